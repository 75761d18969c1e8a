"""Click history kept from run to run: a month is added to the totals of the month before.

The totals of every cutoff are a snapshot table. Its log says which files of the
cleaned clicks each run has read and which totals it started from, so a later
run knows which days were written anew since, and computes only their customers again.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditmart.operators import history
from creditmart.sources import log, tables
from creditmart.sources.spine import as_dates


@dataclass(frozen=True)
class Basis:
    """Where a run starts: the totals of ``cutoff``, and what was written anew since they were made."""

    cutoff: str
    folder: str | None
    changed: dict[str, list[str]]


def files_read(totals: log.State, cutoff: str) -> dict[str, str]:
    """The folder of every day of clicks that went into the totals of ``cutoff``, by day."""
    found: dict[str, str] = {}
    place, end = totals.folders[cutoff], cutoff
    run = log.run_of(place) if place else _maker(totals, cutoff)
    while run:
        note = totals.notes[run]
        for day, folder in note["read"].items():
            if day < end:
                found.setdefault(day, folder)
        run, end = note["base_run"], min(end, note["base"])
    return found


def _maker(totals: log.State, cutoff: str) -> str:
    """The run that made an empty snapshot."""
    return [run for run, note in totals.notes.items() if cutoff in note["cutoffs"]][-1]


def basis(spark: SparkSession, clicks: log.State, clicks_path: str, totals: log.State | None, first: str) -> Basis | None:
    """The latest totals not after ``first``, if what changed since can be told."""
    known = sorted(cutoff for cutoff in totals.folders if cutoff <= first) if totals else []
    if not known:
        return None
    cutoff, changed = known[-1], {}
    read, files = files_read(totals, cutoff), log.Folder(spark, clicks_path)
    for day in sorted({*read, *(d for d in clicks.folders if d < cutoff)}):
        old, new = read.get(day, ""), clicks.folders.get(day) or ""
        if old != new:
            if old and not files.exists(old):
                return None
            changed[day] = [folder for folder in (old, new) if folder]
    return Basis(cutoff, totals.folders[cutoff], changed)


def totals_frame(
    spark: SparkSession, clicks_path: str, totals_path: str, spine: Iterable[str | date]
) -> tuple[DataFrame, dict]:
    """Totals at the cutoffs of ``spine``, and the note that says what they are made of.

    Read are the totals of the latest cutoff before, and the days of clicks since. Of earlier days only those
    customers are read that have a row in a day that was written anew since,
    before or after that.
    """
    cutoffs = [str(day) for day in as_dates(spine)]
    clicks, totals = log.latest(spark, clicks_path), log.latest(spark, totals_path)
    start = basis(spark, clicks, clicks_path, totals, cutoffs[0])
    days = sorted(day for day in clicks.folders if day < cutoffs[-1])
    since = [day for day in days if start is None or day >= start.cutoff]
    rows, base = tables.read_snapshots(spark, clicks_path, values=since), None
    if start is not None:
        base = tables.read_folders(spark, totals_path, totals, [start.folder] if start.folder else [])
        anew = sorted({folder for folders in start.changed.values() for folder in folders})
        if anew:
            customers = tables.read_folders(spark, clicks_path, clicks, anew).select("Customer_ID").distinct()
            base = base.join(customers, base.Customer_ID.eqNullSafe(customers.Customer_ID), "left_anti")
            earlier = tables.read_snapshots(spark, clicks_path, values=[day for day in days if day < start.cutoff])
            again = earlier.join(customers, earlier.Customer_ID.eqNullSafe(customers.Customer_ID), "left_semi")
            rows = rows.unionByName(again)
    read = {day: clicks.folders[day] or "" for day in (days if start is None or start.changed else since)}
    unchanged = start is not None and not start.changed
    note = {
        "cutoffs": cutoffs, "read": read,
        "base": start.cutoff if unchanged else "", "base_run": _run(totals, start.cutoff) if unchanged else None,
    }
    return history.running_totals(rows, cutoffs, base=base), note


def _run(totals: log.State, cutoff: str) -> str:
    place = totals.folders[cutoff]
    return log.run_of(place) if place else _maker(totals, cutoff)


def update(spark: SparkSession, clicks_path: str, totals_path: str, spine: Iterable[str | date]) -> None:
    """Bring the stored totals of these cutoffs up to date; other cutoffs stay as they are."""
    spine = as_dates(spine)
    found, note = totals_frame(spark, clicks_path, totals_path, spine)
    tables.write_snapshots(found, totals_path, dates=spine, note=note)


def read(spark: SparkSession, totals_path: str, spine: Iterable[str | date] | None = None) -> DataFrame:
    """Means and active days at stored cutoffs."""
    return history.means(tables.read_snapshots(spark, totals_path, spine))
