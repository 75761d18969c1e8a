"""The backfill: raw files to the joined feature store, every date at once."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from creditmart.operators import assemble, clean, features, loans
from creditmart.plans import click_history, vocabulary
from creditmart.session import mart_settings
from creditmart.sources import log, raw, tables
from creditmart.sources.buckets import Buckets, count_for
from creditmart.sources.spine import as_dates

DATASETS = ["lms", "fe_attr", "fe_fin", "fe_click"]


@dataclass(frozen=True)
class Layout:
    """Where the layer tables live below one root folder."""

    root: str

    def bronze(self, dataset: str) -> str:
        return f"{self.root}/bronze/{dataset}"

    def silver(self, dataset: str) -> str:
        return f"{self.root}/silver/{dataset}"

    def gold(self, name: str) -> str:
        return f"{self.root}/gold/{name}"


def _together(spark: SparkSession, jobs: Iterable[Callable[[], None]]) -> None:
    """Run independent writes at the same time; Spark shares its cores among them."""
    with ThreadPoolExecutor(len(DATASETS)) as pool:
        for running in [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]:
            running.result()


def run_bronze(
    spark: SparkSession, sources: Mapping[str, str], layout: Layout, spine: Iterable[str | date]
) -> None:
    """One scan per source file for all snapshots."""
    def write(dataset: str) -> None:
        chosen = raw.select_snapshots(raw.read_text_columns(spark, sources[dataset]), spine)
        tables.write_snapshots(
            chosen, layout.bronze(dataset), by=raw.SNAPSHOT_PARTITION, dates=spine
        )

    _together(spark, [partial(write, dataset) for dataset in DATASETS])


def run_silver(spark: SparkSession, layout: Layout, spine: Iterable[str | date]) -> None:
    rules = {
        "lms": lambda df: loans.delinquency(loans.typed(df)),
        "fe_attr": clean.attributes,
        "fe_fin": clean.financials,
        "fe_click": clean.clicks,
    }

    def write(dataset: str) -> None:
        text = tables.read_snapshots(spark, layout.bronze(dataset), spine, by=raw.SNAPSHOT_PARTITION)
        text = text.drop(raw.SNAPSHOT_PARTITION)
        # Bronze lies by snapshot already; only the removal of repeated clicks mixes the rows.
        tables.write_snapshots(
            rules[dataset](text), layout.silver(dataset), dates=spine, rebalance=dataset == "fe_click"
        )

    _together(spark, [partial(write, dataset) for dataset in DATASETS])


def _bucket_count(spark: SparkSession, layout: Layout, spine: Iterable[str | date]) -> int:
    """As many as the joined table has; at first by the stored bytes of the silver snapshots to be joined."""
    before = log.latest(spark, layout.gold("joined_features"))
    if before is not None and before.buckets:
        return list(before.buckets.values())[-1][1]
    asked, stored = {str(day) for day in spine}, 0
    for dataset in ("fe_attr", "fe_fin"):
        path = layout.silver(dataset)
        state, folder = log.latest(spark, path), log.Folder(spark, path)
        if state is not None:
            stored += sum(folder.stored_bytes(place) for day, place in state.folders.items() if place and day in asked)
    return count_for(stored)


def run_gold(
    spark: SparkSession,
    layout: Layout,
    spine: Iterable[str | date],
    loan_types: Sequence[str] | None = None,
    dpd: int = 30,
    mob: int = 6,
    buckets: int | None = None,
) -> None:
    """Labels, the three feature tables, and their join, for the given snapshots.

    The join matches rows of one snapshot only, so the snapshots of earlier runs
    stay as they are and a monthly run joins one month. It also reads one month:
    click totals and vocabulary are kept from run to run and take in what was written since.

    All tables are stored in ``buckets`` by customer, by default as many as earlier
    runs had, so that guard and joins find each customer's rows in one place.

    Without ``loan_types`` the vocabulary is learnt from all silver snapshots,
    later ones included, so that every snapshot has the same columns; in
    snapshots older than a loan type its count reads as zero.
    """
    spine = as_dates(spine)
    cut = Buckets("Customer_ID", buckets or _bucket_count(spark, layout, spine))

    def silver(dataset: str) -> DataFrame:
        return tables.read_snapshots(spark, layout.silver(dataset), spine)

    def write(name: str, table: Callable[[], DataFrame]) -> None:
        tables.write_snapshots(table(), layout.gold(name), dates=spine, buckets=cut)

    def financials() -> DataFrame:
        known = loan_types
        if known is None:
            known = vocabulary.learn(spark, layout.silver("fe_fin"), layout.gold("loan_types"))
        return features.financials(silver("fe_fin"), known)

    def clicks() -> DataFrame:
        click_history.update(spark, layout.silver("fe_click"), layout.gold("click_totals"), spine)
        return click_history.read(spark, layout.gold("click_totals"), spine)

    _together(spark, [
        partial(write, "fe_click", clicks),
        partial(write, "fe_fin", financials),
        partial(write, "label_store", lambda: loans.default_label(silver("lms"), dpd, mob)),
        partial(write, "fe_attr", lambda: features.attributes(silver("fe_attr"))),
    ])
    joined = assemble.features(*[
        tables.read_snapshots(spark, layout.gold(name), spine) for name in ("fe_attr", "fe_fin", "fe_click")
    ])
    tables.write_snapshots(joined, layout.gold("joined_features"), dates=spine, buckets=cut)


def backfill(
    spark: SparkSession,
    sources: Mapping[str, str],
    root: str,
    spine: Iterable[str | date],
    loan_types: Sequence[str] | None = None,
    dpd: int = 30,
    mob: int = 6,
) -> Layout:
    """Run all layers for the given snapshots; other snapshots are left alone.

    Every layer is read by the columns of all its snapshots. A source column that a
    later run adds is null in earlier snapshots; a loan type counts as zero there where the
    list of loans is known, as if one run had learnt all types.
    """
    layout, spine = Layout(root), as_dates(spine)
    with mart_settings(spark):
        run_bronze(spark, sources, layout, spine)
        run_silver(spark, layout, spine)
        run_gold(spark, layout, spine, loan_types, dpd, mob)
    return layout
