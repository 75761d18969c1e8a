"""The vocabulary of loan types as a stored table that only grows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from creditmart.operators import features
from creditmart.sources import log, tables

# The column by which the table is kept: the number of the run that learnt an entry.
LEARNT = "learnt"


def entries(spark: SparkSession, path: str) -> DataFrame:
    """All entries with their ``ordinal``, which never changes."""
    return tables.read_snapshots(spark, path).select("ordinal", "loan_type")


def learn(spark: SparkSession, silver: str, path: str) -> list[str]:
    """Add the loan types of the cleaned snapshots that were not read before, and return all.

    Which files the table has learnt from is kept in its log, so a run reads the
    snapshots written since the last one, also older ones written anew. Entries
    get the next ordinals, by name within a run; none is ever removed. More than
    ``config.MAX_COLUMNS`` entries raise an error and leave the table as it was.
    """
    before = log.latest(spark, path)
    read = {date: place for note in before.notes.values() for date, place in note["read"].items()} if before else {}
    cleaned = log.latest(spark, silver)
    fresh = {date: place for date, place in cleaned.folders.items() if place != read.get(date)}
    if any(fresh.values()):
        found = features.loan_vocabulary(tables.read_snapshots(spark, silver, values=fresh))
        known = entries(spark, path) if before else None
        new = found if known is None else found.join(known, "loan_type", "left_anti")
        start = known.count() if known is not None else 0
        features.vocabulary_list(new)
        # A vocabulary becomes columns, so ordering it in one task is no bottleneck.
        rows = new.limit(features.config.MAX_COLUMNS + 1).select(
            (F.row_number().over(Window.orderBy("loan_type")) + start).alias("ordinal"), "loan_type",
            F.lit(str(before.version + 1 if before else 0)).alias(LEARNT),
        )
        run = str(before.version + 1 if before else 0)
        tables.write_snapshots(rows, path, by=LEARNT, values=[run], note={"read": fresh})
    return features.vocabulary_list(entries(spark, path).orderBy("ordinal"))
