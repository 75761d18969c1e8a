"""Out-of-time, test and train sets, with exact sizes and no sort of the data.

The test set takes, per label, the loans with the smallest hashes until the
class quota is filled. Only counts per hash bucket travel; the boundary they
give turns the assignment into a plain projection over the rows.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditmart.functions.columns import quoted

HASH_DIGITS = 15
BUCKET_DIGITS = 4
COPIES_PER_TASK = 10_000
# Rows equal in these are copies of one loan outcome.
IDENTITY = ["loan_id", "Customer_ID", "loan_start_date", "label_snapshot_date", "label"]


@dataclass(frozen=True)
class Boundary:
    """Hashes below ``hash`` are test rows; of the rows equal to it, ``take`` out of ``ties``."""

    hash: int
    take: int
    ties: int


@dataclass(frozen=True)
class SplitPlan:
    cutoff: date
    seed: int
    identity: tuple[str, ...]
    sizes: dict[str, int] = field(default_factory=dict)
    boundaries: dict[int, Boundary] = field(default_factory=dict)


def class_quotas(counts: Mapping[int, int], test_size: float) -> dict[int, int]:
    """Test rows per class: ceil(test_size * n) in all, by largest remainder."""
    total, classes = sum(counts.values()), len(counts)
    test_rows = math.ceil(test_size * total)
    if not counts:
        raise ValueError("no rows are left to split into train and test")
    if any(count < 2 for count in counts.values()):
        raise ValueError("every label needs at least two rows to be split")
    if test_rows < classes or total - test_rows < classes:
        raise ValueError("train and test need at least one row per label")
    quotas = {label: count * test_rows // total for label, count in counts.items()}
    by_remainder = sorted(counts, key=lambda label: (-(counts[label] * test_rows % total), label))
    for label in by_remainder[: test_rows - sum(quotas.values())]:
        quotas[label] += 1
    return quotas


def oot_dates(loans: DataFrame, fraction: float = 0.2) -> DataFrame:
    """The newest share of the distinct start dates, one row each.

    The window runs over distinct dates, never over loans.
    """
    dates = loans.groupBy("loan_start_date").agg(F.count("*").alias("loans")).filter("loan_start_date is not null")
    newest = Window.orderBy(F.desc("loan_start_date"))
    everything = Window.partitionBy()
    return (
        dates.withColumn("_rank", F.row_number().over(newest))
        .withColumn("_dates", F.count("*").over(everything))
        .filter(F.col("_rank") <= F.ceil(F.col("_dates") * fraction))
        .drop("_rank", "_dates")
    )


def plan_split(
    loans: DataFrame,
    oot_fraction: float = 0.2,
    test_size: float = 0.2,
    seed: int = 55,
    identity: tuple[str, ...] = tuple(IDENTITY),
) -> SplitPlan:
    """Cutoff date and test boundaries, from three narrow counting passes.

    What reaches the driver is the cutoff, then one row per label.
    """
    cutoff = oot_dates(loans, oot_fraction).agg(F.min("loan_start_date")).first()[0]
    if cutoff is None:
        raise ValueError("no dated loans to split")
    before = loans.filter(F.col("loan_start_date") < F.lit(cutoff))
    per_label = before.groupBy("label").agg(F.count("*").alias("n")).collect()
    counts = {row.label: row.n for row in per_label}
    quotas = class_quotas(counts, test_size)

    earlier = before.select("label", _hash(seed, identity).alias("_hash"))
    width = 16 ** (HASH_DIGITS - BUCKET_DIGITS)
    buckets = _boundary_rows(
        earlier.withColumn("_value", F.floor(F.col("_hash") / width)), quotas
    )
    in_bucket = F.floor(F.col("_hash") / width) == _by_label(
        {label: row.value for label, row in buckets.items()}
    )
    left = {label: quotas[label] - row.before for label, row in buckets.items()}
    exact = _boundary_rows(
        earlier.filter(in_bucket).withColumn("_value", F.col("_hash")), left
    )
    boundaries = {
        label: Boundary(row.value, left[label] - row.before, row.n) for label, row in exact.items()
    }
    test = sum(quotas.values())
    return SplitPlan(
        cutoff, seed, tuple(identity),
        {"train": sum(counts.values()) - test, "test": test},
        boundaries,
    )


def assign_split(loans: DataFrame, plan: SplitPlan) -> DataFrame:
    """Add ``split``: ``oot``, ``test`` or ``train``. No shuffle in the usual case.

    Loans without a start date belong to no set.
    """
    hashed = loans.filter("loan_start_date is not null").withColumn(
        "_hash", _hash(plan.seed, plan.identity)
    )
    # The boundary row itself is a test row unless its copies must be shared out.
    limit = _by_label({
        label: b.hash + (1 if b.take == b.ties else 0) for label, b in plan.boundaries.items()
    })
    later = F.col("loan_start_date") >= F.lit(plan.cutoff)
    split = F.when(later, "oot").when(F.col("_hash") < limit, "test").otherwise("train")
    torn = {label: b.hash for label, b in plan.boundaries.items() if b.take < b.ties}
    if not torn:
        return hashed.withColumn("split", split).drop("_hash")
    shared = F.coalesce(~later & (F.col("_hash") == _by_label(torn)), F.lit(False))
    return (
        hashed.filter(~shared).withColumn("split", split)
        .unionByName(_share_copies(hashed.filter(shared), plan))
        .drop("_hash")
    )


def split_report(rows: DataFrame) -> DataFrame:
    """Rows and default rate per set."""
    return rows.groupBy("split").agg(
        F.count("*").alias("rows"), F.avg("label").alias("default_rate")
    )


def _hash(seed: int, identity: tuple[str, ...]) -> Column:
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in identity])
    return F.conv(F.left(F.md5(text), F.lit(HASH_DIGITS)), 16, 10).cast("long")


def _by_label(values: Mapping[int, int]) -> Column:
    """The value of a row's label; null for a label without one."""
    chosen = F.lit(None).cast("long")
    for label, value in values.items():
        chosen = F.when(F.col("label") == label, F.lit(value).cast("long")).otherwise(chosen)
    return chosen


@dataclass(frozen=True)
class _Row:
    value: int
    n: int
    before: int


def _boundary_rows(values: DataFrame, quotas: Mapping[int, int]) -> dict[int, _Row]:
    """Per label, the value at which the running count reaches the quota.

    The window sees one row per label and value: 65,536 hash buckets, and then
    the hashes inside one of them.
    """
    quota = _by_label(quotas)
    running = F.sum("n").over(Window.partitionBy("label").orderBy("_value"))
    rows = (
        values.groupBy("label", "_value").agg(F.count("*").alias("n"))
        .withColumn("upto", running)
        .filter((F.col("upto") >= quota) & (F.col("upto") - F.col("n") < quota))
        .collect()
    )
    return {row.label: _Row(row._value, row.n, row.upto - row.n) for row in rows}


def _share_copies(copies: DataFrame, plan: SplitPlan) -> DataFrame:
    """Identical rows at a boundary: count them, and hand out the counts.

    The copies of a hot row are counted before the shuffle and written out again
    in blocks spread over the tasks, so no task holds them all.
    """
    columns = copies.columns
    counted = copies.groupBy(*[quoted(c) for c in columns]).agg(F.count("*").alias("_n"))
    order = Window.partitionBy("label").orderBy(*[quoted(c) for c in columns])
    take = _by_label({label: boundary.take for label, boundary in plan.boundaries.items()})
    start = F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, -1))
    blocks = counted.withColumn("_start", F.coalesce(start, F.lit(0))).withColumn(
        "_block", F.explode(F.sequence(F.lit(0), F.floor((F.col("_n") - 1) / COPIES_PER_TASK)))
    )
    number = F.explode(F.sequence(
        F.col("_block") * COPIES_PER_TASK + 1,
        F.least(F.col("_n"), (F.col("_block") + 1) * COPIES_PER_TASK),
    ))
    spread = blocks.repartition("_hash", "_block").withColumn("_number", number)
    chosen = F.col("_start") + F.col("_number") <= take
    return spread.withColumn("split", F.when(chosen, "test").otherwise("train")).select(*columns, "split")
