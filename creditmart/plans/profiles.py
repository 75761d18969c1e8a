"""Profiles of stored tables: one state per column and snapshot, merged by reports.

A state holds what adds up over snapshots: counts, moments, extremes, counts
around a range, a quantile sketch and a sketch of distinct values. Reports over any
snapshots merge states and read no data; a new snapshot costs one scan of itself. Counts,
mean, deviation, extremes and value counts are exact; quantiles and
distinct values come from the sketches.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from creditmart.functions.columns import quoted, usable
from creditmart.sources import log, tables

NUMBERS = ("int", "bigint", "float", "double")
# Rank error of the quantiles about 0.7 %, of the distinct values about 1.6 %.
QUANTILE_K, DISTINCT_LOG2 = 400, 12
# Rows of the states: one per snapshot, one per column, one per value of a category.
TABLE, COLUMN, VALUE = "table", "column", "value"


def _state(name: str, dtype: str, bounds: Sequence[float] | None) -> Column:
    known = usable(quoted(name), dtype)
    number = known.cast("double") if dtype in (*NUMBERS, "boolean") else None
    nothing, uncounted = F.lit(None).cast("double"), F.lit(None).cast("bigint")
    low, high = bounds or (None, None)
    ranged = number is not None and bounds is not None
    return F.struct(
        F.lit(COLUMN).alias("part"), F.lit(name).alias("column"), F.lit(dtype).alias("dtype"),
        F.count(known).alias("known"),
        (nothing if number is None else F.avg(number)).alias("mean"),
        (nothing if number is None else F.var_pop(number) * F.count(known)).alias("squares"),
        (nothing if number is None else F.min(number)).alias("min"),
        (nothing if number is None else F.max(number)).alias("max"),
        (F.count_if(number.between(low, high)) if ranged else uncounted).alias("in_range"),
        (F.count_if(number < low) if ranged else uncounted).alias("below_range"),
        (F.count_if(number > high) if ranged else uncounted).alias("above_range"),
        (F.lit(None).cast("binary") if number is None else F.kll_sketch_agg_double(number, QUANTILE_K)).alias("quantiles"),
        F.hll_sketch_agg(known.cast("string"), DISTINCT_LOG2).alias("distinct"),
    )


def states(
    df: DataFrame,
    ranges: Mapping[str, tuple[float, float]] | None = None,
    categories: Sequence[str] = (),
    by: str = "snapshot_date",
) -> DataFrame:
    """The states of every snapshot of ``df``.

    All columns come from one scan and one aggregate, combined before the
    shuffle; the value counts of ``categories`` from a second scan of these columns. Nulls
    and NaN are missing; null is a value of its own in the value counts. No rows give no states.
    """
    cells = df.groupBy(by).agg(
        F.count("*").alias("_rows"),
        F.array(*[_state(name, dtype, (ranges or {}).get(name)) for name, dtype in df.dtypes]).alias("_states"),
    )
    columns = cells.select(by, F.inline("_states"))
    found = [columns, cells.select(by, F.lit(TABLE).alias("part"), F.col("_rows").alias("rows"))]
    if categories:
        pairs = F.array(*[
            F.struct(F.lit(VALUE).alias("part"), F.lit(c).alias("column"), quoted(c).cast("string").alias("value"))
            for c in categories
        ])
        found.append(
            df.select(by, F.inline(pairs)).groupBy(by, "part", "column", "value").agg(F.count("*").alias("rows"))
        )
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found)


def update(
    spark: SparkSession,
    table: str,
    path: str,
    ranges: Mapping[str, tuple[float, float]] | None = None,
    categories: Sequence[str] = (),
) -> list[str]:
    """Bring the states of a stored table up to date; returns the snapshots that were scanned.

    The log of the states says which files each was made of and by which rules, so
    only snapshots written since are scanned, all of them replaced at once. A column
    that stands for a value in snapshots older than itself makes all of them new.
    """
    source, before = log.latest(spark, table), log.latest(spark, path)
    if source is None:
        raise ValueError(f"{table}: no snapshot table")
    standing = sorted(f.name for f in source.columns if f.metadata.get(tables.ABSENT))
    rules = {
        "ranges": {name: list(bounds) for name, bounds in (ranges or {}).items()},
        "categories": list(categories), "standing": standing,
    }
    made = {}
    for note in before.notes.values() if before else ():
        made |= {snapshot: (place, note["rules"]) for snapshot, place in note["read"].items()}
    fresh = {snapshot: place for snapshot, place in source.folders.items() if made.get(snapshot) != (place, rules)}
    if fresh:
        rows = tables.read_snapshots(spark, table, values=fresh, by=source.by)
        tables.write_snapshots(
            states(rows, ranges, categories, source.by), path, by=source.by, values=fresh,
            note={"read": fresh, "rules": rules},
        )
    return sorted(fresh)


def read(spark: SparkSession, path: str, dates: Iterable[str | date] | None = None) -> DataFrame:
    """The states of some snapshots, or of all."""
    return tables.read_snapshots(spark, path, dates)


def _merged(found: DataFrame, *more: Column) -> DataFrame:
    """One row per column: what its states add up to, and the rows of all snapshots.

    The number of states is that of snapshots times columns, whatever the data.
    """
    everywhere = Window.partitionBy("column")
    mean = F.sum(F.col("known") * F.col("mean")).over(everywhere) / F.sum(F.when(F.col("mean").isNotNull(), F.col("known"))).over(everywhere)
    shifted = F.col("squares") + F.col("known") * F.pow(F.col("mean") - F.col("_mean"), 2)
    merged = (
        found.where(F.col("part") == COLUMN).withColumn("_mean", mean).groupBy("column")
        .agg(
            F.max("dtype").alias("dtype"), F.sum("known").alias("count"), F.first("_mean", True).alias("mean"),
            F.sum(shifted).alias("_squares"), F.min("min").alias("min"), F.max("max").alias("max"), *more,
        )
    )
    total = found.where(F.col("part") == TABLE).agg(F.coalesce(F.sum("rows"), F.lit(0)))
    return merged.withColumn("rows", total.scalar())


def describe(found: DataFrame, probabilities: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """One row per column: count, distinct values, mean, sample deviation, min, quantiles, max.

    Measures that do not apply are null, also quantiles of a column without values.
    """
    merged = _merged(
        found, F.hll_union_agg("distinct").alias("_distinct"),
        F.kll_merge_agg_double("quantiles").alias("_quantiles"),
    )
    numeric = F.col("dtype").isin(*NUMBERS)

    def of_numbers(value: Column) -> Column:
        return F.when(numeric & (F.col("count") > 0), value)

    return merged.select(
        "column", "count", F.hll_sketch_estimate("_distinct").alias("about_distinct"),
        of_numbers(F.col("mean")).alias("mean"),
        F.when(numeric & (F.col("count") > 1), F.sqrt(F.col("_squares") / (F.col("count") - 1))).alias("std"),
        of_numbers(F.col("min")).alias("min"),
        *[
            of_numbers(F.kll_sketch_get_quantile_double("_quantiles", F.lit(float(p)))).alias(f"p{round(p * 100):02d}")
            for p in probabilities
        ],
        of_numbers(F.col("max")).alias("max"),
    )


def missing_percent(found: DataFrame, top: int | None = 10) -> DataFrame:
    """Share of missing rows per column, the highest first, ties by name.

    A column is missing in all rows of snapshots that are older than itself.
    """
    share = 100.0 * (F.col("rows") - F.col("count")) / F.col("rows")
    ranked = _merged(found).select("column", share.alias("missing_pct")).orderBy(F.desc("missing_pct"), "column")
    return ranked if top is None else ranked.limit(top)


def flag_percentages(found: DataFrame) -> DataFrame:
    """Share of raised flags among the known ones, for every true/false column."""
    return _merged(found).where("dtype = 'boolean'").select(
        F.col("column").alias("flag"), (F.col("mean") * 100).alias("flagged_pct")
    )


def range_counts(found: DataFrame) -> DataFrame:
    """Values in, below and above the range of each column that was given one, and the largest."""
    ranges = ["in_range", "below_range", "above_range"]
    merged = _merged(found, *[F.sum(name).alias(name) for name in ranges])
    return merged.where("in_range is not null").select(
        F.col("column").alias("column_name"), *ranges, F.col("max").alias("max_value")
    )


def value_counts(found: DataFrame, column: str) -> DataFrame:
    """Rows per value of a category with nulls as a value of their own, most frequent first."""
    counted = found.where((F.col("part") == VALUE) & (F.col("column") == column))
    return counted.groupBy(F.col("value").alias(column)).agg(F.sum("rows").alias("rows")).orderBy(F.desc("rows"), column)


def snapshot_rows(found: DataFrame, by: str = "snapshot_date") -> DataFrame:
    """Rows per snapshot."""
    return found.where(F.col("part") == TABLE).select(by, "rows")
