"""Generic profiling: frequencies, conditional counts, distributions, histograms."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditmart.functions.columns import quoted, usable
from creditmart.functions.quantiles import exact_quantiles, outline, quantiles
from creditmart.session import mart_settings


# Hex digits of a hash that name its bucket in a sample: 65,536 buckets.
SAMPLE_DIGITS = 4


def frequency(df: DataFrame, column: str, count_as: str = "counts") -> DataFrame:
    """Known values counted per value; the group of nulls counts zero."""
    return df.groupBy(column).agg(F.count(quoted(column)).alias(count_as)).orderBy(column)


def frequencies(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``frequency`` of several columns, stacked, from one scan."""
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column"), quoted(c).cast("string").alias("value")) for c in columns
    ])
    return df.select(F.inline(pairs)).groupBy("column", "value").agg(F.count("value").alias("counts"))


def value_counts(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """Rows per value with nulls as a value of their own, most frequent first."""
    counts = df.groupBy(column).agg(F.count("*").alias("rows"))
    ranked = counts.orderBy(F.desc("rows"), column)
    return ranked if top is None else ranked.limit(top)


def values_between(
    df: DataFrame, values: Mapping[str, Column], low: float, high: float
) -> DataFrame:
    """Row counts of each column's values inside a closed range, from one scan.

    A condition on the group key is the same before grouping, and cheaper.
    """
    pairs = F.array(*[
        F.struct(F.lit(name).alias("column"), value.alias("value")) for name, value in values.items()
    ])
    return (
        df.select(F.inline(pairs)).filter(F.col("value").between(low, high))
        .groupBy("column", "value").agg(F.count("*").alias("rows"))
    )


def exploded_frequency(
    df: DataFrame, entries: Column, name: str, mentions: str, distinct: str, distinct_as: str
) -> DataFrame:
    """Mentions and distinct owners per list entry."""
    return (
        df.select(F.col(distinct), F.explode(entries).alias(name))
        .withColumn(name, F.trim(name))
        .groupBy(name, distinct).agg(F.count("*").alias("_n"))
        .groupBy(name).agg(F.sum("_n").alias(mentions), F.count(distinct).alias(distinct_as))
        .orderBy(F.desc(distinct_as), name)
    )


def conditional_counts(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """Rows in all, and rows per condition, in one pass."""
    return df.agg(
        F.count("*").alias("rows"),
        *[F.count_if(condition).alias(name) for name, condition in conditions.items()],
    )


def bucketed(df: DataFrame, bucket: Column, amount: Column) -> DataFrame:
    """Rows, share of all rows, least, median and largest amount per bucket.

    The share divides by the sum of the bucket counts, a handful of rows.
    """
    rows = df.select(bucket.alias("bucket"), amount.alias("amount"))
    counts = rows.groupBy("bucket").agg(
        F.count("*").alias("rows"), F.min("amount").alias("_min"), F.max("amount").alias("_max")
    )
    medians = exact_quantiles(rows, ["amount"], [0.5], keys=["bucket"])
    total = F.sum("rows").over(Window.partitionBy())
    return (
        counts.join(medians, "bucket", "left")
        .withColumn("pct", F.round(100.0 * F.col("rows") / total, 1))
        .orderBy(F.asc_nulls_last("_min"))
        .select(
            "bucket", "rows", "pct",
            F.round("_min", 1).alias("min_amount"),
            F.round(F.get("amount", F.lit(0)), 1).alias("median_amount"),
            F.round("_max", 1).alias("max_amount"),
        )
    )


def range_summary(df: DataFrame, ranges: Mapping[str, tuple[Column, float, float]]) -> DataFrame:
    """Per column: values in, below and above its range, and the largest; one pass."""
    aggregates, rows = [], []
    for i, (name, (value, low, high)) in enumerate(ranges.items()):
        aggregates += [
            F.count_if(value.between(low, high)).alias(f"in_{i}"),
            F.count_if(value < low).alias(f"below_{i}"),
            F.count_if(value > high).alias(f"above_{i}"),
            F.max(value).alias(f"max_{i}"),
        ]
        rows.append(F.struct(
            F.lit(name).alias("column_name"), F.lit(low).alias("low"), F.lit(high).alias("high"),
            F.col(f"in_{i}").alias("in_range"), F.col(f"below_{i}").alias("below_range"),
            F.col(f"above_{i}").alias("above_range"), F.col(f"max_{i}").alias("max_value"),
        ))
    return df.agg(*aggregates).select(F.inline(F.array(*rows)))


def describe_numbers(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float] = (0.25, 0.5, 0.75),
    accuracy: int | None = None,
) -> DataFrame:
    """One row per column: count, mean, sample deviation, min, quantiles, max.

    Quantiles are exact unless an ``accuracy`` is given, see ``functions.quantiles``.
    """
    types = dict(df.dtypes)
    values = {c: usable(quoted(c), types[c]).cast("double") for c in columns}
    moments = [
        F.struct(
            F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
            F.min(v).alias("min"), F.max(v).alias("max"),
        ).alias(f"_{i}")
        for i, v in enumerate(values.values())
    ]
    if accuracy is None:
        # One pass gives the moments and what the quantiles need first.
        outlines = [outline(v).alias(f"_{i}_outline") for i, v in enumerate(values.values())]
        with mart_settings(df.sparkSession):
            both = df.agg(*moments, *outlines).first()
            found = exact_quantiles(df, columns, probabilities, outlines=both[len(moments):])
        described = df.sparkSession.createDataFrame([both[:len(moments)]], ", ".join(
            f"_{i} struct<count: bigint, mean: double, std: double, min: double, max: double>" for i in range(len(moments))
        ))
    else:
        described = df.agg(*moments)
        found = quantiles(df, columns, probabilities, accuracy=accuracy)
    names = [f"p{round(p * 100):02d}" for p in probabilities]
    return (
        _stacked(described, columns)
        .join(_stacked(found, columns, positional=False), "column", "left")
        .select(
            "column", "value.*",
            *[F.get("quantile", F.lit(i)).alias(name) for i, name in enumerate(names)],
        )
    )


def _stacked(one_row: DataFrame, columns: Sequence[str], positional: bool = True) -> DataFrame:
    """One row with a field per column -> one row per column."""
    field = "value" if positional else "quantile"
    return one_row.select(F.inline(F.array(*[
        F.struct(
            F.lit(c).alias("column"),
            (F.col(f"_{i}") if positional else quoted(c)).alias(field),
        )
        for i, c in enumerate(columns)
    ])))


def describe_texts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: count, distinct values, the most frequent and its count.

    Equal values are counted before the shuffle; ties go to the smaller value.
    """
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column"), quoted(c).cast("string").alias("value")) for c in columns
    ])
    counts = (
        df.select(F.inline(pairs)).filter("value is not null")
        .groupBy("column", "value").agg(F.count("*").alias("n"))
    )
    found = counts.groupBy("column").agg(
        F.sum("n").alias("count"),
        F.count("*").alias("unique"),
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("top"),
        F.max("n").alias("freq"),
    )
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "column string")
    return names.join(found, "column", "left").fillna(0, ["count", "unique"])


def describe_all(df: DataFrame) -> DataFrame:
    """Both descriptions of every column in one table; measures that do not apply are null."""
    numeric = [c for c, dtype in df.dtypes if dtype in ("int", "bigint", "float", "double")]
    texts = [c for c in df.columns if c not in numeric]
    parts = []
    if numeric:
        parts.append(describe_numbers(df, numeric))
    if texts:
        parts.append(describe_texts(df, texts))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def flag_percentages(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Share of raised flags among the known ones, one row per flag."""
    shares = df.agg(*[F.avg(quoted(c).cast("int")).alias(f"_{i}") for i, c in enumerate(flags)])
    return shares.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("flag"), (F.col(f"_{i}") * 100).alias("flagged_pct"))
        for i, c in enumerate(flags)
    ])))


def histogram(
    df: DataFrame, value: Column, bins: int, low: float | None = None, high: float | None = None
) -> DataFrame:
    """Rows per equal-width bin, empty bins included; the last bin is closed.

    Without bounds the range is that of the values, found in a pass of its own.
    Values outside the bounds are left out, as are nulls, NaN and infinities.
    """
    values = df.select(value.cast("double").alias("v")).filter(
        ~F.isnan("v") & (F.abs("v") < float("inf"))
    )
    if low is None or high is None:
        ends = values.agg(F.min("v").alias("low"), F.max("v").alias("high")).first()
        low = ends.low if low is None else low
        high = ends.high if high is None else high
    if low is None:
        low, high = 0.0, 1.0
    if low == high:
        low, high = low - 0.5, high + 0.5
    low, high = float(low), float(high)
    width = (high - low) / bins

    def edge(number: Column) -> Column:
        return F.lit(low) + number * F.lit(width)

    guess = F.least(F.floor((F.col("v") - low) / (high - low) * bins), F.lit(bins - 1))
    # The division may miss the edges as reported by one bin.
    position = (
        F.when(F.col("v") < edge(F.col("guess")), F.greatest(F.col("guess") - 1, F.lit(0)))
        .when(F.col("v") >= edge(F.col("guess") + 1), F.least(F.col("guess") + 1, F.lit(bins - 1)))
        .otherwise(F.col("guess"))
    )
    counts = (
        values.filter(F.col("v").between(low, high)).withColumn("guess", guess)
        .groupBy(position.alias("bin")).agg(F.count("*").alias("rows"))
    )
    return (
        df.sparkSession.range(bins).withColumnRenamed("id", "bin")
        .join(counts, "bin", "left").fillna(0, ["rows"])
        .select(
            "bin",
            edge(F.col("bin")).alias("bin_low"),
            edge(F.col("bin") + 1).alias("bin_high"),
            "rows",
        )
        .orderBy("bin")
    )


def trimmed_histogram(
    df: DataFrame, column: str, bins: int, lower: float = 0.01, upper: float = 0.99
) -> DataFrame:
    """Histogram of the values between two exact percentiles.

    The bins span the least and largest value that is kept.
    """
    finite = df.select(quoted(column).cast("double").alias("v")).filter(
        ~F.isnan("v") & (F.abs("v") < float("inf"))
    )
    ends = exact_quantiles(finite, ["v"], [lower, upper]).first()["v"] or [0.0, 0.0]
    return histogram(finite.filter(F.col("v").between(*ends)), F.col("v"), bins)


def extremes(
    df: DataFrame, by: str, k: int, ascending: bool = True, ties: Sequence[str] = ()
) -> DataFrame:
    """The k rows with the least (or largest) known value; ties by the given columns."""
    order = F.asc_nulls_last(by) if ascending else F.desc_nulls_last(by)
    return df.orderBy(order, *ties).limit(k)


def first_rows(df: DataFrame, by: Sequence[str], k: int = 5) -> DataFrame:
    """The first k rows in the given order, found without sorting the table."""
    return df.orderBy(*by).limit(k)


def seeded_sample(df: DataFrame, keys: Sequence[str], rows: int = 10_000, seed: int = 42) -> DataFrame:
    """At most ``rows`` rows, the same ones for the same seed whatever the partitioning.

    The rows with the smallest hashes are the sample. Counts per hash bucket,
    combined before they leave the tasks, tell which bucket fills it, so that only the
    rows up to there are sorted.
    """
    text = F.concat_ws("|", F.lit(str(seed)), *[quoted(key).cast("string") for key in keys])
    hashed = df.withColumn("_hash", F.md5(text))
    bucket = F.left("_hash", F.lit(SAMPLE_DIGITS))
    counts = hashed.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))
    running = F.sum("n").over(Window.orderBy("bucket"))
    # One row per bucket, however many rows there are.
    filled = counts.withColumn("upto", running).filter(F.col("upto") >= rows)
    last = filled.agg(F.min("bucket")).first()[0]
    if last is not None:
        hashed = hashed.filter(bucket <= last)
    return hashed.orderBy("_hash", *keys).limit(rows).drop("_hash")
