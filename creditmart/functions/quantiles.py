"""Quantiles that hold at any group size, exact unless an accuracy is given.

Spark's own ``percentile`` keeps every distinct value of a group in one buffer.
That is the fastest way for ordinary groups and is what they get here. A group
above ``one_task_rows`` values takes two passes, whatever its values are: the
first builds a mergeable sketch per group and column, which tells between which values
a rank must lie; the second counts the values below and, by value, those in between.
Without groups the first pass also counts the values, and in the second a value outside
all ranges becomes one for all of its gap before it is counted.
The counts are exact, so a sketch that was wrong is noticed and costs a pass, not a
result. Ranges that would still hold more than ``gather_rows`` values are
sketched once more. No pass shuffles values outside the ranges.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from creditmart.functions.columns import quoted, usable
from creditmart.session import ensure_checkpoint_dir

ONE_TASK_ROWS = 1_000_000
GATHER_ROWS = 5_000_000
BROADCAST_GROUPS = 100_000
# Size of a sketch, about 200 kB; its ranks are within 0.0007 of the true ones in 99 of 100 cases.
SKETCH = 8192
# Steps of rank that a sketch is asked for, and twice the error in such steps.
GRID, SLACK = 1024, 1.4
# Values that lie close together in rank may need many sketches; then the last range is counted as it is.
MOST_SKETCHES = 6


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    keys: Sequence[str] = (),
    accuracy: int | None = None,
    total: int | None = None,
) -> DataFrame:
    """:func:`exact_quantiles`, or with an ``accuracy`` values of the data near the ranks, in one pass.

    Ranks are then off by a share of about one in ``accuracy``; nothing lies between two values.
    """
    if accuracy is None:
        return exact_quantiles(df, columns, probabilities, keys, total=total)
    types = dict(df.dtypes)
    wanted = [float(p) for p in probabilities]
    found = [
        F.percentile_approx(usable(quoted(c), types[c]).cast("double"), wanted, accuracy).alias(c) for c in columns
    ]
    return df.groupBy(*[quoted(key) for key in keys]).agg(*found)


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    keys: Sequence[str] = (),
    one_task_rows: int = ONE_TASK_ROWS,
    gather_rows: int = GATHER_ROWS,
    total: int | None = None,
    outlines: Sequence[Row] | None = None,
) -> DataFrame:
    """Linearly interpolated quantiles, nulls and NaN left out.

    Returns the keys and, per column, ``array<double>`` in the order of
    ``probabilities`` (null for a group without values). Without keys the
    result is one row; a caller that knows how many values the columns hold in
    ``total`` saves the pass that counts them, if they are few. One that has an :func:`outline` of
    every column saves the first pass.
    """
    types, keys = dict(df.dtypes), list(keys)
    values = df.select(
        *[quoted(key) for key in keys],
        *[usable(quoted(c), types[c]).cast("double").alias(c) for c in columns],
    )
    wanted = F.array(*[F.lit(float(p)) for p in probabilities])
    in_one_buffer = [F.percentile(quoted(c), wanted).alias(c) for c in columns]
    counts = [F.count(quoted(c)) for c in columns]

    if not keys:
        if outlines is None and (total is None or total > one_task_rows):
            found = _scan(values, columns, keys).groupBy("_c").agg(outline(F.col("_v")).alias("outline")).collect()
            outlined = {row["_c"]: row["outline"] for row in found}
        else:
            outlined = dict(enumerate(outlines or ()))
        if outlined or total is None:
            total = sum(row["count"] for row in outlined.values())
        if total <= one_task_rows:
            return values.agg(*in_one_buffer)
        return _bracketed(values, columns, probabilities, keys, gather_rows, outlined)

    # At most rows / one_task_rows groups are large, whatever the number of groups.
    ensure_checkpoint_dir(df.sparkSession)
    sizes = values.groupBy(*keys).agg(F.greatest(*counts, F.lit(0)).alias("_n"))
    large = sizes.filter(F.col("_n") > one_task_rows).drop("_n").checkpoint()
    large_count = large.count()
    if large_count == 0:
        return values.groupBy(*keys).agg(*in_one_buffer)
    large = _sized(large, large_count)
    ordinary = _matched(values, large, keys, "left_anti")
    return ordinary.groupBy(*keys).agg(*in_one_buffer).unionByName(_bracketed(
        _matched(values, large, keys, "left_semi"), columns, probabilities, keys, gather_rows
    ))


def outline(value: Column) -> Column:
    """Aggregate of a column of doubles without NaN: count, least, most, and values at equal steps of rank."""
    found = F.count(value)
    return F.struct(
        found.alias("count"), F.min(value).alias("least"), F.max(value).alias("most"),
        F.when(found > 0, _grid(value)).alias("grid"),
    )


def _matched(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, *conditions: Column
) -> DataFrame:
    """Join on equal keys, where null equals null; the result has the keys once."""
    right = right.withColumnsRenamed({key: f"_right_{key}" for key in keys})
    same = [quoted(key).eqNullSafe(quoted(f"_right_{key}")) for key in keys]
    return left.join(right, same + list(conditions), how).drop(*[f"_right_{key}" for key in keys])


def _sized(small: DataFrame, rows: int) -> DataFrame:
    """Broadcast only when the counted rows are few; else the planner decides."""
    return F.broadcast(small) if rows <= BROADCAST_GROUPS else small


def _scan(values: DataFrame, columns: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """One pass over the values: a row per value, with the number of its column."""
    return (
        values.select(*keys, F.inline(F.array(*[
            F.struct(F.lit(i).alias("_c"), quoted(c).alias("_v")) for i, c in enumerate(columns)
        ])))
        .filter("_v is not null")
    )


def _grid(value: Column | str) -> Column:
    """Values at equal steps of rank, by a sketch of all of them."""
    steps = F.expr(f"array({', '.join(f'{i / GRID!r}D' for i in range(GRID + 1))})")
    return F.kll_sketch_get_quantile_double(F.kll_sketch_agg_double(value, SKETCH), steps)


def _by_gap(value: Column, ranges: Sequence[tuple[float, float]]) -> Column:
    """Values inside a range as they are; others as the largest below the next range, null above all."""
    chosen = F
    for low, high in sorted(ranges):
        chosen = chosen.when(value < F.lit(low), F.lit(math.nextafter(low, -math.inf))).when(value <= F.lit(high), value)
    return chosen


def _bracketed(values, columns, probabilities, keys, gather_rows, outlines=None) -> DataFrame:
    """The ranges are rows (keys, column number, target number); see the module text."""
    spark = values.sparkSession
    target = [*keys, "_c", "_t"]
    fixed = ["_n", "_least", "_most", "_position", "_lower", "_upper"]

    def pin(state: DataFrame) -> DataFrame:
        """Cut the lineage between passes: the state has one row per target."""
        if keys:
            return state.checkpoint()
        return spark.createDataFrame(state.collect(), state.schema)

    def narrower(state: DataFrame) -> DataFrame:
        """Ranges of a few steps around the wanted ranks, and how many rows they should hold; zero for few rows anyway."""
        def step(rank: Column) -> Column:
            return (rank - F.col("_before")) / F.col("_inside") * GRID

        low = F.floor(step(F.col("_lower")) - SLACK).cast("int")
        high = F.ceil(step(F.col("_upper") + 1) + SLACK).cast("int")
        few = F.col("_inside") < 4 * GRID
        expected = F.least(F.col("_inside") * (high - low) / GRID, F.col("_different"))
        return state.select(
            *target, *fixed, F.when(few, 0).otherwise(expected.cast("long")).alias("_expected"),
            F.when(few | (low <= 0), F.col("_lo")).otherwise(F.get("_grid", low)).alias("_lo"),
            F.when(few | (high >= GRID), F.col("_hi")).otherwise(F.get("_grid", high)).alias("_hi"),
        )

    ranks = F.array(*[
        F.struct(F.lit(i).alias("_t"), ((F.col("_n") - 1) * F.lit(float(p))).alias("_position"))
        for i, p in enumerate(probabilities)
    ])
    if outlines is None:
        outlined = _scan(values, columns, keys).groupBy(*keys, "_c").agg(
            F.count("*").alias("_n"), F.min("_v").alias("_least"), F.max("_v").alias("_most"), _grid("_v").alias("_grid")
        )
    else:
        outlined = spark.createDataFrame(
            [(i, row["count"], row["least"], row["most"], row["grid"]) for i, row in outlines.items() if row["count"]],
            "_c int, _n bigint, _least double, _most double, _grid array<double>",
        )
    state = pin(narrower(
        outlined.select("*", F.inline(ranks))
        # Before: values below the range. Below and above: the two wanted neighbours.
        .withColumns({
            "_lo": F.col("_least"), "_hi": F.col("_most"), "_before": F.lit(0).cast("long"), "_inside": F.col("_n"),
            "_lower": F.floor("_position"), "_upper": F.ceil("_position"), "_different": F.col("_n"),
        })
    ))
    rows = state.count()

    def upto_the_end(state: DataFrame) -> DataFrame:
        """All values not above a range, once for every range."""
        return _matched(
            _scan(values, columns, keys), _sized(state, rows), [*keys, "_c"], "inner", F.col("_v") <= F.col("_hi")
        )

    def equal_values(state: DataFrame) -> DataFrame:
        """The same with the number of ``_rows``; without groups values are counted before they meet the ranges."""
        if keys:
            return upto_the_end(state).withColumn("_rows", F.lit(1))
        ranges: dict[int, list[tuple[float, float]]] = {}
        for row in state.collect():
            ranges.setdefault(row["_c"], []).append((row["_lo"], row["_hi"]))
        needed = [columns[i] for i in sorted(ranges)]
        cut = values.select(*[_by_gap(quoted(columns[i]), ranges[i]).alias(columns[i]) for i in sorted(ranges)])
        numbers = F.array(*[F.lit(i) for i in sorted(ranges)])
        counts = _scan(cut, needed, keys).groupBy("_c", "_v").agg(F.count("*").alias("_rows"))
        counts = counts.withColumn("_c", F.get(numbers, F.col("_c")))
        return _matched(counts, _sized(state, rows), ["_c"], "inner", F.col("_v") <= F.col("_hi"))

    inside = F.when(F.col("_v") >= F.col("_lo"), F.col("_v"))
    for _ in range(MOST_SKETCHES):
        wide = state.filter(F.col("_expected") > gather_rows)
        if wide.isEmpty():
            break
        counted = (
            upto_the_end(wide).groupBy(*target)
            .agg(
                *[F.first(c).alias(c) for c in fixed], F.count_if(F.col("_v") < F.col("_lo")).alias("_before"),
                F.count(inside).alias("_inside"), F.min(inside).alias("_lo"), F.max(inside).alias("_hi"),
                F.approx_count_distinct(inside).alias("_different"), _grid(inside).alias("_grid"),
            )
        )
        # A range that a sketch has put beside the rank is given up for all values.
        holds = (F.col("_lower") >= F.col("_before")) & (F.col("_upper") < F.col("_before") + F.col("_inside"))
        whole = wide.withColumns({"_lo": F.col("_least"), "_hi": F.col("_most"), "_expected": F.col("_n")})
        found = narrower(counted.filter(holds))
        state = pin(
            state.filter(F.col("_expected") <= gather_rows).unionByName(found)
            .unionByName(_matched(whole, found.select(*target), target, "left_anti"))
        )

    settled = None
    while settled is None or not state.isEmpty():
        # Values below a range become one; equal values are counted before the shuffle.
        counted = equal_values(state).groupBy(*target, inside.alias("_value")).agg(
            F.sum("_rows").alias("_rows"), *[F.first(c).alias(c) for c in fixed]
        )
        upto = F.sum("_rows").over(Window.partitionBy(*target).orderBy("_value"))

        def holding(rank: str) -> Column:
            return F.max(F.when((F.col(rank) < F.col("_upto")) & (F.col(rank) >= F.col("_upto") - F.col("_rows")), F.col("_value")))

        found = pin(
            counted.withColumn("_upto", upto).groupBy(*target)
            .agg(F.first("_position").alias("_position"), holding("_lower").alias("_below"), holding("_upper").alias("_above"))
            .filter("_below is not null and _above is not null")
        )
        settled = found if settled is None else pin(settled.unionByName(found))
        state = pin(_matched(state, found.select(*target), target, "left_anti").withColumns(
            {"_lo": F.col("_least"), "_hi": F.col("_most")}
        ))

    share = F.col("_position") - F.floor("_position")
    value = F.when(F.col("_below") == F.col("_above"), F.col("_below")).otherwise(
        F.col("_below") * (1 - share) + F.col("_above") * share
    )
    results = settled.select(*target, value.alias("_q"))

    def quantile(i: int, t: int) -> Column:
        return F.max(F.when((F.col("_c") == i) & (F.col("_t") == t), F.col("_q")))

    return results.groupBy(*keys).agg(*[
        F.when(
            F.count_if(F.col("_c") == i) > 0,
            F.array(*[quantile(i, t) for t in range(len(probabilities))]),
        ).alias(c)
        for i, c in enumerate(columns)
    ])
