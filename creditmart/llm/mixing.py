"""Mixing sources to target weights by iterative proportional fitting; DataFrame functions only."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from creditmart.functions.joins import attach
from creditmart.session import ensure_checkpoint_dir

# Raking ends where no share is further from its target, or where a round brings the
# furthest one less than a thousandth nearer: the targets then contradict the cells.
TOLERANCE = 1e-6
STALLED = 0.999
DIGITS = 9
OFF_DIGITS = 6
# Cells in one task, and cells that are broadcast to the documents; more are joined by key.
CELLS_PER_TASK = 100_000
BROADCAST_CELLS = 100_000
# Values of a dimension whose sums may go through the driver.
FEW_VALUES = 1000

Targets = Mapping[str, Mapping[str, float]]


def token_count(text: Column) -> Column:
    """Runs of characters that are not ASCII white space; none for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def topic(text: Column, tokens: Column) -> Column:
    """A coarse topic by the form of a text: tabular, brief, article or long."""
    return (
        F.when(F.contains(F.coalesce(text, F.lit("")), F.lit(" | ")), "tabular")
        .when(tokens < 100, "brief").when(tokens < 1000, "article").otherwise("long")
    )


def target_shares(cells: DataFrame, name: str, target: Mapping[str, float]) -> DataFrame:
    """``name`` and ``share`` for every value of one dimension; the shares sum to one.

    Named values get their share. Values that are not named divide what is
    left, one less the named shares, by their tokens. What named values without
    tokens would get is divided among the others by scaling.
    """
    given = F.create_map(*[F.lit(x) for pair in target.items() for x in pair]) if target else None
    rest = max(0.0, 1.0 - sum(target.values()))
    named = F.element_at(given, F.col(name)) if target else F.lit(None).cast("double")
    totals = cells.groupBy(name).agg(F.sum("weight").alias("tokens")).withColumn("named", named)
    open_ = F.when(F.col("named").isNull(), F.col("tokens"))
    all_named, all_open = totals.agg(F.sum("named"), F.sum(open_)).first()
    whole = (all_named or 0.0) + (rest if all_open else 0.0)
    share = F.coalesce("named", F.try_divide(F.lit(rest) * F.col("tokens"), F.lit(all_open)))
    return totals.select(name, F.coalesce(F.try_divide(share, F.lit(whole)), F.lit(0.0)).alias("share"))


def rake(cells: DataFrame, targets: Targets, tolerance: float = TOLERANCE) -> DataFrame:
    """Scale the cells' ``weight`` (tokens) until every dimension has its target shares.

    ``cells`` has one row per combination of values and is stored, so that no
    round reads the documents. Each step divides by the sums per value: of a dimension with
    few values they go through the driver, combined before they leave the tasks;
    of one with many they are a window, whose groups are then small. The
    lineage is cut every round. The result adds ``mixed``, shares of the whole, and
    ``off_target``: how far a share was from its target at most, before it was last scaled. It is
    above ``tolerance`` only if the targets cannot all be met.
    """
    ensure_checkpoint_dir(cells.sparkSession)
    current, few = cells, {}
    for name, target in targets.items():
        shares = target_shares(cells, name, target)
        few[name] = shares.count() <= FEW_VALUES
        current = current.join(shares.withColumnRenamed("share", f"share_{name}"), name)
    current = current.withColumn("mixed", F.col("weight").cast("double"))
    current = current.repartition(cells.rdd.getNumPartitions()).checkpoint()
    off, before = (2.0, 4.0) if targets else (0.0, 0.0)
    while tolerance < off < STALLED * before:
        off, before = 0.0, off
        for name in targets:
            share = F.col(f"share_{name}")
            if few[name]:
                sums = current.groupBy(name, share).agg(F.sum("mixed").alias("mixed")).collect()
                whole = sum(row["mixed"] for row in sums)
                far = max((abs(row["mixed"] / whole - row[f"share_{name}"]) for row in sums), default=0.0) if whole else 0.0
                found = F.create_map(*[F.lit(x) for row in sums for x in (row[name], row["mixed"])]) if sums else None
                total = F.element_at(found, F.col(name)) if sums else F.lit(None).cast("double")
            else:
                whole = current.agg(F.sum("mixed")).first()[0]
                sums = current.groupBy(name, share).agg(F.sum("mixed").alias("mixed"))
                far = sums.agg(F.max(F.abs(F.try_divide("mixed", F.lit(whole)) - share))).first()[0] or 0.0
                total = F.sum("mixed").over(Window.partitionBy(name))
            off = max(off, far)
            scaled = F.try_divide(F.col("mixed") * share, total)
            current = current.withColumn("mixed", F.coalesce(scaled, F.lit(0.0)))
        current = current.checkpoint()
    return current.withColumn("off_target", F.lit(round(off, OFF_DIGITS)))


def uniform(*columns: str) -> Column:
    """A number in [0, 1) that depends on the values alone; nulls count as a value."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(16**13))


def mix(
    documents: DataFrame,
    targets: Targets,
    budget: float = 0.5,
    text: str = "text",
    key: str = "doc_id",
    source: str = "source",
    lang: str = "lang",
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """``row`` with ``n_tokens``, ``source``, ``lang``, ``topic``, ``expected``, ``copies`` and ``off_target``.

    Token weights of the cells (source, language, topic) are raked to the target
    marginals. ``budget`` is the mix's size as a share of all tokens. ``expected``
    is how often the mix should hold a document of its cell: the cell's mixed
    tokens over its tokens. ``copies`` is its whole part, and one more with the
    probability of the rest, drawn from a hash of the document's key: the same on
    every run, and unbiased in every cell. A document whose copies are 0 is not in the mix.
    ``off_target``, the same in all rows with a cell, tells how far the furthest share stays from
    its target: above ``tolerance`` where the targets contradict each other on these cells.

    Null sources and languages are values of their own (``?``). A null or empty text has
    no tokens: nothing is drawn for it. Repeated rows are drawn alike. Cells
    with target 0 are not drawn. Documents are joined to their cell, by broadcast of a
    counted number of cells or else by key.
    """
    tokens = token_count(F.col(f"row.{text}"))
    rows = (
        documents.select(F.struct(*[documents[name] for name in documents.columns]).alias("row"))
        .withColumn("n_tokens", tokens)
        .select(
            "row", "n_tokens",
            F.coalesce(F.col(f"row.{source}").cast("string"), F.lit("?")).alias("source"),
            F.coalesce(F.col(f"row.{lang}").cast("string"), F.lit("?")).alias("lang"),
            topic(F.col(f"row.{text}"), F.col("n_tokens")).alias("topic"),
            uniform(f"row.{key}").alias("draw"),
        )
    )
    names = ["source", "lang", "topic"]
    ensure_checkpoint_dir(documents.sparkSession)
    cells = rows.groupBy(*names).agg(F.sum("n_tokens").cast("double").alias("weight")).where("weight > 0").checkpoint()
    count, whole = cells.agg(F.count("*"), F.sum("weight")).first()
    cells = cells.coalesce(max(1, math.ceil(count / CELLS_PER_TASK))).checkpoint()
    expected = F.round(F.lit(budget) * F.lit(whole) * F.col("mixed") / F.col("weight"), DIGITS)
    per_cell = rake(cells, targets, tolerance).select(*names, expected.alias("expected"), "off_target")
    if count <= BROADCAST_CELLS:
        joined = rows.join(F.broadcast(per_cell), names, "left")
    else:
        joined = attach(rows, per_cell, names)
    joined = joined.withColumn(
        "expected", F.when(F.col("n_tokens") > 0, F.coalesce("expected", F.lit(0.0))).otherwise(0.0)
    )
    whole_part = F.floor("expected")
    copies = whole_part + (F.col("draw") < F.col("expected") - whole_part).cast("bigint")
    return joined.select("row", "n_tokens", *names, "expected", copies.alias("copies"), "off_target")
