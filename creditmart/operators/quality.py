"""Quality reports over the layer tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditmart.config import KEYS
from creditmart.functions.columns import quoted


def attribute_quality(clean: DataFrame, by: Sequence[str] = ("snapshot_date",)) -> DataFrame:
    return clean.groupBy(*by).agg(
        F.count("*").alias("rows"),
        F.count_if("age_invalid").alias("invalid_age"),
        F.count_if(F.col("Occupation").isNull()).alias("missing_occupation"),
    )


def financial_quality(clean: DataFrame, by: Sequence[str] = ("snapshot_date",)) -> DataFrame:
    """Counts of every flag; an unknown flag counts as not raised.

    Flag counts keep the flag's name with ``_rows``, so a grouped report can
    stand next to the flags themselves.
    """
    flags = [c for c in clean.columns if c.endswith("_invalid")]
    return clean.groupBy(*by).agg(
        F.count("*").alias("rows"),
        F.count_if("loan_count_suspicious").alias("suspicious_loan_counts"),
        F.count_if("loan_types_missing").alias("missing_loan_lists"),
        *[F.count_if(quoted(c)).alias(f"{c}_rows") for c in flags],
        F.count_if(F.col("snapshot_date").isNull()).alias("invalid_dates"),
    )


def duplicate_click_rows(raw: DataFrame, clean: DataFrame) -> DataFrame:
    """Click rows read, kept, and removed as duplicates."""
    counted = raw.agg(F.count("*").alias("input_rows")).withColumn("output_rows", F.lit(None).cast("long"))
    kept = clean.agg(F.count("*").alias("output_rows")).withColumn("input_rows", F.lit(None).cast("long"))
    return (
        counted.unionByName(kept)
        .agg(F.max("input_rows").alias("input_rows"), F.max("output_rows").alias("output_rows"))
        .withColumn("duplicates_removed", F.col("input_rows") - F.col("output_rows"))
    )


def loan_summary(loans: DataFrame) -> DataFrame:
    """Rows, loans and the span of months on book.

    Counting rows per loan first keeps the distinct count a plain sum.
    """
    return (
        loans.groupBy("loan_id")
        .agg(F.count("*").alias("n"), F.min("mob").alias("first"), F.max("mob").alias("last"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
            F.count("loan_id").alias("loan_count"),
            F.min("first").alias("minimum_mob"),
            F.max("last").alias("maximum_mob"),
        )
    )


def table_overview(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Rows, customers, columns, date span and surplus rows per table and its keys.

    One scan per table: every row counts for its key and once more for its
    customer, both combined before the shuffle.
    """

    def overview(name: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
        by_key = F.col("_part") == 0
        named = [F.when(by_key, F.col(key)).alias(f"_key_{i}") for i, key in enumerate(keys)]
        cells = (
            df.withColumn("_part", F.explode(F.array(F.lit(0), F.lit(1))))
            .groupBy("_part", *named, F.when(~by_key, F.col("Customer_ID")).alias("_customer"))
            .agg(
                F.count("*").alias("n"),
                F.min("snapshot_date").alias("first"), F.max("snapshot_date").alias("last"),
            )
        )
        return cells.agg(
            F.lit(name).alias("table"),
            F.coalesce(F.sum(F.when(by_key, F.col("n"))), F.lit(0)).alias("rows"),
            F.count("_customer").alias("customers"),
            F.lit(len(df.columns)).alias("columns"),
            F.min("first").alias("first_date"), F.max("last").alias("last_date"),
            F.coalesce(F.sum(F.when(by_key, F.col("n") - 1)), F.lit(0)).alias("duplicate_key_rows"),
        )

    return reduce(
        DataFrame.unionByName, [overview(name, df, keys) for name, (df, keys) in tables.items()]
    )


def is_missing(df: DataFrame, column: str) -> Column:
    value = quoted(column)
    if dict(df.dtypes)[column] in ("double", "float"):
        return value.isNull() | F.isnan(value)
    return value.isNull()


def missing_percent(df: DataFrame, top: int | None = 10) -> DataFrame:
    """Share of missing rows per column, the highest first, ties by name."""
    shares = df.agg(*[
        F.avg(is_missing(df, c).cast("int")).alias(f"_{i}") for i, c in enumerate(df.columns)
    ])
    rows = F.array(*[
        F.struct(F.lit(c).alias("column"), (F.col(f"_{i}") * 100).alias("missing_pct"))
        for i, c in enumerate(df.columns)
    ])
    ranked = shares.select(F.inline(rows)).orderBy(F.desc("missing_pct"), "column")
    return ranked if top is None else ranked.limit(top)


def joined_audit(joined: DataFrame) -> DataFrame:
    """Rows, surplus rows per key, and rows each source is absent from."""
    absent = ["has_attributes", "has_financials", "has_clickstream"]
    cells = joined.groupBy(*KEYS).agg(
        F.count("*").alias("n"), *[F.count_if(F.col(c) == 0).alias(c) for c in absent]
    )
    total = {c: F.coalesce(F.sum(c), F.lit(0)) for c in ["n", *absent]}
    return cells.agg(
        total["n"].alias("feature_rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_customer_date_keys"),
        total["has_attributes"].alias("missing_attributes"),
        total["has_financials"].alias("missing_financials"),
        total["has_clickstream"].alias("without_clickstream"),
    )
