"""Joining the feature tables, and the guard that runs before it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmart.config import KEYS


def key_counts(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """One row: rows with a null key, keys held by several rows, surplus rows.

    One pass over the key columns only, combined before the shuffle.
    """
    null_key = reduce(lambda a, b: a | b, [F.col(key).isNull() for key in keys])
    return (
        df.groupBy(*keys).agg(F.count("*").alias("_n"))
        .agg(
            F.coalesce(F.sum(F.when(null_key, F.col("_n"))), F.lit(0)).alias("null_key_rows"),
            F.count_if(F.col("_n") > 1).alias("duplicate_keys"),
            F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_key_rows"),
        )
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """The keys held by more than one row, with their row counts."""
    return df.groupBy(*keys).count().filter(F.col("count") > 1)


def all_key_counts(tables: Mapping[str, DataFrame], keys: Sequence[str] = KEYS) -> DataFrame:
    """The counts of several tables, one row each, as one job."""
    return reduce(DataFrame.unionByName, [
        key_counts(df, keys).select(F.lit(name).alias("table"), "*") for name, df in tables.items()
    ])


def assert_unique_keys(tables: Mapping[str, DataFrame], keys: Sequence[str] = KEYS) -> None:
    """Raise if any table has a key with a null part or more than one row; one job for all tables."""
    for row in all_key_counts(tables, keys).collect():
        if row.null_key_rows:
            raise ValueError(f"{row.table}: {row.null_key_rows} rows with null join keys in {list(keys)}")
        if row.duplicate_keys:
            raise ValueError(f"{row.table}: {row.duplicate_keys} duplicate join keys in {list(keys)}")


def features(attr: DataFrame, fin: DataFrame, click: DataFrame) -> DataFrame:
    """Attributes, financials and click history side by side, for every key of the first two.

    All keys of attributes and financials are collected first and the tables
    joined onto them from the left. An outer join of the two loses its
    partitioning and would shuffle the wide joined rows again for the click join; here
    only the narrow keys are shuffled twice, each table once, and not at all if the three
    are stored in equally many buckets by customer. Null and repeated keys are refused.
    """
    assert_unique_keys({"attributes": attr, "financials": fin, "clickstream": click})
    known = attr.select(*KEYS).join(fin.select(*KEYS), KEYS, "full")
    return (
        known.join(attr.withColumn("has_attributes", F.lit(1)), KEYS, "left")
        .join(fin.withColumn("has_financials", F.lit(1)), KEYS, "left")
        .join(click, KEYS, "left")
        .fillna(0, ["has_attributes", "has_financials", "has_clickstream", "clickstream_days"])
    )


def labelled_features(labels: DataFrame, feature_rows: DataFrame) -> DataFrame:
    """Loans with the features of exactly their start date; others drop out.

    The label is observed later, so its date is kept under another name.
    """
    loans = labels.withColumnRenamed("snapshot_date", "label_snapshot_date").withColumn(
        "feature_snapshot_date", F.col("loan_start_date")
    )
    dated = feature_rows.withColumnRenamed("snapshot_date", "feature_snapshot_date")
    return loans.join(dated, ["Customer_ID", "feature_snapshot_date"], "inner")
