"""Raw files: text scans, ad-hoc SQL over files, and snapshot selection."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditmart.sources.spine import as_dates

# Partition column of the raw layer; the source's own date text is kept beside it.
SNAPSHOT_PARTITION = "snapshot"


def read_text_columns(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """CSV with a header line, every column a string. No inference pass."""
    return spark.read.option("header", True).csv(path)


def read_inferred(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """CSV with a header line and types inferred from the whole file.

    Costs one more scan; meant for ad-hoc looks at a source, not for the layers.
    """
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def sql_over_files(
    spark: SparkSession, query: str, paths: Mapping[str, str], infer: bool = True
) -> DataFrame:
    """Run a SQL text over CSV files; ``{name}`` in the text stands for a file."""
    reader = read_inferred if infer else read_text_columns
    return spark.sql(query, **{name: reader(spark, path) for name, path in paths.items()})


def select_snapshots(raw: DataFrame, spine: Iterable[str | date]) -> DataFrame:
    """Rows whose date is exactly a spine date, for all spine dates in one scan.

    The letter ``x`` is a known stray character in the date text. A row counts
    only at midnight of a spine date, so other days of the month fall out.
    """
    text = F.replace(F.col("snapshot_date"), F.lit("x"), F.lit(""))
    moment = text.try_cast("timestamp")
    day = moment.cast("date")
    return (
        raw.withColumns({"snapshot_date": text, SNAPSHOT_PARTITION: day})
        .filter((moment == day.cast("timestamp")) & day.isin(as_dates(spine)))
    )
