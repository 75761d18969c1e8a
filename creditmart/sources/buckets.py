"""Snapshot tables cut by a column, so that joins of stored tables move no rows.

Every snapshot of such a table has one file per bucket. Spark knows buckets of
catalog tables only, so a write goes through a table of the session's catalog
that is dropped again, and a scan through one that names exactly the
folders it reads, whichever runs wrote them. The files and the log stay the
table; the catalog entries hold nothing of their own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from creditmart.functions.columns import quoted
from creditmart.sources import log

BUCKET_BYTES = 128 << 20
FEWEST = 8


@dataclass(frozen=True)
class Buckets:
    """Rows go to one of ``count`` buckets by the hash of ``column``."""

    column: str
    count: int


def _name(text: str) -> str:
    return "`" + text.replace("`", "``") + "`"


def _text(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _table(kind: str, key: str) -> str:
    return f"spark_catalog.default.creditmart_{kind}_{hashlib.md5(key.encode()).hexdigest()}"


def count_for(stored_bytes: int) -> int:
    """Buckets for rows stored in so many bytes: a power of two, about ``BUCKET_BYTES`` each."""
    count = FEWEST
    while count * BUCKET_BYTES < stored_bytes:
        count *= 2
    return count


def write(rows: DataFrame, path: str, run: str, by: str, buckets: Buckets) -> None:
    """Write the folder of a run; one shuffle, by the column the joins use."""
    spark = rows.sparkSession
    place = log.Folder(spark, path).place(f"{log.RUN_COLUMN}={run}")
    table = _table("write", place)
    (
        rows.repartition(buckets.count, quoted(buckets.column))
        .write.format("parquet").option("path", place)
        .partitionBy(by).bucketBy(buckets.count, buckets.column).saveAsTable(table)
    )
    spark.sql(f"DROP TABLE {table}")


def readable(state: log.State, folders: Mapping[str, str]) -> Buckets | None:
    """The buckets that all folders share; none if they differ, or rows have no snapshot."""
    found = {state.buckets.get(log.run_of(folder)) for folder in folders.values()}
    if len(found) != 1 or "__HIVE_DEFAULT_PARTITION__" in folders:
        return None
    shared = found.pop()
    return Buckets(*shared) if shared else None


def read(spark: SparkSession, path: str, state: log.State, folders: Mapping[str, str], buckets: Buckets) -> DataFrame:
    """Folders by snapshot as one bucketed scan."""
    root = log.Folder(spark, path)
    columns = ", ".join(f"{_name(f.name)} {f.dataType.simpleString()}" for f in state.columns)
    parts = " ".join(
        f"PARTITION ({_name(state.by)} = {_text(value)}) LOCATION {_text(root.place(folder))}"
        for value, folder in sorted(folders.items())
    )
    table = _table("read", f"{root.place('')} {columns} {parts} {buckets}")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet PARTITIONED BY ({_name(state.by)}) "
        f"CLUSTERED BY ({_name(buckets.column)}) INTO {buckets.count} BUCKETS LOCATION {_text(root.place(''))}"
    )
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {parts}")
    return spark.table(table).select(*[
        quoted(f.name).alias(f.name, metadata=f.metadata) if f.metadata else quoted(f.name) for f in state.columns
    ])


def forget(spark: SparkSession) -> Sequence[str]:
    """Drop the catalog entries of scans; the files stay. No plan made from them may still wait to run."""
    names = [
        t.name for t in spark.catalog.listTables("spark_catalog.default") if t.name.startswith("creditmart_read_")
    ]
    for name in names:
        spark.sql(f"DROP TABLE spark_catalog.default.{name}")
    return names
