"""Layer tables: one Parquet table per dataset, one partition per snapshot."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from creditmart.functions.columns import quoted
from creditmart.sources import buckets as bucketing
from creditmart.sources import log
from creditmart.sources.spine import as_dates

# Key of a column's metadata: what the column is in snapshots older than itself.
ABSENT = "absent"

# The writer would otherwise trim blanks, which the cleaning rules want to see.
CSV_OPTIONS = {
    "header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False
}


def write_snapshots(
    df: DataFrame,
    path: str,
    by: str = "snapshot_date",
    fmt: str = "parquet",
    dates: Iterable[str | date] = (),
    values: Iterable[str] = (),
    note: dict | None = None,
    buckets: bucketing.Buckets | None = None,
    rebalance: bool = True,
) -> None:
    """Replace the snapshots present in ``df``, all of them at once; every other snapshot stays.

    The files are written below a folder of their own and become visible by one
    entry of the table's log, so a run that fails leaves the table as it was.
    The rebalance hint lets adaptive execution cut each snapshot into files of
    the advisory size: no task holds a whole month, and no task leaves one small
    file per month. Rows scanned from snapshots so written need no ``rebalance`` and no shuffle: they
    become as many files as the scan has splits at most. A snapshot listed in ``dates`` (or, for another column, in
    ``values``) that has no rows becomes an empty one, so that every date of a run
    can be read and a second run leaves nothing of the first behind. Columns are
    matched by name; a column of another type than before is refused unless no older
    snapshot stays. ``note`` is kept in the log with the run.

    With ``buckets`` every snapshot is cut by a column (Parquet only) in place of
    the hint, and joins by it of tables with equally many buckets move no stored rows.
    """
    spark = df.sparkSession
    asked = {str(value) for value in [*as_dates(dates), *values]}
    run = log.new_run()

    def columns(before: log.State | None, replaced: set[str]) -> StructType:
        stays = before is not None and bool(set(before.folders) - replaced)
        known = before.columns if stays else StructType()
        if stays and fmt == "csv" and sorted(known.names) != sorted(df.columns):
            raise ValueError(f"{path}: all snapshots written as CSV need the same columns")
        return log.all_columns(known, df.schema, by)

    rows = df
    before = log.latest(spark, path)
    if before is not None:
        # What is known to clash is refused before anything is written.
        ordered = columns(before, asked).names
        rows = df.select(*[quoted(name) for name in ordered if name in df.columns])
    if buckets is not None and fmt == "parquet":
        bucketing.write(rows, path, run, by, buckets)
    else:
        (
            (rows.hint("rebalance", F.col(by)) if rebalance else rows)
            .write.partitionBy(by).options(**(CSV_OPTIONS if fmt == "csv" else {}))
            .format(fmt).save(f"{path}/{log.RUN_COLUMN}={run}")
        )
    written = log.staged(spark, path, run)

    def change(before: log.State | None) -> log.State:
        folders = dict.fromkeys(asked) | written
        kept = before.folders if before else {}
        notes = dict(before.notes) if before else {}
        if note is not None:
            notes[run] = note
        cut = dict(before.buckets) if before else {}
        if buckets is not None and fmt == "parquet":
            cut[run] = (buckets.column, buckets.count)
        return log.State(0, by, fmt, columns(before, set(folders)), {**kept, **folders}, notes, cut)

    log.commit(spark, path, change)


def absent_as(column: Column, name: str, value: int, unless: str) -> Column:
    """A column that older snapshots may lack: there it is ``value``, null where ``unless`` is not false."""
    return column.alias(name, metadata={ABSENT: {"value": value, "unless": unless}})


def _filled(table: DataFrame) -> DataFrame:
    """Give columns what they are in snapshots older than themselves."""
    filled = {}
    for f in table.schema:
        rule = f.metadata.get(ABSENT)
        if rule and rule["unless"] in table.columns:
            value = F.when(~F.col(rule["unless"]), F.coalesce(quoted(f.name), F.lit(rule["value"]).cast(f.dataType)))
            filled[f.name] = value.otherwise(quoted(f.name)).alias(f.name, metadata=f.metadata)
    return table.withColumns(filled) if filled else table


def read_snapshots(
    spark: SparkSession,
    path: str,
    dates: Iterable[str | date] | None = None,
    values: Iterable[str] | None = None,
    by: str = "snapshot_date",
) -> DataFrame:
    """Scan a layer table; only the folders of ``dates`` (or ``values``) are touched, default is all.

    The columns are those of all snapshots, also of those not read; one that is
    younger than a snapshot is null there, or what it was declared to be by
    :func:`absent_as`. Snapshots cut into the same buckets are scanned by them, also
    if several runs wrote them. A table without a log is read as it lies.
    """
    asked = None if dates is None and values is None else {str(v) for v in [*as_dates(dates or ()), *(values or ())]}
    state = log.latest(spark, path)
    if state is None:
        table = spark.read.parquet(path)
        return table if asked is None else table.filter(F.col(by).cast("string").isin(sorted(asked)))
    folders = {value: place for value, place in state.folders.items() if place and (asked is None or value in asked)}
    shared = bucketing.readable(state, folders)
    if shared is not None:
        return _filled(bucketing.read(spark, path, state, folders, shared))
    return read_folders(spark, path, state, [place for _, place in sorted(folders.items())])


def read_folders(spark: SparkSession, path: str, state: log.State, folders: Sequence[str]) -> DataFrame:
    """Folders of a table, also such as no longer count."""
    if not folders:
        return _filled(spark.createDataFrame([], state.columns))
    table = (
        spark.read.schema(StructType([*state.columns, StructField(log.RUN_COLUMN, StringType())]))
        .option("basePath", path).options(**(CSV_OPTIONS if state.fmt == "csv" else {}))
        .format(state.fmt).load([f"{path}/{folder}" for folder in folders])
    )
    return _filled(table.drop(log.RUN_COLUMN))


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def between_dates(
    df: DataFrame,
    start: str | date | None = None,
    end: str | date | None = None,
    by: str = "snapshot_date",
) -> DataFrame:
    """Optional closed date window over any table."""
    if start is not None:
        df = df.filter(F.col(by) >= F.lit(start).cast("date"))
    if end is not None:
        df = df.filter(F.col(by) <= F.lit(end).cast("date"))
    return df
