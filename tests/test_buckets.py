"""Tables stored in buckets: same rows, no exchange of stored rows in joins."""

import re

import pytest
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from creditmart.operators import assemble
from creditmart.session import scratch_path
from creditmart.sources import buckets, log, tables
from creditmart.sources.buckets import Buckets

MONTHS = ["2024-01-01", "2024-02-01", "2024-03-01"]


def rows(spark, column, months=MONTHS, step=1):
    """Every ``step``-th of 300 customers in each month."""
    dates = spark.createDataFrame([(m,) for m in months], "d string")
    return spark.range(0, 300, step).crossJoin(dates).select(
        F.concat(F.lit("C"), "id").alias("Customer_ID"), (F.col("id") * F.month(F.to_date("d"))).alias(column),
        F.to_date("d").alias("snapshot_date"),
    )


def parts(spark):
    clicks = rows(spark, "clicks", step=3).withColumns({"has_clickstream": F.lit(1), "clickstream_days": F.lit(2)})
    return {"attr": rows(spark, "age", step=2), "fin": rows(spark, "income", step=5), "click": clicks}


def stored(spark, count=8):
    """Each part written by two runs."""
    found = []
    for name, table in parts(spark).items():
        path = scratch_path(spark, name)
        first = F.col("snapshot_date") == MONTHS[0]
        cut = Buckets("Customer_ID", count)
        tables.write_snapshots(table.filter(first), path, buckets=cut)
        tables.write_snapshots(table.filter(~first), path, dates=MONTHS[1:], buckets=cut)
        found.append(tables.read_snapshots(spark, path))
    return found


@pytest.fixture
def unhurried(spark):
    """Joins of small tables go the way of large ones."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def exchanged(df):
    """The columns that go through each exchange of a plan that has not run yet."""
    explained = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    return re.findall(r"\) Exchange\nInput \[\d+\]: \[([^\]]*)\]", explained)


def test_feature_join_exchanges_keys_only(spark, unhurried):
    joined, unstored = assemble.features(*stored(spark)), assemble.features(*parts(spark).values())
    keys_only = [set(re.sub(r"#\d+", "", columns).split(", ")) for columns in exchanged(joined)]
    assert keys_only == [{"Customer_ID", "snapshot_date"}]
    assert any("income" in columns for columns in exchanged(unstored))
    assertDataFrameEqual(joined, unstored)


def test_labelled_join_exchanges_nothing(spark, unhurried):
    cut = Buckets("Customer_ID", 8)
    labels = rows(spark, "label", step=7).withColumn("loan_start_date", F.col("snapshot_date"))
    path = scratch_path(spark, "labels")
    tables.write_snapshots(labels, path, buckets=cut)
    wide = scratch_path(spark, "joined")
    tables.write_snapshots(rows(spark, "income"), wide, buckets=cut)
    loans, features = tables.read_snapshots(spark, path), tables.read_snapshots(spark, wide)
    found = assemble.labelled_features(loans, features)
    assert exchanged(found) == []
    assert found.count() == labels.count()


def test_one_snapshot_is_one_folder(spark):
    attr, _, _ = stored(spark)
    path = scratch_path(spark, "one")
    tables.write_snapshots(attr, path, buckets=Buckets("Customer_ID", 8))
    one = tables.read_snapshots(spark, path, [MONTHS[1]])
    assert one.count() == 150
    assert all(f"snapshot_date={MONTHS[1]}" in file for file in one.inputFiles())
    assert len(one.inputFiles()) <= 8


def test_different_buckets_are_read_as_files(spark):
    path = scratch_path(spark, "mixed")
    for month, count in zip(MONTHS, (8, 16, None), strict=True):
        cut = Buckets("Customer_ID", count) if count else None
        tables.write_snapshots(rows(spark, "age", [month]), path, buckets=cut)
    assert buckets.readable(log.latest(spark, path), log.latest(spark, path).folders) is None
    assertDataFrameEqual(tables.read_snapshots(spark, path), rows(spark, "age"))


def test_odd_rows(spark):
    """Null customers, no rows, rows without a snapshot, odd names, younger columns, replaced snapshots."""
    cut, path = Buckets("Customer_ID", 8), scratch_path(spark, "it's odd")
    odd = rows(spark, "a `b`.c", MONTHS[:1]).unionByName(
        spark.createDataFrame([(None, 1, None), (None, 1, None)], "Customer_ID string, `a ``b``.c` long, d string")
        .select("Customer_ID", "`a ``b``.c`", F.lit(MONTHS[0]).cast("date").alias("snapshot_date"))
    )
    tables.write_snapshots(odd, path, buckets=cut)
    assertDataFrameEqual(tables.read_snapshots(spark, path), odd)
    wider = rows(spark, "a `b`.c", MONTHS[1:2]).withColumn("new", F.lit("n"))
    tables.write_snapshots(wider, path, buckets=cut)
    assertDataFrameEqual(
        tables.read_snapshots(spark, path),
        odd.withColumn("new", F.lit(None).cast("string")).unionByName(wider).select("Customer_ID", "`a ``b``.c`", "new", "snapshot_date"),
    )
    tables.write_snapshots(wider.limit(0), path, dates=MONTHS[:2], buckets=cut)
    assert tables.read_snapshots(spark, path).count() == 0
    undated = wider.withColumn("snapshot_date", F.lit(None).cast("date"))
    tables.write_snapshots(undated, path, buckets=cut)
    assert tables.read_snapshots(spark, path).count() == 300


def test_count_for():
    assert [buckets.count_for(n) for n in (0, 1 << 30, (1 << 30) + 1, 1 << 40)] == [8, 8, 16, 8192]


def test_forget(spark):
    stored(spark)
    assert buckets.forget(spark)
    assert not buckets.forget(spark)
