"""Raw CSV files to encoded sets, and a second run over one snapshot."""

import pytest
from pyspark.sql import functions as F

from checks import views
from creditmart.operators import features, quality
from creditmart.plans import backfill, prepare
from creditmart.session import scratch_path
from creditmart.sources import spine, tables

SF = "/root/testdata/sf0.001"
SPINE = spine.month_starts("2024-01-01", "2024-04-01")


@pytest.fixture(scope="module")
def mart(spark):
    root = scratch_path(spark, "mart")
    loans = view_of(spark, "loans_raw").withColumns({
        # Every loan starts in January 2024 and is observed in the months after.
        "loan_start_date": F.lit("2024-01-01"),
        "snapshot_date": F.expr("CAST(add_months(DATE'2024-01-01', CAST(CAST(installment_num AS DOUBLE) AS INT) % 4) AS STRING)"),
    })
    sources = {
        "lms": loans, "fe_attr": view_of(spark, "delivered"),
        "fe_fin": view_of(spark, "financials_raw"), "fe_click": view_of(spark, "clicks_raw"),
    }
    paths = {}
    for name, df in sources.items():
        paths[name] = f"{root}/source/{name}"
        tables.write_csv(df, paths[name])
    return backfill.backfill(spark, paths, f"{root}/mart", SPINE, mob=2), paths


def view_of(spark, name):
    return views.view(spark, SF, name)


def test_layers(spark, mart):
    layout, _ = mart
    joined = tables.read_snapshots(spark, layout.gold("joined_features"))
    audit = quality.joined_audit(joined).first()
    assert audit.feature_rows > 0 and audit.duplicate_customer_date_keys == 0
    assert audit.missing_attributes > 0 and audit.missing_financials > 0
    assert "Name" not in tables.read_snapshots(spark, layout.silver("fe_attr")).columns
    labels = tables.read_snapshots(spark, layout.gold("label_store"))
    assert labels.select("label_def").distinct().collect()[0][0] == "30dpd_2mob"
    # Two keys, 5 attribute, 42 financial and 22 click columns, and one per loan type seen.
    silver = tables.read_snapshots(spark, layout.silver("fe_fin"))
    loan_types = features.vocabulary_list(features.loan_vocabulary(silver))
    assert len(loan_types) == 9 and len(joined.columns) == 71 + len(loan_types)
    for dataset in ("lms", "fe_attr", "fe_fin", "fe_click"):
        dates = {r[0] for r in tables.read_snapshots(spark, layout.silver(dataset)).select("snapshot_date").distinct().collect()}
        assert dates <= set(SPINE)


def test_dates_without_rows(spark, mart):
    """No click history lies before the first cutoff, yet its snapshot can be read."""
    layout, _ = mart
    history = tables.read_snapshots(spark, layout.gold("fe_click"), ["2024-01-01"])
    assert history.count() == 0 and "fe_1_mean" in history.columns


def test_second_run_changes_nothing(spark, mart):
    layout, paths = mart
    before = tables.read_snapshots(spark, layout.gold("joined_features"))
    rows = sorted(map(repr, before.collect()))
    backfill.backfill(spark, paths, layout.root, ["2024-02-01"], mob=2)
    again = tables.read_snapshots(spark, layout.gold("joined_features"))
    assert sorted(map(repr, again.select(before.columns).collect())) == rows


def test_sets_from_the_mart(spark, mart):
    layout, _ = mart
    labels = tables.read_snapshots(spark, layout.gold("label_store"))
    joined = tables.read_snapshots(spark, layout.gold("joined_features"))
    # Start dates spread over the spine, so that there is an out-of-time set.
    spread = labels.withColumn("loan_start_date", F.expr("add_months(DATE'2024-01-01', CAST(CAST(loan_id AS INT) % 4 AS INT))"))
    path = f"{layout.root}/spread"
    tables.write_snapshots(spread, path)
    prepared = prepare.prepare_tables(spark, layout.gold("joined_features"), path, f"{layout.root}/model")
    assert prepared.plan.sizes["train"] > 0
    test = prepare.load_set(spark, f"{layout.root}/model", "test")
    assert test.count() == prepared.plan.sizes["test"]
    assert joined.count() > 0

    # Two labels only, one of each set kind: the sets of the first run must not stay.
    few = spread.filter("loan_start_date > DATE'2024-03-01'").withColumn(
        "loan_start_date", F.expr("CASE WHEN CAST(loan_id AS INT) % 8 = 3 THEN DATE'2024-04-01' ELSE DATE'2024-03-01' END")
    )
    tables.write_table(few, f"{layout.root}/few")
    again = prepare.prepare_tables(spark, layout.gold("joined_features"), f"{layout.root}/few", f"{layout.root}/model")
    for name in ("train", "test"):
        assert prepare.load_set(spark, f"{layout.root}/model", name).count() == again.plan.sizes[name]


def test_a_set_without_rows_is_empty(spark):
    path = scratch_path(spark, "sets")
    rows = spark.createDataFrame([(1, "train"), (2, "oot")], "k int, split string")
    tables.write_snapshots(rows, path, by="split", values=prepare.SETS)
    tables.write_snapshots(rows.filter("k = 1"), path, by="split", values=prepare.SETS)
    assert [r.k for r in tables.read_snapshots(spark, path).collect()] == [1]
    assert tables.read_snapshots(spark, path, values=["oot"]).count() == 0


def test_few_row_groups_are_dealt_to_all_cores(spark):
    """The rules on wide rows made of a small file run in more than one task."""
    rows = view_of(spark, "financials_raw")
    assert rows.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    customers = spark.read.parquet(f"{SF}/customer.parquet")
    assert rows.count() == customers.count() + customers.filter("c_custkey % 3 = 0").count()


def test_join_without_wide_shuffles_in_any_session(spark, mart, monkeypatch):
    """The backfill makes the settings its joins rely on, and gives the session's own back."""
    _, paths = mart
    key, plans = "spark.sql.requireAllClusterKeysForCoPartition", []
    plain = backfill.assemble.features

    def joined(*parts):
        found = plain(*parts)
        plans.append(found._jdf.queryExecution().executedPlan().toString())
        return found

    monkeypatch.setattr(backfill.assemble, "features", joined)
    kept = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        backfill.backfill(spark, paths, scratch_path(spark, "other_session"), ["2024-02-01"], mob=2)
        assert spark.conf.get(key) == "true"
    finally:
        spark.conf.set(key, kept)
    # Only the keys of the two feature tables are exchanged.
    assert plans[0].count("Exchange hashpartitioning") == 2


def test_silver_is_written_where_bronze_lies(spark, mart, monkeypatch):
    layout, _ = mart
    again = backfill.Layout(scratch_path(spark, "silver_again"))
    monkeypatch.setattr(backfill, "DATASETS", ["fe_attr", "fe_fin", "lms"])
    monkeypatch.setattr(backfill.Layout, "bronze", lambda _, dataset: f"{layout.root}/bronze/{dataset}")
    context, group = spark.sparkContext, "silver again"
    context.setJobGroup(group, group)
    try:
        backfill.run_silver(spark, again, SPINE)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    status = context.statusTracker()
    stages = [len(status.getJobInfo(job).stageIds) for job in status.getJobIdsForGroup(group)]
    assert stages == [1, 1, 1]
    for dataset in backfill.DATASETS:
        new, old = (tables.read_snapshots(spark, lay.silver(dataset)) for lay in (again, layout))
        assert new.exceptAll(old).isEmpty() and old.exceptAll(new).isEmpty()


def test_two_runs_are_compared_by_short_keys(spark):
    """No whole row is shuffled to find it in the other run's table."""
    from checks import queries

    found = queries.backfill_two_runs_equal_one(spark, SF)
    assert "sha2(" in found._jdf.queryExecution().optimizedPlan().toString()
    for row in found.collect():
        assert row.one_run == row.two_runs == row.alike > 0
