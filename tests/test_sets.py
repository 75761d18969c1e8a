"""Split and preprocessing."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from creditmart.functions.columns import quoted
from creditmart.operators import preprocess, profile, split
from creditmart.plans import prepare
from creditmart.session import scratch_path
from creditmart.sources import tables

SCHEMA = (
    "loan_id string, Customer_ID string, loan_start_date date, label_snapshot_date date, label int, "
    "feature_snapshot_date date, label_def string, k string, v double, Age int, has_clickstream int, "
    "fe_1_mean double, sure boolean, unsure boolean"
)


def loan_rows(count=600, seed=1):
    chance = random.Random(seed)
    rows = []
    for i in range(count):
        start = dt.date(2023, 1 + i % 12, 1)
        active = chance.random() < 0.7
        rows.append((
            f"l{i}", f"c{i % 97}", start, start + dt.timedelta(days=180), int(chance.random() < 0.3), start, "d",
            chance.choice(["a", "b", "b.c", None]), chance.choice([None, 1.0, 2.0, 7.5, float("nan")]),
            chance.choice([None, *range(20, 60)]), int(active), chance.random() if active else None,
            chance.random() < 0.5, chance.choice([True, False, None]),
        ))
    return rows


@pytest.fixture(scope="module")
def loans(spark):
    return spark.createDataFrame(loan_rows(), SCHEMA).cache()


def test_quotas():
    assert split.class_quotas({0: 10069, 1: 4934}, 0.2) == {0: 2014, 1: 987}
    for zeros in range(5, 60):
        for ones in range(5, 20):
            quotas = split.class_quotas({0: zeros, 1: ones}, 0.2)
            assert sum(quotas.values()) == math.ceil(0.2 * (zeros + ones))
            assert all(abs(quotas[c] - n * sum(quotas.values()) / (zeros + ones)) < 1 for c, n in ((0, zeros), (1, ones)))
    with pytest.raises(ValueError):
        split.class_quotas({0: 10, 1: 1}, 0.2)
    with pytest.raises(ValueError):
        split.class_quotas({}, 0.2)
    with pytest.raises(ValueError):
        split.class_quotas({0: 2, 1: 2}, 0.2)


def test_split_is_a_partition(loans):
    plan = split.plan_split(loans)
    rows = split.assign_split(loans, plan).select("loan_id", "loan_start_date", "label", "split").collect()
    assert len(rows) == len({r.loan_id for r in rows}) == 600
    dates = sorted({r.loan_start_date for r in rows})
    assert plan.cutoff == dates[-math.ceil(len(dates) * 0.2)]
    assert all((r.loan_start_date >= plan.cutoff) == (r.split == "oot") for r in rows)
    earlier = [r for r in rows if r.split != "oot"]
    quotas = split.class_quotas({c: sum(r.label == c for r in earlier) for c in (0, 1)}, 0.2)
    assert {c: sum(r.split == "test" and r.label == c for r in earlier) for c in (0, 1)} == quotas
    assert sum(r.split == "test" for r in rows) == plan.sizes["test"]
    assert sum(r.split == "train" for r in rows) == plan.sizes["train"]


def test_split_does_not_depend_on_partitioning(loans):
    def members(df):
        assigned = split.assign_split(df, split.plan_split(df))
        return {r.loan_id for r in assigned.filter("split = 'test'").collect()}

    assert members(loans) == members(loans.repartition(7))
    assert split.plan_split(loans, seed=1).boundaries != split.plan_split(loans).boundaries


def test_split_of_copies_is_exact(spark):
    """One loan outcome holding most rows is shared out, not put on one side."""
    rows = loan_rows(60) + [loan_rows(1, 9)[0]] * 30_000
    table = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assigned = split.assign_split(table, split.plan_split(table))
    counts = {tuple(r[:2]): r[2] for r in assigned.groupBy("split", "label").count().collect()}
    earlier = {c: counts.get(("train", c), 0) + counts.get(("test", c), 0) for c in (0, 1)}
    assert {c: counts.get(("test", c), 0) for c in (0, 1)} == split.class_quotas(earlier, 0.2)
    assert sum(counts.values()) == len(rows)


def test_oot_dates(loans):
    dates = sorted(r.loan_start_date for r in split.oot_dates(loans).collect())
    assert dates == [dt.date(2023, m, 1) for m in (10, 11, 12)]


def test_fill_and_scale_by_hand(spark):
    rows = [("a", 1.0), ("b", None), (None, 3.0), ("a", 3.0)]
    train = spark.createDataFrame(rows, "k string, v double")
    fields = preprocess.fit(train, preprocess.column_kinds(train, ["k", "v"]))
    value = fields[0]
    assert (value.fill, value.mean) == (3.0, 2.5) and value.scale == pytest.approx(0.8660254)
    assert [f.out_col for f in fields] == ["v", "k_a", "k_b"]
    coded = preprocess.transform(train, fields).collect()
    assert [tuple(r)[1:] for r in coded] == [(1, 0), (0, 1), (0, 0), (1, 0)]
    new = preprocess.transform(spark.createDataFrame([("c", None)], train.schema), fields).first()
    assert (new.k_a, new.k_b) == (0, 0) and new.v == pytest.approx(0.5 / 0.8660254)


def test_constant_and_empty_columns(spark):
    train = spark.createDataFrame([(0.1, None, 3)] * 7, "same double, empty double, Age int")
    fields = {f.source_col: f for f in preprocess.fit(train, preprocess.column_kinds(train, train.columns))}
    assert fields["same"].scale == 1.0 and fields["Age"].scale == 1.0
    coded = preprocess.transform(train, list(fields.values())).first()
    assert coded.same == pytest.approx(0) and coded.empty is None and coded.Age == 0


def test_infinite_values_are_refused(spark):
    train = spark.createDataFrame([(float("inf"),), (1.0,)], "x double")
    with pytest.raises(ValueError, match="infinite"):
        preprocess.fit(train, {"x": "numeric"})


def test_prepared_sets(spark, loans):
    prepared = prepare.prepare(loans)
    fields = {f.out_col: f for f in prepared.fields}
    assert [f.out_col for f in prepared.fields] == [
        "v", "Age", "has_clickstream", "fe_1_mean", "sure", "k_a", "k_b", "k_b.c", "unsure_False", "unsure_True",
    ]
    train = prepared.rows.filter("split = 'train'")
    pdf = train.toPandas()
    assert fields["v"].fill == pytest.approx(pdf.v.median())
    assert fields["Age"].fill == pytest.approx(pdf.Age.mean())
    assert fields["fe_1_mean"].fill == pytest.approx(pdf.fe_1_mean[pdf.has_clickstream == 1].mean())
    coded = prepared.encoded.filter("split = 'train'").toPandas()
    for c in ("v", "Age", "has_clickstream", "fe_1_mean"):
        assert coded[c].mean() == pytest.approx(0, abs=1e-9) and coded[c].std(ddof=0) == pytest.approx(1)
    assert dict(prepared.encoded.dtypes)["sure"] == "boolean"
    assert (coded["unsure_False"] + coded["unsure_True"]).sum() == pdf.unsure.notna().sum()


def test_bool_policy(loans):
    kinds = preprocess.column_kinds(loans, ["sure", "unsure"], "numeric")
    assert kinds == {"sure": "flag", "unsure": "flag"}


def test_parameters_come_from_train_only(spark, loans):
    plan = split.plan_split(loans)
    rows = split.assign_split(loans, plan)
    kinds = preprocess.column_kinds(loans, preprocess.feature_columns(loans))
    before = preprocess.fit(rows.filter("split = 'train'"), kinds)
    changed = rows.withColumn("v", F.when(F.col("split") != "train", 1e6).otherwise(F.col("v"))).withColumn(
        "k", F.when(F.col("split") != "train", "new").otherwise(F.col("k")))
    assert preprocess.fit(changed.filter("split = 'train'"), kinds) == before


def test_one_start_date_cannot_be_split(loans):
    with pytest.raises(ValueError, match="no rows are left"):
        split.plan_split(loans.filter("loan_start_date = DATE'2023-03-01'"))


def test_too_many_categories_are_refused(loans, monkeypatch):
    monkeypatch.setattr(preprocess, "MAX_COLUMNS", 2)
    with pytest.raises(ValueError, match=r"more than 2 categories.*'k'"):
        preprocess.train_categories(loans, ["k"])


def test_stored_sets_and_parameters(spark, loans):
    path = scratch_path(spark, "prepare")
    labels = loans.select(
        "loan_id", "Customer_ID", "loan_start_date", "label", "label_def",
        F.col("label_snapshot_date").alias("snapshot_date"))
    features = loans.select(
        "Customer_ID", F.col("feature_snapshot_date").alias("snapshot_date"), "k", "v", "Age",
        "has_clickstream", "fe_1_mean", "sure", "unsure").dropDuplicates(["Customer_ID", "snapshot_date"])
    tables.write_snapshots(labels, f"{path}/labels")
    tables.write_table(features, f"{path}/features")
    prepared = prepare.prepare_tables(spark, f"{path}/features", f"{path}/labels", path)
    stored = prepare.load_fields(spark, path)
    assert stored == prepared.fields
    sizes = {name: prepare.load_set(spark, path, name).count() for name in ("train", "test", "oot")}
    assert sum(sizes.values()) == 600 and sizes["train"] == prepared.plan.sizes["train"]
    test = prepare.load_set(spark, path, "test")
    source = prepared.rows.filter("split = 'test'").drop("split")
    again = prepare.encode_new_loans(spark, path, source)
    assert again.exceptAll(test.select(*[quoted(c) for c in again.columns])).count() == 0
    report = {r.split: r.rows for r in split.split_report(prepared.rows).collect()}
    assert report == sizes


def test_medians_of_an_accuracy(spark):
    rows = spark.createDataFrame([(float(i), float(i % 7)) for i in range(5000)], "v double, w double")
    exact, near = (preprocess.train_statistics(rows, ["v", "w"], accuracy) for accuracy in (None, 1000))
    assert exact["v"]["fill"] == 2499.5 and abs(near["v"]["fill"] - 2499.5) <= 15
    assert exact["w"]["fill"] == near["w"]["fill"] == 3.0
    described = profile.describe_numbers(rows, ["v"], accuracy=1000).first()
    assert abs(described.p25 - 1249.75) <= 15 and described["count"] == 5000
