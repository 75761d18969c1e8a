"""History, joins, quantiles, curves, reports and layers."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from creditmart import config
from creditmart.functions import quantiles
from creditmart.functions.quantiles import exact_quantiles
from creditmart.operators import assemble, history, loans, profile, quality
from creditmart.plans import gold_reports, raw_checks
from creditmart.session import scratch_path
from creditmart.sources import raw, tables

DAY = dt.date


def month(number):
    return DAY(2023, number, 1)


def test_history_by_hand(spark):
    rows = [("A", 2, month(1)), ("A", 4, month(1)), ("A", None, month(2)), ("B", 1, month(4))]
    clicks = spark.createDataFrame(rows, "Customer_ID string, fe_1 int, snapshot_date date")
    found = history.asof_history(clicks, [month(m) for m in (1, 2, 3, 4)]).orderBy("snapshot_date").collect()
    assert [(r.Customer_ID, r.snapshot_date, r.fe_1_mean, r.clickstream_days, r.has_clickstream) for r in found] == [
        ("A", month(2), 3.0, 1, 1), ("A", month(3), 3.0, 2, 1), ("A", month(4), 3.0, 2, 1),
    ]


@pytest.mark.parametrize("hot", [False, True])
def test_history_equals_one_pass_per_date(spark, hot):
    """Also when one customer has most of the rows."""
    chance = random.Random(7)
    rows = [
        ("hot" if hot and i % 3 else f"c{chance.randrange(20)}",
         chance.choice([None, *range(50)]), chance.choice([None, 5]), DAY(2023, 1, 1) + dt.timedelta(days=chance.randrange(200)))
        for i in range(3000)
    ]
    clicks = spark.createDataFrame(rows, "Customer_ID string, fe_1 int, fe_2 int, snapshot_date date")
    cutoffs = [DAY(2022, 12, 1), month(2), DAY(2023, 2, 14), month(5), month(6), DAY(2024, 1, 1)]
    found = {tuple(r) for r in history.asof_history(clicks, cutoffs).select(
        "Customer_ID", "snapshot_date", F.round("fe_1_mean", 9), F.round("fe_2_mean", 9), "clickstream_days").collect()}
    expected = set()
    for cutoff in cutoffs:
        before = clicks.filter(F.col("snapshot_date") < F.lit(cutoff)).groupBy("Customer_ID").agg(
            F.round(F.avg("fe_1"), 9), F.round(F.avg("fe_2"), 9), F.countDistinct("snapshot_date"))
        expected |= {(r[0], cutoff, r[1], r[2], r[3]) for r in before.collect()}
    assert found == expected


def tables_to_join(spark):
    attr = spark.createDataFrame([("A", month(1), 30), ("B", month(1), 40)], "Customer_ID string, snapshot_date date, Age int")
    fin = spark.createDataFrame([("A", month(1), True), ("C", month(1), None)], "Customer_ID string, snapshot_date date, flag boolean")
    click = spark.createDataFrame(
        [("A", month(1), 1.5, 3, 1), ("Z", month(1), 2.5, 1, 1)],
        "Customer_ID string, snapshot_date date, fe_1_mean double, clickstream_days long, has_clickstream int",
    )
    return attr, fin, click


def test_joined_features(spark):
    joined = assemble.features(*tables_to_join(spark)).orderBy("Customer_ID")
    assert [tuple(r) for r in joined.collect()] == [
        ("A", month(1), 30, 1, True, 1, 1.5, 3, 1),
        ("B", month(1), 40, 1, None, 0, None, 0, 0),
        ("C", month(1), None, 0, None, 1, None, 0, 0),
    ]
    audit = quality.joined_audit(joined).first()
    assert tuple(audit) == (3, 0, 1, 1, 2)


@pytest.mark.parametrize("bad, message", [
    (("A", month(1), 31), "duplicate join keys"), ((None, month(1), 31), "null join keys"), (("A", None, 1), "null join keys"),
])
def test_guard(spark, bad, message):
    attr, fin, click = tables_to_join(spark)
    attr = attr.union(spark.createDataFrame([bad], attr.schema))
    with pytest.raises(ValueError, match=f"attributes.*{message}"):
        assemble.features(attr, fin, click)


def test_key_counts(spark):
    rows = spark.createDataFrame([("A", month(1))] * 3 + [(None, month(1)), ("B", month(2))], "Customer_ID string, snapshot_date date")
    assert tuple(assemble.key_counts(rows).first()) == (1, 1, 2)
    assert [tuple(r) for r in assemble.duplicate_keys(rows).collect()] == [("A", month(1), 3)]


@pytest.mark.parametrize("kind", ["wide", "hot value", "two values", "extreme", "few"])
def test_exact_quantiles(spark, kind):
    """The narrowing passes agree with the built-in percentile."""
    chance = random.Random(3)
    make = {
        "wide": lambda: chance.gauss(0, 1) * 10 ** chance.randrange(8),
        "hot value": lambda: 5.0 if chance.random() < 0.6 else chance.random() * 10,
        "two values": lambda: chance.choice([0.0, 1.0]),
        "extreme": lambda: chance.choice([-1.7e308, 1.7e308, chance.random(), float("nan"), None]),
        "few": lambda: chance.random(),
    }[kind]
    rows = [(chance.choice(["a", "a", "a", "b", None]), make(), None) for _ in range(5 if kind == "few" else 4000)]
    df = spark.createDataFrame(rows, "g string, v double, empty double")
    probabilities = [0.0, 0.01, 0.5, 0.77, 1.0]
    for keys in ([], ["g"]):
        plain = exact_quantiles(df, ["v", "empty"], probabilities, keys)
        narrowed = exact_quantiles(df, ["v", "empty"], probabilities, keys, one_task_rows=50, gather_rows=20)

        def rows_of(frame):
            return sorted(
                ([r[k] for k in keys], [f"{x:.10g}" for x in r.v] if r.v else None, r.empty) for r in frame.collect()
            ) if not keys else sorted(
                ((str(r.g), [f"{x:.10g}" for x in r.v] if r.v else None, r.empty) for r in frame.collect()), key=repr
            )

        assert rows_of(plain) == rows_of(narrowed)


def test_bad_by_month_equals_running_maximum(spark):
    chance = random.Random(5)
    rows = [(f"l{i % 40}", 1 + i // 40, chance.choice([0, 0, 0, 31, None])) for i in range(480)]
    table = spark.createDataFrame(rows, "loan_id string, mob int, dpd int")
    found = {(r.loan_id, r.mob): r.ever_bad_by_mob for r in loans.bad_by_month(table).collect()}
    for loan in {r[0] for r in rows}:
        bad = 0
        for _, mob, dpd in sorted((r for r in rows if r[0] == loan), key=lambda r: r[1]):
            bad = max(bad, int((dpd or 0) >= 30))
            if mob <= 10:
                assert found.pop((loan, mob)) == bad
    assert not found


def test_loan_count_comparison_per_key(spark):
    rows = [("A", "2", "X", "d1"), ("A", "3_", None, "d2"), ("B", "1", "X", "d1"), ("C", "x", None, "d1")]
    table = spark.createDataFrame(rows, "Customer_ID string, Num_of_Loan string, Type_of_Loan string, snapshot_date string")
    by_customer = raw_checks.loan_count_comparison(table).collect()
    assert [(r.Customer_ID, r.num_of_loan, r.count_difference) for r in by_customer] == [("A", 3, 2), ("A", 2, 1)]
    by_snapshot = raw_checks.loan_count_comparison(table, ["Customer_ID", "snapshot_date"]).collect()
    assert [(r.snapshot_date, r.count_difference) for r in by_snapshot] == [("d2", 3), ("d1", 1)]


def test_hot_key_is_split(spark):
    """A join on a key with most of the rows is split by adaptive execution."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    path = scratch_path(spark, "hot")
    spark.range(40_000).repartition(8).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("Customer_ID"),
        F.lit(month(1)).alias("snapshot_date"), (F.col("id") % 977 + 1.0).alias("Annual_Income"),
    ).write.parquet(path)
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        result = gold_reports.income_vs_customer_median(spark.read.parquet(path))
        assert result.count() == 40_000
        hot = result.filter("Customer_ID = 'hot'")
        medians = hot.agg(F.min("customer_median_income"), F.max("customer_median_income"), F.median("Annual_Income"))
        assert len(set(medians.first())) == 1
        executed = result._jdf.queryExecution()
        result.collect()
        assert "skew=true" in executed.executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_histogram_bins(spark):
    rows = spark.createDataFrame([(x,) for x in (0.0, 0.5, 1.0, 9.99, 10.0, 11.0, -1.0, None, float("nan"))], "v double")
    counts = [r.rows for r in profile.histogram(rows, F.col("v"), 10, 0, 10).collect()]
    assert counts == [2, 1, 0, 0, 0, 0, 0, 0, 0, 2]
    assert profile.histogram(rows.filter("v = 1"), F.col("v"), 4).agg(F.sum("rows")).first()[0] == 1
    assert profile.histogram(rows.filter("v > 99"), F.col("v"), 4).agg(F.sum("rows")).first()[0] == 0


def test_values_on_bin_edges(spark):
    """A value goes where the reported edges say, as 0.29 and 0.57 of a hundred bins do not by division."""
    rows = spark.createDataFrame([(i / 100,) for i in range(101)], "v double")
    found = profile.histogram(rows, F.col("v"), 100, 0, 1).collect()
    for r in found:
        inside = sum(r.bin_low <= i / 100 and (i / 100 < r.bin_high or r.bin == 99) for i in range(101))
        assert r.rows == inside


def test_quantiles_at_the_ends_of_doubles(spark):
    inf, most = float("inf"), 1.7976931348623157e308
    for values in ([1.0, 2.0, 3.0, inf], [most] * 3, [-inf, 1.0, 2.0, 5.0], [most, inf, inf], [0.0, -0.0, 5e-324, float("nan")]):
        df = spark.createDataFrame([(v,) for v in values], "v double")
        plain = exact_quantiles(df, ["v"], [0.1, 0.5, 0.9]).first().v
        narrow = exact_quantiles(df, ["v"], [0.1, 0.5, 0.9], one_task_rows=1, gather_rows=1).first().v
        assert [repr(x + 0.0) for x in plain] == [repr(x + 0.0) for x in narrow]


@pytest.mark.parametrize("kind", ["magnitudes", "two values", "one value", "close", "even"])
def test_two_passes_whatever_the_values(spark, monkeypatch, kind):
    chance, passes = random.Random(4), []
    make = {
        "magnitudes": lambda: 10 ** chance.uniform(-100, 100), "two values": lambda: chance.choice([1.0, 2.0]),
        "one value": lambda: 7.5, "close": lambda: 1e15 + chance.randrange(1000) / 8, "even": chance.random,
    }[kind]
    df = spark.createDataFrame([("ab"[i % 2], make()) for i in range(40_000)], "g string, v double").repartition(4)
    probabilities = [0.0, 0.1, 0.5, 0.999, 1.0]
    plain = quantiles._scan
    monkeypatch.setattr(quantiles, "_scan", lambda *a: (passes.append(1), plain(*a))[1])
    for keys in ([], ["g"]):
        passes.clear()
        found = exact_quantiles(df, ["v"], probabilities, keys, one_task_rows=10, gather_rows=2000).collect()
        assert len(passes) == 2
        whole = exact_quantiles(df, ["v"], probabilities, keys).collect()
        texts = [sorted([*r[:-1], *[f"{x:.12g}" for x in r.v]] for r in rows) for rows in (found, whole)]
        assert texts[0] == texts[1]


def test_a_description_reads_its_rows_twice(spark):
    """The pass for the moments also outlines the values; before, a description took four passes."""
    read, n = spark.sparkContext.accumulator(0), 30_000

    def row(i):
        read.add(1)
        return [float((i * 7919 + c) % (10 + i % 3 * 1000 * c)) for c in range(40)]

    columns = [f"c{c}" for c in range(40)]
    df = spark.createDataFrame(spark.sparkContext.parallelize(range(n), 4).map(row), ", ".join(f"{c} double" for c in columns))
    found = {r.column: r for r in profile.describe_numbers(df, columns).collect()}
    assert read.value == 2 * n
    wanted = df.agg(*[F.percentile(c, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias(c) for c in columns]).first()
    assert {c: [found[c].p25, found[c].p50, found[c].p75] for c in columns} == wanted.asDict()


def test_ranges_that_miss_their_rank(spark, monkeypatch):
    """Wrong brackets cost passes, not results; narrow limits are sketched again."""
    df = spark.createDataFrame([(float(i * 7919 % 20_000),) for i in range(20_000)], "v double")
    whole = exact_quantiles(df, ["v"], [0.25, 0.5]).first().v
    assert exact_quantiles(df, ["v"], [0.25, 0.5], one_task_rows=10, gather_rows=3).first().v == whole
    monkeypatch.setattr(quantiles, "SLACK", -30.0)
    for limit in (3, 10_000):
        assert exact_quantiles(df, ["v"], [0.25, 0.5], one_task_rows=10, gather_rows=limit).first().v == whole


def test_quantiles_of_an_accuracy(spark):
    df = spark.createDataFrame([("ab"[i % 2], float(i), float("nan") if i % 3 else None) for i in range(20_000)], "g string, v double, w double")
    found = {r.g: r.v for r in quantiles.quantiles(df, ["v"], [0.1, 0.9], ["g"], accuracy=1000).collect()}
    for group in found.values():
        assert abs(group[0] - 2000) <= 60 and abs(group[1] - 18_000) <= 60
    assert quantiles.quantiles(df, ["w"], [0.5], accuracy=100).first().w is None
    assert quantiles.quantiles(df, ["v"], [0.5]).first().v == [9999.5]


def test_describe(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 3), ("b", None), (None, 5)], "t string, n int")
    found = {r.column: r for r in profile.describe_all(rows).collect()}
    assert (found["n"]["count"], found["n"].mean, found["n"].p50, found["n"].top) == (3, 3.0, 3.0, None)
    assert (found["t"]["count"], found["t"].unique, found["t"].top, found["t"].freq, found["t"].mean) == (3, 2, "b", 2, None)


def test_frequency_counts_null_as_zero(spark):
    rows = spark.createDataFrame([("a",), (None,), (None,)], "v string")
    assert [tuple(r) for r in profile.frequency(rows, "v").collect()] == [(None, 0), ("a", 1)]
    assert [tuple(r) for r in profile.value_counts(rows, "v").collect()] == [(None, 2), ("a", 1)]


def test_sample_is_stable_and_small(spark):
    rows = spark.range(3000).withColumnRenamed("id", "k")
    first = {r.k for r in profile.seeded_sample(rows, ["k"], 20).collect()}
    again = {r.k for r in profile.seeded_sample(rows.repartition(5), ["k"], 20).collect()}
    whole = {r.k for r in rows.orderBy(F.md5(F.concat(F.lit("42|"), "k"))).limit(20).collect()}
    assert first == again == whole and len(first) == 20
    same = spark.range(3000).select(F.lit(1).alias("k"))
    assert profile.seeded_sample(same, ["k"], 20).count() == 20


def test_one_snapshot_rewritten(spark):
    path = scratch_path(spark, "layer")
    table = spark.createDataFrame([("A", month(1)), ("B", month(2)), ("C", month(2))], "k string, snapshot_date date")
    tables.write_snapshots(table, path)
    tables.write_snapshots(spark.createDataFrame([("D", month(2))], table.schema), path)
    assert sorted(tuple(r) for r in tables.read_snapshots(spark, path).collect()) == [("A", month(1)), ("D", month(2))]
    assert tables.read_snapshots(spark, path, [month(1)]).count() == 1
    tables.write_snapshots(spark.createDataFrame([], table.schema), path, dates=["2023-02-01", "2023-03-01"])
    assert [tuple(r) for r in tables.read_snapshots(spark, path).collect()] == [("A", month(1))]
    tables.write_snapshots(spark.createDataFrame([("E", month(2))], table.schema), path, dates=["2023-02-01"])
    assert sorted(r.k for r in tables.read_snapshots(spark, path).collect()) == ["A", "E"]
    assert tables.between_dates(tables.read_snapshots(spark, path), start="2023-02-01").count() == 1


def test_csv_layer_keeps_text(spark):
    path = scratch_path(spark, "text")
    table = spark.createDataFrame([(" a ", "2023-01-01"), (None, "2023-01-01")], "v string, snapshot_date string")
    chosen = raw.select_snapshots(table, ["2023-01-01"])
    tables.write_snapshots(chosen, path, by=raw.SNAPSHOT_PARTITION, fmt="csv")
    back = tables.read_snapshots(spark, path).select("v", "snapshot_date").collect()
    assert {tuple(r) for r in back} == {(" a ", "2023-01-01"), (None, "2023-01-01")}


def test_missing_percent_counts_nan(spark):
    rows = spark.createDataFrame([(1.0, "a"), (float("nan"), None), (None, "b"), (2.0, "c")], "x double, y string")
    assert [tuple(r) for r in quality.missing_percent(rows).collect()] == [("x", 50.0), ("y", 25.0)]


def test_table_overview(spark):
    rows = spark.createDataFrame([("A", month(1))] * 2 + [("B", month(3))], "Customer_ID string, snapshot_date date")
    found = quality.table_overview({"t": (rows, config.KEYS)}).first()
    assert tuple(found) == ("t", 3, 2, 2, month(1), month(3), 1)
