"""Reports merged from stored states against the same reports over the rows."""

import pytest
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from creditmart.operators import profile, quality
from creditmart.plans import profiles
from creditmart.session import scratch_path
from creditmart.sources import tables

MONTHS = ["2024-01-01", "2024-02-01", "2024-03-01"]
RANGES = {"big": (100.0, 5000.0), "absent": (0.0, 1.0)}


def sample(spark):
    return spark.range(3000).select(
        F.concat(F.lit("C"), F.col("id") % 500).alias("Customer_ID"),
        F.when(F.col("id") % 7 > 0, F.col("id") + 1e9).alias("big"),
        F.when(F.col("id") % 5 == 0, F.lit(float("nan"))).otherwise(F.sin("id")).alias("wave"),
        F.when(F.col("id") % 11 > 0, F.col("id") % 3 == 0).alias("flag"),
        F.when(F.col("id") % 13 > 0, F.chr(97 + F.col("id") % 4)).alias("kind"),
        F.lit(None).cast("double").alias("a `b`.c"),
        F.element_at(F.array(*[F.lit(m).cast("date") for m in MONTHS]), (F.col("id") % 3 + 1).cast("int")).alias("snapshot_date"),
    )


@pytest.fixture(scope="module")
def stored(spark):
    """A table of three snapshots by two runs, its states brought up to date after each."""
    table, path, rows = scratch_path(spark, "rows"), scratch_path(spark, "states"), sample(spark)
    first = F.col("snapshot_date") == MONTHS[0]
    tables.write_snapshots(rows.filter(first), table)
    assert profiles.update(spark, table, path, RANGES, ["kind", "flag"]) == MONTHS[:1]
    tables.write_snapshots(rows.filter(~first), table)
    assert profiles.update(spark, table, path, RANGES, ["kind", "flag"]) == MONTHS[1:]
    assert profiles.update(spark, table, path, RANGES, ["kind", "flag"]) == []
    return table, path


@pytest.mark.parametrize("dates", [None, MONTHS[1:]])
def test_reports_equal_those_over_rows(spark, stored, dates):
    rows = sample(spark) if dates is None else sample(spark).filter(F.col("snapshot_date").isin(dates))
    found = profiles.read(spark, stored[1], dates)
    numbers = ["big", "wave", "a `b`.c"]
    exact = ["column", "count", "mean", "std", "min", "max"]
    assertDataFrameEqual(
        profiles.describe(found).where(F.col("column").isin(numbers)).select(exact),
        profile.describe_numbers(rows, numbers).select(exact), rtol=1e-9,
    )
    assertDataFrameEqual(
        profiles.missing_percent(found, None), quality.missing_percent(rows, None), rtol=1e-9
    )
    assertDataFrameEqual(profiles.flag_percentages(found), profile.flag_percentages(rows, ["flag"]), rtol=1e-9)
    assertDataFrameEqual(profiles.value_counts(found, "kind"), profile.value_counts(rows, "kind"))
    expected = profile.range_summary(rows, {"big": (F.col("big"), *RANGES["big"])}).drop("low", "high")
    assertDataFrameEqual(profiles.range_counts(found), expected)
    assert {r.rows for r in profiles.snapshot_rows(found).collect()} == {1000}


def test_sketches_are_near(spark, stored):
    described = {r.column: r for r in profiles.describe(profiles.read(spark, stored[1]), [0.1, 0.5]).collect()}
    waves = sorted(r.wave for r in sample(spark).where("not isnan(wave)").select("wave").collect())
    for name, p in {"p10": 0.1, "p50": 0.5}.items():
        rank = sum(w <= described["wave"][name] for w in waves) / len(waves)
        assert abs(rank - p) < 0.02
    assert abs(described["Customer_ID"].about_distinct - 500) < 25
    assert described["kind"].about_distinct == 4 and described["kind"].p50 is None
    assert described["a `b`.c"].p50 is None and described["a `b`.c"].about_distinct == 0


def test_reports_read_states_only(spark, stored):
    found = profiles.read(spark, stored[1])
    assert all(stored[1] in file for file in profiles.describe(found).inputFiles())


def test_changes_are_noticed(spark):
    """A snapshot written anew, a younger column, other rules, a snapshot that became empty."""
    table, path = scratch_path(spark, "rows"), scratch_path(spark, "states")
    rows = sample(spark)
    tables.write_snapshots(rows, table)
    profiles.update(spark, table, path)
    changed = rows.filter(F.col("snapshot_date") == MONTHS[1]).limit(10).withColumn("new", F.lit(1))
    tables.write_snapshots(changed, table)
    assert profiles.update(spark, table, path) == [MONTHS[1]]
    counted = {r.column: r for r in profiles.describe(profiles.read(spark, path)).collect()}
    assert (counted["Customer_ID"]["count"], counted["new"]["count"]) == (2010, 10)
    missing = {r.column: r.missing_pct for r in profiles.missing_percent(profiles.read(spark, path), None).collect()}
    assert missing["new"] == pytest.approx(100 * 2000 / 2010)
    assert profiles.update(spark, table, path, categories=["kind"]) == MONTHS
    assert profiles.update(spark, table, path) == MONTHS
    tables.write_snapshots(rows.limit(0), table, dates=MONTHS[:1])
    assert profiles.update(spark, table, path) == MONTHS[:1]
    assert {str(r.snapshot_date) for r in profiles.snapshot_rows(profiles.read(spark, path)).collect()} == set(MONTHS[1:])


def test_no_rows(spark):
    table, path = scratch_path(spark, "rows"), scratch_path(spark, "states")
    with pytest.raises(ValueError, match="no snapshot table"):
        profiles.update(spark, table, path)
    tables.write_snapshots(sample(spark).limit(0), table, dates=MONTHS)
    assert profiles.update(spark, table, path) == MONTHS
    found = profiles.read(spark, path)
    assert profiles.describe(found).count() == 0 and profiles.missing_percent(found).count() == 0
