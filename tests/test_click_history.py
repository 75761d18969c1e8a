"""Totals kept from run to run against the whole history in one pass."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from creditmart.operators import history
from creditmart.plans import click_history
from creditmart.session import scratch_path
from creditmart.sources import log, tables

MONTHS = [datetime.date(2023, m, 1) for m in range(1, 9)]


def clicks(spark, rows, more=()):
    extra = "".join(f", {name} int" for name in more)
    return spark.createDataFrame(rows, f"Customer_ID string, fe_1 int, fe_2 int{extra}, snapshot_date date")


def month_rows(seed, month, n=20):
    pick = random.Random(f"{seed}{month}")
    value = lambda: pick.choice([None, *range(9)])
    return [(pick.choice([None, *"abcdefgh"]), value(), value(), month) for _ in range(n)]


def rows(frame):
    return sorted(map(repr, frame.select(sorted(frame.columns)).collect()))


class Mart:
    def __init__(self, spark):
        root = scratch_path(spark, "history")
        self.spark, self.silver, self.totals = spark, f"{root}/silver", f"{root}/totals"

    def deliver(self, month, given, more=()):
        tables.write_snapshots(clicks(self.spark, given, more), self.silver, dates=[month])

    def update(self, *cutoffs):
        click_history.update(self.spark, self.silver, self.totals, cutoffs)

    def check(self, *cutoffs):
        whole = history.asof_history(tables.read_snapshots(self.spark, self.silver), cutoffs)
        assert rows(click_history.read(self.spark, self.totals, cutoffs)) == rows(whole)

    def files(self, *cutoffs):
        found, _ = click_history.totals_frame(self.spark, self.silver, self.totals, cutoffs)
        days = [f.split("snapshot_date=")[1].split("/")[0] for f in found.inputFiles() if f.split("/_run=")[0].endswith("silver")]
        return sorted({datetime.date.fromisoformat(d) for d in days}), sum("/totals/" in f for f in found.inputFiles())


@pytest.fixture
def mart(spark):
    return Mart(spark)


def test_a_month_reads_a_month(mart):
    for i, month in enumerate(MONTHS[:5]):
        mart.deliver(month, month_rows(1, month))
        if i:
            mart.update(month)
        else:
            mart.update(month, MONTHS[1])
    mart.deliver(MONTHS[5], month_rows(1, MONTHS[5]))
    days, state = mart.files(MONTHS[6])
    # The latest totals are those of May, so May and June are read.
    assert days == MONTHS[4:6] and state >= 1
    mart.update(MONTHS[6])
    mart.check(*MONTHS[:5], MONTHS[6])
    assert mart.files(MONTHS[6])[0] == []
    mart.update(MONTHS[6], MONTHS[7])
    mart.check(*MONTHS[6:8])


def test_late_and_corrected_days(mart):
    for month in MONTHS[:4]:
        mart.deliver(month, month_rows(2, month))
    mart.update(*MONTHS[:4])
    # A customer disappears from February, another one is new there.
    changed = [r for r in month_rows(2, MONTHS[1]) if r[0] != "a"] + [("new", 1, None, MONTHS[1]), (None, 5, 5, MONTHS[1])]
    mart.deliver(MONTHS[1], changed)
    assert mart.files(MONTHS[4])[0] == MONTHS[:4]
    mart.update(MONTHS[4])
    mart.check(MONTHS[0], MONTHS[1], MONTHS[4])
    # What was made from the corrected day is known to be up to date.
    assert mart.files(MONTHS[4])[0] == [] and mart.files(MONTHS[5])[0] in ([], [MONTHS[4]])
    # Older cutoffs catch up when they are asked for.
    mart.update(*MONTHS[1:4])
    mart.check(*MONTHS[:5])
    # A day without rows, and a day that comes after all.
    mart.deliver(MONTHS[2], [])
    mart.update(MONTHS[5])
    mart.check(MONTHS[5])


def test_files_that_are_gone(mart):
    for month in MONTHS[:3]:
        mart.deliver(month, month_rows(3, month))
    mart.update(*MONTHS[:4])
    mart.deliver(MONTHS[0], month_rows(4, MONTHS[0]))
    log.remove_replaced(mart.spark, mart.silver)
    assert mart.files(MONTHS[3])[0] == MONTHS[:3]
    mart.update(MONTHS[3])
    mart.check(MONTHS[3])


def test_a_new_counter(mart):
    mart.deliver(MONTHS[0], month_rows(5, MONTHS[0]))
    mart.update(MONTHS[1])
    mart.deliver(MONTHS[1], [("a", 1, 2, 3, MONTHS[1]), ("z", 1, 2, None, MONTHS[1])], ["fe_9"])
    mart.update(MONTHS[2])
    mart.check(MONTHS[2])
    found = {r.Customer_ID: r.fe_9_mean for r in click_history.read(mart.spark, mart.totals, [MONTHS[2]]).collect()}
    assert found["a"] == 3 and found["z"] is None


@pytest.mark.parametrize("seed", range(3))
def test_any_order_of_runs(mart, seed):
    pick = random.Random(seed)
    mart.deliver(MONTHS[0], month_rows(seed, MONTHS[0]))
    for step in range(7):
        month = pick.choice(MONTHS[:6])
        mart.deliver(month, month_rows(seed * 100 + step, month, pick.choice([0, 1, 15])))
        cutoffs = sorted(pick.sample(MONTHS, pick.choice([1, 1, 3])))
        mart.update(*cutoffs)
        mart.check(*cutoffs)


def test_sums_are_whole(mart):
    mart.deliver(MONTHS[0], [("a", 2**31 - 1, None, MONTHS[0])] * 3)
    mart.update(MONTHS[1])
    mart.deliver(MONTHS[1], [("a", 2**31 - 1, None, MONTHS[1])])
    mart.update(MONTHS[2])
    found = tables.read_snapshots(mart.spark, mart.totals, [MONTHS[2]]).select(F.col("sum_fe_1"), "n_fe_1", "clickstream_days").first()
    assert tuple(found) == (4 * (2**31 - 1), 4, 2)
