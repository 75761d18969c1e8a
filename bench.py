"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the number of local threads.
The loan-like views over the tables are stored first, also as the CSV files a
source system would deliver, and are not part of the times. Every query is then run to
its last row through the ``noop`` sink; the best of ``BENCH_RUNS`` runs counts. ``asof_per_date_loop`` is the comparison
for ``click_history_asof``: one pass per date over the same history. It is
reported under ``comparison`` and not part of the total; ``phases`` are those of one
more backfill.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F  # noqa: E402

from checks.queries import ALL_MONTHS, DAYS, DELIVERED, QUERIES, csv_copy, silver_clicks  # noqa: E402
from checks.views import STORED_FILES, store  # noqa: E402
from creditmart.plans import backfill  # noqa: E402
from creditmart.session import get_session, scratch_path  # noqa: E402

HEADLINE = [
    "snapshot_ingest",
    "loan_delinquency",
    "default_rate_by_cohort",
    "mob_performance_curve",
    "attributes_silver",
    "financials_silver",
    "clicks_silver",
    "financials_gold",
    "click_history_asof",
    "key_guard_counts",
    "joined_features",
    "labelled_features",
    "split_report",
    "encoded_sets",
    "backfill_features",
    "income_gap_summary",
    "loan_type_frequency",
    "stored_table",
    "train_fill_values",
    "encoded_new_loans",
    "grouped_quantiles",
    "describe_financials",
]


def per_date_loop(spark, sf_dir):
    """The history of each cutoff by a pass of its own."""
    clicks = silver_clicks(spark, sf_dir)
    counters = [c for c in clicks.columns if c.startswith("fe_")]
    for cutoff in DAYS:
        clicks.filter(F.col("snapshot_date") < F.lit(cutoff)).groupBy("Customer_ID").agg(
            *[F.avg(c) for c in counters], F.countDistinct("snapshot_date")
        ).write.format("noop").mode("overwrite").save()


def phases(spark, sf_dir) -> dict[str, float]:
    """Seconds of each layer of a backfill."""
    layout, times = backfill.Layout(scratch_path(spark, "mart")), {}
    files = {dataset: csv_copy(spark, sf_dir, name) for dataset, name in DELIVERED.items()}
    for name, run in (
        ("bronze", lambda: backfill.run_bronze(spark, files, layout, ALL_MONTHS)),
        ("silver", lambda: backfill.run_silver(spark, layout, ALL_MONTHS)),
        ("gold", lambda: backfill.run_gold(spark, layout, ALL_MONTHS)),
    ):
        start = time.perf_counter()
        run()
        times[name] = round(time.perf_counter() - start, 3)
    return times


def best(run, runs: int) -> float:
    times = []
    for _ in range(runs):
        start = time.perf_counter()
        run()
        times.append(time.perf_counter() - start)
    return round(min(times), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = sys.argv[1:] or HEADLINE
    spark = get_session(
        "bench",
        spark__master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    store(spark, sf_dir, scratch_path(spark, "views"))
    for name in [*DELIVERED.values()]:
        STORED_FILES[sf_dir, name] = csv_copy(spark, sf_dir, name)
    times = {}
    for name in chosen:
        def run(query=QUERIES[name]):
            query(spark, sf_dir).write.format("noop").mode("overwrite").save()

        times[name] = best(run, runs)
    comparison = {}
    if "click_history_asof" in chosen:
        comparison["asof_per_date_loop"] = best(lambda: per_date_loop(spark, sf_dir), runs)
    print(json.dumps({
        "metric": "headline_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "comparison": comparison,
        "phases": phases(spark, sf_dir) if "backfill_features" in chosen else {},
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
