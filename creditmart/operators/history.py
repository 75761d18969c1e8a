"""Click history strictly before each snapshot, for all snapshots in one pass."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from creditmart.functions.columns import quoted
from creditmart.sources.spine import as_dates


def counters_of(clicks: DataFrame, prefix: str = "fe_") -> list[str]:
    return sorted(name for name in clicks.columns if name.startswith(prefix))


def running_totals(
    clicks: DataFrame,
    spine: Iterable[str | date],
    prefix: str = "fe_",
    base: DataFrame | None = None,
) -> DataFrame:
    """Sum (``sum_``) and number (``n_``) of every counter and active days before each cutoff, per customer.

    A customer has a row at every cutoff that comes after their first activity,
    also when nothing new happened since the previous one. ``base`` has totals of
    the same columns, some perhaps missing, of activity that is not in
    ``clicks`` and lies before the first cutoff.

    Rows shrink before every shuffle: first to one row per customer and day,
    then, partitioned by customer, to one per customer and gap between cutoffs.
    From there running sums and the filling of quiet months need no further
    shuffle, and a customer has at most as many rows as there are cutoffs.
    Sums of whole numbers stay whole, so the order of adding does not matter.
    """
    cutoffs, counters = as_dates(spine), counters_of(clicks, prefix)
    daily = (
        clicks.filter(F.col("snapshot_date") < F.lit(cutoffs[-1]))
        .groupBy("Customer_ID", "snapshot_date")
        .agg(
            *[F.sum(quoted(name)).alias(f"sum_{name}") for name in counters],
            *[F.count(quoted(name)).alias(f"n_{name}") for name in counters],
        )
    )
    # The first cutoff strictly after the day is the first one to see it.
    first_seen = F.coalesce(*[
        F.when(F.col("snapshot_date") < F.lit(cutoff), F.lit(position))
        for position, cutoff in enumerate(cutoffs)
    ])
    parts = daily.withColumns({"_cutoff": first_seen, "clickstream_days": F.lit(1).cast("bigint")}).drop("snapshot_date")
    if base is not None:
        parts = parts.unionByName(
            base.withColumn("_cutoff", F.lit(0)).drop("snapshot_date"), allowMissingColumns=True
        )
    totals = [name for name in parts.columns if name not in ("Customer_ID", "_cutoff")]
    gaps = (
        parts.repartition("Customer_ID").groupBy("Customer_ID", "_cutoff")
        .agg(*[F.sum(quoted(total)).alias(total) for total in totals])
    )
    in_order = Window.partitionBy("Customer_ID").orderBy("_cutoff")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def total_so_far(total: str):
        found = F.sum(quoted(total)).over(so_far)
        return (F.coalesce(found, F.lit(0)) if total.startswith("n_") else found).alias(total)

    running = gaps.select(
        "Customer_ID",
        *[total_so_far(total) for total in totals],
        F.sequence(
            F.col("_cutoff"), F.lead("_cutoff", 1, len(cutoffs)).over(in_order) - 1
        ).alias("_holds_at"),
    )
    dates = F.array(*[F.lit(cutoff) for cutoff in cutoffs])
    return running.withColumn("_position", F.explode("_holds_at")).select(
        "Customer_ID", *[quoted(total) for total in totals], F.get(dates, F.col("_position")).alias("snapshot_date"),
    )


def means(totals: DataFrame) -> DataFrame:
    """Mean of every counter, from its sum and number."""
    counters = sorted(name.removeprefix("sum_") for name in totals.columns if name.startswith("sum_"))
    return totals.select(
        "Customer_ID",
        *[F.try_divide(quoted(f"sum_{name}"), quoted(f"n_{name}")).alias(f"{name}_mean") for name in counters],
        "clickstream_days",
        F.lit(1).alias("has_clickstream"),
        "snapshot_date",
    )


def asof_history(
    clicks: DataFrame, spine: Iterable[str | date], prefix: str = "fe_"
) -> DataFrame:
    """Mean of every counter and number of active days, per customer and cutoff."""
    return means(running_totals(clicks, spine, prefix))
