"""Loan snapshots: typing, days past due, default labels, bad-rate curves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditmart.config import LOAN_COLUMNS
from creditmart.functions.columns import quoted, truncating_int

# The most instalments the column can hold.
MOST_MISSED = 2**31 - 1


def typed(raw: DataFrame, types: dict[str, str] = LOAN_COLUMNS) -> DataFrame:
    """Type the text columns; unreadable values become null, ``6.0`` counts as 6."""
    return raw.withColumns({
        name: truncating_int(quoted(name)) if dtype == "int" else quoted(name).try_cast(dtype)
        for name, dtype in types.items()
        if name in raw.columns
    })


def delinquency(loans: DataFrame) -> DataFrame:
    """Add ``mob``, ``installments_missed``, ``first_missed_date`` and ``dpd``.

    Days past due are calendar days since the first missed instalment, so one
    missed instalment is 28 to 31 days. The ratio is rounded to nine digits
    before the ceiling: three instalments of 880.1 are three, not four. Any
    overdue share of a known instalment is at least one. Counts end at
    ``MOST_MISSED``, and the date at the first year of the calendar.
    """
    overdue, due = F.col("overdue_amt"), F.col("due_amt")
    ratio = F.greatest(F.ceil(F.round(F.try_divide(overdue, due), 9)).cast("double"), F.lit(1.0))
    missed = F.least(ratio, F.lit(float(MOST_MISSED))).cast("int")
    none = F.ceil(F.round(F.try_divide(overdue, due), 9)).try_cast("int")
    counted = loans.withColumns({
        "mob": F.col("installment_num").cast("int"),
        "installments_missed": F.when(overdue == 0, 0).when((due > 0) & (overdue > 0), missed).when(due > 0, none),
    })
    calendar = (F.year("snapshot_date") - 1) * 12 + F.month("snapshot_date") - 1
    back = F.when(F.col("installments_missed") > 0, -F.least("installments_missed", calendar))
    dated = counted.withColumn("first_missed_date", F.add_months("snapshot_date", back))
    days = F.datediff("snapshot_date", "first_missed_date")
    return dated.withColumn("dpd", F.when(overdue > 0, days).otherwise(0))


def default_label(loans: DataFrame, dpd: int = 30, mob: int = 6) -> DataFrame:
    """Label store: loans at month on book ``mob``, 1 when ``dpd`` days late or more.

    The observation date stays apart from the loan start, which is the date
    features are matched on.
    """
    return loans.filter(F.col("mob") == mob).select(
        "loan_id",
        "Customer_ID",
        "loan_start_date",
        _is_bad(dpd).cast("int").alias("label"),
        F.lit(f"{dpd}dpd_{mob}mob").alias("label_def"),
        "snapshot_date",
    )


def default_rate(labels: DataFrame, by: str = "snapshot_date") -> DataFrame:
    """Labelled loans and their default rate per date."""
    return labels.groupBy(by).agg(
        F.count("*").alias("loans"), F.avg("label").alias("default_rate")
    )


def bad_by_month(loans: DataFrame, dpd: int = 30, first: int = 1, last: int = 10) -> DataFrame:
    """Per loan and month on book: rows, bad rows, and bad at this or an earlier month.

    One shuffle by loan, combined before it: a loan becomes its row and bad
    counts per month, however many rows it has, and the running maximum of the
    bad flag is read off those counts without a sort.
    """
    months = range(first, last + 1)
    at = {month: F.col("mob") == month for month in months}
    per_loan = (
        loans.filter(F.col("mob").between(first, last))
        .groupBy("loan_id")
        .agg(
            *[F.count_if(at[month]).alias(f"rows_{month}") for month in months],
            *[F.count_if(at[month] & _is_bad(dpd)).alias(f"bad_{month}") for month in months],
        )
    )
    entries, bad_so_far = [], F.lit(False)
    for month in months:
        bad_so_far = bad_so_far | (F.col(f"bad_{month}") > 0)
        entries.append(F.struct(
            F.lit(month).alias("mob"),
            F.col(f"rows_{month}").alias("rows"),
            F.col(f"bad_{month}").alias("bad_rows"),
            bad_so_far.cast("int").alias("ever_bad_by_mob"),
        ))
    return per_loan.select("loan_id", F.inline(F.array(*entries))).filter("rows > 0")


def performance_curve(
    loans: DataFrame, dpd: int = 30, first: int = 1, last: int = 10
) -> DataFrame:
    """Loans, bad rate and cumulative bad rate per month on book."""
    rows = F.sum("rows")
    return (
        bad_by_month(loans, dpd, first, last).groupBy("mob")
        .agg(
            F.count("loan_id").alias("loan_count"),
            (F.sum("bad_rows") / rows).alias("bad_rate_at_mob"),
            (F.sum(F.col("rows") * F.col("ever_bad_by_mob")) / rows).alias("cumulative_bad_rate"),
        )
        .orderBy("mob")
    )


def _is_bad(dpd: int) -> Column:
    return F.coalesce(F.col("dpd") >= dpd, F.lit(False))
