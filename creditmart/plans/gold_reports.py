"""Named reports over the gold tables: income checks, coverage, distributions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditmart.config import KEYS
from creditmart.functions.joins import attach
from creditmart.functions.quantiles import exact_quantiles
from creditmart.operators import profile
from creditmart.operators.assemble import assert_unique_keys

# From twelve salaries to the annual income: below and above these a pair counts as extreme.
RATIO_LOW, RATIO_HIGH = 0.5, 1.5


def income_pairs(
    financials: DataFrame, low: float = RATIO_LOW, high: float = RATIO_HIGH
) -> DataFrame:
    """Annualised salary against annual income, where both are finite and positive."""
    ratio = F.col("ratio")
    return (
        financials.filter(_comparable())
        .select(*KEYS, "Annual_Income", "Monthly_Inhand_Salary")
        .withColumn("annualized_salary", F.col("Monthly_Inhand_Salary") * 12)
        .withColumn("ratio", F.col("annualized_salary") / F.col("Annual_Income"))
        .withColumns({"relative_gap": ratio - 1, "extreme_ratio": (ratio < low) | (ratio > high)})
    )


def _comparable() -> Column:
    def positive(name: str) -> Column:
        value = F.col(name)
        return (value > 0) & ~F.isnan(value) & (value < float("inf"))

    return positive("Annual_Income") & positive("Monthly_Inhand_Salary")


def income_gap_summary(
    financials: DataFrame, low: float = RATIO_LOW, high: float = RATIO_HIGH
) -> DataFrame:
    """One row: how far salaries and incomes agree.

    Customers are reduced to one row each before they are counted.
    """
    ratio = F.col("ratio")
    annual_ratio = F.col("Monthly_Inhand_Salary") * 12 / F.col("Annual_Income")
    ratios = financials.select("Customer_ID", F.when(_comparable(), annual_ratio).alias("ratio"))
    per_customer = ratios.groupBy("Customer_ID").agg(
        F.count("*").alias("total"),
        F.count("ratio").alias("pairs"),
        F.count_if(ratio.between(0.9, 1.1)).alias("near"),
        F.count_if(ratio < low).alias("low"),
        F.count_if(ratio > high).alias("high"),
    )
    extreme = F.col("low") + F.col("high")
    found = per_customer.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("total", "pairs", "near", "low", "high")],
        F.count_if((extreme > 0) & F.col("Customer_ID").isNotNull()).alias("customers"),
    )
    median = exact_quantiles(ratios, ["ratio"], [0.5]).first()[0]
    pairs = F.col("pairs")
    return found.select(
        F.col("total").alias("financial_rows"),
        pairs.alias("valid_positive_pairs"),
        (F.col("total") - pairs).alias("excluded_missing_nonpositive_or_nonfinite"),
        F.lit(median[0] if median else None).cast("double").alias("median_ratio"),
        F.col("near").alias("within_10_percent_count"),
        F.try_divide(F.col("near") * 100.0, pairs).alias("within_10_percent_pct"),
        F.col("low").alias("low_ratio_count"),
        F.col("high").alias("high_ratio_count"),
        F.try_divide(extreme * 100.0, pairs).alias("extreme_ratio_pct"),
        F.col("customers").alias("customers_with_extreme_ratio"),
    )


def income_gap_monthly(pairs: DataFrame) -> DataFrame:
    counts = pairs.groupBy("snapshot_date").agg(
        F.count("ratio").alias("rows"),
        (F.avg(F.col("extreme_ratio").cast("int")) * 100).alias("extreme_pct"),
    )
    medians = exact_quantiles(pairs, ["ratio"], [0.5], keys=["snapshot_date"])
    return counts.join(
        medians.select("snapshot_date", F.get("ratio", F.lit(0)).alias("median_ratio")),
        "snapshot_date", "left",
    )


def repeat_customers(pairs: DataFrame) -> DataFrame:
    """Customers with more than one financial snapshot."""
    per_customer = pairs.groupBy("Customer_ID").agg(F.count("*").alias("n"))
    return per_customer.agg(F.count_if(F.col("n") > 1).alias("customers_with_multiple_snapshots"))


def income_vs_customer_median(pairs: DataFrame) -> DataFrame:
    """Income relative to the customer's own median over the chosen dates.

    For looking only: the median also uses later dates, so it is no feature.
    """
    medians = exact_quantiles(pairs, ["Annual_Income"], [0.5], keys=["Customer_ID"])
    own = medians.select(
        "Customer_ID", F.get("Annual_Income", F.lit(0)).alias("customer_median_income")
    )
    return attach(pairs, own, ["Customer_ID"]).withColumn(
        "income_vs_customer_median", F.col("Annual_Income") / F.col("customer_median_income")
    )


def most_unusual_incomes(pairs: DataFrame, k: int = 20) -> DataFrame:
    compared = income_vs_customer_median(pairs).filter("extreme_ratio")
    return profile.extremes(compared, "income_vs_customer_median", k, ascending=False, ties=KEYS)


def lowest_ratio_customer(pairs: DataFrame) -> DataFrame:
    """All rows of the customer with the lowest ratio, by date."""
    customer = profile.extremes(pairs, "ratio", 1, ties=KEYS).select("Customer_ID")
    return pairs.join(F.broadcast(customer), "Customer_ID", "left_semi").orderBy("snapshot_date")


def click_coverage(attributes: DataFrame, clicks: DataFrame) -> DataFrame:
    """Customers per date and the share of them with earlier click history."""
    population = attributes.select(*KEYS).distinct()
    activity = clicks.select(*KEYS).distinct().withColumn("has_history", F.lit(1))
    covered = population.join(activity, KEYS, "left")
    return covered.groupBy("snapshot_date").agg(
        F.count("*").alias("customers"),
        (F.avg(F.coalesce("has_history", F.lit(0))) * 100).alias("coverage_pct"),
    )


def checked_click_coverage(attributes: DataFrame, clicks: DataFrame) -> DataFrame:
    """The same, refusing tables whose keys would not match one to one."""
    assert_unique_keys({"attributes": attributes, "clickstream": clicks})
    return click_coverage(attributes, clicks)
