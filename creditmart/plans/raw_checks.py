"""Named reports over the raw text tables, before any cleaning rule."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditmart import config
from creditmart.functions.columns import (
    quoted,
    rounding_int,
    strip_trailing_underscores,
    strip_underscores,
)
from creditmart.functions.joins import attach
from creditmart.functions.quantiles import exact_quantiles
from creditmart.operators import profile

# The buckets of the monthly investment report.
INVESTED_BUCKETS = [(100, "0-100"), (250, "100-250"), (500, "250-500"), (1000, "500-1000")]
INVESTED_PLACEHOLDER_TEXT = "__10000__"


def number(name: str) -> Column:
    """The number in a raw text column, underscores around it removed."""
    return strip_underscores(quoted(name)).try_cast("double")


def raw_age() -> Column:
    return rounding_int(strip_trailing_underscores(F.col("Age")))


def age_listing(attributes: DataFrame, valid: bool) -> DataFrame:
    """Age texts with what they read as: in range or unreadable, or out of range or unreadable."""
    in_range = F.col("Age2").between(*config.AGE_RANGE)
    read = attributes.select(F.col("Age").alias("original_age"), raw_age().alias("Age2"))
    return read.filter((in_range if valid else ~in_range) | F.col("Age2").isNull()).orderBy("Age2")


def valid_age_frequency(attributes: DataFrame) -> DataFrame:
    ages = attributes.select(raw_age().alias("Age")).filter(F.col("Age").between(*config.AGE_RANGE))
    return profile.frequency(ages, "Age", "age_counts")


def age_validity(attributes: DataFrame) -> DataFrame:
    ages = attributes.select(raw_age().alias("age"))
    valid = F.col("age").between(*config.AGE_RANGE)
    return profile.conditional_counts(ages, {
        "valid_ages": valid,
        "invalid_ages": ~F.coalesce(valid, F.lit(False)),
    })


def list_entries(column: str = "Type_of_Loan") -> Column:
    return F.split(F.replace(F.col(column), F.lit(", and "), F.lit(", ")), ", ")


def loan_type_frequency(financials: DataFrame) -> DataFrame:
    return profile.exploded_frequency(
        financials, list_entries(), "loan_type", "loan_mentions", "Customer_ID", "customer_count"
    )


def loan_count_comparison(
    financials: DataFrame, keys: Sequence[str] = ("Customer_ID",)
) -> DataFrame:
    """Customers stating more loans than they list, the largest gap first.

    Listed loans are added up per key and joined back; pass the snapshot date as
    a second key where a customer has several snapshots.
    """
    listed = (
        financials.filter("Type_of_Loan is not null")
        .groupBy(*keys).agg(F.sum(F.size(list_entries())).alias("_listed"))
    )
    stated = rounding_int(strip_trailing_underscores(F.col("Num_of_Loan")))
    rows = financials.select(
        *keys, "Type_of_Loan",
        F.col("Num_of_Loan").alias("raw_num_of_loan"), stated.alias("num_of_loan"),
    )
    compared = (
        attach(rows, listed, keys)
        .withColumn("listed_loan_count", F.coalesce("_listed", F.lit(0)))
        .withColumn("count_difference", F.col("num_of_loan") - F.col("listed_loan_count"))
    )
    result = (
        F.when(F.col("num_of_loan").isNull(), "Invalid Num_of_Loan")
        .when(F.col("count_difference") == 0, "Match")
        .otherwise("Mismatch")
    )
    return (
        compared.withColumn("validation_result", result).drop("_listed")
        .filter("count_difference > 0").orderBy(F.desc("count_difference"), *keys)
    )


def loan_count_status(financials: DataFrame) -> DataFrame:
    """Rows per outcome of comparing the stated count with the entries of the same row."""
    stated = rounding_int(strip_underscores(F.col("Num_of_Loan")))
    listed = F.when(F.trim("Type_of_Loan") != "", F.size(list_entries()))
    status = (
        F.when(F.coalesce(stated < 0, F.lit(True)), "Invalid count")
        .when(listed.isNull(), "Missing loan list")
        .when(stated == listed, "Match")
        .otherwise("Mismatch")
    )
    return (
        financials.select(status.alias("loan_count_status"))
        .groupBy("loan_count_status").agg(F.count("*").alias("row_count"))
        .orderBy(F.desc("row_count"), "loan_count_status")
    )


def customer_rows(table: DataFrame, customer: str) -> DataFrame:
    return table.filter(F.col("Customer_ID") == customer)


def zero_loans_without_list(financials: DataFrame) -> DataFrame:
    stated = rounding_int(strip_trailing_underscores(F.col("Num_of_Loan")))
    return financials.filter((stated == 0) & F.col("Type_of_Loan").isNull()).select(
        "Customer_ID", "Num_of_Loan", "Type_of_Loan", "Total_EMI_per_month", "Outstanding_Debt"
    )


def negative_debt(financials: DataFrame) -> DataFrame:
    return financials.filter(number("Outstanding_Debt") < 0).select("Outstanding_Debt")


def invalid_dates(table: DataFrame) -> DataFrame:
    """Rows whose date text the snapshot selection could not place."""
    unreadable = F.col("snapshot_date").try_cast("date").isNull()
    return table.filter(unreadable).select("Customer_ID", "snapshot_date")


def field_validity(financials: DataFrame) -> DataFrame:
    rate, debt = number("Interest_Rate"), number("Outstanding_Debt")
    in_range = rate.between(*config.VALUE_RANGES["Interest_Rate"])

    def known(name: str, values: Sequence[str]) -> Column:
        return F.coalesce(F.col(name).isin(list(values)), F.lit(False))

    return profile.conditional_counts(financials, {
        "invalid_interest_rate": ~F.coalesce(in_range, F.lit(False)),
        "negative_debt": debt < 0,
        "unknown_credit_mix": ~known("Credit_Mix", config.CREDIT_MIXES),
        "unknown_minimum_payment": ~known("Payment_of_Min_Amount", config.MINIMUM_PAYMENTS),
        "invalid_dates": F.col("snapshot_date").try_cast("date").isNull(),
    })


def invested_distribution(financials: DataFrame) -> DataFrame:
    amount = number("Amount_invested_monthly")
    bucket = F.when(
        F.trim("Amount_invested_monthly") == INVESTED_PLACEHOLDER_TEXT,
        f"{INVESTED_PLACEHOLDER_TEXT} placeholder",
    )
    for limit, name in INVESTED_BUCKETS:
        bucket = bucket.when(amount < limit, name)
    return profile.bucketed(financials, bucket.otherwise("1000+"), amount)


def invested_histogram(financials: DataFrame, placeholder: bool = False) -> DataFrame:
    """Fifty bins from 0 to 10000, without or with only the placeholder rows."""
    marked = F.trim("Amount_invested_monthly") == INVESTED_PLACEHOLDER_TEXT
    rows = financials.filter(marked if placeholder else ~marked)
    return profile.histogram(rows, number("Amount_invested_monthly"), 50, 0, 10000)


def inquiry_decimals(financials: DataFrame) -> DataFrame:
    text = F.col("Num_Credit_Inquiries")
    return profile.conditional_counts(financials, {
        "stored_with_decimal": text.contains("."),
        "ending_in_point_zero": text.endswith(".0"),
    })


def range_summary(financials: DataFrame) -> DataFrame:
    def value(name: str) -> Column:
        text = strip_underscores(quoted(name))
        return F.regexp_replace(text, r"\.0$", "").try_cast("double")

    return profile.range_summary(
        financials, {name: (value(name), *ends) for name, ends in config.VALUE_RANGES.items()}
    )


def value_spreads(financials: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Row counts of each column's values from -5 to 40."""
    return profile.values_between(financials, {c: number(c) for c in columns}, -5, 40)


def salary_ratios(financials: DataFrame) -> DataFrame:
    salary = number("Monthly_Inhand_Salary")
    return financials.select(
        F.try_divide(number("Total_EMI_per_month"), salary).alias("emi_to_salary"),
        F.try_divide(number("Annual_Income"), salary).alias("income_to_salary"),
    )


def salary_ratio_summary(financials: DataFrame) -> DataFrame:
    ratios = salary_ratios(financials)
    emi, income = F.col("emi_to_salary"), F.col("income_to_salary")
    counts = profile.conditional_counts(ratios, {
        "emi_above_salary": emi > 1,
        "emi_half_to_full_salary": emi.between(0.5, 1),
        "income_above_30x_salary": income > 30,
        "income_25x_to_30x_salary": income.between(25, 30),
    })
    median = exact_quantiles(ratios, ["income_to_salary"], [0.5]).first()[0]
    value = F.lit(median[0] if median else None).cast("double")
    return counts.withColumn("median_income_to_salary", F.round(value, 1))


def log_ratio_histogram(ratios: DataFrame, column: str, bins: int = 60) -> DataFrame:
    """Bins of log10 of the positive ratios."""
    positive = ratios.filter(F.col(column) > 0)
    return profile.histogram(positive, F.log10(F.col(column)), bins)


def lowest_balances(financials: DataFrame, k: int = 5) -> DataFrame:
    balances = financials.select(
        "Customer_ID",
        F.col("Monthly_Balance").alias("raw_value"),
        number("Monthly_Balance").alias("balance"),
    )
    return profile.extremes(balances, "balance", k, ties=["Customer_ID"])
