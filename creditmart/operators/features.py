"""Cleaned tables to features; projections only, except the vocabulary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmart import config
from creditmart.functions.columns import entry_count, padded_list
from creditmart.sources.tables import absent_as


def attributes(clean: DataFrame) -> DataFrame:
    """Flag a missing occupation, name it, and leave the raw copies behind."""
    missing = F.col("Occupation").isNull()
    return clean.withColumns({
        "occupation_missing": missing,
        "Occupation": F.coalesce("Occupation", F.lit(config.UNKNOWN_CATEGORY)),
    }).drop("Age_raw", "snapshot_date_raw")


def loan_column(loan_type: str) -> str:
    return "Loan_" + loan_type.translate(str.maketrans(" -", "__"))


def financials(clean: DataFrame, loan_types: Sequence[str] = config.LOAN_TYPES) -> DataFrame:
    """Ratios, disposable income, loan-type counts, behaviour parts and log amounts.

    ``loan_types`` fixes the output columns; pass a frozen list to keep them
    stable, or a vocabulary of the cleaned table. In stored snapshots older than a
    loan type its count reads as zero where the list is known.
    """
    salary, income = F.col("Monthly_Inhand_Salary"), F.col("Annual_Income")
    instalments, invested = F.col("Total_EMI_per_month"), F.col("Amount_invested_monthly")
    behaviour = F.split("Payment_Behaviour", "_")
    derived = {
        "months12_to_annual_income_ratio": F.when(income > 0, F.try_divide(salary * 12, income)),
        "EMI_to_Salary_Ratio": F.when(salary > 0, F.try_divide(instalments, salary)),
        "Debt_to_Income": F.when(income > 0, F.try_divide(F.col("Outstanding_Debt"), income)),
        "Disposable_Income": salary - instalments - invested,
        **{
            loan_column(name): absent_as(
                F.when(~F.col("loan_types_missing"), entry_count(F.col("_listed"), name)),
                loan_column(name), 0, unless="loan_types_missing",
            )
            for name in loan_types
        },
        "Spending_Behaviour": F.get(behaviour, F.lit(0)),
        "Payments_Size": F.get(behaviour, F.lit(2)),
        **{
            f"{name}_log1p": F.when(F.col(name) >= 0, F.log1p(name))
            for name in config.LOG_COLUMNS
        },
    }
    return (
        clean.withColumn("_listed", padded_list(F.col("Type_of_Loan")))
        .withColumns(derived)
        .fillna(config.UNKNOWN_CATEGORY, config.CATEGORY_COLUMNS)
        .drop(
            "_listed", "Num_of_Loan_raw", "snapshot_date_raw",
            "Type_of_Loan", "Payment_Behaviour", "Credit_History_Age",
        )
    )


def loan_vocabulary(clean: DataFrame) -> DataFrame:
    """Distinct loan types over all snapshots, sorted."""
    entry = F.explode(F.split("Type_of_Loan", r",\s*"))
    return (
        clean.select(entry.alias("loan_type"))
        .select(F.trim("loan_type").alias("loan_type"))
        .distinct()
        .orderBy("loan_type")
    )


def vocabulary_list(vocabulary: DataFrame) -> list[str]:
    """The vocabulary as column names need it: one entry per output column.

    More than ``config.MAX_COLUMNS`` entries raise an error, none is left out.
    """
    found = [row.loan_type for row in vocabulary.limit(config.MAX_COLUMNS + 1).collect()]
    if len(found) > config.MAX_COLUMNS:
        raise ValueError(f"Type_of_Loan has more than {config.MAX_COLUMNS} loan types")
    return found
