"""Raw text tables to typed, cleaned tables with quality flags.

Each function works on all snapshots at once and accepts a subset of the usual
columns; rules of absent columns are skipped. Stages are separate projections
because later rules look at cleaned values; none of them shuffles except the
removal of duplicate click rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmart import config
from creditmart.functions import columns as rule
from creditmart.functions.columns import quoted


def clicks(raw: DataFrame, prefix: str = "fe_") -> DataFrame:
    """Type the click counters and drop rows equal in every column."""
    counters = [name for name in raw.columns if name.startswith(prefix)]
    return raw.withColumns({
        **{name: quoted(name).try_cast("int") for name in counters},
        "Customer_ID": F.col("Customer_ID").try_cast("string"),
        "snapshot_date": F.col("snapshot_date").try_cast("date"),
    }).dropDuplicates()


def attributes(
    raw: DataFrame,
    pii: Sequence[str] = config.PII_COLUMNS,
    age_range: tuple[int, int] = config.AGE_RANGE,
) -> DataFrame:
    """Without personal columns; age in range or null with a flag; occupation or null."""
    age = rule.strip_trailing_underscores(F.col("Age")).try_cast("int")
    known = raw.drop(*pii).withColumns({
        "Age_raw": F.col("Age"),
        "snapshot_date_raw": F.col("snapshot_date"),
        "Age": age,
        "Occupation": rule.meaningful_text(F.col("Occupation")),
        "snapshot_date": F.col("snapshot_date").try_cast("date"),
    })
    return _ranged(known, {"Age": age_range})


def financials(
    raw: DataFrame,
    value_ranges: dict[str, tuple[float, float]] = config.VALUE_RANGES,
    salary_ratio_ranges: dict[str, tuple[float, float]] = config.SALARY_RATIO_RANGES,
) -> DataFrame:
    """Financials, typed and ranged. The order of the stages is part of the rules."""
    present = set(raw.columns)
    typed = _typed_financials(raw, present)
    counted = _loan_counts(typed)
    bounded = counted.withColumns({
        name: value for name, value in _bounded_values().items() if name in present
    })
    ranged = _ranged(bounded, {c: r for c, r in value_ranges.items() if c in present})
    related = _salary_ratios(ranged, {c: r for c, r in salary_ratio_ranges.items() if c in present})
    return related.withColumns({
        "Credit_Mix": rule.allowed(F.col("Credit_Mix"), config.CREDIT_MIXES),
        "Payment_of_Min_Amount": rule.allowed(
            F.col("Payment_of_Min_Amount"), config.MINIMUM_PAYMENTS
        ),
        "Payment_Behaviour": rule.matching(
            F.col("Payment_Behaviour"), config.PAYMENT_BEHAVIOUR_PATTERN
        ),
        "Credit_History_Months": rule.history_months(
            F.col("Credit_History_Age"), config.CREDIT_HISTORY_PATTERN
        ),
    })


def _typed_financials(raw: DataFrame, present: set[str]) -> DataFrame:
    def value(name: str, dtype: str):
        text = quoted(name)
        if dtype in ("int", "double"):
            text = rule.strip_underscores(text)
        if name == "Num_Credit_Inquiries":
            text = rule.without_point_zero(text)
        return text.try_cast(dtype)

    return raw.withColumns({
        "Num_of_Loan_raw": F.col("Num_of_Loan"),
        "snapshot_date_raw": F.col("snapshot_date"),
        **{
            name: value(name, dtype)
            for name, dtype in config.FINANCIAL_COLUMNS.items()
            if name in present
        },
        "Type_of_Loan": rule.loan_list(F.col("Type_of_Loan")),
    })


def _loan_counts(typed: DataFrame) -> DataFrame:
    """Compare the stated number of loans with the listed ones."""
    stated = F.col("Num_of_Loan")
    listed = typed.withColumns({
        "loan_types_missing": F.col("Type_of_Loan").isNull(),
        "listed_loan_count": rule.listed_entries(F.col("Type_of_Loan")),
    })
    status = (
        F.when(F.coalesce(stated < 0, F.lit(True)), "Invalid count")
        .when(F.col("loan_types_missing"), "Missing loan list")
        .when(stated == F.col("listed_loan_count"), "Match")
        .otherwise("Mismatch")
    )
    judged = listed.withColumn("loan_count_status", status)
    suspicious = F.col("loan_count_status").isin("Invalid count", "Mismatch") | (
        (F.col("loan_count_status") == "Missing loan list") & (stated > 0)
    )
    return judged.withColumn("loan_count_suspicious", suspicious).withColumn(
        "Num_of_Loan", F.when(~F.col("loan_count_suspicious"), stated)
    )


def _bounded_values() -> dict:
    """Negative amounts and placeholders become null."""
    kept = {name: F.col(name) >= 0 for name in config.NONNEGATIVE_COLUMNS}
    kept["Amount_invested_monthly"] &= F.col("Amount_invested_monthly") != config.INVESTED_PLACEHOLDER
    kept["Monthly_Balance"] = F.col("Monthly_Balance") > config.BALANCE_FLOOR
    return {name: F.when(condition, F.col(name)) for name, condition in kept.items()}


def _ranged(df: DataFrame, ranges: dict[str, tuple[float, float]]) -> DataFrame:
    """Flag missing or out-of-range values, and null them. The flag is never null."""
    changes = {}
    for name, (low, high) in ranges.items():
        valid = rule.within(F.col(name), low, high)
        changes[f"{name.lower()}_invalid"] = ~valid
        changes[name] = F.when(valid, F.col(name))
    return df.withColumns(changes)


def _salary_ratios(df: DataFrame, ranges: dict[str, tuple[float, float]]) -> DataFrame:
    """The same against the cleaned salary, with a three-valued flag.

    Without a usable salary the ratio of a present value is unknown: the flag
    is null, and the value is dropped because it could not be confirmed.
    """
    changes = {}
    for name, (low, high) in ranges.items():
        in_range = F.try_divide(F.col(name), F.col("Monthly_Inhand_Salary")).between(low, high)
        changes[f"{name.lower()}_invalid"] = F.col(name).isNull() | ~in_range
        changes[name] = F.when(in_range, F.col(name))
    return df.withColumns(changes)
