"""Hand rows for every cleaning and loan rule."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from creditmart import config
from creditmart.functions import columns as rule
from creditmart.operators import clean, features, loans
from creditmart.sources import raw, spine


def one_column(spark, values, expression):
    """The expression over rows ``v``, in the order of the values."""
    rows = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    return [row.r for row in rows.select("i", expression(F.col("v")).alias("r")).orderBy("i").collect()]


@pytest.mark.parametrize("text, age", [
    ("23_", 23), (" 23__ ", 23), ("100", 100), ("1", 1), ("_23", None), ("101", None),
    ("0", None), ("-500", None), ("8698", None), ("23.0", None), (None, None), ("", None),
])
def test_age(spark, text, age):
    raw_row = spark.createDataFrame(
        [("c", "n", "s", text, "job", "2023-01-01")],
        "Customer_ID string, Name string, SSN string, Age string, Occupation string, snapshot_date string",
    )
    row = clean.attributes(raw_row).first()
    assert (row.Age, row.age_invalid, row.Age_raw) == (age, age is None, text)
    assert "Name" not in row and "SSN" not in row


def test_occupation(spark):
    texts = ["_______", "  ", "", None, " Lawyer ", "_ _", "Media_Manager"]
    assert one_column(spark, texts, rule.meaningful_text) == [
        None, None, None, None, "Lawyer", "_ _", "Media_Manager"
    ]
    rows = spark.createDataFrame(
        [("Lawyer", "1", "d"), (None, "1", "d")], "Occupation string, Age_raw string, snapshot_date_raw string"
    )
    gold = features.attributes(rows).orderBy("occupation_missing").collect()
    assert [tuple(row) for row in gold] == [("Lawyer", False), ("Unknown", True)]


def test_dates(spark):
    texts = ["2023-1-1", "2023-01", "2023-01-01 05:00:00", "01/01/2023", "2023-02-30", None]
    first = dt.date(2023, 1, 1)
    assert one_column(spark, texts, lambda c: c.try_cast("date")) == [first, first, first, None, None, None]


def test_snapshot_selection(spark):
    texts = [
        "2023-01-01", "2023-1-1", "2023-01-01 00:00:00", "2023-01-01x", "x2023-02-01",
        "2023-01-01 05:00", "2023-01-15", "2023-03-01", "soon", None,
    ]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, snapshot_date string")
    kept = raw.select_snapshots(rows, ["2023-01-01", "2023-02-01"]).orderBy("i").collect()
    assert [row.i for row in kept] == [0, 1, 2, 3, 4]
    assert [row.snapshot_date for row in kept] == [
        "2023-01-01", "2023-1-1", "2023-01-01 00:00:00", "2023-01-01", "2023-02-01"
    ]
    assert {row.snapshot for row in kept} == {dt.date(2023, 1, 1), dt.date(2023, 2, 1)}


def test_spine(spark):
    dates = spine.month_starts("2022-11-20", "2023-02-01")
    assert dates == [dt.date(2022, 11, 1), dt.date(2022, 12, 1), dt.date(2023, 1, 1), dt.date(2023, 2, 1)]
    assert [r[0] for r in spine.spine_frame(spark, "2022-11-20", "2023-02-01").collect()] == dates
    assert len(spine.month_starts("2023-01-01", "2024-12-01")) == 24
    assert spine.month_starts("2023-02-01", "2023-01-01") == []


def test_whole_numbers(spark):
    texts = ["6", "6.0", " 6.9 ", "-3", "+4", "1e3", "99999999999", "n/a", "", None]
    assert one_column(spark, texts, rule.truncating_int) == [6, 6, 6, -3, 4, None, None, None, None, None]
    assert one_column(spark, ["4.0", " 4 ", "99999999999"], lambda c: c.try_cast("int")) == [None, 4, None]
    assert one_column(spark, ["4.0", "4", "4.5", "10.0"], rule.without_point_zero) == ["4", "4", "4.5", "10"]


def test_underscores(spark):
    texts = ["_12_", " __-5.5__ ", "1_2", "___", None]
    assert one_column(spark, texts, rule.strip_underscores) == ["12", "-5.5", "1_2", "", None]


@pytest.mark.parametrize("text, count", [
    ("Auto Loan, Credit-Builder Loan, Personal Loan, and Home Equity Loan", 4),
    ("Auto Loan, and Auto Loan", 2), ("Payday Loan and Auto Loan", 1), ("A,,B", 2),
    ("A, ,B ,", 2), ("  ", None), ("", None), (None, None),
])
def test_loan_lists(spark, text, count):
    cleaned = one_column(spark, [text], lambda c: rule.listed_entries(rule.loan_list(c)))
    assert cleaned == [count]


def test_entry_counts(spark):
    texts = ["Auto Loan, Payday Loan, Auto Loan", "Auto Loan", "Auto Loan Plus, My Auto Loan", " Auto Loan ,Auto Loan", None]
    assert one_column(
        spark, texts, lambda c: rule.entry_count(rule.padded_list(c), "Auto Loan")
    ) == [2, 1, 0, 2, None]
    blank = ["A, B", "A,, B", "A, ", ",A", "A,  ,B", "A"]
    assert one_column(spark, blank, lambda c: rule.entry_count(rule.padded_list(c), "")) == [0, 1, 1, 1, 1, 0]


def test_credit_history(spark):
    texts = ["2 Years and 3 Months", "1 Year and 1 Month", "22 Years 3 Months", "NA", None, "99999999999 Years and 1 Months"]
    assert one_column(
        spark, texts, lambda c: rule.history_months(c, config.CREDIT_HISTORY_PATTERN)
    ) == [27, 13, None, None, None, None]


def test_categories(spark):
    mixes = one_column(spark, [" Good ", "_", "good", None], lambda c: rule.allowed(c, config.CREDIT_MIXES))
    assert mixes == ["Good", None, None, None]
    behaviours = one_column(
        spark, ["High_spent_Small_value_payments", " High_spent_Small_value_payments", "!@9#%8"],
        lambda c: rule.matching(c, config.PAYMENT_BEHAVIOUR_PATTERN),
    )
    assert behaviours == ["High_spent_Small_value_payments", None, None]


LOAN = "Auto Loan, and Payday Loan"
FINANCIAL_ROWS = [
    # income, salary, rate, inquiries, loans, list, instalments, invested, balance
    ("_24000_", "2000", "34", "4.0", "2", LOAN, "500", "100", "-50"),
    ("24000", None, "35", "18.0", "2_", LOAN, "500", "__10000__", "__-333333333333333333333333333__"),
    ("24000", "0", "-1", "4", "0", None, "500", "-5", "10"),
    ("70000", "2000", None, "4.5", "3", None, "2500", "10000.0", "10"),
    ("60000", "2000", "0", "17.0", "-100", "Auto Loan", "2000", "0", "10"),
    ("60000.01", "2000", "abc", "", "1", "Auto Loan, Auto Loan, and Auto Loan", "-1", "12", "10"),
    (None, "-2000", "5", "1.0", None, "Auto Loan", None, None, None),
]
FINANCIAL_EXPECTED = [
    # income (flag), salary, rate (flag), inquiries (flag), loans, status, suspicious, instalments (flag), invested, balance
    (24000.0, False, 2000.0, 34.0, False, 4, False, 2, "Match", False, 500.0, False, 100.0, -50.0),
    (None, None, None, None, True, None, True, 2, "Match", False, None, None, None, None),
    (None, None, 0.0, None, True, 4, False, 0, "Missing loan list", False, None, None, None, 10.0),
    (None, True, 2000.0, None, True, None, True, None, "Missing loan list", True, None, True, None, 10.0),
    (60000.0, False, 2000.0, 0.0, False, 17, False, None, "Invalid count", True, 2000.0, False, 0.0, 10.0),
    (None, True, 2000.0, None, True, None, True, None, "Mismatch", True, None, True, 12.0, 10.0),
    (None, True, None, 5.0, False, 1, False, None, "Invalid count", True, None, True, None, None),
]


def raw_financials(spark, rows):
    schema = ["Annual_Income", "Monthly_Inhand_Salary", "Interest_Rate", "Num_Credit_Inquiries", "Num_of_Loan",
              "Type_of_Loan", "Total_EMI_per_month", "Amount_invested_monthly", "Monthly_Balance"]
    text = ", ".join(f"{name} string" for name in ["i", *schema])
    frame = spark.createDataFrame([(str(i), *row) for i, row in enumerate(rows)], text)
    rest = {
        "Customer_ID": "i", "Outstanding_Debt": "'-1'", "Credit_Mix": "'Good'", "Payment_of_Min_Amount": "'NM'",
        "Payment_Behaviour": "'High_spent_Small_value_payments'", "Credit_History_Age": "'NA'",
        "snapshot_date": "'2023-01-01'",
    }
    return frame.withColumns({name: F.expr(value) for name, value in rest.items()})


def test_financials_in_order(spark):
    silver = clean.financials(raw_financials(spark, FINANCIAL_ROWS)).orderBy("i").select(
        "Annual_Income", "annual_income_invalid", "Monthly_Inhand_Salary", "Interest_Rate", "interest_rate_invalid",
        "Num_Credit_Inquiries", "num_credit_inquiries_invalid", "Num_of_Loan", "loan_count_status",
        "loan_count_suspicious", "Total_EMI_per_month", "total_emi_per_month_invalid",
        "Amount_invested_monthly", "Monthly_Balance",
    )
    assert [tuple(row) for row in silver.collect()] == FINANCIAL_EXPECTED


def test_cleaning_keeps_clean_values(spark):
    row = clean.financials(raw_financials(spark, FINANCIAL_ROWS[:1])).first()
    assert row.Outstanding_Debt is None and row.Payment_of_Min_Amount is None
    assert row.Type_of_Loan == "Auto Loan, Payday Loan" and row.listed_loan_count == 2
    assert row.snapshot_date == dt.date(2023, 1, 1) and row.Num_of_Loan_raw == "2"


def test_financial_features(spark):
    silver = clean.financials(raw_financials(spark, FINANCIAL_ROWS))
    gold = features.financials(silver).orderBy("Customer_ID").collect()
    first, third = gold[0], gold[2]
    assert first.months12_to_annual_income_ratio == 1.0 and first.EMI_to_Salary_Ratio == 0.25
    assert first.Disposable_Income == 1400.0 and first.Debt_to_Income is None
    assert (first.Loan_Auto_Loan, first.Loan_Payday_Loan, first.Loan_Credit_Builder_Loan) == (1, 1, 0)
    assert (first.Spending_Behaviour, first.Payments_Size) == ("High", "Small")
    assert first.Payment_of_Min_Amount == "Unknown" and first.Monthly_Balance_log1p is None
    assert third.Loan_Auto_Loan is None and third.EMI_to_Salary_Ratio is None
    assert gold[5].Loan_Auto_Loan == 3
    assert "Type_of_Loan" not in first and "Num_of_Loan_raw" not in first


def test_column_counts(spark):
    """22 source columns give 36 cleaned ones and, with nine loan types, 51 features beside the keys."""
    raw_row = spark.range(1).select(*[
        F.lit("1").alias(name) for name in config.FINANCIAL_COLUMNS
    ])
    silver = clean.financials(raw_row)
    assert len(silver.columns) == 36
    assert len(features.financials(silver).columns) - len(config.KEYS) == 50


def test_vocabulary(spark):
    rows = spark.createDataFrame([("B, A",), (None,), ("A ,C",)], "Type_of_Loan string")
    assert features.vocabulary_list(features.loan_vocabulary(rows)) == ["A", "B", "C"]


@pytest.mark.parametrize("snapshot, overdue, due, missed, first, dpd", [
    ("2023-05-01", "0", "100", 0, None, 0),
    ("2023-05-01", "150", "100", 2, dt.date(2023, 3, 1), 61),
    ("2023-05-01", "150", "0", None, None, None),
    ("2023-05-01", "100", None, None, None, None),
    ("2023-05-01", None, "100", None, None, 0),
    ("2023-05-01", "-5", "100", 0, None, 0),
    ("2023-03-01", "100", "100", 1, dt.date(2023, 2, 1), 28),
    ("2024-03-01", "100", "100", 1, dt.date(2024, 2, 1), 29),
    ("2023-04-01", "100", "100", 1, dt.date(2023, 3, 1), 31),
    ("2023-05-01", "100", "100", 1, dt.date(2023, 4, 1), 30),
    ("2023-03-31", "100", "100", 1, dt.date(2023, 2, 28), 31),
    ("2023-05-01", "2640.3", "880.1", 3, dt.date(2023, 2, 1), 89),
    ("2023-05-01", "1e12", "0.01", 2**31 - 1, dt.date(1, 1, 1), (dt.date(2023, 5, 1) - dt.date(1, 1, 1)).days),
    ("2023-05-01", "7e10", "1000", 70_000_000, dt.date(1, 1, 1), (dt.date(2023, 5, 1) - dt.date(1, 1, 1)).days),
    ("2023-05-01", "0.01", "3e7", 1, dt.date(2023, 4, 1), 30),
])
def test_delinquency(spark, snapshot, overdue, due, missed, first, dpd):
    text = spark.createDataFrame(
        [("l", "c", "2023-01-01", "10", "6.0", "1000", due, "0", overdue, "0", snapshot)],
        ", ".join(f"{name} string" for name in config.LOAN_COLUMNS),
    )
    row = loans.delinquency(loans.typed(text)).first()
    assert (row.mob, row.installments_missed, row.first_missed_date, row.dpd) == (6, missed, first, dpd)
    label = loans.default_label(loans.delinquency(loans.typed(text))).first()
    assert label.label == int(dpd is not None and dpd >= 30) and label.label_def == "30dpd_6mob"


def test_clicks(spark):
    rows = [("c", "1", None, "2023-01-01")] * 3 + [("c", "4.0", " 4 ", "2023-01-01"), ("c", None, "x", "bad")]
    silver = clean.clicks(spark.createDataFrame(rows, "Customer_ID string, fe_1 string, fe_2 string, snapshot_date string"))
    found = {tuple(row) for row in silver.collect()}
    day = dt.date(2023, 1, 1)
    assert found == {("c", 1, None, day), ("c", None, 4, day), ("c", None, None, None)}
