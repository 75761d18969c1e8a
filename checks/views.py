"""Loan-like views over the shared test tables.

The tables hold no loans, so each view shapes them into one of the inputs the
library works on. Every text runs unchanged in Spark SQL and in DuckDB; braces
stand for the test tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from creditmart.session import ensure_checkpoint_dir

TABLES = ["customer", "orders", "lineitem", "events"]
# Tables of short rows from which views make wide ones: a file of few row groups would leave that to few tasks.
SPREAD = ["customer"]
PARTS_PER_CORE = 2

LOANS = """
SELECT CAST(l_orderkey AS STRING) AS loan_id, CAST(o_custkey AS STRING) AS Customer_ID,
       CAST(date_trunc('month', o_orderdate) AS DATE) AS loan_start_date,
       10 AS tenure, l_linenumber AS installment_num,
       CAST(qty * 10 AS DOUBLE) AS loan_amt, CAST(qty AS DOUBLE) AS due_amt,
       CAST(qty - 1 AS DOUBLE) AS paid_amt,
       CAST(CASE WHEN rf = 'N' THEN 0 ELSE qty * (l_orderkey % 3) END AS DOUBLE)
         + CASE WHEN ls = 'F' AND rf = 'R' THEN 0.5E0 ELSE 0.0E0 END AS overdue_amt,
       CAST(qty * (10 - l_linenumber) AS DOUBLE) AS balance,
       CAST(CAST(date_trunc('month', o_orderdate) AS DATE) + INTERVAL '1' MONTH * l_linenumber AS DATE) AS snapshot_date
FROM (SELECT l_orderkey, l_linenumber, MAX(l_quantity) AS qty, MIN(l_returnflag) AS rf, MIN(l_linestatus) AS ls
      FROM {lineitem} GROUP BY l_orderkey, l_linenumber) l
JOIN {orders} ON l_orderkey = o_orderkey
"""

# The same loans as text, with unreadable, missing and negative amounts.
LOANS_RAW = f"""
SELECT loan_id, Customer_ID, CAST(loan_start_date AS STRING) AS loan_start_date,
       '10' AS tenure,
       CAST(installment_num AS STRING) || CASE WHEN installment_num % 2 = 0 THEN '.0' ELSE '' END AS installment_num,
       CAST(loan_amt AS STRING) AS loan_amt,
       CASE WHEN CAST(loan_id AS BIGINT) % 41 = 0 THEN 'n/a' WHEN CAST(loan_id AS BIGINT) % 37 = 0 THEN NULL
            WHEN CAST(loan_id AS BIGINT) % 31 = 0 THEN '0' ELSE CAST(due_amt AS STRING) END AS due_amt,
       CAST(paid_amt AS STRING) AS paid_amt,
       CASE WHEN CAST(loan_id AS BIGINT) % 29 = 0 THEN NULL WHEN CAST(loan_id AS BIGINT) % 23 = 0 THEN '-5'
            ELSE CAST(overdue_amt AS STRING) END AS overdue_amt,
       CAST(balance AS STRING) AS balance, CAST(snapshot_date AS STRING) AS snapshot_date
FROM ({LOANS}) loans
"""

_CLICK_COLUMNS = """
       CAST(user_id AS STRING) AS Customer_ID, CAST(CAST(ts AS DATE) AS STRING) AS snapshot_date,
       regexp_extract(props, '([0-9]+)', 1) AS fe_1,
       CASE WHEN event_type = 'error' THEN NULL ELSE CAST(CAST(floor(value) AS INT) AS STRING) END AS fe_2,
       CASE WHEN event_id % 13 = 0 THEN '4.0' WHEN event_id % 17 = 0 THEN ' 7 ' WHEN event_id % 19 = 0 THEN 'x'
            ELSE CAST(event_id % 97 AS STRING) END AS fe_3,
""" + ",\n".join(
    f"       CAST((event_id * {k} + user_id) % 89 - 20 AS STRING) AS fe_{k}" for k in range(4, 21)
)
CLICKS_RAW = f"""
SELECT {_CLICK_COLUMNS} FROM {{events}}
UNION ALL
SELECT {_CLICK_COLUMNS} FROM {{events}} WHERE event_id % 10 = 0
"""

# Clicks as they are delivered, most of them on a snapshot date of four months.
CLICKS_DELIVERED = f"""
SELECT Customer_ID,
       CASE WHEN CAST(Customer_ID AS BIGINT) % 5 = 0 THEN snapshot_date
            ELSE CAST(CAST(DATE '2024-01-01' + INTERVAL '1' MONTH * CAST(CAST(Customer_ID AS BIGINT) % 3 + CASE WHEN fe_4 LIKE '-%' THEN 1 ELSE 0 END AS INT) AS DATE) AS STRING) END AS snapshot_date,
       {", ".join(f"fe_{k}" for k in range(1, 21))}
FROM ({CLICKS_RAW}) clicks
"""

# Loans with extreme terms: a tiny overdue share, and more missed months than a calendar has.
LOANS_EXTREME = f"""
SELECT loan_id, Customer_ID, loan_start_date, tenure, installment_num, loan_amt,
       CASE WHEN CAST(loan_id AS BIGINT) % 3 = 0 THEN 3.0E7 WHEN CAST(loan_id AS BIGINT) % 3 = 1 THEN 0.001E0 ELSE due_amt END AS due_amt,
       paid_amt,
       CASE WHEN CAST(loan_id AS BIGINT) % 3 = 0 THEN 0.01E0 WHEN CAST(loan_id AS BIGINT) % 3 = 1 THEN 7.0E10 ELSE overdue_amt END AS overdue_amt,
       balance, snapshot_date
FROM ({LOANS}) loans
"""

# The raw loans as a file delivers them, on the snapshot dates of the other files.
LOANS_DELIVERED = f"""
SELECT loan_id, Customer_ID,
       CAST(CAST(DATE '2024-01-01' + INTERVAL '1' MONTH * CAST(CAST(Customer_ID AS BIGINT) % 3 AS INT) AS DATE) AS STRING) AS loan_start_date,
       tenure, installment_num, loan_amt, due_amt, paid_amt, overdue_amt, balance,
       CAST(CAST(DATE '2024-01-01' + INTERVAL '1' MONTH * CAST(CAST(Customer_ID AS BIGINT) % 3 + CAST(CAST(installment_num AS DOUBLE) AS INT) AS INT) AS DATE) AS STRING) AS snapshot_date
FROM ({LOANS_RAW}) loans
"""

ATTRIBUTES_RAW = """
SELECT CAST(c_custkey AS STRING) AS Customer_ID, c_name AS Name,
       '000-00-' || CAST(c_custkey AS STRING) AS SSN,
       CAST(c_custkey % 120 - 5 AS STRING) || CASE WHEN c_custkey % 7 = 0 THEN '_' ELSE '' END AS Age,
       CASE WHEN c_custkey % 11 = 0 THEN '_______' WHEN c_custkey % 13 = 0 THEN '  ' ELSE ' ' || c_mktsegment END AS Occupation,
       CAST(CAST(DATE '2024-01-01' + INTERVAL '1' MONTH * CAST(c_custkey % 3 AS INT) AS DATE) AS STRING) AS snapshot_date
FROM {customer}
"""

# A third of the customers have a second snapshot, with other values.
FINANCIALS_RAW = """
SELECT CAST(id AS STRING) AS Customer_ID,
       CASE WHEN k % 9 = 0 THEN '_' ELSE '' END || CAST(8000 + (k * 37) % 30000 AS STRING) || CASE WHEN k % 5 = 0 THEN '_' ELSE '' END AS Annual_Income,
       CASE WHEN k % 17 = 0 THEN NULL WHEN k % 19 = 0 THEN '0' WHEN k % 43 = 0 THEN '-200' ELSE CAST(1000 + k % 400 AS STRING) END AS Monthly_Inhand_Salary,
       CAST(k % 15 AS STRING) AS Num_Bank_Accounts,
       CAST(k % 14 AS STRING) || CASE WHEN k % 6 = 0 THEN '_' ELSE '' END AS Num_Credit_Card,
       CAST(k % 40 AS STRING) AS Interest_Rate,
       CAST(k % 6 - 1 AS STRING) || CASE WHEN k % 8 = 0 THEN '_' ELSE '' END AS Num_of_Loan,
       CASE k % 7 WHEN 0 THEN NULL WHEN 1 THEN 'Auto Loan' WHEN 2 THEN 'Auto Loan, and Payday Loan'
            WHEN 3 THEN CASE WHEN k % 2 = 0 THEN 'Student Loan, Auto Loan, and Auto Loan' ELSE 'Student Loan,, Auto Loan, ' END WHEN 4 THEN 'Credit-Builder Loan, Not Specified,  Home Equity Loan , and Mortgage Loan'
            WHEN 5 THEN 'Debt Consolidation Loan' ELSE '' END AS Type_of_Loan,
       CAST(k % 60 - 5 AS STRING) AS Delay_from_due_date,
       CAST(k % 33 - 2 AS STRING) || CASE WHEN k % 10 = 3 THEN '_' ELSE '' END AS Num_of_Delayed_Payment,
       CASE WHEN k % 21 = 0 THEN '_' ELSE CAST(k % 30 - 6 AS STRING) || '.25' END AS Changed_Credit_Limit,
       CAST(k % 20 AS STRING) || '.0' AS Num_Credit_Inquiries,
       CASE k % 4 WHEN 0 THEN '_' WHEN 1 THEN 'Good' WHEN 2 THEN ' Standard ' ELSE 'Bad' END AS Credit_Mix,
       CAST(k % 3000 - 10 AS STRING) AS Outstanding_Debt,
       CAST(k % 50 AS STRING) || '.5' AS Credit_Utilization_Ratio,
       CASE WHEN k % 23 = 0 THEN 'NA' ELSE CAST(k % 30 AS STRING) || ' Years and ' || CAST(k % 12 AS STRING) || ' Months' END AS Credit_History_Age,
       CASE k % 3 WHEN 0 THEN 'NM' WHEN 1 THEN 'Yes' ELSE 'No' END AS Payment_of_Min_Amount,
       CAST(k % 1500 AS STRING) AS Total_EMI_per_month,
       CASE WHEN k % 10 = 0 THEN '__10000__' ELSE CAST(k % 1700 AS STRING) END AS Amount_invested_monthly,
       CASE k % 3 WHEN 0 THEN '!@9#%8' WHEN 1 THEN 'High_spent_Small_value_payments' ELSE 'Low_spent_Large_value_payments' END AS Payment_Behaviour,
       CASE WHEN k % 50 = 0 THEN '__-333333333333333333333333333__' ELSE CAST(k % 900 - 30 AS STRING) END AS Monthly_Balance,
       CAST(CAST(DATE '2024-01-01' + INTERVAL '1' MONTH * CAST(id % 4 + later AS INT) AS DATE) AS STRING) AS snapshot_date
FROM (SELECT c_custkey AS id, c_custkey AS k, 0 AS later FROM {customer}
      UNION ALL SELECT c_custkey, c_custkey + 11, 1 FROM {customer} WHERE c_custkey % 3 = 0) snapshots
"""

# Financials of which the first two months know no payday loan.
FINANCIALS_GROWN = f"""
SELECT * FROM ({FINANCIALS_RAW}) financials
WHERE snapshot_date > '2024-02-01' OR Type_of_Loan IS NULL OR Type_of_Loan NOT LIKE '%Payday%'
"""

# Attributes as a source file delivers them: stray letters, other days, bad dates.
DELIVERED = f"""
SELECT Customer_ID, Name, SSN, Age, Occupation,
       CASE WHEN CAST(Customer_ID AS BIGINT) % 16 = 0 THEN snapshot_date || 'x'
            WHEN CAST(Customer_ID AS BIGINT) % 16 = 1 THEN 'x' || snapshot_date
            WHEN CAST(Customer_ID AS BIGINT) % 16 = 2 THEN snapshot_date || ' 00:00:00'
            WHEN CAST(Customer_ID AS BIGINT) % 16 = 3 THEN snapshot_date || ' 05:00:00'
            WHEN CAST(Customer_ID AS BIGINT) % 16 = 4 THEN substr(snapshot_date, 1, 8) || '15'
            WHEN CAST(Customer_ID AS BIGINT) % 16 = 5 THEN 'unknown'
            WHEN CAST(Customer_ID AS BIGINT) % 16 = 6 THEN NULL
            ELSE snapshot_date END AS snapshot_date
FROM ({ATTRIBUTES_RAW}) attributes
"""

# Feature rows for the loans above, with every kind of model column. The dates of a
# ninth of the customers lie years after their loans, so these find no features.
FEATURE_ROWS = """
SELECT CAST(o_custkey AS STRING) AS Customer_ID,
       CAST(CAST(date_trunc('month', o_orderdate) AS DATE) + INTERVAL '1' MONTH * (CASE WHEN o_custkey % 9 = 0 THEN 200 ELSE 0 END) AS DATE) AS snapshot_date,
       CAST(COUNT(*) AS INT) AS Num_Bank_Accounts,
       CASE WHEN MAX(o_orderkey) % 6 = 0 THEN NULL ELSE CAST(MAX(o_orderkey) % 80 + 1 AS INT) END AS Age,
       CASE WHEN MIN(o_orderkey) % 9 = 0 THEN NULL ELSE MAX(CAST(floor(o_totalprice) AS INT)) END AS Outstanding_Debt,
       MIN(o_orderpriority) AS Credit_Mix,
       CASE WHEN MIN(o_orderkey) % 12 = 0 THEN NULL WHEN MIN(o_orderkey) % 4 = 0 THEN 'Clerk' ELSE 'Not a Clerk' END AS Occupation,
       CASE WHEN MIN(o_orderpriority) = '5-LOW' THEN NULL ELSE MIN(o_orderstatus) = 'F' END AS age_invalid,
       MAX(o_orderkey) % 5 = 0 AS loan_types_missing,
       CASE WHEN MAX(o_orderstatus) = 'O' THEN 1 ELSE 0 END AS has_clickstream,
       CASE WHEN MAX(o_orderstatus) = 'O' THEN MAX(o_orderkey % 50) * 1.0E0 END AS fe_1_mean
FROM {orders}
GROUP BY o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE)
"""

VIEWS = {
    "loans": LOANS,
    "loans_raw": LOANS_RAW,
    "clicks_raw": CLICKS_RAW,
    "loans_extreme": LOANS_EXTREME,
    "clicks_delivered": CLICKS_DELIVERED,
    "loans_delivered": LOANS_DELIVERED,
    "financials_grown": FINANCIALS_GROWN,
    "attributes_raw": ATTRIBUTES_RAW,
    "financials_raw": FINANCIALS_RAW,
    "delivered": DELIVERED,
    "feature_rows": FEATURE_ROWS,
}


# Views written out for timing, by (folder of the test tables, name).
STORED: dict[tuple[str, str], str] = {}
# CSV files of views, likewise.
STORED_FILES: dict[tuple[str, str], str] = {}


def store(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Write the views out once, so that timings start from stored inputs."""
    for name in VIEWS:
        view(spark, sf_dir, name).write.mode("overwrite").parquet(f"{path}/{name}")
    STORED.update({(sf_dir, name): f"{path}/{name}" for name in VIEWS})


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if (sf_dir, name) in STORED:
        return spark.read.parquet(STORED[sf_dir, name])
    text = VIEWS[name]
    used = {t: table(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in text}
    return spark.sql(text, **used)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; one of short rows is dealt out to all cores.

    It is stored so, as filters on the wide rows would otherwise be judged before the dealing, in few tasks.
    """
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    if name not in SPREAD:
        return rows
    ensure_checkpoint_dir(spark)
    return rows.repartition(PARTS_PER_CORE * spark.sparkContext.defaultParallelism).checkpoint()


def view_sql(name: str) -> str:
    return VIEWS[name].format(**{t: t for t in TABLES})
