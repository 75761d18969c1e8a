"""DuckDB SQL for the registered queries.

Written from the rules, with other means than the Spark side where there is a
choice: joins on ranges instead of running sums, list functions instead of
counting, windows over rows instead of hash boundaries.
"""

from __future__ import annotations

import re

from checks.views import VIEWS, view_sql
from creditmart import config

COUNTERS = [f"fe_{k}" for k in range(1, 21)]
FIN_DOUBLES = [c for c, t in config.FINANCIAL_COLUMNS.items() if t == "double"]
FIN_INTS = [c for c, t in config.FINANCIAL_COLUMNS.items() if t == "int"]
FIN_FLAGS = [f"{c.lower()}_invalid" for c in [*config.VALUE_RANGES, *config.SALARY_RATIO_RANGES]]
FIN_GOLD_DOUBLES = [
    *FIN_DOUBLES, "months12_to_annual_income_ratio", "EMI_to_Salary_Ratio", "Debt_to_Income",
    "Disposable_Income", *[f"{c}_log1p" for c in config.LOG_COLUMNS],
]


def loan_type_column(name: str) -> str:
    return "Loan_" + name.replace(" ", "_").replace("-", "_")


LOAN_TYPE_COLUMNS = [loan_type_column(name) for name in config.LOAN_TYPES]
ATTR_GOLD = ["Customer_ID", "snapshot_date", "Age", "Occupation", "age_invalid", "occupation_missing"]
FIN_GOLD = [
    "Customer_ID", "snapshot_date", *FIN_GOLD_DOUBLES, *FIN_INTS, *FIN_FLAGS, "Credit_Mix",
    "Payment_of_Min_Amount", "Spending_Behaviour", "Payments_Size", "Credit_History_Months",
    "loan_types_missing", "listed_loan_count", "loan_count_status", "loan_count_suspicious",
    *LOAN_TYPE_COLUMNS,
]
CLICK_GOLD = [
    "Customer_ID", "snapshot_date", *[f"{c}_mean" for c in COUNTERS], "clickstream_days",
    "has_clickstream",
]
JOINED = list(dict.fromkeys([*ATTR_GOLD, "has_attributes", *FIN_GOLD, "has_financials", *CLICK_GOLD]))


# -- pieces of SQL --------------------------------------------------------


def stripped(column: str) -> str:
    return f"trim(trim({column}), '_')"


def strict_int(text: str) -> str:
    return (
        f"CASE WHEN regexp_matches({text}, '^\\s*[+-]?[0-9]+\\s*$') "
        f"THEN TRY_CAST({text} AS INTEGER) END"
    )


def whole_part(text: str) -> str:
    return f"TRY_CAST(regexp_extract(trim({text}), '^([+-]?[0-9]+)(\\.[0-9]*)?$', 1) AS INTEGER)"


def number(column: str) -> str:
    return f"TRY_CAST({stripped(column)} AS DOUBLE)"


def joined_by_comma(*parts: str) -> str:
    return ",\n  ".join(parts)


LIST_PARTS = "string_split_regex(Type_of_Loan, ',\\s*')"

PIECES: dict[str, str] = {name: view_sql(name) for name in VIEWS}



def missed_sql(overdue: str = "overdue_amt", due: str = "due_amt") -> str:
    """Any overdue share of a known instalment counts as one; the column ends at 2^31 - 1."""
    return f"""CASE WHEN {overdue} = 0 THEN 0 WHEN {due} > 0 AND {overdue} > 0
        THEN CAST(least(greatest(ceil(round({overdue} / {due}, 9)), 1), 2147483647) AS INTEGER)
        WHEN {due} > 0 THEN CAST(ceil(round({overdue} / {due}, 9)) AS INTEGER) END"""


def first_missed_sql(missed: str) -> str:
    """Not before the first year."""
    return f"""CASE WHEN {missed} > 0 THEN CAST(snapshot_date - INTERVAL '1' MONTH
        * CAST(least({missed}, (year(snapshot_date) - 1) * 12 + month(snapshot_date) - 1) AS INTEGER) AS DATE) END"""


def loans_silver_sql(source: str) -> str:
    return f"""
WITH typed AS (
  SELECT loan_id, Customer_ID, TRY_CAST(loan_start_date AS DATE) AS loan_start_date,
    {whole_part('tenure')} AS tenure, {whole_part('installment_num')} AS installment_num,
    {joined_by_comma(*[f"TRY_CAST({c} AS DOUBLE) AS {c}" for c in ("loan_amt", "due_amt", "paid_amt", "overdue_amt", "balance")])},
    TRY_CAST(snapshot_date AS DATE) AS snapshot_date
  FROM {source}
), missed AS (
  SELECT *, installment_num AS mob, {missed_sql()} AS installments_missed FROM typed
), dated AS (
  SELECT *, {first_missed_sql('installments_missed')} AS first_missed_date FROM missed
)
SELECT *, CAST(CASE WHEN overdue_amt > 0 THEN date_diff('day', first_missed_date, snapshot_date) ELSE 0 END AS INTEGER) AS dpd
FROM dated
"""


def loans_exact_sql(source: str) -> str:
    return f"""
WITH missed AS (
  SELECT *, installment_num AS mob, {missed_sql()} AS installments_missed FROM {source}
), dated AS (
  SELECT *, {first_missed_sql('installments_missed')} AS first_missed_date FROM missed
)
SELECT *, CAST(CASE WHEN overdue_amt > 0 THEN date_diff('day', first_missed_date, snapshot_date) ELSE 0 END AS INTEGER) AS dpd
FROM dated
"""


PIECES["loans_silver"] = loans_silver_sql("loans_raw")
PIECES["delivered_silver"] = f"SELECT * FROM ({loans_silver_sql('loans_delivered')}) silver WHERE snapshot_date <= DATE '2024-10-01'"
PIECES["loans_exact"] = loans_exact_sql("loans")
PIECES["extremes"] = loans_exact_sql("loans_extreme")


def label_sql(source: str, dpd: int = 30, mob: int = 6) -> str:
    return f"""
SELECT loan_id, Customer_ID, loan_start_date, CASE WHEN dpd >= {dpd} THEN 1 ELSE 0 END AS label,
       '{dpd}dpd_{mob}mob' AS label_def, snapshot_date
FROM {source} WHERE mob = {mob}
"""


PIECES["loan_labels"] = label_sql("loans_exact")

def clicks_silver_sql(source: str) -> str:
    return f"""
SELECT DISTINCT Customer_ID, CAST(snapshot_date AS DATE) AS snapshot_date,
  {joined_by_comma(*[f"{strict_int(c)} AS {c}" for c in COUNTERS])}
FROM {source}
"""


PIECES["clicks_silver"] = clicks_silver_sql("clicks_raw")



def attributes_sql(source: str) -> str:
    return f"""
WITH read AS (
  SELECT Customer_ID, Age AS Age_raw, trim(Occupation) AS job, snapshot_date AS snapshot_date_raw,
    regexp_replace(trim(Age), '_+$', '') AS age_text
  FROM {source}
), typed AS (SELECT *, {strict_int('age_text')} AS age FROM read)
SELECT Customer_ID, Age_raw, snapshot_date_raw, CAST(snapshot_date_raw AS DATE) AS snapshot_date,
  CASE WHEN age >= 1 AND age <= 100 THEN age END AS Age,
  age IS NULL OR age < 1 OR age > 100 AS age_invalid,
  CASE WHEN job = '' OR regexp_full_match(job, '_+') THEN NULL ELSE job END AS Occupation
FROM typed
"""


PIECES["attributes_silver"] = attributes_sql("attributes_raw")

_FIN_TYPED = []
for _c in FIN_DOUBLES:
    _FIN_TYPED.append(f"TRY_CAST(regexp_replace(trim({_c}), '^_+|_+$', '', 'g') AS DOUBLE) AS {_c}")
for _c in FIN_INTS:
    _text = f"regexp_replace(trim({_c}), '^_+|_+$', '', 'g')"
    if _c == "Num_Credit_Inquiries":
        _text = f"regexp_replace({_text}, '\\.0$', '')"
    _FIN_TYPED.append(f"{strict_int(_text)} AS {_c}")

_RANGED = {
    **{c: f"{c} BETWEEN {low} AND {high}" for c, (low, high) in config.VALUE_RANGES.items()},
    **{
        c: f"{c} / nullif(Monthly_Inhand_Salary, 0) BETWEEN {low} AND {high}"
        for c, (low, high) in config.SALARY_RATIO_RANGES.items()
    },
}


def financials_silver_sql(source: str) -> str:
    return f"""
WITH typed AS (
  SELECT Customer_ID, {joined_by_comma(*_FIN_TYPED)},
    Num_of_Loan AS Num_of_Loan_raw, snapshot_date AS snapshot_date_raw, CAST(snapshot_date AS DATE) AS snapshot_date,
    nullif(regexp_replace(trim(Type_of_Loan), ',\\s*and\\s+', ', ', 'g'), '') AS Type_of_Loan,
    Credit_Mix, Payment_of_Min_Amount, Payment_Behaviour, Credit_History_Age
  FROM {source}
), counted AS (
  SELECT *, Type_of_Loan IS NULL AS loan_types_missing,
    CASE WHEN Type_of_Loan IS NOT NULL
      THEN CAST(len(list_filter({LIST_PARTS}, lambda x: length(trim(x)) > 0)) AS INTEGER) END AS listed_loan_count
  FROM typed
), judged AS (
  SELECT *, CASE WHEN Num_of_Loan IS NULL OR Num_of_Loan < 0 THEN 'Invalid count'
      WHEN loan_types_missing THEN 'Missing loan list'
      WHEN Num_of_Loan = listed_loan_count THEN 'Match' ELSE 'Mismatch' END AS loan_count_status
  FROM counted
), bounded AS (
  SELECT * REPLACE (
      CASE WHEN Monthly_Inhand_Salary >= 0 THEN Monthly_Inhand_Salary END AS Monthly_Inhand_Salary,
      CASE WHEN Outstanding_Debt >= 0 THEN Outstanding_Debt END AS Outstanding_Debt,
      CASE WHEN Amount_invested_monthly >= 0 AND Amount_invested_monthly <> 10000 THEN Amount_invested_monthly END AS Amount_invested_monthly,
      CASE WHEN Monthly_Balance > -1000000000 THEN Monthly_Balance END AS Monthly_Balance),
    loan_count_status IN ('Invalid count', 'Mismatch') OR (loan_types_missing AND Num_of_Loan > 0) AS loan_count_suspicious
  FROM judged
)
SELECT * REPLACE (
    {joined_by_comma(*[f"CASE WHEN {test} THEN {c} END AS {c}" for c, test in _RANGED.items()])},
    CASE WHEN NOT loan_count_suspicious THEN Num_of_Loan END AS Num_of_Loan,
    CASE WHEN trim(Credit_Mix) IN ('Standard', 'Good', 'Bad') THEN trim(Credit_Mix) END AS Credit_Mix,
    CASE WHEN trim(Payment_of_Min_Amount) IN ('Yes', 'No') THEN trim(Payment_of_Min_Amount) END AS Payment_of_Min_Amount,
    CASE WHEN regexp_matches(Payment_Behaviour, '{config.PAYMENT_BEHAVIOUR_PATTERN}') THEN Payment_Behaviour END AS Payment_Behaviour),
  {joined_by_comma(*[f"{c} IS NULL OR NOT ({test}) AS {c.lower()}_invalid" for c, test in _RANGED.items()])},
  CASE WHEN regexp_matches(Credit_History_Age, '{config.CREDIT_HISTORY_PATTERN}')
    THEN TRY_CAST(split_part(Credit_History_Age, ' ', 1) AS INTEGER) * 12 + TRY_CAST(split_part(Credit_History_Age, ' ', 4) AS INTEGER) END AS Credit_History_Months
FROM bounded
"""


PIECES["financials_silver"] = financials_silver_sql("financials_raw")
PIECES["grown_silver"] = financials_silver_sql("financials_grown")



def attributes_gold_sql(source: str) -> str:
    return f"""
SELECT Customer_ID, snapshot_date, Age, age_invalid, Occupation IS NULL AS occupation_missing,
       COALESCE(Occupation, 'Unknown') AS Occupation
FROM {source}
"""


PIECES["attributes_gold"] = attributes_gold_sql("attributes_silver")

def financials_gold_sql(source: str, types: list[str]) -> str:
    return f"""
SELECT * EXCLUDE (Num_of_Loan_raw, snapshot_date_raw, Type_of_Loan, Payment_Behaviour, Credit_History_Age)
  REPLACE (COALESCE(Credit_Mix, 'Unknown') AS Credit_Mix, COALESCE(Payment_of_Min_Amount, 'Unknown') AS Payment_of_Min_Amount),
  CASE WHEN Annual_Income > 0 THEN Monthly_Inhand_Salary * 12 / Annual_Income END AS months12_to_annual_income_ratio,
  CASE WHEN Monthly_Inhand_Salary > 0 THEN Total_EMI_per_month / Monthly_Inhand_Salary END AS EMI_to_Salary_Ratio,
  CASE WHEN Annual_Income > 0 THEN Outstanding_Debt / Annual_Income END AS Debt_to_Income,
  Monthly_Inhand_Salary - Total_EMI_per_month - Amount_invested_monthly AS Disposable_Income,
  {joined_by_comma(*[
      f"CASE WHEN NOT loan_types_missing THEN CAST(len(list_filter({LIST_PARTS}, lambda x: trim(x) = '{name}')) AS INTEGER) END AS {loan_type_column(name)}"
      for name in types])},
  COALESCE(split_part(Payment_Behaviour, '_', 1), 'Unknown') AS Spending_Behaviour,
  COALESCE(split_part(Payment_Behaviour, '_', 3), 'Unknown') AS Payments_Size,
  {joined_by_comma(*[f"CASE WHEN {c} >= 0 THEN ln(1 + {c}) END AS {c}_log1p" for c in config.LOG_COLUMNS])}
FROM {source}
"""


PIECES["financials_gold"] = financials_gold_sql("financials_silver", config.LOAN_TYPES)


def history_sql(days: list[str], clicks: str = "clicks_silver") -> str:
    spine = ", ".join(f"(DATE '{day}')" for day in days)
    return f"""
SELECT c.Customer_ID, {joined_by_comma(*[f"avg({c}) AS {c}_mean" for c in COUNTERS])},
  count(DISTINCT c.snapshot_date) AS clickstream_days, 1 AS has_clickstream, s.day AS snapshot_date
FROM (VALUES {spine}) s(day) JOIN {clicks} c ON c.snapshot_date < s.day
GROUP BY c.Customer_ID, s.day
"""


PIECES["clicks_gold"] = history_sql(["2024-01-01", "2024-02-01", "2024-03-01", "2024-04-01"])



def joined_sql(attr: str, fin: str, click: str) -> str:
    return f"""
SELECT * REPLACE (COALESCE(has_attributes, 0) AS has_attributes, COALESCE(has_financials, 0) AS has_financials,
    COALESCE(has_clickstream, 0) AS has_clickstream, COALESCE(clickstream_days, 0) AS clickstream_days)
FROM (SELECT *, 1 AS has_attributes FROM {attr}) a
FULL OUTER JOIN (SELECT *, 1 AS has_financials FROM {fin}) f USING (Customer_ID, snapshot_date)
LEFT JOIN {click} USING (Customer_ID, snapshot_date)
"""


PIECES["joined"] = joined_sql("attributes_gold", "financials_gold", "clicks_gold")

# The same from the delivered files, by way of the layers: only snapshot rows count.
FOUR_MONTHS = ["2024-01-01", "2024-02-01", "2024-03-01", "2024-04-01"]
_IN_SPINE = "snapshot_date IN (" + ", ".join(f"DATE '{day}'" for day in FOUR_MONTHS) + ")"
PIECES["ingested"] = """
SELECT * REPLACE (left(replace(snapshot_date, 'x', ''), 10) AS snapshot_date) FROM delivered
WHERE regexp_full_match(replace(snapshot_date, 'x', ''), '2024-0[1-4]-01( 00:00:00)?')
"""
PIECES["ingested_silver"] = attributes_sql("ingested")
PIECES["ingested_gold"] = attributes_gold_sql("ingested_silver")
ALL_MONTHS = [f"2024-{month:02d}-01" for month in range(1, 11)]
_IN_ALL = "snapshot_date IN (" + ", ".join(f"DATE '{day}'" for day in ALL_MONTHS) + ")"
# Loan types as the lists have them, the blank entry included.
SEEN_TYPES = ["", *[t for t in config.LOAN_TYPES if t != "Personal Loan"]]
PIECES["delivered_clicks"] = clicks_silver_sql("clicks_delivered")
PIECES["snapshot_clicks"] = f"SELECT * FROM delivered_clicks WHERE {_IN_ALL}"
PIECES["snapshot_history"] = history_sql(ALL_MONTHS, "snapshot_clicks")
PIECES["seen_financials"] = financials_gold_sql("financials_silver", SEEN_TYPES)
PIECES["snapshot_financials"] = f"SELECT * FROM seen_financials WHERE {_IN_ALL}"
PIECES["backfilled"] = joined_sql("ingested_gold", "snapshot_financials", "snapshot_history")
# Two runs: the second knows one more loan type and click column.
_EARLY = "snapshot_date <= DATE '2024-02-01'"
PIECES["grown_clicks"] = f"SELECT DISTINCT * REPLACE (CASE WHEN {_EARLY} THEN NULL ELSE fe_20 END AS fe_20) FROM delivered_clicks WHERE {_IN_SPINE}"
PIECES["grown_history"] = history_sql(FOUR_MONTHS, "grown_clicks")
PIECES["grown_gold"] = financials_gold_sql("grown_silver", SEEN_TYPES)
PIECES["grown_financials"] = f"SELECT * FROM grown_gold WHERE {_IN_SPINE}"
PIECES["second_run"] = joined_sql("ingested_gold", "grown_financials", "grown_history")

PIECES["one_run_history"] = history_sql(FOUR_MONTHS, f"(SELECT * FROM delivered_clicks WHERE {_IN_SPINE})")
PIECES["one_run"] = joined_sql("ingested_gold", "grown_financials", "one_run_history")
# Cutoffs at which all clicks before have arrived in time.
PIECES["kept_history"] = history_sql([*ALL_MONTHS[:2], *ALL_MONTHS[4:]], "snapshot_clicks")

PIECES["labelled"] = """
SELECT l.* EXCLUDE (snapshot_date), l.snapshot_date AS label_snapshot_date,
       f.* EXCLUDE (Customer_ID, snapshot_date), f.snapshot_date AS feature_snapshot_date
FROM loan_labels l JOIN feature_rows f ON l.Customer_ID = f.Customer_ID AND l.loan_start_date = f.snapshot_date
"""

PIECES["oot"] = """
SELECT loan_start_date, loans FROM (
  SELECT loan_start_date, count(*) AS loans, row_number() OVER (ORDER BY loan_start_date DESC) AS place, count(*) OVER () AS dates
  FROM labelled GROUP BY loan_start_date)
WHERE place <= ceil(dates * 0.2)
"""

PIECES["split_rows"] = """
WITH earlier AS (
  SELECT *, CAST('0x' || left(md5(concat_ws('|', '55', loan_id, Customer_ID, CAST(loan_start_date AS VARCHAR),
      CAST(label_snapshot_date AS VARCHAR), CAST(label AS VARCHAR))), 15) AS BIGINT) AS h
  FROM labelled WHERE loan_start_date < (SELECT min(loan_start_date) FROM oot)
), sizes AS (
  SELECT label, count(*) AS n, sum(count(*)) OVER () AS total FROM earlier GROUP BY label
), shares AS (
  SELECT label, n * ceil(0.2 * total) / total AS exact, ceil(0.2 * total) AS wanted FROM sizes
), quotas AS (
  SELECT label, floor(exact) + CASE WHEN row_number() OVER (ORDER BY exact - floor(exact) DESC, label)
      <= wanted - sum(floor(exact)) OVER () THEN 1 ELSE 0 END AS quota
  FROM shares
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY h, loan_id) AS place FROM earlier
)
SELECT p.* EXCLUDE (h, place), CASE WHEN place <= quota THEN 'test' ELSE 'train' END AS split FROM placed p JOIN quotas USING (label)
UNION ALL BY NAME
SELECT *, 'oot' AS split FROM labelled WHERE loan_start_date >= (SELECT min(loan_start_date) FROM oot)
"""

PIECES["fills"] = """
SELECT CAST(avg(Age) AS DOUBLE) AS age_fill, CAST(avg(Num_Bank_Accounts) AS DOUBLE) AS accounts_fill,
  CAST(median(Outstanding_Debt) AS DOUBLE) AS debt_fill, CAST(median(has_clickstream) AS DOUBLE) AS has_fill,
  avg(fe_1_mean) FILTER (WHERE has_clickstream = 1) AS fe_fill
FROM split_rows WHERE split = 'train'
"""

PIECES["filled_rows"] = """
SELECT r.* REPLACE (COALESCE(CAST(Age AS DOUBLE), age_fill) AS Age,
    COALESCE(CAST(Num_Bank_Accounts AS DOUBLE), accounts_fill) AS Num_Bank_Accounts,
    COALESCE(CAST(Outstanding_Debt AS DOUBLE), debt_fill) AS Outstanding_Debt,
    COALESCE(CAST(has_clickstream AS DOUBLE), has_fill) AS has_clickstream,
    COALESCE(fe_1_mean, fe_fill) AS fe_1_mean)
FROM split_rows r, fills
"""

SCALED = ["Num_Bank_Accounts", "Age", "Outstanding_Debt", "has_clickstream", "fe_1_mean"]
PIECES["scales"] = f"""
SELECT {joined_by_comma(*[f"avg({c}) AS {c}_m, CASE WHEN stddev_pop({c}) < 1e-12 THEN 1 ELSE stddev_pop({c}) END AS {c}_s" for c in SCALED])}
FROM filled_rows WHERE split = 'train'
"""

PIECES["income_pairs"] = """
SELECT Customer_ID, snapshot_date, Annual_Income, Monthly_Inhand_Salary,
  Monthly_Inhand_Salary * 12 AS annualized_salary, Monthly_Inhand_Salary * 12 / Annual_Income AS ratio,
  Monthly_Inhand_Salary * 12 / Annual_Income - 1 AS relative_gap,
  Monthly_Inhand_Salary * 12 / Annual_Income NOT BETWEEN 0.5 AND 1.5 AS extreme_ratio
FROM financials_gold WHERE Annual_Income > 0 AND Monthly_Inhand_Salary > 0 AND isfinite(Annual_Income) AND isfinite(Monthly_Inhand_Salary)
"""
PAIR_DOUBLES = ["Annual_Income", "Monthly_Inhand_Salary", "annualized_salary", "ratio", "relative_gap"]

PIECES["salary_ratios"] = f"""
SELECT {number('Total_EMI_per_month')} / nullif({number('Monthly_Inhand_Salary')}, 0) AS emi_to_salary,
       {number('Annual_Income')} / nullif({number('Monthly_Inhand_Salary')}, 0) AS income_to_salary
FROM financials_raw
"""


def needed(text: str) -> list[str]:
    """The pieces a text builds on, each after the pieces it needs itself."""
    found: list[str] = []
    for name, body in PIECES.items():
        if name != text and re.search(rf"(FROM|JOIN|,)\s+\(?{name}\b", text):
            for earlier in [*needed(body), name]:
                if earlier not in found:
                    found.append(earlier)
    return found


def query(body: str, doubles: list[str] = (), dates: list[str] = ()) -> str:
    """The body with its pieces as CTEs, doubles to six digits and dates as text."""
    changes = [f'round(CAST("{c}" AS DOUBLE), 6) + 0.0 AS "{c}"' for c in doubles]
    changes += [f'CAST("{c}" AS VARCHAR) AS "{c}"' for c in dates]
    head = ",\n".join(f"{name} AS ({PIECES[name].strip()})" for name in needed(body))
    replace = f" REPLACE ({', '.join(changes)})" if changes else ""
    return f"{'WITH ' + head if head else ''} SELECT *{replace} FROM ({body.strip()}) result"


def described(source: str, columns: list[str], probabilities: list[float]) -> str:
    quantiles = [f"p{round(p * 100):02d}" for p in probabilities]
    rows = [
        f"""SELECT '{c}' AS "column", count({c}) AS "count", avg({c}) AS mean, stddev_samp({c}) AS std,
            CAST(min({c}) AS DOUBLE) AS "min", CAST(max({c}) AS DOUBLE) AS "max",
            {joined_by_comma(*[f"quantile_cont(CAST({c} AS DOUBLE), {p}) AS {q}" for p, q in zip(probabilities, quantiles, strict=True)])}
            FROM {source}"""
        for c in columns
    ]
    return query("\nUNION ALL\n".join(rows), ["mean", "std", "min", "max", *quantiles])


def described_all(source: str, numbers: dict[str, str], texts: list[str]) -> str:
    measures = ["mean", "std", "min", "max", "p25", "p50", "p75"]
    rows = [
        f"""SELECT '{name}' AS "column", count({c}) AS "count", CAST(avg({c}) AS DOUBLE) AS mean, stddev_samp({c}) AS std,
            CAST(min({c}) AS DOUBLE) AS "min", CAST(max({c}) AS DOUBLE) AS "max", quantile_cont(CAST({c} AS DOUBLE), 0.25) AS p25,
            quantile_cont(CAST({c} AS DOUBLE), 0.5) AS p50, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS p75,
            CAST(NULL AS BIGINT) AS "unique", CAST(NULL AS VARCHAR) AS "top", CAST(NULL AS BIGINT) AS freq FROM {source}"""
        for name, c in numbers.items()
    ] + [
        f"""SELECT '{c}', count({c}), {', '.join(['CAST(NULL AS DOUBLE)'] * 7)}, count(DISTINCT {c}),
            (SELECT CAST({c} AS VARCHAR) FROM {source} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1),
            (SELECT count(*) FROM {source} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC LIMIT 1) FROM {source}"""
        for c in texts
    ]
    return query("\nUNION ALL\n".join(rows), measures)


def frequencies(source: str, columns: list[str]) -> str:
    return query("\nUNION ALL\n".join(
        f"""SELECT '{c}' AS "column", CAST({c} AS VARCHAR) AS "value", count({c}) AS counts FROM {source} GROUP BY {c}"""
        for c in columns
    ))


def histogram(source: str, value: str, bins: int, where: str = "TRUE", ends: tuple | None = None) -> str:
    low, high = (f"{ends[0]}E0", f"{ends[1]}E0") if ends else ("min(v)", "max(v)")
    return query(
        f"""
WITH vals AS (SELECT CAST({value} AS DOUBLE) AS v FROM {source} WHERE {where}),
edges AS (SELECT CAST({low} AS DOUBLE) AS lo, CAST({high} AS DOUBLE) AS hi {'' if ends else 'FROM vals'}),
bins AS (SELECT b.bin, lo, hi, lo + b.bin * ((hi - lo) / {bins}) AS bin_low, lo + (b.bin + 1) * ((hi - lo) / {bins}) AS bin_high
         FROM range({bins}) b(bin) CROSS JOIN edges),
hits AS (SELECT bin, count(*) AS n FROM vals JOIN bins ON v BETWEEN lo AND hi AND (bin = 0 OR v >= bin_low)
         AND (bin = {bins - 1} OR v < bin_high) GROUP BY bin)
SELECT b.bin, bin_low, bin_high, COALESCE(n, 0) AS "rows" FROM bins b LEFT JOIN hits ON hits.bin = b.bin
""",
        ["bin_low", "bin_high"],
    )


def missing(source: str, columns: list[str], name: str) -> str:
    rows = "\nUNION ALL\n".join(
        f"""SELECT '{name}' AS "table", '{c}' AS "column", avg(CASE WHEN {c} IS NULL THEN 1.0E0 ELSE 0.0E0 END) * 100 AS missing_pct FROM {source}"""
        for c in columns
    )
    return f"""SELECT * FROM (SELECT * FROM ({rows}) ORDER BY missing_pct DESC, "column" LIMIT 10)"""


def overview(source: str, columns: int, keys: str, name: str) -> str:
    return f"""SELECT '{name}' AS "table", count(*) AS "rows", count(DISTINCT Customer_ID) AS customers, {columns} AS "columns",
    min(snapshot_date) AS first_date, max(snapshot_date) AS last_date,
    count(*) - count(DISTINCT ({keys})) AS duplicate_key_rows FROM {source}"""


def counts_of(source: str, column: str, limit: str = "") -> str:
    return query(f'SELECT {column}, count(*) AS "rows" FROM {source} GROUP BY {column} {limit}')


def spread(column: str) -> str:
    return f"""SELECT '{column}' AS "column", v AS "value", count(*) AS "rows" FROM (SELECT {number(column)} AS v FROM financials_raw)
    GROUP BY v HAVING v BETWEEN -5 AND 40"""


def guard(source: str, name: str, customer: str = "Customer_ID") -> str:
    return f"""SELECT '{name}' AS "table", COALESCE(CAST(sum(CASE WHEN k IS NULL OR snapshot_date IS NULL THEN n END) AS BIGINT), 0) AS null_key_rows,
    count(*) FILTER (WHERE n > 1) AS duplicate_keys, CAST(sum(n - 1) AS BIGINT) AS duplicate_key_rows
    FROM (SELECT {customer} AS k, snapshot_date, count(*) AS n FROM {source} GROUP BY ALL)"""


LOAN_DATES = ["loan_start_date", "snapshot_date"]
LOAN_DOUBLES = ["loan_amt", "due_amt", "paid_amt", "overdue_amt", "balance"]
READ_AGE = "TRY_CAST(rtrim(trim(Age), '_') AS INTEGER)"
STATED = "TRY_CAST(rtrim(trim(Num_of_Loan), '_') AS INTEGER)"
FILE_LIST = "string_split(replace(Type_of_Loan, ', and ', ', '), ', ')"
ENCODED = f"""
SELECT loan_id, Customer_ID, loan_start_date, feature_snapshot_date, label_snapshot_date, label, split,
  {joined_by_comma(*[f"({c} - {c}_m) / {c}_s AS {c}" for c in SCALED])}, loan_types_missing,
  {joined_by_comma(*[f"CASE WHEN Credit_Mix = '{v}' THEN 1 ELSE 0 END AS " + chr(34) + f"Credit_Mix_{v}" + chr(34) for v in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")])},
  CASE WHEN Occupation = 'Clerk' THEN 1 ELSE 0 END AS "Occupation_Clerk",
  CASE WHEN Occupation = 'Not a Clerk' THEN 1 ELSE 0 END AS "Occupation_Not a Clerk",
  CASE WHEN age_invalid = false THEN 1 ELSE 0 END AS "age_invalid_False",
  CASE WHEN age_invalid = true THEN 1 ELSE 0 END AS "age_invalid_True"
FROM filled_rows, scales
"""

ORACLES: dict[str, str] = {
    "spine_dates": query(
        """SELECT CAST(d AS DATE) AS snapshot_date, (SELECT count(*) FROM loan_labels l WHERE l.loan_start_date = CAST(d AS DATE)) AS loans
        FROM generate_series(TIMESTAMP '1997-01-01', TIMESTAMP '1998-12-01', INTERVAL 1 MONTH) g(d)""",
        dates=["snapshot_date"],
    ),
    "csv_sql_inferred": query(
        'SELECT Interest_Rate, count(*) AS customers FROM financials_raw GROUP BY Interest_Rate'
    ),
    "rewritten_snapshot": query(
        """SELECT * FROM attributes_gold WHERE snapshot_date <> DATE '2024-02-01' UNION ALL BY NAME
        SELECT * REPLACE ('REWRITTEN' AS Occupation) FROM attributes_gold WHERE snapshot_date = DATE '2024-02-01' AND NOT age_invalid""",
        dates=["snapshot_date"],
    ),
    "pruned_snapshot": query(
        "SELECT snapshot_date, count(*) AS loans FROM loan_labels WHERE snapshot_date IN (DATE '1998-03-01', DATE '1999-03-01') GROUP BY snapshot_date",
        dates=["snapshot_date"],
    ),
    "merged_columns": query(
        "SELECT * REPLACE (CASE WHEN snapshot_date <> DATE '2024-01-01' THEN occupation_missing END AS occupation_missing) FROM attributes_gold",
        dates=["snapshot_date"],
    ),
    "loan_delinquency": query("SELECT * FROM loans_silver", LOAN_DOUBLES, [*LOAN_DATES, "first_missed_date"]),
    "default_label": query(label_sql("loans_silver"), dates=LOAN_DATES),
    "default_label_other_terms": query(label_sql("loans_silver", 60, 3), dates=LOAN_DATES),
    "delinquency_extremes": query("SELECT * FROM extremes", LOAN_DOUBLES, [*LOAN_DATES, "first_missed_date"]),
    "default_label_extremes": query(label_sql("extremes"), dates=LOAN_DATES),
    "default_rate_by_cohort": query(
        "SELECT loan_start_date, count(*) AS loans, avg(label) AS default_rate FROM loan_labels GROUP BY loan_start_date",
        ["default_rate"], ["loan_start_date"],
    ),
    "default_rate_by_label_date": query(
        "SELECT snapshot_date, count(*) AS loans, avg(label) AS default_rate FROM loan_labels GROUP BY snapshot_date",
        ["default_rate"], ["snapshot_date"],
    ),
    "mob_performance_curve": query(
        """WITH flagged AS (SELECT loan_id, mob, CASE WHEN dpd >= 30 THEN 1 ELSE 0 END AS bad FROM loans_exact WHERE mob BETWEEN 1 AND 10),
        so_far AS (SELECT *, max(bad) OVER (PARTITION BY loan_id ORDER BY mob ROWS UNBOUNDED PRECEDING) AS ever FROM flagged)
        SELECT mob, count(DISTINCT loan_id) AS loan_count, avg(bad) AS bad_rate_at_mob, avg(ever) AS cumulative_bad_rate FROM so_far GROUP BY mob""",
        ["bad_rate_at_mob", "cumulative_bad_rate"],
    ),
    "bad_by_month": query(
        """WITH flagged AS (SELECT loan_id, mob, CASE WHEN dpd >= 30 THEN 1 ELSE 0 END AS bad FROM loans_exact WHERE mob BETWEEN 1 AND 10),
        so_far AS (SELECT *, max(bad) OVER (PARTITION BY loan_id ORDER BY mob ROWS UNBOUNDED PRECEDING) AS ever FROM flagged)
        SELECT loan_id, mob, count(*) AS "rows", CAST(sum(bad) AS BIGINT) AS bad_rows, max(ever) AS ever_bad_by_mob FROM so_far GROUP BY loan_id, mob"""
    ),
    "loan_summary": query(
        "SELECT count(*) AS row_count, count(DISTINCT loan_id) AS loan_count, min(mob) AS minimum_mob, max(mob) AS maximum_mob FROM loans_exact"
    ),
    "first_loan_rows": query(
        "SELECT loan_id, mob, overdue_amt, dpd FROM loans_exact ORDER BY loan_id, mob LIMIT 5", ["overdue_amt"]
    ),
    "duplicate_loan_keys": query(
        'SELECT l_orderkey, l_linenumber, count(*) AS "count" FROM lineitem GROUP BY ALL HAVING count(*) > 1'
    ),
    "attributes_silver": query("SELECT * FROM attributes_silver", dates=["snapshot_date"]),
    "financials_silver": query("SELECT * FROM financials_silver", FIN_DOUBLES, ["snapshot_date"]),
    "clicks_silver": query("SELECT * FROM clicks_silver", dates=["snapshot_date"]),
    "attribute_quality": query(
        """SELECT snapshot_date, count(*) AS "rows", count(*) FILTER (WHERE age_invalid) AS invalid_age,
        count(*) FILTER (WHERE Occupation IS NULL) AS missing_occupation FROM attributes_silver GROUP BY snapshot_date""",
        dates=["snapshot_date"],
    ),
    "financial_quality": query(
        f"""SELECT snapshot_date, count(*) AS "rows", count(*) FILTER (WHERE loan_count_suspicious) AS suspicious_loan_counts,
        count(*) FILTER (WHERE loan_types_missing) AS missing_loan_lists,
        {joined_by_comma(*[f"count(*) FILTER (WHERE {c}) AS {c}_rows" for c in FIN_FLAGS])},
        count(*) FILTER (WHERE snapshot_date IS NULL) AS invalid_dates FROM financials_silver GROUP BY snapshot_date""",
        dates=["snapshot_date"],
    ),
    "duplicate_click_rows": query(
        """SELECT (SELECT count(*) FROM clicks_raw) AS input_rows, (SELECT count(*) FROM clicks_silver) AS output_rows,
        (SELECT count(*) FROM clicks_raw) - (SELECT count(*) FROM clicks_silver) AS duplicates_removed"""
    ),
    "loan_vocabulary": query(
        f"SELECT DISTINCT trim(entry) AS loan_type FROM (SELECT unnest({LIST_PARTS}) AS entry FROM financials_silver)"
    ),
    "attributes_gold": query("SELECT * FROM attributes_gold", dates=["snapshot_date"]),
    "financials_gold": query("SELECT * FROM financials_gold", FIN_GOLD_DOUBLES, ["snapshot_date"]),
    "click_history_asof": query(
        history_sql([f"2024-01-{day:02d}" for day in range(1, 24)] + ["2024-02-05"]),
        [f"{c}_mean" for c in COUNTERS], ["snapshot_date"],
    ),
    "click_history_monthly": query(
        "SELECT * FROM clicks_gold", [f"{c}_mean" for c in COUNTERS], ["snapshot_date"]
    ),
    "key_guard_counts": query("\nUNION ALL\n".join([
        guard("attributes_gold", "attributes"), guard("financials_gold", "financials"),
        guard("clicks_silver", "clicks"), guard("clicks_silver", "broken", "nullif(Customer_ID, '7')"),
    ])),
    "joined_features": query(
        "SELECT * FROM joined", [*FIN_GOLD_DOUBLES, *[f"{c}_mean" for c in COUNTERS]], ["snapshot_date"]
    ),
    "stored_table": query(
        """SELECT count(*) AS feature_rows, count(*) - count(DISTINCT (Customer_ID, snapshot_date)) AS duplicate_customer_date_keys,
        count(*) FILTER (WHERE has_attributes = 0) AS missing_attributes, count(*) FILTER (WHERE has_financials = 0) AS missing_financials,
        count(*) FILTER (WHERE has_clickstream = 0) AS without_clickstream
        FROM joined WHERE snapshot_date BETWEEN DATE '2024-02-01' AND DATE '2024-03-01'"""
    ),
    "backfill_features": query(
        "SELECT * FROM backfilled", [*FIN_GOLD_DOUBLES, *[f"{c}_mean" for c in COUNTERS]], ["snapshot_date"]
    ),
    "backfill_labels": query(label_sql("delivered_silver"), dates=LOAN_DATES),
    "backfill_second_run": query(
        "SELECT * FROM second_run", [*FIN_GOLD_DOUBLES, *[f"{c}_mean" for c in COUNTERS]], ["snapshot_date"]
    ),
    "backfill_two_runs_equal_one": query(
        """SELECT CAST(snapshot_date AS VARCHAR) AS snapshot_date, CAST(count(*) AS BIGINT) AS one_run,
        CAST(count(*) AS BIGINT) AS two_runs, CAST(count(*) AS BIGINT) AS alike FROM one_run GROUP BY snapshot_date"""
    ),
    "click_history_incremental": query(
        "SELECT * FROM kept_history", [f"{c}_mean" for c in COUNTERS], ["snapshot_date"]
    ),
    "joined_audit": query(
        """SELECT count(*) AS feature_rows, count(*) - count(DISTINCT (Customer_ID, snapshot_date)) AS duplicate_customer_date_keys,
        count(*) FILTER (WHERE has_attributes = 0) AS missing_attributes, count(*) FILTER (WHERE has_financials = 0) AS missing_financials,
        count(*) FILTER (WHERE has_clickstream = 0) AS without_clickstream FROM joined"""
    ),
    "labelled_features": query(
        "SELECT * FROM labelled", ["fe_1_mean"], ["loan_start_date", "feature_snapshot_date", "label_snapshot_date"]
    ),
    "oot_dates": query("SELECT * FROM oot", dates=["loan_start_date"]),
    "split_membership": query("SELECT loan_id, label, split FROM split_rows"),
    "split_report": query(
        'SELECT split, count(*) AS "rows", avg(label) AS default_rate FROM split_rows GROUP BY split', ["default_rate"]
    ),
    "train_fill_values": query(
        """SELECT 'Age' AS source_col, age_fill AS fill FROM fills UNION ALL SELECT 'Num_Bank_Accounts', accounts_fill FROM fills
        UNION ALL SELECT 'Outstanding_Debt', debt_fill FROM fills UNION ALL SELECT 'has_clickstream', has_fill FROM fills
        UNION ALL SELECT 'fe_1_mean', fe_fill FROM fills""",
        ["fill"],
    ),
    "scaler_parameters": query(
        "\nUNION ALL\n".join(f"SELECT '{c}' AS source_col, {c}_m AS mean, {c}_s AS scale FROM scales" for c in SCALED),
        ["mean", "scale"],
    ),
    "onehot_columns": query(
        """SELECT *, source_col || '_' || category AS out_col FROM (
        SELECT DISTINCT 'Credit_Mix' AS source_col, Credit_Mix AS category FROM split_rows WHERE split = 'train' AND Credit_Mix IS NOT NULL
        UNION ALL SELECT DISTINCT 'Occupation', Occupation FROM split_rows WHERE split = 'train' AND Occupation IS NOT NULL
        UNION ALL SELECT DISTINCT 'age_invalid', CASE WHEN age_invalid THEN 'True' ELSE 'False' END FROM split_rows WHERE split = 'train' AND age_invalid IS NOT NULL)"""
    ),
    "imputed_sets": query(
        "SELECT split, sum(Outstanding_Debt) AS debt, sum(Age) AS age, sum(fe_1_mean) AS fe_1 FROM filled_rows GROUP BY split",
        ["debt", "age", "fe_1"],
    ),
    "encoded_sets": query(ENCODED, SCALED, ["loan_start_date", "feature_snapshot_date", "label_snapshot_date"]),
    "encoded_new_loans": query(
        f"""WITH new_loans AS ({label_sql('loans_exact', 30, 3)})
        SELECT l.loan_id, (COALESCE(CAST(f.Age AS DOUBLE), age_fill) - Age_m) / Age_s AS Age,
          (COALESCE(CAST(f.Outstanding_Debt AS DOUBLE), debt_fill) - Outstanding_Debt_m) / Outstanding_Debt_s AS Outstanding_Debt,
          (COALESCE(f.fe_1_mean, fe_fill) - fe_1_mean_m) / fe_1_mean_s AS fe_1_mean,
          CASE WHEN Occupation = 'Clerk' THEN 1 ELSE 0 END AS Occupation_Clerk, CASE WHEN age_invalid THEN 1 ELSE 0 END AS age_invalid_True
        FROM new_loans l JOIN feature_rows f ON l.Customer_ID = f.Customer_ID AND l.loan_start_date = f.snapshot_date CROSS JOIN fills CROSS JOIN scales""",
        ["Age", "Outstanding_Debt", "fe_1_mean"],
    ),
    "raw_frequencies": frequencies(
        "financials_raw", ["Credit_Mix", "Payment_Behaviour", "Type_of_Loan", "Num_Credit_Inquiries", "Interest_Rate"]
    ),
    "occupation_frequency": query("SELECT Occupation, count(Occupation) AS counts FROM attributes_raw GROUP BY Occupation"),
    "loan_term_frequencies": frequencies("loans", ["tenure", "installment_num"]),
    "valid_age_frequency": query(
        f"SELECT Age, count(Age) AS age_counts FROM (SELECT {READ_AGE} AS Age FROM attributes_raw) WHERE Age BETWEEN 1 AND 100 GROUP BY Age"
    ),
    "age_listing_valid": query(
        f"SELECT * FROM (SELECT Age AS original_age, {READ_AGE} AS Age2 FROM attributes_raw) WHERE Age2 BETWEEN 1 AND 100 OR Age2 IS NULL"
    ),
    "age_listing_invalid": query(
        f"SELECT * FROM (SELECT Age AS original_age, {READ_AGE} AS Age2 FROM attributes_raw) WHERE Age2 NOT BETWEEN 1 AND 100 OR Age2 IS NULL"
    ),
    "age_validity": query(
        f"""SELECT count(*) AS "rows", count(*) FILTER (WHERE age BETWEEN 1 AND 100) AS valid_ages,
        count(*) FILTER (WHERE age IS NULL OR age NOT BETWEEN 1 AND 100) AS invalid_ages FROM (SELECT {READ_AGE} AS age FROM attributes_raw)"""
    ),
    "loan_type_frequency": query(
        f"""SELECT loan_type, count(*) AS loan_mentions, count(DISTINCT Customer_ID) AS customer_count
        FROM (SELECT Customer_ID, trim(u.entry) AS loan_type FROM financials_raw CROSS JOIN UNNEST({FILE_LIST}) u(entry) WHERE Type_of_Loan IS NOT NULL)
        GROUP BY loan_type"""
    ),
    "loan_count_comparison": query(
        f"""WITH listed AS (SELECT Customer_ID, count(*) AS n FROM financials_raw CROSS JOIN UNNEST({FILE_LIST}) u(entry)
            WHERE Type_of_Loan IS NOT NULL GROUP BY Customer_ID),
        compared AS (SELECT f.Customer_ID, Type_of_Loan, Num_of_Loan AS raw_num_of_loan, {STATED} AS num_of_loan, COALESCE(n, 0) AS listed_loan_count
            FROM financials_raw f LEFT JOIN listed USING (Customer_ID))
        SELECT *, num_of_loan - listed_loan_count AS count_difference,
          CASE WHEN num_of_loan IS NULL THEN 'Invalid Num_of_Loan' WHEN num_of_loan = listed_loan_count THEN 'Match' ELSE 'Mismatch' END AS validation_result
        FROM compared WHERE num_of_loan - listed_loan_count > 0"""
    ),
    "loan_count_status": query(
        f"""SELECT CASE WHEN n IS NULL OR n < 0 THEN 'Invalid count' WHEN listed IS NULL THEN 'Missing loan list'
          WHEN n = listed THEN 'Match' ELSE 'Mismatch' END AS loan_count_status, count(*) AS row_count
        FROM (SELECT TRY_CAST({stripped('Num_of_Loan')} AS INTEGER) AS n,
          CASE WHEN Type_of_Loan IS NOT NULL AND trim(Type_of_Loan) <> '' THEN len({FILE_LIST}) END AS listed FROM financials_raw)
        GROUP BY 1"""
    ),
    "customer_rows": query("SELECT * FROM clicks_silver WHERE Customer_ID = '7'", dates=["snapshot_date"]),
    "zero_loans_without_list": query(
        f"SELECT Customer_ID, Num_of_Loan, Type_of_Loan, Total_EMI_per_month, Outstanding_Debt FROM financials_raw WHERE {STATED} = 0 AND Type_of_Loan IS NULL"
    ),
    "negative_debt": query(f"SELECT Outstanding_Debt FROM financials_raw WHERE {number('Outstanding_Debt')} < 0"),
    "invalid_dates": query(
        "SELECT Customer_ID, snapshot_date FROM delivered WHERE snapshot_date IS NULL OR NOT regexp_matches(snapshot_date, '^[0-9]{4}-[0-9]{2}-[0-9]{2}( .*)?$')"
    ),
    "field_validity": query(
        f"""SELECT count(*) AS "rows", count(*) FILTER (WHERE rate NOT BETWEEN 0 AND 34 OR rate IS NULL) AS invalid_interest_rate,
        count(*) FILTER (WHERE debt < 0) AS negative_debt,
        count(*) FILTER (WHERE Credit_Mix IS NULL OR Credit_Mix NOT IN ('Good', 'Standard', 'Bad')) AS unknown_credit_mix,
        count(*) FILTER (WHERE Payment_of_Min_Amount IS NULL OR Payment_of_Min_Amount NOT IN ('Yes', 'No')) AS unknown_minimum_payment,
        count(*) FILTER (WHERE TRY_CAST(snapshot_date AS DATE) IS NULL) AS invalid_dates
        FROM (SELECT *, {number('Interest_Rate')} AS rate, {number('Outstanding_Debt')} AS debt FROM financials_raw)"""
    ),
    "invested_distribution": query(
        f"""SELECT bucket, count(*) AS "rows", round(100.0 * count(*) / sum(count(*)) OVER (), 1) AS pct, round(min(amount), 1) AS min_amount,
        round(median(amount), 1) AS median_amount, round(max(amount), 1) AS max_amount
        FROM (SELECT amount, CASE WHEN raw = '__10000__' THEN '__10000__ placeholder' WHEN amount < 100 THEN '0-100' WHEN amount < 250 THEN '100-250'
            WHEN amount < 500 THEN '250-500' WHEN amount < 1000 THEN '500-1000' ELSE '1000+' END AS bucket
          FROM (SELECT trim(Amount_invested_monthly) AS raw, {number('Amount_invested_monthly')} AS amount FROM financials_raw))
        GROUP BY bucket""",
        ["pct", "min_amount", "median_amount", "max_amount"],
    ),
    "invested_histogram": histogram(
        "financials_raw", number("Amount_invested_monthly"), 50, "trim(Amount_invested_monthly) <> '__10000__'", (0, 10000)
    ),
    "invested_placeholder_histogram": histogram(
        "financials_raw", number("Amount_invested_monthly"), 50, "trim(Amount_invested_monthly) = '__10000__'", (0, 10000)
    ),
    "inquiry_decimals": query(
        """SELECT count(*) AS "rows", count(*) FILTER (WHERE Num_Credit_Inquiries LIKE '%.%') AS stored_with_decimal,
        count(*) FILTER (WHERE Num_Credit_Inquiries LIKE '%.0') AS ending_in_point_zero FROM financials_raw"""
    ),
    "range_summary": query(
        "\nUNION ALL\n".join(
            f"""SELECT '{c}' AS column_name, {low} AS low, {high} AS high, count(*) FILTER (WHERE v BETWEEN {low} AND {high}) AS in_range,
            count(*) FILTER (WHERE v < {low}) AS below_range, count(*) FILTER (WHERE v > {high}) AS above_range, max(v) AS max_value
            FROM (SELECT TRY_CAST(regexp_replace({stripped(c)}, '\\.0$', '') AS DOUBLE) AS v FROM financials_raw)"""
            for c, (low, high) in config.VALUE_RANGES.items()
        ),
        ["max_value"],
    ),
    "value_spreads": query("\nUNION ALL\n".join(spread(c) for c in config.VALUE_RANGES), ["value"]),
    "salary_ratio_summary": query(
        """SELECT count(*) AS "rows", count(*) FILTER (WHERE emi_to_salary > 1) AS emi_above_salary,
        count(*) FILTER (WHERE emi_to_salary BETWEEN 0.5 AND 1) AS emi_half_to_full_salary,
        count(*) FILTER (WHERE income_to_salary > 30) AS income_above_30x_salary,
        count(*) FILTER (WHERE income_to_salary BETWEEN 25 AND 30) AS income_25x_to_30x_salary,
        round(median(income_to_salary), 1) AS median_income_to_salary FROM salary_ratios""",
        ["median_income_to_salary"],
    ),
    "emi_log_histogram": histogram("salary_ratios", "log10(emi_to_salary)", 60, "emi_to_salary > 0"),
    "income_log_histogram": histogram("salary_ratios", "log10(income_to_salary)", 60, "income_to_salary > 0"),
    "lowest_balances": query(
        f"SELECT Customer_ID, Monthly_Balance AS raw_value, {number('Monthly_Balance')} AS balance FROM financials_raw ORDER BY balance NULLS LAST, Customer_ID LIMIT 5",
        ["balance"],
    ),
    "describe_financials": described_all(
        "financials_raw", {"salary": number("Monthly_Inhand_Salary")}, list(config.FINANCIAL_COLUMNS)
    ),
    "describe_loans": described_all(
        "loans", {c: c for c in ["tenure", "installment_num", *LOAN_DOUBLES]},
        ["loan_id", "Customer_ID", "loan_start_date", "snapshot_date"],
    ),
    "table_overview": query(
        "\nUNION ALL\n".join([
            overview("loan_labels", 6, "loan_id, snapshot_date", "labels"),
            overview("attributes_gold", len(ATTR_GOLD), "Customer_ID, snapshot_date", "attributes"),
            overview("financials_gold", len(FIN_GOLD), "Customer_ID, snapshot_date", "financials"),
            overview("clicks_gold", len(CLICK_GOLD), "Customer_ID, snapshot_date", "clickstream"),
            overview("clicks_silver", 22, "Customer_ID, snapshot_date", "click rows"),
        ]),
        dates=["first_date", "last_date"],
    ),
    "missing_percent": query(
        "\nUNION ALL\n".join([
            missing("attributes_gold", ATTR_GOLD, "attributes"),
            missing("financials_gold", FIN_GOLD, "financials"),
            missing("joined", JOINED, "joined"),
        ]),
        ["missing_pct"],
    ),
    "income_gap_summary": query(
        """SELECT (SELECT count(*) FROM financials_gold) AS financial_rows, count(*) AS valid_positive_pairs,
        (SELECT count(*) FROM financials_gold) - count(*) AS excluded_missing_nonpositive_or_nonfinite, median(ratio) AS median_ratio,
        count(*) FILTER (WHERE ratio BETWEEN 0.9 AND 1.1) AS within_10_percent_count,
        avg(CASE WHEN ratio BETWEEN 0.9 AND 1.1 THEN 100.0E0 ELSE 0 END) AS within_10_percent_pct,
        count(*) FILTER (WHERE ratio < 0.5) AS low_ratio_count, count(*) FILTER (WHERE ratio > 1.5) AS high_ratio_count,
        avg(CASE WHEN extreme_ratio THEN 100.0E0 ELSE 0 END) AS extreme_ratio_pct,
        count(DISTINCT Customer_ID) FILTER (WHERE extreme_ratio) AS customers_with_extreme_ratio FROM income_pairs""",
        ["median_ratio", "within_10_percent_pct", "extreme_ratio_pct"],
    ),
    "income_percentiles": described(
        "income_pairs", ["Annual_Income", "Monthly_Inhand_Salary", "ratio"], [0.01, 0.05, 0.5, 0.95, 0.99]
    ),
    "lowest_income_ratios": query(
        "SELECT * FROM income_pairs ORDER BY ratio, Customer_ID, snapshot_date LIMIT 10", PAIR_DOUBLES, ["snapshot_date"]
    ),
    "highest_income_ratios": query(
        "SELECT * FROM income_pairs ORDER BY ratio DESC, Customer_ID, snapshot_date LIMIT 10", PAIR_DOUBLES, ["snapshot_date"]
    ),
    "income_ratio_log_histogram": histogram("income_pairs", "log10(ratio)", 60, "ratio > 0"),
    "income_gap_monthly": query(
        """SELECT snapshot_date, count(ratio) AS "rows", median(ratio) AS median_ratio,
        avg(CASE WHEN extreme_ratio THEN 1.0E0 ELSE 0 END) * 100 AS extreme_pct FROM income_pairs GROUP BY snapshot_date""",
        ["median_ratio", "extreme_pct"], ["snapshot_date"],
    ),
    "repeat_customers": query(
        "SELECT count(*) AS customers_with_multiple_snapshots FROM (SELECT Customer_ID FROM income_pairs GROUP BY Customer_ID HAVING count(*) > 1)"
    ),
    "income_vs_customer_median": query(
        """SELECT p.*, m.mid AS customer_median_income, Annual_Income / m.mid AS income_vs_customer_median
        FROM income_pairs p JOIN (SELECT Customer_ID, median(Annual_Income) AS mid FROM income_pairs GROUP BY Customer_ID) m USING (Customer_ID)""",
        [*PAIR_DOUBLES, "customer_median_income", "income_vs_customer_median"], ["snapshot_date"],
    ),
    "most_unusual_incomes": query(
        """SELECT * FROM (SELECT p.*, m.mid AS customer_median_income, Annual_Income / m.mid AS income_vs_customer_median
        FROM income_pairs p JOIN (SELECT Customer_ID, median(Annual_Income) AS mid FROM income_pairs GROUP BY Customer_ID) m USING (Customer_ID))
        WHERE extreme_ratio ORDER BY income_vs_customer_median DESC, Customer_ID, snapshot_date LIMIT 20""",
        [*PAIR_DOUBLES, "customer_median_income", "income_vs_customer_median"], ["snapshot_date"],
    ),
    "lowest_ratio_customer": query(
        "SELECT * FROM income_pairs WHERE Customer_ID = (SELECT Customer_ID FROM income_pairs ORDER BY ratio, Customer_ID, snapshot_date LIMIT 1)",
        PAIR_DOUBLES, ["snapshot_date"],
    ),
    "financial_percentiles": described(
        "financials_gold", ["EMI_to_Salary_Ratio", "Debt_to_Income", "Disposable_Income", "Credit_History_Months"], [0.01, 0.5, 0.99]
    ),
    "grouped_quantiles": query(
        """SELECT l_returnflag, quantile_cont(l_extendedprice, 0.05) AS price_p05, quantile_cont(l_extendedprice, 0.5) AS price_p50,
        quantile_cont(l_quantity, 0.05) AS quantity_p05, quantile_cont(l_quantity, 0.5) AS quantity_p50 FROM lineitem GROUP BY l_returnflag""",
        ["price_p05", "price_p50", "quantity_p05", "quantity_p50"],
    ),
    "trimmed_histogram": histogram(
        "financials_gold", "Disposable_Income", 40,
        "Disposable_Income BETWEEN (SELECT quantile_cont(Disposable_Income, 0.01) FROM financials_gold) AND (SELECT quantile_cont(Disposable_Income, 0.99) FROM financials_gold)",
    ),
    **{
        name: histogram(
            "financials_gold", c, 40,
            f"{c} BETWEEN (SELECT quantile_cont({c}, 0.01) FROM financials_gold) AND (SELECT quantile_cont({c}, 0.99) FROM financials_gold)",
        )
        for name, c in (
            ("trimmed_histogram_instalments", "EMI_to_Salary_Ratio"), ("trimmed_histogram_debt", "Debt_to_Income"),
            ("trimmed_histogram_history", "Credit_History_Months"),
        )
    },
    "tenth_histogram": histogram("lineitem", "l_discount", 100, ends=(0, 1)),
    "age_histogram": histogram("attributes_gold", "Age", 30, "Age IS NOT NULL"),
    "click_days_histogram": histogram("clicks_gold", "clickstream_days", 30),
    "describe_click_history": described("clicks_gold", [f"{c}_mean" for c in COUNTERS], [0.25, 0.5, 0.75]),
    "financial_flag_rates": query(
        "\nUNION ALL\n".join(
            f"SELECT '{c}' AS flag, avg(CASE WHEN {c} THEN 1.0E0 WHEN NOT {c} THEN 0.0E0 END) * 100 AS flagged_pct FROM financials_gold"
            for c in ("loan_count_suspicious", "loan_types_missing", "interest_rate_invalid", "annual_income_invalid")
        ),
        ["flagged_pct"],
    ),
    "attribute_flag_rates": query(
        "\nUNION ALL\n".join(
            f"SELECT '{c}' AS flag, avg(CASE WHEN {c} THEN 1.0E0 ELSE 0.0E0 END) * 100 AS flagged_pct FROM attributes_gold"
            for c in ("age_invalid", "occupation_missing")
        ),
        ["flagged_pct"],
    ),
    "status_value_counts": counts_of("financials_gold", "loan_count_status"),
    "credit_mix_value_counts": counts_of("financials_silver", "Credit_Mix"),
    "top_occupations": counts_of("attributes_gold", "Occupation", 'ORDER BY "rows" DESC, Occupation LIMIT 15'),
    "label_value_counts": counts_of("loan_labels", "label"),
    "click_coverage": query(
        """SELECT a.snapshot_date, count(*) AS customers, avg(CASE WHEN c.Customer_ID IS NULL THEN 0.0E0 ELSE 1.0E0 END) * 100 AS coverage_pct
        FROM (SELECT DISTINCT Customer_ID, snapshot_date FROM attributes_gold) a
        LEFT JOIN (SELECT DISTINCT Customer_ID, snapshot_date FROM clicks_gold) c ON a.Customer_ID = c.Customer_ID AND a.snapshot_date = c.snapshot_date
        GROUP BY a.snapshot_date""",
        ["coverage_pct"], ["snapshot_date"],
    ),
}
ORACLES["csv_sql_text"] = ORACLES["csv_sql_inferred"]
# A delivered row counts at midnight of the first of January or February 2024.
ORACLES["snapshot_ingest"] = query(
    """SELECT Customer_ID, Name, SSN, Age, Occupation, day AS snapshot_date, CAST(left(day, 10) AS DATE) AS snapshot
    FROM (SELECT *, replace(snapshot_date, 'x', '') AS day FROM delivered)
    WHERE day IN ('2024-01-01', '2024-02-01', '2024-01-01 00:00:00', '2024-02-01 00:00:00')""",
    dates=["snapshot"],
)
ORACLES["income_sample"] = query(
    """SELECT * FROM income_pairs ORDER BY md5(concat_ws('|', '42', Customer_ID, CAST(snapshot_date AS VARCHAR))),
    Customer_ID, snapshot_date LIMIT 100""",
    PAIR_DOUBLES, ["snapshot_date"],
)

# Stored in buckets or not, the joins hold the same rows.
ORACLES["bucketed_features"] = ORACLES["joined_features"]
ORACLES["bucketed_labelled"] = ORACLES["labelled_features"]

# Merged from states or computed over all rows, the reports are the same.
ORACLES["profile_missing"] = ORACLES["missing_percent"]
ORACLES["profile_flags"] = ORACLES["financial_flag_rates"]
ORACLES["profile_status_counts"] = ORACLES["status_value_counts"]
ORACLES["profile_described"] = query(
    "\nUNION ALL\n".join(
        f"""SELECT '{c}' AS "column", count({c}) AS "count", avg({c}) AS mean, stddev_samp({c}) AS std,
        CAST(min({c}) AS DOUBLE) AS "min", CAST(max({c}) AS DOUBLE) AS "max" FROM financials_gold"""
        for c in ("EMI_to_Salary_Ratio", "Debt_to_Income", "Disposable_Income", "Credit_History_Months")
    ),
    ["mean", "std", "min", "max"],
)
