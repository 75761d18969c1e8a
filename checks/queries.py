"""The registered queries: library operators on the views over the test tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.views import STORED_FILES, TABLES, view, view_sql
from creditmart import config
from creditmart.functions.columns import quoted
from creditmart.functions.quantiles import exact_quantiles
from creditmart.operators import (
    assemble,
    clean,
    features,
    history,
    loans,
    preprocess,
    profile,
    quality,
    split,
)
from creditmart.plans import (
    backfill,
    click_history,
    gold_reports,
    prepare,
    profiles,
    raw_checks,
)
from creditmart.session import scratch_path
from creditmart.sources import raw, spine, tables
from creditmart.sources.buckets import Buckets

Query = Callable[[SparkSession, str], DataFrame]

MONTHS = spine.month_starts("2024-01-01", "2024-04-01")
ALL_MONTHS = spine.month_starts("2024-01-01", "2024-10-01")
BUCKETS = 8
RATIOS = ["EMI_to_Salary_Ratio", "Debt_to_Income", "Disposable_Income", "Credit_History_Months"]
FLAGS = ["loan_count_suspicious", "loan_types_missing", "interest_rate_invalid", "annual_income_invalid"]
# As many cutoffs as two years of months, on the one month of activity there is.
DAYS = [f"2024-01-{day:02d}" for day in range(1, 24)] + ["2024-02-05"]


def comparable(df: DataFrame) -> DataFrame:
    """Dates as text and doubles to six digits, for the comparison across engines."""

    def column(name: str, dtype: str):
        value = F.col(f"`{name}`")
        if dtype == "date":
            value = value.cast("string")
        if dtype in ("double", "float"):
            value = F.round(value, 6) + F.lit(0.0)
        return value.alias(name)

    return df.select(*[column(name, dtype) for name, dtype in df.dtypes])


# -- inputs ---------------------------------------------------------------


def silver_loans(spark: SparkSession, sf: str) -> DataFrame:
    return loans.delinquency(loans.typed(view(spark, sf, "loans_raw")))


def exact_loans(spark: SparkSession, sf: str) -> DataFrame:
    """Loans without the unreadable amounts."""
    return loans.delinquency(view(spark, sf, "loans"))


def labels(spark: SparkSession, sf: str) -> DataFrame:
    return loans.default_label(exact_loans(spark, sf))


def raw_attributes(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "attributes_raw")


def raw_financials(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "financials_raw")


def silver_attributes(spark: SparkSession, sf: str) -> DataFrame:
    return clean.attributes(raw_attributes(spark, sf))


def silver_financials(spark: SparkSession, sf: str) -> DataFrame:
    return clean.financials(raw_financials(spark, sf))


def silver_clicks(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clicks(view(spark, sf, "clicks_raw"))


def gold_attributes(spark: SparkSession, sf: str) -> DataFrame:
    return features.attributes(silver_attributes(spark, sf))


def gold_financials(spark: SparkSession, sf: str) -> DataFrame:
    return features.financials(silver_financials(spark, sf))


def gold_clicks(spark: SparkSession, sf: str) -> DataFrame:
    return history.asof_history(silver_clicks(spark, sf), MONTHS)


def joined(spark: SparkSession, sf: str) -> DataFrame:
    return assemble.features(
        gold_attributes(spark, sf), gold_financials(spark, sf), gold_clicks(spark, sf)
    )


def bucketed_features(spark: SparkSession, sf: str) -> DataFrame:
    """The join of tables stored in buckets by customer, each written by two runs."""
    cut, found = Buckets("Customer_ID", BUCKETS), []
    for name, table in {
        "attributes": gold_attributes, "financials": gold_financials, "clicks": gold_clicks,
    }.items():
        rows, path = table(spark, sf), scratch_path(spark, name)
        early = F.col("snapshot_date") < "2024-03-01"
        tables.write_snapshots(rows.filter(early), path, buckets=cut)
        tables.write_snapshots(rows.filter(~early), path, buckets=cut)
        found.append(tables.read_snapshots(spark, path))
    return assemble.features(*found)


def bucketed_labelled(spark: SparkSession, sf: str) -> DataFrame:
    """Labels and feature rows stored in buckets by customer, joined where they lie."""
    cut, found = Buckets("Customer_ID", BUCKETS), []
    for name, rows in {"labels": labels(spark, sf), "features": view(spark, sf, "feature_rows")}.items():
        path = scratch_path(spark, name)
        tables.write_snapshots(rows, path, buckets=cut)
        found.append(tables.read_snapshots(spark, path))
    return assemble.labelled_features(*found)


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    return assemble.labelled_features(labels(spark, sf), view(spark, sf, "feature_rows"))


def stored_labelled(spark: SparkSession, sf: str) -> DataFrame:
    """The labelled rows as a table, as dataset preparation reads them."""
    path = scratch_path(spark, "labelled")
    tables.write_table(labelled(spark, sf), path)
    return spark.read.parquet(path)


def pairs(spark: SparkSession, sf: str) -> DataFrame:
    return gold_reports.income_pairs(gold_financials(spark, sf))


def assigned(spark: SparkSession, sf: str) -> DataFrame:
    rows = labelled(spark, sf)
    return split.assign_split(rows, split.plan_split(rows))


def fitted(spark: SparkSession, sf: str) -> tuple[DataFrame, list[preprocess.Field]]:
    prepared = prepare.prepare(stored_labelled(spark, sf))
    return prepared.rows, prepared.fields


def parameters(spark: SparkSession, sf: str) -> DataFrame:
    return preprocess.parameters_frame(spark, fitted(spark, sf)[1])


def stored_view(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A view written out as a table, for queries that read it more than once."""
    path = scratch_path(spark, name)
    tables.write_table(view(spark, sf, name), path)
    return spark.read.parquet(path)


# -- sources and sinks ----------------------------------------------------


def csv_copy(spark: SparkSession, sf: str, name: str) -> str:
    """A view written out as the CSV file a source system would deliver."""
    if (sf, name) in STORED_FILES:
        return STORED_FILES[sf, name]
    path = scratch_path(spark, name)
    tables.write_csv(view(spark, sf, name), path)
    return path


def snapshot_ingest(spark: SparkSession, sf: str) -> DataFrame:
    delivered = raw.read_text_columns(spark, csv_copy(spark, sf, "delivered"))
    return raw.select_snapshots(delivered, spine.month_starts("2024-01-01", "2024-02-01"))


def sql_over_csv(spark: SparkSession, sf: str, infer: bool) -> DataFrame:
    files = {"financials": csv_copy(spark, sf, "financials_raw")}
    return raw.sql_over_files(
        spark,
        """
        WITH rates AS (SELECT Interest_Rate, Customer_ID FROM {financials})
        SELECT CAST(Interest_Rate AS STRING) AS Interest_Rate, COUNT(*) AS customers
        FROM rates GROUP BY Interest_Rate ORDER BY Interest_Rate
        """,
        files,
        infer=infer,
    )


def rewritten_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """Write all snapshots, write one of them again with a change, read all back."""
    path = scratch_path(spark, "gold_attributes")
    table = gold_attributes(spark, sf)
    tables.write_snapshots(table, path)
    changed = table.filter("snapshot_date = '2024-02-01' AND NOT age_invalid").withColumn(
        "Occupation", F.lit("REWRITTEN")
    )
    tables.write_snapshots(changed, path)
    return tables.read_snapshots(spark, path).select(table.columns)


def pruned_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "labels")
    tables.write_snapshots(labels(spark, sf), path)
    stored = tables.read_snapshots(spark, path, ["1998-03-01", "1999-03-01"])
    return stored.groupBy("snapshot_date").agg(F.count("*").alias("loans"))


def merged_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Snapshots written with different columns, read by name."""
    path = scratch_path(spark, "merged")
    table = gold_attributes(spark, sf)
    first = F.col("snapshot_date") == F.lit("2024-01-01").cast("date")
    tables.write_snapshots(table.filter(first).drop("occupation_missing"), path)
    tables.write_snapshots(table.filter(~first), path)
    return tables.read_snapshots(spark, path).select(table.columns)


def stored_table(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "joined")
    tables.write_table(joined(spark, sf), path)
    return quality.joined_audit(tables.between_dates(
        spark.read.parquet(path), start="2024-02-01", end="2024-03-01"
    ))


DELIVERED = {
    "lms": "loans_delivered", "fe_attr": "delivered", "fe_fin": "financials_raw", "fe_click": "clicks_delivered",
}


def delivered_files(spark: SparkSession, sf: str) -> dict[str, str]:
    return {dataset: csv_copy(spark, sf, name) for dataset, name in DELIVERED.items()}


def backfilled(spark: SparkSession, sf: str) -> backfill.Layout:
    """Delivered CSV files through all layers."""
    return backfill.backfill(spark, delivered_files(spark, sf), scratch_path(spark, "mart"), ALL_MONTHS)


def backfill_features(spark: SparkSession, sf: str) -> DataFrame:
    return tables.read_snapshots(spark, backfilled(spark, sf).gold("joined_features"))


def backfill_labels(spark: SparkSession, sf: str) -> DataFrame:
    return tables.read_snapshots(spark, backfilled(spark, sf).gold("label_store"))


def backfill_second_run(spark: SparkSession, sf: str) -> DataFrame:
    """A later run that brings a loan type and a click column the first run did not have."""
    root, paths = scratch_path(spark, "mart"), delivered_files(spark, sf)
    paths["fe_fin"] = csv_copy(spark, sf, "financials_grown")
    early = scratch_path(spark, "early_clicks")
    tables.write_csv(view(spark, sf, "clicks_delivered").drop("fe_20"), early)
    backfill.backfill(spark, {**paths, "fe_click": early}, root, MONTHS[:2])
    layout = backfill.backfill(spark, paths, root, MONTHS[2:])
    return tables.read_snapshots(spark, layout.gold("joined_features"))


def backfill_two_runs_equal_one(spark: SparkSession, sf: str) -> DataFrame:
    """Feature rows of one run, of two runs over the same files, and those alike in every column.

    The second run knows a loan type the first one has not seen. Whole rows are compared by
    their SHA-256, so that 32 bytes a row are shuffled.
    """
    paths = delivered_files(spark, sf)
    paths["fe_fin"] = csv_copy(spark, sf, "financials_grown")
    counts = {}
    for name, spans in {"one_run": [MONTHS], "two_runs": [MONTHS[:2], MONTHS[2:]]}.items():
        root = scratch_path(spark, name)
        for span in spans:
            layout = backfill.backfill(spark, paths, root, span)
        rows = tables.read_snapshots(spark, layout.gold("joined_features"))
        whole = F.to_json(F.struct(*[quoted(c) for c in sorted(rows.columns)]), {"ignoreNullFields": "false"})
        digest = F.unhex(F.sha2(whole, 256)).alias("row")
        counts[name] = rows.groupBy("snapshot_date", digest).agg(F.count("*").alias(name))
    both = counts["one_run"].join(counts["two_runs"], ["snapshot_date", "row"], "full").fillna(0)
    return both.groupBy("snapshot_date").agg(
        F.sum("one_run").alias("one_run"), F.sum("two_runs").alias("two_runs"),
        F.sum(F.least("one_run", "two_runs")).alias("alike"),
    )


# Cutoffs that see no February, or all of it.
KEPT_CUTOFFS = [*ALL_MONTHS[:2], *ALL_MONTHS[4:]]


def click_history_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Totals kept from month to month; February comes late for some customers and is corrected for others."""
    root, by_day = scratch_path(spark, "clicks"), F.col("snapshot_date")
    silver, totals = f"{root}/silver", f"{root}/totals"
    tables.write_table(clean.clicks(view(spark, sf, "clicks_delivered")), f"{root}/delivered")
    delivered = spark.read.parquet(f"{root}/delivered").filter(by_day.isin(ALL_MONTHS))
    january, february, march, *later = ALL_MONTHS

    def deliver(rows: DataFrame, *months, cutoffs) -> None:
        tables.write_snapshots(rows.filter(by_day.isin(list(months))), silver, dates=months)
        if cutoffs:
            click_history.update(spark, silver, totals, cutoffs)

    number = F.col("Customer_ID").cast("bigint")
    wrong = F.when(number % 5 == 2, F.col("fe_4") + 1000).otherwise(F.col("fe_4"))
    deliver(delivered, january, cutoffs=[january, february])
    deliver(delivered.filter(number % 4 != 1).withColumn("fe_4", wrong), february, cutoffs=[march])
    deliver(delivered, march, cutoffs=[later[0]])
    deliver(delivered, february, cutoffs=[])
    deliver(delivered, later[0], cutoffs=[later[1]])
    deliver(delivered, *later[1:], cutoffs=later[2:])
    return click_history.read(spark, totals, KEPT_CUTOFFS)


def spine_dates(spark: SparkSession, sf: str) -> DataFrame:
    """The spine next to the loans that start on each of its dates."""
    dates = spine.spine_frame(spark, "1997-01-15", "1998-12-01")
    starts = labels(spark, sf).groupBy("loan_start_date").agg(F.count("*").alias("loans"))
    return (
        dates.join(starts, dates.snapshot_date == starts.loan_start_date, "left")
        .select("snapshot_date", F.coalesce("loans", F.lit(0)).alias("loans"))
    )


# -- reports over several columns ----------------------------------------


def key_guard(spark: SparkSession, sf: str) -> DataFrame:
    clicks = silver_clicks(spark, sf)
    return assemble.all_key_counts({
        "attributes": gold_attributes(spark, sf),
        "financials": gold_financials(spark, sf),
        "clicks": clicks,
        "broken": clicks.withColumn("Customer_ID", F.nullif("Customer_ID", F.lit("7"))),
    })


def table_overview(spark: SparkSession, sf: str) -> DataFrame:
    return quality.table_overview({
        "labels": (labels(spark, sf), ["loan_id", "snapshot_date"]),
        "attributes": (gold_attributes(spark, sf), config.KEYS),
        "financials": (gold_financials(spark, sf), config.KEYS),
        "clickstream": (gold_clicks(spark, sf), config.KEYS),
        "click rows": (silver_clicks(spark, sf), config.KEYS),
    })


def missing_percent(spark: SparkSession, sf: str) -> DataFrame:
    named = {
        "attributes": gold_attributes(spark, sf),
        "financials": gold_financials(spark, sf),
        "joined": joined(spark, sf),
    }
    return reduce(DataFrame.unionByName, [
        quality.missing_percent(df).select(F.lit(name).alias("table"), "*")
        for name, df in named.items()
    ])


def stored_states(
    spark: SparkSession, table: DataFrame, categories: Sequence[str] = ()
) -> DataFrame:
    """States of a table that grows by a second run; each run scans what it wrote."""
    rows, states = scratch_path(spark, "rows"), scratch_path(spark, "states")
    early = F.col("snapshot_date") < "2024-03-01"
    for part in (early, F.coalesce(~early, F.lit(True))):
        tables.write_snapshots(table.filter(part), rows)
        profiles.update(spark, rows, states, categories=categories)
    return profiles.read(spark, states)


def profile_missing(spark: SparkSession, sf: str) -> DataFrame:
    named = {
        "attributes": gold_attributes(spark, sf),
        "financials": gold_financials(spark, sf),
        "joined": joined(spark, sf),
    }
    return reduce(DataFrame.unionByName, [
        profiles.missing_percent(stored_states(spark, df)).select(F.lit(name).alias("table"), "*")
        for name, df in named.items()
    ])


def profile_described(spark: SparkSession, sf: str) -> DataFrame:
    """The measures of the ratios that states hold exactly."""
    described = profiles.describe(stored_states(spark, gold_financials(spark, sf)))
    return described.where(F.col("column").isin(RATIOS)).select("column", "count", "mean", "std", "min", "max")


def profile_flags(spark: SparkSession, sf: str) -> DataFrame:
    rates = profiles.flag_percentages(stored_states(spark, gold_financials(spark, sf)))
    return rates.where(F.col("flag").isin(FLAGS))


def profile_status_counts(spark: SparkSession, sf: str) -> DataFrame:
    found = stored_states(spark, gold_financials(spark, sf), ["loan_count_status"])
    return profiles.value_counts(found, "loan_count_status")


def financial_percentiles(spark: SparkSession, sf: str) -> DataFrame:
    return profile.describe_numbers(gold_financials(spark, sf), RATIOS, [0.01, 0.5, 0.99])


def grouped_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    """Quantiles per return flag, by narrowing even at a small scale."""
    lines = spark.read.parquet(f"{sf}/lineitem.parquet")
    found = exact_quantiles(
        lines, ["l_extendedprice", "l_quantity"], [0.05, 0.5], keys=["l_returnflag"],
        one_task_rows=2_000, gather_rows=500,
    )
    return found.select(
        "l_returnflag",
        F.get("l_extendedprice", F.lit(0)).alias("price_p05"),
        F.get("l_extendedprice", F.lit(1)).alias("price_p50"),
        F.get("l_quantity", F.lit(0)).alias("quantity_p05"),
        F.get("l_quantity", F.lit(1)).alias("quantity_p50"),
    )


def split_membership(spark: SparkSession, sf: str) -> DataFrame:
    return assigned(spark, sf).select("loan_id", "label", "split")


def train_fill_values(spark: SparkSession, sf: str) -> DataFrame:
    return parameters(spark, sf).filter("kind = 'numeric'").select("source_col", "fill")


def scaler_parameters(spark: SparkSession, sf: str) -> DataFrame:
    return parameters(spark, sf).filter("kind = 'numeric'").select("source_col", "mean", "scale")


def onehot_columns(spark: SparkSession, sf: str) -> DataFrame:
    return parameters(spark, sf).filter("kind = 'category'").select(
        "source_col", "category", "out_col"
    )


def imputed_sets(spark: SparkSession, sf: str) -> DataFrame:
    rows, fields = fitted(spark, sf)
    return preprocess.filled(rows, fields).groupBy("split").agg(
        F.sum("Outstanding_Debt").cast("double").alias("debt"),
        F.sum("Age").alias("age"),
        F.sum("fe_1_mean").alias("fe_1"),
    )


def encoded_sets(spark: SparkSession, sf: str) -> DataFrame:
    rows, fields = fitted(spark, sf)
    return preprocess.transform(rows, fields).drop("label_def")


def encoded_new_loans(spark: SparkSession, sf: str) -> DataFrame:
    """Stored parameters, read back, applied to loans at another month on book."""
    path = scratch_path(spark, "prepared")
    labels_path, features_path = f"{path}/labels", f"{path}/features"
    tables.write_snapshots(labels(spark, sf), labels_path)
    tables.write_table(view(spark, sf, "feature_rows"), features_path)
    prepare.prepare_tables(spark, features_path, labels_path, path)
    new_labels = loans.default_label(exact_loans(spark, sf), mob=3)
    new_loans = assemble.labelled_features(new_labels, spark.read.parquet(features_path))
    return prepare.encode_new_loans(spark, path, new_loans).select(
        "loan_id", "Age", "Outstanding_Debt", "fe_1_mean", "Occupation_Clerk", "age_invalid_True"
    )


QUERIES: dict[str, Query] = {
    # sources and sinks
    "spine_dates": spine_dates,
    "snapshot_ingest": snapshot_ingest,
    "csv_sql_inferred": lambda s, d: sql_over_csv(s, d, True),
    "csv_sql_text": lambda s, d: sql_over_csv(s, d, False),
    "rewritten_snapshot": rewritten_snapshot,
    "pruned_snapshot": pruned_snapshot,
    "merged_columns": merged_columns,
    "stored_table": stored_table,
    # loans
    "loan_delinquency": silver_loans,
    "default_label": lambda s, d: loans.default_label(silver_loans(s, d)),
    "default_label_other_terms": lambda s, d: loans.default_label(silver_loans(s, d), dpd=60, mob=3),
    "delinquency_extremes": lambda s, d: loans.delinquency(view(s, d, "loans_extreme")),
    "default_label_extremes": lambda s, d: loans.default_label(loans.delinquency(view(s, d, "loans_extreme"))),
    "default_rate_by_cohort": lambda s, d: loans.default_rate(labels(s, d), "loan_start_date"),
    "default_rate_by_label_date": lambda s, d: loans.default_rate(labels(s, d)),
    "mob_performance_curve": lambda s, d: loans.performance_curve(exact_loans(s, d)),
    "bad_by_month": lambda s, d: loans.bad_by_month(exact_loans(s, d)),
    "loan_summary": lambda s, d: quality.loan_summary(exact_loans(s, d)),
    "first_loan_rows": lambda s, d: profile.first_rows(
        exact_loans(s, d).select("loan_id", "mob", "overdue_amt", "dpd"), ["loan_id", "mob"]
    ),
    "duplicate_loan_keys": lambda s, d: assemble.duplicate_keys(
        s.read.parquet(f"{d}/lineitem.parquet"), ["l_orderkey", "l_linenumber"]
    ),
    # cleaning
    "attributes_silver": silver_attributes,
    "financials_silver": silver_financials,
    "clicks_silver": silver_clicks,
    "attribute_quality": lambda s, d: quality.attribute_quality(silver_attributes(s, d)),
    "financial_quality": lambda s, d: quality.financial_quality(silver_financials(s, d)),
    "duplicate_click_rows": lambda s, d: quality.duplicate_click_rows(
        view(s, d, "clicks_raw"), silver_clicks(s, d)
    ),
    # features
    "loan_vocabulary": lambda s, d: features.loan_vocabulary(silver_financials(s, d)),
    "attributes_gold": gold_attributes,
    "financials_gold": gold_financials,
    "click_history_asof": lambda s, d: history.asof_history(silver_clicks(s, d), DAYS),
    "click_history_monthly": gold_clicks,
    "key_guard_counts": key_guard,
    "joined_features": joined,
    "bucketed_features": bucketed_features,
    "bucketed_labelled": bucketed_labelled,
    "backfill_features": backfill_features,
    "backfill_labels": backfill_labels,
    "backfill_second_run": backfill_second_run,
    "backfill_two_runs_equal_one": backfill_two_runs_equal_one,
    "click_history_incremental": click_history_incremental,
    "joined_audit": lambda s, d: quality.joined_audit(joined(s, d)),
    "labelled_features": labelled,
    # sets
    "oot_dates": lambda s, d: split.oot_dates(labelled(s, d)),
    "split_membership": split_membership,
    "split_report": lambda s, d: split.split_report(assigned(s, d)),
    "train_fill_values": train_fill_values,
    "scaler_parameters": scaler_parameters,
    "onehot_columns": onehot_columns,
    "imputed_sets": imputed_sets,
    "encoded_sets": encoded_sets,
    "encoded_new_loans": encoded_new_loans,
    # raw checks
    "raw_frequencies": lambda s, d: profile.frequencies(raw_financials(s, d), [
        "Credit_Mix", "Payment_Behaviour", "Type_of_Loan", "Num_Credit_Inquiries", "Interest_Rate",
    ]),
    "occupation_frequency": lambda s, d: profile.frequency(raw_attributes(s, d), "Occupation"),
    "loan_term_frequencies": lambda s, d: profile.frequencies(
        view(s, d, "loans"), ["tenure", "installment_num"]
    ),
    "valid_age_frequency": lambda s, d: raw_checks.valid_age_frequency(raw_attributes(s, d)),
    "age_listing_valid": lambda s, d: raw_checks.age_listing(raw_attributes(s, d), True),
    "age_listing_invalid": lambda s, d: raw_checks.age_listing(raw_attributes(s, d), False),
    "age_validity": lambda s, d: raw_checks.age_validity(raw_attributes(s, d)),
    "loan_type_frequency": lambda s, d: raw_checks.loan_type_frequency(raw_financials(s, d)),
    "loan_count_comparison": lambda s, d: raw_checks.loan_count_comparison(raw_financials(s, d)),
    "loan_count_status": lambda s, d: raw_checks.loan_count_status(raw_financials(s, d)),
    "customer_rows": lambda s, d: raw_checks.customer_rows(silver_clicks(s, d), "7"),
    "zero_loans_without_list": lambda s, d: raw_checks.zero_loans_without_list(raw_financials(s, d)),
    "negative_debt": lambda s, d: raw_checks.negative_debt(raw_financials(s, d)),
    "invalid_dates": lambda s, d: raw_checks.invalid_dates(view(s, d, "delivered")),
    "field_validity": lambda s, d: raw_checks.field_validity(raw_financials(s, d)),
    "invested_distribution": lambda s, d: raw_checks.invested_distribution(raw_financials(s, d)),
    "invested_histogram": lambda s, d: raw_checks.invested_histogram(raw_financials(s, d)),
    "invested_placeholder_histogram": lambda s, d: raw_checks.invested_histogram(raw_financials(s, d), True),
    "inquiry_decimals": lambda s, d: raw_checks.inquiry_decimals(raw_financials(s, d)),
    "range_summary": lambda s, d: raw_checks.range_summary(raw_financials(s, d)),
    "value_spreads": lambda s, d: raw_checks.value_spreads(raw_financials(s, d), list(config.VALUE_RANGES)),
    "salary_ratio_summary": lambda s, d: raw_checks.salary_ratio_summary(raw_financials(s, d)),
    "emi_log_histogram": lambda s, d: raw_checks.log_ratio_histogram(
        raw_checks.salary_ratios(raw_financials(s, d)), "emi_to_salary"
    ),
    "income_log_histogram": lambda s, d: raw_checks.log_ratio_histogram(
        raw_checks.salary_ratios(raw_financials(s, d)), "income_to_salary"
    ),
    "lowest_balances": lambda s, d: raw_checks.lowest_balances(raw_financials(s, d)),
    "describe_financials": lambda s, d: profile.describe_all(
        raw_financials(s, d).withColumn("salary", raw_checks.number("Monthly_Inhand_Salary"))
    ),
    "describe_loans": lambda s, d: profile.describe_all(stored_view(s, d, "loans")),
    # gold reports
    "table_overview": table_overview,
    "missing_percent": missing_percent,
    "profile_missing": profile_missing,
    "profile_described": profile_described,
    "profile_flags": profile_flags,
    "profile_status_counts": profile_status_counts,
    "income_gap_summary": lambda s, d: gold_reports.income_gap_summary(gold_financials(s, d)),
    "income_percentiles": lambda s, d: profile.describe_numbers(
        pairs(s, d), ["Annual_Income", "Monthly_Inhand_Salary", "ratio"], [0.01, 0.05, 0.5, 0.95, 0.99]
    ),
    "lowest_income_ratios": lambda s, d: profile.extremes(pairs(s, d), "ratio", 10, ties=config.KEYS),
    "highest_income_ratios": lambda s, d: profile.extremes(
        pairs(s, d), "ratio", 10, ascending=False, ties=config.KEYS
    ),
    "income_sample": lambda s, d: profile.seeded_sample(pairs(s, d), config.KEYS, rows=100),
    "income_ratio_log_histogram": lambda s, d: raw_checks.log_ratio_histogram(pairs(s, d), "ratio"),
    "income_gap_monthly": lambda s, d: gold_reports.income_gap_monthly(pairs(s, d)),
    "repeat_customers": lambda s, d: gold_reports.repeat_customers(pairs(s, d)),
    "income_vs_customer_median": lambda s, d: gold_reports.income_vs_customer_median(pairs(s, d)),
    "most_unusual_incomes": lambda s, d: gold_reports.most_unusual_incomes(pairs(s, d)),
    "lowest_ratio_customer": lambda s, d: gold_reports.lowest_ratio_customer(pairs(s, d)),
    "financial_percentiles": financial_percentiles,
    "grouped_quantiles": grouped_quantiles,
    "trimmed_histogram": lambda s, d: profile.trimmed_histogram(
        gold_financials(s, d), "Disposable_Income", 40
    ),
    "trimmed_histogram_instalments": lambda s, d: profile.trimmed_histogram(
        gold_financials(s, d), "EMI_to_Salary_Ratio", 40
    ),
    "trimmed_histogram_debt": lambda s, d: profile.trimmed_histogram(
        gold_financials(s, d), "Debt_to_Income", 40
    ),
    "trimmed_histogram_history": lambda s, d: profile.trimmed_histogram(
        gold_financials(s, d), "Credit_History_Months", 40
    ),
    "tenth_histogram": lambda s, d: profile.histogram(
        s.read.parquet(f"{d}/lineitem.parquet"), F.col("l_discount").cast("double"), 100, 0, 1
    ),
    "age_histogram": lambda s, d: profile.histogram(gold_attributes(s, d), F.col("Age"), 30),
    "click_days_histogram": lambda s, d: profile.histogram(
        gold_clicks(s, d), F.col("clickstream_days"), 30
    ),
    "describe_click_history": lambda s, d: profile.describe_numbers(
        gold_clicks(s, d), [f"fe_{k}_mean" for k in range(1, 21)]
    ),
    "financial_flag_rates": lambda s, d: profile.flag_percentages(
        gold_financials(s, d),
        ["loan_count_suspicious", "loan_types_missing", "interest_rate_invalid", "annual_income_invalid"],
    ),
    "attribute_flag_rates": lambda s, d: profile.flag_percentages(
        gold_attributes(s, d), ["age_invalid", "occupation_missing"]
    ),
    "status_value_counts": lambda s, d: profile.value_counts(gold_financials(s, d), "loan_count_status"),
    "credit_mix_value_counts": lambda s, d: profile.value_counts(silver_financials(s, d), "Credit_Mix"),
    "top_occupations": lambda s, d: profile.value_counts(gold_attributes(s, d), "Occupation", 15),
    "label_value_counts": lambda s, d: profile.value_counts(labels(s, d), "label"),
    "click_coverage": lambda s, d: gold_reports.checked_click_coverage(
        gold_attributes(s, d), gold_clicks(s, d)
    ),
}
