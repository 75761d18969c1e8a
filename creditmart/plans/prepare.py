"""Dataset preparation: labelled features to encoded train, test and OOT sets."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditmart.operators import assemble, preprocess, split
from creditmart.sources import log, tables


SETS = ("train", "test", "oot")
# The column by which parameters are kept, and the note of the sets that names theirs.
FIT = "fit"


@dataclass(frozen=True)
class Prepared:
    plan: split.SplitPlan
    fields: list[preprocess.Field]
    rows: DataFrame
    encoded: DataFrame


def prepare(
    labelled: DataFrame,
    oot_fraction: float = 0.2,
    test_size: float = 0.2,
    seed: int = 55,
    bool_policy: str = "by_nulls",
    accuracy: int | None = None,
) -> Prepared:
    """Split, fit on the train rows, encode all rows with one projection.

    The labelled rows are scanned once per pass (split counts, statistics,
    medians, categories), reading only the columns that pass needs; store them
    first when the join before is expensive, as ``prepare_tables`` does. Medians
    are exact unless an ``accuracy`` is given.
    """
    plan = split.plan_split(labelled, oot_fraction, test_size, seed)
    rows = split.assign_split(labelled, plan)
    kinds = preprocess.column_kinds(
        labelled, preprocess.feature_columns(labelled), bool_policy
    )
    fields = preprocess.fit(rows.filter("split = 'train'"), kinds, accuracy)
    return Prepared(plan, fields, rows, preprocess.transform(rows, fields))


def prepare_tables(
    spark: SparkSession,
    features_path: str,
    labels_path: str,
    output_path: str,
    oot_fraction: float = 0.2,
    test_size: float = 0.2,
    seed: int = 55,
) -> Prepared:
    """From the stored label and feature tables to stored sets and parameters.

    ``output_path`` receives ``labelled`` (the join, read by every later pass),
    ``preprocessor``, and ``sets`` partitioned by ``split``. All three sets are
    replaced at once, by an empty one where no rows fall into it, and with them the
    parameters that count: a run that fails leaves the sets and parameters of
    the run before.
    """
    joined = assemble.labelled_features(
        tables.read_snapshots(spark, labels_path), tables.read_snapshots(spark, features_path)
    )
    tables.write_table(joined, f"{output_path}/labelled")
    prepared = prepare(
        spark.read.parquet(f"{output_path}/labelled"), oot_fraction, test_size, seed
    )
    fit = uuid.uuid4().hex
    parameters = preprocess.parameters_frame(spark, prepared.fields).withColumn(FIT, F.lit(fit))
    tables.write_snapshots(parameters, f"{output_path}/preprocessor", by=FIT, values=[fit])
    tables.write_snapshots(prepared.encoded, f"{output_path}/sets", by="split", values=SETS, note={FIT: fit})
    return prepared


def load_set(spark: SparkSession, output_path: str, name: str) -> DataFrame:
    """One of ``train``, ``test`` and ``oot``; the other sets are not read."""
    return tables.read_snapshots(spark, f"{output_path}/sets", values=[name], by="split").drop("split")


def load_fields(spark: SparkSession, output_path: str) -> list[preprocess.Field]:
    """The parameters the stored sets were made with."""
    fit = list(log.latest(spark, f"{output_path}/sets").notes.values())[-1][FIT]
    stored = tables.read_snapshots(spark, f"{output_path}/preprocessor", values=[fit], by=FIT)
    return preprocess.load_fields(stored.drop(FIT))


def encode_new_loans(spark: SparkSession, output_path: str, rows: DataFrame) -> DataFrame:
    """Prepare loans outside the sets with the stored parameters."""
    return preprocess.transform(rows, load_fields(spark, output_path))
