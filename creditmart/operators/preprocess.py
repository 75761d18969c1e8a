"""Model inputs: fill, one-hot and scale, with parameters learnt on train rows only.

``fit`` returns one ``Field`` per source column; the fields travel as a small
table, and ``transform`` turns them into one projection.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditmart.config import MAX_COLUMNS, MEAN_FILL_COLUMNS, METADATA_COLUMNS
from creditmart.functions.columns import quoted, usable
from creditmart.functions.quantiles import quantiles

EPSILON = 2.220446049250313e-16
NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")

PARAMETER_SCHEMA = T.StructType([
    T.StructField("ordinal", T.IntegerType()),
    T.StructField("source_col", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("fill", T.DoubleType()),
    T.StructField("mean", T.DoubleType()),
    T.StructField("scale", T.DoubleType()),
    T.StructField("out_col", T.StringType()),
])


@dataclass(frozen=True)
class Field:
    """One output column: ``numeric`` (scaled), ``flag`` (as is) or ``category`` (0/1)."""

    ordinal: int
    source_col: str
    kind: str
    category: str | None
    fill: float | None
    mean: float | None
    scale: float | None
    out_col: str


def feature_columns(rows: DataFrame, metadata: Sequence[str] = METADATA_COLUMNS) -> list[str]:
    """Every column that is neither metadata nor the split itself."""
    return [c for c in rows.columns if c not in [*metadata, "split"]]


def column_kinds(rows: DataFrame, columns: Sequence[str], bool_policy: str = "by_nulls") -> dict[str, str]:
    """``numeric``, ``flag`` or ``category`` per column.

    Under ``by_nulls`` a true/false column with any unknown in ``rows`` (the
    whole labelled set) is a category of its own, so unknown is neither; under
    ``numeric`` every true/false column is a flag.
    """
    types = dict(rows.dtypes)
    flags = [c for c in columns if types[c] == "boolean"]
    with_nulls: set[str] = set()
    if bool_policy == "by_nulls" and flags:
        missing = rows.agg(*[F.count_if(quoted(c).isNull()).alias(c) for c in flags]).first()
        with_nulls = {c for c in flags if missing[c]}

    def kind(column: str) -> str:
        if column in flags:
            return "category" if column in with_nulls else "flag"
        return "numeric" if types[column] in NUMERIC else "category"

    return {column: kind(column) for column in columns}


def fill_rule(column: str, mean_columns: Sequence[str] = MEAN_FILL_COLUMNS) -> str:
    """``mean``, ``active_mean`` (customers with click history) or ``median``."""
    if column in mean_columns:
        return "mean"
    return "active_mean" if column.startswith("fe_") and column.endswith("_mean") else "median"


def train_statistics(
    train: DataFrame, numeric: Sequence[str], accuracy: int | None = None
) -> dict[str, dict[str, float]]:
    """Fill value, and mean and population deviation after filling, per column.

    One pass gives counts, means and variances; the medians come from
    ``functions.quantiles``, exact unless an ``accuracy`` is given. Filling with a
    constant changes mean and variance in closed form, so the filled rows are not
    scanned again.
    """
    types = dict(train.dtypes)
    rules = {c: fill_rule(c) for c in numeric}
    aggregates = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(numeric):
        value = usable(quoted(c), types[c]).cast("double")
        aggregates += [
            F.count(value).alias(f"n_{i}"), F.avg(value).alias(f"mean_{i}"),
            F.var_pop(value).alias(f"var_{i}"),
        ]
        if rules[c] == "active_mean":
            active = F.when(F.col("has_clickstream") == 1, value)
            aggregates.append(F.avg(active).alias(f"active_{i}"))
    seen = train.agg(*aggregates).first()
    by_median = {c: seen[f"n_{i}"] for i, c in enumerate(numeric) if rules[c] == "median"}
    medians = {}
    if by_median:
        medians = quantiles(
            train, list(by_median), [0.5], accuracy=accuracy, total=sum(by_median.values())
        ).first()

    result = {}
    for i, c in enumerate(numeric):
        n, mean, var = seen[f"n_{i}"], seen[f"mean_{i}"], seen[f"var_{i}"]
        if rules[c] == "median":
            fill = medians[c][0] if medians[c] else None
        else:
            fill = seen[f"active_{i}"] if rules[c] == "active_mean" else mean
        result[c] = {"fill": fill, **_after_filling(seen["rows"], n, mean, var, fill)}
        if any(value is not None and abs(value) == float("inf") for value in (fill, mean)):
            raise ValueError(f"{c}: infinite values cannot be scaled")
    return result


def _after_filling(rows: int, n: int, mean: float, var: float, fill: float) -> dict:
    if not n:
        return {"mean": None, "scale": None}
    missing = rows - n if fill is not None else 0
    total = n + missing
    middle = (n * mean + missing * (fill or 0.0)) / total
    spread = n * (var + (mean - middle) ** 2) + missing * ((fill or 0.0) - middle) ** 2
    variance = spread / total
    # A column that is constant up to rounding is only centred.
    constant = variance <= total * EPSILON * variance + (total * middle * EPSILON) ** 2
    return {"mean": middle, "scale": 1.0 if constant else variance**0.5}


def train_categories(train: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Sorted categories per column: the output columns.

    More than ``MAX_COLUMNS`` of them raise an error that names the columns with most.
    """
    found: dict[str, list[str]] = {c: [] for c in columns}
    if columns:
        types = dict(train.dtypes)
        pairs = F.array(*[
            F.struct(F.lit(c).alias("source_col"), _category(c, types[c]).alias("category"))
            for c in columns
        ])
        seen = train.select(F.inline(pairs)).filter("category is not null").distinct()
        for row in seen.limit(MAX_COLUMNS + 1).collect():
            found[row.source_col].append(row.category)
        if sum(map(len, found.values())) > MAX_COLUMNS:
            sizes = seen.groupBy("source_col").count().orderBy(F.desc("count")).limit(3).collect()
            raise ValueError(f"more than {MAX_COLUMNS} categories: {[tuple(row) for row in sizes]}")
    return {c: sorted(values) for c, values in found.items()}


def _category(column: str, dtype: str) -> Column:
    text = quoted(column).cast("string")
    return F.initcap(text) if dtype == "boolean" else text


def fit(train: DataFrame, kinds: dict[str, str], accuracy: int | None = None) -> list[Field]:
    """Learn the fields; ``kinds`` comes from ``column_kinds`` of the whole set.

    Filled and flag columns keep their order; the 0/1 columns follow. Medians are
    exact unless an ``accuracy`` is given.
    """
    numeric = [c for c, kind in kinds.items() if kind == "numeric"]
    statistics = train_statistics(train, numeric, accuracy)
    categories = train_categories(train, [c for c, kind in kinds.items() if kind == "category"])
    plain = [
        (c, kind, None, statistics.get(c, {}), c) for c, kind in kinds.items() if kind != "category"
    ]
    dummies = [
        (c, "category", value, {}, f"{c}_{value}") for c in categories for value in categories[c]
    ]
    return [
        Field(i, c, kind, value, known.get("fill"), known.get("mean"), known.get("scale"), out)
        for i, (c, kind, value, known, out) in enumerate(plain + dummies)
    ]


def parameters_frame(spark: SparkSession, fields: Sequence[Field]) -> DataFrame:
    """The fields as a table to store, one row per output column."""
    return spark.createDataFrame([tuple(asdict(f).values()) for f in fields], PARAMETER_SCHEMA)


def load_fields(parameters: DataFrame) -> list[Field]:
    return [Field(**row.asDict()) for row in parameters.orderBy("ordinal").collect()]


def filled(rows: DataFrame, fields: Sequence[Field]) -> DataFrame:
    """Only the imputation, for inspection; columns that never had a value stay null."""
    types = dict(rows.dtypes)
    return rows.withColumns({
        f.source_col: F.coalesce(usable(quoted(f.source_col), types[f.source_col]), F.lit(f.fill))
        for f in fields
        if f.kind == "numeric" and f.fill is not None
    })


def transform(rows: DataFrame, fields: Sequence[Field]) -> DataFrame:
    """Metadata and encoded columns of any rows: the sets, or new loans.

    Unseen and missing categories give zeros in all columns of that category.
    """
    types = dict(rows.dtypes)
    metadata = [c for c in [*METADATA_COLUMNS, "split"] if c in rows.columns]

    def encoded(f: Field) -> Column:
        source = quoted(f.source_col)
        if f.kind == "flag":
            return source
        if f.kind == "category":
            same = _category(f.source_col, types[f.source_col]) == F.lit(f.category)
            return F.coalesce(same, F.lit(False)).cast("int")
        value = usable(source, types[f.source_col]).cast("double")
        if f.fill is not None:
            value = F.coalesce(value, F.lit(f.fill))
        return value if f.scale is None else (value - F.lit(f.mean)) / F.lit(f.scale)

    return rows.select(*metadata, *[encoded(f).alias(f.out_col) for f in fields])
