"""URL filters by a sort-merge range join; DataFrame functions only.

A rule (host, path) becomes the key ``reversed host . / path``: all keys it fits
start with it, so it is an interval of keys, and two intervals are nested or
apart. A url has one key per suffix of its host, since a rule with a path
also fits subdomains; suffixes of more labels than any rule fit none and have no key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from creditmart.functions.joins import attach
from creditmart.session import ensure_checkpoint_dir

RULE_COLUMNS = "host string, path string, verdict string"
# Between host and path in a key; no host has one.
_GAP = "/"
# Follows every key that starts with an interval's key; no UTF-8 text has this byte.
_AFTER = b"\xff"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path. The host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the
    end, in lower case; the path goes on up to ``?``, ``#`` or the end. Both are
    empty without a url or without ``://``.
    """
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.char_length(host) + 1), r"^[^?#]*", 0)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lower, F.lit("")), F.coalesce(path, F.lit(""))


def _reversed_host(host: Column) -> Column:
    return F.array_join(F.reverse(F.split(host, r"\.")), ".")


def _key(host: Column, path: Column) -> Column:
    return F.concat(_reversed_host(host), F.lit(_GAP), path).cast("binary")


def _breakpoints(rules: DataFrame) -> DataFrame:
    """Where the stack of active rules changes: ``key`` and the rule on top from there on.

    Every rule opens at its key and closes behind it. What is on top after a
    close is the rule around, the longest shorter prefix that is a rule itself.
    A rule given twice counts once; a block wins over an allow.
    """
    single = (
        rules.select(
            F.coalesce("host", F.lit("")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict"
        )
        .where("verdict in ('allow', 'block')").where(~F.col("host").rlike("[/?#]"))
        .groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
        .select(
            _key(F.col("host"), F.col("path")).alias("key"),
            F.struct(F.concat("host", "path").alias("rule"), "verdict", F.char_length(F.concat("host", "path")).alias("length"), F.char_length("host").alias("host_length")).alias("top"),
            (F.octet_length(F.col("host")) + 1).alias("shortest"),
        )
    )
    # Prefixes of a key that can be rules: the same host with a shorter path.
    prefixes = single.select(
        F.col("key").alias("inner"),
        F.explode(F.sequence("shortest", F.octet_length("key"))).alias("size"),
    ).where("size < octet_length(inner)").select("inner", F.expr("substring(inner, 1, size)").alias("key"))
    around = (
        prefixes.join(single.select("key", "top"), "key")
        .groupBy(F.col("inner").alias("key")).agg(F.max_by("top", F.octet_length("key")).alias("around"))
    )
    opens = single.select("key", F.lit(1).alias("kind"), "top")
    closes = single.join(around, "key", "left").select(
        F.concat("key", F.lit(_AFTER)).alias("key"), F.lit(0).alias("kind"), F.col("around").alias("top")
    )
    return opens.unionByName(closes)


def _swept(probes: DataFrame, points: DataFrame, tasks: int) -> DataFrame:
    """The innermost rule over each probe's key: ``host``, ``path``, ``top``.

    Probes and breakpoints are sorted together by ranges of keys. Each range is
    swept from its first key on, and starts with the last breakpoint of the
    ranges before it; only one row per range is gathered for that. Equal keys
    may be cut into several ranges, so a hot key is no bottleneck.
    """
    spread = F.xxhash64("host", "path")
    events = points.select(
        "key", "kind", F.lit(0).cast("bigint").alias("spread"), F.struct("top").alias("point"),
        F.lit(None).cast("string").alias("host"), F.lit(None).cast("string").alias("path"),
    ).unionByName(probes.select(
        "key", F.lit(2).alias("kind"), spread.alias("spread"), F.lit(None).cast(_point_type(points)).alias("point"), "host", "path",
    ))
    ordered = (
        events.repartitionByRange(tasks, "key", "kind", "spread")
        .withColumn("range", F.spark_partition_id()).checkpoint()
    )
    inner = Window.partitionBy("range").orderBy("key", "kind")
    swept = ordered.withColumn("inside", F.last("point", ignorenulls=True).over(inner))
    lasts = ordered.groupBy("range").agg(F.max_by("point", F.when(F.col("point").isNotNull(), F.struct("key", "kind"))).alias("last"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    carried = lasts.select("range", F.last("last", ignorenulls=True).over(before).alias("carried"))
    # One row per range: as many as tasks.
    return (
        swept.where("kind = 2").join(F.broadcast(carried), "range")
        .select("host", "path", F.coalesce("inside", "carried")["top"].alias("top"))
    )


def _point_type(points: DataFrame) -> str:
    return f"struct<top: {points.schema['top'].dataType.simpleString()}>"


def filter_urls(
    pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow"
) -> DataFrame:
    """``row`` with ``host``, ``path``, ``rule`` and ``verdict``.

    A rule fits its host and all subdomains, if the path starts with its path; the
    longest rule wins, on a tie the one with the longer host. ``default`` is the
    verdict where none fits. A null url, or one without ``://``, has an empty host
    and path. Rules need no order; repeated rules count once, and ones without a
    verdict of allow or block are ignored. Distinct hosts and paths are judged once,
    so repeated urls cost one sweep; a very long url costs as many keys as the
    deepest rule has labels.
    """
    spark = pages.sparkSession
    ensure_checkpoint_dir(spark)
    host, path = split_url(F.col(f"row.{url}"))
    rows = pages.select(F.struct(*[pages[name] for name in pages.columns]).alias("row"))
    rows = rows.select("row", host.alias("host"), path.alias("path"))
    distinct = rows.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    deepest = rules.agg(F.max(F.size(F.split(F.coalesce("host", F.lit("")), r"\.")))).first()[0] or 1
    suffixes = F.transform(
        F.sequence(F.lit(1), F.least(F.size(labels), F.lit(deepest))),
        lambda n: F.array_join(F.slice(labels, -n, n), "."),
    )
    probes = distinct.select("host", "path", F.explode(suffixes).alias("suffix")).select(
        "host", "path", _key(F.col("suffix"), F.col("path")).alias("key")
    )
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    swept = _swept(probes, _breakpoints(rules), tasks).where("top.rule is not null")
    longest = swept.groupBy("host", "path").agg(
        F.max_by("top", F.struct("top.length", "top.host_length")).alias("top")
    )
    return attach(rows, longest, ["host", "path"]).select(
        "row", "host", "path", F.col("top.rule").alias("rule"),
        F.coalesce("top.verdict", F.lit(default)).alias("verdict"),
    )


def rules_frame(spark, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Rules given as (verdict, host, path)."""
    return spark.createDataFrame([(h, p, v) for v, h, p in rules], RULE_COLUMNS)
