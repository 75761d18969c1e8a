"""One query per operator, over whole tables, and the SQL of those SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditmart.llm import (
    alignment,
    compression,
    decontaminate,
    divergence,
    languages,
    licenses,
    mixing,
    passages,
    quality,
    secrets,
    simhash,
    sql,
    tokens,
    url_rules,
)
from creditmart.session import ensure_checkpoint_dir

URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
#: Shares of the tokens; values that are not named divide what is left.
MIX_TARGETS = {
    "source": {"src0": 0.1},
    # Other languages, and texts without one, share a twentieth.
    "lang": {"en": 0.38, "de": 0.19, "fr": 0.19, "es": 0.19},
    "topic": {"article": 0.5, "long": 0.3, "brief": 0.1, "tabular": 0.1},
}
MIX_BUDGET = 0.5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose words lie in benchmark windows of ten words."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.judged(
        decontaminate.find_benchmark(documents, table(spark, sf_dir, "benchmark"))
    )
    return found.select("row.doc_id", *found.columns[1:])


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses named in each document, and where."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = licenses.summary(licenses.find_licenses(documents))
    return found.select("row.doc_id", *found.columns[1:])


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document that repeat fifty words of an earlier one."""
    found = passages.deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.withColumnRenamed("key", "doc_id")


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of each document, and the first document of its group."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    ensure_checkpoint_dir(spark)
    prints = simhash.fingerprints(documents).select("row.doc_id", "fingerprint").checkpoint()
    found = simhash.grouped(prints, F.col("doc_id"))
    return found.select("doc_id", simhash.hex_digits("fingerprint").alias("fingerprint"), "component_id")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule that decides each page's url."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    found = url_rules.filter_urls(pages, url_rules.rules_frame(spark, URL_RULES))
    return found.select("row.page_id", "host", "path", "rule", "verdict")


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, digest and spans of the secrets in each document."""
    found = secrets.digest(secrets.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text")))
    return found.select("row.doc_id", *found.columns[1:])


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main language of each document, learned from four fifths of them."""
    documents = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    model = languages.learn(documents, ~held_out & F.col("doc_id").isNotNull())
    rows = documents.select("doc_id", "text", held_out.alias("held_out"))
    found = languages.identify(rows, model)
    return found.select("row.doc_id", "row.held_out", "lang_pred", "score", "mixture")


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each document is drawn into a mix of half the tokens."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    found = mixing.mix(documents, MIX_TARGETS, MIX_BUDGET)
    return found.select("row.doc_id", *found.columns[1:])


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each document, and whether they are more than 4096."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = tokens.count_tokens(documents, public_tokenizers.path("piece_bpe_32k.model"))
    return found.select("row.doc_id", *found.columns[1:])


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts of every document, and whether it is kept."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(documents, table(spark, sf_dir, "labels"))
    found = quality.judge(documents, model)
    return found.select("row.doc_id", *found.columns[1:])


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the tokens of two tokenizers share the bytes of each document."""
    paths = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = alignment.alignment(documents, *paths, keep=["doc_id"])
    return found.select("row.doc_id", *found.columns[1:])


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the sources of each language are from each other, and the terms that stand out."""
    return divergence.audit(table(spark, sf_dir, "documents").select("text", "lang", "source"))


def op13_quality_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of each document by how it compresses, learned from three quarters of the labels."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    known = table(spark, sf_dir, "labels").where(~held_out & F.col("doc_id").isNotNull())
    model = compression.train(documents, known)
    found = compression.judge(documents.withColumn("held_out", held_out), model, keep=["doc_id", "held_out"])
    return found.select("row.doc_id", "row.held_out", "score", "predicted")


LLM_QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op4_url_filter": op4_url_filter,
    "op5_secret_scan": op5_secret_scan,
    "op6_language_id": op6_language_id,
    "op7_source_mix": op7_source_mix,
    "op8_token_counts": op8_token_counts,
    "op9_quality_rules": op9_quality_rules,
    "op10_benchmark_decontamination": op10_benchmark_decontamination,
    "op11_token_alignment": op11_token_alignment,
    "op12_source_divergence": op12_source_divergence,
    "op13_quality_score": op13_quality_score,
}


def _url_sql() -> str:
    rules = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in URL_RULES)
    return f"""
WITH rules(verdict, host, path) AS (VALUES {rules}),
rest AS (
    SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), hosts AS (
    SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS host FROM rest
), parts AS (
    SELECT page_id,
        translate(host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(substr(rest, length(host) + 1), '^[^?#]*') AS path
    FROM hosts
), fits AS (
    SELECT p.page_id, arg_max(struct_pack(rule := r.host || r.path, verdict := r.verdict), length(r.host || r.path)) AS top
    FROM parts p JOIN rules r
        ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
    GROUP BY p.page_id
)
SELECT p.page_id, p.host, p.path, f.top.rule AS rule, coalesce(f.top.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN fits f USING (page_id)"""


def _mix_sql() -> str:
    steps = []
    for name, target in MIX_TARGETS.items():
        named = " ".join(f"WHEN '{value}' THEN {share}::DOUBLE" for value, share in target.items())
        rest = max(0.0, 1.0 - sum(target.values()))
        steps.append(f"""
totals_{name} AS (
    SELECT {name}, sum(weight) AS tokens, CASE {name} {named} END AS named FROM cells GROUP BY {name}
), shares_{name} AS (
    SELECT {name}, coalesce(named, {rest!r}::DOUBLE * tokens / sum(CASE WHEN named IS NULL THEN tokens END) OVER ())
        / (coalesce(sum(named) OVER (), 0)
            + CASE WHEN count(*) FILTER (WHERE named IS NULL) OVER () > 0 THEN {rest!r}::DOUBLE ELSE 0 END) AS share
    FROM totals_{name}
)""")
    names = list(MIX_TARGETS)
    inner = f"(SELECT * FROM raked WHERE off > {mixing.TOLERANCE} AND off < {mixing.STALLED} * before)"
    for name in names:
        inner = f"""(
    SELECT * REPLACE (mixed * share_{name} / total AS mixed, greatest(far, max(abs(total / whole - share_{name})) OVER ()) AS far)
    FROM (SELECT * EXCLUDE (total, whole), sum(mixed) OVER (PARTITION BY {name}) AS total, sum(mixed) OVER () AS whole FROM {inner})
)"""
    joins = " ".join(f"JOIN (SELECT {name}, share AS share_{name} FROM shares_{name}) USING ({name})" for name in names)
    shares = ", ".join(f"share_{name}" for name in names)
    fields = f"source, lang, topic, weight, {shares}, mixed"
    steps.append(f"""
raked AS (
    SELECT source, lang, topic, weight, {shares}, weight AS mixed,
        0 AS round, 2.0::DOUBLE AS off, 4.0::DOUBLE AS before, 0.0::DOUBLE AS far, 0.0::DOUBLE AS total, 0.0::DOUBLE AS whole
    FROM cells {joins}
    UNION ALL
    SELECT {fields}, round + 1, far, off, 0.0, 0.0, 0.0 FROM {inner}
), last AS (
    SELECT * FROM raked WHERE round = (SELECT max(round) FROM raked)
)""")
    return f"""
WITH RECURSIVE counted AS (
    SELECT doc_id, coalesce(source, '?') AS source, coalesce(lang, '?') AS lang, text,
        coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS n_tokens
    FROM documents
), rows AS (
    SELECT doc_id, source, lang, n_tokens,
        CASE WHEN contains(coalesce(text, ''), ' | ') THEN 'tabular' WHEN n_tokens < 100 THEN 'brief'
            WHEN n_tokens < 1000 THEN 'article' ELSE 'long' END AS topic,
        ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '\\N')), 1, 13))::BIGINT / {float(16**13)!r}::DOUBLE AS draw
    FROM counted
), cells AS MATERIALIZED (
    SELECT source, lang, topic, sum(n_tokens)::DOUBLE AS weight FROM rows GROUP BY ALL HAVING sum(n_tokens) > 0
), {",".join(steps)},
per_cell AS (
    SELECT source, lang, topic, round({MIX_BUDGET} * (SELECT sum(weight) FROM cells) * mixed / weight, {mixing.DIGITS}) AS expected,
        round(off, {mixing.OFF_DIGITS}) AS off_target
    FROM last
), joined AS (
    SELECT r.*, CASE WHEN n_tokens > 0 THEN coalesce(c.expected, 0) ELSE 0 END AS expected, off_target
    FROM rows r LEFT JOIN per_cell c USING (source, lang, topic)
)
SELECT doc_id, n_tokens, source, lang, topic, expected,
    (floor(expected) + CASE WHEN draw < expected - floor(expected) THEN 1 ELSE 0 END)::BIGINT AS copies,
    off_target
FROM joined"""


LLM_ORACLES: dict[str, str] = {
    "op2_substring_dedup": sql.repeats(passages.WINDOW),
    "op4_url_filter": _url_sql(),
    "op7_source_mix": _mix_sql(),
    "op10_benchmark_decontamination": sql.leaks(decontaminate.WINDOW),
    "op12_source_divergence": sql.divergences(divergence.LEAST_DOCUMENTS, divergence.TOP_TERMS),
}
