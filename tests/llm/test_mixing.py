import duckdb
import pytest
from pyspark.sql import functions as F

from creditmart.llm import mixing, queries

TARGETS = queries.MIX_TARGETS


def shares(rows, name):
    total = sum(r.tokens for r in rows)
    return {v: sum(r.tokens for r in rows if r[name] == v) / total for v in {r[name] for r in rows}}


def test_query_equals_sql_and_hits_the_targets(spark):
    sf = "/root/testdata/sf0.1"
    found = queries.LLM_QUERIES["op7_source_mix"](spark, sf)
    got = sorted(tuple(r) for r in found.collect())
    duck = duckdb.connect()
    duck.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    assert got == sorted(duck.execute(queries.LLM_ORACLES["op7_source_mix"]).fetchall())
    # What is expected has the target shares; what is drawn is near.
    for weight, near in (("expected", 1e-5), ("copies", 0.03)):
        rows = found.groupBy("source", "lang", "topic").agg(F.sum(F.col("n_tokens") * F.col(weight)).alias("tokens")).collect()
        # No other language has tokens here, so the four make up the whole.
        assert shares(rows, "lang") == pytest.approx({"en": 0.4, "de": 0.2, "fr": 0.2, "es": 0.2}, abs=near)
        assert shares(rows, "topic") == pytest.approx(TARGETS["topic"], abs=near)
        assert shares(rows, "source")["src0"] == pytest.approx(0.1, abs=near)
    tokens, mixed = found.agg(F.sum("n_tokens"), F.sum(F.col("n_tokens") * F.col("expected"))).first()
    assert mixed == pytest.approx(0.5 * tokens, rel=1e-6)


def test_dirt_and_both_joins(spark, dirty, monkeypatch):
    texts = [None, "", "a b c", "d " * 150, "x | y", "e " * 1200] * 20
    rows = dirty(texts).withColumn("lang", F.when(F.col("doc_id") % 7 > 0, F.lit("en")))
    first = sorted(mixing.mix(rows, {"lang": {"en": 0.5, "?": 0.5, "none": 0.2}, "topic": {}}, 2.0).select("row.doc_id", "lang", "n_tokens", "expected", "copies").collect())
    assert len(first) == 120 and all(r.copies == 0 for r in first if not r.n_tokens)
    monkeypatch.setattr(mixing, "BROADCAST_CELLS", 0)
    monkeypatch.setattr(mixing, "FEW_VALUES", 1)
    assert first == sorted(mixing.mix(rows, {"lang": {"en": 0.5, "?": 0.5, "none": 0.2}, "topic": {}}, 2.0).select("row.doc_id", "lang", "n_tokens", "expected", "copies").collect())
    total = sum(r.n_tokens for r in first)
    for lang in ("en", "?"):
        assert sum(r.n_tokens * r.expected for r in first if r.lang == lang) == pytest.approx(total, rel=1e-6)
    assert mixing.mix(dirty([]), TARGETS).count() == 0
    assert mixing.mix(dirty([None, ""]), TARGETS).count() == 2


def test_targets_that_cannot_be_met_are_reported(spark, dirty, monkeypatch):
    """Each source has one language, so both marginals cannot hold; four of them can."""
    rows = dirty(["a b c d"] * 400).withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "en").otherwise("de"))
    rows = rows.withColumn("source", F.when(F.col("lang") == "en", "one").otherwise("two"))
    against = {"source": {"one": 0.9, "two": 0.1}, "lang": {"en": 0.5, "de": 0.5}}
    agreed = {"source": {"one": 0.9, "two": 0.1}, "lang": {"en": 0.9, "de": 0.1}}
    for few in (1000, 1):
        monkeypatch.setattr(mixing, "FEW_VALUES", few)
        assert {r.off_target for r in mixing.mix(rows, against).collect()} == {0.4}
        assert {r.off_target for r in mixing.mix(rows, agreed).collect()} == {0.0}


def test_other_languages_and_none_stay(spark, dirty):
    langs = F.element_at(F.array(F.lit("en"), F.lit("de"), F.lit("fr"), F.lit("es"), F.lit("pl"), F.lit(None)), (F.col("doc_id") % 6 + 1).cast("int"))
    rows = dirty(["a b c d"] * 600).withColumn("lang", langs)
    found = mixing.mix(rows, {"lang": TARGETS["lang"]}, 2.0).collect()
    total = sum(r.n_tokens * r.expected for r in found)
    for lang, share in (*TARGETS["lang"].items(), ("pl", 0.025), ("?", 0.025)):
        assert sum(r.n_tokens * r.expected for r in found if r.lang == lang) == pytest.approx(share * total, abs=1e-4 * total)
    assert {r.off_target for r in found} == {0.0}
