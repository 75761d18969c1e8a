from pyspark.sql import functions as F

import corpus_pipeline
from brute import contamination
from creditmart.llm import secrets
from test_simhash import plain_groups, plain_print

SF = "/root/testdata/sf0.01"


def test_every_stage_against_its_input(spark, tables, tmp_path):
    docs = tables("documents", "sf0.01")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{name}")
        kept[name] = (docs, spark.read.parquet(f"{tmp_path}/{name}"))
        docs = kept[name][1]
        assert docs.columns[: len(columns)] == columns and docs.count()

    before, after = kept["quality_rules"]
    good = tables("labels", "sf0.01").where("quality = 1 and toxic = 0").join(before, "doc_id").where("size(split(text, ' ')) > 80")
    assert good.join(after, "doc_id", "left_semi").count() >= 0.98 * good.count()
    assert after.count() < before.count()

    before, after = kept["simhash_near_dedup"]
    prints = {r.doc_id: plain_print(r.text) for r in before.collect()}
    assert {r.doc_id for r in after.collect()} == set(plain_groups(prints).values())

    before, after = kept["benchmark_decontamination"]
    items = [tuple(r) for r in tables("benchmark", "sf0.01").collect()]
    found = contamination([(r.doc_id, r.text) for r in after.collect()], items)
    assert any(v[4] for v in contamination([(r.doc_id, r.text) for r in before.collect()], items).values())
    assert before.count() == after.count() and not any(v[4] for v in found.values())

    before, after = kept["secret_scans"]
    texts = {r.doc_id: r.text for r in before.collect()}
    for r in after.collect():
        assert r.text == secrets.masked(texts[r.doc_id], [s[1:3] for s in secrets.scan(texts[r.doc_id])[1]])
        assert not secrets.scan(r.text)[1] and r.n_chars == len(r.text)

    before, after = kept["source_mix"]
    assert after.where("copies <= 0").count() == 0 and after.join(before, "doc_id", "left_anti").count() == 0


def test_dirty_documents_pass_all_stages(spark, dirty):
    words = " ".join(f"good{i % 61} text{i % 53}" for i in range(200))
    rows = dirty([None, "", words, words, words + " token = abcdef123"]).union(dirty([words]))
    rows = rows.union(dirty([words + " other"]).select(F.lit(None).cast("bigint"), *rows.columns[1:]))
    for docs in (rows, rows.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            result = stage(spark, docs, SF)
            assert set(docs.columns) <= set(result.columns)
            result.collect()
    near = dict(corpus_pipeline.STAGES)["simhash_near_dedup"](spark, rows, SF).collect()
    assert sorted((r.doc_id is None, r.doc_id) for r in near)[0] == (False, 0) and len(near) == 2
    twice = dict(corpus_pipeline.STAGES)["simhash_near_dedup"](spark, dirty([None]).union(dirty([None])), SF)
    assert twice.count() == 1
