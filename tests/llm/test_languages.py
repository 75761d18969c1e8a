import numpy as np
from pyspark.sql import functions as F

from creditmart.llm import languages
from creditmart.llm.queries import LLM_QUERIES


def test_held_out_accuracy(spark, tables):
    rows = LLM_QUERIES["op6_language_id"](spark, "/root/testdata/sf0.1").join(
        tables("documents", "sf0.1").select("doc_id", "lang", F.regexp_count("text", F.lit("[A-Za-z]+")).alias("n")), "doc_id"
    ).collect()
    assert len(rows) == 10_000
    import zlib
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out and r.n >= 20]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_mixtures_dirt_and_no_model(spark, dirty, tables):
    documents = tables("documents", "sf0.1")
    model = languages.learn(documents, F.lit(True))
    assert model.languages == ["de", "en", "es", "fr"]
    some = {r.lang: r.text for r in documents.where("n_chars between 3000 and 3300").orderBy("doc_id").collect()}
    texts = [None, "", "123 !?", some["de"] + " " + some["fr"], some["es"], some["en"] * 30]
    found = languages.identify(dirty(texts), model).orderBy("row.doc_id").collect()
    assert [r.lang_pred for r in found[:3]] == ["und"] * 3 and [r.score for r in found[:3]] == [0.0] * 3
    assert {m.lang for m in found[3].mixture} == {"de", "fr"} and 0.3 < found[3].score < 0.7
    assert [m.lang for m in found[4].mixture] == ["es"] and found[5].lang_pred == "en"
    nothing = languages.learn(documents, F.lit(False))
    assert {r.lang_pred for r in languages.identify(dirty(texts), nothing).collect()} == {"und"}
    assert languages.identify(dirty([]), model).count() == 0


def test_fit_finds_known_shares():
    rng = np.random.default_rng(0)
    own = rng.random(4000) < 0.3
    words = np.where(own[:, None], [[-1.0, -6.0, -9.0]], [[-7.0, -2.0, -9.0]])
    share = languages._chosen(words, np.array([0, 4000]))
    assert abs(share[0, 0] - own.mean()) < 0.01 and share[0, 2] == 0
