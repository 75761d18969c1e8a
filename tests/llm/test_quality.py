import random

import numpy as np
import pyarrow as pa
from brute import base_quality, mirrored

from creditmart.llm import quality
from creditmart.llm.queries import LLM_QUERIES
from creditmart.llm.rows import NOT_SPACE, Words

SF = "sf0.1"


def test_base_counts_and_held_out_verdicts(spark, tables):
    rows = LLM_QUERIES["op9_quality_rules"](spark, f"/root/testdata/{SF}").collect()
    documents = tables("documents", SF).select("doc_id", "text")
    want = base_quality(tuple(r) for r in documents.collect())
    assert {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows} == want
    assert not any(r.kept and r.base_failed for r in rows)

    # Verdicts on labelled rows the classifier has not seen.
    labels = tables("labels", SF)
    train, test = labels.where("doc_id % 4 <> 0"), labels.where("doc_id % 4 = 0")
    found = quality.judge(documents, quality.train(documents, train)).select("row.doc_id", "kept", "score", "base_failed")
    judged = found.where("not base_failed").join(test, "doc_id").collect()
    good, bad = [r for r in judged if r.quality == 1], [r for r in judged if r.quality == 0]
    assert sum(r.kept for r in good) >= 0.99 * len(good)
    assert sum(not r.kept for r in bad) >= 0.9 * len(bad)


def test_dirt(spark, dirty):
    texts = [None, "", " \n ", "a", "a b c " * 400, "x\ny\nx\n\n\nx \n" + "é#| " * 20, "word " * 3] + [
        " ".join(f"{a}{i}" for i in range(80)) for a in ("good", "fine", "%%", "##")
    ] * 3
    rows = dirty(texts)
    labels = spark.createDataFrame([(7, 1), (8, 1), (9, 0), (10, 0), (11, 1), (14, 0), (14, 0), (None, 1), (1, None), (99, 7)], "doc_id bigint, quality int")
    for given in (labels, labels.limit(0)):
        found = quality.judge(rows, quality.train(rows, given)).select("row.doc_id", "*").collect()
        got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in found}
        assert got == base_quality(enumerate(texts))
    assert all(r.score is None and r.kept == (not r.base_failed) for r in found)
    empty = dirty([])
    assert quality.judge(empty, quality.train(empty, labels)).count() == 0


def test_neighbours_do_not_count():
    random.seed(2)
    texts = ["", "a", "ab", None, "abc"] + ["".join(random.choices("abcé  \n", k=random.randint(1, 60))) for _ in range(200)] + ["x", ""]
    weights = np.random.default_rng(1).normal(size=2 * quality.BUCKETS).astype(np.float32)
    model = quality.Model(weights, 0.1, 1.0, 0.0)
    together = quality.raw_scores(Words(pa.array(texts), NOT_SPACE), model)
    alone = [quality.raw_scores(Words(pa.array([t], pa.string()), NOT_SPACE), model)[0] for t in texts]
    assert together.tolist() == alone
    at, share = (x.to_pylist() for x in quality._features()(pa.array(texts)))
    for i, text in enumerate(texts):
        assert [x.to_pylist()[0] for x in quality._features()(pa.array([text], pa.string()))] == [at[i], share[i]]


def test_words_in_mirrored_order(spark, dirty):
    """Long lines and words of two letters that hashes of powers cannot tell apart."""
    texts = []
    for letters in (1024, 2048, 4096):
        word, other = mirrored(letters)
        texts += [f"{word}\n{other}\n{word}", f"x y {word} x y {other}", f"{word} {other} " * 3]
    rows = dirty(texts)
    labels = spark.createDataFrame([(1, 1)], "doc_id bigint, quality int").limit(0)
    found = quality.judge(rows, quality.train(rows, labels)).select("row.doc_id", "*").collect()
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in found}
    assert got == base_quality(enumerate(texts))
