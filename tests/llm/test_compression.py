import zlib

import numpy as np

from creditmart.llm import compression
from creditmart.llm.queries import LLM_QUERIES

SF = "sf0.1"


def test_held_out_rows(spark, tables):
    rows = LLM_QUERIES["op13_quality_score"](spark, f"/root/testdata/{SF}").collect()
    assert len(rows) == tables("documents", SF).count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    quality = {r.doc_id: r.quality for r in tables("labels", SF).collect()}
    held = [(r.score, quality[r.doc_id]) for r in rows if r.held_out and r.doc_id in quality]
    good, bad = (np.array([s for s, q in held if q == kind]) for kind in (1, 0))
    assert len(bad) > 100
    assert (good[:, None] > bad[None, :]).mean() > 0.96
    assert (good >= 0.7).mean() > 0.97 and (bad < 0.7).mean() > 0.8
    # Scores are probabilities: their mean is the share of good rows.
    assert abs(np.mean([s for s, _ in held]) - np.mean([q for _, q in held])) < 0.03


def test_dirt(spark, dirty):
    texts = [None, "", " ", "é" * 3000, "a"] + [f"plain words of text number {i} " * 40 for i in range(60)]
    texts += [f"$$ {i} ## !! " * 60 for i in range(60)] + ["plain words " * 40_000, "x", "x"]
    rows = dirty(texts)
    labels = spark.createDataFrame(
        [(i, int(i < 65)) for i in range(5, 125)] + [(124, 1), (None, 1), (0, None), (1, 7), (999, 0)], "doc_id bigint, quality int"
    )
    found = {r.doc_id: r for r in compression.judge(rows, compression.train(rows, labels)).select("row.doc_id", "score", "predicted").collect()}
    assert found[0].score == found[1].score
    assert found[126].score == found[127].score
    assert found[125].predicted == 1 and found[10].predicted == 1 and found[100].predicted == 0

    one_kind = compression.judge(rows, compression.train(rows, labels.where("quality = 1"))).collect()
    assert all(r.predicted == 1 for r in one_kind)
    nothing = compression.judge(rows, compression.train(rows, labels.limit(0))).collect()
    assert all(r.score == 0.5 for r in nothing)
    no_texts = compression.train(dirty([]), labels)
    assert compression.judge(dirty([]), no_texts).count() == 0


def test_too_few_stretches_for_a_trained_dictionary():
    kept = compression.dictionary([b"abc"])
    assert b"abc" in kept
    compression.Differences(kept, b"")("abc")


def test_long_texts_score_like_their_parts():
    good, bad = ([f"{sign} {i} {sign * 3} ".encode() * 20 for i in range(200)] for sign in ("word", "$%"))
    difference = compression.Differences(compression.dictionary(good), compression.dictionary(bad))
    part = "word 3 wordwordword " * 200
    assert abs(difference(part) - difference(part * 200)) < 0.02
