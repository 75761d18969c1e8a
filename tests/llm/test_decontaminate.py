import random

import numpy as np
from brute import contamination, mirrored

from creditmart.llm import decontaminate
from creditmart.llm.fm_index import FmIndex
from creditmart.llm.queries import LLM_QUERIES


def results(frame):
    return {r[0]: tuple(r[1:]) for r in frame.collect()}


def test_query_equals_brute_force(spark, tables):
    for sf in ("sf0.001", "sf0.01"):
        got = results(LLM_QUERIES["op10_benchmark_decontamination"](spark, f"/root/testdata/{sf}"))
        rows = [tuple(r) for r in tables("documents", sf).select("doc_id", "text").collect()]
        want = contamination(rows, [tuple(r) for r in tables("benchmark", sf).collect()])
        assert got == want
        assert any(r[4] for r in got.values()) and not all(r[4] for r in got.values())


def test_small_words_dirt_and_blocks(spark, dirty, monkeypatch):
    random.seed(3)
    texts = [None, "", " ", "a"] + [
        "".join(random.choice(["a", "b", "é", "C9"]) + random.choice([" ", "-", "\n"]) for _ in range(random.randint(1, 60)))
        for _ in range(150)
    ]
    texts += [texts[-1]] * 3 + ["a b " * 5000]
    items = [(None, "a b"), (1, None), (2, "a"), (3, "..."), (4, " ".join("abab")), (5, "a b é c9 a a b b é a a b"), (6, texts[20]), (7, texts[20])]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    want = contamination(list(enumerate(texts)), [i for i in items if None not in i])
    # The second in several blocks, windows of equal texts among them, and in small batches.
    for limit, rows in ((decontaminate.BLOCK_BYTES, decontaminate.WINDOW_ROWS), (2000, 7)):
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", limit)
        monkeypatch.setattr(decontaminate, "WINDOW_ROWS", rows)
        found = decontaminate.judged(decontaminate.find_benchmark(dirty(texts), benchmark))
        assert results(found.select("row.doc_id", *found.columns[1:])) == want
    assert decontaminate.find_benchmark(dirty([]), benchmark).count() == 0
    nothing = decontaminate.judged(decontaminate.find_benchmark(dirty(texts), benchmark.limit(0)))
    assert nothing.where("contaminated").count() == 0 and nothing.count() == len(texts)


def test_cut_texts(spark, dirty):
    benchmark = spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], "item_id int, text string")
    texts = ["Keep this. One two, three four five\nsix seven eight nine TEN! And this é.", None, "clean", "one two"]
    rows = decontaminate.without_benchmark(dirty(texts), benchmark).orderBy("doc_id").collect()
    assert [r.text for r in rows] == ["Keep this. ! And this é.", None, "clean", "one two"]
    assert [r.n_chars for r in rows] == [24, None, 5, 7]
    assert rows[0].row == "x" and rows[0].spans == 1


def test_cut_texts_in_blocks(spark, dirty, monkeypatch):
    random.seed(5)
    signs = "abcdefghijkl"
    items = [(i, " ".join(random.choices(signs, k=random.randint(2, 4)))) for i in range(12)]
    benchmark = spark.createDataFrame(items, "item_id int, text string")
    texts = [" ".join(random.choices(signs, k=random.randint(1, 80))) for _ in range(120)]

    def cut(text):
        words, hit = text.split(" "), set()
        for _, phrase in items:
            size = len(phrase.split(" "))
            for at in range(len(words) - size + 1):
                if " ".join(words[at : at + size]) == phrase:
                    hit.update(range(at, at + size))
        # A run goes from its first to its last byte: the spaces around it stay.
        return " ".join("" if i in hit else w for i, w in enumerate(words) if not (i in hit and i - 1 in hit))

    want = [cut(text) for text in texts]
    assert sum(a != b for a, b in zip(texts, want, strict=True)) > 50
    for limit in (decontaminate.BLOCK_BYTES, 30):
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", limit)
        rows = decontaminate.without_benchmark(dirty(texts), benchmark).orderBy("doc_id").collect()
        assert [r.text for r in rows] == want


def test_index_counts_and_places():
    random.seed(1)
    symbols = np.array([0] + [random.choice([0, 1, 2, 3]) for _ in range(3000)] + [1, 2] * 200 + [0])
    index = FmIndex(symbols, 3)
    for phrase in ([1], [1, 2], [2, 3, 1], [1, 2] * 4, [3, 3, 3, 3]):
        low, high = index.ranges(np.array([[-1] * (8 - len(phrase)) + phrase]))
        want = [i for i in range(len(symbols)) if symbols[i : i + len(phrase)].tolist() == phrase]
        assert sorted(index.locate(np.arange(low[0], high[0])).tolist()) == want


def test_words_in_mirrored_order(spark, dirty):
    """Long words of two letters that hashes of powers cannot tell apart."""
    items, texts = [], []
    for letters in (1024, 2048, 4096):
        word, other = mirrored(letters)
        items += [(letters, word), (letters + 1, f"one {word} two three")]
        texts += [f"a {word} b", f"a {other} b", f"one {other} two three", f"zero one {word} two three four"]
    benchmark = spark.createDataFrame(items, "item_id int, text string")
    found = decontaminate.judged(decontaminate.find_benchmark(dirty(texts), benchmark))
    assert results(found.select("row.doc_id", *found.columns[1:])) == contamination(list(enumerate(texts)), items)
