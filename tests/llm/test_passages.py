import random

import pytest
from brute import mirrored, without_repeats

from creditmart.llm import passages
from creditmart.llm.queries import LLM_QUERIES


def results(frame):
    rows = frame.collect()
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: tuple(r[1:]) for r in rows}


def test_query_equals_brute_force(spark, tables):
    for sf in ("sf0.001", "sf0.01"):
        got = results(LLM_QUERIES["op2_substring_dedup"](spark, f"/root/testdata/{sf}"))
        rows = [tuple(r) for r in tables("documents", sf).select("doc_id", "text").collect()]
        assert got == without_repeats(rows)
        assert any(r[1] for r in got.values())


def texts(seed, count, letters):
    """Shared and shifted runs of few words, with repeats inside a text."""
    rng = random.Random(seed)
    pool = [[rng.choice(letters) for _ in range(rng.randint(3, 40))] for _ in range(12)]
    made = []
    for _ in range(count):
        words = []
        for _ in range(rng.randint(0, 6)):
            part = rng.choice(pool) if rng.random() < 0.7 else [rng.choice(letters) + str(rng.random())]
            words += part[rng.randint(0, 5):]
        made.append(rng.choice([" ", "\n", "\t "]).join(words))
    return made


def test_small_windows_and_hot_anchors(spark, dirty, monkeypatch):
    given = texts(1, 150, "abcdefgh") + ["a " * 300, "a " * 40 + "b", "ab " * 77] * 2 + [None, "", "x"]
    given += given[:40] + [given[3] + " z", "é " + given[5]] * 30
    want = {w: without_repeats(enumerate(given), w) for w in (4, 12)}
    for window in (4, 12):
        for hot in (1000, 5):
            monkeypatch.setattr(passages, "HOT", hot)
            monkeypatch.setattr(passages, "SHARD_WORDS", 100 if hot == 5 else 10_000)
            monkeypatch.setattr(passages, "HOT_PIECES" if window == 4 else "HOT_WORDS", 200)
            assert results(passages.deduplicated(dirty(given), window=window)) == want[window]


def test_null_keys_repeated_rows_and_empty_tables(spark, dirty):
    text = " ".join(f"w{i}" for i in range(60))
    rows = dirty([text, text, text + " end"]).union(dirty([text])).union(dirty([text]).selectExpr("cast(null as bigint) doc_id", "text", "row", "spans", "items", "lang", "source", "n_chars"))
    got = sorted(((r.key is None, r.key), r.n_words, r.n_removed) for r in passages.deduplicated(rows).collect() if r.key is not None)
    assert got == [((False, 0), 60, 0)] * 2 + [((False, 1), 60, 60), ((False, 2), 61, 60)]
    assert [r.n_removed for r in passages.deduplicated(rows).collect() if r.key is None] == [0]
    assert passages.deduplicated(dirty([])).count() == 0


def test_texts_of_equal_words(spark, dirty):
    """Equal words in another spacing are copies; short ones stay, and a part of one is found."""
    text = " ".join(f"w{i}" for i in range(80))
    given = ["short one", text.replace(" ", "\n"), "short  one", text, text + " ", " ".join(text.split()[10:75]), None, None]
    assert results(passages.deduplicated(dirty(given))) == without_repeats(enumerate(given))


def test_a_long_text_that_repeats_one_phrase(spark, dirty):
    """Two texts, one above ten megabytes, with one phrase every 95 words: all pieces of one anchor."""
    rng = random.Random(5)
    phrase = " ".join(f"same{i}" for i in range(10))

    def made(parts):
        return " ".join(phrase + " " + " ".join(f"{rng.getrandbits(20):x}" for _ in range(85)) for _ in range(parts))

    long, short = made(20_500), made(200)
    short += " " + " ".join(long.split()[95_000:95_400])
    assert len(long) > 11_000_000
    assert results(passages.deduplicated(dirty([long, short]))) == without_repeats(enumerate([long, short]))


@pytest.mark.parametrize("hot", (0, 1000))
def test_words_in_mirrored_order(spark, dirty, monkeypatch, hot):
    """Long words of two letters in an order that hashes of powers cannot tell apart."""
    monkeypatch.setattr(passages, "HOT", hot)
    for letters in (1024, 2048, 4096):
        word, other = mirrored(letters)
        rest = " ".join(f"w{i}" for i in range(70))
        given = [f"{rest[:200]} {word} {rest}", f"{rest[:200]} {other} {rest}", f"{word} {rest}"]
        assert results(passages.deduplicated(dirty(given))) == without_repeats(enumerate(given))
