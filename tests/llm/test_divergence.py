import random

import numpy as np
import pytest
from brute import divergences

from creditmart.llm import divergence
from creditmart.llm.queries import LLM_QUERIES

COLUMNS = ["lang", "source", "part", "item", "value", "rank"]


def rows(frame):
    found = [tuple(r) for r in frame.select(COLUMNS).collect()]
    assert len(found) == len(set(found))
    return set(found)


def made(spark, records):
    schema = "text string, lang string, source string, term string, n int, first string"
    return spark.createDataFrame([(*r, "x", 1, "y") for r in records], schema)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_brute_force(spark, tables, sf):
    documents = [tuple(r) for r in tables("documents", sf).select("text", "lang", "source").collect()]
    assert rows(LLM_QUERIES["op12_source_divergence"](spark, f"/root/testdata/{sf}")) == divergences(documents)


@pytest.mark.parametrize("blocks", [(64, 4096), (2, 3), (1, 1)])
def test_blocks_and_dirt(spark, monkeypatch, blocks):
    monkeypatch.setattr(divergence, "SOURCE_BLOCK", blocks[0])
    monkeypatch.setattr(divergence, "TERM_BLOCK", blocks[1])
    monkeypatch.setattr(divergence, "COUNTED", 20)
    random.seed(3)
    words = ["the", "The", "é", "É", "x1y", "ab_cd", " ", "日本", "…", "a\nb", "z" * 5000]
    records = [(None, None, None), ("", "en", "alone"), (None, "de", "s1"), ("only", "xx", "a"), ("few", "xx", "b")]
    for i in range(240):
        lang, source = random.choice(["en", "de", None]), random.choice(["s1", "s2", "S2", "é", "", None, "hot", "hot", "hot"])
        records.append((" ".join(random.choices(words, k=random.randint(0, 12))), lang, source))
    records += records[-30:]
    assert rows(divergence.audit(made(spark, records))) == divergences(records)


def test_empty_table(spark):
    assert divergence.audit(made(spark, [])).count() == 0


def test_shares_are_exact():
    random.seed(1)
    totals = np.array([random.randrange(1, 2 ** random.randint(1, 52)) for _ in range(500)])
    counts = np.array([random.randrange(0, int(t)) for t in totals])
    want = [1 + 10**9 * (int(n) + 2) // int(t) for n, t in zip(counts, totals, strict=True)]
    assert divergence._shares(counts, totals).tolist() == want


def test_wide_shares(spark):
    n, total, terms = 6_000_000_000_000_000, 9_000_000_000_000_000, 10_000_000
    frame = spark.createDataFrame([(n, total, terms)], "n bigint, total bigint, terms bigint")
    assert frame.select(divergence.share("n", "total", "terms")).first()[0] == 1 + 10**9 * (n + 2) // (total + 2 * terms)
