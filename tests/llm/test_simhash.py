import random

import numpy as np
import xxhash
from brute import WORD, ascii_lower
from pyspark.sql import functions as F

from creditmart.llm import golay, simhash
from creditmart.llm.queries import LLM_QUERIES


def plain_print(text, size=4):
    words = WORD.findall(ascii_lower(text))
    if not words:
        return 0
    runs = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_groups(prints, bits=4):
    """{id: least id reachable}, by comparing all pairs."""
    ids = sorted(prints)
    values = np.array([prints[i] for i in ids], np.uint64)
    root = {}
    for i in ids:
        if i in root:
            continue
        root[i], queue = i, [prints[i]]
        while queue:
            near = np.bitwise_count(values ^ np.uint64(queue.pop())) <= bits
            for j in np.flatnonzero(near):
                if ids[j] not in root:
                    root[ids[j]] = i
                    queue.append(prints[ids[j]])
    return root


def test_words_two_bits_apart_share_a_key():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 23, 5000)
    for _ in range(3):
        other = words ^ (1 << rng.integers(0, 23, 5000)) ^ (1 << rng.integers(0, 23, 5000))
        a, b = (dict() for _ in range(2))
        for found, given in ((a, words), (b, other)):
            for which, key in zip(*golay.keys(given), strict=True):
                found.setdefault(int(which), set()).add(int(key))
        assert all(a[i] & b[i] for i in range(5000))
        assert max(map(len, a.values())) == golay.MOST_KEYS


def test_prints_four_bits_apart_share_a_key():
    rng = np.random.default_rng(2)
    one = rng.integers(0, 1 << 63, 20_000, dtype=np.uint64)
    other = one.copy()
    for _ in range(4):
        other ^= np.uint64(1) << rng.integers(0, 64, len(one), dtype=np.uint64)
    sets = []
    for prints in (one, other):
        which, keys = simhash.segment_keys(prints)
        sets.append(set(zip(which.tolist(), keys.tolist(), strict=True)))
    assert {which for which, _ in sets[0] & sets[1]} == set(range(len(one)))


def test_query_equals_brute_force(spark, tables):
    for sf in ("sf0.001", "sf0.01"):
        rows = LLM_QUERIES["op3_simhash_near_dedup"](spark, f"/root/testdata/{sf}").collect()
        prints = {r.doc_id: plain_print(r.text) for r in tables("documents", sf).collect()}
        assert {r.doc_id: r.fingerprint for r in rows} == {i: f"{p:016x}" for i, p in prints.items()}
        assert {r.doc_id: r.component_id for r in rows} == plain_groups(prints)
        assert len({r.component_id for r in rows}) < len(rows)


def test_chains_groups_and_zero(spark):
    rng = random.Random(4)
    prints, value = {}, rng.getrandbits(64)
    for i in range(400):  # a chain, in no order of ids
        prints[(i * 7919) % 1000 + 5000] = value
        for bit in rng.sample(range(64), rng.choice([3, 4, 4, 5])):
            value ^= 1 << bit
    center = rng.getrandbits(64)
    for i in range(600):  # near copies of one
        prints[i] = center ^ sum(1 << b for b in set(rng.sample(range(64), rng.randint(0, 5))))
    prints |= {9000: 0, 9001: 0, 9002: 7, 9003: 127, 9004: (1 << 64) - 1}
    signed = [(i, p - (1 << 64) if p >> 63 else p) for i, p in prints.items()]
    frame = spark.createDataFrame(signed + signed[:50], "doc_id bigint, fingerprint bigint")
    found = simhash.grouped(frame, F.col("doc_id")).collect()
    assert len(found) == len(prints) + 50
    assert {r.doc_id: r.component_id for r in found} == plain_groups(prints)
    assert simhash.grouped(frame.limit(0), F.col("doc_id")).count() == 0


def test_dirt(spark, dirty):
    long = "word%d " * 3
    texts = [None, "", " \n", "a", "A", "a b c d", "A B\tC  D", long * 4000, long * 4000 + "x", "É a b c d"]
    rows = dirty(texts).union(dirty([texts[5]]).selectExpr("cast(null as bigint) doc_id", "text", "row", "spans", "items", "lang", "source", "n_chars"))
    prints = simhash.fingerprints(rows)
    assert {r.row.doc_id: r.fingerprint % 2**64 for r in prints.collect() if r.row.doc_id is not None} == {i: plain_print(t) for i, t in enumerate(texts)}
    found = simhash.grouped(prints.select("row.doc_id", "fingerprint"), F.col("doc_id")).collect()
    by = {r.doc_id: r.component_id for r in found}
    assert by[0] == by[1] == by[2] == 0 and by[3] == by[4] == 3 and by[5] == by[6] == by[None] == 5
