"""Near-duplicates by SimHash fingerprints, found through Golay keys of their segments."""

from __future__ import annotations

from itertools import accumulate, permutations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditmart.functions.joins import attach
from creditmart.llm import golay
from creditmart.llm.rows import extend, packed
from creditmart.session import ensure_checkpoint_dir

SHINGLE, SEED = 4, 42
# The most bits the keys below are made for.
MAX_BITS = 4
# (lowest bit, length) of the three segments, each shorter than a Golay word.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
HALF = 11


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """Bits that are set in over half of the hashes of the text's shingles; A-Z in lower case."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= size:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        ends = list(accumulate(len(w) + 1 for w in words))
        starts = [0, *ends[: len(ends) - size]]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a : b - 1], SEED) for a, b in zip(starts, ends[size - 1 :], strict=True)]
    total = np.zeros(64, np.int64)
    raw = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
    for low in range(0, len(raw), 1 << 14):
        total += np.unpackbits(raw[low : low + (1 << 14)], axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * total > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(documents: DataFrame, text: str = "text", size: int = SHINGLE) -> DataFrame:
    """``row`` with its ``fingerprint``, 64 bits as a bigint.

    A null or empty text has fingerprint zero; one of fewer words than a shingle, that of all
    its words.
    """

    def make():
        def apply(texts: pa.StringArray) -> list[pa.Array]:
            found = [fingerprint(x, size) for x in texts.to_pylist()]
            return [pa.array(np.array(found, np.uint64).view(np.int64))]

        return apply

    return extend(packed(documents), text, make, "fingerprint bigint")


def segment_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which fingerprint, key) so that any two within four bits share a key.

    Four errors fall into three segments. If one segment has none, another has
    two at most: its exact bits with a Golay key of the other. If none is without,
    two have exactly one, and the third two at most: one half of each of the
    two is exact, which goes with a Golay key of the third.
    """
    parts = [(prints >> np.uint64(low) & np.uint64((1 << length) - 1)).astype(np.int64) for low, length in SEGMENTS]
    fuzzy = [golay.keys(part) for part in parts]
    halves = [(part & ((1 << HALF) - 1), part >> HALF) for part in parts]
    rows, keys, kind = [], [], 0

    def add(exact: np.ndarray, third: int) -> None:
        nonlocal kind
        which, index = fuzzy[third]
        rows.append(which)
        keys.append(kind << 40 | exact[which] << golay.DATA_BITS | index)
        kind += 1

    for exact, other in permutations(range(3), 2):
        add(parts[exact], other)
    for one, two, third in ((0, 1, 2), (0, 2, 1), (1, 2, 0)):
        for a in halves[one]:
            for b in halves[two]:
                add(a << HALF | b, third)
    return np.concatenate(rows), np.concatenate(keys)


def _spread(batches):
    """Each fingerprint under each of its keys."""
    for batch in batches:
        prints = batch.column(0).to_numpy().view(np.uint64)
        for low in range(0, len(prints), 2000):
            which, keys = segment_keys(prints[low : low + 2000])
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys), pa.array(prints[low : low + 2000][which].view(np.int64))], ["key", "print"]
            )


def _near(one: np.ndarray, other: np.ndarray, bits: int) -> np.ndarray:
    return np.bitwise_count((one ^ other).view(np.uint64)) <= bits


def _spanning(prints: np.ndarray, bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that connect what is connected in one bucket: each component's members to its least.

    Every print is compared with those not yet reached; what one reaches leaves the rest. So
    a large group of near copies takes few comparisons and gives no pairs.
    """
    links, rest = [], np.sort(prints)
    while len(rest) > 1:
        root, rest = rest[0], rest[1:]
        queue, members = [root], []
        while queue and len(rest):
            near = _near(rest, queue.pop(), bits)
            if near.any():
                members.append(rest[near])
                queue.extend(rest[near])
                rest = rest[~near]
        if members:
            reached = np.concatenate(members)
            links.append((np.full(len(reached), root), reached))
    return links


def _link(bits: int):
    """From rows sorted by key to links between prints that were compared; each once per task."""

    def bucket_links(keys: np.ndarray, prints: np.ndarray):
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        sizes = np.diff(np.r_[starts, len(keys)])
        two = starts[sizes == 2]
        a, b = prints[two], prints[two + 1]
        near = _near(a, b, bits)
        yield np.minimum(a, b)[near], np.maximum(a, b)[near]
        for start, size in zip(starts[sizes > 2], sizes[sizes > 2], strict=True):
            yield from _spanning(prints[start : start + size], bits)

    def run(batches):
        keys, prints = np.empty(0, np.int64), np.empty(0, np.int64)
        parent: dict[int, int] = {}

        def find(x: int) -> int:
            while (up := parent.get(x, x)) != x:
                parent[x] = parent.get(up, up)
                x = up
            return x

        def ended(upto: int):
            """Links of the complete buckets that connect something new in this task."""
            found = []
            if upto:
                for a, b in bucket_links(keys[:upto], prints[:upto]):
                    for x, y in zip(a.tolist(), b.tolist(), strict=True):
                        p, q = find(x), find(y)
                        if p != q:
                            parent[max(p, q)] = min(p, q)
                            found.append((x, y))
            if found:
                a, b = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        for batch in batches:
            keys = np.concatenate([keys, batch.column(0).to_numpy()])
            prints = np.concatenate([prints, batch.column(1).to_numpy()])
            upto = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
            yield from ended(upto)
            keys, prints = keys[upto:], prints[upto:]
        yield from ended(len(keys))

    return run


def links(prints: DataFrame, bits: int = MAX_BITS) -> DataFrame:
    """``a`` and ``b``: verified links between distinct fingerprints, enough to connect whatever is.

    ``prints`` has distinct fingerprints in its only column. They are joined by
    key: dealt out and sorted, so that every bucket streams through one task. A bucket holds
    distinct fingerprints that agree in 33 bits, however many documents have them.
    """
    if not 0 <= bits <= MAX_BITS:
        raise ValueError(f"bits must be 0 to {MAX_BITS}")
    # A hundred rows come of each: as many tasks as a shuffle has, not as its input has.
    tasks = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = prints.repartition(tasks, prints.columns[0]).mapInArrow(_spread, "key bigint, print bigint")
    dealt = spread.repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(_link(bits), "a bigint, b bigint").distinct()


def roots(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``: the least node each node is connected with, for nodes with links.

    Rounds of large and small stars: every node hands its larger, then its smaller
    neighbours to the least one, until nothing changes. The rounds grow with
    the logarithm of the largest component. Nodes with many neighbours are
    combined before the shuffle and split after it.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    current = edges.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("to")).where("node <> to").distinct().checkpoint()
    before = None
    while (state := current.agg(F.count("*"), F.sum(F.xxhash64("node", "to").cast("decimal(38,0)"))).first()) != before:
        before = state
        both = current.union(current.select("to", "node"))
        least = F.least("node", F.min("to")).alias("least")
        larger = attach(both, both.groupBy("node").agg(least), ["node"]).where("to > node")
        large = larger.select(F.col("to").alias("node"), F.col("least").alias("to")).distinct()
        smallest = large.groupBy("node").agg(F.min("to").alias("least"))
        small = attach(large, smallest, ["node"]).select(F.explode(F.array(
            F.struct("node", F.col("least").alias("to")),
            F.struct(F.col("to").alias("node"), F.col("least").alias("to")),
        )).alias("edge")).select("edge.*")
        current = small.where("node <> to").distinct().checkpoint()
    return current.groupBy("node").agg(F.min("to").alias("root"))


def grouped(prints: DataFrame, key: Column, bits: int = MAX_BITS) -> DataFrame:
    """Add ``component`` and ``component_id`` to stored rows with a ``fingerprint``.

    Fingerprints link at ``bits`` or fewer differing bits, zero like any other.
    ``component`` is the least linked fingerprint, ``component_id`` the least key
    among the rows of the component, itself included, null if all are null. Equal
    fingerprints are one node, so copies are never compared; repeated rows and
    keys fall into one component. An empty table stays empty.
    """
    ensure_checkpoint_dir(prints.sparkSession)
    nodes = prints.groupBy("fingerprint").agg(F.min(key).alias("least")).checkpoint()
    found = roots(links(nodes.select("fingerprint"), bits))
    placed = nodes.join(found, nodes["fingerprint"] == found["node"], "left").select(
        "fingerprint", "least", F.coalesce("root", "fingerprint").alias("component")
    )
    least = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    per_print = attach(placed, least, ["component"]).select("fingerprint", "component", "component_id")
    return attach(prints, per_print, ["fingerprint"])


def hex_digits(column: str) -> Column:
    return F.lower(F.lpad(F.hex(column), 16, "0"))
