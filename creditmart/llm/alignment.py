"""Tokens of two tokenizers side by side: Arrow joins on document ends, partial counts merged by Spark.

Both tokenizers spell the same bytes, so the places where a token of each ends
cut a text into the smallest groups that both agree on. A text is first cut at single spaces
between two letters or signs; neither tokenizer has a token across such a place
(``load`` checks it), so every different stretch of a piece is encoded once.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmart.llm.rows import extend, list_array, offsets_of, packed
from creditmart.llm.tokens import check_vocabulary, processor
from creditmart.session import scratch_path

# Stretches a worker remembers, and their bytes, before it starts anew.
REMEMBERED, REMEMBERED_BYTES = 1 << 18, 1 << 24
# Pairs a task counts before it passes them on.
COUNTED = 1 << 18
# Pairs whose counts are broadcast, the most frequent ones: 16 bytes each, whatever the corpus.
FREQUENT = 1 << 18

# Bytes that may stand on either side of a cut: printable ASCII, and characters
# whose first byte rules out white space beyond ASCII.
_SIGN = np.zeros(256, bool)
_SIGN[0x21:0x7F] = True
_BEGINS = _SIGN.copy()
_BEGINS[[*range(0xC3, 0xE0), *range(0xE4, 0xF5)]] = True
_TWO_BYTES = np.zeros(256, bool)
_TWO_BYTES[0xC3:0xE0] = True


@dataclass(frozen=True)
class Tokenizer:
    """An encoder of stretches, and the bytes of every token."""

    encode: object
    spelled: pa.BinaryArray

    def lists(self, stretches: list[str]) -> pa.ListArray:
        found = self.encode(stretches)
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter((i for ids in found for i in ids), np.int32, int(sizes.sum()))
        return list_array(pa.array(ids), sizes)


class Encoder:
    """Both tokenizers, and the tokens of stretches met before."""

    def __init__(self, *sides: Tokenizer):
        self.sides = sides
        self._forget()

    def _forget(self) -> None:
        self.places: dict[str, int] = {}
        self.bytes = 0
        self.lists = [pa.array([], pa.list_(pa.int32())) for _ in self.sides]

    def places_of(self, stretches: pa.StringArray) -> pa.Array:
        """Where in ``lists`` the tokens of different stretches are; valid until the next call."""
        if len(self.places) > REMEMBERED or self.bytes > REMEMBERED_BYTES:
            self._forget()
        found = stretches.to_pylist()
        new = [x for x in found if x not in self.places]
        if new:
            self.places.update(zip(new, range(len(self.places), len(self.places) + len(new)), strict=True))
            self.bytes += sum(map(len, new))
            self.lists = [
                pa.concat_arrays([old, side.lists(new)]) for old, side in zip(self.lists, self.sides, strict=True)
            ]
        return pa.array([self.places[x] for x in found], pa.int32())


_LOADED: dict[tuple[str, str], Encoder] = {}


def _byte_signs() -> dict[str, int]:
    """The sign of each byte in byte-level entries: printable Latin-1 stands for itself, the rest follows 255."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [byte for byte in range(256) if byte not in printable]
    return {chr(byte): byte for byte in printable} | {chr(256 + i): byte for i, byte in enumerate(others)}


def _byte_level(path: str) -> Tokenizer:
    with open(path, encoding="utf-8") as file:
        cutting = json.load(file)["pre_tokenizer"]
    # The form of tokenizer whose words never reach over a single space.
    if cutting != {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}:
        raise ValueError(f"{path}: not a byte-level tokenizer without a leading space")
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = tokenizers.Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    signs, vocabulary = _byte_signs(), tokenizer.get_vocab()
    spelled = [b""] * (max(vocabulary.values()) + 1)
    for entry, token in vocabulary.items():
        spelled[token] = bytes(signs[sign] for sign in entry)

    def encode(stretches):
        return [e.ids for e in tokenizer.encode_batch_fast(stretches, add_special_tokens=False)]

    return Tokenizer(encode, pa.array(spelled, pa.binary()))


def _pieces(path: str) -> Tokenizer:
    check_vocabulary(path)
    tokenizer: sentencepiece.SentencePieceProcessor = processor(path)

    def spell(token: int) -> bytes:
        piece = tokenizer.id_to_piece(token)
        return bytes([int(piece[3:-1], 16)]) if tokenizer.is_byte(token) else piece.replace("▁", " ").encode()

    spelled = [spell(i) for i in range(tokenizer.get_piece_size())]
    # The tokenizer itself puts the space before a stretch.
    return Tokenizer(lambda x: tokenizer.encode([s[1:] for s in x], num_threads=1), pa.array(spelled, pa.binary()))


def load(a_path: str, b_path: str) -> Encoder:
    """Both tokenizers, once per worker: a byte-level one, and one of pieces that adds the space itself."""
    if (a_path, b_path) not in _LOADED:
        _LOADED[a_path, b_path] = Encoder(_byte_level(a_path), _pieces(b_path))
    return _LOADED[a_path, b_path]


def spaced(texts: pa.StringArray) -> pa.StringArray:
    """A space and the text; nothing for null and empty texts."""
    texts = texts.fill_null("")
    return pc.if_else(pc.equal(pc.binary_length(texts), 0), "", pc.binary_join_element_wise("", texts, " "))


def stretches(texts: pa.StringArray) -> tuple[pa.StringArray, np.ndarray]:
    """Stretches to encode by themselves, and the text each is in."""
    offsets = offsets_of(texts).astype(np.int64)
    buffer = texts.buffers()[2]
    data = np.empty(0, np.uint8) if buffer is None else np.frombuffer(buffer, np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    at = np.flatnonzero(data == 0x20)
    at = at[(at > 1) & (at < len(data) - 1)]
    before = _SIGN[data[at - 1]] | ((data[at - 1] & 0xC0 == 0x80) & _TWO_BYTES[data[at - 2]])
    edge = np.zeros(len(data) + 1, bool)
    edge[at[before & _BEGINS[data[at + 1]]]] = True
    edge[offsets] = True
    edges = np.flatnonzero(edge)
    found = pa.StringArray.from_buffers(
        len(edges) - 1, pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))
    )
    return found, np.searchsorted(offsets, edges[:-1], "right") - 1


def _tokens(tokenizer: Tokenizer, lists: pa.ListArray, inside: pa.Array, texts: pa.StringArray):
    """Ids, texts and ends of all tokens in order, ends counted from the start of each text; and which texts are spelled by them."""
    ids = pc.list_flatten(lists)
    text = inside.take(pc.list_parent_indices(lists))
    sizes = pc.binary_length(tokenizer.spelled).cast(pa.int64()).take(ids)
    ends = pc.cumulative_sum(sizes).to_numpy()
    first = np.searchsorted(text.to_numpy(), np.arange(len(texts) + 1))
    begins = np.concatenate([[0], ends])[first]
    ends = ends - begins[text.to_numpy()]

    bytes_ = tokenizer.spelled.take(ids).buffers()[2] if len(ids) else None
    spelled = memoryview(b"" if bytes_ is None else bytes_)
    whole = memoryview(texts.buffers()[2] or b"")
    places = offsets_of(texts)
    same = [
        spelled[begins[i] : begins[i + 1]] == whole[places[i] : places[i + 1]] for i in range(len(texts))
    ]
    return ids, text, pa.array(ends), np.array(same, bool)


def _numbered(key: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """The number of each token's group: how many shared ends lie before the token's own."""
    ends = np.zeros(len(key), np.int64)
    ends[np.searchsorted(key, shared)] = 1
    return np.cumsum(ends) - ends


def _per_text(values: np.ndarray, count: int) -> np.ndarray:
    return np.bincount(values, minlength=count).astype(np.int64)


def _joined_text(ids: pa.Array, group: np.ndarray, groups: int) -> pa.Array:
    return pc.binary_join(list_array(ids.cast(pa.string()), _per_text(group, groups)), ",")


def align_texts(texts: pa.StringArray, encoder: Encoder) -> list[pa.Array]:
    """Per text: tokens of both, groups, links, the groups as text, and each linked pair with how often."""
    count = len(texts)
    texts = spaced(texts)
    found, inside = stretches(texts)
    coded = found.dictionary_encode()
    which, inside = encoder.places_of(coded.dictionary).take(coded.indices), pa.array(inside)
    sides = [
        _tokens(side, lists.take(which), inside, texts)
        for side, lists in zip(encoder.sides, encoder.lists, strict=True)
    ]
    good = pa.array(sides[0][3] & sides[1][3])

    def table(ids, text, ends) -> pa.Table:
        key = pc.add(pc.shift_left(text, pa.scalar(32, pa.int64())), ends)
        return pa.table({"key": key, "id": ids, "text": text}).filter(good.take(text)).combine_chunks()

    left, right = (table(*side[:3]) for side in sides)
    n_a, n_b = (_per_text(t["text"].to_numpy(), count) for t in (left, right))
    shared = left.select(["key"]).join(right.select(["key"]), "key", join_type="inner", use_threads=False)["key"]
    shared = np.sort(shared.to_numpy())
    text_of = shared >> 32
    n_groups = _per_text(text_of, count)

    numbered, written = [], []
    for side in (left, right):
        ids = side["id"].combine_chunks()
        group = _numbered(side["key"].to_numpy(), shared)
        written.append(_joined_text(ids, group, len(shared)))
        counted = pa.table({"group": group, "id": ids.cast(pa.int64())})
        numbered.append(counted.group_by(["group", "id"], use_threads=False).aggregate([([], "count_all")]))
    groups = pc.binary_join(list_array(pc.binary_join_element_wise(*written, "|"), n_groups), ";")

    links = numbered[0].join(
        numbered[1], "group", join_type="inner", left_suffix="_a", right_suffix="_b", use_threads=False
    )
    pairs = pa.table({
        "text": pa.array(text_of).take(links["group"]),
        "pair": pc.bit_wise_or(pc.shift_left(links["id_a"], pa.scalar(32, pa.int64())), links["id_b"]),
        "times": pc.multiply(links["count_all_a"], links["count_all_b"]),
    })
    pairs = pairs.group_by(["text", "pair"], use_threads=False).aggregate([("times", "sum")])
    pairs = pairs.sort_by([("text", "ascending"), ("pair", "ascending")]).combine_chunks()
    of_text = pairs["text"].to_numpy()
    sizes, times = _per_text(of_text, count), pairs["times_sum"].combine_chunks()
    n_links = np.diff(np.concatenate([[0], np.cumsum(times.to_numpy())])[np.concatenate([[0], np.cumsum(sizes)])])
    return [
        pa.array(n_a), pa.array(n_b), pa.array(n_groups), pa.array(n_links.astype(np.int64)), groups,
        list_array(pairs["pair"].combine_chunks(), sizes), list_array(times, sizes),
    ]


def align(
    documents: DataFrame, a_path: str, b_path: str, text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """``row`` with ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``groups``, ``pairs`` and ``times``.

    ``groups`` spells the groups of a text as ``a1,a2|b1;a3|b2,b3``. ``pairs`` holds each
    linked pair of a text once, the id of the first tokenizer in the upper 32
    bits, and ``times`` how many links are of that pair. A text that is null,
    empty, or not spelled byte for byte by either tokenizer has no tokens. Repeated
    rows are aligned each, very long texts whole. ``keep`` names the columns of ``row``.
    """
    load(a_path, b_path)

    def make():
        encoder = load(a_path, b_path)
        return lambda texts: align_texts(texts, encoder)

    fields = (
        "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, "
        "pairs array<bigint>, times array<bigint>"
    )
    return extend(packed(documents), text, make, fields, keep=keep)


def count_links(aligned: DataFrame) -> DataFrame:
    """How many documents hold each linked ``pair``: counted per task, merged by Spark."""

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = None
        for batch in batches:
            pairs = batch.column(0).flatten()
            new = pa.table({"pair": pairs, "docs": pa.array(np.ones(len(pairs), np.int64))})
            counts = _added(new if counts is None else pa.concat_tables([counts, new]))
            if counts.num_rows > COUNTED:
                yield from counts.to_batches()
                counts = None
        if counts is not None:
            yield from counts.to_batches()

    partial = aligned.select("pairs").mapInArrow(report, "pair bigint, docs bigint")
    return partial.groupBy("pair").agg(F.sum("docs").alias("docs"))


def _added(counts: pa.Table) -> pa.Table:
    found = counts.group_by("pair", use_threads=False).aggregate([("docs", "sum")])
    return found.rename_columns(["pair", "docs"]).combine_chunks()


def _frequent(counts: DataFrame) -> DataFrame:
    """The pairs of the highest counts, no more than ``FREQUENT``: all from some power of two on."""
    size = F.floor(F.log2("docs")).cast("int").alias("size")
    sizes = dict(counts.groupBy(size).count().collect())
    least, total = max(sizes, default=0) + 1, 0
    while least > 0 and total + sizes.get(least - 1, 0) <= FREQUENT:
        least -= 1
        total += sizes.get(least, 0)
    return counts.where(F.col("docs") >= 2**least)


def weigh(aligned: DataFrame, counts: DataFrame, key: str) -> DataFrame:
    """Per ``key`` of ``aligned``: ``n_best`` and ``count_sum`` over the links of a document.

    A link is best if its pair is in as many documents as any pair of the same
    first id. The highest counts per first id (as many as its vocabulary) and
    the most frequent pairs go to every task; only rarer pairs are shuffled, and
    none of these can be hot. ``counts`` should be stored, ``key`` unique.
    """
    spark = aligned.sparkSession
    highest = counts.groupBy(F.shiftright("pair", 32).cast("int").alias("id")).agg(F.max("docs").alias("docs"))
    rows = highest.collect()
    best = np.zeros(max((r.id for r in rows), default=0) + 1, np.int64)
    for r in rows:
        best[r.id] = r.docs
    top = _frequent(counts).toArrow()
    pairs, docs = top["pair"].to_numpy(), top["docs"].to_numpy()
    order = np.argsort(pairs)
    sent = spark.sparkContext.broadcast((best, pairs[order], docs[order]))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, known, docs = sent.value
        known, docs = np.append(known, np.int64(-1)), np.append(docs, np.int64(0))
        for batch in batches:
            lists, times = batch.column(1), batch.column(2).flatten().to_numpy()
            pair, of_row = lists.flatten(), lists.value_parent_indices().to_numpy()
            value = pair.to_numpy()
            at = np.searchsorted(known[:-1], value)
            hit = known[at] == value
            count = np.where(hit, docs[at], 0)
            is_best = hit & (count == best[value >> 32])
            n = batch.num_rows
            sums = [np.zeros(n, np.int64), np.zeros(n, np.int64)]
            np.add.at(sums[0], of_row[is_best], times[is_best])
            np.add.at(sums[1], of_row, times * count)
            left = ~hit
            sizes = _per_text(of_row[left], n)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, sums), list_array(pa.array(value[left]), sizes), list_array(pa.array(times[left]), sizes)],
                ["key", "n_best", "count_sum", "pairs", "times"],
            )

    kind = aligned.schema[key].dataType.simpleString()
    looked = aligned.select(F.col(key).alias("key"), "pairs", "times").mapInArrow(
        look_up, f"key {kind}, n_best bigint, count_sum bigint, pairs array<bigint>, times array<bigint>"
    )
    path = scratch_path(spark, "looked-up")
    looked.write.parquet(path)
    looked = spark.read.parquet(path)
    rare = looked.select("key", F.explode(F.arrays_zip("pairs", "times")).alias("link")).select(
        "key", "link.pairs", "link.times"
    )
    highest_known = spark.createDataFrame([(int(i), int(n)) for i, n in enumerate(best)], "id int, most bigint")
    weighed = (
        rare.join(counts.withColumnRenamed("pair", "pairs"), "pairs")
        .join(F.broadcast(highest_known), F.shiftright("pairs", 32) == F.col("id"))
        .select("key", F.when(F.col("docs") == F.col("most"), F.col("times")).otherwise(0).alias("n_best"),
                (F.col("docs") * F.col("times")).alias("count_sum"))
    )
    parts = looked.select("key", "n_best", "count_sum").union(weighed)
    return parts.groupBy("key").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def alignment(documents: DataFrame, a_path: str, b_path: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``row`` with ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum`` and ``groups_sha256``.

    The aligned documents are stored once, without the spelled groups, of which a digest stays; it is
    empty without tokens. Rows are joined back by their place, so repeated rows
    stay apart. Empty tables give no rows.
    """
    spark = documents.sparkSession
    path = scratch_path(spark, "aligned")
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256")
    aligned = align(documents, a_path, b_path, text, keep)
    aligned.select(
        F.monotonically_increasing_id().alias("place"), "row", "n_a", "n_b", "n_groups", "n_links", digest, "pairs", "times"
    ).write.parquet(path)
    stored = spark.read.parquet(path)
    counts_path = scratch_path(spark, "link-counts")
    count_links(stored).write.parquet(counts_path)
    sums = weigh(stored, spark.read.parquet(counts_path), "place")
    return stored.join(sums.withColumnRenamed("key", "place"), "place").select(
        "row", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )
