"""Benchmark decontamination by an FM-index per shard of the training texts."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from creditmart.llm.fm_index import FmIndex
from creditmart.llm.rows import (
    ALNUM, Words, extend, list_array, merged, packed, pieces, runs,
)
from creditmart.session import scratch_path

WINDOW = 10
# Windows, as hashes, with their items that are searched for in one pass; more make further passes.
BLOCK_BYTES = 64 << 20
# Windows in one batch on their way to Spark.
WINDOW_ROWS = 1 << 16
# Training text under one index.
SHARD_BYTES = 8 << 20
FOUND = "n_words bigint, spans array<struct<start: int, end: int>>, items array<string>"


@dataclass(frozen=True)
class Phrases:
    """Distinct windows as rows of symbols; those of row i have the items ``owners[bounds[i]:bounds[i + 1]]``."""

    vocabulary: np.ndarray
    windows: np.ndarray
    names: list[str]
    owners: np.ndarray
    bounds: np.ndarray
    shortest: int

    def items(self, window: int) -> list[str]:
        return [self.names[owner] for owner in self.owners[self.bounds[window] : self.bounds[window + 1]]]


def windows_of(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct pairs of a window of consecutive words, as their hashes, and an item that holds it.

    An item of fewer words, but not none, is one window. ``items`` has ``item`` and ``text``.
    """

    def run(batches):
        for batch in batches:
            for low, high in pieces(batch.column(1)):
                words = Words(batch.column(1).slice(low, high - low), ALNUM, lower=True)
                counts = words.counts
                each = np.where(counts > 0, np.maximum(1, counts - window + 1), 0)
                text = np.repeat(np.arange(len(counts)), each)
                start = words.bounds[text] + np.arange(len(text)) - np.repeat(np.cumsum(each) - each, each)
                for begin in range(0, len(text), WINDOW_ROWS):
                    some = slice(begin, begin + WINDOW_ROWS)
                    size = np.minimum(counts[text[some]], window)
                    ends = np.cumsum(size)
                    index = np.repeat(start[some] - (ends - size), size) + np.arange(ends[-1])
                    binary = pa.BinaryArray.from_buffers(pa.binary(), len(size), [
                        None, pa.py_buffer(np.r_[0, ends * 8].astype(np.int32)), pa.py_buffer(words.hashes[index])
                    ])
                    owner = batch.column(0).take(pa.array(low + text[some]))
                    yield pa.RecordBatch.from_arrays([binary, owner], ["window", "item"])

    return items.mapInArrow(run, "window binary, item string").distinct()


def phrases_of(pairs: pa.Table, window: int = WINDOW) -> Phrases:
    """A block of windows and their items, ready to be searched for."""
    found = pa.chunked_array(pairs["window"], pa.binary()).combine_chunks().dictionary_encode()
    names = pa.chunked_array(pairs["item"], pa.string()).combine_chunks().dictionary_encode()
    codes = found.indices.to_numpy()
    owners = names.indices.to_numpy()[np.argsort(codes, kind="stable")]
    hashes = np.frombuffer(b"".join(found.dictionary.to_pylist()), np.uint64)
    size = pc.binary_length(found.dictionary).to_numpy().astype(np.int64) // 8
    vocabulary, symbols = np.unique(hashes, return_inverse=True)
    rows = np.full((len(size), window), -1, np.int32)
    rows[np.arange(window) >= window - size[:, None]] = symbols + 1
    bounds = np.r_[0, np.cumsum(np.bincount(codes, minlength=len(size)))]
    return Phrases(vocabulary, rows, names.dictionary.to_pylist(), owners, bounds, int(size.min(initial=window)))


def occurrences(words: list[Words], phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """Word positions (over all ``words``) and windows of every occurrence in one shard.

    A word outside the benchmark's vocabulary cannot lie in an occurrence: such
    words, and the ends of texts, become separators, and runs shorter than the
    shortest window are left out of the index.
    """
    empty = np.empty(0, np.int64)
    sequence, places, base = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)], 0
    for part in words:
        at = np.searchsorted(phrases.vocabulary, part.hashes)
        at[at == len(phrases.vocabulary)] = 0
        known = phrases.vocabulary[at] == part.hashes
        starts, ends = runs(known, part.bounds)
        long = ends - starts >= phrases.shortest
        starts, ends = starts[long], ends[long]
        if len(starts):
            # Each run is followed by one separator.
            sizes = ends - starts + 1
            inner = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            index = np.minimum(np.repeat(starts, sizes) + inner, len(known) - 1)
            sequence.append(np.where(inner < np.repeat(sizes - 1, sizes), at[index] + 1, 0))
            places.append(base + index)
        base += len(part.starts)
    if len(sequence) == 1:
        return empty, empty
    symbols, place = np.concatenate(sequence), np.concatenate(places)
    index = FmIndex(symbols, len(phrases.vocabulary))
    low, high = index.ranges(phrases.windows)
    found = np.repeat(np.arange(len(low)), high - low)
    inner = np.arange(len(found)) - np.repeat(np.cumsum(high - low) - (high - low), high - low)
    return place[index.locate(low[found] + inner)], found


def _search(phrases: Phrases):
    """From texts to their words, merged spans of hit words, and items."""
    lengths = (phrases.windows > 0).sum(axis=1)

    def apply(texts: pa.StringArray) -> list[pa.Array]:
        words = [Words(texts.slice(a, b - a), ALNUM, lower=True) for a, b in pieces(texts)]
        counts = np.concatenate([part.counts for part in words])
        bounds = np.r_[0, np.cumsum(counts)]
        at, window = occurrences(words, phrases) if len(phrases.windows) else (np.empty(0, np.int64),) * 2
        marks = merged(at, at + lengths[window], int(bounds[-1]))
        starts, ends = runs(marks, bounds)
        text = np.searchsorted(bounds, starts, "right") - 1
        spans = pa.StructArray.from_arrays(
            [pa.array((x - bounds[text]).astype(np.int32)) for x in (starts, ends)], ["start", "end"]
        )
        of: dict[int, set[str]] = {}
        pairs = np.unique(np.stack([np.searchsorted(bounds, at, "right") - 1, window]), axis=1)
        for row, found in pairs.T.tolist():
            of.setdefault(row, set()).update(phrases.items(found))
        return [
            pa.array(counts.astype(np.int64)),
            list_array(spans, np.bincount(text, minlength=len(counts))),
            pa.array([sorted(of.get(i, ())) for i in range(len(counts))], pa.list_(pa.string())),
        ]

    return apply


def find_benchmark(
    documents: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """Where benchmark windows occur: ``row``, ``n_words``, ``spans``, ``items``.

    ``spans`` are the merged ranges of hit words, ``items`` the distinct item
    ids as sorted strings. The texts are not shuffled: every task indexes shards of its own
    texts and searches for the phrases it was sent. The distinct windows are
    found by a Spark job and stored; beyond ``BLOCK_BYTES`` of them they go in
    several blocks, one pass each. A pair of a window and an item goes to a block by its hash, so
    that blocks are even although many items share a window or one item is very long.

    Null and empty texts have no words; null items are ignored; items with equal
    texts are all reported; an empty benchmark finds nothing; repeated rows are
    judged each.
    """
    spark = documents.sparkSession
    items = benchmark.select(F.col(item).cast("string").alias("item"), F.col(item_text).alias("text")).where(
        "item is not null and text is not null"
    )
    path = scratch_path(spark, "benchmark_windows")
    windows_of(items, window).write.parquet(path)
    stored = spark.read.parquet(path)
    total = stored.agg(F.sum(F.octet_length("window") + F.octet_length("item"))).first()[0] or 0
    blocks = max(1, math.ceil(total / BLOCK_BYTES))
    result = None
    for block in range(blocks):
        chosen = stored.where(F.pmod(F.xxhash64("window", "item"), F.lit(blocks)) == block)
        sent = spark.sparkContext.broadcast(phrases_of(chosen.toArrow(), window))
        if result is None:
            result = _searched(packed(documents), text, sent)
        else:
            before = result.select(F.struct("row", "spans", "items", F.col(f"row.{text}").alias("text")).alias("row"))
            result = _searched(before, "text", sent).select(
                "row.row", "n_words",
                merged_spans(F.concat("row.spans", "spans")).alias("spans"),
                F.array_sort(F.array_union("row.items", "items")).alias("items"),
            )
    return result


def _searched(rows: DataFrame, text: str, sent) -> DataFrame:
    return extend(rows, text, lambda: _search(sent.value), FOUND, limit=SHARD_BYTES)


def judged(found: DataFrame) -> DataFrame:
    """``row`` with ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``, ``contaminated``."""
    inside = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "row", "n_words", inside.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (inside > 0).alias("contaminated"),
    )


def merged_spans(spans: Column) -> Column:
    """The runs of the words in any of some non-empty spans, in order."""
    hit = F.array_distinct(F.flatten(F.transform(spans, lambda s: F.sequence(s["start"], s["end"] - 1))))
    after = F.transform(hit, lambda word: word + 1)
    ranges = F.arrays_zip(F.array_sort(F.array_except(hit, after)), F.array_sort(F.array_except(after, hit)))
    return ranges.cast("array<struct<start: int, end: int>>")


def without_benchmark(documents: DataFrame, benchmark: DataFrame, text: str = "text", **names) -> DataFrame:
    """The documents with every hit word cut out of the text; clean texts stay as they are.

    Cut is what lies from the first to the last byte of each run of hit words.
    ``n_chars``, where present, follows the text.
    """
    found = find_benchmark(documents, benchmark, text, **names)
    rows = found.select(F.struct("row", "spans", F.col(f"row.{text}").alias("text")).alias("row"))

    def run(batches):
        for batch in batches:
            whole = batch.column(0)
            texts, spans = whole.field(2), whole.field(1)
            for low, high in pieces(texts):
                part = texts.slice(low, high - low)
                cut = _cut(part, spans.slice(low, high - low))
                yield pa.RecordBatch.from_arrays([whole.field(0).slice(low, high - low), cut], ["row", "text"])

    schema = StructType([found.schema["row"], StructField("text", StringType())])
    cut = rows.mapInArrow(run, schema)
    columns = []
    for name in documents.columns:
        if name == text:
            column = F.col("text")
        elif name == "n_chars":
            column = F.when(F.col("text") == F.col("row")[text], F.col("row.n_chars")).otherwise(
                F.char_length("text").cast(documents.schema["n_chars"].dataType))
        else:
            column = F.col("row")[name]
        columns.append(column.alias(name))
    return cut.select(*columns)


def _cut(texts: pa.StringArray, spans: pa.ListArray) -> pa.Array:
    counts = spans.value_lengths().to_numpy(zero_copy_only=False)
    if not counts.any():
        return texts
    words, result = Words(texts, ALNUM, lower=True, hashed=False), texts.to_pylist()
    for row in np.flatnonzero(counts):
        raw, base, first = result[row].encode(), words.offsets[row], words.bounds[row]
        kept, last = [], 0
        for span in spans[int(row)].as_py():
            kept.append(raw[last : words.starts[first + span["start"]] - base])
            last = max(last, int(words.ends[first + span["end"] - 1] - base))
        result[row] = b"".join([*kept, raw[last:]]).decode()
    return pa.array(result, pa.string())
