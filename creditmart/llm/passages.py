"""Substring deduplication: recurring passages, compiled into automata and found in all texts.

0. Texts of equal words are one: the one with the least key stands for all, and every
   other of them is a single passage that recurs as a whole.
1. Every text is reduced to anchors: of the phrases in each window the one with
   the least hash. Equal windows have equal anchors, about one for twenty words.
2. Anchors in two or more documents recur. A text is cut into pieces, one per
   recurring anchor: the windows that have it, and no others.
3. Pieces meet by anchor. The windows that recur are confirmed word by word and joined
   into passages that always recur as a whole; a shard of them is compiled into one
   automaton, and the pieces of all documents stream through it.
4. What was found goes back to the documents as spans of words.

Anchors in very many documents, or of very many pieces in few, would meet in one task.
Their pieces are combined before the shuffle, equal ones into one, and confirmed window
by window (``_hot_ranges``).
"""

from __future__ import annotations

import hashlib

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmart.functions.joins import attach
from creditmart.llm.rows import NOT_SPACE, Words, inside_texts, pieces, window_hashes
from creditmart.session import ensure_checkpoint_dir, scratch_path

WINDOW = 50
PHRASE = 10
# What may meet in one task of an anchor: documents, pieces, and words of different pieces.
HOT = 1000
HOT_PIECES = 100_000
HOT_WORDS = 200_000
# Words of pieces under one automaton; one anchor's may come on top.
SHARD_WORDS = 200_000
# Pieces that leave a task at once.
PIECES_AT_ONCE = 10_000

_SUMMARY = "key bigint, digest bigint, n_words bigint, kept_sha256 string, anchors array<bigint>"
_RANGES = "array<struct<start: int, end: int>>"


def _anchor_positions(words: Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of all windows, and position and hash of the anchor of each."""
    phrase = min(PHRASE, window)
    fits = np.flatnonzero(inside_texts(words.bounds, window))
    hashes = window_hashes(words.hashes, phrase)
    if not len(fits):
        return fits, fits, hashes[:0]
    # The low bits make the leftmost of equal phrases the least.
    low = np.uint64(len(hashes).bit_length())
    least = (hashes >> low << low) | np.arange(len(hashes), dtype=np.uint64)
    span, reach = window - phrase + 1, 1
    while 2 * reach <= span:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if reach < span:
        least = np.minimum(least[: -(span - reach)], least[span - reach :])
    at = (least[fits] & ((np.uint64(1) << low) - np.uint64(1))).astype(np.int64)
    return fits, at, hashes[at]


def _piece_bounds(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last window of each run of windows with one anchor position."""
    new = np.r_[True, at[1:] != at[:-1]] if len(at) else np.empty(0, bool)
    first = np.flatnonzero(new)
    return first, np.r_[first[1:], len(at)][: len(first)] - 1


def _joined_words(words: Words, row: int) -> bytes:
    first, last = words.bounds[row], words.bounds[row + 1]
    return words.data[words.offsets[row] : words.offsets[row + 1]].tobytes() if first < last else b""


def _summaries(window: int):
    """Per text: its words, the digest of all of them, and its distinct anchors."""

    def run(batches):
        for batch in batches:
            for low, high in pieces(batch.column(2)):
                texts = batch.column(2).slice(low, high - low)
                words = Words(texts, NOT_SPACE)
                starts, at, anchors = _anchor_positions(words, window)
                first, _ = _piece_bounds(at)
                anchors, text = anchors[first], words.texts()[starts[first]]
                bounds = np.searchsorted(text, np.arange(len(texts) + 1))
                digests, lists = [], []
                for row in range(len(texts)):
                    joined = b" ".join(_joined_words(words, row).split())
                    digests.append(hashlib.sha256(joined).hexdigest())
                    lists.append(np.unique(anchors[bounds[row] : bounds[row + 1]]).view(np.int64))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(low, high - low), batch.column(1).slice(low, high - low),
                    pa.array(words.counts.astype(np.int64)), pa.array(digests, pa.string()),
                    pa.array(lists, pa.list_(pa.int64())),
                ], ["key", "digest", "n_words", "kept_sha256", "anchors"])

    return run


def _cut(window: int):
    """From (key, digest, text, recurring anchors, hot ones of them) to pieces."""

    def run(batches):
        for batch in batches:
            for low, high in pieces(batch.column(2)):
                part = batch.slice(low, high - low)
                words = Words(part.column(2), NOT_SPACE)
                starts, at, anchors = _anchor_positions(words, window)
                if not len(starts):
                    continue
                text = words.texts()[starts]
                first, last = _piece_bounds(at)
                bounds = np.searchsorted(text[first], np.arange(high - low + 1))
                recur, hot = np.zeros(len(first), bool), np.zeros(len(first), bool)
                for row in range(high - low):
                    own = slice(bounds[row], bounds[row + 1])
                    for marks, column in ((recur, 3), (hot, 4)):
                        wanted = part.column(column)[row].values.to_numpy().view(np.uint64)
                        marks[own] = np.isin(anchors[first[own]], wanted)
                first, last, hot = first[recur], last[recur], hot[recur]
                begin, end = starts[first], starts[last] + window
                raw = words.data.tobytes()
                for some in range(0, len(first), PIECES_AT_ONCE):
                    some = slice(some, some + PIECES_AT_ONCE)
                    row = text[first[some]]
                    texts = [
                        b" ".join(raw[a:b].split()).decode()
                        for a, b in zip(words.starts[begin[some]], words.ends[end[some] - 1], strict=True)
                    ]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(anchors[first[some]].view(np.int64)), pa.array(texts, pa.string()),
                        *(part.column(i).take(pa.array(row)) for i in range(2)),
                        pa.array((begin[some] - words.bounds[row]).astype(np.int32)), pa.array(hot[some]),
                    ], ["anchor", "piece", "key", "digest", "start", "hot"])

    return run


class Shard:
    """Pieces of some anchors with the passages that recur in them."""

    def __init__(self, window: int):
        self.window, self.symbols = window, {}
        #: Piece: its least and greatest key, its text as one character per word, its names.
        self.pieces: dict[str, tuple[list, str, tuple]] = {}
        self.words = 0

    def add(self, piece: str, key: int, anchor: int, hashed: int) -> None:
        known = self.pieces.get(piece)
        if known is None:
            words = piece.split(" ")
            signs = [self.symbols.setdefault(w, len(self.symbols)) for w in words]
            # The code points of surrogates are left out.
            text = "".join([chr(s + 1 if s < 0xD7FF else s + 0x801) for s in signs])
            self.pieces[piece] = ([key, key], text, (anchor, hashed))
            self.words += len(words)
        else:
            known[0][0], known[0][1] = min(known[0][0], key), max(known[0][1], key)

    def passages(self) -> dict[str, int]:
        """Recurring passages and the least key each window of them occurs under.

        A window recurs if its pieces have two keys. Windows are joined while
        each is always followed by the next, and that always comes after it:
        wherever one of them occurs, the whole passage does.
        """
        size, seen = self.window, {}
        for (least, greatest), text, _ in self.pieces.values():
            after = None
            for i in range(len(text) - size, -1, -1):
                window = text[i : i + size]
                before = text[i - 1] if i else None
                found = seen.get(window)
                if found is None:
                    seen[window] = [least, greatest, before, after]
                else:
                    if least < found[0]:
                        found[0] = least
                    if greatest > found[1]:
                        found[1] = greatest
                    if found[2] != before:
                        found[2] = False
                    if found[3] != after:
                        found[3] = False
                after = text[i + size - 1]
        result, taken = {}, set()
        for window, (least, greatest, before, _) in seen.items():
            if least >= greatest or window in taken:
                continue
            # Back to the first window of the passage.
            head = window
            while before:
                previous = before + head[:-1]
                if seen[previous][3] is False or seen[previous][:2] != seen[head][:2]:
                    break
                head = previous
                if head == window:
                    break
                before = seen[head][2]
            passage, current = head, head
            taken.add(current)
            while seen[current][3]:
                following = current[1:] + seen[current][3]
                if following in taken or seen[following][2] is False or seen[following][:2] != seen[current][:2]:
                    break
                passage += seen[current][3]
                current = following
                taken.add(current)
            result[passage] = least
        return result

    def found(self):
        """Of every piece (anchor, hash, least key, ranges): windows that also occur under a lesser key."""
        automaton = ahocorasick.Automaton()
        for passage, least in self.passages().items():
            automaton.add_word(passage, (least, len(passage)))
        if len(automaton):
            automaton.make_automaton()
        for (own, _), text, names in self.pieces.values():
            places = automaton.iter(text) if len(automaton) else ()
            yield *names, own, [(last + 1 - n, last + 1) for last, (least, n) in places if least < own]


_KIND = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _located(window: int):
    """From pieces sorted by anchor to their ranges: as many automata as the pieces need."""

    def done(shard: Shard):
        found = list(shard.found())
        return pa.RecordBatch.from_arrays([
            *(pa.array([f[i] for f in found], pa.int64()) for i in range(3)),
            pa.array([[{"start": a, "end": b} for a, b in f[3]] for f in found], _KIND),
        ], ["anchor", "hash", "least", "ranges"])

    def run(batches):
        shard, last = Shard(window), None
        for batch in batches:
            for piece, key, anchor, hashed in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if anchor != last and shard.words >= SHARD_WORDS:
                    yield done(shard)
                    shard = Shard(window)
                last = anchor
                shard.add(piece, key, anchor, hashed)
        yield done(shard)

    return run


def _windows_of(window: int):
    """From distinct pieces of hot anchors to their windows: anchor, hash, offset, window hash, keys."""

    def run(batches):
        for batch in batches:
            for low, high in pieces(batch.column(4)):
                part = batch.slice(low, high - low)
                words = Words(part.column(4), NOT_SPACE)
                starts = np.flatnonzero(inside_texts(words.bounds, window))
                row = words.texts()[starts]
                hashes = window_hashes(words.hashes, window)[starts]
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays([
                    *(part.column(i).take(take) for i in range(4)),
                    pa.array((starts - words.bounds[row]).astype(np.int32)), pa.array(hashes.view(np.int64)),
                ], ["anchor", "hash", "least", "greatest", "start", "window"])

    return run


def _hot_ranges(hot: DataFrame, window: int) -> DataFrame:
    """As :func:`_located`, for pieces of anchors that are too many for one task.

    Equal pieces become one before the shuffle. Each of their windows goes its own way: its
    least key is combined before the shuffle and joined back, both by 128 bits of
    hashes.
    """
    distinct = hot.groupBy("anchor", "hash", "piece").agg(
        F.min("key").alias("least"), F.max("key").alias("greatest")
    ).select("anchor", "hash", "least", "greatest", "piece")
    rows = distinct.mapInArrow(
        _windows_of(window), "anchor bigint, hash bigint, least bigint, greatest bigint, start int, window bigint"
    )
    first = rows.groupBy("anchor", "window").agg(F.min("least").alias("first"))
    span = F.struct(F.col("start"), (F.col("start") + window).cast("int").alias("end"))
    # A piece has few windows, all of one anchor.
    return attach(rows, first, ["anchor", "window"]).groupBy("anchor", "hash", "least").agg(
        F.collect_list(F.when(F.col("first") < F.col("least"), span)).cast(_RANGES).alias("ranges")
    )


def _divided(cut: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pieces of anchors that are too many for one task, and all others.

    Documents were counted before; a few long ones may hold any number of pieces of
    one anchor. Their anchors are stored, so that the planner sees how few they are.
    """
    hot, cool = cut.where("hot"), cut.where("not hot")
    equal = cool.groupBy("anchor", "hash").agg(F.count("*").alias("n"), F.first("size").alias("size"))
    large = (
        equal.groupBy("anchor").agg(F.sum("n").alias("pieces"), F.sum("size").alias("words"))
        .where((F.col("pieces") > HOT_PIECES) | (F.col("words") > HOT_WORDS)).select("anchor")
    )
    path = scratch_path(cut.sparkSession, "large")
    large.write.parquet(path)
    large = cut.sparkSession.read.parquet(path)
    if large.isEmpty():
        return hot, cool
    return hot.unionByName(cool.join(large, "anchor", "left_semi")), cool.join(large, "anchor", "left_anti")


def _spans(cut: DataFrame, ranges: DataFrame) -> DataFrame:
    """Spans of words per place of a piece. A document after a piece's first one loses all of it."""
    places = cut.select("anchor", "hash", "key", "digest", "start", "size")
    whole = F.array(F.struct(F.lit(0).alias("start"), F.col("size").alias("end")))
    spans = F.transform(
        F.when(F.col("key") > F.col("least"), whole.cast(_RANGES)).otherwise(F.col("ranges")),
        lambda r: F.struct((r["start"] + F.col("start")).alias("start"), (r["end"] + F.col("start")).alias("end")),
    )
    return attach(places, ranges, ["anchor", "hash"]).select("key", "digest", spans.cast(_RANGES).alias("spans"))


def repeated_spans(documents: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """Summaries of all texts, and the repeated texts with the words to remove.

    Summaries have ``key``, ``digest`` (of the text), ``n_words``, ``kept_sha256`` of
    all words, and ``copy``: whether all words are those of a text with a lesser
    key, so that all are to be removed. Of the other texts, the repeated ones have ``key``,
    ``digest``, ``text`` and ``spans`` of words, not merged.

    A word is to be removed if a window of ``window`` words around it also
    starts in a text with a lesser integer key. Texts with a null key are left
    alone and touch no others. Null, empty and short texts have no window.
    Repeated rows share a key, so they are no repeats of each other.
    """
    spark = documents.sparkSession
    ensure_checkpoint_dir(spark)
    rows = documents.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))
    rows = rows.select("key", F.xxhash64("text").alias("digest"), "text")
    summaries = rows.mapInArrow(_summaries(window), _SUMMARY).checkpoint()
    # A text without an anchor is shorter than a window: no copy of it is removed.
    long = summaries.where("key is not null and size(anchors) > 0")
    first = long.groupBy("kept_sha256").agg(F.min("key").alias("first"))
    copy = (F.col("key") > F.col("first")) & (F.size("anchors") > 0)
    summaries = attach(summaries, first, ["kept_sha256"]).withColumn("copy", F.coalesce(copy, F.lit(False)))
    summaries = summaries.drop("first").checkpoint()
    anchors = summaries.where("key is not null and not copy").select(
        "key", F.explode("anchors").alias("anchor")
    )
    recurring = (
        anchors.groupBy("anchor")
        .agg(F.min("key").alias("least"), F.max("key").alias("greatest"), F.count("*").alias("n"))
        .where("least < greatest").select("anchor", (F.col("n") > HOT).alias("hot"))
    )
    wanted = (
        attach(anchors, recurring, ["anchor"]).where("hot is not null").groupBy("key")
        .agg(F.collect_set("anchor").alias("wanted"), F.collect_set(F.when(F.col("hot"), F.col("anchor"))).alias("hot"))
    )
    path = scratch_path(spark, "repeated")
    rows.join(wanted, "key").select("key", "digest", "text", "wanted", "hot").write.parquet(path)
    repeated = spark.read.parquet(path)

    cut = repeated.mapInArrow(
        _cut(window), "anchor bigint, piece string, key bigint, digest bigint, start int, hot boolean"
    )
    # Cut once; read for the automata, for the hot anchors, and for the places.
    path = scratch_path(spark, "pieces")
    size = (F.regexp_count("piece", F.lit(" ")) + 1).cast("int")
    cut.withColumns({"hash": F.xxhash64("piece"), "size": size}).write.parquet(path)
    cut = spark.read.parquet(path)
    hot, cool = _divided(cut)
    met = cool.select("piece", "key", "anchor", "hash").repartition("anchor")
    ranges = met.sortWithinPartitions("anchor").mapInArrow(
        _located(window), f"anchor bigint, hash bigint, least bigint, ranges {_RANGES}"
    )
    if not hot.isEmpty():
        ranges = ranges.unionByName(_hot_ranges(hot, window))
    found = _spans(cut, ranges).where("size(spans) > 0")
    per_text = found.groupBy("key", "digest").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    return summaries.drop("anchors"), repeated.drop("wanted", "hot").join(per_text, ["key", "digest"])


def _without(batches):
    """From (key, digest, text, spans) to the number of removed words and the kept words."""
    for batch in batches:
        removed, kept = [], []
        for text, spans in zip(batch.column(2).to_pylist(), batch.column(3), strict=True):
            words = text.encode().split()
            cut = np.zeros(len(words) + 1, np.int64)
            inner = spans.values
            np.add.at(cut, inner.field("start").to_numpy(), 1)
            np.add.at(cut, inner.field("end").to_numpy(), -1)
            gone = np.cumsum(cut[:-1]) > 0
            removed.append(int(gone.sum()))
            kept.append(b" ".join([w for w, g in zip(words, gone, strict=True) if not g]).decode())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
            ["key", "digest", "n_removed", "kept"],
        )


def without_repeats(repeated: DataFrame) -> DataFrame:
    """``key``, ``digest``, ``n_removed`` and ``kept`` words, joined by spaces, of the repeated texts."""
    return repeated.mapInArrow(_without, "key bigint, digest bigint, n_removed bigint, kept string")


def deduplicated(documents: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Per row: ``key``, ``n_words``, ``n_removed``, ``kept_sha256`` of the kept words."""
    summaries, repeated = repeated_spans(documents, key, text, window)
    changed = without_repeats(repeated).select(
        "key", "digest", "n_removed", F.sha2("kept", 256).alias("changed")
    ).dropDuplicates(["key", "digest"])
    same = [summaries[c] == changed[c] for c in ("key", "digest")]
    removed = F.when(F.col("copy"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0)))
    kept = F.when(F.col("copy"), F.sha2(F.lit(""), 256)).otherwise(F.coalesce("changed", "kept_sha256"))
    return summaries.join(changed, same, "left").select(
        summaries["key"], "n_words", removed.cast("bigint").alias("n_removed"), kept.alias("kept_sha256")
    )
