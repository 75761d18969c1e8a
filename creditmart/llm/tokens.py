"""Token counts by two tiers: a broadcast table of frequent pre-tokens, then a cache per worker.

A pre-token is a run of spaces with the run of other characters after it; a
line feed ends it too. No piece of the vocabulary reaches across either place
(``check_vocabulary``), so a text has as many tokens as its pre-tokens together,
and one for each line feed.
"""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmart.llm.rows import extend, packed
from creditmart.session import ensure_checkpoint_dir

# Entries of the broadcast table, and the longest pre-token in it: 65,536 x 48
# characters bound its size, whatever the corpus.
FREQUENT = 1 << 16
LONGEST = 48
# What one task reports to the table, and counts at most before it drops the rare half.
REPORTED = 1 << 13
COUNTED = 1 << 18
# Misses a worker remembers before it starts anew.
CACHED = 1 << 18

_SPACE = "▁"
_UNITS = re.compile(r" *[^ \n]+| +")
_PROCESSORS: dict[str, sentencepiece.SentencePieceProcessor] = {}


def processor(path: str) -> sentencepiece.SentencePieceProcessor:
    """The tokenizer, loaded once per Python worker."""
    if path not in _PROCESSORS:
        _PROCESSORS[path] = sentencepiece.SentencePieceProcessor(model_file=path)
    return _PROCESSORS[path]


def check_vocabulary(path: str) -> None:
    """Raise unless every text can be cut before a run of spaces and around a line feed."""
    tokenizer = processor(path)
    pieces = [tokenizer.id_to_piece(i) for i in range(tokenizer.get_piece_size())]
    if any("\n" in p or _SPACE in p.lstrip(_SPACE) for p in pieces):
        raise ValueError(f"{path}: a piece reaches across a space or a line feed")
    if tokenizer.encode("a  b \nc", out_type=str) != [_SPACE + "a", _SPACE, _SPACE + "b", _SPACE, "<0x0A>", "c"]:
        raise ValueError(f"{path}: spaces are not kept as they are, or a line feed is no token")


def units(text: str) -> list[str]:
    """Pre-tokens; the tokenizer puts one space before a text that is not empty."""
    return _UNITS.findall(" " + text.replace(_SPACE, " ")) if text else []


def unit_length(tokenizer: sentencepiece.SentencePieceProcessor, unit: str) -> int:
    """Tokens of one pre-token, as inside a text."""
    if unit[0] == " ":
        return len(tokenizer.encode(unit[1:], num_threads=1)) if len(unit) > 1 else 1
    # After a line feed no space comes before it: the tokens of space and line feed go.
    return len(tokenizer.encode("\n" + unit, num_threads=1)) - 2


class Lengths(dict):
    """Pre-token lengths: the frequent ones always, others as they come."""

    def __init__(self, frequent: dict[str, int], path: str):
        super().__init__(frequent)
        self.frequent, self.tokenizer, self.encoded = frequent, processor(path), 0

    def __missing__(self, unit: str) -> int:
        length = unit_length(self.tokenizer, unit)
        self.encoded += 1
        if len(unit) <= LONGEST:
            if len(self) >= len(self.frequent) + CACHED:
                self.clear()
                self.update(self.frequent)
            self[unit] = length
        return length

    def count(self, text: str) -> int:
        return sum(map(self.__getitem__, units(text))) + text.count("\n")


def frequent_units(documents: DataFrame, text: str = "text") -> list[str]:
    """The most frequent pre-tokens over all texts, from bounded reports of the tasks.

    Each task counts its own texts and drops the rarer half of its counts when
    they grow too many. Only ``REPORTED`` units a task leave it; pre-tokens are
    never shuffled. The table only saves time: lengths are exact without it.
    """

    def report(batches):
        counts: Counter[str] = Counter()
        for batch in batches:
            for value in batch.column(0):
                if value.is_valid:
                    counts.update(units(value.as_py()))
                if len(counts) > 2 * COUNTED:
                    counts = Counter(dict(counts.most_common(COUNTED)))
        top = [x for x in counts.most_common(REPORTED) if len(x[0]) <= LONGEST and x[1] > 1]
        if top:
            yield pa.RecordBatch.from_arrays([pa.array([u for u, _ in top]), pa.array([n for _, n in top])], ["unit", "n"])

    ensure_checkpoint_dir(documents.sparkSession)
    reported = documents.select(F.col(text)).mapInArrow(report, "unit string, n bigint")
    counted = reported.groupBy("unit").agg(F.sum("n").alias("n")).checkpoint()
    # The lowest power of two that no more than FREQUENT counts reach.
    size = F.floor(F.log2("n")).cast("int").alias("size")
    sizes = dict(counted.groupBy(size).count().collect())
    least, total = max(sizes, default=0) + 1, 0
    while least > 0 and total + sizes.get(least - 1, 0) <= FREQUENT:
        least -= 1
        total += sizes.get(least, 0)
    return [row.unit for row in counted.where(F.col("n") >= 2**least).select("unit").collect()]


def count_tokens(
    documents: DataFrame, path: str, text: str = "text", limit: int = 4096
) -> DataFrame:
    """``row`` with ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens).

    Counts are those of the tokenizer itself, without begin or end tokens. A
    null or empty text has none; a very long text is counted whole, pre-token by
    pre-token; repeated rows are counted each.
    """
    check_vocabulary(path)
    tokenizer = processor(path)
    table = {unit: unit_length(tokenizer, unit) for unit in frequent_units(documents, text)}
    sent = documents.sparkSession.sparkContext.broadcast(table)

    def make():
        lengths = Lengths(sent.value, path)

        def apply(texts: pa.StringArray) -> list[pa.Array]:
            values = [x or "" for x in texts.to_pylist()]
            return [
                pa.array([len(x.encode()) for x in values], pa.int64()),
                pa.array([lengths.count(x) for x in values], pa.int64()),
            ]

        return apply

    counted = extend(packed(documents), text, make, "n_bytes bigint, n_tokens bigint")
    return counted.select("*", (F.col("n_tokens") > limit).alias("over_limit"))
