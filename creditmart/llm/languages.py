"""Language ID: each document as a mixture of languages, fitted by expectation-maximisation."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditmart.llm.rows import extend, packed, pieces

# Letter triples fall into so many buckets; with MAX_LANGUAGES this bounds the model.
BITS = 16
BUCKETS = 1 << BITS
MAX_LANGUAGES = 64
SMOOTHING = 0.5
STEPS = 12
# A further language must raise the log-likelihood by more than so many times
# log(words): one proportion, and the choice of the language itself.
PENALTY = 3.0
UNKNOWN = "und"


@dataclass(frozen=True)
class Model:
    """Learned languages in order, and log-probabilities of the buckets per language."""

    languages: list[str]
    logs: np.ndarray


@cache
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def _triples(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of letter triples, where each word's triples start, and the words' bounds per text.

    A word is a run of letters in lower case; its triples include a blank before and
    after it.
    """
    values = [(x or "").lower() for x in texts.to_pylist()]
    codes = np.frombuffer(" ".join(["", *values, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[codes]
    ends = np.cumsum([1 + len(v) for v in values])
    starts = np.flatnonzero(letter[1:] & ~letter[:-1]) + 1
    symbols = np.where(letter, codes, 32).astype(np.uint64)
    key = symbols[:-2] | (symbols[1:-1] << np.uint64(21)) | (symbols[2:] << np.uint64(42))
    middle = np.flatnonzero(letter[1:-1])
    buckets = ((key[middle] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)).astype(np.int32)
    bounds = np.r_[0, np.searchsorted(starts, ends)]
    return buckets, np.searchsorted(middle, starts - 1), bounds


def learn(documents: DataFrame, training: Column, text: str = "text", lang: str = "lang") -> Model:
    """Counts of letter triples per language over all training rows.

    Every task adds its rows into one table of fixed size and sends that on, so
    the shuffle is bounded by buckets, languages and tasks, and a language with
    most of the rows is no bottleneck. Null languages and texts are left out.
    More than ``MAX_LANGUAGES`` languages raise an error.
    """
    chosen = documents.select(F.col(lang).alias("lang"), F.col(text).alias("text")).where(
        training & F.col(lang).isNotNull() & F.col(text).isNotNull()
    )

    def count(batches):
        tables: dict[str, np.ndarray] = {}
        for batch in batches:
            names = np.array(batch.column(0).to_pylist(), object)
            for name in sorted(set(names)):
                if name not in tables and len(tables) > MAX_LANGUAGES:
                    continue  # found out and refused below
                own = batch.column(1).filter(pa.array(names == name))
                tables.setdefault(name, np.zeros(BUCKETS, np.int64))
                for low, high in pieces(own):
                    buckets, _, _ = _triples(own.slice(low, high - low))
                    tables[name] += np.bincount(buckets, minlength=BUCKETS)
        for name, counted in tables.items():
            used = np.flatnonzero(counted)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * (len(used) + 1)), pa.array(np.r_[-1, used].astype(np.int32)), pa.array(np.r_[0, counted[used]])],
                ["lang", "bucket", "n"],
            )

    counted = chosen.mapInArrow(count, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    per_lang = counted.groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("cells"))
    rows = per_lang.limit(MAX_LANGUAGES + 1).collect()
    if len(rows) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages in the training rows")
    rows = sorted(rows, key=lambda r: r.lang)
    logs = np.zeros((len(rows), BUCKETS), np.float32)
    for row, line in zip(rows, logs, strict=True):
        counts = np.zeros(BUCKETS)
        for bucket, n in row.cells:
            if bucket >= 0:
                counts[bucket] = n
        line[:] = np.log((counts + SMOOTHING) / (counts.sum() + SMOOTHING * BUCKETS))
    return Model([r.lang for r in rows], logs)


def _fit(words: np.ndarray, bounds: np.ndarray, sets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions and log-likelihood of each text over its set of languages (a mask per text).

    ``words`` has a row of log-likelihoods per word; all texts are stepped together.
    """
    counts = np.diff(bounds)
    text = np.repeat(np.arange(len(counts)), counts)
    top = words.max(axis=1, keepdims=True)
    scaled = np.exp(words - top)
    share = sets / sets.sum(axis=1, keepdims=True)
    for _ in range(STEPS):
        joint = scaled * share[text] + 1e-300
        joint /= joint.sum(axis=1, keepdims=True)
        share = np.add.reduceat(joint, bounds[:-1], axis=0) / counts[:, None] * sets
        share /= share.sum(axis=1, keepdims=True)
    value = np.log((scaled * share[text]).sum(axis=1) + 1e-300) + top[:, 0]
    return share, np.add.reduceat(value, bounds[:-1])


def _chosen(words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Proportions of the languages in the best set by penalised likelihood.

    Starts from the best single language of each text and, while that pays,
    adds the language with the largest share of the full mixture.
    """
    count, languages = len(bounds) - 1, words.shape[1]
    single = np.add.reduceat(words, bounds[:-1], axis=0)
    best = np.zeros((count, languages))
    best[np.arange(count), single.argmax(axis=1)] = 1
    value, share = single.max(axis=1), best.copy()
    price = PENALTY * np.log(np.maximum(2, np.diff(bounds)))
    # No mixture can beat the best language of every word.
    limit = np.add.reduceat(words.max(axis=1), bounds[:-1])
    open_ = np.flatnonzero(limit - value > price)
    if not len(open_) or languages == 1:
        return share
    pick = _some(words, bounds, open_)
    full, _ = _fit(*pick, np.ones((len(open_), languages)))
    order = np.argsort(-full - 2 * best[open_], axis=1, kind="stable")
    for size in range(2, languages + 1):
        pick = _some(words, bounds, open_)
        sets = np.zeros((len(open_), languages))
        np.put_along_axis(sets, order[:, :size], 1, axis=1)
        fitted, found = _fit(*pick, sets)
        better = found - value[open_] > price[open_]
        open_, order = open_[better], order[better]
        share[open_], value[open_] = fitted[better], found[better]
        if not len(open_):
            break
    return share


def _some(words: np.ndarray, bounds: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words of some texts only."""
    counts = np.diff(bounds)[texts]
    begin = np.cumsum(counts) - counts
    index = np.repeat(bounds[texts] - begin, counts) + np.arange(counts.sum())
    return words[index], np.r_[begin, counts.sum()]


def identify(documents: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``row`` with ``lang_pred``, ``score`` and ``mixture``.

    ``mixture`` has the languages of the chosen set with their shares of the
    words, largest first, then by name; ``lang_pred`` is the first of them and ``score`` its
    share. A null text, one without a letter, and any text where nothing was
    learned are ``und`` with score 0.
    """
    sent = documents.sparkSession.sparkContext.broadcast(model)
    fields = "lang_pred string, score double, mixture array<struct<lang: string, share: double>>"

    def make():
        model = sent.value
        pair = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))

        def apply(texts: pa.StringArray) -> list[pa.Array]:
            mixtures: list[list[dict]] = [[] for _ in range(len(texts))]
            buckets, starts, bounds = _triples(texts)
            full = np.flatnonzero(np.diff(bounds))
            if len(full) and model.languages:
                logs = np.stack([np.add.reduceat(line[buckets], starts) for line in model.logs], axis=1).astype(float)
                share = _chosen(logs, np.r_[bounds[full], bounds[-1]])
                for row, shares in zip(full, share, strict=True):
                    used = sorted((-s, i) for i, s in enumerate(shares) if s > 0)
                    mixtures[row] = [{"lang": model.languages[i], "share": float(min(1.0, -s))} for s, i in used]
            return [
                pa.array([m[0]["lang"] if m else UNKNOWN for m in mixtures]),
                pa.array([m[0]["share"] if m else 0.0 for m in mixtures]),
                pa.array(mixtures, pair),
            ]

        return apply

    return extend(packed(documents), text, make, fields)
