"""Quality rules: counted base rules, and a calibrated classifier of hashed n-grams."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmart.llm.rows import (
    LOWER, NOT_SPACE, Words, extend, inside_texts, list_array, merged, mixed, packed,
    window_hashes,
)

# The classifier is fitted on so many labelled rows at most: those with the smallest hashes.
TRAINING_ROWS = 8000
# A text is rejected below this calibrated probability of good quality.
THRESHOLD = 0.5
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
REPEAT_WINDOW = 3
SYMBOLS = "#*$%&|<>"

# Buckets of word features, and as many of features of three bytes.
BITS = 16
BUCKETS = 1 << BITS
EPOCHS, BATCH, RATE, DECAY = 12, 64, 0.5, 1e-6

_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[[ord(c) for c in SYMBOLS]] = True
_IN_LINE = np.ones(256, bool)
_IN_LINE[0x0A] = False


@dataclass(frozen=True)
class Model:
    """Weights per bucket, a bias, and the line that calibrates scores; empty without labels of both kinds."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float


def _before(marks: np.ndarray) -> np.ndarray:
    """How many marks lie before each position."""
    total = np.zeros(len(marks) + 1, np.int64)
    np.cumsum(marks, out=total[1:])
    return total


def base_counts(words: Words) -> dict[str, np.ndarray]:
    """The counts of the base rules, per text."""
    data, offsets = words.data, words.offsets
    letters = NOT_SPACE[data]
    begun = letters & ((data & 0xC0) != 0x80)
    return {
        "n_words": words.counts.astype(np.int64),
        "word_chars": np.diff(_before(begun)[offsets]),
        "n_symbols": np.diff(_before(_IS_SYMBOL[data])[offsets]),
        "n_dup_lines": _repeated_lines(words, _before(letters)),
        "n_repeat_words": _repeated_words(words),
    }


def _repeated_lines(words: Words, letters: np.ndarray) -> np.ndarray:
    """Lines with a word that equal an earlier line of their text."""
    lines = words.divided(_IN_LINE)
    full = letters[lines.ends] > letters[lines.starts]
    text = lines.texts()[full]
    _, first = np.unique(lines.hashes[full] + mixed(text.astype(np.uint64)), return_index=True)
    count = len(words.counts)
    return np.bincount(text, minlength=count) - np.bincount(text[first], minlength=count)


def _repeated_words(words: Words) -> np.ndarray:
    """Words in windows found twice or more in their text."""
    fits = np.flatnonzero(inside_texts(words.bounds, REPEAT_WINDOW))
    keys = window_hashes(words.hashes, REPEAT_WINDOW)[fits] + mixed(
        words.texts()[fits].astype(np.uint64)
    )
    _, which, counts = np.unique(keys, return_inverse=True, return_counts=True)
    again = fits[counts[which] > 1]
    marks = merged(again, again + REPEAT_WINDOW, len(words.starts))
    return np.diff(_before(marks)[words.bounds])


def _buckets(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of lower-case words and of three consecutive bytes of one text, and the texts' bounds in each."""
    lower = words.divided(NOT_SPACE, lower=True)
    word = (lower.hashes >> np.uint64(64 - BITS)).astype(np.int32)
    data = words.data.astype(np.uint32)
    fits = inside_texts(words.offsets, 3)
    key = (data[:-2] | (data[1:-1] << 8) | (data[2:] << 16))[fits] if len(data) > 2 else data[:0]
    chars = ((key * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)).astype(np.int32) + BUCKETS
    return word, lower.bounds, chars, _before(fits)[np.clip(words.offsets, 0, len(fits))]


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums per text, each added up by itself, so that no other text shows in its rounding."""
    count = len(bounds) - 1
    return np.bincount(np.repeat(np.arange(count), np.diff(bounds)), values, count)


def raw_scores(words: Words, model: Model) -> np.ndarray:
    """Linear scores: the mean weight of a text's words plus that of its byte triples."""
    word, word_bounds, chars, char_bounds = _buckets(words)
    score = np.full(len(words.counts), model.bias)
    for buckets, bounds in ((word, word_bounds), (chars, char_bounds)):
        score += _sums(model.weights[buckets], bounds) / np.maximum(1, np.diff(bounds))
    return score


def _features():
    """Per text: buckets and their shares of the text."""

    def apply(texts: pa.StringArray) -> list[pa.Array]:
        words, rows = Words(texts, NOT_SPACE), []
        word, word_bounds, chars, char_bounds = _buckets(words)
        for i in range(len(texts)):
            a, b = word[word_bounds[i] : word_bounds[i + 1]], chars[char_bounds[i] : char_bounds[i + 1]]
            at, count = np.unique(np.concatenate([a, b]), return_counts=True)
            rows.append((at, count / np.where(at < BUCKETS, max(1, len(a)), max(1, len(b)))))
        sizes = [len(at) for at, _ in rows]
        join = lambda k, kind: np.concatenate([r[k] for r in rows] or [[]]).astype(kind)
        return [list_array(pa.array(join(0, np.int32)), sizes), list_array(pa.array(join(1, np.float32)), sizes)]

    return apply


def fit(at: list[np.ndarray], share: list[np.ndarray], good: np.ndarray) -> Model:
    """Logistic regression by adaptive gradient steps; a quarter of the rows calibrates it."""
    held = np.arange(len(good)) % 4 == 3
    weights, bias = np.zeros(2 * BUCKETS), 0.0
    seen, seen_bias = np.full(2 * BUCKETS, 1e-8), 1e-8
    train = np.flatnonzero(~held)

    def score(rows):
        return np.array([weights[at[i]] @ share[i] for i in rows]) + bias

    for epoch in range(EPOCHS):
        order = np.random.default_rng(epoch).permutation(train)
        for low in range(0, len(order), BATCH):
            rows = order[low : low + BATCH]
            error = (_sigmoid(score(rows)) - good[rows]) / len(rows)
            index = np.concatenate([at[i] for i in rows])
            step = np.concatenate([share[i] * e for i, e in zip(rows, error, strict=True)])
            gradient = np.bincount(index, step, 2 * BUCKETS) + DECAY * weights
            seen += gradient**2
            weights -= RATE * gradient / np.sqrt(seen)
            seen_bias += error.sum() ** 2
            bias -= RATE * error.sum() / np.sqrt(seen_bias)
    return Model(weights.astype(np.float32), bias, *_calibrate(score(np.flatnonzero(held)), good[held]))


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _calibrate(score: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and shift that fit the held rows best, by Newton's method on smoothed targets."""
    n_good, n_bad = good.sum(), (1 - good).sum()
    if not n_good or not n_bad:
        return 1.0, 0.0
    target = np.where(good > 0, (n_good + 1) / (n_good + 2), 1 / (n_bad + 2))
    points, line = np.stack([score, np.ones_like(score)]), np.array([1.0, 0.0])
    for _ in range(50):
        p = _sigmoid(line @ points)
        hessian = (points * (p * (1 - p) + 1e-9)) @ points.T + 1e-6 * np.eye(2)
        move = np.linalg.solve(hessian, points @ (p - target))
        line -= np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-8:
            break
    return float(line[0]), float(line[1])


def train(
    documents: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    quality: str = "quality",
    rows: int = TRAINING_ROWS,
) -> Model:
    """Fit the classifier on ``rows`` labelled rows at most.

    The rows with the smallest hashes of their key are taken, so the choice is
    the same on every run. Features are extracted where the rows are; one task
    receives the bounded sample and returns weights of a fixed size. Labels
    other than 0 and 1, null keys and texts are left out; of a repeated key the
    least text and label count.
    """
    chosen = (
        labels.select(F.col(key).alias("key"), F.col(quality).cast("int").alias("good"))
        .where("key is not null and good in (0, 1)")
        .groupBy("key").agg(F.min("good").alias("good"))
        .orderBy(F.xxhash64("key"), "key").limit(rows)
    )
    sample = (
        documents.select(F.col(key).alias("key"), F.col(text).alias("text")).where("text is not null")
        .join(F.broadcast(chosen), "key")
        .groupBy("key", "good").agg(F.min("text").alias("text"))
    )
    features = (
        extend(packed(sample), "text", _features, "at array<int>, share array<float>")
        .select(F.xxhash64("row.key").alias("place"), "row.key", "row.good", "at", "share")
    )

    def learn(batches):
        at, share, good, place = [], [], [], []
        for batch in batches:
            place += zip(batch.column(0).to_pylist(), map(str, batch.column(1).to_pylist()), strict=True)
            good += batch.column(2).to_pylist()
            at += [batch.column(3)[i].values.to_numpy() for i in range(batch.num_rows)]
            share += [batch.column(4)[i].values.to_numpy() for i in range(batch.num_rows)]
        order = sorted(range(len(place)), key=place.__getitem__)
        good = np.array(good, float)[order]
        if 0 < good.sum() < len(good):
            model = fit([at[i] for i in order], [share[i] for i in order], good)
            yield pa.RecordBatch.from_pydict({
                "weights": [model.weights.tobytes()], "line": [[model.bias, model.slope, model.shift]]
            })

    found = features.coalesce(1).mapInArrow(learn, "weights binary, line array<double>").collect()
    if not found:
        return Model(np.empty(0, np.float32), 0.0, 1.0, 0.0)
    return Model(np.frombuffer(found[0].weights, np.float32), *found[0].line)


def judge(
    documents: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """``row`` with the base counts, ``base_failed``, ``score`` and ``kept``.

    ``score`` is the calibrated probability of good quality, null where no
    classifier could be fitted; then the base rules alone decide. A null or
    empty text has no words and fails the base rules. Repeated rows are judged each.
    """
    sent = documents.sparkSession.sparkContext.broadcast(model)

    def make():
        model = sent.value

        def apply(texts: pa.StringArray) -> list[pa.Array]:
            words = Words(texts, NOT_SPACE)
            counts = base_counts(words)
            if len(model.weights):
                score = _sigmoid(model.slope * raw_scores(words, model) + model.shift)
                scores = pa.array(score)
            else:
                scores = pa.nulls(len(texts), pa.float64())
            return [*map(pa.array, counts.values()), scores]

        return apply

    fields = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, score double"
    failed = f"n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words"
    return extend(packed(documents), text, make, fields).select(
        "row", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        F.expr(failed).alias("base_failed"), "score",
        F.expr(f"not ({failed}) and coalesce(score >= {threshold}, true)").alias("kept"),
    )
