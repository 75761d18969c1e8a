"""Quality by compression: a text that a dictionary of good texts packs better than one of bad texts is good.

Both dictionaries are built from labelled texts. A text is packed stretch by
stretch, so that a dictionary helps the end of a long text as much as its
start; the difference of the packed sizes, divided by the larger, goes through a
line and the logistic function fitted on labelled texts kept out of the dictionaries.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmart.llm.rows import extend, packed

# Bounds of what is learnt from: labelled rows of each kind (those with the least hashes; half
# make the dictionaries, half calibrate), and stretches of each kind for a dictionary.
TRAINING_ROWS = 4000
STRETCHES = 24_000
DICTIONARY_BYTES = 112_640
STRETCH = 512
LEVEL = 3
THRESHOLD = 0.7


@dataclass(frozen=True)
class Model:
    """A dictionary of good and one of bad texts, and the line that calibrates differences.

    Without texts of both kinds there are no dictionaries, and the shift alone gives
    the share of good texts.
    """

    good: bytes
    bad: bytes
    slope: float
    shift: float


def _stretches(text: bytes) -> list[bytes]:
    return [text[at : at + STRETCH] for at in range(0, len(text), STRETCH)]


def _packer(content: bytes) -> zstandard.ZstdCompressor:
    dictionary = zstandard.ZstdCompressionDict(content)
    dictionary.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_content_size=False, write_dict_id=False)


class Differences:
    """Normalised differences of packed sizes, above zero for good texts."""

    def __init__(self, good: bytes, bad: bytes):
        self.packers = _packer(good), _packer(bad)

    def __call__(self, text: str | None) -> float:
        parts = _stretches((text or "").encode())
        good, bad = (sum(len(packer.compress(part)) for part in parts) for packer in self.packers)
        return (bad - good) / max(bad, good, 1)


def dictionary(stretches: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A trained dictionary; of too few stretches to train on, these themselves."""
    size = min(size, max(1024, sum(map(len, stretches)) // 8))
    try:
        return zstandard.train_dictionary(size, stretches).as_bytes()
    except zstandard.ZstdError:
        # Zstandard takes anything without its own header as raw content.
        return b"\n".join(stretches)[-DICTIONARY_BYTES:]


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def calibrate(x: np.ndarray, good: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the weighted logistic fit, by Newton's method with a slight pull towards zero."""
    points, line = np.stack([x, np.ones_like(x)]), np.zeros(2)
    pull = np.diag([1e-3, 1e-6])
    for _ in range(100):
        p = _sigmoid(line @ points)
        hessian = (points * (weight * p * (1 - p) + 1e-12)) @ points.T + pull
        move = np.linalg.solve(hessian, points @ (weight * (p - good)) + pull @ line)
        line -= move * min(1, 5 / max(np.abs(move).max(), 1e-9))
        if np.abs(move).max() < 1e-9:
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
    """Dictionaries and calibration from ``rows`` labelled rows of each kind at most.

    Rows and stretches with the least hashes are taken, the same on every run. The stretches are
    cut where the rows are; one task receives a bounded number of them and returns two
    dictionaries of a fixed size. Calibration weighs the kinds by how often they
    are among all labels. Labels other than 0 and 1, null keys and texts are left
    out; of a repeated key the least text and label count.
    """
    known = (
        labels.select(F.col(key).alias("key"), F.col(quality).cast("int").alias("good"))
        .where("key is not null and good in (0, 1)")
        .groupBy("key").agg(F.min("good").alias("good"))
    )
    of = dict(known.groupBy("good").count().collect())
    total = sum(of.values())
    prior = np.log((of.get(1, 0) + 0.5) / (of.get(0, 0) + 0.5))
    if len(of) < 2:
        return Model(b"", b"", 0.0, float(prior))
    spread = F.xxhash64("key")
    chosen = [known.where(F.col("good") == kind).orderBy(spread, "key").limit(rows) for kind in (0, 1)]
    sample = (
        documents.select(F.col(key).alias("key"), F.col(text).alias("text")).where("text is not null")
        .join(F.broadcast(chosen[0].union(chosen[1])), "key")
        .groupBy("key", "good").agg(F.min("text").alias("text"))
        .withColumn("builds", F.xxhash64("key", F.lit(1)) % 2 == 0)
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for good, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                parts = _stretches(value.encode())
                if parts:
                    yield pa.RecordBatch.from_arrays([pa.array([good] * len(parts), pa.int32()), pa.array(parts, pa.binary())], ["good", "part"])

    parts = sample.where("builds").select("good", "text").mapInArrow(cut, "good int, part binary")
    bounded = [
        parts.where(F.col("good") == kind).orderBy(F.xxhash64("part"), "part").limit(STRETCHES) for kind in (0, 1)
    ]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list[bytes]] = {0: [], 1: []}
        for batch in batches:
            for good, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found[good].append(part)
        if found[0] and found[1]:
            made = [dictionary(sorted(found[good])) for good in (1, 0)]
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in made], ["good", "bad"])

    made = bounded[0].union(bounded[1]).coalesce(1).mapInArrow(build, "good binary, bad binary").collect()
    if not made:
        return Model(b"", b"", 0.0, float(prior))
    good, bad = bytes(made[0].good), bytes(made[0].bad)
    scored = _differences(sample.where("not builds").select("text", "good"), "text", good, bad, ["good"])
    held = scored.select("row.good", "difference").collect()
    label = np.array([r.good for r in held], float)
    counts = [max(1, int((label == kind).sum())) for kind in (0, 1)]
    weight = np.where(label == 1, of[1] / counts[1], of[0] / counts[0]) * len(held) / total
    if not held:
        return Model(b"", b"", 0.0, float(prior))
    return Model(good, bad, *calibrate(np.array([r.difference for r in held]), label, weight))


def _differences(documents: DataFrame, text: str, good: bytes, bad: bytes, keep: list[str] | None) -> DataFrame:
    sent = documents.sparkSession.sparkContext.broadcast((good, bad))

    def make():
        if not sent.value[0]:
            return lambda texts: [pa.array(np.zeros(len(texts)))]
        difference = Differences(*sent.value)
        return lambda texts: [pa.array([difference(x) for x in texts.to_pylist()], pa.float64())]

    return extend(packed(documents), text, make, "difference double", keep=keep)


def judge(
    documents: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD, keep: list[str] | None = None
) -> DataFrame:
    """``row`` with ``difference``, ``score`` (0 to 1, higher: likelier good) and ``predicted`` (1 from ``threshold`` on).

    A null or empty text has no difference and takes the score of none. Whole
    texts are packed, however long; repeated rows are judged each. ``keep`` names
    the columns of ``row``.
    """
    line = F.lit(model.slope) * F.col("difference") + F.lit(model.shift)
    score = F.lit(1.0) / (F.lit(1.0) + F.exp(-line))
    return _differences(documents, text, model.good, model.bad, keep).select(
        "row", "difference", score.alias("score"), (score >= threshold).cast("int").alias("predicted")
    )
