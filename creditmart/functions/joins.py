"""Joining per-key results back onto rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from creditmart.session import ensure_checkpoint_dir


def attach(rows: DataFrame, per_key: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join one row per key onto any number of rows of that key.

    The per-key side is stored first. Adaptive execution splits a hot key only
    where both sides of the join come straight from their own shuffle; an
    aggregate that already sits in the join's partitioning would rule that out.
    """
    ensure_checkpoint_dir(rows.sparkSession)
    return rows.join(per_key.checkpoint(), list(keys), "left")
