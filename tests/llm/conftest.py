import sys
from pathlib import Path

import pytest

HERE = Path(__file__).resolve().parent
sys.path.insert(0, str(HERE))

# A table with the dirt every operator must take: nulls, empty and very long
# texts, repeated rows, and columns named like those the operators use.
DIRTY = "doc_id bigint, text string, row string, spans int, items string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def tables(spark):
    """Reads a test table."""
    return lambda name, sf="sf0.001": spark.read.parquet(f"/root/testdata/{sf}/{name}.parquet")


@pytest.fixture(scope="session")
def dirty(spark):
    """Makes a table of texts with clashing extra columns."""
    def make(texts, first=0):
        rows = [(first + i, t, "x", 1, None, "en", "src0", None if t is None else len(t)) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, DIRTY)
    return make
