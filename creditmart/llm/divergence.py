"""How far the sources of a language differ: a cube of (source block, source block, term block) cells.

A cell receives the counts of two blocks of sources within one block of terms,
and gives the part of their divergences that these terms make up; the parts are
added along the term axis. A source's counts are copied once per block of
sources, and no cell holds more than a fixed share of any table, however large
one source or one language is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from creditmart.llm.rows import LOWER, Texts, offsets_of, pieces
from creditmart.session import scratch_path

LEAST_DOCUMENTS = 10
TOP_TERMS = 10
# Shares of a text's terms are counted in billionths.
UNIT = 1_000_000_000
# About so many sources and terms to a block.
SOURCE_BLOCK = 64
TERM_BLOCK = 4096
# Parts that the rows of one source are divided into where they meet its totals.
SALTS = 32
# Distinct counts a task gathers before it passes them on.
COUNTED = 1 << 18

# Bytes of terms: ASCII letters, lower-cased, and everything beyond ASCII; others become spaces.
_TERM_BYTES = LOWER.copy()
_TERM_BYTES[[*range(0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = 0x20


def _terms(texts: Texts) -> tuple[pa.Array, pa.Array]:
    """All terms of some texts, and the text each is in."""
    offsets = offsets_of(texts).astype(np.int64)
    buffer = texts.buffers()[2]
    data = np.empty(0, np.uint8) if buffer is None else np.frombuffer(buffer, np.uint8)[offsets[0] : offsets[-1]]
    plain = pa.StringArray.from_buffers(
        len(texts), pa.py_buffer((offsets - offsets[0]).astype(np.int32)), pa.py_buffer(_TERM_BYTES[data])
    )
    lists = pc.ascii_split_whitespace(plain)
    terms, inside = pc.list_flatten(lists), pc.list_parent_indices(lists)
    full = pc.greater(pc.binary_length(terms), 0)
    return terms.filter(full), inside.filter(full)


def _summed(counts: pa.Table) -> pa.Table:
    found = counts.group_by(["lang", "source", "term"], use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
    return found.rename_columns(["lang", "source", "term", "n", "docs"]).combine_chunks()


def term_counts(documents: DataFrame) -> DataFrame:
    """Occurrences ``n`` and documents ``docs`` of every ``term`` by ``lang`` and ``source``, in parts to be added up.

    Terms are counted where the texts are; a task passes on bounded tables of counts.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = None
        for batch in batches:
            lang, source, texts = batch.columns
            for low, high in pieces(texts):
                terms, inside = _terms(texts.slice(low, high - low))
                each = pa.table({"text": inside, "term": terms}).group_by(["text", "term"], use_threads=False)
                each = each.aggregate([([], "count_all")])
                at = pc.add(each["text"], low)
                new = pa.table({
                    "lang": lang.take(at), "source": source.take(at), "term": each["term"],
                    "n": each["count_all"], "docs": np.ones(len(each), np.int64),
                })
                counts = _summed(new if counts is None else pa.concat_tables([counts, new]))
                if counts.num_rows > COUNTED:
                    yield from counts.to_batches()
                    counts = None
        if counts is not None:
            yield from counts.to_batches()

    named = [F.coalesce(F.col(name), F.lit("")).alias(name) for name in ("lang", "source", "text")]
    return documents.select(*named).mapInArrow(count, "lang string, source string, term string, n bigint, docs bigint")


def kept_counts(parts: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """Occurrences ``n`` in each source, and ``n_lang`` in the language, of terms in ``least`` documents of the language.

    ``first`` marks one row of every term. All is done by one shuffle, on language and term.
    """
    of_term = Window.partitionBy("lang", "term")
    summed = parts.repartition("lang", "term").groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs")
    )
    return (
        summed.withColumns({
            "n_lang": F.sum("n").over(of_term), "docs": F.sum("docs").over(of_term),
            "first": F.row_number().over(of_term.orderBy("source")) == 1,
        })
        .where(F.col("docs") >= least).drop("docs")
    )


def share(n, total, terms):
    """Smoothed share of a term in billionths, from one on; whole numbers of any size."""
    wide = "decimal(20,0)"
    over, under = (F.col(n) + 2).cast(wide), (F.col(total) + 2 * F.col(terms)).cast(wide)
    return F.lit(1) + F.call_function("div", over * F.lit(UNIT).cast("decimal(10,0)"), under)


def _shares(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """``share`` of counts over totals below 2**53, by long division in steps of a thousand."""
    left, whole = counts + 2, np.zeros(np.broadcast_shapes(counts.shape, totals.shape), np.int64)
    for step in range(4):
        whole = whole * (1000 if step else 1) + left // totals
        left = left % totals * 1000
    return whole + 1


def _apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


_CELL = "lang string, one string, other string, value bigint"


def _cell(cell: pa.Table) -> pa.Table:
    """Parts of the divergences between the sources of two blocks, within a block of terms."""
    is_source = pc.is_null(cell["term"])
    sources, rows = cell.filter(is_source).sort_by([("block", "ascending"), ("source", "ascending")]), cell.filter(pc.invert(is_source))
    names, block = sources["source"].to_pylist(), sources["block"].to_numpy()
    totals, here = sources["n"].to_numpy(), int(sources["here"][0].as_py())
    left, right = cell["left"][0].as_py(), cell["right"][0].as_py()
    pairs = [(i, np.flatnonzero((block == right) & (np.arange(len(names)) > i))) for i in np.flatnonzero(block == left)]
    values = [np.zeros(len(others), np.int64) for _, others in pairs]
    if here:
        coded = rows["term"].combine_chunks().dictionary_encode()
        counts = np.zeros((len(names), len(coded.dictionary)), np.int64)
        place = pc.index_in(rows["source"].combine_chunks(), pa.array(names, pa.string())).to_numpy()
        counts[place, coded.indices.to_numpy()] = rows["n"].to_numpy()
        p, absent = _shares(counts, totals[:, None]), _shares(np.zeros(len(names), np.int64), totals)
        for at, (i, others) in enumerate(pairs):
            seen = _apart(p[i], p[others]).sum(axis=1)
            values[at] = seen + (here - counts.shape[1]) * _apart(absent[i], absent[others])
    one = [names[i] for i, others in pairs for _ in others]
    other = [names[j] for _, others in pairs for j in others]
    lang = [cell["lang"][0].as_py()] * len(one)
    value = np.concatenate([*values, np.empty(0, np.int64)])
    return pa.table({"lang": pa.array(lang, pa.string()), "one": pa.array(one, pa.string()), "other": pa.array(other, pa.string()), "value": value})


def _sources(documents: DataFrame, kept: DataFrame) -> DataFrame:
    """Per ``lang`` and ``source``: occurrences ``total`` of kept terms; and of the language: ``total_lang``, kept ``terms``, blocks."""
    groups = documents.select(*[F.coalesce(F.col(name), F.lit("")).alias(name) for name in ("lang", "source")]).distinct()
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count_if("first").alias("firsts"))
    whole = Window.partitionBy("lang")

    def blocks(number, size):
        return F.greatest(F.lit(1), F.ceil(number / size)).cast("int")

    return (
        groups.join(totals, ["lang", "source"], "left").fillna(0, ["total", "firsts"])
        .withColumns({"total_lang": F.sum("total").over(whole), "terms": F.sum("firsts").over(whole)})
        .withColumns({
            "source_blocks": blocks(F.count("*").over(whole), SOURCE_BLOCK),
            "term_blocks": blocks(F.col("terms"), TERM_BLOCK),
        })
        .withColumn("block", F.pmod(F.xxhash64("source"), "source_blocks").cast("int")).drop("firsts")
    )


def _with_sources(kept: DataFrame, sources: DataFrame) -> DataFrame:
    """Counts with what is known of their sources; the rows of a hot source are divided by their terms."""
    salted = sources.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64("term"), F.lit(SALTS)).cast("int")
    return kept.withColumn("salt", salt).join(salted, ["lang", "source", "salt"])


def divergences(counts: DataFrame, sources: DataFrame) -> DataFrame:
    """``value`` of every two sources ``one`` and ``other`` of a language.

    ``counts`` are kept counts with their sources. The total of a source stands
    in ``n`` of a row without a term.
    """
    depth = F.pmod(F.xxhash64("term"), "term_blocks").cast("int").alias("depth")
    rows = counts.select("lang", "source", "term", "n", "source_blocks", "block", depth, "first")
    here = rows.where("first").groupBy("lang", "depth").agg(F.count("*").alias("here"))
    names = (
        sources.select(
            "lang", "source", F.lit(None).cast("string").alias("term"),
            (F.col("total") + 2 * F.col("terms")).alias("n"), "source_blocks", "block",
            F.explode(F.sequence(F.lit(0), F.col("term_blocks") - 1)).alias("depth"),
        )
        .join(here, ["lang", "depth"], "left").withColumn("here", F.coalesce("here", F.lit(0)))
    )
    opposite = F.explode(F.sequence(F.lit(0), F.col("source_blocks") - 1)).alias("opposite")
    both = rows.drop("first").withColumn("here", F.lit(None).cast("bigint")).unionByName(names).select("*", opposite)
    cells = both.select(
        "lang", F.least("block", "opposite").alias("left"), F.greatest("block", "opposite").alias("right"), "depth",
        "block", "source", "term", "n", "here",
    )
    parts = cells.groupBy("lang", "left", "right", "depth").applyInArrow(_cell, _CELL)
    return parts.groupBy("lang", "one", "other").agg(F.sum("value").alias("value"))


def standing_out(counts: DataFrame, top: int = TOP_TERMS) -> DataFrame:
    """The ``top`` terms of each source that it has more of than its language."""
    p, q = share("n", "total", "terms"), share("n_lang", "total_lang", "terms")
    terms = (
        counts.select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")).where("p > q")
        .select("lang", "source", "item", F.expr("(p - q) * (p - q) div (p + q)").alias("value"))
    )
    return _ranked(terms, "term").where(F.col("rank") <= top)


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.select(
        "lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank")
    )


def audit(documents: DataFrame) -> DataFrame:
    """How far each source is from the others of its language, and the terms that make it stand out.

    ``documents`` has ``text``, ``lang`` and ``source``; null counts as empty, other columns do
    not matter. Part ``pair`` has a row per other source of the language, part
    ``term`` the ten terms with the largest share of the distance to the whole
    language; ``rank`` counts by falling ``value``, ties by ``item``. A language
    without a term in ten documents has distances of zero. Repeated rows count
    each, very long texts whole; an empty table gives no rows.
    """
    spark = documents.sparkSession
    path = scratch_path(spark, "kept-terms")
    kept_counts(term_counts(documents)).write.parquet(path)
    kept = spark.read.parquet(path)
    sources_path = scratch_path(spark, "sources")
    _sources(documents, kept).write.parquet(sources_path)
    sources = spark.read.parquet(sources_path)
    counts = _with_sources(kept, sources)
    apart = divergences(counts, sources)
    ways = F.explode(F.array(F.struct(F.col("one").alias("source"), F.col("other").alias("item")),
                             F.struct(F.col("other").alias("source"), F.col("one").alias("item")))).alias("way")
    pairs = apart.select("lang", ways, "value").select("lang", "way.source", "way.item", "value")
    return _ranked(pairs, "pair").union(standing_out(counts))
