"""DuckDB SQL of the operators whose results SQL can express, written from their contracts."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"
ITEM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LETTERS = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def repeats(window: int = 50) -> str:
    """Substring deduplication: every window spelled out, and every word it covers."""
    return f"""
WITH texts AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS words FROM documents
), places AS (
    SELECT doc_id, words, unnest(range(1, greatest(1, len(words) - {window} + 2))) AS place FROM texts
), windows AS (
    SELECT doc_id, place, md5(array_to_string(words[place : place + {window} - 1], ' ')) AS content FROM places
), firsts AS (
    SELECT content, min(doc_id) AS first_id FROM windows GROUP BY content
), gone AS (
    SELECT DISTINCT doc_id, place + inner_place AS place
    FROM windows JOIN firsts USING (content) CROSS JOIN range({window}) r(inner_place)
    WHERE first_id < doc_id
), spread AS (
    SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM texts
), kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS kept, count(*) AS n_kept
    FROM spread ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id
)
SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n_kept, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (doc_id)"""


def leaks(window: int = 10) -> str:
    """Benchmark decontamination: every phrase against every place of its length."""

    def split(key: str, table: str) -> str:
        lower = f"translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}')"
        return f"SELECT {key}, regexp_extract_all({lower}, '{ITEM_WORD}') AS words FROM {table}"

    return f"""
WITH texts AS ({split('doc_id', 'documents')}
), items AS ({split('item_id', 'benchmark')}
), phrases AS (
    SELECT DISTINCT item_id, size, array_to_string(words[place : place + size - 1], ' ') AS content FROM (
        SELECT item_id, words, least(len(words), {window}) AS size, unnest(range(1, len(words) - least(len(words), {window}) + 2)) AS place
        FROM items WHERE len(words) > 0)
), places AS (
    SELECT doc_id, words, size, unnest(range(1, greatest(1, len(words) - size + 2))) AS place
    FROM texts CROSS JOIN (SELECT DISTINCT size FROM phrases)
), hits AS (
    SELECT p.doc_id, p.place, p.size, f.item_id
    FROM places p JOIN phrases f ON p.size = f.size AND array_to_string(p.words[p.place : p.place + p.size - 1], ' ') = f.content
), counted AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit
    FROM (SELECT doc_id, unnest(range(place, place + size)) AS place FROM hits) GROUP BY doc_id
), named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM texts LEFT JOIN counted USING (doc_id) LEFT JOIN named USING (doc_id)"""


def divergences(least: int = 10, top: int = 10) -> str:
    """Source divergence: every kept term of every two sources of a language, all in whole numbers."""
    lower = f"translate(unnest(regexp_extract_all(text, '{LETTERS}')), '{UPPER}', '{UPPER.lower()}')"
    share = "1 + (1000000000::HUGEINT * ({n} + 2)) // ({total} + 2 * v)"
    apart = "((p - q) * (p - q)) // (p + q)"
    return f"""
WITH texts AS (
    SELECT row_number() OVER () AS place, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source
    FROM documents
), spread AS (
    SELECT place, lang, source, {lower} AS term FROM texts
), kept AS (
    SELECT lang, term, count(*) AS n_lang FROM spread GROUP BY lang, term HAVING count(DISTINCT place) >= {least}
), langs AS (
    SELECT lang, count(*) AS v, sum(n_lang) AS total FROM kept GROUP BY lang
), counted AS (
    SELECT lang, source, term, count(*) AS n, any_value(n_lang) AS n_lang
    FROM spread JOIN kept USING (lang, term) GROUP BY lang, source, term
), groups AS (
    SELECT lang, source, coalesce(total, 0) AS total
    FROM (SELECT DISTINCT lang, source FROM texts)
    LEFT JOIN (SELECT lang, source, sum(n) AS total FROM counted GROUP BY lang, source) USING (lang, source)
), dense AS MATERIALIZED (
    SELECT g.lang, g.source, k.term, {share.format(n="coalesce(c.n, 0)", total="g.total")} AS p
    FROM groups g JOIN langs l USING (lang) JOIN kept k USING (lang) LEFT JOIN counted c USING (lang, source, term)
), apart AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
    FROM dense a JOIN dense b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pairs AS (
    SELECT a.lang, a.source, b.source AS item, coalesce(value, 0)::BIGINT AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
), shares AS (
    SELECT c.lang, c.source, c.term AS item, {share.format(n="c.n", total="g.total")} AS p, {share.format(n="c.n_lang", total="l.total")} AS q
    FROM counted c JOIN groups g USING (lang, source) JOIN langs l USING (lang)
), ranked AS (
    SELECT lang, source, 'pair' AS part, item, value,
        row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank
    FROM pairs
    UNION ALL
    SELECT lang, source, 'term', item, ({apart})::BIGINT AS value,
        row_number() OVER (PARTITION BY lang, source ORDER BY {apart} DESC, item) AS rank
    FROM shares WHERE p > q
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank FROM ranked WHERE part = 'pair' OR rank <= {top}"""
