import random
import re

from brute import ITEM_WORD, ascii_lower, mirrored

from creditmart.llm import licenses
from creditmart.llm.queries import LLM_QUERIES


def brute(text, templates):
    """Licenses of which some window of the grid holds 0.8 of the shingles."""
    def runs(words):
        size = min(5, max(1, len(words)))
        return [tuple(words[i : i + size]) for i in range(len(words) - size + 1)] if words else []

    words, found = ITEM_WORD.findall(ascii_lower(text)), set()
    for name, template in templates:
        own = ITEM_WORD.findall(ascii_lower(template))
        step = max(1, len(own) // 4)
        for start in range(0, len(words), step):
            window = words[start : start + len(own) + step] if len(words) >= 5 else words
            if own and len(set(runs(own)) & set(runs(window))) >= 0.8 * len(set(runs(own))) - 1e-9:
                found.add(name)
    return found


def test_query_equals_brute_force(spark, tables):
    rows = LLM_QUERIES["op1_license_scan"](spark, "/root/testdata/sf0.01").collect()
    texts = {r.doc_id: r.text for r in tables("documents", "sf0.01").collect()}
    assert len(rows) == len(texts)
    hinted = re.compile("licen|public|permi", re.I)
    for r in rows:
        want = brute(texts[r.doc_id], licenses.TEMPLATES) if hinted.search(texts[r.doc_id]) else set()
        assert set(r.licenses.split(",")) - {""} == want
    assert sum(r.n_matches > 0 for r in rows) >= 20


def test_edits_short_texts_and_dirt(spark, dirty):
    random.seed(2)
    templates = [*licenses.TEMPLATES, ("two", "all mine"), ("none", "...")]
    texts = [None, "", "...", "all mine", "ALL-MINE", "all mine mine"]
    for _, template in templates * 6:
        words = ["x%d" % random.randint(0, 9) for _ in range(20)] + template.split() + ["y z"] * 20
        for _ in range(random.randint(0, 4)):
            words[random.randrange(len(words))] = "changed"
        texts.append(" ".join(words[random.randint(0, 25):]))
    found = licenses.summary(licenses.find_licenses(dirty(texts), templates)).select("row.doc_id", "licenses", "matches").collect()
    for r in found:
        assert set(r.licenses.split(",")) - {""} == brute(texts[r.doc_id], templates), texts[r.doc_id]
    assert licenses.find_licenses(dirty([])).count() == 0
    assert licenses.find_licenses(dirty(texts), []).where("size(matches) > 0").count() == 0


def test_places_are_tight(dirty):
    text = "One two. Released under the MIT License. Three four. Released under the MIT license!"
    found = licenses.find_licenses(dirty([text])).first()
    assert [(m.license, m.start, m.end, m.share) for m in found.matches] == [("MIT", 2, 7, 1.0), ("MIT", 9, 14, 1.0)]


def test_words_in_mirrored_order(dirty):
    """Long words of two letters that hashes of powers cannot tell apart."""
    for letters in (1024, 2048, 4096):
        word, other = mirrored(letters)
        templates = [("long", f"all of {word} may be used")]
        rows = licenses.summary(licenses.find_licenses(dirty([f"see all of {w} may be used" for w in (word, other)]), templates))
        assert [r.licenses for r in rows.orderBy("row.doc_id").collect()] == ["long", ""]
