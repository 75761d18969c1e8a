"""Plain Python versions of the contracts, written from their wording."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter
from itertools import accumulate, product

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def mirrored(letters: int) -> tuple[str, str]:
    """A word of a and b in Thue-Morse order, and the same with both letters swapped."""
    word, other = "a", "b"
    while len(word) < letters:
        word, other = word + other, other + word
    return word, other


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def ascii_lower(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def contamination(documents, benchmark, window=10):
    """{doc_id: (n_words, n_hit, n_items, items_sha256, contaminated)}"""
    windows = {}
    for item, text in benchmark:
        words = ITEM_WORD.findall(ascii_lower(text))
        size = min(window, len(words))
        for i in range(len(words) - size + 1) if words else ():
            windows.setdefault(tuple(words[i : i + size]), set()).add(str(item))
    sizes = {len(w) for w in windows}
    result = {}
    for doc, text in documents:
        words, hit, items = ITEM_WORD.findall(ascii_lower(text)), set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                if found := windows.get(tuple(words[i : i + size])):
                    items |= found
                    hit.update(range(i, i + size))
        result[doc] = (len(words), len(hit), len(items), sha(",".join(sorted(items))), bool(hit))
    return result


def base_quality(documents):
    """{doc_id: (n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)}"""
    result = {}
    for doc, text in documents:
        text = text or ""
        words = WORD.findall(text)
        seen, dups = set(), 0
        for line in text.split("\n"):
            if WORD.search(line):
                dups += line in seen
                seen.add(line)
        at = {}
        for i in range(len(words) - 2):
            at.setdefault(tuple(words[i : i + 3]), []).append(i)
        repeated = {j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 3)}
        failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
        result[doc] = (
            len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dups, len(repeated), failed
        )
    return result


def without_repeats(documents, window=50):
    """{doc_id: (n_words, n_removed, kept_sha256)}"""
    words = {doc: WORD.findall(text or "") for doc, text in documents}
    first = {}
    for doc in sorted(words):
        w = words[doc]
        for i in range(len(w) - window + 1):
            first.setdefault(tuple(w[i : i + window]), doc)
    result = {}
    for doc, w in words.items():
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < doc:
                gone.update(range(i, i + window))
        result[doc] = (len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))
    return result


def alignments(documents, encode_a, encode_b):
    """{doc_id: (n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)}

    Each encoder gives (id, bytes) per token of the whole text.
    """
    texts, links, holds = {}, {}, {}
    for doc, text in documents:
        a, b = encode_a(" " + (text or "")), encode_b(text or "")
        whole = (" " + (text or "")).encode()
        if not text or any(b"".join(x for _, x in side) != whole for side in (a, b)):
            a = b = []
        ends = [list(accumulate(len(x) for _, x in side)) for side in (a, b)]
        cuts = sorted(set(ends[0]) & set(ends[1]))
        groups = [([], []) for _ in cuts]
        for k, side in enumerate((a, b)):
            for (token, _), end in zip(side, ends[k], strict=True):
                groups[bisect_left(cuts, end)][k].append(token)
        links[doc] = Counter(pair for left, right in groups for pair in product(left, right))
        for pair in links[doc]:
            holds[pair] = holds.get(pair, 0) + 1
        spelled = ";".join("|".join(",".join(map(str, side)) for side in group) for group in groups)
        texts[doc] = (len(a), len(b), len(groups), sum(links[doc].values())), sha(spelled) if a else ""
    best = {}
    for (a, _), n in holds.items():
        best[a] = max(best.get(a, 0), n)
    return {
        doc: (*counts, sum(n for p, n in links[doc].items() if holds[p] == best[p[0]]),
              sum(n * holds[p] for p, n in links[doc].items()), digest)
        for doc, (counts, digest) in texts.items()
    }


LETTERS = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def divergences(documents, least=10, top=10):
    """{(lang, source, part, item, value, rank)} of rows of text, lang and source."""
    counts, docs, groups = Counter(), Counter(), set()
    for text, lang, source in documents:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = Counter(ascii_lower(x) for x in LETTERS.findall(text or ""))
        for term, n in terms.items():
            counts[lang, source, term] += n
            docs[lang, term] += 1
    result = set()
    for lang in {lang for lang, _ in groups}:
        kept = [t for (of, t), n in docs.items() if of == lang and n >= least]
        sources = sorted(s for of, s in groups if of == lang)
        whole = {t: sum(counts[lang, s, t] for s in sources) for t in kept}

        def shares(count):
            total = sum(count.values())
            return {t: 1 + 1_000_000_000 * (count[t] + 2) // (total + 2 * len(kept)) for t in kept}

        def apart(p, q):
            return (p - q) * (p - q) // (p + q)

        of_source = {s: {t: counts[lang, s, t] for t in kept} for s in sources}
        p, q = {s: shares(of_source[s]) for s in sources}, shares(whole)
        for s in sources:
            pairs = {o: sum(apart(p[s][t], p[o][t]) for t in kept) for o in sources if o != s}
            terms = {t: apart(p[s][t], q[t]) for t in kept if of_source[s][t] and p[s][t] > q[t]}
            for part, values, last in (("pair", pairs, None), ("term", terms, top)):
                order = sorted(values.items(), key=lambda x: (-x[1], x[0].encode()))[:last]
                result |= {(lang, s, part, item, v, i + 1) for i, (item, v) in enumerate(order)}
    return result
