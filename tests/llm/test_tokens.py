import random

import public_tokenizers
import sentencepiece

from creditmart.llm import tokens
from creditmart.llm.queries import LLM_QUERIES

PATH = public_tokenizers.path("piece_bpe_32k.model")
PLAIN = sentencepiece.SentencePieceProcessor(model_file=PATH)


def expected(text):
    ids = PLAIN.encode(text or "")
    return len((text or "").encode()), len(ids), len(ids) > 4096


def test_query_equals_the_tokenizer(spark, tables):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in LLM_QUERIES["op8_token_counts"](spark, sf).collect()}
    assert got == {r.doc_id: expected(r.text) for r in tables("documents", "sf0.01").collect()}


def test_any_text(spark, dirty):
    random.seed(5)
    signs = ["a", "the", "ing", " ", "  ", "\n", "\t", "\r", "▁", "é", "日本", "🙂", "<s>", "</s>", "<unk>", "<0x0A>", " ", "　", "\0", "ﬁ", "9", "."]
    texts = [None, "", " ", "\n", "▁", "a" * 30_000, " " * 5000, "\n" * 300, "the " * 5000] + [
        "".join(random.choices(signs, k=random.randint(1, 40))) for _ in range(600)
    ]
    found = tokens.count_tokens(dirty(texts), PATH).select("row.doc_id", "*").collect()
    for r in found:
        assert (r.n_bytes, r.n_tokens, r.over_limit) == expected(texts[r.doc_id]), repr(texts[r.doc_id])
    assert tokens.count_tokens(dirty([]), PATH).count() == 0


def test_full_cache_starts_anew(monkeypatch):
    monkeypatch.setattr(tokens, "CACHED", 3)
    lengths = tokens.Lengths({" the": 1}, PATH)
    for text in ("one two three four five six", "seven the eight nine", "one two the three"):
        assert lengths.count(text) == len(PLAIN.encode(text))
    assert len(lengths) <= 4
