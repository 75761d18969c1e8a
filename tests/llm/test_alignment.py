import random

import pyarrow as pa
import pytest
import public_tokenizers
import sentencepiece
import tokenizers
from brute import alignments

from creditmart.llm import alignment
from creditmart.llm.queries import LLM_QUERIES

A, B = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
WHOLE_A = tokenizers.Tokenizer.from_file(A)
WHOLE_A.encode_special_tokens = True
WHOLE_B = sentencepiece.SentencePieceProcessor(model_file=B)
LETTERS = [*range(33, 127), *range(161, 173), *range(174, 256)]
SPELLED = dict(zip(map(chr, LETTERS), LETTERS, strict=True))
SPELLED |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in LETTERS)}


def encode_a(text):
    found = WHOLE_A.encode(text, add_special_tokens=False)
    return [(i, bytes(SPELLED[c] for c in WHOLE_A.id_to_token(i))) for i in found.ids]


def encode_b(text):
    pieces = [(i, WHOLE_B.id_to_piece(i)) for i in WHOLE_B.encode(text)]
    return [(i, bytes([int(p[3:5], 16)]) if WHOLE_B.is_byte(i) else p.replace("▁", " ").encode()) for i, p in pieces]


def result(frame):
    return {r[0]: tuple(r[1:]) for r in frame.collect()}


@pytest.mark.parametrize("frequent", [alignment.FREQUENT, 500])
def test_query_equals_brute_force(spark, tables, monkeypatch, frequent):
    monkeypatch.setattr(alignment, "FREQUENT", frequent)
    sf = "/root/testdata/sf0.001"
    documents = [tuple(r) for r in tables("documents").select("doc_id", "text").collect()]
    assert result(LLM_QUERIES["op11_token_alignment"](spark, sf)) == alignments(documents, encode_a, encode_b)


def test_any_text(spark, dirty, monkeypatch):
    monkeypatch.setattr(alignment, "FREQUENT", 40)
    random.seed(7)
    signs = ["a", "the", "ing", " ", " ", "  ", "\n", "\t", "\r", "▁", "é", "ç", "日本", "🙂", "<s>", "</s>", "<0x0A>",
             "<|endoftext|>", " ", "　", "\u0085", " ", "\x1c", "'s", "\0", "ﬁ", "9", "12", ".", "…", "é"]
    texts = [None, "", " ", "\n", "▁", "  a", "a ", "a" * 30_000, " " * 5000, "\n" * 300, "the " * 5000, "same", "same"]
    texts += ["".join(random.choices(signs, k=random.randint(1, 40))) for _ in range(1500)]
    want = alignments(enumerate(texts), encode_a, encode_b)
    got = result(alignment.alignment(dirty(texts), A, B).select("row.doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"))
    assert got == want
    assert alignment.alignment(dirty([]), A, B).count() == 0


def test_stretches_do_not_depend_on_neighbours():
    texts = pa.array(["", "x y", None, "é à b", "", "a  b c"])
    found, inside = alignment.stretches(alignment.spaced(texts))
    assert found.to_pylist() == [" x", " y", " é", " à", " b", " a  b", " c"]
    assert inside.tolist() == [1, 1, 3, 3, 3, 5, 5]
    part, _ = alignment.stretches(alignment.spaced(texts.slice(3, 2)))
    assert part.to_pylist() == [" é", " à", " b"]


def test_counts_leave_a_task_in_bounded_tables(spark, dirty, monkeypatch):
    texts = [f"the {i} of it" for i in range(50)]
    aligned = alignment.align(dirty(texts), A, B)
    whole = {tuple(r) for r in alignment.count_links(aligned).collect()}
    monkeypatch.setattr(alignment, "COUNTED", 3)
    assert {tuple(r) for r in alignment.count_links(aligned).collect()} == whole
