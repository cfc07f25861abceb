import base64
import hashlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from data import clashing, docs, odd_rows, words
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from candlewright.llm import token_counts
from candlewright.llm.byte_bpe import ByteBpe, byte_characters, encode_column, read_ranks, safe_parts
from candlewright.llm.token_counts import JsonCounter, count_tokens, safe_parts as white_parts

JSON, RANKS = P.path("word_bpe_49k.json"), P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def bpe():
    return ByteBpe(read_ranks(RANKS), P.PATTERN)


def test_byte_characters_are_one_to_one():
    chars = byte_characters()
    assert len(set(chars)) == 256 and chars[ord("A")] == "A" and chars[0] == "Ā" and chars[32] == "Ġ"


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=80))
def test_ids_are_those_of_the_library(reference, bpe, text):
    packed = b"".join(bpe.encode(text))
    assert list(np.frombuffer(packed, "<u4")) == reference.encode_ordinary(text)
    assert bpe.decode(packed) == text.encode()


def test_long_texts_are_cut_safely(reference, bpe):
    text = words(9000, 4) + "'s it's  \n\n x " + "ab" * 3000
    parts = list(safe_parts(text, 1000))
    assert "".join(parts) == text and len(parts) > 20
    assert [i for p in parts for i in reference.encode_ordinary(p)] == reference.encode_ordinary(text)
    assert list(safe_parts("", 5)) == [""] and list(safe_parts("abc" * 10, 5)) == ["abc" * 10]


def test_encode_column(spark, reference):
    rows = odd_rows()
    got = encode_column(clashing(docs(spark, rows)), RANKS, P.PATTERN, keep=("doc_id", "score")).collect()
    assert len(got) == len(rows)
    texts = {r[0]: r[1] or "" for r in rows}
    for r in got:
        ids = reference.encode_ordinary(texts[r.doc_id])
        assert (r.score, r.n_tokens, list(r.ids)) == ("mine", len(ids), ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    assert encode_column(docs(spark, []), RANKS, P.PATTERN).count() == 0


def test_count_tokens(spark):
    t = Tokenizer.from_file(JSON)
    rows = odd_rows()
    got = count_tokens(clashing(docs(spark, rows)), JSON, keep=("doc_id",), limit=40).collect()
    assert len(got) == len(rows)
    texts = {r[0]: r[1] or "" for r in rows}
    for r in got:
        n = len(t.encode(texts[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 40)
    assert count_tokens(docs(spark, []), JSON).count() == 0


def test_pieces_are_counted_whole(spark):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    rows = [r for r in odd_rows() if r[0] != 7]
    for r in count_tokens(docs(spark, rows), P.path("piece_bpe_32k.model"), keep=("doc_id",)).collect():
        assert r.n_tokens == len(sp.encode({x[0]: x[1] or "" for x in rows}[r.doc_id]))


@pytest.fixture(scope="module")
def counter():
    return JsonCounter(JSON)


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="ab \u0301\u0130\u00a0\x85\x1c<|endoftx>'s\n\t\r1!\U0001d4b3", max_size=200))
def test_parts_do_not_change_counts(counter, text):
    assert "".join(white_parts(text)) == text.translate(dict.fromkeys(map(ord, " \n\t\r")))
    assert counter([text, "a b"])[0] == len(counter.tokenizer.encode(text, add_special_tokens=False).ids)


def test_counter_forgets_and_remembers(counter, monkeypatch):
    monkeypatch.setattr(token_counts, "KNOWN_PARTS", 50)
    monkeypatch.setattr(token_counts, "CALL_CHARS", 30)
    texts = [words(40, i) + " " + "y" * 200 for i in range(6)]
    for _ in range(2):
        assert counter(texts) == [len(counter.tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]
    assert counter([]) == []


@pytest.mark.parametrize("file", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_texts_are_cut_only_where_the_file_allows_it(file):
    from tokenizers import Tokenizer

    path = P.path(file)
    count, whole = token_counts.JsonCounter(path), Tokenizer.from_file(path)
    texts = ["a b a", "  x\n\ny  z ", "", " ", "<|endoftext|> a<|endoftext|>", "don't  \t I'll 12 345"]
    assert count(texts) == [len(whole.encode(t, add_special_tokens=False).ids) for t in texts]
    assert count.cuts == file.startswith("word")


def test_long_matches_are_not_remembered():
    bpe = ByteBpe(read_ranks(RANKS), P.PATTERN)
    text = " ".join(words(1, i) + "x" * 40 * i for i in range(1, 9))
    packed = b"".join(bpe.encode(text))
    assert bpe.decode(packed) == text.encode() and packed == b"".join(bpe.encode(text))
    assert bpe.known and max(map(len, bpe.known)) <= 64
