"""Encoding, decoding and counting against the libraries of the vocabularies."""

from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer, pre_tokenizers

from oremill.llm import bpe, pretokens, token_counts
from oremill.llm.queries import QUERIES

PIECES = ["aab ", "ab\n  ", "the quick're''s ", "éèß漢字日本 ", "😀👩‍👩‍👧 a", "՘\U0002b73a1x", "\x85\xa0  a", "0123 ²½Ⅷ", "!!%%--=="]
CODE_POINTS = [(0, 0x2FF), (0x300, 0xD7FF), (0xE000, 0x10FFFF)]


def texts(n: int, seed: int = 1) -> list[str]:
    r = random.Random(seed)
    made = ["".join(r.choice(r.choice(PIECES)) for _ in range(r.randint(0, 60))) for _ in range(n)]
    return made + ["".join(chr(r.randint(*r.choice(CODE_POINTS))) for _ in range(r.randint(0, 20))) for _ in range(n)]


@pytest.fixture(scope="module", params=["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"])
def both(request):
    vocab = bpe.vocabulary(public_tokenizers.path(request.param))
    return vocab, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocab.ranks, special_tokens={})


def test_pretokens_are_the_library_s_for_every_code_point():
    library = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
    for start in range(0, 0x110000, 7):  # stepped, as all code points take a minute
        for code in (start, start + 1) if not 0xD7F0 <= start < 0xE000 else ():
            if code < 0x110000:
                text = f"a{chr(code)}1{chr(code)}! {chr(code)}x  {chr(code)}"
                ends = [end for _, (_, end) in library.pre_tokenize_str(text)]
                found = pretokens.split(text)
                assert "".join(found) == text and len(found) == len(ends), hex(code)


def test_encodes_as_the_library(both):
    vocab, library = both
    for text in [*texts(700), "a" * 20_000, " " * 3_000, "-=" * 2_000]:
        tokens = list(vocab.encode(text))
        assert tokens == library.encode_ordinary(text)
        assert vocab.decode(tokens) == text.encode()


def test_edits_and_appends_give_the_encoding_of_the_new_text(both):
    vocab, library = both
    r = random.Random(2)
    for text in texts(250, 3):
        kept = bpe.EditableText(vocab, text)
        for _ in range(4):
            start = len(text) if r.random() < 0.4 else r.randint(0, len(text))
            end, new = min(len(text), start + r.randint(0, 6)), "".join(r.choice(r.choice(PIECES)) for _ in range(r.randint(0, 6)))
            text = text[:start] + new + text[end:]
            kept.edit(start, end, new)
            assert kept.text == text and kept.tokens() == library.encode_ordinary(text)


def test_an_edited_table_is_that_of_the_new_bytes(both):
    vocab, library = both
    r = random.Random(4)
    for _ in range(60):
        data = bytes(r.choice(b"ab-= e") for _ in range(600))
        start = r.randint(0, 500)
        end, new = start + r.randint(0, 9), bytes(r.choice(b"ab-= e") for _ in range(r.randint(0, 9)))
        table = bpe.PrefixTable(vocab, data)
        table.edit(start, end, new)
        after = data[:start] + new + data[end:]
        assert table.last == bpe.PrefixTable(vocab, after).last
        assert table.tokens() == library._core_bpe.encode_single_piece(after)


def test_encode_and_decode_keep_other_columns(spark):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    rows = [(1, "some text", "x", [9], "t"), (1, "some text", "x", [9], "t"), (2, None, None, None, None), (None, "", "y", [], "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string, tokens string, ids array<int>, data string")
    out = bpe.decode(bpe.encode(df, path), path)
    assert out.columns == ["doc_id", "text", "ids", "tokens", "data"]
    found = sorted((r.doc_id or 0, r.text or "", bytes(r.data).decode()) for r in out.collect())
    assert found == [(0, "", ""), (1, "some text", "some text"), (1, "some text", "some text"), (2, "", "")]
    once = bpe.round_trip(df, path)
    assert once.columns == out.columns and sorted(map(str, once.collect())) == sorted(map(str, out.collect()))
    assert bpe.encode(df.limit(0), path).count() == 0


def test_query_matches_the_library(spark, sf_dir, both):
    if "multi" in str(both[0].bytes_of.get(None, "")):
        return
    ranks = bpe.vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken")).ranks
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    documents = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op1_byte_bpe"](spark, sf_dir).collect()
    assert len(rows) == len(documents)
    for row in rows:
        tokens = library.encode_ordinary(documents[row.doc_id])
        assert row.n_tokens == len(tokens)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, tokens)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(documents[row.doc_id].encode()).hexdigest()


def test_counts_are_the_library_s():
    path = public_tokenizers.path("byte_bpe_50k.json")
    counter, library = token_counts.counter(path), Tokenizer.from_file(path)
    special = ["<|endoftext|>", "a<|endoftext|> b<|endof<|endoftext|><|endoftext|>", "<|endoftext|"]
    for text in [*texts(700, 5), *special, "a" * 20_000, "ab" * 2_000, " " * 3_000, "".join(random.Random(8).choices("etaoinshrdlu", k=30_000))]:
        assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids)


def test_whole_tokens_are_proved():
    path = public_tokenizers.path("byte_bpe_50k.json")
    counter, library = token_counts.counter(path), Tokenizer.from_file(path)
    assert len(counter.whole) > 40_000
    for token in random.Random(6).sample(sorted(counter.whole), 2_000):
        if len(pretokens.split(token)) == 1:
            assert len(library.encode(token, add_special_tokens=False).ids) == 1


def test_count_query(spark, sf_dir):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    documents = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op6_token_counts"](spark, sf_dir).collect()
    assert len(rows) == len(documents)
    for row in rows:
        n = len(library.encode(documents[row.doc_id], add_special_tokens=False).ids)
        assert (row.n_bytes, row.n_tokens, row.over_limit) == (len(documents[row.doc_id].encode()), n, n > 1024)


def test_count_of_odd_rows(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    df = spark.createDataFrame([(1, None, 5), (None, "", 6), (3, "x", 7), (3, "x", 7)], "doc_id long, text string, n_tokens int")
    assert sorted(r.n_tokens for r in token_counts.count(df, path).collect()) == [0, 0, 1, 1]
    assert token_counts.limits(df.limit(0), path).count() == 0
