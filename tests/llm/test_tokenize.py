import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tsumugi.llm.tokenize import TOKENIZER_DIR, bpe, encode_corpus

PATH = os.path.join(TOKENIZER_DIR, "byte_bpe_50k.json")
pytestmark = pytest.mark.skipif(not os.path.exists(PATH), reason="no vocabulary here")


@pytest.fixture(scope="module")
def library():
    t = pytest.importorskip("tokenizers").Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def ours(texts):
    ids, ends = bpe(PATH).encode(texts)
    return [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])]


CASES = ["", " ", "aaaaaaaaaaa", "I'll  don't 12345", "費用は59,647万円を見込み", "\n\n a\t b ", "<|endoftext|>", "😀é́ ½ Ⅷ ²", "\x1c\x1d x", "_a_ __", "a" * 5000, "㉈x", "﻿​"]


def test_equals_the_library(library):
    assert ours(CASES) == [e.ids for e in library.encode_batch(CASES, add_special_tokens=False)]


@settings(deadline=None, max_examples=80)
@given(st.lists(st.text(max_size=40), max_size=6))
def test_any_text_equals_the_library(texts):
    t = pytest.importorskip("tokenizers").Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    assert ours(texts) == [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("word_chars", [1, 10**6])
def test_corpus(spark, library, word_chars):
    rows = [(i, t, "x", "y") for i, t in enumerate([*CASES, None, CASES[4]])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids string, doc string")
    got = {r["doc_id"]: r["ids"] for r in encode_corpus(df, "doc_id", "text", word_chars=word_chars, out_rows=3).collect()}
    assert got == {i: library.encode(t or "", add_special_tokens=False).ids for i, t, *_ in rows}
    assert encode_corpus(df.limit(0), "doc_id", "text").count() == 0
