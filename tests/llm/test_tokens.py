import random

import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from folium.llm import tokens
from folium.session import table
from tests.conftest import SMALL, TINY

ENC = tokens.ForcedCutEncoder(tokens.vocabulary_path())
REF = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
REF.encode_special_tokens = True


def ref(t):
    return REF.encode(t, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80))
def test_any_text(t):
    assert ENC.encode(t) == ref(t)


@pytest.mark.parametrize("t", ["", " ", "  a", "a\n\n b", "<|endoftext|>", "it's 'll", "x" * 5000, "ab" * 3000, "中文" * 2000, "  \n" * 300, "😀👩‍🔧", "ไม่มีช่องว่าง" * 200, "é", "1" * 700])
def test_cases(t):
    assert ENC.encode(t) == ref(t)


def test_long_merges_equal_short_ones():
    rng = random.Random(4)
    for _ in range(200):
        b = "".join(rng.choice("abest ing") for _ in range(rng.randrange(2, 48))).encode()
        assert ENC.merge(b) == ENC._merge_long(b) or b in ENC.ranks


def test_cuts_are_in_no_token():
    for part in ("żółć ünï", "日本語テキスト", "नमस्ते"):
        for w in ENC.words.findall(part):
            assert b"".join(ENC.fragments(w.encode())) == w.encode()


def test_documents_and_counts(spark):
    d = table(spark, SMALL, "documents")
    got = {r["doc_id"]: r["ids"] for r in tokens.encode_documents(d).collect()}
    assert len(got) == d.count()
    assert all(got[r["doc_id"]] == (ref(r["text"]) if r["text"] else []) for r in d.select("doc_id", "text").collect())
    n = {r["doc_id"]: r["n_tokens"] for r in tokens.count_tokens(d).collect()}
    assert n == {k: len(v) for k, v in got.items()}


def test_edges(spark):
    d = spark.createDataFrame([(1, None, "q"), (1, None, "q"), (None, "a", "x"), (2, "", "y")], "doc_id long, text string, ids string")
    assert sorted([tuple(r) for r in tokens.encode_documents(d).collect()], key=repr) == sorted([(1, []), (1, []), (None, ref("a")), (2, [])], key=repr)
    assert tokens.encode_documents(d.limit(0)).isEmpty()
    assert table(spark, TINY, "documents").count() == tokens.encode_documents(table(spark, TINY, "documents")).count()
