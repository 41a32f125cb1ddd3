"""Encoding equals two public libraries on real and on hard texts, and decodes to the text."""

import random

import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from landchange.llm import tokens as T

JSON = T.TOKENIZER_FILE.replace(".tiktoken", ".json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(JSON)
    t.encode_special_tokens = True
    return lambda texts: [x.ids for x in t.encode_batch(texts, add_special_tokens=False)]


@pytest.fixture(scope="module")
def encoder():
    return T.Encoder(T.load_ranks(T.TOKENIZER_FILE))


def test_random_texts(library, encoder):
    rnd = random.Random(2)
    alphabet = "'''stmdrevel  \n\t\xa0　aZé9²٣!?—漢字😀\x1c\x85​́ x"
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 30))) for _ in range(5000)]
    assert encoder.encode(texts) == library(texts)


@given(st.lists(st.text(), max_size=6))
@settings(max_examples=200, deadline=None)
def test_any_text(library, encoder, texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    assert encoder.encode(texts) == library(texts)


def test_every_code_point(library, encoder):
    texts = ["".join(f"x{chr(k)} {chr(k)}'s" for k in range(a, min(a + 2000, 0x110000)) if not 0xD800 <= k < 0xE000) for a in range(0, 0x110000, 2000)]
    assert encoder.encode(texts) == library(texts)


def test_long_and_special(library, encoder):
    texts = ["a" * 200_000, "<|endoftext|>", " " * 50_000, "word " * 50_000, "\n" * 9 + "x"]
    assert encoder.encode(texts) == library(texts)


def test_documents(spark, data, library):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text")
    got = {r.doc_id: (r.ids, r.ends) for r in T.encode(docs, "doc_id", "text", offsets=True).collect()}
    rows = docs.collect()
    assert [got[r.doc_id][0] for r in rows] == library([r.text or "" for r in rows])
    assert all((got[r.doc_id][1] or [0])[-1] == len((r.text or "").encode()) for r in rows)
    back = {r.doc_id: r.text for r in T.decode(T.encode(docs, "doc_id", "text"), "doc_id").collect()}
    assert all(back[r.doc_id] == (r.text or "") for r in rows)
    counts = {r.doc_id: r.tokens for r in T.token_counts(docs, "doc_id", "text").collect()}
    assert all(counts[r.doc_id] == len(got[r.doc_id][0]) for r in rows)


def test_odd_rows(spark):
    rows = spark.createDataFrame([(1, None, 1), (2, "", 1), (2, "", 1), (None, "x", 1)], "doc_id BIGINT, text STRING, ids INT")
    assert sorted((r.doc_id or 0, len(r.ids)) for r in T.encode(rows, "doc_id", "text").collect()) == [(0, 1), (1, 0), (2, 0), (2, 0)]
    assert T.encode(rows.limit(0), "doc_id", "text").count() == 0
