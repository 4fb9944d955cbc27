"""Token counts: spliced and remembered counts against the library's count of whole texts."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from haulage.llm import tokens
from haulage.llm.queries import op12_token_counts

PATH = public_tokenizers.path(tokens.VOCABULARY)
JSON = open(PATH, encoding="utf-8").read()
WHOLE = Tokenizer.from_str(JSON)

PIECES = [
    "hello", " ", "\n\n", "\t", "wörld", "é", "́", "'s", "'S", "'", "'rex", "n't", "12", "3", "٣", "日本語",
    "<|endoftext|>", "<|startoftext|>", "<|", "|>", "|", "endoftext", "!?", "...", " ", " ", "\x1c", "\x85",
    "Å", "İ", "ΣΑΣ", "ﬁ", "👩‍👩‍👧", "≠", "≮", "가", "x" * 40, "a-b", "A1b2", "\x00", "﻿",
]


def whole(text):
    return len(WHOLE.encode(text or "", add_special_tokens=False))


def mixed(seed, n):
    rng = random.Random(seed)
    return "".join(rng.choice(PIECES) for _ in range(n))


@pytest.mark.parametrize("seed", range(25))
def test_spliced_chunks_count_as_the_whole(seed):
    rng = random.Random(seed)
    text = mixed(seed, rng.randint(50, 600))
    counter = tokens.Counter(JSON, chunk=rng.randint(20, 200), overlap=rng.randint(2, 40))
    assert counter.count_long(text) == whole(text)


@pytest.mark.parametrize(
    "text",
    ["a" * 700, "日" * 900, "é" * 500 + " x", "!" * 800, "<|endoftext|>" * 60, "ab|" * 300, "é" * 400, " " * 900, "7" * 500],
    ids=str.__len__,
)
def test_texts_without_a_proven_place_widen_up_to_the_whole(text):
    assert tokens.Counter(JSON, chunk=64, overlap=8).count_long(text) == whole(text)


def test_proven_places_split_every_text():
    for seed in range(300):
        text = mixed(seed, 40)
        total = whole(text)
        for at in range(1, len(text)):
            if tokens.proven(text, at):
                assert whole(text[:at]) + whole(text[at:]) == total, (text, at)


def test_remembered_stretches_count_as_the_whole(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 30)
    counter = tokens.Counter(JSON)
    texts = [mixed(seed, 80) for seed in range(120)] + ["", " ", "\x0b\x0c"]
    for at in range(0, len(texts), 10):
        assert counter.count_batch(texts[at : at + 10]) == [whole(t) for t in texts[at : at + 10]]


def test_other_vocabularies_are_encoded_whole():
    json = open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read()
    counter = tokens.Counter(json, chunk=50, overlap=5)
    text = mixed(1, 300)
    assert not counter.spliced
    assert counter.count_batch([text]) == [len(Tokenizer.from_str(json).encode(text, add_special_tokens=False))]


def test_rows_of_every_kind(spark, docs):
    long = mixed(5, 20_000)
    rows = [(1, None), (2, ""), (3, "two words"), (3, "two words"), (None, "x <|endoftext|> y"), (4, long), (5, "a" * 70_000)]
    out = tokens.count_tokens(docs(rows), limit=100).collect()
    want = [(i, len((t or "").encode()), whole(t), whole(t) > 100) for i, t in rows]
    assert sorted(map(str, map(tuple, out))) == sorted(map(str, want))
    assert tokens.count_tokens(docs([]).limit(0)).count() == 0


def test_query_on_the_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = sorted((r["doc_id"], len(r["text"].encode()), whole(r["text"]), whole(r["text"]) > 2048) for r in docs)
    assert sorted(map(tuple, op12_token_counts(spark, sf).collect())) == want
