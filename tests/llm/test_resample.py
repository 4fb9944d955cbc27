"""Importance resampling: vectorised checksums against zlib, whole results against a plain version."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from haulage.llm import resample
from haulage.llm.queries import op11_importance_resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def features(text):
    words = WORD.findall((text or "").translate(LOWER))
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def plain(docs, bench, share=25):
    """[(doc_id, text)], [text] -> rows (doc_id, n_features, weight, score, rank)."""
    bucket = lambda f: zlib.crc32(f.encode()) % 10000
    s = Counter(bucket(f) for _, t in docs for f in features(t)[1])
    t = Counter(bucket(f) for x in bench for f in features(x)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = [
        math.floor(1000 * math.log((t[b] + 1) * (S + 10000.0) / ((s[b] + 1) * (T + 10000.0)))) for b in range(10000)
    ]
    rows = []
    for doc_id, text in docs:
        words, found = features(text)
        weight = sum(gain[bucket(f)] for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((doc_id, len(found), weight, score, len(words) >= 20))
    able = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    ranks = {}
    for k, r in enumerate(able[: share * len(able) // 100]):
        ranks.setdefault(r, []).append(k + 1)
    return [(*r[:4], ranks[r].pop(0) if ranks.get(r) else None) for r in rows]


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r))


def test_checksums_of_overlapping_spans_of_any_length():
    rng = np.random.default_rng(3)
    data = rng.integers(0, 256, 40_000).astype(np.uint8)
    size = np.concatenate([np.arange(0, 200), [4096, 8191, 8192, 8193, 20_000, 40_000], rng.integers(1, 70, 3000)])
    start = np.array([int(rng.integers(0, len(data) - n + 1)) for n in size])
    got = resample.crc32_spans(data, start, start + size)
    raw = data.tobytes()
    assert got.tolist() == [zlib.crc32(raw[a : a + n]) for a, n in zip(start, size)]


TEXTS = [
    None, "", " .,;", "one", "One TWO\tthree--two", "naïve ÉTÉ été 日本語 日本 x", "a" * 1000 + " " + "é" * 700 + "-b",
    "\x00\x7fA\x80b c", "0 1:2;3@4[5`6{7 8", "x " * 500,
]


@pytest.mark.parametrize("block", [1 << 20, 64, 7])
def test_buckets_of_every_feature(monkeypatch, block):
    monkeypatch.setattr(resample, "BLOCK", block)
    texts = [t or "" for t in TEXTS]
    column = pa.array(["cut off", *texts])[1:]  # a slice has an offset of its own
    words, found = Counter(), [Counter() for _ in texts]
    for row, some, owner, buckets in resample.featured(column, 2, 10000):
        for i, n in enumerate(some):
            words[row + i] += int(n)
        for o, b in zip(owner, buckets):
            found[row + o][int(b)] += 1
    for i, t in enumerate(texts):
        want, runs = features(t)
        assert words[i] == len(want)
        assert found[i] == Counter(zlib.crc32(f.encode()) % 10000 for f in runs)


def test_results_equal_a_plain_version(spark, docs):
    rng = np.random.default_rng(4)
    vocabulary = ["alpha", "Beta", "gamma", "δέλτα", "eps1", "zeta", "eta", "theta"]
    rows = [(i, " ".join(rng.choice(vocabulary, int(rng.integers(0, 60))))) for i in range(150)]
    rows += [(500 + i, t) for i, t in enumerate(TEXTS)]
    rows += [(3, rows[3][1])] * 40 + [(7, rows[8][1]), (None, rows[8][1]), (None, rows[9][1]), (None, None)]
    bench = ["alpha beta alpha beta", "theta eta", None, ""]
    target = spark.createDataFrame([(i, t) for i, t in enumerate(bench)], "item_id long, text string")
    out = resample.resample(docs(rows), target).select("doc_id", "n_features", "weight", "score", "rank")
    assert ordered(map(tuple, out.collect())) == ordered(plain(rows, bench))


def test_empty_tables(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert resample.resample(docs([]).limit(0), none).count() == 0
    rows = [(i, "same words " * 15) for i in range(9)]
    out = resample.resample(docs(rows), none).select("doc_id", "n_features", "weight", "score", "rank")
    assert ordered(map(tuple, out.collect())) == ordered(plain(rows, []))


def test_query_on_the_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    bench = [r["text"] for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    got = [tuple(r) for r in op11_importance_resampling(spark, sf).collect()]
    assert ordered(got) == ordered(plain(docs, bench))
    assert sorted(r[4] for r in got if r[4] is not None) == list(range(1, sum(r[4] is not None for r in got) + 1))
