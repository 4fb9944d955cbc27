"""The corpus pipeline's stages, one after the other, against brute-force versions of each."""

import re
from collections import Counter

import duckdb

import corpus_pipeline
from haulage.llm import mixing

from test_selection import SF, _groups  # noqa: E402


def test_stages_and_columns(spark, docs):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontamination", "source_mix", "sharding"]
    empty = docs([])
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, empty, SF)
        assert out.count() == 0 and out.columns[:5] == list(corpus_pipeline.COLUMNS), name


def test_run_matches_stage_by_stage(spark):
    rows = duckdb.sql(f"SELECT doc_id, text, source FROM read_parquet('{SF}/documents.parquet')").fetchall()
    items = duckdb.sql(f"SELECT text FROM read_parquet('{SF}/benchmark.parquet')").fetchall()
    flat = lambda t: " " + " ".join(re.findall(r"\w+", t.lower())) + " "
    kept = [r for r in rows if r[1] and re.search(r"[^\W\d_]", r[1])]
    groups = _groups([(i, t) for i, t, _ in kept], 5)
    kept = [r for r in kept if groups[r[0]][1] == r[0]]
    kept = [r for r in kept if not any(flat(x) in flat(r[1]) for (x,) in items)]
    out = corpus_pipeline.run(spark, SF).collect()
    clean = spark.createDataFrame([(i, t, s) for i, t, s in kept], "doc_id long, text string, source string")
    plan = {r["doc_id"]: r["copies"] for r in mixing.mix_sources(clean).collect()}
    assert Counter(r["doc_id"] for r in out) == Counter({i: c for i, c in plan.items() if c})
    texts = {i: t for i, t, _ in rows}
    assert all(r["text"] == texts[r["doc_id"]] and 0 <= r["shard"] < 24 for r in out)


def test_stages_survive_odd_rows(spark, docs):
    rows = [(None, None), (1, ""), (1, "12 34"), (2, "a b c", "en", None), (2, "a b c", "en", None), (3, "word " * 20_000, None, "s")]
    df = docs(rows)
    for _, stage in corpus_pipeline.STAGES:
        df = stage(spark, df, SF)
    assert {r["doc_id"] for r in df.collect()} <= {2, 3}


def test_language_stage_rejects_what_the_model_cannot_place(spark, docs):
    import random

    rng = random.Random(7)
    table = duckdb.sql("SELECT doc_id, text, lang FROM read_parquet('/root/testdata/sf0.01/documents.parquet')").fetchall()
    odd = {
        -1: "привет мир " * 20,
        -2: "これは日本語の文章です",
        -3: " ".join("".join(rng.choice("bcdfghjklmnpqrstvwxz") for _ in range(8)) for _ in range(40)),
        -4: "12 34 !", -5: "", -6: None,
    }
    kept = {r["doc_id"] for r in corpus_pipeline.language_id(spark, docs([*table, *((i, t) for i, t in odd.items())]), SF).collect()}
    clean = {i for i, t, _ in table if t and re.search(r"[^\W\d_]", t)}
    assert kept == clean and len({lang for i, _, lang in table if i in kept}) >= 4
    unlabelled = docs([(1, "some words"), (2, "\u043f\u0440\u0438\u0432\u0435\u0442"), (3, "12")])
    assert {r["doc_id"] for r in corpus_pipeline.language_id(spark, unlabelled, SF).collect()} == {1, 2}
