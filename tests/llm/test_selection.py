"""Near-duplicates, decontamination, mixing and sharding against brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from haulage.llm import decontam, mixing, neardup, sharding
from haulage.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def _documents(sf=SF):
    return duckdb.sql(f"SELECT doc_id, text, source FROM read_parquet('{sf}/documents.parquet')").fetchall()


def _shingles(text, size):
    words = (text or "").encode().lower().split()
    k = min(size, len(words))
    return frozenset(zip(*(words[i : len(words) - k + 1 + i] for i in range(k)))) if words else frozenset()


def _groups(rows, size, percent=80):
    sets = {i: _shingles(t, size) for i, t in rows}
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def _near_rows():
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(300)]
    rows, base = [], [" ".join(rng.choices(vocabulary, k=120)) for _ in range(12)]
    for text in base:
        chain = text.split()
        rows.append(text)
        for _ in range(6):  # a chain of small edits, whose ends are no longer alike
            at = rng.randrange(len(chain) - 4)
            chain[at : at + 2] = rng.choices(vocabulary, k=2)
            rows.append(" ".join(chain))
        rows += [text.upper(), "\n\t" + text.replace(" ", "  "), text + " " + " ".join(rng.choices(vocabulary, k=120))]
    rows += ["", None, "  \n", "one", "ONE", "one two", "one two three", "a b c d", "a b c d e", "a b c d e"]
    rows.append(" ".join(rng.choices(vocabulary, k=30_000)))
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_near_duplicates_match_brute_force(docs):
    rows = _near_rows()
    _, groups = neardup.near_duplicates(docs(rows), words=4)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in groups.collect()}
    assert got == _groups(rows, 4)


def test_one_of_each_group_stays(docs):
    rows = _near_rows()
    kept = {r["doc_id"] for r in neardup.drop_near_duplicates(docs(rows)).collect()}
    assert kept == {i for i, (_, root) in _groups(rows, 5).items() if i == root}


def test_near_duplicates_defined_cases(docs):
    text = " ".join(f"t{i}" for i in range(40))
    rows = [(None, text), (5, text), (5, text), (7, None), (None, None), (None, "")]
    kept = neardup.drop_near_duplicates(docs(rows))
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in kept.collect()) == [
        (False, 5, text), (False, 7, ""), (True, 0, ""), (True, 0, ""),
    ]
    assert neardup.drop_near_duplicates(docs([])).count() == 0


def test_band_and_posterior_settings():
    assert (1 - 0.8**neardup.ROWS) ** neardup.BANDS < 1e-6
    looks = neardup.least_matches()
    assert [n for n, _ in looks] == list(range(neardup.BATCH, neardup.HASHES + 1, neardup.BATCH))
    assert all(0 < m < 0.8 * n for n, m in looks)
    rng = np.random.default_rng(0)
    for n, m in looks[:3]:  # pairs at the threshold almost never fall under the bound
        assert (rng.binomial(n, 0.8, 200_000) < m).mean() < 1e-3


def test_near_dedup_query_matches_brute_force(spark):
    got = {r["doc_id"]: r for r in QUERIES["op2_near_dedup"](spark, SF).collect()}
    want = _groups([(i, t) for i, t, _ in _documents()], 4)
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == want
    assert all(r["kept"] == (i == r["component_id"]) for i, r in got.items())


def test_tiles_are_longest_first_and_disjoint():
    test = np.array([1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12], np.uint64)
    text = np.array([99, 7, 8, 9, 10, 11, 12, 50, 1, 2, 3, 4, 5, 6, 50, 1, 2, 3, 4, 5], np.uint64)
    tiles = decontam.greedy_tiles(test, text, 5)
    assert sorted(tiles) == [(0, 8, 6), (6, 1, 6)]
    assert decontam.greedy_tiles(test, text[::-1].copy(), 5) == []
    same = np.zeros(9, np.uint64)
    assert sum(t[2] for t in decontam.greedy_tiles(same, same, 5)) == 9
    assert decontam.greedy_tiles(test[:0], text, 5) == []


def test_decontamination_catches_reordered_passages(spark, docs):
    rng = random.Random(2)
    words = [f"v{i}" for i in range(4000)]
    item = rng.sample(words, 40)
    filler = lambda n: " ".join(rng.sample(words, n))
    rows = [
        (1, filler(300)),
        (2, filler(200) + " " + " ".join(item).upper() + ". " + filler(200)),
        (3, filler(50) + " " + " ".join(item[20:]) + " " + filler(50) + " " + ", ".join(item[:20])),
        (4, filler(50) + " " + " ".join(item[:10]) + " " + filler(50)),  # a quarter of the item
        (5, " ".join(item[i] for i in range(0, 40, 2))),  # its words, no passage
        (6, None), (7, ""), (8, "yes, it is so"), (8, "yes, it is so"), (None, " ".join(item)),
        (9, filler(4000) + " " + " ".join(item)),
        (12, filler(30) + " na" * 40),
    ]
    bench = spark.createDataFrame([(10, " ".join(item)), (11, None), (12, ""), (13, "It is SO"), (14, "na " * 40)], "item_id long, text string")
    numbered = decontam.number_rows(docs(rows))
    pairs = decontam.contaminated_pairs(numbered, bench).join(numbered.select("_rid", "doc_id"), "_rid")
    got = Counter((r["doc_id"], r["item_id"]) for r in pairs.collect())
    assert got == Counter({(2, 10): 1, (3, 10): 1, (9, 10): 1, (None, 10): 1, (8, 13): 2, (12, 14): 1})
    kept = decontam.decontaminate(docs(rows), bench)
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 4, 5, 6, 7]
    assert decontam.decontaminate(docs(rows), bench.limit(0)).count() == len(rows)
    assert decontam.decontaminate(docs([]), bench).count() == 0


def test_decontamination_query_finds_whole_items(spark):
    items = duckdb.sql(f"SELECT item_id, text FROM read_parquet('{SF}/benchmark.parquet')").fetchall()
    flat = lambda t: " " + " ".join(re.findall(r"\w+", (t or "").lower())) + " "
    want = {(d, i) for d, t, _ in _documents() for i, x in items if flat(x) in flat(t)}
    got = {(r["doc_id"], r["item_id"]) for r in QUERIES["op8_decontamination"](spark, SF).collect()}
    assert want and want <= got


def _fill(sizes, weights=(5, 2, 1)):
    """Water filling by rounds: share, cap, share the excess again."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    target, open_names, left = {}, set(names), sum(sizes.values())
    while open_names:
        level = left / sum(weight[s] for s in open_names)
        full = [s for s in open_names if 3 * sizes[s] <= weight[s] * level]
        if not full:
            target |= {s: weight[s] * level for s in open_names}
            break
        for s in full:
            target[s] = 3.0 * sizes[s]
            left -= 3 * sizes[s]
            open_names.discard(s)
    return target


def test_mix_reaches_its_targets(docs):
    rng = random.Random(9)
    rows = []
    for source, n in (("a", 3), ("b", 200), ("c", 5), (None, 40), ("e", 1)):
        rows += [(len(rows) + k, " ".join(["w"] * rng.randrange(0, 30)), "en", source) for k in range(n)]
    rows += [(None, "x y z", "en", "b"), (None, None, "en", "b"), (7, "same same", "en", "b"), (7, "same same", "en", "b")]
    got = mixing.mix_sources(docs(rows)).collect()
    assert len(got) == len(rows)
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in got:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    target = _fill(dict(sizes))
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(target[r["source"]])
    assert all(abs(taken[s] - target[s]) <= 2 for s in sizes)
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix_sources(docs(rows)).collect()))
    assert mixing.mix_sources(docs([])).count() == 0
    assert {r["taken"] for r in mixing.mix_sources(docs([(1, "", "en", "a"), (2, None, "en", "b")])).collect()} == {0}


def test_applied_mix_repeats_documents(docs):
    rows = [(i, "w " * 10, "en", "a" if i < 2 else "b") for i in range(60)]
    plan = {r["doc_id"]: r["copies"] for r in mixing.mix_sources(docs(rows)).collect()}
    mixed = mixing.apply_mix(docs(rows))
    assert mixed.columns == docs(rows).columns
    assert Counter(r["doc_id"] for r in mixed.collect()) == Counter({i: c for i, c in plan.items() if c})


def test_mixing_query_matches_sql(spark):
    df = QUERIES["op10_mixing"](spark, SF)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    cur = con.execute(ORACLES["op10_mixing"])
    assert df.columns == [d[0] for d in cur.description]
    assert sorted(map(tuple, df.collect())) == sorted(cur.fetchall())


def test_shards_move_only_to_the_new_one_and_follow_weights(spark):
    keys = spark.range(20_000).selectExpr("id AS doc_id", "cast(id AS string) AS text", "'x' AS shard")
    weights = [1.0, 2.0, 1.0]
    rows = sharding.assign_shards(keys, weights).collect()
    share = Counter(r["shard"] for r in rows)
    assert share[1] / len(rows) == pytest.approx(0.5, abs=0.02)
    moved = [r for r in rows if r["grown_shard"] != r["shard"]]
    assert {r["grown_shard"] for r in moved} == {3} and len(moved) / len(rows) == pytest.approx(0.2, abs=0.02)
    again = {r["doc_id"]: r["shard"] for r in sharding.assign_shards(keys, [*weights, 1.0]).collect()}
    assert all(again[r["doc_id"]] == r["grown_shard"] for r in rows)
    with pytest.raises(ValueError):
        sharding.assign_shards(keys, [])


def test_slots_are_gapless(docs):
    rows = [(i % 150, f"text {i} é") for i in range(300)] + [(None, None), (None, "x"), (None, "x"), (3, "")]
    got = sharding.shard_slots(docs(rows), [1.0] * 5).collect()
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and len(got) == len(rows)
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    by_id = defaultdict(set)
    for r in got:
        if r["doc_id"] is not None:
            by_id[r["doc_id"]].add(r["shard"])
    assert all(len(s) == 1 for s in by_id.values())
    assert sharding.shard_slots(docs([]), [1.0]).count() == 0
