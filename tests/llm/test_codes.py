"""Vector codes: the transform, the exact search, and whole codebooks against a plain integer version."""

import math

import numpy as np
import pytest

from haulage.llm import codes
from haulage.llm.queries import op13_vector_codes


def plain(rows, parts=4, entries=256, rounds=4):
    """(vec_id, label, vector) -> per row (vec_id, code, error, label), and the codebooks; Python integers only."""
    kept = [r for r in rows if r[2] is not None and all(x is not None and math.isfinite(x) for x in r[2])]
    whole = [(i, lab, [math.floor(1024 * x) for x in v]) for i, lab, v in kept]
    width = len(whole[0][2]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, _, v in whole]
    order = sorted(range(len(whole)), key=lambda k: whole[k][0])[:entries]
    books = [[cut[k][p] for k in order] for p in range(parts)]

    def near(x, book):
        gaps = [sum((a - b) ** 2 for a, b in zip(x, e)) for e in book]
        best = min(gaps)
        return gaps.index(best), best

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for c in cut:
                groups.setdefault(near(c[p], books[p])[0], []).append(c[p])
            books[p] = [
                [sum(col) // len(groups[e]) for col in zip(*groups[e])] if e in groups else books[p][e]
                for e in range(len(books[p]))
            ]
    out = []
    for (i, lab, _), c in zip(whole, cut):
        found = [near(c[p], books[p]) for p in range(parts)]
        out.append((i, "".join(f"{e:02x}" for e, _ in found), sum(g for _, g in found), lab))
    return out, np.array(books)


SCHEMA = "vec_id long, label int, embedding array<float>, code string, slot int"


def frame(spark, rows):
    return spark.createDataFrame([(i, lab, v, "x", 1) for i, lab, v in rows], SCHEMA)


def vectors(n, width=16, seed=0):
    rng = np.random.default_rng(seed)
    return [(i, int(rng.integers(3)) if i % 5 else None, [float(np.float32(x)) for x in rng.normal(0, 0.3, width)]) for i in range(n)]


@pytest.mark.parametrize("width", [1, 2, 4, 16, 32])
def test_transform_scales_distances_and_orders_by_sign_changes(width):
    rows = codes.hadamard(np.eye(width, dtype=np.int64))[:, codes.sequency_order(width)].T
    assert [int((np.diff(r) != 0).sum()) for r in rows] == list(range(width))
    rng = np.random.default_rng(1)
    a, b = rng.integers(-99, 99, (2, 5, width))
    gap = codes.transform(a) - codes.transform(b)
    assert ((gap * gap).sum(1) == width * ((a - b) ** 2).sum(1)).all()


@pytest.mark.parametrize("width,spread", [(3, 2), (16, 3), (16, 10**6), (5, 10**11)])
def test_search_is_exact_with_ties_to_the_lower_entry(width, spread):
    rng = np.random.default_rng(2)
    parts = rng.integers(-spread, spread, (300, width))
    book = rng.integers(-spread, spread, (40, width))
    book[7] = book[3]
    found, gaps = codes.assign(parts, book)
    for x, e, g in zip(parts.tolist(), found, gaps):
        every = [sum((p - q) ** 2 for p, q in zip(x, b)) for b in book.tolist()]
        assert (every.index(min(every)), min(every)) == (e, int(g))


@pytest.mark.parametrize("entries,width", [(256, 16), (8, 12)])
def test_codes_equal_a_plain_version(spark, entries, width):
    rows = vectors(330, width)
    rows += [(400, 1, rows[0][2]), (401, 1, rows[0][2]), (2, None, rows[9][2])]  # copies and a repeated id
    rows += [(-1, 0, None), (-2, 0, [float("nan")] + [0.0] * (width - 1)), (-3, 0, [float("inf")] * width), (-4, 0, [None] * width)]
    coded, books = codes.compress(frame(spark, rows), entries=entries)
    got = [(r["vec_id"], r["code"], r["error"], r["label"]) for r in coded.collect()]
    # A repeated id among the seeds is ordered by its vector, as the plain version's rows are.
    ordered = sorted([r for r in rows if r[2] is not None], key=lambda r: (r[0], [x if x is not None else 0 for x in r[2]]))
    want, want_books = plain(ordered, entries=entries)
    key = lambda r: (r[0], r[1], r[2], str(r[3]))
    assert sorted(got, key=key) == sorted(want, key=key)
    assert (books == want_books).all()


def test_label_errors_sum_over_equal_labels_with_nulls_together(spark):
    rows = vectors(60)
    coded, _ = codes.compress(frame(spark, rows), entries=4)
    out = codes.with_label_error(coded).collect()
    sums = {}
    for r in out:
        sums[r["label"]] = sums.get(r["label"], 0) + r["error"]
    assert len(out) == 60 and None in sums
    assert all(r["label_error"] == sums[r["label"]] for r in out)


def test_edges(spark):
    empty, books = codes.compress(frame(spark, []))
    assert empty.count() == 0 and codes.digest(books) == codes.digest(np.zeros(0))
    same = [(i, 1, [0.5] * 8) for i in range(20)] + [(None, None, [0.25] * 8), (50, 2, [1.0] * 3), (51, 2, [])]
    coded, _ = codes.compress(frame(spark, same))
    got = {r["vec_id"]: (r["code"], r["error"]) for r in coded.collect()}
    assert got[0] == got[19] == ("00000000", 0) and got[None][1] == 0
    assert got[50] == (None, None) and got[51] == (None, None)
    padded, books = codes.compress(frame(spark, [(i, 0, [i / 8.0] * 6) for i in range(5)]))
    assert books.shape == (4, 5, 2) and {r["error"] for r in padded.collect()} == {0}
    huge, _ = codes.compress(frame(spark, [(0, 0, [3e38] * 4), (1, 0, [-3e38] * 4), (2, 0, [3e9] * 4)]), entries=1)
    assert codes.with_label_error(huge).where("label_error > 0").count() == 3
    lone, _ = codes.compress(frame(spark, [(0, 0, []), (1, 0, [])]))
    assert [tuple(r)[2:] for r in lone.collect()] == [("00000000", 0)] * 2


def test_query_gives_every_usable_row(spark):
    out = op13_vector_codes(spark, "/root/testdata/sf0.001")
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r["vec_id"], r["label"], list(r["embedding"])) for r in table.collect()]
    want, books = plain(rows)
    got = out.collect()
    assert sorted((r["vec_id"], r["code"], r["error"]) for r in got) == sorted(w[:3] for w in want)
    assert {r["codebooks_sha256"] for r in got} == {codes.digest(books)}
