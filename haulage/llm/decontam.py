"""Benchmark decontamination by greedy string tiling."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulage.llm.common import scratch_table

TOKEN = re.compile(r"\w+")
TILE = 5  # shortest tile, in tokens; also the length of a seed
COVER = 0.5  # least share of a test item's tokens under tiles
FILTER_BITS = 1 << 20  # of the seed filter that is broadcast, whatever the benchmark's size
CACHE = 500_000

_BASE = np.uint64(0x9E3779B97F4A7C15)


def tokens_of(text: str | None) -> list[str]:
    """Lower-case runs of word characters: case and punctuation do not hide a passage."""
    return TOKEN.findall(text.lower()) if text else []


class _Tokens:
    """Token hashes of texts, with a bounded cache over blank-separated pieces."""

    def __init__(self):
        self.cache: dict[str, tuple[int, ...]] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, np.uint64)
        if len(self.cache) > CACHE:
            self.cache.clear()
        cache, out = self.cache, []
        for piece in text.lower().split():
            found = cache.get(piece)
            if found is None:
                found = cache[piece] = tuple(xxhash.xxh3_64_intdigest(t) for t in TOKEN.findall(piece))
            out += found
        return np.array(out, np.uint64)


def rolling(ids: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin hashes (mod 2**64) of all windows of ``length`` tokens."""
    n = len(ids) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k in range(length):
        total = total * _BASE + ids[k : k + n]
    total = (total ^ (total >> np.uint64(32))) * _BASE
    return total ^ (total >> np.uint64(29))


def greedy_tiles(test: np.ndarray, text: np.ndarray, shortest: int = TILE) -> list[tuple[int, int, int]]:
    """Maximal tiles ``(test start, text start, length)``, longest first, none sharing a token on either side.

    Running Karp-Rabin: windows of the current search length over unmarked
    tokens are matched by their hashes; if some match runs further, the length
    found becomes the search length; matches of that length are marked where
    still free; then the length shrinks.  Ties go to the earlier place.
    """
    free_a, free_b = np.ones(len(test), bool), np.ones(len(text), bool)
    tiles: list[tuple[int, int, int]] = []
    shortest = min(shortest, len(test))
    if not shortest:
        return tiles

    def matches(length: int) -> list[tuple[int, int]]:
        def windows(ids, free):
            marked = np.r_[0, np.cumsum(~free)]
            clear = np.flatnonzero(marked[length:] == marked[:-length])
            return clear, rolling(ids, length)[clear]

        if min(len(test), len(text)) < length:
            return []
        at_a, hash_a = windows(test, free_a)
        at_b, hash_b = windows(text, free_b)
        common = np.isin(hash_b, hash_a)
        where = defaultdict(list)
        for i, h in zip(at_b[common], hash_b[common]):
            where[h].append(i)
        return [(int(i), int(j)) for i, h in zip(at_a, hash_a) for j in where.get(h, ())]

    def runs(i: int, j: int, length: int) -> bool:
        return bool((test[i : i + length] == text[j : j + length]).all())

    # The longest match still free: lengths are monotone, so a binary search over Karp-Rabin passes finds it.
    while True:
        low, high, found = shortest, min(int(free_a.sum()), int(free_b.sum())), []
        if high < low or not (found := [m for m in matches(low) if runs(*m, low)]):
            return tiles
        best = low
        while low < high:
            middle = (low + high + 1) // 2
            got = [m for m in matches(middle) if runs(*m, middle)]
            if got:
                low, found, best = middle, got, middle
            else:
                high = middle - 1
        for i, j in found:
            if free_a[i : i + best].all() and free_b[j : j + best].all():
                free_a[i : i + best] = False
                free_b[j : j + best] = False
                tiles.append((i, j, best))


def _item_seeds(shortest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = _Tokens()
        for batch in batches:
            items, sizes, lens, seeds, places = [], [], [], [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = hashed(text)
                k = min(shortest, len(ids))
                own, counts = np.unique(rolling(ids, k) if k else ids, return_counts=True)
                items += [item] * len(own)
                sizes += [len(ids)] * len(own)
                lens += [k] * len(own)
                seeds += own.view(np.int64).tolist()
                places += counts.tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(items, pa.int64()), pa.array(sizes, pa.int64()), pa.array(lens, pa.int32()), pa.array(seeds, pa.int64()), pa.array(places, pa.int64())],
                names=["item", "item_tokens", "len", "seed", "places"],
            )

    return run


def _text_seeds(lengths: list[int], bits_ref):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed, bits = _Tokens(), bits_ref.value
        for batch in batches:
            rids, lens, seeds = [], [], []
            for rid, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = hashed(text.as_py())
                for k in lengths:
                    windows = rolling(ids, k)
                    hit = np.unique(windows[bits[(windows % np.uint64(FILTER_BITS)).astype(np.int64)]]).view(np.int64)
                    rids += [rid] * len(hit)
                    lens += [k] * len(hit)
                    seeds += hit.tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(rids, pa.int64()), pa.array(lens, pa.int32()), pa.array(seeds, pa.int64())],
                names=["rid", "len", "seed"],
            )

    return run


def _tile(shortest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = _Tokens()
        for batch in batches:
            covered, longest, count = [], [], []
            for item, text in zip(batch.column(2), batch.column(3)):
                tiles = greedy_tiles(hashed(item.as_py()), hashed(text.as_py()), shortest)
                covered.append(sum(t[2] for t in tiles))
                longest.append(max((t[2] for t in tiles), default=0))
                count.append(len(tiles))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(covered, pa.int64()),
                    pa.array(longest, pa.int64()),
                    pa.array(count, pa.int64()),
                ],
                names=["rid", "item", "covered", "longest", "tiles"],
            )

    return run


def number_rows(docs: DataFrame) -> DataFrame:
    return scratch_table(docs.withColumn("_rid", F.monotonically_increasing_id()), "numbered")


def contaminated_pairs(
    rows: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    shortest: int = TILE,
    cover: float = COVER,
) -> DataFrame:
    """``_rid, item_row, item_id, item_tokens, covered, coverage, longest, tiles`` for every contaminated pair.

    ``rows`` must hold a stable ``_rid`` (``number_rows``).  A document is
    contaminated by a test item if tiles of at least ``shortest`` tokens, in
    any order, cover at least ``cover`` of the item's tokens; an item shorter
    than that must occur whole.

    Seeds are windows of ``shortest`` tokens.  Those of the benchmark set bits
    in a filter of fixed size that is broadcast; a document's seeds that pass
    the filter are joined exactly.  A pair goes on to tiling only if its shared
    seeds could cover enough (each of a seed's places in the item covers at most
    ``shortest`` tokens), which drops no pair that tiling would accept.

    Defined cases: null and empty texts and items without a token match
    nothing; repeated items and documents are judged row by row; an empty
    benchmark or an empty table gives no rows.
    """
    sc = rows.sparkSession.sparkContext
    items = scratch_table(
        benchmark.select(
            F.monotonically_increasing_id().alias("item"), F.col(item_col).alias("item_id"), F.col(item_text_col).alias("item_text")
        ),
        "items",
    )
    seeds = scratch_table(
        items.select("item", "item_text").mapInArrow(
            _item_seeds(shortest), "item long, item_tokens long, len int, seed long, places long"
        ),
        "item-seeds",
    )
    lengths = sorted(r["len"] for r in seeds.select("len").distinct().collect())  # at most ``shortest`` values
    bits = np.zeros(FILTER_BITS, bool)
    # At most FILTER_BITS distinct values come back, whatever the benchmark's size.
    for r in seeds.select(F.expr(f"cast(seed & {FILTER_BITS - 1} as int)").alias("bit")).distinct().toLocalIterator():
        bits[r["bit"]] = True
    texts = rows.select(F.col("_rid").alias("rid"), F.col(text_col).alias("text"))
    found = texts.mapInArrow(_text_seeds(lengths, sc.broadcast(bits)), "rid long, len int, seed long")
    shared = (
        found.join(seeds, ["len", "seed"])
        .groupBy("rid", "item")
        .agg(F.sum("places").alias("shared"), F.first("item_tokens").alias("item_tokens"))
        .where(F.col("shared") * F.lit(shortest) >= F.lit(cover) * F.col("item_tokens"))
    )
    pairs = scratch_table(shared.select("rid", "item", "item_tokens"), "tile-pairs")
    tiled = (
        pairs.join(texts, "rid")
        .join(items.select("item", "item_text"), "item")
        .select("rid", "item", "item_text", "text")
        .mapInArrow(_tile(shortest), "rid long, item long, covered long, longest long, tiles long")
    )
    return (
        tiled.join(pairs, ["rid", "item"])
        .join(items.select("item", "item_id"), "item")
        .where(F.col("covered") >= F.lit(cover) * F.col("item_tokens"))
        .select(
            F.col("rid").alias("_rid"),
            F.col("item").alias("item_row"),
            "item_id",
            "item_tokens",
            "covered",
            (F.col("covered") / F.col("item_tokens")).alias("coverage"),
            "longest",
            "tiles",
        )
    )


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", shortest: int = TILE, cover: float = COVER
) -> DataFrame:
    """``docs`` without the contaminated documents; all columns and all other rows stay."""
    rows = number_rows(docs)
    bad = contaminated_pairs(rows, benchmark, text_col, shortest=shortest, cover=cover).select("_rid").distinct()
    return rows.join(bad, "_rid", "left_anti").drop("_rid")
