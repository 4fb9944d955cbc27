"""Near-duplicate groups: MinHash bands, sequential Bayesian pruning, exact verification, components.

Work is done on classes of documents with equal shingle sets, so copies cost
one row each and never meet in pairs.  Bands propose pairs of classes, a
Bayesian test compares their signatures batch by batch, and what survives is
confirmed on the full shingle sets of the whole texts.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from haulage.llm.common import scratch_table

WORDS = 5  # words in a shingle
PERCENT = 80  # least Jaccard similarity, in hundredths
BANDS, ROWS = 48, 6  # a pair at 0.8 shares no band with probability (1 - 0.8**6)**48 = 5e-7
# Signatures keep a byte of each value: chance agreement only raises the matches, so no link is dropped for it.
BATCH = 32  # signature values compared between two looks at the posterior
MISS = 1e-6  # posterior probability of a link below which a pair is dropped
WORD_CACHE = 500_000

HASHES = BANDS * ROWS
_RANDOM = np.random.Generator(np.random.PCG64(20_25))
_XOR = _RANDOM.integers(0, 2**32, HASHES, np.uint32)
_MUL = _RANDOM.integers(0, 2**31, HASHES, np.uint32) * np.uint32(2) + np.uint32(1)
_BAND_MUL = _RANDOM.integers(0, 2**62, ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _RANDOM.integers(0, 2**62, 64, np.uint64) * np.uint64(2) + np.uint64(1)
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[bytes]:
    """Words of the whole text: A-Z lower-cased, cut at ``[\\x20\\x09-\\x0D]+`` (just what bytes do)."""
    return text.encode("utf-8", "replace").lower().split()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _GOLDEN
    return x ^ (x >> np.uint64(29))


class ShingleHasher:
    """Distinct 64-bit shingle hashes of a text, with a bounded cache of word hashes."""

    def __init__(self, size: int):
        self.size = size
        self.cache: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = words_of(text or "")
        if not words:
            return np.zeros(0, np.uint64)
        if len(self.cache) > WORD_CACHE:
            self.cache.clear()
        cache = self.cache
        for w in words:
            if w not in cache:
                cache[w] = xxhash.xxh3_64_intdigest(w)
        ids = np.array([cache[w] for w in words], np.uint64)
        size = min(self.size, len(words))
        n = len(words) - size + 1
        total = np.full(n, size, np.uint64)
        for k in range(size):
            total = _mixed(total + ids[k : k + n] * _PLACE[k % len(_PLACE)])
        return np.unique(total)


def minhash(shingles: np.ndarray) -> np.ndarray:
    """The least value of every hash function over the set (uint32)."""
    low = shingles.astype(np.uint32)
    best = np.full(HASHES, np.iinfo(np.uint32).max, np.uint32)
    for i in range(0, len(low), 512):
        np.minimum(best, ((low[i : i + 512, None] ^ _XOR) * _MUL).min(0), out=best)
    return best


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One 64-bit key per band; the band's number is part of it."""
    rows = signature.reshape(BANDS, ROWS).astype(np.uint64)
    return _mixed(_mixed((rows * _BAND_MUL).sum(1, dtype=np.uint64)) + np.arange(BANDS, dtype=np.uint64) * _GOLDEN)


def least_matches(percent: int = PERCENT, miss: float = MISS) -> list[tuple[int, int]]:
    """(values seen, least matches to go on): below it, P(similarity >= percent) under a flat prior is under ``miss``.

    After m matches in n the posterior is Beta(m + 1, n - m + 1); its upper
    tail at s equals P(Binomial(n + 1, s) <= m).
    """
    s, out = percent / 100, []
    for n in range(BATCH, HASHES + 1, BATCH):
        tail, m = 0.0, -1
        while tail < miss:
            m += 1
            tail += math.comb(n + 1, m) * s**m * (1 - s) ** (n + 1 - m)
        out.append((n, m))
    return out


def _sign(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = ShingleHasher(size)
        for batch in batches:
            for begin in range(0, batch.num_rows, 512):
                part = batch.slice(begin, 512)
                counts, names, bands, signatures = [], [], [], []
                for text in part.column(1):
                    found = hasher(text.as_py())
                    counts.append(len(found))
                    if not len(found):
                        names.append(None), bands.append(None), signatures.append(None)
                        continue
                    names.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
                    values = minhash(found)
                    bands.append(band_keys(values).view(np.int64))
                    signatures.append(values.astype(np.uint8).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(counts, pa.int64()),
                        pa.array(names, pa.binary()),
                        pa.array(bands, pa.list_(pa.int64())),
                        pa.array(signatures, pa.binary()),
                    ],
                    names=["rid", "n_shingles", "set_id", "bands", "signature"],
                )

    return run


def _prune(percent: int, miss: float):
    looks = least_matches(percent, miss)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 4096):
                part = batch.slice(begin, 4096)
                left, right = (
                    np.frombuffer(b"".join(part.column(i).to_pylist()), np.uint8).reshape(-1, HASHES) for i in (2, 3)
                )
                alive, matches = np.arange(part.num_rows), np.zeros(part.num_rows, int)
                for n, least in looks:
                    matches += (left[alive, n - BATCH : n] == right[alive, n - BATCH : n]).sum(1)
                    go_on = matches >= least
                    alive, matches = alive[go_on], matches[go_on]
                kept = part.take(pa.array(alive))
                yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1)], names=["a", "b"])

    return run


def shingle_set(text: str | None, size: int) -> set:
    words = words_of(text or "")
    size = min(size, len(words))
    return set(zip(*(words[k : len(words) - size + 1 + k] for k in range(size)))) if words else set()


def _confirm(size: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple = (None, None)
        for batch in batches:
            keep = []
            for i in range(batch.num_rows):
                a = batch.column(0)[i].as_py()
                if last[0] != a:
                    last = (a, shingle_set(batch.column(2)[i].as_py(), size))
                left, right = last[1], shingle_set(batch.column(3)[i].as_py(), size)
                both = len(left & right)
                if 100 * both >= percent * (len(left) + len(right) - both):
                    keep.append(i)
            kept = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1)], names=["a", "b"])

    return run


def components(links: DataFrame) -> DataFrame:
    """Connected components of undirected ``links`` (``a, b``): ``node, label`` with the smallest node as label.

    Every round takes the least label among a node's neighbours and then the
    label of that label, so long chains shorten by halves.  Labels are written
    after every round; only a count of changes reaches the driver.
    """
    both = scratch_table(
        links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links"
    )
    labels = scratch_table(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label")), "labels")
    while True:
        near = (
            both.join(labels, F.col("b") == F.col("node"))
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        hooked = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("mid"))
        far = labels.select(F.col("node").alias("mid"), F.col("label").alias("far"))
        step = scratch_table(
            hooked.join(far, "mid", "left").select("node", "old", F.least("mid", F.coalesce("far", "mid")).alias("label")),
            "labels",
        )
        if step.where("old <> label").isEmpty():
            return step.select("node", "label")
        labels = step.select("node", "label")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = WORDS,
    percent: int = PERCENT,
    miss: float = MISS,
) -> tuple[DataFrame, DataFrame]:
    """The numbered documents and their groups.

    Returns ``(rows, groups)``: ``rows`` are all columns of ``docs`` with a row
    number ``_rid``; ``groups`` has per row ``_rid, doc_id, n_shingles,
    component_id`` (smallest id reachable, itself included) and ``keeper``
    (true for one row of each group: the smallest id, then the first row).

    Candidate pairs: in every band bucket each class is tested against the
    bucket's first class; after components of those links, classes that share
    a bucket but are still apart meet again by their rare shingles (``_sharing_rare``).
    So a bucket of near copies costs one test per member, and no pair of
    similar sets that meets in a bucket is left out.

    Defined cases: a null, empty or blank text has an empty set and is linked
    with nothing; with fewer than ``words`` words the whole sequence is the one
    shingle; rows with equal sets are one class whatever their ids; null ids
    come after all others; an empty table gives empty results.
    """
    rows = scratch_table(docs.withColumn("_rid", F.monotonically_increasing_id()), "numbered")
    narrow = rows.select(F.col("_rid").alias("rid"), F.col(text_col).alias("text"))
    signed = scratch_table(
        narrow.mapInArrow(_sign(words), "rid long, n_shingles long, set_id binary, bands array<long>, signature binary"),
        "signed",
    )
    members = signed.select("rid", "n_shingles", "set_id")
    classes = members.where("set_id is not null").groupBy("set_id").agg(F.min("rid").alias("cls"))
    first = signed.join(classes.select(F.col("cls").alias("rid")), "rid", "left_semi")
    sets = scratch_table(first.select(F.col("rid").alias("cls"), "n_shingles", "bands", "signature"), "sets")

    buckets = sets.select("cls", "n_shingles", F.explode("bands").alias("key"))
    shared = buckets.groupBy("key").agg(F.min("cls").alias("hub"), F.max("cls").alias("_last")).where("hub < _last")
    meeting = scratch_table(
        buckets.join(shared.select("key", "hub"), "key"), "buckets"
    )
    spokes = meeting.where("cls <> hub").select(F.col("hub").alias("a"), F.col("cls").alias("b")).distinct()
    tried = scratch_table(_sized(spokes, sets, percent), "spokes")
    links = scratch_table(_links(tried, sets, narrow, words, percent, miss), "links")
    labels = components(links)

    # A hub has met all of its bucket, so only the others can have missed each other.
    placed = (
        meeting.where("cls <> hub")
        .join(labels, F.col("cls") == F.col("node"), "left")
        .select("key", "cls", F.coalesce("label", "cls").alias("label"))
    )
    split = placed.groupBy("key").agg(F.min("label").alias("_lo"), F.max("label").alias("_hi")).where("_lo <> _hi")
    unsettled = placed.join(split.select("key"), "key", "left_semi").select("cls", "label").distinct()
    apart = scratch_table(
        _sharing_rare(unsettled, narrow, words, percent).join(tried.select("a", "b"), ["a", "b"], "left_anti"), "apart"
    )
    late = scratch_table(_links(apart, sets, narrow, words, percent, miss), "late")
    if not late.isEmpty():
        labels = components(links.unionByName(late))

    ids = rows.select(F.col("_rid").alias("rid"), F.col(id_col).alias("doc_id"))
    grouped = (
        members.join(classes, "set_id", "left")
        .join(labels, F.col("cls") == F.col("node"), "left")
        .select("rid", "n_shingles", F.coalesce("label", "cls", "rid").alias("label"))
        .join(ids, "rid")
    )
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "rid")
    heads = grouped.groupBy("label").agg(F.min(order).alias("_head"))
    groups = grouped.join(heads, "label").select(
        F.col("rid").alias("_rid"),
        "doc_id",
        "n_shingles",
        F.col("_head.doc_id").alias("component_id"),
        (F.col("_head.rid") == F.col("rid")).alias("keeper"),
    )
    return rows, groups


def _shingle_rows(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = ShingleHasher(size)
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                sets = [hasher(t.as_py()).view(np.int64) for t in part.column(2)]
                counts = [len(x) for x in sets]
                row = pa.array(np.repeat(np.arange(part.num_rows), counts))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(row),
                        part.column(1).take(row),
                        pa.array(np.repeat(counts, counts), pa.int64()),
                        pa.array(np.concatenate(sets) if sets else [], pa.int64()),
                    ],
                    names=["cls", "label", "size", "shingle"],
                )

    return run


def _sharing_rare(classes: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs of classes with different labels (``cls, label``) that could still be similar enough.

    Exact by the prefix rule: with every set in the same order, rarest shingle
    first, two sets of n and m that are similar enough share a shingle among
    the first n - ceil(s n) + 1 and m - ceil(s m) + 1.  Whatever else they
    share lies behind the head of the set whose head ends first, so the shared
    part of the heads and the longer tail together must reach the overlap.  A
    pair is made once, at the first shingle that the heads share.
    Classes of one bucket that differ from each other in shingles of their own
    thus form no pairs, however many they are.
    """
    rows = scratch_table(
        classes.join(texts, F.col("cls") == F.col("rid"))
        .select("cls", "label", "text")
        .mapInArrow(_shingle_rows(words), "cls long, label long, size long, shingle long"),
        "unsettled",
    )
    common = rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("df"))
    rarest = Window.partitionBy("cls").orderBy("df", "shingle")
    prefix = scratch_table(
        rows.join(common, "shingle")
        .withColumn("at", F.row_number().over(rarest))
        .where((F.col("at") <= F.col("size") - F.expr(f"({percent} * size + 99) div 100") + 1) & (F.col("df") > 1))
        .groupBy("cls", "label", "size")
        .agg(F.array_sort(F.collect_list("shingle")).alias("head"))
        .withColumn("shingle", F.explode("head")),
        "prefix",
    )
    other = prefix.select(*[F.col(c).alias(f"{c}2") for c in ("shingle", "cls", "label", "size", "head")])
    sizes = F.col("size") + F.col("size2")
    shared = F.array_intersect("head", "head2")
    tail = F.expr(f"({percent} * greatest(size, size2) + 99) div 100 - 1")
    return (
        prefix.join(
            other,
            (F.col("shingle") == F.col("shingle2"))
            & (F.col("cls") < F.col("cls2"))
            & (F.col("label") != F.col("label2"))
            & (F.lit(100) * F.least("size", "size2") >= F.lit(percent) * F.greatest("size", "size2"))
            & (F.get(shared, F.lit(0)) == F.col("shingle"))
            & ((F.size(shared) + tail) * (100 + percent) >= F.lit(percent) * sizes),
        )
        .select(F.col("cls").alias("a"), F.col("cls2").alias("b"))
        .distinct()
    )


def _sized(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose set sizes allow the similarity."""
    size = sets.select(F.col("cls"), "n_shingles")
    a = size.select(F.col("cls").alias("a"), F.col("n_shingles").alias("na"))
    b = size.select(F.col("cls").alias("b"), F.col("n_shingles").alias("nb"))
    joined = pairs.join(a, "a").join(b, "b")
    return joined.where(F.lit(100) * F.least("na", "nb") >= F.lit(percent) * F.greatest("na", "nb")).select("a", "b")


def _links(pairs: DataFrame, sets: DataFrame, texts: DataFrame, words: int, percent: int, miss: float) -> DataFrame:
    """The pairs that the Bayesian test keeps and the full sets confirm."""
    left = sets.select(F.col("cls").alias("a"), F.col("signature").alias("sa"))
    right = sets.select(F.col("cls").alias("b"), F.col("signature").alias("sb"))
    likely = scratch_table(
        pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb").mapInArrow(_prune(percent, miss), "a long, b long"),
        "likely",
    )
    needed = scratch_table(
        texts.join(likely.select(F.col("a").alias("rid")).unionByName(likely.select(F.col("b").alias("rid"))).distinct(), "rid"),
        "texts",
    )
    return (
        likely.join(needed.select(F.col("rid").alias("b"), F.col("text").alias("tb")), "b")
        .join(needed.select(F.col("rid").alias("a"), F.col("text").alias("ta")), "a")
        .select("a", "b", "ta", "tb")
        .mapInArrow(_confirm(words, percent), "a long, b long")
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each near-duplicate group left, all columns kept."""
    rows, groups = near_duplicates(docs, id_col, text_col, **options)
    kept = groups.where("keeper").select("_rid")
    return rows.join(kept, "_rid", "left_semi").drop("_rid")


def oracle_sql(words: int = 4, percent: int = PERCENT) -> str:
    """The groups by all-pairs set intersection and transitive closure, for small tables."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH RECURSIVE d AS (
  SELECT doc_id, [x FOR x IN string_split_regex(translate(coalesce(text, ''), '{upper}', '{lower}'),
                                                '[\\x20\\x09-\\x0D]+') IF x <> ''] AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {words} THEN [array_to_string(w, ' ')]
    ELSE [array_to_string(w[i:i + {words - 1}], ' ') FOR i IN range(1, len(w) - {words} + 2)] END) AS shingle
  FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * shared >= {percent} * (x.n + y.n - shared)),
reach AS (
  SELECT doc_id, doc_id AS other FROM d
  UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other),
least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least.component_id, d.doc_id = least.component_id AS kept
FROM d JOIN least ON least.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""
