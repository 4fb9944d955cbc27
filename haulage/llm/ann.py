"""Approximate nearest neighbours by cross-polytope hashing with multiprobe tables and exact reranking."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from haulage.llm.common import scratch_table

TABLES = 24
PROBES = 8
CELL = 4096  # candidates that one task compares at once; fuller buckets are split
BLOCK = 4096  # queries that one task compares at once with them; more are split likewise
STEPS = 4  # norm bands a power of two
WHOLE = 4096  # a norm band of so many vectors or fewer is searched whole
SEED = 11


@dataclass(frozen=True)
class Rotations:
    """Pseudo-rotations: three rounds of random signs and a fast Hadamard transform, one set of signs per table."""

    dims: int  # of the vectors
    tables: int
    seed: int = SEED

    @property
    def width(self) -> int:
        """The transform's size: the least power of two that holds the vectors and one more coordinate."""
        return 1 << self.dims.bit_length()

    def signs(self) -> np.ndarray:
        return np.random.default_rng(self.seed).choice(np.array([-1.0, 1.0]), (self.tables, 3, self.width))

    def lifted(self, vectors: np.ndarray, scales: np.ndarray | None = None) -> np.ndarray:
        """Unit vectors whose angle orders like the inner product: candidates get a coordinate that fills their norm
        up to their scale, the largest of their band; queries (no scales) get 0 there."""
        out = np.zeros((len(vectors), self.width))
        out[:, : self.dims] = vectors
        norms = np.linalg.norm(vectors, axis=1)
        if scales is None:
            return out / norms[:, None]
        out[:, self.dims] = np.sqrt(np.maximum(scales**2 - norms**2, 0.0))
        return out / scales[:, None]

    def rotated(self, lifted: np.ndarray, signs: np.ndarray) -> np.ndarray:
        out = lifted
        for s in signs:
            out = out * s
            half = 1
            while half < self.width:
                pairs = out.reshape(-1, self.width // (2 * half), 2, half)
                a, b = pairs[:, :, 0], pairs[:, :, 1]
                out = np.stack([a + b, a - b], axis=2).reshape(-1, self.width)
                half *= 2
            out = out / np.sqrt(self.width)
        return out


def nearest_axes(rotated: np.ndarray, count: int) -> np.ndarray:
    """The ``count`` nearest signed axes of every row, nearest first: twice the axis, plus one if positive."""
    n = rotated.shape[1]
    signed = np.empty((len(rotated), 2 * n))
    signed[:, 0::2], signed[:, 1::2] = -rotated, rotated
    return np.argsort(-signed, axis=1, kind="stable")[:, :count] if count > 1 else signed.argmax(1)[:, None]


@dataclass(frozen=True)
class Bands:
    """Norm bands, from the largest norms down: number, largest norm and first bucket of each, and which are searched
    whole (one bucket).  ``STEPS`` a power of two, so their count is bounded by the range of a double's exponent."""

    numbers: np.ndarray
    scales: np.ndarray
    starts: np.ndarray
    whole: np.ndarray


def norm_bands(found: DataFrame, buckets: int, whole: int) -> tuple[DataFrame, Bands]:
    """``found`` with ``band``, and the bands, each with ``buckets`` buckets unless it is searched whole."""
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    sized = found.withColumn("_norm", norm)
    fits = (F.col("_norm") > 0) & (F.col("_norm") < F.lit(float("inf")))
    top = sized.where(fits).agg(F.max("_norm")).first()[0] or 1.0
    below = F.floor((F.log2(F.lit(top)) - F.log2("_norm")) * STEPS).cast("int")
    banded = sized.withColumn("band", F.when(fits, below).otherwise(F.lit(0)))
    rows = banded.groupBy("band").agg(F.max(F.when(fits, F.col("_norm"))).alias("scale"), F.count(F.lit(1)).alias("n")).orderBy("band").collect()
    small = np.array([r["n"] <= whole for r in rows], bool)
    sizes = np.where(small, 1, buckets)
    bands = Bands(
        np.array([r["band"] for r in rows], int),
        np.array([r["scale"] or top for r in rows], float),
        np.cumsum(sizes) - sizes,
        small,
    )
    return banded.select("id", "v", "band"), bands


def _buckets(rotations: Rotations, count: int, bands: Bands, query: bool):
    """Adds, per vector, the flat list of its ``count`` buckets in every table: a candidate's in its own band, a query's
    in every band.  A band that is searched whole is one bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signs = rotations.signs()
        for batch in batches:
            for begin in range(0, batch.num_rows, 1024):
                part = batch.slice(begin, 1024)
                vectors = np.array(part.column(1).to_pylist(), float).reshape(part.num_rows, rotations.dims)
                at = None if query else np.searchsorted(bands.numbers, part.column(2).to_numpy())
                lifted = rotations.lifted(vectors, None if query else bands.scales[at])
                found = [nearest_axes(rotations.rotated(lifted, s), count) + t * 2 * rotations.width for t, s in enumerate(signs)]
                each = np.concatenate(found, axis=1)
                if query:
                    rows = len(each)
                    hashed = (each[:, None, :] + bands.starts[~bands.whole][None, :, None]).reshape(rows, -1)
                    each = np.concatenate([hashed, np.tile(bands.starts[bands.whole], (rows, 1))], axis=1).tolist()
                else:
                    first = bands.starts[at]
                    each = [[int(f)] if w else (e + f).tolist() for e, f, w in zip(each, first, bands.whole[at])]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(each, pa.list_(pa.int32()))],
                    names=["id", "v", "buckets"],
                )

    return run


def _compare(k: int):
    def run(key, queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        asked, found, scores = [], [], []
        if len(queries) and len(rows):
            stored = rows.groupby("bucket").indices
            held, ids = np.vstack(rows["v"].to_numpy()), rows["id"].to_numpy()
            probing, query_ids = np.vstack(queries["v"].to_numpy()), queries["id"].to_numpy()
            for bucket, at in queries.groupby("bucket").indices.items():
                if bucket not in stored:
                    continue
                here = stored[bucket]
                own, matrix = ids[here], held[here]
                repeated = len(np.unique(own)) < len(own)
                for q in np.array_split(at, len(at) // 256 + 1):
                    # einsum sums each pair in the same order wherever it stands, so equal vectors get equal scores.
                    for i, line in zip(q, np.einsum("qd,nd->qn", probing[q], matrix)):
                        best = np.lexsort((own, -line))
                        if repeated:
                            best = best[np.sort(np.unique(own[best], return_index=True)[1])]
                        best = best[:k]
                        asked.append(np.full(len(best), query_ids[i]))
                        found.append(own[best])
                        scores.append(line[best])
        flat = [np.concatenate(x) if x else np.zeros(0) for x in (asked, found, scores)]
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), flat)))

    return run


def _search(asked: DataFrame, index: DataFrame, groups: int, k: int, cell: int, block: int) -> DataFrame:
    """Each query's best ``k`` of every bucket it probes.

    About ``cell`` vectors make a group: small buckets share one, a larger
    bucket is split into parts, its queries into blocks of about ``block``,
    and each part meets each block in a group of its own.
    """
    entries = index.select("id", "v", F.explode("buckets").alias("bucket"))
    probing = asked.select("id", "v", F.explode("buckets").alias("bucket"))

    # One row per bucket: at most tables * 2 * width rows a band, whatever the data.
    def pieces(rows: DataFrame, size: int, name: str) -> DataFrame:
        return rows.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / F.lit(size)).cast("int").alias(name))

    split = F.broadcast(pieces(entries, cell, "parts").join(pieces(probing, block, "blocks"), "bucket"))

    def every(count: str, name: str):
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1)).alias(name)

    def own(count: str, name: str):
        return F.pmod(F.xxhash64("id"), F.col(count)).cast("int").alias(name)

    group = (F.col("bucket") % groups).alias("group")
    dealt = entries.join(split, "bucket").select(group, own("parts", "part"), every("blocks", "block"), "bucket", "id", "v")
    probing = probing.join(split, "bucket").select(group, every("parts", "part"), own("blocks", "block"), "bucket", "id", "v")
    return (
        probing.groupBy("group", "part", "block")
        .cogroup(dealt.groupBy("group", "part", "block"))
        .applyInPandas(_compare(k), "query_id long, vec_id long, score double")
    )


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id, v`` of the vectors that take part: id and all components present and finite, not all zero."""
    v = F.col(vector_col).cast("array<double>")
    limit = F.lit(float("inf"))
    return (
        vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v"))
        .where("id is not null and v is not null")
        .where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < limit)))
        .where(F.exists("v", lambda x: x != 0))
    )


def nearest(
    vectors: DataFrame,
    is_query,
    k: int = 20,
    tables: int = TABLES,
    probes: int = PROBES,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    cell: int = CELL,
    whole: int = WHOLE,
    block: int = BLOCK,
) -> DataFrame:
    """The ``k`` nearest found of every query row: ``query_id, rank, vec_id, score`` by inner product.

    ``is_query`` is a boolean Column over ``id``.  Vectors are cut into bands
    of like norms, a factor of at most 2 ** (1 / STEPS) apart.  In its band,
    lifted with the band's own largest norm, every vector is indexed in every
    table under its nearest signed axis; a query looks in its ``probes``
    nearest axes of each table of every band.  A band of at most ``whole``
    vectors, as the few longest often are, is searched whole: there a large
    inner product need not be a small angle.  What is met is ranked by the
    exact inner product in double precision, ties to the smaller id.  A bucket
    with more than ``cell`` vectors or ``block`` queries is split over several
    tasks, each of which returns its own best, so a bucket may hold any share
    of the rows.  Equal vectors are searched once: of their ids the ``k`` + 1
    smallest are candidates (the others cannot be among a query's best ``k``),
    and their queries share the answer.  A query whose buckets hold fewer than ``k`` others looks through every vector.

    Defined cases: vectors that are null, zero, or hold null or non-finite
    components take no part, nor do null ids; vectors of another length than
    the most common one (ties: the longer) take no part; a query never meets
    its own id; a repeated id counts once, with its best score; an empty table
    gives no rows.
    """
    found = scratch_table(usable(vectors, id_col, vector_col), "vectors")
    common = found.groupBy(F.size("v").alias("n")).count().orderBy(F.col("count").desc(), F.col("n").desc()).first()
    dims = common["n"] if common else 1
    found = found.where(F.size("v") == dims)
    rotations = Rotations(dims, tables)
    banded, bands = norm_bands(found, tables * 2 * rotations.width, whole)
    twins = Window.partitionBy("key").orderBy("id")
    # Ranks are cut in the tasks before the shuffle, so a vector with many ids costs few rows.
    few = banded.withColumn("key", _vector_key()).distinct().withColumn("_place", F.row_number().over(twins)).where(F.col("_place") <= k + 1)
    index = scratch_table(
        few.select("id", "v", "band").mapInArrow(_buckets(rotations, 1, bands, False), "id long, v array<double>, buckets array<int>"),
        "ann-index",
    )
    groups = max(1, min(2 * rotations.width, -(-index.count() // cell))) * tables
    # One query per vector, numbered by the smallest id that asks; a vector's key names it, as ids may repeat.
    wanted = found.where(is_query).select("id", _vector_key().alias("key"), "v").distinct()
    firsts = Window.partitionBy("key").orderBy("id")
    single = wanted.withColumn("_place", F.row_number().over(firsts)).where("_place = 1")
    single = scratch_table(single.select(F.monotonically_increasing_id().alias("id"), "key", "v"), "ann-queries")
    asked = scratch_table(
        single.select("id", "v").mapInArrow(
            _buckets(rotations, probes, bands, True), "id long, v array<double>, buckets array<int>"
        ),
        "ann-asked",
    )
    askers = wanted.select(F.col("id").alias("query_id"), "key")

    def answered(pairs: DataFrame, name: str) -> DataFrame:
        best = _ranked(pairs, k + 1).groupBy("query_id").agg(F.collect_list(F.struct("vec_id", "score")).alias("hits"))
        named = best.join(single.select(F.col("id").alias("query_id"), "key"), "query_id").select("key", "hits")
        each = askers.join(named, "key").select("query_id", F.inline("hits")).where("query_id != vec_id")
        return scratch_table(_ranked(each, k), name)

    hits = answered(_search(asked, index, groups, k + 1, cell, block), "ann-hits")
    short = askers.join(hits.where(F.col("rank") == k).select("query_id"), "query_id", "left_anti")
    if short.isEmpty():
        return hits
    one = F.array(F.lit(0)).alias("buckets")
    again = index.select(F.col("id").alias("id"), F.col("v").alias("v"), one)
    lacking = single.join(short.select("key").distinct(), "key", "left_semi").select("id", "v", one)
    rest = answered(_search(lacking, again, groups, k + 1, cell, block), "ann-rest")
    missing = short.select("query_id").distinct()
    return hits.join(missing, "query_id", "left_anti").unionByName(rest.join(missing, "query_id", "left_semi"))


def _vector_key():
    """128 bits that stand for a vector in joins and sorts."""
    return F.concat_ws("-", F.xxhash64("v"), F.xxhash64(F.lit(1), F.col("v")))


def _ranked(pairs: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        pairs.groupBy("query_id", "vec_id")
        .agg(F.max("score").alias("score"))
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
