"""Vector code compression: product codes over integer codebooks, searched through an integer Walsh-Hadamard transform.

Components become integers, vectors are cut into equal parts, and each part is
replaced by the index of its nearest codebook entry.  The search is exact and
holds no floating point: parts and entries are zero-padded to a power of two
and transformed by the integer Walsh-Hadamard transform, which multiplies
every squared distance by the padded width.  Scaled squared differences are
added in sequency order (slowly changing rows of the transform first, where
correlated components gather their energy), and an entry is dropped as soon as
its sum passes the full distance of the entry that looked best at first.

Spark reads the table once a round.  A task sends one sum a codebook position,
so a round's shuffle is bounded by tasks x codebook size, and only the
codebooks (parts x entries x width integers, of fixed size) pass through the
driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulage.llm.common import scratch_table

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024.0
STEP = 8  # coefficients between two eliminations
ROWS = 256  # vectors compared at a time, so that their sums stay in a core's cache
SATURATION = 1 << 62  # integers beyond this (|x| over 4.5e15) count as this
LONG_MAX = (1 << 63) - 1


# ------------------------------------------------------------------ transform
def hadamard(rows: np.ndarray) -> np.ndarray:
    """Integer Walsh-Hadamard transform of each row, in natural order; the width is a power of two."""
    n, width = rows.shape
    out, half = rows, 1
    while half < width:
        pairs = out.reshape(n, width // (2 * half), 2, half)
        left, right = pairs[:, :, 0], pairs[:, :, 1]
        out = np.stack([left + right, left - right], axis=2).reshape(n, width)
        half *= 2
    return out


def sequency_order(width: int) -> np.ndarray:
    """Natural-order places of the transform's rows by their number of sign changes (bit-reversed Gray code)."""
    bits = width.bit_length() - 1
    gray = np.arange(width) ^ (np.arange(width) >> 1)
    order = np.zeros(width, int)
    for b in range(bits):
        order |= ((gray >> b) & 1) << (bits - 1 - b)
    return order


def transform(parts: np.ndarray) -> np.ndarray:
    """Zero-padded parts (rows) in the transform's domain, coefficients in sequency order."""
    width = 1 << max(parts.shape[1] - 1, 0).bit_length()
    padded = np.zeros((len(parts), width), parts.dtype)
    padded[:, : parts.shape[1]] = parts
    return hadamard(padded)[:, sequency_order(width)]


def nearest(coefs: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row the nearest entry (ties: lower index) and its squared distance times the transform's width.

    The entry that looks best after ``STEP`` coefficients gives each row its
    bound.  Partial sums only grow, so an entry beyond the bound can't win and
    is dropped; whoever is left at the end has its whole distance.
    """
    n, width = coefs.shape
    partial = np.zeros((n, len(entries)), coefs.dtype)
    first = min(STEP, width)
    for k in range(first):
        gap = coefs[:, k, None] - entries[None, :, k]
        gap *= gap
        partial += gap
    rows = np.arange(n)
    guess = partial.argmin(1)
    rest = coefs[:, first:] - entries[guess, first:]
    bound = partial[rows, guess] + (rest * rest).sum(1)
    row, entry = np.nonzero(partial <= bound[:, None])
    total = partial[row, entry]
    for at in range(first, width, STEP):
        gap = coefs[row, at : at + STEP] - entries[entry, at : at + STEP]
        total = total + (gap * gap).sum(1)
        left = total <= bound[row]
        row, entry, total = row[left], entry[left], total[left]
    best = np.minimum.reduceat(total, np.searchsorted(row, rows))
    hit = np.flatnonzero(total == best[row])
    won = hit[np.unique(row[hit], return_index=True)[1]]
    return entry[won], best


def _exact(width: int, *tables: np.ndarray) -> type:
    """int64 while the largest scaled distance fits, Python's integers beyond."""
    padded = 1 << max(width - 1, 0).bit_length()
    most = max((int(np.abs(t).max()) for t in tables if t.size), default=0)
    return np.int64 if 4 * most * most * padded * padded < LONG_MAX else object


def assign(parts: np.ndarray, codebook: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per part (row) the nearest entry of ``codebook`` and the exact squared distance to it."""
    kind = _exact(parts.shape[1], parts, codebook)
    entries = transform(codebook.astype(kind))
    codes, gaps = np.zeros(len(parts), int), np.zeros(len(parts), kind)
    for at in range(0, len(parts), ROWS):
        block = transform(parts[at : at + ROWS].astype(kind))
        code, total = nearest(block, entries)
        codes[at : at + ROWS], gaps[at : at + ROWS] = code, total // entries.shape[1]
    return codes, gaps


# --------------------------------------------------------------- Spark side
def usable(vector: Column) -> Column:
    """A vector that is not null and holds no null, NaN or infinite component."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & ~bad, F.lit(False))


def _integers(column: pa.Array, parts: int) -> np.ndarray:
    """Vectors of one width as integers, rows x parts x part width (zeros fill the last part)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    values = values.reshape(len(column), -1) if len(column) else values.reshape(0, 0)
    whole = np.floor(np.clip(values * SCALE, -float(SATURATION), float(SATURATION))).astype(np.int64)
    gap = -whole.shape[1] % parts
    return np.pad(whole, ((0, 0), (0, gap))).reshape(len(whole), parts, -1)


def _sums(codebooks: np.ndarray) -> Callable:
    """Per task: the sum of each codebook position's parts and, behind each entry, their number."""
    parts, size, width = codebooks.shape

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((parts, size, width + 1), object)
        for batch in batches:
            whole = _integers(batch.column(0), parts)
            wide = whole.size and int(np.abs(whole).max()) * len(whole) >= LONG_MAX
            for p in range(parts if len(whole) else 0):
                codes, _ = assign(whole[:, p], codebooks[p])
                local = np.zeros((size, width + 1), object if wide else np.int64)
                np.add.at(local[:, :width], codes, whole[:, p].astype(local.dtype))
                np.add.at(local[:, width], codes, 1)
                totals[p] += local.astype(object)
        flat = totals.reshape(-1)
        slots = [i for i, v in enumerate(flat) if v]
        if slots:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(slots, pa.int64()),
                    pa.array([int(flat[i]) >> 32 for i in slots], pa.int64()),
                    pa.array([int(flat[i]) & 0xFFFFFFFF for i in slots], pa.int64()),
                ],
                names=["slot", "high", "low"],
            )

    return summed


def train(vectors: DataFrame, seeds: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (parts x entries x width) after ``rounds`` rounds over all ``vectors`` (one array column).

    Each round is one pass: every part goes to its nearest entry, and an entry
    becomes the floored mean of its parts; one without parts stays.
    """
    codebooks = seeds
    parts, size, width = codebooks.shape
    for _ in range(rounds if size else 0):
        sums = vectors.mapInArrow(_sums(codebooks), "slot long, high long, low long")
        # At most parts x entries x (width + 1) rows, whatever the table's size.
        rows = sums.groupBy("slot").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()
        totals = np.zeros(parts * size * (width + 1), object)
        for r in rows:
            totals[r["slot"]] = (r["high"] << 32) + r["low"]
        totals = totals.reshape(parts, size, width + 1)
        codebooks = codebooks.copy()
        used = totals[:, :, width] > 0
        codebooks[used] = (totals[used][:, :width] // totals[used][:, width:]).astype(np.int64)
    return codebooks


def digest(codebooks: np.ndarray) -> str:
    """sha256 of all entries' decimal components by part, entry and position, comma-joined."""
    return hashlib.sha256(",".join(str(int(x)) for x in codebooks.reshape(-1)).encode()).hexdigest()


def _encoded(codebooks: np.ndarray, keys: list[str]) -> Callable:
    parts = len(codebooks)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = _integers(batch.column(len(keys)), parts)
            found = [assign(whole[:, p], codebooks[p]) for p in range(parts)] if len(whole) else []
            text = ["".join(f"{c:02x}" for c in row) for row in zip(*(codes.tolist() for codes, _ in found))]
            error = [min(sum(map(int, row)), LONG_MAX) for row in zip(*(gaps.tolist() for _, gaps in found))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keys)], pa.array(text, pa.string()), pa.array(error, pa.int64())],
                names=[*keys, "code", "error"],
            )

    return encoded


def vector_width(vectors: DataFrame, vector_col: str) -> int | None:
    """The most common length (ties: the longer), or None for no vectors."""
    sizes = vectors.groupBy(F.size(vector_col).alias("w")).agg(F.count(F.lit(1)).alias("n"))
    top = sizes.orderBy(F.col("n").desc(), F.col("w").desc()).first()
    return None if top is None else int(top["w"])


def compress(
    table: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> tuple[DataFrame, np.ndarray]:
    """Codes of all usable vectors, ``(vec_id, label, code, error)``, and the codebooks behind them.

    A codebook starts as that part of the ``entries`` vectors with the
    smallest ids (repeated ids by their components, null ids last).  Null
    vectors and those with a null or non-finite component are dropped.  The
    most common length is the table's width: a vector of another length stays
    with a null code and error and teaches nothing.  A width that ``parts``
    doesn't divide is filled up with zeros.  Repeated rows each get their code;
    an empty table gives no rows and empty codebooks.  Components beyond
    ``SATURATION`` and errors beyond a long stay at those limits.  Other
    columns are not read.
    """
    if entries > 256:
        raise ValueError("a code has two hex digits: at most 256 entries")
    kept = table.where(usable(F.col(vector_col))).select(
        F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector")
    )
    width = vector_width(kept, "vector")
    fitting = kept.where(F.size("vector") == F.lit(width if width is not None else -1))
    seeds = [r["vector"] for r in fitting.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).collect()]
    whole = _integers(pa.array(seeds, pa.list_(pa.float64())), parts) if seeds and width else np.zeros((len(seeds), parts, 0), np.int64)
    codebooks = train(fitting.select("vector"), np.ascontiguousarray(whole.transpose(1, 0, 2)), rounds if width else 0)
    if not width:
        none = F.size("vector") == 0
        code, error = F.when(none, F.lit("00" * parts)), F.when(none, F.lit(0)).cast("long")
        return kept.select("vec_id", "label", code.alias("code"), error.alias("error")), codebooks
    types = {f.name: f.dataType.simpleString() for f in kept.schema}
    schema = f"vec_id {types['vec_id']}, label {types['label']}, code string, error long"
    coded = fitting.mapInArrow(_encoded(codebooks, ["vec_id", "label"]), schema)
    others = kept.where(F.size("vector") != F.lit(width)).select(
        "vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error")
    )
    return coded.unionByName(others), codebooks


def with_label_error(coded: DataFrame) -> DataFrame:
    """``coded`` with ``label_error``: the sum of the errors over all rows of the label (nulls are one label).

    Errors are summed map-side by label, and the narrow sums are joined back;
    a label with a third of the rows never stands in one window.
    """
    rows = scratch_table(coded, "codes")
    sums = rows.groupBy(F.col("label").alias("_label")).agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("_sum"))
    sums = scratch_table(sums, "label-sums")
    capped = F.least(F.col("_sum"), F.lit(LONG_MAX).cast("decimal(38,0)")).cast("long")
    return rows.join(sums, F.col("label").eqNullSafe(F.col("_label"))).withColumn("label_error", capped).drop("_label", "_sum")


def oracle_sql() -> str:
    """The query's rows as DuckDB SQL, for vectors of one width: distances by dot products of whole numbers in doubles."""
    distance = "xx + ee - 2 * list_dot_product(x, y)"

    def assigned(k: int) -> str:
        return f"""
assigned{k} AS (
  SELECT rid, p, min(struct_pack(d := {distance}, e := e)) AS best FROM parts JOIN books{k} USING (p) GROUP BY rid, p
)"""

    def updated(k: int) -> str:
        return f"""
means{k} AS (
  SELECT p, e, list(m ORDER BY pos) AS y FROM (
    SELECT p, a.best.e AS e, pos, floor(sum(x[pos]) / count(*)) AS m
    FROM assigned{k - 1} a JOIN parts USING (rid, p), positions GROUP BY ALL) GROUP BY p, e
),
books{k} AS (
  SELECT p, e, y, list_dot_product(y, y) AS ee
  FROM (SELECT b.p, b.e, coalesce(m.y, b.y) AS y FROM books{k - 1} b LEFT JOIN means{k} m ON b.p = m.p AND b.e = m.e)
)"""

    steps = ",".join(assigned(k) + "," + updated(k + 1) for k in range(ROUNDS))
    return f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor({int(SCALE)} * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
numbered AS (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, v) AS rid, *, len(v) // {PARTS} AS width FROM kept),
parts AS (
  SELECT rid, p, x, list_dot_product(x, x) AS xx
  FROM (SELECT rid, p, v[p * width + 1 : (p + 1) * width] AS x FROM numbered, range({PARTS}) t(p))
),
positions AS (SELECT pos + 1 AS pos FROM range((SELECT max(width) FROM numbered)) t(pos)),
books0 AS (SELECT p, rid - 1 AS e, x AS y, xx AS ee FROM parts WHERE rid <= {ENTRIES}),{steps},{assigned(ROUNDS)},
coded AS (
  SELECT rid, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error
  FROM assigned{ROUNDS} GROUP BY rid
),
digest AS (
  SELECT sha256(string_agg(CAST(CAST(y[pos] AS BIGINT) AS VARCHAR), ',' ORDER BY p, e, pos)) AS codebooks_sha256
  FROM books{ROUNDS}, positions
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded JOIN numbered USING (rid), digest""".strip()
