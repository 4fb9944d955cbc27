"""Importance resampling towards a target: hashed n-gram features, weighted by target against corpus, drawn by Gumbel keys.

A feature is a run of one to ``n`` words and falls into the bucket of its
CRC-32.  The checksums of all features of a block of texts are computed
together: CRC-32 is linear up to a constant that only depends on the length,
so a feature's checksum is the XOR of one table entry a byte (by its value and
its distance from the feature's end) and of the length's constant.  Features
longer than the table are folded blockwise: each block's XOR is advanced over
the bytes behind it by tables for 64, 128, 256, ... zero bytes.

Both passes read the corpus as it is; what is kept of it between them is one
count a bucket.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulage.llm.common import scratch_table, text_or_empty

BUCKETS = 10_000
GRAMS = 2
MIN_WORDS = 20
SHARE = 25  # per cent of the eligible documents
SEED = 7
DEPTH = 64  # distances from the end in the table
FULL = np.uint32(0xFFFFFFFF)
BLOCK = 1 << 20  # bytes of text or of expanded features handled at a time
LEVELS = 36  # a feature may be 2**36 blocks long


# ---------------------------------------------------------------- checksums
def _crc_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(0xEDB88320), step >> 1).astype(np.uint32)

    def zero_byte(state: np.ndarray) -> np.ndarray:
        return (state >> 8) ^ step[state & 255]

    places = np.empty((DEPTH, 256), np.uint32)
    places[0] = step
    for d in range(1, DEPTH):
        places[d] = zero_byte(places[d - 1])
    lengths = np.empty(DEPTH + 1, np.uint32)
    state = np.array([FULL], np.uint32)
    for n in range(DEPTH + 1):
        lengths[n] = state[0] ^ FULL
        state = zero_byte(state)
    skips = np.empty((LEVELS, 4, 256), np.uint32)
    for byte in range(4):
        state = np.arange(256, dtype=np.uint32) << np.uint32(8 * byte)
        for _ in range(DEPTH):
            state = zero_byte(state)
        skips[0, byte] = state
    for level in range(1, LEVELS):
        for byte in range(4):
            skips[level, byte] = _through(skips[level - 1], skips[level - 1, byte])
    return places.reshape(-1), lengths, skips


def _through(skip: np.ndarray, state: np.ndarray) -> np.ndarray:
    return skip[0][state & 255] ^ skip[1][(state >> 8) & 255] ^ skip[2][(state >> 16) & 255] ^ skip[3][state >> 24]


PLACES, LENGTHS, SKIPS = _crc_tables()


def _advanced(state: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """Each state moved over its number of table-long blocks of zero bytes."""
    state = state.copy()
    for level in range(int(blocks.max(initial=0)).bit_length()):
        on = np.flatnonzero((blocks >> level) & 1)
        state[on] = _through(SKIPS[level], state[on])
    return state


def _folded(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """XOR of the place table's entries over each span of 1 to ``DEPTH`` bytes."""
    out = np.empty(len(start), np.uint32)
    upto = np.cumsum(end - start)
    at = 0
    while at < len(start):
        done = upto[at - 1] if at else 0
        stop = max(int(np.searchsorted(upto, done + BLOCK, "right")), at + 1)
        ends = (upto[at:stop] - done).astype(np.int32)
        size = (end[at:stop] - start[at:stop]).astype(np.int32)
        place = np.arange(ends[-1], dtype=np.int32)
        from_end = np.repeat(ends - 1, size) - place
        byte = data[np.repeat(end[at:stop] - ends, size) + place]
        out[at:stop] = np.bitwise_xor.reduceat(PLACES[(from_end << 8) | byte], ends - size)
        at = stop
    return out


def crc32_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-32 of ``data[start:end]`` for all spans at once; spans may overlap and have any length."""
    size = end - start
    out = np.zeros(len(size), np.uint32)  # of no bytes: 0
    short = np.flatnonzero((size > 0) & (size <= DEPTH))
    out[short] = _folded(data, start[short], end[short]) ^ LENGTHS[size[short]]
    far = np.flatnonzero(size > DEPTH)
    if len(far):
        blocks = -(-size[far] // DEPTH)
        first = np.cumsum(blocks) - blocks
        behind = np.arange(int(blocks.sum())) - np.repeat(first, blocks)
        stop = np.repeat(end[far], blocks) - behind * DEPTH
        begin = np.maximum(stop - DEPTH, np.repeat(start[far], blocks))
        linear = np.bitwise_xor.reduceat(_advanced(_folded(data, begin, stop), behind), first)
        whole, part = np.divmod(size[far], DEPTH)
        out[far] = linear ^ _advanced(LENGTHS[part] ^ FULL, whole) ^ FULL
    return out


# ----------------------------------------------------------------- features
def _byte_classes() -> np.ndarray:
    """Each UTF-8 byte as it stands in a feature: A-Z in lower case, 0-9, a-z and all from 0x80 as they are, else 0."""
    table = np.zeros(256, np.uint8)
    for low, high in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
        table[low : high + 1] = np.arange(low, high + 1)
    table[0x41:0x5B] = np.arange(0x61, 0x7B)
    return table


CLASSES = _byte_classes()


def feature_buckets(
    data: np.ndarray, offsets: np.ndarray, n: int = GRAMS, buckets: int = BUCKETS, skip: int = 0
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words per text, and the text and bucket of every feature, for texts laid end to end in ``data``.

    Features that end within the first ``skip`` words are left out (they were
    counted with the section before).
    """
    marks = CLASSES[data]
    inside = marks > 0
    texts = len(offsets) - 1
    heads = np.zeros(len(data) + 1, bool)
    heads[offsets] = True  # a word never runs on into the next text
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    start = np.flatnonzero(inside & (~before | heads[:-1]))
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    size = np.flatnonzero(inside & (~after | heads[1:])) + 1 - start
    text = np.searchsorted(offsets, start, "right") - 1
    # The words again, one space behind each.
    begin = np.cumsum(size + 1) - size - 1
    line = np.full(int(size.sum()) + len(size), 0x20, np.uint8)
    at = np.flatnonzero(inside)
    line[at + np.repeat(begin - start, size)] = marks[at]
    finish = begin + size
    owners, found = [], []
    for k in range(n):
        whole = text[k:] == text[: len(text) - k]
        if skip:
            whole[: max(skip - k, 0)] = False
        first = np.flatnonzero(whole)
        owners.append(text[first])
        found.append(crc32_spans(line, begin[first], finish[first + k]) % np.uint32(buckets))
    words = np.bincount(text[skip:], minlength=texts)
    return words, np.concatenate(owners), np.concatenate(found)


def _last(data: np.ndarray, at: int, word: bool) -> int:
    """The last place before ``at`` with a byte of a word (or with another byte), -1 if there is none."""
    while at > 0:
        low = max(at - 4096, 0)
        hit = np.flatnonzero((CLASSES[data[low:at]] > 0) == word)
        if len(hit):
            return low + int(hit[-1])
        at = low
    return -1


def _sections(data: np.ndarray, n: int) -> Iterator[tuple[int, int, int]]:
    """A long text in sections that begin at words: (start, end, words at the start that were already counted)."""
    start, skip, fresh = 0, 0, 0
    while fresh < len(data):
        end = fresh + BLOCK
        while end < len(data) and CLASSES[data[end]]:
            more = np.flatnonzero(CLASSES[data[end : end + BLOCK]] == 0)
            end = end + int(more[0]) if len(more) else end + BLOCK
        end = min(end, len(data))
        yield start, end, skip
        # The next section repeats the last n - 1 words.
        start, skip, fresh = end, 0, end
        while skip < n - 1:
            last = _last(data, start, True)
            if last < 0:
                break
            start, skip = _last(data, last, False) + 1, skip + 1


def featured(column: pa.Array, n: int, buckets: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """``feature_buckets`` over a column of texts, block by block, each with its first row; long texts come in sections."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        stop = max(int(np.searchsorted(offsets, offsets[row] + BLOCK, "right")) - 1, row + 1)
        part = data[offsets[row] : offsets[stop]]
        if stop == row + 1 and len(part) > BLOCK:
            for start, end, skip in _sections(part, n):
                yield row, *feature_buckets(part[start:end], np.array([0, end - start]), n, buckets, skip)
        else:
            yield row, *feature_buckets(part, offsets[row : stop + 1] - offsets[row], n, buckets)
        row = stop


# --------------------------------------------------------------- Spark side
def bucket_counts(texts: DataFrame, text_col: str, n: int = GRAMS, buckets: int = BUCKETS) -> np.ndarray:
    """Features per bucket over all texts; a task sends one row a bucket, the driver gets one number a bucket."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, _, found in featured(batch.column(0), n, buckets):
                total += np.bincount(found, minlength=buckets)
        used = np.flatnonzero(total)
        if len(used):
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], names=["bucket", "n"])

    rows = texts.select(text_or_empty(text_col).alias("text")).mapInArrow(counted, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B)))) for each of the B buckets, in doubles."""
    size = float(len(corpus))
    top = (target + 1.0) * (float(corpus.sum()) + size)
    low = (corpus + 1.0) * (float(target.sum()) + size)
    return np.floor(1000.0 * np.log(top / low)).astype(np.int64)


def weigh(docs: DataFrame, gains: np.ndarray, text_col: str = "text", n: int = GRAMS) -> DataFrame:
    """``docs`` without the text, with ``n_words``, ``n_features`` and ``weight``, the floored mean gain of the features.

    A text without features weighs 0.  Gains are at most some tens of
    thousands, so their sums are exact.
    """
    keys = [c for c in docs.columns if c != text_col]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != text_col)

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, features, total = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for row, some, owner, found in featured(batch.column(len(keys)), n, len(gains)):
                words[row : row + len(some)] += some
                features[row : row + len(some)] += np.bincount(owner, minlength=len(some))
                np.add.at(total, row + owner, gains[found])
            weight = total // np.maximum(features, 1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keys)], pa.array(words), pa.array(features), pa.array(weight)],
                names=[*keys, "n_words", "n_features", "weight"],
            )

    return docs.select(*keys, text_or_empty(text_col).alias("_text")).mapInArrow(
        weighed, f"{fields}, n_words long, n_features long, weight long"
    )


def gumbel(id_col: Column, seed: int = SEED) -> Column:
    """floor(-1000 ln(-ln u)) with u from the id's hash; a null id is hashed as no characters."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def draw_highest(scored: DataFrame, eligible: Column, share: int = SHARE) -> DataFrame:
    """``scored`` with ``rank``: 1, 2, ... for the ``share`` per cent of eligible rows with the highest ``score``, else null.

    Ties go to the smaller ``doc_id`` (null last), then to smaller values of
    the other columns.  Rows are counted by score first.  The counts are summed
    from above in two steps, over ranges of 256 scores and within them, and
    then only rows of a drawn score are ordered, one score at a time.  Equal
    rows travel as one with their number.
    """
    columns = scored.columns
    rows = scored.withColumn("_in", F.coalesce(eligible, F.lit(False)))
    by_score = rows.where("_in").groupBy("score").agg(F.count(F.lit(1)).alias("_n"))
    by_score = scratch_table(by_score.withColumn("_range", F.expr("floor(score / 256)")), "scores")
    ranges = by_score.groupBy("_range").agg(F.sum("_n").alias("_m"))
    above = Window.partitionBy("_one").orderBy(F.col("_range").desc()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy("_one")
    ranges = ranges.withColumn("_one", F.lit(1)).select(
        "_range",
        F.coalesce(F.sum("_m").over(above), F.lit(0)).alias("_far"),
        F.expr(f"({int(share)} * sum(_m) over (partition by _one)) div 100").alias("_drawn"),
    )
    inside = Window.partitionBy("_range").orderBy(F.col("score").desc()).rowsBetween(Window.unboundedPreceding, -1)
    places = by_score.withColumn("_near", F.coalesce(F.sum("_n").over(inside), F.lit(0))).join(ranges, "_range")
    places = places.select(F.col("score").alias("_score"), (F.col("_far") + F.col("_near")).alias("_above"), "_drawn")
    placed = rows.join(places, F.col("_in") & (F.col("score") == F.col("_score")), "left")
    maybe = F.coalesce(F.col("_above") < F.col("_drawn"), F.lit(False))
    others = placed.where(~maybe).select(*columns, F.lit(None).cast("long").alias("rank"))
    same = placed.where(maybe).groupBy(*columns, "_above", "_drawn").agg(F.count(F.lit(1)).alias("_n"))
    order = [F.col("doc_id").asc_nulls_last(), *[F.col(c) for c in columns if c not in ("doc_id", "score")]]
    earlier = Window.partitionBy("score").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("_above") + F.coalesce(F.sum("_n").over(earlier), F.lit(0))
    ranked = same.withColumn("_first", first).withColumn("_k", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))))
    rank = F.col("_first") + F.col("_k")
    drawn = ranked.select(*columns, F.when(rank <= F.col("_drawn"), rank).cast("long").alias("rank"))
    return others.unionByName(drawn)


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
    min_words: int = MIN_WORDS,
    share: int = SHARE,
    seed: int = SEED,
) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` of every document, drawn towards the texts of ``target``.

    Null and empty texts have no features, weigh 0 and are never drawn; a null
    id is hashed as no characters.  Repeated rows each stand for themselves and
    share a score; an empty table gives no rows, an empty target still weighs
    by the corpus alone.  Texts of any length are read whole, in sections that
    begin at words.  Columns other than id and text are not read.
    """
    gains = bucket_gains(bucket_counts(docs, text_col), bucket_counts(target, target_text_col))
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    scored = weigh(narrow, gains).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    return draw_highest(scratch_table(scored, "scored"), F.col("n_words") >= min_words, share)


def oracle_sql() -> str:
    """The query's rows as DuckDB SQL; the checksums come from a table of (distance from the end, byte) as well."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH RECURSIVE
texts AS (
  SELECT true AS doc, row_number() OVER () AS rid, doc_id, text FROM documents
  UNION ALL SELECT false, row_number() OVER (), NULL, text FROM benchmark
),
worded AS (
  SELECT doc, rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'),
         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM texts
),
features AS (
  SELECT doc, rid, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM worded
),
names AS (SELECT f, octet_length(encode(f)) AS size, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM features)),
bits(b, k, v) AS (
  SELECT CAST(i AS BIGINT), 0, CAST(i AS BIGINT) FROM range(256) t(i)
  UNION ALL SELECT b, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE k < 8
),
step AS (SELECT b, v FROM bits WHERE k = 8),
longest AS (SELECT coalesce(max(size), 0) AS n FROM names),
places(d, b, v) AS (
  SELECT CAST(0 AS BIGINT), b, v FROM step
  UNION ALL SELECT d + 1, p.b, xor(p.v >> 8, s.v) FROM places p JOIN step s ON s.b = p.v & 255 WHERE d < (SELECT n FROM longest)
),
lengths(n, v) AS (
  SELECT CAST(0 AS BIGINT), CAST(4294967295 AS BIGINT)
  UNION ALL SELECT n + 1, xor(l.v >> 8, s.v) FROM lengths l JOIN step s ON s.b = l.v & 255 WHERE n < (SELECT n FROM longest)
),
bytes AS (
  SELECT f, size, size - 1 - i AS d, CAST('0x' || substr(h, CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT) AS b
  FROM (SELECT f, size, h, unnest(range(size)) AS i FROM names)
),
linear AS (SELECT f, any_value(size) AS size, bit_xor(p.v) AS v FROM bytes JOIN places p USING (d, b) GROUP BY f),
buckets AS (SELECT f, xor(xor(l.v, c.v), 4294967295) % {BUCKETS} AS bucket FROM linear l JOIN lengths c ON c.n = l.size),
placed AS (SELECT doc, rid, bucket FROM features JOIN buckets USING (f)),
counts AS (
  SELECT b.bucket, count(*) FILTER (WHERE doc) AS s, count(*) FILTER (WHERE NOT doc) AS t
  FROM range({BUCKETS}) b(bucket) JOIN placed USING (bucket) GROUP BY 1
),
totals AS (SELECT coalesce(sum(s), 0) AS s, coalesce(sum(t), 0) AS t FROM counts),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST(c.t + 1 AS DOUBLE) * CAST(a.s + {BUCKETS} AS DOUBLE)
         / (CAST(c.s + 1 AS DOUBLE) * CAST(a.t + {BUCKETS} AS DOUBLE)))) AS BIGINT) AS gain
  FROM counts c, totals a
),
weights AS (
  SELECT rid, count(*) AS n_features, CAST(floor(CAST(sum(gain) AS DOUBLE) / count(*)) AS BIGINT) AS weight
  FROM placed JOIN gains USING (bucket) WHERE doc GROUP BY rid
),
scored AS (
  SELECT w.rid, doc_id, len(w.w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST(CAST('0x' || substr(
           sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS DOUBLE) + 0.5) / 4294967296))) AS BIGINT) AS score
  FROM worded w LEFT JOIN weights USING (rid) WHERE w.doc
),
ranked AS (
  SELECT rid, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_words, n_features, weight) AS rank
  FROM scored WHERE n_words >= {MIN_WORDS}
)
SELECT doc_id, n_features, weight, score,
       CASE WHEN rank <= {SHARE} * (SELECT count(*) FROM ranked) // 100 THEN rank END AS rank
FROM scored LEFT JOIN ranked USING (rid)""".strip()
