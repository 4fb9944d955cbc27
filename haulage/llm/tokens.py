"""Token counts by a public vocabulary file, with huge documents encoded in overlapping chunks and spliced.

A document longer than one chunk is never encoded whole.  Its chunks overlap,
each is encoded with offsets, and two neighbours are spliced at a place in
their overlap where both start a token and where the *text* proves that no
encoding of the whole document can join what stands before and behind it (see
``proven``).  The count is then exact whatever the chunk edges cut.  Where an
overlap holds no such place, or the two encodings differ between two of them,
the chunk and its overlap are doubled, in the end up to the whole text.

Shorter documents are counted by their distinct stretches between ASCII white
space, at which a splice is always proven: a stretch is encoded once a task
and remembered.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulage.llm.common import text_or_empty

VOCABULARY = "word_bpe_49k.json"
LIMIT = 2048  # tokens
CHUNK = 1 << 15  # code points encoded at a time
OVERLAP = 1 << 10
STRETCH = 64  # bytes of a stretch that is remembered
REMEMBERED = 300_000  # stretches a task remembers

# The split and the normalisers that ``proven`` is proven for (fixed values, as the vocabulary file states them).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALISERS = ["NFC", "Replace", "Lowercase"]

SPACE = frozenset(" \t\n\r\x0b\x0c")
LETTER = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
DIGIT = frozenset("0123456789")


def proven(text: str, at: int) -> bool:
    """Whether every encoding of ``text`` splits before ``text[at]``, judged by the two code points around the place.

    * Behind ASCII white space: it is dropped by the split, no match and no
      special string holds it, and it is composed with nothing.
    * Between two ASCII code points, one a digit: a digit is a match of its own.
    * Behind an ASCII letter and before another ASCII sign: only runs of
      letters and the contractions, which end in letters, match a letter.
      ``|`` is left out, as the special strings have it behind letters.

    ASCII code points are normalised on their own (none is combining, and none
    is the second half of a composition), so a cut before one changes nothing.
    """
    before, after = text[at - 1], text[at]
    if before in SPACE:
        return True
    if ord(before) > 127 or ord(after) > 127:
        return False
    if before in DIGIT or after in DIGIT:
        return True
    return before in LETTER and after not in LETTER and after != "|"


class Counter:
    """Counts tokens with one tokenizer; ``json`` is a vocabulary file's content."""

    def __init__(self, json: str, chunk: int = CHUNK, overlap: int = OVERLAP):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(json)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.chunk, self.overlap = chunk, overlap
        self.known: dict[bytes, int] = {}
        self.spliced = self._provable(json)

    @staticmethod
    def _provable(json: str) -> bool:
        """Whether the file splits text as ``proven`` assumes; the texts of any other file are encoded whole."""
        import json as parser

        parts = parser.loads(json)
        normalisers = [p["type"] for p in (parts.get("normalizer") or {}).get("normalizers", [])]
        splits = [p for p in (parts.get("pre_tokenizer") or {}).get("pretokenizers", []) if p["type"] == "Split"]
        added = [t["content"] for t in parts.get("added_tokens", [])]
        return (
            normalisers == NORMALISERS
            and [(p["pattern"], p["behavior"], p["invert"]) for p in splits] == [({"Regex": SPLIT}, "Removed", True)]
            and all(re.fullmatch(r"<\|[A-Za-z]+\|>", t) for t in added)
        )

    def _encode(self, text: str) -> tuple[list[int], list[int], list[int]]:
        found = self.tokenizer.encode(text, add_special_tokens=False)
        return found.ids, [s for s, _ in found.offsets], [e for _, e in found.offsets]

    def _sizes(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def count_batch(self, texts: list[str]) -> list[int]:
        if not self.spliced:
            return self._sizes(texts)
        short = [None if len(t) > self.chunk else t.encode().split() for t in texts]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = {p for pieces in short if pieces for p in pieces} - self.known.keys()
        sizes = dict(zip(new, self._sizes([p.decode() for p in new])))
        known = self.known
        known.update((p, n) for p, n in sizes.items() if len(p) <= STRETCH)
        out = []
        for text, pieces in zip(texts, short):
            if pieces is None:
                out.append(self.count_long(text))
            else:
                out.append(sum([known[p] if p in known else sizes[p] for p in pieces]))
        return out

    def count_long(self, text: str) -> int:
        """Tokens of a text of any length by spliced chunks, with one chunk's encoding in memory at a time."""
        total, at = 0, 0
        chunk, overlap = self.chunk, self.overlap
        ids, starts, ends = self._encode(text[:chunk])
        base, stop = 0, min(chunk, len(text))  # the encoded chunk is text[base:stop], counted from ``at`` on
        while stop < len(text):
            begin = max(stop - overlap, at)
            close = min(begin + chunk + overlap, len(text))
            following = self._encode(text[begin:close])
            splice = self._splice(text, (ids, starts, ends), base, following, begin, max(at, begin), stop)
            if splice is None:
                # No proven place is common to both: a longer chunk with a longer overlap, from the last splice on.
                chunk, overlap = 2 * chunk, 2 * overlap
                base, stop = at, min(at + chunk, len(text))
                ids, starts, ends = self._encode(text[base:stop])
                continue
            total += bisect.bisect_left(starts, splice - base) - bisect.bisect_left(starts, at - base)
            ids, starts, ends = following
            base, at, stop = begin, splice, close
            chunk, overlap = self.chunk, self.overlap
        return total + len(starts) - bisect.bisect_left(starts, at - base)

    @staticmethod
    def _splice(text, left, left_base, right, right_base, low, high) -> int | None:
        """The middle of the proven places in ``text[low:high]`` that start a token on both sides, if these agree between them."""

        def places(side, base):
            _, starts, ends = side
            first, last = bisect.bisect_left(starts, low - base), bisect.bisect_left(starts, high - base)
            return {
                base + starts[i]: i
                for i in range(last - 1, first - 1, -1)
                if i and ends[i - 1] <= starts[i] and base + starts[i] > low
            }

        ours, theirs = places(left, left_base), places(right, right_base)
        common = sorted(p for p in ours.keys() & theirs.keys() if proven(text, p))
        if not common:
            return None
        first, last = common[0], common[-1]
        if left[0][ours[first] : ours[last]] != right[0][theirs[first] : theirs[last]]:
            return None
        return common[len(common) // 2]


def count_tokens(
    docs: DataFrame,
    vocabulary: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = LIMIT,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every document, as the vocabulary's library counts whole texts.

    ``vocabulary`` is the path of a ``tokenizers`` JSON file; the driver reads
    it (a few MB, a fixed file) and sends its content to the tasks.  A null
    text counts as empty, with no tokens; repeated rows and null ids each give
    their row; an empty table gives none.  Other columns are not read.  No
    shuffle: rows are counted where they are read.
    """
    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path(VOCABULARY)
    with open(vocabulary, encoding="utf-8") as file:
        json = file.read()
    shared = docs.sparkSession.sparkContext.broadcast(json)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        counter = Counter(shared.value, chunk, overlap)
        for batch in batches:
            sizes: list[int] = []
            for at in range(0, batch.num_rows, 256):
                sizes += counter.count_batch(batch.column(2).slice(at, 256).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"]
            )

    text = text_or_empty(text_col)
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text")
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    sizes = rows.mapInArrow(counted, f"doc_id {kind}, n_bytes long, n_tokens long")
    return sizes.withColumn("over_limit", F.col("n_tokens") > limit)
