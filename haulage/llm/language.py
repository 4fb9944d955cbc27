"""Language identification: known words first, then ever shorter character n-grams for unseen words."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LETTERS = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"
ORDERS = 4  # the longest character n-gram
MAX_LANGS = 256  # a model column each
ROWS_PER_LANG = 4000  # labelled rows that a language is learned from
WORDS_PER_LANG = 50_000  # capacity of the word table
GRAMS_PER_LANG = 30_000  # capacity of each order's n-gram table
FLUSH = 300_000  # distinct tokens that a counting task holds before it passes them on
CACHE = 400_000  # scored tokens that a scoring task remembers


@dataclass
class LanguageModel:
    """Log frequencies per language (columns) of words and of character n-grams (rows)."""

    langs: list[str]
    words: dict[str, int]
    word_logs: np.ndarray
    grams: dict[str, int]
    gram_logs: np.ndarray
    floor: np.ndarray  # of a character that no language has seen

    def word_scores(self, word: str) -> tuple[np.ndarray, int]:
        """Per-language log score of one lower-case word, and how many of its places (characters and end) are known.

        The score is the word's own frequency, or that of its longest known
        n-grams.  A place is known in a known word, or by an n-gram with the two
        characters before it (or all of the word so far).
        """
        row = self.words.get(word)
        if row is not None:
            return self.word_logs[row], len(word) + 1
        total, known = np.zeros(len(self.langs)), 0
        padded = f"\x02{word}\x03"
        for end in range(2, len(padded) + 1):
            for n in range(min(ORDERS, end), 0, -1):
                row = self.grams.get(padded[end - n : end])
                if row is not None:
                    total += self.gram_logs[row]
                    known += n >= min(3, end)
                    break
            else:
                total += self.floor
        return total, known


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    raw: dict[str, Counter] = defaultdict(Counter)

    def flush():
        lang_out, order_out, gram_out, n_out = [], [], [], []
        for lang, tokens in raw.items():
            words: Counter = Counter()
            for token, n in tokens.items():
                for w in LETTERS.findall(token):
                    words[w] += n
            tables = [words, *(Counter() for _ in range(ORDERS))]
            for w, n in words.items():
                padded = f"\x02{w}\x03"
                for order in range(1, ORDERS + 1):
                    table = tables[order]
                    for i in range(len(padded) - order + 1):
                        table[padded[i : i + order]] += n
            for order, table in enumerate(tables):
                lang_out += [lang] * len(table)
                order_out += [order] * len(table)
                gram_out += table.keys()
                n_out += table.values()
        raw.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(lang_out, pa.string()), pa.array(order_out, pa.int32()), pa.array(gram_out, pa.string()), pa.array(n_out, pa.int64())],
            names=["lang", "ord", "gram", "n"],
        )

    for batch in batches:
        for text, lang in zip(batch.column(0), batch.column(1)):
            raw[lang.as_py()].update(text.as_py().lower().split())
            if sum(map(len, raw.values())) > FLUSH:
                yield flush()
    if raw:
        yield flush()


def labelled_sample(
    labelled: DataFrame, id_col: str, lang_col: str, rows_per_lang: int = ROWS_PER_LANG
) -> DataFrame:
    """About ``rows_per_lang`` rows of each language, all of a smaller one, chosen by the hash of the id.

    The ``MAX_LANGS`` languages with most rows are learned, so the counts that
    are broadcast have a fixed largest size and texts are not shuffled.
    """
    counts = (
        labelled.groupBy(F.col(lang_col).alias("_lang"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .orderBy(F.col("_rows").desc(), "_lang")
        .limit(MAX_LANGS)
    )
    draw = F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit("lid")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return labelled.join(F.broadcast(counts), F.col(lang_col) == F.col("_lang")).where(
        draw * F.col("_rows") < F.lit(float(rows_per_lang))
    )


def train(
    labelled: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    id_col: str = "doc_id",
    rows_per_lang: int = ROWS_PER_LANG,
) -> PackedModel:
    """Learn from the text and language of ``labelled`` (rows with a null in either teach nothing).

    The sample is bounded by ``rows_per_lang`` (a classifier's training set)
    and the tables by their capacities, so the model that is broadcast has a
    fixed largest size.  Counting is done by Spark tasks, combined map-side.
    """
    rows = labelled.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    sample = labelled_sample(rows, id_col, lang_col, rows_per_lang).select(
        F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")
    )
    counts = (
        sample.mapInArrow(_counted, "lang string, ord int, gram string, n long")
        .groupBy("lang", "ord", "gram")
        .agg(F.sum("n").alias("n"))
    )
    order = Window.partitionBy("lang", "ord").orderBy(F.col("n").desc(), F.col("gram"))
    kept = (
        counts.withColumn("_rank", F.row_number().over(order))
        .where(F.col("_rank") <= F.when(F.col("ord") == 0, WORDS_PER_LANG).otherwise(GRAMS_PER_LANG))
        .drop("_rank")
    )
    return PackedModel(*_packed(kept))


def _packed(counts: DataFrame) -> tuple[list[str], bytes]:
    """Languages and counts as one Arrow stream: a few MB by the tables' capacities; the driver builds no lookups."""
    table = counts.select("lang", F.col("ord").cast("byte").alias("ord"), "gram", "n").toArrow()
    coded = table.column("lang").combine_chunks().dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    names = coded.dictionary.to_pylist()
    langs = sorted(names)
    place = np.array([langs.index(n) for n in names], np.int16)
    table = table.set_column(0, "lang", pa.array(place[coded.indices.to_numpy()] if names else place, pa.int16()))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(table)
    return langs, sink.getvalue().to_pybytes()


class PackedModel:
    """A trained model as its counts; unpickled, as in a task, it is a ``LanguageModel``."""

    def __init__(self, langs: list[str], packed: bytes):
        self.langs, self.packed = langs, packed

    def __reduce__(self):
        return build_model, (self.langs, self.packed)


def build_model(langs: list[str], packed: bytes) -> LanguageModel:
    table = pa.ipc.open_stream(packed).read_all()
    order = table.column("ord").to_numpy()

    def counts(part: pa.Table) -> tuple[dict[str, int], np.ndarray]:
        coded = part.column("gram").combine_chunks().dictionary_encode()
        if isinstance(coded, pa.ChunkedArray):
            coded = coded.combine_chunks()
        rows = {g: i for i, g in enumerate(coded.dictionary.to_pylist())}
        out = np.zeros((len(rows), len(langs)))
        out[coded.indices.to_numpy(), part.column("lang").to_numpy()] = part.column("n").to_numpy()
        return rows, out

    words, by_word = counts(table.filter(pa.array(order == 0)))
    total = by_word.sum(0)
    word_logs = np.log((by_word + 0.5) / (total + 0.5 * (len(words) + 1)))
    grams, by_gram = counts(table.filter(pa.array(order > 0)))
    singles = [i for g, i in grams.items() if len(g) == 1]
    alphabet = len(singles) + 1
    letters = by_gram[singles].sum(0)
    context = np.array([by_gram[grams[g[:-1]]] if len(g) > 1 and g[:-1] in grams else letters for g in grams])
    context = context.reshape(len(grams), len(langs))
    gram_logs = np.log((by_gram + 0.1) / (np.maximum(context, by_gram) + 0.1 * alphabet))
    return LanguageModel(langs, words, word_logs, grams, gram_logs, np.log(0.1 / (letters + 0.1 * alphabet)))


class _Scorer:
    """Scores texts with one model; a bounded cache holds the tokens scored last."""

    def __init__(self, model: LanguageModel, min_known: float):
        self.model, self.min_known = model, min_known
        self._fresh()

    def _fresh(self):
        self.rows: dict[str, int] = {}
        self.table = np.zeros((1024, len(self.model.langs)))
        self.has_letter = np.zeros(1024, bool)
        self.places = np.zeros((1024, 2), np.int64)  # of a token: known places, all places

    def _row(self, token: str) -> int:
        at = len(self.rows)
        if at == len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
            self.has_letter = np.concatenate([self.has_letter, np.zeros_like(self.has_letter)])
            self.places = np.concatenate([self.places, np.zeros_like(self.places)])
        found = LETTERS.findall(token)
        for word in found:
            scores, known = self.model.word_scores(word)
            self.table[at] += scores
            self.places[at] += known, len(word) + 1
        self.has_letter[at] = bool(found)
        self.rows[token] = at
        return at

    def __call__(self, text: str | None) -> tuple[str, float, bool]:
        if not text:
            return UNKNOWN, 0.0, False
        if len(self.rows) > CACHE:
            self._fresh()
        tokens = text.lower().split()
        ids = np.array([self.rows[t] if t in self.rows else self._row(t) for t in tokens], int)
        if not len(ids) or not self.has_letter[ids].any():
            return UNKNOWN, 0.0, False
        if not self.model.langs:
            return UNKNOWN, 0.0, True
        if self.min_known > 0:
            known, places = self.places[ids].sum(0)
            if known < self.min_known * places:
                return UNKNOWN, 0.0, True
        logs = self.table[ids].sum(0)
        best = int(np.argmax(logs))
        return self.model.langs[best], float(1.0 / np.exp(np.minimum(logs - logs[best], 0)).sum()), True


def identify(docs: DataFrame, model: PackedModel, text_col: str = "text", min_known: float = 0.0) -> DataFrame:
    """``docs`` with ``lang_pred`` (a learned language or ``und``), ``score`` (posterior, 0 to 1) and ``has_letter``.

    Only the text is read.  ``und`` with score 0 stands for a text that is
    null, empty or without a letter, and for every text if nothing was learned.
    With ``min_known`` it also stands for a text that the model can't place: of
    its words' places (see ``LanguageModel.word_scores``) a smaller share is
    known in any language.
    Ties go to the language first in code point order.  Texts are scored whole.
    Columns that already have one of the three names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, has_letter boolean")
    def judged(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = _Scorer(shared.value, min_known)
        for part in texts:
            yield pd.DataFrame([scorer(t) for t in part], columns=["lang_pred", "score", "has_letter"])

    rows = docs.drop("lang_pred", "score", "has_letter").withColumn("_lid", judged(F.col(text_col)))
    return rows.select(*[rows[c] for c in rows.columns if c != "_lid"], "_lid.lang_pred", "_lid.score", "_lid.has_letter")
