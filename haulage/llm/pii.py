"""Personal data: exact base patterns, and a character-level bidirectional LSTM with a CRF that adds spans.

The LSTM-CRF is trained on the base spans of a bounded sample and on written
variants of them (spaced or bracketed forms) set into the same texts.  It reads
overlapping windows; spans that are whole in no window are decoded from the
joined scores of a run of windows, and all are reconciled over the whole text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulage.llm import nn
from haulage.llm.common import first_by_hash

KINDS = ("email", "ip", "card", "phone")
# The base patterns.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile("[0-9]")
SIGNAL = re.compile("[0-9@]")
# Every base pattern and every variant that is trained holds one of these; other brackets and letter case are let in too.
WRITTEN = re.compile(r"[0-9@]|[(\[{<]\s*(?:at|dot)\s*[)\]}>]", re.IGNORECASE)

WINDOW, STRIDE = 96, 48
HIDDEN = 20
TAGS = 1 + 2 * len(KINDS)  # outside, then begin and inside of every kind
TRAIN_DOCS = 1500  # documents that the model is trained on
TRAIN_CHARS = 20_000  # longest training document; all documents are searched whole
TRAIN_WINDOWS = 4000
STEPS, BATCH = 280, 96
PIECE = 64  # windows of a run that are decoded together; longer runs go on from their last outside character
CELLS = 512 * WINDOW  # characters that are decoded at once
SURE = 0.9  # least mean probability of an added span's characters

Span = tuple[int, int, int]  # kind, start, end


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def base_spans(text: str | None) -> list[Span]:
    """The base patterns' spans in code points, by kind as listed, then start; time is linear in the text.

    An address is found from its ``@``: its local part is the run of allowed
    characters before it, which is where the leftmost match starts.
    """
    out: list[Span] = []
    if not text:
        return out
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        end = DOMAIN.match(text, at + 1) if start < at else None
        if end:
            out.append((0, start, end.end()))
            done = end.end()
        at = text.find("@", max(at + 1, done))
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split(".")):
                out.append((1, *m.span()))
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 13:
                digits = re.sub("[ -]", "", m.group())
                if 13 <= len(digits) <= 19 and luhn(digits):
                    out.append((2, *m.span()))
        for m in PHONE.finditer(text):
            if 9 <= len(DIGIT.findall(m.group())) <= 15:
                out.append((3, *m.span()))
    return out


def _class_table() -> np.ndarray:
    """Code point to input class: printable ASCII has its own (digits share one), other letters, space and rest."""
    table = np.zeros(0x250, np.int64)
    for p in range(len(table)):
        c = chr(p)
        if c.isdigit() and p < 128:
            table[p] = 1
        elif 32 < p < 127:
            table[p] = p - 28
        elif c.isspace():
            table[p] = 2
        elif c.isalpha():
            table[p] = 3
    return table


CLASSES = _class_table()
INPUTS = 100


def classes_of(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    return np.where(points < len(CLASSES), CLASSES[np.minimum(points, len(CLASSES) - 1)], 3)


@dataclass
class Tagger:
    """LSTM parameters and CRF transitions (tag after tag; the last row is the start)."""

    params: dict[str, np.ndarray]
    moves: np.ndarray


def _allowed() -> np.ndarray:
    """Inside tags follow only their own kind."""
    ok = np.ones((TAGS + 1, TAGS), bool)
    for k in range(len(KINDS)):
        ok[:, 2 + 2 * k] = False
        ok[[1 + 2 * k, 2 + 2 * k], 2 + 2 * k] = True
    return ok


def crf_marginals(scores: np.ndarray, moves: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over padded rows: tag marginals (0 on padding) and expected transition counts.

    Works on probabilities that are rescaled to sum to 1 at every step.
    """
    rows, steps, n = scores.shape
    step = np.exp(scores - scores.max(2, keepdims=True))
    move = np.exp(moves)
    real = np.arange(steps)[None, :] < lengths[:, None]
    ahead, behind, size = np.empty_like(step), np.ones_like(step), np.ones((rows, steps, 1))
    for t in range(steps):
        x = (move[n] if t == 0 else ahead[:, t - 1] @ move[:n]) * step[:, t]
        size[:, t] = x.sum(1, keepdims=True) + 1e-300
        ahead[:, t] = x / size[:, t]
    for t in range(steps - 2, -1, -1):
        x = (step[:, t + 1] * behind[:, t + 1] / size[:, t + 1]) @ move[:n].T
        behind[:, t] = np.where(real[:, t + 1][:, None], x, 1.0)
    tags = ahead * behind * real[:, :, None]
    pairs = np.zeros((n + 1, n))
    for t in range(1, steps):
        pairs[:n] += move[:n] * (ahead[:, t - 1].T @ (real[:, t][:, None] * step[:, t] * behind[:, t] / size[:, t]))
    pairs[n] = tags[:, 0].sum(0)
    return tags, pairs


def viterbi(scores: np.ndarray, moves: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The best tag path of every padded row."""
    rows, steps, n = scores.shape
    best = scores[:, 0] + moves[n]
    back = np.zeros((rows, steps, n), np.int8)
    for t in range(1, steps):
        options = best[:, :, None] + moves[None, :n]
        back[:, t] = options.argmax(1)
        step = options.max(1) + scores[:, t]
        best = np.where((t < lengths)[:, None], step, best)
        back[:, t] = np.where((t < lengths)[:, None], back[:, t], np.arange(n))
    path = np.empty((rows, steps), np.int8)
    path[:, -1] = best.argmax(1)
    for t in range(steps - 1, 0, -1):
        path[:, t - 1] = back[np.arange(rows), t, path[:, t]]
    return path


def _one_hot(classes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(c) for c in classes])
    x = np.zeros((len(classes), lengths.max(), INPUTS), np.float32)
    for r, c in enumerate(classes):
        x[r, np.arange(len(c)), c] = 1.0
    return x, lengths


def written_otherwise(kind: int, text: str, rng: np.random.Generator) -> str:
    """A variant that the base pattern misses but a reader would know for the same thing."""
    if kind == 0:
        name, _, domain = text.partition("@")
        at = (" @ ", "(at)", " [at] ", "@ ", "(@)")[rng.integers(5)]
        return f"{name}{at}{domain.replace('.', (' . ', '.', '[dot]', '(dot)')[rng.integers(4)])}"
    digits = re.sub(r"\D", "", text)
    if kind == 1:
        return (". ", "[.]", " . ", "(.)")[rng.integers(4)].join(text.split("."))
    if kind == 2:
        return (".", "  ", "/", "_")[rng.integers(4)].join(digits[i : i + 4] for i in range(0, len(digits), 4))
    local = digits[-10:]
    return ("({}) {}-{}", "{}-{}-{}", "{}.{}.{}", "00{} {} {}")[rng.integers(4)].format(local[:3], local[3:6], local[6:])


def training_windows(texts: list[str], rng: np.random.Generator) -> list[tuple[np.ndarray, np.ndarray]]:
    """Windows with tags: around every base span as it is and as a variant, and around other digits."""
    out: list[tuple[np.ndarray, np.ndarray]] = []

    def add(text: str, spans: list[Span], start: int):
        piece = text[start : start + WINDOW]
        tags = np.zeros(len(piece), np.int64)
        for kind, a, b in spans:
            a, b = max(a - start, 0) if a >= start else None, b - start
            if a is None or b > len(piece):
                a, b = max((a or 0), 0), min(max(b, 0), len(piece))
            if a < b:
                tags[a:b] = 2 + 2 * kind
                tags[a] = 1 + 2 * kind
        if len(piece):
            out.append((classes_of(piece), tags))

    for text in texts:
        spans = base_spans(text)
        # A card pattern may lie inside a phone's or address's digits; the first kind keeps the characters.
        taken: list[Span] = []
        for s in spans:
            if all(s[2] <= o[1] or s[1] >= o[2] for o in taken):
                taken.append(s)
        for kind, a, b in taken:
            for _ in range(2):
                add(text, taken, max(0, a - int(rng.integers(WINDOW // 2 + 1))))
            for _ in range(2):
                made = written_otherwise(kind, text[a:b], rng)
                other = text[:a] + made + text[b:]
                add(other, [(kind, a, a + len(made))], max(0, a - int(rng.integers(WINDOW // 3))))
        others = [m.start() for m in SIGNAL.finditer(text) if all(not o[1] <= m.start() < o[2] for o in taken)]
        for at in others[:: max(1, len(others) // 3)][:4]:
            add(text, taken, max(0, at - int(rng.integers(WINDOW))))
    return [out[i] for i in rng.permutation(len(out))[:TRAIN_WINDOWS]]


def train(texts: list[str], seed: int = 5) -> Tagger:
    rng = np.random.default_rng(seed)
    moves = np.where(_allowed(), 0.0, -1e4)
    tagger = Tagger(nn.init_bilstm(rng, INPUTS, HIDDEN, TAGS), moves)
    windows = training_windows(texts, rng)
    weights = {**tagger.params, "moves": moves}
    adam = nn.Adam(weights, 0.02)
    if windows:
        order = np.concatenate([rng.permutation(len(windows)) for _ in range(-(-STEPS * BATCH // len(windows)))])
        for begin in range(0, STEPS * BATCH, BATCH):
            part = [windows[i] for i in order[begin : begin + BATCH]]
            x, lengths = _one_hot([c for c, _ in part])
            scores, cache = nn.forward(tagger.params, x, lengths, keep=True)
            tags, pairs = crf_marginals(scores.astype(float), moves, lengths)
            gold_pairs = np.zeros_like(pairs)
            for r, (_, y) in enumerate(part):
                tags[r, np.arange(len(y)), y] -= 1.0
                np.add.at(gold_pairs, (y[:-1], y[1:]), 1.0)
                gold_pairs[TAGS, y[0]] += 1.0
            grads = nn.backward(tagger.params, cache, (tags / len(part)).astype(np.float32))
            grads["moves"] = np.where(_allowed(), (pairs - gold_pairs) / len(part), 0.0)
            adam.update(grads)
    return tagger


def window_numbers(text: str) -> list[int]:
    """Numbers of the overlapping windows that hold a digit, an ``@`` or a bracketed ``at`` or ``dot``; every span that
    the model is trained to add has one, so other windows hold nothing unless a span reaches into them."""
    final = final_window(text)
    hits = {m.start() // STRIDE for m in WRITTEN.finditer(text)}
    return sorted({min(max(0, h - back), final) for h in hits for back in (0, 1)})


def final_window(text: str) -> int:
    return max(0, -(-(len(text) - WINDOW) // STRIDE))


def window_start(text: str, number: int) -> int:
    """The grid's windows, the last one pulled back to the text's end."""
    return min(number * STRIDE, max(0, len(text) - WINDOW))


def window_starts(text: str) -> list[int]:
    return [window_start(text, i) for i in window_numbers(text)]


@dataclass
class Piece:
    """Windows ``first`` to ``last`` of a text, part of a run that goes to ``end``; spans count from ``since`` on."""

    text: int
    first: int
    last: int
    end: int
    since: int = 0


def run_pieces(index: int, text: str) -> list[Piece]:
    """The runs of windows that overlap, each by its first piece."""
    out: list[Piece] = []
    for i in window_numbers(text):
        if out and i <= out[-1].end + 1:
            out[-1].end = i
        else:
            out.append(Piece(index, i, i, i))
    for piece in out:
        piece.last = min(piece.end, piece.first + PIECE - 1)
    return out


def spans_on(path: np.ndarray, sure: np.ndarray) -> Iterator[tuple[float, int, int, int]]:
    """Spans of a tag path: mean probability of the characters' tags, kind, start, end."""
    for a in np.flatnonzero((path > 0) & (path % 2 == 1)):
        b = a + 1
        while b < len(path) and path[b] == path[a] + 1:
            b += 1
        yield float(sure[np.arange(a, b), path[a:b]].mean()), int(path[a]) // 2, int(a), int(b)


def window_scores(
    tagger: Tagger, texts: list[str], pieces: list[Piece], out: list[list[tuple[float, Span]]]
) -> list[np.ndarray]:
    """Adds to ``out``, per text, the spans that lie whole in a window of a piece, and returns per piece its
    characters' tag scores: the mean over the windows that hold the character, weighted by its distance from the
    window's cut edges."""
    begins = [window_start(texts[p.text], p.first) for p in pieces]
    ends = [min(len(texts[p.text]), window_start(texts[p.text], p.last) + WINDOW) for p in pieces]
    total = [np.zeros((b - a, TAGS)) for a, b in zip(begins, ends)]
    weight = [np.zeros((b - a, 1)) for a, b in zip(begins, ends)]
    places = [(r, window_start(texts[p.text], i)) for r, p in enumerate(pieces) for i in range(p.first, p.last + 1)]
    for begin in range(0, len(places), 512):
        part = places[begin : begin + 512]
        x, lengths = _one_hot([classes_of(texts[pieces[r].text][s : s + WINDOW]) for r, s in part])
        scores = nn.forward(tagger.params, x, lengths)[0].astype(float)
        paths = viterbi(scores, tagger.moves, lengths)
        sure = crf_marginals(scores, tagger.moves, lengths)[0]
        for j, ((r, s), own, n) in enumerate(zip(part, scores, lengths)):
            text, n = pieces[r].text, int(n)
            opens, closes = s == 0, s + n == len(texts[text])
            for p, kind, a, b in spans_on(paths[j, :n], sure[j]):
                if (a > 0 or opens) and (b < n or closes):
                    out[text].append((p, (kind, s + a, s + b)))
            at = np.arange(n)
            left = np.full(n, WINDOW) if opens else at + 1
            right = np.full(n, WINDOW) if closes else n - at
            w = np.minimum(left, right)[:, None]
            total[r][s - begins[r] : s - begins[r] + n] += w * own[:n]
            weight[r][s - begins[r] : s - begins[r] + n] += w
    return [t / w for t, w in zip(total, weight)]


def in_one_window(piece: Piece, text: str, a: int, b: int) -> bool:
    """Whether a window of the piece holds the span without cutting its edges."""
    for i in range(max(piece.first, a // STRIDE - 1), min(piece.last, a // STRIDE + 1) + 1):
        s = window_start(text, i)
        if (s < a or s == 0) and (b < s + WINDOW or s + WINDOW >= len(text)):
            return True
    return False


def decoded(
    tagger: Tagger, texts: list[str], pieces: list[Piece], out: list[list[tuple[float, Span]]]
) -> Iterator[Piece]:
    """Adds to ``out``, per text, the spans of the pieces, with the mean probability of their characters: those that a
    window holds whole as the window decodes them, longer ones from the joined scores.  Yields the pieces that are to
    follow: a wider one if a span reaches over a piece's edge, or the next of its run."""
    each = window_scores(tagger, texts, pieces, out)
    lengths = np.array([len(x) for x in each])
    scores = np.zeros((len(each), lengths.max(), TAGS))
    for r, x in enumerate(each):
        scores[r, : len(x)] = x
    paths = viterbi(scores, tagger.moves, lengths)
    sure = crf_marginals(scores, tagger.moves, lengths)[0]
    for r, piece in enumerate(pieces):
        text, n = texts[piece.text], int(lengths[r])
        path, start = paths[r, :n], window_start(text, piece.first)
        grow = max(1, (piece.last - piece.first + 1) // 2)
        if start > piece.since and path[0] > 0:  # only a run's first piece can begin within a span
            back = Piece(piece.text, max(0, piece.first - grow), piece.last, piece.end, piece.since)
            yield back
            continue
        stop, follow = n, None
        if start + n < len(text) and (path[-1] > 0 or piece.last < piece.end):
            # What follows begins at the last outside character that has half a window after it.
            outside = np.flatnonzero(path[: max(0, n - STRIDE // 2)] == 0)
            outside = outside[start + outside > piece.since]
            end = piece.end if piece.last < piece.end else min(final_window(text), piece.last + grow)
            first = (start + int(outside[-1])) // STRIDE - 1 if len(outside) else 0
            if first > piece.first and piece.last - piece.first + 1 >= PIECE:
                stop = int(outside[-1])
                follow = Piece(piece.text, first, min(max(first + PIECE - 1, piece.last + 1), end), end, start + stop)
            else:  # a short piece, or one long span
                stop, follow = 0, Piece(piece.text, piece.first, min(end, piece.last + grow), end, piece.since)
        for p, kind, a, b in spans_on(path, sure[r]):
            a, b = start + a, start + b
            if piece.since <= a < start + stop and not in_one_window(piece, text, a, b):
                out[piece.text].append((p, (kind, a, b)))
        if follow:
            yield follow


def found_spans(tagger: Tagger, texts: list[str]) -> list[list[tuple[float, Span]]]:
    """Per text, the spans that its runs of windows decode, with the mean probability of their characters."""
    out: list[list[tuple[float, Span]]] = [[] for _ in texts]
    waiting = [p for i, t in enumerate(texts) for p in run_pieces(i, t)]
    while waiting:
        waiting.sort(key=lambda p: p.last - p.first)
        following: list[Piece] = []
        while waiting:
            part = [waiting.pop(0)]
            while waiting and (len(part) + 1) * ((waiting[0].last - waiting[0].first) * STRIDE + WINDOW) <= CELLS:
                part.append(waiting.pop(0))
            following += decoded(tagger, texts, part, out)
        waiting = following
    best = [{span: p for p, span in sorted(x)} for x in out]
    return [sorted(((p, span) for span, p in x.items()), key=lambda f: f[1][1:]) for x in best]


def reconciled(base: list[Span], found: list[tuple[float, Span]], sure: float = SURE) -> list[Span]:
    """Base spans stay; of what the windows add, the surest spans win over those that they overlap.

    A span counts once however many windows see it, needs a mean probability
    of ``sure`` and must not overlap a base span.  Ties go to the earlier, then
    the longer span.
    """
    taken = list(base)
    for p, span in sorted(set(found), key=lambda x: (-x[0], x[1][1], -x[1][2])):
        if p >= sure and all(span[2] <= o[1] or span[1] >= o[2] for o in taken):
            taken.append(span)
    return sorted(taken)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def train_on(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = TRAIN_DOCS) -> Tagger:
    """The tagger, trained on the ``limit`` documents with a digit or ``@`` that come first by the hash of their id."""
    usable = docs.where(F.col(text_col).rlike("[0-9@]") & (F.length(text_col) < TRAIN_CHARS))
    return train(first_by_hash(usable, id_col, text_col, limit))


def find_personal_data(docs: DataFrame, tagger: Tagger, text_col: str = "text", sure: float = SURE) -> DataFrame:
    """``docs`` with ``base`` and ``all``: arrays of ``kind, start, end`` (code points, end exclusive).

    Rows are independent and texts are read whole.  Defined cases: a null,
    empty or clean text has empty arrays; copies get equal results; columns
    already called ``base`` or ``all`` are replaced; all others stay.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tagger)
    spans = "array<struct<kind:string,start:int,end:int>>"

    @F.pandas_udf(f"base {spans}, all {spans}")
    def detect(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        def rows(values: list[Span]) -> list[dict]:
            return [{"kind": KINDS[k], "start": a, "end": b} for k, a, b in values]

        for part in parts:
            base_out, all_out = [], []
            for begin in range(0, len(part), 512):
                texts = [t or "" for t in part.iloc[begin : begin + 512]]
                for text, found in zip(texts, found_spans(shared.value, texts)):
                    base = base_spans(text)
                    base_out.append(rows(base))
                    all_out.append(rows(reconciled(base, found, sure)))
            yield pd.DataFrame({"base": base_out, "all": all_out})

    kept = docs.drop("base", "all").withColumn("_found", detect(F.col(text_col)))
    return kept.select(*[kept[c] for c in kept.columns if c != "_found"], "_found.base", "_found.all")


def redact(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind in brackets."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"[{KINDS[kind]}]"]
            at = b
    return "".join([*out, text[at:]])


def spans_digest(spans: list[Span]) -> str:
    return hashlib.sha256(joined(spans).encode()).hexdigest()
