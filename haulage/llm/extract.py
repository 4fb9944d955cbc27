"""Main-text extraction from HTML: a bidirectional LSTM labels every leaf block of a page in its context."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulage.llm import nn
from haulage.llm.common import first_by_hash

PATH_DIMS, WORD_DIMS, SHAPE_DIMS = 128, 48, 6
INPUTS = PATH_DIMS + WORD_DIMS + SHAPE_DIMS
HIDDEN = 20
TRAIN_PAGES = 240  # pages that the labeller is trained on
VARIANTS = 6  # rebuilt layouts of each of them
EPOCHS = 6
LONGEST = 64  # blocks of a training sequence; pages are labelled whole
CACHE = 200_000

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style noscript template title textarea select svg math iframe object canvas audio video head".split())
RAW = frozenset("script style textarea title iframe noscript".split())
INLINE = frozenset(
    "a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr br img".split()
)
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
ENDS_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
# Elements and class or id words that mark what is around an article; they label the training pages.
AROUND_TAGS = frozenset("nav header footer aside form button menu dialog".split())
AROUND_WORDS = frozenset(
    "ad ads advert advertisement banner sponsor promo sidebar menu nav navbar navigation breadcrumb breadcrumbs header footer notice cookie consent popup modal alert comment comments reply replies related share social subscribe newsletter form login search widget".split()
)

MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)|"""
    r"""<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<rest>(?:[^<>"']++|"[^"]*+"|'[^']*+')*+)(?:>|(?=<)|\Z)|"""
    r"""<(?P<end2>/?)(?P<tag2>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<rest2>[^>]*+)(?:>|\Z)""",
    re.S,
)
NAMED = re.compile(r"""\b(class|id|role)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++))""", re.I)
PART = re.compile(r"[a-z]+")


@dataclass(frozen=True)
class Element:
    tag: str
    words: tuple[str, ...]  # of its class, id and role


@dataclass
class Block:
    path: tuple[Element, ...]
    text: str
    linked: float  # share of its characters inside links


def _element(tag: str, rest: str) -> Element:
    found = NAMED.findall(rest) if "=" in rest else ()
    return Element(tag, tuple(w for _, *values in found for w in PART.findall("".join(values).lower())))


def blocks_of(html: str | None) -> list[Block]:
    """The page's leaf blocks in order.  Character references are decoded and white space becomes single spaces;
    scripts, styles, comments and other markup hold no text.  Unclosed and stray tags are tolerated."""
    out: list[Block] = []
    stack: list[Element] = []
    pieces: list[str] = []
    linked = 0

    def flush():
        nonlocal linked
        if pieces:
            text = " ".join(unescape("".join(pieces)).split())
            if text:
                raw = sum(map(len, pieces))
                out.append(Block(tuple(e for e in stack if e.tag not in INLINE), text, min(1.0, linked / max(1, raw))))
            pieces.clear()
        linked = 0

    def add(text: str):
        nonlocal linked
        if text:
            if any(e.tag in SILENT for e in stack):
                return
            pieces.append(text)
            if any(e.tag == "a" for e in stack):
                linked += len(text)

    html, at = html or "", 0
    while match := MARKUP.search(html, at):
        add(html[at : match.start()])
        at = match.end()
        tag = (match["tag"] or match["tag2"] or "").lower()
        if not tag:
            continue
        if tag in ("html", "body"):
            flush()
            continue
        inline = tag in INLINE
        if match["end"] or match["end2"]:
            if any(e.tag == tag for e in stack):
                if not inline:
                    flush()
                while stack.pop().tag != tag:
                    pass
            continue
        if not inline:
            flush()
            for closing in CLOSES.get(tag, ()) or (("p",) if tag in ENDS_P else ()):
                depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i].tag == closing), None)
                fence = next((i for i in range(len(stack) - 1, -1, -1) if stack[i].tag in ("ul", "ol", "dl", "table", "article", "section", "div") and stack[i].tag != closing), -1)
                if depth is not None and depth > fence:
                    del stack[depth:]
        elif tag == "br":
            add(" ")
        rest = match["rest"] or match["rest2"] or ""
        if tag in VOID or rest.endswith("/"):
            continue
        stack.append(_element(tag, rest))
        if tag in RAW:
            closing = re.compile(rf"</{tag}\b[^>]*+(?:>|\Z)", re.I).search(html, at)
            at = closing.end() if closing else len(html)
            stack.pop()
    add(html[at:])
    flush()
    return out


def around(block: Block) -> bool:
    """The label of a training block: whether its element path says that it stands around the article."""
    return any(e.tag in AROUND_TAGS or not AROUND_WORDS.isdisjoint(e.words) for e in block.path)


class Features:
    """Vectors of blocks: hashed tag path, hashed words and shape, with bounded caches."""

    def __init__(self):
        self.paths: dict[tuple[Element, ...], np.ndarray] = {}
        self.words: dict[str, int] = {}

    def _path(self, path: tuple[Element, ...]) -> np.ndarray:
        vector = self.paths.get(path)
        if vector is None:
            if len(self.paths) > CACHE // 20:
                self.paths.clear()
            vector = np.zeros(PATH_DIMS, np.float32)
            for depth, e in enumerate(reversed(path[-12:])):
                names = [e.tag, *(f".{w}" for w in e.words), f"{min(depth, 3)}:{e.tag}"]
                for name in names:
                    for salt in (0, 1):
                        h = zlib.crc32(f"{salt}{name}".encode())
                        vector[h % PATH_DIMS] += 1.0 if h & 0x10000 else -1.0
            vector = self.paths[path] = np.clip(vector, -2, 2)
        return vector

    def __call__(self, blocks: list[Block]) -> np.ndarray:
        out = np.zeros((len(blocks), INPUTS), np.float32)
        if len(self.words) > CACHE:
            self.words.clear()
        ids, owner = [], []
        for i, block in enumerate(blocks):
            tokens = block.text.lower().split()
            for t in tokens:
                h = self.words.get(t)
                if h is None:
                    h = self.words[t] = zlib.crc32(t.encode("utf-8", "replace")) % WORD_DIMS
                ids.append(h)
            owner.append(len(tokens))
            out[i, :PATH_DIMS] = self._path(block.path)
            last = block.text[-1]
            out[i, -SHAPE_DIMS:] = (
                np.log1p(len(tokens)) / 4,
                block.linked,
                len(tokens) < 4,
                last in ".!?",
                i / len(blocks),
                len(tokens) > 25,
            )
        flat = np.repeat(np.arange(len(blocks)), owner) * WORD_DIMS + np.array(ids, np.int64)
        counts = np.bincount(flat, minlength=len(blocks) * WORD_DIMS).reshape(len(blocks), WORD_DIMS)
        out[:, PATH_DIMS : PATH_DIMS + WORD_DIMS] = counts / np.maximum(np.sqrt((counts**2).sum(1, keepdims=True)), 1)
        return out


def variant(blocks: list[Block], spare: list[str], rng: np.random.Generator) -> tuple[list[Block], np.ndarray]:
    """Another layout for the same article: its blocks in some usual container, with blocks of other pages around it.

    What a training page's own markup calls the article stays 0; menus,
    headers, sidebars, notices, adverts, forms, reader comments and footers are
    put around it and are 1.
    """

    def pick(*options):
        return options[rng.integers(len(options))]

    def made(tag: str, words: tuple[str, ...], leaf: str, count: int, short: bool, linked: float = 0.0) -> list[Block]:
        path = [Element(tag, words)]
        if rng.random() < 0.3:
            path.append(Element("div", ()))
        if leaf == "li":
            path.append(Element("ul", ()))
        path.append(Element(leaf, ()))
        texts = [spare[rng.integers(len(spare))] for _ in range(count)]
        return [Block(tuple(path), " ".join(t.split()[: 1 + rng.integers(3)]) if short else t, linked) for t in texts]

    article = [b for b in blocks if not around(b)]
    words = (("content",), ("post", "body"), ("article", "content"), ("main",), ("entry",), ("story", "text"), ("body",), ("text",), ())
    shell = pick(
        (Element("article", ()),),
        (Element("main", ()),),
        (Element("main", ()), Element("article", ())),
        (Element("div", pick(*words)),),
        (Element("section", pick(*words)),),
        (Element("div", pick(*words)), Element("div", pick(*words))),
        (Element("article", pick(*words)), Element("div", pick(*words))),
    )
    plain = rng.random() < 0.4

    def leaf(block: Block) -> tuple[Element, ...]:
        tag = block.path[-1].tag if block.path else "p"
        if re.fullmatch("h[1-6]", tag):
            return (Element(pick("h1", "h2", "h3"), ()),)
        if plain:
            return (Element("p", ()),)
        tags = pick(("p",), ("p",), ("p",), ("div",), ("ul", "li"), ("ol", "li"), ("table", "tr", "td"), ("blockquote",), ("blockquote", "p"), ("section", "p"), ("h2",), ("pre",), ("figure", "figcaption"), ())
        return tuple(Element(t, ()) for t in tags)

    # Whole texts, and now and then a few words of one, as list points, cells and headings have.
    inside = [
        Block((*shell, *leaf(b)), " ".join(b.text.split()[: 1 + rng.integers(6)]) if not plain and rng.random() < 0.25 else b.text, b.linked)
        for b in article
    ]
    n = rng.integers
    before = [
        made("nav", pick((), ("menu",), ("navbar",)), "li", n(2, 8), True, 1.0),
        made("header", pick((), ("site", "header")), pick("div", "p", "h2"), n(1, 3), True),
        made("div", pick(("ad",), ("advert",), ("banner",), ("promo",)), pick("div", "p"), n(1, 3), False),
        made("div", pick(("notice",), ("cookie", "notice"), ("alert",), ("consent",)), pick("p", "div"), n(1, 3), False),
        made("ul", pick(("menu",), ("breadcrumb",), ("nav",)), "li", n(2, 6), True, 1.0),
        made("form", pick((), ("search",), ("login", "form")), pick("div", "p", "label"), n(1, 4), True),
    ]
    after = [
        made("aside", pick((), ("sidebar",), ("related",)), pick("p", "li", "div"), n(1, 5), rng.random() < 0.4),
        made("div", pick(("sidebar",), ("widget",), ("related",), ("share",)), pick("p", "li"), n(1, 5), rng.random() < 0.5),
        made(pick("section", "div"), pick(("comments",), ("comment", "list"), ("replies",), ("user", "comments")), pick("p", "div", "li"), n(1, 6), False),
        made("form", pick((), ("comment", "form"), ("newsletter", "subscribe")), pick("p", "div", "label"), n(1, 3), rng.random() < 0.5),
        made("footer", pick((), ("site", "footer")), pick("p", "div", "li"), n(1, 4), rng.random() < 0.5),
        made("div", pick(("footer",), ("ad",), ("subscribe",), ("popup",)), pick("p", "div"), n(1, 3), False),
    ]
    chosen = [x for x in before if rng.random() < 0.5], [x for x in after if rng.random() < 0.5]
    middle = made("div", pick(("ad",), ("promo",), ("related",), ("notice",)), "p", 1, False) if rng.random() < 0.3 else []
    if middle:
        middle = [Block((*shell, *b.path), b.text, b.linked) for b in middle]
    cut = rng.integers(len(inside) + 1)
    parts = [*((x, 1) for x in chosen[0]), (inside[:cut], 0), (middle, 1), (inside[cut:], 0), *((x, 1) for x in chosen[1])]
    page = (Element("div", pick((), ("page",), ("wrapper",), ("container",))),) if rng.random() < 0.5 else ()
    flat = [Block((*page, *b.path), b.text, b.linked) for x, _ in parts for b in x]
    return flat, np.array([y for x, y in parts for _ in x], np.float32)


def train(pages: list[str], seed: int = 7) -> dict[str, np.ndarray]:
    """Train the labeller on a bounded list of pages: their own layout, labelled by ``around``, and rebuilt ones."""
    rng = np.random.default_rng(seed)
    params = nn.init_bilstm(rng, INPUTS, HIDDEN, 1)
    parsed = [b for b in map(blocks_of, pages) if b]
    spare = [b.text for blocks in parsed for b in blocks if len(b.text) < 2000]
    if not spare:
        return params
    features, examples = Features(), []
    for blocks in parsed:
        sets = [(blocks, np.array([around(b) for b in blocks], np.float32))]
        sets += [variant(blocks, spare, rng) for _ in range(VARIANTS)]
        for flat, labels in sets:
            x = features(flat) if flat else np.zeros((0, INPUTS), np.float32)
            examples += [(x[i : i + LONGEST], labels[i : i + LONGEST]) for i in range(0, len(labels), LONGEST)]
    adam = nn.Adam(params, 0.01)
    for _ in range(EPOCHS):
        order = sorted(rng.permutation(len(examples)), key=lambda i: len(examples[i][1]) // 8)
        groups = [order[i : i + 32] for i in range(0, len(order), 32)]
        for g in rng.permutation(len(groups)):
            lengths = np.array([len(examples[i][1]) for i in groups[g]])
            x, y = np.zeros((len(lengths), lengths.max(), INPUTS), np.float32), np.zeros((len(lengths), lengths.max()), np.float32)
            for r, i in enumerate(groups[g]):
                x[r, : lengths[r]], y[r, : lengths[r]] = examples[i]
            scores, cache = nn.forward(params, x, lengths, keep=True)
            real = np.arange(x.shape[1])[None, :] < lengths[:, None]
            error = (1 / (1 + np.exp(-scores[:, :, 0])) - y) * real / real.sum()
            adam.update(nn.backward(params, cache, error[:, :, None].astype(np.float32)))
    return params


def label(params: dict[str, np.ndarray], pages: list[list[Block]], features: Features) -> list[np.ndarray]:
    """Per page, which blocks belong to the article.  Pages of similar length run together, each one whole."""
    out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
    order = sorted((i for i in range(len(pages)) if pages[i]), key=lambda i: len(pages[i]))
    begin = 0
    while begin < len(order):
        end, longest = begin, 0
        while end < len(order) and (end == begin or (end + 1 - begin) * len(pages[order[end]]) <= 8192):
            longest = len(pages[order[end]])
            end += 1
        group = order[begin:end]
        lengths = np.array([len(pages[i]) for i in group])
        x = np.zeros((len(group), longest, INPUTS), np.float32)
        flat = features([b for i in group for b in pages[i]])
        row = np.repeat(np.arange(len(group)), lengths)
        starts = np.r_[0, np.cumsum(lengths)[:-1]]
        step = np.arange(len(flat)) - np.repeat(starts, lengths)
        flat[:, -2] = step / np.repeat(lengths, lengths)
        x[row, step] = flat
        scores, _ = nn.forward(params, x, lengths)
        for r, i in enumerate(group):
            out[i] = scores[r, : lengths[r], 0] < 0
        begin = end
    return out


def main_texts(params: dict[str, np.ndarray], pages: list[str | None], features: Features) -> list[str]:
    parsed = [blocks_of(p) for p in pages]
    kept = label(params, parsed, features)
    return ["\n".join(b.text for b, keep in zip(blocks, k) if keep) for blocks, k in zip(parsed, kept)]


def train_on(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", limit: int = TRAIN_PAGES) -> dict[str, np.ndarray]:
    """The labeller, trained on the ``limit`` pages that come first by the hash of their id."""
    return train(first_by_hash(pages, id_col, html_col, limit))


def extract_text(pages: DataFrame, params: dict[str, np.ndarray], html_col: str = "html") -> DataFrame:
    """``pages`` with ``text`` (the article's blocks, joined by line feeds) and ``n_chars`` (its code points).

    Rows are independent and every page is read whole.  Defined cases: a null,
    empty or text-free page gives an empty text; text outside any element is a
    block like others; unclosed tags and comments run to the end of the page;
    columns already called ``text`` or ``n_chars`` are replaced; all others stay.
    """
    shared = pages.sparkSession.sparkContext.broadcast(params)

    @F.pandas_udf("string")
    def article(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        features = Features()
        for part in parts:
            texts: list[str] = []
            for begin in range(0, len(part), 256):
                texts += main_texts(shared.value, part.iloc[begin : begin + 256].tolist(), features)
            yield pd.Series(texts, dtype=object)

    rows = pages.drop("text", "n_chars").withColumn("text", article(F.col(html_col)))
    return rows.withColumn("n_chars", F.length("text").cast("long"))
