"""Extraction, personal data, licenses, language models and neighbours."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from haulage.llm import ann, extract, language, license, lm, nn, pii
from haulage.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def _table(name, sf=SF):
    return duckdb.sql(f"SELECT * FROM read_parquet('{sf}/{name}.parquet')").df()


# HTML ----------------------------------------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>if (a<b) "</p>"</script></head><body>
<header class="site-header"><p>Welcome to this site</p></header><nav><ul><li><a href=a>Home</a></li><li><a href=b>News</a></li></ul></nav>
<div class="ad">Buy now</div><!-- <p>hidden</p> --><article><h1>A &amp; B</h1><p>First   para&shy;graph
of the <b>article</b>, which is long enough to read.<p>Second paragraph of the article, also of some length.</p></article>
<section id="comments"><div class="comment"><p>I liked it very much, thanks.</p></div></section>
<form><label>Mail</label></form><aside class="sidebar"><p>Popular posts</p></aside><footer>&copy; me</footer>"""


def test_blocks_decode_and_survive_bad_markup():
    texts = lambda h: [b.text for b in extract.blocks_of(h)]
    assert texts("<p>a<p>b <i>c</i>\n d&amp;e<br>f<li>g<li>h") == ["a", "b c d&e f", "g", "h"]
    assert texts('<div title="a>b">x</div><script>y</script z>w<!-- never closed <p>v') == ["x", "w"]
    assert texts("a < b and 3<4 <p class='x>c") == ["a < b and 3<4", "c"]
    assert texts(None) == texts("") == texts("<p> \n </p>") == [] and texts("plain") == ["plain"]
    assert texts("<p>" * 3000 + "deep" + "</div>" * 50) == ["deep"]


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    params = {k: v.astype(np.float64) for k, v in nn.init_bilstm(rng, 3, 4, 2).items()}
    x, lengths = rng.normal(size=(2, 5, 3)), np.array([5, 3])
    weight = rng.normal(size=(2, 5, 2)) * (np.arange(5)[None, :] < lengths[:, None])[:, :, None]
    scores, cache = nn.forward(params, x, lengths, keep=True)
    grads = nn.backward(params, cache, weight)
    for name in params:
        at = tuple(rng.integers(s) for s in params[name].shape)
        step = 1e-2
        old = params[name][at]
        params[name][at] = old + step
        up = (nn.forward(params, x, lengths)[0] * weight).sum()
        params[name][at] = old - step
        down = (nn.forward(params, x, lengths)[0] * weight).sum()
        params[name][at] = old
        assert grads[name][at] == pytest.approx((up - down) / (2 * step), abs=0.02, rel=0.05)


def test_extraction_keeps_the_article(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    labeller = extract.train_on(pages)
    rows = [(1, PAGE, "keep"), (2, None, "a"), (3, "", "b"), (3, "", "b"), (None, "<script>x</script>", "c"), (5, "<p>z" * 400, None)]
    df = spark.createDataFrame(rows, "page_id long, html string, text string")
    got = extract.extract_text(df, labeller).collect()
    assert len(got) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in got)
    by_id = {r["page_id"]: r["text"] for r in got}
    assert by_id[2] == by_id[3] == by_id[None] == ""
    assert by_id[1].split("\n") == [
        "A & B",
        "First para­graph of the article, which is long enough to read.",
        "Second paragraph of the article, also of some length.",
    ]
    assert extract.extract_text(df.limit(0), labeller).count() == 0
    extract.train([])  # nothing to learn from is no error


def test_extraction_query_matches_article_elements(spark):
    pages = _table("pages")
    got = {r["page_id"]: r["text"] for r in QUERIES["op1_html_extraction"](spark, SF).collect()}
    wrong = 0
    for page_id, html in zip(pages.page_id, pages.html):
        inside = [b.text for b in extract.blocks_of(html) if any(e.tag == "article" for e in b.path)]
        wrong += got[page_id] != "\n".join(inside)
    assert len(got) == len(pages) and wrong <= 0.01 * len(pages)


# Personal data -------------------------------------------------------------------------------------------------------


def _naive_spans(text):
    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append((1, *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        if 13 <= len(re.sub("[ -]", "", m.group())) <= 19 and pii.luhn(re.sub("[ -]", "", m.group())):
            out.append((2, *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.findall("[0-9]", m.group())) <= 15:
            out.append((3, *m.span()))
    return out


def test_base_spans_match_the_patterns():
    rng = random.Random(3)
    parts = ["4111111111111111", "4111-1111 1111-1111", "1.2.3.4", "256.1.1.1", "+1 (212) 555-0199", "a.b@c.de", "@", ".", " ", "-", "é", "7"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(9)))
        assert pii.base_spans(text) == _naive_spans(text), text
        text = "".join(rng.choice("a@.-1 +(0)2%5_9") for _ in range(rng.randrange(40)))
        assert pii.base_spans(text) == _naive_spans(text), text
    assert pii.base_spans(None) == pii.base_spans("") == []
    long = "a" * 200_000 + "1" * 200_000 + "@" * 1000
    assert pii.base_spans(long) == []  # in linear time


def test_crf_marginals_and_viterbi_match_enumeration():
    import itertools

    rng = np.random.default_rng(1)
    scores, moves = rng.normal(size=(1, 4, 3)), rng.normal(size=(4, 3))
    paths = list(itertools.product(range(3), repeat=4))
    value = [moves[3, p[0]] + sum(scores[0, t, p[t]] for t in range(4)) + sum(moves[p[t - 1], p[t]] for t in range(1, 4)) for p in paths]
    weight = np.exp(value) / np.exp(value).sum()
    tags, pairs = pii.crf_marginals(scores, moves, np.array([4]))
    assert tags[0, 2, 1] == pytest.approx(sum(w for p, w in zip(paths, weight) if p[2] == 1))
    assert pairs[0, 2] == pytest.approx(sum(w * sum(p[t - 1] == 0 and p[t] == 2 for t in range(1, 4)) for p, w in zip(paths, weight)))
    assert tuple(pii.viterbi(scores, moves, np.array([4]))[0]) == paths[int(np.argmax(value))]
    padded = np.concatenate([scores, rng.normal(size=(1, 3, 3))], axis=1)
    again, _ = pii.crf_marginals(padded, moves, np.array([4]))
    assert np.allclose(again[:, :4], tags) and not again[:, 4:].any()


def test_windows_cover_every_signal():
    rng = random.Random(6)
    for _ in range(200):
        n = rng.randrange(1, 700)
        text = "".join(rng.choice("aaaaaaaaaaaaaaaaaaaaaaaaaaaaa1") for _ in range(n))
        starts = pii.window_starts(text)
        for m in re.finditer("1", text):
            assert any(s <= m.start() < s + pii.WINDOW for s in starts)
    assert not pii.window_starts("no signal at all")


def test_reconciliation_is_global():
    base = [(0, 10, 20)]
    found = [(0.99, (3, 30, 40)), (0.97, (2, 35, 50)), (0.99, (0, 15, 25)), (0.99, (3, 30, 40)), (0.2, (1, 60, 70))]
    assert pii.reconciled(base, found) == [(0, 10, 20), (3, 30, 40)]
    assert pii.redact("my mail a@b.cd ok", [(0, 8, 14)]) == "my mail [email] ok"


def test_personal_data_query(spark, docs):
    table = _table("documents")
    got = {r["doc_id"]: r for r in QUERIES["op4_personal_data"](spark, SF).collect()}
    added = 0
    for i, text in zip(table.doc_id, table.text):
        base = _naive_spans(text)
        digest = hashlib.sha256(pii.joined(base).encode()).hexdigest()
        assert got[i]["base_sha256"] == digest
        assert [got[i][f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == n for s in base) for n in range(4)]
        assert set(pii.joined(base).split(",")) <= set(got[i]["spans"].split(","))
        added += got[i]["n_added"]
    assert len(got) == len(table) and added <= 0.05 * len(table)
    tagger = pii.train([])
    rows = [(1, None), (None, ""), (2, "x"), (2, "x"), (3, "é 1.2.3.4 " * 500)]
    found = pii.find_personal_data(docs(rows).selectExpr("*", "1 AS base"), tagger).collect()
    assert [len(r["base"]) for r in sorted(found, key=lambda r: len(r["text"] or ""))] == [0, 0, 0, 0, 500]
    assert pii.find_personal_data(docs([]), tagger).count() == 0


def test_tagger_learns_variants():
    table = _table("documents", "/root/testdata/sf0.01")
    texts = [t for t in table.text if re.search("[0-9@]", t) and len(t) < 20_000]
    tagger = pii.train(texts[::2])
    base = hit = 0
    for text, found in zip(texts[1::2], pii.found_spans(tagger, texts[1::2])):
        own = {s for _, s in found}
        base += len(pii.base_spans(text))
        hit += sum(s in own for s in pii.base_spans(text))
    assert base > 20 and hit >= 0.5 * base


# Licenses ------------------------------------------------------------------------------------------------------------


def test_licenses_match_brute_force(docs, spark):
    words = lambda t: re.findall(r"[^\W_]+", t.lower())
    sets = {k: {tuple(w[i : i + 5]) for i in range(len(w) - 4)} for k, t in license.TEMPLATES for w in [words(t)]}
    rng = random.Random(8)
    filler = lambda n: " ".join(rng.choice("abcdefgh") * rng.randrange(1, 9) for _ in range(n))
    rows = [(i, f"{filler(rng.randrange(40))}\n{t.upper() if i % 2 else t}. {filler(rng.randrange(900))}") for i, (_, t) in enumerate(license.TEMPLATES)]
    rows += [(90, None), (91, ""), (92, "MIT"), (93, filler(20_000)), (None, license.TEMPLATES[0][1]), (0, "repeated id")]
    got = {(r["doc_id"], r["license"]): r["containment"] for r in license.scan_licenses(docs(rows)).collect()}
    for i, (name, _) in enumerate(license.TEMPLATES):
        assert got.pop((i, name)) == 1.0
    assert got.pop((None, license.TEMPLATES[0][0])) == 1.0
    for (i, name), share in got.items():  # other templates whose own shingles are there
        held = {tuple(words(rows[i][1])[j : j + 5]) for j in range(len(words(rows[i][1])) - 4)}
        assert share >= 0.8 and len(sets[name] & held) >= 0.8 * len(sets[name])
    assert license.scan_licenses(docs([])).count() == 0
    with pytest.raises(ValueError):
        license.scan_licenses(docs([]), (("short", "MIT License"),))


def test_license_query_finds_every_notice(spark):
    table = _table("documents", "/root/testdata/sf0.01")
    notice = {"Apache-2.0": "Licensed under the Apache License, Version 2.0", "MIT": "Released under the MIT License", "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0", "GPL-3.0": "This work is licensed under the GNU General Public License, version 3"}
    want = {(i, k) for i, t in zip(table.doc_id, table.text) for k, x in notice.items() if x in t}
    got = {(r["doc_id"], r["license"]) for r in QUERIES["op5_license_scan"](spark, "/root/testdata/sf0.01").collect()}
    assert want and got == want


# Language and language models ----------------------------------------------------------------------------------------


def test_language_query_on_held_out_rows(spark):
    table = _table("documents")
    got = {r["doc_id"]: r for r in QUERIES["op7_language_id"](spark, SF).collect()}
    held = [i for i in table.doc_id if zlib.crc32(str(i).encode()) % 3 == 1]
    assert {i for i, r in got.items() if r["held_out"]} == set(held) and len(got) == len(table)
    truth = dict(zip(table.doc_id, table.lang))
    assert sum(got[i]["lang_pred"] == truth[i] for i in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_language_backs_off_to_ngrams(docs, spark):
    rows = [(i, "strasse schule wasser", "de") for i in range(20)] + [(i + 50, "street school water", "en") for i in range(20)]
    rows += [(98, None, "de"), (99, "text", None)]
    model = language.train(docs(rows))
    assert model.langs == ["de", "en"]
    seen = [(1, "Wasser!"), (2, "wasserschule"), (3, "schoolwater"), (4, "12 %"), (5, None), (6, ""), (6, ""), (None, "water " * 5000), (8, "ÇÇÇ")]
    got = language.identify(docs(seen), model)
    by_id = {r["doc_id"]: (r["lang_pred"], r["has_letter"]) for r in got.collect()}
    assert by_id == {1: ("de", True), 2: ("de", True), 3: ("en", True), 4: ("und", False), 5: ("und", False), 6: ("und", False), None: ("en", True), 8: by_id[8]}
    assert got.count() == len(seen) and language.identify(docs([]), model).count() == 0
    nothing = language.train(docs([]))
    assert {r["lang_pred"] for r in language.identify(docs(seen), nothing).collect()} == {"und"}


def test_lm_base_matches_brute_force(spark):
    table = _table("documents")
    counts = Counter()
    for i, text in zip(table.doc_id, table.text):
        if zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update([*text.encode().lower().split(), b" "])
    total, distinct = sum(counts.values()), len(counts)
    got = {r["doc_id"]: r for r in QUERIES["op6_lm_scoring"](spark, SF).collect()}
    for i, text in zip(table.doc_id, table.text):
        tokens = [*text.encode().lower().split(), b" "]
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(tokens), sum(t in counts for t in tokens), total)
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[t] + 1) / (total + distinct + 1)) for t in tokens))
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 7 == 2) and r["score"] < 0


def test_suffix_tree_matches_direct_walk(docs):
    from pyspark.sql import functions as F

    rows = [(i, t) for i, t in enumerate(["abab abab abc"] * 30 + ["ABBA", None, "", "zebra é"])]
    texts = docs(rows).select("text")
    points = Counter(ord(c) for _, t in rows for c in (t or "").encode().lower().decode())
    table = docs([(0, "x")]).sparkSession.createDataFrame([(str(p), n) for p, n in points.items()], "item string, n long")
    tree = lm.fit_tree(texts, table, 1e-3)
    nodes = {(int(d), int(c)): i for i, (d, c) in enumerate(zip(tree.depth, tree.context))}
    assert all((d - 1, c % 64 ** (d - 1)) in nodes for d, c in nodes if d) and max(d for d, _ in nodes) >= 2
    probs = 10.0**tree.logs
    probs[:, lm.OTHER] *= lm.CODE_POINTS - len(tree.alphabet)
    assert np.allclose(probs.sum(1), 1)
    states, symbol = tree.states(), {chr(p): i for i, p in enumerate(tree.alphabet)}
    for text in ("abab", "", "zz top"):
        seq = [lm.END] * 4 + [symbol.get(c, lm.OTHER) for c in text] + [lm.END]
        want = 0.0
        for t in range(4, len(seq)):
            for d in range(4, -1, -1):
                code = 0
                for s in seq[t - d : t]:
                    code = code * 64 + s
                if (d, code) in nodes:
                    want += tree.logs[nodes[d, code], seq[t]]
                    break
        flat = lm._codes(lm._symbols(text.encode(), lm._lookup(tree.alphabet)))
        assert tree.logs[states[flat // 64], flat % 64].sum() == pytest.approx(want)
    scored = lm.score_documents(docs(rows + [(None, "a"), (0, "a")]), held_out=F.col("doc_id") == 1).collect()
    assert len(scored) == len(rows) + 2 and all(math.isfinite(r["score"]) for r in scored)
    assert lm.score_documents(docs([]), held_out=F.lit(False)).count() == 0


def test_code_points_beyond_the_alphabet_keep_their_own_counts(docs):
    from pyspark.sql import functions as F

    frequent = "".join(chr(0x100 + i) for i in range(lm.OTHER))
    rest = [chr(0x4E00 + i) for i in range(70)]  # more than one digit can number
    rows = [(i, frequent * 3) for i in range(20)] + [(100 + i, c) for i, c in enumerate(rest)]
    rows += [(200 + i, rest[68] + rest[3]) for i in range(30)]
    tests = [(900, rest[68] + rest[3]), (901, rest[3] + rest[68]), (902, rest[68] + rest[5]), (903, rest[68] + chr(0x9000))]
    got = {r["doc_id"]: r["score"] for r in lm.score_documents(docs(rows + tests), F.col("doc_id") >= 900, min_gain=1e-6).collect()}
    assert got[900] > got[901] + 0.5 and got[900] > got[902] + 0.5 and got[902] > got[903] + 0.5
    assert got[100 + 68] > got[100 + 5]
    lookup = lm._lookup([ord(c) for c in frequent], [ord(c) for c in rest])
    spelled = [tuple(lm._symbols(c.encode(), lookup)[lm.DEPTH : -1]) for c in [*frequent, *rest, chr(0x9000)]]
    assert len(set(spelled)) == len(spelled) and {len(x) for x in spelled[lm.OTHER :]} == {3}
    assert (lm._lookup([97]) == lm._lookup([97], [])).all() and lm._symbols(b"az", lm._lookup([97]))[-3:].tolist() == [0, lm.OTHER, lm.END]


def _contexts_by_hand(texts, alphabet, least):
    """Every context, of any length, that gains ``least`` nats over its suffix, with its suffixes: last symbol first."""
    symbol = {chr(p): i for i, p in enumerate(alphabet)}
    counts = {}
    for text in texts:
        seq = [lm.END] + [symbol[c] for c in text] + [lm.END]
        for t in range(1, len(seq)):
            for d in range(t + 1):
                counts.setdefault(tuple(seq[t - d : t][::-1]), Counter())[seq[t]] += 1
    kept = set()
    for path, here in counts.items():
        if path:
            up, n = counts[path[:-1]], sum(here.values())
            if sum(c * math.log(c / n / (up[s] / sum(up.values()))) for s, c in here.items()) >= least:
                kept.update(path[:k] for k in range(len(path) + 1))
    return kept | {()}, counts


@pytest.mark.parametrize("part", [4_000_000, 300])
def test_contexts_of_any_length_match_a_direct_count(docs, monkeypatch, part):
    """Long contexts, through several passes, with parts that hold one context's extensions only in part."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(lm, "PART", part)
    rng = random.Random(5)
    middle = "".join(rng.choice("cdefgh ") for _ in range(45))
    texts = [a + rng.choice(["", "z", "zz"]) + middle + b for a, b in ("ax", "by") for _ in range(60)]
    texts += ["".join(rng.choice("ab") for _ in range(rng.randrange(30))) for _ in range(80)] + ["", "x", "xyxy" * 9]
    rows = list(enumerate(texts)) + [(900, "a" + middle + "x"), (901, "a" + middle + "y"), (902, "cb" + middle + "y"), (903, "qq")]
    df = docs(rows)
    points = Counter(ord(c) for t in texts for c in t)
    table = df.sparkSession.createDataFrame([(str(p), n) for p, n in points.items()], "item string, n long")
    size = sum(len(t) + 1 for t in texts)
    tree = lm.fit_tree(df.where("doc_id < 900").select("text"), table, 3.0 / size)
    kept, counts = _contexts_by_hand(texts, tree.alphabet, 3.0)
    path = lambda d, c: tuple(int(c) // 64**k % 64 for k in range(d))
    rows_of = {path(int(d), c): i for i, (d, c) in enumerate(zip(tree.depth, tree.context))}
    assert set(rows_of) == kept and max(map(len, kept)) >= 46

    probs = {}
    for p in sorted(kept, key=len):
        n = np.zeros(64)
        n[list(counts[p])] = list(counts[p].values())
        probs[p] = (n + 0.5) / (n.sum() + 32) if not p else (n + 10 * probs[p[:-1]]) / (n.sum() + 10)
    got = {r["doc_id"]: r["score"] for r in lm.score_documents(df, F.col("doc_id") >= 900, min_gain=3.0 / size).collect()}
    symbol = {chr(p): i for i, p in enumerate(tree.alphabet)}
    for i, text in rows[:900:7] + rows[-4:]:
        seq, want = [lm.END] + [symbol.get(c, lm.OTHER) for c in text] + [lm.END], 0.0
        for t in range(1, len(seq)):
            before = tuple(seq[:t][::-1])
            p = next(before[:k] for k in range(len(before), -1, -1) if before[:k] in kept)
            want += math.log10(probs[p][seq[t]]) - (seq[t] == lm.OTHER) * math.log10(lm.CODE_POINTS - len(symbol))
        assert got[i] == pytest.approx(want)
    assert got[900] > got[901] + 0.5


def test_a_context_stays_when_other_text_is_added(docs):
    def tree(rows):
        df = docs(rows).select("text")
        points = Counter(ord(c) for _, t in rows for c in t)
        return lm.fit_tree(df, df.sparkSession.createDataFrame([(str(p), n) for p, n in points.items()], "item string, n long"))

    def kept(tree):
        digit = {i: chr(p) for i, p in enumerate(tree.alphabet)}
        return {"".join(digit.get(int(c) // 64**k % 64, "?") for k in reversed(range(d))) for d, c in zip(tree.depth.tolist(), tree.context)}

    rng = random.Random(3)
    own = [(i, rng.choice(["cabbaged", "rabbagef"]) * 6) for i in range(200)]
    other = [(1000 + i, "".join(rng.choices("0123456789", k=3000))) for i in range(1000)]
    assert {"cabbage", "rabbage"} <= kept(tree(own)) & kept(tree(own + other))


def test_least_gain_grows_as_a_log():
    assert lm.least_gain(1000) == 1000 * lm.MIN_GAIN and lm.least_gain(0) == 0
    assert lm.least_gain(10**12) == pytest.approx(1.5 * lm.least_gain(10**8))


def test_numbers_and_blocks_come_back():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 60, 3000))
    found = lm._Numbers(keys).find(np.r_[keys, keys + 1])
    assert (found[: len(keys)] == np.arange(len(keys))).all() and (found[len(keys) :][~np.isin(keys + 1, keys)] == -1).all()
    assert (lm._Numbers(keys[:0]).find(keys) == -1).all()
    for numbers in (keys, keys[:1], keys[::-1], np.arange(1, 400), np.full(5, 7)):
        assert (lm._unpacked(lm._packed(numbers), len(numbers)) == numbers).all()


def test_symbols_of_any_text_are_read_alike():
    lookup = lm._lookup([ord(c) for c in "abcé"], [ord("~"), 0x4E00, ord("ö")])
    for table in (lookup, lm._lookup([97, 98]), lm._lookup([]), lm._lookup([97, 0x4E00])):
        read = lm._reader(table)
        for text in ("", "abc", "é~ö", "a一b", "\xff", "😀", "zzz"):
            assert read(text.encode()).tolist() == lm._symbols(text.encode(), table).tolist()
        assert read(b"a\xff\xfeb").tolist() == lm._symbols(b"a\xff\xfeb", table).tolist()


# Neighbours ----------------------------------------------------------------------------------------------------------


def _best(ids, vectors, q, k):
    score = vectors @ vectors[q]
    order = [i for i in np.lexsort((ids, -score)) if ids[i] != ids[q]]
    return [(int(ids[i]), float(score[i])) for i in order[:k]]


def test_recall_of_the_query(spark):
    table = _table("embeddings")
    ids, vectors = table.vec_id.to_numpy(), np.array(table.embedding.tolist(), float)
    got = {}
    for r in QUERIES["op9_nearest"](spark, SF).collect():
        got.setdefault(r["query_id"], []).append(r)
    queries = [i for i, v in enumerate(ids) if v % 20 == 0]
    hits = 0
    for q in queries:
        rows = sorted(got[ids[q]], key=lambda r: r["rank"])
        assert [r["rank"] for r in rows] == list(range(1, 21))
        assert all(r["score"] == pytest.approx(vectors[q] @ vectors[list(ids).index(r["vec_id"])]) for r in rows)
        hits += len({i for i, _ in _best(ids, vectors, q, 20)} & {r["vec_id"] for r in rows})
    assert hits >= 0.9 * 20 * len(queries)


def test_neighbours_defined_cases(spark):
    from pyspark.sql import functions as F

    rng = np.random.default_rng(2)
    good = [(i, rng.normal(size=8).tolist(), "x") for i in range(12)] + [(100 + i, [1.0] * 8, "x") for i in range(40)]
    bad = [(200, None, "x"), (201, [0.0] * 8, "x"), (202, [None] + [1.0] * 7, "x"), (203, [float("nan")] * 8, "x"), (204, [float("inf")] * 8, "x"), (205, [9.0] * 3, "x"), (None, [1.0] * 8, "x")]
    df = spark.createDataFrame(good + bad + [(3, good[3][1], "x")], "vec_id long, embedding array<double>, score string")
    got = ann.nearest(df, is_query=F.col("id") < 10, k=20, cell=16).collect()
    ids, vectors = np.array([g[0] for g in good]), np.array([g[1] for g in good])
    for q in range(10):
        rows = sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])
        assert len(rows) == 20 and len({r["vec_id"] for r in rows}) == 20 and q not in {r["vec_id"] for r in rows}
        ones = [r["vec_id"] for r in rows if r["vec_id"] >= 100]
        assert ones == list(range(100, 100 + len(ones)))  # ties to the smaller id
    few = ann.nearest(df.where("vec_id < 4"), is_query=F.col("id") >= 0, k=20).collect()
    assert Counter(r["query_id"] for r in few) == Counter({0: 3, 1: 3, 2: 3, 3: 3})
    assert ann.nearest(df.limit(0), is_query=F.lit(True)).count() == 0


def _recall(spark, vectors, queries=40, **kwargs):
    from pyspark.sql import functions as F

    ids = np.arange(len(vectors))
    df = spark.createDataFrame([(int(i), v) for i, v in zip(ids, vectors.tolist())], "vec_id long, embedding array<double>")
    got = ann.nearest(df, is_query=F.col("id") < queries, k=20, **kwargs).collect()
    best = {(q, i) for q in range(queries) for i, _ in _best(ids, vectors, q, 20)}
    return len(best & {(r["query_id"], r["vec_id"]) for r in got}) / len(best)


@pytest.mark.parametrize("norms", ["one long", "log-normal"])
def test_recall_with_unequal_norms(spark, norms):
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(6000, 64))
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    if norms == "one long":
        vectors[77] *= 5.0
    else:
        vectors *= rng.lognormal(size=(6000, 1))
    assert _recall(spark, vectors, whole=100) >= 0.9


def test_hot_buckets_and_copies_stay_in_blocks(spark, monkeypatch):
    rng = np.random.default_rng(9)
    center = rng.normal(size=16)
    vectors = np.concatenate([np.tile(center, (300, 1)), center + 1e-3 * rng.normal(size=(300, 16)), rng.normal(size=(300, 16))])
    sizes = spark.sparkContext.accumulator(0)
    compare = ann._compare

    def watched(k):
        inner = compare(k)

        def run(key, queries, rows):
            if len(rows) > 0 and (queries["bucket"].value_counts().max() > 120 or rows["bucket"].value_counts().max() > 120):
                sizes.add(1)
            return inner(key, queries, rows)

        return run

    monkeypatch.setattr(ann, "_compare", watched)
    assert _recall(spark, vectors, queries=900, cell=60, block=60) == 1.0
    assert sizes.value == 0
    plain = _recall(spark, vectors, queries=900)
    assert plain == 1.0


def test_every_written_variant_has_a_window():
    rng = np.random.default_rng(3)
    spans = [(0, "anna.lind@mail.example.org"), (1, "10.20.30.40"), (2, "4111 1111 1111 1111"), (3, "+1 212 555 0199")]
    for kind, text in spans:
        for _ in range(200):
            made = pii.written_otherwise(kind, text, rng)
            prose = "the quiet river runs " * 20 + made + " along the old mill" * 20
            at = prose.index(made)
            assert any(s <= at and at + len(made) <= s + pii.WINDOW for s in pii.window_starts(prose)), made


def test_bracketed_addresses_in_digit_free_prose(spark, docs):
    texts = [t for t in _table("documents", "/root/testdata/sf0.01").text if re.search("[0-9@]", t) and len(t) < 20_000]
    tagger = pii.train(texts)
    rows, want = [], {}
    for i, at in enumerate(("(at)", " [at] ")):
        for j, dot in enumerate((".", "[dot]", "(dot)", " . ")):
            made = f"anna.lind{at}example{dot}com"  # the training texts know no other ending
            text = f"The committee met again and asked everyone to write to {made} before the end of the month. Nothing else was said."
            want[10 * i + j] = (text.index(made), text.index(made) + len(made))
            rows.append((10 * i + j, text))
    got = {r["doc_id"]: [(s["start"], s["end"]) for s in r["all"]] for r in pii.find_personal_data(docs(rows), tagger).collect()}
    missed = [i for i in want if want[i] not in got[i]]
    assert not missed, (missed, got, want)


def test_long_spans_are_whole_at_every_offset(monkeypatch):
    def forward(params, x, lengths):
        digit = x[:, :, 1] > 0  # a run of digits is a phone, its first character the surer begin
        scores = np.zeros((*digit.shape, pii.TAGS))
        scores[:, :, 0] = np.where(digit, -9.0, 9.0)
        first = digit & ~np.pad(digit, ((0, 0), (1, 0)))[:, :-1]
        first[:, 0] = False
        scores[:, :, 7], scores[:, :, 8] = np.where(first, 9.0, -1.0), np.where(digit, 5.0, -9.0)
        return (scores,)

    monkeypatch.setattr(pii.nn, "forward", forward)
    tagger = pii.Tagger({}, np.where(pii._allowed(), 0.0, -1e4))
    for size in (1, 47, 50, 70, 95, 97, 120, 150, 400):
        texts = ["-" * at + "7" * size + "-" * 200 for at in range(100, 200)]
        for at, found in zip(range(100, 200), pii.found_spans(tagger, texts)):
            assert [s for _, s in found] == [(3, at, at + size)], (at, size)
    many = "".join("-" * (i % 7 + 1) + "7" * (i % 140 + 1) for i in range(300)) + "-"
    want = [(3, m.start(), m.end()) for m in re.finditer("7+", many)]
    assert [s for _, s in pii.found_spans(tagger, [many])[0]] == want
    endless = "-" * 100 + "7" * 10_000 + "-" * 100
    assert [s for _, s in pii.found_spans(tagger, [endless])[0]] == [(3, 100, 10_100)]
    # Only the signal has to be near a digit: a span reaches on into windows without any.
    edge = "-" * 300 + "7" * 60
    assert [s for _, s in pii.found_spans(tagger, [edge])[0]] == [(3, 300, 360)]
