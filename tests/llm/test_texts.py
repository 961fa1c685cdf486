"""Operators that look at one text at a time."""

from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
from tests.llm.helpers import AWKWARD, frame, prose, words
from tradelane.llm import classifier, extraction, rules, stats, toxicity, trees
from tradelane.llm.packing import best_fit, pack_documents, pieces
from tradelane.llm.tables import texts
from tradelane.llm.textops import slices
from tradelane.llm.tokens import Encoder

SMALL = "/root/testdata/sf0.01"


def brute_counts(text):
    text = text or ""
    own = words(text)
    windows = Counter(tuple(own[i:i + 8]) for i in range(len(own) - 7))
    under, seen, dup = set(), set(), 0
    for i in range(len(own) - 7):
        if windows[tuple(own[i:i + 8])] > 1:
            under |= set(range(i, i + 8))
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    return (len(own), sum(map(len, own)), sum(c in "#*$%&|<>" for c in text), dup, len(under))


def test_counts_of_awkward_and_real_texts(spark):
    real = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    all_ = AWKWARD + real + ["a b c d e f g h " * 3, "q\nq\n q\n\nq"]
    got = []
    for _, f in slices(pa.record_batch({"text": pa.array(all_, pa.string())})):
        c = stats.counts(f)
        assert np.isfinite(stats.features(f, c)).all()
        got += list(zip(*(c[k].tolist() for k in stats.COUNTS), strict=True))
    assert got == [brute_counts(t) for t in all_]


def test_quality_rules_hold_base_rules_and_accuracy(spark):
    rows = entry.queries()["op6_quality_rules"](spark, SMALL).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    for r in rows:
        b = brute_counts(docs[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == b
        assert r.base_failed == (b[0] < 20 or 100 * b[4] > 30 * b[0])
        assert not (r.base_failed and r.kept)
    good = [r for r in rows if labels.get(r.doc_id) == 1 and not r.base_failed]
    bad = [r for r in rows if labels.get(r.doc_id) == 0]
    assert sum(r.kept for r in good) >= 0.98 * len(good)
    assert sum(not r.kept for r in bad) >= 0.9 * len(bad)


def test_quality_rules_on_awkward_and_empty_tables(spark):
    docs = texts(frame(spark, AWKWARD))
    none = spark.createDataFrame([], "doc_id long, label int")
    model = rules.fit_rules(docs, none)  # no labels: nothing but the base rules
    got = rules.score_rules(docs, model).collect()
    assert len(got) == len(AWKWARD) and all(r.kept != r.base_failed for r in got)
    assert rules.score_rules(docs.limit(0), model).count() == 0
    whole = frame(spark, AWKWARD)
    kept = rules.keep_by_rules(whole, model)
    assert kept.columns == whole.columns and kept.count() == sum(r.kept for r in got)


def test_trees_are_monotonic():
    r = np.random.default_rng(3)
    x = r.normal(size=(3000, 3))
    y = ((x[:, 0] + np.sin(3 * x[:, 1]) + r.normal(size=3000)) > 0).astype(float)
    model = trees.fit(x, y, np.array([1, 0, -1]))
    line = np.zeros((200, 3))
    for at in x[:50]:
        line[:] = at
        line[:, 0] = np.linspace(-3, 3, 200)
        assert (np.diff(model.raw(line)) >= -1e-9).all()
        line[:] = at
        line[:, 2] = np.linspace(-3, 3, 200)
        assert (np.diff(model.raw(line)) <= 1e-9).all()
    assert ((model.probability(x) > 0.5) == y).mean() > 0.75
    assert trees.fit(x[:0], y[:0], np.zeros(3)).probability(x).min() > 0.99


def test_classifier_on_held_out_labels(spark):
    rows = {r.doc_id: r for r in entry.queries()["op3_quality"](spark, SMALL).collect()}
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").collect()
    held = [(r.quality, rows[r.doc_id]) for r in labels if rows[r.doc_id].held_out]
    assert len(held) > 30 and sum(q == v.predicted for q, v in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows.values())


def test_classifier_on_awkward_tables(spark):
    docs = frame(spark, [*AWKWARD, "null id"], ids=[*range(len(AWKWARD)), None])
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (None, 1), (3, None)], "doc_id long, label int")
    got = classifier.quality_scores(docs, labels).collect()
    assert len(got) == len(AWKWARD) + 1 and all(r.score is not None for r in got)
    assert not next(r for r in got if r.doc_id is None).held_out
    assert all(r.score == 1 for r in classifier.quality_scores(docs, labels.limit(0)).collect())
    assert classifier.quality_scores(docs.limit(0), labels).count() == 0


def test_isotonic_pools_falling_neighbours():
    at, to = classifier.isotonic(np.array([0., 1, 2, 3]), np.array([0., 3, 1, 4]), np.array([4., 4, 4, 4]))
    assert to.tolist() == [0, 0.5, 1] and at.tolist() == [0, 1.5, 3]


def test_toxicity_learns_marker_words(spark):
    bad = ["vile", "nasty", "rotten"]
    made = [prose(i, 60) + (f" {bad[i % 3]} {bad[(i + 1) % 3]}" if i % 5 == 0 else "") for i in range(600)]
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(400)], "doc_id long, label int")
    got = {r.doc_id: r for r in toxicity.toxicity(frame(spark, made), labels).collect()}
    for i in range(400, 600):
        assert got[i].toxic == (i % 5 == 0)
        assert (got[i].severity > 0.7) == (i % 5 == 0) and 0 <= got[i].severity <= 2


def test_toxicity_grades_rise_with_the_words(spark):
    made = [prose(i, 40) + " mild" * (i % 3 > 0) + " severe" * (i % 3 > 1) for i in range(450)]
    labels = spark.createDataFrame([(i, i % 3) for i in range(300)], "doc_id long, label int")
    got = {r.doc_id: r for r in toxicity.toxicity(frame(spark, made), labels, graded=True).collect()}
    assert sum(got[i].grade == i % 3 for i in range(300, 450)) > 140


def test_toxicity_on_awkward_tables(spark):
    docs, none = frame(spark, AWKWARD), spark.createDataFrame([], "doc_id long, label int")
    assert {r.p_toxic for r in toxicity.toxicity(docs, none).collect()} == {0.5}
    one = spark.createDataFrame([(4, 0), (5, 0)], "doc_id long, label int")
    assert len(toxicity.toxicity(docs, one).collect()) == len(AWKWARD)
    assert toxicity.toxicity(docs.limit(0), one).count() == 0


LONG = "word " * 60
PAGES = {
    None: "", "": "", "text only": "text only", "<p>a<p>b": "a\n\nb", "<p>1 < 2 &amp;&nbsp; <b>3</b><br/>x": "1 < 2 & 3 x",
    "<script>if(a<b)</script><style>p{}</style><p>ok": "ok",
    f"<body><nav><a href=x>menu</a></nav><article><h1>T</h1><p>{LONG}<p>end</article><footer>f</footer>":
        f"T\n\n{LONG.strip()}\n\nend",
    f"<div><div class='c'><h2>T</h2><div><p>{LONG}</p><p>{LONG}<a href=#>l</a></p></div></div>"
    "<div id='side-bar sidebar'><p>no</p></div><div class='comments'><p>no</p></div><form><p>no</p></form></div>":
        f"T\n\n{LONG.strip()}\n\n{LONG.strip()} l".replace("word l", "word l"),
    "<table><tr><td>a<td>b<tr><td>c</table>": "a\n\nb\n\nc", "<a title=\"x>y\">q</a> <!-- c <p>no</p> --> done": "q done",
    "<form><p>only a form</p></form>": "only a form", "<p hidden>no</p><p>yes": "yes", "</p></div>x": "x",
}


@pytest.mark.parametrize("source", list(PAGES), ids=range(len(PAGES)))
def test_main_text(source):
    assert extraction.main_text(source or "") == PAGES[source]


_P = f"<p>{LONG}</p><p>{LONG}</p>"
_MENU = "<div class='sidebar'><a href=a>one</a> <a href=b>two</a></div><p>line</p>"
WRAPPED = {
    "wrapper": f"<body><div class='layout with-sidebar'><article>{_P}</article></div>{_MENU}</body>",
    "no article": f"<body><div class='post has-related'><h1>T</h1>{_P}</div>{_MENU}</body>",
    "id": f"<body><div><div>{_P}</div><div id='market-share'>{_P}</div></div>{_MENU}</body>",
    "form": f"<body><form id='aspnetForm'><div>{_P}</div></form>{_MENU}</body>",
    "two articles": f"<body><main><article>{_P}</article><article>{_P}</article></main>{_MENU}</body>",
    "beside": f"<body><div><article>{_P}</article><article>{_P}</article></div>{_MENU}</body>",
    "comments": f"<body><article>{_P}</article><div class='comments'>{_P * 4}</div>{_MENU}</body>",
}


@pytest.mark.parametrize("name", list(WRAPPED))
def test_articles_survive_names_and_neighbours(name):
    got = extraction.main_text(WRAPPED[name])
    assert got.count(LONG.strip()) == (4 if name in ("id", "two articles", "beside") else 2)
    assert "one" not in got.split() and "two" not in got.split()


def test_formulas_are_text():
    assert extraction.main_text("<p>so <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds") == "so x=2 holds"


def test_pages(spark):
    import html
    import re
    got = {r.page_id: r for r in entry.queries()["op7_html_extraction"](spark, SMALL).collect()}
    for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1].replace("<br>", " ")
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        assert got[r.page_id].text == "\n\n".join(x for x in parts if x)
        assert got[r.page_id].n_chars == len(got[r.page_id].text) and got[r.page_id].url == r.url
    odd = spark.createDataFrame([(1, None, None, "x"), (1, "u", "", "x"), (None, "u", "<p>a", "x")],
                                "page_id long, url string, html string, text string")
    assert sorted(r.text for r in extraction.extract_pages(odd).collect()) == ["", "", "a"]
    assert extraction.extract_pages(odd.limit(0)).count() == 0


def test_ids_equal_those_of_the_tokenizer():
    import random
    path = public_tokenizers.path("byte_bpe_50k.json")
    encode, plain, r = Encoder(path), Tokenizer.from_file(path), random.Random(2)
    parts = [" ", "  ", "\n", "\t", "\r\n", "a", "B", "é", "1", "12", ".", "!", "'s", "'ll", "\xa0", " ", "\x1c",
             "\x85", "字", "🙂", "　", "<|endoftext|>", "\"", "_", "\x0b", "​"]
    all_ = [*AWKWARD[1:], *("".join(r.choice(parts) for _ in range(r.randint(0, 14))) for _ in range(5000))]
    at = 0
    for rows, f in slices(pa.record_batch({"text": pa.array(all_)})):
        ids, ends = encode(f)
        for i in range(rows.num_rows):
            want = plain.encode(all_[at + i], add_special_tokens=False).ids
            assert ids[ends[i]:ends[i + 1]].tolist() == want, repr(all_[at + i])
        at += rows.num_rows


def check_packed(rows, want, capacity=2048):
    """want: per row (doc_id, number of ids)."""
    bins, docs = {}, {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
        docs.setdefault(r.doc_id, []).append(r)
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= capacity
    assert sorted((d, sum(r.length for r in rs)) for d, rs in docs.items()) == sorted(want)
    for rs in docs.values():
        rs.sort(key=lambda r: r.piece)
        assert [r.start for r in rs] == [sum(x.length for x in rs[:i]) for i in range(len(rs))]
        assert [r.piece for r in rs] == list(range(len(rs))) and all(r.length == capacity for r in rs[1:])
    return len(bins)


def test_packing_round_trip(spark):
    import zlib
    path = public_tokenizers.path("byte_bpe_50k.json")
    made = AWKWARD + [prose(i, i % 400) for i in range(400)] + ["a <|endoftext|> b", "<|endoftext|>" * 3, "x<|endoftext|"]
    docs = frame(spark, made)
    encode = Tokenizer.from_file(path).encode
    assert encode("a <|endoftext|> b", add_special_tokens=False).ids == [64, 220, 50256, 275]
    ids = {i: [*encode(t or "", add_special_tokens=False).ids, 0] for i, t in enumerate(made)}
    rows = pack_documents(docs, path).collect()
    bins = check_packed(rows, [(i, len(x)) for i, x in ids.items()])
    assert bins <= -(-sum(map(len, ids.values())) // 2048) + 2
    for r in rows:
        own = np.array(ids[r.doc_id][r.start:r.start + r.length], "<u4").tobytes()
        assert r.ids_crc32 == zlib.crc32(own)
    again = pieces(texts(docs), path, with_ids=True).where("doc_id = 12").orderBy("piece").collect()
    assert [x for r in again for x in r.ids] == ids[12]
    assert pack_documents(docs.limit(0), path).count() == 0
    twice = frame(spark, ["a b", "a b", "c"], ids=[1, 1, None])
    assert len(pack_documents(twice, path).collect()) == 3


def long_prose(name, n):
    return "".join(f"<p>Sentence {i} of {name} tells a long story about what happened there and then.</p>" for i in range(n))


MENU = "<html><body><nav><a href=x>Home</a><a href=y>More</a></nav>"
ART, TWO, BAD = long_prose("art", 6), long_prose("two", 3), {n: long_prose("bad", n) for n in (1, 5, 12, 60)}
# page, what must be there, what must not
SITES = {f"{c} {n}": (f"{MENU}<div class=content>{ART}</div><div class='{c}'>{BAD[n]}</div>", ["0 of art", "5 of art"], ["of bad"])
         for c in ("footer", "sidebar", "cookie-notice", "promo", "comment-list", "user-comments", "adBox") for n in BAD}
SITES |= {
    "thread": (f"{MENU}<div class=post>{ART}</div><div id='disqus_thread'>{BAD[60]}</div>", ["0 of art", "5 of art"], ["of bad"]),
    "in article": (f"{MENU}<article>{ART}<section class='user-comments'>{BAD[12]}</section><div class='advert-box'>{BAD[12]}</div>"
                   f"{TWO}</article>", ["0 of art", "2 of two"], ["of bad"]),
    "sections": (f"{MENU}<div class=entry><h1>Title</h1><div class=sec>{ART}</div><table><tr><td>cell A</td><td>cell B</td></tr>"
                 f"</table><blockquote>Short quote.</blockquote><div class=sec>{TWO}</div><p>Tiny.</p><p><a href=z>See this</a></p>"
                 f"<div class=sec>{TWO}</div><p>The end.</p></div><div class=footer>{BAD[12]}</div>",
                 ["Title", "5 of art", "cell A", "cell B", "Short quote.", "2 of two", "Tiny.", "See this", "The end."], ["of bad"]),
    "wrapper": (f"<body><div>Site name</div><div id='sidebar-wrapper'><div>{ART}</div><div class=sidebar>{BAD[5]}</div></div>",
                ["0 of art", "5 of art"], ["of bad"]),
    "modifiers": (f"{MENU}<div class='post with-sidebar has-related comments-open'><h1>T</h1>{ART}</div>", ["0 of art", "5 of art"], []),
    "whole form": (f"<form id=f1><div><h1>T</h1>{ART}</div><div class=footer>{BAD[5]}</div></form>", ["5 of art"], ["of bad"]),
    "share": (f"{MENU}<article>{ART}<section id='market-share'>{TWO}</section></article>", ["5 of art", "2 of two"], []),
    "comments as articles": (f"{MENU}<main><article class='post comments-closed'>{ART}</article><div id=comments>"
                             f"<article class='comment-body'>{BAD[60]}</article></div></main>", ["5 of art"], ["of bad"]),
    "short article": (f"<body><div><h1>Gone</h1><p>Not found.</p></div><div class=footer>{BAD[12]}</div>", ["Not found."], ["of bad"])}


@pytest.mark.parametrize("name", SITES)
def test_articles_stay_whole_and_alone(name):
    page, want, never = SITES[name]
    text = extraction.main_text(page + "</body></html>")
    assert [w for w in want if w not in text] == [] and [w for w in never if w in text] == []


@pytest.mark.parametrize("page", ["<span>" * 100_000, "<span>x" * 50_000 + "</b>" * 50_000, "<div>" * 100_000 + "text",
                                  "<p>a" * 50_000 + "<span>" * 50_000 + "<p>b" * 20_000, "<a title=\"x>" * 50_000,
                                  "<ul><li><table><tr><td>" * 20_000])
def test_long_and_deep_pages_take_time_in_proportion(page):
    import time
    began = time.process_time()
    extraction.main_text(page)
    assert time.process_time() - began < 10  # a few seconds here; a walk of all open tags per tag takes many minutes


def test_densities_are_those_of_a_plain_tree():
    """Characters per tag, adjusted by links, summed over children, worked out by recursion on random trees."""
    import math
    import random

    def grow(r, depth):
        if depth == 0 or r.random() < 0.2:
            return ("t", "w" * r.randint(1, 90))
        tag = r.choice(["div", "div", "b", "a", "section"])
        return (tag, [grow(r, depth - 1) for _ in range(r.randint(1, 4))])

    def html(x):
        return x[1] if x[0] == "t" else f"<{x[0]}>{''.join(map(html, x[1]))}</{x[0]}>"

    def counts(x):  # characters, tags, link characters, link tags below and in the node
        if x[0] == "t":
            return len(x[1]), 0, 0, 0
        below = [counts(y) for y in x[1]]
        c, lc, lt = (sum(b[k] for b in below) for k in (0, 2, 3))
        t = sum(b[1] + (y[0] != "t") for b, y in zip(below, x[1], strict=True))
        return (c, t, c, lt + 1) if x[0] == "a" else (c, t, lc, lt)

    def density(x, share):
        c, t, lc, lt = counts(x)
        if not c:
            return 0.0
        base = math.log(c / max(c - lc, 1) * lc + share * c + math.e)
        return c / max(t, 1) * math.log(max(c / max(lc, 1) * max(t, 1) / max(lt, 1), 1)) / max(math.log(base), 0.5)

    for seed in range(60):
        r = random.Random(seed)
        tree = ("body", [grow(r, 5) for _ in range(3)])
        share = counts(tree)[2] / max(counts(tree)[0], 1)
        want, sums = [], []

        def walk(x):
            if x[0] != "t":
                want.append(density(x, share))
                sums.append(sum(density(y, share) for y in x[1] if y[0] != "t"))
                for y in x[1]:
                    walk(y)
        walk(tree)
        page = extraction._Page(html(tree))
        w = extraction._Weights(page)
        assert w.density[1:] == pytest.approx(want)
        assert sums[w.best - 1] == pytest.approx(max(sums))


def test_best_fit_is_that_of_a_plain_scan():
    r = np.random.default_rng(5)
    for _ in range(20):
        size = np.sort(r.integers(1, 101, 300))[::-1]
        rooms: list[int] = []
        for s in size.tolist():
            fitting = [i for i, room in enumerate(rooms) if room >= s]
            if fitting:
                rooms[min(fitting, key=lambda i: rooms[i])] -= s
            else:
                rooms.append(100 - s)
        bins = best_fit(size, 100)
        assert sorted(100 - np.bincount(bins, size)) == sorted(rooms)


def test_trees_are_those_of_a_plain_search():
    """Every split tried in turn, two levels, three trees, against the histograms."""
    r = np.random.default_rng(8)
    x = r.normal(size=(120, 2)).round(1)
    y = (x[:, 0] * x[:, 1] + 0.3 * r.normal(size=120) > 0).astype(float)
    model = trees.fit(x, y, np.zeros(2), trees=3, depth=2, rate=0.5, bins=16, l2=2.0, least=5)
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, 17)[1:-1])) for j in range(2)]
    raw = np.full(120, np.log(y.mean() / (1 - y.mean())))
    for _ in range(3):
        p = 1 / (1 + np.exp(-raw))
        g, h = y - p, p * (1 - p)

        def leaf(own):
            return g[own].sum() / (h[own].sum() + 2)

        def gain(own):
            return leaf(own) * g[own].sum() / 2

        def grow(own, depth):
            best = (1e-6, None)
            for j in range(2):
                for c in cuts[j]:
                    a, b = own[x[own, j] <= c], own[x[own, j] > c]
                    if len(a) >= 5 and len(b) >= 5 and gain(a) + gain(b) - gain(own) > best[0] + 1e-12:
                        best = (gain(a) + gain(b) - gain(own), (a, b))
            if depth == 0 or best[1] is None or len(own) < 10:
                raw[own] += 0.5 * leaf(own)
            else:
                for part in best[1]:
                    grow(part, depth - 1)
        grow(np.arange(120), 2)
    assert model.raw(x) == pytest.approx(raw)


def test_summed_equations_solve_like_one_matrix(spark):
    r = np.random.default_rng(6)
    x = r.normal(size=(300, len(stats.FEATURES)))
    label = (x[:, 0] + x[:, 1] ** 2 + 0.2 * r.normal(size=300) > 0.8).astype(int)
    rows = spark.createDataFrame([(*map(float, v), int(b), i % 5) for i, (v, b) in enumerate(zip(x, label, strict=True))],
                                 ", ".join(f"`{k}` double" for k in stats.FEATURES) + ", label int, fold int").repartition(7)
    model = classifier.fit_quality(rows.where("fold > 0"))
    own = np.isin(np.arange(300) % 5, [1, 2, 3])
    assert model.mean == pytest.approx(x[own].mean(0)) and model.scale == pytest.approx(x[own].std(0))
    z = model.fourier(x[own])
    penalty = np.eye(z.shape[1]) * classifier.RIDGE * own.sum() / classifier.FOURIER
    penalty[-1, -1] = 0
    assert model.beta == pytest.approx(np.linalg.solve(z.T @ z + penalty, z.T @ label[own]), rel=1e-6, abs=1e-9)


def test_ordinal_fit_reaches_the_least_loss():
    """The loss written out plainly: its numeric gradient is near zero at the fit, and any step away raises it."""
    r = np.random.default_rng(9)
    words_ = [np.flatnonzero(r.random(4) < 0.5) for _ in range(80)]
    grade = np.array([min(2, int((0 in w) + (1 in w) + (r.random() < 0.2))) for w in words_])
    text, bucket = np.repeat(np.arange(80), [len(w) for w in words_]), np.concatenate(words_)
    l2 = 1e-2
    fitted = toxicity.fit_ordinal(text, bucket, grade, rounds=4000, rate=0.01, l2=l2)

    def loss(weights, theta):
        total = 0.0
        for w, k in zip(words_, grade, strict=True):
            upto = [0, *(1 / (1 + np.exp(-(t - weights[w].sum()))) for t in theta), 1]
            total -= np.log(upto[k + 1] - upto[k])
        return total / 80 + l2 / 2 * (weights ** 2).sum()

    free = np.concatenate([fitted.weights[:4], fitted.theta])
    at = lambda f: loss(f[:4], f[4:])
    least = at(free)
    for i in range(len(free)):
        step = np.zeros(len(free))
        step[i] = 1e-4
        assert abs(at(free + step) - at(free - step)) / 2e-4 < 2e-3
        assert at(free + 300 * step) > least and at(free - 300 * step) > least


def test_a_worker_gives_back_unused_memory_after_each_batch(monkeypatch):
    given = []
    monkeypatch.setattr("tradelane.llm.textops.give_back", lambda: given.append(1))
    batch = pa.record_batch([pa.array(["one two", None, "three"])], ["text"])
    for n in (1, 2):
        assert sum(len(rows) for rows, _ in slices(batch)) == 3 and len(given) == n
