"""Top-k search, language ID, HTML extraction and the pipeline."""
from __future__ import annotations

import itertools
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from cortexlake.llm import html_extract, language_id, topk

SF = "/root/testdata/sf0.001"


# ----------------------------------------------------------------- top-k
@pytest.mark.parametrize("shard_rows", [16, 8192])
def test_top_k(spark, shard_rows):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(400)]
    rows += [(1000 + i, rows[0][1]) for i in range(30)]                  # ties
    rows += [(2000, None), (2001, [float("nan")] * 8), (2002, [None] * 8), (2003, [1.0, 2.0]), (None, rows[1][1])]
    rows += [(3, rows[3][1])]                                            # a repeated row
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("x"))
    got = topk.top_k(df, df.filter("vec_id % 50 = 0"), 5, shard_rows, 3).collect()
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    want = []
    for q, x in {i: x for i, x in ok if i % 50 == 0}.items():
        scored = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in ok if i != q and len(x) == len(y))
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:5])]
    assert sorted(tuple(r) for r in got) == sorted(want)
    empty = df.limit(0)
    assert topk.top_k(empty, empty).count() == 0


def test_ball_tree_cuts_subtrees():
    rng = np.random.default_rng(5)
    x = np.floor(256 * (rng.normal(size=(40, 8))[rng.integers(0, 40, 20_000)] + 0.02 * rng.normal(size=(20_000, 8))))
    tree = topk.BallTree(np.arange(len(x)), x)
    for q in range(0, 400, 10):
        s, i = tree.search(x[q], q, 5, float("-inf"))
        score = x @ x[q]
        score[q] = -np.inf
        want = np.lexsort((np.arange(len(x)), -score))[:5]
        assert i.tolist() == want.tolist() and s.tolist() == score[want].tolist()
    assert tree.visited < 0.25 * 40 * len(tree.ranges)


# ----------------------------------------------------------- language ID
def brute_word(word, p, index):
    n, total = len(word), 0.0
    for cuts in itertools.product([0, 1], repeat=n - 1):
        ends = [i + 1 for i, c in enumerate(cuts) if c] + [n]
        prob, a = 1.0, 0
        for b in ends:
            piece = word[a:b]
            k = index.get(piece, 0 if len(piece) == 1 else None)
            prob *= 0.0 if k is None else p[k]
            a = b
        total += prob
    return total


def test_forward_sums_all_segmentations():
    found = sorted([" a", "a", "b", "ab", "ba", "bab", " ab", "abc"])
    index = language_id.Pieces(found)
    names = {p: i for i, p in enumerate(found, 1)}
    p = np.random.default_rng(0).random(index.size)
    for w in (" abab", " babc", " aabz", "abcab", "z"):
        got = language_id.forward(language_id.lattice([w, w], index), p[:, None])[:, -1, 0]
        assert np.allclose(got, brute_word(w, p, names))


def test_fit_raises_the_likelihood():
    index = language_id.pieces("piece_bpe_32k.model")
    words = language_id.words_of("the quick brown fox and the lazy dog " * 3)
    p = [language_id.fit(words, np.ones(len(words)), index, r) for r in (0, 3)]
    like = [language_id.log_probabilities(words, index, x[:, None]).sum() for x in p]
    assert like[1] > like[0] and all(abs(x.sum() - 1) < 1e-9 for x in p)


def test_long_words_and_marks_stay_whole():
    long = "donaudampfschifffahrtsgesellschaftskapitaen"
    assert language_id.words_of(f"({long.upper()}-2) हिन्दी \u0301 a\u0301b²c") == [
        " " + long, " हिन्दी", " a\u0301b", " c"]
    index = language_id.pieces("piece_bpe_32k.model")
    assert index.longest > 8
    p = np.random.default_rng(2).random((index.size, 3)) * 1e-4
    word = " " + long
    got = language_id.log_probabilities([word, " und"], index, p)
    lat = language_id.lattice([word], index)
    for lang in range(3):                                    # plain recursion, in exact sums
        alpha = [1.0]
        for j in range(1, len(word) + 1):
            alpha.append(math.fsum(alpha[j - l] * p[lat[0, j, l], lang]
                                   for l in range(1, min(j, index.longest) + 1) if lat[0, j, l] >= 0))
        assert math.isclose(got[0, lang], math.log(alpha[-1]), rel_tol=1e-9)


def test_words_in_parts(monkeypatch):
    index = language_id.pieces("piece_bpe_32k.model")
    p = np.random.default_rng(3).random((index.size, 2)) * 1e-3
    word = " " + "thequickbrownfoxandthelazydog" * 40                # its probability is below any double
    whole = language_id.log_probabilities([word], index, p)
    monkeypatch.setattr(language_id, "LETTERS", 100)
    assert np.allclose(language_id.log_probabilities([word], index, p), whole, rtol=1e-12)
    alone = language_id.log_probabilities([" thequick"], index, p)
    assert whole.max() < -1000 and np.isfinite(whole).all() and (alone > whole).all()


def test_fit_counts_all_segmentations():
    """One round of EM against sums over all segmentations."""
    found = sorted([" a", "a", "b", "ab", "ba", " ab", "aba"])
    index = language_id.Pieces(found)
    names = {x: i for i, x in enumerate(found, 1)}
    words, counts = [" aba", " abab", "bab"], np.array([3.0, 1.0, 2.0])
    start = language_id.fit(words, counts, index, 0)
    seen = np.zeros(index.size)
    for w, c in zip(words, counts):
        every = []
        for cuts in itertools.product([0, 1], repeat=len(w) - 1):
            ends = [i + 1 for i, x in enumerate(cuts) if x] + [len(w)]
            used = [names.get(w[a:b], 0 if b - a == 1 else None) for a, b in zip([0] + ends, ends)]
            if None not in used:
                every.append((math.prod(start[used]), used))
        total = sum(x for x, _ in every)
        for x, used in every:
            for u in used:
                seen[u] += c * x / total
    want = np.maximum(seen / seen.sum(), language_id.FLOOR)
    want[0] = language_id.FLOOR
    assert np.allclose(language_id.fit(words, counts, index, 1), want / want.sum())


def test_posterior_of_whole_texts():
    """Scores of whole texts against a plain product over their words."""
    index = language_id.pieces("piece_bpe_32k.model")
    p = np.random.default_rng(4).dirichlet(np.ones(index.size), 3).T + 1e-9
    texts = ["the cat, the dog", "Wörter — über 12 Straßen " + "x" * 40, "हिन्दी भाषा", "", None, "12 !", "e\u0301te\u0301 de"]
    got = language_id.Scorer(["a", "b", "c"], p, "piece_bpe_32k.model")(texts)
    for t, (lang, score) in zip(texts, got):
        words = language_id.words_of(t or "")
        if not words:
            assert (lang, score) == ("und", 0.0)
            continue
        total = sum(language_id.log_probabilities([w], index, p)[0] for w in words)
        post = np.exp(total - total.max())
        post /= post.sum()
        assert lang == "abc"[int(post.argmax())] and math.isclose(score, post.max(), rel_tol=1e-9)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language_id.language_id(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out")
    n, right = got.agg(F.count("*"), F.sum((F.col("lang") == F.col("lang_pred")).cast("int"))).first()
    assert n > 150 and right / n >= 0.97


def test_language_edges(spark, docs_of, odd_texts):
    docs = docs_of([(i, t, "en" if i % 2 else None) for i, t in enumerate(odd_texts)]
                   + [(None, "some words here", "en")]).withColumn("score", F.lit("clash"))
    got = {r.doc_id: r for r in language_id.language_id(docs).collect()}
    assert len(got) == docs.count()
    for i, t in enumerate(odd_texts):
        has = any(c.isalpha() for c in t or "")
        assert got[i].lang_pred == ("en" if has else "und") and 0 <= got[i].score <= 1
    assert got[None].held_out is False
    assert language_id.language_id(docs_of([])).count() == 0
    nothing = language_id.language_id(docs_of([(1, "words", None)])).first()
    assert nothing.lang_pred == "und"


# ------------------------------------------------------------------ HTML
def page(i, body, nav="Home News"):
    return (f"<!DOCTYPE html><html><head><title>t {i}</title><style>p{{}}</style></head><body>"
            f"<nav><a href=/>{nav}</a></nav><div class='ad'>buy {i}</div>{body}"
            f"<div id=comments><p>nice one {i}</p></div><footer>&copy; {i}</footer></body></html>")


def test_main_text_roles():
    html = page(1, "<header>Site</header><article><header><h1>Big &amp; bold</h1></header><p>One <b>t</b>wo"
                   "<br>three<p>four  \n five<!-- no --><script>var x='</p>';</script><aside>side</aside>"
                   "<form><label>mail</label></form><ul><li>a<li>b</ul></article><aside>x</aside>")
    assert html_extract.main_text(html, set()) == "Big & bold One two three four five a b"
    assert html_extract.main_text("<p>a < b &lt; c <b>&eacute;</b>t", set()) == "a < b < c ét"
    assert html_extract.main_text("<div>plain", set()) == "plain"
    assert html_extract.main_text("<ul><li><a>one link</a></ul><p>text", set()) == "text"


@pytest.mark.parametrize("start, end", [
    ("<div class='elementor-widget-theme-post-content'>", "</div>"), ("<div class='content has-sidebar'>", "</div>"),
    ("<div class='widget'>", "</div>"), ("<form action=/>", "</form>"), ("<form><article>", "</article></form>"),
    ("<article class='post comments'>", "</article>"), ("<div class=widget><form><main>", "</main></form></div>")])
def test_roles_do_not_drop_the_main_text(start, end):
    html = page(1, f"{start}<h1>Title</h1><p>The story is told here at some length.</p>{end}")
    assert html_extract.main_text(html, set()) == "Title The story is told here at some length."


def test_role_of_varying_text(spark):
    body = "<form class=share><p>Sign up for our weekly letter, it is long and it is free</p><p>story {0}</p></form>"
    df = spark.createDataFrame([(i, "http://h/", body.format(i)) for i in range(9)],
                               "page_id long, url string, html string")
    assert {r.text for r in html_extract.extract(df).collect()} == {f"story {i}" for i in range(9)}


def test_alignment():
    a = "x(p(),q(r()),p())"
    assert html_extract.align(a, a) == {0: 0, 1: 1, 2: 2, 3: 3, 4: 4}
    assert html_extract.align("x(q(r()))", a) == {0: 0, 1: 2, 2: 3}
    assert html_extract.align("y()", a) == {}


def test_inline_words_stay_and_unclosed_elements_end():
    text = lambda body: html_extract.main_text(f"<body>{body}</body>", set())
    assert text("<p>Prices <span class=share>rose 3 points</span> today</p>") == "Prices rose 3 points today"
    assert text("<p>a <span hidden>b</span>c</p>") == "a c"
    assert text("<p>one</p><canvas id=c><p>two</p><p>three</p>") == "one two three"
    assert text("<p>a<svg><path/></svg>b</p><p>c<svg>x</p><p>d</p><p>e<svg>y</svg>f</p>") == "ab c d ef"
    assert text("<p>a</p><script>var s='<p>no</p>';</script><p>b</p><style>p{") == "a b"


def test_long_comments_go():
    body = "<div><h1>Title</h1><p>A short story about {0}, told at once.</p></div><div id=comments>" + \
        "".join(f"<div><p>reader {k}</p><p>said something about {{0}}</p></div>" for k in range(5)) + "</div>"
    assert html_extract.main_text(body.format("bees"), set()) == "Title A short story about bees, told at once."


def test_long_lists_fold_and_align():
    import time
    page = lambda n: "<dl>" + "".join(f"<dt>t{i}</dt><dd>d{i}</dd>" for i in range(n)) + "</dl>"
    start = time.time()
    shapes = [html_extract.skeleton(html_extract.parse(page(n))[0]) for n in (5000, 4000, 1)]
    assert set(shapes) == {"(dl(dt(),dd()))"} and html_extract.align(*shapes[:2]) == {0: 0, 1: 1, 2: 2, 3: 3}
    mixed = html_extract.parse("<h2>a</h2><p>b</p><p>c</p><h2>d</h2><p>e</p>")[0]
    assert html_extract.skeleton(mixed) == "(h2(),p())" and [c.number for c in mixed.children] == [1, 2, 2, 1, 2]
    # nothing to fold: every sibling differs from those around it
    odd = "".join(f"<{('h2', 'p', 'div', 'ul', 'h3')[(i * i + i // 7) % 5]} class=c{'x' * (i % 11)}>x" for i in range(3))
    assert html_extract.skeleton(html_extract.parse(odd)[0])
    tags = np.random.default_rng(3).choice(["h2", "p", "ul", "h3", "dl"], 1500)
    long = "x(" + ",".join(f"{t}()" for t in tags) + ")"
    assert html_extract.align(long, long) == {i: i for i in range(1501)}
    assert time.time() - start < 30


def brute_matching(a, b):
    """Most nodes that an order-keeping matching by tag pairs, by plain recursion."""
    if a[0] != b[0]:
        return 0
    p, q = a[1], b[1]
    best = [[0] * (len(q) + 1) for _ in range(len(p) + 1)]
    for i in range(len(p)):
        for j in range(len(q)):
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + brute_matching(p[i], q[j]))
    return 1 + best[-1][-1]


def test_alignment_matches_most_nodes():
    import random
    r = random.Random(8)

    def tree(depth):
        return (r.choice("xyz"), [tree(depth - 1) for _ in range(r.randint(0, 4))] if depth else [])

    def text(t):
        return f"{t[0]}({','.join(map(text, t[1]))})"

    for _ in range(60):
        a, b = ("r", [tree(2) for _ in range(3)]), ("r", [tree(2) for _ in range(3)])
        assert len(html_extract.align(text(a), text(b))) == brute_matching(a, b)


def test_deep_pages(spark):
    deep = ["<div>" * 5000, "<blockquote><center>" * 2000, "".join(f"<div class=c{'x' * (i % 7)}>" for i in range(3000))]
    df = spark.createDataFrame([(i, "http://h/", page(i, f"<p>Read our letter</p>{deep[i % 3]}<p>story {i}"))
                                for i in range(9)], "page_id long, url string, html string")
    # the comments and the footer are inside the unclosed elements
    assert {r.page_id: r.text for r in html_extract.extract(df).collect()} == {i: f"story {i}" for i in range(9)}


def test_alignment_by_tag():
    assert html_extract.align("x.a.sports(p())", "x.a.news(p())") == {0: 0, 1: 1}
    assert html_extract.align("x(d.b())", "x(d.a(),d.b(),d.c())") == {0: 0, 1: 2}


def test_templates_of_several_layouts(spark):
    notice = "<div><p>Read our weekly letter</p></div>"
    bodies = [f"<body class='post category-{{0}}'><div id='post-{{0}}'>{notice}<p>story {{0}}</p></div></body>",
              "<body><div class=two><p>story {0}</p></div><ul><li>end {0}</li></ul></body>",
              f"<body><div class=two>{notice}<p>story {{0}}</p></div><ul><li>end {{0}}</li></ul></body>",
              "<body><div class=a><div class=b><p>story {0}</p></div></div></body>",
              "<body><div class=c><div class=d><p>All rights</p></div></div><h2>story {0}</h2></body>"]
    word = lambda i: "abcdefghijklmnopqrst"[i]
    rows = [(100 * k + i, f"http://{h}/", bodies[k].replace("{0}", word(i)))
            for h, ks in (("one", [0]), ("two", [1, 2]), ("three", [3, 4])) for k in ks for i in range(20)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_extract.extract(df).collect()}
    for i in range(20):
        assert got[i] == got[300 + i] == got[400 + i] == f"story {word(i)}"
        assert got[100 + i] == got[200 + i] == f"story {word(i)} end {word(i)}"


def test_skeleton_numbers():
    root, _ = html_extract.parse("<ul><li><p>a</p><p>b</p></li><li><p>c</p></li></ul><div></div>")
    assert html_extract.skeleton(root) == "(ul(li(p())),div())"
    assert [n.number for n in root.children] == [1, 4]
    assert [[c.number for c in li.children] for li in root.children[0].children] == [[3, 3], [3]]


def test_template_is_what_stays_the_same(spark):
    body = "<div><p>Read our weekly letter</p></div><section><p>{0}</p><p>{1}</p></section>"
    rows = [(i, f"http://Host.example/{i}?q", page(i, body.format(f"story {i}", f"ending {i}"))) for i in range(9)]
    rows += [(20 + i, "http://host.example/c", page(0, body.format("story 0", "ending 0"))) for i in range(30)]
    rows += [(60, "http://lone.example/", page(60, body.format("alone", "end"))), (61, None, None),
             (62, "nohost", ""), (None, "http://lone.example/", "<p>no id")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("site", F.lit(1)) \
        .repartition(4)
    got = {r.page_id: r for r in html_extract.extract(df).collect()}
    assert all(got[i].text == f"story {i} ending {i}" for i in range(9))
    assert all(got[20 + i].text == "story 0 ending 0" for i in range(30))
    assert got[60].text == "Read our weekly letter alone end"
    assert got[61].text == got[62].text == "" and got[None].text == "no id"
    assert all(r.n_chars == len(r.text) for r in got.values())
    assert html_extract.extract(df.limit(0)).count() == 0


def test_a_page_carries_its_own_skeletons_constants(spark):
    body = "<div><p>Read our weekly letter</p></div>{0}<section><p>story {1}</p></section>"
    df = spark.createDataFrame([(i, "http://h/", page(i, body.format("<ul>" * i + "</ul>" * i, i))) for i in range(40)],
                               "page_id long, url string, html string")
    known = html_extract.templates(df.selectExpr("url AS site", "html")).collect()
    assert len(known) == 40 and all(len(r.constants) == 1 for r in known)
    assert {r.page_id: r.text for r in html_extract.extract(df).collect()} == {i: f"story {i}" for i in range(40)}


def test_every_layout_of_a_site_has_a_wrapper(spark):
    """More different layouts than a round takes: none is left out."""
    def html(layout, i):
        w = "q" + "abcdefgh"[layout // 8] + "abcdefgh"[layout % 8]
        return (f"<body class={w}><div class={w}><p class={w}>Letter {w}</p></div>"
                f"<section class={w}><blockquote class={w}>story {layout} {i}</blockquote></section></body>")
    rows = [(100 * k + i, "http://h/", html(k, i)) for k in range(html_extract.LEADERS + 8) for i in range(5)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_extract.extract(df).collect()}
    assert got == {n: f"story {n // 100} {n % 100}" for n, *_ in rows}


def test_pages_table(spark):
    import html as entities
    rows = {r.page_id: r.text for r in
            html_extract.extract(spark.read.parquet(f"{SF}/pages.parquet")).collect()}
    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        inner = re.search(r"<article>(.*?)(?:</article>|\Z)", r.html, re.S)[1]
        assert rows[r.page_id] == " ".join(entities.unescape(re.sub(r"<[^>]*>", " ", inner)).split())


# -------------------------------------------------------------- pipeline
def test_pipeline(spark):
    import corpus_pipeline as P
    from cortexlake.llm import packing, simhash
    from cortexlake.llm.common import saved, table
    docs = table(spark, SF, "documents")
    columns, ids = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in P.STAGES[:-1]:
        before = docs
        docs = saved(stage(spark, docs, SF), f"test-{name}")
        assert docs.columns == columns
        now = [r.doc_id for r in docs.select("doc_id").collect()]
        assert len(now) == len(set(now)) and set(now) <= ids
        if name == "simhash_near_dedup":
            want = {r.component_id for r in simhash.simhash_components(before).collect()}
            assert set(now) == want and len(now) < len(ids)
        else:
            assert set(now) == ids
        ids = set(now)
    last = P.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in last.select("doc_id").collect()} == ids
    lengths = np.unique([r.length for r in last.select("length").collect()], return_counts=True)
    assert last.select("sequence_id").distinct().count() <= packing.lower_bound(*lengths, 2048) + 1



def test_further_columns_stay_out_of_python(spark, docs_of):
    from cortexlake.llm import substring_dedup
    passage = " ".join(f"w{i}" for i in range(20))
    docs = docs_of([(1, passage), (2, "some " + passage), (3, None)]).withColumn("wide", F.repeat(F.lit("x"), 1000))
    found = language_id.predict(docs, language_id.train(docs))
    cut = substring_dedup.substring_dedup(docs)
    for df in (found, cut):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "ArrowEvalPython" in plan and not re.search(r"MapInArrow \w+\(row", plan)
        assert all(len(r.row.wide) == 1000 for r in df.collect())
    assert {r.row.doc_id: (r.kept, r.n_removed) for r in cut.collect()} == {1: (passage, 0), 2: ("some", 20), 3: ("", 0)}


def test_pipeline_on_odd_rows(spark, docs_of, odd_texts, tmp_path):
    """Nulls, empties, long texts, repeated rows, clashing columns; the steps'
    tables are gone afterwards."""
    import os

    import corpus_pipeline as P
    from cortexlake.session import scratch_path
    prose = [f"the {i} quick brown foxes and their {i * 7} lazy dogs run over the {i * 13} hills today" for i in range(40)]
    rows = [(i, t, "en") for i, t in enumerate(prose)] + [(100 + i, t, None, None) for i, t in enumerate(odd_texts)]
    rows += [rows[0], (None, prose[1] + " at noon", "en"), (None, None, None, None)]
    docs = docs_of(rows)
    for c in ("row", "kept", "_id", "_group", "key", "score", "length", "piece"):
        docs = docs.withColumn(c, F.lit("clash"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    place = scratch_path(spark, "").removeprefix("file:")
    before = set(os.listdir(place))
    out = P.run(spark, str(tmp_path))
    got = out.collect()
    new = sorted(set(os.listdir(place)) - before)
    assert len(new) == 1 and new[0].startswith("stage-best_fit_packing")
    ids = {r.doc_id for r in got}
    assert 0 in ids and all(r.length <= 2048 for r in got)
    assert not ids & {100 + i for i, t in enumerate(odd_texts) if not any(c.isalpha() for c in t or "")}
    starts = sorted((r.start, r.length) for r in got if r.doc_id == 0)
    assert starts[0][0] == 0 and len(starts) == 1               # the repeated row is there once
    docs.limit(0).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert P.run(spark, str(tmp_path / "none")).count() == 0
