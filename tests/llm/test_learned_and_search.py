"""Toxicity, mixing, top-k search, page text, licences and the pipeline."""

import random
import textwrap

import pytest

pytest.importorskip("numpy")

import corpus_pipeline  # noqa: E402
from panelwright.llm import dom, html_text, licenses, mixing, topk, toxicity  # noqa: E402
from panelwright.llm.queries import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"
FILLER = [f"word{i}" for i in range(80)]


def sentences(rng, n, bad=()):
    out = [" ".join(rng.choices(FILLER, k=8)) for _ in range(n)]
    for word in bad:
        out.insert(rng.randrange(len(out) + 1), " ".join([*rng.choices(FILLER, k=4), word, *rng.choices(FILLER, k=3)]))
    return ". ".join(out)


def test_toxicity_learns_from_documents_and_finds_sentences(spark):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(400):
        bad = [rng.choice(["vilest", "vilely", "awful"])] if i % 4 == 0 else []
        rows.append((i, sentences(rng, rng.randint(1, 12), bad), 1.0))
        labels.append((i, int(bool(bad))))
    rows += [(1000, None, 0.0), (1001, "", 0.0), (1002, "!!! ...", 0.0), (None, "awful word1. word2 word3", 0.0), (0, rows[0][1], 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxicity double")
    known = spark.createDataFrame([*labels, (None, 1), (5, None)], "doc_id long, toxic int")
    training = toxicity.training_rows(docs, known)
    fitted = {r.doc_id for r in training.collect()}
    from zlib import crc32

    assert fitted and all(crc32(str(i).encode()) % 5 for i in fitted)
    model = toxicity.fit(training)
    got = [(r.doc_id, r.text, r.toxicity) for r in toxicity.score(docs, model).collect()]
    assert len(got) == len(rows)
    for i, text, found in got:
        if i is not None and i < 400:
            assert (found.score >= 0.5) == bool(labels[i][1]), (i, found.score)
        for hit in found.offending:
            assert any(w in text.lower()[hit.start : hit.start + hit.length] for w in ("vil", "awful"))
    assert {i: f.score for i, _, f in got if i and i >= 1000} == {1000: 0, 1001: 0, 1002: 0}
    kept = toxicity.without_toxic(docs, known)
    assert kept.columns == docs.columns and kept.filter("toxicity = 1").count() == 300
    empty = toxicity.fit(toxicity.training_rows(docs.limit(0), known.limit(0)))
    assert toxicity.score(docs, empty).count() == len(rows)


def test_mixing_meets_targets(spark):
    rng = random.Random(2)
    rows, domains = [], []
    for i in range(300):
        kind = ("prose", "code", "table")[0 if i < 200 else 1 if i < 280 else 2]
        letters = {"prose": "abcdefgh ", "code": "(){};= x", "table": "0123456789|"}[kind]
        rows.append((i, "".join(rng.choices(letters, k=rng.randint(50, 400))), "keep", 2.0))
        domains.append((i, kind))
    rows += [(900, None, "keep", 1.0), (901, "", "keep", 1.0), (None, "abc abc", "keep", 1.0), (1, rows[1][1], "keep", 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, mix string, rate double")
    known = spark.createDataFrame([*domains, (None, "code"), (3, None)], "doc_id long, domain string")
    targets = {"prose": 0.5, "code": 0.3, "table": 0.2}
    got = mixing.rates(docs, known, targets).collect()
    assert len(got) == len(rows) and all(r.rate >= 0 for r in got)
    total = sum(r.mix.tokens for r in got)
    for k, name in enumerate(sorted(targets)):
        assert abs(sum(r.rate * r.mix.tokens * r.mix.posterior[k] for r in got) / total - targets[name]) < 1e-3
    named = dict(domains)
    assert sum(sorted(targets)[max(range(3), key=r.mix.posterior.__getitem__)] == named.get(r.doc_id) for r in got) > 290
    grown = mixing.repeated(docs, known, targets, least=1.0)
    assert grown.columns == docs.columns and grown.select("doc_id").distinct().count() == 303
    assert {r.mix for r in grown.collect()} == {"keep"}
    assert mixing.repeated(docs.limit(0), known, targets).count() == 0
    assert mixing.rates(docs, known.limit(0), targets).count() == len(rows)


def plain_top(vectors, queries, k):
    import math

    fine = [(i, [math.floor(1024 * x) for x in v]) for i, v in vectors if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q in queries:
        for query in [min(v for i, v in fine if i == q)] if any(i == q for i, _ in fine) else []:
            best = sorted((-sum(a * b for a, b in zip(query, v)), i) for i, v in fine if i != q)[:k]
            out += [(q, n, i, -s) for n, (s, i) in enumerate(best, 1)]
    return sorted(out)


def test_components_beyond_exact_scores_fail(spark):
    vectors = spark.createDataFrame([(100, [1e18, 1.0]), (1, [1e18, 2.0])], "vec_id long, v array<double>")
    with pytest.raises(Exception, match="too large for exact scores"):
        topk.usable(vectors, "v", 1024).collect()
    fine = spark.createDataFrame([(100, [1e5, -1.5])], "vec_id long, v array<double>")
    assert topk.usable(fine, "v", 1024).first()._v == [102400000, -1536]


def test_top_k_is_exact(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    vectors = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(rng.normal(size=(300, 6)))]
    vectors += [(300 + i, vectors[7][1]) for i in range(40)]  # ties
    vectors += [(400, None), (401, []), (402, [1.0, None]), (403, [float("nan")] * 6), (404, [float("inf")] * 6), (None, [1.0] * 6), (7, vectors[7][1]), (500, [0.0] * 6)]
    df = spark.createDataFrame([(i, v, 9) for i, v in vectors], "vec_id long, embedding array<float>, score int")
    queries = [0, 7, 100, 310, 400, 500]
    got = topk.top_k(df, df.filter(df.vec_id.isin(queries)), k=10, rows=64, block=2)
    assert sorted(tuple(r) for r in got.collect()) == plain_top(vectors, queries, 10)
    few = df.filter("vec_id < 4")
    assert topk.top_k(few, few).count() == 12
    assert topk.top_k(df.limit(0), df.limit(0)).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body class="has-sidebar">
<header class="site-header"><a href=/>Logo</a></header><nav><ul><li><a href="/x">menu %(n)d</a></ul></nav><div class="content-sidebar-wrap"><main><article>
<header class="entry-header"><h1>Head &amp; %(n)d</h1></header><div class="cookie-notice">cookies %(n)d</div><p><b>One<br>two&nbsp; three &lt;b&gt; %(n)d<p>Second <b>bold</b> x<i>y</i>
<p>Written for the gazette of the town</p><ul><li>a%(n)d<li>b</ul><aside>side %(n)d</aside><div class=advert>buy</div><form>f<input></form><footer>by me</footer></article>
<section id="comments"><article class="comment"><p>nice %(n)d</p></article></section></main><div class="sidebar">sb</div></div><footer>foot %(n)d</footer></body></html>"""


def test_page_text(spark):
    urls = [f"https://u:p@News.example.com:80/{n}" for n in range(8)] + ["https://other.example.com/1"]
    rows = [(n, url, PAGE % {"n": n}, "mine") for n, url in enumerate(urls)]
    rows += [(50, None, "plain <p>text &lt; 1", "x"), (51, "https://news.example.com/e", None, "x"), (52, "https://o.example.com", "", "x"), (None, "", "<p>x", "x")]
    rows += [rows[0]]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = [(r.page_id, r.text, r.n_chars) for r in html_text.extract(pages).collect()]
    assert len(got) == len(rows)
    for n, text, size in got:
        assert size == len(text)
        if n is not None and n < 9:  # most of the article is the same on all pages of the host, so it stays
            assert text == f"Head & {n}\nOne two three <b> {n}\nSecond bold xy\nWritten for the gazette of the town\na{n}\nb"
    found = {n: text for n, text, _ in got}
    assert (found[50], found[51], found[52], found[None]) == ("plain\ntext < 1", "", "", "x")
    assert html_text.extract(pages.limit(0)).count() == 0


def test_copies_on_one_host_keep_their_text(spark):
    page = "<body><nav>%d</nav><article><h1>Same</h1><p>text</p></article></body>"
    pages = spark.createDataFrame([(n, "http://h/x", page % n) for n in range(6)], "page_id long, url string, html string")
    assert {r.text for r in html_text.extract(pages).collect()} == {"Same\ntext"}


def extracted(spark, pages):
    rows = [(n, f"http://{h}/x{n}", html) for n, (h, html) in enumerate(pages)]
    got = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string"))
    return {r.page_id: r.text for r in got.collect()}


def story(n, k=40):
    rng = random.Random(n)
    return " ".join(f"word{rng.randrange(500)}" for _ in range(k))


@pytest.mark.parametrize("n_pages", [2, 4, 6])
def test_a_template_needs_two_pages(spark, n_pages):
    """Text that no mark betrays is template on hosts of any number of pages above one."""
    page = "<body><div><span>Home Weather today in town</span></div><div><p>%s</p><p>%s</p></div></body>"
    given = [("h.example", page % (story(n), story(n + 50))) for n in range(n_pages)]
    assert extracted(spark, given) == {n: f"{story(n)}\n{story(n + 50)}" for n in range(n_pages)}
    assert "Home Weather" in extracted(spark, given[:1])[0]


@pytest.mark.parametrize("marks", [("<article>", "</article>"), ("", "")])
def test_near_copies_on_a_host_keep_their_article(spark, marks):
    body = "".join(f"<p>{story(n)}</p>" for n in range(4))
    page = "<body><div>Home of news</div><div>" + marks[0] + "<h1>Headline %d</h1>" + body + marks[1] + "</div></body>"
    got = extracted(spark, [("h.example", page % n) for n in range(10)])
    for n in range(10):
        assert got[n].split("\n")[-5:] == [f"Headline {n}", *(story(k) for k in range(4))]


def test_a_stub_among_the_pages_of_a_host(spark):
    """One page of another layout, shorter than all, does not hide the template of the others."""
    page = "<body><div class='top'>Home Weather today in town</div><div class='text'><p>%s</p></div></body>"
    given = [("h.example", page % story(n)) for n in range(9)] + [("h.example", "<body><div class='lost'><p>" + "Not found " * 30 + "</p></div></body>")]
    got = extracted(spark, given)
    assert [got[n] for n in range(9)] == [story(n) for n in range(9)] and got[9].startswith("Not found")


def test_two_layouts_on_a_host(spark):
    one = "<body><div class='a'><i>Morning edition since 1901</i></div><div class='text'><p>%s</p></div></body>"
    two = "<body><div class='b'><b>Evening edition of the town</b><u>Buy it today</u></div><section class='s'><div><p>%s</p></div></section></body>"
    given = [("h.example", (one, two)[n % 2] % story(n)) for n in range(8)]
    assert extracted(spark, given) == {n: story(n) for n in range(8)}


def test_every_layout_of_a_host_has_a_template(spark):
    """Layouts beyond the commonest few are aligned with a page of their own."""
    page = "<body><div class='top%d'><i>Edition %d of the morning paper</i><div class='text'><p>%s</p></div></div></body>"
    given = [("h.example", page % (k, k, story(10 * k + n))) for k in range(9) for n in range(9 - k // 2)]
    texts = [story(10 * k + n) for k in range(9) for n in range(9 - k // 2)]
    assert extracted(spark, given) == dict(enumerate(texts))


def plain_text(page, others):
    """Page text by a plain version: nodes whose path and text recur on nearly all other pages of the host go, then marks decide."""
    def paths(node, path=()):
        yield path + (node.key,), node
        seen = {}
        for kid in node.kids:
            seen[kid.key] = seen.get(kid.key, -1) + 1
            yield from paths(kid, path + ((node.key, seen[kid.key]),))

    trees = [dict(paths(dom.parse(o))) for o in others]
    tree = dom.parse(page)
    constant = set()
    for path, node in paths(tree):
        if node.own_text() and sum(path in t and t[path].own_text() == node.own_text() for t in trees) >= 0.9 * len(trees):
            constant.add(node.at)
    return "\n".join(html_text.blocks(tree, frozenset(constant)))


def test_page_text_against_a_plain_version(spark):
    """On pages whose varying part is last among its neighbours, trees align as equal paths do."""
    page = "<body><div><span>Menu of day</span><span>%s</span></div><div><h2>%s</h2><p>%s</p><div><em>Printed here</em><p>%s</p></div></div></body>"
    pages = [page % tuple(story(9 * n + k, 12) for k in range(4)) for n in range(7)]
    got = extracted(spark, [("h.example", p) for p in pages])
    assert got == {n: plain_text(p, pages[:n] + pages[n + 1 :]) for n, p in enumerate(pages)}
    assert all("Menu" not in t and "Printed" not in t for t in got.values())


def test_tree_matching_against_a_plain_version():
    def plain(a, b):
        if a.key != b.key:
            return 0
        rows = [[0] * (len(b.kids) + 1) for _ in range(len(a.kids) + 1)]
        for i, x in enumerate(a.kids, 1):
            for j, y in enumerate(b.kids, 1):
                rows[i][j] = max(rows[i - 1][j], rows[i][j - 1], rows[i - 1][j - 1] + plain(x, y))
        return 1 + rows[-1][-1]

    rng = random.Random(6)

    def grow(depth):
        return "".join(f"<{t}>{grow(depth - 1)}</{t}>" for t in rng.choices(("div", "span", "section"), k=rng.randint(0, 4))) if depth else ""

    for _ in range(60):
        a, b = dom.parse(grow(3)), dom.parse(grow(3))
        assert dom.score(a, b, {}) == plain(a, b) == len(dom.align(a, b, {}))


def test_deep_and_broken_pages():
    deep = dom.parse("<div>" * 4000 + "deep" + "</div>" * 4000 + "<p>after")
    assert html_text.blocks(deep, frozenset()) == ["deep", "after"]
    assert dom.score(deep, deep, {}) == deep.size
    assert html_text.blocks(dom.parse("a < b <!-- open <p>c"), frozenset()) == ["a < b"]


def test_licenses(spark):
    mit = licenses.KNOWN[0][1]
    rows = [
        (1, "MIT License\n\nCopyright (c) 2020 Jane Roe\nAll rights reserved.\n\n" + mit.replace("sublicense", "sub-licence").upper().replace(", ", ",\n  ")),
        (2, None), (3, ""), (4, "Copyright x\n(c) y"), (5, "  * licenced UNDER the Apache LICENCE version 2.0 ..\nfoo\nReleased under the MIT License."),
        (None, "Released under the MIT Licence"), (6, "Released under the MIT Licence"), (6, "Released under the MIT Licence"), (7, mit + " with one word more"),
    ]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, license string")
    got = sorted(((r.doc_id or 0), r.license or "", r.notices, r.n_notices) for r in licenses.scan(docs, licenses.known_digests(spark)).collect())
    assert got == [
        (0, "MIT", [], 0), (1, "MIT", [], 0), (2, "", [], 0), (3, "", [], 0), (4, "", [], 0), (5, "", ["Apache-2.0", "MIT"], 2),
        (6, "MIT", ["MIT"], 2), (6, "MIT", ["MIT"], 2), (7, "", [], 0),
    ]
    assert licenses.scan(docs.limit(0), licenses.known_digests(spark)).count() == 0


ISC_BODY, BSD_BODY = (next(t for n, t in licenses.TEXTS if n == name) for name in ("ISC", "BSD-3-Clause"))


def test_published_forms_of_licenses(spark):
    """Wrapped bodies keep lines that begin with "copyright", titles and list marks fold, notices match behind blanks and marks."""
    wrapped = textwrap.fill(ISC_BODY, 60).replace(" copyright", "\ncopyright")
    stars = BSD_BODY.replace("1. ", "* ").replace("2. ", "* ").replace("3. ", "* ")
    mit = licenses.TEXTS[0][1]
    cases = [
        ("ISC", wrapped), ("BSD-3-Clause", "\n".join(textwrap.fill(p, 70).replace(" copyright", "\ncopyright") for p in BSD_BODY.split("\n"))), ("BSD-3-Clause", stars),
        ("ISC", f"ISC License\n\nCopyright (c) 2004-2010 by A. Body\n\n{wrapped}"), ("MIT", f"The MIT License (MIT)\n\n  Copyright Jane Roe\n{mit}"),
        ("ISC", ISC_BODY), ("BSD-3-Clause", BSD_BODY.replace("1. ", "(1) ").replace("2. ", "b) ").replace("\n", " ")),
        ("", "ISC License\nCopyright holders may say this."), ("MIT", "© 2020 Ürsula\n" + mit), ("MIT", "COPYRIGHT: 2020 x\ncopyright (C) y\n" + mit),
        ("", "Copyright notice\n" + mit), ("MIT", "Copyright Émile\nCopyright by Jane\n" + mit),
    ]
    notices = ["# SPDX-License-Identifier: MIT", "a\nb\n   Released under the MIT License.", "a\nb\nThis work is licensed under the GNU General Public License, version 3"]
    rows = [(i, t) for i, t in enumerate([t for _, t in cases] + notices)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.scan(docs, licenses.known_digests(spark)).collect()}
    assert [got[i].license or "" for i in range(len(cases))] == [name for name, _ in cases]
    assert [got[len(cases) + i].notices for i in range(3)] == [["MIT"], ["MIT"], ["GPL-3.0"]]
    import duckdb
    import pandas as pd

    db = duckdb.connect()
    db.register("documents", pd.DataFrame(rows, columns=["doc_id", "text"]))
    want = {r[0]: r[1:] for r in db.execute(licenses.SQL).fetchall()}
    assert {i: (r.license, ",".join(r.notices), r.n_notices) for i, r in got.items()} == want


@pytest.mark.parametrize("name", sorted(n for n, (_, sql) in QUERIES.items() if sql))
def test_query_equals_sql(spark, name):
    from check import compare, database

    run, sql = QUERIES[name]
    assert compare(run(spark, SF), sql, database(SF)) is None


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, given = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
            assert docs.select("doc_id").subtract(given.select("doc_id")).count() == 0
    result = corpus_pipeline.run(spark, SF)
    assert result.count() == docs.count() > 0
    assert sorted(r.ids_sha256 for r in result.collect()) == sorted(r.ids_sha256 for r in docs.collect())


def test_spellings_keep_what_candidates_are_chosen_by():
    for given, wanted in licenses.SPELLINGS:
        assert given[: licenses.FIRST] == wanted[: licenses.FIRST]
        assert len(wanted) < licenses.FACTOR * len(given) and len(given) < licenses.FACTOR * len(wanted)


def test_long_clean_texts_are_not_toxic(spark, monkeypatch):
    """Thousands of clean sentences, of words seen and unseen, stay clean; one toxic sentence among them is found."""
    rng = random.Random(12)
    rows, labels = [], []
    for i in range(400):
        bad = ["vilest"] if i % 4 == 0 else []
        rows.append((i, sentences(rng, 800 if i % 40 == 1 else rng.randint(1, 12), bad)))
        labels.append((i, int(bool(bad))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    training = toxicity.training_rows(docs, known)
    assert {r.doc_id for r in training.collect() if len(r[1]) > 16_384}
    model = toxicity.fit(training)
    unseen = ". ".join(" ".join(f"new{rng.randrange(10**6)}" for _ in range(8)) for _ in range(5000))
    long = [(1, sentences(rng, 3000)), (2, sentences(rng, 20_000)), (3, unseen), (4, sentences(rng, 3000, ["vilest"]))]
    got = {r.doc_id: r.toxicity.score for r in toxicity.score(spark.createDataFrame(long, "doc_id long, text string"), model).collect()}
    assert max(got[1], got[2], got[3]) < 0.5 < got[4]
    monkeypatch.setattr(toxicity, "SAMPLE_BYTES", 4000)
    few = toxicity.training_rows(docs, known).collect()
    assert {len(r[1]).bit_length() for r in few} == {len(r[1]).bit_length() for r in training.collect()} and len(few) < training.count()


def test_deep_nests_close_only_themselves():
    """Text after a deep nest is still in the article, and a menu in its depth is still a menu."""
    nest = "<div>" * 400 + "<nav>menu</nav>deep" + "</div>" * 400
    page = dom.parse(f"<div><article><p>before</p>{nest}<p>after</p></article></div><p>outside")
    assert html_text.blocks(page, frozenset()) == ["before", "deep", "after"]
    a, b = dom.parse("<div>" * 3000 + "<p>x"), dom.parse("<div>" * 3000 + "<b>x")
    assert dom.score(a, b, {}) == 3001 == len(dom.align(a, b, {}))
