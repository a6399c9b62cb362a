"""Vectors, pages and the pipeline."""

import html
import random
import re
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from leadlake.llm import embedding_dedup, html_extract
from leadlake.llm.queries import ORACLES, QUERIES
from tests.llm.conftest import EDGE_SCHEMA, edge_rows
from tests.oracle_check import compare, connect

SMOKE_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, name):
    assert compare(spark, connect(SMOKE_DIR), QUERIES[name], ORACLES[name], SMOKE_DIR) == ""


def test_names_are_complete():
    assert sorted(int(re.match(r"op(\d+)_", q)[1]) for q in QUERIES) == list(range(1, 14))


# ------------------------------------------------------------------------------------------- embeddings

def test_embedding_recall_against_brute_force(spark):
    rnd = np.random.default_rng(8)
    centres = rnd.normal(size=(60, 48))
    vectors = np.concatenate([centres + rnd.normal(size=centres.shape) * s for s in (0.0, 0.08, 0.13, 0.16, 0.2)])
    labels = np.tile(np.arange(60) % 3, 5)
    rows = [(i, [float(x) for x in v], int(k)) for i, (v, k) in enumerate(zip(vectors, labels))]
    got = embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    near = (unit @ unit.T >= 0.98) & (labels[:, None] == labels[None, :])
    np.fill_diagonal(near, False)
    assert near.sum() > 100
    found = sum(r.n_links for r in got)
    assert 0.98 * near.sum() <= found <= near.sum()
    assert all(r.n_links <= near[r.vec_id].sum() and r.kept == (r.vec_id == r.component_id) for r in got)


def test_embedding_edges(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, [1.0, 0.0], 1), (2, [1.0, 0.01], 1), (3, [0.0, 0.0], 1), (4, [1.0, None], 1), (5, None, 1), (6, [1.0, 0.0], None),
            (7, [nan, 1.0], 1), (8, [inf, 1.0], 1), (9, [1.0, 0.0], 2), (10, [1.0, 0.0, 0.0], 1), (11, [1.0, 0.0], 1),
            (11, [1.0, 0.0], 1), (None, [1.0, 0.0], 1), (12, [], 1), (13, [1e30, 1e28], 1)]
    frame = spark.createDataFrame([(*r, "clash") for r in rows], "vec_id long, embedding array<float>, label int, id string")
    got = embedding_dedup.near_duplicates(frame).collect()
    assert len(got) == len(rows)
    linked = {1, 2, 11, 13, None}
    for r in got:
        assert (r.n_links, r.component_id) == ((5, 1) if r.vec_id in linked else (0, r.vec_id))
    assert embedding_dedup.near_duplicates(frame.limit(0)).count() == 0


# ------------------------------------------------------------------------------------------------ pages

def test_html_rules():
    page = """<html><head><title>T</title></head><body><header><h1>Site</h1></header><nav>menu</nav><main><article class="post">
      <h1>Title &amp; x</h1><p>One <b>two</b>three&nbsp;four<br>five<p>six<ul><li>a<li>b</ul><div class="comments"><p>bad</p></div>
      <form>f</form><aside>as</aside><!-- c --><script>if(a<b){}</script>tail</article></main><div id="sidebar">s</div></body>"""
    assert html_extract.main_text(page, set()) == "Title & x One twothree four five six a b tail"
    assert html_extract.main_text("<div>" * 3000 + "deep", set()) == "deep"
    assert html_extract.main_text("plain <i>te</i>xt", set()) == "plain text"
    assert html_extract.main_text("<p>&#xD83D; x", set()) != ""


def test_html_marks_are_whole_names():
    """Only whole classes and ids mark, never what holds the article or most of the text, nor prose inside the article."""
    article = """<article><h2 id="related">Rel</h2><h2 id="related-work">Work</h2><section id="share-prices"><p class="notice">Up
      <a class="share">five</a></p></section><div class="comments"><article>c</article></div></article>"""
    for wrapper in ('div class="site has-sidebar"', 'div class="no-sidebar"', 'div class="widget"', 'form id="form1"'):
        page = f'<body><nav>n</nav><{wrapper}>{article}</{wrapper.split()[0]}><div class="ad">buy</div>'
        assert html_extract.main_text(page, set()) == "Rel Work Up five"
    page = '<div class="social"><p>A long text of the page in a box.</p><div class="ad">buy</div></div><div class="related">x</div>'
    assert html_extract.main_text(page, set()) == "A long text of the page in a box."
    page = '<div class="related"><article>card</article></div><article>A text.</article>'
    assert html_extract.main_text(page, set()) == "A text."
    page = '<script>' + "x" * 999 + '</script><div class="widget"><main>Text</main></div>Other words of this page'
    assert html_extract.main_text(page, set()) == "Text"
    page = '<div class="related"><article>card</article></div><p>The text of a page without an article.</p>'
    assert html_extract.main_text(page, set()) == "card The text of a page without an article."


def test_html_templates(spark):
    """Without telling names or an article element only recurrence tells the frame from the text."""
    rnd = random.Random(1)
    words = lambda n: " ".join(rnd.choice("alpha beta gamma delta rho tau phi".split()) + str(rnd.randrange(999)) for _ in range(n))
    pages, want = [], {}
    for i in range(12):
        body = [words(25), words(30), "The same sentence on every page."]
        frame = "<div><ul><li>Home<li>News</ul></div>" if i < 10 else ""
        text = "".join(f"<p>{b}</p>" for b in body)
        pages.append((i, "https://Example.com/x" if i % 2 else "http://user@example.com:80/y",
                      f"<body>{frame}<div><section>{text}</section></div><table><tr><td>Imprint</td></tr></table></body>", 1))
        want[i] = " ".join(body)
    pages += [(20, None, None, 1), (21, "no url", "", 1), (20, None, None, 1)]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string, host int")
    got = html_extract.extract(frame).collect()
    assert len(got) == 15
    for r in got:
        assert r.text == want.get(r.page_id, "") and r.n_chars == len(r.text)
    assert html_extract.extract(frame.limit(0)).count() == 0


def test_html_copies_of_a_page_are_no_template(spark):
    """Copies, even in other frames, count as one page of their host; the frame of distinct pages still goes."""
    article = "<article><h1>Head</h1><p>A text that is long enough.</p><ul><li>one<li>two</ul><section>part</section></article>"
    pages = [(i, "http://a.org/x", f"<div><ul><li>Home</ul></div>{article}<div>frame {i % 4}</div>") for i in range(8)]
    pages += [(10 + i, "http://b.org/x", f"<div>Home</div><p>Text {i % 4} of this page</p>") for i in range(8)]
    got = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    for i in range(8):
        assert got[i] == "Head A text that is long enough. one two part"
        assert got[10 + i] == f"Text {i % 4} of this page"


def test_html_recurrence_does_not_depend_on_the_host(spark):
    """Three distinct pages suffice on a host of any size, for the larger part of a page too; what meets by chance stays."""
    menu = "<div><ul><li>Home<li>News<li>Contact</ul></div>"
    notice = f"<div>{'We keep a notice that is longer than all the rest. ' * 3}</div>"
    cells = "<table><tr><td>1<td>2<tr><td>{0}<td>4</table>"
    pages = [(i, f"{menu if i < 4 else ''}{notice if i < 5 else ''}<div>Own text {i}</div>{cells.format(i)}") for i in range(700)]
    pages += [(1000, notice), (1001, "<ul><li>Home<li>An item of its own</ul><ul><li>Home<li>News<li>Now</ul>")]
    frame = spark.createDataFrame([(i, "http://a.org/", h) for i, h in pages], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_extract.extract(frame).collect()}
    for i in range(700):
        assert got[i] == f"Own text {i} 1 2 {i} 4"
    assert got[1000] == " ".join((notice[5:-6]).split()) and got[1001] == "Home An item of its own Now"


def test_html_articles_of_the_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r.text for r in html_extract.extract(pages).collect()}
    for p in pages.collect():
        article = re.search(r"<article>(.*?)</article>", p.html, re.S)[1]
        plain = html.unescape(re.sub(r"</?(p|h1|br)>", " ", article).replace("<b>", ""))
        assert got[p.page_id] == " ".join(plain.split())


# --------------------------------------------------------------------------------------------- pipeline

def run_stages(spark, docs, tmp_path, sf_dir=SMOKE_DIR):
    out = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, out[-1], sf_dir).write.parquet(f"{tmp_path}/{k}")
        out.append(spark.read.parquet(f"{tmp_path}/{k}"))
    return out


def test_pipeline_stages(spark, tmp_path):
    raw, good, single, clean, mixed, tokens = run_stages(spark, spark.read.parquet(f"{SMOKE_DIR}/documents.parquet"), tmp_path)
    ids = [{r.doc_id for r in df.select("doc_id").collect()} for df in (raw, good, single, clean, mixed, tokens)]
    assert ids[0] > ids[1] > ids[2] == ids[3] >= ids[4] == ids[5]
    assert all(df.columns == raw.columns for df in (good, single, clean, mixed))
    kept = {r.doc_id for r in QUERIES["op5_quality_rules"](spark, SMOKE_DIR).filter("kept").collect()}
    assert ids[1] == kept
    before = {r.doc_id: r.text for r in single.collect()}
    for r in clean.collect():
        assert (r.text == before[r.doc_id]) == ("[" not in r.text) and r.n_chars == len(r.text)
        assert not re.search(r"@[a-z0-9]+\.example", r.text)
    assert tokens.count() == mixed.count() and tokens.filter("not round_trip").count() == 0
    assert Counter(map(str, tokens.collect())) == Counter(map(str, corpus_pipeline.run(spark, SMOKE_DIR).collect()))


def test_pipeline_awkward_and_empty_tables(spark, tmp_path, edge, empty):
    for name, docs in (("edge", edge), ("empty", empty)):
        result = run_stages(spark, docs, tmp_path / name)
        assert result[-1].filter("not round_trip").count() == 0
    assert result[-1].count() == 0
    assert EDGE_SCHEMA and edge_rows()


def test_html_cost_of_deep_nesting():
    """Every start and end tag costs the same however many elements are open: four times as many take about four times as long."""
    from time import process_time

    from leadlake.llm.html_extract import main_text, subtree_hashes

    for page in (lambda n: "<div>" * n + "end", lambda n: "<i>" * n + "</b>" * n + "end", lambda n: "<p>" + "<i>" * n + "end" + "<div>x" * 9):
        times = []
        for n in (10_000, 40_000):
            start = process_time()
            subtree_hashes(page(n))
            assert main_text(page(n), set()).startswith("end")
            times.append(process_time() - start)
        assert times[1] < 10 * times[0]
