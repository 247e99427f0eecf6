"""HTML extraction, the permutation index and the pipeline."""

import importlib
import math

import numpy as np
import pytest

from marquee.llm import html_text, permutation_index
from marquee.llm.common import stage
from marquee.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body>{body}</body></html>"


@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), ("plain words", "plain words"), ("<p>a &amp; b&nbsp;c<br>d</p>", "a & b c d"),
    (page("<nav><a>x</a></nav><article><h1>H</h1><p><b>one<br><p>two\n  three</article><footer>f</footer>"), "H\none\ntwo three"),
    (page("<div class='cookie-notice'>c</div><main><p>m</p><aside>s</aside><form>f</form></main>"), "m"),
    (page("<p title='a>b'>q</p><script>if (a<b) '<p>'</script><ul><li>i<li>j</ul><!-- <p>no</p> --><p hidden>h</p>cut &am"), "q\ni\nj\ncut &am"),
    (page("<article><p>keep</p><section class='comments'><p>nice</p></section><div id=sidebar-left>x</div></article>"), "keep"),
    ("<article><p>x</p>" * 3000, "\n".join("x" for _ in range(3000))),
    ("<main class='with-sidebar'><p>m</p></main>", "m"), ("<div class='content has-sidebar'><p>m</p></div>", "m"),
    ("<div class='page nav-open'>m</div>", "m"), ("<div title='A hidden gem'>m</div>", "m"),
    ("<div class='content sidebar-right'><p>m</p><div class='sidebar content'>s</div></div>", "m"),
    ("<article><h2 id='social-structure'>S</h2><p class='notice'>n</p><div class='notice'>gone</div></article>", "S\nn"),
    ("<p class='copyright'>c</p><h3 id='related-work'>R</h3><p aria-hidden=true>h</p><p style='display: none'>h</p><p>x</p>", "R\nx"),
    ("<main><h1>H</h1><p>the long body of the page</p><article>teaser</article></main>", "H\nthe long body of the page"),
    ("<article><p>long text of the article</p></article><article class=comment>me too, and much more than that</article>", "long text of the article"),
    ("<div>" * 500 + "deep", "deep"), ("<div>" * 9000 + "deep" + "</div>" * 9000 + "<p>x", "deep\nx"), ("<p>1 < 2 and 3 > 2</p>", "1 < 2 and 3 > 2"), ("<script>never closed", ""),
])
def test_blocks(html, text):
    assert "\n".join(t for t, _ in html_text.blocks_of(html or "")[0]) == text


def test_reading_is_linear_in_nesting():
    import time

    def seconds(n, unit):
        start = time.perf_counter()
        html_text.blocks_of(unit * n)
        return time.perf_counter() - start

    for unit in ("<div>a", "<b>a", "<div class=x><p>a"):
        seconds(2000, unit)
        assert seconds(40_000, unit) < 60 * max(seconds(2000, unit), 0.01)


def test_templates_of_a_host_are_removed(spark):
    def site(i, host="https://a.example"):
        menu = "<div><span>Home</span> <span>About us</span></div>"
        return (i, f"{host}/{i}", page(f"{menu}<div><p>Story {i} about {i * 7}.</p></div><div>Call us now</div>"))

    rows = [site(i) for i in range(6)] + [site(50, "https://b.example"), (60, None, None), (60, None, "<p>x</p>"), (None, "u", "<p>y</p>")]
    mirrors = [(i, f"https://c.example/{i}", page("<div><p>The same story.</p></div>")) for i in range(70, 80)]
    pages = spark.createDataFrame(rows + mirrors, "page_id long, url string, html string").selectExpr("*", "1 as host", "'t' as texts")
    got = html_text.extract(pages)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    text = {}
    for r in got.collect():
        assert r.n_chars == len(r.text)
        text.setdefault(r.page_id, []).append(r.text)
    for i in range(6):
        assert text[i] == [f"Story {i} about {i * 7}."]
    assert text[50] == ["Home About us\nStory 50 about 350.\nCall us now"]  # seen on one page only
    assert sorted(text[60]) == ["", "x"] and text[None] == ["y"]
    assert all(text[i] == ["The same story."] for i in range(70, 80))  # copies are no template
    assert html_text.extract(pages.where("false")).count() == 0


def test_quoted_paragraphs_of_articles_stay(spark):
    rows = [(i, f"https://a.example/{i}", page(f"<nav>N</nav><article><p>Own {i}.</p><p>A passage that all quote.</p></article>")) for i in range(9)]
    got = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert all(r.text == f"Own {r.page_id}.\nA passage that all quote." for r in got.collect())


def test_text_that_a_few_of_many_pages_share_stays(spark):
    """300 pages of a host: its menu goes; headings, cells and boxes that some share stay."""
    def body(i):
        box = "<div>See the notes.</div>" if i % 20 == 0 else ""
        return f"<div><span>Home</span></div><h2>Introduction</h2><p>Own {i}.</p><table><tr><td>Yes</td><td>{i}</td></tr></table>{box}"

    rows = [(i, f"https://a.example/{i}", page(body(i))) for i in range(300)]
    got = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(got) == 300
    for r in got:
        box = "\nSee the notes." if r.page_id % 20 == 0 else ""
        assert r.text == f"Introduction\nOwn {r.page_id}.\nYes\n{r.page_id}{box}"


def test_recall_of_the_permutation_index(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    want = permutation_index.exact(table)
    got = {}
    for r in permutation_index.search(table).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(got) == set(want)
    recall = np.mean([len({v for _, v, _ in got[q]} & set(want[q])) / len(want[q]) for q in want])
    assert recall >= 0.9
    vectors = {r.vec_id: np.array(r.embedding, float) for r in table.collect()}
    for q, rows in list(got.items())[:20]:
        assert [r for r, _, _ in sorted(rows)] == list(range(1, 21))
        assert all(s == pytest.approx(vectors[q] @ vectors[v], abs=1e-12) for _, v, s in rows)


def test_index_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 2.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [1.0, None]),
            (7, [inf, 1.0]), (8, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (20, [1.0, 0.0]), (20, [1.0, 0.0]), (9, [-1.0, -0.0]), (40, [0.5, 0.5])]
    rows += [(100 + i, [1.0, 0.0]) for i in range(1, 60)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as name", "2 as v")
    got = {}
    for r in permutation_index.search(table).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(got) == {0, 20, 40, 120, 140}
    assert got[0] == [(i, 1.0) for i in [1, 20, *range(101, 119)]]
    assert got[20] == [(i, 1.0) for i in [0, 1, *range(101, 119)]]
    assert got[40][0] == (2, 1.0) and got[40][1] == (0, 0.5)
    few = permutation_index.search(table.where("vec_id in (0, 2)")).collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in few] == [(0, 1, 2, 0.0)]
    assert permutation_index.search(table.where("false")).count() == 0


def test_every_operator_is_registered():
    assert [int(n[2:].split("_")[0]) for n in QUERIES] == list(range(1, 14))
    entry = importlib.import_module("__spark_entry__")
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())


def test_pipeline_stages(spark):
    import corpus_pipeline as pipeline
    from marquee.llm import fertility, jaccard, quality
    from marquee.llm.common import stage

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, [docs]
    for name, function in pipeline.STAGES:
        docs = stage(function(spark, docs, SF), "test-pipeline")
        if name != "packing":
            assert docs.columns == columns
        kept.append(docs)
    ids = [{r.doc_id for r in d.collect()} for d in kept]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    assert ids[1] == {r.doc_id for r in quality.classify(kept[0], labels).where("predicted = 1").collect()}
    assert ids[2] == {r.doc_id for r in fertility.judge(kept[1]).where("kept").collect()}
    assert ids[3] == {r.component_id for r in jaccard.jaccard_components(kept[2]).collect()}
    assert ids[4] <= ids[3] and kept[4].count() >= len(ids[4])
    per_doc = {r.doc_id: r.n for r in kept[4].groupBy("doc_id").count().withColumnRenamed("count", "n").collect()}
    pieces = kept[5].groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).collect()
    assert {r.doc_id: r["sum(length)"] for r in pieces} == {r.doc_id: r["max(doc_tokens)"] * per_doc[r.doc_id] for r in pieces}
    assert math.isclose(sum(per_doc.values()), kept[4].count())


def test_pipeline_runs_as_registered(spark):
    import corpus_pipeline as pipeline

    assert pipeline.run(spark, SF).count() > 0
    assert [n for n, _ in pipeline.STAGES] == [
        "quality classifier", "quality rules", "n-gram Jaccard join", "mixing sources to target weights", "packing",
    ]


def test_staged_rows_are_zstd_whatever_the_session_says(spark):
    back = stage(spark.range(3).selectExpr("id AS doc_id", "'a' AS text"), "test-stage")
    assert sorted(r.doc_id for r in back.collect()) == [0, 1, 2]
    assert all(name.endswith(".zstd.parquet") for name in back.inputFiles())
