"""Harvests on large tables: as many tasks as rows need, pages without their tree, plain links without full resolution."""

from urllib.parse import urljoin, urlsplit

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from folioforge.functions import urls as U
from folioforge.operators import documents as P
from folioforge.operators import html_kernel as K
from folioforge.operators import relational as R
from folioforge.plans import harvest_queries as H

PIECES = ["<a href='x'>", "<A title=t HREF=y>", "<a>", "<a href>", "<a href='1' href='2&amp;3'/>", "</a>", "<p>", "<table>", "<td>", "</table>", "<b>", "</b>", "<i/>", "<br>", "<li>", "</ul>", "<script>x<a href=1></script>", "<template>", "</template>", "<!-- <a> -->", " t ", "&amp;", "&#1;", "<div>", "</div>", "<title>z</title>", "<", "<textarea>", "<a href=\"z"]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=14))
def test_anchors_are_the_trees(pieces):
    text = "".join(pieces)
    assert K.anchors_of(text) == K.anchors(K.parse(text))


def test_pages_of_harvests_need_no_tree(monkeypatch):
    want = [K.anchors(K.parse(html)) for *_, html, _ in H.CASES]
    monkeypatch.setattr(K, "parse", None)
    assert [K.anchors_of(html) for *_, html, _ in H.CASES] == want and K.anchors_of(None) == []


SIMPLE = ["<a href='x'>", "<A title=t HREF=y>", "<a>", "<a href>", '<a href="1&amp;3">', '<a href="1" href="2">', "<a href='>'>", "<a x='<b>'>", "</a>", "</A>", "</a>", "t", " t ", "&amp;", "&#1;", "<b>x</b>", "<B class=k> x</b>", "<i></i>", "<b>", "<p>", "<br>", "<!-- c -->", "<title>t</title>", "<title>a<b></title>", "<div title='a>b'>", "</p>"]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(SIMPLE[:8]), st.lists(st.sampled_from(SIMPLE[11:]), max_size=3), st.sampled_from(SIMPLE[8:11]), st.sampled_from(["", *SIMPLE])), max_size=4))
def test_simple_anchors_are_the_trees(anchors):
    text = "".join("".join((start, *inside, end, after)) for start, inside, end, after in anchors)
    assert K.anchors_of(text) == K.anchors(K.parse(text))


def test_simple_anchors_are_found_by_pattern(monkeypatch):
    """Pages whose anchors hold texts and inline elements of text alone aren't read token by token."""
    pages = [html for *_, html, _ in H.CASES if "<!--" not in html]
    want = [K.anchors(K.parse(html)) for html in pages]
    monkeypatch.setattr(K, "parse", None)
    monkeypatch.setattr(K, "_plain_anchors", None)
    assert len(pages) >= len(H.CASES) - 1 and [K.anchors_of(html) for html in pages] == want


BASES = ["https://h.org", "http://H.org/", "/a/", "a/b.htm", "..", "?q=/z", "#f", ";p", "//", " "]
HREFS = ["/", "a", "b.htm", ".", "..", "//", ";x", "?q", "#t", "%20", "é", " ", "\n", ":", "x.", "http://h.org"]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(BASES), max_size=3), st.lists(st.sampled_from(HREFS), max_size=5))
def test_plain_links_are_resolved_as_all_are(base, href):
    base, href = "".join(base), "".join(href)
    parts = urlsplit(urljoin(base, href))
    url, path, name, kept = U.located(base, href)
    if ";" not in parts.path:
        assert (path, url) == (parts.path, f"https://{parts.netloc}{parts.path}" if parts.netloc else f"https:{parts.path}") and kept.startswith(path) and path.endswith(name)


def test_plain_links_need_no_full_resolution(monkeypatch):
    monkeypatch.setattr(U, "urljoin", None)
    assert U.located("https://h.org/a/b.htm?x=/y", "c/d.htm#t") == ("https://h.org/a/c/d.htm", "/a/c/d.htm", "d.htm", "/a/c/d.htm")
    assert U.located("http://h.org/a/", "/v/") == ("https://h.org/v/", "/v/", "", "/v/index.html")


def test_links_of_parents_need_no_full_resolution(monkeypatch):
    monkeypatch.setattr(U, "urljoin", None)
    assert U.located("https://h.org/a/b/c.htm", "../d/e.htm#t") == ("https://h.org/a/d/e.htm", "/a/d/e.htm", "e.htm", "/a/d/e.htm")
    assert U.located("https://h.org/a/b", "../../d../") == ("https://h.org/d../", "/d../", "", "/d../index.html")


def test_links_with_nulls(spark):
    rows = [("https://h.org/a/b", "c", "t"), ("https://h.org/a/b", None, "t"), (None, "/c", None), ("https://h.org/a/b", "../c", "t")]
    got = spark.createDataFrame(rows, "base string, href string, text string").select(U.resolve_links("base", "href", "text").alias("l")).select("l.*").collect()
    assert [r.url for r in got] == ["https://h.org/a/c", None, "https:/c", "https://h.org/c"]
    assert [(r.base, r.string) for r in got] == [("https://h.org/a/b", "t"), (None, None), (None, None), ("https://h.org/a/b", "t")]
    assert spark.createDataFrame([], "base string, href string, text string").select(U.resolve_links("base", "href", "text").alias("l")).collect() == []


def test_tasks_grow_with_the_customers(spark, tmp_path, monkeypatch):
    """No task of a harvest has more of a level's pages than others: the table is one row group, which one task reads."""
    monkeypatch.setattr(R, "TASK_ROWS", 100)
    spark.range(1000).select(F.col("id").alias("c_custkey")).coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    for journal, levels, links in (("mmwr", 4, 5), ("pcd", 5, 7), ("eid", 6, 7)):
        found = H.harvested(spark, str(tmp_path), journal).withColumn("task", F.spark_partition_id())
        sizes = [r["count"] for r in found.groupBy("task").count().collect()]
        assert len(sizes) >= 10 * levels and sum(sizes) == links * 1000 and max(sizes) <= 2 * 100 * 2


def test_first_counts_by_rule(spark):
    """Of rules that look in pages together each takes its own pages' links, and the first only where it says so."""
    html = '<a href="/a">x</a><a href="/b"><b>x</b> y</a><a>x</a><a href="/a">z</a>'
    pages = spark.createDataFrame([("https://h.org/1", html), ("https://h.org/2", None)], "url string, html string")
    got = P.linked([(pages, P.Rule("one", "a", None, True)), (pages, P.Rule("two", None, "z")), (pages, P.Rule("three", base="https://k.org/"))])
    assert sorted((r.level, r.seq, r.url) for r in got.collect()) == [("one", 0, "https://h.org/a"), ("three", 0, "https://k.org/a"), ("three", 1, "https://k.org/b"), ("three", 3, "https://k.org/a"), ("two", 3, "https://h.org/a")]
    assert got.schema == P.links(pages, "one").schema
