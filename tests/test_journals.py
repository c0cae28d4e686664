"""Whole rows of the journals, fetching, and curation, where the tables' queries don't reach."""

import re

import pytest
from pyspark.sql import functions as F

from folioforge.functions import keywords as W
from folioforge.functions import text as T
from folioforge.operators import html_kernel as K
from folioforge.operators import journals as J
from folioforge.operators import relational as R


def pages(spark, *rows):
    return spark.createDataFrame(list(rows), "path string, html string")


def test_other_paths_and_empty_pages(spark):
    got = J.mmwr_datelines(pages(spark, ("/x.htm", "<p>"), ("/mmwr/preview/mm5010a1.htm", None), (None, None))).collect()
    assert sorted((r.path or "", r.src or "", r.dateline or "") for r in got) == [("", "", ""), ("/mmwr/preview/mm5010a1.htm", "var", " / "), ("/x.htm", "", "")]
    assert J.eid_datelines(pages(spark, ("/eid/article/1/2/000001_article.html", None))).first().dl_vol_iss is None
    assert J.pcd_article_datelines(pages(spark, ("/pcd/issues/2010/10_0001.htm", ""))).first().dl_vol_iss == "vv(i)"
    assert J.mmwr_datelines(pages(spark)).count() == J.eid_datelines(pages(spark)).count() == J.head_counts(pages(spark)).count() == 0


def test_volume_pages(spark):
    row = J.mmwr_datelines(pages(spark, ("/mmwr/preview/index84.html", "<h2>Past Volume (1)</h2><h1>Past Volumes (1982-1984) <i>x</i></h1>"))).first()
    assert (row.dateline, row.series, row.dl_date, row.dl_vol_iss, row.lang, row.src) == ("Past Volumes (1982-1984) x", "mmwr", "1984", "33", "en", None)
    eid = J.eid_datelines(pages(spark, ("/eid/past-issues/volume-9.html", "<p>Volume 9, Number 4—April 2003</p>"))).first()
    assert (eid.dateline, eid.dl_vol_iss, eid.dl_year_mo, eid.dl_page) == ("Volume 9", "09", "2003", None)


def test_short_paragraphs_only(spark):
    html = f"<div>Volume 3: No. 1, January 2006</div><p>Volume 4: No. 1, January 2007 {'x' * 300}</p><p>Volume 5: No. 3,\n July 2008</p>"
    dates = spark.createDataFrame([("05(3)", "2008-06-16")], "key string, value string")
    row = J.pcd_article_datelines(pages(spark, ("/pcd/issues/2008/jul/07_0001.htm", html)), None, dates).first()
    assert (row.dateline, row.dl_vol_iss, row.dl_year_mo, row.dl_date, row.dl_art_num) == ("Volume 5: No. 3, July 2008", "05(3)", "2008-07", "2008-06-16", "")


def test_details(spark):
    def row(dateline):
        html = f'<meta name="Volume" content=" 32 "><script>var reportTitle = "{dateline[0]}"; var reportDate = "{dateline[1]}";</script>'
        return J.mmwr_dateline_details(pages(spark, ("/mmwr/preview/mmwrhtml/mm3213a1.htm", html))).first()

    r = row(("Weekly", "April 08, 1983 / 32(13);171-172,178"))
    assert (r.fn_stan, r.fn_vol, r.src, r.md_Volume, r.dl_ser, r.dl_date, r.dl_vol_num, r.dl_iss_num, r.dl_page, r.dl_repr, r.dl_npgs) == (True, "32", "var_dl", "32", "mm", "1983-04-08", "32", "13", 171, "171-172,178", 3)
    r = row(("Something else", "June 1983"))
    assert (r.dl_ser, r.dl_date, r.dl_vol_num, r.dl_iss_num, r.dl_page, r.dl_npgs) == ("", "june 1983", "", "", 0, 0)


def test_contents_with_fixed_datelines(spark):
    rows = pages(spark, ("/pcd/es/2011_sep_toc.htm", "ISSN 1 Volume 8: No. 5, 2011"), ("/pcd/es/2010_jul_toc.htm", "none"), ("/pcd/issues/2004/apr/toc.htm", "Volume 0 1999 ISSN x Volume 1:\n No. 2, April 2004"), ("/pcd/issues/2023/2023_TOC.htm", "ISSN"))
    got = {r.path: (r.lang, r.dateline, r.dl_year_mo) for r in J.pcd_contents_datelines(rows).collect()}
    assert got == {
        "/pcd/es/2011_sep_toc.htm": ("es", "Volumen 8: Nº 5, septiembre de 2011", "2011-09"), "/pcd/es/2010_jul_toc.htm": ("es", None, "2010-07"),
        "/pcd/issues/2004/apr/toc.htm": ("en", "Volume 1: No. 2, April 2004", "2004-04"), "/pcd/issues/2023/2023_TOC.htm": ("en", None, "2023"),
    }


def test_links_by_the_tree_and_by_pattern(spark):
    """On the pages that hold none but plain anchors both give the same; table functions too."""
    from folioforge import registry

    q, sf = registry.queries(), "/root/testdata/sf0.001"
    plain = sorted((r.page_id, r.seq, r.href) for r in q["anchors_harvest"](spark, sf).collect())
    assert plain and plain == sorted((r.page_id, r.seq, r.href) for r in q["anchors_parsed"](spark, sf).collect()) == sorted((r.page_id, r.seq, r.href) for r in q["anchors_lateral"](spark, sf).collect())


def test_table_functions(spark):
    from folioforge.functions import tables

    tables.register(spark)
    html = '<head><title>t</title><meta name="a" content="b"></head><A HREF="/x">y<b>z</b></A>'
    assert spark.sql(f"select * from html_anchors('{html}')").collect() == [(0, "/x", None, "y|z")]
    assert spark.sql(f"select url from html_anchors('{html}', 'http://h.org/a/b')").collect() == [("https://h.org/x",)]
    with pytest.raises(Exception, match="texts are needed"):
        spark.sql("select * from html_anchors(1)")
    assert spark.sql(f"select * from html_metas('{html}')").collect() == [(0, "a", "b")]
    assert [(r.tag_name, r.n_attr) for r in spark.sql(f"select * from html_tags('{html}')").collect()] == [("head", 0), ("title", 0), ("meta", 2)]
    df = spark.createDataFrame([(k, html.replace("/x", f"x{k}")) for k in range(40)] + [(41, None), (42, "<p>")], "page int, html string")
    assert sorted((r.page, r.href) for r in spark.sql("select * from anchors_of(table({t}))", t=df).collect()) == sorted((str(k), f"x{k}") for k in range(40))
    assert spark.sql("select * from tags_of(table({t}))", t=df).count() == 3 * 40 + 1 and spark.sql("select * from metas_of(table({t}))", t=df).count() == 40
    with pytest.raises(Exception, match="columns page and html"):
        spark.sql("select * from metas_of(table({t}))", t=df.drop("page")).collect()


def test_citations_and_probe(spark):
    html = '<title>Volume 9, Number 4—April 2003</title><table><tr><th>AMA</th><th>x</th><td class="citationCell">a <i>b</i></td></tr><tr><th>EID<td class="y">no<td class="z citationCell">c</table>'
    assert J.citation_cells(pages(spark, ("p", html), ("q", ""))).orderBy("path").collect()[0][1:] == ("AMA|EID|x", "ab", "", "c")
    assert J.eid_probe(pages(spark, ("p", html))).first().dl_title == "Volume 9, Number 4—April 2003"
    assert K.text_nodes(K.parse("a<p>b<i>ab</i>a</p>"), re.compile("a")) == [(0, "#root", 19, "a", "ababa"), (1, "i", 9, "ab", "ab"), (2, "p", 18, "a", "baba")]


def test_first_meta_counts(spark):
    row = J.head_metadata(pages(spark, ("p", '<meta name="description" content=""><meta name="description" content="later"><meta name="keywords" content="a; b">')), "mmwr").first()
    assert (row.md_description, row.md_desc, row.md_kwds, row.title, row.link_canon, row.md_authors) == ("", "", "a|b", "", "", "")


def test_suggested_citation_goes_as_far_as_it_can(spark):
    text = "fever, Suggested citation for this article: A B, C D, title, journal, 2010, pages, cough"
    got = spark.createDataFrame([(text,)], "x string").select(W.joined(W.eid_keywords(F.col("x")), ignore=W.EID_IGNORE).alias("y")).first().y
    assert got == "cough|fever"


def test_bytes_read_as(spark):
    df = spark.createDataFrame([(b"a \n b\xe9", "latin_1"), (b"\xc3\xa9", "utf_8"), (b"\x81", "cp1252"), (None, None)], "c binary, k string")
    got = df.select(T.fetched_text("c").alias("t"), T.decode_as("c", "k").alias("d")).collect()
    assert [(r.t, r.d) for r in got] == [("a bé", "a \n bé"), ("é", "é"), ("", "\\x81"), ("", None)]


def test_curation(spark):
    links = spark.createDataFrame([("/a", "Este x", "/a_es.htm"), ("/a", "A", "/a_es.htm"), ("/b", "Este y", "/b_es.htm"), ("/c", "", "/c")], "path string, string string, url string")
    assert sorted(r.string for r in R.drop_repeated_notices(links, "Este ", "_es.htm").collect()) == ["A", "Este y"]


def test_keywords_are_of_whole_texts(spark, tmp_path):
    """By brute force: all words of a text, those far into it too, and documents without a language."""
    from folioforge import registry

    sf, q = "/root/testdata/sf0.001", registry.queries()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    heads = {r.path: r.md_kwds for r in q["journal_head_metadata"](spark, sf).collect()}
    assert len(heads) == len(docs)
    for i, r in docs.items():
        words = {"".join(c for c in w if "a" <= c <= "z") for w in (r.text or "").split(" ")}
        assert heads[f"/d/{i}"] == "|".join(sorted(words - {""} | {"zeta"}))
    for name in ("kwds_mmwr", "kwds_eid", "kwds_pcd"):
        got = {r.doc_id: r.md_kwds.split("|") for r in q[name](spark, sf).collect()}
        late = [(i, w) for i, r in docs.items() for w in (r.text or "").split(" ")[8:] if w.isascii() and w.isalpha() and w.islower() and len(w) > 7]
        assert len(got) == len(docs) and late and sum(w in got[i] for i, w in late) > 0.9 * len(late)
    spark.createDataFrame([(1, "a b c d", None)], "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    assert [r.md_kwds for r in q["journal_head_metadata"](spark, str(tmp_path)).collect()] == ["a|b|c|d|zeta"]


def test_one_page_ranges_are_returned(spark):
    from folioforge import registry

    sf = "/root/testdata/sf0.001"
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    rows = registry.queries()["dateline_detail"](spark, sf).collect()
    one = [r for r in rows if r.o_orderkey % 7 == 0]
    assert len(rows) == orders.count() and one and all((r.dl_page, r.dl_npgs) == (r.o_orderkey % 900 + 1, 1) for r in one)


def test_pages_as_both_codecs_read_them(spark):
    from folioforge.plans import journal_queries as Q

    pages = [(1, "naïve — Ünï"), (2, "plain"), (3, ""), (4, None)]
    got = {(r.page_id, r.codec): r.t for r in Q.page_renditions(spark.createDataFrame(pages, "page_id long, html string")).collect()}
    assert got == {(i, c): t if t is None else t.encode().decode(c) for i, t in pages for c in ("utf_8", "latin_1")}
