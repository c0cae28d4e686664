"""Vectors for the scalar functions and the HTML kernel."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from folioforge.functions import datelines as D
from folioforge.functions import keywords as W
from folioforge.functions import text as T
from folioforge.functions import urls as U
from folioforge.operators import html_kernel as K
from folioforge.operators import relational as R
from folioforge.sources import readers, writers


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(
    "base, href, url, kept",
    [
        ("https://www.cdc.gov/mmwr/about.html", "/mmwr/about.html", "https://www.cdc.gov/mmwr/about.html", "/mmwr/about.html"),
        ("https://wwwnc.cdc.gov/eid/", "/eid/", "https://wwwnc.cdc.gov/eid/", "/eid/index.html"),
        ("https://wwwnc.cdc.gov/eid/", "/eid/past-issues/volume-30", "https://wwwnc.cdc.gov/eid/past-issues/volume-30", "/eid/past-issues/volume-30.html"),
        ("https://h.org/a/b/c.htm", "../x.htm?y=1#z", "https://h.org/a/x.htm", "/a/x.htm"),
        ("http://h.org/a/", "#top", "https://h.org/a/", "/a/index.html"),
        ("https://h.org/a/b.htm", "//m.org/q;p=1", "https://m.org/q", "/q.html"),
        ("https://h.org/a/", ".hidden", "https://h.org/a/.hidden", "/a/.hidden.html"),
        ("https://h.org/a/", "b.c/d.", "https://h.org/a/b.c/d.", "/a/b.c/d."),
        ("https://h.org/a/b.htm", "mailto:x@y.z", "https:x@y.z", "x@y.z"),
    ],
)
def test_links(base, href, url, kept):
    row = U.resolve(base, href, "t")
    assert (row["url"], row["mirror_path"]) == (url, kept)


def test_mirror_paths(spark):
    paths = ["/a/", "/a/b", "/a/b.htm", "/a/.hidden", "/a/..x", "/a/.x.y", "\\a\\b", "/a.b/c"]
    got = spark.createDataFrame([(p,) for p in paths], "p string").select(U.mirror_path(F.col("p")).alias("m")).collect()
    assert [r.m for r in got] == ["/a/index.html", "/a/b.html", "/a/b.htm", "/a/.hidden.html", "/a/..x.html", "/a/.x.y", "/a/b.html", "/a.b/c.html"]


def test_native_resolution_agrees(spark):
    cases = [("https://h.org/a/b.htm", h) for h in ("/x/y.htm?q=1", "http://o.org/z#t", "//m.org/q;p=1", "#top")]
    df = spark.createDataFrame(cases, "base string, href string").select("base", "href", U.resolve_native(F.col("base"), F.col("href")).alias("u"))
    assert all(r.u == U.resolve(r.base, r.href, "")["url"] for r in df.collect())


@pytest.mark.parametrize(
    "raw, text",
    [
        (b'<meta charset="windows-1252">\x93a\x94\x81', '<meta charset="windows-1252">“a”\\x81'),
        (b'<meta charset="utf-8">\xe2\x80\x99\xc2\x80\xff', '<meta charset="utf-8">’\x80\\xff'),
        (b"no decl \x97", "no decl —"),
        (b'<meta charset="gb2312">\xd6\xd0\xff', '<meta charset="gb2312">中\\xff'),
        (b'<meta charset="big5">\xa4\xa4', '<meta charset="big5">中'),
    ],
)
def test_decode(raw, text):
    assert T.decode_bytes(raw) == text


def test_entities(spark):
    got = one(spark, "&thinsp;123 1&thinsp;234 &#129;x&#157; &lrm;&#8203;A &amp;lt; &lt;b&gt; &#150; &copy", T.repair_entities)
    assert got == ",123 1,234 üx A &lt; <b> – ©"


def test_space(spark):
    assert one(spark, "a b c \r\n  d e  \n\n\n\nf", T.reduce_space) == "a b c\nd\ne\n\nf"
    sparing = lambda c: T.reduce_space(c, keep_pre=True)
    assert one(spark, "<pre >a  b  </pre>  \nx", sparing) == "<pre >a  b  </pre>\nx"
    assert one(spark, "  <PRE>\n   <b>a  <i>  x \n   \n\n\n  c</pre>", sparing) == "<PRE>\n<b>a  <i>  x\n\n  c</pre>"
    assert one(spark, " <p>a  <b>  x ", sparing) == "<p>a <b> x" and one(spark, "<pre>a  b", T.reduce_space) == "<pre>a b"
    flags = spark.createDataFrame([("<pre>a  b", True), ("<pre>a  b", False)], "x string, f boolean").select(T.cleaned(F.col("x"), F.col("f")).alias("y")).collect()
    assert [r.y for r in flags] == ["<pre>a  b", "<pre>a b"]


@pytest.mark.parametrize("text, n, shown", [("v", 1, "v"), ("i-v", 5, "i-v"), ("5", 1, "5"), ("5-9", 5, "5-9"), ("15-9", 5, "15-19"), ("105-9", 5, "105-109"), ("105-19", 15, "105-119"), ("007-9", 3, "7-9"), ("0005", 1, "5"), ("x-xv", 6, "x-xv"), ("9-5", -3, "9-5"), (" 7 - 9 ", 3, "7-9"), ("", 1, "")])
def test_page_range(spark, text, n, shown):
    got = one(spark, text, D.page_range)
    assert (got.n, got["repr"]) == (n, shown)


@pytest.mark.parametrize("text", ["5-x", "i-xx", "1-2-3", "5a", "-5", "i-"])
def test_unreadable_ranges(spark, text):
    assert one(spark, text, D.page_range).n is None


DATES = ["January 5, 1999", "Jan. 5, 1999", "5 January 1999", "1/5/1999", "13/5/1999", "1999-01-05", "Friday, March 5, 1999", "Sept 4, 2001", "May 5 1999", "March 5th, 1999", "1999/2/3", "june 3, 1983", "5 de enero de 1999", "5 enero 1999", "enero 5, 1999", "June 4 / 5, 1999", "", "February 30, 1999"]


def test_dates_are_those_of_the_parser(spark):
    """For dates that state all parts; of others a part would be made up."""
    from dateutil.parser import ParserError, parse

    for text in DATES:
        try:
            want = parse(text).date().isoformat()
        except (ParserError, ValueError):
            want = None
        assert one(spark, text, D.long_date) == want, text
    assert one(spark, "January 1999", D.long_date) is None


def test_dates_in_any_order(spark):
    """Of a generated set, and as the reference reads them: years of two digits, any order, ordinals, times behind."""
    import datetime
    import random
    import warnings

    from dateutil.parser import parse

    rng = random.Random(2)
    texts = {"6/3/83": "1983-06-03", "5-May-1983": "1983-05-05", "1983 May 1": "1983-05-01", "May 1, 1983, 10 AM": "1983-05-01", "20030107": "2003-01-07", "830501": "1983-05-01", "99 May 1": "1999-05-01", "13/5/99": "1999-05-13", "May 1 '83": "1983-05-01", "May 1983 1": "1983-05-01"}
    texts |= dict.fromkeys(["foo 1 1983", "May May 1 1983", "1 2 3 4", "2003-13-01", "May 1", "1 de mayo de 1983", "", "Feb 30 1983"])
    warnings.simplefilter("ignore")
    for _ in range(1500):
        d = datetime.date(rng.randint(1976, 2030), rng.randint(1, 12), rng.randint(1, 28))
        parts = [rng.choice([str(d.year), str(d.year), f"{d.year % 100:02d}"]), rng.choice([f"{d:%B}", f"{d:%b}", str(d.month), f"{d:%m}", f"{d:%B}".upper()]), rng.choice([str(d.day), f"{d:%d}", f"{d.day}{rng.choice(['st', 'nd', 'rd', 'th'])}"])]
        rng.shuffle(parts)
        text = rng.choice(["", "", "Friday, ", "Wed. "]) + rng.choice([" ", ", ", "-", "/", " / ", ". "]).join(parts) + rng.choice(["", "", " 10:30", ", 10 AM", " 10:30:05 pm", " at 9:00"])
        try:
            texts[text] = parse(text, default=datetime.datetime(2026, 1, 1)).date().isoformat()
        except (ValueError, OverflowError):
            texts[text] = None
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", D.long_date(F.col("t")).alias("d")).collect()
    assert {r.t: r.d for r in got if r.d != texts[r.t]} == {}


def test_issues_and_pages_are_numbers(spark):
    values = {"33(001);00012": ("33(01)", "0012"), "33(Special Issue 2);1": ("33(02)", "0001"), "33(Special Issue);xi": ("33(SP)", "xi"), "33(No. 7);12345-6": ("33(07)", "12345"), "33(x);1": (None, "0001"), "33(00);000": ("33(00)", "0000")}
    df = spark.createDataFrame([(f"Weekly / May 1, 1984 / {k}",) for k in values], "dl string")
    parts = D.mmwr(F.col("dl"))
    got = df.select("dl", parts["dl_vol_iss"].alias("i"), parts["dl_page"].alias("p")).collect()
    assert {r.dl.split(" / ")[2]: (r.i, r.p) for r in got} == values


def test_heads_end_at_their_own_tag():
    text = '<html><head><script>var a="</head><body>";</script><!-- </head> --><title>a b</title><meta name="x" content="</head>"></head><body><title>no</title>'
    for t in (text, text.replace("</head><body>", "<body >"), text.replace("<html>", "<HTML>")):
        root = K.parse_head(t)
        assert root.find("title").stripped() == "a b" and [x[2].get("content") for x in K.tags(root) if x[0] == "meta"] == ["</head>"] and len(list(root.find_all("title"))) == 1
    assert K.parse_head("<title>t</title><p>x").find("p") is not None and K.parse_head(None).children == []


def test_emphasis_in_texts_is_escaped():
    md = lambda x: K.markdown(K.parse(f"<body>{x}</body>"))
    assert md("a*b_c <b>x_y</b> <code>p_q*</code> <kbd><i>k_</i></kbd>") == r"a\*b\_c __x\_y__ `p_q*` `_k__`"
    assert md("<pre>a_b*</pre>") == "```\na_b*\n```" and md('<a href="/a_b">c_d</a>') == r"[c\_d](/a_b)"


def test_pages(spark):
    assert tuple(one(spark, "5-x,8-9", D.pages)) == (0, "", 0, "")
    assert tuple(one(spark, "ND-719 - 722; 0730", D.pages)) == (719, "719-722,730", 5, "nd")
    assert tuple(one(spark, "Q1-Q4", D.pages)) == (1, "1-4", 4, "q")
    assert tuple(one(spark, "pp. 12–5.", D.pages)) == (12, "12-15", 4, "")
    assert tuple(one(spark, "SS1", D.pages)) == (1, "1", 1, "ss")
    assert tuple(one(spark, "x\ny", D.pages)) == (0, "x", 1, "") and tuple(one(spark, "x\ni", D.pages)) == (0, "", 0, "")
    assert tuple(one(spark, "856-857;859-869", D.pages)) == (856, "856-857,859-869", 13, "")
    assert tuple(one(spark, "i-iii,vii-viii,1-17", D.pages)) == (1, "i-iii,vii-viii,1-17", 22, "")
    assert tuple(one(spark, "", D.pages)) == (0, "", 0, "")


def test_datelines(spark):
    def row(text, f):
        return spark.createDataFrame([(text,)], "x string").select(*(c.alias(n) for n, c in f(F.col("x")).items())).first().asDict()

    assert row("Weekly / April 08, 1983 / 32(13);171-172,178", D.mmwr) == {"series": "mmwr", "dl_date": "1983-04-08", "dl_vol_iss": "32(13)", "dl_year_mo": "1983", "dl_page": "0171"}
    assert row("Recommendations and Reports / June 25, 1993 / 42(RR-10);i-iii,vii-viii,1-17", D.mmwr)["dl_vol_iss"] == "42(10)"
    assert row("Weekly / January 1, 2021 / 69(5152);1953-1956", D.mmwr) | {"x": 0} == {"series": "mmwr", "dl_date": "2021-01-01", "dl_vol_iss": "69(5152)", "dl_year_mo": "2020", "dl_page": "1953", "x": 0}
    assert set(row("nothing here", D.mmwr).values()) == {None}
    assert row("Other / June 25, 1993 / 42(1);3", D.mmwr)["series"] == "mm" and row("_ / x / 42(1);3", D.mmwr)["series"] == "mm_"
    assert row("/mmwr/preview/ind1985.html", D.mmwr_volume_path)["series"] == "mm" and row("/mmwr/index2004.html", D.mmwr_volume_path)["series"] == "mmwr"
    detail = row("Weekly / 5 Junio 1983 / 32a(13);007-9", D.mmwr_detail)
    assert (detail["dl_ser"], detail["dl_date"], detail["dl_vol_num"], detail["dl_vol_anno"], detail["dl_iss_num"], detail["pages"]["dl_repr"]) == ("mm", "5 junio 1983", "32", "a", "13", "7-9")
    assert row("_ / _ / _", D.mmwr_detail)["dl_ser"] == "_"
    assert one(spark, 'reportTitle = ""; reportDate = "";', D.mmwr_script_dateline) == "_ / _ / _" == one(spark, "", D.mmwr_script_dateline)
    assert row("/pcd/issues/2012/jan/12_0069.htm", D.pcd_path) == {"year": "2012", "month": "01", "volume": "09", "article": "12_0069"}
    assert [one(spark, p, D.pcd_english) for p in ("/pcd/issues/2012/12_0069.htm", "/pcd/issues/2012/12_0069_es.htm", "/x/cover.htm")] == [True, False, True]
    assert row("/mmwr/preview/ind1985_su.html", D.mmwr_volume_path) == {"series": "mmsu", "dl_date": "1985", "dl_vol_iss": "34"}
    got = row("/mmwr/preview/mmwrhtml/rr5810a1_ensp.htm", D.mmwr_article_path)
    assert (got["lang"], got["fn_ser"], got["fn_vol"], got["fn_iss"], got["fn_aem"], got["fn_seq"], got["fn_sfx"]) == ("es", "rr", "58", "10", "a", "1", "_ensp")
    eid = lambda level: lambda c: D.eid(c, F.lit(level))
    assert row("Volume 23, Supplement—December 2017", eid(False))["dl_vol_iss"] == "23(SU)"
    assert row("Volume 9, Number 4—April 2003", eid(True)) == {"dateline": "Volume 9", "dl_vol_iss": "09", "dl_year_mo": "2003"}
    assert one(spark, "2017;23(12):2029", D.eid_page) == "2029"
    assert row("Volume 5: No. 3, July 2008", D.pcd) == {"dl_vol_iss": "05(3)", "dl_year_mo": "2008-07", "dl_date": "xxxx-xx", "dl_cat": ""}
    assert row("ORIGINAL RESEARCH — Volume 16 — August 15, 2019", D.pcd) == {"dl_vol_iss": "16", "dl_year_mo": "2019", "dl_date": "2019-08-15", "dl_cat": "ORIGINAL RESEARCH"}
    assert row("?", D.pcd)["dl_vol_iss"] == "vv(i)"
    assert row("/pcd/es/2011_sep_toc.htm", D.pcd_toc_path) == {"lang": "es", "dl_year_mo": "2011-09"}


def test_keywords(spark):
    assert one(spark, "MMWR, measles,outbreak, and vaccine", lambda c: W.joined(W.mmwr_keywords(c), W.mmwr_keywords(F.lit("CDC; measles")), ignore=W.MMWR_IGNORE)) == "measles|outbreak|vaccine"
    assert one(spark, "a (CSTE) b", lambda c: W.joined(W.mmwr_keywords(c), ignore=W.MMWR_IGNORE)) == ""
    assert one(spark, "diabetes; obesity, PCD", lambda c: W.joined(W.pcd_keywords(c), W.pcd_keywords(F.lit("")), ignore=W.PCD_IGNORE)) == "diabetes|obesity"


def test_labels(spark):
    assert one(spark, "mmsu", lambda c: R.collection(c, F.lit("article"), F.lit("es"))) == "mmwr_art_es"
    assert [one(spark, v, D.banding) for v in ("12", "13", "24", "25", "x")] == ["eid0", "eid1", "eid2", "eid3", ""]


PAGE = """<html><head><title> A &amp; B </title><meta name="keywords" content="k"><meta name=Keywords><link rel="canonical" href="/c"></head>
<body><h1>T</h1><p>one<p>two <b>bold</b> <a href="/x">y <i>z</i></a><script>var a="</p>";</script><ul><li>p<li>q</ul>
<table><tr><th>EID<td class=citationCell>2017;23(12):2029<tr><td>a<td>b</table><svg w=1><g><path d="M"/></g></svg></body></html></body>"""


def test_kernel():
    root = K.parse(PAGE)
    assert K.head_meta(root) == ("A & B", "/c", [("keywords", "k")])
    assert K.anchors(root) == [("/x", "y|z", None)] and K.anchors(K.parse("<A HREF=/y class=k><!-- --> only </A><a>x</a>")) == [("/y", "only", " only "), (None, "x", "x")]
    assert next(s.text() for th in root.find_all("th") if (s := th.next_element())) == "2017;23(12):2029"
    md = K.markdown(K.parse(PAGE))
    assert "# T #" in md and "two __bold__ [y _z_](/x)" in md and "* p\n* q" in md and "| a | b |" in md
    assert "var a" not in K.plain_text(K.parse(PAGE))
    assert K.trim_svg(PAGE).count("<svg>") == 1 and "M" not in K.trim_svg(PAGE).split("<svg>")[1].split("</svg>")[0]
    n, trimmed, lengths = K.svg_lengths(PAGE)
    assert n == 1 and lengths == sorted(lengths, reverse=True) and trimmed == len(K.trim_svg(PAGE))
    twice = "<p>a</p><svg a=1><svg b='x'>t<path d=1 /></svg><text>u<b>v</b>w</text></svg><svg></svg>"
    n, trimmed, lengths = K.svg_lengths(twice)
    assert n == 3 and trimmed == len(K.trim_svg(twice)) and lengths[0] == len(K.parse(twice).serialise()) and lengths[-1] == len("<p>a</p>")
    assert K.parse(None).text() == "" and K.markdown(K.parse("")) == ""


def tolerant(text):
    b = K._Builder()
    b.feed(text)
    b.close()
    return b.root


def shape(n):
    return n if isinstance(n, str) else (n.name, n.attrs, [shape(c) for c in n.children])


PIECES = ["<p>", "</p>", "<b class=x id='y'>", "</b>", "<br/>", "<a href=\"/x?a=1&amp;b=2\">", "</a>", "<script>", "</script>", "var a='<p>';", "<!-- c -- d -->", "<!-->", "<!DOCTYPE html>", "a & b", "&lt;i&gt;", "&copy 1", " < ", "<title>", "</title>", "<li", "<td x=>", "\n", "é", "<style>", "</style >", "&", "<img src=/a/>", "<svg viewBox='0 0'/>", "<![CDATA[x]]>", "</>", "text"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=12))
def test_plain_markup_gives_the_tokenizers_tree(pieces):
    text = "".join(pieces)
    root = K._plain(text)
    assert root is None or shape(root) == shape(tolerant(text))


def test_pages_are_plain(spark):
    pages = [r.html for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()]
    roots = [K._plain(h) for h in pages]
    assert sum(r is not None for r in roots) > 0.9 * len(pages)
    assert all(r is None or shape(r) == shape(tolerant(h)) for r, h in zip(roots, pages, strict=True))


def test_markdown():
    md = lambda x: K.markdown(K.parse(x))
    assert md("<ul>loose<li>a</li><p>x</p><li>b<ul><li>c</ul></ul>") == "loose\n* a\nx\n* b\n  \n  * c"
    assert md("<table><caption>cap</caption><tr><td>a<table><tr><td>in</td></tr></table></td><td>b|c</td></tr></table>").count("in") == 1
    assert md("<table><caption>cap</caption><thead><tr><th>h</thead><tbody><tr><td>x<br>y</tbody></table>") == "cap\n\n| h |\n| --- |\n| x y |"
    assert md("<div>" * 5000 + "deep <b>x</b>") == "deep __x__"
    assert md("<ol><li>a<li>b</ol><h3> t <em>u</em></h3><blockquote>q</blockquote>") == "1. a\n2. b\n\n### t _u_ ###\n\n> q"


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="<>/ap\"'=b &;\n", max_size=60))
def test_kernel_never_fails(text):
    assert isinstance(K.parse(text).serialise(), str)
    K.markdown(K.parse(text))
    K.plain_text(K.parse(text))


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=40))
def test_decode_never_fails(raw):
    assert isinstance(T.decode_bytes(raw), str)


def test_exports(spark, tmp_path):
    df = R.projected(spark.createDataFrame([("u1", "eid0_art_en", 'a "q", b\nc'), ("u2", "pcd_art_en", None)], "url string, collection string, title string"))
    writers.corpus_csv(df, f"{tmp_path}/csv")
    back = readers.corpus_csv(spark, f"{tmp_path}/csv")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    renditions = spark.createDataFrame([("eid0_art_en", "u1", "<p>", "é")], "collection string, url string, html string, md string")
    writers.bundles(renditions, f"{tmp_path}/bundles")
    assert spark.read.json(f"{tmp_path}/bundles").count() == 1
    writers.bundle_objects(renditions, "md", f"{tmp_path}/md", ascii_only=False)
    writers.bundle_objects(renditions.withColumn("md", F.lit("é😀\n")), "md", f"{tmp_path}/txt", ascii_only=True)
    assert spark.read.text(f"{tmp_path}/md").first().value == '{"u1":"é"}' and spark.read.text(f"{tmp_path}/txt").first().value == '{"u1":"\\u00e9\\ud83d\\ude00\\n"}'
    assert readers.bundles(spark, f"{tmp_path}/txt").first().content == "é😀\n"
    writers.checkpoint(df, f"{tmp_path}/kept")
    with pytest.raises(Exception, match="exist"):
        writers.checkpoint(df, f"{tmp_path}/kept")
    typed = readers.corpus_csv(spark, f"{tmp_path}/csv", domains=True).orderBy("url").collect()
    assert [r.collection for r in typed] == ["eid0_art_en", "pcd_art_en"] and typed[0].series is None


def test_dictionaries(spark, tmp_path):
    (tmp_path / "d.json").write_text('{"a": "1"}')
    assert readers.dictionary(spark, f"{tmp_path}/d.json").first().asDict() == {"key": "a", "value": "1"}


def test_patterns_of_presence(spark):
    df = spark.createDataFrame([("a", "en"), ("a", "zht"), ("b", "fr"), ("c", None), ("a", "en")], "stem string, lang string")
    pattern = lambda **k: {r.stem: r.pattern for r in R.presence(df, "stem", "lang", ["en", "fr", "zht"], **k).collect()}
    assert pattern() == {"a": "en|__|zht", "b": "__|fr|___", "c": "__|__|___"} and pattern(blank="") == {"a": "en|zht", "b": "fr", "c": ""}


def test_domains_are_kept(spark, tmp_path):
    """In Parquet and CSV; sorting and checking need no list."""
    rows = [("low", "x"), ("high", "y"), ("odd", "z"), ("mid", None), (None, "a")]
    df = R.with_domains(spark.createDataFrame(rows, "size string, k string"), {"size": ["low", "mid", "high"], "none": ["x"]})
    df.write.parquet(f"{tmp_path}/p")
    back = spark.read.parquet(f"{tmp_path}/p")
    assert R.domains_of(back) == R.domains_of(df) == {"size": ["low", "mid", "high"]}
    assert [r["size"] for r in R.sort_by(back, "size", "k").collect()] == ["low", "mid", "high", None, "odd"]
    assert [tuple(r) for r in R.outside_domains(back).collect()] == [("size", "odd", 1)]
    assert [(r["size"], r.place) for r in R.places_by(back, ["size"], "k").orderBy("place").collect()] == [("low", 1), ("mid", 2), ("high", 3), (None, 4), ("odd", 5)]
    writers.corpus_csv(df, f"{tmp_path}/c")
    csv = readers.corpus_csv(spark, f"{tmp_path}/c", domains=True)
    assert R.domains_of(csv) == {"size": ["low", "mid", "high"]} and {(r["size"], r.k) for r in csv.collect()} == {("low", "x"), ("high", "y"), (None, "z"), ("mid", ""), (None, "a")}


def test_counts_of_any_names(spark):
    from folioforge.operators import journals as J

    df = spark.createDataFrame([("/a", '<title>t</title><meta name="x" content="1"><meta name="X" content="2"><meta name="x" content="3">'), ("/b", "<p>"), ("/c", '<meta property="q.r" content="v">')], "path string, html string")
    wide = J.head_counts_wide(df)
    assert wide.columns == ["path", "meta:name:X", "meta:name:x~2", "meta:property:q.r", "title"]
    assert sorted(map(tuple, wide.collect())) == [("/a", 1, 2, 0, 1), ("/b", 0, 0, 0, 0), ("/c", 0, 0, 1, 0)]
    assert J.head_counts_wide(df, ["title"]).columns == ["path", "title"] and J.head_counts_wide(df.where("path = '/b'")).columns == ["path"]
    with pytest.raises(ValueError, match="more than 3"):
        J.head_counts_wide(df, most=3)


def test_sheets(spark, tmp_path):
    df = spark.createDataFrame([("one", 1, 'a "<&>"\n é', None), ("one", 2, "", "x"), ('two "&"', 3, "\\", None)], "sheet string, k long, s string, e string")
    writers.sheets(df, "sheet", f"{tmp_path}/w")
    assert sorted(map(str, readers.sheets(spark, f"{tmp_path}/w", "sheet", "k long, s string, e string").select(*df.columns).collect())) == sorted(map(str, df.collect()))


def test_groupings_and_firsts(spark):
    rows = [("a", 1, 5), ("a", None, 7), (None, 1, 7), (None, None, None), ("a", 1, None)]
    df = spark.createDataFrame(rows, "x string, y int, n int")
    got = R.grouping_counts(df, [["x"], ["y", "x"], []])
    assert sorted(map(str, got.collect())) == sorted(f"Row(_set={s!r}, x={x!r}, y={y!r}, n={n})" for s, x, y, n in [("x", "a", None, 3), ("x", None, None, 2), ("y,x", "a", "1", 2), ("y,x", "a", None, 1), ("y,x", None, "1", 1), ("y,x", None, None, 1), ("", None, None, 5)])
    assert got._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1
    assert sorted(map(str, R.first_by(df, "x", [-F.col("n"), "y"]).collect())) == ["Row(x='a', y=None, n=7)", "Row(x=None, y=1, n=7)"]


def test_codecs_by_built_ins(spark):
    """Strict trials and decoding are those of the codecs themselves, for all pairs of bytes from 0x80 on and for odd bytes."""
    import random
    import re

    rng = random.Random(1)
    bits = [b"a", "é".encode(), "中文".encode(), "中文".encode("gb2312"), "中文".encode("big5"), b"\x80", b"\x81", b"\xff", b"\xed\xa0\x80", "😀".encode(), b"\xc0\x80", b"\xe2\x82", b" \n\x1c", b"\x93q\x94", b"\xf4\x90\x80\x80", b'<meta charset="utf-8">', b"<META charset=big5 >", b"\\x41\x7f"]
    raws = [b"".join(rng.choice(bits) for _ in range(rng.randint(0, 7))) for _ in range(1500)] + [bytes(rng.choices(range(256), k=20)) for _ in range(1500)] + [bytes([a, b]) for a in range(128, 256) for b in range(256)]

    def strict(raw, codec):
        try:
            return raw.decode(codec)
        except UnicodeDecodeError:
            return None

    names = ["utf_8", "latin_1", "cp1252", "ascii", "big5", "gb2312"]
    df = spark.createDataFrame([(k, r) for k, r in enumerate(raws)] + [(-1, None)], "k int, c binary")
    for r in df.select("k", T.try_codecs("c").alias("t"), T.decode_declared("c").alias("d"), T.fetched_text("c").alias("f"), *(T.decode_as("c", F.lit(n)).alias(n) for n in names)).collect():
        raw = raws[r.k] if r.k >= 0 else None
        assert r.d == T.decode_bytes(raw)
        if raw is None:
            assert r.f == "" and [r[n] for n in names] == [None] * 6
            continue
        assert list(r.t) == [strict(raw, c) is not None for c in T.TRIED]
        read = next((t for t in (strict(raw, "utf_8"), strict(raw, "cp1252")) if t is not None), "")
        assert r.f == " ".join(re.split(r"\s+", read)) and [r[n] for n in names] == [raw.decode(n, "backslashreplace") for n in names]
    plan = df.select(T.try_codecs("c"), T.fetched_text("c"))._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan


def test_charsets(spark):
    raw = b'<meta charset="utf-8">\n<META http-equiv=x content="text/html; charset=GB2312"> <meta charset="big5">\n\xff'
    df = spark.createDataFrame([(raw,), (b"plain",)], "c binary").select(T.declared_charsets(F.col("c")).alias("d"), T.try_codecs("c").alias("t"))
    rows = df.select("d", "t", T.mismatch(F.col("t"), F.col("d")).alias("m")).collect()
    assert [(r.d, r.m) for r in rows] == [(["utf-8", "big5"], True), ([], False)] and not rows[0].t.utf_8 and rows[1].t.ascii


def test_patches(spark):
    patch = [("a", "b"), ("b", "c")]
    df = spark.createDataFrame([("aab", patch), ("a", None), ("a", [])], "x string, p array<struct<old string, new string>>")
    assert [r.y for r in df.select(T.patched(F.col("x"), F.col("p")).alias("y")).collect()] == ["ccc", "a", "a"]


def test_lookups_fail_fast(spark):
    df, store = spark.range(3), spark.createDataFrame([(0, "x"), (1, None)], "id long, html string")
    assert [r.html for r in R.looked_up(df.where("id < 2"), store, "id", "html").orderBy("id").collect()] == ["x", None]
    with pytest.raises(Exception, match="no html of 2"):
        R.looked_up(df, store, "id", "html").collect()


def test_consistency_sees_differences(spark):
    corpus = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "url string, place long")
    stores = {"same": corpus, "other": spark.createDataFrame([("b", 1), ("a", 2), ("x", 3)], "url string, place long"), "none": corpus.limit(0)}
    got = {r.store: (r.n, r.missing, r.more, r.moved) for r in R.consistent(corpus, stores, "url", "place").collect()}
    assert got == {"same": (3, 0, 0, 0), "other": (3, 1, 1, 2), "none": (0, 3, 0, 0)}


def test_sorted_corpus(spark):
    cols = ", ".join(f"{c} string" for c in R.CORPUS_KEYS)
    rows = [("mmrr_toc_en", "eid", "article", None, "2", None, None, None), ("mmwr_toc_en", "eid", "home", "x", None, None, None, None), ("zz", "mmwr", "home", "a", "1", None, None, None), ("mmrr_toc_en", "eid", "article", None, "10", None, None, None), (None, "mmwr", "home", "a", "0", None, None, None)]
    got = [tuple(r)[:5] for r in R.sorted_corpus(spark.createDataFrame(rows, cols)).collect()]
    assert got == [rows[k][:5] for k in (1, 3, 0, 4, 2)]
    placed = R.corpus_places(spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"id long, {cols}"), "id").orderBy("place").collect()
    assert [(r.id, r.place) for r in placed] == [(1, 1), (3, 2), (0, 3), (4, 4), (2, 5)]


def test_references(spark):
    df = spark.createDataFrame([("&#169;",), ("&copy;",), ("&#10;",), ("&none;",), ("&NotEqualTilde;",), ("&#128512;",)], "x string").select(T.resolve_reference("x").alias("r"))
    assert [tuple(r.r) for r in df.collect()] == [("©", "U+00A9", "COPYRIGHT SIGN", "copy")] * 2 + [("\\n", "U+000A", "no name", None), (None,) * 4, ("≂̸", "U+2242 U+0338", "MINUS TILDE; COMBINING LONG SOLIDUS OVERLAY", None), ("😀", "U+1F600", "GRINNING FACE", None)]
