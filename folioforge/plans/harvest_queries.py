"""Link harvests of the three journals over pages written out from `customer`, and table functions, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioforge.functions import tables
from folioforge.operators import crawl
from folioforge.operators import documents as P
from folioforge.operators.relational import spread
from folioforge.plans.io_queries import folder
from folioforge.plans.queries import ANCHORS, load, query
from folioforge.sources import mirror

#: journal, level, url and HTML of a page that level's links are looked for in, and the link rows that it has: seq, href, url, path, filename, mirror_path, string.
#: {k} is the customer's key. Among the anchors are ones with attributes, in upper case, with markup inside, and ones that don't count.
CASES = [
    ("mmwr", "home", "https://h.org/mmwr/{k}/start.html", '<P><A HREF="/mmwr/about.html?x={k}"><b>About</b> MMWR {k}</A> <a href="about.html">again</a>', [(0, "/mmwr/about.html?x={k}", "https://h.org/mmwr/about.html", "/mmwr/about.html", "about.html", "/mmwr/about.html", "About|MMWR {k}")]),
    ("mmwr", "series", "https://h.org/mmwr/{k}/about.html", '<a href="/no">Volumes</a><a class="k" id=a href=\'wk_pvol{k}.html\'>Past Volumes ({k})</a><a href="/no"><b>Past</b> Volumes</a>', [(1, "wk_pvol{k}.html", "https://h.org/mmwr/{k}/wk_pvol{k}.html", "/mmwr/{k}/wk_pvol{k}.html", "wk_pvol{k}.html", "/mmwr/{k}/wk_pvol{k}.html", "Past Volumes ({k})")]),
    ("mmwr", "volume", "https://h.org/mmwr/{k}/list.html", '<ul><li><A title=v HREF="/mmwr/{k}/ind2004_su.html">Volume <i>{k}</i></A><li><a href="/mmwr/other.html">Volume</a></ul>', [(0, "/mmwr/{k}/ind2004_su.html", "https://h.org/mmwr/{k}/ind2004_su.html", "/mmwr/{k}/ind2004_su.html", "ind2004_su.html", "/mmwr/{k}/ind2004_su.html", "Volume|{k}")]),
    ("mmwr", "article", "https://h.org/mmwr/{k}/ind2004.html", '<td><a href="/mmwr/preview/mmwrhtml/{k}.htm"><i>Notes</i>: &amp; {k}</a><a href="../volumes/72/wr/mm{k}a1.htm#top"> two </a><a>none</a>', [(0, "/mmwr/preview/mmwrhtml/{k}.htm", "https://h.org/mmwr/preview/mmwrhtml/{k}.htm", "/mmwr/preview/mmwrhtml/{k}.htm", "{k}.htm", "/mmwr/preview/mmwrhtml/{k}.htm", "Notes|: & {k}"), (1, "../volumes/72/wr/mm{k}a1.htm#top", "https://h.org/mmwr/volumes/72/wr/mm{k}a1.htm", "/mmwr/volumes/72/wr/mm{k}a1.htm", "mm{k}a1.htm", "/mmwr/volumes/72/wr/mm{k}a1.htm", "two")]),
    ("eid", "home", "https://e.org/{k}", '<a href="/x">EID Journal</a><a href="/eid/{k}/"><!-- c -->EID Journal</a><a href="/eid/2">EID Journal</a>', [(1, "/eid/{k}/", "https://e.org/eid/{k}/", "/eid/{k}/", "", "/eid/{k}/index.html", "EID Journal")]),
    ("eid", "series", "https://e.org/eid/{k}/", '<a aria-expanded="true" href="/eid/{k}/past-issues/volume-30">Past Issues</a>', [(0, "/eid/{k}/past-issues/volume-30", "https://e.org/eid/{k}/past-issues/volume-30", "/eid/{k}/past-issues/volume-30", "volume-30", "/eid/{k}/past-issues/volume-30.html", "Past Issues")]),
    ("eid", "volume", "https://e.org/eid/{k}/past-issues/volume-1", '<a href="/eid/{k}/volume-2">Volume 2—1996</a><a href="/eid/{k}/volume-3"><b>Volume 3—1997</b> x</a><a href="/other">Volume 4—1998</a>', [(0, "/eid/{k}/volume-2", "https://e.org/eid/{k}/volume-2", "/eid/{k}/volume-2", "volume-2", "/eid/{k}/volume-2.html", "Volume 2—1996")]),
    ("eid", "volume", "https://e.org/eid/{k}/past-issues/volume-2", '<a href="/eid/{k}/volume-3">Volume 3—1997</a><a href="/eid/{k}/volume-1">Volume 1—1995</a>', [(1, "/eid/{k}/volume-1", "https://e.org/eid/{k}/volume-1", "/eid/{k}/volume-1", "volume-1", "/eid/{k}/volume-1.html", "Volume 1—1995")]),
    ("eid", "issue", "https://e.org/eid/{k}/volume-2", '<a href="/eid/articles/issue/{k}/1/table-of-contents">Table of Contents</a>', [(0, "/eid/articles/issue/{k}/1/table-of-contents", "https://e.org/eid/articles/issue/{k}/1/table-of-contents", "/eid/articles/issue/{k}/1/table-of-contents", "table-of-contents", "/eid/articles/issue/{k}/1/table-of-contents.html", "Table of Contents")]),
    ("eid", "article", "https://e.org/eid/articles/issue/{k}/1/toc", '<a href="/eid/article/{k}/a_article"><em>Bartonella</em> {k}</a><a href="/eid/article/{k}/b_article?x">no</a><a href="/eid/article/{k}/c_article"></a>', [(0, "/eid/article/{k}/a_article", "https://e.org/eid/article/{k}/a_article", "/eid/article/{k}/a_article", "a_article", "/eid/article/{k}/a_article.html", "Bartonella|{k}"), (2, "/eid/article/{k}/c_article", "https://e.org/eid/article/{k}/c_article", "/eid/article/{k}/c_article", "c_article", "/eid/article/{k}/c_article.html", "")]),
    ("pcd", "home", "https://p.org/pcd/{k}", '<a href="/pcd/index.htm">Preventing Chronic Disease</a><a href="/pcd/index.htm?{k}">Preventing Chronic Disease</a>', [(0, "/pcd/index.htm", "https://p.org/pcd/index.htm", "/pcd/index.htm", "index.htm", "/pcd/index.htm", "Preventing Chronic Disease")]),
    ("pcd", "series", "https://p.org/pcd/{k}/index.htm", '<a href="/pcd/{k}/archive.htm">Issue Archive</a><a href="/pcd/archive2.htm">More</a>', [(0, "/pcd/{k}/archive.htm", "https://p.org/pcd/{k}/archive.htm", "/pcd/{k}/archive.htm", "archive.htm", "/pcd/{k}/archive.htm", "Issue Archive")]),
    ("pcd", "series", "https://p.org/{k}/pcd/es/archive_es.htm", '<a href="/archive.htm">no</a><a href="/{k}/pcd/es/archive_es.htm">Archivo de números</a>', [(1, "/{k}/pcd/es/archive_es.htm", "https://p.org/{k}/pcd/es/archive_es.htm", "/{k}/pcd/es/archive_es.htm", "archive_es.htm", "/{k}/pcd/es/archive_es.htm", "Archivo de números")]),
    ("pcd", "volume", "https://p.org/pcd/{k}/archive.htm", '<a href="/pcd/{k}/2011_TOC.htm">2011</a><a href="2011/sep/toc.htm">sep</a><a href="toc.htm">no</a>', [(0, "/pcd/{k}/2011_TOC.htm", "https://p.org/pcd/{k}/2011_TOC.htm", "/pcd/{k}/2011_TOC.htm", "2011_TOC.htm", "/pcd/{k}/2011_TOC.htm", "2011"), (1, "2011/sep/toc.htm", "https://p.org/pcd/{k}/2011/sep/toc.htm", "/pcd/{k}/2011/sep/toc.htm", "toc.htm", "/pcd/{k}/2011/sep/toc.htm", "sep")]),
    ("pcd", "article", "https://p.org/pcd/{k}/2011_TOC.htm", '<A HREF="10_0001_es.htm">La|<b>Border</b></A><a href="/pcd/{k}/cover.htm">Cover</a><a href="/pcd/memoriam.htm">no</a>', [(0, "10_0001_es.htm", "https://p.org/pcd/{k}/10_0001_es.htm", "/pcd/{k}/10_0001_es.htm", "10_0001_es.htm", "/pcd/{k}/10_0001_es.htm", "La||Border"), (1, "/pcd/{k}/cover.htm", "https://p.org/pcd/{k}/cover.htm", "/pcd/{k}/cover.htm", "cover.htm", "/pcd/{k}/cover.htm", "Cover")]),
]
VOLUMES_BASE = "https://e.org/eid/past-issues/volume-30"


def pages_of(customers, journal: str, level: str):
    """(url, html) of the level's pages, for each customer."""
    filled = lambda t: F.replace(F.lit(t), F.lit("{k}"), F.col("c_custkey").cast("string"))
    rows = [F.struct(filled(url).alias("url"), filled(f"<html><body>{html}</body></html>").alias("html")) for j, l, url, html, _ in CASES if (j, l) == (journal, level)]
    return customers.select(F.explode(F.array(*rows)).alias("p")).select("p.*")


def expected(journal: str) -> str:
    """The link rows as SQL: values with the customer's key put in."""
    quote = lambda x: "'" + str(x).replace("'", "''") + "'"
    names = ["level", "base", "seq", "href", "url", "path", "filename", "mirror_path", "string"]
    rows = [(level, VOLUMES_BASE if (j, level) == ("eid", "volume") else base, *row) for j, level, base, _, found in CASES if j == journal for row in found]
    values = ", ".join("(" + ", ".join(map(quote, r)) + ")" for r in rows)
    put = ", ".join(f"seq::int as seq" if n == "seq" else f"replace({n}, '{{k}}', c_custkey::varchar) as {n}" for n in names)
    return f"select {put} from customer, (values {values}) v({', '.join(names)})"


def harvested(spark, sf_dir, journal: str):
    customers = spread(load(spark, sf_dir, "customer").select("c_custkey"))
    levels = dict.fromkeys(level for j, level, *_ in CASES if j == journal)
    return P.harvest(journal, {level: pages_of(customers, journal, level) for level in levels}, VOLUMES_BASE)


@query(expected("mmwr"))
def harvest_mmwr(spark, sf_dir):
    return harvested(spark, sf_dir, "mmwr")


@query(expected("eid"))
def harvest_eid(spark, sf_dir):
    """Volumes are the union of two pages' links."""
    return harvested(spark, sf_dir, "eid")


@query(expected("pcd"))
def harvest_pcd(spark, sf_dir):
    """The series are the archive's link and that of the Spanish archive."""
    return harvested(spark, sf_dir, "pcd")


@query(f"with {ANCHORS}, named as (select page_id, 'volume' as level from anchors where regexp_matches(string, '^[A-Z]') union all select page_id, 'issue' from anchors where length(string) > 6 union all select page_id, 'article' from anchors where regexp_matches(href, 't')) select level, count(*) as n, count(distinct page_id) as pages from named group by 1")
def anchors_level_union(spark, sf_dir):
    pages = load(spark, sf_dir, "pages").withColumn("url", F.concat(F.lit("https://h.org/"), F.col("page_id").cast("string")))
    from folioforge.operators.relational import union

    found = union(P.links(pages, "volume", text="^[A-Z]"), P.links(pages, "issue", text="^.{7,}$"), P.links(pages, "article", href="t"))
    return found.groupBy("level").agg(F.count("*").alias("n"), F.countDistinct("base").alias("pages"))


ANCHOR_TEXT = "trim(replace(replace(replace(replace(string, '&copy;', '©'), '&middot;', '·'), '&quot;', '\"'), '&amp;', '&'))"


@query(f"with {ANCHORS} select a.page_id, seq, href, 'https://' || regexp_extract(p.url, '^[a-z]+://([^/?#]*)', 1) || href as url, {ANCHOR_TEXT} as string from anchors a join pages p on p.page_id = a.page_id")
def anchors_lateral(spark, sf_dir):
    """Anchors by a table function in SQL, a page at a time, resolved against the page's url (2.M)."""
    tables.register(spark)
    return spark.sql("select p.page_id, a.* from {pages} p, lateral html_anchors(p.html, p.url) a", pages=load(spark, sf_dir, "pages"))


@query(f"with {ANCHORS} select page_id::varchar as page, seq, href, {ANCHOR_TEXT} as string from anchors")
def anchors_of_table(spark, sf_dir):
    """The same by a table function over the whole table, partitioned by the page, in Arrow batches (2.M)."""
    tables.register(spark)
    return spark.sql("select page, seq, href, string from anchors_of(table(select page_id as page, html from {pages}) partition by page)", pages=load(spark, sf_dir, "pages"))


HEAD = "regexp_extract(html, '(?is)^(.*?)</head>', 1)"


@query(f"with t as (select page_id, unnest(regexp_extract_all({HEAD}, '<([a-z]+)[ >]', 1)) as tag_name, generate_subscripts(regexp_extract_all({HEAD}, '<([a-z]+)[ >]', 1), 1) - 1 as seq from pages) select page_id, tag_name, seq::int as seq from t")
def tags_lateral(spark, sf_dir):
    """Tags of heads by a table function in SQL (2.M, I3)."""
    tables.register(spark)
    return spark.sql("select p.page_id, t.tag_name, t.seq from {pages} p, lateral html_tags(p.html) t", pages=load(spark, sf_dir, "pages"))


@query("select page_id::varchar as page, k::int as seq, case k when 0 then 'first' else 'second' end as name, case k when 0 then 'v' || page_id else url end as content from pages, range(0, 2) r(k)")
def metas_of_table(spark, sf_dir):
    """Metas of heads, which are put into the pages, by a table function over the table (2.M)."""
    tables.register(spark)
    pages = load(spark, sf_dir, "pages")
    metas = F.concat(F.lit('<head><meta name="first" content="v'), F.col("page_id").cast("string"), F.lit('"><meta name="second" content="'), F.replace("url", F.lit("&"), F.lit("&amp;")), F.lit('"><meta name="none" content="">'))
    return spark.sql("select page, seq, name, content from metas_of(table(select page_id as page, html from {pages}))", pages=pages.withColumn("html", F.replace("html", F.lit("<head>"), metas)))


#: Pages of `pages` as articles of a site: issue page_id // 20 (from 0), of volume issue % 29 + 1, each article's issue by its
#: page; the next issue's page leads to the first article of an issue too.
SITE_LINKS = """
article as (select page_id as p, page_id // 20 as i, page_id // 20 % 29 + 1 as v, html from pages),
issue as (select distinct i, v from article),
volume as (select distinct v from issue),
link as (
    select 'https://e.org/eid/' as base, '/eid/' as href, '/eid/' as path, 'EID Journal' as string, 'home' as level, 0 as seq
    union all select 'https://e.org/eid/', '/eid/past-issues/volume-30', '/eid/past-issues/volume-30', 'Past Issues', 'series', 1
    union all select 'https://e.org/eid/past-issues/volume-30', '/eid/past-issues/volume-' || v, '/eid/past-issues/volume-' || v, 'Volume ' || v || '—' || (1994 + v), 'volume', row_number() over (partition by v = 1 order by v) - 1 from volume
    union all select 'https://e.org/eid/past-issues/volume-' || v, '/eid/articles/issue/' || v || '/' || i || '/toc', '/eid/articles/issue/' || v || '/' || i || '/toc', 'Table of Contents', 'issue', row_number() over (partition by v order by i) - 1 + (select count(*) from volume o where case issue.v when 1 then o.v <> 1 when 2 then o.v = 1 else false end) from issue
    union all select 'https://e.org/eid/articles/issue/' || v || '/' || i || '/toc', '/eid/article/' || v || '/' || p || '_article', '/eid/article/' || v || '/' || p || '_article', 'Article ' || p, 'article', p % 20 from article
    union all select 'https://e.org/eid/articles/issue/' || n.v || '/' || n.i || '/toc', '/eid/article/' || a.v || '/' || p || '_article', '/eid/article/' || a.v || '/' || p || '_article', 'Again ' || p, 'article', (select count(*) from article o where o.i = n.i) from article a join issue n on n.i = a.i + 1 where p % 20 = 0
),
reach as (
    select base, href, path, string, level, seq from link where level = 'home'
    union
    select l.base, l.href, l.path, l.string, l.level, l.seq from reach r join link l on l.base = case when l.level = 'volume' then case when r.level = 'series' then 'https://e.org' || r.path end else 'https://e.org' || r.path end
)"""


@query(f"with recursive {SITE_LINKS} select level, base, seq::int as seq, href, path, string, coalesce(strlen(html), -1)::bigint as article_length from reach left join article on level = 'article' and path = '/eid/article/' || v || '/' || p || '_article'")
def crawl_articles(spark, sf_dir):
    """From a home page to all articles of a site whose articles are `pages` (3.1, D1-D8, A5): the site is a tree of files,
    written and read by the data source. The crawl stops behind its third level, and another one goes on in its folder."""
    at = folder(spark)
    mirror.register(spark)
    site_of(load(spark, sf_dir, "pages")).write.format("pages").mode("append").save(f"{at}/site")
    root = f"{at}/site/{mirror.versions(f'{at}/site')[-1]}"
    new = lambda: crawl.Crawl(spark, "eid", "https://e.org/eid/", f"{at}/crawl", lanes=8, root=root)
    new().run(levels=3)
    found = new().run()
    return found.select("level", "base", "seq", "href", "path", "string", F.when(F.col("level") == "article", F.col("length")).otherwise(-1).alias("article_length"))


def site_of(pages):
    """(mirror_path, content) of the site's files: home, volumes, issues, and the pages themselves."""
    p, text = F.col("page_id"), lambda *parts: F.concat(*(F.lit(x) if isinstance(x, str) else x.cast("string") for x in parts))
    article = pages.select(p, F.expr("page_id div 20").alias("i"), F.expr("page_id div 20 % 29 + 1").alias("v"), "html")
    listed = lambda rows, by, order: rows.groupBy(*by).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, "a"))), lambda x: x["a"]), "").alias("body"))
    own = article.select("i", "v", (p % 20).alias("k"), text('<a href="/eid/article/', F.col("v"), "/", p, '_article">Article ', p, "</a>").alias("a"))
    issue = article.select("i", "v").distinct()
    first = article.where("page_id % 20 = 0").select((F.col("i") + 1).alias("i"), text('<a href="/eid/article/', F.col("v"), "/", p, '_article">Again ', p, "</a>").alias("a"))
    again = first.join(issue, "i").select("i", "v", F.lit(20).alias("k"), "a")
    issues = listed(own.unionByName(again), ["i", "v"], "k").select(text("/eid/articles/issue/", F.col("v"), "/", F.col("i"), "/toc.html").alias("mirror_path"), "body")
    contents = issue.select("v", "i", text('<a href="/eid/articles/issue/', F.col("v"), "/", F.col("i"), '/toc">Table of Contents</a>').alias("a"))
    volumes = issue.select("v").distinct()
    one = volumes.select("v", text('<a href="/eid/past-issues/volume-', F.col("v"), '">Volume ', F.col("v"), "—", F.col("v") + 1994, "</a>").alias("a"))
    # volumes but the first are listed by the first one's page, the first by the second's; all pages list their own issues behind those
    lists = listed(one.withColumn("v2", F.when(F.col("v") == 1, 2).otherwise(1)), ["v2"], "v").withColumnsRenamed({"v2": "v", "body": "head"})
    every = lists.join(listed(contents, ["v"], "i"), "v", "full").select(text("/eid/past-issues/volume-", F.col("v"), ".html").alias("mirror_path"), F.concat(F.coalesce("head", F.lit("")), F.coalesce("body", F.lit(""))).alias("body"))
    fixed = pages.sparkSession.createDataFrame([("/eid/index.html", '<a href="/eid/">EID Journal</a><a href="/eid/past-issues/volume-30">Past Issues</a>'), ("/eid/past-issues/volume-30.html", "")], "mirror_path string, body string")
    rows = issues.unionByName(every).unionByName(fixed).select("mirror_path", F.concat(F.lit("<html><body>"), "body", F.lit("</body></html>")).cast("binary").alias("content"))
    return rows.unionByName(article.select(text("/eid/article/", F.col("v"), "/", p, "_article.html").alias("mirror_path"), F.col("html").cast("binary").alias("content")))
