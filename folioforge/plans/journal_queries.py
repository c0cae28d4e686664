"""Queries over whole journal pages, written out from `orders` and `pages` by both sides, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioforge.functions import datelines as D
from folioforge.functions import text as T
from folioforge.functions import urls as U
from folioforge.operators import documents as P
from folioforge.operators import journals as J
from folioforge.operators import relational as R
from folioforge.plans.queries import LANGS, WEEKLY_SQL, load, query, svg_pages, weekly

# ---- datelines of pages

MMWR_PATH = "'/mmwr/preview/' || o_orderkey || '/mm' || (o_orderkey % 90 + 10) || '05' || case when o_orderkey % 7 = 0 then 'md' when o_orderkey % 11 = 0 then 'a1_ensp' else 'a1' end || '.htm'"


def mmwr_pages(spark, sf_dir):
    k = F.col("o_orderkey")
    name = F.when(k % 7 == 0, "05md.htm").when(k % 11 == 0, "05a1_ensp.htm").otherwise("05a1.htm")
    path = F.concat(F.lit("/mmwr/preview/"), k.cast("string"), F.lit("/mm"), (k % 90 + 10).cast("string"), name)
    title, date = F.substring_index("dateline", " / ", 1), F.expr("substring(dateline, length(substring_index(dateline, ' / ', 1)) + 4)")
    element = F.concat(F.lit('<div class="dateline"> '), F.col("dateline"), F.lit(" </div>"))
    script = F.concat(F.lit("<script>var reportTitle = \""), title, F.lit("\"; var reportDate = \""), date, F.lit("\";</script>"))
    html = F.concat(F.lit("<html><head><title>Report</title></head><body>"), F.when(k % 3 == 0, element).otherwise(script), F.lit("<p>text</body></html>"))
    return weekly(spark, sf_dir).select(path.alias("path"), html.alias("html"), k)


@query(f"""with {WEEKLY_SQL} select {MMWR_PATH} as path, case when o_orderkey % 9 = 0 then 'cx' when o_orderkey % 3 = 0 then 'div' else 'var' end as src, dateline,
    case when o_orderkey % 7 = 0 then 'mmnd' else 'mm' || case o_orderkey % 4 when 0 then 'wr' when 1 then 'rr' when 2 then 'ss' else 'su' end end as series,
    case when o_orderkey % 7 > 0 and o_orderkey % 11 = 0 then 'es' else 'en' end as lang, (vol + 1951)::varchar as dl_year_mo, vol || '(' || case when o_orderkey % 10 = 7 then 'SP' else lpad((o_orderkey % 53 + 1)::varchar, 2, '0') end || ')' as dl_vol_iss,
    strftime(o_orderdate, '%Y-%m-%d') as dl_date, lpad((o_orderkey % 900 + 1)::varchar, 4, '0') as dl_page from wk""")
def journal_mmwr_datelines(spark, sf_dir):
    """From elements, scripts and corrections (of every ninth page)."""
    pages = mmwr_pages(spark, sf_dir)
    fixes = pages.join(weekly(spark, sf_dir), "o_orderkey").where("o_orderkey % 9 = 0").select(F.col("path").alias("key"), F.col("dateline").alias("value"))
    return J.mmwr_datelines(pages, fixes)


@query(f"""with {WEEKLY_SQL} select o_orderkey, case o_orderkey % 4 when 0 then 'mm' when 1 then 'rr' when 2 then 'ss' else 'su' end as dl_ser, strftime(o_orderdate, '%Y-%m-%d') as dl_date, vol::varchar as dl_vol_num, '' as dl_vol_anno,
    lpad((o_orderkey % 53 + 1)::varchar, 2, '0') as dl_iss_num, '' as dl_iss_anno, (o_orderkey % 900 + 1)::int as dl_page, (o_orderkey % 7 + 1)::int as dl_npgs, (o_orderkey % 900 + 1) || '-' || (o_orderkey % 900 + 1 + o_orderkey % 7) as dl_repr, '' as dl_anno from wk""")
def dateline_detail(spark, sf_dir):
    """All orders, ranges of one page among them."""
    rows = weekly(spark, sf_dir, odd=False)
    return rows.select("o_orderkey", *(c.alias(n) for n, c in D.mmwr_detail(F.col("dateline")).items())).select("*", "pages.*").drop("pages")


#: Datelines with odd parts, by o_orderkey % 6.
ODD_DATELINES = "case o_orderkey % 6 when 0 then '_ / _ / _' when 1 then 'Weekly / Junio 1983 / 32a(S-1b);1' when 2 then 'Semanal / June 3, 1983 / 32(RR-5);iv,007-9' when 3 then 'Surveillance Summaries' when 4 then 'Other / May 1, 2001 / 50(3&4) 5-x,8-9' else 'QuickGuide / 1/2/1983 / 9(1);ND-1-4' end"


@query(f"""with d as (select unnest([0, 1, 2, 3, 4, 5]) as k, unnest(['_', 'mm', 'mm', 'ss', '', 'mm']) as dl_ser, unnest(['_', 'junio 1983', '1983-06-03', '', '2001-05-01', '1']) as dl_date,
        unnest(['', '32', '32', '', '50', '219839']) as dl_vol_num, unnest(['_', 'a', '', '_', '', '/ ']) as dl_vol_anno, unnest(['', '01', '05', '', '34', '01']) as dl_iss_num, unnest(['_', 'sb', 'rr', '_', '', '']) as dl_iss_anno,
        unnest([0, 1, 7, 0, 0, 1]) as dl_page, unnest(['', '1', 'iv,7-9', '', '', '1-4']) as dl_repr, unnest([0, 1, 4, 0, 0, 4]) as dl_npgs, unnest(['', '', '', '', '', 'nd']) as dl_anno)
    select o_orderkey, d.* exclude (k) from orders join d on k = o_orderkey % 6""")
def dateline_odd(spark, sf_dir):
    """Missing parts, other languages, notes on numbers, pages that can't be read, a bar too many."""
    rows = load(spark, sf_dir, "orders").select("o_orderkey", F.expr(ODD_DATELINES).alias("dateline"))
    return rows.select("o_orderkey", *(c.alias(n) for n, c in D.mmwr_detail(F.col("dateline")).items())).select("*", "pages.*").drop("pages")


@query(f"""with {WEEKLY_SQL} select {MMWR_PATH} as path, case when o_orderkey % 3 = 0 then '_ / _ / _' else dateline end as var_dl, case when o_orderkey % 3 = 0 then dateline else '_ / _ / _' end as div_dl, case when o_orderkey % 3 = 0 then 'div_dl' else 'var_dl' end as src, dateline as dl,
    case o_orderkey % 4 when 0 then 'mm' when 1 then 'rr' when 2 then 'ss' else 'su' end as dl_ser, (o_orderkey % 900 + 1)::int as dl_page, not (o_orderkey % 7 > 0 and o_orderkey % 11 = 0) as fn_stan, {', '.join(f"case when o_orderkey % {k + 2} = 0 then 'v{k} ' || o_orderkey else '' end as md_{m}" for k, m in enumerate(J.MMWR_METAS))} from wk""")
def journal_mmwr_details(spark, sf_dir):
    """Path, script, element, six metas and parsed dateline side by side."""
    k = F.col("o_orderkey")
    metas = F.concat(F.lit("<head>"), *(F.when(k % (i + 2) == 0, F.concat(F.lit(f'<meta name="{m}" content=" v{i} '), k.cast("string"), F.lit('">'))).otherwise("") for i, m in enumerate(J.MMWR_METAS)))
    pages = mmwr_pages(spark, sf_dir).withColumn("html", F.replace("html", F.lit("<head>"), metas))
    return J.mmwr_dateline_details(pages).select(*(f"md_{m}" for m in J.MMWR_METAS), "path", "var_dl", "div_dl", "src", "dl", "dl_ser", "dl_page", "fn_stan")


EID_TEXT = "'Volume ' || (o_orderkey % 28 + 1) || ', ' || case when o_orderkey % 3 = 0 then 'Supplement' else 'Number ' || (o_orderkey % 12 + 1) end || '—' || strftime(o_orderdate, '%B %Y')"


def eid_pages(spark, sf_dir):
    k = F.col("o_orderkey")
    vol, iss = (k % 28 + 1).cast("string"), (k % 12 + 1).cast("string")
    text = F.concat(F.lit("Volume "), vol, F.lit(", "), F.when(k % 3 == 0, "Supplement").otherwise(F.concat(F.lit("Number "), iss)), F.lit("—"), F.date_format("o_orderdate", "MMMM yyyy"))
    cell = F.concat(F.lit('<table><tr><th>AMA</th><td class="citationCell">x</td></tr><tr><th>EID</th><td class="citationCell">2017;23(12):'), (k % 5000 + 1).cast("string"), F.lit("</td></tr></table>"))
    html = F.concat(F.lit("<html><body><h5 class=header>"), text, F.lit("</h5>"), F.when(k % 4 == 0, "").otherwise(cell), F.lit("</body></html>"))
    path = F.concat(F.lit("/eid/article/"), vol, F.lit("/"), iss, F.lit("/"), F.lpad(k.cast("string"), 9, "0"), F.lit("_article.html"))
    return R.spread(load(spark, sf_dir, "orders")).select(path.alias("path"), html.alias("html"), k)


EID_PATH = "'/eid/article/' || (o_orderkey % 28 + 1) || '/' || (o_orderkey % 12 + 1) || '/' || lpad(o_orderkey::varchar, 9, '0') || '_article.html'"
EID_ISSUE = "lpad((o_orderkey % 28 + 1)::varchar, 2, '0') || '(' || case when o_orderkey % 3 = 0 then 'SU' else lpad((o_orderkey % 12 + 1)::varchar, 2, '0') end || ')'"


@query(f"""select {EID_PATH} as path, 'en' as lang, {EID_TEXT} as dateline, {EID_ISSUE} as dl_vol_iss, strftime(o_orderdate, '%Y-%m') as dl_year_mo,
    case when o_orderkey % 4 > 0 then lpad((o_orderkey % 5000 + 1)::varchar, 4, '0') when o_orderkey % 8 = 0 then '0007' end as dl_page from orders""")
def journal_eid_datelines(spark, sf_dir):
    pages = eid_pages(spark, sf_dir)
    return J.eid_datelines(pages, pages.where("o_orderkey % 8 = 0").select(F.regexp_replace("path", r"\.html$", "").alias("key"), F.lit("0007").alias("value")))


@query(f"select {EID_PATH} as path, case when o_orderkey % 2 = 0 then {EID_TEXT} end as dl_title, case when o_orderkey % 3 = 0 then {EID_TEXT} end as dl_toc_a, {EID_TEXT} as dl_header_h5, case when o_orderkey % 5 = 0 then {EID_TEXT} end as dl_p from orders")
def journal_eid_probe(spark, sf_dir):
    """Datelines in titles, links, headers and paragraphs."""
    k, text = F.col("o_orderkey"), F.regexp_extract("html", "<h5 class=header>(.*?)</h5>", 1)
    put = lambda m, a, b: F.when(k % m == 0, F.concat(F.lit(a), text, F.lit(b))).otherwise("")
    pages = eid_pages(spark, sf_dir).select("path", F.concat(put(2, "<title>In ", "</title>"), put(3, "<a href='/x'>", "</a>"), "html", put(5, "<p>", " and more</p>")).alias("html"))
    return J.eid_probe(pages)


@query("select case when o_orderkey % 4 = 0 then '' else 'AMA|EID' end as headers, count(*) as n, max(case when o_orderkey % 4 = 0 then '' else '2017;23(12):' || (o_orderkey % 5000 + 1) end) as eid from orders group by 1")
def citation_census(spark, sf_dir):
    return J.citation_cells(eid_pages(spark, sf_dir)).groupBy("headers").agg(F.count("*").alias("n"), F.max("eid").alias("eid"))


def pcd_pages(spark, sf_dir):
    k = F.col("o_orderkey")
    early = F.concat(F.lit("Volume "), (k % 8 + 1).cast("string"), F.lit(": No. "), (k % 4 + 1).cast("string"), F.lit(", "), F.date_format("o_orderdate", "MMMM yyyy"))
    late = F.concat(F.when(k % 3 == 0, "ORIGINAL RESEARCH — ").otherwise(""), F.lit("<em>Volume "), (k % 8 + 9).cast("string"), F.lit(" — "), F.date_format("o_orderdate", "MMMM d, yyyy"), F.lit("</em>"))
    html = F.concat(F.lit("<html><body><div>Volume 1 of all</div><p>"), F.when(k % 2 == 0, early).otherwise(F.replace(F.replace(late, F.lit("<em>"), F.lit("")), F.lit("</em>"), F.lit("  "))), F.lit("</p><p>more</p></body></html>"))
    path = F.concat(F.lit("/pcd/issues/"), F.date_format("o_orderdate", "yyyy"), F.lit("/"), F.lpad(k.cast("string"), 8, "0"), F.lit(".htm"))
    return R.spread(load(spark, sf_dir, "orders")).select(path.alias("path"), html.alias("html"), k)


@query("""select '/pcd/issues/' || strftime(o_orderdate, '%Y') || '/' || lpad(o_orderkey::varchar, 8, '0') || '.htm' as path,
    case when o_orderkey % 10 = 0 then 'Volume 9 — March 1, 2012' when o_orderkey % 2 = 0 then 'Volume ' || (o_orderkey % 8 + 1) || ': No. ' || (o_orderkey % 4 + 1) || ', ' || strftime(o_orderdate, '%B %Y') else 'Volume ' || (o_orderkey % 8 + 9) || ' — ' || strftime(o_orderdate, '%B %-d, %Y') end as dateline,
    case when o_orderkey % 10 = 0 then '09' when o_orderkey % 2 = 0 then lpad((o_orderkey % 8 + 1)::varchar, 2, '0') || '(' || (o_orderkey % 4 + 1) || ')' else lpad((o_orderkey % 8 + 9)::varchar, 2, '0') end as dl_vol_iss,
    case when o_orderkey % 10 <> 0 and o_orderkey % 2 = 0 then strftime(o_orderdate, '%Y-%m') else strftime(o_orderdate, '%Y') end as dl_year_mo,
    case when o_orderkey % 10 = 0 then '2012-03-01' when o_orderkey % 8 = 4 then '2008-01-15' when o_orderkey % 2 = 0 then 'xxxx-xx' else strftime(o_orderdate, '%Y-%m-%d') end as dl_date,
    case when o_orderkey % 6 = 0 then 'A' || o_orderkey else '' end as dl_art_num, 'en' as lang, case when o_orderkey % 10 = 0 then 'ESSAY' when o_orderkey % 2 = 1 and o_orderkey % 3 = 0 then 'ORIGINAL RESEARCH' else '' end as dl_cat from orders""")
def journal_pcd_datelines(spark, sf_dir):
    """Both forms, corrections of every tenth page, the date of one issue and article numbers from their lookups."""
    pages = pcd_pages(spark, sf_dir)
    fixes = pages.where("o_orderkey % 10 = 0").select(F.col("path").alias("key"), F.lit("ESSAY — Volume 9 — March 1, 2012").alias("value"))
    numbers = pages.where("o_orderkey % 6 = 0").select(F.col("path").alias("key"), F.concat(F.lit("A"), F.col("o_orderkey").cast("string")).alias("value"))
    return J.pcd_article_datelines(pages, fixes, spark.createDataFrame([("05(1)", "2008-01-15")], "key string, value string"), numbers)


@query("""select '/pcd/' || case when o_orderkey % 2 = 0 then 'es/' else 'issues/' end || '2011' || case when o_orderkey % 2 = 0 then '_sep_toc' else '/sep/toc' end || '.htm?' || o_orderkey as path,
    case when o_orderkey % 2 = 0 then 'es' else 'en' end as lang, case when o_orderkey % 5 > 0 then 'Volume ' || (o_orderkey % 8 + 1) || ': No. 5, ' || strftime(o_orderdate, '%B %Y') end as dateline, '08(5)' as dl_vol_iss, '2011-09' as dl_year_mo from orders""")
def journal_pcd_contents(spark, sf_dir):
    k = F.col("o_orderkey")
    path = F.concat(F.when(k % 2 == 0, "/pcd/es/2011_sep_toc.htm?").otherwise("/pcd/issues/2011/sep/toc.htm?"), k.cast("string"))
    html = F.concat(F.when(k % 5 > 0, "Volume 0 1999 ISSN: 1\n").otherwise(""), F.lit("Volume "), (k % 8 + 1).cast("string"), F.lit(": No.\n 5, "), F.date_format("o_orderdate", "MMMM yyyy"), F.lit(" more 2020"))
    return J.pcd_contents_datelines(load(spark, sf_dir, "orders").select(path.alias("path"), html.alias("html")), spark.createDataFrame([("2011-09", "08(5)")], "key string, value string"))


@query("""with en as (select '/pcd/issues/2010/10_' || lpad((o_orderkey % 10000)::varchar, 4, '0') as stem, max(o_orderstatus) as s from orders group by 1)
    select stem || '_es.htm' as path, 'es' as lang, case when stem like '%7' then '' else s end as dl_cat from en""")
def journal_pcd_translations(spark, sf_dir):
    stem = F.concat(F.lit("/pcd/issues/2010/10_"), F.lpad((F.col("o_orderkey") % 10000).cast("string"), 4, "0"))
    english = load(spark, sf_dir, "orders").groupBy(stem.alias("stem")).agg(F.max("o_orderstatus").alias("dl_cat")).select(F.concat("stem", F.lit(".htm")).alias("path"), F.lit("en").alias("lang"), "dl_cat")
    paths = english.select("path").unionByName(english.select(F.regexp_replace("path", r"\.htm$", "_es.htm").alias("path")))
    return J.pcd_translations(paths, english.where("path not like '%7.htm'"))


# ---- heads


def head_pages(spark, sf_dir):
    """Heads with all words of all documents."""
    k, lang = F.col("doc_id"), F.coalesce("lang", F.lit("none"))
    clean = F.transform(F.split(F.coalesce("text", F.lit("")), " "), lambda w: F.regexp_replace(w, "[^a-z]", ""))
    head = F.concat(
        F.lit("<html><head><title> Doc "), k.cast("string"), F.lit('</title><link rel="canonical" href="/d/'), k.cast("string"), F.lit('"><meta name="keywords" content="'), F.array_join(clean, ","), F.lit(',CDC"><meta name="Keywords" content="zeta; CDC">'),
        F.lit('<meta name="citation_author" content="A"><meta name="citation_author" content="B"><meta name="empty" content=""><meta property="og:x" content="'), lang, F.lit('"></head><body><title>no</title></body></html>'),
    )
    return R.spread(load(spark, sf_dir, "documents")).select(F.concat(F.lit("/d/"), k.cast("string")).alias("path"), head.alias("html"))


def attr_counts(pairs):
    each = pairs.groupBy("path", "attr_name").agg(F.count("*").alias("k"), F.max("attr_value").alias("v"))
    names = each.groupBy("attr_name").agg(F.count("*").alias("n"), F.max(F.when(F.col("attr_name") == "meta:property:og:x", F.col("v"))).alias("top"))
    several = each.where("k > 1").groupBy("attr_name").agg(F.count("*").alias("n")).select(F.concat("attr_name", F.lit(" (more than one)")).alias("attr_name"), "n", F.lit(None).cast("string").alias("top"))
    return names.unionByName(several)


ALL_HEAD_KW = "list_transform(string_split(coalesce(text, ''), ' '), lambda x: regexp_replace(x, '[^a-z]', '', 'g'))"


@query(f"""select '/d/' || doc_id as path, 'Doc ' || doc_id as title, '/d/' || doc_id as link_canon, 'A' as md_citation_author, 'A|B' as md_authors,
    array_to_string(list_sort(list_distinct(list_concat(list_filter({ALL_HEAD_KW}, lambda x: x <> ''), ['zeta']))), '|') as md_kwds, '' as md_desc from documents""")
def journal_head_metadata(spark, sf_dir):
    return J.head_metadata(head_pages(spark, sf_dir), "pcd").select("path", "title", "link_canon", "md_citation_author", "md_authors", "md_kwds", "md_desc")


@query("""with a as (select unnest(['title', 'link:rel:canonical', 'meta:name:keywords', 'meta:name:Keywords', 'meta:name:citation_author', 'meta:property:og:x']) as attr_name)
    select attr_name, count(*) as n, max(case when attr_name = 'meta:property:og:x' then coalesce(lang, 'none') end) as top from a, documents group by 1
    union all select 'meta:name:citation_author (more than one)', count(*), null from documents""")
def meta_eav(spark, sf_dir):
    """Names of pairs with the pages that have them, and pages with several authors. Two authors of a page count once."""
    return attr_counts(J.head_pairs(head_pages(spark, sf_dir)))


@query("""with n as (select doc_id, unnest(['title', 'link:rel:canonical', 'meta:name:citation_author', 'meta:name:of-' || (doc_id % 7), 'meta:name:Of-' || (doc_id % 7), 'meta:property:lang-' || coalesce(lang, 'none')]) as name,
        unnest([1, 1, 2, doc_id % 4, 1, 1 + doc_id % 2]) as n from documents),
    c as (select '/d/' || doc_id as path, case when name like 'meta:name:of-%' then name || '~2' else name end as name, n from n where n > 0)
    select * from (pivot c on name using coalesce(sum(n), 0)::bigint group by path)""")
def head_counts_wide(spark, sf_dir):
    """A count a page of every name that the heads have: the names are found in them, and depend on the rows."""
    k, lang = F.col("doc_id"), F.coalesce("lang", F.lit("none"))
    of = (k % 7).cast("string")
    meta = F.concat(F.repeat(F.concat(F.lit('<meta name="of-'), of, F.lit('" content="x">')), (k % 4).cast("int")), F.lit('<meta name="Of-'), of, F.lit('" content="y">'), F.repeat(F.concat(F.lit('<meta property="lang-'), lang, F.lit('" content="z">')), (1 + k % 2).cast("int")))
    pages = head_pages(spark, sf_dir).withColumn("k", F.regexp_extract("path", r"(\d+)$", 1).cast("long"))
    docs = load(spark, sf_dir, "documents").select(k.alias("k"), meta.alias("meta"))
    head = F.concat(F.lit('<html><head><title>t</title><link rel="canonical" href="/c"><meta name="citation_author" content="A"><meta name="citation_author" content="B"><meta name="empty" content="">'), "meta", F.lit("</head><body></body></html>"))
    return J.head_counts_wide(pages.join(docs, "k").select("path", head.alias("html")))


@query("""with t as (select unnest(['html', 'head', 'title', 'link', 'meta', 'meta']) as tag_name, unnest(['', '', '', 'href|rel', 'content|name', 'content|property']) as signature, unnest([0, 0, 0, 2, 2, 2]) as n_attr, unnest([1, 1, 1, 1, 5, 1]) as times)
    select tag_name, signature, n_attr, (times * (select count(*) from documents))::bigint as n from t""")
def tag_attr_signature(spark, sf_dir):
    """Tags of heads by their attributes' names."""
    rows = J.tag_rows(head_pages(spark, sf_dir))
    return rows.groupBy("tag_name", F.array_join(F.array_sort(F.map_keys("tag_attr")), "|").alias("signature"), "n_attr").agg(F.count("*").alias("n"))


# ---- the corpus table of one journal


@query(f"""select {EID_PATH} as mirror_path, '' as dl_date, {EID_ISSUE} as dl_vol_iss, 'article' as level, 'eid_art' as stratum,
    case when o_orderkey % 28 + 1 <= 12 then 'eid0' when o_orderkey % 28 + 1 <= 18 then 'eid1' when o_orderkey % 28 + 1 <= 24 then 'eid2' else 'eid3' end as series,
    case when o_orderkey % 28 + 1 <= 12 then 'eid0' when o_orderkey % 28 + 1 <= 18 then 'eid1' when o_orderkey % 28 + 1 <= 24 then 'eid2' else 'eid3' end || '_art_en' as collection, 'https://h.org' || {EID_PATH} as url from orders where o_orderkey % 5 > 0""")
def journal_corpus(spark, sf_dir):
    """Links (home pages go), datelines and head metadata to the corpus' columns."""
    pages = eid_pages(spark, sf_dir)
    links = pages.select(F.concat(F.lit("https://h.org"), "path").alias("url"), F.lit("https://h.org/").alias("base"), F.lit("t").alias("string"), F.when(F.col("o_orderkey") % 5 == 0, "home").otherwise("article").alias("level"), F.col("path").alias("mirror_path"))
    df = J.corpus_rows(links, J.eid_datelines(pages), J.head_metadata(pages, "eid"), "eid")
    return df.select("url", "mirror_path", "level", "stratum", "series", "collection", "dl_vol_iss", "dl_date")


# ---- curation, patches, counters


@query("""select doc_id, source from documents d where coalesce(lang, '') <> '' and not (coalesce(starts_with(source, 's'), false) and lang = 'es' and (select count(*) from documents e where e.source = d.source) > 1)""")
def notices_dropped(spark, sf_dir):
    """Links without text go, and those of a notice whose path occurs again."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "source", F.coalesce("lang", F.lit("")).alias("url"), F.col("source").alias("path"), F.when(F.coalesce("lang", F.lit("")) == "", "").otherwise(F.coalesce("source", F.lit("-"))).alias("string"))
    return R.drop_repeated_notices(docs, "s", "es").select("doc_id", "source")


@query("select page_id, replace(html, '&copy;', '(c)') as html from pages")
def byte_patches(spark, sf_dir):
    pages = load(spark, sf_dir, "pages").select("page_id", F.encode("html", "utf-8").alias("c"))
    return pages.select("page_id", T.patch_bytes("c", F.lit(b"&copy;"), F.lit(b"(c)")).cast("string").alias("html"))


@query("select c as codec, count(*) as n, sum(case when c = 'utf_8' then length(html) else strlen(html) end) as chars from pages, (select unnest(['utf_8', 'latin_1']) as c) group by 1")
def codec_renditions(spark, sf_dir):
    """Each page as every codec reads it (B11): as Latin-1, a character a byte."""
    return page_renditions(load(spark, sf_dir, "pages")).groupBy("codec").agg(F.count("*").alias("n"), F.sum(F.length("t")).alias("chars"))


def page_renditions(pages):
    """(page_id, codec, t)"""
    codecs = F.explode(F.array(F.lit("utf_8"), F.lit("latin_1"))).alias("codec")
    return pages.select("page_id", F.encode("html", "utf-8").alias("c"), codecs).select("page_id", "codec", T.decode_as("c", "codec").alias("t"))


@query("select page_id from pages where contains(html, '&middot;')")
def reference_members(spark, sf_dir):
    return load(spark, sf_dir, "pages").where(F.col("html").contains("&middot;")).select("page_id")


@query("select page_id, case when page_id % 3 = 0 and not contains(url, '_es.htm') then replace(replace(url, 'https', 'http') || '.htm', '.htm', '_es.htm') else replace(url, 'https', 'http') || '.htm' end as url from pages")
def spanish_paths(spark, sf_dir):
    base = F.when(F.col("page_id") % 3 == 0, "https://h.org/es/a.htm").otherwise("https://h.org/a.htm")
    url = F.concat(F.replace("url", F.lit("https"), F.lit("http")), F.lit(".htm"))
    return load(spark, sf_dir, "pages").select("page_id", U.spanish(url, base, url).alias("url"))


@query("select page_id, url from pages where regexp_matches(url, '/[a-c]') or regexp_matches(url, '\\.net')")
def url_subset(spark, sf_dir):
    return R.subset(load(spark, sf_dir, "pages").select("page_id", "url"), "url", ["/[a-c]", r"\.net"])


@query("select coalesce(a.source, b.source) as source, greatest(coalesce(a.n, 0), coalesce(b.n, 0)) as n from (select coalesce(source, '?') as source, count(*) as n from documents where lang = 'en' group by 1) a full join (select coalesce(source, '?') as source, count(*) as n from documents where lang = 'fr' group by 1) b on a.source = b.source")
def counter_union(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").withColumn("source", F.coalesce("source", F.lit("?")))
    a, b = (docs.where(F.col("lang") == x).groupBy("source").agg(F.count("*").alias("n")) for x in ("en", "fr"))
    return R.greatest_counts(a, b, "source", "n")


@query("select doc_id, case when l.doc_id is not null then 'label' else 'document' end as origin from documents d left join labels l using (doc_id)")
def store_merge(spark, sf_dir):
    a = load(spark, sf_dir, "documents").select("doc_id", F.lit("document").alias("origin"))
    b = load(spark, sf_dir, "labels").join(a, "doc_id", "left_semi").select("doc_id", F.lit("label").alias("origin"))
    return R.merged(a, b, "doc_id")


@query("select d.doc_id, d.n_chars as n_chars_x, (2 * d.n_chars)::bigint as n_chars_y from documents d join labels l using (doc_id)")
def corrected_compared(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").select("doc_id", "n_chars")
    fixed = docs.join(load(spark, sf_dir, "labels"), "doc_id", "left_semi").withColumn("n_chars", F.col("n_chars") * 2)
    return R.compared(docs, fixed, "doc_id")


@query(f"select k as languages, count(*) as stems, {', '.join(f'sum({x})::bigint as {x}' for x in LANGS)} from (select *, {' + '.join(LANGS)} as k from (select source, doc_id % 7 as g, {', '.join(f"max(coalesce(lang = '{x}', false)::int)::bigint as {x}" for x in LANGS)} from documents group by all)) group by 1")
def presence_sums(spark, sf_dir):
    """Sums over the rows and the columns of a matrix of languages by stem (K6)."""
    docs = load(spark, sf_dir, "documents").withColumn("stem", F.concat_ws("/", F.coalesce("source", F.lit("?")), F.col("doc_id") % 7))
    wide = R.presence(docs, "stem", "lang", LANGS)
    return wide.withColumns({v: F.coalesce(F.col(v).cast("long"), F.lit(0)) for v in LANGS}).withColumn("languages", F.expr(" + ".join(LANGS))).groupBy("languages").agg(F.count("*").alias("stems"), *(F.sum(v).alias(v) for v in LANGS))


@query("select doc_id, (doc_id % 4)::int as n_svg, length(regexp_replace(coalesce(text, ''), '[^a-z ]', '', 'g'))::int + 33 + (doc_id % 4)::int * 8 as len5 from documents")
def svg_counts_joined(spark, sf_dir):
    """Counts of drawings by pattern joined with parsed lengths by document."""
    pages = svg_pages(spark, sf_dir)
    counts = pages.select("doc_id", T.count_tag(F.col("html"), "svg").alias("n_svg"))
    return counts.join(pages.select("doc_id", P.svg_lengths("html")["len5"].alias("len5")), "doc_id")


@query("with w as (select doc_id, unnest(range(0, 2))::int as seq, coalesce(source, '') as source, coalesce(lang, '') as lang from documents) select doc_id, seq, case when seq = 0 then 'p' else 'b' end as tag, 'No. ' || case when seq = 0 then source else lang end as string, (case when seq = 0 then 28 + length(source) + length(lang) else 11 + length(lang) end)::int as size from w")
def text_node_search(spark, sf_dir):
    """Text nodes that match a pattern, with their place, element and its length."""
    html = F.concat(F.lit("<p>No. "), F.coalesce("source", F.lit("")), F.lit("<b>No. "), F.coalesce("lang", F.lit("")), F.lit("</b> other</p>"))
    docs = R.spread(load(spark, sf_dir, "documents")).select("doc_id", P.text_nodes(html, r"^No\.").alias("notes"))
    return docs.select("doc_id", F.explode("notes").alias("n")).select("doc_id", "n.seq", "n.tag", "n.string", "n.size")


@query("""select o_orderkey, case when o_orderkey % 3 < 2 then (2004 + o_orderkey % 20)::varchar end as year, case when o_orderkey % 3 = 0 then '10' end as month, case when o_orderkey % 3 < 2 then lpad((1 + o_orderkey % 20)::varchar, 2, '0') end as volume,
    case o_orderkey % 3 when 0 then '04_0079_es' when 1 then '11_0132' end as article, o_orderkey % 3 > 0 as english, o_orderkey % 3 = 0 as translated from orders""")
def pcd_paths(spark, sf_dir):
    """Parts of articles' paths, and whether they are English or translated."""
    path = F.expr("case o_orderkey % 3 when 0 then '/pcd/issues/' || (2004 + o_orderkey % 20) || '/oct/04_0079_es.htm' when 1 then '/pcd/issues/' || (2004 + o_orderkey % 20) || '/11_0132.htm' else '/other/cover.htm' end")
    return load(spark, sf_dir, "orders").select("o_orderkey", *(c.alias(n) for n, c in D.pcd_path(path).items()), D.pcd_english(path).alias("english"), D.pcd_translated(path).alias("translated"))


@query(r"""with t as (select doc_id, case when doc_id % 4 < 2 then '  <PRE >' else '' end || coalesce(replace(text, ' t', '   <t'), '') || '&#8203;   &amp;' || chr(10) || chr(10) || chr(10) || chr(10) || '  z' as x from documents),
    u as (select doc_id, replace(replace(x, '&#8203;', ''), '&amp;', '&') as x from t)
    select doc_id, regexp_replace(case when doc_id % 4 = 1 then regexp_replace(regexp_replace(x, '(?m)^ +<', '<', 'g'), '(?m) +$', '', 'g') else regexp_replace(regexp_replace(x, ' +', ' ', 'g'), '(?m)^ | $', '', 'g') end, '\n{3,}', chr(10) || chr(10), 'g') as html from u""")
def cleaned_by_source(spark, sf_dir):
    """Entities and white space by each source's rule: those of odd numbers spare <pre>."""
    html = F.concat(F.when(F.col("doc_id") % 4 < 2, "  <PRE >").otherwise(""), F.coalesce(F.replace("text", F.lit(" t"), F.lit("   <t")), F.lit("")), F.lit("&#8203;   &amp;\n\n\n\n  z"))
    return R.spread(load(spark, sf_dir, "documents")).select("doc_id", T.cleaned(html, F.col("doc_id") % 2 == 1).alias("html"))
