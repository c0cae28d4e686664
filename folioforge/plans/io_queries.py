"""Sources and sinks: tables are written by a sink, read back by its source, and held against the table itself."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioforge import registry
from folioforge.operators import documents as P
from folioforge.operators import relational as R
from folioforge.operators import sequence
from folioforge.plans.queries import LABELLED, labelled, load, query
from folioforge.sources import exports, mirror, readers, stages, writers
from folioforge.sources.folders import new_folder


def folder(spark) -> str:
    return f"{new_folder(spark, 'io')}/files"


def put(spark, path: str, content: str) -> None:
    """A small file, by the driver."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, False)
    try:
        out.write(bytearray(content.encode()))
    finally:
        out.close()


@query("select r_regionkey, '/m/' || r_name || '.html' as mirror_path, case r_regionkey % 3 when 0 then 'article' when 1 then 'volume' else 'home' end as level, length('<p>é ' || r_name || '</p>')::bigint + 1 as length, '<p>é ' || r_name || '</p>' as html from region where r_regionkey <> 4")
def source_mirror_files(spark, sf_dir):
    """Files of a mirror, as bytes and as text, joined with the links that name them (A3-A5). The fifth region's file has no link."""
    at = folder(spark)
    regions = load(spark, sf_dir, "region")
    for r in regions.collect():  # five rows
        put(spark, f"{at}/m/{r.r_name}.html", f"<p>é {r.r_name}</p>")
    path = F.concat(F.lit("/m/"), "r_name", F.lit(".html"))
    links = regions.where("r_regionkey <> 4").select("r_regionkey", path.alias("mirror_path"), F.element_at(F.array(*map(F.lit, ("article", "volume", "home"))), (F.col("r_regionkey") % 3 + 1).cast("int")).alias("level"))
    got = readers.mirrored(spark, at, links, "/files")
    text = readers.text_pages(spark, at).select(F.regexp_replace("path", "^.*?(/m/[^/]*)$", "$1").alias("mirror_path"), "html")
    return got.join(text, "mirror_path").join(links.select("mirror_path", "r_regionkey"), "mirror_path").select("r_regionkey", "mirror_path", "level", "length", "html")


_asked: dict[str, int] = {}


def answer(url: str, timeout: float) -> bytes:
    """A stand-in for the web: some pages never answer, some only when they are asked again, some in other bytes than UTF-8."""
    k = int(url.rsplit("/", 1)[1])
    _asked[url] = _asked.get(url, 0) + 1
    if k % 7 == 0 or (k % 5 == 2 and _asked[url] % 2):
        raise TimeoutError(url)
    return f"café \n {k}".encode("utf_8" if k % 2 else "cp1252")


@query("""with k as (select c_custkey, c_custkey % 7 = 0 as never, c_custkey % 5 = 2 as later, length(c_custkey::varchar) as n from customer)
    select c_custkey, case when never then 0 when c_custkey % 2 = 1 then 8 + n else 7 + n end::bigint as length, case when never or later then 2 else 1 end::int as attempts, case when never then '' else 'café ' || c_custkey end as html from k""")
def source_fetched(spark, sf_dir):
    """Pages of three hosts, one of which has most of them, fetched by the data source: some answer at the second attempt,
    some never (A1, A2, B1, B4)."""
    k = F.col("c_custkey")
    host = F.when(k % 10 == 0, "https://a.org/").when(k % 10 == 1, "https://B.org/").otherwise("https://h.org/")
    links = load(spark, sf_dir, "customer").select("c_custkey", F.concat(host, k.cast("string")).alias("url"), F.concat(F.lit("/n/"), k.cast("string")).alias("mirror_path"))
    kept = mirror.mirror(spark, links, folder(spark), lanes=8, fetch="folioforge.plans.io_queries:answer", attempts=2)
    return links.select("c_custkey", "mirror_path").join(kept, "mirror_path").join(mirror.fetched_pages(kept).select("mirror_path", "html"), "mirror_path").select("c_custkey", "length", "attempts", "html")


@query("with t as (select page_id, case when page_id % 3 = 0 then html || ' new' else html end as html from pages) select page_id, strlen(html)::bigint as length, md5(html) as content_md5 from t")
def sink_mirror_tree(spark, sf_dir):
    """A tree of raw files written by the data source, a third of them written again, and read back."""
    at = folder(spark)
    mirror.register(spark)
    pages = load(spark, sf_dir, "pages").select("page_id", F.concat(F.lit("/site/"), (F.col("page_id") % 40).cast("string"), F.lit("/"), F.col("page_id").cast("string"), F.lit(".html")).alias("mirror_path"), "html")
    files = pages.select("mirror_path", F.col("html").cast("binary").alias("content"))
    files.write.format("pages").mode("append").save(at)
    pages.where("page_id % 3 = 0").select("mirror_path", F.concat("html", F.lit(" new")).cast("binary").alias("content")).write.format("pages").mode("append").save(at)
    return mirror.tree(spark, at).join(pages, "mirror_path").select("page_id", "length", F.md5("content").alias("content_md5"))


@query("select n_name as key, 'n' || n_nationkey || ' \"é\"' as value from nation")
def source_dictionary(spark, sf_dir):
    """A JSON object of strings."""
    at = folder(spark)
    rows = load(spark, sf_dir, "nation").select(F.col("n_name"), F.concat(F.lit("n"), F.col("n_nationkey").cast("string"), F.lit(' "é"')).alias("value"))
    rows.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("n_name", "value")))).alias("json")).coalesce(1).write.text(at)
    return readers.dictionary(spark, at)


@query("select o_orderkey::varchar as filename, (o_orderkey % 1000)::int as file_size, (o_orderkey % 100)::double as compress_pct, strftime(o_orderdate, '%Y-%m-%d') as day from orders")
def source_mirror_list(spark, sf_dir):
    """The listing of a zipped mirror: CSV with types, times, and percentages as numbers."""
    at, k = folder(spark), F.col("o_orderkey")
    rows = load(spark, sf_dir, "orders").select(
        F.lit("mmwr").alias("a"), (k % 1000).alias("b"), F.lit("Deflate").alias("c"), (k % 500).alias("d"), F.concat((k % 100).cast("string"), F.lit("%")).alias("e"), F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("f"), F.lit("00ff").alias("g"), k.cast("string").alias("h")
    )
    rows.write.csv(at, header=True)
    return readers.mirror_list(spark, at).select("filename", "file_size", "compress_pct", F.date_format("date_time", "yyyy-MM-dd").alias("day"))


TABLE_SQL = registry.SQL["corpus_table"]


@query(TABLE_SQL)
def sink_corpus_csv(spark, sf_dir):
    """The corpus table as quoted CSV and back."""
    at = folder(spark)
    writers.corpus_csv(registry.QUERIES["corpus_table"](spark, sf_dir), at)
    return readers.corpus_csv(spark, at)


@query(f"with t as ({TABLE_SQL}) select * replace ({', '.join(f'case when list_contains({d!r}, {c}) then {c} end as {c}' for c, d in R.DOMAINS.items())}) from t")
def source_corpus_typed(spark, sf_dir):
    """The corpus read with its ordered domains: other values are null."""
    at = folder(spark)
    writers.corpus_csv(registry.QUERIES["corpus_table"](spark, sf_dir), at)
    return readers.corpus_csv(spark, at, domains=True)


ORDINALS = {c: f"nullif(coalesce(list_position({d!r}, {c}), 0), 0)" for c, d in R.DOMAINS.items()}


@query(f"""with t as ({TABLE_SQL}) select url, row_number() over (order by {ORDINALS["stratum"]} desc nulls last, {ORDINALS["level"]} nulls last, url)::bigint as place from t""")
def csv_domains_kept(spark, sf_dir):
    """The corpus as CSV, of which one column's domain is another than the corpus' own: read back, its places follow from the
    domains that its columns carry (A9, J12)."""
    at = folder(spark)
    writers.corpus_csv(R.with_domains(registry.QUERIES["corpus_table"](spark, sf_dir), R.DOMAINS | {"stratum": R.STRATA[::-1]}), at)
    back = readers.corpus_csv(spark, at, domains=True)
    return R.places_by(back, ["stratum", "level"], "url").select("url", "place")


@query(TABLE_SQL)
def sink_records(spark, sf_dir):
    """The corpus table as JSON records, and as a checkpoint that fails if it exists."""
    at = folder(spark)
    df = registry.QUERIES["corpus_table"](spark, sf_dir)
    writers.records(df, f"{at}/json")
    writers.checkpoint(readers.records(spark, f"{at}/json", ", ".join(f"{c} string" for c in R.CORPUS)), f"{at}/parquet")
    return readers.checkpoint(spark, f"{at}/parquet")


@query("select case when doc_id % 9 = 0 then null else source end as collection, doc_id::varchar as url, coalesce(text, '') || ' é😀' as content from documents")
def sink_bundles(spark, sf_dir):
    """JSON objects by collection with ASCII escapes, and back (B10, L5). Documents without a collection are one of their own."""
    at = folder(spark)
    docs = load(spark, sf_dir, "documents").select(F.when(F.col("doc_id") % 9 > 0, F.col("source")).alias("collection"), F.col("doc_id").cast("string").alias("url"), F.concat(F.coalesce("text", F.lit("")), F.lit(" é😀")).alias("html"))
    writers.bundle_objects(docs, "html", at, ascii_only=True, rows=50)
    return readers.bundles(spark, at)


@query("""with r as (select 'by lang' as sheet, lang as a, null as b, count(*) as n from documents group by all union all select 'by source & lang', source, lang, count(*) from documents group by all)
    select sheet, coalesce(a, '-') as a, coalesce(b, '-') as b, n from r""")
def sink_workbook(spark, sf_dir):
    """Counts by several groupings, from one scan, as a folder of quoted CSV a sheet, and back."""
    at = folder(spark)
    counts = R.grouping_counts(load(spark, sf_dir, "documents"), [["lang"], ["source", "lang"]])
    first = F.col("_set") == "lang"
    writers.sheets(counts.select(F.when(first, "by lang").otherwise("by source & lang").alias("sheet"), F.when(first, F.col("lang")).otherwise(F.col("source")).alias("a"), F.when(~first, F.col("lang")).alias("b"), "n"), "sheet", at)
    rows = readers.sheets(spark, at, "sheet", "a string, b string, n long")
    return rows.select("sheet", F.coalesce("a", F.lit("-")).alias("a"), F.coalesce("b", F.lit("-")).alias("b"), "n")


@query(registry.SQL["three_way_inner"])
def stages_joined(spark, sf_dir):
    """The three-way join over stored stages, bucketed by the path: no rows are moved for it."""
    at = folder(spark)
    links = labelled(load(spark, sf_dir, "pages")).select("page_id", "collection", "level", F.col("page_id").cast("long").alias("mirror_path"))
    docs = load(spark, sf_dir, "documents").select(F.col("doc_id").alias("path"), F.col("lang").alias("doc_lang"))
    labels = load(spark, sf_dir, "labels").select(F.col("doc_id").alias("path"), "quality")
    for name, df, key in (("links", links, "mirror_path"), ("docs", docs, "path"), ("labels", labels, "path")):
        stages.store(df, f"{at}/{name}", key, buckets=8)
    return R.corpus(*(stages.stored(spark, f"{at}/{name}") for name in ("links", "docs", "labels")), ["article"]).select("page_id", "collection", "doc_lang", "quality")


def renditions_of(spark, sf_dir):
    """Pages with their collection and three renditions, from one parse."""
    pages = labelled(R.spread(load(spark, sf_dir, "pages")))
    made = pages.select("page_id", "collection", "html", P.parse_document("html", "text", "md").alias("p"))
    return made.select("page_id", "collection", F.col("page_id").cast("string").alias("url"), "html", F.col("p.md").alias("md"), F.col("p.text").alias("txt"))


FORMATS = {"html": True, "md": False, "txt": True}


@query(f"with {LABELLED} select collection || '_html.json' as file, page_id::varchar as url, row_number() over (partition by collection order by page_id) - 1 as place, md5(html || ' é😀') as content_md5 from labelled")
def bundles_exact(spark, sf_dir):
    """One JSON file a collection, in the corpus' order and with ASCII escapes, put together from the parts of many tasks, and
    read back with each entry's place (B10, L5, A10)."""
    at = folder(spark)
    pages = labelled(load(spark, sf_dir, "pages")).select("page_id", "collection", F.col("page_id").cast("string").alias("url"), F.concat("html", F.lit(" é😀")).alias("html"))
    exports.write_bundles(pages, at, {"html": True}, ["page_id"])
    return exports.read_bundles(spark, at).select(F.col("member").alias("file"), "url", "place", F.md5("content").alias("content_md5"))


@query(f"""with {LABELLED}, f as (select unnest(['html', 'md', 'txt']) as format) select collection || '_' || format || '.json' as file, page_id::varchar as url,
    row_number() over (partition by collection, format order by page_id desc) - 1 as place, case when format = 'html' then md5(html) end as html_md5 from labelled, f""")
def bundles_zipped(spark, sf_dir):
    """Three renditions, zipped, in the reverse order of pages, read a task an entry by its byte range."""
    at = folder(spark)
    exports.write_bundles(renditions_of(spark, sf_dir).withColumn("back", -F.col("page_id")), at, FORMATS, ["back"], zipped=True)
    got = exports.read_bundles(spark, at)
    return got.select(F.col("member").alias("file"), "url", "place", F.when(F.col("member").endswith("_html.json"), F.md5("content")).alias("html_md5"))


def stored_orders(spark, pages, at, bent=None):
    """The stores (html, md, txt) of pages, written, read back in their own order, and held against the corpus, which is written
    in its order: (store, n, missing, more, moved). bent: a change of a store's rows before it is written, by its name."""
    corpus = pages.select("collection", "page_id", F.col("page_id").cast("string").alias("url"))
    order = [R.domain_order(F.col("collection"), R.COLLECTIONS), "collection", "page_id"]
    corpus.orderBy(*order).write.parquet(f"{at}/corpus")
    kept = spark.read.schema(corpus.schema).parquet(f"{at}/corpus")
    for name, ascii_only in FORMATS.items():
        exports.write_bundles((bent or {}).get(name, lambda x: x)(pages.withColumn("at", F.col("page_id").cast("double"))), f"{at}/{name}", {name: ascii_only}, ["at"], zipped=True)
    true, out = sequence.whole(sequence.of_files(kept, "url")), []
    for name in FORMATS:
        read = exports.read_bundles(spark, f"{at}/{name}")
        n, digest = sequence.whole(sequence.of_members(read, "url", R.COLLECTIONS, F.lit(f"_{name}.json")))
        if (n, digest) == true:  # the same keys in the same order: nothing to look for
            out.append(spark.createDataFrame([(name, n, 0, 0, 0)], "store string, n long, missing long, more long, moved long"))
        else:
            last = lambda df: df.withColumn("c", F.coalesce(R.ordinal(F.col("collection"), R.COLLECTIONS), F.lit(len(R.COLLECTIONS) + 1)))
            rows = read.select("url", F.substring_index("member", f"_{name}.json", 1).alias("collection"), "place")
            store = R.ranked(last(rows), ["c", "collection", "place"], "k")
            keys = R.ranked(last(kept), ["c", "collection", "page_id"], "k")
            out.append(R.consistent(keys.select("url", "k"), {name: store.select("url", "k")}, "url", "k").select("store", "n", "missing", "more", "moved"))
    return R.union(*out)


@query("with k as (select count(distinct page_id) as n from pages) select unnest(['html', 'md', 'txt']) as store, n, 0::bigint as missing, 0::bigint as more, 0::bigint as moved from k")
def reconstruct_consistency(spark, sf_dir):
    """The three renditions, written as zipped bundles and read back, hold the corpus' keys in the corpus' order."""
    at = folder(spark)
    renditions_of(spark, sf_dir).write.parquet(f"{at}/pages")
    return stored_orders(spark, spark.read.parquet(f"{at}/pages"), f"{at}/stores")


@query(f"""with {LABELLED}, k as (select count(*) as n from labelled), c as (select collection, min(page_id) as a, count(*) as n from labelled group by 1 having count(*) > 1 order by collection limit 1),
    -- of the first collection with two pages the first one comes last in one store: all of its pages move; without page 0 all pages that the corpus has behind it do
    o as (select page_id, row_number() over (order by list_position({R.COLLECTIONS!r}, collection) nulls last, collection, page_id) as place from labelled)
    select 'html' as store, n, 0::bigint as missing, 0::bigint as more, 0::bigint as moved from k
    union all select 'md', k.n, 0, 0, c.n from k, c
    union all select 'txt', k.n - 1, 1, 0, k.n - (select place from o where page_id = 0) from k""")
def reconstruct_differences(spark, sf_dir):
    """As above, where one store holds a page at another place, and one lacks a page: both are seen."""
    at = folder(spark)
    pages = labelled(load(spark, sf_dir, "pages")).select("page_id", "collection", F.col("page_id").cast("string").alias("url"), "html", F.lit("m").alias("md"), F.lit("t").alias("txt"))
    first = pages.groupBy("collection").agg(F.min("page_id").alias("a"), F.count("*").alias("n")).where("n > 1").orderBy("collection").limit(1)
    last = lambda df: df.join(F.broadcast(first.select("a")), F.col("page_id") == F.col("a"), "left").withColumn("at", F.when(F.col("a").isNotNull(), float("inf")).otherwise(F.col("at"))).drop("a")
    return stored_orders(spark, pages, f"{at}/stores", {"md": last, "txt": lambda df: df.where("page_id <> 0")})
