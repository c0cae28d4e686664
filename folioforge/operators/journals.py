"""Whole rows of the three journals: datelines from paths, pages and lookup tables, head metadata, and the corpus table.

Pages are (path, html) and parsed once for each purpose; all that follows is built-in expressions. Lookup tables are
(key, value). What is missing is null until it is exported.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.functions import datelines as D
from folioforge.functions import keywords as W
from folioforge.functions import urls as U
from folioforge.operators import documents as P
from folioforge.operators import relational as R

# fixed values: metas that the corpus keeps
METAS = ["citation_categories", "citation_author", "citation_doi", "keywords", "Keywords", "description", "Description"]
# fixed values: metas that say what a weekly's dateline says
MMWR_METAS = ["MMWR_Type", "Volume", "Issue_Num", "Issue", "Page", "Date"]
LEVELS_KEPT = ["volume", "issue", "article"]


def mmwr_datelines(pages: DataFrame, corrections: DataFrame | None = None) -> DataFrame:
    """path, src, dateline, series, lang, dl_year_mo, dl_vol_iss, dl_date, dl_page of volume pages and articles.
    Corrections come before the page's element, and this before its script. Other paths have nulls."""
    df = R.lookup(pages.select("path", "html"), "path", corrections, "_cx").withColumn("_p", P.dateline_parts("html", "title", "volumes", "div"))
    title, date = D.mmwr_script(F.col("html"))
    src, text = D.source_precedence(F.col("_cx"), F.col("_p.div"), title, date)
    df = df.select(
        "path", F.col("_p.title").alias("_title"), F.col("_p.volumes").alias("_volumes"), src.alias("_src"), text.alias("_text"),
        F.col("path").rlike(D.VOLUME_PATH).alias("_v"), F.struct(*(c.alias(n) for n, c in D.mmwr_volume_path(F.col("path")).items())).alias("_vol"),
        F.struct(*(c.alias(n) for n, c in D.mmwr_article_path(F.col("path")).items())).alias("_art"),
    ).withColumn("_dl", F.struct(*(c.alias(n) for n, c in D.mmwr(F.col("_text")).items())))
    article = F.col("_art.fn_stem").isNotNull()
    notifiable = F.col("_art.fn_stem").endswith("md") | F.coalesce(F.col("_title"), F.lit("")).startswith("Notifiable Diseases")

    def either(volume: Column, of_article: Column) -> Column:
        return F.when(F.col("_v"), volume).when(article, of_article)

    return df.select(
        "path", either(F.lit(None), F.col("_src")).alias("src"), either(F.col("_volumes"), F.col("_text")).alias("dateline"),
        either(F.col("_vol.series"), F.when(F.col("_dl.dl_vol_iss").isNotNull() & notifiable, "mmnd").otherwise(F.col("_dl.series"))).alias("series"),
        either(F.lit("en"), F.col("_art.lang")).alias("lang"), either(F.col("_vol.dl_date"), F.col("_dl.dl_year_mo")).alias("dl_year_mo"),
        *(either(F.col(f"_vol.{c}"), F.col(f"_dl.{c}")).alias(c) for c in ("dl_vol_iss", "dl_date")), either(F.lit(None), F.col("_dl.dl_page")).alias("dl_page"),
    )


def mmwr_dateline_details(pages: DataFrame) -> DataFrame:
    """Everything that says when an article appeared, side by side (G11-G14, G19): the path's parts, script, element and metas, and the parsed dateline."""
    df = pages.select("path", "html", P.dateline_parts("html", "div").alias("_p"), P.head_tags("html").alias("_tags"))
    script = D.mmwr_script_dateline(F.col("html"))
    df = df.select("path", D.standard_name(F.col("path")).alias("fn_stan"), *(c.alias(n) for n, c in D.mmwr_article_path(F.col("path")).items() if n != "lang"),
        script.alias("var_dl"), F.coalesce("_p.div", F.lit("_ / _ / _")).alias("div_dl"), *(first_meta(F.col("_tags"), m).alias("md_" + m) for m in MMWR_METAS))
    src, text = D.which_dateline(F.col("var_dl"), F.col("div_dl"))
    df = df.withColumns({"src": src, "dl": text})
    return df.select("*", *(c.alias(n) for n, c in D.mmwr_detail(F.col("dl")).items())).select("*", "pages.*").drop("pages")


def eid_datelines(pages: DataFrame, missing_pages: DataFrame | None = None) -> DataFrame:
    """path, lang, dateline, dl_vol_iss, dl_year_mo, dl_page (G20-G24). Lookup keys are paths without .html."""
    df = pages.select("path", F.regexp_replace("path", r"\.html$", "").alias("_key"), P.dateline_parts("html", "citations", "texts").alias("_p"))
    df = R.lookup(df, "_key", missing_pages, "_missing").withColumn("_level", D.eid_path_level(F.col("_key")))
    note = F.filter("_p.texts", lambda n: n["string"].rlike(D.EID))
    df = df.withColumn("_text", F.try_element_at(note, F.lit(1))["string"])
    parts = D.eid(F.col("_text"), F.coalesce(F.col("_level") == "volume", F.lit(False)))
    page = F.when(F.col("_level") == "article", F.coalesce(D.eid_page(F.try_element_at("_p.citations", F.lit("EID"))), "_missing"))
    return df.select("path", F.lit("en").alias("lang"), *(c.alias(n) for n, c in parts.items()), page.alias("dl_page"))


def eid_probe(pages: DataFrame) -> DataFrame:
    """Where in a page its dateline stands (G25): the first text with one below title, a, h5 and p."""
    found = F.filter("_p.texts", lambda n: n["string"].rlike(D.EID))

    def below(tag: str) -> Column:
        return F.try_element_at(F.filter(found, lambda n: n["tag"] == tag), F.lit(1))["string"]

    at = [below(tag) for tag in ("title", "a", "h5", "p")]
    return pages.select("path", P.dateline_parts("html", "texts").alias("_p")).select("path", *(D.part(c, f"({D.EID})", 1).alias(n) for c, n in zip(at, ("dl_title", "dl_toc_a", "dl_header_h5", "dl_p"), strict=True)))


def citation_cells(pages: DataFrame) -> DataFrame:
    """path, the citation table's headers, sorted, with bars between, and the cells of three of them."""
    c = F.col("_p.citations")
    cells = pages.select("path", P.dateline_parts("html", "citations").alias("_p"))
    return cells.select("path", F.array_join(F.array_sort(F.map_keys(c)), "|").alias("headers"), *(F.coalesce(F.try_element_at(c, F.lit(k)), F.lit("")).alias(k.lower()) for k in ("AMA", "APA", "EID")))


def pcd_contents_datelines(pages: DataFrame, year_mo_to_vol_iss: DataFrame | None = None, corrections: DataFrame | None = None) -> DataFrame:
    """path, lang, dateline, dl_vol_iss, dl_year_mo of contents pages (G29, G30). Corrections (key, value) come on top of
    the fixed ones, both only for pages with an ISSN."""
    fixed = F.element_at(D.lookup(D.PCD_TOC_CORRECTIONS), F.col("path"))
    parts = D.pcd_toc_path(F.col("path"))
    df = pages.select("path", D.pcd_toc(F.col("html")).alias("_found"), F.col("html").contains("ISSN").alias("_issn"), *(c.alias(n) for n, c in parts.items()))
    df = R.lookup(R.lookup(df, "path", corrections, "_cx"), "dl_year_mo", year_mo_to_vol_iss, "dl_vol_iss")
    return df.select("path", "lang", F.when(F.col("_issn"), F.coalesce(F.col("_cx"), fixed, F.col("_found"))).alias("dateline"), "dl_vol_iss", "dl_year_mo")


_MONTHED = r"(?is)Volume.{1,2}\d.{1,20}(Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)"


def pcd_article_datelines(pages: DataFrame, corrections: DataFrame | None = None, vol_iss_to_date: DataFrame | None = None, article_numbers: DataFrame | None = None) -> DataFrame:
    """path, dateline, dl_vol_iss, dl_year_mo, dl_date, dl_art_num, lang, dl_cat of English articles (G31-G35): from the
    first short paragraph with a volume and a month, or from a correction, whose year is the path's."""
    df = R.lookup(pages.select("path", P.dateline_parts("html", "notes").alias("_p")), "path", corrections, "_cx")
    short = F.filter("_p.notes", lambda n: n["string"].rlike(_MONTHED) & (n["tag"] == "p") & (n["size"] < 200))
    found = F.trim(F.regexp_replace(F.try_element_at(short, F.lit(1))["around"], r"(?U)\s+", " "))
    df = df.withColumn("_text", F.coalesce("_cx", found))
    df = df.select("path", "_cx", "_text", *(c.alias(n) for n, c in D.pcd(F.col("_text")).items()))
    df = R.lookup(R.lookup(df, "dl_vol_iss", vol_iss_to_date, "_date"), "path", article_numbers, "_number")
    early = F.coalesce(F.col("_text").rlike(D.PCD_EARLY), F.lit(False))
    return df.select(
        "path", F.when(early, F.col("_text")).otherwise(D.part(F.col("_text"), r"(Volume.*?\d{4})", 1)).alias("dateline"), "dl_vol_iss",
        F.when(F.col("_cx").isNotNull(), D.part(F.col("path"), r"/(\d{4})/", 1)).otherwise(F.col("dl_year_mo")).alias("dl_year_mo"),
        F.when(early, F.coalesce("_date", "dl_date")).otherwise(F.col("dl_date")).alias("dl_date"), F.coalesce("_number", F.lit("")).alias("dl_art_num"), F.lit("en").alias("lang"), "dl_cat",
    )


def pcd_translations(paths: DataFrame, english: DataFrame) -> DataFrame:
    """Translated articles with their English page's dateline (H6); what that lacks is empty."""
    lang, path_en = U.translation(F.col("path"))
    foreign = paths.where(D.pcd_translated(F.col("path"))).select("path", lang.alias("lang"), path_en.alias("path_en"))
    columns = [c for c in english.columns if c not in ("path", "lang")]
    return R.translations(foreign, english, columns).drop("path_en").na.fill("", columns)


def first_meta(tags: Column, name: str) -> Column:
    """Content of the first meta of a name, case-sensitive, stripped; empty if there is none."""
    first = F.try_element_at(F.filter(tags, lambda t: (t["name"] == "meta") & (t["attrs"]["name"] == name)), F.lit(1))
    return F.coalesce(F.trim(first["attrs"]["content"]), F.lit(""))


def head_metadata(pages: DataFrame, journal: str) -> DataFrame:
    """path, title, link_canon, md_* of seven metas, md_kwds, md_desc by the journal's rules (I1, J1-J6), and md_authors: all authors with bars between."""
    t = F.col("_tags")
    canon = F.try_element_at(F.filter(t, lambda x: (x["name"] == "link") & F.array_contains(F.split(x["attrs"]["rel"], " "), "canonical")), F.lit(1))
    title = F.try_element_at(F.filter(t, lambda x: x["name"] == "title"), F.lit(1))["string"]
    authors = F.filter(t, lambda x: (x["name"] == "meta") & (x["attrs"]["name"] == "citation_author"))
    df = pages.select("path", P.head_tags("html").alias("_tags")).select(
        "path", F.coalesce(title, F.lit("")).alias("title"), F.coalesce(F.trim(canon["attrs"]["href"]), F.lit("")).alias("link_canon"),
        *(first_meta(t, m).alias(_column(m)) for m in METAS), F.array_join(F.transform(authors, lambda x: F.trim(x["attrs"]["content"])), "|").alias("md_authors"),
    )
    low, up = F.col(_column("keywords")), F.col(_column("Keywords"))
    if journal == "mmwr":
        return df.withColumns({"md_kwds": W.joined(W.mmwr_keywords(low), W.mmwr_keywords(up), ignore=W.MMWR_IGNORE), "md_desc": W.description(F.col(_column("description")), W.MMWR_IGNORE_DESC)})
    if journal == "eid":
        return df.withColumns({"md_kwds": W.joined(W.eid_keywords(low), ignore=W.EID_IGNORE), "md_desc": F.col(_column("description"))})
    return df.withColumns({"md_kwds": W.joined(W.pcd_keywords(low), W.pcd_keywords(up), ignore=W.PCD_IGNORE), "md_desc": W.description(F.col(_column("Description")), W.PCD_IGNORE_DESC)})


def _column(meta: str) -> str:
    """Spark's names don't tell upper from lower case: capitalised metas get another name."""
    return f"md_{meta}" if meta.islower() else f"md_{meta.lower()}_cap"


def head_pairs(pages: DataFrame) -> DataFrame:
    """path, seq, attr_name, attr_value of titles, canonical links, named metas and properties whose content isn't empty."""
    tag = F.col("t")
    a, name = tag["attrs"], tag["name"]
    label = (
        F.when(name == "title", "title").when((name == "link") & F.array_contains(F.split(a["rel"], " "), "canonical"), "link:rel:canonical")
        .when((name == "meta") & a["name"].isNotNull(), F.concat(F.lit("meta:name:"), a["name"])).when((name == "meta") & a["property"].isNotNull(), F.concat(F.lit("meta:property:"), a["property"]))
    )
    value = F.when(name == "title", tag["string"]).when(name == "link", "").otherwise(a["content"])
    out = pages.select("path", F.posexplode(P.head_tags("html")).alias("seq", "t")).select("path", "seq", label.alias("attr_name"), value.alias("attr_value"), (name == "meta").alias("_m"))
    return out.where("attr_name is not null and not (_m and coalesce(attr_value, '-') = '')").drop("_m")


def head_counts(pages: DataFrame) -> DataFrame:
    """path, attr_name, n (I5, I8 long); repeated ones are those with n > 1."""
    return head_pairs(pages).groupBy("path", "attr_name").agg(F.count("*").alias("n"))


def wide_names(names: list[str]) -> dict[str, str]:
    """A column's name for each name: the name itself, with ~2, ~3 and so on behind it where another differs in case only."""
    seen: dict[str, int] = {}
    out = {}
    for n in sorted(names):
        k = seen[n.lower()] = seen.get(n.lower(), 0) + 1
        out[n] = n if k == 1 else f"{n}~{k}"
    return out


def head_counts_wide(pages: DataFrame, names: list[str] | None = None, most: int = 2000) -> DataFrame:
    """path and a count a name, 0 where a page has none (I8). Names that aren't given are those that the pages have, in
    alphabetical order: pages are parsed once, their counts stored, and names found there. More than `most` of them are an
    error, as a table of so many columns helps nobody; head_counts has them as rows."""
    counts = R.stored(head_counts(pages))
    if names is None:
        names = [r.attr_name for r in counts.select("attr_name").distinct().limit(most + 1).collect()]
        if len(names) > most:
            raise ValueError(f"more than {most} names")
    columns = wide_names(names)
    wide = counts.groupBy("path").agg(*(F.sum(F.when(F.col("attr_name") == n, F.col("n"))).alias(c) for n, c in columns.items())) if names else counts.select("path").distinct()
    quoted = {c: f"`{c.replace('`', '``')}`" for c in columns.values()}
    return pages.select("path").distinct().join(wide, "path", "left").select("path", *(F.coalesce(F.col(q), F.lit(0)).alias(c) for c, q in quoted.items()))


def tag_rows(pages: DataFrame) -> DataFrame:
    """path, seq, tag_name, tag_str, n_attr, tag_attr of all tags of heads."""
    rows = pages.select("path", F.posexplode(P.head_tags("html")).alias("seq", "t"))
    return rows.select("path", "seq", F.col("t.name").alias("tag_name"), F.col("t.string").alias("tag_str"), F.size("t.attrs").alias("n_attr"), F.col("t.attrs").alias("tag_attr"))


def corpus_rows(links: DataFrame, datelines: DataFrame, metadata: DataFrame, journal: str) -> DataFrame:
    """The corpus' 23 columns for a journal (H1, J7-J11): links of kept levels joined with datelines and head metadata by path."""
    df = R.corpus(links.select("url", "base", "string", "level", "mirror_path"), datelines, metadata, LEVELS_KEPT)
    if journal == "eid":
        df = df.withColumn("series", F.when(F.col("level") == "article", D.banding(F.substring("dl_vol_iss", 1, 2))).otherwise("eid"))
    elif journal == "pcd":
        df = df.withColumn("series", F.lit("pcd"))
    scope = F.when(F.col("level") == "article", "art").otherwise("toc")
    df = df.withColumn("collection", R.collection(F.col("series"), F.col("level"), F.col("lang"))).withColumn("stratum", F.concat(F.lit(journal + "_"), scope))
    return R.projected(df.withColumn("series", F.when(F.col("series").isin(R.SERIES), F.col("series"))))
