"""One parse a document: everything that later stages read from its tree, as one struct; and its explosions."""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.functions import arrow_function
from folioforge.functions import urls as U
from folioforge.operators import html_kernel as K
from folioforge.operators.relational import union

#: What can be read off a document's tree.
FIELDS = {
    "title": "string", "canonical": "string", "metas": "array<struct<name string, content string>>", "anchors": "array<struct<href string, string string, only string>>",
    "h1": "string", "dateline_div": "string", "eid_citation": "string", "text": "string", "md": "string",
}
HEAD = {"title", "canonical", "metas"}
TAGS = "array<struct<name string, string string, attrs map<string, string>>>"
DATELINE_PARTS = {
    "title": "string", "volumes": "string", "div": "string", "citations": "map<string, string>", "notes": "array<struct<seq int, tag string, size int, string string, around string>>",
    "texts": "array<struct<tag string, string string>>",
}
SVG = "n int, trimmed int, len0 int, len1 int, len2 int, len3 int, len4 int, len5 int"


def _parsed(text: str | None, fields: tuple[str, ...]) -> tuple:
    root = K.parse_head(text) if HEAD >= set(fields) else K.parse(text)
    out: dict = {}
    if HEAD & set(fields):
        title, canonical, metas = K.head_meta(root)
        out |= {"title": title, "canonical": canonical, "metas": [{"name": a, "content": b} for a, b in metas]}
    if "anchors" in fields:
        out["anchors"] = [{"href": a, "string": b, "only": c} for a, b, c in K.anchors(root)]
    if "h1" in fields:
        out["h1"] = h1.text().strip() if (h1 := root.find("h1")) else None
    if "dateline_div" in fields:
        out["dateline_div"] = div.text().strip() if (div := root.find("div", class_="dateline")) else None
    if "eid_citation" in fields:
        out["eid_citation"] = next((s.text() for th in root.find_all("th") if th.text().strip() == "EID" and (s := th.next_element()) is not None), None)
    if "text" in fields:  # it takes elements out of the tree, as Markdown then does
        out["text"] = K.plain_text(root)
    if "md" in fields:
        out["md"] = K.markdown(root)
    return tuple(out[k] for k in fields)


def parse_document(html: Column | str, *fields: str) -> Column:
    """A struct of some FIELDS, all by default, by one parse; of the head alone if no others are asked for."""
    fields = fields or tuple(FIELDS)

    def parsed(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            yield pd.DataFrame([_parsed(x, fields) for x in s], columns=list(fields))

    parsed.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return arrow_function(", ".join(f"{k} {FIELDS[k]}" for k in fields))(parsed)(html)


@arrow_function(FIELDS["anchors"], F.arrow_udf)
def anchors(html: pa.Array) -> pa.Array:
    """A document's anchors, as parse_document gives them, without its tree where its markup is plain."""
    found = [K.anchors_of(x) for x in html.to_pylist()]
    ends = [0, *itertools.accumulate(map(len, found))]
    columns = list(zip(*(a for page in found for a in page), strict=True)) or [()] * 3
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([pa.array(c, pa.string()) for c in columns], ["href", "string", "only"]))


_VOLUME, _VOLUMES = re.compile("Volume"), re.compile(r"(Past|Current) Volumes? \(")


def _dateline_parts(text: str | None, fields: tuple[str, ...]) -> tuple:
    root, out = K.parse(text), {}
    if "title" in fields:
        out["title"] = title.stripped() if (title := root.find("title")) else None
    if "volumes" in fields:
        out["volumes"] = next((around for _, tag, _, _, around in K.text_nodes(root, _VOLUMES) if tag == "h1"), None)
    if "div" in fields:
        out["div"] = div.stripped() if (div := root.find("div", class_="dateline")) else None
    if "citations" in fields:
        out["citations"] = K.citations(root)
    if "notes" in fields:
        out["notes"] = [dict(zip(("seq", "tag", "size", "string", "around"), n, strict=True)) for n in K.text_nodes(root, _VOLUME)]
    if "texts" in fields:
        out["texts"] = [{"tag": tag, "string": string} for tag, string in K.matching_texts(root, _VOLUME)]
    return tuple(out[k] for k in fields)


def dateline_parts(html: Column | str, *fields: str) -> Column:
    """What datelines are read from, by one parse, a struct of some DATELINE_PARTS, all by default: title, heading of volumes,
    dateline element, citations, texts with `Volume` as notes, and as texts with their element's name alone."""
    fields = fields or tuple(DATELINE_PARTS)

    def parts(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            yield pd.DataFrame([_dateline_parts(x, fields) for x in s], columns=list(fields))

    parts.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return arrow_function(", ".join(f"{k} {DATELINE_PARTS[k]}" for k in fields))(parts)(html)


def text_nodes(html: Column | str, pattern: str) -> Column:
    """The texts that match a pattern, in document order: struct(seq, tag, size, string, around) of each."""
    compiled = re.compile(pattern)

    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield s.map(lambda x: [dict(zip(("seq", "tag", "size", "string", "around"), n, strict=True)) for n in K.text_nodes(K.parse(x), compiled)])

    found.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return arrow_function("array<struct<seq int, tag string, size int, string string, around string>>")(found)(html)


@arrow_function(TAGS)
def head_tags(s: pd.Series) -> pd.Series:
    return s.map(lambda x: [{"name": n, "string": t, "attrs": a} for n, t, a in K.tags(K.parse_head(x))])


@arrow_function("string")
def trim_svg(s: pd.Series) -> pd.Series:
    return s.map(K.trim_svg, na_action="ignore")


@arrow_function(SVG)
def svg_lengths(s: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([[n, trimmed, *lengths] for n, trimmed, lengths in (K.svg_lengths(x or "") for x in s)], columns=[x.split()[0] for x in SVG.split(", ")])


def native_anchors(html: Column) -> Column:
    """Raw `<a href="...">text</a>` without nested markup, in order, by regular expression alone: for pages that are known to hold no others."""
    hrefs, texts = (F.regexp_extract_all(html, F.lit(r'<a href="([^"]*)">([^<]*)</a>'), F.lit(k)) for k in (1, 2))
    return F.arrays_zip(hrefs.alias("href"), texts.alias("string"))


class Rule(NamedTuple):
    """Which anchors make up a level: of href, of text, and whether only the first of a page counts; base: what links are resolved against."""

    level: str
    href: str | None = None
    text: str | None = None
    first: bool = False
    base: str | None = None

    def holds(self, a: Column) -> Column:
        out = a["href"].isNotNull()
        if self.href:
            out = out & a["href"].rlike(f"(?U){self.href}")
        return out & F.coalesce(a["only"].rlike(f"(?U){self.text}"), F.lit(False)) if self.text else out


def by_rule(values: list[Column]) -> Column:
    """The value of the row's rule."""
    out = values[-1]
    for k in reversed(range(len(values) - 1)):
        out = F.when(F.col("_rule") == k, values[k]).otherwise(out)
    return out


def linked(looked_in: list[tuple[DataFrame, Rule]], url_col: str = "url", html_col: str = "html") -> DataFrame:
    """The link rows of all rules, each with the pages that it looks in: all pages pass one parse and one resolution together."""
    rules = [r for _, r in looked_in]
    pages = union(*(p.select(F.lit(k).alias("_rule"), (F.lit(r.base) if r.base else F.col(url_col)).alias("_base"), F.col(html_col).alias("_html")) for k, (p, r) in enumerate(looked_in)))
    found = pages.select("_rule", "_base", anchors("_html").alias("_a"))
    numbered = F.transform("_a", lambda a, i: F.struct(i.alias("seq"), a["href"].alias("href"), a["string"].alias("string"), a["only"].alias("only")))
    kept = found.select("_rule", "_base", F.filter(numbered, lambda a: by_rule([r.holds(a) for r in rules])).alias("_a"))
    rows = kept.select("_rule", "_base", F.explode(by_rule([F.slice("_a", 1, 1) if r.first else F.col("_a") for r in rules])).alias("_l"))
    rows = rows.select("_base", "_l.seq", F.col("_l.href").alias("_href"), F.col("_l.string").alias("_string"), by_rule([F.lit(r.level) for r in rules]).alias("level"))
    out = rows.select("seq", U.resolve_links("_base", "_href", "_string").alias("_r"), "level")
    return out.select("_r.base", "seq", "_r.href", "_r.url", "_r.path", "_r.filename", "_r.mirror_path", "_r.string", "level")


def links(pages: DataFrame, level: str, href: str | None = None, text: str | None = None, first: bool = False, base: str | None = None, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Link rows of a level (D1-D7): base, seq, href, url, path, filename, mirror_path, string, level of the pages'
    anchors, by the tree, whose href matches, and whose only text does (an anchor with markup in it has none). first: the
    first one of each page. base: what links are resolved against and said to come from, the page's url by default."""
    return linked([(pages, Rule(level, href, text, first, base))], url_col, html_col)


# fixed values: which anchors make up the levels of each journal: of href, of text, and whether only the first counts
HARVEST = {
    "mmwr": {"home": (r"about.html", None, True), "series": (None, r"Past Volumes", False), "volume": (r"/(ind\w*\d{2,4}\w*\.html?)", None, False), "article": (r"(mmwrhtml|volumes)/(\w|-|/)+.html?", None, False)},
    "eid": {"home": (r"eid", r"EID Journal", True), "series": (None, r"Past Issues", False), "volume": (r"volume-\d{1,2}", r"Volume.+?\d{4}", False), "issue": (None, r"Table of Contents", False), "article": (r"_article$", None, False)},
    "pcd": {"home": (r"pcd/index.htm", r"Preventing Chronic Disease", True), "series": (r"archive", None, True), "volume": (r"\d{4}.*(TOC|toc).htm", None, False), "article": (r"((\d{2}_\d{4,5}([aber]|_es|_fr|_zhs|_zht)?)|cover).htm", None, False)},
}
# fixed values: a page of volumes doesn't link to itself; the first volume's link is on the second one's page
EID_VOLUMES = {"/past-issues/volume-1": r"Volume.+?\d{4}", "/past-issues/volume-2": r"Volume.+?1995"}
# fixed value: the page that links to itself as the Spanish archive
PCD_SPANISH = r"pcd/es/archive_es.htm"


def harvest(journal: str, pages: dict[str, DataFrame], volumes_base: str | None = None) -> DataFrame:
    """All link rows of a journal (D1-D5, D8). pages: by level, the (url, html) in which that level's anchors are looked
    for. The second journal's volumes are those of two pages, resolved against volumes_base."""
    found = []
    for level, (href, text, first) in HARVEST[journal].items():
        if level not in pages:
            continue
        if journal == "eid" and level == "volume":
            found += [(pages[level].where(F.col("url").endswith(end)), Rule(level, href, only, base=volumes_base)) for end, only in EID_VOLUMES.items()]
        elif journal == "pcd" and level == "series":
            spanish = F.col("url").endswith("/archive_es.htm")
            found += [(pages[level].where(~spanish), Rule(level, href, text, first)), (pages[level].where(spanish), Rule(level, PCD_SPANISH, first=True))]
        else:
            found.append((pages[level], Rule(level, href, text, first)))
    return linked(found)
