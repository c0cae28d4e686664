"""URL and path algebra as Column expressions; full RFC 3986 resolution as an Arrow-batched function."""

from __future__ import annotations

import functools
import posixpath
import re
from urllib.parse import urljoin, urlsplit

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from folioforge.functions import arrow_function

LINK = "base string, href string, url string, path string, filename string, mirror_path string, string string"


#: A name with an extension: a dot after something that isn't one.
EXTENSION = r"^\.*[^.].*\."


def canonical(url: Column) -> Column:
    """https, without parameters, query and fragment (C1, for absolute URLs)."""
    return F.regexp_replace(F.regexp_replace(url, r"^[a-zA-Z]+://", "https://"), r"[?#;].*$", "")


def path_of(url: Column) -> Column:
    return F.regexp_extract(canonical(url), r"^https://[^/]*(.*)$", 1)


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[a-zA-Z]+://([^/?#]*)", 1))


def filename_of(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def dirname_of(path: Column) -> Column:
    """The folder of a path, without the last slash but for the root (B2)."""
    d = F.regexp_extract(path, r"^(.*)/[^/]*$", 1)
    return F.when(d == "", "/").otherwise(d)


def mirror_path(path: Column) -> Column:
    """Where a page is kept: index.html for a folder, .html after a name without an extension (C2), slashes forward."""
    path = F.translate(path, "\\", "/")
    name = filename_of(path)
    return F.when(name == "", F.concat(path, F.lit("index.html"))).when(~name.rlike(EXTENSION), F.concat(path, F.lit(".html"))).otherwise(path)


def resolve_native(base: Column, href: Column) -> Column:
    """Canonical URL of absolute, scheme-relative and root-relative links; null where resolve_links is needed (C1, fast path)."""
    root = F.concat(F.lit("https://"), host_of(base))
    return (
        F.when(href.rlike(r"^[a-zA-Z]+://"), canonical(href))
        .when(href.startswith("//"), canonical(F.concat(F.lit("https:"), href)))
        .when(href.startswith("/"), F.regexp_replace(F.concat(root, href), r"[?#;].*$", ""))
        .when(href.startswith("#") | (href == ""), canonical(base))
    )


# fixed values: a name that doesn't begin with a dot; a page and a link of such names, for which the page's folder and the link put together are resolved
_NAME = r"[\w~%+,=-][\w.~%+,=-]*+"
_PAGE = re.compile(rf"https?://([A-Za-z0-9.-]+)(/(?:{_NAME}/)*+)(?:{_NAME})?+(?:[?#][!-~]*+)?", re.A)
_LINK = re.compile(rf"(/|(?:\.\./)*+)((?:{_NAME}/)*+(?:{_NAME})?+)(?:[?#][!-~]*+)?", re.A)


@functools.lru_cache(1024)
def _folder(base: str | None) -> tuple[str, str] | None:
    """Host and folder of a page of plain names."""
    m = _PAGE.fullmatch(base or "")
    return m and m.groups()


def located(base: str | None, href: str) -> tuple[str, str, str, str]:
    """url, path, filename and mirror_path of a link. The scheme is forced, whatever it was."""
    page, link = _folder(base), _LINK.fullmatch(href)
    if page and link and (link[1] or link[2]):
        up, rest = link.groups()
        folder = "/" if up == "/" else page[1]
        for _ in range(len(up) // 3):
            folder = folder[: folder.rfind("/", 0, -1) + 1] or "/"
        path = folder + rest
        url, name = f"https://{page[0]}{path}", path[path.rfind("/") + 1 :]
        return url, path, name, path + "index.html" if not name else path if "." in name else path + ".html"
    parts = urlsplit(urljoin(base, href))
    path = parts.path.split(";")[0] if ";" in parts.path.rsplit("/", 1)[-1] else parts.path
    url = f"https://{parts.netloc}{path}" if parts.netloc else f"https:{path}"
    name = posixpath.basename(path)
    return url, path, name, path + "index.html" if not name else path if posixpath.splitext(name)[1] else path + ".html"


def resolve(base: str, href: str | None, text: str) -> dict | None:
    """One link row; None without a href."""
    if href is None:
        return None
    url, path, name, kept = located(base, href)
    return {"base": base, "href": href, "url": url, "path": path, "filename": name, "mirror_path": kept, "string": text}


@arrow_function(LINK, F.arrow_udf)
def resolve_links(base: pa.Array, href: pa.Array, text: pa.Array) -> pa.Array:
    found = [(None,) * 4 if h is None else located(b, h) for b, h in zip(base.to_pylist(), href.to_pylist(), strict=True)]
    made = [pa.array(c, pa.string()) for c in (zip(*found, strict=True) if found else [()] * 4)]
    if href.null_count:
        base, text = (pc.if_else(href.is_valid(), x, pa.scalar(None, pa.string())) for x in (base, text))
    return pa.StructArray.from_arrays([base, href, *made, text], [x.split()[0] for x in LINK.split(", ")])


def spanish(column: Column, base: Column, url: Column) -> Column:
    """.htm to _es.htm on Spanish pages that lack it."""
    return F.when(base.contains("/es/") & ~url.contains("_es.htm"), F.replace(column, F.lit(".htm"), F.lit("_es.htm"))).otherwise(column)


def translation(path: Column) -> tuple[Column, Column]:
    """Language suffix and the English page's path (C6); null for English pages."""
    pattern = r"(.*?)_(es|fr|zhs|zht)\.htm"
    stem, lang = F.regexp_extract(path, pattern, 1), F.regexp_extract(path, pattern, 2)
    return F.nullif(lang, F.lit("")), F.when(lang != "", F.concat(stem, F.lit(".htm")))


def shape(path: Column) -> Column:
    """Months to MMM and digits to #."""
    return F.regexp_replace(F.regexp_replace(path, "jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec", "MMM"), r"\d", "#")
