"""Table functions for SQL: rows of a document's anchors, head tags and metas. For lateral joins, a page at a time:

    select p.id, a.* from pages p, lateral html_anchors(p.html, p.url) a

and for whole tables (page, html), a batch of pages at a time, partitioned as the call says, with the page of each row:

    select * from anchors_of(table(select url as page, html from pages))
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.functions import arrow_udtf, udtf
from pyspark.sql.types import IntegerType, MapType, StringType, StructField, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from folioforge.functions import urls as U
from folioforge.operators import html_kernel as K

_TEXT = StringType()
ANCHORS = [("seq", IntegerType()), ("href", _TEXT), ("url", _TEXT), ("string", _TEXT)]
TAGS = [("seq", IntegerType()), ("tag_name", _TEXT), ("tag_str", _TEXT), ("n_attr", IntegerType()), ("tag_attr", MapType(_TEXT, _TEXT))]
METAS = [("seq", IntegerType()), ("name", _TEXT), ("content", _TEXT)]


def anchor_rows(html: str | None, base: str | None) -> Iterator[tuple]:
    """Of each anchor its place, href, what that is resolved to against the base (null without one, or without an href), and text."""
    for k, (href, string, _) in enumerate(K.anchors(K.parse(html))):
        yield k, href, (U.resolve(base, href, "") or {}).get("url") if base else None, string


def tag_rows(html: str | None, base: str | None = None) -> Iterator[tuple]:
    for k, (name, string, attrs) in enumerate(K.tags(K.parse_head(html))):
        yield k, name, string, len(attrs), attrs


def meta_rows(html: str | None, base: str | None = None) -> Iterator[tuple]:
    for k, (name, content) in enumerate(K.head_meta(K.parse_head(html))[2]):
        yield k, name, content


def _checked(name: str, *arguments: AnalyzeArgument) -> None:
    for a in arguments:
        if a.isTable or not isinstance(a.dataType, StringType):
            raise ValueError(f"{name}: texts are needed, a page's html{' and its url' if name == 'html_anchors' else ''}")


class HtmlAnchors:
    @staticmethod
    def analyze(html: AnalyzeArgument, base: AnalyzeArgument | None = None) -> AnalyzeResult:
        _checked("html_anchors", html, *([base] if base else []))
        return AnalyzeResult(StructType([StructField(*f) for f in ANCHORS]))

    def eval(self, html: str, base: str | None = None):
        yield from anchor_rows(html, base)


class HtmlTags:
    @staticmethod
    def analyze(html: AnalyzeArgument) -> AnalyzeResult:
        _checked("html_tags", html)
        return AnalyzeResult(StructType([StructField(*f) for f in TAGS]))

    def eval(self, html: str):
        yield from tag_rows(html)


class HtmlMetas:
    @staticmethod
    def analyze(html: AnalyzeArgument) -> AnalyzeResult:
        _checked("html_metas", html)
        return AnalyzeResult(StructType([StructField(*f) for f in METAS]))

    def eval(self, html: str):
        yield from meta_rows(html)


def _of_table(rows_of, fields: list[tuple]):
    """A table function over a table with the columns page, which tells pages apart and is what anchors are resolved against, and html."""

    class OfTable:
        def eval(self, batch: pa.RecordBatch) -> Iterator[pa.Table]:
            names = batch.schema.names
            if not {"page", "html"} <= {*names}:
                raise ValueError("a table with the columns page and html is needed")
            page = batch.column(names.index("page")).cast(pa.string()).to_pylist()
            found = [(p, *row) for p, h in zip(page, batch.column(names.index("html")).to_pylist(), strict=True) for row in rows_of(h, p)]
            columns = zip(*found, strict=True) if found else [[] for _ in range(len(fields) + 1)]
            yield pa.table({n: pa.array([[*x.items()] for x in c] if isinstance(t, MapType) else c, _arrow(t)) for (n, t), c in zip([("page", _TEXT), *fields], columns, strict=True)})

    return OfTable, StructType([StructField("page", _TEXT), *(StructField(*f) for f in fields)])


def _arrow(t) -> pa.DataType:
    return pa.int32() if isinstance(t, IntegerType) else pa.map_(pa.string(), pa.string()) if isinstance(t, MapType) else pa.string()


LATERAL = {"html_anchors": HtmlAnchors, "html_tags": HtmlTags, "html_metas": HtmlMetas}
OF_TABLES = {"anchors_of": _of_table(anchor_rows, ANCHORS), "tags_of": _of_table(tag_rows, TAGS), "metas_of": _of_table(meta_rows, METAS)}


def register(spark: SparkSession) -> None:
    """Make html_anchors(html, base), html_tags(html) and html_metas(html), and anchors_of, tags_of and metas_of(table), known to the session's SQL."""
    for name, cls in LATERAL.items():
        spark.udtf.register(name, udtf(cls, useArrow=True))
    for name, (cls, schema) in OF_TABLES.items():
        spark.udtf.register(name, arrow_udtf(cls, returnType=schema))
