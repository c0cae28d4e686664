"""Queries with SQL on rows that the driver's small tables lack."""

import json

import duckdb
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from folioforge import registry
from folioforge.operators import documents as P
from folioforge.operators import relational as R
from folioforge.sources import writers
from tests.test_oracle import rows

QUERIES, SQL = registry.queries(), registry.oracle_sql()


def same(spark, tmp_path, name, **tables):
    con = duckdb.connect()
    for t, df in tables.items():
        at = f"{tmp_path}/{t}.parquet"
        df.to_parquet(at, coerce_timestamps="us")
        con.sql(f"create view {t} as select * from '{at}'")
    got = rows(QUERIES[name](spark, str(tmp_path)).toPandas())
    assert got == rows(con.sql(SQL[name]).df())
    return got


#: Titles that are cut inside a reference, and references that SQL leaves alone.
TITLES = ["a&amp;&amp;&amp", "a&amp;&am", "k = &quot;1&quot;", "&lt;b&gt; &copy", "&amp;quot; &eacute; &#233;", "a & b&&amp;c", "&AMP; &amp;amp;"]


@pytest.fixture
def cut_pages():
    html = "<!DOCTYPE html><html lang=\"en\"><head><meta charset=\"utf-8\"><title>{0}</title></head><body><p>{0} &middot; &copy;</p></body></html>"
    return pd.DataFrame([(k, f"https://h.org/{k}", html.format(t)) for k, t in enumerate(TITLES)], columns=["page_id", "url", "html"])


def test_references_cut_short_stay(spark, tmp_path, cut_pages):
    got = same(spark, tmp_path, "entity_repair", pages=cut_pages)
    assert any("<title>a&&&amp</title>" in html for html, _ in got)


def test_titles_cut_short_stay(spark, tmp_path, cut_pages):
    same(spark, tmp_path, "head_meta", pages=cut_pages)


def test_tasks_do_not_grow_with_the_table(spark, tmp_path, monkeypatch):
    """A file of many short rows, as the orders', is dealt over tasks of a bounded number of rows; small ones over the cores."""
    spark.range(1000).coalesce(1).write.parquet(f"{tmp_path}/t")
    t = spark.read.parquet(f"{tmp_path}/t")
    monkeypatch.setattr(R, "TASK_ROWS", 50)
    assert R.spread(t).rdd.getNumPartitions() == 20 and R.spread(t).count() == 1000
    monkeypatch.setattr(R, "TASK_ROWS", 5000)
    assert R.spread(t).rdd.getNumPartitions() == 4


def batches(spark, df):
    """The most rows that Python is given at once."""

    def sizes(it):
        for b in it:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], ["n"])

    return df.mapInArrow(sizes, "n long").agg(F.max("n")).first()[0]


def test_batches_of_markup_are_small(spark):
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    rows = spark.range(0, 3000, 1, 1).selectExpr("id", "'<p>x' as html")
    assert batches(spark, rows) == 3000
    P.svg_lengths("html")
    assert batches(spark, rows) <= 256


def test_bundles_are_escaped_row_by_row(spark, tmp_path):
    """Whole objects, of many texts each, don't come to Python; a url that occurs twice is an error as before."""
    docs = spark.createDataFrame([("c", f"u{k}", None if k == 3 else f'é😀"\\{k}\n') for k in range(20)], "collection string, url string, html string")
    writers.bundle_objects(docs, "html", f"{tmp_path}/a", ascii_only=True)
    lines = [r.value for r in spark.read.text(f"{tmp_path}/a").select("value").collect()]
    assert len(lines) == 1 and lines[0].isascii() and json.loads(lines[0]) == {r.url: r.html for r in docs.collect()}
    with pytest.raises(Exception, match="twice"):
        writers.bundle_objects(docs.unionAll(docs), "html", f"{tmp_path}/b", ascii_only=True)


def test_dateline_parts_asked_for():
    """Parts are those of all parts; what isn't asked for isn't made: no element is written to read its texts."""
    html = "<title>t</title><h1>Past Volumes (1)</h1><p>Volume <b>Volume 2</b><div class=dateline> d </div><table><tr><th>EID<td class=citationCell>c"
    title, volumes, div, citations, notes, texts = P._dateline_parts(html, tuple(P.DATELINE_PARTS))
    assert (title, volumes, div, citations) == ("t", "Past Volumes (1)", "d", {"EID": "c"})
    assert texts == [{"tag": n["tag"], "string": n["string"]} for n in notes] and len(texts) == 3
    for k, v in zip(P.DATELINE_PARTS, (title, volumes, div, citations, notes, texts), strict=True):
        assert P._dateline_parts(html, (k,)) == (v,)


def test_filter_holds_small_slices(spark):
    """Rows are scored in slices of a quarter of a megabyte of text, one row at least, and each is kept or not as before."""
    from folioforge.llm.common import filtered

    def make():
        return lambda data, offs: [len(data) <= max(1 << 18, int(max(offs[1:] - offs[:-1])))] * (len(offs) - 1)

    docs = spark.range(0, 40, 1, 1).selectExpr("id", "repeat('x', 50000) as text")
    assert filtered(docs, "text", make).count() == 40
