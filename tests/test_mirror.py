"""The data source of pages, crawls, and rows not seen before."""

import os
import threading
import time
from collections import Counter
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark.sql import functions as F

from folioforge.operators import crawl
from folioforge.operators import relational as R
from folioforge.sources import mirror


def asked(url: str, timeout: float) -> bytes:
    """Answers of a folder that the host names; each request leaves a byte in the log beside it."""
    folder, name = url.removeprefix("https://h").split("!")
    log = f"{folder}/{name}.log"
    again = os.path.exists(log)
    with open(log, "a") as f:
        f.write("x")
    if name == "never" or (name == "later" and not again):
        raise OSError(name)
    return name.encode()


def test_fetching_again(spark, tmp_path):
    """What failed is fetched again, and only that; each path has one row; rows without a url have none."""
    names = [("now", "/a"), ("later", "/b"), ("never", "/c"), ("now", "/a"), (None, "/d"), ("now", None)]
    links = spark.createDataFrame([(n and f"https://h{tmp_path}!{n}", p) for n, p in names], "url string, mirror_path string").withColumn("length", F.lit("clash"))
    got = mirror.mirror(spark, links, f"{tmp_path}/out", lanes=3, fetch="tests.test_mirror:asked", attempts=3)
    for _ in range(2):  # read twice, fetched once
        assert sorted((r.mirror_path, r.content.decode(), r.length, r.attempts) for r in got.collect()) == [("/a", "now", 3, 1), ("/b", "later", 5, 2), ("/c", "", 0, 3)]
    assert {f.name: len(f.read_text()) for f in tmp_path.glob("*.log")} == {"now.log": 1, "later.log": 2, "never.log": 3}
    empty = mirror.mirror(spark, links.limit(0), f"{tmp_path}/none")
    assert empty.count() == mirror.fetched_pages(empty).count() == 0


def test_a_server(spark, tmp_path):
    """Statuses and slow answers count as failures (A2); requests to a host keep their distance, over all its lanes."""
    times = []

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            times.append(time.time())
            if self.path == "/slow":
                time.sleep(3)
            self.send_response(404 if self.path == "/gone" else 200)
            self.end_headers()
            self.wfile.write(f"at \n {self.path}".encode())

        def log_message(self, *args):
            pass

    server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        links = spark.createDataFrame([(f"http://127.0.0.1:{server.server_port}/{k}", f"/{k}") for k in ["slow", "gone", *range(8)]], "url string, mirror_path string")
        got = mirror.mirror(spark, links, f"{tmp_path}/out", lanes=2, attempts=1, timeout=0.5, rate=10)
        html = {r.mirror_path: r.html for r in mirror.fetched_pages(got).collect()}
        assert html == {"/slow": "", "/gone": "", **{f"/{k}": f"at /{k}" for k in range(8)}}
        assert len(times) == 10 and max(times) - min(times) > 0.35  # 5 in each of two lanes, 0.2 s apart, at the same time
    finally:
        server.shutdown()


def test_lanes(spark, tmp_path):
    """A host with most of the pages gets many lanes, the others one each; no page is lost or queued twice."""
    rows = [("https://big.org/" + str(k), f"/b{k}") for k in range(300)] + [(f"https://s{k % 30}.org/{k}", f"/s{k}") for k in range(90)]
    mirror.queue(spark.createDataFrame(rows + rows[:50], "url string, mirror_path string"), f"{tmp_path}/q", lanes=10)
    got = spark.read.parquet(f"{tmp_path}/q").collect()
    assert sorted((r.url, r.mirror_path) for r in got) == sorted(rows)
    assert len({r.lane for r in got if r.host == "big.org"}) > 4 and {r.lanes for r in got if r.host == "big.org"} == {8}
    assert all(len({r.lane for r in got if r.host == f"s{k}.org"}) == 1 for k in range(30))
    assert Counter(r.lane for r in got if r.host == "big.org").most_common(1)[0][1] < 100


def files(spark, rows):
    return spark.createDataFrame(rows, "mirror_path string, content binary")


def test_a_tree_of_files(spark, tmp_path):
    mirror.register(spark)
    at = f"{tmp_path}/tree"
    assert mirror.tree(spark, at).count() == 0
    files(spark, [("/a/b.html", b"1"), ("a\\c.html", b"2"), ("/e", None), ("/ü é.html", b"3")]).write.format("pages").mode("append").save(at)
    files(spark, [("/a/b.html", b"new")]).write.format("pages").mode("append").save(at)
    assert {r.mirror_path: bytes(r.content) for r in mirror.tree(spark, at).where("mirror_path not like '%é%'").collect()} == {"/a/b.html": b"new", "/a/c.html": b"2"}
    assert (tmp_path / "tree" / mirror.versions(at)[0] / "ü é.html").read_bytes() == b"3"
    files(spark, [("/z", b"z")]).write.format("pages").mode("overwrite").save(at)
    assert [(r.mirror_path, bytes(r.content)) for r in mirror.tree(spark, at).collect()] == [("/z", b"z")] and len(mirror.versions(at)) == 1


def test_a_failed_write_leaves_nothing(spark, tmp_path):
    mirror.register(spark)
    at = f"{tmp_path}/tree"
    files(spark, [("/kept", b"k")]).write.format("pages").mode("append").save(at)
    many = files(spark, [(f"/{k}", b"x") for k in range(40)]).repartition(8)
    for bad in (many.unionByName(files(spark, [("/a/../../out", b"!")])), many.withColumn("content", F.when(F.col("mirror_path") == "/7", F.raise_error(F.lit("lost")).cast("binary")).otherwise(F.col("content")))):
        with pytest.raises(Exception, match="lost|not a path"):
            bad.write.format("pages").mode("append").save(at)
        assert [r.mirror_path for r in mirror.tree(spark, at).collect()] == ["/kept"] and len(list((tmp_path / "tree").iterdir())) == 1
    assert not (tmp_path / "out").exists()


def test_unseen(spark, monkeypatch):
    rows = [(k % 700, f"k{k % 700}") for k in range(1000)] + [(1, None), (2, None)]
    df = spark.createDataFrame(rows, "n int, k string").withColumn("bits", F.lit(1))
    seen = spark.createDataFrame([(f"k{k}",) for k in range(0, 1400, 2)] * 2 + [(None,)], "k string")
    want = [(n, k) for n, k in rows if k is None or int(k[1:]) % 2]
    get = lambda s: sorted(((r.n, r.k) for r in R.unseen(df, s, "k").collect()), key=str)
    assert get(seen) == sorted(want, key=str)
    monkeypatch.setattr(R, "BLOOM_KEYS", 20)  # many blocks
    assert get(seen) == sorted(want, key=str)
    assert get(seen.limit(0)) == sorted(rows, key=str)
    monkeypatch.setattr(R, "BLOOM_BLOCKS", 1)  # a filter that is full holds everything
    big = spark.range(60_000).select(F.concat(F.lit("k"), (F.col("id") * 2).cast("string")).alias("k"))
    assert get(big) == sorted(want, key=str)


def test_the_filter_lets_new_rows_pass(spark):
    seen, new = (spark.range(a, a + 4000).select(F.col("id").cast("string").alias("k")) for a in (0, 10_000))
    kept = R.bloom_filter(seen, "k", 2)
    assert kept.count() == 2
    plan = R.unseen(new, seen, "k")._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


SITE = {
    "/pcd/index.htm": '<a href="/pcd/index.htm">Preventing Chronic Disease</a><a href="/pcd/issues/archive.htm">Issue Archive</a>',
    "/pcd/issues/archive.htm": '<a href="2011_toc.htm">2011</a><a href="/pcd/issues/2012_toc.htm">2012</a>',
    "/pcd/es/archive_es.htm": '<a href="/pcd/es/archive_es.htm">Archivo</a><a href="/pcd/issues/2011_toc.htm">2011</a>',
    "/pcd/issues/2011_toc.htm": '<a href="11_0001.htm">One</a><a href="11_0002.htm">Two</a><a href="none.htm">no</a>',
    "/pcd/issues/2012_toc.htm": '<a href="11_0002.htm">Two</a><a href="12_0003.htm">Gone</a>',
    "/pcd/issues/11_0001.htm": "<p>one",
    "/pcd/issues/11_0002.htm": "<p>two",
}


def served(url: str, timeout: float) -> bytes:
    path = url.removeprefix("https://p.org")
    log = f"{os.environ['FF_TEST_LOG']}/{path.replace('/', '_')}"
    with open(log, "a") as f:
        f.write("x")
    return SITE[path].encode()


def test_a_crawl_that_was_stopped_goes_on(spark, tmp_path):
    """No page is fetched twice but those that failed, by the first crawl or by the one that goes on."""
    spark.conf.set("spark.executorEnv.FF_TEST_LOG", str(tmp_path))
    os.environ["FF_TEST_LOG"] = str(tmp_path)
    name = f"{tmp_path}/served.py"
    with open(name, "w") as f:  # workers of the session don't have the driver's environment
        f.write(f"import os\nos.environ['FF_TEST_LOG'] = {str(tmp_path)!r}\nfrom tests.test_mirror import served\n")
    spark.sparkContext.addPyFile(name)
    new = lambda: crawl.Crawl(spark, "pcd", "https://p.org/pcd/index.htm", f"{tmp_path}/crawl", lanes=2, fetch="served:served", attempts=1)
    assert {r.level for r in new().run(levels=2).collect()} == {"home", "series"}
    found = new().run().collect()
    assert sorted((r.level, r.path.rsplit("/", 1)[1], r.length) for r in found) == sorted([
        ("home", "index.htm", len(SITE["/pcd/index.htm"])), ("series", "archive.htm", len(SITE["/pcd/issues/archive.htm"])), ("series", "archive_es.htm", len(SITE["/pcd/es/archive_es.htm"])),
        ("volume", "2011_toc.htm", len(SITE["/pcd/issues/2011_toc.htm"])), ("volume", "2011_toc.htm", len(SITE["/pcd/issues/2011_toc.htm"])), ("volume", "2012_toc.htm", len(SITE["/pcd/issues/2012_toc.htm"])),
        ("article", "11_0001.htm", 6), ("article", "11_0002.htm", 6), ("article", "11_0002.htm", 6), ("article", "12_0003.htm", 0),
    ])
    assert {f.name: len(f.read_text()) for f in tmp_path.glob("_pcd*")} == {p.replace("/", "_"): 1 for p in [*SITE, "/pcd/issues/12_0003.htm"]}
    assert len(new().run().collect()) == len(found)


def test_a_crawl_without_an_answer(spark, tmp_path):
    got = crawl.Crawl(spark, "eid", "https://e.org/eid/", f"{tmp_path}/crawl", lanes=1, root=str(tmp_path / "none"), attempts=1).run()
    assert got.count() == 0
