import os
import time

from folioforge.streaming import pages


def test_stream_gives_what_the_batch_gives(spark, tmp_path):
    table = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "url", "html")
    source, out, mark = (f"{tmp_path}/{x}" for x in ("in", "out", "mark"))
    table.where("page_id % 2 = 0").coalesce(1).write.parquet(source)
    for half in (None, "page_id % 2 = 1"):
        if half:
            table.where(half).coalesce(1).write.mode("append").parquet(source)
        pages.ingest(spark, source, out, mark).awaitTermination()
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == sorted(map(tuple, pages.cleaned(table).collect()))


def test_a_path_that_comes_twice_counts_once(spark, tmp_path):
    """In one batch, in a later one, and after a restart; a path that comes again long after is new."""
    def put(version: str, path: str, text: str, age: float = 0) -> None:
        file = tmp_path / "in" / f"v={version}" / path
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_bytes(f"<head><title>{text}</title></head><body><p>é {text}</p></body>".encode("cp1252"))
        os.utime(file, (time.time() - age, time.time() - age))

    def run() -> list:
        pages.ingest_files(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/mark", within="1 hour", files_a_batch=2).awaitTermination()
        return sorted((r.mirror_path, r.title, r.text) for r in spark.read.parquet(f"{tmp_path}/out").collect())

    put("1", "a/x.html", "one", age=20_000)
    put("1", "a/y.html", "two", age=20_000)
    (tmp_path / "in" / "v=1" / "_written").write_text("{}")
    assert run() == [("/a/x.html", "one", "é one"), ("/a/y.html", "two", "é two")]
    put("2", "a/x.html", "again", age=19_000)
    put("2", "z.html", "three", age=19_000)
    want = [("/a/x.html", "one", "é one"), ("/a/y.html", "two", "é two"), ("/z.html", "three", "é three")]
    assert run() == want
    assert run() == want  # nothing new
    put("3", "new.html", "later")  # the files' time goes on: what was seen two hours ago may go
    assert ("/new.html", "later", "é later") in run()
    put("4", "z.html", "much later")
    assert ("/z.html", "much later", "é much later") in run()
