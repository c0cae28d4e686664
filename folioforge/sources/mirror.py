"""A mirror of pages: the data source `pages`, whose scan fetches and whose writer keeps a tree of files.

    queue(links, folder)                                   the pages to fetch, dealt over lanes by host
    spark.read.format("pages").option("links", folder)     a task a lane: raw bytes, bounded attempts, a bounded rate a host
    df.write.format("pages").mode("append").save(folder)   a file a page, all of a write or nothing
"""

from __future__ import annotations

import importlib
import json
import posixpath
import time
import urllib.request
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from folioforge.functions.text import fetched_text
from folioforge.functions.urls import host_of

SCHEMA = "url string, mirror_path string, content binary, length long, attempts int"
#: Bytes of content, and pages, of a batch that a scan gives, if no page is larger.
BATCH_BYTES, BATCH_PAGES = 4 << 20, 256


def fetch_url(url: str, timeout: float) -> bytes:
    """The bytes of a page; raises an error after any failure (A1, A2)."""
    with urllib.request.urlopen(url, timeout=timeout) as r:  # noqa: S310
        return r.read()


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder's URI, as workers reach it, and the path in it."""
    if uri.startswith(("/", "file:")):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)


def below(root: str, path: str) -> str:
    """The file of a mirror path; raises an error for paths that lead out of the root."""
    kept = posixpath.normpath("/" + path.replace("\\", "/"))
    if kept == "/" or ".." in path.replace("\\", "/").split("/"):
        raise ValueError(f"not a path of a mirror: {path!r}")
    return root.rstrip("/") + kept


def named(function: str) -> Callable[[str, float], bytes]:
    """The function `module:name`."""
    module, _, name = function.partition(":")
    return getattr(importlib.import_module(module), name)


@dataclass
class Lane(InputPartition):
    files: list[str]


class _Pace:
    """Requests of a host no closer than its interval: a host that several lanes share has as many times the interval in each."""

    def __init__(self, rate: float):
        self.rate, self.due = rate, {}

    def wait(self, host: str, lanes: int) -> None:
        if self.rate > 0:
            now = time.monotonic()
            at = max(now, self.due.get(host, now))
            self.due[host] = at + lanes / self.rate
            if at > now:
                time.sleep(at - now)


class PageReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = dict(options)
        if "links" not in self.options:
            raise ValueError("option links: the folder that queue() wrote")

    def partitions(self) -> list[Lane]:
        where, path = filesystem(self.options["links"])
        lanes: dict[str, list[str]] = {}
        for f in where.get_file_info(fs.FileSelector(path, recursive=True)):
            if f.is_file and f.base_name.endswith(".parquet"):
                lanes.setdefault(posixpath.dirname(f.path), []).append(f.path)
        return [Lane(sorted(files)) for _, files in sorted(lanes.items())] or [Lane([])]

    def read(self, lane: Lane) -> Iterator[pa.RecordBatch]:
        o = self.options
        fetch, root = named(o.get("fetch", "folioforge.sources.mirror:fetch_url")), o.get("root", "")
        attempts, timeout, again = int(o.get("attempts", 2)), float(o.get("timeout", 5)), float(o.get("again", 0))
        store = filesystem(root) if root else None
        pace, rows, held = _Pace(float(o.get("rate", 0))), [], 0
        where = filesystem(o["links"])[0]

        def got(url: str, path: str, host: str, lanes: int) -> tuple[bytes, int]:
            """The content, empty after the last failure, and the attempts it took."""
            for k in range(1, attempts + 1):
                pace.wait(host, lanes)
                try:
                    if store:
                        with store[0].open_input_stream(below(store[1], path)) as f:
                            content = f.read()
                    else:
                        content = fetch(url, timeout)
                except Exception:  # any failure of a page counts as an empty answer
                    content = b""
                if content:
                    return content, k
                if k < attempts and again > 0:
                    time.sleep(again)
            return b"", attempts

        for file in lane.files:
            with where.open_input_file(file) as f:
                for batch in pq.ParquetFile(f).iter_batches(1024, columns=["url", "mirror_path", "host", "lanes"]):
                    for url, path, host, lanes in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                        content, k = got(url, path, host, lanes)
                        rows.append((url, path, content, len(content), k))
                        held += len(content)
                        if held >= BATCH_BYTES or len(rows) >= BATCH_PAGES:
                            yield _batch(rows)
                            rows, held = [], 0
        if rows:
            yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], ["url", "mirror_path", "content", "length", "attempts"])


@dataclass
class Kept(WriterCommitMessage):
    files: int
    size: int


class PageWriter(DataSourceArrowWriter):
    """A file a page in a folder that isn't seen until all tasks are done: it gets its name by one rename, or goes."""

    def __init__(self, options: dict, overwrite: bool):
        self.root, self.overwrite = options["path"].rstrip("/"), overwrite
        self.version = f"v={time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        where, staged = filesystem(self.staged)
        where.create_dir(staged, recursive=True)  # by the driver, before there are tasks

    @property
    def staged(self) -> str:
        return f"{self.root}/_staged-{self.version}"

    def write(self, batches: Iterator[pa.RecordBatch]) -> Kept:
        where, root = filesystem(self.staged)
        files = size = 0
        made = {root}
        for batch in batches:
            for path, content in zip(batch.column("mirror_path"), batch.column("content"), strict=True):
                file = below(root, path.as_py())
                raw = content.as_buffer() if content.is_valid else b""
                if not len(raw):
                    continue
                missing, folder = [], posixpath.dirname(file)
                while folder not in made:
                    missing.append(folder)
                    folder = posixpath.dirname(folder)
                for folder in reversed(missing):  # one by one: where the write was given up, the first one fails
                    where.create_dir(folder, recursive=False)
                    made.add(folder)
                with where.open_output_stream(file) as f:  # an earlier attempt's file is written anew
                    f.write(raw)
                files, size = files + 1, size + len(raw)
        return Kept(files, size)

    def commit(self, messages: list[Kept | None]) -> None:
        where, staged = filesystem(self.staged)
        root = filesystem(self.root)[1]
        with where.open_output_stream(f"{staged}/_written") as f:
            f.write(json.dumps({"files": sum(m.files for m in messages if m), "bytes": sum(m.size for m in messages if m)}).encode())
        where.move(staged, f"{root}/{self.version}")
        if self.overwrite:
            for old in versions(self.root)[:-1]:
                where.delete_dir(f"{root}/{old}")

    def abort(self, messages: list[Kept | None]) -> None:
        """The folder is renamed before it goes, so that tasks that still run find it gone."""
        where, staged = filesystem(self.staged)
        where.move(staged, f"{staged}-gone")
        where.delete_dir(f"{staged}-gone")


class PagesSource(DataSource):
    """Reads: links (a folder written by queue), fetch (`module:function` of url and timeout), or root (a mirror's folder to
    read from instead of the web), attempts (2), timeout (5 s), again (0 s between attempts), rate (requests a second and host;
    0: no bound). Writes: mirror_path and content of the rows, below path; columns by those names, others are ignored. Rows
    without content, failed downloads among them, leave no file; of rows that share a path one stays."""

    @classmethod
    def name(cls) -> str:
        return "pages"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> PageReader:
        return PageReader(self.options)

    def writer(self, schema, overwrite: bool) -> PageWriter:
        if "path" not in self.options:
            raise ValueError("save(path): the mirror's folder")
        return PageWriter(dict(self.options), overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(PagesSource)


def versions(folder: str) -> list[str]:
    """The writes that were committed to a mirror, oldest first."""
    where, root = filesystem(folder)
    found = where.get_file_info(fs.FileSelector(root, allow_not_found=True))
    return sorted(f.base_name for f in found if f.type == fs.FileType.Directory and f.base_name.startswith("v="))


def queue(links: DataFrame, folder: str, lanes: int = 64, mode: str = "errorifexists") -> None:
    """Write links (url, mirror_path) to fetch, each path once, dealt over `lanes` by host: a host's pages go to one lane,
    those of a host with more than one lane's share to as many as its share needs. Rows without a url or a path are dropped.
    Lanes are in no order of hosts, so that waiting for one host seldom holds up another."""
    spark, every = links.sparkSession, f"{folder.rstrip('/')}-all"
    todo = links.where("url is not null and mirror_path is not null").groupBy("mirror_path").agg(F.min("url").alias("url")).withColumn("host", host_of(F.col("url")))
    todo.write.mode(mode).parquet(every)  # what links is made from is computed once
    todo = spark.read.schema("mirror_path string, url string, host string").parquet(every)
    least = max(1, -(-todo.count() // lanes))
    hosts = todo.groupBy("host").agg(F.count("*").alias("n"))
    large = hosts.where(F.col("n") > least).select("host", F.ceil(F.col("n") / least).cast("int").alias("lanes"))  # fewer than `lanes`
    h = F.xxhash64("url")
    dealt = todo.join(F.broadcast(large), "host", "left").withColumn("lanes", F.coalesce("lanes", F.lit(1)))
    dealt = dealt.withColumn("lane", F.pmod(F.xxhash64("host") + F.pmod(h, F.col("lanes")), F.lit(lanes)).cast("int"))
    dealt.repartition(lanes, "lane").sortWithinPartitions("lane", F.xxhash64(h)).write.partitionBy("lane").mode(mode).parquet(folder)


def mirror(spark: SparkSession, links: DataFrame, folder: str, lanes: int = 64, **options) -> DataFrame:
    """(url, mirror_path, content, length, attempts) of links, fetched once into a table in `folder` and read from there: what
    was fetched isn't fetched again when executors are lost later. Pages that failed at every attempt are empty (B4)."""
    register(spark)
    queue(links, f"{folder}/links", lanes)
    scan = spark.read.format("pages").options(links=f"{folder}/links", **options).load()
    scan.write.mode("errorifexists").parquet(f"{folder}/pages")
    return spark.read.schema(SCHEMA).parquet(f"{folder}/pages")


def fetched_pages(pages: DataFrame) -> DataFrame:
    """(url, mirror_path, html) of fetched pages: decoded, white space collapsed (A1, A2); empty after any failure."""
    return pages.select("url", "mirror_path", fetched_text("content").alias("html"))


def tree(spark: SparkSession, folder: str) -> DataFrame:
    """(mirror_path, content, length) of a mirror's files, the last write's where several have a path (A3, A5)."""
    kept = versions(folder)
    if not kept:
        return spark.createDataFrame([], "mirror_path string, content binary, length long")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load([f"{folder}/{v}" for v in kept])
    rows = files.select(F.regexp_extract("path", r"/(v=\d{20}-[0-9a-f]{8})(/.*)$", 1).alias("v"), F.regexp_extract("path", r"/(v=\d{20}-[0-9a-f]{8})(/.*)$", 2).alias("mirror_path"), "content", "length")
    if len(kept) > 1:
        last = rows.groupBy("mirror_path").agg(F.max("v").alias("v"))
        rows = rows.join(last, ["mirror_path", "v"], "left_semi")
    return rows.where(~F.col("mirror_path").rlike("/_written$")).select("mirror_path", "content", "length")
