"""Continuous ingestion of mirrored pages: the stateless part of the document pipeline, over tables as they arrive, and raw files
of a mirror, of which each path counts once.

An extension: the batch rules hold on streams.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from folioforge.functions import text as T
from folioforge.functions import urls as U
from folioforge.operators import documents as P

PAGES = "page_id long, url string, html string"
FILES = "path string, modificationTime timestamp, length long, content binary"


def arriving(spark: SparkSession, folder: str, files_a_batch: int = 100) -> DataFrame:
    """Parquet files of (page_id, url, html) that appear in a folder."""
    return spark.readStream.schema(PAGES).option("maxFilesPerTrigger", files_a_batch).parquet(folder)


def cleaned(pages: DataFrame) -> DataFrame:
    """url, paths, title, text and Markdown, with entities and white space put right by the batch rules, which spare <pre>
    in the weeklies' pages only: works on streams and on tables."""
    path = U.path_of(F.col("url"))
    html = T.cleaned(F.col("html"), keep_pre=path.startswith("/mmwr/"))
    return pages.select("page_id", U.canonical(F.col("url")).alias("url"), U.mirror_path(path).alias("mirror_path"), P.parse_document(html, "title", "text", "md").alias("p")).select("page_id", "url", "mirror_path", "p.title", "p.text", "p.md")


def ingest(spark: SparkSession, folder: str, out: str, checkpoint: str) -> StreamingQuery:
    """Clean all files that are there, and stop; run again for what came since. Each file is written once."""
    return cleaned(arriving(spark, folder)).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def arrived_files(spark: SparkSession, folder: str, files_a_batch: int = 100) -> DataFrame:
    """Raw files of a mirror as they appear, each write of it in a folder of its own (v=...): mirror_path below that folder,
    the file's time, and its text by the declared character set."""
    files = spark.readStream.format("binaryFile").schema(FILES).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", files_a_batch).load(folder)
    path = F.regexp_extract("path", r"/v=[^/]*(/.*)$", 1)
    return files.where(path.rlike("/[^/_.][^/]*$")).select(path.alias("mirror_path"), "modificationTime", "length", T.decode_declared("content").alias("html"))


def first_arrivals(files: DataFrame, within: str = "7 days") -> DataFrame:
    """Of files with the same path only the first one that arrived. State holds a path until a file has come whose time is later
    by more than twice `within`: a path that comes again after that is taken as new, which is what bounds the state."""
    return files.withWatermark("modificationTime", within).dropDuplicatesWithinWatermark(["mirror_path"])


def ingest_files(spark: SparkSession, folder: str, out: str, checkpoint: str, within: str = "7 days", files_a_batch: int = 100) -> StreamingQuery:
    """Write (mirror_path, length, title, text, md) of all files that are there, each path once, and stop; run again for what came
    since: what was seen is known after a restart."""
    rows = first_arrivals(arrived_files(spark, folder, files_a_batch), within)
    made = rows.select("mirror_path", "length", P.parse_document(T.cleaned(F.col("html"), keep_pre=F.col("mirror_path").startswith("/mmwr/")), "title", "text", "md").alias("p"))
    return made.select("mirror_path", "length", "p.title", "p.text", "p.md").writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
