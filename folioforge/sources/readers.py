"""Tables from files: raw pages, JSON dictionaries, CSV, and zipped JSON."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

MIRROR_LIST = "series string, file_size int, compress_type string, compress_size int, compress_pct string, date_time timestamp, CRC string, filename string"


def raw_pages(spark: SparkSession, path: str, root: str = "") -> DataFrame:
    """(path, content BINARY) of all files below a folder (A3, A5); paths without the root in front."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return df.select(F.regexp_replace("path", f"^.*?{root}", "").alias("path"), "content", "length")


def text_pages(spark: SparkSession, path: str) -> DataFrame:
    """(path, html) of UTF-8 files, one row a file (A4)."""
    return spark.read.text(path, wholetext=True, recursiveFileLookup=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("html"))


def dictionary(spark: SparkSession, path: str) -> DataFrame:
    """(key, value) of a JSON object of strings."""
    return spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "map<string, string>")))


def mirror_list(spark: SparkSession, path: str) -> DataFrame:
    """The listing of a zipped mirror, with its percentages as numbers."""
    df = spark.read.csv(path, header=True, schema=MIRROR_LIST)
    return df.withColumn("compress_pct", F.regexp_replace("compress_pct", "%$", "").try_cast("double"))


def mirrored(spark: SparkSession, path: str, links: DataFrame, root: str = "") -> DataFrame:
    """(level, mirror_path, content, length) of the files of a mirror that links name, in the order of level and path (A5)."""
    from folioforge.operators.relational import LEVELS, domain_order

    wanted = links.select("mirror_path", "level").distinct()
    out = raw_pages(spark, path, root).withColumnRenamed("path", "mirror_path").join(wanted, "mirror_path")
    return out.select("level", "mirror_path", "content", "length").orderBy(domain_order(F.col("level"), LEVELS), "mirror_path")


def corpus_csv(spark: SparkSession, path: str, domains: bool = False) -> DataFrame:
    """The corpus table as it was exported; empty fields are empty strings (A9). domains: its columns carry their ordered
    domains, those that it was written with or else the corpus', and values that a domain lacks are null, as ordered
    categories make them (L8, J12): R.sort_by and R.outside_domains need no list."""
    from folioforge.operators import relational as R

    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_schema.json")
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    kept = None
    if fs.exists(p):
        stream = fs.open(p)
        try:
            kept = StructType.fromJson(json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
        finally:
            stream.close()
    names = kept.names if kept else R.CORPUS
    df = spark.read.csv(path, header=True, schema=", ".join(f"`{c}` string" for c in names), quote='"', escape='"', multiLine=True).na.fill("")
    if domains:
        known = {f.name: list(f.metadata["domain"]) for f in kept or [] if f.metadata.get("domain")} or {c: d for c, d in R.DOMAINS.items() if c in names}
        df = R.with_domains(df.withColumns({c: F.when(F.col(c).isin(d), F.col(c)) for c, d in known.items()}), known)
    return df


def records(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON records, one a line."""
    return spark.read.schema(schema).json(path)


def checkpoint(spark: SparkSession, path: str) -> DataFrame:
    """A stage's table."""
    return spark.read.parquet(path)


def bundles(spark: SparkSession, path: str) -> DataFrame:
    """(collection, url, content) of bundles written by writers.bundle_objects: an object of bounded size a line."""
    lines = spark.read.schema("json string, collection string").text(path)
    return lines.select("collection", F.explode(F.from_json("json", "map<string, string>")).alias("url", "content"))


def renditions(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """(url, and a column a rendition) of the bundles of several renditions, a folder each, merged by url (A10). Of a url that
    occurs in several members the last one by name counts."""
    from folioforge.sources.exports import read_bundles

    out = None
    for name, path in paths.items():
        last = F.max_by("content", F.struct("member", "place")).alias(name)
        one = read_bundles(spark, path).groupBy("url").agg(last)
        out = one if out is None else out.join(one, "url", "full")
    return out


def sheets(spark: SparkSession, path: str, sheet: str, schema: str) -> DataFrame:
    """The tables that writers.sheets wrote, with the sheet's name as its last column."""
    return spark.read.csv(path, header=True, schema=f"{schema}, {sheet} string", quote='"', escape='"', multiLine=True, nullValue="\\N")
