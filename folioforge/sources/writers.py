"""Exports: checkpoints, CSV, JSON records, and bundles a collection. Modes fail on existing output, as stages write once."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.functions import arrow_function


#: Collections whose sizes are sent to all tasks.
SEND_COLLECTIONS = 100_000


def checkpoint(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").parquet(path)


def corpus_csv(df: DataFrame, path: str) -> None:
    """All fields quoted, with a header (B8), and a file of the schema, with the columns' ordered domains, beside them."""
    df.write.option("quoteAll", True).option("escape", '"').option("emptyValue", "").mode("errorifexists").csv(path, header=True)
    spark = df.sparkSession
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_schema.json")
    out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, False)
    try:
        out.write(bytearray(df.schema.json().encode()))
    finally:
        out.close()


def records(df: DataFrame, path: str) -> None:
    """A JSON record a line."""
    df.write.option("ignoreNullFields", False).mode("errorifexists").json(path)


def bundles(df: DataFrame, path: str, max_records: int = 50_000) -> None:
    """(collection, url, html, md, txt) in a folder a collection, files of bounded size."""
    sizes = df.groupBy("collection").agg(F.ceil(F.count("*") / max_records).alias("_parts")).withColumnRenamed("collection", "_of")
    few = sizes.count() <= SEND_COLLECTIONS
    cut = df.join(F.broadcast(sizes) if few else sizes, F.col("collection").eqNullSafe(F.col("_of")))
    cut.repartition("collection", F.pmod(F.xxhash64("url"), F.col("_parts"))).drop("_of", "_parts").write.option("maxRecordsPerFile", max_records).partitionBy("collection").mode("errorifexists").json(path)


def _escaped(m: re.Match) -> str:
    raw = m[0].encode("utf-16-be")
    return "".join(f"\\u{raw[k]:02x}{raw[k + 1]:02x}" for k in range(0, len(raw), 2))


@arrow_function("string")
def ascii_json(text: pd.Series) -> pd.Series:
    """JSON with all but ASCII characters as \\uXXXX."""
    return text.map(lambda x: re.sub(r"[^\x00-\x7f]", _escaped, x), na_action="ignore")


def bundle_objects(df: DataFrame, column: str, path: str, ascii_only: bool, rows: int = 5000) -> None:
    """JSON objects {url: content} of about `rows` urls each, one a line, in a folder a collection (B10): HTML and text
    with ASCII escapes, Markdown without. Collections of any size are cut by a hash of the url."""
    sizes = df.groupBy("collection").agg(F.ceil(F.count("*") / rows).alias("_parts")).withColumnRenamed("collection", "_of")
    few = sizes.count() <= SEND_COLLECTIONS
    keyed = df.join(F.broadcast(sizes) if few else sizes, F.col("collection").eqNullSafe(F.col("_of"))).select("collection", F.pmod(F.xxhash64("url"), F.col("_parts")).alias("_part"), "url", F.col(column).alias("_content"))
    # each pair as an object of its own, escaped row by row: whole objects, of many texts, never come to Python
    pair = F.to_json(F.create_map("url", "_content"))
    pairs = keyed.select("collection", "_part", "url", (ascii_json(pair) if ascii_only else pair).alias("_pair"))
    held = F.array_sort(F.collect_list(F.struct("url", "_pair")))
    members = F.transform("_held", lambda x: F.substring(x["_pair"], F.lit(2), F.length(x["_pair"]) - 2))
    twice = F.size(F.array_distinct(F.transform("_held", lambda x: x["url"]))) < F.size("_held")
    made = pairs.groupBy("collection", "_part").agg(held.alias("_held"))
    made = made.withColumn("json", F.when(twice, F.raise_error(F.lit("a url occurs twice in a collection"))).otherwise(F.concat(F.lit("{"), F.array_join(members, ","), F.lit("}"))))
    made.select("collection", "json").write.partitionBy("collection").mode("errorifexists").text(path)


def sheets(df: DataFrame, sheet: str, path: str) -> None:
    """Tables for review: a folder of quoted CSV, with a header, for each value of the column `sheet`."""
    df.write.option("quoteAll", True).option("escape", '"').option("emptyValue", "").option("nullValue", "\\N").partitionBy(sheet).mode("errorifexists").csv(path, header=True)
