"""A training corpus from `documents`: five stages, each written as Parquet and read again as the next one's input.

    language    documents without letters, or whose language isn't clear, go
    quality     documents that the line field scores below 0.5 go
    near-copies one document of each group of near-copies stays
    mixing      documents are put into the order of the mix of sources; none goes
    pieces      each document's ids are counted and digested, with its decoded text, its source and its place in the
                mixed stream; `in_mix` marks the stream's first part, in which all sources hold their target weights

Every stage reads whole texts and keeps each row or drops it as it is. Null and empty texts have no letter and go in the
first stage; so nothing is left to the later ones but rows with text, which they'd take all the same. Null ids are kept,
linked with nothing and placed last in their source. Of rows that share an id and a text one is left after the third
stage; rows that share an id only stay or go together there, and come next to each other in the mix. Null sources are one
source. An empty table gives an empty result at every stage. Other columns pass through all stages but the last.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioforge.llm import langid, minhash, mixing, piece_codec, quality_crf, queries
from folioforge.llm.common import Scratch, table

#: Below these scores documents are rejected.
LANGUAGE_SCORE, QUALITY_SCORE = 0.5, 0.5
#: Files whose names and numbers of rows are sent to all executors; of more they are joined.
SEND_FILES = 100_000


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_identified(docs, langid.fit(docs, langid.training_rows()), least=LANGUAGE_SCORE)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_crf.keep_good(docs, quality_crf.fit(docs, table(spark, sf_dir, "labels"), quality_crf.training_rows()), least=QUALITY_SCORE)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.drop_near_copies(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.in_order(docs, block=mixing.BLOCK)


def in_stream(docs: DataFrame) -> DataFrame:
    """doc_id, text, source of docs with mix_place, 0 on: the row's place in its files, read one after another by the number
    in their names, or in the partitions of a table that isn't read from files. Readers pack files by size, so their order isn't used."""
    own = ("doc_id", "text", "source")
    try:
        if not docs._jdf.queryExecution().analyzed().children().isEmpty():
            raise AnalysisException("not a scan: its files' places would be those of what it was made from")
        file = docs.metadataColumn("_metadata")
        rows = docs.select(*own, file["file_name"].alias("_file"), file["row_index"].alias("_at"))
    except AnalysisException:
        m = F.monotonically_increasing_id()
        rows = docs.select(*own, F.concat(F.lit("part-"), F.shiftright(m, 33).cast("string")).alias("_file"), m.bitwiseAND(F.lit((1 << 33) - 1)).alias("_at"))
    before = Window.orderBy(F.regexp_extract("_file", r"^part-(\d+)", 1).cast("long"), "_file").rowsBetween(Window.unboundedPreceding, -1)  # over files
    files = rows.groupBy("_file").agg(F.count("*").alias("_n")).select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_ahead"))
    few = files.count() <= SEND_FILES
    return rows.join(F.broadcast(files) if few else files, "_file").select(*own, (F.col("_ahead") + F.col("_at")).alias("mix_place"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    placed = in_stream(docs)
    in_mix = mixing.mixed_rows(docs, block=mixing.BLOCK)
    rows = placed.select("mix_place", "doc_id", "source", (F.col("mix_place") < in_mix).alias("in_mix"))
    digests = piece_codec.encode_digests(placed, id_col="mix_place").withColumnRenamed("doc_id", "mix_place")
    return digests.join(rows, "mix_place").select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "source", "mix_place", "in_mix")


STAGES = [("language", language), ("quality", quality), ("near-copies", near_copies), ("mixing", mixed), ("pieces", encoded)]

#: No SQL expresses the classifiers and the tokenizer; tests hold the stages against their operators and brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, scratch = queries.documents(spark, sf_dir), Scratch(spark, "pipeline")
    for _, stage in STAGES:
        docs = scratch.table(stage(spark, docs, sf_dir))
    return docs
