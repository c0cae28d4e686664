"""Checkpoints of stages that are joined by one key: bucketed and sorted by it when they are written, so that joins of
stored stages, of any size, move no rows."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession


def _file(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_stage.json")
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def store(df: DataFrame, path: str, key: str, buckets: int = 64) -> None:
    """Write a stage in `buckets` files, by a hash of the key and sorted by it (A6, B5). Stages that are to be joined need the
    same number. It fails if the folder exists; the stage is there once its description is, which is written last."""
    spark, name = df.sparkSession, f"stage_{uuid.uuid4().hex}"
    df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", path).mode("errorifexists").saveAsTable(name)
    spark.sql(f"drop table {name}")  # the name only: the table is external
    p, fs = _file(spark, path)
    out = fs.create(p, False)
    try:
        out.write(bytearray(json.dumps({"key": key, "buckets": buckets, "schema": df.schema.jsonValue()}).encode()))
    finally:
        out.close()


def stored(spark: SparkSession, path: str) -> DataFrame:
    """A stage that was written, in this session or another; raises an error for one that wasn't to its end."""
    p, fs = _file(spark, path)
    if not fs.exists(p):
        raise ValueError(f"no stage at {path}")
    spec = json.loads(_text(spark, p, fs))
    columns = spark._jvm.org.apache.spark.sql.types.DataType.fromJson(json.dumps(spec["schema"])).toDDL()
    name, key = f"stage_{uuid.uuid4().hex}", spec["key"].replace("`", "``")
    spark.sql(f"create table {name} ({columns}) using parquet clustered by (`{key}`) sorted by (`{key}`) into {spec['buckets']} buckets location '{path}'")
    return spark.table(name)


def _text(spark: SparkSession, p, fs) -> str:
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def moves(df: DataFrame) -> int:
    """How many times the plan of df moves rows between tasks, but for the rows of sides that are sent whole."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return sum(line.lstrip(" :+-*()0123456789").startswith("Exchange ") for line in plan.splitlines())
