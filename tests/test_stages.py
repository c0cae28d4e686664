"""Stored stages: joined without moving rows, read in another session, there as a whole or not at all."""

import pytest
from pyspark.sql import functions as F

from folioforge.operators import relational as R
from folioforge.sources import stages


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def sides(spark):
    n = spark.range(3000).withColumn("path", F.concat(F.lit("/p/"), F.col("id").cast("string")))
    links = n.select(F.col("path").alias("mirror_path"), F.when(F.col("id") % 3 == 0, "home").otherwise("article").alias("level"), F.col("id").alias("a"))
    return links, n.where("id % 2 = 0").select("path", F.col("id").alias("dl")), n.where("id % 5 > 0").select("path", F.struct(F.col("id").alias("x y")).alias("md"))


def test_three_stored_stages_join_where_they_are(spark, tmp_path, no_broadcast):
    links, datelines, metadata = sides(spark)
    for name, df, key in (("l", links, "mirror_path"), ("d", datelines, "path"), ("m", metadata, "path")):
        stages.store(df, f"{tmp_path}/{name}", key, buckets=8)
    got = R.corpus(*(stages.stored(spark, f"{tmp_path}/{n}") for n in "ldm"), ["article"])
    plain = R.corpus(links, datelines, metadata, ["article"])
    assert stages.moves(got) == 0 and stages.moves(plain) > 0
    assert sorted(map(str, got.select("a", "dl", "md").collect())) == sorted(map(str, plain.select("a", "dl", "md").collect())) and got.count() > 500
    assert len(list((tmp_path / "l").glob("*.parquet"))) == 8


def test_a_sum_by_the_key_stays_in_its_task(spark, tmp_path, no_broadcast):
    stages.store(sides(spark)[0], f"{tmp_path}/l", "mirror_path", buckets=4)
    df = stages.stored(spark.newSession(), f"{tmp_path}/l").groupBy("mirror_path").agg(F.count("*").alias("n"))
    assert stages.moves(df) == 0 and df.agg(F.sum("n")).first()[0] == 3000


def test_stages_are_written_once(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "x"), (2, "x")], "n int, k string")
    stages.store(df, f"{tmp_path}/s", "k", buckets=2)
    assert sorted(map(str, stages.stored(spark, f"{tmp_path}/s").collect())) == sorted(map(str, df.collect()))
    with pytest.raises(Exception, match="(?i)exist|non-empty"):
        stages.store(df, f"{tmp_path}/s", "k", buckets=2)
    with pytest.raises(ValueError, match="no stage"):
        stages.stored(spark, f"{tmp_path}/none")
    bad = df.withColumn("n", F.when(F.col("n") == 2, F.raise_error(F.lit("lost")).cast("int")).otherwise(F.col("n")))
    with pytest.raises(Exception, match="lost"):
        stages.store(bad, f"{tmp_path}/half", "k", buckets=2)
    with pytest.raises(ValueError, match="no stage"):
        stages.stored(spark, f"{tmp_path}/half")
    stages.store(df.limit(0), f"{tmp_path}/empty", "k", buckets=2)
    assert stages.stored(spark, f"{tmp_path}/empty").count() == 0
