"""Each stage of the pipeline against its operator or brute force, on its own input; queries and SQL are registered."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from folioforge.llm import langid, mixing, quality_crf, queries
from tests.llm.test_near_duplicates import brute

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs.cache()]
    for name, stage in corpus_pipeline.STAGES:
        out.append(stage(spark, out[-1], SF).cache())
        if name != "pieces":
            assert out[-1].columns == docs.columns, name
    ids = [[r.doc_id for r in d.collect()] for d in out]
    found = langid.predict_languages(out[0], langid.fit(out[0], langid.training_rows()))
    assert set(ids[1]) == {r.doc_id for r in found.where("lang_pred != 'und' and score >= 0.5").collect()}
    model = quality_crf.fit(out[1], spark.read.parquet(f"{SF}/labels.parquet"), quality_crf.training_rows())
    assert set(ids[2]) == {r.doc_id for r in quality_crf.score_documents(out[1], model).where("score >= 0.5").collect()}
    assert 0 < len(ids[2]) < len(ids[1])
    want = brute([(r.doc_id, r.text) for r in out[2].collect()], 5, 80, 100)
    assert sorted(ids[3]) == sorted(i for i, (_, c) in want.items() if i == c)
    place = {r.doc_id: (r.slot, r.source, r.place) for r in mixing.mix(out[3]).collect()}
    assert ids[4] == sorted(ids[3], key=place.get)
    assert sorted(ids[5]) == sorted(ids[4])
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, out[5].collect()))


def test_all_are_registered():
    names = __spark_entry__.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10 and "pipeline" in names
    assert set(__spark_entry__.oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got, want = queries.queries()[name](spark, SF).toPandas(), con.sql(queries.oracle_sql()[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    assert sorted(map(str, got[columns].itertuples(index=False, name=None))) == sorted(map(str, want[columns].astype(got[columns].dtypes.to_dict()).itertuples(index=False, name=None)))


def test_the_mix_reaches_the_result(spark):
    """The rows' places are the mix's, which is another order than that of any earlier stage."""
    rows = corpus_pipeline.run(spark, SF).toPandas().sort_values("mix_place")
    assert rows["mix_place"].tolist() == list(range(len(rows)))
    docs = spark.createDataFrame(rows[["doc_id", "source"]])
    mix = sorted(mixing.mix(docs).collect(), key=lambda r: (r.slot, r.source, r.place))
    assert rows["doc_id"].tolist() == [r.doc_id for r in mix] and rows["in_mix"].tolist() == [r.in_mix for r in mix]


ODD = [(9101, None), (9102, ""), (9103, " \n"), (9104, "12 34 --")]


def test_odd_rows_in_every_stage(spark):
    """Nulls in every column, empty and very long texts, repeats, clashing columns, and empty tables."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    some = docs.where("length(text) > 400").orderBy("doc_id").limit(30)
    first = some.first()
    clean = first.text
    rows = [(k, t, None, None, None) for k, t in ODD] + [(None, clean, None, None, None), (None, clean, "en", "s", 1), (9001, clean + (" " + clean) * 300, None, None, None), (9002, clean, "en", None, 3), (9002, clean, "en", None, 3), (first.doc_id, clean[::-1] and "other " + clean, "en", "x", 4)]
    df = some.unionByName(spark.createDataFrame(rows, docs.schema)).withColumns({c: F.lit("clash") for c in ("score", "slot", "kept", "_text", "_id", "_mix_id", "mix_place", "_file")})
    now, ids = df, []
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, now, SF).cache()
        assert name == "pieces" or got.columns == df.columns
        assert stage(spark, df.limit(0), SF).count() == 0
        ids.append(sorted(str(r.doc_id) for r in got.select("doc_id").collect()))
        now = got if name != "pieces" else now
    assert not {str(k) for k, _ in ODD} & set(ids[0]) and {"None", "9001", "9002"} <= set(ids[0])
    assert ids[2].count("None") == ids[1].count("None") and ids[2].count("9002") <= 1
    assert ids[3] == ids[2] and ids[4] == ids[3]
