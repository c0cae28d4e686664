"""Bundles byte by byte, zip files by entry, incremental JSON, and digests of sequences."""

import json
import random
import zipfile

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from folioforge.operators import sequence as S
from folioforge.sources import exports as X
from folioforge.sources import readers

SCHEMA = "collection string, url string, place long, html string, md string"


def bundle(rows: list, name: str, k: int) -> dict:
    out: dict = {}
    for c, url, _, *contents in sorted(rows, key=lambda r: r[2]):
        if (c or "null") == name:
            out[url] = contents[k]
    return out


def rows_of(n: int) -> list:
    rng = random.Random(n)
    return [(rng.choice(["hot", "hot", "a_en", None]), f"https://é.org/{k % (n - 3)}", rng.randrange(10**9), rng.choice(['q"\n\t\\', "é😀 ", "", None, "x" * 3000]), f"# {k} é") for k in range(n)]


@pytest.mark.parametrize("zipped", [False, True])
def test_files_are_those_of_the_json_library(spark, tmp_path, monkeypatch, zipped):
    monkeypatch.setattr(X, "CHUNK", 1000)
    rows = rows_of(400)  # some urls twice
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    X.write_bundles(df, f"{tmp_path}/out", {"html": True, "md": False}, ["place"], zipped=zipped, parts=7)
    names = {f"{c}_{f}.json{'.zip' if zipped else ''}" for c in ("hot", "a_en", "null") for f in ("html", "md")}
    assert {f.name for f in (tmp_path / "out").iterdir()} == names and {f.name for f in tmp_path.iterdir()} == {"out"}
    for c in ("hot", "a_en", "null"):
        for k, (f, ascii_only) in enumerate({"html": True, "md": False}.items()):
            file = tmp_path / "out" / f"{c}_{f}.json"
            raw = zipfile.ZipFile(f"{file}.zip").read(file.name) if zipped else file.read_bytes()
            assert raw == json.dumps(bundle(rows, c, k), indent=1, ensure_ascii=ascii_only).encode()
    got = X.read_bundles(spark, f"{tmp_path}/out", tasks=3).collect()
    for member in {r.member for r in got}:
        c, f = member.removesuffix(".json").rsplit("_", 1)
        read = sorted((r.place, r.url, r.content) for r in got if r.member == member)
        assert [x[1:] for x in read] == [*bundle(rows, c, ["html", "md"].index(f)).items()] and [x[0] for x in read] == list(range(len(read)))
    with pytest.raises(FileExistsError):
        X.write_bundles(df, f"{tmp_path}/out", {"html": True}, ["place"])


def test_no_file_of_a_failed_export(spark, tmp_path):
    df = spark.createDataFrame(rows_of(50), SCHEMA)
    bad = df.withColumn("html", F.when(F.col("md") == "# 7 é", F.raise_error(F.lit("lost")).cast("string")).otherwise(F.col("html")))
    for wrong, why in ((bad, "lost"), (df.withColumn("collection", F.lit("a/b")), "not a file")):
        with pytest.raises(Exception, match=why):
            X.write_bundles(wrong, f"{tmp_path}/out", {"html": True}, ["place"])
    assert not (tmp_path / "out").exists()
    X.write_bundles(df.limit(0), f"{tmp_path}/empty", {"html": True}, ["place"])
    assert list((tmp_path / "empty").iterdir()) == [] and X.read_bundles(spark, f"{tmp_path}/empty").count() == 0


def test_zip_files_by_entry(spark, tmp_path, monkeypatch):
    big = {f"u{k}": "é" * (k * 40) for k in range(300)}
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("one_html.json", json.dumps(big), zipfile.ZIP_DEFLATED)
        z.writestr("two_html.json", json.dumps({"u": "x", "v": None, "w": 3}), zipfile.ZIP_STORED)
        z.writestr("none_html.json", "{}")
        z.mkdir("folder")
    with zipfile.ZipFile(tmp_path / "b c.zip", "w") as z:
        z.writestr("two_md.json", json.dumps({"u": "m", "z": "n"}), zipfile.ZIP_BZIP2)
    assert sorted((r.member, r.method) for r in X.entries(spark, f"{tmp_path}/*.zip").collect()) == [("none_html.json", 0), ("one_html.json", 8), ("two_html.json", 0), ("two_md.json", 12)]
    got = X.read_bundles(spark, f"{tmp_path}/a.zip").collect()  # the large entry comes in several batches
    assert sorted((r.place, r.url, r.content) for r in got if r.member == "one_html.json") == [(k, *kv) for k, kv in enumerate(big.items())]
    assert [(r.place, r.url, r.content) for r in got if r.member != "one_html.json"] == [(0, "u", "x"), (1, "v", None), (2, "w", "3")]
    with pytest.raises(Exception, match="compression 12"):
        X.read_bundles(spark, f"{tmp_path}/b c.zip").collect()


def test_three_renditions_merged(spark, tmp_path):
    for name, parts in {"html": [{"u": "x", "v": "y"}], "md": [{"u": "m"}, {"w": "n", "u": "later"}]}.items():
        (tmp_path / name).mkdir()
        for k, one in enumerate(parts):
            with zipfile.ZipFile(tmp_path / name / f"{k}.zip", "w") as z:
                z.writestr(f"{k}_{name}.json", json.dumps(one))
    assert sorted(map(tuple, readers.renditions(spark, {n: f"{tmp_path}/{n}" for n in ("html", "md")}).collect())) == [("u", "x", "later"), ("v", "y", None), ("w", None, "n")]


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.text(max_size=5), st.one_of(st.none(), st.text(max_size=30), st.integers(), st.lists(st.text(max_size=3), max_size=3))), st.integers(1, 9), st.sampled_from([None, 1]), st.booleans())
def test_pairs_of_pieces(d, size, indent, ascii_only):
    raw = json.dumps(d, indent=indent, ensure_ascii=ascii_only).encode("utf-8", "surrogatepass")
    try:
        raw.decode()
    except UnicodeDecodeError:
        return
    pieces = lambda b: (b[k : k + size] for k in range(0, len(b), size))
    assert [*X.pairs(pieces(raw))] == [(k, v if v is None or isinstance(v, str) else json.dumps(v)) for k, v in d.items()]
    for cut in (raw[:-1], raw[: len(raw) // 2]):
        with pytest.raises(ValueError):
            [*X.pairs(pieces(cut))]


def test_not_objects():
    for bad in (b"", b"[1]", b'{"a" 1}', b'{"a": 1 "b": 2}', b'{1: 2}', b'{"a": tru}', b'{"a": 1,}'):
        with pytest.raises(ValueError):
            [*X.pairs(iter([bad]))]


def folded(keys: list) -> tuple[int, int]:
    total = (0, 0)
    for k in keys:
        total = S.joined(total, (1, S.element(k)))
    return total


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=3)), max_size=20), st.integers(0, 20), st.integers(0, 20))
def test_digests_of_runs_join(keys, a, b):
    a, b = sorted((a, b))
    assert S.joined(S.joined(folded(keys[:a]), folded(keys[a:b])), folded(keys[b:])) == folded(keys)
    if len(keys) > 1 and keys[0] != keys[-1]:
        assert folded(keys[::-1])[1] != folded(keys)[1] or keys[::-1] == keys


def test_digests_of_files(spark, tmp_path):
    """Of any split of a table into files; a swapped pair and a row that lacks are seen."""
    keys = [f"k{k}" for k in range(500)]
    want = folded(keys)

    def digest(rows: list, name: str, n: int) -> tuple[int, str]:
        spark.createDataFrame([(k, "x" * 50) for k in rows], "url string, more string").coalesce(1).write.option("maxRecordsPerFile", n).parquet(f"{tmp_path}/{name}")
        return S.whole(S.of_files(spark.read.parquet(f"{tmp_path}/{name}"), "url"))

    assert digest(keys, "a", 1000) == digest(keys, "b", 37) == (500, f"{want[1]:032x}")
    swapped = keys[:100] + [keys[101], keys[100]] + keys[102:]
    assert digest(swapped, "c", 64)[0] == 500 and digest(swapped, "d", 64) != digest(keys, "e", 64)
    assert digest(keys[:77] + keys[78:], "f", 64)[0] == 499
    assert S.whole(S.of_files(spark.read.parquet(f"{tmp_path}/a").where("false"), "url")) == (0, "0" * 32)
