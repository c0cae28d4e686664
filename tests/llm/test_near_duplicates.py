"""MinHash links and embedding links against brute force, with hot groups and odd rows."""

import random
import re

import numpy as np
import pytest

from folioforge.llm import embed_dedup, minhash
from folioforge.llm.common import Scratch
from folioforge.llm.components import components


def shingles(text, n):
    w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def roots(ids, linked):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def brute(rows, n, num, den):
    sets = {i: shingles(t, n) for i, t in rows}
    ids = sorted(sets)
    pairs = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])]
    return {i: (len(sets[i]), r) for i, r in roots(ids, pairs).items()}


def corpus(seed, n):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6)))
    base = [[word() for _ in range(rng.choice([2, 3, 9, 60, 150]))] for _ in range(n // 4)]
    hot = [word() for _ in range(140)]
    texts = []
    for k in range(n):
        w = list(hot if k % 3 == 0 else rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 4, 8])):
            w[rng.randrange(len(w))] = word()
        texts.append(rng.choice([" ", "\n", " \t"]).join(w))
    return list(enumerate(texts))


@pytest.mark.parametrize("n, num, den", [(3, 85, 100), (5, 80, 100)])
def test_links_are_those_of_all_pairs(spark, n, num, den):
    rows = corpus(n, 320) + [(1000, None), (1001, ""), (1002, " \n\t"), (1003, "One"), (1004, "one"), (1005, "one two"), (1006, "Über"), (1007, "über")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.link_documents(df, words=n, num=num, den=den).collect()}
    assert got == brute(rows, n, num, den)


def test_long_text_and_stragglers(spark):
    """A group of near copies of which many are too far from each other: the finer sketches decide, nothing is lost."""
    rng = random.Random(4)
    hot = [f"w{k}" for k in range(200)]
    rows = []
    for k in range(150):
        w = list(hot)
        for at in rng.sample(range(200), rng.choice([1, 6, 10, 12, 14])):
            w[at] = f"x{k}-{at}"
        rows.append((k, " ".join(w)))
    rows += [(500, "long " * 50_000), (501, "long " * 50_001)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.link_documents(df, words=3, num=85).collect()}
    assert got == brute(rows, 3, 85, 100)


def test_large_groups_go_in_parts(spark, monkeypatch):
    """Leaders with many pairs and buckets with many members give what small ones give."""
    monkeypatch.setattr(minhash, "PAIRS", 8)
    monkeypatch.setattr(minhash, "CELL", 8)
    rng = random.Random(6)
    rows = []
    for k in range(120):
        w = [f"w{i}" for i in range(150)]
        for at in rng.sample(range(150), rng.choice([1, 3, 5, 8, 10])):
            w[at] = f"x{k}-{at}"
        rows.append((k, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.link_documents(df, words=3, num=85).collect()}
    assert got == brute(rows, 3, 85, 100)


def test_repeated_rows_null_ids_and_clashing_columns(spark):
    rows = [(1, "a b c d e f g", "x"), (1, "a b c d e f g", "y"), (None, "a b c d e f g", "z"), (2, "q r s t u v w", "x"), (3, None, "x"), (None, None, None), (1, "q r s t u v w", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id string").selectExpr("*", "1 as kept", "'k' as cls", "array(1L) as bands", "'a' as a", "'_text' as _text")
    got = minhash.link_documents(df).collect()
    assert sorted((str(r.doc_id), str(r.component_id), r.kept) for r in got) == [("1", "1", True)] * 3 + [("2", "1", False), ("3", "3", True), ("None", "None", True), ("None", "None", True)]
    kept = minhash.drop_near_copies(df)
    # an id's different texts both stay, its repeated text once
    assert kept.columns == df.columns and sorted((str(r.doc_id), str(r.text)) for r in kept.collect()) == [("1", "a b c d e f g"), ("1", "q r s t u v w"), ("3", "None"), ("None", "None"), ("None", "a b c d e f g")]


def test_empty_tables(spark):
    assert minhash.link_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert minhash.drop_near_copies(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert embed_dedup.link_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(1)
    for n in (1, 5, 60, 3000):
        x = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        assert (minhash.sketch(x) != minhash._FULL).all() and (minhash.sketch(x, minhash.FINE) != minhash._FULL).all()
    a, b = rng.integers(0, 1 << 63, 900).astype(np.uint64), rng.integers(0, 1 << 63, 100).astype(np.uint64)
    c = rng.integers(0, 1 << 63, 100).astype(np.uint64)
    same = (minhash.sketch(np.concatenate((a, b)), minhash.FINE) == minhash.sketch(np.concatenate((a, c)), minhash.FINE)).mean()
    assert abs(same - 900 / 1100) < 0.05


def test_components_of_a_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(60)] + [(1000, 1000 + k) for k in range(1, 50)] + [(5000, 5001), (7, 7)]
    got = {r.node: r.comp for r in components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "t")).collect()}
    assert got == {k: v for k, v in roots({x for e in edges for x in e}, edges).items() if k != 7 or v == 0}


def test_vectors_are_those_of_all_pairs(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(40, 24))
    rows = [(k, [float(x) for x in (base[k % 40] + rng.normal(size=24) * rng.choice([0, 0.05, 0.2, 0.27])).astype(np.float32)]) for k in range(700)]
    rows += [(k, rows[3][1]) for k in range(700, 900)]  # a third are copies of one
    rows += [(900, None), (901, []), (902, [0.0] * 24), (903, [float("nan")] * 24), (904, [None] * 24), (905, [1.0, 0.0]), (906, [2.0, 0.0]), (907, [1e-300 * 3, 0.0]), (908, [float("inf")] + [0.0] * 23)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in embed_dedup.link_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    good = {k: np.array(v) / np.abs(v).max() for k, v in rows if v and None not in v and np.isfinite(v).all() and any(v)}
    good = {k: v / np.linalg.norm(v) for k, v in good.items()}
    pairs = [(a, b) for a in good for b in good if a < b and len(good[a]) == len(good[b]) and good[a] @ good[b] >= 0.95]
    degree = np.bincount([x for p in pairs for x in p], minlength=1000)
    assert got == {k: (degree[k], r) for k, r in roots([k for k, _ in rows], pairs).items()}


def test_int8_bounds_hold():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 33)) * rng.random((1, 33))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    codes, scale, error = embed_dedup.quantise(x)
    near = codes * scale[:, None]
    size = np.linalg.norm(near, axis=1)
    slack = error[:, None] * size[None] + error[None] * size[:, None] + error[:, None] * error[None]
    assert (np.abs(x @ x.T - near @ near.T) <= slack + 1e-12).all()
    for least in (0.95, 0.3, -0.2):
        tile = embed_dedup.Tile(embed_dedup.Side(x, np.arange(300), np.ones(300, np.int64)), least)
        tile.within()
        assert (tile.count == (x @ x.T >= least).sum(axis=1) - 1).all() and tile.again < 300 * 150


def test_tiles_do_not_grow(spark, monkeypatch):
    """Many small tiles of vectors of two lengths give what one tile gives."""
    rng = np.random.default_rng(5)
    base = rng.normal(size=(30, 12))
    rows = [(k, [float(x) for x in base[k % 30][: 12 - 4 * (k % 2)] + rng.normal(size=12 - 4 * (k % 2)) * 0.06]) for k in range(900)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = sorted(map(tuple, embed_dedup.link_vectors(df).collect()))
    monkeypatch.setattr(embed_dedup, "TILE_BYTES", 1)
    monkeypatch.setattr(embed_dedup, "BLOCK", 64)
    assert sorted(map(tuple, embed_dedup.link_vectors(df).collect())) == want and max(r[1] for r in want) > 20


def test_null_vector_ids(spark):
    rows = [(1, [1.0, 0.0]), (None, [1.0, 0.0]), (2, [1.0, 0.01]), (2, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "'x' as cls", "1 as rep", "2 as n_links", "'r' as raw")
    got = sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in embed_dedup.link_vectors(df).collect())
    assert got == [("1", 1, "1", True), ("2", 0, "1", False), ("2", 1, "1", False), ("None", 0, "None", True)]
