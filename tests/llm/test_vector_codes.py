"""Filtering Lloyd against Lloyd's rounds in plain Python, in whole numbers."""

import hashlib
import math
import random

import numpy as np
import pytest

from folioforge.llm import vector_codes as V
from pyspark.sql import functions as F

SCHEMA = "vec_id long, embedding array<double>, label string"


def plainly(rows: list, parts: int, entries: int, rounds: int) -> list:
    good = [(k, [math.floor(x * 4096) if abs(x) < 1e300 else V._floor(x) for x in v], label, v) for k, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    some = sorted((r for r in good if r[1]), key=lambda r: (r[0] is None, r[0] or 0, r[3]))
    dim = len(some[0][1]) if some else 0
    first = [r[1] for r in some if len(r[1]) == dim][:entries]
    cut = V.spans(dim, parts)
    books = [[v[s] for v in first] for s in cut]
    apart = lambda x, z: sum((a - b) ** 2 for a, b in zip(x, z, strict=True))
    near = lambda x, book: min(range(len(book)), key=lambda e: (apart(x, book[e]), e))
    whole = [r for r in good if r[1] and len(r[1]) == dim]
    for _ in range(rounds):
        for p, s in enumerate(cut):
            groups: dict[int, list] = {}
            for r in whole:
                groups.setdefault(near(r[1][s], books[p]), []).append(r[1][s])
            books[p] = [[sum(c) // len(groups[e]) for c in zip(*groups[e], strict=True)] if e in groups else z for e, z in enumerate(books[p])]
    sha = hashlib.sha256(",".join(str(v) for book in books for z in book for v in z).encode()).hexdigest()
    fits = lambda v: v if v < 1 << 63 else None
    out = []
    for k, v, label, _ in whole:
        codes = [near(v[s], b) for s, b in zip(cut, books, strict=True)]
        out.append((k, "".join(f"{c:02x}" for c in codes), sum(apart(v[s], b[c]) for s, b, c in zip(cut, books, codes, strict=True)), label))
    sums: dict = {}
    for _, _, e, label in out:
        sums[label] = None if sums.get(label, 0) is None or fits(e) is None else sums.get(label, 0) + e
    done = [(k, code, fits(e), sums[label] and fits(sums[label]), sha) for k, code, e, label in out]
    done = [(a, b, c, 0 if d == 0 else d, e) for a, b, c, d, e in done]
    return sorted(done + [(r[0], None, None, None, sha) for r in good if not r[1] or len(r[1]) != dim], key=repr)


def held(spark, rows: list, parts: int = 8, entries: int = 16, rounds: int = 6, spread: int = 3) -> None:
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"code": F.lit("clash"), "own": F.lit(1), "n": F.lit("x")}).repartition(spread)
    got = V.encode_vectors(df, parts, entries, rounds).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()
    assert sorted(map(tuple, got), key=repr) == plainly(rows, parts, entries, rounds)


@pytest.mark.parametrize("seed", range(3))
def test_trees_assign_as_all_distances_do(seed):
    rng = np.random.default_rng(seed)
    for n, d, m, top in ((1, 3, 4, 5), (700, 4, 16, 30), (500, 8, 16, 4096), (300, 2, 7, 2), (200, 1, 5, 3), (40, 0, 3, 9)):
        x, z = rng.integers(-top, top + 1, (n, d)), rng.integers(-top, top + 1, (m, d))
        z[-1] = z[0]  # of equal entries the first gets the points
        tree = V.Tree.build(x)
        nearest = ((x[:, None] - z[None]) ** 2).sum(axis=2).argmin(axis=1)
        sums, counts, (*whole, (at, _)) = tree.assign(z)
        assert (counts == np.bincount(nearest, minlength=m)).all()
        assert all((sums[e] == x[nearest == e].sum(axis=0)).all() for e in range(m))
        again = V.Tree.unpack(tree.pack(), d)
        for t in (tree, again):
            assert (t.codes(z) == nearest).all()
        big = V.Tree.build(x.astype(object) * 10**30)
        assert (V.Tree.unpack(big.pack(), d).codes(z.astype(object) * 10**30) == nearest).all()


def test_subtrees_are_assigned_at_once():
    rng = np.random.default_rng(0)
    centres = rng.integers(-4000, 4000, (16, 8))
    x = centres[rng.integers(0, 16, 4000)] + rng.integers(-40, 41, (4000, 8))
    _, counts, (*whole, (at, _)) = V.Tree.build(x).assign(centres)
    assert counts.sum() == 4000 and len(at) < 2000  # most points are never looked at


def test_rows(spark):
    rng = random.Random(3)
    rows = [(k, [rng.choice([0.0, 0.25, -0.5, 0.1, rng.random()]) for _ in range(16)], rng.choice(["a", "b", None])) for k in range(120)]
    rows += [(5, rows[7][1], "a"), (5, rows[7][1], "a"), (None, rows[8][1], None), (200, None, "a"), (201, [], "b"), (202, [1.0, 2.0], "b"), (203, [None] * 16, "a"), (204, [math.nan] * 16, "a"), (205, [math.inf] * 16, "a"), (-7, [-0.0] * 16, "z")]
    held(spark, rows)
    held(spark, rows, parts=5, entries=7, rounds=2, spread=1)
    held(spark, rows, parts=20, entries=3, rounds=1)  # parts without components
    held(spark, rows[:5])  # fewer vectors than entries
    held(spark, [])
    held(spark, [(1, None, "a"), (2, [], None)])


def test_components_of_any_size(spark):
    rng = random.Random(4)
    rows = [(k, [rng.random() * 10.0 ** rng.choice([0, 3, 8, 30, 200, 308]) for _ in range(8)], "a" if k % 3 else "b") for k in range(60)] + [(100 + k, [rng.random()] * 8, "c") for k in range(50)]
    held(spark, rows, parts=4, entries=5, rounds=3)


def test_many_labels_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(V, "SEND_LABELS", 5)
    monkeypatch.setattr(V, "CHUNK", 16 * 40)
    rng = random.Random(5)
    held(spark, [(k, [rng.gauss(0, 0.2) for _ in range(16)], "hot" if k % 3 == 0 else None if k % 3 == 1 else f"l{k}") for k in range(300)], entries=16, rounds=4)


def test_too_many_entries(spark):
    with pytest.raises(ValueError):
        V.encode_vectors(spark.createDataFrame([], SCHEMA), entries=257)
