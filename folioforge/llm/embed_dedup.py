"""Near-duplicate embeddings: int8 tile products with rigorous error bounds, full precision only where they leave doubt.

A unit vector x is stored as s * q + r with q in int8; e = |r| bounds the error. For two vectors
|x.y - s t (p.q)| <= e_x |y'| + e_y |x'| + e_x e_y with x' = s p the quantised vectors, so the product of the codes, which float32
matrix products give exactly below 1040 dimensions (longer ones go in slices), proves most pairs linked or not linked.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.llm.common import Scratch, release, tune
from folioforge.llm.components import components

#: Bytes of a tile's vectors, as float64, that a task holds while the other tile's pass by; rows of a block of a product;
#: tiles at least, for a few vectors. More vectors make more tiles, not larger ones.
TILE_BYTES, BLOCK, SPREAD = 64 << 20, 2048, 8
_SLICE = 1024


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes, scales, and rigorous bounds of the Euclidean error, for rows of unit vectors."""
    scale = np.abs(x).max(axis=1) / 127
    codes = np.rint(x / scale[:, None]).astype(np.int8)
    error = np.linalg.norm(x - codes * scale[:, None], axis=1)
    return codes, scale, error * (1 + 1e-9) + 1e-12


def _prepare(batches):
    """vec_id, digest of the vector (null if it links with nothing), its components as float32 if that holds them exactly, else float64."""
    for batch in batches:
        ids, column = batch.column(0), batch.column(1)
        digest, raw = [None] * len(ids), [None] * len(ids)
        flat, lengths = column.flatten(), np.asarray(pc.fill_null(pc.list_value_length(column), 0))
        values = np.asarray(flat.fill_null(np.nan)).astype(np.float64) + 0.0  # -0.0 is 0.0
        ends = np.cumsum(lengths)
        some = np.flatnonzero(lengths > 0)
        if len(some):
            first = (ends - lengths)[some]
            with np.errstate(over="ignore", invalid="ignore"):
                half = values.astype(np.float32)
                exact = np.logical_and.reduceat(half == values, first)
                top = np.maximum.reduceat(np.abs(values), first)
            for i in np.flatnonzero(np.isfinite(top) & (top > 0)):
                k = some[i]
                x = values[ends[k] - lengths[k] : ends[k]]
                digest[k] = hashlib.blake2b(x.tobytes(), digest_size=16).digest()
                raw[k] = b"f" + half[ends[k] - lengths[k] : ends[k]].tobytes() if exact[i] else b"d" + x.tobytes()
        yield pa.RecordBatch.from_arrays([ids, pa.array(digest, pa.binary()), pa.array(raw, pa.binary())], ["vec_id", "cls", "raw"])


def _unit(raw: list[bytes]) -> np.ndarray:
    kinds = np.array([r[:1] == b"f" for r in raw])
    out = np.empty((len(raw), (len(raw[0]) - 1) // (4 if kinds[0] else 8)))
    for kind, dtype in ((True, np.float32), (False, np.float64)):
        rows = np.flatnonzero(kinds == kind)
        if len(rows):
            out[rows] = np.frombuffer(b"".join(raw[k][1:] for k in rows), dtype).reshape(len(rows), -1)
    out /= np.abs(out).max(axis=1, keepdims=True)
    return out / np.sqrt(np.einsum("ij,ij->i", out, out))[:, None]


def _local_roots(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The least index that each of n nodes reaches over edges (u, v)."""
    root = np.arange(n)
    while len(u):
        before = root.copy()
        low = np.minimum(root[u], root[v])
        np.minimum.at(root, root[u], low)
        np.minimum.at(root, root[v], low)
        root = root[root]
        if (root == before).all() and (root[u] == root[v]).all():
            break
    return root


class Side:
    """Unit rows with their codes, and what the products of codes need."""

    def __init__(self, x: np.ndarray, rep: np.ndarray, weight: np.ndarray, cls: np.ndarray | None = None):
        self.x, self.rep, self.weight, self.cls = x, rep, weight, rep if cls is None else cls
        codes, self.scale, self.error = quantise(x)
        self.wide = codes.astype(np.float32)
        self.size = np.sqrt(np.einsum("ij,ij->i", self.wide, self.wide, dtype=np.float64)) * self.scale


def links(a: Side, i: slice, b: Side, j: slice, least: float, upper: bool) -> tuple[np.ndarray, np.ndarray, int]:
    """Index pairs (of a, of b) of rows in the slices whose cosine is `least` or more (upper: with a's before b's only),
    and how many were computed again in full precision."""
    product = a.wide[i, :_SLICE] @ b.wide[j, :_SLICE].T
    for k in range(_SLICE, a.wide.shape[1], _SLICE):
        product = product + (a.wide[i, k : k + _SLICE] @ b.wide[j, k : k + _SLICE].T).astype(np.float64)
    # the least product of codes that a row's links can have, by the largest error and scale of the other side
    need = least - (a.error[i] * b.size[j].max() + b.error[j].max() * a.size[i] + a.error[i] * b.error[j].max() + 1e-9)
    floor = np.where(need > 0, need / (a.scale[i] * b.scale[j].max()), need / (a.scale[i] * b.scale[j].min()))
    p, q = np.nonzero(product >= np.floor(floor).astype(product.dtype)[:, None])
    if upper:
        p, q = p[p < q], q[p < q]
    value = product[p, q].astype(np.float64)
    p, q = p + i.start, q + j.start
    value *= a.scale[p] * b.scale[q]
    slack = a.error[p] * b.size[q] + b.error[q] * a.size[p] + a.error[p] * b.error[q] + 1e-9
    linked = value - slack >= least
    where = np.flatnonzero(~linked & (value + slack >= least))
    for c in range(0, len(where), 65_536):
        w = where[c : c + 65_536]
        linked[w] = np.einsum("ij,ij->i", a.x[p[w]], b.x[q[w]]) >= least
    return p[linked], q[linked], len(where)


class Tile:
    """One tile held by a task: what its rows, and the rows that pass by, are linked with."""

    def __init__(self, held: Side, least: float):
        self.held, self.least, self.again = held, least, 0
        self.count, self.root = np.zeros(len(held.rep), np.int64), np.arange(len(held.rep))

    def within(self) -> None:
        n, h = len(self.held.rep), self.held
        for a in range(0, n, BLOCK):
            for b in range(a, n, BLOCK):
                p, q, again = links(h, slice(a, min(n, a + BLOCK)), h, slice(b, min(n, b + BLOCK)), self.least, a == b)
                self.again += again
                self.count += np.bincount(p, h.weight[q], n).astype(np.int64) + np.bincount(q, h.weight[p], n).astype(np.int64)
                if len(p):
                    self.root = _merge(self.root, p, q)

    def passing(self, other: Side) -> tuple[np.ndarray, np.ndarray]:
        """(links of each row of other, an index of held that it is linked with, or -1). Held rows that share a partner get one root."""
        n, m, h = len(self.held.rep), len(other.rep), self.held
        count, to = np.zeros(m, np.int64), np.full(m, -1)
        for a in range(0, n, BLOCK):
            p, q, again = links(h, slice(a, min(n, a + BLOCK)), other, slice(0, m), self.least, False)
            self.again += again
            if len(p):
                self.count += np.bincount(p, other.weight[q], n).astype(np.int64)
                count += np.bincount(q, h.weight[p], m).astype(np.int64)
                to[q[to[q] < 0]] = p[to[q] < 0]
                self.root = _merge(self.root, p, to[q])
        return count, to

    def rows(self) -> tuple[np.ndarray, ...]:
        some = self.count > 0
        return self.held.cls[some], self.held.rep[some], self.count[some], self.held.rep[self.root][some]


def _merge(root: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    u, v = np.concatenate((np.arange(len(root)), p)), np.concatenate((root, q))
    return _local_roots(len(root), u, v)


_MET = ["cls", "rep", "links", "root"]


def _tile_task(least: float):
    """Rows sorted by (pair, width, side): of each pair of tiles the first tile is held, blocks of the second pass by."""

    def run(batches):
        held: list = []  # rows of the tile that is being gathered
        other: list = []
        key, tile = None, None

        def side(rows):
            names = np.empty(len(rows), object)
            names[:] = [r[3] for r in rows]
            return Side(_unit([r[2] for r in rows]), np.array([r[0] for r in rows]), np.array([r[1] for r in rows]), names)

        def out(cls, rep, count, root):
            return pa.RecordBatch.from_arrays([pa.array(list(cls), pa.binary()), pa.array(rep, pa.int64()), pa.array(count, pa.int64()), pa.array(root, pa.int64())], _MET)

        def passed():
            nonlocal other
            block, other = side(other), []
            count, to = tile.passing(block)
            some = count > 0
            return out(block.cls[some], block.rep[some], count[some], tile.held.rep[to[some]])

        def ended():
            if other:
                yield passed()
            if tile is None and held and key[2]:
                made = Tile(side(held), least)
                made.within()
                yield out(*made.rows())
            elif tile is not None:
                yield out(*tile.rows())

        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in range(7)]
            for pair, width, second, rep, n, raw, cls in zip(*columns, strict=True):
                now = (pair, width, (pair >> 32) == (pair & 0xFFFFFFFF))
                if now != key:
                    if key is not None:
                        yield from ended()
                    key, tile, held, other = now, None, [], []
                if not second:
                    held.append((rep, n, raw, cls))
                elif held:
                    if tile is None:
                        tile, held = Tile(side(held), least), [None]
                    other.append((rep, n, raw, cls))
                    if len(other) == BLOCK:
                        yield passed()
        if key is not None:
            yield from ended()
        release()

    return run


def link_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", least: float = 0.95) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of vectors; links are cosines of `least` or more.

    Equal vectors form a class that is compared once and counted with its size. Classes are dealt over tiles by a hash
    of the vector, so no tile is hot; each pair of tiles is met by one task, which holds the first one and lets the second
    pass by in blocks, so its memory is bounded by TILE_BYTES, however many vectors there are. A task returns link counts
    and what its rows' link graph hangs on, never pairs. All pairs of classes are covered by tiles: the work is quadratic in
    the number of different vectors, as is what is sent to tasks (each vector as often as there are tiles); nothing is left out.

    Null, empty or zero vectors and those with a null or non-finite component link with nothing (n_links 0, their own
    component). Vectors of different lengths never link. Rows that share an id are separate vectors, but share the
    component. Rows with a null id take part in no link: n_links 0, a null component_id, kept. An empty table gives an
    empty result; other columns are ignored, whatever their names.
    """
    spark = vectors.sparkSession
    tune(spark)
    scratch = Scratch(spark, "vectors")
    ready = scratch.table(vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("_v")).mapInArrow(_prepare, "vec_id long, cls binary, raw binary"))
    classes = scratch.table(ready.where("cls is not null and vec_id is not null").groupBy("cls").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.any_value("raw").alias("raw")))
    sized = classes.agg(F.count("*").alias("n"), F.max(F.length("raw")).alias("most")).first()
    size = max(BLOCK, TILE_BYTES // (2 * (sized.most or 1)))
    tiles = max(1, math.ceil(sized.n / size), min(SPREAD, math.ceil(sized.n / 1024)))
    width = F.expr("(length(raw) - 1) div if(substring(raw, 1, 1) = X'66', 4, 8)")
    placed = classes.withColumn("tile", F.pmod(F.xxhash64("cls"), F.lit(tiles))).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(tiles - 1).cast("long"))))
    pair = F.shiftleft(F.least("tile", "other"), 32) + F.greatest("tile", "other")
    dealt = placed.select(pair.alias("pair"), width.alias("width"), (F.col("tile") > F.col("other")).alias("second"), "rep", "n", "raw", "cls")
    pairs = tiles * (tiles + 1) // 2
    dealt = dealt.repartition(min(pairs, 4096), "pair").sortWithinPartitions("pair", "width", "second", "rep")
    met = scratch.table(dealt.mapInArrow(_tile_task(least), "cls binary, rep long, links long, root long"))
    shared = ready.where("cls is not null and vec_id is not null").groupBy("vec_id").agg(F.count("*").alias("k")).where("k > 1").select("vec_id")
    same = ready.where("cls is not null").join(shared, "vec_id", "left_semi").join(classes.select("cls", "rep"), "cls").select(F.col("rep").alias("a"), F.col("vec_id").alias("b"))
    found = components(met.select(F.col("rep").alias("a"), F.col("root").alias("b")).unionByName(same).distinct(), scratch)
    linked = met.groupBy("cls").agg(F.sum("links").alias("links"))
    of_class = scratch.table(
        classes.select("cls", "rep", "n").join(linked, "cls", "left").join(found.withColumnRenamed("node", "rep"), "rep", "left")
        .select("cls", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("links"), F.coalesce("comp", "rep").alias("comp"))
    )
    return (
        ready.select("vec_id", "cls").join(of_class, "cls", "left")
        .select("vec_id", F.when(F.col("vec_id").isNotNull(), F.coalesce("links", F.lit(0))).otherwise(F.lit(0)).alias("n_links"), F.when(F.col("vec_id").isNotNull(), F.coalesce("comp", "vec_id")).alias("component_id"))
        .withColumn("kept", F.col("vec_id").isNull() | (F.col("vec_id") == F.col("component_id")))
    )
