"""Product codes for vectors: a codebook a part position, trained by Lloyd's rounds over all vectors with the filtering algorithm.

Components become integers, so that sums, distances and ties are exact. Vectors are cut into chunks of bounded size; for each
chunk and part position a kd-tree is built once, and kept in a table with the box, count and component sums of every node. A
round sends the codebooks down the trees: the entry nearest to a box's middle stays, and an entry goes where no point of the
box can be nearer to it. A box with one entry left is assigned as a whole by its cached sums; only leaves with several
entries left look at their points. Each chunk adds up sums and counts by entry, which Spark adds up over all chunks.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.llm.common import Scratch, release, tune

#: Components of a chunk's vectors; points of a leaf at most; labels whose sums are sent to all tasks.
CHUNK, LEAF, SEND_LABELS = 1 << 20, 32, 100_000
#: Beyond this a sum of squared differences may leave 64 bits: such chunks are computed in Python's integers.
_SAFE = 1 << 25


def exact(x: np.ndarray) -> np.ndarray:
    """floor(4096 x) as int64, or as Python's integers where some are too large for products in 64 bits."""
    scaled = np.floor(x * 4096.0) if np.abs(x).max(initial=0) < 1e300 else None  # times a power of two: exact
    if scaled is not None and np.abs(scaled).max(initial=0) < _SAFE:
        return scaled.astype(np.int64)
    return np.array([[_floor(float(v)) for v in row] for row in x], object).reshape(x.shape)


def _floor(v: float) -> int:
    n, d = v.as_integer_ratio()
    return n * 4096 // d


def spans(dim: int, parts: int) -> list[slice]:
    """Consecutive parts, equal where `parts` divides dim, else the first ones longer by one."""
    ends = np.cumsum([0, *[dim // parts + (k < dim % parts) for k in range(parts)]])
    return [slice(int(a), int(b)) for a, b in zip(ends[:-1], ends[1:], strict=True)]


@dataclass
class Tree:
    """A kd-tree over points by level: points in `order`, nodes as runs of it (first to last), children 2k + 1 and 2k + 2."""

    points: np.ndarray  # in the tree's order
    order: np.ndarray
    first: np.ndarray
    last: np.ndarray
    low: np.ndarray
    high: np.ndarray
    sums: np.ndarray
    leaves: int  # nodes from here on are leaves

    @classmethod
    def build(cls, x: np.ndarray) -> Tree:
        n = len(x)
        depth = max(0, (-(-n // LEAF) - 1).bit_length())
        order, bounds = np.arange(n), np.array([0, n])
        firsts, lasts, lows, highs, sums = [], [], [], [], []
        for level in range(depth + 1):
            y = x[order]
            a, b = bounds[:-1], bounds[1:]
            firsts.append(a)
            lasts.append(b)
            lows.append(np.minimum.reduceat(y, a))
            highs.append(np.maximum.reduceat(y, a))
            sums.append(np.add.reduceat(y, a))
            if level < depth:  # each node's points by its widest component, the lower half to the first child
                node = np.repeat(np.arange(len(a)), b - a)
                widest = np.argmax(highs[-1] - lows[-1], axis=1)[node] if x.shape[1] else node * 0
                order = order[np.lexsort((y[np.arange(n), widest] if x.shape[1] else node, node))]
                bounds = np.unique(np.concatenate([a, (a + b) // 2, b]))
        both = [np.concatenate(v) for v in (firsts, lasts, lows, highs, sums)]
        return cls(x[order], order, *both, leaves=len(both[0]) - len(firsts[-1]))

    def assign(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """Component sums and counts by entry, and which entry (ties: the first) the points get, as (nodes, entry) of whole
        subtrees and (points, entry) of single points."""
        m = len(entries)
        sums, counts = np.zeros((m, self.points.shape[1]), self.points.dtype), np.zeros(m, np.int64)
        kind = object if object in (self.points.dtype, entries.dtype) else np.int64
        low, high, z = self.low.astype(kind), self.high.astype(kind), entries.astype(kind)
        nodes, masks = np.array([0]), np.ones((1, m), bool)
        which = np.arange(m)
        whole, single = [], []
        while len(nodes):
            lo, hi = low[nodes], high[nodes]
            d = ((2 * z[None] - (lo + hi)[:, None]) ** 2).sum(axis=2)
            best = _least(np.where(masks, d, d.max() + 1))
            u = z[None] - z[best][:, None]
            v = np.where(u > 0, hi[:, None], lo[:, None])
            gap = (u * (z[None] + z[best][:, None] - 2 * v)).sum(axis=2)  # least of d(z, x) - d(best, x) over the box
            masks = masks & ((gap < 0) | (gap == 0) & (which[None] <= best[:, None]))
            alone = masks.sum(axis=1) == 1
            done, entry = nodes[alone], best[alone]
            np.add.at(sums, entry, self.sums[done])
            np.add.at(counts, entry, self.last[done] - self.first[done])
            whole.append((done, entry))
            nodes, masks = nodes[~alone], masks[~alone]
            leaf = nodes >= self.leaves
            single.append(nodes[leaf])
            inner = ~leaf
            nodes, masks = np.concatenate([2 * nodes[inner] + 1, 2 * nodes[inner] + 2]), np.concatenate([masks[inner], masks[inner]])
        left = np.concatenate([np.zeros(0, np.int64), *single])
        size = self.last[left] - self.first[left]
        at = np.repeat(self.first[left] - np.cumsum(size) + size, size) + np.arange(size.sum())
        nearest = np.zeros(len(at), np.int64)
        for k in range(0, len(at), 4096):
            nearest[k : k + 4096] = _least(((self.points[at[k : k + 4096], None].astype(kind) - z[None]) ** 2).sum(axis=2))
        np.add.at(sums, nearest, self.points[at])
        np.add.at(counts, nearest, 1)
        return sums, counts, [*whole, (at, nearest)]

    def codes(self, entries: np.ndarray) -> np.ndarray:
        """The entry of each point, in the points' first order."""
        *whole, (at, nearest) = self.assign(entries)[2]
        out = np.zeros(len(self.points), np.int64)
        for nodes, entry in whole:
            for node, e in zip(nodes.tolist(), entry.tolist(), strict=True):
                out[self.first[node] : self.last[node]] = e
        out[at] = nearest
        back = np.empty_like(out)
        back[self.order] = out
        return back

    def pack(self) -> bytes:
        """The arrays as an Arrow record; Python's integers as text."""
        plain = lambda a: pa.array(a.ravel().astype("int64")) if a.dtype != object else pa.array([str(v) for v in a.ravel()], pa.string())
        arrays = [plain(getattr(self, k)) for k in _FIELDS]
        batch = pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a) for a in arrays], list(_FIELDS))
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
            w.write_batch(batch)
        return self.leaves.to_bytes(8, "little") + sink.getvalue().to_pybytes()

    @classmethod
    def unpack(cls, raw: bytes, width: int) -> Tree:
        with pa.ipc.open_stream(raw[8:]) as r:
            batch = r.read_next_batch()
        out = []
        for k, column in zip(_FIELDS, batch.columns, strict=True):
            flat = column.values
            a = np.array([int(v) for v in flat.to_pylist()], object) if pa.types.is_string(flat.type) else flat.to_numpy()
            out.append(a if k in ("order", "first", "last") else a.reshape(-1, width) if width else np.zeros((0, 0), np.int64))
        if not width:  # points without components
            n, m = len(out[1]), len(out[2])
            out[0], out[4], out[5], out[6] = (np.zeros((k, 0), np.int64) for k in (n, m, m, m))
        return cls(*out, leaves=int.from_bytes(raw[:8], "little"))


_FIELDS = ("points", "order", "first", "last", "low", "high", "sums")


def _least(d: np.ndarray) -> np.ndarray:
    """The place of each row's first minimum."""
    return np.argmin(d, axis=1).astype(np.int64) if len(d) else np.zeros(0, np.int64)


def fit_rows(column: str) -> str:
    """SQL that holds for vectors that are coded: not null, no null or non-finite components."""
    return f"`{column}` is not null and forall(`{column}`, x -> x is not null and abs(cast(x as double)) < cast('infinity' as double))"  # NaN is above all


@dataclass
class Codebooks:
    """Entries by part position, as lists of Python's integers: they are small, of a fixed number, and have no bound in size."""

    dim: int
    entries: list[list[list[int]]]

    def arrays(self) -> list[np.ndarray]:
        out = []
        for book, span in zip(self.entries, spans(self.dim, len(self.entries)), strict=True):
            small = all(abs(v) < _SAFE for e in book for v in e)
            out.append(np.array(book, np.int64 if small else object).reshape(len(book), span.stop - span.start))
        return out

    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(v) for book in self.entries for e in book for v in e).encode()).hexdigest()


def _chunks(dim: int, parts: int):
    """Trees of chunks of vectors of dim components; ids and labels of all rows, in chunks; vectors of other sizes get no tree."""
    size = max(LEAF, CHUNK // max(1, dim))

    def made(ids, labels, vectors):
        values = np.concatenate([np.asarray(v.flatten()).astype(np.float64) for v in vectors]).reshape(-1, dim)
        x = exact(values)
        trees = [Tree.build(x[:, s]).pack() for s in spans(dim, parts)]
        return pa.RecordBatch.from_arrays(
            [pa.array([pa.concat_arrays(ids).to_pylist()], pa.list_(pa.int64())), pa.array([pa.concat_arrays(labels).to_pylist()], pa.list_(pa.string())), pa.array([trees], pa.list_(pa.binary()))], ["ids", "labels", "trees"]
        )

    def run(batches):
        ids, labels, vectors, held = [], [], [], 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                take = min(size - held, batch.num_rows - at)
                for store, k in ((ids, 0), (labels, 1), (vectors, 2)):
                    store.append(batch.column(k).slice(at, take))
                held, at = held + take, at + take
                if held == size:
                    yield made(ids, labels, vectors)
                    ids, labels, vectors, held = [], [], [], 0
        if held:
            yield made(ids, labels, vectors)
        release()

    return run


def _trees(raw: pa.ListScalar, dim: int) -> list[Tree]:
    blobs = raw.as_py()
    return [Tree.unpack(b, s.stop - s.start) for b, s in zip(blobs, spans(dim, len(blobs)), strict=True)]


def train(chunks: DataFrame, first: list[list[int]], dim: int, parts: int, rounds: int) -> Codebooks:
    """Codebooks after `rounds` rounds over all chunks. What comes to the driver is a number an entry's component."""
    books = Codebooks(dim, [[v[s] for v in first] for s in spans(dim, parts)])
    entries = len(first)
    for _ in range(rounds):

        def partial(batches, books=books):
            arrays = books.arrays()
            for batch in batches:
                for raw in batch.column(0):
                    rows = []
                    for p, (tree, z) in enumerate(zip(_trees(raw, dim), arrays, strict=True)):
                        sums, counts, _ = tree.assign(z)
                        for e in np.flatnonzero(counts).tolist():
                            for k, v in enumerate(sums[e].tolist()):
                                rows += [(p * entries + e, k, limb, x, int(counts[e])) for limb, x in enumerate(_limbs(int(v)))]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 5, _SUM_TYPES, strict=True)], list(_SUM_NAMES))
            release()

        added = chunks.select("trees").mapInArrow(partial, "slot int, pos int, limb int, total long, n long").groupBy("slot", "pos", "limb").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
        sums: dict[tuple[int, int], list[int]] = {}
        for slot, pos, limb, total, n in added.collect():  # a few numbers for each component of an entry
            got = sums.setdefault((slot, pos), [0, 0])
            got[0] += total << (_LIMB * limb)
            got[1] = max(got[1], n)  # limb 0 is in all rows
        new = [[list(e) for e in book] for book in books.entries]
        for (slot, pos), (total, n) in sums.items():
            new[slot // entries][slot % entries][pos] = total // n
        books = Codebooks(dim, new)
    return books


#: Sums of any size go as signed digits of so many bits, which Spark adds up as longs.
_LIMB = 40
_SUM_NAMES, _SUM_TYPES = ("slot", "pos", "limb", "total", "n"), (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64())


def _limbs(v: int) -> list[int]:
    out = []
    while not -(1 << _LIMB) <= v < 1 << _LIMB:
        out.append(v & ((1 << _LIMB) - 1))
        v >>= _LIMB
    return [*out, v]


def _coded(books: Codebooks, dim: int):
    """vec_id, label, code, error of the vectors of chunks; an error beyond 64 bits is null."""

    def run(batches):
        arrays = books.arrays()
        for batch in batches:
            for ids, labels, raw in zip(*batch.columns, strict=True):
                digits, error = np.zeros((len(arrays), len(ids)), np.int64), np.zeros(len(ids), object)
                for p, (tree, z) in enumerate(zip(_trees(raw, dim), arrays, strict=True)):
                    digits[p] = tree.codes(z)
                    back = np.empty_like(tree.points)
                    back[tree.order] = tree.points
                    kind = object if object in (z.dtype, back.dtype) else np.int64
                    error = error + ((back.astype(kind) - z.astype(kind)[digits[p]]) ** 2).sum(axis=1).astype(object)
                text = ["".join(map(_HEX.__getitem__, row)) for row in digits.T.tolist()]
                yield pa.RecordBatch.from_arrays([ids.values, labels.values, pa.array(text, pa.string()), pa.array([e if e < 1 << 63 else None for e in error.tolist()], pa.int64())], ["vec_id", "label", "code", "error"])
        release()

    return run


_HEX = [f"{k:02x}" for k in range(256)]


def encode_vectors(vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every vector that isn't null and holds no null or non-finite component.

    Codebooks start from the vectors of the `entries` smallest ids (256 at most; ties of ids by the vectors, null ids last), or
    of all if there are fewer. The size of the first of them counts; vectors of another size, empty ones among them, are kept with null
    code, error and label_error. Parts are longer by one at the front if their number doesn't divide the size. Rows that repeat
    count each; ties go to the lower entry. An error beyond 64 bits is null, and so is its label's. An empty table gives an
    empty result; other columns are ignored.
    """
    if not 0 < entries <= 256:
        raise ValueError("entries must be 1 to 256")
    spark = vectors.sparkSession
    tune(spark)
    scratch = Scratch(spark, "vector-codes")
    rows = vectors.where(fit_rows(vector_col)).select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).alias("v"))
    ordered = [F.col("vec_id").asc_nulls_last(), F.col("v")]
    first = rows.where(F.size("v") > 0).orderBy(*ordered).limit(entries).collect()
    dim = len(first[0].v) if first else 0
    if any(len(r.v) != dim for r in first):
        first = rows.where(F.size("v") == dim).orderBy(*ordered).limit(entries).collect()
    whole = (F.size("v") == dim) & (F.size("v") > 0)
    chunks = scratch.table(rows.where(whole).mapInArrow(_chunks(dim, parts), "ids array<long>, labels array<string>, trees array<binary>"))
    books = train(chunks, [[_floor(float(x)) for x in r.v] for r in first], dim, parts, rounds)
    coded = scratch.table(chunks.mapInArrow(_coded(books, dim), "vec_id long, label string, code string, error long"))
    scratch.drop(chunks)
    sums = scratch.table(coded.groupBy("label").agg(F.count("*").alias("n"), F.when(F.count_if(F.col("error").isNull()) == 0, F.sum(F.col("error").cast("decimal(38,0)")).try_cast("long")).alias("label_error")))
    out = ["vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256")]
    left, total = coded.withColumnRenamed("label", "own"), sums.agg(F.count("*"), F.sum("n")).first()
    same = F.col("own").eqNullSafe(F.col("label"))
    # labels with at least one row in SEND_LABELS of all: as many at most, whatever the number of labels
    heavy = F.broadcast(sums.where(F.col("n") * SEND_LABELS >= (total[1] or 0)))
    done = left.join(heavy, same).select(*out)
    if total[0] > SEND_LABELS:
        done = done.unionAll(left.join(heavy, same, "left_anti").join(sums, same).select(*out))
    else:
        done = left.join(F.broadcast(sums), same).select(*out)
    none = F.lit(None)
    odd = rows.where(~whole).select("vec_id", none.cast("string").alias("code"), none.cast("long").alias("error"), none.cast("long").alias("label_error"), F.lit(books.sha256()).alias("codebooks_sha256"))
    return done.unionAll(odd)
