"""MinHash near-duplicates: fast similarity sketches, banding, and confirmation on the full shingle sets.

A sketch has T coordinates. In round i < T every shingle falls into one hashed bin with the value (i, hash); round
T + b puts every shingle into bin b. A bin keeps its least value, so rounds after all bins are filled change nothing,
and every coordinate fills. Two sets agree in a coordinate with a probability equal to their Jaccard similarity, with
the concentration of independent draws. B bands of R coordinates make candidates: at a similarity of 0.85 a pair is
missed in all bands with probability (1 - 0.85^R)^B, below 1e-8 with R = 6 and B = 40.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.llm.common import Scratch, mix64, over_texts, release, tune, word_hashes
from folioforge.llm.components import components

BANDS, ROWS = 40, 6
T = BANDS * ROWS
#: Ids up to this number are sent to all executors (16 MB); beyond it the texts are dealt by id.
SEND_IDS = 2_000_000
#: Bytes of text that are turned into shingles at a time.
SLICE = 1 << 19
#: Pairs that one copy of a leader's set is joined with, and members of a bucket that are compared within one cell; larger groups go in parts.
PAIRS, CELL = 4096, 1024
#: One-bit coordinates of the finer sketch, and the standard deviations that a pair may lie below what is asked for.
FINE, DEVIATIONS = 2048, 5.5

_U = np.uint64
_FULL = _U(0xFFFFFFFFFFFFFFFF)
_ROUND = mix64(np.arange(1, 2 * FINE + 1, dtype=_U) * _U(0xD1B54A32D192ED03))


def shingle_sets(data: np.ndarray, offs: np.ndarray, words: int) -> list[np.ndarray]:
    """For each text the sorted distinct 64-bit hashes of its shingles of `words` lower-cased words."""
    hashed, start, _ = word_hashes(data, offs)
    bounds = np.searchsorted(start, offs)
    run = hashed[: max(0, len(hashed) - words + 1)]
    for k in range(1, words):
        run = mix64(run * _U(3) + hashed[k : k + len(run)])
    out = []
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if b - a >= words:
            out.append(np.unique(run[a : b - words + 1]))
        elif b > a:  # the whole sequence is the one shingle; its length keeps it apart from longer ones
            h = np.array([b - a], _U)
            for x in hashed[a:b]:
                h = mix64(h * _U(5) + x)
            out.append(h)
        else:
            out.append(np.zeros(0, _U))
    return out


def sketch(elements: np.ndarray, size: int = T) -> np.ndarray:
    """The coordinates, each (round << 32) | 32 bits of hash."""
    out = np.full(size, _FULL)
    n = len(elements)
    step = max(1, min(size, math.ceil(1.3 * size * math.log(size) / n), (1 << 18) // n))
    for at in range(0, size, step):
        rounds = np.arange(at, min(size, at + step), dtype=_U)
        h = mix64(elements[None, :] ^ _ROUND[at : at + len(rounds), None])
        bins = ((h >> _U(32)) * _U(size)) >> _U(32)
        np.minimum.at(out, bins.ravel().astype(np.int64), ((rounds[:, None] << _U(32)) | (h & _U(0xFFFFFFFF))).ravel())
        if out.max() != _FULL:
            return out
    for b in np.flatnonzero(out == _FULL):
        out[b] = (_U(size + b) << _U(32)) | (mix64(elements ^ _ROUND[size + b]) & _U(0xFFFFFFFF)).min()
    return out


def band_keys(sketched: np.ndarray) -> np.ndarray:
    grid = sketched.reshape(BANDS, ROWS)
    key = np.arange(1, BANDS + 1, dtype=_U)
    for k in range(ROWS):
        key = mix64(key * _U(3) + grid[:, k])
    return key.view(np.int64)


def _signer(words: int):
    def sign(ids, data, offs):
        sets = shingle_sets(data, offs, words)
        keep = [len(s) > 0 for s in sets]
        return [
            ids,
            pa.array([len(s) for s in sets], pa.int64()),
            pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if k else None for s, k in zip(sets, keep, strict=True)], pa.binary()),
            pa.array([band_keys(sketch(s)) if k else None for s, k in zip(sets, keep, strict=True)], pa.list_(pa.int64())),
        ]

    return lambda: sign


def _finer(words: int):
    """FINE one-bit coordinates as longs, and the band keys again."""

    def f(ids, data, offs):
        sets = shingle_sets(data, offs, words)
        bits = [np.packbits((sketch(s, FINE) & _U(1)).astype(np.uint8)).view(np.int64) if len(s) else None for s in sets]
        return [ids, pa.array(bits, pa.list_(pa.int64())), pa.array([band_keys(sketch(s)) if len(s) else None for s in sets], pa.list_(pa.int64()))]

    return lambda: f


def agreeing(num: int, den: int) -> int:
    """One-bit coordinates in which a pair of the least similarity agrees, less DEVIATIONS: a bit agrees with probability (1 + J) / 2."""
    p = (1 + num / den) / 2
    return math.floor(FINE * p - DEVIATIONS * math.sqrt(FINE * p * (1 - p)))


def _setter(words: int):
    return lambda: lambda ids, data, offs: [ids, pa.array([s.tobytes() for s in shingle_sets(data, offs, words)], pa.binary())]


def _confirmer(num: int, den: int):
    """Pairs with den * |A & B| >= num * |A | B|."""

    def run(batches):
        for batch in batches:
            a, b, left, right = (batch.column(i) for i in range(4))
            good = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                x, y = np.frombuffer(left[i].as_buffer(), _U), np.frombuffer(right[i].as_buffer(), _U)
                if den * min(len(x), len(y)) >= num * max(len(x), len(y)):
                    both = np.sort(np.concatenate((x, y)))
                    common = int(np.count_nonzero(both[1:] == both[:-1]))
                    good[i] = den * common >= num * (len(x) + len(y) - common)
            yield pa.RecordBatch.from_arrays([a, b], ["a", "b"]).filter(pa.array(good))
        release()

    return run


def in_parts(df: DataFrame, key: str, size: int, scratch: Scratch) -> DataFrame | None:
    """df with `_parts`: in how many parts the rows of its key go, 1 for keys of up to `size` rows; None if that is all of
    them. Only the larger ones are joined."""
    counts = df.groupBy(key).agg(F.count("*").alias("_k"))
    if (counts.agg(F.max("_k")).first()[0] or 0) <= size:
        return None
    large = scratch.table(counts.where(F.col("_k") > size).select(key, F.ceil(F.col("_k") / size).cast("int").alias("_parts")))
    return df.join(F.broadcast(large) if large.count() <= SEND_IDS else large, key, "left").withColumn("_parts", F.coalesce("_parts", F.lit(1)))


def link_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of docs.

    Texts with equal shingle sets form a class, and one document of each class is banded, so exact copies cost one
    row each. In each bucket of a band all members are compared with the smallest one, which joins nearly all near
    copies of a group at the cost of a row a member. What is left are pairs of members of one bucket in different
    components: those that finer sketches don't rule out are compared too, each once. No pair is left out otherwise.

    Null or empty texts and texts of white space have no shingles: n_shingles 0, a component of their own. Rows that
    share an id are one document: they get one component. A null id is linked with nothing: its component_id is null
    and it is kept. Texts of any length are read whole, one at a time if they are long. An empty table gives an empty
    result. Other columns are ignored, whatever their names.
    """
    spark = docs.sparkSession
    tune(spark)
    scratch = Scratch(spark, "minhash")
    signed = scratch.table(over_texts(docs, id_col, text_col, _signer(words), "doc_id long, n_shingles long, cls binary, bands array<long>", limit=SLICE))
    classes = scratch.table(signed.where("cls is not null and doc_id is not null").groupBy("cls").agg(F.min("doc_id").alias("rep"), F.any_value("bands").alias("bands")))
    rows = classes.select("rep", F.explode("bands").alias("key"))
    buckets = rows.groupBy("key").agg(F.min("rep").alias("leader"), F.max("rep").alias("last")).where("leader < last").select("key", "leader")
    members = scratch.table(rows.join(buckets, "key"))

    def texts_of(ids: DataFrame) -> DataFrame:
        text = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
        return text.join(F.broadcast(ids) if ids.count() <= SEND_IDS else ids, "_id", "left_semi")

    def confirm(pairs: DataFrame) -> DataFrame:
        pairs = scratch.table(pairs)
        ids = scratch.table(pairs.select(F.col("a").alias("_id")).unionByName(pairs.select(F.col("b").alias("_id"))).distinct())
        sets = scratch.table(over_texts(texts_of(ids), "_id", "_text", _setter(words), "doc_id long, s binary", limit=SLICE))
        left = sets.select(F.col("doc_id").alias("a"), F.col("s").alias("left"))
        on, parted = ["a"], in_parts(pairs, "a", PAIRS, scratch)
        if parted is not None:  # the set of a document with many pairs is copied, so that no task gets all of them
            pairs = scratch.table(parted.withColumn("part", F.pmod(F.xxhash64("b"), F.col("_parts")).cast("int")).select("a", "b", "part"))
            left, on = left.join(pairs.select("a", "part").distinct(), "a"), ["a", "part"]
        joined = pairs.join(sets.select(F.col("doc_id").alias("b"), F.col("s").alias("right")), "b").join(left, on)
        out = scratch.table(joined.select("a", "b", "left", "right").mapInArrow(_confirmer(num, den), "a long, b long"))
        scratch.drop(pairs, ids, sets)
        return out

    edges = confirm(members.where("rep != leader").select(F.col("leader").alias("a"), F.col("rep").alias("b")).distinct())
    # rows that share an id link the classes that they are in
    repeated = signed.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id")
    shared = signed.where("cls is not null").join(repeated, "doc_id", "left_semi").join(classes, "cls").select(F.col("rep").alias("a"), F.col("doc_id").alias("b")).distinct()
    found = components(edges.unionByName(shared), scratch)
    placed = scratch.table(members.where("rep != leader").join(found.withColumnRenamed("node", "rep"), "rep", "left").select("key", "rep", F.coalesce("comp", "rep").alias("comp")))
    open_ = placed.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("key")
    rest = scratch.table(placed.join(open_, "key", "left_semi"))
    if not rest.isEmpty():
        ids = scratch.table(rest.select(F.col("rep").alias("_id")).distinct())
        fine = scratch.table(over_texts(texts_of(ids), "_id", "_text", _finer(words), "rep long, bits array<long>, bands array<long>", limit=SLICE))
        # a column a word: their comparison stays small enough to be compiled
        words_ = [F.coalesce(F.col("bits")[k], F.lit(0)).alias(f"w{k}") for k in range(FINE // 64)]
        rest = scratch.table(rest.join(fine, "rep").select("key", "rep", "comp", "bands", *words_)).select("key", "rep", "comp", "bands", *(F.coalesce(f"w{k}", F.lit(0)).alias(f"w{k}") for k in range(FINE // 64)))
        cell, parted = F.lit(True), in_parts(rest, "key", CELL, scratch)
        if parted is not None:  # a large bucket is cut into a square of cells, of which each task takes one
            rest = parted.withColumn("chunk", F.pmod(F.xxhash64("rep"), F.col("_parts")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
            rest = rest.withColumns({"lo": F.least("chunk", "other"), "hi": F.greatest("chunk", "other")})
            cell = (F.col("x.lo") == F.col("y.lo")) & (F.col("x.hi") == F.col("y.hi")) & ((F.col("x.lo") == F.col("x.hi")) | (F.col("x.chunk") != F.col("y.chunk")))
        x, y = rest.alias("x"), rest.alias("y")
        apart = sum((F.bit_count(F.col(f"x.w{k}").bitwiseXOR(F.col(f"y.w{k}"))) for k in range(FINE // 64)), F.lit(0))
        # a pair that is still possible, in the first of the buckets that it shares
        first = F.array_min(F.array_intersect("x.bands", "y.bands")) == F.col("x.key")
        pairs = x.join(y, (F.col("x.key") == F.col("y.key")) & cell & (F.col("x.rep") < F.col("y.rep")) & (F.col("x.comp") != F.col("y.comp")) & (apart <= FINE - agreeing(num, den)) & first)
        more = confirm(pairs.select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b")).distinct())
        if not more.isEmpty():
            found = components(found.select(F.col("node").alias("a"), F.col("comp").alias("b")).unionByName(more), scratch)
    of_class = scratch.table(classes.select("cls", "rep").join(found.withColumnRenamed("node", "rep"), "rep", "left").select("cls", F.coalesce("comp", "rep").alias("component_id")))
    lone = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return (
        signed.select("doc_id", "n_shingles", "cls")
        .join(of_class, "cls", "left")
        .select("doc_id", "n_shingles", lone.alias("component_id"))
        .withColumn("kept", F.col("doc_id").isNull() | (F.col("doc_id") == F.col("component_id")))
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """Rows of docs less all but one document of each component. Of rows that share an id and a text one stays; rows that
    share an id only are one document, and stay or go together. Nulls and empty tables as in link_documents."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "near-copies")
    links = scratch.table(link_documents(docs, id_col, text_col, words, num, den).select(F.col("doc_id").alias("_kept_id"), "kept"))
    gone = scratch.table(links.where("not kept").select("_kept_id").distinct())
    out = docs.join(F.broadcast(gone) if gone.count() <= SEND_IDS else gone, docs[id_col].cast("long") == gone["_kept_id"], "left_anti")
    if links.where("_kept_id is not null").groupBy("_kept_id").count().where("count > 1").isEmpty():
        return out
    return out.where(F.col(id_col).isNotNull()).dropDuplicates([id_col, text_col]).unionByName(out.where(F.col(id_col).isNull()))
