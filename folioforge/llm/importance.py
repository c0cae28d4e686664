"""Target-distribution importance resampling over hashed n-grams: documents that look like the target are likelier drawn.

A scan of a document holds the CRC states of the last n starts; each word extends every state by a space and its bytes, so a
run's bucket is there when its last word is read, and no n-gram is ever built. Counts by bucket, of the documents and of the
target, give each bucket a gain; a document's weight is the mean gain of its features, and independent Gumbel noise added to
the weights turns the highest scores into a draw without replacement.

Texts are scanned twice, for the corpus' counts and for the weights: buckets kept from the first scan would be as large as the texts.
"""

from __future__ import annotations

import math
import re
from array import array
from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioforge.llm.common import Scratch, over_texts, payload, release, tune

#: Digits, lower-case letters and all bytes of characters outside ASCII; texts are lower-cased first, A-Z only.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
#: Features that are held at a time.
PIECE = 1 << 16


def ring(text: bytes, n: int) -> Iterator[tuple[array, int]]:
    """CRC-32 of all runs of 1 to n words of the text, some PIECE at a time, and how many words each piece has."""
    states: list[int] = []  # of the runs that end at the last word, by length
    out, count = array("I"), 0
    for m in _WORD.finditer(text.lower()):
        word = m[0]
        spaced = b" " + word
        states = [crc32(word), *[crc32(spaced, s) for s in states]][:n] if n > 2 else [crc32(word), crc32(spaced, states[0])] if states and n == 2 else [crc32(word)]
        out.extend(states)
        count += 1
        if len(out) >= PIECE:
            yield out, count
            out, count = array("I"), 0
    if count:
        yield out, count


def bucket_counts(table: DataFrame, text_col: str, n: int, buckets: int) -> np.ndarray:
    """Features of all rows by bucket. Each task adds its own up and sends one row a bucket at most."""

    def count(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            data, offs = payload(batch.column(0))
            raw = data.tobytes()
            for a, b in zip(offs[:-1], offs[1:], strict=True):
                for crcs, _ in ring(raw[a:b], n):
                    total += np.bincount(np.frombuffer(crcs, np.uint32) % buckets, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["bucket", "n"])
        release()

    counts = table.select(F.col(text_col).cast("string").alias("_text")).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for bucket, k in counts.collect():  # `buckets` rows at most
        out[bucket] = k
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of the target's and the corpus' smoothed shares, by bucket, rounded down."""
    all_s, all_t, m = int(corpus.sum()), int(target.sum()), len(corpus)
    return np.array([math.floor(1000 * math.log(((t + 1) * float(all_s + m)) / ((s + 1) * float(all_t + m)))) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def weighed(docs: DataFrame, gain: np.ndarray, n: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(gain)  # a number a bucket

    def make() -> Callable:
        g = sent.value

        def f(ids, data, offs):
            raw, size = data.tobytes(), len(offs) - 1
            words, features, total = np.zeros(size, np.int64), np.zeros(size, np.int64), [0] * size
            for k, (a, b) in enumerate(zip(offs[:-1], offs[1:], strict=True)):
                for crcs, count in ring(raw[a:b], n):
                    words[k] += count
                    features[k] += len(crcs)
                    total[k] += int(g[np.frombuffer(crcs, np.uint32) % len(g)].sum())
            return [ids, pa.array(words), pa.array(features), pa.array([t // max(1, int(c)) for t, c in zip(total, features, strict=True)], pa.int64())]

        return f

    return over_texts(docs, id_col, text_col, make, "doc_id long, n_words long, n_features long, weight long")


def resample(docs: DataFrame, target: DataFrame, n: int = 2, buckets: int = 10_000, least: int = 20, num: int = 25, den: int = 100, seed: int = 7, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text") -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row. Of the documents with `least` words or more, num in den are
    drawn, by score; rank is 1 on among those and null for the others. Ties of scores go to the smaller doc_id, null ids last.

    Null and empty texts have no features and weight 0. Rows that repeat or share an id are each ranked; those with equal
    scores and ids take neighbouring ranks. The noise of a row without an id is that of an empty id. An empty table gives an
    empty result, an empty target T = 0; other columns are ignored. Texts are scanned as they are read, however long.
    """
    spark = docs.sparkSession
    tune(spark)
    gain = gains(bucket_counts(docs, text_col, n, buckets), bucket_counts(target, target_col, n, buckets))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))
    scratch = Scratch(spark, "resampled")
    rows = scratch.table(weighed(docs, gain, n, id_col, text_col).withColumn("score", F.col("weight") + noise))
    fit = rows.where(F.col("n_words") >= least).select("doc_id", "n_features", "weight", "score")
    drawn = fit.count() * num // den
    # ranks: places within range partitions, and the rows of the partitions before; equal rows are spread by a last key
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features"), F.col("weight"), F.col("tie")
    sorted_ = scratch.table(fit.withColumn("tie", F.rand(seed)).repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("tie").withColumn("m", F.monotonically_increasing_id()))
    before = Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    ahead = sorted_.groupBy(F.shiftright("m", 33).alias("p")).agg(F.count("*").alias("n")).select("p", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))  # a row a partition
    place = F.col("ahead") + F.col("m").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    ranked = sorted_.join(F.broadcast(ahead), F.shiftright("m", 33) == F.col("p")).select("doc_id", "n_features", "weight", "score", F.when(place <= drawn, place).alias("rank"))
    rest = rows.where(F.col("n_words") < least).select("doc_id", "n_features", "weight", "score", F.lit(None).cast("long").alias("rank"))
    return ranked.unionAll(rest)
