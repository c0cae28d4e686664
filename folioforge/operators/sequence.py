"""Digests of sequences that can be put together: whether two tables hold the same keys in the same order, without a sort or a
join. A run's digest is a polynomial in the hashes of its keys; that of two runs, one behind the other, follows from theirs."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A prime, and the place at which polynomials are taken. Two sequences that differ have one digest with a probability of about n / PRIME.
PRIME, BASE = (1 << 127) - 1, 0x5BD1E9955BD1E9955BD1E9955BD1E995 % ((1 << 127) - 1)


def element(key: str | None) -> int:
    """The hash of one key; null isn't the empty text."""
    return int.from_bytes(hashlib.blake2b(b"\x00" if key is None else b"\x01" + key.encode(), digest_size=16).digest(), "big") % PRIME


def joined(a: tuple[int, int], b: tuple[int, int]) -> tuple[int, int]:
    """(n, digest) of run a with run b behind it."""
    return a[0] + b[0], (a[1] * pow(BASE, b[0], PRIME) + b[1]) % PRIME


def runs(rows: DataFrame, key: str, segment: list[Column]) -> DataFrame:
    """(segment, first, n, digest) of the runs of rows that stand together in a partition and share a segment, in the order in
    which they are read. segment: text columns that put the runs of a table in order; first: to tell runs of one segment in a
    partition apart. Only these columns are read."""

    def run(batches):
        now, n, d, count, out = None, 0, 0, 0, []
        for batch in batches:
            for part, k in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if part != now:
                    if n:
                        out.append((now, count, n, str(d)))
                    now, n, d, count = part, 0, 0, count + 1
                n, d = n + 1, (d * BASE + element(k)) % PRIME
        if n:
            out.append((now, count, n, str(d)))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)], ["segment", "first", "n", "digest"])

    text = F.concat_ws("\u0000", *segment)
    return rows.select(text.alias("segment"), F.col(key).cast("string").alias("key")).mapInArrow(run, "segment string, first long, n long, digest string")


def whole(runs_: DataFrame) -> tuple[int, str]:
    """(n, digest) of a table from those of its runs: a short row for each file's run, put together in their order."""
    total = (0, 0)
    for r in runs_.orderBy("segment", "first").select("n", "digest").toLocalIterator():
        total = joined(total, (r.n, int(r.digest)))
    return total[0], f"{total[1]:032x}"


def of_files(rows: DataFrame, key: str) -> DataFrame:
    """Runs of a table that is read from files, in the order of the files' names and of the rows in them."""
    m = rows.metadataColumn("_metadata")
    return runs(rows, key, [m["file_name"], F.lpad(m["file_block_start"].cast("string"), 20, "0")])


def of_members(rows: DataFrame, key: str, domain: list[str], end: Column) -> DataFrame:
    """Runs of bundles as they are read, those of members with another end apart: a segment starts with the end. Members, named
    {value}{end}, come in the order of the domain's values, others last, by name."""
    value = F.expr("substring(member, 1, length(member) - length(_end))")
    at = F.array_position(F.array(*map(F.lit, domain)), value)
    rows = rows.withColumn("_end", end)
    return runs(rows, key, [F.col("_end"), F.lpad(F.when(at > 0, at).otherwise(len(domain) + 1).cast("string"), 6, "0"), F.col("member")])
