"""One JSON file a collection and format, in the corpus' order, put together from parts that many tasks write; and back.

    write_bundles   {collection}_{format}.json, byte by byte what json.dump(dict, file, indent=1) writes, zipped if asked for
    entries         the entries of zip files, from their directories alone
    read_bundles    a task an entry, by its byte range, with a JSON reader that holds one value at a time
"""

from __future__ import annotations

import codecs
import json
import posixpath
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions import small_batches
from folioforge.sources.mirror import filesystem

#: Bytes that are copied, or unpacked, at a time; bytes of values, and values, of a batch that is read.
CHUNK, BATCH_BYTES, BATCH_ROWS = 1 << 20, 4 << 20, 500


def one_each(df: DataFrame, keys: list[str], order: list[str], contents: list[str]) -> DataFrame:
    """As a dict is filled in the order given: a repeated key keeps its first place and takes its last contents."""
    if df.groupBy(*keys).count().where("count > 1").isEmpty():
        return df
    at = F.struct(*order)
    return df.groupBy(*keys).agg(F.min(at).alias("_at"), F.max_by(F.struct(*contents), at).alias("_last")).select(*keys, "_at.*", "_last.*")


def write_bundles(df: DataFrame, path: str, formats: dict[str, bool], order: list[str], collection: str = "collection", key: str = "url", zipped: bool = False, parts: int | None = None) -> None:
    """Write {collection}_{format}.json for every collection of df and each format, a column of df: {key: content} in the order
    of `order`, which must be unique within a collection (B10, L5). formats: whether all but ASCII is escaped. zipped: each in a
    zip file of its name with .zip behind. Null contents are null, a null collection is called `null`, null keys too. All files
    appear at once, by one rename; the folder must not exist.

    Rows are dealt over tasks by ranges of (collection, order); a task writes its run of each file, and files are put together
    by a task each, which copies the runs a piece at a time. No task holds more than a batch of rows.
    """
    small_batches(df.sparkSession)
    where, root = filesystem(path)
    if where.get_file_info(root).type != fs.FileType.NotFound:
        raise FileExistsError(path)
    staged = f"{path.rstrip('/')}-staged-{uuid.uuid4().hex}"
    base = filesystem(staged)[1]
    where.create_dir(f"{base}/parts", recursive=True)
    where.create_dir(f"{base}/files", recursive=True)
    names, contents = [*formats], [F.col(c).cast("string").alias(f"_c{k}") for k, c in enumerate(formats)]
    places = [F.col(c).alias(f"_o{k}") for k, c in enumerate(order)]
    rows = df.select(F.coalesce(F.col(collection).cast("string"), F.lit("null")).alias("_collection"), F.coalesce(F.col(key).cast("string"), F.lit("null")).alias("_key"), *places, *contents)
    held = [f"_o{k}" for k in range(len(order))]
    rows = one_each(rows, ["_collection", "_key"], held, [f"_c{k}" for k in range(len(formats))])
    n = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = rows.repartitionByRange(n, "_collection", *held).sortWithinPartitions("_collection", *held)
    sorted_ = sorted_.select("_collection", "_key", *(f"_c{k}" for k in range(len(formats))), F.spark_partition_id().alias("_p"))
    runs = sorted_.mapInArrow(_runs(staged, names, [*formats.values()]), "collection string, format string, p int, file string, n long")
    runs.write.parquet(f"{staged}/runs")
    written = df.sparkSession.read.schema("collection string, format string, p int, file string, n long").parquet(f"{staged}/runs")
    written.groupBy("collection", "format").applyInArrow(_assembled(staged, zipped), "file string, n long").write.format("noop").mode("overwrite").save()
    where.move(f"{base}/files", root)
    where.delete_dir(base)


def _runs(staged: str, names: list[str], ascii_only: list[bool]):
    def run(batches):
        where, base = filesystem(staged)
        now, streams, files, count = None, [], [], 0

        def closed() -> list[tuple]:
            for s in streams:
                s.close()
            return [(now, f, p, file, count) for f, file in zip(names, files, strict=True)] if files else []

        done, p = [], 0
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for row in zip(*columns, strict=True):
                if row[0] != now or not files:
                    done += closed()
                    now, p, count = row[0], row[-1], 0
                    files = [f"{base}/parts/{uuid.uuid4().hex}" for _ in names]
                    streams = [where.open_output_stream(f, buffer_size=CHUNK) for f in files]
                k = json.dumps(row[1])
                for s, plain, value, ascii_ in zip(streams, [row[1]] * len(names), row[2:-1], ascii_only, strict=True):
                    s.write(f"{',' if count else ''}\n {k if ascii_ else json.dumps(plain, ensure_ascii=False)}: {json.dumps(value, ensure_ascii=ascii_)}".encode())
                count += 1
        done += closed()
        if done:
            types = (pa.string(), pa.string(), pa.int32(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), types, strict=True)], ["collection", "format", "p", "file", "n"])

    return run


def _assembled(staged: str, zipped: bool):
    def run(runs: pa.Table) -> pa.Table:
        where, base = filesystem(staged)
        rows = sorted(runs.to_pylist(), key=lambda r: r["p"])
        name = f"{rows[0]['collection']}_{rows[0]['format']}.json"
        if "/" in name or "\\" in name:
            raise ValueError(f"not a file's name: {name!r}")

        def copy(out) -> None:
            out.write(b"{")
            for k, r in enumerate(rows):
                if k:
                    out.write(b",")
                with where.open_input_stream(r["file"]) as f:
                    while piece := f.read(CHUNK):
                        out.write(piece)
            out.write(b"\n}")

        file = f"{base}/files/{name}{'.zip' if zipped else ''}"
        temporary = f"{base}/parts/{uuid.uuid4().hex}"
        with where.open_output_stream(temporary) as out:
            if zipped:
                entry = zipfile.ZipInfo(name)
                entry.compress_type = zipfile.ZIP_DEFLATED
                with zipfile.ZipFile(out, "w") as z, z.open(entry, "w", force_zip64=True) as member:
                    copy(member)
            else:
                copy(out)
        where.move(temporary, file)
        return pa.table({"file": pa.array([name]), "n": pa.array([sum(r["n"] for r in rows)], pa.int64())})

    return run


def entries(spark: SparkSession, path: str) -> DataFrame:
    """(file, member, at, packed, method) of the entries of zip files in a folder, or of one: a file's directory is read, not
    its contents. at: where the entry's header is; packed: its bytes; method: 0 as they are, 8 deflated, others raise an error when read."""
    files = spark.read.format("binaryFile").load(path).select("path")  # no contents: they aren't asked for

    def run(batches):
        for batch in batches:
            for name in batch.column(0).to_pylist():
                where, at = filesystem(name)
                with where.open_input_file(at) as f, zipfile.ZipFile(f) as z:
                    found = [(name, i.filename, i.header_offset, i.compress_size, i.compress_type) for i in z.infolist() if not i.is_dir()]
                for a in range(0, len(found), 10_000):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found[a : a + 10_000], strict=True), (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int32()), strict=True)], ["file", "member", "at", "packed", "method"])

    return files.mapInArrow(run, "file string, member string, at long, packed long, method int")


def _unpacked(where: fs.FileSystem, file: str, at: int, packed: int, method: int) -> Iterator[bytes]:
    """The bytes of an entry, a piece at a time."""
    if method not in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED):
        raise ValueError(f"compression {method} is not supported")
    with where.open_input_file(file) as f:
        f.seek(at)
        head = f.read(30)  # signature to lengths of name and extra field
        if head[:4] != b"PK\x03\x04":
            raise ValueError(f"no entry at {at} of {file}")
        f.seek(at + 30 + int.from_bytes(head[26:28], "little") + int.from_bytes(head[28:30], "little"))
        z = zlib.decompressobj(-15) if method else None
        while packed > 0 and (piece := f.read(min(CHUNK, packed))):
            packed -= len(piece)
            while z and piece:
                yield z.decompress(piece, CHUNK)
                piece = z.unconsumed_tail
            if not z:
                yield piece
        if packed:
            raise ValueError(f"entry at {at} of {file} is cut short")
        if z:
            yield z.flush()


_SPACE = " \t\n\r"


def pairs(pieces: Iterator[bytes]) -> Iterator[tuple[str, str | None]]:
    """Keys and values of a JSON object as its bytes come: no more than a piece and a value is held. Values that aren't text
    come as JSON, null as None. Raises ValueError for anything else, and for an object without its end."""
    decode, read = json.JSONDecoder().raw_decode, codecs.getincrementaldecoder("utf-8")()
    buffer, at, ended = "", 0, False

    def more() -> bool:
        nonlocal buffer, at, ended
        if ended:
            return False
        got = next(pieces, None)
        ended = got is None
        buffer, at = buffer[at:] + read.decode(got or b"", ended), 0
        return True

    def sign() -> str:
        """The next character that isn't white space, which is passed."""
        nonlocal at
        while True:
            while at < len(buffer) and buffer[at] in _SPACE:
                at += 1
            if at < len(buffer):
                at += 1
                return buffer[at - 1]
            if not more():
                raise ValueError("the object has no end")

    def value():
        nonlocal at
        sign()
        at -= 1
        wanted = 0
        while True:
            if len(buffer) - at >= wanted:  # tried again when there is twice as much
                try:
                    got, end = decode(buffer, at)
                    if isinstance(got, str) or end < len(buffer):  # a number may go on
                        at = end
                        return got
                except json.JSONDecodeError:
                    if ended:
                        raise
                wanted = 2 * (len(buffer) - at)
            if not more():
                raise ValueError("the object has no end")
            wanted = 0 if ended else wanted

    if sign() != "{":
        raise ValueError("not an object")
    c = sign()
    while c != "}":
        at -= 1
        key = value()
        if not isinstance(key, str) or sign() != ":":
            raise ValueError("not a key")
        got = value()
        yield key, got if got is None or isinstance(got, str) else json.dumps(got)
        c = sign()
        if c == ",":
            c = sign()
            if c != '"':
                raise ValueError("not a key")
        elif c != "}":
            raise ValueError("no comma")


def read_bundles(spark: SparkSession, path: str, tasks: int | None = None) -> DataFrame:
    """(member, place, url, content) of the JSON objects in zip files, or in .json files, of a folder, or of one file (A10): an
    entry is read by one task, in its order, which place gives from 0. Entries are dealt over `tasks` by a hash of their names."""
    where, root = filesystem(path)
    alone = where.get_file_info(root).type == fs.FileType.File
    names = [root] if alone else [f.path for f in where.get_file_info(fs.FileSelector(root))]
    found = []
    if any(x.endswith(".zip") for x in names):
        found.append(entries(spark, path if alone else f"{path}/*.zip"))
    if any(x.endswith(".json") for x in names):
        files = spark.read.format("binaryFile").load(path if alone else f"{path}/*.json")
        found.append(files.select(F.col("path").alias("file"), F.element_at(F.split("path", "/"), -1).alias("member"), F.lit(0).cast("long").alias("at"), F.col("length").alias("packed"), F.lit(-1).alias("method")))
    if not found:
        return spark.createDataFrame([], "member string, place long, url string, content string")
    every = found[0] if len(found) == 1 else found[0].unionByName(found[1])
    n = tasks or spark.sparkContext.defaultParallelism

    def run(batches):
        for batch in batches:
            for file, member, at, packed, method in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                where, kept = filesystem(file)
                pieces = _whole(where, kept) if method < 0 else _unpacked(where, kept, at, packed, method)
                urls, contents, size, place = [], [], 0, 0
                for url, content in pairs(pieces):
                    urls.append(url)
                    contents.append(content)
                    size += len(content or "")
                    if size >= BATCH_BYTES or len(urls) >= BATCH_ROWS:
                        yield _rows(member, place, urls, contents)
                        urls, contents, size, place = [], [], 0, place + len(urls)
                if urls:
                    yield _rows(member, place, urls, contents)

    dealt = every.repartition(n, F.xxhash64("file", "member")).select("file", "member", "at", "packed", "method")
    return dealt.mapInArrow(run, "member string, place long, url string, content string")


def _whole(where: fs.FileSystem, file: str) -> Iterator[bytes]:
    with where.open_input_stream(file) as f:
        while piece := f.read(CHUNK):
            yield piece


def _rows(member: str, place: int, urls: list, contents: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([member] * len(urls), pa.string()), pa.array(range(place, place + len(urls)), pa.int64()), pa.array(urls, pa.string()), pa.array(contents, pa.string())], ["member", "place", "url", "content"]
    )
