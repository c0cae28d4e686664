"""Size-tiered sharding: arrivals become small immutable shards, runs of similar size are merged to a target size, and a
versioned manifest is committed atomically.

A store is a folder that all executors share:

    data/<batch>/part-*.parquet    immutable shards
    manifest/<version>.json        a version: the store's schema, and its parts with the number of shards of each
    manifest/parts/<id>.json       up to PART shards each, with their sizes and tiers; immutable too

Parts are merged by tiers as shards are: FOLD parts of one tier become one. So an append reads the last version's list of
parts, which is short, and now and then the few parts that it merges, never the whole manifest.

The schema is the union of the arrivals', by name; shards written before a column came give nulls for it. An arrival
whose column has another type than the store's, or a name that differs by case only, is refused.

A version is written beside its place and put there by one step that fails if another writer was first: a hard link on
local file systems, a rename elsewhere (atomic on HDFS; on object stores the catalogue's put-if-absent has to take its
place). Readers take the highest version. Nothing is deleted but by vacuum: old versions, and files that no kept version
names, whoever left them, once they are old enough.
"""

from __future__ import annotations

import json
import math
import time
import uuid
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NullType, StringType, StructField, StructType

#: Bytes that a merged shard should have; shards of at least half of it are done.
TARGET = 128 << 20
#: A tier holds shards within a factor FANOUT of each other; as many of a tier are merged at once, at least.
FANOUT = 4
LEAST = 1 << 20
#: Shards that a part of the manifest lists; parts of one size that are merged into one, until they list so many.
PART, FOLD = 1000, 10
#: Seconds that files without a version are left alone: readers and writers may still need them.
RETAIN = 86_400


class Conflict(Exception):
    """Another writer has committed this version."""


def union_schema(a: StructType, b: StructType) -> StructType:
    """a's columns, then b's that a lacks, all nullable."""
    out, at = [StructField(f.name, f.dataType, True) for f in a], {f.name.lower(): f for f in a}
    for f in b:
        old = at.get(f.name.lower())
        if old is None:
            out.append(StructField(f.name, f.dataType, True))
        elif old.name != f.name or old.dataType.simpleString() != f.dataType.simpleString():
            raise ValueError(f"column {f.name} {f.dataType.simpleString()} clashes with {old.name} {old.dataType.simpleString()}")
    return StructType(out)


class ShardStore:
    def __init__(self, spark: SparkSession, root: str, target: int = TARGET, fanout: int = FANOUT):
        self.spark, self.root, self.target, self.fanout = spark, root.rstrip("/"), target, fanout
        self.jvm = spark._jvm
        self.fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def _get(self, name: str):
        stream = self.fs.open(self._path(f"{self.root}/manifest/{name}"))
        try:
            return json.loads(self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _put(self, name: str, value) -> None:
        out = self.fs.create(self._path(f"{self.root}/manifest/{name}"), False)
        try:
            out.write(bytearray(json.dumps(value).encode()))
        finally:
            out.close()

    def versions(self) -> list[int]:
        folder = self._path(f"{self.root}/manifest")
        if not self.fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self.fs.listStatus(folder)]
        return sorted(int(x[:-5]) for x in names if x.endswith(".json") and x[:-5].isdigit())

    def head(self, version: int | None = None) -> dict:
        """A version, the last one by default, without its shards: {"version", "schema", "parts": [[name, shards]]}."""
        known = self.versions() if version is None else []
        version = version if version is not None else (known[-1] if known else 0)
        return self._get(f"{version:012d}.json") if version else {"version": 0, "schema": StructType([]).jsonValue(), "parts": []}

    def manifest(self, version: int | None = None) -> dict:
        """A version with all its shards: head and "shards": [{"path", "bytes", "tier"}]."""
        got = self.head(version)
        return got | {"shards": [s for p, _ in got["parts"] for s in self._get(p)]}

    def parts(self, shards: list[dict]) -> list[list]:
        """Write parts that list these shards; their names and numbers of shards."""
        out = []
        for a in range(0, len(shards), PART):
            some = shards[a : a + PART]
            out.append([f"parts/{uuid.uuid4().hex}.json", len(some)])
            self._put(out[-1][0], some)
        return out

    def folded(self, parts: list[list]) -> list[list]:
        """The parts, those of a tier merged where there are FOLD of them: what a version lists grows with the logarithm of the appends,
        and by a part for each PART shards."""
        while True:
            tiers: dict[int, list] = {}
            for p in parts:
                if p[1] <= PART // FOLD:
                    tiers.setdefault(int(math.log(max(1, p[1]), FOLD) + 1e-9), []).append(p)
            group = next((g for _, g in sorted(tiers.items()) if len(g) >= FOLD), None)
            if group is None:
                return parts
            gone = {name for name, _ in group}
            parts = [p for p in parts if p[0] not in gone] + self.parts([s for name, _ in group for s in self._get(name)])

    def commit(self, base: int, schema: StructType, parts: list[list]) -> dict:
        """Put version base + 1 in place, or raise Conflict."""
        made = {"version": base + 1, "schema": schema.jsonValue(), "parts": parts}
        self.fs.mkdirs(self._path(f"{self.root}/manifest/parts"))
        draft, name = f".{uuid.uuid4().hex}", f"{base + 1:012d}.json"
        self._put(draft, made)
        draft, place = (self._path(f"{self.root}/manifest/{x}") for x in (draft, name))
        try:
            if self.fs.getScheme() == "file":
                link, file = (self.jvm.java.io.File(x.toUri().getPath()).toPath() for x in (place, draft))
                self.jvm.java.nio.file.Files.createLink(link, file)
                done = True
            else:
                done = not self.fs.exists(place) and self.fs.rename(draft, place)
        except Py4JJavaError as e:
            if "AlreadyExists" not in e.java_exception.getClass().getName():
                raise
            done = False
        finally:
            self.fs.delete(draft, False)
        if not done:
            raise Conflict(f"version {base + 1} exists")
        return made

    def tier(self, size: int) -> int:
        """0 up to LEAST bytes, then one more for each factor FANOUT."""
        return max(0, math.ceil(math.log(max(size, 1) / LEAST, self.fanout) - 1e-9))

    def _write(self, df: DataFrame) -> list[dict]:
        """Write df as a batch of its own; what files it gave, by name and size."""
        batch = f"{self.root}/data/{uuid.uuid4().hex}"
        df.write.parquet(batch)
        files = [(s.getPath().toString(), s.getLen()) for s in self.fs.listStatus(self._path(batch)) if s.getPath().getName().startswith("part-")]
        return [{"path": p, "bytes": n, "tier": self.tier(n)} for p, n in sorted(files)]

    def append(self, df: DataFrame) -> dict:
        """Add the rows of df as new shards, one for each of its partitions that has rows; no shuffle. Columns of the type
        void are stored as strings. Raises ValueError, and adds nothing, if the schema clashes with the store's, or has two
        columns of one name. Of the manifest it reads the last version's schema and names of parts, and what parts it merges."""
        if len({c.lower() for c in df.columns}) < len(df.columns):
            raise ValueError("two columns of one name")
        df = df.select(*(F.col(f"`{f.name}`").cast(StringType()).alias(f.name) if isinstance(f.dataType, NullType) else F.col(f"`{f.name}`") for f in df.schema))
        union_schema(StructType.fromJson(self.head()["schema"]), df.schema)
        self.fs.mkdirs(self._path(f"{self.root}/manifest/parts"))
        fresh = self.parts(self._write(df))
        while True:
            base = self.head()
            schema = union_schema(StructType.fromJson(base["schema"]), df.schema)
            try:
                return self.commit(base["version"], schema, self.folded(base["parts"] + fresh))
            except Conflict:  # another writer's version came: ours goes on top of it
                continue

    def runs(self, shards: list[dict]) -> list[list[dict]]:
        """Groups to merge: within a tier, from the smallest shard on, while they fit the target."""
        out = []
        for tier in sorted({s["tier"] for s in shards}):
            group, size = [], 0
            for s in sorted((s for s in shards if s["tier"] == tier and s["bytes"] < self.target // 2), key=lambda s: (s["bytes"], s["path"])):
                if group and size + s["bytes"] > self.target * 1.1:
                    out.append(group)
                    group, size = [], 0
                group.append(s)
                size += s["bytes"]
            if len(group) >= self.fanout:
                out.append(group)
        return [g for g in out if len(g) > 1]

    def compact(self, threads: int = 8) -> dict:
        """Merge runs until no tier has enough shards; each pass is one atomic commit. Appends meanwhile stay; if another
        compaction took some of the same shards, this one's files are left to vacuum and it starts again."""
        while groups := self.runs((base := self.manifest())["shards"]):
            schema = StructType.fromJson(base["schema"])
            with ThreadPoolExecutor(threads) as pool:
                merged = [s for m in pool.map(lambda g: self._merge(g, schema), groups) for s in m]
            gone = {s["path"] for g in groups for s in g}
            while True:
                now = self.manifest()
                if not gone <= {s["path"] for s in now["shards"]}:
                    break
                try:
                    self.commit(now["version"], StructType.fromJson(now["schema"]), self.parts([s for s in now["shards"] if s["path"] not in gone] + merged))
                    break
                except Conflict:
                    continue
        return self.manifest()

    def _merge(self, group: list[dict], schema: StructType) -> list[dict]:
        files = max(1, round(sum(s["bytes"] for s in group) / self.target))
        return self._write(self.spark.read.schema(schema).parquet(*[s["path"] for s in group]).coalesce(files))

    def _files(self, folder: str) -> list:
        path = self._path(f"{self.root}/{folder}")
        return list(self.fs.listStatus(path)) if self.fs.exists(path) else []

    def vacuum(self, keep_versions: int = 2, retain: float = RETAIN) -> int:
        """Delete all but the last keep_versions versions, and the shards and parts that no kept one names and that have
        not changed for `retain` seconds: those of failed writers too. How many shards went."""
        known, n, before = self.versions(), 0, (time.time() - retain) * 1000
        kept = [self.manifest(v) for v in known[-keep_versions:]]
        shards, parts = {s["path"] for m in kept for s in m["shards"]}, {p for m in kept for p, _ in m["parts"]}
        for v in known[:-keep_versions]:
            self.fs.delete(self._path(f"{self.root}/manifest/{v:012d}.json"), False)
        for s in [*self._files("manifest/parts"), *(x for x in self._files("manifest") if x.getPath().getName().startswith("."))]:
            if s.isFile() and f"parts/{s.getPath().getName()}" not in parts and s.getModificationTime() <= before:
                self.fs.delete(s.getPath(), False)
        for batch in self._files("data"):
            inside = list(self.fs.listStatus(batch.getPath()))
            here = [s for s in inside if s.getPath().getName().startswith("part-")]
            old = [s for s in here if s.getPath().toString() not in shards and s.getModificationTime() <= before]
            if len(old) == len(here) and all(s.getModificationTime() <= before for s in inside) and batch.getModificationTime() <= before:
                self.fs.delete(batch.getPath(), True)
            else:
                for s in old:
                    self.fs.delete(s.getPath(), False)
            n += len(old)
        return n

    def read(self, version: int | None = None) -> DataFrame | None:
        """The rows as of a version, with the columns of its schema; None for a store without shards."""
        got = self.manifest(version)
        paths = [s["path"] for s in got["shards"]]
        return self.spark.read.schema(StructType.fromJson(got["schema"])).parquet(*paths) if paths else None


def shard_table(docs: DataFrame, root: str, id_col: str = "doc_id", text_col: str = "text", target: int = TARGET, fanout: int = FANOUT) -> DataFrame:
    """Append docs to a new store, compact it, drop what compaction replaced, and read it back: (doc_id, shard, tier,
    shard_bytes, n_chars, text_md5).

    Every row is stored, whatever it holds: nulls in any column, empty or very long texts, repeated rows and any other
    columns, whatever their names (`_metadata` too; not two of one name). The result has a row for each, read from the
    shards of the last version. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    store = ShardStore(spark, root, target, fanout)
    store.append(docs)
    store.compact()
    store.vacuum(keep_versions=1, retain=0)  # nobody else reads this store
    rows = store.read()
    out = F.col(id_col).alias("doc_id"), F.length(text_col).cast("long").alias("n_chars"), F.md5(F.col(text_col).cast("binary")).alias("text_md5")
    if rows is None:
        return docs.limit(0).select(out[0], F.lit("").alias("shard"), F.lit(0).alias("tier"), F.lit(0).cast("long").alias("shard_bytes"), *out[1:])
    file = rows.metadataColumn("_metadata")
    size = file["file_size"]
    tier = F.greatest(F.lit(0), F.ceil(F.log(float(fanout), F.greatest(size, F.lit(1)) / LEAST) - 1e-9)).cast("int")
    return rows.select(out[0], file["file_name"].alias("shard"), tier.alias("tier"), size.alias("shard_bytes"), *out[1:])
