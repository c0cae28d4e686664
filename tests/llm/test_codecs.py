"""The piece codec against the library, media round trips, the shard store, and the mix."""

import hashlib
import random
import uuid
import zlib
from collections import Counter
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from folioforge.llm import jpeg_media as J
from folioforge.llm import mixing, piece_codec, sharding
from folioforge.llm import queries as llm_queries
from folioforge.llm.common import shared_folder

ODD = ["", " ", "  a  b ", "a\tb\nc", "　x", "ﬁ é é", "<s>hi</s> <unk>", "\x00a", "▁a ▁", "<0x0A>", "▁▁▁▁x     y", "a" * 3000, "日本語😀😀 🇫🇷", " \n \n\n  ", "----====" * 9, "\n", "a \nb", "a\n b", "word " * 20_000]


def test_ids_are_those_of_the_library(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=piece_codec.default_model())
    rng = random.Random(1)
    bits = ["a", "e", "th", " ", "  ", "▁", "\n", "\t", "é", "中", "😀", "the", "er", "----", "0", "12", "A", "The", "ing", "str"]
    texts = ODD + ["".join(rng.choice(bits) for _ in range(rng.randint(1, 60))) for _ in range(1500)] + [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    m = piece_codec.PieceModel(piece_codec.default_model())
    ids = [m.encode(t) for t in texts]
    assert ids == sp.encode(texts)
    assert [m.decode(i) for i in ids] == [sp.decode(i) for i in ids]


def test_encoded_rows(spark):
    rows = [(1, "a b"), (1, "a b"), (2, None), (None, "x"), (3, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_tokens", F.lit("clash")).withColumn("_id", F.lit(0))
    got = sorted((str(r.doc_id), r.n_tokens, r.ids, r.decoded) for r in piece_codec.encode_documents(df).collect())
    sp = sentencepiece.SentencePieceProcessor(model_file=piece_codec.default_model())
    assert got == sorted((str(k), len(i := sp.encode(t or "")), i, t or "") for k, t in rows)
    r = piece_codec.encode_digests(df).where("doc_id = 1").first()
    assert r.ids_sha256 == hashlib.sha256(",".join(map(str, sp.encode("a b"))).encode()).hexdigest() and r.decoded_sha256 == hashlib.sha256(b"a b").hexdigest()
    assert piece_codec.encode_digests(df.limit(0)).count() == 0


def test_media_round_trip(spark):
    rng = np.random.default_rng(0)
    rows = [(k, t) for k, t in enumerate(ODD)] + [(50, None), (50, None), (None, "x"), (51, "y" * 70_000), (52, "\x00\x00q" + "\x00" * 90 + "z")]
    rows += [(100 + k, "".join(map(chr, rng.integers(1, 3000, rng.integers(1, 300))))) for k in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("media", F.lit("clash"))
    got = J.media_features(J.to_media(df)).collect()
    assert len(got) == len(rows)
    by_text = {}
    for r, (_, text) in zip(sorted(got, key=lambda r: (r.doc_id is None, r.doc_id)), sorted(rows, key=lambda r: (r[0] is None, r[0])), strict=True):
        raw = (text or "").encode()
        stored = raw + bytes(max(64, -(-len(raw) // 64) * 64) - len(raw))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(stored), hashlib.sha256(stored).hexdigest(), zlib.crc32(stored[-64:]))
        assert by_text.setdefault(raw, (r.media_sha256, r.feature)) == (r.media_sha256, r.feature)
    assert J.media_features(J.to_media(df.limit(0))).count() == 0


def test_both_decoders_agree_and_damage_is_null():
    texts = [b"abc" * 100, b"", bytes(range(256)) * 3]
    files = J.write_payloads(np.frombuffer(b"".join(texts), np.uint8), np.array([0, 300, 300, 1068]))
    for f, (payload, feature) in zip(files, J.read_media(files), strict=True):
        p = J.parse(f)
        assert J._finish(p, J.decode_blocks(f, p)[1]) == (payload, feature)
    bad = [b"", b"not a picture", files[0][:300], files[2][:-20], files[0]]
    got = J.read_media(bad)
    assert got[0] == got[1] == got[2] == (None, None) and got[4][0] == texts[0] + bytes(20)


def decoded_by_the_standard(file: bytes) -> tuple[int, int, list[list[int]]]:
    """Width, height and quantised coefficients (in zigzag order, a list a block) of a grey baseline JPEG, bit by bit from
    the standard's text alone: no code or table of the operator is used."""
    assert file[:2] == b"\xff\xd8" and file[-2:] == b"\xff\xd9"
    at, tables, restart, size = 2, {}, 0, (0, 0)
    while True:
        marker, length = file[at + 1], int.from_bytes(file[at + 2 : at + 4], "big")
        body, at = file[at + 4 : at + 2 + length], at + 2 + length
        if marker == 0xC0:
            assert body[0] == 8 and body[5] == 1 and body[7] == 0x11
            size = int.from_bytes(body[3:5], "big"), int.from_bytes(body[1:3], "big")
        elif marker == 0xC4:
            while body:
                counts, symbols, code, k = body[1:17], body[17 : 17 + sum(body[1:17])], 0, 0
                codes = {}
                for n, count in enumerate(counts, 1):
                    for _ in range(count):
                        assert code < (1 << n) - 1  # no code of ones alone
                        codes[n, code] = symbols[k]
                        code, k = code + 1, k + 1
                    code <<= 1
                tables[body[0]], body = codes, body[17 + len(symbols) :]
        elif marker == 0xDD:
            restart = int.from_bytes(body, "big")
        elif marker == 0xDA:
            break
    scan, intervals, now = file[at:-2], [], bytearray()
    k = 0
    while k < len(scan):
        if scan[k] == 255 and scan[k + 1] == 0:
            now.append(255)
        elif scan[k] == 255:
            assert scan[k + 1] == 0xD0 + len(intervals) % 8
            intervals.append(now)
            now = bytearray()
        else:
            now.append(scan[k])
            k -= 1
        k += 2
    out = []
    for raw in [*intervals, now]:
        bits = "".join(f"{b:08b}" for b in raw)
        place, dc = 0, 0

        def symbol(codes):
            nonlocal place
            for n in range(1, 17):
                if (n, int(bits[place : place + n], 2)) in codes:
                    place += n
                    return codes[n, int(bits[place - n : place], 2)]
            raise ValueError

        def value(n):
            nonlocal place
            v, place = int(bits[place : place + n] or "0", 2) if n else 0, place + n
            return v if not n or v >> (n - 1) else v - (1 << n) + 1

        for _ in range(restart):
            dc += value(symbol(tables[0]))
            block, i = [dc] + [0] * 63, 1
            while i < 64:
                s = symbol(tables[16])
                if s == 0:
                    break
                i += s >> 4
                if s & 15:
                    block[i] = value(s & 15)
                i += 1
            out.append(block)
        assert set(bits[place:]) <= {"1"} and len(bits) - place < 8
    return *size, out


def test_files_are_those_of_the_standard():
    texts = [b"", b"plain text " * 30, bytes(range(256)) * 3, b"\xff" * 129, b"\x00" * 63 + b"\x80", "naïve 日本 😀".encode() * 5]
    offs = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    for text, file in zip(texts, J.write_payloads(np.frombuffer(b"".join(texts), np.uint8), offs), strict=True):
        across, down, blocks = decoded_by_the_standard(file)
        stored = text + bytes(max(64, -(-len(text) // 64) * 64) - len(text))
        got = bytes(v & 255 for b in blocks for v in b)
        assert got[: len(stored)] == stored and not any(got[len(stored) :]) and len(blocks) == across // 8 * (down // 8)


class Bits:
    def __init__(self):
        self.out, self.now, self.n = bytearray(), 0, 0

    def put(self, v, n):
        for k in range(n - 1, -1, -1):
            self.now, self.n = self.now << 1 | v >> k & 1, self.n + 1
            if self.n == 8:
                self.out += bytes([self.now]) + b"\x00" * (self.now == 255)
                self.now = self.n = 0

    def align(self):
        while self.n:
            self.put(1, 1)


def test_colour_with_subsampling_and_prediction():
    """A scan of three components, 2 x 2 luminance blocks a unit, DC prediction, and an interval of 2 units, written here bit by bit."""
    rng = np.random.default_rng(5)
    across, down = 3, 2
    blocks = {1: rng.integers(-60, 60, (down * 2, across * 2)), 2: rng.integers(-9, 9, (down, across)), 3: rng.integers(-9, 9, (down, across))}
    b, last = Bits(), dict.fromkeys(blocks, 0)
    for u in range(across * down):
        if u and u % 2 == 0:
            b.align()
            b.out += bytes([255, 0xD0 + (u // 2 - 1) % 8])
            last = dict.fromkeys(blocks, 0)
        for c, side in ((1, 2), (2, 1), (3, 1)):
            for y in range(side):
                for x in range(side):
                    v = int(blocks[c][u // across * side + y, u % across * side + x])
                    d, last[c] = v - last[c], v
                    s = abs(d).bit_length()
                    b.put(int(J.DC.code[s]), int(J.DC.size[s]))
                    b.put(d if d >= 0 else d + (1 << s) - 1, s)
                    b.put(int(J.AC.code[0x31]), int(J.AC.size[0x31]))
                    b.put(1, 1)
                    b.put(int(J.AC.code[0]), int(J.AC.size[0]))
    b.align()
    frame = b"\x08" + (down * 16 - 3).to_bytes(2, "big") + (across * 16 - 5).to_bytes(2, "big") + b"\x03\x01\x22\x00\x02\x11\x00\x03\x11\x00"
    file = b"\xff\xd8" + J._segment(0xDB, b"\x00" + b"\x08" * 64) + J._segment(0xC0, frame) + J._TABLES + J._segment(0xDD, b"\x00\x02") + J._segment(0xDA, b"\x03\x01\x00\x02\x00\x03\x00\x00\x3f\x00") + bytes(b.out) + b"\xff\xd9"
    p = J.parse(file)
    got = J.decode_blocks(file, p)
    assert all((got[c][:, :, 0] == blocks[c]).all() and (got[c][:, :, 4] == 1).all() for c in blocks)
    payload, feature = J.read_media([file])[0]
    assert payload is None and feature.startswith("43x29:")
    assert (J.thumbnail(got[1][:, :, 0], 8) == np.clip(blocks[1] + 128, 0, 255)).all()


def store_of(spark, **args):
    return sharding.ShardStore(spark, f"{shared_folder(spark)}/store-{uuid.uuid4().hex}", **args)


def arrival(spark, k):
    return spark.range(k * 1000, k * 1000 + 1000, 1, 2).selectExpr("id as doc_id", "repeat(cast(id as string), 50) as text", "null as extra")


def test_store(spark):
    store = store_of(spark, target=1 << 20, fanout=3)
    for k in range(7):
        store.append(arrival(spark, k))
    before = store.manifest()
    assert len(before["shards"]) == 14 and before["version"] == 7
    with pytest.raises(sharding.Conflict):
        store.commit(3, StructType([]), [])
    after = store.compact()
    assert len(after["shards"]) < 5 and after["version"] > 7
    assert store.read(7).count() == store.read().count() == 7000  # old versions are there until vacuum
    store._write(arrival(spark, 9))  # a writer that failed before it committed
    assert store.vacuum(keep_versions=1) == 0 and store.versions() == [after["version"]]  # files are too young
    assert store.vacuum(keep_versions=1, retain=-5) == 14 + 2
    rows = store.read()
    assert rows.count() == 7000 and rows.select("doc_id").distinct().count() == 7000
    files = {s["path"].split("/")[-1] for s in after["shards"]}
    assert {r.f for r in rows.selectExpr("_metadata.file_name as f").distinct().collect()} == files
    assert store.compact()["version"] == after["version"]


def test_columns_of_all_arrivals_live_on(spark):
    store = store_of(spark, target=1 << 20, fanout=2)
    store.append(spark.range(5).selectExpr("id as doc_id", "'a' as text"))
    store.append(spark.range(5, 9).selectExpr("id as doc_id", "'b' as text", "id * 2 as extra"))
    store.append(spark.range(9, 12).selectExpr("'c' as text", "cast(id as double) as score", "id as doc_id"))
    store.append(spark.range(12, 14).selectExpr("id as doc_id", "'d' as text", "id * 2 as extra"))
    want = [(k, "a", None, None) for k in range(5)] + [(k, "b", 2 * k, None) for k in range(5, 9)] + [(k, "c", None, float(k)) for k in range(9, 12)] + [(k, "d", 2 * k, None) for k in (12, 13)]
    for _ in range(2):
        assert sorted(map(tuple, store.read().select("doc_id", "text", "extra", "score").collect()), key=lambda r: r[0]) == want
        assert len(store.compact()["shards"]) == 1 and store.vacuum(keep_versions=1, retain=0) >= 0
    version = store.manifest()["version"]
    for clash in ("id as doc_id, 7 as text", "id as doc_id, 'x' as TEXT"):
        with pytest.raises(ValueError, match="clashes"):
            store.append(spark.sql(f"select {clash} from range(3)"))
    assert store.manifest()["version"] == version


def test_racing_writers_lose_nothing(spark):
    store = store_of(spark, target=1 << 20, fanout=2)
    store.append(arrival(spark, 0))

    def write(k):
        own = sharding.ShardStore(spark, store.root, target=1 << 20, fanout=2)
        return own.compact()["version"] if k % 4 == 0 else own.append(arrival(spark, k))["version"]

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(write, range(1, 13)))
    writers = [k for k in range(1, 13) if k % 4]
    rows = store.read()
    assert rows.count() == 1000 * (1 + len(writers)) and rows.select("doc_id").distinct().count() == rows.count()
    store.compact()
    store.vacuum(keep_versions=1, retain=-5)
    assert store.read().count() == 1000 * (1 + len(writers))
    # of several writers of one version exactly one wins
    base, won = store.manifest(), []

    def commit(_):
        try:
            store.commit(base["version"], StructType.fromJson(base["schema"]), base["parts"])
            won.append(1)
        except sharding.Conflict:
            pass

    with ThreadPoolExecutor(6) as pool:
        list(pool.map(commit, range(6)))
    assert len(won) == 1


def test_shard_rows(spark):
    rows = [(1, None, 3), (1, "a", None), (None, "b" * 100_000, 1), (2, "", 1), (2, "", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, tier int").withColumn("_metadata", F.lit("clash")).withColumn("shard", F.lit(None))
    got = sharding.shard_table(df, f"{shared_folder(spark)}/rows-{uuid.uuid4().hex}").collect()
    assert sorted((str(r.doc_id), str(r.n_chars), str(r.text_md5)) for r in got) == sorted((str(k), str(None if t is None else len(t)), str(None if t is None else hashlib.md5(t.encode()).hexdigest())) for k, t, _ in rows)
    assert all(r.shard.startswith("part-") and r.shard_bytes > 0 for r in got)
    empty = sharding.shard_table(df.limit(0), f"{shared_folder(spark)}/none-{uuid.uuid4().hex}")
    assert empty.count() == 0 and empty.columns == ["doc_id", "shard", "tier", "shard_bytes", "n_chars", "text_md5"]


def test_appends_read_and_write_little(spark, monkeypatch):
    """Of many appends: what versions list grows with the logarithm of their number, an append reads few parts, and no shard is lost."""
    store = store_of(spark)
    df = spark.range(1).selectExpr("id as doc_id")
    made, read = [], Counter()
    monkeypatch.setattr(sharding, "PART", 64)
    monkeypatch.setattr(sharding, "FOLD", 4)
    monkeypatch.setattr(store, "_write", lambda _: made.append(f"s{len(made)}") or [{"path": made[-1], "bytes": 10, "tier": 0}])
    monkeypatch.setattr(store, "_get", lambda name, f=store._get: read.update([name.split("/")[0]]) or f(name))
    n = 220
    listed = 0
    for _ in range(n):
        store.append(df)
        listed += len(store.head()["parts"])
    assert sorted(s["path"] for s in store.manifest()["shards"]) == sorted(made) and len(made) == n
    assert listed < n * (3 * 4 + n / 64) and read["parts"] < n * 3 + 20
    assert [c for _, c in store.head()["parts"]].count(64) >= 2 and len(store.head()["parts"]) < 14
    with pytest.raises(ValueError, match="two columns"):
        store.append(spark.range(1).selectExpr("id", "id"))


def deviations(slots: list[str], weights: dict) -> float:
    """The most that a source's blocks so far ever differ from its share of the slots so far."""
    seen, worst = dict.fromkeys(weights, 0), 0.0
    for s, source in enumerate(slots, 1):
        seen[source] += 1
        worst = max(worst, *(abs(seen[k] - s * w) for k, w in weights.items()))
    return worst


@pytest.mark.parametrize("weights", [None, [("s0", 0.5), ("s1", 0.2), ("s2", 0.01), ("s9", 3.0), ("s4", -1.0)]])
def test_mix_stays_within_a_block(spark, weights):
    rows = [(k, ["s0", "s1", "s2", None, "s4"][0 if k % 3 == 0 else k % 5]) for k in range(3000)] + [(None, "s1"), (5, "s2"), (5, "s2")]
    df = spark.createDataFrame(rows, "doc_id long, source string").withColumn("slot", F.lit("clash"))
    w = spark.createDataFrame(weights, "source string, weight double") if weights else None
    got = mixing.mix(df, w, block=4).collect()
    assert sorted((str(r.doc_id), str(r.source)) for r in got) == sorted((str(a), str(b)) for a, b in rows)
    assert len({(r.slot, r.source, r.place) for r in got}) == len(got)
    mixed = [r for r in got if r.in_mix]
    assert mixing.mixed_rows(df, w, block=4) == len(mixed)
    at = {}
    for r in mixed:
        assert at.setdefault(r.slot, r.source) == r.source
    assert sorted(at) == list(range(len(at))) and len(at) > 20 and len(mixed) == 4 * len(at)
    assert all(r.slot >= len(at) for r in got if not r.in_mix)
    sizes = Counter(s for _, s in rows)
    named = {k: v for k, v in weights if v > 0 and k in sizes} if weights else {k: n**0.5 for k, n in sizes.items()}
    target = {k: v / sum(named.values()) for k, v in named.items()}
    assert deviations([at[s] for s in range(len(at))], target) < 1
    assert all(abs(r.weight - target.get(r.source, 0)) < 1e-6 for r in got)
    # the next slot's source has no block left
    left = {k: sum(1 for s in at.values() if s == k) for k in target}
    assert any(sizes[k] // 4 == n for k, n in left.items())


def earliest_deadlines(w: list[int], slots: int) -> list[int]:
    """Slot by slot: of released blocks the one with the earliest deadline."""
    total, done, out = sum(w), [0] * len(w), []
    for t in range(slots):
        i = min((-(-(done[i] + 1) * total // w[i]), i) for i in range(len(w)) if done[i] * total // w[i] <= t)[1]
        done[i] += 1
        out.append(i)
    return out


@pytest.mark.parametrize("weights", [[9, 1], [1, 1, 1], [2**31 - 7, 2**30 + 3, 12345678, 1, 99], list(range(1, 80)), [10**9, *[3] * 200]])
def test_schedule_is_earliest_deadline_first(spark, weights):
    """And stays within a block of the weights over many of the weights' periods."""
    plan = spark.createDataFrame([(f"{k:04d}", w, 1 << 17) for k, w in enumerate(weights)], "source string, w long, blocks long")
    slots = 1500
    got = sorted((r.slot, int(r.source), r.j) for r in mixing.schedule(plan, slots, sum(weights), len(weights)).collect())
    assert [i for _, i, _ in got] == earliest_deadlines(weights, slots) and [s for s, *_ in got] == list(range(slots))
    assert deviations([i for _, i, _ in got], {k: w / sum(weights) for k, w in enumerate(weights)}) < 1
    for i in {i for _, i, _ in got}:
        assert [j for _, k, j in got if k == i] == list(range(sum(k == i for _, k, _ in got)))


def test_weights_hold_over_many_slots(spark):
    df = spark.range(60_000).selectExpr("id as doc_id", "if(id % 10 = 0, 'b', 'a') as source")
    got = mixing.mix(df, spark.createDataFrame([("a", 0.9), ("b", 0.1)], "source string, weight double"), block=4).where("in_mix and place = 0").collect()
    at = {r.slot: r.source for r in got}
    assert len(at) > 14_000 and deviations([at[s] for s in range(len(at))], {"a": 0.9, "b": 0.1}) < 1


def test_many_sources(spark):
    n = 100_000
    df = spark.range(3 * n).selectExpr("id as doc_id", f"cast(if(id < {n}, id, pmod(hash(id), 1000)) as string) as source")
    got = mixing.mix(df, block=1)
    r = got.agg(F.count("*").alias("n"), F.count_if("in_mix").alias("mixed"), F.countDistinct(F.when(F.col("in_mix"), F.col("slot"))).alias("slots"), F.max(F.when(F.col("in_mix"), F.col("slot"))).alias("last")).first()
    assert r.n == 3 * n and r.mixed == r.slots == r.last + 1 > 1000


def test_blocks_grow_with_the_table(spark, monkeypatch):
    """A schedule has SLOTS slots at most: of more rows the blocks are larger, and the shares still hold within one."""
    monkeypatch.setattr(mixing, "SLOTS", 50)
    df = spark.range(4000).selectExpr("id as doc_id", "if(id % 10 < 7, 'a', if(id % 10 < 9, 'b', 'c')) as source")
    got = mixing.mix(df).collect()
    block = 80
    assert {(r.doc_id, r.source) for r in got} == {(k, "a" if k % 10 < 7 else "b" if k % 10 < 9 else "c") for k in range(4000)}
    assert max(r.place for r in got) == block - 1 and max(r.block for r in got) == 2800 // block - 1
    at = {r.slot: r.source for r in got if r.in_mix}
    sizes = {"a": 2800, "b": 800, "c": 400}
    total = sum(n**0.5 for n in sizes.values())
    assert sorted(at) == list(range(len(at))) and len(at) > 10 and deviations([at[s] for s in range(len(at))], {k: n**0.5 / total for k, n in sizes.items()}) < 1


def test_query_blocks_do_not_grow(spark, monkeypatch, tmp_path):
    """op7's rows are the same whether its slots are given at once or a few at a time, and however many rows are sent."""
    spark.range(9000).selectExpr("id as doc_id", "string(id) as text", "if(id % 10 < 7, 'a', if(id % 10 < 9, 'b', 'c')) as source").write.parquet(f"{tmp_path}/documents.parquet")
    before = sorted(map(str, llm_queries.op7_mixing(spark, str(tmp_path)).collect()))
    rows = mixing.mixed_rows(spark.read.parquet(f"{tmp_path}/documents.parquet"), block=mixing.BLOCK)
    monkeypatch.setattr(mixing, "SLOTS", 64)
    assert sorted(map(str, llm_queries.op7_mixing(spark, str(tmp_path)).collect())) == before
    assert mixing.mixed_rows(spark.read.parquet(f"{tmp_path}/documents.parquet"), block=mixing.BLOCK) == rows > 128 * 16


def test_mixed_documents(spark):
    df = spark.createDataFrame([(k, f"s{k % 3}", "x") for k in range(500)], "doc_id long, source string, _slot string")
    out = mixing.in_order(df)
    assert out.columns == df.columns
    order = [r.doc_id for r in out.collect()]
    place = {r.doc_id: (r.slot, r.source, r.place) for r in mixing.mix(df).collect()}
    assert order == sorted(range(500), key=place.get)
    assert mixing.mix(df.limit(0)).count() == 0 and mixing.in_order(df.limit(0)).count() == 0
