"""Importance resampling against a definition in plain Python."""

import hashlib
import math
import re
import zlib
from collections import Counter

from folioforge.llm import importance as I
from pyspark.sql import functions as F


def words(text: str | None) -> list[str]:
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def features(text: str | None, n: int) -> list[str]:
    w = words(text)
    return [" ".join(w[a : a + k]) for k in range(1, n + 1) for a in range(len(w) - k + 1)]


def plainly(docs: list, target: list, n: int, buckets: int, least: int, num: int, den: int) -> list:
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = (Counter(bucket(f) for x in texts for f in features(x, n)) for texts in ([x for _, x in docs], target))
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets)))) for b in range(buckets)]
    out = []
    for k, text in docs:
        f = features(text, n)
        weight = sum(gain[bucket(x)] for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if k is None else k}".encode()).hexdigest()[:8], 16)
        out.append((k, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words(text))))
    fit = sorted((x for x in out if x[4] >= least), key=lambda x: (-x[3], x[0] is None, x[0] or 0, x[1], x[2]))
    drawn = fit[: num * len(fit) // den]
    return sorted([(*x[:4], k) for k, x in enumerate(drawn, 1)] + [(*x[:4], None) for x in fit[len(drawn) :] + [x for x in out if x[4] < least]], key=repr)


def test_ring_is_the_crc_of_every_run(monkeypatch):
    monkeypatch.setattr(I, "PIECE", 7)
    for text in ("", "one", "A b.c  d-é9 ÉZ\x00z", "the same the same the same", "x " * 50, "日本語 中文, ﬁ"):
        for n in (1, 2, 3, 5):
            pieces = list(I.ring(text.encode(), n))
            assert Counter(c for crcs, _ in pieces for c in crcs) == Counter(zlib.crc32(f.encode()) for f in features(text, n))
            assert sum(k for _, k in pieces) == len(words(text))


def test_rows(spark):
    texts = ["The quick brown fox jumps over the lazy dog " * 4, "one two", "", None, "Zürich ÄÖ é9 a-b_c " * 9, "!!! ...", "same words here " * 12]
    docs = [(k, texts[k % len(texts)]) for k in range(60)] + [(3, texts[0]), (3, texts[0]), (None, texts[0]), (None, texts[4]), (None, None)]
    target = ["lazy dog over the fox", None, "", "zürich é9"]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"score": F.lit("clash"), "rank": F.lit(1), "tie": F.lit("x")}).repartition(5)
    aim = spark.createDataFrame([(t,) for t in target], "text string")
    for n, buckets, least, num in ((2, 10_000, 20, 25), (1, 7, 1, 100), (3, 50, 0, 60)):
        got = I.resample(df, aim, n=n, buckets=buckets, least=least, num=num).select("doc_id", "n_features", "weight", "score", "rank").collect()
        assert sorted(map(tuple, got), key=repr) == plainly(docs, target, n, buckets, least, num, 100)
    assert sorted(map(tuple, I.resample(df, aim.limit(0)).collect()), key=repr) == plainly(docs, [], 2, 10_000, 20, 25, 100)
    assert I.resample(df.limit(0), aim).collect() == []


def test_whole_table(spark):
    docs, aim = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "benchmark"))
    got = I.resample(docs, aim).collect()
    assert sorted(map(tuple, got), key=repr) == plainly([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in aim.collect()], 2, 10_000, 20, 25, 100)
