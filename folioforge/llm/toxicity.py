"""Toxicity: a linear classifier on character n-grams whose features are scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.llm.common import fold, folded, hashed_grams, hashed_sample, over_texts, pieces, tune

BITS, GRAMS = 18, (3, 4, 5, 6)
#: Labelled documents that the classifier is fitted on, and n-gram bins that it uses: the most telling ones.
SAMPLE, FEATURES, LEAST_DOCUMENTS = 20_000, 8192, 3


def gram_bins(points: np.ndarray, chars: np.ndarray):
    """For each n: the bins of the n-grams of all texts, and the text of each; n-grams over two texts are left out."""
    for n in GRAMS:
        bins = hashed_grams(points, n, BITS)
        ends = chars[1:-1]  # starts of the later texts
        inside = np.ones(len(bins), bool)
        for k in range(1, n):
            at = ends - k
            inside[at[(at >= 0) & (at < len(bins))]] = False
        yield bins, inside


def presence(points: np.ndarray, chars: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, bin) once for each bin that is `wanted` and occurs in the text, sorted."""
    keys = []
    for bins, inside in gram_bins(points, chars):
        at = np.flatnonzero(wanted[bins] & inside)
        text = np.searchsorted(chars, at, "right") - 1
        keys.append((text << BITS) | bins[at])
    key = np.unique(np.concatenate(keys)) if keys else np.zeros(0, np.int64)
    return key >> BITS, key & ((1 << BITS) - 1)


@dataclass
class ToxicModel:
    bins: np.ndarray
    weights: np.ndarray  # log-count ratio times weight, for each of bins
    bias: float

    def __post_init__(self):
        self.wanted = np.zeros(1 << BITS, bool)
        self.wanted[self.bins] = True
        self.by_bin = np.zeros(1 << BITS)
        self.by_bin[self.bins] = self.weights

    def score(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        text, bins = presence(*folded(data, offs), self.wanted)
        z = np.bincount(text, self.by_bin[bins], len(offs) - 1) + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _counts(batches):
    """Of each task: for each bin the number of its documents of either label; at bin -1 those of all."""
    n, seen = np.zeros(2, np.int64), np.zeros((2, 1 << BITS), np.int64)
    every = np.ones(1 << BITS, bool)
    for batch in batches:
        for part, data, offs in pieces(batch, "_text"):
            y = part.column(0).to_numpy()
            text, bins = presence(*folded(data, offs), every)
            for label in (0, 1):
                seen[label] += np.bincount(bins[y[text] == label], minlength=1 << BITS)
                n[label] += int((y == label).sum())
    at = np.flatnonzero(seen.any(axis=0))
    yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int32()), *(pa.array(np.append(seen[k][at], n[k]), pa.int64()) for k in (0, 1))], ["bin", "clean", "toxic"])


def fit_logistic(rows: list[np.ndarray], y: np.ndarray, r: np.ndarray, epochs: int = 30, batch: int = 256, rate: float = 0.02, l2: float = 1e-4, seed: int = 5) -> tuple[np.ndarray, float]:
    """Logistic regression on r * presence, by Adam over shuffled batches; rows hold the columns that are present."""
    w, bias = np.zeros(len(r)), float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    m, v = np.zeros(len(r) + 1), np.zeros(len(r) + 1)
    rng, t = np.random.default_rng(seed), 0
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for a in range(0, len(order), batch):
            part = order[a : a + batch]
            text = np.repeat(np.arange(len(part)), [len(rows[i]) for i in part])
            at = np.concatenate([rows[i] for i in part])
            z = np.bincount(text, (w * r)[at], len(part)) + bias
            g = 1 / (1 + np.exp(-np.clip(z, -40, 40))) - y[part]
            grad = np.append(np.bincount(at, g[text], len(r)) * r / len(part) + l2 * w, g.mean())
            t += 1
            m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
            step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
            w, bias = w - step[:-1], bias - step[-1]
    return w * r, float(bias)


def fit(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE) -> ToxicModel:
    """Fit on at most `sample` labelled documents for which `learn` (over labels) holds, taken by a hash of the id.
    A document with several labels has the greatest. Null ids, labels and texts are left out; with one class only, or
    none, all texts score alike. Rows of docs that repeat count as often."""
    tune(docs.sparkSession)
    picked = labels.where(learn & F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("_lid")).agg(F.max(F.col(label_col).cast("int")).alias("_y"))
    picked = hashed_sample(picked, sample, "_lid")
    texts = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).cast("long").alias("_lid"), F.col(text_col).alias("_text")).join(F.broadcast(picked), "_lid").select(F.col("_y").cast("long").alias("_y"), "_lid", "_text")
    counts = texts.select("_y", "_text").mapInArrow(_counts, "bin int, clean long, toxic long").groupBy("bin").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).toPandas()
    whole = counts[counts["bin"] == -1]
    n0, n1 = int(whole["clean"].sum()), int(whole["toxic"].sum())
    if not n0 or not n1:
        prior = (n1 + 0.5) / (n0 + n1 + 1)
        return ToxicModel(np.zeros(0, np.int64), np.zeros(0), float(np.log(prior / (1 - prior))))
    counts = counts[(counts["bin"] >= 0) & (counts["clean"] + counts["toxic"] >= LEAST_DOCUMENTS)].sort_values("bin")
    bins, c0, c1 = (counts[k].to_numpy() for k in ("bin", "clean", "toxic"))
    p = (c0 + c1) / (n0 + n1)
    z = (c1 / n1 - c0 / n0) / np.sqrt(np.maximum(p * (1 - p), 1e-9) * (1 / n0 + 1 / n1))
    top = np.sort(np.lexsort((bins, -np.abs(z)))[:FEATURES])
    bins = bins[top].astype(np.int64)
    r = np.log((c1[top] + 1) / (n1 + 2)) - np.log((c0[top] + 1) / (n0 + 2))
    wanted = np.zeros(1 << BITS, bool)
    wanted[bins] = True

    def chosen():
        def f(ids, data, offs):
            text, at = presence(*folded(data, offs), wanted)
            bounds = np.searchsorted(text, np.arange(len(offs)))
            return [ids, pa.array([at[a:b].astype(np.int32).tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary())]

        return f

    got = over_texts(texts.withColumn("_key", F.col("_y") + 2 * F.col("_lid")), "_key", "_text", chosen, "y long, bins binary").toPandas().sort_values(["y", "bins"], kind="stable")
    rows = [np.searchsorted(bins, np.frombuffer(b, np.int32)) for b in got["bins"]]
    return ToxicModel(bins, *fit_logistic(rows, (got["y"].to_numpy() % 2).astype(float), r))


def score_documents(docs: DataFrame, model: ToxicModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) for every row, over whole texts of any length. Null and empty texts have no features: they score as
    the bias. Rows that repeat or share an id are each scored, as is a null id. An empty table gives an empty result; other columns are ignored."""
    tune(docs.sparkSession)
    return over_texts(docs, id_col, text_col, lambda: lambda ids, data, offs: [ids, pa.array(model.score(data, offs), pa.float64())], "doc_id long, score double")


def training_rows(id_col: str = "doc_id") -> Column:
    """The labels that op6 learns from: those whose fold isn't 0 of 5."""
    return fold(F.col(id_col), 5) != 0
