"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams, trained with
follow-the-regularised-leader and elastic-net penalties, then calibrated by a temperature."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.llm.common import Scratch, filtered, fold, folded, hashed_grams, over_texts, pieces, release, tune

BITS, GRAMS = 15, (1, 2, 3)
#: Different texts of each language that the regression is fitted on, all if there are no more; document frequencies are of all.
SAMPLE = 1500
#: Languages that the model's dense weights have room for; more are an error.
LANGUAGES = 1000
#: Below so many texts in all, the temperature is fitted on predictions of models that each left out one of FOLDS parts; else one part is left out.
CROSSED, FOLDS = 500, 5
UNKNOWN = "und"


def term_counts(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bins and counts of the n-grams of a text; runs of non-letters are one space."""
    keep = np.ones(len(points), bool)
    keep[1:] = (points[1:] != 32) | (points[:-1] != 32)
    points = np.concatenate(([np.uint32(32)], points[keep], [np.uint32(32)]))
    counts = np.bincount(np.concatenate([hashed_grams(points, n, BITS) for n in GRAMS]), minlength=1 << BITS)
    bins = np.flatnonzero(counts)
    return bins, counts[bins]


@dataclass
class LanguageModel:
    languages: list[str]
    idf: np.ndarray  # by bin
    weights: np.ndarray  # bin x language, the last row is the bias
    temperature: float = 1.0

    def vector(self, bins: np.ndarray, counts: np.ndarray) -> np.ndarray:
        x = (1 + np.log(counts)) * self.idf[bins]
        return x / max(1e-12, math.sqrt(float(x @ x)))

    def logits(self, bins: np.ndarray, x: np.ndarray) -> np.ndarray:
        return x @ self.weights[bins] + self.weights[-1]

    def predict(self, points: np.ndarray) -> tuple[str, float]:
        if not self.languages or not (points != 32).any():
            return UNKNOWN, 0.0
        bins, counts = term_counts(points)
        p = softmax(self.logits(bins, self.vector(bins, counts)) / self.temperature)
        k = int(p.argmax())
        return self.languages[k], float(min(1.0, p[k]))


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


#: Bins and counts of a text's n-grams, and its language's number.
Row = tuple[np.ndarray, np.ndarray, int]


def fit_ftrl(rows: list[Row], model: LanguageModel, epochs: int = 4, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.5, seed: int = 7) -> None:
    """FTRL-proximal: a weight is 0 while |z| <= l1, else -(z - sign(z) l1) / ((beta + sqrt(n)) / alpha + l2)."""
    z, n = np.zeros_like(model.weights), np.zeros_like(model.weights)
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for r in rng.permutation(len(rows)):
            bins, counts, y = rows[r]
            at, x = np.append(bins, len(z) - 1), np.append(model.vector(bins, counts), 1.0)
            za, na = z[at], n[at]
            w = np.where(np.abs(za) <= l1, 0.0, -(za - np.sign(za) * l1) / ((beta + np.sqrt(na)) / alpha + l2))
            p = softmax(x @ w)
            p[y] -= 1
            g = x[:, None] * p
            more = na + g * g
            z[at] = za + g - (np.sqrt(more) - np.sqrt(na)) / alpha * w
            n[at] = more
    model.weights = np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2))


def fit_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the least negative log-likelihood, by golden-section search over its logarithm."""
    loss = lambda t: -float(np.log(softmax(logits / math.exp(t))[np.arange(len(y)), y] + 1e-300).mean())
    a, b, r = math.log(0.02), math.log(20), (math.sqrt(5) - 1) / 2
    for _ in range(40):
        c, d = b - r * (b - a), a + r * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return math.exp((a + b) / 2)


def _frequencies(batches):
    """Of each task: the number of its documents with each bin, and at bin -1 that of all its documents."""
    total, n = np.zeros(1 << BITS, np.int64), 0
    for batch in batches:
        for _, data, offs in pieces(batch, "_text"):
            points, chars = folded(data, offs)
            for a, b in zip(chars[:-1], chars[1:], strict=True):
                total[term_counts(points[a:b])[0]] += 1
            n += len(offs) - 1
    bins = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(bins, -1), pa.int32()), pa.array(np.append(total[bins], n), pa.int64())], ["bin", "n"])


def _counted(batches):
    """y, h of each text with its bins (16 bits each) and their counts (32)."""
    for batch in batches:
        for part, data, offs in pieces(batch, "_text"):
            points, chars = folded(data, offs)
            rows = [term_counts(points[a:b]) for a, b in zip(chars[:-1], chars[1:], strict=True)]
            bins, counts = pa.array([b.astype(np.uint16).tobytes() for b, _ in rows], pa.binary()), pa.array([c.astype(np.uint32).tobytes() for _, c in rows], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), bins, counts], ["y", "h", "bins", "counts"])
    release()


def fit(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> LanguageModel:
    """Learn from the rows for which `learn` holds and whose language isn't null: document frequencies from all of
    them, the regression and the temperature from at most `sample` different texts a language, those with the least
    hashes. Null texts are left out; without rows, or with one language, the temperature stays 1."""
    spark = docs.sparkSession
    tune(spark)
    known = docs.where(learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(text_col).cast("string").alias("_text"), F.col(lang_col).cast("string").alias("_lang")).withColumn("_h", F.xxhash64("_text", F.lit(11)))
    hashes = Scratch(spark, "languages").table(known.select("_lang", "_h").distinct())
    sizes = {r["_lang"]: r["count"] for r in hashes.groupBy("_lang").count().limit(LANGUAGES + 1).collect()}
    if len(sizes) > LANGUAGES:
        raise ValueError(f"over {LANGUAGES} languages")
    languages = sorted(sizes)
    if not languages:
        return LanguageModel([], np.ones(1 << BITS), np.zeros(((1 << BITS) + 1, 0)))
    rows = known.select("_text").mapInArrow(_frequencies, "bin int, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect()
    seen = {r.bin: r.n for r in rows}
    n = seen.pop(-1, 0)
    frequency = np.zeros(1 << BITS)
    frequency[list(seen)] = list(seen.values())
    model = LanguageModel(languages, np.log((1 + n) / (1 + frequency)) + 1, np.zeros(((1 << BITS) + 1, len(languages))))
    # hashes above a language's bound can't be among its least ones; what is left of a language is ranked
    h = F.pmod("_h", F.lit(1 << 40))
    bound = F.create_map(*[x for k, v in sizes.items() for x in (F.lit(k), F.lit(1 << 40 if v <= 2 * sample else int((1 << 40) * (1.2 * sample + 200) / v)))])
    ranked = hashes.where(h < F.element_at(bound, F.col("_lang"))).withColumn("_r", F.row_number().over(Window.partitionBy("_lang").orderBy(h, "_h")))
    chosen = ranked.where(F.col("_r") <= sample).select("_lang", "_h")
    index = F.create_map(*[x for i, k in enumerate(languages) for x in (F.lit(k), F.lit(i))])
    taken = known.join(F.broadcast(chosen), ["_lang", "_h"]).dropDuplicates(["_lang", "_h"]).select(F.element_at(index, F.col("_lang")).cast("long").alias("_y"), "_h", "_text")
    got = taken.mapInArrow(_counted, "y long, h long, bins binary, counts binary").toArrow().sort_by([("y", "ascending"), ("h", "ascending")])  # the same model however tasks end
    rows: list[Row] = []
    for y, bins, counts in zip(got["y"].to_pylist(), got["bins"], got["counts"], strict=True):  # views of the table's memory
        rows.append((np.frombuffer(bins.as_buffer(), np.uint16), np.frombuffer(counts.as_buffer(), np.uint32), y))
    calibrate(model, rows)
    del rows, got, bins, counts
    release()
    return model


def calibrate(model: LanguageModel, rows: list[Row]) -> None:
    """Fit the regression, and the temperature on rows that the models which predict them haven't seen (CROSSED)."""
    few = len(rows) < CROSSED
    logits, y = [], []
    if len(model.languages) > 1 and len(rows) >= FOLDS:
        for k in range(FOLDS if few else 1):
            fit_ftrl([v for i, v in enumerate(rows) if i % FOLDS != k], model)
            left = rows[k::FOLDS]
            logits += [model.logits(b, model.vector(b, c)) for b, c, _ in left]
            y += [v[2] for v in left]
    if few or not logits:
        fit_ftrl(rows, model)
    if logits:
        model.temperature = fit_temperature(np.array(logits), np.array(y))


def _predictor(model: LanguageModel):
    def make():
        def f(ids, data, offs):
            points, chars = folded(data, offs)
            got = [model.predict(points[a:b]) for a, b in zip(chars[:-1], chars[1:], strict=True)]
            return [ids, pa.array([x[0] for x in got], pa.string()), pa.array([x[1] for x in got], pa.float64())]

        return f

    return make


def predict_languages(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) for every row. Null texts and texts without a letter are `und` with score 0, as is
    every text if there was nothing to learn from. Whole texts are read; rows that repeat or share an id are each
    predicted, as is a null id. An empty table gives an empty result; other columns are ignored."""
    tune(docs.sparkSession)
    return over_texts(docs, id_col, text_col, _predictor(model), "doc_id long, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: LanguageModel, text_col: str = "text", least: float = 0.5, languages: set[str] | None = None) -> DataFrame:
    """Rows of docs, all columns unchanged, whose language is found in the whole text with a score of `least` or more (and
    is one of `languages`). Null texts and texts without a letter go; repeated rows are each looked at."""
    tune(docs.sparkSession)

    def make():
        def f(data, offs):
            points, chars = folded(data, offs)
            got = [model.predict(points[a:b]) for a, b in zip(chars[:-1], chars[1:], strict=True)]
            return [lang != UNKNOWN and score >= least and (languages is None or lang in languages) for lang, score in got]

        return f

    return filtered(docs, text_col, make)


def training_rows(id_col: str = "doc_id") -> Column:
    """The rows that op5 learns from: those whose fold isn't 0 of 5."""
    return fold(F.col(id_col), 5) != 0
