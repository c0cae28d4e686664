"""Document quality from a linear-chain conditional random field over lines.

Each line is good (1) or bad (0). Its potentials come from features of the line and of its two neighbours; neighbouring
labels have transition potentials. Labels of documents stand for those of all their lines when the field is trained.
Forward-backward marginals, weighted by the lines' lengths, give the document's score.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.llm.common import Scratch, filtered, fold, hashed_sample, over_texts, release, tune, word_hashes

#: Labelled documents that the field is trained on at most, and lines of a training sequence (longer documents are cut into
#: several); of their sequences at most SEQUENCES, with at most LINES lines in all, go to the driver, by a hash.
SAMPLE, SEQUENCE, SEQUENCES, LINES = 4000, 128, 8000, 200_000

_UPPER, _LETTER, _DIGIT, _STOP, _SYMBOL = (np.zeros(256, bool) for _ in range(5))
_UPPER[65:91] = True
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_DIGIT[48:58] = True
_STOP[[ord(c) for c in ".,;:?'\"()-"]] = True
_SYMBOL[33:127] = True
_SYMBOL &= ~(_LETTER | _DIGIT | _STOP)
FEATURES = 26


def line_features(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A row of features for each line of each text, the lines' lengths in bytes, and the texts' offsets in lines.
    A text without a byte has one empty line."""
    n, texts = len(data), len(offs) - 1
    breaks = np.flatnonzero(data == 10)
    owner = np.searchsorted(offs, breaks, "right") - 1
    lines = 1 + np.bincount(owner, minlength=texts)
    bounds = np.concatenate(([0], np.cumsum(lines)))
    start = np.empty(bounds[-1], np.int64)
    head = np.zeros(bounds[-1], bool)
    head[bounds[:-1]] = True
    start[head] = offs[:-1]
    start[~head] = breaks + 1
    stop = np.empty_like(start)
    tail = np.zeros(bounds[-1], bool)
    tail[bounds[1:] - 1] = True
    stop[tail] = offs[1:]
    stop[~tail] = breaks
    size = stop - start

    def within(mask: np.ndarray) -> np.ndarray:
        total = np.zeros(n + 1, np.int64)
        np.cumsum(mask, out=total[1:])
        return (total[stop] - total[start]).astype(np.float64)

    hashed, first, last = word_hashes(data, offs)
    at = np.searchsorted(start, first, "right") - 1  # a word's line
    words = np.bincount(at, minlength=len(start)).astype(np.float64)
    same = np.zeros(len(hashed), bool)
    same[1:] = (hashed[1:] == hashed[:-1]) & (at[1:] == at[:-1])
    again = np.bincount(at[same], minlength=len(start))
    order = np.lexsort((hashed, at))
    once = np.ones(len(hashed), bool)
    once[1:] = (hashed[order][1:] != hashed[order][:-1]) | (at[order][1:] != at[order][:-1])
    distinct = np.bincount(at[order][once], minlength=len(start))
    total = np.zeros(len(hashed) + 1, np.uint64)
    np.cumsum(hashed, out=total[1:])
    bound = np.searchsorted(at, np.arange(len(start) + 1))
    line_key = total[bound[1:]] - total[bound[:-1]]
    text_of = np.repeat(np.arange(texts), lines)
    order = np.lexsort((np.arange(len(start)), line_key, text_of))
    repeat = np.zeros(len(start), bool)
    repeat[order[1:]] = (line_key[order][1:] == line_key[order][:-1]) & (text_of[order][1:] == text_of[order][:-1]) & (words[order[1:]] > 0)
    wordless = np.maximum(words, 1)
    chars = np.maximum(size, 1)
    letters = np.maximum(within(_LETTER[data]), 1)
    end = np.where(size > 0, data[np.minimum(np.maximum(stop - 1, 0), max(n - 1, 0))] if n else 0, 0)
    ratios = [within(_SYMBOL[data]) / chars, within(_UPPER[data]) / letters, within(_DIGIT[data]) / chars, within(_STOP[data]) / chars, again / wordless, 1 - distinct / wordless, within(data == 33) / chars, within(data == 124) / chars, within(data >= 128) / chars]
    parts = [np.minimum(x, 1) for x in ratios] + [np.minimum(np.sqrt(x), 1) for x in ratios]
    parts += [np.minimum(size / np.maximum(words, 1) / 12, 3), np.log1p(words) / 5, words == 0, repeat, np.isin(end, (46, 33, 63, 58)), (end == 46), np.log1p(lines)[text_of] / 5, words <= 3]
    return np.stack(parts, axis=1).astype(np.float32), size, bounds


def neighbourly(x: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Each line's features, those of the line before and of the line after (zeros at a text's ends), and a 1."""
    before, after = np.zeros_like(x), np.zeros_like(x)
    before[1:], after[:-1] = x[:-1], x[1:]
    before[bounds[:-1]] = 0
    after[bounds[1:] - 1] = 0
    return np.concatenate((x, before, after, np.ones((len(x), 1), x.dtype)), axis=1)


def marginals(score: np.ndarray, bounds: np.ndarray, transition: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """P(good) of each line, expected counts of neighbouring label pairs of each sequence summed (2 x 2), and log Z.

    All sequences take their k-th step together, longest first, so steps run over a shrinking head of arrays.
    """
    sizes = np.diff(bounds)
    order = np.argsort(-sizes, kind="stable")
    first, sizes = bounds[:-1][order], sizes[order]
    longest = int(sizes[0]) if len(sizes) else 0
    alive = np.searchsorted(-sizes, -np.arange(longest), "left")
    a = np.exp(transition)
    one = np.exp(np.clip(score, -30, 30))  # against 1 for a bad line
    good, scale = np.empty(len(score)), np.empty(len(score))
    log_z = 0.0
    for k in range(longest):
        m = alive[k]
        at = first[:m] + k
        if k:
            p = good[at - 1]
            g, b = (p * a[1, 1] + (1 - p) * a[0, 1]) * one[at], p * a[1, 0] + (1 - p) * a[0, 0]
        else:
            g, b = one[at], np.ones(m)
        scale[at] = g + b
        good[at] = g / scale[at]
    log_z = float(np.log(scale).sum())
    posterior = good.copy()
    back = np.ones((len(score), 2))
    pairs = np.zeros((2, 2))
    for k in range(longest - 2, -1, -1):
        m = alive[k + 1]
        at = first[:m] + k
        nxt = at + 1
        b1, b0 = back[nxt, 1] * one[nxt] / scale[nxt], back[nxt, 0] / scale[nxt]
        p = good[at]
        pairs += np.array([[((1 - p) * a[0, 0] * b0).sum(), ((1 - p) * a[0, 1] * b1).sum()], [(p * a[1, 0] * b0).sum(), (p * a[1, 1] * b1).sum()]])
        back[at, 1] = a[1, 1] * b1 + a[1, 0] * b0
        back[at, 0] = a[0, 1] * b1 + a[0, 0] * b0
        g = p * back[at, 1]
        posterior[at] = g / (g + (1 - p) * back[at, 0])
    return posterior, pairs, log_z


@dataclass
class LineField:
    weights: np.ndarray = field(default_factory=lambda: np.zeros(3 * FEATURES + 1))
    transition: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))

    def score(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """The length-weighted mean of P(good) over each text's lines."""
        x, size, bounds = line_features(data, offs)
        return self.of_features(x, size, bounds)

    def of_features(self, x: np.ndarray, size: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        p, _, _ = marginals(neighbourly(x, bounds) @ self.weights, bounds, self.transition)
        weight = size.astype(np.float64)
        blank = np.add.reduceat(weight, bounds[:-1]) == 0
        weight = np.where(np.repeat(blank, np.diff(bounds)), 1.0, weight)
        return np.clip(np.add.reduceat(p * weight, bounds[:-1]) / np.add.reduceat(weight, bounds[:-1]), 0, 1)


def train(sequences: list[tuple[np.ndarray, int]], steps: int = 250, rate: float = 0.1, l2: float = 1e-4) -> LineField:
    """Maximise the conditional log-likelihood of the lines' labels, each document with the same weight, by Adam."""
    model = LineField()
    if not sequences:
        return model
    x = np.concatenate([s for s, _ in sequences])
    bounds = np.concatenate(([0], np.cumsum([len(s) for s, _ in sequences])))
    y = np.repeat([float(label) for _, label in sequences], np.diff(bounds))
    full = neighbourly(x, bounds)
    lines = len(full)
    inner = np.ones(lines, bool)
    inner[bounds[1:] - 1] = False
    k = np.flatnonzero(inner)
    seen = np.array([[((1 - y[k]) * (1 - y[k + 1])).sum(), ((1 - y[k]) * y[k + 1]).sum()], [(y[k] * (1 - y[k + 1])).sum(), (y[k] * y[k + 1]).sum()]])
    theta = np.concatenate((model.weights, model.transition.ravel()))
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, steps + 1):
        w, a = theta[:-4], theta[-4:].reshape(2, 2)
        p, pairs, _ = marginals((full @ w.astype(np.float32)).astype(np.float64), bounds, a)
        g = np.concatenate((full.T @ (p - y).astype(np.float32), (pairs - seen).ravel())) / lines + l2 * theta
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta = theta - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return LineField(theta[:-4], theta[-4:].reshape(2, 2))


def _featurer(ids, data, offs):
    x, _, bounds = line_features(data, offs)
    return [ids, pa.array([[x[k : min(k + SEQUENCE, b)].tobytes() for k in range(a, b, SEQUENCE)] for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.list_(pa.binary()))]


def fit(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> LineField:
    """Train on at most `sample` labelled documents for which `learn` (over labels) holds, taken by a hash of the id, and
    of their lines on at most LINES. A document with several labels has the greatest. Documents that are labelled and
    not in docs, null ids, labels and texts are left out; without any, all texts score alike. Rows of docs that repeat count as often."""
    spark = docs.sparkSession
    tune(spark)
    picked = labels.where(learn & F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("_lid")).agg(F.max(F.col(label_col).cast("int")).alias("_y"))
    picked = hashed_sample(picked, sample, "_lid")
    texts = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).cast("long").alias("_lid"), F.col(text_col).alias("_text")).join(F.broadcast(picked), "_lid")
    cut = over_texts(texts.withColumn("_key", F.col("_y") + 2 * F.col("_lid")), "_key", "_text", lambda: _featurer, "y long, x array<binary>")
    cut = Scratch(spark, "lines").table(cut.select("y", F.posexplode("x").alias("at", "x")).withColumn("h", F.xxhash64("y", "at", "x")))
    got = hashed_sample(cut, SEQUENCES, "h").toArrow()
    sequences, lines = [], 0
    for y, raw in zip(got["y"].to_pylist(), got["x"], strict=True):  # views of the table's memory
        x = np.frombuffer(raw.as_buffer(), np.float32).reshape(-1, FEATURES)
        lines += len(x)
        if lines > LINES:
            break
        sequences.append((x, int(y) % 2))
    model = train(sequences)
    del sequences, got
    release()
    return model


def score_documents(docs: DataFrame, model: LineField, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) for every row, over whole texts of any length; null and empty texts score as one empty line. Rows
    that repeat or share an id are each scored, as is a null id. An empty table gives an empty result; other columns are ignored."""
    tune(docs.sparkSession)
    return over_texts(docs, id_col, text_col, lambda: lambda ids, data, offs: [ids, pa.array(model.score(data, offs), pa.float64())], "doc_id long, score double")


def keep_good(docs: DataFrame, model: LineField, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """Rows of docs, all columns unchanged, whose whole text scores `least` or more; null texts as empty ones, repeated rows each."""
    tune(docs.sparkSession)
    return filtered(docs, text_col, lambda: lambda data, offs: model.score(data, offs) >= least)


def training_rows(id_col: str = "doc_id") -> Column:
    """The labels that op4 learns from: those whose fold isn't 2 of 4."""
    return fold(F.col(id_col), 4) != 2
