"""Held-out accuracy of the classifiers, and the field's marginals against enumeration."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioforge.llm import langid, quality_crf, queries, toxicity
from folioforge.llm.common import fold

SF = "/root/testdata/sf0.01"
ODD = [(1, None, "en", "s"), (2, "", "en", "s"), (3, "12 34 --", "en", "s"), (None, "the of and", None, "s"), (1, None, "en", "s"), (4, "the\n" * 30_000, "en", "s"), (5, "\n\n\n", None, None)]


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache(), spark.read.parquet(f"{SF}/labels.parquet").cache()


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string, lang string, source string").withColumns({"score": F.lit("clash"), "_id": F.lit(1), "_text": F.lit("x"), "_y": F.lit(7), "_lid": F.lit(7)})


def test_folds_are_crc32(spark):
    import zlib

    got = spark.range(50).select(fold(F.col("id"), 5).alias("f")).collect()
    assert [r.f for r in got] == [zlib.crc32(str(k).encode()) % 5 for k in range(50)]


def test_language_held_out(spark, tables, odd):
    got = queries.op5_language(spark, SF).join(tables[0].select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (got["lang"] == got["lang_pred"]).mean() > 0.97 and got["score"].between(0, 1).all()
    model = langid.fit(tables[0], langid.training_rows())
    assert 0.001 < (model.weights != 0).mean() < 0.5
    rows = [(r.doc_id, r.lang_pred, r.score) for r in langid.predict_languages(odd, model).collect()]
    assert len(rows) == len(ODD) and {r[1] for r in rows if r[0] in (1, 2, 3, 5)} == {"und"} and {r[1] for r in rows if r[0] in (None, 4)} == {"en"}
    kept = langid.keep_identified(odd, model)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} == {None, 4}
    nothing = langid.fit(tables[0].limit(0), langid.training_rows())
    assert {r.lang_pred for r in langid.predict_languages(odd, nothing).collect()} == {"und"}
    assert langid.predict_languages(odd.limit(0), model).count() == 0


def test_temperature_is_that_of_the_draws():
    rng = np.random.default_rng(0)
    z = rng.normal(size=(4000, 3)) * 2
    y = np.array([rng.choice(3, p=langid.softmax(r / 2.5)) for r in z])
    assert abs(langid.fit_temperature(z, y) - 2.5) < 0.3


def test_quality_held_out(spark, tables, odd):
    got = queries.op4_quality(spark, SF).join(tables[1], "doc_id").where("held_out").toPandas()
    assert (got["predicted"] == got["quality"]).mean() > 0.95
    model = quality_crf.fit(tables[0], tables[1], quality_crf.training_rows())
    scores = [(r.doc_id, r.score) for r in quality_crf.score_documents(odd, model).collect()]
    assert len(scores) == len(ODD) and all(0 <= s <= 1 for _, s in scores)
    kept = quality_crf.keep_good(odd, model, least=0.0)
    assert kept.columns == odd.columns and kept.count() == len(ODD)
    assert quality_crf.fit(odd, tables[1].limit(0), quality_crf.training_rows()).score(np.zeros(0, np.uint8), np.array([0, 0])) == [0.5]
    assert quality_crf.fit(odd, tables[1], quality_crf.training_rows()) is not None
    assert quality_crf.score_documents(odd.limit(0), model).count() == 0


def test_marginals_are_those_of_all_labelings():
    rng = np.random.default_rng(1)
    sizes = [1, 4, 2, 6]
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    score, a = rng.normal(size=bounds[-1]), rng.normal(size=(2, 2))
    p, pairs, log_z = quality_crf.marginals(score, bounds, a)
    want, all_pairs, total = np.zeros(len(score)), np.zeros((2, 2)), 0.0
    for s, e in zip(bounds[:-1], bounds[1:], strict=True):
        runs = list(itertools.product((0, 1), repeat=e - s))
        w = np.array([np.exp(sum(score[s + k] * y for k, y in enumerate(r)) + sum(a[u, v] for u, v in itertools.pairwise(r))) for r in runs])
        want[s:e] = (w[:, None] * np.array(runs)).sum(axis=0) / w.sum()
        for r, x in zip(runs, w, strict=True):
            for u, v in itertools.pairwise(r):
                all_pairs[u, v] += x / w.sum()
        total += np.log(w.sum())
    assert np.allclose(p, want) and np.allclose(pairs, all_pairs) and np.isclose(log_z, total)


def test_line_features_by_text():
    """A text's features don't depend on what else is in the batch."""
    texts = ["One two.\ntwo two\n\ntwo two", "", "\n", "A!! B###", "é|é\nx"]
    raw = [t.encode() for t in texts]
    data, offs = np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(r) for r in raw])))
    x, size, bounds = quality_crf.line_features(data, offs)
    assert list(np.diff(bounds)) == [4, 1, 2, 1, 2]
    for k, r in enumerate(raw):
        alone = quality_crf.line_features(np.frombuffer(r, np.uint8), np.array([0, len(r)]))
        assert np.allclose(alone[0], x[bounds[k] : bounds[k + 1]]) and (alone[1] == size[bounds[k] : bounds[k + 1]]).all()


def test_toxicity_held_out(spark, tables, odd):
    got = queries.op6_toxicity(spark, "/root/testdata/sf0.1").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").where("held_out").toPandas()
    order = got["score"].rank()
    n1, n0 = (got["toxic"] == 1).sum(), (got["toxic"] == 0).sum()
    assert (order[got["toxic"] == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * n0) > 0.97
    assert ((got["predicted"] == 1) & (got["toxic"] == 0)).sum() <= 3
    model = toxicity.fit(tables[0], tables[1], toxicity.training_rows())
    rows = toxicity.score_documents(odd, model).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    one_class = toxicity.fit(tables[0], tables[1].where("toxic = 0"), toxicity.training_rows())
    assert len({r.score for r in toxicity.score_documents(odd, one_class).collect()}) == 1
    assert toxicity.score_documents(odd.limit(0), model).count() == 0


def test_presence_by_text():
    """n-grams never reach over two texts."""
    from folioforge.llm.common import folded

    raw = [t.encode() for t in ("abc", "", "de", "abcdé")]
    data, offs = np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(r) for r in raw])))
    text, bins = toxicity.presence(*folded(data, offs), np.ones(1 << toxicity.BITS, bool))
    for k, r in enumerate(raw):
        _, alone = toxicity.presence(*folded(np.frombuffer(r, np.uint8), np.array([0, len(r)])), np.ones(1 << toxicity.BITS, bool))
        assert list(bins[text == k]) == list(alone)


def plain_features(text):
    """Character n-grams of lengths 1 to 3, by hand: runs of what isn't a letter are one space, with one at both ends."""
    low = "".join((c.lower() if len(c.lower()) == 1 else c) if c.isalpha() else " " for c in text)
    return " " + "".join(c for i, c in enumerate(low) if c != " " or i == 0 or low[i - 1] != " ") + " "


def test_language_probabilities_by_hand(spark, tables):
    """TF-IDF, logits and calibrated probabilities of whole texts, n-gram by n-gram."""
    from collections import Counter

    from folioforge.llm.common import hashed_grams

    docs = tables[0].where("length(text) < 600").limit(60)
    model = langid.fit(docs, F.lit(True))
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict_languages(docs, model).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    bins = lambda t: Counter(int(hashed_grams(np.array([ord(c) for c in t[i : i + n]], np.uint32), n, langid.BITS)[0]) for n in langid.GRAMS for i in range(len(t) - n + 1))
    seen = Counter(b for r in docs.where("lang is not null").collect() for b in set(bins(plain_features(r.text))))
    known = docs.where("lang is not null").count()
    for k, text in texts.items():
        x = {b: (1 + np.log(n)) * (np.log((1 + known) / (1 + seen[b])) + 1) for b, n in bins(plain_features(text)).items()}
        norm = np.sqrt(sum(v * v for v in x.values()))
        z = model.weights[-1] + sum(v / norm * model.weights[b] for b, v in x.items())
        p = np.exp(z / model.temperature) / np.exp(z / model.temperature).sum()
        assert got[k][0] == model.languages[int(p.argmax())] and np.isclose(got[k][1], p.max(), rtol=1e-9)


def test_calibration_of_few_rows(spark, tables):
    """Few rows are predicted by models that haven't seen them; no language is left out, and too many are an error."""
    docs = tables[0].where("lang is not null").limit(60)
    model = langid.fit(docs, F.lit(True))
    assert 0.02 < model.temperature < 20 and model.temperature != 1.0
    assert langid.fit(docs.limit(2), F.lit(True)).temperature == 1.0
    many = spark.range(1200).selectExpr("id as doc_id", "concat('text ', id) as text", "concat('l', id) as lang")
    with pytest.raises(ValueError, match="languages"):
        langid.fit(many, F.lit(True))
    copies = docs.limit(1).crossJoin(spark.range(3000)).select("text", "lang").unionByName(docs.select("text", "lang")).selectExpr("1L as doc_id", "text", "lang")
    assert set(langid.fit(copies, F.lit(True), sample=20).languages) == {r.lang for r in docs.collect()}


def test_quality_score_by_hand(spark, tables):
    """The length-weighted mean of the lines' marginals, these by enumeration."""
    model = quality_crf.LineField(np.random.default_rng(0).normal(size=3 * quality_crf.FEATURES + 1), np.random.default_rng(1).normal(size=(2, 2)))
    rows = [(1, "One two.\nbuy!! now!!\n\ntwo two\nlast line here"), (2, ""), (3, "\n\n"), (4, "a"), (5, None)]
    got = {r.doc_id: r.score for r in quality_crf.score_documents(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    for k, text in rows:
        raw = (text or "").encode()
        x, _, _ = quality_crf.line_features(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        zero = np.zeros(quality_crf.FEATURES)
        lines = [np.concatenate((x[i], x[i - 1] if i else zero, x[i + 1] if i + 1 < len(x) else zero, [1.0])) @ model.weights for i in range(len(x))]
        total, good = 0.0, np.zeros(len(x))
        for labels in itertools.product((0, 1), repeat=len(x)):
            w = np.exp(sum(s * y for s, y in zip(lines, labels, strict=True)) + sum(model.transition[a, b] for a, b in itertools.pairwise(labels)))
            total += w
            good += w * np.array(labels)
        size = np.array([len(line) for line in raw.split(b"\n")], float)
        size = size if size.any() else np.ones(len(x))
        assert np.isclose(got[k], (good / total * size).sum() / size.sum(), rtol=1e-6)


def grams_of(text: str) -> set:
    """Bins of all n-grams of a text in lower case, letters only, one n-gram at a time."""
    from folioforge.llm.common import hashed_grams

    low = "".join((c.lower() if len(c.lower()) == 1 else c) if c.isalpha() else " " for c in text)
    return {int(hashed_grams(np.array([ord(c) for c in low[i : i + n]], np.uint32), n, toxicity.BITS)[0]) for n in toxicity.GRAMS for i in range(len(low) - n + 1)}


def test_toxicity_by_hand(spark, tables, monkeypatch):
    """Which n-grams each text has, which are chosen, their log-count ratios, the step that training takes, and the score, in plain Python."""
    from folioforge.llm.common import folded

    docs = tables[0].where("length(text) < 500").limit(80)
    labels = docs.selectExpr("doc_id", "if(doc_id % 3 = 0, 1, 0) as toxic").unionByName(docs.limit(1).selectExpr("doc_id", "1 as toxic"))
    monkeypatch.setattr(toxicity, "FEATURES", 300)
    seen = []
    monkeypatch.setattr(toxicity, "fit_logistic", lambda rows, y, r, f=toxicity.fit_logistic: seen.append((rows, y, r)) or f(rows, y, r))
    model = toxicity.fit(docs, labels, F.lit(True))
    got = {r.doc_id: r.score for r in toxicity.score_documents(docs, model).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    grams, toxic = {k: grams_of(t) for k, t in texts.items()}, {r.doc_id: r.y for r in labels.groupBy("doc_id").agg(F.max("toxic").alias("y")).collect()}
    for k, t in texts.items():
        raw = t.encode()
        _, bins = toxicity.presence(*folded(np.frombuffer(raw, np.uint8), np.array([0, len(raw)])), np.ones(1 << toxicity.BITS, bool))
        assert set(bins.tolist()) == grams[k]
    n = [sum(y == c for y in toxic.values()) for c in (0, 1)]
    counts = {b: [sum(b in grams[k] for k in grams if toxic[k] == c) for c in (0, 1)] for b in set().union(*grams.values())}
    counts = {b: c for b, c in counts.items() if sum(c) >= toxicity.LEAST_DOCUMENTS}

    def z(b: int) -> float:
        p = sum(counts[b]) / sum(n)
        return (counts[b][1] / n[1] - counts[b][0] / n[0]) / math.sqrt(max(p * (1 - p), 1e-9) * (1 / n[0] + 1 / n[1]))

    last = sorted((abs(z(b)) for b in counts), reverse=True)[299]
    chosen = model.bins.tolist()
    assert len(chosen) == 300 and chosen == sorted(chosen) and min(abs(z(b)) for b in chosen) >= last - 1e-9  # ties at the last place aside
    (rows, y, r) = seen[0]
    assert np.allclose(r, [math.log((counts[b][1] + 1) / (n[1] + 2)) - math.log((counts[b][0] + 1) / (n[0] + 2)) for b in chosen])
    assert sorted((int(c), tuple(chosen[i] for i in x)) for x, c in zip(rows, y, strict=True)) == sorted((toxic[k], tuple(b for b in chosen if b in g)) for k, g in grams.items())
    weight = dict(zip(chosen, model.weights, strict=True))
    for k, g in grams.items():
        assert np.isclose(got[k], 1 / (1 + np.exp(-model.bias - sum(weight.get(b, 0.0) for b in g))), atol=1e-9)
    # training lowers the loss
    loss = lambda p: sum(-math.log(q if c else 1 - q) for q, c in zip(p, y, strict=True))
    assert loss([1 / (1 + math.exp(-model.bias - model.weights[x].sum())) for x in rows]) < loss([np.mean(y)] * len(y))
    assert toxicity.fit(docs, labels.where("doc_id < 0"), F.lit(True)).bins.size == 0


def test_several_labels_and_long_documents(spark, monkeypatch):
    """A document with several labels has the greatest; lines that go to the driver are bounded."""
    docs = spark.range(40).selectExpr("id as doc_id", "if(id % 2 = 0, 'Good words here. ', 'x## !!') as t").selectExpr("doc_id", "repeat(concat(t, '\n'), 500) as text")
    labels = docs.selectExpr("doc_id", "1 - doc_id % 2 as quality").unionByName(docs.selectExpr("doc_id", "0 as quality"))
    monkeypatch.setattr(quality_crf, "LINES", 3000)
    seen = []
    monkeypatch.setattr(quality_crf, "train", lambda s, t=quality_crf.train: seen.append(s) or t(s))
    model = quality_crf.fit(docs, labels, F.lit(True))
    assert 2000 < sum(len(x) for x, _ in seen[0]) <= 3000 and all(len(x) <= quality_crf.SEQUENCE for x, _ in seen[0])
    scores = {r.doc_id: r.score for r in quality_crf.score_documents(docs, model).collect()}
    assert min(v for k, v in scores.items() if k % 2 == 0) > max(v for k, v in scores.items() if k % 2)
