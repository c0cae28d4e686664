"""Token counts against the library, and summaries against true counts."""

import random
from collections import Counter

import pytest
from tokenizers import Tokenizer

from folioforge.llm import token_counts as T
from pyspark.sql import functions as F

BITS = [
    "a", "e", "th", " ", "  ", "'", "'s", "'re", "\n", "\t", "é", "É", "中", "😀", "the", "----", "0", "12", "A", "The", "<|startoftext|>", "<|endoftext|>", "<|", "İ", "ß", "ẞ", "é", "́",
    "\x1c", "\x85", "\xa0", "\x00", "²", "½", "ª", "«", "—", "’", "…", " ", "ŉ", "ſ", "Ω", "K", "Å", "\x0b", "\x0c", "٣", "_", "!", "Š", "Ÿ", "ǅ",
]


def library():
    tokenizer = Tokenizer.from_file(T.default_tokenizer())
    return lambda texts: [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def counted(texts: list[str], lengths: T.Lengths) -> list[int]:
    return [sum(sum(map(lengths.__getitem__, found)) + special for found, special in lengths.words.parts(t)) for t in texts]


def test_counts_are_those_of_the_library(monkeypatch):
    monkeypatch.setattr(T, "PIECE", 50)  # long texts are cut
    rng = random.Random(1)
    texts = ["".join(rng.choice(BITS) for _ in range(rng.randint(0, 40))) for _ in range(4000)]
    texts += [f"ab{chr(c)}cd {chr(c)} 1{chr(c)}2" for c in range(0x3000)]  # every class of the first scripts
    texts += ["word " * 5000, "a" * 20_000, "'" * 300 + "s", "x'sy'll 'd've" * 40]
    w = T.words(T.default_tokenizer())
    want = library()(texts)
    assert counted(texts, T.Lengths(w, {})) == want
    monkeypatch.setattr(T, "KEEP", 20)  # the cache is emptied again and again
    assert counted(texts, T.Lengths(w, {"the": 1})) == want


def test_other_files():
    import public_tokenizers

    file = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer, texts = Tokenizer.from_file(file), ["The  cat's  é 12345 \n\n x", "<|endoftext|> a", "  lead", "😀😀 中文"]
    assert counted(texts, T.Lengths(T.Words(file), {})) == [len(tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]


def test_rows(spark):
    rows = [(1, "The cat's <|endoftext|> é"), (1, "The cat's <|endoftext|> é"), (2, None), (None, "x"), (3, ""), (4, " \n "), (5, "ab " * 3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"n_tokens": F.lit("clash"), "_id": F.lit(0), "place": F.lit("x")}).repartition(3)
    want = library()([t or "" for _, t in rows])
    for size in (1, 4, T.FREQUENT):  # the sent table changes no count
        got = sorted(map(str, T.count_tokens(df, size=size).collect()))
        assert got == sorted(f"Row(doc_id={k}, n_bytes={len((t or '').encode())}, n_tokens={n}, over_limit={n > 2048})" for (k, t), n in zip(rows, want, strict=True))
    assert T.count_tokens(df.limit(0)).collect() == []
    assert T.count_tokens(df.where("text is null")).select("n_tokens").collect() == [(0,)]


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    assert {r.doc_id: r.n_tokens for r in T.count_tokens(docs.repartition(5)).collect()} == dict(zip(texts, library()([*texts.values()]), strict=True))


@pytest.mark.parametrize("size", [3, 10, 100])
def test_summaries_keep_the_frequent(spark, size):
    rng = random.Random(size)
    texts = [" ".join(f"{'ab' if rng.random() < 0.4 else 'cd'}" if rng.random() < 0.8 else chr(97 + rng.randrange(26)) * 3 for _ in range(50)) for _ in range(100)]
    true, total = Counter(" ".join(texts).split()), 5000
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(40)
    (row,) = T.frequent(df, "text", T.default_tokenizer(), size).collect()
    got = dict(zip(row.words, row.counts, strict=True))
    assert len(got) <= size and all(true[w] - total / size <= got.get(w, 0) <= true[w] for w in true)
    assert size < 28 or got == true
