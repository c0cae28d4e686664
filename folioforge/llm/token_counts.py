"""Token counts by a two-tier lookup on the map side: no pre-token is shuffled.

The number of a text's tokens is the sum of its pre-tokens' numbers, as merges never reach over a pre-token. A first pass over
all texts finds the frequent pre-tokens: each task keeps a Misra-Gries summary of bounded size, and summaries, a row each, are
merged in a tree. Their lengths are broadcast as a compact table (words joined, a small integer each). The second pass looks
pre-tokens up there; what is missing is encoded once and kept in the worker, up to a bound. The table and the cache change
the cost, never a count.
"""

from __future__ import annotations

import json
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from heapq import nlargest

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from folioforge.llm.common import over_texts, payload, release, tune

#: Frequent pre-tokens that are sent to workers; bytes of the longest one; summaries that one task merges.
FREQUENT, LONGEST, FAN_IN = 16_384, 64, 32
#: Other pre-tokens that a worker keeps, by half of them at a time.
KEEP = 300_000
#: Code points of a text that are matched at a time, if it has a space to cut at.
PIECE = 1 << 20

# fixed values: the normaliser and pre-tokenizer of word_bpe_49k.json
_NORMALISER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

#: Characters that normalisation at most lower-cases, one by one, and whose classes are beyond doubt: ASCII, Latin letters, and general punctuation.
_PLAIN = re.compile("[\x00-\x7f¡«»¿À-ÖØ-öø-įı-ňŊ-ž‐-‧]*")
#: The pattern for such texts in lower case.
_WORDS = re.compile("[a-zß-öø-ž]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^\t-\r a-zß-öø-ž0-9]+")


class Words:
    """The pre-tokens of texts as a tokenizer file of byte-level BPE makes them, and their numbers of tokens. Files with
    other models, or with added tokens that strip spaces or are matched after normalisation, raise an error."""

    def __init__(self, file: str):
        with open(file, encoding="utf-8") as f:
            spec = json.load(f)
        pre, added = spec["pre_tokenizer"] or {}, spec["added_tokens"]
        steps = pre.get("pretokenizers", [pre])
        if spec["model"]["type"] != "BPE" or steps[-1].get("type") != "ByteLevel" or spec["model"].get("dropout"):
            raise ValueError("byte-level BPE is needed")
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError("added tokens must be matched as they are")
        tokenizer = Tokenizer.from_file(file)
        self.model, self.normaliser, self.pre = tokenizer.model, tokenizer.normalizer, tokenizer.pre_tokenizer
        self.special = re.compile("|".join(re.escape(t["content"]) for t in sorted(added, key=lambda t: -len(t["content"])))) if added else None
        self.mark = added[0]["content"][:1] if added else ""
        self.known = (spec["normalizer"] or {}).get("normalizers") == _NORMALISER and steps[0].get("pattern") == {"Regex": _PATTERN} and not steps[-1]["use_regex"] and not steps[-1]["add_prefix_space"]
        # byte-level characters: printable bytes stand for themselves, the others for code points from 256 on
        plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        self.to_char = {b: b for b in plain} | {b: 256 + k for k, b in enumerate(sorted({*range(256)} - {*plain}))}
        self.to_byte = {c: b for b, c in self.to_char.items()}

    def size(self, word: str) -> int:
        """Tokens of a pre-token, by the file's own model."""
        return len(self.model.tokenize(word.encode().decode("latin-1").translate(self.to_char)))

    def parts(self, text: str) -> Iterator[tuple[list[str], int]]:
        """Lists of the text's pre-tokens, and how many special tokens stand between them."""
        if self.mark and self.mark in text and self.special.search(text):
            segments = self.special.split(text)
            yield [], len(segments) - 1
        else:
            segments = [text]
        for segment in segments:
            if self.known and _PLAIN.fullmatch(segment):
                for piece in pieces_of(segment):
                    yield _WORDS.findall(piece.lower()), 0
            elif segment:
                normal = self.normaliser.normalize_str(segment) if self.normaliser else segment
                yield [w if w.isascii() else w.translate(self.to_byte).encode("latin-1").decode() for w, _ in self.pre.pre_tokenize_str(normal)], 0


def pieces_of(text: str) -> Iterator[str]:
    """The text cut before spaces, about PIECE code points at a time; one piece if it has none."""
    start = 0
    while len(text) - start > PIECE:
        cut = text.rfind(" ", start + 1, start + PIECE)
        if cut < 0:
            cut = text.find(" ", start + PIECE)
        if cut < 0:
            break
        yield text[start:cut]
        start = cut
    yield text[start:] if start else text


class Lengths(dict):
    """Numbers of tokens by pre-token: the frequent ones, and behind them what the worker has met, KEEP at most; very long
    pre-tokens aren't kept. What was met since the cache was last half full stays when it is."""

    def __init__(self, words: Words, frequent: dict[str, int]):
        super().__init__(frequent)
        self.words, self.young, self.old = words, {}, {}

    def __missing__(self, word: str) -> int:
        n = self.young.get(word)
        if n is None:
            n = self.old.get(word)
            if n is None:
                n = self.words.size(word)
            if len(word) <= LONGEST:
                if len(self.young) >= KEEP // 2:
                    self.young, self.old = {}, self.young
                self.young[word] = n
        return n


_words: dict[str, Words] = {}
_lengths: dict[str, Lengths] = {}  # of the last table that came


def words(file: str) -> Words:
    if file not in _words:
        _words[file] = Words(file)
    return _words[file]


def trimmed(counts: Counter, size: int) -> Counter:
    """A Misra-Gries step: at most `size` words stay, each count less by the greatest one that goes. A word's count falls
    short by at most the total over size, whatever the order of merges."""
    if len(counts) <= size:
        return counts
    least = nlargest(size + 1, counts.values())[-1]
    return Counter({w: n - least for w, n in counts.items() if n > least})


def _row(place: int, counts: Counter) -> pa.RecordBatch:
    kept = sorted(counts.items())
    return pa.RecordBatch.from_arrays([pa.array([place], pa.int64()), pa.array([[w for w, _ in kept]], pa.list_(pa.string())), pa.array([[n for _, n in kept]], pa.list_(pa.int64()))], ["place", "words", "counts"])


_SUMMARY = "place long, words array<string>, counts array<long>"


def frequent(docs: DataFrame, text_col: str, file: str, size: int = FREQUENT) -> DataFrame:
    """One row (place, words, counts): a summary of the pre-tokens of all texts; no row for an empty table."""

    def summarise(batches):
        w, counts = words(file), Counter()
        for batch in batches:
            data, offs = payload(batch.column(0))
            raw = data.tobytes()
            for a, b in zip(offs[:-1], offs[1:], strict=True):
                for found, _ in w.parts(raw[a:b].decode("utf-8", "replace")):
                    counts.update(found)
                if len(counts) > 8 * size:
                    counts = trimmed(counts, 4 * size)
        counts = Counter({x: n for x, n in counts.items() if len(x) <= LONGEST})
        yield _row(TaskContext.get().partitionId(), trimmed(counts, size))
        release()

    def merge(rows: pa.Table) -> pa.Table:
        counts: Counter = Counter()
        for found, n in zip(rows["words"], rows["counts"], strict=True):
            for w, k in zip(found.as_py(), n.as_py(), strict=True):
                counts[w] += k
            counts = trimmed(counts, size)
        return pa.Table.from_batches([_row(rows["place"][0].as_py() // FAN_IN, counts)])

    out = docs.select(F.col(text_col).cast("string").alias("_text")).mapInArrow(summarise, _SUMMARY)
    for _ in range(3):
        out = out.groupBy(F.expr(f"place div {FAN_IN}").alias("g")).applyInArrow(merge, _SUMMARY)
    return out.groupBy(F.lit(0).alias("g")).applyInArrow(merge, _SUMMARY)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer_file: str | None = None, limit: int = 2048, size: int = FREQUENT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row's whole text, as the tokenizer gives them without added special
    tokens, truncation or padding; strings of special tokens inside a text are those tokens, as is its default.

    Null is the empty text: 0 bytes, 0 tokens. Rows that repeat, share an id or have none are each counted; an empty table
    gives an empty result; other columns are ignored. Long texts are matched a piece at a time, cut before a space.
    """
    tune(docs.sparkSession)
    file = tokenizer_file or default_tokenizer()
    found = frequent(docs, text_col, file, size).head()
    kept = found.words if found else []
    w = words(file)
    sizes = np.array([w.size(x) for x in kept], np.uint16)
    sent = docs.sparkSession.sparkContext.broadcast(("".join(kept), np.array([len(x) for x in kept], np.uint8), sizes))  # `size` words of LONGEST characters at most

    key = uuid.uuid4().hex

    def make():
        if key not in _lengths:
            joined, spans, tokens = sent.value
            ends = np.cumsum(spans, dtype=np.int64).tolist()
            _lengths.clear()
            _lengths[key] = Lengths(words(file), {joined[a:b]: n for a, b, n in zip([0, *ends[:-1]], ends, tokens.tolist(), strict=True)} if ends else {})
        lengths, parts = _lengths[key], words(file).parts

        def f(ids, data, offs):
            raw, n = data.tobytes(), np.zeros(len(offs) - 1, np.int64)
            for k, (a, b) in enumerate(zip(offs[:-1], offs[1:], strict=True)):
                for found, special in parts(raw[a:b].decode("utf-8", "replace")):
                    n[k] += sum(map(lengths.__getitem__, found)) + special
            return [ids, pa.array(np.diff(offs), pa.int64()), pa.array(n), pa.array(n > limit)]

        return f

    return over_texts(docs, id_col, text_col, make, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
