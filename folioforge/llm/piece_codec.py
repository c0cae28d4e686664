"""SentencePiece BPE encoding by a prefix table, and decoding.

A piece sequence is the encoding of a text if and only if each neighbouring pair (a, b) is compatible, that is, if
a + b alone encodes to a, b: merges go by score and then from the left, and what happens on one side of a boundary that
is never crossed doesn't depend on the other side. So each prefix has one last piece: the piece that an Aho-Corasick
automaton finds ending there and that is compatible with the last piece of the prefix before it. The table of last
pieces is filled from the left, and the ids are recovered from its end backwards.

No piece has a word-begin mark after another character, and characters without a piece merge with nothing, so the table
is filled a word at a time, and words already seen are kept, up to a bound.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Callable, Iterable
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from folioforge.llm.common import over_texts, tune

MARK = "▁"
#: Word-begin marks with what follows them, up to the next one or a line's end.
_UNITS = re.compile(f"[ {MARK}]*[^ {MARK}\n]+|[ {MARK}]+|\n")
#: Words (by half of them at a time) and pairs that a worker keeps.
KEEP = 500_000


class _Kept(dict):
    """Results of make by word, KEEP of them at most; keeps no very long words. Words used since it was last half
    full stay when it is."""

    def __init__(self, make: Callable):
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, word: str):
        got = self.old.get(word)
        if got is None:
            got = self.make(word)
        if len(word) < 64:
            if len(self) >= KEEP // 2:
                self.old = dict(self)
                self.clear()
            self[word] = got
        return got


class PieceModel:
    """The encoder and decoder of one model file of type BPE with byte fallback and the identity normaliser."""

    def __init__(self, model_file: str):
        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        n = sp.get_piece_size()
        if n > 1 << 16:
            raise ValueError("models of over 65,536 pieces are not supported")
        self.decimal = list(map(str, range(n)))
        self.text = [sp.id_to_piece(i) for i in range(n)]
        self.ids, self.score, self.byte = {}, {}, [0] * 256
        self.surface = [b""] * n
        for i, piece in enumerate(self.text):
            if sp.is_byte(i):
                self.byte[int(piece[3:5], 16)] = i
                self.surface[i] = bytes([int(piece[3:5], 16)])
            elif sp.is_unknown(i):
                self.surface[i] = " ⁇ ".encode()
            elif not sp.is_control(i):
                self.ids[piece] = i
                self.score[piece] = sp.get_score(i)
                self.surface[i] = piece.replace(MARK, " ").encode()
        self.single = {p for p in self.ids if len(p) == 1}
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            self.automaton.add_word(piece, (len(piece), i))
        self.automaton.make_automaton()
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("pieces that reach over words are not supported")
        whole = [i for p, i in self.ids.items() if len(p) > 1 and self._merge(p) != [p]]
        self.unreachable = frozenset(whole)
        odd = "".join(sorted(self.single - {MARK}))
        self.words = re.compile(f"{MARK}*[{re.escape(odd)}]+|{MARK}+|.", re.S)
        self.pairs: dict[tuple[int, int], bool] = {}
        self.known = _Kept(self._known)
        self.plain = all(chr(c) in self.single for c in range(33, 127))
        self.units = _Kept(lambda w: self._parts(w.replace(" ", MARK)))

    def _merge(self, text: str) -> list[str]:
        """The definition: merge the neighbours whose union has the highest score, the leftmost first."""
        parts = list(text)
        score = self.score
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                s = score.get(parts[k] + parts[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compatible(self, a: int, b: int) -> bool:
        got = self.pairs.get((a, b))
        if got is None:
            if len(self.pairs) >= KEEP:
                self.pairs.clear()
            x, y = self.text[a], self.text[b]
            got = self.pairs[a, b] = self._merge(x + y) == [x, y]
        return got

    def word(self, word: str) -> tuple[int, ...]:
        """Ids of a word of known characters, or of a single character without a piece, by the prefix table."""
        if (i := self.ids.get(word)) is not None and i not in self.unreachable:
            return (i,)
        if word not in self.single and len(word) == 1:
            return tuple(self.byte[b] for b in word.encode())
        n = len(word)
        last, sizes = [0] * (n + 1), [0] * (n + 1)
        pairs, bad, done = self.pairs, self.unreachable, 0
        for end, (size, piece) in self.automaton.iter(word):
            if end < done:
                continue
            if size <= end:
                p = last[end + 1 - size]
                ok = pairs.get((p, piece))
                if ok is None:
                    ok = self.compatible(p, piece)
                if not ok:
                    continue
            if piece in bad:
                continue
            done = end + 1
            last[done], sizes[done] = piece, size
        out = []
        while n:
            out.append(last[n])
            n -= sizes[n]
        out.reverse()
        return tuple(out)

    def _parts(self, word: str) -> bytes:
        return array("H", chain.from_iterable(map(self.word, self.words.findall(word)))).tobytes()

    def _known(self, w: str) -> bytes:
        """A word that a space or a line's end stands before; the line's end is part of it."""
        if w[0] == "\n" or not (self.plain and w.isascii() and w.isprintable()):
            return self._parts(w if w[0] == "\n" else MARK + w)
        return array("H", self.word(MARK + w)).tobytes()

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text. Words are kept as packed ids, which are half as large as lists and cost the collector nothing."""
        if not text:
            return []
        lines = text.replace("\n", " \n")
        if MARK in text or "  " in lines or lines[0] == " " or lines[-1] == " ":
            packed = map(self.units.__getitem__, _UNITS.findall(" " + text))
        else:
            packed = map(self.known.__getitem__, lines.split(" "))
        return np.frombuffer(b"".join(packed), np.uint16).tolist()

    def digest(self, ids: list[int]) -> str:
        """SHA-256 of the decimal ids with commas between."""
        return hashlib.sha256(",".join(map(self.decimal.__getitem__, ids)).encode()).hexdigest()

    def decode(self, ids: Iterable[int]) -> str:
        """Surfaces joined, bytes put together to characters, the space before the first word dropped."""
        raw = b"".join(map(self.surface.__getitem__, ids))
        text = raw.decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


_models: dict[str, PieceModel] = {}


def model(path: str) -> PieceModel:
    if path not in _models:
        _models[path] = PieceModel(path)
    return _models[path]


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _worker(path: str, digest_only: bool) -> Callable:
    def make():
        m = model(path)

        def f(ids, data, offs):
            raw = data.tobytes()
            n, sha, back, listed, texts = [], [], [], [], []
            for a, b in zip(offs[:-1], offs[1:], strict=True):
                tokens = m.encode(raw[a:b].decode("utf-8", "replace"))
                text = m.decode(tokens)
                n.append(len(tokens))
                if digest_only:
                    sha.append(m.digest(tokens))
                    back.append(hashlib.sha256(text.encode()).hexdigest())
                else:
                    listed.append(tokens)
                    texts.append(text)
            counts = pa.array(n, pa.int64())
            return [ids, counts, pa.array(sha, pa.string()), pa.array(back, pa.string())] if digest_only else [ids, counts, pa.array(listed, pa.list_(pa.int32())), pa.array(texts, pa.string())]

        return f

    return make


def encode_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_file: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) for every row, whole texts, without begin or end ids.

    Null is taken as the empty text: no ids. Repeated rows and null ids are kept as they are; other columns are
    ignored. A text of any length is encoded whole; words of over 63 characters are not kept for later use.
    """
    tune(docs.sparkSession)
    return over_texts(docs, id_col, text_col, _worker(model_file or default_model(), False), "doc_id long, n_tokens long, ids array<int>, decoded string")


def encode_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_file: str | None = None) -> DataFrame:
    """As encode_documents, with SHA-256 digests in the place of the ids and the decoded text."""
    tune(docs.sparkSession)
    return over_texts(docs, id_col, text_col, _worker(model_file or default_model(), True), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
