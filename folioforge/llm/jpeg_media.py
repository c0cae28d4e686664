"""Media columns: baseline JPEG, written and read in numpy.

A payload is stored losslessly as the quantised coefficients of 8 x 8 blocks, the unit that a JPEG scan codes without
loss: byte k of a block is its k-th coefficient in zigzag order, as a signed 8-bit number. Each block is a restart
interval, so all blocks of a batch are decoded in step, one symbol at a time. Files of other writers (several
components, subsampling, any restart interval or none) go through a decoder that works block after block.

Features come from the DC coefficients of the luminance alone: a thumbnail of a pixel a block, and its hash.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from folioforge.llm.common import over_texts, tune

BLOCK = 64
#: The APP15 segment that holds the payload's length.
TAG = b"FOLIO\0"
_U = np.uint64


class Huffman:
    """A canonical table from the numbers of codes by length 1..16 and the symbols in the order of their codes."""

    def __init__(self, lengths: bytes, symbols: bytes):
        self.lengths, self.symbols = lengths, symbols
        self.code, self.size = np.zeros(256, np.int64), np.zeros(256, np.int64)
        self.window_symbol, self.window_size = np.zeros(65536, np.int64), np.zeros(65536, np.int64)
        code = k = 0
        for n, count in enumerate(lengths, 1):
            for _ in range(count):
                s = symbols[k]
                self.code[s], self.size[s] = code, n
                a = code << (16 - n)
                self.window_symbol[a : a + (1 << (16 - n))], self.window_size[a : a + (1 << (16 - n))] = s, n
                code, k = code + 1, k + 1
            code <<= 1

    @classmethod
    def of(cls, sizes: dict[int, int]) -> Huffman:
        order = sorted(sizes, key=lambda s: (sizes[s], s))
        return cls(bytes(sum(v == n for v in sizes.values()) for n in range(1, 17)), bytes(order))


#: Short codes for sizes 7 and 6 (letters and spaces), a code for every (run, size) that a signed byte can give.
DC = Huffman.of({7: 1, 6: 2} | dict.fromkeys((0, 1, 2, 3, 4, 5, 8), 5))
AC = Huffman.of({0x07: 1, 0x06: 2, 0x05: 4, 0x00: 4} | dict.fromkeys((0x08, 0x04, 0x03, 0x02, 0x01, 0xF0), 6) | {r << 4 | s: 12 for r in range(1, 16) for s in range(1, 9)})
_SIZE = np.array([abs(v if v < 128 else v - 256).bit_length() for v in range(256)], np.int64)


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


_TABLES = _segment(0xC4, b"\x00" + DC.lengths + DC.symbols) + _segment(0xC4, b"\x10" + AC.lengths + AC.symbols)


def grid(blocks: int) -> tuple[int, int]:
    """Blocks across and down of the nearly square picture that holds so many."""
    across = int(np.ceil(np.sqrt(blocks)))
    down = -(-blocks // across)
    if max(across, down) > 8191:
        raise ValueError("a payload of over 4 GB doesn't fit a JPEG picture")
    return across, down


def header(across: int, down: int, payload_bytes: int) -> bytes:
    frame = struct.pack(">BHHBBBB", 8, down * 8, across * 8, 1, 1, 0x11, 0)
    return b"\xff\xd8" + _segment(0xEF, TAG + struct.pack(">Q", payload_bytes)) + _segment(0xDB, b"\x00" + b"\x01" * 64) + _segment(0xC0, frame) + _TABLES + _segment(0xDD, b"\x00\x01") + _segment(0xDA, b"\x01\x01\x00\x00\x3f\x00")


def encode_scans(blocks: np.ndarray, first: np.ndarray) -> list[bytes]:
    """Entropy-coded scans: blocks is n x 64 int8 in zigzag order, first the pictures' offsets in blocks. Each block is an interval."""
    n = len(blocks)
    flat = blocks.copy()
    flat[:, 0] = 0
    row, col = np.divmod(np.flatnonzero(flat.ravel()), BLOCK)
    value = blocks[row, col].astype(np.int64)
    before = np.zeros(len(col), np.int64)
    before[1:] = np.where(row[1:] == row[:-1], col[:-1], 0)
    run = col - before - 1
    long_runs, run = run >> 4, run & 15
    count = np.bincount(row, minlength=n)
    extra = np.bincount(row, long_runs, n).astype(np.int64)
    last = np.zeros(n, np.int64)
    last[row] = col
    ends = (last < 63).astype(np.int64)
    tokens = 1 + count + extra + ends + 1  # DC, AC, runs of 16 zeros, end of block, padding
    start = np.concatenate(([0], np.cumsum(tokens)))
    bits, size = np.zeros(start[-1], np.int64), np.zeros(start[-1], np.int64)

    def amplitude(v, s):
        return np.where(v < 0, v + (1 << s) - 1, v)

    dc = blocks[:, 0].astype(np.int64)
    s = _SIZE[dc & 255]
    bits[start[:-1]], size[start[:-1]] = DC.code[s] << s | amplitude(dc, s), DC.size[s] + s
    ahead = np.cumsum(long_runs)
    base = np.concatenate(([0], np.cumsum(count)))[:-1]
    zeros_before = np.concatenate(([0], np.cumsum(extra)))[:-1]
    at = start[row] + 1 + (np.arange(len(row)) - base[row]) + (ahead - zeros_before[row])
    s = _SIZE[value & 255]
    symbol = run << 4 | s
    bits[at], size[at] = AC.code[symbol] << s | amplitude(value, s), AC.size[symbol] + s
    for j in np.flatnonzero(long_runs):
        w = at[j] - 1 - np.arange(long_runs[j])
        bits[w], size[w] = AC.code[0xF0], AC.size[0xF0]
    e = start[1:][ends > 0] - 2
    bits[e], size[e] = AC.code[0], AC.size[0]
    total = np.concatenate(([0], np.cumsum(size)))
    used = total[start[1:]] - total[start[:-1]]
    width = (used + 7) >> 3
    pad = (width << 3) - used
    bits[start[1:] - 1], size[start[1:] - 1] = (1 << pad) - 1, pad
    place = np.concatenate(([0], np.cumsum(width)))
    at = total[:-1] + np.repeat((place[:-1] << 3) - total[start[:-1]], tokens)
    window = bits << (32 - size - (at & 7))
    sums = np.bincount(at >> 3, window, place[-1] + 4).astype(np.uint64).astype(np.int64)[: place[-1]]
    out = sums >> 24 & 255
    for k in (1, 2, 3):
        out[k:] |= sums[: len(out) - k] >> (24 - 8 * k) & 255
    # a 0 after each 255, and a restart marker after each block but a picture's last
    more = (out == 255).astype(np.int64)
    final = np.zeros(n, bool)
    final[first[1:] - 1] = True
    more[place[1:] - 1] += 2 * ~final
    move = np.concatenate(([0], np.cumsum(more)))
    raw = np.zeros(len(out) + move[-1], np.uint8)
    raw[np.arange(len(out)) + move[:-1]] = out
    within = np.arange(n) - np.repeat(first[:-1], np.diff(first))
    mark = (place[1:] + move[place[1:]] - 2)[~final]
    raw[mark], raw[mark + 1] = 255, 0xD0 + within[~final] % 8
    ends_at = (place + move[place])[first]
    whole = raw.tobytes()
    return [whole[a:b] for a, b in zip(ends_at[:-1], ends_at[1:], strict=True)]


def write_payloads(data: np.ndarray, offs: np.ndarray) -> list[bytes]:
    """A JPEG file for each text, its bytes padded with 0 to a positive multiple of 64."""
    sizes = np.diff(offs)
    need = np.maximum(1, -(-sizes // BLOCK))
    grids = [grid(int(k)) for k in need]
    first = np.concatenate(([0], np.cumsum([a * b for a, b in grids])))
    flat = np.zeros(first[-1] * BLOCK, np.int8)
    flat[np.arange(len(data)) + np.repeat(first[:-1] * BLOCK - offs[:-1], sizes)] = data.view(np.int8)
    scans = encode_scans(flat.reshape(-1, BLOCK), first)
    return [header(a, b, int(k) * BLOCK) + scan + b"\xff\xd9" for (a, b), k, scan in zip(grids, need, scans, strict=True)]


@dataclass
class Picture:
    """What the markers tell, and where the scan starts."""

    width: int = 0
    height: int = 0
    components: list[tuple[int, int, int, int]] = field(default_factory=list)  # id, across, down, quantiser
    quantisers: dict[int, np.ndarray] = field(default_factory=dict)
    tables: dict[int, tuple[bytes, bytes]] = field(default_factory=dict)
    interval: int = 0
    scan: list[tuple[int, int, int]] = field(default_factory=list)  # id, DC table, AC table
    start: int = 0
    payload_bytes: int | None = None


def parse(file: bytes) -> Picture:
    """Read the markers up to the first scan; ValueError for what isn't baseline JPEG."""
    if file[:2] != b"\xff\xd8":
        raise ValueError("no start of image")
    out, at = Picture(), 2
    while at + 4 <= len(file):
        if file[at] != 0xFF:
            raise ValueError("a marker is missing")
        marker = file[at + 1]
        if marker == 0xFF or marker == 1 or 0xD0 <= marker <= 0xD7:
            at += 1 if marker == 0xFF else 2
            continue
        size = int.from_bytes(file[at + 2 : at + 4], "big")
        body = file[at + 4 : at + 2 + size]
        if marker == 0xDB:
            while body:
                wide = body[0] >> 4
                n = 64 * (1 + wide)
                out.quantisers[body[0] & 15] = np.frombuffer(body[1 : 1 + n], ">u2" if wide else np.uint8).astype(np.int64)
                body = body[1 + n :]
        elif marker in (0xC0, 0xC1):
            precision, out.height, out.width, n = struct.unpack(">BHHB", body[:6])
            if precision != 8:
                raise ValueError("not 8-bit samples")
            out.components = [(body[6 + 3 * k], body[7 + 3 * k] >> 4, body[7 + 3 * k] & 15, body[8 + 3 * k]) for k in range(n)]
        elif 0xC2 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
            raise ValueError("not a baseline picture")
        elif marker == 0xC4:
            while body:
                n = sum(body[1:17])
                out.tables[body[0]] = (body[1:17], body[17 : 17 + n])
                body = body[17 + n :]
        elif marker == 0xDD:
            out.interval = int.from_bytes(body[:2], "big")
        elif marker == 0xEF and body.startswith(TAG):
            out.payload_bytes = int.from_bytes(body[len(TAG) : len(TAG) + 8], "big")
        elif marker == 0xDA:
            out.scan = [(body[1 + 2 * k], body[2 + 2 * k] >> 4, body[2 + 2 * k] & 15) for k in range(body[0])]
            out.start = at + 2 + size
            if not out.components:
                raise ValueError("a scan without a frame")
            return out
        at += 2 + size
    raise ValueError("no scan")


_huffman: dict[tuple[bytes, bytes], Huffman] = {}


def _table(key: tuple[bytes, bytes]) -> Huffman:
    if key not in _huffman:
        _huffman[key] = Huffman(*key)
    return _huffman[key]


def decode_intervals(scan: np.ndarray, pictures: np.ndarray, dc: Huffman, ac: Huffman) -> np.ndarray:
    """All blocks (n x 64) of one-component scans whose blocks are intervals; pictures holds where each scan starts."""
    after = np.concatenate((scan[1:], [0]))
    escape = scan == 255
    mark = escape & (after >= 0xD0) & (after <= 0xD7)
    drop = mark.copy()
    drop[1:] |= escape[:-1] & ((scan[1:] == 0) | mark[:-1])
    clean = np.concatenate((scan[~drop], np.full(8, 255, np.uint8)))
    kept = np.concatenate(([0], np.cumsum(~drop)))
    pos = np.sort(np.concatenate((kept[pictures], kept[np.flatnonzero(mark)]))) << 3
    wide = clean.astype(_U)
    window = wide << _U(56)
    for k in range(1, 8):
        window[: len(wide) - k] |= wide[k:] << _U(56 - 8 * k)
    out = np.zeros((len(pos), BLOCK), np.int64)
    flat = out.ravel()
    index, k = np.arange(len(pos)), np.zeros(len(pos), np.int64)
    table = dc
    while len(index):
        w = window[pos >> 3] << (pos & 7).astype(_U)
        code = (w >> _U(48)).astype(np.int64)
        symbol, length = table.window_symbol[code], table.window_size[code]
        if not length.all():
            raise ValueError("a code that the table doesn't have")
        size = symbol & 15
        value = ((w << length.astype(_U)) >> _U(1) >> (63 - size).astype(_U)).astype(np.int64)
        value -= np.where(value < (1 << size >> 1), (1 << size) - 1, 0)
        pos = pos + length + size
        if table is dc:
            flat[index * BLOCK] = value
            k += 1
            table = ac
            continue
        k = k + (symbol >> 4)
        some = size > 0
        if (k[some] > 63).any():
            raise ValueError("a run beyond the block")
        flat[(index * BLOCK + k)[some]] = value[some]
        k += 1
        going = (k < BLOCK) & (some | (symbol == 0xF0))
        if not going.all():
            index, k, pos = index[going], k[going], pos[going]
    return out


def decode_blocks(file: bytes, p: Picture) -> dict[int, np.ndarray]:
    """Coefficients by component id (rows x columns x 64) of any baseline scan, one block after another."""
    comps = {c[0]: c for c in p.components}
    single = len(p.scan) == 1
    most_h, most_v = max(c[1] for c in p.components), max(c[2] for c in p.components)
    across, down = -(-p.width // (8 * most_h)), -(-p.height // (8 * most_v))
    if single:
        c = comps[p.scan[0][0]]
        across, down = -(-(-(-p.width * c[1] // most_h)) // 8), -(-(-(-p.height * c[2] // most_v)) // 8)
    out = {i: np.zeros((down * (1 if single else comps[i][2]), across * (1 if single else comps[i][1]), BLOCK), np.int64) for i, *_ in p.scan}
    at, buffer, have = p.start, 0, 0

    def bits(n: int) -> int:
        nonlocal at, buffer, have
        while have < n:
            byte = file[at] if at < len(file) else 255
            if byte == 255 and at + 1 < len(file) and file[at + 1] != 0:
                byte = 255  # a marker: the rest reads as ones
            else:
                at += 1 + (byte == 255)
            buffer, have = (buffer << 8 | byte) & ((1 << 48) - 1), have + 8
        return buffer >> (have - n) & ((1 << n) - 1)

    def take(n: int) -> int:
        nonlocal have
        v = bits(n) if n else 0
        have -= n
        return v

    def symbol(t: Huffman) -> int:
        code = bits(16)
        if not t.window_size[code]:
            raise ValueError("a code that the table doesn't have")
        take(int(t.window_size[code]))
        return int(t.window_symbol[code])

    def signed(n: int) -> int:
        v = take(n)
        return v if not n or v >> (n - 1) else v - (1 << n) + 1

    last = dict.fromkeys(out, 0)
    for mcu in range(across * down):
        if p.interval and mcu and mcu % p.interval == 0:
            have = 0
            while at + 1 < len(file) and not (file[at] == 255 and 0xD0 <= file[at + 1] <= 0xD7):
                at += 1
            at, last = at + 2, dict.fromkeys(out, 0)
        for i, d, a in p.scan:
            h, v = (1, 1) if single else comps[i][1:3]
            dc, ac = _table(p.tables[d]), _table(p.tables[16 | a])
            for y in range(v):
                for x in range(h):
                    block = out[i][mcu // across * v + y, mcu % across * h + x]
                    last[i] += signed(symbol(dc))
                    block[0] = last[i]
                    k = 1
                    while k < 64:
                        s = symbol(ac)
                        if not s & 15:
                            if s != 0xF0:
                                break
                            k += 16
                            continue
                        k += s >> 4
                        block[k] = signed(s & 15)
                        k += 1
    return out


def thumbnail(dc: np.ndarray, quantiser: int) -> np.ndarray:
    """A pixel a block from the luminance's DC coefficients."""
    return np.clip(np.rint(dc * quantiser / 8) + 128, 0, 255).astype(np.uint8)


def feature(pixels: np.ndarray, width: int, height: int) -> str:
    """Dimensions and a 64-bit average hash of the thumbnail at 8 x 8."""
    y, x = np.arange(8) * pixels.shape[0] // 8, np.arange(8) * pixels.shape[1] // 8
    small = pixels[y[:, None], x[None, :]].astype(np.int64)
    return f"{width}x{height}:{np.packbits(64 * small > small.sum()).tobytes().hex()}"


def read_media(files: list[bytes]) -> list[tuple[bytes | None, str | None]]:
    """For each file the payload (None if it holds none) and the feature; (None, None) for what isn't baseline JPEG."""
    out: list = [(None, None)] * len(files)
    fast: dict = {}
    for i, f in enumerate(files):
        try:
            p = parse(f)
            if p.interval == 1 and len(p.components) == len(p.scan) == 1:
                fast.setdefault((p.tables[p.scan[0][1]], p.tables[16 | p.scan[0][2]]), []).append((i, p))
            else:
                out[i] = _finish(p, decode_blocks(f, p)[p.components[0][0]])
        except (ValueError, KeyError, IndexError, struct.error):
            pass
    for (dc, ac), some in fast.items():
        try:
            got = _in_step(files, some, _table(dc), _table(ac))
        except (ValueError, IndexError):  # one file is damaged: each on its own
            got = []
            for one in some:
                try:
                    got += _in_step(files, [one], _table(dc), _table(ac))
                except (ValueError, IndexError):
                    got.append((None, None))
        for (i, _), x in zip(some, got, strict=True):
            out[i] = x
    return out


def _in_step(files: list[bytes], some: list, dc: Huffman, ac: Huffman) -> list:
    scans = [files[i][p.start : -2] for i, p in some]
    shapes = [(-(-p.height // 8), -(-p.width // 8)) for _, p in some]
    starts = np.concatenate(([0], np.cumsum([len(s) for s in scans])))[:-1]
    blocks = decode_intervals(np.frombuffer(b"".join(scans), np.uint8), starts, dc, ac)
    first = np.concatenate(([0], np.cumsum([a * b for a, b in shapes])))
    if first[-1] != len(blocks):
        raise ValueError("blocks are missing")
    return [_finish(p, blocks[a:b].reshape(*shape, BLOCK)) for (_, p), shape, a, b in zip(some, shapes, first[:-1], first[1:], strict=True)]


def _finish(p: Picture, luminance: np.ndarray) -> tuple[bytes | None, str]:
    pixels = thumbnail(luminance[:, :, 0], int(p.quantisers[p.components[0][3]][0]))
    stored = None if p.payload_bytes is None else luminance.reshape(-1)[: p.payload_bytes].astype(np.int8).tobytes()
    return stored, feature(pixels, p.width, p.height)


def to_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, media): each whole text as a JPEG file. Null is the empty text: one block of zeros."""
    tune(docs.sparkSession)

    def make():
        return lambda ids, data, offs: [ids, pa.array(np.diff(offs), pa.int64()), pa.array(write_payloads(data, offs), pa.binary())]

    return over_texts(docs, id_col, text_col, make, "doc_id long, n_bytes long, media binary", limit=1 << 18)


def media_features(media: DataFrame) -> DataFrame:
    """What the files of a (doc_id, n_bytes, media) table hold: doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes,
    media_sha256, feature. Payload columns are null for files without one, and all but the media's for null or damaged files."""

    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 64):
                part = batch.slice(a, 64)
                files = [x or b"" for x in part.column(2).to_pylist()]
                rows = read_media(files)
                sha = lambda x: hashlib.sha256(x).hexdigest()
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), part.column(1),
                        pa.array([None if b is None else len(b) for b, _ in rows], pa.int64()),
                        pa.array([None if b is None else sha(b) for b, _ in rows], pa.string()),
                        pa.array([None if b is None else zlib.crc32(b[-64:]) for b, _ in rows], pa.int64()),
                        pa.array([len(f) for f in files], pa.int64()), pa.array([sha(f) for f in files], pa.string()),
                        pa.array([f for _, f in rows], pa.string()),
                    ],
                    ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"],
                )

    return media.mapInArrow(run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
