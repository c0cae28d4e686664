"""Character sets, entities, white space and markup counts."""

from __future__ import annotations

import functools
import html
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from folioforge.functions import arrow_function

# fixed values: characters taken as a space and as a line's end
SPACES = "\t\x1f\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"
NEWLINES = "\n\x0b\x0c\r\x1c\x1d\x1e\x85\u2028\u2029"
# fixed values: references that are replaced or deleted before all others are resolved
REPAIRS = {
    "&#129;": "&uuml;",
    "&#157;": "",
    "&#822;": "&ndash;",
    "&#1467;": "",
    "&#1560;": "",
    "&#8203;": "",
    "&lrm;": "",
    "&rlm;": "",
    "&#8288;": "",
    "&#8289;": "",
    "&#11834;": "&mdash;",
    "&#61620;": "&times;",
    "&#65533;": "",
}


def reduce_space(text: Column, keep_pre: Column | bool = False) -> Column:
    """Spaces to one kind, line ends to newlines, runs collapsed, lines trimmed, at most one empty line.
    keep_pre: texts with a <pre> element lose spaces only at a line's start before a tag, and at a line's end."""
    t = F.translate(text, SPACES, " " * len(SPACES))
    t = F.translate(F.replace(t, F.lit("\r\n"), F.lit("\n")), NEWLINES, "\n" * len(NEWLINES))
    out = F.regexp_replace(F.regexp_replace(t, " +", " "), "(?d)(?m)^ | $", "")
    if keep_pre is not False:
        sparing = text.rlike("(?i)<pre[ >]")
        sparing = sparing if keep_pre is True else sparing & keep_pre
        out = F.when(sparing, F.regexp_replace(t, "(?d)(?m)^ +(?=<)| +$", "")).otherwise(out)
    return F.regexp_replace(out, "\n{3,}", "\n\n")


def cleaned(html: Column, keep_pre: Column | bool = False) -> Column:
    """Entities repaired, then white space reduced; keep_pre by source: true for the weeklies' (F17)."""
    return reduce_space(repair_entities(html), keep_pre)


def repair_known(text: Column) -> Column:
    """The named repairs (F13, first part): a thin space before three digits is a comma; listed references change or go."""
    t = F.regexp_replace(text, r"&thinsp;(?=\d{3})", ",")
    for a, b in REPAIRS.items():
        t = F.replace(t, F.lit(a), F.lit(b))
    return t


@arrow_function("string")
def unescape(text: pd.Series) -> pd.Series:
    return text.map(html.unescape, na_action="ignore")


def repair_entities(text: Column) -> Column:
    """All references resolved (F13). Texts without an ampersand come back as they are."""
    return unescape(repair_known(text))


def only_references(text: Column, *names: str) -> Column:
    """The text with an escaped ampersand for each that doesn't begin one of the named references, semicolon included: resolved, it has those alone resolved."""
    return F.regexp_replace(text, f"&(?!(?:{'|'.join(names)});)", "&amp;")


def unescape_common(text: Column) -> Column:
    """The references that this corpus' pages hold, without Python; the ampersand last."""
    for name, char in (("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        text = F.replace(text, F.lit(name), F.lit(char))
    return text


@arrow_function("char string, codepoint string, name string, canonical string")
def resolve_reference(ref: pd.Series) -> pd.DataFrame:
    """A reference's characters, code points, Unicode names and HTML name (F10); control characters are written as
    escapes, what isn't a reference gives nulls. For distinct references: join the result."""
    shown = {"\t": "\\t", "\n": "\\n", "\v": "\\v", "\f": "\\f", "\r": "\\r"}
    rows = []
    for r in ref:
        c = html.unescape(r)
        if c == r:
            rows.append((None, None, None, None))
        else:
            name = html.entities.codepoint2name.get(ord(c)) if len(c) == 1 else None
            rows.append(("".join(shown.get(x, x) for x in c), " ".join(f"U+{ord(x):04X}" for x in c), "; ".join(unicodedata.name(x, "no name") for x in c), name))
    return pd.DataFrame(rows, columns=["char", "codepoint", "name", "canonical"])


def declared_charset(content: Column) -> Column:
    """The charset that a page declares, lower case; null if none (F1, F2). content: binary or string."""
    head = F.lower(F.regexp_extract(F.decode(content.cast("binary"), "iso-8859-1"), r"(?i)<meta[^>\n]*charset=[\"']?\s*([A-Za-z0-9_-]+)", 1))
    return F.nullif(head, F.lit(""))


def declared_charsets(content: Column) -> Column:
    """All charsets that a page's metas declare, the last one of each line, as written (F2)."""
    return F.regexp_extract_all(F.decode(content.cast("binary"), "iso-8859-1"), F.lit(r'(?id)<meta.*charset="?(.*?)"'), F.lit(1))


#: In the order in which a declaration is looked for; cp1252 without one.
CODECS = {"utf-8": "utf_8", "iso-8859-1": "latin_1", "gb2312": "gb2312", "big5": "big5"}


def decode_bytes(raw: bytes | None) -> str | None:
    """decode_declared of one page."""
    if raw is None:
        return None
    for name, codec in CODECS.items():
        if re.search(rb"(?i)<meta.*charset=\"?" + name.encode() + rb".*>", raw):
            return raw.decode(codec, "backslashreplace")
    return raw.decode("cp1252", "backslashreplace")


#: Bytes 0x80 to 0x9F in cp1252; five of them stand for nothing.
_CP1252 = {b: bytes([b]).decode("cp1252", "ignore") for b in range(0x80, 0xA0)}
_NOTHING = "".join(chr(b) for b, c in _CP1252.items() if not c)
#: One character of UTF-8, in bytes that are read as Latin-1: no overlong forms, no surrogates, nothing above U+10FFFF.
_UTF8 = "[\x00-\x7f]|[\xc2-\xdf][\x80-\xbf]|\xe0[\xa0-\xbf][\x80-\xbf]|[\xe1-\xec\xee\xef][\x80-\xbf]{2}|\xed[\x80-\x9f][\x80-\xbf]|\xf0[\x90-\xbf][\x80-\xbf]{2}|[\xf1-\xf3][\x80-\xbf]{3}|\xf4[\x80-\x8f][\x80-\xbf]{2}"


def _bytes(content: Column) -> Column:
    """Bytes as the characters of those numbers."""
    return F.decode(content.cast("binary"), "iso-8859-1")


@functools.cache
def _pairs(codec: str) -> str:
    """A pattern of one character of a two-byte codec, from what the codec itself accepts: a set of second bytes for each set of first ones."""
    seconds: dict[str, list[int]] = {}
    for lead in range(0x81, 0xFF):
        ok = [t for t in range(0x40, 0xFF) if _accepts(bytes((lead, t)), codec)]
        if ok:
            seconds.setdefault(_ranges(ok), []).append(lead)
    return "|".join(["[\x00-\x7f]", *(f"[{_ranges(leads)}][{t}]" for t, leads in seconds.items())])


def _accepts(raw: bytes, codec: str) -> bool:
    try:
        return len(raw.decode(codec)) > 0
    except UnicodeDecodeError:
        return False


def _ranges(numbers: list[int]) -> str:
    """Numbers, ascending, as the inside of a character class."""
    out, start = [], numbers[0]
    for a, b in zip(numbers, [*numbers[1:], None], strict=True):
        if b != a + 1:
            out.append(f"\\x{start:02x}" if start == a else f"\\x{start:02x}-\\x{a:02x}")
            start = b
    return "".join(out)


def _made_of(raw: Column, one: str) -> Column:
    """Whether a text is a row of what the pattern matches: nothing is left when all of that is taken away, from the left."""
    return F.regexp_replace(raw, f"(?s)(?:{one})", "") == ""


def _as_cp1252(raw: Column) -> Column:
    """Of bytes as characters; those that stand for nothing come out as \\xNN."""
    known = {chr(b): c for b, c in _CP1252.items() if c}
    out = F.translate(raw, "".join(known), "".join(known.values()))
    for c in _NOTHING:
        out = F.replace(out, F.lit(c), F.lit(f"\\x{ord(c):02x}"))
    return out


def _as_ascii(raw: Column) -> Column:
    parts = F.regexp_extract_all(raw, F.lit("(?s)[\x00-\x7f]+|."), F.lit(0))
    return F.array_join(F.transform(parts, lambda c: F.when(c.rlike("^[^\x00-\x7f]"), F.concat(F.lit("\\x"), F.lower(F.hex(F.encode(c, "iso-8859-1"))))).otherwise(c)), "")


def _as_utf8(content: Column) -> Column:
    """UTF-8; bytes that are none come out as \\xNN. Pages that are UTF-8 throughout are taken as they are."""
    text, raw = content.cast("binary").cast("string"), _bytes(content)
    parts = F.regexp_extract_all(raw, F.lit(f"(?s)(?:{_UTF8})|."), F.lit(0))
    shown = F.transform(parts, lambda c: F.when((F.length(c) > 1) | (c <= "\x7f"), F.encode(c, "iso-8859-1").cast("string")).otherwise(F.concat(F.lit("\\x"), F.lower(F.hex(F.encode(c, "iso-8859-1"))))))
    return F.when(F.is_valid_utf8(text), text).otherwise(F.array_join(shown, ""))


@arrow_function("string")
def _decode_pairs(content: pd.Series, codec: pd.Series) -> pd.Series:
    """For what built-ins can't decode: null where the codec is null."""
    return pd.Series([None if r is None or c is None else bytes(r).decode(c, "backslashreplace") for r, c in zip(content, codec, strict=True)], dtype=object)


def decode_as(content: Column | str, codec: Column | str) -> Column:
    """Decoded by a named codec, of utf_8, latin_1, cp1252 and ascii by built-ins, of others by batches that hold only their pages; bytes that
    it lacks come out as \\xNN (B11)."""
    content = (F.col(content) if isinstance(content, str) else content).cast("binary")
    codec = F.col(codec) if isinstance(codec, str) else codec
    name, raw = F.lower(F.replace(codec, F.lit("-"), F.lit("_"))), _bytes(content)
    known = {"utf_8": _as_utf8(content), "utf8": _as_utf8(content), "latin_1": raw, "iso_8859_1": raw, "cp1252": _as_cp1252(raw), "windows_1252": _as_cp1252(raw), "ascii": _as_ascii(raw), "us_ascii": _as_ascii(raw)}
    other = ~name.isin(list(known))
    out = _decode_pairs(F.when(other, content), F.when(other, codec))
    for k, value in known.items():
        out = F.when(name == k, value).otherwise(out)
    return out


def decode_declared(content: Column | str) -> Column:
    """Decoded by the first of CODECS that a page declares, cp1252 without one; bytes that it lacks come out as \\xNN (F1).
    Only pages in two-byte codecs leave the JVM."""
    content = (F.col(content) if isinstance(content, str) else content).cast("binary")
    raw = _bytes(content)
    codec = F.lit("cp1252")
    for name, value in reversed(CODECS.items()):
        codec = F.when(raw.rlike(f'(?id)<meta.*charset="?{name}.*>'), value).otherwise(codec)
    return F.when(content.isNotNull(), decode_as(content, codec))


# fixed value: what a pattern's \s matches in texts
_ANY_SPACE = "[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"


def fetched_text(content: Column | str) -> Column:
    """UTF-8 if it is that, else windows-1252, else empty; all white space as single spaces (A1)."""
    content = (F.col(content) if isinstance(content, str) else content).cast("binary")
    text, raw = content.cast("string"), _bytes(content)
    read = F.when(F.is_valid_utf8(text), text).when(~raw.rlike(f"[{_NOTHING}]"), _as_cp1252(raw)).otherwise("")
    return F.coalesce(F.regexp_replace(read, _ANY_SPACE, " "), F.lit(""))


TRIED = ("ascii", "windows-1252", "iso-8859-1", "big5", "gb2312", "utf-8")


def try_codecs(content: Column | str) -> Column:
    """Whether the bytes decode strictly under each codec (F5): struct of a boolean a codec, by built-ins alone."""
    content = (F.col(content) if isinstance(content, str) else content).cast("binary")
    raw = _bytes(content)
    ok = {"ascii": ~raw.rlike("[^\x00-\x7f]"), "windows_1252": ~raw.rlike(f"[{_NOTHING}]"), "iso_8859_1": raw.isNotNull(), "big5": _made_of(raw, _pairs("big5")), "gb2312": _made_of(raw, _pairs("gb2312")), "utf_8": F.is_valid_utf8(content.cast("string"))}
    return F.struct(*(v.alias(k) for k, v in ok.items()))


def mismatch(tried: Column, charsets: Column) -> Column:
    """Whether a codec that a page declares fails on it (F5). tried: of try_codecs; charsets: of declared_charsets."""
    named = F.lower(F.array_join(charsets, "|"))
    return F.array_contains(F.array(*(named.contains(c) & ~tried[c.replace("-", "_")] for c in TRIED)), F.lit(True))


@arrow_function("binary")
def patch_bytes(content: pd.Series, old: pd.Series, new: pd.Series) -> pd.Series:
    """Replace bytes by bytes on patched documents (F7); null patches change nothing."""
    return pd.Series([c if o is None else bytes(c).replace(bytes(o), bytes(n)) for c, o, n in zip(content, old, new, strict=True)])


def patched(text: Column, patches: Column) -> Column:
    """Strings replaced by strings, one patch after another (F12). patches: array of struct(old, new); null changes nothing."""
    return F.coalesce(F.aggregate(patches, text, lambda t, p: F.replace(t, p["old"], p["new"])), text)


def first_closers_removed(text: Column) -> Column:
    """Without the first </body> and the first </html>."""
    for tag in ("body", "html"):
        text = F.regexp_replace(text, f"(?is)^(.*?)</{tag}>", "$1")
    return text


def count_tag(text: Column, tag: str) -> Column:
    """How often an element opens."""
    return F.regexp_count(text, F.lit(f"(?i)<{tag}[ >]"))


def entities(text: Column) -> Column:
    """All character references, in order."""
    return F.regexp_extract_all(text, F.lit(r"&#?\w+;"), F.lit(0))


def boms(text: Column) -> Column:
    """Byte order marks (F8)."""
    return F.size(F.split(text, "\ufeff")) - 1
