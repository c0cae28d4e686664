"""A tolerant HTML tree on the standard library's tokenizer, and what is read off it. Pure Python, for Arrow-batched calls."""

from __future__ import annotations

import html
import html.parser
import re
from collections.abc import Iterator
from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: What an opening tag closes if it is open, up to the elements that hold it.
CLOSES = {"p": {"p"}, "li": {"li"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}}
BLOCKS = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol pre section table ul".split())
SCOPES = frozenset("table ul ol dl select body html div article section".split())
#: By tag: what it closes, and the elements up to which that is looked for.
_CLOSED = {t: (c, SCOPES - c) for t in {*CLOSES, *BLOCKS} if (c := frozenset(CLOSES.get(t, set()) | ({"p"} if t in BLOCKS else set())))}
# fixed values: elements that contents are freed of
REMOVED = ("svg", "script", "noscript", "form", "template")


class Node:
    __slots__ = ("name", "attrs", "children", "parent")

    def __init__(self, name: str, attrs: dict[str, str], parent: Node | None):
        self.name, self.attrs, self.parent, self.children = name, attrs, parent, []

    def walk(self) -> Iterator[Node]:
        """All elements below, in document order; a stack, so that depth doesn't matter."""
        stack = [c for c in reversed(self.children) if isinstance(c, Node)]
        while stack:
            n = stack.pop()
            yield n
            stack.extend(c for c in reversed(n.children) if isinstance(c, Node))

    def find_all(self, name: str | None = None, **attrs: str) -> Iterator[Node]:
        for n in self.walk():
            if (name is None or n.name == name) and all(v in n.attrs.get(k.rstrip("_"), "").split() if k == "class_" else n.attrs.get(k) == v for k, v in attrs.items()):
                yield n

    def find(self, name: str | None = None, **attrs: str) -> Node | None:
        return next(self.find_all(name, **attrs), None)

    def texts(self) -> Iterator[str]:
        """Text nodes, without those of scripts, styles and templates."""
        stack: list = [self]
        while stack:
            n = stack.pop()
            if isinstance(n, str):
                yield n
            elif n is self or n.name not in ("script", "style", "template"):
                stack.extend(reversed(n.children))

    def text(self) -> str:
        return "".join(self.texts())

    def string(self) -> str | None:
        """The only text below a chain of only children."""
        n = self
        while isinstance(n, Node):
            if len(n.children) != 1:
                return None
            n = n.children[0]
        return n

    def remove(self, names: tuple[str, ...]) -> None:
        for n in list(self.walk()):
            if n.name in names and n.parent:
                n.parent.children = [c for c in n.parent.children if c is not n]

    def next_element(self) -> Node | None:
        rest = self.parent.children if self.parent else []
        at = next(i for i, c in enumerate(rest) if c is self) if rest else 0
        return next((c for c in rest[at + 1 :] if isinstance(c, Node)), None)

    def stripped(self) -> str:
        """The pieces of text, each without white space at its ends, put together."""
        return "".join(t.strip() for t in self.texts())

    def serialise(self) -> str:
        out: list[str] = []
        stack: list = [self]
        while stack:
            n = stack.pop()
            if isinstance(n, tuple):
                out.append(n[0])
            elif isinstance(n, str):
                out.append(html.escape(n, quote=False))
            else:
                if n.name != "#root":
                    out.append("<" + n.name + "".join(f' {k}="{html.escape(v)}"' for k, v in n.attrs.items()) + ">")
                    if n.name in VOID:
                        continue
                    stack.append((f"</{n.name}>",))
                raw = n.name in ("script", "style")
                stack.extend((c,) if raw and isinstance(c, str) else c for c in reversed(n.children))
        return "".join(out)


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#root", {}, None)

    def handle_starttag(self, tag, attrs):
        if tag in _CLOSED:
            closes, ends = _CLOSED[tag]
            n = self.at
            while n.parent and n.name not in ends:
                if n.name in closes:
                    self.at = n.parent
                n = n.parent
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)

    def handle_endtag(self, tag):
        n = self.at
        while n.parent and n.name != tag:
            n = n.parent
        if n.parent:
            self.at = n.parent

    def handle_data(self, data):
        if self.at.children and isinstance(self.at.children[-1], str):
            self.at.children[-1] += data
        else:
            self.at.children.append(data)


#: Markup that leaves nothing to tolerate: a comment, a doctype, an end tag, a start tag with plain attributes.
_PLAIN = re.compile(
    r"""<!--(?!-?>)(?:[^-]|-(?!-))*-->|<!doctype[^<>\[]*>|</([a-z][a-z0-9]*)>|<([a-z][a-z0-9]*)((?:\s+[a-z_][a-z0-9_:.-]*(?:=(?:"[^"]*"|'[^']*'|[^\s"'=<>`/]+))?)*)\s*(/?)>""", re.I
)
_ATTRIBUTE = re.compile(r"""([a-z_][a-z0-9_:.-]*)(?:=(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`/]+)))?""", re.I)
_attribute_text = getattr(html.parser, "_unescape_attribute", html.unescape)


def _plain(text: str) -> Node | None:
    """The tree of a document whose markup is plain throughout, else None: the same tree as by the tokenizer, sooner."""
    b = _Builder()
    at, data = 0, b.handle_data
    while (i := text.find("<", at)) >= 0:
        m = _PLAIN.match(text, i)
        if m is None:
            return None
        if i > at:
            data(html.unescape(text[at:i]))
        at = m.end()
        end, tag, attributes, empty = m.groups()
        if end:
            b.handle_endtag(end.lower())
        elif tag:
            tag = tag.lower()
            found = []
            if attributes:
                for a in _ATTRIBUTE.finditer(attributes):
                    value = a[2] if a[2] is not None else a[3] if a[3] is not None else a[4]
                    found.append((a[1].lower(), _attribute_text(value) if value and "&" in value else value))
            if empty:
                b.handle_startendtag(tag, found)
                continue
            b.handle_starttag(tag, found)
            if tag in ("script", "style"):
                close = re.compile(rf"</\s*{tag}", re.I).search(text, at)
                if close is None or text[close.end() : close.end() + 1] != ">" or len(close[0]) != len(tag) + 2:
                    return None
                if close.start() > at:
                    data(text[at : close.start()])
                at = close.start()
            elif tag in ("title", "textarea", "iframe", "noembed", "noframes", "xmp", "plaintext"):
                nxt = text.find("<", at)
                if nxt < 0 or text[nxt : nxt + len(tag) + 3].lower() != f"</{tag}>":
                    return None
    if at < len(text):
        data(html.unescape(text[at:]))
    return b.root


def parse(text: str | None) -> Node:
    root = _plain(text or "")
    if root is None:
        b = _Builder()
        b.feed(text or "")
        b.close()
        root = b.root
    return root


class _Done(Exception):
    pass


class _Head(_Builder):
    """The tree up to the end of the head: its end tag, or the body's start tag."""

    def handle_starttag(self, tag, attrs):
        if tag == "body":
            raise _Done
        super().handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        super().handle_endtag(tag)
        if tag == "head":
            raise _Done


def parse_head(text: str | None) -> Node:
    """The tree of what stands before the body, for what is read from the head alone (I2). Tags inside scripts, comments
    and values are text and end no head; the rest of the page isn't read."""
    text = text or ""
    m = re.search(r"(?i)</head\s*>|<body[\s>/]", text)
    root = _plain(text[: m.start()]) if m else parse(text)  # plain up to there: a real tag
    if root is None:
        b = _Head()
        try:
            b.feed(text)
            b.close()
        except _Done:
            pass
        root = b.root
    return root


def anchors(root: Node) -> list[tuple[str | None, str, str | None]]:
    """(href, pieces of text, stripped, with bars between, the only text if it is one) of each anchor."""
    return [(a.attrs.get("href"), "|".join(t for x in a.texts() if (t := x.strip())), a.string()) for a in root.find_all("a")]


#: A text, or _PLAIN without going back.
_TOKEN = re.compile(
    r"""([^<]+)|<!--(?!-?>)(?:[^-]|-(?!-))*+-->|<![dD][oO][cC][tT][yY][pP][eE][^<>\[]*+>|</([a-zA-Z][a-zA-Z0-9]*+)>|<([a-zA-Z][a-zA-Z0-9]*+)((?:\s++[a-zA-Z_][a-zA-Z0-9_:.-]*+(?:=(?:"[^"]*+"|'[^']*+'|[^\s"'=<>`/]++))?)*+)\s*+(/?)>"""
)
_RAW = {tag: re.compile(rf"</\s*{tag}", re.I) for tag in ("script", "style")}
_NO_CHILD, _ELEMENT, _TEXT = range(3)


class _Anchor:
    """An anchor as it is read: its place in the open elements, its pieces of text, the text last met, hidden or not, whether no
    element has two children, and the place of the open element that hides what is below it (0: none)."""

    __slots__ = ("href", "place", "pieces", "last", "chain", "hidden")

    def __init__(self, href: str | None, place: int):
        self.href, self.place, self.pieces, self.last, self.chain, self.hidden = href, place, [], None, True, 0


def _plain_anchors(text: str) -> list[_Anchor] | None:
    """The anchors of a document whose markup is plain throughout, else None, without its tree: elements open and close as in
    it, of each open one the name is kept, and inside anchors the kind of its last child."""
    names, children = ["#root"], [_NO_CHILD]
    found: list[_Anchor] = []
    opened: list[_Anchor] = []
    at, size = 0, len(text)

    def child(kind: int) -> None:
        if children[-1]:
            for a in opened:
                a.chain = False
        children[-1] = kind

    def close(place: int) -> None:
        del names[place:], children[place:]
        while opened and opened[-1].place >= place:
            opened.pop()
        for a in opened:
            if a.hidden >= place:
                a.hidden = 0

    def data(piece: str) -> None:
        more = children[-1] == _TEXT
        if not more:
            child(_TEXT)
        for a in opened:
            a.last = a.last + piece if more else piece
            if not a.hidden:
                if more:
                    a.pieces[-1] += piece
                else:
                    a.pieces.append(piece)

    while at < size:
        m = _TOKEN.match(text, at)
        if m is None:
            return None
        at = m.end()
        piece, end, tag, attributes, empty = m.groups()
        if piece:
            if opened:
                data(html.unescape(piece))
        elif end:
            end = end.lower()
            k = len(names) - 1
            while k and names[k] != end:
                k -= 1
            if k:
                close(k)
        elif tag:
            tag, href = tag.lower(), None
            if tag == "a" and attributes:
                for name, *values in _ATTRIBUTE.findall(attributes):
                    if name.lower() == "href":
                        href = "".join(values)
                        href = _attribute_text(href) if "&" in href else href
            if not empty and tag in _CLOSED:
                closes, ends = _CLOSED[tag]
                k = len(names) - 1
                first = k + 1
                while k and names[k] not in ends:
                    if names[k] in closes:
                        first = k
                    k -= 1
                if first < len(names):
                    close(first)
            if opened:
                child(_ELEMENT)
            if tag == "a":
                found.append(_Anchor(href, len(names)))
            if empty:
                continue
            if tag not in VOID:
                if tag == "a":
                    opened.append(found[-1])
                elif opened and tag in ("script", "style", "template"):
                    for a in opened:
                        a.hidden = a.hidden or len(names)
                names.append(tag)
                children.append(_NO_CHILD)
            if tag in _RAW:
                raw = _RAW[tag].search(text, at)
                if raw is None or text[raw.end() : raw.end() + 1] != ">" or len(raw[0]) != len(tag) + 2:
                    return None
                if opened and raw.start() > at:
                    data(text[at : raw.start()])
                at = raw.start()
            elif tag in ("title", "textarea", "iframe", "noembed", "noframes", "xmp", "plaintext"):
                nxt = text.find("<", at)
                if nxt < 0 or text[nxt : nxt + len(tag) + 3].lower() != f"</{tag}>":
                    return None
    return found


#: Attributes whose values hold no < and no >; what an anchor holds: text, and inline elements of text alone; a document of plain markup
#: all of whose anchors are such ones, and no < is but a token's first character, so that they are found by pattern.
_SHORT = r"""(?:[ \t\n\r\f]++[a-z_][a-z0-9_:.-]*+(?:=(?:"[^"<>]*+"|'[^'<>]*+'|[!#-&(-.0-;?-_a-~]++))?+)*+[ \t\n\r\f]*+"""
_INLINE = "|".join(rf"{tag}{_SHORT}>[^<]*+</{tag}" for tag in "b i em strong span font sub sup small u cite code".split())
_INSIDE = rf"[^<]*+(?:<(?:{_INLINE})>[^<]*+)*+"
_SIMPLE = re.compile(
    rf"(?:[^<]++|<a{_SHORT}>{_INSIDE}</a>|</(?!a>)[a-z][a-z0-9]*+>|<(?!(?:a|script|style|title|textarea|iframe|noembed|noframes|xmp|plaintext)\b)[a-z][a-z0-9]*+{_SHORT}/?>"
    rf"|<title{_SHORT}>[^<]*+</title>|<!--(?!-?>)(?:[^-<]|-(?!-))*+-->|<!doctype[^<>\[]*+>)*+", re.I | re.A
)
_SIMPLE_ANCHOR, _TAG = re.compile(rf"<a({_SHORT})>({_INSIDE})</a>", re.I | re.A), re.compile("<[^>]*>")


def _simple_anchor(attributes: str, inside: str) -> tuple[str | None, str, str | None]:
    href = None
    if attributes[:7] == ' href="' and attributes.find('"', 7) == len(attributes) - 1:
        href = attributes[7:-1]
    else:
        for name, *values in _ATTRIBUTE.findall(attributes):
            if name.lower() == "href":
                href = "".join(values)
    if href and "&" in href:
        href = _attribute_text(href)
    if "<" not in inside:
        text = html.unescape(inside)
        return href, text.strip(), text if inside else None
    texts = _TAG.split(inside)
    only = len(texts) == 3 and texts[1] and not texts[0] and not texts[2]
    return href, "|".join([t for x in texts if (t := html.unescape(x).strip())]), html.unescape(texts[1]) if only else None


def anchors_of(text: str | None) -> list[tuple[str | None, str, str | None]]:
    """anchors() of a document, sooner where its markup is plain, and by pattern where its anchors are simple too."""
    if _SIMPLE.fullmatch(text or ""):
        return [_simple_anchor(*a) for a in _SIMPLE_ANCHOR.findall(text or "")]
    found = _plain_anchors(text or "")
    return anchors(parse(text)) if found is None else [(a.href, "|".join([t for x in a.pieces if (t := x.strip())]), a.last if a.chain else None) for a in found]


def head_meta(root: Node) -> tuple[str, str, list[tuple[str, str]]]:
    """Title, canonical link, and (name, content) of the metas that have both."""
    title = root.find("title")
    links = [n for n in root.find_all("link") if "canonical" in n.attrs.get("rel", "").split()]
    return ((title.string() or "").strip() if title else ""), (links[0].attrs.get("href", "") if links else ""), [(n.attrs.get("name") or n.attrs.get("property"), n.attrs["content"]) for n in root.find_all("meta") if (n.attrs.get("name") or n.attrs.get("property")) and n.attrs.get("content")]


def tags(root: Node) -> list[tuple[str, str, dict[str, str]]]:
    """Name, only string and attributes of all elements."""
    return [(n.name, (n.string() or "").strip(), dict(n.attrs)) for n in root.walk()]


def text_nodes(root: Node, pattern: re.Pattern) -> list[tuple[int, str, int, str, str]]:
    """(place, element, its length as serialised, the text, the element's whole text) of the texts that match, in document order."""
    out: list[tuple[int, str, int, str, str]] = []
    wholes: dict[int, tuple[int, str]] = {}
    stack: list = [(root, c) for c in reversed(root.children)]
    while stack:
        parent, c = stack.pop()
        if isinstance(c, Node):
            stack.extend((c, x) for x in reversed(c.children))
        elif pattern.search(c):
            if id(parent) not in wholes:
                wholes[id(parent)] = len(parent.serialise()), parent.text()
            out.append((len(out), parent.name, wholes[id(parent)][0], c, wholes[id(parent)][1]))
    return out


def matching_texts(root: Node, pattern: re.Pattern) -> list[tuple[str, str]]:
    """(element, text) of the texts that match, in document order: text_nodes without writing the elements."""
    out: list[tuple[str, str]] = []
    stack: list = [(root, c) for c in reversed(root.children)]
    while stack:
        parent, c = stack.pop()
        if isinstance(c, Node):
            stack.extend((c, x) for x in reversed(c.children))
        elif pattern.search(c):
            out.append((parent.name, c))
    return out


def citations(root: Node) -> dict[str, str]:
    """The cell beside each header of a citation table, by the header's text."""
    out: dict[str, str] = {}
    for th in root.find_all("th"):
        rest = th.parent.children if th.parent else []
        at = next(i for i, c in enumerate(rest) if c is th)
        cell = next((c for c in rest[at + 1 :] if isinstance(c, Node) and c.name == "td" and "citationCell" in c.attrs.get("class", "").split()), None)
        if cell is not None:
            out.setdefault((th.string() or "").strip(), cell.stripped())
    return out


def body(root: Node) -> Node:
    return root.find("body") or root


def plain_text(root: Node) -> str:
    """The body's text, two white space characters or more as one space (L2)."""
    b = body(root)
    b.remove(REMOVED)
    return re.sub(r"\s{2,}", " ", b.text().strip())


def trim_svg(text: str) -> str:
    """Drawings without attributes and strings (F19); documents without a drawing come back as they are."""
    if not re.search(r"(?i)<svg[ >]", text):
        return text
    root = parse(text)
    for svg in root.find_all("svg"):
        for n in [svg, *svg.walk()]:
            n.attrs = {}
            if n is not svg and not any(isinstance(c, Node) for c in n.children):
                n.children = []
    return root.serialise()


def svg_lengths(text: str) -> tuple[int, int, list[int]]:
    """Drawings, the document's length with its drawings trimmed, and its length as parsed and after each of five
    reductions: attribute values, attributes, strings, contents, elements (F21). The document is parsed and written once;
    after that only drawings are written again."""
    root = parse(text)
    whole, drawings = len(root.serialise()), list(root.find_all("svg"))
    held = {id(n) for s in drawings for n in s.walk()}
    outer = [s for s in drawings if id(s) not in held]
    inside = [n for s in outer for n in [s, *s.walk()]]
    rest = whole - sum(len(s.serialise()) for s in outer)

    def values():
        for n in inside:
            n.attrs = dict.fromkeys(n.attrs, "")

    def attributes():
        for n in inside:
            n.attrs = {}

    def leaves():
        for n in inside:
            if n.name != "svg" and not any(isinstance(c, Node) for c in n.children):
                n.children = []

    def strings():
        for n in inside:
            n.children = [c for c in n.children if isinstance(c, Node)]

    def contents():
        for n in drawings:
            n.children = []

    out = []
    for step in (values, attributes, leaves, strings, contents):
        step()
        out.append(rest + sum(len(s.serialise()) for s in outer))
    return len(drawings), out.pop(2), [whole, *out, rest]


def markdown(root: Node) -> str:
    """ATX headings closed with #, _ and __ for emphasis, ~ and ^ for sub and sup, links, images, lists, quotes, code, tables (L3). * and _ of texts are escaped outside code."""
    b = body(root)
    b.remove((*REMOVED, "style"))
    done: dict[int, str] = {}
    stack: list[tuple[Node, bool, bool]] = [(b, False, False)]
    while stack:  # children first; a stack, so that depth doesn't matter
        n, ready, code = stack.pop()
        code = code or n.name in _CODE
        if not ready:
            stack.append((n, True, code))
            stack.extend((c, False, code) for c in n.children if isinstance(c, Node))
            continue
        spaced = [re.sub(r"\s+", " ", c) if isinstance(c, str) else None for c in n.children]
        done[id(n)] = _md(n, [done[id(c)] if t is None else t if code else _EMPHASIS.sub(r"\\\g<0>", t) for c, t in zip(n.children, spaced, strict=True)], done)
        if n.name not in _TABLE:
            for c in n.children:
                done.pop(id(c), None)
    return re.sub(r"\n{3,}", "\n\n", done[id(b)]).strip()


#: Elements whose parts a table still asks for.
_TABLE = frozenset("thead tbody tfoot tr colgroup".split())
_MARKS = {"em": "_", "i": "_", "strong": "__", "b": "__", "sub": "~", "sup": "^", "del": "~~", "s": "~~", "code": "`", "kbd": "`", "samp": "`"}


#: Elements whose text is as it is; elsewhere characters that would be read as emphasis have a backslash in front.
_CODE, _EMPHASIS = frozenset("code kbd samp pre".split()), re.compile("[*_]")


def _own(table: Node, name: str) -> Iterator[Node]:
    """Elements of a table that aren't a nested table's."""
    stack = [c for c in reversed(table.children) if isinstance(c, Node)]
    while stack:
        n = stack.pop()
        if n.name == name:
            yield n
        elif n.name in _TABLE:
            stack.extend(c for c in reversed(n.children) if isinstance(c, Node))


def _md(n: Node, inner: list[str], done: dict[int, str]) -> str:
    """Markdown of an element, given that of its children."""
    if n.name == "pre":
        return f"\n\n```\n{n.text()}\n```\n\n"
    if n.name == "table":
        title = "".join(f"\n\n{done[id(c)].strip()}" for c in _own(n, "caption"))
        rows = [[re.sub(r"\s*\n\s*", " ", done[id(c)].strip()).replace("|", "\\|") for c in r.children if isinstance(c, Node) and c.name in ("td", "th")] for r in _own(n, "tr")]
        rows = [r for r in rows if r]
        if not rows:
            return title + "\n\n" if title else ""
        wide = max(map(len, rows))
        line = lambda r: "| " + " | ".join(r + [""] * (wide - len(r))) + " |"
        return title + "\n\n" + "\n".join([line(rows[0]), "|" + " --- |" * wide, *map(line, rows[1:])]) + "\n\n"
    if n.name in ("ul", "ol"):
        lines, k = [], 0
        for c, x in zip(n.children, inner, strict=True):
            if isinstance(c, Node) and c.name == "li":
                k += 1
                lines.append(f"{f'{k}.' if n.name == 'ol' else '*'} " + x.strip().replace("\n", "\n  "))
            elif x.strip():  # text and elements beside the items
                lines.append(x.strip())
        return "\n\n" + "\n".join(lines) + "\n\n"
    text = "".join(inner)
    wrapped = text.strip()
    if re.fullmatch("h[1-6]", n.name):
        return f"\n\n{'#' * int(n.name[1])} {wrapped} {'#' * int(n.name[1])}\n\n"
    if n.name in _MARKS and wrapped:
        mark = _MARKS[n.name]
        return f"{' ' if text[0].isspace() else ''}{mark}{wrapped}{mark}{' ' if text[-1].isspace() else ''}"
    if n.name == "a" and n.attrs.get("href") and wrapped:
        return f"[{wrapped}]({n.attrs['href']})"
    if n.name == "img":
        return f"![{n.attrs.get('alt', '')}]({n.attrs.get('src', '')})"
    if n.name == "br":
        return "  \n"
    if n.name == "hr":
        return "\n\n---\n\n"
    if n.name == "blockquote":
        return "\n\n" + "\n".join("> " + x for x in wrapped.split("\n")) + "\n\n"
    if n.name == "p" or n.name in BLOCKS or n.name == "body":
        return f"\n\n{wrapped}\n\n"
    return text
