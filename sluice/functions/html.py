"""P2 helpers: structure of an HTML or plain-text document, by one pass over its tags.

Text without ``<`` never leaves the JVM; the rest goes in Arrow batches to a
tokenizer that keeps a stack of open elements. A tag starts with a letter, a
slash and a letter, ``!`` or ``?``, as in HTML; any other ``<`` or ``>`` is text.
"""

from __future__ import annotations

import re
from html.entities import html5

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

DOCUMENT_TYPE = "struct<text:string,title:string,elements:array<struct<type:string,content:string,level:int,parent:int>>>"
SPACE_RUN = r"[ \t\r\n]+"

# Element names of HTML.
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong "
                   "sub sup time tt u var wbr".split())
BLOCK = frozenset("address article aside blockquote body caption center col colgroup dd details dialog dir div dl dt fieldset "
                  "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav "
                  "noscript ol optgroup option p pre search section summary table tbody td template tfoot th thead title tr ul".split())
OTHER = frozenset("acronym applet area audio base basefont br button canvas datalist embed frame iframe img input link map meta "
                  "meter noframes object output param picture progress rp rt ruby script select slot source style svg math "
                  "textarea track video".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is no markup and is not shown.
RAW = ("script", "style")
TYPES = {**{f"h{k}": "heading" for k in range(1, 7)}, "p": "paragraph", "li": "list_item", "dt": "list_item", "dd": "list_item",
         "ul": "list", "ol": "list", "dl": "list", "table": "table", "tr": "row", "td": "cell", "th": "cell",
         "pre": "preformatted", "blockquote": "quote", "caption": "caption", "figcaption": "caption"}
#: An opening tag ends an open element of these names, as far as the nearest element of the others.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "option": ({"option"}, {"select", "optgroup"})}
#: What an open paragraph or heading ends at, besides its own end.
SHORT = frozenset(["p", "h1", "h2", "h3", "h4", "h5", "h6", "title"])

# An attribute value may hold ``>`` in quotes; no tag runs over the next ``<``, so each is looked at once.
_TAG = re.compile(r"""<(?:!--|([!?])[^<>]*>|(/?)([A-Za-z][^\s/<>"'=]*)(?=[\s/>])((?:"[^"<]*"|'[^'<]*'|[^"'<>])*+|[^<>]*)>)""")
_ATTRIBUTES = re.compile(r"""(?:\s+[^\s=<>"']+\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'=<>]+))*\s*/?""")
_ENTITY = re.compile(r"&(?:#([0-9]{1,7})|#[xX]([0-9a-fA-F]{1,6})|([A-Za-z][A-Za-z0-9]{1,31}));")
_SPACES = re.compile(SPACE_RUN)
_KNOWN = INLINE | BLOCK | OTHER


def _character(m: re.Match) -> str:
    """The character of one entity; an unknown name or code stays as it is."""
    if m[3]:
        return html5.get(m[3] + ";", m[0])
    code = int(m[1]) if m[1] else int(m[2], 16)
    return chr(code) if 0 < code <= 0x10FFFF and not 0xD800 <= code <= 0xDFFF else m[0]


def _decoded(text: str) -> str:
    return _ENTITY.sub(_character, text) if "&" in text else text


def _squashed(text: str) -> str:
    return _SPACES.sub(" ", text).strip(" ")


def _is_markup(name: str, attributes: str) -> bool:
    """Whether what looks like a tag is one: a known name, or any other with nothing but well-formed attributes."""
    return name in _KNOWN or _ATTRIBUTES.fullmatch(attributes) is not None


def looks_html(text: str) -> bool:
    """Whether ``text`` begins with markup or holds a known element with its end; a tag named in prose is not enough."""
    start = text.lstrip("﻿ \t\r\n")
    if start[:1] == "<" and (m := _TAG.match(start)) and (m[0] == "<!--" or m[1] or m[3].lower() in _KNOWN):
        return True
    opened = set()
    for m in _TAG.finditer(text):
        name = (m[3] or "").lower()
        if name in _KNOWN:
            if not m[2]:
                opened.add(name)
            elif name in opened:
                return True
    return False


class _Page:
    """What one pass over a page gathers: its shown text, its title, and its elements with their nesting."""

    def __init__(self) -> None:
        self.shown: list[str] = []
        self.title: list[str] | None = None
        self.titles_done = False
        self.elements: list[tuple[str, int, int | None]] = []  # type, level, parent
        self.parts: list[list[str]] = []  # own text of each element
        self.open: list[tuple[str, int]] = []  # name, number of the innermost element around its content (-1: none)

    def text(self, s: str) -> None:
        if s:
            s = _decoded(s)
            self.shown.append(s)
            if self.open:
                name, inside = self.open[-1]
                if name == "title" and not self.titles_done:
                    self.title = (self.title or []) + [s]
                elif inside >= 0:
                    self.parts[inside].append(s)

    def space(self, s: str = " ") -> None:
        self.shown.append(s)
        if self.open and self.open[-1][1] >= 0:
            self.parts[self.open[-1][1]].append(s)

    def _pop(self, to: int) -> None:
        for name, _ in self.open[to:]:
            self.titles_done |= name == "title"
        del self.open[to:]
        self.space()

    def start(self, name: str) -> None:
        if name in INLINE:
            return
        if name in BLOCK:
            if self.open and self.open[-1][0] in SHORT:  # an open paragraph or heading ends here, closed or not
                self._pop(len(self.open) - 1)
            if name in ENDS:
                ended, borders = ENDS[name]
                for k in range(len(self.open) - 1, -1, -1):
                    if self.open[k][0] in borders:
                        break
                    if self.open[k][0] in ended:
                        self._pop(k)
                        break
        self.space("\n" if name == "br" else " ")
        if name not in BLOCK or name in VOID:
            return
        inside = self.open[-1][1] if self.open else -1
        kind = TYPES.get(name)
        if kind:
            parent = inside if inside >= 0 else None
            self.elements.append((kind, 0 if parent is None else self.elements[parent][1] + 1, parent))
            self.parts.append([])
            inside = len(self.elements) - 1
        self.open.append((name, inside))

    def end(self, name: str) -> None:
        if name in INLINE:
            return
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == name:
                self._pop(k)
                return
        if name in BLOCK and self.open and self.open[-1][0] in SHORT:
            self._pop(len(self.open) - 1)
        else:
            self.space()

    def result(self) -> dict:
        found = []
        for (kind, level, parent), parts in zip(self.elements, self.parts):
            own = "".join(parts)
            content = own.removeprefix(" ").removeprefix("\n").rstrip(" \r\n") if kind == "preformatted" else _squashed(own)
            found.append({"type": kind, "content": content, "level": level, "parent": parent})
        return {"text": _squashed("".join(self.shown)), "title": _squashed("".join(self.title or [])) or None, "elements": found}


def parse_html(text: str) -> dict:
    """``text``, ``title`` and ``elements`` of a page.

    Block elements and line breaks part words, inline ones do not. Elements come in document order; ``content``
    is an element's own text, ``parent`` the place of the element around it, ``level`` their number. Script and
    style bodies and comments are left out; white space is kept in preformatted elements only.
    """
    page, at, look = _Page(), 0, 0
    while m := _TAG.search(text, look):
        name = (m[3] or "").lower()
        if name and not _is_markup(name, m[4]):
            look = m.start() + 1
            continue
        page.text(text[at:m.start()])
        at = m.end()
        if m[0] == "<!--":
            stop = text.find("-->", at)
            at = len(text) if stop < 0 else stop + 3
        elif name in RAW and not m[2]:
            stop = re.compile(f"</{name}(?=[\\s/>])", re.I).search(text, at)
            at = len(text) if stop is None else stop.start()
            page.space()
        elif name and m[2]:
            page.end(name)
        elif name:
            page.start(name)
        look = at
    page.text(text[at:])
    return page.result()


def _pages(texts: pa.Array) -> pa.Array:
    kind = pa.struct([("text", pa.string()), ("title", pa.string()), ("elements", pa.list_(pa.struct([
        ("type", pa.string()), ("content", pa.string()), ("level", pa.int32()), ("parent", pa.int32())])))])
    return pa.array([parse_html(t) if t is not None and looks_html(t) else None for t in texts.to_pylist()], kind)


def squash(text: Column) -> Column:
    """Whitespace runs to one space, trimmed."""
    return F.trim(F.regexp_replace(text, SPACE_RUN, " "))


def document_struct(text: Column) -> Column:
    """``struct<text, title, elements>`` (``DOCUMENT_TYPE``) for HTML; plain text passes through as one paragraph."""
    page = F.arrow_udf(_pages, DOCUMENT_TYPE)(F.when(F.contains(text, F.lit("<")), text))
    paragraph = F.struct(F.lit("paragraph").alias("type"), squash(text).alias("content"), F.lit(0).alias("level"),
                         F.lit(None).cast("int").alias("parent"))
    plain = F.struct(text.alias("text"), F.lit(None).cast("string").alias("title"), F.array(paragraph).alias("elements"))
    return F.coalesce(page, plain)
