"""CSS selectors over saved pages, all of a source's in one pass.

A list of selectors is compiled into positions: one for each compound ("div.card[data-x]") of each selector, with the
combinator that leads to it. While a page is read, every open element carries, as bits of one number, the positions that
it satisfies with what stands above and before it; those of a new element follow from its parent's, its ancestors' and
its siblings' by shifting by one. So nothing is searched again, and a page costs its tags times the selectors that ask
for their kind, however deep it is. Elements that end by what follows them (paragraphs, list items, table cells) are
closed as browsers do.

Understood: tag, ``*``, #id, .class, [a], [a=v], [a~=v], [a|=v], [a^=v], [a$=v], [a*=v] (``i``: in any case),
:first-child, :first-of-type, :nth-child(n), :nth-of-type(n) (a number, odd, even or an+b), :not(compound),
:has-text("...") on the last compound; combinators descendant, ``>``, ``+``, ``~``; lists by comma.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from html.parser import HTMLParser
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCKS = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
#: What a start tag ends, up to the nearest of the elements that hold it.
ENDS: dict[str, tuple[frozenset[str], frozenset[str]]] = {
    "li": (frozenset(("li",)), frozenset(("ul", "ol", "menu"))),
    "dt": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "dd": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "tr": (frozenset(("tr",)), frozenset(("table",))),
    "td": (frozenset(("td", "th")), frozenset(("tr", "table"))),
    "th": (frozenset(("td", "th")), frozenset(("tr", "table"))),
    "option": (frozenset(("option",)), frozenset(("select", "datalist"))),
} | {b: (frozenset(("p",)), frozenset(("button", "table", "td", "th", "caption", "object"))) for b in _BLOCKS}

_TOKEN = re.compile(
    r"""(?P<tag>\*|[A-Za-z][\w-]*)|\#(?P<id>[\w-]+)|\.(?P<cls>[\w-]+)
    |\[\s*(?P<attr>[\w:-]+)\s*(?:(?P<op>[~|^$*]?=)\s*(?:"(?P<dq>[^"]*)"|'(?P<sq>[^']*)'|(?P<word>[^\s\]]+))\s*(?P<any>[iI])?\s*)?\]
    |:(?P<pseudo>[a-z-]+)(?:\((?P<arg>"[^"]*"|'[^']*'|[^()]*(?:\([^()]*\))?[^()]*)\))?""",
    re.X,
)
_NTH = re.compile(r"^\s*(?:(?P<word>odd|even)|(?P<a>[+-]?\d*)n\s*(?:(?P<sign>[+-])\s*(?P<b>\d+))?|(?P<n>\d+))\s*$")
#: A script or style, which has no references, or an ampersand that begins none with a semicolon.
_UNCLOSED = re.compile(r"(?is)<(script|style)\b.*?(?:</\1|\Z)|&(?!(?:#[0-9]+|#x[0-9a-f]+|[a-z][a-z0-9]*);)")


def closed_only(page: str) -> str:
    """A page in which only references with a semicolon are any: browsers also read '&amp' as '&', so the end of a text that
    was cut inside a reference changes with where it was cut."""
    return _UNCLOSED.sub(lambda m: m[0] if m[1] else "&amp;", page)


class Element(NamedTuple):
    """What tests look at: tag, attributes, classes, place among siblings and among those of the tag, both from 1."""

    tag: str
    attributes: dict[str, str]
    classes: frozenset[str]
    place: int
    of_type: int


Test = Callable[[Element], bool]


def _compared(name: str, op: str, value: str, any_case: bool) -> Test:
    fold = (lambda s: s.lower()) if any_case else (lambda s: s)
    value = fold(value)
    how: dict[str, Callable[[str], bool]] = {
        "=": lambda s: s == value,
        "~=": lambda s: value in s.split() and value != "",
        "|=": lambda s: s == value or s.startswith(value + "-"),
        "^=": lambda s: value != "" and s.startswith(value),
        "$=": lambda s: value != "" and s.endswith(value),
        "*=": lambda s: value != "" and value in s,
    }
    return lambda e: name in e.attributes and how[op](fold(e.attributes[name]))


def _nth(argument: str, of_type: bool) -> Test:
    m = _NTH.match(argument)
    if not m:
        raise ValueError(f"not a place: {argument}")
    if m["n"]:
        a, b = 0, int(m["n"])
    elif m["word"]:
        a, b = 2, int(m["word"] == "odd")
    else:
        a = int(m["a"] + "1") if m["a"] in ("", "+", "-") else int(m["a"])
        b = int(f"{m['sign']}{m['b']}") if m["b"] else 0
    at = (lambda e: e.of_type) if of_type else (lambda e: e.place)
    return lambda e: at(e) == b if a == 0 else (at(e) - b) % a == 0 and (at(e) - b) // a >= 0


class Compound(NamedTuple):
    tag: str | None
    tests: tuple[Test, ...]
    text: tuple[str, ...]  # texts that the element must have, in any case


def compound(source: str) -> Compound:
    """Compile one compound."""
    tag, tests, text, at = None, [], [], 0
    while at < len(source):
        m = _TOKEN.match(source, at)
        if not m or m["tag"] and at:
            raise ValueError(f"cannot read the selector at {source[at:]!r}")
        at = m.end()
        if m["tag"]:
            tag = None if m["tag"] == "*" else m["tag"].lower()
        elif m["id"]:
            tests.append(_compared("id", "=", m["id"], False))
        elif m["cls"]:
            tests.append(lambda e, c=m["cls"]: c in e.classes)
        elif m["attr"]:
            name = m["attr"].lower()
            if m["op"]:
                tests.append(_compared(name, m["op"], next(v for v in (m["dq"], m["sq"], m["word"]) if v is not None), bool(m["any"])))
            else:
                tests.append(lambda e, n=name: n in e.attributes)
        else:
            argument = m["arg"] or ""
            if m["pseudo"] in ("first-child", "first-of-type"):
                tests.append(_nth("1", m["pseudo"] == "first-of-type"))
            elif m["pseudo"] in ("nth-child", "nth-of-type"):
                tests.append(_nth(argument, m["pseudo"] == "nth-of-type"))
            elif m["pseudo"] == "not":
                inner = compound(argument.strip())
                if inner.text:
                    raise ValueError("no texts inside :not()")
                tests.append(lambda e, c=inner: not ((c.tag is None or c.tag == e.tag) and all(t(e) for t in c.tests)))
            elif m["pseudo"] in ("has-text", "contains"):
                text.append(argument.strip().strip("\"'").lower())
            else:
                raise ValueError(f"unknown selector :{m['pseudo']}")
    return Compound(tag, tuple(tests), tuple(text))


def _cut(source: str, at: str) -> list[tuple[str, str]]:
    """(separator before, part) of a selector, cut at characters outside of brackets and quotes."""
    out, part, before, depth, quote = [], "", "", 0, ""
    for c in source:
        if quote:
            quote = "" if c == quote else quote
        elif c in "\"'":
            quote = c
        elif c in "([":
            depth += 1
        elif c in ")]":
            depth -= 1
        elif not depth and c in at:
            if part:
                out.append((before, part))
                part, before = "", ""
            before = before if c == " " and before else c
            continue
        part += c
    return [*out, (before, part)] if part else out


class Found(NamedTuple):
    selector: int
    pos: int
    tag: str
    attributes: dict[str, str]
    text: str


class Program:
    """Compiled selectors."""

    def __init__(self, selectors: list[str]):
        self.first = self.descendant = self.child = self.next = self.later = 0
        self.last: list[tuple[int, int, tuple[str, ...]]] = []  # bit, selector, texts
        self.by_tag: dict[str, list[tuple[int, tuple[Test, ...]]]] = {}
        self.any_tag: list[tuple[int, tuple[Test, ...]]] = []
        bit = 1
        for number, source in enumerate(selectors):
            for _, single in _cut(source.strip(), ",") or [("", "")]:
                steps = _cut(re.sub(r"\s*([>+~])\s*(?=[^=])", r"\1", re.sub(r"\s+", " ", single.strip())), " >+~")
                if not steps or steps[0][0] not in ("", " ") or single.strip()[-1] in ">+~":
                    raise ValueError(f"a part of the selector is empty: {source!r}")
                for k, (how, part) in enumerate(steps):
                    c = compound(part)
                    if c.text and k < len(steps) - 1:
                        raise ValueError("texts are asked of the last element only")
                    if not k:
                        self.first |= bit
                    elif how == ">":
                        self.child |= bit
                    elif how == "+":
                        self.next |= bit
                    elif how == "~":
                        self.later |= bit
                    else:
                        self.descendant |= bit
                    (self.by_tag.setdefault(c.tag, []) if c.tag else self.any_tag).append((bit, c.tests))
                    if k == len(steps) - 1:
                        self.last.append((bit, number, c.text))
                    bit <<= 1
        self.ends = 0
        for b, _, _ in self.last:
            self.ends |= b

    def states(self, element: Element, parent: int, above: int, previous: int, before: int) -> int:
        """Positions that an element satisfies, given those of its parent, of all above, of the sibling before and of all before."""
        open_ = self.first | (above << 1 & self.descendant) | (parent << 1 & self.child) | (previous << 1 & self.next) | (before << 1 & self.later)
        out = 0
        for tests in (self.by_tag.get(element.tag, ()), self.any_tag):
            for bit, wanted in tests:
                if open_ & bit and all(t(element) for t in wanted):
                    out |= bit
        return out

    def run(self, page: str | None) -> list[Found]:
        """Every element that a selector finds, by selector and place in the page."""
        reader = _Reader(self)
        reader.feed(page or "")
        reader.close()
        reader.cut(1)
        return sorted(reader.found, key=lambda f: (f.selector, f.pos))


class _Open:
    """An open element, and what its children need to know."""

    __slots__ = ("attributes", "before", "children", "kinds", "pos", "previous", "state", "tag", "text", "above")

    def __init__(self, tag: str, attributes: dict[str, str], state: int, above: int, pos: int, text: int):
        self.tag, self.attributes, self.state, self.above, self.pos, self.text = tag, attributes, state, above, pos, text
        self.children, self.kinds, self.previous, self.before = 0, {}, 0, 0


class _Reader(HTMLParser):
    def __init__(self, program: Program):
        super().__init__(convert_charrefs=True)
        self.program, self.found, self.pieces, self.count = program, [], [], 0
        self.stack = [_Open("", {}, 0, 0, -1, 0)]
        self.depth: dict[str, list[int]] = {}

    def cut(self, depth: int) -> None:
        """Close the elements from ``depth`` on."""
        while len(self.stack) > depth:
            e = self.stack.pop()
            self.depth[e.tag].pop()
            if e.state & self.program.ends:
                text = " ".join("".join(self.pieces[e.text :]).split())
                low = text.lower()
                for bit, number, wanted in self.program.last:
                    if e.state & bit and all(w in low for w in wanted):
                        self.found.append(Found(number, e.pos, e.tag, e.attributes, text))

    def handle_starttag(self, tag, attrs):
        ends, holders = ENDS.get(tag, ((), ()))
        if ends:
            at = max((d[-1] for t in ends if (d := self.depth.get(t))), default=0)
            if at and not any((d := self.depth.get(t)) and d[-1] > at for t in holders):
                self.cut(at)
        up = self.stack[-1]
        up.children += 1
        up.kinds[tag] = up.kinds.get(tag, 0) + 1
        attributes: dict[str, str] = {}
        for k, v in attrs:
            attributes.setdefault(k, v or "")
        element = Element(tag, attributes, frozenset(attributes.get("class", "").split()), up.children, up.kinds[tag])
        state = self.program.states(element, up.state, up.above, up.previous, up.before)
        up.previous, up.before = state, up.before | state
        self.depth.setdefault(tag, []).append(len(self.stack))
        self.stack.append(_Open(tag, attributes, state, up.above | state, self.count, len(self.pieces)))
        self.count += 1
        if tag in VOID:
            self.cut(len(self.stack) - 1)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if places := self.depth.get(tag):
            self.cut(places[-1])

    def handle_data(self, data):
        # Scripts are no text of what is around them.
        e = self.stack[-1]
        if e.tag not in ("script", "style") or e.state & self.program.ends:
            self.pieces.append(data)


@lru_cache(maxsize=64)
def program(selectors: tuple[str, ...]) -> Program:
    return Program(list(selectors))


ELEMENT = "struct<selector: int, pos: int, tag: string, attributes: map<string,string>, text: string>"
_KIND = pa.list_(pa.struct([("selector", pa.int32()), ("pos", pa.int32()), ("tag", pa.string()), ("attributes", pa.map_(pa.string(), pa.string())), ("text", pa.string())]))


def select_all(c: Column, *selectors: str, closed: bool = False) -> Column:
    """array<ELEMENT> of what the selectors find in a page, by selector (numbered from 0), then by place; a null page has nothing.
    References are read as browsers do, or with ``closed`` only those with a semicolon."""
    chosen = tuple(selectors)
    program(chosen)  # a selector that cannot be read is an error here, not in a task

    def run(pages: pa.Array) -> pa.Array:
        of = program(chosen)
        return pa.array([[f._asdict() | {"attributes": list(f.attributes.items())} for f in of.run(closed_only(p) if closed and p else p)] for p in pages.to_pylist()], _KIND)

    return F.arrow_udf(run, f"array<{ELEMENT}>")(c)


def of_selector(found: Column, number: int) -> Column:
    """The elements of one selector."""
    return F.filter(found, lambda e: e["selector"] == number)


def first_texts(c: Column, fields: dict[str, list[str]], least: int = 1, closed: bool = False) -> Column:
    """struct of fields: of each field's selectors the first one that finds an element with at least ``least`` characters of
    text, and that text; null without. All selectors of all fields read the page once. ``closed``: see select_all."""
    found = select_all(c, *[s for ss in fields.values() for s in ss], closed=closed)
    # What was found is an element of an array, so that it has a name and the page is read once for all fields.
    return F.transform(F.array(found), lambda f: F.struct(*_texts(f, fields, least)))[0]


def _texts(found: Column, fields: dict[str, list[str]], least: int) -> Iterator[Column]:
    def of(lo: int, hi: int) -> Callable[[Column], Column]:
        return lambda e: e["selector"].between(lo, hi) & (F.length(e["text"]) >= least)

    at = 0
    for name, selectors in fields.items():
        yield F.try_element_at(F.filter(found, of(at, at + len(selectors) - 1)), F.lit(1))["text"].alias(name)
        at += len(selectors)


@udtf(returnType="selector: int, pos: int, tag: string, attributes: map<string,string>, text: string")
class CssSelect:
    """For SQL: ``SELECT p.page_id, e.* FROM pages p, LATERAL css_select(p.html, 'article p', 'a[href]') e``."""

    def eval(self, html: str, *selectors: str):
        for f in program(selectors).run(html):
            yield f.selector, f.pos, f.tag, f.attributes, f.text


def register(spark: SparkSession) -> None:
    """Make ``css_select`` known to SQL."""
    spark.udtf.register("css_select", CssSelect)
