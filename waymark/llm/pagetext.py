"""Main text of web pages by tag-path ratios.

A tolerant scan turns a page into text blocks, each with its root-to-leaf path of tags (with the first class, or id;
containers that are alike are told apart by their number, inline tags are no part of a path). Per path three figures are
aggregated: characters outside of links per block, punctuation marks per block, and all its characters. They are smoothed
over the tree of paths with a weight that falls by DECAY for every step between two paths (two sweeps over the tree give
the sums over all paths), and fused. A path is content if its value reaches SHARE of the page's mean, taken over
characters.

What an element's tag or class says of its role (menu, footer, advert, reader comments, article) is a factor of the value
and decides nothing by itself. Classes that tell of a state ("no-sidebar", "comments-open") name no role; a class does not
count against an element that holds an article, a main part or nearly all of the page's text, nor, where it would leave
nothing of the page, against one that holds half of it. Headings, lists, tables and other short parts would fall below any share beside long
paragraphs, so they go with the container that holds the content, unless their role is against it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Weight of a path one step away in the tree; share of the mean value that makes a path content.
DECAY, SHARE = 0.4, 0.35
#: A region that holds this share of the content is the article. An element that holds so much of the page's text is no part
#: beside it, whatever its class; half is enough where nothing else would be left.
MOST, NEARLY_ALL, HALF = 0.8, 0.9, 0.5
#: Characters that an element holds at least for its share of the text to say anything; a lone notice has fewer.
ENOUGH = 200
#: Factors of a role that is no article text, of one that may be, of forms, of main and of article. Below LEAST a path is never content.
AGAINST, PERHAPS, FORM, MAIN, ARTICLE, LEAST = 0.05, 0.5, 0.3, 1.5, 2.0, 0.1

_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*+)((?>[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
_LOOSE = re.compile(r"<(/?)([A-Za-z][^\s/>]*+)([^>]*+)>")
_CLASS = re.compile(r"\b(class|id|role)\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++))", re.I)
_PART = re.compile(r"[a-z]+")
_MARKS = re.compile("[.,;:!?…،؛؟।、。，！？：；]")

# Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rb rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
CONTAINERS = frozenset("article aside body button caption div footer form header html main nav object section table td th ul ol dl li dd dt blockquote figure details fieldset".split())
#: Elements whose content is no text of the page.
SILENT = frozenset("head script style noscript template button select textarea title iframe object svg canvas xmp noembed noframes datalist".split())
IN_HEAD = frozenset("title meta link base script style noscript template head html".split())
#: Elements that belong to the container around them.
PARTS = frozenset("p h1 h2 h3 h4 h5 h6 hgroup ul ol li dl dt dd table caption thead tbody tfoot tr td th figure figcaption blockquote pre address details summary center hr".split())
#: A new element of a kind ends the open one of the kind that is nearest in its scope; the scope ends at these.
SCOPES = (
    (frozenset(("li",)), frozenset(("ul", "ol", "menu", "dir"))),
    (frozenset(("dt", "dd")), frozenset(("dl",))),
    (frozenset(("td", "th")), frozenset(("tr", "table"))),
    (frozenset(("tr",)), frozenset(("table",))),
    (frozenset(("tbody", "thead", "tfoot")), frozenset(("table",))),
    (frozenset(("option",)), frozenset(("select", "datalist"))),
    (frozenset(("p",)), CONTAINERS - {"li", "dt", "dd"}),
)
_SCOPE_OF = {name: i for i, (names, _) in enumerate(SCOPES) for name in names}
PARAGRAPH, ROW, CELL = len(SCOPES) - 1, 3, 2
#: Words that name a part which is no article text: these wherever they stand in a class or id,
SURE = frozenset(
    "ads adverts advertisement advertising sponsored navbar navigation breadcrumb breadcrumbs pagination pager sidebar related recommended cookie cookies consent popup modal overlay "
    "newsletter subscribe signup comments commentlist disqus social".split()
)
#: these at its end or beside NEUTRAL words only ("user-comment", "page-menu", not "share-of-market"), headers in the latter way alone.
ROLES = SURE | frozenset("ad advert banner sponsor promo promotion menu nav aside rail widget footer foot notice notices alert login comment discussion reply replies responses respond share sharing toolbar search skip copyright legal".split())
HEADS = frozenset("header head masthead".split())
#: Words that make a class tell of what a page has or lacks or how it stands, not what an element is.
STATES = frozenset("no not non has have with without hide hidden show open opened closed enabled disabled active inactive layout".split())
NEUTRAL = frozenset("the site page global main top bottom left right box area bar block container wrapper wrap inner outer list item items section content row col button buttons link links icon icons panel odd even depth level js id is has".split())


class Page(NamedTuple):
    """Text pieces of a page in order, and the tree of paths (parents come before children; 0 is the root)."""

    path: list[int]  # of each piece
    block: list[int]  # pieces of one block have one number
    link: list[bool]
    text: list[str]  # character references decoded; white space as it is
    parent: list[int]
    tag: list[str]
    factor: list[float]  # of the path's own tag; with those of its classes and of all above once weighed
    says: list[float]  # of its classes


def role(names: list[str]) -> float:
    """AGAINST if classes and ids speak of a role and of nothing else, or surely of one; PERHAPS if of other things too; else 1."""
    against = other = False
    for name in names:
        parts = _PART.findall(name)
        if not STATES.isdisjoint(parts):
            continue
        if any(p in SURE for p in parts):
            return AGAINST
        rest = [p for p in parts if p not in NEUTRAL and len(p) > 1]
        if rest and (all(p in ROLES or p in HEADS for p in rest) or rest[-1] in ROLES):
            against = True
        elif rest:
            other = True
    return 1.0 if not against else PERHAPS if other else AGAINST


def tags(page: str) -> Iterator[tuple[int, int, str, str, str]]:
    """(start, end, "/" of an end tag, name, attributes) of the tags; comments and declarations have no name. One pass:
    an open quote that nothing ends makes the rest of the page be read without regard to quotes."""
    at, last, pattern, size = 0, page.rfind(">"), _TAG, len(page)
    while 0 <= (lt := page.find("<", at)) < last or lt >= 0 and page.startswith("<!--", lt):
        following = page[lt + 1 : lt + 3]
        if following[:1] in ("!", "?") or following[:1] == "/" and not following[1:].isalpha():
            comment = page.startswith("<!--", lt)
            end = page.find("-->", lt + 2) + 3 if comment else page.find(">", lt) + 1
            at = end if end > 2 or not comment and end else size
            yield lt, at, "", "", ""
            continue
        m = pattern.match(page, lt)
        if m is None and following[:1].isascii() and following[:1] != "<" and (following[:1].isalpha() or following[:1] == "/"):
            pattern = _LOOSE
            m = pattern.match(page, lt)
        if m is None:
            at = lt + 1
            continue
        name = m[2].lower()
        at = m.end()
        yield lt, at, m[1], name, m[3]
        if name in RAW and not m[1]:
            close = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(page, at)
            at = close.start() if close else size


def read(page: str) -> Page:
    """Text pieces with their paths. Every step costs the same however deep the page is: an entry of the stack knows the
    open elements that a new one would end, and end tags without an open element are passed over."""
    out = Page([], [], [], [], [-1], [""], [1.0], [1.0])
    known: dict[tuple[int, str], int] = {}
    number: dict[tuple[int, str, int], int] = {}
    # name, path, silent, places of the open elements of each scope, inside an article or main, of the same name within
    stack: list[list] = [["", 0, False, (-1,) * len(SCOPES), False, 0]]
    count: dict[str, int] = {}
    block, at, link = 0, 0, 0  # link: depth of the stack where an open link began, 0 if none is open
    head = 0  # its place in the stack; a page has one

    def text(upto: int) -> None:
        if upto > at and not stack[-1][2]:
            out.path.append(stack[-1][1])
            out.block.append(block)
            out.link.append(link > 0)
            out.text.append(unescape(page[at:upto]))

    def cut(depth: int) -> None:
        nonlocal link
        for entry in stack[depth:]:
            count[entry[0]] -= 1
        del stack[depth:]
        if link > depth:
            link = 0

    for start, end, slash, name, attributes in tags(page):
        text(start)
        at = end
        if not name:
            continue
        top = stack[-1]
        if name in INLINE:
            if slash:
                if name == "a":
                    link = 0
                if top[0] == name:
                    if top[5]:
                        top[5] -= 1
                    else:
                        cut(len(stack) - 1)
                continue
            if name == "a":
                link = len(stack)
            if top[0] == name:
                top[5] += 1
                continue
            if "=" not in attributes or name == "a":
                continue
        else:
            block += 1
        if slash:
            if count.get(name):
                depth = len(stack) - 1
                while stack[depth][0] != name:
                    depth -= 1
                cut(depth)
            continue
        if name in VOID:
            continue
        found = {k.lower(): (a or b or c).lower() for k, a, b, c in _CLASS.findall(attributes)} if attributes else {}
        classes = found.get("class", "").split()
        says = role([*classes, *found.get("id", "").split(), *found.get("role", "").split()]) if found and name not in ("html", "body") else 1.0
        if name in INLINE and says == 1.0:
            continue
        if name == "head":
            if head:
                continue
            head = len(stack)
        elif count.get("head") and name not in IN_HEAD:
            cut(head)
        if (scope := _SCOPE_OF.get(name)) is not None and (depth := stack[-1][3][scope]) >= 0:
            cut(depth)
        if name not in INLINE and (depth := stack[-1][3][PARAGRAPH]) >= 0:
            cut(depth)
        if name == "tr" and (depth := stack[-1][3][CELL]) >= 0:
            cut(depth)
        if name in ("tbody", "thead", "tfoot") and (depth := stack[-1][3][ROW]) >= 0:
            cut(depth)
        if attributes.rstrip().endswith("/") and name not in CONTAINERS and name not in PARTS and name not in INLINE:
            continue
        _, parent, silent, scopes, within, _ = stack[-1]
        mark = classes[0] if classes else f"#{found['id']}" if found.get("id") else ""
        label = f"{name}.{mark}"
        if name not in PARTS and name not in INLINE:
            place = (len(stack), label, parent)
            number[place] = number.get(place, 0) + 1
            label = f"{label}[{number[place]}]"
        path = known.get((parent, label))
        if path is None:
            path = known[parent, label] = len(out.parent)
            factor = 1.0
            if name in ("nav", "footer", "aside", "dialog", "menu") or name == "header" and not within:
                factor *= AGAINST
            factor *= {"form": FORM, "main": MAIN, "article": ARTICLE}.get(name, 1.0)
            out.parent.append(parent)
            out.tag.append(name)
            out.factor.append(factor)
            out.says.append(says)
        depth = len(stack)
        new = tuple(-1 if name in ends else depth if name in names and was < 0 else was for was, (names, ends) in zip(scopes, SCOPES, strict=True))
        stack.append([name, path, silent or name in SILENT, new, within or name in ("article", "main"), 0])
        count[name] = count.get(name, 0) + 1
    text(len(page))
    return out


def smoothed(parent: list[int], own: np.ndarray) -> np.ndarray:
    """For every path the sum over all paths of ``own`` (rows: paths), weighted by DECAY to the number of steps between them."""
    total = [list(row) for row in own.tolist()]
    width = range(own.shape[1])
    for v in range(len(parent) - 1, 0, -1):
        row, up = total[v], total[parent[v]]
        for i in width:
            up[i] += DECAY * row[i]
    for v in range(1, len(parent)):
        row, up = total[v], total[parent[v]]
        for i in width:
            row[i] += DECAY * (up[i] - DECAY * row[i])
    return np.array(total)


def figures(page: Page) -> np.ndarray:
    """Per path: characters outside of links, punctuation marks among them, blocks with text, all characters."""
    out, last = np.zeros((len(page.parent), 4)), [-1] * len(page.parent)
    rows = out.tolist()
    for path, block, link, text in zip(page.path, page.block, page.link, page.text, strict=True):
        if words := text.split():
            row = rows[path]
            n = sum(map(len, words)) + len(words) - 1
            row[3] += n
            if not link:
                row[0] += n
                row[1] += len(_MARKS.findall(text))
            if last[path] != block:
                row[2] += 1
                last[path] = block
    return np.array(rows)


def weighed(page: Page, own: np.ndarray, least: float = NEARLY_ALL) -> Page:
    """The page with the factors of whole paths. Classes do not count against elements that hold an article or a main part, or
    ``least`` of the page's text outside of links (ENOUGH characters or more)."""
    n, parent = len(page.parent), page.parent
    mass, holds = own[:, 0].tolist(), [t in ("article", "main") for t in page.tag]
    for v in range(n - 1, 0, -1):
        mass[parent[v]] += mass[v]
        holds[parent[v]] = holds[parent[v]] or holds[v]
    above = [h and t not in ("article", "main") for h, t in zip(holds, page.tag, strict=True)]
    factor = [1.0] * n
    for v in range(1, n):
        says = 1.0 if page.says[v] < 1.0 and (above[v] or mass[v] >= max(least * mass[0], ENOUGH)) else page.says[v]
        factor[v] = factor[parent[v]] * says * page.factor[v]
    return page._replace(factor=factor)


def values(page: Page, own: np.ndarray) -> np.ndarray:
    """Smoothed and fused ratios of every path, times the factor of its roles."""
    has = own[:, 2] > 0
    n = np.maximum(own[:, 2], 1)
    length, marks, weight, mass = smoothed(page.parent, np.stack((own[:, 0] / n, own[:, 1] / n, has.astype(float), own[:, 0]), axis=1)).T
    weight = np.maximum(weight, 1e-300)
    marks = marks / weight
    fused = length / weight * (0.5 + 0.5 * marks / max(marks[has].max(initial=0), 1e-9)) * np.sqrt(mass / max(mass[has].max(initial=0), 1e-9))
    return np.where(has & (own[:, 0] > 0), fused, 0) * np.array(page.factor)


def content(page: Page, own: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Paths whose value reaches the page's threshold."""
    total = own[:, 0].sum()
    allowed = np.array(page.factor) >= LEAST
    return (value > 0) & allowed & (value >= SHARE * float((own[:, 0] * value).sum()) / max(total, 1))


def taken(page: Page, own: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(paths that belong to the article, paths that do between its first and last block of content)."""
    n, parent, tag, factor = len(page.parent), page.parent, page.tag, page.factor
    # Cells with blocks of their own lay out the page, so they hold what is in them.
    layout = {parent[v] for v in range(1, n) if tag[parent[v]] in ("td", "th") and (tag[v] not in PARTS or tag[v][:1] in "ph") and tag[v] not in INLINE}
    holder = [0] * n
    for v in range(1, n):
        holder[v] = holder[parent[v]] if (tag[v] in PARTS or tag[v] in INLINE) and v not in layout else v
    weight = np.where(chosen, own[:, 0], 0.0).tolist()
    for v in range(n - 1, 0, -1):
        weight[parent[v]] += weight[v]
    region = 0
    for v in range(1, n):  # children come after parents
        if parent[v] == region or region == holder[parent[v]]:
            if holder[v] == v and weight[v] >= MOST * weight[0]:
                region = v
    best: dict[int, float] = {}
    for v in np.flatnonzero(chosen).tolist():
        best[holder[v]] = max(best.get(holder[v], 0.0), factor[v])
    inside, listed = [False] * n, [False] * n
    always, between = np.zeros(n, bool), np.zeros(n, bool)
    for v in range(n):
        inside[v] = v == region or v > 0 and inside[parent[v]]
        listed[v] = tag[v] in ("ul", "ol", "dl", "table") or v > 0 and listed[parent[v]]
        same = holder[v] in best and factor[v] >= PERHAPS * best[holder[v]]
        near = inside[v] and tag[region] not in ("", "html", "body") and factor[v] >= PERHAPS * factor[region]
        links = listed[v] and 2 * own[v, 0] < own[v, 3]  # a list of links beside the text may be a menu
        title = tag[v] in ("h1", "h2")  # may stand before the first paragraph, in a container of its own
        always[v] = chosen[v] or same and not links or near and (title or tag[region] == "article")
        between[v] = same or near
    if (title := title_before(page, own, region, holder)) is not None:
        always[title] = True
    return always, between


def title_before(page: Page, own: np.ndarray, region: int, holder: list[int]) -> int | None:
    """The page's only first-rank heading, if it stands beside the article in a container of its own and its role is not against it."""
    heads = [v for v in range(1, len(page.parent)) if page.tag[v] == "h1" and own[v, 3]]
    if len(heads) != 1 or page.factor[heads[0]] < PERHAPS or own[heads[0], 2] != 1:
        return None
    around, v = {0}, region
    while v > 0:
        around.add(v)
        v = page.parent[v]
    beside = holder[heads[0]]
    return heads[0] if beside in around or page.parent[beside] in around else None


def main_text(page: str) -> str:
    """The article of a page: white space within a block is one space, blocks are joined by one space. "" if there is none."""
    read_, chosen = read(page), np.zeros(0, bool)
    own = figures(read_)
    for least in (NEARLY_ALL, HALF):
        found = weighed(read_, own, least)
        chosen = content(found, own, values(found, own))
        if chosen.any():
            break
    else:
        return ""
    always, between = taken(found, own, chosen)
    blocks = [b for v, b in zip(found.path, found.block, strict=True) if chosen[v] and always[v]]
    lo, hi = (blocks[0], blocks[-1]) if blocks else (0, -1)
    parts, last = [], None
    for path, block, text in zip(found.path, found.block, found.text, strict=True):
        if always[path] or between[path] and lo < block < hi or text.isspace():
            if block != last:
                parts.append(" ")
                last = block
            parts.append(text)
    return " ".join("".join(parts).split())


def extracted(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars (code points).

    A null or empty page, or one without article text, has the text "". Pages are taken each on its own, repeats alike;
    other columns are ignored; an empty table gives an empty one. A page of any length is read whole, in time that grows with
    its length; its pieces of text and its paths are held, some hundred bytes each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                part = batch.slice(lo, 64)
                texts = [main_text(h or "") for h in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html")).mapInArrow(run, "page_id long, url string, text string, n_chars long")
