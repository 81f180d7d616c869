"""Main text of web pages by minimum-cut labelling.

A page is scanned into text blocks (runs of text between block-level tags) and
the tree of their elements.  A linear classifier on a block's elements, names,
link share and length gives the cost of calling it content or boilerplate; these
costs are the capacities from the two terminals.  Smoothness edges join
neighbours in page order and blocks of one parent element, stronger the closer
their elements are in the tree.  The minimum cut is the labelling with the least
total cost; the source side is the main text.

Names speak for the part of a page that they mark, not for the whole page: those of
elements around the principal article, or around most of the plain text, are left
out (``<div class="site has-sidebar">``).  Of the other elements around a block the
strongest one counts once, however many there are.  Scan and classifier take time
in proportion to the page, whatever the depth of its tree.
"""

from __future__ import annotations

import html
import math
import re
from collections import deque
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element roles of HTML.
_SKIP = frozenset("script style noscript template textarea select option button svg math iframe object canvas audio video title".split())
_RAW = frozenset("script style noscript template textarea title iframe svg".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s "
                    "samp small span strike strong sub sup time tt u var wbr".split())
_BOILER = frozenset("nav header footer aside form menu dialog fieldset".split())
_BOILER_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu".split())
_MAIN = frozenset(("article", "main"))
_CLOSED_BY = {"p": frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main menu "
                             "nav ol p pre section table ul".split()),
              "li": frozenset(("li",)), "dt": frozenset(("dt", "dd")), "dd": frozenset(("dt", "dd")),
              "td": frozenset(("td", "th", "tr")), "th": frozenset(("td", "th", "tr")), "tr": frozenset(("tr",))}
_SCOPES = ("ul", "ol", "table", "dl")
# A quote opens a value only after an equals sign: an odd one elsewhere is part of a name.
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:=\s*(?:\"[^\"]*\"|'[^']*')|[^>=]+|=)*+)(>|\Z)|<[!?][^>]*(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s]+))?")
_INVISIBLE = re.compile(r"display\s*:\s*none", re.I)
_BAD_WORDS = frozenset(
    "ad ads advert adverts advertisement banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices "
    "popup modal overlay nav navbar navigation menu breadcrumb breadcrumbs sidebar sidenav rail widget footer header masthead "
    "toolbar comment comments replies disqus share sharing social related recommended newsletter subscribe signup login "
    "pagination pager copyright outbrain taboola".split())
#: Words that also name an article's own parts or states: decisive only alone.
_WEAK_WORDS = frozenset("alert side discussion respond follow more search tag tags legal skip".split())
_GOOD_WORDS = frozenset("article main content post story entry hentry body text".split())
#: Tokens that tell a state or a topic of an element, not what it is.
_STATE = re.compile(r"^(?:has|no|with|without)[-_]|[-_](?:open|closed|on|off|enabled|disabled|active|expanded|collapsed)$")
_TOPIC = re.compile(r"^(?:tag|category)[-_]")
_SPLIT = re.compile(r"[-_]+")

STRONG, WEAK = -6.0, -2.5  # evidence against content
NEIGHBOUR = 0.6   # smoothness between blocks next to each other
SAME_PARENT = 1.2  # added when they are alike elements of one parent
_BLANK = re.compile(r"\s+")


@dataclass
class Element:
    tag: str
    parent: int                # position among the page's elements, -1 for none
    depth: int                 # elements around it and itself, inline ones left out
    block: int                 # nearest element that is not inline, itself included
    role: float                # evidence of its tag and visibility, at most 0
    name: float                # evidence of its names, at most 0
    good: bool                 # a name says content
    mixed: bool                # a name says nothing against content
    main: bool                 # article or main
    plain: int = 0             # characters inside, without links and parts that its role rules out


@dataclass
class Block:
    text: str
    element: int               # innermost element
    tag: str                   # innermost one that is not inline
    parent: int                # the one around that
    linked: int                # characters inside links
    apart: int                 # steps in the tree from the block before


@dataclass
class Page:
    blocks: list[Block] = field(default_factory=list)
    elements: list[Element] = field(default_factory=list)


def name_evidence(names: str) -> tuple[float, bool, bool]:
    """(evidence against content, some name says content, some name says nothing
    against it) of an element's class names and id.

    A word of :data:`_BAD_WORDS` beside names that say content is weak evidence;
    one of :data:`_WEAK_WORDS` counts in full only where no other name stands."""
    strong = weak = good = other = False
    tokens = names.lower().split()
    for token in tokens:
        words = _SPLIT.split(token)
        if _STATE.search(token) or (len(tokens) > 1 and _TOPIC.search(token)):
            other = True
        elif not _BAD_WORDS.isdisjoint(words):
            strong = True
        elif not _WEAK_WORDS.isdisjoint(words):
            weak = True
        elif not _GOOD_WORDS.isdisjoint(words):
            good = True
        else:
            other = True
    mixed = good or other
    if strong:
        return (WEAK if good else STRONG), good, mixed
    if weak:
        return (0.0 if good else WEAK if other else STRONG), good, mixed
    return 0.0, good, True


def _element(tag: str, attributes: str, parent: int, depth: int, block: int, in_main: bool) -> Element:
    role, main, names = 0.0, tag in _MAIN, ""
    if tag in _BOILER:
        role = -1.0 if tag == "header" and in_main else STRONG
    if attributes:
        for key, value in _ATTRIBUTE.findall(attributes):
            key, value = key.lower(), value.strip("\"'")
            if key in ("class", "id"):
                names += " " + value
            elif key == "role":
                said = set(value.lower().split())
                main = main or "main" in said
                role = min(role, STRONG) if said & _BOILER_ROLES else role
            elif key == "hidden" or (key == "aria-hidden" and value.lower() == "true") or (key == "style" and _INVISIBLE.search(value)):
                role = min(role, STRONG)
    if tag in _SKIP or tag == "head":
        role = -20.0
    name, good, mixed = (0.0, False, True) if tag in ("body", "html") else name_evidence(names)
    return Element(tag, parent, depth, block, role, name, good, mixed, main)


def scanned(page: str) -> Page:
    """Text blocks of a page in order and its elements; scripts and the like are
    gone and character references decoded.  Broken markup is read as far as it goes."""
    out = Page()
    elements = out.elements
    stack: list[int] = []
    opened: dict[str, list[int]] = {}  # positions in the stack by tag
    parts: list[str] = []
    linked = at = mains = 0
    before = low = 0  # depth of the block before, and the lowest since

    def depth() -> int:
        return elements[stack[-1]].depth if stack else 0

    def innermost(tag: str) -> int:
        own = opened.get(tag)
        return own[-1] if own else -1

    def close(position: int) -> None:
        nonlocal low, mains
        while len(stack) > position:
            e = elements[stack.pop()]
            opened[e.tag].pop()
            mains -= e.main
        low = min(low, depth())

    def flush() -> None:
        nonlocal linked, before, low
        text = _BLANK.sub(" ", html.unescape("".join(parts))).strip()
        if text:
            element = stack[-1] if stack else -1
            inner = elements[element].block if stack else -1
            parent = elements[inner].parent if inner >= 0 else -1
            out.blocks.append(Block(text, element, elements[inner].tag if inner >= 0 else "",
                                    elements[parent].block if parent >= 0 else -1, min(linked, len(text)),
                                    before + depth() - 2 * low))
            before = low = depth()
        parts.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if text:
            parts.append(text)
            if opened.get("a"):
                linked += len(text)

    while at < len(page):
        found = _TOKEN.search(page, at)
        if not found:
            add(page[at:])
            break
        add(page[at:found.start()])
        at = found.end()
        tag = (found.group(2) or "").lower()
        if not tag:
            continue
        if found.group(1):
            if tag not in _INLINE:
                flush()
            position = innermost(tag)
            # an inline element ends only where no block has been opened inside it
            if position >= 0 and (tag not in _INLINE or elements[stack[position]].depth == depth()):
                close(position)
            continue
        if tag in _RAW:
            if not found.group(3).endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                at = end.end() if end else len(page)
            continue
        if tag in _VOID:
            if tag == "br":
                add(" ")
            elif tag == "hr":
                flush()
            continue
        if tag not in _INLINE:
            flush()
            for closing, by in _CLOSED_BY.items():
                if tag in by:  # an open paragraph, list item or cell ends here
                    position = innermost(closing)
                    if position >= 0 and (closing == "p" or all(innermost(t) < position for t in _SCOPES)):
                        close(position)
            if tag == "body" and innermost("head") >= 0:
                close(innermost("head"))
        parent, inline = (stack[-1] if stack else -1), tag in _INLINE
        block = len(elements) if not inline else elements[parent].block if parent >= 0 else -1
        made = _element(tag, found.group(3), parent, depth() + (not inline), block, mains > 0)
        opened.setdefault(tag, []).append(len(stack))
        stack.append(len(elements))
        elements.append(made)
        mains += made.main
    flush()
    return out


def principal(elements: list[Element]) -> int:
    """The article or main with most plain text, or one inside it that holds half
    of that; -1 if there is none.  One that its names speak against is none."""
    own = [e.main and e.plain > 0 and (e.mixed or e.name > STRONG) for e in elements]
    best = max((i for i, fits in enumerate(own) if fits), key=lambda i: (elements[i].plain, -i), default=-1)
    inside = {best}
    for i in range(best + 1, len(elements) if best >= 0 else 0):  # elements come after those around them
        if elements[i].parent in inside:
            inside.add(i)
            if own[i] and 2 * elements[i].plain >= elements[best].plain:
                best, inside = i, {i}
    return best


def path_evidence(page: Page) -> list[float]:
    """Classifier's evidence for content from the elements around each block."""
    elements = page.elements
    ruled_out: list[bool] = []
    for e in elements:
        ruled_out.append(e.role <= STRONG and e.tag != "form" or e.parent >= 0 and ruled_out[e.parent])
    total = 0
    for b in page.blocks:
        plain = len(b.text) - b.linked
        if b.element < 0 or not ruled_out[b.element]:
            total += plain
            if b.element >= 0:
                elements[b.element].plain += plain
    for e in reversed(elements):
        if e.parent >= 0:
            elements[e.parent].plain += e.plain
    around, i = set(), principal(elements)
    while i >= 0:
        around.add(i)
        i = elements[i].parent
    against: list[float] = []   # strongest evidence of the elements around, itself included
    main: list[bool] = []
    good: list[bool] = []
    for i, e in enumerate(elements):
        wrapper = i in around or (e.mixed and total > 0 and 2 * e.plain > total)
        role = 0.0 if wrapper and e.tag == "form" else e.role
        own = min(role, 0.0 if wrapper else e.name)
        inherited = (against[e.parent], main[e.parent], good[e.parent]) if e.parent >= 0 else (0.0, False, False)
        against.append(min(own, inherited[0]))
        main.append(e.main or inherited[1])
        good.append(e.good or inherited[2])
    out = []
    for b in page.blocks:
        if b.element < 0:
            out.append(0.0)
        elif against[b.element] <= STRONG:  # an article's name does not speak for the menu inside it
            out.append(against[b.element])
        else:
            out.append(against[b.element] + 3.0 * main[b.element] + 1.5 * good[b.element]
                       + (0.5 if b.tag in ("h1", "p", "pre", "blockquote") else 0.0))
    return out


def log_odds(block: Block, evidence: float) -> float:
    """Classifier: evidence for content of one block."""
    words = block.text.count(" ") + 1
    return evidence + 0.5 * math.log(words) - 1.0 - 4.0 * block.linked / max(1, len(block.text))


def minimum_cut(content: list[float], boilerplate: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Labels of least cost: ``content[i]`` is paid when block i is content,
    ``boilerplate[i]`` when it is not, an edge's weight when its ends differ.
    Maximum flow by shortest augmenting paths in level graphs; a block is content
    when the source still reaches it."""
    n = len(content)
    source, sink = n, n + 1
    heads: list[int] = []
    room: list[float] = []
    graph: list[list[int]] = [[] for _ in range(n + 2)]

    def arc(u: int, v: int, forth: float, back: float) -> None:
        graph[u].append(len(heads))
        heads.append(v)
        room.append(forth)
        graph[v].append(len(heads))
        heads.append(u)
        room.append(back)

    for i in range(n):  # what both terminals can give flows straight through
        through = min(content[i], boilerplate[i])
        if boilerplate[i] > through:
            arc(source, i, boilerplate[i] - through, 0.0)
        elif content[i] > through:
            arc(i, sink, content[i] - through, 0.0)
    for u, v, w in edges:
        arc(u, v, w, w)
    tiny = 1e-9
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            u = queue.popleft()
            for e in graph[u]:
                if room[e] > tiny and level[heads[e]] < 0:
                    level[heads[e]] = level[u] + 1
                    queue.append(heads[e])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        turn = [0] * (n + 2)
        path: list[int] = []
        u = source
        while True:
            if u == sink:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                cut = next(k for k, e in enumerate(path) if room[e] <= tiny)
                u = heads[path[cut] ^ 1]
                del path[cut:]
                continue
            while turn[u] < len(graph[u]):
                e = graph[u][turn[u]]
                if room[e] > tiny and level[heads[e]] == level[u] + 1:
                    path.append(e)
                    u = heads[e]
                    break
                turn[u] += 1
            else:
                if u == source:
                    break
                turn[heads[path[-1] ^ 1]] += 1
                u = heads[path.pop() ^ 1]


def smoothness(found: list[Block]) -> list[tuple[int, int, float]]:
    """Edges between neighbours in page order and, for alike blocks of one parent
    that are not neighbours, to the previous one."""
    out = []
    last: dict[tuple[int, str], int] = {}
    for i, b in enumerate(found):
        if i:
            out.append((i - 1, i, NEIGHBOUR / (1 + b.apart) + (SAME_PARENT if b.apart <= 2 and found[i - 1].tag == b.tag else 0.0)))
        kind = (b.parent, b.tag)
        if kind in last and last[kind] < i - 1:
            out.append((last[kind], i, SAME_PARENT / 2))
        last[kind] = i
    return out


def _softplus(x: float) -> float:
    return x if x > 30 else math.log1p(math.exp(x))


def main_text(page: str | None) -> str:
    """Main text of one page: content blocks joined by a line feed."""
    found = scanned(page or "")
    if not found.blocks:
        return ""
    odds = [log_odds(b, e) for b, e in zip(found.blocks, path_evidence(found))]
    keep = minimum_cut([_softplus(-o) for o in odds], [_softplus(o) for o in odds], smoothness(found.blocks))
    return "\n".join(b.text for b, k in zip(found.blocks, keep) if k)


def extract(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points of the text).

    A null or empty page, and one without content, has an empty text.  Repeated
    rows are returned as often as they come; other columns are ignored; an empty
    table gives an empty result.
    """
    @F.arrow_udf("string")
    def text(pages: pa.Array) -> pa.Array:
        return pa.array([main_text(p) for p in pages.to_pylist()], pa.string())

    out = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), text(F.col(html_col)).alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("long"))
