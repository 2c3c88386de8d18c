"""Main text of web pages by wrapper induction: pages of a host are aligned by simple tree matching.

1. A page is a tree of elements and texts. Elements that never hold an article (menus, forms, scripts and the
   like, by tag) are furniture from the start, but for a form, dialog or the like that holds most of the page's text, or an
   ``article`` or ``main``. Outside ``article`` and ``main``, elements that a class, id or role names so are furniture if
   such an element is on half of the host's pages; on a host of one page the name decides. What holds most of the text or a
   first heading is never furniture by its name.
2. All pages of a host are counted, pages with one and the same text once: a text is *template* if it stands at
   the same path (tags and classes) in two pages at least and in half of those that have the containers above it,
   so that each layout is judged by its own pages. The wrapper is the tree of the template texts, and the place
   below which most of the varying text lies.
3. Of every page the template texts go. Where a page has a template text more often than the wrapper, simple tree
   matching of the page with the wrapper says which of them it is. Of the rest what lies below the place of the
   varying text is the article, with a first heading that stands before it. A host of one page has no template; then the place is found in the page alone.
"""

from __future__ import annotations

import math
import re
import sys
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce
from html import unescape
from itertools import chain

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from pricepanel.llm.common import stored, text_batches

# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody td tfoot th thead title tr ul".split()
)
#: Start tags that end an open element: tag -> the elements it ends, unless one of the others is open inside.
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select", "datalist")),
    "body": (("head",), ()),
}
FURNITURE = frozenset("head nav header footer aside form menu dialog button select input label fieldset script style template noscript iframe object svg canvas video audio map search".split())
#: Furniture only if it is a small part of the page.
MAY_HOLD_ALL = frozenset("form fieldset dialog menu".split())
NEVER_HINTED = frozenset("html body article main h1 h2 h3 h4 h5 h6 hgroup".split())
#: Parts of class, id or role that name furniture.
HINT = re.compile(
    r"(?i)(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|nav\w*|menu\w*|breadcrumbs?|sidebar|side|widget|footer|header|masthead|cookies?|consent|gdpr|notice|alert|popup|modal|overlay|newsletter|subscribe|signup|login|share|social|related|recommend\w*|comments?|replies|disqus|pagination|pager|toolbar|search\w*|form|contentinfo|complementary|navigation|banner)(?:$|[\s_-])"
)
#: Those that count inside an article too, where such an element is on half of a host's pages.
INNER_HINT = re.compile(r"(?i)(?:^|[\s_-])(?:comments?|disqus|replies|ads?|advert\w*|sponsor\w*|promo\w*|newsletter|subscribe|cookies?|consent|gdpr)(?:$|[\s_-])")
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_NAMES = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_WHITE = " \t\n\r\x0c"
#: Between the labels of a path; class names never have it.
_STEP = "\x1f"
#: Paths name so many steps; all below are one step, with their hash, so that deeply nested pages have short paths.
_NAMED_STEPS = 100
sys.setrecursionlimit(max(sys.getrecursionlimit(), 1_000_000))  # trees are walked by functions that call themselves, as deep as pages are nested


@dataclass
class Node:
    """An element, or a text where ``tag`` is empty."""

    tag: str
    text: str = ""
    mark: str = ""
    furniture: bool = False
    hint: bool = False
    inside: bool = False
    children: list[Node] = field(default_factory=list)

    @property
    def label(self) -> str:
        return f"{self.tag}.{self.mark}" if self.mark else self.tag


def parse(html: str | None) -> Node:
    """The tree of a page; whatever the input, it never fails."""
    html = html or ""
    root = Node("#root")
    open_nodes, at, inside = [root], 0, 0  # inside: open ``article`` and ``main`` elements
    doubtful: list[Node] = []

    open_tags: Counter = Counter()

    def text(raw: str) -> None:
        if raw:
            open_nodes[-1].children.append(Node("", unescape(raw)))

    def close() -> None:
        nonlocal inside
        tag = open_nodes.pop().tag
        open_tags[tag] -= 1
        inside -= tag in ("article", "main")

    def finish(tags: tuple[str, ...], within: tuple[str, ...]) -> None:
        """Ends the innermost open element of ``tags``, unless one of ``within`` is open inside."""
        if not any(open_tags[t] for t in tags):
            return
        for i in range(len(open_nodes) - 1, 0, -1):
            if open_nodes[i].tag in tags:
                while len(open_nodes) > i:
                    close()
                return
            if open_nodes[i].tag in within:
                return

    for m in _TAG.finditer(html):
        if m.start() < at:
            continue
        text(html[at : m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            if m[0].startswith("<![CDATA["):
                text(m[0][9:-3])
            continue
        if m[1]:
            if open_tags[tag]:
                while open_nodes[-1].tag != tag:
                    close()
                close()
            continue
        if tag in BLOCKS:
            finish(("p",), ("table", "button", "object", "div", "article", "section", "td", "li"))
        if tag in CLOSES:
            finish(*CLOSES[tag])
        node = Node(tag)
        if m[3]:
            found = {k.lower(): a or b or c for k, a, b, c in _NAMES.findall(m[3])}
            names = " ".join(found.get(k, "") for k in ("class", "id", "role"))
            node.mark = ".".join(sorted(found.get("class", "").split()))
            hidden = "hidden" in found or found.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", found.get("style", ""))
            node.furniture = bool(hidden)
            node.inside = inside > 0
            node.hint = tag not in NEVER_HINTED and bool((INNER_HINT if inside else HINT).search(names))
        if tag in MAY_HOLD_ALL or node.hint:
            doubtful.append(node)
        node.furniture |= tag in FURNITURE and not (tag == "header" and inside)
        open_nodes[-1].children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(html, at)
            raw = html[at : end.start() if end else len(html)]
            node.children.append(Node("", unescape(raw) if tag in ("title", "textarea") else raw))
            node.furniture |= tag != "noscript"
            at = end.end() if end else len(html)
        elif tag not in VOID and not m[0].endswith("/>"):
            open_nodes.append(node)
            open_tags[tag] += 1
            inside += tag in ("article", "main")
    text(html[at:])
    if doubtful:
        _clear_doubts(root, doubtful)
    return root


def _clear_doubts(root: Node, doubtful: list[Node]) -> None:
    """What holds more than half of the page's text is no furniture by its name, unless the page has an article elsewhere; nor is a hinted element with a first heading, or a form with the article."""
    held: dict[int, tuple[int, bool, bool]] = {}
    in_articles = 0

    def measure(node: Node) -> tuple[int, bool, bool]:
        """Length of the texts below that may count, and is there an h1, an ``article`` or ``main``?"""
        nonlocal in_articles
        size, heading, article = 0, False, False
        for c in node.children:
            if not c.tag:
                size += len(c.text.strip(_WHITE))
            elif c.tag not in RAW:
                n, h, a = measure(c)
                size += n if c.tag in MAY_HOLD_ALL or not c.furniture else 0
                heading, article = heading or h or c.tag == "h1", article or a or c.tag in ("article", "main")
                in_articles += n if c.tag in ("article", "main") else 0
        held[id(node)] = size, heading, article
        return held[id(node)]

    total = measure(root)[0]
    for node in doubtful:
        size, heading, article = held[id(node)]
        most = 2 * size > total and (node.inside or article or not in_articles)
        node.hint &= not (most or heading or article)
        if node.tag in MAY_HOLD_ALL and (most or article):
            node.furniture = False


def content(node: Node) -> list[Node]:
    """Children that count: no furniture, no white space alone."""
    return [c for c in node.children if not c.furniture and (c.tag or c.text.strip(_WHITE))]


def match(a: Node, b: Node, pairs: list[tuple[Node, Node]] | None = None) -> int:
    """Simple tree matching of a wrapper's tree with a page: the most equal texts that can be matched in order, under equal labels.

    ``pairs`` gets the matched texts. Exact for lists of any length: children that hold no common text match
    nothing, equal heads and tails belong together, and between them the heaviest chain of the pairs that share a text is taken.
    """
    own: dict[int, set[str]] = {}
    marks: dict[int, int] = {}
    lists: dict[int, list[Node]] = {}

    def prepare(node: Node, name, wanted: set[str] | None) -> set[str]:
        """Texts below, children that hold some, and a hash of it all."""
        if not node.tag:
            t = name(node)
            own[id(node)] = {t} if wanted is None or t in wanted else set()
            marks[id(node)] = hash(("", t))
        else:
            kids = [c for c in content(node) if prepare(c, name, wanted)]
            lists[id(node)] = kids
            own[id(node)] = set().union(*(own[id(c)] for c in kids))
            marks[id(node)] = hash((node.label, *(marks[id(c)] for c in kids)))
        return own[id(node)]

    prepare(b, lambda n: str(hashed(squeezed(n.text))), prepare(a, lambda n: n.text, None))
    known: dict[tuple[int, int], tuple[int, list[tuple[Node, Node]]]] = {}

    def best(p: Node, q: Node) -> tuple[int, list[tuple[Node, Node]]]:
        """Equal texts below the two, and the children that are matched for it."""
        if (id(p), id(q)) in known:
            return known[id(p), id(q)]
        if p.label != q.label or own[id(p)].isdisjoint(own[id(q)]):
            out: tuple[int, list[tuple[Node, Node]]] = (0, [])
        elif not p.tag:
            out = (1, [])
        else:
            x, y = lists[id(p)], lists[id(q)]
            same = lambda c, d: marks[id(c)] == marks[id(d)]
            head = 0
            while head < min(len(x), len(y)) and same(x[head], y[head]):
                head += 1
            tail = 0
            while tail < min(len(x), len(y)) - head and same(x[-1 - tail], y[-1 - tail]):
                tail += 1
            way = [*zip(x[:head], y[:head], strict=True), *_chain(x[head : len(x) - tail], y[head : len(y) - tail], own, lambda c, d: best(c, d)[0]), *zip(x[len(x) - tail :], y[len(y) - tail :], strict=True)]
            out = (sum([best(c, d)[0] for c, d in way]), way)
        known[id(p), id(q)] = out
        return out

    def collect(p: Node, q: Node) -> None:
        if not p.tag:
            pairs.append((p, q))
        for c, d in best(p, q)[1]:
            collect(c, d)

    if pairs is not None and best(a, b)[0]:
        collect(a, b)
    return best(a, b)[0]


def _chain(x: list[Node], y: list[Node], own: dict[int, set[str]], weight) -> list[tuple[Node, Node]]:
    """The heaviest pairs of x and y in the order of both; only pairs that share a text weigh anything."""
    at = defaultdict(list)
    for j, d in enumerate(y):
        for t in own[id(d)]:
            at[t].append(j)
    tree: list[tuple[int, tuple | None]] = [(0, None)] * (len(y) + 1)  # greatest weight of chains that end before a place
    for i, c in enumerate(x):
        for j in sorted({j for t in own[id(c)] for j in at[t]}, reverse=True):
            w = weight(c, y[j])
            if not w:
                continue
            end, k = (0, None), j
            while k:
                end, k = (tree[k] if tree[k][0] > end[0] else end), k & (k - 1)
            end, k = (end[0] + w, (i, j, end[1])), j + 1
            while k <= len(y):
                if end[0] > tree[k][0]:
                    tree[k] = end
                k += k & -k
    top, k = (0, None), len(y)
    while k:
        top, k = (tree[k] if tree[k][0] > top[0] else top), k & (k - 1)
    way, link = [], top[1]
    while link:
        way.append((x[link[0]], y[link[1]]))
        link = link[2]
    return way[::-1]


def squeezed(text: str) -> str:
    return " ".join(x for x in re.split(r"[ \t\n\r\x0c]+", text) if x)


def texts_by_path(node: Node, skip: set[int]) -> list[tuple[tuple[str, ...], int]]:
    """(path of labels, length) of each text that is neither furniture nor in ``skip``."""
    out: list[tuple[tuple[str, ...], int]] = []

    def walk(n: Node, path: tuple[str, ...]) -> None:
        for c in content(n):
            if c.tag:
                walk(c, _below(path, c.label))
            elif id(c) not in skip:
                out.append((path, len(c.text.strip(_WHITE))))

    walk(node, ())
    return out


def _below(path: tuple[str, ...], label: str) -> tuple[str, ...]:
    """The path of an element under ``path``."""
    if len(path) < _NAMED_STEPS:
        return (*path, label)
    deep = path[_NAMED_STEPS] if len(path) > _NAMED_STEPS else ""
    return (*path[:_NAMED_STEPS], f"#{hashed(deep + _STEP + label)}")


def main_place(texts: list[tuple[tuple[str, ...], int]], share: float = 0.7) -> tuple[str, ...]:
    """The deepest path of block elements below which ``share`` of the text lies."""
    total, weights = sum(n for _, n in texts), {}
    for path, n in texts:
        for depth in range(len(path) + 1):
            weights[path[:depth]] = weights.get(path[:depth], 0) + n
    fit = [p for p, n in weights.items() if n >= share * total and (not p or _container(p[-1]))]
    place = max(fit, key=lambda p: (len(p), weights[p], p), default=())
    return _to_article(place)


def _to_article(place: tuple[str, ...]) -> tuple[str, ...]:
    """An article that holds it all is the article, headings included."""
    for i, label in enumerate(place):
        if label.split(".")[0] in ("article", "main"):
            return place[: i + 1]
    return place


def _container(label: str) -> bool:
    return label.split(".")[0] in BLOCKS and label.split(".")[0] not in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "blockquote", "pre", "td", "th", "tr")


@dataclass
class Wrapper:
    """What a host's pages have in common: the tree of their constant texts, how many of each, and the article's place."""

    tree: Node | None = None
    template: dict[tuple[str, int], int] = field(default_factory=dict)
    place: tuple[str, ...] | None = None
    hints: frozenset[str] | None = None  # paths of the elements whose names count; None: any outside articles
    broad: frozenset[tuple[str, int]] = frozenset()  # texts on nearly all pages, or on some that are no near copies of each other


@dataclass
class Text:
    """A text of a page: its path, the containers above it, its hash, which of the equal ones it is, its order, the number of elements it shares with the text before."""

    node: Node
    path: str
    scope: str
    key: int
    nth: int
    place: int
    shared: int
    size: int
    hinted: bool


#: ``nth`` of an element whose name says furniture, in the place of a text's.
_ELEMENT = -1


def hashed(text: str) -> int:
    h = xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"))
    return h - (1 << 64) if h >> 63 else h


def facts(root: Node) -> list[Text]:
    """The texts of a page that are no furniture, in page order; the elements whose names say furniture, each path once."""
    out: list[Text] = []
    seen: Counter = Counter()
    before: tuple[int, ...] = ()
    named: set[str] = set()

    def walk(node: Node, path: tuple[str, ...], chain: tuple[int, ...], hinted: bool) -> None:
        nonlocal before
        joined = scope = None
        for c in content(node):
            if c.tag:
                below = _below(path, c.label)
                if c.hint and (name := _STEP.join(below)) not in named:
                    named.add(name)
                    out.append(Text(c, name, "", 0, _ELEMENT, 0, 0, 0, True))
                walk(c, below, (*chain, id(c)) if len(chain) < _NAMED_STEPS else chain, hinted or c.hint)
                continue
            if joined is None:
                joined, scope = _STEP.join(path), _STEP.join(x for x in _to_article(path) if _container(x))
            text = squeezed(c.text)
            key = hashed(text)
            shared = next((i for i, (a, b) in enumerate(zip(chain, before, strict=False)) if a != b), min(len(chain), len(before)))
            out.append(Text(c, joined, scope, key, seen[joined, key], len(out), shared, len(text), hinted))
            seen[joined, key] += 1
            before = chain

    walk(root, (), (), False)
    return out


#: The scope of all pages of a host.
_ALL = hashed("")


def whole(texts: list[Text]) -> int:
    """Pages of one such value are copies of each other."""
    return hashed(" ".join(str(t.key) for t in texts if t.nth != _ELEMENT))


#: So many votes of a page, each for one of its texts: the longer, the likelier. Pages are unlike if half of the votes are for three texts or more.
_VOTES = 4


def votes_of(texts: list[Text]) -> list[int]:
    """Bits of the texts that a page votes for. Near copies vote alike, pages that share little of their text do not."""
    rows = [(t.key, t.size) for t in texts if t.nth != _ELEMENT and t.size]
    spread = lambda key, seed: xxhash.xxh3_64_intdigest(key.to_bytes(8, "little", signed=True), seed=seed) + 1
    return [1 << min((-math.log(spread(k, seed) / 2**64) / n, k) for k, n in rows)[1] % 62 if rows else 0 for seed in range(_VOTES)]


def wrapper_of(constant: list[tuple], place: tuple[str, ...] | None, pages: int) -> Wrapper:
    """From (path, hash, which of the equal ones, mean order, least shared elements, is it broad) of each constant text, and the number of different pages."""
    hints = frozenset(c[0] for c in constant if c[2] == _ELEMENT)
    constant = [c for c in constant if c[2] != _ELEMENT]
    root = Node("#root")
    branch, template = [root], Counter()
    for path, key, _, _, shared, *_ in sorted(constant, key=lambda c: (c[3], c[:3])):
        template[path, key] += 1
        labels = path.split(_STEP) if path else []
        keep = next((i for i, (a, b) in enumerate(zip(labels, branch[1:], strict=False)) if a != b.tag), min(len(labels), len(branch) - 1))
        del branch[min(keep, shared) + 1 :]
        for label in labels[len(branch) - 1 :]:
            node = Node(label)
            branch[-1].children.append(node)
            branch.append(node)
        branch[-1].children.append(Node("", str(key)))
    broad = frozenset((c[0], c[1]) for c in constant if c[5:] == (True,))
    return Wrapper(root if constant else None, dict(template), place, hints if pages > 1 else None, broad)


def induce(pages: list[str]) -> Wrapper:
    """The wrapper of some pages, here and now; copies count once, so fewer than two different ones make no template."""
    distinct = {whole(t): t for t in map(facts, map(parse, pages))}
    pages_with, scopes, found = Counter(), Counter(), defaultdict(list)
    for texts in distinct.values():
        scopes.update({t.scope for t in texts} | {""})
        for t in texts:
            found[t.path, t.key, t.nth].append(t)
    pages_with.update({k: len(v) for k, v in found.items()})
    constant = {k: found[k] for k, n in pages_with.items() if n >= 2 and 2 * n >= scopes[found[k][0].scope]}
    varying = [(tuple(t.path.split(_STEP)) if t.path else (), t.size) for texts in distinct.values() for t in texts if not t.hinted and (t.path, t.key, t.nth) not in constant]
    votes = {id(t): votes_of(texts) for texts in distinct.values() for t in texts}
    told = lambda v: (len(v) >= 3 and 10 * len(v) >= 9 * scopes[v[0].scope]) or 2 * sum(len({votes[id(t)][i] for t in v}) >= 3 for i in range(_VOTES)) >= _VOTES
    return wrapper_of([(*k, sum(t.place for t in v) / len(v), min(t.shared for t in v), told(v)) for k, v in constant.items()], main_place(varying) if varying else None, len(distinct))


def below(root: Node, place: tuple[str, ...]) -> list[Node]:
    """Nodes at a path, in page order; none if the page has no such place."""
    nodes = [root]
    for label in place:
        nodes = [c for n in nodes for c in content(n) if c.label == label]
    return nodes


def blocks_of(node: Node, skip: set[int]) -> list[str]:
    """Texts of the blocks below a node, in page order, white space squeezed."""
    out: list[list[str]] = [[]]

    def walk(n: Node) -> None:
        for c in n.children:
            if c.furniture or id(c) in skip:
                continue
            if not c.tag:
                out[-1].append(c.text)
            elif c.tag == "br":
                out[-1].append(" ")
            elif c.tag in BLOCKS:
                out.append([])
                walk(c)
                out.append([])
            else:
                walk(c)

    walk(node)
    return [t for t in (squeezed("".join(parts)) for parts in out) if t]


def texts_below(node: Node) -> Iterator[Node]:
    """The texts below a node that count."""
    for c in content(node):
        if c.tag:
            yield from texts_below(c)
        else:
            yield c


def headings_before(root: Node, nodes: list[Node]) -> list[Node]:
    """First headings outside and before some nodes: the titles of articles whose text is in a container of its own."""
    first, out = id(nodes[0]) if nodes else None, []

    def walk(node: Node) -> bool:
        for c in content(node):
            if id(c) == first or (c.tag and c.tag != "h1" and walk(c)):
                return True
            if c.tag == "h1":
                out.append(c)
        return False

    return out if walk(root) else []


def _settle(node: Node, hints: frozenset[str] | None, path: tuple[str, ...] = ()) -> None:
    """Makes furniture of the elements whose names count."""
    for c in node.children:
        if c.tag and not c.furniture:
            below = _below(path, c.label)
            if c.hint and (not c.inside if hints is None else _STEP.join(below) in hints):
                c.furniture = True
            else:
                _settle(c, hints, below)


def extract(html: str | None, wrapper: Wrapper) -> str:
    """The article of a page, one line a block; the host's constant texts go, inside an ``article`` or ``main`` too.

    Where they are more than half of the article it may be a near copy of others: then only those go from it that are on nine
    tenths of the pages (three at least), or on pages unlike each other.
    """
    root = parse(html)
    _settle(root, wrapper.hints)
    skip: set[int] = set()
    if wrapper.tree is not None:
        texts = [t for t in facts(root) if t.nth != _ELEMENT and (t.path, t.key) in wrapper.template]
        often = Counter((t.path, t.key) for t in texts)
        skip = {id(t.node) for t in texts if often[t.path, t.key] <= wrapper.template[t.path, t.key]}
        if len(skip) < len(texts):
            pairs: list[tuple[Node, Node]] = []
            match(wrapper.tree, root, pairs)
            skip |= {id(q) for _, q in pairs}
    nodes = below(root, wrapper.place) if wrapper.place else []
    if skip:
        titles = headings_before(root, nodes)
        within = list(chain.from_iterable(texts_below(n) for n in [*titles, *(nodes or [root])]))
        gone = sum(len(t.text.strip(_WHITE)) for t in within if id(t) in skip)
        if 2 * gone > sum(len(t.text.strip(_WHITE)) for t in within):
            named = {id(t.node): (t.path, t.key) for t in texts}
            skip -= {id(t) for t in within if named.get(id(t)) not in wrapper.broad}
    if not any(blocks_of(n, skip) for n in nodes):
        nodes = below(root, main_place(list(texts_by_path(root, skip)))) or [root]
    return "\n".join(b for n in [*headings_before(root, nodes), *nodes] for b in blocks_of(n, skip))


_TEXTS = pa.list_(pa.struct([("path", pa.string()), ("scope", pa.int64()), ("key", pa.int64()), ("nth", pa.int32()), ("place", pa.int32()), ("shared", pa.int32()), ("size", pa.int32()), ("hinted", pa.bool_())]))
_FACTS = pa.schema([("_host", pa.string()), ("_whole", pa.int64()), ("_votes", pa.list_(pa.int64())), ("_texts", _TEXTS)])
_FACT_KINDS = "_host string, _whole long, _votes array<long>, _texts array<struct<path: string, scope: long, key: long, nth: int, place: int, shared: int, size: int, hinted: boolean>>"


def _facts(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_batches(it):
        names, votes, rows = [], [], []
        for html in batch.column(1).to_pylist():
            texts = facts(parse(html))
            names.append(whole(texts))
            votes.append(votes_of(texts))
            rows.append([{"path": t.path, "scope": hashed(t.scope), "key": t.key, "nth": t.nth, "place": t.place, "shared": t.shared, "size": t.size, "hinted": t.hinted} for t in texts])
        yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.string()), pa.array(names, pa.int64()), pa.array(votes, pa.list_(pa.int64())), pa.array(rows, _TEXTS)], schema=_FACTS)


def _wrappers(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import pickle

    for batch in it:
        blobs = []
        for constant, place, n in zip(*[batch.column(i).to_pylist() for i in (1, 2, 3)], strict=True):
            at = None if place is None else _to_article(tuple(place.split(_STEP)) if place else ())
            blobs.append(pickle.dumps(([tuple(c.values()) for c in constant or []], at, n)))
        yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.string()), pa.array(blobs, pa.binary())], names=["_host", "_wrapper"])


def wrappers(pages: DataFrame, salts: int = 32) -> DataFrame:
    """``_host`` and ``_wrapper`` (what ``wrapper_of`` takes, pickled) from all rows of ``_host`` and ``_html``."""
    read = pages.select("_host", "_html").where("_html is not null").mapInArrow(_facts, _FACT_KINDS)
    distinct = stored(read.groupBy("_host", "_whole").agg(F.min("_texts").alias("_texts"), F.min("_votes").alias("_votes")), "page-facts")
    texts = distinct.select("_host", "_votes", F.explode("_texts").alias("t")).select("_host", "_votes", "t.*")
    unlike = [(F.bit_count(F.bit_or(F.get("_votes", F.lit(i)))) >= 3).cast("int") for i in range(_VOTES)]
    found = texts.groupBy("_host", "path", "scope", "key", "nth").agg(F.count("*").alias("n"), F.avg("place").alias("place"), F.min("shared").alias("shared"), F.max(F.when(F.col("hinted"), 0).otherwise(F.col("size"))).alias("size"), (2 * reduce(lambda a, b: a + b, unlike) >= _VOTES).alias("broad")).where("n >= 2")
    # Pages that have a scope: dealt by salt too, as a host's texts are many.
    scopes = distinct.select("_host", F.explode(F.array_distinct(F.concat(F.col("_texts.scope"), F.array(F.lit(_ALL))))).alias("scope")).groupBy("_host", "scope").agg(F.count("*").alias("of"))
    scopes = scopes.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    constant = found.withColumn("salt", F.pmod("key", F.lit(salts)).cast("int")).join(scopes, ["_host", "scope", "salt"]).where("2 * n >= of").withColumn("broad", F.col("broad") | F.expr("n >= 3 and 10 * n >= 9 * of"))
    constant = stored(constant.select("_host", "path", "key", "nth", "place", "shared", "broad", "n", "size"), "constant-texts")

    # Where the varying text lies: at each depth at most one path has 7 tenths of it.
    sizes = texts.groupBy("_host", "path").agg(F.sum(F.when(F.col("hinted"), 0).otherwise(F.col("size"))).alias("w")).union(constant.select("_host", "path", -F.col("n") * F.col("size")))
    sizes = sizes.groupBy("_host", "path").agg(F.sum("w").alias("w")).where("w > 0")
    labels = F.when(F.col("path") == "", F.array().cast("array<string>")).otherwise(F.split("path", _STEP))
    prefixes = sizes.withColumn("l", labels).select("_host", "w", F.explode(F.transform(F.sequence(F.lit(0), F.size("l")), lambda d: F.array_join(F.slice("l", F.lit(1), d), _STEP))).alias("prefix"))
    weights = prefixes.groupBy("_host", "prefix").agg(F.sum("w").alias("w"))
    total = weights.where("prefix = ''").select("_host", F.col("w").alias("total"))
    depth = F.when(F.col("prefix") == "", 0).otherwise(F.size(F.split("prefix", _STEP)))
    holders = sorted(t for t in BLOCKS if _container(t))
    tag = F.substring_index(F.substring_index("prefix", _STEP, -1), ".", 1)
    places = weights.join(total, "_host").where((F.col("w") >= 0.7 * F.col("total")) & ((F.col("prefix") == "") | tag.isin(holders)))
    places = places.groupBy("_host").agg(F.max_by("prefix", depth).alias("_place"))
    listed = constant.groupBy("_host").agg(F.collect_list(F.struct("path", "key", "nth", "place", "shared", "broad")).alias("_constant"))
    n_pages = distinct.groupBy("_host").agg(F.count("*").alias("_n"))
    both = n_pages.join(places, "_host", "left").join(listed, "_host", "left").select("_host", "_constant", "_place", "_n")
    return stored(both.mapInArrow(_wrappers, "_host string, _wrapper binary"), "wrappers")


def _extracted(schema: pa.Schema):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pickle

        known: dict[bytes | None, Wrapper] = {None: Wrapper()}
        for batch in text_batches(it):
            out = []
            for html, blob in zip(batch.column("_html").to_pylist(), batch.column("_wrapper").to_pylist(), strict=True):
                if blob not in known:
                    if len(known) > 500:
                        known = {None: Wrapper()}
                    known[blob] = wrapper_of(*pickle.loads(blob))
                out.append(extract(html, known[blob]))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(out, pa.string())], schema=schema)

    return run


def extract_articles(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Columns ``id_col``, ``url_col``, text (blocks joined by a newline, empty if none) and n_chars.

    All pages of a host make its wrapper. Null html is an empty page; null URLs, and URLs without a host,
    share one wrapper; repeated rows are extracted alike.
    """
    host = F.coalesce(F.lower(F.regexp_extract(F.col(url_col), r"://([^/?#]*)", 1)), F.lit(""))
    source = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"), F.col(html_col).alias("_html"), host.alias("_host"))
    joined = source.join(wrappers(source), "_host", "left").select("_id", "_url", "_html", "_wrapper")
    kept = joined.select("_id", "_url")
    arrow = to_arrow_schema(kept.schema).append(pa.field("text", pa.string()))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    out = joined.mapInArrow(_extracted(arrow), f"{kinds}, text string")
    return out.select(F.col("_id").alias(id_col), F.col("_url").alias(url_col), "text", F.length("text").cast("long").alias("n_chars"))


__all__ = ["Node", "Wrapper", "extract", "extract_articles", "induce", "main_place", "match", "parse"]
