"""Main text of web pages by wrapper induction.

Pages of a host share a template. The DOM trees of all different pages of a
host are aligned by simple tree matching. Nodes that are there, with the same
text, in nearly every page are template; nodes whose text differs are
slots. A page is then aligned with its host's wrapper: what meets a constant
node is dropped, and slots are content unless their element or class says that
they are page furniture (menus, adverts, comments and the like).

Plan: a page becomes its outline (labels and digests of texts), and outlines
are made different by a shuffle; html is not shuffled. Blocks of about
``BLOCK_PAGES`` outlines each are aligned to a partial wrapper, and partial wrappers are
aligned with each other, ``MERGE`` at a time, until a host has one, so no task
sees all pages of a host. Then every outline is aligned with its host's
candidate and the matches are counted, so what is constant is decided by
counts over all pages. Wrappers are a few KB each and are broadcast if they fit in
``BROADCAST_BYTES``, otherwise joined by a salted host; extraction is a
projection over the pages.
"""

from __future__ import annotations

import hashlib
import html as entities
import json
import re
from collections import Counter
from collections.abc import Callable, Iterable
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuator.session import cut_lineage

#: Pages that are aligned in one go, partial wrappers that are merged in one go, and the share of a host's pages that must agree on a constant node.
BLOCK_PAGES = 24
MERGE = 16
AGREE = 0.9
#: Share of a block's pages that a candidate needs: what AGREE of all pages have, some block has this often.
CANDIDATE = 0.5
#: A host with fewer different pages has no wrapper; its pages are judged by their elements alone.
LEAST_PAGES = 3
#: Lists of more children are aligned in numpy, by halves where their table has over LONG_CELLS cells, so that it is never held whole.
LONG_LIST, LONG_CELLS = 400, 1 << 22
BROADCAST_BYTES = 64 << 20

# Element kinds of the HTML standard, and usual names of page furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title xmp noembed noframes svg math".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
FURNITURE = frozenset("head nav header footer aside form script style noscript template iframe button select option textarea input label svg math canvas object embed audio video menu dialog fieldset title xmp noembed noframes".split())
FURNITURE_NAMES = re.compile(
    r"(?:^|[-_\s])(?:ad|ads|advert|adverts|advertisement|advertising|adsense|banner|sponsor|sponsored|promo|promotion|"
    r"nav|navbar|navigation|menu|menus|breadcrumb|breadcrumbs|sidebar|side|aside|header|masthead|topbar|footer|foot|"
    r"cookie|cookies|consent|gdpr|notice|notices|alert|popup|modal|overlay|toast|newsletter|subscribe|subscription|signup|login|"
    r"comment|comments|respond|replies|reply|disqus|discussion|share|sharing|social|related|recommended|more-posts|"
    r"widget|widgets|toolbar|pagination|pager|copyright|legal|skip-link|search|form)(?:$|[-_\s\d])", re.I)
OWN_PARTS = re.compile(r"(?:^|[-_\s])(?:article|post|entry|story|content)[-_](?:header|head|heading|title|body|text|content)(?:$|[-_\s])", re.I)
FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog".split())
# End of an open element implied by a start tag (HTML standard).
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
             "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "tbody"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"},
         "option": {"select"}, "tbody": {"table"}, "tfoot": {"table"}}

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
_ATTR = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_RAW_END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in RAW}


@lru_cache(maxsize=4096)
def _start(tag: str, rest: str) -> tuple[str, bool]:
    """Mark of a node by its class and id, and if it is furniture by these, its role or its element."""
    inside, role = "", ""
    if "=" in rest:
        names = {a[0].lower(): a[1] or a[2] or a[3] for a in _ATTR.findall(rest)}
        inside, role = " ".join((names.get("class", ""), names.get("id", ""))).strip(), names.get("role", "").lower()
    return inside.lower(), tag in FURNITURE or role in FURNITURE_ROLES or bool(
        inside and FURNITURE_NAMES.search(inside) and not OWN_PARTS.search(inside))


class Node:
    __slots__ = ("tag", "mark", "children", "furniture", "key")

    def __init__(self, tag: str, mark: str = "", furniture: bool = False):
        self.tag, self.mark, self.children, self.furniture, self.key = tag, mark, [], furniture, None


def parse(source: str | None) -> Node:
    """DOM tree; texts are children of type str. Unclosed and stray tags are mended as browsers do, roughly."""
    source = source or ""
    root = Node("#root")
    stack, at, raw_end = [root], 0, None
    for m in _TOKEN.finditer(source):
        if raw_end is not None and m.start() < raw_end:
            continue
        raw_end = None
        if m.start() > at:
            stack[-1].children.append(entities.unescape(source[at:m.start()]))
        at = m.end()
        slash, tag, rest = m.groups()
        if not tag:
            continue
        tag = tag.lower()
        if slash:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
                if stack[k].tag in ("td", "th", "table", "body") and tag in INLINE:
                    break
            continue
        if tag in CLOSES_P or tag in CLOSED_BY:
            _close(stack, tag)
        mark, furniture = _start(tag, rest)
        if tag == "header" and furniture and any(x.tag in ("article", "main") for x in stack) and not mark:
            furniture = False  # an article's own heading
        if tag in ("body", "html", "article", "main"):
            furniture = False
        node = Node(tag, mark, furniture)
        stack[-1].children.append(node)
        if tag in RAW:
            end = _RAW_END[tag].search(source, at)
            raw_end = at = end.end() if end else len(source)
            continue
        if tag not in VOID and not rest.endswith("/"):
            stack.append(node)
    if at < len(source):
        stack[-1].children.append(entities.unescape(source[at:]))
    return root


def _close(stack: list[Node], tag: str) -> None:
    if tag in CLOSES_P:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag == "p":
                del stack[k:]
                break
            if stack[k].tag not in INLINE:
                break
    closed, scope = CLOSED_BY.get(tag), SCOPE.get(tag, ())
    if not closed:
        return  # else every block would look through all that is open
    for k in range(len(stack) - 1, 0, -1):
        if stack[k].tag in closed:
            del stack[k:]
            break
        if stack[k].tag in scope:
            break


def _raw(node: Node | str) -> str:
    """All text below as it stands."""
    out: list[str] = []
    todo = [node]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            out.append(x)
        else:
            todo += reversed(x.children)
    return "".join(out)


def plain(node: Node | str) -> str:
    """All text below, white space collapsed."""
    return " ".join(_raw(node).split())


def elements(node: Node) -> list[Node]:
    return [c for c in node.children if not isinstance(c, str)]


def label(node: Node) -> str:
    return f"{node.tag}|{node.mark}"


def _matching(a: list, b: list, names_a: list[str], names_b: list[str], weight, weights=None, rows=None) -> list[tuple[int, int]]:
    """Order-keeping pairs of equal name of the two child lists with the largest total weight.

    ``weights`` may give the weights of one of ``a`` with all of ``b`` at a time, 0 for other names. ``rows`` makes
    the same as arrays, and tells pairs that no other can outweigh, for lists of more than ``LONG_LIST``.
    """
    place = {x: i for i, x in enumerate(names_a)}
    if len(place) == len(a) and len(set(names_b)) == len(b):
        met = [(place[x], j) for j, x in enumerate(names_b) if x in place]
        # each name once on both sides, and in one order: no pair stands in another's way
        if all(x[0] < y[0] for x, y in zip(met, met[1:])):
            return [(i, j) for i, j in met if weight(a[i], b[j])]
    if rows and (len(a) > LONG_LIST or len(b) > LONG_LIST):
        row, full = rows()
        return _long_matching(len(a), len(b), lambda i: row(a[i]), lambda i, j: full(a[i], j))
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    w: list[list[int]] = [[]] * len(a)
    for i in range(len(a) - 1, -1, -1):
        row, below, name, left = best[i], best[i + 1], names_a[i], a[i]
        w[i] = row_of = weights(left) if weights else [weight(left, y) if x == name else 0 for x, y in zip(names_b, b)]
        most = 0
        for j in range(len(b) - 1, -1, -1):
            if below[j] > most:
                most = below[j]
            x = row_of[j]
            if x and x + below[j + 1] > most:
                most = x + below[j + 1]
            row[j] = most
    return _walked(best, w, len(a), len(b))


def _walked(best, w, n: int, m: int) -> list[tuple[int, int]]:
    """The pairs of a table of largest weights, from its first row and column on."""
    i = j = 0
    out = []
    while i < n and j < m:
        if w[i][j] and best[i][j] == w[i][j] + best[i + 1][j + 1]:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif best[i][j] == best[i + 1][j]:
            i += 1
        else:
            j += 1
    return out


def _row_before(w: np.ndarray, below: np.ndarray) -> np.ndarray:
    """Row of the table of largest weights above ``below``; both end with the 0 of an empty list."""
    out = np.zeros_like(below)
    met = np.maximum(below[:-1], np.where(w > 0, w + below[1:], 0))
    out[:-1] = np.maximum.accumulate(met[::-1])[::-1]
    return out


def _long_matching(n: int, m: int, row: Callable[[int], np.ndarray], full: Callable[[int, int], bool]) -> list[tuple[int, int]]:
    """``_matching`` of long lists, a row of the table at a time: halves of the first list meet where their weights add up to most.

    Ends that match in ``full`` weight go first, as no other pair of theirs weighs more."""
    out, todo = [], [(0, n, 0, m)]
    while todo:
        i, i_end, j, j_end = todo.pop()
        while i < i_end and j < j_end and full(i, j):
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < i_end and j < j_end and full(i_end - 1, j_end - 1):
            i_end, j_end = i_end - 1, j_end - 1
            out.append((i_end, j_end))
        high, wide = i_end - i, j_end - j
        if not high or not wide:
            continue
        if high * wide <= LONG_CELLS:
            best, w = np.zeros((high + 1, wide + 1), np.int64), [row(x)[j:j_end] for x in range(i, i_end)]
            for x in range(high - 1, -1, -1):
                best[x] = _row_before(w[x], best[x + 1])
            out += [(i + x, j + y) for x, y in _walked(best, w, high, wide)]
        elif high == 1:
            w = row(i)[j:j_end]
            if w.any():
                out.append((i, j + int(w.argmax())))
        else:
            middle = i + high // 2
            after = np.zeros(wide + 1, np.int64)
            for x in range(i_end - 1, middle - 1, -1):
                after = _row_before(row(x)[j:j_end], after)
            # the same from the front, on the lists turned round
            before = np.zeros(wide + 1, np.int64)
            for x in range(i, middle):
                before = _row_before(row(x)[j:j_end][::-1], before)
            cut = j + int((before[::-1] + after).argmax())
            todo += [(i, middle, j, cut), (middle, i_end, cut, j_end)]
    return sorted(out)


class _Rows:
    """Weights of one node with all nodes of a long list at a time, as ``_part_score`` has them."""

    def __init__(self, names: list[str], below: Iterable[Iterable[str]], texts: Iterable[Iterable[str]]):
        self.of = list(zip(names, map(frozenset, below)))
        self.texts = [frozenset(x) for x in texts]
        kinds = {x: i for i, x in enumerate(dict.fromkeys(self.of))}
        self.kind, self.kinds = np.array([kinds[x] for x in self.of], dtype=np.int64), len(kinds)
        self.named: dict[str, list] = {}
        for (name, names_below), i in kinds.items():
            self.named.setdefault(name, []).append((i, names_below))
        places: dict[str, list[int]] = {}
        for j, x in enumerate(self.texts):
            for t in x:
                places.setdefault(t, []).append(j)
        self.places = {t: np.array(x) for t, x in places.items()}

    def row(self, name: str, below: Iterable[str], texts: Iterable[str]) -> np.ndarray:
        of_kind, own = np.zeros(self.kinds, np.int64), frozenset(below)
        for i, other in self.named.get(name, ()):
            of_kind[i] = 1 + min(len(own & other), 8)
        out = of_kind[self.kind]
        same = np.zeros(len(out), bool)
        for t in texts:
            if t in self.places:
                same[self.places[t]] = True
        return out + 8 * (same & (out > 0))

    def full(self, name: str, below: Iterable[str], texts: Iterable[str], j: int) -> bool:
        return self.of[j] == (name, frozenset(below)) and not self.texts[j].isdisjoint(texts)


def _digest_of(text: str) -> str:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=9).hexdigest()


def digest(node: Node) -> str:
    return _digest_of(plain(node))


def _collapsed(raw: str) -> str:
    """White space collapsed, a space at the edges that have some."""
    inner = " ".join(raw.split())
    if not inner:
        return " " if raw else ""
    return (" " if raw[0].isspace() else "") + inner + (" " if raw[-1].isspace() else "")


def _folded(root, below: Callable, make: Callable):
    """``make(x, made)`` of the root, ``made`` being those of ``below(x)`` in order; ``below`` is asked from the root down. Pages nest without a limit, so nothing recurs."""
    stack = [(root, iter(below(root)), [])]
    while True:
        x, rest, made = stack[-1]
        for kid in rest:
            stack.append((kid, iter(below(kid)), []))
            break
        else:
            stack.pop()
            value = make(x, made)
            if not stack:
                return value
            stack[-1][2].append(value)


def _packed(tree: list) -> str:
    """JSON of a tree of [fields, nodes below], as flat as can be: a node and how many are below, in order of a walk."""
    out, todo = [], [tree]
    while todo:
        x = todo.pop()
        out.append([*x[:-1], len(x[-1])])
        todo += reversed(x[-1])
    return json.dumps(out, separators=(",", ":"))


def _unpacked(text: str) -> list:
    nodes = json.loads(text)
    waiting: list = []
    for x in nodes:
        if waiting:
            waiting.pop().append(x)
        n, x[-1] = x[-1], []
        waiting += [x[-1]] * n
    return nodes[0]


def outline(node: Node) -> list:
    """[label, digest of the text, outlines of the elements below]. Furniture has none below: nothing of it becomes text, whatever its wrapper says."""
    return _folded(node, _pieces, _outlined)[0]


def _pieces(node: Node | str) -> list:
    return [] if isinstance(node, str) else [_raw(node)] if node.furniture else node.children


def _outlined(node: Node | str, made: list) -> tuple[list | None, str]:
    """The outline and the text, white space collapsed once on the way up; a space at the edges that have some."""
    if isinstance(node, str):
        return None, _collapsed(node)
    kids = [x for x, _ in made if x is not None]
    if len(made) == 1 and kids:  # no text of its own
        return [label(node), kids[0][1], kids], made[0][1]
    text = "".join([x for _, x in made])
    while "  " in text:
        text = text.replace("  ", " ")
    return [label(node), _digest_of(text.strip(" ")), kids], text


class Part:
    """A node of a wrapper: its label, how many pages have it, their texts by digest, and its parts."""

    __slots__ = ("label", "pages", "texts", "parts", "names")

    def __init__(self, label: str, pages: int = 0, texts: dict[str, int] | None = None, parts: list | None = None):
        self.label, self.pages, self.texts, self.parts = label, pages, texts if texts is not None else {}, parts or []
        self.names = [x.label for x in self.parts]


def _as_part(page: list) -> Part:
    return _folded(page, lambda x: x[2], lambda x, parts: Part(x[0], 1, {x[1]: 1}, parts))


def absorb(part: Part, other: Part) -> None:
    """Align another page, or another partial wrapper, with a part by simple tree matching, and add its counts."""
    todo = [(part, other)]
    while todo:
        part, other = todo.pop()
        part.pages += other.pages
        for t, n in other.texts.items():
            part.texts[t] = part.texts.get(t, 0) + n
        if not other.parts:
            continue
        pairs = dict((j, i) for i, j in _matching(part.parts, other.parts, part.names, other.names, _part_score, _part_scores(other), _part_rows(other)))
        out, done = [], 0
        for j, kid in enumerate(other.parts):
            if j in pairs:
                out += part.parts[done:pairs[j] + 1]
                done = pairs[j] + 1
                todo.append((part.parts[pairs[j]], kid))
            else:
                out.append(kid)
        part.parts = out + part.parts[done:]
        part.names = [x.label for x in part.parts]


def _part_score(part: Part, other: Part) -> int:
    """Weight of a match of one label: 1, more if the children's labels or the whole text agree."""
    same = 0 if part.texts.keys().isdisjoint(other.texts) else 8
    if not part.names or not other.names:
        return 1 + same
    return 1 + min(len({*part.names} & {*other.names}), 8) + same


def _part_scores(other: Part):
    """``_part_score`` of one part with all parts of ``other`` at a time, 0 for other labels."""
    tables: list = []

    def scores(part: Part) -> list[int]:
        if not tables:
            by_text: dict[str, list[int]] = {}
            for j, x in enumerate(other.parts):
                for t in x.texts:
                    by_text.setdefault(t, []).append(j)
            tables[:] = [by_text, [{*x.names} for x in other.parts]]
        by_text, below = tables
        if part.names:
            own = {*part.names}
            out = [1 + min(len(own & y), 8) if x == part.label else 0 for x, y in zip(other.names, below)]
        else:
            out = [1 if x == part.label else 0 for x in other.names]
        for j in {j for t in part.texts.keys() & by_text.keys() for j in by_text[t]}:
            if out[j]:
                out[j] += 8
        return out

    return scores


def _part_rows(other: Part):
    """The same as arrays, for long lists."""
    def rows():
        r = _Rows(other.names, [x.names for x in other.parts], [x.texts for x in other.parts])
        return (lambda x: r.row(x.label, x.names, x.texts)), (lambda x, j: r.full(x.label, x.names, x.texts, j))

    return rows


def _fold(parts: list[Part]) -> Part:
    """One partial wrapper of all; what fewer than ``CANDIDATE`` of its pages have goes."""
    root = parts[0]
    for other in parts[1:]:
        absorb(root, other)

    def keep(part: Part, kept: list[Part]) -> Part:
        return Part(part.label, part.pages, {t: n for t, n in part.texts.items() if n >= CANDIDATE * part.pages}, kept)

    return _folded(root, lambda part: [x for x in part.parts if x.pages >= CANDIDATE * root.pages], keep)


def _dump(part: Part) -> list:
    return _folded(part, lambda x: x.parts, lambda x, below: [x.label, x.pages, x.texts, below])


def _load(x: list) -> Part:
    return _folded(x, lambda x: x[3], lambda x, parts: Part(x[0], x[1], x[2], parts))


def _candidate(part: Part) -> list:
    """[label, likeliest text or None, parts], as counted by ``matches``."""
    return _folded(part, lambda x: x.parts, lambda x, below: [x.label, max(x.texts, key=x.texts.__getitem__) if x.texts else None, below])


def _numbers(candidate: list) -> dict[int, int]:
    """Number of each node (by ``id``) in order of a walk from the root."""
    out, todo = {}, [candidate]
    while todo:
        x = todo.pop()
        out[id(x)] = len(out)
        todo += reversed(x[2])
    return out


def matches(candidate: list, page: list, numbers: dict[int, int] | None = None) -> list[tuple[int, bool]]:
    """Numbers (in order of a walk from the root) of the candidate's nodes that the page has, and if the text is the same."""
    numbers = numbers or _numbers(candidate)

    def score(c: list, p: list) -> int:
        same = 8 if c[1] == p[1] else 0
        return 1 + min(len({x[0] for x in c[2]} & {x[0] for x in p[2]}), 8) + same if c[2] and p[2] else 1 + same

    def rows_of(kids: list):
        def rows():
            r = _Rows([x[0] for x in kids], [[y[0] for y in x[2]] for x in kids], [[x[1]] for x in kids])
            return (lambda c: r.row(c[0], [y[0] for y in c[2]], [c[1]])), (lambda c, j: r.full(c[0], [y[0] for y in c[2]], [c[1]], j))
        return rows

    out, todo = [], [(candidate, page)]
    while todo:
        c, p = todo.pop()
        out.append((numbers[id(c)], c[1] == p[1]))
        if c[2] and p[2]:
            pairs = _matching(c[2], p[2], [x[0] for x in c[2]], [x[0] for x in p[2]], score, None, rows_of(p[2]))
            todo += [(c[2][i], p[2][j]) for i, j in reversed(pairs)]
    return out


def _constants(candidate: list, counts: dict[int, tuple[int, int]], pages: int) -> str | None:
    """Wrapper as JSON: nodes that nearly all pages have with one text, and the nodes that lead to them."""
    numbers = _numbers(candidate)

    def constant(x: list, below: list) -> list | None:
        had, same = counts.get(numbers[id(x)], (0, 0))
        if x[1] is not None and had >= AGREE * pages and same >= AGREE * had:
            return [x[0], x[1], []]
        kept = [y for y in below if y]
        return [x[0], None, kept] if kept else None

    # an article that all pages share is no template: then nothing tells content from frame
    tree = _folded(candidate, lambda x: x[2], constant)
    return _packed(tree) if tree and tree[1] is None else None


def learn(pages: list[str]) -> str | None:
    """Wrapper of a host as JSON, from different pages; None if there are too few."""
    pages = sorted(set(pages))
    if len(pages) < LEAST_PAGES:
        return None
    outlines = [outline(parse(p)) for p in pages]
    candidate = _candidate(_fold([_as_part(x) for x in outlines]))
    numbers = _numbers(candidate)
    had, same = Counter(), Counter()
    for x in outlines:
        for at, equal in matches(candidate, x, numbers):
            had[at] += 1
            same[at] += equal
    return _constants(candidate, {i: (n, same[i]) for i, n in had.items()}, len(pages))


def _drop_template(node: Node, part: list) -> None:
    """Mark the children of ``node`` that meet a constant node of the wrapper."""
    def of(k: Node) -> str:
        if k.key is None:
            k.key = digest(k)
        return k.key

    def score(p: list, k: Node) -> int:
        return 2 if p[1] is None or p[1] == of(k) else 0

    def rows_of(kids: list[Node], names: list[str]):
        def rows():
            code = {x: i for i, x in enumerate(dict.fromkeys(names))}
            name, text = np.array([code[x] for x in names]), np.array([of(k) for k in kids])

            def row(p: list) -> np.ndarray:
                same = name == code.get(p[0], -1)
                return 2 * (same if p[1] is None else same & (text == p[1]))
            return row, lambda p, j: p[0] == names[j] and p[1] in (None, text[j])
        return rows

    todo = [(node, part)]
    while todo:
        node, part = todo.pop()
        kids = elements(node)
        if not part[2] or not kids:
            continue
        names = [label(x) for x in kids]
        for i, j in _matching(part[2], kids, [x[0] for x in part[2]], names, score, None, rows_of(kids, names)):
            if kids[j].tag in ("article", "main"):
                continue  # all of it is content, also what other pages say as well
            if part[2][i][1] is None:
                todo.append((kids[j], part[2][i]))
            elif kids[j].tag not in ("body", "html"):
                kids[j].furniture = True


@lru_cache(maxsize=16)
def _wrapper(text: str) -> list:
    return _unpacked(text)


def main_text(source: str | None, wrapper: str | None = None) -> str:
    """Text of the content nodes: blocks in page order, joined by one space."""
    root = parse(source)
    if wrapper:
        _drop_template(root, _wrapper(wrapper))
    top = _content_roots(root)
    out: list[str] = []
    for node in top:
        _blocks(node, out)
    return " ".join("".join(out).split())


def _content_roots(root: Node) -> list[Node]:
    """The outermost article or main elements that hold text outside furniture; the whole page if there is none."""
    found, todo = [], [root]
    while todo:
        x = todo.pop()
        if x.furniture:
            continue
        if x.tag in ("article", "main"):
            found.append(x)
            continue
        todo += reversed(elements(x))
    found = [x for x in found if _has_text(x)]
    return found or [root]


def _has_text(node: Node) -> bool:
    out: list[str] = []
    _blocks(node, out)
    return any(not x.isspace() for x in out if x)


def _blocks(node: Node, out: list[str]) -> None:
    """Append the texts below, a space at each edge of a block and at a line break."""
    todo: list = [node]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            out.append(x)
        elif x.furniture:
            out.append("" if x.tag in INLINE else " ")
        elif x.tag in INLINE:
            todo += reversed(x.children)
        else:
            out.append(" ")
            todo.append(" ")
            todo += reversed(x.children)


def host_of(url: str) -> F.Column:
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1))


def wrappers(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """host, wrapper (null if nothing is constant) of the hosts with ``LEAST_PAGES`` different pages, learnt from all of them."""
    @F.pandas_udf("string")
    def outline_of(sources: pd.Series) -> pd.Series:
        return pd.Series([_packed(outline(parse(x))) for x in sources], dtype=object)

    rows = pages.select(host_of(url).alias("host"), F.xxhash64(html).alias("h"), F.col(html).alias("html")).filter(F.col("html").isNotNull())
    # each page's first copy in its partition is outlined, each host's first copy of it stays
    different = cut_lineage(rows.withColumn("outline", outline_of("html")).groupBy("host", "h").agg(F.min("outline").alias("outline")))
    sizes = different.groupBy("host").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= LEAST_PAGES)
    blocks = F.ceil(F.col("n") / BLOCK_PAGES)
    # not by a join on the host alone: its rows would meet in one task, and stay there for all its blocks
    placed = _with_host(different.withColumn("salt", F.col("h")), sizes, "n", "inner").withColumn("block", F.pmod(F.xxhash64(F.lit("block"), "h"), blocks))

    def align(load):
        def fold(group: pd.DataFrame) -> pd.DataFrame:
            group = group.sort_values("at")
            part = _fold([load(_unpacked(x)) for x in group["part"]])
            return pd.DataFrame({"host": group["host"].iloc[:1], "block": group["block"].iloc[:1], "part": [_packed(_dump(part))]})
        return fold

    schema = "host string, block long, part string"
    parts = cut_lineage(placed.select("host", "block", F.col("h").alias("at"), F.col("outline").alias("part"))
                        .groupBy("host", "block").applyInPandas(align(_as_part), schema))
    left = parts.agg(F.max("block").alias("b")).first()["b"] or 0
    while left:
        merged = parts.select("host", F.col("block").alias("at"), F.floor(F.col("block") / MERGE).alias("block"), "part")
        parts = cut_lineage(merged.groupBy("host", "block").applyInPandas(align(_load), schema))
        left //= MERGE

    @F.pandas_udf("string")
    def candidate_of(found: pd.Series) -> pd.Series:
        return pd.Series([_packed(_candidate(_load(_unpacked(x)))) for x in found], dtype=object)

    candidates = cut_lineage(parts.select("host", candidate_of("part").alias("candidate")).join(sizes, "host"))

    def count(batches):
        for b in batches:
            seen: dict[str, list] = {}
            total: Counter = Counter()
            for host, page, candidate in zip(b["host"], b["outline"], b["candidate"]):
                if host not in seen:
                    tree = _unpacked(candidate)
                    seen[host] = tree, _numbers(tree)
                tree, numbers = seen[host]
                for at, equal in matches(tree, _unpacked(page), numbers):
                    total[host, at, equal] += 1
            yield pd.DataFrame([(h, at, n, n if equal else 0) for (h, at, equal), n in total.items()], columns=["host", "at", "had", "same"])

    counted = (_with_host(different.select("host", "outline", F.col("h").alias("salt")), candidates.select("host", "candidate"), "candidate", "inner")
               .select("host", "outline", "candidate").mapInPandas(count, "host string, at int, had long, same long")
               .groupBy("host", "at").agg(F.sum("had").alias("had"), F.sum("same").alias("same"))
               .groupBy("host").agg(F.collect_list(F.struct("at", "had", "same")).alias("counts")))

    @F.pandas_udf("string")
    def wrapper_of(found: pd.Series, counts: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([_constants(_unpacked(c), {x["at"]: (x["had"], x["same"]) for x in k}, m) for c, k, m in zip(found, counts, n)], dtype=object)

    return candidates.join(counted, "host").select("host", wrapper_of("candidate", "counts", "n").alias("wrapper"))


def _with_host(rows: DataFrame, state: DataFrame, text: str, how: str) -> DataFrame:
    """``rows`` with their host's state: by broadcast if it is small, else by host and a part of the row's salt, so that a large host is many tasks' work."""
    size = state.agg(F.sum(F.length(F.col(text).cast("string")) + F.length("host"))).first()[0] or 0
    if size <= BROADCAST_BYTES:
        return rows.join(F.broadcast(state), "host", how)
    salts = 64
    spread = state.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return rows.withColumn("_salt", F.pmod(F.xxhash64("salt"), F.lit(salts)).cast("int")).join(spread, ["host", "_salt"], how).drop("_salt")


def extract(pages: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per page: id, url, text (empty if there is none), has_wrapper.

    A null html counts as empty; a null url, or one without a host, is of the
    host '' and shares a wrapper with its like. Repeated pages count once when
    a wrapper is learnt, so copies of one page do not turn it into template.
    Pages of hosts with fewer than ``LEAST_PAGES`` different pages are judged
    by their elements and class names alone. Other columns are not read.
    """
    learnt = cut_lineage(wrappers(pages, url, html).filter("wrapper IS NOT NULL"))
    @F.pandas_udf("string")
    def text_of(sources: pd.Series, wraps: pd.Series) -> pd.Series:
        return pd.Series([main_text(s, w) for s, w in zip(sources, wraps)], dtype=object)

    rows = pages.select(F.col(id_col).alias("id"), F.col(url).alias("url"), F.col(html).alias("html"), host_of(url).alias("host"))
    both = _with_host(rows.withColumn("salt", F.xxhash64("id", "url")), learnt, "wrapper", "left")
    return both.select(F.col("id").alias(id_col), F.col("url").alias(url), text_of("html", "wrapper").alias("text"),
                       F.col("wrapper").isNotNull().alias("has_wrapper"))
