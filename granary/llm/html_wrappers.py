"""Main text of web pages by wrappers inferred from the pages of each host.

A page's token stream is read as block elements, text slots and links.  Its union-free regular expression has one node for
each path of labels; the children of a node are a sequence in which a stretch where labels recur is one repeated group,
``(p? ul?)+``, and what some instances lack is optional.  Expressions are aligned one after the other: common labels in
their longest common order are anchors, a label that only one side has becomes optional, a label that stands on different
sides of an anchor makes the stretch between a repeated group.  Each task aligns its own pages as they come, partial wrappers
of a host are aligned in buckets, then the buckets' results, so no task holds the pages of a hot host.

Text resolves slots: a text that stands in the same slot on most different pages of a host (copies of a page count once) is
template; what differs from page to page is data.  The wrapper, with data and link characters by node, then says where the
main text is: in article elements, else in the main element, else in the innermost container with nearly all data, and the
headings that vary beside it.  Left out are navigation, headers, footers, asides and forms; template texts; outside articles
groups that hold hardly anything but links; and elements whose class or id as a whole names boilerplate, unless the wrapper
finds most of the data in them.
"""

from __future__ import annotations

import html
import json
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.session import forget, small_batches, written

#: Elements whose content is no text of the page, elements of forms, blocks, and blocks that are boilerplate.
RAW = frozenset("script style noscript template textarea iframe title".split())
CONTROLS = frozenset("select button datalist".split())
BLOCKS = frozenset(
    "html head body article section main nav aside header footer div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption thead tbody tfoot tr"
    " blockquote pre figure figcaption form fieldset address details summary dialog menu center".split()
)
BOILERPLATE = frozenset("head nav header footer aside form dialog menu fieldset".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CONTAINERS = frozenset("html body div section main center table thead tbody tr blockquote ul ol li dl dd article".split())
#: Words of a class or id that name boilerplate, and words that say nothing beside those.
BOILERPLATE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising banner sponsor sponsored promo promotion nav navbar navigation menu"
    " breadcrumb breadcrumbs header masthead footer sidebar aside widget widgets cookie cookies consent gdpr notice notices alert popup modal"
    " overlay newsletter subscribe signup login search form comment comments disqus reply replies share sharing social pagination pager"
    " toolbar".split()
)
NEUTRAL_WORDS = frozenset("site page top bottom left right main global primary secondary box container wrapper wrap block list bar area the inner outer".split())
BAD_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog".split())
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}}

#: A text is template if it stands in a slot on at least this many different pages of a host, and on this share of those
#: that have the slot; but if the main text were template by more than the last share, the pages are near copies: none is.
TEMPLATE_PAGES, TEMPLATE_SHARE, TEMPLATE_LIMIT = 3, 0.5, 0.75
#: A container is entered if it holds this share of the data; a group is a menu if this share of its characters are links.
CONTAINER_SHARE, MENU_SHARE = 0.8, 0.8
#: If names of boilerplate would leave less than this share of the data, those of them that hold most of it are wrong.
ELSEWHERE = 0.05
#: Nodes of wrappers that a task holds before it passes them on.
HELD_NODES = 200_000

_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?>=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+)>|<[!?][^>]*>|<(?=[a-zA-Z/!?])[^>]*\Z", re.S
)
_NAMED = re.compile(r"(?:^|[\s\"'])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_ENDS = {t: re.compile(rf"</{t}\b[^>]*>?", re.I) for t in RAW | CONTROLS}
_MASK = (1 << 64) - 1
_label_hashes: dict[str, int] = {}
_labels: dict[tuple[str, str], str] = {}


def _hash(s: str) -> int:
    return xxhash.xxh3_64_intdigest(s.encode("utf-8", "surrogatepass"))


def _below(path: int, label: str) -> int:
    """Hash of the path that goes on with a label."""
    own = _label_hashes.get(label)
    if own is None:
        if len(_label_hashes) > 100_000:
            _label_hashes.clear()
        own = _label_hashes[label] = _hash(label)
    x = (path * 0x9E3779B97F4A7C15 + own) & _MASK
    return ((x ^ x >> 29) * 0xBF58476D1CE4E5B9) & _MASK


def _label(tag: str, attributes: str) -> str:
    """Tag with its class and id names that hold no digit; ``!`` ends what is boilerplate by tag or role, ``?`` by name."""
    found = _labels.get((tag, attributes))
    if found is not None:
        return found
    kind, names = tag, set()
    hard, soft = tag in BOILERPLATE, False
    for key, *values in _NAMED.findall(attributes):
        for name in "".join(values).split():
            if key.lower() == "role":
                hard = hard or name.lower() in BAD_ROLES
                kind = name.lower() if name.lower() in ("main", "article") else kind
                continue
            words = [w.lower() for w in _WORD.findall(name)]
            soft = soft or bool(BOILERPLATE_WORDS & set(words)) and all(w in BOILERPLATE_WORDS or w in NEUTRAL_WORDS or w.isdigit() for w in words)
            if not any(c.isdigit() for c in name):
                names.add(name.lower().replace(".", "-"))
    if tag in ("html", "body", "main") or tag in HEADINGS:
        hard = soft = False
    out = ".".join([kind, *sorted(names)]) + ("!" if hard else "?" if soft else "")
    if len(_labels) > 20_000:
        _labels.clear()
    _labels[tag, attributes] = out
    return out


class Page:
    """Block elements of a page in page order, and its blocks of text.

    Element ``i`` has ``labels[i]``, ``parents[i]`` (before it) and ``paths[i]``, a hash of the labels down to it; 0 is the
    root.  ``items`` are (element, text, inside a link) in page order; a text of None ends a block.
    """

    __slots__ = ("labels", "parents", "paths", "items")

    def __init__(self, source: str):
        self.labels, self.parents, self.paths = [""], [-1], [0]
        self.items: list[tuple[int, str | None, bool]] = []
        self._read(source)

    def _read(self, source: str) -> None:
        items, labels, parents, paths = self.items, self.labels, self.parents, self.paths
        stack, tags = [0], [""]
        opened: Counter = Counter()
        links = False
        at = 0

        def cut(n: int) -> None:
            for t in tags[n:]:
                opened[t] -= 1
            del stack[n:], tags[n:]
            items.append((stack[-1], None, False))

        while True:
            m = _TOKEN.search(source, at)
            if text := source[at : m.start() if m else len(source)]:
                items.append((stack[-1], text, links))
            if not m:
                return
            at = m.end()
            if not m[2]:
                continue
            tag = m[2].lower()
            if m[1]:
                if tag == "a":
                    links = False
                elif opened[tag] > 0:
                    n = len(tags) - 1
                    while tags[n] != tag:
                        n -= 1
                    cut(n)
                    links = False
            elif tag in _ENDS:
                if not m[3].rstrip().endswith("/"):
                    end = _ENDS[tag].search(source, at)
                    at = end.end() if end else at if tag in CONTROLS else len(source)
            elif tag == "a":
                links = True
            elif tag in BLOCKS:
                if tag in CLOSES:
                    for n in range(len(tags) - 1, 0, -1):
                        if tags[n] in CLOSES[tag]:
                            cut(n)
                            break
                        if tags[n] != "p" and tags[n] not in HEADINGS:
                            break
                elif tags[-1] == "p":
                    cut(len(tags) - 1)
                label = _label(tag, m[3])
                paths.append(_below(paths[stack[-1]], label))
                labels.append(label)
                parents.append(stack[-1])
                stack.append(len(labels) - 1)
                tags.append(tag)
                opened[tag] += 1
                items.append((stack[-1], None, False))
                links = False
            elif tag == "hr":
                if tags[-1] == "p":
                    cut(len(tags) - 1)
                items.append((stack[-1], None, False))
            elif tag in ("br", "td", "th"):
                items.append((stack[-1], " ", links))

    def hard(self) -> list[bool]:
        """Whether each element is boilerplate by tag or role, or inside such a one; an article's header with a heading isn't."""
        headed = {self.parents[i] for i, label in enumerate(self.labels) if _tag(label) in HEADINGS}
        out, inside = [False], [False]
        for i in range(1, len(self.labels)):
            label, p = self.labels[i], self.parents[i]
            own = label.endswith("!") and not (inside[p] and i in headed and _tag(label) == "header")
            out.append(out[p] or own)
            inside.append(inside[p] or _tag(label) == "article")
        return out

    def blocks(self, skip: list[bool]) -> Iterator[tuple[int, str]]:
        """Element and line of each block outside the skipped elements."""
        at, pieces = 0, []
        for i, text, _ in [*self.items, (-1, None, False)]:
            if (text is None or i != at) and pieces:
                if line := " ".join(html.unescape("".join(pieces)).split()):
                    yield at, line
                pieces = []
            at = i
            if text is not None and not skip[i]:
                pieces.append(text)


def _tag(label: str) -> str:
    return label.partition(".")[0].rstrip("!?")


# -- expressions ---------------------------------------------------------------------------------------------------------

#: The children of a node: their labels in order, those that are optional, and repeated groups as first and last places.
Sequence = tuple[tuple[str, ...], frozenset[str], tuple[tuple[int, int], ...]]


def _grouped(labels: list[str], optional: frozenset[str], spans: list[tuple[int, int]]) -> Sequence:
    """The sequence of labels that may recur: the stretch from a label's first to its last place is in one group."""
    first: dict[str, int] = {}
    last: dict[str, int] = {}
    for k, x in enumerate(labels):
        first.setdefault(x, k)
        last[x] = k
    groups: list[list[int]] = []
    for low, high in sorted([*spans, *((first[x], last[x]) for x in first if last[x] > first[x])]):
        if groups and low <= groups[-1][1]:
            groups[-1][1] = max(groups[-1][1], high)
        else:
            groups.append([low, high])
    order = list(first)
    starts = list(first.values())
    out = []
    for low, high in groups:
        # a label's other places are in its group, so the group's labels are those that first stand in it
        out.append((bisect_left(starts, low), bisect_left(starts, high + 1) - 1))
    return tuple(order), optional, tuple(out)


def align(a: Sequence, b: Sequence) -> Sequence:
    """The sequence that matches what either of two matches."""
    if a == b:
        return a
    at = {x: k for k, x in enumerate(b[0])}
    common = [(k, at[x]) for k, x in enumerate(a[0]) if x in at]
    tails: list[int] = []  # longest increasing run of places in b
    ends: list[int] = []
    back = [-1] * len(common)
    for k, (_, j) in enumerate(common):
        p = bisect_left(tails, j)
        tails[p : p + 1] = [j]
        ends[p : p + 1] = [k]
        back[k] = ends[p - 1] if p else -1
    anchors: list[tuple[int, int]] = []
    k = ends[-1] if ends else -1
    while k >= 0:
        anchors.append(common[k])
        k = back[k]
    labels: list[str] = []
    place_a, place_b = [0] * len(a[0]), [0] * len(b[0])
    i = j = 0
    for x, y in [*reversed(anchors), (len(a[0]), len(b[0]))]:
        for k in range(i, x):
            place_a[k] = len(labels)
            labels.append(a[0][k])
        for k in range(j, y):
            place_b[k] = len(labels)
            labels.append(b[0][k])
        if x < len(a[0]):
            place_a[x] = place_b[y] = len(labels)
            labels.append(a[0][x])
        i, j = x + 1, y + 1
    spans = [(place[low], place[high]) for place, groups in ((place_a, a[2]), (place_b, b[2])) for low, high in groups]
    return _grouped(labels, a[1] | b[1] | (set(a[0]) ^ set(b[0])), spans)


class Node:
    """A path of labels: its pages, characters of text and of links that stand in it, and what its instances hold."""

    __slots__ = ("parent", "label", "pages", "plain", "links", "kids")

    def __init__(self, parent: int, label: str):
        self.parent, self.label = parent, label
        self.pages = self.plain = self.links = 0
        self.kids: Sequence | None = None


class Wrapper:
    """The union-free expression of some pages of one host, by path; a node stands after its parent."""

    def __init__(self):
        self.nodes: dict[int, Node] = {0: Node(-1, "")}
        self.pages = 0

    def add(self, page: Page) -> None:
        """Align one more page."""
        self.pages += 1
        hard = page.hard()
        inner: list[list[str]] = [[] for _ in page.labels]
        for i in range(1, len(page.labels)):
            if not hard[page.parents[i]]:
                inner[page.parents[i]].append(page.labels[i])
        seen: set[int] = set()
        slots: dict[int, list[int]] = {}
        for i, text, link in page.items:
            if text is not None and not hard[i] and (n := len(text.strip())):
                slots.setdefault(i, [0, 0])[link] += n
        for i, path in enumerate(page.paths):
            if i and hard[page.parents[i]]:
                continue
            node = self.nodes.get(path)
            if node is None:
                node = self.nodes[path] = Node(page.paths[page.parents[i]], page.labels[i])
            if path not in seen:
                seen.add(path)
                node.pages += 1
            if own := slots.get(i):
                node.plain += own[0]
                node.links += own[1]
                inner[i].append("#" if own[0] else "@")
            if not hard[i]:
                kids = _grouped(inner[i], frozenset(), [])
                node.kids = kids if node.kids is None else align(node.kids, kids)

    def merge(self, other: Wrapper) -> None:
        """Align with the wrapper of other pages."""
        self.pages += other.pages
        for path, b in other.nodes.items():
            a = self.nodes.get(path)
            if a is None:
                a = self.nodes[path] = Node(b.parent, b.label)
            a.pages, a.plain, a.links = a.pages + b.pages, a.plain + b.plain, a.links + b.links
            a.kids = align(a.kids, b.kids) if a.kids and b.kids else a.kids or b.kids

    def dumps(self) -> str:
        rows = []
        for path, n in self.nodes.items():
            order, optional, groups = n.kids or ((), (), ())
            rows.append([path, n.parent, n.label, n.pages, n.plain, n.links, order, sorted(optional), groups, n.kids is not None])
        return json.dumps([self.pages, rows])

    @staticmethod
    def loads(s: str) -> Wrapper:
        out = Wrapper()
        out.pages, rows = json.loads(s)
        for path, parent, label, pages, plain, links, order, optional, groups, read in rows:
            n = out.nodes[path] = Node(parent, label)
            n.pages, n.plain, n.links = pages, plain, links
            if read:
                n.kids = tuple(order), frozenset(optional), tuple(map(tuple, groups))
        return out

    def expression(self) -> str:
        """The wrapper as a regular expression over labels; # is a text slot, @ one of links only."""
        out: list[str] = []
        todo: list = [("node", 0, "")]
        while todo:
            kind, path, mark = todo.pop()
            if kind == "text":
                out.append(mark)
                continue
            n = self.nodes[path]
            out.append(n.label)
            order, optional, groups = n.kids or ((), frozenset(), ())
            steps: list = [("text", 0, "(")] if order else []
            for k, x in enumerate(order):
                many = next((g for g in groups if g[0] <= k <= g[1]), None)
                if k:
                    steps.append(("text", 0, " "))
                if many and k == many[0]:
                    steps.append(("text", 0, "["))
                steps.append(("text", 0, x) if x in "#@" else ("node", _below(path, x), ""))
                if x in optional or many and many[0] < many[1]:
                    steps.append(("text", 0, "?"))
                if many and k == many[1]:
                    steps.append(("text", 0, "]+"))
            if order:
                steps.append(("text", 0, ")"))
            todo += reversed(steps)
        return "".join(out)


def plan(wrapper: Wrapper, templates: list[tuple[int, int, int, int]] = ()) -> dict:
    """Where the main text is: paths of main elements, paths to leave out, template texts.

    ``templates`` are (path, text, pages, characters).  Only sums by path are used, so the order of alignment is no matter.
    """
    nodes = wrapper.nodes
    children: dict[int, list[int]] = {}
    for path, n in nodes.items():
        children.setdefault(n.parent, []).append(path)
    order, todo = [], [0]
    while todo:
        order.append(path := todo.pop())
        todo += children.get(path, [])
    constant: Counter = Counter()
    for path, _, pages, chars in templates:
        constant[path] += pages * chars
    fixed, data, links = {}, {}, {}

    def count(dropped: set[int]) -> None:
        """Characters of template text, of other text and of links below every node, without what is left out."""
        for path in reversed(order):
            n, gone = nodes[path], path in dropped
            own = 0 if gone else min(constant[path], n.plain)
            fixed[path] = own + sum(fixed[c] for c in children.get(path, ()))
            data[path] = (0 if gone else n.plain - own) + sum(data[c] for c in children.get(path, ()))
            links[path] = (0 if gone else n.links) + sum(links[c] for c in children.get(path, ()))

    def outermost(fits, dropped: set[int]) -> list[int]:
        """Nodes that fit and have no such node above; all below them go to ``dropped``."""
        found = []
        for path in order:
            if nodes[path].parent in dropped:
                dropped.add(path)
            elif fits(path):
                found.append(path)
                dropped.add(path)
        return found

    count(set())
    total = data[0]
    dropped: set[int] = set()
    named = outermost(lambda p: nodes[p].label.endswith("?"), dropped)
    every = dict(data)
    count(dropped)
    if wrapper.pages >= TEMPLATE_PAGES and data[0] < ELSEWHERE * total:  # the names are wrong about most of the text
        dropped = set()
        named = outermost(lambda p: nodes[p].label.endswith("?") and 2 * every[p] <= total, dropped)
        count(dropped)
    main: list[int] = []
    below: set[int] = set()
    menus: list[int] = []
    for kind in ("article", "main"):
        below = set(dropped)
        main = outermost(lambda p: _tag(nodes[p].label) == kind, below)  # noqa: B023
        if main and (any(data[p] + links[p] for p in main) or not data[0] + links[0]):
            break
        main = []
    inside = bool(main) and kind == "article"
    if not inside:

        def menu(path: int) -> bool:
            n = nodes[path]
            if not path or not links[path] or links[path] < MENU_SHARE * (links[path] + data[path] + fixed[path]) or _tag(n.label) == "p":
                return False
            labels, _, groups = nodes[n.parent].kids or ((), (), ())
            at = labels.index(n.label) if n.label in labels else -1
            return bool(n.kids and n.kids[2]) or any(low <= at <= high for low, high in groups)

        menus = outermost(menu, dropped)
        count(dropped)
    if not main:
        at = 0
        while nodes[at].plain <= constant[at]:
            best = max(children.get(at, ()), key=lambda c: (data[c], c), default=0)
            share = data[best] >= CONTAINER_SHARE * data[at] > 0 and 2 * nodes[best].pages >= wrapper.pages
            if not best or not share or _tag(nodes[best].label) not in CONTAINERS:
                break
            at = best
        main = [at]
    sure = sum(fixed[p] for p in main)
    if sure > TEMPLATE_LIMIT * (sure + sum(data[p] for p in main)):
        return plan(wrapper)
    if not inside:
        main += [p for p in order if p not in dropped and _tag(nodes[p].label) == "h1" and data[p] > fixed[p]]
    kept = [t for t in templates if not (inside and t[0] in below and _tag(nodes[t[0]].label) in HEADINGS)]
    return {"main": sorted(set(main)), "out": sorted(named + menus), "templates": sorted([t[0], t[1]] for t in kept)}


def _selected(page: Page, rule: dict) -> list[bool] | None:
    """Which elements are main text by the rule; None if the page has no main element."""
    main, out = rule["main"], rule["out"]
    hard = page.hard()
    chosen, gone = [0 in main], [0 in out]
    for i in range(1, len(page.labels)):
        p, path = page.parents[i], page.paths[i]
        gone.append(gone[p] or hard[i] or path in out)
        chosen.append(chosen[p] or path in main)
    if not any(c and not g for c, g in zip(chosen, gone)):
        return None
    return [c and not g for c, g in zip(chosen, gone)]


def _prepared(rule: str | dict) -> dict:
    rule = json.loads(rule) if isinstance(rule, str) else rule
    return {"main": frozenset(rule["main"]), "out": frozenset(rule["out"]), "templates": frozenset(map(tuple, rule["templates"]))}


def main_text(source: str, rule: dict | None = None) -> str:
    """The blocks of a page's main elements, one a line; without a rule, or where it names nothing here, the page is its own wrapper."""
    page = Page(source)
    chosen = _selected(page, rule) if rule else None
    if chosen is None:
        own = Wrapper()
        own.add(page)
        rule = _prepared(plan(own))
        chosen = _selected(page, rule) or [True] * len(page.labels)
    templates = rule["templates"]
    lines = page.blocks([not c for c in chosen])
    return "\n".join(line for i, line in lines if not templates or (page.paths[i], _hash(line)) not in templates)


# -- Spark ---------------------------------------------------------------------------------------------------------------

_SIGN = 1 << 63
_READ = "host string, wrapper string, page long, slots array<struct<path:long,text:long,chars:int>>"
_SLOTS = pa.list_(pa.struct([("path", pa.int64()), ("text", pa.int64()), ("chars", pa.int32())]))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= _SIGN else x


def _read_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each page, the texts of its slots; now and then, and at the end, the wrappers of the hosts met."""
    schema = pa.schema([("host", pa.string()), ("wrapper", pa.string()), ("page", pa.int64()), ("slots", _SLOTS)])
    held: dict[str, Wrapper] = {}

    def passed_on() -> pa.RecordBatch:
        rows = [{"host": h, "wrapper": w.dumps(), "page": None, "slots": None} for h, w in held.items()]
        held.clear()
        return pa.RecordBatch.from_pylist(rows, schema)

    for batch in batches:
        out = []
        nodes = 0
        for host, source in zip(batch.column(0).to_pylist(), batch.column(1)):
            page = Page(source.as_py() or "")
            wrapper = held.setdefault(host, Wrapper())
            before = len(wrapper.nodes)
            wrapper.add(page)
            nodes += len(wrapper.nodes) - before
            slots = {(page.paths[i], _hash(line)): len(line) for i, line in page.blocks(page.hard())}
            whole = xxhash.xxh3_64_intdigest(b"".join(t.to_bytes(8) for _, t in slots))
            out.append({
                "host": host, "wrapper": None, "page": _signed(whole),
                "slots": [{"path": _signed(p), "text": _signed(t), "chars": n} for (p, t), n in slots.items()],
            })
            if nodes > HELD_NODES:
                yield passed_on()
                nodes = 0
        yield pa.RecordBatch.from_pylist(out, schema)
        if sum(len(w.nodes) for w in held.values()) > HELD_NODES:
            yield passed_on()
    if held:
        yield passed_on()


def _merge_wrappers(table: pa.Table) -> Wrapper:
    out = Wrapper()
    for s in sorted(table["wrapper"].to_pylist()):
        out.merge(Wrapper.loads(s))
    return out


def _bucket(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    return pa.table({"host": pa.array([key[0].as_py()], pa.string()), "wrapper": pa.array([_merge_wrappers(table).dumps()], pa.string())})


def _infer(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    fixed = [t for own in table["templates"].to_pylist()[:1] for t in own or ()]
    templates = [(t["path"] & _MASK, t["text"] & _MASK, t["pages"], t["chars"]) for t in fixed]
    wrapper = _merge_wrappers(table)
    return pa.table(
        {
            "host": pa.array([key[0].as_py()], pa.string()),
            "wrapper": pa.array([wrapper.expression()], pa.string()),
            "rule": pa.array([json.dumps(plan(wrapper, templates))], pa.string()),
            "pages": pa.array([wrapper.pages], pa.int64()),
            "templates": pa.array([len(templates)], pa.int64()),
        }
    )


def _host(url_col: str):
    return F.lower(F.regexp_extract(F.coalesce(F.col(url_col).cast("string"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1))


def wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html", buckets: int = 32) -> DataFrame:
    """One row per host: ``host, wrapper, rule, pages, templates``; pages without a host count as one host, the empty one.

    A task that aligns partial wrappers holds one a ``buckets``-th of the tasks that met the host, so raise ``buckets`` with
    the square root of the tasks.  Texts are counted by host, slot and text over all pages, equal pages once; a host's
    template texts are at most 1 / TEMPLATE_SHARE times the texts of a mean page.  The table is written, so its size is known
    when pages are joined with it: it is sent to all tasks if it is below Spark's broadcast threshold, and joined by host,
    hot hosts split, if it is above.

    Edge cases: null and empty html are pages without elements; an empty table gives no hosts; other columns are not read.
    """
    small_batches(pages.sparkSession)
    picked = pages.select(_host(url_col).alias("host"), F.col(html_col).cast("string").alias("html"))
    read = written(picked.mapInArrow(_read_pages, _READ), "layouts")
    once = read.where("page is not null").groupBy("host", "page").agg(F.first("slots").alias("slots"))
    slot = once.select("host", F.explode("slots").alias("s")).select("host", "s.path", "s.text", "s.chars")
    texts = slot.groupBy("host", "path", "text").agg(F.count(F.lit(1)).alias("pages"), F.max("chars").alias("chars"))
    texts = texts.where(F.col("pages") >= TEMPLATE_PAGES)
    with_slot = once.select("host", F.explode(F.array_distinct(F.col("slots.path"))).alias("path")).groupBy("host", "path").agg(F.count(F.lit(1)).alias("of"))
    fixed = texts.join(with_slot, ["host", "path"]).where(F.col("pages") >= TEMPLATE_SHARE * F.col("of"))
    fixed = fixed.groupBy("host").agg(F.collect_list(F.struct("path", "text", "pages", "chars")).alias("templates"))
    partial = read.where("wrapper is not null").select("host", "wrapper", F.pmod(F.xxhash64("wrapper"), F.lit(buckets)).alias("bucket"))
    partial = partial.groupBy("host", "bucket").applyInArrow(_bucket, "host string, wrapper string")
    found = partial.join(fixed, "host", "left").groupBy("host").applyInArrow(_infer, "host string, wrapper string, rule string, pages long, templates long")
    found = written(found, "wrappers")
    forget(read)
    return found


def extract(
    pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """For each row ``page_id, url, text``: the main text by its host's rule.

    Edge cases: null and empty html give an empty text; a page that lacks what the rule names is its own wrapper; a page
    without any block, such as plain text, is one block; truncated pages keep what is there; pages may nest as deep as they
    like; null urls share a host; repeated rows are extracted each; an empty table gives none; very long pages are read
    whole; other columns are neither read nor returned.
    """
    small_batches(pages.sparkSession)
    picked = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"), _host(url_col).alias("host")
    )
    joined = picked.join(rules.select("host", "rule"), "host", "left").select("page_id", "url", "html", "rule")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str | None, dict | None] = {None: None}
        for batch in batches:
            texts = []
            for source, rule in zip(batch.column(2), batch.column(3).to_pylist()):
                if rule not in known:
                    if len(known) > 1000:
                        known = {None: None}
                    known[rule] = _prepared(rule)
                texts.append(main_text(source.as_py() or "", known[rule]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    kind = picked.schema["page_id"].dataType.simpleString()
    return joined.mapInArrow(run, f"page_id {kind}, url string, text string")
