"""Main text of web pages by minimum-cut labelling of their blocks.

A page is cut into blocks of text at block-level tags. A classifier turns what is known of a block (its words, links, ending,
tag, and what the elements around it are called) into costs: a block that looks like content has a capacity from the source,
another one a capacity to the sink. Neighbours on the page are tied by their distance in the document tree, and the blocks of an
element through a node of its own, less and less towards the root. The maximum flow through this graph separates content
(still reached from the source) from boilerplate at the least total cost, so a heading or a short line goes with the text that
stands beside it, and a lone line between two containers with neither.

The text classifier is a logistic regression (`fit`) over a bounded sample of pages that have an article or main element, each
taken twice: as it is, and without any names. Names are bounded: an element called `sidebar` can outweigh a dozen blocks of
prose but not an article, while elements that HTML itself makes boilerplate, and reader comments, always count in full.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter, deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cueweave.llm.common import added, sliced, small_batches

# fixed values: HTML's element classes
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math canvas object select head".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr nobr".split()
)
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
FENCES = frozenset("table td th ul ol dl div section article aside nav main header footer form body html".split())

# fixed values: HTML's and ARIA's own words for what is (True) and is not the main text
ELEMENT = {"article": True, "main": True, "nav": False, "aside": False, "footer": False, "form": False, "menu": False, "dialog": False, "fieldset": False, "button": False, "label": False, "legend": False}
ROLE = {"main": True, "article": True} | dict.fromkeys("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form toolbar".split(), False)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

#: log-odds for names of elements, at most MOST_CUE of it for all blocks of one element that is only called so by its author
GOOD_CUE, BAD_CUE, MOST_CUE, FARTHER = 1.5, -7.0, 84.0, 0.25
#: smoothness: of page neighbours at distance 1, of blocks below one element, and what is left of that a level further up
NEXT, TIE, UPWARDS, UNIT = 0.6, 0.8, 0.25, 1000
MOST = 4.0  # of a block's own log-odds

# a name says what an element is if all its parts do: "related-work" or "share-price" do not
_COMMENTS = re.compile(r"^(?:comments?|commentlist|repl(?:y|ies)|respond|disqus|discussion)$")
_BAD = re.compile(
    r"^(?:ads?|adv|adbox|adslot|adsense|adunit|advert\w*|sponsor\w*|promo\w*|banners?|cookies?|consent|gdpr|notices?|notification\w*|alerts?|popups?|modal|overlay|newsletters?|subscri\w+|signup|signin|login|register"
    r"|nav|navbar|navigation|menus?|breadcrumbs?|sidebar\w*|aside|footer|copyright|share|sharing|social|related|recommend\w*|comments?|commentlist|repl(?:y|ies)|respond|disqus|discussion|pagination|pager|toolbar|widgets?|search|form|masthead|topbar|legal|disclaimer|outbrain|taboola|skip|teasers?|tagcloud)$"
)
_BESIDE = frozenset(
    "site page main top bottom left right list lists item items link links box boxes container wrapper wrap inner outer section block area bar button buttons btn icons group row col column panel holder content header title text body post posts entry article articles "
    "new js mobile desktop sticky fixed float primary secondary global local input field email thread count meta feed slot unit frame zone region module component card cards more all popular latest recent user reader media policy sub mega drop down".split()
)
_GOOD = re.compile(r"^(?:article|articles|content|main|post|entry|story|body|text|prose)$")
_RIGHTS = re.compile(r"©|\(c\) ?\d{4}|copyright|all rights reserved", re.I)
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
_ATTR = re.compile(r"(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_END = tuple(".!?…:;。！？»”\"'")
_ends = {t: re.compile(f"</{t}", re.I) for t in RAW}


class Element:
    """An element: its place in the list of elements, its parent's, whether it is in an article, and what it is called: content,
    boilerplate or nothing (None), on HTML's authority (firm) or its author's."""

    __slots__ = ("at", "tag", "up", "inside", "called", "firm")

    def __init__(self, at: int, tag: str, up: int, inside: bool, called: bool | None, firm: bool):
        self.at, self.tag, self.up, self.inside, self.called, self.firm = at, tag, up, inside, called, firm


class Block:
    """A text block: its features, its element, and its distance in the tree from the block before it."""

    __slots__ = ("text", "features", "home", "far")

    def __init__(self, text: str, features: tuple[float, ...], home: int, far: int):
        self.text, self.features, self.home, self.far = text, features, home, far


def _called(names: str, inside: bool) -> tuple[bool | None, bool]:
    """What a class or an id says, and whether it speaks of comments."""
    good = False
    for name in names.split():
        parts = [x.lower() for x in _NAME.findall(name) if not x.isdigit()]
        bad = [x for x in parts if _BAD.match(x)]
        if bad and all(x in _BESIDE or x in bad or x == "header" for x in parts):
            return False, any(map(_COMMENTS.match, bad))
        if parts == ["header"] and not inside:
            return False, False
        good |= bool(parts) and any(map(_GOOD.match, parts)) and all(x in _BESIDE or _GOOD.match(x) for x in parts)
    return (True if good else None), False


def _cue(tag: str, attrs: str, inside: bool) -> tuple[bool | None, bool]:
    """(called, firm) of an element. An id on a heading or within an article is an anchor, unless it speaks of comments."""
    called, firm = ELEMENT.get(tag), tag in ELEMENT
    if tag == "header" and not inside:
        called, firm = False, True
    if not attrs or tag in ("html", "body"):
        return called, firm
    by_author: list[tuple[bool | None, bool]] = []
    for m in _ATTR.finditer(attrs):
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key == "role" and called is not False:
            called = ROLE.get(value.strip().lower(), called)
            firm = called is not None
        elif key == "style" and "display:none" in value.replace(" ", "").lower() or key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return False, True
        elif key == "class" or key == "id" and tag not in HEADINGS:
            said = _called(value, inside)
            if key == "class" or not inside or said[1]:
                by_author.append(said)
    if called is False:
        return called, firm
    for said in by_author:
        if said[0] is False:
            return said
    return (called, firm) if called is not None else ((True, False) if any(x for x, _ in by_author) else (None, False))


#: features of a block, and the log-odds of each that stand where no sample says more
FEATURES = ("one", "words", "links", "sentence", "rights", "heading", "paragraph", "item", "company")
PRIOR = (-3.2, 0.75, -5.0, 0.6, -3.0, 0.8, 0.7, -0.7, 0.5)


def _features(text: str, tag: str, links: float) -> tuple[float, ...]:
    words = text.count(" ") + 1
    return (1.0, min(math.log2(1 + words), 6.0), links, float(text.endswith(_END)), float(bool(_RIGHTS.search(text))), float(tag in HEADINGS), float(tag in ("p", "blockquote", "pre")), float(tag in ("li", "td", "th", "dt", "dd")))


def blocks(page: str) -> tuple[list[Block], list[Element]]:
    """The text blocks in page order, and all elements, each after its parent; element 0 is the page."""
    out: list[Block] = []
    elements = [Element(0, "", 0, False, None, False)]
    stack = [elements[0]]
    open_tags: dict[str, int] = {}
    text: list[str] = []
    home, links, in_link, at, n = stack[0], 0, 0, 0, len(page)
    depth = low = last = 1  # of the block that is being read; the least since the last block; the last block's
    search = _TOKEN.search

    def flush() -> None:
        nonlocal links, low, last
        if text:
            whole = " ".join(html.unescape("".join(text)).split())
            if whole:
                far = last + depth - 2 * min(low, depth)
                out.append(Block(whole, _features(whole, home.tag, min(1.0, links / len(whole))), home.at, far))
                low = last = depth
            text.clear()
        links = 0

    def push(tag: str, cue: tuple[bool | None, bool], inside: bool) -> None:
        up = stack[-1]
        e = Element(len(elements), tag, up.at, up.inside or inside, *cue)
        elements.append(e)
        stack.append(e)
        open_tags[tag] = open_tags.get(tag, 0) + 1

    def pop(keep: int) -> None:
        nonlocal low
        for e in stack[keep:]:
            open_tags[e.tag] -= 1
        del stack[keep:]
        low = min(low, keep)

    while at < n:
        m = search(page, at)
        end = m.start() if m else n
        if end > at:
            piece = page[at:end]
            if not text:
                home, depth = stack[-1], len(stack)
            text.append(piece)
            if in_link:
                links += len(piece.strip())
        if not m:
            break
        at = m.end()
        close, tag, attrs = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        tag = tag.lower()
        if tag in INLINE:
            if tag == "br":
                text.append(" ") if text else None
            elif tag == "a":
                in_link = 0 if close else 1
            if not close and tag not in VOID and attrs and ("class" in attrs or "id" in attrs or "hidden" in attrs or "style" in attrs):
                cue = _cue(tag, attrs, stack[-1].inside)
                if cue[0] is False:  # an inline advert or hidden text is a block of its own
                    flush()
                    push("*" + tag, cue, False)
            elif close and stack[-1].tag == "*" + tag:
                flush()
                pop(len(stack) - 1)
            continue
        if tag in RAW:
            if not close and not attrs.endswith("/"):
                if tag in ("script", "style", "textarea", "title", "template", "iframe", "svg", "noscript", "select", "object", "canvas", "math"):
                    stop = _ends[tag].search(page, at)
                    at = stop.start() if stop else n
                    flush() if tag in ("textarea", "select") else None
                elif (stop := _ends[tag].search(page, at)) is not None:  # a head that is never closed hides nothing
                    at = stop.start()
            continue
        flush()
        if close:
            if open_tags.get(tag):
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag == tag:
                        pop(k)
                        in_link = 0
                        break
                    if stack[k].tag in FENCES and tag not in FENCES:
                        break
            continue
        if tag in VOID:
            continue
        if tag in CLOSES_P and stack[-1].tag.lstrip("*") in ("p", "span"):
            k = len(stack)
            while k > 1 and stack[k - 1].tag.lstrip("*") in ("p", "span"):
                k -= 1
            pop(k)
        elif tag in SIBLINGS:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in SIBLINGS[tag]:
                    pop(k)
                    break
                if stack[k].tag in FENCES:
                    break
        if not attrs.endswith("/"):
            push(tag, _cue(tag, attrs, stack[-1].inside), tag in ("article", "main"))
    flush()
    # the company of a block: how many stand in its element, or if it has that alone, in the one around, below the page's body
    alone = Counter(b.home for b in out)
    around = [b.home if alone[b.home] > 1 else elements[b.home].up for b in out]
    company = Counter(around)
    for b, e in zip(out, around, strict=True):
        b.features += (min(math.log2(company[e]), 1.6) if elements[e].tag not in ("", "html", "body") else 0.0,)
    return out, elements


def costs(found: list[Block], elements: list[Element], weights: tuple[float, ...] = PRIOR) -> list[float]:
    """Log-odds that each block is content: its own, within MOST, and those of the names around it. The nearest name counts, those
    further out a quarter each."""
    inner = [0] * len(elements)
    for b in found:
        inner[b.home] += 1
    for e in reversed(elements[1:]):
        inner[e.up] += inner[e.at]
    cue, near = [0.0] * len(elements), [0.0] * len(elements)
    for e in elements[1:]:
        own = 0.0 if e.called is None else GOOD_CUE if e.called else BAD_CUE if e.firm else max(BAD_CUE, -MOST_CUE / max(1, inner[e.at]))
        near[e.at] = near[e.up] if e.called is None else own
        cue[e.at] = cue[e.up] if e.called is None else own + FARTHER * near[e.up]
    own = [sum(w * x for w, x in zip(weights, b.features, strict=True)) for b in found]
    return [max(-MOST, min(MOST, x)) + cue[b.home] for x, b in zip(own, found, strict=True)]


def graph(found: list[Block], elements: list[Element], weights: tuple[float, ...] = PRIOR) -> tuple[list[int], list[tuple[int, int, int]]]:
    """Terminal capacities of all nodes, blocks first, and smoothness edges (i, j, capacity).

    An element with one node in it stands for that node; the page, html and body tie nothing together.
    """
    odds = [round(UNIT * x) for x in costs(found, elements, weights)]
    links = [(j - 1, j, round(UNIT * NEXT / max(1, b.far))) for j, b in enumerate(found) if j]
    inner: list[list[tuple[int, int, int]]] = [[] for _ in elements]  # (node, blocks in it, levels of ties below)
    for j, b in enumerate(found):
        inner[b.home].append((j, 1, 0))
    for e in reversed(elements):
        nodes = inner[e.at]
        if not nodes or e.at == 0 or e.tag in ("html", "body"):
            continue
        if len(nodes) > 1:
            high = max(level for _, _, level in nodes)
            links += [(i, len(odds), max(1, round(UNIT * TIE * UPWARDS**high * k))) for i, k, _ in nodes]
            nodes = [(len(odds), sum(k for _, k, _ in nodes), high + 1)]
            odds.append(0)
        inner[e.up] += nodes
    return odds, links


def minimum_cut(odds: list[int], links: list[tuple[int, int, int]]) -> list[bool]:
    """True for nodes on the source's side. odds > 0 is a capacity from the source, odds < 0 one to the sink.

    Nodes whose terminal capacity exceeds all their edges are settled first, for no flow through them can saturate it;
    their edges become terminal capacities of their neighbours. The rest goes through augmenting paths in levels.
    """
    n = len(odds)
    odds = odds[:]
    near: list[dict[int, int]] = [{} for _ in range(n)]
    for i, j, c in links:
        if c > 0:
            near[i][j] = near[i].get(j, 0) + c
            near[j][i] = near[j].get(i, 0) + c
    side: list[bool | None] = [None] * n
    todo = deque(range(n))
    while todo:
        i = todo.popleft()
        if side[i] is None and abs(odds[i]) >= sum(near[i].values()):
            side[i] = odds[i] > 0
            for j, c in near[i].items():
                del near[j][i]
                odds[j] += c if side[i] else -c
                todo.append(j)
            near[i] = {}
    rest = [i for i in range(n) if side[i] is None]
    if rest:
        place = {i: k for k, i in enumerate(rest)}
        reached = _max_flow([odds[i] for i in rest], [[(place[j], c) for j, c in near[i].items()] for i in rest])
        for i, r in zip(rest, reached, strict=True):
            side[i] = r
    return [bool(s) for s in side]


def _max_flow(odds: list[int], near: list[list[tuple[int, int]]]) -> list[bool]:
    """Nodes that the source still reaches when no path to the sink is left (Dinic's levels)."""
    n = len(odds)
    s, t = n, n + 1
    to: list[int] = []
    room: list[int] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def arc(i: int, j: int, there: int, back: int) -> None:
        out[i].append(len(to))
        to.append(j)
        room.append(there)
        out[j].append(len(to))
        to.append(i)
        room.append(back)

    for i in range(n):
        if odds[i] > 0:
            arc(s, i, odds[i], 0)
        elif odds[i] < 0:
            arc(i, t, -odds[i], 0)
        for j, c in near[i]:
            if i < j:
                arc(i, j, c, c)
    while True:
        level = [-1] * (n + 2)
        level[s] = 0
        queue = deque([s])
        while queue:
            i = queue.popleft()
            for e in out[i]:
                if room[e] and level[to[e]] < 0:
                    level[to[e]] = level[i] + 1
                    queue.append(to[e])
        if level[t] < 0:
            return [x >= 0 for x in level[:n]]
        turn = [0] * (n + 2)
        path: list[int] = []
        i = s
        while True:
            if i == t:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                # go on from the first arc that is full
                del path[next(k for k, e in enumerate(path) if not room[e]) :]
                i = to[path[-1]] if path else s
            while turn[i] < len(out[i]):
                e = out[i][turn[i]]
                if room[e] and level[to[e]] == level[i] + 1:
                    break
                turn[i] += 1
            if turn[i] < len(out[i]):
                path.append(out[i][turn[i]])
                i = to[path[-1]]
            elif i == s:
                break
            else:
                e = path.pop()
                i = to[e ^ 1]
                turn[i] += 1


def main_text(page: str | None, weights: tuple[float, ...] = PRIOR) -> str:
    """The content blocks of a page, joined by newlines; empty if it has none."""
    found, elements = blocks(page) if page else ([], [])
    if not found:
        return ""
    keep = minimum_cut(*graph(found, elements, weights))
    return "\n".join([b.text for b, k in zip(found, keep) if k])


_GIVEN_NAMES = re.compile(r"<(/?)(?!/?(?:a|b|br|i|em|strong|span|code|img|input|html|head|body|meta|link|title|style|script)\b)[a-zA-Z][\w-]*(?:[^>\"']|\"[^\"]*\"|'[^']*')*>")


def nameless(page: str) -> str:
    """The page with all its block-level elements called div, without attributes."""
    return _GIVEN_NAMES.sub(lambda m: f"<{m[1]}div>", page)


def examples(page: str) -> tuple[list[tuple[float, ...]], list[bool]]:
    """Features and labels of the blocks of a page that has an article or main element: in it or not. Blocks in it that are below
    boilerplate are no examples."""
    found, elements = blocks(page)
    if not any(e.inside for e in elements):
        return [], []
    state: list[bool | None] = [False] * len(elements)
    for e in elements[1:]:
        state[e.at] = (None if e.called is False or state[e.up] is None else True) if e.inside else False
    some = [(b.features, state[b.home]) for b in found if state[b.home] is not None]
    return [f for f, _ in some], [bool(y) for _, y in some]


def fit_weights(pages: list[str], prior: tuple[float, ...] = PRIOR, hold: float = 10.0, steps: int = 30) -> tuple[float, ...]:
    """Weights of the features by logistic regression over labelled pages and their nameless forms, held near prior as by `hold`
    examples of each class. Every page has the same say, whatever its length. Without labelled pages: prior."""
    x: list[tuple[float, ...]] = []
    y: list[bool] = []
    say: list[float] = []
    for page in pages:
        f, labels = examples(page)
        bare = [b.features for b in blocks(nameless(page))[0]] if f else []
        for features in (f, bare if len(bare) == len(labels) else []):
            for kind in (True, False):
                n = labels.count(kind)
                say += [1.0 / n for label in labels[: len(features)] if label == kind]
                x += [v for v, label in zip(features, labels, strict=False) if label == kind]
                y += [kind] * (n if features else 0)
    if not x:
        return prior
    a, b, s, start = np.array(x), np.array(y, float), np.array(say), np.array(prior)
    w = start.copy()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        slope = a.T @ (s * (p - b)) + hold * (w - start)
        bend = (a * (s * p * (1 - p))[:, None]).T @ a + hold * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(round(float(v), 6) for v in w)


SAMPLE, SAMPLE_CHARS = 400, 1 << 16


def fit(pages: DataFrame, html_col: str = "html", sample: int = SAMPLE, most_chars: int = SAMPLE_CHARS) -> tuple[float, ...]:
    """Weights from at most `sample` pages of at most `most_chars` characters each that name an article or main element, those of least
    hash. Only about as many pages reach the driver, however many tasks there are: a first pass counts, and the hash picks that
    share; copies count once."""
    c = F.col(html_col)
    some = pages.filter((F.length(c) <= most_chars) & c.rlike("(?i)<(?:article|main)\\b")).select(F.xxhash64(c).alias("k"), c.alias("h"))
    n = some.count()
    if n > sample:
        some = some.filter(F.col("k") < -(1 << 63) + (1 << 64) * sample // n)
    return fit_weights([r["h"] for r in some.dropDuplicates(["k"]).orderBy("k").limit(sample).collect()])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", weights: tuple[float, ...] | None = None) -> DataFrame:
    """page_id, url, text, n_chars of every page, from its whole html.

    weights are those of the classifier, by default fitted to the pages. Null, empty and contentless pages have an empty text.
    Repeated rows stay repeated, null ids and urls stay null, other columns are dropped, an empty table gives no row. Pages of
    any length and depth are read whole. Nothing is shuffled but the sample.
    """
    small_batches(pages.sparkSession)
    weights = fit(pages, html_col) if weights is None else weights
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("_html"))
    schema = added(rows.drop("_html"), "text string, n_chars long")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches, 128):
            texts = [main_text(h, weights) for h in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(work, schema)
