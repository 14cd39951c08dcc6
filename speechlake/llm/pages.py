"""Main text of web pages: boosted trees score the nodes, a pass over the tree decides without contradictions."""

from __future__ import annotations

import html
import math
import random
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from speechlake.llm import boosting

# --- parsing

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\"<>])*+)>|<[!?][^<>]*>", re.S)
ATTRIBUTE = re.compile(r"([^\s\"'=<>/]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
SPACES = re.compile(r"\s+")
# fixed values: element names as HTML defines them
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
UNSEEN = frozenset("script style template noscript svg math iframe object canvas head title".split())
RAW = frozenset("script style textarea title".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike "
                   "strong sub sup time tt u var wbr".split())
CLOSES = {  # an opening tag ends an open element of these kinds
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
    "th": ("td", "th"), "option": ("option",), "body": ("head",),
}
SCOPES = frozenset("ul ol dl table select body html".split())  # implied ends do not reach beyond these

GROUPS = {  # groups of element names that count as one feature
    name: k for k, names in enumerate((
        "article main", "div section center", "p blockquote pre", "h1 h2 h3 h4 h5 h6 hgroup", "ul ol dl", "li dt dd",
        "nav menu", "header", "footer", "aside", "form button select textarea option fieldset input", "table tbody thead tr td th",
        "figure figcaption picture", "body html", "dialog details summary",
    )) for name in names.split()}
N_GROUPS = 17
RUN, OTHER = 15, 16
CONTENT = frozenset("content article post entry main body story text page blog news prose".split())
CHROME = frozenset("nav navbar menu sidebar side ad ads advert advertisement banner promo sponsor sponsored cookie cookies "
                   "notice consent gdpr footer foot header head masthead share social related recommended breadcrumb breadcrumbs "
                   "widget popup modal newsletter subscribe signup login search form toolbar pagination tags meta outbrain alert".split())
TALK = frozenset("comment comments reply replies discussion disqus respond thread responses".split())
WORDS_IN = re.compile(r"[a-z]+")


@lru_cache(maxsize=64)
def _end_of(tag: str) -> re.Pattern:
    """The end of an element whose text is not shown; of one that is not raw text, whatever shows first that it has none."""
    if tag in RAW:
        return re.compile(rf"(</{tag}\b[^<>]*>?)", re.I)
    return re.compile(rf"(</{tag}\b[^<>]*>?)|<{tag}\b|</(?:article|main|body|html)\b", re.I)


class Node:
    __slots__ = ("tag", "kind", "parent", "children", "text", "hints", "marked", "chars", "linked", "tags", "stops", "depth")

    def __init__(self, tag: str, parent: Node | None, hints: frozenset[str] = frozenset(), marked: bool = False):
        self.tag, self.parent, self.hints, self.marked = tag, parent, hints, marked or bool(parent and parent.marked)
        self.kind = GROUPS.get(tag, OTHER)
        self.children: list[Node] = []
        self.text: str | None = None
        self.chars = self.linked = self.tags = self.stops = 0
        self.depth = parent.depth + 1 if parent else 0


def parse(source: str) -> Node:
    """Tree of block elements; the text between two block boundaries is one child (a run) of its element.

    A tag that is not closed by ``>`` before the next ``<`` is text. Elements such as ``svg`` or ``noscript`` are skipped up to their end; if
    they have none inside their article or page, only their tag is. Time is in proportion to the page, whatever stands in it.
    """
    root = Node("html", None)
    stack: list[tuple[str, Node, bool]] = [("html", root, True)]  # tag, block that holds it, whether it is that block
    pieces: list[str] = []
    linked, open_links = 0, 0
    at, n = 0, len(source)

    def flush() -> None:
        nonlocal linked
        if pieces:
            said = SPACES.sub(" ", "".join(pieces)).strip()
            if said:
                here = stack[-1][1]
                run = Node("#run", here)
                run.kind, run.text, run.chars, run.linked = RUN, said, len(said), min(linked, len(said))
                run.stops = sum(map(said.count, ".,;:!?"))
                here.children.append(run)
            pieces.clear()
        linked = 0

    def say(raw: str) -> None:
        nonlocal linked
        if raw:
            clear = html.unescape(raw) if "&" in raw else raw
            pieces.append(clear)
            if open_links:
                linked += len(clear.strip())

    def close(to: int) -> None:
        nonlocal open_links
        while len(stack) > to:
            tag, _, block = stack[-1]
            if block:
                flush()
            elif tag == "a":
                open_links -= 1
            stack.pop()

    while at < n:
        found = TOKEN.search(source, at)
        if not found:
            say(source[at:])
            break
        say(source[at:found.start()])
        at = found.end()
        if found[2] is None:
            continue
        tag = found[2].lower()
        if found[1]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    close(k)
                    break
            continue
        if tag in RAW or tag in UNSEEN and tag != "head":
            end = _end_of(tag).search(source, at)
            if end and end[1]:
                at = end.end()
            elif tag in RAW:
                at = n  # raw text without an end reaches to the end of the page, as in a browser
            continue
        if tag == "head":
            end = re.compile(r"</head\s*>|(?=<body\b)", re.I).search(source, at)
            at = end.end() if end else at
            continue
        if tag in VOID:
            if tag == "br":
                pieces.append(" ")
            elif tag == "hr":
                flush()
            continue
        if tag == "html":
            continue
        if tag in INLINE:
            stack.append((tag, stack[-1][1], False))
            open_links += tag == "a"
            continue
        flush()
        ends = CLOSES.get(tag, ())
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] in ends or stack[k][0] == "p":
                close(k)
            elif stack[k][2] and stack[k][0] in SCOPES:
                break
            elif stack[k][2] and not ends:
                break
        given = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(found[3])} if found[3] else {}
        said = " ".join(given.get(k, "") for k in ("class", "id", "role")).lower() if given else ""
        node = Node(tag, stack[-1][1], frozenset(WORDS_IN.findall(said)), "data-main" in given)
        stack[-1][1].children.append(node)
        stack.append((tag, node, True))
    close(0 if not stack else 1)
    flush()
    return root


def nodes(root: Node) -> list[Node]:
    """All nodes, parents before children in page order; sums of the subtrees are set."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo.extend(reversed(node.children))
    for node in reversed(order):
        node.tags += 1
        if node.parent:
            up = node.parent
            up.chars += node.chars
            up.linked += node.linked
            up.stops += node.stops
            up.tags += node.tags
    return order


def features(order: list[Node]) -> np.ndarray:
    """One row for each node: size, densities, depth, place among siblings, element, attribute words."""
    out = np.zeros((len(order), 20 + 2 * N_GROUPS), np.float32)
    whole = order[0].chars + 1
    above: dict[int, tuple[int, int, int]] = {}
    place: dict[int, tuple[int, int]] = {}
    for row, node in zip(out, order):
        up = node.parent
        good, bad, talk = bool(node.hints & CONTENT), bool(node.hints & CHROME), bool(node.hints & TALK)
        ag, ab, at = above[id(up)] if up else (0, 0, 0)
        above[id(node)] = (ag + (good or node.kind == 0), ab + (bad or node.kind in (6, 7, 8, 9, 10)), at + talk)
        for k, child in enumerate(node.children):
            place[id(child)] = (k, len(node.children))
        k, many = place.get(id(node), (0, 1))
        chars = node.chars
        row[:20] = (
            math.log1p(chars), node.linked / (chars + 1), chars / node.tags, node.stops / (chars + 1) * 50, node.depth,
            k, many - k, math.log1p(many), chars / whole, (up.chars if up else chars) / whole,
            chars / ((up.chars if up else chars) + 1), len(node.children), good, bad, talk, ag, ab, at,
            (up.linked / (up.chars + 1)) if up else 0, math.log1p(whole))
        row[20 + node.kind] = 1
        if up:
            row[20 + N_GROUPS + up.kind] = 1
    return out


def decode(order: list[Node], score: np.ndarray) -> list[Node]:
    """Runs of the best consistent choice: below a node that is cut nothing is kept.

    A node is kept or cut at the cost of its log loss, weighed by the root of its size. Cutting costs what all of the
    subtree says against it; a kept node's children decide for themselves. The cheaper one wins.
    """
    keep_cost, cut_cost = np.logaddexp(0, -score), np.logaddexp(0, score)
    at = {id(node): i for i, node in enumerate(order)}
    weigh = np.sqrt([node.chars + 1.0 for node in order])
    keep, cut = keep_cost * weigh, cut_cost * weigh
    for i in range(len(order) - 1, 0, -1):
        up = at[id(order[i].parent)]
        cut[up] += cut[i]
        keep[up] += min(keep[i], cut[i])
    kept, live = [], {id(order[0])}
    for i, node in enumerate(order):
        if node.parent is not None and (id(node.parent) not in live or keep[i] >= cut[i]):
            continue
        live.add(id(node))
        if node.text:
            kept.append(node)
    return kept


# --- training pages

def _prose(rng: random.Random, low: int, high: int) -> str:
    said = []
    while len(said) < rng.randint(low, high):
        word = "".join(rng.choice("bcdfghlmnprstvw") + rng.choice("aeiou") for _ in range(rng.randint(1, 4)))
        said.append(word + (rng.choice(".,.;") if rng.random() < 0.12 else ""))
    return " ".join(said).capitalize() + rng.choice((".", ".", "", "?"))


def training_page(rng: random.Random) -> str:
    """A page of random layout; what holds its main text carries ``data-main``."""
    links = lambda n: "".join(f"<li><a href='/{k}'>{_prose(rng, 1, 3)}</a></li>" for k in range(n))

    def box(tags: str, names: str, inner: str) -> str:
        named = f" {rng.choice(('class', 'id'))}=\"{rng.choice(names.split())}\"" if names else ""
        tag = rng.choice(tags.split())
        return f"<{tag}{named if tag in ('div', 'section') or rng.random() < 0.4 else ''}>{inner}</{tag}>"

    def paragraph() -> str:
        text = _prose(rng, 1, rng.choice((6, 40, 160)))
        if rng.random() < 0.3:
            text = f"<b>{text}" + ("</b>" if rng.random() < 0.5 else "<br>")
        if rng.random() < 0.15:
            text += f" <a href='/x'>{_prose(rng, 1, 4)}</a> {_prose(rng, 2, 12)}"
        return f"<p>{text}" + ("</p>" if rng.random() < 0.9 else "")

    advert = lambda: box("div aside", "ad ads advert banner sponsor promo", _prose(rng, 3, 20))
    body = [paragraph() for _ in range(rng.randint(1, 14))]
    for extra in (f"<h2>{_prose(rng, 2, 6)}</h2>", f"<blockquote>{_prose(rng, 8, 40)}</blockquote>",
                  "<ul>" + "".join(f"<li>{_prose(rng, 3, 25)}</li>" for _ in range(4)) + "</ul>",
                  f"<table><tr><td>{_prose(rng, 1, 4)}<td>{_prose(rng, 1, 4)}</table>",
                  f"<figure><figcaption>{_prose(rng, 4, 14)}</figcaption></figure>", _prose(rng, 5, 60)):
        if rng.random() < 0.25:
            body.insert(rng.randint(0, len(body)), extra)
    title = f"<h1>{_prose(rng, 3, 12)}</h1>" if rng.random() < 0.9 else ""
    kind = rng.random()
    mark = " data-main='1'"
    parts = [f"<div{mark}>{x}</div>" if not x.startswith("<") else re.sub(r"^<(\w+)", rf"<\1{mark}", x) for x in [title, *body] if x]
    if rng.random() < 0.15:
        parts.insert(rng.randint(1, len(parts)), advert())
    inside = "".join(parts)
    if kind < 0.45:
        main = f"<article>{inside}</article>"
    elif kind < 0.6:
        main = f"<main>{inside}</main>"
    elif kind < 0.9:
        main = f"<div class=\"{rng.choice('content post-body entry-content story article-text main page-content'.split())}\">{inside}</div>"
    else:
        main = f"<div>{inside}</div>"
    before = [box("nav nav div", "menu navbar nav", f"<ul>{links(rng.randint(2, 9))}</ul>")]
    after = [box("footer footer div", "footer foot", f"&copy; {_prose(rng, 1, 30)}")]
    more = (
        (before, lambda: box("header div", "header masthead", f"<p>{_prose(rng, 1, 8)}</p>")), (before, advert), (after, advert),
        (before, lambda: box("div section", "cookie consent notice alert", f"<p>{_prose(rng, 6, 40)}</p>")),
        (after, lambda: box("aside aside div", "sidebar side widget", f"<h3>{_prose(rng, 1, 4)}</h3><ul>{links(5)}</ul><p>{_prose(rng, 3, 30)}</p>")),
        (after, lambda: box("section div", "comments discussion responses",
                            "".join(f"<div class='comment'><p>{_prose(rng, 4, 60)}</p></div>" for _ in range(rng.randint(1, 6))))),
        (after, lambda: box("form", "search login newsletter", f"<label>{_prose(rng, 1, 8)}</label><button>{_prose(rng, 1, 2)}</button>")),
        (after, lambda: box("div section", "related recommended", f"<h3>{_prose(rng, 1, 3)}</h3><ul>{links(4)}</ul>")),
        (before, lambda: box("div", "breadcrumb breadcrumbs", "<a href='/'>home</a> / <a href='/a'>" + _prose(rng, 1, 3) + "</a>")),
        (after, lambda: box("div", "share social", f"<a href='#'>{_prose(rng, 1, 2)}</a> <a href='#'>{_prose(rng, 1, 2)}</a>")),
    )
    for side, made in more:
        if rng.random() < 0.35:
            side.insert(rng.randint(0, len(side)), made())
    whole = "".join([*before, main, *after])
    if rng.random() < 0.3:
        whole = f"<div class='{rng.choice(('wrapper', 'container', 'page', 'site'))}'>{whole}</div>"
    return f"<!DOCTYPE html><html><head><title>{_prose(rng, 2, 6)}</title></head><body>{whole}</body></html>"


@lru_cache(maxsize=4)
def page_model(pages: int = 300, seed: int = 8) -> boosting.Trees:
    """Trees fitted on ``pages`` random layouts; a node is positive if it holds main text."""
    rng = random.Random(seed)
    xs, ys, ws = [], [], []
    for _ in range(pages):
        order = nodes(parse(training_page(rng)))
        holds = {id(order[0]): False}
        for node in reversed(order):
            own = bool(node.text) and node.marked
            holds[id(node)] = holds.get(id(node), False) or own
            if node.parent and holds[id(node)]:
                holds[id(node.parent)] = True
        xs.append(features(order))
        ys.append([holds[id(node)] for node in order])
        ws.append([1 + math.sqrt(node.chars) / 4 for node in order])
    return boosting.fit(np.concatenate(xs), np.concatenate(ys).astype(float), np.concatenate(ws))


def main_texts(sources: list[str | None], model: boosting.Trees) -> list[str]:
    """Main text of each page; the pages' nodes are scored together."""
    trees = [nodes(parse(s)) if s else [] for s in sources]
    rows = [features(order) for order in trees if order]
    scores = model.scores(np.concatenate(rows)) if rows else np.zeros(0)
    out, at = [], 0
    for order in trees:
        kept = decode(order, scores[at:at + len(order)]) if order else []
        at += len(order)
        out.append(" ".join(node.text for node in kept))
    return out


def extract_text(pages: DataFrame, source: str = "html", out: str = "text", model: boosting.Trees | None = None,
                 together: int = 64) -> DataFrame:
    """All columns and ``out``, the main text: blocks in page order joined by one space.

    White space in a block is one space, character references are read. A null or empty page, and one without main text,
    gives the empty string. A column already named ``out`` is replaced. No shuffle: pages go through in batches.
    """
    trees = model or page_model()

    @F.pandas_udf("string")
    def extracted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            said: list[str] = []
            values = batch.tolist()
            for at in range(0, len(values), together):
                said += main_texts(values[at:at + together], trees)
            yield pd.Series(said, dtype=object)

    return pages.withColumn(out, extracted(F.col(source)))
