"""Main text of web pages by minimum-cut labelling (operator 10).

A page is read as a sequence of blocks.  A classifier of what a block looks like (length, links, commas and
so on) and of what the markup says of it gives the cost of calling it content or boilerplate; these costs are
terminal capacities, adjacency and nearness in the DOM are smoothness edges, and a maximum flow separates the blocks.
Looks, markup and smoothness are weighted by what a sample of pages says of them.
"""

from __future__ import annotations

import re
from collections import Counter, deque
from dataclasses import dataclass, field
from html import unescape
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chemlake.llm.workspace import small_batches

#: Weights are fitted on the blocks of about so many pages, drawn by a hash of the page's row.
FIT_PAGES = 2_000
#: Costs are in nats: what a block's looks may count for at most, and an edge.
MOST_LOOKS, MOST_SMOOTH = 4.0, 1.0
#: Of elements and roles that are no main text.
CERTAIN = 1e6
# Fixed values, before any page is seen: weights of a block's looks (constant, length, links, commas and stops,
# last character, paragraph, heading, list item); what an article element, its absence in a page that has one, and a word
# of class or id that names a part of a page count for; and how many blocks all this counts for in the fit.
BEFORE, STRENGTH = np.array([-1.5, 0.5, -4.0, 1.0, 0.5, 1.0, 1.0, -0.5]), 50.0
MARKUP = {"inside": 3.0, "outside": -3.0, "named": -3.0}
#: For markup, the sample counts as so many blocks, so that looks and neighbours can outvote it however many pages there are.
MARKUP_BLOCKS = 1_000
#: Neighbours are told apart by steps between them in the DOM, up to FAR; AROUND: children of one element with others between them.
FAR, AROUND = 8, 9
LOOKS, TAGS = len(BEFORE), slice(5, 8)

# Names of HTML elements.
SKIPPED = "script|style|noscript|template|textarea|title|svg|iframe|object|select|canvas|audio|video"
BLOCKS = frozenset("address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# An open element (left) that an opening tag (right) closes.
CLOSED_BY = {"p": BLOCKS, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}
MAIN = frozenset(("article", "main"))
APART = frozenset("nav footer aside form menu dialog button fieldset search".split())
# Words in class, id and role that name a part of a page.
APART_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments complementary consent contentinfo cookie cookies dialog disqus "
    "footer form login menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promotion related respond search share sharing sidebar signup "
    "social sponsor sponsored subscribe toolbar widget".split()
)
# Words in class and id of an article element that is not the page's main text.
TEASER_WORDS = frozenset("card cards comment comments related teaser teasers".split())
HEAD_WORDS = frozenset(("header", "masthead"))
MAIN_WORDS = frozenset(("article", "articlebody", "main"))
NEGATIONS = frozenset(("no", "has", "with", "without", "not"))

TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({SKIPPED})\b(?:=\s*+\"[^\"]*+(?:\"|\Z)|=\s*+'[^']*+(?:'|\Z)|[^>])*+(?:>|\Z)(?:.*?</\1\s*+[^>]*+(?:>|\Z)|.*\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:=\s*+\"[^\"]*+(?:\"|\Z)|=\s*+'[^']*+(?:'|\Z)|[^>])*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"""\b(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
WORD = re.compile(r"[a-zA-Z][a-z]*|[A-Z]+")


@dataclass
class Block:
    text: str
    node: int
    apart: bool
    named: bool
    main: bool
    tag: str
    linked: int


@dataclass
class _Open:
    name: str
    node: int
    apart: bool
    named: bool
    main: bool


@dataclass
class Page:
    """Blocks, and of each element its parent and depth."""

    blocks: list[Block] = field(default_factory=list)
    has_main: bool = False
    parents: list[int] = field(default_factory=lambda: [0])
    depths: list[int] = field(default_factory=lambda: [0])


def _named(attributes: str, inside_main: bool, heading: bool) -> tuple[bool, bool, bool]:
    """Whether the role says boilerplate, class or id do, and any of them main text. The id of a heading is made of its title."""
    apart = named = main = False
    for m in ATTRIBUTE.finditer(attributes):
        kind, before = m[1].lower(), ""
        if heading and kind == "id":
            continue
        for word in WORD.findall(m[2] or m[3] or m[4] or ""):
            word = word.lower()
            if before not in NEGATIONS:
                hit = word in APART_WORDS or (word in HEAD_WORDS and not inside_main)
                apart |= hit and kind == "role"
                named |= hit and kind != "role"
                main |= word in MAIN_WORDS
            before = word
    return apart, named, main and not apart and not named


def _teaser(attributes: str) -> bool:
    """Whether class or id call an article element a comment, a card or a teaser."""
    words = [w.lower() for m in ATTRIBUTE.finditer(attributes) for w in WORD.findall(m[2] or m[3] or m[4] or "")]
    return any(w in TEASER_WORDS and before not in NEGATIONS for before, w in zip(["", *words], words, strict=False))


def read_page(html: str | None) -> Page:
    """The blocks of a page in order; element contents that are no text are left out."""
    page, at = Page(), 0
    stack, names = [_Open("", 0, False, False, False)], Counter()
    texts: list[str] = []
    links = linked = 0
    html = html or ""

    def flush() -> None:
        nonlocal linked
        if texts:
            if text := " ".join(unescape("".join(texts)).split()):
                top = stack[-1]
                page.blocks.append(Block(text, top.node, top.apart, top.named, top.main, top.name, min(linked, len(text))))
            texts.clear()
            linked = 0

    def close(count: int) -> None:
        for _ in range(count):
            names[stack.pop().name] -= 1

    for m in TOKEN.finditer(html):
        if m.start() > at:
            piece = html[at : m.start()]
            texts.append(piece)
            if links:
                linked += len(piece)
        at = m.end()
        name = (m[3] or "").lower()
        if not name:
            continue  # a comment, a declaration, or an element without text
        closing = bool(m[2])
        if name == "a":
            links = max(0, links - 1) if closing else links + 1
        if name == "br":
            texts.append(" ")
        if name not in BLOCKS:
            continue
        flush()
        links = 0 if closing and name in ("p", "li", "div") else links
        if closing:
            if names[name]:
                k = next(k for k in range(1, len(stack)) if stack[-k].name == name)
                close(k)
            continue
        while len(stack) > 1 and name in CLOSED_BY.get(stack[-1].name, ()):
            close(1)
        if name in VOID:
            continue
        top = stack[-1]
        page.parents.append(top.node)
        page.depths.append(len(stack))
        apart, named, main = name in APART or (name == "header" and not top.main), False, name in MAIN
        if "=" in m[4]:
            by_role, named, by_name = _named(m[4], top.main, name[:1] == "h" and name[1:].isdigit())
            if main:
                by_role, named = False, _teaser(m[4])
                main = not named
            else:
                main = by_name
            apart = apart or by_role
        page.has_main |= main and not (top.apart or top.named)
        stack.append(_Open(name, len(page.parents) - 1, top.apart or apart, top.named or named, top.main or main))
        names[name] += 1
    if at < len(html):
        texts.append(html[at:])
    flush()
    return page


def looks(page: Page) -> np.ndarray:
    """What each block looks like, without what the markup says of it."""
    rows = []
    for b in page.blocks:
        size = len(b.text)
        rows.append((1.0, min(log(1 + size), 8.0), b.linked / size, min(b.text.count(",") + b.text.count("."), 12) / 12, float(b.text[-1] in ".!?:…\"'”»"), float(b.tag == "p"), float(b.tag[:1] == "h" and b.tag[1:].isdigit()), float(b.tag == "li")))
    return np.array(rows, np.float64).reshape(len(rows), LOOKS)


def state(page: Page, b: Block) -> str:
    """What the markup says of a block: apart, named, inside or outside of an article, or nothing ('')."""
    return "apart" if b.apart else "named" if b.named else "inside" if b.main else "outside" if page.has_main else ""


def weak_label(says: str) -> int:
    """1 in an article element, 0 in an element that is apart or beside an article, -1 where the markup says nothing."""
    return {"inside": 1, "": -1}.get(says, 0)


def neighbours(page: Page) -> list[tuple[int, int, int]]:
    """(block, block, kind) of blocks that follow one another, by steps in the DOM, and of children of one element around others."""
    out, last = [], {}
    for i, b in enumerate(page.blocks):
        around = page.parents[b.node]
        if i:
            one, two, steps = page.blocks[i - 1].node, b.node, 0
            while one != two and steps < FAR:
                if page.depths[one] >= page.depths[two]:
                    one = page.parents[one]
                else:
                    two = page.parents[two]
                steps += 1
            out.append((i - 1, i, steps))
        if last.get(around, i - 1) != i - 1:
            out.append((last[around], i, AROUND))
        last[around] = i
    return out


@dataclass
class Model:
    """Weights of looks, of what the markup says, and of edges by kind of neighbours."""

    looks: np.ndarray
    markup: dict[str, float]
    smooth: np.ndarray


#: Edges before any page is seen: the weaker, the farther apart.
SMOOTH = np.array([*[1 / (1 + k / 2) for k in range(FAR + 1)], 0.25])


def untrained() -> Model:
    return Model(BEFORE.copy(), dict(MARKUP), SMOOTH.copy())


def fit_looks(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Logistic weights by Newton's method, drawn to BEFORE; row i counts n[i] times.

    Half of each row's count goes to its looks without its tag, so that text in plain div elements is told apart, too.
    """
    w = BEFORE.copy()
    if len(set(y.tolist())) < 2:
        return w
    bare = x.copy()
    bare[:, TAGS] = 0
    x, y, n = np.concatenate([x, bare]), np.concatenate([y, y]), np.concatenate([n, n]) / 2
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + STRENGTH * np.eye(LOOKS), x.T @ (n * (p - y)) + STRENGTH * (w - BEFORE))
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit_markup(odds: np.ndarray, y: np.ndarray, n: np.ndarray, says: np.ndarray) -> dict[str, float]:
    """What each kind of markup counts for beside a block's looks: logistic weights, drawn to MARKUP."""
    out, scale = {}, MARKUP_BLOCKS / max(n.sum(), 1.0)
    for kind, before in MARKUP.items():
        own, w = says == kind, before
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(odds[own] + w, -30, 30)))
            slope = scale * (n[own] * (p - y[own])).sum() + STRENGTH * (w - before)
            w -= slope / (scale * (n[own] * p * (1 - p)).sum() + STRENGTH)
        out[kind] = float(w)
    return out


def fit_smooth(alike: np.ndarray, unlike: np.ndarray) -> np.ndarray:
    """Weights of edges by kind: half the log odds of neighbours that have one label, drawn to SMOOTH, MOST_SMOOTH at most."""
    share = 1 / (1 + np.exp(-2 * SMOOTH))
    return np.clip(np.log((alike + STRENGTH * share) / (unlike + STRENGTH * (1 - share))) / 2, 0.0, MOST_SMOOTH)


def capacities(page: Page, model: Model) -> tuple[list[float], list[float]]:
    """Of each block, the cost of calling it boilerplate and that of calling it content."""
    odds = np.clip(looks(page) @ model.looks, -MOST_LOOKS, MOST_LOOKS).tolist()
    boilerplate, content = [], []
    for b, o in zip(page.blocks, odds, strict=True):
        says = state(page, b)
        both = (o, -CERTAIN if says == "apart" else model.markup.get(says, 0.0))
        boilerplate.append(sum(max(x, 0.0) for x in both))
        content.append(sum(max(-x, 0.0) for x in both))
    return boilerplate, content


def edges(page: Page, model: Model) -> list[tuple[int, int, float]]:
    return [(i, j, w) for i, j, kind in neighbours(page) if (w := float(model.smooth[kind])) > 0]


def minimum_cut(source: list[float], sink: list[float], links: list[tuple[int, int, float]]) -> list[bool]:
    """Nodes on the source's side of a minimum cut, by Dinic's algorithm."""
    n = len(source)
    s, t = n, n + 1
    heads: list[list[int]] = [[] for _ in range(n + 2)]
    to: list[int] = []
    room: list[float] = []

    def edge(a: int, b: int, forward: float, backward: float) -> None:
        heads[a].append(len(to))
        heads[b].append(len(to) + 1)
        to.extend((b, a))
        room.extend((forward, backward))

    for i in range(n):  # what passes straight through a node is cut either way
        through = source[i] - sink[i]
        if through > 0:
            edge(s, i, through, 0.0)
        elif through < 0:
            edge(i, t, -through, 0.0)
    for a, b, weight in links:
        edge(a, b, weight, weight)
    while True:
        level = [-1] * (n + 2)
        level[s] = 0
        queue = deque((s,))
        while queue:
            a = queue.popleft()
            for e in heads[a]:
                if room[e] > 1e-9 and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[t] < 0:
            return [x >= 0 for x in level[:n]]
        place = [0] * (n + 2)
        path: list[int] = []
        a = s
        while True:
            if a == t:
                flow = min(room[e] for e in path)
                for k, e in enumerate(path):
                    room[e] -= flow
                    room[e ^ 1] += flow
                full = next(k for k, e in enumerate(path) if room[e] <= 1e-9)
                a = to[path[full] ^ 1]
                del path[full:]
            elif place[a] < len(heads[a]):
                e = heads[a][place[a]]
                if room[e] > 1e-9 and level[to[e]] == level[a] + 1:
                    path.append(e)
                    a = to[e]
                else:
                    place[a] += 1
            elif path:
                a = to[path.pop() ^ 1]
                place[a] += 1
            else:
                break


def main_text(html: str | None, model: Model) -> str:
    """Blocks of the page that the cut calls content, in order, with an empty line between them."""
    page = read_page(html)
    if not page.blocks:
        return ""
    boilerplate, content = capacities(page, model)
    kept = minimum_cut(boilerplate, content, edges(page, model))
    return "\n\n".join(b.text for b, keep in zip(page.blocks, kept, strict=True) if keep)


_SEEN = "kind string, looks array<double>, label int, n long"


def _squares(batches):
    """Counts of labelled blocks by what the markup says and (rounded, so that blocks alike are one row) by looks, and of
    labelled neighbours by kind and by whether they have one label."""
    for batch in batches:
        seen: Counter = Counter()
        for text in batch.column(0):
            page = read_page(text.as_py())
            says = [state(page, b) for b in page.blocks]
            labels = [weak_label(x) for x in says]
            for kind, row, label in zip(says, looks(page).round(1).tolist(), labels, strict=True):
                if label >= 0:
                    seen[kind, tuple(row), label] += 1
            for i, j, kind in neighbours(page):
                if labels[i] >= 0 and labels[j] >= 0:
                    seen["edge", (float(kind),), int(labels[i] == labels[j])] += 1
        keys = [*seen]
        columns = [pa.array([k[0] for k in keys], pa.string()), pa.array([list(k[1]) for k in keys], pa.list_(pa.float64())), pa.array([k[2] for k in keys], pa.int32()), pa.array([seen[k] for k in keys], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["kind", "looks", "label", "n"])


def train(pages: DataFrame, html: str = "html") -> Model:
    """Weights learnt from blocks of which the markup says what they are, of a bounded sample of pages."""
    total = pages.count()
    share = min(1.0, FIT_PAGES / max(total, 1))
    sample = pages.where(F.pmod(F.xxhash64(*pages.columns), F.lit(1 << 30)) < share * (1 << 30)).select(F.col(html).cast("string").alias("html"))
    rows = sample.mapInArrow(_squares, _SEEN).groupBy("kind", "looks", "label").agg(F.sum("n").alias("n")).collect()
    blocks, model, pairs = [r for r in rows if r.kind != "edge"], untrained(), np.zeros((2, len(SMOOTH)))
    for r in (r for r in rows if r.kind == "edge"):
        pairs[r.label, int(r.looks[0])] += r.n
    model.smooth = fit_smooth(pairs[1], pairs[0])
    if blocks:
        x, y, n = np.array([r.looks for r in blocks]), np.array([r.label for r in blocks]), np.array([float(r.n) for r in blocks])
        model.looks = fit_looks(x, y, n)
        model.markup = fit_markup(np.clip(x @ model.looks, -MOST_LOOKS, MOST_LOOKS), y, n, np.array([r.kind for r in blocks]))
    return model


def extract_text(pages: DataFrame, model: Model | None = None, *, html: str = "html", out: str = "text") -> DataFrame:
    """pages with the main text in `out`: '' where there is none, and for null and empty html.

    Character references are decoded; white space inside a block becomes one space; blocks are joined by an
    empty line.  Pages are looked at one by one and whole, so equal rows have equal texts, and very long pages
    take time in proportion to their blocks; an empty table stays empty.  The model is trained on pages where none is given.
    A column called `out` is replaced, others are kept.
    """
    small_batches(pages.sparkSession)
    model = train(pages, html) if model is None else model

    @F.arrow_udf("string")
    def extract(texts: pa.Array) -> pa.Array:
        return pa.array([main_text(t.as_py(), model) for t in texts], pa.string())

    return pages.withColumn(out, extract(F.coalesce(F.col(html), F.lit(""))))
