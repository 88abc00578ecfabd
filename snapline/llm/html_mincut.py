"""Main text of web pages by minimum-cut labelling of their blocks."""

from __future__ import annotations

import html
import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import log

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapline.llm.common import small_batches

# How HTML elements are read.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea iframe object svg math title select".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu "
    "nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCK - {"html", "head", "body", "option", "optgroup"}
SAME = {"li": "li", "dt": "dd dt", "dd": "dd dt", "tr": "tr td th", "td": "td th", "th": "td th",
        "option": "option", "p": "p"}
# Elements, roles and class names that say what a part of a page is for.
OUT_TAGS = frozenset("nav aside footer form button menu dialog fieldset".split())
IN_TAGS = frozenset("article main".split())
OUT_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu "
                      "menubar toolbar alertdialog".split())
OUT_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments "
    "consent cookie cookies copyright discussion disqus foot footer gdpr header legal login masthead "
    "menu modal nav navbar navigation newsletter notice notices overlay pager pagination popup promo "
    "promotion recommended related replies reply respond search share sharing sidebar signup skip "
    "social sponsor sponsored subscribe tags toolbar topbar widget widgets".split())
IN_WORDS = frozenset("article body content entry main post story text".split())
# Class names of what others wrote or sell; an article inside stays theirs.
FIRM_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising comment comments consent cookie cookies discussion disqus "
    "gdpr promo promotion recommended related replies reply respond sponsor sponsored".split())
FIRM_TAGS = frozenset("nav aside footer button menu dialog".split())
# Evidence of an element fades by this factor with every element it is nested deeper.
FADE = 0.9
# A wrapper with at least this share of a page's unlinked text is the page, whatever its class says.
WRAPPER = 0.6

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|"
                    r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
_ATTR = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_READ = frozenset("class id role hidden aria-hidden style".split())
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_NAME = re.compile(r"[a-z]+")


@dataclass
class Element:
    tag: str
    depth: int
    parent: "Element | None"
    out: bool = False       # inside something set apart from the text around it
    firm: bool = False      # by a tag or a name that an article inside does not undo
    hidden: bool = False
    own: float | None = None    # its own evidence: 1 main text, -1 boilerplate, None none
    loose: bool = False     # that evidence is a class name or a form: a wrapper may have it too
    hint: int = 0           # weak evidence of class names
    lean: float = 0.0       # evidence for what is inside: its own, or its parent's, faded


@dataclass
class Block:
    element: Element
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""


def _names(raw: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(raw)]


def _open(tag: str, attrs: str, parent: Element | None) -> Element:
    e = Element(tag, parent.depth + 1 if parent else 0, parent)
    if parent:
        e.out, e.firm, e.hidden, e.lean = parent.out, parent.firm, parent.hidden, parent.lean
    content = tag in IN_TAGS
    found: list[tuple[float, bool, bool]] = []          # evidence, firm, loose
    if tag in OUT_TAGS:
        found.append((-1.0, tag in FIRM_TAGS, tag not in FIRM_TAGS))
    elif tag == "header" and e.lean <= 0:
        found.append((-1.0, False, False))
    for name, a, b, c in _ATTR.findall(attrs) if attrs and tag not in ("html", "body") else ():
        name, value = name.lower(), a or b or c
        if name not in _READ:
            continue
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            e.hidden = True
        elif name == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                e.hidden = True
        elif name == "role":
            if value.lower() in OUT_ROLES:
                found.append((-1.0, value.lower() != "form", False))
            elif value.lower() in IN_TAGS:
                content = True
        elif name in ("class", "id"):
            for one in value.split():
                words = _names(one)
                bad = [w for w in words if w in OUT_WORDS]
                good = [w for w in words if w in IN_WORDS]
                # The name begins with what the element is; an article's must say nothing else.
                if bad and words[0] in OUT_WORDS and not good and (len(bad) == len(words) or not content):
                    found.append((-1.0, any(w in FIRM_WORDS for w in bad), True))
                elif bad and not good:
                    if not content:
                        found.append((-0.5, False, True))
                    e.hint -= 1
                elif good and not bad:
                    e.hint += 1
    if found:
        e.own = min(v for v, _, _ in found)
        e.firm = e.firm or any(f for _, f, _ in found)
        e.loose = all(l for _, _, l in found)
    elif content and not e.firm:
        e.own, e.out = 1.0, False
    if e.own == -1.0 or e.hidden:
        e.out = True
    e.lean = e.own if e.own is not None else (parent.lean * FADE if parent else 0.0)
    return e


def _settle(elements: list[Element], blocks: list[Block]) -> None:
    """Evidence of every element once the whole page is known: that of a wrapper by a class name
    or a form is left out when most of the page's unlinked text is inside and no article is
    outside of it. Elements come parents first."""
    number = {id(e): i for i, e in enumerate(elements)}
    mass = [0] * len(elements)
    held = [0] * len(elements)                          # of it in articles
    for b in blocks:
        if not b.element.hidden:
            mass[number[id(b.element)]] += max(0, sum(map(len, b.parts)) - b.linked)
    for i in range(len(elements) - 1, 0, -1):
        up = number[id(elements[i].parent)]
        if elements[i].own == 1.0:
            held[i] = mass[i]
        mass[up] += mass[i]
        held[up] += held[i]
    for i, e in enumerate(elements):
        own = e.own
        if (own is not None and own < 0 and e.loose and not e.firm and mass[i] >= WRAPPER * max(1, mass[0])
                and held[i] == held[0]):
            own = None
        e.lean = own if own is not None else (e.parent.lean * FADE if e.parent else 0.0)


def blocks_of(page: str) -> list[Block]:
    """The page's text blocks in order, white space folded, empty ones left out. Unclosed and
    crossed elements are closed as a browser would; a page cut off in a tag ends before it."""
    root = Element("html", 0, None)
    stack = [root]
    elements = [root]
    opened: Counter = Counter()                         # open elements by tag
    out: list[Block] = []
    current: Block | None = None
    links = 0
    at, n = 0, len(page)

    def text(raw: str) -> None:
        nonlocal current
        if not raw:
            return
        if current is None:
            if not raw.strip():
                return
            home = next((e for e in reversed(stack) if e.tag in BLOCK), root)
            inner = stack[-1]
            if inner.out and not home.out:
                home = inner
            current = Block(home)
            out.append(current)
        t = html.unescape(raw)
        current.parts.append(t)
        if links:
            current.linked += len(t)

    def close(i: int) -> None:
        nonlocal links, current
        for e in stack[i:]:
            opened[e.tag] -= 1
            if e.tag == "a":
                links -= 1
            if e.tag in BLOCK or e.out and not (e.parent and e.parent.out):
                current = None
        del stack[i:]

    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            text(page[at:])
            break
        m = _TOKEN.match(page, lt) or _LOOSE.match(page, lt)
        if m is None:
            if lt + 1 < n and (page[lt + 1].isalpha() or page[lt + 1] in "/!?"):
                text(page[at:lt])           # cut off inside a tag, or a stray close
                gt = page.find(">", lt)
                if gt < 0:
                    break
                at = gt + 1
            else:
                text(page[at:lt + 1])
                at = lt + 1
            continue
        text(page[at:lt])
        at = m.end()
        tag = (m.group(2) or "").lower()
        if not tag:
            continue
        if m.group(1):
            if opened[tag]:
                close(next(i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag))
            elif tag in BLOCK:
                current = None
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else n
            continue
        if tag in VOID:
            if tag in BLOCK:
                current = None
            elif tag == "br":
                text(" ")
            continue
        if tag in CLOSES_P and opened["p"]:
            close(next(i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == "p"))
        group = SAME[tag].split() if tag in SAME else []
        if any(opened[g] for g in group):
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in group:
                    close(i)
                    break
                if stack[i].tag in ("ul", "ol", "dl", "table", "tbody", "thead", "select", "div"):
                    break
        e = _open(tag, m.group(3), stack[-1])
        if tag in BLOCK or e.out and not stack[-1].out:
            current = None
        if tag == "a":
            links += 1
        opened[tag] += 1
        elements.append(e)
        stack.append(e)
    for b in out:
        b.text = " ".join("".join(b.parts).split())
    _settle(elements, out)
    return [b for b in out if b.text]


def features(b: Block, place: float) -> list[str]:
    """What the classifier sees of a block: its own text and element, not where it is nested."""
    words = b.text.count(" ") + 1
    share = b.linked / max(1, sum(map(len, b.parts)))
    size = next(i for i, top in enumerate((2, 5, 10, 20, 40, 1 << 62)) if words <= top)
    tag = "h" if b.element.tag[0] == "h" and b.element.tag[1:].isdigit() else b.element.tag
    return [f"tag={tag}", f"words={size}", f"links={min(3, int(share * 4))}",
            f"stop={b.text[-1] in '.!?…”»'}", f"comma={',' in b.text}",
            f"sign={any(c in b.text for c in '©®|»›·')}", f"hint={max(-1, min(1, b.element.hint))}",
            f"place={int(place * 5) if place < 1 else 4}", f"depth={min(b.element.depth, 9) // 3}"]


def seed(b: Block) -> float:
    """Evidence of structure alone: 1 main text, -1 boilerplate, weaker the deeper it is nested;
    what is hidden is certain."""
    return -2.0 if b.element.hidden else b.element.lean


def _count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in frames:
        seen: Counter = Counter()
        for page in pdf["html"]:
            bs = blocks_of(page)
            for i, b in enumerate(bs):
                lean = seed(b)
                side = 1 if lean >= 0.3 else -1 if lean <= -0.3 else 0
                if side:
                    seen[("", side)] += 1
                    seen.update((f, side) for f in features(b, i / len(bs)))
        if seen:
            yield pd.DataFrame([(f, s, n) for (f, s), n in seen.items()], columns=["f", "side", "n"])


def train(pages: DataFrame) -> dict[str, float]:
    """Log-odds of main text for each feature (naive Bayes), from all blocks of all pages whose
    structure says what they are. Features are a fixed set of a few dozen, so what comes to the
    driver does not grow with the pages."""
    counts = (pages.select(F.coalesce("html", F.lit("")).alias("html"))
              .mapInPandas(_count, "f string, side long, n long")
              .groupBy("f", "side").agg(F.sum("n").alias("n")).collect())
    n = {(r["f"], r["side"]): r["n"] for r in counts}
    total = {s: n.get(("", s), 0) for s in (1, -1)}
    # Features of one block depend on each other, so none may speak too loudly.
    return {f: max(-1.5, min(1.5, log((n.get((f, 1), 0) + 1) / (total[1] + 2))
                             - log((n.get((f, -1), 0) + 1) / (total[-1] + 2)))) for f, _ in n if f}


def max_flow_side(gain: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Minimum cut: which nodes stay on the source side.

    ``gain[i]`` > 0 is what labelling node i boilerplate costs (its source capacity), < 0 what
    labelling it content costs (its sink capacity); an edge costs its weight when its ends get
    different labels. Dinic's algorithm: shortest-path levels, then blocking flows.
    """
    n = len(gain)
    s, t = n, n + 1
    to: list[int] = []
    cap: list[float] = []
    adj: list[list[int]] = [[] for _ in range(n + 2)]

    def add(u: int, v: int, forth: float, back: float) -> None:
        adj[u].append(len(to))
        to.append(v)
        cap.append(forth)
        adj[v].append(len(to))
        to.append(u)
        cap.append(back)

    for i, g in enumerate(gain):
        if g > 0:
            add(s, i, g, 0.0)
        elif g < 0:
            add(i, t, -g, 0.0)
    for u, v, w in edges:
        add(u, v, w, w)
    while True:
        level = [-1] * (n + 2)
        level[s] = 0
        queue = deque([s])
        while queue:
            u = queue.popleft()
            for e in adj[u]:
                if cap[e] > 1e-9 and level[to[e]] < 0:
                    level[to[e]] = level[u] + 1
                    queue.append(to[e])
        if level[t] < 0:
            return [level[i] >= 0 for i in range(n)]
        nxt = [0] * (n + 2)
        path: list[int] = []
        u = s
        while True:
            if u == t:
                push = min(cap[e] for e in path)
                for e in path:
                    cap[e] -= push
                    cap[e ^ 1] += push
                cut = next(i for i, e in enumerate(path) if cap[e] <= 1e-9)
                u = to[path[cut] ^ 1]
                del path[cut:]
                continue
            while nxt[u] < len(adj[u]):
                e = adj[u][nxt[u]]
                if cap[e] > 1e-9 and level[to[e]] == level[u] + 1:
                    break
                nxt[u] += 1
            if nxt[u] < len(adj[u]):
                path.append(adj[u][nxt[u]])
                u = to[path[-1]]
            elif path:
                u = to[path.pop() ^ 1]
                nxt[u] += 1
            else:
                break


def label(bs: list[Block], odds: dict[str, float], *, structure: float = 5.0, near: float = 0.6,
          family: float = 0.6) -> list[bool]:
    """Which blocks are main text. The classifier weighs up to 4 and structure up to ``structure``
    (fading with depth), so that a block's text, its neighbours and its parent's other blocks can
    overrule what its nesting says; nothing but hidden blocks is settled beforehand."""
    gain = []
    for i, b in enumerate(bs):
        own = sum(odds.get(f, 0.0) for f in features(b, i / len(bs)))
        gain.append(max(-4.0, min(4.0, own)) + structure * seed(b))
    if all(g >= 0 for g in gain) or all(g <= 0 for g in gain):
        return [g > 0 for g in gain]
    edges = [(i, i + 1, near) for i in range(len(bs) - 1)]
    last: dict[int, int] = {}
    for i, b in enumerate(bs):
        parent = id(b.element.parent)
        if parent in last and last[parent] != i - 1:
            edges.append((last[parent], i, family))
        elif parent in last:
            edges[last[parent]] = (i - 1, i, near + family)
        last[parent] = i
    return max_flow_side(gain, edges)


def main_text(page: str, odds: dict[str, float]) -> str:
    """The main text's blocks, two line breaks between them; empty if there are none."""
    bs = blocks_of(page)
    return "\n\n".join(b.text for b, keep in zip(bs, label(bs, odds) if bs else []) if keep)


def extract(pages: DataFrame, odds: dict[str, float] | None = None) -> DataFrame:
    """``pages`` with ``text``, the main text of the whole ``html``, and ``n_chars``, its code points.

    Every block gets a cost for either label: the classifier's log-odds, and more where the
    page's own structure speaks. Blocks next to each other, and blocks of one parent, are joined
    by smoothness edges; the minimum cut gives the labels. The classifier is trained on all pages
    (see :func:`train`) unless ``odds`` is given. Pages are independent: nothing is shuffled but
    the classifier's counts.

    A null or empty page has the empty text. Repeated pages are extracted alike. Columns named
    text or n_chars are replaced; all others stay. No rows, no result.
    """
    small_batches(pages.sparkSession)
    odds = train(pages) if odds is None else odds
    keep = [f for f in pages.schema.fields if f.name not in ("text", "n_chars")]
    schema = T.StructType([*keep, T.StructField("text", T.StringType()),
                           T.StructField("n_chars", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(p, odds) if p else "" for p in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                [*b.schema.names, "text", "n_chars"])

    return pages.select(*[f.name for f in keep]).mapInArrow(run, schema)
