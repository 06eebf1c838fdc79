"""HTML extraction (operator 10): minimum-cut labelling of a page's blocks.

A page is read once into text blocks in page order.  A logistic classifier
scores each block from the elements around it, the share of its text in links,
its length and punctuation; the costs of the two labels are the capacities of
its edges to the terminals.  Neighbouring blocks, and blocks with the same
parent element, are tied by smoothness edges; the maximum flow separates
content from boilerplate.  A block whose classifier outweighs all its ties keeps
its label in every minimum cut, so it is settled first and only the undecided
blocks go into the flow network.

An element whose class says nothing but boilerplate (``sidebar``) is that with
all it holds; a word among others (``has-sidebar``) outside content is a cost
that an article or main inside it, or a block's long text, outweighs.

Each page is one row's work: pages never meet, nothing is shuffled.

Text: character references are decoded, white space inside a block becomes one
space, blocks are joined by one newline; ``br`` counts as white space.  Scripts,
styles, templates, form fields and comments in the markup are no text.  Defined
cases: null or empty html, and pages without content, give the empty string;
markup that the page leaves open (a cut-off page) ends with the page, but an
element without text (a script, a drawing) that is left open ends with its
parent, and a head with the first element that is none of its own; rows are
independent, so repeated rows give repeated results; extra columns are ignored.
"""

from __future__ import annotations

import html as _html
import math
import re
from collections import deque
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*+)(?P<attrs2>[^>]*+)(?:>|\Z)"
    r"|</[^>]*+(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
WORD = re.compile(r"[a-z]+|[A-Z][a-z]*|[0-9]+")
SENTENCE_END = re.compile(r"[.!?:;\"'”»)\]。！？]\Z")

SKIPPED = {"script", "style", "template", "textarea", "select", "title", "noscript", "iframe", "svg", "object", "audio", "video", "canvas"}
RAW = {"script", "style", "textarea", "title"}  # their content is no markup
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "button", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt",
         "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "legend", "li", "main",
         "menu", "nav", "ol", "option", "p", "pre", "search", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
BOILER_TAGS = {"nav", "header", "footer", "aside", "form", "button", "menu", "dialog", "fieldset", "search"}
CONTENT_TAGS = {"article", "main"}
BOILER_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu", "menubar", "alertdialog"}
BOILER_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion", "banner", "nav", "navbar",
                "navigation", "menu", "breadcrumb", "breadcrumbs", "sidebar", "aside", "rail", "widget", "widgets", "footer", "header", "masthead", "topbar",
                "cookie", "cookies", "consent", "gdpr", "notice", "notification", "alert", "comment", "comments", "disqus", "respond", "reply", "replies", "share",
                "sharing", "social", "related", "recommended", "newsletter", "subscribe", "subscription", "signup", "login", "popup", "modal", "overlay", "copyright",
                "pagination", "pager", "toolbar", "legal", "disclaimer"}
CONTENT_WORDS = {"article", "articlebody", "content", "post", "entry", "story", "body", "main", "text"}

# classifier weights (log odds of content) and smoothness
BASE, INSIDE, OUTSIDE, BOILER, HINTED = -0.5, 4.0, -4.0, -30.0, -4.0
PER_WORD, MOST_WORDS, MOST_HINTED, ENDS, HEADING, ITEM, LINKS = 0.06, 3.0, 6.0, 0.6, 0.6, -0.4, -4.0
ADJACENT, SAME_PARENT = 0.8, 0.7


@dataclass
class Block:
    parent: int
    tag: str
    boiler: bool
    inside: bool
    hinted: bool = False
    text: str = ""
    linked: int = 0
    parts: list = field(default_factory=list)


def _marks(tag: str, attrs: str) -> tuple[bool, bool, bool]:
    """Whether an element says by itself that it is boilerplate, or content, or has a name with a word of boilerplate among others."""
    boiler, content, hinted = tag in BOILER_TAGS, tag in CONTENT_TAGS, False
    if attrs and tag not in ("html", "body"):
        for name, a, b, c in ATTRIBUTE.findall(attrs):
            value = a or b or c
            if name.lower() == "role":
                boiler |= value.strip().lower() in BOILER_ROLES
                content |= value.strip().lower() in ("main", "article")
                continue
            for name_part in value.split():
                words = [w.lower() for w in WORD.findall(name_part)]
                said = [w in BOILER_WORDS for w in words]
                boiler |= bool(said) and all(said) and not content
                hinted |= any(said) and not content
                content |= bool(words) and all(w in CONTENT_WORDS for w in words)
    return boiler, content, hinted


def _skip(html: str, at: int, tag: str, stack: list, unclosed: set) -> int:
    """Where a skipped element ends whose opening tag ended at ``at``: at its own end or, if that is missing, at its parent's."""
    if tag in RAW and tag not in unclosed:
        close = re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(html, at)
        if close:
            return close.end()
        unclosed.add(tag)
    parents = {x[0] for x in stack} | {"body", "html", "head"}
    deep, inner, foreign = 1, {}, 0
    while m := TOKEN.search(html, at):
        name = m["tag"] or m["tag2"]
        if name:
            name = name.lower()
            end = bool(m["end"] or m["end2"])
            if name == tag:
                deep += -1 if end else not (m["attrs"] or "").rstrip().endswith("/")
                if not deep:
                    return m.end()
            elif name == "foreignobject":
                foreign += -1 if end else 1
            elif name == "body" and not end:
                return m.start()
            elif name in RAW and not end and tag not in RAW and not (m["attrs"] or "").rstrip().endswith("/"):
                close = re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(html, m.end())
                at = close.end() if close else m.end()
                continue
            elif name in BLOCK or "-" in name or name == "head":
                if end:
                    if inner.get(name):
                        inner[name] -= 1
                    elif name in parents:
                        return m.start()
                elif tag == "svg" and foreign <= 0:  # such an element ends a drawing
                    return m.start()
                elif name not in VOID:
                    inner[name] = inner.get(name, 0) + 1
        at = m.end()
    return len(html)


def blocks_of(html: str) -> list[Block]:
    """Text blocks of a page in page order."""
    out: list[Block] = []
    # tag, element number, boilerplate, inside content, named with a word of boilerplate
    stack: list[tuple[str, int, bool, bool, bool]] = [("", 0, False, False, False)]
    unclosed: set[str] = set()
    number = 0
    links = 0
    current: Block | None = None

    def take(raw: str) -> None:
        nonlocal current
        if current is None:
            if raw.isspace():
                return
            tag, parent, boiler, inside, hinted = stack[-1]
            if tag in ("p", "li", "h1", "h2", "h3", "h4", "h5", "h6", "td", "dd", "dt") and len(stack) > 1:
                parent = stack[-2][1]
            current = Block(parent, tag, boiler, inside, hinted)
        current.parts.append(raw)
        if links:
            current.linked += len(raw)

    def flush() -> None:
        nonlocal current, links
        links = 0
        if current is not None:
            text = " ".join(_html.unescape("".join(current.parts)).split())
            if text:
                current.text = text
                out.append(current)
            current = None

    at = 0
    while True:
        m = TOKEN.search(html, at)
        if m is None:
            break
        if m.start() > at:
            take(html[at:m.start()])
        at = m.end()
        tag = m["tag"] or m["tag2"]
        if tag is None:
            continue
        tag = tag.lower()
        end = bool(m["end"] or m["end2"])
        if tag in SKIPPED:
            if not end and not (m["attrs"] or "").rstrip().endswith("/"):
                at = _skip(html, at, tag, stack, unclosed)
            continue
        if tag == "br":
            if current is not None:
                current.parts.append(" ")
        elif tag == "a":
            links = 0 if end else 1
        elif tag in BLOCK or "-" in tag:
            flush()
            if end:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == tag:
                        del stack[k:]
                        break
            elif tag not in VOID:
                if stack[-1][0] == "p" or stack[-1][0] == tag and tag in ("li", "dt", "dd", "tr", "td", "th", "option"):
                    stack.pop()
                number += 1
                boiler, content, hinted = _marks(tag, m["attrs"] or m["attrs2"] or "")
                _, _, over, inside, named = stack[-1]
                # inside content, and on a content element of that name, a word of boilerplate says what it says; outside, content ends it
                stack.append((tag, number, over or boiler or hinted and inside, inside or content, hinted or named and not content))
    if at < len(html):
        rest = html[at:]
        cut = re.search(r"<[/a-zA-Z!?][^>]*\Z", rest)
        take(rest[:cut.start()] if cut else rest)
    flush()
    return out


def log_odds(b: Block, has_content: bool) -> float:
    """The classifier: log odds that a block is content."""
    most = MOST_HINTED if b.hinted else MOST_WORDS
    z = BASE + HINTED * b.hinted + min(most, PER_WORD * (b.text.count(" ") + 1)) + LINKS * min(1.0, b.linked / len(b.text))
    z += ENDS * bool(SENTENCE_END.search(b.text)) + HEADING * (b.tag in ("h1", "h2", "h3", "h4", "h5", "h6")) + ITEM * (b.tag in ("li", "td", "th"))
    z += (INSIDE if b.inside else OUTSIDE) if has_content else 0.0
    return z + BOILER * b.boiler


def minimum_cut(content: list[float], boiler: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Labels (True: content) of least total cost: ``content[i]`` / ``boiler[i]`` for a label, an edge's weight where its ends differ.

    Shortest augmenting paths; the source side of the cut is content.
    """
    n = len(content)
    source, sink = n, n + 1
    to: list[int] = []
    room: list[float] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def edge(a: int, b: int, forth: float, back: float) -> None:
        for x, y, c in ((a, b, forth), (b, a, back)):
            out[x].append(len(to))
            to.append(y)
            room.append(c)

    for i in range(n):
        edge(source, i, boiler[i], 0.0)  # cut when i is boilerplate
        edge(i, sink, content[i], 0.0)
    for a, b, w in edges:
        edge(a, b, w, w)
    while True:
        by = [-1] * (n + 2)
        queue = deque([source])
        while queue and by[sink] < 0:
            x = queue.popleft()
            for e in out[x]:
                if room[e] > 1e-12 and by[to[e]] < 0 and to[e] != source:
                    by[to[e]] = e
                    queue.append(to[e])
        if by[sink] < 0:
            return [by[i] >= 0 for i in range(n)]
        path, x = [], sink
        while x != source:
            path.append(by[x])
            x = to[by[x] ^ 1]
        flow = min(room[e] for e in path)
        for e in path:
            room[e] -= flow
            room[e ^ 1] += flow


def label(blocks: list[Block]) -> list[bool]:
    """Which blocks are content."""
    has_content = any(b.inside and not b.boiler for b in blocks)
    z = [log_odds(b, has_content) for b in blocks]
    ties: list[dict[int, float]] = [{} for _ in blocks]

    def tie(a: int, b: int, w: float) -> None:
        ties[a][b] = ties[a].get(b, 0.0) + w
        ties[b][a] = ties[b].get(a, 0.0) + w

    last: dict[int, int] = {}
    for i, b in enumerate(blocks):
        if i:
            tie(i - 1, i, ADJACENT)
        if b.parent in last:
            tie(last[b.parent], i, SAME_PARENT)
        last[b.parent] = i
    settled: dict[int, bool] = {}
    for i, odds in enumerate(z):
        if abs(odds) > sum(ties[i].values()):
            settled[i] = odds > 0
    free = [i for i in range(len(blocks)) if i not in settled]
    if free:
        place = {i: k for k, i in enumerate(free)}
        cost_content = [math.log1p(math.exp(-z[i])) for i in free]
        cost_boiler = [math.log1p(math.exp(z[i])) for i in free]
        edges = []
        for i in free:
            for j, w in ties[i].items():
                if j in settled:
                    (cost_boiler if settled[j] else cost_content)[place[i]] += w
                elif i < j:
                    edges.append((place[i], place[j], w))
        settled.update(zip(free, minimum_cut(cost_content, cost_boiler, edges)))
    return [settled[i] for i in range(len(blocks))]


def main_text(html: str | None) -> str:
    """Main text of a page."""
    blocks = blocks_of(html or "")
    return "\n".join(b.text for b, keep in zip(blocks, label(blocks)) if keep)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars: one row a page."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = [main_text(h) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                             names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")) \
        .mapInArrow(run, "page_id long, url string, text string, n_chars long")
