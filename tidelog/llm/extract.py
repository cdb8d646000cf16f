"""Main text of web pages by minimum-cut labelling.

A page is split into blocks of text. A classifier gives each block a cost for either label (content, boilerplate) from its
place, names, links and words; these are the capacities to the two terminals. Blocks that follow one another, and blocks
that lie close in the tree, are joined by smoothness edges. The minimum cut is the cheapest labelling.
"""

from __future__ import annotations

import html as entities
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<raw>.*?)(?:\]\]>|\Z)|<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*+)(?P<attrs>(?>[^>"']++|"[^"]*+"|'[^']*+')*+)>|<[/!?A-Za-z][^>]*+(?:>|\Z)""", re.S)
_ATTR = re.compile(r"""(class|id|role|style|hidden|aria-hidden)\s*+(?:=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?""", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

#: Elements whose text is never shown as text of the page, read up to their end tag.
RAW = {"script", "style", "template", "noscript", "iframe", "textarea", "title", "xmp", "noembed", "noframes"}
SKIPPED = {"head", "svg", "canvas", "object", "select", "button", "audio", "video", "math", "datalist"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCKS = set("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
             "header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split())
#: Tags and name parts that speak for boilerplate or for content.
BAD_TAGS = set("nav footer aside form header menu dialog fieldset".split())
GOOD_TAGS = set("article main".split())
BAD_NAMES = set("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert popup modal overlay "
                "sidebar menu nav navbar navigation breadcrumb breadcrumbs footer header masthead topbar comment comments disqus reply replies respond discussion share sharing "
                "social related recommended recommendations newsletter subscribe subscription signup login search form widget widgets pagination pager copyright legal skip toolbar".split())
GOOD_NAMES = set("article articlebody post entry story content main maincontent".split())
#: Costs, in units of log odds.
PLACE, OUTER, WORDS, LINKS, SENTENCE, PROSE, RIGHTS, BIAS = 6.0, 1.0, 0.1, 5.0, 1.0, 1.0, 3.0, 1.2
PROSE_TAGS = set("p blockquote pre h1 h2 h3 h4 h5 h6 figcaption".split())
#: Smoothness: between neighbours, and between the next blocks of one parent, halved for each further level.
NEXT, PROXIMITY = 0.3, 0.8


@dataclass
class Block:
    text: str
    path: tuple[int, ...]
    score: float


@dataclass
class _Open:
    name: str
    number: int
    sign: int  # -1 boilerplate, 1 content, 0 neither
    skipped: bool


@dataclass
class _Page:
    blocks: list[Block] = field(default_factory=list)
    stack: list[_Open] = field(default_factory=list)
    parts: list[tuple[str, bool]] = field(default_factory=list)
    links: int = 0
    number: int = 0

    def flush(self) -> None:
        parts, self.parts = self.parts, []
        text = " ".join(entities.unescape("".join(t for t, _ in parts)).split())
        if text:
            linked = sum(len(t) for t, link in parts if link) / max(1, sum(len(t) for t, _ in parts))
            self.blocks.append(Block(text, tuple(o.number for o in self.stack if o.name not in ("html", "body")), _score(text, linked, self.stack)))


def _sign(name: str, attrs: str) -> int:
    sign = -1 if name in BAD_TAGS else 1 if name in GOOD_TAGS else 0
    if not attrs:
        return sign
    for key, a, b, c in _ATTR.findall(attrs):
        key, value = key.lower(), a or b or c
        if key == "hidden" or (key == "aria-hidden" and value.lower() == "true") or (key == "style" and re.search(r"display\s*:\s*none", value, re.I)):
            return -1
        if key in ("class", "id", "role"):
            names = {x.lower() for x in _NAME.findall(value)}
            if name not in ("html", "body") and names & BAD_NAMES:
                return -1
            if names & GOOD_NAMES and not sign:
                sign = 1
    return sign


def _score(text: str, linked: float, stack: list[_Open]) -> float:
    """Log odds that a block is content. The innermost telling element decides most; a heading looks past a header in an article."""
    heading = any(o.name in ("h1", "h2", "h3", "h4", "h5", "h6") for o in stack[-3:])
    signs = [o.sign for o in reversed(stack) if o.sign and not (heading and o.name == "header" and any(x.sign > 0 for x in stack))]
    score = (PLACE * signs[0] + OUTER * sum(signs[1:])) if signs else 0.0
    words = text.count(" ") + 1
    score += WORDS * min(words, 50) + SENTENCE * (text[-1] in ".!?…:") - LINKS * linked - BIAS
    return score + PROSE * any(o.name in PROSE_TAGS for o in stack[-3:]) - RIGHTS * (words < 25 and "©" in text)


def blocks_of(page: str) -> list[Block]:
    """The page's blocks of text in order, markup gone, character references decoded, white space put right."""
    p = _Page()
    at, end, lowered = 0, len(page), None
    while at < end:
        m = _TAG.search(page, at)
        stop = m.start() if m else end
        hidden = bool(p.stack) and p.stack[-1].skipped
        if stop > at and not hidden:
            p.parts.append((page[at:stop], p.links > 0))
        if not m:
            break
        at = m.end()
        if m["raw"] is not None and not hidden:
            p.parts.append((m["raw"].replace("&", "&amp;"), p.links > 0))
        if not m["name"]:
            continue
        name = m["name"].lower()
        if m["end"]:
            if name in BLOCKS:
                p.flush()
            found = next((i for i in range(len(p.stack) - 1, -1, -1) if p.stack[i].name == name), None)
            # An inline end tag does not close the blocks around it.
            if found is not None and (name in BLOCKS or not any(o.name in BLOCKS for o in p.stack[found + 1:])):
                del p.stack[found:]
                p.links = sum(o.name == "a" for o in p.stack)
            continue
        if name in RAW:
            lowered = lowered if lowered is not None else page.lower()
            close = lowered.find(f"</{name}", at) if len(lowered) == end else next((x.start() for x in re.finditer(f"</{name}", page[at:], re.I)), -1 - at) + at
            at = end if close < 0 else close
            if close >= 0:
                at = (page.find(">", close) + 1) or end
            continue
        if name == "br" or name == "wbr":
            p.parts.append((" " if name == "br" else "", p.links > 0))
            continue
        if name in BLOCKS:
            p.flush()
            _imply_ends(p, name)
        if name in VOID or m["attrs"].endswith("/"):
            continue
        p.number += 1
        p.stack.append(_Open(name, p.number, _sign(name, m["attrs"]), hidden or name in SKIPPED))
        p.links += name == "a"
    p.flush()
    return p.blocks


def _imply_ends(p: _Page, name: str) -> None:
    """A new block ends an open paragraph; a new item, row or cell ends the one before it."""
    closes = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "body": ("head",)}.get(name, ())
    for i in range(len(p.stack) - 1, -1, -1):
        open_name = p.stack[i].name
        if open_name == "p" or open_name in closes:
            del p.stack[i:]
            p.links = sum(o.name == "a" for o in p.stack)
            if open_name != "p":
                return
        elif open_name in BLOCKS:
            return


def _edges(blocks: list[Block]) -> dict[tuple[int, int], float]:
    out: dict[tuple[int, int], float] = {}
    last: dict[int, int] = {}
    for i, block in enumerate(blocks):
        if i:
            out[i - 1, i] = out.get((i - 1, i), 0.0) + NEXT
        weight = PROXIMITY
        # The block's own element stands last; the ones above it are shared with other blocks.
        for depth in range(len(block.path) - 2, max(-1, len(block.path) - 5), -1):
            node = block.path[depth]
            if node in last and last[node] != i:
                out[last[node], i] = out.get((last[node], i), 0.0) + weight
            weight /= 2
        for node in block.path:
            last[node] = i
    return out


def minimum_cut(scores: list[float], edges: dict[tuple[int, int], float]) -> list[bool]:
    """True for nodes on the content side of a minimum cut, found by blocking flows (levels by breadth, then advances)."""
    n = len(scores)
    source, sink = n, n + 1
    graph: list[dict[int, float]] = [{} for _ in range(n + 2)]
    for i, s in enumerate(scores):
        # What flows straight through a node (source, node, sink) is taken off at once: only the difference is left.
        if s > 0:
            graph[source][i], graph[i][source] = s, 0.0
        elif s < 0:
            graph[i][sink], graph[sink][i] = -s, 0.0
    for (a, b), w in edges.items():
        graph[a][b] = graph[a].get(b, 0.0) + w
        graph[b][a] = graph[b].get(a, 0.0) + w
    while True:
        level = {source: 0}
        queue = deque([source])
        while queue and sink not in level:
            a = queue.popleft()
            for b, c in graph[a].items():
                if c > 1e-9 and b not in level:
                    level[b] = level[a] + 1
                    queue.append(b)
        if sink not in level:
            return [i in level for i in range(n)]
        targets = {a: [b for b in graph[a] if level.get(b) == level[a] + 1] for a in level}
        path = [source]
        while path:
            a = path[-1]
            if a == sink:
                flow = min(graph[u][v] for u, v in zip(path, path[1:], strict=False))
                cut = len(path)
                for k, (u, v) in enumerate(zip(path, path[1:], strict=False)):
                    graph[u][v] -= flow
                    graph[v][u] = graph[v].get(u, 0.0) + flow
                    if graph[u][v] <= 1e-9:
                        cut = min(cut, k + 1)
                del path[cut:]
                continue
            # The last target is tried until its edge is full or it leads nowhere.
            ahead = targets[a]
            while ahead and graph[a][ahead[-1]] <= 1e-9:
                ahead.pop()
            if ahead:
                path.append(ahead[-1])
            else:
                path.pop()
                if path:
                    targets[path[-1]].pop()


def main_text(page: str) -> str:
    """The content blocks of a page, joined by line feeds."""
    blocks = blocks_of(page)
    keep = minimum_cut([b.score for b in blocks], _edges(blocks))
    return "\n".join(b.text for b, k in zip(blocks, keep, strict=True) if k)


def extract(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url"), html: str = "html") -> DataFrame:
    """One row per row of pages: the columns of keep, text (empty if there is none) and n_chars (its code points).

    Null html is an empty page. Broken markup is read as far as it goes; nothing of a content block is dropped, however long
    it is. Repeated rows each get their row.
    """
    schema = T.StructType([*[pages.schema[k] for k in keep], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def act(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py() or "") for x in batch.column("__html")]
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in keep], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[f.name for f in schema])

    return pages.select(*keep, F.col(html).alias("__html")).mapInArrow(act, schema)
