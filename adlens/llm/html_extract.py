"""Main text of web pages by minimum-cut labelling of text blocks.

A page is read into blocks of text with their open elements. A linear classifier over tags, class words,
length and share of link text gives each block a score; a positive score is the capacity from the source
(the cost of calling it boilerplate), a negative one that to the sink. Neighbouring blocks, and a block
and the last one of the same container, are joined by edges that weigh less the further apart they lie in
the tree. A maximum flow finds the cheapest labelling; blocks on the source's side are the text.
Pages are independent: Arrow batches, no shuffle.

Defined cases: null and empty pages, and pages without content, give an empty text; a tag cut off at the
end of the page is dropped; an element never closed ends with its parent; `br` and table cells are white
space inside their block; text outside any element is a block; other columns and repeated rows do not matter.
"""

from __future__ import annotations

import html
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>=]++|=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|=)*+)(?P<close>>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)"
    r"|(?P<text>[^<]++|<)",
    re.S,
)
MARKED = re.compile(r"(?:^|\s)(class|id|role|aria-hidden|hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"']+)))?(?=\s|/|$)", re.I)
WORDS = re.compile(r"[a-z]+")

# Element names of HTML and words that sites use in class, id and role.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody "
    "tfoot thead tr ul caption".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SPACE = frozenset("br td th".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes noscript template".split())
UNSEEN = frozenset("head svg math object canvas audio video select datalist button map".split())
BOILERPLATE_TAGS = frozenset("nav footer aside form menu dialog".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
MAIN_TAGS = frozenset("article main".split())
MAIN_WORDS = frozenset("article articlebody content entry main post story".split())
BOILERPLATE_WORDS = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments complementary consent contentinfo cookie "
    "cookies dialog disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice pager pagination popup "
    "promo promotion related respond search share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)

#: Score of a block inside an element that is boilerplate by its name; above all edges of a block together.
CERTAIN = 12.0
BIAS, IN_MAIN, PER_CHAR, MOST_LENGTH, HEADING, LINKS = -1.5, 4.0, 1 / 60, 3.0, 0.5, -4.0
ADJACENT, SAME_CONTAINER = 1.5, 1.0


@dataclass
class Block:
    text: str
    path: tuple[int, ...]  # numbers of the open elements
    score: float


class _Page:
    """Open elements and the block at hand."""

    def __init__(self) -> None:
        self.open: list[tuple[str, int, str]] = []  # name, number, kind
        self.blocks: list[Block] = []
        self.parts: list[str] = []
        self.linked, self.links, self.number = 0, 0, 0

    def kinds(self) -> set[str]:
        return {kind for _, _, kind in self.open}

    def flush(self) -> None:
        if self.parts:
            text = " ".join(html.unescape("".join(self.parts)).split())
            if text:
                self.blocks.append(Block(text, tuple(n for _, n, _ in self.open), self.score(text)))
        self.parts, self.linked = [], 0

    def score(self, text: str) -> float:
        kinds, names = self.kinds(), {name for name, _, _ in self.open}
        heading, inside = bool(names & HEADINGS), "main" in kinds
        if "boilerplate" in kinds or ("header" in kinds and not (inside and heading)):
            return -CERTAIN
        share = min(self.linked / len(text), 1.0)
        return (
            BIAS
            + IN_MAIN * inside
            + min(len(text) * PER_CHAR, MOST_LENGTH)
            + HEADING * heading
            + LINKS * share * (0.25 if inside else 1.0)
        )

    def start(self, name: str, attrs: str) -> None:
        if name in BLOCKS:
            self.flush()
            for k in range(len(self.open) - 1, -1, -1):  # a block ends the paragraph it stands in
                if self.open[k][0] == "p":
                    self.links -= sum(n == "a" for n, _, _ in self.open[k:])
                    del self.open[k:]
                    break
                if self.open[k][0] in BLOCKS:
                    break
        elif name in SPACE:
            self.parts.append(" ")
        if name in VOID:
            return
        self.number += 1
        self.open.append((name, self.number, kind_of(name, attrs)))
        self.links += name == "a"

    def end(self, name: str) -> None:
        if name in BLOCKS:
            self.flush()
        elif name in SPACE:
            self.parts.append(" ")
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == name:
                self.links -= sum(n == "a" for n, _, _ in self.open[k:])
                del self.open[k:]
                return
            if name not in BLOCKS and self.open[k][0] in BLOCKS:
                return  # an inline end tag does not close blocks

    def add(self, text: str) -> None:
        if any(kind == "unseen" for _, _, kind in self.open):
            return
        self.parts.append(text)
        if self.links:
            self.linked += len(text.strip())


def kind_of(name: str, attrs: str) -> str:
    """`unseen`, `boilerplate`, `header`, `main` or nothing, by the element's own name and attributes."""
    if name in UNSEEN:
        return "unseen"
    if name in BOILERPLATE_TAGS:
        return "boilerplate"
    words: set[str] = set()
    for match in MARKED.finditer(attrs) if attrs.strip() else ():
        key, value = match[1].lower(), (match[2] or match[3] or match[4] or "").lower()
        if key == "hidden" or (key == "aria-hidden" and value == "true"):
            return "unseen"
        if key == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                return "unseen"
        else:
            words.update(WORDS.findall(value))
    if name in MAIN_TAGS:
        return "boilerplate" if words & {"comment", "comments", "reply"} else "main"
    if name in ("html", "body"):
        return ""
    if words & BOILERPLATE_WORDS:
        return "boilerplate"
    if name == "header" or "header" in words:
        return "header"
    return "main" if words & MAIN_WORDS else ""


def blocks_of(page: str | None) -> list[Block]:
    state, at, text = _Page(), 0, page or ""
    while at < len(text):
        token = TOKEN.match(text, at)
        at = token.end()
        if token["text"]:
            state.add(token["text"])
        elif token["tag"] and token["close"]:
            name = token["tag"].lower()
            if token["end"]:
                state.end(name)
            elif name in RAW:
                if name in ("iframe", "title", "textarea"):
                    state.parts.append(" ")
                stop = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(text, at)
                at = stop.end() if stop else len(text)
            else:
                state.start(name, token["attrs"])
    state.flush()
    return state.blocks


def edges_of(blocks: list[Block]) -> list[tuple[int, int, float]]:
    """Between neighbours, and between a block and the last one of the same container."""

    def steps(a: Block, b: Block) -> int:
        shared = 0
        for x, y in zip(a.path, b.path, strict=False):
            if x != y:
                break
            shared += 1
        return len(a.path) + len(b.path) - 2 * shared

    out, last = [], {}
    for i, block in enumerate(blocks):
        if i:
            out.append((i - 1, i, ADJACENT / (1 + steps(blocks[i - 1], block))))
        container = block.path[-2] if len(block.path) > 1 else 0
        j = last.get(container)
        if j is not None and j < i - 1:
            out.append((j, i, SAME_CONTAINER / (1 + steps(blocks[j], block))))
        last[container] = i
    return out


def source_side(scores: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """The nodes that a minimum cut leaves with the source (the smallest such set), by blocking flows."""
    n, tiny = len(scores), 1e-9
    rest = list(scores)  # what the source can still send in, or (negative) the sink can still take
    to: list[int] = []
    capacity: list[float] = []
    out: list[list[int]] = [[] for _ in range(n)]
    for a, b, weight in edges:
        for x, y in ((a, b), (b, a)):  # edge e and its reverse e ^ 1
            out[x].append(len(to))
            to.append(y)
            capacity.append(weight)
    while True:
        level = [0 if r > tiny else -1 for r in rest]
        queue, reached = deque(i for i in range(n) if level[i] == 0), False
        while queue:
            x = queue.popleft()
            reached = reached or rest[x] < -tiny
            for e in out[x]:
                if capacity[e] > tiny and level[to[e]] < 0:
                    level[to[e]] = level[x] + 1
                    queue.append(to[e])
        if not reached:
            return [v >= 0 for v in level]
        seen = [0] * n  # edges of a node that are used up in this phase
        for root in range(n):
            while rest[root] > tiny:
                path, x = [], root
                while rest[x] >= -tiny:
                    while seen[x] < len(out[x]):
                        e = out[x][seen[x]]
                        if capacity[e] > tiny and level[to[e]] == level[x] + 1:
                            break
                        seen[x] += 1
                    if seen[x] < len(out[x]):
                        path.append(out[x][seen[x]])
                        x = to[path[-1]]
                    elif path:
                        x = to[path.pop() ^ 1]
                        seen[x] += 1
                    else:
                        break
                if not path:
                    break
                flow = min(rest[root], -rest[x], min(capacity[e] for e in path))
                rest[root] -= flow
                rest[x] += flow
                for e in path:
                    capacity[e] -= flow
                    capacity[e ^ 1] += flow


def main_text(page: str | None) -> tuple[str, int, int]:
    """The text, the number of blocks and the number of those that are content."""
    blocks = blocks_of(page)
    keep = source_side([b.score for b in blocks], edges_of(blocks))
    kept = [b.text for b, k in zip(blocks, keep, strict=True) if k]
    return "\n".join(kept), len(blocks), len(kept)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """`id`, `url`, `text`, `n_blocks`, `n_kept` for every row of `pages`."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = pd.DataFrame([main_text(t) for t in frame["_html"]], columns=["text", "n_blocks", "n_kept"], index=frame.index)
            yield pd.concat([frame[["id", "url"]], out], axis=1)

    kind = pages.schema[id_col].dataType.simpleString()
    rows = pages.select(
        F.col(f"`{id_col}`").cast("string").alias("id"), F.col(f"`{url_col}`").cast("string").alias("url"), F.col(f"`{html_col}`").cast("string").alias("_html")
    )
    # ids travel as text: a batch with a null id would turn numbers into floats
    found = rows.mapInPandas(run, "id string, url string, text string, n_blocks long, n_kept long")
    return found.withColumn("id", F.col("id").cast(kind))
