"""Main text of web pages by composite text density.

Each node of the page's tree gets its characters per tag, lowered for the share of characters and
tags that belong to links. The node whose children have the largest sum of densities holds the
main text; the smallest density on its path to the body is the threshold that other parts must
reach. Elements that are never text (scripts, menus, footers) are left out of the tree. A class
name is only evidence: it takes a part out where the part is a small share of the page (for a
doubtful name, one that is mostly links besides) and otherwise halves its density.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotledger.llm.common import python_tasks

# Names of the HTML standard and of common page parts, fixed values.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed template svg math".split())
DROPPED = frozenset("head nav aside footer dialog menu select button object canvas audio video label legend".split()) | RAW
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr main menu nav ol p pre section summary table ul".split()
)
BLOCKS = CLOSES_P | frozenset("li dt dd tr td th caption tbody thead tfoot body html option".split())
TEXT_LEVEL = frozenset("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd blockquote pre td th tr tbody table figure figcaption center".split())
CONTAINERS = frozenset(("article", "main"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
GENERIC = frozenset("div section table ul ol dl".split())
SIBLING_ENDS = {"li": ("li", {"ul", "ol", "menu"}), "dt": ("dt dd", {"dl"}), "dd": ("dt dd", {"dl"}), "tr": ("tr td th", {"table"}),
                "td": ("td th", {"tr", "table"}), "th": ("td th", {"tr", "table"}), "option": ("option", {"select"})}
PART_NAMES = frozenset(
    "nav navbar navigation menu menus breadcrumb breadcrumbs masthead topbar footer sidebar side aside ad ads adv advert adverts "
    "advertisement advertising sponsor sponsored promo promotion banner notice notices cookie cookies consent gdpr popup modal "
    "newsletter signup subscribe share sharing social related recommended comment comments commentlist respond disqus reply replies "
    "login search searchform widget widgets toolbar pagination pager copyright skip outbrain taboola".split()
)
REPLY_NAMES = frozenset("comment comments reply replies respond".split())

# Words that place a part, and words after which a name tells what its element has or lacks.
LAYOUT_NAMES = frozenset(
    "list area section box block wrap wrapper inner outer container left right top bottom thread form item items post posts "
    "link links bar slot unit content col column row".split()
)
HAVING_NAMES = frozenset("with has have no without is not hide show".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(?P<end>/)?(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^'\">])*+)(?P<stop>>)?", re.DOTALL
)
# For pages with a tag that no bracket or quote ends: tags end at the next bracket, the last one at the end.
PLAIN_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(?P<end>/)?(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>[^>]*+)(?P<stop>>)?", re.DOTALL)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


def name_evidence(value: str) -> int:
    """How far a class, id or role names a part that is no text: 2 plainly, 1 doubtfully, 0 not at all."""
    found = 0
    for token in value.split():
        words = [w.lower() for w in NAME_PART.findall(token) if not w.isdigit()]
        if PART_NAMES.isdisjoint(words):
            continue
        while words[-1] in LAYOUT_NAMES and words[-1] not in PART_NAMES:
            words.pop()
        found = max(found, 2 if words[-1] in PART_NAMES and HAVING_NAMES.isdisjoint(words) else 1)
    return found


class Tree:
    """Nodes in page order: tag, parent, evidence of the name, and pieces of text as (node, text, breaks so far)."""

    def __init__(self, page: str):
        self.tags, self.parents, self.dropped, self.named, self.pieces = ["body"], [-1], [False], [0], []
        # Depths at which elements of a tag, and blocks of any tag, are open.
        self.stack, self.open, self.blocks, self.breaks = [0], {}, [0], 0
        self.within = [False]
        at, token = 0, TOKEN
        while (match := token.search(page, at)) is not None:
            name = (match["name"] or "").lower()
            if name and not match["stop"] and token is TOKEN:
                token = PLAIN_TOKEN
                continue
            if match.start() > at:
                self._text(page[at:match.start()])
            at = match.end()
            if match["end"]:
                self._close(name)
            elif name:
                self._open(name, match["attrs"])
                if name in RAW and not match["attrs"].endswith("/"):
                    end = re.compile(f"</{re.escape(name)}(?![a-z0-9-])", re.IGNORECASE).search(page, at)
                    at = page.find(">", end.end()) + 1 if end else 0
                    at = at or len(page)
                    self._close(name)
        self._text(page[at:])

    def _text(self, text: str) -> None:
        if not self.dropped[self.stack[-1]]:
            self.pieces.append((self.stack[-1], html.unescape(text) if "&" in text else text, self.breaks))

    def _cut(self, depth: int) -> None:
        """Closes all elements from a depth on."""
        for node in reversed(self.stack[depth:]):
            self.open[self.tags[node]].pop()
            if self.tags[node] in BLOCKS:
                self.blocks.pop()
                self.breaks += 1
        del self.stack[depth:]

    def _depth(self, names) -> int:
        return max((self.open[n][-1] for n in names if self.open.get(n)), default=0)

    def _pop_to(self, names, limit: int) -> None:
        """Closes up to the innermost open element of ``names`` that lies deeper than ``limit``."""
        depth = self._depth(names)
        if depth > limit:
            self._cut(depth)

    def _open(self, name: str, attrs: str) -> None:
        if name in ("html", "body"):
            return
        if name in CLOSES_P and self.open.get("p"):
            self._pop_to(("p",), self._depth(("td", "th", "table", "button", "object")))
        if name in SIBLING_ENDS:
            names, limits = SIBLING_ENDS[name]
            self._pop_to(names.split(), self._depth(limits))
        if name in HEADINGS and self.tags[self.stack[-1]] in HEADINGS:
            self._cut(len(self.stack) - 1)
        # What follows an unclosed head is the page.
        if self.open.get("head") and name not in ("head", "meta", "title", "link", "style", "script", "base", "noscript", "template"):
            self._pop_to(("head",), 0)
        parent = self.stack[-1]
        evidence, hidden = self._evidence(name, attrs, self.within[parent])
        self.tags.append(name)
        self.parents.append(parent)
        self.dropped.append(self.dropped[parent] or name in DROPPED or hidden)
        self.named.append(evidence)
        self.within.append(self.within[parent] or name in CONTAINERS)
        self.breaks += name in BLOCKS or name == "br"
        if name not in VOID and not (attrs.endswith("/") and name in ("svg", "path")):
            self.open.setdefault(name, []).append(len(self.stack))
            if name in BLOCKS:
                self.blocks.append(len(self.stack))
            self.stack.append(len(self.tags) - 1)

    def _evidence(self, name: str, attrs: str, within: bool) -> tuple[int, bool]:
        """What the names of an element tell, and whether it is surely left out."""
        if name == "header":
            return 0, not within
        if not attrs or name in ("b", "i", "em", "strong", "a") and "hidden" not in attrs:
            return 0, False
        found = {}
        for a, double, single, bare in ATTRIBUTE.findall(attrs):
            found.setdefault(a.lower(), double or single or bare)
        if "hidden" in found or "display:none" in found.get("style", "").replace(" ", "").lower():
            return 0, True
        names = " ".join(found.get(a, "") for a in ("class", "id", "role"))
        words = {w.lower() for w in NAME_PART.findall(names)}
        if name in CONTAINERS:
            return 0, name_evidence(names) == 2 and not words.isdisjoint(REPLY_NAMES)
        return 2 if not within and "header" in names.lower().split() else name_evidence(names), False

    def _close(self, name: str) -> None:
        if name == "br":
            self._open("br", "")
        elif name not in ("html", "body"):
            # An inline end tag does not close the block around it.
            self._pop_to((name,), 0 if name in BLOCKS or name in DROPPED else self.blocks[-1])


def densities(
    tags: list[str], parents: list[int], chars: list[int], named: list[int] | None = None
) -> tuple[list[float], list[float]]:
    """Composite density of each node and the sum over its children.

    ``chars`` are own characters; evidence of a name halves a node's density.
    """
    n = len(tags)
    c, t, lc, lt = list(chars), [0] * n, [0] * n, [0] * n
    for i in range(n - 1, 0, -1):
        if tags[i] == "a":
            lc[i], lt[i] = c[i], t[i]
        p = parents[i]
        c[p] += c[i]
        t[p] += t[i] + 1
        lc[p] += lc[i]
        lt[p] += lt[i] + (tags[i] == "a")
    share = lc[0] / c[0] if c[0] else 0.0
    density, sums = [0.0] * n, [0.0] * n
    for i in range(n - 1, -1, -1):
        if c[i]:
            base = math.log(c[i] / max(1, c[i] - lc[i]) * lc[i] + share * c[i] + math.e)
            value = c[i] / max(1, lc[i]) * max(1, t[i]) / max(1, lt[i])
            density[i] = c[i] / max(1, t[i]) * max(0.0, math.log(value) / math.log(max(base, 1.0000001)) if base > 1 else math.log(value))
            density[i] /= 2 if named and named[i] else 1
        if i:
            sums[parents[i]] += density[i]
    return density, sums


def left_out(tree: Tree, chars: list[int], links: list[int]) -> list[bool]:
    """Nodes that are no text by their element, or by name and share of the page's characters.

    A form goes unless half of the page lies in it. So does a part with a plain name, or one around
    a smaller share unless an article or main element lies in it; one with a doubtful name goes
    where it is under a quarter of the page and half links.
    """
    tags, parents = tree.tags, tree.parents
    holds = [tag in CONTAINERS and not gone for tag, gone in zip(tags, tree.dropped, strict=True)]
    for i in range(len(tags) - 1, 0, -1):
        holds[parents[i]] = holds[parents[i]] or holds[i]
    total, out = chars[0], list(tree.dropped)
    for i in range(1, len(tags)):
        share, name = chars[i], tree.named[i]
        out[i] = (
            out[i] or out[parents[i]]
            or tags[i] in ("form", "fieldset") and 2 * share < total
            or name == 2 and (2 * share < total or not holds[i] and 10 * share < 9 * total)
            or name == 1 and 4 * share < total and 2 * links[i] >= share
        )
    return out


def _totals(tags: list[str], parents: list[int], chars: list[int]) -> tuple[list[int], list[int]]:
    """Characters and link characters of each node with all below it."""
    c, lc = list(chars), [0] * len(tags)
    for i in range(len(tags) - 1, 0, -1):
        lc[i] = c[i] if tags[i] == "a" else lc[i]
        c[parents[i]] += c[i]
        lc[parents[i]] += lc[i]
    return c, lc


def main_text(page: str | None) -> str:
    """The article of a page; empty where there is none."""
    if not page:
        return ""
    tree = Tree(page)
    n, tags, parents = len(tree.tags), tree.tags, tree.parents
    chars = [0] * n
    for node, text, _ in tree.pieces:
        chars[node] += len("".join(text.split()))
    if not any(chars):
        return ""
    out = left_out(tree, *_totals(tags, parents, chars))
    chars = [0 if gone else c for c, gone in zip(chars, out, strict=True)]
    inside, links = _totals(tags, parents, chars)
    density, sums = densities(tags, parents, chars, tree.named)
    best = max(range(n), key=lambda i: (sums[i] or density[i], -i))
    path, node = [], best
    while node > 0:
        path.append(node)
        node = parents[node]
    on_path = set(path)
    threshold = min((density[i] for i in path), default=density[0])
    root = next((i for i in reversed(path) if tags[i] in CONTAINERS), None)
    if root is None:
        root = best
        while root > 0 and (tags[root] in TEXT_LEVEL or tags[root] not in BLOCKS):
            root = parents[root]
    # Other parts count that are as dense as the path and no part of the chosen one; within it, parts
    # off the path that are thinner and mostly links do not.
    chosen, in_article = [False] * n, [False] * n
    for i in range(n):
        p = parents[i]
        in_article[i] = tags[i] == "article" or i > 0 and in_article[p]
        dense = tags[i] in BLOCKS and sums[i] >= sums[best] / 4 and density[i] >= threshold and i not in on_path
        thin = (
            tags[i] in GENERIC and i not in on_path and density[i] < threshold and 2 * links[i] > inside[i]
            and not (in_article[i] and tags[i] in TEXT_LEVEL)
        )
        above = i > 0 and chosen[p] and not thin
        chosen[i] = i == root or above or (i > 0 and dense and (tags[root] not in CONTAINERS or tags[i] in CONTAINERS))
    found, last = [], -1
    for node, text, breaks in tree.pieces:
        if chosen[node] and not out[node]:
            if breaks != last:
                found.append(" ")
            found.append(text)
            last = breaks
    return " ".join("".join(found).split())


def extract(pages: DataFrame, page: str = "html", text: str = "text") -> DataFrame:
    """``pages`` with the main text in place of the page; null and empty pages have an empty text.

    Markup that is cut off or badly nested is read as far as it goes. Other columns stay; one
    named like the result is replaced.
    """
    python_tasks(pages.sparkSession)
    rest = [f for f in pages.schema.fields if f.name not in (page, text)]
    names = [f.name for f in rest]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([main_text(p) for p in batch.column("__page").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in names), found], names=[*names, text])

    schema = T.StructType(rest).add(text, T.StringType())
    return pages.select(*names, F.col(page).cast("string").alias("__page")).mapInArrow(run, schema)
