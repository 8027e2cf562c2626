"""Makes elements of a page end at their own end tag, for pattern matching.

An element pattern follows elements of its kind inside others some levels down by itself. Pages
that go deeper, or leave elements open, first get the depth of each element written into its
tags, worked out tag by tag; the same patterns then end an element at the tag of its depth.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Elements fields lie in. Fixed by the page templates; ``div`` is for listings only.
BLOCKS = ("ul", "ol", "li", "table", "tr", "td", "th")
LISTING_BLOCKS = ("div",)
LISTS = ("ul", "li")
#: Levels that patterns follow without marks; pages that go deeper are marked.
LEVELS = {"div": 24}
OTHER_LEVELS = 6
_CHUNK = 512


def _inside(tag: str, levels: int) -> str:
    """What may stand in an element: text, other tags and whole elements of its kind, no loose tag of it."""
    whole = rf"|{tag}(?=[\s/>])[^>]*>{_inside(tag, levels - 1)}</{tag}\s*>" if levels else ""
    return rf"[^<]*+(?:<(?:(?!/?{tag}[\s/>]){whole})[^<]*+)*+"


def element(tag: str, label: int = 1, attribute: str = "") -> str:
    """A whole element; ``label`` is the number of the group that holds its depth in marked pages.

    It begins with the one text that both forms share, for which a page is scanned fast.
    """
    rest = rf"(?=[\s>])[^>]*{attribute}[^>]*>"
    return rf"<{tag}(?:{rest}{_inside(tag, LEVELS.get(tag, OTHER_LEVELS))}</{tag}\s*>|#(\d+){rest}.*?</{tag}#\{label}\s*>)"


def inside(whole: Column) -> Column:
    """An element without its own two tags."""
    return F.regexp_extract(whole, r"(?s)^<[^>]*+>(.*)</", 1)


def _flat() -> str:
    """A page of lists that hold only items, and items that hold no list, with small tags."""
    text = rf"[^<]*+(?:<(?!/?(?i:{'|'.join(LISTS)}))[^<]*+)*+"
    start, end = (lambda tag: rf"<{tag}(?:\s[^<>]*+)?+>"), (lambda tag: rf"</{tag}\s*+>")
    item = rf"{start('li')}{text}{end('li')}{text}"
    return rf"\A{text}(?:{start('ul')}{text}(?:{item})*+{end('ul')}{text})*+\z"


def flat(html: Column) -> Column:
    """Whether lists and items can be cut out by plain text: nothing else on the page begins as their tags do."""
    return html.rlike(_flat())


def cut(node: Column, tag: str, last: int) -> Column:
    """A flat page's node cut before every start and end tag, up to the element ``last``; the pieces 1, 3, 5 are in elements."""
    return F.split(node, f"</?{tag}", 2 * last + 1)


def cut_text(piece: Column) -> Column:
    """The piece without the end of its start tag."""
    return F.substring(piece, F.instr(piece, ">") + 1, F.length(piece))


def _nested(*tags: str) -> str:
    """One of the tags that is opened again before it has ended, whether nested or left open."""
    again = "|".join(rf"{tag}(?=[\s/>])[^<]*+(?:<(?!/?{tag}[\s/>])[^<]*+)*+<{tag}[\s/>]" for tag in tags)
    return rf"(?i)<(?:{again})"


def _clear(*tags: str) -> str:
    """A page of nothing but elements that patterns can follow, for each of the tags."""
    return r"(?is)\A" + "".join(rf"(?={_inside(tag, LEVELS.get(tag, OTHER_LEVELS) + 1)}\z)" for tag in tags)


def _loose(html: Column, tag: str) -> Column:
    """Whether tags are left once all elements that patterns can follow are taken out."""
    whole = rf"(?is)<{tag}(?=[\s/>])[^>]*>{_inside(tag, LEVELS.get(tag, OTHER_LEVELS))}</{tag}\s*>"
    return F.regexp_replace(html, whole, "").rlike(rf"(?i)</?{tag}[\s/>]")


def _stepped(state: Column, token: Column) -> Column:
    """One tag: what it ends, what it opens, and its text with the depth it belongs to.

    ``stack`` has the open elements, the innermost first. A cell or list item ends an open one
    beside it, and an end tag ends all that was opened inside; such ends are written out. An
    end tag without its element gets depth 0.
    """
    stack, name, size = state["stack"], token["name"], F.size(state["stack"])
    top, below = F.get(stack, F.lit(0)), F.get(stack, F.lit(1))
    cell = top.isin("td", "th")
    beside = (
        F.when((name == "li") & (top == "li"), 1).when(name.isin("td", "th") & cell, 1)
        .when((name == "tr") & cell & (below == "tr"), 2).when((name == "tr") & (top == "tr"), 1).otherwise(0)
    )
    own = F.array_position(stack, name).cast("int")
    ended = F.when(token["ends"], own).otherwise(beside)
    implied = F.when(token["ends"], F.greatest(own - 1, F.lit(0))).otherwise(beside)
    ends = F.array_join(F.transform(F.slice(stack, 1, implied), lambda n, i: F.concat(F.lit("</"), n, F.lit("#"), size - i, F.lit(">"))), "")
    depth = F.when(~token["ends"], size - beside + 1).when(own > 0, size - own + 1).otherwise(0)
    marked = F.concat(ends, F.when(token["ends"], "</").otherwise("<"), name, F.lit("#"), depth, token["rest"])
    rest = F.slice(stack, ended + 1, size)
    tagged = name != ""
    return F.struct(
        F.when(~tagged, stack).when(token["ends"], rest).otherwise(F.concat(F.array(name), rest)).alias("stack"),
        F.concat(state["part"], F.array(F.when(tagged, marked).otherwise(token["rest"]))).alias("part"),
        state["done"].alias("done"),
    )


def _with_depths(html: Column, tags: tuple[str, ...]) -> Column:
    """Every tag of ``tags`` with the depth of its element, as ``<td#3 class="a">`` and ``</td#3>``.

    The text is cut at these tags once; chunks of tags are joined as they are done, so that the
    work grows with the length of the page.
    """
    names = "|".join(tags)
    pieces = F.split(html, rf"(?i)(?=</?(?:{names})[\s/>])")
    tag = rf"(?i)^</?({names})(?=[\s/>])"
    tokens = F.transform(pieces, lambda p: F.struct(
        F.lower(F.regexp_extract(p, tag, 1)).alias("name"), p.startswith("</").alias("ends"), F.regexp_replace(p, tag, "").alias("rest")))
    none = F.array().cast("array<string>")
    state = F.struct(none.alias("stack"), none.alias("part"), none.alias("done"))
    starts = F.sequence(F.lit(1), F.greatest(F.size(pieces), F.lit(1)), F.lit(_CHUNK))

    def chunk(all_tokens: Column) -> Column:
        return F.aggregate(
            starts, state,
            lambda before, at: F.aggregate(
                F.slice(all_tokens, at, _CHUNK), before, _stepped,
                lambda s: F.struct(s["stack"].alias("stack"), none.alias("part"), F.concat(s["done"], F.array(F.array_join(s["part"], ""))).alias("done"))),
            lambda s: F.concat(F.array_join(s["done"], ""), F.array_join(F.transform(
                s["stack"], lambda n, i: F.concat(F.lit("</"), n, F.lit("#"), F.size(s["stack"]) - i, F.lit(">"))), "")))

    return F.get(F.transform(F.array(tokens), chunk), F.lit(0))  # the tokens are worked out once


def marked(html: Column, sought: tuple[str, ...], tags: tuple[str, ...] = BLOCKS) -> Column:
    """The page, with depths in ``tags`` where patterns could not follow a ``sought`` element without them."""
    if not sought:
        return html
    # One scan tells the pages without a tag in another, the next those that are clear in every tag.
    doubtful = html.rlike(_nested(*sought)) & ~html.rlike(_clear(*sought))
    unclear = reduce(Column.__or__, [html.rlike(_nested(tag)) & _loose(html, tag) for tag in sought])
    return F.when(doubtful & unclear, _with_depths(html, tags)).otherwise(html)


def unmarked(node: Column) -> Column:
    """A piece of a marked page without the depths."""
    return F.when(node.contains("#"), F.regexp_replace(node, r"(</?[a-z]+)#\d+(?=[\s/>])", "$1")).otherwise(node)
