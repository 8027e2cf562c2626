"""Fields and nodes out of raw report and listing pages."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotledger.functions.text import blank_to_null, first_token
from lotledger.operators.nesting import BLOCKS, LISTING_BLOCKS, LISTS, cut, cut_text, element, flat, inside, marked, unmarked
from lotledger.schemas import NO_RESULTS_TEXT, NOT_AVAILABLE, RESERVED_TEXT

#: A node inside another one is found too: what is matched is only looked at ahead.
LISTING_NODE = rf'(?is)(?=({element("div", 2, chr(92) + 'bdata-impression="[^"]*"')}))<'
LISTING_ATTRIBUTE = r'(?i)data-impression="([^"]*)"'
LIST_BLOCK, LIST_ITEM, TABLE_ROW, TABLE_CELL = ("(?is)" + element(tag) for tag in ("ul", "li", "tr", "td"))
#: What these match is an element with its tags; pages in which they could not be told apart get marks.
ELEMENTS = {LIST_BLOCK: "ul", LIST_ITEM: "li", TABLE_ROW: "tr", TABLE_CELL: "td"}


def _leaf(tag: str) -> str:
    """A node that holds no other of its kind; any other markup may be inside."""
    return rf"(?i)<{tag}(?=[\s>])[^>]*>([^<]*+(?:<(?!/?{tag}[\s>])[^<]*+)*+)</{tag}\s*>"


SPAN_TEXT = _leaf("span")
DEFINITION = _leaf("dd")
STRONG_TEXT = _leaf("strong")
LABELLED_CELL = rf"(?is)({element('th', 2)})\s*({element('td', 4)})"
#: What these match is the inside of an element, of which fields take the text.
TEXT_NODES = {SPAN_TEXT, DEFINITION, STRONG_TEXT, TABLE_CELL}
COMMENT = r"(?s)<!--.*?-->"
MARKUP = r"</?[A-Za-z][^>]*>"
LINE_BREAK = r"(?i)<br(?=[\s/>])[^>]*>"
ENTITY_PARTS = r"[^&]+|&#[0-9]{1,7};|&#[xX][0-9a-fA-F]{1,6};|&[A-Za-z]+;|&"
ENTITIES = {
    "&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&amp;": "&", "&quot;": '"', "&apos;": "'", "&middot;": "·", "&hellip;": "…",
    "&ndash;": "–", "&mdash;": "—", "&lsquo;": "‘", "&rsquo;": "’", "&ldquo;": "“", "&rdquo;": "”", "&times;": "×",
    "&won;": "₩", "&sup2;": "²", "&sup3;": "³", "&deg;": "°", "&copy;": "©", "&reg;": "®", "&trade;": "™", "&bull;": "•",
}


class Step(NamedTuple):
    """Narrow to the ``position``-th (1-based) match of ``pattern``'s first group."""

    pattern: str
    position: int


# Where each field sits in the two report templates.
ACCIDENT_FIELDS: dict[str, list[Step]] = {
    "license": [Step(DEFINITION, 1)],
    "model": [Step(TABLE_ROW, 1), Step(TABLE_CELL, 2)],
    "fuel": [Step(TABLE_ROW, 2), Step(TABLE_CELL, 2)],
    "cc": [Step(TABLE_ROW, 3), Step(TABLE_CELL, 1)],
    "registration_date": [Step(TABLE_ROW, 4), Step(TABLE_CELL, 2)],
    "license_changed": [Step(LIST_BLOCK, 1), Step(LIST_ITEM, 3), Step(SPAN_TEXT, 1)],
    "owner_changed": [Step(LIST_BLOCK, 1), Step(LIST_ITEM, 3), Step(SPAN_TEXT, 2)],
    "total_loss": [Step(LIST_BLOCK, 1), Step(LIST_ITEM, 4), Step(SPAN_TEXT, 1)],
    "flood": [Step(LIST_BLOCK, 1), Step(LIST_ITEM, 4), Step(SPAN_TEXT, 2)],
    "theft": [Step(LIST_BLOCK, 1), Step(LIST_ITEM, 4), Step(SPAN_TEXT, 3)],
    "cm": [Step(LIST_BLOCK, 1), Step(LIST_ITEM, 5), Step(SPAN_TEXT, 1)],
    "co": [Step(LIST_BLOCK, 1), Step(LIST_ITEM, 6), Step(SPAN_TEXT, 1)],
}
ACCIDENT_SUMMARY_FIELDS: dict[str, list[Step]] = {
    "car_name": [Step(LIST_BLOCK, 1), Step(LIST_ITEM, 1), Step(SPAN_TEXT, 2)],
    "year": [Step(LIST_BLOCK, 1), Step(LIST_ITEM, 1), Step(SPAN_TEXT, 3)],
}


def _inspection(block: int, item: int) -> list[Step]:
    return [Step(LIST_BLOCK, block), Step(LIST_ITEM, item), Step(SPAN_TEXT, 2)]


INSPECTION_FIELDS: dict[str, list[Step]] = {
    "transmission": _inspection(1, 1),
    "warranty": _inspection(1, 3),
    "mileage": _inspection(2, 2),
    "tuning_history": _inspection(2, 4),
    "special_history": _inspection(2, 5),
    "usage_change": _inspection(2, 6),
    "accident": _inspection(3, 1),
    "little_accident": _inspection(3, 2),
}
COLLECT_FIELDS: dict[str, list[Step]] = {
    "car_title": [Step(STRONG_TEXT, 1)],
    "registered": [Step(STRONG_TEXT, 2)],
    "gearbox": _inspection(1, 1),
    "fuel_type": _inspection(1, 2),
    "mileage": _inspection(2, 2),
    "mileage_condition": _inspection(2, 1),
    "chassis_number": _inspection(2, 3),
    "tuning": _inspection(2, 4),
    "special_history": _inspection(2, 5),
    "usage_change": _inspection(2, 6),
    "emission_gas": _inspection(2, 7),
    "recall": _inspection(2, 8),
}


def _once(pages: DataFrame, keep: list[str], columns: dict[str, Column]) -> DataFrame:
    """Add columns that are worked out exactly once per page.

    As plain projections they would be copied into every later filter and column that uses
    them, and page matching repeated each time; nothing is pushed through a generator.
    """
    return pages.select(*keep, F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def _let(value: Column, made: Callable[[Column], Column]) -> Column:
    """``made`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), made), F.lit(0))


def _decoded(part: Column) -> Column:
    """The character of an entity; unknown ones and plain text stay."""
    digits = F.regexp_extract(part, "^&#[xX]?([0-9a-fA-F]+);$", 1)
    code = F.when(part.rlike("^&#[xX]"), F.conv(digits, 16, 10)).when(part.rlike("^&#"), digits).cast("long")
    names, values = (F.split(F.lit("\x01".join(side)), "\x01") for side in zip(*ENTITIES.items(), strict=True))
    known = F.map_from_arrays(names, values)
    return (
        F.when(code == 160, F.lit(" "))
        .when(code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF), F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
        .otherwise(F.coalesce(F.try_element_at(known, part), part))
    )


def inner_text(node: Column) -> Column:
    """The text of a node: without tags, a line break for each ``br``, entities decoded once."""
    may_break = reduce(Column.__or__, [node.contains(tag) for tag in ("<br", "<BR", "<Br", "<bR")])
    lines = F.when(may_break, F.regexp_replace(node, LINE_BREAK, "\n")).otherwise(node)
    plain = F.when(node.contains("<"), F.regexp_replace(lines, MARKUP, "")).otherwise(node)

    def decoded(text: Column) -> Column:
        parts = F.regexp_extract_all(text, F.lit(ENTITY_PARTS), F.lit(0))
        return F.when(text.contains("&"), F.array_join(F.transform(parts, _decoded), "")).otherwise(text)

    return _let(plain, decoded)


def _all(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0 if pattern in ELEMENTS else 1))


def _without_comments(html: Column) -> Column:
    return F.when(html.contains("<!--"), F.regexp_replace(html, COMMENT, "")).otherwise(html)


def _marked_pages(pages: DataFrame, keep: list[str], html: str, sought: tuple[str, ...], tags: tuple[str, ...] = BLOCKS) -> DataFrame:
    """``__page`` without comments, and with depths where patterns need them; marks look at a page more than once."""
    clean = _once(pages, keep, {"__clean": _without_comments(F.col(html))})
    return _once(clean, keep, {"__page": marked(F.col("__clean"), sought, tags)})


def _list_pages(pages: DataFrame, keep: list[str], html: str) -> DataFrame:
    """``__page`` as :func:`_marked_pages` gives it for lists and items, and whether it is ``__flat``."""
    def told(clean: Column) -> Column:
        return _let(flat(clean), lambda is_flat: F.struct(
            is_flat.alias("__flat"), F.when(is_flat, clean).otherwise(marked(clean, LISTS)).alias("__page")))

    return pages.select(*keep, F.inline(F.array(_let(_without_comments(F.col(html)), told))))


def extract_fields(
    pages: DataFrame, fields: dict[str, list[Step]], keep: list[str], html: str = "html"
) -> DataFrame:
    """One trimmed text column per field; a missing node is null.

    The steps of all fields form a tree. It is gone down level by level: of a node only what
    a field lies in is matched, once for all fields that share it, and only the text of the
    chosen nodes is worked out. On flat pages lists and items are cut out without patterns.
    """
    depth = max(len(steps) for steps in fields.values())
    patterns = {step.pattern for steps in fields.values() for step in steps}
    own = patterns <= {*ELEMENTS, *TEXT_NODES}  # other patterns see the page as it is
    sought = tuple(tag for pattern, tag in ELEMENTS.items() if pattern in patterns)
    lists = own and set(sought) == set(LISTS)
    if lists:
        level = _list_pages(pages, keep, html)
    else:
        level = _marked_pages(pages, keep, html, sought) if own else _once(pages, keep, {"__page": F.col(html)})
    wanted, keep = keep, [*keep, "__flat"] if lists else keep
    columns: dict[tuple, str] = {}

    def node(steps: tuple[Step, ...]) -> Column:
        if not steps:
            return F.col("__page")
        found, place = F.col(columns[steps[:-1], steps[-1].pattern]), steps[-1].position - 1
        if steps[-1].pattern not in ELEMENTS:
            return F.get(found, F.lit(place))
        whole = inside(F.get(found, F.lit(place)))
        return F.when(F.col("__flat"), F.get(found, F.lit(2 * place + 1))).otherwise(whole) if lists else whole

    def matches(parent: Column, pattern: str, last: int) -> Column:
        """All matches, or as far as the last that a field lies in where that is simple."""
        if pattern not in ELEMENTS:
            return _all(parent, pattern)
        found = F.array(F.nullif(F.regexp_extract(parent, pattern, 0), F.lit(""))) if last == 1 else _all(parent, pattern)
        return F.when(F.col("__flat"), cut(parent, ELEMENTS[pattern], last)).otherwise(found) if lists else found

    for d in range(depth):
        sought: dict[tuple, int] = {}
        for s in fields.values():
            if len(s) > d:
                at = tuple(s[:d]), s[d].pattern
                sought[at] = max(sought.get(at, 1), s[d].position)
        found = {f"__level{d}_{i}": matches(node(prefix), pattern, last) for i, ((prefix, pattern), last) in enumerate(sought.items())}
        # Matches of earlier levels go on while a field ends there.
        ended = dict.fromkeys(columns[tuple(s[:-1]), s[-1].pattern] for s in fields.values() if len(s) <= d)
        level = _once(level, [*keep, *ended], found)
        columns |= dict(zip(sought, found, strict=True))

    nodes = {name: node(tuple(steps)) for name, steps in fields.items()}
    if lists:
        nodes |= {name: F.when(F.col("__flat"), cut_text(nodes[name])).otherwise(nodes[name])
                  for name, steps in fields.items() if steps[-1].pattern in ELEMENTS}
    texts = [name for name, steps in fields.items() if steps[-1].pattern in TEXT_NODES]
    if texts:  # one expression for all texts keeps plans small
        level = _once(level, [*keep, *dict.fromkeys(c for c in level.columns if c not in keep)], {
            "__texts": F.transform(F.array(*[nodes[name] for name in texts]), inner_text)})
        nodes |= {name: F.get("__texts", F.lit(i)) for i, name in enumerate(texts)}
    return level.select(*wanted, *[F.trim(chosen).alias(name) for name, chosen in nodes.items()])


def extract_labelled(
    pages: DataFrame, cells: dict[str, str], items: dict[str, str], keep: list[str], html: str = "html"
) -> DataFrame:
    """Fields found by their label instead of their place; missing labels are null.

    ``cells`` take the ``td`` right after the first ``th`` that contains the label, ``items``
    the first span text of the first list item that contains it.
    """
    page = _marked_pages(pages, keep, html, ("th", "td", "li"))
    text = F.col("__page")
    found = _once(page, keep, {
        "__heads": F.regexp_extract_all(text, F.lit(LABELLED_CELL), F.lit(1)),
        "__cells": F.regexp_extract_all(text, F.lit(LABELLED_CELL), F.lit(3)),
        "__nodes": _all(text, LIST_ITEM),
    })
    heads = F.transform("__heads", inner_text)
    layout = _once(found, keep, {
        "__pairs": F.arrays_zip(heads.alias("head"), F.col("__cells").alias("cell")),
        "__items": F.transform("__nodes", lambda node: F.struct(inner_text(node).alias("text"), node.alias("node"))),
    })

    def cell(label: str) -> Column:
        return F.get(F.filter("__pairs", lambda pair: pair["head"].contains(label)), F.lit(0))["cell"]

    def item(label: str) -> Column:
        first = F.get(F.filter("__items", lambda node: node["text"].contains(label)), F.lit(0))["node"]
        return F.get(_all(first, SPAN_TEXT), F.lit(0))

    chosen = {name: cell(label) for name, label in cells.items()} | {name: item(label) for name, label in items.items()}
    texts = _once(layout, keep, {"__texts": F.transform(F.array(*chosen.values()), inner_text)})
    return texts.select(*keep, *[F.trim(F.get("__texts", F.lit(i))).alias(name) for i, name in enumerate(chosen)])


def explode_nodes(pages: DataFrame, pattern: str, keep: list[str], group: int = 0, html: str = "html") -> DataFrame:
    """One row per match, with its 0-based place on the page."""
    matches = F.regexp_extract_all(F.col(html), F.lit(pattern), F.lit(group))
    return pages.select(*keep, F.posexplode(matches).alias("position", "node"))


def listing_nodes(pages: DataFrame, keep: list[str], html: str = "html") -> DataFrame:
    """Every listing node with all its descendants, its 0-based place on the page and its ``attribute``.

    A node ends at its own end tag, whatever elements it holds; one inside another is a node too.
    """
    page = _marked_pages(pages, keep, html, LISTING_BLOCKS, LISTING_BLOCKS)
    nodes = explode_nodes(page, LISTING_NODE, keep, group=1, html="__page")
    return nodes.withColumns({"attribute": node_attribute(F.col("node")), "node": unmarked(F.col("node"))})


def drop_reserved(nodes: DataFrame, text: str = RESERVED_TEXT, node: str = "node") -> DataFrame:
    return nodes.where(~F.col(node).contains(text))


def drop_empty_pages(pages: DataFrame, text: str = NO_RESULTS_TEXT, html: str = "html") -> DataFrame:
    return pages.where(~F.col(html).contains(text))


def node_attribute(node: Column, pattern: str = LISTING_ATTRIBUTE) -> Column:
    return F.regexp_extract(node, pattern, 1)


def parse_listing(nodes: DataFrame, attribute: str = "attribute") -> DataFrame:
    """``id`` and ``price`` texts of attributes with at least two ``|`` parts."""
    parts = F.split(F.col(attribute), r"\|")
    return nodes.where(F.size(parts) >= 2).withColumns({"id": F.get(parts, 0), "price": F.get(parts, 1)})


def listing_ids(nodes: DataFrame, keep: list[str] | None = None, attribute: str = "attribute") -> DataFrame:
    """Distinct first tokens of the non-empty attributes, per value of the ``keep`` columns."""
    token = first_token(F.col(attribute), "|").alias("id")
    return nodes.where(F.col(attribute) != "").select(*(keep or []), token).distinct()


def require_all(df: DataFrame, columns: list[str], blank_is_missing: bool = False) -> DataFrame:
    """Rows with every field present. A blank text is a present field unless said otherwise."""
    complete = reduce(
        lambda a, b: a & b,
        [(blank_to_null(F.col(c)) if blank_is_missing else F.col(c)).isNotNull() for c in columns],
    )
    return df.where(complete)


def default_after_failure(df: DataFrame, columns: list[str], default: str = NOT_AVAILABLE) -> DataFrame:
    """From the first missing field on, every later field of the row is ``default`` too.

    A field is missing when it is null; a blank one only takes the default itself.
    """
    present = F.lit(True)
    kept = {}
    for name in columns:
        present = present & F.col(name).isNotNull()
        kept[name] = F.when(present, F.coalesce(blank_to_null(F.col(name)), F.lit(default))).otherwise(F.lit(default))
    return df.withColumns(kept)
