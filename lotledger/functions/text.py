"""Text columns: tokens, defaults and node texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lotledger.schemas import NOT_AVAILABLE


def first_token(text: Column, sep: str) -> Column:
    """Everything before the first ``sep``."""
    return F.substring_index(text, sep, 1)


def nth_token(text: Column, sep: str, position: int, strip: str = "") -> Column:
    """Token ``position`` (1-based, negative counts from the end), trimmed of ``strip`` characters.

    A position past the end gives null. ``sep`` is literal text.
    """
    token = F.try_element_at(F.split(text, r"\Q" + sep + r"\E"), F.lit(position))
    return F.trim(token, F.lit(strip)) if strip else token


def strip_commas(text: Column) -> Column:
    return F.replace(text, F.lit(","), F.lit(""))


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def default_text(text: Column, default: str = NOT_AVAILABLE) -> Column:
    """Blank or missing text becomes ``default``."""
    return F.coalesce(blank_to_null(text), F.lit(default))


def join_text(html: Column, pattern: str, sep: str = ",") -> Column:
    """All first-group matches of ``pattern``, joined in page order."""
    return F.array_join(F.regexp_extract_all(html, F.lit(pattern), F.lit(1)), sep)


def none_to_null(text: Column) -> Column:
    """The literal text ``None`` means missing."""
    return F.nullif(text, F.lit("None"))


def split_pair(text: Column, first: str, second: str, sep: str = "/") -> list[Column]:
    """Two named columns from ``first/second`` text."""
    parts = F.split(text, r"\Q" + sep + r"\E", 2)
    return [F.get(parts, 0).alias(first), F.get(parts, 1).alias(second)]
