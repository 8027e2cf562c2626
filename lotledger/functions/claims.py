"""Insurance claim texts to counts and amounts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lotledger.functions.text import strip_commas
from lotledger.schemas import NONE_TEXT, UNDETERMINED_TEXT

# How the reports write "N times" and "N times, so much won".
COUNT_PATTERN = "([0-9]+)회"
COUNT_AMOUNT_PATTERN = "([0-9]+)회[^0-9]*([0-9]+)"


def extract_number(text: Column) -> Column:
    """First run of digits as INT; no text, no digits or a number too large count as 0."""
    return F.coalesce(F.regexp_extract(text, "([0-9]+)", 1).try_cast("int"), F.lit(0))


def parse_claims(text: Column) -> Column:
    """Struct ``(count INT, total LONG)`` of one claim text.

    No claims gives (0, 0); an undetermined amount keeps its count; anything unreadable,
    ``N/A`` and null give (null, null).
    """
    plain = strip_commas(text)

    def group(source: Column, pattern: str, index: int, kind: str) -> Column:
        return F.regexp_extract(source, pattern, index).try_cast(kind)

    undetermined = text.contains(UNDETERMINED_TEXT)
    count = (
        F.when(text == NONE_TEXT, F.lit(0))
        .when(undetermined, group(text, COUNT_PATTERN, 1, "int"))
        .otherwise(group(plain, COUNT_AMOUNT_PATTERN, 1, "int"))
    )
    total = (
        F.when(text == NONE_TEXT, F.lit(0).cast("long"))
        .when(undetermined, F.lit(None).cast("long"))
        .otherwise(group(plain, COUNT_AMOUNT_PATTERN, 2, "long"))
    )
    return F.struct(count.alias("count"), total.alias("total"))


def claims_text(text: Column) -> Column:
    """The ``count/amount`` text form of a claim, with ``None`` for unknown parts."""
    parsed = parse_claims(text)
    unknown = F.lit("None")
    return F.concat_ws(
        "/",
        F.coalesce(parsed["count"].cast("string"), unknown),
        F.coalesce(parsed["total"].cast("string"), unknown),
    )
