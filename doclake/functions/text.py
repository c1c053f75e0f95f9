"""Text clean-up, storage keys and listing values as native column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from doclake.schema import EXTENSIONS

# Fixed value: every character Unicode text processing counts as whitespace, spelled out so that
# the result does not depend on an engine's own idea of \s.
WHITESPACE = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# The same characters one by one.
BLANKS = "".join(c for c in map(chr, range(0x3001)) if re.match(f"[{WHITESPACE}]", c))
# Fixed value: the results counter printed on a listing page.
TOTAL_RESULTS = rf"(?i)of[{WHITESPACE}]+([\d,]+)[{WHITESPACE}]+results"


def strip(value: Column) -> Column:
    return F.btrim(value, F.lit(BLANKS))


def clean_text(value: Column) -> Column:
    """Whitespace runs become one space, ends are trimmed, null becomes the empty string."""
    spaced = F.regexp_replace(F.coalesce(value, F.lit("")), rf"[{WHITESPACE}]+", " ")
    return F.trim(spaced)


def sanitize_identifier(value: Column) -> Column:
    """Readable object-key part; null where nothing is left (the caller makes that a failure)."""
    dashed = F.regexp_replace(strip(value), r"[/\x00-\x1f]+", "-")
    joined = F.regexp_replace(dashed, rf"[{WHITESPACE}]+", "_")
    return F.nullif(F.btrim(joined, F.lit("-_.")), F.lit(""))


def has_key(value: Column) -> Column:
    """Whether anything is left of an identifier after ``sanitize_identifier``, by one look."""
    return value.rlike(rf"[^/\x00-\x1f{WHITESPACE}\-_.]")


def lookup(table: dict[str, str], key: Column) -> Column:
    """Value of ``key`` in a small constant table, null when it is not there."""
    entries = [F.lit(part) for pair in table.items() for part in pair]
    return F.try_element_at(F.create_map(*entries), key)


def extension_for(document_type: Column) -> Column:
    return lookup(EXTENSIONS, document_type)


def landing_key(body: Column, identifier: Column, document_type: Column) -> Column:
    return F.concat(
        sanitize_identifier(body), F.lit("/"), transformed_key(identifier, document_type)
    )


def transformed_key(identifier: Column, document_type: Column) -> Column:
    return F.concat(sanitize_identifier(identifier), extension_for(document_type))


def iso_date(value: Column) -> Column:
    """dd/mm/yyyy to ISO; anything else passes through unchanged."""
    shaped = F.when(value.rlike(r"^\d{1,2}/\d{1,2}/\d{4}\z"), value)
    parsed = F.date_format(F.try_to_date(shaped, "d/M/yyyy"), "yyyy-MM-dd")
    return F.coalesce(parsed, value)


def total_results(head: Column, page: Column) -> Column:
    """First "of N results" in the results head, else in the whole page."""

    def first_match(text: Column) -> Column:
        return F.nullif(F.regexp_extract(text, TOTAL_RESULTS, 1), F.lit(""))

    digits = F.coalesce(first_match(head), first_match(page))
    return F.replace(digits, F.lit(","), F.lit("")).try_cast("bigint")


def blank(value: Column) -> Column:
    """True for null and for the empty string."""
    return F.coalesce(value, F.lit("")) == F.lit("")
