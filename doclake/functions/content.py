"""Type sniffing, payload normalisation and hashing of captured bytes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from doclake.functions.text import lookup, strip
from doclake.profile import DEFAULT_PROFILE, SourceProfile
from doclake.schema import CONTENT_TYPES, HTML, SIGNATURES


def detect_document_type(content_type: Column, payload: Column) -> Column:
    """Magic bytes decide; without them the declared type; html when that is none of ours."""
    header = F.substring_index(F.coalesce(content_type, F.lit("")), ";", 1)
    declared = lookup({mime: kind for kind, mime in CONTENT_TYPES.items()}, F.lower(strip(header)))
    sniffed = reduce(
        lambda cases, item: cases.when(F.startswith(payload, F.lit(item[1])), F.lit(item[0])),
        SIGNATURES.items(),
        F,
    )
    return sniffed.otherwise(F.coalesce(declared, F.lit(HTML)))


def effective_document_type(stored: Column, payload: Column) -> Column:
    known = stored.isin(*CONTENT_TYPES)
    return F.when(known, stored).otherwise(detect_document_type(F.lit(None).cast("string"), payload))


def content_type_of(document_type: Column) -> Column:
    return lookup(CONTENT_TYPES, document_type)


def normalize_payload(
    payload: Column, document_type: Column, profile: SourceProfile = DEFAULT_PROFILE
) -> Column:
    """Take per-render comments out of html so that an unchanged page keeps its hash.

    The patterns work on bytes: Latin-1 maps every byte to one character and back.
    """
    text = F.decode(payload, "ISO-8859-1")
    for pattern, replacement in profile.volatile_comments:
        text = F.regexp_replace(text, pattern, replacement)
    return F.when(document_type == HTML, F.encode(text, "ISO-8859-1")).otherwise(payload)


def file_hash(payload: Column) -> Column:
    return F.sha2(payload, 256)
