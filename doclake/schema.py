"""Table schemas and the fixed values every operator shares."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------------------------
HTML, PDF, DOC, DOCX = "html", "pdf", "doc", "docx"

EXTENSIONS = {"html": ".html", "pdf": ".pdf", "doc": ".doc", "docx": ".docx"}

CONTENT_TYPES = {
    "html": "text/html; charset=utf-8",
    "pdf": "application/pdf",
    "doc": "application/msword",
    "docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
}

SIGNATURES = {
    "pdf": b"%PDF-",
    "docx": b"PK\x03\x04",
    "doc": b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1",
}

# Texts of failure rows.
MISSING_METADATA = "listing card without identifier or link"
NO_BODIES = "body discovery returned no bodies"
INCOMPLETE_RECORD = "record is missing body, identifier or file_path"
EMPTY_IDENTIFIER = "identifier is empty after sanitization: "
LANDING_FAILED = "landing write failed: "
NO_CONTAINER = "no container matched "
# Texts of failure rows the contract of captures adds.
NO_PAYLOAD = "a fetched capture without payload"
BAD_NUMBER = "fetch_seq is missing or negative"
REPEATED_NUMBER = "fetch_seq occurs twice for the identity"
NO_CONTENT = "the object has no content"
NO_ANSWER = ("no_answer", "neither status nor error")
# The scope of a record without body or partition.
NO_SCOPE = "None"

RETRYABLE_STATUS = (500, 502, 503, 504, 522, 524, 408, 429)
RATE_LIMIT_STATUS = (429, 503)
RETRY_TIMES = 3
# ----------------------------------------------------------------------------------------------

IDENTITY = ("body", "identifier")



def _texts(*names: str, nullable: bool = True) -> list[T.StructField]:
    return [T.StructField(name, T.StringType(), nullable) for name in names]


# --- fixed values: names and order of the columns ----------------------------------------------
CAPTURE_SCHEMA = T.StructType(
    [
        T.StructField("fetch_seq", T.LongType(), False),
        *_texts("body", "identifier", "title", "description", "date", "document_url", "source_url"),
        *_texts("partition_date", "partition"),
        T.StructField("status", T.IntegerType()),
        *_texts("content_type", "http_etag", "http_last_modified", "retry_after"),
        T.StructField("payload", T.BinaryType()),
        *_texts("error_code", "reason"),
    ]
)

LANDING_SCHEMA = T.StructType(
    [
        *_texts("identifier", "title", "description", "date", "document_url", nullable=False),
        *_texts("partition_date", "body", "file_path", "file_hash", nullable=False),
        *_texts("source_url", "document_type", "scraped_at", "http_etag", "http_last_modified"),
    ]
)

TRANSFORMED_SCHEMA = T.StructType(
    [*LANDING_SCHEMA.fields, *_texts("source_file_path", "transformed_at")]
)

FAILURE_SCHEMA = T.StructType(
    _texts("url", "error_code", "reason", "body", "partition", "identifier")
)
# ----------------------------------------------------------------------------------------------

REQUIRED_FIELDS = tuple(f.name for f in LANDING_SCHEMA.fields if not f.nullable)
