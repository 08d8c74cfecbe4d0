"""Expressions over self-describing documents: a header of field names, then rows as positional arrays.

The header stays with its document. Each field's position is looked up once per document, before its
rows are exploded, so decoding a row is one array access per column.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from platework._columns import as_col

# Records are kept as their JSON text and read one by one, so that one that is no array costs only itself.
DOCUMENT_SCHEMA = (
    "struct<meta:struct<view:struct<name:string,columns:array<struct<fieldName:string>>>>,"
    "data:array<string>>"
)
# Nested cells arrive as their JSON text, numbers as written and null as NULL.
RECORD_SCHEMA = "array<string>"

# The same without the header, for counting records.
OUTLINE_SCHEMA = "struct<meta:struct<view:struct<name:string>>,data:array<string>>"


def outline(raw) -> Column:
    return F.from_json(as_col(raw), OUTLINE_SCHEMA)


def decode(raw) -> Column:
    """The document as a struct; NULL fields when the text is not such a document."""
    return F.from_json(as_col(raw), DOCUMENT_SCHEMA)


def record_cells(record) -> Column:
    """The cells of one record; NULL when it is no array."""
    return F.from_json(as_col(record), RECORD_SCHEMA)


def is_whole_json(raw) -> Column:
    """Whether the text is one JSON object or array with nothing after it, of any length.

    Readers stop at the end of the root. Inside a wrapping array the root must be the only element, and inside a
    wrapping object the only value: text after it breaks at least one of the two.
    """
    text = as_col(raw)
    alone = F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1
    value = F.json_object_keys(F.concat(F.lit('{"root":'), text, F.lit("}"))) == F.array(F.lit("root"))
    return F.coalesce(text.rlike(r"^\s*[\[{]") & alone & value, F.lit(False))


def field_names(document: Column) -> Column:
    return F.transform(document["meta"]["view"]["columns"], lambda c: c["fieldName"])


def field_position(names: Column, field: str) -> Column:
    """Zero-based position of the field in the header; NULL when it is missing."""
    from_end = F.array_position(F.reverse(names), F.lit(field))
    return F.when(from_end > 0, (F.size(names) - from_end).cast("int"))


def missing_fields(names: Column, required: list[str]) -> Column:
    """Required names the header lacks, in the order of the contract."""
    return F.array_except(
        F.array(*[F.lit(r) for r in required]), F.coalesce(names, F.array().cast("array<string>"))
    )


def json_path(text, path: str) -> Column:
    return F.get_json_object(as_col(text), path)


def object_keys(text) -> Column:
    return F.json_object_keys(as_col(text))


def array_size(array) -> Column:
    """Number of elements; NULL for no array."""
    return F.when(as_col(array).isNotNull(), F.size(as_col(array)))
