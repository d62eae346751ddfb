"""JSON decode / encode of topic values.

Decoding is PERMISSIVE: a malformed document yields NULL fields and its text in
``_corrupt_record`` so the row can be routed to quarantine instead of failing the stream.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "_corrupt_record"


def with_corrupt_field(schema: StructType) -> StructType:
    if CORRUPT in schema.fieldNames():
        return schema
    return StructType(schema.fields + [StructField(CORRUPT, StringType())])


def decode(value: Column, schema: StructType) -> Column:
    """JSON text -> struct of ``schema`` + ``_corrupt_record`` (text of a malformed input)."""
    return F.from_json(
        value.cast("string"),
        with_corrupt_field(schema),
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT},
    )


def normalize(value: Column, schema: StructType | None = None) -> Column:
    """Parse and print JSON again: compact form with no optional spaces.

    With a schema the document is typed first; without one it goes through VARIANT, which
    keeps every field. A malformed document gives NULL, so the row can go to quarantine.
    """
    if schema is not None:
        return F.to_json(F.from_json(value, schema))
    return F.to_json(F.try_parse_json(value))
