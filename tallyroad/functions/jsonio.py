"""JSON in and out of columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DataType

# Single-quoted text is not JSON for this feed (Spark's reader allows it).
READ_OPTIONS = {"allowSingleQuotes": "false"}


def read_json(text: Column, schema: DataType | str) -> Column:
    """Parse JSON text; text that does not fit the schema gives NULL."""
    return F.from_json(text, schema, READ_OPTIONS)


def write_json(value: Column, keep_nulls: bool = True) -> Column:
    """A struct or map column as JSON text."""
    return F.to_json(value, {"ignoreNullFields": str(not keep_nulls).lower()})


def row_as_json(*columns: str) -> Column:
    """Whole rows as name-to-value JSON objects, nulls included."""
    return write_json(F.struct(*[F.col(c) for c in columns]))
