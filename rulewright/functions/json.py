"""JSON column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def valid_json(text: Column) -> Column:
    """Whether a text is one JSON value and nothing else; false for null.

    Spark's parsers stop after the first value; as the only element of an
    array, what follows it makes the array malformed or longer.
    """
    wrapped = F.concat(F.lit("["), text, F.lit("]"))
    return F.coalesce(F.try_parse_json(wrapped).isNotNull() & (F.json_array_length(wrapped) == 1), F.lit(False))
