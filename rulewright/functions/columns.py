"""Helpers for column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(value: Column) -> Column:
    """`value` as a column of its own row-for-row generator.

    Spark merges projections and writes a column's expression out wherever it
    is used; a generator stands between them, so a costly one runs once a row.
    """
    return F.explode(F.array(value))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of `value`, which is worked out once."""
    return F.transform(F.array(value), body)[0]
