"""Schemas of what a task returns: columns that pass through, and new ones."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType


def extended(fields: Iterable[StructField], more: str) -> StructType:
    """``fields`` as they are, whatever their names and types, and those of ``more``."""
    return StructType([*fields, *StructType.fromDDL(more).fields])


def passed(keep: Sequence[str], results: Sequence[str]) -> list[Column]:
    """Columns that an operator hands on; one named like a result comes back as ``in_<name>``."""
    return [F.col(f"`{c}`").alias(f"in_{c}" if c in results else c) for c in keep]
