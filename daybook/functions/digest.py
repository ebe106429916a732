"""Attribute fingerprint for change detection."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Stored fingerprints depend on both.
SEPARATOR = "||"
BITS = 256


def attribute_hash(columns: Iterable[str]) -> Column:
    """SHA-256 hex over the values in order; NULL counts as empty text.

    Two limits come with this formula, kept because stored tables hold its results: NULL equals ``''``, and values
    that contain the separator can collide.
    """
    values = [F.coalesce(F.col(c), F.lit("")) for c in columns]
    return F.sha2(F.concat_ws(SEPARATOR, *values), BITS)
