"""Schema and uniqueness checks."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    present = set(df.columns)
    return [c for c in required if c not in present]


def require_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"required columns are missing: {', '.join(missing)}")
    return df


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with how often. Counts combine in the map tasks first."""
    counted = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.where(F.col("n_rows") > 1)
