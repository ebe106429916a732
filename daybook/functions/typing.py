"""Text to typed values and back.

Values that do not read as the wanted type become NULL under ANSI mode as well, so one bad row never fails a run.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def read_as(column: str, sql_type: str) -> Column:
    return F.col(column).try_cast(sql_type)


def as_typed(df: DataFrame, conversions: Mapping[str, str]) -> DataFrame:
    return df.select(*[read_as(c, conversions[c]).alias(c) if c in conversions else F.col(c) for c in df.columns])


def as_text(df: DataFrame, conversions: Mapping[str, str]) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) if c in conversions else F.col(c) for c in df.columns])
