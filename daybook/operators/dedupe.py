"""One row per business key and run, chosen by a total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.schemas import RUN, Entity


def one_per_key(df: DataFrame, key: Sequence[str], prefer_largest: Sequence[str] = ()) -> DataFrame:
    """Keep one row per key: largest ``prefer_largest`` values first, then the smallest values of all other columns.

    The order is total up to identical rows, so the survivor does not depend on partitioning. Filtering on row number
    1 lets Spark keep one row per key in each map task before the shuffle, so a hot key never travels whole.
    """
    rest = [c for c in df.columns if c not in {*key, *prefer_largest}]
    order = [F.col(c).desc() for c in prefer_largest] + [F.col(c).asc() for c in rest]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order or [F.lit(1)])))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def one_per_run_key(df: DataFrame, entity: Entity) -> DataFrame:
    return one_per_key(df, (*entity.key, RUN), entity.prefer_largest)
