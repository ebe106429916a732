"""Facts against dimensions: the version valid on a day, and daily totals by an attribute."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.functions.money import parts, total

# Days before any that a date column holds.
EVER = -(2**31) + 1


def _day(column: Column) -> Column:
    return F.unix_date(column.cast("date"))


def versions_by_start(dimension: DataFrame, key: Sequence[str], start: str, *, early: bool = False) -> DataFrame:
    """Rows as versions ``[valid_from, valid_until)`` in days: each ends where the next of its key starts.

    ``early`` lets the first version of a key reach back to all earlier days. A key brings its own versions to a task.
    """
    by_start = Window.partitionBy(*key).orderBy(start)
    first = F.lag(F.col(start)).over(by_start).isNull()
    begins = _day(F.col(start))
    return dimension.where(F.col(start).isNotNull()).withColumns(
        {
            "valid_from": F.when(first, F.lit(EVER)).otherwise(begins) if early else begins,
            "valid_until": F.lead(begins).over(by_start),
        }
    )


def versions_between(history: DataFrame, start: str, end: str) -> DataFrame:
    """A stored history (half-open ``[start, end)``) as versions in days; an end of NULL is open."""
    return history.withColumns({"valid_from": _day(F.col(start)), "valid_until": _day(F.col(end))})


def valid_at(facts: DataFrame, versions: DataFrame, key: Sequence[str], day: str, *, bin_days: int = 32) -> DataFrame:
    """Facts with the columns of the version of their key that is valid on their day; others are left out.

    ``versions`` has ``valid_from`` and ``valid_until`` (days, see :func:`versions_between`) and, per key, no two versions
    that overlap; versions of no length are never valid. Columns that both sides have are taken from the facts.

    Days fall into bins. A bin of a key needs the versions that start in it and the one that is valid when it begins;
    the latter is carried forward over the bins that facts fall into, of which only key and bin are read. So an open
    version is not spread over all days to come, and the join is by equality of key and bin: the facts of a hot key are
    spread over its bins, and those of one bin can be split, since a bin of versions is small.
    """
    key = list(key)
    placed = facts.withColumn("_day", _day(F.col(day))).withColumn("_bin", F.floor(F.col("_day") / bin_days))
    own = [c for c in versions.columns if c in key or c not in facts.columns]
    real = versions.where(F.col("valid_until").isNull() | (F.col("valid_from") < F.col("valid_until"))).select(*own)
    starting = real.withColumn("_bin", F.floor(F.col("valid_from") / bin_days))

    bins = placed.where(F.col("_day").isNotNull()).select(*key, "_bin").distinct()
    packed = F.struct(*[F.col(c) for c in own])
    marks = bins.select(*key, "_bin", (F.col("_bin") * bin_days).alias("_at"), F.lit(None).cast(starting.select(packed.alias("v")).schema["v"].dataType).alias("_v"))
    steps = marks.unionByName(real.select(*key, F.lit(None).cast("bigint").alias("_bin"), F.col("valid_from").cast("bigint").alias("_at"), packed.alias("_v")))
    # A mark comes before the versions that start on its day: those are found by their own bin.
    until_now = Window.partitionBy(*key).orderBy("_at", F.col("_bin").desc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    carried = steps.withColumn("_v", F.last("_v", ignorenulls=True).over(until_now)).where(F.col("_bin").isNotNull() & F.col("_v").isNotNull())
    carried = carried.where(F.col("_v.valid_until").isNull() | (F.col("_v.valid_until") > F.col("_at"))).select("_v.*", "_bin")

    pieces = starting.unionByName(carried).withColumns({"_from": F.col("valid_from"), "_until": F.col("valid_until")})
    joined = placed.join(pieces, [*key, "_bin"])
    inside = (F.col("_day") >= F.col("_from")) & (F.col("_until").isNull() | (F.col("_day") < F.col("_until")))
    added = [c for c in own if c not in key and c not in ("valid_from", "valid_until")]
    return joined.where(inside).select(*facts.columns, *added)


def daily_totals(
    facts: DataFrame,
    dimension: DataFrame,
    on: str,
    day: str,
    amount: str,
    category: str,
    valid_from: str | None = None,
    *,
    early: bool = True,
) -> DataFrame:
    """Sum and count of facts per day and category; facts without a dimension row are left out.

    Without ``valid_from`` the dimension has one row per ``on``. With it a key may have several, each valid from that
    date to the next one's, and a fact counts once, under the row valid on its day; facts before the first row count
    under the first, or with ``early=False`` not at all. Facts are summed per key and day before the join, in the map
    tasks first, so a hot key enters the join as one row per day instead of all its facts.
    """
    per_key = facts.groupBy(on, F.col(day).alias("day")).agg(
        *[F.sum(part).alias(name) for name, part in parts(amount).items()], F.count(F.lit(1)).alias("_n")
    )
    if valid_from is None:
        joined = per_key.join(dimension.select(on, category), on)
    else:
        versions = versions_by_start(dimension.select(on, valid_from, category), [on], valid_from, early=early)
        joined = valid_at(per_key, versions, [on], "day")
    return joined.groupBy("day", category).agg(
        total(F.sum("_whole"), F.sum("_rest"), F.sum("_inexact")).alias("total"), F.sum("_n").alias("n_facts")
    )
