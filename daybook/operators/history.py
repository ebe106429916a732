"""Slowly changing dimension, type 2: full change history with half-open validity ``[start, end)``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.functions.digest import attribute_hash
from daybook.schemas import OPEN_END, RUN

VALIDITY_COLUMNS = ("attr_hash", "effective_start_date", "effective_end_date", "is_current")


def as_versions(snapshot: DataFrame, tracked: Sequence[str], run_date: str | Column) -> DataFrame:
    """Snapshot rows as open versions that start on the run date."""
    start = F.lit(run_date) if isinstance(run_date, str) else run_date
    return snapshot.withColumns(
        {
            "attr_hash": attribute_hash(tracked),
            "effective_start_date": start,
            "effective_end_date": F.lit(OPEN_END),
            "is_current": F.lit(True),
        }
    )


def current_versions(history: DataFrame) -> DataFrame:
    return history.where(F.col("is_current"))


def changed_versions(versions: DataFrame, history: DataFrame, key: Sequence[str]) -> DataFrame:
    """Versions whose key is new or whose fingerprint differs from the current one.

    Adds ``replaced_start``: start of the version it replaces, NULL for a new key. Only keys, fingerprint and start of
    the current versions take part in the join.
    """
    current = current_versions(history).select(
        *key, F.col("attr_hash").alias("replaced_hash"), F.col("effective_start_date").alias("replaced_start")
    )
    joined = versions.join(current, list(key), "left")
    differs = F.col("replaced_hash").isNull() | (F.col("attr_hash") != F.col("replaced_hash"))
    return joined.where(differs).select(*[F.col(c) for c in versions.columns], "replaced_start")


def close(versions: DataFrame, end: Column) -> DataFrame:
    """Versions ended at ``end``, which is the start of the version that follows."""
    return versions.withColumns({"effective_end_date": end, "is_current": F.lit(False)})


def expired_versions(history: DataFrame, changes: DataFrame, key: Sequence[str]) -> DataFrame:
    """The current versions that ``changes`` replaces, ended."""
    ends = changes.select(*key, F.col("effective_start_date").alias("_end"))
    matched = current_versions(history).join(ends, list(key), "inner")
    return close(matched, F.col("_end")).select(*history.columns)


def scd2_apply(
    history: DataFrame,
    versions: DataFrame,
    key: Sequence[str],
    *,
    allow_backdated: bool = False,
) -> DataFrame:
    """The whole new history after applying one snapshot of versions (see :func:`as_versions`).

    One full outer join of current versions and snapshot decides every key: keep, add, or end and add. Keys missing
    from the snapshot stay open. A version that would start before the one it replaces raises an error unless
    ``allow_backdated``; a second change on the same day leaves a zero-length version.
    """
    columns = history.columns

    def packed(side: str, **changed: Column) -> Column:
        return F.struct(*[changed.get(c, F.col(f"{side}.{c}")).alias(c) for c in columns])

    current, new = current_versions(history).alias("c"), versions.select(*columns).alias("n")
    same_key = [F.col(f"c.{k}") == F.col(f"n.{k}") for k in key]
    condition = same_key[0]
    for equal in same_key[1:]:
        condition = condition & equal
    both = current.join(new, condition, "full_outer")

    has_current, has_new = F.col("c.attr_hash").isNotNull(), F.col("n.attr_hash").isNotNull()
    changes = has_new & (~has_current | (F.col("c.attr_hash") != F.col("n.attr_hash")))
    end = F.col("n.effective_start_date")
    if not allow_backdated:
        message = F.concat(F.lit("back-dated run: a version starting "), F.col("c.effective_start_date"), F.lit(" exists"))
        end = F.when(F.col("c.effective_start_date") > end, F.raise_error(message)).otherwise(end)

    old_row = F.when(~has_current, F.lit(None)).when(
        changes, packed("c", effective_end_date=end, is_current=F.lit(False))
    ).otherwise(packed("c"))
    new_row = F.when(changes, packed("n"))
    rows = both.select(F.explode(F.array_compact(F.array(old_row, new_row))).alias("row")).select("row.*")
    return history.where(~F.col("is_current")).unionByName(rows)


def history_of_days(
    snapshots: DataFrame,
    tracked: Sequence[str],
    key: Sequence[str],
    history: DataFrame | None = None,
    *,
    day: str = RUN,
    allow_backdated: bool = False,
) -> DataFrame:
    """The history that snapshots of many days leave, in one plan: what applying them day by day would give.

    ``snapshots`` holds one row per key and day. A key's rows in day order fall into islands of equal fingerprints: the
    first row of each is a version (``lag``), which ends where the next island starts (``lead``). Days without the key
    change nothing. With ``history``, its open versions come before all days, and its closed versions are passed through.
    Both windows share one shuffle by key, in which a key brings no more than its own days. As in :func:`scd2_apply`, a
    version that would end before it starts raises an error unless ``allow_backdated``.
    """
    rows = as_versions(snapshots, tracked, F.col(day)).withColumn("_stored", F.lit(False))
    if history is not None:
        columns = history.columns
        stored = current_versions(history).withColumn("_stored", F.lit(True))
        rows = stored.unionByName(rows.select(*columns, "_stored"))
    in_order = Window.partitionBy(*key).orderBy(F.col("_stored").desc(), "effective_start_date")
    before = F.lag("attr_hash").over(in_order)
    starts = rows.withColumn("_before", before).where(F.col("_before").isNull() | (F.col("_before") != F.col("attr_hash")))
    end = F.col("_end")
    if not allow_backdated:
        message = F.concat(F.lit("back-dated run: a version starting "), F.col("effective_start_date"), F.lit(" exists"))
        end = F.when(F.col("effective_start_date") > end, F.raise_error(message)).otherwise(end)
    versions = starts.withColumn("_end", F.lead("effective_start_date").over(in_order)).withColumns(
        {"effective_end_date": F.coalesce(end, F.lit(OPEN_END)), "is_current": F.col("_end").isNull()}
    )
    versions = versions.drop("_stored", "_before", "_end")
    return versions if history is None else history.where(~F.col("is_current")).unionByName(versions.select(*columns))
