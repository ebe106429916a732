"""Keyed upsert without row-level mutation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Which columns a match updates, or a new row gets: names (taken from the source) or expressions over ``s`` and ``t``.
Columns = Sequence[str] | Mapping[str, Column]

# Rows that a join may broadcast, which sends them through the driver. Of more, both sides are shuffled.
BROADCAST_ROWS = 50_000


def shuffled_beyond(rows: DataFrame, n: int) -> DataFrame:
    """A side of a join with ``n`` rows: Spark may broadcast it if they are few, and not by the size of compressed files."""
    return rows.hint("merge") if n > BROADCAST_ROWS else rows


def unmatched(target: DataFrame, source: DataFrame, key: Sequence[str]) -> DataFrame:
    """Target rows whose key does not occur in the source, of which only the keys are read.

    An anti join: Spark broadcasts the keys when they are small and then leaves the big target unshuffled.
    """
    return target.join(source.select(*key), list(key), "left_anti")


def upsert(target: DataFrame, source: DataFrame, key: Sequence[str], newer_by: str | None = None) -> DataFrame:
    """Target rows without a match, plus the source rows: update all columns on a match, insert the rest.

    ``source`` holds at most one row per key. It is read twice, once for its keys only; stage a costly source first.
    With ``newer_by`` a source row only wins over a target row whose value in that column is not greater; by default
    the source always wins. An empty target is the first load.
    """
    if newer_by is None:
        kept, applied = unmatched(target, source, key), source
    else:
        same_key = reduce(and_, (F.col(f"t.{c}") == F.col(f"s.{c}") for c in key))
        target_newer = F.coalesce(F.col(f"t.{newer_by}") > F.col(f"s.{newer_by}"), F.lit(False))
        narrow = [*key, newer_by]
        kept = target.alias("t").join(source.select(*narrow).alias("s"), same_key & ~target_newer, "left_anti")
        applied = source.alias("s").join(target.select(*narrow).alias("t"), same_key & target_newer, "left_anti")
    return kept.unionByName(applied)


def _expressions(columns: Columns | None, every: Sequence[str]) -> dict[str, Column]:
    if columns is None:
        columns = every
    if isinstance(columns, Mapping):
        return dict(columns)
    return {c: F.col(f"s.{c}") for c in columns}


def applied_rows(
    target: DataFrame, source: DataFrame, key: Sequence[str], update: Columns | None = None, insert: Columns | None = None
) -> DataFrame:
    """The source's rows as they stand in the target afterwards, column by column.

    A row whose key the target holds keeps the target's values but for the columns in ``update``; a new row gets the
    columns in ``insert`` and NULL elsewhere. None means all columns from the source. Keys come from the source. Of the
    target only the columns that a match keeps or an expression may use are read; rows without a match are left behind
    by a semi join, for which Spark broadcasts a small source and leaves the target unshuffled.
    """
    columns = target.columns
    updates, inserts = _expressions(update, columns), _expressions(insert, columns)
    for name in {*updates, *inserts} - set(columns):
        raise ValueError(f"no such column in the target: {name}")
    own = dict.fromkeys(key)
    if all(updates.get(c) is inserts.get(c) is None for c in columns):
        raise ValueError("neither update nor insert names a column")
    uses_target = isinstance(update, Mapping)
    needed = [c for c in columns if c not in own and (uses_target or c not in updates)]
    matched = target.select(*key, *needed).join(source.select(*key), list(key), "left_semi").withColumn("_matched", F.lit(True))
    same_key = reduce(and_, (F.col(f"t.{c}") == F.col(f"s.{c}") for c in key))
    both = source.alias("s").join(matched.alias("t"), same_key, "left")

    def value(name: str) -> Column:
        if name in own:
            return F.col(f"s.{name}")
        kept = updates[name] if name in updates else F.col(f"t.{name}")
        given = inserts.get(name, F.lit(None))
        return F.when(F.col("t._matched"), kept).otherwise(given).cast(target.schema[name].dataType)

    return both.select(*[value(c).alias(c) for c in columns])


def upsert_columns(
    target: DataFrame, source: DataFrame, key: Sequence[str], update: Columns | None = None, insert: Columns | None = None
) -> DataFrame:
    """Upsert with column lists: see :func:`applied_rows`. NULL keys match nothing: such rows are kept, and inserted.

    ``source`` holds at most one row per key and is read several times; stage a costly source first. An expression may
    use both sides, as in ``{"n": F.col("t.n") + F.col("s.n")}``.
    """
    return unmatched(target, source, key).unionByName(applied_rows(target, source, key, update, insert))
