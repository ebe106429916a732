"""Clean snapshot to change history."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.operators.dedupe import one_per_run_key
from daybook.operators.history import as_versions, changed_versions, expired_versions, history_of_days
from daybook.operators.rules import SILVER_RULES
from daybook.operators.upsert import shuffled_beyond, upsert
from daybook.plans.counts import Counts
from daybook.schemas import ENTITIES, HISTORY_TABLE, OPEN_END, RUN
from daybook.sources.tables import Lake, checked_run_date

HOLDERS = ENTITIES["policyholders"]


def load_history(
    lake: Lake, run_date: str, snapshot: DataFrame | None = None, *, allow_backdated: bool = False
) -> Counts:
    """Apply one run's holder snapshot to the history. ``snapshot`` replaces the clean table as its source.

    The history is stored by end date: all open versions in one partition, each run's closed versions in another. The
    changes are staged, the closed versions are written first and the open ones after them, each into a fresh folder that
    is then switched to, so a crash in between loses nothing and a rerun writes the same closed partition again.
    """
    key = list(HOLDERS.key)
    if snapshot is None:
        snapshot = lake.read_run(HOLDERS.silver, run_date)
    snapshot = snapshot.withColumn("_loaded_at", F.current_timestamp())
    history = lake.read(HISTORY_TABLE)
    # The stored end date names the partition; the flag alone would make Spark open every folder.
    open_versions = history.where(F.col("effective_end_date") == OPEN_END)

    versions = as_versions(snapshot, HOLDERS.tracked, run_date).select(*history.columns)
    # The count reads file footers.
    changed = changed_versions(versions, shuffled_beyond(open_versions, open_versions.count()), key)
    with lake.staged(changed, HISTORY_TABLE) as changes:
        seen = changes.agg(
            F.count(F.lit(1)).alias("changed"),
            F.count("replaced_start").alias("closed"),
            F.max("replaced_start").alias("latest"),
        ).first()
        n_read = snapshot.count()
        if seen["closed"] and seen["latest"] > run_date and not allow_backdated:
            raise ValueError(f"back-dated run {run_date}: a version starting {seen['latest']} exists")

        changes = shuffled_beyond(changes, seen["changed"])
        if seen["closed"]:
            # Few rows from many tasks: let Spark gather them into files of a sensible size.
            expired = expired_versions(open_versions, changes, key)
            closed_before = history.where(F.col("effective_end_date") == run_date)
            closed = upsert(closed_before, shuffled_beyond(expired, seen["closed"]), [*key, "effective_start_date"])
            lake.overwrite_partitions(HISTORY_TABLE, closed.hint("rebalance"))
        if seen["changed"]:
            opened = upsert(open_versions, changes.drop("replaced_start"), key)
            lake.overwrite_partitions(HISTORY_TABLE, opened)
    return Counts(n_read, seen["changed"], 0)


def load_history_days(
    lake: Lake, run_dates: Iterable[str], snapshots: DataFrame | None = None, *, allow_backdated: bool = False
) -> Counts:
    """Apply the holder snapshots of many runs to the history in one plan, with the result of one run after another.

    The snapshots are the valid rows of the runs in the raw layer, which keeps every day; the clean table holds a key
    only in the run that last wrote it. ``snapshots`` replaces them. Only open versions are read, closed versions of
    other end dates stay untouched. Closed versions are written first, open ones after them.
    """
    dates = sorted({checked_run_date(d) for d in run_dates})
    if snapshots is None:
        bronze = lake.read(HOLDERS.bronze).where(F.col(RUN).isin(dates))
        snapshots = one_per_run_key(SILVER_RULES[HOLDERS.name].valid(bronze), HOLDERS)
    snapshots = snapshots.where(F.col(RUN).isin(dates)).withColumn("_loaded_at", F.current_timestamp())
    history = lake.read(HISTORY_TABLE)
    open_versions = history.where(F.col("effective_end_date") == OPEN_END)
    chained = history_of_days(snapshots, HOLDERS.tracked, HOLDERS.key, open_versions, allow_backdated=allow_backdated)
    with lake.staged(chained, HISTORY_TABLE) as versions:
        # One row per end date among the new versions: no more than there are dates.
        ends = {r["effective_end_date"]: r["count"] for r in versions.groupBy("effective_end_date").count().collect()}
        closed_on = sorted(set(ends) - {OPEN_END})
        if closed_on:
            closed_before = history.where(F.col("effective_end_date").isin(closed_on))
            expired = shuffled_beyond(versions.where(~F.col("is_current")), sum(ends[d] for d in closed_on))
            closed = upsert(closed_before, expired, [*HOLDERS.key, "effective_start_date"])
            lake.overwrite_partitions(HISTORY_TABLE, closed.hint("rebalance", "effective_end_date"))
        if ends:
            lake.overwrite_partitions(HISTORY_TABLE, versions.where(F.col("is_current")))
        return Counts(snapshots.count(), sum(ends.values()), 0)
