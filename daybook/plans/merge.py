"""Merge one run into a keyed table that is stored by run.

A keyed table holds each key once, in the partition of the run that last wrote it. That layout makes the readers cheap
(aggregates and history read exactly one partition) and keeps the merge in proportion to what changes: the new rows go
into their own partition, and only older partitions that hold a replaced key are rewritten.
"""

from __future__ import annotations

from collections.abc import Iterable
from contextlib import ExitStack

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.operators.upsert import Columns, applied_rows, shuffled_beyond, unmatched
from daybook.schemas import RUN, TABLES
from daybook.sources.tables import Lake


def merge_run(
    lake: Lake,
    table: str,
    batch: DataFrame,
    run_date: str,
    *,
    keep_newer: bool = False,
    update: Columns | None = None,
    insert: Columns | None = None,
) -> int:
    """Upsert ``batch`` (rows of one run, one per key) and return how many of its rows were applied.

    Rows of the same key in other runs are replaced. ``update`` and ``insert`` choose columns, see
    :func:`daybook.operators.upsert.applied_rows`; the run column always comes from the batch, it places the row.

    All partitions are written before the first is switched (see :meth:`Lake.overwrite_partitions`). The run's own
    partition is switched first: if the driver dies between two switches, a key may stand in its old run as well until
    the same run is merged again, which finds it there; no row is lost.
    """
    key = list(TABLES[table].key)
    with ExitStack() as stack, lake.staged(batch, table) as rows:
        bounds = [f(k).alias(f"{name}_{k}") for k in key for name, f in (("min", F.min), ("max", F.max))]
        seen = rows.agg(F.count(F.lit(1)).alias("n"), *bounds).first()
        if not seen["n"]:
            return 0
        applied = seen["n"]
        rows = shuffled_beyond(rows, seen["n"])

        # Equal keys lie between the batch's smallest and largest: the scan skips files and row groups outside.
        target = lake.read(table)
        in_range = target
        for k in key:
            in_range = in_range.where(F.col(k).between(F.lit(seen[f"min_{k}"]), F.lit(seen[f"max_{k}"])))

        if keep_newer:
            newer = in_range.where(F.col(RUN) > run_date).select(*key)
            rows = rows.join(newer, key, "left_anti")
            applied = rows.count()
        replaced = _replaced_per_run(in_range.where(F.col(RUN) != run_date), rows, key)
        if update is not None or insert is not None:
            chosen = applied_rows(in_range, rows, key, update, insert).withColumn(RUN, F.lit(run_date))
            # Reads the target, of which parts are about to be replaced, and is read twice below.
            rows = shuffled_beyond(stack.enter_context(lake.staged(chosen, table)), seen["n"])
        sizes = _rows_per_run(target, replaced)
        emptied = sorted(run for run, n in replaced.items() if n == sizes[run])
        rewritten = sorted(set(replaced) - set(emptied))

        touched = target.where(F.col(RUN).isin([run_date, *rewritten]))
        kept = unmatched(touched, rows, key)
        if rewritten:
            # Rows of several runs may leave the join spread over all its tasks; gathering them by run avoids a file per
            # task and run, and a run too big for one task is split. The new rows keep their staged files' layout.
            kept = kept.hint("rebalance", RUN)
        lake.overwrite_partitions(table, kept.unionByName(rows), first=run_date)
        for run in emptied:
            lake.clear_partition(table, run)
        return applied


def _replaced_per_run(others: DataFrame, rows: DataFrame, key: list[str]) -> dict[str, int]:
    """How many rows of each stored run the batch replaces; one small row per run reaches the driver."""
    hits = others.select(RUN, *key).join(rows.select(*key), key, "left_semi")
    return {r[RUN]: r["n"] for r in hits.groupBy(RUN).agg(F.count(F.lit(1)).alias("n")).collect()}


def _rows_per_run(target: DataFrame, runs: Iterable[str]) -> dict[str, int]:
    """Rows stored per run, from file footers."""
    wanted = list(runs)
    if not wanted:
        return {}
    return {r[RUN]: r["count"] for r in target.where(F.col(RUN).isin(wanted)).groupBy(RUN).count().collect()}
