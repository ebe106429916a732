"""Premium totals and distinct policies from daily partial states, without reading all clean rows again.

A partial state is what a run's rows of the clean table add to an aggregate, in a form that can be merged exactly: money as
sums of decimal parts, and the set of policies as bits over dense numbers, 64 to a word. Policies are numbered in the order
of their groups, so a group's policies share words, and a state is as many words as it needs. One partition of states belongs to one
partition of the clean table, and carries the folder it was computed from. A merge that moves keys out of an older run
rewrites that run into a fresh folder; its states are then stale, and only they are computed again.

Any coarser aggregate over all runs is a merge of states: groups, buckets of numbers and runs, never policies.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daybook.functions.money import parts, total
from daybook.operators.upsert import shuffled_beyond
from daybook.schemas import RUN
from daybook.session import matching_folders, session_setting, write_scratch
from daybook.sources.tables import OVERWRITE_MODE, Lake

SOURCE = "silver_policies"
GROUPS = ("day", "state", "product")
NUMBERS = "policy_id string, number bigint"
STATES = (
    "day date, state string, product string, bucket bigint, policies bigint, _whole decimal(38,0), _rest decimal(38,18), "
    f"_inexact double, _source string, {RUN} string"
)
# Policies to a word: the bits of a bigint.
WORD = 64


def numbers_path(lake: Lake) -> str:
    return f"{lake.base}/gold/policy_numbers"


def states_path(lake: Lake) -> str:
    return f"{lake.base}/gold/written_premium_states"


def _read(lake: Lake, path: str, schema: str) -> DataFrame:
    if not matching_folders(lake.spark, path):
        return lake.spark.createDataFrame([], schema)
    return lake.spark.read.schema(schema).parquet(path)


def number_policies(lake: Lake, policies: DataFrame) -> DataFrame:
    """Give policies without a number the next ones, without gaps; the numbers of all policies.

    New policies are dealt out by ranges of (first day, state and product, id), so those of a group stand together and a
    large group is cut by id. Only the sizes of the ranges reach the driver; within its range, which is stored, a policy's
    place follows from its columns, so a task that is run again gives the same numbers.
    """
    path = numbers_path(lake)
    known = _read(lake, path, NUMBERS)
    known = shuffled_beyond(known, known.count())
    place = ("day", "kind", "policy_id")
    new = policies.where("policy_id IS NOT NULL").groupBy("policy_id").agg(
        F.min("effective_date").alias("day"), F.min(F.xxhash64("state", "product")).alias("kind")
    )
    new = new.join(known, "policy_id", "left_anti").repartitionByRange(*place)
    new, _ = write_scratch(new.withColumn("part", F.spark_partition_id()), "new-policies")
    sizes = {r["part"]: r["count"] for r in new.groupBy("part").count().collect()}
    if sizes:
        first = (known.agg(F.max("number")).first()[0] or 0) + 1
        offsets = accumulate((sizes.get(part, 0) for part in range(max(sizes))), initial=first)
        at = F.row_number().over(Window.partitionBy("part").orderBy(*place))
        number = F.element_at(F.array(*[F.lit(o).cast("bigint") for o in offsets]), F.col("part") + 1) + at - 1
        new.select("policy_id", number.cast("bigint").alias("number")).write.mode("append").parquet(path)
    numbers = _read(lake, path, NUMBERS)
    return shuffled_beyond(numbers, numbers.count())


def states_of(policies: DataFrame, numbers: DataFrame) -> DataFrame:
    """The states of clean policy rows, per run, group and word of policy numbers."""
    rows = policies.join(numbers, "policy_id")
    bit = F.expr(f"shiftleft(1L, CAST(number % {WORD} AS INT))")
    return rows.groupBy(RUN, F.col("effective_date").alias("day"), "state", "product", F.expr(f"number DIV {WORD}").alias("bucket")).agg(
        F.bit_or(bit).alias("policies"),
        *[F.sum(part).alias(name) for name, part in parts("written_premium").items()],
    )


def stale_runs(lake: Lake) -> dict[str, str]:
    """Runs whose clean rows lie in another folder than the one their states were computed from, with that folder."""
    folders = {run: path.removeprefix("file:").replace("//", "/") for run, path in lake.folders(SOURCE).items()}
    # One row per run.
    known = {r[RUN]: r["_source"] for r in _read(lake, states_path(lake), STATES).groupBy(RUN).agg(F.max("_source").alias("_source")).collect()}
    gone = {run: "" for run, source in known.items() if source and run not in folders}
    return gone | {run: path for run, path in folders.items() if known.get(run) != path}


def refresh_states(lake: Lake) -> list[str]:
    """Compute the states of stale runs again, from their partitions of the clean table only; the runs refreshed."""
    stale = stale_runs(lake)
    if stale:
        rows = lake.read(SOURCE).where(F.col(RUN).isin(sorted(stale)))
        source = F.element_at(F.create_map(*[F.lit(x) for pair in stale.items() for x in pair]), F.col(RUN))
        states = states_of(rows, number_policies(lake, rows)).withColumn("_source", source)
        # A run that has lost all its rows keeps one empty state, so that its partition is replaced too.
        none = lake.spark.createDataFrame([(run, path) for run, path in stale.items()], f"{RUN} string, _source string")
        states = states.unionByName(none.join(rows.select(RUN).distinct(), RUN, "left_anti"), allowMissingColumns=True)
        schema = lake.spark.createDataFrame([], STATES).schema
        states = states.select(*[F.col(f.name).cast(f.dataType) for f in schema])
        with session_setting(lake.spark, OVERWRITE_MODE, "dynamic"):
            states.hint("rebalance", RUN).write.mode("overwrite").partitionBy(RUN).parquet(states_path(lake))
    return sorted(stale)


def premium_from_states(lake: Lake, by: Sequence[str] = GROUPS) -> DataFrame:
    """Premium and distinct policies over all runs, for the groups or any coarser grouping, from the states alone."""
    states = _read(lake, states_path(lake), STATES).where("bucket IS NOT NULL")
    merged = states.groupBy(*by, "bucket").agg(
        F.bit_or("policies").alias("policies"), *[F.sum(c).alias(c) for c in ("_whole", "_rest", "_inexact")]
    )
    return merged.groupBy(*by).agg(
        total(*[F.sum(c) for c in ("_whole", "_rest", "_inexact")]).alias("written_premium"),
        F.sum(F.bit_count("policies")).alias("policy_count"),
    )
