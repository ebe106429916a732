"""Raw drop to typed rows and quarantine."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from daybook.functions.typing import as_typed
from daybook.operators.rules import BRONZE_RULES, MALFORMED_REASON
from daybook.plans.counts import Counts
from daybook.schemas import Entity, struct
from daybook.session import new_scratch_path, remove_path
from daybook.sources.drops import MALFORMED, read_drop
from daybook.sources.tables import Lake

VERDICT = "_verdict"
VALID, REJECTED, BROKEN = "valid", "rejected", "malformed"
MALFORMED_RECORD = "record string, _sourceFile string, reject_reason string, rejected_at timestamp"


def load_bronze(lake: Lake, entity: Entity, run_date: str, mode: str = "replace", *, multi_line: bool = True) -> Counts:
    """Load one drop. ``replace`` makes a rerun leave the run's rows once; ``append`` adds them again.

    The drop is parsed once: its rows are written to the scratch folder, partitioned by the verdict of the rules, and an
    ``Observation`` on that write, which has no shuffle, counts them (a retried task is not counted twice). Both tables
    are then filled from their partition. Records with too many or too few fields are rejected under a reason of their
    own, with the fields they have; the whole records are kept as documents, see :func:`read_malformed`.
    """
    if mode not in ("replace", "append"):
        raise ValueError(f"mode is replace or append, got {mode!r}")
    rules = BRONZE_RULES[entity.name]
    raw = read_drop(lake.spark, lake.drop_path("raw", entity.name, run_date), entity, run_date, multi_line=multi_line)
    verdict = F.when(F.col(MALFORMED).isNotNull(), BROKEN).when(rules.holds(), VALID).otherwise(REJECTED)

    seen, path = Observation(), new_scratch_path(lake.spark, entity.bronze)
    try:
        marked = raw.withColumn(VERDICT, verdict).observe(
            seen, F.count(F.lit(1)).alias("read"), *[F.count_if(F.col(VERDICT) == v).alias(v) for v in (VALID, REJECTED, BROKEN)]
        )
        marked.write.partitionBy(VERDICT).parquet(path)
        staged = lake.spark.read.schema(marked.schema).parquet(path)
        counts = seen.get
        _write(lake, entity.bronze, as_typed(_of(staged, VALID), entity.conversions), run_date, mode)
        rejects = rules.rejects(_of(staged, REJECTED))
        broken = _of(staged, BROKEN).withColumns({"reject_reason": F.lit(MALFORMED_REASON[entity.name]), "rejected_at": F.current_timestamp()})
        if counts[REJECTED] or counts[BROKEN]:
            # Few rows from many tasks: let Spark gather them into files of a sensible size.
            _write(lake, entity.bronze_rejects, rejects.unionByName(broken).hint("rebalance"), run_date, mode)
        elif mode == "replace":
            lake.clear_partition(entity.bronze_rejects, run_date)
        _write_malformed(lake, entity, staged, run_date, counts[BROKEN], mode)
    finally:
        remove_path(lake.spark, path)
    return Counts(counts["read"], counts[VALID], counts[REJECTED] + counts[BROKEN])


def _of(staged: DataFrame, verdict: str) -> DataFrame:
    return staged.where(F.col(VERDICT) == verdict).drop(VERDICT, MALFORMED)


def _write(lake: Lake, table: str, rows: DataFrame, run_date: str, mode: str) -> None:
    if mode == "append":
        lake.append(table, rows)
    else:
        lake.replace_partition(table, rows, run_date)


def _write_malformed(lake: Lake, entity: Entity, staged: DataFrame, run_date: str, n: int, mode: str) -> None:
    path = lake.malformed_path(entity.name, run_date)
    if n:
        records = staged.where(F.col(VERDICT) == BROKEN).select(
            F.col(MALFORMED).alias("record"),
            "_sourceFile",
            F.lit(MALFORMED_REASON[entity.name]).alias("reject_reason"),
            F.current_timestamp().alias("rejected_at"),
        )
        records.write.mode("overwrite" if mode == "replace" else "append").json(path)
    elif mode == "replace":
        remove_path(lake.spark, path)


def read_malformed(lake: Lake, entity: Entity, run_date: str) -> DataFrame:
    """The whole records of a run that had too many or too few fields."""
    return lake.spark.read.schema(struct(MALFORMED_RECORD)).json(lake.malformed_path(entity.name, run_date))
