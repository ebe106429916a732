"""Run accounting: counts per layer, status records, and the run dates still to do."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions.typing import as_typed
from daybook.operators.rules import RuleSet
from daybook.schemas import ALERT, RUN, Entity, struct

# The two states of a step, and the layers of a run in order.
SUCCESS = "SUCCESS"
FAILED = "FAILED"
LAYERS = ("raw", "bronze", "silver", "history", "gold")


def layer_counts(raw: DataFrame, bronze: RuleSet, silver: RuleSet, entity: Entity) -> DataFrame:
    """Rows read, valid and rejected per run, for the bronze and the silver layer, from one pass over the raw rows.

    Silver counts valid rows after one row per key is kept. The first level groups by key and combines in the map
    tasks, so neither a hot key nor a hot run is gathered in one place.
    """
    marked = raw.withColumn("_bronze", F.coalesce(bronze.holds(), F.lit(False)))
    rows = as_typed(marked, entity.conversions)
    in_bronze = F.col("_bronze")
    per_key = rows.groupBy(RUN, *entity.key).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(in_bronze).alias("n_bronze"),
        F.max(F.when(in_bronze & silver.holds(), 1).otherwise(0)).alias("kept"),
        F.count_if(in_bronze & silver.rejected()).alias("n_refused"),
    )
    sums = per_key.groupBy(RUN).agg(*[F.sum(c).alias(c) for c in ("n", "n_bronze", "kept", "n_refused")])

    def layer(name: str, read: Column, valid: Column, rejected: Column) -> Column:
        counts = {"rows_read": read, "rows_valid": valid, "rows_rejected": rejected}
        return F.struct(
            F.lit(name).alias("layer"),
            F.lit(entity.name).alias("entity"),
            F.col(RUN).alias("runDate"),
            *[c.cast("bigint").alias(n) for n, c in counts.items()],
        )

    n, n_bronze, kept, n_refused = (F.col(c) for c in ("n", "n_bronze", "kept", "n_refused"))
    layers = F.array(layer("bronze", n, n_bronze, n - n_bronze), layer("silver", n_bronze, kept, n_refused))
    return sums.select(F.explode(layers).alias("row")).select("row.*")


def recent(log: DataFrame, k: int, *order: Column) -> DataFrame:
    """Latest rows of the log: a top-k, kept per task and merged."""
    return log.orderBy(*order).limit(k)


def run_status(log: DataFrame, environment: str = "dev", export_csv: str = "", attempt: str | None = None) -> DataFrame:
    """One alert record per run: Failure if any step failed, with the first failed step and its message.

    A step counts with its latest row: a rerun that succeeds clears an earlier failure. ``attempt`` becomes a part of the
    run id.
    """
    latest = latest_steps(log, "pipeline_name")
    failed = F.col("last.status") != SUCCESS
    runs = latest.groupBy("pipeline_name", "runDate").agg(
        F.bool_or(failed).alias("failed"),
        F.min(F.when(failed, F.struct("ended_at", "layer", "entity", F.col("last.message").alias("message")))).alias("first"),
        F.min("started_at").alias("started_at"),
    )
    return runs.select(
        F.when(F.col("failed"), "Failure").otherwise("Success").alias("status"),
        F.lit(environment).alias("environment"),
        F.col("pipeline_name").alias("pipelineName"),
        F.concat_ws("-", "pipeline_name", "runDate", F.lit(attempt)).alias("runId"),
        F.date_format(F.to_utc_timestamp("started_at", F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")
        .alias("triggerTimeUtc"),
        F.col("runDate"),
        F.lit(export_csv).alias("exportCsv"),
        F.coalesce(F.concat_ws("/", "first.layer", "first.entity"), F.lit("")).alias("activityName"),
        F.when(F.col("failed"), F.lit("STEP_FAILED")).otherwise(F.lit("")).alias("errorCode"),
        F.coalesce(F.col("first.message"), F.lit("")).alias("errorMessage"),
    ).select(*struct(ALERT).names)


def latest_steps(log: DataFrame, *by: str) -> DataFrame:
    """Each step's latest row: the log is append-only, and a step counts with its last attempt.

    Columns ``by`` (beside run date, layer and entity), ``last`` (status and message), ``started_at``, ``ended_at`` (of the
    latest row).
    """
    return log.groupBy(*by, "runDate", "layer", "entity").agg(
        F.max_by(F.struct("status", "message"), "ended_at").alias("last"),
        F.min("started_at").alias("started_at"),
        F.max("ended_at").alias("ended_at"),
    )


def completed_runs(log: DataFrame, layer: str, required: Sequence[str]) -> DataFrame:
    """Run dates whose latest attempt came through: every step up to ``layer`` has succeeded last, all required steps of
    ``layer`` are there, and none of them is older than a step of a layer before.

    So a rerun that failed, or stopped without a word, makes its date pending again.
    """
    rank = F.array_position(F.array(*map(F.lit, LAYERS)), F.col("layer"))
    steps = latest_steps(log).where((rank > 0) & (rank <= LAYERS.index(layer) + 1))
    own = F.col("layer") == layer
    wanted = own & F.col("entity").isin(*required)
    per_run = steps.groupBy("runDate").agg(
        F.bool_and(F.col("last.status") == SUCCESS).alias("all_done"),
        F.count_if(wanted).alias("n_required"),
        F.min(F.when(wanted, F.col("ended_at"))).alias("own_from"),
        F.max(F.when(~own, F.col("ended_at"))).alias("before_to"),
    )
    in_order = F.col("before_to").isNull() | (F.col("own_from") >= F.col("before_to"))
    return per_run.where(F.col("all_done") & (F.col("n_required") == len(set(required))) & in_order).select("runDate")


def mark(log: DataFrame, first: Column, today: Column, layer: str, required: Sequence[str]) -> DataFrame:
    """One row, ``mark``: the last date up to ``today`` before the first gap since ``first``; the day before ``first`` if
    that one is not completed."""
    pending = run_plan(log, F.date_sub(first, 1), today, layer, required)
    return pending.agg(F.coalesce(F.date_sub(F.min("runDate").cast("date"), 1), today).cast("string").alias("mark"))


def run_plan(log: DataFrame, last: Column, today: Column, layer: str, required: Sequence[str]) -> DataFrame:
    """Run dates after ``last`` up to ``today`` that are not completed in the log, oldest first.

    ``last`` and ``today`` are date expressions; with ``last`` NULL or not before ``today`` there is nothing to do.
    """
    spark = log.sparkSession
    # sequence() counts backwards when the end lies before the start, hence the guard.
    days = F.when(last < today, F.sequence(F.date_add(last, 1), today))
    wanted = spark.range(1).select(F.explode(days).alias("day")).select(F.col("day").cast("string").alias("runDate"))
    return wanted.join(completed_runs(log, layer, required), "runDate", "left_anti").orderBy("runDate")
