"""Seven run dates through the whole daily path, and queries that read what it left.

The landing drops are derived from the star tables, every row of them; each date then runs as in production, from landing
files to exported aggregates. The lake is built once per session and input, and read from storage.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from itertools import product

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.catalogue.views import raw
from daybook.functions.typing import as_typed
from daybook.operators.runs import mark, run_plan
from daybook.plans.daily import run_day
from daybook.plans.gold import AGGREGATES
from daybook.schemas import ENTITIES, HISTORY_TABLE, LOG_TABLE, TABLES
from daybook.session import matching_folders, new_scratch_path
from daybook.sources.alerts import read_alerts
from daybook.sources.drops import read_text, write_drop
from daybook.sources.tables import Lake

# Run dates of the catalogue's drops.
WEEK = tuple(f"2026-02-0{d}" for d in range(1, 8))
SOURCES = {"policies": "policies", "policyholders": "policyholders_week", "payments": "payments"}
LAST, TODAY = "2026-01-30", "2026-02-10"

_built: dict[tuple[str, str], Lake] = {}


def write_landing(spark: SparkSession, sf_dir: str, base: str, dates: tuple[str, ...] = WEEK) -> None:
    def write(place: tuple[str, str]) -> None:
        entity, run_date = place
        rows = raw(spark, sf_dir, SOURCES[entity]).select(*ENTITIES[entity].columns)
        write_drop(rows.where(F.col("runDate") == run_date), f"{base}/landing", entity, run_date)

    with ThreadPoolExecutor(8) as pool:
        list(pool.map(write, product(SOURCES, dates)))


def week(spark: SparkSession, sf_dir: str) -> Lake:
    """The lake after seven days. The catalog forgets it; its files stay for the results."""
    place = (spark.sparkContext.applicationId, sf_dir)
    lake = _built.get(place)
    if lake is None or not matching_folders(spark, lake.base):
        lake = Lake(spark, new_scratch_path(spark, "week"), f"daybook_{uuid.uuid4().hex}").create()
        try:
            write_landing(spark, sf_dir, lake.base)
            for run_date in WEEK:
                run_day(lake, run_date, export_csv="true", from_landing=True, at_once=3)
        finally:
            spark.sql(f"DROP DATABASE IF EXISTS `{lake.database}` CASCADE")
        _built[place] = lake
    return lake


def _stored(table: str, *leave_out: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return week(spark, sf_dir).read_files(table).drop("_loaded_at", "_sourceFile", "rejected_at", *leave_out)

    return query


def week_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exported snapshots of the premium aggregate, all dates."""
    lake, table = week(spark, sf_dir), AGGREGATES[0].table
    types = {f.name: f.dataType.simpleString() for f in TABLES[table].schema}
    exported = [read_text(spark, lake.export_path(run_date, AGGREGATES[0].export_name)) for run_date in WEEK]
    rows = exported[0]
    for more in exported[1:]:
        rows = rows.unionByName(more)
    return as_typed(rows, types).drop("_loaded_at")


def week_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = week(spark, sf_dir).read_files(LOG_TABLE)
    counts = ("rows_read", "rows_valid", "rows_rejected")
    return log.where(F.col("layer").isin("bronze", "silver")).select("pipeline_name", "layer", "entity", "runDate", "status", *counts)


def week_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per run; the run id ends with the time of the attempt, which is left out here."""
    alerts = read_alerts(spark, f"{week(spark, sf_dir).base}/logs/alerts")
    run = F.regexp_extract("runId", r"^(daily_batch-\d{4}-\d{2}-\d{2})-\d{8}T\d{12}Z$", 1)
    return alerts.drop("triggerTimeUtc").withColumn("runId", run)


def week_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run dates still to do, from the log that the runs wrote, and the mark before the first gap."""
    log = week(spark, sf_dir).read_files(LOG_TABLE)
    steps = [a.export_name for a in AGGREGATES]
    last, today = (F.lit(d).cast("date") for d in (LAST, TODAY))
    pending = run_plan(log, last, today, "gold", steps).select("runDate", F.lit("pending").alias("state"))
    done_up_to = mark(log, F.lit(WEEK[0]).cast("date"), today, "gold", steps).select(F.col("mark").alias("runDate"), F.lit("mark").alias("state"))
    return pending.unionByName(done_up_to)


QUERIES = {
    "q44_day_bronze_payments": _stored("bronze_payments"),
    "q45_day_rejects_policies": _stored("rejects_silver_policies"),
    "q46_day_silver_payments": _stored("silver_payments"),
    "q47_day_history": _stored(HISTORY_TABLE),
    "q48_day_gold_export": week_export,
    "q49_day_log": week_log,
    "q50_day_alerts": week_alerts,
    "q51_day_pending": week_pending,
}
