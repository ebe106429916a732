"""Named queries: each runs library operators over whole star tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.catalogue import week
from daybook.catalogue.views import raw
from daybook.functions.digest import attribute_hash
from daybook.functions.typing import as_text, as_typed
from daybook.operators import runs
from daybook.operators.aggregates import active_policies_daily, payments_daily, written_premium_daily
from daybook.operators.checks import duplicate_keys
from daybook.operators.dedupe import one_per_run_key
from daybook.operators.history import (
    as_versions,
    changed_versions,
    current_versions,
    expired_versions,
    history_of_days,
    scd2_apply,
)
from daybook.operators.rules import BRONZE_RULES, SILVER_RULES
from daybook.operators.star import daily_totals, valid_at, versions_between
from daybook.operators.upsert import upsert, upsert_columns
from daybook.plans.history import load_history, load_history_days
from daybook.plans.merge import merge_run
from daybook.plans.partials import GROUPS, premium_from_states, refresh_states
from daybook.schemas import ENTITIES, HISTORY_TABLE, RUN, TABLES, Table
from daybook.session import new_scratch_path, session_setting, write_scratch
from daybook.sources.drops import copy_drop, drop_path, read_text, write_csv
from daybook.sources.keyed import KeyedStore
from daybook.sources.tables import Lake

Query = Callable[[SparkSession, str], DataFrame]

HOLDERS = ENTITIES["policyholders"]
FIRST_DAY, SECOND_DAY = "2026-02-01", "2026-02-02"
LAST_OLD_RUN, NEXT_RUN = "2026-02-04", "2026-02-05"
# A step of the derived log counts as failed from this share of rejected rows on, in percent.
FAILED_SHARE = 6.0
# What a task reads at most of a table whose rows it sorts.
SPLIT = "16m"


# Layers as frames


def bronze(spark: SparkSession, sf_dir: str, entity: str, source: str | None = None) -> DataFrame:
    return as_typed(BRONZE_RULES[entity].valid(raw(spark, sf_dir, source or entity)), ENTITIES[entity].conversions)


def bronze_rejects(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    return BRONZE_RULES[entity].rejects(raw(spark, sf_dir, entity)).drop("rejected_at")


def clean(spark: SparkSession, sf_dir: str, entity: str, source: str | None = None) -> DataFrame:
    return one_per_run_key(SILVER_RULES[entity].valid(bronze(spark, sf_dir, entity, source)), ENTITIES[entity])


def stored_clean(spark: SparkSession, sf_dir: str, entity: str, source: str | None = None) -> DataFrame:
    """The clean rows as a stored table, for queries that use them more than once.

    One row per key is chosen in the tasks that read, which sort what they read: small splits bound that.
    """
    with session_setting(spark, "spark.sql.files.maxPartitionBytes", SPLIT):
        return write_scratch(clean(spark, sf_dir, entity, source), f"clean-{entity}")[0]


def silver_rejects(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    rejects = SILVER_RULES[entity].rejects(bronze(spark, sf_dir, entity), undecided=False)
    return as_text(rejects.drop("rejected_at"), ENTITIES[entity].conversions)


# Upserts: an older state, and a later delivery that adds rows and corrects some old ones


def _old_and_new(rows: DataFrame, column: str, was: str, becomes: str) -> tuple[DataFrame, DataFrame]:
    old = rows.where(F.col(RUN) <= LAST_OLD_RUN)
    corrected = old.where(F.col(column) == was).withColumns({column: F.lit(becomes), RUN: F.lit(NEXT_RUN)})
    return old, rows.where(F.col(RUN) > LAST_OLD_RUN).withColumn(RUN, F.lit(NEXT_RUN)).unionByName(corrected)


def upsert_policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _old_and_new(stored_clean(spark, sf_dir, "policies"), "status", "Cancelled", "Active")
    return upsert(old, new, ENTITIES["policies"].key)


def upsert_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _old_and_new(stored_clean(spark, sf_dir, "payments"), "method", "CHECK", "ACH")
    return upsert(old, new, ENTITIES["payments"].key)


def _holder_days(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    holders = stored_clean(spark, sf_dir, "policyholders")
    return holders.where(F.col(RUN) == FIRST_DAY), holders.where(F.col(RUN) == SECOND_DAY)


def upsert_holders(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = _holder_days(spark, sf_dir)
    return upsert(first, second, HOLDERS.key)


def upsert_keep_newer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first day delivered again after the second: rows the second day wrote stay."""
    first, second = _holder_days(spark, sf_dir)
    return upsert(second, first, HOLDERS.key, newer_by=RUN)


# History


def holder_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(spark, sf_dir, "policyholders").select(
        *HOLDERS.key, RUN, attribute_hash(HOLDERS.tracked).alias("attr_hash")
    )


def _versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Both days as versions. The first day's, all open, are also the history after the first load."""
    first, second = _holder_days(spark, sf_dir)
    return as_versions(first, HOLDERS.tracked, FIRST_DAY), as_versions(second, HOLDERS.tracked, SECOND_DAY)


def holder_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    history, second = _versions(spark, sf_dir)
    return changed_versions(second, history, HOLDERS.key)


def scd2_expired(spark: SparkSession, sf_dir: str) -> DataFrame:
    history, second = _versions(spark, sf_dir)
    return expired_versions(history, changed_versions(second, history, HOLDERS.key), HOLDERS.key)


def scd2_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    history, second = _versions(spark, sf_dir)
    return scd2_apply(history, second, HOLDERS.key)


def scd2_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = ("holder_id", "policy_id", "effective_start_date", "effective_end_date", "is_current")
    return scd2_history(spark, sf_dir).select(*listed).orderBy(*listed[:3])


def scd2_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current_versions(scd2_history(spark, sf_dir))


def week_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven holder snapshots as one history, in one plan."""
    return history_of_days(stored_clean(spark, sf_dir, "policyholders", "policyholders_week"), HOLDERS.tracked, HOLDERS.key)


# Aggregates


def gold_written_premium(spark: SparkSession, sf_dir: str) -> DataFrame:
    return written_premium_daily(clean(spark, sf_dir, "policies")).orderBy(RUN, "day", "state", "product")


def gold_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payments_daily(clean(spark, sf_dir, "payments")).orderBy(RUN, "day")


def gold_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    return active_policies_daily(clean(spark, sf_dir, "policies")).orderBy(RUN, "day")


def gold_full_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return written_premium_daily(clean(spark, sf_dir, "policies"), by=())


def fact_dimension_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A policy may come with several effective dates: a payment counts once, under the one valid on its day."""
    payments = clean(spark, sf_dir, "payments")
    dimension = clean(spark, sf_dir, "policies")
    return daily_totals(payments, dimension, "policy_id", "payment_date", "amount", "product", "effective_date")


def endorsed_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third policy gets another product half a year after it took effect; payments before that day are left out."""
    policies = clean(spark, sf_dir, "policies").select("policy_id", "effective_date", "product")
    changed = policies.where(F.substring("policy_id", 2, 20).cast("bigint") % 3 == 0).select(
        "policy_id", F.date_add("effective_date", 180).alias("effective_date"), F.concat("product", F.lit(" PLUS")).alias("product")
    )
    payments = clean(spark, sf_dir, "payments")
    dimension = policies.unionByName(changed)
    return daily_totals(payments, dimension, "policy_id", "payment_date", "amount", "product", "effective_date", early=False)


def payments_by_holder_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments of each run under the state that the policy's holder had on that day, from the history of all days."""
    history = week_history(spark, sf_dir).select("policy_id", "state", "effective_start_date", "effective_end_date")
    versions = versions_between(history, "effective_start_date", "effective_end_date").drop("effective_start_date", "effective_end_date")
    # Used twice: for the bins that payments fall into, and for the join.
    payments = stored_clean(spark, sf_dir, "payments").select("policy_id", "payment_id", RUN)
    placed = valid_at(payments, versions, ["policy_id"], RUN)
    return placed.groupBy(RUN, "state").agg(F.count(F.lit(1)).alias("n_payments"))


# Tables and files


@contextmanager
def _scratch_lake(spark: SparkSession, *tables: str) -> Iterator[Lake]:
    """A lake of its own in the shared scratch folder, with only the tables asked for.

    The catalog forgets it afterwards; its files stay for the result, which is read from storage.
    """
    lake = Lake(spark, new_scratch_path(spark, "lake"), f"daybook_{uuid.uuid4().hex}")
    try:
        yield lake.create(tables)
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS `{lake.database}` CASCADE")


def _stored(df: DataFrame, table: str) -> DataFrame:
    """Columns a stored row has and a computed frame lacks."""
    missing = [f for f in TABLES[table].schema if f.name not in df.columns]
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})


def gold_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All runs stored, one replaced by a recomputation over card payments, one cleared, one replaced by nothing."""
    table = "gold_payments_daily"
    payments = stored_clean(spark, sf_dir, "payments")
    card = payments.where((F.col(RUN) == "2026-02-03") & (F.col("method") == "CC"))
    none = payments.where((F.col(RUN) == "2026-02-05") & (F.col("method") == "CASH"))
    with _scratch_lake(spark, table) as lake:
        lake.overwrite_partitions(table, _stored(payments_daily(payments), table).hint("rebalance", RUN))
        lake.replace_partition(table, _stored(payments_daily(card), table), "2026-02-03")
        lake.replace_partition(table, _stored(payments_daily(none), table), "2026-02-05")
        lake.clear_partition(table, "2026-02-07")
    return lake.read_files(table).drop("_loaded_at")


def rows_per_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = "bronze_policies"
    with _scratch_lake(spark, table) as lake:
        lake.append(table, _stored(bronze(spark, sf_dir, "policies"), table).hint("rebalance", RUN))
    return lake.read_files(table).groupBy(RUN).agg(F.count(F.lit(1)).alias("n_rows"))


def gold_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = "gold_payments_daily"
    result = _stored(payments_daily(clean(spark, sf_dir, "payments")), table)
    with _scratch_lake(spark, table) as lake:
        lake.overwrite_partitions(table, result.hint("rebalance", RUN))
        path = f"{lake.base}/export"
        write_csv(lake.read(table).drop("_loaded_at"), path, one_file=True)
    types = {f.name: f.dataType.simpleString() for f in TABLES[table].schema}
    return as_typed(read_text(spark, path), types)


def raw_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Policies as a landing drop of several part files, copied with every field quoted, and read back."""
    base = new_scratch_path(spark, "drops")
    landing, copied = (drop_path(f"{base}/{zone}", "policies", FIRST_DAY) for zone in ("landing", "raw"))
    write_csv(raw(spark, sf_dir, "policies").drop(RUN), landing)
    copy_drop(spark, landing, copied)
    return read_text(spark, copied)


def table_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The policies upsert on stored tables."""
    table = "silver_policies"
    old, new = _old_and_new(_stored(stored_clean(spark, sf_dir, "policies"), table), "status", "Cancelled", "Active")
    with _scratch_lake(spark, table) as lake:
        lake.overwrite_partitions(table, old.hint("rebalance", RUN))
        merge_run(lake, table, new, NEXT_RUN)
    return lake.read_files(table).drop("_loaded_at", "_sourceFile")


def table_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both holder days applied to the stored history, the second one twice."""
    first, second = (_stored(day, HOLDERS.silver) for day in _holder_days(spark, sf_dir))
    with _scratch_lake(spark, HISTORY_TABLE) as lake:
        for day, snapshot in ((FIRST_DAY, first), (SECOND_DAY, second), (SECOND_DAY, second)):
            load_history(lake, day, snapshot)
    return lake.read_files(HISTORY_TABLE).drop("_loaded_at", "_sourceFile")


def table_history_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored history: two days one by one, four in one plan, the last one again by itself and repeated."""
    snapshots = _stored(stored_clean(spark, sf_dir, "policyholders", "policyholders_week"), HOLDERS.silver)

    def day(run_date: str) -> DataFrame:
        return snapshots.where(F.col(RUN) == run_date)

    with _scratch_lake(spark, HISTORY_TABLE) as lake:
        for run_date in week.WEEK[:2]:
            load_history(lake, run_date, day(run_date))
        load_history_days(lake, week.WEEK[2:6], snapshots)
        for run_date in (week.WEEK[6], week.WEEK[6]):
            load_history(lake, run_date, day(run_date))
    return lake.read_files(HISTORY_TABLE).drop("_loaded_at", "_sourceFile")


def upsert_first_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An upsert that updates all columns but the day a row was first loaded."""

    def loaded(rows: DataFrame, run_date: str) -> DataFrame:
        return rows.withColumn("first_loaded", F.lit(run_date))

    old, new = _old_and_new(stored_clean(spark, sf_dir, "policies"), "status", "Cancelled", "Active")
    update = [c for c in old.columns if c not in ENTITIES["policies"].key]
    return upsert_columns(loaded(old, LAST_OLD_RUN), loaded(new, NEXT_RUN), ENTITIES["policies"].key, update=update)


def saved_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table made from the first day's clean holders, to which the later ones are added with their columns in another order."""
    rows = stored_clean(spark, sf_dir, "policyholders", "policyholders_week")
    first = rows.where(F.col(RUN) == FIRST_DAY)
    later = rows.where(F.col(RUN) > FIRST_DAY).select(*reversed(rows.columns))
    with _scratch_lake(spark) as lake:
        lake.save_by_name("kept_by_name", first)
        lake.save_by_name("kept_by_name", later)
        return write_scratch(spark.table(lake.name("kept_by_name")), "by-name")[0]


def _premium_states(spark: SparkSession, sf_dir: str, by: tuple[str, ...]) -> DataFrame:
    """The premium over all runs from daily states: computed for the old runs, then for what a merge has touched."""
    table = "silver_policies"
    old, new = _old_and_new(_stored(stored_clean(spark, sf_dir, "policies"), table), "status", "Cancelled", "Active")
    with _scratch_lake(spark, table) as lake:
        lake.overwrite_partitions(table, old.hint("rebalance", RUN))
        refresh_states(lake)
        merge_run(lake, table, new, NEXT_RUN)
        refresh_states(lake)
        return premium_from_states(lake, by)


def premium_from_daily_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _premium_states(spark, sf_dir, GROUPS)


def policies_per_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A coarser aggregate from the same states: distinct policies over all days."""
    return _premium_states(spark, sf_dir, ("state",))


def keyed_store_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The policies upsert on a table in hash buckets of its key."""
    rows = stored_clean(spark, sf_dir, "policies")
    table = Table("policies", "silver", "policies", rows.schema, key=ENTITIES["policies"].key)
    old, new = _old_and_new(rows, "status", "Cancelled", "Active")
    with _scratch_lake(spark) as lake:
        store = KeyedStore(lake, table, slots=16, buckets=8).create()
        store.merge(old)
        store.merge(new)
        return write_scratch(store.read(), "keyed-store")[0]


# Runs


def run_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [
        runs.layer_counts(raw(spark, sf_dir, name), BRONZE_RULES[name], SILVER_RULES[name], entity)
        for name, entity in ENTITIES.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def recent_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.recent(run_counts(spark, sf_dir), 20, F.col("runDate").desc(), F.col("layer"), F.col("entity"))


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log rows from the counts; a step with too many rejected rows counts as failed."""
    share = F.round(100 * F.col("rows_rejected") / F.col("rows_read"), 1)
    failed = 100 * F.col("rows_rejected") >= FAILED_SHARE * F.col("rows_read")
    started = F.to_timestamp(F.concat("runDate", F.lit("T00:00:00Z")))
    minutes = F.when(F.col("layer") == "bronze", 1).otherwise(2)
    return run_counts(spark, sf_dir).select(
        F.lit("daily_batch").alias("pipeline_name"),
        *("layer", "entity", "runDate"),
        F.when(failed, runs.FAILED).otherwise(runs.SUCCESS).alias("status"),
        *("rows_read", "rows_valid", "rows_rejected"),
        (60 * minutes).cast("int").alias("duration_sec"),
        F.when(failed, F.concat(F.col("rows_rejected"), F.lit(" rows rejected"))).otherwise("").alias("message"),
        started.alias("started_at"),
        (started + F.make_dt_interval(mins=minutes)).alias("ended_at"),
    )


def run_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    last, today = F.lit("2026-01-30").cast("date"), F.lit("2026-02-10").cast("date")
    return runs.run_plan(_log(spark, sf_dir), last, today, layer="bronze", required=("policies", "payments"))


def run_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.run_status(_log(spark, sf_dir), export_csv="false")


def duplicate_payment_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = SILVER_RULES["payments"].valid(bronze(spark, sf_dir, "payments"))
    return duplicate_keys(valid, ("payment_id", RUN))


def _of(build: Callable[[SparkSession, str, str], DataFrame], entity: str) -> Query:
    return lambda spark, sf_dir: build(spark, sf_dir, entity)


QUERIES: dict[str, Query] = {
    "q01_bronze_policies": _of(bronze, "policies"),
    "q02_bronze_policies_rejects": _of(bronze_rejects, "policies"),
    "q03_bronze_holders": _of(bronze, "policyholders"),
    "q04_bronze_holders_rejects": _of(bronze_rejects, "policyholders"),
    "q05_bronze_payments": _of(bronze, "payments"),
    "q06_bronze_payments_rejects": _of(bronze_rejects, "payments"),
    "q07_silver_policies": _of(clean, "policies"),
    "q08_silver_policies_rejects": _of(silver_rejects, "policies"),
    "q09_silver_payments": _of(clean, "payments"),
    "q10_silver_payments_rejects": _of(silver_rejects, "payments"),
    "q11_silver_holders": _of(clean, "policyholders"),
    "q12_silver_holders_rejects": _of(silver_rejects, "policyholders"),
    "q13_upsert_policies": upsert_policies,
    "q14_upsert_payments": upsert_payments,
    "q15_upsert_holders": upsert_holders,
    "q16_holder_hash": holder_hash,
    "q17_holder_changes": holder_changes,
    "q18_scd2_expired": scd2_expired,
    "q19_scd2_history": scd2_history,
    "q20_gold_written_premium": gold_written_premium,
    "q21_gold_payments": gold_payments,
    "q22_gold_active": gold_active,
    "q23_gold_rerun": gold_rerun,
    "q24_run_counts": run_counts,
    "q25_rows_per_run": rows_per_run,
    "q26_recent_runs": recent_runs,
    "q27_scd2_listing": scd2_listing,
    "q28_gold_export": gold_export,
    "q29_raw_copy": raw_copy,
    "q30_run_plan": run_plan,
    "q31_gold_full_refresh": gold_full_refresh,
    "q32_duplicate_keys": duplicate_payment_keys,
    "q33_run_status": run_status,
    "q34_table_merge": table_merge,
    "q35_table_history": table_history,
    "q36_fact_dimension_daily": fact_dimension_daily,
    "q37_scd2_current": scd2_current,
    "q38_upsert_keep_newer": upsert_keep_newer,
    "q39_history_of_days": week_history,
    "q40_table_history_week": table_history_week,
    "q41_upsert_first_loaded": upsert_first_loaded,
    "q42_endorsed_daily": endorsed_daily,
    "q43_payments_by_holder_state": payments_by_holder_state,
    "q52_keyed_store_merge": keyed_store_merge,
    "q53_premium_from_states": premium_from_daily_states,
    "q54_policies_per_state": policies_per_state,
    "q55_saved_by_name": saved_by_name,
} | week.QUERIES
