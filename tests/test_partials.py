"""Aggregates from partial states equal aggregates over all clean rows, and only stale runs are read again."""

import random

from pyspark.sql import functions as F

from daybook.operators.aggregates import written_premium_daily
from daybook.plans.merge import merge_run
from daybook.plans.partials import number_policies, premium_from_states, refresh_states, stale_runs
from daybook.schemas import RUN, TABLES

TABLE = "silver_policies"


def policies(spark, rows, run):
    data = [(f"P{p}", prod, st, f"2026-01-0{d}", float(v), "Active", run, "f", run) for (p, d), (prod, st, v) in rows.items()]
    df = spark.createDataFrame(
        data,
        "policy_id string, product string, state string, effective_date string, written_premium double, status string, "
        "runDate string, _sourceFile string, _runDate string",
    )
    return df.withColumns({"effective_date": F.col("effective_date").cast("date"), "_loaded_at": F.current_timestamp()}).select(*TABLES[TABLE].columns)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_states_follow_the_table(spark, lake):
    rng = random.Random(6)
    assert refresh_states(lake) == [] and premium_from_states(lake).collect() == []
    for run in ("2026-02-01", "2026-02-02", "2026-02-03"):
        batch = {(rng.randrange(30), rng.randrange(1, 4)): (rng.choice("AB"), rng.choice(["TX", None]), rng.randrange(1, 9999) / 100) for _ in range(25)}
        merge_run(lake, TABLE, policies(spark, batch, run), run)
        stale = set(stale_runs(lake))
        assert run in stale and set(refresh_states(lake)) == stale
        assert refresh_states(lake) == []
        whole = written_premium_daily(lake.read(TABLE), by=())
        got = premium_from_states(lake).select(*whole.columns)
        assert found(got) == found(whole)
        coarse = lake.read(TABLE).groupBy("state").agg(F.count_distinct("policy_id").alias("n"))
        assert found(premium_from_states(lake, ["state"]).select("state", "policy_count")) == found(coarse)
    numbers = number_policies(lake, lake.read(TABLE)).collect()
    assert sorted(r["number"] for r in numbers) == list(range(1, len(numbers) + 1))
    assert len({r["policy_id"] for r in numbers}) == len(numbers)


def test_a_run_that_was_replaced_whole_leaves_no_state(spark, lake):
    rows = {(1, 1): ("A", "TX", 5.0)}
    merge_run(lake, TABLE, policies(spark, rows, "2026-02-01"), "2026-02-01")
    refresh_states(lake)
    merge_run(lake, TABLE, policies(spark, rows, "2026-02-02"), "2026-02-02")
    assert refresh_states(lake) == ["2026-02-01", "2026-02-02"]
    assert [(r["written_premium"], r["policy_count"]) for r in premium_from_states(lake).collect()] == [(5.0, 1)]
    assert refresh_states(lake) == [] and lake.read(TABLE).select(RUN).distinct().count() == 1
