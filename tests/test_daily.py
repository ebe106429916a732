"""Whole days end to end: landing files to aggregates, compared with SQL over the same rows."""

import json
import os
import shutil

import pytest
from pyspark.sql import functions as F

from daybook.catalogue import oracle
from daybook.catalogue.views import raw
from daybook.plans.bronze import load_bronze, read_malformed
from daybook.plans.daily import completed_mark, is_true, pending_runs, run_day, run_range
from daybook.plans.gold import AGGREGATES, full_refresh
from daybook.plans.history import load_history, load_history_days
from daybook.plans.runlog import recent_log
from daybook.schemas import ENTITIES, HISTORY_TABLE, LOG_TABLE, RUN, TABLES
from daybook.sources.alerts import read_alerts
from daybook.sources.drops import copy_drop, read_text, write_drop
from daybook.sources.tables import Lake
from daybook.streaming.arrivals import follow_drops
from tests.compare import connect, digest

SF = "/root/testdata/sf0.001"
DAYS = ("2026-02-01", "2026-02-02")
EMPTY_DAY = "2026-02-03"
NOT_COMPARED = ("_sourceFile", "_loaded_at", "rejected_at")


def landing(spark, base, zone):
    for entity in ENTITIES:
        rows = raw(spark, SF, entity).drop(RUN).cache()
        for day in DAYS:
            write_drop(rows.where(F.col("runDate") == day), f"{base}/{zone}", entity, day)
        # A drop with a header and no rows.
        write_drop(rows.limit(0), f"{base}/{zone}", entity, EMPTY_DAY)
        rows.unpersist()


@pytest.fixture(scope="module")
def done(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("lake"))
    landing(spark, base, "landing")
    lake = Lake(spark, base, "daily").create()
    for day in DAYS:
        run_day(lake, day, "yes", from_landing=True, environment="test")
    return lake


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def table_digest(lake, name):
    df = lake.read(name)
    df = df.drop(*[c for c in NOT_COMPARED if c in df.columns])
    return digest(df.columns, [tuple(r) for r in df.collect()])


def sql_digest(con, sql):
    relation = con.sql(f"SELECT * FROM ({sql}) WHERE _runDate IN {DAYS}")
    return digest(relation.columns, relation.fetchall())


def expected(con):
    """Table name to digest, for every table except the log."""
    out = {}
    for name, entity in ENTITIES.items():
        out[entity.bronze] = sql_digest(con, oracle.bronze(name))
        out[entity.bronze_rejects] = sql_digest(con, oracle.bronze_rejects(name))
        rejected = (
            f"SELECT {oracle.TEXT[name]}, CASE WHEN {oracle.SILVER_FAILED[name]} THEN '{oracle.SILVER_REASON[name]}' "
            f"ELSE '{oracle.SILVER_DOUBT[name]}' END AS reject_reason FROM ({oracle.bronze(name)}) WHERE {oracle.SILVER_REJECTED[name]}"
        )
        out[entity.silver_rejects] = sql_digest(con, rejected)
        if name != "policyholders":
            out[entity.silver] = sql_digest(con, oracle.clean(name))
    out["silver_policyholders_current"] = sql_digest(con, oracle.ORACLE["q15_upsert_holders"])
    out[HISTORY_TABLE] = sql_digest(con, oracle.ORACLE["q19_scd2_history"])
    out["gold_written_premium_daily"] = sql_digest(con, oracle.ORACLE["q20_gold_written_premium"])
    out["gold_payments_daily"] = sql_digest(con, oracle.ORACLE["q21_gold_payments"])
    out["gold_active_policies_daily"] = sql_digest(con, oracle.ORACLE["q22_gold_active"])
    return out


def test_every_table_matches_sql(done, con):
    wanted = expected(con)
    assert set(wanted) | {LOG_TABLE} == set(TABLES)
    for name, value in wanted.items():
        assert table_digest(done, name) == value, name
        assert value[1] > 0, name


def test_log_counts_and_alerts(spark, done):
    rows = {(r["layer"], r["entity"], r["runDate"]): r for r in done.read(LOG_TABLE).collect()}
    # Three copies, three bronze, three silver, one history, three aggregates and their exports.
    assert len(rows) == 2 * 16 and {r["status"] for r in rows.values()} == {"SUCCESS"}
    for name in ENTITIES:
        assert rows["raw", name, DAYS[0]]["rows_read"] == rows["bronze", name, DAYS[0]]["rows_read"] > 0
    for name, entity in ENTITIES.items():
        for day in DAYS:
            bronze, silver = rows["bronze", name, day], rows["silver", name, day]
            assert bronze["rows_read"] == bronze["rows_valid"] + bronze["rows_rejected"]
            assert bronze["rows_valid"] == done.read_run(entity.bronze, day).count() == silver["rows_read"]
            assert bronze["rows_rejected"] == done.read_run(entity.bronze_rejects, day).count()
            assert silver["rows_rejected"] == done.read_run(entity.silver_rejects, day).count()
            assert silver["rows_valid"] + silver["rows_rejected"] <= silver["rows_read"]
            assert bronze["started_at"] <= bronze["ended_at"] and bronze["message"] == ""
    ends = [r["ended_at"] for r in recent_log(done, 5).collect()]
    assert len(ends) == 5 and ends == sorted(ends, reverse=True)
    alerts = {r["runDate"]: r for r in read_alerts(spark, f"{done.base}/logs/alerts").collect()}
    assert set(alerts) == set(DAYS)
    assert {(a["status"], a["environment"], a["exportCsv"]) for a in alerts.values()} == {("Success", "test", "true")}


def test_exports_hold_the_stored_run(spark, done):
    for aggregate in AGGREGATES:
        path = done.export_path(DAYS[1], aggregate.export_name)
        assert len([f for f in os.listdir(path) if f.startswith("part-")]) == 1
        exported, stored = read_text(spark, path), done.read_run(aggregate.table, DAYS[1])
        assert exported.columns == stored.columns and exported.count() == stored.count() > 0


def test_full_refresh_covers_all_runs(done):
    premium = full_refresh(done, AGGREGATES[0])
    assert RUN not in premium.columns
    total = premium.agg(F.sum("policy_count")).first()[0]
    assert total == done.read("silver_policies").count()


def test_rerun_changes_nothing_and_empty_day_adds_nothing(done, con):
    wanted = expected(con)
    run_day(done, DAYS[1])
    run_day(done, EMPTY_DAY, from_landing=True)
    for name, value in wanted.items():
        assert table_digest(done, name) == value, name
    alerts = [r["runDate"] for r in read_alerts(done.spark, f"{done.base}/logs/alerts").collect()]
    # One document per attempt: the first one of a date stays.
    assert sorted(alerts) == sorted([*DAYS, DAYS[1], EMPTY_DAY])
    empty = done.read(LOG_TABLE).where(F.col("runDate") == EMPTY_DAY)
    assert {(r["status"], r["rows_read"]) for r in empty.collect()} == {("SUCCESS", 0)}


def test_catch_up_and_failure(spark, done):
    assert pending_runs(done, "2026-01-31", "2026-02-05") == ["2026-02-04", "2026-02-05"]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        run_range(done, "2026-01-31", "2026-02-05")
    failed = done.read(LOG_TABLE).where(F.col("status") == "FAILED").collect()
    assert [(r["layer"], r["entity"], r["runDate"], r["rows_read"]) for r in failed] == [("bronze", "policies", "2026-02-04", 0)]
    assert "PATH_NOT_FOUND" in failed[0]["message"]
    folder = f"{done.base}/logs/alerts/pipeline=daily_batch/run=2026-02-04"
    (attempt,) = os.listdir(folder)
    (name,) = [f for f in os.listdir(f"{folder}/{attempt}") if f.endswith(".json")]
    with open(f"{folder}/{attempt}/{name}") as f:
        alert = json.loads(f.read())
    assert len(alert) == 10 and alert["status"] == "Failure" and alert["activityName"] == "bronze/policies"
    assert pending_runs(done, "2026-01-31", "2026-02-03") == []
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        run_day(done, "2026-02-05", from_landing=True)
    last = recent_log(done, 1).first()
    assert (last["layer"], last["entity"], last["status"]) == ("raw", "policies", "FAILED")
    assert os.path.isdir(f"{done.base}/logs/alerts/pipeline=daily_batch/run=2026-02-05")


def test_a_late_date_completes_and_leaves_newer_rows_alone(spark, tmp_path):
    base = str(tmp_path / "late")
    landing(spark, base, "raw")
    lake = Lake(spark, base, "late").create()
    run_day(lake, DAYS[1])
    keys = {e.silver: (e.key, lake.read_run(e.silver, DAYS[1]).select(*e.key).collect()) for e in ENTITIES.values()}
    assert run_range(lake, "2026-01-31", DAYS[1]) == [DAYS[0]]
    assert pending_runs(lake, "2026-01-31", DAYS[1]) == []
    for table, (key, before) in keys.items():
        assert sorted(lake.read_run(table, DAYS[1]).select(*key).collect()) == sorted(before)
        late = lake.read_run(table, DAYS[0]).count()
        log = lake.read(LOG_TABLE).where((F.col("layer") == "silver") & (F.col("runDate") == DAYS[0]))
        assert late in [r["rows_valid"] for r in log.collect()]
    current = lake.read(HISTORY_TABLE).where("is_current")
    assert current.count() == lake.read(ENTITIES["policyholders"].silver).count()
    for aggregate in AGGREGATES:
        assert lake.read_run(aggregate.table, DAYS[1]).count() > 0


def test_a_late_date_run_by_hand_leaves_newer_rows_alone(spark, tmp_path):
    base = str(tmp_path / "byhand")
    landing(spark, base, "raw")
    lake = Lake(spark, base, "byhand").create()
    run_day(lake, DAYS[1])
    before = {e.silver: sorted(lake.read_run(e.silver, DAYS[1]).collect()) for e in ENTITIES.values()}
    run_day(lake, DAYS[0])
    for table, rows in before.items():
        assert sorted(lake.read_run(table, DAYS[1]).collect()) == rows
    assert pending_runs(lake, "2026-01-31", DAYS[1]) == [] and completed_mark(lake, DAYS[0], EMPTY_DAY) == DAYS[1]


def test_broken_records_lose_no_value_and_the_drop_is_parsed_once(spark, tmp_path, monkeypatch):
    lake = Lake(spark, str(tmp_path / "broken"), "broken").create([e.bronze for e in ENTITIES.values()] + [e.bronze_rejects for e in ENTITIES.values()])
    entity, day = ENTITIES["payments"], "2026-02-01"
    lines = [
        ",".join(entity.columns),
        'A1,P1,1.50,2026-02-01,"ACH",2026-02-01',
        'A2,P2,2.50,2026-02-01,"two\nlines, one value",2026-02-01',
        "A3,P3,3.50,2026-02-01,ACH,2026-02-01,surplus,values",
        "A4,P4,4.50",
        "A5,P5,abc,2026-02-01,ACH,2026-02-01",
    ]
    folder = lake.drop_path("landing", "payments", day)
    os.makedirs(folder)
    with open(f"{folder}/part-0.csv", "w") as f:
        f.write("\n".join(lines) + "\n")
    for zone in ("copied", "direct"):
        raw_folder = lake.drop_path("raw", "payments", day)
        if zone == "copied":
            assert copy_drop(spark, folder, raw_folder) == 5
        else:
            shutil.rmtree(raw_folder)
            shutil.copytree(folder, raw_folder)
        # The drop is gone once the first table is written: whatever follows reads the rows parsed before.
        replace = lake.replace_partition

        def then_gone(*args, **kwargs):
            shutil.rmtree(raw_folder, ignore_errors=True)
            replace(*args, **kwargs)

        with monkeypatch.context() as patch:
            patch.setattr(lake, "replace_partition", then_gone)
            assert load_bronze(lake, entity, day) == (5, 2, 3)
        os.makedirs(raw_folder, exist_ok=True)
        valid = {r["payment_id"]: (r["amount"], r["method"]) for r in lake.read_run(entity.bronze, day).collect()}
        assert valid == {"A1": (1.5, "ACH"), "A2": (2.5, "two\nlines, one value")}
        reasons = sorted(r["reject_reason"] for r in lake.read_run(entity.bronze_rejects, day).collect())
        assert reasons == ["PAYMENT_BASIC_VALIDATION_FAILED", "PAYMENT_MALFORMED_RECORD", "PAYMENT_MALFORMED_RECORD"]
        records = {r["record"].strip() for r in read_malformed(lake, entity, day).collect()}
        assert records == set(lines[3:5])
    # A clean drop leaves nothing of them behind.
    with open(f"{raw_folder}/part-0.csv", "w") as f:
        f.write("\n".join(lines[:2]) + "\n")
    assert load_bronze(lake, entity, day) == (1, 1, 0)
    assert lake.read_run(entity.bronze_rejects, day).count() == 0
    assert not os.path.exists(lake.malformed_path("payments", day))


def test_days_applied_together_equal_days_applied_one_by_one(spark, done, tmp_path):
    one, many = (Lake(spark, str(tmp_path / n), f"days_{n}").create([HISTORY_TABLE, "bronze_policyholders"]) for n in ("one", "many"))
    many.append("bronze_policyholders", done.read("bronze_policyholders"))
    for day in DAYS:
        load_history(one, day, done.read_run("bronze_policyholders", day).where("full_name IS NOT NULL"))
    for dates in (DAYS, DAYS[1:]):
        load_history_days(many, dates)
        assert table_digest(many, HISTORY_TABLE) == table_digest(one, HISTORY_TABLE)


def test_append_mode_adds_rows_again(done):
    entity = ENTITIES["payments"]
    before = done.read_run(entity.bronze, DAYS[0]).count(), done.read_run(entity.bronze_rejects, DAYS[0]).count()
    counts = load_bronze(done, entity, DAYS[0], mode="append")
    after = done.read_run(entity.bronze, DAYS[0]).count(), done.read_run(entity.bronze_rejects, DAYS[0]).count()
    assert after == tuple(2 * n for n in before) and (counts.valid, counts.rejected) == before
    load_bronze(done, entity, DAYS[0])
    assert done.read_run(entity.bronze, DAYS[0]).count() == before[0]
    with pytest.raises(ValueError):
        load_bronze(done, entity, DAYS[0], mode="other")


def test_history_heals_after_a_crash_between_its_two_writes(spark, done, con, tmp_path):
    """Closed versions written, open ones not: both states show until the rerun."""
    lake = Lake(spark, str(tmp_path), "crashed").create([HISTORY_TABLE])
    snapshots = {day: done.read_run("bronze_policyholders", day).where("full_name IS NOT NULL") for day in DAYS}
    load_history(lake, DAYS[0], snapshots[DAYS[0]])
    write = lake.overwrite_partitions
    calls = []

    def crash_on_second(table, df):
        calls.append(table)
        if len(calls) == 2:
            raise RuntimeError("lost driver")
        write(table, df)

    lake.overwrite_partitions = crash_on_second
    with pytest.raises(RuntimeError):
        load_history(lake, DAYS[1], snapshots[DAYS[1]])
    lake.overwrite_partitions = write
    for _ in range(2):
        load_history(lake, DAYS[1], snapshots[DAYS[1]])
        assert table_digest(lake, HISTORY_TABLE) == sql_digest(con, oracle.ORACLE["q19_scd2_history"])
    changed = snapshots[DAYS[0]].withColumn("city", F.lit("elsewhere"))
    with pytest.raises(ValueError, match="back-dated"):
        load_history(lake, DAYS[0], changed)
    assert load_history(lake, DAYS[0], snapshots[DAYS[0]].limit(0)).valid == 0


def test_stream_runs_the_dates_that_received_files(spark, done, tmp_path):
    base = str(tmp_path / "lake")
    landing(spark, base, "raw")
    lake = Lake(spark, base, "streamed").create()
    checkpoint = str(tmp_path / "checkpoint")
    for _ in range(2):
        query = follow_drops(lake, checkpoint)
        query.awaitTermination()
        assert query.exception() is None
    runs = [r["runDate"] for r in lake.read(LOG_TABLE).where("layer = 'bronze' AND entity = 'policies'").orderBy("ended_at").collect()]
    assert runs == [*DAYS, EMPTY_DAY]
    for name in ("silver_payments", HISTORY_TABLE, "gold_written_premium_daily"):
        assert table_digest(lake, name) == table_digest(done, name), name


def test_export_switch():
    assert all(is_true(v) for v in (True, "true", " TRUE ", "1", "yes", "Y"))
    assert not any(is_true(v) for v in (False, "", "false", "0", "no", "on"))
