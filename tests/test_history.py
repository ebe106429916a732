"""Change history: hand-written sequence, and random days against a plain simulation."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from daybook.operators.history import (
    as_versions,
    changed_versions,
    current_versions,
    expired_versions,
    history_of_days,
    scd2_apply,
)

KEY = ("h", "p")
COLUMNS = "h string, p string, a string, b string"
OPEN = "9999-12-31"


def versions(spark, rows, day):
    return as_versions(spark.createDataFrame(rows, COLUMNS), ("a", "b"), day)


def state(history):
    shown = ("h", "p", "a", "b", "effective_start_date", "effective_end_date", "is_current")
    return sorted((tuple(r[c] for c in shown) for r in history.collect()), key=repr)


def simulate(days):
    history = []
    for day, rows in days:
        for h, p, a, b in rows:
            fingerprint = f"{a or ''}||{b or ''}"
            current = next((v for v in history if v[:2] == [h, p] and v[6]), None)
            if current and f"{current[2] or ''}||{current[3] or ''}" == fingerprint:
                continue
            if current:
                current[5:7] = [day, False]
            history.append([h, p, a, b, day, OPEN, True])
    return sorted(map(tuple, history), key=repr)


def apply_all(spark, days, tmp=None):
    history = versions(spark, [], "2026-01-01")
    for day, rows in days:
        history = scd2_apply(history, versions(spark, rows, day), KEY)
    return history


def test_sequence_of_one_key(spark):
    def row(a):
        return [("H1", "P1", a, None)]

    days = [
        ("2026-02-01", row("A")),
        ("2026-02-02", row("A")),
        ("2026-02-03", row("B")),
        ("2026-02-04", []),
        ("2026-02-05", row("A")),
        ("2026-02-05", row("A")),
    ]
    assert state(apply_all(spark, days)) == [
        ("H1", "P1", "A", None, "2026-02-01", "2026-02-03", False),
        ("H1", "P1", "A", None, "2026-02-05", OPEN, True),
        ("H1", "P1", "B", None, "2026-02-03", "2026-02-05", False),
    ]


def test_random_days_match_the_simulation(spark):
    rng = random.Random(5)
    days = []
    for d in range(1, 5):
        keys = {(f"H{rng.randrange(6)}", f"P{rng.randrange(3)}") for _ in range(12)}
        days.append((f"2026-02-0{d}", [(h, p, rng.choice(["x", "y", None]), rng.choice(["1", ""])) for h, p in keys]))
    history = apply_all(spark, days)
    found = state(history)
    assert found == simulate(days)
    # One open version per key, and each end is the next start.
    by_key = {}
    for v in sorted(found, key=lambda v: v[4]):
        by_key.setdefault(v[:2], []).append(v)
    for chain in by_key.values():
        assert [v[6] for v in chain] == [False] * (len(chain) - 1) + [True]
        assert [v[5] for v in chain[:-1]] == [v[4] for v in chain[1:]]


def test_change_and_expire_agree_with_apply(spark):
    first = versions(spark, [("H1", "P1", "A", "x"), ("H2", "P2", "A", "x"), ("H3", "P3", "A", "x")], "2026-02-01")
    second = versions(spark, [("H1", "P1", "B", "x"), ("H2", "P2", "A", "x"), ("H4", "P4", "N", "x")], "2026-02-02")
    changes = changed_versions(second, first, KEY)
    assert {(r["h"], r["replaced_start"]) for r in changes.collect()} == {("H1", "2026-02-01"), ("H4", None)}
    expired = expired_versions(first, changes, KEY)
    assert state(expired) == [("H1", "P1", "A", "x", "2026-02-01", "2026-02-02", False)]
    whole = scd2_apply(first, second, KEY)
    assert state(whole.where(~F.col("is_current"))) == state(expired)
    assert current_versions(whole).count() == 4


def test_second_change_on_one_day_leaves_a_zero_length_version(spark):
    days = [("2026-02-01", [("H1", "P1", "A", "x")]), ("2026-02-01", [("H1", "P1", "B", "x")])]
    assert state(apply_all(spark, days)) == [
        ("H1", "P1", "A", "x", "2026-02-01", "2026-02-01", False),
        ("H1", "P1", "B", "x", "2026-02-01", OPEN, True),
    ]


def test_backdated_change_raises_unless_allowed(spark):
    history = versions(spark, [("H1", "P1", "A", "x")], "2026-02-05")
    late = versions(spark, [("H1", "P1", "B", "x")], "2026-02-01")
    with pytest.raises(Exception, match="back-dated"):
        scd2_apply(history, late, KEY).collect()
    allowed = scd2_apply(history, late, KEY, allow_backdated=True)
    assert ("H1", "P1", "A", "x", "2026-02-05", "2026-02-01", False) in state(allowed)
    same = versions(spark, [("H1", "P1", "A", "x")], "2026-02-01")
    assert scd2_apply(history, same, KEY).count() == 1


def test_hash_formula(spark):
    row = versions(spark, [("H1", "P1", "A", None)], "2026-02-01").first()
    assert row["attr_hash"] == hashlib.sha256(b"A||").hexdigest()


def test_all_days_in_one_plan_match_the_daily_steps(spark):
    """Random days with absences and changes back and forth; a hot key changes on every day."""
    rng = random.Random(8)
    days, rows = [], []
    for d in range(1, 10):
        day = f"2026-02-0{d}"
        keys = {(f"H{rng.randrange(8)}", f"P{rng.randrange(3)}") for _ in range(14)}
        today = [(h, p, rng.choice(["x", "y", None]), rng.choice(["1", ""])) for h, p in keys] + [("hot", "P", str(d), None)]
        days.append((day, today))
        rows += [(*r, day) for r in today]
    snapshots = spark.createDataFrame(rows, f"{COLUMNS}, _runDate string").repartition(4)
    whole = history_of_days(snapshots, ("a", "b"), KEY)
    assert state(whole) == simulate(days) == state(apply_all(spark, days))
    # Some days stored, the others added in one plan.
    stored = apply_all(spark, days[:4]).withColumn("_runDate", F.lit("x"))
    added = history_of_days(snapshots.where("_runDate > '2026-02-04'"), ("a", "b"), KEY, stored)
    assert state(added) == simulate(days)
    # Applying the last day again changes nothing, an earlier one is refused.
    again = history_of_days(snapshots.where("_runDate = '2026-02-09'"), ("a", "b"), KEY, added)
    assert state(again) == simulate(days)
    late = snapshots.where("_runDate = '2026-02-01'")
    with pytest.raises(Exception, match="back-dated"):
        history_of_days(late, ("a", "b"), KEY, added).collect()
    assert state(history_of_days(late, ("a", "b"), KEY, added, allow_backdated=True)) == state(
        scd2_apply(added, as_versions(late, ("a", "b"), F.col("_runDate")).select(*added.columns), KEY, allow_backdated=True)
    )


def test_all_days_share_one_shuffle(spark, tmp_path):
    spark.createDataFrame([("H", "P", "a", "b", "2026-02-01")], f"{COLUMNS}, _runDate string").write.parquet(str(tmp_path / "s"))
    snapshots = spark.read.parquet(str(tmp_path / "s"))
    text = history_of_days(snapshots, ("a", "b"), KEY)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1
