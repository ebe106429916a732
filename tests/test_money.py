import math
import random

from daybook.functions.money import exact_sum
from daybook.operators.aggregates import active_policies_daily, payments_daily, written_premium_daily


def total(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x double").agg(exact_sum("x").alias("s")).first()["s"]


def test_exact_and_independent_of_order(spark):
    assert total(spark, [0.1] * 10) == 1.0
    rng = random.Random(1)
    values = [round(rng.uniform(-5000, 5000), 2) for _ in range(500)]
    cents = sum(round(v * 100) for v in values)
    for _ in range(2):
        rng.shuffle(values)
        assert total(spark, values) == cents / 100
    assert total(spark, [10.005, 10.005]) == 20.01
    # All digits count, below six fraction digits too.
    assert total(spark, [1e-7] * 10) == 1e-6
    assert total(spark, [0.1234567891234] * 2 + [1e15]) == 1e15 + 0.2469135782468
    assert total(spark, [1e-30, 1.0, 2.0]) == 3.0
    assert total(spark, [9e17] * 400) == 3.6e20


def test_values_a_decimal_cannot_hold(spark):
    assert math.isnan(total(spark, [1.0, float("nan")]))
    assert total(spark, [1.0, float("inf")]) == float("inf")
    assert total(spark, [1e300, 1.0]) == 1e300
    assert total(spark, [1e30]) == 1e30


def test_nulls(spark):
    assert total(spark, [None, None]) is None
    assert total(spark, [None, 2.5]) == 2.5
    assert total(spark, []) is None


def test_aggregates(spark):
    policies = spark.createDataFrame(
        [
            ("P1", "AUTO", "TX", "2026-02-01", 10.1, "Active", "r"),
            ("P1", "AUTO", "TX", "2026-02-01", 10.2, "Cancelled", "r"),
            ("P2", "AUTO", "TX", "2026-02-01", 1.0, "active", "r"),
            ("P3", "HOME", None, "2026-02-02", 5.0, None, "r"),
        ],
        "policy_id string, product string, state string, effective_date string, written_premium double, status string, "
        "_runDate string",
    )
    premium = {(r["day"], r["state"], r["product"]): (r["written_premium"], r["policy_count"]) for r in written_premium_daily(policies).collect()}
    assert premium == {("2026-02-01", "TX", "AUTO"): (21.3, 2), ("2026-02-02", None, "HOME"): (5.0, 1)}
    active = {r["day"]: (r["active_policies"], r["cancelled_policies"]) for r in active_policies_daily(policies).collect()}
    assert active == {"2026-02-01": (1, 1), "2026-02-02": (0, 0)}
    payments = spark.createDataFrame([("d", 1.5, "r"), ("d", 2.5, "s")], "payment_date string, amount double, _runDate string")
    assert payments_daily(payments).count() == 2
    assert tuple(payments_daily(payments, by=()).first()) == ("d", 4.0, 2)
