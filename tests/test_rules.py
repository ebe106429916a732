"""Hand-written edge rows through both rule layers."""

import math

import pytest
from pyspark.sql import functions as F

from daybook.functions.typing import as_text, as_typed
from daybook.operators.rules import BRONZE_RULES, SILVER_RULES
from daybook.schemas import ENTITIES, RUN

DAY = "2026-02-08"


def policies(spark, *rows):
    """Rows of (policy_id, state, effective_date, written_premium)."""
    data = [(i, "AUTO", state, date, premium, "Active", DAY) for i, state, date, premium in rows]
    return spark.createDataFrame(data, ENTITIES["policies"].text).withColumn(RUN, F.lit(DAY))


def payments(spark, *rows):
    data = [(i, policy, amount, date, "ACH", DAY) for i, policy, amount, date in rows]
    return spark.createDataFrame(data, ENTITIES["payments"].text).withColumn(RUN, F.lit(DAY))


def holders(spark, *rows):
    data = [(i, policy, name, "1 Main St", "LA", "CA", "90001", DAY) for i, policy, name in rows]
    return spark.createDataFrame(data, ENTITIES["policyholders"].text).withColumn(RUN, F.lit(DAY))


def ids(df, column):
    return sorted(str(r[column]) for r in df.select(column).collect())


POLICY_ROWS = [
    # id, state, date, premium, bronze, silver
    ("P1", "TX", DAY, "10.50", "valid", "valid"),
    (None, "TX", DAY, "10.50", "reject", None),
    ("P3", "TX", "not-a-date", "10.50", "reject", None),
    ("P4", "TX", None, "10.50", "valid", "reject"),
    ("P5", "TX", DAY, None, "reject", None),
    ("P6", "TX", DAY, "abc", "reject", None),
    ("P7", "TX", DAY, "-1.00", "reject", None),
    ("P8", "TX", DAY, "0.00", "valid", "reject"),
    ("P9", "TEX", DAY, "10.50", "valid", "reject"),
    ("P10", None, DAY, "10.50", "valid", "unknown"),
    ("P11", "TX", DAY, "NaN", "valid", "valid"),
    ("P12", "TX", "2026-2-8", "1e3", "valid", "valid"),
    ("P13", "TX", "2026-13-01", "10.50", "reject", None),
    ("P14", "TX", "2026-02-08 11:22:33", "10.50", "valid", "valid"),
    ("P15", None, None, "10.50", "valid", "reject"),
    ("P16", "TX", DAY, "", "reject", None),
]


def test_policy_layers(spark):
    raw = policies(spark, *(r[:4] for r in POLICY_ROWS))
    valid, rejects = BRONZE_RULES["policies"].split(raw)
    assert ids(valid, "policy_id") == sorted(str(r[0]) for r in POLICY_ROWS if r[4] == "valid")
    assert ids(rejects, "policy_id") == sorted(str(r[0]) for r in POLICY_ROWS if r[4] == "reject")
    assert {r[0] for r in rejects.select("reject_reason").collect()} == {"POLICY_BASIC_VALIDATION_FAILED"}

    bronze = as_typed(valid, ENTITIES["policies"].conversions)
    silver, refused = SILVER_RULES["policies"].split(bronze)
    assert ids(silver, "policy_id") == sorted(r[0] for r in POLICY_ROWS if r[5] == "valid")
    reasons = {r["policy_id"]: r["reject_reason"] for r in refused.collect()}
    failed = {r[0]: "POLICY_SILVER_RULES_FAILED" for r in POLICY_ROWS if r[5] == "reject"}
    unknown = {r[0]: "POLICY_SILVER_RULES_UNKNOWN" for r in POLICY_ROWS if r[5] == "unknown"}
    assert reasons == failed | unknown

    without = SILVER_RULES["policies"].rejects(bronze, undecided=False)
    assert ids(without, "policy_id") == sorted(failed)
    assert bronze.count() == silver.count() + refused.count()


def test_typed_values(spark):
    raw = policies(spark, ("P12", "TX", "2026-2-8", "1e3"), ("P11", "TX", DAY, "NaN"), ("P6", "TX", "x", "abc"))
    rows = {r["policy_id"]: r for r in as_typed(raw, ENTITIES["policies"].conversions).collect()}
    assert str(rows["P12"]["effective_date"]) == DAY and rows["P12"]["written_premium"] == 1000.0
    assert math.isnan(rows["P11"]["written_premium"])
    assert rows["P6"]["effective_date"] is None and rows["P6"]["written_premium"] is None


def test_reject_payload_is_text(spark):
    bronze = as_typed(policies(spark, ("P8", "TX", DAY, "0.00")), ENTITIES["policies"].conversions)
    rejects = as_text(SILVER_RULES["policies"].rejects(bronze), ENTITIES["policies"].conversions)
    row = rejects.first()
    assert (row["effective_date"], row["written_premium"]) == (DAY, "0.0")
    assert row["rejected_at"] is not None


def test_payment_layers(spark):
    raw = payments(
        spark,
        ("A", "P1", "5.00", DAY),
        (None, "P1", "5.00", DAY),
        ("B", "P1", "abc", DAY),
        ("C", "P1", "0", DAY),
        ("D", "P1", "-5", DAY),
        ("E", "P1", None, DAY),
        ("F", "P1", "5.00", "not-a-date"),
        ("G", None, "5.00", DAY),
        ("H", "P1", "5.00", None),
        ("I", "P1", "NaN", DAY),
    )
    valid, rejects = BRONZE_RULES["payments"].split(raw)
    assert ids(valid, "payment_id") == ["A", "G", "H", "I"]
    assert ids(rejects, "payment_id") == ["B", "C", "D", "E", "F", "None"]
    silver, refused = SILVER_RULES["payments"].split(as_typed(valid, ENTITIES["payments"].conversions))
    assert ids(silver, "payment_id") == ["A", "I"]
    assert ids(refused, "payment_id") == ["G", "H"]


def test_holder_layers(spark):
    raw = holders(spark, ("H1", "P1", "Ann"), (None, "P1", "Bob"), ("H3", None, "Cid"), ("H4", "P4", None))
    valid, rejects = BRONZE_RULES["policyholders"].split(raw)
    assert ids(valid, "holder_id") == ["H1", "H4"]
    assert ids(rejects, "holder_id") == ["H3", "None"]
    silver, refused = SILVER_RULES["policyholders"].split(valid)
    assert ids(silver, "holder_id") == ["H1"]
    assert ids(refused, "holder_id") == ["H4"]
    assert refused.first()["reject_reason"] == "POLICYHOLDER_SILVER_RULES_FAILED"


@pytest.mark.parametrize("entity", list(ENTITIES))
def test_broken_and_holds_are_complements(spark, entity):
    """Rules without an undecided case must give exactly one of the two answers on every row."""
    for rules, view in ((BRONZE_RULES[entity], "text"), (SILVER_RULES[entity], "typed")):
        for rule in rules.rules:
            if rule.undecided() is not None:
                continue
            schema = getattr(ENTITIES[entity], view)
            text = ENTITIES[entity].text
            values = [None, "", "abc", "0", "-1", "1", "NaN", "2026-02-08", "2026-13-01"]
            df = spark.createDataFrame([tuple(v for _ in text) for v in values], text)
            df = as_typed(df, {f.name: f.dataType.simpleString() for f in schema})
            both = df.select(F.coalesce(rule.holds(), F.lit(False)).alias("h"), rule.broken().alias("b"))
            assert both.where(F.col("b").isNull() | (F.col("h") == F.col("b"))).count() == 0, rule
