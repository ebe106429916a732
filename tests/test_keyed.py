"""Dedupe, upsert and checks against brute force on small random data."""

import random

import pytest
from pyspark.sql import functions as F

from daybook.operators.checks import duplicate_keys, missing_columns, require_columns
from daybook.operators.dedupe import one_per_key
from daybook.operators.star import daily_totals, valid_at, versions_between
from daybook.operators.upsert import upsert, upsert_columns

SCHEMA = "k string, j int, v string, run string"


def frame(spark, rows, partitions=4):
    return spark.createDataFrame(rows, SCHEMA).repartition(partitions)


def random_rows(rng, n, keys, run):
    return [(f"k{rng.randrange(keys)}", rng.randrange(2), rng.choice(["a", "b", None]), run) for _ in range(n)]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_one_per_key_matches_brute_force_with_a_hot_key(spark):
    rng = random.Random(7)
    rows = random_rows(rng, 300, 40, "1") + [("hot", 0, rng.choice("abcdef"), "1") for _ in range(500)]
    best = {}
    for row in rows:
        # Largest v first (NULL last), then nothing else differs.
        rank = (row[2] is not None, row[2] or "")
        if row[:2] not in best or rank > best[row[:2]][0]:
            best[row[:2]] = (rank, row)
    expected = sorted((row for _, row in best.values()), key=repr)
    for partitions in (1, 5):
        assert rows_of(one_per_key(frame(spark, rows, partitions), ("k", "j"), ("v",))) == expected


def test_one_per_key_keeps_one_row_per_key_before_the_shuffle(spark):
    df = one_per_key(frame(spark, [("a", 1, "x", "1")]), ("k",), ("v",))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan


def as_state(rows):
    return {row[:2]: row for row in rows}


def test_upsert_is_last_writer_wins_and_idempotent(spark):
    rng = random.Random(11)
    for _ in range(3):
        target = list(as_state(random_rows(rng, 30, 20, "1")).values())
        source = list(as_state(random_rows(rng, 20, 30, "2")).values())
        expected = sorted((as_state(target) | as_state(source)).values(), key=repr)
        t, s = frame(spark, target), frame(spark, source)
        once = upsert(t, s, ("k", "j"))
        assert rows_of(once) == expected
        assert rows_of(upsert(once, s, ("k", "j"))) == expected


def test_upsert_first_load_and_empty_source(spark):
    rows = [("a", 1, "x", "1"), ("b", 1, None, "1")]
    empty = frame(spark, [])
    assert rows_of(upsert(empty, frame(spark, rows), ("k",))) == rows
    assert rows_of(upsert(frame(spark, rows), empty, ("k",))) == rows


def test_upsert_newer_by(spark):
    target = [("a", 1, "new", "3"), ("b", 1, "old", "1"), ("c", 1, "same", "2"), ("d", 1, "only", None)]
    source = [("a", 1, "late", "2"), ("b", 1, "x", "2"), ("c", 1, "y", "2"), ("d", 1, "z", "2"), ("e", 1, "w", "2")]
    result = {r["k"]: r["v"] for r in upsert(frame(spark, target), frame(spark, source), ("k", "j"), "run").collect()}
    assert result == {"a": "new", "b": "x", "c": "y", "d": "z", "e": "w"}


def test_duplicate_keys(spark):
    rows = [("a", 1, "x", "1"), ("a", 1, "y", "1"), ("a", 2, "x", "1"), ("b", 1, "x", "1")]
    assert rows_of(duplicate_keys(frame(spark, rows), ("k", "j"))) == [("a", 1, 2)]


def test_required_columns(spark):
    df = frame(spark, [])
    assert missing_columns(df, ["k", "z", "y"]) == ["z", "y"]
    assert require_columns(df, ["k"]) is df
    try:
        require_columns(df, ["z"])
    except ValueError as error:
        assert "z" in str(error)
    else:
        raise AssertionError("missing column went unnoticed")


def test_daily_totals_with_a_hot_key(spark):
    rng = random.Random(3)
    facts = [(rng.choice(["hot", "hot", "x", "none"]), rng.randrange(3), rng.randrange(1000) / 100) for _ in range(600)]
    dimension = [("hot", "H"), ("x", "X"), ("unused", "U")]
    expected = {}
    names = dict(dimension)
    for key, day, amount in facts:
        if key in names:
            total, n = expected.get((day, names[key]), (0, 0))
            expected[day, names[key]] = (total + round(amount * 100), n + 1)
    f = spark.createDataFrame(facts, "k string, d int, a double").repartition(5)
    result = daily_totals(f, spark.createDataFrame(dimension, "k string, c string"), "k", "d", "a", "c")
    found = {(r["day"], r["c"]): (round(r["total"] * 100), r["n_facts"]) for r in result.collect()}
    assert found == expected


# Column lists


def merged(spark, target, source, **lists):
    schema = "k string, v int, loaded string"
    t, s = spark.createDataFrame(target, schema), spark.createDataFrame(source, schema)
    return rows_of(upsert_columns(t, s, ["k"], **lists))


def test_upsert_with_column_lists(spark):
    target = [("a", 1, "first"), ("b", 2, "first"), (None, 3, "first")]
    source = [("b", 20, "second"), ("c", 30, "second"), (None, 9, "second")]
    null = [(None, 3, "first"), (None, 9, "second")]
    assert merged(spark, target, source) == sorted([("a", 1, "first"), ("b", 20, "second"), ("c", 30, "second"), *null], key=repr)
    # The first load time survives an update.
    kept = merged(spark, target, source, update=["v"])
    assert kept == sorted([("a", 1, "first"), ("b", 20, "first"), ("c", 30, "second"), *null], key=repr)
    # New rows get only the columns listed.
    assert ("c", None, "second") in merged(spark, target, source, update=["v"], insert=["loaded"])
    # Nothing is updated, new rows come in.
    assert ("b", 2, "first") in merged(spark, target, source, update=[])
    summed = merged(spark, target, source, update={"v": F.col("t.v") + F.col("s.v")}, insert={"v": F.col("s.v"), "loaded": F.lit("new")})
    assert ("b", 22, "first") in summed and ("c", 30, "new") in summed
    with pytest.raises(ValueError, match="no such column"):
        merged(spark, target, source, update=["w"])


def test_upsert_with_column_lists_against_brute_force(spark):
    rng = random.Random(9)
    for _ in range(3):
        target = {f"k{i}": (rng.randrange(9), "t") for i in rng.sample(range(40), 20)}
        source = {f"k{i}": (rng.randrange(9), "s") for i in rng.sample(range(40), 20)}
        expected = dict(target)
        for k, (v, _) in source.items():
            expected[k] = (v, target[k][1]) if k in target else (v, None)
        got = merged(spark, [(k, *x) for k, x in target.items()], [(k, *x) for k, x in source.items()], update=["v"], insert=["v"])
        assert got == sorted(((k, *x) for k, x in expected.items()), key=repr)


def test_small_source_with_column_lists_leaves_the_target_unshuffled(spark, tmp_path):
    spark.range(1000).selectExpr("cast(id as string) k", "1 v", "'x' loaded").write.parquet(str(tmp_path / "t"))
    spark.range(3).selectExpr("cast(id as string) k", "2 v", "'y' loaded").write.parquet(str(tmp_path / "s"))
    result = upsert_columns(spark.read.parquet(str(tmp_path / "t")), spark.read.parquet(str(tmp_path / "s")), ["k"], update=["v"])
    text = result._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in text and "SortMergeJoin" not in text


# The version valid on a day


def brute_valid(facts, versions):
    return sorted(
        ((k, d, n, c) for k, d, n in facts for vk, start, end, c in versions if k == vk and k is not None and start <= d and (end is None or d < end)), key=repr
    )


def test_valid_at_against_brute_force(spark):
    import datetime

    rng = random.Random(4)
    base = datetime.date(2020, 1, 1)

    def day(n):
        return base + datetime.timedelta(days=n)

    versions = []
    for k in range(12):
        starts = sorted(rng.sample(range(0, 400), rng.randint(0, 6)))
        for i, s in enumerate(starts):
            gap = rng.random() < 0.2
            end = starts[i + 1] - (1 if gap and starts[i + 1] - s > 1 else 0) if i + 1 < len(starts) else rng.choice([None, s + 30, 2_900_000])
            versions.append((f"k{k}", day(s), day(end) if end is not None and end < 2_900_000 else (None if end is None else datetime.date(9999, 12, 31)), f"c{i}"))
    versions += [("k1", day(5), day(5), "never"), (None, day(0), None, "no key")]
    facts = [(rng.choice(["k0", "k0", "k0", f"k{rng.randrange(14)}", None]), day(rng.randrange(-50, 450)), n) for n in range(600)]
    facts += [(k, s, 1000 + i) for i, (k, s, _, _) in enumerate(versions)] + [(k, e, 2000 + i) for i, (k, _, e, _) in enumerate(versions) if e]
    f = spark.createDataFrame(facts, "k string, d date, n int").repartition(4)
    v = versions_between(spark.createDataFrame(versions, "k string, s date, e date, c string"), "s", "e")
    for bin_days in (1, 7, 32, 5000):
        assert rows_of(valid_at(f, v.select("k", "c", "valid_from", "valid_until"), ["k"], "d", bin_days=bin_days)) == brute_valid(facts, versions)


def test_valid_at_does_not_spread_open_versions_or_cross_ranges(spark):
    f = spark.createDataFrame([("k", "2020-01-01", 1)], "k string, d string, n int")
    v = versions_between(spark.createDataFrame([("k", "1800-01-01", "9999-12-31", "c")], "k string, s string, e string, c string"), "s", "e")
    joined = valid_at(f, v, ["k"], "d")
    text = joined._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in text and "CartesianProduct" not in text and "NestedLoop" not in text
    assert [tuple(r) for r in joined.select("k", "n", "c").collect()] == [("k", 1, "c")]


def test_daily_totals_count_a_fact_once_under_the_row_valid_on_its_day(spark):
    dimension = spark.sql(
        "select * from values ('p', date'2020-01-10', 'A'), ('p', date'2020-03-01', 'B'), ('q', date'2020-01-01', 'A') t(k, since, c)"
    )
    facts = spark.sql(
        "select * from values ('p', date'2020-01-01', 1.0D), ('p', date'2020-02-29', 2.0D), ('p', date'2020-03-01', 4.0D), ('q', date'2020-03-01', 8.0D), ('r', date'2020-03-01', 16.0D) t(k, d, a)"
    )
    found = {(str(r["day"]), r["c"]): (r["total"], r["n_facts"]) for r in daily_totals(facts, dimension, "k", "d", "a", "c", "since").collect()}
    assert found == {("2020-01-01", "A"): (1.0, 1), ("2020-02-29", "A"): (2.0, 1), ("2020-03-01", "B"): (4.0, 1), ("2020-03-01", "A"): (8.0, 1)}
    strict = daily_totals(facts, dimension, "k", "d", "a", "c", "since", early=False)
    assert {str(r["day"]) for r in strict.collect()} == {"2020-02-29", "2020-03-01"}
