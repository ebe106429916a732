"""Keyed tables in hash buckets: results as of a plain upsert, and a plan that leaves the table where it lies."""

import random

import pytest
from pyspark.sql import functions as F

from daybook.schemas import TABLES, Table, struct
from daybook.sources.keyed import SLOT, KeyedStore

PAIRS = Table("pairs", "silver", "pairs", struct("k string, v int, run string"), key=("k",))


def frame(spark, rows, run):
    return spark.createDataFrame([(k, v, run) for k, v in rows.items()], "k string, v int, run string")


@pytest.fixture
def store(lake):
    return KeyedStore(lake, PAIRS, slots=8, buckets=4).create()


def test_merges_equal_a_dictionary(spark, store):
    rng, expected = random.Random(3), {}
    for run in range(4):
        batch = {f"k{rng.randrange(60)}": rng.randrange(99) for _ in range(25 if run < 3 else 2)}
        touched = store.merge(frame(spark, batch, str(run)))
        assert touched == frame(spark, batch, "x").select(store.slot()).distinct().count()
        expected |= {k: (v, str(run)) for k, v in batch.items()}
        assert {r["k"]: (r["v"], r["run"]) for r in store.read().collect()} == expected
        assert store.read().count() == len(expected)
    assert store.merge(frame(spark, {}, "9")) == 0


def test_a_merge_does_not_shuffle_the_table_and_reads_touched_slots_only(spark, store):
    store.merge(frame(spark, {f"k{i}": i for i in range(200)}, "1"))
    rows = frame(spark, {"k1": 9}, "2").withColumn(SLOT, store.slot())
    with store.lake.staged(rows, "batch") as batch:
        merged = store.merged(batch, [r[SLOT] for r in batch.collect()])
        text = merged._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in text
    # The one exchange moves the batch: it stands above the scan of the staged rows.
    assert "_by_key" not in text[text.index("Exchange hashpartitioning") :].split("\n\n")[0] or text.index("_by_key") < text.index("Exchange hashpartitioning")
    assert "SelectedBucketsCount" in text and f"{SLOT}#" in text


def test_a_writer_that_dies_before_the_switch_leaves_the_old_rows(spark, store, monkeypatch):
    store.merge(frame(spark, {"a": 1, "b": 1}, "1"))
    sql = spark.sql

    def dies(text, *args, **kwargs):
        if "SET LOCATION" in text or "ADD IF NOT EXISTS" in text:
            raise RuntimeError("lost driver")
        return sql(text, *args, **kwargs)

    with monkeypatch.context() as patch:
        patch.setattr(store.spark, "sql", dies, raising=False)
        with pytest.raises(RuntimeError):
            store.merge(frame(spark, {"a": 2, "c": 2}, "2"))
    assert {r["k"]: r["v"] for r in store.read().collect()} == {"a": 1, "b": 1}
    store.merge(frame(spark, {"a": 2, "c": 2}, "2"))
    assert {r["k"]: r["v"] for r in store.read().collect()} == {"a": 2, "b": 1, "c": 2}


def test_library_tables_fit(lake):
    table = TABLES["silver_policies"]
    store = KeyedStore(lake, table, slots=4, buckets=2).create()
    assert store.read().columns == table.columns and store.read().count() == 0
    described = {r["col_name"]: r["data_type"] for r in store.spark.sql(f"DESCRIBE FORMATTED {store.name}").collect()}
    assert described["Num Buckets"] == "2" and F.col(SLOT) is not None
