"""What a task holds and what passes the driver do not grow with the tables."""

from contextlib import contextmanager

from pyspark.sql import functions as F

from daybook.catalogue import queries, views
from daybook.operators import upsert
from daybook.plans import history
from daybook.plans.merge import merge_run
from daybook.plans.partials import WORD, number_policies, refresh_states, states_path
from daybook.schemas import ENTITIES, HISTORY_TABLE, TABLES

DAY, NEXT = "2026-02-01", "2026-02-02"


def star(spark, folder, customers=200, orders=50):
    spark.range(customers).selectExpr("id AS c_custkey", "concat('n', id) AS c_name", "1 AS c_nationkey").coalesce(1).write.parquet(f"{folder}/customer.parquet")
    spark.sql("SELECT 1 AS n_nationkey, 'FRANCE' AS n_name").write.parquet(f"{folder}/nation.parquet")
    lines = spark.range(1, orders).selectExpr(
        "id AS l_orderkey", "1 AS l_linenumber", "10.0D AS l_extendedprice", "timestamp'1996-01-01' AS l_shipdate", "'A' AS l_returnflag"
    )
    lines.coalesce(1).write.parquet(f"{folder}/lineitem.parquet")
    return str(folder)


def policies(spark, n, run):
    rows = spark.range(n).selectExpr(
        "concat('P', xxhash64(id)) AS policy_id", "concat('p', id % 5) AS product", "'TX' AS state", "DATE'2026-01-01' AS effective_date",
        "1.5D AS written_premium", "'Active' AS status", f"'{run}' AS runDate", "'f' AS _sourceFile", f"'{run}' AS _runDate",
    )
    return rows.withColumn("_loaded_at", F.current_timestamp()).select(*TABLES["silver_policies"].columns)


def test_rows_of_two_weeks_are_made_in_many_tasks(spark, tmp_path, monkeypatch):
    folder = star(spark, tmp_path)
    whole = views.raw(spark, folder, "policyholders_week")
    monkeypatch.setattr(views, "TASK_ROWS", 280)
    rows = views.raw(spark, folder, "policyholders_week")
    sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 3 and max(sizes) < rows.count() / 3
    assert sorted(rows.collect(), key=repr) == sorted(whole.collect(), key=repr)


def test_payments_by_state_reads_the_payments_once_in_small_splits(spark, tmp_path, monkeypatch):
    folder, splits, write = star(spark, tmp_path), [], queries.write_scratch

    def noted(rows, label):
        splits.append((label, spark.conf.get("spark.sql.files.maxPartitionBytes")))
        return write(rows, label)

    monkeypatch.setattr(queries, "write_scratch", noted)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    found = queries.payments_by_holder_state(spark, folder)
    assert not [f for f in found.inputFiles() if "lineitem" in f]
    assert sorted(splits) == [("clean-payments", "16m"), ("clean-policyholders", "16m")]
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before


def test_a_state_is_as_many_words_as_its_policies_need(spark, lake):
    merge_run(lake, "silver_policies", policies(spark, 1_000, DAY), DAY)
    refresh_states(lake)
    states = spark.read.parquet(states_path(lake))
    assert dict(states.dtypes)["policies"] == "bigint"
    # Five groups of 200 policies: each fills its words, but for the first and the last.
    assert states.count() <= 5 * (200 // WORD + 2)
    assert number_policies(lake, lake.read("silver_policies")).agg(F.max("number"), F.count_distinct("number")).first() == (1_000, 1_000)


@contextmanager
def broadcasts(spark, monkeypatch):
    """The broadcast joins of every write to the lake inside."""
    found, write = [], type(spark.range(1).write).parquet

    def noted(writer, *args, **options):
        found.append("BroadcastHashJoin" in writer._df._jdf.queryExecution().executedPlan().toString())
        return write(writer, *args, **options)

    with monkeypatch.context() as patch:
        patch.setattr(type(spark.range(1).write), "parquet", noted)
        yield found


def test_many_keys_of_a_merge_do_not_pass_the_driver(spark, lake, monkeypatch):
    merge_run(lake, "silver_policies", policies(spark, 300, DAY), DAY)
    monkeypatch.setattr(upsert, "BROADCAST_ROWS", 50)
    with broadcasts(spark, monkeypatch) as found:
        merge_run(lake, "silver_policies", policies(spark, 200, NEXT), NEXT)
    assert found and not any(found)
    assert {r["_runDate"]: r["count"] for r in lake.read("silver_policies").groupBy("_runDate").count().collect()} == {DAY: 100, NEXT: 200}


def test_many_open_versions_do_not_pass_the_driver(spark, lake, monkeypatch):
    def snapshot(run, state):
        columns = {c: F.concat(F.lit(c), "id") for c in ENTITIES["policyholders"].columns}
        rows = spark.range(200).select(*[v.alias(c) for c, v in columns.items()]).withColumns({"state": F.lit(state), "_runDate": F.lit(run), "_sourceFile": F.lit("f")})
        return rows.withColumn("runDate", F.lit(run)).withColumn("_loaded_at", F.current_timestamp())

    history.load_history(lake, DAY, snapshot(DAY, "TX"))
    monkeypatch.setattr(upsert, "BROADCAST_ROWS", 50)
    with broadcasts(spark, monkeypatch) as found:
        history.load_history(lake, NEXT, snapshot(NEXT, "CA"))
    assert found and not any(found)
    rows = lake.read(HISTORY_TABLE)
    assert (rows.count(), rows.where("is_current AND state = 'CA'").count()) == (400, 200)
