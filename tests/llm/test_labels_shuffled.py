"""Statistics and labels meet by shuffle: neither side passes the driver, however small its files look."""

from daybook.llm import quality_rules


def test_neither_statistics_nor_labels_are_broadcast(spark, docs, monkeypatch):
    from pyspark.sql import functions as F

    text = " ".join(f"word{i}" for i in range(60))
    table = docs((1, text), (2, text + " more"), (3, "short"), (None, text), (2, text)).select("doc_id", "text")
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, 1), (3, 0), (None, 0), (4, None)], "doc_id long, quality int")
    seen = []

    def learn(labelled):
        seen.append(labelled._jdf.queryExecution().executedPlan().toString())
        seen.extend(sorted((r["doc_id"], r["poor"]) for r in labelled.collect()))
        seen.append(labelled._jdf.queryExecution().executedPlan().toString())
        return []

    monkeypatch.setattr(quality_rules, "learn", learn)
    stats = table.select("doc_id", quality_rules.statistics(F.col("text")).alias("s"))
    kept = quality_rules.judged_statistics(stats, labels, "s").select("doc_id", "s.kept").collect()
    assert seen[1:-1] == [(1, 1), (2, 0), (2, 0)]
    assert all("SortMergeJoin" in plan and "Broadcast" not in plan for plan in (seen[0], seen[-1]))
    assert sorted(r["kept"] for r in kept if r["doc_id"] != 3) == [True] * 4 and [r["kept"] for r in kept if r["doc_id"] == 3] == [False]
