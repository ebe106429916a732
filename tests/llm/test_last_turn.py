"""Pairs of the near-copy join's last turn, and what a worker holds after a task."""

import numpy as np
from pyspark.sql import functions as F

from daybook.llm import jaccard_join as jaccard
from daybook.llm.common import freed, staged


def test_pairs_of_the_last_turn_meet_whole_sketches_before_they_are_written(spark, monkeypatch):
    rng = np.random.default_rng(7)
    plans = []

    def noted(df, name, keep=False):
        if name == "op8-pairs":
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return staged(df, name, keep)

    monkeypatch.setattr(jaccard, "staged", noted)
    vocabulary = [f"w{i}" for i in range(5000)]
    base = [" ".join(rng.choice(vocabulary, 400)) for _ in range(8)]
    docs = spark.createDataFrame([(i, t, i) for i, t in enumerate([*base, base[3] + " end"])], "id long, text string, real long")
    docs = docs.select("id", "text", jaccard._place("id"), "real")
    known = staged(jaccard.summaries(docs, 5), "test-sets")
    info = known.select(F.col("id").alias("rep"), "n", "sketch")
    # Every document in one bucket.
    buckets = known.select(F.lit(1).cast("long").alias("signature"), F.lit(1).cast("long").alias("times"), F.col("id").alias("rep"))
    found = {r["rep"]: r["component"] for r in jaccard._linked(buckets, info, docs, 5, 80, 100).collect()}
    assert found == {3: 3, 8: 3}
    assert len(plans) == jaccard.LEADER_TURNS + 1
    # All pairs come together once distinct, and those have no other join to pass: whole sketches are part of the first.
    last = plans[-1]
    assert last.index("Aggregate") < last.index("Join") and "[15]" in last[last.index("Join") :].split("\n")[0]


def test_a_worker_gives_back_what_it_freed(spark):
    assert spark.range(10).mapInArrow(freed(lambda batches: batches), "id long").count() == 10
