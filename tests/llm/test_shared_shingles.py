"""Sets that share too little with any other take no part in the near-copy join."""

import numpy as np
from pyspark.sql import functions as F

from daybook.llm import jaccard_join as jaccard
from daybook.llm import mixing
from daybook.llm.common import staged


def long_texts(rng, number, words):
    """Texts without a shingle in common, and a near copy of the fourth and a copy of the fifth."""
    base = [" ".join(f"{i}w{x}" for x in rng.integers(0, 1 << 40, words)) for i in range(number)]
    return [*base, base[3] + " end", base[4]]


def test_shingles_held_by_others_are_counted(spark, monkeypatch):
    # Several blocks, and several parts of the hash space.
    monkeypatch.setattr(jaccard, "HELD", 40)
    monkeypatch.setattr(jaccard, "PART_SHINGLES", 30)
    rows = [(1, "a b c d e f g h"), (2, "a b c d e f x y"), (3, "p q r s t u"), (4, "a b c"), (5, ""), (6, None), (None, "a b c d e f g h")]
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], "id long, text string, key int")
    assert {tuple(r) for r in jaccard.shared(docs, 3, 20).collect()} == {(1, 4), (2, 4), (4, 1)}


def test_long_texts_that_share_nothing_never_meet(spark, monkeypatch):
    met = []

    def noted(df, name, keep=False):
        out = staged(df, name, keep)
        if name in ("op8-buckets", "op8-pairs"):
            met.append((name, out.count()))
        return out

    monkeypatch.setattr(jaccard, "staged", noted)
    texts = long_texts(np.random.default_rng(3), 24, 2500)
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = {r["id"]: r["component"] for r in jaccard.classes(docs, 5, 80, 100).collect()}
    assert got == {i: {24: 3, 25: 4}.get(i, i) for i in range(26)}
    # Only the near copy and its source have signatures in common, and they meet once.
    assert sum(n for name, n in met if name == "op8-pairs") == 1


def test_a_mix_leaves_texts_where_they_are(spark):
    rows = [(i, f"{'w ' * (i % 7)}t{i}", "abc"[i % 3]) for i in range(60)] * 2 + [(None, "x y", None), (7, None, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit(1)).withColumn("of", F.lit(2))
    mix = mixing.mixed(docs)
    assert mix.columns == docs.columns
    assert "Exchange hashpartitioning" not in mix._jdf.queryExecution().executedPlan().toString().replace("SortMergeJoin", "Exchange hashpartitioning")
    own = F.xxhash64("doc_id", F.col("doc_id").isNull(), "source", F.col("source").isNull(), "text", F.col("text").isNull())
    plan = mixing.copies(docs.select(own.alias("id"), "source", mixing.n_words(F.col("text")).alias("size")))
    taken = docs.withColumn("id", own).join(plan.select("id", "copies").distinct(), "id").groupBy("id").agg(F.sum("copies").alias("n")).filter("n > 0")
    got = mix.select(own.alias("id")).groupBy("id").count()
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in taken.collect()}
