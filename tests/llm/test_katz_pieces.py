"""Pieces of the language model meet their answers one at a time."""

from pyspark.sql import functions as F

from daybook.llm import katz
from daybook.llm.common import staged


def test_answers_are_not_gathered_into_one_row_per_piece(spark, monkeypatch):
    plans = {}

    def noted(df, name, keep=False):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return staged(df, name, keep)

    monkeypatch.setattr(katz, "staged", noted)
    docs = spark.createDataFrame([(i, f"a b c w{i % 7} a b") for i in range(50)], "id long, text string")
    scores, total, _, _ = katz.scored(docs, F.col("id") % 7 == 2)
    assert scores.count() == 50 and total == sum(7 for i in range(50) if i % 7 != 2)
    assert all("collect_list" not in plans[k] and "CoGroup" in plans[k] for k in ("op6-bigrams", "op6-scores"))
