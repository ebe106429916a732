"""Shared shingles are answered by block and part, not by set and part, so their rows do not grow with sets times parts."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from daybook.llm import jaccard_join as jaccard


def test_rows_are_blocks_times_parts(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "HELD", 2000)
    monkeypatch.setattr(jaccard, "PART_SHINGLES", 300)
    made = []
    frame = type(spark.range(1).groupBy("id"))
    apply = frame.applyInArrow

    def noted(self, f, schema):
        out = apply(self, f, schema)
        made.append(out)
        return out

    monkeypatch.setattr(frame, "applyInArrow", noted)
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 60, 100)) for _ in range(90)]
    sets = [{tuple(t.split()[i : i + 2]) for i in range(99)} for t in texts]
    holders = Counter(x for s in sets for x in s)
    total = sum(map(len, sets))
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "id long, text string, key int").coalesce(1)
    # Documents that come twice hold their shingles twice, also in other blocks.
    twice = docs.unionByName(docs.filter("id = 7")).coalesce(1)
    held = {r["id"]: r["held"] for r in jaccard.shared(docs, 2, total).collect()}
    want = {i: sum(holders[x] > 1 for x in s) for i, s in enumerate(sets)}
    # Parts compare 32 bits: no two of these few shingles agree in them.
    assert held == {i: n for i, n in want.items() if n}
    parts, blocks = -(-total // 300), -(-total // 2000)
    assert parts >= 20 and made[0].count() <= parts * blocks < 90 * parts / 5
    again = {r["id"]: r["held"] for r in jaccard.shared(twice, 2, total).collect()}
    assert again[7] == 2 * len(sets[7]) and all(again[i] >= n for i, n in held.items())


def test_answers_of_a_block_that_was_made_otherwise_fail(spark, monkeypatch):
    functions = []
    frame = type(spark.range(1).groupBy("id"))
    apply = frame.applyInArrow
    monkeypatch.setattr(frame, "applyInArrow", lambda self, f, schema: functions.append(f) or apply(self, f, schema))
    jaccard.shared(spark.createDataFrame([], "id long, text string, key int"), 3, 0)

    table = pa.table({"block": pa.array([1]), "places": pa.array([jaccard._planes(np.array([0, 2]))]), "ids": pa.array([b""])})
    with pytest.raises(ValueError, match="read alike"):
        functions[-1](table)
