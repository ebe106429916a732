"""Pairs that are left in the last turn meet as wide sketches before their sets travel."""

import numpy as np

from daybook.llm import jaccard_join as jaccard


def test_wide_sketches_keep_similar_pairs_and_part_the_others(spark):
    rng = np.random.default_rng(4)
    sets = {}
    # Base sets below and above a power of two, with a near copy of another width, and one with nothing in common.
    for k, n in enumerate((20, 1000, 1030, 8000)):
        base = rng.integers(0, 2**63, n, dtype=np.uint64)
        near = np.concatenate([base, rng.integers(0, 2**63, n // 20, dtype=np.uint64)])
        sets |= {3 * k: base, 3 * k + 1: near, 3 * k + 2: rng.integers(0, 2**63, n, dtype=np.uint64)}
    rows = [(i, np.sort(h).view(np.int64).tolist(), jaccard._wide(np.sort(h)).tolist()) for i, h in sets.items()]
    frame = spark.createDataFrame(rows, "id long, members array<long>, wide array<long>")
    pairs = spark.createDataFrame([(3 * k, 3 * k + d) for k in range(4) for d in (1, 2)], "a long, b long")
    kept = {tuple(r) for r in jaccard._near(pairs, frame, 80, 100).collect()}
    assert kept == {(3 * k, 3 * k + 1) for k in range(4)}
    assert max(8 * len(w) / len(m) for _, m, w in rows if len(m) > 64) <= 0.25 + 8 / 64
