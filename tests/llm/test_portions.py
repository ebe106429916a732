"""Workers that align tokens hold the pieces of a portion of a block, and what the corpus counts is not sent to all of them."""

import numpy as np
import public_tokenizers
import pytest

from daybook.llm import token_alignment as align
from daybook.llm.bpe import Vocabulary

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture
def texts():
    rng = np.random.default_rng(3)
    found = [" ".join(f"wörd{x}" if x % 9 == 0 else f"word{x}" for x in rng.integers(0, 400, 60)) for _ in range(40)]
    return [*found, None, "", " ", "white \n space ", "▁ mark", found[0], "a" * 3000]


def test_a_block_is_cut_portion_by_portion(texts, monkeypatch):
    with open(PATHS[0], encoding="utf-8") as f, open(PATHS[1], "rb") as g:
        files = f.read(), g.read(), Vocabulary(PATHS[0]).tokens
    whole = align._block(align.Pair(*files), texts)
    monkeypatch.setattr(align, "PORTION", 1_000, raising=False)
    pair, cut = align.Pair(*files), []
    pieces, aligned = pair.pieces, pair.align
    monkeypatch.setattr(pair, "pieces", lambda text: cut.append(len(text)) or pieces(text))
    monkeypatch.setattr(pair, "align", lambda new: cut.append(None) or aligned(new))
    parted = align._block(pair, texts)
    assert all(np.array_equal(x, y) if isinstance(x, np.ndarray) else x == y for x, y in zip(whole, parted))
    ends = [i for i, n in enumerate(cut) if n is None]
    portions = [cut[a + 1 : b] for a, b in zip([-1, *ends], ends)]
    assert sum(map(len, portions)) == sum(bool(t) for t in texts)
    assert all(sum(p) <= 1_000 or len(p) == 1 for p in portions) and len(portions) > 10
    # What is kept between blocks is as long for each piece, whichever portion it came with.
    assert len(pair.known) == len(pair.groups) == len(pair.fits) == len(pair.size) == len(pair.counts) == len(pair.uses)
    assert pair.size.sum() == len(pair.pairs) and not pair.added
    again = align._block(pair, texts[::-1])
    assert again[1] == whole[1][::-1] and np.array_equal(again[0], whole[0][::-1])


def test_counts_meet_their_blocks_by_shuffle(spark, texts, monkeypatch):
    plans = {}
    staged = align.staged

    def seen(df, label, keep=False):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return staged(df, label, keep)

    monkeypatch.setattr(align, "staged", seen)
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string")
    assert align.aligned(frame, *PATHS).count() == len(texts)
    assert "SortMergeJoin" in plans["op12-answers"] and "Broadcast" not in plans["op12-answers"]


def test_a_worker_gives_back_after_each_block(spark, texts, monkeypatch):
    import pyarrow as pa
    from pyspark import TaskContext

    runs, given = [], []
    monkeypatch.setattr(align, "give_back", lambda: given.append(1), raising=False)
    monkeypatch.setattr(align, "freed", lambda run: runs.append(run) or run, raising=False)
    monkeypatch.setattr(align, "staged", lambda df, label, keep=False: df)
    monkeypatch.setattr(TaskContext, "get", classmethod(lambda cls: type("", (), {"partitionId": lambda self: 0})()))
    monkeypatch.setattr(align, "BLOCK_BYTES", 4_000)
    align._blocks(spark.createDataFrame([], "id long, text string"), *PATHS)
    blocks = list(runs[0](iter([pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["id", "text"])])))
    assert len(given) == len(blocks) > 3 and sum(len(b.column("ids")[0]) for b in blocks) == len(texts)
