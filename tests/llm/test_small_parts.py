"""Stages over texts work on small parts of a batch and hand these on: a worker holds as much whatever a batch holds."""

import pyarrow as pa

from daybook.llm import substring_dedup as dedup


def test_texts_are_packed_hashed_and_cut_in_parts(spark, monkeypatch):
    caught = []
    monkeypatch.setattr(dedup, "freed", lambda run: caught.append(run) or run, raising=False)
    monkeypatch.setattr(dedup, "PIECE", 10_000, raising=False)
    texts = [f"{i} some words of a text " * 100 for i in range(30)] + [None, "", "long " * 9000, "é" * 40]
    ids = pa.array(range(len(texts)), pa.int64())

    dedup.chunks(spark.createDataFrame([], "id long, h long, text string"))
    worked = []
    chunk_ends = dedup.chunk_ends
    monkeypatch.setattr(dedup, "chunk_ends", lambda data, starts: worked.append((len(data), len(starts) - 1)) or chunk_ends(data, starts))
    batch = pa.RecordBatch.from_arrays([ids, ids, pa.array(texts)], ["id", "h", "text"])
    found = pa.Table.from_batches(caught[-1](iter([batch])))
    assert sum(n for n, _ in worked) == sum(len((t or "").encode()) for t in texts)
    assert sorted(n for n, _ in worked)[-2] < 20_000  # but for the text longer than a part
    assert sum(found.column("size").to_pylist()) == sum(n for n, _ in worked)
    # Equal chunks of different parts of a slice are still compared before they are sent.
    sent = [(a, b) for a, b, again in zip(*(found.column(c).to_pylist() for c in ("d1", "d2", "again"))) if not again]
    assert len(sent) == len(set(sent)) < found.num_rows

    dedup._compressed(spark.createDataFrame([], "doc_id long, text string"), "text")
    packed = list(caught[-1](iter([pa.RecordBatch.from_arrays([ids, pa.array(texts)], ["c0", "c1"])])))
    assert len(packed) > 5
    binary = pa.Table.from_batches(packed).column(1).combine_chunks()
    monkeypatch.setattr(dedup, "PIECE", 200)
    dedup.cut_out(spark.createDataFrame([], "doc_id long, text binary, spans array<struct<at:bigint,size:bigint>>"), "text", "spans")
    spans = pa.array([[{"at": 0, "size": 1}] if t else None for t in texts], pa.list_(pa.struct([("at", pa.int64()), ("size", pa.int64())])))
    spans = pa.array([*spans.to_pylist()[:-1], [{"at": 2, "size": 4}]], spans.type)
    cut = list(caught[-1](iter([pa.RecordBatch.from_arrays([ids, binary, spans], ["c0", "c1", "c2"])])))
    assert len(cut) > 5
    left = [t[1:] if t else t for t in texts[:-1]] + ["é" * 38]
    assert pa.Table.from_batches(cut).column(1).to_pylist() == left
