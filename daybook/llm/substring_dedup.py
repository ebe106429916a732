"""Substring dedup by content-defined chunks.

Method. A gear rolling hash runs over the UTF-8 bytes of each text; a chunk ends where five of its bits are zero (32
bytes on average), which depends on the last 16 bytes only, so cuts return to the same places behind an insertion. A
chunk has at most ``MOST`` bytes: without a natural cut it ends there, at a character's end. Chunks never split a
character. A chunk is a repeat if the same digest (BLAKE2b, 128 bits) stands earlier: in a document of smaller id, or
before it in its own. Runs of adjacent repeats of at least ``min_bytes`` are cut out; a passage of more than 50 words
holds such a run wherever it stands, and chance repeats of single chunks do not reach it.

Each chunk travels once. Of equal chunks that a task sees together, only the first goes to the digest's task; the others
are repeats already, so a digest that stands in a third of all documents brings a few rows per task, not all of them.

A document is a row's id and text: rows that agree in both are one document, cut alike, and rows that only share an id
are documents of their own (the digest of the text orders them), so no text is cut by the places of another. Null or
empty text: nothing to remove, returned as it is. Rows with a null id are returned unchanged and repeat nothing. Long
texts are hashed piece by piece. Between equal chunks of one document the first place stays. An empty table gives no
rows. Other columns pass through, whatever their names. A task works on about ``PIECE`` bytes of texts at a time, a longer
text whole, and hands rows on in such parts.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

from daybook.llm.common import free_name, freed, passing, staged
from daybook.llm.textvec import slices, text_bytes

_rng = np.random.Generator(np.random.PCG64(77))
GEAR = _rng.integers(0, 2**32, 256, dtype=np.uint32)
CUT_BITS = np.uint32(0xF800)
REACH = 16  # bytes that bits up to 15 of the hash depend on
MOST = 512  # bytes of a chunk
SLICE = 8 << 20  # bytes of text whose chunks are compared before they are sent
PIECE = 1 << 20  # bytes of text, or of packed text, that a task works on at a time


def chunk_ends(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where chunks end (exclusive), over all texts."""
    if not len(data):
        return np.zeros(0, np.int64)
    h = GEAR[data]
    step = 1
    while step < REACH:
        later = h.copy()
        later[step:] += h[:-step] << np.uint32(step)
        h, step = later, step * 2
    cut = (h & CUT_BITS) == 0
    for d in range(REACH - 1):  # hashes of a text's first bytes still hold bytes of the text before
        at = starts[:-1] + d
        cut[at[at < len(data)]] = False
    follow = np.zeros(len(data), bool)
    follow[:-1] = (data[1:] & 0xC0) == 0x80
    cut &= ~follow
    ends = np.unique(np.concatenate([np.flatnonzero(cut) + 1, starts[1:][np.diff(starts) > 0]]))
    begins = np.concatenate(([0], ends[:-1]))
    # Too long: cut every MOST bytes from where the chunk begins, less what would split a character.
    extra = (ends - begins - 1) // MOST
    long = np.flatnonzero(extra)
    if len(long):
        nth = np.arange(extra.sum()) - np.repeat(np.cumsum(extra[long]) - extra[long], extra[long]) + 1
        more = np.repeat(begins[long], extra[long]) + nth * MOST
        for _ in range(3):
            more = more - follow[more - 1]
        ends = np.unique(np.concatenate([ends, more]))
    return ends


def _chunks(docs: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """d1, d2, id, h, at, size of each chunk of ``docs`` (id, h, text)."""
    data, starts = text_bytes(docs.column("text"))
    ends = chunk_ends(data, starts)
    begins = np.concatenate(([0], ends))[: len(ends)]
    raw, blake = memoryview(data.tobytes()), hashlib.blake2b
    digest = b"".join([blake(raw[a:b], digest_size=16).digest() for a, b in zip(begins.tolist(), ends.tolist())])
    text = np.searchsorted(starts, begins, "right") - 1
    ids, h = (docs.column(c).to_numpy()[text] for c in ("id", "h"))
    return *np.frombuffer(digest, "<i8").reshape(-1, 2).T, ids, h, begins - starts[text], ends - begins


def chunks(docs: DataFrame) -> DataFrame:
    """(d1, d2, id, h, at, size, again): chunks of ``docs`` (id, h, text) that may be the first of their digest, and, with
    ``again``, those that are known not to be."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                found = [c for piece in slices(part, "text", PIECE) if len((c := _chunks(piece))[0])]
                if not found:
                    continue
                d1, d2, ids, h, at, size = (np.concatenate(c) for c in zip(*found))
                order = np.lexsort((at, h, ids, d2, d1))
                d1, d2, ids, h, at, size = (c[order] for c in (d1, d2, ids, h, at, size))
                new = np.concatenate(([True], (d1[1:] != d1[:-1]) | (d2[1:] != d2[:-1])))
                head = np.flatnonzero(new)[np.cumsum(new) - 1]
                here = (ids == ids[head]) & (h == h[head]) & (at == at[head])
                keep = new | ~here  # the same place twice: rows that agree in id and text
                # Known repeats need no digest; their own place spreads them.
                d1 = np.where(here, d1, at * np.int64(0x9E3779B97F4A7C1) ^ h)
                columns = [pa.array(c[keep]) for c in (d1, np.where(here, d2, 0), ids, h, at, size, ~here)]
                yield pa.RecordBatch.from_arrays(columns, ["d1", "d2", "id", "h", "at", "size", "again"])

    return docs.mapInArrow(freed(run), "d1 long, d2 long, id long, h long, at long, size long, again boolean")


def _repeats(pieces: DataFrame) -> DataFrame:
    """(id, h, at, size) of all chunks that are not the first of their digest."""
    sorted_pieces = pieces.repartition("d1").sortWithinPartitions("again", "d1", "d2", "id", "h", "at")

    def run(batches):
        last = None  # digest and first place of the run that the batch before ended in
        for batch in batches:
            d1, d2, ids, h, at, size = (batch.column(i).to_numpy() for i in range(6))
            again = batch.column(6).to_numpy(zero_copy_only=False)
            out = again.copy()
            n = int((~again).sum())  # known repeats come last
            if n:
                new = np.concatenate(([True], (d1[1:n] != d1[: n - 1]) | (d2[1:n] != d2[: n - 1])))
                head = np.flatnonzero(new)[np.cumsum(new) - 1]
                place = np.stack([ids[:n], h[:n], at[:n]])
                first = place[:, head]
                if last is not None and last[0] == (d1[0], d2[0]):
                    first[:, : int((head == 0).sum())] = np.array(last[1])[:, None]
                out[:n] = (place != first).any(axis=0)
                last = (d1[n - 1], d2[n - 1]), first[:, -1].copy()
            if out.any():
                yield pa.RecordBatch.from_arrays([pa.array(c[out]) for c in (ids, h, at, size)], ["id", "h", "at", "size"])

    return sorted_pieces.mapInArrow(freed(run), "id long, h long, at long, size long")


def spans(docs: DataFrame, min_bytes: int = 100) -> DataFrame:
    """(id, h, spans): per document the byte ranges to cut out, as an array of (at, size) in order."""
    repeats = _repeats(chunks(docs.filter("id is not null")))
    listed = repeats.groupBy("id", "h").agg(F.sort_array(F.collect_set(F.struct("at", "size"))).alias("chunks"))

    def run(batches):
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                pair = batch.column("chunks").slice(i, 1).flatten()
                at, size = pair.field("at").to_numpy(), pair.field("size").to_numpy()
                # Adjacent repeats become one run.
                begin = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1] + size[:-1])))
                total = np.add.reduceat(size, begin)
                wide = total >= min_bytes
                out.append([{"at": a, "size": s} for a, s in zip(at[begin][wide].tolist(), total[wide].tolist())])
            kind = pa.list_(pa.struct([("at", pa.int64()), ("size", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("h"), pa.array(out, kind)], ["id", "h", "spans"])

    merged = listed.mapInArrow(freed(run), "id long, h long, spans array<struct<at:bigint,size:bigint>>")
    return merged.filter(F.size("spans") > 0)


def _compressed(rows: DataFrame, text: str) -> DataFrame:
    """``rows`` with ``text`` packed for its way to the spans: that takes a third of the disk."""
    names = rows.columns
    t = names.index(text)

    def run(batches):
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            for part in slices(batch, batch.schema.names[t], PIECE):
                columns = list(part.columns)
                columns[t] = pa.array([None if x is None else pack(x.encode()) for x in columns[t].to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays(columns, part.schema.names)

    plain = rows.toDF(*[f"c{i}" for i in range(len(names))])
    kinds = StructType([StructField(f.name, BinaryType() if i == t else f.dataType, f.nullable) for i, f in enumerate(plain.schema)])
    return plain.mapInArrow(freed(run), kinds).toDF(*names)


def cut_out(rows: DataFrame, text: str, spans: str) -> DataFrame:
    """Take the byte ranges in column ``spans`` out of ``text``, plain or as ``_compressed``; the column becomes what is left."""
    names, schema = rows.columns, rows.schema
    t, s = names.index(text), names.index(spans)
    packed = isinstance(schema[t].dataType, BinaryType)

    def run(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for part in slices(batch, batch.schema.names[t], PIECE):
                texts, ranges = part.column(t).to_pylist(), part.column(s).to_pylist()
                if packed:
                    texts = [None if x is None else unpack(x).decode() for x in texts]
                for i, r in enumerate(ranges):
                    if r and texts[i] is not None:
                        data, out, at = texts[i].encode(), [], 0
                        for x in r:
                            out.append(data[at : x["at"]])
                            at = x["at"] + x["size"]
                        texts[i] = b"".join([*out, data[at:]]).decode()
                columns = list(part.columns)
                columns[t] = pa.array(texts, pa.string() if packed else part.schema.field(t).type)
                yield pa.RecordBatch.from_arrays(columns, part.schema.names)

    # Spark looks columns up by name here: names with dots pass as plain ones.
    plain = rows.toDF(*[f"c{i}" for i in range(len(names))])
    kinds = StructType([StructField(f.name, StringType() if i == t else f.dataType, f.nullable) for i, f in enumerate(plain.schema)])
    return plain.mapInArrow(freed(run), kinds).toDF(*names).select(*[F.col(f"`{f.name}`") for f in schema])


def _digest(text: str) -> Column:
    return F.xxhash64(F.col(f"`{text}`"))


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", min_bytes: int = 100) -> tuple[DataFrame, str]:
    """The rows of ``docs`` with repeated passages cut out of ``text``, and the name of a column with the cut spans."""
    name, own, h = free_name(docs, "spans"), free_name(docs, "span_id"), free_name(docs, "span_text")
    id_ = F.col(f"`{key}`")
    with passing(docs.sparkSession):
        found = spans(docs.select(id_.cast("long").alias("id"), _digest(text).alias("h"), F.col(f"`{text}`").alias("text")), min_bytes)
        found = staged(found.select(F.col("id").alias(own), F.col("h").alias(h), F.col("spans").alias(name)), "op1-spans", keep=True)
    of = free_name(docs, "text_digest")
    texts = _compressed(docs.withColumn(of, _digest(text)), text)
    joined = texts.join(found, (id_.cast("long") == F.col(own)) & (F.col(of) == F.col(h)), "left").drop(own, h, of)
    return cut_out(joined, text, name), name
