"""A bit table of keys, of a size that does not depend on them, to tell early which rows cannot have a partner."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import freed

BITS = 26  # 2**26 bits, 8 MB
PARTS = 256


def bit_table(keys: DataFrame) -> np.ndarray:
    """Bits of the low ends of ``keys`` (column key, int). What is collected are 256 rows, 8 MB, at any size of input."""
    size = (1 << BITS) // PARTS

    def run(table: pa.Table) -> pa.Table:
        mask = np.zeros(size, np.uint8)
        mask[table.column("bit").to_numpy() % size] = 1
        return pa.table({"part": table.column("part").slice(0, 1), "bits": pa.array([np.packbits(mask).tobytes()], pa.binary())})

    bit = F.col("key").cast("long").bitwiseAND(F.lit((1 << BITS) - 1)).alias("bit")
    places = keys.select(bit).distinct().withColumn("part", F.floor(F.col("bit") / size).cast("long"))
    out = np.zeros((PARTS, size // 8), np.uint8)
    for r in places.groupBy("part").applyInArrow(run, "part long, bits binary").collect():
        out[r["part"]] = np.frombuffer(r["bits"], np.uint8)
    return out.ravel()


def packed(keys: np.ndarray) -> pa.RecordBatch:
    """(part, body): the low 32 bits of ``keys``, sorted, as differences in byte planes, which compress well."""
    keys, low = keys.astype(np.uint32), np.uint32((1 << BITS) // PARTS - 1)
    part = (keys & np.uint32((1 << BITS) - 1)) // np.uint32(low + 1)
    place = ((keys >> np.uint32(BITS)) * np.uint32(low + 1)) | (keys & low)
    order = np.lexsort((place, part))
    part, place = part[order], place[order]
    first = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(part)]])
    bodies = [np.diff(place[a:b], prepend=np.uint32(0)).view(np.uint8).reshape(-1, 4).T.tobytes() for a, b in zip(first, first[1:])]
    return pa.RecordBatch.from_arrays([pa.array(part[first[:-1]].astype(np.int32)), pa.array(bodies, pa.binary())], ["part", "body"])


def repeated_bits(keys: DataFrame) -> np.ndarray:
    """The bit table of those keys that occur twice or more in ``keys``, rows of ``packed``.

    A task holds two planes of 2**24 places for one part at a time, whatever the number of keys.
    """
    size = (1 << BITS) // PARTS
    places = size << (32 - BITS)

    def run(batches):
        def bits() -> pa.RecordBatch:
            body = np.packbits(twice.reshape(-1, size).any(axis=0)).tobytes()
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([body], pa.binary())], ["part", "bits"])

        now = once = twice = None
        for batch in batches:
            for part, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if part != now:
                    if now is not None:
                        yield bits()
                    now, once, twice = part, np.zeros(places, bool), np.zeros(places, bool)
                place = np.cumsum(np.frombuffer(body, np.uint8).reshape(4, -1).T.copy().view(np.uint32).ravel(), dtype=np.uint32)
                twice[place[1:][place[1:] == place[:-1]]] = True
                twice[place[once[place]]] = True
                once[place] = True
        if now is not None:
            yield bits()

    out = np.zeros((PARTS, size // 8), np.uint8)
    for r in keys.repartition("part").sortWithinPartitions("part").mapInArrow(freed(run), "part int, bits binary").collect():
        out[r["part"]] = np.frombuffer(r["bits"], np.uint8)
    return out.ravel()


def passes(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    bit = (keys & np.uint64((1 << BITS) - 1)).astype(np.int64)
    return (table[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8)) & 1 == 1
