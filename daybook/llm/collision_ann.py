"""Approximate nearest neighbours by collision counting over query-centred windows.

Method. Each vector is projected on m random lines; every line is cut into cells, and keeps the cell of each projection in a
byte. A query looks at a window of cells around its own projection on each line and counts, per vector, on how many lines it
lies inside (collisions): one pass over bytes. Widening all windows by a factor is the next virtual rehashing; the first
that gives enough is sought from where the query before it ended. Vectors whose count reaches the collision threshold are
candidates; these are verified with the exact inner product in double precision. Largest inner product is turned into nearest distance by one more coordinate that makes all lengths equal.

Spark deals the vectors into blocks of bounded size by a hash of the id, each with its own index, and the queries into
blocks too. Each pair of blocks gives the best of every query; the best of all blocks are ranked per query.

Vectors that are null, empty, zero, or hold a null or non-finite component take no part, nor do rows with a null id.
Vectors meet only vectors of the same length. Ties go to the smaller id. Rows that repeat an id and vector count once.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from daybook.llm.common import staged

LINES = 96
THRESHOLD = 66  # of LINES
WIDTH = 0.3  # half of the first window; vectors have length 1
WIDEN = 1.12
CELLS = 256  # of a line; a cell's number is a byte
VERIFIED = 0.12  # share of a block's vectors that is verified at least
BLOCK = 16_384
QUERY_BLOCK = 2_048


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _lines(dim: int, seed: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).standard_normal((dim + 1, LINES))


def _packed(rows: DataFrame, block: str) -> DataFrame:
    """One row per block: its ids and vectors as bytes."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        ids = table.column("id").to_numpy().astype("<i8")
        vectors = np.concatenate([np.asarray(v, "<f8") for v in table.column("vector").to_pylist()])
        return pa.table(
            {
                "dim": pa.array([table.column("dim")[0].as_py()], pa.int32()),
                "block": pa.array([table.column(block)[0].as_py()], pa.int64()),
                "ids": pa.array([ids.tobytes()], pa.binary()),
                "vectors": pa.array([vectors.tobytes()], pa.binary()),
            }
        )

    return rows.select("dim", block, "id", "vector").groupBy("dim", block).applyInArrow(run, "dim int, block long, ids binary, vectors binary")


class Index:
    """The cells of one block's projections."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, longest: float, seed: int):
        self.ids, self.vectors, self.longest, self.seed = ids, vectors, longest, seed
        scaled = vectors / longest
        extra = np.sqrt(np.maximum(0.0, 1.0 - (scaled * scaled).sum(1)))
        projected = np.column_stack([scaled, extra]) @ _lines(vectors.shape[1], seed)
        self.reach = float(np.abs(projected).max()) or 1.0
        self.cells = np.ascontiguousarray(self.cell(projected).T)
        self.moved, self.inside = np.empty_like(self.cells), np.empty(self.cells.shape, bool)
        self.round = 0

    def cell(self, place: np.ndarray) -> np.ndarray:
        return np.clip((place + self.reach) * (CELLS / 2 / self.reach), 0, CELLS - 1).astype(np.uint8)

    def centres(self, queries: np.ndarray) -> np.ndarray:
        unit = queries / np.sqrt((queries * queries).sum(1, keepdims=True))
        return np.column_stack([unit, np.zeros(len(queries))]) @ _lines(self.vectors.shape[1], self.seed)

    def collisions(self, centre: np.ndarray, turn: int) -> np.ndarray:
        """On how many lines each vector lies inside the window of a turn."""
        half = WIDTH * WIDEN**turn
        low, high = self.cell(centre - half), self.cell(centre + half)
        # Cells below the window wrap around to large numbers.
        np.subtract(self.cells, low[:, None], out=self.moved)
        np.less_equal(self.moved, (high - low)[:, None], out=self.inside)
        return np.add.reduce(self.inside.view(np.uint8), axis=0, dtype=np.uint8)

    def candidates(self, centre: np.ndarray, want: int) -> np.ndarray:
        """The vectors over the threshold in the first turn that has ``want`` of them; windows only grow with the turn."""

        def over() -> np.ndarray:
            return np.flatnonzero(self.collisions(centre, self.round) >= THRESHOLD)

        found = over()
        while len(found) < want:
            self.round += 1
            found = over()
            if len(found) >= want:
                return found
        while self.round:
            self.round -= 1
            fewer = over()
            if len(fewer) < want:
                self.round += 1
                break
            found = fewer
        return found

    def best(self, key: int, query: np.ndarray, centre: np.ndarray, k: int, verify: int) -> tuple[np.ndarray, np.ndarray]:
        found = self.candidates(centre, min(len(self.ids), max(verify, ceil(VERIFIED * len(self.ids)))))
        found = found[self.ids[found] != key]
        if len(found) > k:
            # A quick product leaves the best and what rounding might have put behind them.
            near = self.vectors[found] @ query
            rounding = 1e-9 * self.longest * float(np.sqrt(query @ query))
            found = found[~(near < np.partition(near, -k)[-k] - rounding)]
        scores = np.cumsum(self.vectors[found] * query, axis=1)[:, -1] if len(found) else np.zeros(0)
        top = np.lexsort((self.ids[found], -scores))[:k]
        return self.ids[found[top]], scores[top]


def nearest(vectors: DataFrame, queries: Column, k: int = 20, verify: int = 600, seed: int = 5) -> DataFrame:
    """(query_id, rank, id, score) over ``vectors`` (id, vector), for the rows for which ``queries`` holds."""
    good = staged(
        vectors.filter(F.col("id").isNotNull() & usable(F.col("vector")))
        .select(F.col("id").cast("long").alias("id"), F.col("vector").cast("array<double>").alias("vector"), queries.alias("asks"))
        .dropDuplicates(["id", "vector"])
        .withColumn("dim", F.size("vector")),
        "op10-vectors",
    )
    length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    n, asked, longest = good.agg(F.count(F.lit(1)), F.count_if("asks"), F.max(length)).first()
    blocks, query_blocks = max(1, ceil((n or 0) / BLOCK)), max(1, ceil((asked or 0) / QUERY_BLOCK))
    place = lambda b, s: F.pmod(F.xxhash64("id", F.lit(s)), F.lit(b))
    data = staged(_packed(good.withColumn("b", place(blocks, 1)), "b"), "op10-blocks")
    asks = staged(_packed(good.filter("asks").withColumn("q", place(query_blocks, 2)), "q"), "op10-queries")
    asks = asks.select(F.col("dim").alias("q_dim"), F.col("block").alias("q_block"), F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"))
    pairs = data.withColumn("q", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(query_blocks - 1).cast("long")))).join(
        asks, (F.col("dim") == F.col("q_dim")) & (F.col("q") == F.col("q_block"))
    )
    longest = float(longest or 1.0)

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                dim = row["dim"]
                index = Index(np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["vectors"], "<f8").reshape(-1, dim), longest, seed)
                keys, asked = np.frombuffer(row["q_ids"], "<i8"), np.frombuffer(row["q_vectors"], "<f8").reshape(-1, dim)
                best = [index.best(key, q, c, k, verify) for key, q, c in zip(keys.tolist(), asked, index.centres(asked))]
                sizes = [len(i) for i, _ in best]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(keys, sizes), pa.int64()),
                        pa.array(np.concatenate([i for i, _ in best]), pa.int64()),
                        pa.array(np.concatenate([s for _, s in best]), pa.float64()),
                    ],
                    ["query_id", "id", "score"],
                )

    # A pair of blocks is some megabytes in one row: dealt out one by one, each is a task's work of its own.
    pairs = pairs.select("dim", "ids", "vectors", "q_ids", "q_vectors").repartition(max(1, min(blocks * query_blocks, 4096)))
    found = pairs.mapInArrow(run, "query_id long, id long, score double").distinct()
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "id", "score")
