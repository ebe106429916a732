"""SimHash near-duplicates, found with Golay-code fuzzy hashing.

Method. A document's 64-bit fingerprint (the majority of each bit over the hashes of its word shingles) is cut into three
segments of 22, 21 and 21 bits, each filled up with zeros to a word of 23 bits. The binary Golay code [23, 12, 7] is
perfect: each word lies within three bits of exactly one codeword, within four of one or six, within five of about 22. A
key is a triple of codeword numbers, 36 bits. A fingerprint gets every triple whose codewords need, summed over the
segments, at most two bits beyond the three that the code corrects. That sum is the pigeonhole: if two fingerprints
differ in at most four bits, some word in between differs from each in at most two, however the errors fall into the
segments, and what that word decodes to is a key of both. So no link is missed. Fingerprints get about 118 keys each.

Rows with the same key meet in one task, sorted, and are compared in chunks of bounded size; of the links found, a chunk
passes on a spanning forest only. Keys with more rows than a chunk are rare: what their chunks did not link already is
compared chunk against chunk, in tasks of bounded size. Links join the distinct fingerprints into components.

Words are runs of ``[^\\x20\\x09-\\x0D]``, A-Z lower-cased. Null text, empty text and white space: fingerprint zero, which
links like any other. With fewer words than a shingle has, the whole sequence is the shingle. Long texts are hashed
piece by piece. Rows with equal texts have equal fingerprints, and meet as one; rows keep their number. Rows with a null
id take part; a component of null ids only has a null component id. Ties (half of the hashes) give a zero bit. Columns
other than ``id`` and ``text`` are not read. An empty table gives no rows.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import passing, staged
from daybook.llm.graph import components
from daybook.llm.textvec import slices

# Fixed value: generator polynomial of the binary Golay code, x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GENERATOR = 0b110001110101
WIDTHS = (22, 21, 21)
DISTANCE = 4
CORRECTS = 3
CHUNK = 4_096
SEED = 42
PIECE = 1 << 16  # shingles whose bits are counted together


# --- fingerprints ----------------------------------------------------------------------------------------------------


def fingerprint(text: bytes, size: int = 4) -> int:
    """SimHash of the word shingles of a text, repeats included; XXH64 of the shingle joined by single spaces."""
    words = text.lower().split()  # of bytes: A-Z only, and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.array([len(w) + 1 for w in words])) - 1
    begins = np.concatenate([[0], ends[:-1] + 1])
    size = min(size, len(words))
    first, last = begins[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist()
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(first), PIECE):
        hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(first[at : at + PIECE], last[at : at + PIECE])], ">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(first)).tobytes(), "big")


def fingerprints(docs: DataFrame, size: int = 4) -> DataFrame:
    """(id, f): the fingerprint of each row of ``docs`` (id, text), as a signed long."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                texts = part.column("text").cast(pa.binary()).to_pylist()
                f = np.array([fingerprint(t or b"", size) for t in texts], np.uint64)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(f.view(np.int64))], ["id", "f"])

    id_type = docs.schema["id"].dataType.simpleString()
    return docs.select("id", "text").mapInArrow(run, f"id {id_type}, f long")


# --- keys ------------------------------------------------------------------------------------------------------------


def _remainders(words: np.ndarray) -> np.ndarray:
    """Of words as polynomials, divided by the generator: the syndrome, 11 bits."""
    r = words.astype(np.int64, copy=True)
    for bit in range(22, 10, -1):
        r ^= np.where(r >> bit & 1, GENERATOR << (bit - 11), 0)
    return r


class Cosets:
    """By syndrome: error patterns of at most five bits that lead to a codeword, lightest first."""

    def __init__(self):
        weights = range(CORRECTS + DISTANCE // 2 + 1)
        light = np.array([sum(1 << b for b in bits) for w in weights for bits in combinations(range(23), w)], np.int64)
        excess = np.maximum(np.bitwise_count(light).astype(np.int64) - CORRECTS, 0)
        syndrome = _remainders(light)
        order = np.lexsort((light, excess, syndrome))
        self.pattern, self.excess = light[order], excess[order]
        self.begin = np.searchsorted(syndrome[order], np.arange((1 << 11) + 1))

    def near(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place of the word, number of a codeword near it, excess) for all codewords within reach."""
        syndrome = _remainders(words)
        count = self.begin[syndrome + 1] - self.begin[syndrome]
        place = np.repeat(np.arange(len(words)), count)
        at = np.arange(len(place)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(self.begin[syndrome], count)
        # The code is systematic: the upper twelve bits number the codeword.
        return place, (words[place] ^ self.pattern[at]) >> 11, self.excess[at]


_cosets: list[Cosets] = []


def _paired(n: int, left, right):
    """All combinations of ``left`` and ``right`` of the same place that stay within the excess."""
    place, key, over = left
    r_place, r_key, r_over = right
    begin = np.searchsorted(r_place, np.arange(n + 1))
    count = begin[place + 1] - begin[place]
    take = np.repeat(np.arange(len(place)), count)
    at = np.arange(len(take)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(begin[place], count)
    total = over[take] + r_over[at]
    ok = total <= DISTANCE // 2
    take, at = take[ok], at[ok]
    return place[take], key[take] << 12 | r_key[at], total[ok]


def keys_of(f: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, key) of every key of the fingerprints ``f`` (unsigned)."""
    if not _cosets:
        _cosets.append(Cosets())
    shift, found = 64, None
    for width in WIDTHS:
        shift -= width
        segment = (f >> np.uint64(shift) & np.uint64((1 << width) - 1)).astype(np.int64)
        near = _cosets[0].near(segment)
        found = near if found is None else _paired(len(f), found, near)
    return found[0], found[1]


def keyed(distinct: DataFrame) -> DataFrame:
    """(key, f): one row per key of each distinct fingerprint."""

    def run(batches):
        for batch in batches:
            f = batch.column(0).to_numpy()
            for at in range(0, len(f), 2_000):
                part = f[at : at + 2_000]
                place, key = keys_of(part.view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(part[place])], ["key", "f"])

    return distinct.select("f").mapInArrow(run, "key long, f long")


# --- links -----------------------------------------------------------------------------------------------------------


def forest(f: np.ndarray, g: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Places (i, j) of links that join what the links within ``f``, or between ``f`` and ``g``, join."""
    both = f if g is None else np.concatenate([f, g])
    group = np.arange(len(both))
    out = []
    for i in range(len(f)):
        first = i + 1 if g is None else len(f)
        hit = np.flatnonzero(np.bitwise_count(both[first:] ^ f[i]) <= DISTANCE) + first
        hit = hit[group[hit] != group[i]]
        while len(hit):
            j = hit[0]
            out.append((i, int(j) if g is None else int(j) - len(f)))
            group[group == group[j]] = group[i]
            hit = hit[group[hit] != group[i]]
    return out


def _chunk_links(keys: DataFrame) -> DataFrame:
    """(a, b, key, chunk): links within chunks of a key; of keys with several chunks also each row, as (f, null)."""

    def run(batches):
        def emit(f: np.ndarray, key: int, chunk: int, hot: bool) -> None:
            for i, j in forest(f.view(np.uint64)):
                out.append((int(f[i]), int(f[j]), key, chunk))
            if hot:
                out.extend((int(x), None, key, chunk) for x in f)

        def flushed():
            batch = pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.int32()))], ["a", "b", "key", "chunk"]
            )
            out.clear()
            return batch

        out: list[tuple] = []
        now, chunk, rest = None, 0, np.zeros(0, np.int64)
        for batch in batches:
            key, f = batch.column("key").to_numpy(), batch.column("f").to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(key)) + 1, [len(key)]])
            size = np.diff(cuts)
            # Most keys have one row or two: only longer runs, and the ends of the batch, are looked at one by one.
            end = np.isin(np.arange(len(size)), (0, len(size) - 1))
            two = cuts[:-1][(size == 2) & ~end]
            two = two[np.bitwise_count((f[two] ^ f[two + 1]).view(np.uint64)) <= DISTANCE]
            out.extend(zip(f[two].tolist(), f[two + 1].tolist(), key[two].tolist(), [0] * len(two)))
            look = np.flatnonzero((size > 2) | end)
            for s in look.tolist():
                k, part = int(key[cuts[s]]), f[cuts[s] : cuts[s + 1]]
                if k != now:
                    if len(rest) > 1 or chunk:
                        emit(rest, now, chunk, chunk > 0)
                    now, chunk, rest = k, 0, part
                else:
                    rest = np.concatenate([rest, part])
                while len(rest) > CHUNK:
                    emit(rest[:CHUNK], now, chunk, True)
                    chunk, rest = chunk + 1, rest[CHUNK:]
                if len(out) > 50_000:
                    yield flushed()
        if len(rest) > 1 or chunk:
            emit(rest, now, chunk, chunk > 0)
        if out:
            yield flushed()

    return keys.repartition("key").sortWithinPartitions("key", "f").mapInArrow(run, "a long, b long, key long, chunk int")


def _across_chunks(hot: DataFrame, groups: DataFrame) -> DataFrame:
    """(a, b): links between chunks of a key, but between rows that are in one component already.

    ``hot`` has (f, key, chunk), ``groups`` (f, component). A key whose rows are one component is done. Of the others
    every pair of chunks makes a task of its own; rows of one component are not compared with each other.
    """
    rows = hot.join(groups, "f")
    open_keys = rows.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.max("chunk").alias("last"))
    open_keys = open_keys.filter("x <> y").select("key", "last")
    rows = rows.join(open_keys, "key")
    # A row goes to the pair of its chunk with every chunk, the lower number first.
    other = F.explode(F.sequence(F.lit(0), F.col("last"))).alias("other")
    pairs = rows.select("*", other).select("key", "f", "component", "chunk", F.least("chunk", "other").alias("p"), F.greatest("chunk", "other").alias("q"))

    def run(table: pa.Table) -> pa.Table:
        f, c = table.column("f").to_numpy(), table.column("component").to_numpy()
        left = table.column("chunk").to_numpy() == table.column("p").to_numpy()
        a, b = [], []
        for group in np.unique(c[left]).tolist():
            i, j = np.flatnonzero(left & (c == group)), np.flatnonzero(~left & (c != group))
            for x, y in forest(f[i].view(np.uint64), f[j].view(np.uint64)):
                a.append(int(f[i][x]))
                b.append(int(f[j][y]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return pairs.filter("p < q").groupBy("key", "p", "q").applyInArrow(run, "a long, b long")


def links(distinct: DataFrame) -> DataFrame:
    """(a, b): fingerprints at ``DISTANCE`` or fewer bits, enough of them to join all that such links join."""
    found = staged(_chunk_links(keyed(distinct)), "op11-links")
    near = found.filter("b is not null").select("a", "b")
    hot = found.filter("b is null").select(F.col("a").alias("f"), "key", "chunk")
    if hot.isEmpty():
        return near
    nodes = near.select(F.col("a").alias("f")).union(near.select("b")).distinct()
    alone = hot.select("f").distinct().join(nodes, "f", "left_anti").select("f", F.col("f").alias("component"))
    groups = components(near).select(F.col("node").alias("f"), "component").union(alone)
    return near.union(_across_chunks(hot, staged(groups, "op11-groups")))


def classes(docs: DataFrame, size: int = 4) -> DataFrame:
    """(id, f, component): each row of ``docs`` (id, text), its fingerprint, the smallest id that links reach."""
    with passing(docs.sparkSession):
        rows = staged(fingerprints(docs, size), "op11-fingerprints", keep=True)
        # A fingerprint's smallest id, nulls aside; copies combine in the map tasks.
        distinct = staged(rows.groupBy("f").agg(F.min("id").alias("least")), "op11-distinct")
        joined = components(links(distinct)).withColumnRenamed("node", "f")
        named = distinct.join(joined, "f")
        least = named.groupBy("component").agg(F.min("least").alias("reach"))
        found = distinct.join(named.select("f", "component").join(least, "component").select("f", "reach"), "f", "left")
        # Of a fingerprint that nothing reaches, the least is its own; a component without an id stays null.
        answer = staged(found.select("f", F.coalesce("reach", "least").alias("component")), "op11-answer", keep=True)
    return rows.join(answer, "f").select("id", "f", "component")
