"""Set similarity join over word shingles, exact, by partitioning the universe of shingles.

Method. For two sets with Jaccard similarity of at least t, the symmetric difference is at most H = (1-t)/(1+t) * (sum
of sizes). Sizes are cut into bands; a band has m = H+1 segments for its largest sizes, and a shingle's hash says which
segment it falls in. By pigeonhole two similar sets agree on some whole segment, so each set is indexed by a signature
per segment, in its own band and, if it can have larger partners there, in the next. Costs decide how the H+1 units of
evidence are shared out: a segment whose signatures collide too often is skipped, and another segment of the band gives
its unit instead by also indexing all its one-deletion neighbours (agreement up to one shingle counts two units). That
choice is made once per band from counts over all documents, so both sides of any pair follow it.

Before that, each set's shingles are counted that another set holds too (``shared``): similar sets have at least t of their
own in common, so a set with fewer has no partner and gets no signatures. Long sets leave some segments empty, and those
agree by chance; without this screen nearly every pair of long sets would meet.

Candidates meet in signature buckets. Equal sets are merged before (one representative each), and so are signatures that
bring the same documents together. In a bucket, sets are compared with leaders first, each with one leader a turn; only
sets that are still in different components afterwards are compared with each other, so a group of copies is linked by
about one comparison per member, while no link that would join two components is left out. Every comparison is exact on
the full sets of 64-bit shingle hashes; where many pairs are left, sketches in proportion to the sets go to the pairs first.

Null or empty text: no set, linked with nothing, component is the own id. Rows with a null id get a null component and
link nothing. A document is a row's id and text (64 bits of a hash of both): rows that agree in both are one document, and
rows that only share an id are documents of their own. Long texts are cut into words block by block. Ties need no rule:
links have no order. An empty table gives no rows. Columns other than id and text are not read; the rows that
``without_near_copies`` keeps have all their columns, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from math import floor

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import free_name, freed, freed_by_group, passing, staged
from daybook.llm.graph import components
from daybook.llm.screen import BITS, bit_table, packed, passes, repeated_bits
from daybook.llm.textvec import distinct, mix, slices, text_bytes, windows, words

BAND_RATIO = 1.4
SKETCH_WORDS = 16
FIRST_WORDS = 4
SLICE = 2 << 20  # bytes of text that a task makes into sets at a time
THIN_ROWS = 500_000  # signatures that a task packs at a time
LEADER_TURNS = 3
HELD = 500_000  # shingles that a task sends at a time to be counted
PART_SHINGLES = 1_000_000  # shingles that are compared in one group


class Bands:
    """Size bands for a similarity of at least num/den."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.lows = [1]

    def low(self, band: int) -> int:
        while len(self.lows) <= band:
            self.lows.append(max(self.lows[-1] + 1, floor(self.lows[-1] * BAND_RATIO)))
        return self.lows[band]

    def of(self, n: int) -> int:
        band = 0
        while self.low(band + 1) <= n:
            band += 1
        return band

    def segments(self, band: int) -> int:
        largest = self.low(band + 1) - 1
        return 2 * largest * (self.den - self.num) // (self.den + self.num) + 1

    def used(self, n: int) -> list[int]:
        """The bands in which a set of n members is indexed: its own, and those above that hold partners."""
        out = [self.of(n)]
        while self.low(out[-1] + 1) * self.num <= n * self.den:
            out.append(out[-1] + 1)
        return out


def _place(key: str) -> Column:
    """Where an id falls in a bit table."""
    return F.xxhash64(key).bitwiseAND(F.lit((1 << BITS) - 1)).cast("int").alias("key")


def _sets(batch: pa.RecordBatch, n: int, wanted=None) -> Iterator[tuple[int | None, np.ndarray]]:
    """(id, ascending distinct shingle hashes) of each row; of those that pass ``wanted``, a broadcast bit table of ids."""
    if wanted is not None:
        batch = batch.filter(pa.array(passes(wanted.value, batch.column(2).to_numpy().astype(np.uint64))))
    for part in slices(batch, batch.schema.names[1], SLICE):
        hashes, at = windows(*words(*text_bytes(part.column(1))), n)
        for i, key in enumerate(part.column(0).to_pylist()):
            yield key, distinct(hashes[at[i] : at[i + 1]])


def _sketch(h: np.ndarray) -> list[int]:
    """Parity of the members in each of 1024 cells: two sketches differ in no more bits than the sets in members."""
    odd = np.bincount((h >> np.uint64(7)).astype(np.int64) & (64 * SKETCH_WORDS - 1), minlength=64 * SKETCH_WORDS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()


def _wide(h: np.ndarray) -> np.ndarray:
    """A sketch like ``_sketch``, of as many cells as the set has members, rounded up to a power of two, 64 at least."""
    cells = 1 << max(6, (len(h) - 1).bit_length())
    odd = np.bincount((h >> np.uint64(7)).astype(np.int64) & (cells - 1), minlength=cells) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def summaries(docs: DataFrame, shingle: int) -> DataFrame:
    """(id, real, n, digest, sketch) of each document's set; ``docs`` has columns id, text and real."""

    def run(batches):
        for batch in batches:
            rows = [(k, len(h), hashlib.blake2b(h.tobytes(), digest_size=16).digest(), _sketch(h)) for k, h in _sets(batch, shingle)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.int64()),
                    batch.column("real"),
                    pa.array([r[1] for r in rows], pa.int64()),
                    pa.array([r[2] for r in rows], pa.binary()),
                    pa.array([r[3] for r in rows], pa.list_(pa.int64())),
                ],
                ["id", "real", "n", "digest", "sketch"],
            )

    return docs.mapInArrow(freed(run), "id long, real long, n long, digest binary, sketch array<long>")


def _planes(values: np.ndarray) -> bytes:
    """32-bit values byte plane by byte plane, which compress well where values are small."""
    return values.astype(np.uint32).view(np.uint8).reshape(-1, 4).T.tobytes()


def _from_planes(body: bytes) -> np.ndarray:
    return np.frombuffer(body, np.uint8).reshape(4, -1).T.copy().view(np.uint32).ravel()


def shared(docs: DataFrame, shingle: int, total: int, wanted=None) -> DataFrame:
    """(id, held): how many shingles of a set other sets hold too; sets without any are left out.

    ``total`` is the number of shingles; parts of the hash space of about ``PART_SHINGLES`` are looked at one by one, so a
    task holds as much at any size of input. Shingles travel as 32 bits within their part: equal bits of different
    shingles, and copies, may count one too many, never too few.

    Sets are sent in blocks of about ``HELD`` shingles. A part answers each block in one row, with the places in the block
    of the sets that hold a shared shingle, once per shingle; a block then counts its answers, of ``HELD`` places at most.
    So rows are blocks times parts, as the pieces of a shuffle, not sets times parts. A block's ids travel with one of its
    rows. A block is known by its content: were it made again with other rows, the answers would find no ids, and fail.
    """
    parts = max(1, -(-total // PART_SHINGLES))

    def sent(ids, sets) -> Iterator[pa.RecordBatch]:
        value = mix(np.concatenate(sets) + np.uint64(0x2545F4914F6CDD1D))
        place = (value >> np.uint64(32)) % np.uint64(parts) << np.uint64(32) | value & np.uint64(0xFFFFFFFF)
        sizes = np.array([len(h) for h in sets], np.int64)
        name = hashlib.blake2b(ids.tobytes() + sizes.tobytes() + value.tobytes(), digest_size=8).digest()
        order = np.argsort(place)
        place, owner = place[order], np.repeat(np.arange(len(sets), dtype=np.uint32), sizes)[order]
        part = (place >> np.uint64(32)).astype(np.int64)
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(part)]]).tolist()
        rows = []
        for a, b in zip(cuts, cuts[1:]):
            keys = _planes(np.diff(place[a:b].astype(np.uint32), prepend=np.uint32(0)))
            rows.append((int(part[a]), int.from_bytes(name, "little", signed=True), keys, _planes(owner[a:b]), b"" if a else ids.tobytes()))
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["part", "block", "keys", "own", "ids"])

    def run(batches):
        ids, sets, held = [], [], 0
        for batch in batches:
            for key, h in _sets(batch, shingle, wanted):
                if key is None or not len(h):
                    continue
                ids.append(key)
                sets.append(h)
                held += len(h)
                if held >= HELD:
                    yield from sent(np.array(ids, np.int64), sets)
                    ids, sets, held = [], [], 0
        if sets:
            yield from sent(np.array(ids, np.int64), sets)

    def answered(table: pa.Table) -> pa.Table:
        column = lambda name: [x.as_py() for x in table.column(name)]
        keys = [np.cumsum(_from_planes(b), dtype=np.uint32) for b in column("keys")]
        ends = np.cumsum([len(k) for k in keys]).tolist()
        keys = np.concatenate(keys)
        order = np.argsort(keys, kind="stable")
        again = keys[order[1:]] == keys[order[:-1]]
        twice = np.zeros(len(keys), bool)
        twice[order[np.concatenate([again, [False]]) | np.concatenate([[False], again])]] = True
        rows = []
        for block, own, ids, a, b in zip(column("block"), column("own"), column("ids"), [0, *ends], ends):
            places = np.sort(_from_planes(own)[twice[a:b]])
            if len(places) or ids:
                rows.append((block, _planes(np.diff(places, prepend=np.uint32(0))), ids))
        kinds = {"block": pa.int64(), "places": pa.binary(), "ids": pa.binary()}
        return pa.table({c: pa.array([r[i] for r in rows], k) for i, (c, k) in enumerate(kinds.items())})

    def counted(table: pa.Table) -> pa.Table:
        ids = next((np.frombuffer(x, np.int64) for x in table.column("ids").to_pylist() if x), None)
        if ids is None:
            raise ValueError("a block of sets was made again with other rows; docs must be read alike each time")
        number = np.zeros(len(ids), np.int64)
        for body in table.column("places").to_pylist():
            number += np.bincount(np.cumsum(_from_planes(body), dtype=np.uint32), minlength=len(ids))
        some = np.flatnonzero(number)
        return pa.table({"id": pa.array(ids[some]), "held": pa.array(number[some])})

    blocks = docs.mapInArrow(freed(run), "part long, block long, keys binary, own binary, ids binary")
    answers = blocks.groupBy("part").applyInArrow(freed_by_group(answered), "block long, places binary, ids binary")
    counts = answers.groupBy("block").applyInArrow(freed_by_group(counted), "id long, held long")
    return counts.groupBy("id").agg(F.sum("held").alias("held"))


SIGNATURES = "part long, signature long, id long, tag long"


def signatures(
    docs: DataFrame, shingle: int, num: int, den: int, units: dict[int, int] | None = None, screen=None, thin: bool = False, wanted=None
) -> DataFrame:
    """(part, signature, id, tag) per segment. ``part`` is the band and segment, ``tag`` 64 bits of the set's digest.

    ``units``: parts with -1 (skipped) or 1 (with one-deletion neighbours); all others count 0 (equality). ``screen``: a
    broadcast bit table that signatures must pass. ``thin``: only their low 32 bits, packed for such a table. ``wanted``:
    a broadcast bit table of the ids (places in column key) that take part.
    """
    full = THIN_ROWS if thin else 200_000

    def rows(parts, sigs, ids, tags) -> pa.RecordBatch:
        part, sig = np.concatenate(parts), np.concatenate(sigs)
        if thin:
            return packed(sig)
        id_, tag = (np.repeat(np.array(x, np.int64), [len(p) for p in parts]) for x in (ids, tags))
        return pa.RecordBatch.from_arrays([pa.array(c) for c in (part, sig.view(np.int64), id_, tag)], ["part", "signature", "id", "tag"])

    def run(batches):
        bands = Bands(num, den)
        of_size: dict[int, list[int]] = {}
        parts, sigs, ids, tags, held = [], [], [], [], 0
        for batch in batches:
            for key, h in _sets(batch, shingle, wanted):
                if key is None or not len(h):
                    continue
                tag = int.from_bytes(hashlib.blake2b(h.tobytes(), digest_size=16).digest()[:8], "little", signed=True)
                if len(h) not in of_size:
                    of_size[len(h)] = bands.used(len(h))
                value = mix(h + np.uint64(0x5851F42D4C957F2D))
                for band in of_size[len(h)]:
                    m = bands.segments(band)
                    segment = (value >> np.uint64(11)) % np.uint64(m)
                    total = np.zeros(m, np.uint64)
                    np.add.at(total, segment, h)
                    part = (np.int64(band) << 40) + np.arange(m, dtype=np.int64)
                    if units:
                        unit = np.array([units.get(p, 0) for p in part.tolist()])
                        two = unit[segment] == 1
                        less, of = total[segment[two]] - h[two], part[segment[two]]
                        total, part = np.concatenate([total[unit != -1], less]), np.concatenate([part[unit != -1], of])
                    sig = mix(total + mix(part.astype(np.uint64)))
                    if screen is not None:
                        hit = passes(screen.value, sig)
                        part, sig = part[hit], sig[hit]
                    parts.append(part)
                    sigs.append(sig)
                    ids.append(key)
                    tags.append(tag)
                    held += len(part)
                if held >= full:
                    yield rows(parts, sigs, ids, tags)
                    parts, sigs, ids, tags, held = [], [], [], [], 0
        if parts:
            yield rows(parts, sigs, ids, tags)

    return docs.mapInArrow(freed(run), "part int, body binary" if thin else SIGNATURES)


def shared_signatures(docs: DataFrame, shingle: int, num: int, den: int, units: dict[int, int] | None = None, wanted=None) -> DataFrame:
    """The rows of ``signatures`` that different sets may share, written once.

    Which signatures occur twice is first asked of their low bits, so that the many that nobody shares are left out
    where they arise, by a bit table; a false hit of that table costs a row, never a result.
    """
    thin = signatures(docs, shingle, num, den, units, thin=True, wanted=wanted)
    screen = docs.sparkSession.sparkContext.broadcast(repeated_bits(thin))
    return staged(signatures(docs, shingle, num, den, units, screen, wanted=wanted), "op8-signatures")


def members(docs: DataFrame, shingle: int, wanted=None) -> DataFrame:
    """(id, members, wide): the sets and their wide sketches; of documents that pass ``wanted``, a broadcast bit table of ids."""

    def sets(rows) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array([k for k, _ in rows], pa.int64()),
                pa.array([h.view(np.int64) for _, h in rows], pa.list_(pa.int64())),
                pa.array([_wide(h) for _, h in rows], pa.list_(pa.int64())),
            ],
            ["id", "members", "wide"],
        )

    def run(batches):
        for batch in batches:
            rows, held = [], 0
            for key, h in _sets(batch, shingle, wanted):
                rows.append((key, h))
                held += len(h)
                if held >= 500_000:
                    yield sets(rows)
                    rows, held = [], 0
            yield sets(rows)

    return docs.mapInArrow(freed(run), "id long, members array<long>, wide array<long>")


def allocate(costs: DataFrame, num: int, den: int) -> dict[int, int]:
    """Parts that are not plain: -1 for segments to skip, 1 for those that stand in with one-deletion neighbours.

    ``costs``: part, rows, pairs (that its signatures would bring together). Within a band the k-th costliest segment is
    skipped for the k-th cheapest, as long as its pairs outweigh the extra index rows and pairs that this brings.
    Only parts that can gain reach the driver: their number is bounded by the segments of the longest texts.
    """
    by_band: dict[int, list[tuple[int, int, int]]] = {}
    costly = costs.filter("pairs > 16 * rows").select((F.col("part").bitwiseAND(F.lit(~((1 << 40) - 1)))).alias("band")).distinct()
    for r in costs.withColumn("band", F.col("part").bitwiseAND(F.lit(~((1 << 40) - 1)))).join(costly, "band").collect():
        by_band.setdefault(r["part"] >> 40, []).append((r["pairs"], r["rows"], r["part"]))
    bands, units = Bands(num, den), {}
    for band, rows in by_band.items():
        rows.sort()
        size = bands.low(band + 1) / bands.segments(band) + 1
        for k in range(len(rows) // 2):
            (few, n, stand_in), (many, _, skip) = rows[k], rows[-1 - k]
            if many <= 16 * n * size + 2 * few:
                break
            units |= {stand_in: 1, skip: -1}
    return units


def _similar(a: Column, b: Column, na: Column, nb: Column, num: int, den: int) -> Column:
    both = F.size(F.array_intersect(a, b))
    return den * both >= num * (na + nb - both)


def _may_be_similar(a: str, b: str, num: int, den: int, n_words: int = SKETCH_WORDS) -> Column:
    """Necessary conditions on sizes and (the first words of) sketches; exact pairs follow from the sets."""
    col = lambda side, c: F.col(f"{side}.{c}")
    differ = sum((F.bit_count(col(a, "sketch")[i].bitwiseXOR(col(b, "sketch")[i])) for i in range(n_words)), F.lit(0))
    n = col(a, "n") + col(b, "n")
    return (
        (num * F.greatest(col(a, "n"), col(b, "n")) <= den * F.least(col(a, "n"), col(b, "n")))
        & (differ * (den + num) <= n * (den - num))
    )


def _near(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) that wide sketches leave. The wider of two is folded to the other's width; no similar pair goes."""
    side = lambda c: sets.select(F.col("id").alias(c), F.col("wide").alias(f"w{c}"), F.size("members").alias(f"n{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").withColumn("width", F.expr("least(size(wa), size(wb))"))
    folded = "aggregate(sequence(0, size({w}) DIV width - 1), 0L, (x, j) -> x ^ {w}[CAST(i + j * width AS INT)])"
    differ = F.expr(
        f"aggregate(sequence(0, width - 1), 0L, (n, i) -> n + bit_count({folded.format(w='wa')} ^ {folded.format(w='wb')}))"
    )
    return both.filter(differ * (den + num) <= (F.col("na") + F.col("nb")) * (den - num)).select("a", "b")


def _linked(buckets: DataFrame, info: DataFrame, docs: DataFrame, shingle: int, num: int, den: int) -> DataFrame | None:
    """(rep, component) over the sets of ``buckets`` (signature, times, rep); ``info`` has (rep, n, sketch).

    Sizes and sketches are looked up for pairs, of which there are few, not carried along with every signature.
    """
    counts = buckets.groupBy("signature").count()
    weights = staged(buckets.join(counts, "signature").groupBy("rep").agg(F.sum(F.col("count") * F.col("times")).alias("weight")), "op8-weights")
    found = None  # rep, component of those in a link
    live = buckets.withColumn("c", F.col("rep"))
    for turn in range(LEADER_TURNS + 1):
        if found is not None:
            at = live.select("signature", "times", "rep").join(found, "rep", "left")
            at = staged(at.select("signature", "times", "rep", F.coalesce("component", "rep").alias("c")), "op8-live")
            open_keys = at.groupBy("signature").agg(F.min("c").alias("x"), F.max("c").alias("y")).filter("x <> y").select("signature")
            live = staged(at.join(open_keys, "signature"), "op8-open")
        if live.isEmpty():
            break
        if turn < LEADER_TURNS:
            order = F.col("weight") if turn == 0 else F.xxhash64("rep", F.lit(turn))
            a = (live.join(weights, "rep") if turn == 0 else live).groupBy("signature").agg(
                F.max_by(F.struct("rep", "c"), F.struct(order, "rep")).alias("lead")
            ).select("signature", "lead.*")
            b, keep = live, F.col("a.c") != F.col("b.c")
        else:
            # All against all in what is left: conditions on sizes and whole sketches are part of the join, since pairs grow
            # faster than sets and must not be written before. A part of the sketch, as valid, sends most away sooner.
            a = b = live.join(info, "rep")
            first = _may_be_similar("a", "b", num, den, FIRST_WORDS)
            keep = (F.col("a.c") < F.col("b.c")) & first & _may_be_similar("a", "b", num, den)
        met = a.alias("a").join(b.alias("b"), (F.col("a.signature") == F.col("b.signature")) & keep)
        pairs = met.select(F.col("a.rep").alias("s"), F.col("b.rep").alias("t"), F.col("b.times").alias("times"))
        if turn < LEADER_TURNS:
            pairs = pairs.groupBy("s", "t").agg(F.sum("times").alias("count"))
            pairs = (
                pairs.join(info.alias("a"), F.col("s") == F.col("a.rep")).join(info.alias("b"), F.col("t") == F.col("b.rep"))
                .filter(_may_be_similar("a", "b", num, den))
                .select("s", "t", "count")
            )
            # A set is verified with one leader a turn, the one it shares most signatures with; others come in later turns.
            pairs = pairs.groupBy("t").agg(F.max_by("s", F.struct("count", "s")).alias("s"))
        else:
            pairs = pairs.select("s", "t").distinct()
        # What a turn stages goes at its end, but for the components.
        with passing(docs.sparkSession):
            pairs = staged(pairs.select(F.col("s").alias("a"), F.col("t").alias("b")), "op8-pairs")
            # Sets are read again for the few documents that sizes and sketches leave in pairs; a bit table names these, so
            # that no text is shuffled. The set of b goes to where that of a is.
            places = pairs.select(_place("a")).unionByName(pairs.select(_place("b"))).distinct()
            wanted = docs.sparkSession.sparkContext.broadcast(bit_table(places))
            sets = staged(members(docs, shingle, wanted), "op8-members")
            if turn == LEADER_TURNS:
                # A set may be in many of these pairs, and would go to each of them.
                pairs = staged(_near(pairs, sets, num, den), "op8-near")
            ones = sets.join(pairs.select(F.col("a").alias("id")).distinct(), "id", "left_semi")
            others = pairs.join(sets.select(F.col("id").alias("b"), F.col("members").alias("mb")), "b")
            links = (
                others.join(ones.select(F.col("id").alias("a"), F.col("members").alias("ma")), "a")
                .filter(_similar(F.col("ma"), F.col("mb"), F.size("ma"), F.size("mb"), num, den))
                .select("a", "b")
            )
            if found is None:
                edges = links
            else:
                edges = links.unionByName(found.select(F.col("rep").alias("a"), F.col("component").alias("b")))
            found = staged(components(edges).withColumnRenamed("node", "rep"), "op8-components", keep=True)
    return found


def _met(index: DataFrame) -> DataFrame:
    """(part, signature, rows, who, what) of the signatures that different sets share.

    The last two sum the halves of the members' hashes: signatures shared by the same documents agree in them.
    """
    h = F.xxhash64("id")
    ends = index.groupBy("part", "signature").agg(
        F.min("tag").alias("x"), F.max("tag").alias("y"), F.count(F.lit(1)).alias("rows"),
        F.sum(F.shiftright(h, 32)).alias("who"), F.sum(h.bitwiseAND(F.lit((1 << 32) - 1))).alias("what"),
    )
    return staged(ends.filter("x <> y").drop("x", "y"), "op8-met")


def _components_of(docs: DataFrame, rep_of: DataFrame, info: DataFrame, shingle: int, num: int, den: int) -> DataFrame | None:
    """(rep, component) of the representatives that link with another."""
    # Copies add nothing to the index. A false hit of the table adds rows of a copy, no more.
    context = docs.sparkSession.sparkContext
    wanted = context.broadcast(bit_table(info.select(_place("rep"))))
    total = info.agg(F.sum("n")).first()[0] or 0
    found = staged(shared(docs, shingle, total, wanted), "op8-shared")
    partnered = info.select("rep", "n").join(found, F.col("rep") == F.col("id")).filter(den * F.col("held") >= num * F.col("n"))
    wanted = context.broadcast(bit_table(partnered.select(_place("rep"))))
    index = shared_signatures(docs, shingle, num, den, wanted=wanted)
    met = _met(index)
    costs = met.groupBy("part").agg(F.sum("rows").alias("rows"), F.sum(F.col("rows") * (F.col("rows") - 1) / 2).cast("long").alias("pairs"))
    units = allocate(costs, num, den)
    if units:
        index = shared_signatures(docs, shingle, num, den, units, wanted)
        met = _met(index)
    # Of signatures that bring the same documents together, one is kept, with their number.
    kept = met.groupBy("rows", "who", "what").agg(F.min("signature").alias("signature"), F.count(F.lit(1)).alias("times"))
    kept = index.select("signature", "id").join(kept.select("signature", "times"), "signature")
    buckets = staged(kept.join(rep_of, "id").select("signature", "times", "rep").distinct(), "op8-buckets")
    return _linked(buckets, info, docs, shingle, num, den)


def _document(key: str, text: str) -> Column:
    """What a row is known by: its id and text. Null without an id."""
    key, text = F.col(f"`{key}`").cast("long"), F.col(f"`{text}`")
    return F.when(key.isNotNull(), F.xxhash64(key, text))


def documents(docs: DataFrame, shingle: int, num: int, den: int) -> DataFrame:
    """(id, real, n, component, least) per row of ``docs`` (id, text): the document, the row's id, its set's size, its
    component, and the component's smallest (real, id)."""
    docs = docs.select(_document("id", "text").alias("id"), "text", F.col("id").cast("long").alias("real"))
    docs = docs.select("id", "text", _place("id"), "real")
    known = staged(summaries(docs, shingle), "op8-sets", keep=True)
    with_set = known.filter("id is not null and n > 0")
    # Equal sets are one: some document stands for all.
    reps = with_set.groupBy("digest").agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    reps = staged(reps, "op8-info")
    rep_of = staged(with_set.select("id", "digest").join(reps.select("digest", "rep"), "digest").select("id", "rep").distinct(), "op8-reps")

    with passing(docs.sparkSession):
        found = _components_of(docs, rep_of, reps.select("rep", "n", "sketch"), shingle, num, den)
        found = found and staged(found, "op8-found", keep=True)
    component = F.col("rep") if found is None else F.coalesce("component", "rep")
    of = (rep_of if found is None else rep_of.join(found, "rep", "left")).select("id", component.alias("component"))
    rows = staged(known.select("id", "real", "n").join(of, "id", "left"), "op8-rows", keep=True)
    least = rows.filter("component is not null").groupBy("component").agg(F.min(F.struct("real", "id")).alias("least"))
    return rows.join(least, "component", "left").select("id", "real", "n", "component", "least")


def classes(docs: DataFrame, shingle: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """(id, n, component) per row of ``docs`` (id, text): documents linked at a similarity of num/den or more."""
    found = documents(docs, shingle, num, den)
    return found.select(F.col("real").alias("id"), "n", F.coalesce("least.real", "real").alias("component"))


def without_near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of ``docs`` but those linked with a row of a smaller id; rows without an id stay."""
    of = documents(docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text")), shingle, num, den)
    # Written, so that its size is known: few documents are broadcast, and texts stay where they are.
    own = free_name(docs, "gone")
    gone = staged(of.filter(F.col("id") != F.col("least.id")).select(F.col("id").alias(own)).distinct(), "op8-gone", keep=True)
    return docs.join(gone, _document(key, text) == F.col(own), "left_anti")
