"""Katz back-off language model: counts, discounts and back-off weights in partitioned tables, scores per document.

Model. P(w | u) = d(c(u,w)) c(u,w) / c(u) for bigrams that occur in training, else alpha(u) P(w); P(w) = d(c(w)) c(w) / N for known words, and the mass left is that of the one unknown word. d is the
Good-Turing discount for counts up to K and 1 beyond; alpha(u) makes the probabilities of every context sum to 1
exactly, as does the unknown word for single words. A context (or the words themselves) that discounting leaves nothing
to back off with keeps one part in count + 1 for it. A text is a start (context only), its words, and an end, which is a
token.

Work. Texts are read once into pieces of about a million tokens, with a local number per word, staged in the shared
folder. Each piece sends its distinct words to buckets of the hash space; a bucket counts all pieces' words, numbers them
(frequent words low) and answers each piece in the piece's own order. With these numbers each piece sends its distinct
bigrams to buckets by context; a bucket counts them, keeps its part of the model table, and answers with counts and what
the contexts need. A context that occurs more than ``HOT`` times is dealt out over several units by the following word,
whose sums the piece adds up. So a word or bigram is one entry per piece however often it occurs, rows are few and large,
no bucket holds more than its share, and no part of the model passes the driver but counts of counts. The number of
buckets grows with the entries. Numbers of words take 32 bits.

Null text is empty: its end is its only token. Rows with a null id are scored and train. Rows that repeat an id are
documents of their own. Long texts make a piece of their own. An empty training set gives every token the unknown word's
probability, 1; an empty table gives no rows. Columns other than id and text are not read. Sums have no ties.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import staged
from daybook.llm.textvec import distinct, mix, slices, text_bytes, words
from daybook.session import new_scratch_path, remove_path

PIECE_TOKENS = 1_000_000
BUCKET_ENTRIES = 1_500_000
HOT = 2_000_000  # occurrences of a context that one unit holds
K = 5  # counts up to K are discounted
START, END = np.uint64(0x5354415254), np.uint64(0x454E44)


def _pack(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).tobytes())


def _unpack(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def _binary(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[] for _ in names], kinds)], names)


# --- pieces ----------------------------------------------------------------------------------------------------------

PIECES = "piece long, ids binary, no_id binary, held binary, sizes binary, words binary, tokens binary, n_words long"


def pieces(docs: DataFrame) -> DataFrame:
    """Rows of many documents from (id, text, held): ids, sizes in tokens, distinct words (ascending), tokens by place."""
    names = [c.split()[0] for c in PIECES.split(", ")]
    kinds = [pa.int64()] + [pa.binary()] * 6 + [pa.int64()]

    def piece(ids, held, sizes, tokens) -> pa.RecordBatch:
        all_tokens = np.concatenate(tokens)
        own = distinct(np.append(all_tokens, START))
        local = np.searchsorted(own, all_tokens).astype(np.int32)
        number = np.array([i or 0 for i in ids], np.int64)
        missing = np.array([i is None for i in ids], bool)
        row = (uuid.uuid4().int >> 65, _pack(number), _pack(missing), _pack(np.array(held, bool)), _pack(np.concatenate(sizes)), _pack(own), _pack(local), len(own))
        return _binary([row], names, kinds)

    def run(batches) -> Iterator[pa.RecordBatch]:
        ids, held, sizes, tokens, n = [], [], [], [], 0
        for batch in batches:
            for part in slices(batch, "text", 4 << 20):
                hashes, at = words(*text_bytes(part.column("text")))
                own = np.insert(hashes, at[1:], END)  # each text's end after its words
                ids += part.column("id").to_pylist()
                held += part.column("held").to_pylist()
                sizes.append(np.diff(at) + 1)
                tokens.append(own)
                n += len(own)
                if n >= PIECE_TOKENS:
                    yield piece(ids, held, sizes, tokens)
                    ids, held, sizes, tokens, n = [], [], [], [], 0
        if ids:
            yield piece(ids, held, sizes, tokens)

    return docs.mapInArrow(run, PIECES)


def _bounds(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Where each bucket begins among ascending hashes; buckets are equal ranges of the hash space."""
    edges = (np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)) if bits else np.zeros(1, np.uint64)
    return np.append(np.searchsorted(hashes, edges), len(hashes))


def _training(row: dict) -> np.ndarray:
    """Per token: does it train?"""
    return np.repeat(~_unpack(row["held"], "?"), _unpack(row["sizes"], "<i8"))


def _counts_of_counts(c: np.ndarray) -> list[int]:
    return np.bincount(c[(c > 0) & (c <= K + 1)], minlength=K + 2)[1:].tolist()


# --- words -----------------------------------------------------------------------------------------------------------

UNI = "bucket long, piece long, words binary, ids binary, counts binary, stats array<long>"


def _word_requests(rows: DataFrame, bits: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                own, tokens, train = _unpack(row["words"], "<u8"), _unpack(row["tokens"], "<i4"), _training(row)
                counts = np.bincount(tokens[train], minlength=len(own)).astype(np.int32)
                counts[np.searchsorted(own, START)] = int((~_unpack(row["held"], "?")).sum())
                at = _bounds(own, bits)
                for b in range(1 << bits):
                    if at[b + 1] > at[b]:
                        part = slice(at[b], at[b + 1])
                        yield _binary([(b, row["piece"], _pack(own[part]), _pack(counts[part]))], ["bucket", "piece", "words", "counts"], [pa.int64()] * 2 + [pa.binary()] * 2)

    return rows.select("piece", "held", "sizes", "words", "tokens").mapInArrow(run, "bucket long, piece long, words binary, counts binary")


def _word_counts(requests: DataFrame, bits: int) -> DataFrame:
    """Per bucket its words, numbers and counts (piece null, with statistics), and the numbers and counts each piece asked for."""
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64())]
    names = [c.split()[0] for c in UNI.split(", ")]

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        own = [_unpack(r["words"], "<u8") for r in rows]
        known = distinct(np.concatenate(own))
        total = np.zeros(len(known), np.int64)
        places = [np.searchsorted(known, w) for w in own]
        for p, r in zip(places, rows):
            total[p] += _unpack(r["counts"], "<i4")
        number = np.empty(len(known), np.int64)
        number[np.lexsort((known, -total))] = np.arange(len(known), dtype=np.int64) << bits | rows[0]["bucket"]
        if number.max() >> 32:
            raise OverflowError("more words than numbers of 32 bits")
        number = number.astype("<u4")
        real = np.where(known == START, 0, total)
        stats = [int(real.sum()), int((real > 0).sum()), *_counts_of_counts(real)]
        seen = total > 0
        out = [(rows[0]["bucket"], None, _pack(known[seen]), _pack(number[seen]), _pack(total[seen]), stats)]
        out += [(r["bucket"], r["piece"], None, _pack(number[p]), _pack(total[p]), None) for p, r in zip(places, rows)]
        return pa.Table.from_batches([_binary(out, names, kinds)])

    return requests.groupBy("bucket").applyInArrow(run, UNI)


# --- bigrams ---------------------------------------------------------------------------------------------------------

ASK = "bucket long, piece long, units binary, fan binary, second binary, counts binary, word_counts binary"
BI = "bucket long, piece long, units binary, fan binary, second binary, counts binary, seen binary, share binary, stats array<long>"


class Local:
    """A piece with its words in the order of their numbers, and its pairs in the order in which they are sent."""

    def __init__(self, row: dict, answers: list[dict], bits: int):
        answers = sorted(answers, key=lambda a: a["bucket"])
        own = _unpack(row["words"], "<u8")
        number = np.concatenate([_unpack(a["ids"], "<u4") for a in answers])
        order = np.argsort(number)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.number = number[order].astype(np.int64)
        self.counts = np.concatenate([_unpack(a["counts"], "<i8") for a in answers])[order]
        self.tokens = rank[_unpack(row["tokens"], "<i4")]
        self.sizes = _unpack(row["sizes"], "<i8")
        before = np.empty(len(self.tokens), np.int64)
        before[1:] = self.tokens[:-1]
        before[np.cumsum(self.sizes) - self.sizes] = rank[np.searchsorted(own, START)]
        self.pair = before << 32 | self.tokens
        self.train = _training(row)
        # Training has both words; other pairs cannot be in the model.
        self.can = (self.counts[before] > 0) & (self.counts[self.tokens] > 0)
        self.ask = distinct(self.pair[self.can])
        self._deal(bits)

    def _deal(self, bits: int) -> None:
        """Units are contexts, hot ones in several parts; all parts of a context are asked for."""
        context, word = self.ask >> 32, self.ask & 0xFFFFFFFF
        parts = -(-self.counts // HOT)
        of_word = mix(self.number[word].astype(np.uint64)).astype(np.int64) & 0x7FFFFFFF
        unit = context << 32 | of_word % np.maximum(parts[context], 1)
        hot = distinct(context[parts[context] > 1])
        each = parts[hot]
        all_parts = np.repeat(hot << 32, each) + np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
        units = distinct(np.concatenate([unit, all_parts]))
        key = self.number[units >> 32] << 32 | (units & 0xFFFFFFFF)
        bucket = (mix(key.astype(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(units), np.int64)
        order = np.lexsort((units, bucket))
        place = np.empty(len(units), np.int64)
        place[order] = np.arange(len(units))
        at = place[np.searchsorted(units, unit)]
        self.units, self.keys, self.buckets = units[order], key[order], bucket[order]
        self.order = np.argsort(at, kind="stable")  # of ``ask``, as sent
        self.fan = np.bincount(at, minlength=len(units))


def _with_answers(rows: DataFrame, answers: DataFrame, run, schema: str) -> DataFrame:
    """``run`` of each piece (a row) and the list of its answers. A task holds one piece at a time, and answers stay rows of their own."""

    def one(piece: pa.Table, own: pa.Table) -> pa.Table:
        return pa.Table.from_batches([run(piece.to_pylist()[0], own.to_pylist())])

    return rows.groupBy("piece").cogroup(answers.groupBy("piece")).applyInArrow(one, schema)


def _bigram_requests(rows: DataFrame, answers: DataFrame, bits: int) -> DataFrame:
    names, kinds = [c.split()[0] for c in ASK.split(", ")], [pa.int64()] * 2 + [pa.binary()] * 5

    def run(row: dict, own: list[dict]) -> pa.RecordBatch:
        x = Local(row, own, bits)
        amount = np.bincount(np.searchsorted(x.ask, x.pair[x.can & x.train]), minlength=len(x.ask)).astype(np.int32)[x.order]
        word = (x.ask & 0xFFFFFFFF)[x.order]
        entry = np.concatenate([[0], np.cumsum(x.fan)])
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(x.buckets)) + 1, [len(x.buckets)]]).tolist()
        out = []
        for i, j in zip(cuts, cuts[1:]):
            if j > i:
                u, e = slice(i, j), slice(entry[i], entry[j])
                out.append(
                    (
                        int(x.buckets[i]), row["piece"], _pack(x.keys[u]), _pack(x.fan[u].astype(np.int32)),
                        _pack(x.number[word[e]].astype("<u4")), _pack(amount[e]), _pack(x.counts[word[e]]),
                    )
                )
        return _binary(out, names, kinds)

    return _with_answers(rows.select("piece", "held", "sizes", "words", "tokens"), answers, run, ASK)


def _bigram_counts(requests: DataFrame, p_word) -> DataFrame:
    """Per bucket its bigrams and counts, and for each piece the counts of its pairs and what its units need.

    ``seen`` per unit: how many pairs have count 1..K, and the sum of counts beyond K; ``share``: the single-word
    probability of the words of all its pairs.
    """
    names, kinds = [c.split()[0] for c in BI.split(", ")], [pa.int64()] * 2 + [pa.binary()] * 6 + [pa.list_(pa.int64())]

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        keys = [_unpack(r["units"], "<i8") for r in rows]
        fan = [_unpack(r["fan"], "<i4") for r in rows]
        units = distinct(np.concatenate(keys))
        unit = np.concatenate([np.repeat(np.searchsorted(units, k), n) for k, n in zip(keys, fan)])
        pair = unit << 32 | np.concatenate([_unpack(r["second"], "<u4") for r in rows]).astype(np.int64)
        amount = np.concatenate([_unpack(r["counts"], "<i4") for r in rows])
        word_count = np.concatenate([_unpack(r["word_counts"], "<i8") for r in rows])
        order = np.argsort(pair)
        p = pair[order]
        new = np.ones(len(p), bool)
        new[1:] = p[1:] != p[:-1]
        head = np.flatnonzero(new)
        total = np.add.reduceat(amount[order].astype(np.int64), head) if len(head) else np.zeros(0, np.int64)
        answer = np.empty(len(order), np.int32)
        answer[order] = total[np.cumsum(new) - 1]
        of, kept = p[head] >> 32, total > 0  # pairs of held-out texts only are asked for, and not in the model
        n = len(units)
        seen = [np.bincount(of[total == r], minlength=n) for r in range(1, K + 1)]
        seen.append(np.bincount(of[total > K], weights=total[total > K], minlength=n).astype(np.int64))
        seen = np.stack(seen, axis=1).astype(np.int64)
        share = np.bincount(of[kept], weights=p_word(word_count[order][head][kept]), minlength=n)
        model_fan = np.bincount(of[kept], minlength=n)
        live = model_fan > 0
        second = (p[head][kept] & 0xFFFFFFFF).astype("<u4")
        out = [(rows[0]["bucket"], None, _pack(units[live]), _pack(model_fan[live].astype(np.int32)), _pack(second), _pack(total[kept]), _pack(seen[live]), _pack(share[live]), _counts_of_counts(total))]
        at = 0
        for r, k, f in zip(rows, keys, fan):
            size, place = int(f.sum()), np.searchsorted(units, k)
            out.append((r["bucket"], r["piece"], None, None, None, _pack(answer[at : at + size]), _pack(seen[place]), _pack(share[place]), None))
            at += size
        return pa.Table.from_batches([_binary(out, names, kinds)])

    return requests.groupBy("bucket").applyInArrow(run, BI)


# --- the model -------------------------------------------------------------------------------------------------------


def discounts(n: list[int]) -> np.ndarray:
    """Good-Turing discounts by count (0 to K, then 1), from the numbers of things counted 1, 2, ... K+1 times.

    Where those numbers are too uneven for the formula to lie between 0 and 1, (r - 1/2) / r stands in.
    """
    d = np.ones(K + 2)
    for r in range(1, K + 1):
        d[r] = (r - 0.5) / r
        if n[0] > 0 and n[r - 1] > 0:
            common = (K + 1) * n[K] / n[0]
            if common < 1:
                x = ((r + 1) * n[r] / n[r - 1] / r - common) / (1 - common)
                if 0 < x < 1:
                    d[r] = x
    d[0] = 0.0
    return d


class Words:
    """Single-word probabilities, by training count."""

    def __init__(self, total: int, counts_of_counts: list[int]):
        self.total, self.d = total, discounts(counts_of_counts)
        freed = sum((1 - self.d[r]) * r * counts_of_counts[r - 1] for r in range(1, K + 1))
        self.scale = 1.0 if freed > 1e-9 * max(total, 1) else total / (total + 1)
        self.unknown = 1 - self.scale * (total - freed) / total if total else 1.0

    def __call__(self, count: np.ndarray) -> np.ndarray:
        known = self.scale * self.d[np.minimum(count, K + 1)] * count / max(self.total, 1)
        return np.where(count > 0, known, self.unknown)


def backoff(context_count: np.ndarray, seen: np.ndarray, share: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per context: the factor on discounted relative frequencies, and alpha."""
    r = np.arange(1, K + 1)
    kept = (seen[:, :-1] * (d[r] * r)).sum(1) + seen[:, -1]
    count = np.maximum(context_count, 1)
    scale = np.where(count - kept > 1e-9 * count, 1.0, count / (count + 1))
    return scale, np.where(context_count > 0, (1 - scale * kept / count) / (1 - share), 1.0)


SCORES = "id long, held boolean, n_tokens long, n_known long, base_score double, score double"


def _scores(rows: DataFrame, answers: DataFrame, bits: int, p_word: Words, n_types: int, d: np.ndarray) -> DataFrame:
    """``answers``: of words, and of pairs (column ``seen`` not null)."""

    def run(row: dict, own: list[dict]) -> pa.RecordBatch:
        x = Local(row, [a for a in own if a["seen"] is None], bits)
        begins = np.cumsum(x.sizes) - x.sizes
        log_p = np.log10(p_word(x.counts))[x.tokens]
        # Contexts without pairs in the model give all their mass to single words: alpha is 1.
        of_pairs = sorted((a for a in own if a["seen"] is not None), key=lambda a: a["bucket"])
        if of_pairs:
            n = np.empty(len(x.ask), np.int64)
            n[x.order] = np.concatenate([_unpack(a["counts"], "<i4") for a in of_pairs])
            context = x.units >> 32
            heads = distinct(context)
            at = np.searchsorted(heads, context)
            seen, share = np.zeros((len(heads), K + 1), np.int64), np.zeros(len(heads))
            np.add.at(seen, at, np.concatenate([_unpack(a["seen"], "<i8").reshape(-1, K + 1) for a in of_pairs]))
            np.add.at(share, at, np.concatenate([_unpack(a["share"], "<f8") for a in of_pairs]))
            alpha, factor = np.ones(len(x.number)), np.ones(len(x.number))
            factor[heads], alpha[heads] = backoff(x.counts[heads], seen, share, d)
            # Logarithms of pairs and contexts are taken once each, then dealt to the tokens.
            known = n > 0
            before, n = (x.ask >> 32)[known], n[known]
            log_pair = np.zeros(len(x.ask))
            log_pair[known] = np.log10(factor[before] * d[np.minimum(n, K + 1)] * n / x.counts[before])
            place = np.minimum(np.searchsorted(x.ask, x.pair), len(x.ask) - 1)
            use = x.can & known[place]
            log_p += np.log10(np.maximum(alpha, 1e-300))[x.pair >> 32]
            log_p[use] = log_pair[place[use]]
        base = np.log10((x.counts + 1) / (p_word.total + n_types + 1))[x.tokens]
        add = lambda v: np.add.reduceat(v, begins)
        ids = pa.array(_unpack(row["ids"], "<i8"), mask=_unpack(row["no_id"], "?"))
        return pa.RecordBatch.from_arrays(
            [ids, pa.array(_unpack(row["held"], "?")), pa.array(x.sizes), pa.array(add((x.counts > 0)[x.tokens].astype(np.int64))), pa.array(add(base)), pa.array(add(log_p))],
            [v.split()[0] for v in SCORES.split(", ")],
        )

    return _with_answers(rows.drop("n_words"), answers, run, SCORES)


def _bits(entries: int) -> int:
    return max(0, (max(entries, 1) // BUCKET_ENTRIES).bit_length())


def _by_number(rows: DataFrame) -> tuple[DataFrame, str, str]:
    """Pieces as a table bucketed by their number: answers are shuffled to the pieces, not pieces to the answers."""
    spark = rows.sparkSession
    path, name = new_scratch_path(spark, "op6-pieces"), f"op6_pieces_{uuid.uuid4().hex}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows.write.bucketBy(n, "piece").option("path", path).option("compression", "zstd").saveAsTable(name)
    return spark.table(name), name, path


def scored(docs: DataFrame, held: Column) -> tuple[DataFrame, int, DataFrame, DataFrame]:
    """Scores per row of ``docs`` (id, text), the number of training tokens, and the model's two tables."""
    spark = docs.sparkSession
    rows, name, path = _by_number(pieces(docs.select(F.col("id").cast("long").alias("id"), "text", F.coalesce(held, F.lit(False)).alias("held"))))
    try:
        entries = rows.agg(F.sum("n_words")).first()[0] or 0
        bits = _bits(entries)
        uni = staged(_word_counts(_word_requests(rows, bits), bits), "op6-words", keep=True)
        sums = uni.filter("piece is null").agg(*(F.sum(F.col("stats")[i]) for i in range(K + 3))).first()
        total, n_types, *of_counts = (int(x or 0) for x in sums)
        p_word = Words(total, of_counts)

        answers = uni.filter("piece is not null").select("piece", "bucket", "ids", "counts")
        # About six pairs are sent for each distinct word of a piece.
        bits = _bits(6 * entries)
        bi = staged(_bigram_counts(_bigram_requests(rows, answers, bits), p_word), "op6-bigrams", keep=True)
        sums = bi.filter("piece is null").agg(*(F.sum(F.col("stats")[i]) for i in range(K + 1))).first()
        d = discounts([int(x or 0) for x in sums])

        pair_answers = bi.filter("piece is not null").select("piece", "bucket", "counts", "seen", "share")
        answers = answers.unionByName(pair_answers, allowMissingColumns=True)
        # Written, so that the pieces can go.
        scores = staged(_scores(rows, answers, bits, p_word, n_types, d), "op6-scores", keep=True)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        remove_path(spark, path)
    return scores, total, uni.filter("piece is null"), bi.filter("piece is null")
