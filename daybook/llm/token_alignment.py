"""Alignment of two tokenizers' tokens over the same bytes, with corpus-wide counts of linked ids.

Method. A text is encoded by tokenizer A (byte-level BPE, tokenizers library) and B (byte-fallback BPE, sentencepiece).
A's character offsets and the spans of B's proto are coarse cuts: places where both say that a token ends and the next
one begins. Between two cuts the places are refined where spans cannot tell: tokens that hold a part of a multibyte
character, and byte-fallback tokens, are placed by the bytes that they decode to. Places where A and B tokens both end
cut the text into groups; A and B tokens whose bytes overlap are linked.

Both tokenizers split at a space behind a character that is no white space: A's pattern takes a space only in front of a
word, and no piece of B has its space mark behind another character (checked when B is loaded; texts stay whole if one
has). So a text is aligned piece by piece, each different piece once per block of texts, which gives the ids of the whole.

Corpus-wide, an id pair's count is the number of rows that hold it linked. Blocks of about 4 MB of text are written with
their links; each sends its distinct pairs once, which are added up, and gets their counts back. A worker cuts a portion of a
block into pieces at a time, and gives back after each block what it has freed.

``aligned`` takes columns ``id`` and ``text``; others are not read. Strings of special tokens are plain text. Null text,
empty text, and text whose tokens do not decode to a space and the text (U+2581 in it) have no tokens: zeros, and an
empty digest. Long texts make a block of their own. Rows that repeat an id or a text are rows of their own, and count so.
Ties for an id's highest count all are best. A null id stays null. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from daybook.llm.bpe import Vocabulary
from daybook.llm.common import freed, give_back, passing, staged
from daybook.llm.textvec import distinct, slices

BLOCK_BYTES = 4 << 20
PORTION = 512 << 10  # characters of a block that are in pieces at a time
CACHED = 200_000  # pieces whose alignment a task keeps between blocks
ENCODED = 10_000  # pieces encoded together
JOINED = 1_000  # pieces that make one text for the tokenizers
# A space, what follows up to the next space behind a character that is no white space, and white space at the end.
PIECE = regex.compile(r" \s*\S(?:[^ ]|(?<=\s) )*(?: \s*\Z)?")
ODD_SPACE = regex.compile(r"\s ")
SPACE_MARK = "▁"


class Pair:
    """Both tokenizers, loaded from the contents of their files, and the pieces of text aligned so far.

    Per piece: ``counts`` (A tokens, B tokens, groups), ``fits``, the number ``size`` of its linked pairs in ``pairs``,
    ``groups``, its part of the text's listing, and ``uses``, how often it was met.
    """

    def __init__(self, spec: str, model: bytes, tokens: dict[int, bytes]):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_str(spec)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.whole, b_bytes = False, []
        for i in range(self.b.get_piece_size()):
            name = self.b.id_to_piece(i)
            b_bytes.append(bytes([int(name[1:-1], 16)]) if self.b.is_byte(i) else name.replace(SPACE_MARK, " ").encode())
            self.whole |= not self.b.is_byte(i) and SPACE_MARK in name.lstrip(SPACE_MARK)
        self.of_a, self.of_b = Side([tokens.get(i, b"") for i in range(max(tokens) + 1)], "|"), Side(b_bytes, ";")
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.groups: list[str] = []
        self.added: list[tuple[np.ndarray, ...]] = []  # by pieces encoded together, until all are
        self.fits, self.size, self.uses = np.zeros(0, bool), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.counts, self.pairs = np.zeros((0, 3), np.int64), np.zeros(0, np.int64)

    def thin_out(self) -> None:
        """Keep the pieces that were met more than once since the last time; all go if those are too many."""
        stay = self.uses > 1
        if stay.sum() > CACHED // 2:
            self.forget()
            return
        place = np.cumsum(stay) - 1
        keep = stay.tolist()
        self.known = {p: int(place[i]) for p, i in self.known.items() if keep[i]}
        self.groups = [g for g, k in zip(self.groups, keep) if k]
        self.pairs = self.pairs[np.repeat(stay, self.size)]
        self.fits, self.size, self.counts, self.uses = self.fits[stay], self.size[stay], self.counts[stay], np.zeros(int(stay.sum()), np.int64)

    def pieces(self, text: str) -> list[str]:
        """A space and the text, cut where both tokenizers split; the space that begins each piece is left out."""
        if self.whole:
            return [text]
        if ODD_SPACE.search(" " + text) or text[-1].isspace():
            return [p[1:] for p in PIECE.findall(" " + text)] or [text]
        return text.split(" ")

    def align(self, pieces: list[str]) -> None:
        """Add the alignments of ``pieces`` to what is known.

        Pieces that end in a character and hold no space mark follow each other as in a text, many to one call; the others
        make a call each.
        """
        alone = [not p or p[-1].isspace() or SPACE_MARK in p for p in pieces]
        together = [p for p, x in zip(pieces, alone) if not x]
        if self.whole:
            together, alone = [], [True] * len(pieces)
        for at in range(0, len(together), ENCODED):
            part = together[at : at + ENCODED]
            self._encode(part, [part[i : i + JOINED] for i in range(0, len(part), JOINED)])
        rest = [p for p, x in zip(pieces, alone) if x]
        for at in range(0, len(rest), ENCODED):
            part = rest[at : at + ENCODED]
            self._encode(part, [[p] for p in part])
        if self.added:
            self.fits, self.size, self.counts, self.pairs = (np.concatenate(x) for x in zip((self.fits, self.size, self.counts, self.pairs), *self.added))
            self.uses = np.concatenate([self.uses, np.zeros(len(self.size) - len(self.uses), np.int64)])
            self.added.clear()

    def _encode(self, pieces: list[str], texts: list[list[str]]) -> None:
        """Align ``pieces``, which follow each other in ``texts``."""
        joined = [" ".join(t) for t in texts]
        left = self.a.encode_batch([" " + t for t in joined], add_special_tokens=False)
        right = self.b.encode(joined, return_type="proto", num_threads=1)
        data = [(" " + t).encode() for t in joined]
        size = np.array([len(d) for d in data], np.int64)
        begin = np.cumsum(size) - size
        raw = b"".join(data)
        starts = np.concatenate([[0], np.cumsum([len(p) if p.isascii() else len(p.encode()) for p in pieces]) + np.arange(1, len(pieces) + 1)])

        # Spans in bytes: A counts characters, B bytes behind the space that it puts in front itself.
        ids = np.array(list(chain.from_iterable([x.ids for x in left])), np.int64)
        number = np.array([len(x) for x in left], np.int64)
        spans = np.array(list(chain.from_iterable([x.offsets for x in left])), np.int64).reshape(-1, 2)
        characters = np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)
        spans += np.repeat(np.searchsorted(characters, begin), number)[:, None]
        a = Tokens(self.of_a, ids, np.append(characters, len(raw))[spans], starts)
        flat = np.array([(t.id, t.begin, t.end) for p in right for t in p.pieces], np.int64).reshape(-1, 3)
        number = np.array([len(p.pieces) for p in right], np.int64)
        spans = flat[:, 1:] + 1
        spans[(np.cumsum(number) - number)[number > 0], 0] = 0
        b = Tokens(self.of_b, flat[:, 0], spans + np.repeat(begin, number)[:, None], starts)
        cuts = _both(a.clean, b.clean)
        fits = a.placed(raw, cuts) & b.placed(raw, cuts)
        a.keep(fits)
        b.keep(fits)
        self.known.update(zip(pieces, range(len(self.groups), len(self.groups) + len(pieces))))

        # Links: of each A token, the B tokens from the one that ends behind its start to the one that reaches its end.
        first = np.searchsorted(b.ends, a.ends - a.sizes, "right")
        last = np.searchsorted(b.ends, a.ends, "left")
        number = last - first + 1
        take = np.repeat(np.arange(len(a.ids)), number)
        to = np.arange(len(take)) - np.repeat(np.cumsum(number) - number, number) + first[take]
        pairs = a.ids[take] << 32 | b.ids[to]
        # Groups end where A and B tokens both end; a group lists its A tokens, then its B tokens.
        common = _both(a.ends, b.ends)
        group_a, group_b = np.searchsorted(common, a.ends), np.searchsorted(common, b.ends)
        texts = np.concatenate([a.listed(group_a), b.listed(group_b)])
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        texts = texts[order].tolist()
        n = len(pieces)
        n_a, n_b = np.bincount(a.piece, minlength=n), np.bincount(b.piece, minlength=n)
        of = np.searchsorted(starts, common, "left") - 1
        n_groups = np.bincount(of, minlength=n)
        at = 0
        for size in (n_a + n_b).tolist():
            self.groups.append("".join(texts[at : at + size])[:-1])
            at += size
        self.added.append((fits, np.bincount(a.piece[take], minlength=n), np.stack([n_a, n_b, n_groups], axis=1), pairs))


def _both(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """What is in both of two ascending arrays."""
    return x[y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x] if len(x) and len(y) else x[:0]


def _numbered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in ascending order, and the place of each value among them."""
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    new = np.ones(len(values), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    place = np.empty(len(values), np.int64)
    place[order] = np.cumsum(new) - 1
    return ordered[new], place


class Side:
    """A tokenizer's tokens: their bytes, and how they are listed within a group and at its end."""

    def __init__(self, decoded: list[bytes], end: str):
        self.decoded = decoded
        self.size = np.array([len(d) for d in decoded], np.int64)
        self.inside = np.array([f"{i}," for i in range(len(decoded))], object)
        self.last = np.array([f"{i}{end}" for i in range(len(decoded))], object)


class Tokens:
    """The tokens of many pieces laid one behind the other, with their spans in bytes."""

    def __init__(self, side: Side, ids: np.ndarray, spans: np.ndarray, starts: np.ndarray):
        self.side, self.starts, self.ids = side, starts, ids
        self.begin, self.end = spans[:, 0], spans[:, 1]
        self.piece = np.searchsorted(starts, self.begin, "right") - 1
        self.sizes = side.size[self.ids]
        # A coarse cut: a token ends, no later one begins before, and the next piece begins there at the latest.
        later = np.minimum.accumulate(np.append(self.begin, starts[-1])[::-1])[::-1][1:]
        self.clean = distinct(np.concatenate([self.end[(later >= self.end) & (self.end > self.begin)], starts[1:]]))

    def placed(self, raw: bytes, cuts: np.ndarray) -> np.ndarray:
        """Place each token by its span where that has the size of its bytes, else by its bytes from the last cut on; per
        piece, whether its tokens fill it and have its bytes."""
        n = len(self.starts) - 1
        piece_end = self.starts[1:]
        run = np.cumsum(self.sizes)
        head = np.searchsorted(self.piece, np.arange(n))
        before = np.concatenate([[0], run])[head]
        by_bytes = run - before[self.piece] + self.starts[self.piece]
        # From the last cut before the token: bytes of the tokens since then. In a piece that fits both ways agree.
        cut = cuts[np.maximum(np.searchsorted(cuts, self.begin, "right") - 1, 0)] if len(cuts) else self.starts[self.piece]
        plain = (self.end - self.begin == self.sizes) & (by_bytes == self.end)
        wrong = ~plain & ((by_bytes > piece_end[self.piece]) | (by_bytes - self.sizes < np.minimum(cut, self.begin)))
        self.ends = np.where(plain, self.end, by_bytes)
        fits = np.ones(n, bool)
        fits[self.piece[wrong]] = False
        filled = np.bincount(self.piece, self.sizes, n).astype(np.int64) == np.diff(self.starts)
        fits &= filled
        joined = b"".join([self.side.decoded[i] for i in self.ids.tolist()])
        if joined != raw:
            # Some pieces are not what their tokens say.
            end = np.cumsum(np.bincount(self.piece, self.sizes, n).astype(np.int64)).tolist()
            for i, (x, y) in enumerate(zip([0, *end], end)):
                fits[i] &= joined[x:y] == raw[self.starts[i] : self.starts[i + 1]]
        return fits

    def keep(self, fits: np.ndarray) -> None:
        own = fits[self.piece]
        self.ids, self.piece, self.sizes, self.ends = self.ids[own], self.piece[own], self.sizes[own], self.ends[own]

    def listed(self, group: np.ndarray) -> np.ndarray:
        last = np.append(group[1:] != group[:-1], True) if len(group) else np.zeros(0, bool)
        return np.where(last, self.side.last[self.ids], self.side.inside[self.ids])


def _portions(texts: list[str | None]) -> Iterator[list[str | None]]:
    """Texts in order, of about ``PORTION`` characters together; a longer text is a portion of its own."""
    part, size = [], 0
    for text in texts:
        if part and size + len(text or "") > PORTION:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text or "")
    if part:
        yield part


def _block(pair: Pair, texts: list[str | None]):
    """Alignment of many texts: numbers per text, distinct pairs, and each text's pairs as places among these."""
    if len(pair.known) > CACHED:
        pair.thin_out()
    known, groups, held = pair.known, pair.groups, []
    for part in _portions(texts):
        split = [pair.pieces(t) if t else None for t in part]
        pair.align(sorted(set().union(*[p for p in split if p]).difference(known)))
        held += [np.array([known[p] for p in pieces], np.int32) if pieces else None for pieces in split]
    fits, size, counts = pair.fits, pair.size, pair.counts
    # The block's own pieces, and their pairs, numbered anew.
    met = np.concatenate([h for h in held if h is not None] or [np.zeros(0, np.int32)])
    pair.uses += np.bincount(met, minlength=len(pair.uses))
    own = distinct(met)
    begin = np.cumsum(size) - size
    take = np.arange(size[own].sum()) - np.repeat(np.cumsum(size[own]) - size[own], size[own]) + np.repeat(begin[own], size[own])
    pairs, place = _numbered(pair.pairs[take])
    own_begin = np.zeros(len(size), np.int64)
    own_begin[own] = np.cumsum(size[own]) - size[own]
    sums, digests, at, times, ends = np.zeros((len(texts), 4), np.int64), [], [], [], []
    for n, pieces in enumerate(held):
        digest = ""
        if pieces is not None and fits[pieces].all():
            piece, of_piece = _numbered(pieces)
            often = np.bincount(of_piece)
            of = size[piece]
            take = np.arange(of.sum()) - np.repeat(np.cumsum(of) - of, of) + np.repeat(own_begin[piece], of)
            linked, back = _numbered(place[take])
            at.append(linked.astype(np.int32))
            times.append(np.bincount(back, np.repeat(often, of)).astype(np.int32))
            sums[n, :3] = counts[piece].T @ often
            sums[n, 3] = of @ often
            digest = hashlib.sha256(";".join([groups[i] for i in pieces.tolist()]).encode()).hexdigest()
        digests.append(digest)
        ends.append(len(at[-1]) if digest else 0)
    at = np.concatenate(at) if at else np.zeros(0, np.int32)
    times = np.concatenate(times) if times else np.zeros(0, np.int32)
    rows = np.bincount(at, minlength=len(pairs)).astype(np.int64)
    used = rows > 0
    at = (np.cumsum(used) - 1)[at].astype(np.int32)
    return sums, digests, pairs[used], rows[used], np.cumsum(ends), at, times


NUMBERS = ("sums", "pairs", "rows", "ends", "at", "times")


def _blocks(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row per block of texts, its arrays as bytes."""
    with open(path_a, encoding="utf-8") as f:
        spec = f.read()
    with open(path_b, "rb") as f:
        model = f.read()
    # Both files are vocabularies: a few MB, whatever the corpus.
    files = docs.sparkSession.sparkContext.broadcast((spec, model, Vocabulary(path_a).tokens))
    id_type = docs.schema["id"].dataType.simpleString()

    def run(batches):
        pair, made = Pair(*files.value), TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in slices(batch, "text", BLOCK_BYTES):
                sums, digests, pairs, rows, ends, at, times = _block(pair, part.column("text").to_pylist())
                ids = part.column("id")
                whole = pa.array([0, len(ids)], pa.int32())
                arrays = (sums, pairs, rows, ends, at, times)
                columns = [
                    pa.array([made]),
                    pa.ListArray.from_arrays(whole, ids),
                    pa.array([digests], pa.list_(pa.string())),
                    *(pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in arrays),
                ]
                made += 1
                yield pa.RecordBatch.from_arrays(columns, ["block", "ids", "digests", *NUMBERS])
                give_back()

    schema = f"block long, ids array<{id_type}>, digests array<string>, " + ", ".join(f"{n} binary" for n in NUMBERS)
    return staged(docs.select("id", "text").mapInArrow(freed(run), schema), "op12-blocks", keep=True)


def _requests(blocks: DataFrame) -> DataFrame:
    """(block, pair, n): each block's distinct pairs, and how many of its rows hold each."""

    def run(batches):
        for batch in batches:
            for block, pairs, rows in zip(*(batch.column(i).to_pylist() for i in range(3))):
                pairs = np.frombuffer(pairs, np.int64)
                columns = [pa.array(np.full(len(pairs), block, np.int64)), pa.array(pairs), pa.array(np.frombuffer(rows, np.int64))]
                yield pa.RecordBatch.from_arrays(columns, ["block", "pair", "n"])

    return blocks.select("block", "pairs", "rows").mapInArrow(run, "block long, pair long, n long")


def pair_counts(requests: DataFrame) -> DataFrame:
    """(pair, count, best): in how many rows a pair is linked, and whether no pair of its A id is in more."""
    counts = requests.groupBy("pair").agg(F.sum("n").alias("count"))
    # An A id has at most as many rows here as B has ids.
    highest = F.max("count").over(W.partitionBy(F.shiftright("pair", 32)))
    return counts.select("pair", "count", (F.col("count") == highest).alias("best"))


def aligned(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for columns ``id`` and ``text``."""
    id_type = docs.schema["id"].dataType.simpleString()
    blocks = _blocks(docs, path_a, path_b)
    with passing(docs.sparkSession):
        requests = _requests(blocks)
        # By shuffle: their files look small, but the counts grow with the corpus, and each executor would hold them all.
        counts = staged(pair_counts(requests), "op12-counts").hint("merge")
        answers = requests.join(counts, "pair").select("block", "pair", "count", "best")
        answers = staged(answers.hint("rebalance", "block"), "op12-answers", keep=True)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        pair = right.column("pair").to_numpy()
        order = np.argsort(pair)
        count, best = right.column("count").to_numpy()[order], right.column("best").to_numpy(zero_copy_only=False)[order]
        out = []
        for row in range(left.num_rows):
            # Of one block: (rows, 4) sums, and each row's links as places among the block's pairs.
            data = {n: left.column(n)[row].as_py() for n in NUMBERS}
            sums, ends = np.frombuffer(data["sums"], np.int64).reshape(-1, 4), np.frombuffer(data["ends"], np.int64)
            at, times = np.frombuffer(data["at"], np.int32), np.frombuffer(data["times"], np.int32)
            bounds = np.concatenate([[0], ends])

            def total(values):
                running = np.concatenate([[0], np.cumsum(values)])
                return running[bounds[1:]] - running[bounds[:-1]]

            ids = left.column("ids").slice(row, 1).combine_chunks().flatten()
            columns = [ids, *(pa.array(sums[:, i]) for i in range(4)), pa.array(total(best[at] * times)), pa.array(total(count[at] * times))]
            digests = left.column("digests").slice(row, 1).combine_chunks().flatten()
            out.append(pa.table([*columns, digests], ["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]))
        return pa.concat_tables(out)

    schema = f"id {id_type}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, schema)
