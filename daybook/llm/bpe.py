"""Byte-level BPE encoding and decoding with a lexicon of frequent words.

Method. Spark counts the words of all texts; the most frequent ones are encoded once and compiled into a minimal
acyclic automaton that shares prefixes and suffixes. Its arcs carry numbers whose sum along a word is the word's place
in a table of id sequences (a transducer from bytes to ids). The file goes to every executor and is memory-mapped
there. Words of a text that the automaton does not hold are merged exactly, pair by pair, in the vocabulary's order.
The lexicon only saves work: ids are the same with any lexicon. Its size is the parameter ``lexicon_words``.

Ids equal those of the tokenizer file's own library without added special tokens; the strings of special tokens in a
text become their ids, as there. Null text counts as empty: no ids. Rows keep their number; ids of rows are not read, so
they may repeat or be null. Long texts are encoded as others. Other columns pass through, but for those with a name that
the result uses. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import struct
import tempfile
import uuid
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm.common import freed, passing, staged
from daybook.llm.textvec import slices

# Fixed value: how byte-level BPE splits text before merging (\s written out as the property that it stands for).
SPLIT = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
CACHED_WORDS = 400_000
LONG_WORD = 200  # bytes from which a word is merged by a heap instead of with others
NONE = 1 << 60


def _byte_characters() -> dict[str, int]:
    """The printable stand-ins of byte-level BPE: visible Latin-1 bytes stand for themselves, others follow from 256."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Tokens and merges of a tokenizer file (JSON, byte-level BPE)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        stands = _byte_characters()
        ids = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: bytes(stands[c] for c in t) for t, i in ids.items() if all(c in stands for c in t)}
        self.tokens |= {i: t.encode() for t, i in self.special.items()}
        self.of_byte = [0] * 256
        for i, t in self.tokens.items():
            if len(t) == 1:
                self.of_byte[t[0]] = i
        self.merges, self.made = {}, []  # rank of a pair (two ids in one number), id that a rank makes
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[ids[a] << 32 | ids[b]] = rank
            self.made.append(ids[a + b])
        self.special_split = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None

        order = np.array(sorted(self.merges), np.int64)
        self.pairs, self.ranks = order, np.array([self.merges[k] for k in order.tolist()], np.int64)
        self.made_ids, self.byte_ids = np.array(self.made, np.int64), np.array(self.of_byte, np.int64)

    def merged(self, word: bytes) -> list[int]:
        """Ids of one word: the pair of the lowest rank merges first, the leftmost of equals. Time n log n."""
        ids = [self.of_byte[b] for b in word]
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := self.merges.get(ids[i] << 32 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue  # one of the two has merged meanwhile
            ids[i], ids[j] = self.made[rank], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
            for x, y in ((before[i], i), (i, k)):
                if x >= 0 and y < n and (r := self.merges.get(ids[x] << 32 | ids[y])) is not None:
                    heapq.heappush(heap, (r, x, ids[x], ids[y]))
        return [i for i in ids if i >= 0]

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        want = a << 32 | b
        at = np.minimum(np.searchsorted(self.pairs, want), len(self.pairs) - 1)
        return np.where(self.pairs[at] == want, self.ranks[at], NONE)

    def merged_all(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of many words; in each step every word that still can makes its next merge."""
        out: list = [self.merged(w) if len(w) >= LONG_WORD or not len(self.pairs) else None for w in words]
        todo = [i for i, w in enumerate(words) if out[i] is None]
        lengths = np.array([len(words[i]) for i in todo], np.int64)
        ids = self.byte_ids[np.frombuffer(b"".join(words[i] for i in todo), np.uint8)]
        word = np.repeat(np.array(todo, np.int64), lengths)
        rank = np.full(len(ids), NONE)
        inside = np.flatnonzero(word[1:] == word[:-1])
        rank[inside] = self._rank(ids[inside], ids[inside + 1])
        while len(ids):
            begin = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            size = np.diff(begin, append=len(ids))
            best = np.minimum.reduceat(rank, begin)
            over = best == NONE
            if over.any():
                done = np.repeat(over, size)
                for w, x in zip(word[begin[over]].tolist(), np.split(ids[done], np.cumsum(size[over])[:-1])):
                    out[w] = x
                ids, word, rank, best, size = ids[~done], word[~done], rank[~done], best[~over], size[~over]
                if not len(ids):
                    break
            hit = np.flatnonzero(rank == np.repeat(best, size))
            at = hit[np.concatenate(([True], word[hit[1:]] != word[hit[:-1]]))]
            ids[at] = self.made_ids[best]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            place = np.cumsum(keep) - 1
            ids, word, rank = ids[keep], word[keep], rank[keep]
            at = place[at]
            rank[at] = NONE
            right = at[(at + 1 < len(ids)) & (word[np.minimum(at + 1, len(ids) - 1)] == word[at])]
            rank[right] = self._rank(ids[right], ids[right + 1])
            left = at[(at > 0) & (word[at - 1] == word[at])]
            rank[left - 1] = self._rank(ids[left - 1], ids[left])
        return out


# --- the lexicon -----------------------------------------------------------------------------------------------------


def compile_lexicon(words: Iterable[bytes], ids_of, path: str) -> int:
    """Write the automaton of the words and their ids; the number of its states.

    States are made from the longest words' ends up and shared when they accept the same rest (words come in order, so
    only the last path is open). Then an arc's number is how many words its state accepts by earlier arcs.
    """
    words = sorted(set(words))
    register: dict[tuple, int] = {}
    states: list[tuple[bool, tuple[tuple[int, int], ...]]] = []

    def close(node: list) -> int:
        key = (node[0], tuple(node[1]))
        if key not in register:
            register[key] = len(states)
            states.append(key)
        return register[key]

    path_nodes: list[list] = [[False, []]]
    last = b""
    for word in [*words, None]:
        keep = 0 if word is None else len(os.path.commonprefix([word, last]))
        while len(path_nodes) > keep + 1:
            node = path_nodes.pop()
            path_nodes[-1][1].append((last[len(path_nodes) - 1], close(node)))
        if word is not None:
            path_nodes += [[False, []] for _ in word[keep:]]
            path_nodes[-1][0] = True
            last = word
    root = close(path_nodes[0])
    accepts, keys, targets, numbers = [0] * len(states), [], [], []
    for s, (final, arcs) in enumerate(states):  # a state's targets come before it
        total = int(final)
        for byte, target in arcs:
            keys.append(s << 8 | byte)
            targets.append(target)
            numbers.append(total)
            total += accepts[target]
        accepts[s] = total
    sequences = [ids_of(w) for w in words]
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in sequences], dtype=np.int64)))
    ids = np.array([i for x in sequences for i in x], np.int64)
    finals = np.array([f for f, _ in states], np.int64)
    parts = [np.array(x, np.int64) for x in (keys, targets, numbers)] + [finals, offsets, ids]
    with open(path, "wb") as f:
        f.write(struct.pack("<7q", root, *map(len, parts)))
        for part in parts:
            f.write(part.astype("<i8").tobytes())
    return len(states)


class Lexicon:
    """A compiled lexicon, memory-mapped; looks up many words together, one byte of each at a time."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.root, *sizes = struct.unpack("<7q", f.read(56))
        data = np.memmap(path, "<i8", "r", 56, (sum(sizes),)) if sum(sizes) else np.zeros(0, np.int64)
        self.keys, self.targets, self.numbers, self.finals, self.offsets, self.ids = np.split(data, np.cumsum(sizes)[:-1])

    def find(self, words: list[bytes]) -> np.ndarray:
        """The place of each word, -1 if the lexicon does not hold it."""
        if not len(self.keys) or not words:
            return np.full(len(words), -1)
        lengths = np.array([len(w) for w in words])
        begins = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        data = np.frombuffer(b"".join(words), np.uint8)
        state, number = np.full(len(words), self.root), np.zeros(len(words), np.int64)
        live, depth = np.flatnonzero(lengths > 0), 0
        dead = lengths == 0
        while len(live):
            want = (state[live] << 8) | data[begins[live] + depth]
            at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
            ok = self.keys[at] == want
            dead[live[~ok]] = True
            live, at = live[ok], at[ok]
            state[live] = self.targets[at]
            number[live] += self.numbers[at]
            depth += 1
            live = live[lengths[live] > depth]
        return np.where(~dead & (self.finals[state] == 1), number, -1)


def frequent_words(text: Column, docs: DataFrame, n: int) -> list[str]:
    """The most frequent runs of letters over all texts, at most ``n``: a top-k report of bounded size.

    Words fall into classes by the logarithm of their count; the driver sees the number of words per class, then the
    words of as many of the highest classes as have no more than ``n`` together.
    """
    words = docs.select(F.explode(F.split(F.coalesce(text, F.lit("")), r"[^\p{L}]+")).alias("word"))
    counts = words.filter("word <> ''").groupBy("word").count().filter("count > 1")
    with passing(docs.sparkSession):
        counts = staged(counts.select("word", F.floor(64 * F.log2("count")).cast("int").alias("class")), "op5-words")
        classes = sorted(((r["class"], r["count"]) for r in counts.groupBy("class").count().collect()), reverse=True)
        total, lowest = 0, None
        for number, size in classes:
            if total + size > n:
                break
            total, lowest = total + size, number
        if lowest is None:
            return []
        return sorted(r["word"] for r in counts.filter(F.col("class") >= lowest).select("word").collect())


def ship_lexicon(spark: SparkSession, words: list[str], vocabulary_path: str) -> tuple[str, str]:
    """Compile on the driver; the names under which executors find the lexicon and the vocabulary."""
    vocabulary = Vocabulary(vocabulary_path)
    tag = uuid.uuid4().hex
    folder = tempfile.mkdtemp(prefix="lexicon-")
    lexicon, copy = os.path.join(folder, f"lexicon-{tag}.bin"), os.path.join(folder, f"vocabulary-{tag}.json")
    # Words longer than this are rarely frequent; they are merged like unseen ones.
    compile_lexicon([(" " + w).encode() for w in words if len(w) <= 64], vocabulary.merged, lexicon)
    with open(vocabulary_path, "rb") as source, open(copy, "wb") as target:
        target.write(source.read())
    for path in (lexicon, copy):
        spark.sparkContext.addFile(path)
    return os.path.basename(lexicon), os.path.basename(copy)


# --- texts -----------------------------------------------------------------------------------------------------------


class Encoder:
    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon):
        self.vocabulary, self.lexicon = vocabulary, lexicon
        self.split = regex.compile(SPLIT).findall
        # Ids of what stands between single spaces, with the space before it; None where a text can't be cut so.
        self.known: dict[str, bytes | None] = {}

    def _learn(self, missing: list[str]) -> None:
        tied = [not p or p[0].isspace() or p[-1].isspace() for p in missing]
        self.known.update((p, None) for p, t in zip(missing, tied) if t)
        missing = [p for p, t in zip(missing, tied) if not t]
        for p, ids in zip(missing, self._whole([" " + p for p in missing])):
            self.known[p] = ids

    def _whole(self, texts: list[str]) -> list[bytes]:
        """Texts split into words as they are; each different word is looked up or merged once."""
        split = [self.split(p) for p in texts]
        words = list({w for ws in split for w in ws})
        raw = [w.encode() for w in words]
        places = self.lexicon.find(raw).tolist()
        lexicon, ids = self.lexicon, {}
        unseen = [i for i, at in enumerate(places) if at < 0]
        for i, x in zip(unseen, self.vocabulary.merged_all([raw[i] for i in unseen])):
            ids[words[i]] = np.asarray(x, "<u4").tobytes()
        table = lexicon.ids.astype("<u4").tobytes() if len(unseen) < len(words) else b""
        for w, at in zip(words, places):
            if at >= 0:
                ids[w] = table[4 * lexicon.offsets[at] : 4 * lexicon.offsets[at + 1]]
        return [b"".join([ids[w] for w in ws]) for ws in split]

    def _plain(self, texts: list[str]) -> list[bytes]:
        """A text is cut before single spaces between other characters: such a space always begins a word."""
        split = [t.split(" ") for t in texts]
        known = self.known
        if len(known) > CACHED_WORDS:
            known.clear()
        missing = set().union(*[p[1:] for p in split]).difference(known)
        if missing:
            self._learn(list(missing))
        out: list = [[known[p] for p in pieces[1:]] for pieces in split]
        whole = [i for i, ids in enumerate(out) if None in ids or split[i][0][-1:].isspace() or (ids and not split[i][0])]
        begins = self._whole([split[i][0] for i in range(len(texts))])
        out = [b"".join([begin, *ids]) if None not in ids else b"" for begin, ids in zip(begins, out)]
        for i, ids in zip(whole, self._whole([texts[i] for i in whole])):
            out[i] = ids
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids as little-endian unsigned 32-bit integers."""
        v = self.vocabulary
        if not v.special_split or not any(v.special_split.search(t) for t in texts):
            return self._plain(texts)
        out = []
        for t in texts:
            pieces = self._plain(v.special_split.split(t))
            marks = [struct.pack("<I", v.special[m]) for m in v.special_split.findall(t)]
            out.append(b"".join(x for pair in zip(pieces, [*marks, b""]) for x in pair))
        return out

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.vocabulary.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


def encoded(docs: DataFrame, text: str, vocabulary_path: str, lexicon_words: int = 50_000, with_ids: bool = False) -> DataFrame:
    """``docs`` without ``text``, with n_tokens, ids_sha256 and decoded_sha256, and the ids themselves if wanted."""
    spark = docs.sparkSession
    names = ship_lexicon(spark, frequent_words(F.col(f"`{text}`"), docs, lexicon_words), vocabulary_path)
    made = ["n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids
    others = [f for f in docs.schema.fields if f.name != text and f.name.lower() not in made]
    kinds = ["long", "string", "string"] + ["array<int>"] * with_ids
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in others] + [f"{c} {k}" for c, k in zip(made, kinds)])
    # Columns go in by place, whatever their names.
    rows = docs.select(*[F.col(f"`{f.name}`").alias(f"c{i}") for i, f in enumerate(others)], F.col(f"`{text}`").alias("text"))

    def run(batches):
        encoder = Encoder(Vocabulary(SparkFiles.get(names[1])), Lexicon(SparkFiles.get(names[0])))
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                ids = encoder.encode([t or "" for t in part.column("text").to_pylist()])
                columns = [part.column(i) for i in range(len(others))]
                columns += [
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
                    pa.array([hashlib.sha256(encoder.decode(x).encode()).hexdigest() for x in ids]),
                ]
                if with_ids:
                    columns.append(pa.array([np.frombuffer(x, "<i4") for x in ids], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, [f.name for f in others] + made)

    return rows.mapInArrow(freed(run), schema)
