"""Golay SimHash, tokenizer alignment and whitening against brute-force versions over whole small tables."""

import collections
import hashlib
import itertools
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from daybook.llm import golay_simhash, queries, token_alignment, whitening

SF = "/root/testdata/sf0.001"


def rows_of(df, key):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[key] is None, r))


# --- Golay SimHash ---------------------------------------------------------------------------------------------------


def simhash(text, size=4):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + size]) for i in range(max(len(words) - size, 0) + 1)] if words else []
    bits = [sum(xxhash.xxh64_intdigest(s, 42) >> b & 1 for s in shingles) for b in range(64)]
    return sum((2 * n > len(shingles)) << b for b, n in enumerate(bits))


def reached(ids, prints):
    """Smallest id that links reach, by comparing all pairs."""
    group = list(range(len(ids)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, j in itertools.combinations(range(len(ids)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= 4:
            group[root(j)] = root(i)
    least = {}
    for i, x in enumerate(ids):
        known = [v for v in (least.get(root(i)), x) if v is not None]
        least[root(i)] = min(known) if known else None
    return [least[root(i)] for i in range(len(ids))]


def test_golay_code_is_perfect_and_near_fingerprints_share_a_key():
    cosets = golay_simhash.Cosets()
    syndromes = golay_simhash._remainders(cosets.pattern)[cosets.excess == 0]
    assert np.bincount(syndromes, minlength=2048).tolist() == [1] * 2048
    rng = random.Random(1)
    for shape in ((4, 0, 0), (2, 2, 0), (0, 1, 3), (1, 1, 2), (0, 0, 4), (1, 2, 1), (0, 0, 0)):
        for _ in range(40):
            f = rng.getrandbits(64)
            g, high = f, 64
            for width, errors in zip(golay_simhash.WIDTHS, shape):
                high -= width
                for b in rng.sample(range(high, high + width), errors):
                    g ^= 1 << b
            place, key = golay_simhash.keys_of(np.array([f, g], np.uint64))
            assert set(key[place == 0].tolist()) & set(key[place == 1].tolist())


def test_simhash_components_on_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    prints = [simhash(r["text"]) for r in docs]
    found = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in queries.op11_golay_simhash(spark, SF).collect()}
    reach = reached([r["doc_id"] for r in docs], prints)
    assert found == {r["doc_id"]: (f"{p:016x}", c) for r, p, c in zip(docs, prints, reach)}


def test_simhash_odd_rows(spark, docs):
    base = " ".join(f"w{i}" for i in range(400))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one TWO"), (5, "One two"), (6, "ONE\ntwo"), (None, base), (7, base + " x"), (7, base + " x")]
    rows += [(8, "Äpfel äpfel 日本 © w"), (None, "alone in the world of no ids at all"), (9, base.replace("w7 ", "q7 ")), (10, "v " * 50_000)]
    frame = docs(*rows).withColumn("f", F.lit(1)).withColumn("component", F.lit("x")).withColumn("a.b", F.lit(0))
    got = rows_of(golay_simhash.classes(frame.withColumnRenamed("doc_id", "id")), 0)
    prints = [simhash(t) for _, t in rows]
    reach = reached([i for i, _ in rows], prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    assert got == sorted(zip([i for i, _ in rows], signed, reach), key=lambda r: (r[0] is None, r))
    empty = golay_simhash.classes(docs((1, "x")).filter("false").withColumnRenamed("doc_id", "id"))
    assert empty.columns == ["id", "f", "component"] and empty.collect() == []


def test_simhash_keys_with_many_rows_lose_no_link(spark, monkeypatch):
    """Chains of near fingerprints, far more of them than a chunk holds."""
    monkeypatch.setattr(golay_simhash, "CHUNK", 6)
    rng = random.Random(5)
    prints = set()
    for _ in range(3):
        f = rng.getrandbits(64)
        for _ in range(60):
            prints.add(f)
            for b in rng.sample(range(24), rng.choice((1, 3, 4, 5, 6))):
                f ^= 1 << b
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    distinct = spark.createDataFrame([(s,) for s in signed], "f long")
    edges = [(r["a"], r["b"]) for r in golay_simhash.links(distinct).collect()]
    group = {s: s for s in signed}

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for a, b in edges:
        assert ((a ^ b) & (2**64 - 1)).bit_count() <= 4
        group[root(a)] = root(b)
    least = {}
    for i, s in enumerate(signed):
        least.setdefault(root(s), i)
    assert [least[root(s)] for s in signed] == reached(list(range(len(prints))), prints)


# --- tokenizer alignment ---------------------------------------------------------------------------------------------

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
NAMES = ["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def byte_level():
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table, extra = {}, 256
    for b in range(256):
        if b in visible:
            table[chr(b)] = b
        else:
            table[chr(extra)] = b
            extra += 1
    return table


def brute_alignment(rows):
    a, b = Tokenizer.from_file(PATHS[0]), sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    a.encode_special_tokens = True
    of = byte_level()
    texts = []
    for _, text in rows:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        bytes_a = [bytes(of[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(p[3:-1], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i in ids_b for p in [b.id_to_piece(i)]]
        if not text or b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
            texts.append(None)
            continue
        ends_a, ends_b = [list(itertools.accumulate(map(len, x))) for x in (bytes_a, bytes_b)]
        spans_a, spans_b = [list(zip([0, *e], e)) for e in (ends_a, ends_b)]
        links, j = [], 0
        for x, (s, e) in zip(ids_a, spans_a):
            while spans_b[j][1] <= s:
                j += 1
            k = j
            while k < len(spans_b) and spans_b[k][0] < e:
                links.append((x, ids_b[k]))
                k += 1
        groups, last = [], 0
        for cut in sorted(set(ends_a) & set(ends_b)):
            groups.append(",".join(str(x) for x, e in zip(ids_a, ends_a) if last < e <= cut) + "|" + ",".join(str(x) for x, e in zip(ids_b, ends_b) if last < e <= cut))
            last = cut
        texts.append((ids_a, ids_b, groups, links))
    count = collections.Counter(p for t in texts if t for p in set(t[3]))
    most = collections.Counter()
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    out = []
    for (i, _), t in zip(rows, texts):
        if t is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        ids_a, ids_b, groups, links = t
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        out.append((i, len(ids_a), len(ids_b), len(groups), len(links), sum(count[p] == most[p[0]] for p in links), sum(count[p] for p in links), digest))
    return sorted(out, key=lambda r: (r[0] is None, r))


def test_alignment_on_whole_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if r["text"] is None or len(r["text"]) < 8000]
    short = spark.createDataFrame(rows, "id long, text string").repartition(5)
    got = token_alignment.aligned(short, *PATHS)
    assert got.columns == NAMES
    assert rows_of(got, 0) == brute_alignment(rows)
    assert queries.op12_token_alignment(spark, SF).count() == spark.read.parquet(f"{SF}/documents.parquet").count()


ODD_TEXTS = [
    None, "", " ", "   ", "a", " a", "a ", "a  b   c ", "a\n\n  b\t \tc\n", "foo\n bar\n  baz", "日本語 é😀🇩🇪👩‍👩‍👧 x", "\U00010348𐍈 ᚠᛇ", "a▁b", "▁",
    "<|endoftext|> <s></s><unk> <0x0A>", "a\x00b \x1c\x1d c\x85d\xa0 e　 f   g", "don't we'll 123456  7.8e9 $%#", "x" * 5000, "é" * 3000,
    "﻿bom ﬁ Å é", "tail \n", "tail　", " \x1c", "a   b",
]


def test_alignment_odd_texts(spark):
    rng = random.Random(3)
    alphabet = "aB3 \n\t.,'\xa0é日😀▁　ſ"
    rows = [(i, t) for i, t in enumerate(ODD_TEXTS)] + [(None, "no id here"), (5, "a"), (5, "a"), (5, "again")]
    rows += [(100 + i, "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60)))) for i in range(300)]
    frame = spark.createDataFrame(rows, "id long, text string").withColumn("block", F.lit("x")).withColumn("a.b", F.lit(1))
    assert rows_of(token_alignment.aligned(frame, *PATHS), 0) == brute_alignment(rows)
    empty = token_alignment.aligned(frame.filter("false"), *PATHS)
    assert empty.columns == NAMES and empty.collect() == []


# --- whitening -------------------------------------------------------------------------------------------------------


def brute_whitening(rows, components=16):
    x = {}
    for place, (_, v) in enumerate(rows):
        if v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v):
            x[place] = tuple(int(np.floor(64 * float(c))) + 1_000_000 for c in v)
    fit = sorted(set(x.values()))
    n, total = len(fit), [sum(c) for c in zip(*fit)]
    y = np.array([[(n * a - s) / n for a, s in zip(v, total)] for v in fit])
    e, q = np.linalg.eigh(y.T @ y / n)
    e, q = e[::-1], q[:, ::-1]
    out = {}
    for place, v in x.items():
        exact = [n * a - s for a, s in zip(v, total)]
        z = np.array(exact) / n @ q
        for k in range(min(components, len(e))):
            if e[k] > 1e-9 * e[0]:
                out[place, k + 1] = (rows[place][0], n, sum(d * d for d in exact), z[k] / np.sqrt(e[k]), e[k] / e.sum())
    return out


def check_whitening(df, rows, tolerance=1e-7):
    """Values agree up to the sign of a component."""
    want = brute_whitening(rows)
    got = collections.defaultdict(list)
    for r in df.collect():
        got[r["component"]].append(r)
        assert r["identity_error"] <= 1e-9
    assert {k: len(v) for k, v in got.items()} == dict(collections.Counter(k for _, k in want))
    for k, found in got.items():
        rest = [want[key] for key in want if key[1] == k]

        def fits(sign):
            a = sorted(((r["vec_id"] is None, r["vec_id"] or 0, r["n"], r["deviation"], sign * r["whitened"], r["explained"]) for r in found))
            b = sorted(((i is None, i or 0, n, d, w, x) for i, n, d, w, x in rest))
            return all(p[:4] == q[:4] and abs(p[4] - q[4]) < tolerance and abs(p[5] / q[5] - 1) < 1e-9 for p, q in zip(a, b))

        assert fits(1) or fits(-1), k


def test_whitening_on_whole_table(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    check_whitening(queries.op13_chebyshev_whitening(spark, SF), rows)


def whiten(spark, rows, kind="array<double>"):
    frame = spark.createDataFrame(rows, f"id long, vector {kind}").withColumn("n", F.lit("x")).withColumn("a.b", F.lit(1))
    return whitening.whitened(frame.repartition(3)).withColumnRenamed("id", "vec_id")


def test_whitening_odd_rows(spark):
    rng = np.random.default_rng(2)
    nan, inf = float("nan"), float("inf")
    good = [(i, rng.normal(size=5).tolist()) for i in range(40)]
    bad = [(50, None), (51, [1.0, None, 0.0, 0.0, 0.0]), (52, [nan] * 5), (53, [0.0, 0.0, inf, 0.0, 0.0]), (54, []), (None, [0.5] * 5)]
    rows = good + bad + [good[3], good[3], (99, good[3][1])]
    check_whitening(whiten(spark, rows), rows)
    assert whiten(spark, rows[:0]).collect() == []
    assert whiten(spark, [(1, [1.0, 2.0])] * 3).collect() == []  # no variance
    flat = [(i, [*rng.normal(size=2).tolist(), 1.0, 1.0]) for i in range(30)]
    assert {r["component"] for r in whiten(spark, flat).collect()} == {1, 2}
    check_whitening(whiten(spark, flat), flat)
    # Lengths are spaces of their own.
    both = whiten(spark, good + flat)
    assert {(r["vec_id"], r["n"]) for r in both.filter("component = 4").collect()} == {(i, 40) for i in range(40)}
    # Far values stay exact, and a deviation beyond a long is null.
    huge = [(1, [1e15, 0.0]), (2, [-1e15, 1.0]), (3, [1e300, 2.0])]
    assert {r["deviation"] for r in whiten(spark, huge).collect()} == {None}


@pytest.mark.parametrize("shape", ["flat", "steep", "cluster", "low_rank"])
def test_leading_eigenpairs(shape):
    rng = np.random.default_rng(4)
    d = 120
    e = {
        "flat": np.linspace(1, 1.2, d),
        "steep": 10.0 ** -np.linspace(0, 9, d),
        "cluster": np.concatenate([np.full(15, 5.0), 1 + 1e-7 * np.arange(60), np.full(45, 1e-3)]),
        "low_rank": np.concatenate([np.arange(1.0, 21), np.zeros(100)]),
    }[shape]
    e = np.sort(e)[::-1]
    q = np.linalg.qr(rng.normal(size=(d, d)))[0]
    v = q * e @ q.T
    passes = []
    values, vectors = whitening.leading(lambda x: (passes.append(1), v @ x)[1], d, 16)
    assert np.abs(values - e[:16]).max() < 1e-12 * e[0] and len(passes) < 700
    assert np.linalg.norm(v @ vectors - vectors * values, axis=0).max() < 1e-11 * e[0]
    assert np.abs(vectors.T @ vectors - np.eye(16)).max() < 1e-12
