"""No text destroyed, no false equality: rows that share an id, structured texts, clashing names, empty tables."""

import collections
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from daybook.llm import bpe, html_extract, jaccard_join, mixing, substring_dedup, suffix_dedup
from daybook.llm.textvec import text_bytes, words


def prose(seed, n, vocabulary=10**6):
    rng = random.Random(seed)
    return " ".join(f"{rng.choice('abcdefgh')}{rng.randrange(vocabulary)}" for _ in range(n))


def by_letters(n, a, d):
    """Two strings of n letters that a sum of powers modulo a power of two cannot tell apart, and their swap."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join(a if b else d for b in bits), "".join(d if b else a for b in bits)


def test_words_with_swapped_letters_have_hashes_of_their_own():
    import pyarrow as pa

    for n in (64, 1024, 4096):
        one, two = by_letters(n, "a", "d")
        hashes, _ = words(*text_bytes(pa.array([one, two, one[::-1]])))
        assert len(set(hashes.tolist())) == len({one, two, one[::-1]})


def test_substring_dedup_by_brute_force(spark, docs):
    """Chunks by the gear hash byte for byte; a chunk goes if its text stands in an earlier place, in runs of 100 bytes."""

    def chunked(data):
        out, begin = [], 0
        for end in range(1, len(data) + 1):
            h = 0
            for k in range(substring_dedup.REACH):
                if end - 1 - k >= 0:
                    h += int(substring_dedup.GEAR[data[end - 1 - k]]) << k
            natural = end >= substring_dedup.REACH and h & int(substring_dedup.CUT_BITS) == 0
            if end < len(data) and (data[end] & 0xC0) == 0x80:
                natural = False
            if natural or end == len(data):
                out.append((begin, end))
                begin = end
        return out

    rows = [(i, prose(i % 7, 40 + i) + prose(100 + i, 30)) for i in range(20)]
    rows += [(30, rows[3][1] + "é" * 60), (30, "own text " + prose(77, 60)), (31, prose(77, 60)), (None, rows[0][1]), (40, None), (41, "")]
    placed = []
    for i, text in rows:
        if i is not None and text:
            data = text.encode()
            placed += [(i, text, a, b, data[a:b]) for a, b in chunked(data)]
    order = docs(*rows).select("doc_id", "text", F.xxhash64("text").alias("h")).collect()
    rank = {(r["doc_id"], r["text"]): r["h"] for r in order}
    first = {}
    for i, text, a, b, chunk in sorted(placed, key=lambda p: (p[0], rank[p[0], p[1]], p[2])):
        first.setdefault(chunk, (i, rank[i, text], a))
    runs = collections.defaultdict(list)
    for i, text, a, b, chunk in placed:
        if first[chunk] != (i, rank[i, text], a):
            spans = runs[i, text]
            if spans and spans[-1][1] == a:
                spans[-1][1] = b
            else:
                spans.append([a, b])
    found, spans = substring_dedup.without_repeats(docs(*rows))
    got = {(r["doc_id"], hashlib.sha256((r["text"] or "").encode()).hexdigest(), tuple((s["at"], s["size"]) for s in r[spans] or [])) for r in found.collect()}
    want = set()
    for i, text in rows:
        cut = [(a, b) for a, b in runs.get((i, text), []) if b - a >= 100]
        data = (text or "").encode()
        kept = b"".join(data[x:y] for x, y in zip([0] + [b for _, b in cut], [a for a, _ in cut] + [len(data)]))
        want.add((i, hashlib.sha256(kept).hexdigest(), tuple((a, b - a) for a, b in cut)))
    assert got == want and found.count() == len(rows)
    assert any(c for _, _, c in want)


def test_long_chunks_are_cut_and_differ(spark, docs):
    rng = random.Random(4)
    one = "".join(rng.choice("ad") for _ in range(4096))
    two = one.translate(str.maketrans("ad", "da"))
    out = {r["doc_id"]: r["text"] for r in substring_dedup.without_repeats(docs((1, one), (2, two), (3, one), (4, "é" * 5000)))[0].collect()}
    assert (out[1], out[2], out[3]) == (one, two, "") and set(out[4]) == {"é"}
    data, starts = text_bytes(__import__("pyarrow").array(["é" * 5000, one, "a" * 3000]))
    ends = substring_dedup.chunk_ends(data, starts)
    sizes = np.diff(np.concatenate([[0], ends]))
    assert sizes.max() <= substring_dedup.MOST and sizes.min() > 0 and set(starts[1:].tolist()) <= set(ends.tolist())
    assert all((data[e] & 0xC0) != 0x80 for e in ends[:-1].tolist())


PASSAGE = prose(1, 90)


@pytest.mark.parametrize("dedup", ["op1", "op7"])
def test_rows_that_share_an_id_are_cut_by_their_own_places(spark, docs, dedup):
    rows = [(0, PASSAGE), (1, PASSAGE), (1, "zz " * 40), (1, prose(2, 200)), (1, PASSAGE)]
    if dedup == "op1":
        out = [(r["doc_id"], r["text"]) for r in substring_dedup.without_repeats(docs(*rows))[0].collect()]
        kept = collections.Counter((i, t) for i, t in out)
        assert kept[1, prose(2, 200)] == 1 and kept[0, PASSAGE] == 1 and kept[1, "zz " * 40] + sum(1 for i, t in out if t.startswith("zz")) >= 1
    else:
        frame = docs(*rows).select(F.col("doc_id").alias("id"), "text")
        out = [(r["id"], bytes(r["kept"]).decode()) for r in suffix_dedup.without_repeats(frame).collect()]
        assert sorted(out) == sorted([(0, PASSAGE), (1, ""), (1, ""), (1, "zz " * 40), (1, prose(2, 200))])
    assert len(out) == len(rows)


def test_jaccard_rows_that_share_an_id_are_documents_of_their_own(spark, docs):
    rows = [(0, "a b c d"), (1, "a b c d"), (1, "p q r s"), (2, "P q r s"), (5, "lone words only here"), (5, "lone words only here"), (None, "a b c d")]
    got = jaccard_join.classes(docs(*rows).select(F.col("doc_id").alias("id"), "text"), 3, 90, 100).collect()
    assert sorted((str(r["id"]), r["n"], str(r["component"])) for r in got) == sorted(
        [("0", 2, "0"), ("1", 2, "0"), ("1", 2, "1"), ("2", 2, "1"), ("5", 2, "5"), ("5", 2, "5"), ("None", 2, "None")]
    )
    one, two = by_letters(1024, "a", "d")
    apart = jaccard_join.classes(docs((1, one), (2, two)).select(F.col("doc_id").alias("id"), "text"), 3, 90, 100).collect()
    assert {r["component"] for r in apart} == {1, 2}
    frame = docs(*rows).withColumns({"_gone": F.lit(1), "gone": F.lit(2), "a.b": F.lit(3)})
    kept = jaccard_join.without_near_copies(frame, shingle=3)
    assert kept.columns == frame.columns
    found = sorted((str(r["doc_id"]), r["text"]) for r in kept.select("doc_id", "text").collect())
    assert found == sorted([("0", "a b c d"), ("1", "p q r s"), ("5", "lone words only here"), ("5", "lone words only here"), ("None", "a b c d")])


def test_mixed_takes_each_row_by_its_own_plan(spark, docs):
    rows = [(None, "one two three", "a"), (None, "four five six", "b"), (7, "one two three", "a"), (7, "x y z", "c"), (7, "x y z", "c"), (8, None, None), (9, "", "d")]
    rows += [(100 + i, prose(i, 5 + i % 9), "abc"[i % 3]) for i in range(60)]
    frame = docs(*rows).withColumns({"row": F.lit(1), "copies": F.lit("x"), "a.b": F.lit(3)})
    out = mixing.mixed(frame)
    assert out.columns == frame.columns
    times = collections.Counter((r["doc_id"], r["text"], r["source"]) for r in out.select("doc_id", "text", "source").collect())
    given = collections.Counter(rows)
    assert set(times) <= set(given) and all(n <= 3 * given[k] for k, n in times.items())
    own = F.xxhash64("doc_id", F.col("doc_id").isNull(), "source", F.col("source").isNull(), "text", F.col("text").isNull())
    plan = mixing.copies(docs(*rows).select(own.alias("id"), "source", mixing.n_words(F.col("text")).alias("size")))
    assert sum(times.values()) == sum(r["copies"] for r in plan.collect())
    assert mixing.mixed(frame.filter("false")).collect() == []


def test_sampling_by_brute_force(spark, docs):
    """Of each source, the smallest ranks until the words left are reached, to the nearest document."""
    rows = [(i, prose(i, 3 + i % 23), "abc"[i % 3]) for i in range(200)]
    sizes = docs(*rows).select(F.col("doc_id").alias("id"), "source", mixing.n_words(F.col("text")).alias("size"))
    u = {r["id"]: r["u"] for r in sizes.select("id", ((F.shiftrightunsigned(F.xxhash64("id", F.lit(1)), 11) + 0.5) / float(1 << 53)).alias("u")).collect()}
    longer = {r["source"]: r["longer"] for r in mixing.targets(sizes).collect()}
    got = mixing.copies(sizes).collect()
    for source in "abc":
        own = [r for r in got if r["source"] == source]
        ratio = own[0]["target"] / own[0]["source_size"]
        whole, part = int(ratio + 1e-9), max(ratio - int(ratio + 1e-9), 0.0)
        ranked = []
        for r in own:
            p = min(max(part * np.log(r["size"] + 2.0) / longer[source], 1e-9), 1 - 1e-9)
            x = u[r["id"]]
            ranked.append((x / (1 - x) / (p / (1 - p)), r["id"], r["size"]))
        left, taken, total = part * own[0]["source_size"], set(), 0
        for _, i, size in sorted(ranked):
            if total + size / 2 > left:
                break
            taken.add(i)
            total += size
        assert {r["id"] for r in own if r["copies"] == whole + 1} == taken, source
        assert {r["copies"] for r in own} <= {whole, whole + 1}


def test_clashing_names_pass(spark, docs, tmp_path):
    import json

    stands = {b: c for c, b in bpe._byte_characters().items()}
    path = tmp_path / "v.json"
    path.write_text(json.dumps({"added_tokens": [], "model": {"vocab": {stands[b]: b for b in range(256)}, "merges": []}}))
    frame = docs((1, "ab ab"), (2, None)).withColumns({"n_tokens": F.lit("old"), "a.b": F.lit(3), "ids": F.lit("old")})
    out = bpe.encoded(frame, "text", str(path), with_ids=True)
    assert {r["doc_id"]: (r["n_tokens"], r["a.b"], r["ids"]) for r in out.collect()} == {1: (5, 3, [97, 98, 32, 97, 98]), 2: (0, 3, [])}
    assert bpe.encoded(frame.filter("false"), "text", str(path)).collect() == []
    found, spans = substring_dedup.without_repeats(docs((1, PASSAGE), (2, PASSAGE)).withColumns({"a.b": F.lit(1), "spans": F.lit("x"), "span_id": F.lit(2)}))
    assert {r["doc_id"]: (len(r["text"]) > 0, r["spans"], r["a.b"]) for r in found.collect()} == {1: (True, "x", 1), 2: (False, "x", 1)}
    page = spark.createDataFrame([(1, "<p>x y</p>")], "page_id long, html string")
    assert html_extract.extracted(page.filter("false")).collect() == []


def test_lexicon_is_bounded_by_whole_classes(spark, docs):
    rows = [(i, "the " * 50 + "and " * 20 + f"rare{'abcdefghij'[i]} rare{'abcdefghij'[i]}") for i in range(10)]
    frame = docs(*rows)
    assert bpe.frequent_words(F.col("text"), frame, 2) == ["and", "the"]
    assert bpe.frequent_words(F.col("text"), frame, 11) == ["and", "the"]
    assert len(bpe.frequent_words(F.col("text"), frame, 12)) == 12


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_take_odd_rows_and_none(spark, docs, stage):
    work = dict(corpus_pipeline.STAGES)[stage]
    rows = [(1, None), (None, prose(3, 80)), (None, prose(4, 80), "b"), (2, ""), (3, prose(5, 90)), (3, prose(6, 90)), (4, prose(5, 90), None)]
    frame = docs(*rows)
    out = work(spark, frame, "/root/testdata/sf0.001")
    given = collections.Counter((r[0], r[1]) for r in rows)
    if stage == "bpe":
        assert out.count() == len(rows)
    else:
        assert out.columns == frame.columns
        assert set((r["doc_id"],) for r in out.collect()) <= set((k,) for k, _ in given)
    assert work(spark, frame.filter("false"), "/root/testdata/sf0.001").collect() == []


def test_katz_contexts_in_parts_give_the_same_scores(spark, docs, monkeypatch):
    from daybook.llm import katz

    rows = [(i, prose(i, 60, 12)) for i in range(30)] + [(90, None), (91, ""), (None, "A0 b1 zzz"), (5, "again " * 40)]
    frame = docs(*rows).select(F.col("doc_id").alias("id"), "text")
    held = F.coalesce(F.col("id") % 5 == 0, F.lit(False))

    def scores():
        found, total, words_, pairs = katz.scored(frame, held)
        return sorted((str(r["id"]), r["n_tokens"], r["n_known"], round(r["base_score"], 9), round(r["score"], 9)) for r in found.collect()), total

    whole = scores()
    tables = spark.catalog.listTables()
    monkeypatch.setattr(katz, "HOT", 3)
    monkeypatch.setattr(katz, "BUCKET_ENTRIES", 50)
    assert scores() == whole
    assert not [t.name for t in tables if t.name.startswith("op6_pieces")]
    none = katz.scored(frame.filter("false"), held)
    assert none[0].collect() == [] and none[1] == 0
