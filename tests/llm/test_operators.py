"""Each operator against a brute-force version on small rows: nulls, empty and long texts, ties, repeated rows."""

import collections
import hashlib
import itertools
import json
import math
import random
import re
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from daybook.llm import bpe, collision_ann, html_extract, jaccard_join, katz, mixing, quality_rules, substring_dedup, suffix_dedup, warc
from daybook.llm.graph import components
from daybook.llm.textvec import text_bytes, windows, words

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def prose(seed, n, vocabulary=400):
    rng = random.Random(seed)
    return " ".join(rng.choice("abcdefghij") * rng.randint(1, 2) + str(rng.randrange(vocabulary)) for _ in range(n))


def ids_and_texts(docs, rows):
    return docs(*rows).select(F.col("doc_id").alias("id"), "text")


ODD = [(90, None), (91, ""), (92, " \t\n "), (93, "x" * 3000), (94, "ünï ©ode　wörds \x85 end"), (None, "no id here at all"), (95, "one two"), (95, "one two")]


def test_word_hashes_depend_on_the_word_alone():
    import pyarrow as pa

    data, at = text_bytes(pa.array(["Ab cd", None, "", "  cd\tAB ", "ab"]))
    hashes, begin = words(data, at)
    assert begin.tolist() == [0, 2, 2, 2, 4, 5]
    assert hashes[0] == hashes[3] == hashes[4] and hashes[1] == hashes[2] != hashes[0]
    runs, begin = windows(hashes, begin, 2)
    assert begin.tolist() == [0, 1, 1, 1, 2, 3] and len(set(runs.tolist())) == 3


def test_quality_statistics(spark, docs):
    def brute(text):
        w, lines = split(text), [x for x in (text or "").split("\n") if split(x)]
        seen, cover = collections.Counter(zip(w, w[1:], w[2:])), set()
        for i in range(len(w) - 2):
            if seen[tuple(w[i : i + 3])] > 1:
                cover |= {i, i + 1, i + 2}
        return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(cover)

    many = " ".join(f"w{i % 97} w{i % 89}" for i in range(20000))
    rows = [*ODD, (1, "a b c a b c a b c"), (2, "a b c d\na b c d\n\n x#|\n x#|"), (3, many), (4, prose(4, 500, 5))]
    s = quality_rules.flat(F.col("s"))
    got = docs(*rows).withColumn("s", quality_rules.statistics(F.col("text"))).withColumn("s", s)
    for r in got.collect():
        want = brute(r["text"])
        assert tuple(r["s"][c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == want, r["doc_id"]


def test_quality_rules_learn_a_threshold_and_keep_without_labels(spark, docs):
    rows = [(i, " ".join(w[:-1] + "#" if i % 4 == 0 else w for w in prose(i, 80).split())) for i in range(160)]
    labels = spark.createDataFrame([(i, 0 if i % 4 == 0 else 1) for i in range(0, 160)], "doc_id long, quality int")
    kept = quality_rules.kept_documents(docs(*rows, *ODD), labels)
    assert kept.columns == docs((1, "")).columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [i for i in range(160) if i % 4]
    none = quality_rules.kept_documents(docs(*rows), labels.limit(0))
    assert none.count() == 160
    assert quality_rules.kept_documents(docs(*rows).limit(0), labels).count() == 0


def _brute_classes(rows, n, num):
    sets = {}
    for key, text in rows:
        w = split((text or "").translate(LOWER))
        sets[key] = {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()
    parent = {k: k for k in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations([k for k in sets if k is not None], 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= num * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return {k: (len(sets[k]), None if k is None else find(k)) for k in sets}


@pytest.mark.parametrize("n,num", [(3, 90), (5, 80)])
def test_jaccard_classes_equal_brute_force(spark, docs, n, num):
    rows, rng = list(ODD), random.Random(n)
    for g in range(8):
        base = prose(g, 30 + 60 * g).split()
        for c in range(8):
            w = list(base)
            for _ in range(rng.randrange(0, 2 + len(w) // 40)):
                w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
            rows.append((100 + 10 * g + c, " ".join(w)))
    want = _brute_classes(rows, n, num)
    got = jaccard_join.classes(ids_and_texts(docs, rows), n, num, 100).collect()
    assert len(got) == len(rows)
    assert {r["id"]: (r["n"], r["component"]) for r in got} == want
    assert jaccard_join.classes(ids_and_texts(docs, rows).limit(0), n, num, 100).count() == 0


def test_jaccard_one_deletion_neighbours_stand_in_for_skipped_segments(spark, docs):
    base = prose(1, 200).split()
    rows = [(1, " ".join(base)), (2, " ".join([*base[:100], "edit", *base[101:]]))]
    frame = ids_and_texts(docs, rows)
    plain = jaccard_join.signatures(frame, 3, 90, 100).select("part").distinct().collect()
    parts = sorted(r["part"] for r in plain)
    units = {p: 1 if i % 2 else -1 for i, p in enumerate(parts)}
    near = jaccard_join.signatures(frame, 3, 90, 100, units)
    met = near.groupBy("signature").agg(F.countDistinct("id").alias("n")).filter("n = 2").count()
    assert met > 0
    costs = spark.createDataFrame([((3 << 40) + i, 10, 100000 if i == 0 else 0) for i in range(6)], "part long, rows long, pairs long")
    assert set(jaccard_join.allocate(costs, 90, 100).values()) == {1, -1}


def test_components(spark):
    edges = [(i, i + 1) for i in range(20)] + [(50, 40), (40, 60), (7, 7)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(21)}, 40: 40, 50: 40, 60: 40}


def test_substring_dedup_finds_shifted_passages_and_leaves_the_rest(spark, docs):
    passage = prose(5, 80, 10**6)
    rows = [(1, prose(1, 100) + " " + passage), (2, "xy " + prose(2, 90) + passage + prose(3, 50)), (3, prose(9, 200, 10**6)), *ODD]
    found, spans = substring_dedup.without_repeats(docs(*rows))
    out = {r["doc_id"]: r for r in found.collect()}
    assert out[1]["text"] == rows[0][1] and out[3]["text"] == rows[2][1]
    assert len(out[2]["text"].encode()) < len(rows[1][1].encode()) - len(passage) // 2 and out[2][spans]
    assert out[90]["text"] is None and out[91]["text"] == "" and out[None]["text"] == "no id here at all"
    assert found.count() == len(rows)


def test_suffix_dedup_equals_brute_force(spark, docs):
    length, rows, rng = 50, [], random.Random(3)
    pool = [prose(i, 60, 30) for i in range(6)]
    for i in range(40):
        rows.append((i, "é".join(rng.choice(pool)[rng.randrange(40) :][: rng.randrange(200)] + prose(i, rng.randrange(20)) for _ in range(3))))
    rows += [(200, "ab" * 400), (201, "ab" * 100 + "c"), (202, rows[0][1]), *ODD]
    first = {}
    for key, text in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        b = (text or "").encode()
        for k in range(len(b) - length + 1):
            first.setdefault(b[k : k + length], key)
    got = collections.defaultdict(list)
    for r in suffix_dedup.without_repeats(ids_and_texts(docs, rows), length).collect():
        got[r["id"]].append(r)
    for key, text in rows:
        b = (text or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if key is not None and first[b[k : k + length]] < key:
                gone[k : k + length] = b"\1" * length
        kept = bytes(x for x, y in zip(b, gone) if not y)
        for r in got[key]:
            assert (r["n_bytes"], bytes(r["kept"]), r["kept_sha256"]) == (len(b), kept, hashlib.sha256(kept).hexdigest()), key


def test_mixing_meets_targets_and_repeats(spark, docs):
    rows = [(i, prose(i, 5 + i % 40), ["a", "b", "c", None, "d"][i % 5]) for i in range(600)] + [(900, None, "e"), (901, "", "e")]
    sizes = docs(*rows).select(F.col("doc_id").alias("id"), "source", mixing.n_words(F.col("text")).alias("size"))
    got = [tuple(r) for r in mixing.copies(sizes).collect()]
    assert sorted(got, key=str) == sorted((tuple(r) for r in mixing.copies(sizes).collect()), key=str)
    total, by = sum(r[2] for r in got), collections.defaultdict(list)
    for r in got:
        by[r[1]].append(r)
    assert math.isclose(sum(v[0][4] for v in by.values()), total, rel_tol=1e-9)
    for source, v in by.items():
        size, target, taken = sum(r[2] for r in v), v[0][4], sum(r[2] * r[5] for r in v)
        assert v[0][3] == size and target <= 3 * size + 1e-9 and all(r[5] <= 3 for r in v)
        assert abs(taken - target) <= max(r[2] for r in v), source


def test_mixing_targets_stop_at_three_times_and_reshare(spark):
    sizes = spark.createDataFrame([("a", 1000), ("b", 10), ("c", 500), (None, 100)], "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.targets(sizes).collect()}
    # weights 1, 2, 3, 1: b stops at 30; 1580 left for weights 1 + 3 + 1, null stops at 300; 1280 for 1 + 3.
    assert got == pytest.approx({"a": 320, "b": 30, "c": 960, None: 300})


@pytest.fixture(scope="module")
def vocabulary(tmp_path_factory):
    """A small byte-level vocabulary of our own: all bytes and a few merges."""
    stands = {b: c for c, b in bpe._byte_characters().items()}
    vocab = {stands[b]: b for b in range(256)}
    merges = []
    for a, b in [("t", "h"), ("th", "e"), (stands[32], "the"), ("a", "a"), ("aa", "aa"), ("e", "n"), ("r", "e"), (stands[32], "a")]:
        vocab[a + b] = len(vocab)
        merges.append([a, b])
    spec = {"added_tokens": [{"id": len(vocab), "content": "<|end|>"}], "model": {"vocab": vocab, "merges": merges}}
    path = tmp_path_factory.mktemp("bpe") / "v.json"
    path.write_text(json.dumps(spec))
    return str(path)


def test_bpe_merges_lexicon_and_round_trip(spark, docs, vocabulary, tmp_path):
    v = bpe.Vocabulary(vocabulary)
    listed = [b" the", b" then", b" there", b"other", b"then", b" aaaa"]
    states = bpe.compile_lexicon(listed, v.merged, str(tmp_path / "l.bin"))
    lexicon = bpe.Lexicon(str(tmp_path / "l.bin"))
    assert states < sum(map(len, listed)) + 1
    places = lexicon.find([*listed, b" th", b"", b"zzz"])
    assert places[-3:].tolist() == [-1, -1, -1]
    for w, at in zip(listed, places):
        assert lexicon.ids[lexicon.offsets[at] : lexicon.offsets[at + 1]].tolist() == v.merged(w)
    some = [b"aaaaa", b" there", b"\x00\xff", b"x" * 300, b"thethethe", b"a"]
    assert [list(x) for x in v.merged_all(some)] == [v.merged(w) for w in some]
    rows = [(1, "the other  then\n\nthere<|end|>the"), (2, "it's aaaaa 12 ½ 日本語 🙂"), *ODD]
    for r in bpe.encoded(docs(*rows), "text", vocabulary, with_ids=True).collect():
        text = dict((k, t) for k, t in rows)[r["doc_id"]] or ""
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert r["ids_sha256"] == hashlib.sha256(struct.pack(f"<{r['n_tokens']}I", *r["ids"])).hexdigest()


def test_bpe_equals_the_tokenizer_library():
    tokens = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = tokens.path("byte_bpe_50k.json")
    library, v = Tokenizer.from_file(path), bpe.Vocabulary(path)
    import tempfile

    with tempfile.NamedTemporaryFile() as f:
        bpe.compile_lexicon([b" the", b" and"], v.merged, f.name)
        encoder = bpe.Encoder(v, bpe.Lexicon(f.name))
        texts = ["", " ", "  a", "Hello  world\n\n  x", "<|endoftext|>a<|endoftext|>", "\x1c\x1d a\x85b c　d", "it's we'll 12٣ ½ ²", "日本語 🙂👍🏽 éàü", "x" * 900, " the and ", "a \n b", "\t\t x "]
        for text, ids in zip(texts, encoder.encode(texts)):
            want = library.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(ids, "<u4").tolist() == want, text
            assert encoder.decode(ids) == library.decode(want, skip_special_tokens=False)


def test_warc_round_trip(spark):
    long_page = "é<p>\r\n\r\n" * 60000
    rows = [(5, "http://a", "x"), (2, "http://b", "x"), (9, None, long_page), (1, "u\r\nv", None), (3, "c", ""), (7, "d", long_page), (None, "e", "x")]
    pages = spark.createDataFrame(rows, "id long, uri string, payload string")
    folder, archives = warc.archive(pages)
    chunks = warc.read(spark, folder, archives).collect()
    last = {r["id"]: r for r in chunks if r["last"]}
    refers = {5: 2, 2: None, 9: 7, 7: None, 1: None, 3: 1, None: None}
    for key, _, page in rows:
        data = (page or "").encode()
        import base64

        assert last[key]["payload_bytes"] == len(data) and last[key]["refers_to"] == refers[key]
        assert last[key]["digest"] == base64.b32encode(hashlib.sha1(data).digest()).decode()
        if refers[key] is None:
            own = sorted((r for r in chunks if r["record_id"] == last[key]["record_id"]), key=lambda r: r["chunk"])
            assert b"".join(bytes(r["data"]) for r in own) == data and all(len(r["data"]) <= warc.CHUNK for r in own)
    empty_folder, none = warc.archive(pages.limit(0))
    assert warc.read(spark, empty_folder, none).count() == 0


def test_katz_is_normalised_and_scores_like_its_definition(spark, docs, monkeypatch):
    rows = [(i, prose(i, 60, 12)) for i in range(40)] + [(90, None), (91, ""), (None, "A0 b1 zzz")]
    held = F.coalesce(F.col("id") % 5 == 0, F.lit(False))
    scores, total, _, _ = katz.scored(ids_and_texts(docs, rows), held)
    train = [split((t or "").translate(LOWER)) + ["\0"] for i, t in rows if i is None or i % 5]
    c = collections.Counter(w for d in train for w in d)
    b = collections.Counter(p for d in train for p in zip(["\1", *d], d))
    of = collections.Counter(u for u, _ in b.elements())
    tallies = lambda x: [sum(1 for v in x.values() if v == r) for r in range(1, katz.K + 2)]
    p_word, d = katz.Words(sum(c.values()), tallies(c)), katz.discounts(tallies(b))
    single = lambda w: float(p_word(np.array([c.get(w, 0)]))[0])

    def p(u, w):
        kept = {x: n for (y, x), n in b.items() if y == u and n >= 1}
        if not of[u]:
            return single(w)
        mass = sum(d[min(n, katz.K + 1)] * n for n in kept.values())
        scale = 1.0 if of[u] - mass > 1e-9 * of[u] else of[u] / (of[u] + 1)
        if w in kept:
            return scale * d[min(kept[w], katz.K + 1)] * kept[w] / of[u]
        return (1 - scale * mass / of[u]) / (1 - sum(single(x) for x in kept)) * single(w)

    assert total == sum(c.values())
    for u in [*list(c)[:5], "\1", "unseen"]:
        assert math.isclose(sum(p(u, w) for w in c) + p(u, "never"), 1, rel_tol=1e-9)
    got = collections.defaultdict(list)
    for r in scores.collect():
        got[r["id"]].append(r)
    for key, text in rows:
        w = split((text or "").translate(LOWER)) + ["\0"]
        assert math.isclose(got[key][0]["score"], sum(math.log10(p(u, x)) for u, x in zip(["\1", *w], w)), rel_tol=1e-9), key
        assert got[key][0]["n_tokens"] == len(w) and got[key][0]["n_known"] == sum(x in c for x in w)


def test_html_main_text():
    page = (
        "<html><head><title>T</title><style>p{}</style></head><body><nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></nav>"
        "<!-- x --><div class='cookie-notice'>We use cookies.</div><article><h1>Head &amp; line</h1><p>First  long\nparagraph of the text.<p>"
        "Short.<div class=\"ad\">Buy this now.</div><p>Second paragraph, <a href='x>y'>linked</a> inside.</p></article>"
        "<div id=comments><p>Nice text, thank you very much for it.</p></div><footer>&copy; site</footer><script>var t='</p>'</script>"
    )
    assert html_extract.main_text(page) == "Head & line\n\nFirst long paragraph of the text.\n\nShort.\n\nSecond paragraph, linked inside."
    assert html_extract.main_text("") == "" and html_extract.main_text("<p") == ""


def test_minimum_cut_equals_brute_force():
    rng = random.Random(1)
    for _ in range(60):
        n = rng.randint(1, 8)
        scores = [rng.uniform(-3, 3) for _ in range(n)]
        edges = [(i, j, rng.uniform(0, 1.5)) for i in range(n) for j in range(i + 1, n) if rng.random() < 0.5]

        def cost(keep):
            return sum(abs(s) for s, k in zip(scores, keep) if (s > 0) != k) + sum(w for i, j, w in edges if keep[i] != keep[j])

        best = min(cost(k) for k in itertools.product([True, False], repeat=n))
        assert math.isclose(cost(html_extract.cut(scores, edges)), best, abs_tol=1e-9)


def test_html_rows(spark):
    rows = [(1, "u", "<p>Some words that make a sentence of fair length, with an end.</p>"), (2, None, None), (None, "v", "")]
    got = html_extract.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert [(r["page_id"], r["n_chars"]) for r in got] == [(1, 60), (2, 0), (None, 0)]


def test_nearest_neighbours_reach_recall_and_rank_exactly(spark):
    rng = np.random.Generator(np.random.PCG64(2))
    v = rng.standard_normal((1500, 16)).astype(np.float32)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    v[10] = v[11] = v[40]
    rows = [(i, x.tolist()) for i, x in enumerate(v)] + [(2000, None), (2020, [0.0] * 16), (2040, [float("nan")] * 16), (2060, [1.0, None]), (None, v[0].tolist())]
    got = collections.defaultdict(list)
    frame = spark.createDataFrame(rows, "id long, vector array<float>")
    for r in collision_ann.nearest(frame, F.coalesce(F.col("id") % 20 == 0, F.lit(False)), k=20).collect():
        got[r["query_id"]].append((r["rank"], r["id"], r["score"]))
    x, hit = v.astype(float), 0
    assert sorted(got) == list(range(0, 1500, 20))
    for q, found in got.items():
        scores = x @ x[q]
        want = sorted((i for i in range(1500) if i != q), key=lambda i: (-scores[i], i))[:20]
        found.sort()
        assert [f[0] for f in found] == list(range(1, 21)) and all(abs(f[2] - scores[f[1]]) < 1e-12 for f in found)
        hit += len({f[1] for f in found} & set(want))
    assert hit >= 0.9 * 20 * len(got)
    assert [f[1] for f in got[40][:2]] == [10, 11]
    assert collision_ann.nearest(frame.limit(0), F.lit(True)).count() == 0
