"""Each operator against a plain version, and the hard cases: nulls, empty and long texts, ties, repeats, empty tables, clashing columns."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import ahocorasick
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers
from pyspark.sql import functions as F

from claimsight.llm import (
    graph, op01_suffix_dedup, op02_mixing, op03_byte_bpe, op04_secrets, op05_fingerprints, op06_toxicity, op07_ngram_join, op08_vantage_points,
    op09_pii, op10_licenses, op11_alignment, op12_collocations, op13_url_filters)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, score double, findings string, copy int, text_hash long"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(text):
    w = words(text)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def corpus(seed=1, n=60):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 8))) for _ in range(150)]
    passage = " ".join(rng.choice(vocab) for _ in range(40))
    base = [" ".join(rng.choice(vocab) for _ in range(rng.choice([4, 30, 90, 200]))) for _ in range(8)]
    rows = []
    for i in range(n):
        t = rng.choice(base).split()
        for _ in range(rng.choice([0, 0, 1, 3])):
            t[rng.randrange(len(t))] = rng.choice(vocab)
        t = " ".join(t)
        if rng.random() < 0.3:
            t = t + "\n" + passage + " " + rng.choice(vocab)
        rows.append((i, t, rng.choice(["a", "b", None])))
    rows += [(n, None, "a"), (n + 1, "", None), (n + 2, " \t\n", "b"), (n + 3, "x", "c"), (5, rows[5][1], rows[5][2]), (6, rows[7][1], "b"),
             (None, rows[3][1], None), (n + 4, "ab" * 3000, "a"), (n + 5, ("ab" * 3000)[1:], "a"),
             (n + 6, "mail a.b@c.de, +1 (234) 555-0000 ip 10.0.0.255 visa 4111 1111 1111 1111 mit license", "b")]
    return rows


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    full = [(i, t, "en", s, len(t or ""), 1, 0.5, "x", 3, 4) for i, t, s in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def key(r):
    return tuple((v is None, v if v is not None else 0) for v in r)


def same(got, expected):
    assert sorted(map(key, map(tuple, got))) == sorted(map(key, expected))


# ------------------------------------------------------------------ op1
def plain_suffix_dedup(rows):
    top = (1 << 63) - 1
    ident = [(top if i is None else i, (t or "")) for i, t, _ in rows]
    raw = [t.encode() for _, t in ident]
    least, first = {}, {}
    for (i, t), b in zip(ident, raw):
        for s in range(len(b) - 99):
            w = b[s:s + 100]
            least[w] = min(least.get(w, top), i)
            first[w, i, t] = min(first.get((w, i, t), s), s)
    out = []
    for (i, t), b, r in zip(ident, raw, rows):
        gone = bytearray(len(b))
        for s in range(len(b) - 99):
            w = b[s:s + 100]
            if least[w] < i or first[w, i, t] < s:
                gone[s:s + 100] = b"\1" * 100
        spans = len(re.findall(b"\1+", bytes(gone)))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((r[0], len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def test_op1_against_all_windows(docs, rows, none):
    same(op01_suffix_dedup.digests(docs).collect(), plain_suffix_dedup(rows))
    assert op01_suffix_dedup.digests(none).collect() == []


def test_op1_merge_never_loses_order():
    rng = random.Random(2)
    for _ in range(100):
        runs = []
        for _ in range(rng.randint(1, 9)):
            lines = sorted(bytes(rng.choice(b"ab\0") for _ in range(rng.randint(0, 9))) for _ in range(rng.randint(0, 20)))
            runs.append((lines, op01_suffix_dedup.shared_prefixes(lines).tolist()))
        out = list(op01_suffix_dedup.merge(runs))
        lines = [runs[r][0][i] for r, i, _ in out]
        assert lines == sorted(x for r in runs for x in r[0])
        assert [n for *_, n in out] == op01_suffix_dedup.shared_prefixes(lines).tolist()


# ------------------------------------------------------------------ op2
def test_op2_targets_and_cap(docs, rows, none):
    got = op02_mixing.digests(docs).collect()
    sizes = [len(words(t)) for _, t, _ in rows]
    assert sorted(r["size"] for r in got) == sorted(sizes)
    assert all(r["taken"] <= 3 * r["size"] and (not r["size"] or r["taken"] % r["size"] == 0) for r in got)
    assert sorted(map(tuple, got), key=key) == sorted(map(tuple, op02_mixing.digests(docs.repartition(5)).collect()), key=key)
    by = {}
    for r in got:
        by.setdefault((r["source_size"], r["target"]), []).append(r)
    assert abs(sum(t for _, t in by) - sum(sizes)) < 1e-6 * sum(sizes)
    for (_, target), members in by.items():
        assert abs(sum(r["taken"] for r in members) - target) <= max(r["size"] for r in members)
    assert op02_mixing.digests(none).collect() == []


def test_op2_targets_reshare_excess():
    assert op02_mixing.targets([("a", 10), ("b", 10), ("c", 80)], [5, 2, 1], 3) == [30.0, 30.0, 40.0]


def test_op2_flow_prefers_first_uses_and_shares_overlaps():
    # pattern 0 only in source 0, pattern 1 in both: source 1 can only be filled by pattern 1
    flow = op02_mixing.min_cost_flow([((0,), 10), ((0, 1), 10)], [10, 10], 3)
    assert flow == {(0, 0): 10, (1, 1): 10}
    assert sum(op02_mixing.min_cost_flow([((0,), 10)], [50], 3).values()) == 30


# ------------------------------------------------------------------ op3
@pytest.fixture(scope="module")
def ranks():
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def test_op3_equals_the_library_and_round_trips(docs, rows, none, ranks):
    codec = op03_byte_bpe.Codec.get(*ranks)
    expected = []
    for i, t, _ in rows:
        ids = np.array(codec.bpe.encode_ordinary(t or ""), "<u4")
        expected.append((i, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    same(op03_byte_bpe.digests(docs, *ranks).collect(), expected)
    same(op03_byte_bpe.digests(docs, *ranks, chunk_chars=50, overlap=20).collect(), expected)
    assert op03_byte_bpe.digests(none, *ranks).collect() == []


def test_op3_stitch_of_any_cut(ranks):
    codec, rng = op03_byte_bpe.Codec.get(*ranks), random.Random(4)
    for _ in range(400):
        alphabet = rng.choice(["ab 1'.\n  ", "a", "  ", "é1 \t'sre", "1234567890", " .,!?'ll ve", "²½३a_ "])
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 200)))
        size, over = rng.choice([(10, 3), (20, 8), (7, 1)])
        parts = [(k, text[k * size: k * size + size + over]) for k in range(max(1, -(-len(text) // size)))]
        assert op03_byte_bpe.stitch(codec, parts, size) == np.array(codec.bpe.encode_ordinary(text), "<u4").tobytes()


# ------------------------------------------------------------------ op4
def test_op4_finds_tokens_and_spares_digests(spark, none):
    rng = random.Random(5)
    vocab = ["".join(rng.choice("abcdefghil") for _ in range(rng.randint(3, 9))) for _ in range(200)]
    prose = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    hexa = lambda: hashlib.sha1(str(rng.random()).encode()).hexdigest()
    rows = []
    for i in range(150):
        h = hexa()
        rows.append((i, f'{prose(30)} token = "{h}" {prose(20)}' if i % 3 == 0 else f"{prose(30)} commit {h} {prose(20)}" if i % 3 == 1 else
                     f"{prose(20)} {'verylong' * 3} {prose(30)}"))
    rows += [(200, None), (201, ""), (0, rows[0][1]), (202, "a" * 50000)]
    got = op04_secrets.digests(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] < 150:
            assert r["n_secrets"] == int(r["doc_id"] % 3 == 0), r
        elif r["doc_id"] in (200, 201):
            assert r["n_candidates"] == 0 and r["spans"] == ""
    assert op04_secrets.digests(none).collect() == []


def test_op4_counts_the_words_of_all_documents(spark, monkeypatch):
    rows = [(i, "common plain words") for i in range(op04_secrets.SAMPLE_DOCS + 100)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    sampled = {r["doc_id"] for r in op04_secrets.sample_docs(d).collect()}
    out = next(i for i, _ in rows if i not in sampled)
    d = d.withColumn("text", F.when(F.col("doc_id") == out, "jargon " * 900).otherwise(F.col("text")))
    used = {}
    monkeypatch.setattr(op04_secrets, "train", lambda findings, words, pairs: used.update(words=words, pairs=pairs))
    assert op04_secrets.digests(d).count() == len(rows)
    assert used["words"] == ["jargon", "common", "plain", "words"] and {"ja", "rg"} <= set(used["pairs"])


# ------------------------------------------------------------------ op5
def test_op5_edits_and_likeness(docs, rows, none):
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    got = sorted(op05_fingerprints.digests(docs).collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["fingerprint"]))
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    prints = {}
    for k, (i, t, _) in enumerate(order):
        t, after = t or "", order[(k + 1) % len(order)][1] or ""
        cut = len(t) // 4
        edited = t[:len(t) - cut] + after[:cut]
        mine = [r for r in by[i] if r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()]
        assert mine and mine[0]["n_chars"] == len(t)
        for name, other in (("near_edited", edited), ("near_next", after)):
            a, b = shingles(t), shingles(other)
            assert abs(mine[0][name] - (len(a & b) / len(a | b) if a | b else 1.0)) < 0.2
        assert prints.setdefault(t, mine[0]["fingerprint"]) == mine[0]["fingerprint"]
    assert len(got) == len(rows)
    assert op05_fingerprints.digests(none).collect() == []


def test_op5_merge_is_the_sketch_of_the_whole(spark):
    parts = [" ".join(f"w{i * 7 % 501}" for i in range(a, a + 300)) for a in (0, 200, 400)]
    df = spark.createDataFrame([(1, p) for p in parts], "k int, text string")
    one = op05_fingerprints.merge_by(op05_fingerprints.fingerprints(df, keep=("k",)), "k").first()["fingerprint"]
    union = set().union(*map(shingles, parts))
    assert abs(op05_fingerprints.distinct(op05_fingerprints.read(one)) - len(union)) < 0.3 * len(union)
    a = op05_fingerprints.read(op05_fingerprints.fingerprints(df.limit(1), keep=("k",)).first()["fingerprint"])
    assert op05_fingerprints.containment(a, op05_fingerprints.read(one)) > 0.8
    assert op05_fingerprints.written(op05_fingerprints.read(one)) == one


# ------------------------------------------------------------------ op6
def test_op6_held_out_accuracy_and_no_leak(spark, none):
    rng = random.Random(6)
    vocab = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 8))) for _ in range(300)]
    rows, labels = [], []
    for i in range(400):
        w = [rng.choice(vocab) for _ in range(60)]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(4):
                w[rng.randrange(60)] = rng.choice(["nastiest", "n4stiest", "vilestuff", "VILESTUFF"])
        rows.append((i, " ".join(w)))
        if i % 2 == 0:
            labels.append((i, int(toxic)))
    rows += [(1000, None), (1001, ""), (1002, "nаstiest n@stiest vilestuff")]          # a Cyrillic letter
    d, lab = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in op06_toxicity.digests(d, lab).collect()}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    assert sum(got[i]["predicted"] == int(i % 4 == 0) for i in range(400)) > 392
    assert got[1002]["predicted"] == 1 and got[1000]["predicted"] == 0 and got[1000]["score"] == got[1001]["score"]
    # labels of held-out rows change nothing
    flipped = spark.createDataFrame([(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in labels], "doc_id long, toxic int")
    again = {r["doc_id"]: r["score"] for r in op06_toxicity.digests(d, flipped).collect()}
    assert again == {i: r["score"] for i, r in got.items()}
    empty = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r["predicted"] for r in op06_toxicity.digests(d, empty).collect()} == {0}
    assert op06_toxicity.digests(none, lab).collect() == []


def test_op6_folding_is_linear_and_keeps_plain_text():
    assert op06_toxicity.fold("Idi0t, 5cum! the$$$ 1234 x") == " idiot scum the x "
    assert len(op06_toxicity.fold("0" * 300000 + "a" * 300000)) > 0


def test_op6_rare_class_is_learned_from_a_bounded_sample(spark):
    rng = random.Random(66)
    vocab = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 8))) for _ in range(300)]
    made = lambda toxic: " ".join([rng.choice(vocab) for _ in range(40)] + ["nastiest vilestuff"] * toxic)
    rows = [(i, made(i % 100 == 0)) for i in range(2000)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 100 == 0)) for i in range(1600)], "doc_id long, toxic int")
    sample = op06_toxicity.training_rows(d, labels, most=60, held_out=F.lit(False))
    assert {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()} == {1: 16, 0: 44}
    got = {r["doc_id"]: r["score"] for r in op06_toxicity.score(d, op06_toxicity.learn(sample)).collect()}
    assert all((got[i] >= 0.5) == (i % 100 == 0) for i in got)
    # a text without entries scores by the labelled share of the class, not by the sample's
    assert sorted(got.values())[1000] < 0.05


def test_op6_the_bound_is_on_rows_of_the_sample(spark):
    rows = [(i, f"text {i}") for i in range(20)] + [(3, "text 3")] * 50 + [(4, f"other {k}") for k in range(30)] + [(5, None), (5, "")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)] + [(i, 1) for i in range(100, 400)], "doc_id long, toxic int")
    none_held = {"held_out": F.lit(False)}
    every = op06_toxicity.training_rows(d, labels, **none_held)
    assert sorted(r["text"] for r in every.collect()) == sorted(t for _, t in {(i, t or "") for i, t in rows})
    for most in (8, 30):
        sample = op06_toxicity.training_rows(d, labels, most=most, **none_held)
        assert sample.count() == most and {r["label"] for r in sample.collect()} == {0, 1}


# ------------------------------------------------------------------ op7
def plain_components(rows):
    sets = [shingles(t) for _, t, *_ in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[root(i)] = min(least.get(root(i), r[0]), r[0])
    return [(r[0], len(sets[i]), least.get(root(i))) for i, r in enumerate(rows)]


@pytest.mark.parametrize("family_tokens", [1 << 20, 150])
def test_op7_components(docs, rows, family_tokens):
    same(op07_ngram_join.join(docs, family_tokens=family_tokens, hot_tokens=20).collect(), plain_components(rows))


def test_op7_one_of_each_group(docs, rows, none):
    kept = op07_ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns
    filled = [r for r in kept.collect() if words(r["text"])]
    components = plain_components(rows)
    assert len(filled) == len({root for (_, n, root) in components if n})
    assert sum(1 for r in kept.collect() if not words(r["text"])) == sum(1 for _, n, _ in components if not n)
    assert op07_ngram_join.join(none).collect() == []


def test_op7_null_ids_link_by_their_own_texts(spark):
    run = lambda c, n: [f"{c}{i}" for i in range(n)]
    one, bridge, alone = run("w", 200), run("b", 100), run("z", 50)
    near = ["x" if i == 20 else w for i, w in enumerate(one)]
    rows = [(1, one), (None, near), (2, bridge + run("l", 15)), (None, bridge), (3, run("r", 15) + bridge), (None, alone), (None, alone + ["y"])]
    rows = [(i, " ".join(t)) for i, t in rows] + [(4, None), (None, "")]
    left, right = shingles(rows[2][1]), shingles(rows[4][1])
    assert 100 * len(left & right) < 80 * len(left | right)          # 2 and 3 link by the text without id only
    expected = plain_components(rows)
    assert expected[1][2] == 1 and expected[4][2] == 2
    d = spark.createDataFrame(rows, "doc_id long, text string")
    same(op07_ngram_join.join(d).collect(), expected)
    kept = [(r["doc_id"], r["text"]) for r in op07_ngram_join.one_of_each(d).collect()]
    assert sorted(i for i, t in kept if t and i) == [1, 2] and sum(1 for i, t in kept if i is None and t) == 1


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(7, 7)]
    got = dict(map(tuple, graph.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert all(got[i] == 0 for i in range(201)) and all(got[1000 + i] == 1000 for i in range(300))


def test_op7_only_likely_carriers_are_shuffled(spark):
    """No wanted row is lost, also without an id or repeated; of the others few come through, also of those with a wanted text."""
    rows = [(i, f"text {i % 1500}") for i in range(3000)] + [(None, "text 5"), (None, "x"), (7, "text 7")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("text_hash", op07_ngram_join.text_hash())
    wanted = docs.where("doc_id % 100 = 7 or (doc_id is null and text = 'x')").distinct().select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"))
    got = op07_ngram_join._likely(docs, ["doc_id", "text_hash"], wanted, ["__id", "__hash"])
    found = [(r["doc_id"], r["text"]) for r in got.collect()]
    assert got.columns == docs.columns
    assert [x for x in rows if (x[0] or 0) % 100 == 7 or x == (None, "x")] == [x for x in rows if x in set(found) and ((x[0] or 0) % 100 == 7 or x == (None, "x"))]
    assert found.count((7, "text 7")) == 2 and len(found) < 60


# ------------------------------------------------------------------ op8
def test_op8_exact_and_relaxed(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(900, 12)).astype("float32")
    x[100:140] = x[100]
    rows = [(i, [float(v) for v in x[i]], 0) for i in range(900)]
    rows += [(2000, None, 0), (2020, [0.0] * 12, 0), (2040, [float("nan")] * 12, 0), (2060, [1.0] * 11 + [None], 0), (2080, [1.0, 2.0], 0), (None, [1.0] * 12, 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")
    asked = df.where("vec_id % 20 = 0")
    got = {}
    for r in op08_vantage_points.search(df, asked, shard_rows=300).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    y = x.astype(float)
    for q in range(0, 900, 20):
        s = sorted(((-float(np.cumsum(y[q] * y[i])[-1]), i) for i in range(900) if i != q))[:20]
        assert [i for _, i in s] == [v for v, _ in got[q]]
        assert np.allclose([-v for v, _ in s], [v for _, v in got[q]], atol=1e-12)
    assert set(got) == set(range(0, 900, 20))          # 2080 has no other vector of its length
    near = {}
    for r in op08_vantage_points.search(df, asked, shard_rows=300, factor=3.0).collect():
        near.setdefault(r["query_id"], set()).add(r["vec_id"])
    recall = np.mean([len(near[q] & {v for v, _ in got[q]}) / 20 for q in got])
    assert recall > 0.8
    assert op08_vantage_points.digests(df.limit(0)).collect() == []


# ------------------------------------------------------------------ op9
def plain_pii(text):
    text, out = text or "", {"email": [], "ip": [], "card": [], "phone": []}
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out["email"].append(m.span())
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out["ip"].append(m.span())
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()][::-1]
        if 16 <= len(d) <= 19 and sum(v if i % 2 == 0 else v * 2 - 9 * (v > 4) for i, v in enumerate(d)) % 10 == 0:
            out["card"].append(m.span())
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
            out["phone"].append(m.span())
    return out


def test_op9_against_plain_patterns(spark, docs, rows, none):
    rng = random.Random(9)
    more = [(500 + i, "".join(rng.choice("a1.@+- (2)_%é😀\n4") for _ in range(rng.randint(1, 80)))) for i in range(300)]
    more += [(900, "x" * 30000), (901, "1" * 30000), (902, "a.b." * 8000), (903, "1." * 9000), (904, "a@" + "b." * 9000 + "c"), (905, "+1" + " " * 20000),
             (906, "call 415-555-0199 now, iban DE89 3704 0044 0532 0130 00."), (907, "415-555-0199")]
    every = [(i, t) for i, t, _ in rows] + more
    got = {}
    for r in op09_pii.digests(spark.createDataFrame(every, "doc_id long, text string")).collect():
        got.setdefault(r["doc_id"], []).append(r)
    for i, t in every:
        found = plain_pii(t)
        line = ",".join(f"{k}:{a}:{b}" for k, spans in found.items() for a, b in spans)
        assert any(r["base_sha256"] == hashlib.sha256(line.encode()).hexdigest() and [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]]
                   == [len(v) for v in found.values()] and r["spans"].startswith(line) for r in got[i]), (i, t, got[i])
    assert "tel:5:17" in got[906][0]["spans"] and "iban:28:55" in got[906][0]["spans"] and got[907][0]["spans"] == ""
    red = [r["text"] for r in op09_pii.redacted(docs).where("text like 'mail%'").collect()]
    assert red == ["mail <EMAIL>, <PHONE> ip <IP> visa <CARD> mit license"]
    assert op09_pii.redacted(docs).columns == docs.columns and op09_pii.digests(none).collect() == []


def test_op9_ibans_before_other_groups(spark):
    cases = {
        "iban BE68 5390 0754 7034 2024": [(5, 24)], "iban AT61 1904 3002 3457 3201 BANK": [(5, 29)], "iban BE68539007547034 2024 AB": [(5, 21)],
        "konto BE68 5390 0754 7034 AT61 1904 3002 3457 3201": [(6, 25), (26, 50)], "iban AB12 3456 7890 DE89 3704 0044 0532 0130 00.": [(20, 47)],
        "iban BE685390075470342024": [], "iban BE68 5390 0754 7035 2024": [], "iban BE68 5390 0754 7034": [(5, 24)], "": [], None: [],
    }
    df = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    for r in op09_pii.findings(df).collect():
        assert [(x["start"], x["end"]) for x in r["findings"] if x["kind"] == "iban"] == cases[r["text"]], r


# ------------------------------------------------------------------ op10
def test_op10_places_and_expressions(spark, docs, rows, none):
    cases = {
        "The MIT-License; and (mit  LICENSE)": (["mit", "mit"], {"mit"}),
        "GNU General Public License, apache\nlicense": (["gpl", "apache"], {"gpl", "apache"}),
        "licensed under CC BY-NC 4.0": (["cc-by"], {"cc-by", "cc-by-nc"}),
        "permit license": ([], set()), "": ([], set()), None: ([], set()),
        "// SPDX-License-Identifier: (MIT OR GPL-2.0-only) AND Apache-2.0 WITH LLVM-exception": ([], {"mit", "gpl", "apache"}),
    }
    df = spark.createDataFrame(list(enumerate(cases)), "doc_id int, text string")
    got = {r["doc_id"]: r for r in op10_licenses.scan(df).collect()}
    for k, (text, (base, labels)) in enumerate(cases.items()):
        assert sorted(p["label"] for p in got[k]["base_places"]) == sorted(base) and set(got[k]["labels"]) == labels, text
        assert got[k]["n_words"] == len(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")))
        assert 0 <= got[k]["score"] <= 1
    assert got[0]["first_word"] == 1 and got[0]["last_word"] == 4 and got[6]["openness"] == 1.0
    assert op10_licenses.digests(none).collect() == [] and op10_licenses.digests(docs).count() == len(rows)


def test_op10_expressions_of_any_length():
    found = op10_licenses.automaton()
    tag = "SPDX-License-Identifier: "
    long = tag + "MIT AND " * 100_000 + "GPL-2.0-only\nAND Apache-2.0"
    _, _, labels, openness = op10_licenses.scan_text(long.encode(), found)
    assert set(labels) == {"mit", "gpl"} and openness == 0.4
    _, _, labels, openness = op10_licenses.scan_text((tag + "(MIT) */ " + "x" * 500 + " " + tag + "\n" + tag + "EPL-2.0").encode(), found)
    assert set(labels) == {"mit", "epl"} and openness == 0.6
    _, _, labels, _ = op10_licenses.scan_text((" OR ".join(f"{tag}X-{i}" for i in range(20_000))).encode(), found)
    assert len(labels) > 1


@pytest.mark.parametrize(("text", "tokens"), [
    ("MIT OR Apache-2.0 AND BSD-3-Clause", ["MIT", "Apache-2.0", "BSD-3-Clause", "and", "or"]),
    ("(MIT OR Apache-2.0) AND BSD-3-Clause", ["MIT", "Apache-2.0", "or", "BSD-3-Clause", "and"]),
    ("GPL-2.0 WITH Classpath-exception-2.0 OR MIT", ["GPL-2.0", "Classpath-exception-2.0", "with", "MIT", "or"]),
    ("MIT AND", ["MIT"]), ("((MIT", ["MIT"]), ("MIT some words", ["MIT"]),
])
def test_op10_shunting_yard(text, tokens):
    assert op10_licenses.postfix(text) == tokens


def test_op1_rows_of_one_id_with_equal_checksums(spark):
    rng, seen, pair = random.Random(3), {}, None
    while pair is None:
        t = "".join(rng.choices("abcdefgh", k=137))
        other = seen.setdefault(zlib.crc32(t.encode()), t)
        pair = (other, t) if other != t else None
    rows = [(1, pair[1], "x"), (None, pair[0], "x"), (None, pair[1], "x")]
    got = op01_suffix_dedup.digests(spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")).collect()
    same(got, plain_suffix_dedup(rows))


# ------------------------------------------------------------------ dense hits in long texts
def test_dense_hits_take_linear_time():
    import time
    t0 = time.perf_counter()
    found = op10_licenses.automaton()
    n, base, _, _ = op10_licenses.scan_text(b"mit license, x " * 200_000, found)
    assert n == 600_000 and [w for w, _ in base] == list(range(0, 600_000, 3))
    lexicon = ahocorasick.Automaton()
    for word, entry in ((" bad", (4, 1.0, False)), (" not bad", (8, 0.0, True))):
        lexicon.add_word(word, entry)
    lexicon.make_automaton()
    assert op06_toxicity.hits(" bad not bad x" * 100_000 + " ", lexicon) == (400_000, 100_000.0, 100_000)
    assert time.perf_counter() - t0 < 30


# ------------------------------------------------------------------ op11
A11, B11 = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def plain_alignment(rows):
    """Both tokenizers on whole texts, links by walking the byte ranges."""
    a_tok = tokenizers.Tokenizer.from_file(A11)
    a_tok.encode_special_tokens = True
    b_tok = sentencepiece.SentencePieceProcessor(model_file=B11)
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(x for x in range(256) if x not in printable)}
    docs = []
    for i, t in rows:
        a, b = (a_tok.encode(" " + t, add_special_tokens=False).ids, b_tok.encode(t)) if t else ([], [])
        raw_a = [bytes(byte_of[c] for c in a_tok.id_to_token(x)) for x in a]
        raw_b = [bytes([int(b_tok.id_to_piece(x)[3:5], 16)]) if b_tok.is_byte(x) else b_tok.id_to_piece(x).replace("▁", " ").encode() for x in b]
        if not t or not b"".join(raw_a) == b"".join(raw_b) == (" " + t).encode():
            docs.append((i, [], [], [], []))
            continue
        ends_a, ends_b = list(itertools.accumulate(map(len, raw_a))), list(itertools.accumulate(map(len, raw_b)))
        groups, links, p, q = [], [], 0, 0
        for cut in sorted(set(ends_a) & set(ends_b)):
            p2, q2 = ends_a.index(cut, p) + 1, ends_b.index(cut, q) + 1
            groups.append((a[p:p2], b[q:q2]))
            links += [(a[x], b[y]) for x in range(p, p2) for y in range(q, q2)
                      if ends_a[x] - len(raw_a[x]) < ends_b[y] and ends_b[y] - len(raw_b[y]) < ends_a[x]]
            p, q = p2, q2
        docs.append((i, a, b, groups, links))
    count = collections.Counter(link for *_, links in docs for link in set(links))
    highest = {}
    for (x, _), n in count.items():
        highest[x] = max(highest.get(x, 0), n)
    return [(i, len(a), len(b), len(g), len(ls), sum(count[x] == highest[x[0]] for x in ls), sum(count[x] for x in ls),
             hashlib.sha256(";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g).encode()).hexdigest() if a else "",
             sum(len(x) * len(y) for x, y in g)) for i, a, b, g, ls in docs]


def test_op11_against_whole_texts(spark, rows, docs, none):
    same(op11_alignment.digests(docs, A11, B11).collect(), plain_alignment([(i, t) for i, t, _ in rows]))
    assert op11_alignment.digests(none, A11, B11).collect() == []
    assert op11_alignment.links(docs, A11, B11, keep=("doc_id", "size", "findings")).columns[:3] == ["doc_id", "size", "findings"]


def test_op11_units_are_exact_on_odd_texts(spark):
    rng = random.Random(5)
    parts = ["a", "the", "  ", " ", "\n", "\t", "\x1c", "\u00a0", "\u2009", "\u3000", "é", "日本", "'s", "12", "…", "▁", "<s>", "<|endoftext|>", "\x00", "👍🏽", " \n ", "ﬁ"]
    odd = [(k, "".join(rng.choice(parts) for _ in range(rng.randint(0, 30)))) for k in range(1500)] + [(9000, None), (9001, "   "), (9002, "x" * 90_000), (9002, "x" * 90_000)]
    got = op11_alignment.digests(spark.createDataFrame(odd, "doc_id long, text string").repartition(3), A11, B11, chunk_bytes=3000).collect()
    same(got, plain_alignment(odd))


def test_op11_row_products():
    rng = np.random.default_rng(1)
    for _ in range(30):
        x, y = (rng.random((rng.integers(1, 8), 5)) < 0.4 for _ in range(2))
        a, b = (op11_alignment.CSR(np.concatenate([[0], np.cumsum(m.sum(1))]), np.nonzero(m)[1], 5) for m in (x, y))
        c = a.times(b.transposed())
        got = np.zeros((len(x), len(y)), bool)
        got[np.repeat(np.arange(len(x)), np.diff(c.indptr)), c.indices] = True
        assert (got == (x.astype(int) @ y.T.astype(int) > 0)).all()


# ------------------------------------------------------------------ op12
def plain_collocations(rows, support=30, top=2000):
    f, n = collections.Counter(), collections.Counter()
    for _, t, lang in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        for piece in re.split("[.,;:!?\\x0a-\\x0d]", low):
            w = re.findall("[^\\x20\\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i:i + k])) for k in range(1, 5) for i in range(len(w) - k + 1))
    found = {}
    for (lang, p), a in f.items():
        if len(p) > 1 and a >= support:
            found[lang, p] = min((2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p)))
    out = []
    for (lang, p), (score, k) in found.items():
        a = f[lang, p]
        if not any(100 * f[lang, q] >= 80 * a for other, q in found if other == lang and len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q)))):
            out.append((lang, -score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    ranked, last, rank = [], None, 0
    for lang, score, a, phrase, left, right in sorted(out):
        last, rank = lang, rank + 1 if lang == last else 1
        if rank <= top:
            ranked.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return ranked


def collocation_rows():
    rng = random.Random(11)
    vocab = ["New", "york", "times", "sq", "the", "of", "É", "x\x1fy", "a\u00a0b"]
    text = lambda m: "".join(rng.choice(vocab) + rng.choice([" ", " ", " ", "  ", "\t", ". ", "\n", "; ", ","]) for _ in range(m))
    rows = [(i, text(rng.randint(0, 60)), rng.choice(["en", "en", None, "und", ""])) for i in range(250)]
    rows += [(i, "new york times " * 20, "en") for i in range(3)] + [(7, None, "en"), (8, "", "fr"), (9, "...", "de"), (10, "z " * 9000, "en"), (None, "z z", None)]
    return rows


@pytest.mark.parametrize("chunk,each", [(100, 16), (5000, 500), (8 << 20, 1 << 20)])
def test_op12_against_all_phrases(spark, chunk, each):
    rows = collocation_rows()
    df = spark.createDataFrame([(i, t, x, 5, "z") for i, t, x in rows], "doc_id long, text string, lang string, n int, phrase string").repartition(3)
    got = op12_collocations.digests(df, chunk_bytes=chunk, pairs_each=each).collect()
    assert len(got) > 20
    same(got, plain_collocations(rows))
    assert op12_collocations.digests(df.limit(0)).collect() == []
    assert op12_collocations.digests(df, support=10**6).collect() == []


@pytest.mark.parametrize("each", [16, 1 << 20])
def test_op12_leaves_out_rare_pairs_before_they_are_counted(spark, each):
    """Every pair that occurs often enough comes out with its whole count, rare ones do not."""
    df = spark.createDataFrame(collocation_rows(), "doc_id long, text string, lang string").repartition(3)
    first = op12_collocations.occurrences(df, chunk_bytes=2000)
    frequent = op12_collocations.counted(first, ("lang", "word"), 60)
    word = {r["name"]: (r["lang"], r["word"]) for r in frequent.where("f is not null").collect()}
    pairs = op12_collocations.extended(first, frequent, 60, each).where("places is null").groupBy("head", "tail").agg(F.sum("n").alias("n")).collect()
    expected = collections.Counter()
    for _, t, lang in collocation_rows():
        for piece in re.split("[.,;:!?\\x0a-\\x0d]", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")):
            w = re.findall("[^\\x20\\x09]+", piece)
            expected.update((lang if lang is not None else "und", *p) for p in zip(w, w[1:]))
    got = {(word[r["head"]][0], word[r["head"]][1], word[r["tail"]][1]): r["n"] for r in pairs}
    assert got == {k: n for k, n in expected.items() if n >= 60} and len(got) < len(expected)


def test_op12_item_tables_are_rows_of_ranges(spark):
    """A chunk's items travel packed: a row for each range (and lang), however many words and pairs there are."""
    rng = random.Random(5)
    df = spark.createDataFrame([(" ".join(f"w{rng.randrange(120)}" for _ in range(400)), "en" if i % 2 else "de") for i in range(60)], "text string, lang string").coalesce(1)
    first = op12_collocations.occurrences(df)
    assert first.where("places is null").count() == 2
    frequent = op12_collocations.counted(first, ("lang", "word"), 2)
    assert frequent.where("f is not null").count() == 240 and frequent.where("f is null").count() == 2
    second = op12_collocations.grown(first, frequent, 2)
    assert second.count() == 2
    pairs = op12_collocations.counted(second, ("head", "tail"), 2)
    assert pairs.where("f is not null").count() > 1000 and pairs.where("f is null").count() == 1


def test_op12_score_is_exact_beyond_64_bits(spark):
    big = 9_000_000_000_000_000_003
    row = spark.createDataFrame([(big, big, big - 2)], "a long, l long, r long").select(op12_collocations.score_of(*map(F.col, "alr")).alias("s")).first()
    assert row["s"] == 2_000_000 * big // (2 * big - 2)


# ------------------------------------------------------------------ op13
PAGES = [
    (1, "http://a.net/x", "<html><head><link rel=\"canonical\" href='http://b.com/de/1?q=2&amp;r=3'></head>"),
    (2, "https://B.com/de/1?q=2&r=3#f", None),                                       # blocked by rule
    (3, "http://c.net/y", "<meta http-equiv='refresh' content='0; url=//a.net/x'>"),   # alias of 1
    (4, "http://c.net/dir/z", "<LINK href=w REL=canonical />"),                        # relative
    (5, "http://c.net/dir/w", ""), (6, None, "<link rel=canonical href=http://b.com/de/1>"), (7, "nourl", None),
    (8, "http://example.org/es/1", "<link rel=canonical href=/en/22>"),                # a block and an allow in one class
    (9, "http://example.org/en/22", "x"),
    (10, "http://d.net/?a", "<!-- <link rel=canonical href=http://b.com/de/9> -->"),
    (11, "http://e.net/q", "<script>x='<link rel=canonical href=http://fine.net/>'</script><link rel=canonical href=http://b.com/de/9>"),
    (12, "http://b.com/de/7", "<link rel=canonical href=http://x.net/>"), (13, "http://x.net/", ""), (13, "http://x.net/", ""),
    (14, "http://org", "x"), (15, "http://a.example.org/en/1?x", "x"), (16, "http://a.example.org:80/en/1?x", "x"), (17, "http://U@ORG/en", "x"),
    (18, "a://b://c/org/", "x"), (19, "http://h.net/a/b/c", "<meta http-equiv=refresh content=5>"), (20, "http://notorg/", ""),
    (21, "http://y.net/p", "<link rel=canonical href=http://x.com/fr/>"), (22, "http://y.net/q", "<link rel=canonical href=/p><link rel=canonical href=http://b.com/de/3>"),
]
VERDICTS = {1: "block", 2: "block", 3: "block", 8: "block", 9: "allow", 11: "block", 12: "block", 13: "block", 15: "block", 21: "allow", 22: "allow"}


def test_op13_decisions_and_duckdb(spark):
    import duckdb
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumns({"host": F.lit("x"), "rule": F.lit(1), "node": F.lit(2)})
    got = op13_url_filters.digests(df).collect()
    assert {r["page_id"]: r["verdict"] for r in got} == {i: VERDICTS.get(i, "allow") for i, *_ in PAGES}
    assert {r["page_id"]: r["rule"] for r in got if r["rule"]} == {2: "com/de/", 8: "example.org/es/", 9: "org/", 12: "com/de/", 15: "example.org/en/1"}
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", PAGES)
    same(got, con.execute(op13_url_filters.oracle_sql()).fetchall())
    assert op13_url_filters.digests(df.limit(0)).collect() == []


def test_op13_crawled_redirects_and_dots(spark):
    pages = spark.createDataFrame([(1, "http://a.net/1", ""), (2, "http://a.net/2", "<link rel=canonical href='../x/./y'>"), (3, "http://a.net/x/y", "")], "page_id long, url string, html string")
    moved = spark.createDataFrame([("http://a.net/1", "https://b.com/de/"), (None, "http://z.net/"), ("http://a.net/x/y", "http://a.net/1")], "source string, target string")
    assert {r["page_id"]: r["verdict"] for r in op13_url_filters.judge(pages, redirects=moved).collect()} == {1: "block", 2: "block", 3: "block"}
    assert {r["verdict"] for r in op13_url_filters.judge(pages, redirects=moved, html=None).collect() if r["page_id"] == 2} == {"allow"}
