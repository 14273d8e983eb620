"""Operators that compare rows with each other, against brute force, and the pipeline."""

import hashlib
import itertools
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from starmart.llm import mixing, neighbours, registry, simhash, suffix_dedup
from starmart.llm.components import components

SF = "/root/testdata/sf0.001"


class Groups:
    def __init__(self):
        self.up = {}

    def root(self, x):
        while self.up.setdefault(x, x) != x:
            x = self.up[x]
        return x

    def link(self, a, b):
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)


@pytest.mark.parametrize("edges", [[], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 30)], [(5, 5), (9, 7), (7, 8), (-3, 8), (2, 1)]])
def test_components(spark, edges):
    want = Groups()
    for a, b in edges:
        if a != b:
            want.link(a, b)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: want.root(x) for x in want.up}


def test_near_fingerprints_meet_and_far_ones_do_not(spark):
    draw = random.Random(3)
    prints = set()
    for _ in range(40):
        x = draw.getrandbits(64)
        prints.add(x)
        for _ in range(3):
            for b in draw.sample(range(64), draw.choice([1, 2, 3])):
                x ^= 1 << b
            prints.add(x)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    got = Groups()
    for r in simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long")).collect():
        assert ((r.a ^ r.b) & (2**64 - 1)).bit_count() <= 2
        got.link(r.a, r.b)
    want = Groups()
    for a in signed:
        for b in signed:
            if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 2:
                want.link(a, b)
    assert {x: got.root(x) for x in signed} == {x: want.root(x) for x in signed}


def test_near_duplicates_of_rows(docs):
    long_text = " ".join(f"word{i}" for i in range(4000))
    df = docs((5, None), (3, ""), (9, " \t "), (7, "One  two three"), (2, "one two\nTHREE"), (None, "one two three"), (1, long_text), (4, long_text + " more"), (4, "alone"), (4, "alone"), fp=1, node=2, component_id=3)
    rows = Counter((r.doc_id, r.component_id) for r in simhash.near_duplicates(df).collect())
    assert rows == {(5, 3): 1, (3, 3): 1, (9, 3): 1, (7, 2): 1, (2, 2): 1, (None, 2): 1, (1, 1): 1, (4, 1): 1, (4, 4): 2}
    assert simhash.simhash("") == 0 and simhash.simhash("É é") != simhash.simhash("é é")
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert Counter((r.doc_id, (r.text or "")[:9]) for r in kept.collect()) == {(3, ""): 1, (2, "one two\nT"): 1, (1, "word0 wor"): 1, (4, "alone"): 1}
    assert simhash.near_duplicates(df.limit(0)).count() == 0 and simhash.keep_one(df.limit(0)).count() == 0


# Repeated passages ------------------------------------------------------


def brute_force(texts):
    """(n_bytes, spans, kept) of texts in order."""
    met, out = set(), []
    for raw in texts:
        gone = np.zeros(len(raw) + 1, dtype=int)
        for p in range(len(raw) - 99):
            s = raw[p : p + 100]
            if s in met:
                gone[p : p + 100] = 1
            met.add(s)
        edges = np.flatnonzero(np.diff(np.concatenate(([0], gone))))
        out.append((len(raw), list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)), bytes(b for b, g in zip(raw, gone, strict=False) if not g)))
    return out


def passages(seed, n):
    draw = random.Random(seed)

    def prose(k):
        return " ".join("".join(draw.choices("abcdé", k=draw.randint(2, 9))) for _ in range(k))

    shared = [prose(draw.randint(12, 60)) for _ in range(4)]
    texts = []
    for i in range(n):
        parts = [draw.choice(shared) if draw.random() < 0.5 else prose(draw.randint(1, 40)) for _ in range(draw.randint(1, 5))]
        texts.append(draw.choice(["", " "]).join(parts))
        if i % 9 == 0:
            texts[-1] = draw.choice(texts)
        if i % 13 == 0:
            texts[-1] = "That " * draw.randint(5, 200) + prose(5)
    return texts


def removed(df):
    return [(r.doc_id, r.n_bytes, [(s.start, s.end) for s in r.spans], bytes(r.kept)) for r in suffix_dedup.without_repeats(df).collect()]


@pytest.mark.parametrize("hot", [False, True])
def test_repeats_equal_brute_force(docs, monkeypatch, hot):
    if hot:
        monkeypatch.setattr(suffix_dedup, "KEY_CONTENTS", 2)
    texts = [*passages(7, 60), "x" * 5000, "x" * 99, "x" * 100, "", "y" * 3000 + "x" * 150]
    df = docs(*enumerate(texts), key="k", content=1, spans=2)
    want = [(i, *w) for i, w in enumerate(brute_force([t.encode() for t in texts]))]
    assert sorted(removed(df)) == want


def test_repeats_of_odd_rows(docs):
    a, b = "some words of a passage " * 6, "other words, quite different ones " * 4
    df = docs((None, a), (2, b), (2, b), (1, a), (3, None))
    got = Counter((i, n, len(kept)) for i, n, _, kept in removed(df))
    first_a, first_b = (len(brute_force([t.encode()])[0][2]) for t in (a, b))
    assert got == {(1, len(a), first_a): 1, (2, len(b), first_b): 1, (2, len(b), 0): 1, (None, len(a), 0): 1, (3, 0, 0): 1}
    assert removed(df.limit(0)) == []


def test_suffix_sort_orders_and_survives_collisions(monkeypatch):
    raw = b"".join(t.encode() for t in passages(11, 25))
    starts = np.arange(len(raw) - 99)
    group = np.zeros(len(starts), dtype=np.int64)

    def classes():
        order, equal = suffix_dedup.SuffixSort(raw).classes(starts, group)
        cut = [raw[i : i + 100] for i in order.tolist()]
        assert [a == b for a, b in zip(cut, cut[1:], strict=False)] == equal[1:].tolist()
        return sorted(order[equal].tolist())

    met, want = set(), []
    for i in starts.tolist():
        if raw[i : i + 100] in met:
            want.append(i)
        met.add(raw[i : i + 100])
    assert classes() == want
    # hashes that often agree by mistake mislead the sort, and verification mends it
    monkeypatch.setattr(suffix_dedup.Hashed, "of", lambda self, start, length: (self.prefix[start + length] - self.prefix[start]) * self.inverse[start] & np.uint64(3))
    assert classes() == want


@pytest.mark.parametrize("collide", [False, True])
def test_many_equal_suffixes_are_merged_with_few_comparisons(monkeypatch, collide):
    draw = random.Random(3)
    raw = b"".join(("a line that comes again\n" * draw.randint(1, 60) + " ".join(t)).encode() for t in zip(*[iter(passages(5, 60))] * 2, strict=True))
    starts = np.arange(len(raw) - 99)
    group = starts % 3 // 2
    of, looked = suffix_dedup.Hashed.of, [0]

    def counted(self, start, length):
        looked[0] += len(start)
        return of(self, start, length) & np.uint64(7 if collide else 2**64 - 1)

    monkeypatch.setattr(suffix_dedup.Hashed, "of", counted)
    if differing := getattr(suffix_dedup.SuffixSort, "differing", None):

        def compared(self, x, y):
            looked[0] += 2 * len(self.steps) * len(x)
            return differing(self, x, y)

        monkeypatch.setattr(suffix_dedup.SuffixSort, "differing", compared)
    order, equal = suffix_dedup.SuffixSort(raw).classes(starts, group)
    cut = [(int(g), raw[i : i + 100]) for i, g in enumerate(group.tolist())]
    met = Counter((g, s[:8]) for g, s in cut)
    want = [i for i in sorted(range(len(cut)), key=lambda i: (cut[i], i)) if met[cut[i][0], cut[i][1][:8]] > 1]
    assert order.tolist() == want
    assert equal.tolist() == [False, *(cut[i] == cut[j] for i, j in zip(want, want[1:], strict=False))]
    assert collide or looked[0] < 50 * len(starts)  # 261 when each suffix of a merge searched the other half


# Neighbours -------------------------------------------------------------


def exact(ids, vectors, query, own, k):
    scores = sorted((-float(np.sum(vectors[i] * query)), ids[i]) for i in range(len(ids)) if ids[i] != own)
    return [v for _, v in scores[:k]]


def test_recall_of_neighbours(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = df.collect()
    ids, vectors = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], dtype=np.float64)
    got = defaultdict(list)
    for r in neighbours.search(df).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.vec_id)
    at = {int(v): i for i, v in enumerate(ids)}
    hits = [len(set(got[q]) & set(exact(ids, vectors, vectors[at[q]], q, 20))) for q in at if q % 20 == 0]
    assert all(len(v) == 20 for v in got.values()) and len(got) == len(hits)
    assert sum(hits) / (20 * len(hits)) >= 0.95


def test_neighbours_of_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 40)
    draw = np.random.default_rng(2)
    base = draw.standard_normal((90, 5)) * draw.uniform(0.5, 3, (90, 1))
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    rows += [(100 + i, base[0].tolist()) for i in range(60)]  # a vector with very many copies
    bad = [(200, None), (220, []), (240, [0.0] * 5), (260, [1.0, None, 0.0, 0.0, 0.0]), (280, [math.nan] * 5), (300, [math.inf] + [1.0] * 4), (None, [1.0] * 5), (320, [1.0, 2.0])]
    df = spark.createDataFrame(rows + bad + rows[:1], "vec_id long, embedding array<double>").withColumn("rank", F.lit(1)).withColumn("dim", F.lit("d"))
    got = defaultdict(list)
    for r in neighbours.search(df).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    ids, vectors = [r[0] for r in rows], np.array([r[1] for r in rows])
    queries = [i for i in ids if i % 20 == 0]
    assert sorted(got) == queries
    exactly = [[v for v, _ in got[q]] == exact(ids, vectors, vectors[ids.index(q)], q, 20) for q in queries]
    assert np.mean(exactly) >= 0.9
    assert neighbours.search(df.limit(0)).count() == 0


@pytest.mark.parametrize("dim", [1, 5, 64, 384])
def test_small_blocks_give_all_their_vectors(dim):
    draw = np.random.default_rng(dim)
    for n in range(1, 21):
        vectors = draw.standard_normal((n, dim))
        vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
        ids = np.arange(n) * 20
        index = neighbours.Index(ids, vectors, 1 + 1e-12, 20)
        for query in (vectors[0], 50 * vectors[0]):  # one far outside of the block as well
            assert index.search(query[None, :], np.array([0]), 20)[0][0].tolist() == exact(ids.tolist(), vectors, query, 0, 20)


def test_neighbours_of_a_rare_length(spark):
    draw = np.random.default_rng(8)
    rows = [(i, draw.standard_normal(8).tolist()) for i in range(100)] + [(100 + i, draw.standard_normal(3).tolist()) for i in range(5)]
    got = defaultdict(list)
    for r in neighbours.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.vec_id)
    ids, rare = [r[0] for r in rows[100:]], np.array([r[1] for r in rows[100:]])
    assert sorted(got) == [0, 20, 40, 60, 80, 100]
    assert got[100] == exact(ids, rare, rare[0], 100, 20)


# Mixing -----------------------------------------------------------------


def test_exponents_meet_their_targets(spark):
    tokens = [900, 300, 60, 6]
    share = np.array(tokens) / sum(tokens)
    df = spark.createDataFrame([(float(s),) for s in share], "share double")

    def weights(a):
        w = share**a
        return w / w.sum()

    a = mixing.exponent(df, mixing.Target(repeats=3.0))
    passes = weights(a) / share
    assert passes.max() / passes.min() == pytest.approx(3, rel=1e-4)
    a = mixing.exponent(df, mixing.Target(entropy=0.8))
    assert -(weights(a) * np.log(weights(a))).sum() / math.log(4) == pytest.approx(0.8, rel=1e-4)


def test_draws_follow_the_plan(docs):
    draw = random.Random(9)
    rows = [(i, " ".join("w" * draw.randint(1, 5) for _ in range(draw.randint(5, 40))), "en", source) for i, source in enumerate(["big"] * 900 + ["small"] * 100 + [None] * 40)]
    df = docs(*rows, draws="x", block=1)
    got = mixing.draws(df, mixing.Target(repeats=1.7)).select("doc.doc_id", "doc.source", "n_tokens", "pass", "block", "block_order").collect()
    size = Counter()
    for i, text, _, source in rows:
        size[source] += len(text.split())
    drawn, copies = Counter(), Counter()
    for r in got:
        assert r.n_tokens == len(rows[r.doc_id][1].split())
        drawn[r.source] += r.n_tokens
        copies[r.doc_id] += 1
    assert set(copies) == {r[0] for r in rows} and max(copies.values()) <= 2
    assert drawn["big"] == size["big"]
    assert drawn[None] / size[None] == pytest.approx(1.7, abs=0.1)
    blocks = defaultdict(set)
    for r in got:
        blocks[r.source, r["pass"], r.block].add(r.block_order)
    assert all(len(v) == 1 for v in blocks.values())
    mixed = mixing.mixed(df, mixing.Target(entropy=0.9), budget=sum(size.values()) // 2)
    assert mixed.columns == df.columns
    assert sum(len((r.text or "").split()) for r in mixed.collect()) == pytest.approx(sum(size.values()) / 2, rel=0.05)
    assert mixing.mixed(df.limit(0)).count() == 0
    # sources without a token stay once, beside others as well
    assert mixing.mixed(docs((1, None), (2, ""))).count() == 2
    beside = mixing.mixed(docs((1, None, None, "bare"), (2, " ", None, "bare"), *[(i, "a b c", None, "full") for i in range(3, 9)], (9, "", None, None)))
    assert sorted(r.doc_id for r in beside.collect()) == list(range(1, 10))


# Pipeline ---------------------------------------------------------------


def plain_fingerprint(text):
    """The contract's words: bit by bit, from the hashes of the shingles, repeats included."""
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    parts = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64(p.encode(), seed=42).intdigest() for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def fingerprint_groups(rows):
    """{id: least id of its group} of (id, text), all fingerprints against all."""
    prints, want = defaultdict(list), Groups()
    for i, text in rows:
        prints[plain_fingerprint(text)].append(i)
    for a, b in itertools.combinations(prints, 2):
        if (a ^ b).bit_count() <= 2:
            want.link(min(prints[a]), min(prints[b]))
    least = {i: min(same) for same in prints.values() for i in same}
    return {i: want.root(m) for i, m in least.items()}


def test_fingerprints_and_groups_of_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: r for r in registry.op3_simhash(spark, SF).collect()}
    assert all(got[i].fingerprint == f"{plain_fingerprint(t):016x}" for i, t in rows)
    assert {i: r.component_id for i, r in got.items()} == fingerprint_groups(rows)


def test_one_of_each_group_stays(docs):
    rows = [(5, None), (4, ""), (9, " \t"), (3, "One  two"), (None, "one two"), (7, "one two"), (7, "one two"), (8, "one two three"), (None, "alone"), (None, "alone")]
    df = docs(*rows, _id="x", fp=1, _sha="y")
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text) for r in kept.collect()) == [(False, 3, "One  two"), (False, 4, ""), (False, 8, "one two three"), (True, 0, "alone")]
    assert simhash.keep_one(docs(*[(1, "same text")] * 3000)).count() == 1
    assert simhash.keep_one(df.limit(0)).count() == 0


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        kept[name] = stage(spark, list(kept.values())[-1], SF).cache()
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language", "near_copies", "secrets", "mixing", "packing"]
    assert all(kept[n].columns == docs.columns for n in names[:-1])
    assert kept["language"].count() >= 0.97 * docs.count()
    groups = fingerprint_groups([tuple(r) for r in kept["language"].select("doc_id", "text").collect()])
    assert sorted(r.doc_id for r in kept["near_copies"].select("doc_id").collect()) == sorted(set(groups.values()))
    assert kept["secrets"].count() == kept["near_copies"].count()
    assert {r.doc_id for r in kept["mixing"].collect()} == {r.doc_id for r in kept["secrets"].collect()}
    packed = kept["packing"]
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 1024").count() == 0
    assert packed.where("start = 0").count() == kept["mixing"].count()
    assert corpus_pipeline.run(spark, SF).count() == packed.count()


def test_edited_digests_are_those_of_the_texts(spark):
    docs = sorted((r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    got = {r.doc_id: r for r in registry.op10_order_minhash(spark, SF).collect()}
    for (i, t), (_, n) in zip(docs, [*docs[1:], docs[0]], strict=True):
        half = len(t) // 2
        assert got[i].edited_sha256 == hashlib.sha256((t[: len(t) - half] + n[:half]).encode()).hexdigest()
        assert got[i].n_chars == len(t)
