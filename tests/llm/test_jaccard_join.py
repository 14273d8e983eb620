"""The Jaccard join against all pairs, and its tree and rounds on their own."""

import random
from itertools import combinations

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from starmart.llm import jaccard_join, jaccard_join_sql, registry
from starmart.llm.jaccard_join import GROUPS, Likeness, Tree, forests, groups, keys, shingles

LIKE = Likeness()


def plain(rows, length=3, like=LIKE):
    """{row number: (size, component)} by comparing all pairs."""
    sets = [frozenset(shingles(t or "", length)) for _, t in rows]
    up = list(range(len(rows)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        if sets[a] and like.reached(len(sets[a] & sets[b]), len(sets[a]), len(sets[b])) and sets[b]:
            x, y = top(a), top(b)
            up[max(x, y)] = min(x, y)
    ids = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            ids[top(i)] = min(doc, ids.get(top(i), doc))
    return [(rows[i][0], len(sets[i]), ids.get(top(i))) for i in range(len(rows))]


def asked(df):
    null = lambda r: tuple((x is None, x or 0) for x in r)
    return sorted([tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect()], key=null)


def expected(rows, **kw):
    return sorted(plain(rows, **kw), key=lambda r: tuple((x is None, x or 0) for x in r))


def test_shingles_are_those_of_the_contract():
    assert shingles("A b\tC\n d") == [b"a b c", b"b c d"]
    assert shingles("Été x") == ["Été x".encode()] and shingles("É x y z w") == ["É x y z".encode(), b"y z w"]
    assert shingles(" \x0b\r\n") == [] and shingles("a a a a a") == [b"a a a"]


@pytest.mark.parametrize("per_cent", [90, 70])
def test_linked_sets_share_a_key(per_cent):
    like, draw = Likeness(per_cent), random.Random(per_cent)
    for n in [1, 2, 3, 8, 9, 10, 11, 12, 17, 18, 19, 20, 27, 28, 40, 63, 94, 141, 211, 500, 3000] * 3:
        most = max(d for d in range(n + 1) if like.reached(n - d, n, n - d) or d == 0)
        base = [draw.getrandbits(64) for _ in range(n)]
        for gone in {0, most // 2, most}:
            for more in range(0, most + 1, max(1, most // 3)):
                other = draw.sample(base, n - gone) + [draw.getrandbits(64) for _ in range(more)]
                if like.reached(n - gone, n, len(other)):
                    a, b = (np.sort(np.array(x, dtype=np.uint64)) for x in (base, other))
                    assert set(keys(a, like)) & set(keys(b, like)), (n, gone, more)


def test_tree_join_finds_what_all_pairs_find():
    draw = np.random.default_rng(2)
    middle = draw.poisson(5, (6, GROUPS))
    points = np.maximum(0, np.concatenate([m + draw.integers(-1, 2, (90, GROUPS)) * (draw.random((90, GROUPS)) < 0.15) for m in middle])).astype(np.int64)
    labels = draw.integers(0, 200, len(points))
    a, b, bound = Tree(points, labels, LIKE).join()
    got = {(min(x, y), max(x, y)) for x, y in zip(a.tolist(), b.tolist())}
    want = set()
    for i, j in combinations(range(len(points)), 2):
        both, sizes = np.minimum(points[i], points[j]).sum(), points[i].sum() + points[j].sum()
        if 190 * both >= 90 * sizes and labels[i] != labels[j]:
            want.add((i, j))
    assert got == want and len(a) == len(got) and len(want) > 500
    some = forests(a, b, bound, labels, 2)
    assert len(set(some)) == len(some) <= 2 * (len(set(labels.tolist())) - 1)
    assert forests(a[:0], b[:0], bound[:0], labels, 2) == []


def edited(draw, words, edits):
    words = list(words)
    for _ in range(edits):
        at = draw.randrange(len(words))
        words[at : at + draw.choice([0, 1])] = [f"e{draw.randrange(10**6)}"] * draw.choice([0, 1, 1])
    return " ".join(words)


@pytest.mark.parametrize("page", [1024, 12])
def test_groups_against_all_pairs(docs, page):
    draw = random.Random(page)
    rows = []
    for n in [4, 12, 13, 40, 150, 600]:
        base = [f"w{draw.randrange(10**5)}" for _ in range(n)]
        rows += [(0, edited(draw, base, draw.randint(0, max(1, n // 30)))) for _ in range(60 if n == 150 else 12)]
    rows += [(0, t) for t in [None, "", " \n", "one", "One", "one two", "one  TWO", "one two three", "x " * 5000, "x x x", "é è ê"] * 2]
    ids = list(range(len(rows)))
    draw.shuffle(ids)
    rows = [(i, t) for i, (_, t) in zip(ids, rows)]
    rows += [(None, rows[5][1]), (None, "only here, twice"), (None, "only here, twice"), (rows[7][0], rows[7][1]), (rows[8][0], "same id, another text")]
    df = docs(*rows, node=1, digest="d", n="n", keys="k")
    assert asked(groups(df, page=page)) == expected(rows)


def test_groups_of_an_empty_table_and_of_other_parameters(docs):
    assert groups(docs((1, "a")).limit(0)).count() == 0
    assert asked(groups(docs((1, None), (2, " ")))) == [(1, 0, 1), (2, 0, 2)]
    draw = random.Random(1)
    base = [f"w{i}" for i in range(120)]
    rows = [(i, edited(draw, base, i % 12)) for i in range(50)]
    assert asked(groups(docs(*rows), length=5, like=Likeness(70))) == expected(rows, length=5, like=Likeness(70))


def test_a_chain_of_links_is_one_component(docs):
    words = [f"w{i}" for i in range(100)]
    rows = []
    for i in range(40):
        words[2 * i % 100] = f"n{i}"
        rows.append((100 - i, " ".join(words)))
    want = expected(rows)
    assert asked(groups(docs(*rows))) == want and len({r[2] for r in want}) == 1


def test_join_agrees_with_sql(spark):
    path = "/root/testdata/sf0.01"
    with duckdb.connect() as db:
        db.execute(f"create view documents as select * from '{path}/documents.parquet'")
        want = sorted(db.execute(f"select doc_id, n_shingles, component_id from ({jaccard_join_sql.SQL})").fetchall())
    assert asked(registry.op13_jaccard_join(spark, path)) == want
