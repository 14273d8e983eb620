"""Conversation repair against every edit string, whitening against numpy's own decomposition."""

import hashlib
import random
import zlib
from functools import cache

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from starmart.llm import registry, turn_repair, turn_repair_sql, whitening
from starmart.llm.turn_repair import ASSISTANT, DUE, FOLLOWS, KINDS, MUST_GO, NOTHING

SF = "/root/testdata/sf0.001"
CONVERSATION = "conv_id long, turn long, role string, text string"


# Repair -----------------------------------------------------------------


def plain(signs):
    """(cost, edits) of the cheapest, then least edit string, tried state by state."""

    @cache
    def best(i, q, inserted):
        ways = [(0, "")] if i == len(signs) and q in (NOTHING, ASSISTANT) else []
        if inserted < 3:
            c, e = best(i, DUE[q], inserted + 1)
            ways.append((c + 2, "I" + e))
        if i < len(signs):
            c, e = best(i + 1, q, 0)
            ways.append((c + 3, "D" + e))
            if signs[i] != MUST_GO:
                cut, kind = signs[i] // 4, KINDS[signs[i] % 4]
                if (q, kind) in FOLLOWS:
                    c, e = best(i + 1, FOLLOWS[q, kind], 0)
                    ways.append((c + cut, "K" + e))
                c, e = best(i + 1, DUE[q], 0)
                ways.append((c + cut + 2, "R" + e))
        return min(ways) if ways else (10**6, "")

    return best(0, NOTHING, 0)


@pytest.mark.parametrize("length", [1, 2, 3, 4])
def test_block_tables_give_the_cheapest_edits(length):
    made, draw = turn_repair.BlockTables(length), random.Random(length)
    for size in [0, 1, 2, 3, 4, 5, 7, 8, 9, 12] * 30:
        signs = [draw.randrange(turn_repair.SYMBOLS) for _ in range(size)]
        blocks, vector, rest = [], 0, list(signs)
        while rest:
            block, rest = rest[-length:], rest[:-length]
            blocks.append((vector, block))
            if rest:
                vector = int(made.next[vector, sum(s * 9**j for j, s in enumerate(reversed(block)))])
        state, cost, edits = NOTHING, 0, []
        for behind, block in reversed(blocks):
            for _, edit, state, price in turn_repair.walk(state, block, made.expanded(behind, block)):
                edits.append(edit)
                cost += price
        for edit, state, price in turn_repair.closing(state):
            edits.append(edit)
            cost += price
        assert (cost, "".join(edits)) == plain(tuple(signs))


def audited(rows):
    """The query's columns of one conversation, by the contract's words."""
    kept = []
    for conv, turn, role, text in rows:
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if code == 1:
            text = ""
        if code == 2:
            text = "".join(c for c in text if c not in ".!?")
        kept += [(turn, "user" if code == 4 else role, text)] * (0 if code == 0 else 2 if code == 3 else 1)
    kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, signs, counts, space = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}, " \t\n\r\x0b\x0c"
    for _, role, text in kept:
        fault = "blank" if not text.strip(space) else "duplicate" if (role, text) in seen else "truncated" if text.strip(space)[-1] not in ".!?" else None
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        signs.append(MUST_GO if fault in ("blank", "duplicate") else ("sua".find(role[:1]) if role[:1] in tuple("sua") else 3) + 4 * (fault == "truncated"))
    cost, audit = plain(tuple(signs))
    state, at, lines = NOTHING, 0, []
    for edit in audit:
        role, text = (kept[at][1:]) if edit != "I" else ("", "")
        at += edit != "I"
        if edit != "D":
            state = FOLLOWS[state, role[0]] if edit == "K" else DUE[state]
            lines.append(f"{role if edit == 'K' else {2: 'user', 3: 'assistant'}[state]}:{text}")
    turns = [r[0] for r in kept if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(kept, kept[1:]))
    return gaps, *counts.values(), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def results(df):
    return {r.conv_id: tuple(r)[1:] for r in df.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()}


def test_repair_of_odd_rows(spark):
    draw, rows = random.Random(5), []
    for conv in [*range(60), None]:
        for _ in range(draw.choice([1, 1, 2, 5, 9, 30])):
            role = draw.choice(["system", "user", "user", "assistant", "assistant", "tool", "", None, "User"])
            text = draw.choice(["Yes.", "no", "Is it?", "", " \n", None, "a.b", "Fine!\n", "é…", "long " * 2000 + "."])
            rows.append((conv, draw.choice([None, 0, 1, 2, 3, 4, 7, 8, -2]), role, text))
    rows += rows[::7]
    df = spark.createDataFrame(rows, CONVERSATION).withColumn("block", F.lit(1)).withColumn("fault", F.lit("x"))
    want = {c: audited([r for r in rows if r[0] == c]) for c in {r[0] for r in rows}}
    assert results(turn_repair.repair(df)) == want
    assert turn_repair.repair(df.limit(0)).count() == 0


def test_repair_of_a_conversation_with_most_rows_and_of_lost_ones(spark):
    lost = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows = [(5, i, "user" if i % 2 == 0 else "assistant", f"Row {i}.") for i in range(9000)] + [(lost, 0, "user", "Hi.")] * 3
    got = results(turn_repair.repair(spark.createDataFrame(rows, CONVERSATION)))
    assert got[lost] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    edits = got[5][6]
    damage = [zlib.crc32(f"5:{i}".encode()) % 20 for i in range(9000)]
    assert len(edits.replace("I", "")) == sum({0: 0, 3: 2}.get(d, 1) for d in damage)
    cut = damage.count(2) - cut_and_deleted(rows[:9000], edits)
    assert got[5][5] == 3 * edits.count("D") + 2 * (edits.count("I") + edits.count("R")) + cut


def cut_and_deleted(rows, edits):
    ops, deleted = iter(edits.replace("I", "")), 0
    for _, turn, _, _ in rows:
        code = zlib.crc32(f"5:{turn}".encode()) % 20
        for _ in range({0: 0, 3: 2}.get(code, 1)):
            deleted += next(ops) == "D" and code == 2
    return deleted


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_repair_agrees_with_sql(spark, sf):
    path = f"/root/testdata/{sf}"
    with duckdb.connect() as db:
        db.execute(f"create view conversations as select * from '{path}/conversations.parquet'")
        names = "conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256"
        want = {r[0]: r[1:] for r in db.execute(f"select {names} from ({turn_repair_sql.SQL})").fetchall()}
    assert results(registry.op11_turn_repair(spark, path)) == want


# Whitening --------------------------------------------------------------


def spread(eigenvalues, draw):
    q = np.linalg.qr(draw.standard_normal((len(eigenvalues),) * 2))[0]
    return q @ np.diag(eigenvalues) @ q.T


@pytest.mark.parametrize("values", [[3.0], [1.0, 1.0], [2.0, 0.0], [5.0] * 4 + [1.0] * 3, list(10.0 ** -np.arange(12)), [0.0] * 5, list(range(1, 61)), [1e9, 1.0, 1.0, 1e-3], [7.0] + [0.0] * 20])
def test_spectrum(values):
    v = spread(np.array(values), np.random.default_rng(len(values)))
    for wanted in {1, min(16, len(values)), len(values)}:
        got, vectors = whitening.spectrum(v, wanted)
        want = np.sort(np.linalg.eigvalsh(v))[::-1][:wanted]
        size = max(np.abs(want).max(), 1e-300)
        assert np.abs(got - want).max() <= 1e-13 * size
        assert np.abs(vectors.T @ vectors - np.eye(wanted)).max() <= 1e-13
        assert np.abs(v @ vectors - vectors * got).max() <= 1e-13 * size


def test_polar_factor_is_orthogonal():
    draw = np.random.default_rng(3)
    for values in ([1.0, -2.0, 3.0], [1e-9, -1.0], list(draw.standard_normal(40)), [-5.0, -6.0]):
        a = spread(np.array(values), draw)
        u = whitening.polar(a)
        w, q = np.linalg.eigh(a)
        assert np.abs(u @ u - np.eye(len(a))).max() < 1e-12 and np.abs(u - q @ np.diag(np.sign(w)) @ q.T).max() < 1e-6
    assert (whitening.polar(np.zeros((2, 2))) == np.eye(2)).all()


def check_whitening(rows, got, components=16):
    """``rows``: (id, vector) that take part, of one length; ids are unique."""
    x = {i: np.floor(64 * np.asarray(v, dtype=float)).astype(np.int64) + 1_000_000 for i, v in rows}
    fit = np.unique(np.stack(list(x.values())), axis=0)
    n, s, k = len(fit), fit.sum(axis=0), min(components, fit.shape[1])
    y = fit - s / n
    values, vectors = np.linalg.eigh(y.T @ y / n)
    trace, values, vectors = values.sum(), values[::-1][:k], vectors[:, ::-1][:, :k]
    by = {(r.vec_id, r.component): r for r in got}
    assert len(by) == len(got) == k * len(x)
    signs = None
    for i, v in x.items():
        mine = [by[i, c + 1] for c in range(k)]
        assert all(r.n == n and r.deviation == sum((n * int(a) - int(b)) ** 2 for a, b in zip(v, s)) for r in mine)
        assert all(r.identity_error <= 1e-10 for r in mine)
        assert np.allclose([r.explained for r in mine], values / trace, rtol=1e-6, atol=1e-15)
        want = (v - s / n) @ vectors / np.sqrt(values)
        white = np.array([r.whitened for r in mine])
        signs = np.sign(want * white) if signs is None else signs
        assert np.allclose(white, want * signs, atol=1e-7)


def test_whitening_of_the_table(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    check_whitening([(r.vec_id, r.embedding) for r in rows], registry.op12_whitening(spark, SF).collect())


def test_whitening_of_odd_rows(spark):
    draw, nan, inf = np.random.default_rng(1), float("nan"), float("inf")
    good = [(i, draw.standard_normal(5).tolist()) for i in range(200)]
    copies = [(1000 + i, v) for i, v in good[:50]] + [(2000 + i, good[0][1]) for i in range(300)]
    short = [(5000 + i, draw.standard_normal(2).tolist()) for i in range(9)]
    flat = [(6000 + i, [1.0, float(i), 1.0]) for i in range(4)]
    bad = [(7000, None), (7001, [1.0, None, 1.0, 1.0, 1.0]), (7002, [nan] * 5), (7003, [inf] * 5), (7004, [])]
    df = spark.createDataFrame(good + copies + short + flat + bad, "vec_id long, embedding array<double>").withColumn("x", F.lit(1)).withColumn("n", F.lit("n"))
    got = whitening.whiten(df).collect()
    ids = lambda some: {i for i, _ in some}
    check_whitening(good + copies, [r for r in got if r.vec_id in ids(good + copies)])
    check_whitening(short, [r for r in got if r.vec_id in ids(short)])
    level = [r for r in got if r.vec_id in ids(flat)]
    assert len(level) == 12 and all((r.whitened is None) == (r.component > 1) and (r.explained == 0) == (r.component > 1) for r in level)
    assert not {r.vec_id for r in got} & ids(bad)
    assert whitening.whiten(df.limit(0)).count() == 0
    assert [r.whitened for r in whitening.whiten(df.where("vec_id = 3")).collect()] == [None] * 5


def test_deviations_are_exact_beyond_small_numbers():
    x = np.array([[10**6, 2 * 10**6], [3, 4]])
    sums = [10**9, -(10**9)]
    assert whitening.deviations(x, 1000, sums) == [sum((1000 * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x]
    assert whitening.deviations(x * 10**5, 10**6, sums) == [None, None]
    assert whitening.deviations(np.array([[4 * 10**9], [7]]), 1, [3]) == [None, 16]
    huge = whitening.centred(np.array([[2**61, -(2**61)]]), 10, [10 * 2**61, 5])
    assert huge.tolist() == [[0.0, -(2.0**61) - 0.5]]
