"""Nearest neighbours by collision-counting hashing.

Vectors are projected on many single directions, and each projection is kept as a sorted array.
A query opens a window around its own value in every array and widens all of them step by
step (virtual rehashing: a wider window is a coarser hash of the same array).  A vector that
lies in the windows of at least a share of the directions (``THRESHOLD``) is verified by its exact
inner product.  A query ends when its k-th best verified vector is no farther than ``SLACK`` times the
radius that the windows stand for, or when every vector is verified.

Windows are ranks: a vector collides in a direction if its rank there lies between the window's
ends.  The first windows, which stand for a little less than the distance at which sample vectors of the
block have their k-th neighbour; a query that does not end with them has them widened.

The largest inner product is a nearest neighbour after one more component is added, which
gives all indexed vectors the same length.

Vectors are dealt into blocks and queries into chunks; each pair of both is one task's group
of bounded size, and the best of a query's blocks are merged.  With vectors that are nearly equally far
from each other no block can be left out for a query: its windows reach into all of them.  A query's result can hold no
more than k + 1 equal vectors, so of equal ones only those of least id are indexed: exact,
and a vector with very many copies makes no large group.

Results: rows with a null id or vector, zero vectors and vectors with null or non-finite
components take no part.  Vectors of different lengths are not compared.  Ties go to
the smaller id.  Rows that repeat an id with another vector are candidates of their own, and
rows alike in both count once.  An empty table gives an empty table.
"""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Ranks are unsigned 16-bit numbers, so a block has less than 65,536 rows.
BLOCK_ROWS = 32_768
# A block's arrays are built once for so many queries.
CHUNK_QUERIES = 16_384
DIRECTIONS = 128
# The share of windows, half as wide as twice the radius, that must hold a vector.
THRESHOLD = 0.6
# How much farther than the radius the k-th neighbour may be: windows of that radius hold most of what is that near.
SLACK = 1.06
WIDENING = 1.03
# From this step on windows grow faster: the block has no neighbours where its sample vectors had them.
PATIENCE = 10
FASTER = 1.12
# Vectors of a block from which the first radius is taken.
RADIUS_SAMPLE = 16
# Queries whose windows are counted together.
QUERIES_AT_ONCE = 64


def directions(dim: int, count: int, seed: int = 42) -> np.ndarray:
    """(dim, count): random orthonormal bases side by side, scaled like single normal draws."""
    draw = np.random.default_rng(seed)
    bases = [np.linalg.qr(draw.standard_normal((dim, dim)))[0] for _ in range(-(-count // dim))]
    return np.concatenate(bases, axis=1)[:, :count] * math.sqrt(dim)


class Index:
    """Sorted projections of one block, and every vector's rank in each of them."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, longest: float, k: int) -> None:
        self.ids, self.vectors, self.longest, self.verified = ids, vectors, longest, 0
        n, dim = vectors.shape
        rest = np.sqrt(np.maximum(longest**2 - np.einsum("ij,ij->i", vectors, vectors), 0))
        self.axes = directions(dim + 1, DIRECTIONS)
        projected = np.ascontiguousarray((np.concatenate([vectors, rest[:, None]], axis=1) @ self.axes).T)
        self.order = np.argsort(projected, axis=1, kind="stable").astype(np.int32)
        # all arrays in one, each moved by an offset that keeps them apart, so that one search looks into all of them
        self.step = 4 * float(np.abs(projected).max()) + 1
        self.offset = np.arange(DIRECTIONS) * self.step
        self.sorted = (np.take_along_axis(projected, self.order, axis=1) + self.offset[:, None]).ravel()
        self.first_rank = np.arange(DIRECTIONS) * n
        self.ranks = np.empty((DIRECTIONS, n), dtype=np.uint16)
        np.put_along_axis(self.ranks, self.order, np.arange(n, dtype=np.uint16)[None, :], axis=1)
        self.first_radius = self._near(k)

    def _near(self, k: int) -> float:
        """Where windows start: within reach of the k-th neighbour of the densest sample vector."""
        n = len(self.vectors)
        some = self.vectors[:: max(1, n // RADIUS_SAMPLE)][:RADIUS_SAMPLE]
        squares = np.maximum(2 * self.longest**2 - 2 * some @ self.vectors.T, 0)
        near = np.partition(squares, min(k, n - 1), axis=1)[:, min(k, n - 1)]
        return max(math.sqrt(float(near.min())) / SLACK, 0.05 * self.longest)

    def ends(self, at: np.ndarray, half: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks of the windows' ends, a row for a query and a column for a direction."""
        n = len(self.ids)
        low = np.searchsorted(self.sorted, at - half[:, None] + self.offset, "left") - self.first_rank
        high = np.searchsorted(self.sorted, at + half[:, None] + self.offset, "right") - self.first_rank
        return np.clip(low, 0, n), np.clip(high, 0, n)

    def collisions(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """In how many windows of each query each vector lies; ranks below a window wrap around to large numbers.

        A direction's ranks are read once for all queries.
        """
        n = len(self.ids)
        counts, moved, inside = np.zeros((len(low), n), dtype=np.uint8), np.empty(n, dtype=np.uint16), np.empty(n, dtype=bool)
        inside_as_number = inside.view(np.uint8)
        starts, widths = low.T.astype(np.uint16), (high - low).T.astype(np.uint16)
        for ranks, firsts, wide in zip(self.ranks, starts, widths, strict=True):
            for count, a, w in zip(counts, firsts, wide, strict=True):
                np.subtract(ranks, a, out=moved)
                np.less(moved, w, out=inside)
                np.add(count, inside_as_number, out=count)
        return counts

    def best(self, query: np.ndarray, own: int, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` best of ``rows`` without the query's own, best first, ties to the smaller id."""
        rows = rows[self.ids[rows] != own]
        vectors = self.vectors[rows]
        score = vectors @ query
        if len(rows) > k:
            # rough sums choose who may be among the k; theirs are taken anew
            rough = np.partition(score, len(score) - k)[len(score) - k]
            near = score >= rough - 1e-9 * max(1.0, self.longest * float(np.sqrt(query @ query)))
            rows, vectors = rows[near], vectors[near]
        # sums along a row do not depend on where the row stands, so equal vectors tie
        score = (vectors * query).sum(axis=1)
        order = np.lexsort((self.ids[rows], -score))[:k]
        return rows[order], score[order]

    def search(self, queries: np.ndarray, owns: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query the ids and inner products of the ``k`` best found, best first."""
        made: list = [None] * len(queries)
        for at in range(0, len(queries), QUERIES_AT_ONCE):
            self._search(queries, owns, k, np.arange(at, min(at + QUERIES_AT_ONCE, len(queries))), made)
        return made

    def _search(self, queries: np.ndarray, owns: np.ndarray, k: int, left: np.ndarray, made: list) -> None:
        n = len(self.ids)
        need = math.ceil(THRESHOLD * DIRECTIONS)
        projected = np.concatenate([queries, np.zeros((len(queries), 1))], axis=1)[left] @ self.axes
        lengths = self.longest**2 + np.einsum("ij,ij->i", queries[left], queries[left])
        radius, step = np.full(len(left), self.first_radius), 0
        while len(left):
            low, high = self.ends(projected, radius)
            counts = self.collisions(low, high)
            whole = (high - low == n).all(axis=1)
            open_ = np.ones(len(left), dtype=bool)
            for i, q in enumerate(left.tolist()):
                hit = np.arange(n) if whole[i] else np.flatnonzero(counts[i] >= need)
                if len(hit) <= k and len(hit) < n:
                    continue
                rows, score = self.best(queries[q], int(owns[q]), hit, k)
                if len(hit) == n or (len(rows) == k and lengths[i] - 2 * score[-1] <= (SLACK * radius[i]) ** 2):
                    made[q] = self.ids[rows], score
                    self.verified += len(hit)
                    open_[i] = False
            # no limit to its growth: what reaches past an array's ends is cut off there
            step += 1
            left, projected, lengths = left[open_], projected[open_], lengths[open_]
            radius = radius[open_] * (WIDENING if step <= PATIENCE else FASTER)


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, embedding`` (doubles) of the rows that take part."""
    x = F.col("embedding").cast("array<double>")
    good = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != math.inf)) & F.exists(x, lambda v: v != 0)
    return vectors.where(F.col("vec_id").isNotNull() & good).select("vec_id", x.alias("embedding"))


def search(vectors: DataFrame, every: int = 20, k: int = 20) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest of each row whose id ``every`` divides."""
    rows = usable(vectors)
    same = Window.partitionBy("embedding").orderBy("vec_id")
    kept = rows.distinct().withColumn("_turn", F.row_number().over(same)).where(F.col("_turn") <= k + 1)
    asked = rows.where(F.col("vec_id") % every == 0).distinct()
    n, longest = rows.agg(F.count(F.lit(1)), F.max(F.aggregate("embedding", F.lit(0.0), lambda a, v: a + v * v))).first()
    blocks = max(1, -(-n // BLOCK_ROWS))
    chunks = max(1, -(-(n // every + 1) // CHUNK_QUERIES))
    longest = math.sqrt(longest or 1.0) * (1 + 1e-12)

    def dealt(df: DataFrame, own: str, parts: int, other: str, others: int) -> DataFrame:
        placed = df.select("vec_id", "embedding", F.size("embedding").alias("dim"), F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int").alias(own))
        return placed.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1))))

    key = ["dim", "block", "chunk"]
    schema = "query_id long, vec_id long, score double"

    def both(queries: pa.Table, block: pa.Table) -> pa.Table:
        out: list[tuple[int, np.ndarray, np.ndarray]] = []
        if queries.num_rows and block.num_rows:
            block, queries = block.sort_by("vec_id"), queries.sort_by("vec_id")
            index = Index(block.column("vec_id").to_numpy(), _matrix(block), longest, k)
            owns = queries.column("vec_id").to_numpy()
            found = index.search(_matrix(queries), owns, k)
            out = [(own, *f) for own, f in zip(owns.tolist(), found, strict=True)]
        sizes = [len(o[1]) for o in out]
        return pa.table({"query_id": pa.array(np.repeat([o[0] for o in out], sizes), type=pa.int64()), "vec_id": pa.array(np.concatenate([o[1] for o in out]) if out else [], type=pa.int64()), "score": pa.array(np.concatenate([o[2] for o in out]) if out else [], type=pa.float64())})

    left = dealt(asked, "chunk", chunks, "block", blocks).groupBy(*key)
    right = dealt(kept, "block", blocks, "chunk", chunks).groupBy(*key)
    near = left.cogroup(right).applyInArrow(both, schema)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _matrix(table: pa.Table) -> np.ndarray:
    rows = table.column("embedding").combine_chunks()
    return rows.flatten().to_numpy().reshape(table.num_rows, -1)
