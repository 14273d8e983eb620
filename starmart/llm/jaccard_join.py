"""Groups of documents whose sets of word shingles are alike, by an R-tree over count vectors.

A document's distinct shingles are hashed into ``GROUPS`` groups; the counts of the groups are a point.  Two
sets share at most the sum of the coordinate-wise minima of their points, so in an R-tree two boxes
or points whose minima (or gaps) rule the similarity out are passed over.  What survives is verified by the
shingles themselves.

The trees are small and many.  Sets within the similarity differ in at most a nineteenth of their joint size
(for 0.9), D shingles.  Hashed into D + 1 blocks, both have some block in common exactly, so the
points meet in buckets of (size class, block, content of the block) and each bucket gets a tree: every pair
meets, whatever it is.  Buckets with the same members are looked at once.  Equal sets are one node
from the start.

A bucket never lists its pairs.  A task emits a few edge-disjoint forests of the surviving pairs of nodes not
connected yet, best first (more of them in later rounds); these are verified, the connected components are taken, and what is refuted or
connected is left out of the next round.  When no pair is emitted all pairs are settled.  Buckets above
``PAGE`` nodes are dealt into cells of at most two pages: in the first round every page meets the first page, later
the pages outside of the bucket's most frequent component meet all others; pages inside of it need
not meet.

Results: ASCII white space splits words, A-Z are lower-cased.  A document of fewer words than a shingle has one
shingle, the whole sequence; one without words has an empty set, is linked with nothing and is its own component.
Repeated rows share a set.  A null id takes no part in choosing a component's id, which is null only if
every id of it is.  An empty table gives an empty table.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import arrow_schema, bounded_batches, freeing_shuffles, per_row, text_or_empty
from starmart.llm.components import components
from starmart.sources.scratch import stored

SHINGLE = 3
GROUPS = 64
SEED = 42
PAGE = 1024
BROADCAST_NODES = 300_000
LEAF = 32
# Forests of a cell in the first round, and their growth by round: rounds grow with the logarithm of the refuted.
FORESTS = 3
FOREST_GROWTH = 16


@dataclass(frozen=True)
class Likeness:
    """Intersection over union of at least ``per_cent`` / 100, in whole numbers."""

    per_cent: int = 90

    def reached(self, both: int, a: int, b: int) -> bool:
        return 100 * both >= self.per_cent * (a + b - both)

    def may_reach(self, both: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The same by the sum of both sizes: both >= p / (100 + p) * sizes."""
        return (100 + self.per_cent) * both >= self.per_cent * sizes

    def apart(self, size: int) -> int:
        """The most shingles by which a set of ``size`` and one that is no smaller can differ."""
        both = size + 100 * size // self.per_cent
        return (100 - self.per_cent) * both // (100 + self.per_cent)

    def least_partner(self, size: int) -> int:
        return -(-self.per_cent * size // 100)


def shingles(text: str, length: int = SHINGLE) -> list[bytes]:
    """The distinct shingles of a text, in order of their first place."""
    words = text.encode("utf-8").lower().split()
    if not words:
        return []
    if len(words) <= length:
        return [b" ".join(words)]
    return list(dict.fromkeys(b" ".join(words[i : i + length]) for i in range(len(words) - length + 1)))


# Size classes: each about half as wide again as the one before.  CLASSES[c] is the least size of class c.
CLASSES = [1]
while CLASSES[-1] < 2**40:
    CLASSES.append(max(CLASSES[-1] + 1, CLASSES[-1] * 3 // 2))


def size_classes(size: int, like: Likeness) -> range:
    """Classes in which a set of ``size`` meets its partners: that of the smaller of the two."""
    own = bisect.bisect_right(CLASSES, size) - 1
    return range(bisect.bisect_right(CLASSES, like.least_partner(size)) - 1, own + 1)


def keys(hashes: np.ndarray, like: Likeness) -> np.ndarray:
    """A key for every class and block of a set: the block's content and its place."""
    made = []
    for c in size_classes(len(hashes), like):
        blocks = like.apart(CLASSES[c + 1] - 1) + 1
        content = np.zeros(blocks, dtype=np.uint64)
        np.add.at(content, ((hashes >> np.uint64(32)) % np.uint64(blocks)).astype(np.int64), hashes * np.uint64(0x9E3779B97F4A7C15) | np.uint64(1))
        made += [xxhash.xxh64_intdigest(b"%d %d %d" % (c, i, x), SEED) for i, x in enumerate(content.tolist())]
    return np.array(made, dtype=np.uint64).view(np.int64)


def signed(docs: DataFrame, length: int, like: Likeness) -> DataFrame:
    """``doc_id, sha, n, digest, keys, counts`` of every row; the last three are null for an empty set."""
    kept = docs.select("doc_id", F.sha2(text_or_empty(), 256).alias("sha"), text_or_empty().alias("text"))
    kind = kept.schema["doc_id"].dataType.simpleString()

    def rows(batch: pa.RecordBatch) -> dict:
        made: dict[str, list] = {"n": [], "digest": [], "keys": [], "counts": []}
        for text in batch.column("text").to_pylist():
            parts = shingles(text, length)
            made["n"].append(len(parts))
            if not parts:
                for name in ("digest", "keys", "counts"):
                    made[name].append(None)
                continue
            hashes = np.fromiter((xxhash.xxh64_intdigest(p, SEED) for p in parts), dtype=np.uint64, count=len(parts))
            made["digest"].append(hashlib.sha256(b"\n".join(parts[i] for i in np.argsort(hashes, kind="stable"))).digest())
            made["keys"].append(keys(hashes, like))
            made["counts"].append(np.bincount((hashes % np.uint64(GROUPS)).astype(np.int64), minlength=GROUPS).astype("<u4").tobytes())
        return {"doc_id": batch.column("doc_id"), "sha": batch.column("sha"), **made}

    return per_row(kept, f"doc_id {kind}, sha string, n int, digest binary, keys array<long>, counts binary", rows)


# The tree of a bucket ---------------------------------------------------


class Tree:
    """An R-tree over points, filled by halving along the widest coordinate.

    ``join`` gives the pairs of points that may be alike and whose labels differ.
    """

    def __init__(self, points: np.ndarray, labels: np.ndarray, like: Likeness) -> None:
        self.like, self.order, self.boxes = like, np.arange(len(points)), []
        self.points, self.sizes, self.labels = points, points.sum(axis=1), labels
        self._fill(0, len(points))

    def _fill(self, start: int, stop: int) -> int:
        mine = self.order[start:stop]
        low, high = self.points[mine].min(axis=0), self.points[mine].max(axis=0)
        label = self.labels[mine[0]] if (self.labels[mine] == self.labels[mine[0]]).all() else None
        at = len(self.boxes)
        self.boxes.append([low, high, self.sizes[mine].min(), self.sizes[mine].max(), label, start, stop, None])
        if stop - start > LEAF:
            widest = int((high - low).argmax())
            middle = (stop - start) // 2
            self.order[start:stop] = mine[np.argpartition(self.points[mine, widest], middle)]
            self.boxes[at][7] = (self._fill(start, start + middle), self._fill(start + middle, stop))
        return at

    def _apart(self, a: list, b: list) -> bool:
        if a[4] is not None and a[4] == b[4]:
            return True
        if self.like.least_partner(int(b[2])) > a[3] or self.like.least_partner(int(a[2])) > b[3]:
            return True
        if not self.like.may_reach(np.minimum(a[1], b[1]).sum(), a[2] + b[2]):
            return True
        # the minima sum to (sizes - distance) / 2, and the gaps are the least distance
        gaps = np.maximum(0, np.maximum(a[0] - b[1], b[0] - a[1])).sum()
        most = a[3] + b[3]
        return not self.like.may_reach((most - gaps) / 2, most)

    def join(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of both points, and their bound as a share of their sizes."""
        found, left = [], [(0, 0)]
        while left:
            i, j = left.pop()
            a, b = self.boxes[i], self.boxes[j]
            if self._apart(a, b):
                continue
            if a[7] is None and b[7] is None:
                found.append(self._leaves(a, b, i == j))
            elif i == j:
                left += [(a[7][0], a[7][0]), (a[7][0], a[7][1]), (a[7][1], a[7][1])]
            elif b[7] is None or (a[7] is not None and a[6] - a[5] >= b[6] - b[5]):
                left += [(a[7][0], j), (a[7][1], j)]
            else:
                left += [(i, b[7][0]), (i, b[7][1])]
        if not found:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0)
        return tuple(np.concatenate(part) for part in zip(*found, strict=True))

    def _leaves(self, a: list, b: list, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        x, y = self.order[a[5] : a[6]], self.order[b[5] : b[6]]
        both = np.minimum(self.points[x][:, None, :], self.points[y][None, :, :]).sum(axis=2)
        sizes = self.sizes[x][:, None] + self.sizes[y][None, :]
        may = self.like.may_reach(both, sizes) & (self.labels[x][:, None] != self.labels[y][None, :])
        i, j = np.nonzero(np.triu(may, 1) if same else may)
        return x[i], y[j], both[i, j] / sizes[i, j]


def forests(a: np.ndarray, b: np.ndarray, bound: np.ndarray, labels: np.ndarray, count: int) -> list[tuple[int, int]]:
    """``count`` edge-disjoint spanning forests of the pairs, best bound first, where equal labels are one place."""
    order = np.lexsort((b, a, -bound))
    pairs = list(zip(a[order].tolist(), b[order].tolist(), strict=True))
    labels, taken = labels.tolist(), []
    for _ in range(count):
        up: dict[int, int] = {}

        def top(x: int, up: dict[int, int] = up) -> int:
            while (above := up.setdefault(x, x)) != x:
                up[x] = up[above]
                x = above
            return x

        rest = []
        for i, j in pairs:
            x, y = top(labels[i]), top(labels[j])
            if x == y:
                rest.append((i, j))
            else:
                up[max(x, y)] = min(x, y)
                taken.append((i, j))
        pairs = rest
        if not pairs:
            break
    return taken


def bucket_pairs(nodes: list[int], labels: np.ndarray, points: np.ndarray, refuted: list[list[int] | None], like: Likeness, count: int = FORESTS) -> list[tuple[int, int]]:
    """Pairs of a cell that are to be verified."""
    a, b, bound = Tree(points, labels, like).join()
    if len(a) and any(refuted):
        known = {(x, y) for x, others in zip(nodes, refuted, strict=True) for y in others or ()}
        open_ = np.array([(nodes[i], nodes[j]) not in known for i, j in zip(a.tolist(), b.tolist(), strict=True)], dtype=bool)
        a, b, bound = a[open_], b[open_], bound[open_]
    return [(max(nodes[i], nodes[j]), min(nodes[i], nodes[j])) for i, j in forests(a, b, bound, labels, count)]


def cell_pairs(cells: DataFrame, like: Likeness, count: int = FORESTS) -> DataFrame:
    """``a, b``: the pairs to verify, from rows ``cell, node, root, counts, refuted``."""
    bounded_batches(cells.sparkSession)
    fields = arrow_schema(cells.sparkSession, "a long, b long")
    dealt = cells.repartition("cell").sortWithinPartitions("cell", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, held, last = [], [], None

        def settled() -> list[tuple[int, int]]:
            # cells are bounded, so one of them fits; a node stands once in each
            points = np.frombuffer(b"".join(h[3] for h in held), dtype="<u4").reshape(len(held), GROUPS).astype(np.int64)
            return bucket_pairs([h[1] for h in held], np.array([h[2] for h in held]), points, [h[4] for h in held], like, count)

        for batch in batches:
            for row in zip(*(batch.column(n).to_pylist() for n in ("cell", "node", "root", "counts", "refuted")), strict=True):
                if held and row[0] != last:
                    made += settled()
                    held = []
                    if len(made) > 50_000:
                        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*made, strict=True)], schema=fields)
                        made = []
                last = row[0]
                held.append(row)
        made += settled() if held else []
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*made, strict=True)], schema=fields)

    return dealt.mapInArrow(run, "a long, b long").distinct()


# Rounds -----------------------------------------------------------------


def buckets_of(nodes: DataFrame) -> DataFrame:
    """``key, many, node``: the members of every bucket of two nodes or more, one bucket for each set of members."""
    # keys travel once: what stands alone under its key is left out where the key's rows meet
    each = nodes.select("node", F.explode("keys").alias("key"))
    many = F.count(F.lit(1)).over(Window.partitionBy("key"))
    members = stored(each.withColumn("many", many).where("many > 1"), "jaccard-shared")
    sets = members.groupBy("key", "many").agg(F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(SEED))).alias("y"))
    once = sets.groupBy("many", "x", "y").agg(F.min("key").alias("key"))
    return stored(members.join(stored(once.select("key"), "jaccard-buckets"), "key"), "jaccard-members")


def first_cells(rooted: DataFrame, page: int) -> DataFrame:
    """Every page of a bucket with the bucket's first page."""
    pages = F.ceil(F.col("many") / page)
    own = F.pmod(F.xxhash64("node", F.lit(7)), pages)
    into = F.when((pages > 1) & (own == 0), F.sequence(F.lit(1).cast("long"), F.greatest(pages - 1, F.lit(1)))).otherwise(F.array(own))
    dealt = rooted.select("key", "node", "root", F.explode(into).alias("i"))
    return dealt.select(F.struct("key", "i", F.lit(-1).cast("long").alias("j")).alias("cell"), "node", "root")


def later_cells(rooted: DataFrame, page: int) -> DataFrame:
    """The nodes outside of a bucket's most frequent component with each other and with those inside.

    Buckets that are one component are done.
    """
    by_root = rooted.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
    cores = by_root.groupBy("key").agg(F.max(F.struct("n", "root")).alias("core"), F.sum("n").alias("all"), F.count(F.lit(1)).alias("roots")).where("roots > 1")
    cores = stored(cores.select("key", F.col("core.root").alias("core"), F.ceil(F.col("core.n") / page).alias("inner"), F.ceil((F.col("all") - F.col("core.n")) / page).alias("outer"), "all"), "jaccard-cores")
    met = rooted.join(cores, "key")
    zero, inside = F.lit(0).cast("long"), F.col("root") == F.col("core")
    whole = F.col("all") <= 2 * page
    own = F.pmod(F.xxhash64("node", F.lit(7)), F.when(inside, F.col("inner")).otherwise(F.col("outer")))
    every = F.sequence(zero, F.col("outer") - 1)
    outer = F.transform(every, lambda o: F.struct(F.least(o, F.col("own")).alias("i"), F.greatest(o, F.col("own")).alias("j")))
    inner = F.transform(F.sequence(zero, F.col("inner") - 1), lambda i: F.struct((-1 - i).alias("i"), F.col("own").alias("j")))
    crossed = F.transform(every, lambda o: F.struct((-1 - F.col("own")).alias("i"), o.alias("j")))
    single = F.array(F.struct(zero.alias("i"), zero.alias("j")))
    into = F.when(whole, single).when(inside, crossed).otherwise(F.concat(outer, inner))
    dealt = met.withColumn("own", own).withColumn("at", F.explode(into))
    return dealt.select(F.struct("key", "at.i", "at.j").alias("cell"), "node", "root")


def verified(pairs: DataFrame, texts: DataFrame, length: int, like: Likeness) -> DataFrame:
    """``pairs`` with ``near``: whether the shingles themselves are alike enough.  ``texts`` are packed."""

    @F.pandas_udf("boolean")
    def near(a: pd.Series, b: pd.Series) -> pd.Series:
        sets: dict[bytes, frozenset] = {}
        unpack = zstandard.ZstdDecompressor().decompress
        out = []
        for x, y in zip(a, b, strict=True):
            x, y = (sets[t] if t in sets else sets.setdefault(t, frozenset(shingles(unpack(t).decode("utf-8"), length))) for t in (x, y))
            out.append(like.reached(len(x & y), len(x), len(y)))
            if len(sets) > 1000:
                sets.clear()
        return pd.Series(out, dtype=bool)

    left = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("_a")), "a")
    both = left.join(texts.select(F.col("node").alias("b"), F.col("text").alias("_b")), "b")
    return stored(both.select("a", "b", near("_a", "_b").alias("near")), "jaccard-verified")


def node_links(nodes: DataFrame, docs: DataFrame, length: int = SHINGLE, like: Likeness = Likeness(), page: int = PAGE) -> DataFrame:
    """``node, root`` of the nodes that are linked with another, from ``node, id, sha, keys, counts``."""
    spark = nodes.sparkSession
    members = buckets_of(nodes)
    wanted = stored(members.select("node").distinct().join(nodes.select("node", "id", "sha"), "node"), "jaccard-wanted")
    # about 100 bytes each; beyond that many the texts are dealt by their id instead
    wanted = F.broadcast(wanted) if wanted.count() <= BROADCAST_NODES else wanted
    whole = docs.select(F.col("doc_id").alias("_doc"), F.sha2(text_or_empty(), 256).alias("_digest"), text_or_empty().alias("text"))
    held = whole.join(wanted, F.col("_doc").eqNullSafe(F.col("id")) & (F.col("_digest") == F.col("sha")))

    @F.pandas_udf("binary")
    def packed(text: pd.Series) -> pd.Series:
        # texts travel three times from here on
        pack = zstandard.ZstdCompressor().compress
        return text.map(lambda t: pack(t.encode("utf-8")))

    texts = held.select("node", packed("text").alias("text"))
    texts = stored(texts.groupBy("node").agg(F.first("text").alias("text")), "jaccard-texts")
    checked, roots, turn = None, None, 0
    while True:
        if roots is None:
            rooted = members.withColumn("root", F.col("node"))
        else:
            rooted = stored(members.join(roots, "node", "left").select("key", "many", "node", F.coalesce("root", "node").alias("root")), "jaccard-rooted")
        cells = first_cells(rooted, page) if turn == 0 else later_cells(rooted, page)
        cells = cells.join(nodes.select("node", "counts"), "node")
        if checked is None:
            cells = cells.withColumn("refuted", F.lit(None).cast("array<long>"))
        else:
            wrong = checked.where("not near")
            each = wrong.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(wrong.select(F.col("b").alias("node"), F.col("a").alias("other")))
            known = stored(each.groupBy("node").agg(F.collect_set("other").alias("refuted")), "jaccard-refuted")
            cells = cells.join(known, "node", "left")
        pairs = stored(cell_pairs(cells, like, FORESTS * FOREST_GROWTH**turn), "jaccard-pairs")
        if turn and pairs.isEmpty():
            return roots
        found = verified(pairs, texts, length, like)
        checked = found if checked is None else checked.unionByName(found)
        if roots is None or not found.where("near").isEmpty():
            roots = stored(components(checked.where("near").select("a", "b")), "jaccard-roots")
        turn += 1


def groups(docs: DataFrame, length: int = SHINGLE, like: Likeness = Likeness(), page: int = PAGE) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row."""
    spark = docs.sparkSession
    with freeing_shuffles(spark):
        rows = stored(signed(docs, length, like), "jaccard-rows")
        place = F.struct(F.col("doc_id").isNull().alias("_null"), "doc_id", "sha")
        found = rows.where("n > 0").groupBy("digest").agg(F.min(place).alias("place"), F.first("keys").alias("keys"), F.first("counts").alias("counts"))
        nodes = stored(found.select(F.monotonically_increasing_id().alias("node"), "digest", F.col("place.doc_id").alias("id"), F.col("place.sha").alias("sha"), "keys", "counts"), "jaccard-nodes")
        roots = node_links(nodes, docs, length, like, page)
        rooted = nodes.select("node", "digest", "id").join(roots, "node", "left").select("digest", "id", F.coalesce("root", "node").alias("root"))
        rooted = stored(rooted, "jaccard-named")
        least = stored(rooted.groupBy("root").agg(F.min("id").alias("component_id")), "jaccard-least")
        named = stored(rooted.join(least, "root").select("digest", "component_id"), "jaccard-components")
    full = rows.where("n > 0").select("doc_id", "n", "digest").join(named, "digest").select("doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id")
    empty = rows.where("n = 0").select("doc_id", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return full.unionByName(empty)
