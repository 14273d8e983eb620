"""Order MinHash fingerprints, sensitive to the edit distance of texts.

Every k-mer of code points gets the number of its earlier occurrences, and the two
together are hashed.  The hashes fall into ``SLOTS`` parts by their leading bits; in each
part the ``TUPLE`` least are taken, put back into text order, and their k-mers hashed as
one tuple.  A signature is the row of these tuple hashes.  It changes where k-mers are
replaced, repeated another number of times, or moved past each other.

Likeness is derived from the share of equal slots among those that either text fills.

Results: a text shorter than a k-mer is one k-mer as a whole; a null or empty text has no
k-mer, fingerprint zero throughout, likeness 1 to itself and 0 to others.  Equal texts
have equal fingerprints.  Rows stand in ascending order of id, nulls last, and rows with one
id in the order of their texts' hashes; the row after the last is the first, and a row alone is
its own next.  An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import arrow_schema, text_or_empty

K = 6
SLOT_BITS = 6
SLOTS = 1 << SLOT_BITS
TUPLE = 2
# Hashes kept for each slot at first; where that leaves a slot short, all are looked at.
AHEAD = 14
# A k-mer is known by the other 40 bits of its hash.
PLACE_BITS = np.uint64(24)

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
MIXER = np.uint64(0xD6E8FEB86659FD93)


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x *= MIXER
    x ^= x >> np.uint64(29)
    x *= MULTIPLIER
    x ^= x >> np.uint64(32)
    return x


def signature(text: str) -> np.ndarray:
    """A text's ``SLOTS`` tuple hashes of 16 bits; 0 is an empty slot."""
    out = np.zeros(SLOTS, dtype=np.uint16)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    if not len(codes):
        return out
    k = min(K, len(codes))
    n = len(codes) - k + 1
    kmers = np.zeros(n, dtype=np.uint64)
    for t in range(k):
        kmers *= MULTIPLIER
        kmers += codes[t : t + n]
    kmer, place = in_groups(mixed(kmers) >> PLACE_BITS)
    index = np.arange(n)
    begin = np.where(np.concatenate(([True], kmer[1:] != kmer[:-1])), index, 0)
    occurrence = (index - np.maximum.accumulate(begin)).astype(np.uint64)
    hashes = mixed(kmer * MULTIPLIER + occurrence)
    inner = np.uint64(64 - SLOT_BITS)
    if n > 2 * AHEAD * SLOTS:
        least = np.flatnonzero((hashes & np.uint64((1 << int(inner)) - 1)) < np.uint64((1 << int(inner)) // n * AHEAD * SLOTS))
        if np.bincount((hashes[least] >> inner).astype(np.int64), minlength=SLOTS).min() < TUPLE:
            least = index
    else:
        least = index
    order = least[np.argsort(hashes[least], kind="stable")]
    slot = (hashes[order] >> inner).astype(np.int64)
    first = np.searchsorted(slot, np.arange(SLOTS + 1))
    size = np.minimum(np.diff(first), TUPLE)
    taken = first[:-1, None] + np.arange(TUPLE)
    there = np.arange(TUPLE) < size[:, None]
    rows = order[np.where(there, taken, 0)] if n else taken
    places = np.where(there, place[rows].astype(np.int64), np.int64(1) << 62)
    in_text = np.take_along_axis(rows, np.argsort(places, axis=1, kind="stable"), axis=1)
    total = np.zeros(SLOTS, dtype=np.uint64)
    for t in range(TUPLE):
        total = np.where(t < size, mixed(total * MULTIPLIER + kmer[in_text[:, t]] + np.uint64(t + 1)), total)
    short = (total >> np.uint64(48)).astype(np.uint16)
    short[short == 0] = 1
    return np.where(size > 0, short, 0).astype(np.uint16)


def in_groups(kmers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """k-mers sorted, equal ones in text order, and their places."""
    n = len(kmers)
    if n >> int(PLACE_BITS):
        order = np.argsort(kmers, kind="stable")
        return kmers[order], order.astype(np.uint64)
    # with the place in the low bits one plain sort does it
    keyed = (kmers << PLACE_BITS) | np.arange(n, dtype=np.uint64)
    keyed.sort()
    return keyed >> PLACE_BITS, keyed & np.uint64((1 << int(PLACE_BITS)) - 1)


def digits(signature_: np.ndarray) -> str:
    return signature_.astype(">u2").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The share of text in common that equal slots speak for.

    Of slots filled by either, the part m that is equal estimates the chance that all of a tuple is
    shared, so J = m ** (1 / TUPLE) estimates the shared part of both texts' k-mers together,
    and 2J / (1 + J) that of one of two equally long texts.
    """
    filled = (a != 0) | (b != 0)
    if not (n := int(filled.sum())):
        return 1.0
    both = (int((a == b)[filled].sum()) / n) ** (1 / TUPLE)
    return 2 * both / (1 + both)


def edited(text: str, following: str) -> str:
    """The last half of a text replaced by as many characters of the next, or all of it."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def beside_next(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """``part, doc_id, text, guest`` for which each part is to be read in order.

    Rows are dealt by ranges of the id.  The first row of each part is copied to the part before
    as its last row, a guest, so that every row finds its next one in its own part.
    """
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select("doc_id", text_or_empty().alias("text"))
    limits = rows.agg(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)] or [0.5], 10_000)).first()[0] or []
    limits = sorted(set(limits))
    bounds = F.array(*[F.lit(x) for x in limits]) if limits else F.array().cast("array<long>")
    # rows of one id share a part, and the nulls are the end of the last
    part = F.when(F.col("doc_id").isNull(), len(limits)).otherwise(F.size(F.filter(bounds, lambda x: x < F.col("doc_id"))))
    placed = rows.withColumn("part", part.cast("int"))
    place = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.xxhash64("text"))
    firsts = placed.groupBy("part").agg(F.min(place).alias("p")).orderBy("part").select("part", "p.*").collect()
    if not firsts:
        return placed.withColumn("guest", F.lit(False))
    # one row for each part: as short as the number of parts, so it may be broadcast
    before = [(firsts[i - 1]["part"], f[2], f[3]) for i, f in enumerate(firsts)]
    heads = F.broadcast(spark.createDataFrame(before, f"part int, _id {rows.schema['doc_id'].dataType.simpleString()}, _hash long"))
    met = rows.join(heads, rows["doc_id"].eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_hash")))
    guest = met.select("doc_id", "text", "part").dropDuplicates(["part", "doc_id"])
    return placed.withColumn("guest", F.lit(False)).unionByName(guest.withColumn("guest", F.lit(True)))


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, text, edited, signature, edited_signature, near_edited, near_next``.

    Signatures are hexadecimal digits, four for each slot.
    """
    rows = beside_next(docs).withColumn("_hash", F.xxhash64("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionById(parts, F.col("part")).sortWithinPartitions("part", "guest", F.col("doc_id").asc_nulls_last(), "_hash")
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, text string, edited string, signature string, edited_signature string, near_edited double, near_next double"
    fields = arrow_schema(docs.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row, which waits for its next one
        out: list[tuple] = []
        size = 0
        for batch in batches:
            for part, doc_id, text, guest in zip(*(batch.column(c).to_pylist() for c in ("part", "doc_id", "text", "guest")), strict=True):
                own = signature(text)
                if held is not None:
                    changed = edited(held[1], text)
                    theirs = signature(changed)
                    out.append((held[0], held[1], changed, digits(held[2]), digits(theirs), likeness(held[2], theirs), likeness(held[2], own)))
                    size += len(text)
                # a guest is the end of its part
                held = None if guest else (doc_id, text, own)
                if size > 8_000_000:
                    yield record(out)
                    out, size = [], 0
        if out:
            yield record(out)

    def record(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*out, strict=True), fields, strict=True)], schema=fields)

    return dealt.select("part", "doc_id", "text", "guest").mapInArrow(run, schema)
