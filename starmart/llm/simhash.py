"""SimHash fingerprints and their near-duplicates by meet-in-the-middle ball hashing.

Every distinct fingerprint emits all variants within half the radius.  Two fingerprints
within the radius have a variant in common, and two that share a variant are within the
radius, so the fingerprints that meet at a variant are linked to the least of them (no
pairs are listed; at most 65 fingerprints can meet at one variant).  Links are deduplicated
and verified by counting bits, and their connected components are the groups.

Results: a null or empty text, or one of white space alone, has fingerprint zero and is linked
like any other.  Repeated rows and equal texts share a fingerprint.  A null id takes no
part in choosing a group's id, which is null only if every id of the group is.  An
empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import bounded_batches, per_row, text_or_empty
from starmart.llm.components import components
from starmart.sources.scratch import stored

BITS = 64
SEED = 42
SHINGLE = 3
RADIUS = 2


def simhash(text: str, shingle: int = SHINGLE) -> int:
    """Bit i is 1 if over half of the shingles' hashes have it."""
    words = text.encode("utf-8").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > shingle:
        starts, ends = starts[: 1 - shingle], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], dtype="<u8")
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 65_536):
        ones += np.unpackbits(hashes[at : at + 65_536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, fp``: the fingerprint of every whole text as a signed long."""
    kept = docs.select("doc_id", text_or_empty().alias("text"))
    kind = kept.schema["doc_id"].dataType.simpleString()

    def rows(batch: pa.RecordBatch) -> dict:
        made = [simhash(t, shingle) for t in batch.column("text").to_pylist()]
        return {"doc_id": batch.column("doc_id"), "fp": pa.array(np.array(made, dtype=np.uint64).view(np.int64))}

    return per_row(kept, f"doc_id {kind}, fp long", rows)


def variants(fp: Column, half: int) -> Column:
    """All values within ``half`` bits (0 or 1) of ``fp``."""
    if half > 1:
        raise ValueError("radii above 3 are not provided")
    masks = [0] + [1 << i if i < BITS - 1 else -(1 << i) for i in range(BITS)] * half
    return F.explode(F.transform(F.array(*map(F.lit, masks)), lambda m: fp.bitwiseXOR(m)))


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Verified links ``a, b`` that connect what is within an even ``radius``, from distinct ``fp``."""
    if radius % 2:
        raise ValueError("the radius is cut into halves")
    balls = prints.select("fp", variants(F.col("fp"), radius // 2).alias("variant"))
    least = F.min("fp").over(Window.partitionBy("variant"))
    met = balls.withColumn("least", least).where(F.col("fp") != F.col("least"))
    return met.select(F.col("fp").alias("a"), F.col("least").alias("b")).distinct().where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)


def near_duplicates(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, fp, component_id`` of every row; component_id is the least id of its group."""
    rows = stored(fingerprints(docs, shingle), "simhash")
    prints = rows.groupBy("fp").agg(F.min("doc_id").alias("least_id"))
    roots = components(links(prints.select("fp"), radius))
    grouped = prints.join(roots, prints["fp"] == roots["node"], "left").select("fp", "least_id", F.coalesce("root", "fp").alias("root"))
    # written first: a join of two plain tables is one that a large group does not hold up
    least = stored(grouped.groupBy("root").agg(F.min("least_id").alias("component_id")), "simhash-groups")
    named = grouped.select("fp", "root").join(least, "root").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each group, columns as they were.

    That of the least id stays (nulls last); of rows that repeat the id, the one whose text
    has the least digest.
    """
    bounded_batches(docs.sparkSession)

    @F.pandas_udf("long")
    def fp_of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([simhash(t) for t in texts], dtype=np.uint64).view(np.int64))

    # a row's place in the choice; its fingerprint is a function of the text, so of its place
    rows = docs.select(F.col("doc_id").alias("_id"), F.sha2(text_or_empty(), 256).alias("_sha"), fp_of(text_or_empty()).alias("_fp"))
    place = F.struct(F.col("_id").isNull().alias("_null"), "_id", "_sha")
    prints = stored(rows.groupBy("_fp").agg(F.min(place).alias("_least")), "simhash")
    roots = components(links(prints.select(F.col("_fp").alias("fp")), radius))
    grouped = prints.join(roots, prints["_fp"] == roots["node"], "left").withColumn("_root", F.coalesce("root", "_fp"))
    best = grouped.groupBy("_root").agg(F.min("_least").alias("_least")).select("_least._id", "_least._sha")
    return rows_at(docs, best)


def rows_at(docs: DataFrame, best: DataFrame) -> DataFrame:
    """The rows of ``docs`` at the places ``_id, _sha``, one for each place."""
    # the texts meet the places, so nothing is fingerprinted again and a large group is no hot key
    whole = docs.select(F.struct("*").alias("doc"), F.sha2(text_or_empty(), 256).alias("_digest"))
    held = whole.join(best, F.col("doc.doc_id").eqNullSafe(F.col("_id")) & (F.col("_digest") == F.col("_sha")))
    # combined before the shuffle, so a row that is repeated very often is one row of each task
    return held.groupBy("_id", "_sha").agg(F.first("doc").alias("doc")).select("doc.*")
