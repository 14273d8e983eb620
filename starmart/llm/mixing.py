"""Mixing sources by temperature.

A source's share of all tokens is raised to an exponent and the results are made to sum to
one.  The exponent is bisected until the weights reach a target entropy, or until no source
is repeated more often than a limit.  Each source then gets its weight's part of a token
budget, in whole passes over its blocks and one last pass that stops where the budget
ends; every pass takes the blocks in another order.

A source is cut into ``BLOCKS`` blocks by a hash of the row, so a block is a bounded
share of its source at any size, and no step holds a source as one group: only
(source, block) sums meet.

Results: a null source is a source of its own; a null or empty text has no tokens and goes
with its block; repeated rows are drawn as often as they stand there; a source without any
token has no weight and costs no budget, and its rows are drawn once; an empty table
gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import text_or_empty
from starmart.sources.scratch import stored

BLOCKS = 1024
MOST_REPEATS = 2.0
STEPS = 24


@dataclass(frozen=True)
class Target:
    """What the exponent is bisected for; exactly one of the two is given.

    ``entropy``: of the weights, as a share of the greatest possible (that of equal weights).
    ``repeats``: the most passes over any source, where the source passed over least has one.
    """

    entropy: float | None = None
    repeats: float | None = None


def word_count(text: Column) -> Column:
    """Tokens by default: runs of characters that are no white space."""
    return F.regexp_count(text, F.lit(r"\S+"))


def exponent(shares: DataFrame, target: Target) -> float:
    """The exponent in [0, 1] that meets ``target`` for ``shares`` (``share``, all above zero).

    Each step of the bisection is one aggregate over the sources.  Entropy falls and repeats
    fall as the exponent grows, so the least exponent with few enough repeats and the greatest
    with enough entropy are found the same way.
    """
    if (target.entropy is None) == (target.repeats is None):
        raise ValueError("give an entropy or a repeat limit")
    log = F.log("share")

    def meets(a: float) -> bool:
        if target.repeats is not None:
            # passes over a source are in proportion to share ** (a - 1)
            low, high = shares.agg(F.min(log * (a - 1)), F.max(log * (a - 1))).first()
            return high - low > _log(target.repeats)
        powered = F.exp(log * a)
        total, moment, n = shares.agg(F.sum(powered), F.sum(powered * log * a), F.count(F.lit(1))).first()
        return n < 2 or _log(total) - moment / total >= target.entropy * _log(n)

    low, high = 0.0, 1.0
    for _ in range(STEPS):
        middle = (low + high) / 2
        low, high = (middle, high) if meets(middle) else (low, middle)
    return high if target.repeats is not None else low


def _log(x: float) -> float:
    import math

    return math.log(x)


def with_blocks(docs: DataFrame, tokens: Column | None, seed: int) -> DataFrame:
    """``doc`` (the row), its source, tokens and block."""
    count = word_count(text_or_empty()) if tokens is None else tokens
    block = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text"), F.lit(BLOCKS)).cast("int")
    return docs.select(F.struct("*").alias("doc"), F.col("source").alias("_source"), count.cast("long").alias("_tokens"), block.alias("_block"))


@dataclass
class Plan:
    """``weights``: source, tokens, weight, budget, passes.  ``blocks``: how often each is drawn."""

    exponent: float
    weights: DataFrame
    blocks: DataFrame


def plan(rows: DataFrame, target: Target, budget: int | None, seed: int) -> Plan:
    """How often each block is drawn, from rows with ``_source, _block, _tokens``.

    Without a ``budget`` it is the least at which no source is passed over less than once.
    """
    sums = stored(rows.groupBy("_source", "_block").agg(F.sum("_tokens").alias("tokens")), "mixing-blocks")
    sources = sums.groupBy("_source").agg(F.sum("tokens").alias("source_tokens")).where("source_tokens > 0")
    everything = sources.agg(F.sum("source_tokens")).first()[0] or 0
    shares = stored(sources.withColumn("share", F.col("source_tokens") / F.lit(float(everything or 1))), "mixing-sources")
    a = exponent(shares, target) if everything else 1.0
    powered = F.pow("share", F.lit(a))
    total, least = shares.agg(F.sum(powered), F.min(powered / F.col("source_tokens"))).first()
    weight = powered / F.lit(total or 1.0)
    whole = float(budget) if budget is not None else (total or 1.0) / (least or 1.0)
    weights = shares.select("_source", "source_tokens", weight.alias("weight"), (weight * whole).alias("budget"), (weight * whole / F.col("source_tokens")).alias("passes"))

    # whole passes draw every block; the last one draws blocks in its own order up to the budget
    full = F.floor(F.col("passes") + 1e-9)
    order = F.xxhash64(F.lit(seed), F.lit("order"), "_source", full, "_block")
    before = F.sum("tokens").over(Window.partitionBy("_source").orderBy("_order", "_block"))
    rest = F.col("budget") - full * F.col("source_tokens")
    drawn = sums.join(weights, sums["_source"].eqNullSafe(weights["_source"]), "left").drop(weights["_source"])
    drawn = drawn.withColumn("_order", order).withColumn("_filled", before)
    passed = (full + F.when((rest >= 1) & (F.col("_filled") <= rest), 1).otherwise(0)).cast("int")
    blocks = drawn.select("_source", "_block", "tokens", F.when(F.col("source_tokens").isNull(), 1).otherwise(passed).alias("draws"))
    return Plan(a, weights, stored(blocks.where("draws > 0"), "mixing-draws"))


def draws(docs: DataFrame, target: Target | None = None, budget: int | None = None, tokens: Column | None = None, seed: int = 42) -> DataFrame:
    """Each drawn copy of a row: ``doc`` (all its columns), ``n_tokens, pass, block, block_order``.

    ``block_order`` is a long; within a source and pass, blocks stand in its order.
    """
    rows = with_blocks(docs, tokens, seed)
    made = plan(rows, target or Target(repeats=MOST_REPEATS), budget, seed)
    # at most BLOCKS rows for each source: small beside the documents, yet joined by size, not by a hint
    blocks = made.blocks.select(F.col("_source").alias("_s"), F.col("_block").alias("_b"), "draws")
    taken = rows.join(blocks, rows["_source"].eqNullSafe(F.col("_s")) & (rows["_block"] == F.col("_b")))
    each = taken.withColumn("pass", F.explode(F.sequence(F.lit(0), F.col("draws") - 1)))
    order = F.xxhash64(F.lit(seed), F.lit("order"), "_source", F.col("pass").cast("long"), "_block")
    return each.select("doc", F.col("_tokens").alias("n_tokens"), "pass", F.col("_block").alias("block"), order.alias("block_order"))


def mixed(docs: DataFrame, target: Target | None = None, budget: int | None = None, tokens: Column | None = None, seed: int = 42) -> DataFrame:
    """``docs`` mixed: rows repeated or left out as drawn, columns as they were."""
    return draws(docs, target, budget, tokens, seed).select("doc.*")
