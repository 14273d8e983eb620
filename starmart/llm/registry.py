"""The queries of this folder over the given tables, and the SQL of those that SQL expresses."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm import jaccard_join, jaccard_join_sql, language, mixing, neighbours, order_minhash, packing, secret_scan, simhash, suffix_dedup, token_counts, toxicity, turn_repair, turn_repair_sql, whitening
from starmart.llm.common import fold, table
from starmart.sources.scratch import stored

VOCABULARY = "byte_bpe_50k.json"
TOKEN_LIMIT = 512
TOXIC_AT = 0.3


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def packed(docs: DataFrame) -> DataFrame:
    """Digests of the packed pieces of ``docs``."""
    pieces = packing.windows(docs, public_tokenizers.path(VOCABULARY))
    digests = pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    return packing.pack(digests, packing.most_pieces(docs))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs, language.train(docs))
    return found.select("doc_id", (fold("doc_id", language.FOLDS) == 0).alias("held_out"), "lang_pred", "score")


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(table(spark, sf_dir, "documents"))
    counts = [secret_scan.count_of(F.col("base"), k).alias(f"n_{k}") for k in secret_scan.KINDS]
    return found.select("doc_id", *counts, F.sha2(secret_scan.joined(F.col("base")), 256).alias("base_sha256"), secret_scan.joined(F.col("spans")).alias("spans"), "unread")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = mixing.draws(table(spark, sf_dir, "documents"))
    return drawn.select("doc.doc_id", "doc.source", "n_tokens", "pass", "block", "block_order")


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    held_out = fold("doc_id", toxicity.FOLDS) == toxicity.HELD_OUT
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= TOXIC_AT).cast("int").alias("predicted"), F.size("offending").alias("n_offending"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.without_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return cut.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op10_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = order_minhash.fingerprints(table(spark, sf_dir, "documents"))
    return made.select("doc_id", F.char_length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), F.col("signature").alias("fingerprint"), F.col("edited_signature").alias("edited_fingerprint"), "near_edited", "near_next")


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.repair(table(spark, sf_dir, "conversations"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.groups(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = (op1_token_counts, op2_packing, op3_simhash, op4_language, op5_secrets, op6_mixing, op7_neighbours, op8_toxicity, op9_suffix_dedup, op10_order_minhash, op11_turn_repair, op12_whitening, op13_jaccard_join, pipeline)
    return {f.__name__: f for f in named}


def oracles() -> dict[str, str]:
    return {"op9_suffix_dedup": SUFFIX_DEDUP_SQL, "op11_turn_repair": turn_repair_sql.SQL, "op13_jaccard_join": jaccard_join_sql.SQL}


# Bytes are pairs of hexadecimal digits here.
SUFFIX_DEDUP_SQL = """
with d as (select doc_id, lower(hex(encode(coalesce(text, '')))) as h from documents),
w as (
    select doc_id, p, substring(h, 2 * p + 1, 200) as s
    from (select doc_id, h, unnest(range(0, length(h) // 2 - 99)) as p from d where length(h) >= 200)
),
late as (
    select doc_id, p
    from (select doc_id, p, row_number() over (partition by s order by doc_id, p) as turn from w)
    where turn > 1
),
islands as (
    select doc_id, min(p) as a, max(p) + 100 as b
    from (
        select doc_id, p, sum(new) over (partition by doc_id order by p) as island
        from (
            select doc_id, p, case when p - lag(p) over (partition by doc_id order by p) <= 100 then 0 else 1 end as new
            from late
        )
    )
    group by doc_id, island
),
gaps as (
    select doc_id, a as at, lag(b, 1, 0) over (partition by doc_id order by a) as start, a as stop from islands
    union all
    select d.doc_id, length(d.h) // 2, coalesce(i.b, 0), length(d.h) // 2
    from d left join (select doc_id, max(b) as b from islands group by doc_id) i using (doc_id)
),
kept as (
    select g.doc_id, string_agg(substring(d.h, 2 * g.start + 1, 2 * (g.stop - g.start)), '' order by g.start, g.at) as h
    from gaps g join d using (doc_id)
    group by g.doc_id
)
select d.doc_id, length(d.h) // 2 as n_bytes, (length(d.h) - length(k.h)) // 2 as n_removed,
       (select count(*) from islands i where i.doc_id = d.doc_id) as n_spans, sha256(unhex(k.h)) as kept_sha256
from d join kept k using (doc_id)
"""
