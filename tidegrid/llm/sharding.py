"""Sharding: rendezvous hashing of stable record keys over weighted shards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from tidegrid.llm.common import checkpoint, pick

#: Rows of one partition that are numbered by one window.
BLOCK_ROWS = 1 << 18


def rendezvous_shard(key: Column, weights: Sequence[float]) -> Column:
    """The shard that wins ``key``: the least of -ln(u) / weight over the shards, u being a hash of key
    and shard. A shard's score doesn't depend on the others, so one more shard takes rows only into
    itself and a dropped shard gives up only its own. Ties go to the lower shard. A null key hashes as
    the number 42 does in ``xxhash64``, so all null keys share a shard.
    """
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive")
    scores = []
    for shard, weight in enumerate(weights):
        # the upper 52 bits of the hash, moved into (0, 1)
        u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 12).cast("double") + 0.5) / float(1 << 52)
        scores.append(F.struct((-F.ln(u) / float(weight)).alias("score"), F.lit(shard).alias("shard")))
    return F.array_min(F.array(*scores))["shard"] if len(scores) > 1 else F.lit(0)


def assign_shards(
    docs: DataFrame, weights: Sequence[float] = (1.0,) * 16, next_weight: float = 1.0, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, size, text_crc32, law, shard, slot, grown_shard) for every row; other columns don't matter.

    size is the text's UTF-8 bytes plus one (null text: 1, crc32 0). ``grown_shard`` is the shard with
    one more shard of ``next_weight``. ``slot`` numbers each shard's rows from 0 without gaps. Repeated
    rows get one shard and slots of their own; an empty table gives no rows.

    Rows are numbered without sorting a shard: the digest rows are checkpointed, each partition is cut
    into blocks, one window numbers (shard, block) and the blocks' counts give the offsets. A hot key
    therefore never makes a group larger than ``BLOCK_ROWS``.
    """
    body = F.coalesce(F.col("c1"), F.lit(""))
    keyed = pick(docs, key, text).toDF("c0", "c1")
    placed = keyed.select(
        F.col("c0").alias("doc_id"),
        (F.octet_length(body) + F.lit(1)).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        rendezvous_shard(F.col("c0"), weights).alias("shard"),
        rendezvous_shard(F.col("c0"), [*weights, next_weight]).alias("grown_shard"),
    )
    # partitions and their order are fixed once written, so row numbers are the same in both reads
    at = F.monotonically_increasing_id()
    blocked = checkpoint(placed).withColumn("at", at).withColumn("block", F.floor(F.col("at") / F.lit(BLOCK_ROWS)))
    before = W.Window.partitionBy("shard").orderBy("block").rowsBetween(W.Window.unboundedPreceding, -1)
    offsets = (
        blocked.groupBy("shard", "block").agg(F.count(F.lit(1)).alias("n"))
        .select("shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    )
    within = W.Window.partitionBy("shard", "block").orderBy("at")
    return (
        blocked.withColumn("nth", F.row_number().over(within))
        .join(offsets, ["shard", "block"])
        .select(
            F.col("doc_id").alias(key), "size", "text_crc32", F.lit("key").alias("law"), F.col("shard").cast("int").alias("shard"),
            (F.col("offset") + F.col("nth") - 1).cast("long").alias("slot"), F.col("grown_shard").cast("int").alias("grown_shard"),
        )
    )
