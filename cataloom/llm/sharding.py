"""Sharding: weighted rendezvous hashing of a stable record key.

Every shard scores every key, ``-weight / ln(u)`` with ``u`` in (0, 1) from a
hash of key and shard number, and the highest score takes the row.  A score
depends on its own shard alone, so a new shard takes rows only into itself,
about its share of the total weight.  DataFrame functions only.

Cases: a null key counts as the empty key; a null text has zero bytes and the
checksum of no bytes; equal rows (repeated rows) get the same shard and
different slots; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, gapless


def rendezvous(key: Column, weights: list[float]) -> Column:
    """Number of the shard that takes ``key``, from 0; equal scores: the lower."""
    key = F.coalesce(key.cast("string"), F.lit(""))

    def score(shard: int, weight: float) -> Column:
        u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 12) + F.lit(0.5)) / F.lit(float(1 << 52))  # never 0 or 1
        return F.struct((F.lit(-float(weight)) / F.log(u)).alias("score"), F.lit(-shard).alias("neg"))

    return -F.array_max(F.array(*[score(i, w) for i, w in enumerate(weights)]))["neg"]


def shard_documents(docs: DataFrame, weights: list[float], key: str = "doc_id", text: str = "text", grow_weight: float = 1.0) -> DataFrame:
    """key, size (bytes + 1), text_crc32, shard, slot (gapless in the shard)
    and grown_shard (with one more shard of ``grow_weight``)."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(key),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        rendezvous(F.col(key), weights).alias("shard"),
        rendezvous(F.col(key), [*weights, grow_weight]).alias("grown_shard"),
        F.monotonically_increasing_id().alias("_row"),
    )
    order = [key, "text_crc32", "size", "_row"]
    return gapless(checkpoint(rows), ["shard"], order, "_row", "slot").drop("_row")
