"""Helpers shared by the operators: byte slabs, hashes, ranks, components.

The numpy helpers work on a *slab*: the texts of some documents laid end to
end in one byte array.  ``Rolling`` keeps prefix sums of a polynomial with an
odd multiplier modulo 2**64, so the hash of any span is one subtraction and
one multiplication, and equal spans have equal hashes wherever they stand.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cataloom.session import ensure_checkpoint_dir

BROADCAST_BYTES = 32 * 1024 * 1024
BASE = 0x9E3779B97F4A7C15 | 1
SLAB_BYTES = 1 << 20


def checkpoint(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder of ``spark.checkpoint.dir``."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def broadcast_if_small(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint when ``df`` (already checkpointed) holds at most ``limit``
    bytes by its exact row count; otherwise the join shuffles both sides."""
    return F.broadcast(df) if df.count() * row_bytes <= limit else df


def gapless(df: DataFrame, groups: list[str], order: list[str], spread: str, name: str, rows_per_block: int = 20_000) -> DataFrame:
    """Number the rows of each group 0, 1, 2, ... without one task per group.

    Rows are dealt into blocks by the hash of ``spread``; ranks are taken in
    each (group, block) and shifted by the running count of the blocks before.
    ``df`` must be checkpointed and ``order`` must be a total order, so that a
    recomputed task numbers its rows the same way.  ``groups`` hold no null.
    """
    blocks = 1 + df.count() // rows_per_block
    dealt = df.withColumn("_block", F.pmod(F.xxhash64(spread), F.lit(blocks)).cast("int"))
    keys = [*groups, "_block"]
    before = Window.partitionBy(*groups).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    shift = dealt.groupBy(*keys).count().withColumn("_shift", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
    ranked = dealt.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1)
    return ranked.join(shift, keys).withColumn(name, F.col("_shift") + F.col("_rank")).drop("_block", "_rank", "_shift")


def components(links: DataFrame, task_rows: int | None = None) -> DataFrame:
    """(node, root) for every node of the (u, v) links; root is the smallest
    node of its component.

    Large-star and small-star rounds: minima are aggregated before the
    shuffle, so the neighbours of a hub never meet in one row.  Each round is
    checkpointed; the rounds grow with the logarithm of the longest path.
    ``task_rows`` keeps a graph of few links in few tasks, so many links each.
    """
    edges = checkpoint(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen, rows = None, edges.count() if task_rows else 0
    few = lambda df: df.coalesce(1 + rows // task_rows) if task_rows else df
    while True:
        edges = few(edges)
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = few(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = few(few(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct())
        least = few(large.groupBy("u").agg(F.min("v").alias("m")))
        small = few(large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
        edges = checkpoint(few(small.union(least).distinct()))
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen, rows = now, now[0]
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# ---- numpy side -----------------------------------------------------------


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n, kept between calls."""
    have = _POWERS.get("n", 0)
    if have < n:
        have = 1 << max(20, int(n - 1).bit_length())
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            out = np.full(have, base, dtype=np.uint64)
            out[0] = 1
            _POWERS[name] = np.multiply.accumulate(out)
        _POWERS["n"] = have
    return _POWERS["up"][:n], _POWERS["down"][:n]


_POWERS: dict = {}


def byte_codes() -> np.ndarray:
    """256 fixed odd 64-bit codes, from a rule, so that bytes differ in all bits."""
    return mix(np.arange(1, 257, dtype=np.uint64)) | np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser (splitmix64): spreads every bit over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Rolling:
    """Span hashes of one byte array."""

    def __init__(self, data: np.ndarray):
        up, self.down = powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(byte_codes()[data] * up[: len(data)], out=self.sums[1:])

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])

    def grams(self, k: int) -> np.ndarray:
        n = len(self.sums) - k
        if n <= 0:
            return np.zeros(0, dtype=np.uint64)
        return mix((self.sums[k:] - self.sums[:n]) * self.down[:n])


def slabs(batches, limit: int = SLAB_BYTES):
    """(columns, texts, byte array, offsets) for runs of rows whose texts come
    to about ``limit`` bytes; the batches' last column is the text, a null text
    is empty."""
    for batch in batches:
        rows = [c.to_pylist() for c in batch.columns[:-1]]
        texts = [(t or "").encode() for t in batch.column(batch.num_columns - 1).to_pylist()]
        at = 0
        while at < len(texts):
            to, size = at, 0
            while to < len(texts) and (to == at or size + len(texts[to]) <= limit):
                size += len(texts[to])
                to += 1
            part = texts[at:to]
            yield [r[at:to] for r in rows], part, np.frombuffer(b"".join(part), dtype=np.uint8), np.cumsum([0, *map(len, part)])
            at = to


def word_spans(data: np.ndarray, inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every run of bytes with ``inside[byte]``, broken at
    document bounds."""
    is_word = np.zeros(len(data) + 2, dtype=bool)
    is_word[1:-1] = inside[data]
    bound = np.zeros(len(data) + 1, dtype=bool)
    bound[offsets] = True
    starts = np.flatnonzero(is_word[1:-1] & (~is_word[:-2] | bound[:-1]))
    ends = np.flatnonzero(is_word[1:-1] & (~is_word[2:] | bound[1:])) + 1
    return starts, ends
