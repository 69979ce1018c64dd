"""SimHash near-dedup: fingerprints and a binary-trie self-join.

A fingerprint bit is set when it is set in over half of the shingle hashes.
Two fingerprints within ``distance`` bits agree on at least one of
``distance + 1`` equal blocks, so the trie is built once for each block
rotated to the front, and the traversal starts at the pairs (node, itself)
below that block.  From there pairs of nodes are walked down together, bit by
bit; the bits in which their paths differ add up, and a pair is dropped once
they exceed the budget.  A node with more than ``node_rows`` fingerprints is
split eight bits further into its admissible child pairs, by Spark and over
all tasks, before a task walks it; so no task holds an unbounded node.

Links inside a walked pair leave the task as a star per connected set (at most
one row per fingerprint), never as all pairs; ``components`` joins them up.

Cases: a null or empty text (no word) has fingerprint zero and links like any
other; fewer words than ``shingle`` form one shingle; rows with a null doc_id
are fingerprinted but take no part in linking (component_id null); repeated
rows and equal texts share a fingerprint; an empty table gives no rows; extra
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, components

#: Production parameters.
SHINGLE, DISTANCE, NODE_ROWS = 3, 3, 2048
CHUNK_WORDS = 1 << 16


def fingerprint(text: str | None, shingle: int) -> int:
    """64-bit SimHash of the whole text, as an unsigned number."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    total, ones = 0, np.zeros(64, dtype=np.int64)
    for at in range(0, max(1, len(words) - shingle + 1), CHUNK_WORDS):
        part = words[at : at + CHUNK_WORDS + shingle - 1]
        grams = zip(*(part[i:] for i in range(shingle))) if len(part) >= shingle else [part]
        hashes = np.array([xxh64_intdigest(b" ".join(g), 42) for g in grams], dtype=">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
        total += len(hashes)
    return int(np.packbits(2 * ones > total).view(">u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id and ``fp``, the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, shingle) for t in batch.column(1).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, fp long")


def walk(keys: np.ndarray, nodes: list[tuple[int, int, int, int, int]], bit: int, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of ``keys`` within ``budget`` bits of each other.

    ``keys`` are sorted inside each node; ``nodes`` are (a from, a to, b from,
    b to, differing bits so far), a node paired with itself given twice.  All
    pairs go down one bit at a time, from ``bit`` to 0.
    """
    a0, a1, b0, b1, diff = (np.array(c, dtype=np.int64) for c in zip(*nodes))
    found = [(a0[:0], b0[:0])]
    for b in range(bit, -2, -1):
        own = a0 == b0
        live = (a1 > a0) & (b1 > b0) & (diff <= budget) & ~(own & (a1 - a0 < 2))
        leaf = live & ~own & (a1 - a0 == 1) & (b1 - b0 == 1)
        u, v = a0[leaf], b0[leaf]
        near = np.bitwise_count(keys[u] ^ keys[v]) <= budget
        found.append((u[near], v[near]))
        a0, a1, b0, b1, diff, own = (x[live & ~leaf] for x in (a0, a1, b0, b1, diff, own))
        if b < 0 or not len(a0):
            break
        ones = np.concatenate([[0], np.cumsum((keys >> np.uint64(b)) & np.uint64(1))]).astype(np.int64)
        am, bm = a1 - (ones[a1] - ones[a0]), b1 - (ones[b1] - ones[b0])
        other = ~own
        parts = ((a0, am, b0, bm, diff), (am, a1, bm, b1, diff), (a0, am, bm, b1, diff + 1), tuple(x[other] for x in (am, a1, b0, bm, diff + 1)))
        a0, a1, b0, b1, diff = (np.concatenate(c) for c in zip(*parts))
    return tuple(np.concatenate(c) for c in zip(*found))


def star(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Smallest index linked with each of ``n`` by the links (u, v)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        for x in (u, v, label[u], label[v]):
            np.minimum.at(new, x, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def link_nodes(prefix: int, budget: int, pairs: int = 1 << 22):
    """Arrow batches of (block, lo, hi, key) sorted by the first three ->
    (u, v) links; a run of whole nodes is walked at once, up to ``pairs``
    possible pairs."""

    def rotate(x: np.ndarray, by: np.ndarray, right: bool = False) -> np.ndarray:
        by = (64 - by) % 64 if right else by
        return (x << by) | np.where(by > 0, x >> ((np.uint64(64) - by) % np.uint64(64)), np.uint64(0))

    def linked(cols: list[np.ndarray], width: int) -> pa.RecordBatch | None:
        block, lo, hi, key = cols[0], cols[1], cols[2], cols[3].view(np.uint64)
        side = (key >> np.uint64(64 - prefix)).astype(np.int64) != lo
        order = np.lexsort((key, side, hi, lo, block))
        block, lo, hi, key, side = (c[order] for c in (block, lo, hi, key, side))
        fresh = np.flatnonzero(np.r_[True, (np.diff(block) != 0) | (np.diff(lo) != 0) | (np.diff(hi) != 0)])
        ends = np.r_[fresh[1:], len(key)]
        right = np.add.reduceat(side.astype(np.int64), fresh)
        cross = lo[fresh] != hi[fresh]
        mid = np.where(cross, ends - right, fresh)
        apart = np.bitwise_count((lo ^ hi)[fresh].view(np.uint64)).astype(np.int64)
        nodes = list(zip(fresh, np.where(cross, mid, ends), np.where(cross, mid, fresh), ends, apart))
        u, v = walk(key, nodes, 63 - prefix, budget)
        if not len(u):
            return None
        label = star(len(key), u, v)
        fp = rotate(key, (block * width).astype(np.uint64), right=True).view(np.int64)
        at = np.flatnonzero(label != np.arange(len(key)))
        return pa.RecordBatch.from_arrays([pa.array(fp[at]), pa.array(fp[label[at]])], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = 64 // (budget + 1)
        held = [np.zeros(0, dtype=np.int64)] * 4
        for batch in batches:
            held = [np.r_[h, batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64)] for i, h in enumerate(held)]
            new = np.flatnonzero(np.r_[True, (np.diff(held[0]) != 0) | (np.diff(held[1]) != 0) | (np.diff(held[2]) != 0)])
            cost, at = 0, 0
            for first, size in zip(new[:-1], np.diff(new)):  # the last node may go on in the next batch
                if cost and cost + size * size > pairs:
                    if (out := linked([h[at:first] for h in held], width)) is not None:
                        yield out
                    cost, at = 0, first
                cost += size * size
            if cost:
                if (out := linked([h[at : new[-1]] for h in held], width)) is not None:
                    yield out
                at = new[-1]
            held = [h[at:] for h in held]
        if len(held[0]) and (out := linked(held, width)) is not None:
            yield out

    return run


def trie_links(fps: DataFrame, distance: int = DISTANCE, node_rows: int = NODE_ROWS) -> DataFrame:
    """(u, v) links that connect all distinct fingerprints ``fp`` within
    ``distance`` bits.  ``fps`` is checkpointed and holds each value once."""
    width = 64 // (distance + 1)
    turns = [F.struct(F.lit(b).alias("block"), F.expr(f"(fp << {b * width}) | shiftrightunsigned(fp, {64 - b * width})" if b else "fp").alias("key")) for b in range(distance + 1)]
    rows = fps.select(F.explode(F.array(*turns)).alias("x")).select("x.block", "x.key")
    prefix = width
    top = F.expr(f"shiftrightunsigned(key, {64 - prefix})")
    rows = rows.select("block", top.alias("lo"), top.alias("hi"), "key")
    masks = F.array(*[F.lit(m) for m in range(256) if m.bit_count() <= distance])
    node, links = ["block", "lo", "hi"], []
    while True:
        right = F.count_if(F.expr(f"shiftrightunsigned(key, {64 - prefix}) <> lo"))
        sizes = rows.groupBy(*node).agg(F.count("*").alias("n"), right.alias("r"))
        sizes = checkpoint(sizes.where("n > 1 and (lo = hi or (r > 0 and r < n))"))
        ready = rows.join(sizes.where(F.col("n") <= node_rows).select(*node), node, "left_semi") if prefix < 64 else rows.join(sizes.select(*node), node, "left_semi")
        # dealt by a key that is not the join's: Spark drops a repartition by the
        # join's own, and is then free to deal the rows of a node over many tasks
        dealt = ready.repartition(F.xxhash64(*node)).sortWithinPartitions(*node)
        links.append(dealt.mapInArrow(link_nodes(prefix, distance), "u long, v long"))
        large = sizes.where(F.col("n") > node_rows).select(*node)
        if prefix + 8 > 64 or not large.take(1):
            return links[0] if len(links) == 1 else _union(links)
        split = rows.join(large, node, "left_semi").select("block", "lo", "hi", "key", F.explode(masks).alias("mask"))
        split = split.where(F.bit_count(F.col("lo").bitwiseXOR(F.col("hi"))) + F.bit_count("mask") <= distance)
        prefix += 8
        mine = F.expr(f"shiftrightunsigned(key, {64 - prefix})")
        old = F.expr(f"shiftrightunsigned(key, {64 - prefix + 8})")
        partner = F.when(F.col("lo") == old, F.col("hi")).otherwise(F.col("lo"))
        digit = mine.bitwiseAND(F.lit(255)).bitwiseXOR(F.col("mask").cast("long"))
        split = split.withColumns({"_mine": mine, "_other": F.shiftleft(partner, 8).bitwiseOR(digit)})
        rows = split.select("block", F.least("_mine", "_other").alias("lo"), F.greatest("_mine", "_other").alias("hi"), "key")
        rows = checkpoint(rows.distinct())


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.union(f)
    return out


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, node_rows: int = NODE_ROWS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, the smallest
    doc_id that links reach."""
    rows = checkpoint(fingerprints(docs, shingle))
    known = rows.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("first"))
    known = checkpoint(known)
    roots = components(trie_links(known.select("fp"), distance, node_rows)).withColumnRenamed("node", "fp")
    named = known.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    ids = named.join(least, "root").select("fp", "component_id")
    out = rows.join(ids, "fp", "left").withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id")))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, **params) -> DataFrame:
    """The documents without near duplicates: of each component the row with
    the smallest doc_id, once; rows without a doc_id stay."""
    groups = near_duplicates(docs, **params)
    kept = groups.where("doc_id = component_id").select("doc_id").distinct()
    again = checkpoint(groups.where("doc_id = component_id").groupBy("doc_id").count().where("count > 1").select("doc_id"))
    rest = docs.join(kept, "doc_id", "left_semi")
    if again.take(1):  # rows that repeat a doc_id: one of them
        rest = rest.join(again, "doc_id", "left_anti").unionByName(rest.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id"]))
    return rest.select(*docs.columns).unionByName(docs.where("doc_id is null"))
