"""MinHash near-dedup: banded candidates, odd sketches, exact confirmation.

A document's set is its distinct word shingles.  ``SAMPLES`` MinHash values are
taken of it; the first ``ROWS * BANDS`` make its band keys, and all of them are
folded into an *odd sketch*: each sample flips one bit, so the sketch is a
parity bitmap.  Two sketches differ in about ``BITS / 2 * (1 - exp(-4 * SAMPLES
* (1 - J) / BITS))`` bits, which tells high similarities apart well and costs a
few XORs and population counts.  With 6 rows and 40 bands two sets of
similarity 0.85 share no band once in 10^8; a sketch count above the one of
similarity ``LEAST`` is over five standard deviations off there.

Documents with equal sets are one class, so copies cost nothing further.
Classes that share a band key form a bucket, and every pair in a bucket that
may be similar is confirmed on the full sets, without listing all pairs of a
large bucket:

* a hub round (or more): in each bucket the class that shares most buckets
  overall, the likely original of a family, is paired with the others.  Links
  found name what is connected; the hub leaves the bucket, having met all of
  it, and buckets that are connected throughout are done;
* what is left: the remaining classes of each bucket meet in blocks of bounded
  size inside tasks, by their sketches.  Pairs not yet connected whose set sizes
  and sketches allow the similarity join classes to families, and within a
  family, in blocks again, such pairs are confirmed.  Both times a star per
  connected set comes out, at most one link per class and block.

Pairs are confirmed by the sizes of the sets' intersection and union, where a
shingle is a 64-bit hash of its words.  Nothing is capped: a bucket of any size
goes through blocks, one task per pair of blocks.

Cases: null texts and texts without a word have an empty set, link with nothing
and are their own component; fewer words than a shingle are one shingle; rows
without a doc_id link like others (component_id is the least doc_id there is in
the component, null if there is none) and are kept only in a component without
ids; repeated rows and doc_ids are rows of their own; an empty table gives no
rows; extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Rolling, broadcast_if_small, checkpoint, components, mix, slabs, union_all, word_spans
from .simhash import star

#: Production parameters.
SHINGLE, PERCENT = 3, 85
ROWS, BANDS, SAMPLES, BITS, LEAST = 6, 40, 512, 1024, 0.74
HUB_ROUNDS, BLOCK_ROWS, BLOCK_SHINGLES = 1, 2048, 1 << 20
TASK_LINKS = 200_000
SKETCH_DOCS, CHUNK_SHINGLES, STAR_PAIRS = 1024, 1 << 13, 1 << 18


def shingles(data: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each document of a slab."""
    lower, inside = np.arange(256, dtype=np.uint8), np.ones(256, dtype=bool)
    lower[65:91] += 32
    inside[[32, *range(9, 14)]] = False
    data = lower[data]
    start, end = word_spans(data, inside, offsets)
    word = Rolling(data).spans(start, end)
    first = np.searchsorted(start, offsets)
    gram, grams = word, [word]
    for n in range(2, size + 1):
        last, gram = gram, np.zeros(len(word), dtype=np.uint64)
        gram[1:] = mix(last[:-1] * np.uint64(0xD1342543DE82EF95) + word[1:] + np.uint64(n))
        grams.append(gram)
    out = []
    for a, b in zip(first[:-1], first[1:]):
        n = min(size, b - a)  # the gram that ends at a word takes n words
        out.append(np.unique(grams[n - 1][a + n - 1 : b]) if n else word[:0])
    return out


def multipliers() -> np.ndarray:
    """One odd 32-bit multiplier for each sample, from a rule."""
    return (mix(np.arange(1, SAMPLES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def sketch(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Band keys and odd sketches (rows of 64-bit words) of nonempty sets."""
    hashes = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    first = np.cumsum([0, *map(len, sets)])[:-1]
    least, product = np.empty((SAMPLES, len(sets)), dtype=np.uint64), np.empty_like(hashes)
    for sample, odd in enumerate(multipliers()):
        np.multiply(hashes, odd, out=product)
        least[sample] = np.minimum.reduceat(product, first)
    least += np.arange(SAMPLES, dtype=np.uint64)[:, None] << np.uint64(32)
    keys = np.zeros((BANDS, len(sets)), dtype=np.uint64)
    for row in range(ROWS):
        keys = mix(keys * np.uint64(0xD1342543DE82EF95) + least[row : ROWS * BANDS : ROWS] + np.uint64(1))
    bit = (mix(least) & np.uint64(BITS - 1)).astype(np.int64) + np.arange(len(sets)) * BITS
    parity = np.bincount(bit.ravel(), minlength=len(sets) * BITS) & 1
    return keys.T, np.packbits(parity.astype(np.uint8)).view("<u8").reshape(len(sets), -1)


def sketch_rows(size: int, kind: pa.DataType):
    """(doc_id, t1, t2, text) batches -> the documents' set sizes and sketches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns, texts, data, offsets in slabs(batches):
            sets = shingles(data, offsets, size)
            for a in range(0, len(sets), SKETCH_DOCS):
                some = sets[a : a + SKETCH_DOCS]
                full = [i for i, s in enumerate(some) if len(s)]
                rows = [[None] * len(some) for _ in range(3)]
                if full:
                    for i, keys, odd in zip(full, *sketch([some[i] for i in full])):
                        rows[0][i], rows[1][i], rows[2][i] = blake2b(some[i].tobytes(), digest_size=16).digest(), keys.view(np.int64), odd.view(np.int64)
                longs = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(columns[0][a : a + SKETCH_DOCS], kind),
                        pa.array(columns[1][a : a + SKETCH_DOCS], pa.int64()),
                        pa.array(columns[2][a : a + SKETCH_DOCS], pa.int64()),
                        pa.array([len(s) for s in some], pa.int64()),
                        *(pa.array(r, t) for r, t in zip(rows, (pa.binary(), longs, longs))),
                    ],
                    names=["doc_id", "t1", "t2", "n", "digest", "keys", "odd"],
                )

    return run


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text and two hashes that name the row's content."""
    t1, t2 = F.xxhash64("doc_id", "text"), F.xxhash64("text", F.lit(1), "doc_id")
    return docs.select("doc_id", t1.alias("t1"), t2.alias("t2"), "text")


def sketches(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """doc_id, t1, t2, n (set size), digest of the set, band keys, odd sketch."""
    from pyspark.sql.pandas.types import to_arrow_type

    kind = docs.schema["doc_id"].dataType
    schema = f"doc_id {kind.simpleString()}, t1 long, t2 long, n long, digest binary, keys array<long>, odd array<long>"
    return _keyed(docs).mapInArrow(sketch_rows(size, to_arrow_type(kind)), schema)


def most_bits(least: float = LEAST) -> int:
    """Bits in which two sketches of this similarity differ."""
    return int(BITS / 2 * (1 - math.exp(-4 * SAMPLES * (1 - least) / BITS)))


def _possible(percent: int):
    """Whether set sizes n1, n2 and sketches o1, o2 allow the similarity."""
    apart = sum((F.bit_count(F.col("o1")[i].bitwiseXOR(F.col("o2")[i])) for i in range(BITS // 64)), F.lit(0))
    return (100 * F.least("n1", "n2") >= percent * F.greatest("n1", "n2")) & (apart <= most_bits())


def set_rows(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (nodes,), _, data, offsets in slabs(batches):
            packed = [s.tobytes() for s in shingles(data, offsets, size)]
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(packed, pa.binary())], names=["node", "shingles"])

    return run


def similar_pairs(percent: int):
    """(u, v, two sets) batches -> the pairs that are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for i, (a, b) in enumerate(zip(batch.column(2), batch.column(3))):
                one, two = (np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in (a, b))
                both = len(one) + len(two) - len(np.unique(np.concatenate([one, two])))
                if 100 * both >= percent * (len(one) + len(two) - both):
                    keep.append(i)
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at)], names=["u", "v"])

    return run


def set_table(nodes: DataFrame, reps: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """(node, shingles) of the classes named in ``nodes``, read from the texts."""
    wanted = checkpoint(reps.join(nodes, "node", "left_semi").select("node", "t1", "t2"))
    texts = _keyed(docs).join(broadcast_if_small(wanted, 32), ["t1", "t2"]).select("node", "text")
    return checkpoint(texts.mapInArrow(set_rows(size), "node long, shingles binary").dropDuplicates(["node"]))


def confirmed(pairs: DataFrame, reps: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """The (u, v) class pairs whose full sets are similar enough."""
    one = reps.select(F.col("node").alias("u"), F.col("n").alias("n1"), F.col("odd").alias("o1"))
    two = reps.select(F.col("node").alias("v"), F.col("n").alias("n2"), F.col("odd").alias("o2"))
    likely = checkpoint(pairs.join(one, "u").join(two, "v").where(_possible(percent)).select("u", "v"))
    sets = set_table(likely.select(F.col("u").alias("node")).union(likely.select("v")).distinct(), reps, docs, size)
    first = sets.select(F.col("node").alias("u"), F.col("shingles").alias("s1"))
    second = sets.select(F.col("node").alias("v"), F.col("shingles").alias("s2"))
    both = likely.join(first, "u").join(second, "v").select("u", "v", "s1", "s2")
    return checkpoint(both.mapInArrow(similar_pairs(percent), "u long, v long"))


def shared_shingles(sets: list[np.ndarray], u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sets u[i] and v[i] (u sorted): rows of bits
    over the shingles that two sets or more hold, a chunk of shingles at a time."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    twice = times > 1
    number = np.cumsum(twice) - 1
    held = twice[column]
    owner, column = owner[held], number[column[held]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros(len(u), dtype=np.int32)
    first = np.flatnonzero(np.r_[True, u[1:] != u[:-1]]) if len(u) else np.zeros(0, dtype=np.int64)
    for start in range(0, int(twice.sum()), CHUNK_SHINGLES):
        x, y = np.searchsorted(column, [start, start + CHUNK_SHINGLES])
        ones = np.zeros((len(sets), CHUNK_SHINGLES), dtype=bool)
        ones[owner[x:y], column[x:y] - start] = True
        bits = np.packbits(ones, axis=1).view(np.uint64)
        for a, b in zip(first, np.r_[first[1:], len(u)]):
            out[a:b] += np.bitwise_count(bits[v[a:b]] & bits[u[a]]).sum(axis=1, dtype=np.int32)
    return out


def possible_pairs(rows: pa.Table, percent: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (u, v), u in order, of the pairs of one group, or of two blocks of
    it, that lie in different components and whose sizes and sketches allow the
    similarity."""
    own = rows.column("left")[0].as_py() == rows.column("right")[0].as_py()
    part, root, n = (rows.column(c).to_numpy() for c in ("part", "root", "n"))
    odd = rows.column("odd").combine_chunks().flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(len(n), -1)
    left = part == rows.column("left")[0].as_py()
    a = np.arange(len(n)) if own else np.flatnonzero(left)
    b = a if own else np.flatnonzero(~left)
    u, v = [np.zeros(0, dtype=np.int32)], [np.zeros(0, dtype=np.int32)]
    for i, x in enumerate(a):
        others = b[i + 1 :] if own else b
        others = others[(root[others] != root[x]) & (100 * np.minimum(n[others], n[x]) >= percent * np.maximum(n[others], n[x]))]
        others = others[np.bitwise_count(odd[others] ^ odd[x]).sum(axis=1, dtype=np.int64) <= bits]
        u.append(np.full(len(others), x, dtype=np.int32))
        v.append(others.astype(np.int32))
    return np.concatenate(u), np.concatenate(v)


def stars(n: int, u: np.ndarray, v: np.ndarray, keep) -> tuple[np.ndarray, np.ndarray]:
    """A star per set that the pairs connect of which ``keep(from, to)`` holds;
    so many pairs at a time, what is linked so far being one star each."""
    label = every = np.arange(n)
    for x in range(0, len(u), STAR_PAIRS):
        held = keep(x, x + STAR_PAIRS)
        label = star(n, np.r_[every, u[x : x + STAR_PAIRS][held]], np.r_[label, v[x : x + STAR_PAIRS][held]])
    linked = np.flatnonzero(label != every)
    return linked, label[linked]


def group_links(rows: pa.Table, percent: int, bits: int, confirm: bool) -> pa.RecordBatch | None:
    """Links of one group as stars: of all possible pairs, or of those that the
    full sets confirm."""
    u, v = possible_pairs(rows, percent, bits)
    if not len(u):
        return None
    node, n = (rows.column(c).to_numpy() for c in ("node", "n"))
    if confirm:
        both = shared_shingles([np.frombuffer(s, dtype=np.uint64) for s in rows.column("shingles").to_pylist()], u, v)
    keep = lambda x, y: 100 * both[x:y] >= percent * (n[u[x:y]] + n[v[x:y]] - both[x:y]) if confirm else slice(None)
    linked, to = stars(len(node), u, v, keep)
    return pa.RecordBatch.from_arrays([pa.array(node[linked]), pa.array(node[to])], names=["u", "v"])


def grouped_links(percent: int, bits: int, confirm: bool):
    """Rows sorted by (key, left, right) -> (u, v) links of every group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            names = [batch.column(c).to_numpy() for c in ("key", "left", "right")]
            new = np.flatnonzero(np.r_[True, np.any([x[1:] != x[:-1] for x in names], axis=0)]) if batch.num_rows else []
            for start, end in zip(new, [*new[1:], batch.num_rows]):
                name = tuple(int(x[start]) for x in names)
                if name != now and held and (out := group_links(pa.Table.from_batches(held), percent, bits, confirm)) is not None:
                    yield out
                held = [*(held if name == now else []), batch.slice(start, end - start)]
                now = name
        if held and (out := group_links(pa.Table.from_batches(held), percent, bits, confirm)) is not None:
            yield out

    return run


def links_in_groups(rows: DataFrame, percent: int, block_rows: int, confirm: bool) -> DataFrame:
    """(u, v) links within each group ``key`` of the rows (key, node, root, n,
    odd, with ``shingles`` to confirm); a large group is dealt into blocks of so
    many classes, or shingles, on average, and each pair of blocks is gone
    through by itself."""
    load = [F.count("*") / block_rows, *([F.sum("n") / BLOCK_SHINGLES] if confirm else [])]
    sizes = rows.groupBy("key").agg((F.greatest(*load) if confirm else load[0]).cast("int").alias("blocks"))
    dealt = rows.join(sizes, "key").withColumn("part", F.pmod(F.xxhash64("node"), F.col("blocks") + 1).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks"))))
    dealt = dealt.withColumns({"left": F.least("part", "other"), "right": F.greatest("part", "other")}).drop("other", "blocks")
    dealt = dealt.repartition("key", "left", "right").sortWithinPartitions("key", "left", "right", "node")
    return checkpoint(dealt.mapInArrow(grouped_links(percent, most_bits(), confirm), "u long, v long"))


def remaining_links(live: DataFrame, reps: DataFrame, docs: DataFrame, size: int, percent: int, block_rows: int) -> DataFrame:
    """(u, v) links between different components within each bucket of (key,
    node, root): the pairs that sketches allow join classes to families, and
    the full sets of each family are sent together once."""
    light = reps.select("node", "n", "odd")
    families = components(links_in_groups(live.join(light, "node"), percent, block_rows, False), TASK_LINKS).withColumnRenamed("root", "key")
    roots = live.groupBy("node").agg(F.min("root").alias("root"))
    members = checkpoint(families.join(roots, "node").join(light, "node"))
    full = members.join(set_table(members.select("node"), reps, docs, size), "node")
    return links_in_groups(full, percent, block_rows, True)


def class_links(reps: DataFrame, docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, hub_rounds: int = HUB_ROUNDS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Confirmed (u, v) links that connect all classes whose sets are similar."""
    rows = reps.select("node", F.explode("keys").alias("key"))
    sizes = rows.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    live = checkpoint(rows.join(sizes, "key"))
    popular = live.groupBy("node").agg(F.sum("size").alias("popular"))
    live = checkpoint(live.select("key", "node").join(popular, "node").withColumn("root", F.col("node")))
    links: list[DataFrame] = []
    for _ in range(hub_rounds):
        hubs = live.groupBy("key").agg(F.max(F.struct("popular", "node", "root")).alias("hub"))
        met = live.join(checkpoint(hubs.select("key", F.col("hub.node").alias("hub"), F.col("hub.root").alias("hub_root"))), "key").where("node <> hub")
        pairs = met.where("root <> hub_root").select(F.least("node", "hub").alias("u"), F.greatest("node", "hub").alias("v")).distinct()
        links.append(confirmed(pairs, reps, docs, size, percent))
        both = union_all([x.select(F.col(c).alias("node"), F.least("u", "v").alias("near")) for x in links for c in ("u", "v")])
        # classes of one neighbour are connected; the hub has met its bucket and stays out of it
        near = both.groupBy("node").agg(F.min("near").alias("near"))
        rest = met.select("key", "node", "popular").join(near, "node", "left").withColumn("root", F.coalesce("near", "node")).drop("near")
        open_ = rest.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a < b").select("key")
        live = checkpoint(rest.join(open_, "key", "left_semi"))
    if live.take(1) or not links:
        links.append(remaining_links(live.select("key", "node", "root"), reps, docs, size, percent, block_rows))
    return union_all(links)


def near_duplicates(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, hub_rounds: int = HUB_ROUNDS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row."""
    rows = checkpoint(sketches(docs, size).withColumn("_row", F.monotonically_increasing_id()))
    full = rows.where("n > 0")
    classes = checkpoint(full.groupBy("digest").agg(F.min("_row").alias("node"), F.min("doc_id").alias("first")))
    reps = full.withColumnRenamed("_row", "node").join(classes.select("node"), "node", "left_semi")
    reps = checkpoint(reps.select("node", "t1", "t2", "n", "keys", "odd"))
    roots = components(class_links(reps, docs, size, percent, hub_rounds, block_rows), TASK_LINKS)
    named = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    ids = named.join(least, "root").select("digest", "component_id")
    out = rows.select("doc_id", "n", "digest").join(ids, "digest", "left")
    out = out.withColumn("component_id", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")))
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
