"""LM scoring with stupid backoff.

    S(w | context) = count(context w) / count(context)   if count(context w) >= MIN_COUNT
                   = ALPHA * S(w | shorter context)      otherwise,  S(w) = count(w) / words

Counts are of the whole corpus.  The flow is the relational one: explode every
text into its n-grams, count them in tables partitioned by n-gram hash, join
the counts back to the exploded n-grams, sum the logarithms per document.  So
that 100 million n-grams fit the shuffle, documents are dealt into blocks of
about ``BLOCK_BYTES`` by hash, and a block exchanges its distinct n-grams with
a count table's partition as one packed row: the sorted hashes go out, the
corpus counts come back in the same order.  An n-gram that repeats is counted
in its block first, so a frequent n-gram sends one entry per block.

Sorted hashes travel as differences, and numbers as byte planes under zstd: a
plane of high bytes is nearly constant, so a hash takes five bytes instead of
eight and a count a fraction of one.

An n-gram is its hash, cut to 48 bits beyond the partition number (64 bits in
all at most); as the partitions grow with the corpus, so does the hash.

Cases: null and empty texts have no words, score 0 and mean_score null; a text
of one word is scored by its unigram; rows that share a doc_id are scored one
by one, and every row counts in the tables; null doc_ids are carried along; an
empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Rolling, mix, word_spans
from .toxicity import byte_classes

ORDER, MIN_COUNT, ALPHA = 3, 2, 0.4
BLOCK_BYTES, PARTITION_KEYS = 8 << 20, 1 << 20
LOW_BITS = 48
WORDS_KEY = 0x5EED_0F_A11  # stands for the empty context, whose count is the number of words


def ngrams(texts: list[str | None], order: int, slab: int = 1 << 20) -> tuple[list[np.ndarray], np.ndarray]:
    """Hash of the n-gram that ends at each word, for n = 1..order (0 where the
    document has fewer words before), and each word's document."""
    lower, inside = byte_classes()
    words, docs, at = [], [], 0
    while at < len(texts):
        part, size = [], 0
        first = at
        while at < len(texts) and (not part or size < slab):
            part.append((texts[at] or "").encode())
            size += len(part[-1])
            at += 1
        data, offsets = lower[np.frombuffer(b"".join(part), dtype=np.uint8)], np.cumsum([0, *map(len, part)])
        start, end = word_spans(data, inside, offsets)
        words.append(Rolling(data).spans(start, end))
        docs.append(first + np.searchsorted(offsets, start, side="right") - 1)
    word = np.concatenate(words) if words else np.zeros(0, dtype=np.uint64)
    doc = np.concatenate(docs) if docs else np.zeros(0, dtype=np.int64)
    out = [word]
    for n in range(2, order + 1):
        gram = np.zeros(len(word), dtype=np.uint64)
        if len(word) >= n:
            gram[1:] = mix(out[-1][:-1] * np.uint64(0xD1342543DE82EF95) + word[1:] + np.uint64(n))
            gram[: n - 1] = 0
            gram[n - 1 :][doc[n - 1 :] != doc[: len(doc) - n + 1]] = 0
        out.append(gram)
    return out, doc


def squeezed(numbers: np.ndarray) -> bytes:
    """Unsigned numbers, all first bytes, all second bytes, ..., compressed."""
    wide = np.ascontiguousarray(numbers, dtype="<u8").view(np.uint8).reshape(-1, 8)
    return pa.compress(np.ascontiguousarray(wide.T), codec="zstd", asbytes=True)


def unsqueezed(packed: bytes, n: int) -> np.ndarray:
    wide = np.frombuffer(pa.decompress(packed, decompressed_size=8 * n, codec="zstd"), dtype=np.uint8).reshape(8, n)
    return np.ascontiguousarray(wide.T).view("<u8").ravel()


def low_bits(bits: int) -> int:
    """Hash bits of a key below its ``bits`` bits of partition number."""
    return min(LOW_BITS, 64 - bits)


def distinct_keys(grams: list[np.ndarray], bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys of a block, how often each occurs there, and for
    each entry of the joined ``grams`` the place of its key."""
    every = np.concatenate(grams)
    every = np.maximum(every >> np.uint64(64 - low_bits(bits) - bits), every > 0)
    keys, place, counts = np.unique(every, return_inverse=True, return_counts=True)
    return keys, place, counts


def partitions_of(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Count-table partitions that the sorted keys go to, and their first places."""
    part = (keys >> np.uint64(low_bits(bits))).astype(np.int64)
    first = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(part) else np.zeros(0, dtype=np.int64)
    return part[first], first


def score_documents(docs: DataFrame, order: int = ORDER, min_count: int = MIN_COUNT, alpha: float = ALPHA, block_bytes: int = BLOCK_BYTES, partition_keys: int = PARTITION_KEYS) -> DataFrame:
    """Per document: n_words, score (sum of ln S) and mean_score (per word)."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 1 + size // block_bytes
    bits = (size * order // 7 // partition_keys).bit_length()
    total_key = max(1, int(mix(np.array([WORDS_KEY], dtype=np.uint64))[0]) >> (64 - low_bits(bits) - bits))

    def keyed(table: pa.Table):
        grams, doc = ngrams(table.column("text").to_pylist(), order)
        keys, place, counts = distinct_keys([*grams, np.array([0, mix(np.array([WORDS_KEY], dtype=np.uint64))[0]], dtype=np.uint64)], bits)
        counts[0] = 0  # key 0: no n-gram
        counts[np.searchsorted(keys, np.uint64(total_key))] += len(doc) - 1
        return grams, doc, keys, place, counts

    def pack(table: pa.Table) -> pa.Table:
        _, _, keys, _, counts = keyed(table)
        parts, first = partitions_of(keys, bits)
        ends = np.r_[first[1:], len(keys)]
        low = keys & np.uint64((1 << low_bits(bits)) - 1)
        return pa.table(
            {
                "block": pa.array(np.full(len(parts), table.column("block")[0].as_py()), pa.int64()),
                "part": pa.array(parts, pa.int64()),
                "n": pa.array(ends - first, pa.int64()),
                "keys": pa.array([squeezed(np.diff(low[a:b], prepend=np.uint64(0))) for a, b in zip(first, ends)], pa.binary()),
                "counts": pa.array([squeezed(counts[a:b]) for a, b in zip(first, ends)], pa.binary()),
            }
        )

    def count(table: pa.Table) -> pa.Table:
        sizes = table.column("n").to_pylist()
        keys, own = (np.concatenate([unsqueezed(b, n) for b, n in zip(table.column(c).to_pylist(), sizes)]) for c in ("keys", "counts"))
        cuts = np.cumsum([0, *sizes])
        for a, b in zip(cuts[:-1], cuts[1:]):
            np.cumsum(keys[a:b], out=keys[a:b])
        _, place = np.unique(keys, return_inverse=True)
        total = np.bincount(place, own).astype("<u8")[place]
        return pa.table({"block": table.column("block"), "part": table.column("part"), "n": table.column("n"), "totals": pa.array([squeezed(total[a:b]) for a, b in zip(cuts[:-1], cuts[1:])], pa.binary())})

    kind = docs.schema["doc_id"].dataType.simpleString()

    def score(table: pa.Table, counted: pa.Table) -> pa.Table:
        if not table.num_rows:
            return pa.table({n: pa.array([], t) for n, t in (("doc_id", table.schema.field("doc_id").type), ("n_words", pa.int64()), ("score", pa.float64()))})
        grams, doc, keys, place, _ = keyed(table)
        rows = sorted(zip(*(counted.column(c).to_pylist() for c in ("part", "n", "totals"))))
        totals = np.concatenate([unsqueezed(b, size) for _, size, b in rows]).astype(float)
        n = len(doc)
        found = [totals[place[i * n : (i + 1) * n]] for i in range(order)]
        words = totals[np.searchsorted(keys, np.uint64(total_key))]
        value = np.log(np.maximum(found[0], 1) / max(words, 1))
        for i in range(1, order):
            context = np.r_[1.0, found[i - 1][:-1]] if n else found[i - 1]
            here = grams[i] > 0
            seen = here & (found[i] >= min_count)
            value = np.where(seen, np.log(np.maximum(found[i], 1) / np.maximum(context, 1)), value + np.where(here, np.log(alpha), 0.0))
        return pa.table(
            {
                "doc_id": table.column("doc_id"),
                "n_words": pa.array(np.bincount(doc, minlength=table.num_rows), pa.int64()),
                "score": pa.array(np.bincount(doc, value, minlength=table.num_rows), pa.float64()),
            }
        )

    dealt = docs.select("doc_id", "text", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).alias("block")).repartition("block")
    packed = dealt.groupBy("block").applyInArrow(pack, "block long, part long, n long, keys binary, counts binary")
    counted = packed.groupBy("part").applyInArrow(count, "block long, part long, n long, totals binary")
    scored = dealt.groupBy("block").cogroup(counted.groupBy("block")).applyInArrow(score, f"doc_id {kind}, n_words long, score double")
    return scored.withColumn("mean_score", F.when(F.col("n_words") > 0, F.col("score") / F.col("n_words")))
