"""Document fingerprints from prefix polynomial hashes.

``PrefixHash`` keeps modular prefix arrays of a text's UTF-8 bytes for two
prime moduli: any span's hash is a difference of two entries, so span equality
takes constant time and the longest common extension of two positions a binary
search.  A fingerprint is the hash and length of the whole text followed by
the least span hash of each of ``BINS`` classes of span hashes (spans of
``SPAN`` bytes), as 16 bits mixed from all of it, so that chance agreement is
2**-16 a class however long the texts are; the share of classes in which two fingerprints agree
estimates the Jaccard likeness of their span sets.

Cases: a null text is empty; an empty text has no span, and is like (1.0) an
empty text alone; a text shorter than a span is one span; equal texts have
equal fingerprints and likeness 1.0; rows that share a doc_id are ordered by
text, null doc_ids come last; a single row is its own next document; an empty
table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix

PRIMES = (2**31 - 1, 2**31 - 19)
BASES = (1_000_003, 69_069_069)
SPAN, BINS = 16, 64
_KEPT: dict = {}


def _powers(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(base**i, base**-i) modulo each prime for i <= n."""
    if _KEPT.get("n", 0) <= n:
        size = 1 << max(16, int(n + 1).bit_length())
        tables = []
        for p, base in zip(PRIMES, BASES):
            pair = []
            for b in (base, pow(base, -1, p)):
                out = np.ones(1, dtype=np.uint64)
                while len(out) < size:
                    out = np.concatenate([out, out * np.uint64(pow(b, len(out), p)) % np.uint64(p)])
                pair.append(out)
            tables.append(tuple(pair))
        _KEPT.update(n=size - 1, tables=tables)
    return [(up[: n + 1], down[: n + 1]) for up, down in _KEPT["tables"]]


class PrefixHash:
    """Prefix arrays of one text; positions and lengths count bytes."""

    def __init__(self, text: bytes):
        data = np.frombuffer(text, dtype=np.uint8).astype(np.uint64) + np.uint64(1)
        self.n = len(data)
        self.down, self.prefix = [], []
        for p, (up, down) in zip(PRIMES, _powers(self.n)):
            sums = np.zeros(self.n + 1, dtype=np.uint64)
            np.cumsum(data * up[: self.n] % np.uint64(p), out=sums[1:])  # under 2**31 each: exact below 2**33 bytes
            self.prefix.append(sums)
            self.down.append(down)

    def spans(self, start, end) -> np.ndarray:
        """62-bit hashes of the spans [start, end)."""
        high, low = (
            (s[end] - s[start]) % np.uint64(p) * d[start] % np.uint64(p) for p, s, d in zip(PRIMES, self.prefix, self.down)
        )
        return (high << np.uint64(31)) | low

    def grams(self, k: int) -> np.ndarray:
        """Hashes of all spans of ``k`` bytes, by start."""
        m = self.n - k + 1
        high, low = (
            (s[k:] - s[:m]) % np.uint64(p) * d[:m] % np.uint64(p) for p, s, d in zip(PRIMES, self.prefix, self.down)
        )
        return (high << np.uint64(31)) | low

    def equal(self, start: int, other: "PrefixHash", at: int, length: int) -> bool:
        """Whether ``length`` bytes from ``start`` equal ``other``'s from ``at``."""
        if start + length > self.n or at + length > other.n:
            return False
        return bool(self.spans(start, start + length) == other.spans(at, at + length))

    def common_extension(self, start: int, other: "PrefixHash", at: int) -> int:
        """Longest length for which ``equal`` holds, by binary search."""
        low, high = 0, min(self.n - start, other.n - at)
        while low < high:
            mid = (low + high + 1) // 2
            low, high = (mid, high) if self.equal(start, other, at, mid) else (low, mid - 1)
        return low


def sketch(text: bytes) -> tuple[int, np.ndarray]:
    """Hash of the whole text and 16 mixed bits of the least span hash of each class (0: none)."""
    least = np.zeros(BINS, dtype=np.uint64)
    if not text:
        return 0, least
    hashes = PrefixHash(text)
    whole = int(mix(np.array([hashes.spans(0, hashes.n) ^ np.uint64(hashes.n << 1)], dtype=np.uint64))[0])
    values = mix(hashes.grams(min(SPAN, hashes.n)))
    shift = np.uint64(64 - BINS.bit_length() + 1)
    inner = (np.uint64(1) << shift) - np.uint64(1)
    few = values[(values & inner) <= np.uint64(min(1.0, 16 * BINS / len(values)) * float(inner) * 0.999)] if len(values) > 64 * BINS else values
    bins = np.sort(few)
    if len(few) < len(values) and len(np.unique(bins >> shift)) < BINS:
        bins = np.sort(values)
    cls = (bins >> shift).astype(np.int64)
    first = np.flatnonzero(np.r_[True, cls[1:] != cls[:-1]])
    least[cls[first]] = (mix(bins[first]) & np.uint64(0xFFFF)) | np.uint64(1 << 16)  # a least hash's own high bits go to 0 as texts grow
    return whole, least


def encode(made: tuple[int, np.ndarray]) -> str:
    """16 hex digits of the whole text's hash, then four per class, ---- for none."""
    whole, least = made
    return f"{whole:016x}" + "".join(f"{int(x) & 0xFFFF:04x}" if x else "----" for x in least)


def likeness(a: tuple[int, np.ndarray], b: tuple[int, np.ndarray]) -> float:
    """Share of classes in which both sketches hold the same span, of those that
    either holds; equal sketches: 1."""
    if a[0] == b[0] and (a[1] == b[1]).all():
        return 1.0
    either = (a[1] > 0) | (b[1] > 0)
    return float(((a[1] == b[1]) & either).sum() / either.sum()) if either.any() else 0.0


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by as much of ``following``'s start."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


SCHEMA = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def neighbour_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (block, guest, doc_id, text) sorted in each block, each compared with
    the next; a guest is the first row of the block after, it only follows."""
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    before = None
    for batch in batches:
        out: dict[str, list] = {n: [] for n in names}
        for block, guest, doc, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
            text = text or ""
            made = sketch(text.encode())
            if before is not None and before[0] == block:
                other = edited(before[2], text).encode()
                new = sketch(other)
                row = (before[1], len(before[2]), hashlib.sha256(other).hexdigest(), encode(before[3]), encode(new), likeness(before[3], new), likeness(before[3], made))
                for n, v in zip(names, row):
                    out[n].append(v)
            before = None if guest else (block, doc, text, made)
        kinds = [batch.schema.field(2).type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        yield pa.RecordBatch.from_arrays([pa.array(out[n], type=k) for n, k in zip(names, kinds)], names=names)


def document_fingerprints(docs: DataFrame, blocks: int | None = None) -> DataFrame:
    """Fingerprints of every text and of its edited text.

    Documents are dealt by doc_id range into ``blocks``; the first document of
    a block also goes to the block before it as a guest, so that every row
    meets the next one and the texts are shuffled once.
    """
    spark = docs.sparkSession
    blocks = blocks or 3 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))
    keyed = docs.select("doc_id", "text", key.alias("k"))
    cuts = sorted(set(keyed.approxQuantile("k", [i / blocks for i in range(1, blocks)], 0.2 / blocks))) if blocks > 1 else []
    above = F.size(F.filter(F.array(*[F.lit(int(c)) for c in cuts]).cast("array<long>"), lambda c: c > F.col("k"))) if cuts else F.lit(0)
    keyed = keyed.withColumn("block", above)
    tops = keyed.groupBy("block").agg(F.max("k").alias("top")).orderBy("block").collect()  # at most `blocks` rows
    if not tops:
        tops = [(0, None)]
    guests = [(top, tops[i - 1][0]) for i, (_, top) in enumerate(tops)]  # the first block's first row follows the last block
    guests = F.broadcast(spark.createDataFrame(guests, "k long, guest_of int"))
    dealt = keyed.join(guests, "k", "left").select(
        "doc_id", "text", "k", F.explode(F.array_compact(F.array(F.struct("block", F.lit(False).alias("guest")), F.when(F.col("guest_of").isNotNull(), F.struct(F.col("guest_of").alias("block"), F.lit(True).alias("guest")))))).alias("to")
    )
    dealt = dealt.select(F.col("to.block").alias("block"), F.col("to.guest").alias("guest"), "doc_id", "text", "k")
    sorted_rows = dealt.repartition(F.col("block")).sortWithinPartitions("block", "guest", F.desc("k"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return sorted_rows.drop("k").mapInArrow(neighbour_rows, f"doc_id {kind}, {SCHEMA}")
