"""Best-fit packing: best-fit decreasing over document pieces.

Tokenising runs in tasks.  The packing itself depends only on how many pieces
there are of each length, at most ``capacity`` numbers: best-fit decreasing
runs over those counts, all equal pieces that go to bins of equal room in one
step, and a segment tree over the remaining capacities finds the tightest open
bin in logarithmic time.  Its result is a short list of rank ranges, joined
to the pieces by (length, rank in length); no row passes through the driver.

Cases: a null text is empty and becomes one piece holding the terminator; a
null doc_id is carried as it is; repeated rows are packed once each; equal
lengths are ranked by (doc_id, piece, checksum, row); an empty table gives no
rows; extra columns are not read; documents of any length are cut into
pieces of ``capacity`` tokens, the first piece being the short one.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, checkpoint, gapless


class CapacityTree:
    """Segment tree over room 0..capacity; each leaf holds runs of open bins
    (first bin, number of bins) with that room."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.bins = [0] * (2 * self.size)
        self.runs: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]

    def _add(self, room: int, n: int) -> None:
        i = room + self.size
        while i:
            self.bins[i] += n
            i >>= 1

    def put(self, room: int, first: int, n: int) -> None:
        if n:
            self.runs[room].append((first, n))
            self._add(room, n)

    def take(self, room: int, n: int) -> tuple[int, int]:
        """Up to ``n`` bins of this room with consecutive numbers."""
        first, have = self.runs[room].pop()
        got = min(n, have)
        if have > got:
            self.runs[room].append((first + got, have - got))
        self._add(room, -got)
        return first, got

    def tightest(self, need: int) -> int | None:
        """Smallest room of an open bin that is at least ``need``."""
        i = need + self.size
        if self.bins[i]:
            return need
        while i > 1:
            if not i & 1 and self.bins[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if self.bins[2 * i] else 2 * i + 1
                return i - self.size
            i >>= 1
        return None


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, end rank, first bin, offset) runs: the piece of
    this length and rank r sits in bin ``first bin + r - first rank`` at offset.

    The same bins as placing the pieces one by one, longest first, each in the
    tightest open bin: a bin that has just taken a piece and can take another
    of that length is then the tightest, so it is filled before the next.
    """
    tree, opened, out = CapacityTree(capacity), 0, []
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = tree.tightest(length)
            each = min(left, (capacity if room is None else room) // length)
            want = left // each
            if room is None:
                room, first, n = capacity, opened, want
                opened += n
            else:
                first, n = tree.take(room, want)
            for copy in range(each):
                out.append((length, rank, rank + n, first, capacity - room + copy * length))
                rank += n
            left -= n * each
            tree.put(room - each * length, first, n)
    return out


def load_encoder(path: str):
    """Byte-level encoder of the vocabulary file ``path`` (``.json``): the ids
    of the tokenizers library, computed by tiktoken from the same vocabulary's
    rank file beside it when there is one (the same ids, four times as fast)."""
    import os

    ranks = path.removesuffix(".json") + ".tiktoken"
    if os.path.exists(ranks):
        import public_tokenizers
        import tiktoken

        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        special = {"<|endoftext|>": 50256}
        encoding = tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens=special)
        return lambda text: encoding.encode(text, allowed_special="all")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def piece_rows(path: str, capacity: int, terminator: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = load_encoder(path)
        for batch in batches:
            rows: dict[str, list] = {"doc_id": [], "piece": [], "start": [], "length": [], "ids_crc32": [], **({"ids": []} if with_ids else {})}
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.array([*encode(text or ""), terminator], dtype="<u4")
                end = len(ids) % capacity or capacity
                start, piece = 0, 0
                while start < len(ids):
                    part = ids[start:end]
                    for name, value in zip(rows, (doc, piece, start, len(part), zlib.crc32(part.tobytes()), part)):
                        rows[name].append(value)
                    start, end, piece = end, end + capacity, piece + 1
            types = {"piece": pa.int32(), "ids": pa.list_(pa.int32())}
            arrays = [pa.array(rows["doc_id"], type=batch.schema.field(0).type), *(pa.array(v, type=types.get(k, pa.int64())) for k, v in list(rows.items())[1:])]
            yield pa.RecordBatch.from_arrays(arrays, names=list(rows))

    return run


def document_pieces(docs: DataFrame, tokenizer: str, capacity: int, terminator: int = 0, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) of every piece."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return docs.select("doc_id", "text").mapInArrow(piece_rows(tokenizer, capacity, terminator, with_ids), schema)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048, terminator: int = 0, with_ids: bool = False) -> DataFrame:
    """Every piece with its sequence_id and offset there."""
    pieces = checkpoint(document_pieces(docs, tokenizer, capacity, terminator, with_ids).withColumn("_row", F.monotonically_increasing_id()))
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most `capacity` rows
    runs = best_fit_decreasing(counts, capacity)
    places = docs.sparkSession.createDataFrame(runs or [(0, 0, 0, 0, 0)], "length long, first long, end long, bin long, offset long")
    places = F.broadcast(places) if len(runs) * 48 <= BROADCAST_BYTES else places
    ranked = gapless(pieces, ["length"], ["doc_id", "piece", "ids_crc32", "_row"], "_row", "rank")
    placed = ranked.join(places, "length").where("rank >= first and rank < end")
    return placed.withColumn("sequence_id", F.expr("bin + rank - first")).drop("_row", "rank", "first", "end", "bin")
