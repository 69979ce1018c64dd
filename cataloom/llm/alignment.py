"""Cross-tokenizer alignment: which tokens of two vocabularies overlap, and how
often over the corpus.

Both tokenizers cover the same bytes, so all token ends of a text cut it into
segments that lie in one token of each side: the segments are the *links*.
Places where both sides end a token cut the text into *groups*.

An id pair's count is the number of documents that hold it linked.  It is
counted by external spill counting.  Documents are cut into blocks of bounded
text; a block sorts its (pair, document) records side-major, all pairs of one A
id together, and spills its distinct pairs with their document counts as zstd
runs, one for each radix partition of the A ids.  A partition's runs are merged
``FAN`` at a time by a heap over their frames, which come up in key order.  As
all pairs of an A id pass together, their maximum is known when the id ends.
The merged table then streams past the runs again, and each run goes home to
its block with counts and maxima, where records add up per document.

Runs travel as Spark rows: the shuffle keeps them on disk and a lost executor's
runs are made again.  With more than ``FAN`` blocks the runs of a partition are
dealt over several tasks by block, merged there, and merged once more.  The
table of a partition is bounded by the vocabularies, whatever the corpus.

Cases: null and empty texts, and texts whose tokens do not spell `` `` + text
(U+2581 in the text, for one), have no tokens: all counts are 0 and the digest
is the empty string; repeated rows and repeated or null doc_ids are documents
of their own; a text is tokenized whole, so a task needs memory for the longest
text; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .backoff import squeezed, unsqueezed
from .common import checkpoint

#: Production parameters.
BLOCK_BYTES, DOC_BYTES = 4 << 20, 256  # a document counts as its bytes and DOC_BYTES more
RADIX, FAN, FRAME = 64, 256, 1 << 12


class Side:
    """A tokenizer with the bytes and the decimal text of each id."""

    def __init__(self, encode, tokens: list[bytes]):
        self.encode, self.tokens = encode, tokens
        self.sizes = np.array([len(t) for t in tokens], dtype=np.int64)

    def spelled(self, text: str) -> tuple[np.ndarray, bytes]:
        ids = self.encode(text)
        return np.array(ids, dtype=np.int64), b"".join(map(self.tokens.__getitem__, ids))


def byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves, the others
    in order as the characters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def load_sides(path_a: str, path_b: str) -> tuple[Side, Side]:
    """A: a byte-level vocabulary (``.json``), encoded by tiktoken when the
    same vocabulary's rank file lies beside it (the same ids); B: a
    sentencepiece model, which puts the leading space itself."""
    import json
    import os

    import sentencepiece

    with open(path_a, encoding="utf-8") as lines:
        vocab = json.load(lines)["model"]["vocab"]
    tokens = [b""] * (1 + max(vocab.values()))
    byte_of = byte_of_char()
    for name, i in vocab.items():
        if all(c in byte_of for c in name):
            tokens[i] = bytes(map(byte_of.__getitem__, name))
    ranks = path_a.removesuffix(".json") + ".tiktoken"
    if os.path.exists(ranks):
        import public_tokenizers
        import tiktoken

        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        encode_a = tiktoken.Encoding(path_a, pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={}).encode_ordinary
    else:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path_a)
        tokenizer.encode_special_tokens = True
        encode_a = lambda text: tokenizer.encode(text, add_special_tokens=False).ids
    model = sentencepiece.SentencePieceProcessor(model_file=path_b)
    names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    pieces = [bytes([int(n[3:5], 16)]) if model.is_byte(i) else n.replace("▁", " ").encode() for i, n in enumerate(names)]
    return Side(lambda text: encode_a(" " + text), tokens), Side(lambda text: model.encode(text), pieces)


class Aligned:
    """Tokens, segments and groups of some texts laid end to end."""

    def __init__(self, a: Side, b: Side, texts: list[str | None]):
        empty = np.zeros(0, dtype=np.int64)
        self.ids, size = ([], []), []
        for text in texts:
            ids = (empty, empty)
            if text:
                raw = b" " + text.encode()
                (ids_a, bytes_a), (ids_b, bytes_b) = a.spelled(text), b.spelled(text)
                if bytes_a == raw and bytes_b == raw:
                    ids = (ids_a, ids_b)
            size.append(int(a.sizes[ids[0]].sum()))
            for kept, some in zip(self.ids, ids):
                kept.append(some)
        self.counts = [np.array([len(x) for x in kept], dtype=np.int64) for kept in self.ids]
        self.ids = [np.concatenate([empty, *kept]) for kept in self.ids]
        total = sum(size)
        mark = np.zeros(total + 1, dtype=np.uint8)
        for bit, side, ids in ((1, a, self.ids[0]), (2, b, self.ids[1])):
            mark[np.cumsum(side.sizes[ids])] |= bit
        mark[0] = 0
        self.ends = np.flatnonzero(mark)
        mark = mark[self.ends]
        #: place among the A and B tokens of the token that holds each segment
        self.at = [np.cumsum(mark & bit > 0) - (mark & bit > 0) for bit in (1, 2)]
        self.group_end = mark == 3
        bounds = np.cumsum([0, *size])
        self.doc = np.searchsorted(bounds[1:], self.ends, side="left")
        self.n_docs = len(texts)

    def per_doc(self, where: np.ndarray | None = None) -> np.ndarray:
        return np.bincount(self.doc if where is None else self.doc[where], minlength=self.n_docs)

    def digests(self) -> list[str]:
        """Hex digest of each document's groups, as ``a1,a2|b1;a3|b2,b3``."""
        n_a, n_b = len(self.ids[0]), len(self.ids[1])
        before = np.cumsum(self.group_end) - self.group_end  # group of each segment
        group = [np.zeros(n, dtype=np.int64) for n in (n_a, n_b)]
        for g, at in zip(group, self.at):
            g[at] = before
        sizes = [np.bincount(g, minlength=int(before[-1]) + 1 if len(before) else 0) for g in group]
        cum = [np.cumsum(s) for s in sizes]
        place_a = np.arange(n_a) + (cum[1] - sizes[1])[group[0]]
        place_b = np.arange(n_b) + cum[0][group[1]]
        # what follows an id: a comma, or after the last of a side in its group a bar (A) or semicolon (B)
        last = [np.r_[g[1:] != g[:-1], True] if len(g) else np.zeros(0, dtype=bool) for g in group]
        code = np.zeros(n_a + n_b, dtype=np.int64)
        code[place_a] = self.ids[0] * 3 + last[0]
        code[place_b] = self.ids[1] * 3 + 2 * last[1]
        ends = np.cumsum(self.counts[0] + self.counts[1]).tolist()
        listed, out, first = code.tolist(), [], 0
        for end in ends:
            out.append(hashlib.sha256(b"".join(map(_NAMES.__getitem__, listed[first:end]))[:-1]).hexdigest() if end > first else "")
            first = end
        return out


class _Names(dict):
    """Text of an id and what follows it, by 3 * id + (0 comma, 1 bar, 2 semicolon)."""

    def __missing__(self, code: int) -> bytes:
        self[code] = b"%d%c" % (code // 3, b",|;"[code % 3])
        return self[code]


_NAMES = _Names()


def side_major(a: np.ndarray, b: np.ndarray, ids_a: int, ids_b: int, radix: int) -> np.ndarray:
    """Sort key of an id pair: radix partition of the A id, A id, B id."""
    width = -(-ids_a // radix)
    return ((a % radix) * width + a // radix) * ids_b + b


def encode_blocks(path_a: str, path_b: str, radix: int, block_bytes: int, kind: pa.DataType):
    """(doc_id, text) batches -> one row per block with its documents and
    records (``part`` -1), and one run per block and radix partition."""

    def block_rows(block: int, ids: list, texts: list, sides: tuple[Side, Side]) -> pa.RecordBatch:
        a, b = sides
        found = Aligned(a, b, texts)
        ids_a, ids_b = len(a.tokens), len(b.tokens)
        pair = side_major(found.ids[0][found.at[0]], found.ids[1][found.at[1]], ids_a, ids_b, radix)
        bits = max(1, int(len(texts) - 1).bit_length())
        records = np.sort(pair.astype(np.uint64) << np.uint64(bits) | found.doc.astype(np.uint64))
        fresh = np.flatnonzero(np.r_[True, records[1:] != records[:-1]]) if len(records) else np.zeros(0, dtype=np.int64)
        times = np.diff(np.r_[fresh, len(records)])
        records = records[fresh]
        doc, key = records & np.uint64((1 << bits) - 1), records >> np.uint64(bits)
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else fresh
        keys, docs = key[first], np.diff(np.r_[first, len(key)])
        part = (keys // np.uint64(-(-ids_a // radix) * ids_b)).astype(np.int64)
        cut = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(part) else fresh
        ends = np.r_[cut[1:], len(keys)]
        numbers = [found.counts[0], found.counts[1], found.per_doc(found.group_end), found.per_doc()]
        n_runs = len(cut)
        columns = {
            "block": pa.array([block] * (1 + n_runs), pa.int64()),
            "part": pa.array([-1, *part[cut].tolist()], pa.int32()),
            "n": pa.array([len(records), *(ends - cut).tolist()], pa.int64()),
            "keys": pa.array([squeezed(docs), *(squeezed(np.diff(keys[x:y], prepend=np.uint64(0))) for x, y in zip(cut, ends))], pa.binary()),
            "counts": pa.array([squeezed(doc), *(squeezed(docs[x:y]) for x, y in zip(cut, ends))], pa.binary()),
            "times": pa.array([squeezed(times)] + [None] * n_runs, pa.binary()),
            "n_pairs": pa.array([len(keys)] + [None] * n_runs, pa.int64()),
            "ids": pa.array([ids] + [None] * n_runs, pa.list_(kind)),
            "numbers": pa.array([np.concatenate(numbers).astype(np.int64)] + [None] * n_runs, pa.list_(pa.int64())),
            "digests": pa.array([found.digests()] + [None] * n_runs, pa.list_(pa.string())),
        }
        return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        sides = load_sides(path_a, path_b)
        block, ids, texts, size = TaskContext.get().partitionId() << 33, [], [], 0
        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                cost = DOC_BYTES + len((text or "").encode())
                if texts and size + cost > block_bytes:
                    yield block_rows(block, ids, texts, sides)
                    block, ids, texts, size = block + 1, [], [], 0
                ids.append(i)
                texts.append(text)
                size += cost
        if texts:
            yield block_rows(block, ids, texts, sides)

    return run


class Run:
    """Cursor over a sorted run, one frame at a time."""

    def __init__(self, keys: bytes, counts: bytes, n: int, frame: int):
        self.keys, self.counts = np.cumsum(unsqueezed(keys, n)), unsqueezed(counts, n)
        self.at, self.frame = 0, frame

    def last(self) -> int:
        """Keys up to here are in sight: the last of the frame, in the last frame any."""
        end = self.at + self.frame
        return int(self.keys[end - 1]) if end < len(self.keys) else (1 << 64) - 1

    def upto(self, key: int) -> tuple[np.ndarray, np.ndarray]:
        end = self.at + int(np.searchsorted(self.keys[self.at : self.at + self.frame], np.uint64(key), side="right"))
        out = self.keys[self.at : end], self.counts[self.at : end]
        self.at = end
        return out


def merge(runs: list[Run]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """K-way merge: a heap holds each run by the last key of its frame; all
    keys up to the heap's least one are complete and leave together."""
    heap = [(r.last(), i) for i, r in enumerate(runs) if len(r.keys)]
    heapq.heapify(heap)
    while heap:
        top = heap[0][0]
        parts = [runs[i].upto(top) for _, i in heap]
        keys, place = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
        yield keys, np.bincount(place, np.concatenate([c for _, c in parts])).astype(np.uint64)
        while heap and heap[0][0] <= top:
            _, i = heapq.heappop(heap)
            if runs[i].at < len(runs[i].keys):
                heapq.heappush(heap, (runs[i].last(), i))


def framed(merged: Iterator[tuple[np.ndarray, np.ndarray]], frame: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The same keys and counts in pieces of at least ``frame`` keys."""
    held, size = [], 0
    for part in merged:
        held.append(part)
        size += len(part[0])
        if size >= frame:
            yield tuple(np.concatenate(c) for c in zip(*held))
            held, size = [], 0
    if held:
        yield tuple(np.concatenate(c) for c in zip(*held))


def with_best(merged: Iterator[tuple[np.ndarray, np.ndarray]], ids_b: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Adds whether a pair's count is the highest of its A id.  Keys come side-
    major, so only the last A id of a frame has to wait for the next one."""
    keys, counts = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.uint64)

    def judged(keys, counts):
        side = keys // np.uint64(ids_b)
        first = np.flatnonzero(np.r_[True, side[1:] != side[:-1]])
        highest = np.maximum.reduceat(counts, first)
        return keys, counts, counts == np.repeat(highest, np.diff(np.r_[first, len(keys)]))

    for more_keys, more_counts in merged:
        keys, counts = np.r_[keys, more_keys], np.r_[counts, more_counts]
        cut = int(np.searchsorted(keys, keys[-1] // np.uint64(ids_b) * np.uint64(ids_b)))
        if cut:
            yield judged(keys[:cut], counts[:cut])
            keys, counts = keys[cut:], counts[cut:]
    if len(keys):
        yield judged(keys, counts)


TABLE = "part int, salt long, seq long, n long, keys binary, counts binary, best binary"


def merge_partitions(ids_b: int, final: bool, fan: int = FAN, frame: int = FRAME):
    """Runs sorted by (part, salt) -> the merged table of each, in rows of one
    frame or more; the final merge also tells the highest pairs."""

    def tables(part: int, salt: int, held: list[Run]) -> Iterator[pa.RecordBatch]:
        merged = framed(merge(held), 16 * frame)
        whole = with_best(merged, ids_b) if final else ((k, c, np.zeros(len(k), dtype=bool)) for k, c in merged)
        for seq, (keys, counts, best) in enumerate(whole):
            row = (part, salt, seq, len(keys), squeezed(np.diff(keys, prepend=np.uint64(0))), squeezed(counts), squeezed(best))
            types = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names=["part", "salt", "seq", "n", "keys", "counts", "best"])

    def folded(held: list[Run]) -> Run:
        out, parts = Run.__new__(Run), list(merge(held))
        out.keys, out.counts = (np.concatenate(c) for c in zip(*parts))
        out.at, out.frame = 0, frame
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for part, salt, n, keys, counts in zip(*(batch.column(c).to_pylist() for c in ("part", "salt", "n", "keys", "counts"))):
                if now != (part, salt):
                    if held:
                        yield from tables(*now, held)
                    now, held = (part, salt), []
                held.append(Run(keys, counts, n, frame))
                if len(held) >= fan:
                    held = [folded(held)]
        if held:
            yield from tables(*now, held)

    return run


def send_home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (part, salt), its table first and then its runs -> each run's
    counts and highest flags, for its block."""
    now, table, whole = None, [], None
    for batch in batches:
        rows = []
        for part, salt, block, n, keys, counts, best in zip(*(batch.column(c).to_pylist() for c in ("part", "salt", "block", "n", "keys", "counts", "best"))):
            if now != (part, salt):
                now, table, whole = (part, salt), [], None
            own = np.cumsum(unsqueezed(keys, n))
            if best is not None:
                table.append((own, unsqueezed(counts, n), unsqueezed(best, n)))
                continue
            if whole is None:
                whole = [np.concatenate(c) for c in zip(*table)]
            at = np.searchsorted(whole[0], own)
            rows.append((block, part, n, squeezed(whole[1][at]), squeezed(whole[2][at])))
        if rows:
            types = (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["block", "part", "n", "counts", "best"])


def settle_block(block: pa.Table, home: pa.Table) -> pa.Table:
    """A block's records with the counts that came home -> its documents."""
    one = {c: block.column(c)[0] for c in block.column_names}
    ids = one["ids"].values
    n_a, n_b, groups, links = np.array(one["numbers"].as_py(), dtype=np.int64).reshape(4, -1)
    rows = sorted(zip(*(home.column(c).to_pylist() for c in ("part", "n", "counts", "best")))) if home.num_rows else []
    counts, best = (np.concatenate([np.zeros(0, dtype=np.uint64), *(unsqueezed(r[i], r[1]) for r in rows)]) for i in (2, 3))
    n, n_pairs = one["n"].as_py(), one["n_pairs"].as_py()
    docs = unsqueezed(one["keys"].as_py(), n_pairs).astype(np.int64)
    doc, times = (unsqueezed(one[c].as_py(), n).astype(np.int64) for c in ("counts", "times"))
    counts, best = (np.repeat(x.astype(np.int64), docs) for x in (counts, best))
    sums = np.zeros((2, len(n_a)), dtype=np.int64)
    np.add.at(sums[0], doc, times * best)
    np.add.at(sums[1], doc, times * counts)
    columns = {"doc_id": ids, "n_a": n_a, "n_b": n_b, "n_groups": groups, "n_links": links, "n_best": sums[0], "count_sum": sums[1], "groups_sha256": one["digests"].values}
    return pa.table({name: v if isinstance(v, pa.Array) else pa.array(v, pa.int64()) for name, v in columns.items()})


def align_tokenizers(docs: DataFrame, path_a: str, path_b: str, block_bytes: int = BLOCK_BYTES, radix: int = RADIX, fan: int = FAN, frame: int = FRAME) -> DataFrame:
    """Per document: n_a, n_b, n_groups, n_links, n_best, count_sum and
    groups_sha256."""
    runs, blocks = spilled_runs(docs, path_a, path_b, block_bytes, radix, fan)
    table = pair_table(runs, path_b, fan, frame)
    salts = runs.select("part", "salt").distinct()
    sent = table.drop("salt").join(salts, "part").select("part", "salt", F.lit(None).cast("long").alias("block"), "seq", "n", "keys", "counts", "best")
    mine = runs.select("part", "salt", "block", F.lit(None).cast("long").alias("seq"), "n", "keys", "counts", F.lit(None).cast("binary").alias("best"))
    both = sent.unionByName(mine).repartition("part", "salt").sortWithinPartitions("part", "salt", F.col("seq").asc_nulls_last())
    home = both.mapInArrow(send_home, "block long, part int, n long, counts binary, best binary")
    kind = docs.schema["doc_id"].dataType.simpleString()
    out = f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return blocks.groupBy("block").cogroup(home.groupBy("block")).applyInArrow(settle_block, out)


def spilled_runs(docs: DataFrame, path_a: str, path_b: str, block_bytes: int = BLOCK_BYTES, radix: int = RADIX, fan: int = FAN) -> tuple[DataFrame, DataFrame]:
    """The runs (block, part, salt, n, keys, counts) and the blocks they are of."""
    from pyspark.sql.pandas.types import to_arrow_type

    kind = docs.schema["doc_id"].dataType
    schema = f"block long, part int, n long, keys binary, counts binary, times binary, n_pairs long, ids array<{kind.simpleString()}>, numbers array<long>, digests array<string>"
    rows = checkpoint(docs.select("doc_id", "text").mapInArrow(encode_blocks(path_a, path_b, radix, block_bytes, to_arrow_type(kind)), schema))
    blocks = rows.where("part = -1")
    salts = 1 + blocks.count() // fan
    runs = rows.where("part >= 0").select("block", "part", F.pmod(F.xxhash64("block"), F.lit(salts)).alias("salt"), "n", "keys", "counts")
    return runs, blocks.drop("part")


def pair_table(runs: DataFrame, path_b: str, fan: int = FAN, frame: int = FRAME) -> DataFrame:
    """The merged count table (part, seq, n, keys, counts, best) in zstd rows."""
    import sentencepiece

    ids_b = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    some = runs.select("part", "salt", "n", "keys", "counts").repartition("part", "salt").sortWithinPartitions("part", "salt")
    some = some.mapInArrow(merge_partitions(ids_b, False, fan, frame), TABLE)
    some = some.select("part", F.lit(0).cast("long").alias("salt"), "n", "keys", "counts").repartition("part").sortWithinPartitions("part")
    return checkpoint(some.mapInArrow(merge_partitions(ids_b, True, fan, frame), TABLE))
