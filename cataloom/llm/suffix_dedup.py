"""Suffix-array dedup: repeated passages across and inside documents.

A byte goes when a ``LENGTH``-byte string that covers it also starts earlier
(smaller doc_id, or earlier in the document).

1. Anchors.  In every window of ``LENGTH`` bytes the least hash of its
   ``GRAM``-byte spans is an anchor, so equal windows have an anchor at the
   same place.  An anchor's piece is all bytes that windows around it reach.
2. Anchors meet by hash, sorted, and stream through a task.  Of equal pieces
   all but the first are repeats in every window and need no bytes.  This is
   done in each slab of texts first, so a frequent anchor (a periodic text, a
   common passage) sends one row per slab, and the spans of the others ride
   along, spread over the slab's rows.  An anchor that occurs once is dropped.  The first of each of several different pieces
   goes on.
3. Those pieces are built into a collection column by column: each round
   inserts one symbol of every piece, sorts the collection's order by it (that
   column of the collection's Burrows-Wheeler transform, pieces being aligned
   at their anchors) and updates the lengths common with the neighbour above.
   Neighbours that share ``LENGTH`` symbols form a class; all but its earliest
   piece repeat that window.  Rounds are the piece length, not the longest
   document; a task holds one run of collections at a time.  Collections of
   over ``NODE_ROWS`` pieces are first dealt by the hash of each window.
4. The spans found are joined to the documents, and the bytes cut.

A row's bytes are found by (doc, sub).  Rows without a doc_id are numbered, each
is a document of its own after all others.  Rows that share a doc_id are one
document to the rule: of equal strings at different starts the earlier stays,
at one start none is earlier; ``sub``, their text's hash, only tells which row's
bytes are meant.

Cases: a null or empty text has nothing to remove; rows equal in doc_id and
text count as one document that does not repeat itself, and its spans apply to
each of them; an empty table gives no rows; extra columns stay in ``remove_repeats`` and are not read otherwise.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cataloom.session import shared_path

from .common import Rolling, checkpoint, mix, slabs

LENGTH, GRAM, NODE_ROWS = 100, 32, 4096
NO_ID = (1 << 63) - 1
PAD = 256


def stored(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder as Parquet and read again."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (np.minimum or np.maximum) over each run of ``width`` values."""
    have = 1
    while 2 * have <= width:
        x = pick(x[:-have], x[have:])
        have *= 2
    return pick(x[: len(x) - (width - have)], x[width - have :]) if width > have else x


def turn(sub: np.ndarray) -> np.ndarray:
    """What orders the rows of a ``doc`` before their places: the number of a row
    without a doc_id; nothing where texts share one (``sub`` is negative there)."""
    return np.maximum(sub, 0)


def folded(h: np.ndarray, piece: np.ndarray, doc: np.ndarray, sub: np.ndarray, pos: np.ndarray, length: int, gram: int) -> pa.RecordBatch:
    """One row (h, piece, doc, sub, pos, more) per piece of a slab, its earliest
    (and each other text of that doc_id that has it at the same place);
    ``more`` packs some of the spans (doc, sub, start, end) that the others repeat."""
    order = np.lexsort((sub, pos, turn(sub), doc, piece, h))
    h, piece, doc, sub, pos = h[order], piece[order], doc[order], sub[order], pos[order]
    first = np.r_[True, (h[1:] != h[:-1]) | (piece[1:] != piece[:-1])] if len(h) else np.zeros(0, dtype=bool)
    head = np.maximum.accumulate(np.where(first, np.arange(len(h)), 0))
    again = (doc != doc[head]) | (turn(sub) != turn(sub)[head]) | (pos != pos[head])
    first[1:] |= ~again[1:] & (sub[1:] != sub[:-1])
    spans = merged(doc[again], sub[again], pos[again] - (length - gram), pos[again] + length)
    n, m = int(first.sum()), spans.num_rows
    each = m // n + (np.arange(n) < m % n) if n else np.zeros(0, dtype=np.int64)
    values = np.stack([np.asarray(c, dtype=np.int64) for c in spans.columns], axis=1)
    cuts = np.r_[0, np.cumsum(each)]
    more = pa.array([values[a:b].tobytes() if b > a else None for a, b in zip(cuts[:-1], cuts[1:])], type=pa.binary())
    cols = [pa.array(h[first].view(np.int64)), pa.array(piece[first].view(np.int64)), pa.array(doc[first]), pa.array(sub[first]), pa.array(pos[first].astype(np.int32))]
    return pa.RecordBatch.from_arrays([*cols, more], names=["h", "piece", "doc", "sub", "pos", "more"])


def anchor_rows(length: int, gram: int):
    spans = length - gram + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (docs, subs), _, data, offsets in slabs(batches):
            sizes = np.diff(offsets)
            if len(data) < length:
                continue
            hashes = Rolling(data)
            grams = hashes.grams(gram)
            least = sliding(grams, spans, np.minimum)
            rest = np.repeat(offsets[1:], sizes)[: len(least)] - np.arange(len(least))
            least[rest < length] = 0  # windows that leave their document
            covering = np.zeros(len(grams) + spans - 1, dtype=np.uint64)
            covering[spans - 1 : spans - 1 + len(least)] = least
            at = np.flatnonzero(sliding(covering, spans, np.maximum) == grams)
            doc = np.searchsorted(offsets, at, side="right") - 1
            pos = at - offsets[doc]
            left = np.minimum(spans - 1, pos)
            right = np.minimum(spans - 1, sizes[doc] - pos - gram)
            piece = mix(hashes.spans(at - left, at + gram + right) ^ (left.astype(np.uint64) << np.uint64(8)) ^ right.astype(np.uint64))
            yield folded(grams[at], piece, *(np.array(c, dtype=np.int64)[doc] for c in (docs, subs)), pos, length, gram)

    return run


def repeated_rows(length: int, gram: int):
    """(h, piece, doc, sub, pos, more) sorted -> (null, doc, sub, start, end) of repeats
    and (h, doc, sub, pos, null) of the first of each piece whose anchor has several;
    holds a few rows."""

    def out(h, doc, sub, start, end):
        h, end = (pa.nulls(len(doc), t) if x is None else pa.array(x, type=t) for x, t in ((h, pa.int64()), (end, pa.int32())))
        return pa.RecordBatch.from_arrays([h, pa.array(doc), pa.array(sub), pa.array(start, type=pa.int32()), end], names=["h", "doc", "sub", "pos", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held, open_row = None, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            h, piece, doc, sub, pos = (batch.column(i).to_numpy() for i in range(5))
            before = [np.r_[c[:1] if last is None else last[i], c[:-1]] for i, c in enumerate((h, piece, doc, sub, pos))]
            same = h == before[0]
            if last is None:
                same[0] = False
            equal = same & (piece == before[1])
            # each row beside the first of its piece, which may be in a batch before
            head = np.maximum.accumulate(np.where(equal, 0, np.arange(1, len(h) + 1)))
            places = [np.r_[c[:1] if held is None else held[i], c] for i, c in enumerate((doc, turn(sub), pos))]
            again = np.any([c[1:] != c[head] for c in places], axis=0)
            held = [c[head[-1:]] for c in places]
            last = [c[-1:] for c in (h, piece, doc, sub, pos)]
            yield out(None, doc[again], sub[again], pos[again] - (length - gram), pos[again] + length)
            more = np.frombuffer(b"".join(batch.column(5).drop_null().to_pylist()), dtype=np.int64).reshape(-1, 4)
            yield out(None, *more.T)
            first = np.flatnonzero(~equal | ~again & (sub != before[3]))
            if len(first):
                cols = [h[first], doc[first], sub[first], pos[first], same[first]]
                if open_row is not None:
                    cols = [np.r_[o, c] for o, c in zip(open_row, cols)]
                wanted = cols[4][:-1] | (cols[0][1:] == cols[0][:-1])
                yield out(*(c[:-1][wanted] for c in cols[:4]), None)
                open_row = [c[-1:] for c in cols]
        if open_row is not None and open_row[4][0]:
            yield out(*open_row[:4], None)

    return run


def piece_rows(length: int, gram: int):
    reach = length - gram

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            for doc, sub, marks, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
                data = (text or "").encode()
                for mark in marks:
                    pos = mark["pos"]
                    start = max(0, pos - reach)
                    for col, value in zip(out, (mark["h"], doc, sub, pos, pos - start, data[start : pos + gram + reach])):
                        col.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(out, kinds)], names=["h", "doc", "sub", "pos", "before", "bytes"])

    return run


def column_wise(symbols: np.ndarray, group: np.ndarray, length: int):
    """Rounds over the columns of aligned pieces, sorted by group at the start:
    yields (first column, order, class starts) for every window end."""
    n, columns = symbols.shape
    order = np.arange(n)
    split = np.zeros(n, dtype=np.int64)  # column from which a piece agrees with the one above
    split[np.r_[True, group[1:] != group[:-1]]] = columns + 1
    for j in range(columns):
        symbol = symbols[order, j].astype(np.int64)
        key = group[order] * (PAD + 1) + symbol
        perm = np.argsort(key, kind="stable")
        key = key[perm]
        gap = np.diff(perm)
        same = key[1:] == key[:-1]
        new = np.full(n, j + 1, dtype=np.int64)
        new[0] = columns + 1
        new[1:][group[order[perm[1:]]] != group[order[perm[:-1]]]] = columns + 1
        # the least agreement on the way from one piece to the next in the old order
        level, table = 0, split
        where = np.flatnonzero(same)
        low, width = perm[:-1][where] + 1, gap[where]
        best = np.zeros(len(where), dtype=np.int64)
        while len(where):
            here = width.astype(np.int64) >> level == 1
            best[here] = np.maximum(table[low[here]], table[low[here] + width[here] - (1 << level)])
            if not (width >> (level + 1)).any():
                break
            table = np.maximum(table[: len(table) - (1 << level)], table[1 << level :])
            level += 1
        new[1:][where] = best
        order, split = order[perm], new
        if j >= length - 1:
            yield j - length + 1, order, np.flatnonzero(split > j - length + 1)


def merged(doc: np.ndarray, sub: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
    """Spans sorted and joined where they touch."""
    order = np.lexsort((start, sub, doc))
    doc, sub, start, end = doc[order], sub[order], start[order], end[order]
    new = np.r_[True, (doc[1:] != doc[:-1]) | (sub[1:] != sub[:-1]) | (start[1:] > end[:-1])] if len(doc) else np.zeros(0, dtype=bool)
    first = np.flatnonzero(new)
    ends = np.maximum.reduceat(end, first) if len(first) else end
    return pa.RecordBatch.from_arrays([pa.array(doc[first]), pa.array(sub[first]), pa.array(start[first].astype(np.int32)), pa.array(ends.astype(np.int32))], names=["doc", "sub", "start", "end"])


def collection_rows(length: int, gram: int, size: int = 16_384):
    """Pieces sorted by h and place -> repeated spans (doc, sub, start, end)."""
    reach = length - gram
    columns = gram + 2 * reach

    def solved(rows: list[tuple]) -> pa.RecordBatch:
        n = len(rows)
        symbols = np.full((n, columns), PAD, dtype=np.int16)
        for i, (*_, before, data) in enumerate(rows):
            symbols[i, reach - before : reach - before + len(data)] = np.frombuffer(data, dtype=np.uint8)
        h, doc, sub, pos = (np.array([r[k] for r in rows], dtype=np.int64) for k in range(4))
        group = np.cumsum(np.r_[0, h[1:] != h[:-1]])
        places = (h, doc, turn(sub), pos)
        key = np.cumsum(np.r_[0, np.any([c[1:] != c[:-1] for c in places], axis=0)])
        before, after = (np.array(x) for x in zip(*((r[4], len(r[5]) - r[4] - gram) for r in rows)))
        found: list[list[np.ndarray]] = [[], [], [], []]
        for column, order, starts in column_wise(symbols, group, length):
            counts = np.diff(np.r_[starts, n])
            earliest = np.repeat(np.minimum.reduceat(key[order], starts), counts)
            offset = reach - column  # of the anchor in the window
            hit = order[(key[order] > earliest) & (before[order] >= offset) & (after[order] >= reach - offset)]
            for col, value in zip(found, (doc[hit], sub[hit], pos[hit] - offset, pos[hit] - offset + length)):
                col.append(value)
        return merged(*(np.concatenate(c) for c in found))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            held += zip(*(batch.column(i).to_pylist() for i in range(6)))
            while len(held) > size:
                to = size
                while to > 0 and held[to][0] == held[to - 1][0]:
                    to -= 1
                if not to:
                    to = next((i for i in range(size, len(held)) if held[i][0] != held[i - 1][0]), 0)
                if not to:
                    break
                yield solved(held[:to])
                held = held[to:]
        if held:
            yield solved(held)

    return run


def window_rows(length: int, gram: int):
    """Pieces of a large collection -> (window hash, doc, sub, start) of every window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list[np.ndarray]] = [[], [], [], [], []]
            for h, doc, sub, pos, before, data in zip(*(batch.column(i).to_pylist() for i in range(6))):
                buffer = np.frombuffer(data, dtype=np.uint8)
                grams = Rolling(buffer).grams(length)
                other = Rolling(buffer[::-1]).grams(length)[::-1]
                for col, value in zip(out, (grams.view(np.int64), other.view(np.int64), np.full(len(grams), doc), np.full(len(grams), sub), pos - before + np.arange(len(grams)))):
                    col.append(value)
            if out[0]:
                a, b, doc, sub, start = (np.concatenate(c) for c in out)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(np.ascontiguousarray(b)), pa.array(doc), pa.array(sub), pa.array(start.astype(np.int32))], names=["a", "b", "doc", "sub", "start"])

    return run


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_doc`` and ``_sub``, which name each row's text.  ``_sub`` is 0
    while no doc_id is shared, so that it adds nothing to what is shuffled; rows
    without a doc_id are numbered in a checkpoint."""
    key = F.col("doc_id").cast("long")
    having = docs.where(key.isNotNull()).withColumn("_doc", key)
    shared = having.groupBy("_doc").count().where("count > 1").take(1)
    of_text = F.xxhash64("text").bitwiseOR(F.lit(-(1 << 63)))  # under 0: orders nothing
    having = having.withColumn("_sub", of_text if shared else F.lit(0).cast("long"))
    without = docs.where(key.isNull()).withColumn("_doc", F.lit(NO_ID).cast("long"))
    return having.union(checkpoint(without.withColumn("_sub", F.monotonically_increasing_id() + 1)))


def repeated_spans(keyed: DataFrame, length: int = LENGTH, gram: int = GRAM, node_rows: int = NODE_ROWS) -> DataFrame:
    """(doc, sub, spans): the byte spans of each document (doc, sub, text) that start
    earlier too; spans may overlap and reach past either end of the text."""
    anchors = keyed.mapInArrow(anchor_rows(length, gram), "h long, piece long, doc long, sub long, pos int, more binary")
    order = F.greatest("sub", F.lit(0))  # as ``turn``
    met = anchors.repartition("h").sortWithinPartitions("h", "piece", "doc", order, "pos", "sub")
    marks = stored(met.mapInArrow(repeated_rows(length, gram), "h long, doc long, sub long, pos int, end int"), "anchors")
    whole = marks.where("h is null").select("doc", "sub", F.col("pos").alias("start"), "end")

    firsts = marks.where("h is not null").select("h", "doc", "sub", "pos")
    listed = firsts.groupBy("doc", "sub").agg(F.collect_list(F.struct("h", "pos")).alias("marks"))
    pieces = listed.join(keyed, ["doc", "sub"]).select("doc", "sub", "marks", "text")
    pieces = pieces.mapInArrow(piece_rows(length, gram), "h long, doc long, sub long, pos int, before int, bytes binary")
    large = checkpoint(firsts.groupBy("h").count().where(F.col("count") > node_rows).select("h"))
    spans = []
    if large.take(1):
        pieces = stored(pieces, "pieces")
        windows = pieces.join(large, "h", "left_semi").mapInArrow(window_rows(length, gram), "a long, b long, doc long, sub long, start int").distinct()
        earliest = windows.groupBy("a", "b").agg(F.min(F.struct("doc", order.alias("turn"), "start")).alias("least"), F.count("*").alias("n")).where("n > 1")
        later = windows.join(earliest, ["a", "b"]).where((F.col("doc") != F.col("least.doc")) | (order != F.col("least.turn")) | (F.col("start") != F.col("least.start")))
        spans.append(later.select("doc", "sub", "start", (F.col("start") + length).alias("end")))
        pieces = pieces.join(large, "h", "left_anti")
    dealt = pieces.repartition("h").sortWithinPartitions("h", "doc", order, "pos")
    spans.append(dealt.mapInArrow(collection_rows(length, gram), "doc long, sub long, start int, end int"))
    for part in spans:
        whole = whole.union(part)
    return whole.groupBy("doc", "sub").agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def cut(text: str | None, spans: list[dict] | None) -> tuple[int, int, int, bytes]:
    """(bytes, bytes removed, runs removed, bytes kept) of one document."""
    data = (text or "").encode()
    if spans is None or not len(spans):
        return len(data), 0, 0, data
    edge = np.zeros(len(data) + 1, dtype=np.int64)
    for side, step in (("start", 1), ("end", -1)):
        np.add.at(edge, np.clip([s[side] for s in spans], 0, len(data)), step)
    gone = np.cumsum(edge[:-1]) > 0
    runs = int((gone & ~np.r_[False, gone[:-1]]).sum())
    return len(data), int(gone.sum()), runs, np.frombuffer(data, dtype=np.uint8)[~gone].tobytes()


def _with_spans(docs: DataFrame, params: dict) -> DataFrame:
    docs = numbered(docs)
    spans = repeated_spans(docs.select(F.col("_doc").alias("doc"), F.col("_sub").alias("sub"), "text"), **params)
    return docs.join(spans.withColumnsRenamed({"doc": "_doc", "sub": "_sub", "spans": "_spans"}), ["_doc", "_sub"], "left").drop("_doc", "_sub")


def repeated_passages(docs: DataFrame, **params) -> DataFrame:
    """Per document: n_bytes, n_removed, n_spans, kept_sha256."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [cut(t, s) for t, s in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            cols = [pa.array([r[i] for r in rows], type=pa.int64()) for i in range(3)]
            shas = pa.array([hashlib.sha256(r[3]).hexdigest() for r in rows], type=pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols, shas], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = _with_spans(docs.select("doc_id", "text"), params).select("doc_id", "text", "_spans")
    return rows.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(docs: DataFrame, **params) -> DataFrame:
    """The documents with the repeated bytes cut from their text; a character
    that loses some of its bytes goes, ``n_chars`` (if there) is counted anew,
    a null text stays null."""

    def kept(texts, spans):
        import pandas as pd

        return pd.Series([None if t is None else cut(t, s)[3].decode(errors="ignore") for t, s in zip(texts, spans)])

    shortened = F.pandas_udf(kept, "string")
    rows = _with_spans(docs, params).withColumn("text", F.when(F.col("_spans").isNull(), F.col("text")).otherwise(shortened("text", "_spans")))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.when(F.col("_spans").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))
    return rows.select(*docs.columns)
