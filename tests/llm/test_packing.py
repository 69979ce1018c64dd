import random
import zlib
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from cataloom.llm import packing
from cataloom.llm.queries import op10_best_fit, tokenizer_path


def plain_best_fit(sizes, capacity):
    """Bins opened by best-fit decreasing, one piece at a time."""
    bins = []
    for s in sorted(sizes, reverse=True):
        fits = [i for i, room in enumerate(bins) if room >= s]
        if fits:
            bins[min(fits, key=lambda i: bins[i])] -= s
        else:
            bins.append(capacity - s)
    return sorted(bins)


@given(st.lists(st.integers(1, 40), max_size=120))
@settings(max_examples=60, deadline=None)
def test_counts_give_the_same_bins(sizes):
    counts = {s: sizes.count(s) for s in set(sizes)}
    runs = packing.best_fit_decreasing(counts, 40)
    used, placed = defaultdict(list), defaultdict(int)
    for length, a, b, first, offset in runs:
        placed[length] += b - a
        for k in range(b - a):
            used[first + k].append((offset, length))
    assert placed == counts
    for pieces in used.values():  # gapless from 0
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 40
    assert sorted(40 - sum(x[1] for x in p) for p in used.values()) == plain_best_fit(sizes, 40)


def check(rows, docs, capacity):
    encode = packing.load_encoder(tokenizer_path())
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(tokenizer_path())
    want, bins, by_doc = [], defaultdict(list), defaultdict(list)
    for doc, text in docs:
        ids = [*own.encode(text or "", add_special_tokens=False).ids, 0]
        assert [*encode(text or ""), 0] == ids
        first = len(ids) % capacity or capacity
        for piece, start in enumerate([0, *range(first, len(ids), capacity)]):
            part = ids[start : first if not piece else start + capacity]
            want.append((doc, piece, start, len(part), zlib.crc32(np.array(part, dtype="<u4").tobytes())))
    got = [(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(bins) == len(plain_best_fit([r["length"] for r in rows], capacity))


def test_query_table(spark, sf, documents):
    check(op10_best_fit(spark, sf).collect(), documents, 2048)


def test_edge_cases(make, edge):
    rows = [*edge, (30, "<|endoftext|> x"), (31, "  \n\t  x")]
    check(packing.pack_documents(make(rows), tokenizer_path(), 64).collect(), rows, 64)
    assert packing.pack_documents(make([]), tokenizer_path()).collect() == []


def test_ids_and_exact_capacity(make):
    rows = packing.pack_documents(make([(1, "a b c"), (2, "")]), tokenizer_path(), 4, with_ids=True).collect()
    assert sorted((r["doc_id"], len(r["ids"]), r["length"]) for r in rows) == [(1, 4, 4), (2, 1, 1)]


def test_tightest_room():
    rng = random.Random(1)
    tree, rooms = packing.CapacityTree(50), []
    for i in range(300):
        room = rng.randint(0, 50)
        tree.put(room, i, 1)
        rooms.append(room)
        need = rng.randint(1, 50)
        best = min((r for r in rooms if r >= need), default=None)
        assert tree.tightest(need) == best
        if best is not None and rng.random() < 0.7:
            tree.take(best, 1)
            rooms.remove(best)
