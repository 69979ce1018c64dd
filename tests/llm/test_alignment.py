import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from cataloom.llm import alignment
from cataloom.llm.queries import OTHER_TOKENIZER, tokenizer_path

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def paths():
    return tokenizer_path(), tokenizer_path(OTHER_TOKENIZER)


@pytest.fixture(scope="module")
def tokens(paths):
    """text -> ((id, bytes) of A, (id, bytes) of B), by the libraries themselves."""
    import sentencepiece
    from tokenizers import Tokenizer

    one = Tokenizer.from_file(paths[0])
    one.encode_special_tokens = True
    names = {i: n for n, i in one.get_vocab().items()}
    two = sentencepiece.SentencePieceProcessor(model_file=paths[1])
    byte_of = alignment.byte_of_char()

    def split(text):
        a = [(i, bytes(byte_of[c] for c in names[i])) for i in one.encode(" " + text, add_special_tokens=False).ids]
        b = [(i, bytes([int(p[3:5], 16)]) if two.is_byte(i) else p.replace("▁", " ").encode()) for i in two.encode(text) for p in [two.id_to_piece(i)]]
        return a, b

    return split


def brute(rows, tokens):
    """Every result row by walking all pairs of neighbouring tokens."""
    links, heads, counts = [], [], Counter()
    for i, text in rows:
        a, b = tokens(text) if text else ([], [])
        raw = b" " + (text or "").encode()
        if b"".join(t for _, t in a) != raw or b"".join(t for _, t in b) != raw:
            a, b = [], []
        ends = [np.cumsum([0, *(len(t) for _, t in side)]).tolist() for side in (a, b)]
        found, j = [], 0
        for k in range(len(a)):
            while j < len(b) and ends[1][j + 1] <= ends[0][k]:
                j += 1
            q = j
            while q < len(b) and ends[1][q] < ends[0][k + 1]:
                found.append((a[k][0], b[q][0]))
                q += 1
        place = [{e: n for n, e in enumerate(side)} for side in ends]
        groups, last = [], (0, 0)
        for e in sorted(set(ends[0][1:]) & set(ends[1][1:])):
            now = (place[0][e], place[1][e])
            groups.append(",".join(str(x) for x, _ in a[last[0] : now[0]]) + "|" + ",".join(str(x) for x, _ in b[last[1] : now[1]]))
            last = now
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        heads.append((i, len(a), len(b), len(groups), digest))
        links.append(found)
        counts.update(set(found))
    best = Counter()
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    out = [(i, na, nb, ng, len(f), sum(counts[p] == best[p[0]] for p in f), sum(counts[p] for p in f), d) for (i, na, nb, ng, d), f in zip(heads, links)]
    return sorted(out, key=repr)


def test_query_table_against_brute_force(spark, sf, documents, rows_of, tokens):
    from cataloom.llm.queries import op13_alignment

    assert rows_of(op13_alignment(spark, sf), *COLUMNS) == brute(documents, tokens)


@pytest.mark.parametrize("block_bytes, radix, fan, frame", [(4 << 20, 64, 256, 4096), (2000, 3, 2, 8)])
def test_edge_cases_in_small_blocks_and_merges(make, edge, rows_of, tokens, paths, block_bytes, radix, fan, frame):
    rows = [(i, t if t is None else t[:20_000]) for i, t in edge]
    rows += [(20, "a ▁ b"), (21, "<|endoftext|> <s> </s> <unk>"), (22, "\x00 tab\tline\n\n  two"), (23, " lead"), (24, "é" * 50 + "​﻿"), (None, "one"), (20, "one")]
    got = alignment.align_tokenizers(make(rows), *paths, block_bytes=block_bytes, radix=radix, fan=fan, frame=frame)
    assert rows_of(got, *COLUMNS) == brute(rows, tokens)
    assert rows_of(alignment.align_tokenizers(make([]), *paths)) == []


def test_heap_merge_equals_counter():
    rng = random.Random(6)
    runs, want = [], Counter()
    for _ in range(9):
        keys = sorted(rng.sample(range(500), rng.randrange(1, 200)))
        counts = [rng.randrange(1, 9) for _ in keys]
        want.update(dict(zip(keys, counts)))
        keys, counts = np.array(keys, dtype=np.uint64), np.array(counts, dtype=np.uint64)
        runs.append(alignment.Run(alignment.squeezed(np.diff(keys, prepend=np.uint64(0))), alignment.squeezed(counts), len(keys), 7))
    merged = list(alignment.merge(runs))
    assert len(merged) > 20  # frames leave one by one
    keys = np.concatenate([k for k, _ in merged]).tolist()
    assert keys == sorted(want) and np.concatenate([c for _, c in merged]).tolist() == [want[k] for k in keys]
    flagged = list(alignment.with_best(iter(merged), 20))
    for k, c, best in zip(*(np.concatenate(x).tolist() for x in zip(*flagged))):
        assert best == (c == max(n for other, n in want.items() if other // 20 == k // 20))
