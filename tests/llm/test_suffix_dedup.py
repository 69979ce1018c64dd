import hashlib
import random

import pytest

from cataloom.llm import suffix_dedup


def brute(rows, length=100):
    """Earlier starts of every ``length``-byte string, document by document."""
    big = 1 << 63
    seen, out = {}, []
    docs = [((big if i is None else i), i, (t or "").encode()) for i, t in rows]
    for key, _, data in docs:
        for p in range(len(data) - length + 1):
            w = data[p : p + length]
            seen[w] = min(seen.get(w, (key, p)), (key, p))
    for key, i, data in docs:
        gone = [False] * len(data)
        for p in range(len(data) - length + 1):
            if seen[data[p : p + length]] < (key, p):
                gone[p : p + length] = [True] * length
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def test_query_table_against_brute_force(documents, spark, sf, rows_of):
    from cataloom.llm.queries import op5_suffix_dedup

    got = rows_of(op5_suffix_dedup(spark, sf))
    assert got == brute(documents)
    assert any(r[2] for r in got)


@pytest.mark.parametrize("node_rows", [1, 4096])
def test_edge_cases(make, edge, rows_of, node_rows):
    rows = [(i, t) for i, t in edge if t is None or len(t) < 20_000]
    rows.append((20, "x" * 99 + "y" * 99))
    rows.append((21, "x" * 99))
    assert rows_of(suffix_dedup.repeated_passages(make(rows), node_rows=node_rows)) == brute(rows)


@pytest.mark.parametrize("node_rows", [1, 3, 4096])
def test_overlapping_copies(make, rows_of, node_rows):
    """Cut, shifted and edited copies of a few passages, and periodic texts."""
    rng = random.Random(5)
    base = ["".join(rng.choice("abcdé ") for _ in range(700)) for _ in range(3)]
    rows = []
    for i in range(60):
        text = ""
        for _ in range(rng.randint(1, 4)):
            b = rng.choice(base)
            s = rng.randint(0, 500)
            text += b[s : s + rng.randint(60, 260)]
            if rng.random() < 0.3:
                text += "".join(rng.choice("xyz") for _ in range(rng.randint(1, 30)))
            if rng.random() < 0.15:
                text += rng.choice(["ab", "abc", "q"]) * rng.randint(40, 120)
        rows.append((i, text))
    rng.shuffle(rows)
    assert rows_of(suffix_dedup.repeated_passages(make(rows), node_rows=node_rows)) == brute(rows)


def test_short_lengths_use_the_same_path(make, rows_of):
    rows = [(i, t) for i, t in enumerate(["the quick brown fox", "a quick brown dog", "quick brown", "", "quick brown quick brown"])]
    got = rows_of(suffix_dedup.repeated_passages(make(rows), length=8, gram=3))
    assert got == brute(rows, 8)


def test_empty_and_remove(make, edge, rows_of):
    assert suffix_dedup.repeated_passages(make([])).collect() == []
    assert suffix_dedup.remove_repeats(make([])).collect() == []
    rows = [(i, t) for i, t in edge if t is None or len(t) < 20_000]
    docs = make(rows)
    out = suffix_dedup.remove_repeats(docs)
    assert out.columns == docs.columns
    kept = {(r["doc_id"], hashlib.sha256((r["text"] or "").encode()).hexdigest()) for r in out.collect() if r["doc_id"] != 11}
    assert kept == {(r[0], r[4]) for r in brute(rows) if r[0] != 11}
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in out.collect())


@pytest.mark.parametrize("node_rows", [1, 4096])
def test_rows_without_an_id_are_documents_of_their_own(make, rows_of, passage, node_rows):
    rng = random.Random(9)
    noise = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    rows = [(3, noise(50) + passage), (None, noise(500) + passage[:200] + noise(300)), (None, noise(1200)), (None, noise(1200)), (1, noise(400))]
    rows += [(None, rows[2][1]), (None, noise(90) + rows[3][1][100:400] + noise(90)), (None, None), (None, "")]
    want = [(None if i >= 1000 else i, *rest) for i, *rest in brute([(1000 + k if i is None else i, t) for k, (i, t) in enumerate(rows)])]
    assert rows_of(suffix_dedup.repeated_passages(make(rows), node_rows=node_rows)) == sorted(want, key=repr)
    clean = [r["text"] for r in suffix_dedup.remove_repeats(make(rows), node_rows=node_rows).collect()]
    assert rows[2][1] in clean and rows[3][1] in clean and "" in clean and None in clean


def test_texts_that_share_an_id_are_cut_by_themselves(make, passage):
    rng = random.Random(10)
    noise = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    rows = [(1, noise(300) + passage[:250]), (2, noise(20) + passage[:250] + noise(400)), (2, noise(900)), (2, noise(30) + "".join(map(str, range(200)))), (2, noise(500) + "".join(map(str, range(200))))]
    clean = sorted(r["text"] for r in suffix_dedup.remove_repeats(make(rows)).collect())
    assert rows[0][1] in clean and rows[2][1] in clean and rows[1][1][:20] + rows[1][1][270:] in clean
    digits = "".join(map(str, range(200)))
    assert sum(digits in t for t in clean) == 1 and {rows[3][1], rows[3][1][:30]} & set(clean) and {rows[4][1], rows[4][1][:500]} & set(clean)


@pytest.mark.parametrize("node_rows", [1, 4096])
def test_texts_that_share_an_id_are_ordered_by_their_starts(make, rows_of, node_rows):
    """Of equal strings under one doc_id the one that starts first stays, whichever
    row it is in; at one start both stay, and both go if another id has them earlier."""
    rng = random.Random(11)
    noise = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    base = noise(1500)
    rows = [(rng.randrange(25), noise(rng.randrange(30)) + base[(a := rng.randrange(1400)) : a + rng.randrange(600)]) for _ in range(120)]
    rows += [(30, base[:150] + noise(50 + k)) for k in range(4)] + [(31, base[700:900] + noise(k)) for k in (1, 2, 2)]
    fresh = noise(300)
    rows += [(40, fresh + noise(20)), (40, fresh + noise(30)), (41, noise(7) + fresh), (41, noise(7) + fresh[:250] + noise(9))]
    rows += [(50, (edge := noise(260)) + noise(9)), (50, edge + noise(10)), (45, noise(5) + edge[:200])]
    rows.append(rows[5])
    rng.shuffle(rows)
    assert rows_of(suffix_dedup.repeated_passages(make(rows), node_rows=node_rows)) == brute(rows)
