import random

import numpy as np
import pytest

from cataloom.llm import minhash


def sets_of(rows, size=3):
    out = []
    for i, t in rows:
        words = (t or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()
        out.append((i, {tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1))} if words else set()))
    return out


def brute(rows, percent=85):
    """(doc_id, n_shingles, component_id) of every row."""
    sets = sets_of(rows)
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, (_, x) in enumerate(sets):
        for b in range(a):
            y = sets[b][1]
            if x and y and min(len(x), len(y)) * 100 >= percent * max(len(x), len(y)):
                both = len(x & y)
                if 100 * both >= percent * (len(x) + len(y) - both):
                    parent[max(root(a), root(b))] = min(root(a), root(b))
    out = []
    for a, (i, x) in enumerate(sets):
        ids = [j for b, (j, _) in enumerate(sets) if root(b) == root(a) and j is not None]
        out.append((i, len(x), (min(ids) if ids else None) if x else i))
    return sorted(out, key=repr)


def result(df):
    rows = df.collect()
    for r in rows:
        assert r["kept"] == (r["doc_id"] == r["component_id"])
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows), key=repr)


def test_query_table_against_brute_force(documents, spark, sf):
    from cataloom.llm.queries import op11_odd_sketches

    assert result(op11_odd_sketches(spark, sf)) == brute(documents)


def test_edge_cases(make, edge):
    assert result(minhash.near_duplicates(make(edge))) == brute(edge)
    assert minhash.near_duplicates(make([])).count() == 0


def families(seed=5, n=160):
    """Texts at every similarity around the bound, short ones too."""
    rng = random.Random(seed)
    rows = []
    for base in range(4):
        words = [f"w{rng.randrange(400)}" for _ in range((9, 25, 120, 500)[base])]
        for _ in range(n // 4):
            copy = list(words)
            for _ in range(rng.randrange(0, 1 + len(words) // 30)):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(50)}"
            rows.append((len(rows) * 7 % 1009, " ".join(copy)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("hub_rounds, block_rows", [(0, 4), (1, 2048), (2, 16)])
def test_families_by_hubs_and_blocks(make, hub_rounds, block_rows):
    rows = families()
    got = result(minhash.near_duplicates(make(rows), hub_rounds=hub_rounds, block_rows=block_rows))
    assert got == brute(rows)


def test_sketches_tell_similarities():
    rng = np.random.default_rng(1)
    for share in (0.85, 0.95):
        far = 0
        for _ in range(60):
            n = int(rng.integers(20, 400))
            both = round(2 * n * share / (1 + share))
            pool = rng.integers(0, 2**64, 2 * n - both, dtype=np.uint64)
            keys, odd = minhash.sketch([np.unique(pool[:n]), np.unique(pool[n - both :])])
            assert (keys[0] == keys[1]).any()
            far = max(far, int(np.bitwise_count(odd[0] ^ odd[1]).sum()))
        assert far <= minhash.most_bits()
    _, odd = minhash.sketch([np.unique(rng.integers(0, 2**64, 300, dtype=np.uint64)) for _ in range(2)])
    assert np.bitwise_count(odd[0] ^ odd[1]).sum() > minhash.most_bits()


def test_hot_groups(make):
    """A third exact copies, a third near copies of one text, the rest alone."""
    rng = random.Random(2)
    base = [f"b{rng.randrange(3000)}" for _ in range(200)]
    rows = [(i, "the one text that is copied very often indeed") for i in range(300)]
    for i in range(300, 600):
        near = list(base)
        near[rng.randrange(200)] = f"y{i}"
        rows.append((i, " ".join(near)))
    rows += [(i, " ".join(f"z{rng.randrange(9999)}" for _ in range(30))) for i in range(600, 900)]
    got = {i: c for i, _, c in result(minhash.near_duplicates(make(rows)))}
    assert all(got[i] == 0 for i in range(300)) and all(got[i] == 300 for i in range(300, 600)) and all(got[i] == i for i in range(600, 900))
