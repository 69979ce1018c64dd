import random

import numpy as np
import pytest
from xxhash import xxh64_intdigest

from cataloom.llm import simhash


def brute(rows, distance=3):
    out, fps = {}, {}
    for i, t in rows:
        if i is None:
            continue
        words = (t or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()
        grams = [words[k : k + 3] for k in range(len(words) - 2)] or ([words] if words else [])
        hashes = [xxh64_intdigest(b" ".join(g), 42) for g in grams]
        fps[i] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    parent = {i: i for i in fps}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(fps)
    for a in ids:
        for b in ids:
            if a < b and (fps[a] ^ fps[b]).bit_count() <= distance:
                ra, rb = sorted((root(a), root(b)))
                parent[rb] = ra
    for i in ids:
        out[i] = (f"{fps[i]:016x}", root(i))
    return out


def test_query_table_against_brute_force(documents, spark, sf):
    from cataloom.llm.queries import op1_simhash

    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in op1_simhash(spark, sf).collect()}
    assert got == brute(documents)


def test_edge_cases(make, edge):
    rows = simhash.near_duplicates(make(edge)).collect()
    want = brute(edge)
    assert len(rows) == len(edge)
    for r in rows:
        if r["doc_id"] is None:
            assert r["component_id"] is None
        else:
            assert (r["fingerprint"], r["component_id"]) == want[r["doc_id"]]


@pytest.mark.parametrize("node_rows", [2, 8, 2048])
def test_links_with_split_nodes(spark, node_rows):
    """Dense fingerprints: node splitting changes no component."""
    rng = random.Random(3)
    centres = [rng.getrandbits(64) for _ in range(12)] + [0, 2**64 - 1, 2**63]
    fps = {c for c in centres}
    for c in centres:
        for _ in range(25):
            x = c
            for b in rng.sample(range(64), rng.randint(1, 6)):
                x ^= 1 << b
            fps.add(x)
    fps = sorted(fps)
    signed = np.array(fps, dtype=np.uint64).view(np.int64).tolist()
    links = simhash.trie_links(spark.createDataFrame([(x,) for x in signed], "fp long"), 3, node_rows)
    from cataloom.llm.common import components

    got = {r["node"]: r["root"] for r in components(links).collect()}
    parent = list(range(len(fps)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                parent[root(i)] = root(j)
    groups = {}
    for i, s in enumerate(signed):
        groups.setdefault(root(i), []).append(s)
    want = {s: min(g) for g in groups.values() if len(g) > 1 for s in g}
    assert got == want


@pytest.mark.parametrize("node_rows", [64, 2048])
def test_nodes_stay_whole_when_joins_turn_to_broadcasts(spark, node_rows):
    """One node of near pairs that agree on their first block only, in many
    partitions, with joins that become broadcast joins while they run."""
    rng = random.Random(5)
    pairs = set()
    for _ in range(100):
        one = 0xABCD << 48 | rng.getrandbits(48)
        pairs.add((one, one ^ sum(1 << 16 * block + rng.randrange(16) for block in range(3))))
    fps = [x for side in zip(*pairs) for x in side]
    signed = np.array(fps, dtype=np.uint64).view(np.int64).tolist()
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "10m",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        rows = spark.createDataFrame([(x,) for x in signed], "fp long").repartition(16)
        links = simhash.trie_links(rows, 3, node_rows).collect()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    got = {tuple(sorted((u % 2**64, v % 2**64))) for u, v in links}
    assert got == {tuple(sorted(p)) for p in pairs}


def test_empty_and_keep_first(make, edge, rows_of):
    assert simhash.near_duplicates(make([])).collect() == []
    assert simhash.keep_first(make([])).collect() == []
    docs = make(edge)
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    want = sorted({c for _, c in brute(edge).values()})
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == want
    assert kept.where("doc_id is null").count() == 2
