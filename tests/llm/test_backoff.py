import math
import re
from collections import Counter

import numpy as np
import pytest

from cataloom.llm import backoff


def brute(rows, order, min_count=2, alpha=0.4):
    texts = [re.findall("[0-9a-z\x80-\U0010ffff]+", (t or "").translate({c: c + 32 for c in range(65, 91)})) for _, t in rows]
    counts = Counter()
    for w in texts:
        for n in range(1, order + 1):
            counts.update(tuple(w[k : k + n]) for k in range(len(w) - n + 1))
    total = sum(map(len, texts))

    def score(context, word):
        if not context:
            return counts[(word,)] / total
        if counts[(*context, word)] >= min_count:
            return counts[(*context, word)] / counts[context]
        return alpha * score(context[1:], word)

    out = {}
    for (i, _), w in zip(rows, texts):
        s = sum(math.log(score(tuple(w[max(0, k - order + 1) : k]), w[k])) for k in range(len(w)))
        out.setdefault(i, []).append((len(w), s))
    return out


def compare(rows, got, order):
    want = brute(rows, order)
    mine = {}
    for r in got:
        mine.setdefault(r["doc_id"], []).append((r["n_words"], r["score"]))
        assert (r["mean_score"] is None) == (r["n_words"] == 0)
    assert mine.keys() == want.keys()
    for i in want:
        for (n, s), (m, t) in zip(sorted(want[i]), sorted(mine[i])):
            assert n == m and s == pytest.approx(t, rel=1e-9, abs=1e-9)


def test_query_table_against_brute_force(spark, sf, documents):
    from cataloom.llm.queries import op2_stupid_backoff

    compare(documents, op2_stupid_backoff(spark, sf).collect(), backoff.ORDER)


@pytest.mark.parametrize("order", [1, 2, 3, 5])
def test_edge_cases_over_many_blocks(make, edge, order):
    got = backoff.score_documents(make(edge), order=order, block_bytes=2000, partition_keys=500).collect()
    compare(edge, got, order)


def test_empty(make):
    assert backoff.score_documents(make([])).collect() == []


@pytest.mark.parametrize("bits", [0, 3, 16, 17, 26])
def test_keys_keep_order_and_partition(bits):
    grams = np.array([0, 1, 1, 5 << 40, 2**63, 2**64 - 1, 2**64 - 1], dtype=np.uint64)
    keys, place, counts = backoff.distinct_keys([grams], bits)
    parts, first = backoff.partitions_of(keys, bits)
    assert keys[0] == 0 and len(keys) == 5 and counts.tolist() == [1, 2, 1, 1, 2]
    assert (keys[place][1:] > 0).all() and 0 <= parts.min() and parts.max() < 2**bits
    assert parts[-1] == 2**bits - 1 and first[0] == 0
