import itertools
import math

import numpy as np
import pytest

from cataloom.llm import toxicity
from cataloom.llm.queries import op6_toxicity


def test_marginals_against_all_paths():
    rng = np.random.default_rng(1)
    model = toxicity.Field(moves=rng.normal(size=(2, 2)))
    chain = np.array([True, False, False, False, True, True, False])
    emission = rng.normal(size=len(chain))
    got, pairs = model.marginals(emission, chain, pairs=True)
    want, moves = np.zeros(len(chain)), np.zeros((2, 2))
    bounds = [*np.flatnonzero(chain), len(chain)]
    for a, b in zip(bounds[:-1], bounds[1:]):
        total, seen, change = 0.0, np.zeros(b - a), np.zeros((2, 2))
        for path in itertools.product((0, 1), repeat=b - a):
            p = math.exp(sum(emission[a + k] * y for k, y in enumerate(path)) + sum(model.moves[x, y] for x, y in zip(path, path[1:])))
            total += p
            seen += p * np.array(path)
            for x, y in zip(path, path[1:]):
                change[x, y] += p
        want[a:b] = seen / total
        moves += change / total
    assert np.allclose(got, want) and np.allclose(pairs, moves)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in op6_toxicity(spark, sf).collect()]
    assert len(rows) == 10_000 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    held = [(r["score"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    bad, good = [s for s, y in held if y], [s for s, y in held if not y]
    auc = np.mean([[(b > g) + 0.5 * (b == g) for g in good] for b in bad])
    recall, false = np.mean([b >= 0.3 for b in bad]), np.mean([g >= 0.3 for g in good])
    print("held-out", auc, recall, false, len(bad), len(good))
    assert auc > 0.95 and recall > 0.85 and false < 0.03


@pytest.fixture(scope="module")
def tiny(spark):
    docs = [(i, f"plain words number {i} here. you are an idiot\nand more" if i % 3 == 0 else f"plain words number {i} here and more") for i in range(90)]
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(90)] + [(0, 0, 1), (None, 1, 1), (5, 0, None), (999, 1, 1)], "doc_id long, quality int, toxic int")
    return docs, labels


def test_spans_point_at_the_words(make, tiny):
    docs, labels = tiny
    model = toxicity.fit(make(docs), labels)
    rows = {r["doc_id"]: r for r in toxicity.score_documents(make([*docs, (200, "é IDIOT! fine"), (201, None), (202, "")]), model, spans=True).collect()}
    assert all((rows[i]["score"] >= 0.3) == (i % 3 == 0) for i in range(90))
    (span,) = [s for s in rows[200]["spans"] if b"IDIOT" in "é IDIOT! fine".encode()[s["start"] : s["end"]]]
    assert span["marginal"] >= 0.5
    assert rows[201]["score"] == rows[202]["score"] < 0.3 and rows[201]["spans"] == []


def test_edge_cases(make, edge, tiny, spark):
    docs, labels = tiny
    model = toxicity.fit(make(docs), labels)
    assert toxicity.score_documents(make(edge), model).count() == len(edge)
    assert toxicity.score_documents(make([]), model).collect() == []
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] < 0.01 for r in toxicity.score_documents(make(edge), toxicity.fit(make(docs), none)).collect()} == {True}
    frame = make([*docs, *edge])
    kept = toxicity.keep_clean(frame, labels)
    assert kept.columns == frame.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None and r["lang"] is None and r["doc_id"] >= 14) == [i for i in range(14, 90) if i % 3]
