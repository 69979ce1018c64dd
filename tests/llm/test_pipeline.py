"""The whole pipeline against the brute-force versions of its stages."""

import hashlib

import corpus_pipeline
from cataloom.llm import toxicity
from test_decontaminate import brute as leaks
from test_packing import plain_best_fit
from test_simhash import brute as groups
from test_suffix_dedup import brute as repeats


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    scores = {r["doc_id"]: r["score"] for r in toxicity.score_documents(docs, toxicity.fit(docs, labels)).collect()}
    before, rows = None, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf).cache()
        now = {r["doc_id"]: r["text"] for r in out.collect()} if name != "packing" else None
        if name != "packing":
            assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        if name == "toxicity":
            assert len(now) > 150 and now.keys() == {i for i, s in scores.items() if s < 0.3}
        elif name == "simhash":
            assert now == {i: before[i] for i, (_, c) in groups(list(before.items())).items() if c == i}
        elif name == "suffix_dedup":
            want = {r[0]: r[4] for r in repeats(list(before.items()))}
            whole = {i for i, t in now.items() if hashlib.sha256(t.encode()).hexdigest() == want[i]}
            assert now.keys() == before.keys() and len(whole) >= 0.98 * len(now)  # others lost part of a character
        elif name == "decontamination":
            dirty = {r[0] for r in leaks(list(before.items()), items) if r[5]}
            assert now == {i: t for i, t in before.items() if i not in dirty}
        else:
            lengths = [r["length"] for r in out.collect()]
            assert {r["doc_id"] for r in out.collect()} == before.keys()
            assert len({r["sequence_id"] for r in out.collect()}) == len(plain_best_fit(lengths, 2048))
        before, docs = now, out
        rows[name] = out.count()
    assert corpus_pipeline.run(spark, sf).count() == rows["packing"]


def test_empty_documents(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
        assert docs.count() == 0
