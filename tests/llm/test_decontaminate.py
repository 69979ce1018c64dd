import hashlib
import re

import pytest

from cataloom.llm import decontaminate


def words(text):
    return re.findall("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(docs, items, size=10):
    windows = {}
    for item, text in items:
        w = words(text)
        for k in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[k : k + size]), set()).add(item)
    lengths = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        w = words(text)
        hit, found = set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                if items_of := windows.get(tuple(w[k : k + n])):
                    hit.update(range(k, k + n))
                    found |= items_of
        names = sorted(str(i) for i in found if i is not None)
        out.append((doc, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


ITEMS = [
    (1, "word0 of a passage word1 of a passage word2 of a passage word3"), (2, "Two, three!"), (3, None), (4, "..."), (5, "ab ab ab ab ab ab ab ab ab ab ab"),
    (6, "One two THREE"), (6, "One two THREE"), (7, "ÄÖÜ été Ñ 中文"), (8, "äöü été ñ 中文"), (9, "never seen words at all in any of the given documents here"), (10, "one"),
]


def test_query_table_against_brute_force(documents, spark, sf, rows_of):
    from cataloom.llm.queries import op3_decontamination

    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    got = rows_of(op3_decontamination(spark, sf))
    assert got == brute(documents, items)
    assert any(r[5] for r in got)


@pytest.mark.parametrize("size", [10, 3])
def test_edge_cases(spark, make, edge, rows_of, size):
    items = spark.createDataFrame(ITEMS, "item_id long, text string").selectExpr("item_id", "text", "1 as wid", "2 as terms")
    assert rows_of(decontaminate.decontaminate(make(edge), items, size)) == brute(edge, ITEMS, size)


def test_empty_tables_and_filter(spark, make, edge):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.decontaminate(make([]), items).collect() == []
    assert not decontaminate.decontaminate(make(edge), none).where("contaminated or n_hit > 0").take(1)
    docs = make(edge)
    kept = decontaminate.keep_clean(docs, items)
    assert kept.columns == docs.columns
    dirty = {r[0] for r in brute(edge, ITEMS) if r[5]}
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == sorted(i for i, _ in edge if i is not None and i not in dirty)


def test_filter_judges_each_row_by_its_own_text(spark, make, passage):
    items = spark.createDataFrame([(1, passage)], "item_id long, text string")
    rows = [(None, passage), (None, None), (None, "clean"), (1, "a " + passage), (1, "clean too"), (2, passage), (3, "")]
    kept = decontaminate.keep_clean(make(rows).withColumnRenamed("ids", "_digest"), items)
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr) == sorted([(None, None), (None, "clean"), (1, "clean too"), (3, "")], key=repr)


def test_proximity(spark, make):
    """A slop lets the other terms stand near their places."""
    docs = make([(1, "alpha beta gamma delta"), (2, "alpha x beta gamma delta"), (3, "alpha x x x beta gamma delta"), (4, "delta gamma beta alpha")])
    items = spark.createDataFrame([(1, "alpha beta gamma delta")], "item_id long, text string")

    def found(slop):
        return {r["doc_id"] for r in decontaminate.decontaminate(docs, items, 4, slop).where("contaminated").collect()}

    assert found(0) == {1}
    assert found(1) == {1, 2}
    assert found(3) == {1, 2, 3}  # document 4 holds the terms the other way round, none but one in its place
