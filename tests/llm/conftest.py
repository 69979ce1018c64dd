import pytest

from pyspark.sql import Row

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rid long, fp string, block int, score double, _row long, ids string"


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark, sf):
    """(doc_id, text) rows of the smallest table."""
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def make(spark):
    """Documents with extra columns that clash with the operators' own names."""

    def build(rows):
        rows = [(i, t, None, "s", None if t is None else len(t), 7, "x", 1, 0.5, 3, "y") for i, t in rows]
        return spark.createDataFrame(rows, DOC_SCHEMA)

    return build


@pytest.fixture(scope="session")
def passage():
    return " ".join(f"word{i} of a passage" for i in range(40))


@pytest.fixture(scope="session")
def edge(passage):
    """Nulls, empty and long texts, ties, repeated rows."""
    long = " ".join(f"t{i * 7919 % 10007}" for i in range(30_000))
    return [
        (1, None), (2, ""), (3, "   "), (4, "one"), (5, "One two THREE"), (6, passage), (7, passage), (8, "before " + passage + " after"),
        (9, long), (10, long + " end"), (11, "ÄÖÜ été Ñ 中文 😀 " * 20), (11, "ÄÖÜ été Ñ 中文 😀 " * 20), (12, "a" * 5000), (None, passage), (None, None), (13, "ab " * 300),
    ]


@pytest.fixture(scope="session")
def rows_of():
    def collect(df, *names):
        return sorted((tuple(r[n] for n in names) if names else tuple(r) for r in df.collect()), key=repr)

    return collect


__all__ = ["Row"]
