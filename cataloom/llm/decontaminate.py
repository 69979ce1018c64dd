"""Benchmark decontamination: a distributed positional inverted index.

``build_index`` tokenises every document once and stores the postings (row,
position, term) of every test term, with each document's word count.  A
window's terms are ranked by their posting counts: the postings of its rarest
term, shifted back by the term's offset, are the candidate starts, the second
rarest term's offset-adjusted postings cut them down, and the others confirm
what is left.  ``slop`` = 0 gives exact phrases; a larger slop lets each
other term stand up to that many words from its place (proximity).

DataFrame functions only.  Broadcasts (vocabulary, windows, surviving rows)
are hinted only after counting them against a byte bound; beyond it the same
join shuffles.

Cases: a null text has no words, and an item without words no windows; an item
of fewer than ``size`` words is one window of all of them; rows that repeat a
doc_id are judged one by one; null doc_ids are carried along; a null item_id
is not listed; repeated items count once; an empty benchmark leaves every
document clean; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cataloom.session import shared_path

from .common import broadcast_if_small, checkpoint

WINDOW = 10
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"  # on text whose A-Z are not lowered yet


def raw_words(text: Column) -> Column:
    """Words in their own case; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATORS), "")


def windows(items: DataFrame, size: int = WINDOW, item: str = "item_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(wid, n, terms) of the distinct windows, and (wid, item_id) pairs."""
    words = F.transform(raw_words(F.col(text)), lambda w: F.translate(w, UPPER, LOWER))
    rows = items.select(F.col(item).alias("item_id"), words.alias("words")).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - (size - 1)))
    rows = rows.select("item_id", "words", F.explode(starts).alias("at")).select("item_id", F.slice("words", F.col("at"), size).alias("terms")).distinct()
    distinct = checkpoint(rows.select("terms").distinct().select(F.monotonically_increasing_id().alias("wid"), F.size("terms").alias("n"), "terms"))
    return distinct, checkpoint(rows.join(distinct, "terms").select("wid", "item_id"))


def build_index(docs: DataFrame, vocabulary: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Store and return the postings (rid, doc_id, pos, term_id).

    ``vocabulary`` is (term, term_id) with term_id >= 0.  One more posting per
    document, term_id -1 at the position after its last word, carries its word
    count, so that the texts are read once.
    """
    end = docs.sparkSession.createDataFrame([("", -1)], "term string, term_id long")
    terms = checkpoint(vocabulary.select("term", "term_id").union(end).withColumn("low", F.lower("term")))
    numbered = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", F.col(text).alias("text"))
    tokens = numbered.select("rid", "doc_id", F.posexplode(F.concat(raw_words(F.col("text")), F.array(F.lit("")))).alias("pos", "word"))
    # lower() is the fast coarse key, it also folds letters beyond A-Z; the words themselves decide
    found = tokens.withColumn("low", F.lower("word")).join(broadcast_if_small(terms, 96), "low")
    found = found.where(F.translate("word", UPPER, LOWER) == F.col("term"))
    found.select("rid", "doc_id", "pos", "term_id").write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.parquet(path)


def matches(index: DataFrame, terms: DataFrame, slop: int = 0) -> DataFrame:
    """(rid, wid, start) of each window found in the index.

    ``terms`` is (wid, n, offset, term_id), checkpointed.
    """
    counts = index.where("term_id >= 0").groupBy("term_id").agg(F.count("*").alias("df"))
    order = Window.partitionBy("wid").orderBy("df", "term_id", "offset")
    ranked = terms.join(counts, "term_id", "left").fillna(0, ["df"]).withColumn("rank", F.row_number().over(order))
    ranked = checkpoint(ranked.drop("df"))
    rarest = broadcast_if_small(checkpoint(ranked.where("rank = 1").drop("rank")), 64)
    hits = index.join(rarest, "term_id").select("rid", "wid", "n", (F.col("pos") - F.col("offset")).alias("start"))
    hits = hits.where("start >= 0")

    def wanted(found: DataFrame, which: Column) -> DataFrame:
        need = found.join(broadcast_if_small(checkpoint(ranked.where(which).drop("n")), 64), "wid")
        if slop:
            need = need.withColumn("shift", F.explode(F.sequence(F.lit(-slop), F.lit(slop))))
        return need.withColumn("pos", F.col("start") + F.col("offset") + (F.col("shift") if slop else 0)).select("rid", "wid", "n", "start", "rank", "pos", "term_id")

    second = checkpoint(ranked.where("rank = 2").select("term_id").distinct())
    postings = index.select("rid", "pos", "term_id").join(broadcast_if_small(second, 48), "term_id", "left_semi")
    pairs = wanted(hits.where("n > 1"), F.col("rank") == 2).join(postings, ["rid", "pos", "term_id"], "left_semi")
    pairs = checkpoint(pairs.select("rid", "wid", "n", "start").distinct())
    rows = checkpoint(pairs.where("n > 2").select("rid").distinct())
    postings = index.select("rid", "pos", "term_id").join(broadcast_if_small(rows, 32), "rid", "left_semi")
    rest = wanted(pairs.where("n > 2"), F.col("rank") > 2).join(postings, ["rid", "pos", "term_id"], "left_semi")
    whole = rest.groupBy("rid", "wid", "n", "start").agg(F.count_distinct("rank").alias("got")).where("got = n - 2")
    keep = ["rid", "wid", "n", "start"]
    return hits.where("n = 1").select(*keep).union(pairs.where("n = 2").select(*keep)).union(whole.select(*keep))


def decontaminate(docs: DataFrame, items: DataFrame, size: int = WINDOW, slop: int = 0) -> DataFrame:
    """Per document: n_words, n_hit, n_items, items_sha256, contaminated."""
    spark: SparkSession = docs.sparkSession
    grams, owners = windows(items, size)
    offsets = grams.select("wid", "n", F.posexplode("terms").alias("offset", "term"))
    vocabulary = checkpoint(offsets.select("term").distinct().select("term", F.monotonically_increasing_id().alias("term_id")))
    index = build_index(docs, vocabulary, shared_path(spark, "postings"))
    terms = checkpoint(offsets.join(vocabulary, "term").select("wid", "n", "offset", "term_id"))
    found = checkpoint(matches(index, terms, slop))

    end = F.col("start") + F.col("n")
    before = Window.partitionBy("rid").orderBy("start", "n").rowsBetween(Window.unboundedPreceding, -1)
    spans = found.select("rid", "start", "n").distinct().withColumn("done", F.coalesce(F.max(end).over(before), F.lit(0)))
    hit = spans.groupBy("rid").agg(F.sum(F.greatest(F.lit(0), end - F.greatest("start", "done"))).alias("n_hit"))
    names = found.select("rid", "wid").distinct().join(owners.where("item_id is not null"), "wid").select("rid", F.col("item_id").cast("string").alias("item")).distinct()
    listed = names.groupBy("rid").agg(F.count("*").alias("n_items"), F.array_join(F.array_sort(F.collect_list("item")), ",").alias("items"))
    counts = index.where("term_id = -1").select("rid", "doc_id", F.col("pos").cast("long").alias("n_words"))
    out = counts.join(hit, "rid", "left").join(listed, "rid", "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return out.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce("items", F.lit("")), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def keep_clean(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """The documents without a benchmark window.  Each row is judged by its own
    text, under the text's digest, whatever its doc_id."""
    digest = F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)
    found = decontaminate(docs.select(digest.alias("doc_id"), "text"), items, size)
    hit = checkpoint(found.where("contaminated").select(F.col("doc_id").alias("_digest")).distinct())
    return docs.join(broadcast_if_small(hit, 96), digest == hit["_digest"], "left_anti")
