"""Source divergence audit: how far the sources of a language stand apart.

A group is a (lang, source).  ``term_counts`` counts every term of every text;
``kept_levels`` keeps the terms found in enough documents of their language and
gives each group's count of them, its *levels*.  Smoothed frequencies are whole
numbers, ``p = 1 + floor(SCALE * (count + 5) / (N + 5 * V))``, so that all
arithmetic is exact.

The divergence of two groups is the sum of ``|p - q|`` over all kept terms.  It
depends on a term only through its two levels, so the *joint table* of a pair
of groups (how many terms have level a here and level b there) prices it.  The
joint tables of all pairs are one matrix product: with one indicator column for
each (group, level), the matrix's transpose times the matrix holds them all.
The product runs in blocks: terms and sources are dealt by hash into blocks of
bounded size, a task multiplies one block of terms for one pair of source
blocks, and entries of equal place add up.  The entry (0, 0), terms that
neither group has, is what is left of V.

Cases: null text, lang and source are empty strings; a group without kept terms
has divergences to all others of its language; a language without kept terms
has value 0 everywhere; a language with one source has no pairs; repeated rows
count each time; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpoint

#: Production parameters.
MIN_DOCS, TOP_TERMS = 30, 50
SCALE, SMOOTHING = 1_000_000_000, 5
BLOCK_TERMS, BLOCK_SOURCES, PRODUCT_PAIRS = 512, 64, 256
FLUSH_TERMS = 500_000
TERM = rb"[a-z\x80-\xff]+"


def _flushed(held: dict) -> pa.RecordBatch:
    rows: list[tuple] = []
    for (lang, source), (counts, docs) in held.items():
        rows.append((lang, source, None, 0, 0))  # the group itself, also without terms
        rows += [(lang, source, t.decode(), n, docs[t]) for t, n in counts.items()]
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts of a task's texts; what is held is passed on once it
    reaches ``FLUSH_TERMS`` entries."""
    find, held, size = re.compile(TERM).findall, {}, 0
    for batch in batches:
        for lang, source, text in zip(*(c.to_pylist() for c in batch.columns)):
            counts, docs = held.setdefault((lang, source), (Counter(), Counter()))
            words, before = find(text.encode().lower()), len(counts)
            counts.update(words)
            docs.update(set(words))
            size += len(counts) - before
            if size >= FLUSH_TERMS:
                yield _flushed(held)
                held, size = {}, 0
    if held:
        yield _flushed(held)


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences) and docs (documents with it); a row
    with a null term for every group."""
    empty = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")]
    partial = docs.select(*empty).mapInArrow(_count_terms, "lang string, source string, term string, n long, docs long")
    # tasks have counted already: dealt by term as they are, not counted again before
    return partial.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def kept_terms(counts: DataFrame, min_docs: int) -> DataFrame:
    """lang, term and lang_n, its occurrences there, of the terms in at least
    ``min_docs`` documents of the language."""
    found = counts.where("term is not null").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"))
    return found.where(F.col("docs") >= min_docs).select("lang", "term", "lang_n")


def kept_levels(counts: DataFrame, kept: DataFrame) -> DataFrame:
    """lang, source, term, level (count above 0) and lang_n of the kept terms."""
    return counts.where("n > 0").join(kept, ["lang", "term"]).select("lang", "source", "term", F.col("n").alias("level"), "lang_n")


def group_sizes(counts: DataFrame, levels: DataFrame, kept: DataFrame) -> DataFrame:
    """Every group with total (its count over kept terms), lang_total and
    lang_terms (the language's kept terms)."""
    groups = counts.where("term is null").select("lang", "source")
    totals = levels.groupBy("lang", "source").agg(F.sum("level").alias("total"))
    langs = kept.groupBy("lang").agg(F.sum("lang_n").alias("lang_total"), F.count("*").alias("lang_terms"))
    return groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["total", "lang_total", "lang_terms"])


def frequency(count, total, terms):
    """The whole-number frequency; null without terms.  Exact: in 64 bits where
    they hold the product, in decimals beyond."""
    count, below = count + F.lit(SMOOTHING), F.nullif(total + F.lit(SMOOTHING) * terms, F.lit(0).cast("long"))
    above = F.lit(SCALE).cast("decimal(10,0)") * count.cast("decimal(20,0)")
    wide = F.call_function("div", above, below.cast("decimal(20,0)"))
    return F.when(count < (1 << 63) // SCALE, F.call_function("div", F.lit(SCALE).cast("long") * count, below)).otherwise(wide) + F.lit(1)


def block_product(table: pa.Table) -> pa.Table:
    """Joint-table entries of one block of terms for one pair of source blocks.

    The indicator matrix has a row per term and a column per (source, level),
    level 0 included; a row holds a single 1 for each source.  So it is kept as
    the column numbers of its ones, and its product with its transpose is exact
    in whole numbers: a row adds 1 at every pair of its columns."""
    left, right = table.column("left")[0].as_py(), table.column("right")[0].as_py()
    source, which = table.column("source").combine_chunks().dictionary_encode(), table.column("part").to_numpy()
    names = np.array(source.dictionary.to_pylist(), dtype=object)
    code = source.indices.to_numpy(zero_copy_only=False)
    words = table.column("term").combine_chunks().dictionary_encode()
    held = words.indices.is_valid().to_numpy(zero_copy_only=False)  # rows without a term only name a source
    level = np.zeros((len(words.dictionary), len(names)), dtype=np.int64)
    level[words.indices.fill_null(0).to_numpy()[held], code[held]] = table.column("level").to_numpy()[held]
    owner = np.zeros(len(names), dtype=np.int64)
    owner[code] = which
    place = np.argsort(names)  # a pair is held once, by the order of its names in one block
    one, two = np.meshgrid(place[owner[place] == left], place[owner[place] == right], indexing="ij")
    if left == right:
        one, two = (x[np.triu_indices(len(x), 1)] for x in (one, two))
    one, two = one.ravel(), two.ravel()
    values, column = np.unique(level, return_inverse=True)  # columns of a source are its numbers of this list
    column, size = column.reshape(level.shape).astype(np.int64), max(1, len(values))
    out: list[list[np.ndarray]] = [[], [], [], [], []]
    for first in range(0, len(one), PRODUCT_PAIRS):
        s, t = one[first : first + PRODUCT_PAIRS], two[first : first + PRODUCT_PAIRS]
        at = (np.arange(len(s)) * size + column[:, s]) * size + column[:, t]
        entries, terms = np.unique(at, return_counts=True)
        pair, a, b = entries // (size * size), entries // size % size, entries % size
        keep = (values[a] > 0) | (values[b] > 0) if len(values) else a > 0
        for got, x in zip(out, (s[pair], t[pair], values[a], values[b], terms)):
            got.append(x[keep])
    s, t, a, b, n = (np.concatenate([np.zeros(0, dtype=np.int64), *c]).astype(np.int64) for c in out)
    lang = table.column("lang")[0].as_py()
    strings = [pa.array([lang] * len(n), pa.string()), *(pa.array(names[x], pa.string()) for x in (s, t))]
    return pa.Table.from_arrays([*strings, pa.array(a), pa.array(b), pa.array(n)], names=["lang", "source", "other", "level", "other_level", "terms"])


def joint_tables(levels: DataFrame, groups: DataFrame, block_terms: int = BLOCK_TERMS, block_sources: int = BLOCK_SOURCES) -> DataFrame:
    """lang, source, other, level, other_level, terms: for each unordered pair
    of sources (one of the two orders), how many terms of a block have these
    levels; entries of several blocks add up, (0, 0) is left out."""
    sizes = groups.agg(F.max("lang_terms"), F.count("*")).first()
    term_blocks, source_blocks = 1 + (sizes[0] or 0) // block_terms, 1 + sizes[1] // block_sources
    part = F.pmod(F.xxhash64("source"), F.lit(source_blocks)).cast("int")
    dealt = levels.select("lang", "source", "term", "level", F.pmod(F.xxhash64("term"), F.lit(term_blocks)).alias("block"), part.alias("part"))
    # every source stands in every block, also with none of its terms
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(term_blocks - 1).cast("long"))).alias("block")
    dealt = dealt.unionByName(groups.select("lang", "source", F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("level"), every, part.alias("part")))
    partner = F.explode(F.sequence(F.lit(0), F.lit(source_blocks - 1))).alias("partner")
    dealt = dealt.select("*", partner).withColumns({"left": F.least("part", "partner"), "right": F.greatest("part", "partner")})
    schema = "lang string, source string, other string, level long, other_level long, terms long"
    return dealt.groupBy("lang", "block", "left", "right").applyInArrow(block_product, schema)


def divergences(tables: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, other, value for every ordered pair of a language's sources."""
    one = groups.select("lang", "source", F.col("total").alias("n1"), F.col("lang_terms").alias("v"))
    two = groups.select("lang", F.col("source").alias("other"), F.col("total").alias("n2"))
    apart = F.abs(frequency(F.col("level"), F.col("n1"), F.col("v")) - frequency(F.col("other_level"), F.col("n2"), F.col("v")))
    priced = tables.join(one, ["lang", "source"]).join(two, ["lang", "other"])
    priced = priced.groupBy("lang", "source", "other").agg(F.sum(F.col("terms") * apart).alias("seen"), F.sum("terms").alias("n"))
    back = priced.select("lang", F.col("other").alias("source"), F.col("source").alias("other"), "seen", "n")
    pairs = one.join(two, "lang").where("source <> other").join(priced.unionByName(back), ["lang", "source", "other"], "left")
    zero = F.lit(0).cast("long")
    rest = F.abs(frequency(zero, F.col("n1"), F.col("v")) - frequency(zero, F.col("n2"), F.col("v")))
    left = (F.col("v") - F.coalesce("n", zero)) * rest
    return pairs.select("lang", "source", "other", F.coalesce(F.coalesce("seen", zero) + left, zero).alias("value"))


def outstanding_terms(levels: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, term, value of the terms that a group uses more often than
    its language does."""
    p = frequency(F.col("level"), F.col("total"), F.col("lang_terms"))
    q = frequency(F.col("lang_n"), F.col("lang_total"), F.col("lang_terms"))
    return levels.join(groups, ["lang", "source"]).select("lang", "source", "term", (p - q).alias("value")).where("value > 0")


def audit_sources(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS, block_terms: int = BLOCK_TERMS, block_sources: int = BLOCK_SOURCES) -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item, value and rank."""
    counts = checkpoint(term_counts(docs))
    kept = checkpoint(kept_terms(counts, min_docs))
    levels = checkpoint(kept_levels(counts, kept))
    groups = checkpoint(group_sizes(counts, levels, kept))
    order = [F.col("value").desc(), F.col("item")]
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(*order))
    pairs = divergences(joint_tables(levels, groups, block_terms, block_sources), groups).withColumnRenamed("other", "item")
    terms = outstanding_terms(levels, groups).withColumnRenamed("term", "item")
    pairs = pairs.withColumns({"part": F.lit("pair"), "rank": place})
    terms = terms.withColumns({"part": F.lit("term"), "rank": place}).where(F.col("rank") <= top_terms)
    return pairs.unionByName(terms).select("lang", "source", "part", "item", "value", "rank")
