import random
import re
from collections import Counter, defaultdict

import pytest

from cataloom.llm import divergence


def brute(rows, min_docs, top=50):
    """rows of (lang, source, text) -> set of result rows, in whole numbers."""
    found, docs, groups = defaultdict(Counter), Counter(), defaultdict(set)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        low = (text or "").translate({c: c + 32 for c in range(65, 91)}).encode()
        terms = Counter(re.findall(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low))
        groups[lang].add(source)
        found[lang, source].update(terms)
        docs.update((lang, t) for t in terms)
    out = set()
    for lang, sources in groups.items():
        kept = sorted(t for (x, t), n in docs.items() if x == lang and n >= min_docs)
        whole = {t: sum(found[lang, s][t] for s in sources) for t in kept}
        v = len(kept)

        def freq(count, total):
            return {t: 1 + 10**9 * (count[t] + 5) // (total + 5 * v) for t in kept}

        p = {s: freq(found[lang, s], sum(found[lang, s][t] for t in kept)) for s in sources}
        q = freq(whole, sum(whole.values()))
        for s in sources:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in sources if o != s]
            terms = [(q[t] - p[s][t], t) for t in kept if found[lang, s][t] and p[s][t] > q[t]]
            for part, ranked in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out |= {(lang, s, part, item.decode(), -value, i) for i, (value, item) in enumerate(ranked, 1)}
    return out


@pytest.fixture(scope="module")
def mixed():
    rng = random.Random(4)
    words = ["alpha", "Beta", "GAMMA", "été", "ñ", "中文", "x1y", "it's", "delta", "eps", "zeta", "Ünder", "plain"]
    rows = []
    for i in range(400):
        lang, source = rng.choice(["en", "de", None, ""]), rng.choice(["a", "b", "c", None, "Ω"])
        rows.append((i % 350, lang, source, rng.choice([None, "", "12 34", " ".join(rng.choices(words, k=rng.randrange(1, 40)))])))
    rows += [(1000 + i, "en", "hot", "alpha " * i) for i in range(300)]  # one source with over a third of all rows
    return rows + [(9, "fr", "only", "mot"), (10, "it", "p", None), (11, "it", "q", "uno due")]


def as_frame(spark, rows):
    extra = [(*r, 1, "t", 2, 3, 4) for r in rows]
    return spark.createDataFrame(extra, "doc_id long, lang string, source string, text string, n long, term string, level long, block int, part int")


@pytest.mark.parametrize("block_terms, block_sources", [(512, 64), (2, 2)])
def test_blocks_against_brute_force(spark, rows_of, mixed, block_terms, block_sources):
    got = divergence.audit_sources(as_frame(spark, mixed), 5, block_terms=block_terms, block_sources=block_sources)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    rows = rows_of(got)
    assert len(rows) == len(set(rows)) and set(rows) == brute([r[1:] for r in mixed], 5)


def test_query_table_against_brute_force(spark, sf, rows_of):
    from cataloom.llm.queries import op12_divergence

    docs = spark.read.parquet(f"{sf}/documents.parquet").select("lang", "source", "text").collect()
    assert set(rows_of(op12_divergence(spark, sf))) == brute([tuple(r) for r in docs], 30)


def test_joint_tables_hold_every_pair(spark, mixed):
    """Joint tables add up to the kept terms that either source has."""
    counts = divergence.term_counts(as_frame(spark, mixed))
    kept = divergence.kept_terms(counts, 5)
    levels = divergence.kept_levels(counts, kept).cache()
    groups = divergence.group_sizes(counts, levels, kept)
    got = {}
    for r in divergence.joint_tables(levels, groups, 3, 2).collect():
        key = (r["lang"], *sorted((r["source"], r["other"])))
        assert r["level"] or r["other_level"]
        got[key] = got.get(key, 0) + r["terms"]
    have = defaultdict(set)
    for r in levels.collect():
        have[r["lang"], r["source"]].add(r["term"])
    names = sorted(have)
    want = {(x[0], x[1], y[1]): len(have[x] | have[y]) for x in names for y in names if x[0] == y[0] and x[1] < y[1]}
    assert got == want


def test_empty_table_and_no_kept_terms(spark, rows_of):
    assert divergence.audit_sources(as_frame(spark, [])).count() == 0
    rows = [(1, "en", "a", "x y"), (2, "en", "b", None), (3, "en", "b", "x")]
    assert rows_of(divergence.audit_sources(as_frame(spark, rows))) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


def test_frequency_is_exact_beyond_doubles(spark):
    big = spark.createDataFrame([(9_007_199_254_740_993, 12_345_678_901_234_567, 77_777)], "c long, t long, v long")
    value = big.select(divergence.frequency(big["c"], big["t"], big["v"])).first()[0]
    assert value == 1 + 10**9 * (9_007_199_254_740_993 + 5) // (12_345_678_901_234_567 + 5 * 77_777)
