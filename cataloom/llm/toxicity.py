"""Toxicity: a linear-chain conditional random field over the words of a text.

Labels come per document.  ``label_words`` turns them into word labels on a
bounded sample (``SAMPLE`` documents, those with the least hash): it picks,
one by one, the word features (whole word, prefixes, suffixes) that cover the
most toxic documents not covered yet at the cost of clean ones; words of
toxic documents with a picked feature are offending.  The field is trained on
these word labels by gradient ascent; forward-backward gives every word's
marginal, in chains that end at a line or sentence end and after ``CHAIN``
words.  A document's score is a logistic function of its largest marginal and
of the sum of marginals, fitted on the sample; words with a marginal of a half
or more are its offending spans.  Training needs only the sample; scoring
reads whole texts, and each document is scored from its own text alone.

Cases: null and empty texts have no words and get the score of no evidence;
rows that share a doc_id are scored one by one, labels that repeat a doc_id
count once (the highest); null doc_ids are scored and never train; without a
toxic or a clean training document every score is the training share of toxic
ones (0 without labels); an empty table gives no rows; extra columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Rolling, slabs, word_spans

#: Bound on the labelled documents that training reads, and model sizes.
SAMPLE, TABLE_BITS, CHAIN, AFFIXES, ROUNDS = 4000, 20, 64, (3, 4, 5, 6), 30
THRESHOLD = 0.3


def byte_classes() -> tuple[np.ndarray, np.ndarray]:
    """(lower-casing table, whether a byte belongs to a word)."""
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    inside = np.zeros(256, dtype=bool)
    inside[48:58] = inside[97:123] = inside[128:] = True
    return lower, inside


@dataclass
class Words:
    """The words of a slab: byte spans, document, number of the distinct word
    and chain start; ``features`` has a row for each distinct word."""

    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    kind: np.ndarray
    chain: np.ndarray
    hashes: np.ndarray
    features: np.ndarray


def slab_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    lower, inside = byte_classes()
    data = lower[data]
    start, end = word_spans(data, inside, offsets)
    if not len(start):
        none = np.zeros(0, dtype=np.int64)
        return Words(none, none, none, none, np.zeros(0, dtype=bool), np.zeros(0, dtype=np.uint64), np.zeros((0, 1 + 2 * len(AFFIXES)), dtype=np.int64))
    hashes = Rolling(data)
    whole, some, kind = np.unique(hashes.spans(start, end), return_index=True, return_inverse=True)
    a, b = start[some], end[some]
    spans = [(a, b, 0)]
    for k in AFFIXES:
        size = np.minimum(k, b - a)
        spans += [(a, a + size, k), (b - size, b, 16 + k)]
    mask = np.uint64((1 << TABLE_BITS) - 1)
    features = np.stack([((hashes.spans(a, b) + np.uint64(place * 0x9E3779B1)) & mask).astype(np.int64) for a, b, place in spans], axis=1)
    doc = np.searchsorted(offsets, start, side="right") - 1
    stops = np.cumsum(np.isin(data, np.frombuffer(b".!?\n", dtype=np.uint8)))
    sentence = np.r_[0, stops][start]
    new = np.r_[True, (doc[1:] != doc[:-1]) | (sentence[1:] != sentence[:-1])]
    first = np.flatnonzero(new)
    at = np.arange(len(start)) - np.repeat(first, np.diff(np.r_[first, len(start)]))
    return Words(start, end, doc, kind, at % CHAIN == 0, whole, features)


def words_of(texts: list[str | None]) -> Words:
    """The words of many texts, a slab at a time, without their byte spans."""
    parts, first = [], 0
    for _, part, data, offsets in slabs([pa.record_batch([pa.array(texts, type=pa.string())], names=["text"])]):
        words = slab_words(data, offsets)
        words.start = words.end = words.start[:0]
        words.doc = (words.doc + first).astype(np.int32)
        words.kind, words.features = words.kind.astype(np.int32), words.features.astype(np.int32)
        parts.append(words)
        first += len(part)
    hashes, some, place = np.unique(np.concatenate([w.hashes for w in parts]), return_index=True, return_inverse=True)
    base = np.cumsum([0, *(len(w.hashes) for w in parts)])
    kind = np.concatenate([place[w.kind + b].astype(np.int32) for w, b in zip(parts, base)])
    start, end, doc, chain, features = (np.concatenate([getattr(w, n) for w in parts]) for n in ("start", "end", "doc", "chain", "features"))
    return Words(start, end, doc, kind, chain, hashes, features[some])


@dataclass
class Field:
    """Weights of label 1 against label 0, and of label changes."""

    weights: np.ndarray = field(default_factory=lambda: np.zeros(1 << TABLE_BITS))
    bias: float = -4.0
    moves: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    scale: np.ndarray = field(default_factory=lambda: np.zeros(3))

    def emission(self, words: Words) -> np.ndarray:
        return self.weights[words.features].sum(axis=1)[words.kind] + self.bias

    def marginals(self, emission: np.ndarray, chain: np.ndarray, pairs: bool = False, step: int = 1 << 17):
        """P(label 1) per word; with ``pairs`` also the summed expectation of
        each label change.  Takes whole chains of about ``step`` words at once."""
        first = np.flatnonzero(chain)
        at = np.unique(np.searchsorted(first, np.arange(0, len(emission), step)))
        cuts = np.r_[first[at[at < len(first)]], len(emission)]
        marginal, moves = np.zeros(len(emission)), np.zeros((2, 2))
        for a, b in zip(cuts[:-1], cuts[1:]):
            marginal[a:b], part = self._marginals(emission[a:b], chain[a:b], pairs)
            moves += part
        return (marginal, moves) if pairs else marginal

    def _marginals(self, emission: np.ndarray, chain: np.ndarray, pairs: bool) -> tuple[np.ndarray, np.ndarray]:
        """Forward-backward, all chains in step."""
        n = len(emission)
        first = np.flatnonzero(chain)
        size = np.diff(np.r_[first, n])
        by = np.argsort(-size, kind="stable")
        first, size = first[by], size[by]
        live = [int(np.searchsorted(-size, -t, side="left")) for t in range(int(size[0]))]  # chains longer than t
        # log-odds of the forward and backward messages
        go = np.exp(self.moves)
        forward, backward = np.zeros(n), np.zeros(n)
        odds = np.zeros(len(first))
        for t, m in enumerate(live):
            at = first[:m] + t
            if t:
                p = 1 / (1 + np.exp(-np.clip(odds[:m], -50, 50)))
                odds[:m] = np.log(((1 - p) * go[0, 1] + p * go[1, 1]) / ((1 - p) * go[0, 0] + p * go[1, 0]))
            odds[:m] += emission[at]
            forward[at] = odds[:m]
        odds = np.zeros(len(first))
        for t in range(len(live) - 1, 0, -1):
            m = live[t]
            at = first[:m] + t
            p = 1 / (1 + np.exp(-np.clip(odds[:m] + emission[at], -50, 50)))
            odds[:m] = np.log(((1 - p) * go[1, 0] + p * go[1, 1]) / ((1 - p) * go[0, 0] + p * go[0, 1]))
            backward[at - 1] = odds[:m]
        marginal = 1 / (1 + np.exp(-np.clip(forward + backward, -50, 50)))
        if not pairs:
            return marginal, np.zeros((2, 2))
        later = np.flatnonzero(~chain)
        a = 1 / (1 + np.exp(-np.clip(forward[later - 1], -50, 50)))
        b = 1 / (1 + np.exp(-np.clip(backward[later] + emission[later], -50, 50)))
        both = np.stack([(1 - a) * (1 - b) * go[0, 0], (1 - a) * b * go[0, 1], a * (1 - b) * go[1, 0], a * b * go[1, 1]])
        return marginal, (both / both.sum(axis=0)).sum(axis=1).reshape(2, 2)

    def evidence(self, words: Words, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
        """Marginals m, and per document (1, largest -ln(1 - m), ln(1 + sum of -ln(1 - m)))."""
        marginal = self.marginals(self.emission(words), words.chain)
        weight = -np.log1p(-np.minimum(marginal, 1 - 1e-6))
        top = np.zeros(n_docs)
        np.maximum.at(top, words.doc, weight)
        return marginal, np.stack([np.ones(n_docs), top, np.log1p(np.bincount(words.doc, weight, minlength=n_docs))], axis=1)

    def scores(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(evidence @ self.scale, -50, 50)))


def label_words(words: Words, toxic: np.ndarray, least_gain: int = 3, clean_cost: float = 3.0, repeats: tuple[int, ...] = (1, 2, 4), common: float = 0.1) -> np.ndarray:
    """Whether each word offends, from document labels.  A feature covers a
    document that holds it once, or (words that clean texts use too) at least
    2 or 4 times; the number that covers best decides.  Features that cover a
    share ``common`` of the toxic documents are picked from the start, so that
    words which stand together are all found."""
    docs, size = len(toxic), 1 << TABLE_BITS
    pair, times = np.unique(words.kind.astype(np.int64) * docs + words.doc, return_counts=True)
    covers: list[list] = [[[], [], np.zeros(size)] for _ in repeats]
    for column in words.features.T:  # a feature belongs to one place of the word
        own, place = np.unique(column[pair // docs].astype(np.int64) * docs + pair % docs, return_inverse=True)
        held = np.bincount(place, times)
        for cover, least in zip(covers, repeats):
            feature, doc = own[held >= least] // docs, own[held >= least] % docs
            bad = toxic[doc] == 1
            cover[0].append(feature[bad])
            cover[1].append(doc[bad])
            cover[2] += clean_cost * np.bincount(feature[~bad], minlength=size)
    covers = [[np.concatenate(f), np.concatenate(d), cost] for f, d, cost in covers]
    is_open = toxic == 1
    enough = max(least_gain, common * is_open.sum())
    picked = []
    for feature, doc, cost in covers:
        often = np.flatnonzero(np.bincount(feature, minlength=size) - cost >= enough)
        picked += often.tolist()
        is_open[doc[np.isin(feature, often)]] = False
    while True:
        gains = [np.bincount(f[is_open[d]], minlength=size) - cost for f, d, cost in covers]
        level = int(np.argmax([g.max() for g in gains]))
        best = int(np.argmax(gains[level]))
        if gains[level][best] < least_gain:
            break
        picked.append(best)
        is_open[covers[level][1][covers[level][0] == best]] = False
    return np.isin(words.features, picked).any(axis=1)[words.kind] & (toxic[words.doc] == 1)


def train(texts: list[str | None], toxic: np.ndarray) -> Field:
    """Fit the field and the document score on labelled texts."""
    model = Field()
    share = float(np.mean(toxic)) if len(toxic) else 0.0
    if share in (0.0, 1.0):
        model.scale = np.array([60.0 * (2 * share - 1), 0.0, 0.0])
        return model
    words = words_of(texts)
    goal = label_words(words, toxic).astype(float)
    later = np.flatnonzero(~words.chain)
    seen = np.bincount((2 * goal[later - 1] + goal[later]).astype(int), minlength=4).reshape(2, 2)
    flat, width, squares = words.features.ravel(), words.features.shape[1], None
    scale = 1.0 / max(1.0, goal.sum())
    for _ in range(ROUNDS):
        marginal, expected = model.marginals(model.emission(words), words.chain, pairs=True)
        error = goal - marginal
        by_kind = np.bincount(words.kind, error, minlength=len(words.features))
        step = np.r_[np.bincount(flat, np.repeat(by_kind, width), minlength=1 << TABLE_BITS) * scale - 1e-4 * model.weights, error.sum() * scale, ((seen - expected) * scale).ravel()]
        squares = step**2 if squares is None else squares + step**2
        step = 0.5 * step / (np.sqrt(squares) + 1e-6)
        model.weights += step[: 1 << TABLE_BITS]
        model.bias += step[1 << TABLE_BITS]
        model.moves += step[(1 << TABLE_BITS) + 1 :].reshape(2, 2)
    x = model.evidence(words, len(texts))[1]
    for _ in range(50):  # Newton steps of a ridge logistic fit
        p = model.scores(x)
        pull = x.T @ (toxic - p) - 0.1 * model.scale
        curve = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(3)
        model.scale = model.scale + np.clip(np.linalg.solve(curve, pull), -2, 2)
    model.weights = model.weights.astype(np.float32)
    return model


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(text, toxic) of at most ``sample`` documents: known labels only (rows
    whose crc32(doc_id) mod 4 is not 2), those with the least hash of doc_id."""
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.where(~held_out()).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    return docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").orderBy("doc_id", "text").limit(sample).select("text", "toxic")


def held_out():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Field:
    """Train on the bounded sample, in one task; the model comes back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, toxic = [], []
        for batch in batches:
            texts += batch.column(0).to_pylist()
            toxic += batch.column(1).to_pylist()
        model = train(texts, np.array(toxic, dtype=float))
        parts = [model.weights.astype("<f4"), np.array([model.bias]), model.moves, model.scale]
        yield pa.RecordBatch.from_arrays([pa.array([p.tobytes()]) for p in parts], names=["weights", "bias", "moves", "scale"])

    rows = training_rows(docs, labels, sample).coalesce(1).mapInArrow(run, "weights binary, bias binary, moves binary, scale binary").collect()
    if not rows:  # no partition, so no training document
        return train([], np.zeros(0))
    weights, bias, moves, scale = rows[0]
    numbers = lambda b: np.frombuffer(b, dtype=float)
    return Field(np.frombuffer(weights, dtype="<f4"), float(numbers(bias)[0]), numbers(moves).reshape(2, 2), numbers(scale))


def score_documents(docs: DataFrame, model: Field, spans: bool = False) -> DataFrame:
    """doc_id, score (and ``spans``: byte offsets and marginal of each offending word)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a fixed 4 MB table

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field_ = shared.value
        for batch in batches:
            kind = batch.schema.field(0).type
            for (ids,), part, data, offsets in slabs([batch]):
                words = slab_words(data, offsets)
                marginal, evidence = field_.evidence(words, len(part))
                cols = [pa.array(ids, type=kind), pa.array(field_.scores(evidence))]
                if spans:
                    hit = np.flatnonzero(marginal >= 0.5)
                    found: list[list] = [[] for _ in part]
                    for i in hit:
                        d = words.doc[i]
                        found[d].append({"start": int(words.start[i] - offsets[d]), "end": int(words.end[i] - offsets[d]), "marginal": float(marginal[i])})
                    cols.append(pa.array(found, type=pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("marginal", pa.float64())]))))
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "score", "spans"][: len(cols)])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, score double" + ", spans array<struct<start:int,end:int,marginal:double>>" * spans
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """The documents that score below ``threshold``."""
    model = fit(docs, labels, sample)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, keep = batch.schema.get_field_index("text"), []
            for _, part, data, offsets in slabs([pa.RecordBatch.from_arrays([batch.column(at)], names=["text"])]):
                keep.append(shared.value.scores(shared.value.evidence(slab_words(data, offsets), len(part))[1]) < threshold)
            if keep:
                yield batch.filter(pa.array(np.concatenate(keep)))

    return docs.mapInArrow(scored, docs.schema)
