"""Licence scans: sentence rules.

A text is read as words (lower case, runs of letters and digits) in
paragraphs; a line without a word ends one.  A sentence starts and ends at a
line's bounds, at . ! ? ; : or a dash before white space, at a comma before
"see", or at a markup tag, and may run on over any number of lines of its
paragraph, so a notice is found however it is wrapped
and whatever comment marks its lines carry.  Sentences are looked up in a table
of known licence sentences, the longest first; a ``*`` in a known sentence
stands for any words of its paragraph (a holder's name).  What follows
``SPDX-License-Identifier:`` on its line is read as an expression: each licence
named in it (between AND, OR, WITH, brackets; a ``+`` means "or later") counts
as its own sentence.  A document's identifiers, in order of their place, are
then matched against ordered rules from left to right: a rule holds where its
identifiers follow each other, gaps of other known sentences allowed up to
``GAP`` identifiers.  Of rules that start at the same identifier the longest
holds (all of that length), and its identifiers start no other rule.  The sentence and rule tables are fixed and small and travel
with the task; every document is scanned by itself.

Cases: null and empty texts have no sentence and match nothing; every document
comes back, also without a licence; rows that share a doc_id are scanned one by
one; null doc_ids are carried along; a sentence that repeats counts each time;
an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .licence_table import RULES, SENTENCES

GAP = 1
WORD = re.compile(r"[^\W_]+")
LINE_END = re.compile(r"\r\n|\r|\n")
FRAGMENT_END = re.compile(r"(?<![.!?;:])[.!?;:]++[\"'”’)\]]*+(?=\s|$)|(?<=\s)[-–—]{1,3}(?=\s)|,(?=\s+see\b)|</?[a-z][^<>]*>")
SPDX = re.compile(r"spdx-license-identifier:((?:[\s()]|[\w.+-])+)")
#: Comment marks that are words.
WORD_MARKS = re.compile(r"\s*(?:dnl|rem)\s")


def sentence_index(sentences: dict[str, str]) -> dict[tuple, list]:
    """First two words -> (parts between ``*``, identifier), the longest first."""
    index: dict[tuple, list] = {}
    for key in sorted(sentences, key=len, reverse=True):
        parts = [p.split() for p in key.split("*")]
        if parts[0]:
            index.setdefault(tuple(parts[0][:2]), []).append((parts, sentences[key]))
    return index


def sentence_end(words: list[str], at: int, parts: list[list[str]], ends: set[int]) -> int:
    """Where the sentence that starts at ``at`` ends, 0 if it does not stand there."""
    first = parts[0]
    to = at + len(first)
    if words[at:to] != first:
        return 0
    if len(parts) == 1:
        return to if to in ends else 0
    rest = parts[1:]
    return next((e for s in range(to, len(words) + 1) if (e := sentence_end(words, s, rest, ends))), 0)


def paragraph_ids(words: list[str], bounds: list[int], index: dict[tuple, list]) -> list[str]:
    """Known sentences of one paragraph; ``bounds`` are its fragments' starts and its end."""
    out, upto, ends = [], 0, None
    for at in bounds:
        if at < upto:
            continue
        known = [*index.get(tuple(words[at : at + 2]), ()), *(index.get((words[at],), ()) if at + 1 < len(words) else ())]
        if known and ends is None:
            ends = set(bounds)
        for parts, sid in known:
            if to := sentence_end(words, at, parts, ends):
                out.append(sid)
                upto = to
                break
        if at == bounds[-2]:
            break
    return out


def known_sentences(text: str, index: dict[tuple, list]) -> list[str]:
    """Identifiers of the known sentences of a text, in order."""
    out: list[str] = []
    words: list[str] = []
    bounds = [0]
    for line in [*LINE_END.split(text.lower()), ""]:
        if "spdx-license-identifier:" in line and (named := SPDX.search(line)):
            if words:
                out += paragraph_ids(words, bounds, index)
                words, bounds = [], [0]
            out += spdx_ids(named.group(1), index)
            continue
        mark = WORD_MARKS.match(line)
        before = len(words)
        for fragment in FRAGMENT_END.split(line[mark.end() :] if mark else line):
            words += WORD.findall(fragment)
            if len(words) > bounds[-1]:
                bounds.append(len(words))
        if len(words) == before and words:
            out += paragraph_ids(words, bounds, index)
            words, bounds = [], [0]
    return out


def spdx_ids(expression: str, index: dict[tuple, list]) -> list[str]:
    """Sentence identifiers of the licences that an SPDX expression names."""
    out = []
    for name in re.split(r"[\s()]+", expression.strip()):
        name = name.rstrip(".-")
        for found in (name[:-1] + "-or-later", name[:-1]) if name.endswith("+") else (name,):
            key = WORD.findall("spdx license identifier " + found)
            known = next((sid for parts, sid in index.get(tuple(key[:2]), ()) if parts == [key]), None)
            if known and len(key) > 3:
                out.append(known)
                break
    return out


def sentence_ids(docs: DataFrame, sentences: dict[str, str] = SENTENCES) -> DataFrame:
    """(doc_id, ids): the known sentences of each document, in order."""
    index = sentence_index(sentences)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = pa.array([known_sentences(t or "", index) for t in batch.column(1).to_pylist()], type=pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=["doc_id", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<string>")


def rule_index(rules) -> dict[str, list[tuple[list[str], str]]]:
    """First identifier -> (identifiers, name), the longest first."""
    index: dict[str, list] = {}
    for name, sequence in sorted(rules, key=lambda r: -len(r[1])):
        index.setdefault(sequence[0], []).append((sequence, name))
    return index


def follows(ids: list[str], at: int, sequence: list[str], gap: int) -> list[int] | None:
    """Places of a rule's identifiers from ``at`` on, each at most ``gap``
    others after the one before; None where they do not follow."""
    if len(sequence) == 1:
        return [at]
    for to in range(at + 1, min(at + 2 + gap, len(ids))):
        if ids[to] == sequence[1] and (rest := follows(ids, to, sequence[1:], gap)):
            return [at, *rest]
    return None


def rule_matches(ids: list[str], index: dict[str, list[tuple[list[str], str]]], gap: int = GAP) -> list[tuple[str, int]]:
    """(name, place of its first identifier) of the rules found, from left to right."""
    out, taken = [], set()
    for at, sid in enumerate(ids):
        if at in taken:
            continue
        longest = 0
        for sequence, name in index.get(sid, ()):
            if len(sequence) < longest:
                break
            if places := follows(ids, at, sequence, gap):
                longest = len(sequence)
                taken.update(places)
                out.append((name, at))
    return out


def scan_licences(docs: DataFrame, sentences: dict[str, str] = SENTENCES, rules=RULES, gap: int = GAP) -> DataFrame:
    """doc_id, n_sentences (known ones), sentence_ids, licences (names, sorted)
    and matches (name@place of its first sentence, in order)."""
    index, by_first = sentence_index(sentences), rule_index(rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [known_sentences(t or "", index) for t in batch.column(1).to_pylist()]
            matches = [rule_matches(ids, by_first, gap) for ids in found]
            columns = [
                batch.column(0),
                pa.array([len(ids) for ids in found], pa.int64()),
                pa.array([",".join(ids) for ids in found], pa.string()),
                pa.array([",".join(sorted({name for name, _ in m})) for m in matches], pa.string()),
                pa.array([",".join(f"{name}@{at}" for name, at in m) for m in matches], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_sentences", "sentence_ids", "licences", "matches"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_sentences long, sentence_ids string, licences string, matches string")
