import hashlib
import random

import pytest

from cataloom.llm import fingerprints
from cataloom.llm.fingerprints import PrefixHash, edited, encode, likeness, sketch


def test_spans_and_extensions():
    rng = random.Random(2)
    text = bytes(rng.choice(b"ab") for _ in range(600)) + b"tail"
    other = text[100:400] + b"x" + text[200:]
    a, b = PrefixHash(text), PrefixHash(other)
    for _ in range(300):
        i, j, n = rng.randrange(len(text)), rng.randrange(len(other)), rng.randrange(40)
        fits = i + n <= len(text) and j + n <= len(other)
        assert a.equal(i, b, j, n) == (fits and text[i : i + n] == other[j : j + n])
        want = 0
        while i + want < len(text) and j + want < len(other) and text[i + want] == other[j + want]:
            want += 1
        assert a.common_extension(i, b, j) == want
    assert a.common_extension(len(text), b, 0) == 0
    assert PrefixHash(b"").n == 0


def brute(rows):
    """Rows in descending order with the next document's text."""
    order = sorted(rows, key=lambda r: (-(r[0] if r[0] is not None else -(1 << 63)), (r[1] is not None, r[1] or "")))
    out = []
    for k, (i, t) in enumerate(order):
        t, nxt = t or "", order[(k + 1) % len(order)][1] or ""
        e = t[: len(t) - len(t) // 2] + nxt[: len(t) // 2]
        a, b, c = (sketch(x.encode()) for x in (t, e, nxt))
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), encode(a), encode(b), likeness(a, b), likeness(a, c)))
    return sorted(out, key=repr)


def test_query_table_against_brute_force(spark, sf, documents, rows_of):
    from cataloom.llm.queries import op4_fingerprints

    got = rows_of(op4_fingerprints(spark, sf))
    assert got == brute(documents)
    near, far = [sum(r[k] for r in got) / len(got) for k in (5, 6)]
    assert near > 0.25 and far < 0.1


@pytest.mark.parametrize("blocks", [1, 2, 7, 40])
def test_edge_cases(make, edge, rows_of, blocks):
    assert rows_of(fingerprints.document_fingerprints(make(edge), blocks)) == brute(edge)


def test_small_tables(make, rows_of):
    assert fingerprints.document_fingerprints(make([])).collect() == []
    assert rows_of(fingerprints.document_fingerprints(make([(5, "abcdef")]))) == brute([(5, "abcdef")])
    assert edited("abcde", "XY") == "abcXY" and edited("abcde", "X") == "abcX" and edited("", "X") == ""


def test_likeness_follows_overlap():
    rng = random.Random(4)
    text = "".join(rng.choice("abcdefgh ") for _ in range(4000))
    assert likeness(sketch(text.encode()), sketch(text.encode())) == 1.0
    one = text[:2000] + "!" + text[2001:]
    assert likeness(sketch(text.encode()), sketch(one.encode())) > 0.9
    assert likeness(sketch(b""), sketch(b"")) == 1.0 and likeness(sketch(b""), sketch(b"abc")) == 0.0
    assert sketch(b"short")[1].any()


def test_unrelated_long_texts_are_not_alike():
    rng = random.Random(6)
    one, other = rng.randbytes(4_000_000), rng.randbytes(4_000_000)
    assert likeness(sketch(one), sketch(other)) < 0.05
    assert likeness(sketch(one), sketch(one[:2_000_000] + b"!" + one[2_000_001:])) > 0.9
