import random

import pytest

from cataloom.llm import quotes
from cataloom.llm.queries import op7_quotations

SCHEMA = "conv_id long, turn long, role string, text string, rid int, hash string, level int"


@pytest.fixture
def chat(spark):
    return lambda rows: spark.createDataFrame([(*r, 1, "h", 2) for r in rows], SCHEMA)


def linked(df):
    return {(r["conv_id"], r["turn"]): r for r in quotes.link_quotes(df).collect()}


def walk(rows):
    """Turns of one conversation in tree order, replies by turn."""
    below = {}
    for r in rows:
        below.setdefault(r["reply_to"], []).append(r["turn"])
    out, stack = [], sorted(set(below.get(None, [])), reverse=True)
    while stack:
        t = stack.pop()
        out.append(t)
        stack += sorted(set(below.get(t, [])), reverse=True)
    return out


def test_nested_quotes(chat):
    got = linked(chat([
        (1, 0, "user", "How do I sort?"),
        (1, 1, "assistant", "Use sorted().\n\nIt copies."),
        (1, 2, "user", "> How do  I SORT?\nI meant in place."),
        (1, 3, "assistant", "> > How do I sort?\n> I meant in place.\nThen list.sort()."),
        (1, 4, "user", "> nobody said this\nok"),
        (1, 5, "user", "> Use sorted().\n> \n> It copies.\nthanks"),
        (2, 0, "user", "> How do I sort?"),
    ]))
    assert [got[1, t]["reply_to"] for t in range(6)] == [None, 0, 0, 2, 3, 1]
    assert [got[1, t]["thread"] for t in range(6)] == [0, 0, 2, 2, 2, 5]
    assert [got[1, t]["depth"] for t in range(6)] == [0, 1, 1, 2, 3, 2]
    assert sorted(range(6), key=lambda t: got[1, t]["reply_order"]) == [0, 1, 5, 2, 3, 4] == walk([got[1, t] for t in range(6)])
    assert got[1, 3]["text"] == "Then list.sort()." and (got[1, 3]["n_quotes"], got[1, 3]["n_linked"]) == (2, 2)
    assert (got[1, 4]["n_quotes"], got[1, 4]["n_linked"]) == (1, 0)
    assert got[2, 0]["reply_to"] is None and got[2, 0]["text"] == ""


def test_query_table(spark, sf):
    rows = op7_quotations(spark, sf).collect()
    given = {(r["conv_id"], r["turn"]): r["text"] for r in spark.read.parquet(f"{sf}/conversations.parquet").collect()}
    assert [(r["conv_id"], r["turn"]) for r in rows] == sorted(given)  # no quotes: conversations in turn order
    for r in rows:
        assert r["text"] == given[r["conv_id"], r["turn"]].strip() and r["n_quotes"] == 0 and r["depth"] == r["turn"]


def test_edge_cases(chat):
    rows = [(1, 0, None, None), (1, 0, None, None), (1, 1, "user", ""), (None, 0, "user", "x"), (1, None, "user", "x"), (1, 5, "user", ">>> \n>\n\n> x"), (1, 3000, "a", "hi"), (1, 3001, "b", "> hi"), (3, 7, "a", "z" * 50_000)]
    out = quotes.link_quotes(chat(rows)).collect()
    assert [(r["conv_id"], r["turn"]) for r in out] == [(1, 0), (1, 0), (1, 1), (1, 5), (1, 3000), (1, 3001), (3, 7)]
    assert [r["reply_to"] for r in out if r["turn"] == 3001] == [3000]
    assert quotes.link_quotes(chat([])).collect() == []


def test_random_replies_against_a_tree_walk(chat):
    rng = random.Random(8)
    rows = []
    for c in range(6):
        for t in range(3000 if c == 0 else 60):
            back = rng.choice([None, None, rng.randrange(t), max(0, t - 2)]) if t else None
            rows.append((c, t, "user", (f"> message {c} {back}\n" if back is not None else "") + f"message {c} {t}"))
    out = quotes.link_quotes(chat(rows)).collect()
    texts = {(c, t): x for c, t, _, x in rows}
    for c in range(6):
        own = [r for r in out if r["conv_id"] == c]
        depth = {}
        for r in sorted(own, key=lambda r: r["turn"]):
            first = texts[c, r["turn"]].split("\n")[0]
            want = int(first.split()[-1]) if first.startswith(">") else (r["turn"] - 1 if r["turn"] else None)
            assert r["reply_to"] == want
            depth[r["turn"]] = 0 if want is None else depth[want] + 1
            assert r["depth"] == depth[r["turn"]]
        assert [r["turn"] for r in own] == walk(own)


def test_quotes_of_parts(chat):
    long = "Use sorted().\nIt copies\nthe list.\n\nOr call list.sort(),\nwhich does not.\n\nBoth are stable."
    got = linked(chat([
        (1, 0, "user", "How do I sort?\nThanks"),
        (1, 1, "assistant", long),
        (1, 2, "user", "Thanks"),
        (1, 3, "user", "> It copies\nWhy?"),
        (1, 4, "user", "> Both are stable.\nGood.\n\n> Use sorted().\n> It copies\n> the list.\nNot good."),
        (1, 5, "user", "> Or call list.sort(), which\n> does not.\n\n> Both are stable.\nyes"),
        (1, 6, "user", "> > It copies\n> Why?\nSo that yours stays."),
        (1, 7, "user", "> Use sorted().\r\n> It copies\r\n> the list.\r\n\r\n> Or call list.sort(),\r\n> which does not.\r\n\r\n> Both are stable.\r\nall"),
        (1, 8, "user", "> it cop\nhalf a line"),
        (1, 9, "user", "> How do I sort?\n>\n> So that yours stays.\nof two messages"),
        (2, 0, "user", "Thanks\nyes"),
        (2, 1, "user", "Bye\nno"),
        (2, 2, "user", "well\nThanks\nBye\nend"),
        (2, 3, "user", "Bye\nThanks\nagain"),
        (2, 4, "user", "ok"),
        (2, 5, "user", "> Thanks\n> Bye\nthe first that has both"),
    ]))
    assert [got[1, t]["reply_to"] for t in range(10)] == [None, 0, 1, 1, 1, 1, 3, 1, 7, 6]
    assert (got[1, 4]["n_quotes"], got[1, 4]["n_linked"], got[1, 4]["text"]) == (2, 2, "Good.\n\nNot good.")
    assert [(got[1, t]["n_quotes"], got[1, t]["n_linked"]) for t in (5, 7, 8, 9)] == [(1, 1), (1, 1), (1, 0), (1, 1)]
    assert got[2, 5]["reply_to"] == 2
    assert [got[1, t]["thread"] for t in range(10)] == [0, 0, 0, 3, 4, 5, 6, 7, 7, 9]


def test_long_conversation_that_always_quotes_two_back(spark, chat):
    """Every turn starts a chain: one number and one depth per message, in few rounds."""
    n = 3000
    rows = [(1, t, "user", f"message number {t}" if t < 2 else f"> message number {t - 2}\nmessage number {t}") for t in range(n)]
    got = {r["turn"]: r for r in quotes.link_quotes(chat(rows)).collect()}
    assert [got[t]["reply_to"] for t in range(4)] == [None, 0, 0, 1]
    order = sorted(range(n), key=lambda t: got[t]["reply_order"])
    assert [got[t]["reply_order"] for t in order] == list(range(n))
    assert order == walk([got[t] for t in range(n)])
    for t in range(n):
        up = got[t]["reply_to"]
        assert got[t]["depth"] == (0 if up is None else got[up]["depth"] + 1)
