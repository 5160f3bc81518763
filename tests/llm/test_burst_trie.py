"""Prefix trie against plain Python."""

import hashlib
import random
import zlib

import pytest

from vesseltrack.llm import burst_trie as B

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    """(conv_id, turn, role, text) rows without equal turn numbers in a conversation to the set of node rows."""
    own = {}
    for c, t, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0)):
        own.setdefault(c, []).append((role or "", text or ""))
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(own.get(c - c % 5, [])[:h] + turns[h:])
    members = {}
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
    children = {p: [q for q in members if len(q) == len(p) + 1 and q[:len(p)] == p] for p in members}
    out = set()
    for p, m in members.items():
        below = [q for q in members if q[:len(p)] == p]
        ends = ",".join(str(c) for c in sorted(m) if len(built[c]) == len(p))
        out.add((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), sum(not children[q] for q in below),
                 sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in below if q), hashlib.sha256(ends.encode()).hexdigest()))
    return out


def result(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def conversations(seed, n=60):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        if c % 13 == 12:
            continue
        for t in range(rng.choice((0, 1, 2, 3, 9, 14)) if c % 5 else rng.choice((1, 6, 10))):
            rows.append((c, t if t else rng.choice((None, 0)), rng.choice(("user", "assistant", None)), rng.choice(("", None, "Hi", "é漢", "a,b"))))
    return rows


@pytest.mark.parametrize("most", [B.CONTAINER_SEQUENCES, 7, 1])
def test_equal_to_plain_python(spark, most):
    rows = conversations(most)
    rows += [(1000 + c, t, "user", f"same {t}") for c in range(40) for t in range(3)] + [(None, 1, "user", "nobody")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'own' as key", "'own' as seq", "1 as depth")
    assert result(B.prefix_trie(df, most)) == plain(rows)


def test_bursting_makes_heads_until_containers_fit(spark):
    rows = [(c * 5, t, "user", "start" if t < 2 else f"{c}") for c in range(200) for t in range(10)]
    convs = B.conversations(spark.createDataFrame(rows, SCHEMA))
    contained, ending = B.burst(B.distinct_sequences(B.rebuild(convs)), 50)
    assert len(ending) == 3  # the root, the first turn and the second
    assert {r.depth for r in contained.collect()} == {3}
    assert result(B.prefix_trie(spark.createDataFrame(rows, SCHEMA), 50)) == plain(rows)


def test_long_conversation_and_repeated_rows(spark):
    rows = [(5, t, "user", f"t{t}") for t in range(3000)] + [(6, 1, "user", "x")]
    again = [(7, 3, "user", "twice")] * 12  # equal rows are turns of their own
    got = result(B.prefix_trie(spark.createDataFrame(rows, SCHEMA)))
    assert {r[:6] for r in got if r[1] > 100} == {(5, d, 5, 1, int(d < 3000), 1) for d in range(101, 3001)}
    h = zlib.crc32(b"7") % 9
    assert max(r[1] for r in result(B.prefix_trie(spark.createDataFrame(again, SCHEMA)))) == 12 - h


def test_role_and_text_are_told_apart(spark):
    rows = [(5, 0, "ab", "c"), (10, 0, "a", "bc"), (15, 0, None, "abc"), (20, 0, "", "abc")]
    rows = [(c, t + i, r, x) for c, t, r, x in rows for i in range(9)]  # more turns than any h
    assert result(B.prefix_trie(spark.createDataFrame(rows, SCHEMA))) == plain(rows)


def test_turnless_conversations_end_at_the_root(spark):
    rows = [(c, 0, "user", "only") for c in range(1, 40) if c % 5]
    got = result(B.prefix_trie(spark.createDataFrame(rows, SCHEMA)))
    assert got == plain(rows)
    assert [r for r in got if r[1] == 0][0][7] != B.NO_ENDS


def test_empty(spark):
    assert B.prefix_trie(spark.createDataFrame([], SCHEMA)).collect() == []
