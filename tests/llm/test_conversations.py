"""Prefix trie of conversations: against a trie built in memory, odd tables, long conversations."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from ridepulse.llm import catalog, conversations
from ridepulse.llm.common import ready
from tests.conftest import SF_SMALL

SCHEMA = "conv_id long, turn long, role string, text string, pos string, id string, words long, depth long, block int"


def turn_id(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]


def rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", turn_id(role or "", text or ""), text or ""))
    own = {c: [(r, t) for _, _, r, _, t in sorted(x)] for c, x in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = abs(c) - abs(c) % 20
        out[c] = own.get(base if c >= 0 else -base, [])[:h] + turns[h:]
    return out


def brute(rows):
    convs = rebuilt(rows)
    members = defaultdict(list)
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            members[tuple(convs[c][:d])].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids[p]) or 1
        words = len(p[-1][1].encode().split()) if p else 0
        saved[p] = (len(members[p]) - 1) * words + sum(saved[k] for k in kids[p])
    return {
        (
            m[0], len(p), members[p[:-1]][0] if p else None, len(m), len(kids[p]), leaves[p], saved[p],
            hashlib.sha256(",".join(str(c) for c in m if len(convs[c]) == len(p)).encode()).hexdigest(),
        )
        for p, m in members.items()
    }


def trie(spark, rows):
    ready(spark)
    df = spark.createDataFrame([(*r, "x", "x", -1, -1, 7) for r in rows], SCHEMA)
    turns = conversations.share_openings(conversations.number_turns(df), 20, 3)
    return result(conversations.prefix_trie(turns))


def result(df):
    assert ", ".join(f"{f.name} {f.dataType.simpleString().replace('bigint', 'long')}" for f in df.schema) == conversations.TRIE_SCHEMA
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_query_equals_trie_in_memory(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").collect()]
    assert result(catalog.op12_conversation_trie(spark, SF_SMALL)) == brute(rows)


@pytest.mark.parametrize("seed", range(3))
def test_random_tables(spark, monkeypatch, seed):
    """Few distinct turns, so that prefixes are shared deep into further blocks; ties, nulls, repeated rows, negative ids."""
    monkeypatch.setattr(conversations, "FIRST_BLOCK", 2)
    monkeypatch.setattr(conversations, "NEXT_BLOCK", 3)
    monkeypatch.setattr(conversations, "_JOINED", 2)
    rnd = random.Random(seed)
    rows = []
    for c in rnd.sample([*range(-45, 60), 10**12, 10**12 + 1], 60):
        for _ in range(rnd.choice([1, 1, 2, 4, 9, 14])):
            rows.append((c, rnd.choice([None, *range(6)]), rnd.choice(["a", "a", None]), rnd.choice(["x", "x", "x", "y z", None])))
    rows += [(None, 1, "a", "x"), rows[0], rows[0]]
    rnd.shuffle(rows)
    assert trie(spark, rows) == brute(rows)


def test_small_tables(spark):
    assert trie(spark, []) == set() == trie(spark, [(None, 0, "a", "b")])
    c = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 == 3)
    for rows in ([(0, None, None, None)], [(c, 0, "a", "b")], [(c, 0, "a", "b"), (c + 20, 0, "a", "b"), (c + 40, 5, "", "")]):
        assert trie(spark, rows) == brute(rows)


def test_copies_and_long_conversations(spark):
    """Many copies of one conversation, two long ones that part late, one long one alone, one very long text."""
    rows = [(20 * c, t, "u", f"t{t}") for c in range(300) for t in range(3)]
    rows += [(20 * c, t, "u", f"w{t} w") for c in (1001, 1002) for t in range(60)] + [(20 * 1002, 60, "u", "end")]
    rows += [(20 * 2000, t, "u", str(t)) for t in range(200)] + [(20 * 3000, 0, "u", "long " * 300_000)]
    assert trie(spark, rows) == brute(rows)


def test_a_conversation_over_many_tasks(spark):
    """Places are counted on from task to task."""
    ready(spark)
    rows = [(c, t, "u", "x") for c, n in ((1, 5), (7, 4000), (8, 1), (9, 3)) for t in range(n)]
    random.Random(1).shuffle(rows)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = conversations.number_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
        got = sorted((r.conv_id, r.pos) for r in placed.collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == sorted((c, t + 1) for c, t, _, _ in rows)
