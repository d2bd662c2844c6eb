"""The conversation trie against a plain restatement over dictionaries."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyhouse.llm import conversation_trie as T
from tests.llm.helpers import SF

FIELDS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def brute_force(rows):
    """rows: (conv_id, turn, role, text)."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[: T.WIDTH]
            own[c].append((turn is not None, turn or 0, role, key, len(text), text))
    seqs = {}
    for c, turns in own.items():
        turns.sort()
        h = zlib.crc32(str(c).encode()) % 6
        base = own.get(c - int(np.fmod(c, 100)), [])
        seqs[c] = tuple((t[2], t[5]) for t in sorted(base)[:h] + turns[h:])
    members = defaultdict(list)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    children = defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += (len(m) - 1) * (len(p[-1][1]) if p else 0)
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in m if len(seqs[c]) == len(p)))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def as_tuples(df):
    return sorted((tuple(r[f] for f in FIELDS) for r in df.collect()), key=repr)


def frame(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return df.selectExpr("*", "1 AS part", "'x' AS path", "2 AS depth", "'y' AS node")


def test_query_equals_brute_force(spark):
    rows = duckdb.sql(f"SELECT conv_id, turn, role, text FROM read_parquet('{SF}/conversations.parquet')").fetchall()
    assert as_tuples(T.op13_conversation_trie(spark, SF)) == brute_force(rows)


@pytest.mark.parametrize("part_bytes", [1, 400, 3000, 1 << 24])
def test_shared_prefixes_over_many_parts(spark, part_bytes, monkeypatch):
    monkeypatch.setattr(T, "ID_RUN", 7)
    r = random.Random(part_bytes)
    texts = ["", "a", "bb", "日本語", "long " * 50, None]
    rows = []
    for c in [*range(0, 130), *range(400, 460), -5, -100, -130]:
        for k in range(r.choice([1, 2, 3, 4, 5, 7])):
            rows.append((c, r.choice([k, k, None]) if c % 7 == 0 else k, r.choice(["user", None, "system"]) if k > 1 else "user", r.choice(texts[:3]) if k < 3 else r.choice(texts)))
    rows += [(1000 + c, 0, "user", "same first turn") for c in range(200)]  # copies, all alike
    rows += [(1300 + c, k, "user", f"deep {k}") for c in range(3) for k in range(60)]
    rows += [(None, 1, "user", "nobody's"), (7, None, None, None), (7, 3, "user", "again"), (7, 3, "user", "again")]
    assert as_tuples(T.conversation_trie(frame(spark, rows).repartition(3), part_bytes)) == brute_force(rows)


def test_no_conversations(spark):
    assert T.conversation_trie(frame(spark, [])).collect() == []
    assert T.conversation_trie(frame(spark, [(None, None, None, None)])).collect() == []


def test_turnless_conversation_belongs_to_the_root(spark):
    c = next(c for c in range(501, 600) if zlib.crc32(str(c).encode()) % 6)  # no conversation 500, one turn of its own
    assert as_tuples(T.conversation_trie(frame(spark, [(c, 0, "user", "x")]))) == brute_force([(c, 0, "user", "x")])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("abc", max_size=5), min_size=1, max_size=25, unique=True), st.data())
def test_extents_equal_a_scan(words, data):
    words = sorted(words)
    paths = [w.encode().replace(b"a", b"a" * T.WIDTH).replace(b"b", b"b" * T.WIDTH).replace(b"c", b"c" * T.WIDTH) for w in words]
    lcp = np.array([0] + [T.common_turns(x, y) for x, y in zip(paths, paths[1:])], np.int64)
    pairs = [(i, d) for i, w in enumerate(words) for d in range(len(w) + 1)]
    row, depth = (np.array(x, np.int64) for x in zip(*pairs))
    left, right = T.extents(T.sparse_table(lcp), row, depth)
    for (i, d), l, r in zip(pairs, left, right):
        same = [j for j, w in enumerate(words) if w[:d] == words[i][:d] and len(w) >= d]
        assert (l, r) == (same[0], same[-1])
    values = np.array(data.draw(st.lists(st.integers(0, 9), min_size=len(words), max_size=len(words))), np.int64)
    assert T.range_min(T.sparse_table(values), left, right).tolist() == [values[a : b + 1].min() for a, b in zip(left, right)]
