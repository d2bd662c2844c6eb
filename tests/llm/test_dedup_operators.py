"""Sharding and dedup operators against brute force on small inputs."""

import hashlib
import os
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyhouse import session
from tallyhouse.llm import components as K
from tallyhouse.llm import histogram_shards as G
from tallyhouse.llm import repeated_windows as R
from tallyhouse.llm import simhash_blocks as B
from tests.llm.helpers import SF, as_rows, documents, odd_documents


def least_of_components(nodes, edges):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


# ---------------------------------------------------------------- components


def test_components_of_random_graphs_and_chains(spark):
    rng = random.Random(5)
    chain = [(i, i + 1) for i in range(100, 160)]
    rest = [(rng.randint(200, 420), rng.randint(200, 420)) for _ in range(150)]
    star = [(1000, 1000 + i) for i in range(60)]
    edges = chain + rest + star + [(7, 7)]
    nodes = {x for e in edges for x in e}
    want = {n: r for n, r in least_of_components(nodes, edges).items() if n != r}
    got = K.connected_components(spark.createDataFrame(edges, "a long, b long"))
    assert {r["node"]: r["root"] for r in got.collect()} == want
    assert K.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---------------------------------------------------------------- SimHash


def brute_fingerprint(text, shingle=4):
    words = [w for w in (text or "").encode().lower().split()]
    if not words:
        return 0
    parts = [b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(rows, bits=4):
    fps = [(i, brute_fingerprint(t)) for i, t in rows]
    edges = [(a, b) for a, (_, x) in enumerate(fps) for b, (_, y) in enumerate(fps[:a]) if (x ^ y).bit_count() <= bits]
    root = least_of_components(range(len(rows)), edges)
    least = {}
    for n, r in root.items():
        i = fps[n][0]
        least[r] = min(least.get(r, (True, 0)), (i is None, i or 0))
    return [(i, f"{fp:016x}", None if least[root[n]][0] else least[root[n]][1]) for n, (i, fp) in enumerate(fps)]


def test_spark_hash_is_the_contract_hash(spark):
    got = spark.sql("SELECT hex(xxhash64('a b c d'))").first()[0]
    assert int(got, 16) == xxhash.xxh64_intdigest(b"a b c d", 42)


def test_op8_equals_all_pairs(spark):
    got = as_rows(B.op8_simhash_blocks(spark, SF), "doc_id", "fingerprint", "component_id")
    assert got == sorted(brute_groups(documents()), key=repr)


@pytest.mark.parametrize("bucket", [1, 3, 1000])
def test_simhash_of_near_copies_with_and_without_hot_buckets(spark, bucket):
    rng = random.Random(bucket)
    base = [f"w{rng.randint(0, 999)}" for _ in range(120)]
    rows = [(None, "  "), (900, None)]
    for i in range(60):
        words = list(base)
        for _ in range(rng.randint(0, 4)):
            words[rng.randint(0, 119)] = f"x{rng.randint(0, 99)}"
        rows.append((1000 - i, " ".join(words)))
    rows += [(5, "unlike"), (6, "unlike"), (None, "no id"), (None, "no id")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumnRenamed("doc_id", "Id").selectExpr("*", "1 AS fp", "2 AS chosen_id", "3 AS component_id")
    got = B.near_duplicates(df, id_col="Id", bucket=bucket)
    assert as_rows(got, "doc_id", "fingerprint", "component_id") == sorted(brute_groups(rows), key=repr)
    kept = B.one_of_each(df, id_col="Id", bucket=bucket)
    assert kept.columns == df.columns
    groups = len({(c if c is not None else f) for _, f, c in brute_groups(rows)})
    assert kept.count() == groups


def test_simhash_odd_rows(spark):
    df = odd_documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    got = as_rows(B.near_duplicates(df), "doc_id", "fingerprint", "component_id")
    assert got == sorted(brute_groups(rows), key=repr)
    assert B.near_duplicates(df.limit(0)).count() == 0


def test_masks_lose_no_pair():
    rng = random.Random(1)
    for n in (1, 10**5, 10**7, 10**10):
        masks = B.block_masks(n)
        for _ in range(200):
            x = sum(1 << b for b in rng.sample(range(64), 4))
            assert any(x & (m % (1 << 64)) == 0 for m in masks)
    assert len(B.near_values()) == 2081


# ---------------------------------------------------------------- substring dedup


def brute_windows(rows, width=13):
    split = [(i, (t or "").encode().split()) for i, t in rows]
    least, big = {}, float("inf")
    for i, w in split:
        for k in range(len(w) - width + 1):
            key = tuple(w[k : k + width])
            least[key] = min(least.get(key, big), big if i is None else i)
    out = []
    for i, w in split:
        gone = [False] * len(w)
        for k in range(len(w) - width + 1):
            if least[tuple(w[k : k + width])] < (big if i is None else i):
                gone[k : k + width] = [True] * width
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def test_op5_equals_brute_force(spark):
    got = as_rows(R.op5_repeated_windows(spark, SF), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == sorted(brute_windows(documents()), key=repr)


def test_windows_in_small_chunks_and_ranges(spark, monkeypatch):
    monkeypatch.setattr(R, "CHUNK_BYTES", 400)
    monkeypatch.setattr(R, "RANGE_ENTRIES", 50)
    rng = random.Random(2)
    rows = [(i if i % 7 else None, " ".join(rng.choice("ab") for _ in range(rng.randint(0, 40)))) for i in range(60)]
    rows += [rows[3], (5, rows[20][1]), (999, None), (998, ""), (997, " \n ")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("text", "doc_id", "1 AS chunk", "'r' AS rows")
    got = R.remove_repeats(df, width=5, digest=True)
    assert as_rows(got, "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(brute_windows(rows, 5), key=repr)
    out = R.remove_repeats(df, width=5)
    assert out.columns == df.columns
    want = {(i, sha) for i, _, _, sha in brute_windows(rows, 5)}
    assert {(r["doc_id"], hashlib.sha256(" ".join(r["text"].split()).encode()).hexdigest()) for r in out.collect()} == want


def complemented(k):
    """A word of 2 ** k letters, each half the complement of the one before: the pair agrees in polynomial hashes."""
    word = "a"
    for _ in range(k):
        word += word.translate({97: "b", 98: "a"})
    return word, word.translate({97: "b", 98: "a"})


def test_words_that_agree_in_polynomial_hashes_stay(spark):
    x, y = complemented(10)
    tail = " ".join(f"w{i}" for i in range(12))
    rows = [(1, f"{x} {tail}"), (2, f"{y} {tail}"), (3, f"{y}  {tail}\nmore")]
    got = R.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), digest=True)
    assert as_rows(got, "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(brute_windows(rows), key=repr)
    assert {r.doc_id: r.n_removed for r in got.collect()} == {1: 0, 2: 0, 3: 13}


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from([w for k in (0, 1, 5, 10, 11) for w in complemented(k)]), min_size=3, max_size=40))
def test_window_digests_tell_words_apart(words):
    texts = R.Texts(pa.array(["  ".join(words)]), 3)
    at = texts.window_starts()
    h, g = texts.window_digests(at)
    shown = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    assert len(set(zip(h.tolist(), g.tolist()))) == len(set(shown))
    assert all((h[i] == h[j]) == (shown[i] == shown[j]) for i in range(len(shown)) for j in range(i))


def test_op5_sql_equals_brute_force():
    import duckdb

    from tallyhouse.llm.repeats_sql import repeats_sql

    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    rows = con.sql(repeats_sql()).project("doc_id, n_words, n_removed, kept_sha256").fetchall()
    assert sorted(rows, key=repr) == sorted(brute_windows(documents()), key=repr)


def test_windows_odd_rows(spark):
    df = odd_documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    got = R.remove_repeats(df, digest=True)
    assert as_rows(got, "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(brute_windows(rows), key=repr)
    assert R.remove_repeats(df.limit(0), digest=True).count() == 0
    whole = R.remove_repeats(df)
    assert whole.schema == df.schema and whole.count() == df.count()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**40), max_size=300).map(sorted))
def test_sketch_coding_round_trip(values):
    a = np.array(values, np.uint64)
    if len(a):
        assert (R._decode(R._encode(a)) == a).all()


# ---------------------------------------------------------------- sharding


def check_shards(rows, n_shards, slack):
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r)
    assert set(by) <= set(range(n_shards))
    for part in by.values():
        assert sorted(r["slot"] for r in part) == list(range(len(part)))
    total = sum(r["size"] for r in rows)
    for s in range(n_shards):
        assert abs(sum(r["size"] for r in by.get(s, [])) - total / n_shards) <= slack


def test_op1_sizes_and_slots(spark):
    rows = G.op1_histogram_shards(spark, SF).collect()
    texts = dict(documents())
    assert len(rows) == len(texts)
    for r in rows:
        raw = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
    check_shards(rows, 16, max(r["size"] for r in rows) + 0.005 * sum(r["size"] for r in rows) / 16)


def test_shards_cut_a_group_that_holds_a_third_of_the_rows(spark):
    rows = [(i, "same text " * 3) for i in range(700)] + [(i, None) for i in range(700, 900)]
    rows += [(i, f"own text {i}") for i in range(900, 2000)] + [(None, "no id"), (None, "no id")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "length(text) AS sort_hash", "1 AS shard")
    out = G.shard_rows(df, shards=8)
    assert out.columns == [*df.columns, "_shard", "slot"]
    rows = [{"size": len((r["text"] or "").encode()) + 1, "shard": r["_shard"], "slot": r["slot"], "text": r["text"]} for r in out.collect()]
    assert len(rows) == 2002
    check_shards(rows, 8, 200)
    own = {}
    for r in rows:
        own.setdefault(r["text"], set()).add(r["shard"])
    assert sum(len(s) > 1 for s in own.values()) <= 7


def test_shards_odd_rows(spark):
    df = odd_documents(spark)
    rows = G.shard_rows(df, shards=3).collect()
    assert len(rows) == df.count()
    assert G.shard_rows(df.limit(0)).count() == 0


def test_shards_order_and_parts_of_cells(spark):
    rows = [(i, f"text {i % 90}") for i in range(600)] + [(i * i * 10**9, "hot") for i in range(600, 1000)] + [(-5, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    few = G.shard_rows(df, shards=4, cells_per_shard=2)
    cut = G.shard_rows(df, shards=4, cells_per_shard=2, part_bytes=200)
    columns = ("doc_id", "text", "shard", "slot")
    assert as_rows(few, *columns) == as_rows(cut, *columns)
    keyed = cut.selectExpr("xxhash64(text) AS h", "doc_id", "shard", "slot").collect()
    want = sorted(keyed, key=lambda r: (r["h"], r["doc_id"]))
    assert sorted(keyed, key=lambda r: (r["shard"], r["slot"])) == want
    for shard in range(4):
        slots = sorted(r["slot"] for r in keyed if r["shard"] == shard)
        assert slots == list(range(len(slots)))


def test_intermediate_tables_go_with_their_scratch_block(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(folder))
    with session.scratch(spark):
        sharded = G.op1_histogram_shards(spark, SF)
        linked = B.op8_simhash_blocks(spark, SF)
        assert sharded.count() == linked.count() == len(documents())
        assert set(os.listdir(folder)) > before
    assert set(os.listdir(folder)) == before
