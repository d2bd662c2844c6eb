"""Rules, classifiers and decontamination against brute force or held-out labels."""

import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyhouse.llm import ordinal_quality as O
from tallyhouse.llm import qgram_leaks as L
from tallyhouse.llm import quality_rules as Q
from tallyhouse.llm import toxicity_trees as T
from tallyhouse.llm.quality_sql import quality_sql
from tests.llm.helpers import ODD_TEXTS, SF, as_rows, documents, odd_documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF_MORE = "/root/testdata/sf0.01"

# ---------------------------------------------------------------- rules


def brute_base(text):
    t = text or ""
    w = WORD.findall(t)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    often = {x for x in windows if windows.count(x) > 1} if len(windows) < 3000 else {
        x for x, n in __import__("collections").Counter(windows).items() if n > 1
    }
    covered = {j for i, x in enumerate(windows) if x in often for j in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def test_base_counts_of_odd_rows(spark):
    texts = [*ODD_TEXTS, "a b c a b c a b c", "a a a a", "x y\nx y\n\n \nx y", "#a $b |c| <d>", "A b\x0bC\x0cd\re"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").selectExpr("*", "0 AS words_")
    got = as_rows(Q.base_metrics(df), "doc_id", *BASE)
    assert got == sorted(((i, *brute_base(t)) for i, t in enumerate(texts)), key=repr)


def test_op2_equals_sql_and_brute_force(spark):
    rows = Q.op2_quality_rules(spark, SF).collect()
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    res = con.sql(quality_sql())
    want = sorted(res.fetchall(), key=repr)
    assert sorted((tuple(r[c] for c in res.columns) for r in rows), key=repr) == want
    for r in rows:
        base = brute_base(dict(documents())[r["doc_id"]])
        assert tuple(r[c] for c in BASE) == base
        assert r["base_failed"] == (base[0] < 50 or 100 * base[4] > 50 * base[0])
        assert not (r["base_failed"] and r["kept"])


def test_sketches_merge_and_bound_quantiles(spark):
    rng = random.Random(4)
    values = [int(10 ** rng.uniform(0, 6)) for _ in range(2000)]
    df = spark.createDataFrame([(v,) for v in values], "value long").selectExpr("'r' AS rate", "value")
    whole = df.withColumn("bucket", Q.bucket("value")).groupBy("rate", "bucket").agg(F.count("*").alias("n"))
    halves = [df.where(f"value % 2 = {k}").withColumn("bucket", Q.bucket("value")).groupBy("rate", "bucket").agg(F.count("*").alias("n")) for k in (0, 1)]
    one, two = Q.quartiles(whole).first(), Q.quartiles(Q.merged(halves[0].union(halves[1]))).first()
    assert one == two
    s = sorted(values)
    for got, exact in ((one["q1"], s[499]), (one["q3"], s[1499])):
        assert exact * (1 - 2 ** (1 - Q.SKETCH_BITS)) <= got <= exact


def test_rules_keep_small_groups_and_odd_rows(spark):
    good = " ".join(f"word{i}" for i in range(80))
    rows = [(i, f"{good} {i}", "en", f"s{i % 3}") for i in range(90)]
    rows += [(200, good, None, None), (201, good.replace("0", "%%%%"), "en", "s0"), (None, None, "en", "s0"), (203, "", "xx", "rare")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").selectExpr("*", "1 AS kept", "2 AS limit_lang", "3 AS n_words")
    kept = {r["doc_id"]: r["kept"] for r in Q.quality_verdicts(df).collect()}
    assert all(kept[i] for i in range(90)) and kept[200]
    assert not kept[201] and not kept[203] and not kept[None]
    assert Q.quality_verdicts(df.limit(0)).count() == 0


def test_op2_uses_no_python(spark):
    plan = Q.judge(Q.with_rates(Q.base_metrics(odd_documents(spark).drop("n_tokens"))), Q.thresholds(Q.sketch(Q.with_rates(Q.base_metrics(odd_documents(spark))))))
    text = plan._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", text)


# ---------------------------------------------------------------- leaks


def least_edits(item, text):
    """Semi-global edit distance: the whole item against any part of the text."""
    row = [0] * (len(text) + 1)
    for j, c in enumerate(item, 1):
        new = [j]
        for k, d in enumerate(text, 1):
            new.append(min(row[k - 1] + (c != d), row[k] + 1, new[-1] + 1))
        row = new
    return min(row)


def edited(rng, s, n):
    s = list(s)
    for _ in range(n):
        p = rng.randrange(len(s))
        kind = rng.random()
        if kind < 0.34:
            s[p] = "z"
        elif kind < 0.67:
            s.insert(p, "q")
        else:
            del s[p]
    return "".join(s)


def test_matches_are_exactly_the_items_within_the_budget():
    rng = random.Random(9)
    word = lambda: "".join(rng.choice(["th", "er", "on", "an", "re", "ed", "nd"]) for _ in range(rng.randint(1, 4)))
    items = [" ".join(word() for _ in range(rng.randint(4, 14))) for _ in range(12)] + ["short one"]
    index = L.Items(list(range(len(items))), items)
    texts = []
    for k in range(60):
        inner = edited(rng, items[k % 12], rng.randint(0, 9)) if k % 3 else ""
        texts.append(" ".join(word() for _ in range(6)) + " " + inner + " " + " ".join(word() for _ in range(6)))
    texts += [items[0], items[12], "", "x"]
    got = {(r, i): e for r, i, _, _, e in index.matches(texts)}
    want = {}
    for r, t in enumerate(texts):
        for i, item in enumerate(items):
            e = least_edits(item, t)
            if e <= L.budget(len(item)) and (len(item) >= L.Q or item in t):
                want[r, i] = e
    assert got == want


def test_ruled_lines_and_small_slices_equal_brute_force(monkeypatch):
    items = ["_" * 30, "Name: " + "_" * 28, "a-" * 20, "-" * 14 + " end of the form", "no such thing in any text", "____"]
    texts = ["_" * n for n in (3, 12, 31, 200)]
    texts += ["fill in " + "_" * 400 + " Name: " + "_" * 26 + "x", "a-" * 300, "-" * 500 + " end of the fern", "Name: " + "_" * 500]
    want = {}
    for r, t in enumerate(texts):
        for i, item in enumerate(items):
            e = least_edits(item, t)
            if e <= L.budget(len(item)) and (len(item) >= L.Q or item in t):
                want[r, i] = e
    for pairs in (1, 50, 1 << 19):
        monkeypatch.setattr(L, "PAIRS", pairs)
        got = L.Items(list(range(len(items))), items).matches(texts)
        assert {(r, i): e for r, i, _, _, e in got} == want
        for r, i, start, end, e in got:  # the place named does hold the item
            assert 0 <= start <= end <= len(texts[r])
            near = texts[r][max(0, start - 4) : end + 4]
            assert least_edits(items[i], near) == e and (e or texts[r][start:end] == items[i])


def test_places_in_shortened_runs():
    text = "ab" + "x" * 1000 + "cd" + "y" * 60 + "x" * 500
    short, back = L.short_runs(text, 40)
    assert short == "ab" + "x" * 80 + "cd" + "y" * 60 + "x" * 80
    assert (back(0), back(2), short[back(2) :][:1], back(42), text[back(82) :][:4]) == (0, 2, "x", 42, "cdyy")
    assert back(len(short)) == len(text)
    assert L.short_runs("x" * 80, 40)[0] == "x" * 80 and L.short_runs("", 40)[0] == ""


def test_long_ruled_line_is_bounded():
    import time
    import tracemalloc

    items = L.Items(list(range(201)), ["_" * 28 + f" item {i} " for i in range(100)] + ["_" * (150 + i) for i in range(100)] + ["_" * 200])
    tracemalloc.start()
    begun = time.time()
    got = items.matches(["_" * 400_000])
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert {(r, i, e) for r, i, _, _, e in got} == {(0, i, 0) for i in range(100, 201)}
    assert peak < 500 << 20 and time.time() - begun < 60  # traced; about a third of that without


def test_banded_alignment_equals_the_whole_table():
    rng = random.Random(3)
    for _ in range(60):
        item = "".join(rng.choice("abc") for _ in range(rng.randint(5, 25)))
        place = rng.randint(0, 10)
        text = "x" * place + edited(rng, item, rng.randint(0, 4)) + "y" * rng.randint(0, 10)
        codes = [np.frombuffer(x.encode("utf-32-le"), np.uint32) for x in (item, text)]
        found, _ = L.banded_edits(*codes, -10 - len(item), 2 * len(item) + len(text) + 20, 6)
        assert found == min(least_edits(item, text), 7)


def test_op3_finds_every_verbatim_item(spark):
    bench = [(i, L.normal(t)) for i, t in duckdb.sql(f"SELECT item_id, text FROM read_parquet('{SF_MORE}/benchmark.parquet')").fetchall()]
    want = {(d, i) for d, t in documents(sf=SF_MORE) for n in [L.normal(t)] for i, x in bench if x in n}
    got = L.op3_qgram_leaks(spark, SF_MORE).collect()
    assert want <= {(r["doc_id"], r["item_id"]) for r in got}
    assert {(r["doc_id"], r["item_id"]) for r in got if r["edits"] == 0} == want
    texts, items = dict(documents(sf=SF_MORE)), dict(bench)
    for r in got:
        part = L.normal(texts[r["doc_id"]])[r["start"] : r["end"]]
        assert least_edits(items[r["item_id"]], part) <= r["edits"] + abs(len(part) - len(items[r["item_id"]]))


def test_leaks_odd_rows_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(L, "BLOCK_CHARS", 40)
    items = [(1, "The  quick brown fox\njumps over the lazy dog"), (2, None), (3, ""), (None, "never seen in any text at all"), (4, "tiny")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = odd_documents(spark).unionByName(
        spark.createDataFrame([(77, "so THE QUICK brown fox jumps over teh lazy dog."), (78, "a tiny bit")], "doc_id long, text string"), True
    )
    monkeypatch.setattr(L.item_blocks, "__defaults__", (40,))
    got = as_rows(L.find_leaks(df, bench), "doc_id", "item_id", "edits")
    assert got == [(77, 1, 2), (78, 4, 0)]
    kept = L.clean_documents(df, bench)
    assert kept.dtypes == df.dtypes and kept.count() == df.count() - 2
    assert L.find_leaks(df.limit(0), bench).count() == 0
    assert L.find_leaks(df, bench.limit(0)).count() == 0
    assert L.clean_documents(df, bench.limit(0)).count() == df.count()


# ---------------------------------------------------------------- ordinal regression


def labels(sf):
    return dict((r[0], r[1:]) for r in duckdb.sql(f"SELECT doc_id, quality, toxic FROM read_parquet('{sf}/labels.parquet')").fetchall())


def test_link_gradient_and_order():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(900, 6)).astype(np.float32)
    z = x @ np.array([2, -1, 0, 0, 1, 0]) + rng.logistic(size=900)
    grade = (z > -1).astype(int) + (z > 1.5).astype(int)
    m = O.fit_link(x, grade, 3)
    assert m.thresholds[0] < m.thresholds[1]
    assert np.allclose(m.thresholds, [-1, 1.5], atol=0.4)
    tails = m.tails(x)
    assert (tails[:, 0] >= tails[:, 1]).all()
    assert np.corrcoef(tails.sum(1), grade)[0, 1] > 0.7


def test_op4_on_held_out_ratings(spark):
    docs = T.read_input(spark, SF_MORE, "documents")
    ratings = O.graded(T.read_input(spark, SF_MORE, "labels")).where("doc_id % 4 <> 1")
    scored = {r["doc_id"]: r for r in O.score_documents(docs, O.fit(docs.select("doc_id", "text"), ratings)).collect()}
    out = [(scored[d]["expected_grade"], q, scored[d]["kept"]) for d, (q, _) in labels(SF_MORE).items() if d % 4 == 1]
    good, bad = [s for s, q, _ in out if q], [s for s, q, _ in out if not q]
    assert np.mean([[a > b for b in bad] for a in good]) > 0.97
    assert np.mean([k for _, q, k in out if q]) > 0.97 and np.mean([k for _, q, k in out if not q]) < 0.2


def test_ordinal_odd_rows(spark):
    df = odd_documents(spark)
    ratings = spark.createDataFrame([(i, i % 3) for i in range(20)], "doc_id long, grade int")
    out = O.score_documents(df, O.fit(df.select("doc_id", "text"), ratings)).collect()
    assert len(out) == df.count() and all(0 <= r["tail_2"] <= r["tail_1"] <= 1 for r in out)
    one = O.score_documents(df, O.fit(df.select("doc_id", "text"), ratings.where("grade = 2"))).collect()
    assert all(r["kept"] and r["expected_grade"] > 1.99 for r in one)
    none = O.fit(df.select("doc_id", "text"), ratings.limit(0))
    assert O.score_documents(df, none).count() == df.count()
    assert O.score_documents(df.limit(0), none).count() == 0
    got = as_rows(O.graded(spark.createDataFrame([(1, 0, 1), (1, 1, 1), (2, None, 1), (None, 1, 0), (3, 1, None)], "doc_id long, quality int, toxic int")), "doc_id", "grade")
    assert got == [(1, 1), (3, 2)]


# ---------------------------------------------------------------- toxicity


def held(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


def test_op9_on_held_out_labels(spark):
    rows = {r["doc_id"]: r for r in T.op9_toxicity_trees(spark, "/root/testdata/sf0.1").collect()}
    assert len(rows) == 10_000
    assert all(r["held_out"] == held(i) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for i, r in rows.items())
    out = [(rows[i]["score"], rows[i]["predicted"], t) for i, (_, t) in labels("/root/testdata/sf0.1").items() if held(i)]
    toxic, clean = [s for s, _, t in out if t], [s for s, _, t in out if not t]
    assert np.mean([[a > b for b in clean] for a in toxic]) > 0.98
    assert np.mean([p for _, p, t in out if t]) > 0.9 and np.mean([p for _, p, t in out if not t]) < 0.02


def test_toxicity_never_learns_from_held_out_rows(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(300)] + [(None, "none")], "doc_id long, text string")
    marks = spark.createDataFrame([(i, i % 2) for i in range(300)] + [(7, 1), (8, None), (None, 1)], "doc_id long, toxic int")
    got = {r["doc_id"]: r["label"] for r in T.training_rows(docs, marks).collect()}
    assert got == {i: float(i % 2 or i == 7) for i in range(300) if not held(i)}
    assert 0 < T.training_rows(docs, marks, 50).count() < 120


def test_toxicity_odd_rows(spark):
    df = odd_documents(spark).selectExpr("*", "1 AS weak", "2 AS label", "3 AS c0")
    no_labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = T.fit(df, no_labels)
    assert {r["score"] for r in T.score_documents(df, model).collect()} == {0.0}
    marks = spark.createDataFrame([(i, int(i % 2 == 0)) for i in range(24)], "doc_id long, toxic int")
    model = T.fit(df, marks)
    out = T.score_documents(df, model).collect()
    assert len(out) == df.count() and all(0 <= r["score"] <= 1 for r in out)
    kept = T.reject_toxic(df, model)
    assert kept.dtypes == df.dtypes
    assert kept.count() == sum(r["predicted"] == 0 for r in out)
    assert T.score_documents(df.limit(0), model).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=200))
def test_features_of_any_text(text):
    f = T.features_of(text, T.WordFlags({"bad": 50.0}))
    assert len(f) == len(T.FEATURES) and all(np.isfinite(f))


def test_words_written_to_hide():
    flags = T.WordFlags({"idio": 100.0, "moron$": 100.0})
    for w in ("Idiot", "1diot!", "id1ot", "i*d*i*o*t", "MORON###", "(moron)"):
        assert flags[w] & T.STRONG_BIT, w
    for w in ("morons", "radio", "it's", "well-known"):
        assert not flags[w] & T.STRONG_BIT, w


@pytest.mark.parametrize("text,near", [("you are an idiot", 1), ("idiot " + "x " * 9 + "you", 0)])
def test_second_person_nearby(text, near):
    f = dict(zip(T.FEATURES, T.features_of(text, T.WordFlags({"idio": 100.0}))))
    assert (f["near_you"] > 0) == bool(near)
