"""Language identification: held-out accuracy, votes against a plain count, odd rows."""

import zlib
from itertools import combinations

import duckdb
import numpy as np

from tallyhouse.llm import language_families as L
from tests.llm.helpers import SF, odd_documents


def test_held_out_accuracy(spark):
    rows = {r.doc_id: r for r in L.op11_language_families(spark, SF).collect()}
    truth = duckdb.sql(f"SELECT doc_id, lang, text FROM read_parquet('{SF}/documents.parquet')").fetchall()
    assert len(rows) == len(truth)
    known = {g for _, g, _ in truth if g}
    hits, n = 0, 0
    for i, lang, text in truth:
        assert rows[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= rows[i].score <= 1
        assert rows[i].lang_pred in known or (rows[i].lang_pred, rows[i].score) == ("und", 0.0)
        if rows[i].held_out and lang and text and any(c.isalpha() for c in text):
            hits, n = hits + (rows[i].lang_pred == lang), n + 1
    assert n > 20 and hits / n > 0.97


def test_odd_rows(spark):
    docs = odd_documents(spark)
    got = L.identify_languages(docs).collect()
    want = docs.collect()
    assert sorted((r.doc_id, r.held_out) for r in got if r.doc_id is not None) == sorted(
        (r.doc_id, zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in want if r.doc_id is not None
    )
    letters = [r.text is not None and any(c.isalpha() for c in r.text) for r in want]
    assert sum(r.lang_pred == "en" and r.score == 1.0 for r in got) == sum(letters)  # one language: no rival
    assert sum(r.lang_pred == "und" and r.score == 0.0 for r in got) == len(letters) - sum(letters)
    assert L.identify_languages(docs.where("false")).collect() == []
    nothing = docs.selectExpr("doc_id", "text", "cast(null as string) AS lang")
    assert {(r.lang_pred, r.score) for r in L.identify_languages(nothing).collect()} == {("und", 0.0)}


def test_unlisted_languages_are_families_of_their_own(spark):
    words = {"xx": "zzq qzz ", "yy": "kkw wkk ", "en": "the and of ", "de": "der und die ", "nl": "het een van "}
    rows = [(i, words[g] * (1 + i % 5), g) for i, g in enumerate(list(words) * 40)]
    got = L.identify_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert {(r.doc_id, r.lang_pred) for r in got.collect()} == {(i, g) for i, _, g in rows}
    assert L.family_of("xx") == "xx" and L.family_of("en") == L.family_of("nl") == "germanic"


def test_duels_equal_a_plain_count():
    r = np.random.default_rng(1)
    classes = ["a", "b", "c", "d"]
    duels = L.Duels(classes, r.normal(size=(6, 5)), r.normal(size=6))
    x = r.normal(size=(300, 5))
    won, sure = duels.decide(x)
    for row, w, s in zip(x, won, sure):
        m = dict(zip(combinations(range(4), 2), row @ duels.weights.T + duels.offsets))
        own = {c: [v if p[0] == c else -v for p, v in m.items() if c in p] for c in range(4)}
        votes = {c: sum((v >= 0) if p[0] == c else (v < 0) for p, v in m.items() if c in p) for c in range(4)}
        best = max(range(4), key=lambda c: (votes[c], sum(own[c])))
        assert w == best and np.isclose(s, 1 / (1 + np.exp(-2 * min(own[best]))))


def test_long_texts_are_read_whole(monkeypatch):
    text = "The quick Brown fox, über 12 alles! " * 50
    whole = L.trigram_profile(text)
    for size in (1, 2, 7, 700):
        monkeypatch.setattr(L, "PIECE_BYTES", size)
        assert (L.trigram_profile(text) == whole).all()
    assert abs(np.linalg.norm(whole) - 1) < 1e-5
    assert L.trigram_profile("").sum() == 0 and L.trigram_profile("1 2 !").sum() == 0


def test_machine_separates_and_keeps_a_margin():
    r = np.random.default_rng(2)
    x = r.normal(size=(400, 6)).astype(np.float32)
    y = np.where(x @ np.array([1, -2, 0.5, 0, 0, 1]) > 0.3, 1, -1).astype(np.float32)
    w = L.fit_machine(x, y, weight=1e-5)
    assert ((x @ w[:-1] + w[-1] > 0) == (y > 0)).mean() > 0.98
    one = L.fit_machine(x[:5], np.ones(5, np.float32))  # a single class: no crash, its side
    assert (x[:5] @ one[:-1] + one[-1] > 0).all()
