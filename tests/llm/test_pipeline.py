"""The pipeline's stages against brute force, each on its own input."""

import hashlib

import corpus_pipeline as P
from tallyhouse.llm import qgram_leaks as L
from tallyhouse.llm import simhash_blocks as B
from tallyhouse.llm import toxicity_trees as T
from tallyhouse.llm.common import read_input, saved
from tests.llm.helpers import ODD_TEXTS
from tests.llm.test_dedup_operators import brute_groups, brute_windows
from tests.llm.test_token_operators import SP

SF = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows_of(df):
    return sorted((r["doc_id"], r["text"]) for r in df.collect())


def test_each_stage_on_its_own_input(spark):
    docs = read_input(spark, SF, "documents")
    names = [n for n, _ in P.STAGES]
    assert names == ["toxicity", "simhash_near_dedup", "substring_dedup", "benchmark_decontamination", "sentencepiece"]
    assert docs.columns == COLUMNS
    stages = dict(P.STAGES)

    clean = saved(stages["toxicity"](spark, docs, SF), "t1")
    model = T.fit(docs, read_input(spark, SF, "labels"))
    bad = {r["doc_id"] for r in T.score_documents(docs, model).collect() if r["predicted"]}
    before = rows_of(docs)
    assert bad and rows_of(clean) == [r for r in before if r[0] not in bad] and clean.columns == COLUMNS

    one = saved(stages["simhash_near_dedup"](spark, clean, SF), "t2")
    rows = rows_of(clean)
    least = {i for i, _, c in brute_groups(rows) if i == c}
    assert rows_of(one) == [r for r in rows if r[0] in least] and one.columns == COLUMNS

    cut = saved(stages["substring_dedup"](spark, one, SF), "t3")
    rows = rows_of(one)
    want = {i: (removed, sha) for i, _, removed, sha in brute_windows(rows)}
    texts = dict(rows)
    for r in cut.collect():
        removed, sha = want[r["doc_id"]]
        assert r["n_chars"] == len(r["text"])
        assert removed or r["text"] == texts[r["doc_id"]]
        assert hashlib.sha256(" ".join(r["text"].split(None)).encode()).hexdigest() == sha
    assert cut.count() == one.count() and cut.columns == COLUMNS

    safe = saved(stages["benchmark_decontamination"](spark, cut, SF), "t4")
    items = [L.normal(r["text"]) for r in read_input(spark, SF, "benchmark").collect()]
    verbatim = {i for i, t in rows_of(cut) if any(x in L.normal(t) for x in items)}
    gone = {i for i, _ in rows_of(cut)} - {i for i, _ in rows_of(safe)}
    assert verbatim <= gone and gone == {r["doc_id"] for r in L.find_leaks(cut, read_input(spark, SF, "benchmark")).collect()}

    out = stages["sentencepiece"](spark, safe, SF).collect()
    texts = dict(rows_of(safe))
    assert len(out) == len(texts)
    for r in out:
        ids = SP.encode(texts[r["doc_id"]])
        assert (r["n_tokens"], r["token_ids"]) == (len(ids), ids)
        assert r["decoded_sha256"] == hashlib.sha256(SP.decode(ids).encode()).hexdigest()

    whole = P.run(spark, SF)
    assert sorted((r["doc_id"], r["n_tokens"]) for r in whole.collect()) == sorted((r["doc_id"], r["n_tokens"]) for r in out)


def test_stages_take_odd_and_empty_tables(spark):
    rows = [(5 * i % 23, t, None if i % 3 == 0 else "en", None, len(t or "")) for i, t in enumerate(ODD_TEXTS)]
    rows += [rows[5], (None, "no id", None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr(
        "*", "1 AS chunk", "2 AS text_hash", "3 AS token_ids"
    )
    for table in (docs, docs.limit(0)):
        now = table
        for name, stage in P.STAGES:
            now = saved(stage(spark, now, SF), "odd")
            assert name == "sentencepiece" or now.columns == docs.columns
        n = now.count()
        assert n == B.one_of_each(table).count()
