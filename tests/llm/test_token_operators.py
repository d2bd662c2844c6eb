"""Token operators against the libraries themselves, on small inputs."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallyhouse.llm import huffman_tokens as H
from tallyhouse.llm import sentencepiece_prefix as S
from tallyhouse.llm import token_counts as C
from tests.llm.helpers import ODD_TEXTS, SF, as_rows, documents, odd_documents

SP = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
PIECES = st.lists(
    st.sampled_from([*"abcdeinorst ,.'0é日\n\t", " the ", "ing", "tion", "<s>", "▁", "  ", "&&&", "!!"]), max_size=40
).map("".join)


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def expected_sp(doc_id, text):
    ids = SP.encode(text or "")
    return doc_id, len(ids), sha(",".join(map(str, ids))), sha(SP.decode(ids))


@settings(max_examples=300, deadline=None)
@given(PIECES)
def test_prefix_table_gives_the_library_ids(text):
    assert S.encoder("piece_bpe_32k.model").encode(text) == SP.encode(text)


def test_prefix_table_without_caches_of_words():
    enc = S.encoder("piece_bpe_32k.model")
    for t in ["a" * 700, "ingtion" * 90, "thththe" * 50, "\x00\x01"]:
        normal = SP.normalize(t)
        want = SP.encode(t)
        got = [i for p in enc.tokens(normal) for i in ([enc.ids[p]] if p in enc.ids else [enc.byte_ids[b] for b in p.encode()])]
        assert got == want


def test_op10_equals_the_library(spark):
    got = as_rows(S.op10_sentencepiece(spark, SF), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert got == sorted((expected_sp(*r) for r in documents()), key=repr)


def test_sentencepiece_odd_rows(spark):
    df = odd_documents(spark)
    want = sorted((expected_sp(r["doc_id"], r["text"]) for r in df.collect()), key=repr)
    assert as_rows(S.digest_documents(df), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == want
    out = S.encode_documents(df.withColumnRenamed("h", "token_ids"))
    assert out.columns == [*df.columns[:-1], "token_ids", "_n_tokens", "_token_ids", "decoded_text"]
    for r in out.collect():
        assert r["_token_ids"] == SP.encode(r["text"] or "") and r["_n_tokens"] == len(r["_token_ids"])
        assert r["decoded_text"] == SP.decode(r["_token_ids"])
    assert S.digest_documents(df.limit(0)).count() == 0


# ---------------------------------------------------------------- token counts


def words_tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def test_op7_equals_the_library(spark):
    tok = words_tokenizer()
    want = []
    for i, t in documents():
        n = len(tok.encode(t or "", add_special_tokens=False).ids)
        want.append((i, len((t or "").encode()), n, n > 2048))
    assert as_rows(C.op7_token_counts(spark, SF), "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(want, key=repr)


def test_counts_of_odd_rows_with_tiny_chunks(spark):
    tok, df = words_tokenizer(), odd_documents(spark)
    want = sorted(
        ((r["doc_id"], len(tok.encode(r["text"] or "", add_special_tokens=False).ids)) for r in df.collect()), key=repr
    )
    assert as_rows(C.count_tokens(df, huge_chars=10, chunk=16, overlap=4), "doc_id", "n_tokens") == want
    assert C.count_tokens(df.limit(0)).count() == 0


@settings(max_examples=200, deadline=None)
@given(PIECES, st.integers(8, 40), st.integers(2, 8))
def test_spliced_ids_equal_whole_ids(text, chunk, overlap):
    tok = C.tokenizer("word_bpe_49k.json")
    assert [i for _, i in C.encode_spliced(tok, text, chunk, overlap)] == tok.encode(text, add_special_tokens=False).ids


def test_overlap_widens_without_white_space():
    tok = C.tokenizer("word_bpe_49k.json")
    t = "abcdefg" * 900 + " the end"
    assert [i for _, i in C.encode_spliced(tok, t, 50, 5)] == tok.encode(t, add_special_tokens=False).ids


# ---------------------------------------------------------------- Huffman files


def expected_ids(rows):
    tok, start, out = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0, []
    for i, t in rows:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 0]
        out.append((i, start, len(ids), ids))
        start += len(ids)
    return out


def test_op6_round_trip_equals_the_library(spark):
    want = [(i, s, n, zlib.crc32(np.array(ids, "<u4").tobytes())) for i, s, n, ids in expected_ids(documents())]
    got = as_rows(H.op6_huffman_tokens(spark, SF), "doc_id", "start", "n_tokens", "ids_crc32")
    assert got == sorted(want, key=repr)


def test_token_file_of_odd_rows_in_small_blocks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(H, "LEAST_TOKENS", 700)
    df = odd_documents(spark).where("doc_id is not null").dropDuplicates(["doc_id"])
    rows = sorted(((r["doc_id"], r["text"]) for r in df.collect()))
    H.write_token_file(df, f"{tmp_path}/f")
    got = as_rows(H.read_token_file(spark, f"{tmp_path}/f"), "doc_id", "start", "n_tokens", "ids")
    assert got == sorted(expected_ids(rows), key=repr)


def test_token_file_null_ids_repeated_rows_and_no_rows(spark, tmp_path):
    df = odd_documents(spark)
    H.write_token_file(df, f"{tmp_path}/a")
    got = sorted(H.read_token_file(spark, f"{tmp_path}/a").collect(), key=lambda r: r["start"])
    assert got[0]["doc_id"] is None and [r["doc_id"] for r in got[1:]] == sorted(r["doc_id"] for r in got[1:])
    assert [r["start"] for r in got] == list(np.cumsum([0, *[r["n_tokens"] for r in got[:-1]]]))
    assert len(got) == df.count()
    H.write_token_file(df.limit(0), f"{tmp_path}/b")
    assert H.read_token_file(spark, f"{tmp_path}/b").count() == 0


def test_rows_without_an_id_are_spread_over_shards(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(H, "LEAST_TOKENS", 100)
    rows = [(None if i % 3 else i, f"text {i} of many") for i in range(600)]
    H.write_token_file(spark.createDataFrame(rows, "doc_id long, text string"), f"{tmp_path}/n")
    blocks = spark.read.parquet(f"{tmp_path}/n/blocks").collect()
    assert sum(None in b["doc_ids"] for b in blocks) > 2 and len({(b["shard"], b["block"]) for b in blocks}) == len(blocks)
    got = sorted(H.read_token_file(spark, f"{tmp_path}/n").collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [None] * 400 + list(range(0, 600, 3))
    texts = dict(zip(range(0, 600, 3), rows[::3]))
    assert [r["ids"] for r in got[400:]] == [ids for *_, ids in expected_ids(texts.values())]
    assert [r["start"] for r in got] == list(np.cumsum([0, *[r["n_tokens"] for r in got[:-1]]]))


def test_code_lengths_are_optimal_and_limited():
    rng = random.Random(3)
    for bits in (4, 6, 16):
        counts = np.array([0] + [int(1.9**rng.randint(0, 20)) for _ in range(14)])
        lengths = H.code_lengths(counts, bits)
        assert lengths[0] == 0 and lengths.max() <= bits
        assert sum(2.0 ** -int(n) for n in lengths if n) == pytest.approx(1)
        codes = H.canonical_codes(lengths)
        words = [format(int(codes[i]), f"0{lengths[i]}b") for i in range(1, 15)]
        assert not any(a != b and b.startswith(a) for a in words for b in words)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 40), min_size=1, max_size=1300), min_size=1, max_size=5))
def test_pack_and_unpack(docs):
    ids = np.array([i for d in docs for i in d], np.uint16)
    n = np.array([len(d) for d in docs])
    lengths = H.code_lengths(np.bincount(ids, minlength=41), 6)
    payload, sizes, offsets, marks = H.pack(ids, n, H.canonical_codes(lengths), lengths)
    assert marks.sum() == len(offsets) and len(payload) == sizes.sum()
    back = H.unpack(payload, sizes, n, offsets.astype(np.int64), H.decode_table(lengths, 6), 6)
    assert (back == ids).all()


@settings(max_examples=200, deadline=None)
@given(st.lists(PIECES, max_size=6))
def test_cached_stretches_give_the_library_ids(texts):
    enc = H.stretch_encoder("byte_bpe_50k.json")
    assert enc.encode(texts) == [enc._whole(t) for t in texts]


def test_odd_texts_stretches():
    enc = H.stretch_encoder("byte_bpe_50k.json")
    texts = [t or "" for t in ODD_TEXTS]
    assert enc.encode(texts) == [enc._whole(t) for t in texts]


def test_signs_and_beginnings_of_lines_cost_no_call_each(monkeypatch):
    enc, calls, together = H.StretchEncoder("byte_bpe_50k.json"), [], []
    whole, some = enc._whole, enc._together
    monkeypatch.setattr(enc, "_whole", lambda t: calls.append(t) or whole(t))
    monkeypatch.setattr(enc, "_together", lambda words, *a: together.extend(words) or some(words, *a))
    stems = [f"{a}{b}tion" for a in "abcdefghij" for b in "aeiouäé日本語"]
    texts = ["\n".join(f"{w} {w}&&& {w}, {w}.\" {w}20%" for w in stems), "\n" + "\n".join(stems)]
    assert enc.encode(texts) == [whole(t) for t in texts]
    assert len(calls) < 12  # the first word of each text and the kinds of signs
    assert len(together) == len(set(together)) <= 3 * len(stems) + 1


def test_stretches_of_odd_lines_and_a_small_cache(monkeypatch):
    monkeypatch.setattr(H, "CACHE_STRETCHES", 3)
    enc = H.StretchEncoder("byte_bpe_50k.json")
    texts = ["", "\n", "\na", "a\n", "\ta\tb c", "a\tb\nc", "\x1c", "a\x85b ,", "x\u3000\u3000y z", "it's dogs' (so)\n's", "12.\n34,5%", "a\n b  c\nd", "\x00\n\x00 \x00", "<|endoftext|>"]
    for some in ([], [""], ["\n"], texts, texts[::-1], texts * 3):
        assert enc.encode(some) == [enc._whole(t) for t in some]


def test_groups_of_texts_follow_their_bytes(monkeypatch):
    monkeypatch.setattr(H, "GROUP_BYTES", 10)
    texts = H.pa.array(["", "é" * 5, "a", "b" * 30, "c" * 4, "d" * 6, "", "e"])
    assert list(H._groups(texts)) == [(0, 2), (2, 1), (3, 1), (4, 3), (7, 1)]
    assert list(H._groups(texts.slice(3, 2))) == [(0, 1), (1, 1)] and not list(H._groups(texts[:0]))


def test_op7_splices_the_long_documents_of_a_table(spark):
    sf = SF.replace("sf0.001", "sf0.1")
    tok = C.tokenizer("word_bpe_49k.json")
    texts = dict(documents(sf=sf))
    rows = C.op7_token_counts(spark, sf).collect()
    long = [r for r in rows if len(texts[r["doc_id"]] or "") > C.CHUNK_CHARS]
    assert len(rows) == len(texts) and len(long) > 400
    assert {r["n_chunks"] for r in rows if r not in long} == {1}
    assert all(r["n_chunks"] > 1 for r in long)
    whole = tok.encode_batch_fast([texts[r["doc_id"]] for r in long], add_special_tokens=False)
    assert [r["n_tokens"] for r in long] == [len(e) for e in whole]


def test_op7_very_long_texts_of_all_kinds(spark):
    tok = C.tokenizer("word_bpe_49k.json")
    texts = ["ab" * 100_000, ("x" * 9_000 + " ") * 9, " " * 300_000 + "b", "a b\n" * 100_000, "<|endoftext|>" * 5_000, "e\u0301 " * 50_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = sorted(((i, len(tok.encode(t, add_special_tokens=False))) for i, t in enumerate(texts)), key=repr)
    assert as_rows(C.count_tokens(df), "doc_id", "n_tokens") == want


def test_failed_alignment_widens_the_overlap_and_then_the_chunk():
    tok = C.tokenizer("word_bpe_49k.json")
    text = "a b " + "c" * 60 + " d e f g " + "h" * 200 + " i j"
    parts = list(C.stretches(tok, text, 40, 4))
    assert max(c.end - c.begin for c, _, _ in parts) > 40
    assert sum(end - first for _, first, end in parts) == len(tok.encode(text, add_special_tokens=False))
