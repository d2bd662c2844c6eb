"""Cross-tokenizer alignment against a plain restatement with the libraries."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from tallyhouse.llm import cross_tokenizers as X
from tests.llm.helpers import ODD_TEXTS, SF, documents, odd_documents

FIELDS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def brute_force(rows):
    """rows: (doc_id, text)."""
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    letters = X.byte_level_letters()

    def groups(text):
        want = (" " + (text or "")).encode()
        a = tok.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = sp.encode(text) if text else []
        bytes_a = [bytes(letters[c] for c in tok.id_to_token(i)) for i in a]
        bytes_b = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not text or b"".join(bytes_a) != want or b"".join(bytes_b) != want:
            return []
        ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
        common, out, i, j = sorted(set(ends_a) & set(ends_b)), [], 0, 0
        for e in common:
            ga, gb = [], []
            while i < len(a) and ends_a[i] <= e:
                ga.append(a[i])
                i += 1
            while j < len(b) and ends_b[j] <= e:
                gb.append(b[j])
                j += 1
            out.append((ga, gb))
        return out

    found = [(i, groups(t)) for i, t in rows]
    count = Counter()
    for _, g in found:
        count.update({(x, y) for ga, gb in g for x in ga for y in gb})
    top = defaultdict(int)
    for (x, _), n in count.items():
        top[x] = max(top[x], n)
    out = []
    for i, g in found:
        links = [(x, y) for ga, gb in g for x in ga for y in gb]
        shown = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in g)
        out.append((
            i, sum(len(ga) for ga, _ in g), sum(len(gb) for _, gb in g), len(g), len(links),
            sum(count[p] == top[p[0]] for p in links), sum(count[p] for p in links),
            hashlib.sha256(shown.encode()).hexdigest() if g else "",
        ))
    return sorted(out, key=repr)


def as_tuples(df):
    return sorted((tuple(r[f] for f in FIELDS) for r in df.collect()), key=repr)


def test_query_equals_brute_force(spark):
    assert as_tuples(X.op12_cross_tokenizers(spark, SF)) == brute_force(documents())


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert as_tuples(X.align_tokenizers(docs, chars=300, most=3)) == brute_force(rows)
    assert X.align_tokenizers(docs.where("false")).collect() == []


def test_random_texts_and_copies(spark):
    r = random.Random(5)
    signs = ["the", "a", "é", "ß", " ", "  ", "\n", "\t", "▁", "<s>", "<0x0A>", "<|endoftext|>", "'s", "12", "日本", "\U0001f600", "́", "x" * 40, ",", ".", " "]
    texts = ["".join(r.choice(signs) for _ in range(r.randrange(1, 25))) for _ in range(400)] + ODD_TEXTS
    texts += ["copied text of many rows"] * 300 + ["zq" * 30_000, "ab" * 9_000 + " end"]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert as_tuples(X.align_tokenizers(df, chars=2_000, most=50)) == brute_force(rows)


def test_many_links_in_a_group():
    r = np.random.default_rng(3)
    a, b = r.integers(0, 5, 60), r.integers(0, 4, 90)
    group_a, group_b = np.sort(r.integers(0, 3, 60)), np.sort(r.integers(0, 3, 90))
    text = np.array([0, 0, 1])[group_a]
    want = Counter((int(text[i]), int(a[i]) * 7 + int(b[j])) for i in range(60) for j in range(90) if group_a[i] == group_b[j])
    for many in (0, 100, 10**6):
        got = X.linked_pairs(a, b, group_a, group_b, text, 7, many)
        assert {(int(t), int(p)): int(n) for t, p, n in zip(*got)} == dict(want)
