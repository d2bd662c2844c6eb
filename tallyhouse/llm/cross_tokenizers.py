"""Cross-tokenizer alignment: which ids of two tokenizers share text, each distinct text done once.

1. Rows are shuffled by their full text, combined before the shuffle, so a text with
   any number of copies arrives as one row with its multiplicity.
2. Distinct texts are tokenised by both tokenizers and aligned, a bounded chunk of
   texts at a time: byte offsets at which tokens of both end cut the text into
   groups; every token of the one is linked with every token of the other in its
   group.  A chunk is written once, as one row: per text the digest of its groups and
   its linked id pairs as places in the chunk's own list of pairs; per pair how many
   documents hold it linked, copies counted by multiplicity.
3. The chunks' pair counts are summed over the corpus; a pair is best if no pair of
   the same first id has a higher count.  Counts go back to the chunks that asked,
   a row a chunk and pair, and give each text its measures.
4. Measures are joined to the ids of all rows by the SHA-256 of the text.  That side
   holds one row a distinct text; a text with a third of all rows is split by
   Spark's skew join.

A token's bytes: the first tokenizer is byte-level; a piece of the second is its
text in UTF-8 with U+2581 as a space, or one byte.  The first tokenizer gets a space
and the text, the second adds that space itself.  A text whose tokens of either
side do not join to a space and the text (U+2581 written in a text), a null and an
empty text have no tokens: all measures 0 and an empty digest.  Texts are tokenised
through caches of stretches between single spaces, which no token of either side
crosses.  A chunk holds ``CHUNK_CHARS`` characters or one longer text; what a
task holds is some hundred bytes a token of it.  Within a group tokens repeated
many times are linked by distinct ids and counts.  A null id stays null; repeated rows give
repeated results, empty tables empty results; only id and text are read, so
other columns may have any name.
"""

from __future__ import annotations

import hashlib
import os
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.common import kept_table, map_batches, read_input, tokenizer_path
from tallyhouse.llm.huffman_tokens import StretchEncoder

CHUNK_CHARS = 2_000_000
CHUNK_TEXTS = 4_000
CACHE_PIECES = 300_000
MANY_LINKS = 1 << 14  # a group with more links goes through distinct ids
MEASURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
CHUNK_SCHEMA = (
    "chunk long, texts array<binary>, groups_sha256 array<string>, n_a binary, n_b binary, n_groups binary, n_links binary, "
    "held binary, place binary, times binary, pairs binary, counts binary"
)


def byte_level_letters() -> dict[str, int]:
    """The byte each letter of a byte-level vocabulary stands for: printable bytes are
    themselves, the others follow in order from U+0100."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class ByteTokens:
    """Ids of a space and a text by a byte-level vocabulary, special strings as plain text."""

    def __init__(self, name: str):
        self.stretches = StretchEncoder(name)
        self.stretches.tok.encode_special_tokens = True
        self.stretches.specials = []
        self.size = self.stretches.size
        letters = byte_level_letters()
        self.lengths = np.zeros(self.size, np.int64)
        for token, i in self.stretches.tok.get_vocab().items():
            self.lengths[i] = len(token) if all(c in letters for c in token) else len(token.encode())

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        kind = self.stretches.kind
        return [np.frombuffer(x, kind).astype(np.int64) for x in self.stretches.encode([" " + t for t in texts])]


class PieceTokens:
    """Ids of a text by a piece vocabulary that puts a space in front; None where they do not join to it."""

    def __init__(self, name: str):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(name))
        self.size = self.sp.get_piece_size()
        self.bytes = [self._bytes(i) for i in range(self.size)]
        self.lengths = np.array([len(b) for b in self.bytes], np.int64)
        self.known: dict[str, np.ndarray | None] = {}
        self.lone = re.compile(r"(?<=[^ ]) (?=[^ ])")

    def _bytes(self, i: int) -> bytes:
        piece = self.sp.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.sp.is_byte(i) else piece.replace("▁", " ").encode()

    def _learn(self, words: list[str]) -> None:
        if len(self.known) > CACHE_PIECES:
            self.known.clear()
        for w, ids in zip(words, self.sp.encode(words, num_threads=1)):
            same = b"".join([self.bytes[i] for i in ids]) == b" " + w.encode()
            self.known[w] = np.array(ids, np.int64) if same else None

    def encode(self, texts: list[str]) -> list[np.ndarray | None]:
        parts = [
            self.lone.split(t) if "  " in t or t[:1] == " " or t[-1:] == " " else t.split(" ") for t in texts
        ]
        words = {w for p in parts for w in p}
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > CACHE_PIECES:
            new = list(words)
            self.known.clear()
        self._learn(new)
        out = []
        for p in parts:
            found = [self.known[w] for w in p]
            out.append(None if any(x is None for x in found) else np.concatenate(found))
        return out


def link_groups(a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray):
    """Group of each token of either side: cut at the byte offsets where tokens of both sides end."""
    cut_a = ends_b[np.minimum(np.searchsorted(ends_b, ends_a), len(ends_b) - 1)] == ends_a
    cut_b = ends_a[np.minimum(np.searchsorted(ends_a, ends_b), len(ends_a) - 1)] == ends_b
    return np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b


def linked_pairs(a, b, group_a, group_b, text_a, size_b: int, many: int = MANY_LINKS):
    """``(text, pair, times)`` of every linked id pair of each text, a pair as ``a * size_b + b``."""
    n_groups = int(group_a[-1]) + 1
    in_a, in_b = np.bincount(group_a, minlength=n_groups), np.bincount(group_b, minlength=n_groups)
    start_a, start_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
    repeat = np.where((in_a * in_b > many)[group_a], 0, in_b[group_a])
    first = np.cumsum(repeat) - repeat
    at = np.arange(int(repeat.sum())) - np.repeat(first - start_b[group_a], repeat)
    texts, pairs = np.repeat(text_a, repeat), np.repeat(a * size_b, repeat) + b[at]
    span = int(a.max() + 1) * size_b
    keys = np.sort(texts * span + pairs)
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    times = np.diff(np.append(new, len(keys)))
    keys = keys[new]
    more = []
    for g in np.flatnonzero(in_a * in_b > many):
        ids_a, times_a = np.unique(a[start_a[g] : start_a[g] + in_a[g]], return_counts=True)
        ids_b, times_b = np.unique(b[start_b[g] : start_b[g] + in_b[g]], return_counts=True)
        text = text_a[start_a[g]]
        more.append((text * span + (ids_a[:, None] * size_b + ids_b).ravel(), (times_a[:, None] * times_b).ravel()))
    if more:
        keys = np.concatenate([keys, *[k for k, _ in more]])
        times = np.concatenate([times, *[t for _, t in more]])
        keys, where = np.unique(keys, return_inverse=True)
        total = np.zeros(len(keys), np.int64)
        np.add.at(total, where, times)
        times = total
    return keys // span, keys % span, times


class Aligner:
    def __init__(self, byte_vocabulary: str, piece_vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a, self.b = ByteTokens(byte_vocabulary), PieceTokens(piece_vocabulary)
        # every id with each sign that may follow it: "," in its side, "|" or ";" at the side's end
        self.shown = [f"{i}," for i in range(self.a.size)] + [f"{i}|" for i in range(self.a.size)]
        self.shown += [f"{i}," for i in range(self.b.size)] + [f"{i};" for i in range(self.b.size)]

    def align(self, texts: list[str], copies: np.ndarray) -> dict:
        """The columns of a chunk but its number and the texts' digests."""
        n = len(texts)
        ids_a, ids_b = self.a.encode(texts), self.b.encode(texts)
        none = np.zeros(0, np.int64)
        for k, t in enumerate(texts):
            size = 1 + len(t.encode())
            whole = t != "" and ids_b[k] is not None
            if not (whole and self.a.lengths[ids_a[k]].sum() == size == self.b.lengths[ids_b[k]].sum()):
                ids_a[k] = ids_b[k] = none
        n_a, n_b = (np.array([len(x) for x in ids], np.int64) for ids in (ids_a, ids_b))
        a, b = np.concatenate([none, *ids_a]), np.concatenate([none, *ids_b])
        if not len(a):
            return {
                "groups_sha256": [""] * n, "n_a": n_a, "n_b": n_b, "n_groups": n_a, "n_links": n_a,
                "held": n_a, "place": none, "times": none, "pairs": none, "counts": none,
            }
        text_a, text_b = np.repeat(np.arange(n), n_a), np.repeat(np.arange(n), n_b)
        group_a, group_b = link_groups(a, b, np.cumsum(self.a.lengths[a]), np.cumsum(self.b.lengths[b]))
        last_a = np.append(group_a[1:] != group_a[:-1], True)
        last_b = np.append(group_b[1:] != group_b[:-1], True)
        in_group = np.bincount(group_a) * np.bincount(group_b)
        n_groups = np.bincount(text_a[last_a], minlength=n)
        n_links = np.zeros(n, np.int64)
        np.add.at(n_links, text_a[last_a], in_group)
        return {
            "groups_sha256": self._digests(a, b, group_a, group_b, last_a, last_b, n_a + n_b),
            "n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_links,
            **self._pairs(a, b, group_a, group_b, text_a, copies),
        }

    def _digests(self, a, b, group_a, group_b, last_a, last_b, sizes) -> list[str]:
        code_a = a + last_a * self.a.size
        code_b = b + 2 * self.a.size + last_b * self.b.size
        # each group's tokens of the first side stand before those of the second
        place_a = np.arange(len(a)) + np.searchsorted(group_b, group_a)
        place_b = np.arange(len(b)) + np.searchsorted(group_a, group_b, side="right")
        code = np.empty(len(a) + len(b), np.int64)
        code[place_a], code[place_b] = code_a, code_b
        shown, out, at = [self.shown[c] for c in code.tolist()], [], 0
        for size in sizes.tolist():
            line = "".join(shown[at : at + size])
            out.append(hashlib.sha256(line[:-1].encode()).hexdigest() if size else "")
            at += size
        return out

    def _pairs(self, a, b, group_a, group_b, text_a, copies) -> dict:
        text, pair, times = linked_pairs(a, b, group_a, group_b, text_a, self.b.size)
        pairs, place = np.unique(pair, return_inverse=True)
        counts = np.zeros(len(pairs), np.int64)
        np.add.at(counts, place, copies[text])
        return {"held": np.bincount(text, minlength=len(copies)), "place": place, "times": times, "pairs": pairs, "counts": counts}


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(byte_vocabulary: str, piece_vocabulary: str) -> Aligner:
    key = (byte_vocabulary, piece_vocabulary)
    if key not in _ALIGNERS:
        _ALIGNERS[key] = Aligner(*key)
    return _ALIGNERS[key]


def text_chunks(batches, chars: int, most: int):
    """(texts, copies) some at a time: at most ``chars`` characters, or one longer text."""
    texts, copies, size = [], [], 0
    for batch in batches:
        for k in range(0, batch.num_rows, 256):
            part = batch.slice(k, 256)
            for t, c in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                if texts and (size + len(t) > chars or len(texts) >= most):
                    yield texts, copies
                    texts, copies, size = [], [], 0
                texts.append(t)
                copies.append(c)
                size += len(t)
    if texts:
        yield texts, copies


def aligned_chunks(distinct: DataFrame, byte_vocabulary: str, piece_vocabulary: str, chars: int, most: int) -> DataFrame:
    def run(batches):
        both = aligner(byte_vocabulary, piece_vocabulary)
        first = TaskContext.get().partitionId() << 32
        for k, (texts, copies) in enumerate(text_chunks(batches, chars, most)):
            found = both.align(texts, np.array(copies, np.int64))
            wide = {"n_a", "n_b", "n_groups", "n_links", "pairs", "counts"}
            row = {c: v if isinstance(v, list) else v.astype("<i8" if c in wide else "<i4").tobytes() for c, v in found.items()}
            row |= {"chunk": first + k, "texts": [hashlib.sha256(t.encode()).digest() for t in texts]}
            yield pa.RecordBatch.from_pylist([row], schema=CHUNK_ARROW)

    return map_batches(distinct, run, CHUNK_SCHEMA)


CHUNK_ARROW = pa.schema(
    [("chunk", pa.int64()), ("texts", pa.list_(pa.binary())), ("groups_sha256", pa.list_(pa.string()))]
    + [(c, pa.binary()) for c in ("n_a", "n_b", "n_groups", "n_links", "held", "place", "times", "pairs", "counts")]
)


def chunk_pairs(chunks: DataFrame) -> DataFrame:
    """``chunk, at, pair, n``: the pairs of each chunk, by their place there, with the documents that hold them."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                pairs, counts = np.frombuffer(row["pairs"], "<i8"), np.frombuffer(row["counts"], "<i8")
                for k in range(0, len(pairs), 1 << 16):
                    part = pairs[k : k + (1 << 16)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(part), row["chunk"])),
                            pa.array(np.arange(k, k + len(part), dtype=np.int32)),
                            pa.array(part),
                            pa.array(counts[k : k + (1 << 16)]),
                        ],
                        names=["chunk", "at", "pair", "n"],
                    )

    return map_batches(chunks.select("chunk", "pairs", "counts"), run, "chunk long, at int, pair long, n long")


MEASURE_SCHEMA = "text_digest binary, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def text_measures(chunks: DataFrame, answers: DataFrame) -> DataFrame:
    """Measures of each distinct text from its chunk and the counts of the chunk's pairs."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        at = right.column("at").to_numpy()
        n, best = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        n[at], best[at] = right.column("n").to_numpy(), right.column("best").to_numpy().astype(np.int64)
        for row in left.to_pylist():
            held, place, times = (np.frombuffer(row[c], "<i4").astype(np.int64) for c in ("held", "place", "times"))
            text = np.repeat(np.arange(len(held)), held)
            n_best, total = np.zeros(len(held), np.int64), np.zeros(len(held), np.int64)
            np.add.at(n_best, text, times * best[place])
            np.add.at(total, text, times * n[place])
            sizes = [np.frombuffer(row[c], "<i8") for c in ("n_a", "n_b", "n_groups", "n_links")]
            arrays = [pa.array(row["texts"], pa.binary()), *map(pa.array, [*sizes, n_best, total]), pa.array(row["groups_sha256"], pa.string())]
            out.append(pa.table(arrays, names=["text_digest", *MEASURES, "groups_sha256"]))
        return pa.concat_tables(out) if out else pa.table(
            [pa.array([], pa.binary()), *[pa.array([], pa.int64())] * 6, pa.array([], pa.string())],
            names=["text_digest", *MEASURES, "groups_sha256"],
        )

    wanted = chunks.select("chunk", "texts", "groups_sha256", "n_a", "n_b", "n_groups", "n_links", "held", "place", "times")
    return wanted.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(run, MEASURE_SCHEMA)


def align_tokenizers(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    byte_vocabulary: str = "byte_bpe_50k.json",
    piece_vocabulary: str = "piece_bpe_32k.model",
    chars: int = CHUNK_CHARS,
    most: int = CHUNK_TEXTS,
) -> DataFrame:
    """Per row: ``doc_id``, the six measures and the digest of the text's groups."""
    docs = df.selectExpr(f"cast(`{id_col}` as long) AS doc_id", f"cast(`{text_col}` as string) AS text")
    distinct = docs.where("text <> ''").groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
    chunks, _ = kept_table(aligned_chunks(distinct, byte_vocabulary, piece_vocabulary, chars, most), "alignment")
    asked = chunk_pairs(chunks)
    counts, _ = kept_table(asked.groupBy("pair").agg(F.sum("n").alias("n")), "pair-counts")
    size_b = aligner_size(piece_vocabulary)
    first = F.expr(f"pair div {size_b}")
    top = counts.groupBy(first.alias("first")).agg(F.max("n").alias("top"))
    judged = counts.withColumn("first", first).join(top, "first").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))
    answers = asked.drop("n").join(judged, "pair").select("chunk", "at", "n", "best")
    measures = text_measures(chunks, answers)
    rows = docs.select("doc_id", F.unhex(F.sha2("text", 256)).alias("text_digest"))
    joined = rows.join(measures, "text_digest", "left")
    return joined.select(
        "doc_id",
        *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in MEASURES],
        F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"),
    )


def aligner_size(piece_vocabulary: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(piece_vocabulary)).get_piece_size()


def op12_cross_tokenizers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokenizers(read_input(spark, sf_dir, "documents"))
