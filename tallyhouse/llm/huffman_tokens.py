"""Token ids as canonical length-limited Huffman codes in independent blocks.

Writing: the ids of all documents go to an intermediate table, whose ids are
counted (a vocabulary-sized table); the counts give code lengths of at most
``max_bits`` (package-merge), lengths give canonical codes.  Each document is
then coded, byte-aligned, with the bit offset of every ``CHECKPOINT``-th id;
documents are exchanged once into shards, ranges of ascending (``doc_id``, hash
of the text) cut at a sample and a task each, and packed, in that order, into
blocks.
The file format is a folder of two parquet tables:

``codes``   one row: ``lengths`` (a byte an id, 0: unused), ``max_bits``
``blocks``  ``shard, block, start, n_tokens, doc_ids, counts, sizes, offsets,
            payload``: a row is a block that can be decoded alone; ``start`` is
            the number of ids in front of it in its shard, ``counts`` and
            ``sizes`` have ids and bytes a document, ``offsets`` the bit
            offset of each checkpoint from the start of its document.

Reading: a table indexed by the next ``max_bits`` bits gives an id and its length;
all checkpoints of a batch of blocks are decoded side by side.

Encoding is the tokenizers library's.  Its byte-level pattern starts a piece at
every single space between two characters that are not white space, so text is
cut there and each distinct stretch is encoded once per worker and cached, without
the signs behind it.  Texts that hold the string of a special token are encoded whole.

Null and empty texts have the end id alone.  Null ``doc_id``s come first; rows of
equal ``doc_id`` follow the hash of their text.  Empty tables give empty
folders and results.  Extra columns are ignored whatever their names.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_left
from itertools import chain, compress
from operator import not_
from string import punctuation

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.common import drop_table, map_batches, read_input, tokenizer_path, write_table
from tallyhouse.session import scratch_path

CHECKPOINT = 512
BLOCK_TOKENS = 65_536
SHARD_TOKENS = 128_000_000  # about 0.2 GB of codes
LEAST_TOKENS = 2_000_000  # smaller shards are not made just to fill the session's partitions
SAMPLE_KEYS = 1_000_000  # at most about so many keys are sampled to cut shards
CACHE_STRETCHES = 1_500_000  # about 0.35 GB a worker
CACHE_SIGNS = 100_000
GROUP_BYTES = 6 << 20  # of texts encoded together
PACK_TEXTS = 64  # few enough for the processor's cache
DIGITS = frozenset("0123456789")
DOUBLE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]{2}"  # as \s\s in Python
SPACE = "\u0120"  # fixed value: how byte-level vocabularies write the space
BLOCK_SCHEMA = (
    "shard int, block int, start long, n_tokens long, doc_ids array<long>, counts array<int>, "
    "sizes array<int>, offsets binary, payload binary"
)

# ------------------------------------------------------------------ codes


def code_lengths(counts: np.ndarray, max_bits: int) -> np.ndarray:
    """Optimal code lengths of at most ``max_bits`` for the ids with a count (package-merge)."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << max_bits:
        raise ValueError("more ids than codes of that length")
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.float64)
    levels, packages = [], np.zeros(0)
    for _ in range(max_bits):
        weights = np.concatenate([leaves, packages])
        by = np.argsort(weights, kind="stable")
        levels.append(by < len(leaves))
        merged = weights[by][: len(weights) // 2 * 2]
        packages = merged[0::2] + merged[1::2]
    take, depth = 2 * len(used) - 2, np.zeros(len(used), np.int64)
    for is_leaf in reversed(levels):
        n = int(np.count_nonzero(is_leaf[:take]))
        depth[:n] += 1
        take = 2 * (take - n)
    lengths[order] = depth
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of (length, id)."""
    codes = np.zeros(len(lengths), np.uint64)
    code, before = 0, 0
    for i in np.lexsort((np.arange(len(lengths)), lengths)):
        n = int(lengths[i])
        if n:
            code = (code << (n - before)) if before else 0
            codes[i], before = code, n
            code += 1
    return codes


def decode_table(lengths: np.ndarray, max_bits: int) -> np.ndarray:
    """``id << 8 | length`` for every value of the next ``max_bits`` bits."""
    table = np.zeros(1 << max_bits, np.uint64)
    codes = canonical_codes(lengths)
    for i in np.flatnonzero(lengths):
        n = int(lengths[i])
        first = int(codes[i]) << (max_bits - n)
        table[first : first + (1 << (max_bits - n))] = (int(i) << 8) | n
    return table


def pack(ids: np.ndarray, counts: np.ndarray, codes: np.ndarray, lengths: np.ndarray):
    """Code documents laid end to end: (payload, bytes a document, checkpoint offsets, checkpoints a document)."""
    n = lengths[ids]
    ends = np.cumsum(n, dtype=np.int64)
    first = np.cumsum(counts) - counts
    begin = ends[first] - n[first]
    sizes = (ends[first + counts - 1] - begin + 7) >> 3
    start = (np.cumsum(sizes) - sizes) * 8
    place = ends - n
    place += np.repeat(start - begin, counts)
    words = np.zeros(int(sizes.sum()) // 4 + 3, np.uint64)
    at = place >> 5
    highest = codes << (np.uint64(64) - lengths)  # each code in the first of 64 bits
    value = highest[ids] >> (place & 31).view(np.uint64)
    runs = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    value, at = np.bitwise_or.reduceat(value, runs), at[runs]  # codes that begin in the same word
    words[at] |= value >> np.uint64(32)
    words[at + 1] |= value & np.uint64(0xFFFFFFFF)
    marks = -(-counts // CHECKPOINT)
    k = np.arange(int(marks.sum())) - np.repeat(np.cumsum(marks) - marks, marks)
    offsets = place[np.repeat(first, marks) + CHECKPOINT * k] - np.repeat(start, marks)
    payload = words.astype(">u4").tobytes()[: int(sizes.sum())]
    return payload, sizes, offsets.astype("<u4"), marks


def unpack(payload: bytes, sizes: np.ndarray, counts: np.ndarray, offsets: np.ndarray, table: np.ndarray, max_bits: int):
    """The ids of documents laid end to end: every checkpoint is a lane, all lanes advance together."""
    marks = -(-counts // CHECKPOINT)
    doc_bit = np.concatenate([[0], np.cumsum(sizes)[:-1]]) * 8
    doc_first = np.concatenate([[0], np.cumsum(counts)[:-1]])
    k = np.arange(int(marks.sum())) - np.repeat(np.cumsum(marks) - marks, marks)
    bit = np.repeat(doc_bit, marks) + offsets
    to = np.repeat(doc_first, marks) + k * CHECKPOINT
    left = np.minimum(CHECKPOINT, np.repeat(counts, marks) - k * CHECKPOINT)
    order = np.argsort(-left, kind="stable")
    bit, to, left = bit[order], to[order], left[order]
    raw = np.frombuffer(payload + b"\0\0\0\0", np.uint8).astype(np.uint32)
    ahead = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]
    out = np.zeros(int(counts.sum()), np.uint32)
    table = table.astype(np.uint32)
    shift, mask = 32 - max_bits, np.uint32((1 << max_bits) - 1)
    active = np.searchsorted(-left, -np.arange(CHECKPOINT), side="left")  # lanes with more than s ids
    for s in range(CHECKPOINT):
        n = int(active[s])
        if not n:
            break
        b = bit[:n]
        found = table[(ahead[b >> 3] >> (shift - (b & 7)).astype(np.uint32)) & mask]
        out[to[:n] + s] = found >> 8
        bit[:n] += found & 255
    return out


# ------------------------------------------------------------------ encoding


class StretchEncoder:
    """Ids of texts as bytes of little-endian numbers, through a cache of stretches.

    Texts are split by Arrow, some megabytes at a time; only the distinct stretches
    of such a group are looked up.  A newline between other characters is a piece of
    its own.  A stretch is filed with a tab in front if it starts its text, with the
    newline in front if it starts another line, and as it follows its space otherwise
    (such a stretch never starts with white space).
    """

    def __init__(self, name: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(tokenizer_path(name))
        self.tok.no_padding()
        self.tok.no_truncation()
        self.size = self.tok.get_vocab_size(with_added_tokens=True)
        self.kind = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self.spaced, self.lined = np.zeros((2, self.size), bool)
        self.spaced[[i for t, i in self.tok.get_vocab().items() if t[0] == SPACE]] = True
        self.lined[self.tok.encode("\n", add_special_tokens=False).ids[:1]] = True
        self.specials = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}
        self.signs: dict[str, bytes] = {}
        self.lone = re.compile(r"(?<=\S) (?=\S)")

    def _whole(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def _learn(self, new: list[str]) -> None:
        """Encode new stretches together.  Signs between a letter or digit and the end are a piece of their own."""
        known, signs = self.known, self.signs
        stems, plain = {}, set()
        for w in new:
            stem = w.rstrip(punctuation)
            if len(stem) < len(w) and (stem[-1:].isalpha() or stem[-1:] in DIGITS):
                stems[w] = stem
                if stem not in known:
                    plain.add(stem)
            else:
                plain.add(w)
        spaced, lined = [], []
        for w in plain:
            if w.isalpha():
                spaced.append(w)
            elif not w or w[0] == "\t" or w == "\n" or " " in w or w[-1].isspace():
                known[w] = self._whole(w[1:] if w[:1] == "\t" else w if w[:1] == "\n" else " " + w)
            else:
                (lined if w[0] == "\n" else spaced).append(w)
        known.update(zip(lined, self._together(lined, self.lined)))
        known.update(zip(spaced, self._together([" " + w for w in spaced], self.spaced)))
        for w, stem in stems.items():
            sign = w[len(stem) :]
            if sign not in signs:
                if len(signs) > CACHE_SIGNS:
                    signs.clear()
                signs[sign] = self._whole(sign)
            known[w] = known[stem] + signs[sign]

    def _together(self, words: list[str], begins: np.ndarray) -> list[bytes]:
        """Ids of words that start with a space or newline: some at a time, cut at the ids that begin with it."""
        if not words:
            return []
        some = ["".join(words[k : k + 64]) for k in range(0, len(words), 64)]
        found = self.tok.encode_batch_fast(some, add_special_tokens=False)
        ids = np.concatenate([np.array(e.ids, self.kind) for e in found])
        starts = np.flatnonzero(begins[ids])
        if len(starts) != len(words):  # never with a byte-level vocabulary
            return [self._whole(w) for w in words]
        raw, ends = ids.tobytes(), [*(starts[1:] * ids.itemsize).tolist(), ids.nbytes]
        return [raw[a:b] for a, b in zip((starts * ids.itemsize).tolist(), ends)]

    def _look_up(self, words: list[str]) -> list[bytes]:
        """Ids of distinct stretches; a full cache keeps those of this call."""
        found = list(map(self.known.get, words))
        lacking = list(compress(range(len(words)), map(not_, found)))
        if lacking:
            new = [words[i] for i in lacking]
            self._learn(new)
            for i, w in zip(lacking, new):
                found[i] = self.known[w]
            if len(self.known) > CACHE_STRETCHES:
                self.known = dict(zip(words, found))
        return found

    def _joined(self, words: pa.Array, ends: np.ndarray, end: bytes) -> pa.Array:
        """Ids of each text, whose stretches stop in front of ``ends``, and ``end`` behind them."""
        filed = words.dictionary_encode()
        ids = pa.array([*self._look_up(filed.dictionary.to_numpy(zero_copy_only=False).tolist()), end], pa.binary())
        at = np.insert(filed.indices.to_numpy(), ends, len(ids) - 1)
        laid = ids.take(pa.array(at))
        offsets = np.frombuffer(laid.buffers()[1], np.int32)[np.concatenate([[0], ends + np.arange(1, len(ends) + 1)])]
        return pa.BinaryArray.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), laid.buffers()[2]])

    def encode_array(self, texts: pa.Array, end: bytes = b"") -> pa.Array:
        """Ids of each text of a string array without nulls, and ``end`` behind them."""
        whole, double = np.zeros(len(texts), bool), pc.match_substring_regex(texts, DOUBLE).to_numpy(zero_copy_only=False)
        for s in self.specials:
            whole |= pc.match_substring(texts, s).to_numpy(zero_copy_only=False)
        kinds = np.where(whole, 2, np.where(double, 1, 0))
        rows = [np.flatnonzero(kinds == k) for k in range(3)]
        plain, spaced, special = (texts if len(r) == len(texts) else texts.take(pa.array(r)) for r in rows)
        out = []
        if len(plain):
            lines = pc.replace_substring(plain, "\n", " \n")
            parts = pc.split_pattern(pc.binary_join_element_wise("\t", lines, ""), " ")
            out.append(self._joined(parts.flatten(), np.cumsum(pc.list_value_length(parts).to_numpy()), end))
        if len(spaced):
            parts = [self.lone.split("\t" + t) for t in spaced.to_pylist()]
            words = pa.array(chain.from_iterable(parts), pa.string())
            out.append(self._joined(words, np.cumsum([len(x) for x in parts]), end))
        if len(special):
            out.append(pa.array([self._whole(t) + end for t in special.to_pylist()], pa.binary()))
        if len(out) == 1:
            return out[0]
        return pa.concat_arrays([pa.array([], pa.binary()), *out]).take(pa.array(np.argsort(np.concatenate(rows))))

    def encode(self, texts: list[str]) -> list[bytes]:
        return self.encode_array(pa.array(texts, pa.string())).to_pylist()


_ENCODERS: dict[str, StretchEncoder] = {}
_FIRST = -(2**63) - 1  # in front of every id: the place of rows without one


def stretch_encoder(name: str) -> StretchEncoder:
    if name not in _ENCODERS:
        _ENCODERS[name] = StretchEncoder(name)
    return _ENCODERS[name]


def _texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.selectExpr(
        f"cast(`{id_col}` as long) AS doc_id",
        f"coalesce(cast(`{text_col}` as string), '') AS text",
    )


def _groups(texts: pa.Array):
    """(first row, rows) of the groups of a string array: about ``GROUP_BYTES`` each, a text at least."""
    ends, first = np.cumsum(pc.binary_length(texts).to_numpy(), dtype=np.int64), 0
    while first < len(ends):
        before = int(ends[first - 1]) if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + GROUP_BYTES, side="right")))
        yield first, last - first
        first = last


def _numbers(laid: pa.Array, kind: np.dtype) -> np.ndarray:
    """The numbers of all rows of a binary array without nulls, end to end."""
    offsets = np.frombuffer(laid.buffers()[1], np.int32)[laid.offset : laid.offset + len(laid) + 1]
    return np.frombuffer(laid.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].view(kind)


def encode_table(docs: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """``doc_id, tie, ids, counts``: the ids of each text and the end id as little-endian numbers.

    The last row of each task has no ids but ``counts``: how often each id occurred in it.
    """

    def run(batches):
        enc = stretch_encoder(vocabulary)
        end = np.array([end_id], enc.kind).tobytes()
        total = np.zeros(enc.size, np.int64)
        names = ["doc_id", "tie", "ids", "counts"]
        for batch in batches:
            for k, n in _groups(batch.column(1)):
                ids = enc.encode_array(batch.column(1).slice(k, n), end)
                total += np.bincount(_numbers(ids, enc.kind), minlength=enc.size)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(k, n), batch.column(2).slice(k, n), ids, pa.nulls(n, pa.binary())],
                    names=names,
                )
        if total.any():
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([total.astype("<i8").tobytes()], pa.binary())],
                names=names,
            )

    return map_batches(docs.withColumn("tie", F.xxhash64("text")), run, "doc_id long, tie long, ids binary, counts binary")


def id_counts(counts: DataFrame) -> DataFrame:
    """``token, n``: how often each id occurs in the corpus, end ids included, from the tasks' counts."""

    def run(batches):
        total = None
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                own = np.frombuffer(raw, "<i8")
                total = own.copy() if total is None else total + own
        if total is not None:
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["token", "n"])

    return map_batches(counts, run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


# ------------------------------------------------------------------ writing


def shard_cuts(encoded: DataFrame, shards: int, rows: int) -> list[tuple[int, int]]:
    """At most ``shards - 1`` keys (``doc_id``, tie) that cut the rows into shards of about equal rows.

    The keys are sampled, about 100 a shard and ``SAMPLE_KEYS`` in all; they decide places only.
    """
    share = min(1.0, min(100 * shards, SAMPLE_KEYS) / max(rows, 1))
    keys = encoded.select("doc_id", "tie").sample(share, seed=7).collect()
    keys = sorted((_FIRST if r["doc_id"] is None else r["doc_id"], r["tie"]) for r in keys)
    return sorted({keys[len(keys) * i // shards] for i in range(1, shards)}) if keys else []


def write_token_file(
    df: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = "byte_bpe_50k.json",
    end_id: int = 0,
    max_bits: int = 16,
) -> None:
    """Write the ids of all documents in ascending ``doc_id`` order (see the module)."""
    spark = df.sparkSession
    table = write_table(encode_table(_texts(df, id_col, text_col), vocabulary, end_id), "ids", "snappy")
    encoded = spark.read.schema("doc_id long, tie long, ids binary").parquet(table).where("ids IS NOT NULL")
    enc = stretch_encoder(vocabulary)
    size, kind = enc.size, enc.kind
    counts = np.zeros(size, np.int64)
    noted = spark.read.schema("counts binary").parquet(table).where("counts IS NOT NULL")
    counted = id_counts(noted).collect()  # at most one row an id of the vocabulary
    for r in counted:
        counts[r["token"]] = r["n"]
    max_bits = max(max_bits, int(np.count_nonzero(counts) - 1).bit_length())
    if max_bits > 24:
        raise ValueError("codes of at most 24 bits are supported")
    lengths = code_lengths(counts, max_bits)
    spark.createDataFrame([(bytearray(lengths.tobytes()), max_bits)], "lengths binary, max_bits int").coalesce(
        1
    ).write.parquet(f"{path}/codes")

    tokens, partitions = int(counts.sum()), int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = max(1, tokens // SHARD_TOKENS, min(partitions, tokens // LEAST_TOKENS))
    cuts = shard_cuts(encoded, shards, int(counts[end_id]))

    def code(batches):
        codes = canonical_codes(lengths)
        for batch in batches:
            for k in range(0, batch.num_rows, PACK_TEXTS):
                some = batch.slice(k, PACK_TEXTS)
                ids, raw = some.column(0), some.column(2).to_pylist()
                n = np.array([len(x) // kind.itemsize for x in raw], np.int64)
                payload, sizes, offsets, marks = pack(np.frombuffer(b"".join(raw), kind), n, codes, lengths)
                ends, mark_ends = np.cumsum(sizes), np.cumsum(marks)
                shard = [bisect_left(cuts, (_FIRST if i is None else i, t)) for i, t in zip(ids.to_pylist(), some.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(shard, pa.int32()),
                        ids,
                        some.column(1),
                        pa.array(n.astype(np.int32)),
                        pa.array([offsets[b - m : b].tobytes() for b, m in zip(mark_ends, marks)], pa.binary()),
                        pa.array([payload[e - s : e] for e, s in zip(ends, sizes)], pa.binary()),
                    ],
                    names=["shard", "doc_id", "tie", "n", "offsets", "payload"],
                )

    coded = map_batches(
        encoded, code, "shard int, doc_id long, tie long, n int, offsets binary, payload binary"
    )

    schema = pa.schema(
        [
            ("shard", pa.int32()),
            ("block", pa.int32()),
            ("start", pa.int64()),
            ("n_tokens", pa.int64()),
            ("doc_ids", pa.list_(pa.int64())),
            ("counts", pa.list_(pa.int32())),
            ("sizes", pa.list_(pa.int32())),
            ("offsets", pa.binary()),
            ("payload", pa.binary()),
        ]
    )

    def block(shard, number, start, rows):
        ids, n, offsets, payload = (list(x) for x in zip(*rows))
        one = [shard, number, start, sum(n), ids, n, [len(p) for p in payload], b"".join(offsets), b"".join(payload)]
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(one, schema)], schema=schema)

    def blocks(batches):
        rows, tokens, shard, number, start = [], 0, None, 0, 0
        for batch in batches:
            for s, i, _, n, o, p in zip(*(c.to_pylist() for c in batch.columns)):
                if rows and (s != shard or tokens >= BLOCK_TOKENS):
                    yield block(shard, number, start, rows)
                    rows, tokens, number, start = [], 0, number + 1, start + tokens
                if s != shard:
                    shard, number, start = s, 0, 0
                rows.append((i, n, o, p))
                tokens += n
        if rows:
            yield block(shard, number, start, rows)

    placed = coded.repartitionById(shards, F.col("shard"))
    ordered = placed.sortWithinPartitions("shard", F.col("doc_id").asc_nulls_first(), "tie")
    map_batches(ordered, blocks, BLOCK_SCHEMA).write.option("compression", "none").parquet(f"{path}/blocks")
    drop_table(spark, table)


# ------------------------------------------------------------------ reading


def _codes(spark: SparkSession, path: str) -> tuple[np.ndarray, int]:
    row = spark.read.schema("lengths binary, max_bits int").parquet(f"{path}/codes").first()
    return np.frombuffer(bytes(row["lengths"]), np.uint8), int(row["max_bits"])


def _shard_starts(blocks: DataFrame) -> dict[int, int]:
    """Ids in front of each shard; one row a shard, that is a task of the write, reaches the driver."""
    starts, total = {}, 0
    for r in blocks.groupBy("shard").agg(F.sum("n_tokens").alias("n")).orderBy("shard").collect():
        starts[r["shard"]] = total
        total += r["n"]
    return starts


def read_token_file(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens`` and ``ids`` (array of int), or ``ids_crc32`` in its place if ``digest``."""
    lengths, max_bits = _codes(spark, path)
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks")
    starts = _shard_starts(blocks)
    rows = blocks.select("shard", "start", "doc_ids", "counts", "sizes", "offsets", "payload")

    def decode(batches):
        table = decode_table(lengths, max_bits)
        for batch in batches:
            for k in range(0, batch.num_rows, 16):
                part = batch.slice(k, 16)
                shard, before = part.column(0).to_pylist(), part.column(1).to_pylist()
                per_block = [len(x) for x in part.column(2)]
                doc_ids = part.column(2).flatten()
                n = part.column(3).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                sizes = part.column(4).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                offsets = np.frombuffer(b"".join(part.column(5).to_pylist()), "<u4").astype(np.int64)
                ids = unpack(b"".join(part.column(6).to_pylist()), sizes, n, offsets, table, max_bits).astype("<u4")
                ends = np.cumsum(n)
                first = np.cumsum([0, *per_block[:-1]])
                base = np.array([starts[s] + b for s, b in zip(shard, before)], np.int64)
                begin = ends - n
                start = begin + np.repeat(base - begin[first], per_block)
                if digest:
                    last = pa.array([zlib.crc32(ids[a:b]) for a, b in zip(begin, ends)], pa.int64())
                else:
                    last = pa.ListArray.from_arrays(
                        pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(ids.astype(np.int32))
                    )
                yield pa.RecordBatch.from_arrays(
                    [doc_ids, pa.array(start), pa.array(n), last],
                    names=["doc_id", "start", "n_tokens", "ids_crc32" if digest else "ids"],
                )

    kind = "ids_crc32 long" if digest else "ids array<int>"
    return map_batches(rows, decode, f"doc_id long, start long, n_tokens long, {kind}")


def op6_huffman_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "llm-token-file")
    write_token_file(read_input(spark, sf_dir, "documents"), path)
    return read_token_file(spark, path, digest=True)
