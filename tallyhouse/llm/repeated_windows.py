"""Substring dedup: a count-min sketch finds the word windows that may repeat, exact grouping settles them.

Texts are packed, with all columns of their rows, into compressed chunks of
bounded size (one table row each, written once).  All passes work on chunks:

1. Each chunk sketches its windows: ``DEPTH`` hash rows of cells, each cell with
   the number of its windows (documents that hold it counted once, at most 2:
   more is not needed).  As a partition sketch fills a small part of its cells it
   travels sparsely, as sorted cell numbers coded by their differences, split
   into ranges of cells.  The number of cells follows the number of windows of the
   corpus, the number of ranges the number of cells (see `sizes`), so a task
   merges a bounded range.  The merged sketch never leaves its range:
   it answers each chunk with a bit a cell, set if the count is at least 2.
2. A chunk's window whose cells are all answered with 1 may occur twice.  The
   estimate never falls below the true count, so no repeated window is lost.
   Only these windows go on, with the least document of the chunk, to be grouped by
   their words; the answer is a bit a window: a smaller ``doc_id`` holds it elsewhere.
   For the words stands the cryptographic digest (BLAKE2b, 16 bytes) of the words joined by
   single spaces: whole windows on their way would not fit the disk.  The quick
   polynomial hashes of the first pass can collide on chosen words; that only
   lets a window through to this pass.
3. Each chunk removes the words covered by such windows, and by windows whose first
   document is another one of the same chunk.

A window of ``width`` consecutive words of one document is removed with all its
words if the same words start in a document with a smaller id; all windows are
judged on the input.  Words: see `common`.

A null text has no words and is empty afterwards.  A null id is larger than all
others.  Rows of equal id count as one document: they never remove from each
other.  Empty tables give empty results; all columns keep their names, types and
values but the text.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.common import make_importable, map_batches, read_input, trim_memory, write_table

WIDTH = 13
CHUNK_BYTES = 2 << 20  # at least
CHUNK_ROWS = 10_000  # for every 2 MB
DEPTH = 2
LOAD = 4  # cells of a hash row for each window of the corpus
RANGE_ENTRIES = 1 << 19  # entries merged by a task, at least
MESSAGE_ENTRIES = 64  # wanted from each chunk for each range
WINDOW_BYTES = 6
NO_ID = (1 << 63) - 1
CHUNK_SCHEMA = "chunk long, n_windows long, rows binary"

# ------------------------------------------------------------------ words and windows

_ODD = (0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1)  # bases of the two hashes


def _mix(x: np.ndarray) -> np.ndarray:
    """Spread all bits of a number over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Digits:
    """Powers of a base and of its inverse modulo 2 ** 64, as many as were asked for."""

    def __init__(self, base: int):
        self.bases, self.tables = (base, pow(base, -1, 1 << 64)), [np.ones(1, np.uint64)] * 2

    def upto(self, n: int):
        if len(self.tables[0]) < n:
            n = max(n, 1 << 18)
            for i, base in enumerate(self.bases):
                out = np.full(n, base, np.uint64)
                out[0] = 1
                self.tables[i] = np.multiply.accumulate(out)
        return self.tables


_DIGITS = tuple(_Digits(b) for b in _ODD)
STEP_BYTES = 1 << 16  # so much at a time stays in the processor's cache


class Texts:
    """Words and window hashes of texts laid end to end, all texts of a chunk at once."""

    def __init__(self, texts: pa.Array, width: int = WIDTH):
        each = pc.fill_null(texts.cast(pa.large_string()), "").cast(pa.large_binary())
        lengths = pc.binary_length(each).to_numpy(zero_copy_only=False).astype(np.int64)
        self.raw = np.frombuffer(b" " + b" ".join(each.to_pylist()) + b" ", np.uint8)
        space = (self.raw == 32) | (self.raw - np.uint8(9) < 5)
        edge = np.flatnonzero(space[1:] ^ space[:-1]) + 1
        self.start, self.end = edge[0::2].copy(), edge[1::2].copy()
        last = np.searchsorted(self.start, np.cumsum(lengths + 1))  # a text's bytes end before its separator
        self.n_words = np.diff(last, prepend=0)
        self.n_docs, self.width = len(lengths), width
        self.doc = np.repeat(np.arange(self.n_docs), self.n_words)

    def word_hashes(self, which: int) -> np.ndarray:
        """A hash of each word: its bytes as digits, every word from the same power on."""
        size = self.end - self.start
        out = np.zeros(len(size), np.uint64)
        a = 0
        while a < len(size):
            b = max(a + 1, int(np.searchsorted(self.end, self.start[a] + STEP_BYTES)))
            lo, hi = int(self.start[a]), int(self.end[b - 1])
            power, back = _DIGITS[which].upto(hi - lo + 1)
            total = np.zeros(hi - lo + 1, np.uint64)
            np.cumsum((self.raw[lo:hi].astype(np.uint64) + np.uint64(1)) * power[: hi - lo], dtype=np.uint64, out=total[1:])
            s = self.start[a:b] - lo
            out[a:b] = (total[self.end[a:b] - lo] - total[s]) * back[s]
            a = b
        return _mix(out + size.astype(np.uint64) * np.uint64(_ODD[which]))

    def window_digests(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Both halves of a digest of the words of the windows at some places."""
        plain = b" ".join(self.raw.tobytes().split())
        size = self.end - self.start
        stop = np.cumsum(size + 1) - 1
        begin, end = (stop - size)[at], stop[at + self.width - 1] if len(at) else stop[:0]
        found = []
        for k in range(0, len(at), STEP_BYTES):
            some = zip(begin[k : k + STEP_BYTES].tolist(), end[k : k + STEP_BYTES].tolist())
            found.append(b"".join([hashlib.blake2b(plain[x:y], digest_size=16).digest() for x, y in some]))
        halves = np.frombuffer(b"".join(found), "<u8").reshape(-1, 2)
        return np.ascontiguousarray(halves[:, 0]), np.ascontiguousarray(halves[:, 1])

    def windows(self, which: int, at: np.ndarray | None = None) -> np.ndarray:
        """A hash of every window (also of those that leave their text), or of those at some places."""
        h, base = self.word_hashes(which), np.uint64(_ODD[1 - which])
        n = max(0, len(h) - self.width + 1) if at is None else len(at)
        out = np.zeros(n, np.uint64)
        for a in range(0, n, STEP_BYTES >> 2):
            b = min(n, a + (STEP_BYTES >> 2))
            part = out[a:b]
            for k in range(self.width):
                part *= base
                part += h[a + k : b + k] if at is None else h[at[a:b] + k]
        return _mix(out)

    def window_starts(self) -> np.ndarray:
        """Places (word numbers) of the windows that lie in one text."""
        n = max(0, len(self.start) - self.width + 1)
        return np.flatnonzero(self.doc[:n] == self.doc[self.width - 1 : self.width - 1 + n])


# ------------------------------------------------------------------ chunks


def _pack_rows(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _rows(blob: bytes) -> pa.Table:
    with pa.ipc.open_stream(blob) as stream:
        return stream.read_all()


def sizes(text_bytes: int) -> tuple[int, int]:
    """(bytes of a chunk, entries of a range) for a corpus.

    Both grow with its square root once it is large, so that a chunk still has
    about ``MESSAGE_ENTRIES`` entries for each range and neither the number of
    messages nor the size of a task's work gets out of hand: 2 MB and half a
    million up to some 20 GB of text, about 124 MB and 52 million at 100 TB.
    """
    windows = math.isqrt(int(MESSAGE_ENTRIES / 2.5 * text_bytes / WINDOW_BYTES))
    return max(CHUNK_BYTES, WINDOW_BYTES * windows), max(RANGE_ENTRIES, int(2.5 * windows))


def chunk_table(df: DataFrame, text_at: int, width: int, chunk_bytes: int) -> DataFrame:
    """Rows of ``df`` packed into chunks of at most about ``chunk_bytes`` of text (or one longer row)."""
    chunk_rows = CHUNK_ROWS * max(1, chunk_bytes >> 21)

    def run(batches):
        from pyspark import TaskContext

        part, number, waiting, held, rows = TaskContext.get().partitionId(), 0, [], 0, 0

        def chunk():
            table = pa.Table.from_batches(waiting)
            words = Texts(table.column(text_at).combine_chunks(), width).n_words
            windows = int(np.maximum(words - width + 1, 0).sum())
            blob = _pack_rows(table)
            return pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) + number], pa.int64()), pa.array([windows], pa.int64()), pa.array([blob], pa.binary())],
                names=["chunk", "n_windows", "rows"],
            )

        for batch in batches:
            size = pc.fill_null(pc.binary_length(batch.column(text_at)), 0).to_numpy(zero_copy_only=False)
            a, total = 0, np.cumsum(size)
            while a < batch.num_rows:
                room = chunk_bytes - held + (total[a - 1] if a else 0)
                b = int(np.searchsorted(total, room, side="right"))
                b = min(max(b, a + (not waiting)), a + chunk_rows - rows)
                if b > a:
                    waiting.append(batch.slice(a, b - a))
                    held += int(total[b - 1] - (total[a - 1] if a else 0))
                    rows += b - a
                if b < batch.num_rows or held >= chunk_bytes or rows >= chunk_rows:
                    yield chunk()
                    number, waiting, held, rows = number + 1, [], 0, 0
                a = max(b, a)
        if waiting:
            yield chunk()

    return map_batches(df, run, CHUNK_SCHEMA)


# ------------------------------------------------------------------ sketches


def _encode(sorted_values: np.ndarray) -> bytes:
    """Sorted numbers as differences, byte planes apart, compressed."""
    d = np.diff(sorted_values, prepend=np.uint64(0)).astype("<u8")
    used = max(1, (int(d.max()).bit_length() + 7) // 8) if len(d) else 1
    planes = np.ascontiguousarray(d.view(np.uint8).reshape(-1, 8)[:, :used].T)
    return bytes([used]) + zstandard.compress(planes.tobytes(), 1)


def _decode(blob: bytes) -> np.ndarray:
    used = blob[0]
    planes = np.frombuffer(zstandard.decompress(blob[1:]), np.uint8).reshape(used, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :used] = planes.T
    return np.cumsum(out.view("<u8").ravel(), dtype=np.uint64)


def _cells(windows: np.ndarray, row: int, bits: int) -> np.ndarray:
    """The cell of each window in one hash row of the sketch."""
    x = windows if row == 0 else _mix(windows ^ np.uint64(0xA0761D6478BD642F * row & (2**64 - 1)))
    return x >> np.uint64(64 - bits)


def _groups(keys: np.ndarray):
    """(order, first of each run, run number of each in order) of the sorted keys."""
    by = np.argsort(keys)
    k = keys[by]
    new = np.concatenate([[True], k[1:] != k[:-1]]) if len(k) else np.zeros(0, bool)
    return by, np.flatnonzero(new), np.cumsum(new) - 1


def _held_twice(keys: np.ndarray, docs: np.ndarray):
    """Distinct keys in order, and which of them two documents of the chunk hold."""
    by, first, _ = _groups(keys)
    if not len(first):
        return keys, np.zeros(0, bool)
    d = docs[by]
    return keys[by[first]], np.minimum.reduceat(d, first) != np.maximum.reduceat(d, first)


def _doc_keys(table: pa.Table, id_at: int) -> np.ndarray:
    ids = pc.fill_null(table.column(id_at).combine_chunks().cast(pa.int64()), NO_ID)
    return ids.to_numpy(zero_copy_only=False)


def _merge_range(key, table):
    """One range of one hash row: add the partition sketches up, answer each chunk."""
    trim_memory()  # what the range before has freed
    chunks, sent, twice = (table.column(c).to_pylist() for c in ("chunk", "cells", "twice"))
    each = [_decode(b) for b in sent]
    n = [len(x) for x in each]
    cells = np.concatenate(each)
    more = np.concatenate([np.unpackbits(np.frombuffer(t, np.uint8), count=m) for t, m in zip(twice, n)])
    by, first, run = _groups(cells)
    counts = np.add.reduceat(1 + more[by].astype(np.int64), first)
    answer = np.empty(len(cells), bool)
    answer[by] = (counts >= 2)[run]
    ends = np.cumsum(n)
    bits = [np.packbits(answer[e - m : e]).tobytes() for e, m in zip(ends, n)]
    return pa.table(
        {
            "chunk": pa.array(chunks, pa.int64()),
            "row": pa.array([key[0].as_py()] * len(chunks), pa.int32()),
            "part": pa.array([key[1].as_py()] * len(chunks), pa.int64()),
            "bits": pa.array(bits, pa.binary()),
        }
    )


ANSWER_SCHEMA = "chunk long, row int, part long, bits binary"


def _exact_groups(h: np.ndarray, g: np.ndarray):
    """Like `_groups` of the pairs (h, g)."""
    by, first, run = _groups(h)
    g_in_order = g[by]
    if len(first) and (g_in_order != g_in_order[first][run]).any():  # equal first halves only: all but impossible
        by = np.lexsort((g, h))
        new = np.concatenate([[True], (h[by][1:] != h[by][:-1]) | (g[by][1:] != g[by][:-1])])
        first, run = np.flatnonzero(new), np.cumsum(new) - 1
    return by, first, run


def _merge_exact(key, table):
    """One range of exact windows: the least id that holds each, and whether it is less than a chunk's own.

    Ranges below 0 are not windows but what chunks noted for themselves.
    """
    trim_memory()
    part, chunks, sent = key[0].as_py(), table.column("chunk").to_pylist(), table.column("windows").to_pylist()
    bits = sent
    if part >= 0:
        raw = [np.frombuffer(b, [("h", "<u8"), ("g", "<u8"), ("id", "<i8")]) for b in sent]
        rows = np.concatenate(raw)
        ids = rows["id"]
        by, first, run = _exact_groups(np.ascontiguousarray(rows["h"]), np.ascontiguousarray(rows["g"]))
        answer = np.empty(len(rows), bool)
        answer[by] = np.minimum.reduceat(ids[by], first)[run] < ids[by]
        ends = np.cumsum([len(x) for x in raw])
        bits = [np.packbits(answer[e - len(x) : e]).tobytes() for e, x in zip(ends, raw)]
    return pa.table(
        {
            "chunk": pa.array(chunks, pa.int64()),
            "row": pa.array([DEPTH] * len(chunks), pa.int32()),
            "part": pa.array([max(part, -1)] * len(chunks), pa.int64()),
            "bits": pa.array(bits, pa.binary()),
        }
    )


def _split(values: np.ndarray, cuts: np.ndarray):
    """(part, from, to) of the sorted values that fall into each part, empty parts left out."""
    at = np.searchsorted(values, cuts, side="left").tolist()
    for part, (a, b) in enumerate(zip([0, *at], [*at, len(values)])):
        if b > a:
            yield part, a, b


def _cuts(parts: int, bits: int) -> np.ndarray:
    return np.array([(i << bits) // parts for i in range(1, parts)], np.uint64)


class Plan:
    """Sizes that follow from the number of windows."""

    def __init__(self, windows: int, id_at: int, text_at: int, width: int, range_entries: int = RANGE_ENTRIES):
        self.id_at, self.text_at, self.width = id_at, text_at, width
        self.bits = max(8, math.ceil(math.log2(max(1, LOAD * windows))))
        self.ranges = max(1, -(-windows // range_entries))

    def chunk(self, blob: bytes):
        """(rows, texts, window places, window hashes, document of each window)."""
        table = _rows(blob)
        texts = Texts(table.column(self.text_at).combine_chunks(), self.width)
        at = texts.window_starts()
        return table, texts, at, texts.windows(0)[at], texts.doc[at]

    def maybe(self, windows: np.ndarray, answers: list) -> np.ndarray:
        """The windows all of whose cells the merged sketch counts twice or more."""
        out = np.ones(len(windows), bool)
        for row in range(DEPTH):
            cells = _cells(windows, row, self.bits)
            by, first, run = _groups(cells)
            distinct = cells[by[first]]
            held = np.zeros(len(distinct), bool)
            mine = {a["part"]: a["bits"] for a in answers if a["row"] == row}
            for part, a, b in _split(distinct, _cuts(self.ranges, self.bits)):
                held[a:b] = np.unpackbits(np.frombuffer(mine[part], np.uint8), count=b - a)
            out[by] &= held[run]
        return out

    def candidates(self, texts: Texts, places, ids):
        """Windows that may repeat, by their places: distinct digests (both halves, in order), least id
        in the chunk, and which of them each place has."""
        h, g = texts.window_digests(places)
        own = ids[texts.doc[places]]
        by, first, run = _exact_groups(h, g)
        which = np.empty(len(h), np.int64)
        which[by] = run
        least = np.minimum.reduceat(own[by], first) if len(first) else own
        return h[by[first]], g[by[first]], least, which


def _with_answers(chunks: DataFrame, answers: DataFrame) -> DataFrame:
    """Chunks with the answers they were given (bounded: a bit a window); chunks without windows have none."""
    a = answers.groupBy("chunk").agg(F.collect_list(F.struct("row", "part", "bits")).alias("answers"))
    return chunks.join(a, "chunk", "left")


def remove_repeats(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, digest: bool = False
) -> DataFrame:
    """``df`` with repeated windows taken out of the text (kept words joined by one space).

    With ``digest``: ``doc_id, n_words, n_removed, kept_sha256`` in its place.
    Texts without any removed word are kept as they are unless ``digest``.
    """
    spark = df.sparkSession
    make_importable(spark)
    id_at, text_at = df.columns.index(id_col), df.columns.index(text_col)
    text_bytes = df.agg(F.sum(F.octet_length(F.col(f"`{text_col}`").cast("string")))).first()[0] or 0
    chunk_bytes, range_entries = sizes(text_bytes)
    path = write_table(chunk_table(df, text_at, width, chunk_bytes), "chunks", "none")
    chunks = spark.read.schema(CHUNK_SCHEMA).parquet(path)
    plan = Plan(chunks.agg(F.sum("n_windows")).first()[0] or 0, id_at, text_at, width, range_entries)

    def sketch(batches):
        for batch in batches:
            for chunk, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                table, _, _, windows, docs = plan.chunk(blob.as_py())
                by_id = _doc_keys(table, id_at)[docs]
                for row in range(DEPTH):
                    cells, twice = _held_twice(_cells(windows, row, plan.bits), by_id)
                    sent = [
                        (chunk, row, part, _encode(cells[a:b]), np.packbits(twice[a:b]).tobytes())
                        for part, a, b in _split(cells, _cuts(plan.ranges, plan.bits))
                    ]
                    if sent:
                        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, k) for c, k in zip(zip(*sent), kinds)], names=["chunk", "row", "part", "cells", "twice"]
                        )

    sketches = map_batches(chunks.select("chunk", "rows"), sketch, "chunk long, row int, part long, cells binary, twice binary")
    first_answers = sketches.groupBy("row", "part").applyInArrow(_merge_range, ANSWER_SCHEMA)

    def exact(batches):
        for batch in batches:
            for chunk, blob, answers in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                if not answers:
                    continue
                table, texts, at, windows, _ = plan.chunk(blob.as_py())
                maybe = plan.maybe(windows, answers)
                h, g, least, _ = plan.candidates(texts, at[maybe], _doc_keys(table, id_at))
                rows = np.empty(len(h), [("h", "<u8"), ("g", "<u8"), ("id", "<i8")])
                rows["h"], rows["g"], rows["id"] = h, g, least
                sent = [(chunk, part, rows[a:b].tobytes()) for part, a, b in _split(h, _cuts(plan.ranges, 64))]
                if sent:  # and for the last pass: which windows these were
                    sent.append((chunk, -1 - chunk % plan.ranges, np.packbits(maybe).tobytes()))
                    kinds = (pa.int64(), pa.int64(), pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*sent), kinds)], names=["chunk", "part", "windows"]
                    )

    asked = map_batches(
        _with_answers(chunks.select("chunk", "rows"), first_answers), exact, "chunk long, part long, windows binary"
    )
    second_answers = asked.groupBy("part").applyInArrow(_merge_exact, ANSWER_SCHEMA)

    def settle(batches):
        for batch in batches:
            for blob, answers in zip(batch.column(0), batch.column(1).to_pylist()):
                table, texts, at, windows, docs = plan.chunk(blob.as_py())
                gone = np.zeros(len(texts.start) + 1, np.int64)
                if answers:
                    ids = _doc_keys(table, id_at)
                    mine = {a["part"]: np.frombuffer(a["bits"], np.uint8) for a in answers}
                    maybe = np.unpackbits(mine[-1], count=len(at)).astype(bool)
                    places = at[maybe]
                    h, _, least, which = plan.candidates(texts, places, ids)
                    elsewhere = np.zeros(len(h), bool)
                    for part, a, b in _split(h, _cuts(plan.ranges, 64)):
                        elsewhere[a:b] = np.unpackbits(mine[part], count=b - a)
                    repeated = places[elsewhere[which] | (least[which] < ids[docs[maybe]])]
                    np.add.at(gone, repeated, 1)
                    np.add.at(gone, np.minimum(repeated + width, len(gone) - 1), -1)
                yield from _result(table, texts, np.cumsum(gone[:-1]) > 0)

    def _result(table, texts, gone):
        ends = np.cumsum(texts.n_words)
        raw, start, end = texts.raw.tobytes(), texts.start.tolist(), texts.end.tolist()
        removed = np.bincount(texts.doc, gone, texts.n_docs).astype(np.int64)
        old = None if digest else table.column(text_at).to_pylist()
        kept = []
        for i, (e, n) in enumerate(zip(ends.tolist(), texts.n_words.tolist())):
            if not digest and not removed[i]:
                kept.append(old[i] or "")
                continue
            if removed[i]:
                words = [raw[start[w] : end[w]] for w in (np.flatnonzero(~gone[e - n : e]) + e - n).tolist()]
                text = b" ".join(words)
            else:
                text = b" ".join(raw[start[e - n] : end[e - 1]].split()) if n else b""
            kept.append(hashlib.sha256(text).hexdigest() if digest else text.decode())
        if digest:
            columns = [table.column(id_at).combine_chunks().cast(pa.int64()), pa.array(texts.n_words, pa.int64()), pa.array(removed), pa.array(kept)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_removed", "kept_sha256"])
        else:
            new = table.set_column(text_at, table.schema.field(text_at), pa.array(kept, table.schema.field(text_at).type))
            yield from new.combine_chunks().to_batches()

    ready = _with_answers(chunks.select("chunk", "rows"), second_answers).select("rows", "answers")
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" if digest else df.schema
    return map_batches(ready, settle, schema)


def op5_repeated_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_input(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs, digest=True)
