"""Benchmark decontamination by the q-gram lemma on diagonal bands, verified by banded alignment.

Texts and items are compared in lower case with white-space runs as one space.  An
item of ``n`` characters may differ from its place in a document by ``e`` edits
(``EDIT_SHARE`` of ``n``).  An alignment with at most ``e`` edits keeps at least
``n - q + 1 - q * e`` of the item's q-grams, all on ``e + 1`` neighbouring diagonals
(document place minus item place).  Shared q-grams are counted in bands of
``2 * (e + 1)`` diagonals that overlap by half, so some band holds all of them; bands
that reach the bound are aligned with the item inside their diagonals only, and
those within ``e`` edits are matches.

The items are the query set: they go to every task in blocks of at most about
``BLOCK_CHARS`` characters, a pass over the documents for each block, so documents
are never shuffled.  For short items the budget shrinks until the bound is at
least 1; items shorter than ``q`` must occur as they are.

Null and empty texts and items match nothing.  Repeated documents or items repeat
their matches.  Empty tables give empty results.  `clean_documents` keeps all
columns, whatever their names.
"""

from __future__ import annotations

import bisect
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.common import map_batches, read_input

Q = 10
EDIT_SHARE = 0.08
BLOCK_CHARS = 4_000_000
GROUP_CHARS = 400_000
FILTER_BITS = 22
PAIRS = 1 << 19  # hits paired with places in items at a time
_BASE = np.uint64(0x9E3779B97F4A7C15)


def normal(text: str | None) -> str:
    return " ".join(text.lower().split()) if text else ""


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def gram_hashes(codes: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit hash of every q-gram; candidates it lets through by chance do not pass the alignment."""
    n = len(codes) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    c = codes.astype(np.uint64)
    h = c[:n].copy()
    for k in range(1, q):
        h *= _BASE
        h += c[k : k + n]
    return h ^ (h >> np.uint64(29))


def budget(n: int, q: int = Q, share: float = EDIT_SHARE) -> int:
    return max(0, min(int(share * n), (n - q) // q))


def banded_edits(item: np.ndarray, text: np.ndarray, first: int, width: int, most: int) -> tuple[int, int]:
    """(least edits, end in the text) of the whole item against any part of the text.

    Only cells on the diagonals ``first .. first + width - 1`` are computed.
    (``most + 1``, -1) if the least is more than ``most``.
    """
    big = len(item) + len(text) + 1
    k = np.arange(width)
    place = first + k  # characters of the text used before the item's first
    row = np.where((place >= 0) & (place <= len(text)), 0, big)
    for j, c in enumerate(item.tolist()):
        at = j + place  # the character of the text on each diagonal
        inside = (at >= 0) & (at < len(text))
        same = np.zeros(width, bool)
        same[inside] = text[at[inside]] == c
        step = np.where(inside, row + ~same, big)
        drop = np.append(row[1:], big) + 1
        drop[(at + 1 < 0) | (at + 1 > len(text))] = big
        best = np.minimum(step, drop)
        row = np.minimum(np.minimum.accumulate(best - k) + k, big)
        if row.min() > most:
            return most + 1, -1
    end = int(np.argmin(row))
    return int(row[end]), int(len(item) + place[end])


@dataclass
class Items:
    """One block of benchmark items and their q-gram index."""

    ids: list
    texts: list[str]
    q: int = Q
    share: float = EDIT_SHARE

    def __post_init__(self):
        self.codes = [_codes(t) for t in self.texts]
        self.edits = np.array([budget(len(c), self.q, self.share) for c in self.codes], np.int64)
        size = np.array([len(c) for c in self.codes], np.int64)
        self.size = size
        # no region that is within its item's edits, and no stretch that is aligned for it, is longer
        self.reach = int((size + 4 * self.edits + 4).max()) if len(size) else 1
        self.need = np.maximum(1, size - self.q + 1 - self.q * self.edits)
        self.short = [i for i, n in enumerate(size.tolist()) if 0 < n < self.q]
        grams = [gram_hashes(c, self.q) for c in self.codes]
        h = np.concatenate([*grams, np.zeros(0, np.uint64)])
        item = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        place = np.concatenate([*(np.arange(len(g)) for g in grams), np.zeros(0, np.int64)])
        by = np.argsort(h, kind="stable")
        self.item, self.place = item[by], place[by]
        self.grams, self.first, self.count = np.unique(h[by], return_index=True, return_counts=True)
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[(self.grams >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True

    def matches(self, texts: list[str]) -> list[tuple]:
        """(row, item, start, end, edits) of the verified regions, the best of each (row, item) first.

        Long runs of one character are searched in a shortened form (see `short_runs`), and q-gram
        hits are paired with the items a bounded number of pairs at a time.
        """
        short, moved = zip(*(short_runs(t, self.reach) for t in texts)) if texts else ((), ())
        out = []
        for row, item, start, end, edits in self._matches(list(short)):
            last = moved[row](end)
            out.append((row, item, last - (end - start), last, edits))
        return sorted(out)

    def _matches(self, texts: list[str]) -> list[tuple]:
        codes = [_codes(t) for t in texts]
        size = np.array([len(c) for c in codes], np.int64)
        first = np.cumsum(size) - size
        joined = np.concatenate([*codes, np.zeros(0, np.uint32)])
        h = gram_hashes(joined, self.q)
        best: dict[tuple[int, int], tuple] = {}
        hit = np.flatnonzero(self.filter[(h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)]) if len(self.grams) else []
        if len(hit):
            g = np.searchsorted(self.grams, h[hit])
            g[g == len(self.grams)] = 0
            true = self.grams[g] == h[hit]
            hit, g = hit[true], g[true]
            row = np.searchsorted(first, hit, side="right") - 1
            fits = hit - first[row] + self.q <= size[row]  # a q-gram of one text
            self._count(texts, codes, hit[fits] - first[row[fits]], g[fits], row[fits], best)
        out = [(r, i, *v) for (r, i), v in best.items()]
        for i in self.short:
            out += [(r, i, a, a + len(self.texts[i]), 0) for r, t in enumerate(texts) if (a := t.find(self.texts[i])) >= 0]
        return out

    def _count(self, texts, codes, hit, g, row, best) -> None:
        """Count hits by (row, item, band) and verify the bands with enough, ``PAIRS`` pairs at a time.

        Hits come in text order, so a band is complete once the hits are an item's length past it;
        only bands that may still grow are carried along.  Items found verbatim in a row need no more of its hits.
        """
        at, open_keys, open_count = 0, np.zeros((3, 0), np.int64), np.zeros(0, np.int64)
        found = np.zeros(0, np.int64)  # row * items + item of verbatim matches
        pairs = np.cumsum(self.count[g])
        while at < len(hit):
            done = int(pairs[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(pairs, done + PAIRS, side="right")))
            n = self.count[g[at:to]]
            # a hit may meet every place of a frequent q-gram: those of items already found verbatim are left out first
            place = np.repeat(self.first[g[at:to]] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            r, item = np.repeat(row[at:to], n), self.item[place]
            if len(found):
                new = ~np.isin(r * len(self.ids) + item, found)
                place, r, item = place[new], r[new], item[new]
                where = np.repeat(hit[at:to], n)[new]
            else:
                where = np.repeat(hit[at:to], n)
            band = (where - self.place[place]) // (self.edits[item] + 1)
            keys = np.stack([np.repeat(r, 2), np.repeat(item, 2), np.stack([band, band - 1], 1).ravel()])
            keys, count = _count_columns(np.hstack([open_keys, keys]), np.concatenate([open_count, np.ones(keys.shape[1], np.int64)]))
            at = to
            if at < len(hit):
                low = keys[2] * (self.edits[keys[1]] + 1)
                closed = (keys[0] < row[at]) | (low + 2 * (self.edits[keys[1]] + 1) + self.size[keys[1]] < hit[at])
            else:
                closed = np.ones(keys.shape[1], bool)
            self._verify(texts, codes, keys[:, closed & (count >= self.need[keys[1]])], best)
            found = np.array([k[0] * len(self.ids) + k[1] for k, v in best.items() if v[2] == 0 and at < len(hit) and k[0] >= row[at]], np.int64)
            open_keys, open_count = keys[:, ~closed], count[~closed]
            if len(found) and open_keys.shape[1]:
                left = ~np.isin(open_keys[0] * len(self.ids) + open_keys[1], found)
                open_keys, open_count = open_keys[:, left], open_count[left]

    def _verify(self, texts, codes, bands, best) -> None:
        seen: dict[tuple[int, str], tuple[int, int]] = {}  # the same stretch against the same item: aligned once
        for row, item, band in bands.T.tolist():
            edits, size = int(self.edits[item]), len(self.codes[item])
            known = best.get((row, item))
            if known and known[2] == 0:
                continue
            low, width = band * (edits + 1), 2 * (edits + 1)
            a, b = max(0, low - edits), low + width + size + edits
            same = texts[row].find(self.texts[item], a, b)
            if same >= 0:
                best[row, item] = (same, same + size, 0)
                continue
            if low - edits >= 0 and b <= len(texts[row]):
                key = (item, texts[row][a:b])
                if key not in seen:
                    least, end = banded_edits(self.codes[item], codes[row][a:b], 0, width + 2 * edits, edits)
                    seen[key] = least, end
                least, end = seen[key]
                end = end + a if least <= edits else end
            else:
                least, end = banded_edits(self.codes[item], codes[row], low - edits, width + 2 * edits, edits)
            if least <= edits and (known is None or least < known[2]):
                best[row, item] = (max(0, end - size), end, least)


def short_runs(text: str, reach: int):
    """The text with every run of one character cut to ``2 * reach`` characters, and a function that
    takes places back.

    No region that can match an item is longer than ``reach``, so each stretch of that length of
    the text, and its first place, is still there: one inside a long run like all others inside it.
    """
    codes = _codes(text)
    some = codes[::reach]  # a run that is too long holds two neighbours of these
    if len(text) <= 2 * reach or not (some[1:] == some[:-1]).any():
        return text, int
    edges = np.concatenate([[0], np.flatnonzero(codes[1:] != codes[:-1]) + 1, [len(codes)]])
    parts, cuts, gone, last = [], [], [0], 0
    for k in np.flatnonzero(np.diff(edges) > 2 * reach).tolist():
        a, b = int(edges[k]), int(edges[k + 1])
        parts.append(text[last : a + reach])
        cuts.append(a + reach - gone[-1])
        gone.append(gone[-1] + b - a - 2 * reach)
        last = b - reach
    parts.append(text[last:])
    return "".join(parts), lambda place: place + gone[bisect.bisect_left(cuts, place)]


def _count_columns(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct columns, in order, and the sum of their weights."""
    by = np.lexsort(keys[::-1])
    k = keys[:, by]
    new = np.concatenate([[True], (k[:, 1:] != k[:, :-1]).any(axis=0)]) if k.shape[1] else np.zeros(0, bool)
    first = np.flatnonzero(new)
    return k[:, first], np.add.reduceat(weights[by], first) if len(first) else weights


def item_blocks(benchmark: DataFrame, chars: int = BLOCK_CHARS):
    """The items, a block of bounded size at a time: the only rows that reach the driver."""
    items = benchmark.selectExpr("cast(item_id as long) AS item_id", "cast(text as string) AS text").where("length(text) > 0")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-total // chars))
    for b in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b) if blocks > 1 else items
        rows = sorted(((r["item_id"], normal(r["text"])) for r in part.collect()), key=repr)
        if rows:
            yield [r[0] for r in rows], [r[1] for r in rows]


def _grouped(texts: list[str | None]):
    """(first row, normal texts), about ``GROUP_CHARS`` characters at a time."""
    start, some, held = 0, [], 0
    for row, t in enumerate(texts):
        some.append(normal(t))
        held += len(some[-1])
        if held >= GROUP_CHARS:
            yield start, some
            start, some, held = row + 1, [], 0
    if some:
        yield start, some


def find_leaks(
    df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", q: int = Q, share: float = EDIT_SHARE
) -> DataFrame:
    """``doc_id, item_id, start, end, edits``: each item found in each document, its best region in the normal text."""
    schema = "doc_id long, item_id long, `start` long, `end` long, edits int"
    out = None
    for ids, item_texts in item_blocks(benchmark):

        def run(batches, ids=ids, item_texts=item_texts):
            items = Items(ids, item_texts, q, share)
            for batch in batches:
                doc_ids = batch.column(0).to_pylist()
                for first, texts in _grouped(batch.column(1).to_pylist()):
                    got = items.matches(texts)
                    if got:
                        row, item, start, end, edits = zip(*got)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([doc_ids[first + r] for r in row], pa.int64()),
                                pa.array([items.ids[i] for i in item], pa.int64()),
                                pa.array(start, pa.int64()),
                                pa.array(end, pa.int64()),
                                pa.array(edits, pa.int32()),
                            ],
                            names=["doc_id", "item_id", "start", "end", "edits"],
                        )

        src = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
        part = map_batches(src, run, schema)
        out = part if out is None else out.union(part)
    return df.sparkSession.createDataFrame([], schema) if out is None else out


def clean_documents(
    df: DataFrame, benchmark: DataFrame, text_col: str = "text", q: int = Q, share: float = EDIT_SHARE
) -> DataFrame:
    """``df`` without the documents that hold an item; one narrow pass a block of items."""
    at = df.columns.index(text_col)
    for ids, item_texts in item_blocks(benchmark):

        def run(batches, ids=ids, item_texts=item_texts):
            items = Items(ids, item_texts, q, share)
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for first, texts in _grouped(batch.column(at).to_pylist()):
                    keep[[first + m[0] for m in items.matches(texts)]] = False
                yield batch.filter(pa.array(keep))

        df = map_batches(df, run, df.schema)
    return df


def op3_qgram_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(read_input(spark, sf_dir, "documents"), read_input(spark, sf_dir, "benchmark"))
