"""Sharding by histogram sort: probe key boundaries until the splitters fit, then exchange once.

Rows are ordered by (hash of the text, id).  A narrow table of keys and sizes is
written once.  Every round counts, across all partitions, the exact bytes and
rows between candidate boundaries, and puts new probes into the cells that are
too coarse: cells that hold an ideal splitter farther than ``tolerance`` from
both edges, and cells larger than a 128th of a shard (twice that at most).  A cell that
holds a single hash (one group of equal texts, however large) is probed by id.  The
counts that reach the driver, and the plan that reaches the tasks, are one row a
cell: their number follows the shards, never the data.

Splitters are the cell edges nearest the ideal byte positions, edges between
groups of equal texts being preferred within the tolerance; so equal texts share a
shard unless a splitter has to cut their group.  What is too much for one task in a
cell is cut into parts of evenly wide key ranges, whose rows are counted and summed
up by Spark in a table of its own.  Since the rows below every part are known
exactly, a row's slot is their count plus its place in the part: the documents'
one exchange is by cell and part.

Size is the UTF-8 bytes of the text plus 1 (null text: 1).  A null id sorts before
all others.  Rows that agree in text and id lie in one cell.  An empty table
gives an empty result.  Existing columns are kept; an added one whose name is
taken gets leading underscores.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import crc32_of, drop_table, fresh_name, map_batches, read_input, saved, utf8_bytes, write_table

SHARDS = 16
TOLERANCE = 0.005  # of an ideal shard
CELLS_PER_SHARD = 128
PART_BYTES = 128 << 20
ROW_BYTES = 64  # counted for a row beside its text when parts are made
LEAST, MOST = -(1 << 63), (1 << 63) - 1
STATS = "cell int, bytes long, n long, h0 long, h1 long, k0 long, k1 long"


@dataclass
class Cells:
    """Cells between sorted boundaries (hash, id), with what the last round counted in each that has rows."""

    h: np.ndarray  # lower bounds; the first is (LEAST, LEAST)
    k: np.ndarray

    def index(self, h: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The cell of each key: boundaries by hash first, by id among those of an equal hash."""
        low = np.searchsorted(self.h, h, side="left")
        high = np.searchsorted(self.h, h, side="right")
        out = high - 1
        for b in np.unique(low[high - low > 1]):
            rows = (low == b) & (high - low > 1)
            out[rows] = b - 1 + np.searchsorted(self.k[b : high[rows][0]], k[rows], side="right")
        one = high - low == 1
        out[one & (k < self.k[np.minimum(low, len(self.k) - 1)])] -= 1
        return out


def _count(keys: DataFrame, cells: Cells) -> np.ndarray:
    """One round: per cell that has rows (cell, bytes, rows, least and greatest hash and id), in order."""

    def run(batches):
        n = len(cells.h)
        size, rows = np.zeros(n, np.int64), np.zeros(n, np.int64)
        low = np.full((2, n), MOST, np.int64)
        high = np.full((2, n), LEAST, np.int64)
        for batch in batches:
            h, k, s = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            at = cells.index(h, k)
            size += np.bincount(at, s, n).astype(np.int64)
            rows += np.bincount(at, minlength=n)
            for j, v in enumerate((h, k)):
                np.minimum.at(low[j], at, v)
                np.maximum.at(high[j], at, v)
        used = np.flatnonzero(rows)
        columns = [used.astype(np.int32), size[used], rows[used], low[0][used], high[0][used], low[1][used], high[1][used]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["cell", "bytes", "n", "h0", "h1", "k0", "k1"])

    part = map_batches(keys, run, STATS)
    got = part.groupBy("cell").agg(
        F.sum("bytes").alias("bytes"), F.sum("n").alias("n"), F.min("h0"), F.max("h1"), F.min("k0"), F.max("k1")
    )
    return np.array(sorted(tuple(r) for r in got.collect()), np.int64).reshape(-1, 7)


def _between(low: int, high: int, parts: int) -> list[int]:
    """Up to ``parts - 1`` evenly spaced boundaries in (low, high]."""
    return sorted({low + (high - low + 1) * j // parts for j in range(1, parts)} - {low})


@dataclass
class Plan:
    cells: Cells
    shard: np.ndarray  # of each cell
    base: np.ndarray  # rows of the cell's shard below the cell
    rounds: int
    by_id: np.ndarray  # whether the cell holds a single hash, so that its parts are ranges of ids
    low: np.ndarray  # least hash (id) of the cell
    width: np.ndarray  # of its parts

    def place(self, h: np.ndarray, k: np.ndarray) -> dict[str, np.ndarray]:
        at = self.cells.index(h, k)
        above = (np.where(self.by_id[at], k, h) - self.low[at]).view(np.uint64)
        part = (above // self.width[at]).astype(np.int32)
        return {"cell": at.astype(np.int32), "part": part, "shard": self.shard[at], "base": self.base[at]}


def plan_shards(
    keys: DataFrame,
    shards: int,
    tolerance: float = TOLERANCE,
    cells_per_shard: int = CELLS_PER_SHARD,
    part_bytes: int = PART_BYTES,
) -> Plan:
    """Probe until every splitter fits and every cell is small (or holds a single key)."""
    cells, rounds = Cells(np.array([LEAST]), np.array([LEAST])), 0
    while True:
        found = _count(keys, cells)
        rounds += 1
        total, rows = int(found[:, 1].sum()), int(found[:, 2].sum())
        ideal = total / shards
        most_bytes, most_rows = 2 * ideal / cells_per_shard, 2 * rows / shards / cells_per_shard
        end = np.cumsum(found[:, 1])
        start = end - found[:, 1]
        probes = []
        for (_, size, n, h0, h1, k0, k1), a, b in zip(found.tolist(), start.tolist(), end.tolist()):
            i = int(a // ideal) + 1 if ideal else 1
            misses = []
            while i < shards and i * ideal < b:
                misses.append(min(i * ideal - a, b - i * ideal))
                i += 1
            coarse = max(size / max(most_bytes, 1e-9), n / max(most_rows, 1e-9))
            if (h0, k0) == (h1, k1) or n == 1:
                continue
            if coarse > 1 or max(misses, default=0) > tolerance * ideal:
                parts = int(min(4096, max(16, 4 * coarse)))
                probes += [(x, LEAST) for x in _between(h0, h1, parts)] if h0 < h1 else [(h0, x) for x in _between(k0, k1, parts)]
        if not probes:
            break
        bounds = sorted({*zip(cells.h.tolist(), cells.k.tolist()), *probes})
        cells = Cells(*(np.array(x, np.int64) for x in zip(*bounds)))
    # an edge stands below each cell that has rows; whole edges do not cut a group of equal texts
    whole = np.concatenate([[True], found[1:, 3] != found[:-1, 4]]) if len(found) else np.zeros(0, bool)
    shard_of, last = np.zeros(len(cells.h), np.int32), 0
    used = found[:, 0].astype(int)
    splits = []
    for i in range(1, shards):
        if not len(found):
            break
        far = np.abs(start - i * ideal)
        near = np.flatnonzero(whole & (far <= tolerance * ideal))
        at = int(near[np.argmin(far[near])]) if len(near) else int(np.argmin(np.append(far, abs(total - i * ideal))))
        last = max(last, at)
        splits.append(last)
    shard_used = np.searchsorted(np.array(splits, int), np.arange(len(found)), side="right").astype(np.int32)
    before = np.cumsum(found[:, 2]) - found[:, 2]
    first = np.searchsorted(shard_used, shard_used, side="left")
    base = np.zeros(len(cells.h), np.int64)
    shard_of[used], base[used] = shard_used, before - before[first] if len(found) else before
    by_id, low = np.zeros(len(cells.h), bool), np.zeros(len(cells.h), np.int64)
    width = np.ones(len(cells.h), np.uint64)
    for c, size, n, h0, h1, k0, k1 in found.tolist():
        by_id[c] = h0 == h1
        low[c], high = (k0, k1) if h0 == h1 else (h0, h1)
        parts = (size + ROW_BYTES * n) // part_bytes + 1
        width[c] = min((high - int(low[c])) // parts + 1, 2**64 - 1)
    return Plan(cells, shard_of, base, rounds, by_id, low, width)


def shard_rows(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shards: int = SHARDS,
    tolerance: float = TOLERANCE,
    cells_per_shard: int = CELLS_PER_SHARD,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """``df`` with ``shard`` (0..shards-1, near-equal bytes) and ``slot`` (0.. in the order of the shard)."""
    spark = df.sparkSession
    shard_col, slot_col = fresh_name(df, "shard"), fresh_name(df, "slot")
    h, k, at = fresh_name(df, "sort_hash"), fresh_name(df, "sort_id"), fresh_name(df, "sort_place")
    cell, part, below = fresh_name(df, "sort_cell"), fresh_name(df, "sort_part"), fresh_name(df, "sort_below")
    keyed = df.withColumn(h, F.xxhash64(F.col(f"`{text_col}`"))).withColumn(
        k, F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LEAST))
    )
    size = (utf8_bytes(F.col(f"`{text_col}`")) + 1).alias("size")
    path = write_table(keyed.select(F.col(h).alias("h"), F.col(k).alias("k"), size), "shard-keys")
    keys = spark.read.schema("h long, k long, size long").parquet(path)
    plan = plan_shards(keys, shards, tolerance, cells_per_shard, part_bytes)

    @F.pandas_udf("cell int, part int, shard int, base long")
    def place(hs, ks):
        import pandas as pd

        return pd.DataFrame(plan.place(hs.to_numpy(), ks.to_numpy()))

    parts = keys.select(place("h", "k").alias("at")).groupBy("at.cell", "at.part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("cell").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = saved(
        parts.select(
            F.col("cell").alias(cell),
            F.col("part").alias(part),
            F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias(below),
        ),
        "shard-parts",
    )
    drop_table(spark, path)

    out = keyed.withColumn(at, place(F.col(h), F.col(k)))
    out = out.withColumn(cell, F.col(at)["cell"]).withColumn(part, F.col(at)["part"]).join(parts, [cell, part])
    within = F.row_number().over(Window.partitionBy(cell, part).orderBy(h, k))
    return out.select(
        *[F.col(f"`{c}`") for c in df.columns],
        F.col(at)["shard"].alias(shard_col),
        (F.col(at)["base"] + F.col(below) + within - 1).alias(slot_col),
    )


def op1_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    docs = read_input(spark, sf_dir, "documents").select(
        "doc_id", "text", (utf8_bytes(text) + 1).alias("size"), crc32_of(text).alias("text_crc32")
    )
    return shard_rows(docs).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
