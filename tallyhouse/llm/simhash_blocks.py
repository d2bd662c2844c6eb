"""SimHash near-duplicates by pigeonhole blocks.

A text's fingerprint is the bitwise majority of the XXH64 hashes of its word
shingles.  Fingerprints are cut into more blocks than bits may differ, so a close
pair agrees on at least ``blocks - max_bits`` blocks: fingerprints are joined on
every choice of that many blocks and each pair met is verified by its Hamming
distance, at the first choice on which it agrees.  The number of blocks follows the
number of distinct fingerprints, so that chance meetings stay few at any size.

A bucket of more than ``BUCKET`` fingerprints would make a number of pairs that
grows with its square.  Its fingerprints are linked in another exact way: two of
them differ in at most ``max_bits`` = 4 bits exactly if some value differs from
either in at most 2, so each is filed under all 2081 values near it (at most as many
can meet under one value) and neighbours there are linked.  Every such link joins
fingerprints within ``max_bits``, and no link between components is lost.

Copies share a fingerprint and take part once.  Links are exchanged and
merged as tables (`connected_components`); nothing is gathered on the driver but
the number of fingerprints.

A null text has no words, like an empty one: fingerprint zero, linked like any
other.  A null id is larger than all others; a component of such rows alone has
a null id.  Repeated rows share a component; an empty table gives an empty result.
Other columns are not read, whatever their names.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import drop_table, fresh_name, kept_table, map_batches, read_input, saved
from tallyhouse.llm.components import connected_components

SHINGLE = 4
MAX_BITS = 4
SEED = 42
BUCKET = 512  # comparing so many a bucket costs less than the 2081 rows of the other way
GROUP_TEXTS = 128


def text_fingerprints(texts: list[str | None], shingle: int = SHINGLE) -> np.ndarray:
    """64-bit fingerprints: a bit is set if it is set in over half of the shingle hashes."""
    from xxhash import xxh64_intdigest

    hashes: list[int] = []
    counts = np.zeros(len(texts), np.int64)
    for row, text in enumerate(texts):
        words = text.encode().lower().split() if text else []  # bytes: only A-Z change, only ASCII white space splits
        if not words:
            continue
        joined = b" ".join(words)
        if len(words) <= shingle:
            hashes.append(xxh64_intdigest(joined, SEED))
            counts[row] = 1
            continue
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = np.concatenate([[0], ends[: len(words) - shingle]]).tolist()
        hashes += [xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, (ends[shingle - 1 :] - 1).tolist())]
        counts[row] = len(words) - shingle + 1
    out = np.zeros(len(texts), np.uint64)
    full = np.flatnonzero(counts)
    if len(full):
        bits = np.unpackbits(np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
        first = np.cumsum(counts[full]) - counts[full]
        ones = np.add.reduceat(bits, first, axis=0, dtype=np.int32)
        out[full] = np.packbits(2 * ones > counts[full][:, None], axis=1).view(">u8").ravel()
    return out


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, text_hash, fp`` of every row."""

    def run(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, GROUP_TEXTS):
                some = batch.slice(k, GROUP_TEXTS)
                fp = text_fingerprints(some.column(2).to_pylist(), shingle).view(np.int64)
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array(fp)], names=["doc_id", "text_hash", "fp"])

    src = df.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_hash(text_col).alias("text_hash"), F.col(f"`{text_col}`").cast("string").alias("text")
    )
    return map_batches(src, run, "doc_id long, text_hash long, fp long")


def text_hash(text_col: str = "text"):
    return F.xxhash64(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))


def block_masks(distinct: int, max_bits: int = MAX_BITS) -> list[int]:
    """Masks of every choice of ``blocks - max_bits`` blocks; a choice has a bit more than counting them needs."""
    need = max(1, distinct).bit_length() + 1
    blocks = max_bits + 1
    while blocks < 16 and (64 // blocks) * (blocks - max_bits) < need:
        blocks += 1
    edges = [64 * i // blocks for i in range(blocks + 1)]
    one = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    masks = [sum(c) for c in combinations(one, blocks - max_bits)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _signed(values) -> str:
    return "array(" + ", ".join(f"cast({v} as bigint)" if v > -(1 << 63) else f"shiftleft(1L, 63)" for v in values) + ")"


def near_values(max_bits: int = MAX_BITS) -> list[int]:
    """All values with at most half of ``max_bits`` bits set, as signed numbers."""
    found = [sum(1 << i for i in c) for n in range(max_bits // 2 + 1) for c in combinations(range(64), n)]
    return [v - (1 << 64) if v >> 63 else v for v in found]


def links(distinct: DataFrame, n: int, max_bits: int = MAX_BITS, bucket: int = BUCKET) -> tuple[DataFrame, str]:
    """``a, b``: links whose components are those of all pairs within ``max_bits``; and the table they read.

    ``distinct``: ``fp``, unique.
    """
    if max_bits % 2:
        raise ValueError("an even number of bits is supported")
    masks = block_masks(n, max_bits)
    keys = distinct.selectExpr("fp", f"posexplode({_signed(masks)}) AS (choice, mask)").selectExpr(
        "choice", "fp & mask AS part", "fp"
    )
    met = keys.groupBy("choice", "part").agg(F.count("*").alias("n")).where("n > 1")
    both, path = kept_table(keys.join(met, ["choice", "part"]), "simhash-buckets")
    cold = both.where(F.col("n") <= bucket).select("choice", "part", "fp")
    other = cold.select("choice", "part", F.col("fp").alias("b"))
    pairs = cold.withColumnRenamed("fp", "a").join(other, ["choice", "part"])
    first = f"array_position(transform({_signed(masks)}, m -> ((a ^ b) & m) = 0), true) = choice + 1"
    pairs = pairs.where(f"a < b AND bit_count(a ^ b) <= {max_bits}").where(first).select("a", "b")
    hot = both.where(F.col("n") > bucket).select("fp").distinct()
    near = np.array(near_values(max_bits), np.int64)

    def file_under(batches):
        for batch in batches:
            fps = batch.column(0).to_numpy()
            for k in range(0, len(fps), 64):
                some = fps[k : k + 64]
                yield pa.RecordBatch.from_arrays(
                    [pa.array((some[:, None] ^ near[None, :]).ravel()), pa.array(np.repeat(some, len(near)))],
                    names=["value", "fp"],
                )

    filed = map_batches(hot, file_under, "value long, fp long")
    near_by = Window.partitionBy("value").orderBy("fp")
    beside = filed.select(F.lag("fp").over(near_by).alias("a"), F.col("fp").alias("b")).where("a is not null").distinct()
    return pairs.union(beside), path


def near_duplicates(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
    bucket: int = BUCKET,
) -> DataFrame:
    """``doc_id, text_hash, fingerprint, component_id, representative`` of every row.

    ``representative`` marks the least (doc_id, text_hash) of each component;
    rows that agree in both are marked together.
    """
    rows = saved(fingerprints(df, id_col, text_col, shingle), "simhash")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("least")
    distinct = saved(rows.groupBy("fp").agg(least), "simhash-distinct")
    linked, path = links(distinct.select("fp"), distinct.count(), max_bits, bucket)
    roots = connected_components(linked)
    drop_table(df.sparkSession, path)
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    chosen = rooted.groupBy("root").agg(F.min("least").alias("chosen"))
    of_fp = rooted.select("fp", "root").join(chosen, "root").select("fp", "chosen")
    out = rows.join(of_fp, "fp")
    return out.select(
        "doc_id",
        "text_hash",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("chosen.doc_id").alias("component_id"),
        (F.col("doc_id").eqNullSafe(F.col("chosen.doc_id")) & (F.col("text_hash") == F.col("chosen.text_hash"))).alias("representative"),
    )


def one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``df`` without the rows that are not their component's representative; equal (id, text) rows become one."""
    chosen = near_duplicates(df, id_col, text_col, **options).where("representative").select("doc_id", "text_hash").distinct()
    # joined and made distinct by the same two hashes, so that texts are exchanged once
    h, k, right_h, right_k = (fresh_name(df, n) for n in ("text_hash", "row_hash", "chosen_text_hash", "chosen_row_hash"))
    row_hash = F.xxhash64(F.col(f"`{id_col}`").cast("long"), F.col(h))
    left = df.withColumn(h, text_hash(text_col)).withColumn(k, row_hash)
    right = chosen.select(F.xxhash64("doc_id", "text_hash").alias(right_k), F.col("text_hash").alias(right_h))
    same = (F.col(k) == F.col(right_k)) & (F.col(h) == F.col(right_h))
    return left.join(right, same, "left_semi").dropDuplicates([k, h]).select(*[F.col(f"`{c}`") for c in df.columns])


def op8_simhash_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_input(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")
