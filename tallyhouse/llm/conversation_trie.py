"""Prefix trie of conversations: sorted turn sequences, their LCPs, and range minima in a sparse table.

1. Turns become 16 bytes each (SHA-256 of role and text, cut) with the code points of
   their text; texts go no further.  A conversation is its turns in order, rebuilt with
   the head of the conversation of its hundred.
2. Equal sequences become one row: number, least id, and the digest of the ids, which are
   sorted over ranges and digested as a stream of runs, so the ids of a sequence that a third
   of all conversations share are never held together.
3. Distinct sequences are sorted as bytes and cut into parts of about ``PART_BYTES`` (range
   partitions, written once).  A part learns the last sequence before it and the
   first behind it.
4. Within a part, LCPs of neighbours go into a sparse table of range minima.  Every
   prefix of every sequence is a candidate and finds the left and right end of its
   member interval by binary search over that table, on its own, without a stack.
   A candidate whose interval begins at its own sequence is a node.  Members, least ids,
   leaves, children and saved tokens are differences of running sums, or range
   minima, over the interval.
5. Nodes whose interval reaches into a neighbouring part, at most a path a border, are
   summed up over parts; all others are complete.

Turns are ordered by number (null first), ties by role and then by the text's digest;
a null role or text is empty.  Rows without ``conv_id`` belong to no conversation.
Repeated rows are turns of their own.  Empty tables give no nodes.  Only conv_id, turn,
role and text are read, so other columns may have any name.  A task holds 16 bytes a
turn of one part, and of one conversation however long.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import kept_table, map_batches, read_input

HUNDRED = 100
HEADS = 6  # a rebuilt conversation begins with fewer turns than this of its hundred's first
WIDTH = 16
PART_BYTES = 1 << 24
ID_RUN = 4_096
NO_ENDS = hashlib.sha256(b"").hexdigest()


def conversation_turns(df: DataFrame) -> DataFrame:
    """``conv_id, turns``: per conversation its turns in order, as (turn, role, digest, points)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    own = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turn = F.struct(
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        F.substring(F.unhex(F.sha2(own, 256)), 1, WIDTH).alias("digest"),
        F.char_length(text).alias("points"),
    )
    rows = df.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("turn"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))


def head_turns(conv_id: Column) -> Column:
    return (F.crc32(conv_id.cast("string").cast("binary")) % HEADS).cast("int")


def rebuilt(turns: DataFrame) -> DataFrame:
    """``conv_id, path, points``: head of the hundred's first conversation, then the own turns behind that many.

    ``path`` is the turns' digests end to end, so that bytes sort as sequences do.
    """
    base = turns.where(F.col("conv_id") % HUNDRED == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, HEADS - 1).alias("head")
    )
    h = head_turns(F.col("conv_id"))
    joined = turns.withColumn("base", F.col("conv_id") - F.col("conv_id") % HUNDRED).join(base, "base", "left")
    head = F.slice(F.coalesce("head", F.slice("turns", 1, 0)), F.lit(1), h)
    own = F.slice("turns", h + 1, F.greatest(F.size("turns"), h) - h)
    return joined.select("conv_id", F.concat(head, own).alias("turns")).select(
        "conv_id",
        F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["digest"])), "")).alias("path"),
        F.transform("turns", lambda t: t["points"]).alias("points"),
    )


def distinct_sequences(paths: DataFrame) -> DataFrame:
    """``path, points, n, least, ends``: each sequence once, its conversations, and the digest of their ids.

    Ids are sorted over ranges of (sequence, id), so those of one sequence spread over tasks, which
    write them as text, ``ID_RUN`` in a row.  Only these rows of text meet by sequence, to be digested
    one behind the other: a digest over an order cannot be split.
    """

    most = ID_RUN

    def write(batches):
        now, run = None, []

        def row():
            text = b",".join(b"%d" % c for c in run)
            return pa.RecordBatch.from_arrays(
                [pa.array([now], pa.binary()), pa.array([run[0]], pa.int64()), pa.array([len(run)], pa.int64()), pa.array([text], pa.binary())],
                names=["key", "least", "n", "ids"],
            )

        for batch in batches:
            for key, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if run and (key != now or len(run) == most):
                    yield row()
                    run = []
                now = key
                run.append(conv)
        if run:
            yield row()

    def digest(batches):
        now, sha, n, least, done = None, None, 0, 0, []

        def rows():
            out = pa.RecordBatch.from_arrays(
                [pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.int64()), pa.array([d[2] for d in done], pa.string())],
                names=["conv_id", "n", "ends"],
            )
            done.clear()
            return out

        for batch in batches:
            for key, first, count, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if key == now:
                    sha.update(b"," + ids)
                    n += count
                    continue
                if now is not None:
                    done.append((least, n, sha.hexdigest()))
                now, sha, n, least = key, hashlib.sha256(ids), count, first
            if len(done) > 10_000:
                yield rows()
        if now is not None:
            done.append((least, n, sha.hexdigest()))
        yield rows()

    key = F.unhex(F.sha2(F.col("path"), 256))
    ids = paths.select(key.alias("key"), "conv_id").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    runs = map_batches(ids, write, "key binary, least long, n long, ids binary")
    runs = runs.repartition("key").sortWithinPartitions("key", "least")
    ends = map_batches(runs, digest, "conv_id long, n long, ends string")
    return ends.join(paths, "conv_id").select("path", "points", "n", F.col("conv_id").alias("least"), "ends")


# ------------------------------------------------------------------ one part


def common_turns(x: bytes, y: bytes) -> int:
    n, k = min(len(x), len(y)), 0
    while k < n and x[k : k + WIDTH] == y[k : k + WIDTH]:
        k += WIDTH
    return k // WIDTH


def sparse_table(values: np.ndarray) -> list[np.ndarray]:
    """Level k holds the minimum of each 2^k neighbours."""
    levels = [values]
    while 2 << (len(levels) - 1) <= len(values):
        half = 1 << (len(levels) - 1)
        levels.append(np.minimum(levels[-1][:-half], levels[-1][half:]))
    return levels


def range_min(levels: list[np.ndarray], first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Minimum of each [first, last]."""
    k = np.frexp((last - first + 1).astype(np.float64))[1] - 1
    out = np.empty(len(first), levels[0].dtype)
    for level in np.unique(k):
        at = np.flatnonzero(k == level)
        out[at] = np.minimum(levels[level][first[at]], levels[level][last[at] + 1 - (1 << level)])
    return out


def extents(levels: list[np.ndarray], row: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last sequence that share ``depth`` turns with sequence ``row``.

    ``levels`` is the sparse table of the LCP of each sequence with the one before it (0 for
    the first).  Each search halves its step, and goes on where the minimum over the step allows it.
    """
    n = len(levels[0])
    left, right = row.copy(), row.copy()
    for k in reversed(range(len(levels))):
        step, table = 1 << k, levels[k]
        to = right + step
        ok = to < n
        ok[ok] = table[right[ok] + 1] >= depth[ok]  # LCPs right+1 .. right+step
        right = np.where(ok, to, right)
        to = left - step
        ok = to >= 0
        ok[ok] = table[to[ok] + 1] >= depth[ok]  # LCPs left-step+1 .. left
        left = np.where(ok, to, left)
    return left, right


def part_nodes(paths: list[bytes], points: list[list[int]], n: np.ndarray, least: np.ndarray, before, behind) -> dict:
    """The nodes of sorted distinct sequences, by column; ``before`` and ``behind`` are the neighbouring parts' paths or None."""
    rows = len(paths)
    size = np.array([len(p) // WIDTH for p in paths], np.int64)
    lcp = np.array([0] + [common_turns(x, y) for x, y in zip(paths, paths[1:])], np.int64)
    from_before = -1 if before is None else common_turns(before, paths[0])
    to_behind = -1 if behind is None else common_turns(paths[-1], behind)
    levels = sparse_table(lcp)

    # candidates: every prefix of every sequence, depth 0 .. size
    count = size + 1
    start = np.cumsum(count) - count
    row = np.repeat(np.arange(rows), count)
    depth = np.arange(int(count.sum())) - np.repeat(start, count)
    left, right = extents(levels, row, depth)
    node = left == row

    # running code points within each sequence, and sums over sequences
    flat = np.concatenate([np.asarray(p, np.int64) for p in points] + [np.zeros(0, np.int64)])
    upto = np.concatenate([[0], np.cumsum(flat)])
    first_turn = np.cumsum(size) - size

    def points_to(r, d):  # code points of the first d turns of sequence r
        return upto[first_turn[r] + d] - upto[first_turn[r]]

    whole = points_to(np.arange(rows), size)
    met = lcp.copy()  # turns of each sequence that an earlier one has shown
    met[0] = max(from_before, 0)
    fresh = whole - points_to(np.arange(rows), met)
    leaf = np.append(lcp[1:], max(to_behind, 0)) < size
    leaf[-1] |= to_behind < 0
    sums = {k: np.concatenate([[0], np.cumsum(v)]) for k, v in {"n": n, "np": n * whole, "fresh": fresh, "leaf": leaf.astype(np.int64)}.items()}

    at = np.flatnonzero(node)
    l, r, d = left[at], right[at], depth[at]

    def over(key):
        return sums[key][r + 1] - sums[key][l]

    above = points_to(l, np.maximum(d - 1, 0))
    goes_on = (l == 0) & (from_before >= d)  # begun in an earlier part
    own = np.where(goes_on, fresh[l], whole[l] - above)
    members = over("n")
    saved = (over("np") - members * above) - (over("fresh") - fresh[l] + own)
    open_ = goes_on | ((r == rows - 1) & (to_behind >= d))
    ends_here = size[l] == d

    # a node's parent is the candidate one turn shorter of the same row, filed at that one's left end
    place = np.full(len(node), -1, np.int64)
    place[at] = np.arange(len(at))
    deep = d > 0
    shorter = at[deep] - 1
    parent = place[start[left[shorter]] + depth[shorter]]
    children = np.bincount(parent[~goes_on[deep]], minlength=len(at))
    table = sparse_table(least)
    low = range_min(table, l, r)

    def digest(i, k):
        return hashlib.sha256(paths[i][: k * WIDTH]).digest()[:WIDTH]

    key = [digest(i, k) for i, k in zip(l.tolist(), d.tolist())]
    parent_key, parent_conv = [None] * len(at), [None] * len(at)
    for i, p in zip(np.flatnonzero(deep).tolist(), parent.tolist()):
        parent_key[i] = key[p]
        if not open_[p]:
            parent_conv[i] = int(low[p])
    return {
        "node": key, "parent": parent_key, "parent_conv_id": parent_conv, "open": open_, "conv_id": low, "depth": d,
        "n_convs": members, "n_children": children, "n_leaves": over("leaf"), "saved_tokens": saved,
        "ends_row": np.where(ends_here, l, -1),
    }


NODE_SCHEMA = (
    "node binary, parent binary, parent_conv_id long, open boolean, conv_id long, depth long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, ends string"
)


def local_nodes(parts: DataFrame, borders: DataFrame) -> DataFrame:
    """Nodes of every part; those that reach into a neighbour are marked open."""

    def run(table: pa.Table, border: pa.Table) -> pa.Table:
        rows, border = sorted(table.to_pylist(), key=lambda x: x["path"]), border.to_pylist()[0]
        n, least = (np.array([x[c] for x in rows], np.int64) for c in ("n", "least"))
        found = part_nodes([x["path"] for x in rows], [x["points"] for x in rows], n, least, border["before"], border["behind"])
        ends = [rows[i]["ends"] if i >= 0 else None for i in found.pop("ends_row").tolist()]
        kinds = {"node": pa.binary(), "parent": pa.binary(), "open": pa.bool_()}
        arrays = {c: pa.array(v, kinds.get(c, pa.int64())) for c, v in found.items()}
        return pa.table(arrays | {"ends": pa.array(ends, pa.string())})

    return parts.groupBy("part").cogroup(borders.groupBy("part")).applyInArrow(run, NODE_SCHEMA)


# ------------------------------------------------------------------ all parts


def sorted_parts(sequences: DataFrame, part_bytes: int) -> tuple[DataFrame, DataFrame]:
    """Distinct sequences cut into ranges by a part number; and per part the neighbouring paths on either side."""
    size = sequences.agg(F.sum(F.octet_length("path") + 64)).first()[0] or 0
    cut = sequences.repartitionByRange(max(1, -(-int(size) // part_bytes)), "path").withColumn("part", F.spark_partition_id())
    cut, _ = kept_table(cut, "trie-parts")
    ends = cut.groupBy("part").agg(F.min("path").alias("low"), F.max("path").alias("high"))
    w = Window.orderBy("part")  # one row a part
    return cut, ends.select("part", F.lag("high").over(w).alias("before"), F.lead("low").over(w).alias("behind"))


def conversation_trie(df: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """A row a node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    paths, _ = kept_table(rebuilt(conversation_turns(df)), "trie-paths")
    sequences, _ = kept_table(distinct_sequences(paths), "trie-sequences")
    nodes, _ = kept_table(local_nodes(*sorted_parts(sequences, part_bytes)), "trie-nodes")
    merged = nodes.where("open").groupBy("node").agg(
        F.max("parent").alias("parent"),
        F.max("parent_conv_id").alias("parent_conv_id"),
        F.min("conv_id").alias("conv_id"),
        F.max("depth").alias("depth"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.max("ends").alias("ends"),
    )
    over = merged.select(F.col("node").alias("parent"), F.col("conv_id").alias("open_parent"))
    whole = nodes.where("NOT open").drop("open").unionByName(merged)
    known = whole.where("parent IS NULL OR parent_conv_id IS NOT NULL").withColumn("open_parent", F.lit(None).cast("long"))
    asked = whole.where("parent IS NOT NULL AND parent_conv_id IS NULL").join(over, "parent")
    return known.unionByName(asked).select(
        "conv_id",
        "depth",
        F.coalesce("parent_conv_id", "open_parent").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"),
    )


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(read_input(spark, sf_dir, "conversations"))
