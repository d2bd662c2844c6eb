"""Quality selection by ordinal cumulative-link regression over hashed text.

A document rated on an ordered scale has ``P(grade <= k) = s(t_k - w.x)``: one
weight vector ``w`` for all grades, ordered thresholds ``t_k``, ``s`` the logistic
function.  ``x`` is the text hashed into ``DIMENSIONS`` places: whole words in lower
case, the shape and the ending of each word, whether it repeats the word before,
and the size of the text; counts are damped (log) and scaled to length 1.  The
model gives the tail probabilities ``P(grade >= k)`` and from their sum the
expected grade; a document is kept if ``P(grade >= KEEP_GRADE)`` is at least
``KEEP_TAIL``.

Grades come from the labels: 0 low quality, 1 good but toxic, 2 good.  The fit uses
at most about ``SAMPLE`` rated documents, chosen by a hash of the id; only their
hashed counts (``DIMENSIONS`` places a document) reach the driver.  All documents
are scored in one narrow pass over their whole text.

Null and empty texts have no words, only the feature of their size.  Labels
without a quality do not count; of several labels of an id the greatest grade
does.  With ratings of fewer than two grades every document gets the grade seen
(or 0) for certain.  Repeated rows give repeated results, empty tables empty results.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.common import map_batches, read_input

SAMPLE = 12_000
DIMENSIONS = 2048
KEEP_GRADE, KEEP_TAIL = 1, 0.5
STEPS, RATE, RIDGE = 250, 0.1, 1e-4
CACHE_WORDS = 400_000


def place(kind: str, value: str) -> int:
    return zlib.crc32(f"{kind}\0{value}".encode()) % DIMENSIONS


def shape(word: str) -> str:
    """Letters as a or A, digits as 0, other characters as they are, runs as one."""
    out = []
    for c in word:
        s = ("A" if c.isupper() else "a") if c.isalpha() else "0" if c.isdigit() else c
        if not out or out[-1] != s:
            out.append(s)
    return "".join(out)


class HashedText:
    """Feature counts of texts; the places of each word are worked out once a worker."""

    def __init__(self):
        self.row: dict[str, int] = {}
        self.places = np.zeros((1024, 3), np.int32)

    def _learn(self, word: str) -> int:
        n = len(self.row)
        if n == len(self.places):
            self.places = np.concatenate([self.places, np.zeros_like(self.places)])
        low = word.lower()
        self.places[n] = place("word", low), place("shape", shape(word)), place("end", low[-3:])
        self.row[word] = n
        return n

    def counts(self, text: str | None) -> np.ndarray:
        words = text.split() if text else []
        n = len(words)
        if len(self.row) > CACHE_WORDS:
            self.row.clear()
        known = self.row.get
        rows = [known(w, -1) for w in words]
        if -1 in rows:
            rows = [r if r >= 0 else known(w, -1) if w in self.row else self._learn(w) for r, w in zip(rows, words)]
        at = np.array(rows, np.int64)
        out = np.bincount(self.places[at].ravel(), minlength=DIMENSIONS).astype(np.float32) if n else np.zeros(DIMENSIONS, np.float32)
        again = int(np.count_nonzero(at[1:] == at[:-1])) if n > 1 else 0
        size = n.bit_length()
        out[place("size", str(size))] += 4
        if n:
            out[place("again", str(min(10, 10 * again // n)))] += 1 + n // 8
            fresh = len(set(rows))
            out[place("fresh", str(10 * fresh // n))] += 1 + n // 8
        return out

    def vectors(self, texts: list[str | None]) -> np.ndarray:
        x = np.log1p(np.array([self.counts(t) for t in texts], np.float32).reshape(-1, DIMENSIONS))
        return x / np.maximum(1e-9, np.sqrt((x * x).sum(axis=1, keepdims=True)))


_HASHED: list[HashedText] = []


def hashed_text() -> HashedText:
    if not _HASHED:
        _HASHED.append(HashedText())
    return _HASHED[0]


def _s(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class CumulativeLink:
    weights: np.ndarray
    thresholds: np.ndarray  # ascending; one fewer than grades

    def tails(self, x: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, .. of each row."""
        return 1 - _s(self.thresholds[None, :] - (x @ self.weights)[:, None])


def fit_link(x: np.ndarray, grade: np.ndarray, grades: int, steps: int = STEPS) -> CumulativeLink:
    """Most likely weights and ordered thresholds, by Adam on the whole sample.

    The thresholds are the first one and the logarithms of the gaps, so they
    stay in order.
    """
    n, d = x.shape
    share = np.clip(np.array([(grade <= k).mean() for k in range(grades - 1)]), 1e-3, 1 - 1e-3)
    start = np.log(share / (1 - share))
    gaps = np.log(np.maximum(np.diff(start), 1e-2))
    p = np.concatenate([np.zeros(d), start[:1], gaps])
    m, v = np.zeros_like(p), np.zeros_like(p)
    rows = np.arange(n)
    for step in range(1, steps + 1):
        w, first, gap = p[:d].astype(np.float32), p[d], np.exp(p[d + 1 :])
        t = first + np.concatenate([[0], np.cumsum(gap)])
        z = (x @ w).astype(np.float64)
        c = np.concatenate([np.zeros((n, 1)), _s(t[None, :] - z[:, None]), np.ones((n, 1))], axis=1)
        likely = np.maximum(c[rows, grade + 1] - c[rows, grade], 1e-9)
        slope = c * (1 - c)
        up, down = slope[rows, grade + 1] / likely, slope[rows, grade] / likely
        dz = (up - down) / n  # of minus the log likelihood
        dt = np.array([(np.where(grade == k + 1, down, 0) - np.where(grade == k, up, 0)).sum() / n for k in range(grades - 1)])
        later = np.cumsum(dt[::-1])[::-1]
        g = np.concatenate([x.T @ dz.astype(np.float32) + 2 * RIDGE * w, later[:1], later[1:] * gap])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return CumulativeLink(p[:d].astype(np.float32), p[d] + np.concatenate([[0], np.cumsum(np.exp(p[d + 1 :]))]))


def graded(labels: DataFrame) -> DataFrame:
    """``doc_id, grade``: 0 low quality, 1 good but toxic, 2 good (not known to be toxic)."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).otherwise(2)
    return (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max(grade).alias("grade"))
    )


def fit(docs: DataFrame, ratings: DataFrame, bound: int = SAMPLE) -> CumulativeLink:
    """``docs``: doc_id, text.  ``ratings``: doc_id, grade (0, 1, ..)."""
    total = ratings.count()
    if total > bound:
        ratings = ratings.where(F.pmod(F.xxhash64("doc_id", F.lit("rated")), F.lit(1 << 30)) < int((1 << 30) * bound / total))

    def run(batches):
        hashed = hashed_text()
        for batch in batches:
            sparse = []
            for t in batch.column(1).to_pylist():
                c = hashed.counts(t)
                at = np.flatnonzero(c)
                sparse.append(at.astype("<u2").tobytes() + c[at].astype("<f4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sparse, pa.binary())], names=["grade", "counts"])

    # about ``bound`` rows of two numbers: small enough for every task, so texts stay where they are
    rows = docs.join(F.broadcast(ratings), "doc_id").select("grade", "text")
    # in one order whatever the partitions were, so that the fit is the same again
    sample = sorted(map_batches(rows, run, "grade int, counts binary").collect(), key=lambda r: (r["grade"], bytes(r["counts"])))
    grade = np.array([r["grade"] for r in sample], np.int64)
    grades = int(grade.max()) + 1 if len(grade) else 1
    if len(set(grade.tolist())) < 2:
        sure = np.array([-30.0 if k < grades - 1 else 30.0 for k in range(max(1, grades - 1))])
        return CumulativeLink(np.zeros(DIMENSIONS, np.float32), sure if len(grade) and grades > 1 else np.array([30.0]))
    x = np.zeros((len(sample), DIMENSIONS), np.float32)
    for i, r in enumerate(sample):
        raw = bytes(r["counts"])
        n = len(raw) // 6
        x[i, np.frombuffer(raw[: 2 * n], "<u2")] = np.frombuffer(raw[2 * n :], "<f4")
    np.log1p(x, out=x)
    x /= np.maximum(1e-9, np.sqrt((x * x).sum(axis=1, keepdims=True)))
    return fit_link(x, grade, grades)


def score_documents(df: DataFrame, model: CumulativeLink, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, expected_grade, tail_1, tail_2, .., kept`` of every row."""
    n = len(model.thresholds)

    def run(batches):
        hashed = hashed_text()
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                some = batch.slice(k, 256)
                tails = model.tails(hashed.vectors(some.column(1).to_pylist())).astype(float)
                kept = tails[:, min(KEEP_GRADE, n) - 1] >= KEEP_TAIL
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array(tails.sum(axis=1)), *(pa.array(np.ascontiguousarray(c)) for c in tails.T), pa.array(kept)],
                    names=["doc_id", "expected_grade", *[f"tail_{i}" for i in range(1, n + 1)], "kept"],
                )

    tails = ", ".join(f"tail_{i} double" for i in range(1, n + 1))
    src = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return map_batches(src, run, f"doc_id long, expected_grade double, {tails}, kept boolean")


def op4_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_input(spark, sf_dir, "documents")
    model = fit(docs.select("doc_id", "text"), graded(read_input(spark, sf_dir, "labels")))
    return score_documents(docs, model)
