"""Helpers shared by the training-data operators: tables, shared folders, words.

Word rule used throughout: a word is a maximal run of characters other than
space and U+0009..U+000D (``[^\\x20\\x09-\\x0D]+``).  On UTF-8 bytes this is
exactly ``bytes.split()``.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.session import drop_path, scratch_path


def make_importable(spark: SparkSession) -> None:
    """Python workers on this machine find this package where the driver found it.

    On a cluster the package is shipped with the job (``--py-files``).
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH", "")) if x)


def read_input(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    make_importable(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def tokenizer_path(name: str) -> str:
    """Place of a vocabulary file; resolved where it is used (driver or task)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def write_table(df: DataFrame, name: str, compression: str = "zstd") -> str:
    """Write ``df`` as a parquet table under the shared checkpoint folder; returns its path.

    The write runs at once.  It cuts the lineage: whatever reads the table
    later does not go back to the source when an executor is lost.  The table is
    noted: `session.free_scratch`, or a `session.scratch` block around the job,
    removes it when the result has been written.
    """
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.option("compression", compression).parquet(path)
    return path


def kept_table(df: DataFrame, name: str, compression: str = "zstd") -> tuple[DataFrame, str]:
    """``df`` written to the shared folder and read back with its own schema; and the table's path."""
    spark, schema = df.sparkSession, df.schema
    path = write_table(df, name, compression)
    return spark.read.schema(schema).parquet(path), path


def saved(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    return kept_table(df, name, compression)[0]


def drop_table(spark: SparkSession, path: str) -> None:
    """Remove an intermediate table that nothing reads any more."""
    drop_path(spark, path)


def map_batches(
    df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``mapInArrow`` with this package importable in the workers, which give freed memory back after each task."""
    make_importable(df.sparkSession)

    def run(batches):
        try:
            yield from fn(batches)
        finally:
            release_memory()

    return df.mapInArrow(run, schema)


def release_memory() -> None:
    """Return what a task has freed to the system: the next task of this worker may be of another kind."""
    gc.collect()
    trim_memory()


def trim_memory() -> None:
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only the GNU library has it
        ctypes.CDLL(None).malloc_trim(0)


def fresh_name(df: DataFrame, base: str) -> str:
    """``base``, with underscores added until no column of ``df`` has that name (case-insensitive)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base = f"_{base}"
    return base


def utf8_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def crc32_of(text: Column) -> Column:
    return F.crc32(F.encode(F.coalesce(text, F.lit("")), "UTF-8"))


class RecentlyUsed(dict):
    """Cache of ``make(key)`` holding at most twice ``size`` entries: the newest, and those found again since."""

    def __init__(self, make: Callable, size: int):
        super().__init__()
        self.make, self.size, self.older = make, size, {}

    def __missing__(self, key):
        value = self.older.pop(key, None)
        if value is None:
            value = self.make(key)
        self.put(key, value)
        return value

    def put(self, key, value) -> None:
        if len(self) >= self.size:
            self.older = dict(self)
            self.clear()
        self[key] = value
