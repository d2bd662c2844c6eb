"""Session helpers for local runs, tests and the benchmark."""

from __future__ import annotations

import atexit
import contextlib
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tallyhouse") -> SparkSession:
    """A local session with the settings the jobs are tuned for.

    On a cluster the session comes from ``spark-submit``, which names the
    shared folder in ``spark.checkpoint.dir``.
    """
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("TALLYHOUSE_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Uses ``spark.checkpoint.dir`` as configured for the cluster.  Where it is
    unset, a session in local mode (tests, single machine) gets a fresh
    temporary folder, removed when the program ends; on a cluster that folder
    would lie on one machine only, so an unset setting raises.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path
    master = spark.conf.get("spark.master", "") or ""
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="tallyhouse-ckpt-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-path of the checkpoint folder for a written table.

    The path is noted, so that `free_scratch` or a `scratch` block can remove the
    table once nothing reads it any more.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/{name}-{uuid.uuid4().hex}"
    _SCRATCH.append(path)
    return path


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a table of files, if it is there, and forget that it was noted."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    if path in _SCRATCH:
        _SCRATCH.remove(path)


def free_scratch(spark: SparkSession, since: int = 0) -> None:
    """Remove the intermediate tables this program has written (all but the first ``since``).

    A returned DataFrame may read such a table until its result is written, so the
    caller says when: after writing the result, or by a `scratch` block around the job.
    """
    for path in _SCRATCH[since:]:
        drop_path(spark, path)


@contextlib.contextmanager
def scratch(spark: SparkSession):
    """Intermediate tables written inside the block are removed at its end, also after an error."""
    mark = len(_SCRATCH)
    try:
        yield
    finally:
        free_scratch(spark, mark)


def materialize(df, name: str):
    """Write ``df`` as parquet under the checkpoint folder and read it back.

    The write runs at once, when this is called.  Used where one intermediate feeds several consumers: it is computed once,
    its lineage is cut (a lost executor does not send recomputation back to
    the fact scan), and the planner sees its real size."""
    return _written(df, scratch_path(df.sparkSession, name))


def _written(df, path: str):
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def computed_once(df, name: str):
    """``df`` materialized for a block that writes it several times, and removed at the block's
    end, also after an error; what leaves the block must not read it lazily."""
    path = scratch_path(df.sparkSession, name)
    try:
        yield _written(df, path)
    finally:
        drop_path(df.sparkSession, path)
