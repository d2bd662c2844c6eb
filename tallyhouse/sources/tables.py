"""Table scans: metastore tables and day partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Whole metastore (or temp-view) table."""
    return spark.table(name)


def read_partition(spark: SparkSession, name_or_path: str, ds: str, *, fmt: str | None = None) -> DataFrame:
    """One ``ds`` partition of a table (by name) or of a partitioned path.

    The equality on the partition column is a literal, so the scan prunes to
    that directory (``PartitionFilters`` in the plan).
    """
    if fmt is None:
        df = spark.table(name_or_path)
    else:
        df = spark.read.format(fmt).load(name_or_path)
    return df.where(F.col("ds") == F.lit(ds))

