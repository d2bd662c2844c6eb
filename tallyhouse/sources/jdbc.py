"""JDBC sources.  Connection settings always come from the caller."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def read_jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    options: Mapping[str, str] | None = None,
    *,
    fetch_size: int = 10000,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """Read a table (or ``(subquery) alias``) over JDBC.

    ``options`` carries driver, user, password and any URL flags.  A numeric
    ``partition_column`` with bounds splits the read into parallel range
    queries; without it the read is one task, fine for lookup tables.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).option("fetchsize", str(fetch_size))
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    if partition_column is not None:
        if lower_bound is None or upper_bound is None or num_partitions is None:
            raise ValueError("partition_column needs lower_bound, upper_bound and num_partitions")
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", str(lower_bound))
            .option("upperBound", str(upper_bound))
            .option("numPartitions", str(num_partitions))
        )
    return reader.load()


def read_release_dates(spark: SparkSession, url: str, table: str, options: Mapping[str, str] | None = None) -> DataFrame:
    """The per-city release-date table, with its columns named by position:
    ``city_id`` (long), ``new_updated`` and ``second_updated`` (date)."""
    df = read_jdbc_table(spark, url, table, options)
    a, b, c = df.columns[:3]
    return df.select(
        df[a].cast("bigint").alias("city_id"),
        df[b].cast("date").alias("new_updated"),
        df[c].cast("date").alias("second_updated"),
    )
