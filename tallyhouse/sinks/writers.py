"""Sinks of the metrics table."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.schema import METRIC_COLUMNS, METRICS_SCHEMA
from tallyhouse.sources.text import NULL_TOKEN, delimited_fields_sql


def lines_table(name: str) -> str:
    """The catalog table that holds the lines of text table ``name``."""
    return f"{name}_lines"


def create_metrics_table(spark: SparkSession, name: str, *, location: str | None = None, text: bool = False) -> None:
    """``CREATE TABLE IF NOT EXISTS`` for the metrics table, partitioned by ``ds``.

    ``text=True`` keeps it as tab-delimited text with ``\\N`` nulls and neither quotes
    nor escapes, the files Hive reads and writes.  Spark's delimited source cannot tell
    an empty string from a null there, so the catalog gets a table of plain lines
    (``<name>_lines``) and ``name`` is a typed view over it; `insert_partition` writes
    and `read_table` reads either form by ``name``.
    """
    loc = f" LOCATION '{location}'" if location else ""
    if text:
        lines = lines_table(name)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {lines} (value string, ds string) USING text PARTITIONED BY (ds){loc}")
        fields = ", ".join(delimited_fields_sql(METRICS_SCHEMA))
        spark.sql(f"CREATE VIEW IF NOT EXISTS {name} AS SELECT {fields}, ds FROM {lines}")
        return
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in METRICS_SCHEMA.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}, ds string) USING parquet PARTITIONED BY (ds){loc}")


def is_text_table(spark: SparkSession, name: str) -> bool:
    return spark.catalog.getTable(name).tableType == "VIEW"


def drop_metrics_table(spark: SparkSession, name: str) -> None:
    """Remove the metrics table, parquet or text, from the catalog (files at a location of their own stay)."""
    if not spark.catalog.tableExists(name):
        return
    if is_text_table(spark, name):
        spark.sql(f"DROP VIEW {name}")
        name = lines_table(name)
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def write_partition(df: DataFrame, path: str, ds: str, *, mode: str = "overwrite", fmt: str = "parquet") -> None:
    """Write the rows as partition ``ds`` of a path-based table.

    The partition's own folder is written, so ``overwrite`` replaces exactly
    that partition, also by no rows at all, and no session setting changes;
    ``append`` adds rows like ``INSERT INTO``.  Callers that publish several
    jobs into one partition should write their union once.
    """
    df.select(*METRIC_COLUMNS).write.mode(mode).format(fmt).save(f"{path.rstrip('/')}/ds={ds}")


def insert_partition(df: DataFrame, table: str, ds: str, *, overwrite: bool = True) -> None:
    """``INSERT [OVERWRITE] table PARTITION (ds=...)`` from the rows, through a view of its own.

    ``table`` may be a parquet or a text table of `create_metrics_table`.
    """
    spark = df.sparkSession
    rows = df.select(*METRIC_COLUMNS)
    if is_text_table(spark, table):
        table, rows = lines_table(table), rows.select(delimited_line(rows.columns).alias("value"))
    view = f"tallyhouse_insert_{uuid.uuid4().hex}"
    rows.createOrReplaceTempView(view)
    verb = "OVERWRITE TABLE" if overwrite else "INTO"
    columns = ", ".join(f"`{c}`" for c in rows.columns)
    try:
        spark.sql(f"INSERT {verb} {table} PARTITION (ds='{ds}') SELECT {columns} FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def delimited_line(columns: Sequence[str], *, sep: str = "\t", null_value: str = NULL_TOKEN) -> Column:
    """The columns as one delimited line: no quotes, no escapes, ``\\N`` for null.

    Such a line has no way to hold the separator or a line break inside a value, so
    those characters are written as a blank; everything else, quotes and backslashes
    included, stands as it is, and an empty string is an empty field.
    """
    fields = [F.coalesce(F.translate(F.col(f"`{c}`").cast("string"), f"{sep}\n\r", "   "), F.lit(null_value)) for c in columns]
    return F.concat_ws(sep, *fields)


def write_delimited(df: DataFrame, path: str, *, sep: str = "\t", null_value: str = NULL_TOKEN, mode: str = "overwrite") -> None:
    """Delimited text files as Hive reads them, without a header (see `delimited_line`)."""
    df.select(delimited_line(df.columns, sep=sep, null_value=null_value).alias("value")).write.mode(mode).text(path)


def export_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    options: Mapping[str, str] | None = None,
    *,
    num_partitions: int = 8,
    batch_size: int = 10000,
    mode: str = "append",
) -> None:
    """Insert the metric columns (no ``ds``) into an RDBMS table.

    Writes with up to ``num_partitions`` parallel connections (``coalesce``,
    no shuffle) in batches.
    """
    out = df.select(*METRIC_COLUMNS).coalesce(num_partitions)
    writer = out.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table)
    writer = writer.option("batchsize", str(batch_size))
    for k, v in (options or {}).items():
        writer = writer.option(k, v)
    writer.save()
