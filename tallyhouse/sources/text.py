"""Text sources: plain lines, delimited lines to typed rows, tab-delimited tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NULL_TOKEN = "\\N"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, column ``value``."""
    return spark.read.text(path)


def read_typed_lines(
    spark: SparkSession,
    path: str,
    fields: Sequence[tuple[str, T.DataType]],
    *,
    sep: str = ",",
    trim: Sequence[str] = (),
    mode: str = "PERMISSIVE",
) -> DataFrame:
    """Delimited lines -> typed columns by position.

    Field ``i`` of the split line is cast to the ``i``-th type; only the
    fields named in ``trim`` are stripped of surrounding blanks (a name keeps
    its blanks, a number is trimmed before parsing).  Extra fields are
    ignored.  ``PERMISSIVE`` yields null for a missing or unparsable field and
    keeps the line in ``_corrupt_record``; ``FAILFAST`` raises on such a line.
    """
    if mode not in ("PERMISSIVE", "FAILFAST"):
        raise ValueError("mode must be PERMISSIVE or FAILFAST")
    parts = F.split(F.col("value"), sep)
    cols, ok = [], F.lit(True)
    for i, (name, dtype) in enumerate(fields):
        raw = F.get(parts, i)
        if name in trim:
            raw = F.trim(raw)
        typed = raw if isinstance(dtype, T.StringType) else raw.try_cast(dtype)
        ok = ok & typed.isNotNull()
        cols.append(typed.alias(name))
    lines = read_lines(spark, path)
    if mode == "FAILFAST":
        # A filter is never pruned away, unlike an unused column.
        fail = F.raise_error(F.concat(F.lit("malformed line: "), F.col("value")))
        lines = lines.where(F.when(~ok, fail).isNull())
    return lines.select(*cols, F.when(~ok, F.col("value")).alias("_corrupt_record"))


def delimited_fields_sql(schema: T.StructType, *, line: str = "value", sep: str = "\t", null_value: str = NULL_TOKEN) -> list[str]:
    """SQL text of the typed columns of a delimited line, by position.

    A missing field, one equal to ``null_value`` and one that does not parse as its
    type are null; an empty string stays one; surplus fields are ignored.
    """

    def quoted(x: str) -> str:
        return "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"

    pattern = quoted("".join(f"\\{c}" if c in "\\^$.|?*+()[]{}" else c for c in sep))
    out = []
    for i, f in enumerate(schema.fields):
        raw = f"nullif(get(split({line}, {pattern}, -1), {i}), {quoted(null_value)})"
        typed = raw if isinstance(f.dataType, T.StringType) else f"try_cast({raw} AS {f.dataType.simpleString()})"
        out.append(f"{typed} AS `{f.name}`")
    return out


def read_delimited_table(
    spark: SparkSession, path: str, schema: T.StructType, *, sep: str = "\t", null_value: str = NULL_TOKEN
) -> DataFrame:
    """A delimited text table as Hive reads it: no header, no quotes, no escapes, ``\\N`` for null
    (see `delimited_fields_sql`)."""
    return read_lines(spark, path).selectExpr(*delimited_fields_sql(schema, sep=sep, null_value=null_value))
