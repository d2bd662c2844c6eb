"""Small end-to-end programs: typed text as a SQL view, JDBC table as a SQL
view, whole-table dump, word count over a text file."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallyhouse.operators.wordcount import word_count
from tallyhouse.sources.jdbc import read_jdbc_table
from tallyhouse.sources.tables import read_table
from tallyhouse.sources.text import read_lines, read_typed_lines

PEOPLE_FIELDS = [("name", T.StringType()), ("age", T.IntegerType())]


def people(spark: SparkSession, path: str, *, view: str = "people", strict: bool = True) -> DataFrame:
    """``name,age`` lines -> view ``people`` -> ``SELECT * FROM people``.

    The age is trimmed, the name is kept as written; ``strict`` fails the job
    on a short or non-numeric line, otherwise such lines give a null age."""
    rows = read_typed_lines(spark, path, PEOPLE_FIELDS, trim=("age",), mode="FAILFAST" if strict else "PERMISSIVE")
    rows.select("name", "age").createOrReplaceTempView(view)
    return spark.sql(f"SELECT * FROM {view}")


def jdbc_view(
    spark: SparkSession, url: str, table: str, options: Mapping[str, str] | None = None, *, view: str | None = None
) -> DataFrame:
    """A JDBC table registered as a view and selected through SQL."""
    name = view or table.split(".")[-1]
    read_jdbc_table(spark, url, table, options).createOrReplaceTempView(name)
    return spark.sql(f"SELECT * FROM {name}")


def table_dump(spark: SparkSession, name: str) -> DataFrame:
    """Every row of a metastore table."""
    return read_table(spark, name)


def text_word_count(spark: SparkSession, path: str) -> DataFrame:
    """``(word, count)`` over the lines of text files."""
    return word_count(read_lines(spark, path))
