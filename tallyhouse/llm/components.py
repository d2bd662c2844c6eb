"""Connected components of an edge table by alternating large and small stars.

Each round writes its edges to the shared folder, so a lost executor costs one
round at most.  Rounds grow with the logarithm of the size of a component.
Nothing but a count and a checksum of the edges reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import drop_table, write_table

SCHEMA = "a long, b long"


def _state(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    )


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of an edge (``a, b``) other than the least of its component.

    ``root`` is the least node of the component.  Loops and repeated edges do
    not matter; an empty table gives an empty result.
    """
    spark = edges.sparkSession
    start = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    path = write_table(start, "edges")
    now = spark.read.schema(SCHEMA).parquet(path)
    state = _state(now)
    while state[0]:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        own = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(own, "a")
        small = (
            joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(own.select("a", F.col("m").alias("b"))).distinct()
        )
        after = write_table(small, "edges")
        drop_table(spark, path)
        path, now = after, spark.read.schema(SCHEMA).parquet(after)
        before, state = state, _state(now)
        if state == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
