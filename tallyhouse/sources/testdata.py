"""Adapters from the generated benchmark tables to the job's input shapes.

The jobs read a deal fact, a listing fact, a community dimension and a
per-city release-date table.  The benchmark data is TPC-H shaped, so these
functions derive those inputs from ``lineitem``, ``supplier``, ``part`` and
``nation`` with deterministic rules (all fact columns are strings, as in the
production staging tables).  Scale grows with ``lineitem``; the joins to
``supplier``/``part`` are plain equi-joins whose strategy Spark picks from
table statistics (broadcast below ``spark.sql.autoBroadcastJoinThreshold``,
sort-merge beyond it).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

AS_OF = "2001-11-05"
DS = "2001-11-04"

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


_SCHEMAS: dict[tuple[str, int, int], T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table.  Its schema is inferred once for each state of the file
    (path, time of change, length), so that later plans over it start no job."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    status = p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p)
    key = (path, status.getModificationTime(), status.getLen())
    if key not in _SCHEMAS:
        _SCHEMAS[key] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[key]).parquet(path)


def _day_text(day: Column) -> Column:
    return day.cast("string")


def _shifted_day() -> Column:
    """Activity day of a line: ship day moved back by a supplier-dependent lag."""
    k = F.col("s_suppkey")
    lag = (k % 12) * 40 - F.when(k % 24 == 0, 5).otherwise(0)
    return F.date_sub(F.to_date(F.col("l_shipdate")), lag.cast("int"))


def community_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Community dimension: one row per supplier, plus a copy in the other
    segment for every tenth supplier (a community sold both new and
    second-hand), and copies without a segment code or with one that is
    neither new nor second-hand for some others."""
    k = F.col("s_suppkey")
    base = table(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").cast("string").alias("biz_city_id"),
        k.cast("string").alias("biz_house_id"),
        F.when(k % 13 == 0, F.lit(None).cast("string")).otherwise((k % 4).cast("string")).alias("biz_district_id"),
        F.when(k % 11 == 0, F.lit("p"))
        .otherwise(F.concat(F.col("s_nationkey").cast("string"), F.lit("@"), (k % 6).cast("string")))
        .alias("plate_fk"),
        (F.lit(1) + k % 2).cast("int").alias("is_first"),
        k.alias("_k"),
    )
    extra = base.where(F.col("_k") % 10 == 0).withColumn("is_first", (F.lit(3) - F.col("is_first")).cast("int"))
    none = base.where(F.col("_k") % 7 == 3).withColumn("is_first", F.lit(None).cast("int"))
    other = base.where(F.col("_k") % 9 == 4).withColumn("is_first", F.lit(3))
    return base.unionByName(extra).unionByName(none).unionByName(other).drop("_k")


def deal_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deals derived from lineitem x supplier.

    Some amounts have five decimals, and some of these 15 and more digits.
    Like the text columns of a staging table, the fields are formatted once a
    row (they come out of a generator, so no consumer's filter repeats that).
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_partkey", "l_linenumber", "l_extendedprice", "l_discount", "l_quantity", "l_shipdate"
    )
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    j = li.join(sup, li.l_suppkey == sup.s_suppkey)
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    line, pk = F.col("l_linenumber"), F.col("l_partkey")
    long, fine = pk % 97 == 5, pk % 89 == 7

    def amount(value: Column, digits: str) -> Column:
        text = value.cast("string")
        return (
            F.when(long, F.concat(F.lit("1234567890"), text, F.lit(digits)))
            .when(fine, F.concat(text, F.lit(digits)))
            .otherwise(text)
        )

    fields = F.struct(
        F.col("s_nationkey").cast("string").alias("city_id"),
        F.col("s_suppkey").cast("string").alias("house_id"),
        _day_text(_shifted_day()).alias("bargaindate"),
        amount(price, "345").alias("totalprice"),
        amount(price * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)")), "5").alias("eval_totalprice"),
        F.when(line % 4 == 0, F.lit("1"))
        .when(line % 4 == 1, F.lit("2"))
        .when(line % 4 == 2, F.lit("行情参考"))
        .otherwise(F.lit(None).cast("string"))
        .alias("price_label"),
        amount(F.col("l_quantity").cast("decimal(12,2)"), "125").alias("bargain_area"),
        F.when(line == 7, F.lit("2001-11-03")).otherwise(F.lit(DS)).alias("ds"),
    )
    return j.select(F.inline(F.array(fields)))


def listing_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings derived from lineitem x supplier x part.

    Some lines give a second listing whose first day is no date: two digits
    too many, or a word right behind it.  Some areas have five decimals.  The
    fields are formatted once a row, as in `deal_fact`.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_partkey", "l_linenumber", "l_discount", "l_quantity", "l_shipdate"
    )
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    j = li.join(sup, li.l_suppkey == sup.s_suppkey).join(part, li.l_partkey == part.p_partkey)
    pk = F.col("l_partkey")
    sk = F.col("s_suppkey")
    area, unit, day, first = F.col("_area"), F.col("_unit"), F.col("_day"), F.col("_first")
    numbers = F.struct(
        (F.lit(30) + F.col("l_quantity").cast("bigint")).alias("_area"),
        (
            F.lit(1500000)
            + (sk % 7) * 100000
            + ((pk * pk) % 97) * 2000
            + F.when(sk % 3 == 0, (pk % 9) * (pk % 9) * 60000).otherwise(0)
        ).alias("_unit"),
        _day_text(_shifted_day()).alias("_day"),
        _day_text(F.date_sub(_shifted_day(), (F.lit(10) + pk % 1500).cast("int"))).alias("_first"),
    )
    j = j.select("*", F.inline(F.array(numbers)))
    fields = [
        F.col("s_nationkey").cast("string").alias("city_id"),
        sk.cast("string").alias("house_id"),
        F.when(pk % 6 == 0, F.lit(None).cast("string")).otherwise(day).alias("last_pub_date"),
        F.concat(area.cast("string"), F.when(pk % 89 == 7, F.lit(".12345")).otherwise(F.lit(""))).alias("area"),
        (area * F.when(pk % 50 == 1, F.lit(90000)).otherwise(unit)).cast("string").alias("quoted_price"),
        F.when(pk % 37 == 0, F.lit(None).cast("string"))
        .otherwise((area * unit * (F.lit(1) + F.lit(12) * F.col("l_discount").cast("decimal(4,2)"))).cast("string"))
        .alias("evaluation_high_price"),
        (F.col("p_size") * 25).cast("string").alias("total_floors"),
        F.col("l_linenumber").cast("string").alias("status"),
        F.lit(DS).alias("ds"),
    ]
    written = F.when(pk % 5 == 0, F.concat(first, F.lit(" 10:00:00"))).otherwise(first).alias("first_pub_date")
    broken = F.concat(first, F.when(pk % 2 == 0, F.lit("99")).otherwise(F.lit("garbage"))).alias("first_pub_date")
    good, bad = F.struct(written, *fields), F.struct(broken, *fields)
    return j.select(F.inline(F.when(pk % 41 == 0, F.array(good, bad)).otherwise(F.array(good))))


def release_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-city data release dates (nullable)."""
    n = F.col("n_nationkey")
    day = F.date_sub(F.lit("2001-06-15").cast("date"), (n * 31).cast("int"))
    return table(spark, sf_dir, "nation").select(
        n.cast("bigint").alias("city_id"),
        F.when(n % 2 == 0, F.lit(None).cast("date")).otherwise(day).alias("new_updated"),
        F.when(n % 5 == 0, F.lit(None).cast("date")).otherwise(day).alias("second_updated"),
    )
