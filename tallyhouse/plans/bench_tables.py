"""The daily jobs wired to the generated benchmark tables.

Each function takes ``(spark, sf_dir)`` and returns a DataFrame; these are the
queries registered in ``__spark_entry__`` and timed by ``bench.py``.  All are
lazy but those that read back what they write: the round trips, and the listing
prices, whose grain is written when the plan is built.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse import schema as S
from tallyhouse.operators import deals as D
from tallyhouse.sources import testdata as td

RESULT_DIGITS = 6


def rounded(df: DataFrame, digits: int = RESULT_DIGITS) -> DataFrame:
    """Round the metric values (for stable comparison across engines)."""
    out = df
    for c in ("current_result", "previous_result", "mom"):
        if c in df.columns:
            out = out.withColumn(c, F.round(F.col(c), digits))
    return out


def deal_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = D.enrich_deals(td.deal_fact(spark, sf_dir), td.community_dim(spark, sf_dir), td.DS)
    return e.withColumn("price", F.col("price").cast("string")).withColumn("area", F.col("area").cast("string"))


def deal_metrics(spark: SparkSession, sf_dir: str, *, calendar_months: bool = False, indexes=None) -> DataFrame:
    return rounded(
        D.deal_metrics(
            td.deal_fact(spark, sf_dir),
            td.community_dim(spark, sf_dir),
            td.release_dates(spark, sf_dir),
            td.DS,
            td.AS_OF,
            calendar_months=calendar_months,
            indexes=indexes,
        )
    )


def deal_price_new(spark, sf_dir):
    return deal_metrics(spark, sf_dir, indexes=[S.INDEX_DEAL_PRICE_AVG]).where(F.col("dim") == S.DIM_NEW)


def deal_total_volume(spark, sf_dir):
    return deal_metrics(spark, sf_dir, indexes=[S.INDEX_TOTAL_DEAL_VOLUME])


def deal_volume_cyclical(spark, sf_dir):
    return deal_metrics(spark, sf_dir, indexes=[S.INDEX_DEAL_VOLUME]).where(F.col("dim") == S.DIM_NEW)


def deal_volume_release_month(spark, sf_dir, calendar_months: bool = False):
    return deal_metrics(spark, sf_dir, indexes=[S.INDEX_DEAL_VOLUME], calendar_months=calendar_months).where(
        (F.col("dim") == S.DIM_SECOND) & (F.col("obj_type") != S.OBJ_HOUSE)
    )


def deal_volume_deal_month(spark, sf_dir):
    return deal_metrics(spark, sf_dir, indexes=[S.INDEX_DEAL_VOLUME]).where(
        (F.col("dim") == S.DIM_SECOND) & (F.col("obj_type") == S.OBJ_HOUSE)
    )


def listing_clean(spark, sf_dir):
    from tallyhouse.operators import listings as L

    c = L.clean_listings(td.listing_fact(spark, sf_dir), td.community_dim(spark, sf_dir), td.DS, td.AS_OF)
    return c.withColumns({n: F.round(F.col(n).cast("double"), RESULT_DIGITS) for n in ("price_yuan", "area")})


def listing_metrics(spark, sf_dir, *, indexes=None, **opts):
    from tallyhouse.operators import listings as L

    return rounded(
        L.listing_metrics(
            td.listing_fact(spark, sf_dir), td.community_dim(spark, sf_dir), td.DS, td.AS_OF, indexes=indexes, **opts
        )
    )


def listing_volume(spark, sf_dir):
    return listing_metrics(spark, sf_dir, indexes=[S.INDEX_QUOTED_VOLUME])


def listing_price_avg(spark, sf_dir):
    return listing_metrics(spark, sf_dir, indexes=[S.INDEX_QUOTED_PRICE_AVG]).where(F.col("obj_type") != S.OBJ_HOUSE)


def listing_price_house(spark, sf_dir, **opts):
    return listing_metrics(spark, sf_dir, indexes=[S.INDEX_QUOTED_PRICE_AVG], **opts).where(
        F.col("obj_type") == S.OBJ_HOUSE
    )


def metrics_all(spark, sf_dir, *, deals: DataFrame | None = None):
    """Both jobs' rows for the day: the content of one ``ds`` partition.  A caller
    that has the deal job's rows already passes them as ``deals``."""
    deals = deal_metrics(spark, sf_dir) if deals is None else deals
    return deals.unionByName(listing_metrics(spark, sf_dir))


def area_band_histogram(spark, sf_dir):
    from tallyhouse.functions.bands import band_upper_of
    from tallyhouse.operators import listings as L

    clean = L.clean_listings(td.listing_fact(spark, sf_dir), td.community_dim(spark, sf_dir), td.DS, td.AS_OF)
    return (
        clean.groupBy("city_id", "band_lo")
        .agg(F.count(F.lit(1)).alias("listings"))
        .withColumn("band_hi", band_upper_of("band_lo"))
    )


def month_bounds(spark, sf_dir):
    from tallyhouse.functions.periods import month_window

    days = td.table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    m, c = month_window("day"), month_window("day", calendar_months=True)
    return days.select(
        "day",
        m["period"].alias("period"),
        m["s"].alias("s"),
        m["e"].alias("e"),
        m["p_s"].alias("p_s"),
        m["p_e"].alias("p_e"),
        c["p_e"].alias("p_e_calendar"),
    )


def cyclical_period_of_date(spark, sf_dir):
    from tallyhouse.functions.periods import cyclical_window

    days = td.table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    w = cyclical_window("day", td.AS_OF)
    return days.select("day", *[w[f].alias(f) for f in ("period", "s", "e", "p_s", "p_e")])


def word_count(spark, sf_dir):
    from tallyhouse.operators.wordcount import document_word_count

    return document_word_count(td.table(spark, sf_dir, "documents").select("text"))


def _people_lines(spark, sf_dir):
    c = F.col("c_custkey")
    age = (c % 90 + 10).cast("string")
    line = F.when(c % 50 == 0, F.col("c_name")).otherwise(F.concat(F.col("c_name"), F.lit(", "), age, F.lit(" ")))
    return td.table(spark, sf_dir, "customer").select(line.alias("value"))


def typed_csv(spark, sf_dir):
    """Delimited text -> typed rows: lines derived from ``customer`` are
    written as a text file, then parsed into ``(name string, age int)``."""
    from pyspark.sql import types as T

    from tallyhouse.session import scratch_path
    from tallyhouse.sources.text import read_typed_lines

    path = scratch_path(spark, "people")
    _people_lines(spark, sf_dir).write.mode("overwrite").text(path)
    return read_typed_lines(spark, path, [("name", T.StringType()), ("age", T.IntegerType())], trim=("age",))


def _odd_labels():
    return (
        F.when(F.col("obj_type") == S.OBJ_CITY, F.concat("obj_value", F.lit(':"q"\\path')))
        .when(F.col("obj_type") == S.OBJ_DISTRICT, "")
        .otherwise(F.col("obj_value"))
    )


def tsv_null_roundtrip(spark, sf_dir):
    """Metrics written as tab-delimited text with ``\\N`` nulls and read back;
    some values hold quotes and backslashes or are empty."""
    from tallyhouse.schema import METRICS_SCHEMA
    from tallyhouse.session import scratch_path
    from tallyhouse.sinks.writers import write_delimited
    from tallyhouse.sources.text import read_delimited_table

    path = scratch_path(spark, "metrics-tsv")
    write_delimited(metrics_all(spark, sf_dir).withColumn("obj_value", _odd_labels()), path)
    return read_delimited_table(spark, path, METRICS_SCHEMA)


def partition_write_roundtrip(spark, sf_dir):
    """Metrics written twice into partition ``ds`` (overwrite: idempotent),
    next to an older partition holding the deal rows only, then read back
    through partition pruning."""
    from tallyhouse.schema import METRIC_COLUMNS
    from tallyhouse.session import computed_once, scratch_path
    from tallyhouse.sinks.writers import write_partition
    from tallyhouse.sources.tables import read_partition

    path = scratch_path(spark, "metrics-table")
    with computed_once(deal_metrics(spark, sf_dir), "metrics-deals") as deals:
        write_partition(deals, path, "2001-11-03")
        with computed_once(metrics_all(spark, sf_dir, deals=deals), "metrics-rows") as rows:
            write_partition(rows, path, td.DS)
            write_partition(rows, path, td.DS)
    return read_partition(spark, path, td.DS, fmt="parquet").select(*METRIC_COLUMNS)


OLDER_DAY = "2001-11-03"


def empty_day_roundtrip(spark, sf_dir):
    """Two days written as partitions of a path, then the older day again with
    no rows: it must end up empty, the other as it was."""
    from tallyhouse.schema import METRIC_COLUMNS
    from tallyhouse.session import computed_once, scratch_path
    from tallyhouse.sinks.writers import write_partition

    path = scratch_path(spark, "metrics-empty-day")
    with computed_once(deal_metrics(spark, sf_dir), "metrics-rows") as rows:
        write_partition(rows, path, OLDER_DAY)
        write_partition(rows, path, td.DS)
        write_partition(rows.where("false"), path, OLDER_DAY)
    return spark.read.parquet(path).select(*METRIC_COLUMNS, F.col("ds").cast("string").alias("ds"))


def _through_catalog(spark, name: str, days: dict[str, list[DataFrame]], *, text: bool = False) -> DataFrame:
    """Create the metrics table in the catalog at a shared location, insert each day's frames
    in turn, read it whole; the rows read are kept, the table leaves catalog and folder."""
    from tallyhouse.session import drop_path, materialize, scratch_path
    from tallyhouse.sinks.writers import create_metrics_table, drop_metrics_table, insert_partition
    from tallyhouse.sources.tables import read_table

    location = scratch_path(spark, "metrics-catalog")
    try:
        create_metrics_table(spark, name, location=location, text=text)
        for ds, frames in days.items():
            for rows in frames:
                insert_partition(rows, name, ds)
        return materialize(read_table(spark, name), "metrics-read")
    finally:
        drop_metrics_table(spark, name)
        drop_path(spark, location)


def catalog_table_roundtrip(spark, sf_dir):
    """The metrics table created in the catalog at a shared location, filled
    through a view (a repeated insert replaces its day, an empty one empties
    it), and read whole."""
    from tallyhouse.session import computed_once

    name = f"tallyhouse_metrics_{uuid.uuid4().hex}"
    with computed_once(deal_metrics(spark, sf_dir), "metrics-rows") as rows:
        return _through_catalog(spark, name, {OLDER_DAY: [rows, rows.where("false")], td.DS: [rows, rows]})


def text_catalog_table_roundtrip(spark, sf_dir):
    """The same with a table of tab-delimited text; some values hold quotes and
    backslashes, are empty or look like the null mark's halves."""
    from tallyhouse.session import computed_once

    odd = deal_metrics(spark, sf_dir).withColumn("obj_value", _odd_labels())
    odd = odd.withColumn("period_value", F.when(F.col("obj_type") == S.OBJ_PLATE, "\\").otherwise(F.col("period_value")))
    name = f"tallyhouse_metrics_text_{uuid.uuid4().hex}"
    with computed_once(odd, "metrics-rows") as rows:
        return _through_catalog(spark, name, {OLDER_DAY: [rows, rows.where("false")], td.DS: [rows, rows]}, text=True)
