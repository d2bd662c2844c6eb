"""Deal metrics: total volume, volume and area-weighted average price.

Plan (one Catalyst plan; the fact is exchanged after partial aggregation only,
unless the dimension is too large for Spark to broadcast):

1. scan the day partition, join the community dimension (Spark picks the join
   from sizes), derive segment, plate, effective price and time slot;
2. pre-aggregate the deals to communities and slots, then explode those rows
   into the four object levels and aggregate to a *slot grain* ``(dim,
   obj_type, city, key, slot)``, both with partial (map-side) aggregation -- a
   hot city or house is combined before each shuffle, so skew never reaches
   one task as raw rows, and a deal is hashed once, not once a level.  Slots (see
   :func:`~tallyhouse.functions.periods.time_slot`) are at most about four
   per month plus one per look-back edge, and every statistic window is a
   union of whole slots;
3. per object, the latest day over a window on the slot grain (a group here
   is bounded by the number of slots, not by deals), attach the city's
   release month (one row a city), derive the statistic windows;
4. one grouped aggregate of conditional sums on the same partitioning, then
   an in-stage unpivot to tall rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse import schema as S
from tallyhouse.functions.numeric import change_pct, parse_amount, parse_day, ratio
from tallyhouse.functions.periods import cyclical_window, month_window, slot_in_window, time_slot
from tallyhouse.operators.levels import ALL_LEVELS, explode_levels
from tallyhouse.operators.tall import MetricSpec, to_metric_rows

# Price labels of second-hand deals.  A signed deal uses the
# contract price, a reference deal the appraised price, anything else (or no
# label) the contract price.
SIGNED_LABELS = ("1", "签约实价")
REFERENCE_LABELS = ("2", "行情参考")

SEGMENT_CODES = {"1": S.DIM_NEW, "2": S.DIM_SECOND}


def community_keys(dim: DataFrame, segments=None) -> DataFrame:
    """Community dimension reduced to the join keys, the level keys and the segment label.

    ``segments=None`` takes every row, whatever its segment code (null included;
    codes without a label get none); otherwise only rows with one of the codes.
    """
    seg = F.col("is_first").cast("string")
    dim_label = None
    for code, label in SEGMENT_CODES.items():
        dim_label = F.when(seg == code, label) if dim_label is None else dim_label.when(seg == code, label)
    rows = dim if segments is None else dim.where(seg.isin(*segments))
    return rows.select(
        F.col("biz_city_id").cast("string").alias("_dim_city"),
        F.col("biz_house_id").cast("string").alias("_dim_house"),
        F.col("biz_district_id").cast("string").alias("district_id"),
        F.get(F.split(F.col("plate_fk"), "@"), 1).alias("plate_id"),
        dim_label.alias("dim"),
    )


def enrich_deals(
    deals: DataFrame,
    dim: DataFrame,
    ds: str,
    *,
    segments=("1", "2"),
) -> DataFrame:
    """Deals of partition ``ds`` joined to their communities.

    Columns: dim, city_id, district_id, plate_id, house_id, deal_day (DATE),
    price, area (decimal).  A community listed in several segments yields one
    row per segment.  Unparsable numbers or dates become null: such a deal
    still counts in volumes but not in prices (price) or windows (date).
    """
    facts = deals.where(F.col("ds") == F.lit(ds)).select(
        F.col("city_id").cast("string").alias("city_id"),
        F.col("house_id").cast("string").alias("house_id"),
        "bargaindate",
        "totalprice",
        "eval_totalprice",
        "price_label",
        "bargain_area",
    )
    keys = community_keys(dim, segments)
    j = facts.join(keys, (facts.city_id == keys._dim_city) & (facts.house_id == keys._dim_house))
    label = F.col("price_label")
    effective = (
        F.when((F.col("dim") == S.DIM_SECOND) & label.isin(*SIGNED_LABELS), F.col("totalprice"))
        .when((F.col("dim") == S.DIM_SECOND) & label.isin(*REFERENCE_LABELS), F.col("eval_totalprice"))
        .otherwise(F.col("totalprice"))
    )
    return j.select(
        "dim",
        "city_id",
        "district_id",
        "plate_id",
        "house_id",
        parse_day(F.col("bargaindate")).alias("deal_day"),
        parse_amount(effective).alias("price"),
        parse_amount(F.col("bargain_area")).alias("area"),
    )


def release_months(release: DataFrame, column: str = "second_updated") -> DataFrame:
    """Per-city release day of one segment (latest one if a city repeats)."""
    return (
        release.where(F.col(column).isNotNull())
        .groupBy(F.col("city_id").cast("string").alias("_rel_city"))
        .agg(F.max(F.col(column).cast("date")).alias("release_day"))
    )


def slot_grain(enriched: DataFrame, as_of, levels=ALL_LEVELS) -> DataFrame:
    """``(dim, obj_type, city_id, obj_key, slot_first, slot_last)`` -> n, sp, sa, last_day."""
    valid = F.col("price").isNotNull() & F.col("area").isNotNull()
    first, last = time_slot("deal_day", as_of)
    house = (
        enriched.withColumns({"slot_first": first, "slot_last": last})
        .groupBy("dim", "city_id", "district_id", "plate_id", "house_id", "slot_first", "slot_last")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.when(valid, F.col("price"))).alias("sp"),
            F.sum(F.when(valid, F.col("area"))).alias("sa"),
            F.max("deal_day").alias("last_day"),
        )
    )
    return (
        explode_levels(house, levels)
        .groupBy(*S.OBJECT_KEYS, "slot_first", "slot_last")
        .agg(F.sum("n").alias("n"), F.sum("sp").alias("sp"), F.sum("sa").alias("sa"), F.max("last_day").alias("last_day"))
    )


def deal_object_stats(
    enriched: DataFrame,
    as_of,
    release: DataFrame | None = None,
    *,
    calendar_months: bool = False,
    levels=ALL_LEVELS,
) -> DataFrame:
    """One wide row per object with the chosen windows and their sums.

    Price always uses the cyclical look-back window of the object's latest
    deal.  Volume uses the same window for NEW; for SECOND it uses the month
    of the city's release day (city, district, plate) or the month of the
    object's latest deal (house).
    """
    grain = slot_grain(enriched, as_of, levels)
    obj = Window.partitionBy(*S.OBJECT_KEYS)
    grain = grain.withColumn("latest", F.max("last_day").over(obj))
    if release is not None:
        rel = release_months(release)
        grain = grain.join(rel, grain.city_id == rel._rel_city, "left").drop("_rel_city")
    else:
        grain = grain.withColumn("release_day", F.lit(None).cast("date"))

    cyc = cyclical_window("latest", as_of)
    is_new = F.col("dim") == S.DIM_NEW
    is_house = F.col("obj_type") == S.OBJ_HOUSE
    vol = (
        F.when(is_new, cyc)
        .when(is_house, month_window("latest", calendar_months))
        .otherwise(month_window("release_day", calendar_months))
    )
    grain = grain.withColumn("cyc", cyc).withColumn("vol", vol)
    first, last = F.col("slot_first"), F.col("slot_last")

    def cnt(cond):
        return F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0)).cast("long")

    def total(cond, c):
        return F.sum(F.when(cond, F.col(c)))

    cur = slot_in_window(first, last, F.col("cyc"))
    prev = slot_in_window(first, last, F.col("cyc"), previous=True)
    vcur = slot_in_window(first, last, F.col("vol"))
    vprev = slot_in_window(first, last, F.col("vol"), previous=True)
    # Only fixed-width buffers (no string max), so both aggregate phases stay
    # hash-based; the labels are derived from the carried days afterwards.
    stats = grain.groupBy(*S.OBJECT_KEYS).agg(
        F.sum("n").cast("long").alias("total"),
        F.max("latest").alias("latest"),
        F.max("release_day").alias("release_day"),
        cnt(cur).alias("n_cur"),
        total(cur, "sp").alias("sp_cur"),
        total(cur, "sa").alias("sa_cur"),
        cnt(prev).alias("n_prev"),
        total(prev, "sp").alias("sp_prev"),
        total(prev, "sa").alias("sa_prev"),
        cnt(vcur).alias("v_cur"),
        cnt(vprev).alias("v_prev"),
    )
    price_period = cyclical_window("latest", as_of)["period"]
    month_of = F.when(is_house, F.col("latest")).otherwise(F.col("release_day"))
    volume_period = F.when(is_new, price_period).otherwise(F.date_format(month_of, "yyyy-MM"))
    return stats.withColumn("price_period", price_period).withColumn("volume_period", volume_period)


def deal_metric_rows(stats: DataFrame, indexes=None) -> DataFrame:
    """Tall metrics rows from :func:`deal_object_stats`."""
    price_cur = F.when(F.col("n_cur") > 0, ratio(F.col("sp_cur"), F.col("sa_cur")))
    price_prev = F.when(F.col("n_prev") > 0, ratio(F.col("sp_prev"), F.col("sa_prev")))
    vol_cur = F.when(F.col("v_cur") > 0, F.col("v_cur").cast("double"))
    vol_prev = F.when(F.col("v_prev") > 0, F.col("v_prev").cast("double"))
    vol_type = F.when(F.col("dim") == S.DIM_NEW, S.PERIOD_TYPE_PERIOD).otherwise(S.PERIOD_TYPE_MONTH)
    none = F.lit(None).cast("double")
    specs = {
        S.INDEX_TOTAL_DEAL_VOLUME: MetricSpec(
            F.lit(S.INDEX_TOTAL_DEAL_VOLUME), F.lit(S.PERIOD_TYPE_TOTAL), F.lit(S.PERIOD_TYPE_TOTAL),
            F.col("total").cast("double"), none, none,
        ),
        S.INDEX_DEAL_PRICE_AVG: MetricSpec(
            F.lit(S.INDEX_DEAL_PRICE_AVG), F.lit(S.PERIOD_TYPE_PERIOD), F.col("price_period"),
            price_cur, price_prev, change_pct(price_cur, price_prev),
        ),
        S.INDEX_DEAL_VOLUME: MetricSpec(
            F.lit(S.INDEX_DEAL_VOLUME), vol_type, F.col("volume_period"),
            vol_cur, vol_prev, change_pct(vol_cur, vol_prev),
        ),
    }
    chosen = list(specs) if indexes is None else list(indexes)
    return to_metric_rows(stats, [specs[i] for i in chosen])


def deal_metrics(
    deals: DataFrame,
    dim: DataFrame,
    release: DataFrame | None,
    ds: str,
    as_of,
    *,
    calendar_months: bool = False,
    indexes=None,
) -> DataFrame:
    """The deals job: tall metrics rows for NEW and SECOND at all levels."""
    enriched = enrich_deals(deals, dim, ds)
    stats = deal_object_stats(enriched, as_of, release, calendar_months=calendar_months)
    return deal_metric_rows(stats, indexes)
