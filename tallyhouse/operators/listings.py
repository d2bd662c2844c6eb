"""Listing metrics: active-listing volume and average asking price.

Plan:

1. scan the day partition, apply the quality filters, join every row of the
   community dimension (Spark picks the join from sizes), clip each listing's
   end day;
2. explode into object levels and pre-aggregate (map-side, skew safe) to a
   grain of (object, first-day slot, end-day slot), where slots cut the
   calendar at the window edges, so every window predicate has one value per
   grain row; then one grouped aggregate holds, for each of the seven
   look-back windows, the count and sums of the listings in its current
   window (overlap) and its previous window (containment), plus the latest end
   day.  The object's window is picked after aggregation from the latest day,
   so no window function or join-back is needed;
3. communities with more than three listings in a window get the robust
   price of :mod:`tallyhouse.operators.houseprice`, computed from the HOUSE
   rows of the same grain (which keep band and unit price): they are joined
   to their community's latest day and window counts from step 2, reduced to
   a (community, window, band, unit price) grain with partial aggregation,
   and ranked.  The grain is written once under the checkpoint folder, at
   once when the plan is built, and read by both consumers, so the listings
   are scanned once, the lineage is cut after the big shuffle, and filters
   reach the grain's parquet scan;
4. unpivot to tall rows.
"""

from __future__ import annotations

import datetime as _dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse import schema as S
from tallyhouse.functions.bands import band_lower
from tallyhouse.functions.numeric import change_pct, parse_amount, parse_day, parse_double, ratio
from tallyhouse.functions.periods import (
    CYCLICAL_PERIODS,
    as_date,
    cyclical_index,
    cyclical_table,
    cyclical_window,
    floor_to_cut,
)
from tallyhouse.operators.deals import community_keys
from tallyhouse.operators.houseprice import SALTS, SEGMENT, house_price, unit_price
from tallyhouse.operators.levels import explode_levels
from tallyhouse.operators.tall import MetricSpec, to_metric_rows
from tallyhouse.session import materialize

# Listing quality rules.
ACTIVE_STATUSES = ("3", "5", "7")
MAX_FLOORS = 1000
MAX_AREA = 1000
UNIT_PRICE_CENTS = (100000, 50000000)
MAX_VALUATION_RATIO = 2

LEVELS = (S.OBJ_CITY, S.OBJ_DISTRICT, S.OBJ_HOUSE)
LEVELS_WITH_PLATE = (S.OBJ_CITY, S.OBJ_DISTRICT, S.OBJ_PLATE, S.OBJ_HOUSE)


def clean_listings(
    listings: DataFrame,
    dim: DataFrame,
    ds: str,
    as_of,
    *,
    segments=None,
) -> DataFrame:
    """Listings of partition ``ds`` that pass the quality rules, joined to
    their communities.

    The join takes every row of the dimension whatever its segment code, null
    and unknown codes included (``segments=None``), so a community present as
    new and second-hand counts its listings twice, as the production job does;
    pass ``segments=("2",)`` to restrict.

    Columns: city_id, district_id, plate_id, house_id, first_day, end_day,
    price_yuan, area (decimal), u (unit price), band_lo.
    """
    day = as_date(as_of)
    yesterday = day - _dt.timedelta(days=1)
    last_day = parse_day(F.col("last_pub_date"))
    # Every field is parsed once: the fields come out of a generator, which neither
    # filters nor later projections are folded into, so no predicate parses again.
    parsed = F.struct(
        F.col("city_id").cast("string").alias("city_id"),
        F.col("house_id").cast("string").alias("house_id"),
        parse_day(F.col("first_pub_date")).alias("first_day"),
        F.col("last_pub_date").isNull().alias("open_end"),
        F.when(last_day >= F.lit(day), F.lit(yesterday)).otherwise(last_day).alias("last_day"),
        parse_amount(F.col("quoted_price")).alias("price"),
        parse_amount(F.col("area")).alias("area"),
        parse_double(F.col("quoted_price")).alias("price_number"),
        parse_double(F.col("area")).alias("area_number"),
        parse_double(F.col("evaluation_high_price")).alias("evaluation"),
        parse_double(F.col("total_floors")).alias("floors"),
    )
    rows = listings.where((F.col("ds") == F.lit(ds)) & F.col("status").cast("string").isin(*ACTIVE_STATUSES))
    rows = rows.select(F.inline(F.array(parsed)))
    lo, hi = UNIT_PRICE_CENTS
    unit = F.try_divide(F.col("price_number"), F.col("area_number"))
    # Numbers compare by their floor, ratios with a zero or missing divisor drop the row.
    facts = rows.where(
        (F.floor("floors") < MAX_FLOORS)
        & (F.floor("area_number") > 0)
        & (F.floor("area_number") < MAX_AREA)
        & (unit >= lo)
        & (unit <= hi)
        & (F.try_divide(F.col("evaluation"), F.col("price_number")) <= MAX_VALUATION_RATIO)
        & (F.col("first_day") < F.lit(day))
    ).select(
        "city_id",
        "house_id",
        "first_day",
        F.when(F.col("open_end"), F.col("first_day")).otherwise(F.col("last_day")).alias("end_day"),
        "price",
        "area",
        F.floor("area_number").cast("long").alias("area_int"),
    )
    keys = community_keys(dim, segments).drop("dim")
    j = facts.join(keys, (facts.city_id == keys._dim_city) & (facts.house_id == keys._dim_house))
    out = j.select(
        "city_id",
        "district_id",
        "plate_id",
        "house_id",
        "first_day",
        "end_day",
        (F.col("price") * F.lit(Decimal("0.01"))).alias("price_yuan"),
        "area",
        unit_price(F.floor("price").try_cast("long"), F.col("area_int")).alias("u"),
        "area_int",
    )
    return out.withColumn("band_lo", band_lower("area_int")).drop("area_int")


def _slot_cuts(as_of) -> tuple[list, list]:
    """Cut dates for the two interval ends.  Every predicate on a listing is
    ``first_day <= x`` (cut at ``x + 1``) or ``end_day >= y`` (cut at ``y``)
    for an edge ``x``/``y`` of some window, current or previous, under either
    previous-window rule."""
    one = _dt.timedelta(days=1)
    first_cuts, end_cuts = set(), set()
    for _, s, e, p_s, p_e in cyclical_table(as_of):
        first_cuts.update((e + one, p_s + one, p_e + one))
        end_cuts.update((s, p_s, p_e))
    return sorted(first_cuts), sorted(end_cuts)


def listing_grain(clean: DataFrame, as_of, *, levels=LEVELS) -> DataFrame:
    """``(object, first slot, end slot[, band, unit price]) -> n, sums, latest end``.

    Grouping the interval ends by the window cut dates leaves every window
    predicate constant within a grain row, so per-window counts and sums come
    from the grain exactly.  HOUSE rows also keep the area band and the unit
    price, which the robust price needs; other levels leave them null.  This
    is the only aggregate over the listing rows (partial, map-side)."""
    first_cuts, end_cuts = _slot_cuts(as_of)
    is_house = F.col("obj_type") == S.OBJ_HOUSE
    rows = explode_levels(clean.withColumn("dim", F.lit(S.DIM_SECOND)), levels).select(
        *S.OBJECT_KEYS,
        floor_to_cut("first_day", first_cuts).alias("first_slot"),
        floor_to_cut("end_day", end_cuts).alias("end_slot"),
        F.when(is_house, F.col("band_lo")).alias("band_lo"),
        F.when(is_house, F.col("u")).alias("u"),
        "end_day",
        "price_yuan",
        "area",
    )
    return rows.groupBy(*S.OBJECT_KEYS, "first_slot", "end_slot", "band_lo", "u").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("price_yuan").alias("price_yuan"),
        F.sum("area").alias("area"),
        F.max("end_day").alias("last_end"),
    )


def _membership(first: Column, end: Column, s, e, p_s, p_e, previous: str) -> tuple[Column, Column]:
    cur = (first <= e) & (end >= s)
    if previous == "cover":
        prev = (first <= p_s) & (end >= p_e)
    elif previous == "overlap":
        prev = (first <= p_e) & (end >= p_s)
    else:
        raise ValueError("previous must be 'cover' or 'overlap'")
    return cur, prev


def _membership_sql(first: str, end: str, s: str, e: str, p_s: str, p_e: str, previous: str) -> tuple[str, str]:
    """SQL text of the current (overlap) and previous window predicates."""
    cur = f"({first} <= {e} AND {end} >= {s})"
    if previous == "cover":
        prev = f"({first} <= {p_s} AND {end} >= {p_e})"
    elif previous == "overlap":
        prev = f"({first} <= {p_e} AND {end} >= {p_s})"
    else:
        raise ValueError("previous must be 'cover' or 'overlap'")
    return cur, prev


def listing_object_stats(grain: DataFrame, as_of, *, previous: str = "cover") -> DataFrame:
    """One wide row per object: latest end day, chosen window, and count and
    sums of the listings in its current and previous window.

    The 42 conditional sums are written as SQL text, one expression each."""
    aggs = [F.max("last_end").alias("latest")]
    for k, (_, s, e, p_s, p_e) in enumerate(cyclical_table(as_of)):
        days = (f"DATE'{d.isoformat()}'" for d in (s, e, p_s, p_e))
        cur, prev = _membership_sql("first_slot", "end_slot", *days, previous)
        for tag, cond in (("c", cur), ("p", prev)):
            aggs += [
                F.expr(f"coalesce(sum(CASE WHEN {cond} THEN n END), 0) AS n{tag}{k}"),
                F.expr(f"sum(CASE WHEN {cond} THEN price_yuan END) AS y{tag}{k}"),
                F.expr(f"sum(CASE WHEN {cond} THEN area END) AS a{tag}{k}"),
            ]
    wide = grain.groupBy(*S.OBJECT_KEYS).agg(*aggs)
    n = len(CYCLICAL_PERIODS)

    def pick(prefix: str, alias: str) -> Column:
        return F.expr(f"get(array({', '.join(f'{prefix}{k}' for k in range(n))}), _idx) AS {alias}")

    names = ", ".join(f"'{name}'" for name, *_ in CYCLICAL_PERIODS)
    return wide.withColumn("_idx", cyclical_index("latest", as_of)).select(
        *S.OBJECT_KEYS,
        "latest",
        F.expr(f"get(array({names}), _idx) AS period"),
        pick("nc", "n_cur"),
        pick("yc", "y_cur"),
        pick("ac", "a_cur"),
        pick("np", "n_prev"),
        pick("yp", "y_prev"),
        pick("ap", "a_prev"),
    )


def community_prices(
    grain: DataFrame,
    stats: DataFrame,
    as_of,
    *,
    previous: str = "cover",
    area_bands: str = "all",
    segment: int = SEGMENT,
) -> DataFrame:
    """``(dim, obj_type, city_id, obj_key, kind) -> n_main, mode, avg, price``
    for communities with more than ``segment`` listings in window ``kind``
    (``cur`` or ``prev``): the robust price and its ingredients.

    The HOUSE rows of the grain get their community's latest day and window
    counts from ``stats`` by an equi-join on the object keys and a salt of the
    unit price (the one row a community on the right is repeated for every
    salt), and are then reduced to (community, window, band, unit price); so
    the grain of a community with a large share of all listings is spread over
    tasks all the way, and no window runs over it."""
    is_house = F.col("obj_type") == S.OBJ_HOUSE
    right = stats.where(is_house & ((F.col("n_cur") > segment) | (F.col("n_prev") > segment))).select(
        *S.OBJECT_KEYS, "latest", "n_cur", "n_prev", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])).alias("_salt")
    )
    salt = F.pmod(F.xxhash64("u"), F.lit(SALTS)).cast("int")
    j = grain.where(is_house).withColumn("_salt", salt).join(right, [*S.OBJECT_KEYS, "_salt"])
    w = cyclical_window("latest", as_of)
    cur, prev = _membership(F.col("first_slot"), F.col("end_slot"), w["s"], w["e"], w["p_s"], w["p_e"], previous)
    kinds = F.array(
        F.when(cur & (F.col("n_cur") > segment), F.lit("cur")),
        F.when(prev & (F.col("n_prev") > segment), F.lit("prev")),
    )
    # The salt is a function of the unit price: grouping by it changes nothing,
    # and the join's partitioning on (object, salt) serves the aggregate.
    per_kind = (
        j.select(*S.OBJECT_KEYS, "_salt", "band_lo", "u", "n", "price_yuan", "area", F.explode(kinds).alias("kind"))
        .where(F.col("kind").isNotNull())
        .groupBy(*S.OBJECT_KEYS, "_salt", "kind", "band_lo", "u")
        .agg(F.sum("n").alias("cnt"), F.sum("price_yuan").alias("sp"), F.sum("area").alias("sa"))
        .drop("_salt")
    )
    return house_price(per_kind, [*S.OBJECT_KEYS, "kind"], area_bands=area_bands, segment=segment)


def house_prices(
    grain: DataFrame,
    stats: DataFrame,
    as_of,
    *,
    previous: str = "cover",
    area_bands: str = "all",
    segment: int = SEGMENT,
) -> DataFrame:
    """``(dim, obj_type, city_id, obj_key) -> hp_cur, hp_prev``: the robust
    price of :func:`community_prices` per window, one row per community."""
    hp = community_prices(grain, stats, as_of, previous=previous, area_bands=area_bands, segment=segment)
    return hp.groupBy(*S.OBJECT_KEYS).agg(
        F.max(F.when(F.col("kind") == "cur", F.col("price"))).alias("hp_cur"),
        F.max(F.when(F.col("kind") == "prev", F.col("price"))).alias("hp_prev"),
    )



def listing_metric_rows(stats: DataFrame, prices: DataFrame | None, *, segment: int = SEGMENT, indexes=None) -> DataFrame:
    if prices is not None:
        # Price rows exist for communities only, whose keys are never null.
        stats = stats.join(prices, list(S.OBJECT_KEYS), "left")
    else:
        stats = stats.withColumn("hp_cur", F.lit(None).cast("double")).withColumn("hp_prev", F.lit(None).cast("double"))
    is_house = F.col("obj_type") == S.OBJ_HOUSE
    plain_cur = ratio(F.col("y_cur"), F.col("a_cur"))
    plain_prev = ratio(F.col("y_prev"), F.col("a_prev"))
    price_cur = F.when(is_house & (F.col("n_cur") > segment), F.col("hp_cur")).otherwise(plain_cur)
    price_prev = F.when(F.col("n_prev") > 0, F.when(is_house & (F.col("n_prev") > segment), F.col("hp_prev")).otherwise(plain_prev))
    vol_cur = F.col("n_cur").cast("double")
    vol_prev = F.when(F.col("n_prev") > 0, F.col("n_prev").cast("double"))
    specs = {
        S.INDEX_QUOTED_PRICE_AVG: MetricSpec(
            F.lit(S.INDEX_QUOTED_PRICE_AVG), F.lit(S.PERIOD_TYPE_PERIOD), F.col("period"),
            price_cur, price_prev, change_pct(price_cur, price_prev),
        ),
        S.INDEX_QUOTED_VOLUME: MetricSpec(
            F.lit(S.INDEX_QUOTED_VOLUME), F.lit(S.PERIOD_TYPE_PERIOD), F.col("period"),
            vol_cur, vol_prev, change_pct(vol_cur, vol_prev),
        ),
    }
    chosen = list(specs) if indexes is None else list(indexes)
    return to_metric_rows(stats, [specs[i] for i in chosen])


def listing_metrics(
    listings: DataFrame,
    dim: DataFrame,
    ds: str,
    as_of,
    *,
    emit_plate: bool = False,
    previous: str = "cover",
    area_bands: str = "all",
    segments=None,
    indexes=None,
) -> DataFrame:
    """The listings job: tall QUOTED_* rows for SECOND.

    ``emit_plate`` adds PLATE rows (the production job computes and then drops
    them); ``previous="overlap"`` uses the same overlap rule for the previous
    window as for the current one; ``area_bands="dominant"`` restricts the
    robust price to the main area bands.
    """
    clean = clean_listings(listings, dim, ds, as_of, segments=segments)
    grain = listing_grain(clean, as_of, levels=LEVELS_WITH_PLATE if emit_plate else LEVELS)
    wants_price = indexes is None or S.INDEX_QUOTED_PRICE_AVG in indexes
    if wants_price:
        # Read by the object stats and by the community price: written once.
        grain = materialize(grain, "listing-grain")
    stats = listing_object_stats(grain, as_of, previous=previous)
    prices = house_prices(grain, stats, as_of, previous=previous, area_bands=area_bands) if wants_price else None
    return listing_metric_rows(stats, prices, indexes=indexes)
