"""Robust community asking price: a histogram mode over unit prices.

For one community and one window with more than ``segment`` listings:

* main rows -- all rows (default), or with ``area_bands="dominant"`` the
  largest area bands (by listing count, ties to the lower band) until they
  cover more than half of the listings;
* unit price ``u = (price_cents div 100) div area`` (integer divisions);
* ``pitch = (max(u) - min(u)) div segment``; bucket ``ceil((u - min) / pitch)``
  (pitch 0: the minimum in bucket 0, everything else in one other bucket);
* the unique largest bucket gives the mode ``sum(u) div count``; a tie gives
  none;
* without a mode the price is the main rows' area-weighted average; with one
  more than 20 % away from the average of *all* rows it is that average, else
  the mode.  (With all rows as main rows both averages are the same.)

Input is a *grain* ``(keys..., band_lo, u) -> cnt, sp, sa``, one row per distinct
band and unit price (bounded by the listing filters, 1,000 .. 500,000), however
many listings there are.  Counts and extremes are taken per band by a partially
aggregated group-by; the windows run over those at most 21 rows a group, and over
its few buckets, never over the grain.  The limits are joined back to the grain on
the keys, the band and a salt of the unit price, and the buckets are summed by
another partial aggregate, so the rows of a hot community stay spread over tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions.numeric import ratio

SEGMENT = 3
MAX_GAP = 0.2
SALTS = 8  # tasks over which the grain of one group and band may spread
# A value above every other bucket index: where a saturated integer
# conversion of +infinity lands when the pitch is zero (all prices above the
# minimum share one bucket).
OVERFLOW_BUCKET = 2147483647


def _div(a: Column, b: Column) -> Column:
    """SQL ``div`` of whole numbers (truncating); null for a zero divisor."""
    return F.call_function("div", a, F.nullif(b, F.lit(0)))


def unit_price(price_cents: Column, area_int: Column) -> Column:
    return _div(_div(price_cents, F.lit(100)), area_int)


def house_price(
    grain: DataFrame,
    keys: Sequence[str],
    *,
    area_bands: str = "all",
    segment: int = SEGMENT,
) -> DataFrame:
    """``keys -> n_main, mode, avg (of the main rows), price`` for each group of the grain."""
    if area_bands not in ("all", "dominant"):
        raise ValueError("area_bands must be 'all' or 'dominant'")
    # One row a group and band (21 bands at most): counts and extremes.
    bands = grain.groupBy(*keys, "band_lo").agg(
        F.sum("cnt").alias("_band_n"),
        F.min("u").alias("_lo"),
        F.max("u").alias("_hi"),
        F.sum("sp").alias("_band_sp"),
        F.sum("sa").alias("_band_sa"),
    )
    w = Window.partitionBy(*keys)
    bands = bands.withColumn("_whole", ratio(F.sum("_band_sp").over(w), F.sum("_band_sa").over(w)))
    if area_bands == "dominant":
        ordered = w.orderBy(F.col("_band_n").desc(), F.col("band_lo").asc()).rowsBetween(Window.unboundedPreceding, -1)
        before = F.coalesce(F.sum("_band_n").over(ordered), F.lit(0))
        bands = bands.withColumn("_main", before * 2 <= F.sum("_band_n").over(w)).where("_main")
    limits = bands.select(*keys, "band_lo", F.min("_lo").over(w).alias("_min"), F.max("_hi").over(w).alias("_max"), "_whole")

    # The grain rows of one group are spread by a salt of the unit price, and
    # each limit is repeated for every salt, so no task holds a hot group.
    salt = F.pmod(F.xxhash64("u"), F.lit(SALTS)).cast("int")
    salted = limits.withColumn("_salt", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])))
    g = grain.withColumn("_salt", salt).join(salted, [*keys, "band_lo", "_salt"])
    pitch = _div(F.col("_max") - F.col("_min"), F.lit(segment))
    steps = F.ceil(F.try_divide((F.col("u") - F.col("_min")).cast("double"), pitch.cast("double")))
    bucket = (
        F.when(pitch == 0, F.when(F.col("u") == F.col("_min"), F.lit(0)).otherwise(F.lit(OVERFLOW_BUCKET)))
        .otherwise(steps)
        .cast("long")
    )
    b = g.groupBy(*keys, bucket.alias("bucket")).agg(
        F.sum("cnt").alias("nb"),
        F.sum(F.col("u") * F.col("cnt")).alias("su"),
        F.sum("sp").alias("sp"),
        F.sum("sa").alias("sa"),
        F.max("_whole").alias("_whole"),
    )
    b = b.withColumn("_top", F.max("nb").over(w))  # a handful of buckets a group
    top = F.col("nb") == F.col("_top")
    r = b.groupBy(*keys).agg(
        F.sum("nb").alias("n_main"),
        F.sum(F.when(top, 1).otherwise(0)).alias("_ties"),
        F.max(F.when(top, _div(F.col("su"), F.col("nb")))).alias("_mode"),
        F.sum("sp").alias("_sp"),
        F.sum("sa").alias("_sa"),
        F.max("_whole").alias("_whole"),
    )
    avg = ratio(F.col("_sp"), F.col("_sa"))
    mode = F.when(F.col("_ties") == 1, F.col("_mode").cast("double"))
    whole = F.col("_whole")
    far = F.abs(F.try_divide(mode - whole, mode)) > F.lit(MAX_GAP)
    return r.select(
        *keys,
        "n_main",
        mode.alias("mode"),
        avg.alias("avg"),
        F.when(mode.isNull(), avg).when(F.coalesce(far, F.lit(True)), whole).otherwise(mode).alias("price"),
    )
