"""Branch-coverage counts of the test-data adapters, as measured independently
with DuckDB when the fixtures were designed (sf0.001)."""

import pytest
from pyspark.sql import functions as F

from tallyhouse.functions.periods import cyclical_window
from tallyhouse.operators.deals import enrich_deals
from tallyhouse.sources import testdata as td

from .conftest import SF_SMALL


def test_dimension_shape(spark):
    dim = td.community_dim(spark, SF_SMALL)
    known = dim.where("is_first IN (1, 2)")
    assert known.count() == 11
    assert known.where(F.col("biz_district_id").isNull()).count() == 2
    assert known.where(F.col("plate_fk") == "p").count() == 2
    # copies without a segment code (k % 7 = 3) and with an unknown one (k % 9 = 4)
    assert dim.where("is_first IS NULL").count() > 0 and dim.where("is_first = 3").count() > 0


def test_houses_by_look_back_period(spark):
    e = enrich_deals(td.deal_fact(spark, SF_SMALL), td.community_dim(spark, SF_SMALL), td.DS)
    latest = e.groupBy("house_id").agg(F.max("deal_day").alias("latest"))
    label = F.coalesce(
        cyclical_window("latest", td.AS_OF)["period"],
        F.when(F.col("latest") >= F.lit(td.AS_OF).cast("date"), "future").otherwise("too old"),
    )
    got = {r.p: r["count"] for r in latest.select(label.alias("p")).groupBy("p").count().collect()}
    want = {"Yesterday": 1, "SixtyDays": 1, "NinetyDays": 1, "SixMonths": 2, "OneYear": 4, "too old": 1}
    assert got == want


def _release_month_rows(spark, sf_dir, calendar_months=False):
    from tallyhouse.operators.deals import deal_metrics

    rows = deal_metrics(
        td.deal_fact(spark, sf_dir), td.community_dim(spark, sf_dir), td.release_dates(spark, sf_dir),
        td.DS, td.AS_OF, calendar_months=calendar_months, indexes=["DEAL_VOLUME"],
    ).where((F.col("dim") == "SECOND") & (F.col("obj_type") == "CITY"))
    return {r.obj_value: r.previous_result for r in rows.collect()}


def test_release_month_cities(spark):
    assert len(_release_month_rows(spark, SF_SMALL)) == 5


def test_month_end_clamping_changes_two_cities(spark):
    sf = "/root/testdata/sf0.01"
    clamped, calendar = _release_month_rows(spark, sf), _release_month_rows(spark, sf, calendar_months=True)
    assert len(clamped) == len(calendar) == 18
    assert sum(clamped[k] != calendar[k] for k in clamped) == 2


@pytest.mark.parametrize(
    "sf_dir, kept, cur, prev",
    [
        (SF_SMALL, 1689, (4, 2, 0, 3), (3, 0, 0, 0)),
        ("/root/testdata/sf0.01", 16216, (37, 10, 7, 20), (48, 4, 5, 17)),
    ],
)
def test_house_price_branches(spark, sf_dir, kept, cur, prev):
    from tallyhouse.operators import listings as L

    # The design figures count each listing once (no segment fan-out).
    dim1 = td.community_dim(spark, sf_dir).dropDuplicates(["biz_city_id", "biz_house_id"])
    clean = L.clean_listings(td.listing_fact(spark, sf_dir), dim1, td.DS, td.AS_OF)
    assert clean.count() == kept
    grain = L.listing_grain(clean, td.AS_OF)
    stats = L.listing_object_stats(grain, td.AS_OF)
    details = L.community_prices(grain, stats, td.AS_OF).collect()
    houses = stats.where((F.col("obj_type") == "HOUSE") & F.col("period").isNotNull())

    def branches(kind, n_col):
        small = houses.where((F.col(n_col) > 0) & (F.col(n_col) <= 3)).count()
        rows = [r for r in details if r.kind == kind]
        tie = sum(r.mode is None for r in rows)
        used = sum(r.mode is not None and r.price == r.mode for r in rows)
        far = sum(r.mode is not None and r.price != r.mode for r in rows)
        return small, tie, far, used

    assert branches("cur", "n_cur") == cur
    assert branches("prev", "n_prev") == prev
