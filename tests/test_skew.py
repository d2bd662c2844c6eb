"""A community holding far more than a third of all rows: results stay exact
and the plans never window over raw rows."""

import datetime as dt
import random
import re

from tallyhouse.operators.deals import deal_metrics
from tallyhouse.operators.listings import listing_metrics

from .test_bruteforce import AS_OF, DS, _round, python_deal_metrics, python_listing_metrics

DIM = [("1", "hot", "a", "p1", 2), ("1", "hot", "a", "p1", 1), ("1", "c1", None, None, 2), ("2", "c2", "b", "p2", 1)]
DIM_SCHEMA = "biz_city_id string, biz_house_id string, biz_district_id string, plate_fk string, is_first int"


def _dim_df(spark):
    return spark.createDataFrame([(c, h, d, (f"x@{p}" if p else "p"), s) for c, h, d, p, s in DIM], DIM_SCHEMA)


def test_skewed_deals(spark):
    rnd = random.Random(5)
    deals = []
    for i in range(900):
        c, h = ("1", "hot") if i % 5 else rnd.choice([("1", "c1"), ("2", "c2")])
        day = AS_OF - dt.timedelta(days=rnd.randint(1, 700))
        deals.append((c, h, day, f"{rnd.randint(100, 999)}.25", "500", rnd.choice(["1", "2", None]), str(rnd.randint(1, 5))))
    release = {"1": AS_OF - dt.timedelta(days=40), "2": AS_OF - dt.timedelta(days=70)}
    deal_df = spark.createDataFrame(
        [(c, h, d.isoformat(), t, e, lab, a, DS) for c, h, d, t, e, lab, a in deals],
        "city_id string, house_id string, bargaindate string, totalprice string, eval_totalprice string, "
        "price_label string, bargain_area string, ds string",
    )
    rel_df = spark.createDataFrame([(int(c), None, d) for c, d in release.items()],
                                   "city_id long, new_updated date, second_updated date")
    out = deal_metrics(deal_df, _dim_df(spark), rel_df, DS, AS_OF)
    got = {_round(tuple(r)[:9]) for r in out.collect()}
    assert got == {_round(r) for r in python_deal_metrics(deals, DIM, release)}
    plan = re.sub(r"#\d+L?", "", out._jdf.queryExecution().executedPlan().toString())
    window_at = plan.index("Window [max(last_day)")
    # Below the window there is the slot-grain aggregate, not the raw deals.
    assert plan.find("HashAggregate(keys=[dim, obj_type, city_id, obj_key, slot_first, slot_last]", window_at) > window_at


def test_skewed_listings(spark):
    rnd = random.Random(6)
    listings = []
    for i in range(600):
        c, h = ("1", "hot") if i % 4 else rnd.choice([("1", "c1"), ("2", "c2")])
        first = AS_OF - dt.timedelta(days=rnd.randint(1, 400))
        last = first + dt.timedelta(days=rnd.randint(0, 90))
        area = rnd.randint(30, 300)
        cents = area * rnd.choice([1500000, 1510000, rnd.randint(1000000, 3000000)])
        listings.append((c, h, first.isoformat(), last.isoformat(), str(area), str(cents), str(cents), "20", "5"))
    lst_df = spark.createDataFrame(
        [(*row, DS) for row in listings],
        "city_id string, house_id string, first_pub_date string, last_pub_date string, area string, "
        "quoted_price string, evaluation_high_price string, total_floors string, status string, ds string",
    )
    out = listing_metrics(lst_df, _dim_df(spark), DS, AS_OF)
    got = {_round(tuple(r)[:9]) for r in out.collect()}
    assert got == {_round(r) for r in python_listing_metrics(listings, DIM)}


def test_hot_community_prices_stay_spread(spark):
    """Without broadcasts: no join or window brings the grain of one community into one task."""
    from tallyhouse.operators import listings as L

    rows = [("SECOND", "HOUSE", "1", "hot", 90, 1000 + i, 1, 10.0, 1.0) for i in range(4000)]
    rows += [("SECOND", "HOUSE", "1", f"c{i}", 90, 1000 + i, 9, 10.0, 1.0) for i in range(40)]
    first, end = AS_OF - dt.timedelta(days=400), AS_OF - dt.timedelta(days=1)
    grain = spark.createDataFrame(
        [(*r, first, end, end) for r in rows],
        "dim string, obj_type string, city_id string, obj_key string, band_lo int, u long, n long, price_yuan double, "
        "area double, first_slot date, end_slot date, last_end date",
    )
    keep = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        stats = L.listing_object_stats(grain, AS_OF)
        out = L.community_prices(grain, stats, AS_OF)
        plan = re.sub(r"#\d+L?", "", out._jdf.queryExecution().executedPlan().toString())
        prices = {(r.obj_key, r.kind): r.n_main for r in out.collect()}
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    assert prices[("hot", "cur")] == 4000 and prices[("c3", "cur")] == 9
    joins = [ln for ln in plan.splitlines() if "SortMergeJoin" in ln]
    assert len(joins) >= 2 and all("_salt]" in ln.split("], [")[0] + "]" for ln in joins), joins
    # between the limits' join and the buckets there is a shuffle after partial aggregation
    top = plan.index("SortMergeJoin")
    assert re.search(r"Exchange hashpartitioning\(dim, obj_type, city_id, obj_key, kind, (bucket|_groupingexpression), ", plan[:top])
    assert "partial_sum(" in plan[:top]
    # windows see bands or buckets, never grain rows
    for ln in plan.splitlines():
        if "Window [" in ln:
            assert "max(nb)" in ln or "min(_lo)" in ln or "max(_hi)" in ln, ln
