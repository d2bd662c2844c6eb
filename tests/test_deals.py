import datetime as dt

import pytest

from tallyhouse.operators.deals import deal_metrics, enrich_deals

AS_OF = "2018-09-22"
DS = "2018-09-21"
DIM = [
    ("1", "10", "3", "x@5", 1),
    ("1", "20", None, "p", 2),
    ("1", "30", "4", "y@6", 2),
]
DEALS = [
    # city, house, day, total, eval, label, area, ds
    ("1", "10", "2018-09-21", "110", "0", None, "1", DS),
    ("1", "10", "2018-09-20", "100", "0", "2", "1", DS),
    ("1", "20", "2018-09-10", "300", "200", "2", "2", DS),
    ("1", "20", "2018-08-15", "100", "50", "1", "1", DS),
    ("1", "30", "2018-09-25", "100", "100", None, "1", DS),
    ("1", "10", "2018-09-21", "999", "999", None, "1", "2018-09-20"),
]


@pytest.fixture(scope="module")
def frames(spark):
    dim = spark.createDataFrame(DIM, "biz_city_id string, biz_house_id string, biz_district_id string, plate_fk string, is_first int")
    deals = spark.createDataFrame(
        DEALS,
        "city_id string, house_id string, bargaindate string, totalprice string, eval_totalprice string, "
        "price_label string, bargain_area string, ds string",
    )
    release = spark.createDataFrame([(1, None, dt.date(2018, 8, 31))], "city_id long, new_updated date, second_updated date")
    return deals, dim, release


def _rows(df):
    return {(r.dim, r["index"], r.obj_value): r for r in df.collect()}


def test_enrich_effective_price_and_plate(spark, frames):
    deals, dim, _ = frames
    rows = enrich_deals(deals, dim, DS).collect()
    assert len(rows) == 5
    by = {(r.house_id, str(r.deal_day)): r for r in rows}
    assert float(by[("20", "2018-09-10")].price) == 200.0  # reference label -> appraised
    assert float(by[("10", "2018-09-20")].price) == 100.0  # NEW ignores the label
    assert by[("10", "2018-09-21")].plate_id == "5"
    assert by[("20", "2018-09-10")].plate_id is None


def test_deal_metrics(spark, frames):
    deals, dim, release = frames
    got = _rows(deal_metrics(deals, dim, release, DS, AS_OF))
    p = got[("NEW", "DEAL_PRICE_AVG", "city:1,house:10")]
    assert (p.period_type, p.period_value, p.current_result, p.previous_result, p.mom) == ("Period", "Yesterday", 110.0, 100.0, 10.0)
    v = got[("NEW", "DEAL_VOLUME", "city:1")]
    assert (v.period_value, v.current_result, v.previous_result, v.mom) == ("Yesterday", 1.0, 1.0, 0.0)
    t = got[("SECOND", "TOTAL_DEAL_VOLUME", "city:1")]
    assert (t.period_type, t.period_value, t.current_result, t.previous_result) == ("Total", "Total", 3.0, None)
    h = got[("SECOND", "DEAL_PRICE_AVG", "city:1,house:20")]
    assert (h.period_value, h.current_result, h.previous_result, h.mom) == ("ThirtyDays", 100.0, 100.0, 0.0)
    hm = got[("SECOND", "DEAL_VOLUME", "city:1,house:20")]
    assert (hm.period_type, hm.period_value, hm.current_result, hm.previous_result) == ("Month", "2018-09", 1.0, 1.0)
    cm = got[("SECOND", "DEAL_VOLUME", "city:1")]
    assert (cm.period_type, cm.period_value, cm.current_result, cm.previous_result) == ("Month", "2018-08", 1.0, None)
    # The latest SECOND deal of the city is in the future: no cyclical window.
    assert ("SECOND", "DEAL_PRICE_AVG", "city:1") not in got
    assert got[("SECOND", "DEAL_VOLUME", "city:1,house:30")].period_value == "2018-09"
    assert ("SECOND", "DEAL_PRICE_AVG", "city:1,house:30") not in got
    assert got[("SECOND", "TOTAL_DEAL_VOLUME", "city:1,district:null")].current_result == 2.0
    assert ("SECOND", "TOTAL_DEAL_VOLUME", "city:1,plate:null") in got
    assert all(r.yoy is None for r in got.values())


def test_no_release_date_no_month_volume(spark, frames):
    deals, dim, _ = frames
    got = _rows(deal_metrics(deals, dim, None, DS, AS_OF))
    assert ("SECOND", "DEAL_VOLUME", "city:1") not in got
    assert ("SECOND", "DEAL_VOLUME", "city:1,house:20") in got


def test_repeated_city_takes_latest_release_day(spark):
    from tallyhouse.operators.deals import release_months

    rel = spark.createDataFrame(
        [(1, None, dt.date(2018, 7, 1)), (1, None, dt.date(2018, 8, 31)), (2, None, None), (3, dt.date(2018, 1, 1), None)],
        "city_id long, new_updated date, second_updated date",
    )
    got = {r._rel_city: r.release_day for r in release_months(rel).collect()}
    assert got == {"1": dt.date(2018, 8, 31)}
