import pytest

from tallyhouse.operators.listings import clean_listings, listing_metrics

AS_OF = "2018-09-22"
DS = "2018-09-21"
DIM = [("1", "10", "3", "x@5", 2)]
OK = dict(area="50", quoted_price="100000000", evaluation_high_price="150000000", total_floors="20", status="3")


def _listing(first, last, **over):
    v = dict(OK, **over)
    return ("1", "10", first, last, v["area"], v["quoted_price"], v["evaluation_high_price"], v["total_floors"], v["status"], DS)


LISTINGS = [
    _listing("2018-09-10", "2018-09-16"),
    _listing("2018-09-01 10:00:00", "2018-09-16", area="100", quoted_price="300000000", evaluation_high_price="300000000"),
    _listing("2018-09-09", "2018-09-14"),
    _listing("2018-09-10", "2018-09-16", status="1"),
    _listing("2018-09-10", "2018-09-16", area="0.5"),
    _listing("2018-09-10", "2018-09-16", quoted_price="100"),
    _listing("2018-09-10", "2018-09-16", evaluation_high_price="300000000"),
    _listing("2018-09-10", "2018-09-16", evaluation_high_price=None),
    _listing("2018-09-22", "2018-09-23"),
]
SCHEMA = (
    "city_id string, house_id string, first_pub_date string, last_pub_date string, area string, quoted_price string, "
    "evaluation_high_price string, total_floors string, status string, ds string"
)


@pytest.fixture(scope="module")
def frames(spark):
    dim = spark.createDataFrame(DIM, "biz_city_id string, biz_house_id string, biz_district_id string, plate_fk string, is_first int")
    return spark.createDataFrame(LISTINGS, SCHEMA), dim


def test_quality_filters_and_clipping(spark, frames):
    listings, dim = frames
    rows = clean_listings(listings, dim, DS, AS_OF).collect()
    assert len(rows) == 3
    clipped = clean_listings(spark.createDataFrame([_listing("2018-09-01", "2018-09-30")], SCHEMA), dim, DS, AS_OF).first()
    assert str(clipped.end_day) == "2018-09-21"
    open_ended = clean_listings(spark.createDataFrame([_listing("2018-09-01 10:00:00", None)], SCHEMA), dim, DS, AS_OF).first()
    assert str(open_ended.end_day) == "2018-09-01"


def test_overlap_and_cover_windows(spark, frames):
    listings, dim = frames
    got = {(r["index"], r.obj_value): r for r in listing_metrics(listings, dim, DS, AS_OF).collect()}
    v = got[("QUOTED_VOLUME", "city:1,house:10")]
    assert (v.period_value, v.current_result, v.previous_result, v.mom) == ("SevenDays", 2.0, 1.0, 100.0)
    p = got[("QUOTED_PRICE_AVG", "city:1")]
    assert p.current_result == pytest.approx(4000000 / 150)
    assert p.previous_result == pytest.approx(30000.0)
    assert p.mom == pytest.approx((4000000 / 150 - 30000) * 100 / 30000)
    assert ("QUOTED_VOLUME", "city:1,plate:5") not in got
    with_plate = {(r["index"], r.obj_value) for r in listing_metrics(listings, dim, DS, AS_OF, emit_plate=True).collect()}
    assert ("QUOTED_VOLUME", "city:1,plate:5") in with_plate
    overlap = {(r["index"], r.obj_value): r for r in listing_metrics(listings, dim, DS, AS_OF, previous="overlap").collect()}
    assert overlap[("QUOTED_VOLUME", "city:1")].previous_result == 3.0
