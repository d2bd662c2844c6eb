import pytest
from pyspark.sql import functions as F

from tallyhouse.operators.houseprice import house_price

CASES = {
    "a": ([100, 101, 102, 130, 160, 161], 101),
    "b": ([100, 101, 130, 131], None),
    "c": ([100, 101, 102, 102], 101),
    "d": ([100, 100, 100, 100], 100),
    "e": ([10, 12, 13, 14, 15], None),
}


def _grain(spark, cases, band=lambda u: 90):
    rows = []
    for key, (units, _) in cases.items():
        for u in units:
            rows.append((key, band(u), u, 1, float(u), 1.0))
    df = spark.createDataFrame(rows, "k string, band_lo int, u long, cnt long, sp double, sa double")
    return df.groupBy("k", "band_lo", "u").agg(F.sum("cnt").alias("cnt"), F.sum("sp").alias("sp"), F.sum("sa").alias("sa"))


def test_histogram_mode(spark):
    got = {r.k: r.mode for r in house_price(_grain(spark, CASES), ["k"]).collect()}
    assert got == {k: (None if m is None else float(m)) for k, (_, m) in CASES.items()}


def test_fallback_to_average(spark):
    got = {r.k: (r.mode, r.avg, r.price) for r in house_price(_grain(spark, CASES), ["k"]).collect()}
    mode, avg, price = got["a"]
    assert avg == pytest.approx(754 / 6)
    assert abs(mode - avg) / mode > 0.2 and price == avg  # mode too far away
    assert got["c"][2] == 101.0  # mode within 20 % of 101.25
    assert got["b"][2] == got["b"][1]  # tie: average


def test_dominant_bands(spark):
    # 3 listings in band 60, 2 in band 70, 1 in band 90: bands 60 (3/6, not
    # yet more than half) and 70 are kept, band 90 is dropped.
    units = {"k": ([100, 100, 100, 200, 200, 900], None)}
    bands = {100: 60, 200: 70, 900: 90}
    g = _grain(spark, units, band=lambda u: bands[u])
    dom = house_price(g, ["k"], area_bands="dominant").first()
    allb = house_price(g, ["k"]).first()
    assert dom.n_main == 5 and allb.n_main == 6
    assert dom.avg == pytest.approx(140.0)
    assert dom.mode == 100.0
    # The mode is more than 20 % away from the average of all six: that average counts.
    assert dom.price == pytest.approx(1600 / 6) and allb.price == pytest.approx(1600 / 6)


def test_dominant_bands_near_the_whole_average(spark):
    # Main rows (band 60) average 100; the whole average is 110: the mode stays.
    units = {"k": ([100, 100, 100, 100, 130, 130], None), "tie": ([100, 101, 130, 131, 500], None)}
    bands = {100: 60, 101: 60, 130: 70, 131: 70, 500: 90}
    got = {r.k: r for r in house_price(_grain(spark, units, band=lambda u: bands[u]), ["k"], area_bands="dominant").collect()}
    assert (got["k"].mode, got["k"].avg, got["k"].price) == (100.0, 100.0, 100.0)
    # No mode among the main rows (a tie): their own average, not the whole one.
    assert got["tie"].n_main == 4 and got["tie"].mode is None and got["tie"].price == pytest.approx(115.5)
