from pyspark.sql import functions as F

from tallyhouse.functions.bands import band_lower, band_upper_of
from tallyhouse.functions.labels import object_label
from tallyhouse.functions.numeric import change_pct, parse_amount, parse_day, ratio


def test_area_bands(spark):
    areas = [60, 61, 120, 135, 500, 501, 0, 1000000]
    df = spark.createDataFrame([(a,) for a in areas], "a long")
    rows = df.select("a", band_lower("a").alias("lo")).withColumn("hi", band_upper_of("lo")).collect()
    got = {r.a: (r.lo, r.hi) for r in rows}
    assert got == {
        60: (0, 60), 61: (60, 70), 120: (110, 120), 135: (120, 135), 500: (450, 500),
        501: (500, 999999), 0: (90, 100), 1000000: (90, 100),
    }


def test_labels_with_null_keys(spark):
    df = spark.createDataFrame(
        [("CITY", "1", None), ("DISTRICT", "1", "3"), ("PLATE", "1", None), ("HOUSE", "1", "77")],
        "t string, c string, k string",
    )
    got = [r[0] for r in df.select(object_label("t", "c", "k")).collect()]
    assert got == ["city:1", "city:1,district:3", "city:1,plate:null", "city:1,house:77"]


def test_mom_and_ratio(spark):
    df = spark.createDataFrame([(110.0, 100.0), (5.0, None), (1.0, 0.0)], "c double, p double")
    got = [r[0] for r in df.select(change_pct(F.col("c"), F.col("p"))).collect()]
    assert got == [10.0, None, None]
    assert spark.range(1).select(ratio(F.lit(1), F.lit(0))).first()[0] is None


def test_parsers_are_total(spark):
    df = spark.createDataFrame([("2018-09-21 10:00:00", "12.5"), ("bad", "x"), (None, None)], "d string, a string")
    rows = df.select(parse_day(F.col("d")).alias("d"), parse_amount(F.col("a")).alias("a")).collect()
    assert str(rows[0].d) == "2018-09-21" and float(rows[0].a) == 12.5
    assert rows[1].d is None and rows[1].a is None
    assert rows[2].d is None and rows[2].a is None


def test_a_day_is_the_text_before_the_first_blank(spark):
    texts = ["2018-09-21", "2018-09-21 10:00:00", "2018-09-2199", "2018-09-21garbage", " 2018-09-21", "2018-13-01", ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, d string")
    got = [r.d for r in df.select("i", parse_day(F.col("d")).alias("d")).orderBy("i").collect()]
    assert [str(d) if d else None for d in got] == ["2018-09-21", "2018-09-21"] + [None] * 5


def test_unit_price_is_whole_number_division(spark):
    from tallyhouse.operators.houseprice import unit_price

    df = spark.createDataFrame([(1234567, 7), (99, 3), (-250, 2), (100, 0), (None, 1)], "q long, a long")
    out = df.select(unit_price(F.col("q"), F.col("a")).alias("u"))
    assert [r.u for r in out.collect()] == [1763, 0, -1, None, None]
    assert "decimal" not in out._jdf.queryExecution().toString()


def test_long_and_fine_amounts(spark):
    rows = [("123456789012345",), ("12345678901234567890.123456789",), ("12.34567",), ("1e3",), ("100000000000000000000",), ("x",), ("",), (None,)]
    out = spark.createDataFrame(rows, "v string").select(parse_amount(F.col("v")).cast("string").alias("a"))
    assert [r.a for r in out.collect()] == [
        "123456789012345.00000000", "12345678901234567890.12345679", "12.34567000", "1000.00000000", None, None, None, None,
    ]
    total = spark.createDataFrame([("99999999999999999999",)] * 1000, "v string").agg(F.sum(parse_amount(F.col("v"))).alias("s"))
    assert int(total.first().s) == 99999999999999999999 * 1000


def test_days_take_the_full_form_only(spark):
    good = ["2001-01-05", "2001-01-05 10:00:00", "2000-02-29 x", "0001-01-01"]
    bad = ["2001-1-05", "2001-01-5", "2001-01-05T10", "2001-01-0T", "2001-02-30", "2001-01", "+2001-01-05", "20010-01-05",
           " 2001-01-05", "2001-01-0599", "2001-01-05garbage", "2001/01/05", "", "-001-01-05", "2001-01-0\u0665"]
    rows = spark.createDataFrame([(v,) for v in good + bad] + [(None,)], "v string")
    got = [r.d for r in rows.select(parse_day(F.col("v")).alias("d")).collect()]
    assert [d.isoformat() for d in got[:4]] == [v[:10] for v in good] and got[4:] == [None] * (len(bad) + 1)
