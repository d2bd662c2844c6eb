import datetime as dt


from tallyhouse.functions.periods import cyclical_table, cyclical_window, month_window

D = dt.date.fromisoformat

# Hand-worked look-back windows for as-of 2018-09-22.
EXPECTED = [
    ("Yesterday", "2018-09-21", "2018-09-21", "2018-09-20", "2018-09-20"),
    ("SevenDays", "2018-09-15", "2018-09-21", "2018-09-08", "2018-09-14"),
    ("ThirtyDays", "2018-08-23", "2018-09-21", "2018-07-24", "2018-08-22"),
    ("SixtyDays", "2018-07-24", "2018-09-21", "2018-05-25", "2018-07-23"),
    ("NinetyDays", "2018-06-24", "2018-09-21", "2018-03-26", "2018-06-23"),
    ("SixMonths", "2018-03-26", "2018-09-21", "2017-09-27", "2018-03-25"),
    ("OneYear", "2017-09-27", "2018-09-21", "2016-10-02", "2017-09-26"),
]


def test_cyclical_table():
    got = [(n, *(d.isoformat() for d in ds)) for n, *ds in cyclical_table("2018-09-22")]
    assert got == EXPECTED


def test_cyclical_window_lookup(spark):
    days = ["2018-09-21", "2018-09-20", "2018-09-15", "2018-09-14", "2017-09-27", "2017-09-26", "2018-09-22", "2019-01-01"]
    df = spark.createDataFrame([(D(d),) for d in days], "d date")
    rows = df.select("d", cyclical_window("d", "2018-09-22")["period"].alias("p")).collect()
    got = {r.d.isoformat(): r.p for r in rows}
    assert got == {
        "2018-09-21": "Yesterday",
        "2018-09-20": "SevenDays",
        "2018-09-15": "SevenDays",
        "2018-09-14": "ThirtyDays",
        "2017-09-27": "OneYear",
        "2017-09-26": None,
        "2018-09-22": None,
        "2019-01-01": None,
    }


def test_month_window(spark):
    df = spark.createDataFrame([(D("2018-06-15"),), (D("2018-02-10"),), (D("2018-03-31"),)], "d date")
    w, c = month_window("d"), month_window("d", calendar_months=True)
    rows = df.select("d", w.alias("w"), c["p_e"].alias("cal")).collect()
    got = {r.d.isoformat(): (r.w.period, str(r.w.s), str(r.w.e), str(r.w.p_s), str(r.w.p_e), str(r.cal)) for r in rows}
    assert got == {
        "2018-06-15": ("2018-06", "2018-06-01", "2018-06-30", "2018-05-01", "2018-05-30", "2018-05-31"),
        "2018-02-10": ("2018-02", "2018-02-01", "2018-02-28", "2018-01-01", "2018-01-28", "2018-01-31"),
        "2018-03-31": ("2018-03", "2018-03-01", "2018-03-31", "2018-02-01", "2018-02-28", "2018-02-28"),
    }


def test_month_window_null(spark):
    df = spark.createDataFrame([(None,)], "d date")
    assert df.select(month_window("d").alias("w")).first().w is None


def test_in_window(spark):
    from pyspark.sql import functions as F

    from tallyhouse.functions.periods import in_window

    df = spark.createDataFrame([(D("2018-09-14"),), (D("2018-09-15"),), (D("2018-09-08"),)], "d date")
    w = cyclical_window("d", "2018-09-22")  # each day's own window
    rows = df.select(
        "d",
        in_window(F.col("d"), F.lit(None).cast("struct<period:string,s:date,e:date,p_s:date,p_e:date>")).alias("none"),
        in_window(F.col("d"), w).alias("cur"),
        in_window(F.col("d"), w, previous=True).alias("prev"),
    ).collect()
    assert all(r.none is None for r in rows)
    assert all(r.cur for r in rows) and not any(r.prev for r in rows)
