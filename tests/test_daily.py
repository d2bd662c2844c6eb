"""The daily job end to end on metastore tables built from the test data."""

import datetime as dt

from tallyhouse.operators.listings import listing_metrics
from tallyhouse.plans import daily
from tallyhouse.sources import testdata as td

from .conftest import SF_SMALL


def test_daily_job_writes_one_partition(spark, tmp_path):
    td.deal_fact(spark, SF_SMALL).write.mode("overwrite").partitionBy("ds").parquet(str(tmp_path / "deals"))
    td.listing_fact(spark, SF_SMALL).write.mode("overwrite").partitionBy("ds").parquet(str(tmp_path / "listings"))
    for name, path in (("th_deals", "deals"), ("th_listings", "listings")):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{tmp_path / path}'")
        spark.sql(f"MSCK REPAIR TABLE {name}")
    td.community_dim(spark, SF_SMALL).createOrReplaceTempView("th_dim")
    td.release_dates(spark, SF_SMALL).createOrReplaceTempView("th_release")
    out = str(tmp_path / "out")
    args = daily.parser().parse_args(
        ["--as-of", td.AS_OF, "--deals-table", "th_deals", "--listings-table", "th_listings", "--dim-table", "th_dim",
         "--release-table", "th_release", "--out-path", out]
    )
    rows = daily.run(spark, args)
    expected = rows.count()
    daily.run(spark, args)  # re-run: partition replaced, not doubled
    back = spark.read.parquet(out)
    assert back.where(back.ds == td.DS).count() == expected > 0
    variant = daily.parser().parse_args(
        ["--as-of", td.AS_OF, "--deals-table", "th_deals", "--listings-table", "th_listings", "--dim-table", "th_dim",
         "--release-table", "th_release", "--out-path", str(tmp_path / "variant"), "--calendar-months", "--emit-plate",
         "--previous", "overlap", "--area-bands", "dominant", "--segments", "2",
         "--release-jdbc-option", "user=a", "--export-jdbc-option", "user=b"]
    )
    assert daily.pairs(variant.release_jdbc_option) == {"user": "a"} and daily.pairs(variant.export_jdbc_option) == {"user": "b"}
    daily.run(spark, variant)
    got = spark.read.parquet(str(tmp_path / "variant")).where("dim = 'SECOND' AND index LIKE 'QUOTED%'")
    want = listing_metrics(
        td.listing_fact(spark, SF_SMALL), td.community_dim(spark, SF_SMALL), td.DS, td.AS_OF,
        emit_plate=True, previous="overlap", area_bands="dominant", segments=("2",),
    )
    assert "PLATE" in {r.obj_type for r in got.collect()}
    key = lambda r: tuple(repr(r[c]) for c in want.columns)
    assert sorted(map(key, got.collect())) == sorted(map(key, want.collect()))
    assert daily.day_before(dt.date(2018, 3, 1)) == "2018-02-28"
