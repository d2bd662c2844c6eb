"""End-to-end: the registered queries against DuckDB, plan shape checks."""

import duckdb
import pytest

import __spark_entry__ as entry
from tallyhouse.plans import bench_tables as B
from tallyhouse.sources.testdata import TABLES

from .conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _canon(v):
    return round(v, 6) if isinstance(v, float) else v


def _same(df, con, sql):
    a = sorted((tuple(_canon(r[c]) for c in sorted(df.columns)) for r in df.collect()), key=repr)
    res = con.sql(sql)
    cols = res.columns
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    b = sorted((tuple(_canon(r[i]) for i in order) for r in res.fetchall()), key=repr)
    return sorted(df.columns) == sorted(cols) and a == b


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["dim", "index", "obj_type", "obj_value", "period_type", "period_value",
                          "current_result", "previous_result", "mom", "yoy"]
    assert df.count() > 0


def core(queries):
    """Without the optional training-data queries, some of which SQL cannot express."""
    return {q for q in queries if not q.startswith("op") and q != "pipeline"}


def test_every_query_has_an_oracle():
    assert core(entry.queries()) == core(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(core(entry.queries())))
def test_query_matches_oracle(spark, duck, name):
    assert _same(entry.queries()[name](spark, SF_SMALL), duck, entry.oracle_sql()[name])


@pytest.mark.parametrize("name", ["deal_enriched", "deal_metrics", "deal_total_volume", "listing_clean", "listing_volume",
                                  "area_band_histogram", "month_bounds", "cyclical_period_of_date", "word_count"])
def test_building_a_plan_starts_no_job(spark, name):
    build = entry.queries()[name]
    build(spark, SF_SMALL)  # reads the schemas of the files once
    spark.sparkContext.setJobGroup("plan-only", name)
    try:
        build(spark, SF_SMALL)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("plan-only")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_deals_plan_shape(spark):
    plan = _plan(B.deal_metrics(spark, SF_SMALL))
    assert "BroadcastHashJoin" in plan
    assert "EvalPython" not in plan and "SortAggregate" not in plan


def test_listings_plan_shape(spark):
    plan = _plan(B.listing_metrics(spark, SF_SMALL))
    assert "EvalPython" not in plan and "FlatMapGroupsInPandas" not in plan


def _plan_without_aqe(spark, build):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return _plan(build(spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_listing_grain_is_computed_once(spark):
    plan = _plan_without_aqe(spark, B.listing_metrics)
    # Both consumers (object stats, community price) read the written grain;
    # the fact scan is not repeated in the plan.
    assert "listing-grain" in plan and "lineitem" not in plan
    assert "Window [max(last_end)" not in plan  # no window over a whole community


def test_deal_fact_path_has_three_shuffles(spark):
    plan = _plan_without_aqe(spark, B.deal_metrics)
    hashed = [ln for ln in plan.splitlines() if "Exchange hashpartitioning" in ln and "REPARTITION" not in ln]
    # community grain + slot grain + per-object window/aggregate, plus the tiny release lookup aggregate
    assert len(hashed) == 4, hashed
