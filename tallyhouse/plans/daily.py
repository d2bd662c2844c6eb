"""The daily publish job: deals + listings metrics for one day.

    spark-submit --py-files tallyhouse.zip tallyhouse/plans/daily.py \\
        --deals-table db.deal_fact --listings-table db.listing_fact \\
        --dim-table db.community_dim --release-table db.city_release \\
        --out-table db.metrics [--as-of 2018-09-22]

Both jobs' rows are written together as partition ``ds`` (= as-of minus one
day) of the output table, replacing that partition, so a re-run or a retried
write never duplicates rows.  Release dates can also come over JDBC
(``--release-jdbc-url`` / ``--release-jdbc-table`` / ``--release-jdbc-option k=v``),
and the partition can be exported to another database
(``--export-jdbc-url`` / ``--export-jdbc-table`` / ``--export-jdbc-option k=v``).
The variants of both jobs have flags: ``--calendar-months``, ``--emit-plate``,
``--previous``, ``--area-bands`` and ``--segments``.  Intermediate tables go to the
shared folder named in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.operators.deals import deal_metrics
from tallyhouse.operators.listings import listing_metrics
from tallyhouse.session import ensure_checkpoint_dir
from tallyhouse.sinks.writers import export_jdbc, insert_partition, write_partition
from tallyhouse.sources.jdbc import read_release_dates
from tallyhouse.sources.tables import read_partition, read_table


def day_before(as_of) -> str:
    return (dt.date.fromisoformat(str(as_of)[:10]) - dt.timedelta(days=1)).isoformat()


def daily_metrics(
    deals: DataFrame,
    listings: DataFrame,
    dim: DataFrame,
    release: DataFrame | None,
    as_of,
    *,
    ds: str | None = None,
    deal_options: Mapping | None = None,
    listing_options: Mapping | None = None,
) -> DataFrame:
    """All metric rows of one day (the content of partition ``ds``)."""
    ds = ds or day_before(as_of)
    d = deal_metrics(deals, dim, release, ds, as_of, **dict(deal_options or {}))
    q = listing_metrics(listings, dim, ds, as_of, **dict(listing_options or {}))
    return d.unionByName(q)


def pairs(options) -> dict[str, str]:
    return dict(kv.split("=", 1) for kv in options)


def deal_options(args: argparse.Namespace) -> dict:
    return {"calendar_months": args.calendar_months}


def listing_options(args: argparse.Namespace) -> dict:
    segments = tuple(s.strip() for s in args.segments.split(",")) if args.segments else None
    return {"emit_plate": args.emit_plate, "previous": args.previous, "area_bands": args.area_bands, "segments": segments}


def run(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    ensure_checkpoint_dir(spark)
    as_of = args.as_of or dt.date.today().isoformat()
    ds = args.ds or day_before(as_of)
    deals = read_partition(spark, args.deals_table, ds)
    listings = read_partition(spark, args.listings_table, ds)
    dim = read_table(spark, args.dim_table)
    if args.release_jdbc_url:
        release = read_release_dates(
            spark, args.release_jdbc_url, args.release_jdbc_table, pairs(args.release_jdbc_option)
        )
    elif args.release_table:
        release = read_table(spark, args.release_table)
    else:
        release = None
    rows = daily_metrics(
        deals, listings, dim, release, as_of, ds=ds, deal_options=deal_options(args), listing_options=listing_options(args)
    )
    if args.out_table:
        insert_partition(rows, args.out_table, ds, overwrite=not args.append)
    elif args.out_path:
        write_partition(rows, args.out_path, ds, mode="append" if args.append else "overwrite")
    if args.export_jdbc_table:
        written = spark.table(args.out_table) if args.out_table else spark.read.parquet(args.out_path)
        export_jdbc(
            written.where(written.ds == ds), args.export_jdbc_url, args.export_jdbc_table, pairs(args.export_jdbc_option)
        )
    return rows


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description=__doc__.split("\n\n")[0])
    p.add_argument("--as-of", help="statistics day (default: today); facts are read from the day before")
    p.add_argument("--ds", help="fact partition to read and output partition to write (default: as-of minus 1)")
    p.add_argument("--deals-table", required=True)
    p.add_argument("--listings-table", required=True)
    p.add_argument("--dim-table", required=True)
    p.add_argument("--release-table")
    p.add_argument("--release-jdbc-url")
    p.add_argument("--release-jdbc-table")
    p.add_argument("--release-jdbc-option", action="append", default=[], help="k=v passed to the release-date read")
    p.add_argument("--out-table")
    p.add_argument("--out-path")
    p.add_argument("--append", action="store_true", help="append instead of replacing the partition")
    p.add_argument("--export-jdbc-url")
    p.add_argument("--export-jdbc-table")
    p.add_argument("--export-jdbc-option", action="append", default=[], help="k=v passed to the export")
    p.add_argument("--calendar-months", action="store_true", help="previous month ends on its own last day")
    p.add_argument("--emit-plate", action="store_true", help="listing rows for plates as well")
    p.add_argument("--previous", choices=("cover", "overlap"), default="cover", help="previous listing window's rule")
    p.add_argument("--area-bands", choices=("all", "dominant"), default="all", help="rows of the robust price")
    p.add_argument("--segments", help="segment codes of the listing join, comma-separated (default: every row)")
    return p


def main(argv=None) -> None:
    args = parser().parse_args(argv)
    if not (args.out_table or args.out_path):
        raise SystemExit("one of --out-table / --out-path is required")
    spark = SparkSession.builder.appName("tallyhouse-daily").getOrCreate()
    run(spark, args)


if __name__ == "__main__":
    main()
