import glob
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse import schema as S
from tallyhouse.schema import METRIC_COLUMNS, METRICS_SCHEMA
from tallyhouse.sinks.writers import (
    create_metrics_table,
    drop_metrics_table,
    insert_partition,
    lines_table,
    write_delimited,
    write_partition,
)
from tallyhouse.sources.tables import read_partition
from tallyhouse.sources.text import read_delimited_table, read_typed_lines

FIELDS = [("name", T.StringType()), ("age", T.IntegerType())]


def _metrics(spark):
    rows = [
        ("NEW", "DEAL_VOLUME", "CITY", "city:1", "Period", "Yesterday", 3.0, None, None, None),
        ("SECOND", "DEAL_PRICE_AVG", "HOUSE", "city:1,house:2", "Period", "SevenDays", 1.5, 1.0, 50.0, None),
    ]
    return spark.createDataFrame(rows, METRICS_SCHEMA)


def test_typed_lines_golden(spark, tmp_path):
    p = tmp_path / "people.txt"
    p.write_text("spark, 10\nhadoop,20\n")
    got = [(r.name, r.age) for r in read_typed_lines(spark, str(p), FIELDS, trim=("age",)).collect()]
    assert got == [("spark", 10), ("hadoop", 20)]


def test_typed_lines_bad_line(spark, tmp_path):
    p = tmp_path / "bad.txt"
    p.write_text(" spark ,1\nnocomma\n")
    rows = read_typed_lines(spark, str(p), FIELDS, trim=("age",)).collect()
    assert rows[0].name == " spark " and rows[0]._corrupt_record is None
    assert rows[1].age is None and rows[1]._corrupt_record == "nocomma"
    with pytest.raises(Exception):
        read_typed_lines(spark, str(p), FIELDS, trim=("age",), mode="FAILFAST").collect()


def test_tsv_null_roundtrip(spark, tmp_path):
    path = str(tmp_path / "tsv")
    src = _metrics(spark)
    write_delimited(src, path)
    text = "".join(open(f).read() for f in glob.glob(path + "/part*"))
    assert "\\N" in text and "\t" in text
    back = read_delimited_table(spark, path, METRICS_SCHEMA)
    assert sorted(back.collect()) == sorted(src.collect())


def test_partition_overwrite_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "table")
    src = _metrics(spark)
    write_partition(src, path, "2018-09-21")
    write_partition(src, path, "2018-09-21")
    write_partition(src.limit(1), path, "2018-09-20")
    assert read_partition(spark, path, "2018-09-21", fmt="parquet").count() == 2
    assert read_partition(spark, path, "2018-09-20", fmt="parquet").count() == 1
    write_partition(src, path, "2018-09-20", mode="append")
    assert read_partition(spark, path, "2018-09-20", fmt="parquet").count() == 3
    plan = read_partition(spark, path, "2018-09-21", fmt="parquet")._jdf.queryExecution().executedPlan().toString()
    filters = re.search(r"PartitionFilters: \[([^\]]*)\]", plan).group(1)
    assert "ds" in filters and re.search(r"= (2018-09-21|17795)\b", filters), filters


def test_empty_day_empties_its_partition(spark, tmp_path):
    path, src = str(tmp_path / "table"), _metrics(spark)
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    write_partition(src, path, "2018-09-20")
    write_partition(src, path, "2018-09-21")
    write_partition(src.limit(0), path, "2018-09-20")
    assert [r.ds.isoformat() for r in spark.read.parquet(path).collect()] == ["2018-09-21"] * 2
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode
    name = "tallyhouse_empty_day_test"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    create_metrics_table(spark, name, location=str(tmp_path / "t"))
    insert_partition(src, name, "2018-09-20")
    insert_partition(src, name, "2018-09-21")
    insert_partition(src.limit(0), name, "2018-09-20")
    assert [r.ds for r in spark.table(name).collect()] == ["2018-09-21"] * 2
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("tallyhouse_insert")]
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_delimited_bytes(spark, tmp_path):
    schema = "a string, b string, c double"
    rows = [('say "hi"', "back\\slash", 1.5), ("", None, None), ("tab\there\nand there", "\\t", -2.0)]
    write_delimited(spark.createDataFrame(rows, schema).coalesce(1), str(tmp_path / "x"))
    raw = b"".join(open(f, "rb").read() for f in glob.glob(str(tmp_path / "x" / "part*")))
    assert sorted(raw.split(b"\n")) == sorted(
        [b'say "hi"\tback\\slash\t1.5', b"\t\\N\t\\N", b"tab here and there\t\\t\t-2.0", b""]
    )
    back = read_delimited_table(spark, str(tmp_path / "x"), T._parse_datatype_string(schema))
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(
        [rows[0], rows[1], ("tab here and there", "\\t", -2.0)], key=repr
    )


def test_metrics_table_ddl_and_insert(spark, tmp_path):
    name = "tallyhouse_metrics_test"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    create_metrics_table(spark, name, location=str(tmp_path / "t"))
    insert_partition(_metrics(spark), name, "2018-09-21")
    insert_partition(_metrics(spark), name, "2018-09-21")  # overwrite
    assert spark.table(name).where(F.col("ds") == "2018-09-21").count() == 2
    assert [c for c in spark.table(name).columns] == list(METRIC_COLUMNS) + ["ds"]
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_people_demo(spark, tmp_path):
    from tallyhouse.plans import demos

    p = tmp_path / "people.txt"
    p.write_text("spark, 10\nhadoop,20\n")
    assert [(r.name, r.age) for r in demos.people(spark, str(p)).collect()] == [("spark", 10), ("hadoop", 20)]
    (tmp_path / "bad.txt").write_text("spark,x\n")
    with pytest.raises(Exception):
        demos.people(spark, str(tmp_path / "bad.txt")).collect()


def test_text_word_count_demo(spark, tmp_path):
    from tallyhouse.plans import demos

    (tmp_path / "w.txt").write_text("hello scala\njava hadoop\nhadoop demo\n")
    got = {r.word: r["count"] for r in demos.text_word_count(spark, str(tmp_path / "w.txt")).collect()}
    assert got == {"scala": 1, "hello": 1, "java": 1, "hadoop": 2, "demo": 1}


def test_text_metrics_table(spark, tmp_path):
    name = "tallyhouse_metrics_text_test"
    drop_metrics_table(spark, name)
    loc = tmp_path / "tt"
    odd = [
        ("NEW", "I", "CITY", 'say "hi"', "back\\slash", "", 1.0, None, None, None),
        ("NEW", "I", "CITY", "", "\\", "'", -0.5, 2.0, None, 1e300),
        ("NEW", "I", "CITY", "tab\there", "line\nbreak", "\\n", 0.0, None, 3.0, None),
    ]
    src = _metrics(spark).unionByName(spark.createDataFrame(odd, METRICS_SCHEMA))
    want = {tuple(r) for r in src.collect()} - {odd[2]} | {(*odd[2][:3], "tab here", "line break", *odd[2][5:])}
    create_metrics_table(spark, name, location=str(loc), text=True)
    create_metrics_table(spark, name, location=str(loc), text=True)  # IF NOT EXISTS
    assert spark.table(name).columns == [*METRIC_COLUMNS, "ds"]
    for _ in range(2):
        insert_partition(src, name, "2018-09-21")  # overwrite
    insert_partition(src.limit(1), name, "2018-09-20")
    insert_partition(src.limit(1), name, "2018-09-20", overwrite=False)
    back = spark.table(name).where(F.col("ds") == "2018-09-21").drop("ds")
    assert back.count() == 5 and {tuple(r) for r in back.collect()} == want
    assert [f.dataType for f in back.schema] == [f.dataType for f in METRICS_SCHEMA]
    assert spark.table(name).where("ds = '2018-09-20'").count() == 2
    insert_partition(src.limit(0), name, "2018-09-20")
    assert spark.table(name).where("ds = '2018-09-20'").count() == 0
    text = "".join(open(f).read() for f in glob.glob(str(loc / "ds=2018-09-21" / "part*")))
    assert 'say "hi"\tback\\slash\t\t1.0\t\\N' in text
    drop_metrics_table(spark, name)
    assert not spark.catalog.tableExists(name) and not spark.catalog.tableExists(lines_table(name))
    drop_metrics_table(spark, name)  # nothing there: nothing to do


def test_round_trips_leave_the_catalog_as_it_was(spark):
    from tallyhouse.plans import bench_tables as B

    before = {t.name for t in spark.catalog.listTables()}
    rows = B.text_catalog_table_roundtrip(spark, "/root/testdata/sf0.001")
    assert rows.count() > 0 and rows.where("obj_value = ''").count() > 0
    assert {t.name for t in spark.catalog.listTables()} == before


def test_jdbc_partitioned_read_needs_bounds(spark):
    from tallyhouse.sources.jdbc import read_jdbc_table

    with pytest.raises(ValueError):
        read_jdbc_table(spark, "jdbc:none://x", "t", partition_column="id", lower_bound=1)


@pytest.mark.parametrize("query", ["partition_write", "empty_day", "catalog_table", "text_catalog_table"])
def test_round_trips_compute_the_metrics_once(spark, monkeypatch, query):
    from tallyhouse.plans import bench_tables as B
    from tallyhouse.sources import testdata as td

    read = spark.sparkContext.accumulator(0)

    def job(obj_type, n):
        row = (S.DIM_NEW, S.INDEX_DEAL_VOLUME, obj_type, "x", S.PERIOD_TYPE_PERIOD, "SixtyDays", 1.0, None, None, None)

        def counted(_):
            read.add(1)
            return row

        return lambda *_, **__: spark.createDataFrame(spark.sparkContext.range(n).map(counted), METRICS_SCHEMA)

    monkeypatch.setattr(B, "deal_metrics", job(S.OBJ_HOUSE, 5))
    monkeypatch.setattr(B, "listing_metrics", job(S.OBJ_CITY, 3))
    got = getattr(B, f"{query}_roundtrip")(spark, "unused").collect()
    if query == "partition_write":
        assert len(got) == 8
    else:
        assert len(got) == 5 and {r["ds"] for r in got} == {td.DS}
    assert read.value == len(got)
