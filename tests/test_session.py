"""The shared folder: taken from the session, demanded on a cluster, removed after local runs."""

import os
import subprocess
import sys

import pytest

from tallyhouse.session import ensure_checkpoint_dir


class Conf(dict):
    def set(self, key, value):
        self[key] = value


class Session:
    """As much of a session as the folder's choice looks at."""

    def __init__(self, **conf):
        self.conf = Conf(conf)


def test_folder_of_the_session_is_used():
    s = Session(**{"spark.master": "spark://host:7077", "spark.checkpoint.dir": "hdfs://shared/x"})
    assert ensure_checkpoint_dir(s) == "hdfs://shared/x"


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "local-cluster[2,1,1024]", ""])
def test_cluster_without_a_shared_folder_raises(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session(**{"spark.master": master}))


def test_local_folder_is_removed_at_the_end():
    code = (
        "from tallyhouse import session as s\n"
        "class C(dict):\n    def set(self, k, v): self[k] = v\n"
        "class X:\n    conf = C({'spark.master': 'local[2]'})\n"
        "    class sparkContext:\n        setCheckpointDir = staticmethod(lambda p: None)\n"
        "p = s.ensure_checkpoint_dir(X)\nopen(p + '/table', 'w').close()\nprint(p)"
    )
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True)
    path = out.stdout.strip().splitlines()[-1]
    assert "tallyhouse-ckpt-" in path and not os.path.exists(path)


def test_scratch_tables_are_freed(spark):
    import os

    from tallyhouse.plans import bench_tables as B
    from tallyhouse.session import ensure_checkpoint_dir, scratch

    folder = ensure_checkpoint_dir(spark).removeprefix("file:")

    def tables():
        return {n for n in os.listdir(folder) if "-" in n}

    before = tables()
    with scratch(spark):
        prices = B.listing_price_house(spark, "/root/testdata/sf0.001")
        read = B.catalog_table_roundtrip(spark, "/root/testdata/sf0.001")
        # only what the two returned frames still read: the grain and the rows read back
        assert sorted(n.rsplit("-", 1)[0] for n in tables() - before) == ["listing-grain", "metrics-read"]
        assert prices.count() > 0 and read.count() > 0
    assert tables() == before


def test_table_follows_a_rewritten_file(spark, tmp_path):
    from tallyhouse.sources.testdata import table

    path = str(tmp_path / "nation.parquet")
    spark.range(3).write.parquet(path)
    assert table(spark, str(tmp_path), "nation").columns == ["id"]
    spark.range(5).selectExpr("id AS a", "id AS b").write.mode("overwrite").parquet(path)
    assert table(spark, str(tmp_path), "nation").columns == ["a", "b"]
    assert table(spark, str(tmp_path), "nation").count() == 5
