from __future__ import annotations

from lakeferry.session import RECOMMENDED, checkpoint_root, fresh_dir, sized


def test_partitions_fit_the_data_and_the_cores():
    big = sized(100 * 2**40, 4000)
    assert big["spark.sql.shuffle.partitions"] == str(100 * 2**40 // (256 * 2**20))
    assert sized(1, 8)["spark.sql.shuffle.partitions"] == "24"


def test_scratch_is_below_the_named_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    root = checkpoint_root(spark)
    assert named is None or root == named.rstrip("/")
    assert spark.sparkContext.getCheckpointDir() is not None
    one, other = fresh_dir(spark, "x"), fresh_dir(spark, "x")
    assert one != other and one.startswith(root + "/")


def test_no_web_page_is_started(spark):
    assert RECOMMENDED["spark.ui.enabled"] == "false"
    assert spark.sparkContext.uiWebUrl is None
