"""Session helpers: partition sizing from input size, and the checkpoint folder."""

from tidepool.session import checkpoint_root, scale_conf


def test_scale_conf_bounds():
    tiny = scale_conf(10 << 20, cores=8)
    assert tiny["spark.sql.shuffle.partitions"] == "16"          # at least two per core
    big = scale_conf(100 << 40, cores=8000)
    assert big["spark.sql.shuffle.partitions"] == "100000"       # capped: map-output metadata
    mid = scale_conf(64 << 30, cores=8)
    assert mid["spark.sql.shuffle.partitions"] == "64"           # one per GiB of input
    assert big["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] == "100000"


def test_checkpoint_root_reads_the_session(spark):
    d = spark.conf.get("spark.checkpoint.dir")
    assert checkpoint_root(spark) == d
