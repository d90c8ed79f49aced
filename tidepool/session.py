"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

# Settings every job relies on. The session zone pins the day bucket (P8); AQE
# re-plans joins and skewed partitions from runtime statistics.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # A record that repeats a key keeps the last value, as a map-based parser does.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Checkpoints written by queries (first claims, rule history, page topic) are
    # removed once their DataFrames are gone, so the shared folder does not fill.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def scale_conf(input_bytes: int, cores: int, scan_partition_bytes: int = 256 << 20,
               input_bytes_per_shuffle_partition: int = 1 << 30,
               max_shuffle_partitions: int = 100_000) -> dict[str, str]:
    """Partition sizing for a job reading ``input_bytes`` on ``cores`` task slots.

    Scan splits of ``scan_partition_bytes``; an initial shuffle partition count of
    one per GiB of input (at least two per core, at most ``max_shuffle_partitions``
    so map-output metadata stays bounded), which AQE then coalesces towards
    ``scan_partition_bytes`` per partition and splits where skewed. At 100 TB this
    gives 100,000 shuffle partitions of roughly 100-300 MB after projection.
    """
    n = -(-input_bytes // input_bytes_per_shuffle_partition)
    n = max(2 * cores, min(max_shuffle_partitions, n))
    return {
        "spark.sql.files.maxPartitionBytes": str(scan_partition_bytes),
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(scan_partition_bytes),
    }


def get_session(master: str | None = None, app_name: str = "tidepool",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine's settings.

    On a cluster pass ``master=None`` and let spark-submit decide; tests pass
    ``local[*]``.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    # A reused session keeps its static settings; re-apply the runtime SQL ones.
    for k, v in conf.items():
        if k.startswith("spark.sql.") and spark.conf.isModifiable(k):
            spark.conf.set(k, v)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's modules to the executors' Python workers, once per application.

    Functions that run in Python workers refer to their modules by name, and an
    executor need not have the package installed. Spark's own file server carries
    the archive, as with ``--py-files``.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    top = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="tidepool-code-"), "tidepool.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(top):
            for n in sorted(names):
                if n.endswith(".py"):
                    path = os.path.join(folder, n)
                    z.write(path, os.path.relpath(path, os.path.dirname(top)))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by whoever runs the job (a shared file system), and
    an unset value is an error: a machine-local folder would lose checkpoints with
    the machine. Only on a ``local`` master (tests, single-machine runs) is a
    folder under the temp dir created and recorded in the session, so later calls
    agree.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS or an "
                               "object store) before running on a cluster")
        d = tempfile.mkdtemp(prefix="tidepool-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d
