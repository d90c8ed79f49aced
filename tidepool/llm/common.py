"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.session import checkpoint_root

# A word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

_STAGED: list[str] = []


def staged(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back.

    The files cut the lineage, so lost executors cost only the tasks they ran, and
    their size is known to the optimizer when it decides on a broadcast.
    """
    path = f"{checkpoint_root(spark)}/tidepool-llm/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}-{name}"
    df.write.option("compression", "zstd").parquet(path)
    _STAGED.append(path)
    return spark.read.schema(df.schema).parquet(path)


def staged_paths() -> list[str]:
    """Folders written so far by this process and not dropped yet."""
    return list(_STAGED)


def drop_staged(spark: SparkSession, paths: list[str]) -> None:
    """Delete staged folders whose results have been written out."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        if p in _STAGED:
            _STAGED.remove(p)
            path = jvm.org.apache.hadoop.fs.Path(p)
            path.getFileSystem(conf).delete(path, True)


_HELD: dict = {}


def held(key, make):
    """What a Python worker keeps from task to task for one operator: ``make()``, once.

    Workers are reused, and encoders and indexes with their memories are large, so a worker
    holds one at a time: those of an operator that ran in it before are let go.
    """
    if key not in _HELD:
        _HELD.clear()
        gc.collect()
        _HELD[key] = make()
    return _HELD[key]


def word_count(text: Column) -> Column:
    """Number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One whole provided table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
