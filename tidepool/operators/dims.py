"""Dimension tables: create-if-missing (K3) and the upsert (K4).

A dimension is kept in long form, one row per cell
``(sink_table, row_key, qualifier, value, arrival, seq)``, the shape of a
wide-column store with one column family. Writing a cell replaces it; cells not
in a record stay. The store is append-only: each write adds the batch's latest
cells, and the current table is the latest cell per ``(sink_table, row_key,
qualifier)``. A dimension is cut into buckets of row keys, and each append is a
partition of its own in every bucket it has cells for, so a retried batch replaces
exactly its cells. Compaction folds the buckets that got cells since their last fold
and leaves the others as they are. It folds only the appends it has seen: it writes
the fold as one more part, then drops those. Reading a cell twice changes nothing.
"""

from __future__ import annotations

import re
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.operators.ordering import ORDER

CELL_KEY = ["sink_table", "row_key", "qualifier"]
CELL_COLUMNS = ["sink_table", "row_key", "qualifier", "value", "arrival", "seq"]
NO_ROW_KEY = "no_row_key"
FOLD = "fold-"
NO_NAME = "__HIVE_DEFAULT_PARTITION__"      # fixed value: Spark's folder name of a null partition value
DROPS = 500                                 # partitions dropped by one statement
_NAME = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def cells(routed: DataFrame, key: str = "id", honour_sink_pk: bool = False) -> tuple[DataFrame, DataFrame]:
    """Records routed to the dimension side -> (cells, rejects).

    The row key is ``after[key]`` (Q9: ``id``; with ``honour_sink_pk`` the rule's
    ``sink_pk`` when set). Every other non-null field is one cell; non-string
    values are already text (Q11). A record without a row key is rejected (Q6,
    Q10), never written as a tombstone.
    """
    key_name = F.coalesce(F.col("sink_pk"), F.lit(key)) if honour_sink_pk else F.lit(key)
    with_key = routed.withColumn("row_key", F.try_element_at(F.col("after"), key_name))
    rejects = (with_key.where(F.col("row_key").isNull())
               .select("arrival", "seq", "sink_table", F.lit(NO_ROW_KEY).alias("reason")))
    body = F.map_filter(F.col("after"), lambda k, v: (k != key_name) & v.isNotNull())
    out = (with_key.where(F.col("row_key").isNotNull())
           .select("sink_table", "row_key", "arrival", "seq",
                   F.explode(body).alias("qualifier", "value")))
    return out.select(*CELL_COLUMNS), rejects


def latest_cells(cell_rows: DataFrame) -> DataFrame:
    """K4 fold: the latest value per cell by arrival order. Partial aggregation
    first, so a hot row key is combined map-side before it shuffles."""
    last = F.max_by(F.struct("value", *ORDER), F.struct(*ORDER))
    return (cell_rows.groupBy(*CELL_KEY).agg(last.alias("_c"))
            .select(*CELL_KEY, "_c.value", "_c.arrival", "_c.seq"))


def wide_dimension(cell_rows: DataFrame, sink_table: str, columns: list[str]) -> DataFrame:
    """One dimension as a wide table: the row key and one column per qualifier,
    the latest cell each. One grouped pass with a conditional ``max_by`` per
    column; the columns come from the rule, so no distinct scan of qualifiers."""
    order = F.struct(*ORDER)
    cur = cell_rows.where(F.col("sink_table") == sink_table)
    return cur.groupBy("row_key").agg(*[
        F.max_by(F.col("value"), F.when(F.col("qualifier") == c, order)).alias(c) for c in columns])


def is_name(text: str | None) -> bool:
    """Whether a rule's text can name a catalog table or column."""
    return bool(text) and bool(_NAME.match(text))


class DimStore:
    """Cells under a shared folder, registered in the catalog as one table
    partitioned by dimension, by bucket of row keys and by append (``part``).

    ``buckets`` sizes a fold: about one bucket of a dimension is one to a few tasks'
    work. Another number on a store that exists reads the same; cells move to their new
    buckets as they are folded.
    """

    def __init__(self, spark: SparkSession, path: str, database: str = "dims", buckets: int = 16):
        if not is_name(database):
            raise ValueError(f"bad database name {database!r}")
        if buckets < 1:
            raise ValueError("a store needs a bucket")
        self.spark, self.path, self.database, self.buckets = spark, path, database, buckets
        self.table = f"{database}.cells"
        self.ready = False

    def _hadoop_path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _filesystem(self, path: str):
        conf = self.spark._jsparkSession.sessionState().newHadoopConf()
        return self._hadoop_path(path).getFileSystem(conf)

    def ensure(self) -> None:
        """K3: create the store if missing and find the parts already under its
        folder; idempotent; failures raise."""
        if self.ready:
            return
        self._filesystem(self.path).mkdirs(self._hadoop_path(self.path))
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database}")
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} (row_key STRING, qualifier STRING, "
            f"value STRING, arrival BIGINT, seq BIGINT, sink_table STRING, bucket INT, part STRING) "
            f"USING parquet PARTITIONED BY (sink_table, bucket, part) LOCATION '{self.path}'")
        self.spark.sql(f"MSCK REPAIR TABLE {self.table}")
        self.ready = True

    def ensure_dimension(self, sink_table: str, columns: list[str]) -> str:
        """K3 per rule: a catalog view ``<database>.<sink_table>`` with the row key
        and one column per qualifier, the latest cell each.

        One grouped pass over the table's partition of the store (conditional
        ``max_by`` per column), so it needs no distinct scan of qualifiers and no
        pivot. Re-creating it for a rule change is idempotent; failures raise. The
        columns are those of all live rules of the dimension together.
        """
        if not is_name(sink_table) or not all(is_name(c) for c in columns):
            raise ValueError(f"bad dimension name {sink_table!r} / {columns!r}")
        self.ensure()
        name = f"{self.database}.{sink_table}"
        cols = "".join(
            f",\n  max_by(value, struct(arrival, seq)) filter (where qualifier = '{c}') as {c}"
            for c in columns)
        self.spark.sql(f"""create or replace view {name} as
select row_key{cols}
from {self.table}
where sink_table = '{sink_table}'
group by row_key""")
        return name

    def append(self, cell_rows: DataFrame, part: str | None = None) -> None:
        """K4 write: the batch's latest cells as the part ``part`` (a new one if not
        given) of each dimension; the same part is replaced."""
        self.ensure()
        self._write(latest_cells(cell_rows), part or uuid.uuid4().hex)

    def _write(self, rows: DataFrame, part: str) -> None:
        bucket = F.pmod(F.xxhash64("row_key"), F.lit(self.buckets)).cast("int")
        prev = self.spark.conf.get("spark.sql.sources.partitionOverwriteMode")
        self.spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        try:
            # Rebalanced, so that a bucket is a file or, when it is large, a few, and not one of every task.
            (rows.select("row_key", "qualifier", "value", "arrival", "seq", "sink_table", bucket.alias("bucket"),
                         F.lit(part).alias("part"))
             .hint("rebalance", "sink_table", "bucket")
             .write.mode("overwrite").insertInto(self.table, overwrite=True))
        finally:
            self.spark.conf.set("spark.sql.sources.partitionOverwriteMode", prev)

    def current(self) -> DataFrame:
        self.ensure()
        return latest_cells(self.spark.table(self.table))

    def _places(self, sink_tables: list[str] | None = None) -> list[tuple[str, int, str, str]]:
        """(dimension, bucket, part, folder) of every partition; the dimension of cells
        without a name is ``NO_NAME``."""
        self.ensure()
        out = []
        for row in self.spark.sql(f"SHOW PARTITIONS {self.table}").collect():
            shown = dict(x.split("=", 1) for x in row[0].split("/"))
            if shown["sink_table"] == "null" and not self._is_folder("null"):
                shown["sink_table"] = NO_NAME
            name = unquote(shown["sink_table"])
            if sink_tables is None or name in sink_tables:
                out.append((name, int(shown["bucket"]), unquote(shown["part"]),
                            "/".join(f"{k}={v}" for k, v in shown.items())))
        return out

    def _is_folder(self, escaped_name: str) -> bool:
        folder = f"{self.path}/sink_table={escaped_name}"
        return self._filesystem(folder).exists(self._hadoop_path(folder))

    def parts(self, sink_tables: list[str] | None = None) -> list[tuple[str, str]]:
        """(dimension, part) of every append there is; one each, kept few by compaction."""
        return sorted({(name, part) for name, _, part, _ in self._places(sink_tables)})

    def compact(self, sink_tables: list[str] | None = None) -> None:
        """Fold the parts present now to the latest cell per key, in the buckets with
        appends since their last fold, for the dimensions named (all when None).

        The fold is written as a new part before the folded ones are dropped. A part
        appended meanwhile is not touched, and a run that stops in between leaves
        cells twice, which reads the same.
        """
        places = self._places(sink_tables)
        changed = {p[:2] for p in places if not p[2].startswith(FOLD)}
        old = [p for p in places if p[:2] in changed]
        if not old:
            return
        self._write(latest_cells(self._cells_of(changed, {p[2] for p in old})), f"{FOLD}{uuid.uuid4().hex}")
        for i in range(0, len(old), DROPS):
            specs = ", ".join(f"PARTITION (sink_table={_literal(name)}, bucket={bucket}, part={_literal(part)})"
                              for name, bucket, part, _ in old[i:i + DROPS])
            self.spark.sql(f"ALTER TABLE {self.table} DROP IF EXISTS {specs}")
        for *_, folder in old:
            path = f"{self.path}/{folder}"
            self._filesystem(path).delete(self._hadoop_path(path), True)

    def _cells_of(self, buckets: set[tuple[str, int]], parts: set[str]) -> DataFrame:
        """Cells of these (dimension, bucket) and parts: conditions on partition columns
        alone, so that no other file is listed or read."""
        place = F.concat_ws("/", F.col("bucket").cast("string"), F.coalesce("sink_table", F.lit(NO_NAME)))
        return self.spark.table(self.table).where(
            place.isin([f"{b}/{name}" for name, b in sorted(buckets)]) & F.col("part").isin(sorted(parts)))


def _literal(name: str) -> str:
    """A partition value as SQL text."""
    if name == NO_NAME:
        return "null"
    return "'" + name.replace("\\", "\\\\").replace("'", "\\'") + "'"
