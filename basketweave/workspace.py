"""Tables that a mining run writes between its levels.

A level's result is written as parquet under the folder the cluster names in
``spark.checkpoint.dir`` and read back, so the lineage stays one level long and
a lost executor costs a re-read, not a re-run. The row count and a few size
figures come from the same job that writes the table, as observed metrics.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Rows that are worth a task of their own when each of them is expanded.
SPREAD_ROWS = 1000


@dataclass(frozen=True)
class Table:
    """A written table, its row count and the metrics observed on the way."""

    df: DataFrame
    path: str
    rows: int
    stats: dict = field(default_factory=dict)

    def spread(self, rows_per_task: int = SPREAD_ROWS) -> DataFrame:
        """The table over more tasks, where it has few files.

        For steps that do much work per row, such as turning one row into many: a
        small table would be left to one or two tasks. A table that already reads
        as enough tasks stays as it is.
        """
        limit = int(self.df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        tasks = min(limit, self.rows // rows_per_task)
        if tasks < 2 or len(self.df.inputFiles()) >= tasks:
            return self.df
        return self.df.repartition(tasks, *self.df.columns)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    ``spark.checkpoint.dir`` of the session if it is set, else the folder given to
    ``SparkContext.setCheckpointDir``, else one in the session's warehouse. A warehouse on
    the driver's own disk is refused unless the session is local: executors of a cluster
    could not read it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        root = f"{spark.conf.get('spark.sql.warehouse.dir')}/basketweave"
        local = re.match(r"local(\[|$)", spark.sparkContext.master)
        if not local and re.match(r"(file:|/|[^:/]+(/|$))", root):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return root.rstrip("/")


class Workspace:
    """One folder of intermediate tables, for one run.

    `close`, or the end of a ``with`` block, deletes the folder; frames that read from
    it must have been used by then.
    """

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        path = self._hadoop_path(f"{root or checkpoint_root(spark)}/basketweave-{uuid4().hex}")
        full = self._store(path).makeQualified(path).toString()
        self.path = re.sub("^file:/+", "file:///", full)
        self._written = 0
        # Catalog tables by the path of their files.
        self._catalogued: dict[str, str] = {}

    def _hadoop_path(self, path: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)

    def _store(self, path):
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _delete(self, path: str) -> None:
        at = self._hadoop_path(path)
        self._store(at).delete(at, True)

    def _next_path(self, name: str) -> str:
        self._written += 1
        return f"{self.path}/{self._written - 1:03d}_{name}"

    def write(self, name: str, df: DataFrame, **metrics: Column) -> Table:
        """Write `df`, count its rows and evaluate `metrics` in the same job."""
        path = self._next_path(name)
        seen = Observation()
        observed = df.observe(seen, *_measures(metrics))
        observed.write.parquet(path)
        return self._read_back(self.spark.read.schema(df.schema).parquet(path), path, seen, metrics)

    def write_bucketed(
        self, name: str, df: DataFrame, key: str, buckets: int, **metrics: Column
    ) -> Table:
        """`write`, with the rows in `buckets` files by the hash of `key`.

        A plan that groups by `key` and more reads them without an exchange. Spark knows
        buckets of catalog tables only, so the session's catalog holds one until `drop` or
        `close`, over files in this folder. `df` should be partitioned by `key`, else
        every task writes a file for each bucket.
        """
        path = self._next_path(name)
        table = f"basketweave_{uuid4().hex}"
        seen = Observation()
        observed = df.observe(seen, *_measures(metrics))
        writer = observed.write.format("parquet").option("path", path)
        writer.bucketBy(buckets, key).saveAsTable(table)
        self._catalogued[path] = table
        return self._read_back(self.spark.table(table), path, seen, metrics)

    @staticmethod
    def _read_back(back: DataFrame, path: str, seen: Observation, metrics: dict) -> Table:
        stats = _measured(seen, ["rows", *metrics])
        return Table(back, path, stats.pop("rows"), {n: v or 0 for n, v in stats.items()})

    def drop(self, table: Table) -> None:
        """Delete a table that no later plan reads; a frame without a path is left."""
        if table.path:
            self._forget(table.path)
            self._delete(table.path)

    def _forget(self, path: str) -> None:
        """Take a table out of the catalog, if it is there."""
        if path in self._catalogued:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._catalogued.pop(path)}")

    def close(self) -> None:
        """Delete all tables of this run."""
        for path in [*self._catalogued]:
            self._forget(path)
        self._delete(self.path)

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *_) -> None:
        self.close()


def _measures(metrics: dict[str, Column]) -> list[Column]:
    return [F.count(F.lit(1)).alias("rows")] + [m.alias(n) for n, m in metrics.items()]


def _measured(seen: Observation, names: list[str]) -> dict:
    """The observed metrics; a lost one must not pass for zero rows."""
    found = dict(seen.get)
    missing = [n for n in names if n not in found]
    if missing:
        raise RuntimeError(f"Spark did not report {', '.join(missing)} of a written table")
    return found
