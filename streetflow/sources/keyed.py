"""Keyed tables with last-write-wins upsert semantics (K2, K3, K5), on Parquet.

A keyed store's append is an upsert.  Here every write is a partition
``version=<n>`` of an ordinary Parquet table, and the table's state is the latest
row per key over its versions (R1), by version, then the given order columns, then
every other column.

* Replay-safe: writing batch ``n`` again overwrites ``version=<n>`` only, so a
  re-run micro-batch or batch cycle cannot duplicate or reorder rows.
* Rows with a null key part are not storable (P10); ``upsert`` leaves them out.
* ``compact`` is a job like any other: it copies the state into a *new* folder, as
  the one version there; the folder being read is never overwritten.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from streetflow.operators.latest import latest_per_key, split_null_keys

VERSION = "version"


@dataclass
class KeyedTable:
    path: str
    partition_key: list[str]
    clustering_key: list[str] = field(default_factory=list)
    descending: list[str] = field(default_factory=list)  # clustering columns stored newest first
    order: list[str] = field(default_factory=list)  # extra last-write-wins order after the version

    @property
    def key(self) -> list[str]:
        return self.partition_key + self.clustering_key

    @property
    def batches(self) -> str:
        return f"{self.path}/batches"

    def _clustered(self, df: DataFrame) -> DataFrame:
        """K5: rows of a partition key in one file, in clustering order inside.

        A rebalance by the partition key: small keys share a task, and a key too
        large for one is split by the adaptive plan."""
        sort = [F.col(c) for c in self.partition_key] + [
            F.col(c).desc() if c in self.descending else F.col(c).asc() for c in self.clustering_key
        ]
        return df.hint("rebalance", *self.partition_key).sortWithinPartitions(*sort)

    def upsert(self, df: DataFrame, version: int) -> None:
        """Write one batch as version ``version`` (null-key rows are left out, P10).

        Count rejects with ``null_key_counts`` on the same input when needed; it
        is not done here so a batch is scanned once.
        """
        ok, _ = split_null_keys(df, self.key)
        self._clustered(ok).write.mode("overwrite").parquet(f"{self.batches}/{VERSION}={int(version)}")

    def read_versions(self, spark: SparkSession, schema: StructType, through: int | None = None) -> DataFrame:
        """All versions (up to ``through``, a partition filter); none while nothing was written."""
        full = StructType([*schema.fields, StructField(VERSION, IntegerType())])
        try:
            rows = spark.read.schema(full).parquet(self.batches)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return spark.createDataFrame([], full)
        return rows if through is None else rows.where(F.col(VERSION) <= through)

    def read(self, spark: SparkSession, schema: StructType, through: int | None = None) -> DataFrame:
        """Current table state (or the state through version ``through``): one row
        per key, by a shuffle on the key with partial aggregation first."""
        v = self.read_versions(spark, schema, through)
        return latest_per_key(v, self.key, [VERSION] + self.order).drop(VERSION)

    def compact(self, spark: SparkSession, schema: StructType, new_path: str) -> KeyedTable:
        """Copy the current state into a new table folder (as its version 0)."""
        self._clustered(self.read(spark, schema)).write.mode("errorifexists").parquet(
            f"{new_path}/batches/{VERSION}=0"
        )
        return KeyedTable(new_path, self.partition_key, self.clustering_key, self.descending, self.order)
