"""The archive ("data lake"): day-partitioned Parquet (S2-S4, K1 batch form).

Reads always go through the base path with an explicit schema, so (a) no footer
pass is needed to learn the schema, (b) the streaming sink's commit log is
honoured, and (c) a day filter becomes a PartitionFilter (S3).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streetflow.schema import ARCHIVE

PARTITION = "date_partition"


def read_lake(spark: SparkSession, base: str, schema=ARCHIVE) -> DataFrame:
    """S2 + S4: the whole archive; an absent archive is an empty DataFrame of the schema."""
    try:
        return spark.read.schema(schema).parquet(base)
    except AnalysisException as e:  # only a missing path is tolerated
        if "PATH_NOT_FOUND" in (e.getCondition() or "") or "PATH_NOT_FOUND" in str(e):
            return spark.createDataFrame([], schema)
        raise


def lake_exists(spark: SparkSession, base: str) -> bool:
    """Whether the archive folder exists yet (a cheap listing through a read)."""
    try:
        spark.read.schema(ARCHIVE).parquet(base)
        return True
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in (e.getCondition() or "") or "PATH_NOT_FOUND" in str(e):
            return False
        raise


def read_day(spark: SparkSession, base: str, day: str, schema=ARCHIVE) -> DataFrame:
    """S3 + F1: one day, pruned to a single partition directory."""
    return read_lake(spark, base, schema).where(F.col(PARTITION) == F.lit(day))


def write_lake(df: DataFrame, base: str, mode: str = "append", max_records_per_file: int = 5_000_000) -> None:
    """K1 (batch form): append rows partitioned by day.

    ``rebalance`` on the day column lets AQE size the write tasks from the
    measured shuffle: a hot day is split into several advisory-size tasks and
    small days are merged, so files stay near the target size whatever the
    skew, and no task holds a whole day.
    """
    (
        df.hint("rebalance", PARTITION)
        .write.mode(mode)
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(PARTITION)
        .parquet(base)
    )


def compact_lake(spark: SparkSession, base: str, new_base: str, schema=ARCHIVE) -> str:
    """Rewrite the lake (small files from many micro-batches) into ``new_base``.

    The read goes through the base path, so only files committed by the
    streaming sink are taken; the write is rebalanced per day into
    advisory-size files.  The folder being read is never overwritten -- readers
    switch to ``new_base`` once this returns.
    """
    write_lake(read_lake(spark, base, schema), new_base, mode="errorifexists")
    return new_base
