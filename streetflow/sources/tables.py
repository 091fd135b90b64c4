"""Reading the input tables.

Reads are lazy; Catalyst prunes columns and pushes filters into the Parquet scan,
so callers select and filter after reading.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")
