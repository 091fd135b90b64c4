"""The two long-running applications of the source system, as Spark jobs.

* ``run_speed_layer``: messages (Kafka or a landing folder) -> lake + realtime
  keyed table, two streaming queries, until one ends.
* ``batch_cycle``: one cycle of the batch layer -- read the lake, flatten every
  line into the mapping table and upsert today's statistics -- meant to be
  started by an outside scheduler (the source's sleep loop is not rebuilt).
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streetflow.operators.analysis import daily_analysis, flatten_points
from streetflow.schema import ARRIVAL, DAILY_KEY, MAPPING_KEY, REALTIME_KEY
from streetflow.sources.keyed import KeyedTable
from streetflow.sources.lake import lake_exists, read_day, read_lake
from streetflow.streaming.jobs import await_any, incremental_mapping_table, run_to_end, speed_layer


log = logging.getLogger(__name__)


def realtime_table(path: str) -> KeyedTable:
    part, clus = REALTIME_KEY
    return KeyedTable(path, part, clus, descending=["date_time"], order=ARRIVAL)


def mapping_table(path: str) -> KeyedTable:
    part, clus = MAPPING_KEY
    return KeyedTable(path, part, clus, descending=["date_time"], order=ARRIVAL)


def daily_table(path: str) -> KeyedTable:
    part, clus = DAILY_KEY
    return KeyedTable(path, part, clus)


def run_speed_layer(messages: DataFrame, lake: str, realtime: str, checkpoints: str, available_now: bool = False):
    """Start both sinks of the speed layer and block until any query ends, or, with
    ``available_now``, until both have; a failure of one stops the other (T3)."""
    queries = speed_layer(messages, lake, realtime_table(realtime), checkpoints, available_now=available_now)
    if available_now:
        run_to_end(queries)
    else:
        await_any(messages.sparkSession)
    return queries


def batch_outputs(spark: SparkSession, lake: str, as_of: str) -> dict[str, DataFrame]:
    """The batch layer's two outputs for day ``as_of`` (the day is an argument,
    not the process start date)."""
    points = flatten_points(read_lake(spark, lake)).withColumn(
        "date_time", F.try_to_timestamp("date_time").cast("timestamp_ntz")
    )
    stats = daily_analysis(read_day(spark, lake, as_of)).withColumn(
        "max_speed_today", F.col("max_speed_today").cast("double")
    )
    return {"traffic_mapping": points, "traffic_daily_analysis": stats}


def batch_cycle(
    spark: SparkSession,
    lake: str,
    mapping: str,
    daily: str,
    as_of: str,
    cycle: int,
    checkpoints: str | None = None,
) -> bool:
    """One cycle: both keyed tables upserted.  A failed write raises (the source
    swallowed it); re-running the same cycle is idempotent.

    T4: with a ``checkpoints`` folder the mapping table takes only lake files that no
    earlier cycle has read (versions are micro-batches), so a cycle over unchanged data
    writes nothing there; without one every cycle explodes the whole lake anew, as
    version ``cycle``.

    S4: while the archive does not exist yet the cycle is skipped with a warning
    and ``False`` is returned; the scheduler simply runs the next cycle.
    """
    if not lake_exists(spark, lake):
        log.warning("archive %s does not exist yet; cycle %s skipped", lake, cycle)
        return False
    out = batch_outputs(spark, lake, as_of)
    if checkpoints:
        run_to_end([incremental_mapping_table(spark, lake, mapping_table(mapping), f"{checkpoints}/mapping")])
        del out["traffic_mapping"]
    tables = {"traffic_mapping": mapping_table(mapping), "traffic_daily_analysis": daily_table(daily)}
    for name, rows in out.items():
        tables[name].upsert(rows, cycle)
    return True


def compact_tables(spark: SparkSession, lake: str, as_of: str, tables: dict[str, tuple[KeyedTable, str]]) -> None:
    """Copy keyed tables of the batch layer into new folders that hold their current state
    as one version: ``{output name: (table, new folder)}``.  Readers and writers switch to
    the new folders afterwards; until then nothing changes for them."""
    out = batch_outputs(spark, lake, as_of)
    for name, (table, folder) in tables.items():
        table.compact(spark, out[name].schema, folder)
