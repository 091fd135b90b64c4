"""Message parsing and store-boundary casts.

All column expressions; no Python runs per row.  Under ANSI mode the
null-returning ``try_`` forms are used wherever the source system relied on
non-ANSI null results (SURVEY §1 item 3).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streetflow.schema import ARRIVAL, RENAMES, SEQ, WIRE

DAY_FORMAT = "yyyy-MM-dd"


def parse_value(value: Column, schema=WIRE) -> Column:
    """Bytes or text -> struct, permissive (bad field -> null, bad message -> null struct)."""
    return F.from_json(value.cast("string"), schema)


def expand(df: DataFrame, value_col: str = "value", keep: list[str] | None = None, schema=WIRE) -> DataFrame:
    """P1+P2: parse the message column and expand the struct (``data.*``).

    Pass ``KEPT_WIRE`` when only the archive fields are needed: the JSON parser
    then materialises 10 fields instead of 17."""
    keep = keep or []
    return df.select(*keep, parse_value(F.col(value_col), schema).alias("data")).select(*keep, "data.*")


def to_timestamp_safe(c: Column) -> Column:
    """ISO text -> TIMESTAMP, null on unparsable text (ANSI-safe)."""
    return F.try_to_timestamp(c)


def day_key(date_time: Column) -> Column:
    """Calendar day of an ISO timestamp string in the session zone; null if unparsable."""
    return F.date_format(to_timestamp_safe(date_time), DAY_FORMAT)


def project_archive(parsed: DataFrame, seq: Column | None = None, later: list[Column] | None = None) -> DataFrame:
    """P3 + P4: keep 9 of the 17 wire fields under their archive names and add the day key.

    ``seq`` is the arrival order used for last-write-wins (broker time, file position,
    ...) and ``later`` the further columns of that order, if it has any; they are carried
    along but are not part of any key.
    """
    cols = [F.col(src).alias(dst) for src, dst in RENAMES]
    if seq is not None:
        cols += [c.cast("bigint").alias(name) for name, c in zip(ARRIVAL, [seq, *(later or [])])]
    out = parsed.select(*cols)
    return out.withColumn("date_partition", day_key(F.col("date_time")))


def is_rejected(parsed_cols: list[str]) -> Column:
    """A message whose every key field is null did not parse (or carries no key)."""
    cond = F.lit(True)
    for c in parsed_cols:
        cond = cond & F.col(c).isNull()
    return cond


def store_row(archive: DataFrame) -> DataFrame:
    """The casts applied when an archive row enters a keyed table.

    date_time text -> timestamp (null if unparsable), max_speed int -> double,
    geo_shape struct -> JSON text (a plain cast would give ``{a, b}`` text).
    """
    return archive.select(
        to_timestamp_safe(F.col("date_time")).alias("date_time"),
        "denomination",
        "avg_speed",
        "travel_time",
        "traffic_status",
        F.to_json("geo_shape").alias("geo_shape"),
        "hierarchie",
        "hierarchie_dv",
        F.col("max_speed").cast("double").alias("max_speed"),
        "date_partition",
        *[c for c in ARRIVAL if c in archive.columns],
    )


def encode_messages(archive: DataFrame) -> DataFrame:
    """Archive rows as wire messages ``(key, value)``: UTF-8 JSON with the wire's own
    field names, the key null."""
    record = F.struct(
        F.col("date_time").alias("datetime"),
        F.col(SEQ).cast("string").alias("predefinedlocationreference"),
        *[F.col(dst).alias(src) for src, dst in RENAMES if dst != "date_time"],
    )
    rest = [c for c in ARRIVAL if c in archive.columns]
    return archive.select(F.lit(None).cast("binary").alias("key"), F.to_json(record).cast("binary").alias("value"), *rest)
