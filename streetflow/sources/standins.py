"""Stand-in mappings: the driver tables played as the streams the operators expect.

The mappings are the ones written down in FIXTURES.md §5.  Each is a lazy
projection (plus, for geometries, one equi-join), so every query's work grows
with the tables it reads.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streetflow.functions.parse import encode_messages
from streetflow.schema import GEO_SHAPE, SEQ
from streetflow.sources.tables import read_table

ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def max_speed_of(props: Column) -> Column:
    """``$.k`` of the JSON props as INT; null when absent or not an integer."""
    return F.get_json_object(props, "$.k").try_cast("int")


def status_of(speed: Column, limit: Column) -> Column:
    """Stand-in traffic status: below the limit = congested, else free flow."""
    return F.when(limit.isNull() | speed.isNull(), F.lit(None).cast("string")).when(
        speed < limit, F.lit("congested")
    ).otherwise(F.lit("freeFlow"))


def coordinates_of(vec: Column, label: Column) -> Column:
    """Embedding folded into a LineString: pairs ``[v[2i], v[2i+1]]`` as [lon, lat].

    label % 3 = 0 -> null coordinates (a MultiLineString in the wire data),
    label % 3 = 1 -> empty line, otherwise the pairs.
    """
    n = F.when(vec.isNull(), F.lit(0)).otherwise(F.floor(F.size(vec) / 2)).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda i: F.array(F.get(vec, i * 2).cast("double"), F.get(vec, i * 2 + 1).cast("double")),
    )
    kind = F.pmod(label, F.lit(3))
    return (
        F.when(kind == 0, F.lit(None).cast("array<array<double>>"))
        .when((kind == 1) | (n < 1), F.array().cast("array<array<double>>"))
        .otherwise(pairs)
    )


def shape_of(coords: Column) -> Column:
    return F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.lit("LineString").alias("type"), coords.alias("coordinates")).alias("geometry"),
        F.lit(None).cast("map<string,string>").alias("properties"),
    ).cast(GEO_SHAPE)


def with_shapes(ev: DataFrame, embeddings: DataFrame | None) -> DataFrame:
    """Attach a line geometry to each event whose id has an embedding (left join)."""
    if embeddings is None:
        return ev.withColumn("geo_shape", F.lit(None).cast(GEO_SHAPE))
    emb = embeddings.select(
        F.col("vec_id").alias("event_id"),
        shape_of(coordinates_of(F.col("embedding"), F.col("label"))).alias("geo_shape"),
    )
    # Equi-join on the id; AQE turns it into a broadcast only if the shape side
    # measures under the broadcast threshold at run time.  Works for a streaming
    # ``ev`` too (stream-static left outer join).
    return ev.join(emb, "event_id", "left")


def traffic_archive(spark: SparkSession, root: str, with_shape: bool = False) -> DataFrame:
    """Events as parsed archive rows (the schema of ``streetflow.schema.ARCHIVE``) plus ``ts``."""
    ev = read_table(spark, root, "events")
    emb = read_table(spark, root, "embeddings") if with_shape else None
    return archive_from_events(with_shapes(ev, emb))


def archive_from_events(ev: DataFrame) -> DataFrame:
    """denomination <- user_id, hierarchie <- event_type, avg_speed <- value,
    max_speed <- $.k of props, date_time <- ts (ISO text), seq <- event_id.
    Batch or streaming input."""
    if "geo_shape" not in ev.columns:
        ev = with_shapes(ev, None)
    k = max_speed_of(F.col("props"))
    return ev.select(
        F.date_format("ts", ISO_FORMAT).alias("date_time"),
        F.col("user_id").cast("string").alias("denomination"),
        F.col("value").alias("avg_speed"),
        F.lit(None).cast("int").alias("travel_time"),
        status_of(F.col("value"), k).alias("traffic_status"),
        F.col("geo_shape"),
        F.col("event_type").alias("hierarchie"),
        F.lit(None).cast("string").alias("hierarchie_dv"),
        k.alias("max_speed"),
        F.col("event_id").alias(SEQ),
        F.date_format("ts", "yyyy-MM-dd").alias("date_partition"),
        F.col("ts"),
    )


def traffic_messages(
    spark: SparkSession, root: str, with_shape: bool = False, corrupt_every: int = 97
) -> DataFrame:
    """Wire messages (``value`` BINARY, ``seq`` BIGINT) built from events with ``to_json``.

    Every ``corrupt_every``-th event id is replaced by a non-JSON payload so the
    permissive-parse and reject paths see real traffic.
    """
    a = traffic_archive(spark, root, with_shape)
    return messages_from_archive(a, corrupt_every)


def messages_from_archive(a: DataFrame, corrupt_every: int | None = 97) -> DataFrame:
    """Archive rows as wire messages, every ``corrupt_every``-th of them replaced by a non-JSON payload."""
    sent = encode_messages(a)
    if not corrupt_every:
        return sent
    corrupt = F.concat(F.lit("corrupt:"), F.col(SEQ).cast("string")).cast("binary")
    return sent.withColumn("value", F.when(F.pmod(F.col(SEQ), F.lit(corrupt_every)) == 0, corrupt).otherwise(F.col("value")))


def spans(spark: SparkSession, root: str) -> DataFrame:
    """orders + lineitem as a span table (FIXTURES §5).

    trace = o_orderkey; the order is the root span (id 0, parent -1, nested-set
    interval (0, 2n+1)); line i (1-based row number in the order by its columns)
    is span i with parent 0 and interval (2i-1, 2i).  duration = price,
    error = returnflag 'R', service = linestatus (roots: orderstatus).
    """
    from pyspark.sql.window import Window

    li = read_table(spark, root, "lineitem")
    o = read_table(spark, root, "orders")
    # Row number within one order: a window partition holds one order's lines.
    w = Window.partitionBy("l_orderkey").orderBy(
        "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
    )
    kids = li.select(
        F.col("l_orderkey").alias("trace_id"),
        F.row_number().over(w).cast("bigint").alias("span_id"),
        F.lit(0).cast("bigint").alias("parent_id"),
        F.concat(F.col("l_returnflag"), F.col("l_linestatus")).alias("name"),
        F.col("l_linestatus").alias("service"),
        F.when(F.col("l_returnflag") == "R", F.lit("error")).otherwise(F.lit("ok")).alias("status"),
        F.col("l_extendedprice").alias("duration"),
        F.col("l_shipdate").alias("start_ts"),
    ).withColumns({"lft": F.col("span_id") * 2 - 1, "rgt": F.col("span_id") * 2})
    # per-trace size and error flag straight from lineitem (an aggregate, no window)
    per_order = li.groupBy(F.col("l_orderkey").alias("trace_id")).agg(
        F.count(F.lit(1)).alias("n"), F.max(F.col("l_returnflag") == "R").alias("any_error")
    )
    roots = (
        o.join(per_order, o.o_orderkey == per_order.trace_id, "left")
        .select(
            F.col("o_orderkey").alias("trace_id"),
            F.lit(0).cast("bigint").alias("span_id"),
            F.lit(-1).cast("bigint").alias("parent_id"),
            F.col("o_orderpriority").alias("name"),
            F.col("o_orderstatus").alias("service"),
            F.when(F.coalesce("any_error", F.lit(False)), F.lit("error")).otherwise(F.lit("ok")).alias("status"),
            F.col("o_totalprice").alias("duration"),
            F.col("o_orderdate").alias("start_ts"),
            F.lit(0).cast("bigint").alias("lft"),
            (F.coalesce("n", F.lit(0)) * 2 + 1).cast("bigint").alias("rgt"),
        )
    )
    return roots.unionByName(kids)
