"""Record layouts.

Fixed values: the wire field names and types, the archive column names, and
the keyed-table keys must equal the source system's for messages and tables
to be interchangeable.  They are listed here together, in their natural order.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
)

# --- fixed values: geometry of one road segment --------------------------------
COORDINATES = ArrayType(ArrayType(DoubleType()))
GEO_SHAPE = StructType(
    [
        StructField("type", StringType()),
        StructField(
            "geometry",
            StructType(
                [
                    StructField("type", StringType()),
                    StructField("coordinates", COORDINATES),
                ]
            ),
        ),
        StructField("properties", MapType(StringType(), StringType())),
    ]
)

# --- fixed values: one wire message (all fields nullable) ----------------------
WIRE = StructType(
    [
        StructField("datetime", StringType()),
        StructField("predefinedlocationreference", StringType()),
        StructField("averagevehiclespeed", DoubleType()),
        StructField("traveltime", IntegerType()),
        StructField("traveltimereliability", IntegerType()),
        StructField("trafficstatus", StringType()),
        StructField("vehicleprobemeasurement", IntegerType()),
        StructField(
            "geo_point_2d",
            StructType([StructField("lat", DoubleType()), StructField("lon", DoubleType())]),
        ),
        StructField("geo_shape", GEO_SHAPE),
        StructField("gml_id", StringType()),
        StructField("id_rva_troncon_fcd_v1_1", IntegerType()),
        StructField("hierarchie", StringType()),
        StructField("hierarchie_dv", StringType()),
        StructField("denomination", StringType()),
        StructField("insee", StringType()),
        StructField("sens_circule", StringType()),
        StructField("vitesse_maxi", IntegerType()),
    ]
)

# --- fixed values: wire field -> archive column (kept fields, in order) --------
RENAMES = [
    ("datetime", "date_time"),
    ("denomination", "denomination"),
    ("averagevehiclespeed", "avg_speed"),
    ("traveltime", "travel_time"),
    ("trafficstatus", "traffic_status"),
    ("geo_shape", "geo_shape"),
    ("hierarchie", "hierarchie"),
    ("hierarchie_dv", "hierarchie_dv"),
    ("vitesse_maxi", "max_speed"),
]

# The wire fields the archive keeps (plus the location reference, which carries
# the sender's record id); parsing only these is cheaper than the full record.
KEPT_WIRE = StructType(
    [f for f in WIRE.fields if f.name in {src for src, _ in RENAMES} | {"predefinedlocationreference"}]
)

# Arrival order is not part of the source record; we carry it so "last write
# wins" has a total order.
# Kafka's order needs three columns: the broker's time (as ``seq``), then offset and partition.
SEQ = "seq"
ARRIVAL = [SEQ, "seq_offset", "seq_partition"]

ARCHIVE = StructType(
    [
        StructField("date_time", StringType()),
        StructField("denomination", StringType()),
        StructField("avg_speed", DoubleType()),
        StructField("travel_time", IntegerType()),
        StructField("traffic_status", StringType()),
        StructField("geo_shape", GEO_SHAPE),
        StructField("hierarchie", StringType()),
        StructField("hierarchie_dv", StringType()),
        StructField("max_speed", IntegerType()),
        *[StructField(c, LongType()) for c in ARRIVAL],
        StructField("date_partition", StringType()),
    ]
)

# --- fixed values: keyed tables (partition key, clustering key) ----------------
REALTIME_KEY = (["denomination"], ["date_time"])
MAPPING_KEY = (["denomination", "hierarchie"], ["date_time", "point_order"])
DAILY_KEY = (["denomination", "hierarchie"], [])

# Status colours of the live map.
STATUS_COLOURS = [("congested", "RED"), ("freeFlow", "GREEN")]
