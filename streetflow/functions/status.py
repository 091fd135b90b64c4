"""Live-map colour of a traffic status."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from streetflow.schema import STATUS_COLOURS


def status_colour(status: Column) -> Column:
    """congested -> RED, freeFlow -> GREEN, anything else -> null."""
    out = None
    for value, colour in STATUS_COLOURS:
        out = (F.when if out is None else out.when)(status == value, F.lit(colour))
    return out.otherwise(F.lit(None).cast("string"))
