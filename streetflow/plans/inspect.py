"""Plan inspection: the checks we apply to every registered query's physical plan."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def python_nodes(plan: str) -> list[str]:
    """Python evaluation nodes (the slow path) present in a plan."""
    return [n for n in PYTHON_NODES if n in plan]


def single_partition_exchanges(plan: str) -> int:
    """Shuffles into one partition (global sort / limit / ungrouped aggregate)."""
    return len(re.findall(r"Exchange SinglePartition|Arguments: SinglePartition", plan))


def read_schemas(plan: str) -> list[str]:
    return re.findall(r"ReadSchema: (struct<.*?>)\n", plan)


def pushed_filters(plan: str) -> list[str]:
    return re.findall(r"PushedFilters: \[(.*?)\]\n", plan)


def partition_filters(plan: str) -> list[str]:
    return re.findall(r"PartitionFilters: \[(.*?)\]\n", plan)
