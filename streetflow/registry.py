"""Registry of named queries: each is a Spark function ``(spark, root) -> DataFrame``
and, where the result is expressible in SQL, the equivalent DuckDB statement
over the raw tables (the correctness oracle).

Domain modules add entries with ``@query(name, oracle=SQL)``.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from streetflow.functions.rounding import nudge_sql
from streetflow.session import ensure_utc

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def expand_r6(sql: str) -> str:
    """``R<n>(x)`` in oracle text -> Spark's ``round(x, n)`` semantics in DuckDB.

    Both sides first add the bounded nudge of ``functions.rounding`` (exact
    midpoints would otherwise round by last-bit noise), then round HALF_UP on
    the decimal text of the double, which is what Spark's ``round`` does.
    """
    out, i = [], 0
    while True:
        m = _RN.search(sql, i)
        if m is None:
            out.append(sql[i:])
            return "".join(out)
        out.append(sql[i : m.start()])
        depth, k = 1, m.end()
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        inner = expand_r6(sql[m.end() : k - 1])
        n = int(m.group(1))
        v = nudge_sql(inner, n)
        out.append(f"CAST(ROUND(TRY_CAST(CAST({v} AS VARCHAR) AS DECIMAL(38,17)), {n}) AS DOUBLE)")
        i = k


_RN = re.compile(r"(?<![A-Za-z0-9_])R([0-9])\(")


def query(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, root: str) -> DataFrame:
            ensure_utc(spark)
            return fn(spark, root)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = expand_r6(oracle)
        return run

    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from streetflow.plans import (  # noqa: F401
        q_logs,
        q_panels,
        q_samples,
        q_spans,
        q_stacks,
        q_streaming,
        q_traffic,
    )
