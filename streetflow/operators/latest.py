"""Latest row per key (R1, R2, Q3) and the null-key guard (P10).

"Latest" is an aggregate, not a window: ``max`` over a struct whose leading
fields are the order columns.  That plans as a partial + final aggregate, so a
key holding a third of all rows is reduced map-side to one row per task before
the shuffle.  Where the winning row holds strings the aggregate is sort-based:
each task sorts its own input by key (spilling), never a whole key group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_W = "__latest"


def _orderable(df: DataFrame, c: str) -> Column:
    dt = df.schema[c].dataType.simpleString()
    # Maps cannot be compared; their JSON text stands in for them in the order.
    return F.to_json(F.col(c)) if "map<" in dt else F.col(c)


def latest_per_key(
    df: DataFrame,
    key: list[str],
    order: list[str],
    tie_break_all: bool = True,
) -> DataFrame:
    """One row per ``key``: greatest by ``order`` (descending significance), then
    by every other column, so the winner is defined for any input.

    Nulls sort lowest, so a non-null order value beats a null one.
    """
    others = [c for c in df.columns if c not in key and c not in order]
    carried = order + (others if tie_break_all else [])
    fields = [_orderable(df, c).alias(f"o{i}") for i, c in enumerate(carried)]
    # Columns that are not comparable are carried next to the order struct.
    payload = F.struct(*[F.col(c).alias(c) for c in df.columns if c not in key])
    best = F.max_by(payload, F.struct(*fields))
    return df.groupBy(*key).agg(best.alias(_W)).select(*key, f"{_W}.*")


def split_null_keys(df: DataFrame, key: list[str]) -> tuple[DataFrame, DataFrame]:
    """P10: rows a keyed store can hold, and the rows it would reject."""
    ok = F.lit(True)
    for c in key:
        ok = ok & F.col(c).isNotNull()
    return df.where(ok), df.where(~ok)


def null_key_counts(df: DataFrame, tables: dict[str, list[str]]) -> DataFrame:
    """P10 counts for several keyed tables in one pass over ``df``."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for name, key in tables.items():
        bad = F.lit(False)
        for c in key:
            bad = bad | F.col(c).isNull()
        aggs.append(F.count_if(bad).alias(name))
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{n}', `{n}`" for n in tables)
    return wide.selectExpr(
        f"stack({len(tables)}, {stack}) as (table_name, n_rejected)", "n_rows"
    ).select("table_name", "n_rows", F.col("n_rejected").cast("bigint").alias("n_rejected"))
