"""Dashboard read queries over a keyed/time-series table (Q1-Q10).

A panel is configured by column names (time, value, id) plus id values, a time
range, an alias template, or free SQL; each function returns a lazy DataFrame.
Id lists go into ``isin`` (pushed into the Parquet scan as an In filter);
ids that come from another query (a chained variable) are applied as a
left-semi join so they never pass through the driver.
"""

from __future__ import annotations

import re
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streetflow.functions.timeutil import epoch_seconds
from streetflow.operators.latest import latest_per_key


def parse_ids(ids: str | list[str] | None) -> list[str] | None:
    """Id values as typed in the editor: a list or one comma-joined string."""
    if ids is None:
        return None
    if isinstance(ids, str):
        return [p.strip() for p in ids.split(",") if p.strip()]
    return list(ids)


def time_range(ts: Column, time_from=None, time_to=None) -> Column:
    """``$__timeFrom`` / ``$__timeTo``: strict bounds, as in the documented example."""
    cond = F.lit(True)
    if time_from is not None:
        cond = cond & (ts > F.lit(time_from).cast(ts_type(time_from)))
    if time_to is not None:
        cond = cond & (ts < F.lit(time_to).cast(ts_type(time_to)))
    return cond


def ts_type(v) -> str:
    return "bigint" if isinstance(v, int) else "timestamp_ntz"


def series(
    df: DataFrame,
    time_col: str,
    value_col: str,
    id_col: str,
    ids: str | list[str] | DataFrame | None = None,
    time_from=None,
    time_to=None,
) -> DataFrame:
    """Q1 + Q2: rows of the chosen series inside the range, as (id, value, time)."""
    out = df.where(time_range(F.col(time_col), time_from, time_to))
    if isinstance(ids, DataFrame):
        out = out.join(ids.select(F.col(ids.columns[0]).alias(id_col)), id_col, "left_semi")
    elif ids is not None:
        out = out.where(F.col(id_col).isin(parse_ids(ids)))
    return out.select(F.col(id_col).alias("id"), F.col(value_col).alias("value"), F.col(time_col).alias("time"))


def with_epoch(df: DataFrame, ts_col: str, out: str = "time_epoch") -> DataFrame:
    """Integer epoch-seconds time column (for ``$__unixEpochFrom/To``)."""
    return df.withColumn(out, F.floor(epoch_seconds(F.col(ts_col))).cast("bigint"))


def epoch_range(ts: Column, epoch_from: int, epoch_to: int) -> Column:
    """``$__unixEpochFrom/To`` as bounds on the stored time itself: whole seconds strictly
    between both are times from one second after the first and before the second.  Unlike
    bounds on a derived epoch this reaches the scan."""
    day0 = datetime(1970, 1, 1)
    low, high = (day0 + timedelta(seconds=s) for s in (epoch_from + 1, epoch_to))
    return (ts >= F.lit(low.isoformat(" ")).cast("timestamp_ntz")) & (ts < F.lit(high.isoformat(" ")).cast("timestamp_ntz"))


def unix_epoch(ts: str | datetime) -> int:
    """Macro value of ``$__unixEpochFrom`` for a UTC wall time."""
    d = datetime.fromisoformat(ts) if isinstance(ts, str) else ts
    return int((d - datetime(1970, 1, 1)).total_seconds())


def macro_values(time_from: str, time_to: str) -> dict[str, str]:
    """Q2: SQL literals of the time-range macros for a UTC range.

    ``$__timeFrom/$__timeTo`` are timestamps, ``$__unixEpochFrom/To`` epoch
    seconds, ``$__from/$__to`` epoch milliseconds.
    """
    f, t = datetime.fromisoformat(time_from), datetime.fromisoformat(time_to)
    ms = lambda d: int((d - datetime(1970, 1, 1)).total_seconds() * 1000)
    return {
        "$__timeFrom": f"TIMESTAMP_NTZ '{f.isoformat(sep=' ')}'",
        "$__timeTo": f"TIMESTAMP_NTZ '{t.isoformat(sep=' ')}'",
        "$__unixEpochFrom": str(ms(f) // 1000),
        "$__unixEpochTo": str(ms(t) // 1000),
        "$__from": str(ms(f)),
        "$__to": str(ms(t)),
    }


def expand_macros(text: str, time_from: str, time_to: str) -> str:
    """Substitute the time-range macros in a panel's query text (longest names first)."""
    vals = macro_values(time_from, time_to)
    for name in sorted(vals, key=len, reverse=True):
        text = text.replace(name, vals[name])
    return text


def instant(df: DataFrame, time_col: str, value_col: str, id_col: str, order: list[str] | None = None) -> DataFrame:
    """Q3: the newest row of each id (PER PARTITION LIMIT 1 on a time-DESC table)."""
    cols = [id_col, time_col, value_col] + [c for c in (order or []) if c not in (id_col, time_col, value_col)]
    latest = latest_per_key(df.select(*cols), [id_col], [time_col] + (order or []))
    return latest.select(F.col(id_col).alias("id"), F.col(value_col).alias("value"), F.col(time_col).alias("time"))


_TEMPLATE = re.compile(r"\{\{\s*([A-Za-z_][A-Za-z0-9_]*)\s*\}\}")


def alias_column(template: str) -> Column:
    """Q4: ``{{ column1 }}:{{ column2 }}`` -> a series-name column (literal parts kept)."""
    parts: list[Column] = []
    pos = 0
    for m in _TEMPLATE.finditer(template):
        if m.start() > pos:
            parts.append(F.lit(template[pos : m.start()]))
        parts.append(F.coalesce(F.col(m.group(1)).cast("string"), F.lit("")))
        pos = m.end()
    if pos < len(template):
        parts.append(F.lit(template[pos:]))
    return F.concat(*parts) if parts else F.lit(template)


def table_panel(df: DataFrame, columns: list[str], order: list[Column], limit: int | None = None) -> DataFrame:
    """Q5: raw rows, sorted, optionally limited (plans as TakeOrderedAndProject)."""
    out = df.select(*columns).orderBy(*order)
    return out.limit(limit) if limit else out


def labelled(df: DataFrame, label_cols: list[str]) -> DataFrame:
    """Q6 long form: non-time fields become one label map per row."""
    keys = F.array(*[F.lit(c) for c in label_cols])
    vals = F.array(*[F.col(c).cast("string") for c in label_cols])
    return df.withColumn("labels", F.map_from_arrays(keys, vals))


def long_to_wide(
    df: DataFrame, time_col: str, id_col: str, value_col: str, ids: list[str], agg: str = "avg"
) -> DataFrame:
    """Q6 wide form: one column per id, one row per time; ids given up front so
    the pivot needs no extra distinct job.  A row of another id is an error when the
    result is computed, never left out silently; filter the input to leave ids out."""
    known = F.col(id_col).isin(ids)
    message = F.concat(F.lit("long_to_wide: id not listed: "), F.coalesce(F.col(id_col).cast("string"), F.lit("null")))
    listed = df.withColumn(id_col, F.when(known, F.col(id_col)).otherwise(F.raise_error(message)))
    return listed.groupBy(time_col).pivot(id_col, ids).agg(getattr(F, agg)(value_col))


def variable_values(df: DataFrame, col: str, where: dict[str, str] | None = None) -> DataFrame:
    """Q7: distinct values for a picker; earlier picks filter the later variable."""
    out = df
    for k, v in (where or {}).items():
        out = out.where(F.col(k) == F.lit(v))
    return out.select(F.col(col).alias("value")).distinct()


def panel_sql(
    spark: SparkSession,
    text: str,
    args: dict | None = None,
    between: tuple[str, str] | None = None,
    **frames: DataFrame,
) -> DataFrame:
    """Q8: the user's own SQL over named DataFrames (``{name}``) with bound
    parameters (``:name``) and the time-range macros; no session-wide temp
    views are created."""
    if between:
        text = expand_macros(text, *between)
    return spark.sql(text, args=args, **frames)


def alert_states(latest: DataFrame, bound: float, value_col: str = "value") -> DataFrame:
    """Q9: last value of each series against a bound -> alerting / ok."""
    state = F.when(F.col(value_col) > F.lit(bound), F.lit("alerting")).otherwise(F.lit("ok"))
    return latest.withColumn("state", state)


def annotations(df: DataFrame, time_col: str, text: Column, title: Column, time_from=None, time_to=None) -> DataFrame:
    """Q10: (time, title, text) rows inside the range."""
    return df.where(time_range(F.col(time_col), time_from, time_to)).select(
        F.col(time_col).alias("time"), title.alias("title"), text.alias("text")
    )


def panel_query(
    tables: dict[str, DataFrame], spec: dict, time_from: str | None = None, time_to: str | None = None
) -> DataFrame:
    """One configured panel, as the dashboard sends it: ``table``, ``columnTime``,
    ``columnValue``, ``columnId``, optional ``valueId`` (list, csv or a DataFrame
    of ids from a chained variable), ``instant`` and ``alias`` (template).

    Returns ``(id | alias, value, time)`` rows: the series in the range, or the
    newest row of each series for an instant panel.
    """
    df = tables[spec["table"]]
    t, v, i = spec["columnTime"], spec["columnValue"], spec["columnId"]
    ids = spec.get("valueId")
    if isinstance(ids, DataFrame):
        df = df.join(ids.select(F.col(ids.columns[0]).alias(i)), i, "left_semi")
    elif ids is not None:
        df = df.where(F.col(i).isin(parse_ids(ids)))
    order = spec.get("order", [])
    if spec.get("instant"):
        carry = [c for c in df.columns if c not in (i, t, v)]
        df = latest_per_key(df.select(i, t, v, *carry), [i], [t, *order])
    else:
        df = df.where(time_range(F.col(t), time_from, time_to))
    label = alias_column(spec["alias"]).alias("alias") if spec.get("alias") else F.col(i).alias("id")
    return df.select(label, F.col(v).alias("value"), F.col(t).alias("time"))
