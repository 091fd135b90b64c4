"""Span operators (X1-X9): RED metrics, root-span panels, duration histograms,
baseline comparison, structural (ancestor/descendant) matching, path roll-up,
exception groups and recent errors.

Span table: ``trace_id, span_id, parent_id (-1 for roots), name, service,
status, duration, start_ts`` (plus nested-set ``lft, rgt``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from streetflow.functions.timeutil import bucket_start
from streetflow.operators.quantiles import exact_quantiles
from streetflow.session import written


def red(spans: DataFrame, attribute: str, bucket_s: int, qs=(0.5, 0.9)) -> DataFrame:
    """Rate, error rate and duration quantiles per time bucket and attribute value;
    spans without the attribute are left out."""
    s = spans.where(F.col(attribute).isNotNull()).withColumn("bucket", bucket_start(F.col("start_ts"), bucket_s))
    return exact_quantiles(
        s,
        ["bucket", attribute],
        "duration",
        list(qs),
        names=[f"p{int(q * 100)}" for q in qs],
        others=[
            F.count(F.lit(1)).alias("n"),
            (F.count(F.lit(1)) / F.lit(float(bucket_s))).alias("rate"),
            (F.count_if(F.col("status") == "error") / F.lit(float(bucket_s))).alias("error_rate"),
        ],
    )


def roots(spans: DataFrame) -> DataFrame:
    """Root spans (no parent)."""
    return spans.where(F.col("parent_id") < 0)


def pow2_ceiling(d: Column) -> Column:
    """X3 bucket edge: the smallest power of two >= d (d > 0), exact at powers of two."""
    k0 = F.ceil(F.log2(d))
    k = (
        F.when(F.pow(F.lit(2.0), k0 - 1) >= d, k0 - 1)
        .when(F.pow(F.lit(2.0), k0) < d, k0 + 1)
        .otherwise(k0)
    )
    return F.when(d > 0, F.pow(F.lit(2.0), k))


def duration_histogram(spans: DataFrame, time_key: Column) -> DataFrame:
    """Span counts per (time key, power-of-two duration bucket)."""
    return spans.groupBy(time_key.alias("period"), pow2_ceiling(F.col("duration")).alias("le")).agg(
        F.count(F.lit(1)).alias("n")
    )


def compare(spans: DataFrame, selection: Column, attributes: list[str]) -> DataFrame:
    """For each attribute value, its share among selected spans minus its share
    among the rest (baseline); attributes ranked by their largest absolute difference.

    One aggregate over (attribute, value); totals and largest differences are
    aggregates by attribute joined back, so no task holds all values of one
    attribute.  Only the table of attributes (one row for each name in
    ``attributes``) is ranked as a whole.
    """
    kv = F.explode(
        F.array(*[F.struct(F.lit(a).alias("attribute"), F.col(a).cast("string").alias("value")) for a in attributes])
    )
    s = spans.select(selection.alias("_sel"), kv.alias("kv")).select("_sel", "kv.*")
    counts = s.groupBy("attribute", "value").agg(
        F.count_if(F.col("_sel")).alias("selection"), F.count_if(~F.col("_sel")).alias("baseline")
    )
    totals = counts.groupBy("attribute").agg(F.sum("selection").alias("_s"), F.sum("baseline").alias("_b"))
    shares = counts.join(totals, "attribute").withColumns(
        {
            "sel_share": F.try_divide(F.col("selection"), F.col("_s")),
            "base_share": F.try_divide(F.col("baseline"), F.col("_b")),
        }
    )
    shares = shares.drop("_s", "_b").withColumn("diff", F.col("sel_share") - F.col("base_share"))
    largest = shares.groupBy("attribute").agg(F.max(F.abs("diff")).alias("max_abs_diff"))
    rank = F.dense_rank().over(Window.orderBy(F.col("max_abs_diff").desc_nulls_last(), F.col("attribute")))
    return shares.join(largest.withColumn("attr_rank", rank), "attribute")


def _by_node(df: DataFrame) -> DataFrame:
    """``df`` as a side of a sort-merge join.  Tables of nodes are written with long runs of
    ids, so their files are many times smaller than their rows: by file size Spark would
    broadcast a table that fills the driver and every task."""
    return df.hint("merge")


def _largest_trace(spans: DataFrame) -> int:
    """Spans of the largest trace: more steps up than that mean a cycle of parents."""
    return spans.groupBy("trace_id").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0


#: Rounds of pointer jumping after which a walk looks how many its longest trace can need.
PATIENCE = 6


def _still_going(spans: DataFrame, rounds: int) -> None:
    """Pointers reach twice as far every round: more rounds than the largest trace has
    binary digits mean a cycle of parents."""
    if rounds > PATIENCE and rounds > _largest_trace(spans).bit_length() + 1:
        raise ValueError("spans have a cycle of parents")


def nearest_ancestor(spans: DataFrame, hit: Column) -> DataFrame:
    """``(trace_id, span_id, up)``: every span's nearest proper ancestor that matches
    ``hit``; null if none does.

    By pointer jumping: a span points at its parent and, while that one doesn't match,
    takes over the parent's own pointer, which reaches twice as far every round.  The
    rounds grow with the logarithm of the depth; each is an equi-join on the pointer,
    written to the shared folder.  Raises on a cycle of parents without a match.
    """
    parent = F.when(F.col("parent_id") >= 0, F.col("parent_id"))
    nodes = spans.select("trace_id", "span_id", parent.alias("up"), F.coalesce(hit, F.lit(False)).alias("hit"))
    above = nodes.select("trace_id", F.col("span_id").alias("up"), F.col("hit").alias("_hit"))
    first = nodes.join(_by_node(above), ["trace_id", "up"], "left")  # a parent that is missing is no pointer
    state = written(
        first.select(
            "trace_id",
            "span_id",
            F.when(F.col("_hit").isNotNull(), F.col("up")).alias("up"),
            F.coalesce("_hit", F.lit(True)).alias("done"),
        ),
        "nearest",
    )
    rounds = 0
    while not state.where("NOT done").isEmpty():
        rounds += 1
        _still_going(spans, rounds)
        above = state.select("trace_id", F.col("span_id").alias("up"), F.col("up").alias("_up"), F.col("done").alias("_done"))
        moved = state.where("NOT done").join(_by_node(above), ["trace_id", "up"])
        moved = moved.select("trace_id", "span_id", F.col("_up").alias("up"), F.col("_done").alias("done"))
        state = written(state.where("done").unionByName(moved), "nearest")
    return state.select("trace_id", "span_id", "up")


def structural_match(spans: DataFrame, ancestor: Column, descendant: Column) -> DataFrame:
    """X5 (``A &>> B``): descendant spans matching B under an ancestor matching A,
    one row for each such pair (``ancestor_id`` and the descendant's columns).

    Only traces with matches of both sides take part.  The matches of A form a forest
    of their own by ``nearest_ancestor``; in it, tables of jumps over 1, 2, 4, ... nodes
    and the number of nodes above are made by doubling.  A descendant with k ancestors
    gets k rows, and the row for the i-th follows the jumps that the binary digits of i
    name.  So the rounds grow with the logarithm of the depth, the rows with the
    result, and every join is an equi-join on a node, which AQE can split where many
    spans share a parent.  Raises on a cycle of parents.
    """
    traces = spans.groupBy("trace_id").agg(F.max(F.coalesce(ancestor, F.lit(False))).alias("a"), F.max(F.coalesce(descendant, F.lit(False))).alias("b"))
    nodes = spans.select("trace_id", "span_id", "parent_id", ancestor.alias("_a"), descendant.alias("_b"))
    nodes = written(nodes.join(_by_node(traces.where("a AND b").select("trace_id")), "trace_id", "left_semi"), "match-nodes")
    nearest = _by_node(nearest_ancestor(nodes, F.col("_a")).where("up IS NOT NULL"))
    start = nodes.where("_b").select("trace_id", "span_id").join(nearest, ["trace_id", "span_id"])
    start = start.select("trace_id", "span_id", F.col("up").alias("ancestor_id"))

    forest = nodes.where("_a").select("trace_id", "span_id").join(nearest, ["trace_id", "span_id"], "left")
    state = written(forest.withColumn("above", F.col("up").isNotNull().cast("long")), "jumps")
    jumps, all_above = [], state
    while not (linked := state.where("up IS NOT NULL")).isEmpty():
        jumps.append(linked.select("trace_id", F.col("span_id").alias("ancestor_id"), F.col("up").alias("_next")))
        _still_going(spans, len(jumps))
        upper = state.select("trace_id", F.col("span_id").alias("up"), F.col("up").alias("_up"), F.col("above").alias("_above"))
        state = state.join(_by_node(upper), ["trace_id", "up"], "left")
        state = state.select("trace_id", "span_id", F.col("_up").alias("up"), (F.col("above") + F.coalesce("_above", F.lit(0))).alias("above"))
        state = all_above = written(state, "jumps")
    if jumps:
        above = all_above.select("trace_id", F.col("span_id").alias("ancestor_id"), "above")
        pairs = start.join(_by_node(above), ["trace_id", "ancestor_id"])
        pairs = pairs.select("trace_id", "span_id", "ancestor_id", F.explode(F.expr("sequence(0L, above)")).alias("steps"))
        for digit, table in enumerate(jumps):
            jumping = pairs.withColumn("_jumps", F.expr(f"(steps >> {digit}) & 1 = 1"))
            moved = jumping.where("_jumps").join(_by_node(table), ["trace_id", "ancestor_id"])
            moved = moved.select("trace_id", "span_id", F.col("_next").alias("ancestor_id"), "steps")
            pairs = written(jumping.where("NOT _jumps").drop("_jumps").unionByName(moved), "matches")
        start = pairs.drop("steps")
    return start.join(_by_node(spans.where(descendant)), ["trace_id", "span_id"])


def name_paths(spans: DataFrame) -> DataFrame:
    """Root-to-span path of names for every span, and its number of ancestors.

    By doubling: each span holds the path from below some ancestor down to itself,
    and a round puts the ancestor's own path in front and takes over its ancestor,
    so the rounds grow with the logarithm of the depth, whatever the depth.  A span
    whose parent is missing begins a path; a null name is an empty step.  Raises on a cycle of parents.
    """
    up = F.when(F.col("parent_id") >= 0, F.col("parent_id"))
    paths = spans.select("trace_id", "span_id", up.alias("up"), F.coalesce("name", F.lit("")).alias("path"), F.lit(0).alias("depth"))
    most = _largest_trace(spans).bit_length() + 1
    for _ in range(most + 1):
        above = paths.select(
            "trace_id", F.col("span_id").alias("up"), F.col("up").alias("_up"), F.col("path").alias("_path"),
            F.col("depth").alias("_depth"),
        )
        found = F.col("_depth").isNotNull()
        joined = paths.join(_by_node(above), ["trace_id", "up"], "left")
        paths = written(
            joined.select(
                "trace_id",
                "span_id",
                F.col("_up").alias("up"),
                F.when(found, F.concat("_path", F.lit("/"), "path")).otherwise(F.col("path")).alias("path"),
                F.when(found, F.col("depth") + F.col("_depth") + 1).otherwise(F.col("depth")).alias("depth"),
            ),
            "paths",
        )
        if paths.where("up IS NOT NULL").isEmpty():
            return spans.join(_by_node(paths.select("trace_id", "span_id", "path", "depth")), ["trace_id", "span_id"])
    raise ValueError("spans have a cycle of parents")


def path_rollup(spans: DataFrame) -> DataFrame:
    """Merge span trees across traces by name path: spans and traces per path."""
    p = name_paths(spans)
    return p.groupBy("path", "depth").agg(
        F.count(F.lit(1)).alias("n_spans"), F.count_distinct("trace_id").alias("n_traces")
    )


def error_groups(df: DataFrame, message: str, type_: str, ts: str) -> DataFrame:
    """Exceptions table: per (message, type) the count and when last seen."""
    return df.groupBy(F.col(message).alias("message"), F.col(type_).alias("type")).agg(
        F.count(F.lit(1)).alias("n"), F.max(ts).alias("last_seen")
    )


def recent(df: DataFrame, where: Column, columns: list[str], order: list[Column], limit: int) -> DataFrame:
    """Most recent matching spans with chosen fields (TakeOrderedAndProject)."""
    return df.where(where).select(*columns).orderBy(*order).limit(limit)
