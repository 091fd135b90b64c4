"""Stack-sample operators (Y1-Y5): flame table, flame diff, profile totals.

A stack sample is ``(sample id, depth position, frame)`` rows plus a weight;
the tables never collect a stack into one array: leaf = ``max_by`` per sample,
"stack contains f" = distinct (sample, frame) pairs, both aggregates that combine
map-side.  Only the call tree, whose nodes are stack prefixes, needs a sample's
frames in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streetflow.session import written


def stack_summary(frames: DataFrame, sample: str, pos: str, frame: str, weight: Column | None = None) -> DataFrame:
    """Per sample: leaf frame, depth and weight (a sample's own value, the same in all
    its rows; 1 unless given)."""
    return frames.groupBy(sample).agg(
        F.max_by(frame, pos).alias("leaf"), F.count(F.lit(1)).alias("depth"), _weight(weight).alias("weight")
    )


def _weight(weight: Column | None) -> Column:
    return F.max(weight) if weight is not None else F.lit(1).cast("bigint")


def frames_in_stack(frames: DataFrame, sample: str, frame: str, weight: Column | None = None) -> DataFrame:
    """Distinct (sample, frame) pairs with the sample's weight: "total" counts a function once per stack."""
    return frames.groupBy(sample, frame).agg(_weight(weight).alias("weight"))


def flame_table(
    frames: DataFrame, sample: str, pos: str, frame: str, weight: Column | None = None, max_nodes: int | None = None
) -> DataFrame:
    """Self (leaf) and total (in stack) weight per function, largest first; the sums
    keep the weight's own type (whole or floating)."""
    leaf = stack_summary(frames, sample, pos, frame, weight).groupBy(F.col("leaf").alias("function")).agg(
        F.sum("weight").alias("self")
    )
    total = frames_in_stack(frames, sample, frame, weight).groupBy(F.col(frame).alias("function")).agg(
        F.sum("weight").alias("total")
    )
    out = total.join(leaf, "function", "full").select(
        "function", F.coalesce("self", F.lit(0)).alias("self"), F.coalesce("total", F.lit(0)).alias("total")
    )
    out = out.orderBy(F.col("total").desc(), F.col("self").desc(), "function")
    return out.limit(max_nodes) if max_nodes else out


OTHER = "(other)"


def _prefix_nodes(frames: Column) -> Column:
    """The nodes on a stack's way from its root: ``(id, parent, depth, function)``, where an id
    is a running hash of the frames so far and the root's parent is the empty id."""

    def step(nodes: Column, f: Column) -> Column:
        parent = F.when(F.size(nodes) > 0, F.element_at(nodes, -1)["id"]).otherwise(F.lit(""))
        node = F.struct(
            F.md5(F.concat(parent, F.lit("/"), f).cast("binary")).alias("id"),
            parent.alias("parent"),
            (F.size(nodes) + 1).alias("depth"),
            f.alias("function"),
        )
        return F.concat(nodes, F.array(node))

    none = F.array().cast("array<struct<id:string,parent:string,depth:int,function:string>>")
    return F.aggregate(frames, none, step)


def flame_tree(
    frames: DataFrame, sample: str, pos: str, frame: str, weight: Column | None = None, max_nodes: int | None = None
) -> DataFrame:
    """The call tree of all samples, ``(id, parent, depth, function, self, total)``.

    A node is a distinct way from the root; ``self`` is the weight of the stacks that end
    there, ``total`` that of all that pass.  With ``max_nodes`` the heaviest nodes are kept
    (of equal ones the less deep, so a parent always stays with its children), and what is
    cut below a node becomes one row ``(other)`` under it: the self values add up to the
    whole weight at any limit.

    A stack is one record's frames, so its array is bounded by the record.  Equal stacks
    are added up before they are cut into nodes."""
    stack = F.transform(F.array_sort(F.collect_list(F.struct(F.col(pos), F.coalesce(F.col(frame), F.lit("")).alias("f")))), lambda x: x["f"])
    stacks = frames.groupBy(sample).agg(stack.alias("stack"), _weight(weight).alias("weight"))
    stacks = stacks.groupBy("stack").agg(F.sum("weight").alias("weight"))
    nodes = stacks.select("weight", F.size("stack").alias("size"), F.explode(_prefix_nodes(F.col("stack"))).alias("node")).select("weight", "size", "node.*")
    own = F.coalesce(F.sum(F.when(F.col("depth") == F.col("size"), F.col("weight"))), F.lit(0))
    nodes = nodes.groupBy("id", "parent", "depth", "function").agg(own.alias("self"), F.sum("weight").alias("total"))
    if max_nodes is None:
        return nodes
    nodes = written(nodes, "flame-nodes")
    kept = written(nodes.orderBy(F.col("total").desc(), "depth", "id").limit(max_nodes), "flame-kept")
    cut = nodes.join(kept.select("id"), "id", "left_anti")
    parents = kept.select(F.col("id").alias("parent"), (F.col("depth") + 1).alias("depth")).union(
        kept.sparkSession.createDataFrame([("", 1)], "parent string, depth int")
    )
    rest = cut.select("parent", "total").join(parents, "parent").groupBy("parent", "depth").agg(F.sum("total").alias("total"))
    rest = rest.select(F.lit(None).cast("string").alias("id"), "parent", "depth", F.lit(OTHER).alias("function"), F.col("total").alias("self"), "total")
    return kept.unionByName(rest)


def flame_diff(frames: DataFrame, sample: str, frame: str, side: Column, weight: Column | None = None) -> DataFrame:
    """Per function, the weight of stacks containing it on the left and right
    selection, their shares of each side's weight and the difference (right - left)."""

    def of(name: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("_side") == name, F.col("weight"))), F.lit(0))

    def share(name: str) -> Column:
        return F.max(F.when(F.col("_side") == name, F.try_divide(F.col("_w"), F.col("_all")))).alias(f"{name}_share")

    tagged = frames.withColumn("_side", side)
    per_fn = tagged.groupBy(sample, frame, "_side").agg(_weight(weight).alias("weight"))
    per_fn = per_fn.groupBy(F.col(frame).alias("function")).agg(of("left").alias("left"), of("right").alias("right"))
    sides = tagged.groupBy(sample, "_side").agg(_weight(weight).alias("weight"))
    sides = sides.where(F.col("_side").isin("left", "right")).groupBy("_side").agg(F.sum("weight").alias("_all"))  # two rows
    by_side = F.explode(F.array(*[F.struct(F.lit(n).alias("_side"), F.col(n).alias("_w")) for n in ("left", "right")])).alias("s")
    shares = per_fn.select("function", "left", "right", by_side).select("function", "left", "right", "s.*").join(sides, "_side", "left")
    out = shares.groupBy("function", "left", "right").agg(share("left"), share("right"))
    return out.withColumn("diff", F.col("right_share") - F.col("left_share"))


def profile_totals(
    samples: DataFrame,
    labels: list[str],
    metrics: dict[str, tuple[str, str]],
    fn_hit: Column | None = None,
    bucket: Column | None = None,
) -> DataFrame:
    """Y1 + Y2 + Y5: per label set (and time bucket, if given, as ``bucket``), each metric folded by its kind -- a
    ``cumulative`` metric is summed, an ``instant`` one averaged; with ``fn_hit``
    each metric is also given restricted to stacks containing the chosen function
    (``<name>_fn``)."""
    aggs = []
    for name, (col, kind) in metrics.items():
        agg = F.sum if kind == "cumulative" else F.avg
        aggs.append(agg(F.col(col)).alias(name))
        if fn_hit is not None:
            aggs.append(agg(F.when(fn_hit, F.col(col))).alias(f"{name}_fn"))
    return samples.groupBy(*([bucket.alias("bucket")] if bucket is not None else []), *labels).agg(*aggs)


def recorded_totals(frames: DataFrame, sample: str, frame: str, ts: str, weight: str, width: str, delay: str | None = None) -> DataFrame:
    """Y5, the recording rule: per window and function the weight of the samples whose stack
    holds the function, ``(window_start, function, samples, total)``.

    The same on a batch and on a stream.  A function counts once a sample: on a stream
    repeated (sample, frame) pairs are dropped within the watermark ``delay`` (all rows of a
    sample have one time), so the state holds the pairs of the open windows only."""
    pairs = frames.select(sample, F.col(frame).alias("function"), F.col(ts).cast("timestamp").alias("at"), F.col(weight).alias("weight"))
    if frames.isStreaming:
        pairs = pairs.withWatermark("at", delay).dropDuplicatesWithinWatermark([sample, "function"])
    else:
        pairs = pairs.groupBy(sample, "function").agg(F.min("at").alias("at"), F.max("weight").alias("weight"))
    out = pairs.groupBy(F.window("at", width).alias("w"), "function").agg(F.count(F.lit(1)).alias("samples"), F.sum("weight").alias("total"))
    return out.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "function", "samples", "total")
