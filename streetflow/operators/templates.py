"""Log templates mined from the lines themselves (L5): constant words stay, variable ones
become a wildcard.

Lines are masked (hex and digit runs) and cut into tokens at single spaces; lines of
different numbers of tokens never share a template.

1. *Token-position frequencies.*  A token is a constant at its position if at least
   ``support`` lines of its length have it there, else it is a wildcard.  The support
   of a length is a share of its lines, ``min_lines`` at least, so a position has at most
   1 / share constants, however large the corpus is.
2. *Prefix-tree merging.*  Tokens are constants by position alone, so chance meetings
   leave rare branches.  The templates of a length form a tree by their first tokens;
   level by level, for the first ``depth`` ones, a branch that fewer than ``support`` lines
   take is merged into its parent's wildcard branch.

Every distinct masked line is handled once, with its number of lines, and moves whole:
no row is made for each of its tokens.  The lines of a length are cut into parts of about
``PART_BYTES`` by a hash; a part counts its tokens, and a length that is one part sends on
only those that are frequent.  The parts' counts are summed up, and each part marks its
lines with the constants of its length.  Branches are merged over the distinct first
tokens of the templates, which are an aggregate with map-side combine.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from streetflow.operators.logs import mask_pattern
from streetflow.session import written

WILDCARD = "<*>"

#: Bytes of lines that a task holds at once, one line at least, and tokens that it sorts at once.
PART_BYTES, SORTED_TOKENS = 24 << 20, 1 << 20


def _supports(texts: DataFrame, min_lines: int, share: float) -> DataFrame:
    """``(size, support, parts)``: one row for each number of tokens."""
    lines = texts.groupBy("size").agg(F.sum("n").alias("lines"), F.sum(F.octet_length("pattern") + 1).alias("bytes"))
    support = F.greatest(F.lit(min_lines), F.ceil(F.col("lines") * F.lit(share)))
    return lines.select("size", support.alias("support"), F.ceil(F.col("bytes") / PART_BYTES).alias("parts"))


def _part_work() -> tuple[Callable, Callable]:
    """What tasks do with a part, as functions that travel whole: workers need not have this library."""

    def tokens(patterns: pa.ChunkedArray, size: int) -> tuple[np.ndarray, pa.Array]:
        """The lines' tokens: a row of codes for each line, and what the codes stand for."""
        flat = pc.list_flatten(pc.split_pattern(patterns, " "))
        coded = flat.combine_chunks().dictionary_encode() if isinstance(flat, pa.ChunkedArray) else flat.dictionary_encode()
        return coded.indices.to_numpy(zero_copy_only=False).reshape(-1, size), coded.dictionary

    def frequent(part: pa.Table) -> pa.Table:
        """Lines of each token at each position; of a length that is one part only the constants."""
        size, support, parts = (part.column(c)[0].as_py() for c in ("size", "support", "parts"))
        codes, words = tokens(part.column("pattern"), size)
        n = part.column("n").to_numpy()
        step = max(1, SORTED_TOKENS // len(n))
        found: list[list] = [[], [], []]
        for at in range(0, size, step):
            cells = codes[:, at : at + step].astype(np.int64)
            width = cells.shape[1]
            seen, which = np.unique(cells + np.arange(width) * len(words), return_inverse=True)
            lines = np.zeros(len(seen), np.int64)
            np.add.at(lines, which.reshape(-1), np.repeat(n, width))
            kept = lines >= (support if parts == 1 else 0)
            for column, values in zip(found, (at + seen[kept] // len(words), seen[kept] % len(words), lines[kept]), strict=True):
                column.append(values)
        pos, code, lines = (np.concatenate(c) for c in found)
        same = lambda v: pa.array(np.full(len(pos), v))
        return pa.table({"size": same(size).cast(pa.int32()), "support": same(support), "pos": pa.array(pos, pa.int32()), "token": words.take(pa.array(code)), "lines": pa.array(lines)})

    def marked(key: tuple, part: pa.Table, constants: pa.Table) -> pa.Table:
        """The lines of a part with their rare tokens replaced by the wildcard."""
        size = key[0].as_py()
        if not part.num_rows:
            texts: pa.Array = pa.array([], pa.string())
        else:
            codes, words = tokens(part.column("pattern"), size)
            code = pc.index_in(constants.column("token").combine_chunks(), words)
            at = constants.column("pos").to_numpy()
            known = code.is_valid().to_numpy(zero_copy_only=False)
            wanted = np.sort(at[known].astype(np.int64) * len(words) + code.drop_null().to_numpy())
            shown = codes.copy()
            step = max(1, SORTED_TOKENS // len(codes))
            for first in range(0, size, step):
                cells = codes[:, first : first + step]
                cell = cells.astype(np.int64) + np.arange(first, first + cells.shape[1]) * len(words)
                shown[:, first : first + step] = np.where(np.isin(cell, wanted), cells, len(words))
            shown_words = pa.concat_arrays([words, pa.array([WILDCARD], words.type)]).take(pa.array(shown.reshape(-1)))
            ends = pa.array(np.arange(len(codes) + 1, dtype=np.int64) * size)
            texts = pc.binary_join(pa.LargeListArray.from_arrays(ends, shown_words), " ")
        return pa.table({"pattern": part.column("pattern"), "size": part.column("size"), "n": part.column("n"), "support": part.column("support"), "marked": texts})

    return frequent, marked


def _by_frequency(texts: DataFrame, supports: DataFrame) -> DataFrame:
    """``(pattern, size, n, support, marked)``: rare tokens replaced by the wildcard."""
    # lengths are few: together they have no more tokens than the texts, so n tokens have sqrt(2 n) lengths at most
    frequent, marked = _part_work()
    placed = texts.join(F.broadcast(supports), "size").withColumn("part", F.pmod(F.xxhash64("pattern"), "parts"))
    counts = placed.groupBy("size", "part").applyInArrow(frequent, "size int, support long, pos int, token string, lines long")
    summed = counts.groupBy("size", "pos", "token").agg(F.sum("lines").alias("lines"), F.first("support").alias("support"))
    constants = summed.where("lines >= support").select("size", "pos", "token")
    parts = supports.select("size", F.explode(F.expr("sequence(0L, parts - 1)")).alias("part"))
    constants = written(constants.join(F.broadcast(parts), "size"), "constants")
    both = placed.groupBy("size", "part").cogroup(constants.groupBy("size", "part"))
    return both.applyInArrow(marked, "pattern string, size int, n long, support long, marked string")


def _merged(tokens: Column, at: int, taken: Column) -> Column:
    return F.transform(tokens, lambda t, i: F.when((i == at) & taken, F.lit(WILDCARD)).otherwise(t))


def _merge_branches(rows: DataFrame, depth: int) -> DataFrame:
    """``(size, head, template)``: the first ``depth`` tokens of the templates with their rare branches merged."""
    tree = rows.groupBy("size", "head").agg(F.sum("n").alias("n"), F.first("support").alias("support"))
    tree = tree.withColumn("template", F.col("head"))
    for at in range(depth):
        branch = Window.partitionBy("size", F.slice("template", 1, at + 1))
        tree = tree.withColumn("_lines", F.sum("n").over(branch))
        tree = tree.withColumn("template", _merged(F.col("template"), at, F.col("_lines") < F.col("support"))).drop("_lines")
    return tree.select("size", "head", "template")


def mine_templates(df: DataFrame, line: str, min_lines: int = 10, share: float = 0.001, depth: int = 4) -> DataFrame:
    """``(pattern, template)``: the template of every distinct masked line of ``df``."""
    texts = df.where(F.col(line).isNotNull()).groupBy(mask_pattern(F.col(line)).alias("pattern")).agg(F.count(F.lit(1)).alias("n"))
    texts = written(texts.select("pattern", "n", F.size(F.split("pattern", " ", -1)).alias("size")), "patterns")
    supports = written(_supports(texts, min_lines, share), "supports")
    rows = written(_by_frequency(texts, supports), "pattern-tokens")
    tokens = F.split("marked", " ", -1)
    rows = rows.withColumn("head", F.slice(tokens, 1, depth))
    found = rows.join(_merge_branches(rows, depth).hint("merge"), ["size", "head"])
    rest = F.slice(tokens, depth + 1, F.greatest(F.col("size") - depth, F.lit(0)))
    return found.select("pattern", F.array_join(F.concat("template", rest), " ").alias("template"))


def template_rollup(df: DataFrame, line: str, bucket: str, level: str, **rule) -> DataFrame:
    """For each template its lines, masked patterns, buckets seen and set of levels."""
    mined = written(mine_templates(df, line, **rule), "templates")
    lines = df.where(F.col(line).isNotNull()).select(mask_pattern(F.col(line)).alias("pattern"), bucket, level)
    joined = lines.join(mined.hint("merge"), "pattern")
    per_bucket = joined.groupBy("template", bucket).agg(F.count(F.lit(1)).alias("n"), F.collect_set(level).alias("levels"))
    levels = F.array_distinct(F.flatten(F.collect_list("levels")))  # a set of levels a bucket
    totals = per_bucket.groupBy("template").agg(
        F.sum("n").alias("total"), F.count(F.lit(1)).alias("n_buckets"), F.array_join(F.array_sort(levels), ",").alias("levels")
    )
    members = mined.groupBy("template").agg(F.count(F.lit(1)).alias("n_patterns"))
    return totals.join(members, "template")
