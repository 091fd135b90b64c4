"""Document fingerprints: a Merkle tree over paragraphs and sections, in SQL functions only.

A text's paragraphs are its lines.  A paragraph's digest is the SHA-256 of its text; a
section is a run of paragraphs that ends after one whose digest ends in ``0`` (so a
section's limits depend on its own text alone), its digest the SHA-256 of its
paragraphs' digests; the root is the SHA-256 of the sections' digests.  Below each
paragraph lie leaves, short digests of its pieces, of 6 characters each up to the 24th
and of 24 from there on.  The fingerprint is the tree, written as

    root | section ; section ; ...        a section:    digest = paragraph , paragraph ...
                                          a paragraph:  digest : leaves

with 16 hex digits of section and paragraph digests and five of a leaf.  Equal roots mean
equal texts.  Where roots differ, :func:`branches` names the sections of one tree that the
other lacks, :func:`paragraphs` the paragraphs below them, and :func:`compare` goes down
both trees: what lies under a common section agrees as a whole, of the other sections
what lies under a common paragraph, and of the other paragraphs the common leaves.

Edits are made from the next document in ascending (id, hash of the text).  The order
is found on ids alone, range-partitioned; texts are shuffled once by key, and only the
needed beginning of the next text travels again.

Defined cases: a null text is the empty text, one empty paragraph; the document after
the last is the first, so a single document is its own next; a null id sorts first;
rows that repeat an id are ordered by the hash of their texts, rows that repeat both
count as one document; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streetflow.llm.common import id_and_text, keep

#: Pieces of a paragraph: 6 characters each up to the 24th, 24 from there on.
PIECE = r"(?s)(?<=^.{0,18}).{1,6}|(?s).{1,24}"


def _piece_digest(piece: Column) -> Column:
    return F.lpad(F.lower(F.hex(F.pmod(F.xxhash64(piece), F.lit(1 << 20)))), 5, "0")


def _sha(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def tree(text: Column) -> Column:
    """``array<struct<digest, pieces>>``: one entry for each paragraph."""
    return F.transform(
        F.split(text, "\n", -1),
        lambda p: F.struct(
            _sha(p).alias("digest"),
            F.transform(F.regexp_extract_all(p, F.lit(PIECE), F.lit(0)), _piece_digest).alias("pieces"),
        ),
    )


def _short(digest: Column) -> Column:
    return F.substring(digest, 1, 16)


def _sections(paragraphs: Column) -> Column:
    """Runs of paragraphs, each up to one whose digest ends in 0:
    ``array<struct<digest, below>>`` of a section's digest and its written paragraphs."""

    def closed(p: Column) -> Column:
        mark = F.when(F.endswith(p["digest"], F.lit("0")), ";").otherwise(",")
        return F.concat(p["digest"], F.lit(":"), F.array_join(p["pieces"], ""), mark)

    runs = F.filter(F.split(F.array_join(F.transform(paragraphs, closed), ""), ";", -1), lambda r: r != "")
    split = F.transform(runs, lambda r: F.filter(F.split(r, ",", -1), lambda p: p != ""))
    return F.transform(
        split,
        lambda ps: F.struct(
            _sha(F.array_join(F.transform(ps, lambda p: F.substring(p, 1, 64)), ",")).alias("digest"),
            F.array_join(F.transform(ps, lambda p: F.concat(_short(p), F.substring(p, 65, 1 << 30))), ",").alias("below"),
        ),
    )


def written(paragraphs: Column) -> Column:
    """The fingerprint string of a :func:`tree` column."""
    sections = F.transform(F.array(_sections(paragraphs)), lambda s: F.struct(
        _sha(F.array_join(F.transform(s, lambda x: x["digest"]), ",")).alias("root"),
        F.array_join(F.transform(s, lambda x: F.concat(_short(x["digest"]), F.lit("="), x["below"])), ";").alias("below"),
    ))
    return F.concat(sections[0]["root"], F.lit("|"), sections[0]["below"])


def root(fingerprint: Column) -> Column:
    """The Merkle root in a fingerprint."""
    return F.substring_index(fingerprint, "|", 1)


def _written_sections(fingerprint: Column) -> Column:
    return F.split(F.substring_index(fingerprint, "|", -1), ";", -1)


def _below_sections(sections: Column) -> Column:
    """The written paragraphs of written sections."""
    return F.flatten(F.transform(sections, lambda s: F.split(F.substring(s, 18, 1 << 30), ",", -1)))


def _digest(branch: Column) -> Column:
    return F.substring(branch, 1, 16)


def _leaves(paragraphs: Column) -> Column:
    """The leaves of written paragraphs, five digits each, in one string."""
    return F.array_join(F.transform(paragraphs, lambda p: F.substring(p, 18, 1 << 30)), "")


def _bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.transform(F.array(value), use)[0]


def compare(a: Column, b: Column) -> Column:
    """Likeness of two fingerprints from 0 to 1: 1 for equal roots, else the part of the leaves
    on which the trees agree, of the tree that has more leaves (a repeated paragraph agrees once).

    The leaves under common sections and paragraphs agree; those under the paragraphs that
    one tree alone has agree as far as their distinct digests lie under such paragraphs of
    the other."""

    def lost(x: Column, y: Column) -> Column:
        # branches of one digest are written alike, so sets of written branches do
        return _leaves(F.array_except(_below_sections(F.array_except(x["s"], y["s"])), _below_sections(F.array_except(y["s"], x["s"]))))

    def one(f: Column) -> Column:
        sections = _written_sections(f)
        below = _below_sections(sections)
        return F.struct(sections.alias("s"), F.length(_leaves(F.array_distinct(below))).alias("n"), F.length(_leaves(below)).alias("all"))

    def share(t: Column) -> Column:
        mine, theirs = (F.array_distinct(F.regexp_extract_all(t[x], F.lit("[0-9a-f]{5}"), F.lit(0))) for x in ("la", "lb"))
        return _bound(F.struct(mine.alias("a"), theirs.alias("b"), F.size(F.array_intersect(mine, theirs)).alias("both")), lambda d: agreed(t, d))

    def agreed(t: Column, d: Column) -> Column:
        of = [t[n] - F.length(t[lost_]) * (1 - F.coalesce(F.try_divide(d["both"], F.size(d[x])), F.lit(1.0))) for n, lost_, x in (("na", "la", "a"), ("nb", "lb", "b"))]
        return F.least(*of) / F.greatest(t["all"], F.lit(1))

    trees = F.struct(one(a).alias("a"), one(b).alias("b"))
    lists = _bound(trees, lambda t: F.struct(lost(t["a"], t["b"]).alias("la"), lost(t["b"], t["a"]).alias("lb"), t["a"]["n"].alias("na"), t["b"]["n"].alias("nb"), F.greatest(t["a"]["all"], t["b"]["all"]).alias("all")))
    return F.when(root(a) == root(b), 1.0).otherwise(_bound(lists, share).cast("double"))


def _positions(mine: Column, other: Column) -> Column:
    known = F.transform(other, _digest)
    at = F.transform(mine, lambda x, i: F.when(~F.array_contains(known, _digest(x)), i))
    return F.filter(at, lambda i: i.isNotNull())


def branches(a: Column, b: Column) -> Column:
    """Positions (from 0) of the sections of ``a`` that ``b`` hasn't: where an edit lies."""
    return _positions(_written_sections(a), _written_sections(b))


def paragraphs(a: Column, b: Column) -> Column:
    """Positions (from 0) of the paragraphs of ``a`` that ``b`` hasn't: the lines that were edited."""
    return _positions(_below_sections(_written_sections(a)), _below_sections(_written_sections(b)))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fingerprint)``."""
    return id_and_text(docs, id_col, text_col).select("doc_id", written(tree(F.col("text"))).alias("fingerprint"))


def successors(keys: DataFrame) -> DataFrame:
    """``keys`` (k, h, n; distinct) with the key of the next, the first after the last."""
    ranged = keep(keys.repartitionByRange("k", "h").withColumn("part", F.spark_partition_id()), "merkle-order")
    w = Window.partitionBy("part").orderBy("k", "h")
    inner = ranged.select("*", F.lead(F.struct("k", "h")).over(w).alias("next"))
    firsts = ranged.groupBy("part").agg(F.min(F.struct("k", "h")).alias("first")).orderBy("part").collect()
    if not firsts:
        return inner.select("k", "h", "n", "next.k", "next.h").toDF("k", "h", "n", "next_k", "next_h")
    heads = [(r["first"]["k"], r["first"]["h"]) for r in firsts]  # one row a range partition
    after = [(r["part"], *heads[(i + 1) % len(heads)]) for i, r in enumerate(firsts)]
    after = F.broadcast(keys.sparkSession.createDataFrame(after, "part int, ak long, ah long"))
    return inner.join(after, "part").select(
        "k", "h", "n", F.coalesce("next.k", "ak").alias("next_k"), F.coalesce("next.h", "ah").alias("next_h")
    )


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every text's fingerprint beside that of its edit, whose last quarter of characters
    is replaced by as many (or all) first characters of the next document's text.

    ``(doc_id, n_chars, edited, fingerprint, next_id, next_fingerprint, edited_fingerprint)``

    Both sides of the last join read the same columns of ``rows``, so one shuffle of the
    texts serves both.
    """
    order = F.coalesce("doc_id", F.lit(-(2**63)))
    rows = id_and_text(docs, id_col, text_col).select("doc_id", "text", order.alias("k"), F.xxhash64("text").alias("h"))
    counted = rows.groupBy("k", "h").agg(F.first(F.length("text").cast("long")).alias("n"), F.count("*").alias("times"))
    counted = keep(counted, "merkle-keys")
    if not counted.filter("times > 1").isEmpty():
        rows = rows.dropDuplicates(["k", "h"])
    before = successors(counted.select("k", "h", "n")).select(
        F.col("next_k").alias("k"), F.col("next_h").alias("h"), F.col("k").alias("to_k"), F.col("h").alias("to_h"), F.col("n").alias("to_n")
    )
    told = rows.join(keep(before, "merkle-before"), ["k", "h"])
    own = told.select("k", "h", "doc_id", "text", written(tree(F.col("text"))).alias("fingerprint"))
    sent = told.select(
        F.col("to_k").alias("k"),
        F.col("to_h").alias("h"),
        F.col("doc_id").alias("next_id"),
        F.substring("text", F.lit(1), F.floor(F.col("to_n") / 4).cast("int")).alias("lead"),
        written(tree(F.col("text"))).alias("next_fingerprint"),
    )
    n = F.length("text")
    both = own.join(sent, ["k", "h"]).select(
        "doc_id",
        n.cast("long").alias("n_chars"),
        F.concat(F.substring("text", F.lit(1), n - F.floor(n / 4).cast("int")), "lead").alias("edited"),
        "fingerprint",
        "next_id",
        "next_fingerprint",
    )
    return both.withColumn("edited_fingerprint", written(tree(F.col("edited"))))
