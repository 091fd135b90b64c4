"""N-gram Jaccard join with token-combination prefixes.

A document's tokens are its distinct 5-word shingles.  Documents link when the
Jaccard similarity of their sets is at least 0.75.  Steps, each over all documents:

1. ``(doc_id, n, digest)`` of every document; equal sets become one representative.
2. *Shared-token bound.*  A set of n tokens may miss at most ``n // 4`` of them in
   any partner.  Tokens whose hash falls below a fixed fraction of the hash range
   (the same tokens in every document) are exchanged by hash; a document of whose
   m such tokens fewer than ``m - n // 4`` occur in another document has no partner
   and drops out.  This loses no link.  Tasks combine what they send: a token in two
   sets of one task is sent once, as shared, so a token in a third of all documents
   costs one entry a task.
3. *Prefixes.*  The rest get exact token frequencies and a global order, rare tokens
   first.  Rare tokens are indexed singly.  Frequent tokens are dealt into classes by
   hash and indexed as pairs within a class: a class with x prefix tokens needs x - 1
   misses before every pair is broken.  The prefix is extended until singles and
   classes together outlast ``n // 4`` misses, so two linked documents share an index
   entry.  (Class counts follow the size level of the sets; a document also takes part
   in the level above if a partner may lie there.)  A set too small to extend that far
   is indexed in a second family by the usual single-token prefix, for others like it.
4. *Verification by leaders.*  In every index group, one member (then 16, then 256, ...) is
   compared exactly with those members of other components that the sizes and the
   numbers of shared tokens allow, until the group is one component or all its members
   have led.  A round's links join components, and only these joints are looked at.  Groups of near copies thus take links in
   proportion to their size, not its square, and no connection is lost.

The result is exact up to 64-bit hashing of shingles.

Defined cases: null or empty text, or one without words, has no shingles and links
with nothing; texts of fewer than five words have one shingle, the whole sequence;
rows that repeat a document id count as one document for components (the union of
their links) and come back row by row; a null id has a null component; an empty
table gives no rows; columns other than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from streetflow.llm.common import few, id_and_text, keep, slices
from streetflow.llm.components import components
from streetflow.llm.shingles import U, digests, shingle_sets

#: Of the hash range, the part whose tokens take part in the shared-token bound.
EXCHANGED = 3 / 8
#: Token entries that a task combines at once, and entries that a bucket should get.
TASK_ENTRIES, BUCKET_ENTRIES, LEAST_BUCKETS = 1_000_000, 1_000_000, 256
#: Documents above which a token is frequent, i.e. indexed in pairs.
FREQUENT = 32
SLICE_BYTES = 2 << 20

DOCS = "doc_id long, n int, m int, d1 long, d2 long"
SENT = "bucket int, tokens binary, sets binary, counted binary, counts binary"


def may_miss(n):
    """Most tokens of a set of ``n`` that a linked set may lack: 100 I >= 75 U gives I >= 3n/4."""
    return n // 4


def _limit() -> np.uint64:
    return U(int(EXCHANGED * 2**64))


def document_sets(docs: DataFrame) -> DataFrame:
    """Size, tokens in the exchanged range, and digest of every document's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                sets = list(shingle_sets(part.column(1)))
                d1, d2 = digests(sets)
                n = np.fromiter(map(len, sets), np.int32, len(sets))
                m = np.fromiter((np.searchsorted(s, _limit()) for s in sets), np.int32, len(sets))
                yield pa.RecordBatch.from_arrays([part.column(0), *map(pa.array, (n, m, d1, d2))], names=["doc_id", "n", "m", "d1", "d2"])

    return docs.mapInArrow(run, DOCS)


def _by_bucket(bucket: np.ndarray, n: int, *columns: np.ndarray) -> Iterator[tuple[int, list[bytes]]]:
    order = np.argsort(bucket, kind="stable")
    edge = np.searchsorted(bucket[order], np.arange(n + 1))
    columns = [c[order] for c in columns]
    for b in range(n):
        if edge[b] < edge[b + 1]:
            yield b, [c[edge[b] : edge[b + 1]].tobytes() for c in columns]


def _combined(tokens: np.ndarray, owners: np.ndarray, n_buckets: int) -> pa.RecordBatch:
    """What a task sends of its (token, set) entries: tokens of one set here, with it;
    tokens of several sets once, with owner 0; and how many of the latter each set has."""
    order = np.lexsort((owners, tokens))
    tokens, owners = tokens[order], owners[order]
    fresh = np.append(True, (tokens[1:] != tokens[:-1]) | (owners[1:] != owners[:-1]))
    tokens, owners = tokens[fresh], owners[fresh]
    first = np.append(True, tokens[1:] != tokens[:-1])
    size = np.diff(np.append(np.flatnonzero(first), len(tokens)))
    shared = np.repeat(size > 1, size)
    sets, counts = np.unique(owners[shared], return_counts=True)
    send = first | ~shared
    tokens, owners = tokens[send], np.where(shared[send], U(0), owners[send])
    rows: dict[int, list[bytes]] = {}
    for b, got in _by_bucket((tokens >> U(8)) % U(n_buckets), n_buckets, ((tokens >> U(24)) & U(0xFFFFFFFF)).astype("<u4"), owners):
        rows[b] = [*got, b"", b""]
    for b, got in _by_bucket(sets % U(n_buckets), n_buckets, sets, counts.astype("<i8")):
        rows.setdefault(b, [b"", b"", b"", b""])[2:] = got
    cols = list(zip(*rows.values(), strict=True))
    return pa.RecordBatch.from_arrays([pa.array(list(rows), pa.int32()), *(pa.array(c, pa.binary()) for c in cols)], names=[f.split()[0] for f in SENT.split(", ")])


def send_tokens(docs: DataFrame, n_buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, owners, held = [], [], 0
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                sets = list(shingle_sets(part.column(0)))
                d1, _ = digests(sets)
                cut = [s[: np.searchsorted(s, _limit())] for s in sets]
                sizes = np.fromiter(map(len, cut), np.int64, len(cut))
                tokens += cut
                owners.append(np.repeat(d1.view(U), sizes))
                held += int(sizes.sum())
                if held >= TASK_ENTRIES:
                    yield _combined(np.concatenate(tokens), np.concatenate(owners), n_buckets)
                    tokens, owners, held = [], [], 0
        if held:
            yield _combined(np.concatenate(tokens), np.concatenate(owners), n_buckets)

    return docs.select("text").mapInArrow(run, SENT)


def _count_shared(table: pa.Table) -> pa.Table:
    """One bucket: how many of each set's tokens occur in another set too."""

    def joined(name: str, kind: str) -> np.ndarray:
        return np.concatenate([np.frombuffer(b, kind) for b in table.column(name).to_pylist()] or [np.zeros(0, kind)])

    tokens, owners = joined("tokens", "<u4"), joined("sets", "<u8")
    order = np.lexsort((owners, tokens))
    tokens, owners = tokens[order], owners[order]
    fresh = np.append(True, (tokens[1:] != tokens[:-1]) | (owners[1:] != owners[:-1]))[: len(tokens)]
    tokens, owners = tokens[fresh], owners[fresh]
    at = np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1])[: len(tokens)])
    size = np.diff(np.append(at, len(tokens)))
    marked = owners[at] == 0 if len(at) else np.zeros(0, bool)  # 0 sorts first
    keep_ = np.repeat((size > 1) | marked, size) & (owners != 0)
    sets = np.concatenate([owners[keep_], joined("counted", "<u8")])
    counts = np.concatenate([np.ones(int(keep_.sum()), np.int64), joined("counts", "<i8")])
    found, where = np.unique(sets, return_inverse=True)
    total = np.bincount(where, counts, len(found)).astype(np.int64)
    return pa.table({"d1": pa.array(found.astype("<u8").view(np.int64)), "shared": pa.array(total)})


def with_possible_partners(docs: DataFrame, reps: DataFrame) -> DataFrame:
    """The representatives that pass the shared-token bound."""
    total = reps.agg(F.sum("m")).first()[0] or 0
    n_buckets = max(LEAST_BUCKETS, total // BUCKET_ENTRIES)
    shared = (
        send_tokens(docs, n_buckets)
        .groupBy("bucket")
        .applyInArrow(_count_shared, "d1 long, shared long")
        .groupBy("d1")
        .agg(F.sum("shared").alias("shared"))
    )
    enough = F.coalesce("shared", F.lit(0)) >= F.col("m") - F.expr("n div 4")
    return reps.join(shared, "d1", "left").filter(enough).select("doc_id", "d1")


def token_lists(docs: DataFrame) -> DataFrame:
    """``(key, n, tokens)`` of the texts whose digest is ``d1``, by that digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                sets = list(shingle_sets(part.column(0)))
                own, _ = digests(sets)
                sizes = np.fromiter(map(len, sets), np.int32, len(sets))
                flat = np.concatenate(sets).view(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32)), pa.array(flat))
                same = pa.array(own == part.column(1).to_numpy(zero_copy_only=False))
                made = pa.RecordBatch.from_arrays([pa.array(own), pa.array(sizes), lists], names=["key", "n", "tokens"])
                yield made.filter(same)

    return docs.select("text", "d1").mapInArrow(run, "key long, n int, tokens array<long>")


def _key(kind: int, level: int, *tokens: int) -> int:
    """One index entry as a 64-bit number."""
    x = kind * 64 + level
    for t in tokens:
        x = (x * 0x9E3779B97F4A7C15 + (t & (2**64 - 1)) + 1) & (2**64 - 1)
        x ^= x >> 29
        x = (x * 0xBF58476D1CE4E5B9) & (2**64 - 1)
        x ^= x >> 32
    return x - 2**64 if x >= 2**63 else x


SINGLE, PAIR, FALLBACK = 1, 2, 3


def index_entries(n: int, ranked: list[tuple[int, int]]) -> dict[int, int]:
    """Index entries of one set of ``n`` tokens, of which ``ranked`` are those that other
    sets have too, as (documents, token) in the global order; the others come before them.

    With each entry comes the most tokens that the set can share with one that it meets
    there only: all of ``ranked`` for a single token; the frequent ones for the rest, as
    sets that share a rare token meet in its own entry too."""
    need = may_miss(n) - (n - len(ranked)) + 1
    if need <= 0:
        return {}  # more tokens of its own than a partner may lack
    rare = next((i for i, (f, _) in enumerate(ranked) if f > FREQUENT), len(ranked))
    keys = {_key(SINGLE, 0, t): len(ranked) for _, t in ranked[: min(need, rare)]}
    if need <= rare:
        return keys
    need, often = need - rare, [t for _, t in ranked[rare:]]
    level = n.bit_length()
    levels = [level, level + 1] if (4 * n // 3).bit_length() > level else [level]
    for at in levels:
        n_classes, left, members = max(1, 2**at // 8), need, {}
        for t in often:
            mine = members.setdefault((t & (2**64 - 1)) % n_classes, [])
            left -= bool(mine)
            mine.append(t)
            if not left:
                break
        for mine in members.values():
            keys |= {_key(PAIR, at, *p): len(often) for p in combinations(mine, 2)}
        if left:
            keys |= {_key(FALLBACK, 0, t): len(often) for t in often[:need]}
    return keys


def index(lists: DataFrame) -> DataFrame:
    """``(entry, key, n, s)``: the index entries of all sets in ``lists``; ``s``: tokens that a set met there may share."""
    tokens = lists.select("key", F.explode("tokens").alias("t"))
    shared = tokens.groupBy("t").agg(F.count("*").alias("f")).filter("f > 1")
    ranked = (
        tokens.join(shared, "t")
        .groupBy("key")  # a group is one document's own tokens
        .agg(F.collect_list(F.struct("f", "t")).alias("ranked"))
    )
    sized = ranked.join(lists.select("key", "n"), "key").select("key", "n", "ranked.f", "ranked.t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, size, shared, out = [], [], [], []
            for key, n, fs, ts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                entries = index_entries(n, sorted(set(zip(fs, ts, strict=True))))
                out += entries.keys()
                shared += entries.values()
                owner += [key] * len(entries)
                size += [n] * len(entries)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out, pa.int64()), pa.array(owner, pa.int64()), pa.array(size, pa.int32()), pa.array(shared, pa.int32())],
                names=["entry", "key", "n", "s"],
            )

    return sized.mapInArrow(run, "entry long, key long, n int, s int")


def linked(pairs: DataFrame, lists: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` of keys whose sets have a Jaccard similarity of 0.75 or more.

    Each side of the pairs meets its sets alone, so while the pairs are few enough to
    broadcast, only the sets that they name are shuffled."""
    pairs = few(keep(pairs, "jaccard-pairs"))
    left = lists.withColumnsRenamed({"key": "a", "n": "na", "tokens": "ta"}).join(pairs, "a")
    right = lists.withColumnsRenamed({"key": "b", "n": "nb", "tokens": "tb"}).join(pairs, "b")
    both = left.join(right, ["a", "b"]).withColumn("i", F.size(F.array_intersect("ta", "tb")))
    return both.filter("100 * i >= 75 * (na + nb - i)").select("a", "b")


def _leaders(members: DataFrame, count: int, turn: int) -> DataFrame:
    """``count`` members of each index group: at first the one with the fewest tokens of its
    own, then those of the components with the fewest members there, by a hash of their keys."""
    drawn = F.xxhash64("key", F.lit(turn))
    if turn == 0:
        central = F.struct((F.col("n") - F.col("s")).alias("own"), drawn.alias("drawn"))
        one = members.groupBy("entry").agg(F.min_by(F.struct("key", "n", "s", "c"), central).alias("l")).select("entry", "l.*")
    else:
        sizes = members.groupBy("entry", "c").agg(F.count("*").alias("size"))
        rank = F.row_number().over(Window.partitionBy("entry").orderBy("size", drawn, "key"))
        one = members.join(sizes, ["entry", "c"]).withColumn("rank", rank).filter(F.col("rank") <= count)
    return one.select("entry", *(F.col(c).alias(f"lead_{c}") for c in ("key", "n", "s", "c")))


#: Sets that can share s and s' tokens share the lesser number at most; 0.75 needs 3/7 of both sizes.
MAY_LINK = "c <> lead_c AND 175 * least(s, lead_s) >= 75 * (n + lead_n)"


#: Leaders of a group in the first round, and how many times more in each further one.
FIRST_LEADERS, MORE_LEADERS = 1, 16


def components_by_leaders(entries: DataFrame, lists: DataFrame) -> DataFrame:
    """``(v, m)``: components of the linked sets among the index groups.

    ``c`` names the component of a member as far as it is known.  The links of a round join
    names, and only these joints are made into components, not all links anew.  A member
    that has led was compared with all the others of its group and leaves it; a group whose
    members bear one name is done.
    """
    entries = keep(entries, "jaccard-entries")
    several = entries.groupBy("entry").agg(F.count("*").alias("size")).filter("size > 1").select("entry")
    members = keep(entries.join(several, "entry").withColumn("c", F.col("key")), "jaccard-groups")
    names = members.sparkSession.createDataFrame([], "v long, m long")
    count, turn = FIRST_LEADERS, 0
    while not members.isEmpty():
        lead = keep(_leaders(members, count, turn), "jaccard-leaders")
        pairs = (
            members.join(few(lead), "entry")
            .filter(MAY_LINK)
            .select(F.least("key", "lead_key").alias("a"), F.greatest("key", "lead_key").alias("b"))
            .distinct()
        )
        names = keep(_names(names, linked(pairs, lists)), "jaccard-names")
        led = few(lead.select("entry", F.col("lead_key").alias("key")))
        rest = members.drop("c").join(led, ["entry", "key"], "left_anti").join(few(names), F.col("key") == F.col("v"), "left")
        members = keep(rest.select("entry", "key", "n", "s", F.coalesce("m", "key").alias("c")), "jaccard-members")
        undone = members.groupBy("entry").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo <> hi").select("entry")
        members = keep(members.join(undone, "entry"), "jaccard-groups")
        count, turn = count * MORE_LEADERS, turn + 1
    return names


def _names(names: DataFrame, links: DataFrame) -> DataFrame:
    """``(v, m)``: sets with the least set of their component, but for these least ones
    themselves, once more links are known."""
    one, two = (names.toDF(x, f"m{x}") for x in ("a", "b"))
    joints = links.join(one, "a", "left").join(two, "b", "left").select(F.coalesce("ma", "a").alias("a"), F.coalesce("mb", "b").alias("b"))
    joined = few(components(joints, "jaccard"))
    renamed = names.join(joined.toDF("m", "_m"), "m", "left").select("v", F.coalesce("_m", "m").alias("m"))
    return renamed.union(joined)


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` of every row of ``docs``."""
    docs = id_and_text(docs, id_col, text_col)
    sets = keep(document_sets(docs), "jaccard-sets")
    known = sets.filter("doc_id IS NOT NULL AND n > 0")
    reps = keep(known.groupBy("d1", "d2", "n", "m").agg(F.min("doc_id").alias("doc_id")), "jaccard-distinct")
    possible = keep(with_possible_partners(docs, reps), "jaccard-possible")
    lists = keep(token_lists(docs.join(few(possible), "doc_id")), "jaccard-tokens")
    found = components_by_leaders(index(lists), lists)
    # rows that repeat a document id: their sets belong together
    repeated = known.groupBy("doc_id").agg(F.min("d1").alias("a"), F.max("d1").alias("b")).filter("a <> b").select("doc_id", "a")
    if not repeated.isEmpty():
        again = known.join(repeated, "doc_id").select("a", F.col("d1").alias("b")).filter("a <> b")
        found = components(again.union(found), "jaccard")
    # the smallest document of each component, for the sets that have links
    joined = reps.select("d1", "doc_id").join(found, F.col("d1") == F.col("v"), "left").select("d1", "doc_id", F.coalesce("m", "d1").alias("m"))
    least = joined.groupBy("m").agg(F.min("doc_id").alias("component_id"))
    classes = joined.join(least, "m").select("d1", "component_id")
    out = sets.join(classes, "d1", "left").select("doc_id", F.col("n").cast("long").alias("n_shingles"), "n", "component_id")
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), own).alias("component_id"))
