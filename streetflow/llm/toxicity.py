"""Toxicity: logistic regression by FTRL-proximal over hashed word n-grams and skip-grams.

Features of a text are its distinct words, word stems (the first ``STEM`` bytes), pairs
of neighbouring words and pairs with one word between them, hashed to ``2 ** BITS``
coordinates.  Words are runs of
letters, digits and non-ASCII characters, A-Z lower-cased.  Training takes at most
``TRAIN_ROWS`` labelled rows (the least by a hash of their ids), dealt to tasks of
about ``SHARD_ROWS``; each runs FTRL-proximal over its rows (a learning rate for every coordinate,
L1 that leaves most weights zero), and the shards' weights are averaged.  Only the
non-zero weights are broadcast.  A text's score is the logistic function of the sum
of its features' weights.

Defined cases: a null or empty text has no features, its score is that of the bias;
a label that is null is not learned, of several labels of one id the highest counts;
without labels the score is 0.5 throughout; rows come back one by one with all their
columns (an output column that clashes gets ``_`` in front); an empty table gives no
rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from streetflow.llm.common import column, crc32_mod, fresh, fresh_key, held, slices, string_bytes
from streetflow.llm.shingles import U, mix, series, word_hashes

BITS = 20
#: Most labelled rows that are learned from, and about how many a task gets.
TRAIN_ROWS, SHARD_ROWS = 16_000, 8_000
EPOCHS = 5
ALPHA, BETA, L1, L2 = 2.0, 1.0, 10.0, 0.1
STEM = 4
SLICE_BYTES = 2 << 20

#: Bytes that part words: ASCII other than letters and digits.
_PARTS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_PAIR, _SKIP, _STEM, _FIRST = series(53, 2), series(59, 2), series(61, 1), U(64 - BITS)


def feature_runs(arr: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each of words, stems, pairs and skip-pairs: (coordinates, row of each)."""
    data, offsets = string_bytes(arr)
    words, first = word_hashes(data, offsets, _PARTS)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    with np.errstate(over="ignore"):
        yield mix(word_hashes(data, offsets, _PARTS, STEM)[0] * _STEM[0]) >> _FIRST, row
        yield mix(words) >> _FIRST, row
        for gap, by in ((1, _PAIR), (2, _SKIP)):
            if len(words) > gap:
                same = row[:-gap] == row[gap:]
                yield (mix(words[:-gap] * by[0] + words[gap:] * by[1]) >> _FIRST)[same], row[:-gap][same]


def feature_sets(arr: pa.Array) -> list[np.ndarray]:
    """The distinct coordinates of each text."""
    runs = list(feature_runs(arr))
    index, row = (np.concatenate(x) for x in zip(*runs, strict=True))
    key = np.unique((row.astype(U) << U(BITS)) | index.astype(U))
    edge = np.searchsorted(key >> U(BITS), np.arange(len(arr) + 1).astype(U))
    index = (key & U((1 << BITS) - 1)).astype(np.int32)
    return [index[a:b] for a, b in zip(edge[:-1], edge[1:], strict=True)]


class Ftrl:
    """FTRL-proximal with one learning rate for each coordinate; the bias is coordinate ``2 ** BITS``."""

    def __init__(self):
        self.z, self.n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        l1 = np.where(np.asarray(at) == 1 << BITS, 0.0, L1)
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, at: np.ndarray, label: int) -> None:
        w = self.weights(at)
        g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        rate = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / ALPHA
        self.z[at] += g - rate * w
        self.n[at] += g * g


def _train(table: pa.Table) -> pa.Table:
    """One shard: its rows in a fixed order, ``EPOCHS`` times."""
    table = table.sort_by([("u", "ascending"), ("text", "ascending")])
    labels = table.column("label").to_pylist()
    sets = []
    for batch in table.select(["text"]).to_batches():
        for part in slices(batch, "text", SLICE_BYTES):
            sets += [np.append(x, np.int32(1 << BITS)) for x in feature_sets(part.column(0))]
    model = Ftrl()
    for epoch in range(EPOCHS):
        for i in np.random.default_rng(epoch).permutation(len(sets)):
            model.learn(sets[i], labels[i])
    w = model.weights(np.arange((1 << BITS) + 1))
    at = np.flatnonzero(w)
    return pa.table({"at": pa.array(at, pa.int64()), "w": pa.array(w[at])})


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic"
) -> tuple[np.ndarray, np.ndarray]:
    """(coordinates, weights), learned from labelled ids whose crc32 mod 5 isn't 0."""
    known = labels.select(column(id_col).alias("id"), column(label_col).cast("int").alias("label"))
    known = known.filter((crc32_mod(F.col("id"), 5) != 0) & F.col("id").isNotNull() & F.col("label").isNotNull())
    known = known.groupBy("id").agg(F.max("label").alias("label"))
    unit = F.shiftrightunsigned(F.xxhash64("id"), 11) / F.lit(float(1 << 53))
    n = known.count()
    sample = known.withColumn("u", unit).filter(F.col("u") * max(n, 1) < 1.5 * TRAIN_ROWS).orderBy("u").limit(TRAIN_ROWS)
    texts = docs.select(column(id_col).alias("id"), F.coalesce(column(text_col), F.lit("")).alias("text"))
    rows = texts.join(F.broadcast(sample), "id")  # TRAIN_ROWS rows of three numbers at most
    shards = max(1, -(-min(n, TRAIN_ROWS) // SHARD_ROWS))
    shard = F.pmod(F.xxhash64("id", F.lit("shard")), F.lit(shards))
    learned = rows.select("u", "text", "label", shard.alias("shard")).groupBy("shard").applyInArrow(_train, "at long, w double")
    weights = learned.groupBy("at").agg((F.sum("w") / shards).alias("w")).orderBy("at").toPandas()
    return weights["at"].to_numpy(np.int64), weights["w"].to_numpy(np.float64)


def _dense(model: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    dense = np.zeros((1 << BITS) + 1)
    dense[model[0]] = model[1]
    return dense


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with a toxicity score from 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # non-zero weights: 2 ** BITS at most
    at = docs.columns.index(text_col)
    field = StructField(fresh(name, docs.columns), DoubleType())

    key = fresh_key()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = held("toxicity", key, lambda: _dense(shared.value))
        for batch in batches:
            for part in slices(batch, text_col, SLICE_BYTES):
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(_scores(part.column(at), dense))], names=[*part.schema.names, field.name])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, field]))


def _scores(arr: pa.Array, dense: np.ndarray) -> np.ndarray:
    import pyarrow.compute as pc

    keys = []
    for index, row in feature_runs(pc.fill_null(arr, "")):
        hit = np.flatnonzero(dense[index])
        keys.append((row[hit].astype(U) << U(BITS)) | index[hit])
    key = np.unique(np.concatenate(keys))
    total = np.bincount((key >> U(BITS)).astype(np.int64), dense[(key & U((1 << BITS) - 1)).astype(np.int64)], len(arr))
    return 1.0 / (1.0 + np.exp(-np.clip(total + dense[1 << BITS], -35, 35)))
