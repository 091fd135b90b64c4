"""Corpus pipeline: ``documents`` to packed training sequences, in five written stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet
under the shared checkpoint folder and read again as the next one's ``docs``, so a lost
executor or driver costs one stage at most.  All but the last return the columns of
``documents``; rows that a stage rejects are gone for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streetflow.llm import bpe, jaccard, langid, packing, pii, toxicity
from streetflow.llm.common import few, fresh, keep, table
from streetflow.llm.queries import pii_key
from streetflow.session import ensure_utc

#: Documents with a toxicity score from here on go.
TOXIC = 0.5

#: Compression, regression, hashing and tokenizers lie outside SQL; the stages are tested against brute force.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, in mixed languages, or whose language is told by a narrow margin, go."""
    found = langid.identify(docs, langid.dictionaries(docs))
    return found.filter(found.columns[-1]).select(docs.columns)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the regression takes for toxic go."""
    scored = toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    return scored.filter(F.col(scored.columns[-1]) < TOXIC).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every component of documents linked by shingle similarity, the one of least id stays.

    Documents without an id stay.  Where ids repeat, every row is a document of its own, and
    of a component's rows of least id one stays.
    """
    repeated = docs.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("times")).filter("times > 1")
    if not repeated.isEmpty():
        return _near_duplicate_rows(docs)
    found = keep(jaccard.jaccard_components(docs), "pipeline-components")
    gone = keep(found.filter("doc_id <> component_id").select("doc_id").distinct(), "pipeline-gone")
    return docs.join(few(gone), "doc_id", "left_anti").select(docs.columns)


def _near_duplicate_rows(docs: DataFrame) -> DataFrame:
    row = fresh("row", docs.columns)
    rows = keep(docs.withColumn(row, F.monotonically_increasing_id()), "pipeline-rows")
    found = jaccard.jaccard_components(rows.filter("doc_id IS NOT NULL"), id_col=row)
    found = keep(found.select(F.col("doc_id").alias(row), "component_id"), "pipeline-components")
    order = F.min_by(row, F.struct("doc_id", row)).alias(row)
    first = rows.join(found, row).groupBy("component_id").agg(order).select(row)
    kept = rows.join(first, row, "left_semi").unionByName(rows.filter("doc_id IS NULL"))
    return kept.select(docs.columns)


def private_values(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal values get pseudonyms of their format."""
    clean = pii.pseudonymize(docs, pii_key(spark)).select(docs.columns)
    n_chars = F.coalesce(F.length("text").cast("long"), "n_chars").alias("n_chars")
    return clean.select(*(n_chars if c == "n_chars" else c for c in docs.columns))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 4096 ids."""
    pieces = packing.pack(docs, bpe.public_path(bpe.WORD_BPE), end_id=2, size=4096)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


STAGES = [
    ("language_id", language_id),
    ("toxicity", toxic),
    ("ngram_jaccard_join", near_duplicates),
    ("pii", private_values),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    ensure_utc(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
