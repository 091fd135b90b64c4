"""The registered queries of this package: thin forms of the operators.

Each takes (spark, sf_dir) and returns its contract's columns, taken from the
operator's own output.
"""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streetflow.llm import bpe, bpe_trie, jaccard, langid, lattice, lexical, merkle, multi_index, negatives, packing, pii, token_counts, token_store, toxicity
from streetflow.llm.common import crc32_mod, table
from streetflow.session import ensure_utc, work_dir

log = logging.getLogger(__name__)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Most tokens of a document before ``over_limit``.
TOKEN_LIMIT = 2048


def pii_key(spark: SparkSession) -> bytes:
    """The key of the pseudonyms, a secret of the deployment; ``spark.streetflow.pii.key`` must
    be set for data of one's own.  Unset, a public key serves the synthetic tables of tests,
    with a warning, as its pseudonyms can be undone by anyone."""
    key = spark.conf.get("spark.streetflow.pii.key", None)
    if key is None:
        log.warning("spark.streetflow.pii.key is not set: pseudonyms use a public key and hide nothing")
        key = "a key for tests"
    return key.encode()


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_utc(spark)
        return fn(spark, sf_dir)

    run.__doc__ = fn.__doc__
    QUERIES[fn.__name__] = run
    return fn


@query
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by compression against per-language dictionaries."""
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs.select("doc_id", "text"), langid.dictionaries(docs))
    return found.select("doc_id", (crc32_mod(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score", "accepted")


@query
def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 5-word shingle sets have a Jaccard similarity of 0.75 or more."""
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


@query
def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, written as range-coded files and read back."""
    path = work_dir(spark, "token-files")
    token_store.write(table(spark, sf_dir, "documents"), path, bpe.public_path(bpe.BYTE_BPE), end_id=2)
    return token_store.read(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document by FTRL-proximal logistic regression."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model)
    held_out = (crc32_mod(F.col("doc_id"), 5) == 0).alias("held_out")
    return scored.select("doc_id", held_out, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op5_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle fingerprints of every document and of its edit, with their likeness."""
    made = merkle.edited_fingerprints(table(spark, sf_dir, "documents"))
    return made.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        merkle.compare(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        merkle.compare(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
        "next_id",
    )


@query
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document under ``word_bpe_49k``, by the two-tier lookup."""
    counts = token_counts.token_counts(table(spark, sf_dir, "documents"), bpe.public_path(bpe.WORD_BPE))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


@query
def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text with personal values replaced by pseudonyms."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymize(docs, pii_key(spark))


@query
def op8_lattice_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of embeddings with a cosine of 0.95 or more, by E8 lattice hashing."""
    return lattice.near_duplicates(table(spark, sf_dir, "embeddings"), 0.95)


@query
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 4096 ids, by concatenating and cutting."""
    pieces = packing.pack(table(spark, sf_dir, "documents"), bpe.public_path(bpe.WORD_BPE), end_id=2, size=4096)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoding by trie traversal and decoding, as digests."""
    coded = bpe_trie.encode_decode(table(spark, sf_dir, "documents"), bpe.public_path(bpe.WORD_BPE))
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item, by norm buckets over impact vectors."""
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 10)


ORACLES["op11_lexical_search"] = r"""
WITH d AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
q AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
sizes AS (SELECT doc_id, COUNT(*) AS n FROM d GROUP BY doc_id),
total AS (SELECT COUNT(*) AS docs, CAST(SUM(n) AS BIGINT) AS terms FROM sizes),
tf AS (SELECT doc_id, term, COUNT(*) AS tf FROM d WHERE term IN (SELECT term FROM q) GROUP BY doc_id, term),
w AS (SELECT term, CAST(floor(1000 * ln((2.0 * (SELECT docs FROM total) + 2) / (2 * COUNT(*) + 1)::DOUBLE)) AS BIGINT) AS w FROM tf GROUP BY term),
impact AS (
  SELECT tf.doc_id, tf.term, w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * (25 + (75 * s.n * t.docs) // t.terms))) AS x
  FROM tf JOIN w ON tf.term = w.term JOIN sizes s ON tf.doc_id = s.doc_id CROSS JOIN total t),
scored AS (
  SELECT q.item_id, i.doc_id, CAST(SUM(i.x) AS BIGINT) AS score
  FROM q JOIN impact i ON q.term = i.term GROUP BY q.item_id, i.doc_id),
ranked AS (
  SELECT item_id, CAST(ROW_NUMBER() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
  FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""


@query
def op12_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest embeddings found of every hundredth one, by an inverted multi-index."""
    return multi_index.search(table(spark, sf_dir, "embeddings"), "vec_id % 100 = 0", 10)


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives for the positives of every fiftieth embedding, by the threshold algorithm."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf_dir, "embeddings"), "vec_id % 50 = 0", label)


ORACLES["op13_hard_negatives"] = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS vec_id, a.label = b.label AS same, CAST(list_dot_product(a.x, b.x) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x) WHERE a.vec_id % 50 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY ROW_NUMBER() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (
  SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score,
         CAST(ROW_NUMBER() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""
