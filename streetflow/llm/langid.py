"""Language identification by compression against per-language dictionaries.

For each language, up to ``SAMPLE_DOCS`` labelled training documents (the least by a
hash of their ids) give ``SAMPLE_CHARS`` characters each; joined, they are a
zstandard raw-content dictionary.  A whole text is compressed against every
dictionary, in pieces of ``PIECE`` bytes, so that dictionaries count to its end; the
smallest sum of sizes names the language, a language's share of the labelled
documents counting as bits of its own.  (Texts are brought to words in lower case
before, so capitals and rows of symbols don't hide the words.)  The score is the best
language's probability when every bit saved doubles the odds.

A document is *accepted* unless it has no letter, its margin is narrow, or it is
mixed; all are judged by sizes alone, relative to the language's own, whatever the
text's length and the languages' shares.  The margin is what the next language takes
more (with one language only: what the text takes without a dictionary); below
``MIN_MARGIN`` it is narrow.  A text is mixed if choosing the best language for each
piece would save more than ``MAX_MIXED``.

Defined cases: a null text, or one without a letter, is ``und`` with score 0 and not
accepted; ties go to the first language in ascending order; without any labelled
text every document is ``und``; null languages are not learned; rows come back one
by one with all their columns (an output column that clashes gets ``_`` in front);
an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from streetflow.llm.common import column, crc32_mod, fresh, fresh_key, held, slices

UNDETERMINED = "und"
#: Bounds of the training sample for each language: documents, and characters of each.
SAMPLE_DOCS, SAMPLE_CHARS = 128, 1024
LEVEL = 9
#: Bytes of text compressed at once, and that a task turns into Python objects at once.
PIECE, SLICE_BYTES = 1024, 4 << 20
#: Limits of accepted texts as parts of their size; of training rows, 96 to 99 in 100 stay.
MIN_MARGIN, MAX_MIXED = 0.06, 0.05

#: ASCII other than letters parts words.
_WORDS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def words_only(text: str) -> bytes:
    return b" ".join(text.lower().encode().translate(_WORDS).split())


def dictionaries(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> dict[str, tuple[bytes, float]]:
    """Each language's raw-content dictionary and its share, from the documents whose crc32(id) mod 4 isn't 2."""
    rows = docs.select(
        column(id_col).cast("string").alias("id"), column(text_col).alias("text"), column(lang_col).cast("string").alias("lang")
    ).filter((crc32_mod(F.col("id"), 4) != 2) & F.col("lang").isNotNull() & F.length("text").cast("boolean"))
    counts = rows.groupBy("lang").agg(F.count("*").alias("n"))
    unit = F.shiftrightunsigned(F.xxhash64("id"), 11) / F.lit(float(1 << 53))
    share = {r["lang"]: r["n"] for r in counts.collect()}  # one row a language
    if not share:
        return {}
    size = F.create_map(*(F.lit(x) for pair in share.items() for x in pair))[F.col("lang")]
    near = rows.select("lang", F.substring("text", 1, SAMPLE_CHARS).alias("text"), "id", unit.alias("u"))
    near = near.filter(F.col("u") * size < 4 * SAMPLE_DOCS)  # about four times what is kept
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("u", "id", "text"))
    kept = near.withColumn("r", rank).filter(F.col("r") <= SAMPLE_DOCS).orderBy("lang", "r").select("lang", "text").collect()
    out: dict[str, list[str]] = {}
    for r in kept:  # at most SAMPLE_DOCS * SAMPLE_CHARS characters a language
        out.setdefault(r["lang"], []).append(r["text"])
    total = sum(share.values())
    return {lang: (b" ".join(map(words_only, texts)), share[lang] / total) for lang, texts in out.items()}


class Sizes:
    """Compressed sizes of texts under each dictionary."""

    def __init__(self, dicts: dict[str, tuple[bytes, float]]):
        import zstandard as z

        self.langs = sorted(dicts)
        self.own_bits = [-math.log2(dicts[lang][1]) for lang in self.langs]
        self.compressors = []
        for lang in self.langs:
            d = z.ZstdCompressionDict(dicts[lang][0], dict_type=z.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            self.compressors.append(z.ZstdCompressor(dict_data=d, write_content_size=False))
        #: The rival of a language that has no other.
        self.plain = z.ZstdCompressor(level=LEVEL, write_content_size=False)

    def classify(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score, accepted)."""
        if not text or not self.langs or not has_letter(text):
            return UNDETERMINED, 0.0, False
        data = words_only(text)
        pieces = [data[i : i + PIECE] for i in range(0, len(data), PIECE)]
        sizes = [[len(c.compress(p)) for p in pieces] for c in self.compressors]
        total = [sum(s) for s in sizes]
        bits = [8 * t + own for t, own in zip(total, self.own_bits, strict=True)]
        best = min(bits)
        score = 1.0 / sum(2.0 ** -min(60.0, b - best) for b in bits)
        at = bits.index(best)
        rivals = total[:at] + total[at + 1 :] or [sum(len(self.plain.compress(p)) for p in pieces)]
        margin = min(rivals) - total[at]
        mixed = total[at] - sum(map(min, zip(*sizes, strict=True)))
        return self.langs[at], score, margin >= MIN_MARGIN * total[at] and mixed <= MAX_MIXED * total[at]


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text[:64])) or any(map(str.isalpha, text[64:]))


def identify(
    docs: DataFrame, dicts: dict[str, tuple[bytes, float]], text_col: str = "text", names: tuple[str, str, str] = ("lang_pred", "score", "accepted")
) -> DataFrame:
    """``docs`` with the predicted language, its score, and whether it is accepted."""
    shared = docs.sparkSession.sparkContext.broadcast(dicts)  # languages * SAMPLE_DOCS * SAMPLE_CHARS at most
    at, taken = docs.columns.index(text_col), list(docs.columns)
    fields = []
    for name, kind in zip(names, (StringType(), DoubleType(), BooleanType()), strict=True):
        fields.append(StructField(fresh(name, taken), kind))
        taken.append(fields[-1].name)

    key = fresh_key()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = held("langid", key, lambda: Sizes(shared.value))
        for batch in (part for whole in batches for part in slices(whole, text_col, SLICE_BYTES)):
            found = [sizes.classify(t) for t in batch.column(at).to_pylist()]
            more = [pa.array([f[i] for f in found], k) for i, k in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, *(f.name for f in fields)])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, *fields]))
