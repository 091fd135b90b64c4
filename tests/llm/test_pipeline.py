"""The pipeline against its stages done by hand, and its stages' rules."""

import zlib

import numpy as np

import corpus_pipeline as cp
from streetflow.llm import bpe, langid, pii, queries, toxicity
from streetflow.llm.common import table
from tests.llm import brute
from tests.llm.conftest import SMALL
from tests.llm.test_tokens import check_pieces, library_ids


def test_stages():
    assert [n for n, _ in cp.STAGES] == ["language_id", "toxicity", "ngram_jaccard_join", "pii", "packing"]
    assert cp.ORACLE_SQL is None


def test_run_is_the_stages_by_hand(spark):
    docs = table(spark, SMALL, "documents")
    texts = dict(brute.rows(SMALL, "SELECT doc_id, text FROM documents"))
    sizes = langid.Sizes(langid.dictionaries(docs))
    kept = {d: t for d, t in texts.items() if sizes.classify(t)[2]}
    frame = spark.createDataFrame(sorted(kept.items()), "doc_id long, text string")
    scores = {r.doc_id: r.score for r in toxicity.score(frame, toxicity.train(frame, table(spark, SMALL, "labels"))).collect()}
    kept = {d: t for d, t in kept.items() if scores[d] < 0.5}
    comps = brute.jaccard(sorted(kept.items()))
    kept = {d: t for d, t in kept.items() if comps[d][1] == d}
    names = pii.Pseudonyms(queries.pii_key(spark))
    kept = {d: names.text(t)[0] for d, t in kept.items()}
    want = {d: np.array([*library_ids(bpe.public_path(bpe.WORD_BPE), t), 2], "<u4") for d, t in kept.items()}

    pieces = cp.run(spark, SMALL).collect()
    assert {r.doc_id for r in pieces} == set(want)
    for r in pieces:
        assert r.ids_crc32 == zlib.crc32(want[r.doc_id][r.start : r.start + r.length].tobytes())
    got = [(r.doc_id, r.start, r.length, r.doc_tokens, r.sequence_id, r.offset, want[r.doc_id][r.start : r.start + r.length].tolist()) for r in pieces]
    check_pieces(got, [w.tolist() for w in want.values()], 4096)


def test_stages_keep_columns_and_take_odd_rows(spark, odd, none):
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, odd, SMALL)
        assert out.columns == odd.columns and out.dtypes == odd.dtypes, name
        assert stage(spark, none, SMALL).count() == 0
    assert cp.packed(spark, none, SMALL).count() == 0
    stay = cp.near_duplicates(spark, odd, SMALL).collect()
    # rows that repeat an id are documents of their own: both wordless rows of 2 stay, and of 3 one "word" and the other text
    assert sorted(r.doc_id for r in stay if r.doc_id is not None) == [0, 1, 2, 2, 3, 3, 4, 6, 9, 10, 11, 12, 13, 14, 15, 16, 18]
    assert sorted(r.text for r in stay if r.doc_id == 3) == ["another text under the same id here", "word"]
    assert sum(r.doc_id is None for r in stay) == 2
    changed = {r.doc_id: r for r in cp.private_values(spark, odd, SMALL).collect()}
    assert changed[15].text != "" and changed[15].n_chars == len(changed[15].text) and changed[0].n_chars == 0


def test_a_repeated_id_loses_only_texts_with_a_kept_copy(spark):
    words = [f"word{i}" for i in range(60)]
    one, two, three = " ".join(words[:30]), " ".join(words[30:]), " ".join(words[::2])
    docs = spark.createDataFrame([(1, one), (7, one + " more"), (7, two), (7, two), (9, three), (None, one)], "doc_id long, text string")
    got = sorted([(r.doc_id or 0, r.text) for r in cp.near_duplicates(spark, docs, SMALL).collect()])
    assert got == sorted([(1, one), (7, two), (9, three), (0, one)])
