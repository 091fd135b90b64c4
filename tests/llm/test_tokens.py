"""Token operators against the tokenizers library: ids, counts, files, packing, trie coding."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from streetflow.llm import bpe, bpe_trie, packing, queries, token_counts, token_store
from tests.llm.brute import rows
from tests.llm.conftest import ODD_TEXTS, SMOKE

WORD, BYTE = bpe.public_path(bpe.WORD_BPE), bpe.public_path(bpe.BYTE_BPE)
DOCS = "SELECT doc_id, text FROM documents ORDER BY doc_id"


def library_ids(path, text):
    return bpe.library(path).encode(text or "", add_special_tokens=False).ids


TEXT = st.text(st.one_of(st.characters(max_codepoint=0x2FF), st.sampled_from(" \n\t'sre.,1²é\x85\xa0\x1c"), st.characters(exclude_categories=["Cs"])), max_size=40)


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_ids_are_the_librarys(text):
    for path in (WORD, BYTE):
        assert np.frombuffer(bpe.encoder(path).ids16(text), "<u2").tolist() == library_ids(path, text)


def test_every_latin1_character_is_split_as_the_library_does():
    rng = random.Random(3)
    every = [chr(c) for c in range(256)]
    texts = ["".join(rng.choice(every) for _ in range(30)) for _ in range(500)] + [f"a{c}b {c} {c}{c}" for c in every] + ODD_TEXTS
    for path in (WORD, BYTE):
        for t in texts:
            assert np.frombuffer(bpe.encoder(path).ids16(t or ""), "<u2").tolist() == library_ids(path, t), repr(t)


def test_a_full_cache_starts_anew():
    enc = bpe.WordEncoder(WORD, 3 * (bpe.ENTRY_BYTES + 20))
    text = "a few more words than the cache can hold at once"
    assert np.frombuffer(enc.ids16(text), "<u2").tolist() == library_ids(WORD, text)
    assert 0 < len(enc.pieces) <= 4


def test_pieces_of_both_spellings_that_look_alike(monkeypatch):
    """A plain piece may begin with any character, NUL included, and equal a word of the library's spelling."""
    for texts in (["\0abc hello", "日本 abc"], ["日本 abc", "\0abc hello"], ["abc \0", "é abc \0 日", "\0\0abc", "日\0abc"]):
        coder = bpe_trie.Coder(WORD)
        for most in (bpe_trie.HELD_BYTES, 0):
            monkeypatch.setattr(bpe_trie, "HELD_BYTES", most)
            for text, (ids, _) in zip(texts, coder.code(texts), strict=True):
                assert np.frombuffer(ids, "<u4").tolist() == library_ids(WORD, text)
    rng = random.Random(12)
    texts = ["".join(rng.choice("ab \0é日本'1\n") for _ in range(rng.randrange(12))) for _ in range(4000)]
    for text, (ids, _) in zip(texts, bpe_trie.Coder(WORD).code(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library_ids(WORD, text)


def test_a_stage_drops_what_another_kept():
    from streetflow.llm.common import fresh_key, held

    made = []
    make = lambda: made.append(1) or object()
    first = held("one", "a", make)
    assert held("one", "a", make) is first and held("one", "b", make) is not first
    held("two", "a", make)
    assert held("one", "a", make) is not first and len(made) == 4
    assert fresh_key() != fresh_key()


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXT, max_size=6))
def test_trie_codes_as_the_library(texts):
    tok = bpe.library(WORD)
    for text, (ids, decoded) in zip(texts, bpe_trie.coder(WORD).code(texts), strict=True):
        want = library_ids(WORD, text)
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert decoded == tok.decode(want, skip_special_tokens=False)


def test_counts(spark):
    docs = dict(rows(SMOKE, DOCS))
    got = queries.QUERIES["op6_token_counts"](spark, SMOKE).collect()
    assert len(got) == len(docs)
    for r in got:
        n = len(library_ids(WORD, docs[r.doc_id]))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((docs[r.doc_id] or "").encode()), n, n > 2048)


def test_a_long_run_of_letters_takes_memory_in_proportion():
    import tracemalloc

    rng = random.Random(6)
    run = "".join(rng.choices("etaoinshrdlu", k=200_000))
    trie = bpe_trie.TrieCoder(WORD)
    tracemalloc.start()
    trie.encode({run[:20_000]})
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30 << 20, peak  # half the square of the letters is 200 MB
    ids, _ = bpe_trie.coder(WORD).code([run])[0]
    assert np.frombuffer(ids, "<u4").tolist() == library_ids(WORD, run)


def test_trie_query(spark):
    docs, tok = dict(rows(SMOKE, DOCS)), bpe.library(WORD)
    got = queries.QUERIES["op10_bpe"](spark, SMOKE).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = library_ids(WORD, docs[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def check_pieces(pieces, want, size):
    """``pieces`` as (doc, start, length, doc_tokens, sequence, offset, ids); ``want``: ids of all rows, end included."""
    by_sequence, whole = {}, sorted(tuple(w) for w in want)
    for p in pieces:
        by_sequence.setdefault(p[4], []).append(p)
    last = max(by_sequence, default=0)
    stream = []
    for s in range(last + 1 if by_sequence else 0):
        at = 0
        for p in sorted(by_sequence[s], key=lambda p: p[5]):
            assert p[5] == at and len(p[6]) == p[2] > 0
            at += p[2]
            stream.append(p)
        assert at == size or s == last
    docs, now = [], []
    for p in stream:
        assert p[1] == len(now)
        now += p[6]
        if len(now) == p[3]:
            docs.append(tuple(now))
            now = []
    assert not now and sorted(docs) == whole


@pytest.mark.parametrize("size", [1, 7, 4096])
def test_packing_operator(spark, size):
    texts = ["a b c", None, "", "some more words here", "x " * 50]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = [(*r[:6], np.frombuffer(r.ids, "<u4").tolist()) for r in packing.pack(docs, WORD, 2, size).collect()]
    check_pieces(got, [[*library_ids(WORD, t), 2] for t in texts], size)


def test_packing_query(spark):
    docs = dict(rows(SMOKE, DOCS))
    want = {d: np.array([*library_ids(WORD, t), 2], "<u4") for d, t in docs.items()}
    pieces = queries.QUERIES["op9_packing"](spark, SMOKE).collect()
    for r in pieces:
        assert r.ids_crc32 == zlib.crc32(want[r.doc_id][r.start : r.start + r.length].tobytes())
    got = [(r.doc_id, r.start, r.length, r.doc_tokens, r.sequence_id, r.offset, want[r.doc_id][r.start : r.start + r.length].tolist()) for r in pieces]
    check_pieces(got, [w.tolist() for w in want.values()], 4096)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 65535), min_size=1, max_size=60), st.integers(1, 80))
def test_coder_round_trip(ids, times):
    x = np.array(ids * times, "<u2")
    assert (token_store.decode_segment(token_store.encode_segment(x)) == x).all()


def test_coder_blocks_decode_alone_and_damage_is_seen():
    x = np.random.default_rng(1).integers(0, 300, 3 * token_store.BLOCK + 5).astype("<u2")
    data = token_store.encode_segment(x)
    b = token_store.BLOCK
    assert (token_store.decode_segment(data, slice(1, 2)) == x[b : 2 * b]).all()
    assert (token_store.decode_segment(data, slice(3, 4)) == x[3 * b :]).all()
    broken = bytearray(data)
    broken[-9] ^= 255
    with pytest.raises(ValueError, match="damaged"):
        token_store.decode_segment(bytes(broken))
    with pytest.raises(ValueError, match="cut short"):
        token_store.decode_segment(data[:-4])


def test_coder_steps_write_over_their_arrays():
    import tracemalloc

    lanes = 100_000
    ids = np.random.default_rng(4).integers(0, 50, lanes).astype(np.int32)
    model, coder = token_store.Mixer(lanes, token_store.Zero.of(ids)), token_store.Range(lanes)
    hit2, hit1, hit = np.zeros((3, lanes), bool)
    tracemalloc.start()
    model.predict()
    np.logical_or(np.equal(ids, model.id2, out=hit2), np.equal(ids, model.id1, out=hit1), out=hit)
    coder.units()
    first, size = model.interval(ids, hit2, hit)
    model.learn(ids, hit2, hit1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < lanes, peak  # the smallest array of the lanes has a byte each


STEPS = np.arange(9000)
CODES = [
    ((STEPS * STEPS % 977).astype("<u2"), 904840805),
    ((STEPS * 7919 % 50257 * (STEPS % 3 > 0)).astype("<u2"), 1772278915),
    (np.full(3, 65535, "<u2"), 2312083363),
]


def test_coder_keeps_the_format():
    """The code of files that were written before, checked by its sum; their tables are packed by zlib."""
    for ids, want in CODES:
        data = token_store.encode_segment(ids)
        n_table = int.from_bytes(data[21:25], "little")
        assert zlib.crc32(data[25 + n_table :]) == want
        assert (token_store.decode_segment(data) == ids).all()


def test_repetition_is_coded_short():
    x = np.tile(np.arange(50, dtype="<u2"), 400)
    assert len(token_store.encode_segment(x)) < len(x) * 2 / 10


def test_token_files_query(spark):
    at = 0
    got = {r.doc_id: r for r in queries.QUERIES["op3_token_files"](spark, SMOKE).collect()}
    docs = rows(SMOKE, DOCS)
    assert len(got) == len(docs)
    for d, t in docs:
        ids = np.array([*library_ids(BYTE, t), 2], "<u4")
        assert (got[d].start, got[d].n_tokens, got[d].ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_several_segments_in_a_part(spark, monkeypatch, tmp_path):
    texts = [f"text number {i} with some words" for i in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    monkeypatch.setattr(token_store, "SEGMENT", 64)
    path = str(tmp_path / "files")
    token_store.write(docs, path, BYTE)
    assert spark.read.parquet(path).count() >= 1
    got = token_store.read(spark, path).orderBy("start").collect()
    assert [np.frombuffer(r.ids, "<u4").tolist() for r in got] == [[*library_ids(BYTE, t), 2] for t in texts]


def texts_of(df):
    return sorted((r.doc_id is not None, r.doc_id or 0, r.text or "") for r in df.collect())


def test_odd_rows(spark, odd, none, tmp_path):
    """Nulls, empty and long texts, repeats, clashing columns: every row comes back, with the library's ids."""
    want = texts_of(odd)
    counts = sorted((d, i, len(t.encode()), len(library_ids(WORD, t))) for d, i, t in want)
    got = token_counts.token_counts(odd, WORD, table_size=5).collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_bytes, r.n_tokens) for r in got) == counts
    coded = bpe_trie.encode_decode(odd, WORD).collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0, np.frombuffer(r.ids, "<u4").tolist()) for r in coded) == sorted((d, i, library_ids(WORD, t)) for d, i, t in want)
    pieces = [(*r[:6], np.frombuffer(r.ids, "<u4").tolist()) for r in packing.pack(odd, WORD, 2, 512).collect()]
    check_pieces(pieces, [[*library_ids(WORD, t), 2] for _, _, t in want], 512)
    token_store.write(odd, str(tmp_path / "odd"), BYTE)
    files = token_store.read(spark, str(tmp_path / "odd")).orderBy("start").collect()
    assert [r.start for r in files] == [sum(x.n_tokens for x in files[:k]) for k in range(len(files))]
    ids = [(r.doc_id is not None, r.doc_id or 0) for r in files]
    assert ids == sorted(ids)
    assert sorted(np.frombuffer(r.ids, "<u4").tolist() for r in files) == sorted([*library_ids(BYTE, t), 2] for _, _, t in want)
    token_store.write(none, str(tmp_path / "none"), BYTE)
    for empty in (token_counts.token_counts(none, WORD), bpe_trie.encode_decode(none, WORD), packing.pack(none, WORD), token_store.read(spark, str(tmp_path / "none"))):
        assert empty.count() == 0
