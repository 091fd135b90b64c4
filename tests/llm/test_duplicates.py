"""Near-duplicate operators and fingerprints against brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from streetflow.llm import jaccard, lattice, merkle, queries
from streetflow.llm.components import components
from streetflow.llm.shingles import shingle_sets, word_hashes
from streetflow.llm.common import string_bytes
from tests.llm import brute
from tests.llm.brute import rows
from tests.llm.conftest import SMALL, SMOKE


def test_shingles_of_any_window(monkeypatch):
    from streetflow.llm import shingles

    rng = random.Random(5)
    texts = [" ".join(rng.choice(["a", "Bb", "çç", "d\te", "long" * 9]) for _ in range(rng.randrange(40))) for _ in range(60)] + ["", " ", "x" * 300, "  y"]
    whole = [s.tolist() for s in shingle_sets(pa.array(texts))]
    assert [len(s) for s in whole] == [len(brute.shingles(t)) for t in texts]
    for size in (1, 7, 64):
        monkeypatch.setattr(shingles, "WINDOW_BYTES", size)
        assert [s.tolist() for s in shingle_sets(pa.array(texts))] == whole
    words, first = word_hashes(*string_bytes(pa.array(["A b", "a B a"])))
    assert len(words) == 5 and words[0] == words[2] == words[4] and first.tolist() == [0, 2, 5]


@pytest.mark.parametrize("sf", [SMOKE, SMALL])
def test_jaccard_query(spark, sf):
    want = brute.jaccard(rows(sf, "SELECT doc_id, text FROM documents"))
    got = queries.QUERIES["op2_ngram_jaccard_join"](spark, sf).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert len(got) == len(want)


def near_copies(seed, n_docs, n_words, edits, words):
    """Texts about one base, each with some words replaced, so that similarities lie about the threshold."""
    rng = random.Random(seed)
    base = [rng.choice(words) for _ in range(n_words)]
    out = []
    for _ in range(n_docs):
        text = list(base)
        for _ in range(rng.randrange(edits + 1)):
            text[rng.randrange(n_words)] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(text))
    return out


def check_jaccard(spark, texts, monkeypatch, frequent):
    monkeypatch.setattr(jaccard, "FREQUENT", frequent)
    docs = list(enumerate(texts, 10))
    got = jaccard.jaccard_components(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.jaccard(docs)


@pytest.mark.parametrize("frequent", [1, 3, 32])
def test_groups_of_near_copies_lose_no_link(spark, monkeypatch, frequent):
    words = [f"w{i}" for i in range(400)]
    texts = []
    for seed, (n_docs, n_words, edits) in enumerate([(40, 60, 4), (30, 200, 9), (25, 14, 1), (12, 9, 1), (20, 7, 1)]):
        texts += near_copies(seed, n_docs, n_words, edits, words)
    texts += ["a b c", "A b c", "a b", "a", "a", "", None]
    check_jaccard(spark, texts, monkeypatch, frequent)


def test_a_passage_shared_by_many_links_nothing(spark, monkeypatch):
    rng = random.Random(8)
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [f"{' '.join(f'u{rng.randrange(10**9)}' for _ in range(n))} {passage}" for n in [10, 12, 14, 15, 16, 17, 18, 19, 20, 30, 60, 200] * 6]
    check_jaccard(spark, texts, monkeypatch, 4)


def test_two_level_index_entries_are_shared_by_linked_sets():
    """Any two linked sets share an index entry, whichever tokens are rare, frequent or their own."""
    rng = random.Random(13)
    for _ in range(3000):
        n = rng.choice([1, 2, 3, 4, 5, 7, 8, 9, 15, 16, 17, 31, 33, 60, 64, 90])
        common = [(rng.choice([2, 3, 40, 500]), rng.randrange(-(2**63), 2**63)) for _ in range(n)]
        a, b = set(common), set(common)
        for s in (a, b):
            for _ in range(rng.randrange(n // 4 + 1)):
                s.discard(rng.choice(common))
            for _ in range(rng.randrange(n // 6 + 1)):
                s.add((rng.choice([2, 3, 40, 500]), rng.randrange(-(2**63), 2**63)))
        own_a, own_b = rng.randrange(n // 8 + 1), rng.randrange(n // 8 + 1)
        na, nb, i = len(a) + own_a, len(b) + own_b, len(a & b)
        if i and 100 * i >= 75 * (na + nb - i):
            ea, eb = jaccard.index_entries(na, sorted(a)), jaccard.index_entries(nb, sorted(b))
            assert any(175 * min(ea[e], eb[e]) >= 75 * (na + nb) for e in ea.keys() & eb.keys())


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(1000, 1100)] + [(7, 7), (2000, 2001), (2001, 2000)]
    want = brute.Union({v for e in links for v in e})
    for a, b in links:
        want.join(a, b)
    got = {r.v: r.m for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {v: want.find(v) for v in want.up if want.find(v) != v}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_jaccard_odd_rows(odd, none):
    got = jaccard.jaccard_components(odd).collect()
    assert len(got) == odd.count()
    assert all(r.component_id is None for r in got if r.doc_id is None)
    by = {r.doc_id: r for r in got}
    assert by[0].n_shingles == by[1].n_shingles == 0 and by[0].component_id == 0
    assert by[6].component_id == by[7].component_id == by[8].component_id == 6
    assert by[4].component_id == by[5].component_id == 4
    assert by[16].component_id == by[17].component_id == 16
    assert {r.component_id for r in got if r.doc_id == 3} == {3}
    assert jaccard.jaccard_components(none).count() == 0


def test_lattice_points():
    rng = np.random.default_rng(4)
    roots = lattice.minimal_vectors()
    assert roots.shape == (240, 8) and np.allclose((roots**2).sum(1), 2)
    x = rng.normal(size=(500, 8)) * 3
    near = lattice.nearest_e8(x)
    two = np.rint(near * 2)
    assert (two == near * 2).all() and ((two % 2).sum(1) % 8 == 0).all() and (near.sum(1) % 2 == 0).all()
    own = ((x - near) ** 2).sum(1)
    for r in roots:  # no neighbouring point is nearer
        assert (own <= ((x - near - r) ** 2).sum(1) + 1e-9).all()


def test_lattice_query(spark):
    want = brute.cosine(rows(SMALL, "SELECT vec_id, embedding FROM embeddings"), 0.95)
    got = queries.QUERIES["op8_lattice_near_duplicates"](spark, SMALL).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


@pytest.mark.parametrize("block", [2048, 16])
def test_lattice_recall_at_the_threshold(spark, monkeypatch, block):
    """Pairs of cosine 0.95 to 0.97 about 40 centres, and one hot group in several blocks."""
    rng = np.random.default_rng(6)
    vectors = []
    for size in [8] * 40 + [60]:
        centre = rng.normal(size=64)
        for _ in range(size):
            v = centre + rng.normal(size=64) * np.linalg.norm(centre) / 8 * rng.uniform(0.1, 0.25)
            vectors.append((v * rng.uniform(0.5, 9)).tolist())
    vectors += [vectors[0]] * 5
    monkeypatch.setattr(lattice, "BLOCK", block)
    rows_ = list(enumerate(vectors, 100))
    want = brute.cosine(rows_, 0.95)
    got = {r.vec_id: (r.n_links, r.component_id) for r in lattice.near_duplicates(spark.createDataFrame(rows_, "vec_id long, embedding array<double>").repartition(3)).collect()}
    total = sum(n for n, _ in want.values())
    assert total > 1000 and all(got[i][0] <= want[i][0] for i in want)
    assert sum(n for n, _ in got.values()) >= 0.98 * total


def test_lattice_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    base = [1.0, 2.0, 3.0]
    rows_ = [(1, base), (2, [2.0, 4.0, 6.0]), (3, None), (4, []), (5, [0.0, 0.0, 0.0]), (6, [1.0, None, 2.0]), (7, [1.0, nan, 2.0]), (8, [inf, 1.0, 1.0]),
             (9, [1.0, 2.0]), (None, base), (2, base), (10, [1e300, 2e300, 3e300]), (11, [-1.0, -2.0, -3.0])]
    df = spark.createDataFrame([(i, v, 1, 2, "x") for i, v in rows_], "vec_id long, embedding array<double>, n_links int, cell int, root string")
    got = lattice.near_duplicates(df).collect()
    assert len(got) == len(rows_)
    by = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got}
    # id 2 has two rows: each is linked with 1 and 10, not with the other
    assert by[1] == (3, 1, True) and by[2] == (4, 1, False) and by[10] == (3, 1, False)
    for i in (3, 4, 5, 6, 7, 8, 9, 11):
        assert by[i] == (0, i, True)
    assert by[None] == (0, None, True)
    assert lattice.near_duplicates(df.limit(0)).count() == 0


def test_fingerprint_query(spark):
    docs = rows(SMOKE, "SELECT doc_id, text FROM documents ORDER BY doc_id")
    import hashlib

    got = {r.doc_id: r for r in queries.QUERIES["op5_document_fingerprints"](spark, SMOKE).collect()}
    assert len(got) == len(docs)
    prints = {}
    for (d, t), (e, u) in zip(docs, docs[1:] + docs[:1], strict=True):
        k = len(t) // 4
        edited = t[: len(t) - k] + u[:k]
        r = got[d]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1
        assert (r.near_next == 1) == (t == u) or r.near_next < 1
        assert (r.fingerprint == r.edited_fingerprint) == (t == edited)
        prints.setdefault(t, set()).add(r.fingerprint)
        if len(t) >= 200:
            assert r.near_edited >= 0.25
    assert all(len(p) == 1 for p in prints.values()) and len({p for s in prints.values() for p in s}) == len(prints)


def plain_fingerprint(text):
    """root, and (section digest, [(paragraph digest, number of leaves)]) of every section."""
    import hashlib

    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    sections, run = [], []
    for line in text.split("\n"):
        run.append((sha(line), -(-min(len(line), 24) // 6) + -(-max(0, len(line) - 24) // 24)))
        if run[-1][0].endswith("0"):
            sections.append(run)
            run = []
    sections += [run] if run else []
    digests = [sha(",".join(d for d, _ in s)) for s in sections]
    return sha(",".join(digests)), [(d[:16], [(p[:16], n) for p, n in s]) for d, s in zip(digests, sections, strict=True)]


def test_fingerprints_are_the_written_tree(spark, odd):
    for r in merkle.fingerprints(odd).join(odd.select("doc_id", "text"), "doc_id").collect():
        if r.doc_id == 3:  # an id with two texts
            continue
        top, sections = plain_fingerprint(r.text or "")
        assert r.fingerprint.split("|")[0] == top
        written = [s.split("=") for s in r.fingerprint.split("|")[1].split(";")]
        assert [(d, [(p.split(":")[0], len(p.split(":")[1]) // 5) for p in ps.split(",")]) for d, ps in written] == sections


def test_differing_branches_locate_an_edit(spark):
    lines = [f"line {i} of the text with enough words to tell it from others" for i in range(200)]
    other = [*lines[:120], "another line", *lines[121:]]
    df = spark.createDataFrame([(1, "\n".join(lines)), (2, "\n".join(other))], "doc_id long, text string")
    a, b = (r.fingerprint for r in merkle.fingerprints(df).orderBy("doc_id").collect())
    pair = spark.createDataFrame([(a, b)], "a string, b string")
    found = pair.select(
        merkle.branches(F.col("a"), F.col("b")).alias("x"), merkle.paragraphs(F.col("a"), F.col("b")).alias("p"), merkle.compare(F.col("a"), F.col("b")).alias("c"),
        merkle.compare(F.col("b"), F.col("a")).alias("back"), merkle.compare(F.col("a"), F.col("a")).alias("same"),
    ).first()
    assert found.p == [120] and found.same == 1.0 and found.c == found.back
    sections = a.split("|")[1].split(";")
    assert len(found.x) == 1 and 0.9 < found.c < 1
    before = sum(s.count(",") + 1 for s in sections[: found.x[0]])
    assert before <= 120 <= before + sections[found.x[0]].count(",") + 1


def test_likeness_goes_down_to_the_leaves(spark):
    """One long paragraph without line breaks, its end replaced: neither section nor paragraph agrees."""
    text = " ".join(f"word{i}" for i in range(400))
    half = text[: len(text) // 2] + "".join(chr(0x4E00 + i) for i in range(len(text) // 2))
    df = spark.createDataFrame([(1, text), (2, half), (3, ""), (4, text + "\n" + text)], "doc_id long, text string")
    prints = {r.doc_id: r.fingerprint for r in merkle.fingerprints(df).collect()}
    pairs = spark.createDataFrame([(i, j, prints[i], prints[j]) for i in prints for j in prints], "i int, j int, a string, b string")
    got = {(r.i, r.j): r.c for r in pairs.select("i", "j", merkle.compare(F.col("a"), F.col("b")).alias("c")).collect()}
    assert 0.45 < got[1, 2] < 0.55 and got[1, 3] == 0 and 0.45 < got[1, 4] <= 0.5 and got[3, 3] == 1
    assert all(got[i, j] == got[j, i] for i, j in got)


def test_fingerprints_have_no_python(spark):
    df = spark.createDataFrame([(1, "a\nb"), (2, "c")], "doc_id long, text string")
    plan = merkle.edited_fingerprints(df)._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas"))


def test_fingerprint_odd_rows(odd, none):
    got = merkle.edited_fingerprints(odd).collect()
    distinct = {(r.doc_id, r.text or "") for r in odd.collect()}
    assert len(got) == len(distinct)
    assert sorted(r.n_chars for r in got) == sorted(len(t) for _, t in distinct)
    assert merkle.edited_fingerprints(none).count() == 0
    one = merkle.edited_fingerprints(odd.filter("doc_id = 8")).collect()
    assert len(one) == 1 and one[0].next_fingerprint == one[0].fingerprint


def test_lattice_group_of_equal_vectors(spark, monkeypatch):
    """A third and more of the rows equal: representatives alone meet, and every link is counted."""
    met = []
    compare = lattice.file_vectors
    monkeypatch.setattr(lattice, "file_vectors", lambda units, *a: met.append(units.count()) or compare(units, *a))
    rng = np.random.default_rng(3)
    other = rng.normal(size=(50, 16))
    values = ", ".join(f"array({', '.join(f'{x:.6f}D' for x in v)})" for v in other)
    rows_ = spark.range(100_000).selectExpr("id AS vec_id", f"element_at(array({values}), IF(id < 60000, 1, CAST(2 + id % 49 AS INT))) AS embedding")
    got = {r.component_id: (r.n, r.lo, r.hi) for r in lattice.near_duplicates(rows_).groupBy("component_id").agg(
        F.count("*").alias("n"), F.min("n_links").alias("lo"), F.max("n_links").alias("hi")).collect()}
    assert met == [50]
    assert got[0] == (60_000, 59_999, 59_999) and len(got) == 50
    assert all(n - 1 == lo == hi for n, lo, hi in got.values())


def test_lattice_settings_follow_the_table():
    scale, tables = lattice.settings(1000, 64, 0.95)
    assert (scale, tables) == (lattice.SCALE, lattice.TABLES)
    scale, tables = lattice.settings(10**9, 64, 0.95)
    assert scale > 2 * lattice.SCALE and tables > lattice.TABLES


def test_jaccard_rounds_over_near_copies(spark, monkeypatch):
    """A large group of near copies: few rounds, and the result is brute force's."""
    written = []
    keep = jaccard.keep
    monkeypatch.setattr(jaccard, "keep", lambda df, name, **o: written.append(name) or keep(df, name, **o))
    words = [f"w{i}" for i in range(300)]
    texts = near_copies(11, 300, 60, 9, words) + [" ".join(random.Random(i).choices(words, k=40)) for i in range(100)]
    docs = list(enumerate(texts, 1))
    got = jaccard.jaccard_components(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.jaccard(docs)
    assert written.count("jaccard-names") <= 4


def test_components_by_one_task_and_by_stars(spark, monkeypatch):
    from streetflow.llm import components as module

    rng = random.Random(1)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5), (2000, 3000), (3000, 2000)]
    comps = brute.Union({x for p in links for x in p})
    for a, b in links:
        comps.join(a, b)
    want = {x: comps.find(x) for x in comps.up if comps.find(x) != x}
    df = spark.createDataFrame(links, "a long, b long").repartition(4)
    for most in (250_000, 0):
        monkeypatch.setattr(module, "FEW_LINKS", most)
        assert {r.v: r.m for r in module.components(df).collect()} == want
