"""Searches and hard negatives against brute force."""

import collections
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from streetflow.llm import lexical, multi_index, negatives, queries
from tests.llm import brute
from tests.llm.brute import rows
from tests.llm.conftest import ODD_TEXTS, SMALL, SMOKE

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate(brute.LOWER))


def ranked(docs, items, k=10):
    """(item, rank, doc, score) of every document against every item."""
    counts = [(i, collections.Counter(terms(t))) for i, t in docs]
    n_docs, n_terms = sum(1 for _, c in counts if c), sum(c.total() for _, c in counts)
    df = collections.Counter(t for _, c in counts for t in c)
    asked = collections.defaultdict(collections.Counter)
    for i, t in items:
        if i is not None:
            asked[i].update(terms(t))
    out = []
    for item, wanted in asked.items():
        scored = []
        for doc, c in counts:
            m = 25 + 75 * c.total() * n_docs // n_terms if n_terms else 0
            score = 0
            for t, times in wanted.items():
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += times * w * (10**9 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, doc, -s) for rank, (s, _, _, doc) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=str)


def asked(spark, docs, items, k=10):
    found = lexical.search(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string"), k)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted([tuple(r) for r in found.collect()], key=str)


@pytest.mark.parametrize("sf", [SMOKE, SMALL])
def test_lexical_query(spark, sf):
    want = ranked(rows(sf, "SELECT doc_id, text FROM documents"), rows(sf, "SELECT item_id, text FROM benchmark"))
    got = sorted([tuple(r) for r in queries.QUERIES["op11_lexical_search"](spark, sf).collect()], key=str)
    assert got == want


@pytest.mark.parametrize("bucket,entries,first", [(4096, 250_000, 1 / 16), (7, 40, 0.5), (1, 3, 1 / 64)])
def test_lexical_search_of_skewed_words(spark, monkeypatch, bucket, entries, first):
    """Frequent and rare words, copies and ties, whatever the buckets, batches and turns are."""
    monkeypatch.setattr(lexical, "BUCKET", bucket)
    monkeypatch.setattr(lexical, "ITEM_TERMS", entries)
    monkeypatch.setattr(lexical, "FIRST_PART", first)
    rng = random.Random(3)
    words = [f"w{i}" for i in range(60)]
    odds = [1 / (i + 1) for i in range(60)]
    docs = [(i, " ".join(rng.choices(words, odds, k=rng.randrange(1, 40)))) for i in range(150)]
    docs += [(i + 200, docs[7][1]) for i in range(60)]
    items = [(i, " ".join(rng.choices(words + ["absent"], [*odds, 0.1], k=rng.randrange(1, 12)))) for i in range(9)]
    assert asked(spark, docs, items) == ranked(docs, items)


def test_lexical_odd_rows(spark, odd, none, monkeypatch):
    monkeypatch.setattr(lexical, "WINDOW_BYTES", 100)
    items = [(i, t) for i, t in enumerate(ODD_TEXTS)] + [(3, "another word"), (None, "word"), (99, "nowhere"), (98, None)]
    asked_of = spark.createDataFrame([(i, t, 1, "x") for i, t in items], "item_id long, text string, score int, doc_id string")
    docs = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    got = sorted([tuple(r) for r in lexical.search(odd, asked_of).collect()], key=str)
    assert got == ranked(docs, items)
    assert lexical.search(none, asked_of).count() == 0
    assert lexical.search(odd, asked_of.limit(0)).count() == 0
    assert lexical.search(odd.filter("text = ''"), asked_of).count() == 0


def test_terms_of_any_window(monkeypatch):
    for size in (1, 5, 64):
        monkeypatch.setattr(lexical, "WINDOW_BYTES", size)
        for text in [t for t in ODD_TEXTS if t] + ["x" * 300, " \x00a\x00 B"]:
            assert {t.decode(): n for t, n in lexical.term_counts(text.encode()).items()} == collections.Counter(terms(text))


def neighbours(vectors, is_query, k=10):
    """query -> [(id, distance)] by comparing all pairs."""
    ids = np.array([i for i, _ in vectors])
    x = np.array([v for _, v in vectors], float)
    out = {}
    for q in np.flatnonzero([is_query(i) for i in ids]):
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        d[q] = np.inf
        order = np.lexsort((ids, d))[: min(k, len(ids) - 1)]
        out[int(ids[q])] = [(int(ids[o]), float(d[o])) for o in order]
    return out


def recall(found, truth):
    got = collections.defaultdict(set)
    for r in found:
        got[r.query_id].add(r.vec_id)
    return sum(len(got[q] & {i for i, _ in near}) for q, near in truth.items()) / sum(map(len, truth.values()))


def test_nearest_query(spark):
    sf = "/root/testdata/sf0.1"
    vectors = rows(sf, "SELECT vec_id, embedding FROM embeddings")
    found = queries.QUERIES["op12_nearest_neighbours"](spark, sf).collect()
    truth = neighbours(vectors, lambda i: i % 100 == 0)
    assert recall(found, truth) >= 0.93
    x = {i: np.array(v, float) for i, v in vectors}
    by_query = collections.defaultdict(list)
    for r in found:
        assert r.score == np.sqrt(((x[r.query_id] - x[r.vec_id]) ** 2).sum()) and r.vec_id != r.query_id
        by_query[r.query_id].append(r)
    for got in by_query.values():
        assert [r.rank for r in sorted(got, key=lambda r: (r.score, r.vec_id))] == list(range(1, 11))


def test_nearest_among_clusters_takes_a_part_of_the_index(spark, monkeypatch):
    """Clustered vectors, a third of them equal; batches of few queries give the same rows."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(40, 16)) * 4
    x = centres[rng.integers(0, 40, 3000)] + rng.normal(size=(3000, 16)) * 0.3
    x[::3] = x[0]
    vectors = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").repartition(4)
    depths, measured = [], multi_index.Index._measured_depth
    monkeypatch.setattr(multi_index.Index, "_measured_depth", lambda self: depths.append(measured(self)) or depths[-1])
    found = multi_index.search(df, "vec_id % 20 = 1").collect()
    truth = neighbours(vectors, lambda i: i % 20 == 1)
    assert recall(found, truth) >= 0.9
    assert depths[0] <= 1500  # the equal third and little more
    equal = [r for r in found if r.query_id % 3 == 0]
    assert all(r.score == 0.0 for r in equal)
    monkeypatch.setattr(multi_index, "QUERIES", 16)
    assert sorted(multi_index.search(df, "vec_id % 20 = 1").collect()) == sorted(found)


def test_walk_takes_pairs_by_ascending_sum():
    rng = np.random.default_rng(8)
    for _ in range(30):
        a, b = rng.integers(0, 9, 6) / 2.0, rng.integers(0, 9, 5) / 2.0
        sizes = rng.integers(0, 4, (6, 5))
        depth = int(rng.integers(1, sizes.sum() + 4))
        sums = (a[:, None] + b[None, :]).ravel()
        order = np.argsort(sums, kind="stable")
        passed = np.cumsum(sizes.ravel()[order])
        want = sums[order][np.searchsorted(passed, depth)] if passed[-1] >= depth else np.inf
        assert multi_index.walk(a, b, sizes, depth) == want


ODD_VECTORS = [
    (0, [1.0, 0.0], 1), (50, [0.9, 0.1], 1), (51, [0.9, 0.1], 1), (52, [0.9, 0.2], 2), (53, [0.8, 0.1], 2), (54, [0.6, 0.0], 3), (55, [0.0, 0.0], 2),
    (56, None, 1), (57, [], 1), (58, [1.0, None], 1), (59, [1.0, float("nan")], 1), (60, [float("inf"), 1.0], 1), (61, [1.0, 2.0, 3.0], 1), (62, [1.0, 2.0, 2.0], 1),
    (63, [0.7, 0.0], None), (100, [1.0, 2.0, 3.0], 4), (150, [], 1), (151, [], 1), (152, [], 2), (70, [0.5, 0.5], 1), (70, [0.5, 0.5], 1), (70, [0.9, 0.9], 5), (None, [1.0, 1.0], 1),
]


@pytest.fixture(scope="module")
def odd_vectors(spark):
    schema = "vec_id long, embedding array<double>, label int, score int, Rank string, dims int, cell int"
    return spark.createDataFrame([(*r, 1, "x", 7, 8) for r in ODD_VECTORS], schema).repartition(3)


def test_nearest_odd_rows(spark, odd_vectors):
    found = multi_index.search(odd_vectors, "vec_id % 50 = 0").collect()
    own = {2: [], 3: []}
    for i, v, _ in ODD_VECTORS:
        if i is not None and v and None not in v and np.isfinite(v).all() and any(v) and (i, v) != (70, [0.9, 0.9]) and (i, v) not in own[len(v)]:
            own[len(v)].append((i, v))
    want = {}
    for vectors in own.values():
        want |= neighbours(vectors, lambda i: i % 50 == 0)
    got = collections.defaultdict(list)
    for r in sorted(found, key=lambda r: r.rank):
        got[r.query_id].append((r.vec_id, r.score))
    assert got == want
    assert multi_index.search(odd_vectors.limit(0), "vec_id % 50 = 0").count() == 0
    assert multi_index.search(odd_vectors, "vec_id = 12345").count() == 0
    one = spark.createDataFrame([(i, [float(i % 7 + 1)]) for i in range(40)], "vec_id long, embedding array<double>")
    assert recall(multi_index.search(one, "vec_id % 10 = 0").collect(), neighbours([(i, [i % 7 + 1]) for i in range(40)], lambda i: i % 10 == 0)) == 1


def mined(vectors, is_anchor):
    """(anchor, positive, rank, negative, positive score, negative score) over (id, vector, label)."""
    x = {i: [math.floor(256 * c) for c in v] for i, v, _ in vectors}
    label = {i: lab for i, _, lab in vectors}
    out = []
    for a in filter(is_anchor, x):
        scored = sorted((-sum(p * q for p, q in zip(x[a], x[b], strict=True)), b) for b in x if b != a and len(x[b]) == len(x[a]))
        for p, pos in [s for s in scored if label[s[1]] == label[a]][:5]:
            fit = [s for s in scored if label[s[1]] != label[a] and 50 * -p <= 100 * -s[0] <= 95 * -p]
            out += [(a, pos, rank, neg, -p, -n) for rank, (n, neg) in enumerate(fit[:3], 1)]
    return sorted(out)


def as_contract(vectors):
    return [(i, v, (lab + 1) % 10 if i % 7 == 0 else lab) for i, v, lab in vectors]


@pytest.mark.parametrize("sf", [SMALL])
def test_hard_negative_query(spark, sf):
    want = mined(as_contract(rows(sf, "SELECT vec_id, embedding, label FROM embeddings")), lambda i: i % 50 == 0)
    assert sorted(map(tuple, queries.QUERIES["op13_hard_negatives"](spark, sf).collect())) == want


def test_hard_negatives_with_ties_and_small_blocks(spark, monkeypatch):
    """Few distinct components give ties and negative scores; a third of the rows are equal."""
    rng = np.random.default_rng(6)
    x = rng.integers(-3, 4, (400, 5)) / 4
    x[::3] = x[0]
    x[1] = 0
    vectors = [(i, x[i].tolist(), int(rng.integers(0, 3))) for i in range(400)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>, label int").repartition(3)
    want = mined(vectors, lambda i: i % 9 == 1)
    assert sorted(map(tuple, negatives.mine(df, "vec_id % 9 = 1").collect())) == want
    monkeypatch.setattr(negatives, "BLOCK", 32)
    monkeypatch.setattr(negatives, "ANCHORS", 10)
    monkeypatch.setattr(negatives, "FIRST_DEPTH", 1)
    assert sorted(map(tuple, negatives.mine(df, "vec_id % 9 = 1").collect())) == want


def test_threshold_stops_before_the_end():
    rng = np.random.default_rng(2)
    x = np.floor(rng.normal(size=(4000, 4)) * 256).astype(np.int64)
    lists = negatives.Lists(x, np.arange(4000), np.zeros(4000, np.int64))
    turns, read = 0, 0
    for met, scores, threshold in lists.descend(x[0]):
        assert (scores == x[met] @ x[0]).all()
        turns, read = turns + 1, read + len(met)
        if turns == 3:
            break
    unseen = np.sort(x @ x[0])[::-1]
    assert read < 400 and threshold < unseen[0]
    ids, best = lists.positives(x[0], -1)
    assert best.tolist() == unseen[:5].tolist()


def test_hard_negative_odd_rows(spark, odd_vectors):
    keep = {}
    for i, v, lab in sorted((r for r in ODD_VECTORS if r[0] is not None and r[2] is not None and r[1] is not None), key=lambda r: (r[0], r[2], str(r[1]))):
        if None not in v and np.isfinite(v).all():
            keep.setdefault(i, (i, v, lab))
    found = negatives.mine(odd_vectors, "vec_id % 50 = 0")
    assert sorted(map(tuple, found.collect())) == mined(list(keep.values()), lambda i: i % 50 == 0)
    assert negatives.mine(odd_vectors.limit(0), "vec_id % 50 = 0").count() == 0
    huge = spark.createDataFrame([(0, [1e30, 1.0], 1), (1, [1.0, 1.0], 1), (2, [1e300, -1e300], 2), (50, [2.0, 1.0], 1), (3, [1.2, 1.1], 2)], "vec_id long, embedding array<double>, label int")
    assert [tuple(r) for r in negatives.mine(huge, "vec_id % 50 = 0").collect()] == mined([(1, [1.0, 1.0], 1), (50, [2.0, 1.0], 1), (3, [1.2, 1.1], 2)], lambda i: i == 50)


def test_label_expression_may_use_the_id(spark):
    df = spark.createDataFrame([(i, [1.0 + i / 100], 1) for i in range(20)], "vec_id long, embedding array<double>, label int")
    label = F.when(F.col("vec_id") % 2 == 0, F.lit(5)).otherwise(F.col("label"))
    got = negatives.mine(df, "vec_id = 0", label).collect()
    assert {r.positive_id % 2 for r in got} == {0} and {r.negative_id % 2 for r in got} == {1}
