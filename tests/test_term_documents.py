"""Vectors of terms over documents, similarities by them, and their clusters, against dense computations."""

import math
import random

import numpy as np
import pytest

from termloom.operators import clusters
from termloom.operators import term_documents as shared
from termloom.operators import term_vectors as terms


@pytest.fixture(scope="module")
def corpus(spark):
    rnd = random.Random(12)
    words = [f"w{k}" for k in range(30)]
    texts = [" ".join(rnd.choices(words, [1 / (k + 1) for k in range(30)], k=rnd.randint(0, 40))) for _ in range(40)]
    texts += ["alone", "twin1 twin2", "", None, " ".join(words * 2)]
    rows = [(i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, contents string")
    indexed = terms.with_vectors(docs).cache()
    return texts, indexed, terms.doc_freq(indexed).cache()


def weights(texts, rep, mode="default"):
    counts = [{w: (t or "").split().count(w) for w in set((t or "").split())} for t in texts]
    df = {}
    for c in counts:
        for w in c:
            df[w] = df.get(w, 0) + 1
    f32 = lambda x: float(np.float32(x))
    n = len(texts)
    ratio = lambda d: (d + 1) / (n + 1) if mode == "default" else (n + 1) / (d + 1)
    idf = {w: f32(math.log(ratio(d)) + 1) for w, d in df.items()}
    own = {"bin": lambda w, c: 1.0, "tf": lambda w, c: f32(math.sqrt(c)), "tfxidf": lambda w, c: f32(math.sqrt(c)) * idf[w]}[rep]
    return {(w, i): own(w, c[w]) for i, c in enumerate(counts) for w in c}


@pytest.mark.parametrize("rep", shared.REPRESENTATIONS)
@pytest.mark.parametrize("mode", ["default", "classic"])
def test_vectors_and_similarities(spark, corpus, rep, mode):
    texts, indexed, freqs = corpus
    expected = weights(texts, rep, mode)
    rows = shared.term_doc_vectors(indexed, freqs, rep, mode).collect()
    assert {(r.term, r.doc_id): r.weight for r in rows} == pytest.approx(expected) and len(rows) == len(expected)

    names = sorted({w for w, _ in expected})
    dense = np.zeros((len(names), len(texts)))
    for (w, i), x in expected.items():
        dense[names.index(w), i] = x
    norms = np.linalg.norm(dense, axis=1)
    asked = ["w0", "w17", "alone", "twin1", "nowhere", "w0", None]
    queries = spark.createDataFrame([(q,) for q in asked], "q string")
    want = {}
    for q in ("w0", "w17", "alone", "twin1"):
        k = names.index(q)
        sims = [(-round(float(dense[k] @ dense[j] / (norms[k] * norms[j])), 9), names[j]) for j in range(len(names)) if (dense[k] * dense[j]).any()]
        want |= {(q, r): (t, -s) for r, (s, t) in enumerate(sorted(sims)[:6], 1)}
    for long in (shared.LONG, 7):  # 7: documents are cut into slices
        found = shared.similar_by_documents(indexed, freqs, queries, 6, rep, mode, long=long).collect()
        assert {(r.q, r["rank"]): (r.term, r.sim) for r in found} == want and len(found) == len(want)
    assert shared.similar_by_documents(indexed, freqs, queries, 0, rep, mode).collect() == []
    assert shared.similar_by_documents(indexed.limit(0), freqs.limit(0), queries, 5, rep).collect() == []


def test_queries_beyond_a_broadcast(spark, corpus, monkeypatch):
    _, indexed, freqs = corpus
    queries = spark.createDataFrame([("w0",), ("w3",), ("w29",)], "q string")
    small = shared.similar_by_documents(indexed, freqs, queries, 9).collect()
    monkeypatch.setattr(shared, "fits_broadcast", lambda df: False)
    monkeypatch.setattr(shared, "broadcast_if_small", lambda df: df)
    assert sorted(shared.similar_by_documents(indexed, freqs, queries, 9, long=5).collect()) == sorted(small)


def test_no_pair_without_a_common_document(spark):
    """Partial products grow with the documents that hold query terms, not with the vocabulary."""
    docs = spark.createDataFrame([(i, f"a{i} b{i}") for i in range(500)], "doc_id bigint, contents string")
    indexed = terms.with_vectors(docs)
    asked = spark.createDataFrame([(f"a{i}",) for i in range(0, 500, 5)], "q string")
    assert shared._products_in_rows(indexed, asked, "tf").count() == 2 * 100


@pytest.mark.parametrize("rep", shared.REPRESENTATIONS)
def test_few_terms_are_scored_against_frequent_queries(spark, monkeypatch, rep):
    """Terms that cannot reach the floor of a query form no product with it, and the lists are those of all products."""
    rnd = random.Random(5)
    common = [f"c{k}" for k in range(12)]
    rows = [(i % 150, " ".join([*rnd.sample(common, 8), *rnd.choices(common[:4], k=i % 7), f"r{i}", f"m{i % 9}"])) for i in range(300)]
    docs = spark.createDataFrame([*rows, (None, "c1 c2 c3"), (7, "far1 far2")], "doc_id bigint, contents string")
    indexed = terms.with_vectors(docs).cache()
    freqs = terms.doc_freq(indexed).cache()
    queries = spark.createDataFrame([(q,) for q in ("c0", "c5", "m3", "r17", "far1", "nowhere")], "q string")
    asked = queries.distinct()
    norms = shared.document_norms(indexed, freqs, rep)
    want = shared._listed(shared._placed(shared._sims_of_all(indexed, norms, asked, rep, shared.LONG, True), 5)).collect()
    met = []
    count = shared._sims_of

    def counted(cells, marks):
        sims = count(cells, marks)
        met.append(sims.filter("q LIKE 'c%'").count())
        return sims

    monkeypatch.setattr(shared, "_sims_of", counted)
    for head in (6, 14):
        met.clear()
        found = shared.similar_by_documents(indexed, freqs, queries, 5, rep, head=head).collect()
        assert sorted(map(tuple, found)) == sorted(map(tuple, want))
        assert sum(met) < 100  # of over 300 terms with each of two


def test_unknown_representation(corpus):
    with pytest.raises(ValueError):
        shared.term_doc_vectors(corpus[1], corpus[2], "binary")


def points_of(rows):
    return {r.term: {c.place: c.v for c in r.point} for r in rows}


def test_kmeans_is_a_fixed_point_and_the_same_on_any_partitioning(spark, corpus):
    _, indexed, freqs = corpus
    vectors = shared.term_doc_vectors(indexed, freqs, "tf")
    results = []
    for parts in (1, 9):
        found = clusters.term_kmeans(vectors.repartition(parts), 4, rounds=50, width=32).collect()
        results.append(sorted(map(tuple, found)))
    assert results[0] == results[1]
    cluster = {t: c for t, c, _ in results[0]}
    assert set(cluster) == {r.term for r in freqs.collect()} and set(cluster.values()) <= set(range(4))
    points = points_of(clusters.term_points(vectors, 32).collect())
    centres = {}
    for c in set(cluster.values()):
        total = np.zeros(32)
        for t, own in cluster.items():
            if own == c:
                for place, v in points[t].items():
                    total[place] += v
        centres[c] = np.round(total / np.linalg.norm(total) * clusters.ONE)
    for t, c in cluster.items():
        scores = {k: sum(v * centre[p] for p, v in points[t].items()) for k, centre in centres.items()}
        assert scores[c] == max(scores.values())
        assert dict((a, s) for a, _, s in results[0])[t] == pytest.approx(scores[c] / clusters.ONE**2, abs=2e-6)


def test_kmeans_of_groups_apart(spark):
    rows = [(f"{g}{k}", d, 1.0) for g, first in (("a", 0), ("b", 1000), ("c", 2000)) for k in range(20) for d in range(first, first + 40)]
    rows += [("none", 5, 0.0)]
    vectors = spark.createDataFrame(rows, "term string, doc_id bigint, weight double")
    for seed in (1, 2, 3):
        found = clusters.term_kmeans(vectors, 3, seed=seed).collect()
        groups = {}
        for r in found:
            groups.setdefault(r.term[0], set()).add(r.cluster)
        # Clusters that lost all terms took the farthest ones, so each group has its own.
        assert sorted(len(g) for g in groups.values()) == [1, 1, 1] and len(set.union(*groups.values())) == 3
        assert "none" not in {r.term for r in found}


def test_kmeans_multiplies_blocks_of_terms(spark, monkeypatch):
    """Terms get their centres by exact products in the tasks, without a row for each place of a term."""
    rng = np.random.default_rng(4)
    points = {f"t{i}": {int(p): int(rng.integers(-(1 << 20), 1 << 20)) for p in rng.choice(8, 3, replace=False)} for i in range(50)}
    rows = [(t, sorted(cells.items())) for t, cells in points.items()]
    frame = spark.createDataFrame(rows, "term string, point array<struct<place: int, v: bigint>>").repartition(3)
    centres = rng.integers(-(1 << 20), 1 << 20, (5, 8))
    centres[4] = centres[1]  # the first of two equal ones is taken
    monkeypatch.setattr(clusters, "_BLOCK", 64)
    expected = {t: [sum(v * int(c[p]) for p, v in cells.items()) for c in centres] for t, cells in points.items()}
    given = clusters._assigned(frame, centres.astype(float))
    for r in given.collect():
        assert (r.cluster, r.score) == (expected[r.term].index(max(expected[r.term])), max(expected[r.term]))
        assert {c.place: c.v for c in r.point} == points[r.term]
    sums = clusters._sums(frame, centres.astype(float))
    total = {}
    for t, cells in points.items():
        for p, v in cells.items():
            key = expected[t].index(max(expected[t])), p
            total[key] = total.get(key, 0) + v
    assert {(r.cluster, r.place): r.v for r in sums.collect()} == total
    assert "Generate" not in sums._jdf.queryExecution().optimizedPlan().toString()


def test_kmeans_of_few_terms(spark):
    empty = spark.createDataFrame([], "term string, doc_id bigint, weight double")
    assert clusters.term_kmeans(empty, 5).collect() == []
    two = spark.createDataFrame([("x", 1, 2.0), ("y", 2, 1.0)], "term string, doc_id bigint, weight double")
    assert sorted(r.cluster for r in clusters.term_kmeans(two, 5).collect()) == [0, 1]
    same = spark.createDataFrame([("x", 1, 2.0), ("y", 1, 1.0)], "term string, doc_id bigint, weight double")
    assert [r.cluster for r in clusters.term_kmeans(same, 2, rounds=4).collect()] == [0, 0]
    with pytest.raises(ValueError):
        clusters.term_kmeans(same, 0)
