"""Source mix, whitening and hard negatives against plain versions."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from termloom.llm import mixture, negatives, oracle, whitening
from termloom.llm.tables import ready

VECTORS = "vec_id bigint, embedding array<double>, label int, uid string, cell string"
DOCS = "doc_id bigint, text string, source string, row string, size string, key string"


@pytest.fixture(autouse=True)
def prepared(spark):
    ready(spark)


# --- source mix ------------------------------------------------------------------------------


def shares(sizes, weights=(5, 2, 1), most=3):
    """Targets by resharing what is above the bound again and again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, free, rest = {}, set(names), float(sum(sizes.values()))
    while free:
        unit = rest / sum(weight[s] for s in free)
        over = {s for s in free if unit * weight[s] >= most * sizes[s]}
        if not over:
            return target | {s: unit * weight[s] for s in free}
        for s in over:
            target[s] = float(most * sizes[s])
            rest -= target[s]
        free -= over
    return target


@pytest.fixture(scope="module")
def mixed_rows():
    rnd = random.Random(8)
    rows = [(1, None, "a"), (2, "", "a"), (3, " \t\n\x0b\f\r", "b"), (None, "null id", None), (4, "x" * 20000, "b"), (5, "one two " * 3000, "é")]
    rows += [(100 + k, "w " * rnd.randint(0, 30), rnd.choice(["a", "b", "B", "", "\U0001f600", None])) for k in range(400)]
    rows += [(7, "the same row", "hot")] * 300 + [(None, "no id", "nameless")] * 101
    return rows


def test_source_mix(spark, mixed_rows):
    df = spark.createDataFrame([(*r, "x", "x", "x") for r in mixed_rows], DOCS)
    rows = mixture.taken(df).collect()
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = defaultdict(int)
    for _, t, s in mixed_rows:
        sizes[s] += words(t)
    target = shares(sizes)
    assert sum(target.values()) == pytest.approx(sum(sizes.values()))
    expected = Counter((i, words(t), sizes[s]) for i, t, s in mixed_rows)
    assert Counter((r.doc_id, r.size, r.source_size) for r in rows) == expected
    assert Counter(round(r.target, 6) for r in rows) == Counter(round(target[s], 6) for _, _, s in mixed_rows)
    assert all(0 <= r.taken <= 3 * r.size and (not r.size or r.taken % r.size == 0) for r in rows)
    # Sources are told apart by their sizes; what is taken stays below the target by less than one document.
    assert len(set(sizes.values())) == len(sizes)
    taken, largest = defaultdict(int), defaultdict(int)
    for r in rows:
        taken[r.source_size] += r.taken
        largest[r.source_size] = max(largest[r.source_size], r.size)
    for s, n in sizes.items():
        assert 0 <= target[s] - taken[n] + 1e-6 and (target[s] - taken[n] < largest[n] or not n)
    hot = [r.taken for r in rows if r.doc_id == 7]  # equal rows, of which some are taken
    assert target["hot"] - 3 < sum(hot) <= target["hot"]


def test_source_mix_equals_its_sql_and_does_not_depend_on_partitions(spark, mixed_rows):
    df = spark.createDataFrame([(*r, "x", "x", "x") for r in mixed_rows], DOCS)
    one, many = (sorted(map(tuple, mixture.taken(df.repartition(n)).collect()), key=repr) for n in (1, 13))
    assert one == many
    pdf = df.select("doc_id", "text", "source").toPandas()  # noqa: F841
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", mixed_rows)
    cursor = con.execute(oracle.OP13)
    assert [d[0] for d in cursor.description] == ["doc_id", "size", "source_size", "target", "taken"]
    assert sorted(cursor.fetchall(), key=repr) == one


def test_mixed_documents_keep_their_columns(spark, mixed_rows, monkeypatch):
    df = spark.createDataFrame([(*r, "r", "s", "k") for r in mixed_rows], DOCS)
    expected = Counter()
    for r in mixture.with_taken(df, df.columns).collect():
        expected[tuple(r.row)] += r.passes + r.again if r.size else 0
    found = mixture.mix(df)
    assert found.columns == df.columns
    assert Counter(map(tuple, found.collect())) == +expected
    monkeypatch.setattr(mixture, "fits_broadcast", lambda df: False)  # sources beyond a broadcast are dealt with salts
    assert Counter(map(tuple, mixture.mix(df).collect())) == +expected
    assert mixture.taken(df.limit(0)).collect() == [] == mixture.mix(df.limit(0)).collect()
    blank = mixture.taken(df.filter("text IS NULL OR text = ''")).collect()
    assert blank and all((r.size, r.target, r.taken) == (0, 0, 0) for r in blank)


# --- whitening -------------------------------------------------------------------------------


@pytest.mark.parametrize("values", [[5.0], [1, 1, 1], [4, 3, 2, 1, 0], [2, 2, 2, 1, 1, 0, 0], [1e9, 1, 1e-3], [0, 0], list(range(1, 65))])
def test_spectral_divide_and_conquer(values):
    rng = np.random.default_rng(4)
    basis, _ = np.linalg.qr(rng.standard_normal((len(values), len(values))))
    a = basis @ np.diag(values) @ basis.T
    found, vectors = whitening.spectral((a + a.T) / 2)
    size = max(values) or 1
    assert np.abs(found - np.sort(values)[::-1]).max() <= 1e-13 * size
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-13
    assert np.abs(a @ vectors - vectors * found).max() <= 1e-13 * size


def test_polar_factor():
    a = np.array([[2.0, 1], [1, -3]])
    u = whitening.polar(a)
    values, vectors = np.linalg.eigh(a)
    assert np.abs(u - vectors @ np.diag(np.sign(values)) @ vectors.T).max() < 1e-14


def vectors_of(spark, rows):
    rows = [(i, v and [None if c is None else float(c) for c in v], lab, "x", "y") for i, v, lab in rows]
    return spark.createDataFrame(rows, VECTORS)


def test_whitening(spark):
    rng = np.random.default_rng(2)
    data = rng.standard_normal((300, 6)) * [9, 5, 3, 1, 0.5, 0] + 4  # the last dimension is constant
    rows = [(k, x.tolist(), 0) for k, x in enumerate(data)] + [(5, data[5].tolist(), 0)] * 7 + [(None, data[9].tolist(), 1)]
    bad = [(900, None, 0), (901, [], 0), (902, [1.0, None, 1, 1, 1, 1], 0), (903, [float("nan")] * 6, 0), (904, [float("inf")] * 6, 0), (905, [1e300] * 6, 0)]
    other = [(1000 + k, [float(k), float(k * k)], 0) for k in range(9)]  # another width is a fit of its own
    for part in (1, 6):
        found = whitening.whiten(vectors_of(spark, rows + bad + other).repartition(part), most=4).collect()
        x = np.array([np.floor(64 * np.array(v)).astype(np.int64) + 1_000_000 for _, v, _ in rows])
        n, sums = len(x), x.sum(axis=0)
        centred = x - sums / n
        cov = centred.T @ centred / n
        values, basis = np.linalg.eigh(cov)
        values, basis = values[::-1], basis[:, ::-1]
        six = [r for r in found if r.n == n]
        assert Counter((r.vec_id, r.component) for r in six) == Counter((i, c) for i, _, _ in rows for c in range(1, 5))
        deviations = {i: int(((n * v.astype(object) - sums) ** 2).sum()) for (i, _, _), v in zip(rows, x)}
        by_id = {(i, c): centred[k] @ basis[:, c - 1] / np.sqrt(values[c - 1]) for k, (i, _, _) in enumerate(rows) for c in range(1, 5)}
        signs = {c: np.sign(by_id[0, c] * next(r.whitened for r in six if r.vec_id == 0 and r.component == c)) for c in range(1, 5)}
        for r in six:
            assert r.deviation == deviations[r.vec_id]
            assert r.whitened == pytest.approx(signs[r.component] * by_id[r.vec_id, r.component], abs=1e-9)
            assert r.explained == pytest.approx(values[r.component - 1] / np.trace(cov), rel=1e-9)
            assert r.identity_error < 1e-9
        assert Counter(r.vec_id for r in found if r.n == 9) == Counter({1000 + k: 2 for k in range(9)})
        assert len(found) == len(six) + 18


def test_whitening_without_spread(spark):
    same = vectors_of(spark, [(k, [1.0, 2.0], 0) for k in range(5)])
    assert whitening.whiten(same).collect() == [] == whitening.whiten(same.limit(0)).collect()
    assert whitening.whiten(vectors_of(spark, [(1, [1.0, 2.0], 0)])).collect() == []


def test_deviations_beyond_64_bits():
    x = np.array([[1 << 40, 0]])
    sums = [(1 << 40) + 5, 7]
    assert whitening._exact_deviations(x, 1 << 10, sums) == [None]
    small = whitening._exact_deviations(np.array([[3, 4], [5, 9]]), 2, [8, 13])
    assert small == [(6 - 8) ** 2 + (8 - 13) ** 2, (10 - 8) ** 2 + (18 - 13) ** 2]
    odd = whitening._exact_deviations(np.array([[1 << 30]]), 2, [1])
    assert odd == [((1 << 31) - 1) ** 2]


# --- hard negatives --------------------------------------------------------------------------


def test_cells_come_by_falling_bounds_each_once():
    rng = np.random.default_rng(1)
    for n, m in ((1, 1), (1, 7), (5, 3), (8, 8), (0, 3)):
        u, v = rng.integers(0, 4, n).astype(float), rng.integers(0, 4, m).astype(float)
        found = list(negatives.cells_by_bound(u, v))
        assert sorted((i, j) for _, i, j in found) == [(i, j) for i in range(n) for j in range(m)]
        assert [b for b, _, _ in found] == sorted((b for b, _, _ in found), reverse=True)
        assert all(b == u[i] + v[j] for b, i, j in found)


def test_bounds_hold():
    rng = np.random.default_rng(6)
    x = rng.integers(-300, 300, (500, 6))
    centres = negatives.codebook(x, 9)
    own, far = negatives.nearest(x, centres)
    radius = np.array([far[own == k].max(initial=0) for k in range(len(centres))])
    q = rng.integers(-300, 300, 6)
    low, high = negatives.half_bounds(q, centres, radius)
    assert (low[own] <= x @ q).all() and (x @ q <= high[own]).all()


def plain_negatives(rows, every=100):
    usable = []
    for i, v, lab in rows:
        if i is None or lab is None or v is None or any(c is None or not np.isfinite(c) or abs(c) >= 1 << 18 for c in v):
            continue
        usable.append((i, (lab + 1) % 10 if i % 7 == 0 else lab, [int(np.floor(256 * c)) for c in v]))
    out = Counter()
    for a, (i, lab, q) in enumerate(usable):
        if i % every:
            continue
        score = lambda b: sum(x * y for x, y in zip(q, usable[b][2]))
        others = [b for b in range(len(usable)) if b != a and len(usable[b][2]) == len(q)]
        best = sorted((-score(b), usable[b][0]) for b in others if usable[b][1] == lab)[:5]
        for p, positive in best:
            fits = [(-score(b), usable[b][0]) for b in others if usable[b][1] != lab and 30 * -p <= 100 * score(b) <= 90 * -p]
            for rank, (s, negative) in enumerate(sorted(fits)[:10], 1):
                out[i, positive, rank, negative, -p, -s] += 1
    return out


@pytest.fixture(scope="module")
def labelled():
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((10, 7))
    rows = [(k, (centres[k % 10] + 0.4 * rng.standard_normal(7)).tolist(), k % 10) for k in range(1200)]
    rows += [(2000 + k, rows[40][1], 1) for k in range(150)]  # copies in one cell
    rows += [(100, rows[100][1], 0)] * 3 + [(77, rows[3][1], 4)] * 2
    rows += [(None, rows[0][1], 0), (3000, None, 0), (3001, rows[0][1], None), (3002, [], 1), (3100, [], 1), (3003, [], 2)]
    rows += [(3004, [None] * 7, 1), (3005, [float("nan")] * 7, 1), (3006, [1e30] * 7, 1), (3200, [2.0, 1.0], 3), (3201, [2.0, 1.0], 3), (3202, [1.0, 0.9], 4)]
    rows += [(4000, [0.0] * 7, 5), (4100, [-1.0] * 7, 6)]
    return rows


def test_hard_negatives(spark, labelled, monkeypatch):
    expected = plain_negatives(labelled)
    df = vectors_of(spark, labelled)
    assert Counter(map(tuple, negatives.hard_negatives(df).collect())) == expected
    # Many cells, small blocks, short lists of anchors and several rounds.
    for name, value in {"CELL_ROWS": 8, "BLOCK_ROWS": 16, "QUERY_ROWS": 2, "FIRST_ROWS": 64}.items():
        monkeypatch.setattr(negatives, name, value)
    assert Counter(map(tuple, negatives.hard_negatives(df.repartition(5)).collect())) == expected
    assert negatives.hard_negatives(df.limit(0)).collect() == []
    assert negatives.hard_negatives(df.filter("vec_id < 0")).collect() == []
    assert negatives.hard_negatives(df.filter("vec_id = 300")).collect() == []


def test_far_cells_are_not_asked_for():
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.integers(-20, 20, (100, 4)) + 1000 * np.array(s) for s in ([1, 1, 1, 1], [1, -1, 1, -1], [-1, -1, -1, -1])])
    books = negatives.codebook(x[:, :2], 4), negatives.codebook(x[:, 2:], 4)
    (i, far_a), (j, far_b) = negatives.nearest(x[:, :2], books[0]), negatives.nearest(x[:, 2:], books[1])
    words = len(books[1])
    index = {
        "radius_a": np.array([far_a[i == k].max(initial=0) for k in range(len(books[0]))]),
        "radius_b": np.array([far_b[j == k].max(initial=0) for k in range(words)]),
        "n": np.bincount(i * words + j, minlength=len(books[0]) * words),
    }
    scores = x @ x[0]
    floor = int(np.sort(scores)[-5])
    cells, _ = negatives.next_cells(index, books, x[0], [floor], [negatives._ALL], 0, 10**9)
    assert set((i * words + j)[scores >= floor]) <= set(cells)
    assert index["n"][cells].sum() <= 150
