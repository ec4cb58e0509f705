"""Whitening of vectors by spectral divide and conquer with polar decompositions.

The covariance is summed in Spark, centred first. On the driver, where it has as many rows as a vector
has entries, its eigenvectors are found without a library's eigensolver: the polar factor U of the
covariance less a shift has eigenvalues +1 and -1, so (I + U) / 2 projects on the eigenvectors above the
shift. The factor comes from QDWH, an iteration of QR factorisations with weights that follow a lower
bound of the singular values. The two invariant subspaces are split again until each has one
dimension, or only one eigenvalue. Components are then broadcast and every row is projected on them.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
_EPS = np.finfo(np.float64).eps
_SUM_TASKS = 64  # shares of so many tasks are summed first
_LARGEST = 1 << 52  # entries beyond it in size would not be whole numbers in doubles

# --- eigenvectors ----------------------------------------------------------------------------


def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix by QDWH; singular directions come out short of 1."""
    n = len(a)
    x = a / max(np.linalg.norm(a), np.finfo(np.float64).tiny)
    # Singular values are at least this; a smaller one only takes more rounds.
    low = max(1.0 / (np.linalg.norm(np.linalg.inv(x)) if _regular(x) else np.inf), _EPS)
    for _ in range(60):
        square = low * low
        d = np.cbrt(4 * (1 - square) / (square * square)) if low < 1 else 0.0
        root = np.sqrt(1 + d)
        alpha = root + 0.5 * np.sqrt(max(0.0, 8 - 4 * d + 8 * (2 - square) / (square * root)))
        beta = (alpha - 1) ** 2 / 4
        gamma = alpha + beta - 1
        q, _ = np.linalg.qr(np.concatenate([np.sqrt(gamma) * x, np.eye(n)]))
        new = beta / gamma * x + (alpha - beta / gamma) / np.sqrt(gamma) * (q[:n] @ q[n:].T)
        new = (new + new.T) / 2
        step = np.linalg.norm(new - x)
        x = new
        low = min(1.0, low * (alpha + beta * square) / (1 + gamma * square))
        if step <= 4 * _EPS * np.sqrt(n) or (abs(1 - low) < 10 * _EPS and step < 1e-8):
            break
    return x


def _regular(x: np.ndarray) -> bool:
    return np.linalg.cond(x, 1) < 1 / _EPS


def _split(a: np.ndarray, size: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Bases of the invariant subspaces above and below a shift; None if all eigenvalues are one (to rounding)."""
    n = len(a)
    centre = np.trace(a) / n
    spread = np.linalg.norm(a - centre * np.eye(n))
    if spread <= 8 * _EPS * n * size:
        return None
    # The mean of the eigenvalues lies between them. An eigenvalue at the shift itself gives no sign: move a little.
    width = spread / np.sqrt(n)
    for move in (0.0, 0.05, -0.05, 0.13, -0.13, 0.29, -0.29, 0.41, -0.41):
        u = polar(a - (centre + move * width) * np.eye(n))
        if np.linalg.norm(u @ u - np.eye(n)) > 1e-10 * n:
            continue
        above = int(round((np.trace(u) + n) / 2))
        if not 0 < above < n:
            continue
        projector = (u + np.eye(n)) / 2
        # Columns of the projector span the subspace: a first basis from a fixed random mix, then once more for digits.
        mixed = projector @ np.random.default_rng(n).standard_normal((n, above))
        basis, _ = np.linalg.qr(projector @ np.linalg.qr(mixed)[0])
        whole, _ = np.linalg.qr(np.concatenate([basis, (np.eye(n) - projector) @ np.random.default_rng(n + 1).standard_normal((n, n - above))], axis=1))
        rest, _ = np.linalg.qr(whole[:, above:] - basis @ (basis.T @ whole[:, above:]))
        if np.linalg.norm(basis.T @ a @ rest) <= 1e-12 * n * size:
            return basis, rest
    raise ArithmeticError("no shift splits the spectrum")


def spectral(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors in columns, of a symmetric matrix.

    The largest entry of each vector is positive. Blocks wait in a list, not in nested calls.
    """
    n = len(a)
    a = (a + a.T) / 2
    size = float(np.linalg.norm(a))
    waiting, vectors = [(a, np.eye(n))] if n else [], []
    while waiting:
        block, basis = waiting.pop()
        parts = _split(block, size) if len(block) > 1 and size > 0 else None
        if parts is None:
            vectors.append(basis)
            continue
        for part in parts:
            own = part.T @ block @ part
            waiting.append(((own + own.T) / 2, basis @ part))
    found = np.concatenate(vectors, axis=1) if vectors else np.zeros((n, 0))
    # Products of many bases drift by rounding; one Newton step makes the vectors orthonormal again.
    found = found @ (1.5 * np.eye(n) - 0.5 * (found.T @ found))
    values = np.einsum("ij,ij->j", found, a @ found)
    order = np.argsort(-values, kind="stable")
    values, found = values[order], found[:, order]
    signs = np.sign(found[np.abs(found).argmax(axis=0), np.arange(n)]) if n else np.ones(0)
    return values, found * np.where(signs == 0, 1, signs)


# --- vectors ---------------------------------------------------------------------------------


def _usable(ids: pa.Array, column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the usable rows of each width, and their entries as whole numbers."""
    if not len(column):
        return
    lists = column.cast(pa.large_list(pa.float64()))
    offsets, inner = lists.offsets.to_numpy(), lists.values
    values = np.array(inner.fill_null(np.nan).to_numpy(zero_copy_only=False), np.float64)
    with np.errstate(invalid="ignore", over="ignore"):
        whole = np.floor(values * SCALE) + SHIFT
        good = np.isfinite(values) & (np.abs(whole) < _LARGEST)
    bad = np.concatenate([[0], np.cumsum(~good)])
    widths = np.diff(offsets)
    fine = np.array(lists.is_valid().to_numpy(zero_copy_only=False), bool) & (bad[offsets[1:]] == bad[offsets[:-1]])
    for width in np.unique(widths[fine & (widths > 0)]).tolist():
        rows = np.flatnonzero(fine & (widths == width))
        yield rows, whole[offsets[rows][:, None] + np.arange(width)].astype(np.int64)


def _shares(name: str, of: "dict[int, object]") -> pa.RecordBatch:
    task = TaskContext.get().partitionId()
    widths = sorted(of)
    return pa.record_batch(
        {
            "width": pa.array(widths, pa.int32()),
            "task": pa.array([task] * len(widths), pa.int64()),
            "share": pa.array([pickle.dumps(of[w], 5) for w in widths], pa.binary()),
        }
    )


_SHARES = "width int, task bigint, share binary"


def _combined(shares: DataFrame, add) -> dict[int, object]:
    """The shares of all tasks added up for each width, in the order of tasks: first of _SUM_TASKS tasks each."""

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table["task"].to_pylist(), table["share"].to_pylist()))
        total = pickle.loads(rows[0][1])
        for _, share in rows[1:]:
            total = add(total, pickle.loads(share))
        return pa.table(
            {
                "width": table["width"].slice(0, 1),
                "task": pa.array([rows[0][0]], pa.int64()),
                "share": pa.array([pickle.dumps(total, 5)], pa.binary()),
            }
        )

    first = shares.groupBy("width", F.floor(F.col("task") / _SUM_TASKS)).applyInArrow(lambda t: run(t), _SHARES)
    found = first.groupBy("width").applyInArrow(lambda t: run(t), _SHARES).collect()  # one row per width
    return {r["width"]: pickle.loads(r["share"]) for r in found}


def _sum_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows and exact sums per width."""
    of: dict[int, tuple] = {}
    for batch in batches:
        for _, x in _usable(batch.column(0), batch.column(1)):
            # Below 2**52 each and at most some thousands at once: halves of the bits cannot overflow.
            high, low = (x >> 26).sum(axis=0), (x & ((1 << 26) - 1)).sum(axis=0)
            sums = [(int(h) << 26) + int(l) for h, l in zip(high, low)]
            n, old = of.get(x.shape[1], (0, [0] * x.shape[1]))
            of[x.shape[1]] = (n + len(x), [a + b for a, b in zip(old, sums)])
    if of:
        yield _shares("sums", of)


def _add_sums(a: tuple, b: tuple) -> tuple:
    return a[0] + b[0], [x + y for x, y in zip(a[1], b[1])]


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x less the mean: whole numbers about the nearest one, then the rest of the mean."""
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([(s % n) / n for s in sums])
    return (x - whole).astype(np.float64) - rest


def _moment_batches(prepare):
    """Rows, means and sums of products about the means, per width, merged batch by batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of: dict[int, tuple] = {}
        for batch in batches:
            for _, x in _usable(batch.column(0), batch.column(1)):
                y = prepare(x)
                mean = y.mean(axis=0)
                y = y - mean
                own = (len(y), mean, y.T @ y)
                of[x.shape[1]] = _add_moments(of[x.shape[1]], own) if x.shape[1] in of else own
        if of:
            yield _shares("moments", of)

    return run


def _add_moments(a: tuple, b: tuple) -> tuple:
    n = a[0] + b[0]
    step = b[1] - a[1]
    return n, a[1] + step * (b[0] / n), a[2] + b[2] + np.outer(step, step) * (a[0] * b[0] / n)


def components(covariance: np.ndarray, most: int) -> dict[str, np.ndarray]:
    """The first ``most`` components whose eigenvalue is not 0 (to rounding): vectors, values, shares of the trace."""
    values, vectors = spectral(covariance)
    trace = float(np.trace(covariance))
    kept = np.flatnonzero(values > len(values) * 16 * _EPS * max(values[:1].max(initial=0.0), 0.0))[:most]
    values, vectors = values[kept], vectors[:, kept]
    return {"values": values, "explained": values / trace if len(kept) else values, "project": vectors / np.sqrt(values)}


def _exact_deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sums over dimensions of (n * x - S)**2 as whole numbers; None beyond 64 bits."""
    about = np.array([s // n for s in sums], np.int64)
    rest = np.array([s % n for s in sums], np.int64)
    near = x - about
    largest = (int(np.abs(near).max(initial=0)) + 1) * n
    if largest < 2**31 and largest * largest * x.shape[1] < 2**62:
        far = near * n - rest
        return (far * far).sum(axis=1).tolist()
    out = []
    for row in near.tolist():
        total = sum((n * v - r) ** 2 for v, r in zip(row, rest.tolist()))
        out.append(total if total < 2**63 else None)
    return out


_OUT = (
    "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
)


def _white_batches(models):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in _usable(batch.column(0), batch.column(1)):
                m = models.value[x.shape[1]]
                many = len(m["values"])
                white = centred(x, m["n"], m["sums"]) @ m["project"]
                total = len(rows) * many
                yield pa.record_batch(
                    {
                        "vec_id": batch.column(0).cast(pa.int64()).take(pa.array(np.repeat(rows, many))),
                        "component": pa.array(np.tile(np.arange(1, many + 1, dtype=np.int32), len(rows))),
                        "n": pa.array(np.full(total, m["n"], np.int64)),
                        "deviation": pa.array(_exact_deviations(x, m["n"], m["sums"]), pa.int64()).take(
                            pa.array(np.repeat(np.arange(len(rows)), many))
                        ),
                        "whitened": pa.array(white.reshape(-1)),
                        "explained": pa.array(np.tile(m["explained"], len(rows))),
                        "identity_error": pa.array(np.full(total, m["identity_error"])),
                    }
                )

    return run


def fit(vectors: DataFrame, most: int = COMPONENTS) -> dict[int, dict]:
    """Per width of vectors: n, sums, values, explained, project (columns that whiten), identity_error.

    ``vectors`` has a key and a vector. All usable rows are learned from, in three passes with sums of
    bounded size (width squared): means, covariance about them, and the covariance of what is whitened.
    """
    spark = vectors.sparkSession
    totals = _combined(vectors.mapInArrow(_sum_batches, _SHARES), _add_sums)
    known = spark.sparkContext.broadcast(totals)
    about = _moment_batches(lambda x: centred(x, *known.value[x.shape[1]]))
    moments = _combined(vectors.mapInArrow(about, _SHARES), _add_moments)
    models = {
        w: components(moments[w][2] / moments[w][0], most) | {"n": totals[w][0], "sums": totals[w][1]} for w in moments
    }
    sent = spark.sparkContext.broadcast(models)

    def whiten(x: np.ndarray) -> np.ndarray:
        m = sent.value[x.shape[1]]
        return centred(x, m["n"], m["sums"]) @ m["project"]

    white = _combined(vectors.mapInArrow(_moment_batches(whiten), _SHARES), _add_moments)
    for w, (n, _, products) in white.items():
        models[w]["identity_error"] = float(np.abs(products / n - np.eye(len(products))).max(initial=0.0))
    return models


def whiten(vectors: DataFrame, most: int = COMPONENTS, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row for each vector and component.

    Entries c count as floor(64 * c) + 1000000. Vectors that are null or empty, or hold a null, a non-finite
    entry or one of 2**46 or more in size, take no part. Each width of vectors is a fit of its own. There
    are at most ``most`` components, and none for an eigenvalue of 0: vectors that are all equal, or a
    single one, give no rows, nor does an empty table. A deviation beyond 64 bits is null. Null keys stay
    null; rows that repeat count and come out as often. Other columns are not read. ``vectors`` is
    read four times, so it should be a table.
    """
    rows = vectors.select(F.col(key).cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    models = rows.sparkSession.sparkContext.broadcast(fit(rows, most))
    return rows.mapInArrow(_white_batches(models), _OUT)
