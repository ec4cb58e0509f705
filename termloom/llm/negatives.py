"""Hard negatives by an inverted multi-index: exact, with cells visited by falling score bounds.

Vectors are cut into two halves, each half has a codebook, and a pair of codewords is a cell. For an
anchor q the inner product with any row of cell (i, j) is at most u[i] + v[j], where u[i] is the product
of the first half of q with the codeword plus the norm of that half times the cluster's radius, and v
the same for the second half. A heap over both lists, sorted, gives cells by falling sums. An anchor
asks for its next cells until these hold enough rows; rows of the cells are scored in blocks; and the
anchor stops once no cell left can change a window: a range of scores of which the best few rows are
wanted. Each round asks for GROW times as many rows as the one before, so there are few.

First the window is all scores, of rows with the anchor's label: the positives. Each positive's score
then sets a window for rows of other labels.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from termloom.session import materialize

SCALE = 256
ANCHORS, FLIPPED, LABELS = 100, 7, 10  # every so manieth is an anchor; labels that move on by one, of so many
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90  # of the positive's score, in hundredths
SAMPLE = 16_384  # rows that codebooks are fitted on, at most
CELL_ROWS, MOST_WORDS = 256, 256  # rows of a cell on average, words of a codebook at most
STEPS = 8  # of k-means
BLOCK_ROWS, QUERY_ROWS = 2048, 256
FIRST_ROWS, GROW = 4096, 4
LIMIT = 1 << 26  # components from here on in size would not give scores of 64 bits
_ALL = 1 << 62

_ROWS = "vec_id bigint, label bigint, width int, x binary"
_CODED = _ROWS + ", cell int, far_a double, far_b double"
_BLOCKS = "width int, cell int, salt int, ids binary, labels binary, uids binary, vectors binary"


def _row_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Usable rows with their components as whole numbers of four bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lists = batch.column(2).cast(pa.large_list(pa.float64()))
        offsets = lists.offsets.to_numpy()
        values = np.array(lists.values.fill_null(np.nan).to_numpy(zero_copy_only=False), np.float64)
        with np.errstate(invalid="ignore", over="ignore"):
            whole = np.floor(values * SCALE)
            good = np.isfinite(values) & (np.abs(whole) < LIMIT)
        bad = np.concatenate([[0], np.cumsum(~good)])
        fine = np.array(lists.is_valid().to_numpy(zero_copy_only=False), bool) & (bad[offsets[1:]] == bad[offsets[:-1]])
        rows = np.flatnonzero(fine)
        ints = np.where(good, whole, 0).astype("<i4")
        yield pa.record_batch(
            {
                "vec_id": batch.column(0).take(pa.array(rows)),
                "label": batch.column(1).take(pa.array(rows)),
                "width": pa.array(np.diff(offsets)[rows].astype(np.int32)),
                "x": pa.array([ints[offsets[k] : offsets[k + 1]].tobytes() for k in rows.tolist()], pa.binary()),
            }
        )


def _matrix(payloads: list[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join(payloads), "<i4").reshape(len(payloads), width)


# --- the index -------------------------------------------------------------------------------


def codebook(x: np.ndarray, words: int) -> np.ndarray:
    """Centres by k-means, beginning at rows spread over the order of ``x``; a centre without rows stays."""
    x = x.astype(np.float64)
    centres = x[np.unique(np.linspace(0, len(x) - 1, words).astype(np.int64))]
    for _ in range(STEPS):
        own, _ = nearest(x, centres)
        many = np.bincount(own, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        centres = np.where(many[:, None] > 0, sums / np.maximum(many, 1)[:, None], centres)
    return centres


def nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of each row, and its distance."""
    x = x.astype(np.float64)
    own = ((centres * centres).sum(axis=1) - 2 * (x @ centres.T)).argmin(axis=1)
    return own, np.sqrt(((x - centres[own]) ** 2).sum(axis=1))


def _fit(words: dict[int, int]):
    def run(table: pa.Table) -> pa.Table:
        width = table["width"][0].as_py()
        x = _matrix(sorted(table["x"].to_pylist()), width)
        books = codebook(x[:, : width // 2], words[width]), codebook(x[:, width // 2 :], words[width])
        return pa.table({"width": table["width"].slice(0, 1), "books": pa.array([pickle.dumps(books, 5)], pa.binary())})

    return run


def _code_batches(books):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widths = batch.column("width").to_numpy(zero_copy_only=False)
            for width in np.unique(widths).tolist():
                own = batch.take(pa.array(np.flatnonzero(widths == width)))
                x = _matrix(own.column("x").to_pylist(), width)
                a, b = books.value[width]
                (i, far_a), (j, far_b) = nearest(x[:, : width // 2], a), nearest(x[:, width // 2 :], b)
                columns = [*own.columns, pa.array((i * len(b) + j).astype(np.int32)), pa.array(far_a), pa.array(far_b)]
                yield pa.record_batch(columns, [*own.schema.names, "cell", "far_a", "far_b"])

    return run


def _pack(table: pa.Table) -> pa.Table:
    """The rows of a part of a cell by vec_id."""
    table = table.sort_by([("vec_id", "ascending"), ("uid", "ascending")])
    whole = lambda c: pa.array([table[c].combine_chunks().to_numpy(zero_copy_only=False).astype("<i8").tobytes()], pa.binary())
    return pa.table(
        {
            **{c: table[c].slice(0, 1) for c in ("width", "cell", "salt")},
            "ids": whole("vec_id"),
            "labels": whole("label"),
            "uids": whole("uid"),
            "vectors": pa.array([b"".join(table["x"].to_pylist())], pa.binary()),
        }
    )


class Index:
    """Rows in cells: ``rows`` (coded), ``blocks`` of a cell's rows, and per width the codebooks, radii and cell sizes."""

    def __init__(self, vectors: DataFrame):
        """``vectors``: vec_id, label, vector. Codebooks come from SAMPLE rows at most; every row is indexed."""
        spark = vectors.sparkSession
        rows = materialize(vectors.mapInArrow(_row_batches, _ROWS), "vectors")
        sizes = {r["width"]: r["n"] for r in rows.groupBy("width").agg(F.count("*").alias("n")).collect()}
        words = {w: int(np.clip(np.ceil(np.sqrt(n / CELL_ROWS)), 4, MOST_WORDS)) for w, n in sizes.items()}
        first = Window.partitionBy("width").orderBy("mark", "x")
        marked = rows.select("width", "x", F.xxhash64("vec_id", "x").alias("mark"))
        sample = marked.withColumn("k", F.row_number().over(first)).filter(F.col("k") <= SAMPLE).drop("k", "mark")
        fitted = sample.groupBy("width").applyInArrow(_fit(words), "width int, books binary").collect()
        self.books = {r["width"]: pickle.loads(r["books"]) for r in fitted}
        sent = spark.sparkContext.broadcast(self.books)
        coded = rows.mapInArrow(_code_batches(sent), _CODED).withColumn("uid", F.monotonically_increasing_id())
        self.rows = materialize(coded, "coded")
        self._measure(spark)
        salts = spark.createDataFrame(
            [(w, int(c), int(n)) for w, m in self.cells.items() for c, n in enumerate(m["salts"]) if n] or [(0, 0, 1)],
            "width int, cell int, salts int",
        )
        self.salts = salts  # at most MOST_WORDS ** 2 rows per width
        dealt = self.rows.join(F.broadcast(salts), ["width", "cell"])
        dealt = dealt.withColumn("salt", F.pmod(F.xxhash64("uid"), F.col("salts")).cast("int"))
        dealt = dealt.select("width", "cell", "salt", "vec_id", "label", "uid", "x")
        packed = dealt.groupBy("width", "cell", "salt").applyInArrow(lambda t: _pack(t), _BLOCKS)
        self.blocks = materialize(packed, "blocks")

    def _measure(self, spark) -> None:
        """Radii of the clusters of both halves, rows of each cell, and blocks that a cell is cut into."""
        self.cells = {}
        for w, (a, b) in self.books.items():
            self.cells[w] = {
                "radius_a": np.zeros(len(a)), "radius_b": np.zeros(len(b)),
                "n": np.zeros(len(a) * len(b), np.int64), "salts": np.zeros(len(a) * len(b), np.int64),
            }
        found = self.rows.groupBy("width", "cell").agg(
            F.count("*").alias("n"), F.max("far_a").alias("far_a"), F.max("far_b").alias("far_b")
        )
        for r in found.collect():  # one row per cell
            m, words = self.cells[r["width"]], len(self.books[r["width"]][1])
            i, j = divmod(r["cell"], words)
            m["radius_a"][i] = max(m["radius_a"][i], r["far_a"])
            m["radius_b"][j] = max(m["radius_b"][j], r["far_b"])
            m["n"][r["cell"]] = r["n"]
            m["salts"][r["cell"]] = -(-r["n"] // BLOCK_ROWS)


# --- which cells -----------------------------------------------------------------------------


def half_bounds(q: np.ndarray, centres: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and the largest product of half a query with any row of each cluster."""
    q = q.astype(np.float64)
    middle = centres @ q
    reach = np.sqrt(q @ q) * radius * (1 + 1e-9) + 1e-6 * (1 + np.abs(middle) * 1e-6)
    return middle - reach, middle + reach


def cells_by_bound(u: np.ndarray, v: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """(u[i] + v[j], i, j) by falling sums. Each pair follows one other in the order of both lists."""
    by_u, by_v = np.argsort(-u, kind="stable").tolist(), np.argsort(-v, kind="stable").tolist()
    if not by_u or not by_v:
        return
    u, v = u.tolist(), v.tolist()
    heap = [(-(u[by_u[0]] + v[by_v[0]]), 0, 0)]
    while heap:
        bound, a, b = heapq.heappop(heap)
        yield -bound, by_u[a], by_v[b]
        if a + 1 < len(by_u):
            heapq.heappush(heap, (-(u[by_u[a + 1]] + v[by_v[b]]), a + 1, b))
        if a == 0 and b + 1 < len(by_v):
            heapq.heappush(heap, (-(u[by_u[0]] + v[by_v[b + 1]]), 0, b + 1))


def next_cells(index: dict, books: tuple, q: np.ndarray, floors: list, highs: list, seen: int, rows: int) -> tuple[list[int], int]:
    """The next cells that can change a window, until they hold ``rows`` rows, and how many are behind them.

    A cell is left out if all its scores lie above every window or below what a window holds already; when no
    window can be changed by the cell that is next, none can by those after it: the windows are certified.
    """
    half = len(q) // 2
    low_a, high_a = half_bounds(q[:half], books[0], index["radius_a"])
    low_b, high_b = half_bounds(q[half:], books[1], index["radius_b"])
    sizes, words = index["n"], len(books[1])
    least = min(floors)
    asked, held = [], 0
    place = 0
    for place, (bound, i, j) in enumerate(cells_by_bound(high_a, high_b)):
        if place < seen:
            continue
        if bound < least or held >= rows:
            return asked, place
        cell = i * words + j
        low = low_a[i] + low_b[j]
        if sizes[cell] and any(bound >= f and low <= h for f, h in zip(floors, highs)):
            asked.append(cell)
            held += int(sizes[cell])
    return asked, place + 1


_PLAN = "uid bigint, label bigint, width int, x binary, lows array<bigint>, highs array<bigint>, floors array<bigint>, seen bigint, cells array<int>"


def _plan_batches(index, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            books, cells = index.value
            asked, seen = [], []
            columns = (batch.column(c).to_pylist() for c in ("width", "x", "highs", "floors", "seen"))
            for width, x, highs, floors, before in zip(*columns):
                q = np.frombuffer(x, "<i4")
                some, now = next_cells(cells[width], books[width], q, floors, highs, before, rows) if floors else ([], before)
                asked.append(some)
                seen.append(now)
            kept = [batch.column(c) for c in ("uid", "label", "width", "x", "lows", "highs", "floors")]
            kept += [pa.array(seen, pa.int64()), pa.array(asked, pa.list_(pa.int32()))]
            yield pa.record_batch(kept, ["uid", "label", "width", "x", "lows", "highs", "floors", "seen", "cells"])

    return run


# --- scores ----------------------------------------------------------------------------------


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whole inner products of all rows of ``a`` with all of ``b``; in doubles where these are exact."""
    if max(np.abs(a).max(initial=0), np.abs(b).max(initial=0)) < 1 << 20 and a.shape[1] < 1 << 12:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


_FOUND = "uid bigint, window int, score bigint, vec_id bigint, row bigint"


def _score_batches(same: bool, top: int):
    """The best rows of each block for each window of each anchor that asked for it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ids, labels, uids = (np.frombuffer(r[c], "<i8") for c in ("ids", "labels", "uids"))
                rows = np.frombuffer(r["vectors"], "<i4").reshape(len(ids), r["width"])
                scores = _products(_matrix([q["x"] for q in r["queries"]], r["width"]), rows)
                out = []
                for q, own in zip(r["queries"], scores):
                    fits = (labels == q["label"]) & (uids != q["uid"]) if same else labels != q["label"]
                    for k, (low, high) in enumerate(zip(q["floors"], q["highs"])):
                        at = np.flatnonzero(fits & (own >= low) & (own <= high))
                        if len(at) > top:  # rows are by vec_id: a stable sort keeps that among ties
                            at = at[np.argsort(-own[at], kind="stable")[:top]]
                        if len(at):
                            out.append((np.full(len(at), q["uid"]), np.full(len(at), k), own[at], ids[at], uids[at]))
                if out:
                    uid, window, score, vec, row = (np.concatenate(c) for c in zip(*out))
                    yield pa.record_batch(
                        [pa.array(uid), pa.array(window.astype(np.int32)), pa.array(score), pa.array(vec), pa.array(row)],
                        ["uid", "window", "score", "vec_id", "row"],
                    )

    return run


def _best(found: DataFrame, top: int) -> DataFrame:
    best = Window.partitionBy("uid", "window").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)


def _score(index: Index, plan: DataFrame, same: bool, top: int) -> DataFrame:
    """What the rows of all cells asked for give; pairs of a block and a bounded list of anchors are dealt evenly."""
    asked = plan.select("width", F.explode("cells").alias("cell"), "uid", "label", "x", "floors", "highs")
    many = asked.groupBy("width", "cell").agg(F.ceil(F.count("*") / QUERY_ROWS).cast("int").alias("slots"))
    many = F.broadcast(materialize(many, "slots"))  # one row per cell at most
    slot = F.pmod(F.xxhash64("uid"), F.col("slots")).cast("int")
    query = F.struct("uid", "label", "x", "floors", "highs")
    lists = asked.join(many, ["width", "cell"]).withColumn("slot", slot)
    lists = lists.groupBy("width", "cell", "slot").agg(F.collect_list(query).alias("queries"))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    lists = lists.join(F.broadcast(index.salts), ["width", "cell"]).withColumn("salt", each("salts")).drop("salts")
    blocks = index.blocks.join(many, ["width", "cell"]).withColumn("slot", each("slots")).drop("slots")
    met = blocks.join(lists, ["width", "cell", "salt", "slot"])
    return _best(met.mapInArrow(_score_batches(same, top), _FOUND), top).drop("rank")


def search(index: Index, queries: DataFrame, same: bool, top: int) -> DataFrame:
    """uid, window, score, vec_id, row, rank: the ``top`` best rows of each window of each query.

    ``queries``: uid, label, width, x, and as arrays the windows' ``lows`` and ``highs``. Rows count if they
    have the query's label and are not itself (``same``), or have another label.
    """
    spark = queries.sparkSession
    sent = spark.sparkContext.broadcast((index.books, index.cells))
    state = queries.select("uid", "label", "width", "x", "lows", "highs", F.col("lows").alias("floors"), F.lit(0).cast("bigint").alias("seen"))
    found, rows = None, FIRST_ROWS
    while True:
        plan = materialize(state.mapInArrow(_plan_batches(sent, rows), _PLAN), "plan").filter(F.size("cells") > 0)
        if plan.isEmpty():
            break
        new = _score(index, plan, same, top)
        found = materialize(new if found is None else _best(found.unionByName(new), top).drop("rank"), "found")
        # A window with as many rows as wanted takes only rows that score as much as its last.
        full = found.groupBy("uid", "window").agg(F.count("*").alias("n"), F.min("score").alias("least"))
        full = full.filter(F.col("n") == top).groupBy("uid").agg(F.map_from_entries(F.collect_list(F.struct("window", "least"))).alias("full"))
        state = plan.drop("cells").join(full, "uid", "left")
        state = state.withColumn("floors", F.transform("lows", lambda low, k: F.coalesce(F.col("full")[k], low))).drop("full")
        rows *= GROW
    if found is None:
        return spark.createDataFrame([], _FOUND + ", rank int")
    return _best(found, top)


def _window(score: str) -> tuple[Column, Column]:
    """The least and largest whole scores from LOW to HIGH hundredths of a score; an empty range below 0."""
    low = F.when(F.col(score) < 0, 1).otherwise(F.expr(f"({LOW} * {score} + 99) div 100"))
    return low.cast("bigint"), F.when(F.col(score) < 0, 0).otherwise(F.expr(f"{HIGH} * {score} div 100")).cast("bigint")


def hard_negatives(
    vectors: DataFrame, every: int = ANCHORS, key: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of all anchors and positives.

    Rows with a null key, label or vector, or a component that is null, not finite or 2**18 or more in size
    take no part. Vectors meet those of their width only, empty ones included. Equal scores go to the smaller
    key. Rows that repeat are rows of their own, as anchors too. A positive below 0 has no window, and anchors
    without another row of their label have no positives; neither gives rows, nor does an empty table. Other
    columns are not read. The result is exact whatever the codebooks are.
    """
    moved = F.when(F.col("vec_id") % FLIPPED == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    rows = vectors.select(
        F.col(key).cast("bigint").alias("vec_id"), F.col(label).cast("bigint").alias("label"),
        F.col(vector).cast("array<double>").alias("vector"),
    )
    rows = rows.filter("vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL").withColumn("label", moved)
    index = Index(rows)
    anchors = index.rows.filter(F.col("vec_id") % every == 0).select("uid", "vec_id", "label", "width", "x")
    whole = anchors.withColumns({"lows": F.array(F.lit(-_ALL)), "highs": F.array(F.lit(_ALL))})
    positives = search(index, whole, True, POSITIVES)
    positives = materialize(positives.select("uid", (F.col("rank") - 1).alias("window"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    low, high = _window("positive_score")
    windows = positives.groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("window", low.alias("low"), high.alias("high")))).alias("w"))
    asking = anchors.join(windows, "uid").select("uid", "label", "width", "x", F.col("w.low").alias("lows"), F.col("w.high").alias("highs"))
    negatives = search(index, asking, False, NEGATIVES)
    negatives = negatives.select("uid", "window", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    named = negatives.join(positives, ["uid", "window"]).join(anchors.select("uid", F.col("vec_id").alias("anchor_id")), "uid")
    return named.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
