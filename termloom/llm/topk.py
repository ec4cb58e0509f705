"""Exact top-k inner products by bounds from segment statistics, coarse to fine.

A vector is cut into 1, 4, 16, ... equal segments, at last into pairs of components. For two vectors,
the squared distance is at least the sum over segments of n * ((difference of means)**2 + (difference
of deviations)**2). With the norms known that bounds the inner product from above, and as a norm is made
of the same means and deviations, the bound is n times the inner product of the statistics themselves.
A pair whose bound stays below the k-th exact score known for its query is out; the others go to the
next resolution, and those that survive the finest are scored exactly, in integers. The k-th scores go
on from one block of rows to the next in a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from termloom.session import materialize

TOP = 5
EVERY = 50
BLOCK_ROWS = 4096  # candidates that meet a block of queries at once
QUERY_ROWS = 512
QUERY_BYTES = 64 << 20  # vectors of queries that are broadcast at most
GROUP_SLOTS = 16  # blocks of queries, and
GROUP_BLOCKS = 32  # blocks of rows, that meet under one key beyond that
HELD_SLOTS = 4096  # blocks of queries whose k-th scores a task remembers
SPARSE = 0.1  # share of pairs below which they are multiplied one by one
MOST = 2**63 - 1
_PACKED = "block bigint, width int, n int, ids binary, vectors binary"


def _quantize(column: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """Places of the usable vectors and their components as floor(256 * x), at the ends of 64 bits if beyond them."""
    if not len(column):
        return np.zeros(0, np.int64), []
    lists = column.cast(pa.large_list(pa.float64()))
    offsets = lists.offsets.to_numpy()
    inner = lists.values
    values = np.array(inner.fill_null(np.nan).to_numpy(zero_copy_only=False), np.float64)
    good = np.isfinite(values)
    bad = np.concatenate([[0], np.cumsum(~good)])
    present = ~np.array(lists.is_null().to_numpy(zero_copy_only=False), bool)
    usable = np.flatnonzero(present & (bad[offsets[1:]] == bad[offsets[:-1]]))
    with np.errstate(over="ignore"):
        scaled = np.floor(np.where(good, values, 0) * 256)
    inside = np.abs(scaled) < 2.0**63
    whole = np.where(inside, scaled, 0).astype(np.int64)
    whole[~inside] = np.where(scaled[~inside] > 0, MOST, -MOST - 1)
    return usable, [whole[offsets[i] : offsets[i + 1]] for i in usable]


def _pack_batches(size: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from termloom.llm.words import chunk_number

        sequence = 0
        for batch in batches:
            usable, rows = _quantize(batch.column(1))
            ids = np.asarray(batch.column(0).fill_null(0).to_numpy(zero_copy_only=False), np.int64)[usable]
            known = np.asarray(batch.column(0).is_valid().to_numpy(zero_copy_only=False), bool)[usable]
            widths = np.array([len(r) for r in rows], np.int64)
            for width in np.unique(widths):
                own = np.flatnonzero((widths == width) & known)
                for at in range(0, len(own), size):
                    some = own[at : at + size]
                    matrix = np.stack([rows[i] for i in some])
                    yield pa.record_batch(
                        {
                            "block": pa.array([chunk_number(sequence)], pa.int64()),
                            "width": pa.array([int(width)], pa.int32()),
                            "n": pa.array([len(some)], pa.int32()),
                            "ids": pa.array([ids[some].astype("<i8").tobytes()], pa.binary()),
                            "vectors": pa.array([matrix.astype("<i8").tobytes()], pa.binary()),
                        }
                    )
                    sequence += 1

    return pack


def levels_of(width: int) -> list[int]:
    """Numbers of segments: powers of four that divide the width, then half of it."""
    found, n = [], 1
    while width >= 2 * n and width % n == 0:
        found.append(n)
        n *= 4
    return found + [width // 2] if width > 3 and width % 2 == 0 and found[-1] < width // 2 else found


def statistics(vectors: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Means and deviations of equal segments."""
    parts = vectors.reshape(len(vectors), segments, -1)
    return parts.mean(axis=2), parts.std(axis=2)


def sketch(vectors: np.ndarray, segments: int) -> np.ndarray:
    """Statistics scaled so that the inner product of two sketches bounds that of their vectors."""
    scale = np.sqrt(vectors.shape[1] // segments)
    return np.concatenate(statistics(vectors, segments), axis=1) * scale


def _products(a: np.ndarray, b: np.ndarray, alive: np.ndarray | None, pairs: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Inner products of pairs, in their order: those that are alive, or any given in its place."""
    if alive is not None and len(pairs[0]) > SPARSE * alive.size:
        return (a @ b.T)[alive]
    out = np.empty(len(pairs[0]))
    for at in range(0, len(out), 1 << 16):
        i, j = (p[at : at + (1 << 16)] for p in pairs)
        out[at : at + (1 << 16)] = np.einsum("ij,ij->i", a[i], b[j])
    return out


def _exact(queries: np.ndarray, rows: np.ndarray, alive: np.ndarray | None, pairs: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Integer inner products of pairs, at the ends of 64 bits if beyond them."""
    largest = [max(abs(int(m.max(initial=0))), abs(int(m.min(initial=0)))) for m in (queries, rows)]
    bound = largest[0] * largest[1] * queries.shape[1]
    if bound < 2**53:  # sums in doubles are exact integers
        return _products(queries.astype(np.float64), rows.astype(np.float64), alive, pairs).astype(np.int64)
    out = np.empty(len(pairs[0]), np.int64)
    for at in range(0, len(out), 1 << 14):
        i, j = (p[at : at + (1 << 14)] for p in pairs)
        if bound <= MOST:
            out[at : at + len(i)] = (queries[i] * rows[j]).sum(axis=1)
        else:
            sums = (queries[i].astype(object) * rows[j].astype(object)).sum(axis=1)
            out[at : at + len(i)] = [min(max(int(n), -MOST - 1), MOST) for n in sums]
    return out


def _search(
    queries: np.ndarray, rows: np.ndarray, ids: np.ndarray, own: np.ndarray, top: int, floors: np.ndarray, left: list | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each query its best ``top`` of these rows that reach its floor: (query place, row place, score).

    ``own`` holds, for each query, its place among the rows, or -1. ``floors`` holds the k-th best score
    known for each query, and is raised. ``left`` takes the number of pairs alive after each level.
    """
    alive = np.ones((len(queries), len(rows)), bool)
    inside = np.flatnonzero(own >= 0)
    alive[inside, own[inside]] = False
    levels = levels_of(queries.shape[1])
    a, b = queries.astype(np.float64), rows.astype(np.float64)
    slack = 1e-9 * ((a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :]) + 1e-6  # rounding of the bounds
    new = np.flatnonzero(np.isneginf(floors))
    if levels and len(new) and len(rows) > top + 1:
        # Without a floor: the rows of the best bounds at the finest level give one.
        bounds = sketch(a[new], levels[-1]) @ sketch(b, levels[-1]).T
        bounds[~alive[new]] = -np.inf
        first = np.argpartition(-bounds, top - 1, axis=1)[:, :top]
        pairs = np.repeat(new, top), first.ravel()
        floors[new] = _exact(queries, rows, None, pairs).reshape(len(new), top).min(axis=1)
    for n in levels:
        pairs = np.nonzero(alive)
        bounds = _products(sketch(a, n), sketch(b, n), alive, pairs) + slack[pairs]
        # Scores stop at the ends of 64 bits, and so do bounds.
        alive[pairs] = np.maximum(bounds, -(2.0**63)) >= floors[pairs[0]]
        if left is not None:
            left.append(int(alive.sum()))
    pairs = np.nonzero(alive)
    score = _exact(queries, rows, alive, pairs)
    order = np.lexsort((ids[pairs[1]], -score.astype(object) if (score == -MOST - 1).any() else -score, pairs[0]))
    query = pairs[0][order]
    rank = np.arange(len(order)) - np.searchsorted(query, query)
    kept = order[rank < top]
    last = order[rank == top - 1]
    np.maximum.at(floors, pairs[0][last], score[last].astype(np.float64))
    return pairs[0][kept], pairs[1][kept], score[kept]


def _score_batches(top: int):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                width, slot = row["width"], (row["width"], row["q_slot"])
                ids, places = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["q_places"], "<i8")
                vectors = np.frombuffer(row["vectors"], "<i8").reshape(len(ids), width)
                query_ids, blocks = np.frombuffer(row["q_ids"], "<i8"), np.frombuffer(row["q_blocks"], "<i8")
                queries = np.frombuffer(row["q_vectors"], "<i8").reshape(len(query_ids), width)
                own = np.where(blocks == row["block"], places, -1)
                if slot not in held and len(held) >= HELD_SLOTS:
                    held.clear()
                floors = held.setdefault(slot, np.full(len(queries), -np.inf))
                query, found, scores = _search(queries, vectors, ids, own, top, floors)
                yield pa.record_batch(
                    {
                        "query": pa.array([f"{blocks[q]}:{places[q]}" for q in query.tolist()], pa.string()),
                        "query_id": pa.array(query_ids[query], pa.int64()),
                        "vec_id": pa.array(ids[found], pa.int64()),
                        "score": pa.array(scores, pa.int64()),
                    }
                )

    return score


def _query_batches(every: int):
    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], "<i8")
                vectors = np.frombuffer(row["vectors"], "<i8").reshape(len(ids), row["width"])
                own = np.flatnonzero(ids % every == 0)
                for at in own.tolist():
                    yield pa.record_batch(
                        {
                            "width": pa.array([row["width"]], pa.int32()),
                            "q_block": pa.array([row["block"]], pa.int64()),
                            "q_place": pa.array([at], pa.int64()),
                            "q_id": pa.array([int(ids[at])], pa.int64()),
                            "q_vector": pa.array([vectors[at].tobytes()], pa.binary()),
                        }
                    )

    return pick


def _block_of_queries(key: tuple, rows: pa.Table) -> pa.Table:
    join = lambda c: np.array(rows[c].to_pylist(), "<i8").tobytes()
    return pa.table(
        {
            "width": pa.array([key[0].as_py()], pa.int32()),
            "q_slot": pa.array([key[1].as_py()], pa.int64()),
            "q_blocks": pa.array([join("q_block")], pa.binary()),
            "q_places": pa.array([join("q_place")], pa.binary()),
            "q_ids": pa.array([join("q_id")], pa.binary()),
            "q_vectors": pa.array([b"".join(rows["q_vector"].to_pylist())], pa.binary()),
        }
    )


def top_k(vectors: DataFrame, top: int = TOP, every: int = EVERY, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The ``top`` best other rows of each row whose key ``every`` divides: query_id, rank, vec_id, score.

    Scores are integer inner products of floor(256 * x); ties go to the smaller key. Null vectors, and
    vectors with a null or non-finite component, take no part, nor do rows with a null key. Vectors meet
    only vectors of their width. Rows that repeat are rows of their own: each is a query, and a candidate
    for the others. Fewer candidates than ``top`` give fewer rows; an empty table gives none.

    Components and scores beyond 64 bits stop at their ends, as Spark's casts do.

    Queries are dealt into blocks of bounded size, and each block of queries meets each block of rows: by
    broadcast while the counted bytes of all queries allow it, else by a join of groups of both, whose keys
    hold a bounded number of blocks.
    """
    rows = vectors.select(F.col(key).cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    packed = materialize(rows.mapInArrow(_pack_batches(BLOCK_ROWS), _PACKED), "vectors")
    picked = packed.mapInArrow(
        _query_batches(every), "width int, q_block bigint, q_place bigint, q_id bigint, q_vector binary"
    )
    picked = materialize(picked, "queries")
    size = F.coalesce(F.sum(F.octet_length("q_vector")), F.lit(0))
    asked = picked.agg(F.count("*").alias("rows"), size.alias("bytes")).first()
    slots = max(1, -(-asked["rows"] // QUERY_ROWS))
    dealt = picked.withColumn("q_slot", F.pmod(F.xxhash64("q_block", "q_place"), F.lit(slots).cast("bigint")))
    queries = dealt.groupBy("width", "q_slot").applyInArrow(
        _block_of_queries, "width int, q_slot bigint, q_blocks binary, q_places binary, q_ids binary, q_vectors binary"
    )
    met = _meet(packed, queries, slots, asked["bytes"])
    found = met.mapInArrow(_score_batches(top), "query string, query_id bigint, vec_id bigint, score bigint")
    best = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _meet(packed: DataFrame, queries: DataFrame, slots: int, query_bytes: int) -> DataFrame:
    """Each block of rows with each block of queries of its width."""
    spark = packed.sparkSession
    blocks = packed.count()
    columns = ["block", "width", "ids", "vectors", "q_slot", "q_blocks", "q_places", "q_ids", "q_vectors"]
    if query_bytes <= QUERY_BYTES:
        tasks = max(2 * spark.sparkContext.defaultParallelism, -(-blocks // GROUP_BLOCKS))
        return packed.repartition(tasks, "block").join(F.broadcast(queries), "width").select(*columns)
    parts, groups = max(1, -(-blocks // GROUP_BLOCKS)), -(-slots // GROUP_SLOTS)
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = packed.withColumn("part", F.pmod(F.xxhash64("block"), F.lit(parts)).cast("int")).withColumn("group", each(groups))
    right = queries.withColumn("group", F.pmod("q_slot", F.lit(groups)).cast("int")).withColumn("part", each(parts))
    return left.join(right, ["width", "group", "part"]).select(*columns)
