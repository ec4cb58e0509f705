"""k-means of terms by the documents that hold them.

A term's vector over all documents is hashed into WIDTH places with signs, which keeps cosines on average,
and brought to unit length. All numbers are then whole (in units of 1 / ONE), so that sums do not
depend on the order in which tasks add them: the same corpus gives the same clusters on any cluster.

The centres are one row of k arrays, whose size the parameters fix; every round sends it to the tasks, which
multiply blocks of terms with the centres as matrices, and sum the terms of a cluster before anything moves.
Each round's centres are a table, so that a lost executor costs one round.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from termloom.session import materialize, package_on_path

WIDTH = 256
ROUNDS = 20
SEED = 17
ONE = 1 << 20
_FINE = 1 << 16  # weights are whole in units of 1 / _FINE
_BLOCK = 1 << 18  # places of dense vectors that a task holds at once


def term_points(weights: DataFrame, width: int = WIDTH, seed: int = SEED) -> DataFrame:
    """(term, point): unit vectors as arrays of (place, value), by place, from (term, doc_id, weight).

    A term that many documents hold is summed by place before it is brought together, so that no row and
    no group has more than ``width`` entries. Terms without any weight have no vector and are left out.
    """
    mark = F.xxhash64("doc_id", F.lit(seed))
    place = F.pmod(mark, F.lit(width)).cast("int")
    sign = F.when(F.shiftright(mark, 62).bitwiseAND(F.lit(1)) == 0, F.lit(1)).otherwise(F.lit(-1))
    whole = (F.round(F.col("weight") * _FINE) * sign).cast("bigint")
    sums = weights.select("term", place.alias("place"), whole.alias("v")).groupBy("term", "place").agg(F.sum("v").alias("v"))
    sums = sums.filter(F.col("v") != 0)
    listed = sums.groupBy("term").agg(F.array_sort(F.collect_list(F.struct("place", "v"))).alias("cells"))
    return listed.select("term", _unit(F.col("cells")).alias("point")).filter(F.size("point") > 0)


def _unit(cells: Column) -> Column:
    """(place, v) cells at length ONE, rounded; cells that round to nothing are left out."""
    value = lambda c: c["v"].cast("double")
    scaled = lambda c, square: F.round(value(c) / F.sqrt(square) * ONE).cast("bigint")
    at = lambda c, square: F.struct(c["place"].alias("place"), scaled(c, square).alias("v"))
    # The sum reaches the last step as a value: it is not formed again for every cell.
    units = F.aggregate(
        cells, F.lit(0.0), lambda s, c: s + value(c) * value(c), lambda square: F.transform(cells, lambda c: at(c, square))
    )
    return F.filter(units, lambda c: c["v"] != 0)


def _dense(cells: Column, width: int) -> Column:
    """An array of ``width`` values from (place, v) cells."""
    values = F.map_from_entries(cells)
    return F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: F.coalesce(F.try_element_at(values, i), F.lit(0).cast("bigint")))


def _as_centres(rows: DataFrame) -> DataFrame:
    """One row with the centres of (cluster, centre), in order, as an array of arrays."""
    return rows.agg(F.array_sort(F.collect_list(F.struct("cluster", "centre"))).alias("c")).select(F.col("c.centre").alias("centres"))


def first_centres(points: DataFrame, k: int, width: int = WIDTH, seed: int = SEED) -> DataFrame:
    """(cluster, centre): the vectors of k terms that a hash with the seed draws; fewer if there are fewer terms."""
    drawn = points.orderBy(F.xxhash64("term", F.lit(seed)), "term").limit(k)
    listed = drawn.agg(F.array_sort(F.collect_list(F.struct("term", "point"))).alias("all"))
    return listed.select(F.posexplode("all").alias("cluster", "at")).select("cluster", _dense(F.col("at.point"), width).alias("centre"))


def _sent(centres: DataFrame) -> np.ndarray:
    """The centres as a matrix (k x width numbers), for the tasks."""
    package_on_path(centres.sparkSession)
    return np.array(centres.first()["centres"], float)


def _blocks(batches: Iterator[pa.RecordBatch], centres: np.ndarray) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """Terms in blocks: their rows, dense vectors, the centre with the largest product (the first of several), and that product.

    All numbers are whole, and no sum of products exceeds ONE * ONE by much, so the products are exact.
    """
    step = max(1, _BLOCK // centres.shape[1])
    for batch in batches:
        for low in range(0, batch.num_rows, step):
            some = batch.slice(low, step)
            point = some.column("point")
            cells, sizes = point.flatten(), point.value_lengths().to_numpy()
            dense = np.zeros((some.num_rows, centres.shape[1]))
            dense[np.repeat(np.arange(some.num_rows), sizes), cells.field("place").to_numpy()] = cells.field("v").to_numpy()
            scores = dense @ centres.T
            cluster = scores.argmax(axis=1)
            yield some, dense, cluster, scores[np.arange(len(cluster)), cluster]


def _assigned(points: DataFrame, centres: np.ndarray) -> DataFrame:
    """(term, point, cluster, score): the centre with the largest product, the first of several."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some, _, cluster, score in _blocks(batches, centres):
            found = [pa.array(cluster, pa.int32()), pa.array(score.astype(np.int64))]
            yield pa.record_batch([*(some.column(c) for c in ("term", "point")), *found], ["term", "point", "cluster", "score"])

    cell = points.schema["point"].dataType.simpleString()
    return points.select("term", "point").mapInArrow(run, f"term string, point {cell}, cluster int, score bigint")


def _sums(points: DataFrame, centres: np.ndarray) -> DataFrame:
    """(cluster, place, v): the sums of the terms of each cluster; a task gives each place once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, met = np.zeros(centres.shape, np.int64), np.zeros(centres.shape, bool)
        for _, dense, cluster, _ in _blocks(batches, centres):
            for k in np.unique(cluster).tolist():
                own = dense[cluster == k]
                total[k] += own.sum(axis=0).astype(np.int64)
                met[k] |= own.any(axis=0)
        k, place = np.nonzero(met)
        yield pa.record_batch([pa.array(k, pa.int32()), pa.array(place, pa.int32()), pa.array(total[k, place])], ["cluster", "place", "v"])

    told = points.select("point").mapInArrow(run, "cluster int, place int, v bigint")
    return told.groupBy("cluster", "place").agg(F.sum("v").alias("v"))  # k * width rows at most


def _next_centres(points: DataFrame, centres: DataFrame, sent: np.ndarray, width: int) -> DataFrame:
    """(cluster, centre) after a round. A cluster that has lost all terms takes the vector of the term farthest from
    its centre: the first such cluster the farthest term, and so on, ties in term order."""
    met = _sums(points, sent).groupBy("cluster").agg(F.array_sort(F.collect_list(F.struct("place", "v"))).alias("cells"))
    moved = materialize(met.select("cluster", _unit(F.col("cells")).alias("cells")), "moved")
    moved = moved.select("cluster", _dense(F.col("cells"), width).alias("centre"))
    old = centres.select(F.posexplode("centres").alias("cluster", "old"))
    joined = old.join(moved, "cluster", "left").select("cluster", "old", "centre")
    lost = [r["cluster"] for r in joined.filter("centre IS NULL").select("cluster").orderBy("cluster").collect()]  # k at most
    taken = F.lit(None).cast("array<bigint>")
    if lost:
        # A term at its centre (but for rounding) is no better as a centre of its own.
        apart = _assigned(points, sent).filter(F.col("score") < ONE * ONE * (1 - 1e-5)).orderBy("score", "term").limit(len(lost))
        apart = apart.select("score", "term", _dense(F.col("point"), width).alias("centre"))
        far = apart.agg(F.array_sort(F.collect_list(F.struct("score", "term", "centre"))).alias("far")).scalar()
        turn = F.array_position(F.array(*map(F.lit, lost)), F.col("cluster")).cast("int") - 1
        taken = F.when(turn >= 0, F.get(far, turn)["centre"])
    return joined.select("cluster", F.coalesce("centre", taken, "old").alias("centre"))


def term_kmeans(
    weights: DataFrame, k: int, rounds: int = ROUNDS, width: int = WIDTH, seed: int = SEED
) -> DataFrame:
    """(term, cluster, sim): the cluster, from 0, of every term of (term, doc_id, weight), and the cosine to its centre.

    Rounds end when one leaves all centres as they are, or after ``rounds``. Ties go to the cluster with the smaller
    number. If there are fewer terms than k, there are as many clusters as terms. Terms whose weights are
    all 0 are in no cluster; no terms give no rows.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    points = materialize(term_points(weights, width, seed), "points")
    centres = materialize(_as_centres(first_centres(points, k, width, seed)), "centres")
    if points.isEmpty():
        return points.select("term", F.lit(0).alias("cluster"), F.lit(0.0).alias("sim"))
    sent = _sent(centres)
    for _ in range(rounds):
        old = sent
        centres = materialize(_as_centres(_next_centres(points, centres, old, width)), "centres")
        sent = _sent(centres)
        if np.array_equal(sent, old):
            break
    given = _assigned(points, sent)
    return given.select("term", "cluster", F.round(F.col("score") / (ONE * ONE), 6).alias("sim"))
