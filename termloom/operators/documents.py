"""Adding, replacing and merging documents, and numbering them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window as W, functions as F

from termloom.session import materialize
from termloom.sizes import BROADCAST_ROWS, broadcast_if_small, fits_broadcast

# monotonically_increasing_id: the task above these bits, the place in it below.
_PLACE_BITS = 33


def add_documents(existing: DataFrame, new: DataFrame) -> DataFrame:
    """All rows of both; a path met twice stays twice. A field that only one side has is null in
    the rows of the other."""
    return existing.unionByName(new, allowMissingColumns=True)


def last_per_key(new: DataFrame, key: str, order: str | None) -> DataFrame:
    """One row per key: the one with the highest ``order``, or the last row if there is none.

    The keys are counted first, on their own. Only rows whose key repeats are ranked, so the
    contents of the others never move; the rank limit applies in each task before the shuffle,
    and a key that fills a third of the rows arrives as one row per task. ``new`` is read more
    than once: without an ``order`` give it as a table.
    """
    counted = new.groupBy(key).count().filter("count > 1").select(key)
    repeated = materialize(counted, "repeated-keys")
    if repeated.isEmpty():
        return new
    placed = new.withColumn("_order", F.col(order) if order else F.monotonically_increasing_id())
    ranked = F.row_number().over(W.partitionBy(key).orderBy(F.desc("_order")))
    again = placed.join(broadcast_if_small(repeated), key, "left_semi")
    last = again.withColumn("_rank", ranked).filter(F.col("_rank") == 1).drop("_rank", "_order")
    # Rows without a key are kept as they are.
    return without_keys(new, repeated, key).unionByName(last.select(*new.columns))


def without_keys(
    existing: DataFrame, keys: DataFrame, key: str = "path", max_broadcast: int = BROADCAST_ROWS
) -> DataFrame:
    """The rows of ``existing`` whose key is not among the distinct ``keys``.

    While the keys fit a broadcast the rows are filtered where they are read.
    Beyond that the keys become a table of their own, and the join shuffles by key,
    where adaptive execution can split a key with very many old rows.
    """
    if fits_broadcast(keys, max_broadcast):
        return existing.join(F.broadcast(keys), key, "left_anti")
    return existing.join(materialize(keys, "upsert-keys"), key, "left_anti")


def upsert_documents(
    existing: DataFrame,
    new: DataFrame,
    key: str = "path",
    order: str | None = None,
    max_broadcast: int = BROADCAST_ROWS,
) -> DataFrame:
    """Replace every row that shares its key with a new row, and add the rest.

    Only the keys of the new rows take part in the join, never their contents.
    """
    kept = without_keys(existing, new.select(key).distinct(), key, max_broadcast)
    return kept.unionByName(last_per_key(new, key, order), allowMissingColumns=True)


def merge_partials(partials: Sequence[DataFrame]) -> DataFrame:
    """Partial results of several roots in one; a path in two of them stays twice, and a field
    that some lack is null there."""
    return reduce(add_documents, partials)


def _numbered(placed: DataFrame, sizes: DataFrame, start: int) -> DataFrame:
    """doc_id = rows of the tasks before + place in the task, for rows with _place.

    ``sizes`` has one row per task, so its window and its broadcast are small: a million tasks
    are some 30 MB.
    """
    before = F.sum("_n").over(W.orderBy("_task").rowsBetween(W.unboundedPreceding, -1))
    shifts = sizes.select("_task", "_n", F.coalesce(before, F.lit(0)).alias("_shift"))
    inside = F.col("_place").bitwiseAND((1 << _PLACE_BITS) - 1)
    known = F.col("_n").isNotNull() & (inside < F.col("_n"))
    number = F.when(known, F.col("_shift") + inside + F.lit(start)).otherwise(
        F.raise_error(F.lit("the rows of a task changed while documents were numbered")).cast("bigint")
    )
    return (
        placed.withColumn("_task", F.shiftright("_place", _PLACE_BITS))
        .join(F.broadcast(shifts), "_task", "left")
        .withColumn("doc_id", number)
        .drop("_task", "_n", "_shift", "_place")
    )


def _task_sizes(placed: DataFrame) -> DataFrame:
    task = F.shiftright("_place", _PLACE_BITS).alias("_task")
    return placed.groupBy(task).agg(F.count("*").alias("_n"))


def number_documents(docs: DataFrame, start: int = 0) -> DataFrame:
    """``docs`` plus a dense doc_id from ``start``, for rows of any origin.

    The rows are written once with their task and place, then numbered, because a
    plan with shuffles may spread its rows differently when it runs again.
    """
    placed = materialize(docs.withColumn("_place", F.monotonically_increasing_id()), "numbering")
    return _numbered(placed, _task_sizes(placed), start)


def number_scan(rows: DataFrame, start: int = 0) -> DataFrame:
    """``number_documents`` for rows straight from a file scan, without writing them.

    A scan cuts the same files into the same tasks each time. The first pass only
    counts, so it reads no contents. Should a task hold more rows later than it was
    counted with, the job fails; two rows never get one number.
    """
    placed = rows.withColumn("_place", F.monotonically_increasing_id())
    return _numbered(placed, materialize(_task_sizes(placed), "task-sizes"), start)
