"""Size checks: what may be broadcast, and when a small input needs spreading."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Largest number of short rows (a term or a path with a number or two) that is
# ever broadcast. One row stays near 100 bytes, so the table near 100 MB.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 256 << 20

# Scans below this many bytes per core can sit in one or two row groups, which
# leaves most cores idle; re-dealing so little data is cheap.
SPREAD_BYTES_PER_CORE = 32 << 20
SPREAD_TASKS_PER_CORE = 3
UNKNOWN_BYTES = 1 << 50  # estimates from here on stand for rows of unknown size, such as those of an RDD


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """True if ``df`` has at most ``max_rows`` rows and its texts ``max_bytes`` bytes.

    One aggregate, combined in each task: no row leaves its task for it.
    """
    texts = [F.coalesce(F.octet_length(c), F.lit(0)) for c, t in df.dtypes if t in ("string", "binary")]
    width = sum(texts, F.lit(0)).cast("bigint")
    found = df.agg(F.count("*").alias("rows"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()
    return found["rows"] <= max_rows and found["bytes"] <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if its counted size allows, else unmarked."""
    return F.broadcast(df) if fits_broadcast(df, max_rows) else df


def estimated_bytes(df: DataFrame) -> int | None:
    """The optimizer's size estimate, or None where it has none or cannot be asked (Connect)."""
    try:
        plan = df._jdf.queryExecution().optimizedPlan()
    except AttributeError:
        return None
    size = int(str(plan.stats().sizeInBytes()))
    return size if size < UNKNOWN_BYTES else None


def dealt_tasks(df: DataFrame) -> int:
    """Tasks for the analysis of so many bytes: some per core, none of more than SPREAD_BYTES_PER_CORE."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return max(cores * SPREAD_TASKS_PER_CORE, -(-(estimated_bytes(df) or 0) // SPREAD_BYTES_PER_CORE))


def fullest_share(df: DataFrame) -> float:
    """The part of the rows of a scan that its fullest task holds; of a Parquet table only footers are read."""
    tasks = df.groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n"))
    found = tasks.agg(F.max("n").alias("most"), F.sum("n").alias("all")).first()
    return found["most"] / found["all"] if found["all"] else 0.0


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Re-deal a scan over all cores if it is small, or if row groups leave much of it to one task.

    A corpus of many files or row groups already has more splits than cores, and moving its
    texts would be a full shuffle. A row group is never split: a corpus of one would be analysed
    by a single task, however large it is.
    """
    size = estimated_bytes(df)
    if size is None:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    if size <= cores * SPREAD_BYTES_PER_CORE:
        return df.repartition(cores * SPREAD_TASKS_PER_CORE, *keys)
    if size * fullest_share(df) <= 2 * SPREAD_BYTES_PER_CORE:
        return df
    return df.repartition(dealt_tasks(df))
