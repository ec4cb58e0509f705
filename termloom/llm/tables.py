"""Small DataFrame helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from termloom.session import package_on_path


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_fold(column: str, folds: int) -> Column:
    """crc32 of the value as text, modulo ``folds``; null for null."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % folds


def held_out(column: str, folds: int) -> Column:
    """True in the fold that is kept from learning; a null key is never held out."""
    return F.coalesce(crc_fold(column, folds) == 0, F.lit(False))


def text_size(docs: DataFrame, text: str = "text") -> tuple[int, int]:
    """Rows, and bytes of text in all."""
    found = docs.agg(
        F.count("*").alias("rows"), F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).alias("bytes")
    ).first()
    return found["rows"], found["bytes"]


BATCH_ROWS = 1000  # rows that go to a Python worker at once, some megabytes of documents
# Large arrays go back to the system when they are freed, instead of staying with an idle worker.
_WORKER_MEMORY = {
    "MALLOC_MMAP_THRESHOLD_": str(4 << 20),
    "MALLOC_TRIM_THRESHOLD_": str(16 << 20),
    "ARROW_DEFAULT_MEMORY_POOL": "system",
}


def ready(spark: SparkSession) -> None:
    """Prepare the workers of this session: small batches, memory that is given back, and the
    package on their path where it is not installed."""
    package_on_path(spark)
    spark.sparkContext.environment.update(_WORKER_MEMORY)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
