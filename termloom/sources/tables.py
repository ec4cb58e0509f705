"""A corpus held in a table, one text per row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from termloom.functions.content import select_content
from termloom.functions.names import extension
from termloom.sizes import spread


def read_table(spark: SparkSession, path: str, columns: Sequence[str], key: str | None = None) -> DataFrame:
    """Columns of a Parquet table, dealt over all cores if the table is small."""
    rows = spark.read.parquet(path).select(*columns)
    return spread(rows, *([key] if key else []))


def table_corpus(
    rows: DataFrame,
    path: Column,
    text: str = "text",
    doc_id: str | None = "doc_id",
    keep: Sequence[str] = (),
    extensions: Sequence[str] = (),
    top: int = 0,
    bottom: int = 0,
) -> DataFrame:
    """The document form of a table: doc_id, path, contents, sizeKb (bytes), and the
    columns to ``keep`` as keyword fields. The same choices as for files apply."""
    named = rows.withColumn("path", path)
    if extensions:
        named = named.filter(extension(F.col("path")).isin(*extensions))
    key = [F.col(doc_id).alias("doc_id")] if doc_id else []
    return named.select(
        *key,
        "path",
        select_content(F.col(text), top, bottom).alias("contents"),
        F.octet_length(text).cast("double").alias("sizeKb"),
        *keep,
    )
