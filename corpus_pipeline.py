"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept; its decisions take
effect in what it returns, which is written as Parquet and read again for the next. All stages but the
last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from termloom.llm import decontaminate, minhash, packing, quality, suffix
from termloom.llm.tables import read, ready
from termloom.session import new_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts, learned from the labels of those given."""
    ready(spark)
    return quality.keep_good(docs, read(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates: the one with the smallest doc_id."""
    ready(spark)
    return minhash.keep_one_of_each(docs)


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of long strings that start earlier in the corpus too.

    n_chars follows the text; a null text becomes empty. A document of which nothing is left stays, with an empty text.
    """
    ready(spark)
    found = suffix.remove_repeats(docs, [c for c in docs.columns if c != "text"])
    columns = {c: F.col(f"row.{c}") for c in docs.columns if c != "text"} | {"text": F.col("kept_text")}
    length = F.when(F.col("n_removed") > 0, F.length("kept_text")).otherwise(F.col("row.n_chars"))
    columns["n_chars"] = length.cast("bigint")
    return found.select(*(columns[c].alias(c) for c in docs.columns))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark items do not make up a twentieth."""
    ready(spark)
    return decontaminate.keep_clean(docs, read(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences."""
    ready(spark)
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_good_documents),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", remove_repeated_passages),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

# A trained classifier, sampling and suffix sorting are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; each but the last is written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = new_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
