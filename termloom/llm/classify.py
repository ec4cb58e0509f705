"""Shared by the classifiers: bounded training samples, and models as bytes."""

from __future__ import annotations

import pickle
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from termloom.llm.tables import crc_fold

FOLDS = 5  # rows whose crc32(doc_id) leaves 0 modulo FOLDS are never learned from
SAMPLE = 12_000  # labelled documents that a model is fitted on at most: those with the lowest hashes
SAMPLE_BYTES = 128 << 20  # and bytes of their texts, taken in the order of the hashes
TEXT_BYTES = 1 << 20  # longer texts teach nothing


def training_rows(docs: DataFrame, labels: DataFrame, label: str, most: int = SAMPLE) -> DataFrame:
    """(text, label) of at most ``most`` labelled documents, SAMPLE_BYTES in all, outside the held-out fold.

    The ids are drawn first and their texts measured, so that only the sample's texts move. A document with
    several labels has the largest; null labels, ids and texts teach nothing. Of rows with one id the shortest text
    teaches, the first by code point among equals, so that a frequent id weighs no more than others.
    """
    known = (
        labels.select("doc_id", F.col(label).cast("int").alias("label"))
        .filter(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & (crc_fold("doc_id", FOLDS) != 0))
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    drawn = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    sized = docs.select("doc_id", F.octet_length("text").alias("size")).filter(F.col("size") <= TEXT_BYTES)
    # At most ``most`` rows of numbers from here on.
    found = sized.join(F.broadcast(drawn), "doc_id").groupBy("doc_id").agg(F.min("size").alias("size"), F.first("label").alias("label"))
    so_far = F.sum("size").over(Window.orderBy(F.xxhash64("doc_id"), "doc_id"))
    chosen = found.withColumn("so_far", so_far).filter(F.col("so_far") <= SAMPLE_BYTES).drop("so_far")
    texts = docs.select("doc_id", "text", F.octet_length("text").alias("size"))
    same = texts.join(F.broadcast(chosen), ["doc_id", "size"])
    return same.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").alias("label")).select("text", "label")


def fit_in_one_task(rows: DataFrame, fit: Callable[[list[bytes], list[int]], object]) -> object:
    """``fit`` of the texts and labels of a bounded sample, run by one task; None for no rows."""

    def run(table: pa.Table) -> pa.Table:
        from termloom.llm.words import texts_of

        texts, labels = texts_of(table["text"]), table["label"].to_pylist()
        order = sorted(range(len(texts)), key=lambda i: (texts[i], labels[i]))  # the same model from any row order
        model = fit([texts[i] for i in order], [labels[i] for i in order])
        return pa.table({"model": pa.array([pickle.dumps(model)], pa.binary())})

    grouped = rows.withColumn("all", F.lit(1)).groupBy("all")
    found = grouped.applyInArrow(lambda t: run(t), "model binary").first()
    return pickle.loads(found["model"]) if found else None
