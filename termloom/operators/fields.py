"""Collection statistics and the list of fields, each in one pass over the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from termloom.operators.term_vectors import VECTOR_FIELDS


def corpus_size(docs: DataFrame) -> DataFrame:
    """One row (n_docs)."""
    return docs.agg(F.count("*").alias("n_docs"))


# Sums that add up over any parts of a corpus, per field; the documents themselves stand under ALL_DOCS.
SUMS = ("docCount", "sumTotalTermFreq", "sumDocFreq")
ALL_DOCS = ""


def field_sums(counted: DataFrame, fields: Sequence[str]) -> DataFrame:
    """(field, docCount, sumTotalTermFreq, sumDocFreq) of each of ``fields``, and of all documents.

    ``counted`` carries n_tokens and n_terms, so all fields are summed per row and
    the only exchange is one partial row per task. A keyword field has one term
    of frequency 1 in each document that holds it.
    """
    sums = [F.struct(F.lit(ALL_DOCS).alias("field"), *(F.count("*").alias(c) for c in SUMS))]
    for f in fields:
        if f in VECTOR_FIELDS:
            cells = (
                F.count_if(F.col("n_tokens") > 0),
                F.coalesce(F.sum("n_tokens"), F.lit(0)),
                F.coalesce(F.sum("n_terms"), F.lit(0)),
            )
        else:
            cells = (F.count(F.col(f"`{f}`")),) * 3
        sums.append(F.struct(F.lit(f).alias("field"), *(c.cast("bigint").alias(n) for n, c in zip(SUMS, cells))))
    return counted.agg(F.array(*sums).alias("cells")).select(F.inline("cells"))


def add_sums(parts: DataFrame) -> DataFrame:
    """Sums of fields of several parts as those of the whole; parts may be negative."""
    return parts.groupBy("field").agg(*(F.sum(c).alias(c) for c in SUMS))


def size_of_sums(sums: DataFrame) -> DataFrame:
    """One row (n_docs)."""
    return sums.filter(F.col("field") == ALL_DOCS).agg(F.coalesce(F.sum("docCount"), F.lit(0)).alias("n_docs"))


def stats_of_sums(sums: DataFrame, fields: Sequence[str]) -> DataFrame:
    """(field, maxDoc, docCount, sumTotalTermFreq, sumDocFreq) of those of ``fields`` that hold a value, in their order."""
    place = F.array_position(F.array(*map(F.lit, fields)), F.col("field"))
    held = F.when((F.col("docCount") > 0) & (place > 0), F.struct(place.alias("place"), "field", *SUMS))
    docs = F.max(F.when(F.col("field") == ALL_DOCS, F.col("docCount")))
    one_row = sums.agg(docs.alias("maxDoc"), F.sort_array(F.collect_list(held)).alias("cells"))
    return one_row.select("maxDoc", F.inline("cells")).select("field", "maxDoc", *SUMS)


def field_stats(counted: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Statistics of each non-empty field of ``fields``, in one pass over rows with n_tokens and n_terms."""
    return stats_of_sums(field_sums(counted, fields), fields)


def list_fields(docs: DataFrame, fields: Sequence[str]) -> DataFrame:
    """(ord, field): the fields that hold a value, in the order a walk over the
    documents by doc_id first meets them; ``fields`` is their order in a document.
    """
    first = [
        F.struct(
            F.min(F.when(F.col(f"`{f}`").isNotNull(), F.col("doc_id"))).alias("doc"),
            F.lit(i).alias("place"),
            F.lit(f).alias("field"),
        )
        for i, f in enumerate(fields)
    ]
    met = docs.agg(F.array(*first).alias("cells")).select(
        F.posexplode(
            F.sort_array(F.filter("cells", lambda c: c["doc"].isNotNull()))
        ).alias("ord", "cell")
    )
    return met.select((F.col("ord") + 1).cast("bigint").alias("ord"), F.col("cell.field").alias("field"))


def write_field_list(listed: DataFrame, location: str, output: str) -> None:
    """Save the list as text under its heading; one line per field, so one file."""
    spark = listed.sparkSession
    # Fixed value: the heading of the report, with its spelling.
    heading = f"- Fields avaliable in Index: {location}"
    head = spark.createDataFrame([(-1, heading), (0, "")], "ord bigint, field string")
    (
        head.unionByName(listed)
        .coalesce(1)
        .sortWithinPartitions("ord")
        .select("field")
        .write.mode("overwrite")
        .text(output)
    )
