"""From documents to terms: tokens, term vectors, keyword terms, vocabulary, df.

A document is one row, so its term vector is built inside that row, in the scan
stage: the token array is sorted and cut into runs of equal terms. Nothing is
shuffled until rows of different documents have to meet, as in ``doc_freq``.

Vectors are kept as parallel arrays (``terms``, ``freqs``, ``positions``), so
that a reader of a stored table opens only the arrays it needs.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from termloom.functions.text import cut_long, tokens

CONTENTS = "contents"
VECTOR_FIELDS = (CONTENTS,)

_FOUND, _TOKENS, _RUNS, _STARTS = "_found", "_tokens", "_runs", "_starts"


def _with_tokens(docs: DataFrame) -> DataFrame:
    return docs.withColumn(_FOUND, tokens(F.col(CONTENTS))).withColumn(
        _TOKENS, cut_long(F.col(_FOUND))
    )


def tokenize(docs: DataFrame) -> DataFrame:
    """(doc_id, pos, term), one row per token; positions count from 0."""
    # The outer form of explode keeps the optimizer from testing the size of the
    # array in a filter of its own, which would tokenize every text twice.
    return (
        _with_tokens(docs)
        .select("doc_id", F.posexplode_outer(_TOKENS).alias("pos", "term"))
        .filter(F.col("term").isNotNull())
        .select("doc_id", F.col("pos").cast("bigint").alias("pos"), "term")
    )


def with_counts(docs: DataFrame) -> DataFrame:
    """``docs`` plus n_tokens and n_terms (distinct), for field statistics."""
    return (
        _with_tokens(docs)
        .withColumn("n_tokens", F.coalesce(F.size(_TOKENS), F.lit(0)).cast("bigint"))
        .withColumn("n_terms", F.coalesce(F.size(F.array_distinct(_TOKENS)), F.lit(0)).cast("bigint"))
        .drop(_FOUND, _TOKENS)
    )


def with_vectors(docs: DataFrame, positions: bool = True) -> DataFrame:
    """``docs`` plus n_tokens, n_terms and the arrays terms, freqs and positions.

    ``terms`` is in term order; ``positions`` (optional) is in text order per term.
    """
    if positions:
        runs = F.sort_array(
            F.transform(_TOKENS, lambda t, i: F.struct(t.alias("term"), i.alias("pos")))
        )
        term_at = lambda i: F.get(_RUNS, i)["term"]
    else:
        runs = F.sort_array(_TOKENS)
        term_at = lambda i: F.get(_RUNS, i)
    size = F.coalesce(F.size(_RUNS), F.lit(0))
    first = lambda i: (i == 0) | (term_at(i) != term_at(i - 1))
    starts = F.when(
        size > 0, F.filter(F.sequence(F.lit(0), size - 1), first)
    ).otherwise(F.array().cast("array<int>"))
    length = lambda start, j: F.coalesce(F.get(_STARTS, j + 1), size) - start
    out = (
        _with_tokens(docs)
        .withColumn(_RUNS, runs)
        .withColumn(_STARTS, starts)
        .withColumn("n_tokens", size.cast("bigint"))
        .withColumn("n_terms", F.size(_STARTS).cast("bigint"))
        .withColumn("terms", F.transform(_STARTS, term_at))
        .withColumn("freqs", F.transform(_STARTS, lambda s, j: length(s, j).cast("bigint")))
    )
    if positions:
        places = lambda s, j: F.transform(F.slice(_RUNS, s + 1, length(s, j)), lambda r: r["pos"])
        out = out.withColumn("positions", F.transform(_STARTS, places))
    return out.drop(_FOUND, _TOKENS, _RUNS, _STARTS)


def term_vectors(indexed: DataFrame, field: str = CONTENTS, positions: bool = False) -> DataFrame:
    """Long form (field, doc_id, term, freq[, positions]) of ``with_vectors`` rows.

    A field without term vectors gives no rows.
    """
    arrays = ["terms", "freqs"] + (["positions"] if positions else [])
    names = ["term", "freq"] + (["positions"] if positions else [])
    rows = indexed if field in VECTOR_FIELDS else indexed.limit(0)
    return (
        rows.select("doc_id", F.inline_outer(F.arrays_zip(*arrays)).alias(*names))
        .filter(F.col("term").isNotNull())
        .select(F.lit(field).alias("field"), "doc_id", *names)
    )


def keyword_terms(docs: DataFrame, fields: Sequence[str]) -> DataFrame:
    """(field, doc_id, term, freq): the whole value of a keyword field is one term."""
    cells = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"`{f}`").alias("term")) for f in fields])
    return (
        docs.select("doc_id", F.inline(cells))
        .filter(F.col("term").isNotNull())
        .select("field", "doc_id", "term", F.lit(1).cast("bigint").alias("freq"))
    )


def _terms_per_document(docs: DataFrame) -> DataFrame:
    """One row (term) per document and distinct term, from texts or stored arrays."""
    if "terms" in docs.columns:
        rows = docs.select(F.explode_outer("terms").alias("term"))
    else:
        rows = _with_tokens(docs).select(F.explode_outer(F.array_distinct(_TOKENS)).alias("term"))
    return rows.filter(F.col("term").isNotNull())


def vocabulary(docs: DataFrame, field: str = CONTENTS) -> DataFrame:
    """Distinct terms of a field over all term vectors."""
    rows = _terms_per_document(docs).distinct()
    return rows if field in VECTOR_FIELDS else rows.limit(0)


def doc_freq(
    docs: DataFrame, fields: Sequence[str] = (CONTENTS,), only: DataFrame | None = None
) -> DataFrame:
    """(field, term, df) of every term of the given fields.

    Counts are combined before the shuffle, so a term that every document holds
    arrives as one row per task. ``only`` (term) keeps the listed terms, and drops
    the others before the shuffle.
    """
    parts = []
    keywords = [f for f in fields if f not in VECTOR_FIELDS]
    if CONTENTS in fields:
        parts.append(_terms_per_document(docs).select(F.lit(CONTENTS).alias("field"), "term"))
    if keywords:
        parts.append(keyword_terms(docs, keywords).select("field", "term"))
    if not parts:
        parts = [docs.select(F.lit("").alias("field"), F.lit("").alias("term")).limit(0)]
    rows = reduce(DataFrame.unionByName, parts)
    if only is not None:
        rows = rows.join(only, "term", "left_semi")
    return rows.groupBy("field", "term").agg(F.count("*").alias("df"))
