"""Terms as vectors over documents, and the terms most similar by the documents they share.

The vector of a term has a weight for each document that holds it: 1 (``bin``), tf, or tf times idf.
Two terms have a product above nothing only if some document holds both, so similarities are sums over
documents: a document that holds a query term gives one partial product for each of its terms, and these
are summed in each task before they move. Pairs of terms without a common document are never formed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from termloom.functions.weights import idf, tf
from termloom.operators.best_terms import attach_doc_freq, n_docs
from termloom.operators.term_vectors import CONTENTS, term_vectors
from termloom.session import materialize
from termloom.sizes import BROADCAST_BYTES, BROADCAST_ROWS, broadcast_if_small, fits_broadcast

REPRESENTATIONS = ("bin", "tf", "tfxidf")
# A document of more distinct terms is cut into slices of so many, which go to different tasks.
LONG = 4096
# The most frequent terms, which are scored against every query first.
HEAD = 512
# Products are summed in no fixed order; similarities are given to so many decimals, where sums agree.
DECIMALS = 9


def _checked(rep: str) -> str:
    if rep not in REPRESENTATIONS:
        raise ValueError(f"rep must be one of {REPRESENTATIONS}, not {rep!r}")
    return rep


def _in_document(freq: Column, rep: str) -> Column:
    """The part of the weight that depends on the document; idf is the same in all of a term's documents."""
    return F.lit(1.0) if rep == "bin" else tf(freq)


def term_doc_vectors(indexed: DataFrame, freqs: DataFrame, rep: str = "tfxidf", idf_mode: str = "default") -> DataFrame:
    """(term, doc_id, weight): the vectors of all terms, one row for each document that holds a term.

    ``indexed`` has vectors (``with_vectors``) and ``freqs`` the df of all terms; tables both.
    """
    rows = term_vectors(indexed).select("term", "doc_id", "freq")
    weight = _in_document(F.col("freq"), _checked(rep))
    if rep == "tfxidf":
        rows = attach_doc_freq(rows, freqs)
        weight = weight * idf(F.col("df"), n_docs(indexed), idf_mode)
    return rows.select("term", "doc_id", weight.alias("weight"))


def document_norms(indexed: DataFrame, freqs: DataFrame, rep: str = "tfxidf", idf_mode: str = "default") -> DataFrame:
    """(term, norm, sign, df): the length of each term's vector without its idf, and the sign of that.

    idf is a constant factor of a term's vector, so it changes no cosine but by its sign. For ``bin`` the
    length follows from df alone.
    """
    known = freqs.filter(F.col("field") == CONTENTS) if "field" in freqs.columns else freqs
    if _checked(rep) == "bin":
        return known.select("term", F.sqrt(F.col("df").cast("double")).alias("norm"), F.lit(1.0).alias("sign"), "df")
    weight = _in_document(F.col("freq"), rep)
    sums = term_vectors(indexed).groupBy("term").agg(F.sum(weight * weight).alias("square"), F.count("*").alias("df"))
    sign = F.signum(idf(F.col("df"), n_docs(indexed), idf_mode)) if rep == "tfxidf" else F.lit(1.0)
    return sums.select("term", F.sqrt("square").alias("norm"), sign.alias("sign"), "df")


def _cells() -> Column:
    return F.arrays_zip("terms", "freqs")


def _products_in_rows(rows: DataFrame, asked: DataFrame, rep: str) -> DataFrame:
    """(q, term, product) of documents that meet the broadcast query terms where they are read."""
    held = rows.select("terms", "freqs", F.inline_outer(_cells()).alias("q", "own")).join(asked, "q")
    pairs = held.select("q", "own", F.inline_outer(_cells()).alias("term", "freq"))
    product = _in_document(F.col("own"), rep) * _in_document(F.col("freq"), rep)
    return pairs.select("q", "term", product.alias("product"))


def _products_in_slices(rows: DataFrame, asked: DataFrame, rep: str, long: int) -> DataFrame:
    """The same of documents cut into slices: every slice meets the query terms of its document."""
    count = F.ceil(F.size("terms") / long).cast("int")
    parts = F.explode(F.sequence(F.lit(0), count - 1))
    cut = rows.filter(F.size("terms") > 0).select("doc_id", "terms", "freqs", parts.alias("part"))
    piece = lambda c: F.slice(c, F.col("part") * long + 1, F.lit(long)).alias(c)
    slices = cut.select("doc_id", "part", piece("terms"), piece("freqs"))
    named = slices.select("doc_id", "part", F.inline(_cells()).alias("q", "own")).drop("part")
    # The holders come from slices too, so that no row with a whole long vector is multiplied.
    counts = rows.select("doc_id", count.alias("parts"))
    holders = named.join(asked, "q").join(counts, "doc_id")
    holders = holders.select("doc_id", "q", "own", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    met = slices.join(holders, ["doc_id", "part"])
    pairs = met.select("q", "own", F.inline(_cells()).alias("term", "freq"))
    product = _in_document(F.col("own"), rep) * _in_document(F.col("freq"), rep)
    return pairs.select("q", "term", product.alias("product"))


def _products(indexed: DataFrame, asked: DataFrame, rep: str, long: int, small: bool) -> DataFrame:
    """(q, term, product) of all terms that share a document with a query term."""
    rows = indexed.select("doc_id", "terms", "freqs", "n_terms")
    if not small:
        return _products_in_slices(rows, asked, rep, long)
    asked = F.broadcast(asked)
    near = _products_in_rows(rows.filter(F.col("n_terms") <= long), asked, rep)
    return near.unionByName(_products_in_slices(rows.filter(F.col("n_terms") > long), asked, rep, long))


def _cells_of(indexed: DataFrame, marks: DataFrame, rep: str) -> DataFrame:
    """(row, id, weight, asked, listed, df, least): what the documents hold of the terms in ``marks``, as a table.

    Documents are told apart by a number of their row, as a doc_id may repeat.
    """
    rows = indexed.select(F.monotonically_increasing_id().alias("row"), "terms", "freqs")
    cells = rows.select("row", F.inline_outer(_cells()).alias("term", "freq"))
    known = F.broadcast(marks.select("term", "id", "asked", "listed", "df", "least"))
    weight = _in_document(F.col("freq"), rep).alias("weight")
    return materialize(cells.join(known, "term").select("row", "id", weight, "asked", "listed", "df", "least"), "cells")


def _sims_of(cells: DataFrame, marks: DataFrame) -> DataFrame:
    """(q, term, sim) of the asked and the listed terms of ``marks`` that share a document."""
    own = cells.filter("asked").select("row", F.col("id").alias("q_id"), F.col("weight").alias("own"), F.col("least").alias("from_df"))
    other = cells.filter("listed").select(F.col("row").alias("at"), "id", "weight", "df")
    met = own.join(other, (F.col("row") == F.col("at")) & (F.col("df") >= F.col("from_df")))
    dots = met.groupBy("q_id", "id").agg(F.sum(F.col("own") * F.col("weight")).alias("dot"))
    other = marks.filter("listed").select("id", "term", "norm", "sign")
    own = marks.filter("asked").select(*(F.col(c).alias(f"q_{c}") for c in ("id", "term", "norm", "sign")))
    return dots.join(F.broadcast(other), "id").join(F.broadcast(own), "q_id").select(F.col("q_term").alias("q"), "term", _cosine().alias("sim"))


def _cosine() -> Column:
    cosine = F.col("sign") * F.col("q_sign") * (F.col("dot") / (F.col("norm") * F.col("q_norm")))
    return F.round(cosine, DECIMALS)


def _least_df(cells: DataFrame, marks: DataFrame, floors: DataFrame) -> DataFrame:
    """(q, least): the df that a term needs to reach the ``floor`` of each query.

    A term in n documents has a cosine of at most the length of the query's n largest weights over that of all.
    """
    own = cells.filter("asked").groupBy("id", "weight").agg(F.count("*").alias("n"))
    before = W.partitionBy("id").orderBy(F.desc("weight")).rowsBetween(W.unboundedPreceding, -1)
    square = F.col("weight") * F.col("weight")
    steps = own.select(
        "id", "n", square.alias("square"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n_before"),
        F.coalesce(F.sum(square * F.col("n")).over(before), F.lit(0.0)).alias("square_before"),
    )
    named = steps.join(F.broadcast(marks.filter("asked").select("id", F.col("term").alias("q"), "norm")), "id")
    # The margin covers rounding in the sums and in the cosines; it only ever adds terms.
    floor = F.col("floor") - F.lit(10.0 ** (1 - DECIMALS))
    lacks = floor * floor * F.col("norm") * F.col("norm") * F.lit(1 - 1e-9) - F.col("square_before")
    needs = named.join(F.broadcast(floors), "q").withColumn("lacks", lacks).filter(F.col("lacks") <= F.col("square") * F.col("n"))
    step = F.greatest(F.ceil(F.col("lacks") / F.col("square")), F.lit(0))
    return needs.groupBy("q").agg(F.min(F.col("n_before") + step).cast("bigint").alias("least"))


def _placed(scored: DataFrame, top: int) -> DataFrame:
    place = F.row_number().over(W.partitionBy("q").orderBy(F.desc("sim"), F.asc("term")))
    return scored.withColumn("rank", place).filter(F.col("rank") <= max(top, 0))


def similar_by_documents(
    indexed: DataFrame,
    freqs: DataFrame,
    queries: DataFrame,
    top: int,
    rep: str = "tfxidf",
    idf_mode: str = "default",
    long: int = LONG,
    head: int = HEAD,
) -> DataFrame:
    """(q, rank, term, sim): for each query term the ``top`` terms with the largest cosine, ties in term order.

    Only terms that share a document with the query term are listed, itself included; a query that no document
    holds has no list. Cosines are rounded to DECIMALS; where idf is negative or 0, they can be too.
    ``indexed`` and ``freqs`` are tables with one row per doc_id and per term; repeated query words count once.

    The ``head`` terms of the largest df are scored first. The ``top``-th cosine among them is a floor, and it takes
    a certain df to reach it; only other terms of that df or more are scored then. Queries without a floor, or
    with one that a broadcast's worth of terms could reach, are scored against all terms that they meet.
    """
    _checked(rep)
    asked = materialize(queries.select("q").filter("q IS NOT NULL").distinct(), "query-terms")
    norms = materialize(document_norms(indexed, freqs, rep, idf_mode), "norms")
    small = fits_broadcast(asked)
    if not small or top <= 0:
        return _listed(_placed(_sims_of_all(indexed, norms, asked, rep, long, small), top))
    wanted = norms.join(F.broadcast(asked.withColumnRenamed("q", "term")), "term", "left_semi").select("term", F.lit(True).alias("asked"))
    first = norms.orderBy(F.desc("df"), "term").limit(head).select("term", F.lit(True).alias("listed"))
    marks = norms.join(F.broadcast(wanted), "term", "left").join(F.broadcast(first), "term", "left")
    marks = marks.fillna(False, ["asked", "listed"]).filter("asked OR listed")
    marks = materialize(marks.withColumns({"id": F.monotonically_increasing_id(), "least": F.lit(0).cast("bigint")}), "marks")
    cells = _cells_of(indexed, marks, rep)
    sims = materialize(_placed(_sims_of(cells, marks), top), "head-sims").drop("rank")

    floors = sims.groupBy("q").agg(F.count("*").alias("n"), F.min("sim").alias("floor"))
    floors = floors.filter((F.col("n") == top) & (F.col("floor") > 10.0 ** (2 - DECIMALS))).select("q", "floor")
    needs = materialize(_least_df(cells, marks, floors), "least-df")
    # Of total rows, terms with total / most of them or more are at most this many.
    total = norms.agg(F.coalesce(F.sum("df"), F.lit(0))).first()[0]
    needs = needs.filter(F.col("least") > total // min(BROADCAST_ROWS, BROADCAST_BYTES >> 10))
    found = needs.agg(F.count("*").alias("n"), F.min("least").alias("least")).first()
    parts = [sims.join(F.broadcast(needs.select("q")), "q", "left_semi")]
    if found["n"]:
        others = norms.join(F.broadcast(first.select("term")), "term", "left_anti")
        others = others.filter(F.col("df") >= found["least"]).select("term", F.lit(True).alias("listed"))
        others = materialize(others, "other-terms")
        if not others.isEmpty():
            wanted = needs.select(F.col("q").alias("term"), F.lit(True).alias("asked"), "least")
            more = norms.join(F.broadcast(wanted), "term", "left").join(F.broadcast(others), "term", "left")
            more = more.fillna(False, ["asked", "listed"]).filter("asked OR listed")
            more = materialize(more.withColumn("id", F.monotonically_increasing_id()), "marks")
            parts.append(_sims_of(_cells_of(indexed, more, rep), more))
    if found["n"] < marks.filter("asked").count():
        open_ = marks.filter("asked").select(F.col("term").alias("q")).join(F.broadcast(needs.select("q")), "q", "left_anti")
        parts.append(_sims_of_all(indexed, norms, materialize(open_, "open-terms"), rep, long, small))
    return _listed(_placed(reduce(DataFrame.unionByName, parts), top))


def _listed(placed: DataFrame) -> DataFrame:
    return placed.select("q", F.col("rank").cast("bigint").alias("rank"), "term", "sim")


def _sims_of_all(indexed: DataFrame, norms: DataFrame, asked: DataFrame, rep: str, long: int, small: bool) -> DataFrame:
    """(q, term, sim) of all terms that share a document with a query term."""
    dots = _products(indexed, asked, rep, long, small).groupBy("q", "term").agg(F.sum("product").alias("dot"))
    own = norms.join(F.broadcast(asked) if small else asked, norms["term"] == asked["q"], "left_semi")
    own = broadcast_if_small(own.select(F.col("term").alias("q"), F.col("norm").alias("q_norm"), F.col("sign").alias("q_sign")))
    met = dots.join(broadcast_if_small(norms.drop("df")), "term").join(own, "q")
    return met.select("q", "term", _cosine().alias("sim"))
