"""Term weights and the best terms of one document or of all of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from termloom.functions.weights import idf, tf
from termloom.operators.term_vectors import CONTENTS, doc_freq, term_vectors
from termloom.sizes import BROADCAST_BYTES, BROADCAST_ROWS, broadcast_if_small

WEIGHT_COLUMNS = ("term", "tf", "df", "idf", "tfxidf")

# The three rankings sort one list in turn with a stable sort, so each inherits
# the order before it as its tie-break.
_BY_TERM = (("term", False),)
_BY_TF = (("tf", True),) + _BY_TERM
_BY_DF = (("df", True),) + _BY_TF
HEAD_TERMS, HEAD_LEVELS = 256, 6  # terms that a document's row knows the df of, roughly

RANKINGS = {"tf": _BY_TF, "df": _BY_DF, "tfxidf": (("tfxidf", True),) + _BY_DF}


def ranking(order: str) -> list[Column]:
    if order not in RANKINGS:
        raise ValueError(f"order must be one of {tuple(RANKINGS)}, not {order!r}")
    return [F.desc(c) if falling else F.asc(c) for c, falling in RANKINGS[order]]


def n_docs(docs: DataFrame) -> Column:
    """The corpus size as a scalar subquery: its value is read once, without a join."""
    return docs.agg(F.count("*")).scalar()


def doc_terms(indexed: DataFrame, doc_id: int, field: str = CONTENTS, positions: bool = False) -> DataFrame:
    """The term vector of one document; the filter reaches the scan."""
    return term_vectors(indexed.filter(F.col("doc_id") == doc_id), field, positions)


def _weigh(rows: DataFrame, size: Column, idf_mode: str) -> DataFrame:
    return (
        rows.withColumn("tf", tf(F.col("freq")))
        .withColumn("idf", idf(F.col("df"), size, idf_mode))
        .withColumn("tfxidf", F.col("tf") * F.col("idf"))
        .select("doc_id", *WEIGHT_COLUMNS)
    )


def _split(freqs: DataFrame, max_broadcast: int) -> tuple[DataFrame, DataFrame | None, int]:
    """(common, rare, largest df of a rare term): the terms to broadcast and the others, None if there are none.

    With P rows in all, a term counts as common if it holds P / max_broadcast of them or more; there can
    be no more than max_broadcast common terms. None of the others is heavy enough to load one task.
    """
    size = F.coalesce(F.sum(F.octet_length("term")), F.lit(0))
    found = freqs.agg(F.count("*").alias("terms"), F.sum("df").alias("rows"), size.alias("bytes")).first()
    if found["terms"] <= max_broadcast and found["bytes"] <= BROADCAST_BYTES:
        return freqs, None, 0
    # Long terms (over a kilobyte there is none) lower the number that may be broadcast.
    most = min(max_broadcast, max(1, BROADCAST_BYTES * found["terms"] // max(found["bytes"], 1)), BROADCAST_BYTES >> 10)
    is_common = F.col("df") * most >= F.lit(found["rows"])
    return freqs.filter(is_common), freqs.filter(~is_common), (found["rows"] - 1) // most


def _of_contents(freqs: DataFrame) -> DataFrame:
    if "field" in freqs.columns:
        freqs = freqs.filter(F.col("field") == CONTENTS)
    return freqs.select("term", "df")


def attach_doc_freq(vectors: DataFrame, freqs: DataFrame, max_broadcast: int = BROADCAST_ROWS) -> DataFrame:
    """(doc_id, term, freq) rows with the df of their term; give ``freqs`` as a table.

    A vocabulary of at most ``max_broadcast`` terms is broadcast. Beyond that the common terms are
    broadcast, so the bulk of the rows never moves, and the rows of the others are shuffled by term.
    """
    common, rare, _ = _split(_of_contents(freqs), max_broadcast)
    by_broadcast = vectors.join(F.broadcast(common), "term")
    if rare is None:
        return by_broadcast
    rest = vectors.join(F.broadcast(common.select("term")), "term", "left_anti")
    return by_broadcast.unionByName(rest.join(rare, "term"))


def term_weights(
    indexed: DataFrame,
    freqs: DataFrame,
    idf_mode: str = "default",
    max_broadcast: int = BROADCAST_ROWS,
) -> DataFrame:
    """(doc_id, term, tf, df, idf, tfxidf) of every document.

    ``indexed`` and ``freqs`` are read more than once: give them as tables.
    """
    vectors = term_vectors(indexed).drop("field")
    return _weigh(attach_doc_freq(vectors, freqs, max_broadcast), n_docs(indexed), idf_mode)


def document_weights(
    indexed: DataFrame, corpus: DataFrame, doc_id: int, field: str = CONTENTS, idf_mode: str = "default"
) -> DataFrame:
    """The weights of one document's terms.

    ``indexed`` holds at least that document, with vectors; ``corpus`` is the whole
    corpus, as texts or with vectors. Only terms of the document are counted in it.
    """
    vector = doc_terms(indexed, doc_id, field).drop("field")
    own = broadcast_if_small(vector.select("term"))
    freqs = doc_freq(corpus, (field,), only=own).drop("field")
    return _weigh(vector.join(freqs, "term"), n_docs(corpus), idf_mode)


def weights_by_freqs(
    indexed: DataFrame, freqs: DataFrame, doc_id: int, field: str = CONTENTS, idf_mode: str = "default"
) -> DataFrame:
    """The weights of one document's terms from a stored table of frequencies.

    Of ``indexed`` only that document's vector is read. ``freqs`` (field, term, df) has each term
    once; the vector meets it where it is read.
    """
    vector = doc_terms(indexed, doc_id, field).drop("field")
    own = freqs.filter(F.col("field") == field).select("term", "df")
    return _weigh(own.join(broadcast_if_small(vector), "term"), n_docs(indexed), idf_mode)


def best_terms(weights: DataFrame, order: str, top: int) -> DataFrame:
    """The first ``top`` terms of one document; none for zero or less."""
    return weights.select(*WEIGHT_COLUMNS).orderBy(*ranking(order)).limit(max(top, 0))


def leading_by_tf(indexed: DataFrame, top: int) -> DataFrame:
    """``indexed`` with the vectors cut to the ``top`` terms by tf, ties in term order, in each document's own row.

    That ranking does not ask for df, so only these terms need to meet it.
    """
    cells = F.transform(
        F.arrays_zip("terms", "freqs"), lambda c: F.struct((-tf(c["freqs"])).alias("down"), c["terms"].alias("term"), c["freqs"].alias("freq"))
    )
    first = indexed.select("doc_id", F.slice(F.array_sort(cells), 1, max(top, 0)).alias("first"))
    return first.select("doc_id", F.col("first.term").alias("terms"), F.col("first.freq").alias("freqs"))


def frequent_levels(freqs: DataFrame) -> list[tuple[list[str], int, int]]:
    """The most frequent terms in levels of falling df, each with its least and largest df; the last level, of no
    names, stands for all other terms. Each level has twice the terms of the one before, HEAD_TERMS at most in all."""
    head = _of_contents(freqs).orderBy(F.desc("df"), "term").limit(HEAD_TERMS).collect()
    ends = [HEAD_TERMS >> k for k in range(HEAD_LEVELS - 1, -1, -1)]
    parts = [part for a, b in zip([0, *ends], ends) if (part := head[a:b])]
    levels = [([r["term"] for r in part], part[-1]["df"], part[0]["df"]) for part in parts]
    return [*levels, ([], 1, levels[-1][1] if levels else 1)]


def could_lead(
    indexed: DataFrame, levels: list, rare_df: int, order: str, top: int, idf_mode: str = "default"
) -> DataFrame:
    """(doc_id, term, freq) of the terms that could be among their document's first ``top`` if their df were ``rare_df`` or less.

    Decided in each document's row. A term is worth at least what the least df of its level allows; the
    ``top``-th largest of these values is a floor that a term must reach with the best df it may have.
    """
    size = F.lit(indexed.count())

    def span(least: int, most: int) -> tuple[Column, Column]:
        ends = [F.lit(float(n)) if order == "df" else idf(F.lit(n), size, idf_mode) for n in (least, most)]
        return F.least(*ends), F.greatest(*ends)

    worth = lambda cell, bound: bound if order == "df" else tf(cell["freqs"]) * bound

    def low(cell: Column) -> Column:
        *named, (_, least, most) = levels
        bound = span(least, most)[0]
        for names, least, most in reversed(named):
            bound = F.when(cell["terms"].isin(names), span(least, most)[0]).otherwise(bound)
        return worth(cell, bound)

    best_df = span(1, max(rare_df, 1))[1]
    cells = F.arrays_zip("terms", "freqs")
    floor = F.get(F.sort_array(F.transform(cells, low), asc=False), F.lit(max(top, 1) - 1))
    # A document of fewer terms has no floor. The array of one element computes it once for all terms.
    reach = lambda f: F.filter(cells, lambda c: f.isNull() | (worth(c, best_df) >= f))
    kept = F.flatten(F.transform(F.array(floor), reach))
    return indexed.select("doc_id", F.inline(kept).alias("term", "freq"))


def leading_weights(
    indexed: DataFrame,
    freqs: DataFrame,
    order: str,
    top: int,
    idf_mode: str = "default",
    max_broadcast: int = BROADCAST_ROWS,
) -> DataFrame:
    """Rows of ``term_weights`` that hold the first ``top`` terms of every document by ``order``, for ``best_terms_all``.

    By tf, the vectors are cut before they meet df. By df and tfxidf, terms that are broadcast stay where they
    are, and of the others only those move that ``could_lead``. Zero or less gives no rows.
    """
    ranking(order)
    if top <= 0:
        return term_weights(indexed.limit(0), freqs, idf_mode, max_broadcast)
    if order == "tf":
        return term_weights(leading_by_tf(indexed, top), freqs, idf_mode, max_broadcast)
    common, rare, rare_df = _split(_of_contents(freqs), max_broadcast)
    rows = term_vectors(indexed).drop("field").join(F.broadcast(common), "term")
    if rare is not None:
        few = could_lead(indexed, frequent_levels(freqs), rare_df, order, top, idf_mode)
        few = few.join(F.broadcast(common.select("term")), "term", "left_anti")
        rows = rows.unionByName(few.join(rare, "term"))
    return _weigh(rows, n_docs(indexed), idf_mode)


def best_terms_all(weights: DataFrame, order: str, top: int) -> DataFrame:
    """The first ``top`` terms of every document, with their rank from 1.

    The rank limit is applied in each task before the shuffle by document.
    """
    place = F.row_number().over(W.partitionBy("doc_id").orderBy(*ranking(order)))
    return (
        weights.withColumn("rank", place)
        .filter(F.col("rank") <= max(top, 0))
        .select("doc_id", F.col("rank").cast("bigint").alias("rank"), *WEIGHT_COLUMNS)
    )
