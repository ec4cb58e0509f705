"""Character vectors of terms, and the terms most similar to a query term."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from termloom.functions.chars import (
    bag_norm,
    cosine,
    dot_with,
    occurrences,
    squared_norm,
    units,
    word_bag,
)
from termloom.session import materialize, package_on_path
from termloom.sizes import fits_broadcast, spread

# Query words that go to every task at most. More of them are dealt with the words by character and salt.
QUERY_ROWS = 10_000
SALTS = 64

# Products of words and queries that a task forms at once, best scores that it keeps at most, and words
# in one product at most.
PRODUCTS = 1 << 19
KEPT = 1 << 22
BLOCK_WORDS = 1024

# Similarities that the rounds look down to; what no round settles is scored against all words it shares a
# character with.
FLOORS = (0.85, 0.6, 0.3)

# A rank limit up to this size is applied in each task before the shuffle (the
# default of spark.sql.optimizer.windowGroupLimitThreshold). For longer lists the
# words are ranked in this many groups first.
TASK_LIMIT = 1000
RANK_GROUPS = 1000


def _bags(words: DataFrame, word: str = "term") -> DataFrame:
    return words.select(word, units(F.col(word)).alias("bag"))


def _norm() -> Column:
    return F.sqrt(squared_norm(F.col("bag")).cast("double"))


def char_vectors(words: DataFrame, word: str = "term") -> DataFrame:
    """(word, ch, c): how often each character occurs in each of the distinct words."""
    return (
        _bags(words, word)
        .select(word, "bag", F.explode_outer(F.array_distinct("bag")).alias("ch"))
        .filter(F.col("ch").isNotNull())
        .select(word, "ch", occurrences(F.col("bag"), F.col("ch")).alias("c"))
    )


def char_norms(words: DataFrame, word: str = "term") -> DataFrame:
    """(word, norm): square root of the summed squares of the character counts."""
    return _bags(words, word).select(word, _norm().alias("norm"))


def char_cosine(words: DataFrame, query: str) -> DataFrame:
    """(term, sim) of every word against one query word, taken as it is written.

    The query is a constant, so each row is scored where it is.
    """
    bag = word_bag(query)
    sim = cosine(dot_with(F.col("bag"), bag), F.lit(bag_norm(bag)), _norm())
    return _bags(words).select("term", sim.alias("sim"))


def similar_terms(words: DataFrame, query: str, top: int) -> DataFrame:
    """The ``top`` words most similar to the query, ties in term order."""
    return char_cosine(words, query).orderBy(F.desc("sim"), F.asc("term")).limit(max(top, 0))


def term_clusters(
    words: DataFrame, query: str, top: int, rep: str | None = None, k: int | None = None
) -> DataFrame:
    """The same report as ``similar_terms``; ``rep`` and ``k`` are accepted and unused,
    as in the program it stands for, which forms no clusters."""
    return similar_terms(words, query, top)


def _queries(words: DataFrame, queries: DataFrame) -> DataFrame:
    """(q, q_norm, counts, chars) per query word; ``words`` come with their bags.

    ``counts`` maps its characters to their counts. ``chars`` lists them as (cost, ch,
    weight, n): n words hold the character, weight is its part of the squared norm, and
    the cheapest characters per weight come first.
    """
    holders = words.select(F.explode_outer(F.array_distinct("bag")).alias("ch")).filter("ch IS NOT NULL")
    chars = char_vectors(queries, "q")
    known = F.broadcast(chars.select("ch").distinct())
    held = holders.join(known, "ch", "left_semi").groupBy("ch").agg(F.count("*").alias("n"))
    n = F.coalesce(F.col("n"), F.lit(0))
    weight = F.col("c") * F.col("c")
    ordered = (
        chars.join(held, "ch", "left")
        .groupBy("q")
        .agg(
            F.map_from_entries(F.collect_list(F.struct("ch", "c"))).alias("counts"),
            F.sort_array(
                F.collect_list(
                    F.struct((n / weight).alias("cost"), "ch", weight.alias("weight"), n.alias("n"))
                )
            ).alias("chars"),
        )
    )
    return char_norms(queries, "q").withColumnRenamed("norm", "q_norm").join(ordered, "q", "left")


def _up_to(holds) -> Column:
    """Leading entries of ``chars``: an entry stays if ``holds`` of those before it."""
    return F.filter(
        F.coalesce(F.col("chars"), F.expr("slice(chars, 1, 0)")),
        lambda _, i: holds(F.slice("chars", F.lit(1), i)),
    )


def _mask(bag: Column) -> Column:
    """The characters of a bag as 64 bits; two characters may share one."""
    bit = lambda u: F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(F.xxhash64(u), F.lit(64)).cast("int"))
    return F.aggregate(F.array_distinct(bag), F.lit(0).cast("bigint"), lambda m, u: m.bitwiseOR(bit(u)))


def _known_words(words: DataFrame) -> DataFrame:
    """(term, bag, square, norm, mask) of every word."""
    bags = _bags(words).withColumn("square", squared_norm(F.col("bag")))
    return bags.withColumns({"norm": F.sqrt(F.col("square").cast("double")), "mask": _mask(F.col("bag"))})


def _scored(known: DataFrame, probes: DataFrame, small: bool, top: int) -> DataFrame:
    """(q, term, sim) of the pairs with a score of ``floor`` or more that share a character; of a few queries
    (``small``), pairs that cannot be among the ``top`` are left out, as far as a task can tell."""
    if not small:
        return _met(known, probes)
    asked = probes.filter("q IS NOT NULL").select("q", "floor").collect()  # query_rows at most
    package_on_path(known.sparkSession)
    run = _products([r["q"] for r in asked], np.array([r["floor"] for r in asked], float), top)
    return known.select("term", _code_units(F.col("term")).alias("units")).mapInArrow(run, "q string, term string, sim double")


def _code_units(word: Column) -> Column:
    """The UTF-16 units of a word, two bytes each."""
    return F.encode(word, "UTF-16LE")


def _counted(units: np.ndarray, word: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different units, how often each of n words holds each of them, and the norms of the words."""
    found, place = np.unique(units, return_inverse=True)
    counts = np.bincount(word * len(found) + place, minlength=n * len(found)).reshape(n, len(found)).astype(float)
    return found, counts, np.sqrt((counts * counts).sum(axis=1))


def _products(queries: list[str], floors: np.ndarray, top: int):
    """Scores of all words of a task against the queries, as products of matrices of character counts.

    The counts are whole, so products are exact, and scores are the same as ``cosine`` gives. The floor of a query
    rises to its ``top``-th score in the task so far; an equal score is kept, as the order of terms decides.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bags = [np.frombuffer(q.encode("utf-16-le"), np.uint16) for q in queries]
        chars = np.unique(np.concatenate([np.zeros(0, np.uint16), *bags]))
        table = np.zeros((len(chars) + 1, len(bags)))  # the last row is of characters that no query holds
        for k, bag in enumerate(bags):
            np.add.at(table[:, k], np.searchsorted(chars, bag), 1)
        q_norm = np.sqrt((table * table).sum(axis=0))
        place = np.full(1 << 16, len(chars))
        place[chars] = np.arange(len(chars))
        least = floors.copy()
        best = np.full((len(bags), top), -1.0) if len(bags) * top <= KEPT else None
        step = max(1, min(BLOCK_WORDS, PRODUCTS // max(1, len(bags))))
        names = np.array(queries, object)
        for batch in batches:
            batch = batch.filter(batch.column("term").is_valid())
            for low in range(0, batch.num_rows, step):
                some = batch.slice(low, step)
                raw = some.column("units").to_pylist()
                word = np.repeat(np.arange(len(raw)), [len(r) // 2 for r in raw])
                found, counts, norm = _counted(np.frombuffer(b"".join(raw), np.uint16), word, len(raw))
                dot = counts @ table[place[found]]
                sims = np.divide(dot, q_norm * norm[:, None], out=np.zeros_like(dot), where=dot > 0)
                hit = (sims >= least) & (dot > 0)
                if not hit.any():
                    continue
                at, q = np.nonzero(hit)
                terms = some.column("term").take(pa.array(at))
                yield pa.record_batch([pa.array(names[q], pa.string()), terms, pa.array(sims[at, q])], ["q", "term", "sim"])
                if best is not None:
                    rising = np.flatnonzero(hit.any(axis=0))
                    every = np.concatenate([best[rising], sims[:, rising].T], axis=1)
                    best[rising] = np.partition(every, -top, axis=1)[:, -top:]
                    least[rising] = np.maximum(floors[rising], best[rising].min(axis=1))

    return run


def _met(known: DataFrame, probes: DataFrame) -> DataFrame:
    """(q, term, sim) of the pairs with a score of ``floor`` or more whose word holds one of the ``probe`` characters of q.

    A pair is taken where its word holds the first of the probes it has, so it appears once. Of a word with score f
    against q, the characters of q that it lacks weigh (1 - f * f) |q|**2 at most, and its own that q lacks
    (1 - f * f) of its own square. Each weighs 1 or more, so counts of bits tell most pairs from the join at once.
    """
    left = known.withColumn("ch", F.explode_outer(F.array_distinct("bag")))
    right = probes.select("q", "q_norm", "q_square", "q_mask", "counts", "floor", F.col("probe.ch").alias("probe"))
    right = right.withColumn("spare", (1 - F.col("floor") * F.col("floor")) * F.lit(1 + 1e-9))
    right = right.withColumn("ch", F.explode_outer("probe"))
    right = right.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    left = left.withColumn("salt", F.pmod(F.xxhash64("term"), F.lit(SALTS)).cast("int"))
    met = left.join(right, ["ch", "salt"])
    lacks = lambda a, b: F.bit_count(F.col(a).bitwiseAND(F.bitwise_not(F.col(b))))
    near = (lacks("q_mask", "mask") <= F.col("spare") * F.col("q_square")) & (lacks("mask", "q_mask") <= F.col("spare") * F.col("square"))
    dot = F.aggregate(
        "bag",
        F.lit(0).cast("bigint"),
        lambda acc, u: acc + F.coalesce(F.try_element_at("counts", u), F.lit(0)),
    )
    sim = cosine(dot, F.col("q_norm"), F.col("norm"))
    return (
        met.filter(near)
        .filter(F.get(F.array_intersect("probe", "bag"), F.lit(0)) == F.col("ch"))
        .filter(sim >= F.col("floor"))
        .select("q", "term", sim.alias("sim"))
    )


def _apart(words: DataFrame, queries: DataFrame, top: int) -> DataFrame:
    """(q, term, 0.0) for the first ``top`` words that share no character with q.

    Pairs at 0 rank by term. If a query has p pairs above 0, its list takes the
    first top - p of them, and those are among the first ``top`` words of all.
    """
    first = words.select("term").orderBy("term").limit(top)
    listed = first.agg(F.array_sort(F.collect_list("term"))).scalar()
    return (
        queries.select("q", F.explode(listed).alias("term"))
        .filter(~F.arrays_overlap(units(F.col("q")), units(F.col("term"))))
        .select("q", "term", F.lit(0.0).alias("sim"))
    )


def _first_ranks(scored: DataFrame, top: int) -> DataFrame:
    order = (F.desc("sim"), F.asc("term"))
    if top > TASK_LIMIT:
        group = F.pmod(F.xxhash64("term"), F.lit(RANK_GROUPS))
        within = F.row_number().over(W.partitionBy("q", group).orderBy(*order))
        scored = scored.withColumn("rank", within).filter(F.col("rank") <= top).drop("rank")
    place = F.row_number().over(W.partitionBy("q").orderBy(*order))
    return (
        scored.withColumn("rank", place)
        .filter(F.col("rank") <= top)
        .select("q", F.col("rank").cast("bigint").alias("rank"), "term", "sim")
    )


def similar_terms_batch(
    words: DataFrame, queries: DataFrame, top: int, query_rows: int = QUERY_ROWS
) -> DataFrame:
    """(q, rank, term, sim): ``similar_terms`` for a table (q) of distinct query words.

    Each round takes the queries that are not settled yet down to the next of FLOORS; a list is final if
    it is full, as no other word scores as much. The last round has no floor and fills up with words that share
    no character. Up to ``query_rows`` queries go to every task, which multiplies them with its words. Of more, pairs
    meet by characters: a word without any of the characters S of q scores at most |q without S| / |q|, so to find all
    words that score f or more, it is enough to look at those that hold one of the cheapest characters that leave
    less than f. Words and queries are written to tables first, as rounds read them.
    """
    top = max(top, 0)
    if top == 0:
        return words.limit(0).select(
            F.col("term").alias("q"),
            F.lit(0).cast("bigint").alias("rank"),
            "term",
            F.lit(0.0).alias("sim"),
        )
    queries = materialize(queries.select("q"), "query-words")
    small = fits_broadcast(queries, query_rows)
    known = spread(words.select("term"))
    known = materialize(known if small else _known_words(known), "words")
    weigh = lambda entries: F.aggregate(entries, F.lit(0).cast("bigint"), lambda acc, x: acc + x["weight"])
    asked = queries
    if not small:
        asked = _queries(known, queries).withColumn("q_mask", _mask(units(F.col("q"))))
        asked = materialize(asked.withColumn("q_square", F.coalesce(weigh("chars"), F.lit(0).cast("bigint"))), "queries")
    lists = []
    for floor in FLOORS:
        probes = asked.withColumn("floor", F.lit(floor))
        if not small:
            # The margin covers rounding in the scores; it only ever adds characters.
            reach = F.lit(floor * floor * (1 - 1e-9)) * F.col("q_square")
            probes = probes.withColumn("probe", _up_to(lambda before: F.col("q_square") - weigh(before) >= reach))
        found = materialize(_first_ranks(_scored(known, probes, small, top), top), "round")
        full = found.filter(F.col("rank") == top).select("q")
        full = F.broadcast(full) if small else full
        lists.append(found.join(full, "q", "left_semi"))
        asked = materialize(asked.join(full, "q", "left_anti"), "queries")
        if asked.isEmpty():
            return reduce(DataFrame.unionByName, lists)
    last = asked.withColumn("floor", F.lit(0.0))
    rest = _scored(known, last if small else last.withColumn("probe", F.col("chars")), small, top)
    return reduce(DataFrame.unionByName, [*lists, _first_ranks(rest.unionByName(_apart(known, asked, top)), top)])
