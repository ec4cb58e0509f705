"""Words as bags of characters."""

from __future__ import annotations

from collections import Counter
from math import sqrt

from pyspark.sql import Column, functions as F


def units(word: Column) -> Column:
    """The UTF-16 units of a word: a character outside the BMP counts as two.

    Such a pair is written as its two hexadecimal code units, which no single
    character can equal.
    """
    chars = F.when(word == "", F.array().cast("array<string>")).otherwise(F.split(word, ""))
    pair = lambda c: F.hex(F.encode(c, "UTF-16BE"))
    split_up = F.flatten(
        F.transform(
            chars,
            lambda c: F.when(
                F.octet_length(c) == 4,
                F.array(F.substring(pair(c), 1, 4), F.substring(pair(c), 5, 4)),
            ).otherwise(F.array(c)),
        )
    )
    wide = (F.octet_length(word) > F.length(word)) & word.rlike(r"[\x{10000}-\x{10FFFF}]")
    return F.when(wide, split_up).otherwise(chars)


def occurrences(bag: Column, unit: Column) -> Column:
    return (F.size(bag) - F.size(F.array_remove(bag, unit))).cast("bigint")


def squared_norm(bag: Column) -> Column:
    """Sum of squared character counts of an array from ``units``."""
    counts = F.transform(F.array_distinct(bag), lambda u: occurrences(bag, u))
    return F.aggregate(counts, F.lit(0).cast("bigint"), lambda acc, c: acc + c * c)


def word_bag(word: str) -> dict[str, int]:
    """Character counts of one query word, keyed like ``units``."""
    bag: Counter[str] = Counter()
    for ch in word:
        if ord(ch) > 0xFFFF:
            code = ch.encode("utf-16-be").hex().upper()
            bag.update((code[:4], code[4:]))
        else:
            bag[ch] += 1
    return dict(bag)


def bag_norm(bag: dict[str, int]) -> float:
    return sqrt(sum(c * c for c in bag.values()))


def dot_with(bag: Column, query: dict[str, int]) -> Column:
    """Dot product of an array from ``units`` with a fixed bag."""
    if not query:
        return F.lit(0).cast("bigint")
    weights = F.create_map(*[F.lit(x) for pair in query.items() for x in pair])
    return F.aggregate(
        bag,
        F.lit(0).cast("bigint"),
        lambda acc, u: acc + F.coalesce(F.try_element_at(weights, u), F.lit(0)).cast("bigint"),
    )


def cosine(dot: Column, norm_a: Column, norm_b: Column) -> Column:
    """dot / (|a| * |b|), and 0 where one of them is empty."""
    return F.coalesce(F.try_divide(dot.cast("double"), norm_a * norm_b), F.lit(0.0))
