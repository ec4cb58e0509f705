"""Token counts at every prefix of a text, kept so that no text is encoded twice.

The count of a prefix follows from a shorter one: tokens up to the end of the last whole
piece between white space, plus the tokens of the piece that the cut leaves open. One pass
stores the first term at every piece end; ``tokens_at`` and ``longest_prefix`` add the
second by encoding that one piece only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from termloom.llm.tokens import PieceEncoder
from termloom.llm.words import PIECE, spans, text_bytes, words

_BLOCK = 4 << 20


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    encoder = PieceEncoder()
    for batch in batches:
        data, offsets = text_bytes(batch.column(1))
        for i, j in spans(offsets, _BLOCK):
            rows = offsets[i : j + 1] - offsets[i]
            block = data[offsets[i] : offsets[j]]
            _, ends = words(block, rows, PIECE)
            first = np.searchsorted(ends, rows, side="right")  # the first piece of each row
            raw = block.tobytes()
            parts = [p for a, b in zip(rows[:-1].tolist(), rows[1:].tolist()) for p in raw[a:b].split()]
            counts = np.fromiter(map(len, encoder.ids(parts)), np.int64, len(parts)) // 4
            total = np.concatenate([[0], np.cumsum(counts)])
            sizes = np.diff(first)
            before = total[first[:-1]]
            prefix = total[1:] - np.repeat(before, sizes)
            places = ends - np.repeat(rows[:-1], sizes)
            lists = pa.array(first, pa.int32())
            yield pa.record_batch(
                {
                    "key": batch.column(0)[i:j],
                    "n_bytes": pa.array(np.diff(rows), pa.int64()),
                    "n_tokens": pa.array(total[first[1:]] - before, pa.int64()),
                    "prefix_bytes": pa.ListArray.from_arrays(lists, pa.array(places, pa.int32())),
                    "prefix_tokens": pa.ListArray.from_arrays(lists, pa.array(prefix, pa.int32())),
                }
            )


def prefix_counts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its key, n_bytes, n_tokens, and two arrays of equal length,
    the bytes up to the end of each piece and the tokens up to there.

    A null text counts as empty: no bytes, no tokens, empty arrays. Rows that repeat give
    rows that repeat; a null key stays null; other columns are not carried, so their names
    cannot clash. An empty table gives no rows.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    out = rows.mapInArrow(
        _count_batches,
        f"key {kind}, n_bytes bigint, n_tokens bigint, prefix_bytes array<int>, prefix_tokens array<int>",
    )
    return out.withColumnRenamed("key", key)


def tokens_of(counted: DataFrame) -> DataFrame:
    """n_tokens read from the stored prefixes: the count at the last one."""
    last = F.when(F.size("prefix_tokens") == 0, F.lit(0)).otherwise(F.element_at("prefix_tokens", -1))
    return counted.withColumn("n_tokens", last.cast("bigint"))


def tokens_at(counts: tuple[list[int], list[int]], text: bytes, at: int, encoder: PieceEncoder) -> int:
    """Tokens of text[:at], given the prefix arrays of ``text``; encodes one piece at most."""
    ends, tokens = counts
    k = int(np.searchsorted(ends, at, side="right"))
    done, start = (tokens[k - 1], ends[k - 1]) if k else (0, 0)
    return done + encoder.count(text[start:at])


def longest_prefix(counts: tuple[list[int], list[int]], text: bytes, budget: int, encoder: PieceEncoder) -> int:
    """The most bytes of whole characters whose tokens stay within ``budget``."""
    ends, tokens = counts
    k = int(np.searchsorted(tokens, budget, side="right"))
    if k == len(ends):
        return len(text)
    done, start = (tokens[k - 1], ends[k - 1]) if k else (0, 0)
    for at in range(ends[k], start, -1):
        if at == len(text) or text[at] & 0xC0 != 0x80:
            if done + encoder.count(text[start:at]) <= budget:
                return at
    return start


def _cut_batches(budget: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PieceEncoder()
        for batch in batches:
            at = 0
            for counted in _count_batches(iter([batch])):
                texts = batch.column(1)[at : at + counted.num_rows].to_pylist()
                at += counted.num_rows
                ends, tokens = counted.column("prefix_bytes").to_pylist(), counted.column("prefix_tokens").to_pylist()
                raws = [(t or "").encode() for t in texts]
                kept = [raw[: longest_prefix((e, n), raw, budget, encoder)].decode() for raw, e, n in zip(raws, ends, tokens)]
                yield pa.record_batch({"key": counted.column("key"), "text": pa.array(kept, pa.string())})

    return cut


def truncate(docs: DataFrame, budget: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each text cut to its longest prefix of at most ``budget`` tokens: its key and text.

    The prefix arrays of a row say where its cut falls; only that one piece is encoded again. Counts and
    text stay in their row, so keys may be null and repeat. A null text gives an empty one; rows that repeat
    are cut alike; no rows give no rows; other columns are not carried.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(_cut_batches(budget), f"key {kind}, text string").toDF(key, text)
