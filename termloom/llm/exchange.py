"""Ask a question about hashes of the whole corpus, and bring the answers back to where they arose.

Documents are taken in chunks of bounded size. A chunk sends what it wants to know about its
hashes in one row per bucket, a bucket being a part of the hash space. The task of a bucket sees
all hashes of its part once per chunk, however often a chunk holds them, and answers each chunk
in one row. A chunk's own notes travel through a bucket unchanged, so that a chunk's answers and
notes meet again in one bounded group. Payloads are pickled tuples of arrays.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from termloom.llm.words import chunk_number

CHUNK_BYTES = 4 << 20
CHUNK_DOCS = 4096
BUCKET_BYTES = 4 << 20  # bytes of text for which there is one bucket
LEAST_BUCKETS = 64
ASK, NOTE, TOTAL = 0, 1, 2
ROWS = "bucket int, chunk bigint, kind int, payload binary"
_NAMES = ("bucket", "chunk", "kind", "payload")
_TYPES = (pa.int32(), pa.int64(), pa.int32(), pa.binary())


def buckets_for(text_bytes: int) -> int:
    return int(max(LEAST_BUCKETS, min(text_bytes // BUCKET_BYTES, 1 << 20)))


def pack(*parts) -> bytes:
    return pickle.dumps(parts, protocol=5)


def totals_of(answered: DataFrame) -> dict[int, int]:
    """The sums over all buckets."""
    rows = answered.filter(F.col("kind") >= TOTAL).groupBy("kind").agg(F.sum("chunk").alias("n")).collect()
    return {r["kind"] - TOTAL: r["n"] for r in rows}


def by_bucket(hashes: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Places of the hashes in each bucket that has some, in their order."""
    bucket = ((hashes >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(cuts)).tolist():
        yield b, order[cuts[b] : cuts[b + 1]]


def rows_of(rows: Iterable[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [(), (), (), ()]
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, _TYPES)], list(_NAMES))


def ask(
    docs: DataFrame, chunk: Callable[[pa.RecordBatch], Iterator[tuple[Iterable[tuple[int, bytes]], bytes]]], buckets: int
) -> DataFrame:
    """Rows of questions and notes. ``chunk`` cuts a batch into chunks and gives, for each, its
    questions as (bucket, payload) and its notes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence = 0
        for batch in batches:
            for questions, notes in chunk(batch):
                number = chunk_number(sequence)
                sequence += 1
                rows = [(b, number, ASK, p) for b, p in questions]
                yield rows_of([*rows, (number % buckets, number, NOTE, notes)])

    return docs.mapInArrow(run, ROWS)


def answer(asked: DataFrame, decide: Callable[[list[tuple]], tuple[list[bytes | None], list[int]]]) -> DataFrame:
    """``decide`` sees all questions of a bucket and gives an answer for each, or None, and numbers
    that are to be summed over buckets: the rows of kind TOTAL + k hold the k-th in ``chunk``."""

    def run(table: pa.Table) -> pa.Table:
        bucket, chunk, kind, payload = (table[c].to_pylist() for c in _NAMES)
        asks = [i for i, k in enumerate(kind) if k == ASK]
        found, totals = decide([pickle.loads(payload[i]) for i in asks])
        rows = [(bucket[i], chunk[i], ASK, p) for i, p in zip(asks, found) if p is not None]
        rows += [(bucket[i], chunk[i], NOTE, payload[i]) for i, k in enumerate(kind) if k == NOTE]
        rows += [(bucket[0], int(n), TOTAL + k, None) for k, n in enumerate(totals)]
        return pa.Table.from_batches([rows_of(rows)])

    return asked.groupBy("bucket").applyInArrow(lambda t: run(t), ROWS)


def receive(answered: DataFrame, finish: Callable[..., pa.Table], schema: str, with_chunk: bool = False) -> DataFrame:
    """``finish`` sees the notes and all answers of one chunk, and its number first if asked for."""

    def run(table: pa.Table) -> pa.Table:
        kind, payload = table["kind"].to_pylist(), table["payload"].to_pylist()
        notes = next(p for k, p in zip(kind, payload) if k == NOTE)
        first = (table["chunk"][0].as_py(),) if with_chunk else ()
        return finish(*first, pickle.loads(notes), [pickle.loads(p) for k, p in zip(kind, payload) if k == ASK])

    return answered.filter(F.col("kind") < TOTAL).groupBy("chunk").applyInArrow(lambda t: run(t), schema)
