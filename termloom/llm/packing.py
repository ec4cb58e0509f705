"""Best-fit packing of documents into sequences of a fixed number of tokens.

Only lengths matter for packing, and there are at most ``capacity`` of them, so the plan is
made on the counts of each length: a table that does not grow with the corpus. Pieces over a
third of the capacity are paired first, each largest one with the largest that still fits,
at most two to a sequence; shorter ones then go, longest first, into the smallest gap that
takes them. A plan is a list of runs, "the pieces of this length with these ranks go to these
sequences at this place", and pieces find their run by their rank among those of equal length.
Ranks are counted within salts of a length and shifted by the counts of earlier salts, so a
length that a third of all pieces share is dealt over all tasks.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from termloom.llm.tokens import PieceEncoder
from termloom.llm.words import chunk_number, texts_of
from termloom.session import materialize

CAPACITY = 4096
END = 1
_PIECES = (
    "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, spread int"
)
_BLOCK = 4 << 20
_STEP = 0x9E3779B1  # an odd number, so that near places give far values


def _piece_batches(capacity: int, with_ids: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PieceEncoder()
        place = chunk_number(0) % 1_000_003  # rows that repeat are told apart by their place in all tasks
        end = np.array([END], "<u4").tobytes()
        width = 4 * capacity
        for batch in batches:
            docs, raws = batch.column(0).to_pylist(), texts_of(batch.column(1))
            at = 0
            while at < len(raws):
                stop, size = at, 0
                while stop < len(raws) and (stop == at or size + len(raws[stop]) <= _BLOCK):
                    size += len(raws[stop])
                    stop += 1
                rows: list[tuple] = []
                ids: list[bytes] = []
                for doc, found in zip(docs[at:stop], encoder.text_ids(raws[at:stop])):
                    whole = found + end
                    place += 1
                    for k, a in enumerate(range(0, len(whole), width)):
                        some = whole[a : a + width]
                        crc = zlib.crc32(some)
                        rows.append((doc, k, a // 4, len(some) // 4, crc, (crc + place * _STEP) & 0x7FFFFFFF))
                        if with_ids:
                            ids.append(some)
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32()))]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "spread"]
                if with_ids:
                    columns.append(pa.array(ids, pa.binary()))
                    names.append("ids")
                yield pa.record_batch(columns, names)
                at = stop

    return cut


def pieces(docs: DataFrame, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Documents as token pieces: the ids of the text, then the end id, cut only where longer
    than ``capacity``. A null text is empty: one piece of the end id alone."""
    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return rows.mapInArrow(_piece_batches(capacity, with_ids), _PIECES + ", ids binary" * with_ids)


class _Gaps:
    """Groups of sequences with the same gap: gap to a list of [first sequence, how many]."""

    def __init__(self):
        self.sizes: list[int] = []
        self.groups: dict[int, list[list[int]]] = {}

    def add(self, gap: int, first: int, many: int) -> None:
        if gap > 0:
            if gap not in self.groups:
                self.groups[gap] = []
                insort(self.sizes, gap)
            self.groups[gap].append([first, many])

    def smallest(self, need: int) -> int | None:
        at = bisect_left(self.sizes, need)
        return self.sizes[at] if at < len(self.sizes) else None

    def take(self, gap: int, most: int) -> tuple[int, int]:
        """Up to ``most`` sequences of one group with this gap."""
        group = self.groups[gap][-1]
        first, many = group[0], min(group[1], most)
        group[0], group[1] = first + many, group[1] - many
        if not group[1]:
            self.groups[gap].pop()
            if not self.groups[gap]:
                del self.groups[gap]
                self.sizes.pop(bisect_left(self.sizes, gap))
        return first, many


def plan_runs(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first rank, how many, first sequence, offset) for counts by length.

    Rank r of a run goes to sequence ``first sequence + r - first rank``. Work and result
    depend on the number of distinct lengths, not on the counts.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    used: dict[int, int] = dict.fromkeys(left, 0)
    runs: list[tuple[int, int, int, int, int]] = []
    gaps, sequences = _Gaps(), 0

    def place(length: int, many: int, first: int, offset: int) -> None:
        runs.append((length, used[length], many, first, offset))
        used[length] += many
        left[length] -= many

    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        big = large[-1]
        fit = bisect_left(large, capacity - big + 1) - 1
        if fit < 0:
            many, partner = left[big], None
        elif large[fit] == big:
            many, partner = left[big] // 2, big
            if not many:
                many, partner = (1, None) if not fit else (1, large[fit - 1])
        else:
            partner = large[fit]
            many = min(left[big], left[partner])
        place(big, many, sequences, 0)
        if partner is not None:
            place(partner, many, sequences, big)
        gaps.add(capacity - big - (partner or 0), sequences, many)
        sequences += many
        large = [n for n in large if left[n]] if not left[big] or (partner and not left[partner]) else large

    for length in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[length]:
            gap = gaps.smallest(length)
            if gap is None:
                each = min(capacity // length, left[length])
                many = left[length] // each
                first, gap = sequences, capacity
                sequences += many
            else:
                each = min(gap // length, left[length])
                first, many = gaps.take(gap, left[length] // each)
            for k in range(each):
                place(length, many, first, capacity - gap + k * length)
            gaps.add(gap - each * length, first, many)
    return runs


def _place_batches(runs: list[tuple[int, int, int, int, int]]):
    table = np.array(sorted(runs), np.int64).reshape(-1, 5)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = np.rec.fromarrays([table[:, 0], table[:, 1]], names="length,rank")
        for batch in batches:
            length, rank = (batch.column(n).to_numpy() for n in ("length", "rank"))
            find = np.rec.fromarrays([length, rank], names="length,rank")
            run = np.searchsorted(keys, find, side="right") - 1
            sequence = table[run, 3] + rank - table[run, 1]
            kept = [n for n in batch.schema.names if n != "rank"]
            yield pa.record_batch(
                [batch.column(n) for n in kept] + [pa.array(sequence), pa.array(table[run, 4])],
                [*kept, "sequence_id", "offset"],
            )

    return place


def ranked(rows: DataFrame, salts: int) -> DataFrame:
    """``rank``: a number from 0, without gaps, for each row among those of its length."""
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "spread"), F.lit(salts)))
    own = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "spread")
    counted = salted.groupBy("length", "salt").count()
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    shift = counted.select("length", "salt", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("shift"))
    out = salted.withColumn("own", F.row_number().over(own) - 1).join(shift, ["length", "salt"])
    return out.withColumn("rank", (F.col("own") + F.col("shift")).cast("bigint")).drop("salt", "own", "shift")


def pack(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Every piece of every document with its sequence and its place there.

    Rows that repeat are documents of their own. Null ids stay null and are packed like others.
    Only doc_id and text are read, so other columns may have any name. No rows give no rows.
    Ties between equal lengths go by doc_id and piece within a salt of the hash of both and of the row's place.
    """
    cut = materialize(pieces(docs, capacity), "pieces")
    lengths = cut.groupBy("length").count().collect()  # at most ``capacity`` rows
    runs = plan_runs({r["length"]: r["count"] for r in lengths}, capacity)
    if not runs:
        return cut.drop("spread").withColumns({"sequence_id": F.lit(0).cast("bigint"), "offset": F.lit(0).cast("bigint")})
    salts = max(64, sum(r["count"] for r in lengths) // 20_000)
    rows = ranked(cut, salts).select("doc_id", "piece", "start", "length", "ids_crc32", "rank")
    return rows.mapInArrow(
        _place_batches(runs),
        "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
    )
