"""A positional inverted index over documents, and exact phrases and proximity found in it.

The index is a table of posting lists. Documents are taken in segments of bounded size; a row
holds one term of one segment: for each occurrence the document's number in the segment and its
position. A term that every document has is thus spread over all segments. Only terms that a test
asks for are stored; the benchmark is taken in blocks of bounded size, so the vocabulary that
travels to the tasks is bounded too.

A phrase starts from its rarest term (by occurrences in the whole corpus): its postings, less the
term's offset, are candidate starts, and the lists of the other terms, rarest first, are
intersected with them. The phrase tests of a segment run together, as arrays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, functions as F

from termloom.llm.words import LOWER, WORD, chunk_number, spans, text_bytes, words
from termloom.session import materialize
from termloom.sizes import broadcast_if_small

WINDOW = 13
SEGMENT_BYTES = 4 << 20
SEGMENT_DOCS = 4096
BLOCK_WORDS = 500_000  # words of test items whose terms and windows travel to the tasks at once
_NO_TERM, _GAP = -1, -2
_INDEX = "segment bigint, term int, docs binary, places binary, keys array<bigint>, sizes array<bigint>"

# Bytes that are no part of a word become spaces, A-Z become a-z.
_TRANSLATE = np.where(WORD, LOWER, 32).astype(np.uint8)


def test_words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_TRANSLATE.tobytes()).split()


def _index_batches(terms: dict[bytes, int]):
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence = 0
        table = _TRANSLATE.tobytes()
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            keys = batch.column(0).to_pylist()
            for i, j in _segments(offsets):
                rows = offsets[i : j + 1] - offsets[i]
                block = data[offsets[i] : offsets[j]]
                starts, _ = words(block, rows)
                first = np.searchsorted(starts, rows)
                raw = block.tobytes().translate(table)
                found = [w for a, b in zip(rows[:-1].tolist(), rows[1:].tolist()) for w in raw[a:b].split()]
                ids = np.fromiter(map(terms.get, found, [_NO_TERM] * len(found)), np.int32, len(found))
                sizes = np.diff(first)
                docs = np.repeat(np.arange(j - i, dtype=np.int32), sizes)
                places = np.arange(len(found)) - np.repeat(first[:-1], sizes)
                known = np.flatnonzero(ids >= 0)
                known = known[np.argsort(ids[known], kind="stable")]
                own, at = np.unique(ids[known], return_index=True)
                cuts = np.append(at, len(known))
                segment = chunk_number(sequence)
                sequence += 1
                lists = [known[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
                # The first row of a segment has no term: it holds its documents and their lengths.
                yield pa.record_batch(
                    {
                        "segment": pa.array([segment] * (len(own) + 1), pa.int64()),
                        "term": pa.array([_NO_TERM, *own.tolist()], pa.int32()),
                        "docs": pa.array([None, *(docs[x].astype("<i4").tobytes() for x in lists)], pa.binary()),
                        "places": pa.array([None, *(places[x].astype("<i4").tobytes() for x in lists)], pa.binary()),
                        "keys": pa.array([keys[i:j], *[None] * len(own)], pa.list_(pa.int64())),
                        "sizes": pa.array([sizes.tolist(), *[None] * len(own)], pa.list_(pa.int64())),
                    }
                )

    return index


def _segments(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    for i, j in spans(offsets, SEGMENT_BYTES):
        for k in range(i, j, SEGMENT_DOCS):
            yield k, min(k + SEGMENT_DOCS, j)


def build_index(docs: DataFrame, terms: dict[bytes, int], key: str = "doc_id", text: str = "text") -> DataFrame:
    """The stored index of ``docs`` for ``terms`` (word to number, of bounded size)."""
    rows = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).cast("string").alias("text"))
    return materialize(rows.mapInArrow(_index_batches(terms), _INDEX), "postings")


def occurrences(index: DataFrame) -> dict[int, int]:
    """How often each term occurs in all documents; one row per test term."""
    rows = index.filter(F.col("term") >= 0).groupBy("term").agg(F.sum(F.length("docs") / 4).cast("bigint").alias("n"))
    return {r["term"]: r["n"] for r in rows.collect()}


class Phrases:
    """Phrases of term numbers, each with its item and its terms from the rarest on."""

    def __init__(self, phrases: list[tuple[int, list[int]]], counts: dict[int, int]):
        self.items = np.array([i for i, _ in phrases], np.int64)
        self.lengths = np.array([len(t) for _, t in phrases], np.int64)
        width = int(self.lengths.max(initial=1))
        self.terms = np.full((len(phrases), width), _NO_TERM, np.int32)
        self.offsets = np.zeros((len(phrases), width), np.int32)
        for row, (_, terms) in enumerate(phrases):
            order = sorted(range(len(terms)), key=lambda k: (counts.get(terms[k], 0), k))
            self.terms[row, : len(terms)] = [terms[k] for k in order]
            self.offsets[row, : len(terms)] = order
        by_first = np.argsort(self.terms[:, 0], kind="stable")
        self.by_first, self.first = by_first, self.terms[by_first, 0]


class Segment:
    """The posting lists of one segment on one axis: documents in order, a gap after each."""

    def __init__(self, rows: pa.Table):
        heads = pa.compute.equal(rows["term"], _NO_TERM)
        head = rows.filter(heads).slice(0, 1).to_pylist()[0]
        self.keys, self.sizes = head["keys"], np.array(head["sizes"], np.int64)
        self.begins = np.concatenate([[0], np.cumsum(self.sizes + 1)]).astype(np.int64)
        self.ids = np.full(self.begins[-1] + 1, _GAP, np.int32)
        self.lists: dict[int, np.ndarray] = {}
        lists = rows.filter(pa.compute.invert(heads))
        for term, docs, places in zip(*(lists[c].to_pylist() for c in ("term", "docs", "places"))):
            at = self.begins[np.frombuffer(docs, "<i4")] + np.frombuffer(places, "<i4")
            self.lists[term] = at
            self.ids[at] = term

    def find(self, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
        """Phrase numbers and starts of all exact occurrences."""
        starts, numbers = [], []
        for term, at in self.lists.items():
            a, b = np.searchsorted(phrases.first, [term, term + 1])
            some = phrases.by_first[a:b]
            if len(some):
                starts.append((at[None, :] - phrases.offsets[some, 0][:, None]).ravel())
                numbers.append(np.repeat(some, len(at)))
        if not starts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        start, number = np.concatenate(starts), np.concatenate(numbers)
        inside = (start >= 0) & (start + phrases.lengths[number] <= len(self.ids))
        start, number = start[inside], number[inside]
        for k in range(1, phrases.terms.shape[1]):
            wanted = phrases.terms[number, k]
            # The k-th rarest list holds the start, moved by the term's offset.
            there = np.minimum(start + phrases.offsets[number, k], len(self.ids) - 1)
            kept = (wanted == _NO_TERM) | (self.ids[there] == wanted)
            start, number = start[kept], number[kept]
            if not len(start):
                break
        return number, start

    def near(self, terms: list[int], within: int) -> dict[int, tuple[int, int]]:
        """Documents (numbers) that hold all terms within ``within`` words, with the first such window."""
        found: dict[int, tuple[int, int]] = {}
        lists = [self.lists.get(t) for t in set(terms)]
        if any(x is None for x in lists):
            return found
        lists.sort(key=len)
        for at in lists[0]:  # from the rarest term
            doc = int(np.searchsorted(self.begins, at, side="right")) - 1
            for low in range(max(self.begins[doc], at - within + 1), at + 1):
                if all(np.searchsorted(x, low) < np.searchsorted(x, low + within) for x in lists):
                    end = min(low + within, self.begins[doc + 1] - 1)
                    found.setdefault(doc, (int(low - self.begins[doc]), int(end - self.begins[doc])))
                    break
        return found


def _lists(values: np.ndarray, cuts: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(values, kind))


def _hits(phrases: Phrases, names: list[str | None]):
    def search(key: tuple, rows: pa.Table) -> pa.Table:
        segment = Segment(rows)
        number, start = segment.find(phrases)
        doc = np.searchsorted(segment.begins, start, side="right") - 1
        # Words hit: +1 at each start and -1 after each end, summed along the axis.
        edge = np.zeros(len(segment.ids) + 1, np.int64)
        np.add.at(edge, start, 1)
        np.add.at(edge, start + phrases.lengths[number], -1)
        hit = np.concatenate([[0], np.cumsum(edge) > 0, [0]]).astype(np.int8)
        begin, end = np.flatnonzero(np.diff(hit) == 1), np.flatnonzero(np.diff(hit) == -1)
        span_doc = np.searchsorted(segment.begins, begin, side="right") - 1
        pairs = np.unique(np.stack([doc, phrases.items[number]]), axis=1)
        n = len(segment.keys)
        cuts, base = np.searchsorted(span_doc, np.arange(n + 1)), segment.begins[span_doc]
        by_doc = np.searchsorted(pairs[0], np.arange(n + 1))
        return pa.table(
            {
                "segment": pa.array([key[0].as_py()] * n, pa.int64()),
                "doc": pa.array(np.arange(n)),
                "doc_id": pa.array(segment.keys, pa.int64()),
                "n_words": pa.array(segment.sizes),
                "starts": _lists(begin - base, cuts, pa.int64()),
                "ends": _lists(end - base, cuts, pa.int64()),
                "items": _lists([names[i] for i in pairs[1]], by_doc, pa.string()),
            }
        )

    return search


_FOUND = (
    "segment bigint, doc bigint, doc_id bigint, n_words bigint, starts array<bigint>, ends array<bigint>, "
    "items array<string>"
)


def phrase_matches(index: DataFrame, phrases: list[tuple[int, list[int]]], names: list[str | None]) -> DataFrame:
    """Per document: the spans of words inside any occurrence of a phrase (adjoining ones as
    one) and the names of the items that these phrases belong to."""
    prepared = Phrases(phrases, occurrences(index))
    return index.groupBy("segment").applyInArrow(_hits(prepared, names), _FOUND)


def proximity_matches(index: DataFrame, terms: list[int], within: int) -> DataFrame:
    """Documents that hold all ``terms``, in any order, within ``within`` consecutive words."""

    def search(key: tuple, rows: pa.Table) -> pa.Table:
        segment = Segment(rows)
        found = sorted(segment.near(terms, within).items())
        columns = [[segment.keys[d] for d, _ in found], [a for _, (a, _) in found], [b for _, (_, b) in found]]
        return pa.table([pa.array(c, pa.int64()) for c in columns], ["doc_id", "start", "end"])

    return index.groupBy("segment").applyInArrow(search, "doc_id bigint, start bigint, end bigint")


def windows(words_of_item: list[bytes], size: int = WINDOW) -> list[list[bytes]]:
    """Runs of ``size`` words, or all of them if fewer; none for no words."""
    if not words_of_item:
        return []
    return [words_of_item[k : k + size] for k in range(max(1, len(words_of_item) - size + 1))]


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str | None]]]:
    """Different items in blocks of about BLOCK_WORDS words, or one longer item; one block for most tests.

    Dealt by id and text, so that an id of many texts is spread; an item that repeats comes once.
    """
    items = benchmark.filter(F.length("text") > 0).select("item_id", "text").distinct()
    size = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // (4 * BLOCK_WORDS)))
    dealt = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    for block in range(blocks):
        yield [(r["item_id"], r["text"]) for r in dealt.filter(F.col("block") == block).collect()]


def _merge(found: list[DataFrame]) -> DataFrame:
    """Results of the blocks of items as one row per document, with n_hit."""
    one = found[0]
    if len(found) > 1:
        for more in found[1:]:
            one = one.unionByName(more)
        lists = [F.flatten(F.collect_list(c)).alias(c) for c in ("starts", "ends", "items")]
        firsts = [F.first(c).alias(c) for c in ("doc_id", "n_words")]
        one = one.groupBy("segment", "doc").agg(*firsts, *lists)
    none = F.lit(0).cast("bigint")
    # A span counts from where the ones before it end.
    total = F.aggregate(
        F.array_sort(F.arrays_zip("starts", "ends")),
        F.struct(none.alias("n"), none.alias("to")),
        lambda s, x: F.struct(
            (s["n"] + F.greatest(none, x["ends"] - F.greatest(s["to"], x["starts"]))).alias("n"),
            F.greatest(s["to"], x["ends"]).alias("to"),
        ),
    )
    return one.withColumn("n_hit", total["n"]).withColumn("items", F.array_distinct("items"))


def _digest(names: Column) -> Column:
    return F.sha2(F.array_join(F.array_sort(names), ",").cast("binary"), 256)


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256 and contaminated.

    Words are runs of word bytes with A-Z lower-cased. A word is hit if it lies in an occurrence of
    ``size`` consecutive words of an item, or of all words of a shorter item. contaminated: at least
    one word in twenty is hit. Null texts have no words; items without words match nothing; items
    with a null id are not told apart from each other (null counts as one item and is left out of the
    digest). Rows that repeat, also by doc_id, are judged one by one. An empty benchmark leaves all
    documents clean; an empty table gives no rows. Only the named columns are read.
    """
    results = []
    for block in _blocks(benchmark):
        found = [(item, w) for item, text in block for w in windows(test_words(text), size)]
        terms = {w: k for k, w in enumerate(dict.fromkeys(w for _, ws in found for w in ws))}
        items = {item: k for k, item in enumerate(dict.fromkeys(i for i, _ in found))}
        phrases = list(dict.fromkeys((items[i], tuple(terms[w] for w in ws)) for i, ws in found))
        names = [None if i is None else str(i) for i in items]
        results.append(phrase_matches(build_index(docs, terms), phrases, names))
    merged = _merge(results)
    return merged.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        _digest(F.col("items")).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents, with all their columns, that are not contaminated.

    Rows are told apart by doc_id and text, so rows that repeat in both stay or go together. A null text is
    clean, and ids may be null. A row travels as one value, so its columns may have any names. No rows give no rows.
    """
    key = F.xxhash64(F.col("doc_id").cast("bigint"), F.coalesce(F.col("text"), F.lit("")))
    judged = contamination(docs.select(key.alias("doc_id"), "text"), benchmark)
    bad = judged.filter("contaminated").select(F.col("doc_id").alias("key")).distinct()
    bad = broadcast_if_small(materialize(bad, "contaminated"))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), key.alias("key"))
    return rows.join(bad, "key", "left_anti").select("row.*")
