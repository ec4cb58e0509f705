"""Removal of repeated passages by suffix sorting with hashed comparisons.

A byte goes if a string of SPAN bytes around it also starts earlier in the corpus. Two equal
strings have the same smallest GRAM-byte hash at the same place, their anchor, so every start
belongs to one anchor and equal strings meet in the group of their anchor's hash.

1. Each chunk of documents asks which of its anchors occur more than once in the corpus.
2. Documents that have such anchors send a context for each: the bytes of all strings that belong
   to it. A context that repeats within a chunk is sent once, at its earliest place; so a passage
   that a third of all documents share comes as one context per chunk.
3. In an anchor's group, the contexts are sorted twice by merging: by what follows the anchor, and
   by what precedes it read backwards. A comparison finds the common extension of two suffixes by
   binary search over polynomial prefix hashes. Extensions of neighbours are then checked byte by
   byte; if hashes ever collide, the group is sorted anew with another base. The strings that reach
   ``o`` bytes back are equal where both extensions suffice, and all but the earliest start go.
4. The anchor nearest to an end of a shared passage has another context in each document. Anchors
   with more than MANY places are therefore not sorted as groups: their strings are dealt one by one,
   by a cryptographic digest of 128 bits, and each chunk sends a string once, at its earliest place.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from termloom.llm import exchange
from termloom.llm.tables import text_size
from termloom.llm.words import inverse_powers, mix, prefix_hashes, range_hashes, spans, text_bytes

SPAN = 100
GRAM = 32
MANY = 4096  # places of an anchor beyond which its strings are dealt one by one
_PLACE = np.uint64((1 << 20) - 1)
_BLOCK = 1 << 18
_FIRST = -(1 << 63)  # stands for a null id, before all others
_SLICE = 1 << 20  # bytes of contexts that are sorted at once
_BASES = (0x9E3779B97F4A7C55, 0xD1342543DE82EF95, 0xF1357AEA2E62A9C5)

Anchors = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _block_anchors(data: np.ndarray, rows: np.ndarray, span: int, gram: int) -> Anchors:
    none = np.zeros(0, np.int64)
    if len(data) < span:
        return none, none, none, none.astype(np.uint64)
    prefix = prefix_hashes(data)
    hashes = mix((prefix[gram:] - prefix[:-gram]) * inverse_powers(len(data) - gram + 1))
    low = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)  # by hash, then from the left
    left, step = span - gram + 1, 1
    while 2 * step <= left:
        low = np.minimum(low[:-step], low[step:])
        step *= 2
    if left > step:
        low = np.minimum(low[: len(low) - (left - step)], low[left - step :])
    place = (low & _PLACE).astype(np.int64)[: len(data) - span + 1]
    # Starts whose string stays in its text.
    ends = np.repeat(rows[1:], np.diff(rows))[: len(place)]
    good = np.arange(len(place)) + span <= ends
    change = np.ones(len(place), bool)
    change[1:] = (place[1:] != place[:-1]) | ~good[:-1]
    first = np.flatnonzero(good & change)
    stop = np.ones(len(place), bool)
    stop[:-1] = change[1:] | ~good[1:]
    last = np.flatnonzero(good & stop)
    return first, last, place[first], hashes[place[first]]


def anchors(data: np.ndarray, rows: np.ndarray, span: int = SPAN, gram: int = GRAM) -> Anchors:
    """First and last start of the strings of each anchor, the anchor's place and its hash.

    ``rows`` are the offsets of the texts in ``data``; long texts are taken in pieces that overlap
    so that each start is seen once.
    """
    found: list[Anchors] = []
    for i, j in spans(rows, _BLOCK):
        a, b = int(rows[i]), int(rows[j])
        if b - a <= 2 * _BLOCK:
            part = _block_anchors(data[a:b], rows[i : j + 1] - a, span, gram)
            found.append((part[0] + a, part[1] + a, part[2] + a, part[3]))
            continue
        for at in range(a, b - span + 1, _BLOCK):  # one long text
            end = min(at + _BLOCK + span - 1, b)
            part = _block_anchors(data[at:end], np.array([0, end - at]), span, gram)
            found.append((part[0] + at, part[1] + at, part[2] + at, part[3]))
    if not found:
        return _block_anchors(data[:0], rows[:1], span, gram)
    return tuple(np.concatenate(c) for c in zip(*found))


def _chunks(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    for i, j in spans(offsets, exchange.CHUNK_BYTES):
        for k in range(i, j, exchange.CHUNK_DOCS):
            yield k, min(k + exchange.CHUNK_DOCS, j)


def _questions(buckets: int):
    def chunk(batch: pa.RecordBatch):
        ids, hashes = (batch.column(k).to_numpy() for k in (0, 1))
        data, offsets = text_bytes(batch.column(2))
        for i, j in _chunks(offsets):
            block, rows = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
            _, _, place, own = anchors(block, rows)
            distinct, inverse = np.unique(own, return_inverse=True)
            times = np.bincount(inverse, minlength=len(distinct))
            twice = times > 1
            # Four bytes of a hash and its bucket; a chance collision only sends a context too many.
            asks, number, begin = [], np.empty(len(distinct), np.uint32), {}
            at_most = 0
            for b, at in exchange.by_bucket(distinct, buckets):
                asks.append((b, exchange.pack(b, distinct[at].astype(np.uint32), np.packbits(twice[at]), times[at][twice[at]].astype(np.uint32))))
                number[at], begin[b] = np.arange(at_most, at_most + len(at)), at_most
                at_most += len(at)
            many = np.diff(np.searchsorted(place, rows)).astype(np.uint32)
            # Anchors stand less than a string apart.
            steps = np.diff(place - np.repeat(rows[:-1], many), prepend=0)
            first = (np.cumsum(many) - many)[many > 0]
            steps[first] = place[first] - rows[:-1][many > 0]
            yield asks, exchange.pack(ids[i:j], hashes[i:j], many, steps.astype(np.uint8), number[inverse], begin, at_most)

    return chunk


def _repeated(many: int):
    def decide(asked: list[tuple]) -> tuple[list[bytes | None], list[int]]:
        """For each chunk, which of its distinct anchors occur more than once in the corpus, and which more than ``many`` times."""
        if not asked:
            return [], []
        distinct, inverse = np.unique(np.concatenate([a[1] for a in asked]), return_inverse=True)
        times = np.ones(len(inverse), np.int64)
        at = 0
        for _, hashes, twice, more in asked:
            times[at + np.flatnonzero(np.unpackbits(twice, count=len(hashes)))] = more
            at += len(hashes)
        total = np.zeros(len(distinct), np.int64)
        np.add.at(total, inverse, times)
        total = total[inverse]
        out, at = [], 0
        for bucket, hashes, _, _ in asked:
            own = total[at : at + len(hashes)]
            some = np.flatnonzero(own > 1)
            at += len(hashes)
            out.append(exchange.pack(bucket, some.astype(np.uint32), np.packbits(own[some] > many)) if len(some) else None)
        return out, []

    return decide


def _to_documents(notes: tuple, answers: list[tuple]) -> pa.Table:
    ids, hashes, many, steps, number, begin, at_most = notes
    again, often = np.zeros(at_most, bool), np.zeros(at_most, bool)
    for bucket, some, heavy in answers:
        again[begin[bucket] + some.astype(np.int64)] = True
        often[begin[bucket] + some.astype(np.int64)] = np.unpackbits(heavy, count=len(some)).astype(bool)
    doc = np.repeat(np.arange(len(ids)), many)
    total = np.concatenate([[0], np.cumsum(steps.astype(np.int64))])
    places = total[1:] - np.repeat(total[np.cumsum(many.astype(np.int64)) - many], many)
    kept = again[number] if len(number) else np.zeros(0, bool)
    # The places of anchors with very many are told by their complements.
    places = np.where(often[number], ~places, places) if len(number) else places
    doc, places = doc[kept], places[kept]
    own, cuts = np.unique(doc, return_index=True)
    cuts = np.append(cuts, len(doc))
    lists = [places[a:b].astype("<i4").tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
    return pa.table(
        {"id": pa.array(ids[own], pa.int64()), "hash": pa.array(hashes[own], pa.int64()), "places": pa.array(lists, pa.binary())}
    )


def _names(raw: bytes, span: int) -> bytes:
    """Digests of 16 bytes of all strings of a context."""
    name = hashlib.blake2b
    return b"".join([name(raw[i : i + span], digest_size=16).digest() for i in range(len(raw) - span + 1)])


def _earliest(names: np.ndarray, doc: np.ndarray, start: np.ndarray, text_hash: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of strings with equal names, those at the earliest place (one for each text there), and those at later places."""
    order = np.lexsort((text_hash, start, doc, names[:, 1], names[:, 0]))
    names, doc, start, text_hash = names[order], doc[order], start[order], text_hash[order]
    new = np.append(True, (names[1:] != names[:-1]).any(axis=1))[: len(order)]
    lead = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    later = (doc != doc[lead]) | (start != start[lead])
    first = ~later & (new | np.append(True, text_hash[1:] != text_hash[:-1])[: len(order)])
    return order[first], order[later]


def _add_starts(out: dict[tuple[int, int], list], doc: np.ndarray, text_hash: np.ndarray, start: np.ndarray) -> None:
    """Add single starts to ``out``, joined to runs."""
    order = np.lexsort((start, text_hash, doc))
    doc, text_hash, start = doc[order], text_hash[order], start[order]
    new = np.append(True, (np.diff(doc) != 0) | (np.diff(text_hash) != 0) | (np.diff(start) > 1))[: len(order)]
    head = np.flatnonzero(new)
    last = np.append(head[1:], len(order))[: len(head)] - 1
    for d, h, a, b in zip(doc[head].tolist(), text_hash[head].tolist(), start[head].tolist(), start[last].tolist()):
        out.setdefault((d, h), []).append((a, b))


def _context_batches(buckets: int, span: int):
    def split(pool: dict, removed: dict) -> list[tuple[int, int, int, bytes]]:
        """Rows for the strings of contexts of anchors with very many places, each string once."""
        if not pool:
            return []
        names = np.frombuffer(b"".join([_names(raw, span) for raw, _ in pool]), "<u8").reshape(-1, 2)
        sizes = np.array([len(raw) - span + 1 for raw, _ in pool], np.int64)
        heads = np.repeat(np.array([v[:3] for v in pool.values()], np.int64), sizes, axis=0)
        doc, start, text_hash = heads.T
        start = start + np.arange(len(start)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        first, later = _earliest(names, doc, start, text_hash)
        _add_starts(removed, doc[later], text_hash[later], start[later])
        names, doc, start, text_hash = names[first], doc[first], start[first].astype(np.int32), text_hash[first]
        found = exchange.by_bucket(names[:, 0], buckets)
        return [(b, 0, exchange.ASK, exchange.pack(names[at], doc[at], start[at], text_hash[at])) for b, at in found]

    def flush(pool: dict, often: dict, removed: dict) -> pa.RecordBatch:
        keys = list(pool)
        own = np.array([pool[k][3] for k in keys], np.uint64)
        rows = split(often, removed)
        for b, at in exchange.by_bucket(own, buckets) if keys else ():
            some = [(pool[keys[i]], keys[i]) for i in at.tolist()]
            heads = np.array([[c[0], c[1], c[2], k[1]] for c, k in some], np.int64)
            rows.append((b, 0, exchange.ASK, exchange.pack(own[at], heads, [k[0] for _, k in some])))
        if removed:
            rows.append((abs(hash(next(iter(removed)))) % buckets, 0, exchange.NOTE, exchange.pack(list(removed.items()))))
        return exchange.rows_of(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pool: dict[tuple[bytes, int], tuple] = {}
        often: dict[tuple[bytes, int], tuple] = {}
        removed: dict[tuple[int, int], list] = {}
        size = 0
        for batch in batches:
            ids, hashes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            data, offsets = text_bytes(batch.column(2))
            lists = batch.column(batch.schema.get_field_index("places")).to_pylist()
            for i, j in _chunks(offsets):
                block, rows = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                first, last, place, own = anchors(block, rows)
                told = [np.frombuffer(p, "<i4").astype(np.int64) for p in lists[i:j]]
                wanted = np.concatenate([np.where(p < 0, ~p, p) + rows[k] for k, p in enumerate(told)])
                heavy = np.concatenate(told) < 0
                by = np.argsort(wanted, kind="stable")
                kept = np.isin(place, wanted)
                first, last, place, own = first[kept], last[kept], place[kept], own[kept]
                heavy = heavy[by][np.searchsorted(wanted[by], place)]
                doc = np.searchsorted(rows, place, side="right") - 1
                begin = first - rows[doc]
                raw = block.tobytes()
                for f, n, off, d, s, h, o in zip(first.tolist(), (last - first + 1).tolist(), (place - first).tolist(), doc.tolist(), begin.tolist(), own.tolist(), heavy.tolist()):
                    key = (raw[f : f + n + span - 1], off)
                    new = (ids[i + d], s, hashes[i + d], h)
                    same = often if o else pool
                    old = same.setdefault(key, new)
                    if old is not new:
                        if new[:2] < old[:2]:
                            same[key], new = new, old
                            old = same[key]
                        if old[:2] < new[:2]:  # else the same place in a row that repeats
                            removed.setdefault((new[0], new[2]), []).append((new[1], new[1] + n - 1))
                    else:
                        size += n * span if o else n + span
                if size > exchange.CHUNK_BYTES:
                    yield flush(pool, often, removed)
                    pool, often, removed, size = {}, {}, {}, 0
        yield flush(pool, often, removed)

    return run


def _less_or_equal(prefix, text, a, b, size_a, size_b, or_equal, base):
    """For pairs of suffixes, whether the first sorts before the second (or is equal, if ``or_equal``)."""
    low, high = np.zeros(len(a), np.int64), np.minimum(size_a, size_b)
    most = high.copy()
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            break
        x, y = a[open_], b[open_]
        middle = (low[open_] + high[open_] + 1) // 2
        same = range_hashes(prefix, x, x + middle, base) == range_hashes(prefix, y, y + middle, base)
        low[open_] = np.where(same, middle, low[open_])
        high[open_] = np.where(same, high[open_], middle - 1)
    ended = low == most
    x, y = text[np.minimum(a + low, len(text) - 1)], text[np.minimum(b + low, len(text) - 1)]
    return np.where(ended, (size_a < size_b) | ((size_a == size_b) & or_equal), x < y), low


def sort_suffixes(text: np.ndarray, begin: np.ndarray, size: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sort the suffixes text[begin : begin + size] within their groups (equal numbers, side by side).

    Returns the order and, for each place in it, the bytes in common with the suffix before it (-1
    for the first of a group). Bottom-up mergesort; all merges of a level run together.
    """
    for base in _BASES:
        prefix = prefix_hashes(text, base)
        order, common = _merge_sort(prefix, text, begin, size, group, base)
        if _verified(text, begin[order], common):
            return order, common
    raise RuntimeError("prefix hashes collided under every base")


def _merge_sort(prefix, text, begin, size, group, base):
    n = len(begin)
    place = np.arange(n)
    head = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if n else np.zeros(0, np.int64)
    tail = np.append(head[1:], n)
    start, stop = np.repeat(head, tail - head), np.repeat(tail, tail - head)
    order, width, most = place.copy(), 1, int((tail - head).max(initial=0))
    while width < most:
        run = (place - start) // width
        other = start + (run ^ 1) * width
        there = np.flatnonzero(other < stop)
        low, high = other[there].copy(), np.minimum(other + width, stop)[there]
        left = (run[there] & 1) == 0
        own = order[there]
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            middle = (low[open_] + high[open_]) // 2
            x, y = order[middle], own[open_]
            # Equal suffixes of the left run stay before those of the right run.
            less, _ = _less_or_equal(prefix, text, begin[x], begin[y], size[x], size[y], ~left[open_], base)
            low[open_] = np.where(less, middle + 1, low[open_])
            high[open_] = np.where(less, high[open_], middle)
        ahead = np.zeros(n, np.int64)
        ahead[there] = low - other[there]
        merged = np.empty_like(order)
        merged[start + (run // 2) * 2 * width + (place - start) % width + ahead] = order
        order, width = merged, 2 * width
    common = np.full(n, -1, np.int64)
    if n > 1:
        x, y = order[:-1], order[1:]
        _, same = _less_or_equal(prefix, text, begin[x], begin[y], size[x], size[y], True, base)
        common[1:] = np.where(group[x] == group[y], same, -1)
    return order, common


def _verified(text: np.ndarray, begin: np.ndarray, common: np.ndarray) -> bool:
    """Whether neighbours really share the bytes that their hashes say."""
    for at in range(1, len(begin), 1 << 14):
        some = np.arange(at, min(at + (1 << 14), len(begin)))
        sizes = np.maximum(common[some], 0)
        steps = np.arange(int(sizes.max(initial=0)))
        inside = steps[None, :] < sizes[:, None]
        x = text[np.minimum(begin[some - 1][:, None] + steps, len(text) - 1)]
        y = text[np.minimum(begin[some][:, None] + steps, len(text) - 1)]
        if ((x != y) & inside).any():
            return False
    return True


def _sort_group_slice(own: np.ndarray, heads: np.ndarray, raws: list[bytes], span: int) -> list[tuple[int, int, int]]:
    """(context, first step, last step) of the strings that start earlier too, in contexts of whole groups."""
    sizes = np.array([len(r) for r in raws], np.int64)
    text = np.frombuffer(b"".join(raws), np.uint8)
    begin = np.cumsum(sizes) - sizes
    off = heads[:, 3]
    starts = sizes - span + 1
    order, common = sort_suffixes(text, begin + off, sizes - off, own)
    back, back_common = sort_suffixes(text[::-1].copy(), len(text) - (begin + off), off, own)
    # The earliest context comes first wherever two strings are equal.
    earlier = np.empty(len(own), np.int64)
    earlier[np.lexsort((heads[:, 1] + off, heads[:, 0]))] = np.arange(len(own))
    gone: list[tuple[np.ndarray, np.ndarray]] = []
    for o in range(int(off.max(initial=0)) + 1):
        inside = np.flatnonzero((off - o >= 0) & (off - o < starts))
        if len(inside) < 2:
            continue
        right, left = np.empty(len(own), np.int64), np.empty(len(own), np.int64)
        right[order], left[back] = np.cumsum(common < span - o), np.cumsum(back_common < o)
        pair = right[inside] * (len(own) + 1) + left[inside]
        by = np.lexsort((earlier[inside], pair))
        again = np.append(False, pair[by][1:] == pair[by][:-1])
        if not again.any():
            continue
        # Strings at the very place of the earliest one belong to a row that repeats and stay.
        lead = inside[by][np.maximum.accumulate(np.where(again, 0, np.arange(len(by))))]
        found = inside[by]
        start = heads[:, 1] + off - o
        later = again & ((heads[found, 0] != heads[lead, 0]) | (start[found] != start[lead]))
        gone.append((found[later], off[found[later]] - o))
    if not gone:
        return []
    context, step = (np.concatenate(c) for c in zip(*gone))
    by = np.lexsort((step, context))
    context, step = context[by], step[by]
    new = np.append(True, (np.diff(context) != 0) | (np.diff(step) != 1))
    last = np.append(np.flatnonzero(new)[1:] - 1, len(by) - 1)
    return list(zip(context[new].tolist(), step[new].tolist(), step[last].tolist()))


def _removed_of(span: int):
    def run(table: pa.Table) -> pa.Table:
        out: dict[tuple[int, int], list] = {}
        pool: dict[tuple[bytes, int], tuple] = {}
        strings: list[tuple] = []
        for kind, payload in zip(table["kind"].to_pylist(), table["payload"].to_pylist()):
            parts = pickle.loads(payload)
            if kind == exchange.NOTE:
                for doc, runs in parts[0]:
                    out.setdefault(doc, []).extend(runs)
                continue
            if len(parts) == 4:
                strings.append(parts)
                continue
            hashes, heads, raws = parts
            for h, (doc, s, text_hash, off), raw in zip(hashes.tolist(), heads.tolist(), raws):
                new = (doc, s, text_hash, h)
                old = pool.setdefault((raw, off), new)
                if old is not new:
                    if new[:2] < old[:2]:
                        pool[raw, off], new, old = new, old, new
                    if old[:2] < new[:2]:
                        out.setdefault((new[0], new[2]), []).append((new[1], new[1] + len(raw) - span))
        if strings:
            names, doc, start, text_hash = (np.concatenate(c) for c in zip(*strings))
            _, later = _earliest(names, doc, start, text_hash)
            _add_starts(out, doc[later], text_hash[later], start[later])
        keys = list(pool)
        own = np.array([pool[k][3] for k in keys], np.uint64)
        by_hash = np.argsort(own, kind="stable")
        lone = np.append(True, own[by_hash][1:] != own[by_hash][:-1])
        lone &= np.append(lone[1:], True)
        by_hash = by_hash[~lone] if len(keys) else by_hash
        at = 0
        while at < len(by_hash):
            size, stop = 0, at
            while stop < len(by_hash) and (size < _SLICE or own[by_hash[stop]] == own[by_hash[stop - 1]]):
                size += len(keys[by_hash[stop]][0])
                stop += 1
            some = by_hash[at:stop].tolist()
            heads = np.array([[*pool[keys[i]][:3], keys[i][1]] for i in some], np.int64)
            raws = [keys[i][0] for i in some]
            for c, first, last in _sort_group_slice(own[by_hash[at:stop]], heads, raws, span):
                doc, s = (int(heads[c, 0]), int(heads[c, 2])), int(heads[c, 1])
                out.setdefault(doc, []).append((s + first, s + last))
            at = stop
        docs = list(out)
        return pa.table(
            {
                "id": pa.array([d[0] for d in docs], pa.int64()),
                "hash": pa.array([d[1] for d in docs], pa.int64()),
                "starts": pa.array([_joined(out[d], 1).tobytes() for d in docs], pa.binary()),
            }
        )

    return run


def _joined(runs: list | np.ndarray, reach: int) -> np.ndarray:
    """Sorted (first, last) pairs, those that overlap or stand ``reach`` apart joined."""
    pairs = np.array(runs, "<i4").reshape(-1, 2)
    pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
    if not len(pairs):
        return pairs
    top = np.maximum.accumulate(pairs[:, 1])
    new = np.append(True, pairs[1:, 0] > top[:-1] + reach)
    last = np.append(np.flatnonzero(new)[1:] - 1, len(pairs) - 1)
    return np.stack([pairs[new, 0], top[last]], axis=1).astype("<i4")


def _kept_batches(span: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            removed, runs, digests, kept = [], [], [], []
            for k, lists in enumerate(batch.column(2).to_pylist()):
                raw = data[offsets[k] : offsets[k + 1]].tobytes()
                pairs = np.concatenate([np.frombuffer(x, "<i4").reshape(-1, 2) for x in lists or [b""]])
                # Strings at most ``span`` apart leave no byte between them.
                gone = [(a, b + span) for a, b in _joined(pairs, span).tolist()]
                left, at = [], 0
                for a, b in gone:
                    left.append(raw[at:a])
                    at = b
                left.append(raw[at:])
                text = b"".join(left)
                removed.append(len(raw) - len(text))
                runs.append(len(gone))
                digests.append(hashlib.sha256(text).hexdigest())
                kept.append(text.decode(errors="ignore"))
            yield pa.record_batch(
                {
                    "row": batch.column(0),
                    "n_bytes": pa.array(np.diff(offsets), pa.int64()),
                    "n_removed": pa.array(removed, pa.int64()),
                    "n_spans": pa.array(runs, pa.int64()),
                    "kept_sha256": pa.array(digests, pa.string()),
                    "kept_text": pa.array(kept, pa.string()),
                }
            )

    return run


def _sent(keyed: DataFrame, buckets: int, span: int, many: int) -> DataFrame:
    """What goes to the buckets: contexts, strings of anchors with more than ``many`` places, and starts that go already."""
    asked = exchange.ask(keyed.select("id", "hash", "text"), _questions(buckets), buckets)
    found = exchange.receive(
        exchange.answer(asked, _repeated(many)), _to_documents, "id bigint, hash bigint, places binary"
    )
    # Rows that repeat have the same anchors; one of them brings its places for all.
    found = found.groupBy("id", "hash").agg(F.max("places").alias("places"))
    # Both joins move the same columns of the documents by the same key, so that they move once.
    sent = keyed.join(found, ["id", "hash"]).select("id", "hash", "text", "row", "places")
    return sent.mapInArrow(_context_batches(buckets, span), exchange.ROWS)


def remove_repeats(docs: DataFrame, row: list[str], span: int = SPAN, many: int = MANY) -> DataFrame:
    """``row`` columns (as a struct; none of them the text), n_bytes, n_removed, n_spans, kept_sha256, kept_text of each document.

    Bytes are those of the whole UTF-8 text; a null text is empty and keeps nothing. A byte goes if a
    string of ``span`` bytes that covers it starts earlier too: in a document with a smaller doc_id, or
    in the same one further left. Null ids count as smallest, and rows with one id as the same document:
    at equal places neither is earlier, so exact repeats of a row are all kept. Texts shorter than
    ``span`` lose nothing. ``kept_text`` drops characters of which only a part is left. Other columns
    are carried in the struct only, so their names cannot clash. No rows give no rows.
    """
    _, size = text_size(docs)
    buckets = exchange.buckets_for(size)
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_FIRST)).alias("id"),
        F.xxhash64(text).alias("hash"),
        text.alias("text"),
        F.struct(*row).alias("row"),
    )
    contexts = _sent(keyed, buckets, span, many)
    removed_in = _removed_of(span)
    starts = contexts.groupBy("bucket").applyInArrow(lambda t: removed_in(t), "id bigint, hash bigint, starts binary")
    starts = starts.groupBy("id", "hash").agg(F.collect_list("starts").alias("starts"))
    kind = keyed.schema["row"].dataType.simpleString()
    return (
        keyed.join(starts, ["id", "hash"], "left")
        .select("row", "text", "starts")
        .mapInArrow(
            _kept_batches(span),
            f"row {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept_text string",
        )
    )


def repeated_bytes(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    found = remove_repeats(docs, ["doc_id"])
    return found.select("row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
