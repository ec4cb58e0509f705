"""Near-duplicates: consistent weighted samples of TF-IDF shingles, banded, verified.

A document is the multiset of its runs of SHINGLE words (A-Z lower-cased; fewer words make one run).
A shingle weighs its count times its idf, 1 + ln((N + 1) / (df + 1)) / ln(N + 1), with df counted over
all documents. This idf lies between 1 and 2, so that a text that very many documents repeat with small
changes is not torn apart by its changes. Similarity is the weighted Jaccard of two documents.

1. Chunks of documents ask for the df of their shingles. A shingle that no other document has cannot
   be shared, so a document whose shared weight is under THRESHOLD of its total has no partner and is
   done: an exact bound. The others keep their shared shingles; all that matters of the rest is its weight.
2. Documents with equal vectors become one. Each remaining vector gets BANDS x ROWS samples by improved
   consistent weighted sampling; two vectors agree in a sample with their similarity as probability, so
   a pair at 0.8 misses every band once in 40,000 times.
3. In a bucket (vectors that agree in a band) members are compared with a few leaders, one in the first
   round, four times as many in each next, until all pairs of the bucket that are not connected yet have
   been compared. So buckets of thousands of copies cost one comparison per member, and no link is lost.
4. Classes are the connected components of the verified links.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from termloom.llm import exchange
from termloom.llm.components import components
from termloom.llm.tables import text_size
from termloom.llm.words import LOWER, mix, spans, text_bytes, word_hashes, words
from termloom.session import materialize
from termloom.sizes import broadcast_if_small

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 20, 4
_ALONE = 8  # documents of a chunk with one shingle, beyond which it travels as one number
_MASK48 = np.uint64((1 << 48) - 1)
_SALTS = mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_MIX = (0xA24BAED4963EE407, 0x9FB21C651E98DF25, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
_SLICE = 1 << 13
_DOCUMENTS = (
    "uid bigint, doc_id bigint, sig binary, hashes binary, weights binary, shared double, total double, "
    "bands array<bigint>"
)


def shingles(data: np.ndarray, rows: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of all texts, in order, and the bounds of the texts among them."""
    data = LOWER[data]
    starts, ends = words(data, rows)
    first = np.searchsorted(starts, rows)
    h = word_hashes(data, starts, ends)
    n = len(h)
    sizes = np.diff(first)
    left = np.repeat(first[1:], sizes) - np.arange(n)  # words from here to the end of the text
    total = np.zeros(n, np.uint64)
    for k in range(min(size, n)):
        part = np.zeros(n, np.uint64)
        part[: n - k] = h[k:]
        total += np.where(left > k, part, np.uint64(0)) * np.uint64(_MIX[k % len(_MIX)] + 2 * (k // len(_MIX)))
    whole = np.repeat(sizes < size, sizes) & (left == np.repeat(sizes, sizes))  # a short text's only run
    kept = (left >= size) | whole
    counts = np.concatenate([[0], np.cumsum(kept)])
    return mix(total[kept]), counts[first]


def _distinct(found: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, shingle, count) of all distinct shingles of each document."""
    parts = [np.unique(found[a:b], return_counts=True) for a, b in zip(bounds[:-1], bounds[1:])]
    doc = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
    hashes = np.concatenate([p[0] for p in parts]) if parts else found[:0]
    counts = np.concatenate([p[1] for p in parts]) if parts else bounds[:0]
    return doc, hashes, counts


def _six(hashes: np.ndarray) -> np.ndarray:
    """The low six bytes of each hash; with the bucket, all that is needed to tell shingles apart."""
    return np.ascontiguousarray(hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6])


def _whole(six: np.ndarray) -> np.ndarray:
    out = np.zeros((len(six), 8), np.uint8)
    out[:, :6] = six
    return out.view("<u8").ravel().astype(np.uint64)


def _questions(buckets: int):
    def chunk(batch: pa.RecordBatch):
        ids = batch.column(0).to_pylist()
        data, offsets = text_bytes(batch.column(1))
        for low, high in spans(offsets, exchange.CHUNK_BYTES):
            for i in range(low, high, exchange.CHUNK_DOCS):
                j = min(i + exchange.CHUNK_DOCS, high)
                block, rows = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                found, bounds = shingles(block, rows)
                doc, hashes, tf = _distinct(found, bounds)
                order = np.argsort(hashes, kind="stable")
                doc, hashes, tf = doc[order], hashes[order], tf[order]
                head = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])) if len(hashes) else order
                many = np.diff(np.append(head, len(hashes)))
                own = hashes[head]
                heavy = many > _ALONE
                notes_of = np.full(len(own), -1)
                notes_of[heavy] = np.arange(int(heavy.sum()))
                listed = np.repeat(~heavy, many)
                begin = np.cumsum(np.where(heavy, 0, many)) - np.where(heavy, 0, many)
                docs_listed, tf_listed = doc[listed].astype(np.uint16), np.minimum(tf[listed], 1 << 31).astype(np.uint32)
                asks = []
                for b, at in exchange.by_bucket(own, buckets):
                    sizes = np.where(heavy[at], 0, many[at])
                    flat = np.repeat(begin[at] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
                    asks.append((b, exchange.pack(b, _six(own[at]), many[at].astype(np.uint32), notes_of[at][heavy[at]].astype(np.uint32), docs_listed[flat], tf_listed[flat])))
                marks = [hashlib.blake2b(block[a:z].tobytes(), digest_size=16).digest() if p == q else None for a, z, p, q in zip(rows[:-1], rows[1:], bounds[:-1], bounds[1:])]
                notes = (ids[i:j], np.diff(bounds), marks, many[heavy], doc[~listed].astype(np.uint16), tf[~listed].astype(np.uint32))
                yield asks, exchange.pack(*notes)

    return chunk


def _shared(asked: list[tuple]) -> tuple[list[bytes | None], list[int]]:
    """For each chunk, its shingles that more than one document has, with df and documents."""
    if not asked:
        return [], []
    hashes = np.concatenate([_whole(a[1]) for a in asked])
    distinct, inverse = np.unique(hashes, return_inverse=True)
    df = np.bincount(inverse, np.concatenate([a[2] for a in asked]), len(distinct)).astype(np.int64)[inverse]
    out, at = [], 0
    for bucket, six, many, notes, docs, tf in asked:
        own = df[at : at + len(six)]
        at += len(six)
        kept = own > 1
        if not kept.any():
            out.append(None)
            continue
        heavy = many > _ALONE
        listed = np.repeat(kept[~heavy], many[~heavy])
        light = kept & ~heavy
        hashes = _whole(six) | np.uint64(bucket & 0xFFFF) << np.uint64(48)
        out.append(exchange.pack(hashes[light], own[light], many[light], docs[listed], tf[listed], hashes[heavy], own[heavy], notes))
    return out, []


def samples(hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """BANDS * ROWS consistent weighted samples: equal in two vectors with the probability of their
    weighted Jaccard similarity. ``hashes`` must be distinct, ``weights`` positive."""
    n = len(_SALTS)
    best, found = np.full(n, np.inf), np.zeros(n, np.uint64)
    scale = 2.0**-32
    half = np.uint64(32)
    low = np.uint64(0xFFFFFFFF)
    for at in range(0, len(hashes), _SLICE):
        h = hashes[at : at + _SLICE, None] ^ _SALTS[None, :]
        one = mix(h)
        two = mix(one + np.uint64(_MIX[0]))
        three = mix(two + np.uint64(_MIX[1]))
        part = lambda x: ((x & low).astype(np.float64) + 0.5) * scale
        # Gamma(2, 1) variables as sums of two exponentials; beta is uniform.
        r = -np.log(part(one) * part(one >> half))
        log_c = np.log(-np.log(part(two) * part(two >> half)))
        t = np.floor(np.log(weights[at : at + _SLICE, None]) / r + part(three))
        log_a = log_c - r * (t - part(three)) - r
        k = np.argmin(log_a, axis=0)
        column = np.arange(n)
        less = log_a[k, column] < best
        value = mix(hashes[at + k] ^ mix(t[k, column].astype(np.int64).astype(np.uint64) + _SALTS))
        best = np.where(less, log_a[k, column], best)
        found = np.where(less, value, found)
    return found


def band_keys(values: np.ndarray) -> np.ndarray:
    """One bucket number for each band."""
    table = values.reshape(BANDS, ROWS)
    key = mix(np.arange(1, BANDS + 1, dtype=np.uint64))
    for k in range(ROWS):
        key = mix(key * np.uint64(3) + table[:, k])
    return key.view(np.int64)


def idf(df: np.ndarray, n: int) -> np.ndarray:
    return 1.0 + np.log((n + 1) / (np.minimum(df, n) + 1)) / np.log(n + 1)


def _documents(n_docs: int):
    def finish(chunk: int, notes: tuple, answers: list[tuple]) -> pa.Table:
        ids, sizes, marks, heavy_many, heavy_docs, heavy_tf = notes
        heavy_begin = np.cumsum(heavy_many) - heavy_many
        doc, hashes, tf, df = [], [], [], []
        for light_h, light_df, light_many, light_docs, light_tf, heavy_h, heavy_df, which in answers:
            many = heavy_many[which]
            flat = np.repeat(heavy_begin[which] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
            for h, d, m, docs, f in (
                (light_h, light_df, light_many, light_docs, light_tf),
                (heavy_h, heavy_df, many, heavy_docs[flat], heavy_tf[flat]),
            ):
                doc.append(docs.astype(np.int64))
                hashes.append(np.repeat(h, m))
                tf.append(f.astype(np.int64))
                df.append(np.repeat(d, m))
        join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        doc, hashes, tf, df = join(doc, np.int64), join(hashes, np.uint64), join(tf, np.int64), join(df, np.int64)
        order = np.lexsort((hashes, doc))
        doc, hashes, tf, df = doc[order], hashes[order], tf[order], df[order]
        weights = tf * idf(df, n_docs)
        bounds = np.searchsorted(doc, np.arange(len(ids) + 1))
        once = float(idf(np.array([1]), n_docs)[0])
        base = ((chunk >> 32) << 33) | ((chunk & 0xFFFFF) << 13)
        columns: dict[str, list] = {k: [] for k in ("uid", "doc_id", "sig", "hashes", "weights", "shared", "total", "bands")}
        seen: dict[bytes, list[int]] = {}
        for k, (i, size, mark) in enumerate(zip(ids, sizes.tolist(), marks)):
            a, b = bounds[k], bounds[k + 1]
            uid = base | k
            rest = size - int(tf[a:b].sum())  # shingles that no other document has
            shared = float(weights[a:b].sum())
            row = [uid, i, *[None] * 6]
            if mark is not None:  # no words: alike only if equal
                row[2] = mark
            elif shared >= THRESHOLD * (shared + rest * once) - 1e-9:
                vector = hashes[a:b].astype("<u8").tobytes(), weights[a:b].astype("<f4").tobytes()
                sig = hashlib.blake2b(vector[0] + tf[a:b].tobytes() + (b"" if not rest else uid.to_bytes(8, "little")), digest_size=16).digest()
                if sig not in seen:
                    own = mix(np.arange(1, rest + 1, dtype=np.uint64) * np.uint64(_MIX[2]) + mix(np.array([uid], np.uint64)))
                    h = np.concatenate([hashes[a:b], own])
                    seen[sig] = band_keys(samples(h, np.concatenate([weights[a:b], np.full(rest, once)]))).tolist()
                row[2:] = [sig, *vector, shared, shared + rest * once, seen[sig]]
            for name, value in zip(columns, row):
                columns[name].append(value)
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.float64(), pa.float64(), pa.list_(pa.int64()))
        return pa.table({name: pa.array(v, kind) for (name, v), kind in zip(columns.items(), kinds)})

    return finish


def weighted_jaccard(hashes_a, weights_a, total_a, hashes_b, weights_b, total_b) -> float:
    """Of two vectors with sorted hashes; the totals count what is not listed too."""
    _, x, y = np.intersect1d(hashes_a, hashes_b, assume_unique=True, return_indices=True)
    both = float(np.minimum(weights_a[x], weights_b[y]).sum())
    return both / (total_a + total_b - both) if total_a + total_b > both else 1.0


def _verify_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("a", "b", "ra", "rb")
    for batch in batches:
        kept = []
        for r in batch.to_pylist():
            left = np.frombuffer(r["ha"], "<u8"), np.frombuffer(r["wa"], "<f4"), r["ta"]
            right = np.frombuffer(r["hb"], "<u8"), np.frombuffer(r["wb"], "<f4"), r["tb"]
            if weighted_jaccard(*left, *right) >= THRESHOLD - 1e-6:
                kept.append([r[n] for n in names])
        yield pa.record_batch([pa.array([k[i] for k in kept], pa.int64()) for i in range(4)], list(names))


def _verified(pairs: DataFrame, vectors: DataFrame) -> DataFrame:
    def side(k: str) -> DataFrame:
        names = [F.col("uid").alias(k), *(F.col(c).alias(c[0] + k) for c in ("hashes", "weights", "total"))]
        return vectors.select(*names)

    met = pairs.join(side("a"), "a").join(side("b"), "b")
    return met.mapInArrow(_verify_batches, "a bigint, b bigint, ra bigint, rb bigint")


def link_buckets(vectors: DataFrame) -> DataFrame | None:
    """Links (a, b) between the vectors (uid, hashes, weights, shared, total, bands); None if no two may be alike.

    ``root`` labels what is known to be connected: each round, a vector takes the smallest label among
    those it is linked to. Vectors with one label need no comparison; labels that lag behind only cost some.
    """
    members = vectors.select("uid", "shared", "total", "bands", F.posexplode("bands").alias("band", "bucket"))
    # Two vectors meet in the first bucket that they share: the one without a common bucket before it.
    members = members.withColumn("before", F.slice("bands", F.lit(1), F.col("band"))).drop("bands", "band")
    state = members.withColumn("root", F.col("uid")).withColumn("done", F.lit(False))
    found: list[DataFrame] = []
    leaders = 1
    while True:
        # A bucket is open while members with different labels have not led yet.
        open_ = state.filter("not done").groupBy("bucket").agg((F.min("root") != F.max("root")).alias("more"))
        state = materialize(state.join(open_.filter("more").select("bucket"), "bucket"), "open")
        if state.isEmpty():
            return reduce(DataFrame.unionByName, found) if found else None
        slot = F.pmod(F.xxhash64("uid"), F.lit(leaders))
        led = state.filter("not done").groupBy("bucket", slot.alias("slot")).agg(
            F.min(F.struct("uid", "root", "shared", "total", "before")).alias("l")
        )
        names = {"leader": "uid", "its": "root", "its_shared": "shared", "its_total": "total", "its_before": "before"}
        led = materialize(led.select("bucket", *(F.col(f"l.{c}").alias(n) for n, c in names.items())), "leaders")
        # What both share with others bounds what they can share with each other.
        most = F.least("shared", "its_shared")
        able = most >= THRESHOLD * (F.col("total") + F.col("its_total") - most) - 1e-6
        # A member that has led its bucket has met all others there.
        met = state.filter("not done").join(led, "bucket").filter(
            able & (F.col("root") != F.col("its")) & ~F.arrays_overlap("before", "its_before")
        )
        first = F.col("uid") < F.col("leader")
        sides = [F.when(first, F.col(x)).otherwise(F.col(y)) for x, y in (("uid", "leader"), ("leader", "uid"), ("root", "its"), ("its", "root"))]
        pairs = met.select(*(c.alias(n) for c, n in zip(sides, ("a", "b", "ra", "rb")))).distinct()
        links = materialize(_verified(pairs, vectors), "links")
        found.append(links.select("a", "b"))
        told = links.select(F.col("a").alias("uid"), F.col("rb").alias("new"))
        told = told.unionByName(links.select(F.col("b").alias("uid"), F.col("ra").alias("new")))
        told = told.groupBy("uid").agg(F.min("new").alias("new"))
        state = state.join(told, "uid", "left").withColumn("root", F.least("root", "new")).drop("new")
        now = led.select("bucket", F.col("leader").alias("uid"), F.lit(True).alias("led"))
        state = state.join(now, ["bucket", "uid"], "left")
        state = state.select("uid", "shared", "total", "before", "bucket", "root", (F.col("done") | F.coalesce("led", F.lit(False))).alias("done"))
        leaders *= 4


def near_duplicates(docs: DataFrame) -> DataFrame:
    """uid, doc_id and class of every document: ``class_uid`` names its class, ``class_id`` is the
    smallest doc_id there.

    Documents are alike at a similarity of THRESHOLD or more; a class is what links connect. Texts that
    are equal are alike, also without words, and null texts are empty ones. Null ids take part (a class of
    null ids alone has a null class_id); rows that repeat are documents of their own in one class. No rows
    give no rows; only doc_id and text are read.
    """
    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    n_docs, size = text_size(docs)
    buckets = exchange.buckets_for(size)
    answered = exchange.answer(exchange.ask(rows, _questions(buckets), buckets), _shared)
    documents = materialize(exchange.receive(answered, _documents(max(n_docs, 1)), _DOCUMENTS, with_chunk=True), "shingled")
    alike = documents.filter(F.col("sig").isNotNull()).groupBy("sig").agg(F.min("uid").alias("first"))
    alike = materialize(alike, "alike")
    vectors = documents.filter(F.col("hashes").isNotNull()).join(alike.select(F.col("first").alias("uid")), "uid")
    vectors = materialize(vectors.select("uid", "hashes", "weights", "shared", "total", "bands"), "vectors")
    links = link_buckets(vectors)
    named = documents.select("uid", "doc_id", "sig").join(alike, "sig", "left")
    named = named.select("uid", "doc_id", F.coalesce("first", "uid").alias("node"))
    if links is None:
        classed = named.withColumn("class_uid", F.col("node"))
    else:
        classed = named.join(components(links), "node", "left").withColumn("class_uid", F.coalesce("root", "node"))
    classed = materialize(classed.select("uid", "doc_id", "class_uid"), "classes")
    names = classed.groupBy("class_uid").agg(F.min("doc_id").alias("class_id"))
    return classed.join(names, "class_uid").select("uid", "doc_id", "class_uid", "class_id")


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """The documents, with all their columns, of which one row of each class stays: the smallest doc_id.

    A null doc_id counts as the smallest. Of rows that repeat in doc_id and text one stays; where their other columns differ, the one that is
    first by these as JSON. Null texts are empty ones here.
    """
    key = F.xxhash64(F.col("doc_id").cast("bigint"), F.coalesce(F.col("text"), F.lit("")))
    keyed = docs.select(key.alias("doc_id"), "text")
    # One row for each key and how often it occurs, combined in each task before the shuffle.
    found = near_duplicates(keyed).groupBy(F.col("doc_id").alias("_row"))
    found = found.agg(F.min("class_uid").alias("class_uid"), F.count("*").alias("_n"))
    found = materialize(found, "keys")
    # Classes of one are left out before anything moves.
    more = found.groupBy("class_uid").agg((F.sum("_n") > 1).alias("more")).filter("more").select("class_uid")
    found = materialize(found.join(more, "class_uid"), "in-classes")
    ids = docs.select(F.col("doc_id").cast("bigint").alias("_id"), key.alias("_row"))
    ids = ids.groupBy("_row").agg(F.min("_id").alias("_id"))
    named = found.join(ids, "_row")
    stays = named.groupBy("class_uid").agg(F.min(F.struct("_id", "_row", "_n")).alias("first"))
    stays = materialize(stays.select("first._row", "first._n"), "stays")
    again = materialize(stays.filter("_n > 1").select("_row"), "again")
    gone = found.join(stays, "_row", "left_anti").select("_row").unionByName(again)
    gone = broadcast_if_small(materialize(gone, "gone"))
    # A row travels as one value, so its columns may have any names.
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), key.alias("_row"))
    once = rows.join(gone, "_row", "left_anti").select("row.*")
    if again.isEmpty():
        return once
    others = [F.col(f"row.`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    by = F.to_json(F.struct(*others)) if others else F.lit("")
    repeated = rows.join(broadcast_if_small(again), "_row", "left_semi")
    repeated = repeated.groupBy("_row").agg(F.min_by("row", by).alias("row"))
    return once.unionByName(repeated.select("row.*"))
