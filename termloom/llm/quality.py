"""Quality classifier: logistic regression on hashed word n-grams, trained with FTRL-proximal.

Tokens are runs of letters and digits, A-Z lower-cased, and single other characters. A document's
sparse vector holds hashed unigrams and bigrams of tokens and n-grams of token shapes (length,
kind, whether it repeats one of the last tokens), each as its share of the document's tokens. The
score is the sigmoid of a sparse dot product. The learner sees a bounded sample of labelled
documents (classify.SAMPLE) in one task; every document is scored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from termloom.llm.classify import FOLDS, fit_in_one_task, training_rows
from termloom.llm.tables import held_out
from termloom.llm.words import LOWER, PIECE, WORD, mix, spans, text_bytes, word_hashes

BITS = 18
EPOCHS = 3
CUT = 0.3
_BLOCK = 1 << 20
_SCALE = 12.0  # a feature that every token has gets this value
_ALPHA, _BETA, _L1, _L2 = 0.5, 1.0, 0.002, 0.002
_SALTS = tuple(np.uint64(x) for x in (0x51ED270B, 0x9F1C6B25, 0x2545F491, 0x6C8E9CF5))


def tokens(data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of tokens in ``data``, whose texts begin at ``rows``."""
    word = WORD[data]
    other = PIECE[data] & ~word
    cut = np.zeros(len(data) + 1, bool)
    cut[rows] = True
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1] | cut[1:-1]
    last[:-1] &= ~word[1:] | cut[1:-1]
    return np.flatnonzero(first | other), np.flatnonzero(last | other) + 1


def features(data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of each token, one column per n-gram kind (-1 where its n-gram would leave
    the text), and the bounds of the texts among the tokens."""
    data = LOWER[data]
    starts, ends = tokens(data, rows)
    bounds = np.searchsorted(starts, rows)
    n = len(starts)
    out = np.full((n, 4), -1, np.int64)
    if not n:
        return out, bounds
    h = word_hashes(data, starts, ends)
    left = np.repeat(np.diff(bounds), np.diff(bounds)) - 1 - (np.arange(n) - np.repeat(bounds[:-1], np.diff(bounds)))
    since = np.arange(n) - np.repeat(bounds[:-1], np.diff(bounds))
    shape = np.minimum(ends - starts, 15).astype(np.uint64) * np.uint64(2) + WORD[data[starts]]
    repeats = np.zeros(n, np.uint64)
    for back in (1, 2, 3, 4):
        same = np.zeros(n, bool)
        same[back:] = (h[back:] == h[:-back]) & (since[back:] >= back)
        repeats = np.where((repeats == 0) & same, np.uint64(back), repeats)
    shape = shape * np.uint64(8) + repeats
    mask = np.uint64((1 << BITS) - 1)
    out[:, 0] = mix(h ^ _SALTS[0]) & mask
    out[:-1, 1] = mix(h[:-1] * np.uint64(3) + h[1:] + _SALTS[1]) & mask
    out[:, 2] = mix(shape + _SALTS[2]) & mask
    out[:-2, 3] = mix((shape[:-2] << np.uint64(40)) + (shape[1:-1] << np.uint64(20)) + shape[2:] + _SALTS[3]) & mask
    out[left < 1, 1] = -1
    out[left < 2, 3] = -1
    return out, bounds


def fit(texts: list[bytes], labels: list[int], epochs: int = EPOCHS) -> np.ndarray:
    """Weights: one for each hashed feature and the intercept last."""
    size = (1 << BITS) + 1
    z, n, w = np.zeros(size), np.zeros(size), np.zeros(size)
    order = np.random.default_rng(7).permutation(len(texts))
    y = np.array(labels, np.float64)
    for _ in range(epochs):
        for at in range(0, len(order), 256):
            some = order[at : at + 256]
            data = np.frombuffer(b"".join(texts[i] for i in some), np.uint8)
            rows = np.concatenate([[0], np.cumsum([len(texts[i]) for i in some])]).astype(np.int64)
            found, bounds = features(data, rows)
            for k, doc in enumerate(some):
                own = found[bounds[k] : bounds[k + 1]]
                index, count = np.unique(own[own >= 0], return_counts=True)
                index = np.append(index, size - 1)
                x = np.append(count * (_SCALE / max(1, len(own))), 1.0)
                # The weights that this document uses, from the sums of past gradients.
                zi, ni = z[index], n[index]
                wi = np.where(
                    np.abs(zi) <= _L1, 0.0, -(zi - np.sign(zi) * _L1) / ((_BETA + np.sqrt(ni)) / _ALPHA + _L2)
                )
                p = 1 / (1 + np.exp(-np.clip(wi @ x, -35, 35)))
                g = (p - y[doc]) * x
                step = (np.sqrt(ni + g * g) - np.sqrt(ni)) / _ALPHA
                z[index] += g - step * wi
                n[index] += g * g
    w = np.where(np.abs(z) <= _L1, 0.0, -(z - np.sign(z) * _L1) / ((_BETA + np.sqrt(n)) / _ALPHA + _L2))
    return w.astype(np.float32)


def scores(data: np.ndarray, offsets: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The score of each text: sigmoid of its sparse dot product with the weights."""
    table = np.append(weights[:-1], np.float32(0))  # -1 finds the zero at the end
    out = np.empty(len(offsets) - 1)
    for i, j in spans(offsets, _BLOCK):
        rows = offsets[i : j + 1] - offsets[i]
        found, bounds = features(data[offsets[i] : offsets[j]], rows)
        per_token = np.zeros(len(found))
        for kind in range(found.shape[1]):
            per_token += table[found[:, kind]]
        total = np.concatenate([[0], np.cumsum(per_token)])
        dot = (total[bounds[1:]] - total[bounds[:-1]]) * _SCALE / np.maximum(1, np.diff(bounds))
        out[i:j] = dot + weights[-1]
    return 1 / (1 + np.exp(-np.clip(out, -35, 35)))


def score_batches(weights: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(batch.schema.get_field_index("text")))
            yield batch.append_column("score", pa.array(scores(data, offsets, weights), pa.float64()))

    return run


def learn(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """The model: 2**BITS + 1 weights, whatever the corpus. All zero without labelled rows."""
    found = fit_in_one_task(training_rows(docs, labels, "quality"), fit)
    return np.zeros((1 << BITS) + 1, np.float32) if found is None else found


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document; score tends to 1 for label 1.

    Null and empty texts get the intercept alone. Null ids are scored and not held out. Rows that
    repeat get the same score; no rows give no rows. Without labels every score is 0.5. Only doc_id
    and text are read of ``docs``; the label table is read by doc_id and quality.
    """
    weights = learn(docs, labels)
    rows = docs.select("doc_id", held_out("doc_id", FOLDS).alias("held_out"), F.col("text").cast("string"))
    scored = rows.mapInArrow(score_batches(weights), "doc_id bigint, held_out boolean, text string, score double")
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents, with all their columns, whose score reaches CUT.

    Nulls, empty texts and repeated rows as in ``score_quality``; a row travels as one value, so its columns may
    have any names. No rows give no rows.
    """
    weights = learn(docs, labels)
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col("text").cast("string").alias("text"))
    scored = rows.mapInArrow(score_batches(weights), StructType([*rows.schema.fields, StructField("score", DoubleType())]))
    return scored.filter(F.col("score") >= CUT).select("row.*")
