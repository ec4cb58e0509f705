"""Toxicity: gradient-boosted trees over a dozen dense features, with isotonic calibration.

The features of a document: densities of lexicon words (plain, and with look-alike signs undone),
how near they stand to second-person words, capitals, punctuation, and signs inside words. The
lexicon is learned from the labelled sample: words whose documents are toxic far more often than
documents are. Trees are fitted on three quarters of the sample and calibrated on the rest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from termloom.llm.classify import FOLDS, fit_in_one_task, training_rows
from termloom.llm.tables import held_out
from termloom.llm.words import LOWER, WORD, spans, text_bytes, word_hashes, words

CUT = 0.5
LEXICON = 512  # words at most
NEAR = 5  # words between a lexicon word and a second-person word
TREES, DEPTH, RATE, BINS = 60, 3, 0.2, 32
_BLOCK = 1 << 20

# Second-person words in the languages that the library's examples use; fixed values.
SECOND_PERSON = (
    "you your yours yourself u ur du dich dir dein deine ihr euch sie tu te toi ton ta tes vous votre vos "
    "tú ti tuyo usted ustedes vosotros vuestro su sus"
).split()

# Signs that stand for letters; fixed values.
LOOK_ALIKES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "*": ""}

FEATURES = (
    "lexicon", "lexicon_weight", "lexicon_max", "disguised", "disguised_weight", "near_second", "second",
    "capitals", "all_caps", "exclamation", "punctuation", "signs_in_words", "digits_in_words", "repeated", "length",
    "hits",
)

_UNDONE = LOWER.copy()
for _sign, _letter in LOOK_ALIKES.items():
    if _letter:
        _UNDONE[ord(_sign)] = ord(_letter)
_SIGN = np.zeros(256, bool)
_SIGN[[ord(s) for s in LOOK_ALIKES]] = True
_LETTER = WORD.copy()
_LETTER[48:58] = False
_MIXED = WORD | _SIGN
_CAPITAL = np.zeros(256, bool)
_CAPITAL[65:91] = True
_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[33:127] = ~WORD[33:127]


def hash_words(texts: list[str]) -> np.ndarray:
    """Hashes as the scanner gives them."""
    raw = [t.encode() for t in texts]
    rows = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    return word_hashes(np.frombuffer(b"".join(raw), np.uint8), rows[:-1], rows[1:])


def _weights(hashes: np.ndarray, lexicon: np.ndarray, weights: np.ndarray) -> np.ndarray:
    if not len(lexicon):
        return np.zeros(len(hashes))
    at = np.minimum(np.searchsorted(lexicon, hashes), len(lexicon) - 1)
    return np.where(lexicon[at] == hashes, weights[at], 0.0)


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _peaks(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    out = np.zeros(len(bounds) - 1)
    some = bounds[1:] > bounds[:-1]
    if some.any():
        out[some] = np.maximum.reduceat(np.append(values, 0.0), bounds[:-1][some])
    return out


def dense(data: np.ndarray, rows: np.ndarray, lexicon: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The features of the texts that begin at ``rows`` in ``data``."""
    lower = LOWER[data]
    starts, ends = words(data, rows)
    bounds = np.searchsorted(starts, rows)
    n = np.maximum(1, np.diff(bounds)).astype(np.float64)
    size = np.maximum(1, np.diff(rows)).astype(np.float64)
    h = word_hashes(lower, starts, ends)
    w = _weights(h, lexicon, weights)
    hit = w > 0
    second = np.isin(h, _SECOND)
    # Second-person words up to each word, and so those within NEAR words of a hit in its text.
    place = np.arange(len(h))
    low = np.maximum(place - NEAR, np.repeat(bounds[:-1], np.diff(bounds)))
    high = np.minimum(place + NEAR + 1, np.repeat(bounds[1:], np.diff(bounds)))
    seen = np.concatenate([[0], np.cumsum(second)])
    near = hit & (seen[high] > seen[low]) if len(h) else hit
    # Words in which signs may stand for letters; those that are plain words count above.
    mixed_starts, mixed_ends = words(data, rows, _MIXED)
    mixed_bounds = np.searchsorted(mixed_starts, rows)
    letters = np.concatenate([[0], np.cumsum(_LETTER[data])])
    signs = np.concatenate([[0], np.cumsum(_SIGN[data])])
    has = (letters[mixed_ends] > letters[mixed_starts]) & (signs[mixed_ends] > signs[mixed_starts])
    undone = np.zeros(len(mixed_starts))
    if has.any():
        undone[has] = _weights(word_hashes(_UNDONE[data], mixed_starts[has], mixed_ends[has]), lexicon, weights)
    middle = np.zeros(len(data), bool)
    middle[1:-1] = _LETTER[data[:-2]] & _LETTER[data[2:]]
    capital = _CAPITAL[data]
    capitals = np.concatenate([[0], np.cumsum(capital)])
    shouted = (capitals[ends] - capitals[starts] == ends - starts) & (ends - starts > 1)
    again = np.zeros(len(data), bool)
    again[2:] = (lower[2:] == lower[1:-1]) & (lower[2:] == lower[:-2]) & _LETTER[data[2:]]
    of_bytes = lambda flag: _sums(flag, rows)
    out = [
        _sums(hit, bounds) / n, _sums(w, bounds) / n, _peaks(w, bounds),
        _sums(undone > 0, mixed_bounds) / n, _sums(undone, mixed_bounds) / n,
        _sums(near, bounds) / n, _sums(second, bounds) / n,
        of_bytes(capital) / size, _sums(shouted, bounds) / n,
        of_bytes(data == 33) / size, of_bytes(_PUNCTUATION[data]) / size,
        of_bytes(middle & _SIGN[data] & ~WORD[data]) / n, of_bytes(middle & _SIGN[data] & WORD[data]) / n,
        of_bytes(again) / n, np.log1p(np.diff(bounds)), _sums(hit, bounds) + _sums(undone > 0, mixed_bounds),
    ]
    return np.stack(out, axis=1)


_SECOND = hash_words(SECOND_PERSON)


def learn_lexicon(texts: list[bytes], labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted word hashes and their log odds: words seen in five toxic documents or more, and
    there at least eight times as likely as in others."""
    in_toxic: dict[int, int] = {}
    found = []
    for text, label in zip(texts, labels):
        data = LOWER[np.frombuffer(text, np.uint8)]
        starts, ends = words(data, np.array([0, len(data)]))
        own = np.unique(word_hashes(data, starts, ends))
        found.append((own, label))
        if label:
            for x in own.tolist():
                in_toxic[x] = in_toxic.get(x, 0) + 1
    common = np.array(sorted(k for k, v in in_toxic.items() if v >= 5), np.uint64)
    clean = np.zeros(len(common))
    for own, label in found:
        if not label and len(common):
            clean[np.searchsorted(common, own[np.isin(own, common, assume_unique=True)])] += 1
    toxic = np.array([in_toxic[k] for k in common.tolist()], np.float64)
    n_toxic, n_clean = max(1, int(labels.sum())), max(1, int((1 - labels).sum()))
    odds = np.log((toxic + 0.5) / (n_toxic + 1)) - np.log((clean + 0.5) / (n_clean + 1))
    best = np.flatnonzero(odds > np.log(8))
    # The weight of evidence: rare words with high odds come after frequent ones.
    best = best[np.lexsort((common[best], -odds[best] * toxic[best]))][:LEXICON]
    best.sort()
    return common[best], odds[best]


def grow(x: np.ndarray, y: np.ndarray, edges: list[np.ndarray]) -> list[tuple]:
    """Trees (feature, cut, left, right, value arrays) boosted on the logistic loss."""
    coded = np.stack([np.searchsorted(e, x[:, k], side="left") for k, e in enumerate(edges)], axis=1)
    raw, trees = np.zeros(len(y)), []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-raw))
        gradient, weight = y - p, p * (1 - p)
        nodes = [(np.arange(len(y)), 0)]
        tree: list[list[float]] = [[-1, 0.0, 0, 0, 0.0]]
        at = 0
        while at < len(nodes):
            rows, depth = nodes[at]
            g, h = gradient[rows].sum(), weight[rows].sum()
            tree[at][4] = RATE * g / (h + 1.0)
            best = (1e-6, -1, -1)
            if depth < DEPTH and len(rows) >= 20:
                for k, e in enumerate(edges):
                    if not len(e):
                        continue
                    gs = np.cumsum(np.bincount(coded[rows, k], gradient[rows], len(e) + 1))[:-1]
                    hs = np.cumsum(np.bincount(coded[rows, k], weight[rows], len(e) + 1))[:-1]
                    gain = gs**2 / (hs + 1) + (g - gs) ** 2 / (h - hs + 1) - g**2 / (h + 1)
                    gain[(hs < 0.5) | (h - hs < 0.5)] = 0
                    top = int(np.argmax(gain))
                    if gain[top] > best[0]:
                        best = (gain[top], k, top)
            if best[1] >= 0:
                left = coded[rows, best[1]] <= best[2]
                tree[at][:4] = [best[1], edges[best[1]][best[2]], len(nodes), len(nodes) + 1]
                nodes += [(rows[left], depth + 1), (rows[~left], depth + 1)]
                tree += [[-1, 0.0, 0, 0, 0.0], [-1, 0.0, 0, 0, 0.0]]
            else:
                raw[rows] += tree[at][4]
            at += 1
        trees.append(tuple(np.array(c) for c in zip(*tree)))
    return trees


def boosted(x: np.ndarray, trees: list[tuple]) -> np.ndarray:
    total = np.zeros(len(x))
    for feature, cut, left, right, value in trees:
        node = np.zeros(len(x), np.int64)
        for _ in range(DEPTH):
            k = feature[node].astype(np.int64)
            inner = k >= 0
            goes_left = x[np.arange(len(x)), np.maximum(k, 0)] <= cut[node]
            node = np.where(inner, np.where(goes_left, left[node], right[node]).astype(np.int64), node)
        total += value[node]
    return total


def isotonic(raw: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Raw values and non-decreasing probabilities, by pooling adjacent violators."""
    order = np.argsort(raw, kind="stable")
    blocks: list[list[float]] = []  # sum of labels, weight, sum of raw values
    for r, v in zip(raw[order], y[order]):
        blocks.append([v, 1.0, r])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    return np.array([b[2] / b[1] for b in blocks]), np.array([b[0] / b[1] for b in blocks])


def fit(texts: list[bytes], labels: list[int]) -> dict:
    y = np.array(labels, np.float64)
    part = np.arange(len(y)) % 4 == 0  # the rows come in the order of their texts
    lexicon, weights = learn_lexicon([t for t, p in zip(texts, part) if not p], y[~part])
    x = np.concatenate([_features(some, lexicon, weights) for some in _in_blocks(texts)])
    edges = []
    for k in range(x.shape[1]):
        distinct = np.unique(x[~part, k])
        some = np.unique(np.quantile(distinct, np.linspace(0, 1, BINS + 1)[1:-1])) if len(distinct) > 1 else distinct[:0]
        edges.append(some)
    trees = grow(x[~part], y[~part], edges) if (~part).any() else []
    at, value = isotonic(boosted(x[part], trees), y[part])
    return {"lexicon": lexicon, "weights": weights, "trees": trees, "at": at, "value": value}


def _in_blocks(texts: list[bytes]) -> Iterator[list[bytes]]:
    for at in range(0, len(texts), 500):
        yield texts[at : at + 500]


def _features(texts: list[bytes], lexicon: np.ndarray, weights: np.ndarray) -> np.ndarray:
    rows = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    return dense(np.frombuffer(b"".join(texts), np.uint8), rows, lexicon, weights)


def scores(data: np.ndarray, offsets: np.ndarray, model: dict) -> np.ndarray:
    out = np.empty(len(offsets) - 1)
    for i, j in spans(offsets, _BLOCK):
        rows = offsets[i : j + 1] - offsets[i]
        x = dense(data[offsets[i] : offsets[j]], rows, model["lexicon"], model["weights"])
        out[i:j] = np.interp(boosted(x, model["trees"]), model["at"], model["value"])
    return np.clip(out, 0.0, 1.0)


def _score_batches(model: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(2))
            score = pa.array(scores(data, offsets, model), pa.float64())
            yield pa.record_batch([batch.column(0), batch.column(1), score], ["doc_id", "held_out", "score"])

    return run


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document; score is a calibrated probability.

    Null and empty texts are scored on features of 0. Null ids are scored and not held out. Rows that
    repeat get the same score; no rows give no rows. Without labels every score is 0. Only doc_id and
    text are read of ``docs``; the label table is read by doc_id and toxic.
    """
    model = fit_in_one_task(training_rows(docs, labels, "toxic"), fit)
    if model is None:
        none = np.zeros(0)
        model = {"lexicon": none.astype(np.uint64), "weights": none, "trees": [], "at": np.zeros(1), "value": np.zeros(1)}
    rows = docs.select("doc_id", held_out("doc_id", FOLDS).alias("held_out"), F.col("text").cast("string"))
    scored = rows.mapInArrow(_score_batches(model), "doc_id bigint, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= CUT).cast("int"))
