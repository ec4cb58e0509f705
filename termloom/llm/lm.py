"""Language-model scores: a causal self-attention model on subword ids, with corpus counts.

The probability of a word is a mixture of three. One is the product of the probabilities of its subword
ids under a small causal self-attention model, trained in numpy on all training documents: it begins on a
few (SAMPLE_DOCS), then ROUNDS parts of the corpus follow. In a round, each task goes on from the model so
far with its share of the part, and the weights are averaged, those of an id by how often a task met it.
Each training text is taken once and whole, long ones in windows of LEARNED_IDS. The model predicts a group of ids and a slot there; frequent ids have slots of their
own, and the others their share of the training ids of their slot. The second is the word's share of all
training words, the third its share of the text so far. Counts of words and ids cover the whole corpus.

A text is scored in windows of two blocks: the positions of the second block attend to themselves and
to the first, so that every id is scored once, with at least a block of context where the text has it.
All windows of a batch are computed together, and a mask keeps attention from looking ahead or into
another text.
"""

from __future__ import annotations

import base64
import ctypes
import os
import pickle
import re
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from termloom.llm import exchange
from termloom.llm.tables import crc_fold, held_out, text_size
from termloom.llm.words import LOWER, PIECE, spans, text_bytes, texts_of, word_hashes, words as words_in
from termloom.session import materialize

FOLDS = 10
SAMPLE_DOCS = 1200
VOCABULARY = "byte_bpe_50k.tiktoken"
IDS = 50_257
END_ID = 50_256
END = b"\n"  # stands for the end token among words; no word holds it
BLOCK, WIDTH, GROUPS, SLOTS = 16, 16, 64, 32
LEARNED_IDS = 8192  # of one window of a text
ROUNDS, ROUND_RATE, STEP_IDS = 4, 0.004, 4096
_SHARDS = 256  # tasks of a round at most
_PARTS = 16  # parts in which sums over tasks are formed
OWN, OWN_PLACES = 0.25, 100  # weight of the text's own words at most, and words until half of it
_CACHE = 400_000
_BATCH = 1 << 13  # positions computed at once
_NOTE_BYTES = 4 << 20  # of notes that go to a Python worker at once
_WORDS = 256  # coded as one text
_KEPT_BYTES = 64 << 20  # of freed memory that a worker keeps while it computes
_BLANK = re.compile(r"[^\S ]")


class WordIds:
    """Subword ids of words (a space before each), cached."""

    def __init__(self):
        with open(public_tokenizers.path(VOCABULARY), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.coder = tiktoken.Encoding(
            "words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.known: dict[bytes, list[int]] = {}
        self.bytes = np.zeros(IDS, np.int64)  # of each id
        self.bytes[list(ranks.values())] = list(map(len, ranks))

    def __call__(self, words: list[bytes]) -> list[list[int]]:
        if len(self.known) > _CACHE:
            self.known = {}
        known, code = self.known, self.coder.encode_ordinary
        out = []
        for w in words:
            ids = known.get(w)
            if ids is None:
                ids = [END_ID] if w == END else code(" " + w.decode())
                known[w] = ids
            out.append(ids)
        return out

    def flat(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each word has, and all ids in order.

        The pattern cuts a text before each single space, so words are coded many at once; those that hold
        white space beyond ASCII (and their neighbours here) go one by one.
        """
        sizes, ids = [np.zeros(0, np.int64)], [np.zeros(0, np.uint16)]
        for low in range(0, len(words), _WORDS):
            some = words[low : low + _WORDS]
            text = (b" " + b" ".join(some)).decode()
            if _BLANK.search(text):
                found = self(some)
                sizes.append(np.array([len(x) for x in found], np.int64))
                ids.append(np.array([y for x in found for y in x], np.uint16))
            else:
                found = self.coder.encode_to_numpy(text, disallowed_special=())
                ends = np.cumsum([len(w) + 1 for w in some])
                sizes.append(np.diff(np.searchsorted(np.cumsum(self.bytes[found]), ends), prepend=-1))
                ids.append(found.astype(np.uint16))
        return np.concatenate(sizes), np.concatenate(ids)


def text_words(raw: bytes) -> list[bytes]:
    """Words with A-Z lower-cased, then the end."""
    found = raw.lower().split()
    found.append(END)
    return found


def numbered_words(data: np.ndarray, rows: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The distinct words of texts laid end to end (``rows``: their offsets) and the end as the last one;
    the number of each word and end in order; how many each text has."""
    lower = LOWER[data]
    starts, ends = words_in(lower, rows, PIECE)
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(lower[PIECE[lower]])]
    found = pa.Array.from_buffers(pa.large_binary(), len(starts), buffers).dictionary_encode()
    distinct = found.dictionary.to_pylist()
    before = np.searchsorted(starts, rows)
    flat = np.insert(found.indices.to_numpy().astype(np.int64), before[1:], len(distinct))
    return [*distinct, END], flat, np.diff(before) + 1


# --- the model -------------------------------------------------------------------------------


def _places(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All ids by falling frequency, and the place of each among the most frequent (the same for all others)."""
    own = GROUPS * (SLOTS - 1)
    order = np.lexsort((np.arange(len(counts)), -counts))
    place = np.full(len(counts), own)
    place[order[:own]] = np.arange(own)
    return order, place


def _pairs(place: np.ndarray, flat: np.ndarray) -> np.ndarray:
    """How often each place stands before each other."""
    n = GROUPS * (SLOTS - 1) + 1
    at = place[flat]
    return np.bincount(at[:-1] * n + at[1:], minlength=n * n)


def neighbours(pairs: np.ndarray) -> np.ndarray:
    """For each place, what follows and what precedes it, projected at random, and how much that is."""
    n = GROUPS * (SLOTS - 1) + 1
    table = pairs.reshape(n, n).astype(np.float64, copy=False)
    signs = np.random.default_rng(3).standard_normal((n, 48))
    many = table.sum(axis=0) + table.sum(axis=1)
    return np.concatenate([table @ signs, table.T @ signs, many[:, None]], axis=1)


def id_groups(counts: np.ndarray, sums: np.ndarray) -> dict[str, np.ndarray]:
    """Where the model finds each id: its group, its slot there, and the log of its share of the slot.

    The most frequent ids have a slot of their own. Groups of equal size bring together ids that stand
    before and after the same ids: the set is halved again and again along its main axis. ``sums`` are the
    ``neighbours`` in all training texts. All other ids share the last slots, dealt by falling frequency
    into slots of about equal mass.
    """
    own = GROUPS * (SLOTS - 1)
    order, _ = _places(counts)
    head, tail = order[:own], order[own:]
    table = (sums[:, :-1] / np.sqrt(1.0 + sums[:, -1:])).astype(np.float32)
    parts = [np.arange(own)]
    while len(parts) < GROUPS:
        halves = []
        for part in parts:
            x = table[part] - table[part].mean(axis=0)
            axis = x @ np.linalg.eigh(x.T @ x)[1][:, -1]
            by = part[np.lexsort((part, axis))]
            halves += [by[: len(by) // 2], by[len(by) // 2 :]]
        parts = halves
    group, slot = np.empty(len(counts), np.int64), np.full(len(counts), SLOTS - 1)
    for k, part in enumerate(parts):
        group[head[part]], slot[head[part]] = k, np.arange(SLOTS - 1)
    mass = np.cumsum(counts[tail] + 0.1)
    group[tail] = np.minimum((mass / mass[-1] * GROUPS).astype(np.int64), GROUPS - 1)
    mass = counts + 0.1
    total = np.bincount(group * SLOTS + slot, mass, GROUPS * SLOTS)
    share = np.log(mass / total[group * SLOTS + slot]).astype(np.float32)
    return {"group": group, "slot": slot, "share": share}


def _initial() -> dict[str, np.ndarray]:
    rng = np.random.default_rng(11)
    d = WIDTH
    put = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
    return {
        "e": put(IDS, d, scale=0.3), "q": put(d, d, scale=d**-0.5), "k": put(d, d, scale=d**-0.5),
        "v": put(d, d, scale=d**-0.5), "o": put(d, d, scale=d**-0.5), "at": put(BLOCK, 2 * BLOCK, scale=0.1),
        "u": put(d, 2 * d, scale=d**-0.5), "ub": np.zeros(2 * d, np.float32), "w": put(2 * d, d, scale=0.1),
        "c": put(d, GROUPS, scale=0.1), "cb": np.zeros(GROUPS, np.float32),
        "m": put(GROUPS, d, SLOTS, scale=0.1), "mb": np.zeros((GROUPS, SLOTS), np.float32),
    }


def layout(lengths: np.ndarray) -> tuple[np.ndarray, int]:
    """First positions of texts that begin at block bounds, and positions in all."""
    padded = -(-lengths // BLOCK) * BLOCK
    return np.cumsum(padded) - padded, int(padded.sum())


# Keys that a query of a block may not see: those after it.
_AHEAD = np.where(np.arange(2 * BLOCK)[None, :] > np.arange(BLOCK)[:, None] + BLOCK, -1e9, 0).astype(np.float32)
_MOST = 60.0  # bounds exponents, in place of taking off the largest


def _windows(a: np.ndarray, by: np.ndarray) -> np.ndarray:
    """Of the product, for each block of positions, its rows and those of the block before (zeros for the first)."""
    padded = np.empty((len(a) + BLOCK, by.shape[1]), a.dtype)
    padded[:BLOCK] = 0
    np.matmul(a, by, out=padded[BLOCK:])
    row, item = padded.strides
    return np.lib.stride_tricks.as_strided(
        padded, (len(a) // BLOCK, 2 * BLOCK, by.shape[1]), (BLOCK * row, row, item), writeable=False
    )


def _forward(p: dict, x: np.ndarray, first: np.ndarray) -> dict:
    """Activations for positions ``x`` (ids); ``first`` tells which blocks begin a text."""
    n, d = len(x), WIDTH
    h = p["e"].take(x, axis=0)
    q = (h @ (p["q"] * d**-0.5).astype(h.dtype)).reshape(-1, BLOCK, d)
    kb, vb = _windows(h, p["k"]), _windows(h, p["v"])
    s = q @ kb.transpose(0, 2, 1)
    s += p["at"] + _AHEAD
    s[first, :, :BLOCK] = -1e9
    np.minimum(s, _MOST, out=s)
    a = np.exp(s, out=s)
    weight = _row_sums(a)[:, :, None]
    o = a @ vb
    o /= weight
    o = o.reshape(n, d)
    g = o @ p["o"]
    g += h
    f = g @ p["u"]
    f += p["ub"]
    np.maximum(f, 0, out=f)
    z = f @ p["w"]
    z += g
    y = np.empty((n + 1, GROUPS), h.dtype)
    np.matmul(z, p["c"], out=y[:n])
    y[n] = np.maximum(p["cb"], -_MOST)  # their exponentials weigh the others
    _bounded(y, _longest(z) * _longest(p["c"].T) + p["cb"].max())
    return {"h": h, "q": q, "kb": kb, "vb": vb, "a": a, "weight": weight, "o": o, "g": g, "f": f, "z": z, "y": y}


def _longest(a: np.ndarray) -> float:
    """The greatest length of a row: products of rows are at most that of their lengths."""
    return float(np.einsum("...i,...i->...", a, a).max(initial=0)) ** 0.5


def _bounded(a: np.ndarray, most: float) -> np.ndarray:
    """``a`` with no exponent over _MOST; ``most`` is a bound known beforehand."""
    return a if most < _MOST else np.minimum(a, _MOST, out=a)


def _by_group(group: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """Positions in the order of their groups, and where each group that has some begins and ends there."""
    order = np.argsort(group.astype(np.uint8), kind="stable")
    ends = np.cumsum(np.bincount(group, minlength=GROUPS)).tolist()
    return order, [(k, a, b) for k, (a, b) in enumerate(zip([0, *ends[:-1]], ends)) if a < b]


def _row_sums(a: np.ndarray) -> np.ndarray:
    return a @ np.ones(a.shape[-1], a.dtype)


def _slot_logits(p: dict, z: np.ndarray, group: np.ndarray, parts: list[tuple[int, int, int]]) -> np.ndarray:
    """Logits of the slots for positions in the order of their groups."""
    l = np.empty((len(z), SLOTS), z.dtype)
    for k, a, b in parts:
        np.matmul(z[a:b], p["m"][k], out=l[a:b])
    l += p["mb"].take(group, axis=0)
    return _bounded(l, _longest(z) * _longest(p["m"].transpose(0, 2, 1)) + p["mb"].max())


def slot_log_probs(p: dict, x: np.ndarray, first: np.ndarray, group: np.ndarray, slot: np.ndarray) -> np.ndarray:
    """Log probabilities of the groups of the targets and of their slots in these."""
    t = _forward(p, x, first)
    y, n = t["y"], np.arange(len(x))
    out = y[n, group] + y[-1][group]
    order, parts = _by_group(group)
    l = _slot_logits(p, t["z"].take(order, axis=0), group[order], parts)
    own = l[n, slot[order]] - np.log(_row_sums(np.exp(l, out=l)))
    np.exp(y, out=y)
    out -= np.log(y[:-1] @ y[-1])
    out[order] += own
    return out


def _of_keys(windows: np.ndarray) -> np.ndarray:
    """Sums for each key, which stands in the window of its own block and in that of the next."""
    own = windows[:, BLOCK:]
    own[:-1] += windows[1:, :BLOCK]
    return own.reshape(-1, WIDTH)


def _gradients(p: dict, x: np.ndarray, first: np.ndarray, group: np.ndarray, slot: np.ndarray, real: np.ndarray) -> dict:
    """Gradients of the mean loss over the ``real`` positions; that of "e" is by position.

    Shares of groups and slots stay exponentials: what divides them goes to the narrow sides of the products.
    """
    t = _forward(p, x, first)
    n, d = len(x), WIDTH
    a, at = t["a"], np.arange(n)
    a /= t["weight"]
    np.exp(t["y"], out=t["y"])
    dy, bias = t["y"][:-1], t["y"][-1]
    part = (real / max(1, int(real.sum()))).astype(dy.dtype)
    total = dy @ bias
    dy[at, group] -= total / bias[group]
    total = part / total
    g = {"c": ((t["z"] * total[:, None]).T @ dy) * bias, "cb": (total @ dy) * bias, "m": np.zeros_like(p["m"]), "mb": np.zeros_like(p["mb"])}
    dz = dy @ (p["c"] * bias).T
    dz *= total[:, None]
    order, parts = _by_group(group)
    z = t["z"].take(order, axis=0)
    dl = _slot_logits(p, z, group[order], parts)
    np.exp(dl, out=dl)
    total = _row_sums(dl)
    dl[at, slot[order]] -= total
    total = part[order] / total
    z *= total[:, None]
    back = np.empty_like(z)
    for k, low, high in parts:
        some = dl[low:high]
        np.matmul(z[low:high].T, some, out=g["m"][k])
        np.matmul(total[low:high], some, out=g["mb"][k])
        np.matmul(some, p["m"][k].T, out=back[low:high])
    back *= total[:, None]
    z[order] = back
    dz += z
    df = dz @ p["w"].T
    df *= (t["f"] > 0).astype(df.dtype)
    g["w"], g["u"], g["ub"] = t["f"].T @ dz, t["g"].T @ df, _row_sums(df.T)
    dg = df @ p["u"].T
    dg += dz
    g["o"] = t["o"].T @ dg
    do = (dg @ p["o"].T).reshape(-1, BLOCK, d)
    ds = do @ t["vb"].transpose(0, 2, 1)
    ds -= np.einsum("ijk,ijk->ij", ds, a)[:, :, None]
    ds *= a
    g["at"] = ds.sum(axis=0)
    dq = (ds @ t["kb"]).reshape(n, d)
    dk = _of_keys(ds.transpose(0, 2, 1) @ t["q"])
    dv = _of_keys(a.transpose(0, 2, 1) @ do)
    scale = np.asarray(d**-0.5, dy.dtype)
    g["q"], g["k"], g["v"] = t["h"].T @ dq * scale, t["h"].T @ dk, t["h"].T @ dv
    dg += dq @ (p["q"] * scale).T
    dg += dk @ p["k"].T
    dg += dv @ p["v"].T
    g["e"] = dg
    return g


class Learner:
    """Weights that learn by Adam. All but those of the ids lie in one array, of which ``p`` shows the parts."""

    def __init__(self, p: dict, where: dict):
        self.names = [k for k in p if k != "e"]
        flat, at = np.concatenate([p[k].ravel() for k in self.names]), 0
        self.p = {"e": p["e"].copy()}
        for k in self.names:
            self.p[k], at = flat[at : at + p[k].size].reshape(p[k].shape), at + p[k].size
        self.where = where
        self.weights = [self.p["e"], flat]
        self.m = [np.zeros_like(v) for v in self.weights]
        self.s = [np.zeros_like(v) for v in self.weights]
        self.met = np.zeros(IDS)  # how often each id was an input
        self.step = 0

    def learn(self, docs: list, rate: float) -> None:
        """One step on some texts of ids."""
        x, first, target, places = inputs(docs)
        real = np.zeros(len(x), bool)
        real[places] = True
        group, slot = self.where["group"].take(target), self.where["slot"].take(target)
        g = _gradients(self.p, x, first, group, slot, real)
        self.step += 1
        lr = rate * min(1.0, self.step / 30)
        fix = (1 - 0.99**self.step) ** 0.5 / (1 - 0.9**self.step)
        by = np.argsort(x.astype(np.uint16), kind="stable")
        sorted_x = x[by]
        begins = np.flatnonzero(np.append(True, sorted_x[1:] != sorted_x[:-1]))
        own = sorted_x[begins]
        self.met[own] += np.add.reduceat(real[by].astype(np.float64), begins)
        grads = [np.add.reduceat(g["e"].take(by, axis=0), begins), np.concatenate([g[k].ravel() for k in self.names])]
        for p, m, s, at, grad in zip(self.weights, self.m, self.s, (own, slice(None)), grads):
            mean = m[at] = 0.9 * m[at] + 0.1 * grad
            square = s[at] = 0.99 * s[at] + 0.01 * grad * grad
            p[at] -= lr * fix * mean / (np.sqrt(square) + 1e-8)


def train(docs: list[list[int]], counts: np.ndarray, epochs: int = 2, rate: float = 0.01, where: dict | None = None) -> dict:
    """A model of texts of ids (each with its end id; their first LEARNED_IDS); ``counts`` are those of
    all training ids, ``where`` their groups (formed from these texts if not given)."""
    docs = [d[:LEARNED_IDS] for d in docs]
    if where is None:
        flat = np.array([i for d in docs for i in d] or [END_ID], np.int64)
        where = id_groups(counts, neighbours(_pairs(_places(counts)[1], flat)))
    learner = Learner(_initial(), where)
    rng = np.random.default_rng(5)
    total = epochs * max(1, sum(map(len, docs)) // STEP_IDS)
    for _ in range(epochs):
        group: list[list[int]] = []
        for k in [*rng.permutation(len(docs)).tolist(), None]:
            if k is not None:
                group.append(docs[k])
            if not group or (k is not None and sum(map(len, group)) < STEP_IDS):
                continue
            learner.learn(group, rate * max(0.05, 1 - (learner.step + 1) / (total + 1)))
            group = []
    return {"p": learner.p, **where}


def _rows(p: dict) -> np.ndarray:
    """All weights in rows of WIDTH, those of the ids first."""
    return np.concatenate([p[k].reshape(-1, WIDTH) for k in p])


def _from_rows(rows: np.ndarray, like: dict) -> dict:
    out, at = {}, 0
    for k, v in like.items():
        n = v.size // WIDTH
        out[k], at = rows[at : at + n].reshape(v.shape).astype(np.float32), at + n
    return out


def inputs(docs: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Positions for texts of ids, each beginning with a block: input ids (the end id first, then all
    but the last), which blocks begin a text, target ids, and where the real positions are."""
    lengths = np.array([len(i) for i in docs], np.int64)
    flat = np.concatenate([np.asarray(i, np.int64) for i in docs]) if docs else np.zeros(0, np.int64)
    return _laid(flat, lengths)


def _laid(flat: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    begin, n = layout(lengths)
    places = np.repeat(begin - (np.cumsum(lengths) - lengths), lengths) + np.arange(len(flat))
    x, target = np.full(n + 1, END_ID), np.full(n, END_ID)
    target[places] = flat
    x[places + 1] = flat
    x[begin] = END_ID
    first = np.zeros(n // BLOCK, bool)
    first[begin // BLOCK] = True
    return x[:n], first, target, places


def id_log_probs(model: dict, flat: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Natural log probabilities of all ids of texts laid end to end (each has one at least)."""
    x, first, target, places = _laid(flat, lengths)
    group, slot = model["group"][target], model["slot"][target]
    got = np.empty(len(x), np.float32)
    for low in range(0, len(x), _BATCH):  # with the block before, which a text may go on from
        begin = max(0, low - BLOCK)
        some = slice(begin, low + _BATCH)
        blocks = first[begin // BLOCK : (low + _BATCH) // BLOCK]
        got[low : low + _BATCH] = slot_log_probs(model["p"], x[some], blocks, group[some], slot[some])[low - begin :]
    return got[places] + model["share"][flat]


def seen_before(words: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How often each word stood earlier in its text, and how many words stood there."""
    n = len(words)
    text = np.repeat(np.arange(len(lengths)), lengths)
    keys = np.sort(words.astype(np.int64) * n + np.arange(n))  # by word, then place, so that its texts are in order
    by_word, order = np.divmod(keys, max(n, 1))
    new = np.append(True, (np.diff(text[order]) != 0) | (np.diff(by_word) != 0))[:n]
    begin = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    before = np.empty(n, np.int64)
    before[order] = np.arange(n) - begin
    return before, np.arange(n) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def mixture(by_word, counts, n: int, once: int, before, place) -> np.ndarray:
    """Natural log of the mixture of the model, the training shares and the words of the text so far.

    The text's own words gain weight as it goes on. Of the rest, the model has a half and the share of
    training tokens that occurred once, which is how often a new word is to be expected.
    """
    own = OWN * place / (place + OWN_PLACES)
    model = min(0.9, 0.5 + once / n) if n else 1.0
    told = own * before / np.maximum(place, 1) + (1 - own) * (1 - model) * counts / max(n, 1)
    with np.errstate(divide="ignore"):
        return np.logaddexp(np.log((1 - own) * model) + by_word, np.log(told))


# --- the corpus ------------------------------------------------------------------------------


def _questions(buckets: int):
    coder: list[WordIds] = []

    def chunk(batch: pa.RecordBatch):
        if not coder:
            coder.append(WordIds())
        ids, held = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        data, offsets = text_bytes(batch.column(2))
        for low, high in spans(offsets, exchange.CHUNK_BYTES):
            for i in range(low, high, exchange.CHUNK_DOCS):
                j = min(i + exchange.CHUNK_DOCS, high)
                words, flat, lengths = numbered_words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                learned = np.repeat(~np.array(held[i:j], bool), lengths)
                counts = np.bincount(flat[learned], minlength=len(words))
                sizes = np.cumsum([0, *map(len, words)])
                hashes = word_hashes(np.frombuffer(b"".join(words), np.uint8), sizes[:-1], sizes[1:])
                asks = [(b, exchange.pack(at.astype(np.uint32), hashes[at], counts[at])) for b, at in exchange.by_bucket(hashes, buckets)]
                piece_sizes, piece_ids = coder[0].flat(words[:-1])
                piece_sizes, piece_ids = np.append(piece_sizes, 1), np.append(piece_ids, np.uint16(END_ID))
                of_ids = np.bincount(piece_ids, np.repeat(counts, piece_sizes), IDS)
                used = np.flatnonzero(of_ids)
                notes = (ids[i:j], held[i:j], lengths, flat.astype(np.uint32), piece_sizes.astype(np.uint8 if piece_sizes.max() < 256 else np.uint32), piece_ids)
                seen = (used.astype(np.uint16), of_ids[used])
                plain = pickle.dumps(notes, 5)
                yield asks, exchange.pack(pa.compress(plain, "zstd", asbytes=True), len(plain), seen)

    return chunk


def _count_words(asked: list[tuple]) -> tuple[list[bytes | None], list[int]]:
    """For each chunk, the training count of its words; in all, training tokens, distinct ones, and those that occur once."""
    if not asked:
        return [], []
    distinct, inverse = np.unique(np.concatenate([a[1] for a in asked]), return_inverse=True)
    total = np.zeros(len(distinct), np.int64)
    np.add.at(total, inverse, np.concatenate([a[2] for a in asked]))
    out, at = [], 0
    for own, hashes, _ in asked:
        out.append(exchange.pack(own, total[inverse[at : at + len(own)]]))
        at += len(own)
    return out, [int(total.sum()), int((total > 0).sum()), int((total == 1).sum())]


@contextmanager
def _few_notes(spark: SparkSession) -> Iterator[None]:
    """Batches of few notes for the jobs run inside: a row of notes is as large as a chunk."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(_NOTE_BYTES))
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def _kept_memory() -> Iterator[None]:
    """Memory that is freed stays with the worker inside, where each step would fetch it again from the system."""
    most, set_option = os.environ.get("MALLOC_TRIM_THRESHOLD_"), getattr(ctypes.CDLL(None), "mallopt", None)
    if not most or not set_option:  # nothing is given back early
        yield
        return
    trim_threshold = -1  # M_TRIM_THRESHOLD
    set_option(trim_threshold, max(int(most), _KEPT_BYTES))
    try:
        yield
    finally:
        set_option(trim_threshold, int(most))


def _payloads(batch: pa.RecordBatch) -> Iterator[bytes]:
    """The notes of a batch, one at a time: no list holds them all."""
    return (payload.as_py() for payload in batch.column(0))


def _id_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(IDS)
    for batch in batches:
        for payload in _payloads(batch):
            used, counts = pickle.loads(payload)[2]
            total[used] += counts
    some = np.flatnonzero(total)
    yield pa.record_batch({"id": pa.array(some, pa.int64()), "n": pa.array(total[some].astype(np.int64))})


def _ids_of(notes: tuple) -> tuple[list, list, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a chunk: doc ids, held, words in each text, all words as numbers, ids in each of them, ids in each text, all ids in order."""
    ids, held, lengths, flat, piece_sizes, piece_ids = pickle.loads(pa.decompress(notes[0], notes[1], "zstd"))
    sizes = piece_sizes.astype(np.int64)
    starts = np.cumsum(sizes) - sizes
    many = sizes[flat]
    at = np.repeat(starts[flat] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
    begins = np.cumsum(lengths) - lengths
    in_text = np.add.reduceat(many, begins) if len(begins) else many[:0]
    return ids, held, lengths, flat, many, in_text, piece_ids[at].astype(np.int64)


def _training_windows(payload: bytes) -> list[np.ndarray]:
    """The ids of a chunk's training texts, long ones cut into windows."""
    _, held, _, _, _, in_text, flat = _ids_of(pickle.loads(payload))
    ends = np.cumsum(in_text)
    out = []
    for h, a, b in zip(held, (ends - in_text).tolist(), ends.tolist()):
        if not h:
            out += [flat[k : min(k + LEARNED_IDS, b)] for k in range(a, b, LEARNED_IDS)]
    return out


def _sum_rows(index: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
    """A task's share in a sum of rows, in parts."""
    task = TaskContext.get().partitionId()
    parts = [index % _PARTS == k for k in range(_PARTS)]
    payloads = [exchange.pack(index[some] // _PARTS, values[some]) for some in parts]
    return pa.record_batch(
        {"part": pa.array(range(_PARTS), pa.int32()), "task": pa.array([task] * _PARTS, pa.int64()), "payload": pa.array(payloads, pa.binary())}
    )


def _summed(found: DataFrame, n: int, width: int) -> np.ndarray:
    """The sum over all tasks (n rows), always in the same order; n is fixed by the parameters above."""

    def add(table: pa.Table) -> pa.Table:
        shares = sorted(zip(table["task"].to_pylist(), table["payload"].to_pylist()))
        total = np.zeros((-(-n // _PARTS), width))
        for _, payload in shares:
            index, values = pickle.loads(payload)
            total[index] += values
        return pa.table({"part": table["part"].slice(0, 1), "payload": pa.array([total.tobytes()], pa.binary())})

    out = np.zeros((n, width))
    for r in found.groupBy("part").applyInArrow(lambda t: add(t), "part int, payload binary").collect():
        total = np.frombuffer(r["payload"]).reshape(-1, width)
        out[r["part"] :: _PARTS] = total[: len(range(r["part"], n, _PARTS))]
    return out


_SUMS = "part int, task bigint, payload binary"


def _neighbour_batches(place: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for payload in _payloads(batch):
                windows = _training_windows(payload)
                if windows:
                    pairs = _pairs(place, np.concatenate(windows))
                    total = pairs.astype(np.float64) if total is None else np.add(total, pairs, out=total)
                    del pairs
        if total is not None:
            sums = neighbours(total)
            yield _sum_rows(np.arange(len(sums)), sums)

    return run


def _round_batches(model, rate: float):
    """Goes on from the model with the texts of a task; tells, for each row of weights that it met, how
    often, and the change times that."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = model.value["p"]
        learner = Learner(p, model.value)
        group, size = [], 0
        rng = np.random.default_rng(7)
        with _kept_memory():
            for batch in batches:
                for payload in _payloads(batch):
                    windows = _training_windows(payload)
                    for k in rng.permutation(len(windows)).tolist():
                        group.append(windows[k])
                        size += len(windows[k])
                        if size >= STEP_IDS:
                            learner.learn(group, rate)
                            group, size = [], 0
            if group:
                learner.learn(group, rate)
        if learner.step:
            change = _rows(learner.p).astype(np.float64) - _rows(p)
            met = np.full(len(change), learner.met.sum())
            met[:IDS] = learner.met
            some = np.flatnonzero(met)
            yield _sum_rows(some, np.concatenate([change * met[:, None], met[:, None]], axis=1)[some])

    return run


def learn_corpus(notes: DataFrame, model: dict) -> dict:
    """The model after all training texts, in ROUNDS parts of the chunks."""
    spark = notes.sparkSession
    for k in range(ROUNDS):
        part = notes.filter(F.pmod(F.xxhash64("chunk"), F.lit(ROUNDS)) == k).select("payload").coalesce(_SHARDS)
        sent = spark.sparkContext.broadcast(model)
        rows = _rows(model["p"])
        found = part.mapInArrow(_round_batches(sent, ROUND_RATE / 2**k), _SUMS)
        with _few_notes(spark):
            sums = _summed(found, len(rows), WIDTH + 1)
        rows = rows + sums[:, :-1] / np.maximum(sums[:, -1:], 1)
        model = model | {"p": _from_rows(rows, model["p"])}
        sent.unpersist()
    return model


def _scores(model: dict, n: int, v: int, once: int):
    def finish(notes: tuple, answers: list[tuple]) -> pa.Table:
        ids, held, lengths, flat, many, in_text, pieces = _ids_of(notes)
        counts = np.zeros(int(flat.max(initial=0)) + 1, np.int64)
        for own, some in answers:
            counts[own] = some
        ends = np.cumsum(lengths)
        begins = ends - lengths
        sums = lambda x: np.add.reduceat(x, begins) if len(begins) else x[:0]
        c = counts[flat]
        base = sums(np.log10((counts + 0.1) / (n + 0.1 * (v + 1)))[flat])
        with _kept_memory():
            got = id_log_probs(model, pieces, in_text)
        by_word = np.add.reduceat(got.astype(np.float64), np.cumsum(many) - many) if len(many) else got
        score = sums(mixture(by_word, c, n, once, *seen_before(flat, lengths)) / np.log(10))
        return pa.table(
            {
                "doc_id": pa.array(ids, pa.int64()),
                "held_out": pa.array(held, pa.bool_()),
                "n_tokens": pa.array(lengths),
                "n_known": pa.array(sums((c > 0).astype(np.int64))),
                "train_tokens": pa.array(np.full(len(ids), n), pa.int64()),
                "base_score": pa.array(base, pa.float64()),
                "score": pa.array(score, pa.float64()),
            }
        )

    return finish


def _fit(counts: np.ndarray, where: dict):
    def run(table: pa.Table) -> pa.Table:
        coder = WordIds()
        texts = sorted(texts_of(table["text"]))
        docs = [[i for ids in coder(text_words(raw)) for i in ids] for raw in texts]
        with _kept_memory():
            model = train(docs, counts, where=where)
        return pa.table({"model": pa.array([pickle.dumps(model)], pa.binary())})

    return run


def score_texts(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document.

    Tokens are words and one end each; null and empty texts are the end alone. Held-out documents
    (crc32 of the id modulo FOLDS is 0; never for null ids) are scored and not learned from. Rows that
    repeat count as often and get equal scores; no rows give no rows. Only doc_id and text are read.
    """
    spark = docs.sparkSession
    _, size = text_size(docs)
    buckets = exchange.buckets_for(size)
    rows = docs.select(
        F.col("doc_id").cast("bigint"), held_out("doc_id", FOLDS).alias("held"), F.col("text").cast("string")
    )
    asked = exchange.ask(rows, _questions(buckets), buckets)
    answered = materialize(exchange.answer(asked, _count_words), "word-counts")
    totals = exchange.totals_of(answered)
    notes = answered.filter(F.col("kind") == exchange.NOTE).select("chunk", "payload")
    found = notes.select("payload").mapInArrow(_id_batches, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    id_counts = np.zeros(IDS)
    with _few_notes(spark):
        for r in found.collect():  # at most IDS rows
            id_counts[r["id"]] = r["n"]
    drawn = docs.select("doc_id").filter(crc_fold("doc_id", FOLDS) != 0).distinct()
    drawn = drawn.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS)
    sample = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id").select("text", F.lit(1).alias("all"))
    told = notes.select("payload").coalesce(_SHARDS).mapInArrow(_neighbour_batches(_places(id_counts)[1]), _SUMS)
    with _few_notes(spark):
        where = id_groups(id_counts, _summed(told, GROUPS * (SLOTS - 1) + 1, 97))
    run = _fit(id_counts, where)
    trained = sample.groupBy("all").applyInArrow(lambda t: run(t), "model binary").first()
    learned = pickle.loads(trained["model"]) if trained else train([], id_counts, where=where)
    learned = learn_corpus(notes, learned)
    model = spark.sparkContext.broadcast(learned)  # its size is fixed by the parameters above

    def finish(own: tuple, answers: list[tuple]) -> pa.Table:
        return _scores(model.value, *(totals.get(k, 0) for k in (0, 1, 2)))(own, answers)

    return exchange.receive(
        answered,
        finish,
        "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
        "base_score double, score double",
    )
