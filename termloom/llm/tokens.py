"""Exact token ids of whole texts through a cache of the pieces between white space.

The tokenizer drops white space and never joins characters across it, so a text's ids
are those of its pieces in order. A piece of ASCII and common accented letters falls into
words and signs as the tokenizer's own pattern says; other pieces go to the tokenizer whole.
New words are encoded many at a time with spaces between them: the last token of a word, and
only that, is marked as a word end in the vocabulary, which tells the words apart again. Words
of letters are lower-cased and split already, so they go to the tokenizer's merges without its
normalizer and pattern.
Pieces and words are encoded once per worker; a cache is emptied at CACHE entries, which
bounds its memory.
"""

from __future__ import annotations

import re

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer, pre_tokenizers

VOCABULARY = "word_bpe_49k.json"
CACHE = 400_000  # pieces, and twice as many words
_WORD_END = "</w>"

# Characters for which lower-casing and splitting here is what the tokenizer does.
_PLAIN = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
_LETTERS = "a-z\u00df-\u00f6\u00f8-\u00ff"
_PLAIN_TEXT = re.compile("[\t-\r -~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]*")
_SPLIT_TEXT = re.compile(f"[{_LETTERS}]+|'(?:[stmd]|re|ve|ll)|[0-9]|[^\t-\r 0-9{_LETTERS}]+")
_SPLIT = re.compile(f"[{_LETTERS}]+|'(?:[stmd]|re|ve|ll)|[0-9]|[^0-9{_LETTERS}]+")

# What the tokenizer's byte alphabet makes of the accented letters.
_ALPHABET = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
_BYTE_LETTERS = {k: _ALPHABET.pre_tokenize_str(chr(k))[0][0] for k in range(0xDF, 0x100) if k != 0xF7}


class PieceEncoder:
    """ids(pieces): little-endian unsigned 32-bit ids as bytes, for pieces of UTF-8."""

    def __init__(self, path: str | None = None):
        self.tokenizer = Tokenizer.from_file(path or public_tokenizers.path(VOCABULARY))
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(_WORD_END)]] = True
        self.merges = Tokenizer(self.tokenizer.model)
        self.merges.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.known: dict[bytes, bytes] = {}
        self.words: dict[str, bytes] = {}

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        coded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4") for e in coded]

    def _merge(self, letters: list[str]) -> np.ndarray:
        """The ids of words of lower-case letters, one after the other."""
        text = " ".join(letters)
        text = text if text.isascii() else text.translate(_BYTE_LETTERS)
        return np.array(self.merges.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _learn_words(self, new: list[str]) -> None:
        """Encode words and runs of signs; letters by the thousand, others one by one."""
        letters = sorted((w for w in new if w.isalpha()), key=str.isascii)
        for at in range(0, len(letters), 1000):
            some = letters[at : at + 1000]
            ids = self._merge(some)
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) != len(some):  # not told apart by word ends
                self.words.update((w, x.tobytes()) for w, x in zip(some, self._encode(some)))
                continue
            raw, cuts = ids.tobytes(), (4 * ends).tolist()
            self.words.update((w, raw[a:b]) for w, a, b in zip(some, [0, *cuts[:-1]], cuts))
        others = [w for w in new if not w.isalpha()]
        self.words.update((w, x.tobytes()) for w, x in zip(others, self._encode(others)))

    def learn(self, new: set[bytes]) -> None:
        """Encode pieces that the cache lacks."""
        plain: list[tuple[bytes, list[str]]] = []
        whole: list[bytes] = []
        for piece in new:
            text = piece.decode()
            if _PLAIN.fullmatch(text) and "<|" not in text:
                plain.append((piece, _SPLIT.findall(text.lower())))
            else:
                whole.append(piece)
        words = {w for _, found in plain for w in found}
        if len(self.words) + len(words) > 2 * CACHE:
            self.words = {}
        self._learn_words(list(words.difference(self.words)))
        known = self.words
        self.known.update((piece, b"".join([known[w] for w in found])) for piece, found in plain)
        for at in range(0, len(whole), 10_000):
            some = whole[at : at + 10_000]
            self.known.update((p, x.tobytes()) for p, x in zip(some, self._encode([p.decode() for p in some])))

    def ids(self, parts: list[bytes]) -> list[bytes]:
        """The ids of each part."""
        found = list(map(self.known.get, parts))
        if None in found:
            new = {p for p, x in zip(parts, found) if x is None}
            if len(self.known) + len(new) > CACHE:
                self.known, new = {}, set(parts)
            self.learn(new)
            found = list(map(self.known.__getitem__, parts))
        return found

    def text_ids(self, texts: list[bytes]) -> list[bytes]:
        """The ids of whole texts. Plain ones are split into words at once, others into pieces."""
        split: list[list] = []
        for raw in texts:
            text = raw.decode()
            plain = _PLAIN_TEXT.fullmatch(text) and "<|" not in text
            split.append(_SPLIT_TEXT.findall(text.lower()) if plain else raw.split())
        is_plain = [bool(s) and isinstance(s[0], str) for s in split]
        flat = [w for s, p in zip(split, is_plain) if p for w in s]
        words = list(map(self.words.get, flat))
        if None in words:
            lacking = [i for i, x in enumerate(words) if x is None]
            new = {flat[i] for i in lacking}
            if len(self.words) + len(new) > 2 * CACHE:
                self.words = {}
            self._learn_words(list(new))
            for i in lacking:
                words[i] = self.words[flat[i]]
        out, at = [], 0
        for found, plain in zip(split, is_plain):
            if plain:
                out.append(b"".join(words[at : at + len(found)]))
                at += len(found)
            else:
                out.append(b"".join(self.ids(found)))
        return out

    def count(self, text: bytes) -> int:
        """Tokens of a short text, past the cache."""
        found = self.tokenizer.encode(text.decode(errors="replace"), add_special_tokens=False)
        return len(found.ids)
