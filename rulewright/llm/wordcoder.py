"""Batch encoding with a public tokenizer file, one library call per new word.

A byte-pair tokenizer splits a text into words by a pattern and encodes each
word alone.  `WordCoder` finds the words of a whole batch with array
operations, keeps the ids of every word it has met in a bounded table and asks
the ``tokenizers`` model only for words that are not there yet.  Texts that the
array form can't split exactly (apostrophes, scripts outside its table) go
through the library as they are, so the ids are always the library's own.
"""

from __future__ import annotations

import json
import os
import unicodedata

import numpy as np

#: Words kept before the table starts afresh; bounds a worker's memory.
MAX_WORDS = 1 << 20
#: Characters handled at once.
BATCH_CHARS = 1 << 20
#: Longer words are never hashed.
LONG_WORD = 256

_SPACE, _LETTER, _NUMBER, _OTHER, _END = range(5)
_SEPARATOR = 0xFFFF
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_UNBASE = pow(_BASE, -1, 1 << 64)
_MIX = np.uint64(0xD6E8FEB86659FD93)

_coders: dict[str, "WordCoder"] = {}


def coder(path: str) -> "WordCoder":
    """The process's coder for a tokenizer file; workers are reused by Spark, and so are their words."""
    if path not in _coders:
        _coders[path] = WordCoder(path)
    return _coders[path]


def chunks(texts: list[str], most: int = BATCH_CHARS):
    """(first, end) index ranges of about `most` characters; a longer text stands alone."""
    first, size = 0, 0
    for k, text in enumerate(texts):
        if k > first and size + len(text) > most:
            yield first, k
            first, size = k, 0
        size += len(text)
    if first < len(texts):
        yield first, len(texts)


def _class_table(limit: int) -> np.ndarray:
    table = np.full(1 << 16, _OTHER, np.uint8)
    for code in range(limit):
        kind = unicodedata.category(chr(code))[0]
        table[code] = _LETTER if kind == "L" else _NUMBER if kind == "N" else _OTHER
    table[[*range(9, 14), 32, 0x85, 0xA0]] = _SPACE
    table[_SEPARATOR] = _END
    return table


class WordCoder:
    """Encodes texts as ``Tokenizer.encode(text, add_special_tokens=False).ids`` does.

    Empty texts have no ids; nulls are the caller's to replace.  Strings of
    special tokens count as ordinary text.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("RAYON_NUM_THREADS", "1")
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            conf = json.load(file)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        #: Whether all ids fit into 16 bits.
        self.small = self.tokenizer.get_vocab_size() <= 1 << 16
        pre, norm = conf.get("pre_tokenizer") or {}, conf.get("normalizer")
        #: Words with their leading space, or words without any space in lower case, or neither.
        self.kind = "none"
        if norm is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space"):
            self.kind, self.limit = "spaced", 0x530
        elif norm and [x["type"] for x in norm.get("normalizers", [])] == ["NFC", "Replace", "Lowercase"] and pre.get("type") == "Sequence":
            self.kind, self.limit = "bare", 0x130
        if self.kind != "none":
            self.classes = _class_table(self.limit)
            self.folded = np.arange(1 << 16, dtype=np.uint32)
            if self.kind == "bare":
                self.folded[: self.limit] = [ord(chr(c).lower()) for c in range(self.limit)]
            printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
            rest = [b for b in range(256) if b not in printable]
            self.visible = {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(rest)}
        self.powers = self.unpowers = np.ones(1, np.uint64)
        self._forget()

    def _forget(self) -> None:
        self.slots = np.zeros(1 << 16, np.uint64)
        self.slot_word = np.zeros(1 << 16, np.int32)
        self.words, self.used = 0, 0
        self.at, self.length = np.zeros(1 << 15, np.int64), np.zeros(1 << 15, np.int32)
        self.ids = np.zeros(1 << 17, np.uint32)

    # -- the table of words -------------------------------------------------

    def _slot(self, hashes: np.ndarray) -> np.ndarray:
        return ((hashes * _MIX) >> np.uint64(64 - int(self.slots.size).bit_length() + 1)).astype(np.int64)

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """Word numbers, or -1."""
        mask, slot = self.slots.size - 1, self._slot(hashes)
        held = self.slots[slot]
        found = np.where(held == hashes, self.slot_word[slot], -1)
        open_ = np.flatnonzero((held != hashes) & (held != 0))
        slot = slot[open_]
        while open_.size:
            slot = (slot + 1) & mask
            held, want = self.slots[slot], hashes[open_]
            hit = held == want
            found[open_[hit]] = self.slot_word[slot[hit]]
            go = ~hit & (held != 0)
            open_, slot = open_[go], slot[go]
        return found

    def _place(self, hashes: np.ndarray, numbers: np.ndarray) -> None:
        mask, slot = self.slots.size - 1, self._slot(hashes)
        while hashes.size:
            free = np.flatnonzero(self.slots[slot] == 0)
            _, first = np.unique(slot[free], return_index=True)
            put = free[first]
            self.slots[slot[put]], self.slot_word[slot[put]] = hashes[put], numbers[put]
            left = np.ones(hashes.size, bool)
            left[put] = False
            hashes, numbers, slot = hashes[left], numbers[left], (slot[left] + 1) & mask

    def _add(self, hashes: np.ndarray, coded: list[list[int]]) -> None:
        n, flat = len(coded), np.fromiter((i for ids in coded for i in ids), np.uint32)
        sizes = np.fromiter(map(len, coded), np.int32, n)
        while self.words + n > self.at.size:
            self.at, self.length = np.resize(self.at, 2 * self.at.size), np.resize(self.length, 2 * self.length.size)
        while self.used + flat.size > self.ids.size:
            self.ids = np.resize(self.ids, 2 * self.ids.size)
        new = slice(self.words, self.words + n)
        self.length[new] = sizes
        self.at[new] = self.used + np.cumsum(sizes) - sizes
        self.ids[self.used : self.used + flat.size] = flat
        numbers = np.arange(self.words, self.words + n, dtype=np.int32)
        self.words, self.used = self.words + n, self.used + flat.size
        if 2 * self.words > self.slots.size:
            keep = self.slots != 0
            old, word = self.slots[keep], self.slot_word[keep]
            self.slots = np.zeros(max(4 * self.slots.size, 1 << int(4 * self.words - 1).bit_length()), np.uint64)
            self.slot_word = np.zeros(self.slots.size, np.int32)
            self._place(old, word)
        self._place(hashes, numbers)

    # -- encoding -----------------------------------------------------------

    def _powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if self.powers.size < n:
            size = max(n, 2 * self.powers.size, BATCH_CHARS + 4096)
            for name, base in (("powers", _BASE), ("unpowers", _UNBASE)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))
        return self.powers[:n], self.unpowers[:n]

    def _encode_split(self, texts: list[str]) -> list[np.ndarray]:
        joined = "￿".join([*texts, ""])
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        kind = self.classes[codes]
        before = np.empty_like(kind)
        before[0], before[1:] = _END, kind[:-1]
        end = kind == _END
        if self.kind == "spaced":
            space = kind == _SPACE
            start = kind != before
            start[1:] &= ~((codes[:-1] == 32) & ~space[1:] & ~end[1:])
            start[:-1] |= space[:-1] & ~space[1:] & ~end[1:]
            bounds = np.flatnonzero(start | end)
            real = ~end[bounds]
        else:
            codes = self.folded[codes]
            bounds = np.flatnonzero((kind != before) | (kind == _NUMBER) | end)
            real = (kind[bounds] != _SPACE) & ~end[bounds]
        ends = np.append(bounds[1:], codes.size)[real]
        starts = bounds[real]
        power, unpower = self._powers(codes.size)
        sums = np.zeros(codes.size + 1, np.uint64)
        np.cumsum(codes * power, dtype=np.uint64, out=sums[1:])
        size = (ends - starts).astype(np.uint64)
        hashes = (sums[ends] - sums[starts]) * unpower[starts] + size * _MIX
        hashes[hashes == 0] = 1
        long = np.flatnonzero(size > LONG_WORD)
        for k in long:  # never shared, so a collision can't matter
            hashes[k] = np.uint64(hash(joined[starts[k] : ends[k]]) & (2**64 - 1) | 1)
        words = self._find(hashes)
        new = np.flatnonzero(words < 0)
        if new.size:
            fresh, first = np.unique(hashes[new], return_index=True)
            if self.words + fresh.size > MAX_WORDS and self.words:
                self._forget()
                fresh, new = np.unique(hashes, return_index=True)
                first = np.arange(fresh.size)
            where = new[first]
            self._add(fresh, [self._word(joined[a:b]) for a, b in zip(starts[where].tolist(), ends[where].tolist(), strict=True)])
            words = self._find(hashes)
        counts = self.length[words].astype(np.int64)
        total = np.cumsum(counts)
        flat = self.ids[np.repeat(self.at[words] - total + counts, counts) + np.arange(total[-1] if total.size else 0)]
        cut = np.searchsorted(starts, np.flatnonzero(end))
        return np.split(flat, np.append(0, total)[cut])[:-1]

    def _word(self, word: str) -> list[int]:
        if self.kind == "bare":
            word = word.lower()
        return [t.id for t in self.model.tokenize(word.encode().decode("latin-1").translate(self.visible))]

    def _plain(self, text: str) -> bool:
        if text.isascii():
            return "'" not in text
        return "'" not in text and ord(max(text)) < self.limit

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """One uint32 array for each text."""
        out: list[np.ndarray | None] = [None] * len(texts)
        fast = [k for k, x in enumerate(texts) if x and self.kind != "none" and self._plain(x)]
        for a, b in chunks([texts[k] for k in fast]):
            for k, ids in zip(fast[a:b], self._encode_split([texts[k] for k in fast[a:b]]), strict=True):
                out[k] = ids
        slow = [k for k, ids in enumerate(out) if ids is None]
        for a, b in chunks([texts[k] for k in slow]):
            for k, x in zip(slow[a:b], self.tokenizer.encode_batch_fast([texts[k] for k in slow[a:b]], add_special_tokens=False), strict=True):
                out[k] = np.array(x.ids, np.uint32)
        return out
