"""Benchmark decontamination by the q-gram lemma.

A benchmark item is cut into overlapping windows.  A window of W characters
that occurs in a document with at most e edits shares at least
W - q + 1 - q * e of its q-grams with a region of at most W + e characters
there, and all of these lie on neighbouring diagonals (place in the document
minus place in the item).  Documents are searched in three steps: regions
dense enough in q-grams of any item; counts of shared q-grams for each window
and overlapping diagonal band; banded alignment of what reaches the bound.

Shared q-grams are counted in portions of bounded size: a text or benchmark that
repeats itself makes more portions, not larger ones.

Benchmark text is broadcast in blocks of a fixed size, one at a time; a larger
benchmark takes a pass over the documents for each block.  Documents are read
whole and never moved.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .wordcoder import chunks

#: Characters of a q-gram, of a window, between windows, and edits allowed per character.
Q = 8
WINDOW = 80
STRIDE = 40
EDITS = 0.075
#: Items with fewer characters (after `normal`) match as whole words, without edits.
SHORTEST = 24
#: Characters of benchmark text that one broadcast holds, and shared q-grams of windows that are counted at once, at most.
BLOCK_CHARS = 4 << 20
PORTION = 1 << 21
#: Repeats of up to 16 characters that go on for more than twice as long keep so many characters at both ends.
KEEP = 128

_BITS = 22
_BASE = 0x9E3779B97F4A7C15
_STEP = np.uint64(0xD6E8FEB86659FD93)
#: Stands between texts; no character has this number.
_BORDER = 0x110000


def normal(text: str | None) -> str:
    """Lower case, and white space as single spaces."""
    return " ".join((text or "").lower().split())


def _grams(code: np.ndarray) -> np.ndarray:
    """A hash of the q-gram at each place."""
    n = code.size - Q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(Q):
        out *= np.uint64(_BASE)
        out += code[k : k + n]
    out *= _STEP
    out ^= out >> np.uint64(29)
    return out * np.uint64(_BASE)


def _code(texts: list[str]) -> np.ndarray:
    """The characters of texts in normal form, a border after each."""
    code = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32).copy()
    code[code == 10] = _BORDER
    return code


def shorten(code: np.ndarray) -> np.ndarray:
    """`code` without the middle of long repeats; all stretches of up to KEEP - 16 characters are still there, and no new ones."""
    for period in (16, 12, 10, 14):  # multiples of the shorter ones
        if code.size <= 2 * KEEP + period:
            return code
        breaks = np.flatnonzero(code[period:] != code[:-period]) + period
        starts, ends = np.append(period, breaks + 1), np.append(breaks, code.size)
        long = ends - starts > 2 * KEEP
        if long.any():
            keep = np.ones(code.size, bool)
            code = code.copy()
            for start, end in zip((starts[long] - period + KEEP).tolist(), (ends[long] - KEEP).tolist(), strict=True):
                keep[start:end] = False
                # The first character dropped stays as a number that no character has.
                keep[start], code[start] = True, _BORDER + 1
            code = code[keep]
    return code


class Windows(NamedTuple):
    first: np.ndarray  # place in the block
    size: np.ndarray
    edits: np.ndarray
    bound: np.ndarray  # shared q-grams at least


class Index:
    """A block of benchmark items; windows with the same characters are one."""

    def __init__(self, items: list[tuple[int, str]]) -> None:
        known: dict[str, int] = {}
        self.owners: list[list[int]] = []
        #: Items too short for a q-gram, by their number of words.
        self.tiny: dict[int, dict[str, list[int]]] = {}
        rows, texts, at = [], [], 0
        for item, text in items:
            short = len(text) < SHORTEST
            if short and len(text) + 2 < Q:
                self.tiny.setdefault(text.count(" ") + 1, {}).setdefault(text, []).append(item)
                continue
            text = f" {text} " if short else text
            n = len(text)
            texts.append(text)
            for s in [0] if n <= WINDOW else [*range(0, n - WINDOW, STRIDE), n - WINDOW]:
                w = min(n, WINDOW)
                own = known.setdefault(text[s : s + w], len(rows))
                if own == len(rows):
                    e = 0 if short else int(EDITS * w)
                    rows.append((at + s, w, e, w - Q + 1 - Q * e))
                    self.owners.append([])
                if item not in self.owners[own][-1:]:
                    self.owners[own].append(item)
            at += n + 1
        self.code = _code(texts)
        self.windows = Windows(*np.array(rows, np.int64).reshape(-1, 4).T)
        # Of each place of the block, the windows over it: a range, as windows are by place.
        spots = np.arange(self.code.size)
        self.from_window = np.searchsorted(self.windows.first + self.windows.size, spots + Q, "left")
        self.to_window = np.searchsorted(self.windows.first, spots, "right")
        grams = _grams(self.code)
        place = np.flatnonzero((self.to_window > self.from_window)[: grams.size])
        grams, place = grams[place], place
        order = np.lexsort((place, grams))
        self.place = place[order]
        self.grams, rank = np.unique(grams[order], return_inverse=True)
        #: Ranks of q-grams with their places, ascending.
        self.ranked = rank * self.code.size + self.place
        self.seen = np.zeros(1 << _BITS, bool)
        self.seen[(self.grams >> np.uint64(64 - _BITS)).astype(np.int64)] = True
        # Kinds of windows for the first step: (region, least bound); short windows by eights.
        kinds: dict[int, tuple[int, int]] = {}
        for w, e, t in set(zip(self.windows.size.tolist(), self.windows.edits.tolist(), self.windows.bound.tolist(), strict=True)):
            region, bound = kinds.get(w // 8, (0, 1 << 30))
            kinds[w // 8] = max(region, w + e - Q + 1), min(bound, t)
        self.kinds = list(kinds.values())
        most = int(self.windows.edits.max()) if rows else 0
        self.wide = 2 * most + 2
        #: Characters that all shared q-grams of a window and band lie within.
        self.span = WINDOW + self.wide + most + Q

    def _active(self, grams: np.ndarray) -> np.ndarray:
        """Places whose q-gram is in the block and lies in a region dense enough for some window."""
        hit = self.seen[(grams >> np.uint64(64 - _BITS)).astype(np.int64)]
        total = np.append(0, np.cumsum(hit, dtype=np.int32))
        active = np.zeros(hit.size, bool)
        for region, bound in self.kinds:
            ends = np.minimum(np.arange(region, hit.size + region), hit.size)
            dense = np.flatnonzero(hit & (total[ends] - total[:-1] >= bound))  # regions that begin with a hit are enough
            if dense.size:
                mark = np.zeros(hit.size + 1, np.int32)
                mark[dense] += 1
                np.subtract.at(mark, np.minimum(dense + region, hit.size), 1)
                active |= np.cumsum(mark[:-1]) > 0
        return np.flatnonzero(active & hit)

    def search(self, texts: list[str]) -> list[tuple[int, int, int, int]]:
        """(text number, item, edits, windows found) of all items found in `texts` (normal form), with the fewest edits of a window."""
        best: dict[tuple[int, int], list[int]] = {}
        for number, text in enumerate(texts) if self.tiny else ():
            words = text.split(" ")
            for n, wanted in self.tiny.items():
                for found in wanted.keys() & {" ".join(words[k : k + n]) for k in range(len(words) - n + 1)}:
                    best |= {(number, item): [0, 1] for item in wanted[found]}
        if self.grams.size:
            code = shorten(_code([f" {x} " for x in texts]))
            grams = _grams(code)
            at = self._active(grams)
            rank = np.minimum(np.searchsorted(self.grams, grams[at]), self.grams.size - 1)
            shared = self.grams[rank] == grams[at]
            borders, sure = np.flatnonzero(code == _BORDER), np.zeros(0, np.int64)
            fewest: dict[int, int] = {}  # text number * windows + window: edits
            n = self.windows.size.size
            for which, diagonal in self._candidates(at[shared], rank[shared], 0, n):
                middle = self.windows.first[which] + self.windows.size[which] // 2 + diagonal + self.wide // 2
                key = np.searchsorted(borders, np.clip(middle, 0, code.size - 1)) * n + which
                # What is there without edits can't get better.
                left = np.flatnonzero(~np.isin(key, sure))
                key, which, diagonal = key[left], which[left], diagonal[left]
                edits = self._align(code, which, diagonal, self.wide)
                ok = edits <= self.windows.edits[which]
                for k, e in zip(key[ok].tolist(), edits[ok].tolist(), strict=True):
                    fewest[k] = min(e, fewest.get(k, e))
                sure = np.union1d(sure, key[ok & (edits == 0)])
            for k, e in fewest.items():
                for item in self.owners[k % n]:
                    had = best.setdefault((k // n, item), [e, 0])
                    had[0], had[1] = min(e, had[0]), had[1] + 1
        return [(d, item, e, windows) for (d, item), (e, windows) in sorted(best.items())]

    def _candidates(self, at: np.ndarray, rank: np.ndarray, low: int, high: int):
        """(windows, first diagonals of bands) that reach the bound, for windows `low` to `high`; where there is too much to count, for parts of the text and of the windows."""
        if not at.size or low == high:
            return
        size = self.code.size
        begin = np.searchsorted(self.ranked, rank * size + self.windows.first[low])
        end = np.searchsorted(self.ranked, rank * size + self.windows.first[high - 1] + self.windows.size[high - 1])
        some = np.flatnonzero(end > begin)
        at, rank, begin, n = at[some], rank[some], begin[some], (end - begin)[some]
        if not at.size:
            return
        total = np.cumsum(n)
        if total[-1] > PORTION:
            middle = at[np.searchsorted(total, total[-1] // 2)]
            head, tail = at < middle + self.span, at >= middle
            if not head.all() and not tail.all():
                yield from self._candidates(at[head], rank[head], low, high)
                yield from self._candidates(at[tail], rank[tail], low, high)
                return
            if high - low > 1:
                yield from self._candidates(at, rank, low, (low + high) // 2)
                yield from self._candidates(at, rank, (low + high) // 2, high)
                return
        place = self.place[np.repeat(begin, n) + np.arange(total[-1]) - np.repeat(total - n, n)]
        # Each shared q-gram, for each window over it.
        first, last = np.maximum(self.from_window[place], low), np.minimum(self.to_window[place], high)
        many = np.maximum(last - first, 0)
        ends = np.cumsum(many)
        window = np.repeat(first - ends + many, many) + np.arange(ends[-1])
        diagonal = np.repeat(np.repeat(at, n) - place, many) + size
        for half in (0, self.wide // 2):
            key, count = np.unique(window * (1 << 40) + (diagonal + half) // self.wide, return_counts=True)
            of = key >> 40
            good = count >= self.windows.bound[of]
            if good.any():
                yield of[good], (key[good] & ((1 << 40) - 1)) * self.wide - half - size

    def _align(self, code: np.ndarray, which: np.ndarray, diagonal: np.ndarray, wide: int, step: int = 4096) -> np.ndarray:
        """Fewest edits that turn each window into some stretch of the document on its band of diagonals."""
        out = np.full(which.size, 1 << 15, np.int64)
        margin = int(self.windows.edits.max())
        for w in np.unique(self.windows.size[which]).tolist():
            of_size = np.flatnonzero(self.windows.size[which] == w)
            for k in range(0, of_size.size, step):
                some = of_size[k : k + step]
                item = self.code[self.windows.first[which[some]][:, None] + np.arange(w)]
                start = self.windows.first[which[some]] + diagonal[some] - margin
                width = wide + 2 * margin
                spot = start[:, None] + np.arange(w + width)
                text = np.where((spot >= 0) & (spot < code.size), code[np.clip(spot, 0, code.size - 1)], _BORDER)
                shift = np.arange(width + 1)
                row = np.zeros((some.size, width + 1), np.int32)
                for i in range(w):
                    reach = row + (item[:, i, None] != text[:, i : i + width + 1])
                    reach[:, :-1] = np.minimum(reach[:, :-1], row[:, 1:] + 1)
                    row = np.minimum.accumulate(reach - shift, axis=1) + shift
                out[some] = row.min(1)
        return out


def blocks(benchmark: DataFrame) -> int:
    """How many blocks of about BLOCK_CHARS characters the benchmark makes."""
    chars = benchmark.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    return -(-chars // BLOCK_CHARS)


def block(benchmark: DataFrame, k: int, n: int) -> list[tuple[int, str]]:
    """The k-th of `n` blocks: items in normal form, those without a character left out."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id is not null and text is not null")
    some = items.where(F.pmod(F.xxhash64("text"), F.lit(n)) == k).distinct().toArrow()
    found = zip(some.column("item_id").to_pylist(), map(normal, some.column("text").to_pylist()), strict=True)
    return sorted((item, text) for item, text in found if text)


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, edits, windows: the benchmark items with a passage in a document.

    A passage is a window of an item (the whole item if it is short) with at
    most 7.5 % edits; `edits` is the least of a window, `windows` how many
    different windows were found.  Items under 24 characters match as whole
    words without edits.  Null and empty texts match nothing, nor do null or
    empty items or those without an id; repeated rows of `docs` each match;
    items that repeat an id with another text count together.  No rows if
    either table is empty; other columns are ignored.  A benchmark of several
    blocks is searched at once, one block after the other.
    """
    spark, found = docs.sparkSession, []
    n = blocks(benchmark)
    for k in range(n):
        items = block(benchmark, k, n)
        if not items:
            continue
        index = spark.sparkContext.broadcast(items)

        def run(batches, index=index):
            own = _index(index.value)
            for batch in batches:
                ids, texts = batch.column(0).to_pylist(), [normal(x) for x in batch.column(1).to_pylist()]
                rows = []
                for a, b in chunks(texts, 1 << 18):
                    rows += [(ids[a + d], item, e, w) for d, item, e, w in own.search(texts[a:b])]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows, strict=True)], ["doc_id", "item_id", "edits", "windows"])

        own = common.texts(docs).where("text <> ''").mapInArrow(common.tidily(run), "doc_id long, item_id long, edits long, windows long")
        if n > 1:
            own = common.settle(own, "matches")
            index.destroy()
        found.append(own)
    if not found:
        return spark.createDataFrame([], "doc_id long, item_id long, edits long, windows long")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


_held: list = [None, None]


def _index(items: list[tuple[int, str]]) -> Index:
    """The index of a broadcast's items, made once in a worker; the items are held with it, so no other list is taken for them."""
    if _held[0] is not items:
        _held[:] = items, Index(items)
    return _held[1]


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """`docs` without the documents that hold a benchmark passage.

    All rows of an id go if one does.  Rows with a null doc_id stay, as do
    null and empty texts; all columns stay.
    """
    found = common.settle(matches(docs, benchmark).select("doc_id").distinct(), "leaks")
    return docs.join(found, docs["doc_id"] == found["doc_id"], "left_anti")
