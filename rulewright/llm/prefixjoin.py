"""Pairs of sets that share a given part of all that either has, by a prefix-filtered join.

All elements have one global order: frequent ones last, hashes decide between
the others.  Of a set of n elements, a pair of similarity t (shared elements by
elements of both) shares t * n or more, so the first element that it shares
is among the first n - ceil(t * n) + 1 of either set.  Sets meet at those
elements alone, and sizes and places rule out pairs there that cannot reach t.
Nothing else is left out: the order changes how many pairs are met, not which
similar pairs are.

Each set has a digest that rules out more pairs before whole sets are read.  A
small one's are the parities of its hash buckets: two sets differ in at least
as many elements as these differ.  A large one's are samples, a bit of the least
element of each of as many parts: they rule out a pair only if its similarity
would have to lie seven standard deviations off.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .passages import _by_key, _starts

#: Elements that are put last at most, and sets counted at once; an element is counted where OFTEN of those have it.
HEAVY = 1 << 17
COUNTED, OFTEN = 512, 3
#: Columns of a digest, 64 bits each.
DIGEST = ("digest0", "digest1", "digest2", "digest3")
#: Its bits, and elements of a set that has samples as its digest.
BITS, LARGE = 64 * len(DIGEST), 400
#: Slack for products of similarities and sizes that are whole numbers.
_SLACK = 1e-9


def prefix_size(n, similarity: float):
    """Elements of a set of n of which a similar set has one at least."""
    return n - np.ceil(similarity * n - _SLACK).astype(np.int64) + 1


def similar(x: np.ndarray, y: np.ndarray, similarity: float) -> bool:
    """Whether two sets, as sorted arrays, share `similarity` of what either has."""
    if min(x.size, y.size) < similarity * max(x.size, y.size) - _SLACK:
        return False
    shared = np.intersect1d(x, y).size
    return shared >= similarity * (x.size + y.size - shared) - _SLACK


def digest(own: np.ndarray) -> np.ndarray:
    """Of a sorted set, in 64-bit integers: the parities of its buckets, or if it is large, its samples."""
    part = (own & np.uint64(BITS - 1)).astype(np.int64)
    if own.size < LARGE:
        bits = np.bincount(part, minlength=BITS) & 1
    else:
        some, first = np.unique(part, return_index=True)
        bits = np.zeros(BITS, np.int64)
        bits[some] = (own[first] >> np.uint64(16) & np.uint64(1)).astype(np.int64)
    return np.packbits(bits.astype(np.uint8), bitorder="little").view(np.int64)


def digests_allow(x: list[np.ndarray], y: list[np.ndarray], n_x: np.ndarray, n_y: np.ndarray, similarity: float) -> np.ndarray:
    """Which pairs, by sizes and digests (columns), may be similar."""
    may = np.minimum(n_x, n_y) >= similarity * np.maximum(n_x, n_y) - _SLACK
    differ = sum(np.bitwise_count((a ^ b).view(np.uint64)).astype(np.int64) for a, b in zip(x, y, strict=True))
    small = np.maximum(n_x, n_y) < LARGE
    may &= ~small | (differ * (1 + similarity) <= (1 - similarity) * (n_x + n_y) + _SLACK)
    # The least elements of a part are the same with the similarity as odds, and else half of the bits are.
    odds = (1 - similarity) / 2
    large = np.minimum(n_x, n_y) >= LARGE
    return may & (~large | (differ <= BITS * odds + 7 * np.sqrt(BITS * odds * (1 - odds))))


def packed(own: np.ndarray) -> bytes:
    """A sorted set in five bytes an element: the high 40 bits of each."""
    return np.ascontiguousarray(own.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 3:]).tobytes()


def unpacked(data) -> np.ndarray:
    five = np.frombuffer(data, np.uint8).reshape(-1, 5)
    out = np.zeros((five.shape[0], 8), np.uint8)
    out[:, 3:] = five
    return out.view("<u8").ravel()


def frequent(sets: DataFrame, elements) -> tuple[np.ndarray, np.ndarray]:
    """Elements that many sets have, sorted, with their rank; `elements` makes (key, sorted array) pairs of batches of `sets`."""

    def run(batches):
        def flush():
            value, count = np.unique(np.concatenate(held), return_counts=True)
            some = count >= OFTEN
            return pa.RecordBatch.from_arrays([pa.array(value[some].view(np.int64)), pa.array(count[some])], ["element", "c"])

        held, seen = [], set()
        for key, own in elements(batches):
            if key not in seen:
                seen.add(key)
                held.append(own)
            if len(held) >= COUNTED:
                yield flush()
                held, seen = [], set()
        if held:
            yield flush()

    most = sets.mapInArrow(common.tidily(run), "element long, c long").groupBy("element").agg(F.sum("c").alias("c")).orderBy(F.desc("c"), "element").limit(HEAVY).toArrow()
    value, count = most.column("element").to_numpy().view(np.uint64), most.column("c").to_numpy()
    order = np.argsort(value)
    return value[order], count[order]


def prefixes(sets: DataFrame, elements, similarity: float) -> DataFrame:
    """(element, n, key, at): the first elements of each set in the global order, its size and their places."""
    shared = sets.sparkSession.sparkContext.broadcast(frequent(sets, elements))

    def run(batches):
        value, count = shared.value
        seen, rows, held = set(), [], 0
        for key, own in elements(batches):
            if key in seen or not own.size:
                continue
            seen.add(key)
            if len(seen) > 1 << 15:
                seen = {key}
            at = np.minimum(np.searchsorted(value, own), max(0, value.size - 1))
            rank = np.where(value[at] == own, count[at], 0) if value.size else np.zeros(own.size, np.int64)
            first = own[np.argsort(rank, kind="stable")[: int(prefix_size(own.size, similarity))]]
            rows.append((key, own.size, first))
            held += first.size
            if held > 1 << 15:
                yield _prefix_batch(rows)
                rows, held = [], 0
        if rows:
            yield _prefix_batch(rows)

    return sets.mapInArrow(common.tidily(run), "element long, n int, key long, at int")


def _prefix_batch(rows) -> pa.RecordBatch:
    sizes = np.array([first.size for _, _, first in rows])
    element = np.concatenate([first for _, _, first in rows]).view(np.int64)
    at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    key, n = np.array([k for k, _, _ in rows], np.uint64).view(np.int64), np.array([n for _, n, _ in rows], np.int32)
    return pa.RecordBatch.from_arrays([pa.array(element), pa.array(np.repeat(n, sizes)), pa.array(np.repeat(key, sizes)), pa.array(at.astype(np.int32))], ["element", "n", "key", "at"])


def _shared(batches):
    """Of sorted (element, n, key, at): the distinct rows of elements that more than one set has."""
    for element, n, key, at in _by_key(batches, 1):
        distinct = _starts([element, n, key])
        element, n, key, at = element[distinct], n[distinct], key[distinct], at[distinct]
        first = _starts([element])
        size = np.diff(np.append(first, element.size))
        keep = np.repeat(size > 1, size)
        if keep.any():
            yield pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in (element, n, key, at)], ["element", "n", "key", "at"])


def meeting(sets: DataFrame, elements, similarity: float) -> DataFrame:
    """The rows of `prefixes` whose element another set has as well, in the shared folder."""
    rows = prefixes(sets, elements, similarity).repartition("element").sortWithinPartitions("element", "n", "key")
    return common.settle(rows.mapInArrow(common.tidily(_shared), "element long, n int, key long, at int"), "prefixes")


def _most_common(first: np.ndarray, root: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Which rows have the root that most rows of their element have."""
    order = np.lexsort((root, number))
    runs = _starts([number[order], root[order]])
    size = np.diff(np.append(runs, root.size))
    of = number[order][runs]
    best = np.lexsort((size, of))[np.append(np.flatnonzero(np.diff(np.sort(of))), of.size - 1)]  # the longest run of each element
    return root == root[order][runs[best]][number]


def pairs(met: DataFrame, similarity: float) -> DataFrame:
    """(x, y), x < y: pairs of `met` (element, n, key, at, root, DIGEST) with different roots that may be similar.

    Of each element's rows, those with the root that most have are only
    compared with the others, so a large group of known copies costs no pairs
    within itself.
    """

    def run(batches):
        for element, n, key, at, root, *digests in _by_key(batches, 1):
            n, at = n.astype(np.int64), at.astype(np.int64)
            first = _starts([element])
            number = np.repeat(np.arange(first.size), np.diff(np.append(first, element.size)))
            rare = ~_most_common(first, root, number)
            left = np.flatnonzero(rare)
            if not left.size:
                continue
            # Rows of an element are by size, so those that one may be similar to lie around it without a gap.
            most = int(n.max()) + 1
            place = number * (2 * most + 2) + n
            low = np.searchsorted(place, number[left] * (2 * most + 2) + np.ceil(similarity * n[left] - _SLACK).astype(np.int64), side="left")
            high = np.searchsorted(place, number[left] * (2 * most + 2) + np.minimum(np.floor(n[left] / similarity + _SLACK).astype(np.int64), 2 * most), side="right")
            found = []
            for cut in range(0, left.size, 1024):
                own, start, width = left[cut : cut + 1024], low[cut : cut + 1024], (high - low)[cut : cut + 1024]
                # Rows with very many partners are taken in steps of bounded size.
                for step in range(0, int(width.max()), 64):
                    some = width > step
                    w = np.minimum(width[some] - step, 64)
                    i = np.repeat(own[some], w)
                    j = np.repeat(start[some] + step, w) + np.arange(w.sum()) - np.repeat(np.cumsum(w) - w, w)
                    may = (root[i] != root[j]) & (~rare[j] | (i < j))
                    i, j = i[may], j[may]
                    # All before a pair's first shared element is not shared; pairs are met there, if not here.
                    may = np.minimum(n[i] - at[i], n[j] - at[j]) * (1 + similarity) >= similarity * (n[i] + n[j]) - _SLACK
                    i, j = i[may], j[may]
                    may = digests_allow([d[i] for d in digests], [d[j] for d in digests], n[i], n[j], similarity)
                    i, j = i[may], j[may]
                    found.append(np.stack([np.minimum(key[i], key[j]), np.maximum(key[i], key[j])]))
                    if sum(f.shape[1] for f in found) > 1 << 18:
                        yield _pair_batch(found)
                        found = []
            if found:
                yield _pair_batch(found)

    return met.repartition("element").sortWithinPartitions("element", "n", "key").mapInArrow(common.tidily(run), "x long, y long").distinct()


def _pair_batch(found) -> pa.RecordBatch:
    distinct = np.unique(np.concatenate(found, axis=1), axis=1)
    return pa.RecordBatch.from_arrays([pa.array(distinct[0]), pa.array(distinct[1])], ["x", "y"])
