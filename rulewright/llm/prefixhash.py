"""Document fingerprints from prefix polynomial hashes.

A prefix array holds, for each place i, the polynomial hash of the first i
code points modulo a prime.  The hash of any span is a difference of two
entries, so spans compare in constant time and the longest common extension of
two places is found by binary search.

A fingerprint is the hash of the whole text under two primes and the smallest
mixed hashes of its spans of `SPAN` code points (a bottom-k sketch of the set
of spans, read off the same arrays).  Equal texts have equal fingerprints.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import ordered

#: Two Mersenne-like moduli under 2**31, each with a base.
PRIMES = ((2147483647, 911382323), (2147483629, 972663749))
SPAN = 32
SKETCH = 48
#: Text bytes on disk in a shard; shards stream, so this is no memory bound.
SHARD_BYTES = 32 << 20

_MIX = np.uint64(0x9E3779B97F4A7C15)


class _Powers:
    """Powers of a base and of its inverse modulo a prime, grown as needed."""

    def __init__(self, prime: int, base: int) -> None:
        self.prime, self.base, self.inverse = prime, base, pow(base, -1, prime)
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while self.up.size < n:
            size = np.uint64(self.prime)
            for name, base in (("up", self.base), ("down", self.inverse)):
                had = getattr(self, name)
                setattr(self, name, np.concatenate([had, had * np.uint64(pow(base, had.size, self.prime)) % size]))
        return self.up[:n], self.down[:n]


_powers = [_Powers(*x) for x in PRIMES]


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class PrefixHashes:
    """The prefix arrays of one text."""

    def __init__(self, text: str | np.ndarray) -> None:
        self.codes = codes(text) if isinstance(text, str) else text
        self.n = self.codes.size
        self.sums = [self._sums(p) for p in _powers]

    def _sums(self, powers: _Powers) -> np.ndarray:
        up, _ = powers.get(self.n)
        out, prime = np.zeros(self.n + 1, np.uint64), np.uint64(powers.prime)
        # Code points are below 2**21 and powers below 2**31; reduced terms stay below 2**31, sums of 2**32 of them below 2**63.
        np.cumsum((self.codes + np.uint64(1)) * up % prime, out=out[1:])
        out %= prime
        return out

    def spans(self, size: int, k: int = 0) -> np.ndarray:
        """Hashes of all spans of `size` code points under the k-th prime."""
        if self.n < size:
            return np.zeros(0, np.uint64)
        sums, prime = self.sums[k], np.uint64(_powers[k].prime)
        _, down = _powers[k].get(self.n)
        return (sums[size:] + prime - sums[: self.n - size + 1]) % prime * down[: self.n - size + 1] % prime

    def span(self, a: int, b: int) -> tuple[int, int]:
        return tuple(int((int(s[b]) - int(s[a])) * pow(p.inverse, a, p.prime) % p.prime) for s, p in zip(self.sums, _powers, strict=True))

    def equal(self, a: int, other: PrefixHashes, b: int, size: int) -> bool:
        """Whether the spans of `size` at place a here and place b of `other` are equal."""
        return a + size <= self.n and b + size <= other.n and self.span(a, a + size) == other.span(b, b + size)

    def extension(self, a: int, other: PrefixHashes, b: int) -> int:
        """Length of the longest common extension of place a here and place b of `other`."""
        low, high = 0, min(self.n - a, other.n - b)
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if self.equal(a, other, b, middle) else (low, middle - 1)
        return low


def _smallest(values: np.ndarray) -> np.ndarray:
    """The SKETCH smallest distinct values, sorted."""
    take = 4 * SKETCH
    while take < values.size:
        least = np.unique(np.partition(values, take)[:take])
        if least.size >= SKETCH:
            return least[:SKETCH]
        take *= 4
    return np.unique(values)[:SKETCH]


def _mixed(hashes: np.ndarray) -> np.ndarray:
    return ((hashes + np.uint64(1)) * _MIX) >> np.uint64(32)


def _written(n: int, whole: tuple[int, int], sketch: np.ndarray) -> str:
    return f"{n}:{whole[0]:08x}{whole[1]:08x}:" + "".join(f"{x:08x}" for x in sketch.tolist())


class Sketched:
    """A text with what its own fingerprint and that of an edited text need."""

    def __init__(self, text: str) -> None:
        self.text, self.hashes = text, PrefixHashes(text)
        self.n = self.hashes.n
        self.mixed = _mixed(self.hashes.spans(SPAN))
        self.sketch = _smallest(self.mixed if self.mixed.size else _short(self.hashes))
        self.fingerprint = _written(self.n, self.hashes.span(0, self.n), self.sketch)


def _short(hashes: PrefixHashes) -> np.ndarray:
    """Texts below SPAN code points have one span: themselves; the empty text has none."""
    return _mixed(np.array([hashes.span(0, hashes.n)[0]], np.uint64)) if hashes.n else np.zeros(0, np.uint64)


def fingerprint(text: str) -> str:
    return Sketched(text).fingerprint


def likeness(a: str, b: str) -> float:
    """Share of spans two fingerprinted texts have in common (Dice), 0 to 1; 1 for equal fingerprints.

    The smallest hashes of both sketches together are a sample of all spans;
    the part found in both estimates their overlap.
    """
    if a == b:
        return 1.0
    x, y = ({s[k : k + 8] for k in range(0, len(s), 8)} for s in (a.rpartition(":")[2], b.rpartition(":")[2]))
    sample = sorted(x | y)[:SKETCH]
    if not sample:
        return 0.0
    both = sum(h in x and h in y for h in sample) / len(sample)
    return 2 * both / (1 + both)


def edited(here: Sketched, following: Sketched) -> tuple[str, str, str]:
    """(text, sha256, fingerprint) of `here` with its last n // 2 code points replaced by the first as many of `following`.

    Spans of the kept half and of the inserted part are those of the two
    documents; only the spans across the joint are hashed anew.
    """
    keep, new = here.n - here.n // 2, min(here.n // 2, following.n)
    text = here.text[:keep] + following.text[:new]
    n = keep + new
    if n < SPAN:
        hashes = PrefixHashes(text)
        return text, _sha(text), _written(n, hashes.span(0, n), _smallest(_short(hashes)))
    a, b = max(0, keep - SPAN + 1), min(n, keep + SPAN - 1)
    joint = _mixed(PrefixHashes(text[a:b]).spans(SPAN))
    parts = [here.mixed[: max(0, keep - SPAN + 1)], joint, following.mixed[: max(0, new - SPAN + 1)]]
    sketch = _smallest(np.concatenate([_smallest(p) for p in parts]))
    whole = []
    for k, powers in enumerate(_powers):
        shift = pow(powers.base, keep, powers.prime)
        whole.append((int(here.hashes.sums[k][keep]) + int(following.hashes.sums[k][new]) * shift) % powers.prime)
    return text, _sha(text), _written(n, tuple(whole), sketch)


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of all `docs` (doc_id, text), of their edited texts, and how near they are.

    A null text counts as empty.  The next document is the one that follows by
    (doc_id, text), repeated rows included; after the last comes the first, so
    a single document follows itself.  Two empty texts are alike (1.0), an
    empty and another one are not (0.0).  An empty table gives no rows.
    """
    dealt, _ = ordered.in_order(docs, SHARD_BYTES, peek=True)

    def run(batches):
        here = doc = shard = first = None
        done = True
        names = [x.split()[0] for x in RESULT.split(", ")]

        def row(following: Sketched):
            _, sha, changed = edited(here, following)
            return doc, here.n, sha, here.fingerprint, changed, likeness(here.fingerprint, changed), likeness(here.fingerprint, following.fingerprint)

        def batch_of(rows):
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

        for batch in batches:
            rows = []
            for next_doc, text, next_shard, peek in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if done and peek and next_shard == shard:
                    continue
                following = Sketched(text)
                if not done:
                    rows.append(row(following))
                first, shard, done = first or following, next_shard, peek
                here, doc = following, next_doc
            if rows:
                yield batch_of(rows)
        if not done:  # without a peeked row all documents are in this one partition
            yield batch_of([row(first)])

    return dealt.select("doc_id", "text", "shard", "peek").mapInArrow(run, RESULT)
