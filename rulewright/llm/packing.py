"""Best-fit packing of token sequences by the sum-of-squares rule.

Documents are encoded, closed with an end id and cut into pieces of at most
`capacity` tokens; pieces go to sequences so that, after each placement, the
sum over all gaps of (number of open sequences with that gap) squared is
smallest.  Pieces come longest first, and a new sequence is opened only where no
open one has room, which the plain rule does more often.  The state of a packer
is one count and one list of open sequences per gap, whatever the number of
documents.

Packing runs on independent shards of about SHARD_PIECES pieces, as many as the
count of the pieces asks for.  Open gaps at the end cost a shard a few
sequences; no row ever waits for another shard.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .wordcoder import chunks, coder

#: Pieces of one shard.
SHARD_PIECES = 100_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = f"{PIECES}, sequence_id long, offset long"


class SumOfSquares:
    """An on-line packer: `place(size)` gives (sequence, offset)."""

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.count = np.zeros(capacity + 1, np.int64)  # open sequences by gap
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.sequences = 0

    def place(self, size: int) -> tuple[int, int]:
        """Ties go to the smallest gap.  `size` is 1 to `capacity`."""
        gaps, count = self.capacity - size, self.count
        # Leaving r of gap g = size + r makes the sum 2 N[r] + 1 larger (nothing for a sequence that closes) and 2 N[g] - 1 smaller.
        change = 2 * count[:gaps] + 2
        change[:1] = 1
        fall = count[size : self.capacity]
        change -= np.where(fall > 0, 2 * fall, -(1 << 40))
        rest = int(change.argmin()) if fall.any() else gaps
        if rest == gaps:
            sequence, self.sequences = self.sequences, self.sequences + 1
        else:
            sequence = self.open[rest + size].pop()
            count[rest + size] -= 1
        if rest:
            self.open[rest].append(sequence)
            count[rest] += 1
        return sequence, self.capacity - rest - size


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of `n` tokens: whole pieces, a shorter one first."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity
    return [(0, first)] * bool(first) + [(s, capacity) for s in range(first, n, capacity)]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 for all pieces of `docs` (doc_id, text; a null text is empty and has its end id alone)."""

    def encode(batches):
        known = coder(tokenizer)
        for batch in batches:
            ids, whole = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in chunks(whole):
                out = []
                for doc, coded in zip(ids[a:b], known.encode(whole[a:b]), strict=True):
                    coded = np.append(coded, np.uint32(end_id)).astype("<u4")
                    out += [(doc, k, s, n, zlib.crc32(coded[s : s + n])) for k, (s, n) in enumerate(cut(coded.size, capacity))]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return common.texts(docs).mapInArrow(common.tidily(encode), PIECES)


def place(cuts: DataFrame, shards: int, capacity: int = 1024) -> DataFrame:
    """`cuts` (as `pieces` gives them) with sequence_id and offset, packed in `shards` independent parts."""

    def pack(batches):
        packer, base = SumOfSquares(capacity), TaskContext.get().partitionId() << 40
        for batch in batches:
            placed = [packer.place(n) for n in batch.column("length").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([base + s for s, _ in placed], pa.int64()), pa.array([o for _, o in placed], pa.int64())], [*batch.schema.names, "sequence_id", "offset"])

    dealt = cuts.repartition(shards, F.xxhash64("doc_id", "piece", "ids_crc32"))
    return dealt.sortWithinPartitions(F.desc("length"), "doc_id", "piece", "ids_crc32").mapInArrow(common.tidily(pack), PLACED)


def pack(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2, shards: int | None = None) -> DataFrame:
    """Packs `docs` (doc_id, text; other columns are ignored).

    Null and empty texts are one piece that holds the end id alone.  Repeated
    rows are packed each on its own.  An empty table gives no rows.  Result:
    doc_id, piece, start, length, ids_crc32, sequence_id, offset.
    """
    cuts = common.settle(pieces(docs, tokenizer, capacity, end_id), "pieces")
    return place(cuts, shards or max(1, -(-cuts.count() // SHARD_PIECES)), capacity)
