"""Token ids in wavelet matrices: one compressed file per shard.

A wavelet matrix holds a sequence of ids as one bit plane per binary digit.
The plane of the highest digit lists that digit of every id in order; the next
plane lists the next digit after a stable partition that puts the ids with a 0
before those with a 1, and so on.  With rank and select on the planes any
token can be read, counted or located in time proportional to the number of
digits, without unpacking the rest.

File layout (little-endian): ``MAGIC``, five uint64 (tokens, documents,
planes, bytes of the document section, bits of a chunk), the zeros of each
plane as uint64, an index with two uint64 for each chunk of each plane (where
its bytes end, counted from the first chunk; ones of the plane before it), the
document section (zstd: ids as int64, lengths as int64, a byte for each id that
is 1 if it is null), and the chunks of all planes (packed bits, zstd each).
A token is read from one chunk of each plane, and so are ranks: what is opened
is the index, and chunks are fetched as they are asked for.
"""

from __future__ import annotations

import struct
import zlib
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, ordered
from .wordcoder import chunks, coder

MAGIC = b"RWWM0002"
#: Text bytes on disk that make one shard, and the tokens after which a shard starts another file.
SHARD_BYTES = 24 << 20
FILE_TOKENS = 1 << 23

#: Bits of a plane that are compressed together; ranks are stored for each.
CHUNK = 1 << 17
#: Chunks that an open file remembers.
REMEMBERED = 64


class _Bytes:
    """A file in memory; `taken` counts the bytes that were asked for."""

    def __init__(self, data: bytes) -> None:
        self.data, self.taken = data, 0

    def read(self, at: int, size: int) -> bytes:
        self.taken += size
        return self.data[at : at + size]


class _File(_Bytes):
    """A file on any file system that allows reads in its midst."""

    def __init__(self, uri: str) -> None:
        files, path = fs.FileSystem.from_uri(uri)
        self.file, self.taken = files.open_input_file(path), 0

    def read(self, at: int, size: int) -> bytes:
        self.taken += size
        return self.file.read_at(size, at)


class WaveletMatrix:
    """A shard's ids in a file: `access`, `rank`, `select`, `count`, `occurrences` and `decode`; `docs`, `lengths` and `absent` (null ids) of its documents."""

    def __init__(self, source: _Bytes) -> None:
        self.source = source
        head = source.read(0, 48)
        if head[:8] != MAGIC:
            raise ValueError("not a wavelet matrix file")
        self.n, self._n_docs, digits, self._docs_size, self.chunk = struct.unpack_from("<5Q", head, 8)
        chunks_ = -(-self.n // self.chunk)
        self.zeros = np.frombuffer(source.read(48, 8 * digits), "<u8").astype(np.int64).tolist()
        index = np.frombuffer(source.read(48 + 8 * digits, 16 * digits * chunks_), "<u8").astype(np.int64).reshape(digits, chunks_, 2)
        self._docs_at = 48 + 8 * digits + 16 * digits * chunks_
        ends = self._docs_at + self._docs_size + index[:, :, 0].ravel()
        self._starts = np.append(self._docs_at + self._docs_size, ends[:-1]).reshape(digits, chunks_) if ends.size else ends.reshape(digits, chunks_)
        self._ends, self._ones, self._held = ends.reshape(digits, chunks_), index[:, :, 1], {}

    # -- documents ---------------------------------------------------------------------------------------------

    def _documents(self) -> np.ndarray:
        import zstandard

        if not hasattr(self, "_section"):
            self._section = zstandard.ZstdDecompressor().decompress(self.source.read(self._docs_at, self._docs_size))
        return self._section

    @property
    def docs(self) -> np.ndarray:
        return np.frombuffer(self._documents(), "<i8", self._n_docs)

    @property
    def lengths(self) -> np.ndarray:
        return np.frombuffer(self._documents(), "<i8", self._n_docs, 8 * self._n_docs)

    @property
    def absent(self) -> np.ndarray:
        return np.frombuffer(self._documents(), np.uint8, self._n_docs, 16 * self._n_docs).astype(bool)

    # -- planes ------------------------------------------------------------------------------------------------

    def _chunk(self, plane: int, k: int) -> np.ndarray:
        """A chunk's packed bits."""
        import zstandard

        if (plane, k) not in self._held:
            if len(self._held) >= REMEMBERED:
                del self._held[next(iter(self._held))]
            start, end = int(self._starts[plane, k]), int(self._ends[plane, k])
            self._held[plane, k] = np.frombuffer(zstandard.ZstdDecompressor().decompress(self.source.read(start, end - start)), np.uint8)
        return self._held[plane, k]

    def _bit(self, plane: int, i: int) -> int:
        k, at = divmod(i, self.chunk)
        return int(self._chunk(plane, k)[at >> 3] >> (7 - (at & 7))) & 1

    def _rank(self, plane: int, i: int) -> int:
        """Ones of a plane before place i."""
        k, at = divmod(i, self.chunk)
        if not at:
            return int(self._ones[plane, k]) if k < self._ones.shape[1] else self.n - self.zeros[plane]
        held, byte = self._chunk(plane, k), at >> 3
        return int(self._ones[plane, k]) + int(np.bitwise_count(held[:byte]).sum()) + (int(held[byte] >> (8 - (at & 7))).bit_count() if at & 7 else 0)

    def _find(self, plane: int, bit: int, k: int) -> int:
        """Place of the k-th (from 0) such bit of a plane."""
        before = self._ones[plane] if bit else np.arange(self._ones.shape[1]) * self.chunk - self._ones[plane]
        chunk = int(np.searchsorted(before, k, "right")) - 1
        a = chunk * self.chunk
        bits = np.unpackbits(self._chunk(plane, chunk), count=min(self.chunk, self.n - a))
        return a + int(np.flatnonzero(bits == bit)[k - int(before[chunk])])

    def _plane(self, plane: int) -> np.ndarray:
        """All packed bits of a plane, read in one go."""
        import zstandard

        if not self.n:
            return np.zeros(0, np.uint8)
        at, end = int(self._starts[plane, 0]), int(self._ends[plane, -1])
        data, unpack = memoryview(self.source.read(at, end - at)), zstandard.ZstdDecompressor().decompress
        return np.frombuffer(b"".join(unpack(data[s - at : e - at]) for s, e in zip(self._starts[plane].tolist(), self._ends[plane].tolist(), strict=True)), np.uint8)

    def decode(self) -> np.ndarray:
        """All ids, as uint32: the partitions undone from the last plane to the first."""
        now = np.zeros(self.n, np.uint16 if len(self.zeros) <= 16 else np.uint32)
        for k, zeros in enumerate(reversed(self.zeros)):
            bit = np.unpackbits(self._plane(len(self.zeros) - 1 - k), count=self.n).view(bool)
            before = np.empty_like(now)
            before[~bit] = now[:zeros]
            before[bit] = now[zeros:] | now.dtype.type(1 << k)
            now = before
        return now.astype("<u4")

    def access(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for plane, zeros in enumerate(self.zeros):
            bit = self._bit(plane, i)
            value = value << 1 | bit
            i = zeros + self._rank(plane, i) if bit else i - self._rank(plane, i)
        return value

    def _narrow(self, token: int, i: int, j: int) -> tuple[int, int]:
        if token >> len(self.zeros):
            return 0, 0
        for plane, zeros in enumerate(self.zeros):
            a, b = self._rank(plane, i), self._rank(plane, j)
            i, j = (zeros + a, zeros + b) if token >> (len(self.zeros) - 1 - plane) & 1 else (i - a, j - b)
        return i, j

    def count(self, token: int, i: int = 0, j: int | None = None) -> int:
        """Occurrences of `token` in places i to j (exclusive)."""
        a, b = self._narrow(token, i, self.n if j is None else j)
        return b - a

    def rank(self, token: int, i: int) -> int:
        return self.count(token, 0, i)

    def select(self, token: int, k: int) -> int:
        """Place of the k-th (from 0) occurrence of `token`."""
        a, b = self._narrow(token, 0, self.n)
        if not 0 <= k < b - a:
            raise IndexError(k)
        i = a + k
        for plane in range(len(self.zeros) - 1, -1, -1):
            if token >> (len(self.zeros) - 1 - plane) & 1:
                i = self._find(plane, 1, i - self.zeros[plane])
            else:
                i = self._find(plane, 0, i)
        return i

    def occurrences(self, token: int) -> list[int]:
        return [self.select(token, k) for k in range(self.count(token))]

    @classmethod
    def from_bytes(cls, data: bytes) -> WaveletMatrix:
        return cls(_Bytes(data))


def to_bytes(ids: np.ndarray, docs: list[int | None], lengths: np.ndarray, chunk: int = CHUNK) -> bytes:
    """The file of a shard's ids and the documents that they belong to, one after the other."""
    import zstandard

    pack = zstandard.ZstdCompressor(level=1).compress
    digits = max(1, int(ids.max(initial=0)).bit_length())
    now = ids.astype(np.uint16 if digits <= 16 else np.uint32)
    zeros, index, held, at = [], [], [], 0
    for k in range(digits - 1, -1, -1):
        bit = (now >> k & 1).astype(bool)
        ones = 0
        for a in range(0, bit.size, chunk):
            part = bit[a : a + chunk]
            held.append(pack(np.packbits(part).tobytes()))
            at += len(held[-1])
            index += [at, ones]
            ones += int(part.sum())
        low = now[~bit]
        zeros.append(low.size)
        now = np.concatenate([low, now[bit]])
    absent = np.array([d is None for d in docs], np.uint8)
    section = pack(np.array([d or 0 for d in docs], "<i8").tobytes() + lengths.astype("<i8").tobytes() + absent.tobytes())
    head = struct.pack("<5Q", ids.size, len(docs), digits, len(section), chunk)
    return b"".join([MAGIC, head, np.array(zeros, "<u8").tobytes(), np.array(index, "<u8").tobytes(), section, *held])


@contextmanager
def open_file(uri: str):
    """The matrix of a file, of which no more is read than what is asked for."""
    source = _File(uri)
    try:
        yield WaveletMatrix(source)
    finally:
        source.file.close()


def write(docs: DataFrame, tokenizer: str, out_dir: str, end_id: int = 1) -> DataFrame:
    """Writes all `docs` (doc_id, text) in ascending doc_id order; gives (file, shard, part, tokens, documents), already computed.

    A null text counts as empty and has its end id alone; rows with the same
    doc_id follow one another by text, and those without one come first and
    have none in the file either; an empty table makes no file.  Files
    are named by task attempt: a repeated attempt never overwrites another's,
    and only the files of the attempts that Spark kept are listed.
    """
    dealt, _ = ordered.in_order(docs, SHARD_BYTES)

    def encode(batches):
        known, files = coder(tokenizer), None
        held, ids, size, part = [], [], 0, 0
        shard, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()

        def flush():
            nonlocal files, held, ids, size, part
            lengths = np.array([x.size for x in held], np.int64)
            n, data = int(lengths.sum()), to_bytes(np.concatenate(held), ids, lengths)
            name = f"{out_dir}/{shard:06d}-{part:04d}-{attempt}.wm"
            if files is None:
                files = fs.FileSystem.from_uri(name)[0]
                files.create_dir(fs.FileSystem.from_uri(out_dir)[1], recursive=True)
            with files.open_output_stream(fs.FileSystem.from_uri(name)[1]) as file:
                file.write(data)
            row = [[name], [shard], [part], [n], [len(ids)]]
            held, ids, size, part = [], [], 0, part + 1
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(row, (pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64()), strict=True)], ["file", "shard", "part", "tokens", "documents"])

        for batch in batches:
            doc_ids, whole = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in chunks(whole):
                for doc, coded in zip(doc_ids[a:b], known.encode(whole[a:b]), strict=True):
                    if held and size + coded.size + 1 > FILE_TOKENS:
                        yield flush()
                    held.append(np.append(coded, np.uint32(end_id)).astype(np.uint16 if known.small else np.uint32))
                    ids.append(doc)
                    size += coded.size + 1
        if held:
            yield flush()

    return common.settle(dealt.select("doc_id", "text").mapInArrow(encode, "file string, shard int, part int, tokens long, documents long"), "wavelet-files")


def read(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of all documents in the files that `write` listed, from the files alone.

    The driver holds one short row per file (8 million tokens each).
    """
    spark, listed, start = files.sparkSession, [], 0
    for row in files.select("file", "tokens").orderBy("shard", "part").collect():
        listed.append((row["file"], start))
        start += row["tokens"]

    def decode(batches):
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with open_file(name) as matrix:
                    docs, lengths, absent, data = matrix.docs, matrix.lengths, matrix.absent, memoryview(matrix.decode())
                ends = np.cumsum(lengths)
                at = [0, *ends.tolist()]
                crc = [zlib.crc32(data[a:b]) for a, b in zip(at, at[1:], strict=False)]
                yield pa.RecordBatch.from_arrays([pa.array(docs, mask=absent), pa.array(start + ends - lengths), pa.array(lengths), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    frame = spark.createDataFrame(listed, "file string, start long")
    return frame.repartition(max(1, len(listed)), F.xxhash64("file")).mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    """Encodes, writes and reads back; see `write` and `read`."""
    return read(write(docs, tokenizer, common.new_dir(docs.sparkSession, "wavelet"), end_id))
