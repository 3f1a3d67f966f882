"""SimHash near-duplicates by an embedding into segment bit counts.

A fingerprint's 32 segments of two bits are mapped to their bit counts, 0 to
2.  Two fingerprints that differ in d bits have count vectors at Manhattan
distance d or less, so a range join of the vectors finds every link and the
full fingerprints decide.  Counts are written in unary (00, 01, 11), which
makes the Manhattan distance a population count of an exclusive or.

The range join goes over a grid.  Of the two halves of a vector (16 segments),
one must lie within half the radius, 2; two half vectors that close are both
within 1 of a common grid point.  Each fingerprint therefore visits, for each
half, its own grid point and the about 24 next to it, and is compared with the
others that meet it there.  Equal fingerprints are taken together before that.
Within a grid point only a spanning forest of the links is written: a group of
n near copies gives n - 1 edges from a point, not n * n.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, graph, prefixjoin

SEED = 42
#: The largest radius that the grid covers.
RADIUS = 4
#: Fingerprints at a grid point that one task compares; beyond, pairs of blocks of this size go to tasks of their own.
BLOCK = 1 << 13
#: Groups up to this size are compared all at once.
SMALL = 8

_LOW = np.uint64(0x5555555555555555)
_FLIPS = np.uint64(1) << np.arange(32, dtype=np.uint64)


def fingerprint(text: str, width: int = 4) -> int:
    """The majority bits of the XXH64 values of the word shingles of a text; A-Z count as a-z."""
    from xxhash import xxh64_intdigest

    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined, n = b" ".join(words), max(1, len(words) - width + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.append(0, ends[:-1])[:n].tolist()
    stops = (ends[-n:] - 1).tolist()
    hashes = np.fromiter((xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, stops, strict=True)), np.uint64, n)
    counts = np.zeros(64, np.int64)
    for a in range(0, n, 4096):
        counts += np.unpackbits(hashes[a : a + 4096].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = 4) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed long; null and empty texts have 0."""

    def run(batches):
        for batch in batches:
            found = np.fromiter((fingerprint(x, width) for x in batch.column(1).to_pylist()), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    return common.texts(docs).mapInArrow(run, "doc_id long, fp long")


def unary(fps: np.ndarray) -> np.ndarray:
    """The bit counts of the segments, in unary: the low bit if any is set, the high bit if both are."""
    return (fps | fps >> np.uint64(1)) & _LOW | ((fps & fps >> np.uint64(1)) & _LOW) << np.uint64(1)


def grid_points(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(point, fingerprint) pairs: for both halves, the half vector's point and the points at distance 1."""
    counts, points, owners = unary(fps), [], []
    for half in (0, 1):
        own = counts >> np.uint64(32 * half) & np.uint64(0xFFFFFFFF)
        near = own[:, None] ^ _FLIPS
        # A unary digit may change its low bit while the high one is 0, its high bit while the low one is 1.
        low, high = own & _LOW, own >> np.uint64(1) & _LOW
        may = (~high & _LOW) | low << np.uint64(1)
        at, flip = np.nonzero(may[:, None] & _FLIPS)
        points += [own | np.uint64(half << 32), near[at, flip] | np.uint64(half << 32)]
        owners += [fps, fps[at]]
    return np.concatenate(points), np.concatenate(owners)


def _near(a: np.ndarray, b: np.ndarray, radius: int) -> np.ndarray:
    """Which pairs are within the radius; the embedding's bound first, then the bits."""
    close = np.flatnonzero(np.bitwise_count(unary(a) ^ unary(b)) <= radius)
    return close[np.bitwise_count(a[close] ^ b[close]) <= radius]


def _forest(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Edges that connect what the links among `fps` connect."""
    left, counts, edges = fps, unary(fps), []
    while left.size:
        queue, left, counts = [left[0]], left[1:], counts[1:]
        while queue and left.size:
            here = queue.pop()
            close = np.bitwise_count(counts ^ unary(here)) <= radius
            close &= np.bitwise_count(left ^ here) <= radius
            if close.any():
                reached = left[close]
                edges += [(int(here), int(x)) for x in reached]
                queue += list(reached)
                left, counts = left[~close], counts[~close]
    return edges


def _forest_between(a: np.ndarray, b: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """As `_forest`, of the links between two blocks alone."""
    edges, sides = [], [a, b]
    while sides[0].size and sides[1].size:
        queue, sides[0] = [(0, sides[0][0])], sides[0][1:]
        while queue:
            side, here = queue.pop()
            other = sides[1 - side]
            close = np.bitwise_count(other ^ here) <= radius
            if close.any():
                edges += [(int(here), int(x)) for x in other[close]]
                queue += [(1 - side, x) for x in other[close]]
                sides[1 - side] = other[~close]
    return edges


def _signed(values) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def _edges_at_points(radius: int, block: int):
    """Arrow batches of (point, fp), sorted, into (point, a, b): links with a null point, members of crowded points with b null."""

    def groups(batches):
        """Runs of whole points."""
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in common.merged(batches):
            point, fp = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
            cut = int(np.searchsorted(point, point[-1]))
            if cut:
                yield tuple(np.concatenate(x) for x in zip(*held, (point[:cut], fp[:cut]), strict=True))
                held = []
            held.append((point[cut:], fp[cut:]))
        if held:
            yield tuple(np.concatenate(x) for x in zip(*held, strict=True))

    def run(batches):
        for point, fp in groups(batches):
            bounds = np.flatnonzero(np.diff(point, prepend=point[0] - 1))
            sizes = np.diff(np.append(bounds, point.size))
            size_at = np.repeat(sizes, sizes)
            some = (size_at > 1) & (size_at <= SMALL)
            key, few = point[some], fp[some]
            a, b = [], []
            for d in range(1, SMALL):
                same = np.flatnonzero(key[d:] == key[:-d]) if key.size > d else np.zeros(0, int)
                if not same.size:
                    break
                found = same[_near(few[same], few[same + d], radius)]
                a.append(few[found])
                b.append(few[found + d])
            crowded_point, crowded_fp, edges = [], [], []
            for k in np.flatnonzero(sizes > SMALL):
                members = slice(bounds[k], bounds[k] + sizes[k])
                if sizes[k] <= block:
                    edges += _forest(fp[members], radius)
                else:
                    crowded_point.append(point[members])
                    crowded_fp.append(fp[members])
            if edges:
                a.append(np.array([x for x, _ in edges], np.uint64))
                b.append(np.array([y for _, y in edges], np.uint64))
            if a:
                found = np.unique(np.stack([np.concatenate(a), np.concatenate(b)]), axis=1)
                yield pa.RecordBatch.from_arrays([pa.nulls(found.shape[1], pa.int64()), _signed(found[0]), _signed(found[1])], ["point", "a", "b"])
            if crowded_fp:
                which = np.concatenate(crowded_fp)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(crowded_point)), _signed(which), pa.nulls(which.size, pa.int64())], ["point", "a", "b"])

    return run


def links(fps: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """Edges (a, b) between the distinct `fps` (fp) that connect all that links of `radius` bits or fewer connect."""
    if radius > RADIUS:
        raise ValueError(f"the grid covers a radius of {RADIUS}")

    def visit(batches):
        for batch in batches:
            whole = batch.column(0).to_numpy().view(np.uint64)
            for k in range(0, whole.size, 4096):
                points, owners = grid_points(whole[k : k + 4096])
                yield pa.RecordBatch.from_arrays([_signed(points), _signed(owners)], ["point", "fp"])

    at_points = fps.mapInArrow(visit, "point long, fp long")
    met = at_points.repartition("point").sortWithinPartitions("point", "fp").mapInArrow(_edges_at_points(radius, block), "point long, a long, b long")
    met = common.settle(met, "links")
    found, crowded = met.where("point is null").select("a", "b"), met.where("point is not null").select("point", F.col("a").alias("fp"))
    if crowded.isEmpty():
        return found
    # Crowded points: every pair of blocks meets in a group of its own.
    blocks = crowded.groupBy("point").agg(F.ceil(F.count("*") / block).cast("int").alias("n"))
    members = crowded.join(blocks, "point").withColumn("own", F.pmod(F.xxhash64("fp"), F.col("n")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("n") - 1))
    paired = members.select("point", "fp", "own", other.alias("other")).select("point", "fp", "own", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"))

    def compare(table: pa.Table) -> pa.Table:
        fp, own = table.column("fp").to_numpy().view(np.uint64), table.column("own").to_numpy()
        x, y = table.column("x")[0].as_py(), table.column("y")[0].as_py()
        edges = _forest(np.sort(fp), radius) if x == y else _forest_between(np.sort(fp[own == x]), np.sort(fp[own == y]), radius)
        return pa.table({"a": _signed([a for a, _ in edges]), "b": _signed([b for _, b in edges])})

    return found.unionByName(paired.groupBy("point", "x", "y").applyInArrow(compare, "a long, b long"))


def near_duplicates(docs: DataFrame, radius: int = RADIUS, width: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id, the smallest doc_id that links lead to.

    Documents without words (null, empty or blank texts) have fingerprint 0
    and are linked like any other.  Repeated rows each get a row; an empty
    table gives none; columns other than doc_id and text are ignored.
    """
    own = common.settle(fingerprints(docs, width), "fingerprints")
    distinct = own.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = graph.components(links(distinct.select("fp"), radius)).withColumnRenamed("node", "fp")
    classed = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    first = classed.groupBy("root").agg(F.min("least").alias("component_id"))
    # Sizes are those of distinct fingerprints; a fingerprint that very many documents share is split by Spark's skew join.
    ids = classed.join(first, "root").select("fp", "component_id")
    return own.join(ids, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


# -- near copies by similarity -------------------------------------------------

#: Fingerprints of a text, each from hashes of its own.
FINGERPRINTS = 4

_MIX = np.uint64(0xD6E8FEB86659FD93)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_word_hashes: dict[bytes, int] = {}


def _hash_words(words: list[bytes]) -> np.ndarray:
    from xxhash import xxh64_intdigest

    if len(_word_hashes) > 1 << 17:
        _word_hashes.clear()
    for w in words:
        if w not in _word_hashes:
            _word_hashes[w] = xxh64_intdigest(w, SEED)
    return np.fromiter(map(_word_hashes.__getitem__, words), np.uint64, len(words))


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(32)) * _MIX
    x = (x ^ x >> np.uint64(29)) * _MIX
    return x ^ x >> np.uint64(32)


def _words(text: str) -> np.ndarray:
    return _hash_words(text.encode("utf-8", "surrogatepass").lower().split())


def _key(words: np.ndarray) -> int:
    """A hash of all words in their order; 0 of none."""
    if not words.size:
        return 0
    return int(_scramble(np.array([(words * np.cumprod(np.full(words.size, _STEP))).sum(dtype=np.uint64)]))[0])


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """The distinct hashes of all runs of `width` words, sorted; of a shorter text, of the whole."""
    if not words.size:
        return words
    n = max(1, words.size - width + 1)
    out = np.zeros(n, np.uint64)
    for k in range(min(width, words.size)):
        out = out * _STEP + words[k : k + n]
    return np.unique(_scramble(out))


def describe(text: str, width: int) -> tuple[int, list[int], int, np.ndarray]:
    """(key, fingerprints, n, digest) of a text: a hash of all its words, majority bits over its distinct words, and number and digest of its shingles."""
    words = _words(text)
    if not words.size:
        return 0, [0] * FINGERPRINTS, 0, prefixjoin.digest(words)
    distinct, fps = np.unique(words), []
    for k in range(FINGERPRINTS):
        bits = np.unpackbits(_scramble(distinct + np.uint64(k * 0x9E3779B9)).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        fps.append(int(np.packbits(2 * bits.sum(0, dtype=np.int64) > distinct.size, bitorder="little").view("<u8")[0]))
    own = shingles(words, width)
    return _key(words), fps, int(own.size), prefixjoin.digest(own)


def _may_be_similar(pairs: DataFrame, classed: DataFrame, similarity: float) -> DataFrame:
    """Those of `pairs` (x, y) that sizes and digests of `classed` allow."""

    def allow(batches):
        k = len(prefixjoin.DIGEST)
        for batch in batches:
            n_x, n_y, *digests = (c.to_numpy() for c in batch.columns[2:])
            keep = prefixjoin.digests_allow(digests[:k], digests[k:], n_x.astype(np.int64), n_y.astype(np.int64), similarity)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["x", "y"]).filter(pa.array(keep))

    of = lambda side: classed.select(F.col("key").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in ("n", *prefixjoin.DIGEST)])
    met = pairs.join(of("x"), "x").join(of("y"), "y")
    return met.select("x", "y", "n_x", "n_y", *[f"{c}_{side}" for side in "xy" for c in prefixjoin.DIGEST]).mapInArrow(allow, "x long, y long")


def _similar_pairs(docs: DataFrame, classed: DataFrame, pairs: DataFrame, width: int, similarity: float, once: bool) -> DataFrame:
    """(a, b): those of `pairs` (x, y) whose whole shingle sets are similar.

    `classed` (key, least) names a row of each text, `docs` has their hashes,
    and `once` tells that no row is repeated there.
    """
    pairs = common.settle(pairs, "candidates")
    named = pairs.select(F.col("x").alias("key")).unionByName(pairs.select(F.col("y").alias("key"))).distinct().join(classed, "key")
    # Written first, so that Spark knows how few they are before it moves texts.
    named = common.settle(named.select(F.col("least.doc_id").alias("id"), F.col("least.hash").alias("of"), "key"), "named")
    wanted = docs.join(named, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("hash") == F.col("of"))).select("key", "text")

    def sets(batches):
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for k in range(0, len(keys), 500):
                out = []
                for key, text in zip(keys[k : k + 500], texts[k : k + 500], strict=True):
                    words = _words(text)
                    if _key(words) == key % (1 << 64):  # another row may have the same doc_id and hash
                        out.append((key, prefixjoin.packed(shingles(words, width))))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.binary()), strict=True)], ["key", "own"])

    own = wanted.mapInArrow(common.tidily(sets), "key long, own binary")
    own = common.settle(own if once else own.dropDuplicates(["key"]), "sets")

    def decide(batches):
        for batch in batches:
            x, y = ((prefixjoin.unpacked(own.as_buffer()) for own in batch.column(k)) for k in (2, 3))
            keep = pa.array([prefixjoin.similar(a, b, similarity) for a, b in zip(x, y, strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(keep)

    told = pairs.join(own.select(F.col("key").alias("x"), F.col("own").alias("of_x")), "x").join(own.select(F.col("key").alias("y"), F.col("own").alias("of_y")), "y")
    near = common.settle(told.select("x", "y", "of_x", "of_y").mapInArrow(common.tidily(decide), "a long, b long"), "near")
    common.discard(pairs, named, own)
    return near


def near_copies(docs: DataFrame, width: int = 5, similarity: float = 0.8) -> DataFrame:
    """doc_id, hash, component_id and first of every row of `docs`: classes of documents that share `similarity` of their word shingles.

    Most classes come from the grid: candidates are texts of which one of
    FINGERPRINTS fingerprints, taken over distinct words, is within its
    radius.  The grid misses pairs (cut or extended texts, and those that only
    met through a third), so a prefix-filtered join of the shingles then finds
    every pair between different classes that may be similar.  The whole
    shingle sets of both texts decide each candidate.  Texts with the same
    words are equal; all texts without words are (null, empty and blank ones).

    `hash` is the xxhash64 of the text (null: of the empty one), component_id
    the smallest doc_id of the class, null if its rows have none, and `first`
    marks the row of a class with that doc_id, of several the one with the
    smallest hash.  Rows that repeat a doc_id are documents of their own;
    whole repeated rows are all marked.  An empty table gives no rows, other
    columns are ignored.
    """

    def run(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for k in range(0, len(texts), 500):
                key, fps, n, digest = zip(*(describe(x, width) for x in texts[k : k + 500]), strict=True)
                signed = np.array(fps, np.uint64).view(np.int64)
                own = [_signed(key), pa.array(list(signed), pa.list_(pa.int64())), pa.array(n, pa.int32()), *map(pa.array, np.array(digest).T.copy())]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(k, len(key)), batch.column(2).slice(k, len(key)), *own], ["doc_id", "hash", "key", "fps", "n", *prefixjoin.DIGEST])

    def elements(batches):
        for batch in batches:
            for text in batch.column(0).to_pylist():
                words = _words(text)
                yield _key(words), shingles(words, width)

    whole = common.texts(docs).withColumn("hash", F.xxhash64("text"))
    own = common.settle(whole.mapInArrow(common.tidily(run), "doc_id long, hash long, key long, fps array<long>, n int, " + ", ".join(f"{c} long" for c in prefixjoin.DIGEST)), "described")
    once = own.groupBy("doc_id", "hash").count().where("count > 1").isEmpty()
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "hash")
    classed = common.settle(own.groupBy("key").agg(F.min(row).alias("least"), *[F.first(x).alias(x) for x in ("n", "fps", *prefixjoin.DIGEST)]), "distinct")
    at = classed.select("key", F.explode("fps").alias("fp")).distinct()
    speaks = at.groupBy("fp").agg(F.min("key").alias("rep"))
    found = links(speaks.select("fp"))
    between = found.join(speaks.select(F.col("fp").alias("a"), F.col("rep").alias("x")), "a").join(speaks.select(F.col("fp").alias("b"), F.col("rep").alias("y")), "b").select("x", "y")
    equal = at.join(speaks, "fp").select(F.col("rep").alias("x"), F.col("key").alias("y"))
    pairs = between.unionByName(equal).where("x <> y").select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()
    sure = _similar_pairs(whole, classed, _may_be_similar(pairs, classed, similarity), width, similarity, once)
    # What the grid leaves apart meets at the first shingles of both.
    roots = common.settle(graph.components(sure).withColumnRenamed("node", "key"), "classes")
    shared = prefixjoin.meeting(whole.select("text"), elements, similarity)
    met = shared.join(classed.select("key", *prefixjoin.DIGEST), "key").join(roots, "key", "left")
    met = met.select("element", "n", "key", "at", F.coalesce("root", "key").alias("root"), *prefixjoin.DIGEST)
    more = _similar_pairs(whole, classed, prefixjoin.pairs(met, similarity), width, similarity, once)
    common.discard(shared)
    roots = graph.components(sure.unionByName(more)).withColumnRenamed("node", "key")
    classed = classed.select("key", "least").join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
    firsts = classed.groupBy("root").agg(F.min("least").alias("first"))
    told = own.select("doc_id", "hash", "key").join(classed.join(firsts, "root").select("key", "first"), "key")
    mark = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("hash") == F.col("first.hash"))
    return told.select("doc_id", "hash", F.col("first.doc_id").alias("component_id"), mark.alias("first"))
