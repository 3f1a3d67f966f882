"""A Merkle manifest of a dataset, with an authentication path for every row.

Rows are leaves.  Each language is a tree of its own, in which every eight
nodes in a row become one, and the roots of the languages are the leaves of a
last tree, whose root names the whole dataset.

Leaves are numbered along (lang, doc_id) by ranges, so no task sees a language,
and cut into aligned blocks of 512.  The roots of the blocks are the leaves of
the next layer, and so on until each tree has one node; layers shrink 512-fold.
Paths then come down again: a block meets the path of its root and is gone
through once by fractal traversal, which holds one subtree of each of its levels
and grows the next one beside it by a leaf a step.  What is held at a time does
not depend on the size of the dataset, nor on how many rows a language has.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common, running

#: Children of a node.
ARITY = 8
#: Levels of a block, and of each of the subtrees that the traversal stacks.
BLOCK_LEVELS, SUBTREE_LEVELS = 3, 1
BLOCK = ARITY**BLOCK_LEVELS
#: Bytes of input a range of leaves, and ranges at most (beyond that they grow: narrow rows, sorted by Spark, which spills).
RANGE_BYTES, MOST_RANGES = 128 << 20, 20_000

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_PATH = "array<struct<left:string,right:string>>"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


# -- hashes ----------------------------------------------------------------------------------------------------


def leaf(*values: Column) -> Column:
    """The hash of a row: each value `-` if null, else its length in UTF-8 bytes, a colon and itself; integers in decimal."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]), 256)


def fold(node: Column, path: Column) -> Column:
    """The root that a node leads to along a path."""
    return F.aggregate(path, node, lambda at, step: F.sha2(F.concat(step["left"], at, step["right"]), 256))


def path_digest(path: Column) -> Column:
    """The hash of all siblings of a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""), 256)


def _parent(children: list[bytes]) -> bytes:
    return sha256(b"".join(children)).hexdigest().encode()


# -- one block -------------------------------------------------------------------------------------------------


class Subtree:
    """What a subtree with its bottom at level `low` and its root at level `high` has over leaves first..last-1, built a leaf at a time.

    `kept` holds its nodes by level; of what lies below `low` only the children
    that still wait for their parent are held.
    """

    def __init__(self, leaves, first: int, last: int, low: int, high: int) -> None:
        self.leaves, self.first, self.next, self.last, self.high = leaves, first, first, last, high
        self.kept: dict[int, list[bytes]] = {t: [] for t in range(low, high)}
        self.waiting: list[list[bytes]] = [[] for _ in range(high)]
        self.root: bytes | None = None

    def grow(self, by: int) -> Subtree:
        for k in range(self.next, min(self.next + by, self.last)):
            self._add(0, self.leaves[k])
            self.next = k + 1
        if self.next == self.last and self.root is None:
            for level in range(self.high):  # the last run of a level may have fewer children, even one
                if self.waiting[level]:
                    self._close(level)
        return self

    def _add(self, level: int, node: bytes) -> None:
        if level in self.kept:
            self.kept[level].append(node)
        if level == self.high:
            self.root = node
            return
        self.waiting[level].append(node)
        if len(self.waiting[level]) == ARITY:
            self._close(level)

    def _close(self, level: int) -> None:
        node, self.waiting[level] = _parent(self.waiting[level]), []
        self._add(level + 1, node)

    def siblings(self, k: int) -> Iterator[tuple[bytes, bytes]]:
        """(left, right) siblings of leaf k's ancestors in this subtree, from below."""
        for level, nodes in self.kept.items():
            own = k // ARITY**level - self.first // ARITY**level
            run, place = nodes[own - own % ARITY : own - own % ARITY + ARITY], own % ARITY
            yield b"".join(run[:place]), b"".join(run[place + 1 :])


def block_root(leaves, levels: int) -> bytes:
    return Subtree(leaves, 0, len(leaves), levels, levels).grow(len(leaves)).root


def traverse(leaves, levels: int, height: int = SUBTREE_LEVELS) -> Iterator[list[tuple[bytes, bytes]]]:
    """The path of each leaf to the root of its block, in order (fractal traversal).

    Of every `height` levels there is an existing subtree, the one above the
    current leaf, and a desired one, that right of it.  Each output grows every
    desired subtree by one leaf, so it is whole when the existing one has been
    gone through and takes its place.
    """
    spans = [(low, min(low + height, levels)) for low in range(0, levels, height)]

    def begun(low: int, high: int, number: int) -> Subtree | None:
        first = number * ARITY**high
        return Subtree(leaves, first, min(first + ARITY**high, len(leaves)), low, high) if first < len(leaves) else None

    existing = [begun(*span, 0).grow(len(leaves)) for span in spans]
    desired = [begun(*span, 1) for span in spans]
    for k in range(len(leaves)):
        yield [pair for tree in existing for pair in tree.siblings(k)]
        for n, (low, high) in enumerate(spans):
            if desired[n] is not None:
                desired[n].grow(1)
            if (k + 1) % ARITY**high == 0 and desired[n] is not None:
                existing[n], desired[n] = desired[n], begun(low, high, (k + 1) // ARITY**high + 1)


def levels_left(n: int) -> int:
    """Levels from a row of n nodes up to a single one."""
    levels = 0
    while n > 1:
        n, levels = -(-n // ARITY), levels + 1
    return levels


# -- layers ----------------------------------------------------------------------------------------------------


def _nodes(table: pa.Table) -> tuple[pa.Table, list[bytes], int]:
    """The rows of a block in order, their digests in hexadecimal, and the levels to go in this layer."""
    table = table.sort_by("index")
    return table, [d.hex().encode() for d in table["digest"].to_pylist()], min(BLOCK_LEVELS, levels_left(table["n"][0].as_py()))


def _root(table: pa.Table) -> pa.Table:
    table, digests, levels = _nodes(table)
    n, at = table["n"][0].as_py(), table["index"][0].as_py()
    return pa.table({"tree": table["tree"][:1], "index": pa.array([at // BLOCK], pa.int64()), "n": pa.array([-(-n // BLOCK)], pa.int64()), "digest": pa.array([bytes.fromhex(block_root(digests, levels).decode())], pa.binary())})


def _blocks(nodes: DataFrame):
    return nodes.withColumn("block", F.floor(F.col("index") / BLOCK)).groupBy("tree", "block")


def layers(nodes: DataFrame) -> list[DataFrame]:
    """`nodes` (tree, index, n, digest), n being how many its tree has, and the layers over them, to one node a tree."""
    out = [nodes]
    while not out[-1].where("n > 1").isEmpty():
        roots = _blocks(out[-1].select("tree", "index", "n", "digest")).applyInArrow(_root, "tree long, index long, n long, digest binary")
        out.append(common.settle(roots, "roots"))
    return out


def _down(left: pa.Table, right: pa.Table) -> pa.Table:
    """The rows of a block with their whole paths: those in the block, then that of its root."""
    left, digests, levels = _nodes(left)
    above = [(s["left"], s["right"]) for s in right["path"][0].as_py()]
    lefts, rights, ends = [], [], [0]
    for path in traverse(digests, levels):
        lefts += [a.decode() for a, _ in path] + [a for a, _ in above]
        rights += [b.decode() for _, b in path] + [b for _, b in above]
        ends.append(len(lefts))
    steps = pa.StructArray.from_arrays([pa.array(lefts, pa.string()), pa.array(rights, pa.string())], ["left", "right"])
    out = left.append_column("path", pa.ListArray.from_arrays(pa.array(ends, pa.int32()), steps))
    for name in ("subroot", "root"):
        out = out.append_column(name, pa.array([right[name][0].as_py()] * len(left), pa.string()))
    return out.drop_columns(["block"])


def descend(above: list[DataFrame], crowns: DataFrame) -> DataFrame:
    """The lowest of the layers with `path`, `subroot` and `root`, given those of the highest (tree, index, path, subroot, root)."""
    for nodes in reversed(above[:-1]):
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in nodes.schema) + f", path {_PATH}, subroot string, root string"
        upper = crowns.select("tree", F.col("index").alias("block"), "path", "subroot", "root").groupBy("tree", "block")
        crowns = _blocks(nodes).cogroup(upper).applyInArrow(_down, fields)
        if nodes is not above[0]:
            crowns = common.settle(crowns, "paths")
    return crowns


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _numbered_leaves(docs: DataFrame) -> DataFrame:
    """(tree, index, n, doc_id, digest, tampered): the place of each row in its language, and of the language among all."""
    own = [F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), F.col("text")]
    lowered = F.translate("text", _UPPER, _LOWER)
    changed = (common.remainder("doc_id", 3) == 0) & (lowered != F.col("text"))
    rows = docs.select("doc_id", "lang", F.unhex(leaf(*own)).alias("digest"), F.when(changed, F.unhex(leaf(*own[:4], lowered))).alias("tampered"))
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), common.shards(docs, RANGE_BYTES, MOST_RANGES))
    dealt = running.placed(rows, F.col("lang").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), F.col("digest").asc(), parts=parts)
    totals = dealt.groupBy("_part", "lang").agg(F.count("*").alias("_n"), F.min("_place").alias("_first"))  # a row for each range and language in it
    langs = running.numbered(totals.groupBy("lang").agg(F.sum("_n").alias("n")), F.col("lang").asc_nulls_first(), name="tree").withColumnRenamed("lang", "of")
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("lang").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = totals.withColumn("start", before - F.col("_first")).join(langs, F.col("lang").eqNullSafe(F.col("of")))
    # Settled, so that Spark sees how small it is.
    starts = common.settle(starts.select(F.col("_part").alias("part"), "of", "start", "tree", "n"), "starts")
    placed = dealt.join(starts, (F.col("_part") == F.col("part")) & F.col("lang").eqNullSafe(F.col("of")))
    return placed.select("tree", (F.col("start") + F.col("_place")).alias("index"), "n", "doc_id", "digest", "tampered")


def manifest(docs: DataFrame) -> DataFrame:
    """(doc_id, tree, index, leaf, tampered, path, subroot, root) of every row of `docs` (doc_id, source, lang, n_chars, text).

    `tree` is the place of the row's language among all, null first, then by
    UTF-8 bytes; `index` that of the row in its language, by doc_id, null first,
    equal ids by their leaf.  `path` lists, from the leaf to the root of the
    dataset, what stands left and right of each node among its parent's children
    (hexadecimal digests, joined).  `tampered` is the leaf of the row with A-Z of
    its text in lower case, where crc32 of the id is a multiple of three and
    that changes the text, else null.

    Any column may be null; an empty text is not a null one.  Rows that are the
    same in all fields are leaves of their own next to each other.  A language
    of one row has its leaf as subroot, a table of one language its subroot as
    root; an empty table gives no rows.  Other columns are left behind.
    """
    common.small_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *[F.col(f).cast("string").alias(f) for f in FIELDS[1:]])
    langs = layers(_numbered_leaves(docs))
    subroots = langs[-1]
    if len(langs) == 1:
        subroots = common.settle(subroots.select("tree", "index", "n", "digest"), "roots")
    top = layers(subroots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("index"), F.lit(subroots.count()).cast("long").alias("n"), "digest"))
    none = F.lit(None).cast("string")
    crown = top[-1].select("tree", "index", F.expr(f"cast(array() as {_PATH})").alias("path"), none.alias("subroot"), _hex(F.col("digest")).alias("root"))
    crowns = descend(top, crown).select(F.col("index").alias("of"), "path", "root")
    crowns = common.settle(subroots.join(crowns, F.col("tree") == F.col("of")).select("tree", F.lit(0).cast("long").alias("index"), "path", _hex(F.col("digest")).alias("subroot"), "root"), "crowns")
    if len(langs) == 1:
        found = langs[0].join(crowns.select(F.col("tree").alias("of"), "path", "subroot", "root"), F.col("tree") == F.col("of"))
    else:
        found = descend(langs, crowns)
    return found.select("doc_id", "tree", "index", _hex(F.col("digest")).alias("leaf"), _hex(F.col("tampered")).alias("tampered"), "path", "subroot", "root")


def verify(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified): the digest of each path, and where it leads from the tampered leaf."""
    found = manifest(docs).withColumn("folded_root", fold(F.coalesce("tampered", "leaf"), F.col("path")))
    return found.select("doc_id", "leaf", "subroot", "root", path_digest(F.col("path")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
