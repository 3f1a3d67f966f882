"""The Merkle manifest against trees built in memory."""

import random
import zlib
from hashlib import sha256

import pytest

from rulewright.llm import merkle

H = lambda parts: sha256("".join(parts).encode()).hexdigest()


def rise(nodes):
    """All levels of a tree, from its leaves to the single node."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([H(below[k : k + 8]) for k in range(0, len(below), 8)])
    return levels


def siblings(levels, k):
    out = []
    for nodes in levels[:-1]:
        run = nodes[k - k % 8 : k - k % 8 + 8]
        out.append((run[: k % 8], run[k % 8 + 1 :]))
        k //= 8
    return out


def leaf(row):
    return H("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row)


def plainly(rows):
    """Rows of (doc_id, source, lang, n_chars, text) to the columns of the query, in the order of languages and ids."""
    langs = {}
    for row in rows:
        langs.setdefault(row[2], []).append(row)
    trees, order = {}, sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    for lang in order:
        langs[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[lang] = rise([leaf(r) for r in langs[lang]])
    top = rise([trees[lang][-1][0] for lang in order])
    root, out = top[-1][0], []
    for n, lang in enumerate(order):
        for k, row in enumerate(langs[lang]):
            path = siblings(trees[lang], k) + siblings(top, n)
            own = leaf(row)
            touched = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 and row[4] is not None
            at = leaf((*row[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4]))) if touched else own
            for a, b in path:
                at = H([*a, at, *b])
            out.append((row[0], own, trees[lang][-1][0], root, H(x for a, b in path for x in a + b), at, at == root))
    return out


@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 63, 64, 65, 511, 512])
@pytest.mark.parametrize("height", [1, 2])
def test_traversal_gives_each_path_of_a_block(n, height):
    leaves = [H([str(k)]) for k in range(n)]
    levels = merkle.levels_left(n)
    tree = rise(leaves)
    got = list(merkle.traverse([x.encode() for x in leaves], levels, height))
    assert got == [[("".join(a).encode(), "".join(b).encode()) for a, b in siblings(tree, k)] for k in range(n)]
    assert merkle.block_root([x.encode() for x in leaves], levels).decode() == tree[-1][0]


def test_traversal_holds_little(monkeypatch):
    """A subtree forgets what lies below it, so at any time the nodes held are a few runs of each level."""
    most, grow = [0], merkle.Subtree.grow

    def watched(tree, by):
        grow(tree, by)
        most[0] = max(most[0], sum(map(len, tree.kept.values())) + sum(map(len, tree.waiting)))
        return tree

    monkeypatch.setattr(merkle.Subtree, "grow", watched)
    assert sum(1 for _ in merkle.traverse([b"%064d" % k for k in range(4096)], 4)) == 4096
    assert most[0] <= 8 + 8 * 4


@pytest.fixture
def table(spark):
    def make(rows):
        schema = "doc_id long, source string, lang string, n_chars long, text string, tree string, index string, digest string, path string, root string, block long"
        return spark.createDataFrame([(*r, "t", "i", "d", "p", "r", 3) for r in rows], schema)

    return make


def check(df, rows):
    assert sorted(map(tuple, merkle.verify(df).collect()), key=str) == sorted(plainly(rows), key=str)


def test_a_hot_language_over_many_blocks_and_ranges(table):
    chance = random.Random(1)
    rows = [(k * 3, f"s{k % 4}", chance.choices(["en", "de", "fr", None, "é", "Z"], [80, 5, 5, 3, 3, 1])[0], k, f"Text {k} WITH Ünïcode " * (k % 5)) for k in range(5000)]
    chance.shuffle(rows)
    check(table(rows).repartition(7), rows)


def test_nulls_ties_repeated_rows_and_long_texts(table):
    rows = [(1, None, "en", None, None), (None, None, None, None, None), (None, "s", "en", 1, "A"), (None, "s", "en", 1, "A"), (2, "s", "en", 0, ""), (2, "s", "en", 1, "B"), (3, "s", None, 5, "UP" * 200_000), *[(7, "s", "en", 3, "Abc")] * 20]
    check(table(rows), rows)


def test_one_row_one_language_and_none(table):
    only = [(9, "s", "en", 3, "Abc")]
    check(table(only), only)
    many = [(k, "s", "en", 3, f"T{k}") for k in range(30)]
    check(table(many), many)
    each = [(k, "s", f"l{k}", 3, f"T{k}") for k in range(20)]
    check(table(each), each)
    assert merkle.verify(table(only).limit(0)).count() == 0


def test_a_changed_sibling_is_found(spark, table):
    from pyspark.sql import functions as F

    rows = [(k, "s", "en", 3, f"T{k}") for k in range(100)]
    found = merkle.manifest(table(rows)).where("index = 50")
    bad = F.transform("path", lambda s: F.struct(F.translate(s["left"], "0123456789abcdef", "123456789abcdef0").alias("left"), s["right"].alias("right")))
    row = found.select("root", merkle.fold(F.col("leaf"), F.col("path")).alias("good"), merkle.fold(F.col("leaf"), bad).alias("bad")).first()
    assert row["root"] == row["good"] != row["bad"]
