"""Quantified rules over entries that are rows of their own.

``fun i => i.lots.all (fun s => i.payments.any (fun p => p.lot == s.id && p.price < s.price))``
asks the same of tables `lots` and `payments` as of two lists within a filing,
but no row holds a filing's entries.  A quantifier is decorrelated: what its
body says of the entry alone is a filter, equalities with outer variables
become join keys beside the filing's, one comparison with outer variables
becomes the least or greatest value for each key, and only what compares more
than one value is left to the condition of a semi join.  So each quantifier
costs an aggregate of its table, with partial sums, and a join against one row
for each key; no pairs of entries are made.

`all` is the negation of `any` of the negation; negations are pushed down to
comparisons, disjunctions are split, and quantifiers inside a body that speak
of its entry and the filing alone are worked out on the entries first.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .language import _LEVELS, _MEMBERS, _SQL, Unsupported, _tokens

# -- the tree of a predicate -----------------------------------------------------------------------------------


class Value(NamedTuple):
    """A scalar: Spark SQL over columns `var.member`, and the variables in it."""

    sql: str
    of: frozenset[str]


class Compare(NamedTuple):
    op: str
    left: Value
    right: Value


class Truth(NamedTuple):
    value: Value


class Both(NamedTuple):
    parts: tuple


class Either(NamedTuple):
    parts: tuple


class Exists(NamedTuple):
    """Whether an entry of `relation` makes `body` true."""

    relation: str
    var: str
    body: object
    negated: bool = False


@dataclass(frozen=True)
class Relation:
    """Entries of filings as rows: `rows` has the filing's key in `key`, and the members of an entry in other columns; numbers in `value`."""

    rows: DataFrame
    key: str = "issuer_id"


_NEGATED = {"==": "!=", "!=": "==", "<": ">=", ">=": "<", ">": "<=", "<=": ">"}
_MIRRORED = {"<": ">", ">": "<", "<=": ">=", ">=": "<=", "==": "==", "!=": "!="}


def _col(var: str, member: str) -> str:
    return f"`{var}.{member}`"


class _Reader:
    """Reads the part of the predicate language that makes sense of rows; raises `Unsupported` for the rest."""

    def __init__(self, tokens: list[str], root: str, fields: set[str], relations: dict[str, set[str]]) -> None:
        self.tokens, self.at, self.root, self.fields, self.relations = tokens, 0, root, fields, relations
        self.vars: dict[str, str | None] = {root: None}
        self.fresh = 0

    def peek(self, k: int = 0) -> str:
        return self.tokens[self.at + k] if self.at + k < len(self.tokens) else ""

    def take(self, wanted: str | None = None) -> str:
        got = self.peek()
        if not got or wanted and got != wanted:
            raise Unsupported(f"expected {wanted or 'more'}, got {got or 'the end'}")
        self.at += 1
        return got

    def expression(self, level: int = 0):
        if level == len(_LEVELS):
            return self.unary()
        left = self.expression(level + 1)
        while self.peek() in _LEVELS[level]:
            op, right = self.take(), self.expression(level + 1)
            if op in ("&&", "||"):
                left = (Both if op == "&&" else Either)((_truth(left), _truth(right)))
            elif op in _NEGATED:
                left = Compare(op, _value(left), _value(right))
            else:
                a, b = _value(left), _value(right)
                sql = f"greatest({a.sql} - {b.sql}, 0)" if op == "-" else f"({a.sql} {'div' if op == '/' else op} {b.sql})"
                left = Value(sql, a.of | b.of)
        return left

    def unary(self):
        if self.peek() == "!":
            self.take()
            return negated(_truth(self.unary()))
        if self.peek() == "(":
            self.take()
            inner = self.expression()
            self.take(")")
            return inner
        got = self.take()
        if got.isdigit():
            return Value(got, frozenset())
        if got[0] == '"':
            return Value("'" + got[1:-1].replace("\\", "\\\\").replace("'", "\\'") + "'", frozenset())
        if got in ("true", "True", "false", "False"):
            return Truth(Value(got.lower(), frozenset()))
        return self.path(got)

    def path(self, got: str):
        head, *members = got.split(".")
        if head == self.root and members and members[0] in self.relations:
            return self.quantified(members[0], members[1:])
        if head not in self.vars:
            raise Unsupported(f"unknown name {head}")
        relation = self.vars[head]
        member = members.pop(0) if members else "value"
        known = self.fields if relation is None else self.relations[relation]
        if member not in known:
            raise Unsupported(f"unknown field {member}")
        if members:
            raise Unsupported(f"unknown member {members[0]}")
        return Value(_col(head, member), frozenset({head}))

    def quantified(self, relation: str, members: list[str]):
        name = _MEMBERS.get(members[0], members[0]) if members else ""
        if len(members) > 1:
            raise Unsupported(f"unknown member {members[1]}")
        everything = Truth(Value("true", frozenset()))
        if name == "isEmpty":
            return Exists(relation, self.new(relation), everything, True)
        if name == "contains":
            item, var = _value(self.unary()), self.new(relation)
            return Exists(relation, var, Compare("==", Value(_col(var, "value"), frozenset({var})), item))
        if name not in ("any", "all"):
            raise Unsupported(f"{name or 'a list as a value'} of rows")
        self.take("(")
        before = dict(self.vars)
        if self.peek() == "fun":
            self.take()
            own = self.take()
            self.take("," if self.peek() == "," else "=>")
            if own in self.vars:
                raise Unsupported(f"{own} is named twice")
        else:
            raise Unsupported("a function without a variable")
        self.vars[own] = relation
        body = _truth(self.expression())
        self.take(")")
        self.vars = before
        return Exists(relation, own, negated(body), True) if name == "all" else Exists(relation, own, body)

    def new(self, relation: str) -> str:
        self.fresh += 1
        return f"_{relation}{self.fresh}"


def _truth(node):
    return Truth(node) if isinstance(node, Value) else node


def _value(node) -> Value:
    if isinstance(node, Truth):
        return node.value
    if not isinstance(node, Value):
        raise Unsupported("a comparison of truth values of rows")
    return node


def negated(node):
    """The negation, with `!` at comparisons and quantifiers only; nulls have been filled, so each is true or false."""
    if isinstance(node, Compare):
        return Compare(_NEGATED[node.op], node.left, node.right)
    if isinstance(node, Truth):
        return Truth(Value(f"(NOT {node.value.sql})", node.value.of))
    if isinstance(node, Exists):
        return node._replace(negated=not node.negated)
    return (Either if isinstance(node, Both) else Both)(tuple(negated(p) for p in node.parts))


def read(source: str, fields: set[str], relations: dict[str, set[str]]):
    """(name of the filing's variable, tree) of ``fun i => …``; `relations` names the members that each relation's entries have."""
    tokens = _tokens(source)
    if tokens[:1] != ["fun"] or "=>" not in tokens[:3] or len(tokens) < 4:
        raise Unsupported("not a function of a filing")
    reader = _Reader(tokens[3:], tokens[1], fields, relations)
    tree = _truth(reader.expression())
    if reader.at != len(reader.tokens):
        raise Unsupported(f"left over: {reader.peek()}")
    return tokens[1], tree


def disjuncts(node) -> list[list]:
    """A body as an `or` of `and`s; quantifiers stay whole."""
    if isinstance(node, Either):
        return [d for p in node.parts for d in disjuncts(p)]
    if isinstance(node, Both):
        out = [[]]
        for p in node.parts:
            out = [a + b for a in out for b in disjuncts(p)]
        return out
    return [[node]]


def free(node) -> frozenset[str]:
    """Variables of a tree that it doesn't bind."""
    if isinstance(node, Compare):
        return node.left.of | node.right.of
    if isinstance(node, Truth):
        return node.value.of
    if isinstance(node, Exists):
        return free(node.body) - {node.var}
    return frozenset().union(*(free(p) for p in node.parts))


# -- joins -----------------------------------------------------------------------------------------------------


class _Builder:
    def __init__(self, filings: DataFrame, relations: dict[str, Relation], key: str, root: str) -> None:
        self.relations, self.root, self.fresh = relations, root, 0
        self.filings = filings.select(F.col(key).alias("_key"), *[F.col(f"`{c}`").alias(f"{root}.{c}") for c in filings.columns])

    def flag(self) -> str:
        self.fresh += 1
        return f"_flag{self.fresh}"

    def truth(self, rows: DataFrame, node, own: frozenset[str]) -> tuple[DataFrame, Column]:
        """`rows`, with the columns that it takes added, and the truth of `node` as a column of them; `own` are the variables that rows have columns of."""
        if isinstance(node, Truth):
            return rows, F.expr(node.value.sql)
        if isinstance(node, Compare):
            return rows, F.expr(f"({node.left.sql} {_SQL.get(node.op, node.op)} {node.right.sql})")
        if isinstance(node, Exists):
            rows, found = self.exists(rows, node, own)
            return rows, ~found if node.negated else found
        out = None
        for part in node.parts:
            rows, truth = self.truth(rows, part, own)
            out = truth if out is None else out & truth if isinstance(node, Both) else out | truth
        return rows, out

    def exists(self, rows: DataFrame, node: Exists, own: frozenset[str]) -> tuple[DataFrame, Column]:
        found = None
        for conjuncts in disjuncts(node.body):
            rows, here = self.one(rows, node, conjuncts, own)
            found = here if found is None else found | here
        return rows, found

    def entries(self, node: Exists, with_filing: bool) -> DataFrame:
        relation = self.relations[node.relation]
        rows = relation.rows.select(F.col(f"`{relation.key}`").alias("_key"), *[F.col(f"`{c}`").alias(f"{node.var}.{c}") for c in relation.rows.columns if c != relation.key])
        return rows.join(self.filings, "_key") if with_filing else rows

    def one(self, rows: DataFrame, node: Exists, conjuncts: list, own: frozenset[str]) -> tuple[DataFrame, Column]:
        var = frozenset({node.var})
        inner, equal, ranges, outer = [], [], [], []
        for c in conjuncts:
            names = free(c)
            if not names & var:
                outer.append(c)
            elif names <= var:
                inner.append(c)
            elif isinstance(c, Compare) and c.left.of == var and not c.right.of & var:
                (equal if c.op == "==" else ranges).append(c)
            elif isinstance(c, Compare) and c.right.of == var and not c.left.of & var:
                (equal if c.op == "==" else ranges).append(Compare(_MIRRORED[c.op], c.right, c.left))
            elif names <= var | {self.root}:
                inner.append(c)
            else:
                raise Unsupported(f"a condition on {', '.join(sorted(names))} that is no comparison of {node.var} with the others")
        entries = self.entries(node, any(self.root in free(c) for c in inner))
        for c in inner:
            entries, truth = self.truth(entries, c, var | {self.root})
            entries = entries.where(truth)
        rows, found = self.matched(rows, entries, equal, ranges)
        for c in outer:
            rows, truth = self.truth(rows, c, own)
            found = found & truth
        return rows, found

    def matched(self, rows: DataFrame, entries: DataFrame, equal: list[Compare], ranges: list[Compare]) -> tuple[DataFrame, Column]:
        """Whether there is an entry of the same filing for which all comparisons hold; left sides are the entry's."""
        keys = [f"_k{n}" for n in range(len(equal))]
        flag, held = self.flag(), [f"_r{n}" for n in range(len(ranges))]
        entries = entries.select("_key", *[F.expr(c.left.sql).alias(k) for c, k in zip([*equal, *ranges], [*keys, *held], strict=True)])
        rows = rows.withColumns({k: F.expr(c.right.sql) for c, k in zip([*equal, *ranges], [*keys, *held], strict=True)})
        if len(ranges) > 1:
            found = self.met(rows, entries, keys, ranges).withColumn(flag, F.lit(True))
            keys = [*keys, *held]
        elif ranges:
            found = entries.groupBy("_key", *keys).agg(F.min("_r0").alias(f"{flag}_min"), F.max("_r0").alias(f"{flag}_max"))
        else:
            found = entries.select("_key", *keys).distinct().withColumn(flag, F.lit(True))
        found = found.withColumnsRenamed({k: f"_of{k}" for k in ["_key", *keys]})
        on = F.col("_key") == F.col("_of_key")
        for k in keys:  # values of options may be null, and two nulls are equal
            on = on & F.col(k).eqNullSafe(F.col(f"_of{k}"))
        out = rows.join(found, on, "left")
        if len(ranges) == 1:
            least, most, to = F.col(f"{flag}_min"), F.col(f"{flag}_max"), F.col("_r0")
            either = least.isNotNull() & (~least.eqNullSafe(to) | ~most.eqNullSafe(to))
            out = out.withColumn(flag, {"!=": either, "<": least < to, "<=": least <= to, ">": most > to, ">=": most >= to}[ranges[0].op])
        return out.select(*[f"`{c}`" for c in rows.columns if c not in (*keys, *held)], F.coalesce(F.col(flag), F.lit(False)).alias(flag)), F.col(flag)

    def met(self, rows: DataFrame, entries: DataFrame, keys: list[str], ranges: list[Compare]) -> DataFrame:
        """Of two comparisons or more: the different outer values that meet an entry, by a semi join on the keys with the comparisons as its condition."""
        held = [f"_r{n}" for n in range(len(ranges))]
        entries = entries.withColumnsRenamed({k: f"_of{k}" for k in ["_key", *keys, *held]})
        on = F.col("_key") == F.col("_of_key")
        for k in keys:
            on = on & F.col(k).eqNullSafe(F.col(f"_of{k}"))
        for k, c in zip(held, ranges, strict=True):
            at, to = F.col(f"_of{k}"), F.col(k)
            on = on & {"<": at < to, "<=": at <= to, ">": at > to, ">=": at >= to, "!=": ~at.eqNullSafe(to)}[c.op]
        return rows.select("_key", *keys, *held).distinct().join(entries, on, "left_semi")


def evaluate(filings: DataFrame, relations: dict[str, Relation], rules: dict[str, str], key: str = "issuer_id") -> DataFrame:
    """key and a Boolean column for each of `rules` (name to ``fun i => …``): one row a filing, as many as `filings` has.

    Nulls in fields and members must have been filled, as `Schema.normalise`
    does, but for options, where two nulls are equal.  A filing without entries
    makes every `all` true and every `any` false; entries of no filing, or of a
    null one, change nothing; repeated entries and filings do no harm.
    """
    fields = set(filings.columns)
    members = {n: {c for c in r.rows.columns if c != r.key} for n, r in relations.items()}
    roots = {n: read(source, fields, members) for n, source in rules.items()}
    out = filings.select(key, *[c for c in filings.columns if c != key])
    root = "_filing"
    builder = _Builder(out, relations, key, root)
    rows, flags = builder.filings, {}
    for name, (var, tree) in roots.items():
        rows, truth = builder.truth(rows, _renamed(tree, var, root), frozenset({root}))
        rows = rows.withColumn(f"_rule {name}", truth)
        flags[name] = F.col(f"`_rule {name}`").alias(name)
        rows = rows.select("_key", *[f"`{root}.{c}`" for c in filings.columns], *[f"`_rule {n}`" for n in flags])
    return rows.select(F.col("_key").alias(key), *flags.values())


def _renamed(node, var: str, to: str):
    """A tree whose filing is named `to`."""
    value = lambda v: Value(v.sql.replace(f"`{var}.", f"`{to}."), frozenset(to if x == var else x for x in v.of))
    if isinstance(node, Compare):
        return Compare(node.op, value(node.left), value(node.right))
    if isinstance(node, Truth):
        return Truth(value(node.value))
    if isinstance(node, Exists):
        return node._replace(body=_renamed(node.body, var, to))
    return type(node)(tuple(_renamed(p, var, to) for p in node.parts))
