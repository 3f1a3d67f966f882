"""The predicate language of rule files, compiled to Spark SQL.

A predicate is a function of one filing, ``fun i => <expression>``, over its
fields.  Literals, comparison, Boolean and whole-number operators (division
rounds down), list members (``length``, ``sum``, ``isEmpty``, ``all``, ``any``,
``contains``, ``filter``, ``map``, ``find?``, ``partition``, ``zip``,
``zipIdx``), options (``isSome``, ``isNone``, ``getD``), local ``let`` names and ``if`` are understood.  What isn't, or
names an unknown field, raises `Unsupported`; the linter makes a stub of it.
"""

from __future__ import annotations

import re

from .schema import Schema


class Unsupported(ValueError):
    """A predicate that can't be evaluated."""


_TOKEN = re.compile(r"""\s*(?:(?P<num>\d+)|(?P<str>"(?:[^"\\]|\\.)*")|(?P<name>[A-Za-z_][A-Za-z0-9_'?!]*(?:\.[A-Za-z_][A-Za-z0-9_'?!]*|\.\d+)*)|(?P<op>:=|=>|==|!=|<=|>=|&&|\|\||\.[A-Za-z_]\w*\??|\.\d+|[≥≤≠∧∨¬·λ!<>=+\-*/(),.;|&\[\]]))""")
_SAME = {"≥": ">=", "≤": "<=", "≠": "!=", "∧": "&&", "∨": "||", "¬": "!", "=": "==", "&": "&&", "and": "&&", "or": "||", "not": "!", "λ": "fun"}
#: An option may be null, and two nulls are equal.
_SQL = {"&&": "AND", "||": "OR", "==": "<=>", "!=": "IS DISTINCT FROM"}
#: Loosest first.
_LEVELS = (("||",), ("&&",), ("==", "!=", "<", ">", "<=", ">="), ("+", "-"), ("*", "/"))


def _tokens(text: str) -> list[str]:
    out, at, text = [], 0, text.strip()
    while at < len(text):
        m = _TOKEN.match(text, at)
        if not m:
            raise Unsupported(f"unexpected {text[at : at + 12]!r}")
        out.append(_SAME.get(m[0].strip(), m[0].strip()))
        at = m.end()
    return out


#: Other names of members.
_MEMBERS = {"exists": "any", "forall": "all", "isDefined": "isSome"}


class _Parser:
    def __init__(self, tokens: list[str], schema: Schema, issuer: str) -> None:
        self.tokens, self.at, self.issuer = tokens, 0, issuer
        self.fields = {f.name for f in schema.fields}
        self.scope: dict[str, str] = {}
        self.used: set[str] = set()
        self.fresh = 0

    def peek(self) -> str:
        return self.tokens[self.at] if self.at < len(self.tokens) else ""

    def take(self, wanted: str | None = None) -> str:
        got = self.peek()
        if not got or wanted and got != wanted:
            raise Unsupported(f"expected {wanted or 'more'}, got {got or 'the end'}")
        self.at += 1
        return got

    def expression(self, level: int = 0) -> str:
        if level == 0 and self.peek() == "let":
            self.take()
            name = self.take()
            self.take(":=" if self.peek() == ":=" else "==")
            self.scope[name] = f"({self.expression()})"
            if self.peek() in (";", "in"):
                self.take()
            return self.expression()
        if level == 0 and self.peek() == "match":
            return self.match()
        if level == 0 and self.peek() == "if":
            self.take()
            when = self.expression()
            self.take("then")
            yes = self.expression()
            self.take("else")
            return f"CASE WHEN {when} THEN {yes} ELSE {self.expression()} END"
        if level == len(_LEVELS):
            return self.unary()
        left = self.expression(level + 1)
        while self.peek() in _LEVELS[level]:
            op = self.take()
            right = self.expression(level + 1)
            if op == "-":  # whole numbers stop at zero
                left = f"greatest({left} - {right}, 0)"
            else:
                left = f"({left} {'div' if op == '/' else _SQL.get(op, op)} {right})"
        return left

    def match(self) -> str:
        """``match e with some k => a | _ => b``; k is a number, or a name for the value."""
        self.take()
        value = self.expression(1)
        self.take("with")
        if self.peek() == "|":
            self.take()
        self.take("some")
        shape, before = self.take(), dict(self.scope)
        when = f"{value} <=> {shape}" if shape.isdigit() else f"{value} IS NOT NULL"
        self.scope[shape] = value
        self.take("=>")
        yes = self.expression()
        self.scope = before
        self.take("|")
        if self.peek() == "|":
            self.take()
        if self.take() not in ("_", "none"):
            raise Unsupported("a match of other than an option")
        self.take("=>")
        return f"CASE WHEN {when} THEN {yes} ELSE {self.expression()} END"

    def unary(self) -> str:
        if self.peek() == "!":
            self.take()
            return f"(NOT {self.unary()})"
        out = self.primary()
        while self.peek().startswith(".") and len(self.peek()) > 1:
            out = self.member(out, self.take()[1:])
        return out

    def primary(self) -> str:
        got = self.take()
        if got == "(":
            out = self.expression()
            self.take(")")
            return f"({out})"
        if got == "·" and "·" in self.scope:
            return self.scope["·"]
        if got.isdigit():
            return got
        if got[0] == '"':
            return "'" + got[1:-1].replace("\\", "\\\\").replace("'", "\\'") + "'"
        if got in ("true", "True", "false", "False"):
            return got.lower()
        if got in ("allGeNat", "lengthIs"):
            listed, n = self.argument(), self.argument()
            return f"(size({listed}) = {n})" if got == "lengthIs" else f"forall({listed}, x -> x >= {n})"
        if got == "List.range":
            n = self.argument()
            return f"filter(sequence(0L, greatest({n}, 1L) - 1), k -> k < {n})"
        if got == "some":
            return self.argument()
        if got == "none":
            return "NULL"
        if got in ("fst", "snd"):
            return self.member(self.argument(), got)
        head, *members = got.split(".")
        if head == self.issuer and members:
            if members[0] not in self.fields:
                raise Unsupported(f"unknown field {members[0]}")
            self.used.add(members[0])
            out = members.pop(0)
        elif head in self.scope:
            out = self.scope[head]
        else:
            raise Unsupported(f"unknown name {head}")
        for m in members:
            out = self.member(out, m)
        return out

    def argument(self) -> str:
        """One operand that follows by juxtaposition."""
        return self.primary()

    def function(self) -> tuple[str, str]:
        """(variable, body) of ``(fun x => …)`` or ``(· ≥ 1)``."""
        self.take("(")
        self.fresh += 1
        name, before = f"v{self.fresh}", dict(self.scope)
        if self.peek() == "fun":
            self.take()
            self.scope[self.take()] = name
            self.take("," if self.peek() == "," else "=>")
        else:
            self.scope["·"] = name
        body = self.expression()
        self.take(")")
        self.scope = before
        return name, body

    def member(self, of: str, name: str) -> str:
        name = _MEMBERS.get(name, name)
        if name in ("get", "get!", "some"):  # of an option: the value itself
            return of
        if name == "last":
            return f"try_element_at({of}, -1)"
        if name in ("length", "size"):
            return f"size({of})"
        if name == "isEmpty":
            return f"(size({of}) = 0)"
        if name == "sum":
            return f"aggregate({of}, 0L, (a, x) -> a + x)"
        if name in ("all", "any", "filter", "map"):
            v, body = self.function()
            return f"{ {'all': 'forall', 'any': 'exists', 'map': 'transform'}.get(name, name)}({of}, {v} -> {body})"
        if name in ("find?", "partition"):
            v, body = self.function()
            yes = f"filter({of}, {v} -> {body})"
            return f"try_element_at({yes}, 1)" if name == "find?" else f"named_struct('_1', {yes}, '_2', filter({of}, {v} -> NOT ({body})))"
        if name == "zip":  # as long as the shorter list
            other = self.argument()
            n = f"least(size({of}), size({other}))"
            return f"zip_with(slice({of}, 1, {n}), slice({other}, 1, {n}), (x, y) -> named_struct('_1', x, '_2', y))"
        if name == "zipIdx":
            return f"transform({of}, (x, k) -> named_struct('_1', x, '_2', CAST(k AS bigint)))"
        if name == "contains":
            return f"array_contains({of}, {self.argument()})"
        if name == "isSome":
            return f"({of} IS NOT NULL)"
        if name == "isNone":
            return f"({of} IS NULL)"
        if name in ("getD", "getOrElse"):
            return f"coalesce({of}, {self.argument()})"
        if name in ("fst", "snd") or name.isdigit():
            return f"{of}._{ {'fst': 1, 'snd': 2}.get(name, name) }"
        if re.fullmatch(r"v\d+(?:\.\w+)*", of):  # a member of a list's entry
            return f"{of}.{name}"
        raise Unsupported(f"unknown member {name}")


def compile_predicate(source: str, schema: Schema) -> tuple[str, frozenset[str]]:
    """(Spark SQL, fields used) of ``fun i => …``; the SQL is never null once nulls are filled."""
    tokens = _tokens(source)
    if tokens[:1] != ["fun"] or "=>" not in tokens[:3] or len(tokens) < 4:
        raise Unsupported("not a function of a filing")
    parser = _Parser(tokens[3:], schema, tokens[1])
    sql = parser.expression()
    if parser.at != len(parser.tokens):
        raise Unsupported(f"left over: {parser.peek()}")
    return sql, frozenset(parser.used)


_RECORD = re.compile(r"""\{\s*id\s*:=\s*"(?P<id>(?:[^"\\]|\\.)*)"(?P<body>.*?)(?=\n\s*\{\s*id\s*:=|\n\s*\]|\Z)""", re.S)
_MEMBER = re.compile(r"""[,\n]\s*(title|reference|check|failReason|remedy\??)\s*:=\s*""")


def read_records(text: str) -> list[dict[str, str]]:
    """The members (as text) of the rule records of a file, in order; a record may lack members."""
    out = []
    for m in _RECORD.finditer(text):
        body = m["body"]
        marks = [*_MEMBER.finditer(body)]
        row = {"id": m["id"]}
        for k, mark in enumerate(marks):
            value = body[mark.end() : marks[k + 1].start() if k + 1 < len(marks) else len(body)]
            row[mark[1].rstrip("?")] = re.sub(r"\}\s*,?\s*$", "", value.strip().rstrip(",").strip()).strip()
        out.append(row)
    return out
