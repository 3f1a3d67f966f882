"""Propositions about a filing, and the gates that combine them.

A proposition file defines named predicates, ``def name (x : Issuer) : Prop :=
body``, each with a comment that says which regulation it states.  A body may
apply other propositions to the same filing, so a library is a graph; what is
not proven yet (``sorry``), can't be compiled, names a proposition that isn't
there or lies on a cycle is unknown, and so is whatever hinges on it: values are
true, false or null, combined as SQL combines them.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field, replace

from .language import Unsupported, _Parser, _tokens
from .schema import FieldSpec, Schema, spark_type

_BLOCK_COMMENT = re.compile(r"/-(?!-).*?-/", re.S)
_DEFINITION = re.compile(
    r"""(?:/--(?P<doc>.*?)-/\s*)?^\s*def\s+(?P<name>[A-Za-z_][\w']*)\s*\(\s*(?P<var>\w+)\s*:\s*\w+\s*\)\s*:\s*Prop\s*:=(?P<body>.*?)(?=^\s*(?:/-|def\b|theorem\b|lemma\b|example\b|end\b|namespace\b|section\b|open\b|\#)|\Z)""",
    re.S | re.M,
)
_LINE_COMMENT = re.compile(r"--[^\n]*")
#: ``Reg 6(1)(a): text`` and ``Combined Regulation 6 gate``.
_LABEL = re.compile(r"\s*Reg(?:ulation)?\s+(\d+[A-Z]?)([^:]*):?\s*(.*)", re.S)
_OF_NAME = re.compile(r"reg_(\d+[a-z]?)(?:_|$)", re.I)
_MODULE = re.compile(r"chapter_?(\d+)(?:_part_?(\d+))?", re.I)


@dataclass(frozen=True)
class Proposition:
    """`sql` is Spark SQL over the filing's fields and the columns of other propositions, as `column` names them."""

    name: str
    label: str  # the regulation with its clauses, as the comment has it
    title: str
    kind: str  # bool, string, list, tautology, gate or not_evaluable
    sql: str
    fields: frozenset[str]
    members: tuple[str, ...]  # propositions that the body applies, in order
    regulation: str | None
    part: str | None
    chapter: str | None
    note: str = ""


@dataclass(frozen=True)
class Library:
    """Propositions in an order in which each comes after all that it applies; `levels` has the same, grouped by depth."""

    schema: Schema
    propositions: tuple[Proposition, ...]
    problems: tuple[tuple[str, str], ...] = field(default=())  # (proposition, what is wrong)

    def __getitem__(self, name: str) -> Proposition:
        return self.by_name[name]

    @property
    def by_name(self) -> dict[str, Proposition]:
        return {p.name: p for p in self.propositions}

    @property
    def levels(self) -> list[list[Proposition]]:
        depth: dict[str, int] = {}
        for p in self.propositions:
            depth[p.name] = max((depth[m] + 1 for m in p.members), default=0)
        return [[p for p in self.propositions if depth[p.name] == d] for d in range(max(depth.values(), default=-1) + 1)]

    @property
    def gates(self) -> tuple[Proposition, ...]:
        return tuple(p for p in self.propositions if p.kind == "gate")

    def needed(self, *names: str) -> Library:
        """The library of these propositions and all that they hinge on."""
        want, known = set(), self.by_name
        todo = [*names]
        while todo:
            if (name := todo.pop()) not in want:
                want.add(name)
                todo += known[name].members
        return replace(self, propositions=tuple(p for p in self.propositions if p.name in want))

    @property
    def fields(self) -> set[str]:
        return set().union(*(p.fields for p in self.propositions)) if self.propositions else set()


def column(name: str) -> str:
    """The column that holds a proposition's value; no field of a filing has such a name."""
    return f"proposition {name}"


class _Body(_Parser):
    """The predicate language with propositions applied to the filing, and comparisons that are unknown where a side is."""

    def __init__(self, tokens, schema, issuer, known) -> None:
        super().__init__(tokens, schema, issuer)
        self.known, self.members = known, []

    def primary(self) -> str:
        name = self.peek()
        if name in self.known and name not in self.scope and self.tokens[self.at + 1 : self.at + 2] == [self.issuer]:
            self.at += 2
            self.members.append(name)
            return f"`{column(name)}`"
        return super().primary()


def _strict(sql: str) -> str:
    """Null-safe comparisons as plain ones."""
    return sql.replace(" <=> ", " = ").replace(" IS DISTINCT FROM ", " <> ")


def _kind(body: str, sql: str, members: list[str]) -> str:
    if members:
        return "gate"
    if re.fullmatch(r"\s*(?:\w+\.\w+\s*(?:≥|>=)\s*0\s*(?:(?:∧|&&)\s*)?)+", body):
        return "tautology"
    if '"' in body:
        return "string"
    return "list" if re.search(r"\b(?:size|forall|exists|filter|array_contains)\(", sql) else "bool"


def _definitions(text: str):
    for m in _DEFINITION.finditer(_BLOCK_COMMENT.sub("", text)):
        yield m["name"], m["var"], " ".join((m["doc"] or "").split()), _LINE_COMMENT.sub("", m["body"]).strip()


def load(modules: dict[str, str], schema: Schema) -> Library:
    """The library of proposition files, by module name; ``Chapter2_Part1`` gives chapter and part.

    Never fails on a proposition: what can't be used becomes unknown and is
    reported in `problems`, as are names defined twice (the first counts),
    names that are applied but not defined, and cycles.
    """
    found, problems = {}, []
    for module, text in modules.items():
        where = _MODULE.search(module)
        for name, var, doc, body in _definitions(text):
            if name in found:
                problems.append((name, "defined again"))
            else:
                found[name] = (where, var, doc, body)
    props = {name: _proposition(name, *parts, schema, found.keys()) for name, parts in found.items()}
    problems += [(p.name, p.note) for p in props.values() if p.note not in ("", "sorry")]
    ordered, cyclic = _ordered(props)
    for cycle in cyclic:
        problems.append((cycle[0], "cycle: " + " -> ".join([*cycle, cycle[0]])))
    return Library(schema, ordered, tuple(problems))


def _proposition(name, where, var, doc, body, schema: Schema, known) -> Proposition:
    said, own = _LABEL.match(doc), _OF_NAME.match(name)
    at = _MODULE.search(name) if not own else None
    regulation = said[1] if said else own[1] if own else None
    chapter, part = ((at or where)[1], (at or where)[2]) if (at or where) else (None, None)
    make = lambda kind, sql, fields=frozenset(), members=(), note="": Proposition(
        name, (said[1] + said[2]).strip() if said else "", said[3].strip() if said else doc, kind, sql, fields, tuple(members), regulation, part, chapter, note
    )
    if re.search(r"\bsorry\b", body) or not body:
        return make("not_evaluable", "CAST(NULL AS boolean)", note="sorry")
    try:
        parser = _Body(_tokens(body), schema, var, known)
        sql = _strict(parser.expression())
        if parser.at != len(parser.tokens):
            raise Unsupported(f"left over: {parser.peek()}")
    except Unsupported as e:
        unknown = [n for n in re.findall(rf"([A-Za-z_][\w']*)\s+{var}\b", body) if n not in known]
        return make("not_evaluable", "CAST(NULL AS boolean)", note=f"no proposition {unknown[0]}" if unknown else str(e))
    members = tuple(dict.fromkeys(parser.members))
    return make(_kind(body, sql, parser.members), sql, frozenset(parser.used), members)


def _ordered(props: dict[str, Proposition]) -> tuple[tuple[Proposition, ...], list[list[str]]]:
    """Topological order, as defined where that is free, and the cycles; members of a cycle become unknown and stand alone."""
    props, cycles = dict(props), []
    for cycle in _cycles(props):
        cycles.append(cycle)
        for name in cycle:
            props[name] = replace(props[name], kind="not_evaluable", sql="CAST(NULL AS boolean)", fields=frozenset(), members=(), note="cycle")
    waiting = {name: len(p.members) for name, p in props.items()}
    above = {name: [] for name in props}
    for p in props.values():
        for m in p.members:
            above[m].append(p.name)
    ready, out = [name for name, n in waiting.items() if not n], []
    while ready:
        name = ready.pop(0)
        out.append(props[name])
        for up in above[name]:
            waiting[up] -= 1
            if not waiting[up]:
                ready.append(up)
    return tuple(out), cycles


def _cycles(props: dict[str, Proposition]) -> list[list[str]]:
    """Every strongly connected group with a cycle in it, as a walk round one of its cycles with the rest of the group after it."""
    index: dict[str, int] = {}
    low: dict[str, int] = {}
    stack, held, out = [], set(), []
    for start in props:
        if start in index:
            continue
        work = [(start, iter(props[start].members))]
        index[start] = low[start] = len(index)
        stack.append(start)
        held.add(start)
        while work:
            name, members = work[-1]
            for m in members:
                if m not in index:
                    index[m] = low[m] = len(index)
                    stack.append(m)
                    held.add(m)
                    work.append((m, iter(props[m].members)))
                    break
                if m in held:
                    low[name] = min(low[name], index[m])
            else:
                work.pop()
                if work:
                    low[work[-1][0]] = min(low[work[-1][0]], low[name])
                if low[name] == index[name]:
                    group = set()
                    while name not in group:
                        group.add(stack[-1])
                        held.discard(stack.pop())
                    if len(group) > 1 or name in props[name].members:
                        out.append(_walk(props, name, group))
    return out


def _walk(props: dict[str, Proposition], start: str, group: set[str]) -> list[str]:
    seen, at = [], start
    while at not in seen:
        seen.append(at)
        at = next(m for m in props[at].members if m in group)
    round_ = seen[seen.index(at) :]
    return round_ + sorted(group - set(round_))


# -- structures ------------------------------------------------------------------------------------------------

_STRUCTURE = re.compile(r"^structure\s+(\w+)\s+where\s*\n(.*?)(?=^\S|\Z)", re.S | re.M)
_ALIAS = re.compile(r"^abbrev\s+(\w+)\s*:=\s*(.+?)\s*$", re.M)
_FIELD = re.compile(r"^\s+([a-z_]\w*)\s*:\s*([^:=\n]+?)\s*(?::=.*)?$", re.M)


def read_schema(text: str, name: str = "Issuer") -> Schema:
    """The schema of a ``structure`` in a definitions file: its fields with aliases resolved; lists of other structures become arrays of structs."""
    text = re.sub(r"/-.*?-/", "", text, flags=re.S)
    text = _LINE_COMMENT.sub("", text)
    aliases, structures = dict(_ALIAS.findall(text)), {n: _FIELD.findall(b) for n, b in _STRUCTURE.findall(text)}
    enums = set(re.findall(r"^inductive\s+(\w+)", text, re.M))
    if name not in structures:
        raise ValueError(f"no structure {name}; there are {', '.join(sorted(structures))}")

    def resolved(written: str) -> str:
        words = re.findall(r"[A-Za-z_]\w*", written)
        return " ".join("String" if w in enums else aliases.get(w, w) for w in words)

    def fields(of: str, within: tuple[str, ...]):
        if of in within:
            raise ValueError(f"structure {of} holds itself")
        for own, written in structures[of]:
            bare = resolved(written)
            inner = next((w for w in bare.split() if w in structures), None)
            if inner:
                members = ", ".join(f"{n}: {t}" for n, t, _ in fields(inner, (*within, of)))
                yield own, f"array<struct<{members}>>" if "List" in bare else f"struct<{members}>", False
            else:
                kind, optional = spark_type(bare)
                yield own, kind, optional

    return Schema(tuple(FieldSpec(*f) for f in fields(name, ())))


def counts(library: Library) -> Counter:
    """How many propositions there are of each kind."""
    return Counter(p.kind for p in library.propositions)
