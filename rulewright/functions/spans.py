"""Where a text holds a hint with the fewest edits.

The column of the dynamic programme of approximate search, one row for each
character of the hint, is kept as bits: where a cell is one more than the cell
above it, and where it is one less.  A stretch of text is a fold of that state
over its characters, 60 rows at a time in one bigint, so texts are searched
inside column expressions and hints may be of any length.  Only stretches around
places where a piece of the hint stands as it is are folded over: without one a
span needs too many edits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import let as _let

#: Rows of a block; sums of two blocks then fit in a bigint.
_ROWS = 60
_FULL = (1 << _ROWS) - 1


def _long(n: int) -> Column:
    return F.lit(n).cast("bigint")


def _not(x: Column) -> Column:
    return F.bitwise_not(x).bitwiseAND(_long(_FULL))


def _bit(k: Column) -> Column:
    return F.call_function("shiftleft", _long(1), k.cast("int"))


def characters(text: Column) -> Column:
    """The code points of a text as an array."""
    return F.regexp_extract_all(text, F.lit("(?s)."), 0)


def _blocks(chars: Column) -> Column:
    return F.sequence(F.lit(0), F.floor((F.size(chars) - 1) / _ROWS).cast("int"))


def _masks(chars: Column) -> Column:
    """A map from each character of a hint to the bits of its places, block by block."""
    places = lambda c: F.transform(
        _blocks(chars), lambda b: F.aggregate(F.transform(F.slice(chars, b * _ROWS + 1, _ROWS), lambda x, k: F.when(x == c, _bit(k)).otherwise(_long(0))), _long(0), lambda a, x: a.bitwiseOR(x))
    )
    return F.map_from_entries(F.transform(F.array_distinct(chars), lambda c: F.struct(c.alias("c"), places(c).alias("bits"))))


def _advanced(more: Column, less: Column, equal: Column, into: Column, top: Column) -> Column:
    """struct(more, less, out): a block one character on; `into` and `out` are what the cells above and below the block change by."""
    up, down = F.when(into > 0, _long(1)).otherwise(_long(0)), F.when(into < 0, _long(1)).otherwise(_long(0))

    def across(same: Column) -> Column:
        sums = same.bitwiseAND(more) + more
        return _let(sums.bitwiseXOR(more).bitwiseOR(same).bitwiseAND(_long(_FULL)), lambda diagonal: F.struct(less.bitwiseOR(_not(diagonal.bitwiseOR(more))).alias("p"), more.bitwiseAND(diagonal).alias("m")))

    def down_the_column(h: Column) -> Column:
        out = F.when(h["p"].bitwiseAND(top) != 0, 1).when(h["m"].bitwiseAND(top) != 0, -1).otherwise(0)
        shifted = F.struct(
            F.call_function("shiftleft", h["p"], F.lit(1)).bitwiseAND(_long(_FULL)).bitwiseOR(up).alias("p"),
            F.call_function("shiftleft", h["m"], F.lit(1)).bitwiseAND(_long(_FULL)).bitwiseOR(down).alias("m"),
            equal.bitwiseOR(less).alias("v"),
            out.alias("out"),
        )
        return _let(shifted, lambda s: F.struct(s["m"].bitwiseOR(_not(s["v"].bitwiseOR(s["p"]))).alias("more"), s["p"].bitwiseAND(s["v"]).alias("less"), s["out"].alias("out")))

    return _let(across(equal.bitwiseOR(down)), down_the_column)


#: What makes a column of a function that scans an array of characters.
_Use = Callable[[Callable[[Column], Column]], Column]


def _scan(chars: Column, anchored: bool, use: _Use) -> Column:
    """`use` of a function that scans a text for the hint `chars`, whose masks are made once however many texts are scanned.

    It gives struct(best, at): the least cost of the hint at an end within the
    text, and how many characters are before that end (the first such end).  An
    anchored hint begins where the text does.
    """
    masks, blocks, m = _masks(chars), _blocks(chars), F.size(chars)
    last = F.size(blocks) - 1
    none = F.transform(blocks, lambda b: _long(0))
    above = F.lit(1 if anchored else 0)

    def scanned(given: Column) -> Column:
        top = lambda b: F.when(b == last, _bit((m - 1) % _ROWS)).otherwise(_bit(F.lit(_ROWS - 1)))

        def step(state: Column, c: Column) -> Column:
            equal = F.coalesce(F.try_element_at(given["masks"], c), given["none"])

            def through(equal: Column) -> Column:
                start = F.struct(F.slice(given["none"], 1, 0).alias("more"), F.slice(given["none"], 1, 0).alias("less"), above.alias("h"))
                block = lambda a, b: _let(
                    _advanced(F.get(state["more"], b), F.get(state["less"], b), F.get(equal, b), a["h"], top(b)),
                    lambda n: F.struct(F.array_append(a["more"], n["more"]).alias("more"), F.array_append(a["less"], n["less"]).alias("less"), n["out"].alias("h")),
                )
                return F.aggregate(given["blocks"], start, block)

            def scored(n: Column) -> Column:
                cost, k = state["cost"] + n["h"], state["k"] + 1
                hit = cost < state["best"]
                return F.struct(n["more"].alias("more"), n["less"].alias("less"), cost.alias("cost"), F.when(hit, cost).otherwise(state["best"]).alias("best"), F.when(hit, k).otherwise(state["at"]).alias("at"), k.alias("k"))

            return _let(_let(equal, through), scored)

        first = F.struct(F.transform(given["blocks"], lambda b: _long(_FULL)).alias("more"), given["none"].alias("less"), m.alias("cost"), m.alias("best"), F.lit(0).alias("at"), F.lit(0).alias("k"))
        return use(lambda text: F.aggregate(text, first, step, lambda s: F.struct(s["best"].alias("best"), s["at"].alias("at"))))

    return _let(F.struct(masks.alias("masks"), blocks.alias("blocks"), none.alias("none")), scanned)


def _scan_short(chars: Column, anchored: bool, use: _Use) -> Column:
    """As `_scan`, for hints of one block."""
    masks, m = F.transform_values(_masks(chars), lambda _, bits: bits[0]), F.size(chars)
    up = _long(1 if anchored else 0)

    def scanned(given: Column) -> Column:
        def step(state: Column, c: Column) -> Column:
            def across(same: Column) -> Column:
                sums = same.bitwiseAND(state["more"]) + state["more"]
                diagonal = sums.bitwiseXOR(state["more"]).bitwiseOR(same).bitwiseAND(_long(_FULL))
                return _let(diagonal, lambda x: F.struct(state["less"].bitwiseOR(_not(x.bitwiseOR(state["more"]))).alias("p"), state["more"].bitwiseAND(x).alias("m"), same.bitwiseOR(state["less"]).alias("v")))

            def down(h: Column) -> Column:
                cost = state["cost"] + F.when(h["p"].bitwiseAND(given["top"]) != 0, 1).when(h["m"].bitwiseAND(given["top"]) != 0, -1).otherwise(0)
                shift = lambda x: F.call_function("shiftleft", x, F.lit(1)).bitwiseAND(_long(_FULL))
                return _let(F.struct(shift(h["p"]).bitwiseOR(up).alias("p"), shift(h["m"]).alias("m"), h["v"].alias("v"), cost.alias("cost")), settled)

            def settled(n: Column) -> Column:
                k, hit = state["k"] + 1, n["cost"] < state["best"]
                return F.struct(
                    n["m"].bitwiseOR(_not(n["v"].bitwiseOR(n["p"]))).alias("more"), n["p"].bitwiseAND(n["v"]).alias("less"), n["cost"].alias("cost"),
                    F.when(hit, n["cost"]).otherwise(state["best"]).alias("best"), F.when(hit, k).otherwise(state["at"]).alias("at"), k.alias("k"),
                )

            return _let(_let(F.coalesce(F.try_element_at(given["masks"], c), _long(0)), across), down)

        first = F.struct(_long(_FULL).alias("more"), _long(0).alias("less"), m.alias("cost"), m.alias("best"), F.lit(0).alias("at"), F.lit(0).alias("k"))
        return use(lambda text: F.aggregate(text, first, step, lambda s: F.struct(s["best"].alias("best"), s["at"].alias("at"))))

    return _let(F.struct(masks.alias("masks"), _bit(m - 1).alias("top")), scanned)


#: What stretches are collected in: where a text has been read to, the stretch that may go on, and those before it.
_STRETCH = "struct<low: int, high: int>"


def _pushed(state: Column, low: Column, high: Column, at: Column) -> Column:
    """`state` with one more stretch, that begins no earlier than those before it; what overlaps or touches is one."""
    last = state["open"]
    joins = last.isNotNull() & (low <= last["high"])
    longer, other = F.struct(last["low"].alias("low"), F.greatest(last["high"], high).alias("high")), F.struct(low.alias("low"), high.alias("high"))
    return F.struct(at.alias("at"), F.when(joins, longer).otherwise(other).alias("open"), F.when(joins | last.isNull(), state["done"]).otherwise(F.array_append(state["done"], last)).alias("done"))


def _stretches(parts: Column, push: Callable[[Column, Column], Column]) -> Column:
    first = F.struct(F.lit(0).alias("at"), F.lit(None).cast(_STRETCH).alias("open"), F.expr(f"cast(array() as array<{_STRETCH}>)").alias("done"))
    return F.aggregate(parts, first, push, lambda s: F.when(s["open"].isNull(), s["done"]).otherwise(F.array_append(s["done"], s["open"])))


def _windows(text: Column, hint: Column, most: Column) -> Column:
    """Array of struct(low, high): stretches of the text, apart from each other, that hold all spans within `most` edits of the hint.

    One of `most` + 1 pieces of the hint stands in such a span as it is, and
    the span reaches no further from that place than the hint does and `most`
    characters more.  Where pieces would be empty, it is the whole text.
    """
    m, long = F.length(hint), F.floor(F.length(hint) / (most + 1)).cast("int")
    pieces = F.transform(F.sequence(F.lit(0), most), lambda k: F.struct((k * long).alias("at"), F.substr(hint, k * long + 1, long).alias("piece")))

    def around(p: Column) -> Column:
        # Every place where the piece begins ends a part, those that overlap too.
        parts = F.split(text, F.concat(F.lit(r"(?=\Q"), F.replace(p["piece"], F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E)")))

        def push(state: Column, part: Column) -> Column:
            low, at = state["at"] - p["at"] - most, state["at"] + F.length(part)
            passed = F.struct(at.alias("at"), state["open"].alias("open"), state["done"].alias("done"))
            return F.when((state["at"] > 0) | F.startswith(text, p["piece"]), _pushed(state, low, low + m + 2 * most, at)).otherwise(passed)

        return F.when(F.contains(text, p["piece"]), _stretches(parts, push)).otherwise(F.expr(f"cast(array() as array<{_STRETCH}>)"))

    whole = F.array(F.struct(F.lit(0).alias("low"), F.length(text).alias("high")))
    return F.when(long == 0, whole).otherwise(_stretches(F.array_sort(F.flatten(F.transform(pieces, around))), lambda state, w: _pushed(state, w["low"], w["high"], state["at"])))


def nearest_span(text: Column, hint: Column, most: Column) -> Column:
    """struct(start, end, edits): the code points start..end-1 of `text` that are nearest `hint` by edit distance, null beyond `most` edits.

    Of spans with as few edits the one that ends first counts, and of those the
    shortest.  A null text or hint has none, an empty hint the empty span at 0,
    an empty text one only if the hint may be left out.
    """
    scan = lambda hint, anchored, use: F.when(F.size(hint) <= _ROWS, _scan_short(hint, anchored, use)).otherwise(_scan(hint, anchored, use))
    part = lambda g, low, high: characters(F.substr(g["text"], low + 1, high - low))

    def found(g: Column) -> Column:
        def ahead(run: Callable[[Column], Column]) -> Column:
            def within(w: Column) -> Column:
                low = F.greatest(w["low"], F.lit(0))
                return _let(run(part(g, low, w["high"])), lambda s: F.struct(s["best"].alias("best"), (low + s["at"]).alias("at")))

            return F.array_min(F.transform(g["windows"], within))

        def back(s: Column) -> Column:
            reach = F.reverse(part(g, F.greatest(s["at"] - F.size(g["chars"]) - s["best"], F.lit(0)), s["at"]))
            length = scan(F.reverse(g["chars"]), True, lambda run: run(reach))
            return _let(length, lambda b: F.struct((s["at"] - b["at"]).alias("start"), s["at"].alias("end"), s["best"].alias("edits")))

        best = _let(scan(g["chars"], False, ahead), lambda s: F.when(s["best"] <= g["most"], s))
        return F.when(F.size(g["windows"]) > 0, _let(best, lambda s: F.when(s.isNotNull(), back(s))))

    empty = F.struct(F.lit(0).alias("start"), F.lit(0).alias("end"), F.lit(0).alias("edits"))
    given = F.struct(text.alias("text"), hint.alias("hint"), most.cast("int").alias("most"))
    prepared = lambda g: F.struct(g["text"].alias("text"), g["most"].alias("most"), characters(g["hint"]).alias("chars"), _windows(g["text"], g["hint"], g["most"]).alias("windows"))
    return F.when(hint == "", empty).when(text.isNotNull() & hint.isNotNull(), _let(_let(given, prepared), found))
