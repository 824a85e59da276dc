"""Matches of regular expressions with their places, as DataFrame expressions.

Places count code points; ends are exclusive. Patterns are Java's. The work on a
text grows in proportion to its length and, for up to about ``CHUNK`` squared matches, to
their number: running sums are taken by chunks, and no span is compared with all others.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<start:int,end:int,value:string>>"
#: Elements that a running sum appends one by one before it starts a new list.
CHUNK = 256
#: Characters in a block of a text that is cut at many places.
BLOCK = 1024


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _running(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """For each of the values (int, 0 or more) the sum or maximum of all up to it.

    Appending copies the list, so lists of ``CHUNK`` elements are made first, and joined.
    """
    none = F.array().cast("array<int>")

    def chunk(number: Column) -> Column:
        step = lambda state, x: F.concat(state, F.array(join(F.coalesce(F.try_element_at(state, F.lit(-1)), F.lit(0)), x)))
        return F.aggregate(F.slice(values, number * CHUNK + 1, CHUNK), none, step)

    def joined(chunks: Column) -> Column:
        last = lambda state: F.element_at(state, -1)
        before = F.aggregate(chunks, F.array(F.lit(0)), lambda state, c: F.concat(state, F.array(join(last(state), last(c)))))
        return F.flatten(F.zip_with(chunks, F.slice(before, 1, F.size(chunks)), lambda c, b: F.transform(c, lambda x: join(b, x))))

    numbers = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / CHUNK).cast("int"))
    return F.when(F.size(values) == 0, none).otherwise(_let(F.transform(numbers, chunk), joined))


def _sum(a: Column, b: Column) -> Column:
    return a + b


def matches(text: Column, pattern: str) -> Column:
    """All leftmost matches of a pattern, none overlapping, as structs (start, end, value).

    The text between matches and the matches themselves alternate; their
    lengths, summed up, give the places. The pattern never matches the empty text.
    """

    def placed(both: Column) -> Column:
        size = F.transform(both, lambda b: F.char_length(b["between"]) + F.coalesce(F.char_length(b["value"]), F.lit(0)))
        span = lambda b, end: F.struct((end - F.char_length(b["value"])).alias("start"), end.alias("end"), b["value"].alias("value"))
        return _let(size, lambda sizes: F.filter(F.zip_with(both, _running(sizes, _sum), span), lambda s: s["value"].isNotNull()))

    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    both = F.arrays_zip(F.split(text, pattern, -1).alias("between"), value.alias("value"))
    return F.when(text.rlike(pattern), _let(both, placed)).otherwise(F.array().cast(SPAN))


def apart(spans: Column, others: Column) -> Column:
    """The spans that overlap none of the others; both are structs with start and end.

    In the order of where spans end and others begin, a span meets the farthest end of
    all the others that begin before its own end.
    """
    mine = F.transform(spans, lambda s: F.struct(s["end"].alias("at"), F.lit(0).alias("later"), F.lit(0).alias("reach"), s.alias("span")))
    theirs = F.transform(others, lambda o: F.struct(o["start"].alias("at"), F.lit(1).alias("later"), o["end"].alias("reach")))

    def left(events: Column) -> Column:
        reached = _let(F.transform(events, lambda e: e["reach"]), lambda reach: _running(reach, F.greatest))
        met = F.zip_with(events, reached, lambda e, reach: F.struct(e["span"].alias("span"), reach.alias("reach")))
        return F.transform(F.filter(met, lambda m: m["span"].isNotNull() & (m["reach"] <= m["span"]["start"])), lambda m: m["span"])

    none = F.filter(mine, lambda e: F.lit(False))
    nothing = F.element_at(F.concat(F.transform(none, lambda e: e["span"]), F.array(F.lit(None))), -1)
    theirs = F.transform(theirs, lambda e: F.struct(e["at"], e["later"], e["reach"], nothing.alias("span")))
    return F.when((F.size(spans) == 0) | (F.size(others) == 0), spans).otherwise(_let(F.sort_array(F.concat(mine, theirs)), left))


def tagged(spans: Column, kind: str, order: int) -> Column:
    """Spans with their kind and its place among the kinds: (start, order, end, kind, value)."""
    return F.transform(
        spans,
        lambda s: F.struct(s["start"].alias("start"), F.lit(order).alias("order"), s["end"].alias("end"), F.lit(kind).alias("kind"), s["value"].alias("value")),
    )


def listed(spans: Column) -> Column:
    """kind:start:end of all tagged spans by start, then kind, comma-joined."""
    return F.array_join(
        F.transform(F.sort_array(spans), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def replaced(text: Column, spans: Column) -> Column:
    """The text with every span (start, end, new) replaced; of overlapping spans the first, then the longest, stands.

    What an overlapping span covers beyond the one before goes too. Parts of the text are cut
    from blocks, as a place in a text is found by reading all before it.
    """
    order = F.sort_array(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("less"), s["new"].alias("new"))))
    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))

    def part(blocks: Column, start: Column, end: Column) -> Column:
        first, last = F.floor(start / BLOCK).cast("int"), F.floor((end - 1) / BLOCK).cast("int")
        whole = F.array_join(F.slice(blocks, first + 1, F.greatest(last - first + 1, F.lit(0))), "")
        return F.substring(whole, F.pmod(start, F.lit(BLOCK)) + 1, F.greatest(end - start, F.lit(0)))

    def cut(both: Column) -> Column:
        ends = _let(F.transform(both["order"], lambda s: -s["less"]), lambda end: _running(end, F.greatest))

        def put(ends: Column) -> Column:
            before = F.concat(F.array(F.lit(0)), ends)
            pairs = F.zip_with(both["order"], F.slice(before, 1, F.size(ends)), lambda s, at: F.struct(s.alias("s"), at.alias("at")))
            outside = F.filter(pairs, lambda p: p["s"]["start"] >= p["at"])
            parts = F.transform(outside, lambda p: F.concat(part(both["blocks"], p["at"], p["s"]["start"]), p["s"]["new"]))
            return F.concat(F.array_join(parts, ""), part(both["blocks"], F.element_at(ends, -1), F.char_length(text)))

        return _let(ends, put)

    return F.when(F.size(spans) == 0, text).otherwise(_let(F.struct(order.alias("order"), blocks.alias("blocks")), cut))
