"""Places of pattern matches in texts, as native expressions.

Spark returns the matched strings but not where they stand.  Splitting by the same
pattern returns what lies between them, so a match starts after all earlier gaps and
matches.  Sums over many matches go by blocks, so that a text with n matches costs
about n * sqrt(n) steps and not n squared.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

BLOCK = 256
# Code points of text kept before and after a match, for context words.
NEAR = 48

SPAN = "array<struct<kind:string,start:int,end:int,value:string,before:string,after:string>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once, also if it is used inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda total, n: total + n)


def sums_before(lengths: Column) -> Column:
    """For each number of an int array the sum of those before it."""

    def with_blocks(known: Column) -> Column:
        own, blocks = known["own"], known["blocks"]

        def before(_: Column, i: Column) -> Column:
            block = F.floor(i / BLOCK).cast("int")
            return _total(F.slice(blocks, 1, block)) + _total(F.slice(own, block * BLOCK + 1, i - block * BLOCK))

        return F.transform(own, before)

    def block_sums(own: Column) -> Column:
        last = F.floor((F.size(own) - 1) / BLOCK).cast("int")
        sums = F.transform(F.sequence(F.lit(0), last), lambda b: _total(F.slice(own, b * BLOCK + 1, BLOCK)))
        return let(F.struct(own.alias("own"), sums.alias("blocks")), with_blocks)

    empty = F.array().cast("array<int>")
    return let(lengths, lambda own: F.when(F.size(own) == 0, empty).otherwise(block_sums(own)))


def spans(text: Column, pattern: str, kind: str) -> Column:
    """Leftmost non-overlapping matches: kind, start, end (code points, end exclusive), value and the text around."""

    def placed(known: Column) -> Column:
        found, gaps = known["found"], known["gaps"]
        lengths = F.transform(found, lambda m, i: F.length(m) + F.length(gaps[i]))

        def at(sums: Column) -> Column:
            def span(m: Column, i: Column) -> Column:
                start = sums[i] + F.length(gaps[i])
                around = (F.right(gaps[i], F.lit(NEAR)).alias("before"), F.left(gaps[i + 1], F.lit(NEAR)).alias("after"))
                return F.struct(F.lit(kind).alias("kind"), start.alias("start"), (start + F.length(m)).alias("end"), m.alias("value"), *around)

            return F.transform(found, span)

        return let(sums_before(lengths), at)

    def of(found: Column) -> Column:
        both = F.struct(found.alias("found"), F.split(text, pattern, -1).alias("gaps"))
        return F.when(F.size(found) == 0, F.array().cast(SPAN)).otherwise(let(both, placed).cast(SPAN))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), of)


def listed(found: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(found: Column) -> Column:
    return F.sha2(listed(found), 256)


def of_kind(found: Column, kind: str) -> Column:
    return F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("long")


def by_start(found: Column, kinds: list[str]) -> Column:
    """Spans by start, then by the order of their kinds."""
    rank = F.array(*[F.lit(k) for k in kinds])
    keyed = F.transform(found, lambda s: F.struct(s["start"].alias("at"), F.array_position(rank, s["kind"]).alias("rank"), s.alias("span")))
    return F.transform(F.array_sort(keyed), lambda k: k["span"])
