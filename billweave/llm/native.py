"""Column helpers for work inside one text, in Spark SQL expressions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: ASCII white space: what parts words, and what is stripped from lines.
SPACES = " \t\n\x0b\x0c\r"
GAP = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

#: Prefix sums are taken in blocks, since an array can only grow by being copied.
_BLOCK = 512


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often ``body`` names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def whole(text: Column) -> Column:
    """The text; NULL counts as empty."""
    return F.coalesce(text, F.lit(""))


def words(text: Column) -> Column:
    return F.array_remove(F.split(whole(text), GAP, -1), "")


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, other letters as they are."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def lines(text: Column) -> Column:
    return F.split(whole(text), "\n", -1)


def numbers(first: int, last: Column) -> Column:
    """``first``..``last``, empty if ``last`` is smaller."""
    some = F.sequence(F.lit(first), last)
    return F.when(last >= first, some).otherwise(F.array().cast("array<int>"))


def running_sums(values: Column) -> Column:
    """For an array of ints: the sum before each element, and the total behind the last."""

    def grown(block: Column, start: Column) -> Column:
        return F.aggregate(block, F.array(start), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))

    def of(v: Column) -> Column:
        zero = F.lit(0)
        blocks = F.transform(
            numbers(0, F.floor((F.size(v) - 1) / F.lit(_BLOCK)).cast("int")),
            lambda b: F.slice(v, b * _BLOCK + 1, F.lit(_BLOCK)),
        )

        def joined(bs: Column) -> Column:
            starts = grown(F.transform(bs, lambda b: F.aggregate(b, zero, lambda a, x: a + x)), zero)
            inner = F.zip_with(
                bs,
                F.slice(starts, F.lit(1), F.size(bs)),
                lambda b, s: F.slice(grown(b, s), F.lit(1), F.size(b)),
            )
            return F.concat(F.flatten(inner), F.array(F.element_at(starts, -1)))

        return let(blocks, joined)

    return let(values, of)


def matches(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches as (start, end, found), in code points.

    ``pattern`` must not match the empty string. The parts between matches give the
    positions, so each text is searched twice, whatever the number of matches.
    """

    def placed(parts: Column, found: Column) -> Column:
        gaps = F.zip_with(
            F.slice(parts, F.lit(1), F.size(found)), found, lambda p, m: F.char_length(p) + F.char_length(m)
        )
        return F.zip_with(
            F.slice(running_sums(gaps), F.lit(2), F.size(found)),
            found,
            lambda end, m: F.struct(
                (end - F.char_length(m)).alias("start"), end.alias("end"), m.alias("found")
            ),
        )

    def of(t: Column) -> Column:
        found = F.regexp_extract_all(t, F.lit(pattern), F.lit(0))
        return let(found, lambda ms: F.when(
            F.size(ms) > 0, let(F.split(t, pattern, -1), lambda ps: placed(ps, ms))
        ).otherwise(F.array().cast("array<struct<start:int,end:int,found:string>>")))

    return let(whole(text), of)


def span_text(spans: Column, kinds: tuple[str, ...]) -> Column:
    """Structs (start, kind, end), kind a number, as "name:start:end" by start and kind."""
    names = F.array(*map(F.lit, kinds))
    shown = F.transform(
        F.sort_array(spans),
        lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")),
    )
    return F.array_join(shown, ",")


def overlaps(span: Column, others: Column) -> Column:
    return F.exists(others, lambda o: (o["start"] < span["end"]) & (span["start"] < o["end"]))


def of_kind(found: Column, kind: int, valid: Callable[[Column], Column]) -> Column:
    """Matches whose text is valid, as (start, kind, end)."""
    return F.transform(
        F.filter(found, lambda m: valid(m["found"])),
        lambda m: F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end")),
    )
