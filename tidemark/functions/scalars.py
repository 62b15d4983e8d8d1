"""Column functions: times, lenient numbers, text predicates."""

from __future__ import annotations

import re
from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

INT_MIN, INT_MAX = -2147483648, 2147483647
MICROSECOND = timedelta(microseconds=1)


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def micros(time: Column | str) -> Column:
    """Epoch microseconds. A time without zone is read in the session zone."""
    return F.unix_micros(col(time).cast("timestamp"))


def event_time(epoch_ms: Column | str) -> Column:
    """Timestamp from epoch milliseconds."""
    return F.timestamp_millis(col(epoch_ms))


def field(text: Column | str, number: int, separator: str = ",") -> Column:
    """The 1-based field of a delimited text; null when there are fewer."""
    return F.get(F.split(col(text), re.escape(separator)), number - 1)


def non_empty(text: Column | str) -> Column:
    """True unless the value is null or empty (a blank CSV field reads as null)."""
    return F.coalesce(col(text), F.lit("")) != ""


def equals_ignore_case(text: Column | str, value: str) -> Column:
    return F.lower(col(text)) == value.lower()


def is_digit(text: Column | str) -> Column:
    """True when the whole text is one ASCII digit."""
    return col(text).rlike("^[0-9]\\z")


def lenient_int(text: Column | str) -> Column:
    """The first run of digits as an int, clamped to the 32-bit range.

    A minus directly before the run makes it negative. No digit gives null. Leading zeros
    are ignored, and more than ten other digits are out of range whatever they are.
    """
    found = F.regexp_extract(col(text), "(-?)([0-9]+)", 1)
    digits = F.regexp_extract(col(text), "(-?)([0-9]+)", 2)
    significant = F.regexp_replace(digits, "^0+(?=[0-9])", "")
    negative = found == "-"
    bound = F.when(negative, INT_MIN).otherwise(INT_MAX)
    size = F.length(significant)
    value = F.when(size <= 10, significant).cast("long")
    signed = F.when(negative, -value).otherwise(value)
    clamped = F.greatest(F.lit(INT_MIN), F.least(F.lit(INT_MAX), signed))
    return F.when(size.isNull() | (size == 0), None).when(size > 10, bound).otherwise(clamped).cast("int")


def well_bracketed(text: Column | str, ignore_other: bool = False) -> Column:
    """True when every bracket of `()[]{}` is closed by its partner in the right order.

    Other characters make the text invalid unless `ignore_other` is set. The text is cut down
    to its brackets first, so the fold below costs brackets, not characters.
    """
    text = col(text)
    brackets = F.regexp_replace(text, r"[^()\[\]{}]", "")
    pairs = F.create_map(*[F.lit(c) for c in (")", "(", "]", "[", "}", "{")])

    def step(stack: Column, char: Column) -> Column:
        # A closing bracket without its partner on top leaves "x", which nothing removes.
        opener = F.element_at(pairs, char)
        return (
            F.when(stack.startswith("x"), stack)
            .when(opener.isNull(), F.concat(char, stack))
            .when(stack.startswith(opener), F.substring(stack, 2, INT_MAX))
            .otherwise(F.lit("x"))
        )

    chars = F.filter(F.split(brackets, ""), lambda c: c != "")
    closed = F.aggregate(chars, F.lit(""), step) == ""
    return closed if ignore_other else closed & (brackets == text)


def phrase_starts(text: Column | str, words: list[str]) -> Column:
    """0-based offsets where the text runs through all `words` back to back, in any order.

    The words have one length; a word listed twice must occur twice. One look-ahead pattern
    splits the text before each run of listed words, so only those places are compared.
    """
    size, total = len(words[0]), sum(map(len, words))
    if any(len(w) != size for w in words):
        raise ValueError("words must have the same length")
    text = col(text)
    run = "(?:%s){%d}" % ("|".join(re.escape(w) for w in sorted(set(words))), len(words))
    pieces = F.split(text, f"(?={run})")
    starts = F.aggregate(
        F.slice(pieces, 1, F.size(pieces) - 1),
        F.array(F.lit(0)),
        lambda acc, piece: F.concat(acc, F.array(F.element_at(acc, -1) + F.length(piece))),
    )
    wanted = F.array_sort(F.array(*[F.lit(w) for w in words]))

    def phrase(index: Column) -> Column:
        return F.substring(F.array_join(F.slice(pieces, index + 1, total), ""), 1, total)

    def complete(found: Column) -> Column:
        split = F.transform(
            F.sequence(F.lit(0), F.lit(len(words) - 1)), lambda i: F.substr(found, i * size + 1, F.lit(size))
        )
        return (F.length(found) == total) & (F.array_sort(split) == wanted)

    places = F.transform(starts, lambda start, i: F.struct(start.alias("start"), phrase(i).alias("found")))
    hits = F.filter(places, lambda p: complete(p["found"]))
    none = F.array().cast("array<int>")
    hits = F.transform(hits, lambda p: p["start"])
    return F.when(text.rlike(run), hits).when(text.isNotNull(), none)
