"""Column helpers for whole-text work inside one row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: ASCII white space, and the pattern of its runs.
BLANK = " \t\n\x0b\x0c\r"
BLANKS = r"[\x20\x09-\x0D]+"


def let(value: Column, body) -> Column:
    """``body`` applied to ``value``, which is computed once per row."""
    return F.transform(F.array(value), body)[0]


def trimmed_split(text: Column, chars: Column, pattern: str) -> Column:
    """Pieces of ``text`` between runs matching ``pattern``; none for a text of such characters alone.

    ``chars`` are characters that ``pattern`` matches and that may begin or end a text.
    """
    return let(F.btrim(text, chars), lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, pattern)))


def blank_words(text: Column) -> Column:
    """Words between runs of ASCII white space."""
    return trimmed_split(text, F.lit(BLANK), BLANKS)


def following(items: Column, k: int, size: Column) -> Column:
    """``items`` from their (k+1)-th on."""
    return F.slice(items, F.lit(k + 1), F.greatest(size - k, F.lit(0)))


def running(values: Column, zero: Column, add, chunk: int = 256) -> Column:
    """For each value the fold of those before it, ``zero`` for the first.

    Folded chunk by chunk, as an array that grows is copied by every step.
    """
    def before(xs, start):
        first = F.struct(start.alias("at"), F.slice(F.array(zero), F.lit(1), F.lit(0)).alias("out"))
        return F.aggregate(xs, first, lambda a, x: F.struct(add(a["at"], x).alias("at"), F.array_append(a["out"], a["at"]).alias("out")), lambda a: a["out"])

    def chunks(v):
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / chunk).cast("int")), lambda c: F.slice(v, c * chunk + 1, F.lit(chunk)))

    def of(parts):
        offsets = before(F.transform(parts, lambda p: F.aggregate(p, zero, add)), zero)
        return F.flatten(F.zip_with(parts, offsets, before))

    return let(values, lambda v: F.when(F.size(v) == 0, v).otherwise(let(chunks(v), of)))
