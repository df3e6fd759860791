"""Text primitives as column expressions: Unicode-aware trimming, lines, sections, byte caps.

Patterns carry (?U) so that \\s, \\w and \\b know Unicode, and (?d) where a dot or an anchor must see line feeds only.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space that is trimmed: Unicode's, and the four separators below space.
SPACE = r"[\s\x1c-\x1f]"
LINE_BREAK = "\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once."""
    return F.get(F.transform(F.array(value), lambda x: body(x)), F.lit(0))


def strip(x: Column) -> Column:
    return F.regexp_replace(x, rf"(?U)\A{SPACE}+|{SPACE}+\z", "")


def rstrip(x: Column) -> Column:
    return F.regexp_replace(x, rf"(?U){SPACE}+\z", "")


def or_empty(x: Column) -> Column:
    return F.coalesce(x, F.lit(""))


def filled(x: Column) -> Column:
    """x, or null where it is an empty string: falsy values fall through to the next choice."""
    return F.nullif(x, F.lit(""))


def first_filled(*choices: Column) -> Column:
    return F.coalesce(*[filled(c) for c in choices])


def cap(x: Column, n: int) -> Column:
    """The first n code points."""
    return F.substring(x, 1, n)


def collapse(x: Column) -> Column:
    return F.regexp_replace(x, rf"(?U){SPACE}+", " ")


def lines(x: Column) -> Column:
    """The lines of x at every kind of line break, without an empty last one."""
    return let(F.split(x, LINE_BREAK, -1), lambda parts: F.when(F.element_at(parts, -1) == "", F.slice(parts, F.lit(1), F.size(parts) - 1)).otherwise(parts))


def replaced(x: Column, pattern: str, make: Callable[[Column], Column]) -> Column:
    """x with make(match) in the place of every match; nothing but the test where there is none."""

    def of(v: Column) -> Column:
        gaps, found = F.split(v, pattern, -1), F.regexp_extract_all(v, F.lit(pattern), 0)
        woven = let(F.transform(found, make), lambda new: F.array_join(F.transform(gaps, lambda g, i: F.concat(g, F.coalesce(F.get(new, i), F.lit("")))), ""))
        return F.when(v.rlike(pattern), woven).otherwise(v)

    return let(x, of)


def before_first(x: Column, markers: Sequence[str]) -> Column:
    """x up to the first occurrence of any marker, case as written."""

    def of(v: Column) -> Column:
        places = F.array_compact(F.array(*[F.nullif(F.instr(v, m), F.lit(0)) for m in markers]))
        return let(F.array_min(places), lambda at: F.when(at.isNull(), v).otherwise(F.substring(v, F.lit(1), at - 1)))

    return let(x, of)


def utf8_prefix(x: Column, n: Column) -> Column:
    """The longest prefix of at most n bytes that does not end within a character."""

    def of(raw: Column) -> Column:
        return F.coalesce(*[F.try_validate_utf8(F.substring(raw, F.lit(1), F.greatest(n - k, F.lit(0))).cast("string")) for k in range(4)])

    return F.when(F.octet_length(x) <= n, x).otherwise(let(F.encode(x, "UTF-8"), of))


def heading_level(line: Column) -> Column:
    """Number of # before a space, 0 if the line is no heading."""
    return F.length(F.regexp_extract(line, "^(#+) ", 1))


def heading_matches(line: Column, keywords: Sequence[str]) -> Column:
    """Whether a heading's title is, begins with, or holds outside parentheses one of the (plain, lower-case) keywords."""
    any_of = "|".join(keywords)
    title = F.lower(strip(F.substring(line, heading_level(line) + 1, F.length(line))))
    title = strip(collapse(F.regexp_replace(title, r"(?U)[^\w\s:()\-]+", " ")))

    def named(t: Column) -> Column:
        return t.rlike(rf"\A(?:{any_of})(?:\z|[ :])") | F.regexp_replace(t, r"\([^)]*\)", " ").rlike(rf"(?U)\b(?:{any_of})\b")

    # most headings name no keyword at all
    return (heading_level(line) > 0) & line.rlike(rf"(?iU)(?:{any_of.replace(' ', '.+')})") & let(title, named)


OUTLINE = "struct<lines:array<string>,heads:array<struct<i:int,level:int,line:string>>>"


def outline(x: Column) -> Column:
    """The lines of x and its headings, from which any number of sections are taken; null for a text without #."""

    def of(every: Column) -> Column:
        headings = F.filter(F.transform(every, lambda line, i: F.struct(i.alias("i"), heading_level(line).alias("level"), line.alias("line"))), lambda r: r["line"].startswith("#"))
        return F.struct(every.alias("lines"), headings.alias("heads"))

    return F.when(F.contains(x, F.lit("#")), let(lines(x), of))


def section_of(o: Column, keywords: Sequence[str]) -> Column:
    """Of an outline the body below the first heading that matches any keyword, up to the next of its level or above; null if empty."""

    def to_end(start: Column) -> Column:
        end = F.get(F.filter(o["heads"], lambda r: (r["i"] > start["i"]) & r["level"].between(1, start["level"])), F.lit(0))["i"]
        size = F.coalesce(end, F.size(o["lines"])) - start["i"] - 1
        return F.when(start.isNotNull(), filled(strip(F.array_join(F.slice(o["lines"], start["i"] + 2, size), "\n"))))

    return let(F.get(F.filter(o["heads"], lambda r: heading_matches(r["line"], keywords)), F.lit(0)), to_end)


def section(x: Column, keywords: Sequence[str]) -> Column:
    """One section of a text: see section_of."""
    return let(outline(x), lambda o: section_of(o, keywords))


def indent(line: Column) -> Column:
    """Width of leading blanks: a space 1, a tab 2."""
    lead = F.regexp_extract(line, "^([ \t]*)", 1)
    return F.length(lead) + F.length(F.regexp_replace(lead, " ", ""))
