"""Paths in diffs: decoding, headers, and which files are a machine's own noise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let, or_empty, strip

# Files and folders of one machine, which say nothing about the change.
NOISE_FILES = ("remotes.txt", ".env", ".env.local")
NOISE_FOLDERS = (".beads", ".claude", ".kilo")
ESCAPES = {"n": "0A", "t": "09", "r": "0D", "a": "07", "b": "08", "f": "0C", "v": "0B", '"': "22", "\\": "5C"}
BREAKS = "\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"
QUOTED = r'"((?:[^"\\]|\\.)*)"'


def unquoted(token: Column) -> Column:
    """A path token of a header: C quotes and octal bytes undone, the side's prefix (a/ or b/) off."""

    def hexed(part: Column) -> Column:
        octal = F.lpad(F.conv(F.substring(part, 2, 3), 8, 16), 2, "0")
        plain = F.hex(F.encode(part, "UTF-8"))
        named = F.coalesce(*[F.when(part == "\\" + k, F.lit(v)) for k, v in ESCAPES.items()], plain)
        return F.when(part.rlike(r"\A\\[0-7]{3}\z"), octal).when(part.startswith("\\"), named).otherwise(plain)

    def decoded(s: Column) -> Column:
        parts = F.regexp_extract_all(F.substring(s, F.lit(2), F.length(s) - 2), F.lit(r"(?s)\\[0-7]{3}|\\.|[^\\]"), 0)
        return F.make_valid_utf8(F.unhex(F.array_join(F.transform(parts, hexed), "")).cast("string"))

    path = let(strip(or_empty(token)), lambda s: F.when((F.length(s) >= 2) & s.startswith('"') & s.endswith('"'), decoded(s)).otherwise(s))
    return F.regexp_replace(path, r"\A[ab]/", "")


def is_noise(path: Column) -> Column:
    """Whether a path is a machine's own: by its name, or by a folder on its way, in any case."""
    raw = F.when(path.startswith('"'), unquoted(path)).otherwise(path)
    clean = F.regexp_replace(F.regexp_replace(strip(F.replace(or_empty(raw), F.lit("\\"), F.lit("/"))), r'\A"+|"+\z', ""), r"\A[ab]/", "")

    def judged(low: Column) -> Column:
        base = F.regexp_extract(F.regexp_replace(low, "/+$", ""), "([^/]*)$", 1)
        folders = "|".join(f.replace(".", r"\.") for f in NOISE_FOLDERS)
        return base.isin(*NOISE_FILES) | F.regexp_replace(low, r"\A\./", "").rlike(rf"(?:\A|/)(?:{folders})/") | (base.startswith(".env.") & base.endswith(".local"))

    return F.when(F.coalesce(path, F.lit("")) == "", False).otherwise(let(F.lower(clean), judged))


def header_paths(header: Column) -> Column:
    """The paths of a `diff --git` line: two quoted ones, or a/.. up to the first ` b/`, or else its tokens."""
    both = rf"(?U)\A{QUOTED}\s+{QUOTED}\z"

    def of(rest: Column) -> Column:
        quoted = F.array(*[unquoted(F.concat(F.lit('"'), F.regexp_extract(rest, both, i), F.lit('"'))) for i in (1, 2)])
        at = F.instr(rest, " b/")
        plain = F.array(unquoted(F.substring(rest, F.lit(1), at - 1)), unquoted(F.substring(rest, at + 1, F.length(rest))))
        tokens = F.transform(F.regexp_extract_all(rest, F.lit(rf"(?U){QUOTED}|\S+"), 0), unquoted)
        return F.when(rest == "", F.array().cast("array<string>")).when(rest.rlike(both), quoted).when(rest.startswith("a/") & (at > 0), plain).otherwise(tokens)

    return let(F.regexp_extract(strip(header), r"(?s)\Adiff --git (.*)\z", 1), of)


def without_noise(diff: Column) -> Column:
    """A unified diff without the sections of files that are noise on either side; other lines as they were."""
    named = "|".join(p.replace(".", r"\.") for p in (*NOISE_FILES, *NOISE_FOLDERS))
    header = lambda part: F.regexp_extract(part, rf"\A([^{BREAKS}]*)", 1)

    def of(v: Column) -> Column:
        parts = F.split(v, rf"(?:\A|(?<=[{BREAKS}]))(?=diff --git )", -1)
        kept = F.filter(parts, lambda part: ~(part.startswith("diff --git ") & F.exists(header_paths(header(part)), is_noise)))
        return F.when(v.rlike(rf"(?i)(?:{named})"), F.array_join(kept, "")).otherwise(v)

    return let(diff, of)


def suffix(path: Column) -> Column:
    """The last extension of a file's name, lower-cased, dot included; empty without one."""
    name = F.regexp_extract(or_empty(path), "([^/]*)$", 1)
    return F.lower(F.regexp_extract(name, r"[^.].*?(\.[^.]+)$", 1))


def is_inside(path: Column) -> Column:
    """Whether a relative path stays below its folder: not absolute, no step up."""
    p = strip(or_empty(path))
    return (p != "") & ~p.startswith("/") & ~p.rlike(r"(?:\A|/)\.\.(?:/|\z)") & ~p.rlike(r"\A[A-Za-z]:")


