"""Redaction of secrets and home paths. The table of families is this library's own.

Replacements hold nothing that any family matches, so redacting twice changes nothing more.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let

#: family: (pattern, what stays before the replacement). Look-around free, so that other engines can run them.
FAMILIES: dict[str, tuple[str, str]] = {
    "private_key": (r"(?s)-----BEGIN [A-Z ]*PRIVATE KEY-----.*?-----END [A-Z ]*PRIVATE KEY-----", ""),
    "cloud_key_id": (r"\b(?:AKIA|ASIA)[A-Z0-9]{16}\b", ""),
    "vcs_token": (r"\b(?:gh[pousr]_[A-Za-z0-9]{20,}|github_pat_[A-Za-z0-9_]{20,}|glpat-[A-Za-z0-9_\-]{20,})", ""),
    "chat_token": (r"\bxox[abprs]-[A-Za-z0-9\-]{10,}", ""),
    "model_key": (r"\bsk-[A-Za-z0-9_\-]{20,}", ""),
    "jwt": (r"\beyJ[A-Za-z0-9_\-]{8,}\.[A-Za-z0-9_\-]{8,}\.[A-Za-z0-9_\-]{4,}", ""),
    "bearer": (r"(?i)(\bbearer\s+)[A-Za-z0-9._~+/\-]{16,}=*", "$1"),
    "assignment": (r"(?i)(\b(?:password|passwd|secret|token|api[_\-]?key)[\"']?\s*[:=]\s*[\"']?)[A-Za-z0-9+/_.=\-]{8,}", "$1"),
}
#: What a text must hold for a family to match; families without an entry ignore case and are searched for at once.
HINTS = {"private_key": ("PRIVATE KEY",), "cloud_key_id": ("AKIA", "ASIA"), "vcs_token": ("gh", "glpat-"), "chat_token": ("xox",), "model_key": ("sk-",), "jwt": ("eyJ",)}
HOME = r"(?i)(?:/home/[A-Za-z0-9._\-]+|/Users/[A-Za-z0-9._\-]+|/root(?:/[^\s\"']+)?|[A-Za-z]:\\Users\\[A-Za-z0-9._\-]+|[A-Za-z]:/Users/[A-Za-z0-9._\-]+)"
HOME_MARK = "[home]"


def mark(family: str) -> str:
    return f"[redacted:{family}]"


def _may_hold(x: Column, family: str) -> Column | None:
    """A plain search, many times cheaper than the pattern's."""
    return reduce(lambda a, b: a | b, [F.contains(x, F.lit(h)) for h in HINTS[family]]) if family in HINTS else None


def redact(x: Column) -> Column:
    def one(family: str):
        pattern, kept = FAMILIES[family]

        def of(v: Column) -> Column:
            may, new = _may_hold(v, family), F.regexp_replace(v, pattern, kept + mark(family))
            return new if may is None else F.when(may, new).otherwise(v)

        return of

    for family in FAMILIES:
        x = let(x, one(family)) if family in HINTS else one(family)(x)
    return F.regexp_replace(x, HOME, HOME_MARK)


def secret_families(x: Column) -> Column:
    """Names of the families that x holds, in the table's order."""
    holds = lambda f, p: x.rlike(p) if f not in HINTS else _may_hold(x, f) & x.rlike(p)
    return F.array_compact(F.array(*[F.when(holds(f, p), F.lit(f)) for f, (p, _) in FAMILIES.items()]))


def has_home(x: Column) -> Column:
    return x.rlike(HOME)


def redaction_warnings(x: Column) -> Column:
    """What a redaction of x would say: one line a family."""
    return F.transform(F.concat(secret_families(x), F.when(has_home(x), F.array(F.lit("home_path"))).otherwise(F.array().cast("array<string>"))), lambda f: F.concat(F.lit("redacted "), f))
