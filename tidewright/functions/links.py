"""References to issues that a text closes, and the addresses of their sources."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let, or_empty

# Closing words and what may stand between them and a reference.
CLOSE = r"\b(?:close[sd]?|closing|fix(?:e[sd])?|fixing|resolve[sd]?|resolving)(?:\*+)?(?::\*+|:)?\**\s+"
LIST = rf"(?iU){CLOSE}#(\d+)(?:\s*[,/]\s*(?:and\s+)?#(\d+))*(?:\s+and\s+#(\d+))?"
ONE = rf"(?iU){CLOSE}#(\d+)\b"
FULL = rf"(?iU){CLOSE}https://github\.com/([\w.\-]+)/([\w.\-]+)/issues/(\d+)\b"
CROSS = rf"(?iU){CLOSE}([\w.\-]+)/([\w.\-]+)#(\d+)\b"
SOURCE = r"\Ahttps://github\.com/[A-Za-z0-9_.\-]+/[A-Za-z0-9_.\-]+/(?:pull|issues)/[0-9]+"
REF = "struct<repo:string,number:bigint>"


def ref(repo: Column, number: Column) -> Column:
    return F.struct(repo.cast("string").alias("repo"), number.try_cast("bigint").alias("number"))


def close_refs(text: Column, repo: Column) -> Column:
    """Array of (repo, number) that a text closes, in the order of four readings, the first of equal ones; case as written.

    Of a list the first number comes first, then the last one behind a comma, the one behind "and", and the others.
    """
    parts = lambda m: F.concat(F.array(*[F.regexp_extract(m, LIST, i) for i in (1, 2, 3)]), F.regexp_extract_all(m, F.lit(r"#(\d+)"), 1))

    def elsewhere(body: Column, pattern: str) -> Column:
        found = F.regexp_extract_all(body, F.lit(pattern), 0)
        return F.transform(found, lambda m: ref(F.concat(F.regexp_extract(m, pattern, 1), F.lit("/"), F.regexp_extract(m, pattern, 2)), F.regexp_extract(m, pattern, 3)))

    def of(body: Column) -> Column:
        listed = F.flatten(F.transform(F.regexp_extract_all(body, F.lit(LIST), 0), parts))
        own = F.transform(F.concat(listed, F.regexp_extract_all(body, F.lit(ONE), 1)), lambda n: ref(repo, n))
        return F.filter(F.array_distinct(F.concat(own, elsewhere(body, FULL), elsewhere(body, CROSS))), lambda r: r["number"].isNotNull())

    # most texts hold no closing word before a reference at all
    return let(or_empty(text), lambda body: F.when(body.rlike(rf"(?iU){CLOSE}(?:#|https|[\w.\-]+/)"), of(body)).otherwise(F.array().cast(f"array<{REF}>")))


def issue_url(repo: Column, number: Column) -> Column:
    return F.concat(F.lit("https://github.com/"), repo, F.lit("/issues/"), number.cast("string"))


def pull_url(repo: Column, number: Column) -> Column:
    return F.concat(F.lit("https://github.com/"), repo, F.lit("/pull/"), number.cast("string"))


def source_urls(repo: Column, number: Column, urls: Column) -> Column:
    """The pull request's own address, then those of issues, each once, that look like a pull or an issue."""
    good = F.filter(urls, lambda u: F.coalesce(u.rlike(SOURCE), F.lit(False)))
    return F.array_distinct(F.concat(F.array(pull_url(repo, number)), good))


def repo_name(text: Column) -> Column:
    """owner/name from either that or a web address; an error for anything else."""
    bare = F.regexp_replace(F.regexp_replace(text, r"(?U)\A[\s/]+|[\s/]+\z", ""), r"(?i)\Ahttps?://github\.com/", "")
    return F.when(bare.rlike(r"\A[^/]+/[^/]+\z"), bare).otherwise(F.raise_error(F.concat(F.lit("not a repository: "), text)).cast("string"))


def repo_slug(text: Column) -> Column:
    return F.replace(repo_name(text), F.lit("/"), F.lit("_"))


def next_link(header: Column) -> Column:
    """The address with rel="next" in a Link header, or null."""
    part = F.get(F.filter(F.split(or_empty(header), ","), lambda p: F.contains(p, F.lit('rel="next"'))), F.lit(0))
    return F.nullif(F.regexp_extract(part, "<([^>]*)>", 1), F.lit(""))
