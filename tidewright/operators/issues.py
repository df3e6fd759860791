"""Linked issues: collected ones, references that texts close, and references of cards or tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.bots import strip_boilerplate
from ..functions.links import close_refs, issue_url, ref
from ..functions.redact import redact
from ..functions.text import cap, filled, let, or_empty, outline, section_of, strip
from .labels import issue_numbers

ISSUE = "struct<number:bigint,repo:string,title:string,body:string,state:string,html_url:string,closed_by_pr:boolean,synthetic:boolean>"
ISSUES = f"array<{ISSUE}>"
# Sections that tell what a change is for, and how much of each text is kept.
PURPOSE = ("what changed", "user description", "motivation", "problem", "overview")
ISSUE_CHARS, SECTION_CHARS, BODY_CHARS = 1500, 2500, 2000


def key(repo: Column, number: Column) -> Column:
    return F.struct(F.lower(or_empty(repo)).alias("r"), number.alias("n"))


def stub(r: Column, closed: bool) -> Column:
    """An issue of which only its place is known."""
    return F.struct(
        r["number"].alias("number"), r["repo"].alias("repo"), F.lit("").alias("title"), F.lit("").alias("body"), F.lit("unknown").alias("state"),
        issue_url(r["repo"], r["number"]).alias("html_url"), F.lit(closed).alias("closed_by_pr"), F.lit(True).alias("synthetic"),
    ).cast(ISSUE)


def link_text(body: Column, commits: Column) -> Column:
    """What is searched for closing words: the body, then the commits' messages."""
    said = F.filter(F.transform(commits, lambda c: c["message"]), lambda m: filled(m).isNotNull())
    return F.array_join(F.concat(F.array(or_empty(body)), F.coalesce(said, F.array().cast("array<string>"))), "\n")


def linked_issues(repo: Column, number: Column, collected: Column, body: Column, commits: Column, carded: Column, tabled: Column) -> Column:
    """Collected issues, then those that texts close, then those of the card or else the table; never the pull request itself, each once.

    carded: the card's value for the pull request as JSON text (labels.json_text); tabled: a JSON list. Equality ignores the repository's case.
    """
    own = key(repo, number.cast("bigint"))
    kept = F.filter(F.coalesce(collected.cast(ISSUES), F.array().cast(ISSUES)), lambda i: F.coalesce(key(i["repo"], i["number"]) != own, F.lit(True)))
    closed = F.transform(close_refs(link_text(body, commits), repo), lambda r: stub(r, True))
    numbers = F.coalesce(issue_numbers(carded), issue_numbers(tabled), F.array().cast("array<bigint>"))
    named = F.transform(numbers, lambda n: stub(ref(repo, n), False))

    def joined(have: Column) -> Column:
        seen = F.transform(have, lambda i: key(i["repo"], i["number"]))

        def first(new: Column) -> Column:
            keys = F.transform(new, lambda i: key(i["repo"], i["number"]))
            return F.filter(new, lambda i, at: (key(i["repo"], i["number"]) != own) & ~F.array_contains(seen, key(i["repo"], i["number"])) & (F.array_position(keys, key(i["repo"], i["number"])) == at + 1))

        return F.concat(have, let(F.concat(closed, named), first))

    return let(kept, joined)


def issue_context(issues: Column, body: Column, title: Column, outlined: Column | None = None) -> Column:
    """Titles and bodies of the issues, then the change's purpose; the title if there is nothing else. Null if empty.

    body: without boilerplate; outlined: its outline, if that is there already.
    """
    outlined = outline(body) if outlined is None else outlined

    def told(i: Column) -> Column:
        head = F.when(strip(or_empty(i["title"])) != "", F.concat(F.lit("Issue #"), i["number"].cast("string"), F.lit(": "), strip(i["title"])))
        return F.array(head, filled(cap(strip_boilerplate(i["body"]), ISSUE_CHARS)))

    purpose = F.coalesce(cap(section_of(outlined, PURPOSE), SECTION_CHARS), cap(section_of(outlined, ("summary",)), SECTION_CHARS), filled(cap(body, BODY_CHARS)))
    parts = F.array_compact(F.concat(F.flatten(F.transform(issues, told)), F.array(purpose)))
    whole = let(parts, lambda p: F.when(F.size(p) > 0, F.array_join(p, "\n\n")).otherwise(strip(or_empty(title))))
    return filled(redact(strip(whole)))
