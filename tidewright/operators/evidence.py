"""Validation events: what a body's section, check runs and a combined status say about a change."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.bots import is_review_check
from ..functions.redact import redact
from ..functions.text import cap, filled, let, or_empty, rstrip, section_of
from ..functions.validation import section_passes
from ..schemas import EVENT

# Headings of validation sections, and what checks may end as without failing.
HEADINGS = ("validation", "validations", "test plan", "test plans", "verification", "verifications", "testing", "tests")
FINE, DONE = ("success", "neutral", "skipped"), ("completed", "neutral", "skipped")
DETAIL_CHARS, NAMED_CHECKS = 1500, 12


def event(kind: str, passes: Column, detail: Column) -> Column:
    return F.struct(F.lit(kind).alias("type"), F.when(passes, "pass").otherwise("fail").alias("result"), detail.alias("detail")).cast(EVENT)


def _ends(checks: Column) -> Column:
    return F.filter(F.transform(checks, lambda c: c["conclusion"]), lambda c: filled(c).isNotNull())


def ci_passes(checks: Column) -> Column:
    """All have ended, at least one with success, and none other than successful, neutral or skipped."""

    def open_(c: Column) -> Column:
        status = F.coalesce(filled(c["status"]), F.lit("completed"))
        return ~status.isin(*DONE) | ((status == "completed") & filled(c["conclusion"]).isNull())

    return ~F.exists(checks, open_) & F.array_contains(_ends(checks), "success") & F.forall(_ends(checks), lambda c: c.isin(*FINE))


def apps_pass(checks: Column) -> Column:
    """At least one has ended, and none other than successful, neutral or skipped."""
    return (F.size(_ends(checks)) > 0) & F.forall(_ends(checks), lambda c: c.isin(*FINE))


def check_names(checks: Column) -> Column:
    """name=end of the first checks, those without a name left out after counting."""
    shown = lambda c: F.concat(c["name"], F.lit("="), F.coalesce(filled(c["conclusion"]), c["status"], F.lit("None")))
    return F.array_join(F.transform(F.filter(F.slice(checks, 1, NAMED_CHECKS), lambda c: filled(c["name"]).isNotNull()), shown), ", ")


def validation_events(outlined: Column, check_runs: Column, combined: Column) -> Column:
    """Section, builds, combined status, or that there is no evidence; review apps last. outlined: of the body without boilerplate."""
    none = F.array().cast(f"array<{EVENT}>")
    some = lambda when, e: F.when(when, F.array(e)).otherwise(none)
    size = lambda a: F.coalesce(F.size(a), F.lit(0))

    def told(said: Column) -> Column:
        short = redact(cap(said, DETAIL_CHARS))
        detail = let(short, lambda x: F.when((F.length(said) > DETAIL_CHARS) & (x != ""), F.concat(rstrip(x), F.lit(" […]"))).otherwise(x))
        return some(said.isNotNull(), event("test", section_passes(said), detail))

    def built(builds: Column) -> Column:
        return some(size(builds) > 0, event("ci", ci_passes(builds), F.coalesce(filled(check_names(builds)), F.lit("check runs collected"))))

    def reviewed(apps: Column) -> Column:
        return some(size(apps) > 0, event("other", apps_pass(apps), F.coalesce(F.concat(F.lit("review_apps: "), filled(check_names(apps))), F.lit("review_apps"))))

    runs = F.coalesce(check_runs, F.slice(check_runs, 1, 0))
    state = or_empty(combined["state"])
    by_status = (state != "") & ((size(combined["statuses"]) > 0) | (size(check_runs) == 0))
    first = F.concat(
        let(section_of(outlined, HEADINGS), told), let(F.filter(runs, lambda c: ~is_review_check(c["name"])), built), some(by_status, event("ci", state == "success", F.concat(F.lit("combined_status="), state)))
    )
    nothing = F.array(event("other", F.lit(False), F.lit("No structured validation evidence collected")))
    return F.concat(let(first, lambda e: F.when(size(e) > 0, e).otherwise(nothing)), let(F.filter(runs, lambda c: is_review_check(c["name"])), reviewed))
