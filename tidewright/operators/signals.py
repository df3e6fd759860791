"""Review signals: union of a thread's sources, deduplication, problems before acknowledgements."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.bots import ACK, is_ack, is_bot, is_empty_review, strip_boilerplate
from ..functions.redact import redact
from ..functions.text import cap, collapse, filled, let, or_empty, strip
from ..schemas import SIGNAL

MAX_SIGNALS, MAX_CHARS, LEAST_CHARS = 8, 2000, 20
DECISIONS = ("APPROVED", "CHANGES_REQUESTED", "DISMISSED")
SUGGESTION = r"(?s)```suggestion(?U:\s*)\n(.*?)```"
FENCE = r"(?is)```suggestion(?U:\s*)\n.*?```"
SHA_TOKEN = r"(?iU)\b(?=[0-9a-f]*[a-f])[0-9a-f]{7,40}\b"


def body_words(body: Column) -> Column:
    """A text without suggestion fences and white space at its ends and in a row; of acknowledgements what follows the commit."""
    text = collapse(strip(F.regexp_replace(or_empty(body), FENCE, " ")))
    return let(text, lambda x: F.when(is_ack(body), F.regexp_replace(x, ACK + r"(?:\*\*)?\s*:?\s*", "")).otherwise(x))


def body_key(body: Column) -> Column:
    """What two signals must share to be one: `body_words` in lower case, in acknowledgements with further commits masked. Empty without any letter or digit."""
    masked = let(body_words(body), lambda x: F.when(is_ack(body), F.regexp_replace(x, SHA_TOKEN, "<sha>")).otherwise(x))
    return let(F.lower(strip(masked)), lambda x: F.when(x.rlike("[a-z0-9]"), x).otherwise(""))


def review_body(body: Column, state: Column) -> Column:
    """A review's text; short ones count only with a decision, which is added. Null otherwise."""
    text, decision = strip(or_empty(body)), F.upper(or_empty(state))
    short = F.when(decision.isin(*DECISIONS), F.when(text == "", F.concat(F.lit("Review state: "), decision)).otherwise(F.concat(text, F.lit(" (review state: "), decision, F.lit(")"))))
    return F.when(F.length(text) >= LEAST_CHARS, text).otherwise(short)


def thread(reviews: Column, review_comments: Column, issue_comments: Column) -> Column:
    """All that people and listed reviewers wrote, in that order of sources: (kind, author, body)."""
    empty = F.array().cast("array<struct<kind:string,author:string,body:string>>")

    def part(rows: Column, kind: str, body) -> Column:
        people = F.filter(rows, lambda r: ~is_bot(r["user_login"], r["user_type"]))
        return F.coalesce(F.transform(people, lambda r: F.struct(F.lit(kind).alias("kind"), r["user_login"].alias("author"), body(r).alias("body"))), empty)

    return F.concat(
        part(reviews, "review", lambda r: review_body(r["body"], r["state"])),
        part(review_comments, "inline", lambda r: strip(or_empty(r["body"]))),
        part(issue_comments, "issue", lambda r: strip(or_empty(r["body"]))),
    )


def candidates(written: Column) -> Column:
    """(author, comment, suggestion, key, ack) of what is left after boilerplate, redaction and the gates."""
    clean = F.transform(F.filter(written, lambda w: w["body"].isNotNull()), lambda w: F.struct(w["kind"].alias("kind"), w["author"].alias("author"), strip_boilerplate(w["body"]).alias("body")))
    long_enough = F.filter(clean, lambda w: ~is_empty_review(w["body"]) & ((w["kind"] != "issue") | (F.length(w["body"]) >= LEAST_CHARS)))
    safe = F.transform(long_enough, lambda w: F.struct(w["kind"].alias("kind"), w["author"].alias("author"), strip(redact(w["body"])).alias("body")))

    def signal(w: Column) -> Column:
        suggestion = F.when(w["kind"] == "inline", filled(cap(strip(F.regexp_extract(w["body"], SUGGESTION, 1)), MAX_CHARS)))

        def keyed(s: Column) -> Column:
            own = body_key(w["body"])
            spare = F.when(s.isNotNull(), F.concat(F.lit("suggestion:"), F.coalesce(filled(body_key(s)), cap(F.lower(strip(s)), 120))))
            return F.struct(F.coalesce(filled(w["author"]), F.lit("unknown")).alias("author"), cap(w["body"], MAX_CHARS).alias("comment"), s.alias("suggestion"), F.coalesce(filled(own), spare).alias("key"), is_ack(w["body"]).alias("ack"))

        return let(suggestion, keyed)

    return F.filter(F.transform(F.filter(safe, lambda w: ~is_empty_review(w["body"])), signal), lambda c: c["key"].isNotNull())


def merged(found: Column) -> Column:
    """One candidate a key, at the place of its first: the first that is no acknowledgement, or else the first, with its own suggestion or the first there is."""

    def one(key: Column) -> Column:
        def of(same: Column) -> Column:
            best = F.coalesce(F.get(F.filter(same, lambda c: ~c["ack"]), F.lit(0)), F.get(same, F.lit(0)))
            other = F.get(F.filter(same, lambda c: filled(c["suggestion"]).isNotNull()), F.lit(0))["suggestion"]
            return F.struct(best["author"].alias("author"), best["comment"].alias("comment"), F.coalesce(filled(best["suggestion"]), other).alias("suggestion"), key.alias("key"), best["ack"].alias("ack"))

        return let(F.filter(found, lambda c: c["key"] == key), of)

    return F.transform(F.array_distinct(F.transform(found, lambda c: c["key"])), one)


def problem_first(items: Column, k: int) -> Column:
    """Up to k: problems in order, then acknowledgements, one of which has a place kept if both exist and k > 1."""
    if k < 1:
        return F.slice(items, 1, 0)

    def ranked(problems: Column) -> Column:
        def with_acks(acks: Column) -> Column:
            kept = F.when((F.size(acks) > 0) & (F.size(problems) > 0) & F.lit(k > 1), 1).otherwise(0)
            return F.slice(F.concat(F.slice(problems, F.lit(1), F.lit(k) - kept), acks), 1, k)

        return let(F.filter(items, lambda c: c["ack"]), with_acks)

    return let(F.filter(items, lambda c: ~c["ack"]), ranked)


def review_signals(reviews: Column, review_comments: Column, issue_comments: Column, k: int = MAX_SIGNALS) -> Column:
    """The signals of one pull request, at most k."""
    chosen = let(candidates(thread(reviews, review_comments, issue_comments)), lambda c: let(merged(c), lambda m: problem_first(m, k)))
    shown = lambda s: F.struct(s["author"].alias("author"), cap(s["comment"], MAX_CHARS).alias("comment"), filled(cap(strip(s["suggestion"]), MAX_CHARS)).alias("suggestion")).cast(SIGNAL)
    return F.transform(chosen, shown)
