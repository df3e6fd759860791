"""Constraints on trajectories: the shape a record must have, and policy on top. Each gives an array of (path, message)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.links import pull_url
from ..functions.redact import has_home, secret_families
from ..functions.text import filled, strip
from ..schemas import EVENT_TYPES, OUTCOMES, RESULTS, TASKS, TRAJECTORY, USES

PROBLEM = "struct<path:string,message:string>"
# What names and addresses look like, and what a record may and must hold.
REPO = r"\A[a-zA-Z0-9](?:[a-zA-Z0-9-]{0,37}[a-zA-Z0-9])?/[a-zA-Z0-9][a-zA-Z0-9_.-]{0,99}\z"
URL = r"\Ahttps://github\.com/[A-Za-z0-9_.-]+/[A-Za-z0-9_.-]+/(?:pull|issues)/[0-9]+(?:#.*)?\z"
REQUIRED = ("id", "repo", "pr_number", "source_urls", "language", "domain", "task_type", "before_context", "patch", "validation", "outcome", "training_use")
KEYS = tuple(f.name for f in TRAJECTORY.fields)


def problem(when: Column, path: Column | str, message: Column | str) -> Column:
    as_column = lambda x: F.lit(x) if isinstance(x, str) else x
    return F.when(F.coalesce(when, F.lit(False)), F.struct(as_column(path).alias("path"), as_column(message).alias("message")).cast(PROBLEM))


def shape_problems(row: dict[str, Column] | None = None) -> Column:
    """What is wrong with a typed trajectory, by path. Null fields count as absent."""
    c = row or {k: F.col(k) for k in KEYS}
    out = [problem(c[k].isNull(), "(root)", f"'{k}' is a required property") for k in REQUIRED]
    out += [problem(c[k] == "", k, "must not be empty") for k in ("id", "language", "domain", "issue_context", "before_context", "patch")]
    out += [problem(~c["repo"].rlike(REPO), "repo", "is no repository name"), problem(c["pr_number"] < 1, "pr_number", "is less than 1")]
    out += [problem(~c[k].isin(*v), k, F.concat(c[k], F.lit(" is not one of its values"))) for k, v in (("task_type", TASKS), ("outcome", OUTCOMES), ("training_use", USES))]
    out += [problem(F.size(c[k]) == 0, k, "must hold an item") for k in ("source_urls", "validation", "review_signals")]
    out.append(problem((c["quality_score"] < 0) | (c["quality_score"] > 1), "quality_score", "is not within 0 and 1"))
    out.append(problem(c["issue_context"].isNull() & c["review_signals"].isNull(), "(root)", "needs issue_context or review_signals"))
    out.append(problem((c["training_use"] == "review-to-patch") & c["review_signals"].isNull(), "(root)", "'review_signals' is a required property"))

    def each(items: Column, test) -> Column:
        return F.coalesce(F.flatten(F.transform(items, lambda x, i: F.array_compact(F.array(*test(x, i))))), F.array().cast(f"array<{PROBLEM}>"))

    at = lambda name, i, part="": F.concat(F.lit(f"{name}."), i.cast("string"), F.lit(part))
    urls = each(c["source_urls"], lambda u, i: [problem(~u.rlike(URL), at("source_urls", i), F.concat(u, F.lit(" is no address of a pull or an issue")))])
    events = each(c["validation"], lambda e, i: [
        problem(e["type"].isNull() | ~e["type"].isin(*EVENT_TYPES), at("validation", i, ".type"), "is not one of its values"),
        problem(e["result"].isNull() | ~e["result"].isin(*RESULTS), at("validation", i, ".result"), "is not one of its values"),
        problem(e["detail"] == "", at("validation", i, ".detail"), "must not be empty"),
    ])
    signals = each(c["review_signals"], lambda s, i: [
        problem(s["comment"].isNull() & s["suggestion"].isNull(), at("review_signals", i), "needs comment or suggestion"),
        *[problem(s[k] == "", at("review_signals", i, f".{k}"), "must not be empty") for k in ("author", "comment", "suggestion")],
    ])
    return F.array_sort(F.concat(F.array_compact(F.array(*out)), urls, events, signals))


def extra_keys(line: Column) -> Column:
    """Keys of a JSON line that a trajectory does not have."""
    return F.array_except(F.coalesce(F.json_object_keys(line), F.array().cast("array<string>")), F.array(*[F.lit(k) for k in KEYS]))


def all_texts(row: dict[str, Column] | None = None) -> Column:
    """Every text of a trajectory, in the order of its fields."""
    c = row or {k: F.col(k) for k in KEYS}
    one = F.array(*[c[k] for k in ("id", "repo", "language", "domain", "task_type", "before_context", "patch", "outcome", "training_use", "issue_context")])
    none = F.array().cast("array<string>")
    events = F.flatten(F.transform(c["validation"], lambda e: F.array(e["type"], e["result"], e["detail"])))
    signals = F.flatten(F.transform(c["review_signals"], lambda s: F.array(s["author"], s["comment"], s["suggestion"])))
    return F.array_compact(F.concat(one, F.coalesce(c["source_urls"], none), F.coalesce(events, none), F.coalesce(signals, none)))


def policy_problems(row: dict[str, Column] | None = None) -> Column:
    """The own address must be among the sources; no home folder and no secret in any text."""
    c = row or {k: F.col(k) for k in KEYS}
    texts = all_texts(c)
    own = pull_url(c["repo"], c["pr_number"])
    families = F.array_distinct(F.flatten(F.transform(texts, secret_families)))
    missing = filled(c["repo"]).isNotNull() & (c["pr_number"] != 0) & ~F.coalesce(F.array_contains(c["source_urls"], own), F.lit(False))
    return F.array_compact(F.array(
        problem(missing, "source_urls", F.concat(F.lit("missing canonical address "), own)),
        problem(F.exists(texts, has_home), "policy", "absolute user-home path present"),
        problem(F.size(families) > 0, "policy", F.concat(F.lit("secret-like token present ("), F.array_join(families, ", "), F.lit(")"))),
    ))


def validate_lines(lines: DataFrame, strict: bool = False) -> DataFrame:
    """(file, line, path, message) of all problems of JSON lines (file, line, text); blank lines are passed over."""
    rows = lines.where(strip(F.col("text")) != "")
    parsed = rows.withColumn("record", F.from_json("text", TRAJECTORY)).withColumn("tree", F.try_parse_json("text"))
    c = {k: F.col("record")[k] for k in KEYS}
    bad = F.array(F.struct(F.lit(None).cast("string").alias("path"), F.lit("Invalid JSON").alias("message")).cast(PROBLEM))
    extra = F.transform(extra_keys(F.col("text")), lambda k: F.struct(F.lit("(root)").alias("path"), F.concat(F.lit("additional property "), k).alias("message")).cast(PROBLEM))
    good = F.concat(shape_problems(c), extra, policy_problems(c) if strict else F.array().cast(f"array<{PROBLEM}>"))
    found = parsed.select("file", "line", F.explode(F.when(F.col("tree").isNull(), bad).otherwise(good)).alias("p"))
    return found.select("file", "line", "p.path", "p.message")


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """df, or an error when it is empty."""
    if df.isEmpty():
        raise ValueError(f"no {what}")
    return df


def differs(made: DataFrame, kept: DataFrame) -> bool:
    """Whether two tables hold different rows."""
    return not (made.exceptAll(kept).isEmpty() and kept.exceptAll(made).isEmpty())
