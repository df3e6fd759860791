"""Payloads of the REST source to raw records: narrow projections of each endpoint, put together by pull request."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import __version__
from ..functions.links import close_refs
from ..functions.redact import redact, redaction_warnings
from ..functions.text import filled, or_empty
from ..operators.issues import link_text
from ..schemas import RAW

USER = "user struct<login:string,type:string>"
SHAPES = {
    "pull": f"title string, body string, state string, merged boolean, merged_at string, html_url string, url string, {USER}, labels array<struct<name:string>>, base struct<sha:string>, head struct<sha:string>, merge_commit_sha string, additions bigint, deletions bigint, changed_files bigint, draft boolean, commits bigint, comments bigint, review_comments bigint",
    "commits": "array<struct<sha:string,commit:struct<message:string,author:struct<date:string>>,author:struct<login:string>>>",
    "files": "array<struct<filename:string,status:string,additions:bigint,deletions:bigint,changes:bigint,patch:string>>",
    "reviews": "array<struct<id:bigint,user:struct<login:string,type:string>,state:string,body:string,submitted_at:string>>",
    "comments": "array<struct<id:bigint,user:struct<login:string,type:string>,path:string,line:bigint,original_line:bigint,body:string,diff_hunk:string,created_at:string,in_reply_to_id:bigint,author_association:string>>",
    "issue_comments": "array<struct<id:bigint,user:struct<login:string,type:string>,created_at:string,body:string,author_association:string>>",
    "check_runs": "array<struct<name:string,status:string,conclusion:string,html_url:string>>",
    "combined_status": "state string, statuses array<struct<context:string,state:string,description:string>>",
}


def _type(name: str) -> str:
    return next(f.dataType.simpleString() for f in RAW.fields if f.name == name)


def slim_comment(c: Column) -> Column:
    return F.struct(c["id"].alias("id"), c["user"]["login"].alias("user_login"), c["user"]["type"].alias("user_type"), c["created_at"].alias("created_at"), redact(or_empty(c["body"])).alias("body"), c["author_association"].alias("author_association"))


def slim_review_comment(c: Column) -> Column:
    line = F.coalesce(F.nullif(c["line"], F.lit(0)), c["original_line"])
    return F.struct(c["id"].alias("id"), c["user"]["login"].alias("user_login"), c["user"]["type"].alias("user_type"), c["path"].alias("path"), line.alias("line"), redact(or_empty(c["body"])).alias("body"), redact(c["diff_hunk"]).alias("diff_hunk"), c["created_at"].alias("created_at"), c["in_reply_to_id"].alias("in_reply_to_id"), c["author_association"].alias("author_association"))


def slim_review(r: Column) -> Column:
    return F.struct(r["id"].alias("id"), r["user"]["login"].alias("user_login"), r["user"]["type"].alias("user_type"), r["state"].alias("state"), redact(or_empty(r["body"])).alias("body"), r["submitted_at"].alias("submitted_at"))


def slim_commit(c: Column) -> Column:
    return F.struct(c["sha"].alias("sha"), redact(or_empty(c["commit"]["message"])).alias("message"), c["author"]["login"].alias("author_login"), c["commit"]["author"]["date"].alias("date"))


def slim_file(f: Column) -> Column:
    cut = f["patch"].isNull() & F.coalesce(f["status"] != "removed", F.lit(True))
    return F.struct(*[f[k].alias(k) for k in ("filename", "status", "additions", "deletions", "changes")], redact(f["patch"]).alias("patch"), cut.alias("patch_truncated"))


def label_names(labels: Column) -> Column:
    return F.filter(F.transform(labels, lambda x: x["name"]), lambda n: filled(n).isNotNull())


def raw_records(payloads: DataFrame, collected_at: Column | None = None, authenticated: bool = False) -> DataFrame:
    """(repo, number, endpoint, payload) to records of the RAW type: one group by (repo, number), all else within the row.

    Texts are redacted as they are taken over; what was found is among the warnings.
    """
    of = lambda name: F.max(F.when(F.col("endpoint") == name, F.col("payload"))).alias(name)
    warned = F.array_sort(F.collect_list(F.when(F.col("endpoint") == "warning", F.col("payload")))).alias("soft")
    row = payloads.groupBy("repo", "number").agg(*[of(k) for k in (*SHAPES, "diff")], warned, F.array_sort(F.collect_set("endpoint")).alias("called"))
    everything = F.concat_ws("\n", *[F.col(k) for k in (*SHAPES, "diff")])
    row = row.withColumn("told", redaction_warnings(everything))
    row = row.withColumns({k: F.from_json(k, shape) for k, shape in SHAPES.items()})
    p, none = F.col("pull"), lambda t: F.lit(None).cast(t)
    fields = {
        "title": redact(p["title"]), "body": redact(or_empty(p["body"])), "state": p["state"], "merged": F.coalesce(p["merged"], F.lit(False)), "merged_at": p["merged_at"],
        "user_login": p["user"]["login"], "labels": label_names(p["labels"]), "base_sha": p["base"]["sha"], "head_sha": p["head"]["sha"], "merge_commit_sha": p["merge_commit_sha"],
        **{k: p[k] for k in ("additions", "deletions", "changed_files")}, "draft": F.coalesce(p["draft"], F.lit(False)), **{k: p[k] for k in ("commits", "comments", "review_comments")},
    }
    slim = lambda name, make: F.coalesce(F.transform(name, make), F.array().cast(_type({"comments": "review_comments"}.get(name, name))))
    size = F.octet_length("diff").cast("bigint")
    out = {
        "schema_version": F.lit("raw_pr_record_v0"),
        "collected_at": F.coalesce(collected_at if collected_at is not None else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX")),
        "collector_version": F.lit(__version__),
        "source": F.struct(F.col("repo"), F.col("number").alias("pr_number"), p["html_url"].alias("html_url"), F.struct(p["url"].alias("pull")).alias("api_urls")),
        "pull": F.struct(*[v.alias(k) for k, v in fields.items()]),
        "issue_comments": slim("issue_comments", slim_comment), "review_comments": slim("comments", slim_review_comment), "reviews": slim("reviews", slim_review),
        "commits": slim("commits", slim_commit), "files": slim("files", slim_file),
        "diff": F.struct(redact(F.col("diff")).alias("inline"), none("string").alias("sidecar_path"), size.alias("bytes"), F.lit(False).alias("truncated")),
        "checks": F.struct(F.col("check_runs"), F.col("combined_status")),
        "linked_issues": F.array().cast(_type("linked_issues")),
        "collection_meta": F.struct(F.lit(authenticated).alias("authenticated"), F.col("called").alias("endpoints_called"), F.concat(F.array_compact("soft"), "told").alias("warnings")),
    }
    return row.select(*[out[f.name].cast(f.dataType).alias(f.name) for f in RAW.fields])


#: What one issue's payload holds; a pull request among issues is told by its field pull_request.
ISSUE = "number bigint, title string, body string, state string, html_url string, pull_request string"


def issue_rows(payloads: DataFrame) -> DataFrame:
    """Payloads of single issues as rows (repo, number, title, body, state, html_url, pull_request); repo as it was asked for."""
    parsed = payloads.where("endpoint = 'issue'").select("repo", F.from_json("payload", ISSUE).alias("i"))
    return parsed.select("repo", "i.number", "i.title", "i.body", "i.state", "i.html_url", "i.pull_request")


def wanted_issues(raw: DataFrame, allowed: list[str] | None = None) -> DataFrame:
    """(repo, pr_number, issue_repo, issue_number, allowed) that bodies and commits close: the own repository's, and others if on the list. Case is ignored."""
    refs = close_refs(link_text(F.col("pull.body"), F.col("commits")), F.col("source.repo"))
    rows = raw.select(F.col("source.repo").alias("repo"), F.col("source.pr_number").alias("pr_number"), F.explode(refs).alias("r"))
    names = sorted({a.strip().lower() for a in allowed or []})
    own = F.lower("r.repo") == F.lower("repo")
    listed = F.lower("r.repo").isin(*names) if names else F.lit(False)
    return rows.select("repo", "pr_number", F.col("r.repo").alias("issue_repo"), F.col("r.number").alias("issue_number"), (own | listed).alias("allowed"))


def with_issues(raw: DataFrame, issues: DataFrame, allowed: list[str] | None = None) -> DataFrame:
    """raw with the linked issues among `issues` (repo, number, title, body, state, html_url, pull_request); pull requests are no issues."""
    real = issues.where(F.col("pull_request").isNull()).select(F.lower("repo").alias("k"), F.col("number").alias("n"), "title", "body", "state", "html_url")
    want = wanted_issues(raw, allowed).where("allowed")
    met = want.join(real, (F.lower("issue_repo") == F.col("k")) & (F.col("issue_number") == F.col("n")))
    item = F.struct(F.col("n").alias("number"), F.col("issue_repo").alias("repo"), redact(F.col("title")).alias("title"), redact(or_empty(F.col("body"))).alias("body"), "state", "html_url", F.lit(True).alias("closed_by_pr"), F.lit(None).cast("boolean").alias("synthetic"))
    packed = met.groupBy("repo", "pr_number").agg(F.array_sort(F.collect_list(item)).alias("found"))
    joined = raw.join(packed, (F.col("source.repo") == packed["repo"]) & (F.col("source.pr_number") == packed["pr_number"]), "left").drop("repo", "pr_number")
    kept = F.coalesce(F.col("found").cast(_type("linked_issues")), F.col("linked_issues"))
    return joined.withColumn("linked_issues", kept).drop("found")
