"""Raw pull-request records to trajectories: narrow projections, and lookups of cards and overrides."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.bots import strip_boilerplate
from ..functions.links import source_urls
from ..functions.redact import redact
from ..functions.text import filled, outline
from ..operators import evidence, issues, labels, patch, quality, signals
from ..schemas import TRAJECTORY


def normalize(raw: DataFrame, card: str | None = None, overrides: DataFrame | None = None, shortlist: DataFrame | None = None, max_patch_bytes: int = patch.MAX_BYTES) -> DataFrame:
    """One trajectory a record. card: JSON text of the dataset's card; shortlist: fixed scores (repo as written, pr, quality).

    raw may carry `sidecar_text`, the diff kept beside a record. The only joins are with tables of overrides and fixed
    scores, reduced to a row a pull request: they are broadcast, and the wide records stay in their partitions, as
    long as they are counted to be of at most labels.BROADCAST_PULLS rows; larger ones are joined by shuffle.
    """
    if "sidecar_text" not in raw.columns:
        raw = raw.withColumn("sidecar_text", F.lit(None).cast("string"))
    c = labels.card_column(card)
    row = labels.with_overrides(raw, overrides).withColumn("card", c)
    if shortlist is not None:
        fixed = labels.beside(shortlist.groupBy("repo", "pr").agg(F.max("quality").alias("fixed")))
        row = row.join(fixed, (F.col("source.repo") == fixed["repo"]) & (F.col("source.pr_number") == fixed["pr"]), "left").drop(fixed["repo"], fixed["pr"])
    else:
        row = row.withColumn("fixed", F.lit(None).cast("double"))
    col = F.col
    row = row.withColumns({
        "repo_name": F.coalesce(filled(col("source.repo")), filled(col("card.source_repo")), F.lit("unknown/unknown")),
        "number": F.coalesce(col("source.pr_number"), F.lit(0)),
        "clean_body": strip_boilerplate(col("pull.body")),
    })
    row = row.withColumn("outlined", outline(col("clean_body")))
    carded = labels.json_text(labels.by_number(col("card.linked_issues_by_pr"), col("number")))
    row = row.withColumn("linked", issues.linked_issues(col("repo_name"), col("number"), col("linked_issues"), col("pull.body"), col("commits"), carded, col("table")["linked_issues"]))
    row = row.withColumns({
        "context": issues.issue_context(col("linked"), col("clean_body"), col("pull.title"), col("outlined")),
        "signals": signals.review_signals(col("reviews"), col("review_comments"), col("issue_comments")),
        "events": evidence.validation_events(col("outlined"), col("checks.check_runs"), col("checks.combined_status")),
        "outcome": labels.outcome(col("pull.merged"), col("pull.state")),
        "use": labels.training_use(col("table"), col("card"), col("number")),
    })
    has_signals = F.size("signals") > 0
    title = F.concat(F.lit("PR "), col("repo_name"), F.lit("#"), col("number").cast("string"), F.lit(": "), F.coalesce(filled(col("pull.title")), F.concat_ws("-", F.replace("repo_name", F.lit("/"), F.lit("-")), "number")))
    out = row.withColumn("context", F.when(col("context").isNull() & ~has_signals, title).otherwise(col("context")))
    score = F.coalesce("fixed", quality.heuristic(col("outcome"), col("context"), col("signals"), col("events"), F.size("commits"), col("collection_meta.warnings")))
    chosen = {
        "id": F.concat_ws("-", F.replace("repo_name", F.lit("/"), F.lit("-")), col("number").cast("string")),
        "repo": col("repo_name"), "pr_number": col("number"),
        "source_urls": source_urls(col("repo_name"), col("number"), F.transform("linked", lambda i: i["html_url"])),
        "language": labels.language(col("table"), col("card"), col("number"), F.transform("files", lambda f: f["filename"])),
        "domain": labels.domain(col("table"), col("card"), col("number"), col("pull.labels")),
        "task_type": labels.task_type(col("table"), col("card"), col("number"), col("pull.title"), col("pull.labels")),
        "before_context": redact(patch.before_context(col("pull.title"), col("outlined"), col("files"))),
        "patch": redact(patch.patch(col("diff.inline"), col("sidecar_text"), col("files"), max_patch_bytes)),
        "validation": col("events"), "outcome": col("outcome"),
        "training_use": F.when((col("use") == "review-to-patch") & ~has_signals, "other").otherwise(col("use")),
        "issue_context": redact(col("context")), "review_signals": F.when(has_signals, col("signals")), "quality_score": score,
    }
    return out.select(*[chosen[f.name].cast(f.dataType).alias(f.name) for f in TRAJECTORY.fields])
