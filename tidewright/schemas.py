"""Types of raw pull-request records and of trajectories. Nested JSON is read with these, never inferred."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, BooleanType, DataType, DoubleType, IntegerType, LongType, MapType, StringType, StructField, StructType, VariantType

ATOMS = {"string": StringType, "int": IntegerType, "bigint": LongType, "boolean": BooleanType, "double": DoubleType, "variant": VariantType}


def _split(text: str) -> list[str]:
    """The parts of text between commas that lie in no brackets."""
    out, depth, start = [], 0, 0
    for i, c in enumerate(text):
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append(text[start:i])
            start = i + 1
    return [x.strip() for x in (*out, text[start:]) if x.strip()]


def parse_type(text: str) -> DataType:
    """A type as it is written in a schema; no session is needed for it, in contrast to Spark's own parser."""
    text = text.strip()
    if text in ATOMS:
        return ATOMS[text]()
    kind, _, inner = text[:-1].partition("<")
    if kind == "array":
        return ArrayType(parse_type(inner))
    if kind == "map":
        return MapType(*map(parse_type, _split(inner)))
    return parse_fields(inner)


def parse_fields(text: str) -> StructType:
    parts = [part.replace(":", " ", 1).split(None, 1) if "<" not in part.split(None, 1)[0] else part.split(":", 1) for part in _split(text)]
    return StructType([StructField(name.strip(), parse_type(kind)) for name, kind in parts])


RAW = parse_fields("""
schema_version string, collected_at string, collector_version string,
source struct<repo: string, pr_number: int, html_url: string, api_urls: struct<pull: string>>,
pull struct<title: string, body: string, state: string, merged: boolean, merged_at: string, user_login: string, labels: array<string>, base_sha: string, head_sha: string,
    merge_commit_sha: string, additions: bigint, deletions: bigint, changed_files: bigint, draft: boolean, commits: bigint, comments: bigint, review_comments: bigint>,
issue_comments array<struct<id: bigint, user_login: string, user_type: string, created_at: string, body: string, author_association: string>>,
review_comments array<struct<id: bigint, user_login: string, user_type: string, path: string, line: bigint, body: string, diff_hunk: string, created_at: string, in_reply_to_id: bigint, author_association: string>>,
reviews array<struct<id: bigint, user_login: string, user_type: string, state: string, body: string, submitted_at: string>>,
commits array<struct<sha: string, message: string, author_login: string, date: string>>,
files array<struct<filename: string, status: string, additions: bigint, deletions: bigint, changes: bigint, patch: string, patch_truncated: boolean>>,
diff struct<inline: string, sidecar_path: string, bytes: bigint, truncated: boolean>,
checks struct<check_runs: array<struct<name: string, status: string, conclusion: string, html_url: string>>, combined_status: struct<state: string, statuses: array<struct<context: string, state: string, description: string>>>>,
linked_issues array<struct<number: bigint, repo: string, title: string, body: string, state: string, html_url: string, closed_by_pr: boolean, synthetic: boolean>>,
collection_meta struct<authenticated: boolean, endpoints_called: array<string>, warnings: array<string>>
""")

SIGNAL = "struct<author: string, comment: string, suggestion: string>"
EVENT = "struct<type: string, result: string, detail: string>"
TRAJECTORY = parse_fields(f"""
id string, repo string, pr_number int, source_urls array<string>, language string, domain string, task_type string, before_context string, patch string,
validation array<{EVENT}>, outcome string, training_use string, issue_context string, review_signals array<{SIGNAL}>, quality_score double
""")

# The vocabularies of a trajectory.
TASKS = ("bugfix", "feature", "refactor", "docs", "test", "perf", "security", "chore", "other")
OUTCOMES = ("merged", "closed", "open", "superseded", "abandoned")
USES = ("repair", "validation", "feature", "review-to-patch", "autocomplete", "bug-prediction", "other")
EVENT_TYPES = ("test", "ci", "manual", "review", "other")
RESULTS = ("pass", "fail", "flaky")

MANIFEST = parse_fields("""
name string, schema_version string, created_at string, created_by string, source_repo string, jsonl_path string, record_count int, sha256 string, bytes bigint,
records array<struct<id: string, pr_number: int, training_use: string, task_type: string, domain: string, language: string, quality_score: double, outcome: string, has_issue_context: boolean,
    review_signal_count: int, unique_review_signal_count: int, patch_chars: int, validation_count: int, source_url_count: int>>
""")

#: Dataset cards hold hand-written maps: each value keeps its own JSON type, so one of an odd type spoils no other.
CARD = parse_fields("""
name string, source_repo string, schema_version string, language string, domains array<string>, domain_by_pr map<string,variant>, task_type_by_pr map<string,variant>,
language_by_pr map<string,variant>, linked_issues_by_pr map<string,variant>, training_use_buckets map<string,array<int>>
""")
