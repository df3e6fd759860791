"""Commands: list, collect, normalize, validate, manifest, status.

    python -m tidewright.cli normalize --raw-dir raw --card card.json

They end with 0 when all went well, 1 for failed records or stale files, 2 for what can't be begun with.
"""

from __future__ import annotations

import argparse
import json
import re
import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import session
from .operators import checks, manifest
from .operators.funnel import parse_numbers
from .plans.collect import issue_rows, raw_records, wanted_issues, with_issues
from .plans.trajectory import normalize
from .sources import files, rest, sinks


class Unusable(Exception):
    """Arguments or settings that nothing can be begun with."""


def say(*parts: object) -> None:
    print(*parts, file=sys.stderr)


def absolute(path: str | Path) -> str:
    """For Spark's readers, whose working folder need not be this one."""
    return str(Path(path).resolve())


def repository(text: str) -> str:
    bare = re.sub(r"(?i)\Ahttps?://github\.com/", "", text.strip().strip("/"))
    if not re.fullmatch(r"[^/\s]+/[^/\s]+", bare):
        raise Unusable(f"not a repository: {text!r}")
    return bare


def numbers(given: list[str] | None) -> list[int]:
    try:
        return list(dict.fromkeys(n for part in given or [] for n in parse_numbers(part)))
    except ValueError as e:
        raise Unusable(str(e)) from e


def client_of(args) -> rest.Client:
    client = rest.Client(rest.token_from_env(args.token_env))
    if args.fixtures:
        client.fetch, client.sleep = rest.fixture_fetch(args.fixtures), lambda s: None
    return client


def list_(args) -> int:
    repo = repository(args.repo)
    if args.limit < 1:
        raise Unusable("--limit must be at least 1")
    try:
        found = rest.list_merged(client_of(args), repo, args.limit)
    except rest.HostError as e:
        say(e)
        return 1
    only = ",".join(str(p["number"]) for p in found)
    if args.numbers_only:
        print(only)
    elif args.json:
        print(json.dumps(found, indent=2))
    else:
        print(f"# {repo}: {len(found)} merged PR(s) (limit={args.limit})")
        for p in found:
            print(f"  #{p['number']:>4}  {p['merged_at'][:10]}  {p['title'][:72]}")
        print(f"# numbers: {only}")
    return 0


def reader(spark: SparkSession, args, onerror: str = "row"):
    session.ship(spark)
    spark.dataSource.register(rest.RestSource)
    read = spark.read.format("code_host").option("tokenenv", args.token_env).option("partitions", args.partitions).option("onerror", onerror)
    return read.option("fixtures", args.fixtures) if args.fixtures else read


def with_linked(spark: SparkSession, args, rows: DataFrame) -> DataFrame:
    """Raw records with the issues that they close, each asked for once; the list of issues is bounded by the numbers asked for."""
    want = wanted_issues(rows, args.allow_cross_repo)
    asked = [f"{r.issue_repo}#{r.issue_number}" for r in want.where("allowed").select("issue_repo", "issue_number").distinct().orderBy("issue_repo", "issue_number").collect()]
    schema = "repo string, number int, endpoint string, payload string"
    got = reader(spark, args).option("issues", ",".join(asked)).load().cache() if asked else spark.createDataFrame([], schema)
    rows = with_issues(rows, issue_rows(got), args.allow_cross_repo)
    key = lambda repo, number: (F.lower(repo).alias("k_repo"), number.cast("bigint").alias("k_number"))
    failed = got.where("endpoint = 'warning'").select(*key(F.col("repo"), F.col("number")), F.col("payload").alias("said"))
    said = want.where("allowed").select("repo", "pr_number", *key(F.col("issue_repo"), F.col("issue_number"))).join(failed, ["k_repo", "k_number"]).select("repo", "pr_number", "said")
    skipped = F.concat(F.lit("linked_issue_"), F.col("issue_number").cast("string"), F.lit("_skipped: cross-repo "), F.col("issue_repo"), F.lit(" not in allowlist (pass --allow-cross-repo "), F.col("issue_repo"), F.lit(")"))
    said = said.unionByName(want.where("not allowed").select("repo", "pr_number", skipped.alias("said")))
    more = said.groupBy(F.col("repo").alias("w_repo"), F.col("pr_number").alias("w_number")).agg(F.array_sort(F.collect_set("said")).alias("w_said"))
    rows = rows.join(more, (F.col("source.repo") == F.col("w_repo")) & (F.col("source.pr_number") == F.col("w_number")), "left")
    told = F.concat("collection_meta.warnings", F.coalesce("w_said", F.array().cast("array<string>")))
    return rows.withColumn("collection_meta", F.col("collection_meta").withField("warnings", told)).drop("w_repo", "w_number", "w_said")


def collect(args) -> int:
    """All numbers in one query; without --continue-on-error numbers behind the first that fails are not written."""
    repo, wanted = repository(args.repo), numbers(args.pr)
    if not wanted:
        raise Unusable("no pull requests")
    folder = sinks.raw_dir(args.out_dir, repo)
    if args.dry_run:
        print(f"Would collect {repo} PRs {wanted} → {folder}" + (" (with --skip-existing)" if args.skip_existing else ""))
        return 0
    there = [n for n in wanted if args.skip_existing and (Path(folder) / f"pr-{n}.json").exists()]
    todo, failed, done = [n for n in wanted if n not in there], {}, 0
    if todo:
        spark = session.build("collect")
        skip = ",".join(k for k in ("diff", "checks") if getattr(args, f"skip_{k}"))
        payloads = reader(spark, args).option("repo", repo).option("numbers", ",".join(map(str, todo))).option("skip", skip).load().cache()
        failed = {r.number: r.payload for r in payloads.where("endpoint = 'error'").select("number", "payload").collect()}
        stop = next((i for i, n in enumerate(todo) if n in failed), len(todo)) if not args.continue_on_error else len(todo)
        good = [n for n in todo[:stop] if n not in failed]
        for n in todo[: stop + 1]:
            if n in failed:
                say(f"Failed {repo}#{n}: {failed[n]}")
        if good:
            rows = raw_records(payloads.where(F.col("number").isin(good)), authenticated=client_of(args).token is not None).cache()
            done = sinks.write_raw_files(with_linked(spark, args, rows), folder, args.max_inline_diff_bytes)
            rows.unpersist()
        payloads.unpersist()
    say(f"{done} collected, {len(there)} skipped, {len(failed)} failed → {folder}")
    return 1 if failed else 0


def card_of(path: str | None) -> str | None:
    try:
        text = files.card(path)
        json.loads(text or "{}")
    except (OSError, ValueError) as e:
        raise Unusable(f"card {path}: {e}") from e
    return text


def normalize_(args) -> int:
    if not Path(args.raw_dir).is_dir():
        raise Unusable(f"raw-dir not found: {args.raw_dir}")
    card = card_of(args.card)
    try:
        out = args.out or str(Path("datasets/jsonl") / sinks.output_name(json.loads(card or "{}").get("name")))
    except ValueError as e:
        raise Unusable(f"no --out, and {e}") from e
    wanted = numbers(args.pr)
    if not any(Path(args.raw_dir).glob("pr-*.json")):
        say(f"no pr-*.json in {args.raw_dir}")
        return 1
    spark = session.build("normalize")
    folder = absolute(args.raw_dir)
    raw = files.with_sidecars(files.raw_records(spark, folder), folder)
    if wanted:
        raw = raw.where(F.col("source.pr_number").isin(wanted))
    overrides = spark.read.schema("repo_key string, pr int, field string, value string").json(args.overrides) if args.overrides else None
    try:
        print(f"Wrote {sinks.write_trajectories(normalize(raw, card, overrides, max_patch_bytes=args.max_patch_bytes), out)} records to {out}")
    except sinks.BadRecords as e:
        say(e)
        return 1
    return 0


def validate(args) -> int:
    spark, bad = session.build("validate"), []
    for path in map(Path, args.files):
        if not path.is_file():
            found = [f"  ERROR: File not found: {path}"]
        else:
            lines = files.json_lines(spark, absolute(path))
            rows = checks.validate_lines(lines, args.strict_policy).orderBy("line", "path", "message")
            found = [f"  {r.file}:{r.line} " + (f"[{r.path}] - " if r.path else "- ") + r.message for r in rows.toLocalIterator()]
            if lines.isEmpty():
                found = [f"  {path.name} - no non-empty JSONL records"]
        print(f"  ✗ {path.name} ({len(found)} error(s))" if found else f"  ✓ {path.name}")
        bad += found
    print("\n".join(["\nValidation FAILED:", *bad]) if bad else "\nAll files passed validation.")
    return 1 if bad else 0


def manifest_(args) -> int:
    path = Path(args.jsonl)
    card = json.loads(card_of(args.card or f"datasets/cards/{path.stem}.json") or "{}")
    out = Path(args.out or f"datasets/manifests/{path.stem}.manifest.json")
    old = json.loads(out.read_text(encoding="utf-8")) if out.exists() else {}
    at, by = args.created_at or old.get("created_at"), args.created_by or old.get("created_by")
    if not at or not by:
        raise Unusable(f"no manifest at {out} to take the date and author from; pass --created-at and --created-by")
    spark = session.build("manifest")
    digest = manifest.file_digest(spark.read.format("binaryFile").load(absolute(path))).first()
    rows = files.trajectories(spark, absolute(path)).select(F.to_json(F.struct(*manifest.record_row()), {"ignoreNullFields": "false"}).alias("row"))
    records = [json.loads(r.row) for r in rows.collect()]
    made = {
        "name": path.stem, "schema_version": str(card.get("schema_version") or "pr_trajectory_v0"), "created_at": str(at), "created_by": str(by), "source_repo": str(card.get("source_repo") or ""),
        "jsonl_path": path.as_posix(), "record_count": len(records), "sha256": digest.sha256, "bytes": digest.bytes, "records": records,
    }
    fresh = sinks.write_manifest(made, str(out), args.check)
    if args.check and not fresh:
        say(f"ERROR: {out.name} is out of date with {path.name}")
        return 1
    print(f"{out.name} {'is up to date' if fresh else 'written'} ({len(records)} records).")
    return 0


def status(args) -> int:
    spark, stale, touched = session.build("status"), [], []
    folder = Path(args.manifest_dir)
    if any(folder.glob("*.manifest.json")):
        block = manifest.status_block(files.manifests(spark, absolute(folder)), args.begin, args.end)
        touched.append((args.status, sinks.write_region(args.status, block, args.begin, args.end, args.check)))
    elif args.check:
        say(f"ERROR: no manifests found in {folder}; refusing to report {args.status} as up to date")
        return 1
    else:
        say(f"No manifests in {folder}; skipping {args.status}.")
    index = Path(args.docs_dir) / "_index.md"
    block = manifest.index_block(files.pages(spark, absolute(args.docs_dir)), args.index_begin, args.end)
    touched.append((str(index), sinks.write_region(str(index), block, args.index_begin, args.end, args.check)))
    for path, fresh in touched:
        stale += [] if fresh else [path]
        print(f"{Path(path).name} {'up to date' if fresh else 'out of date' if args.check else 'written'}.")
    return 1 if args.check and stale else 0


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tidewright", description=__doc__)
    commands = p.add_subparsers(required=True)

    def add(name: str, run, *options: tuple) -> None:
        sub = commands.add_parser(name)
        for flag, kw in options:
            sub.add_argument(flag, **kw)
        sub.set_defaults(run=run)

    on, many = {"action": "store_true"}, {"action": "append"}
    host = (("--token-env", {"default": "GITHUB_TOKEN"}), ("--fixtures", {"help": "a folder of answers instead of the host"}))
    at_once = ("--partitions", {"type": int, "default": rest.PARTITIONS, "help": "how many tasks ask the host at once"})
    add("list", list_, ("--repo", {"required": True}), ("--limit", {"type": int, "default": 50}), ("--numbers-only", on), ("--json", on), *host)
    add(
        "collect", collect, ("--repo", {"required": True}), ("--pr", many | {"required": True}), ("--out-dir", {}), ("--skip-existing", on), ("--skip-checks", on), ("--skip-diff", on),
        ("--allow-cross-repo", many), ("--max-inline-diff-bytes", {"type": int, "default": sinks.MAX_INLINE}), ("--continue-on-error", on), ("--dry-run", on), at_once, *host,
    )
    add("normalize", normalize_, ("--raw-dir", {"required": True}), ("--card", {}), ("--out", {}), ("--pr", many), ("--overrides", {"help": "JSON lines of (repo_key, pr, field, value)"}), ("--max-patch-bytes", {"type": int, "default": 96 * 1024}))
    add("validate", validate, ("files", {"nargs": "+"}), ("--strict-policy", on))
    add("manifest", manifest_, ("--jsonl", {"required": True}), ("--card", {}), ("--out", {}), ("--created-at", {}), ("--created-by", {}), ("--check", on))
    add(
        "status", status, ("--manifest-dir", {"default": "datasets/manifests"}), ("--status", {"default": "STATUS.md"}), ("--docs-dir", {"default": "docs"}), ("--check", on),
        ("--begin", {"default": manifest.BEGIN}), ("--index-begin", {"default": manifest.BEGIN}), ("--end", {"default": manifest.END}),
    )
    return p


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    try:
        return args.run(args)
    except (Unusable, FileNotFoundError) as e:
        say(f"ERROR: {e}")
        return 2
    except ValueError as e:
        say(f"ERROR: {e}")
        return 1


if __name__ == "__main__":
    sys.exit(main())
