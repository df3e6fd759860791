"""Operators on small records, and the whole plan on one."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from tidewright import schemas
from tidewright.functions.text import outline
from tidewright.operators import checks, evidence, funnel, issues, labels, manifest, patch, quality, signals
from tidewright.plans.collect import issue_rows, raw_records, wanted_issues, with_issues
from tidewright.plans.trajectory import normalize
from tidewright.sources import files, rest, sinks

CHECK = "array<struct<name:string,status:string,conclusion:string,html_url:string>>"


def raw(spark, *records):
    return spark.read.schema(schemas.RAW).json(spark.sparkContext.parallelize([json.dumps(r) for r in records], 1))


def record(**kw):
    return {"source": {"repo": "Acme/widget", "pr_number": 89}, "pull": {"title": "t", "state": "open"}} | kw


def signals_of(spark, k=8, **kw):
    df = raw(spark, record(**kw))
    return [r.asDict() for r in df.select(signals.review_signals(F.col("reviews"), F.col("review_comments"), F.col("issue_comments"), k).alias("s")).first().s]


def review(body, state="COMMENTED", login="ann"):
    return {"user_login": login, "user_type": "User", "state": state, "body": body}


def test_signals_short_reviews_need_a_decision(spark):
    got = signals_of(spark, reviews=[review("LGTM", "APPROVED"), review("ok"), review("", "CHANGES_REQUESTED"), review("This one is long enough.")])
    assert [s["comment"] for s in got] == ["LGTM (review state: APPROVED)", "Review state: CHANGES_REQUESTED", "This one is long enough."]


def test_signals_merge_and_keep_suggestions(spark):
    said = "Please use a guard here for safety."
    got = signals_of(spark, reviews=[review(said)], review_comments=[{"user_login": "bob", "body": said + "\n```suggestion\nguard();\n```"}])
    assert got == [{"author": "ann", "comment": said, "suggestion": "guard();"}]


def test_signals_keep_different_fences_apart(spark):
    got = signals_of(spark, review_comments=[{"user_login": "a", "body": f"Same prose.\n```rust\n{x}\n```"} for x in "xy"])
    assert len(got) == 2


def test_signals_problems_first_with_one_place_for_an_ack(spark):
    acks = [{"user_login": "a", "body": f"Fixed in commit {h}: moved it"} for h in ("abc1234", "def5678", "aaa9999")]
    found = [{"user_login": "b", "body": f"Finding number {i} of the review"} for i in range(11)]
    got = signals_of(spark, review_comments=acks + found)
    assert [s["comment"][:7] for s in got] == ["Finding"] * 7 + ["Fixed i"] and "abc1234" in got[-1]["comment"]
    assert [s["comment"][:7] for s in signals_of(spark, k=1, review_comments=acks + found)] == ["Finding"]
    assert signals_of(spark, k=0, review_comments=found) == []


def test_signals_drop_bots_wrappers_and_bare_acks(spark):
    got = signals_of(
        spark, reviews=[review("### Codex Review\nall of the wrapper text")], review_comments=[{"user_login": "x[bot]", "body": "a"}, {"user_login": "a", "body": "Fixed in 0b05325."}],
        issue_comments=[{"user_login": "a", "body": "short"}, {"user_login": "a", "body": "long enough to be kept as it is"}],
    )
    assert [s["comment"] for s in got] == ["long enough to be kept as it is"]


def loop(cands, k):
    """A plain reading of the rules, one candidate after the other."""
    kept, order = {}, []
    for c in cands:
        if c["key"] not in kept:
            kept[c["key"]] = dict(c)
            order.append(c["key"])
        elif kept[c["key"]]["ack"] and not c["ack"]:
            kept[c["key"]] = dict(c) | {"suggestion": c["suggestion"] or kept[c["key"]]["suggestion"]}
        elif not kept[c["key"]]["suggestion"] and c["suggestion"]:
            kept[c["key"]]["suggestion"] = c["suggestion"]
    problems, acks = ([kept[x] for x in order if kept[x]["ack"] is a] for a in (False, True))
    reserve = 1 if problems and acks and k > 1 else 0
    return (problems[: k - reserve] + acks)[:k] if k > 0 else []


def test_merge_and_top_k_equal_a_plain_loop(spark):
    rnd = random.Random(5)
    rows = []
    for i in range(300):
        rows.append((i, rnd.randint(0, 4), [{"author": str(j), "comment": "c", "suggestion": rnd.choice([None, "", f"s{j}"]), "key": rnd.choice("abc"), "ack": rnd.random() < 0.5} for j in range(rnd.randint(0, 7))]))
    df = spark.createDataFrame(rows, "i int, k int, c array<struct<author:string,comment:string,suggestion:string,key:string,ack:boolean>>")
    for k in range(5):
        got = df.where(F.col("k") == k).select("i", signals.problem_first(signals.merged(F.col("c")), k).alias("s")).collect()
        for r in got:
            want = loop(rows[r.i][2], k)
            assert [(s.author, s.key, s.ack, s.suggestion or None) for s in r.s] == [(w["author"], w["key"], w["ack"], w["suggestion"] or None) for w in want]


@pytest.mark.parametrize(
    ("runs", "combined", "want"),
    [
        ([("ci", "completed", "success")], ("pending", 0), [("ci", "pass")]),
        ([("ci", "completed", "success"), ("Code Review", "completed", "failure")], ("success", 1), [("ci", "pass"), ("ci", "pass"), ("other", "fail")]),
        ([("CodeRabbit", "completed", "success")], None, [("other", "fail"), ("other", "pass")]),
        ([("CodeQL", "completed", "failure"), ("Snyk", "completed", "success")], None, [("ci", "fail")]),
        ([("a", "completed", "skipped"), ("b", "completed", "neutral")], None, [("ci", "fail")]),
        ([("a", "completed", "success"), ("b", "completed", "skipped")], None, [("ci", "pass")]),
        ([("a", "in_progress", None), ("b", "completed", "success")], None, [("ci", "fail")]),
        ([], ("failure", 0), [("ci", "fail")]),
        ([], None, [("other", "fail")]),
    ],
)
def test_validation_events(spark, runs, combined, want):
    checks_ = {"check_runs": [dict(zip(("name", "status", "conclusion"), r)) for r in runs]}
    if combined:
        checks_["combined_status"] = {"state": combined[0], "statuses": [{"context": "x"}] * combined[1]}
    df = raw(spark, record(checks=checks_))
    got = df.select(evidence.validation_events(outline(F.lit("no section")), F.col("checks.check_runs"), F.col("checks.combined_status")).alias("e")).first().e
    assert [(e.type, e.result) for e in got] == want


def test_check_names_count_before_they_are_left_out(spark):
    runs = [("", "completed", "x")] + [(f"n{i}", "queued", None) for i in range(12)]
    df = spark.createDataFrame([([(*r, None) for r in runs],)], f"c {CHECK}")
    assert df.select(evidence.check_names(F.col("c")).alias("n")).first().n == ", ".join(f"n{i}=queued" for i in range(11))


def test_linked_issues(spark):
    df = raw(spark, record(
        pull={"body": "Closes #74, #89 and fixes other/x#2"}, commits=[{"message": "resolves #80"}],
        linked_issues=[{"number": 74, "repo": "acme/WIDGET", "title": "Leak", "html_url": "u"}, {"number": 89, "repo": "acme/widget"}],
    ))
    got = lambda card: [(r.repo, r.number, r.closed_by_pr) for r in df.select(issues.linked_issues(F.lit("Acme/widget"), F.lit(89), F.col("linked_issues"), F.col("pull.body"), F.col("commits"), F.lit(card).cast("string"), F.lit("[5]")).alias("l")).first().l]
    base = [("acme/WIDGET", 74, None), ("Acme/widget", 80, True), ("other/x", 2, True)]
    assert got('["7", 0, -1, "x", "²", 7, true]') == [*base, ("Acme/widget", 7, False)]
    assert got("9") == [*base, ("Acme/widget", 9, False)]
    assert got("true") == got(None) == [*base, ("Acme/widget", 5, False)]


def test_precedence_of_labels(spark):
    card = json.dumps({"source_repo": "Acme/widget", "language": "Rust", "domains": ["tools"], "domain_by_pr": {"89": " ml ", "90": 7, "x": "y"}, "task_type_by_pr": {"89": ["perf"]}, "training_use_buckets": {"repair": [89, 90], "strange": [90]}})
    rows = raw(spark, record(), record(source={"repo": "acme/Widget", "pr_number": 90}, pull={"title": "fix: x"}), record(source={"repo": "Acme/widget", "pr_number": 91}))
    table = labels.override_table(spark, [(" ACME/widget", 89, "training_use", "validation"), ("acme/widget", 89, "domain", "no"), ("acme/widget", 90, "domain", "table")])
    got = {r.pr_number: r for r in normalize(rows, card, table).collect()}
    assert (got[89].training_use, got[89].domain, got[89].task_type, got[89].language) == ("validation", "ml", "other", "Rust")
    assert (got[90].training_use, got[90].domain, got[90].task_type) == ("other", "table", "bugfix")
    assert (got[91].training_use, got[91].domain) == ("other", "tools")


def test_a_field_stated_twice_has_one_value(spark):
    rows = [("acme/widget", 89, "domain", "b"), ("acme/widget", 89, "domain", "a"), ("acme/widget", 89, "language", "Zig"), ("acme/widget", 90, None, "x")]
    table = labels.override_table(spark, [r for r in rows if r[2]])
    assert labels.override_map(table).where("pr = 89").first()["table"] == {"domain": "b", "language": "Zig"}
    late = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], labels.OVERRIDES + ", at int")
    assert {r.pr: r["table"] for r in labels.override_map(late).collect()} == {89: {"domain": "a", "language": "Zig"}}
    assert normalize(raw(spark, record()), None, late).first().domain == "a"
    scores = spark.createDataFrame([("Acme/widget", 89, 0.5)] * 2, labels.QUALITY)
    assert [r.quality_score for r in normalize(raw(spark, record()), None, late, scores).collect()] == [0.5]


def test_wide_records_are_not_shuffled_for_lookups(spark, monkeypatch):
    table = labels.override_table(spark, [("acme/widget", 89, "domain", "b")])
    def joins(df):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        return "strategy=broadcast" in plan

    assert joins(labels.with_overrides(raw(spark, record()), table))
    monkeypatch.setattr(labels.beside, "__defaults__", (0,))
    assert not joins(labels.with_overrides(raw(spark, record()), table))


def test_card_values_keep_their_types(spark):
    said = {"1": "2024", "2": 2024, "3": "true", "4": True, "5": None, "6": ["x"], "7": " y ", "8": " ", "9": {"a": 1}}
    card = json.dumps({"source_repo": "Acme/widget", "domain_by_pr": said, "linked_issues_by_pr": {"1": "7", "2": 8, "3": ["9", 10, True], "4": None, "5": True}})
    rows = raw(spark, *[record(source={"repo": "Acme/widget", "pr_number": n}) for n in range(1, 10)])
    got = {r.pr_number: r for r in normalize(rows, card).collect()}
    assert {n: r.domain for n, r in got.items()} == {1: "2024", 3: "true", 7: "y"} | dict.fromkeys((2, 4, 5, 6, 8, 9), "systems")
    linked = {n: [int(u.rsplit("/", 1)[1]) for u in r.source_urls[1:]] for n, r in got.items()}
    assert linked == {1: [7], 2: [8], 3: [9, 10], **{n: [] for n in range(4, 10)}}
    assert {(r.field, r.pr): r.value for r in labels.card_overrides(spark, card).where("pr < 4").collect()} == {
        ("domain", 1): "2024", ("domain", 2): "2024", ("domain", 3): "true", ("linked_issues", 1): "7", ("linked_issues", 2): "8", ("linked_issues", 3): '["9",10,true]',
    }


def test_nothing_is_stated_twice(spark):
    card = json.dumps({"source_repo": "Acme/widget", "domain_by_pr": {"89": "a", "x": "b"}, "linked_issues_by_pr": {"7": [1]}})
    table = labels.override_table(spark, [("acme/widget", 89, "domain", "t"), ("acme/widget", 89, "task_type", "t"), ("other/x", 7, "linked_issues", "[1]")])
    assert [tuple(r) for r in labels.stated_twice(labels.card_overrides(spark, card), table).collect()] == [("acme/widget", 89, "domain")]


def test_shortlist_is_case_sensitive(spark):
    rows = raw(spark, record(), record(source={"repo": "acme/widget", "pr_number": 89}))
    fixed = spark.createDataFrame([("Acme/widget", 89, 0.92)], labels.QUALITY)
    assert sorted(r.quality_score for r in normalize(rows, None, None, fixed).collect()) == [0.6, 0.92]


def test_quality_arithmetic(spark):
    df = spark.range(1)
    score = lambda *a: df.select(quality.heuristic(*a).alias("s")).first().s
    some, passed = F.array(F.lit(1)), F.array(F.struct(F.lit("pass").alias("result")))
    none = F.array().cast("array<struct<result:string>>")
    assert score(F.lit("merged"), F.lit("c"), some, passed, F.lit(3), F.array(F.lit("x"))) == 0.95
    assert score(F.lit("open"), F.lit(""), F.array(), none, F.lit(2), F.array(F.lit("redacted y"))) == 0.45


def test_patch_budget_and_fallbacks(spark):
    rec = record(files=[{"filename": "a.rs", "status": "modified", "additions": 1, "deletions": 2, "patch": "+é"}, {"filename": "gone.bin", "status": "added"}, {"filename": "old", "status": "removed"}, {"filename": "x/.env", "patch": "s"}])
    of = lambda r, n=96 * 1024: raw(spark, r).select(patch.patch(F.col("diff.inline"), F.lit(None).cast("string"), F.col("files"), n).alias("p")).first().p
    assert of(rec) == "--- a/a.rs\n+++ b/a.rs\n+é\n# omitted: gone.bin (patch unavailable / truncated from files API)"
    assert of(record(files=[{"filename": ".env"}])) == "# Patch unavailable from API; changed files: (none)\n"
    long = of(rec | {"diff": {"inline": "é" * 5000}}, 3000)
    head = "# Truncated unified diff for training (full raw under datasets/raw/; 10000 bytes, 3 files)\n# modified: a.rs (+1/-2)\n"
    assert long.startswith(head) and long.endswith("\n\n# … truncated …\n") and len(long.encode()) <= 3000 and set(long[len(head) :].split("\n\n")[1]) == {"é"}


def test_outcomes(spark):
    df = spark.createDataFrame([(True, "closed"), (False, "CLOSED"), (None, "open"), (False, None)], "m boolean, s string")
    assert [r.o for r in df.select(labels.outcome(F.col("m"), F.col("s")).alias("o")).collect()] == ["merged", "closed", "open", "abandoned"]


def test_trajectory_is_valid_and_context_falls_back(spark):
    t = normalize(raw(spark, record(), record(source={"repo": "a/b", "pr_number": 2}, pull={"state": "open"})))
    assert [r.n for r in t.select(F.size(checks.shape_problems()).alias("n")).collect()] == [0, 0]
    assert {r.issue_context for r in t.collect()} == {"t", "PR a/b#2: a-b-2"}


def test_lines_are_checked(spark, tmp_path):
    good = json.loads(normalize(raw(spark, record())).toJSON().first())
    lines = [json.dumps(good), "", "{broken", json.dumps(good | {"extra": 1, "outcome": "lost"}), json.dumps(good | {"patch": "in /home/ann/x", "source_urls": ["https://github.com/a/b/pull/1"]})]
    (tmp_path / "x.jsonl").write_text("\n".join(lines) + "\n")
    got = [(r.line, r.path, r.message) for r in checks.validate_lines(files.json_lines(spark, str(tmp_path / "x.jsonl")), strict=True).orderBy("line", "path", "message").collect()]
    assert [(a, b) for a, b, _ in got] == [(3, None), (4, "(root)"), (4, "outcome"), (5, "policy"), (5, "source_urls")]


def test_lines_are_numbered_across_parts(spark, tmp_path):
    for name in ("a.jsonl", "b.jsonl"):
        (tmp_path / name).write_text("".join(f"{name} {i}\n" if i % 7 else "\n" for i in range(1, 400)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        got = files.json_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted((r.file, r.line, r.text) for r in got) == sorted((n, i, f"{n} {i}") for n in ("a.jsonl", "b.jsonl") for i in range(1, 400) if i % 7)


def test_lines_of_spaces_are_no_records(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text("  \n\t\n\u3000\n{}\n \n")
    assert [(r.line, r.text) for r in files.json_lines(spark, str(tmp_path / "x.jsonl")).collect()] == [(4, "{}")]


def test_table_of_trajectories_is_written_whole_or_not_at_all(spark, tmp_path):
    good, path = normalize(raw(spark, record(), record(source={"repo": "a/b", "pr_number": 2}))), str(tmp_path / "t")
    assert sinks.write_trajectory_table(good, path) == 2
    for bad in (good.withColumn("outcome", F.when(F.col("pr_number") == 2, "lost").otherwise(F.col("outcome"))), good.limit(0)):
        with pytest.raises(sinks.BadRecords):
            sinks.write_trajectory_table(bad, path)
        assert spark.read.schema(schemas.TRAJECTORY).parquet(path).count() == 2 and not (tmp_path / "t.part").exists()
    assert sinks.write_trajectory_table(good.where("pr_number = 2"), path) == 1 and spark.read.parquet(path).count() == 1


def test_status_page(spark):
    rows = [{"pr_number": n, "domain": d, "training_use": "repair", "task_type": None, "quality_score": q, "review_signal_count": 8, "unique_review_signal_count": u, "validation_count": 3} for n, d, q, u in ((2, "x", 0.9, 1), (10, None, None, 8))]
    found = spark.read.schema(schemas.MANIFEST).json(spark.sparkContext.parallelize([json.dumps({"name": "b", "created_at": "2026-02-01", "record_count": 2, "records": rows}), json.dumps({"name": "a", "created_at": "2026-02-01", "record_count": 0, "records": []})], 1))
    page = manifest.status_block(found)
    assert "**Extracts:** 2 · **Trajectories:** 2  " in page and page.index("### a") < page.index("### b")
    assert page.index("| #10 | — | repair | — | — | 8 | 3 |") < page.index("| #2 | x | repair | — | 0.90 | 1 of 8 | 3 |")
    assert manifest.splice(f"x\n{manifest.BEGIN}\nold\n{manifest.END}\ny", page) == f"x\n{page}\ny"
    for bad in ("none", f"{manifest.END}{manifest.BEGIN}", f"{manifest.BEGIN}{manifest.BEGIN}{manifest.END}"):
        with pytest.raises(ValueError):
            manifest.splice(bad, page)


def test_index_needs_its_line(spark, tmp_path):
    (tmp_path / "b.md").write_text("<!-- index: [a/b](u) | v0 done -->\n")
    (tmp_path / "_index.md").write_text("no line")
    assert "| [a/b](u) | [b.md](b.md) | v0 done |" in manifest.index_block(files.pages(spark, str(tmp_path)))
    (tmp_path / "c.md").write_text("nothing")
    with pytest.raises(Exception, match="no index line"):
        manifest.index_block(files.pages(spark, str(tmp_path)))


def test_writers_round_trip(spark, tmp_path):
    big = raw(spark, record(diff={"inline": "diff --git a/q b/q\n+é", "bytes": 3}), record(source={"repo": "Acme/widget", "pr_number": 125}))
    assert sinks.write_raw_files(big, str(tmp_path / "raw"), max_bytes=10) == 2
    back = files.with_sidecars(files.raw_records(spark, str(tmp_path / "raw")), str(tmp_path / "raw"))
    assert [r.file_name for r in back.orderBy("file_name").collect()] == ["pr-125.json", "pr-89.json"]
    got = {r.pr_number: r.patch for r in normalize(back).collect()}
    assert got[89] == "diff --git a/q b/q\n+é"
    out = tmp_path / "t.jsonl"
    assert sinks.write_trajectories(normalize(back), str(out)) == 2
    assert [json.loads(x)["pr_number"] for x in out.read_text().splitlines()] == [125, 89]
    with pytest.raises(sinks.BadRecords):
        sinks.write_trajectories(normalize(back).withColumn("outcome", F.lit("lost")), str(tmp_path / "no.jsonl"))
    assert not (tmp_path / "no.jsonl").exists() and not list(tmp_path.glob("*.part"))


def test_names_and_folders(monkeypatch):
    assert sinks.output_name("a-b.v0") == "a-b.v0.jsonl"
    for bad in (None, "", "../x", "a..b", "-x", "a" * 129):
        with pytest.raises(ValueError):
            sinks.output_name(bad)
    monkeypatch.setenv("TIDEWRIGHT_DATA_ROOT", " ")
    assert sinks.raw_dir(None, "a/b") == "datasets/raw/a_b"
    monkeypatch.setenv("TIDEWRIGHT_DATA_ROOT", "/d")
    assert sinks.raw_dir(None, "a/b") == "/d/raw/a_b" and sinks.raw_dir("/x", "a/b") == "/x"


def test_numbers_and_limits(spark):
    assert funnel.parse_numbers("3, 1,3") == [3, 1]
    for bad in ("", "a", "0"):
        with pytest.raises(ValueError):
            funnel.parse_numbers(bad)
    with pytest.raises(ValueError):
        funnel.merged_pulls(spark.range(1), 0)


class Host:
    def __init__(self, *answers):
        self.answers, self.slept, self.asked = list(answers), [], []

    def __call__(self, url, headers):
        self.asked.append(url)
        a = self.answers.pop(0)
        if isinstance(a, Exception):
            raise a
        return a

    def client(self, **kw):
        return rest.Client(fetch=self, sleep=self.slept.append, clock=lambda: 1000.0, **kw)


def test_requests_are_tried_again():
    host = Host((500, {}, ""), OSError("net"), (429, {"retry-after": "3"}, ""), (403, {}, "secondary rate limit"), (200, {}, "{}"))
    assert host.client().get("/x") == {} and host.slept == [1.0, 2.0, 3.5, 60.0]
    with pytest.raises(rest.HostError):
        Host((403, {}, "forbidden")).client().get("/x")
    with pytest.raises(rest.HostError):
        Host(*[(503, {}, "")] * 6).client().get("/x")
    low = Host((200, {"x-ratelimit-remaining": "1", "x-ratelimit-reset": "1010"}, "{}"))
    low.client().get("/x")
    assert low.slept == [11.0]


def test_pages_follow_links_and_schemes_are_kept_safe():
    host = Host((200, {"link": '<https://h/p2>; rel="next"'}, "[1]"), (200, {}, "[2]"))
    assert list(host.client().pages("/list?a=1")) == [[1], [2]] and host.asked[0].endswith("/list?a=1&per_page=100")
    with pytest.raises(rest.HostError):
        list(Host((200, {}, "{}")).client().pages("/x"))
    assert rest.resolve("http://h/x") == "https://h/x" and rest.resolve("/repos/a") == f"{rest.BASE}/repos/a"
    with pytest.raises(rest.HostError):
        rest.resolve("ftp://h/x")


def test_tasks_that_ask_at_once_are_capped():
    shares = lambda **o: [p.places for p in rest.RestReader({"repo": "a/b", "numbers": "1,2,3,4,5"} | o).partitions()]
    assert shares(partitions="2") == [(("a/b", 1), ("a/b", 3), ("a/b", 5)), (("a/b", 2), ("a/b", 4))]
    assert len(shares()) == rest.PARTITIONS and len(shares(partitions="9")) == 5
    assert rest.RestReader({"issues": "a/b#3, c/d#4,a/b#3"}).partitions()[0].places == (("a/b", 3),)
    for bad in ({"partitions": "0"}, {"issues": "x"}):
        with pytest.raises(ValueError):
            shares(**bad)


def test_errors_become_rows(spark, tmp_path):
    (tmp_path / "issue_3.json").write_text('{"number": 3, "title": "T", "pull_request": {"url": "u"}}')
    spark.dataSource.register(rest.RestSource)
    read = spark.read.format("code_host").option("fixtures", str(tmp_path))
    got = read.option("issues", "a/b#3,a/b#4").option("onerror", "row").load()
    assert sorted((r.number, r.endpoint) for r in got.collect()) == [(3, "issue"), (4, "warning")]
    assert [(r.repo, r.number, r.title, r.pull_request) for r in issue_rows(got).collect()] == [("a/b", 3, "T", '{"url":"u"}')]
    pulls = spark.read.format("code_host").option("fixtures", str(tmp_path)).option("repo", "a/b").option("numbers", "7")
    assert [(r.number, r.endpoint) for r in pulls.option("onerror", "row").load().collect()] == [(7, "error")]
    with pytest.raises(Exception, match="404"):
        pulls.option("onerror", "stop").load().collect()


def test_collected_from_fixtures(spark, tmp_path):
    user = {"login": "ann", "type": "User"}
    docs = {
        "pull_5": {"title": "feat: x", "body": None, "state": "closed", "merged": True, "html_url": "u", "user": user, "labels": [{"name": "bug"}, {}], "base": {"sha": "b"}, "head": {"sha": "h"}},
        "commits_5": [{"sha": "c", "commit": {"message": "Closes #6, fixes far/away#7", "author": {"date": "d"}}}], "files_5": [{"filename": "a.py", "status": "added"}, {"filename": "b", "status": "removed"}],
        "reviews_5": [], "review_comments_5": [{"id": 1, "user": user, "body": "See password=abcdefgh12", "line": 0, "original_line": 4}], "issue_comments_5": [], "check_runs": {"total_count": 1, "check_runs": [{"name": "n", "status": "completed", "conclusion": "success"}]},
    }
    for name, content in docs.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(content))
    spark.dataSource.register(rest.RestSource)
    got = spark.read.format("code_host").option("repo", "Acme/w").option("numbers", "5").option("fixtures", str(tmp_path)).load()
    rows = raw_records(got, F.lit("2026-01-01T00:00:00Z"))
    assert [(f.name, f.dataType.simpleString()) for f in rows.schema] == [(f.name, f.dataType.simpleString()) for f in schemas.RAW]
    r = rows.first()
    assert r.pull.labels == ["bug"] and r.pull.body == "" and r.review_comments[0].line == 4 and [f.patch_truncated for f in r.files] == [True, False]
    assert "[redacted:assignment]" in r.review_comments[0].body and "redacted assignment" in r.collection_meta.warnings
    assert any(w.startswith("diff_failed") for w in r.collection_meta.warnings) and any(w.startswith("combined_status_failed") for w in r.collection_meta.warnings)
    want = {(x.issue_repo, x.issue_number, x.allowed) for x in wanted_issues(rows).collect()}
    assert want == {("Acme/w", 6, True), ("far/away", 7, False)}
    issues_ = spark.createDataFrame([("acme/W", 6, "T", None, "open", "https://github.com/Acme/w/issues/6", None), ("far/away", 7, "U", "", "open", "v", None)], "repo string, number long, title string, body string, state string, html_url string, pull_request string")
    assert [i.number for i in with_issues(rows, issues_).first().linked_issues] == [6]
    assert len(with_issues(rows, issues_, ["FAR/away"]).first().linked_issues) == 2


def test_stream_equals_batch(spark, tmp_path):
    from tidewright.streaming.trajectories import stream_raw, write_stream

    sinks.write_raw_files(raw(spark, record(), record(source={"repo": "a/b", "pr_number": 2})), str(tmp_path / "in"))
    for _ in range(2):  # a second start finds nothing new
        write_stream(stream_raw(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = spark.read.schema(schemas.TRAJECTORY).parquet(str(tmp_path / "out"))
    assert not checks.differs(got, normalize(files.raw_records(spark, str(tmp_path / "in"))))
