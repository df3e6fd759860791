"""The commands end to end, on invented answers of a host."""

from __future__ import annotations

import json

import pytest

from tidewright import cli
from tidewright.operators import manifest
from tidewright.sources import rest

USER = {"login": "ann", "type": "User"}


@pytest.fixture
def host(tmp_path):
    folder = tmp_path / "host"
    folder.mkdir()
    answers = {
        "pull_5": {"title": "feat: more", "body": "## Summary\nMore of it.\n\nCloses #6, fixes far/away#7\n\n## Tests\nall green", "state": "closed", "merged": True, "html_url": "u", "user": USER, "labels": [], "head": {"sha": "h"}},
        "commits_5": [], "files_5": [{"filename": "a.py", "status": "added", "additions": 1, "deletions": 0, "patch": "@@ +1"}], "comments_5": [],
        "reviews_5": [{"id": 1, "user": USER, "state": "CHANGES_REQUESTED", "body": "Please name this what it is, a list."}], "review_comments_5": [], "issue_comments_5": [],
        "issue_6": {"number": 6, "title": "More", "body": "We want more", "state": "closed", "html_url": "https://github.com/acme/w/issues/6"},
        "check_runs": {"total_count": 1, "check_runs": [{"name": "build", "status": "completed", "conclusion": "success"}]}, "status": {"state": "pending", "statuses": []},
    }
    for name, answer in answers.items():
        (folder / f"{name}.json").write_text(json.dumps(answer))
    (folder / "diff_5.diff").write_text("diff --git a/a.py b/a.py\n+1\n")
    return str(folder)


def test_from_host_to_status(spark, host, tmp_path, capsys, monkeypatch):
    monkeypatch.chdir(tmp_path)
    run = lambda *a: cli.main([str(x) for x in a])
    raw = tmp_path / "raw"
    collect = ("collect", "--repo", "https://github.com/acme/w/", "--pr", "5", "--fixtures", host, "--out-dir", raw)
    assert run(*collect, "--dry-run") == 0 and "Would collect acme/w PRs [5]" in capsys.readouterr().out and not raw.exists()
    assert run(*collect) == 0 and run(*collect, "--skip-existing") == 0 and "1 skipped" in capsys.readouterr().err
    record = json.loads((raw / "pr-5.json").read_text())
    assert [i["number"] for i in record["linked_issues"]] == [6]
    assert any("cross-repo far/away not in allowlist" in w for w in record["collection_meta"]["warnings"])
    assert run(*collect[:4], "5,8", *collect[5:], "--continue-on-error") == 1 and "Failed acme/w#8" in capsys.readouterr().err
    (raw / "pr-5.json").unlink()
    assert run(*collect[:4], "8,5", *collect[5:]) == 1 and not (raw / "pr-5.json").exists()  # nothing behind the first failure
    assert run(*collect[:4], "8,5", *collect[5:], "--continue-on-error") == 1 and (raw / "pr-5.json").exists()
    assert run(*collect[:4], "x", *collect[5:]) == 2

    (tmp_path / "card.json").write_text(json.dumps({"name": "acme-v0", "source_repo": "acme/w", "language": "Python", "domain_by_pr": {"5": "lists"}}))
    assert run("normalize", "--raw-dir", raw) == 2 and run("normalize", "--raw-dir", tmp_path / "none") == 2 and run("normalize", "--raw-dir", raw, "--card", "gone") == 2
    assert run("normalize", "--raw-dir", raw, "--card", "card.json") == 0
    out = tmp_path / "datasets/jsonl/acme-v0.jsonl"
    t = json.loads(out.read_text())
    assert (t["id"], t["domain"], t["task_type"], t["language"], t["outcome"], t["quality_score"]) == ("acme-w-5", "lists", "feature", "Python", "merged", 0.9)
    assert t["source_urls"] == ["https://github.com/acme/w/pull/5", "https://github.com/acme/w/issues/6", "https://github.com/far/away/issues/7"]
    assert t["issue_context"].startswith("Issue #6: More\n\nWe want more\n\nMore of it.") and t["patch"] == "diff --git a/a.py b/a.py\n+1\n"
    assert run("normalize", "--raw-dir", raw, "--card", "card.json", "--pr", "9") == 1

    assert run("validate", out, "--strict-policy") == 0 and "✓ acme-v0.jsonl" in capsys.readouterr().out
    (tmp_path / "bad.jsonl").write_text("{\n")
    (tmp_path / "empty.jsonl").write_text("\n  \n\t\n")
    assert run("validate", "bad.jsonl", "empty.jsonl", "gone.jsonl") == 1
    said = capsys.readouterr().out
    assert "bad.jsonl:1 - Invalid JSON" in said and "no non-empty JSONL records" in said and "File not found" in said

    made = ("manifest", "--jsonl", out, "--card", "card.json", "--out", "m/acme-v0.manifest.json")
    (tmp_path / "m").mkdir()
    assert run(*made) == 2 and run(*made, "--created-at", "2026-01-02", "--created-by", "x") == 0 and run(*made, "--check") == 0
    kept = json.loads((tmp_path / "m/acme-v0.manifest.json").read_text())
    assert kept["record_count"] == 1 and kept["bytes"] == len(out.read_bytes()) and kept["records"][0]["review_signal_count"] == 1
    out.write_text(out.read_text() + "\n")
    assert run(*made, "--check") == 1

    docs = tmp_path / "docs"
    docs.mkdir()
    (docs / "a.md").write_text("<!-- index: acme/w | done -->")
    for page in (tmp_path / "STATUS.md", docs / "_index.md"):
        page.write_text(f"head\n{manifest.BEGIN}\n{manifest.END}\ntail\n")
    shown = ("status", "--manifest-dir", "m", "--docs-dir", docs)
    assert run(*shown, "--check") == 1 and run(*shown) == 0 and run(*shown, "--check") == 0
    assert "| #5 | lists | other | feature | 0.90 | 1 | 2 |" in (tmp_path / "STATUS.md").read_text() and "| acme/w | [a.md](a.md) | done |" in (docs / "_index.md").read_text()
    assert run("status", "--manifest-dir", "nowhere", "--docs-dir", docs, "--check") == 1


def test_merged_list_stops_early(capsys, monkeypatch):
    pulls = [{"number": n, "merged_at": None if n % 2 else "2026-01-01T00:00:00Z", "title": f"t{n}", "user": USER} for n in range(6)]
    asked = []

    def fetch(url, headers):
        asked.append(url)
        return 200, {"link": '<https://h/2>; rel="next"'}, json.dumps(pulls)

    client = rest.Client(fetch=fetch)
    assert [p["number"] for p in rest.list_merged(client, "a/b", 2)] == [0, 2] and len(asked) == 1 and "sort=updated" in asked[0]
    assert [p["number"] for p in rest.list_merged(client, "a/b", 4)] == [0, 2, 4, 0]
    monkeypatch.setattr(cli, "client_of", lambda args: client)
    assert cli.main(["list", "--repo", "a/b", "--limit", "3", "--numbers-only"]) == 0 and capsys.readouterr().out == "0,2,4\n"
    assert cli.main(["list", "--repo", "a/b", "--limit", "1"]) == 0 and "#   0  2026-01-01  t0" in capsys.readouterr().out
    assert cli.main(["list", "--repo", "a/b", "--limit", "0"]) == 2 and cli.main(["list", "--repo", "a"]) == 2
    monkeypatch.setattr(cli, "client_of", lambda args: rest.Client(fetch=lambda u, h: (404, {}, "")))
    assert cli.main(["list", "--repo", "a/b"]) == 1
