"""A Python data source for a code host's REST interface: pages, objects and texts as rows of JSON.

    spark.dataSource.register(RestSource)
    spark.read.format("code_host").option("repo", "owner/name").option("numbers", "1,2").load()

Rows are (repo, number, endpoint, payload). With `issues` instead of `numbers` ("owner/name#3,other/name#4") they are
single issues. Hosts limit requests per token, so `partitions` (4 without it) caps how many tasks ask at once: each
takes its share of the numbers one after the other, with one client and one throttle. With `onerror` "row" what can't be
had is a row of endpoint `error` or `warning`; otherwise it ends the query. With `fixtures`, a folder of files named by
endpoint, nothing is requested.
"""

from __future__ import annotations

import json
import os
import re
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from urllib.parse import urljoin, urlsplit

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

BASE, VERSION = "https://api.github.com", "2022-11-28"
RETRIES, TIMEOUT, PER_PAGE, LEAST_LEFT, PARTITIONS = 5, 60, 100, 2, 4
LISTS = ("commits", "files", "reviews", "comments", "issue_comments")


class HostError(Exception):
    def __init__(self, message: str, status: int | None = None):
        super().__init__(message)
        self.status = status


def token_from_env(name: str = "GITHUB_TOKEN") -> str | None:
    """The named variable; for the default name GH_TOKEN stands in."""
    return os.environ.get(name) or (os.environ.get("GH_TOKEN") if name == "GITHUB_TOKEN" else None) or None


def resolve(url: str, base: str = BASE) -> str:
    """An absolute https address: http is raised to https, other schemes are refused, paths join the base."""
    parts = urlsplit(url)
    if not parts.scheme:
        return resolve(urljoin(base.rstrip("/") + "/", url.lstrip("/")))
    if parts.scheme not in ("http", "https"):
        raise HostError(f"refused scheme: {parts.scheme}")
    return "https" + url[len(parts.scheme) :]


def next_link(header: str | None) -> str | None:
    """The address of the part of a Link header that says rel="next"."""
    for part in (header or "").split(","):
        address, _, rel = part.partition(">")
        if 'rel="next"' in rel and "<" in address:
            return address.split("<", 1)[1]
    return None


def wait_after(status: int | None, headers: dict[str, str], body: str, attempt: int, now: float) -> float | None:
    """Seconds before another try, or None when another try is of no use. status None: the network failed."""
    low = body.lower()
    limited = status == 403 and ("rate limit" in low or headers.get("x-ratelimit-remaining") == "0" or "retry-after" in headers)
    if status is not None and status != 429 and status < 500 and not limited:
        return None
    if headers.get("retry-after", "").strip().isdigit():
        return int(headers["retry-after"]) + 0.5
    if "secondary rate limit" in low:
        return 60.0
    if (status == 429 or limited) and headers.get("x-ratelimit-reset", "").isdigit():
        return min(max(int(headers["x-ratelimit-reset"]) - now, 0) + 1, 120.0)
    return float(min(2**attempt, 60))


def fetch_url(url: str, headers: dict[str, str]) -> tuple[int, dict[str, str], str]:
    """(status, lower-cased headers, text); undecodable bytes are replaced."""
    try:
        with urllib.request.urlopen(urllib.request.Request(url, headers=headers), timeout=TIMEOUT) as r:  # noqa: S310
            return r.status, {k.lower(): v for k, v in r.headers.items()}, r.read().decode("utf-8", "replace")
    except urllib.error.HTTPError as e:
        return e.code, {k.lower(): v for k, v in e.headers.items()}, e.read().decode("utf-8", "replace")


@dataclass
class Client:
    """Requests with retries and a throttle. fetch and sleep can be replaced."""

    token: str | None = None
    base: str = BASE
    retries: int = RETRIES
    fetch: Callable[[str, dict[str, str]], tuple[int, dict[str, str], str]] = fetch_url
    sleep: Callable[[float], None] = time.sleep
    clock: Callable[[], float] = time.time
    made: int = field(default=0)

    def _headers(self, accept: str) -> dict[str, str]:
        known = {"Accept": accept, "User-Agent": "tidewright", "X-GitHub-Api-Version": VERSION}
        return known | ({"Authorization": f"Bearer {self.token}"} if self.token else {})

    def request(self, url: str, accept: str = "application/vnd.github+json") -> tuple[dict[str, str], str]:
        url = resolve(url, self.base)
        for attempt in range(self.retries + 1):
            self.made += 1
            try:
                status, headers, body = self.fetch(url, self._headers(accept))
            except OSError as e:
                status, headers, body = None, {}, str(e)
            if status is not None and status < 400:
                if headers.get("x-ratelimit-remaining", "").isdigit() and int(headers["x-ratelimit-remaining"]) <= LEAST_LEFT:
                    reset = headers.get("x-ratelimit-reset", "")
                    self.sleep(min(max(int(reset) - self.clock(), 0) + 1, 120.0) if reset.isdigit() else 1.0)
                return headers, body
            wait = wait_after(status, headers, body, attempt, self.clock())
            if wait is None or attempt == self.retries:
                raise HostError(f"{url}: {status} {body[:200]}", status)
            self.sleep(wait)
        raise AssertionError

    def get(self, url: str):
        return json.loads(self.request(url)[1])

    def text(self, url: str, accept: str = "application/vnd.github.v3.diff") -> str:
        return self.request(url, accept)[1]

    def pages(self, url: str, per_page: int = PER_PAGE) -> Iterator[list]:
        """Every page of a list, by the Link header; anything but a list is an error."""
        at: str | None = f"{url}{'&' if '?' in url else '?'}per_page={per_page}"
        while at:
            headers, body = self.request(at)
            page = json.loads(body)
            if not isinstance(page, list):
                raise HostError(f"{at}: expected a list")
            yield page
            at = next_link(headers.get("link")) if page else None


@dataclass
class Share(InputPartition):
    """What one task asks for, in order: (repo, number) of pull requests, or of issues."""

    places: tuple[tuple[str, int], ...]
    issues: bool
    skip: tuple[str, ...]


def endpoints(repo: str, number: int) -> dict[str, str]:
    pull = f"/repos/{repo}/pulls/{number}"
    return {"pull": pull, "commits": f"{pull}/commits", "files": f"{pull}/files", "reviews": f"{pull}/reviews", "comments": f"{pull}/comments", "issue_comments": f"/repos/{repo}/issues/{number}/comments"}


def payloads(client: Client, repo: str, number: int, skip: tuple[str, ...] = ()) -> Iterator[tuple[str, str]]:
    """(endpoint, JSON or text) of a pull request. Lists and the pull itself must be there; diff and checks may fail, as a warning."""
    places = endpoints(repo, number)
    pull = client.get(places["pull"])
    for side in ("base", "head"):
        if ((pull.get(side) or {}).get("repo") or {}).get("private") is True:
            raise HostError(f"{repo}#{number}: a private repository")
    yield "pull", json.dumps(pull)
    for name in LISTS:
        yield name, json.dumps([x for page in client.pages(places[name]) for x in page])

    def soft(name: str, make: Callable[[], str]) -> Iterator[tuple[str, str]]:
        if name in skip:
            return
        try:
            yield name, make()
        except HostError as e:
            yield "warning", f"{name}_failed: {e}"

    yield from soft("diff", lambda: client.text(places["pull"]))
    sha = (pull.get("head") or {}).get("sha")
    if sha and "checks" not in skip:
        def runs() -> str:
            found, page = [], 1
            while True:
                got = client.get(f"/repos/{repo}/commits/{sha}/check-runs?per_page={PER_PAGE}&page={page}")
                found += got.get("check_runs") or []
                if not got.get("check_runs") or len(found) >= got.get("total_count", len(found)):
                    return json.dumps(found)
                page += 1

        yield from soft("check_runs", runs)
        yield from soft("combined_status", lambda: json.dumps(client.get(f"/repos/{repo}/commits/{sha}/status")))


def parse_issues(text: str) -> list[tuple[str, int]]:
    """(repo, number) of a list by commas; an error for anything else."""
    found = [re.fullmatch(r"\s*([^/\s#]+/[^/\s#]+)#([0-9]+)\s*", part) for part in text.split(",") if part.strip()]
    if not all(found):
        raise ValueError(f"not a list of issues: {text!r}")
    return list(dict.fromkeys((m[1], int(m[2])) for m in found))


class RestReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = options

    def partitions(self) -> list[Share]:
        from ..operators.funnel import parse_numbers

        skip = tuple(s for s in self.options.get("skip", "").split(",") if s)
        issues = "issues" in self.options
        places = parse_issues(self.options["issues"]) if issues else [(self.options["repo"], n) for n in parse_numbers(self.options["numbers"])]
        n = int(self.options.get("partitions", PARTITIONS))
        if n < 1:
            raise ValueError("partitions must be at least 1")
        return [Share(tuple(places[i::n]), issues, skip) for i in range(min(n, len(places)))]

    def read(self, partition: Share) -> Iterator[tuple]:
        folder, rows = self.options.get("fixtures"), self.options.get("onerror") == "row"
        client = Client(token_from_env(self.options.get("tokenenv", "GITHUB_TOKEN")), self.options.get("base", BASE))
        if folder:
            client.fetch, client.sleep = fixture_fetch(folder), lambda s: None
        for repo, number in partition.places:
            try:
                if partition.issues:
                    yield repo, number, "issue", json.dumps(client.get(f"/repos/{repo}/issues/{number}"))
                else:
                    for endpoint, payload in payloads(client, repo, number, partition.skip):
                        yield repo, number, endpoint, payload
            except HostError as e:
                if not rows:
                    raise
                yield repo, number, "warning" if partition.issues else "error", f"linked_issue_{number}_failed: {e}" if partition.issues else str(e)


def fixture_fetch(folder: str) -> Callable[[str, dict[str, str]], tuple[int, dict[str, str], str]]:
    """Answers from files: <kind>_<number>.json, or diff_<number>.diff; others are not found."""
    from pathlib import Path

    def fetch(url: str, headers: dict[str, str]) -> tuple[int, dict[str, str], str]:
        parts = urlsplit(url).path.strip("/").split("/")  # repos, owner, name, kind, number, more
        kind, number, more = parts[3], parts[4], parts[5] if len(parts) > 5 else ""
        if kind == "pulls" and not more:
            name = f"diff_{number}.diff" if headers["Accept"].endswith("diff") else f"pull_{number}.json"
        else:
            name = {("pulls", "comments"): f"review_comments_{number}", ("issues", "comments"): f"issue_comments_{number}", ("issues", ""): f"issue_{number}", ("commits", "check-runs"): "check_runs", ("commits", "status"): "status"}.get((kind, more), f"{more}_{number}") + ".json"
        path = Path(folder) / name
        return (200, {}, path.read_text(encoding="utf-8")) if path.exists() else (404, {}, "not found")

    return fetch


class RestSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "code_host"

    def schema(self) -> str:
        return "repo string, number int, endpoint string, payload string"

    def reader(self, schema) -> RestReader:
        return RestReader(dict(self.options))


def list_merged(client: Client, repo: str, limit: int = 50) -> list[dict]:
    """Up to limit merged pull requests, newest update first; asks for no page beyond the one that fills the limit."""
    if limit < 1:
        raise ValueError("limit must be at least 1")
    found: list[dict] = []
    for page in client.pages(f"/repos/{repo}/pulls?state=closed&sort=updated&direction=desc"):
        for pull in page:
            if isinstance(pull, dict) and pull.get("merged_at") and pull.get("number") is not None:
                kept = {k: pull.get(k) for k in ("number", "merged_at", "html_url", "additions", "deletions", "changed_files")}
                found.append({"title": pull.get("title") or "", "user": (pull.get("user") or {}).get("login"), **kept})
                if len(found) == limit:
                    return found
    return found
