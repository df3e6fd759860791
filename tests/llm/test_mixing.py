from __future__ import annotations

import hashlib
import math
from collections import Counter, defaultdict

import pytest

from tidewright.llm import mixing as M

SIZES = {"a": 300, "b": 40, "c": 12, None: 5}


@pytest.fixture(scope="module")
def docs(spark):
    rows, i = [], 0
    for s, n in SIZES.items():
        for k in range(n):
            rows.append((i, "w " * (1 + k % 7), s, 3))
            i += 1
    rows += [(9000, None, "void", 3), (9001, "", "void", 3), (9002, None, "a", 3)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, epoch int").repartition(3)


def tokens(docs):
    out = defaultdict(int)
    for r in docs.collect():
        out[r.source] += len((r.text or "").split())
    return out


def plain_exponent(t, met):
    lo, hi = 0.0, 1.0
    if met(0.0):
        return 0.0
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (lo, mid) if met(mid) else (mid, hi)
    return hi


def weights(t, a):
    total = sum(t.values())
    x = {s: (n / total) ** a for s, n in t.items() if n}
    return {s: v / sum(x.values()) for s, v in x.items()}


def test_full_coverage_with_a_limit(docs):
    t = tokens(docs)
    plan = M.plan_mixture(docs, M.Target(max_repetition=2.0))
    ratio = lambda a: (lambda r: max(r) / min(r))([w / t[s] for s, w in weights(t, a).items()])
    a = plain_exponent(t, lambda a: ratio(a) <= 2)
    assert plan.exponent == pytest.approx(a, abs=1e-6)
    got = M.mixture(docs).collect()
    copies = Counter(r.doc_id for r in got)
    every = {r.doc_id for r in docs.collect()}
    assert set(copies) == every and max(copies.values()) == 2
    read = defaultdict(int)
    for r in got:
        read[r.source] += r.n_tokens
    w = weights(t, a)
    whole = max(t[s] / w[s] for s in w)
    for s in w:  # met to within one document
        assert abs(read[s] - w[s] * whole) <= 8
    assert {r.weight for r in got if r.source == "void"} == {0.0} and {round(r.weight, 6) for r in got if r.source == "a"} == {round(w["a"], 6)}


def test_entropy_and_budget(docs):
    t = tokens(docs)
    entropy = lambda a: -sum(w * math.log(w) for w in weights(t, a).values())
    h = (entropy(0) + entropy(1)) / 2
    plan = M.plan_mixture(docs, M.Target(max_repetition=None, entropy=h, budget=600))
    assert entropy(plan.exponent) == pytest.approx(h, abs=1e-6)
    read = defaultdict(int)
    for r in M.mixture(docs, M.Target(max_repetition=None, entropy=h, budget=600)).collect():
        read[r.source] += r.n_tokens
    for s, w in weights(t, plan.exponent).items():
        assert w * 600 - 8 <= read[s] <= w * 600 + 1
    with pytest.raises(ValueError):
        M.plan_mixture(docs, M.Target(max_repetition=2.0, entropy=1.0))


def test_block_permutations_by_hand(docs):
    """The same blocks, orders and cuts, one document after the other."""
    target = M.Target(max_repetition=None, entropy=1.0, budget=900)
    plan = M.plan_mixture(docs, target)
    unit = lambda *p: int(hashlib.md5(":".join(map(str, p)).encode()).hexdigest()[:15], 16)
    want = Counter()
    rows = defaultdict(list)
    for r in docs.collect():
        rows["null" if r.source is None else f"={r.source}"].append((r.doc_id, len((r.text or "").split())))
    for s in plan.sources.collect():
        blocks = defaultdict(list)
        for i, n in rows[s.key]:
            blocks[unit("mix", i) % s.n_blocks].append((i, n))
        if not s.tokens:
            want.update({(i, 0): 1 for i, _ in rows[s.key]})
            continue
        for epoch in range(s.epochs + 1):
            left = s.tokens if epoch < s.epochs else s.rest
            for b in sorted(blocks, key=lambda b: (unit("mix", "order", epoch, s.key, b), b)):
                total = sum(n for _, n in blocks[b])
                if epoch < s.epochs or total <= left and left > 0:
                    want.update({(i, epoch): 1 for i, _ in blocks[b]})
                elif left > 0:
                    upto = 0
                    for i, n in sorted(blocks[b], key=lambda x: (unit("mix", "doc", epoch, x[0]), x[0])):
                        upto += n
                        if upto <= left:
                            want[i, epoch] += 1
                left -= total
    got = M.mixture(docs, target).collect()
    assert Counter((r.doc_id, r.epoch) for r in got) == want
    copies = Counter(r.doc_id for r in M.mix_documents(docs, target).collect())
    by = Counter()
    for (i, _), n in want.items():
        by[i] += n
    assert copies == by


def test_sources_interleave(docs):
    got = sorted(M.mixture(docs).where("weight > 0").collect(), key=lambda r: r.position)
    half = got[: len(got) // 2]
    share = sum(r.n_tokens for r in half if r.source == "a") / sum(r.n_tokens for r in half)
    assert abs(share - got[0].weight if got[0].source == "a" else share - next(r.weight for r in got if r.source == "a")) < 0.08
    assert all(0 <= r.position <= 1.2 for r in got)


def test_odd_tables(spark, docs):
    none = docs.limit(0)
    assert M.mixture(none).isEmpty() and M.mix_documents(none).isEmpty()
    assert M.mix_documents(docs).columns == docs.columns
    one = spark.createDataFrame([(None, "a b", "s"), (1, "c", "s"), (1, "c", "s")], "doc_id long, text string, source string")
    assert sorted((r.doc_id or 0) for r in M.mix_documents(one).collect()) == [0, 1, 1]
