from __future__ import annotations

import random

import corpus_pipeline as C
from tidewright.llm import shingle_join as J
from tidewright.llm.common import connected_components

from .test_simhash import components


def grams(text, width=5):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} or {tuple(words)}


def similar(x, y):
    return 5 * len(x & y) >= 4 * len(x | y)


def roots(spark, texts, **kw):
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    return {r.node: r.root for r in connected_components(J.shingle_links(df, **kw)).collect()}


def wanted(texts):
    sets = {i: grams(t) for i, t in texts.items()}
    want = components(sorted(texts), lambda a, b: similar(sets[a], sets[b]))
    return {i: r for i, r in want.items() if sum(1 for x in want.values() if x == r) > 1}


def edited_texts():
    rnd = random.Random(5)
    word = lambda: rnd.choice("abcdefgh") + str(rnd.randrange(40))
    shared = [word() for _ in range(30)]
    texts = [None, "", "one", "ONE", "a b c d e", "a b c d f"]
    for _ in range(12):
        base = [word() for _ in range(rnd.randint(20, 120))]
        for _ in range(6):
            new = list(base)
            for _ in range(rnd.randint(0, 5)):
                new[rnd.randrange(len(new))] = word()
            texts.append(" ".join(new + shared * rnd.randint(0, 1)))
    rnd.shuffle(texts)
    return dict(enumerate(texts))


def test_all_similar_pairs_and_no_others(spark, monkeypatch):
    texts = edited_texts()
    want = wanted(texts)
    assert len(want) > 20
    assert roots(spark, texts) == want
    monkeypatch.setattr(J, "SAMPLED", 5)
    assert roots(spark, texts) == want
    monkeypatch.setattr(J, "COMMON", 0)
    assert roots(spark, texts) == want


def test_the_stage_drops_edited_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    sets = {i: grams(t) for i, t in texts.items()}
    want = components(sorted(texts), lambda a, b: similar(sets[a], sets[b]))
    assert {r.doc_id for r in C.drop_near_copies(spark, docs, sf_dir).collect()} == set(want.values())
    assert (want[177], want[145]) == (1, 6)  # similarity 0.83, fingerprints 7 and 11 bits apart


def test_odd_tables(spark):
    df = spark.createDataFrame([(None, "a b"), (None, "a b"), (1, "a b"), (1, "c d"), (2, "C d")], "doc_id long, text string")
    left = J.drop_linked(df, J.shingle_links(df))
    assert sorted((r.doc_id or 0) for r in left.collect()) == [0, 0, 1, 1]
    assert J.shingle_links(df.limit(0)).isEmpty() and J.drop_linked(df.limit(0), J.shingle_links(df.limit(0))).isEmpty()
