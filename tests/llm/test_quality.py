from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tidewright.llm import quality as Q


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), Q.grades_of_labels(spark.read.parquet(f"{sf}/labels.parquet"))
    train, rest = labels.where("doc_id % 3 <> 0"), labels.where("doc_id % 3 = 0")
    model = Q.train(docs, train)
    got = Q.grade_documents(docs, model).join(rest, "doc_id").groupBy("grade").agg(F.avg(F.col("selected").cast("int")).alias("kept"), F.avg("expected_grade").alias("g")).collect()
    by = {r.grade: r for r in got}
    assert by[2].kept > 0.97 and by[0].kept < 0.1 and by[0].g < by[1].g < by[2].g


def test_thresholds_keep_their_order():
    rng = np.random.default_rng(0)
    rows = [np.unique(rng.integers(0, 50, 8)) for _ in range(400)]
    grades = np.array([min(3, int((r < 10).sum())) for r in rows])
    model = Q.fit_ordinal(rows, grades, 4, bits=8)
    assert (np.diff(model.thresholds) > 0).all()
    scores = np.array([model.score(r) for r in rows])
    tails = model.tails(scores)
    assert (np.diff(tails, axis=1) < 0).all() and np.corrcoef(tails.sum(axis=1), grades)[0, 1] > 0.8


def test_column_equals_the_model(spark):
    texts = ["good clean words here", "BAD!! BAD!!", None, "", "é 😀", "long " * 40_000]
    grades = [2, 0, 1, 1, 2, 2]
    docs = spark.createDataFrame([(i, t, 0.5) for i, t in enumerate(texts * 6)], "doc_id long, text string, score double")
    model = Q.train(docs, spark.createDataFrame([(i, grades[i % 6]) for i in range(36)], "doc_id long, grade int"))
    got = {r.doc_id: r for r in Q.grade_documents(docs, model).collect()}
    for i, t in enumerate(texts * 6):
        s = model.score(Q.features(t or ""))
        assert abs(got[i].score - s) < 1e-6 and abs(got[i].p_ge_2 - model.tails(np.array([s]))[0, 1]) < 1e-6
        assert abs(got[i].expected_grade - got[i].p_ge_1 - got[i].p_ge_2) < 1e-9 and got[i].selected == (got[i].p_ge_2 >= 0.5)
    left = Q.drop_poor(docs, model)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == {i for i, r in got.items() if r.selected}


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, grade int")
    same = spark.createDataFrame([(1, 2), (2, 2), (7, 0), (None, 1), (1, None)], "doc_id long, grade int")
    assert Q.train(docs, none) is None and Q.train(docs, same) is None
    assert all(r.selected and r.score is None for r in Q.grade_documents(docs, None).collect())
    assert Q.drop_poor(docs, None) is docs
    assert Q.grade_documents(docs.limit(0), None).isEmpty()


def test_sample_is_bounded(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    grades = Q.grades_of_labels(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rows, y = Q.labelled(docs, grades, "doc_id", "text", 20)
    assert len(rows) == len(y) == 20


def test_features_are_bounded_and_repeats_count(spark):
    docs = spark.createDataFrame([(i % 10, f"word{i} common text {'z' * i}", 1) for i in range(40)], "doc_id long, text string, _id int")
    grades = spark.createDataFrame([(i, i % 3) for i in range(10)] + [(0, 2)], "doc_id long, grade int")
    rows, y = Q.labelled(docs, grades, "doc_id", "text", 100)
    assert len(rows) == len(y) == 44  # four rows of every identifier, and identifier 0 was graded twice
    sizes = [len(r) for r in rows]
    some, _ = Q.labelled(docs, grades, "doc_id", "text", 100, max_features=sum(sizes) // 2)
    assert 0 < sum(map(len, some)) <= sum(sizes) // 2


def test_gradients_by_finite_differences():
    rng = np.random.default_rng(5)
    for k in (2, 3, 5):
        s, y, t = rng.normal(size=50), rng.integers(0, k, 50), np.sort(rng.normal(size=k - 1)) + np.arange(k - 1)

        def loss(s, t):
            tail = np.concatenate([np.ones((50, 1)), 1 / (1 + np.exp(t - s[:, None])), np.zeros((50, 1))], axis=1)
            return -np.log(tail[range(50), y] - tail[range(50), y + 1])  # noqa: B023

        ds, dt = Q.gradients(s, y, t)
        eps = 1e-6
        assert np.allclose(ds, (loss(s + eps, t) - loss(s - eps, t)) / (2 * eps), atol=1e-5)
        for j in range(k - 1):
            step = np.eye(k - 1)[j] * eps
            assert abs(dt[j] - ((loss(s, t + step) - loss(s, t - step)) / (2 * eps)).sum()) < 1e-4


def test_order_leaves_thresholds_that_have_it():
    t = np.array([-1.0, 0.5, 0.5005, 3.0])
    assert (Q.in_order(t)[[0, 1, 3]] == t[[0, 1, 3]]).all() and Q.in_order(t)[2] == 0.5 + Q.GAP
    assert (Q.in_order(Q.in_order(t)) == Q.in_order(t)).all()


def test_tails_are_the_observed_shares():
    rng = np.random.default_rng(3)
    for shares in ((0.41, 0.22, 0.37), (0.2, 0.2, 0.2, 0.15, 0.25)):
        grades = rng.choice(len(shares), size=12_000, p=shares)
        rows = [np.array([i % 2], dtype=np.int32) for i in range(len(grades))]  # says nothing of the grade
        model = Q.fit_ordinal(rows, grades, len(shares), bits=4)
        tails = model.tails(np.array([model.score(r) for r in rows]))
        for k in range(1, len(shares)):
            assert abs(tails[:, k - 1].mean() - (grades >= k).mean()) < 0.01
            assert np.abs(tails[:, k - 1] - (grades >= k).mean()).max() < 0.03


def plain_features(text):
    """The features again, a character at a time."""
    import zlib

    words, word = [], ""
    for c in text + " ":
        if c in " \t\n\x0b\x0c\r":
            words, word = words + [word] * (word != ""), ""
        else:
            word += c.lower() if "A" <= c <= "Z" else c
    names = set()
    for w in set(words):
        bare = w.encode().strip(Q.OUTER)
        names.add(zlib.crc32(bare) % 2**18)
        if len(bare) > 5:
            names.add(zlib.crc32(bare[:5], 1) % 2**18)
    raw = text.encode()
    letters = sum(65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in raw)
    full = [x for x in raw.split(b"\n") if x.strip()]
    n, size = max(1, len(words)), max(1, len(raw))
    ratios = {
        "upper": sum(65 <= b <= 90 for b in raw) / max(1, letters), "digit": sum(48 <= b <= 57 for b in raw) / size, "letter": letters / size, "bang": raw.count(b"!") / n, "stop": raw.count(b".") / n,
        "comma": raw.count(b",") / n, "bar": raw.count(b"|") / n, "odd": sum(raw.count(c.encode()) for c in "$%&*#@~^") / n, "same words": 1 - len(set(words)) / n, "same lines": 1 - len(set(full)) / max(1, len(full)),
        "long": len(words) / 4000, "length": size / n / 40,
    }
    return names | {zlib.crc32(f" {k} {sum(v > c for c in Q.CUTS)}".encode()) % 2**18 for k, v in ratios.items()}


def test_query_by_brute_force(spark, sf_dir):
    """op9 over its whole tables, against the model applied by a plain loop over all documents."""
    from tidewright.llm import registry

    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = Q.train(docs, Q.grades_of_labels(labels))
    weight = dict(enumerate(model.weights.tolist()))
    want = {}
    for r in docs.collect():
        s = sum(weight[f] for f in plain_features(r.text or ""))
        p = [1 / (1 + np.exp(t - s)) for t in model.thresholds]
        want[r.doc_id] = (s, *p, sum(p), bool(p[1] >= 0.5))
    got = {r.doc_id: (r.score, r.p_ge_1, r.p_ge_2, r.expected_grade, r.selected) for r in registry.op9_ordinal_quality(spark, sf_dir).collect()}
    assert got.keys() == want.keys()
    assert all(np.allclose(got[i][:4], want[i][:4], atol=1e-6) and (got[i][4] == want[i][4] or abs(want[i][2] - 0.5) < 1e-6) for i in got)


def test_ties_repeats_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "same words", 0.1, "a"), (1, "same words", 0.2, "b"), (2, "same words", 0.3, "c"), (None, "same words", None, None)], "doc_id long, text string, _tidewright_score double, score string")
    model = Q.OrdinalModel(np.zeros(1 << Q.BITS, dtype=np.float32), np.array([-1.0, 0.0]))
    got = Q.grade_documents(docs, model).collect()
    assert [r.doc_id for r in got] == [1, 1, 2, None] and all(r.selected and r.p_ge_2 == 0.5 for r in got)
    assert Q.drop_poor(docs, model).columns == docs.columns and Q.drop_poor(docs, model).count() == 4
