from __future__ import annotations

from collections import Counter

import pytest

import corpus_pipeline as C
from tidewright.llm import common, mixing, packing, quality, simhash

from .test_exact_dedup import plain as exact
from .test_shingle_join import grams, similar
from .test_simhash import components


def test_stages_have_their_effect(spark, sf_dir):
    docs = start = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = []
    for name, stage in C.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == start.columns
        names.append(name)
    assert len(C.STAGES) == 5 and names[0].startswith("quality") and names[-1].startswith("mixing")


def test_run_equals_a_plain_version(spark, sf_dir):
    rows = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    labels = quality.grades_of_labels(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    model = quality.train(spark.read.parquet(f"{sf_dir}/documents.parquet"), labels)
    good = [(i, r.text) for i, r in rows.items() if model is None or model.tails(quality.np.array([model.score(quality.features(r.text or ""))]))[0, 1] >= 0.5]
    assert 0 < len(good) < len(rows)
    whole = [i for i, keep, _, _ in exact(good) if i == keep]
    sets = {i: grams(rows[i].text) for i in whole}
    left = sorted(set(components(sorted(whole), lambda a, b: similar(sets[a], sets[b])).values()))
    schema = spark.read.parquet(f"{sf_dir}/documents.parquet").schema
    mixed = Counter(r.doc_id for r in mixing.mixture(spark.createDataFrame([tuple(rows[i]) for i in left], schema), C.MIX).collect())
    assert set(mixed) == set(left) and max(mixed.values()) <= 2
    got = [r.asDict() for r in C.run(spark, sf_dir).collect()]
    ids = packing.encoder("byte_bpe_50k.json")
    tokens = {i: [*ids(rows[i].text or "").tolist(), 1] for i in left}
    assert sum(p["length"] for p in got) == sum(len(tokens[i]) * n for i, n in mixed.items())
    per = Counter()
    for p in got:
        per[p["doc_id"]] += p["length"]
    assert per == {i: len(tokens[i]) * n for i, n in mixed.items()}
    once = [p for p in got if mixed[p["doc_id"]] == 1]
    covered = Counter()
    for p in once:
        covered[p["doc_id"]] += p["length"]
    assert all(covered[i] == len(tokens[i]) for i, n in mixed.items() if n == 1)


def test_fingerprints_decide_in_the_stage(spark, sf_dir):
    """Texts that one repeated line fills are near by their fingerprints, though their sets of shingles are not."""
    line, tail = "the same line again and again without one other ", lambda name, n: " ".join(f"{name}{i}" for i in range(n))
    texts = {1: line * 40 + tail("a", 20), 2: line * 40 + tail("b", 20), 3: line * 20 + tail("c", 20), 4: tail("d", 40)}
    assert not any(similar(grams(texts[a]), grams(texts[b])) for a in texts for b in texts if a < b)
    fps = [simhash.fingerprint(texts[i], 5) for i in (1, 2, 3)]
    assert all(bin(fps[0] ^ f).count("1") <= 2 for f in fps)
    docs = spark.createDataFrame([(i, t, "s") for i, t in texts.items()], "doc_id long, text string, source string")
    near = C.drop_near_copies(spark, docs, sf_dir)
    assert sorted(r.doc_id for r in near.collect()) == [1, 3, 4]  # of 1 and 3 the shingles, repeats included, are half the same
    assert {r.doc_id for r in C.mix_sources(spark, near, sf_dir).collect()} == {1, 3, 4}


def test_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names and {n.split("_")[0] for n in names} >= {f"op{i}" for i in range(1, 11)}
    assert C.ORACLE_SQL is None


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, salt int, _gone_id long, _tidewright_score double, _tidewright_key string, pii_finds string"
LONG = " ".join(f"w{i * 7919 % 9973}" for i in range(60_000))


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """Documents with nulls in every column, repeats, ties, a very long text and further columns; labels with nulls."""
    folder = str(tmp_path_factory.mktemp("odd"))
    texts = [(1, "one two three four five six"), (1, "one two three four five six"), (2, "one two three four five  six"), (3, None), (4, ""), (5, LONG), (6, LONG + " end"), (None, "no identifier here at all"), (None, None), (7, "é 😀"), (8, "two\nlines of it")]
    rows = [(i, t, "en" if (i or 0) % 2 else None, f"s{i % 2}" if i else None, len(t or "") if i else None, i, 3, i, 0.5, "k", None) for i, t in texts]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(None, 1, 0), (1, None, 1), (99, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


def test_odd_rows_through_every_stage(spark, odd):
    docs = spark.read.parquet(f"{odd}/documents.parquet")
    key = lambda df: sorted(((r.doc_id, len(r.text or "x")) for r in df.collect()), key=repr)
    good = C.keep_good(spark, docs, odd)
    assert key(good) == key(docs) and good.columns == docs.columns  # no usable label: none is rejected
    exact_left = C.drop_exact_copies(spark, docs, odd)
    assert exact_left.columns == docs.columns  # 2 owns 1 (longer), 3 owns the empty ones; the twice stated 1 goes as one
    assert sorted(str(r.doc_id) for r in exact_left.collect()) == ["2", "3", "5", "6", "7", "8", "None"]
    near_left = C.drop_near_copies(spark, docs, odd)
    assert near_left.columns == docs.columns  # rows without identifier stay, 6 is a near copy of 5, the two rows of 1 stay together
    assert sorted(str(r.doc_id) for r in near_left.collect()) == ["1", "1", "3", "5", "7", "8", "None", "None"]
    mixed = C.mix_sources(spark, docs, odd)
    assert mixed.columns == docs.columns and set(map(repr, mixed.collect())) == set(map(repr, docs.collect()))
    packed = C.pack_sequences(spark, docs, odd).collect()
    assert sum(1 for p in packed if p.doc_id is None and p.start == 0) == 2 and sum(p.length for p in packed if p.doc_id in (3, 4)) == 2
    assert sum(p.length for p in packed if p.doc_id == 5) == next(p.doc_tokens for p in packed if p.doc_id == 5) > 60_000


def test_empty_tables_through_every_stage(spark, odd, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{odd}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in C.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and out.isEmpty()
    assert C.run(spark, str(tmp_path)).isEmpty()


def test_run_leaves_only_its_result(spark, odd):
    before = set(common._written)
    out = C.run(spark, odd)
    assert set(common._written) - before == {out._tidewright_path} and out.count() > 0
