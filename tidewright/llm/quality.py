"""Ordinal quality classifier: cumulative-link (proportional odds) regression over hashed text.

One weight for each hashed feature is shared by all grades; ordered thresholds t1 < t2 < ... split the score into
grades: P(grade >= k) = sigmoid(score - t_k). The expected grade is the sum of these tail probabilities, and
selection asks for one tail probability. Features are the distinct words of the whole text (lower-cased A-Z,
outer punctuation off) and of their first five bytes, each present or not, and one-hot bins of shape ratios; every weight sits in a table of
2**18 floats, so what is broadcast has a fixed size.

Part of the model: only features whose rows' mean grade is four standard errors from the overall one get a weight
(`screened`), all others weigh nothing; and after the weights are fitted, the thresholds are set so that the mean of
every tail probability over the labelled rows is the share of rows of that grade or above.

Fitting uses at most `max_rows` labelled rows, those of the smallest hash of their identifier, and of these no more
than hold `max_features` features together (documented bounds; scoring covers all documents). Defined results: null
text is empty; labels that are null, or of documents not in the table, are not used; a document with several labels
counts with each, and so does each row of a repeated identifier; without labelled rows, or with one grade only, every
document is selected and has null scores; rows repeat as they come, equal texts get equal scores; a tail probability
that equals the one asked for selects; an empty table gives no rows; further columns of any name are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hashed_sample, materialize, release, text_or_empty, tune, unused

BITS = 18
OUTER = b"\"'()[]{}<>.,;:!?*&%$#@|-_=+/\\~^`"
MAX_ROWS = 12_000
#: Features (four bytes each) of all labelled rows together that the driver takes.
MAX_FEATURES = 1 << 25
#: Words longer than this also count by so many first bytes, which inflected forms share.
STEM = 5
#: Ratios are cut at these points; a feature says how many lie below.
CUTS = (0.001, 0.01, 0.03, 0.06, 0.1, 0.2, 0.3, 0.5, 0.7, 0.9)


def features(text: str, bits: int = BITS) -> np.ndarray:
    """Sorted distinct feature numbers of one whole text."""
    raw = text.encode()
    words = raw.lower().split()
    mask = (1 << bits) - 1
    bare = {w.strip(OUTER) for w in set(words)}
    found = {zlib.crc32(w) & mask for w in bare}
    found |= {zlib.crc32(w, 1) & mask for w in {w[:STEM] for w in bare if len(w) > STEM}}
    n, chars = max(1, len(words)), max(1, len(raw))
    count = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    letters = count[65:91].sum() + count[97:123].sum() + count[128:].sum()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    ratios = {
        "upper": count[65:91].sum() / max(1, letters), "digit": count[48:58].sum() / chars, "letter": letters / chars,
        "bang": count[33] / n, "stop": count[46] / n, "comma": count[44] / n, "bar": count[124] / n, "odd": sum(count[ord(c)] for c in "$%&*#@~^") / n,
        "same words": 1 - len(set(words)) / n, "same lines": 1 - len(set(lines)) / max(1, len(lines)), "long": len(words) / 4000, "length": chars / n / 40,
    }
    found |= {zlib.crc32(f" {k} {sum(v > c for c in CUTS)}".encode()) & mask for k, v in ratios.items()}
    return np.array(sorted(found), dtype=np.int32)


@dataclass
class OrdinalModel:
    weights: np.ndarray
    thresholds: np.ndarray

    def score(self, feats: np.ndarray) -> float:
        return float(self.weights[feats].sum(dtype=np.float64))

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1..K-1, one column each."""
        z = np.clip(scores[:, None] - self.thresholds[None, :], -60, 60)
        return 1 / (1 + np.exp(-z))


def screened(rows: list[np.ndarray], grades: np.ndarray, bits: int = BITS, least_z: float = 4.0, least_rows: int = 4) -> np.ndarray:
    """Which features get a weight: those whose rows' mean grade is `least_z` standard errors from the overall mean.

    Long documents hold hundreds of neutral words, whose small weights would add up to noise.
    """
    flat = np.concatenate(rows)
    each = np.repeat(grades.astype(np.float64), [len(r) for r in rows])
    n = np.bincount(flat, minlength=1 << bits)
    mean = np.bincount(flat, weights=each, minlength=1 << bits) / np.maximum(n, 1)
    z = np.abs(mean - grades.mean()) / max(grades.std(), 1e-9) * np.sqrt(n)
    return (n >= least_rows) & (z >= least_z)


def gradients(s: np.ndarray, y: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of -log P(grade = y): by the score of each row, and by each threshold, summed over rows."""
    edges = np.concatenate([np.full((len(s), 1), 60.0), np.clip(s[:, None] - t, -60, 60), np.full((len(s), 1), -60.0)], axis=1)
    tail = 1 / (1 + np.exp(-edges))
    rows = np.arange(len(s))
    up, down = tail[rows, y], tail[rows, y + 1]  # P(>= y), P(>= y + 1)
    p = np.maximum(up - down, 1e-9)
    du, dd = up * (1 - up) / p, down * (1 - down) / p
    dt = np.zeros(len(t) + 2)
    np.add.at(dt, y, du)
    np.add.at(dt, y + 1, -dd)
    return dd - du, dt[1:-1]


#: The least distance of neighbouring thresholds while weights are fitted.
GAP = 1e-3


def in_order(t: np.ndarray, gap: float = GAP) -> np.ndarray:
    """The thresholds, raised where they must be to lie `gap` apart; those that do are left as they are."""
    steps = np.arange(len(t)) * gap
    return np.maximum.accumulate(t - steps) + steps


def levelled(scores: np.ndarray, share: np.ndarray) -> np.ndarray:
    """The thresholds under which the mean tail probabilities are `share`, by bisection; they rise as the shares fall."""
    lo, hi = np.full(len(share), scores.min() - 20.0), np.full(len(share), scores.max() + 20.0)
    for _ in range(60):
        mid = (lo + hi) / 2
        mean = np.array([(1 / (1 + np.exp(-np.clip(scores - m, -60, 60)))).mean() for m in mid])
        lo, hi = np.where(mean > share, mid, lo), np.where(mean > share, hi, mid)
    return hi


def fit_ordinal(rows: list[np.ndarray], grades: np.ndarray, n_grades: int, bits: int = BITS, epochs: int = 30, rate: float = 0.3, ridge: float = 3e-5, batch: int = 64, seed: int = 7) -> OrdinalModel:
    """Adagrad on the likelihood of the cumulative link, thresholds kept in order; then thresholds alone, to the shares."""
    use = screened(rows, grades, bits)
    rows = [r[use[r]] for r in rows]
    flat, starts = np.concatenate(rows), np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    w, g2 = np.zeros(1 << bits), np.full(1 << bits, 1e-8)
    share = np.array([(grades >= k).mean() for k in range(1, n_grades)]).clip(1e-3, 1 - 1e-3)
    t = -np.log(share / (1 - share))  # increasing, since the shares fall
    tg2, order = np.full(len(t), 1e-8), np.random.default_rng(seed)
    for _ in range(epochs):
        perm = order.permutation(len(rows))
        for lo in range(0, len(perm), batch):
            part = perm[lo : lo + batch]
            idx = np.concatenate([flat[starts[i] : starts[i + 1]] for i in part])
            own = np.repeat(np.arange(len(part)), [starts[i + 1] - starts[i] for i in part])
            ds, dt = gradients(np.bincount(own, weights=w[idx], minlength=len(part)), grades[part], t)
            grad = np.bincount(idx, weights=ds[own], minlength=len(w))
            touched = np.unique(idx)
            gt = grad[touched] / len(part) + ridge * w[touched]
            g2[touched] += gt * gt
            w[touched] -= rate * gt / np.sqrt(g2[touched] + 1e-4)
            gt = dt / len(part)
            tg2 += gt * gt
            t = in_order(t - rate * gt / np.sqrt(tg2))
    w = w.astype(np.float32)
    each = np.repeat(np.arange(len(rows)), np.diff(starts))
    return OrdinalModel(w, levelled(np.bincount(each, weights=w[flat], minlength=len(rows)), share))


def _features(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for part in texts:
        yield part.map(lambda x: features(x).tobytes())


def labelled(docs: DataFrame, grades: DataFrame, id_col: str, text_col: str, max_rows: int, max_features: int = MAX_FEATURES) -> tuple[list[np.ndarray], np.ndarray]:
    """Features and grades of a bounded sample of the labelled rows, on the driver."""
    spark = docs.sparkSession
    tune(spark)
    some = grades.select(F.col("doc_id").cast("bigint").alias("_id"), F.col("grade").cast("int").alias("_grade")).dropna()
    some = hashed_sample(some, "_id", max_rows, "_grade")
    found = docs.select(F.col(id_col).cast("bigint").alias("_id"), text_or_empty(text_col).alias("_text")).join(F.broadcast(some), "_id")
    found = materialize(found.select("_id", "_grade", F.pandas_udf(_features, "binary")("_text").alias("_feats")), "quality-features")
    sizes = found.groupBy("_id").agg((F.sum(F.octet_length("_feats")) / 4).alias("size")).orderBy(F.xxhash64("_id"), "_id").collect()
    taken = [r["_id"] for r, upto in zip(sizes, np.cumsum([r["size"] for r in sizes])) if upto <= max_features]
    if len(taken) < len(sizes):
        found = found.join(F.broadcast(spark.createDataFrame([(i,) for i in taken], "_id long")), "_id")
    got = found.toArrow()
    release(found)
    feats = got["_feats"].to_pylist()
    grade = got["_grade"].to_numpy()
    order = sorted(range(len(feats)), key=lambda i: (got["_id"][i].as_py(), grade[i], feats[i]))
    return [np.frombuffer(feats[i], dtype=np.int32) for i in order], grade[order]


def train(docs: DataFrame, grades: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_grades: int = 3, max_rows: int = MAX_ROWS) -> OrdinalModel | None:
    """A model from grades (doc_id, grade 0..n_grades-1); None where the labels can't tell grades apart."""
    rows, y = labelled(docs, grades, id_col, text_col, max_rows)
    if len(set(y.tolist())) < 2:
        return None
    return fit_ordinal(rows, y.astype(np.int64), n_grades)


def grades_of_labels(labels: DataFrame) -> DataFrame:
    """Graded ratings from two flags: 0 poor quality, 1 good but toxic, 2 good and clean."""
    return labels.select("doc_id", F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when((F.col("quality") == 1) & (F.col("toxic") == 0), 2).alias("grade"))


def score_column(model: OrdinalModel, text: Column) -> Column:
    at = np.flatnonzero(model.weights)
    values = model.weights[at]

    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = np.zeros(1 << BITS, dtype=np.float32)
        own[at] = values
        for part in texts:
            yield part.map(lambda x: float(own[features(x)].sum(dtype=np.float64)))

    return F.pandas_udf(run, "double")(text)


def tail(score: Column, threshold: float) -> Column:
    return 1 / (1 + F.exp(F.lit(float(threshold)) - score))


def grade_documents(docs: DataFrame, model: OrdinalModel | None, id_col: str = "doc_id", text_col: str = "text", least_grade: int = 2, least_tail: float = 0.5) -> DataFrame:
    """doc_id, score, expected_grade, p_ge_1.., selected: P(grade >= least_grade) is at least least_tail."""
    tune(docs.sparkSession)
    ids = F.col(id_col).cast("bigint").alias("doc_id")
    if model is None:
        nothing = F.lit(None).cast("double")
        return docs.select(ids, nothing.alias("score"), nothing.alias("expected_grade"), *[nothing.alias(f"p_ge_{k}") for k in range(1, least_grade + 1)], F.lit(True).alias("selected"))
    scored = docs.select(ids, score_column(model, text_or_empty(text_col)).alias("score"))
    tails = [tail(F.col("score"), t) for t in model.thresholds]
    return scored.select(
        "doc_id", "score", sum(tails[1:], tails[0]).alias("expected_grade"), *[p.alias(f"p_ge_{k}") for k, p in enumerate(tails, 1)], (tails[least_grade - 1] >= least_tail).alias("selected")
    )


def drop_poor(docs: DataFrame, model: OrdinalModel | None, text_col: str = "text", least_grade: int = 2, least_tail: float = 0.5) -> DataFrame:
    """docs that the classifier selects, all columns as they were, in one pass and without a shuffle."""
    if model is None:
        return docs
    tune(docs.sparkSession)
    name = unused("_tidewright_score", docs)
    scored = docs.withColumn(name, score_column(model, text_or_empty(text_col)))
    return scored.where(tail(F.col(name), model.thresholds[least_grade - 1]) >= least_tail).drop(name)
