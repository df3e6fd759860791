"""Secret scans: fixed patterns, and character Markov models compared by log-likelihood ratio.

The base kinds are patterns (an assigned value, an access key, a run of hex digits). The method adds spans of kind
`markov`: runs of key characters that overlap no base span and that a Markov chain of secrets explains better, by a
threshold in bits, than a chain of ordinary identifiers. Both chains are of order one over the single characters, and
are trained on labelled samples:

    secret     random strings over the usual alphabets of keys, the values that base spans of the corpus assign, and
               access keys
    ordinary   identifiers of the usual kinds put together from words and numbers (snake, camel and kebab case, URL
               paths, hosts, pods, versions, times), and the distinct words of every document outside base spans

The generated samples are fixed in number; what the corpus gives is counted over all documents, without a sample or a
bound, and weighs at most as much as the generated ordinary ones (values: a quarter of the generated secrets), so that
chains come out alike at every size. A caller's own labelled rows count each as one sample.

Ordinary for the chains are UUIDs, digests and commit ids in either case, and the random ends of pod names: they name
things and open nothing. A run of 24 lower-case hex digits is found by its base kind all the same. Letters alone are
judged like any other run; runs without any letter are numbers or rules and are not asked.

Defined results: null text is empty; a text without finds has zero counts, empty spans and the hash of the empty
string; rows repeat as they come, each counts as a document; a null identifier stays null; an empty table gives no
rows, and a model of the generated samples; labelled rows with nulls are left out; further columns are not read. Very
long texts are scanned as a whole.
"""

from __future__ import annotations

import hashlib
import random
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty, tune

#: The base kinds in order, with their patterns and least lengths (of group 2, of the match, of the match).
KINDS = ("assign", "access", "hex", "markov")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_VALUE, LEAST_ACCESS = 6, 20
#: Words that any assignment holds; texts without one are not searched for them.
HINTS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

RUN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_UPPER, _LOWER, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
#: Alphabets of the generated secrets.
SHAPES = (_UPPER + _LOWER + _DIGITS + "+/", _UPPER + _LOWER + _DIGITS, _UPPER + _LOWER + _DIGITS + "_-", _LOWER + _DIGITS, _UPPER + _DIGITS)
#: Words of the generated identifiers.
PARTS = """account action admin array async backup batch block body buffer build cache call channel check child class client cluster
    color column command comment config connect content context count create cursor custom data date debug default deploy device
    directory display document domain driver element email enable encode engine entry error event example export factory feature
    field file filter find flag folder format frame function gateway global graph group handler header height helper history host
    image import index info init input install instance integer item job json language layout length library limit line link list
    load local location lock main manager map match max memory menu message method metric min mode model module monitor name native
    network next node number object offset option order output owner package page parent path pattern pipeline plan platform""".split()  # fmt: skip
#: What the random ends of pod names are made of.
POD = "bcdfghjklmnpqrstvwxz2456789"
GENERATED = 40_000
LETTER = re.compile("[A-Za-z]")
WORD = re.compile(r"[A-Za-z0-9+/_=-]{3,}")
#: Bits by which the chain of secrets must win, over the whole run and for each character.
LEAST_BITS, LEAST_RATE = 20.0, 1.0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind number) in code points, end exclusive: leftmost non-overlapping within a kind."""
    found = []
    low = text.encode().lower()
    if any(h in low for h in HINTS):
        found += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m.group(2)) >= LEAST_VALUE]
    if "AKIA" in text:
        found += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return sorted(found, key=lambda x: (x[0], x[2]))


@dataclass
class MarkovPair:
    """ratio[a, b]: bits by which `secret` beats `ordinary` for b after a; row len(ALPHABET) is the start of a run."""

    ratio: np.ndarray

    def bits(self, run: str) -> float:
        at = CODES[np.frombuffer(run.encode("ascii"), dtype=np.uint8)]
        return float(self.ratio[len(ALPHABET), at[0]] + self.ratio[at[:-1], at[1:]].sum())


SIDE = len(ALPHABET)
CODES = np.full(256, SIDE, dtype=np.int64)  # all other characters end a run, like its start
CODES[[ord(c) for c in ALPHABET]] = np.arange(SIDE)


def transitions(samples) -> np.ndarray:
    """How often each character follows each other one, or begins (last row), in all samples together."""
    at = CODES[np.frombuffer("\n".join(["", *samples]).encode("ascii"), dtype=np.uint8)]
    cell = at[:-1] * SIDE + at[1:]
    return np.bincount(cell[at[1:] < SIDE], minlength=(SIDE + 1) * SIDE).reshape(SIDE + 1, SIDE)


def chain(counts: np.ndarray, prior: float) -> np.ndarray:
    """log2 of smoothed transition probabilities."""
    soft = counts + prior
    return np.log2(soft / soft.sum(axis=1, keepdims=True))


def generated_secret(rnd: random.Random) -> str:
    return "".join(rnd.choices(rnd.choice(SHAPES), k=rnd.randint(16, 48)))


def generated_name(rnd: random.Random) -> str:
    """An identifier of one of the usual kinds."""
    words = [rnd.choice(PARTS) for _ in range(rnd.randint(2, 5))]
    some = lambda alphabet, n: "".join(rnd.choices(alphabet, k=n))
    titled = [w.title() for w in words]
    hexed = some("0123456789abcdef", rnd.choice((16, 24, 32, 40, 64)))
    uuid = "-".join(some("0123456789abcdef", n) for n in (8, 4, 4, 4, 12))
    kinds = (
        "_".join(words), "_".join(words).upper(), "-".join(words), "".join(titled), words[0] + "".join(titled[1:]), "".join(words), "/" + "/".join(words), uuid, uuid.upper(), hexed, hexed.upper(),
        "-".join(words[:2]) + f"-{some(POD, rnd.randint(8, 10))}-{some(POD, 5)}", "-".join(words[:2]) + rnd.choice("-_") + some(_DIGITS, rnd.randint(2, 12)), "-".join(words[:2]) + "-v" + "-".join(some(_DIGITS, 3)),
        f"20{some(_DIGITS, 6)}T{some(_DIGITS, 6)}Z-{words[0]}", f"{words[0]}-{rnd.choice(('east', 'west', 'north', 'south'))}-{some(_DIGITS, 1)}/{words[1]}-{some(_DIGITS, 2)}",
    )
    return rnd.choice(kinds)


def train(words: np.ndarray | None = None, values: np.ndarray | None = None, seed: int = 11, generated: int = GENERATED) -> MarkovPair:
    """words, values: transitions of ordinary words and of secrets from elsewhere, which weigh no more than the generated ones."""
    rnd = random.Random(seed)
    secret, ordinary = (transitions(make(rnd) for _ in range(generated)).astype(float) for make in (generated_secret, generated_name))
    for own, more, most in ((ordinary, words, 1.0), (secret, values, 0.25)):
        if more is not None and more.sum():
            own += more * min(1.0, most * own.sum() / more.sum())
    return MarkovPair(chain(secret, 0.5) - chain(ordinary, 0.1))


def labelled(text: str) -> tuple[set[str], list[str]]:
    """(ordinary words, secrets) of one text, by its base spans."""
    words, values, at = set(), [], 0
    for start, end, kind in base_spans(text):
        words.update(WORD.findall(text, at, max(at, start)))
        if kind == 0:
            values.append(ASSIGN.match(text, start).group(2).replace(".", "\n"))
        elif kind == 1:
            values.append(text[start:end])
        at = max(at, end)
    words.update(WORD.findall(text, at))
    return words, values


def spans(text: str, model: MarkovPair | None) -> list[tuple[int, int, int]]:
    """Base spans, and runs that the random chain explains better and no base span overlaps; by start, then kind."""
    found = base_spans(text)
    if model is None:
        return found
    more = []
    for m in RUN.finditer(text):
        run = m.group()
        if not LETTER.search(run):  # plain numbers, rules
            continue
        if any(s < m.end() and m.start() < e for s, e, _ in found):
            continue
        bits = model.bits(run)
        if bits >= LEAST_BITS and bits >= LEAST_RATE * len(run):
            more.append((m.start(), m.end(), 3))
    return sorted(found + more, key=lambda x: (x[0], x[2])) if more else found


def shown(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k in found)


ROW = "doc_id long, n_assign long, n_access long, n_hex long, n_markov long, base_sha256 string, spans string"
_ARROW = pa.schema([("doc_id", pa.int64())] + [(f"n_{k}", pa.int64()) for k in KINDS] + [("base_sha256", pa.string()), ("spans", pa.string())])


def _scan(model: MarkovPair):
    def run(batches):
        for b in batches:
            rows = []
            for i in range(b.num_rows):
                found = spans(b.column(1)[i].as_py(), model)
                base = shown([x for x in found if x[2] < 3])
                rows.append((b.column(0)[i].as_py(), *(sum(x[2] == k for x in found) for k in range(4)), hashlib.sha256(base.encode()).hexdigest(), shown(found)))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _ARROW.types)] if rows else [pa.array([], t) for t in _ARROW.types], schema=_ARROW)

    return run


def _count(batches):
    """What a task's texts add to the transitions of words (0) and of values (1)."""
    total = np.zeros((2, (SIDE + 1) * SIDE), dtype=np.int64)
    for b in batches:
        for x in b.column(0):
            for k, samples in enumerate(labelled(x.as_py())):
                if samples:
                    total[k] += transitions(samples).ravel()
    kind, cell = np.nonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(cell, pa.int32()), pa.array(total[kind, cell])], names=["kind", "cell", "n"])


def _count_rows(batches):
    total = np.zeros((2, (SIDE + 1) * SIDE), dtype=np.int64)
    for b in batches:
        for x, secret in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            total[int(secret)] += transitions(WORD.findall(x)).ravel()
    kind, cell = np.nonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(cell, pa.int32()), pa.array(total[kind, cell])], names=["kind", "cell", "n"])


def train_on(docs: DataFrame, text_col: str = "text", samples: DataFrame | None = None) -> MarkovPair:
    """A model from the samples that all documents give, and from the caller's labelled ones (text, secret: boolean)."""
    tune(docs.sparkSession)
    schema = "kind int, cell int, n long"
    rows = docs.select(text_or_empty(text_col).alias("text")).mapInArrow(_count, schema)
    if samples is not None:
        rows = rows.unionAll(samples.select(F.col("text").cast("string"), F.col("secret").cast("boolean")).dropna().mapInArrow(_count_rows, schema))
    total = np.zeros((2, (SIDE + 1) * SIDE))
    for r in rows.groupBy("kind", "cell").agg(F.sum("n").alias("n")).collect():  # 9,000 cells at most
        total[r["kind"], r["cell"]] = r["n"]
    words, values = total.reshape(2, SIDE + 1, SIDE)
    return train(words, values)


def scan_secrets(docs: DataFrame, model: MarkovPair, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, counts of each kind, base_sha256, spans: one row a document, no shuffle."""
    tune(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(_scan(model), ROW)
