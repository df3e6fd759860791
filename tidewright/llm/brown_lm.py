"""Scoring texts with a Brown class-based bigram model.

The `head` most frequent words are put into classes by exchange clustering; all rarer words are one more class, the
texts' end another. A class bigram model of the training texts has the log likelihood, up to a constant,

    sum over (p, c) of N(p, c) log N(p, c)  -  2 * sum over c of N(c) log N(c)

N(p, c): how often class c follows class p. In a round every head word is offered the class under which this grows
most by the present classes of all its neighbours, its own counts taken out of the class it comes from; all words move
at once, and the tables are counted anew. A round that does not raise the likelihood is tried again with half of its
moves, and undone if that does not either, so the likelihood never falls (`Classes.likelihoods`).

Neighbours of head words are counted once, as numbers of head words: a row a word, at most twice the head's length,
whatever the size of the corpus. The HEAVY most frequent words, which occur in every chunk, are not gathered in one
row: their rows stay dealt over tasks, and each round sums what these hold by class, a table of fixed size on which
the driver decides for them. So a round is two passes over the rows, and what moves is bounded by head and classes.

The model gives a token w after class p the probability

    (1 - unseen(p)) * P(class of w | p) * n(w) / n(class of w)      a word of the training texts
    unseen(p)                                                       any other word, all of them one symbol

P(c | p) is the smoothed class transition, n(w) / n(c) the word's emission, and unseen(p) comes from the training
words that occur once: had their text been left out, they would have been unseen. Texts begin and end with `end`.

Texts are cut into words once. Each task writes chunks of a bounded number of tokens: the chunk's distinct words, and
its texts as numbers of these; every later pass looks words up by chunk and works on numbers. The head is broadcast:
HEAD words of at most HEAD_BYTES bytes. All others are looked up by a join on the word, one row for each chunk that
holds it with its places there, and return to their chunk.

Defined results: null text is empty and consists of its end; a null identifier trains (it has no remainder); rows
repeat as they come; words that are equally frequent are ordered by their bytes, and of classes that are equally good
the first is taken; without training texts every probability is 1; an empty table gives no rows; further columns are
not read. Very long texts are read as a whole.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, release, settle, text_or_empty, tune

CLASSES = 64
ROUNDS = 5
#: Words that have classes and are broadcast: at most so many, of at most so many bytes each.
HEAD, HEAD_BYTES = 1 << 18, 64
#: So many of the most frequent words are decided on the driver.
HEAVY = 1024
#: Weight of the class unigram in a class transition.
PRIOR = 10.0
#: A chunk ends with the text that brings it to so many distinct words or tokens.
CHUNK_WORDS, CHUNK_TOKENS = 300_000, 2_000_000

ENTRY = np.dtype([("ctx", "<u2"), ("n", "<u4")])
TAIL = 255  # the code of tokens that are yet to be looked up


def words_of(text: bytes) -> list[bytes]:
    """A-Z lower-cased, cut at [\\x20\\x09-\\x0D]; bytes know no other letters and spaces."""
    return text.lower().split()


def is_held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 1, F.lit(False))


def _binary(data: bytes, ends: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data)])


def _entries(vecs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(entries, row of each entry) of a binary column."""
    sizes = np.fromiter(map(len, vecs), dtype=np.int64, count=len(vecs)) // ENTRY.itemsize
    return np.frombuffer(b"".join(vecs), dtype=ENTRY), np.repeat(np.arange(len(vecs)), sizes)


# --- chunks ---------------------------------------------------------------------------------------------------------

CHUNK = "chunk long, words binary, tokens binary, lens binary, ids binary, named binary, held binary"
_CHUNK = pa.schema([("chunk", pa.int64())] + [(n, pa.binary()) for n in ("words", "tokens", "lens", "ids", "named", "held")])


def _encode(chunk_words: int, chunk_tokens: int):
    def run(batches):
        part, made = TaskContext.get().partitionId(), 0
        index: dict[bytes, int] = defaultdict(count().__next__)
        tokens, lens, ids, held, total = [], [], [], [], 0

        def row():
            named = np.array([x is not None for x in ids], dtype=np.uint8)
            numbers = np.array([x or 0 for x in ids], dtype="<i8")
            columns = b"\n".join(index), np.concatenate(tokens).tobytes(), np.array(lens, dtype="<u4").tobytes(), numbers.tobytes(), named.tobytes(), np.array(held, dtype=np.uint8).tobytes()
            return pa.RecordBatch.from_arrays([pa.array([part << 36 | made], pa.int64()), *(pa.array([c], pa.binary()) for c in columns)], schema=_CHUNK)

        for b in batches:
            for i in range(b.num_rows):
                words = words_of(b.column(0)[i].as_py())
                tokens.append(np.fromiter(map(index.__getitem__, words), dtype="<u4", count=len(words)))
                lens.append(len(words))
                ids.append(b.column(1)[i].as_py())
                held.append(b.column(2)[i].as_py())
                total += len(words)
                if total >= chunk_tokens or len(index) >= chunk_words:
                    yield row()
                    made, index, total = made + 1, defaultdict(count().__next__), 0
                    tokens, lens, ids, held = [], [], [], []
        if lens:
            yield row()

    return run


class Chunk:
    """A row of chunks, columns as in CHUNK or the first of them."""

    def __init__(self, batch: pa.RecordBatch, row: int):
        get = lambda name: batch.column(batch.schema.get_field_index(name))[row].as_py()
        self.key, words = get("chunk"), get("words")
        self.words = words.split(b"\n") if words else []
        self.tokens, self.lens = np.frombuffer(get("tokens"), dtype="<u4"), np.frombuffer(get("lens"), dtype="<u4").astype(np.int64)
        self.held = np.frombuffer(get("held"), dtype=np.uint8).astype(bool)

    def training(self) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of the texts that are not held out, and where each text that has any ends among them."""
        lens = self.lens[~self.held]
        return self.tokens[np.repeat(~self.held, self.lens)].astype(np.int64), np.cumsum(lens[lens > 0])


def _chunks(batches) -> Iterator[Chunk]:
    for b in batches:
        for i in range(b.num_rows):
            yield Chunk(b, i)


# --- counting -------------------------------------------------------------------------------------------------------

_COUNT = pa.schema([("word", pa.binary()), ("n", pa.int64())])


def _count(batches):
    for c in _chunks(batches):
        n = np.bincount(c.training()[0], minlength=len(c.words))
        there = pa.array(np.flatnonzero(n))
        if len(there):
            yield pa.RecordBatch.from_arrays([pa.array(c.words, pa.binary()).take(there), pa.array(n).take(there)], schema=_COUNT)


# --- neighbours -----------------------------------------------------------------------------------------------------

NEIGHBOURS = "owner int, salt int, codes binary, times binary"
_NEIGHBOURS = pa.schema([("owner", pa.int32()), ("salt", pa.int32()), ("codes", pa.binary()), ("times", pa.binary())])
SALTED = 1 << 12


def _rows_of(owner: np.ndarray, codes: np.ndarray, n: np.ndarray, salts: np.ndarray, most: int = 20_000) -> Iterator[pa.RecordBatch]:
    """Entries sorted by owner as rows, one an owner; salts: by owner's place among the rows."""
    owners, first = np.unique(owner, return_index=True)
    ends = np.concatenate([first[1:], [len(owner)]])
    n = np.minimum(n, 2**32 - 1)
    for lo in range(0, len(owners), most):
        base, stop = int(first[lo]), ends[lo : lo + most]
        last = int(stop[-1])
        data = [_binary(x[base:last].astype("<u4").tobytes(), (stop - base) * 4) for x in (codes, n)]
        yield pa.RecordBatch.from_arrays([pa.array(owners[lo : lo + most].astype(np.int32)), pa.array(salts[owners[lo : lo + most]].astype(np.int32)), *data], schema=_NEIGHBOURS)


def _neighbours(head, n_head: int, heavy: int):
    """Per head word what stands left (codes 0..n_head+1) and right (from n_head+2) of it: a head word's number, n_head for any other word, n_head+1 for the end."""
    width = 2 * (n_head + 2)

    def run(batches):
        for c in _chunks(batches):
            at, ends = c.training()
            if not len(at):
                continue
            own = _in_head(c, head.value.get)[at]
            ctx = np.where(own < 0, n_head, own)
            left, right = np.roll(ctx, 1), np.roll(ctx, -1)
            left[np.concatenate([[0], ends[:-1]])] = n_head + 1
            right[ends - 1] = n_head + 1
            there = own >= 0
            own = own[there] * width
            codes, n = np.unique(np.concatenate([own + left[there], own + right[there] + n_head + 2]), return_counts=True)
            salts = np.where(np.arange(max(n_head, 1)) < heavy, c.key % SALTED, 0)
            yield from _rows_of(codes // width, codes % width, n, salts)

    return run


def _entries_of(codes: list[bytes], times: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, times, row of each entry) of two binary columns."""
    sizes = np.fromiter(map(len, codes), dtype=np.int64, count=len(codes)) // 4
    return np.frombuffer(b"".join(codes), dtype="<u4"), np.frombuffer(b"".join(times), dtype="<u4"), np.repeat(np.arange(len(codes)), sizes)


def _merge(width: int, rows: int = 8192):
    """Rows sorted by owner: one row an owner and task."""

    def merged(owner, codes, times) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        c, n, row = _entries_of(codes, times)
        key = np.array(owner, dtype=np.int64)[row] * width + c
        order = np.argsort(key, kind="stable")  # runs that are sorted already
        key = key[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        return key[first] // width, key[first] % width, np.add.reduceat(n[order].astype(np.int64), first)

    def run(batches):
        owner, codes, times, held = [], [], [], 0
        for b in batches:
            o, c, t = (b.column(b.schema.get_field_index(k)).to_pylist() for k in ("owner", "codes", "times"))
            owner, codes, times, held = owner + o, codes + c, times + t, held + sum(map(len, c))
            if len(owner) < rows and held < 32 << 20:
                continue
            done = len(owner)
            while done and owner[done - 1] == owner[-1]:
                done -= 1
            if done:
                whole = merged(owner[:done], codes[:done], times[:done])
                yield from _rows_of(*whole, np.zeros(whole[0].max() + 1))
                owner, codes, times = owner[done:], codes[done:], times[done:]
            if len(owner) > 1:  # what is there of the last owner, as one row
                whole = merged(owner, codes, times)
                last = next(_rows_of(*whole, np.zeros(whole[0].max() + 1)))
                owner, codes, times = owner[-1:], last.column(2).to_pylist(), last.column(3).to_pylist()
            held = sum(map(len, codes))
        if owner:
            whole = merged(owner, codes, times)
            yield from _rows_of(*whole, np.zeros(whole[0].max() + 1))

    return run


# --- exchange -------------------------------------------------------------------------------------------------------


def _g(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def class_likelihood(table: np.ndarray, n_classes: int) -> float:
    """Of tables (class by class of the neighbour, left and right), up to what no exchange changes."""
    half = n_classes + 2
    left, right = table[:, :half], table[:, half:]
    return float(_g(right).sum() + _g(left[:, n_classes:]).sum() - 2 * _g(right.sum(axis=1)).sum())


def seeded(dense: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The seed's class whose neighbours (rows of table) make each word's (rows of dense) most likely."""
    soft, half = table + 0.1, table.shape[1] // 2
    logs = np.concatenate([np.log(x / x.sum(axis=1, keepdims=True)) for x in (soft[:, :half], soft[:, half:])], axis=1)
    return (dense @ logs.T).argmax(axis=1)


def moved(dense: np.ndarray, own: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The best class of each word for what it adds to the likelihood, to first order; for many words of few counts."""
    half = table.shape[1] // 2
    n, size = dense[:, half:].sum(axis=1), table[:, half:].sum(axis=1)
    score = dense @ np.log(table + 0.5).T - 2 * n[:, None] * np.log(size + 1)
    rest = np.maximum(table[own] - dense, 0)
    rows = np.arange(len(own))
    score[rows, own] = (dense * np.log(rest + 0.5)).sum(axis=1) - 2 * n * np.log(np.maximum(size[own] - n, 0) + 1)
    best = score.argmax(axis=1)
    return np.where(score[rows, best] > score[rows, own] + 1e-9, best, own)


def moved_exactly(dense: np.ndarray, own: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The same for words whose counts are a good part of a class: by the differences of N log N themselves."""
    half = table.shape[1] // 2
    size, out = table[:, half:].sum(axis=1), own.copy()
    for k in range(len(own)):
        n = dense[k, half:].sum()
        if not n:
            continue
        without, sizes = table.copy(), size.copy()
        without[own[k]] = np.maximum(without[own[k]] - dense[k], 0)
        sizes[own[k]] -= n
        gain = (_g(without + dense[k]) - _g(without)).sum(axis=1) - 2 * (_g(sizes + n) - _g(sizes))
        best = int(gain.argmax())
        out[k] = best if gain[best] > gain[own[k]] + 1e-9 else own[k]
    return out


_CELL = pa.schema([("kind", pa.int32()), ("at", pa.int64()), ("n", pa.int64())])
TABLE, WEIGHTY, MOVE = 0, 1, 2


def _pass(class_of: np.ndarray, n_classes: int, heavy: int, table: np.ndarray | None, decide):
    """A pass over the rows of neighbours: without a table, what a task adds to it; with one, moves of words, and neighbours by class of the heavy ones.

    class_of: by number of head word, n_classes for words that have none yet.
    """
    half = n_classes + 2
    by_context = np.concatenate([class_of, [n_classes, n_classes + 1]]).astype(np.int64)
    cell = np.concatenate([by_context, by_context + half])

    def run(batches):
        total, weighty, owners, classes = np.zeros((n_classes + 1) * 2 * half), np.zeros(heavy * 2 * half), [], []
        for b in batches:
            for lo in range(0, b.num_rows, 4096):
                owner, codes, times = (b.column(b.schema.get_field_index(k)).slice(lo, 4096) for k in ("owner", "codes", "times"))
                owner = owner.to_numpy(zero_copy_only=False)
                codes, n, row = _entries_of(codes.to_pylist(), times.to_pylist())
                if table is None:
                    total += np.bincount(class_of[owner].astype(np.int64)[row] * 2 * half + cell[codes], weights=n, minlength=len(total))
                    continue
                dense = np.bincount(row * 2 * half + cell[codes], weights=n, minlength=len(owner) * 2 * half).reshape(len(owner), 2 * half)
                some = owner < heavy
                if some.any():
                    weighty += np.bincount((owner[some, None].astype(np.int64) * 2 * half + np.arange(2 * half)).ravel(), weights=dense[some].ravel(), minlength=len(weighty))
                new = decide(dense[~some], class_of[owner[~some]].astype(np.int64), table)
                changed = new != class_of[owner[~some]]
                owners.append(owner[~some][changed])
                classes.append(new[changed])
        for kind, at, n in ((TABLE, np.flatnonzero(total), total), (WEIGHTY, np.flatnonzero(weighty), weighty)):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), kind), pa.int32()), pa.array(at, pa.int64()), pa.array(n[at].astype(np.int64))], schema=_CELL)
        if owners:
            at = np.concatenate(owners)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), MOVE), pa.int32()), pa.array(at, pa.int64()), pa.array(np.concatenate(classes), pa.int64())], schema=_CELL)

    return run


class Exchange:
    """Rounds over `rows` (owner, codes, times), one row an owner but for the heavy ones."""

    def __init__(self, rows: DataFrame, n_head: int, n_classes: int, heavy: int = HEAVY):
        self.rows, self.n_head, self.n_classes, self.heavy = rows.select("owner", "codes", "times"), n_head, n_classes, min(heavy, n_head)
        self.likelihoods: list[float] = []

    def _cells(self, class_of, table=None, decide=None) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        found = self.rows.mapInArrow(_pass(class_of, self.n_classes, self.heavy, table, decide), "kind int, at long, n long")
        got = found.groupBy("kind", "at").agg(F.sum("n").alias("n")).toArrow()
        kind, at, n = (got[c].to_numpy() for c in ("kind", "at", "n"))
        return {k: (at[kind == k], n[kind == k]) for k in (TABLE, WEIGHTY, MOVE)}

    def table(self, class_of: np.ndarray) -> np.ndarray:
        out = np.zeros((self.n_classes + 1) * 2 * (self.n_classes + 2))
        at, n = self._cells(class_of)[TABLE]
        out[at] = n
        return out.reshape(self.n_classes + 1, -1)[: self.n_classes]

    def offered(self, class_of: np.ndarray, table: np.ndarray, many, few) -> np.ndarray:
        """The class that each head word would move to."""
        cells = self._cells(class_of, table, many)
        out = class_of.copy()
        at, klass = cells[MOVE]
        out[at] = klass
        dense = np.zeros(self.heavy * table.shape[1])
        at, n = cells[WEIGHTY]
        dense[at] = n
        out[: self.heavy] = few(dense.reshape(self.heavy, table.shape[1]), class_of[: self.heavy].astype(np.int64), table)
        return out

    def run(self, rounds: int) -> np.ndarray:
        """Classes of the head words, from the most frequent ones as seeds."""
        k = self.n_classes
        seeds = np.where(np.arange(self.n_head) < k, np.arange(self.n_head), k).astype(np.uint8)
        by_seed = lambda dense, own, table: seeded(dense, table) if len(dense) else own
        best = self.offered(seeds, self.table(seeds), by_seed, by_seed)
        table = self.table(best)
        self.likelihoods = [class_likelihood(table, k)]
        half = np.random.default_rng(1).random(self.n_head) < 0.5
        for _ in range(rounds):
            new = self.offered(best, table, moved, moved_exactly)
            for tried in (new, np.where(half, new, best)):
                if (tried == best).all():
                    continue
                counted = self.table(tried)
                if class_likelihood(counted, k) > self.likelihoods[-1]:
                    best, table = tried, counted
                    self.likelihoods.append(class_likelihood(counted, k))
                    break
            else:
                break
        return best


@dataclass
class Classes:
    """counts: word, n of every training word; head: number of a word, by frequency; n, klass: by that number."""

    counts: DataFrame
    head: dict[bytes, int]
    n: np.ndarray
    klass: np.ndarray
    sizes: np.ndarray  # tokens of each class; the last but one is that of all words outside the head, the last the end's
    tokens: int
    types: int
    once: int
    likelihoods: list[float]


def _many_rows(spark: SparkSession) -> None:
    """Batches for tables of words, which are short rows; those of chunks stay small by their bytes."""
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "8192")


def most_frequent(words: DataFrame, k: int) -> DataFrame:
    """The k words of largest n, by n and word. A histogram of the counts tells from where on they lie, so that no task orders more than about k words."""
    step = F.floor(F.log2("n") * 16)
    left, least = k, 0
    for r in sorted(words.groupBy(step.alias("step")).agg(F.count("*").alias("n")).collect(), reverse=True):
        least, left = r.step, left - r.n
        if left <= 0:
            break
    return words.where(step >= least).orderBy(F.desc("n"), "word").limit(k)


def cluster(chunks: DataFrame, n_docs: int, n_classes: int = CLASSES, rounds: int = ROUNDS, head: int = HEAD, heavy: int = HEAVY) -> Classes:
    """Classes of the words of the n_docs texts that are not held out."""
    spark = chunks.sparkSession
    training = chunks.select("chunk", "words", "tokens", "lens", "held")
    counts = materialize(training.mapInArrow(_count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")), "lm-counts")
    tokens, types, once = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*"), F.count(F.when(F.col("n") == 1, 1))).first()
    top = most_frequent(counts.where(F.octet_length("word") <= HEAD_BYTES), head).toArrow()
    named, n = {w: i for i, w in enumerate(top["word"].to_pylist())}, top["n"].to_numpy().astype(np.int64)
    settle(spark)
    index = spark.sparkContext.broadcast(named)
    width = 2 * (len(named) + 2)
    dealt = training.mapInArrow(_neighbours(index, len(named), heavy), NEIGHBOURS).repartition("owner", "salt").sortWithinPartitions("owner")
    rows = materialize(dealt.mapInArrow(_merge(width), NEIGHBOURS), "lm-neighbours", "zstd")
    settle(spark)
    _many_rows(spark)
    exchange = Exchange(rows, len(named), n_classes, heavy)
    klass = exchange.run(rounds) if len(named) else np.zeros(0, dtype=np.uint8)
    release(rows)
    index.destroy()
    sizes = np.zeros(n_classes + 2)
    sizes[:n_classes] = np.bincount(klass, weights=n, minlength=n_classes)
    sizes[n_classes], sizes[n_classes + 1] = tokens - n.sum(), n_docs
    tune(spark)
    settle(spark)
    return Classes(counts, named, n, klass.astype(np.int64), sizes, tokens + n_docs, types + (n_docs > 0), once + (n_docs == 1), exchange.likelihoods)


# --- texts by classes -----------------------------------------------------------------------------------------------

PART = "chunk long, codes binary, once binary, lens binary, ids binary, named binary, held binary, known binary, base binary, emitted binary"
_PART = pa.schema([("chunk", pa.int64())] + [(n, pa.binary()) for n in ("codes", "once", "lens", "ids", "named", "held", "known", "base", "emitted")])
_RARE = pa.schema([("word", pa.binary()), ("chunk", pa.int64()), ("places", pa.binary())])
RARE = "word binary, chunk long, places binary"


def _in_head(c: Chunk, get) -> np.ndarray:
    """The place of each of a chunk's words in the head, or -1."""
    return np.fromiter(map(get, c.words, repeat(-1)), dtype=np.int64, count=len(c.words))


def _by_head(head):
    """A chunk as class codes of its tokens, with what frequent words add to its texts' sums; rare words are left open."""

    def run(batches):
        index, klass, base, emitted, once = head.value
        for b in batches:
            for i in range(b.num_rows):
                c = Chunk(b, i)
                at = _in_head(c, index.get)
                bounds = np.concatenate([[0], np.cumsum(c.lens)])
                # the last place of the tables stands for words that the head does not hold
                known, more, out = (np.diff(np.concatenate([[0.0], np.cumsum(x[c.tokens])])[bounds]) for x in ((at >= 0).astype(float), base[at], emitted[at]))
                codes, single = klass[at].astype(np.uint8)[c.tokens], np.packbits(once[at][c.tokens])
                same = [b.column(b.schema.get_field_index(k)).slice(i, 1) for k in ("lens", "ids", "named", "held")]
                sums = [pa.array([x.tobytes()], pa.binary()) for x in (known.astype("<i8"), more, out)]
                yield pa.RecordBatch.from_arrays([pa.array([c.key], pa.int64()), pa.array([codes.tobytes()], pa.binary()), pa.array([single.tobytes()], pa.binary()), *same, *sums], schema=_PART)

    return run


def _rare(head):
    """A row for each word of a chunk that the head does not hold, with its places among the chunk's tokens."""

    def run(batches):
        for c in _chunks(batches):
            at = np.flatnonzero((_in_head(c, head.value[0].get) < 0)[c.tokens])
            if not len(at):
                continue
            word = c.tokens[at]
            order = np.argsort(word, kind="stable")
            at, word = at[order].astype("<u4"), word[order]
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            ends = np.concatenate([first[1:], [len(word)]])
            names = pa.array(c.words, pa.binary())
            for lo in range(0, len(first), 50_000):
                base, stop = int(first[lo]), ends[lo : lo + 50_000]
                yield pa.RecordBatch.from_arrays([names.take(pa.array(word[first[lo : lo + 50_000]].astype(np.int64))), pa.array(np.full(len(stop), c.key)), _binary(at[base : int(stop[-1])].tobytes(), (stop - base) * 4)], schema=_RARE)

    return run


_STAT = pa.schema([("id", pa.int64()), ("held_out", pa.bool_()), ("tokens", pa.int64()), ("known", pa.int64()), ("base", pa.float64()), ("emitted", pa.float64()), ("moves", pa.binary()), ("more", pa.binary())])
STAT = "id long, held_out boolean, tokens long, known long, base double, emitted double, moves binary, more binary"


def transitions(codes: np.ndarray, once: np.ndarray, starts: np.ndarray, n_classes: int, training: np.ndarray):
    """Per document sparse counts of (class before, class), and for training documents what their single words stand for.

    codes: 0..n_classes-1 classes, n_classes the end, n_classes + 1 an unseen word; every document ends with the end.
    """
    side = n_classes + 2
    doc = np.zeros(len(codes), dtype=np.int64)
    doc[starts[1:]] = 1
    doc = np.cumsum(doc)
    first = np.zeros(len(codes), dtype=bool)
    first[starts] = True
    prev = np.where(first, n_classes, np.roll(codes, 1)).astype(np.int64)
    prev_once = np.where(first, False, np.roll(once, 1))
    cur = codes.astype(np.int64)
    unseen = n_classes + 1
    train = training[doc]

    def sparse(d, p, c):
        code, n = np.unique(d * side * side + p * side + c, return_counts=True)
        entry = np.empty(len(code), dtype=ENTRY)
        entry["ctx"], entry["n"] = code % (side * side), n
        return _binary(entry.tobytes(), np.searchsorted(code // (side * side), np.arange(len(starts)), side="right") * ENTRY.itemsize)

    a, z = train & once, train & prev_once
    both = a & z
    more = sparse(np.concatenate([doc[a], doc[z], doc[both]]), np.concatenate([prev[a], np.full(z.sum(), unseen), np.full(both.sum(), unseen)]), np.concatenate([np.full(a.sum(), unseen), cur[z], np.full(both.sum(), unseen)]))
    return sparse(doc, prev, cur), more


def _meet(n_classes: int, sizes: np.ndarray, tokens: int, types: int):
    """A chunk and its rare words: one row of statistics a text."""
    floor = 0.5 / (tokens + 0.5 * (types + 1)) if tokens or types else 1.0
    n_end = int(sizes[n_classes])

    def run(part: pa.Table, rare: pa.Table) -> pa.Table:
        if not part.num_rows:
            return _STAT.empty_table()
        get = lambda name, kind: np.frombuffer(part[name][0].as_py(), dtype=kind)
        lens, held = get("lens", "<u4").astype(np.int64), get("held", np.uint8).astype(bool)
        known, base, emitted = get("known", "<i8").copy(), get("base", "<f8").copy(), get("emitted", "<f8").copy()
        text = np.repeat(np.arange(len(lens)), lens)
        place = np.arange(len(text)) + text  # among tokens with an end behind each text
        starts = np.cumsum(lens + 1) - lens - 1
        codes, once = np.full(len(text) + len(lens), n_classes, dtype=np.uint8), np.zeros(len(text) + len(lens), dtype=bool)
        codes[place] = get("codes", np.uint8)
        once[place] = np.unpackbits(get("once", np.uint8), count=len(text)).astype(bool)
        if rare.num_rows:
            places = rare["places"].to_pylist()
            at = np.frombuffer(b"".join(places), dtype="<u4").astype(np.int64)
            n = np.repeat(rare["n"].to_numpy(), [len(x) // 4 for x in places])
            codes[place[at]] = np.where(n > 0, n_classes - 1, n_classes + 1)  # the last class, or unseen
            once[place[at]] = n == 1
            total = sizes[n_classes - 1]
            add = lambda x: np.bincount(text[at], weights=x, minlength=len(lens))
            known += add(n > 0).astype(np.int64)
            base += add(np.log10((n + 0.5) * 2 * floor))
            emitted += add(np.where(n > 0, np.log10(np.maximum(n, 1) / max(total, 1)), 0))
        known += n_end > 0
        base += np.log10((n_end + 0.5) * 2 * floor)
        # with a single training text its end is a word that occurs once
        once[starts + lens] = n_end == 1
        if not n_end:
            codes[starts + lens] = n_classes + 1
        moves, more = transitions(codes, once, starts, n_classes, ~held)
        ids = pa.array(get("ids", "<i8"), mask=get("named", np.uint8) == 0)
        return pa.table([ids, pa.array(held), pa.array(lens + 1), pa.array(known), pa.array(base), pa.array(emitted), moves, more], schema=_STAT)

    return run


def _sums(side: int):
    def run(batches):
        new = np.zeros(side * side)
        for b in batches:
            for k in (0, 1):
                entry, _ = _entries(b.column(k).to_pylist())
                new += np.bincount(entry["ctx"], weights=entry["n"], minlength=side * side)
        cells = np.flatnonzero(new)
        yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int32()), pa.array(new[cells].astype(np.int64), pa.int64())], names=["cell", "n"])

    return run


def transition_logs(counts: np.ndarray, sizes: np.ndarray, tokens: int, once: int, prior: float = PRIOR) -> np.ndarray:
    """log10 of (1 - unseen(p)) * P(c | p), and in the last column of unseen(p). Each row's probabilities add up to 1."""
    n = len(counts)
    if not tokens:
        return np.zeros((n, n))
    seen = counts[:, : n - 1].sum(axis=1, keepdims=True)
    unseen = (counts[:, n - 1 :] + prior * (once + 0.5) / (tokens + 1)) / (seen + prior + 0.5)
    class_share = sizes / sizes.sum()
    with np.errstate(divide="ignore"):
        known = np.log10((counts[:, : n - 1] + prior * class_share) / (seen + prior)) + np.log10(1 - unseen)
        return np.concatenate([known, np.log10(unseen)], axis=1)


def _score(logs: np.ndarray):
    schema = pa.schema([("id", pa.int64()), ("held_out", pa.bool_()), ("tokens", pa.int64()), ("known", pa.int64()), ("base", pa.float64()), ("score", pa.float64())])

    def run(batches):
        flat = logs.ravel()
        for b in batches:
            if b.num_rows:
                entry, row = _entries(b.column(6).to_pylist())
                moved = np.bincount(row, weights=flat[entry["ctx"]] * entry["n"], minlength=b.num_rows)
                yield pa.RecordBatch.from_arrays([*(b.column(k) for k in range(5)), pa.array(b.column(5).to_numpy() + moved)], schema=schema)

    return run


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_out: Column | None = None, n_classes: int = CLASSES, rounds: int = ROUNDS, head: int = HEAD, heavy: int = HEAVY, chunk_words: int = CHUNK_WORDS, chunk_tokens: int = CHUNK_TOKENS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity: one row a document."""
    spark = docs.sparkSession
    tune(spark)
    if n_classes > 250:
        raise ValueError("classes are held in a byte, of which some values are taken")
    held = is_held_out(F.col(id_col).cast("bigint")) if held_out is None else held_out
    texts = docs.select(text_or_empty(text_col).cast("binary").alias("text"), F.col(id_col).cast("bigint").alias("id"), held.alias("held_out"))
    n_docs = texts.where(~F.col("held_out")).count()
    chunks = materialize(texts.mapInArrow(_encode(chunk_words, chunk_tokens), CHUNK), "lm-chunks", "zstd")
    c = cluster(chunks, n_docs, n_classes, rounds, head, heavy)
    floor = 0.5 / (c.tokens + 0.5 * (c.types + 1)) if c.tokens else 1.0
    # one more place at the end, for words that the head does not hold
    frequent = spark.sparkContext.broadcast((
        c.head, np.append(c.klass, TAIL), np.append(np.log10((c.n + 0.5) * 2 * floor), 0.0), np.append(np.log10(c.n / c.sizes[c.klass]), 0.0), np.append(c.n == 1, False).astype(bool),
    ))
    by_head = chunks.mapInArrow(_by_head(frequent), PART)
    rare = chunks.select("chunk", "words", "tokens", "lens", "held").mapInArrow(_rare(frequent), RARE).join(c.counts, "word", "left")
    rare = rare.select("chunk", "places", F.coalesce("n", F.lit(0)).alias("n"))
    all_classes = n_classes + 1  # with that of all rarer words
    side = all_classes + 2
    stats = by_head.groupBy("chunk").cogroup(rare.groupBy("chunk")).applyInArrow(_meet(all_classes, c.sizes, c.tokens, c.types), STAT)
    stats = materialize(stats, "lm-stats")
    release(chunks, c.counts)
    settle(spark)
    counts = np.zeros(side * side)
    for r in stats.where(~F.col("held_out")).select("moves", "more").mapInArrow(_sums(side), "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        counts[r["cell"]] = r["n"]
    logs = transition_logs(counts.reshape(side, side), c.sizes, c.tokens, c.once)
    scored = stats.mapInArrow(_score(logs), "id long, held_out boolean, tokens long, known long, base double, score double")
    perplexity = F.pow(F.lit(10.0), -F.col("score") / F.col("tokens"))
    return scored.select(F.col("id").alias("doc_id"), "held_out", F.col("tokens").alias("n_tokens"), F.col("known").alias("n_known"), F.lit(int(c.tokens)).cast("bigint").alias("train_tokens"), F.col("base").alias("base_score"), "score", perplexity.alias("perplexity"))
