"""Exact deduplication by Patricia-trie owners.

Texts are equal when identical after every character of [\\x20\\x09-\\x0D] is deleted. Length and content hash of a
normalised text choose its partition, and no more than that: in a partition one compressed radix trie takes the full
byte strings, whose shared beginnings are held once, and it alone decides which are equal. A terminal node keeps the
owner of its string: most code points in the original text, then the smallest identifier.

Memory: before the shuffle every task combines what it reads in a trie of its own. Over a budget of bytes the trie
spills by subtree: the heaviest subtrees that free half of it go on to the shuffle, and what comes later for them is
met behind it. There the rows of a partition come in the order of their strings (Spark sorts, and spills, outside
Python), so subtrees left of the insertion path are finished and leave memory at once: what stays is one path.

Defined results: a null text counts as empty, empty texts form one group; a null identifier never owns a group
that has another (a group of null identifiers has owner null); rows that repeat both identifier and text are one
document stated again, they are kept or dropped together; an empty table gives no rows; further columns of any
name are not read. Very long texts are held one at a time.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ASCII_SPACE, kept, materialize, salt_mask, salt_of, scratch, small, spread, text_or_empty, tune, unused

NO_ID = (1 << 63) - 1
#: Bytes that a task's trie holds before the shuffle, and what a node counts besides the bytes of its edge.
COMBINE_BYTES = 64 << 20
NODE_BYTES = 600

ROW = "body binary, score long, owner long, has_owner boolean, n long, salts long"
_ARROW = pa.schema([("body", pa.binary()), ("score", pa.int64()), ("owner", pa.int64()), ("has_owner", pa.bool_()), ("n", pa.int64()), ("salts", pa.int64())])
GROUP = "sha binary, keep_id long, group_size long, salts long"
_GROUP_ARROW = pa.schema([("sha", pa.binary()), ("keep_id", pa.int64()), ("group_size", pa.int64()), ("salts", pa.int64())])


class Node:
    """label: the edge's bytes; owner: (-score, is_null, id, count, salts) if a string ends here."""

    __slots__ = ("label", "kids", "owner")

    def __init__(self, label: bytes, owner=None):
        self.label, self.kids, self.owner = label, {}, owner


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n  # a[:lo] == b[:lo], a[:hi] != b[:hi]
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


def better(a, b):
    """The owner of two: larger score, then a present identifier, then the smaller one; counts add up, salts unite."""
    first = a if a[:3] <= b[:3] else b
    return (*first[:3], a[3] + b[3], a[4] | b[4])


class PatriciaTrie:
    """Compressed radix trie over byte strings. held: bytes of its edges and nodes; split: edges that were split."""

    def __init__(self):
        self.root, self.held, self.split = Node(b""), 0, 0

    def insert(self, key: bytes, owner) -> list[tuple[Node, int]]:
        """Returns the path: every node from the root to the string's own, and where in the string its edge ends."""
        node, at = self.root, 0
        path = [(node, 0)]
        while at < len(key):
            kid = node.kids.get(key[at])
            if kid is None:
                node.kids[key[at]] = kid = Node(key[at:])
                self.held += len(kid.label) + NODE_BYTES
            elif not key.startswith(kid.label, at):
                same = common_prefix(key[at : at + len(kid.label)], kid.label)
                mid = Node(kid.label[:same])
                kid.label = kid.label[same:]
                mid.kids[kid.label[0]] = kid
                node.kids[key[at]] = kid = mid
                self.held += NODE_BYTES
                self.split += 1
            node, at = kid, at + len(kid.label)
            path.append((node, at))
        node.owner = owner if node.owner is None else better(node.owner, owner)
        return path

    @staticmethod
    def walk(node: Node, prefix: bytes) -> Iterator[tuple[bytes, tuple]]:
        """(string, owner) of every terminal below node; prefix: the bytes above it."""
        stack = [(node, prefix)]
        while stack:
            node, prefix = stack.pop()
            whole = prefix + node.label
            if node.owner is not None:
                yield whole, node.owner
            stack += [(kid, whole) for kid in node.kids.values()]

    def items(self) -> Iterator[tuple[bytes, tuple]]:
        return self.walk(self.root, b"")

    def cut_left(self, key: bytes, path: list[tuple[Node, int]]) -> Iterator[tuple[bytes, tuple]]:
        """Take out everything that sorts before `key`, the last one inserted: in sorted input no later string reaches it."""
        for (node, at), (below, _) in zip(path, path[1:]):
            if node.owner is not None:
                yield key[:at], node.owner
                node.owner = None
            for first in [k for k, kid in node.kids.items() if kid is not below]:
                yield from self.walk(node.kids.pop(first), key[:at])

    def weights(self) -> dict[int, int]:
        """Bytes held by each subtree, by the id of its top node."""
        order, stack = [], [self.root]
        while stack:
            order.append(node := stack.pop())
            stack += node.kids.values()
        out: dict[int, int] = {}
        for node in reversed(order):
            out[id(node)] = len(node.label) + NODE_BYTES + sum(out[id(kid)] for kid in node.kids.values())
        return out

    def spill(self, free: int) -> Iterator[tuple[bytes, tuple]]:
        """Take out the heaviest subtrees until `free` bytes are gone; of one much heavier than that only parts of it."""
        weight = self.weights()
        self.held = weight[id(self.root)] - NODE_BYTES
        heap = [(-weight[id(kid)], b"", first, self.root) for first, kid in self.root.kids.items()]
        heapq.heapify(heap)
        while heap and free > 0:
            heavy, prefix, first, above = heapq.heappop(heap)
            node = above.kids[first]
            if -heavy > 2 * free and len(node.kids) > 1:
                for k, kid in node.kids.items():
                    heapq.heappush(heap, (-weight[id(kid)], prefix + node.label, k, node))
                continue
            yield from self.walk(above.kids.pop(first), prefix)
            self.held += heavy
            free += heavy


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    part, held = [], 0
    for row in rows:
        part.append(row)
        held += 64 + sum(len(x) for x in row if isinstance(x, bytes))
        if held >= size or len(part) >= 20_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part), schema.types)], schema=schema)
            part, held = [], 0
    if part:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part), schema.types)], schema=schema)


def _rows(batches):
    for b in batches:
        cols = [b.column(b.schema.get_field_index(n)) for n in _ARROW.names]
        for i in range(b.num_rows):
            body, score, owner, has, n, salts = (c[i].as_py() for c in cols)
            yield body, (-score, not has, owner, n, salts)


def _state(string, owner):
    return string, -owner[0], owner[2], not owner[1], owner[3], owner[4]


def combine(budget: int):
    """Before the shuffle: one row for each string and task, or more where its subtree was spilled to the shuffle."""

    def run(batches):
        def rows():
            trie = PatriciaTrie()
            for body, owner in _rows(batches):
                trie.insert(body, owner)
                if trie.held > budget:
                    yield from (_state(*x) for x in trie.spill(trie.held - budget // 2))
            yield from (_state(*x) for x in trie.items())

        return _batches(rows(), _ARROW)

    return run


def own(batches):
    """Behind the shuffle, a partition's rows in the order of their strings: one row for each distinct string."""

    def done(pairs):
        for s, o in pairs:
            yield hashlib.sha256(s).digest(), None if o[1] else o[2], o[3], o[4]

    def rows():
        trie = PatriciaTrie()
        for body, owner in _rows(batches):
            yield from done(trie.cut_left(body, trie.insert(body, owner)))
        yield from done(trie.items())

    return _batches(rows(), _GROUP_ARROW)


def prepared(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row a document, without its text's white space: what both sides of the operator are made of."""
    text = text_or_empty(text_col)
    return docs.select(F.col(id_col).cast("bigint").alias("id"), F.length(text).cast("bigint").alias("score"), F.translate(text, ASCII_SPACE, "").alias("norm"))


def owners(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", combine_bytes: int = COMBINE_BYTES) -> DataFrame:
    """(sha, keep_id, group_size, salts) for every distinct normalised text."""
    tune(docs.sparkSession)
    rows = prepared(docs, id_col, text_col).select(
        F.col("norm").cast("binary").alias("body"), "score", F.coalesce("id", F.lit(NO_ID)).alias("owner"), F.col("id").isNotNull().alias("has_owner"), F.lit(1).cast("bigint").alias("n"), salt_mask(salt_of(F.col("id"))).alias("salts")
    )
    dealt = rows.mapInArrow(combine(combine_bytes), ROW).repartition(F.octet_length("body"), F.xxhash64("body"))
    return dealt.sortWithinPartitions("body").mapInArrow(own, GROUP)


def _decided(docs: DataFrame, id_col: str, text_col: str, **kw) -> DataFrame:
    """id, mark (hash of the normalised text), sha, keep_id, group_size of every row.

    The owners return to their rows through a join on (digest, salt): a group that holds a third of all rows is
    met under 32 keys, each beside a single owner row, and adaptive execution may split those further.
    """
    sha = F.unhex(F.sha2(F.col("norm").cast("binary"), 256))
    rows = prepared(docs, id_col, text_col).select("id", F.xxhash64("norm").alias("mark"), sha.alias("sha"), salt_of(F.col("id")).alias("salt"))
    return rows.join(spread(owners(docs, id_col, text_col, **kw), "salts"), ["sha", "salt"])


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row for every row of docs, dropped ones too."""
    kept = F.col("id").eqNullSafe(F.col("keep_id"))
    return _decided(docs, id_col, text_col, **kw).select(F.col("id").alias("doc_id"), "keep_id", "group_size", kept.alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))


def drop_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """docs without the rows that another one owns, all columns as they were."""
    gone_id, gone_mark = unused("_gone_id", docs), unused("_gone_mark", docs)
    gone = _decided(docs, id_col, text_col, **kw).where(~F.col("id").eqNullSafe(F.col("keep_id")))
    with scratch():
        gone = kept(materialize(gone.select(F.col("id").alias(gone_id), F.col("mark").alias(gone_mark)).distinct(), "exact-gone"))
    mark = F.xxhash64(F.translate(text_or_empty(text_col), ASCII_SPACE, ""))
    return docs.join(small(gone), F.col(id_col).cast("bigint").eqNullSafe(F.col(gone_id)) & (mark == F.col(gone_mark)), "left_anti")
