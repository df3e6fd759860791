"""Cost-balanced packing of tokenised documents into sequences of fixed capacity.

A piece of n tokens costs linear * n + quadratic * n**2 (attention). Whole sequences are cut off long documents,
each the costliest piece there can be; what remains is gathered in windows of a bounded number of tokens, and in
descending order every piece goes to the sequence of lowest cost that still has room for it. A window makes as many
sequences as its tokens fill, so a piece that fits nowhere whole is cut, and every sequence of a window is full. The
few tokens after a task's last window are laid into sequences of descending powers of two, which need no padding.

Every task packs what it reads: no shuffle, memory bounded by the window, and a lost task is simply run again.
Defined results: null text is empty, an empty text is its end id alone; rows are packed as they come, repeated ones
repeatedly; pieces of equal length are laid in the order they were read, and of sequences of equal cost the first is
taken; a null identifier stays null; an empty table gives no rows; further columns of any name are not read; very
long texts are read as a whole.
"""

from __future__ import annotations

import base64
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty, tune

END_ID = 1
SEQUENCE = 2048
#: Tokens that a task holds before it packs them: 512 sequences.
WINDOW = 1 << 20
LINEAR, QUADRATIC = 1.0, 1.0 / SEQUENCE

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, cost double"
_ARROW = pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")] + [("cost", pa.float64())])


@lru_cache(maxsize=2)
def encoder(vocabulary: str):
    """A function text -> ids (uint32). vocabulary: a file name of the public tokenizers, or a path.

    *.tiktoken: the ranks of a byte-level BPE, several times faster; *.json: the same ids from the tokenizers library.
    """
    import public_tokenizers

    path = vocabulary if "/" in vocabulary else public_tokenizers.path(vocabulary)
    if path.endswith(".json"):
        from tokenizers import Tokenizer

        plain = Tokenizer.from_file(path)
        return lambda text: np.array(plain.encode(text, add_special_tokens=False).ids, dtype="<u4")
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    ranked = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={"<|endoftext|>": len(ranks)})

    def ids(text: str) -> np.ndarray:
        try:
            return ranked.encode_to_numpy(text, allowed_special="all")
        except ValueError:  # its pattern engine gives up on runs of over a million spaces
            return encoder(vocabulary.removesuffix(".tiktoken") + ".json")(text)

    return ids


def cost(n, linear: float = LINEAR, quadratic: float = QUADRATIC):
    return linear * n + quadratic * n * n


class Packer:
    """Takes documents one by one; `rows` gathers (doc_id, start, length, crc, doc_tokens, sequence, offset, cost)."""

    def __init__(self, sequence: int = SEQUENCE, window: int = WINDOW, linear: float = LINEAR, quadratic: float = QUADRATIC, first_id: int = 0):
        self.size, self.window, self.weights, self.next_id = sequence, max(window, sequence), (linear, quadratic), first_id
        self.items: list[tuple] = []  # (doc_id, start, ids, doc_tokens)
        self.held, self.rows = 0, []

    def add(self, doc_id, ids: np.ndarray) -> None:
        whole = len(ids) // self.size * self.size
        for at in range(0, whole, self.size):
            self._put((doc_id, at, ids[at : at + self.size], len(ids)), self.next_id, 0)
            self.next_id += 1
        if whole < len(ids):
            self.items.append((doc_id, whole, ids[whole:], len(ids)))
            self.held += len(ids) - whole
        if self.held >= self.window:
            self.pack()

    def _put(self, piece, sequence: int, offset: int) -> None:
        doc_id, start, ids, total = piece
        self.rows.append((doc_id, start, len(ids), zlib.crc32(np.ascontiguousarray(ids, dtype="<u4").tobytes()), total, sequence, offset, cost(len(ids), *self.weights)))

    def pack(self) -> None:
        """Fill as many sequences as the held tokens fill; what is left over stays held."""
        k = self.held // self.size
        if not k:
            return
        spent, room = np.zeros(k), np.full(k, self.size)
        left: list[tuple] = []
        for piece in sorted(self.items, key=lambda x: -len(x[2])):
            while piece is not None:
                doc_id, start, ids, total = piece
                fits = room >= len(ids)
                if fits.any():
                    j, take = int(np.where(fits, spent, np.inf).argmin()), len(ids)
                else:  # cut: the sequence with most room takes what it can
                    j = int(room.argmax())
                    take = int(room[j])
                    if not take:
                        left.append(piece)
                        break
                self._put((doc_id, start, ids[:take], total), self.next_id + j, self.size - int(room[j]))
                room[j] -= take
                spent[j] += cost(take, *self.weights)
                piece = (doc_id, start + take, ids[take:], total) if take < len(ids) else None
        self.next_id += k
        self.items, self.held = left, sum(len(x[2]) for x in left)

    def close(self) -> None:
        self.pack()
        todo, offset, size = self.items[::-1], 0, 0
        left = self.held
        while todo:
            if not size:
                size, offset = 1 << (left.bit_length() - 1), 0
            doc_id, start, ids, total = todo.pop()
            take = min(len(ids), size - offset)
            self._put((doc_id, start, ids[:take], total), self.next_id, offset)
            if take < len(ids):
                todo.append((doc_id, start + take, ids[take:], total))
            offset += take
            left -= take
            if offset == size:
                self.next_id, size = self.next_id + 1, 0
        self.items, self.held = [], 0


def _pack(vocabulary: str, sequence: int, window: int, linear: float, quadratic: float, end_id: int):
    def run(batches):
        ids_of = encoder(vocabulary)
        packer = Packer(sequence, window, linear, quadratic, TaskContext.get().partitionId() << 36)
        end = np.array([end_id], dtype="<u4")

        def out():
            rows, packer.rows = packer.rows, []
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _ARROW.types)], schema=_ARROW)

        for b in batches:
            for i in range(b.num_rows):
                packer.add(b.column(0)[i].as_py(), np.concatenate([ids_of(b.column(1)[i].as_py()), end]))
                if len(packer.rows) > 20_000:
                    yield out()
        packer.close()
        if packer.rows:
            yield out()

    return run


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = "byte_bpe_50k.tiktoken", sequence: int = SEQUENCE, window: int = WINDOW, linear: float = LINEAR, quadratic: float = QUADRATIC, end_id: int = END_ID) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, cost: one row a piece."""
    tune(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(_pack(vocabulary, sequence, window, linear, quadratic, end_id), PIECE)
