from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidewright.llm import packing as P


@pytest.fixture(scope="module")
def reference():
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda t: [*plain.encode(t or "", add_special_tokens=False).ids, 1]


def check(pieces, docs, size=2048):
    """Every id in one piece, sequences gapless and within their size, padding only where no power of two is met."""
    cover, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        ids = docs[p["doc_id"]]
        assert p["doc_tokens"] == len(ids) and p["length"] > 0
        part = ids[p["start"] : p["start"] + p["length"]]
        assert p["ids_crc32"] == zlib.crc32(np.array(part, dtype="<u4").tobytes())
        cover[p["doc_id"]].append((p["start"], p["length"]))
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
    for i, ids in docs.items():
        at = 0
        for start, n in sorted(cover[i]):
            assert start == at
            at += n
        assert at == len(ids)
    padding = 0
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= size
        padding += 0 if at & (at - 1) == 0 else size - at
    return padding, sequences


@pytest.mark.parametrize("window", [1 << 20, 20_000, 2048])
def test_all_documents(spark, sf_dir, reference, window):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = {r.doc_id: reference(r.text) for r in df.collect()}
    got = [r.asDict() for r in P.pack_documents(df.repartition(3), window=window).collect()]
    padding, sequences = check(got, docs)
    assert padding == 0 and len(sequences) <= sum(map(len, docs.values())) / 2048 + 3 * 11


def test_ids_of_both_libraries(reference):
    rnd = random.Random(1)
    ids = P.encoder("byte_bpe_50k.tiktoken")
    alphabet = ["a", "b ", "Z", "\n", "\t", "\r", "\x00", "\xa0", "　", "é", "😀", "ß", "1", "٣", "'s", "'ll", "-_%", "‍", "﻿", "İ", "ſ", "  ", "<|endoftext|>"]
    for _ in range(1500):
        t = "".join(rnd.choices(alphabet, k=rnd.randint(0, 30)))
        assert [*ids(t).tolist(), 1] == reference(t)


def test_what_one_library_gives_up_on(reference):
    text = "a" + " " * 1_200_000 + "b"
    assert [*P.encoder("byte_bpe_50k.tiktoken")(text).tolist(), 1] == reference(text)


def test_costs_are_balanced():
    rnd = random.Random(4)
    packer = P.Packer(2048, 1 << 18)
    for i in range(800):
        packer.add(i, np.arange(rnd.choice([40, 90, 200, 600, 1500])))
    packer.close()
    spent, full = defaultdict(float), defaultdict(int)
    for r in packer.rows:
        spent[r[5]] += r[7]
        full[r[5]] += r[2]
    whole = [spent[s] for s in spent if full[s] == 2048]
    first = defaultdict(float)  # first-come packing of the same documents
    rnd, at = random.Random(4), 0
    for _ in range(800):
        n = rnd.choice([40, 90, 200, 600, 1500])
        while n:
            take = min(n, 2048 - at % 2048)
            first[at // 2048] += P.cost(take)
            at, n = at + take, n - take
    assert np.std(whole) < np.std(list(first.values())[:-1])


def test_descending_to_the_lowest_cost_with_room():
    packer = P.Packer(10, 20, 1.0, 1.0)
    for i, n in enumerate((6, 5, 4, 3, 2)):
        packer.add(i, np.arange(n))
    packer.close()
    assert [(r[0], r[5], r[6], r[2]) for r in packer.rows] == [(0, 0, 0, 6), (1, 1, 0, 5), (2, 1, 5, 4), (3, 0, 6, 3), (4, 0, 9, 1), (4, 1, 9, 1)]


def test_odd_tables(spark, reference):
    rows = [(1, None), (2, ""), (None, "hello there"), (3, "x y z " * 3000), (3, "x y z " * 3000)]
    got = P.pack_documents(spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, length int").coalesce(1)).collect()
    assert {r.doc_id for r in got} == {None, 1, 2, 3} and sum(r.length for r in got) == sum(len(reference(t)) for _, t in rows)
    assert P.pack_documents(spark.createDataFrame([], "doc_id long, text string")).isEmpty()
