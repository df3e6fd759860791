from __future__ import annotations

import datetime
import hmac
import math
import re

import pytest
from pyspark.sql import functions as F

from tidewright.llm import pii as P

TEXTS = [
    "call +1 (743) 555-3824 or 212-555-0100, +49 30 12345678.", "mail bosbt.42@mail8.example.com, card 4111 1111 1111 1111 and 4111111111111112", "ip 42.144.35.254, 999.1.1.1, v1.2.3",
    "DE89 3704 0044 0532 0130 00, GB82WEST12345698765432, GB82WEST12345698765433", "2023-02-28 2023-02-30 31.12.1999 12/25/2001 2020/02/29", "ssn 123-45-6789, 666-11-1111", None, "", "plain é 😀 text",
]


KEY = "a key for tests"


def rewritten(spark, texts, **kw):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, pii_old string")
    out = P.pseudonymize(df, **{"key": KEY} | kw)
    assert out.columns == [*df.columns, "pii_finds"]
    return {r.doc_id: r for r in out.collect()}


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def iban(x):
    x = x.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in x[4:] + x[:4])) % 97 == 1


def test_formats_stay_and_values_change(spark):
    got = rewritten(spark, TEXTS)
    shape = lambda t: re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub("[0-9]", "9", t)))
    for i in (0, 1, 3, 4, 5):
        assert shape(got[i].text) == shape(TEXTS[i]) and got[i].text != TEXTS[i]
    assert [got[i].pii_finds for i in range(9)] == [{"phone": 3}, {"email": 1, "card": 1}, {"ipv4": 1}, {"iban": 2}, {"date": 4}, {"ssn": 1}, {}, {}, {}]
    assert [got[i].text for i in (6, 7, 8)] == TEXTS[6:]
    assert "4111111111111112" in got[1].text and "999.1.1.1, v1.2.3" in got[2].text and "GB82WEST12345698765433" in got[3].text and "2023-02-30" in got[4].text and "666-11-1111" in got[5].text
    assert luhn(re.sub(" ", "", re.search(r"card ([\d ]+) and", got[1].text)[1])) and "@mail8.example.com" in got[1].text
    assert all(iban(x.strip()) for x in got[3].text.split(",")[:2])
    assert all(0 <= int(x) < 256 for x in re.search(r"ip ([\d.]+),", got[2].text)[1].split("."))
    d = got[4].text.split()
    datetime.date.fromisoformat(d[0])
    datetime.datetime.strptime(d[2], "%d.%m.%Y")
    assert datetime.datetime.strptime(d[3], "%m/%d/%Y").day > 12
    area, group, serial = map(int, re.search(r"ssn ([\d-]+),", got[5].text)[1].split("-"))
    assert 0 < area < 900 and area != 666 and group and serial


def test_links_across_documents_and_keys(spark):
    got = rewritten(spark, ["a 4111 1111 1111 1111 b", "4111111111111111", "x@y.org", "so x@y.org!"])
    assert re.sub(r"\D", "", got[0].text) == got[1].text and got[2].text in got[3].text
    assert rewritten(spark, ["4111111111111111"], key="other" * 20)[0].text != got[1].text


def test_every_small_domain_is_permuted(spark):
    for size in (1, 2, 3, 10, 17, 1000, P.DAYS):
        vs = {r.v for r in spark.range(size).select(P.permute(F.col("id"), size, "t", KEY).alias("v")).collect()}
        assert vs == set(range(size))
    vs = {r.v for r in spark.range(5000).select(P.permute(F.col("id") * 199_999_999_999_999, 10**18, "t", KEY).alias("v")).collect()}
    assert len(vs) == 5000 and min(vs) >= 0 and max(vs) < 10**18
    cells = spark.range(2600).select(P.permute_cells(F.concat(F.char(F.col("id") % 26 + 97), F.lit("-"), F.lpad(F.floor(F.col("id") / 26).cast("string"), 2, "0")), "t", KEY).alias("v"))
    assert {r.v for r in cells.collect()} == {f"{chr(97 + a)}-{n:02d}" for a in range(26) for n in range(100)}


def test_mac_and_feistel_by_hand(spark):
    for key in ("k", "long" * 40):
        mac = lambda *p: hmac.new(key.encode(), ":".join(map(str, p)).encode(), "sha256").hexdigest()  # noqa: B023, E731
        size = 73_049
        a = math.isqrt(size - 1) + 1
        b = -(-size // a)

        def once(v):
            left, right = divmod(v, b)  # noqa: B023
            for i in range(P.ROUNDS):
                if i % 2 == 0:
                    left = (left + int(mac("t", i, right)[:15], 16) % a) % a  # noqa: B023
                else:
                    right = (right + int(mac("t", i, left)[:15], 16) % b) % b  # noqa: B023
            return left * b + right  # noqa: B023

        def whole(v):
            v = once(v)  # noqa: B023
            while v >= size:  # noqa: B023
                v = once(v)  # noqa: B023
            return v

        got = [r.v for r in spark.range(300).select(P.permute(F.col("id"), size, "t", key).alias("v")).orderBy("id").collect()]
        assert got == [whole(v) for v in range(300)]


def test_planted_values_are_gone(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    new = {r.doc_id: r.text for r in P.pseudonymize(docs, KEY).collect()}
    n = 0
    for r in docs.collect():
        for value in re.findall(r"[a-z]+\.\d\d@mail\d\.example\.com|\+1 \(\d{3}\) 555-\d{4}", r.text) + [x for x in re.findall(r"(?<!\d)\d{16}(?!\d)", r.text) if luhn(x)]:
            n += 1
            assert value not in new[r.doc_id]
    assert n > 3


@pytest.mark.parametrize("n", [200_000])
def test_long_texts_and_empty_tables(spark, n):
    got = rewritten(spark, ["word " * n + "4111111111111111"])
    assert got[0].pii_finds == {"card": 1} and got[0].text.startswith("word " * n)
    assert P.pseudonymize(spark.createDataFrame([], "doc_id long, text string"), KEY).isEmpty()


def test_words_behind_an_iban_and_times_behind_a_date(spark):
    values = ["BE68 5390 0754 7034", "BE68539007547034", "ES91 2100 0418 4502 0005 1332", "DE89 3704 0044 0532 0130 00"]
    behind = [" EUR", " BIC KRED", " BANK", " 1234 A", "."]
    texts = [f"to {v}{b}" for v in values for b in behind]
    got = rewritten(spark, texts)
    for i, (v, b) in enumerate((v, b) for v in values for b in behind):
        new = got[i].text[3 : 3 + len(v)]
        assert got[i].pii_finds == {"iban": 1} and got[i].text == f"to {new}{b}" and new != v and iban(new), texts[i]
    times = ["T00:00:00Z", "t23:59", "T2359+01:00", "T07"]
    got = rewritten(spark, [f"at 1987-03-12{t}, 1987-03-12Tx, 1987-02-30{t}" for t in times])
    for i, t in enumerate(times):
        new = got[i].text[3:13]
        assert got[i].pii_finds == {"date": 1} and got[i].text == f"at {new}{t}, 1987-03-12Tx, 1987-02-30{t}"
        assert datetime.date.fromisoformat(new) != datetime.date(1987, 3, 12)


def test_clashing_columns_and_repeated_rows(spark):
    rows = [(1, "x@y.org", {"own": 1}, "o", "g"), (1, "x@y.org", {"own": 1}, "o", "g"), (None, "x@y.org", None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, PII_finds map<string,int>, _tidewright_old string, `a.b` string")
    out = P.pseudonymize(df, KEY)
    assert out.columns == ["doc_id", "text", "_tidewright_old", "a.b", "pii_finds"]
    got = out.select("doc_id", "text", "_tidewright_old", "`a.b`", "pii_finds").collect()
    assert len({r.text for r in got}) == 1 and got[0].text != "x@y.org" and all(r.pii_finds == {"email": 1} for r in got)
    assert [(r["_tidewright_old"], r["a.b"]) for r in got] == [("o", "g"), ("o", "g"), (None, None)]


def test_a_key_is_required(spark):
    df = spark.createDataFrame([(1, "x@y.org")], "doc_id long, text string")
    with pytest.raises(TypeError):
        P.pseudonymize(df)
    with pytest.raises(ValueError):
        P.pseudonymize(df, "")
