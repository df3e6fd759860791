"""Format-preserving pseudonyms for personal data. DataFrame functions only.

Numbers and dates that pass their own validity test are replaced by others of the same format. Each kind has a domain
of integers 0..N-1 (the valid card numbers of a length, the calendar days of a range, ...); a keyed Feistel network of
alternating rounds permutes a rectangle a * b that covers N, and points outside the domain are walked on until one
lies inside. So within a kind the replacement is a bijection: equal values stay equal in all documents, different
values stay different, and without the key nothing leads back. Rounds are HMAC-SHA-256 of (kind, round, half).

    kind    what is permuted                          what stays
    email   letters and digits of the local part      places of letters, digits and other signs; the domain
    iban    digits and letters behind the country     country, spaces, which places are letters; check digits anew
    date    the days of 1900-01-01..2099-12-31        order of year, month, day, separators, leading zeros
    ipv4    the 32-bit addresses                      dotted form
    ssn     the valid area-group-serial numbers       dashes
    phone   all digits after the country code         country code, separators; whether ten digits are a number
                                                      of the North American plan
    card    all digits before the check digit         length, separators; the Luhn digit is made anew

What fails its test (a wrong check digit, octets above 255, 2023-02-30) is left as it is. Kinds are tried in the
order listed, leftmost first. Everything is one projection of the row: no shuffle, no join.

The key is the caller's, from a secret store; there is none by default. A local part, or a number's rest, of a single
letter or digit is moved by the same keyed amount wherever it stands: there is no other half that it could depend on.

Defined results: a null text stays null with no finds; texts without finds stay as they are, byte for byte; repeated
rows are rewritten alike; very long texts are read as a whole; an empty table gives no rows; other columns pass
untouched, but for one called like the new column of finds (in any case), whose place that takes at the end.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import unused

ROUNDS = 10
#: How long the IBANs of a country are. Those of other countries may have any length.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "AO CV GW LY MZ PT ST", 26: "DZ IR IS TR", 27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
    28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _of_length(n: int, countries: str) -> str:
    rest = rf"[ ]?[A-Z0-9]{{{n % 4}}}" if n % 4 else ""
    return rf"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?:[ ]?[A-Z0-9]{{4}}){{{n // 4 - 1}}}{rest}(?![A-Za-z0-9])"


_OF_COUNTRY = "|".join(_of_length(n, countries) for n, countries in IBAN_LENGTHS.items())

#: The kinds with their patterns, in the order in which they are tried at a place.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9][A-Za-z0-9._%+\-]*+@(?:[A-Za-z0-9\-]+\.)+[A-Za-z]{2,}",
    "iban": rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{_OF_COUNTRY}|[A-Z]{{2}}[0-9]{{2}}(?:[ ]?[A-Z0-9]{{4}}){{2,7}}(?:[ ]?[A-Z0-9]{{1,3}})?)(?![A-Za-z0-9])",
    "date": r"(?<![0-9A-Za-z./\-])(?:(?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2}|(?:19|20)[0-9]{2}/[0-9]{2}/[0-9]{2}|[0-9]{2}[./\-][0-9]{2}[./\-](?:19|20)[0-9]{2})(?:(?=[Tt][0-9]{2}(?::?[0-9]{2}|(?![0-9A-Za-z])))|(?![0-9A-Za-z]|[./\-][0-9]))",
    "ipv4": r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])",
    "ssn": r"(?<![0-9\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])",
    "phone": r"(?:(?<![0-9A-Za-z])\+[0-9]{1,3}[ .\-]?)?(?:\([0-9]{3}\)[ .\-]?|(?<![0-9])[0-9]{3}[ .\-])[0-9]{3}[ .\-][0-9]{4}(?![0-9])|(?<![0-9A-Za-z])\+[0-9]{1,3}(?:[ .\-]?[0-9]{2,4}){2,5}(?![0-9])",
    "card": r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ \-][0-9]{4}){2}[ \-][0-9]{1,7}|[0-9]{4}[ \-][0-9]{6}[ \-][0-9]{5})(?![0-9])",
}
KINDS = list(PATTERNS)
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())


def _let(value: Column, body) -> Column:
    """body(value) with value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _long(x) -> Column:
    return F.lit(x).cast("bigint")



#: Steps that a walk outside the domain may take. The rectangle exceeds its domain by less than its side, so a step
#: stays outside with a chance of 1 in sqrt(N) only.
WALK = 24


def _div(a: Column, b) -> Column:
    return F.call_function("div", a, b if isinstance(b, Column) else _long(b))


def _mac(key: str, *parts: Column) -> Column:
    """HMAC-SHA-256 as hex digits."""
    k = key.encode()
    k = (hashlib.sha256(k).digest() if len(k) > 64 else k).ljust(64, b"\0")
    inner, outer = (F.lit(bytes(b ^ pad for b in k)) for pad in (0x36, 0x5C))
    said = F.concat_ws(":", *[x.cast("string") for x in parts]).cast("binary")
    return F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, said), 256))), 256)


def _number(digits: Column, base: int = 10) -> Column:
    return F.conv(digits, base, 10).cast("bigint")


def permute(x: Column, size: int, kind: str, key: str, rounds: int = ROUNDS) -> Column:
    """The keyed image of x in 0..size-1 (at most 10**18): a bijection for every kind and size."""
    a = next(r for r in range(max(1, int(size**0.5) - 2), int(size**0.5) + 3) if r * r >= size)
    b = -(-size // a)

    def step(s: Column, i: Column) -> Column:
        mixed = lambda half, n: _number(F.substring(_mac(key, F.lit(kind), i, half), 1, 15), 16) % _long(n)
        left = F.struct(((s["l"] + mixed(s["r"], a)) % _long(a)).alias("l"), s["r"].alias("r"))
        right = F.struct(s["l"].alias("l"), ((s["r"] + mixed(s["l"], b)) % _long(b)).alias("r"))
        return F.when(i % 2 == 0, left).otherwise(right)

    def once(v: Column) -> Column:
        start = F.struct(_div(v, b).alias("l"), (v % _long(b)).alias("r"))
        return F.aggregate(F.sequence(F.lit(0), F.lit(rounds - 1)), start, step, lambda s: s["l"] * _long(b) + s["r"])

    return walk(once, x, lambda v: v < _long(size), 0 if a * b == size else WALK)


def walk(once, x: Column, inside, most: int) -> Column:
    """once applied to x until it lies inside: a bijection of the inner points, if once is one of all."""
    if not most:
        return once(x)
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(most)), once(x), lambda v, _: F.when(inside(v), v).otherwise(once(v)),
        lambda v: F.when(inside(v), v).otherwise(F.raise_error(F.lit("no point of the domain was met")).cast("bigint")),
    )


def permute_cells(text: Column, kind: str, key: str, rounds: int = ROUNDS) -> Column:
    """A Feistel network over characters: letters stay letters of their case, digits digits, all else as it is.

    Halves take turns: each cell of one moves by a keyed amount that depends on the other half and on its own place.
    """

    def moved(half: Column, other: Column, i: Column) -> Column:
        def cells(mac: Column) -> Column:
            def cell(c: Column, at: Column) -> Column:
                by = _number(F.substring(mac, (at % 16) * 4 + 1, F.lit(4)), 16) + at
                turn = lambda first, n: F.char((F.ascii(c) - first + by) % n + first)
                return F.when(c.between("0", "9"), turn(48, 10)).when(c.between("a", "z") & (F.octet_length(c) == 1), turn(97, 26)).when(c.between("A", "Z"), turn(65, 26)).otherwise(c)

            return F.array_join(F.transform(F.split(half, F.lit(""), -1), cell), "")

        return F.when(half == "", half).otherwise(_let(_mac(key, F.lit(kind), i, other), cells))

    def step(s: Column, i: Column) -> Column:
        left = F.struct(moved(s["l"], s["r"], i).alias("l"), s["r"].alias("r"))
        right = F.struct(s["l"].alias("l"), moved(s["r"], s["l"], i).alias("r"))
        return F.when(i % 2 == 0, left).otherwise(right)

    n = F.length(text)
    start = F.struct(F.substring(text, F.lit(1), _div(n, 2).cast("int")).alias("l"), F.substring(text, (_div(n, 2) + 1).cast("int"), n).alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(rounds - 1)), start, step, lambda s: F.concat(s["l"], s["r"]))


def refill(form: Column, digits: Column) -> Column:
    """form with its digits replaced in order; all other characters stay."""
    zero = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))
    step = lambda s, c: F.when(c.between("0", "9"), F.struct(F.concat(s["out"], F.substring(digits, s["at"], F.lit(1))).alias("out"), (s["at"] + 1).alias("at"))).otherwise(F.struct(F.concat(s["out"], c).alias("out"), s["at"].alias("at")))
    return F.aggregate(F.split(form, F.lit(""), -1), zero, step, lambda s: s["out"])


def _padded(x: Column, n: int) -> Column:
    return F.lpad(x.cast("string"), n, "0")


def luhn_sum(digits: Column) -> Column:
    def add(total: Column, x: Column) -> Column:
        return total + x

    def worth(c: Column, i: Column) -> Column:
        twice = c.cast("int") * 2
        return F.when(i % 2 == 0, c.cast("int")).when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.transform(F.split(F.reverse(digits), F.lit(""), -1), worth), F.lit(0), add)


def new_card(digits: Column, key: str) -> Column:
    """Null unless 13 to 19 digits with a right Luhn digit."""
    n, out = F.length(digits), F.lit(None).cast("string")
    for size in range(13, 20):
        payload = _padded(permute(F.substring(digits, 1, size - 1).cast("bigint"), 10 ** (size - 1), f"card{size}", key), size - 1)
        out = F.when(n == size, _let(payload, lambda p: F.concat(p, ((10 - luhn_sum(F.concat(p, F.lit("0"))) % 10) % 10).cast("string")))).otherwise(out)
    return F.when(luhn_sum(digits) % 10 == 0, out)


def new_ssn(digits: Column, key: str) -> Column:
    """Null unless area 001-899 but 666, group 01-99, serial 0001-9999."""
    area, group, serial = (F.substring(digits, at, n).cast("bigint") for at, n in ((1, 3), (4, 2), (6, 4)))
    valid = (area >= 1) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)
    rank = ((area - 1 - F.when(area > 666, 1).otherwise(0)) * 99 + group - 1) * 9999 + serial - 1

    def named(v: Column) -> Column:
        first = _div(v, 99 * 9999) + 1
        return F.concat(_padded(first + F.when(first >= 666, 1).otherwise(0), 3), _padded(_div(v, 9999) % 99 + 1, 2), _padded(v % 9999 + 1, 4))

    return F.when(valid, _let(permute(rank, 898 * 99 * 9999, "ssn", key), named))


def new_american(digits: Column, key: str) -> Column:
    """Ten digits; those of a North American number (area and exchange begin with 2-9) stay such, others stay others."""
    real = lambda v: v.rlike("^[2-9][0-9]{2}[2-9][0-9]{6}$")
    once = lambda v: permute(v, 10**10, "phone", key)
    moved = walk(once, digits.try_cast("bigint"), lambda v: real(_padded(v, 10)) == real(digits), 96)
    return F.when(digits.rlike("^[0-9]{10}$"), _padded(moved, 10))


def new_phone(found: Column, key: str) -> Column:
    """With +1 or no country code ten digits; else 8 to 15 digits, those after the country code move."""
    digits = F.regexp_replace(found, "[^0-9]", "")
    plus = found.startswith("+")
    first = F.regexp_extract(found, r"^\+([0-9]+)", 1)
    one = plus & digits.startswith("1")
    code = F.when(F.length(first) <= 3, F.length(first)).otherwise(F.lit(2))
    abroad = F.concat(F.substring(digits, F.lit(1), code), permute_cells(F.substring(digits, code + 1, F.lit(15)), "phone+", key))
    return F.when(~plus, refill(found, new_american(digits, key))).when(one, refill(found, F.concat(F.lit("1"), new_american(F.substring(digits, 2, 15), key)))).when(F.length(digits).between(8, 15), refill(found, abroad))


def new_ipv4(found: Column, key: str) -> Column:
    octet = "(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
    parts = [F.get(F.split(found, r"\."), F.lit(i)).cast("bigint") for i in range(4)]
    rank = ((parts[0] * 256 + parts[1]) * 256 + parts[2]) * 256 + parts[3]
    named = lambda v: F.concat_ws(".", *[(_div(v, 256 ** (3 - i)) % 256).cast("string") for i in range(4)])
    return F.when(found.rlike(rf"^{octet}(?:\.{octet}){{3}}$"), _let(permute(rank, 256**4, "ipv4", key), named))


def mod97(text: Column) -> Column:
    """The remainder of an IBAN's figures: the first four characters go last, letters count from 10."""
    moved = F.concat(F.substring(text, 5, 40), F.substring(text, 1, 4))
    step = lambda v, c: F.when(c.between("0", "9"), (v * 10 + F.ascii(c) - 48) % 97).otherwise((v * 100 + F.ascii(c) - 55) % 97)
    return F.aggregate(F.split(moved, F.lit(""), -1), F.lit(0), step)


def new_iban(found: Column, key: str) -> Column:
    """Null unless the check digits are right."""
    bare = F.regexp_replace(found, " ", "")

    def made(bban: Column) -> Column:
        country = F.substring(found, 1, 2)
        whole = F.concat(country, _padded(98 - mod97(F.concat(country, F.lit("00"), bban)), 2), bban)
        return _let(whole, lambda w: F.aggregate(
            F.split(found, F.lit(""), -1), F.struct(F.lit("").alias("out"), F.lit(1).alias("at")),
            lambda s, c: F.when(c == " ", F.struct(F.concat(s["out"], c).alias("out"), s["at"].alias("at"))).otherwise(F.struct(F.concat(s["out"], F.substring(w, s["at"], F.lit(1))).alias("out"), (s["at"] + 1).alias("at"))),
            lambda s: s["out"],
        ))

    return F.when(F.length(bare).between(15, 34) & (mod97(bare) == 1), _let(permute_cells(F.substring(bare, 5, 30), "iban", key), made))


FIRST_DAY, DAYS = "1900-01-01", 73_049


def new_date(found: Column, key: str) -> Column:
    """Year first, or day.month.year where that is a date, or else month.day.year (only days above 12 get there)."""
    at = lambda i, n: F.substring(found, i, n)
    mark = F.when(found.rlike("^[0-9]{4}"), at(5, 1)).otherwise(at(3, 1))
    iso = lambda y, m, d: F.concat_ws("-", y, m, d).try_cast("date")
    rank = lambda day: F.datediff(day, F.lit(FIRST_DAY).cast("date")).cast("bigint")
    day_of = lambda v: F.date_add(F.lit(FIRST_DAY).cast("date"), v.cast("int"))
    shown = lambda v, form: F.date_format(day_of(v), form)
    ymd, dmy, mdy = iso(at(1, 4), at(6, 2), at(9, 2)), iso(at(7, 4), at(4, 2), at(1, 2)), iso(at(7, 4), at(1, 2), at(4, 2))
    marked = lambda text: F.replace(text, F.lit("-"), mark)
    plain = lambda day, form: marked(shown(permute(rank(day), DAYS, "date", key), form))
    late = walk(lambda v: permute(v, DAYS, "date", key), rank(mdy), lambda v: F.dayofmonth(day_of(v)) > 12, 64)
    return F.when(found.rlike("^[0-9]{4}"), F.when(ymd.isNotNull() & (at(5, 1) == at(8, 1)), plain(ymd, "yyyy-MM-dd"))).when(at(3, 1) != at(6, 1), F.lit(None)).when(dmy.isNotNull(), plain(dmy, "dd-MM-yyyy")).when(mdy.isNotNull(), marked(shown(late, "MM-dd-yyyy")))


def new_email(found: Column, key: str) -> Column:
    local = F.substring_index(found, "@", 1)
    return F.concat(permute_cells(local, "email", key), F.substring(found, F.length(local) + 1, F.length(found)))


def pseudonym(found: Column, key: str) -> Column:
    """struct(kind, new): kind is null and new the same where a find fails its test."""
    digits = F.regexp_replace(found, "[^0-9]", "")
    made = {
        "email": new_email(found, key), "iban": new_iban(found, key), "date": new_date(found, key), "ipv4": new_ipv4(found, key),
        "card": refill(found, new_card(digits, key)), "ssn": refill(found, new_ssn(digits, key)), "phone": new_phone(found, key),
    }

    def tried(kind: str):
        return lambda new: F.struct(F.when(new.isNotNull(), F.lit(kind)).alias("kind"), F.coalesce(new, found).alias("new"))

    out = F.struct(F.lit(None).cast("string").alias("kind"), found.alias("new"))
    for kind in reversed(KINDS):
        out = F.when(found.rlike(rf"\A(?:{PATTERNS[kind]})\z"), _let(made[kind], tried(kind))).otherwise(out)
    return out


def pseudonymize(docs: DataFrame, key: str, text_col: str = "text", finds_col: str = "pii_finds") -> DataFrame:
    """docs with the text rewritten, and finds_col: how many values of each kind were replaced (map, empty without any)."""
    if not key:
        raise ValueError("pseudonyms need a key")
    kept = docs.select(*[docs[f"`{c}`"] for c in docs.columns if c.lower() != finds_col.lower()])
    text, old, gaps, new = F.col(f"`{text_col}`").cast("string"), *(unused(f"_tidewright_{x}", kept) for x in ("old", "gaps", "new"))
    some = text.rlike("[0-9@]")
    none = F.array().cast("array<string>")
    rows = kept.withColumn(old, F.when(some, F.regexp_extract_all(text, F.lit(ANY), 0)).otherwise(none))
    rows = rows.withColumn(new, F.transform(F.col(old), lambda m: pseudonym(m, key)))
    rows = rows.withColumn(gaps, F.when(F.size(old) > 0, F.split(text, ANY, -1)).otherwise(none))
    woven = F.array_join(F.transform(F.col(gaps), lambda g, i: F.concat(g, F.coalesce(F.get(F.col(new), i)["new"], F.lit("")))), "")
    kinds = F.array_compact(F.transform(F.col(new), lambda x: x["kind"]))
    each = [F.struct(F.lit(k).alias("key"), F.size(F.array_remove(kinds, k)).alias("others")) for k in KINDS]
    counted = F.transform(F.array(*each), lambda e: F.struct(e["key"].alias("key"), (F.size(kinds) - e["others"]).alias("value")))
    counts = F.map_from_entries(F.filter(counted, lambda e: e["value"] > 0))
    rewritten = F.when(F.size(old) > 0, woven).otherwise(F.col(f"`{text_col}`"))
    return rows.select(*[(rewritten.alias(c) if c == text_col else F.col(f"`{c}`")) for c in kept.columns], counts.alias(finds_col))
