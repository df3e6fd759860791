"""Line deduplication by a segment-partition edit join. DataFrame functions only.

Lines are near-duplicates if they are equal, or if their edit distance is at most what the length of the shorter one
permits (`bands`: from so many code points, so many edits t; below the first band lines must be equal). A line is
split into t + 1 even segments; t edits leave one of them whole, so two near lines share a segment at a shift that the
edits before and after it allow. Every distinct line puts its segments into an index under (segment, own length,
substring), and probes the index, for its own length and each up to t shorter, with the substrings at the allowed
shifts only. Pairs that are compared are held against bit maps of their characters' pairs and against finer pieces,
neither of which rules out a near pair, and then verified with a banded bit-parallel edit distance of what lies between
their common beginning and end: the band of 2t + 1 diagonals lies in the bits of a long, one step a character.

Skew. Copies never multiply: occurrences are reduced to distinct lines first, and the answer returns to the
occurrences by a salted lookup. A segment that over HOT lines share tells little (the beginning of an address, a
notice): such lines are indexed anew, by the t + 1 of their finer pieces that the fewest of them hold or probe for. Any t + 1
pieces do, since t edits spoil t at most; the probes hold all pieces at all shifts. Under every key all lines are compared
with the smallest; then only lines that are in different classes still, in tiles of a bounded number of lines
(`common.apart`). Links are a line's with the smallest of a key, and one for each two classes that are met so: never
all pairs. In each class the first occurrence, by identifier and line number, stays.

Lines are trimmed of [\\x20\\x09-\\x0D] at both ends before they are compared; empty ones always stay, and with
`min_chars` shorter ones too.

Defined results: null text is empty; a document without lines has nothing removed; equal lines are near-duplicates at
distance 0; a null identifier sorts before all others; rows that repeat an identifier (and rows without one) are one
document stated again: lines at the same place are decided alike, and the report has one row for them; an empty table
gives no rows; further columns are not read. Very long lines are compared as a whole.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import apart, connected_components, materialize, release, salt_mask, salt_of, spread, text_or_empty, unused

#: From so many code points, so many edits: more than three times as many code points as edits.
BANDS = ((12, 1), (24, 2))
#: Lines that may share a segment before they are indexed by their rarest pieces; these are at most so many, of so many code points.
HOT, FINE, FINE_CHARS = 64, 12, 5
EDGES = " \t\x0b\x0c\r"
#: Pieces that a pair is held against before its distance is computed.
PIECES = 16
#: Up to so many keys that two lines meet under are broadcast (eight bytes each); beyond, they are joined by shuffle.
BROADCAST_KEYS = 2_000_000


def segments(max_edits: int, length: Column) -> list[tuple[Column, Column]]:
    """(start from 0, length) of the t + 1 even segments of a line; the longer ones come last."""
    n = max_edits + 1
    short, longer = F.floor(length / n).cast("int"), (length % n).cast("int")
    out = []
    for i in range(n):
        extra = F.greatest(longer - (n - i), F.lit(0))  # longer segments before this one
        out.append((short * i + extra, short + F.when(F.lit(i) >= n - longer, 1).otherwise(0)))
    return out


def shifts(max_edits: int, segment: int, shorter: int) -> range:
    """Where segment `segment` (from 0) of a line may begin in one that is `shorter` longer, relative to its own place.

    At most `segment` edits lie before it and at most max_edits - segment behind it, or a later (earlier) segment is whole.
    """
    behind = max_edits - segment
    return range(max(-segment, shorter - behind), min(segment, shorter + behind) + 1)


def places(max_edits: int) -> list[tuple[int, int, int]]:
    """(segment, shorter, shift) of the t + 1 segments of a line's own, then of those by which it finds others.

    At equal length a pair probes both ways, so there shifts above 0 are enough.
    """
    own = [(i, 0, 0) for i in range(max_edits + 1)]
    return own + [(i, shorter, s) for shorter in range(max_edits + 1) for i in range(max_edits + 1) for s in shifts(max_edits, i, shorter) if shorter or s > 0]


def edits(n: Column, bands: tuple) -> Column:
    """How many edits a line of n code points permits."""
    out = F.lit(0)
    for least, t in bands:
        out = F.when(n >= least, t).otherwise(out)
    return out


def keyed(lines: DataFrame, bands: tuple) -> DataFrame:
    """(id, line, n, own, key): for every place a hash of segment, length and substring.

    `wide` holds four bytes a character, so that any place in it is found at once. The segments' ends are columns of
    their own, so that what makes the keys is small enough for the JVM to compile.
    """
    out = []
    for k, (least, t) in enumerate(bands):
        most = bands[k + 1][0] - 1 if k + 1 < len(bands) else None  # lengths of this band's shorter lines
        within = lambda n: n >= least if most is None else n.between(least, most)  # noqa: B023, E731
        own = t + 1
        wide = lines.where(F.col("n") >= least if most is None else F.col("n").between(least, most + t)).select("id", "line", "n", F.encode("line", "UTF-32").alias("wide"))
        ends = {(shorter, i): x for shorter in range(t + 1) for i, x in enumerate(segments(t, F.col("n") - shorter))}
        cut = wide.select("id", "line", "n", "wide", *[(4 * x).alias(f"_{c}{shorter}{i}") for (shorter, i), (at, size) in ends.items() for c, x in (("at", at), ("size", size))])

        def key(i: int, shorter: int, s: int) -> Column:
            found = F.xxhash64((F.col("n") - shorter) * 32 + i, F.substring(F.col("wide"), F.col(f"_at{shorter}{i}") + 4 * s + 1, F.col(f"_size{shorter}{i}")))
            return F.when(within(F.col("n") - shorter), found)  # noqa: B023

        rows = cut.select("id", "line", "n", F.posexplode(F.array(*[key(*p) for p in places(t)])).alias("pos", "key"))
        out.append(rows.where("key is not null").select("id", "line", "n", (F.col("pos") < own).alias("own"), "key"))
    return reduce(DataFrame.unionByName, out)


def by_rare_pieces(lines: DataFrame, bands: tuple) -> DataFrame:
    """(id, line, n, own, key) for lines (id, line, n) that share frequent segments: own keys are of a line's rarest pieces."""
    t_most = max(t for _, t in bands)

    def key(length: Column, p: Column, shift) -> Column:
        many = F.least(F.lit(FINE), F.greatest(edits(length, bands) + 1, F.floor(length / FINE_CHARS))).cast("int")
        at, end = F.floor(length * p / many).cast("int"), F.floor(length * (p + 1) / many).cast("int")
        found = F.xxhash64(length * 32 + p, F.substring(F.col("wide"), 4 * (at + shift) + 1, 4 * (end - at)))
        return F.when((p < many) & (at + shift >= 0), found)

    wide = lines.withColumn("wide", F.encode("line", "UTF-32"))
    pieces = F.sequence(F.lit(0), F.lit(FINE - 1))
    held = F.filter(F.transform(pieces, lambda p: key(F.col("n"), p, F.lit(0))), lambda x: x.isNotNull())
    asked = []
    for shorter in range(t_most + 1):
        length = F.col("n") - shorter
        for shift in range(shorter - t_most, t_most + 1):
            # at equal length a pair asks both ways, and what lies between its edits is shifted up for one of the two
            if abs(shift) + abs(shorter - shift) <= t_most and (shorter or shift >= 0):
                fits = edits(length, bands) >= abs(shift) + abs(shorter - shift)
                asked.append(F.when(fits, F.transform(pieces, lambda p: key(length, p, F.lit(shift)))).otherwise(F.array().cast("array<bigint>")))  # noqa: B023
    found = wide.select("id", "n", held.alias("held"), F.array_distinct(F.concat(*asked)).alias("asked"))
    # a line asks for its own pieces too, so these are all lines that would meet under a key
    every = materialize(found.select("id", "n", F.explode("asked").alias("key"), F.array_contains("held", F.col("key")).alias("own")).where("key is not null"), "line-pieces")
    counted = every.where("own").join(every.groupBy("key").agg(F.count("*").alias("times")), "key")
    rare = counted.groupBy("id", "n").agg(F.array_sort(F.collect_list(F.struct("times", "key"))).alias("held")).select("id", F.explode(F.slice("held", F.lit(1), edits(F.col("n"), bands) + 1)).alias("x"))
    rare = materialize(rare.select("id", F.col("x.key").alias("key")), "line-rare")
    probes = every.where("not own").select("id", "key").join(rare.select("key").distinct(), "key", "left_semi")
    # what a line holds and has not chosen as its own, it asks for
    passed = every.where("own").select("id", "key").join(rare, ["id", "key"], "left_anti").join(rare.select("key").distinct(), "key", "left_semi")
    met = rare.withColumn("own", F.lit(True)).unionByName(probes.unionByName(passed).withColumn("own", F.lit(False)))
    return met.join(lines, "id").select("id", "line", "n", "own", "key")


def _let(value: Column, body) -> Column:
    """body(value) with value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def banded_distance(a: Column, b: Column, n_a: Column, n_b: Column, max_edits: int) -> Column:
    """Edit distance of a and b if at most max_edits, else some larger number. Needs n_a > max_edits, |n_a - n_b| <= max_edits.

    Column j of the dynamic program is held for the rows j - t .. j + t, as bit vectors of the steps +1 and -1 between
    neighbouring rows; bit k is row j - t + k. The distance is followed down the lowest diagonal to the last row of a,
    then along that row.
    """
    t = max_edits
    top, full = 1 << (2 * t), (1 << (2 * t + 1)) - 1
    shift_right = lambda x, k: F.call_function("shiftright", x, k)
    bits = lambda x: x.bitwiseAND(F.lit(full).cast("bigint"))
    flip = lambda x: bits(F.bitwise_not(x))
    long = lambda x: F.lit(x).cast("bigint")

    def equal(chars_a: Column, c: Column, j: Column) -> Column:
        found = [F.when(F.get(chars_a, j - (t + 1) + k) == c, long(1 << k)).otherwise(long(0)) for k in range(2 * t + 1)]
        out = found[0]
        for x in found[1:]:
            out = out.bitwiseOR(x)
        return out

    def step(state: Column, eq: Column, j: Column) -> Column:
        vp, vn, d = state["vp"], state["vn"], state["d"]
        d0 = bits((eq.bitwiseAND(vp) + vp).bitwiseXOR(vp).bitwiseOR(eq).bitwiseOR(vn))

        def given_d0(x: Column) -> Column:
            hp, hn = vn.bitwiseOR(flip(x.bitwiseOR(vp))), x.bitwiseAND(vp)
            row = n_a - j + t  # the bit of the last row of a
            down = F.when(x.bitwiseAND(long(top)) == 0, 1).otherwise(0)
            along = F.when(shift_right(hp, row).bitwiseAND(long(1)) == 1, 1).when(shift_right(hn, row).bitwiseAND(long(1)) == 1, -1).otherwise(0)
            half = shift_right(x, F.lit(1))
            return F.struct(hn.bitwiseOR(flip(half.bitwiseOR(hp))).alias("vp"), half.bitwiseAND(hp).alias("vn"), (d + F.when(j <= n_a - t, down).otherwise(along)).cast("int").alias("d"))

        return F.when(d > 3 * t, state).otherwise(_let(d0, given_d0))  # beyond the reach of the steps that are left

    start = F.struct(long(full & ~((1 << t) - 1)).alias("vp"), long(0).alias("vn"), F.lit(t).cast("int").alias("d"))

    def run(chars: Column) -> Column:
        eqs = F.transform(F.split(b, F.lit(""), -1), lambda c, i: F.struct(equal(chars, c, i + 1).alias("eq"), (i + 1).alias("j")))
        eqs = F.filter(eqs, lambda x: x["j"] <= n_b)
        return F.aggregate(eqs, start, lambda s, x: step(s, x["eq"], x["j"]), lambda s: s["d"])

    return _let(F.split(a, F.lit(""), -1), run)


def unlike_part(a: Column, b: Column, keep: int) -> Column:
    """struct(a, b) without their common beginning and end but for `keep` characters of each: their distance is the same."""

    def common(x: Column, y: Column, part) -> Column:
        most = F.least(F.length(x), F.length(y))
        step = lambda n, k: F.when((n + k <= most) & (part(x, n + k) == part(y, n + k)), n + k).otherwise(n)
        return F.greatest(F.aggregate(F.array(*[F.lit(1 << k) for k in range(24, -1, -1)]), F.lit(0), step) - keep, F.lit(0))

    pair = lambda x, y: F.struct(x.alias("a"), y.alias("b"))
    behind = _let(common(a, b, lambda x, n: F.substring(x, F.lit(1), n)), lambda n: pair(F.substring(a, n + 1, F.length(a)), F.substring(b, n + 1, F.length(b))))
    cut = lambda p, n: pair(F.substring(p["a"], F.lit(1), F.length(p["a"]) - n), F.substring(p["b"], F.lit(1), F.length(p["b"]) - n))
    return _let(behind, lambda p: _let(common(p["a"], p["b"], F.right), lambda n: cut(p, n)))


def pieces_met(a: Column, b: Column, n_a: Column, max_edits: int, pieces: int = PIECES) -> Column:
    """Whether all but max_edits of the even pieces of a stand in b within max_edits places: so they do in near lines.

    Each edit spoils one piece at most. This costs a hundredth of a distance, and most pairs that share a segment fail it.
    """
    size = F.floor(n_a / pieces).cast("int")
    piece = lambda k: F.substring(a, size * k + 1, size)
    near = lambda k: F.substring(b, F.greatest(size * k + 1 - max_edits, F.lit(1)), size + 2 * max_edits)
    return F.size(F.filter(F.sequence(F.lit(0), F.lit(pieces - 1)), lambda k: F.contains(near(k), piece(k)))) >= pieces - max_edits


def pair_map(line: Column) -> Column:
    """A bit for each pair of neighbouring characters, by their hash. An edit takes two pairs away at most and adds two, so near lines differ in few bits."""

    def of(chars: Column) -> Column:
        bits = F.transform(chars, lambda c, i: F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(F.xxhash64(c, F.get(chars, i + 1)), F.lit(64)).cast("int")))
        return F.aggregate(bits, F.lit(0).cast("bigint"), lambda s, b: s.bitwiseOR(b))

    return _let(F.split(line, F.lit(""), -1), of)


def occurrences(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(doc_id, line_no from 0, line) of every line that is long enough, trimmed."""
    line = F.col("line")
    edged = reduce(lambda x, y: x | y, [e for c in EDGES for e in (line.startswith(c), line.endswith(c))])
    lines = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.posexplode(F.split(text_or_empty(text_col), "\n", -1)).alias("line_no", "line"))
    return lines.withColumn("line", F.when(edged, F.trim(line, F.lit(EDGES))).otherwise(line)).where(F.length("line") >= min_chars)


def line_id(line: Column) -> Column:
    """16 bytes of SHA-256: the identity of a line's text."""
    return F.substring(F.unhex(F.sha2(line.cast("binary"), 256)), 1, 16)


#: Identifier and line number as one number, which a hash aggregate can hold; null identifiers come first.
PLACE = "decimal(38,0)"


def place(doc_id: Column, line_no: Column) -> Column:
    return (F.coalesce(doc_id, F.lit(-(1 << 63))).cast(PLACE) * F.lit(1 << 32).cast(PLACE) + line_no).cast(PLACE)


def line_links(lines: DataFrame, bands: tuple = BANDS) -> tuple[DataFrame, DataFrame]:
    """(links, roots): links (a, b) whose components are those of all near pairs of the distinct lines (id, line, n), and the components (node, root).

    The keys are counted first, without texts: few of them are met by two lines. Only lines with such a key go on,
    with their texts, and the joins on the key verify their pairs themselves, so that lines which share a segment but
    are not near cost comparisons and no rows.
    """
    t_most = max(t for _, t in bands)
    every = keyed(lines, bands)
    count = every.groupBy("key").agg(F.count(F.when(F.col("own"), 1)).alias("n_own"), F.count("*").alias("many"))
    live = materialize(count.where("n_own > 1 or (n_own = 1 and many > 1)").select("key", (F.col("many") > HOT).alias("hot")), "line-keys")
    if live.count() <= BROADCAST_KEYS:
        met = every.join(F.broadcast(live), "key")
    else:  # the keys alone are dealt, then the lines that have one
        named = every.select("id", "own", "key").join(live, "key")
        met = named.join(lines.select("id", "line", "n"), "id")
    met = materialize(met.select("key", "hot", "own", "id", "line", "n"), "line-met")
    groups = met.where("not hot").drop("hot")
    hot = met.where("hot").select("id", "line", "n").dropDuplicates(["id"])
    if not hot.isEmpty():
        groups = groups.unionByName(by_rare_pieces(hot, bands).select(*groups.columns))
    # a comparison is much work on few bytes: dealt to all tasks, whatever its bytes
    tasks = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    groups = materialize(groups.withColumn("pairs", pair_map(F.col("line"))), "line-groups")

    def near(x: str, z: str) -> Column:
        """x: the line whose own key it is, so the shorter one."""
        a, b, n_a, n_b = F.col(f"{x}.line"), F.col(f"{z}.line"), F.col(f"{x}.n"), F.col(f"{z}.n")
        most = edits(n_a, bands)
        few_bits = F.bit_count(F.col(f"{x}.pairs").bitwiseXOR(F.col(f"{z}.pairs"))) <= 4 * most
        alike = F.when((n_b - n_a).between(0, most) & few_bits, pieces_met(a, b, n_a, t_most)).otherwise(False)
        distance = _let(unlike_part(a, b, t_most + 1), lambda p: banded_distance(p["a"], p["b"], F.length(p["a"]), F.length(p["b"]), t_most))
        return F.when(alike, distance <= most).otherwise(False)

    leads = groups.where("own").groupBy("key").agg(F.min(F.struct("id", "line", "n", "pairs")).alias("x"))
    leads = materialize(leads, "line-leads")
    star = groups.repartition(tasks, "key").alias("z").join(leads, "key").where((F.col("x.id") != F.col("z.id")) & near("x", "z"))
    first = materialize(star.select(F.least("x.id", "z.id").alias("a"), F.greatest("x.id", "z.id").alias("b")).distinct(), "line-star")
    roots = connected_components(first, "line-star")
    # what is left to compare has a line of its own key that is not the smallest
    named = groups.join(roots, F.col("id") == F.col("node"), "left").select("key", "own", "id", "line", "n", "pairs", F.coalesce("root", "id").alias("root"))
    told = (F.min(F.when(F.col("own"), F.col("id"))).alias("lead"), F.count(F.when(F.col("own"), 1)).alias("n_own"))
    x, z = (side.repartition(tasks, "key", "tile").alias(k) for side, k in zip(apart(named, "line", F.col("own"), told=told, where="n_own > 1"), "xz"))
    same = (F.col("x.key") == F.col("z.key")) & (F.col("x.tile") == F.col("z.tile")) & (F.col("x.root") != F.col("z.root")) & (F.col("x.id") != F.col("x.lead"))
    once = F.when(F.col("z.own"), F.col("x.id") < F.col("z.id")).otherwise(True)
    pairs = x.join(z, same & F.when(once, near("x", "z")).otherwise(False)).select(F.col("x.id").alias("a"), F.col("z.id").alias("b"), F.least("x.root", "z.root").alias("lo"), F.greatest("x.root", "z.root").alias("hi"))
    rest = pairs.groupBy("lo", "hi").agg(F.min(F.struct(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))).alias("link"))
    rest = materialize(rest.select("lo", "hi", "link.a", "link.b"), "line-rest")
    links = first.unionAll(rest.select("a", "b"))
    if not rest.isEmpty():  # components of components, by their smallest lines
        up = connected_components(rest.select(F.col("lo").alias("a"), F.col("hi").alias("b")), "line-up")
        every = roots.unionAll(up.join(roots.select("node"), "node", "left_anti").select("node", F.col("node").alias("root")))
        whole = every.join(up.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left").select("node", F.coalesce("top", "root").alias("root"))
        whole = materialize(whole, "line-roots")
        release(roots, up)
        roots = whole
    release(live, met, groups, leads)
    return links, roots


def line_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bands: tuple = BANDS, min_chars: int = 1) -> tuple[DataFrame, DataFrame]:
    """(lines, links): lines that are repeated or in a class (id, first, times, salts, root), and links that make the classes."""
    if any(least <= 3 * t or not 0 < t <= 20 for least, t in bands) or sorted(set(bands)) != list(bands) or min_chars < 1:
        raise ValueError("lines must be longer than three times the edits allowed, and longer lines come later")
    found = occurrences(docs, id_col, text_col, min_chars).select("line", place(F.col("doc_id"), F.col("line_no")).alias("place"), salt_mask(salt_of(F.col("doc_id"))).alias("salt"))
    lines = found.groupBy("line").agg(F.min("place").alias("first"), F.count("*").alias("times"), F.bit_or("salt").alias("salts"))
    lines = materialize(lines.select(line_id(F.col("line")).alias("id"), "line", F.length("line").alias("n"), "first", "times", "salts"), "lines", "zstd")
    links, roots = line_links(lines.select("id", "line", "n"), bands)
    named = lines.select("id", "first", "times", "salts").join(roots, F.col("id") == F.col("node"), "left").withColumn("root", F.coalesce("root", "id")).drop("node")
    known = named.where("times > 1 or root <> id").unionByName(named.where("times <= 1 and root = id").join(roots.select("root").distinct(), "root", "left_semi"))
    return known, links


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bands: tuple = BANDS, min_chars: int = 1) -> DataFrame:
    """(doc_id, line_no, class_id, class_lines) of every line to be removed; class_id: hex identity of the class."""
    known, _ = line_classes(docs, id_col, text_col, bands, min_chars)
    known = materialize(known, "line-known")
    classes = known.groupBy("root").agg(F.min("first").alias("keep"), F.sum("times").alias("class_lines"))
    table = materialize(known.join(classes, "root").select("id", "salts", "root", "keep", "class_lines"), "line-classes")
    release(known)
    rows = occurrences(docs, id_col, text_col, min_chars).select("doc_id", "line_no", line_id(F.col("line")).alias("id"), salt_of(F.col("doc_id")).alias("salt"))
    met = rows.join(spread(table, "salts"), ["id", "salt"])
    stays = place(F.col("doc_id"), F.col("line_no")) == F.col("keep")
    return met.where(~stays).select("doc_id", "line_no", F.lower(F.hex("root")).alias("class_id"), "class_lines")


def line_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bands: tuple = BANDS, min_chars: int = 1) -> DataFrame:
    """doc_id, n_lines, n_removed, removed_lines (line numbers from 0): a row for every identifier."""
    gone = repeated_lines(docs, id_col, text_col, bands, min_chars).select("doc_id", "line_no", F.lit(None).cast("int").alias("n_lines"))
    count = F.size(F.split(text_or_empty(text_col), "\n", -1)).alias("n_lines")
    every = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.lit(None).cast("int").alias("line_no"), count)
    out = every.unionByName(gone).groupBy("doc_id").agg(F.max("n_lines").alias("n_lines"), F.sort_array(F.collect_set("line_no")).alias("removed_lines"))
    return out.select("doc_id", "n_lines", F.size("removed_lines").alias("n_removed"), "removed_lines")


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """docs with the repeated lines taken out of the text; all other columns as they were."""
    gone_id, gone_lines = unused("_tidewright_id", docs), unused("_tidewright_gone", docs)
    gone = line_report(docs, id_col, text_col, **kw).where("n_removed > 0").select(F.col("doc_id").alias(gone_id), F.col("removed_lines").alias(gone_lines))
    rows = docs.join(gone, F.col(id_col).cast("bigint").eqNullSafe(F.col(gone_id)), "left")
    left = F.filter(F.split(text_or_empty(text_col), "\n", -1), lambda x, i: ~F.array_contains(F.col(gone_lines), i))
    text = F.when(F.col(gone_lines).isNull(), F.col(text_col)).otherwise(F.array_join(left, "\n"))
    return rows.select(*[(text.alias(c) if c == text_col else docs[c]) for c in docs.columns])
