"""Line dedup under a small edit distance, by segments, in DataFrame functions only.

With at most k edits between two lines, one of k + 1 disjoint segments of the shorter line stands
unchanged in the longer one, near its own place. The first half of the segments is placed from the
start of a line and the others from its end, with one size for all lengths of a band. So lines meet
by the hash of (band of the shorter line, segment number, segment), the longer line probing only with the
substrings that the number of edits outside of the segment allows; of long segments both lines show windows in place of
that. Lines of a segment that too many lines share are cut into finer segments, of which the rarest are indexed. Lines of a
key are paired if their lengths and counts of letters allow it. Spark's ``levenshtein``, bounded, tells the distance.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakestrata.layout import materialize
from lakestrata.llm.components import components

# Lines may differ by one edit per so many characters of the shorter one, up to MOST_EDITS.
CHARS_PER_EDIT = 10
MOST_EDITS = 5
LEAST_CHARS = 20  # shorter lines are not compared for edits
# Candidate lines are preselected by a hash of this many bits, which bounds the broadcast at 2^20 rows.
PRESELECT_BITS = 20
# Lines and keys are frequent when they make up more than one of so many rows: at most so many are broadcast.
FREQUENT = 1 << 16
# Heavy keys are looked for in the lines of one hash in SAMPLE, where they stand for LEAST_HEAVY lines or more.
SAMPLE = 64
LEAST_HEAVY = 16
# Lines of a key with more than these are compared by finer segments.
MOST_LINES = 128
# Letters whose counts are compared before the distance.
LETTERS = "aeinorst"
MORE_LETTERS = (" cdhlmpu", ",.bfgvwy")
# Bands from this length on are wide, and their segments are compared by windows.
WINDOWED = 80


def lines(docs: DataFrame, least: int) -> DataFrame:
    """(doc_id, line_no, line) of the lines of ``least`` characters or more; a null text has none."""
    split = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return split.where(F.length("line") >= least)


def line_id(line: Column) -> Column:
    return F.unhex(F.md5(line))


def edits_of(length: Column) -> Column:
    """Edits allowed to a pair whose shorter line has ``length`` characters."""
    return F.greatest(F.lit(1), F.least(F.lit(MOST_EDITS), F.floor(length / CHARS_PER_EDIT))).cast("int")


def _band(length: Column) -> Column:
    """Least length of the band of ``length``. Bands are wider than MOST_EDITS, and all their lengths allow the same edits."""
    quarter = F.call_function("shiftleft", F.lit(1), F.length(F.bin(length)) - 3)
    return length - F.pmod(length, F.when(length < WINDOWED, F.lit(10)).otherwise(quarter))


def _segments(edits: int, fine: int) -> int:
    return (edits + 1) * fine


def _moves(edits: int, fine: int, windows: bool) -> list[int]:
    """Where segments are looked for: (number, shift from the place in the shorter line), packed as ``number * 64 + shift + 16``.

    Coarse segments (``fine`` = 1): let h be the number of segments placed from the start, the others being placed from the
    end and numbered from -1 down. Either at most h - 1 edits reach into the first ones, and the first segment i that at most i
    edits reach up to is unchanged behind i edits; or the other segments are as well off when read from the end. So a
    segment moves by no more than its number from its own side. Fine segments are all placed from the start and move by
    any number of edits.

    With ``windows`` both lines show the i + 1 windows of a segment that are shorter than it by i characters, i being its number from its
    own side: whatever the shift, one window of the one line is one of the other line. That is fewer rows than 2 * i + 1 shifts.
    """
    if fine > 1:
        found = [(i, shift) for i in range(_segments(edits, fine)) for shift in range(-edits, edits + 1)]
    else:
        left = edits // 2 + 1
        shifts = lambda i: range(0 if windows else -i, i + 1)
        found = [(i, shift) for i in range(left) for shift in shifts(i)]
        found += [(-1 - i, shift) for i in range(edits + 1 - left) for shift in shifts(i)]
    return [no * 64 + shift + 16 for no, shift in found]


BELOW = 32  # the bit of a move that reads the line under the sizes of the band below its own


def _fineness(band: Column) -> Column:
    """Fine segments per coarse one: more where a line is long enough."""
    return F.when(band < 160, F.lit(2)).otherwise(F.lit(4))


def keyed(known: DataFrame, edits: int | None, fine: bool = False) -> DataFrame:
    """(key, id, indexed, needed) of the segments of (id, line): under the sizes of its own band, and under those of the band below
    when lengths of it are within reach.

    Rows with ``indexed`` are the segments of the line itself, or their windows. The others are substrings that a longer line may
    hold a segment at; an indexed row is one of these as well. Of any ``needed`` segments of a line one is unchanged. One row per move leaves the plan before the key is
    computed, so that the generated code has one hash rather than one for each move.
    """
    known = known.select("id", "line", F.length("line").alias("long")).withColumn("own", _band(F.col("long")))
    known = known.withColumn("below", _band(F.col("own") - 1))

    def moves(band: Column, bit: int) -> Column:
        # One table, by the edits and by the number of fine segments, or whether coarse ones have windows: choices by `when` are too much code.
        kinds = [(2, False), (4, False)] if fine else [(1, False), (1, True)]
        table = F.lit([[m + bit for m in _moves(n, part, windows)] for n in range(1, MOST_EDITS + 1) for part, windows in kinds])
        second = _fineness(band) == 4 if fine else band >= WINDOWED
        place = ((F.lit(edits) if edits else edits_of(band)) - 1) * 2 + F.when(second, 2).otherwise(1)
        return F.element_at(table, place)

    reach = F.lit(edits) if edits else edits_of(F.col("below"))
    near = (F.col("own") > LEAST_CHARS) & (F.col("long") - reach < F.col("own"))
    others = F.when(near, moves(F.col("below"), BELOW)).otherwise(F.array().cast("array<int>"))
    rows = known.select("id", "line", "long", "own", "below", F.explode(F.concat(moves(F.col("own"), 0), others)).alias("move"))
    lower = F.col("move").bitwiseAND(BELOW) != 0
    rows = rows.select(
        "id", "line", "long", F.when(lower, F.col("below")).otherwise(F.col("own")).alias("band"),
        F.shiftright("move", 6).alias("no"), (F.col("move").bitwiseAND(31) - 16).alias("shift"), lower.alias("lower"),
    )
    band, no, shift = F.col("band"), F.col("no"), F.col("shift")
    parts = ((F.lit(edits) if edits else edits_of(band)) + 1) * (_fineness(band) if fine else F.lit(1))
    rows = rows.withColumn("size", F.floor(band / parts).cast("int"))
    size = F.col("size")
    at = F.when(no >= 0, size * no).otherwise(F.col("long") + size * no) + 1 + shift
    windows = F.lit(not fine) & (band >= WINDOWED)
    window = F.when(windows, size - F.when(no >= 0, no).otherwise(-1 - no)).otherwise(size)
    key = F.xxhash64(band, no, F.substr("line", at, window))
    needed = F.lit(edits) if edits else edits_of(band)
    indexed = ~F.col("lower") & (windows | (shift == 0))
    return rows.select(key.alias("key"), "id", indexed.alias("indexed"), (needed + 1).alias("needed"))


def banded_distance(a: Column, b: Column, edits: int) -> Column:
    """Edit distance of ``a`` and ``b`` if at most ``edits``, else null.

    One machine word holds the vertical differences of 2 * edits + 1 cells around the diagonal; it moves
    one cell down per character of ``b``. Lengths must differ by ``edits`` at most; then the score is
    followed along the lowest diagonal of the band until it leaves the table, and to the
    last cell from there.
    """
    width = 2 * edits + 1
    full, top = (1 << width) - 1, 1 << (width - 1)

    # Each stage binds its results by a transform over one value, so that none is computed twice.
    def bind(value: Column, stage: Callable[[Column], Column]) -> Column:
        return F.transform(F.array(value), stage)[0]

    letters = F.struct(F.split(a, "").alias("x"), F.split(b, "").alias("y"))
    return bind(letters, lambda s: bind(F.size(s["x"]), lambda n: _follow(s["x"], n, s["y"], bind, edits, width, full, top)))


def _follow(
    x: Column, n: Column, y: Column, bind: Callable, edits: int, width: int, full: int, top: int
) -> Column:
    """The distance of ``x`` (of ``n`` characters) and ``y``, or null above ``edits``."""

    def equal(s: Column, letter: Column) -> Column:
        # Cells of this column are rows j - edits to j + edits, lowest bit first.
        bits = F.lit(0)
        for k in range(width):
            row = s["j"] + (k - edits)
            same = F.when(row >= 1, F.try_element_at(x, row) == letter)
            bits = bits + F.when(F.coalesce(same, F.lit(False)), 1 << k).otherwise(0)
        return F.struct(s["j"].alias("j"), s["vp"].alias("vp"), s["vn"].alias("vn"), s["score"].alias("score"), bits.alias("eq"))

    def diagonal(s: Column) -> Column:
        d0 = (s["eq"].bitwiseAND(s["vp"]) + s["vp"]).bitwiseXOR(s["vp"]).bitwiseOR(s["eq"]).bitwiseOR(s["vn"])
        return F.struct(
            s["j"].alias("j"), s["vp"].alias("vp"), s["vn"].alias("vn"), s["score"].alias("score"),
            d0.bitwiseAND(F.lit(full)).alias("d0"),
        )

    def horizontal(s: Column) -> Column:
        hp = s["vn"].bitwiseOR(F.bitwise_not(s["d0"].bitwiseOR(s["vp"]))).bitwiseAND(F.lit(full))
        return F.struct(
            s["j"].alias("j"), s["score"].alias("score"), s["d0"].alias("d0"), F.shiftright(s["d0"], 1).alias("next"),
            hp.alias("hp"), s["d0"].bitwiseAND(s["vp"]).alias("hn"),
        )

    def vertical(s: Column) -> Column:
        # Down the lowest diagonal while it is inside, then along the last row.
        down = F.when(s["d0"].bitwiseAND(F.lit(top)) != 0, 0).otherwise(1)
        place = F.element_at(F.lit([1 << k for k in range(width)]), F.greatest(n - s["j"] + edits + 1, F.lit(1)))
        along = F.when(s["hp"].bitwiseAND(place) != 0, 1).when(s["hn"].bitwiseAND(place) != 0, -1).otherwise(0)
        score = s["score"] + F.when(s["j"] + edits <= n, down).otherwise(along)
        vp = s["hn"].bitwiseOR(F.bitwise_not(s["next"].bitwiseOR(s["hp"]))).bitwiseAND(F.lit(full))
        vn = s["next"].bitwiseAND(s["hp"])
        return F.struct((s["j"] + 1).alias("j"), vp.alias("vp"), vn.alias("vn"), score.alias("score"))

    def step(s: Column, letter: Column) -> Column:
        # No cell of the band is lower than the followed one by more than its width, so the rest of the line cannot help.
        hopeless = s["score"] > edits + width - 1
        return F.when(hopeless, s).otherwise(bind(bind(bind(equal(s, letter), diagonal), horizontal), vertical))

    # Column 0 is 0, 1, 2, ...: every difference below row 0 is one.
    above = full & ~((1 << edits) - 1)
    start = F.struct(F.lit(1).alias("j"), F.lit(above).alias("vp"), F.lit(0).alias("vn"), F.lit(edits).alias("score"))
    end = F.aggregate(y, start, step)["score"]
    return bind(end, lambda e: F.when(e <= edits, e))


def line_key(line: Column) -> Column:
    """A hash of the line whose last four bits hold those of its length; the two bits above are free (INDEXED, HOT)."""
    return F.xxhash64(line).bitwiseAND(F.lit(-64)).bitwiseOR(F.length(line).cast("long").bitwiseAND(15))


INDEXED, HOT = 16, 32


def _with_ids(docs: DataFrame) -> DataFrame:
    """(id, line) of the lines that are compared, once per document."""
    line = docs.select(F.explode(F.array_distinct(F.split("text", "\n"))).alias("line"))
    return line.where(F.length("line") >= LEAST_CHARS).select(line_key(F.col("line")).alias("id"), "line")


def _each_once(docs: DataFrame) -> DataFrame:
    """(id, line) of all lines, the frequent ones once and the others no more often than in documents.

    Frequent is a line that makes up more than one of FREQUENT lines, so there are at most FREQUENT of them. They are taken out by
    a broadcast of their ids, and only their texts are made distinct: the texts of the others are never shuffled.
    """
    counts = materialize(_with_ids(docs).groupBy("id").agg(F.count("*").alias("n")).where("n > 1"), "line-counts")
    total = _with_ids(docs).count()
    frequent = F.broadcast(counts.where(F.col("n") > total // FREQUENT).select("id"))
    return _with_ids(docs).join(frequent, "id", "left_anti").union(_with_ids(docs).join(frequent, "id", "left_semi").distinct())


def _heavy_keys(docs: DataFrame, edits: int | None) -> DataFrame:
    """Keys that stand for so many lines that no task should sort them, found in the lines of one hash in SAMPLE.

    They are at most FREQUENT. The sample decides only where a key is handled: lines of
    a key that it misses are found to be too many for pairs after the exchange.
    """
    sample = _with_ids(docs).where(F.pmod(F.shiftright("id", 6), F.lit(SAMPLE)) == 0).distinct()
    counts = materialize(keyed(sample, edits).groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_HEAVY), "key-counts")
    keys = keyed(sample, edits).count()
    return counts.where(F.col("n") > keys // FREQUENT).select("key")


def _count(line: Column, letter: str) -> Column:
    return F.octet_length(line) - F.octet_length(F.replace(line, F.lit(letter), F.lit("")))


def letter_counts(line: Column) -> Column:
    """How often each of LETTERS stands in the line, by their last eight bits."""
    packed = F.lit(0).cast("long")
    for n, letter in enumerate(LETTERS):
        packed = packed.bitwiseOR(F.shiftleft(F.pmod(_count(line, letter), F.lit(256)).cast("long"), 8 * n))
    return packed


def letters_apart(a: Column, b: Column) -> Column:
    """At most the sum of the differences of two lines' counts; an edit changes it by two at most."""
    byte = lambda x, n: F.shiftrightunsigned(x, 8 * n).bitwiseAND(255)
    gaps = [F.abs(byte(a, n) - byte(b, n)) for n in range(len(LETTERS))]
    return sum((F.least(gap, 256 - gap) for gap in gaps), F.lit(0))


def counts_in_steps(line: Column, letters: str) -> Column:
    """Counts of eight letters modulo 16, in eight bits each, of which one changes with each step.

    The bits in which two such numbers differ are at most as many as the sum of the differences of the counts.
    """
    packed = F.lit(0).cast("long")
    for n, letter in enumerate(letters):
        codes = F.lit([(1 << c) - 1 if c < 8 else 256 - (1 << c - 8) for c in range(16)])
        packed = packed.bitwiseOR(F.shiftleft(F.element_at(codes, F.pmod(_count(line, letter), F.lit(16)) + 1).cast("long"), 8 * n))
    return packed


def marks(line: Column) -> list[Column]:
    """What tells most lines of a key apart: the length, and counts of letters."""
    steps = [counts_in_steps(line, letters).alias(f"steps{n}") for n, letters in enumerate(MORE_LETTERS)]
    return [F.length(line).alias("long"), letter_counts(line).alias("letters"), *steps]


MARKS = ["long", "letters", *[f"steps{n}" for n in range(len(MORE_LETTERS))]]
SKETCH = [f"sketch{n}" for n in range(4)]


def sketches(known: DataFrame) -> DataFrame:
    """(id, SKETCH): 256 bits for each (id, line), each the parity of how many of the line's pairs of neighbouring letters have its hash.

    An edit changes at most four bits, and one that changes the length at most three.
    """
    letters = F.split("line", "")
    both = known.select("id", F.explode(F.arrays_zip(letters.alias("x"), F.slice(letters, F.lit(2), F.length("line")).alias("y"))).alias("p"))
    hashed = both.where("p.y IS NOT NULL").select("id", F.xxhash64("p.x", "p.y").alias("h"))
    word, bit = F.shiftright("h", 6).bitwiseAND(3), F.call_function("shiftleft", F.lit(1).cast("long"), F.col("h").bitwiseAND(63).cast("int"))
    return hashed.groupBy("id").agg(*[F.bit_xor(F.when(word == n, bit).otherwise(F.lit(0).cast("long"))).alias(name) for n, name in enumerate(SKETCH)])


def _differing(names: list[str]) -> Column:
    return sum((F.bit_count(F.col(f"{name}_a").bitwiseXOR(F.col(f"{name}_b"))) for name in names), F.lit(0))


def _likely(edits: int | None) -> Column:
    """Whether lines a and b, with their marks as ``<mark>_a`` and ``<mark>_b``, may be a pair with the shorter line a.

    A replaced letter changes the counts by two at most, and each of the others, which make up the gap, by one. Pairs of equal
    lengths come in one order.
    """
    reach = F.lit(edits) if edits else edits_of(F.col("long_a"))
    gap = F.col("long_b") - F.col("long_a")
    apart, most = _differing(MARKS[2:]), 2 * reach - gap
    near = gap.between(F.lit(0), reach) & ((gap > 0) | (F.col("a") < F.col("b"))) & (apart <= most)
    return near & (apart + letters_apart(F.col("letters_a"), F.col("letters_b")) <= most)


def _as(rows: DataFrame, side: str) -> DataFrame:
    """``rows`` with the id as ``side`` and the marks named by it."""
    return rows.select("key", F.col("id").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in rows.columns if c in MARKS + SKETCH])


def candidates(docs: DataFrame, edits: int | None) -> DataFrame:
    """(a, b): keys of lines of which one segment of the shorter line a stands in b, and whose marks allow it, each pair once.

    All rows meet in one exchange, and only those of keys with two lines or more are written. Keys of more than MOST_LINES
    lines give no pairs: their lines meet again in :func:`_fine_candidates`. Marks join the rows that are written, so
    that pairs that cannot be close never become rows.
    """
    if edits is not None and (edits < 1 or 4 * edits > LEAST_CHARS):
        raise ValueError(f"at least one edit, and at most one in four of {LEAST_CHARS} characters")
    heavy = F.broadcast(_heavy_keys(docs, edits).withColumn("heavy", F.lit(True)))
    rows = keyed(_each_once(docs), edits).join(heavy, "key", "left")
    # A heavy key is told apart by line, which spreads its rows; they only name the lines concerned.
    spread = F.when(F.col("heavy"), F.xxhash64("key", "id")).otherwise(F.col("key"))
    flags = F.when(F.col("indexed"), INDEXED).otherwise(0) + F.when(F.col("heavy"), HOT).otherwise(0)
    rows = rows.select(spread.alias("key"), F.col("id").bitwiseOR(flags.cast("long")).alias("code"))
    line, group = F.col("code").bitwiseAND(~(INDEXED + HOT)), Window.partitionBy("key")
    rows = rows.select(
        "key", "code", F.min(line).over(group).alias("least"), F.max(line).over(group).alias("most"),
        F.max(F.col("code").bitwiseAND(INDEXED)).over(group).alias("index"), F.count("*").over(group).alias("n"),
    )
    hot = (F.col("code").bitwiseAND(HOT) != 0) | (F.col("n") > MOST_LINES)
    rows = rows.where((F.col("code").bitwiseAND(HOT) != 0) | ((F.col("least") < F.col("most")) & (F.col("index") > 0)))
    rows = rows.select("key", line.alias("id"), (F.col("code").bitwiseAND(INDEXED) != 0).alias("indexed"), hot.alias("hot"))
    rows = materialize(rows, "line-keys")
    met = rows.where("NOT hot")
    known = _some(docs, met.select("id").distinct()).select("id", *marks(F.col("line"))).distinct()
    met = materialize(met.select("key", "id", "indexed").join(known, "id"), "line-candidates")
    pairs = _as(met.where("indexed"), "a").join(_as(met, "b"), "key").where(_likely(edits)).select("a", "b")
    many = materialize(rows.where("hot").select("id").distinct(), "line-hot")
    if not many.isEmpty():
        pairs = pairs.union(_fine_candidates(texts_of(docs, many), edits))
    return pairs.distinct()


def _fine_candidates(known: DataFrame, edits: int | None) -> DataFrame:
    """Pairs of (id, line) whose coarse segments are shared by too many lines.

    A line is cut into two or four times as many segments. All but ``edits`` of them stand in a close line, so one of any
    ``edits`` + 1 does; the rarest ones are indexed. A passage that many lines share gives no pairs as long as the rest
    of a line holds that many segments. What is frequent beyond that belongs to lines that agree in most of their
    segments, which only their marks tell apart; the join splits it where it is skewed.
    """
    rows = keyed(known, edits, fine=True)
    index = materialize(rows.where("indexed").select("key", F.col("id").alias("a"), "needed").distinct(), "line-fine")
    # By what is looked for: a passage behind an inserted character is rare as a segment, and yet stands in many lines.
    counted = index.join(rows.groupBy("key").agg(F.count("*").alias("n")), "key")
    rank = F.row_number().over(Window.partitionBy("a").orderBy("n", "key"))
    rarest = materialize(counted.withColumn("rank", rank).where("rank <= needed AND n > 1").select("key", F.col("a").alias("id")), "line-rarest")
    marked = materialize(known.select("id", *marks(F.col("line"))).join(sketches(known), "id"), "line-marks")
    probes = rows.select("key", "id").join(rarest.select("key").distinct(), "key", "left_semi").distinct()
    pairs = _as(rarest.join(marked, "id"), "a").join(_as(probes.join(marked, "id"), "b"), "key").where(_likely(edits))
    reach = F.lit(edits) if edits else edits_of(F.col("long_a"))
    return pairs.where(_differing(SKETCH) <= 4 * reach - (F.col("long_b") - F.col("long_a"))).select("a", "b")


def _some(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, line) of the lines with these ids and of some others. A bounded broadcast of hash buckets leaves out most others."""
    bucket = F.pmod(F.xxhash64("id"), F.lit(1 << PRESELECT_BITS))
    buckets = ids.select(bucket.alias("bucket")).distinct()
    return _with_ids(docs).withColumn("bucket", bucket).join(F.broadcast(buckets), "bucket", "left_semi").select("id", "line")


def texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, line) of the lines with these ids."""
    return materialize(_some(docs, ids).distinct().join(ids, "id", "left_semi"), "line-texts")


def links(docs: DataFrame, edits: int | None = None) -> DataFrame:
    """(a, b, distance) of all different lines within ``edits``, by line id, each pair once.

    Without ``edits`` they follow from the length of the shorter line (:func:`edits_of`).
    """
    likely = materialize(candidates(docs, edits), "line-likely")
    texts = texts_of(docs, likely.select(F.col("a").alias("id")).union(likely.select("b")).distinct())
    both = likely.join(texts.select(F.col("id").alias("a"), F.col("line").alias("line_a")), "a")
    both = both.join(texts.select(F.col("id").alias("b"), F.col("line").alias("line_b")), "b")
    # Lines of a pair of equal lengths come in any order; otherwise a is the shorter one.
    allowed = F.lit(edits) if edits else edits_of(F.length("line_a"))
    # Negative above the most edits.
    distance = F.levenshtein("line_a", "line_b", edits or MOST_EDITS)
    ids = line_id(F.col("line_a")).alias("a"), line_id(F.col("line_b")).alias("b")
    return both.where(distance.between(F.lit(0), allowed)).select(*ids, distance.alias("distance"))


def _placed(docs: DataFrame, edits: int | None, least: int) -> DataFrame:
    """(doc_id, line_no, id, class, near) of every line of ``least`` characters or more, written to the shared folder."""
    linked = materialize(links(docs, edits).select("a", "b"), "line-links")
    classes = components(linked, "a", "b")
    placed = lines(docs, least).select("doc_id", "line_no", line_id(F.col("line")).alias("id"))
    placed = placed.join(classes, F.col("id") == F.col("node"), "left")
    near = F.col("node").isNotNull().alias("near")
    return materialize(placed.select("doc_id", "line_no", "id", F.coalesce("component", "id").alias("class"), near), "line-classes")


def _first(placed: DataFrame) -> DataFrame:
    return placed.groupBy("class").agg(F.min(F.struct("doc_id", "line_no")).alias("first"))


def line_classes(docs: DataFrame, edits: int | None = None, least: int = 1) -> DataFrame:
    """(doc_id, line_no, id, class, near, kept) of every line of ``least`` characters or more.

    Lines that are equal or linked through close lines form a class; only its first line, in the order
    of doc_id and line number, is ``kept``. Lines under LEAST_CHARS form classes of equal lines only. ``near`` tells that a close
    but different line exists. Equal doc_ids and numbers count as one place.
    """
    placed = _placed(docs, edits, least)
    kept = F.struct("doc_id", "line_no").eqNullSafe(F.col("first"))
    return placed.join(_first(placed), "class").select(*placed.columns, kept.alias("kept"))


def kept_texts(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """``docs`` with ``text`` cut down to the kept lines of :func:`line_classes`, and the numbers of the others as ``removed``.

    Lines outside of the classes (empty ones) stay. A null text stays null, and a text whose lines all go is empty. Rows of one
    doc_id lose the lines that stand at the removed numbers with the removed content.
    """
    gone = classes.where("NOT kept").groupBy(F.col("doc_id").alias("_doc"))
    gone = gone.agg(F.collect_set(F.struct("line_no", "id")).alias("_gone"))
    none = F.array().cast("array<struct<line_no:int,id:binary>>")
    both = docs.join(gone, F.col("doc_id").eqNullSafe(F.col("_doc")), "left").withColumn("_gone", F.coalesce("_gone", none))
    split = F.transform(F.split("text", "\n"), lambda line, n: F.struct(n.alias("line_no"), line.alias("line")))
    out = lambda x: F.array_contains("_gone", F.struct(x["line_no"].alias("line_no"), line_id(x["line"]).alias("id")))
    both = both.withColumn("_marked", F.transform(split, lambda x: F.struct(x["line_no"], x["line"], out(x).alias("out"))))
    text = F.array_join(F.transform(F.filter("_marked", lambda x: ~x["out"]), lambda x: x["line"]), "\n")
    removed = F.transform(F.filter("_marked", lambda x: x["out"]), lambda x: x["line_no"])
    removed = F.coalesce(removed, F.array().cast("array<int>"))
    return both.select(*[c for c in docs.columns if c != "text"], text.alias("text"), removed.alias("removed"))


def dedup_lines(docs: DataFrame, edits: int | None = None, least: int = 1) -> DataFrame:
    """Per doc_id: n_lines, n_near (lines with a close but different line) and n_removed, by :func:`line_classes`.

    Lines under ``least`` characters stay. Rows with equal doc_id
    count as one document. A null text has no lines; an empty text has one empty line.
    """
    placed = _placed(docs, edits, least)
    kept = _first(placed).groupBy(F.col("first.doc_id").alias("doc_id")).agg(F.count("*").alias("kept"))
    per_doc = placed.groupBy("doc_id").agg(F.count("*").alias("compared"), F.count_if("near").alias("n_near"))
    counts = docs.groupBy("doc_id").agg(F.coalesce(F.sum(F.size(F.split("text", "\n"))), F.lit(0)).cast("long").alias("n_lines"))
    sums = [
        counts.select("doc_id", "n_lines", *[F.lit(0).cast("long").alias(c) for c in ("compared", "n_near", "kept")]),
        per_doc.select("doc_id", F.lit(0).cast("long").alias("n_lines"), "compared", "n_near", F.lit(0).cast("long").alias("kept")),
        kept.select("doc_id", *[F.lit(0).cast("long").alias(c) for c in ("n_lines", "compared", "n_near")], "kept"),
    ]
    # Sums over a union rather than joins: null doc_ids meet too.
    total = sums[0].unionByName(sums[1]).unionByName(sums[2]).groupBy("doc_id").agg(*[F.sum(c).alias(c) for c in ("n_lines", "compared", "n_near", "kept")])
    return total.select("doc_id", "n_lines", "n_near", (F.col("compared") - F.col("kept")).alias("n_removed"))
