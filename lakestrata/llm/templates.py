"""Benchmark decontamination by templates, in DataFrame functions only.

Numbers, names and units are replaced by typed placeholders. A window of consecutive tokens whose
template equals that of a benchmark window is a match, so a question with other parameters is
found too; but within one alignment a benchmark value must always stand for the same text.

Only few places of a text are canonicalised: every benchmark window has an anchor, its longest
literal token, and a window of a text is looked at where the anchor stands in it.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from lakestrata.layout import materialize

WINDOW = 8  # tokens; a shorter item is one window
LEAST_LITERALS = 3  # windows with fewer literal tokens are too common to count
SHARE = 0.5  # of an item's windows that must match, or of its tokens that matched windows must cover
LEAST_RUN = 13  # so many consecutive tokens of an item in one alignment are enough, whatever their share
BROADCAST_WINDOWS = 100_000  # more benchmark windows are joined by shuffles

# Marks trimmed from tokens, and unit words.
MARKS = ".,;:!?\"'()[]{}«»“”‘’…"
UNITS = (
    "mm cm m km inch inches ft feet yard yards mile miles mg g kg lb lbs oz ml l liter liters litre litres "
    "ms s sec second seconds min minute minutes h hour hours day days week weeks month months year years "
    "percent dollar dollars euro euros cent cents usd eur gbp mph kmh hz khz mhz w kw v a n j pa"
).split()
MARK_PATTERN = "[" + re.escape(MARKS) + "]"
NUMBER = "^[$€£+-]?[0-9][0-9.,:/-]*%?$"
NAME = "^\\p{Lu}[\\p{L}'-]+$"


def tokens(text: Column) -> Column:
    """Runs of characters between white space; one empty token for a null or blank text."""
    return F.split(F.btrim(F.regexp_replace(F.coalesce(text, F.lit("")), "\\s+", " ")), " ")


def literal(word: Column) -> Column:
    """A token, or a text, without marks and in lower case."""
    return F.lower(F.regexp_replace(word, MARK_PATTERN, ""))


def core(token: Column) -> Column:
    return F.btrim(token, F.lit(MARKS))


def canonical(window: Column) -> Column:
    """Array of (kind, form, value) per token; kind is null for a literal.

    A name is a capitalised word inside a sentence; the first token of a window is never one, so
    that what stands before the window has no say. A unit is a unit word after a number.
    """

    def one(token: Column, at: Column) -> Column:
        word, low = core(token), literal(token)
        before = F.when(at > 0, F.try_element_at(window, at.cast("int")))
        number = word.rlike(NUMBER)
        unit = low.isin(UNITS) & core(before).rlike(NUMBER)
        name = word.rlike(NAME) & before.isNotNull() & ~before.rlike("[.!?:]$")
        kind = F.when(number, "number").when(F.coalesce(unit, F.lit(False)), "unit").when(F.coalesce(name, F.lit(False)), "name")
        form = F.coalesce(F.concat(F.lit("<"), kind, F.lit(">")), low)
        return F.struct(kind.alias("kind"), form.alias("form"), low.alias("value"))

    return F.transform(window, one)


def template(parts: Column) -> Column:
    return F.xxhash64(F.transform(parts, lambda p: p["form"]))


def slots(parts: Column) -> Column:
    return F.transform(
        F.filter(parts, lambda p: p["kind"].isNotNull()), lambda p: F.struct(p["kind"].alias("kind"), p["value"].alias("value"))
    )


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """(item_id, at, width, size, template, slots, anchor, anchor_at, second, second_at, windows).

    Items without an id or text and windows with too few literals are left out; repeated items
    count once, and of equal ids with different texts each text is an item of its own.
    """
    items = benchmark.where("item_id IS NOT NULL").select("item_id", "text").distinct()
    items = items.select("item_id", F.xxhash64("text").alias("version"), tokens(F.col("text")).alias("t"))
    width = F.least(F.size("t"), F.lit(WINDOW))
    windows = items.select(
        "item_id", "version", "t", width.alias("width"), F.size("t").alias("size"),
        F.explode(F.sequence(F.lit(0), F.size("t") - width)).alias("at"),
    )
    windows = windows.withColumn("parts", canonical(F.slice("t", F.col("at") + 1, F.col("width"))))
    numbered = F.transform("parts", lambda p, i: F.struct(
        F.length(p["form"]).alias("long"), i.alias("place"), p["form"].alias("form"), p["kind"].alias("kind")))
    literal = F.sort_array(F.filter(numbered, lambda p: p["kind"].isNull() & (p["long"] > 0)), asc=False)
    windows = windows.withColumn("literals", literal).where(F.size("literals") >= LEAST_LITERALS)
    windows = windows.select(
        "item_id", "version", "at", "width", "size", template(F.col("parts")).alias("template"), slots(F.col("parts")).alias("slots"),
        F.col("literals")[0]["form"].alias("anchor"), F.col("literals")[0]["place"].alias("anchor_at"),
        F.col("literals")[1]["form"].alias("second"), F.col("literals")[1]["place"].alias("second_at"),
    )
    total = windows.groupBy("item_id", "version").agg(F.count("*").alias("windows"))
    return windows.join(total, ["item_id", "version"])


def anchored(docs: DataFrame, windows: DataFrame, small: bool) -> DataFrame:
    """(doc_id, _text, place, anchor, from, context): the places of a text at which the anchor of a
    benchmark window stands, with as many tokens around as a window there may hold."""
    plain = F.btrim(F.regexp_replace("text", "\\s+", " "))
    texts = docs.where("text IS NOT NULL").select("doc_id", F.xxhash64("text").alias("_text"), plain.alias("plain"))
    # Removing marks leaves the blanks, so both arrays have the same places.
    texts = texts.select("doc_id", "_text", F.split("plain", " ").alias("t"), F.split(literal(F.col("plain")), " ").alias("low"))
    anchors = windows.select("anchor").distinct()
    if small:
        # At most BROADCAST_WINDOWS words.
        known = F.lit(sorted(r["anchor"] for r in anchors.collect()) or [None]).cast("array<string>")
        texts = texts.withColumn("present", F.array_intersect("low", known))
        places = F.filter(F.transform("low", lambda w, i: F.when(F.array_contains("present", w), i)), lambda i: i.isNotNull())
        texts = texts.withColumn("places", F.when(F.size("present") > 0, places))
    else:
        found = texts.select("doc_id", "_text", F.posexplode("low").alias("place", "anchor")).join(anchors, "anchor")
        found = found.groupBy("doc_id", "_text").agg(F.collect_set("place").alias("places"))
        found = found.withColumnsRenamed({"doc_id": "_doc", "_text": "_key"})
        same = texts["doc_id"].eqNullSafe(found["_doc"]) & (texts["_text"] == found["_key"])
        texts = texts.join(found, same)

    def around(place: Column) -> Column:
        begin = F.greatest(place - (WINDOW - 1), F.lit(0))
        return F.struct(
            place.alias("place"), F.get("low", place).alias("anchor"), begin.alias("begin"),
            F.slice("t", begin + 1, F.lit(2 * WINDOW - 1)).alias("context"),
        )

    # Only short contexts are exploded, never a text. The outer form keeps the places from being computed twice.
    here = texts.select("doc_id", "_text", F.explode_outer(F.transform("places", around)).alias("c"))
    return here.where("c IS NOT NULL").select("doc_id", "_text", "c.*")


def coverage(ats: Column, width: Column) -> Column:
    """(covered, run): tokens that windows at ``ats`` cover, and the most of them without a gap."""
    start = F.struct(*[F.lit(0).alias(c) for c in ("covered", "run", "best", "end")])

    def step(s: Column, at: Column) -> Column:
        gained = at + width - F.greatest(at, s["end"])
        run = F.when(at <= s["end"], s["run"] + gained).otherwise(gained)
        return F.struct(
            (s["covered"] + gained).alias("covered"), run.alias("run"), F.greatest(s["best"], run).alias("best"), (at + width).alias("end")
        )

    return F.aggregate(F.sort_array(ats), start, step, lambda s: F.struct(s["covered"].alias("covered"), s["best"].alias("run")))


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, _text, item_id, matched, windows, covered, run, size): per document and item, the benchmark windows
    found in consistent alignments, the item's tokens they cover, the most consecutive ones in one alignment, and all
    tokens of the item. ``_text`` is the hash that tells texts of one doc_id apart."""
    windows = materialize(benchmark_windows(benchmark), "benchmark-windows")
    small = windows.count() <= BROADCAST_WINDOWS
    start = F.col("place") - F.col("anchor_at")
    inside = start - F.col("begin")
    second = literal(F.try_element_at("context", F.greatest(inside + F.col("second_at") + 1, F.lit(1))))
    fits = (start >= 0) & (inside + F.col("width") <= F.size("context")) & (second == F.col("second"))
    near = anchored(docs, windows, small).join(F.broadcast(windows) if small else windows, "anchor").where(fits)
    near = near.withColumn("parts", canonical(F.slice("context", inside + 1, F.col("width"))))
    found = near.where(template(F.col("parts")) == F.col("template")).select(
        "doc_id", "_text", "item_id", "version", "windows", "width", "size", "at", (start - F.col("at")).alias("shift"),
        F.zip_with("slots", slots(F.col("parts")), lambda mine, theirs: F.struct(
            mine["kind"].alias("kind"), mine["value"].alias("mine"), theirs["value"].alias("theirs"))).alias("pairs"),
    )
    # An alignment holds at most the windows of one item.
    aligned = found.groupBy("doc_id", "_text", "item_id", "version", "windows", "width", "size", "shift").agg(
        F.collect_set("at").alias("ats"), F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs")
    )
    given = F.array_distinct(F.transform("pairs", lambda p: F.struct(p["kind"], p["mine"])))
    consistent = aligned.where(F.size(given) == F.size("pairs"))
    key = ("doc_id", "_text", "item_id", "version", "windows", "width", "size")
    whole = consistent.withColumn("run", coverage(F.col("ats"), F.col("width"))["run"]).groupBy(*key).agg(
        F.array_distinct(F.flatten(F.collect_set("ats"))).alias("ats"), F.max("run").alias("run")
    )
    covered = coverage(F.col("ats"), F.col("width"))["covered"].alias("covered")
    return whole.select("doc_id", "_text", "item_id", F.size("ats").alias("matched"), "windows", covered, "run", "size")


def contamination(docs: DataFrame, benchmark: DataFrame, share: float = SHARE) -> DataFrame:
    """All rows of ``docs`` with ``contaminated``, ``item_id`` (the item found to the largest share, the
    smallest id in a tie), ``share`` of its windows and ``n_items`` found.

    An item is found when ``share`` of its windows match or ``share`` of its tokens are covered by matched windows, or when
    LEAST_RUN consecutive tokens are.

    Null and empty texts are clean, as is everything when the benchmark is empty. Rows with equal
    doc_id and text get the same answer. Columns of the added names in ``docs`` are refused.
    """
    if clash := {"contaminated", "item_id", "share", "n_items", "_text"} & set(docs.columns):
        raise ValueError(f"columns in the way: {sorted(clash)}")
    part = F.col("matched") / F.col("windows")
    best = F.max_by(F.struct("item_id", part.alias("share")), F.struct(part.alias("p"), (-F.col("item_id")).alias("i")))
    found = (
        matches(docs, benchmark)
        .where((part >= share) | (F.col("covered") / F.col("size") >= share) | (F.col("run") >= LEAST_RUN))
        .groupBy("doc_id", "_text")
        .agg(best.alias("_best"), F.countDistinct("item_id").alias("n_items"))
    )
    found = materialize(found, "contaminated").select(F.col("doc_id").alias("_doc"), F.col("_text").alias("_key"), "_best", "n_items")
    keyed = docs.withColumn("_text", F.xxhash64("text"))
    joined = keyed.join(found, keyed["doc_id"].eqNullSafe(F.col("_doc")) & (F.col("_text") == F.col("_key")), "left")
    return joined.select(
        *docs.columns, F.col("_best").isNotNull().alias("contaminated"), F.col("_best.item_id").alias("item_id"),
        F.coalesce("_best.share", F.lit(0.0)).alias("share"), F.coalesce("n_items", F.lit(0)).alias("n_items"),
    )
