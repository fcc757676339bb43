"""N-gram Jaccard join with skipping by set relations, to connected components.

Linked sets differ in at most (|x| + |y|) / 19 shingles at a Jaccard similarity of 0.9. Three steps
use this, none of which writes all pairs of a group:

1. Index lists by position: the shingle space is cut into half as many parts again as differences
   are allowed, so linked sets agree on a third of the parts. A list holds the sets of one block
   of sizes that have the same shingles in the part at one position. Lists of one set are
   skipped at once, then sets that are in too few lists of a block, and of the others' lists the
   longest.
2. Of each list only the pairs with its most central set, the leader, are computed.
3. Derived answers: sets linked to one leader are connected. Any other link among its members shows in
   their differences from it: sets are as far apart as their differences are. All members of a leader that are not far from
   it settle their links by these in one task, without a text. Only the members of a leader that has too many
   go through another round, which indexes differences in place of sets, by their rarest shingles: two sets that differ
   from it by x and y shingles must share (x + y - allowed) / 2 of these. Members far from the leader stay in their
   list and get a leader of their own, once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from lakestrata.layout import materialize
from lakestrata.llm.components import components
from lakestrata.llm.words import Words, mix, pieces, runs, words_of

BAND = 1.5  # ratio of set sizes in a block of a list
SEEN_SETS = 200_000  # that a task remembers to have sent
# One task settles the members of a leader up to this number of them and of their differences; both grow by each round.
MEMBERS = 4096
DIFFERENCES = 1 << 18
OVERLAPS = 1 << 20  # counted at a time
PRESELECT = 1 << 20  # bounds the broadcasts that preselect rows by a hash
# A text has many times its own size in keys, and a pair two arrays of shingles: both are handled in smaller pieces than texts.
KEY_BYTES = 1 << 19
PAIR_BYTES = 4 << 20
_STEP = np.uint64(0x9E3779B97F4A7C15)


class Join:
    """Jaccard similarity of at least ``percent`` / 100 between sets of ``width``-word shingles."""

    def __init__(self, width: int = 3, percent: int = 90) -> None:
        if not 50 < percent < 100 or width < 1:
            raise ValueError("a similarity between 50 and 100 percent, exclusive, and a width of at least 1")
        self.width, self.percent = width, percent
        # A member counts as far from its leader if it differs from it by more than its size, and as near up to
        # near / percent times its size. No set near only can be linked with one far only.
        self.near = 200 - percent
        edges = [1]
        while edges[-1] < 1 << 40:
            edges.append(max(edges[-1] + 1, int(edges[-1] * BAND)))
        self.edges = np.array(edges)

    def most_apart(self, both: np.ndarray | int) -> np.ndarray | int:
        """Largest symmetric difference of linked sets whose sizes add up to ``both``."""
        return both * (100 - self.percent) // (100 + self.percent)

    def largest_partner(self, size: np.ndarray | int) -> np.ndarray | int:
        return size * 100 // self.percent

    def band(self, size: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.edges, size, side="right") - 1

    def bands(self, size: np.ndarray) -> list[np.ndarray]:
        """A set's own block and that of its largest partner, which may be the same."""
        return [self.band(size), self.band(self.largest_partner(size))]

    def parts(self, band: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Parts of a block, and the number on which linked sets agree at least."""
        apart = self.most_apart(2 * (self.edges[band + 1] - 1))
        agree = np.maximum(1, (apart + 1) // 2)
        return apart + agree, agree


def shingles(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, values): distinct shingles of each document, ascending. A text of fewer words
    than ``width`` has its whole sequence as the only shingle; one without words has none."""
    h, counts = words.hashes(), words.counts()
    at = runs(words.first, width)
    document = words.document_of_word()
    # Short texts: the sequence as one shingle of its own length.
    few = np.flatnonzero((counts > 0) & (counts < width))
    value = np.zeros(len(at), np.uint64)
    for n in range(width):
        value = mix(value * _STEP + h[at + n])
    lone = np.zeros(len(few), np.uint64)
    for n in range(width - 1):
        there = counts[few] > n
        lone[there] = mix(lone[there] * _STEP + h[words.first[few[there]] + n])
    lone = mix(lone + counts[few].astype(np.uint64))
    value = np.concatenate([value, lone])
    owner = np.concatenate([document[at] if len(at) else at, few])
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.append(True, (value[1:] != value[:-1]) | (owner[1:] != owner[:-1]))[: len(value)]
    value, owner = value[new], owner[new]
    return np.searchsorted(owner, np.arange(len(counts) + 1)), value


def _sums(first: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Wrapping sums of runs, 0 for empty ones."""
    total = np.append(np.uint64(0), np.cumsum(values, dtype=np.uint64))
    return total[first[1:]] - total[first[:-1]]


def set_ids(first: np.ndarray, value: np.ndarray) -> np.ndarray:
    """64 bits per set of shingles."""
    size = np.diff(first).astype(np.uint64)
    return mix(_sums(first, mix(value ^ np.uint64(0x5DEECE66D))) ^ mix(size)).view(np.int64)


def profiles(docs: DataFrame, join: Join) -> DataFrame:
    """(doc_id, version, n_shingles, sid) per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                first, value = shingles(words_of(piece.column("text"), lower=True), join.width)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": piece.column("doc_id").cast(pa.int64()), "version": piece.column("version"),
                    "n_shingles": pa.array(np.diff(first), pa.int64()), "sid": pa.array(set_ids(first, value)),
                })

    return materialize(docs.mapInArrow(run, "doc_id long, version long, n_shingles long, sid long"), "set-profiles")


def part_keys(docs: DataFrame, join: Join) -> DataFrame:
    """(key, sid, agree): what a set holds of each part of the shingle space, for its blocks, and
    in how many lists of the block it must be; this number tells blocks apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for piece in pieces(batch, most=KEY_BYTES):
                first, value = shingles(words_of(piece.column("text"), lower=True), join.width)
                size, sid = np.diff(first), set_ids(first, value)
                # A task sends a set once, however many copies it reads.
                fresh = np.array([s not in seen and not seen.add(s) for s in sid.tolist()], bool) & (size > 0)
                if len(seen) > SEEN_SETS:
                    seen.clear()
                owner, spread = np.repeat(np.arange(len(size)), size), mix(value)
                own, above = join.bands(size)
                for band, use in ((own, fresh), (above, fresh & (above != own))):
                    # A block of sizes that allow no difference needs no parts: linked sets are equal.
                    parts, agree = join.parts(np.maximum(band, 0))
                    parts = np.where(use & (parts > 1), parts, 0)
                    base = np.append(0, np.cumsum(parts))
                    mine = parts[owner] > 0
                    who = owner[mine]
                    slot = base[who] + ((spread[mine] >> np.uint64(20)) % parts[who].astype(np.uint64)).astype(np.int64)
                    held = np.zeros(base[-1], np.uint64)
                    np.add.at(held, slot, spread[mine])
                    of = np.repeat(np.arange(len(size)), parts)
                    place = (np.arange(base[-1]) - base[of]).astype(np.uint64)
                    key = mix(held + mix(place * np.uint64(1 << 20) + band[of].astype(np.uint64)))
                    yield pa.RecordBatch.from_pydict({
                        "key": pa.array(key.view(np.int64)), "sid": pa.array(sid[of]), "agree": pa.array(agree[of], pa.int32()),
                    })

    return docs.select("text").mapInArrow(run, "key long, sid long, agree int")


def agreeing(keys: DataFrame) -> DataFrame:
    """Rows whose key another set has too, each once. One exchange; rows stream by in the order of
    keys, so a long list takes no more memory than a short one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried, sent = None, False  # the last row waits for what follows, unless it is sent already
        for batch in batches:
            key, sid, agree = (batch.column(c).to_numpy() for c in ("key", "sid", "agree"))
            if not len(key):
                continue
            if carried is not None:
                key, sid, agree = (np.append(a, b) for a, b in zip(carried, (key, sid, agree)))
            new = np.append(True, (key[1:] != key[:-1]) | (sid[1:] != sid[:-1]))
            key, sid, agree = key[new], sid[new], agree[new]
            same = key[1:] == key[:-1]
            before = np.append(False, same)
            send = before | np.append(same, False)
            send[0] &= not sent
            yield pa.RecordBatch.from_pydict({"key": pa.array(key[send]), "sid": pa.array(sid[send]), "agree": pa.array(agree[send])})
            sent = bool(before[-1]) or (sent and len(key) == 1)
            carried = key[-1:], sid[-1:], agree[-1:]

    ordered = keys.repartition("key").sortWithinPartitions("key", "sid")
    return materialize(ordered.mapInArrow(run, "key long, sid long, agree int"), "set-parts")


def shortest(lists: DataFrame) -> DataFrame:
    """(key, sid): of a set's n lists of a block the n - agree + 1 shortest.

    Linked sets share at least ``agree`` lists of a block, so in one order of all lists they share one of
    these; sets with fewer lists have no link. A window holds at most the parts of one set.
    """
    long = lists.groupBy("key").agg(F.count("*").alias("n"))
    mine = Window.partitionBy("sid", "agree")
    ranked = lists.join(long, "key").select(
        "key", "sid", "agree", F.row_number().over(mine.orderBy("n", "key")).alias("place"),
        F.count("*").over(mine).alias("has"),
    )
    kept = ranked.where("place <= has - agree + 1").select("key", "sid")
    held = kept.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    return materialize(kept.join(held, "key"), "set-parts")


def _bucket(*columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(PRESELECT))


class Sets:
    """Where sets can be read: one text of each."""

    def __init__(self, docs: DataFrame, places: DataFrame, join: Join) -> None:
        self.docs, self.places, self.join = docs, places, join

    def tokens(self, wanted: DataFrame, name: str) -> DataFrame:
        """(sid, <name>, tokens) for the rows (sid, <name>) of ``wanted``, <name> being an array of
        partners; a row per partner. The texts are preselected by a hash, of which at most 2^20
        values are broadcast, so that few other texts are shuffled."""
        places = self.places.join(wanted, "sid")
        places = materialize(places, "set-places")
        some = places.select(_bucket("doc_id", "version").alias("_bucket")).distinct()
        texts = self.docs.withColumn("_bucket", _bucket("doc_id", "version")).join(F.broadcast(some), "_bucket", "left_semi")
        texts = texts.dropDuplicates(["doc_id", "version"]).select(
            F.col("doc_id").alias("_doc"), F.col("version").alias("_version"), "text"
        )
        here = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("version") == F.col("_version"))
        chosen = places.join(texts, here).select("sid", name, "text")
        width = self.join.width

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for piece in pieces(batch):
                    first, value = shingles(words_of(piece.column("text"), lower=True), width)
                    partners = piece.column(name)
                    at = np.repeat(np.arange(piece.num_rows), partners.value_lengths().to_numpy())
                    raw = pa.array([value[a:b].astype("<u8").tobytes() for a, b in zip(first, first[1:])], pa.binary())
                    # A row per partner, so a set of many partners fills several batches.
                    filled = np.cumsum(8 * np.diff(first)[at]) // PAIR_BYTES
                    for some in np.split(np.arange(len(at)), np.flatnonzero(np.diff(filled)) + 1):
                        rows = pa.array(at[some])
                        yield pa.RecordBatch.from_arrays(
                            [piece.column("sid").take(rows), partners.flatten().take(pa.array(some)), raw.take(rows)],
                            names=["sid", name, "tokens"],
                        )

        return chosen.mapInArrow(run, f"sid long, {name} long, tokens binary")


def _unpack(rows: DataFrame, column: str, *keep: str) -> DataFrame:
    """One row per 64-bit value of a binary column."""
    names = list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column(column).to_pylist()
            value = np.frombuffer(b"".join(raw), "<i8")
            at = pa.array(np.repeat(np.arange(len(raw)), [len(r) // 8 for r in raw]))
            yield pa.RecordBatch.from_arrays([*[batch.column(k).take(at) for k in names], pa.array(value)], names=[*names, "token"])

    schema = ", ".join(f"{k} long" for k in names) + ", token long"
    return rows.select(*names, column).mapInArrow(run, schema)


def rarest(tokens: DataFrame, within: list[str], owner: list[str], sizes: DataFrame, shown: Column) -> DataFrame:
    """The rarest ``shown`` of a set's tokens that are not its own alone: (owner, rank, token list).

    ``rank`` counts tokens that only this set has; they are the rarest and use up places. ``sizes``
    has the columns of ``owner`` and ``size``. A list holds at most the tokens of one set.
    """
    often = tokens.groupBy(*within, "token").agg(F.count("*").alias("df")).where("df > 1")
    common = tokens.join(often, [*within, "token"]).groupBy(*owner).agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("common"))
    own = F.col("size") - F.size("common")
    rest = sizes.join(common, owner).withColumn("rank", own).withColumn("left", shown - own).where("left > 0")
    listed = F.transform(F.slice("common", 1, F.greatest("left", F.lit(0)).cast("int")), lambda x: x["token"])
    return rest.withColumn("listed", listed).drop("common", "left")


def compare(pairs: DataFrame, sets: Sets, join: Join, every: bool) -> DataFrame:
    """(a, b, size_a, size_b, linked, apart, difference) of members and their leaders; the difference is empty
    for members that are not near, unless ``every`` one is wanted."""
    # A set has no more partners than it has lists.
    mine = sets.tokens(pairs.groupBy(F.col("a").alias("sid")).agg(F.collect_set("b").alias("b")), "b")
    mine = mine.select(F.col("sid").alias("a"), "b", F.col("tokens").alias("x"))
    leaders = pairs.select(F.col("b").alias("sid")).distinct().withColumn("self", F.array("sid"))
    theirs = sets.tokens(leaders, "self").select(F.col("sid").alias("b"), F.col("tokens").alias("y"))
    both = mine.join(theirs, "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in (p for batch in batches for part in pieces(batch, "x", PAIR_BYTES) for p in pieces(part, "y", PAIR_BYTES)):
            rows = []
            # Values of one row at a time, which are read where they lie.
            for x, y in zip(piece.column("x"), piece.column("y")):
                x, y = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
                apart = np.setxor1d(x, y, assume_unique=True)
                linked = len(apart) * (100 + join.percent) <= (100 - join.percent) * (len(x) + len(y))
                far = not every and len(apart) * join.percent > join.near * len(x)
                rows.append((len(x), len(y), linked, len(apart), b"" if far else apart.tobytes()))
            names = ["size_a", "size_b", "linked", "apart", "difference"]
            kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.binary()]
            columns = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [piece.column("a"), piece.column("b"), *[pa.array(c, k) for c, k in zip(columns, kinds)]], names=["a", "b", *names]
            )

    schema = "a long, b long, size_a long, size_b long, linked boolean, apart long, difference binary"
    return materialize(both.mapInArrow(run, schema), "set-comparisons")


def near_members(found: DataFrame) -> DataFrame:
    """Members near leaders that have something left to decide, with the number ``n`` of them and ``differences`` of a leader."""
    near = found.where(F.length("difference") > 0)
    # Leaders all of whose members are linked have nothing left to decide.
    sums = near.groupBy("b").agg(F.count("*").alias("n"), F.sum("apart").alias("differences"), F.bool_or(~F.col("linked")).alias("undecided"))
    return near.join(sums.where("undecided AND n > 1").drop("undecided"), "b")


def overlaps(owner: np.ndarray, token: np.ndarray, size: np.ndarray, rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, counts): for some of ``rows`` at a time, how many tokens each shares with every set.

    ``owner`` and ``token`` list the sets' tokens in the order of owners, ``size`` has their number by set.
    """
    order = np.argsort(token, kind="stable")
    _, place, often = np.unique(token, return_inverse=True, return_counts=True)
    holders, begin = owner[order], np.cumsum(often) - often
    first = np.cumsum(size) - size
    work = np.maximum(np.bincount(owner, often[place], len(size))[rows], len(size)).cumsum()
    for some in np.split(rows, np.flatnonzero(np.diff(work // OVERLAPS)) + 1):
        mine = size[some]
        at = place[np.repeat(first[some] - np.cumsum(mine) + mine, mine) + np.arange(mine.sum())]
        met = often[at]
        other = holders[np.repeat(begin[at] - np.cumsum(met) + met, met) + np.arange(met.sum())]
        row = np.repeat(np.repeat(np.arange(len(some)), mine), met)
        yield some, np.bincount(row * len(size) + other, minlength=len(some) * len(size)).reshape(len(some), len(size))


def member_links(members: DataFrame, join: Join) -> DataFrame:
    """(a, b) links that connect what is linked among the members of one leader, each with its difference from it.

    Members linked to the leader count as connected. At most one link for each member.
    """

    def run(table: pa.Table) -> pa.Table:
        sid, whole = table.column("a").to_numpy(), table.column("size_a").to_numpy()
        linked, size = table.column("linked").to_numpy(), table.column("apart").to_numpy()
        token = np.frombuffer(b"".join(table.column("difference").to_pylist()), "<u8")
        group = np.where(linked, len(sid), np.arange(len(sid)))
        links = []
        for rows, shared in overlaps(np.repeat(np.arange(len(sid)), size), token, size, np.flatnonzero(~linked)):
            for row, same in zip(rows, shared):
                near = (size[row] + size - 2 * same) * (100 + join.percent) <= (100 - join.percent) * (whole[row] + whole)
                # One link to each group that is met; these become one.
                met, at = np.unique(np.where(near, group, group[row]), return_index=True)
                for one, other in zip(met, at):
                    if one != group[row]:
                        links.append((sid[row], sid[other]))
                if len(met) > 1:
                    group[np.isin(group, met)] = group[row]
        a, b = zip(*links) if links else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    rows = members.select("a", "b", "size_a", "linked", "apart", "difference")
    return rows.groupBy("b").applyInArrow(run, "a long, b long")


def next_lists(led: DataFrame, found: DataFrame, near: DataFrame, join: Join, every: bool) -> DataFrame:
    """Lists for the pairs that a round of leaders has left undecided; ``near`` has the members of leaders that have too many.

    A member near its leader goes on by its differences, one far from it stays in the list unless ``every`` member counts as near; linked
    sets always share one of the two zones, which overlap. Sets linked to the leader are
    closed: pairs of closed sets need no look.
    """
    distant = found.where(F.lit(not every) & F.expr("NOT linked AND apart > size_a")).select(F.col("a").alias("sid"), "b")
    far = led.join(distant, ["sid", "b"]).select("key", "sid", "rank", "open")
    tokens = _unpack(near, "difference", "a", "b")
    # What a linked set shares at least with any open one, and an open one with any set.
    closed_share = F.ceil(F.col("size") * join.percent / (100 + join.percent))
    open_share = F.col("size") - F.floor(F.col("whole") * (100 - join.percent) / join.percent)
    share = F.greatest(F.lit(1), F.when(F.col("linked"), closed_share).otherwise(open_share))
    sizes = near.select("a", "b", F.col("apart").alias("size"), F.col("size_a").alias("whole"), "linked")
    shown = rarest(tokens, ["b"], ["a", "b"], sizes, F.col("size") - share + 1)
    by_difference = shown.select(
        "b", F.col("a").alias("sid"), "rank", (~F.col("linked")).alias("open"), F.explode("listed").alias("token")
    ).select(F.xxhash64("b", "token").alias("key"), "sid", "rank", "open")
    return far.unionByName(by_difference)


def larger_helpers(found: DataFrame, join: Join) -> DataFrame:
    """(a, b) links between a set just not linked to its leader and a larger set that is.

    They need not share a difference. Of the leader's sets only the one with the most room matters:
    all of them are connected.
    """
    p, q = 100 + join.percent, 100 - join.percent
    room = F.col("size_a") * q - F.col("apart") * p
    best = found.where("linked").groupBy("b").agg(F.max(F.struct(room.alias("room"), F.col("a").alias("helper"))).alias("h"))
    return found.where("NOT linked").join(best, "b").where(room + F.col("h.room") >= 0).select("a", F.col("h.helper").alias("b"))


def set_links(lists: DataFrame, sets: Sets, join: Join) -> DataFrame | None:
    """(a, b) links that connect all linked sets; ``lists`` has (key, sid, rank, open)."""
    links, turn = None, 1
    while True:
        # The leader is the open set of least rank: the one most like the others.
        heads = lists.groupBy("key").agg(
            F.min_by(F.when(F.col("open"), F.col("sid")), F.when(F.col("open"), F.col("rank"))).alias("b"), F.count("*").alias("n")
        ).where("n > 1 AND b IS NOT NULL").drop("n")
        led = materialize(lists.join(heads, "key"), "set-lists")
        if led.isEmpty():
            return links
        # Few are far from their first leader. From the second on their differences are looked at all the same.
        found = compare(led.where("sid <> b").select(F.col("sid").alias("a"), "b"), sets, join, every=turn > 1)
        near = near_members(found)
        few = (F.col("n") <= MEMBERS * turn) & (F.col("differences") <= DIFFERENCES * turn)
        many = near.where(~few).drop("n", "differences")
        helped = larger_helpers(found.join(many.select("b").distinct(), "b", "left_semi"), join)
        linked = found.where("linked").select("a", "b").unionByName(member_links(near.where(few), join)).unionByName(helped)
        links = linked if links is None else links.unionByName(linked)
        lists, turn = next_lists(led, found, many, join, every=turn > 1), turn + 1


def jaccard_components(docs: DataFrame, width: int = 3, percent: int = 90) -> DataFrame:
    """Per row of ``docs`` (doc_id integer, text): doc_id, version, n_shingles, component_id, group.

    Texts with equal sets are one set of the join. A text without words has an empty set and links with
    nothing. ``component_id`` is the smallest doc_id reachable; a null doc_id takes part and
    never is the smallest. Repeated rows get equal answers. ``version`` is a hash of the text,
    ``group`` names the component, null for a text without words.
    """
    join = Join(width, percent)
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("version"))
    profile = profiles(docs, join)
    lists = shortest(agreeing(part_keys(docs, join)))
    # A set that agrees with others on many parts is like them in most places.
    ranks = materialize(lists.groupBy("sid").agg((-F.count("*")).alias("rank")), "set-ranks")
    places = profile.join(ranks.select("sid"), "sid", "left_semi")
    places = places.groupBy("sid").agg(F.min("version").alias("version"), F.min_by("doc_id", "version").alias("doc_id"))
    places = materialize(places.select("sid", "doc_id", "version"), "set-texts")
    lists = lists.join(ranks, "sid").select("key", "sid", "rank", F.lit(True).alias("open"))
    links = set_links(lists, Sets(docs, places, join), join)
    if links is None:
        links = lists.select(F.col("sid").alias("a"), F.col("sid").alias("b")).limit(0)
    nodes = components(links, "a", "b")
    with_words = profile.where("n_shingles > 0").join(nodes, F.col("sid") == F.col("node"), "left")
    with_words = with_words.select("doc_id", "version", "n_shingles", F.coalesce("component", "sid").alias("component"))
    smallest = with_words.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    joined = with_words.join(smallest, "component").select(
        "doc_id", "version", "n_shingles", "component_id", F.col("component").alias("group")
    )
    alone = profile.where("n_shingles = 0").select("doc_id", "version", "n_shingles", F.col("doc_id").alias("component_id"))
    return joined.unionByName(alone.withColumn("group", F.lit(None).cast("long")))


def one_per_group(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of every component the one of smallest doc_id
    stays, null ids last; of repeated rows one. Texts without words all stay."""
    marked = jaccard_components(docs, width, percent)
    order = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "version")
    kept = marked.where("group IS NOT NULL").groupBy("group").agg(F.min(order).alias("k"))
    kept = materialize(kept.select(F.col("k.doc_id").alias("_doc"), F.col("k.version").alias("_version")), "kept-sets")
    empty = marked.where("group IS NULL").select(F.col("version").alias("_version")).distinct()
    keyed = docs.withColumn("_key", F.xxhash64("text"))
    stays = keyed.join(kept, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_key") == F.col("_version")), "left_semi")
    stays = stays.dropDuplicates(["doc_id", "_key"])
    wordless = keyed.join(empty, F.col("_key") == F.col("_version"), "left_semi")
    return stays.unionByName(wordless).select(*docs.columns)
