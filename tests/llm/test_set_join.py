import random

import pytest

from lakestrata.llm import set_join


def shingle_set(text, width):
    words = (text or "").encode().lower().split()
    if len(words) < width:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(zip(*[words[n:] for n in range(width)]))


def brute_force(rows, width, percent):
    sets = [shingle_set(t, width) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    best = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            best[find(i)] = min(key, best.get(find(i), key))
    return [(k, len(s), best.get(find(i), k)) for i, ((k, _), s) in enumerate(zip(rows, sets))]


def family(rng, copies, length, most_edits, words="abcdefghij"):
    base = ["".join(rng.choices(words, k=4)) for _ in range(length)]
    out = []
    for _ in range(copies):
        text = list(base)
        for _ in range(rng.randint(0, most_edits)):
            kind, at = rng.randrange(3), rng.randrange(len(text))
            if kind == 0:
                text[at] = "".join(rng.choices(words, k=5))
            elif kind == 1:
                del text[at]
            else:
                text.insert(at, "".join(rng.choices(words, k=5)))
        out.append(" ".join(text))
    return out


def check(spark, rows, width=3, percent=90):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = set_join.jaccard_components(docs, width, percent).select("doc_id", "n_shingles", "component_id").collect()
    order = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted(map(tuple, found), key=order) == sorted(brute_force(rows, width, percent), key=order)


@pytest.mark.parametrize("seed,percent", [(1, 90), (2, 90), (3, 80)])
def test_families_of_near_copies(spark, seed, percent):
    rng = random.Random(seed)
    texts = family(rng, 150, 100, 14) + family(rng, 60, 60, 6) + family(rng, 40, 12, 2) + family(rng, 30, 300, 20)
    # A second family grown from a member of the first, and a passage that all of some others share.
    far = texts[5].split()
    texts += [" ".join(far[:60] + t.split()) for t in family(rng, 40, 40, 3)]
    shared = " ".join(family(rng, 1, 30, 0))
    texts += [shared + " " + t for t in family(rng, 1, 70, 0) + [x for _ in range(40) for x in family(rng, 1, 60, 0)]]
    texts += texts[:20]
    keys = list(range(len(texts)))
    rng.shuffle(keys)
    check(spark, list(zip(keys, texts)), 3, percent)


@pytest.mark.parametrize("limits", [{"MEMBERS": 30}, {"DIFFERENCES": 900}, {"OVERLAPS": 500}])
def test_leaders_of_too_many_members(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(set_join, name, value)
    rng = random.Random(5)
    check(spark, list(enumerate(family(rng, 120, 100, 14) + family(rng, 40, 40, 5))))


@pytest.mark.parametrize("width,percent", [(3, 90), (5, 80)])
def test_a_family_is_settled_in_few_rounds_without_its_pairs(spark, monkeypatch, width, percent):
    written = []

    def watched(df, name, plain=set_join.materialize):
        out = plain(df, name)
        written.append((name, out.count()))
        return out

    monkeypatch.setattr(set_join, "materialize", watched)
    rows = list(enumerate(family(random.Random(6), 400, 100, 30)))
    check(spark, rows, width, percent)
    assert [name for name, _ in written].count("set-lists") <= 3
    # A set has a leader in each of its lists at most.
    lists = max(n for name, n in written if name == "set-lists")
    assert all(n <= lists for name, n in written if name not in ("set-lists", "set-parts"))


def test_boundary_of_the_similarity(spark):
    words = [f"w{n}" for n in range(40)]
    # 36 of 40 shingles: 90 percent exactly; 35 of 39 below.
    rows = [(1, " ".join(words[:42])), (2, " ".join(words[:38])), (3, " ".join(["z", *words]))]
    check(spark, rows)
    check(spark, [(n, " ".join(words[: 12 + n])) for n in range(28)])


def test_odd_input(spark):
    rows = [
        (5, None), (6, ""), (7, " \n\t "), (8, "One"), (3, "one"), (4, "one two"), (2, "ONE\ttwo"), (9, "two one"),
        (None, "one two"), (None, "a b c d"), (10, "a b c d"), (10, "a b c d"), (11, "x " * 30_000), (12, "X " * 40_000),
        (13, "é É"), (14, "é é"),
    ]
    check(spark, rows)
    assert set_join.jaccard_components(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    with pytest.raises(ValueError):
        set_join.Join(3, 100)


def test_one_document_of_each_group_stays(spark):
    rng = random.Random(4)
    texts = family(rng, 20, 100, 1) + ["", None, "lone words here and there now"]
    rows = [(n + 1, t, f"s{n}") for n, t in enumerate(texts)] + [(1, texts[0], "again"), (None, texts[0], "none")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string")
    kept = set_join.one_per_group(docs)
    groups = {c for _, n, c in brute_force([(k, t) for k, t, _ in rows], 5, 80) if n}
    assert kept.columns == docs.columns
    found = [r["doc_id"] for r in kept.where("doc_id < 21 OR doc_id = 23").collect()]
    assert sorted(found) == sorted(groups)
    assert kept.where("doc_id IN (21, 22)").count() == 2
