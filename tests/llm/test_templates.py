import pytest
from pyspark.sql import functions as F

from lakestrata.llm import templates
from lakestrata.llm.queries import QUERIES, read

QUESTION = (
    "A farmer named Alice Brown walks 12 km to the market every morning. If Alice buys 30 apples and sells "
    "12 of them before noon, how many apples does Alice carry home?"
)
OTHER = QUESTION.replace("Alice", "Robert").replace("Brown", "Green").replace("12", "45").replace("30", "99").replace("km", "miles")
MIXED = QUESTION.replace("buys 30", "buys 31").replace("sells 12", "sells 13")  # 12 is once 12 and once 13


def marked(spark, docs, benchmark):
    docs = spark.createDataFrame(docs, "doc_id long, text string, item_id int").drop("item_id")
    benchmark = spark.createDataFrame(benchmark, "item_id long, text string, width int")
    return {(r["doc_id"], r["text"]): r for r in templates.contamination(docs, benchmark).collect()}


def forms(spark, text):
    parts = templates.canonical(templates.tokens(F.lit(text)))
    return [p["form"] for p in spark.range(1).select(parts.alias("p")).first()["p"]]


def test_placeholders(spark):
    assert forms(spark, "Paris is where Anna ran 3,5 km. Then $4 (5%) for Bob's dog, 7 km/h") == [
        "paris", "is", "where", "<name>", "ran", "<number>", "<unit>", "then", "<number>", "<number>", "for", "<name>",
        "dog", "<number>", "km/h",
    ]
    assert forms(spark, "a km Élodie x\nYes") == ["a", "km", "<name>", "x", "<name>"]


def test_copies_and_questions_with_other_parameters(spark):
    filler = "Some words that stand around the question and have nothing to do with it at all. "
    docs = [
        (1, filler + QUESTION + " " + filler, 0), (2, OTHER, 0), (3, filler * 4, 0), (4, QUESTION.lower(), 0),
        (5, filler + QUESTION.replace(" ", "\n\t"), 0), (6, " ".join(QUESTION.split()[:12]), 0),
    ]
    found = marked(spark, docs, [(7, QUESTION, 0), (8, "unrelated words make up this other item here", 0)])
    verdict = {k[0]: (r["contaminated"], r["item_id"]) for k, r in found.items()}
    assert verdict[1] == verdict[2] == verdict[5] == (True, 7)
    assert verdict[3] == (False, None) and verdict[6] == (False, None)
    share = {k[0]: r["share"] for k, r in found.items()}
    # Windows that begin with one of the four names keep it as a literal.
    assert share[1] == share[5] == 1.0 and share[2] == 21 / 25


def test_slots_must_be_consistent(spark):
    item = "there are 12 red stones and 12 blue stones in the old wooden box"
    docs = [(1, item.replace("12", "7"), 0), (2, item.replace("12", "7", 1), 0), (3, item, 0)]
    found = marked(spark, docs, [(1, item, 0)])
    assert {k[0]: r["contaminated"] for k, r in found.items()} == {1: True, 2: False, 3: True}


def test_odd_input(spark):
    docs = [(1, None, 0), (2, "", 0), (3, "word " * 30_000 + QUESTION, 0), (4, QUESTION, 0), (4, QUESTION, 0), (None, QUESTION, 0), (4, "clean", 0), (5, "short item text", 0)]
    items = [(None, QUESTION, 0), (1, None, 0), (2, "", 0), (3, "short item text", 0), (4, QUESTION, 0), (4, QUESTION, 0), (5, QUESTION, 0), (6, "12 13 14 15", 0)]
    found = marked(spark, docs, items)
    assert {k: (r["contaminated"], r["item_id"], r["n_items"]) for k, r in found.items()} == {
        (1, None): (False, None, 0), (2, ""): (False, None, 0), (3, docs[2][1]): (True, 4, 2), (4, QUESTION): (True, 4, 2),
        (None, QUESTION): (True, 4, 2), (4, "clean"): (False, None, 0), (5, "short item text"): (True, 3, 1),
    }
    frame = spark.createDataFrame(docs, "doc_id long, text string, width int")
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert templates.contamination(frame, nothing).where("contaminated").count() == 0
    assert templates.contamination(frame, spark.createDataFrame(items, "item_id long, text string, x int")).count() == len(docs)
    assert templates.contamination(frame.limit(0), nothing).collect() == []
    with pytest.raises(ValueError):
        templates.contamination(frame.withColumnRenamed("width", "share"), nothing)


def test_the_shuffled_join_gives_the_same(spark, monkeypatch):
    docs, items = read(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text"), read(spark, "/root/testdata/sf0.001", "benchmark")
    first = sorted(map(tuple, templates.contamination(docs, items).drop("text").collect()))
    monkeypatch.setattr(templates, "BROADCAST_WINDOWS", 0)
    assert sorted(map(tuple, templates.contamination(docs, items).drop("text").collect())) == first


def test_verbatim_items_of_the_supplied_texts(spark):
    folder = "/root/testdata/sf0.01"
    plain = lambda t: " ".join((t or "").split())
    items = [plain(r["text"]) for r in read(spark, folder, "benchmark").collect()]
    wanted = {r["doc_id"] for r in read(spark, folder, "documents").collect() if any(i in plain(r["text"]) for i in items)}
    query = QUERIES["op3_template_decontamination"](spark, folder)
    assert wanted and {r["doc_id"] for r in query.where("contaminated").collect()} == wanted
    plan = query._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_edited_and_partial_passages(spark):
    words = [a + b for a in ("lum", "tor", "vex", "qui", "bal") for b in ("an", "ed", "ol", "ip", "ur", "est", "ami", "ock")][:38]
    item, edited = " ".join(words), [*words]
    edited[12] = edited[25] = "changed"
    short = [w[::-1] for w in words[:16]]
    one = [*short[:8], "changed", *short[9:]]
    docs = [
        (1, " ".join(edited), 0), (2, "before it " + " ".join(words[:20]), 0), (3, " ".join(words[:12]), 0),
        (4, " ".join(one), 0), (5, " ".join(words[20:33]), 0),
    ]
    found = marked(spark, docs, [(1, item, 0), (2, " ".join(short), 0)])
    assert {k[0]: r["item_id"] for k, r in found.items()} == {1: 1, 2: 1, 3: None, 4: 2, 5: 1}
