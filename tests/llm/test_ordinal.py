import random

import pytest

from lakestrata.llm import ordinal
from lakestrata.llm.queries import QUERIES, read

SMALL = "/root/testdata/sf0.1"


def made(spark, n=600, seed=1):
    rng = random.Random(seed)
    docs, labels = [], []
    for key in range(n):
        words = ["".join(rng.choices("abcdefgh", k=2)) for _ in range(rng.randint(5, 200))]
        hits = rng.choice([0, 0, 0, 1, 2, 6])
        for _ in range(hits):
            words.insert(rng.randrange(len(words)), rng.choice(["vile,", "Nasty", "foul!"]))
        docs.append((key, " ".join(words), hits))
        labels.append((key, int(hits > 0)))
    return (
        spark.createDataFrame(docs, "doc_id long, text string, hits int"),
        spark.createDataFrame(labels, "doc_id long, toxic int"),
    )


def test_grades_of_made_texts(spark):
    docs, labels = made(spark)
    model = ordinal.fit_severity(docs, labels.where("doc_id < 400"))
    assert (model.thresholds[1:] > model.thresholds[:-1]).all()
    rows = ordinal.score_severity(docs, model).collect()
    assert all(r["toxic"] == (r["hits"] > 0) for r in rows if r["doc_id"] >= 400)
    mean = lambda k: sum(r["severity"] for r in rows if r["hits"] == k) / sum(r["hits"] == k for r in rows)
    assert mean(0) < 0.2 < mean(1) < mean(2) < mean(6)
    assert all(0 <= r["severity"] <= 2 and 0 <= r["grade"] <= 2 for r in rows)


def test_chances_fall_with_the_grade():
    import numpy as np

    model = ordinal.SeverityModel(np.empty(0, np.int64), np.empty(0), np.array([-1.0, 2.0]))
    above = model.chances(np.linspace(-5, 5, 20))
    assert (above[:, 0] > above[:, 1]).all() and (np.diff(above, axis=0) > 0).all()


def test_held_out_labels_of_the_supplied_texts(spark):
    docs, labels = read(spark, SMALL, "documents"), read(spark, SMALL, "labels")
    model = ordinal.fit_severity(docs, labels.where("doc_id % 4 <> 0"))
    scored = ordinal.score_severity(docs, model, ["doc_id"]).join(labels.withColumnRenamed("toxic", "wanted"), "doc_id")
    rows = scored.where("doc_id % 4 = 0").collect()
    wanted = [r for r in rows if r["wanted"]]
    assert sum(r["toxic"] for r in wanted) >= 0.9 * len(wanted) > 0
    assert sum(r["toxic"] for r in rows if not r["wanted"]) <= 0.02 * len(rows)


def test_odd_input(spark):
    docs, labels = made(spark, 200)
    model = ordinal.fit_severity(docs, labels)
    rows = [(1, None), (2, ""), (2, ""), (None, "vile nasty foul"), (3, "vile " * 30_000), (4, "…!!")]
    found = ordinal.score_severity(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()
    assert [r["toxic"] for r in sorted(found, key=str)] == [r["toxic"] for r in sorted(found, key=str)]
    by_id = {r["doc_id"]: r for r in found}
    assert not by_id[1]["toxic"] and not by_id[2]["toxic"] and not by_id[4]["toxic"] and by_id[None]["toxic"] and by_id[3]["toxic"]
    assert by_id[1]["severity"] == by_id[2]["severity"] == by_id[4]["severity"]
    assert ordinal.score_severity(docs.limit(0), model).collect() == []
    with pytest.raises(ValueError):
        ordinal.score_severity(docs.withColumnRenamed("hits", "grade"), model)


@pytest.mark.parametrize("where", ["toxic = 0", "toxic = 1", "doc_id < 0", "toxic IS NULL"])
def test_labels_that_teach_nothing(spark, where):
    docs, labels = made(spark, 100)
    labels = labels.selectExpr("doc_id", "toxic").where(where)
    rows = ordinal.score_severity(docs, ordinal.fit_severity(docs, labels)).collect()
    assert len(rows) == 100 and not any(r["toxic"] for r in rows)


def test_contradicting_and_null_labels(spark):
    docs, labels = made(spark)
    doubled = labels.union(labels.selectExpr("doc_id", "0")).union(labels.selectExpr("NULL", "toxic")).union(labels.selectExpr("doc_id", "NULL"))
    rows = ordinal.score_severity(docs, ordinal.fit_severity(docs, doubled)).collect()
    assert all(r["toxic"] == (r["hits"] > 0) for r in rows)


def test_the_sample_is_bounded(spark):
    docs, labels = made(spark)
    assert ordinal.labelled_sample(docs, labels, 50).count() == 50


def test_every_document_is_returned(spark):
    assert QUERIES["op10_ordinal_severity"](spark, "/root/testdata/sf0.001").count() == read(spark, "/root/testdata/sf0.001", "documents").count()


def test_sample_is_bounded_after_labels_meet_documents(spark):
    docs = spark.createDataFrame([(7, f"text {n}") for n in range(300)] + [(8, "b"), (9, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(n, n % 2) for n in range(7, 3000)] + [(8, 1), (None, 1)], "doc_id long, toxic int")
    for rows in (1, 2, 3, 50):
        found = ordinal.labelled_sample(docs, labels, rows).collect()
        assert len(found) == min(rows, 3)
    assert sum(r["toxic"] for r in found) == 3
