import math
import random

import pytest
from pyspark.sql import functions as F

from lakestrata.llm import mixing


def made(spark, n=800, seed=2):
    """Domains that some words tell; rows carry their own domain as ``kind``."""
    rng = random.Random(seed)
    docs, labels = [], []
    for key in range(n):
        kind = rng.choice(["clean"] * 6 + ["poor"] * 3 + ["toxic"])
        words = ["".join(rng.choices("abcdefghijkl", k=2)) for _ in range(rng.randint(20, 80))]
        words += {"clean": [], "poor": ["###", "%%%"] * 4, "toxic": ["vile", "foul"]}[kind]
        rng.shuffle(words)
        docs.append((key, " ".join(words), kind))
        labels.append((key, int(kind != "poor"), int(kind == "toxic")))
    return (
        spark.createDataFrame(docs, "doc_id long, text string, kind string"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


def totals(rows):
    return {d: sum(r["n_tokens"] * r["rate"] * r[f"p_{d}"] for r in rows) for d in mixing.DOMAINS}


@pytest.mark.parametrize("targets", [{"clean": 0.9, "poor": 0.1}, {"clean": 0.5, "poor": 0.4, "toxic": 0.1}])
def test_expected_totals_meet_the_targets(spark, targets):
    docs, labels = made(spark)
    rows = mixing.mix_to_targets(docs, labels.where("doc_id < 500"), targets).collect()
    assert len(rows) == 800 and all(0 <= r["rate"] <= 1 for r in rows)
    assert all(math.isclose(sum(r[f"p_{d}"] for d in mixing.DOMAINS), 1.0, abs_tol=1e-9) for r in rows)
    right = sum(r[f"p_{r['kind']}"] > 0.5 for r in rows if r["doc_id"] >= 500)
    assert right >= 0.97 * 300
    found = totals(rows)
    size = sum(found.values())
    for domain in mixing.DOMAINS:
        assert abs(found[domain] / size - targets.get(domain, 0.0)) < 0.02


def test_rates_match_a_plain_loop(spark):
    docs, labels = made(spark, 300)
    rows = mixing.rated_members(docs, labels).collect()
    share = {d: [r[f"p_{d}"] for r in rows] for d in mixing.DOMAINS}
    size, rate = [r["n_tokens"] for r in rows], [1.0] * len(rows)
    have = {d: sum(n * p for n, p in zip(size, share[d])) for d in share}
    total = sum(have.values())
    scale = min(have[d] / w for d, w in mixing.TARGETS.items() if w)
    now = dict(have)
    for _ in range(mixing.STEPS):
        gap = {d: (now[d] - scale * mixing.TARGETS[d]) / max(have[d], 1e-9) for d in have}
        rate = [min(1.0, max(0.0, r - mixing.STEP * sum(share[d][i] * gap[d] for d in have))) for i, r in enumerate(rate)]
        last, now = now, {d: sum(n * r * p for n, r, p in zip(size, rate, share[d])) for d in have}
        if max(abs(now[d] - last[d]) for d in have) <= mixing.CLOSE * total:
            break
    assert all(math.isclose(r["rate"], x, abs_tol=1e-6) for r, x in zip(rows, rate))


def test_odd_input(spark):
    docs, labels = made(spark, 200)
    odd = spark.createDataFrame(
        [(None, "vile foul", "x"), (900, None, "x"), (901, "", "x"), (901, "", "x"), (902, "a " * 50_000, "x")],
        "doc_id long, text string, kind string",
    )
    doubled = labels.union(labels.selectExpr("doc_id", "NULL", "toxic")).union(labels.selectExpr("NULL", "quality", "toxic"))
    rows = mixing.mix_to_targets(docs.union(odd), doubled).where("doc_id IS NULL OR doc_id >= 900").collect()
    assert len(rows) == 5 and all(r["rate"] is not None for r in rows)
    by_id = {r["doc_id"]: r for r in rows}
    assert (by_id[900]["n_tokens"], by_id[901]["n_tokens"], by_id[902]["n_tokens"]) == (0, 0, 50_000)
    assert by_id[None]["p_toxic"] > 0.5 and by_id[900]["p_clean"] == by_id[901]["p_clean"]
    assert mixing.mix_to_targets(docs.limit(0), labels).collect() == []
    for clash in ("rate", "n_tokens", "p_clean"):
        with pytest.raises(ValueError):
            mixing.mix_to_targets(docs.withColumnRenamed("kind", clash), labels)
    with pytest.raises(ValueError):
        mixing.mix_to_targets(docs, labels, {"clean": 0.5})


@pytest.mark.parametrize("where", ["false", "toxic = 1", "quality IS NULL"])
def test_labels_that_teach_nothing(spark, where):
    docs, labels = made(spark, 60)
    assert mixing.mix_to_targets(docs, labels.where(where)).count() == 60


def test_only_built_in_functions_run(spark):
    docs, labels = made(spark, 100)
    plan = mixing.mix_to_targets(docs, labels)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert docs.select(mixing.words(F.lit("A\n b  c")).alias("w")).first()["w"] == ["a", "b", "c"]


@pytest.mark.parametrize("poor", [0.01, 0.0])
def test_clean_texts_stay_when_another_domain_is_scarce(spark, caplog, poor):
    docs, labels = made(spark, 2000)
    kinds = docs.where(f"kind <> 'poor' OR pmod(xxhash64(doc_id), 1000) < {1000 * poor * 3}")
    found = mixing.mix_to_targets(kinds, labels.join(kinds, "doc_id", "left_semi"))
    rows = found.collect()
    rates = {k: [r["rate"] for r in rows if r["kind"] == k] for k in ("clean", "poor", "toxic")}
    assert sum(rates["clean"]) >= 0.98 * len(rates["clean"])
    assert sum(rates["toxic"]) <= 0.1 * len(rates["toxic"])
    assert poor == 0 or sum(rates["poor"]) >= 0.9 * len(rates["poor"]) > 0
    report = {r["domain"]: r for r in mixing.domain_totals(found).collect()}
    assert report["poor"]["missing"] > 0 and report["clean"]["missing"] == 0
    assert "poor falls short" in caplog.text


def test_goals():
    wanted = [0.95, 0.05, 0.0]
    assert mixing.goals([95.0, 50.0, 5.0], wanted, "clean") == [95.0, 5.0, 0.0]
    assert mixing.goals([95.0, 1.0, 5.0], wanted, "clean") == [95.0, 1.0, 0.0]
    assert mixing.goals([95.0, 1.0, 5.0], wanted, None) == [19.0, 1.0, 0.0]
    assert mixing.goals([95.0, 0.1, 5.0], wanted, None, ("clean", "toxic")) == [95.0, 0.1, 0.0]
    assert mixing.goals([0.1, 50.0, 5.0], wanted, "clean", ("poor", "toxic")) == [0.1, 50.0, 0.0]


def test_labels_of_absent_documents_do_not_use_up_the_bound(spark):
    docs = [(n, "good words here" if n % 4 else "bad stuff there") for n in range(60)]
    docs += [(1, "good words here")] * 200  # repeated rows count once
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame(
        [(n, int(n % 4 > 0), 0) for n in range(5000)], "doc_id long, quality int, toxic int"
    )
    few = mixing.fit_domains(docs, labels, 60)
    assert few == mixing.fit_domains(docs, labels) and few.known
