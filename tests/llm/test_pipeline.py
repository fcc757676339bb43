import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lakestrata.layout import materialize
from lakestrata.llm import mixing, ordinal, set_join, templates, token_files
from lakestrata.llm.queries import QUERIES, read

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Documents before and after every stage."""
    docs, out = read(spark, SMALL, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        after = materialize(stage(spark, docs, SMALL), "stage")
        out.append((name, docs, after))
        docs = after
    return out


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_columns_and_order(stages):
    assert [name for name, _, _ in stages] == ["toxicity", "near copies", "decontamination", "mixing", "tokens"]
    columns = stages[0][1].columns
    assert all(after.columns == columns for _, _, after in stages[:-1])


def test_decisions_take_effect(spark, stages):
    toxicity, copies, decontamination, mix, tokens = stages
    scored = ordinal.score_severity(toxicity[1], ordinal.fit_severity(toxicity[1], read(spark, SMALL, "labels")))
    assert ids(toxicity[2]) == ids(scored.where("NOT toxic"))
    joined = set_join.jaccard_components(copies[1], 5, 80)
    assert ids(copies[2]) == ids(joined.where("doc_id = component_id"))
    marked = templates.contamination(decontamination[1], read(spark, SMALL, "benchmark"))
    assert ids(decontamination[2]) == ids(marked.where("NOT contaminated")) != ids(decontamination[1])
    rated = mixing.mix_to_targets(mix[1], read(spark, SMALL, "labels"))
    assert set(ids(rated.where("rate >= 1"))) <= set(ids(mix[2]))
    assert not set(ids(rated.where("rate <= 0"))) & set(ids(mix[2]))
    assert ids(tokens[2]) == ids(mix[2])
    assert tokens[2].columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_clean_labelled_documents_stay(spark, stages):
    labels = read(spark, SMALL, "labels").where("quality = 1 AND toxic = 0")
    for name, before, after in (stages[0], stages[3]):
        clean = before.join(labels, "doc_id", "left_semi")
        assert clean.join(after, "doc_id", "left_anti").count() <= 0.02 * clean.count(), name


def test_run_and_empty_table(spark, stages, tmp_path):
    whole = corpus_pipeline.run(spark, SMALL)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, stages[-1][2].collect()))
    for table in ("labels", "benchmark"):
        read(spark, SMALL, table).write.parquet(f"{tmp_path}/{table}.parquet")
    docs = read(spark, SMALL, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.collect() == []


def test_nulls_and_repeats_pass_every_stage(spark):
    docs = read(spark, SMALL, "documents").limit(50)
    odd = docs.limit(1).select(*[F.lit(None).cast(t).alias(c) for c, t in docs.dtypes])
    docs = materialize(docs.union(odd).union(odd).union(docs.limit(3)), "odd")
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SMALL), "stage")
        assert docs.count() > 0, name


def test_registered():
    import __spark_entry__ as entry

    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))
    assert token_files.MAGIC == b"LSTOKEN1"
