"""The corpus pipeline, stage by stage, and the registered queries."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline as P
from lodestone.llm import quality_classifier
from tests.llm import brute
from tests.llm.conftest import edge_rows, make, prose

SF = "/root/testdata/sf0.001"
OPS = sorted(n for n in E.queries() if n.startswith("op"))


def test_all_queries_are_there():
    assert {n.split("_")[0] for n in OPS} == {f"op{k}" for k in range(1, 14)} and "pipeline" in E.queries()


@pytest.mark.parametrize("name", OPS)
def test_one_row_per_document(spark, name):
    df = E.queries()[name](spark, SF)
    if name.startswith("op10"):
        ids = {r[0] for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id").collect()} | {-7}
        assert {r["conv_id"] for r in df.collect()} == ids
    elif name.startswith("op11"):
        groups = {tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("lang", "source").distinct().collect()}
        assert {(r["lang"], r["source"]) for r in df.where("part = 'pair'").collect()} == groups
    elif name.startswith("op12"):
        sums = df.groupBy("doc_id", "doc_tokens").agg(F.sum("length").alias("n"))
        assert sums.where("n = doc_tokens").count() == sums.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    else:
        ids = sorted(r[0] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect())
        assert sorted(r["doc_id"] for r in df.select("doc_id").collect()) == ids


def rows(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_stages_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(P.STAGES)
    assert list(stages) == ["quality_classifier", "line_dedup", "near_dedup", "decontamination", "mixing"]
    columns = docs.columns
    d = stages["quality_classifier"](spark, docs, SF).cache()
    model = quality_classifier.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    low = quality_classifier.score(docs, model, "s").where("s < 0.5").select("doc_id")
    assert d.columns == columns and sorted(rows(d)) == sorted(rows(docs.join(low, "doc_id", "left_anti")))
    labels = spark.read.parquet(f"{SF}/labels.parquet").join(docs.select("doc_id"), "doc_id")
    kept = labels.join(d.select("doc_id", F.lit(1).alias("k")), "doc_id", "left").groupBy("quality").agg(F.avg(F.coalesce("k", F.lit(0))).alias("k")).collect()
    assert all(r["k"] >= 0.95 if r["quality"] else r["k"] <= 0.05 for r in kept)

    before = rows(d)
    d = stages["line_dedup"](spark, d, SF).cache()
    want = {i: h for i, _, _, h in brute.lines(before)}
    assert d.columns == columns and {i: brute.sha(t or "") for i, t in rows(d)} == want

    before = rows(d)
    d = stages["near_dedup"](spark, d, SF).cache()
    assert d.columns == columns and sorted(i for i, _ in rows(d)) == sorted(i for i, _, _, k in brute.near(before, 5) if k)

    before = rows(d)
    d = stages["decontamination"](spark, d, SF).cache()
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert d.columns == columns and sorted(i for i, _ in rows(d)) == sorted(r[0] for r in brute.contaminated(before, items) if not r[5])

    out = stages["mixing"](spark, d, SF)
    per = {r["source"]: r["n"] for r in out.groupBy("source").agg(F.sum("mix_words").alias("n")).collect()}
    sizes = {}
    for r in d.collect():
        sizes[r["source"]] = sizes.get(r["source"], 0) + len(brute.words(r["text"]))
    from tests.llm.test_native import water_fill
    assert all(abs(per.get(s, 0) - t) <= 1 for s, t in water_fill(sizes).items())


def test_one_document_of_each_class_stays(spark):
    """Near copies that share one id, or have none, and copies of one text under several ids."""
    one, two = prose(31, 100), prose(32, 100)
    docs = make(spark, [(1, one, "a"), (1, one + " tail", "a"), (None, two, "a"), (None, two + " tail", "b"), (3, one, "b"), (4, prose(33, 40), "b"), (4, prose(34, 40), "b")])
    out = dict(P.STAGES)["near_dedup"](spark, docs, SF)
    assert sorted((r["doc_id"] or 0) for r in out.collect()) == [0, 1, 4, 4]


def test_run_gives_what_the_stages_give(spark):
    out = P.run(spark, SF)
    assert out.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"] and out.count() > 0


def test_odd_rows_pass_the_stages(spark, nothing):
    docs = make(spark, edge_rows())
    for name, stage in P.STAGES[1:]:
        assert stage(spark, nothing, SF).count() == 0, name
        out = stage(spark, docs, SF)
        assert set(docs.columns) <= set(out.columns)
        if name != "mixing":
            # null and empty texts stay; rows repeated whole may be merged
            assert out.where("text is null or trim(text) = ''").count() >= 3, name
            assert out.count() >= len(edge_rows()) - 8, name
