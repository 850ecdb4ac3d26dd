import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from conftest import DOCS, SF0001  # noqa: I001


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    out = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "t")
        stage(spark, docs, SF0001).write.parquet(path)
        docs = out[name] = spark.read.parquet(path)
    return out


def test_columns(steps):
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert steps[name].columns == steps["documents"].columns


def test_quality_keeps_clean_documents(spark, steps):
    labels = spark.read.parquet(f"{SF0001}/labels.parquet")
    kept = steps["quality"].select("doc_id")
    good = labels.filter("quality = 1")
    assert good.join(kept, "doc_id").count() >= 0.95 * good.count()
    assert labels.filter("quality = 0").join(kept, "doc_id").count() <= 2


def test_one_of_each_group_stays(steps):
    from test_dedup import brute

    docs = [(r.doc_id, r.text) for r in steps["quality"].collect()]
    assert sorted(r.doc_id for r in steps["near_duplicates"].collect()) == [d for d, _, _, kept in brute(docs, 5) if kept]


def test_personal_data_is_gone(steps):
    before, after = steps["near_duplicates"], steps["pii"]
    at = F.col("text").rlike("[a-z0-9]@[a-z]")
    assert before.filter(at).count() > 0 and after.filter(at).count() == 0
    assert after.filter(F.length("text") != F.col("n_chars")).count() == 0 and before.count() == after.count()


def test_mix_and_pack(steps):
    from kpimart.llm.mixing import words

    mixed = steps["mix"].groupBy("doc_id").count()
    assert mixed.agg(F.max("count")).first()[0] <= 2
    total = lambda df: df.agg(F.sum(words(F.col("text")))).first()[0]
    assert total(steps["mix"]) == pytest.approx(1.5 * total(steps["pii"]), rel=0.05)
    pieces = steps["pack"]
    assert pieces.filter("start = 0").count() == steps["mix"].count()
    assert pieces.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 2048").count() == 0


def test_edges(spark):
    rows = [(1, None, None, None, None), (None, "a b c.", "en", "s", 5), (2, "a b c.", "en", "s", 5), (2, "a b c.", "en", "s", 5),
            (3, "", "en", "s", 0), (4, "long words here. " * 5000, "en", "t", 1)]
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 as mark", "'x' as found", "2 as copies", "3 as n", "4 as item",
                                                     "5 as lead_id", "6 as lead_mark", "7 as row")
    for given in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            got = stage(spark, given, SF0001)
            got.collect()
            assert name == "pack" or got.columns == docs.columns
    assert corpus_pipeline.drop_near_duplicates(spark, docs, SF0001).count() == 4


def test_documents_without_words_pass_the_mix(spark):
    rows = [(1, "some words here", "en", "a", 15), (2, "other words there", "en", "a", 17), (3, "  ", "en", "a", 2), (4, None, "en", "a", 0)]
    docs = spark.createDataFrame(rows, DOCS)
    assert {r.doc_id for r in corpus_pipeline.mix(spark, docs, SF0001).collect()} == {1, 2, 3, 4}


def test_equal_rows_with_other_columns_keep_the_same_one(spark):
    rows = [(1, "a b c d e f g", lang, source, n) for n, (lang, source) in enumerate([("en", "x"), ("de", "y"), (None, None), ("fr", "z")])]
    docs = spark.createDataFrame(rows, DOCS)
    kept = [corpus_pipeline.drop_near_duplicates(spark, docs.repartition(n, "n_chars").orderBy(order), SF0001).collect()
            for n, order in ((1, "n_chars"), (3, F.desc("n_chars")))]
    assert len(kept[0]) == 1 and kept[0] == kept[1] and tuple(kept[0][0]) in rows
