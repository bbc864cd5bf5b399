"""Stages against what their operators say, on awkward rows, and the registration of the queries."""



from pyspark.sql import functions as F

import corpus_pipeline
from rankloom.llm import queries, toxicity
from rankloom.llm.near_copies import near_copies

TINY = "/root/testdata/sf0.001"


def folder(spark, docs, tmp_path):
    """A data folder with the tables that stages read beside the documents."""
    labels = docs.filter("doc_id is not null").select("doc_id", (F.col("doc_id") % 9 == 0).cast("int").alias("toxic"))
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    item = docs.filter("doc_id = 6").select(F.lit(1).alias("item_id"), "text")
    item.write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_stages_keep_columns_and_decide(spark, docs, tmp_path):
    sf_dir, rows = folder(spark, docs, tmp_path), docs
    for name, step in corpus_pipeline.STAGES[:-1]:
        out = step(spark, rows, sf_dir).cache()
        assert out.schema.names == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema], name
        before, after = rows.count(), out.count()
        if name == "near copies":
            classes = near_copies(rows)
            named = classes.filter("class_id is not null").select("class_id").distinct().count()
            unnamed = classes.filter("class_id is null").select("text_key").distinct().count()
            assert after == named + unnamed
            assert near_copies(out).filter("n_links > 0").count() == 0
        elif name == "decontamination":
            assert out.filter("doc_id = 6").count() == 0 and after < before
        elif name == "personal data":
            assert after == before and out.filter("text like '%@%'").count() == 0 and out.filter("text like '%[EMAIL]%'").count() == 1
            assert out.filter("n_chars <> length(text)").count() == 0
        rows = out
    assert corpus_pipeline.STAGES[-1][1](spark, rows, sf_dir).select("doc_id").distinct().count() == rows.select("doc_id").distinct().count()


def test_stages_of_nothing(spark, docs, no_docs, tmp_path):
    sf_dir = folder(spark, docs, tmp_path)
    for _, step in corpus_pipeline.STAGES:
        assert step(spark, no_docs, sf_dir).count() == 0


def test_toxic_documents_go(spark):
    docs = spark.read.parquet(f"{TINY}/documents.parquet")
    kept = corpus_pipeline.drop_toxic(spark, docs, TINY)
    scored = toxicity.score_toxicity(docs, toxicity.fit(docs, spark.read.parquet(f"{TINY}/labels.parquet")))
    assert kept.count() == scored.filter(F.col("score") < toxicity.THRESHOLD).count()


def test_whole_pipeline(spark):
    pieces = corpus_pipeline.run(spark, TINY)
    assert pieces.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert pieces.filter("length < 1 or length > 4096").count() == 0 and pieces.count() > 0


def test_every_operator_is_registered():
    names = queries.load().QUERIES
    assert {int(n[2:].split("_")[0]) for n in names} == set(range(1, 14))

