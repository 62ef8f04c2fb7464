import corpus_pipeline

from conftest import SF_SMALL
from seriesrel.llm import bagminhash, exact, spaced_seeds


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, kept = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = kept, stage(spark, kept, SF_SMALL).cache()
        assert kept.columns == columns and kept.subtract(before).isEmpty(), name
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    good = docs.join(labels.where("quality = 1"), "doc_id")
    passed = corpus_pipeline.keep_quality(spark, docs, SF_SMALL)
    assert good.join(passed, "doc_id", "left_semi").count() >= 0.98 * good.count()
    assert exact.exact_dedup(kept).where("NOT kept").isEmpty()
    assert bagminhash.near_classes(kept).where("doc_id <> class_id").isEmpty()
    assert spaced_seeds.decontaminate(kept, spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")).isEmpty()
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert sorted(r.doc_id for r in out.collect()) == sorted(r.doc_id for r in kept.collect())
    assert out.where("n_tokens <> length(token_ids) / 4").isEmpty()


def test_registered():
    import __spark_entry__ as e
    assert {q.split("_")[0] for q in e.LLM_QUERIES} == {"pipeline", *(f"op{n}" for n in range(1, 14))}


def test_odd_tables(spark, tmp_path):
    """Null ids, repeated rows, texts without words, extra columns that clash, and an empty table."""
    from pyspark.sql import functions as F
    odd = [(None, "", "en"), (1, None, "en"), (1, None, "en"), (2, "!!!", None), (3, "one two three", "en"), (3, "other words here", "en"), (None, "null id", "en")]
    docs = spark.createDataFrame([(i, t, lang, "s", 0) for i, t, lang in odd], "doc_id long, text string, lang string, source string, n_chars long")
    extra = docs.withColumns({c: F.lit(1) for c in ("_gone", "_bad", "_id", "_sha", "digest", "_doc_id", "ids", "score", "label")})
    for name, table in (("odd", extra), ("empty", docs.limit(0))):
        folder = f"{tmp_path}/{name}"
        table.write.parquet(f"{folder}/documents.parquet")
        for other in ("labels", "benchmark"):
            spark.read.parquet(f"{SF_SMALL}/{other}.parquet").write.parquet(f"{folder}/{other}.parquet")
        kept = spark.read.parquet(f"{folder}/documents.parquet")
        for stage, function in corpus_pipeline.STAGES[1:-1]:
            kept = function(spark, kept, folder).cache()
            assert kept.columns == table.columns, stage
        out = corpus_pipeline.encode_documents(spark, kept, folder)
        assert out.count() == kept.count() == (0 if name == "empty" else 5)
