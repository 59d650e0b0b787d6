import corpus_pipeline
import __spark_entry__ as contract

FOLDER = "/root/testdata/sf0.001"


def test_every_operator_and_the_pipeline_are_registered():
    names = contract.queries()
    assert all(any(name.startswith(f"op{number}_") for name in names) for number in range(1, 11)) and "pipeline" in names


def test_stages_keep_columns_and_only_drop_rows(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, keys = docs.columns, {row["doc_id"] for row in docs.select("doc_id").collect()}
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialise(stage(spark, docs, FOLDER))
        now = [row["doc_id"] for row in docs.select("doc_id").collect()]
        assert docs.columns == columns and set(now) <= keys and len(now) == len(set(now))
        keys = set(now)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()
    assert {row["doc_id"] for row in packed} == keys


def test_stages_take_an_empty_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, FOLDER).count() == 0
