import corpus_pipeline
import __spark_entry__ as driver

from spindrift.llm import queries

SF = "/root/testdata/sf0.001"


def test_stages_hand_on_documents(spark, odd_documents, no_documents, tmp_path):
    for name, docs in (("odd", odd_documents), ("none", no_documents)):
        docs = docs.select("doc_id", "text", "lang", "source", "n_chars")
        for i, (stage, function) in enumerate(corpus_pipeline.STAGES):
            function(spark, docs, SF).write.parquet(path := f"{tmp_path}/{name}{i}")
            out = spark.read.parquet(path)
            if stage != "pack":
                assert out.columns == docs.columns
                assert out.count() <= docs.count()
            docs = out
        assert docs.count() == 0 or name == "odd"


def test_run_packs_what_the_stages_keep(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and {r.doc_id for r in rows} <= {r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "mix", "pack"]


def test_all_are_registered():
    found = driver.queries()
    assert {f"op{n}" for n in range(1, 11)} == {q.split("_")[0] for q in queries.QUERIES}
    assert queries.QUERIES.items() <= found.items() and "pipeline" in found
    assert queries.ORACLES.items() <= driver.oracle_sql().items()
