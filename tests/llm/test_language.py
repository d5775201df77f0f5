from pyspark.sql import functions as F
from spindrift.llm import language
from spindrift.llm.queries import op8_compression_language

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = op8_compression_language(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    right = got.filter("held_out").join(docs, "doc_id").agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("double"))).first()[0]
    assert right >= 0.97
    assert got.filter("rejected").count() <= 20


def test_odd_rows(spark, odd_documents, no_documents):
    got = language.identify(odd_documents).collect()
    assert len(got) == odd_documents.count()
    by = {r.doc_id: r for r in got}
    for i in (3, 4, 5, 6, 13):
        assert (by[i].lang_pred, by[i].score, by[i].rejected) == ("und", 0.0, True)
    assert all(r.lang_pred in ("en", "de", "es", "und") and 0 <= r.score <= 1 for r in got)
    kept = language.keep_identified(odd_documents)
    assert kept.columns == odd_documents.columns
    assert not {3, 4, 5, 6, 13} & {r.doc_id for r in kept.collect()}
    assert language.identify(no_documents).collect() == []


def test_nothing_to_learn_from(odd_documents):
    got = language.predict_language(odd_documents, {}, "text", [F.col("doc_id")]).collect()
    assert {r.lang_pred for r in got} == {"und"}


def test_whole_texts_are_read(spark):
    en, de = "the cat and the house with thee then that ", "der hund und das haus nicht wenn sich auch "
    df = spark.createDataFrame([(1, en * 40 + de * 4000)], "doc_id long, text string")
    words = {"en": (en * 60).encode(), "de": (de * 60).encode()}
    assert language.predict_language(df, words, "text", [F.col("doc_id")]).first().lang_pred == "de"


def test_a_hot_text_counts_once_and_the_sample_is_bounded(spark):
    hot = spark.range(3_000).select(F.lit("immer derselbe satz von vorn").alias("text"), F.lit("de").alias("lang"))
    many = spark.range(4_000).select(F.concat(F.lit("text number "), F.sha2(F.col("id").cast("string"), 256)).alias("text"), F.lit("en").alias("lang"))
    found = language.fit_dictionaries(hot.unionByName(many), sample_rows=50)
    assert list(found) == ["en", "de"]
    assert found["de"] == b"immer derselbe satz von vorn"
    assert 20 < found["en"].count(b"text number") < 100


def test_passages_come_from_anywhere_in_a_text(spark):
    """Beginnings that are all alike don't fill the dictionary."""
    df = spark.range(60).select(F.concat(F.repeat(F.lit("kopf "), 1_000), F.repeat(F.lit("rumpf "), 20_000), F.col("id").cast("string")).alias("text"), F.lit("de").alias("lang"))
    found = language.fit_dictionaries(df)["de"]
    assert found.count(b"rumpf") > found.count(b"kopf")
