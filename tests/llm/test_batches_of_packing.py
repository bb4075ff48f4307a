"""Packing hands whole texts to Python by few rows, and leaves the session's setting as it was."""

from helpers_llm import frame

from tidewater.llm import common, packing
from tidewater.llm.tokens import vocabulary_path

KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


def test_texts_are_encoded_in_small_batches(spark, monkeypatch):
    seen, kept = [], packing.materialize
    monkeypatch.setattr(packing, "materialize", lambda df, name: seen.append(spark.conf.get(KEY)) or kept(df, name))
    before = spark.conf.get(KEY, None)
    got = packing.pack(frame(spark, [(i, f"word {i} " * (i % 7)) for i in range(30)]), vocabulary_path(), size=16)
    assert got.select("doc_id").distinct().count() == 30
    assert seen == [str(common.BATCH_ROWS)] and common.BATCH_ROWS <= 1000
    assert spark.conf.get(KEY, None) == before


def test_a_setting_of_the_session_comes_back(spark):
    before = spark.conf.get(KEY, None)
    spark.conf.set(KEY, "77")
    try:
        with common.small_batches(spark, 5):
            assert spark.conf.get(KEY) == "5"
        assert spark.conf.get(KEY) == "77"
    finally:
        spark.conf.unset(KEY) if before is None else spark.conf.set(KEY, before)
