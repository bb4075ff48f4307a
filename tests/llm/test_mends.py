"""Cases that earlier versions of the operators got wrong."""

import hashlib
import random

import numpy as np
import pytest
from helpers_llm import corpus, frame, repeats, sentence
from pyspark.sql import functions as F

from tidewater.llm import byte_bpe, ngram_join, tokens
from tidewater.llm.common import tidy_worker
from tidewater.llm.ngram_join import drop_near_copies, near_copies
from tidewater.llm.repeats import drop_repeats, repeat_report
from tidewater.llm.repetition import measure, quality_filter


@pytest.mark.parametrize("parts", [46_341, 100_000, 3_000_000])
def test_repeats_are_right_at_any_number_of_parts(spark, parts):
    rows = [r for r in corpus() if r[1] is None or len(r[1]) < 3000]
    got = sorted((r["doc_id"] or -1, r["n_bytes"], r["n_removed"]) for r in repeat_report(frame(spark, rows), parts).collect())
    want = sorted((i or -1, len(raw), sum(gone)) for (i, _), (raw, gone) in zip(rows, repeats(rows)))
    assert got == want and sum(n for *_, n in want) > 1000


CLASHES = ["other", "_node", "node", "_dd_node", "_dd_slice", "label"]


@pytest.mark.parametrize("drop", [drop_near_copies, drop_repeats])
def test_columns_that_clash_with_private_names(spark, drop):
    rows = [r for r in corpus() if r[1] is None or len(r[1]) < 3000]
    docs = spark.createDataFrame([(i, t, *[f"{c}{i}" for c in CLASHES]) for i, t in rows],
                                 "doc_id long, text string, " + ", ".join(f"{c} string" for c in CLASHES)).repartition(3)
    out = drop(docs)
    assert out.columns == docs.columns
    kept = out.collect()
    assert 0 < len(kept) <= len(rows)
    plain = drop(docs.select("doc_id", "text"))
    assert sorted(map(repr, out.select("doc_id", "text").collect())) == sorted(map(repr, plain.collect()))
    assert all(r[c] == f"{c}{r['doc_id']}" for r in kept for c in CLASHES)


def test_filter_keeps_what_the_metrics_keep(spark):
    rows = corpus() + [(500, "same words here " * 50), (501, sentence(random.Random(1), 60_000))]
    docs = frame(spark, rows)
    kept = measure([t for _, t in rows])["kept"]
    got = quality_filter(docs)
    assert got.columns == docs.columns
    want = [r for r, k in zip(rows, kept) if k]
    assert sorted(map(repr, [(r["doc_id"], r["text"]) for r in got.collect()])) == sorted(map(repr, want))


def test_a_family_that_shares_a_template_gives_no_quadratic_tables(spark, monkeypatch):
    """Documents with 60 common words and 60 of their own are no near copies, whatever their number."""
    sizes = {}

    def counted(df, name):
        out = kept(df, name)
        sizes[name] = max(sizes.get(name, 0), out.count())
        return out

    kept = ngram_join.materialize
    monkeypatch.setattr(ngram_join, "materialize", counted)
    common, found = sentence(random.Random(0), 60), {}
    for k in (300, 600):
        rng = random.Random(k)
        docs = spark.createDataFrame([(i, common + " " + " ".join(f"w{rng.random()}" for _ in range(60))) for i in range(k)],
                                     "doc_id long, text string").repartition(4)
        sizes.clear()
        out = near_copies(docs)
        assert out.where(F.col("component_id") != F.col("doc_id")).isEmpty()
        found[k] = dict(sizes)
    for name, n in found[600].items():
        assert n <= 2.5 * max(found[300].get(name, 0), 600), (name, found)


def test_dropped_encoder_gives_its_memory_back():
    """Its tables refer to it, so it went only at some later collection."""
    import gc
    import weakref

    gc.disable()
    try:
        enc = weakref.ref(tokens.encoder(tokens.vocabulary_path()))
        tidy_worker(keep=True)
        assert enc() is not None and enc() is tokens.encoder(tokens.vocabulary_path())
        tidy_worker()
        assert enc() is None
    finally:
        gc.enable()


def test_latin_texts_are_looked_up_by_word():
    """Case and neighbouring symbols make no entries of their own; other texts go by chunk."""
    enc = tokens.WordEncoder(tokens.vocabulary_path())
    library = enc._tokenizer
    texts = ["The the THE (the) the, the-the", "Été été, ÉTÉ! naïve-été 1été2 Œuf\tſ ŉ\nŸ", "x" * 90 + " " + "-" * 90]
    for t in texts:
        assert enc.encode(t) == np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
    assert not enc._chunks
    for t in ["don't stop", "aİb", "naïvé <|x|> 中文 ǄªŸ", "½ a\xa0b²"]:
        assert enc.encode(t) == np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
    assert enc._chunks


def test_encoding_and_decoding_share_a_worker(spark, tmp_path):
    rows = [(1, "naïve text"), (2, None), (3, ""), (4, "naïve text " * 50)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    out = byte_bpe.op13_bpe_transducer(spark, str(tmp_path))
    assert out._jdf.queryExecution().executedPlan().toString().count("MapInArrow ") == 1
    sha = {r["doc_id"]: r["decoded_sha256"] for r in out.collect()}
    assert sha == {i: hashlib.sha256((t or "").encode()).hexdigest() for i, t in rows}
