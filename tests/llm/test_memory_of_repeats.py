"""Removing repeats holds a few times a slice's text, and a bucket's fragments a part at a time."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
from helpers_llm import corpus, frame, repeats, sentence

from tidewater.llm import repeats as module
from tidewater.llm.repeats import NODE, _keys, _marked, _Slice, fragments, repeat_report

PARTS = 16


def slice_of(texts):
    """A slice whose every string of 50 bytes has a shared owner."""
    owner = np.concatenate([o for *_, o in fragments([t.encode() for t in texts])])
    bucket, key = _keys(owner, PARTS)
    docs = pa.table({NODE: pa.array(range(len(texts)), pa.int64()), "doc_id": pa.array(range(len(texts)), pa.int64()), "text": texts})
    blocks = [np.unique(key[bucket == b]).tobytes() for b in range(PARTS)]
    return _Slice(docs, pa.table({"bucket": pa.array(range(PARTS), pa.int32()), "block": pa.array(blocks, pa.binary())}), PARTS)


def test_marking_holds_a_few_times_the_text():
    rng = random.Random(7)
    s = slice_of([sentence(rng, 8000) for _ in range(40)])
    size = sum(map(len, s.texts))
    by, cut = s.dealt()
    bits = []
    for i, j in zip(cut, [*cut[1:], len(by)]):
        n = sum(len(s.pieces[k]) - module.LENGTH + 1 for k in by[i:j])
        bits.append(np.packbits(np.ones(n, bool)).tobytes())
    marks = pa.table({"bucket": pa.array([s.bucket[by[i]] for i in cut], pa.int32()), "block": pa.array(bits, pa.binary())})
    tracemalloc.start()
    try:
        gone = _marked(s, marks)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert all(g.all() for g in gone) and sum(map(len, gone)) == size
    assert peak < 25 * size, (peak, size)


def test_rounds_of_a_bucket_give_what_it_gives_at_once(spark, monkeypatch):
    monkeypatch.setattr(module, "ROUND_BYTES", 300)
    monkeypatch.setattr(module, "MARK_FRAGMENTS", 3)
    rows = [r for r in corpus() if r[1] is None or len(r[1]) < 3000]
    got = sorted((r["doc_id"] or -1, r["n_bytes"], r["n_removed"]) for r in repeat_report(frame(spark, rows), 2).collect())
    want = sorted((i or -1, len(raw), sum(gone)) for (i, _), (raw, gone) in zip(rows, repeats(rows)))
    assert got == want and sum(n for *_, n in want) > 1000
