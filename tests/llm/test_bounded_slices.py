"""What a slice of texts holds and sends at once is a few times its text, whatever fragments are shared; known words are few."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
from helpers_llm import sentence

from tidewater.llm import repeats, tokens
from tidewater.llm.repeats import NODE, _keys, _Slice, fragments


def test_a_slice_of_shared_fragments_holds_a_few_times_its_text(monkeypatch):
    monkeypatch.setattr(repeats, "SLICE_FRAGMENTS", 4096)
    rng = random.Random(9)
    texts = [sentence(rng, 400) for _ in range(600)]
    owner = np.concatenate([o for *_, o in fragments([t.encode() for t in texts])])
    bucket, key = _keys(owner, 16)
    docs = pa.table({NODE: pa.array(range(600), pa.int64()), "doc_id": pa.array(range(600), pa.int64()), "text": texts})
    shared = pa.table({"bucket": pa.array(range(16), pa.int32()), "block": pa.array([np.unique(key[bucket == b]).tobytes() for b in range(16)], pa.binary())})
    size = sum(map(len, texts))
    tracemalloc.start()
    try:
        s = _Slice(docs, shared, 16)
        held, peak = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert len(s.pieces) > size // 40 and held < 8 * size and peak < 12 * size, (len(s.pieces), size, held, peak)
    # equal fragments are one, under the smallest id
    whole: dict[bytes, int] = {}
    for f in range(len(s.row)):
        piece = bytes(s.texts[s.row[f]][s.start[f]:s.start[f] + s.count[f] + repeats.LENGTH - 1])
        assert s.pieces[int(s.which[f])] == piece
        whole[piece] = min(whole.get(piece, 1 << 40), int(s.ids[s.row[f]]))
    assert dict(zip(s.pieces, s.least.tolist())) == whole and len(whole) == len(s.pieces)


def test_a_slices_blocks_leave_it_in_parts(monkeypatch):
    monkeypatch.setattr(repeats, "DEAL_BYTES", 2000)
    rng = random.Random(10)
    texts = [sentence(rng, 300) for _ in range(20)]
    bucket, key = _keys(np.concatenate([o for *_, o in fragments([t.encode() for t in texts])]), 16)
    docs = pa.table({NODE: pa.array(range(20), pa.int64()), "doc_id": pa.array(range(20), pa.int64()), "text": texts})
    shared = pa.table({"bucket": pa.array(range(16), pa.int32()), "block": pa.array([np.unique(key[bucket == b]).tobytes() for b in range(16)], pa.binary())})
    s = _Slice(docs, shared, 16)
    by, cut = s.dealt()
    schema = pa.schema([("slice", pa.int32()), ("kind", pa.int32()), ("bucket", pa.int32()), ("block", pa.binary())])
    out = list(repeats._dealt_blocks(s, by, cut, 3, schema))
    assert len(out) > 3
    rows = pa.concat_tables(out).to_pylist()
    assert [r["bucket"] for r in rows] == s.bucket[by[cut]].tolist()
    assert [r["block"] for r in rows] == [repeats._pack(s, by[i:j]) for i, j in zip(cut, [*cut[1:], len(by)])]


def test_known_words_of_a_worker_hold_little():
    """As many words as a worker remembers, beside the tokenizer's own."""
    known = tokens._Known(lambda x: x.encode()[:8], tokens.MAX_PIECES)
    tracemalloc.start()
    try:
        for k in range(700_000):
            known[f"word{k:08d}"]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert known["word00000003"] == b"word0000" and peak < 80_000_000, peak
