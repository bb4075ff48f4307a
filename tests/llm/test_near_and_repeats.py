import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tidewater.llm import ngram_join, repeats, repetition
from tidewater.llm.bwt import merge, transform
from tidewater.llm.components import components

from helpers_llm import clusters, corpus, empty, frame, repeats as brute_repeats


def _key(x):
    return tuple(("", "") if v is None else ("v", v) for v in x)


@pytest.mark.parametrize("short", [64, 2])
def test_components_equal_all_pairs(spark, monkeypatch, short):
    """With lists of over two documents long, pivots and closure do the work."""
    monkeypatch.setattr(ngram_join, "SHORT", short)
    rows = corpus()
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"])
                  for r in ngram_join.near_copies(frame(spark, rows)).collect()), key=_key)
    root, sets = clusters(rows)
    least = {}
    for (i, _), c in zip(rows, root):
        if i is not None:
            least[c] = min(least.get(c, i), i)
    want = sorted(((i, len(s), least.get(c)) for (i, _), s, c in zip(rows, sets, root)), key=_key)
    assert got == want


def test_one_document_of_each_group_stays(spark):
    rows = corpus()
    docs = frame(spark, rows)
    out = ngram_join.drop_near_copies(docs)
    assert out.columns == docs.columns
    root, sets = clusters(rows)
    kept = out.select("doc_id", "text").collect()
    with_text = [c for c, s in zip(root, sets) if s]
    assert sum(1 for r in kept if ngram_join.shingle_sets([r["text"]])[0].size) == len(set(with_text))
    assert sum(1 for r in kept if not (r["text"] or "").strip()) == sum(1 for s in sets if not s)


def test_empty_tables(spark):
    assert ngram_join.near_copies(empty(spark)).count() == 0
    assert ngram_join.drop_near_copies(empty(spark)).count() == 0
    assert repeats.repeat_report(empty(spark)).count() == 0
    assert repeats.drop_repeats(empty(spark)).count() == 0
    assert repetition.quality_metrics(empty(spark)).count() == 0
    assert repetition.quality_filter(empty(spark)).count() == 0


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 130)] + [(7, 7), (200, 201)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    groups = Counter(got.values())
    assert sorted(groups.values()) == [2, 30, 31] and len({got[i] for i in range(31)}) == 1


def test_prefix_length_is_enough():
    for n in range(1, 60):
        # the smallest overlap of a similar partner is 3/4 of n, rounded up; it must reach into the prefix
        assert n - int(ngram_join.prefix_length(np.array([n]))[0]) < (3 * n + 3) // 4


def test_repeat_report_equals_brute_force(spark):
    rows = corpus()
    got = sorted((_key(tuple(r)) for r in repeats.repeat_report(frame(spark, rows)).collect()))
    want = []
    for (i, _), (raw, gone) in zip(rows, brute_repeats(rows)):
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        want.append(_key((i, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())))
    assert got == sorted(want)


def test_drop_repeats_cuts_texts_and_keeps_columns(spark):
    rows = corpus()
    docs = frame(spark, rows)
    out = repeats.drop_repeats(docs)
    assert out.columns == docs.columns and out.count() == len(rows)
    whole = {}
    for (i, t), (_, gone) in zip(rows, brute_repeats(rows)):
        if not any(gone):
            whole[i, t] = t
    after = out.collect()
    have = Counter((r["doc_id"], r["text"]) for r in after)
    assert all(have[k] for k in whole)
    assert all(r["n_chars"] == len(r["text"]) for r in after if r["text"] is not None and r["n_chars"] is not None)


def test_characters_are_cut_whole():
    raw = "aéb".encode()
    gone = np.array([False, False, True, False])   # the second byte of the two of é
    assert repeats._kept_text(raw, gone) == "ab"


def test_merged_transforms_equal_sorting():
    rng = random.Random(3)
    for _ in range(40):
        strings = [bytes(rng.choice(b"ab\x00\xf4") for _ in range(rng.randint(0, 12))) for _ in range(rng.randint(1, 15))]
        k, depth = rng.randint(1, 4), rng.choice([1, 3, 5])
        cuts = [c for c in (strings[i::k] for i in range(k)) if c]
        shards = [transform(c) for c in cuts]
        order, common, first = merge(shards, depth)
        suffix = [(s + b"\0")[at - start:][:len(s) - (at - start)] for c, sh in zip(cuts, shards)
                  for at in sh.place.tolist() for s, start in [_string_at(c, at)]]
        rows = [suffix[r] for r in order.tolist()]
        cut = [[b + 1 for b in x[:depth]] + [0] * (len(x) < depth) for x in rows]
        assert cut == sorted(cut)
        starts = set(first.tolist())
        for i in range(1, len(rows)):
            same = next((n for n, (x, y) in enumerate(zip(rows[i - 1], rows[i])) if x != y), min(len(rows[i - 1]), len(rows[i])))
            assert common[i] == min(same, depth)
            assert (i not in starts) == (same >= depth)


def _string_at(strings, at):
    start = 0
    for s in strings:
        if at <= start + len(s):
            return s, start
        start += len(s) + 1
    raise AssertionError


def _longest(words):
    n = len(words)
    out = [0] * n
    for i in range(n):
        for j in range(n):
            k = 0
            while i != j and i + k < n and j + k < n and words[i + k] == words[j + k]:
                k += 1
            out[i] = max(out[i], k)
    return out


def test_longest_repeats_equal_brute_force():
    rng = random.Random(1)
    texts = [[rng.choice("abc") for _ in range(rng.randint(0, 50))] for _ in range(80)] + [list("abcdefgh") * 12, ["x"] * 60]
    flat, ends, want = [], [], []
    for t in texts:
        flat += [ord(c) for c in t]
        ends += [len(flat)] * len(t)
        want += _longest(t)
    assert repetition.longest_repeats(np.array(flat), np.array(ends)).tolist() == want


def test_quality_metrics_equal_brute_force(spark):
    rows = [*corpus(), (90, "spam spam eggs " * 30), (91, "a#b $ % & | < > * c"), (92, "l one\nl one\n\n\nl two\nl one")]
    rows = [(i, t if t is None or len(t) < 5000 else t[:3000]) for i, t in rows]
    got = Counter()
    for r in repetition.quality_metrics(frame(spark, rows)).collect():
        got[tuple(r[c] for c in ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                 "base_failed", "longest_repeat", "n_covered_words", "kept"))] += 1
    want = Counter()
    for i, t in rows:
        t = t or ""
        words = t.encode().split()
        far = _longest(words)
        cover = lambda least: len({k for s, n in enumerate(far) if n >= least for k in range(s, s + n)})  # noqa: B023, E731
        lines = [x for x in t.split("\n") if x.encode().split()]
        base = len(words) < 10 or 100 * cover(5) > 20 * len(words)
        most, under = max(far, default=0), cover(repetition.MIN_REPEAT)
        kept = not base and under <= repetition.MAX_COVERED * len(words) and most <= repetition.MAX_LONGEST
        want[(i, len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in t),
              len(lines) - len(set(lines)), cover(5), base, most, under, kept)] += 1
    assert got == want
    assert repetition.quality_filter(frame(spark, rows)).count() == sum(n for k, n in want.items() if k[-1])
