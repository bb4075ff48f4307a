import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tidewater.llm import packing, pfor, templates, tokens, warc
from tidewater.session import scratch_path

from helpers_llm import corpus, empty, frame

VOCABULARY = tokens.vocabulary_path()


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(VOCABULARY)


ODD = ["Don't stop <|endoftext|> it's <|ENDOFTEXT|>x", "a\x1cb \x1f c", "J̌ é ́x ≠ .̸", "İSTANBUL ΣΑΣ Σ K", "École, ß ẞ ªº ŉ Ǆ œuvre! ÿ Ÿ µ",
       "日本語テキスト、です。 １２３ abc123def", "  ", "we'LL 'S x's. a.b,c!! ...", "é. ñ,, é!?", "x y　z\u0085w", "ﬁ ① ½ a​b", "w" * 300, "", None]


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("text", ODD)
def test_chunks_encode_as_the_whole(library, text):
    got = np.frombuffer(tokens.WordEncoder(VOCABULARY).encode(text), "<u4").tolist()
    assert got == ids_of(library, text)


def test_known_chunks_are_bounded(monkeypatch, library):
    monkeypatch.setattr(tokens, "MAX_CHUNKS", 6)
    monkeypatch.setattr(tokens, "MAX_PIECES", 4)
    enc = tokens.WordEncoder(VOCABULARY)
    text = " ".join(f"w{i}, word{i % 7} Ünd{i}" for i in range(60))
    assert np.frombuffer(enc.encode(text), "<u4").tolist() == ids_of(library, text)
    assert len(enc._chunks) <= 3 and len(enc._pieces) <= 2


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 1000])
@pytest.mark.parametrize("top", [1, 2, 300, 49_408, 1 << 32])
def test_blocks_round_trip(n, top):
    rng = np.random.default_rng(n)
    ids = rng.integers(0, top, n).astype(np.uint32)
    if n > 10:
        ids[rng.integers(0, n, 3)] = (1 << 32) - 1
    payload = pfor.encode_ids(ids)
    assert (pfor.decode_ids(payload) == ids).all()
    for a, b in ((0, n), (n // 3, n // 2), (n, n + 5), (n // 2, n // 2 + 1)):
        assert (pfor.decode_ids(payload, a, b) == ids[a:b]).all()


def test_narrow_blocks_are_small_and_outliers_are_exceptions():
    ids = np.full(1280, 40_000, np.uint32)
    ids[::2] += 1
    narrow = pfor.encode_ids(ids)
    ids[5] = 7_000_000
    assert len(narrow) < 1280 and len(pfor.encode_ids(ids)) == len(narrow) + 5


def test_tokens_read_back_equal_the_library(spark, library, monkeypatch):
    monkeypatch.setattr(pfor, "SEGMENT_BYTES", 2000)     # several segments a task
    rows = corpus()
    path = scratch_path(spark, "test_tokens")
    pfor.write_tokens(frame(spark, rows), path, VOCABULARY)
    got = sorted(pfor.read_tokens(spark, path).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i))
    want = {}
    for i, t in rows:
        ids = np.array([*ids_of(library, t), 1], "<u4")
        want.setdefault(i, []).append((len(ids), zlib.crc32(ids.tobytes())))
    start = 0
    for r in got:
        assert r["start"] == start
        want[r["doc_id"]].remove((r["n_tokens"], r["ids_crc32"]))
        start += r["n_tokens"]


def test_no_documents_no_tokens(spark):
    path = scratch_path(spark, "test_tokens")
    pfor.write_tokens(empty(spark), path, VOCABULARY)
    assert pfor.read_tokens(spark, path).count() == 0
    assert packing.pack(empty(spark), VOCABULARY).count() == 0


def test_packed_pieces_are_whole_and_gapless(spark, library):
    rows = corpus()
    got = packing.pack(frame(spark, rows), VOCABULARY, size=256).collect()
    want = []
    for i, t in rows:
        ids = np.array([*ids_of(library, t), 0], "<u4")
        want += [(str(i), k // 256, k, len(ids[k:k + 256]), zlib.crc32(ids[k:k + 256].tobytes())) for k in range(0, len(ids), 256)]
    assert sorted(want) == sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got)
    by = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in by.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 256
    assert len(by) <= -(-sum(r["length"] for r in got) // 256) * 1.03 + 1


@pytest.mark.parametrize("n", [0, 1, 40, 3000, 50_000])
def test_plans_use_the_histogram_up(n):
    rng = np.random.default_rng(n)
    length = np.clip(rng.lognormal(6.2, 1, n).astype(int) + 1, 1, 2048)
    hist = np.bincount(length, minlength=2049)
    plan = packing.plan_patterns(hist)
    used = np.zeros(2049, np.int64)
    for lengths, times in plan:
        assert sum(lengths) <= 2048
        np.add.at(used, list(lengths), times)
    assert (used == hist).all()
    bound = -(-int(length.sum()) // 2048)
    best = sum(t for _, t in packing.best_fit(hist, 2048))
    assert sum(t for _, t in plan) <= max(best, int(bound * 1.001) + 1)


def test_one_length_holds_a_third_of_all_pieces():
    hist = np.zeros(2049, np.int64)
    hist[100:1500], hist[700] = 143, 100_000
    plan = packing.plan_patterns(hist)
    assert sum(ls.count(700) * t for ls, t in plan) == 100_000


PAGES = "page_id long, url string, html string, size int"


def page_rows():
    rng = random.Random(2)
    rows = [(i, f"http://x/é {i}\n", "".join(rng.choice("abc é<p>") for _ in range(rng.randint(0, 3000))), 1) for i in range(60)]
    rows += [(100 + i, "u", "same" * 50, 1) for i in range(25)] + [(200, None, None, 1), (201, "u", "", 1), (202, "u", "x" * 3_000_000, 1)]
    return rows + [(None, "u", "only null", 1), (None, "u", "same" * 50, 1), (300, "u", "twice", 1), (300, "u", "twice", 1)]


@pytest.mark.parametrize("step", [997, 1 << 20])
def test_archives_read_back(spark, step):
    rows = page_rows()
    files = warc.write_archives(spark.createDataFrame(rows, PAGES).repartition(3), scratch_path(spark, "test_warc"))
    if step < 1000:   # tiny ranges: on the small pages only
        rows = rows[:85]
        files = warc.write_archives(spark.createDataFrame(rows, PAGES).repartition(2), scratch_path(spark, "test_warc"))
    got = sorted((tuple(r) for r in warc.read_archives(files, step).collect()), key=str)
    top = {}
    for i, _, html, _ in rows:
        if i is not None:
            top[html or ""] = max(top.get(html or "", i), i)
    want = []
    for i, _, html, _ in rows:
        p = (html or "").encode()
        keeper = top.get(html or "")
        revisit = keeper is not None and keeper != i
        want.append((i, len(p), warc.digest_of(p), "revisit" if revisit else "response", keeper if revisit else None))
    assert got == sorted(want, key=str)


def test_any_cut_of_an_archive_gives_every_record_once():
    raw = b"".join(warc.record(i, "u", b"\x1f\x8b\x08 not a member " * i, None) for i in range(40))
    read = lambda at, n: raw[at:at + n]
    for step in (1, 13, 500, len(raw)):
        got = [warc.parse(m)["page_id"] for a in range(0, len(raw), step) for m in warc.members(read, a, min(a + step, len(raw)))]
        assert got == list(range(40))


def test_damaged_members_are_passed_over():
    good = [warc.record(i, "u", b"text", None) for i in range(3)]
    raw = good[0] + good[1][:20] + b"\0" * 30 + good[2]
    got = [warc.parse(m)["page_id"] for m in warc.members(lambda at, n: raw[at:at + n], 0, len(raw))]
    assert got == [0, 2]


def test_no_pages_no_records(spark):
    files = warc.write_archives(spark.createDataFrame([], PAGES), scratch_path(spark, "test_warc"))
    assert warc.read_archives(files).count() == 0


# --- leaks -----------------------------------------------------------------

ITEMS = [(1, "Yesterday Alice bought 12 apples for 30 cents each and gave Alice half of the 12 apples to the poor baker"),
         (2, "the quick brown fox jumps over the lazy dog while nobody is watching the garden gate"),
         (3, None), (4, ""), (5, "12 13 14 15 16 17 18 19 20"), (None, "a null item of enough words to be found anywhere"),
         (6, "only four words here")]


def leak_docs():
    filler = "some words that lead up to it. "
    return [
        (1, filler + ITEMS[0][1] + ". and more"),                                                     # verbatim
        (2, filler + ITEMS[0][1].replace("Alice", "Robert").replace("12", "48").replace("30", "7") + "."),   # new names and numbers
        (3, filler + ITEMS[0][1].replace("12 apples for", "48 apples for") + "."),                    # 12 stands for 48 and 12, the rest is verbatim
        (4, "THE quick brown fox, jumps over the lazy dog while nobody is watching; the garden gate"),
        (5, "the quick brown fox jumps over the lazy dog"),                                            # a small part only
        (6, "12 13 14 15 16 17 18 19 20 21 22"), (7, None), (8, ""), (9, "so only four words here again"),
        (None, ITEMS[1][1]), (4, "another text"), (1, filler + ITEMS[0][1] + ". and more"),
        (10, "a null item of enough words to be found anywhere")]


def test_leaks_and_slots(spark):
    items = spark.createDataFrame([(i, t, 1) for i, t in ITEMS], "item_id long, text string, doc_id int")
    docs = frame(spark, leak_docs())
    got = {(r["doc_id"], r["item_id"]): r["changed"] for r in templates.leaks(docs, items).collect()}
    assert got == {(1, 1): False, (2, 1): True, (3, 1): False, (4, 2): False, (None, 2): False, (9, 6): False}
    left = templates.drop_contaminated(docs, items)
    assert left.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in left.collect()) == sorted(["5", "6", "7", "8", "4", "10"])


def test_leaks_of_empty_tables(spark):
    items = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([ITEMS[1]], "item_id long, text string")
    assert templates.leaks(frame(spark, leak_docs()), items).count() == 0
    assert templates.leaks(empty(spark), some).count() == 0
    assert templates.drop_contaminated(frame(spark, leak_docs()), items).count() == len(leak_docs())


LONG = " ".join(f"{a} {b}" for a in ("green", "old", "small", "warm", "loud", "empty") for b in
                ("rivers turn", "houses stand", "boats sail", "roads wind", "bells ring"))     # 90 words, 83 windows


def found(spark, items, docs):
    items = spark.createDataFrame(items, "item_id long, text string")
    return {(r["doc_id"], r["item_id"]) for r in templates.leaks(frame(spark, docs), items).collect()}


def test_excerpts_of_long_items(spark):
    words = LONG.split()
    docs = [(1, "it says " + " ".join(words[20:33]) + " and ends"), (2, "it says " + " ".join(words[20:32]) + " and ends"),
            (3, " ".join(words[:11]) + " x " + " ".join(words[60:71])), (4, " ".join(words[:45])), (None, " ".join(words[20:34]))]
    assert found(spark, [(1, LONG)], docs) == {(1, 1), (4, 1), (None, 1)}


def test_copies_in_other_case_and_lines(spark):
    item = "we all know that old John has nine grey cats in every small house"
    names = "then John Mary Peter Paul Ruth Anna Mark met"       # too few words that are no names
    km = "a ride of 12 km to the old town costs 5 % more this year"
    docs = [(1, f"so {item}."), (2, f"so {item.lower()}."), (3, f"so {item.upper()}."), (4, "so " + item.replace(" ", "\n")),
            (5, f"so {item.title()}."), (6, names.upper()), (7, km.replace(" ", "\n")), (8, km.replace("12 km", "30\nmiles").replace("5 %", "7\n%")),
            (9, "we all know nine grey cats")]
    assert found(spark, [(1, item), (2, names), (3, km)], docs) == {(i, 1) for i in range(1, 6)} | {(6, 2), (7, 3), (8, 3)}


def test_one_contradicted_value_leaves_the_other_windows(spark):
    words = LONG.split()
    twice = " ".join([*words[:20], "12", *words[20:50], "12", *words[50:60]])
    often = " ".join(w if i % 7 else "12" for i, w in enumerate(words))          # every window holds 12
    short = "they ate 2 red apples and 2 green pears on the way home"
    one = lambda t, a, b: b.join(t.rsplit(a, 1))
    docs = [(1, "so " + one(twice, "12", "15")), (2, "so " + one(often, "12", "15")),
            (3, "so " + twice.replace("12", "15", 1).replace(" 12", " 16")), (4, "so " + one(short.replace("2", "3"), "3", "4")),
            (None, "so " + one(twice, "12", "15"))]
    assert found(spark, [(1, twice), (2, often), (3, short)], docs) == {(1, 1), (2, 2), (3, 1), (None, 1)}


def test_units_and_names():
    doc, code, slot, words, at = templates.canonical(["He ran 5 km in Paris. Paris is 5 km wide"])
    seen = [words[i] for i in at]
    assert [w for w, s in zip(seen, slot) if s] == ["5", "km", "Paris", "5", "km"]     # a sentence's first word is no name
    assert pa.array(doc).to_pylist() == [0] * len(code)
