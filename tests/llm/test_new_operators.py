"""Filter audit, spelling groups and the BPE transducer against brute force and the library."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
import tiktoken
from helpers_llm import corpus, empty, frame, sentence

from tidewater.llm import byte_bpe, filter_audit, spelling
from tidewater.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


# -- op11 -------------------------------------------------------------------

def audit_by_hand(rows, labels):
    """rows: (doc_id, text, lang). Every order is applied to every document."""
    fails = []
    texts = [t or "" for _, t, _ in rows]
    for (i, _, _), t in zip(rows, texts):
        w = t.encode().split()
        f = set()
        if len(w) < 100:
            f.add("A")
        if 100 * len(set(w)) < 80 * len(w):
            f.add("B")
        if 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t):
            f.add("C")
        if any(c in t for c in "#$%&*|"):
            f.add("D")
        if i is not None and any(j is not None and j < i and u == t for (j, _, _), u in zip(rows, texts)):
            f.add("E")
        fails.append(f)
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    out = {}
    for part in {p or "" for *_, p in rows}:
        here = [(i, f) for (i, _, p), f in zip(rows, fails) if (p or "") == part]
        shapley = Counter()
        for order in permutations("ABCDE"):
            left = here
            for step, c in enumerate(order, 1):
                gone = [x for x in left if c in x[1]]
                left = [x for x in left if c not in x[1]]
                shapley[c] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(c in f for _, f in here) - len(gone), sum(f == {c} for _, f in here),
                    sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)]
        for (p, order, step), v in out.items():
            if p == part:
                v.append(shapley[order[step - 1]])
    return out


def test_intervals_cover_every_removal_once():
    ranks = {p: r for r, p in enumerate(permutations(filter_audit.FILTERS))}
    covered = defaultdict(list)
    for mask, step, first, after in filter_audit.mask_intervals():
        for r in range(first, after):
            covered[mask, r].append(step)
    for mask in range(32):
        for order, r in ranks.items():
            want = [s for s, c in enumerate(order, 1) if mask >> "ABCDE".index(c) & 1][:1]
            assert covered[mask, r] == want


def test_audit_equals_applying_all_orders(spark):
    rng = random.Random(11)
    texts = [sentence(rng, n) for n in (5, 99, 100, 101, 400)] + ["SHOUT " * 120, "a # b", "x" * 50_000, "", None, " \n\x0b "]
    texts += ["".join(rng.choice("ABc %|") for _ in range(300)) for _ in range(5)]
    rows = [(i, rng.choice(texts), rng.choice(["en", "de", None, ""])) for i in range(150)]
    rows += [rows[3], rows[3], (None, texts[0], "en"), (None, texts[0], "en"), (-5, texts[1], "fr")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 150, 2)]
    labels += [(4, 1, 0), (4, 0, 1), (None, 1, 1), (9999, 1, 1)]
    docs = spark.createDataFrame([(*r, 1, "s") for r in rows], "doc_id long, text string, lang string, n int, mask string").repartition(5)
    marks = spark.createDataFrame([(*r, "en") for r in labels], "doc_id long, quality int, toxic int, lang string")
    got = {(r["part"], r["filter_order"], r["step"]):
           [r[c] for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")]
           for r in filter_audit.audit(filter_audit.mask_counts(docs, marks)).collect()}
    assert got == audit_by_hand(rows, labels)
    assert filter_audit.audit(filter_audit.mask_counts(docs.limit(0), marks)).count() == 0


# -- op12 -------------------------------------------------------------------

def words_by_hand(rows):
    n = Counter()
    for i, t in rows:
        run = ""
        for c in (t or "") + "\0":
            if "A" <= c <= "Z" or "a" <= c <= "z" or "À" <= c <= "ÿ":
                run += c.lower() if c <= "Z" else c
            elif run:
                h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
                n[run[:h % len(run)] + run[h % len(run) + 1:] if h % 97 == 0 else run] += 1
                run = ""
    return {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}


def near_by_hand(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def groups_by_hand(rows):
    n = words_by_hand(rows)
    near = {w: [v for v in n if near_by_hand(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n[w], len(near[w]), n.get(form[w]))
    return out


def variants(seed):
    """Texts of words in families one or more edits apart, with counts that chain, ties and every letter."""
    rng = random.Random(seed)
    letters = "abcdexyzÀ×é÷ÿ"
    words = []
    for _ in range(25):
        w = "".join(rng.choice(letters) for _ in range(rng.choice([5, 6, 7, 9, 45])))
        n = 48
        while n >= 2:
            words += [w] * n
            k = rng.randrange(len(w))
            w = rng.choice([w[:k] + w[k + 1:], w[:k] + rng.choice(letters) + w[k:], w[:k] + rng.choice(letters) + w[k + 1:]])
            n = rng.choice([n // 2, n // 3, n])
            if rng.random() < 0.2:
                break
    rng.shuffle(words)
    rows = [(i, " ".join(w.upper() if w.isascii() and rng.random() < 0.1 else w for w in words[a:a + 90]))
            for i, a in enumerate(range(0, len(words), 90))]
    return rows + [(900, None), (901, ""), (902, "123 Āœ x"), (None, " ".join(words[:40])), rows[0], rows[0]]


@pytest.mark.parametrize("max_bytes", [32 << 20, 256])
def test_spelling_groups_equal_all_pairs(spark, max_bytes):
    rows = variants(3) + corpus()
    got = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"])
           for r in spelling.spelling_groups(frame(spark, rows), max_bytes).collect()}
    want = groups_by_hand(rows)
    assert got == want
    assert sum(v[0] is not None and v[0] != v[1] for v in want.values()) > 3   # chains of forms


def test_small_filters_take_several_rounds_and_hold_every_word(spark):
    words = spark.createDataFrame([(w, n) for w, n in words_by_hand(variants(4)).items()], "word string, n long")
    blocks, rounds = spelling.filter_plan(words, 256)
    assert rounds > 1
    left = {r["word"] for r in words.collect()}
    for f in spelling.build_filters(words, 256):
        assert sum(b.nbytes for b in f.bits.values()) <= 256 + 64 * len(blocks)
        left -= {w for w in left if f.may_hold(len(w), spelling.word_hashes(spelling._points([w])))[0]}
    assert not left


def test_no_words_give_no_rows(spark):
    assert spelling.spelling_groups(empty(spark)).count() == 0
    assert spelling.spelling_groups(frame(spark, [(1, "one two"), (2, None)])).count() == 0


# -- op13 -------------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    ranks = byte_bpe.read_ranks(byte_bpe.ranks_path())
    return ranks, tiktoken.Encoding("own", pat_str=byte_bpe.piece_pattern(), mergeable_ranks=ranks, special_tokens={})


def packed(ids):
    return np.array(ids, "<u4").tobytes()


def test_transducer_equals_the_library(library):
    ranks, enc = library
    rng = random.Random(13)
    ours = byte_bpe.Encoder(ranks, byte_bpe.piece_pattern())
    pools = ["abcdefgh  '\n\t", "aab b", "éüß 日本語\U0001f600\U0001f44d‍", "0123,;-_ ", "the ing er tion  ", "\x00\x7f̀ a"]
    texts = ["".join(rng.choice(p) for _ in range(rng.randint(0, 80))) for p in pools * 300]
    texts += ["a" * 30_000, "日本" * 5_000, " " * 9_000, "'s" * 50]
    assert ours.encode(texts) == [packed(enc.encode_ordinary(t)) for t in texts]
    assert ours.encode(["", None, texts[0]]) == [b"", b"", packed(enc.encode_ordinary(texts[0]))]
    tokens = list(ranks)
    pieces = [b"".join(rng.choice(tokens) for _ in range(rng.randint(1, 6))) for _ in range(3000)]
    assert ours._transducer.encode_pieces(pieces) == [packed(enc._encode_single_piece(p)) for p in pieces]


def test_few_states_change_nothing(library):
    ranks, enc = library
    small, rng = byte_bpe.Encoder(ranks, byte_bpe.piece_pattern(), max_states=40), random.Random(14)
    for _ in range(60):
        texts = ["".join(rng.choice("thenarios é日") for _ in range(rng.randint(1, 60))) for _ in range(5)]
        texts.append("".join(rng.choice("thenario") for _ in range(rng.choice([1, 2000]))))
        assert small.encode(texts) == [packed(enc.encode_ordinary(t)) for t in texts]
        assert len(small._transducer._states) <= 40


def test_a_token_that_the_merges_dont_reach_stands_for_its_whole_piece():
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"bc": 257, b"xbc": 259, b"abc": 258, b"abcd": 300}
    enc = tiktoken.Encoding("own", pat_str=r"\S+|\s", mergeable_ranks=ranks, special_tokens={})
    ours = byte_bpe.Encoder(ranks, r"\S+|\s")
    rng = random.Random(15)
    texts = ["abc", "abcd", "abcdab", "xbc", "xabc"] + ["".join(rng.choice("abcdx ") for _ in range(rng.randint(1, 12))) for _ in range(2000)]
    for t, ids in zip(texts, ours.encode(texts)):
        assert ids == packed(enc.encode_ordinary(t)), t


def test_decoding_in_any_cut(library):
    ranks, enc = library
    dec, rng = byte_bpe.Decoder(ranks), random.Random(16)
    for _ in range(500):
        t = "".join(rng.choice("ab é日\U0001f600\U0010ffff߿ࠀ") for _ in range(rng.randint(0, 40)))
        ids = np.array(enc.encode_ordinary(t), "<u4")
        cuts = [0, *sorted(rng.randint(0, len(ids)) for _ in range(6)), len(ids)]
        assert "".join(dec.stream(ids[a:b] for a, b in zip(cuts, cuts[1:]))) == t
        raw = bytes(rng.choice([0x41, 0x80, 0xBF, 0xC3, 0xE0, 0xED, 0xF0, 0xF4, 0xFF, 0x9F]) for _ in range(rng.randint(0, 12)))
        machine = byte_bpe.Utf8Machine()
        got = "".join(machine.feed(raw[i:i + 1]) for i in range(len(raw))) + machine.close()
        assert got == raw.decode("utf-8", "replace")


def test_columns_round_trip(spark, library):
    rows = corpus()
    docs = frame(spark, rows)
    path = byte_bpe.ranks_path()
    out = byte_bpe.decode(byte_bpe.encode(docs, path, byte_bpe.piece_pattern(), out="token_ids"), path, "token_ids", "back")
    assert out.columns == [*docs.columns, "token_ids", "back"]
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["back"] == (r["text"] or "")
        assert bytes(r["token_ids"]) == packed(library[1].encode_ordinary(r["text"] or ""))
        assert r["n_chars"] == (None if r["text"] is None else len(r["text"]))
    with pytest.raises(ValueError):
        byte_bpe.encode(docs, path, byte_bpe.piece_pattern(), out="kept")
    assert byte_bpe.encode(empty(spark), path, byte_bpe.piece_pattern()).count() == 0


def test_op13_on_the_small_tables(spark, library):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in QUERIES["op13_bpe_transducer"](spark, SF).collect()}
    want = {}
    for i, t in texts.items():
        ids = library[1].encode_ordinary(t)
        want[i] = (len(ids), hashlib.sha256(packed(ids)).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
    assert got == want
