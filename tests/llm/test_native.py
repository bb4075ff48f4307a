import zlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from tidewater.llm import licenses, sharding, snapshots
from tidewater.llm.queries import ORACLE, QUERIES

from helpers_llm import corpus, empty, frame

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    df = QUERIES[name](spark, SMALL)
    cols = sorted(df.columns)
    want = Counter(con.sql(ORACLE[name]).select(*[f'"{c}"' for c in cols]).fetchall())
    assert Counter(tuple(r[c] for c in cols) for r in df.collect()) == want


@pytest.mark.parametrize("rows", [1, 2, 7, 40, 41, 1000, 1001])
def test_the_permutation_is_one(spark, rows):
    p = spark.range(rows).select(sharding.permuted(F.col("id"), rows).alias("p"))
    assert sorted(r["p"] for r in p.collect()) == list(range(rows))


def _by_hand(row, rows, seed=sharding.SEED):
    a, b = sharding.halves(rows)
    keys = sharding.round_keys(seed)
    p = row
    while True:
        left, right = divmod(p, b)
        for i, (m, c) in enumerate(keys):
            y = ((left if i % 2 else right) * m + c) % sharding.PRIME
            y = y * y % sharding.PRIME
            if i % 2:
                right = (right + y) % b
            else:
                left = (left + y) % a
        p = left * b + right
        if p < rows:
            return p


def test_shard_and_slot_are_computable_from_the_row_number(spark):
    rows = corpus()
    digest = frame(spark, rows).selectExpr("doc_id", "octet_length(coalesce(text, '')) + 16L AS size",
                                           "crc32(coalesce(text, '')) AS text_crc32", "'mine' AS slot", "1 AS row_number")
    got = sharding.assign_shards(digest, ["doc_id", "size", "text_crc32"], 7).collect()
    ordered = sorted(((i is not None, i or 0), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    assert sorted(r["row_number"] for r in got) == list(range(len(rows)))
    for r in got:
        p = _by_hand(r["row_number"], len(rows))
        assert (r["shard"], r["slot"]) == (p % 7, p // 7)
        assert ordered[r["row_number"]] == ((r["doc_id"] is not None, r["doc_id"] or 0), r["size"], r["text_crc32"])
    sizes = Counter(r["shard"] for r in got)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    assert all(sorted(r["slot"] for r in got if r["shard"] == s) == list(range(n)) for s, n in sizes.items())


def test_shards_are_written_in_slot_order(spark, tmp_path):
    out = sharding.assign_shards(spark.range(200).withColumnRenamed("id", "doc_id"), ["doc_id"], 4)
    sharding.write_shards(out, str(tmp_path / "s"))
    for s in range(4):
        back = spark.read.parquet(str(tmp_path / "s" / f"shard={s}"))
        assert sorted(r["slot"] for r in back.collect()) == list(range(50))


def test_native_operators_take_empty_tables(spark):
    assert sharding.assign_shards(empty(spark).select("doc_id"), ["doc_id"]).count() == 0
    assert licenses.license_labels(empty(spark)).count() == 0
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    hashed = snapshots.turn_hashes(none)
    assert snapshots.render(hashed, snapshots.maximal_conversations(hashed)).count() == 0


# --- licenses ----------------------------------------------------------------

def test_license_places_and_blocks(spark):
    texts = [
        (1, "MIT-License; then mit license\nApache   License"), (2, None), (3, ""), (4, "summit license apachelicense cc-by-sa"),
        (5, "Permission is hereby granted, free of charge, to any person obtaining a copy of that software"),   # 14 of 15 words
        (6, "free of charge to any person"), (7, "Licensed under the Apache\nLicense Version 2.0"),
        (8, "ĞNU general public license. gnu GENERAL public License"), (9, "mit license"), (9, "cc by"), (9, "cc by"),
        (None, "cc by"), (10, "word " * 20_000 + "mit license")]
    got = Counter((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"],
                   round(r["score"], 3)) for r in licenses.license_labels(frame(spark, texts)).collect())
    assert got == Counter([
        (1, 7, 3, 0, 5, "apache,mit", "apache,mit", 0.0), (2, 0, 0, None, None, "", "", 0.0), (3, 0, 0, None, None, "", "", 0.0),
        (4, 6, 1, 3, 3, "cc-by", "cc-by", 0.0), (5, 16, 0, None, None, "", "mit-grant", round(14 / 15, 3)),
        (6, 6, 0, None, None, "", "", 0.0), (7, 8, 1, 3, 3, "apache", "apache,apache-2.0", 1.0),
        (8, 8, 1, 4, 4, "gpl", "gpl", 0.0), (9, 2, 1, 0, 0, "mit", "mit", 0.0),
        (9, 2, 1, 0, 0, "cc-by", "cc-by", 0.0), (9, 2, 1, 0, 0, "cc-by", "cc-by", 0.0),
        (None, 2, 1, 0, 0, "cc-by", "cc-by", 0.0), (10, 20_002, 1, 20_000, 20_000, "mit", "mit", 0.0)])


WRAPPED = [
    ("Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that", "bsd"),
    ("Permission is hereby granted, free of charge, to any\nperson obtaining a copy of\nthis software and", "mit-grant"),
    ("# Licensed under the Apache License,\n# Version 2.0 (the", "apache-2.0"),
]


def test_wrapped_notices_carry_their_labels(spark):
    docs = [(i, "code here\n" + t + "\nmore code") for i, (t, _) in enumerate(WRAPPED)]
    docs += [(9, WRAPPED[0][0].replace("\n", "\n\n\nx\n"))]      # too far apart
    got = {r["doc_id"]: r["labels"].split(",") for r in licenses.license_labels(frame(spark, docs)).collect()}
    assert all(label in got[i] for i, (_, label) in enumerate(WRAPPED)) and got[9] == [""]


def test_filters_lose_no_run_of_lines(spark):
    import random
    rng = random.Random(7)
    lines = []
    for t in [*licenses.TEMPLATES] * 6:
        left = [w for w in t.split() if rng.random() > 0.1]
        while left:
            n = rng.randint(2, 8)
            lines.append(" ".join(left[:n] + rng.choices(["x", "y"], k=rng.randint(0, 2))))
            left = left[n:]
        lines += [""] * rng.randint(0, 1)
    blocks = licenses.template_blocks(frame(spark, [(1, "\n".join(lines))]))
    got = {(r["block"], r["label"]): r["containment"] for r in licenses.containment_join(blocks).orderBy("containment").collect()}
    want = {}
    for i in range(len(lines)):
        held = set(" ".join(lines[i:i + licenses.MAX_LINES]).split())
        for t, label in licenses.TEMPLATES.items():
            t = set(t.split())
            if len(t & held) >= licenses.MIN_CONTAINMENT * len(t):
                want[i, label] = len(t & held) / len(t)
    # the longest run from a line has the most words; shorter ones of the same words stand for it
    assert got == want and len(want) > 15


def test_filters_lose_no_block(spark):
    import random
    rng = random.Random(4)
    vocab = sorted({w for t in licenses.TEMPLATES for w in t.split()})
    lines = []
    for t in licenses.TEMPLATES:
        for _ in range(25):
            words = [w for w in t.split() if rng.random() > 0.15] + rng.sample(vocab, rng.randint(0, 4))
            rng.shuffle(words)
            lines.append(" ".join(words))
    blocks = licenses.template_blocks(frame(spark, [(1, "\n".join(lines))]), 1)
    got = {(r["block"], r["label"]) for r in licenses.containment_join(blocks).collect()}
    want = {(i, label) for i, x in enumerate(lines) for t, label in licenses.TEMPLATES.items()
            if len(set(t.split()) & set(x.split())) >= licenses.MIN_CONTAINMENT * len(set(t.split()))}
    assert got == want and len(want) > 20


# --- snapshots ---------------------------------------------------------------

def _conversations():
    a = [("user", "hi"), ("bot", "hello"), ("user", "bye")]
    out = []
    for conv, turns in {
        1: a, 2: a[:1], 3: a[:2], 4: a, 5: [("user", "hi"), ("bot", "HELLO")], 6: [("user", None)], 7: [("user", "")],
        8: [(None, "x"), ("bot", "y")], None: a[:2], 9: [("user", f"t{i}") for i in range(700)],
        10: [("user", f"t{i}") for i in range(300)], 11: [("user", f"t{i}") for i in range(299)] + [("user", "t300")],
    }.items():
        out += [(conv, k, r, t) for k, (r, t) in enumerate(turns)]
    return out + [(12, None, "user", "first"), (12, 5, "bot", "b"), (12, 5, "a", "tie")]


def test_only_maximal_conversations_stay(spark):
    rows = _conversations()
    hashed = snapshots.turn_hashes(spark.createDataFrame([(*r, 1, "x") for r in rows],
                                   "conv_id long, turn long, role string, text string, n_turns int, chat string").repartition(4))
    got = {r["conv_id"]: (r["n_turns"], r["n_copies"], r["chat"])
           for r in snapshots.render(hashed, snapshots.maximal_conversations(hashed)).collect()}
    show = lambda turns: "".join(f"<|{r or 'unknown'}|>\n{t or ''}<|end|>\n" for r, t in turns)
    of = lambda c: [(r, t) for i, _, r, t in rows if i == c]
    assert got == {1: (3, 2, show(of(1))), 5: (2, 1, show(of(5))), 6: (1, 1, show(of(6))), 7: (1, 1, show(of(7))),
                   8: (2, 1, show(of(8))), 9: (700, 1, show(of(9))), 11: (300, 1, show(of(11))),
                   12: (3, 1, show([("user", "first"), ("a", "tie"), ("bot", "b")]))}


def test_repeated_turns_are_turns(spark):
    rows = [(1, 0, "u", "a"), (1, 0, "u", "a"), (2, 0, "u", "a")]
    hashed = snapshots.turn_hashes(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = [(r["conv_id"], r["n_turns"]) for r in snapshots.maximal_conversations(hashed).collect()]
    assert got == [(1, 2)]
