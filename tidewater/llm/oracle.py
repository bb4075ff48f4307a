"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

import string

from tidewater.llm.licenses import OP5_SQL
from tidewater.llm.sharding import PRIME, ROW_OVERHEAD, SEED, SHARDS, round_keys
from tidewater.llm.snapshots import OP10_SQL

_TEXT = "coalesce(text, '')"
_LOWER = f"translate({_TEXT}, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"

OP2_SQL = f"""
WITH d AS (SELECT doc_id, hex(encode({_TEXT})) AS h, strlen({_TEXT}) AS n FROM documents),
w AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM (SELECT doc_id, h, unnest(range(0, n - 49)) AS i FROM d)),
m AS (SELECT s, min(doc_id) AS lo FROM w GROUP BY s),
g AS (SELECT doc_id, i FROM w JOIN m USING (s) WHERE lo < doc_id),
x AS (SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 50 THEN 0 ELSE 1 END AS brk FROM g),
k AS (SELECT doc_id, i, sum(brk) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM x),
s AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM k GROUP BY doc_id, run),
p AS (SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS before FROM s),
c AS (SELECT doc_id, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept,
             sum(b - a) AS gone, count(*) AS spans, max(b) AS last
      FROM p JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, coalesce(spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept || substr(h, 2 * last + 1), h))) AS kept_sha256
FROM d LEFT JOIN c USING (doc_id)
"""


def _permuted(source: str) -> str:
    """(id, n, a, b, p) of ``source`` with every p sent through the rounds once."""
    sql = f"SELECT id, n, a, b, p // b AS l, p % b AS r FROM ({source})"
    for i, (m, c) in enumerate(round_keys(SEED)):
        x, to = ("l", "r") if i % 2 else ("r", "l")
        side = "b" if i % 2 else "a"
        sql = f"SELECT id, n, a, b, l, r, ({x} * {m} + {c}) % {PRIME} AS y FROM ({sql})"
        sql = f"SELECT * REPLACE (({to} + (y * y) % {PRIME}) % {side} AS {to}) FROM ({sql})"
    return f"SELECT id, n, a, b, l * b + r AS p FROM ({sql})"


# the checksum's table, then a fold over the bytes
_CRC = f"""
t AS (SELECT list(c ORDER BY v) AS tab FROM (
  SELECT v, list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, v) AS c
  FROM range(256) q(v))),
d AS (SELECT doc_id, strlen({_TEXT}) + {ROW_OVERHEAD} AS size, hex(encode({_TEXT})) AS h FROM documents),
c AS (SELECT doc_id, size, xor(list_reduce(
        list_transform(range(0, CAST(len(h) / 2 AS BIGINT)), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT)),
        lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) AS text_crc32
      FROM d, t)"""

OP3_SQL = f"""
WITH RECURSIVE {_CRC},
o AS (SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1 AS id, count(*) OVER () AS n FROM c),
z AS (SELECT id, n, CAST(ceil(sqrt(n)) AS BIGINT) AS a, CAST(ceil(n / ceil(sqrt(n))) AS BIGINT) AS b, id AS p FROM o),
walk AS ({_permuted("SELECT * FROM z")} UNION ALL {_permuted("SELECT * FROM walk WHERE p >= n")})
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(p % {SHARDS} AS INTEGER) AS shard, p // {SHARDS} AS slot,
       CAST(NULL AS INTEGER) AS grown_shard, o.id AS row_number
FROM o JOIN walk ON o.id = walk.id WHERE p < walk.n
"""

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
OP4_SQL = f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
g AS (SELECT h, max(page_id) AS keeper, array_to_string(list_transform(range(0, 32), lambda i: substr('{_BASE32}',
        ((CAST('0x' || substr(h, 5 * (i // 4) + 1, 5) AS BIGINT) >> (5 * (3 - i % 4))) & 31) + 1, 1)), '') AS payload_digest
      FROM p GROUP BY h)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> keeper THEN keeper END AS refers_to
FROM p JOIN g USING (h)
"""

OP9_SQL = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, shingle FROM (
  SELECT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(0, len(w) - 4), lambda i: array_to_string(w[i + 1:i + 5], ' '))
                             WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS shingle FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
      GROUP BY a.doc_id, b.doc_id),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS other FROM w UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.other)
SELECT w.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(other) AS component_id
FROM w JOIN r USING (doc_id) LEFT JOIN n USING (doc_id) GROUP BY w.doc_id
"""

_WORDS = r"regexp_extract_all(t, '[^\x20\x09-\x0D]+')"
OP11_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, {_WORDS} AS w, min(doc_id) OVER (PARTITION BY t) AS lo FROM d),
f AS (SELECT doc_id, part, len(w) < 100 AS a, 100 * len(list_distinct(w)) < 80 * len(w) AS b,
             100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) AS c,
             regexp_matches(t, '[#$%&*|]') AS d, coalesce(doc_id > lo, false) AS e FROM w),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
n AS (SELECT part, [a, b, c, d, e] AS fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
      FROM f LEFT JOIN l USING (doc_id) GROUP BY part, [a, b, c, d, e]),
k(k) AS (VALUES (1), (2), (3), (4), (5)),
o AS (SELECT [p.k, q.k, r.k, s.k, 15 - p.k - q.k - r.k - s.k] AS o FROM k p, k q, k r, k s
      WHERE len(list_distinct([p.k, q.k, r.k, s.k])) = 4),
x AS (SELECT part, o, k AS step, fails, n, good, toxic, fails[o[k]] AS here,
             len(list_filter(o[1:k - 1], lambda i: fails[i])) > 0 AS gone,
             len(list_filter(fails, lambda i: i)) AS n_fails FROM n, o, k),
r AS (SELECT part, o, step, coalesce(sum(n) FILTER (NOT here AND NOT gone), 0) AS kept, coalesce(sum(n) FILTER (here AND NOT gone), 0) AS removed,
             coalesce(sum(n) FILTER (here AND gone), 0) AS redundant, coalesce(sum(n) FILTER (here AND n_fails = 1), 0) AS unique_fails,
             coalesce(sum(good) FILTER (here AND NOT gone), 0) AS good_lost, coalesce(sum(toxic) FILTER (here AND NOT gone), 0) AS toxic_lost
      FROM x GROUP BY part, o, step)
SELECT part, array_to_string(list_transform(o, lambda i: chr(64 + i)), '') AS filter_order, step, chr(64 + o[step]) AS filter,
       kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
       good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, o[step]))::BIGINT AS shapley
FROM r
"""

# checksums of all distinct (document, run) pairs; edits meet in words with one place deleted or left open
OP12_SQL = rf"""
WITH RECURSIVE {_CRC.split("d AS")[0].strip().rstrip(",")},
r AS (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents),
g AS (SELECT doc_id, run, count(*) AS n, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS h FROM r GROUP BY doc_id, run),
c AS (SELECT run, n, xor(list_reduce(
        list_transform(range(0, CAST(len(h) / 2 AS BIGINT)), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT)),
        lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) AS crc FROM g, t),
w AS (SELECT CASE WHEN crc % 97 = 0 THEN left(run, crc % length(run)) || substr(run, crc % length(run) + 2) ELSE run END AS word, n FROM c),
v AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM w WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
e AS (SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS cut, left(word, i - 1) || '*' || substr(word, i + 1) AS open
      FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)),
p AS (SELECT e.word AS a, e.n AS an, v.word AS b, v.n AS bn FROM e JOIN v ON e.cut = v.word
      UNION SELECT x.word, x.n, y.word, y.n FROM e x JOIN e y ON x.open = y.open AND x.word < y.word),
q AS (SELECT a AS word, an AS n, b AS other, bn AS other_n FROM p UNION ALL SELECT b, bn, a, an FROM p),
b AS (SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS other, max(other_n) AS other_n FROM q GROUP BY word),
f AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 2 * n THEN other END AS form,
             CASE WHEN other_n >= 2 * n THEN other_n END AS form_n FROM v LEFT JOIN b USING (word)),
k AS (SELECT word, word AS at, form AS further FROM f
      UNION ALL SELECT k.word, f.word, f.form FROM k JOIN f ON f.word = k.further)
SELECT f.word, form, k.at AS root, n, n_near, form_n FROM f JOIN k ON k.word = f.word AND k.further IS NULL
"""

ORACLE = {
    "op2_merged_repeats": OP2_SQL,
    "op3_feistel_shards": OP3_SQL,
    "op4_splittable_warc": OP4_SQL,
    "op5_license_join": OP5_SQL,
    "op9_vertical_jaccard": OP9_SQL,
    "op10_snapshot_chats": OP10_SQL,
    "op11_filter_audit": OP11_SQL,
    "op12_spelling_groups": OP12_SQL,
}
