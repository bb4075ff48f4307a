"""Removal of repeated 50-byte strings across documents, by merged suffix orders.

A byte is removed when it lies in a string of ``LENGTH`` bytes that also starts
in a document with a smaller id.

1. Every string of ``LENGTH`` bytes belongs to the smallest hash among its
   ``GRAM``-byte grams; consecutive strings with the same one form a fragment.
   Equal strings have equal smallest hashes, so only fragments whose hash is
   met in two documents can hold a match. Hashes are dealt to buckets as packed
   integers, and each slice of documents gets back those that are shared.
2. Slices deal their distinct fragments of shared hashes, with the smallest id
   that holds each. Equal fragments are counted once, and those that are alone
   under their hash are done with. Of the others a bucket builds the Burrows-Wheeler transforms of shards of
   its fragments, merges them by interleave refinement to depth ``LENGTH`` and
   takes the intervals of suffixes that share at least so many bytes. The
   smallest id in an interval tells which of its strings are repeats.
3. Slices get back a bit per string and mark, join and cut their documents'
   spans. Both visits of a slice read the same exchange of the texts.

Slices and buckets are as many as shuffle partitions. What a fragment's copies
send is reduced to one row per slice, so a passage that a third of all rows
hold is no larger than the slices are many.

Defined results: a null text has no bytes, and the checksum of nothing. A null
id is smaller than any other. Rows with equal ids don't remove each other's
bytes. A text that is repeated as a whole is left empty, and its row stays. An
empty table gives an empty table. ``drop_repeats`` passes other columns on and
replaces the text; ``n_chars``, where it is a whole number, follows the text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.bwt import merge, transform
from tidewater.llm.common import (BATCH_ROWS, arrow_schema, free_name, map_batches, materialize, shuffle_tasks, small_batches, table,
                                  text_chunks, tidy_worker)

LENGTH = 50
GRAM = 18
MAX_WINDOWS = 200         # strings in a fragment; longer runs make several
CHUNK_BYTES = 1 << 17     # text hashed at once
FLUSH_BYTES = 8_000_000   # text whose hashes a task deals at once
MERGE_BYTES = 1 << 18     # fragments merged at once, unless one hash has more
ROUND_BYTES = 1 << 22     # packed fragments of a bucket unpacked at once, dealt to rounds by their hashes
MARK_FRAGMENTS = 1 << 14  # fragments whose strings are marked at once
SLICE_FRAGMENTS = 1 << 16 # fragments of a slice told apart at once
DEAL_BYTES = 1 << 22      # packed fragments that leave a slice at once
DEAL_ROWS = 2500          # texts that go to Python at once where their hashes are dealt; a deal of more names its slices less often
SHARDS = 4
NULL_ID = -(1 << 63)
NODE, SLICE = "_dd_node", "_dd_slice"   # an input's columns of these names are renamed meanwhile

_C = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]
_LOW = np.uint64(0xFFFFFFFF)


def gram_hashes(x: np.ndarray, size: int = GRAM) -> np.ndarray:
    """A hash of every ``size`` bytes, from those of powers of two."""
    h = x.astype(np.uint64) * _C[0]
    h ^= h >> np.uint64(32)
    n, out, at, width = len(x) - size + 1, None, 0, 1
    todo = size
    while todo:
        if todo & 1:
            piece = h[at:at + n]
            out = piece.copy() if out is None else out * _C[2] + piece
            at += width
        todo >>= 1
        if todo:
            m = len(h) - width
            h = h[:m] * _C[1] + h[width:]
            h ^= h >> np.uint64(29)
            width *= 2
    out *= _C[0]
    return out ^ (out >> np.uint64(31))


def window_owners(x: np.ndarray) -> np.ndarray:
    """The smallest gram hash of every string of ``LENGTH`` bytes."""
    cur, have, want = gram_hashes(x), 1, LENGTH - GRAM + 1
    while have * 2 <= want:
        cur = np.minimum(cur[:-have], cur[have:])
        have *= 2
    return np.minimum(cur[:len(cur) - (want - have)], cur[want - have:]) if have < want else cur


def fragments(texts: list[bytes]) -> Iterator[tuple[int, bytes, np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of strings with one owner: (first text, bytes, starts, counts, owners) per chunk.

    Starts count from the beginning of the chunk's bytes.
    """
    first, size = 0, 0
    for i in range(len(texts) + 1):
        if i == len(texts) or size >= CHUNK_BYTES:
            if size >= LENGTH:
                raw = b"".join(texts[first:i])
                owner = window_owners(np.frombuffer(raw, np.uint8))
                ends = np.cumsum([len(t) for t in texts[first:i]])
                at = np.arange(len(owner))
                end = np.repeat(ends, [len(t) for t in texts[first:i]])[:len(owner)]
                inside = at + LENGTH <= end
                new = np.r_[True, (owner[1:] != owner[:-1]) | (inside[1:] != inside[:-1]) | (end[1:] != end[:-1])]
                start = np.flatnonzero(new)
                count = np.diff(np.r_[start, len(owner)])
                ok = inside[start]
                start, count = start[ok], count[ok]
                if len(count) and count.max() > MAX_WINDOWS:
                    parts = -(-count // MAX_WINDOWS)
                    nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
                    start = np.repeat(start, parts) + nth * MAX_WINDOWS
                    count = np.minimum(np.repeat(count, parts) - nth * MAX_WINDOWS, MAX_WINDOWS)
                yield first, raw, start, count, owner[start]
            first, size = i, 0
        if i < len(texts):
            size += len(texts[i])


def _keys(owner: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of an owner hash, and 32 bits that name it there."""
    return (owner % np.uint64(buckets)).astype(np.int64), (owner // np.uint64(buckets) & _LOW).astype(np.uint32)


def sliced(docs: DataFrame, slices: int) -> DataFrame:
    """``docs`` with the hash that orders rows in a slice, and their slice."""
    node = F.xxhash64("doc_id", "text")
    return docs.withColumns({NODE: node, SLICE: F.pmod(node, F.lit(slices)).cast("int")})


def owner_blocks(docs: DataFrame, parts: int) -> DataFrame:
    """(bucket, block): owner hashes of documents by slice; twice if two documents of a deal have it."""
    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        for first, texts in text_chunks(batch, "text", FLUSH_BYTES):
            raw = [(t or "").encode() for t in texts]
            where = batch.column(SLICE).slice(first, len(texts)).to_numpy(zero_copy_only=False).astype(np.int64)
            rows, owners = [], []
            for at, data, start, _, owner in fragments(raw):
                ends = np.cumsum([len(t) for t in raw[at:at + _texts_in(raw, at, len(data))]])
                rows.append(at + np.searchsorted(ends, start, "right"))
                owners.append(owner)
            if not owners:
                continue
            row, owner = np.concatenate(rows), np.concatenate(owners)
            bucket, key = _keys(owner, parts)
            to = where[row]
            by = np.lexsort((key, to, bucket))               # three keys: packed, they don't fit into 64 bits
            bucket, to, key, row = bucket[by], to[by], key[by], row[by]
            same = np.r_[False, (bucket[1:] == bucket[:-1]) & (to[1:] == to[:-1]) & (key[1:] == key[:-1])]
            other = np.r_[False, row[1:] != row[:-1]]
            again = np.flatnonzero(same & other)             # a second document
            keep = ~same
            starts = np.maximum.accumulate(np.where(keep, np.arange(len(key)), 0))
            second = np.unique(starts[again], return_index=True)[1] if len(again) else again
            keep[again[second]] = True
            bucket, to, key = bucket[keep], to[keep], key[keep].astype("<u4")
            cut = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
            yield {"bucket": bucket[cut], "block": [_pack_keys(to[i:j], key[i:j]) for i, j in zip(cut, [*cut[1:], len(key)])]}

    slim = docs.select(SLICE, F.col("text").cast("string").alias("text"))
    return map_batches(slim, run, "bucket int, block binary")


def _pack_keys(where: np.ndarray, keys: np.ndarray) -> bytes:
    """Keys sorted by slice: slices u32, then each slice and its number of keys, then the keys."""
    cut = np.flatnonzero(np.r_[True, where[1:] != where[:-1]])
    counts = np.diff(np.r_[cut, len(where)])
    head = np.r_[len(cut), where[cut], counts].astype("<u4")
    return head.tobytes() + keys.tobytes()


def _unpack_keys(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int(np.frombuffer(block, "<u4", 1)[0])
    head = np.frombuffer(block, "<u4", 2 * n, 4)
    return np.repeat(head[:n].astype(np.int64), head[n:]), np.frombuffer(block, "<u4", -1, 4 + 8 * n)


def shared_owners(blocks: DataFrame) -> DataFrame:
    """(slice, bucket, block): for each slice its owner hashes that several documents have."""
    kind = "slice int, bucket int, block binary"
    schema = arrow_schema(kind)

    def run(group: pa.Table) -> pa.Table:
        where, key = (np.concatenate(x) for x in zip(*map(_unpack_keys, group.column("block").to_pylist())))
        by = np.argsort(key, kind="stable")
        key, where = key[by], where[by]
        new = np.r_[True, key[1:] != key[:-1], True]
        some = ~(new[1:] & new[:-1])
        key, where = key[some], where[some]
        by = np.argsort(where, kind="stable")
        key, where = key[by], where[by]
        cut = np.flatnonzero(np.r_[True, where[1:] != where[:-1]]) if len(where) else np.zeros(0, np.int64)
        blocks_ = [np.unique(key[i:j]).tobytes() for i, j in zip(cut, [*cut[1:], len(key)])]
        return pa.Table.from_arrays([pa.array(where[cut], pa.int32()),
                                     pa.array(np.full(len(cut), group.column("bucket")[0].as_py()), pa.int32()),
                                     pa.array(blocks_, pa.binary())], schema=schema)

    return blocks.groupBy("bucket").applyInArrow(run, kind)


class _Pieces:
    """Distinct fragments of a slice's bytes, cut out when they are asked for."""

    def __init__(self, raw: bytes, start: np.ndarray, size: np.ndarray) -> None:
        self.raw, self.start, self.size = raw, start, size

    def __len__(self) -> int:
        return len(self.start)

    def __getitem__(self, k: int) -> bytes:
        if not 0 <= k < len(self.start):
            raise IndexError(k)
        return self.raw[self.start[k]:self.start[k] + self.size[k]]


class _Slice:
    """A slice's documents in canonical order, and its distinct fragments of shared hashes.

    Texts and fragments are places in the slice's bytes, and fragments are told apart some hashes at a time: where every
    hash is shared, a Python object for each fragment would take many times the text."""

    def __init__(self, docs: pa.Table, shared: pa.Table, parts: int) -> None:
        node = docs.column(NODE).to_numpy()
        self.order = np.argsort(node, kind="stable")
        column = docs.column("text")
        texts = [(column[i].as_py() or "").encode() for i in self.order.tolist()]
        lengths = np.array([len(t) for t in texts], np.int64)
        ends = np.cumsum(lengths)
        raw = b"".join(texts)
        del texts
        view = memoryview(raw)
        self.texts = [view[j - n:j] for n, j in zip(lengths.tolist(), ends.tolist())]
        ids = docs.column("doc_id").to_pylist()
        self.ids = np.array([NULL_ID if ids[i] is None else ids[i] for i in self.order.tolist()], np.int64)
        known = [np.frombuffer(b, "<u4").astype(np.int64) | k << 32 for k, b in
                 zip(shared.column("bucket").to_pylist(), shared.column("block").to_pylist())]
        known = np.sort(np.concatenate(known)) if known else np.zeros(0, np.int64)
        names, starts, counts = [], [], []
        for first, _, start, count, owner in fragments(self.texts):
            bucket, key = _keys(owner, parts)
            name = bucket << 32 | key.astype(np.int64)
            hit = np.zeros(len(name), bool)
            if len(known):
                hit = known[np.minimum(np.searchsorted(known, name), len(known) - 1)] == name
            names.append(name[hit])
            starts.append(start[hit] + (ends[first] - lengths[first]))
            counts.append(count[hit].astype(np.int32))
        del known
        none = np.zeros(0, np.int64)
        name, begin, self.count = (np.concatenate(x) if x else none for x in (names, starts, counts))
        del names, starts, counts
        self.row = np.searchsorted(ends, begin, "right").astype(np.int32)
        self.start = (begin - (ends - lengths)[self.row]).astype(np.int32) if len(begin) else none
        self.which = np.zeros(len(begin), np.int32)
        found = [none]                 # the first of equal fragments
        rounds = max(1, -(-len(begin) // SLICE_FRAGMENTS))
        turn = (name & _LOW.astype(np.int64)) % rounds        # equal fragments have equal hashes
        base = 0
        for r in range(rounds):
            at = np.flatnonzero(turn == r)
            index: dict[bytes, int] = {}
            which = np.fromiter((index.setdefault(raw[i:i + n + LENGTH - 1], len(index)) for i, n in
                                 zip(begin[at].tolist(), self.count[at].tolist())), np.int64, len(at))
            new = np.zeros(len(index), np.int64)
            new[which[::-1]] = at[::-1]
            self.which[at] = base + which
            found.append(new)
            base += len(index)
            del index, which
        one = np.concatenate(found)
        self.bucket, self.key = name[one] >> 32, (name[one] & _LOW.astype(np.int64)).astype(np.uint32)
        self.least = np.full(len(one), np.iinfo(np.int64).max)
        for k in range(0, len(begin), SLICE_FRAGMENTS):
            np.minimum.at(self.least, self.which[k:k + SLICE_FRAGMENTS], self.ids[self.row[k:k + SLICE_FRAGMENTS]])
        self.pieces = _Pieces(raw, begin[one], self.count[one].astype(np.int64) + LENGTH - 1)

    def dealt(self) -> tuple[np.ndarray, np.ndarray]:
        """Fragment numbers by bucket, in canonical order, and the first of each bucket."""
        by = np.argsort(self.bucket, kind="stable")
        cut = np.flatnonzero(np.r_[True, np.diff(self.bucket[by]) != 0]) if len(by) else np.zeros(0, np.int64)
        return by, cut


def _texts_in(texts: list[bytes], first: int, size: int) -> int:
    n = 0
    while size > 0:
        size -= len(texts[first + n])
        n += 1
    return n


_ITEM = np.dtype([("key", "<u4"), ("size", "<u2"), ("least", "<i8")])
BLOCKS = "slice int, kind int, bucket int, block binary"


def _pack(s: _Slice, at: np.ndarray) -> bytes:
    item = np.zeros(len(at), _ITEM)
    item["key"], item["size"], item["least"] = s.key[at], s.pieces.size[at], s.least[at]
    return np.array([len(at)], "<u4").tobytes() + item.tobytes() + b"".join([s.pieces[i] for i in at.tolist()])


def _dealt_blocks(s: _Slice, by: np.ndarray, cut: np.ndarray, here: int, schema: pa.Schema) -> Iterator[pa.Table]:
    """The slice's rows of :data:`BLOCKS`, some bytes at a time."""
    ends, packed, first = [*cut[1:].tolist(), len(by)], [], 0
    for k, (i, j) in enumerate(zip(cut.tolist(), ends)):
        packed.append(_pack(s, by[i:j]))
        if k + 1 == len(ends) or sum(map(len, packed)) > DEAL_BYTES:
            n = len(packed)
            yield pa.Table.from_arrays([pa.array(np.full(n, here), pa.int32()), pa.array(np.full(n, 2), pa.int32()),
                                        pa.array(s.bucket[by[cut[first:k + 1]]], pa.int32()), pa.array(packed, pa.binary())], schema=schema)
            packed, first = [], k + 1


def _unpack(block: memoryview) -> tuple[np.ndarray, np.ndarray]:
    """A block's items, and where their fragments end in it."""
    n = int(np.frombuffer(block, "<u4", 1)[0])
    item = np.frombuffer(block, _ITEM, n, 4)
    return item, np.cumsum(item["size"].astype(np.int64)) + 4 + n * _ITEM.itemsize


def interval_minima(pieces: list[bytes], least: np.ndarray) -> list[np.ndarray]:
    """For each piece, per string of ``LENGTH`` bytes, the smallest ``least`` of pieces that hold it.

    The pieces' shards are transformed, merged and cut into intervals of
    suffixes that share at least ``LENGTH`` bytes.
    """
    cuts = [range(i, len(pieces), SHARDS) for i in range(min(SHARDS, len(pieces)))]
    shards = [transform([pieces[i] for i in c]) for c in cuts]
    order, _, first = merge(shards, LENGTH)
    size = np.array([len(p) for p in pieces], np.int64)
    owner = np.concatenate([np.repeat(np.array(c), size[c] + 1)[s.place] for c, s in zip(cuts, shards)])
    offset = np.concatenate([(np.arange(len(s.place)) - np.repeat(np.cumsum(size[c] + 1) - size[c] - 1, size[c] + 1))[s.place]
                             for c, s in zip(cuts, shards)])
    owner, offset = owner[order], offset[order]
    low = np.minimum.reduceat(least[owner], first)
    low = np.repeat(low, np.diff(np.r_[first, len(order)]))
    whole = offset + LENGTH <= size[owner]
    windows = size - LENGTH + 1
    start = np.cumsum(windows) - windows
    out = np.empty(int(windows.sum()), np.int64)
    out[start[owner[whole]] + offset[whole]] = low[whole]
    return np.split(out, start[1:])


def repeat_bits(blocks: list[memoryview]) -> list[bytes]:
    """For each of a bucket's blocks a bit per string of its fragments: held under a smaller id elsewhere.

    Fragments of different hashes share no string, so those of some hashes are unpacked and
    merged at a time, and memory beside the packed blocks doesn't grow with the bucket.
    """
    unpacked = [_unpack(x) for x in blocks]
    windows = [item["size"].astype(np.int64) - LENGTH + 1 for item, _ in unpacked]
    out = [np.zeros(int(n.sum()), bool) for n in windows]
    rounds = max(1, -(-sum(len(x) for x in blocks) // ROUND_BYTES))
    for r in range(rounds):
        taken = [np.flatnonzero(item["key"] % np.uint32(rounds) == r) for item, _ in unpacked]
        index: dict[bytes, int] = {}
        which = []
        for x, (item, end), at in zip(blocks, unpacked, taken):
            size = item["size"][at].tolist()
            which.append(np.array([index.setdefault(bytes(x[e - k:e]), len(index)) for e, k in zip(end[at].tolist(), size)], np.int64))
        least = np.full(len(index), np.iinfo(np.int64).max)
        key = np.zeros(len(index), np.int64)
        for (item, _), at, names in zip(unpacked, taken, which):
            np.minimum.at(least, names, item["least"][at])
            key[names] = item["key"][at]
        low = _least_holders(list(index), least, key)
        for (item, _), n, hit, at, names in zip(unpacked, windows, out, taken, which):
            if len(at):
                begin = (np.cumsum(n) - n)[at]
                n = n[at]
                flat = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                held = np.concatenate([low[k] for k in names.tolist()])
                hit[np.repeat(begin, n) + flat] = held < np.repeat(item["least"][at], n)
    return [np.packbits(hit).tobytes() for hit in out]


def _least_holders(pieces: list[bytes], least: np.ndarray, key: np.ndarray) -> list[np.ndarray]:
    """For each of distinct fragments with their smallest ids and hashes what :func:`interval_minima` tells."""
    by = np.argsort(key, kind="stable")
    size = np.array([len(pieces[i]) + 1 for i in by.tolist()], np.int64)
    # fragments of different hashes share no string: they needn't be merged together,
    # and one that is alone under its hash has nothing to be merged with
    new_key = np.r_[True, np.diff(key[by]) != 0] if len(by) else np.zeros(0, bool)
    low: list[np.ndarray | None] = [None] * len(pieces)
    alone = new_key & np.r_[new_key[1:], True][:len(by)]
    for k in by[alone].tolist():
        low[k] = np.full(len(pieces[k]) - LENGTH + 1, least[k])
    by, size = by[~alone], size[~alone]
    new_key = np.r_[True, np.diff(key[by]) != 0]
    begin, held = 0, 0
    for i in range(len(by) + 1):
        if i > begin and (i == len(by) or (new_key[i] and held >= MERGE_BYTES)):
            some = by[begin:i]
            for k, v in zip(some.tolist(), interval_minima([pieces[k] for k in some.tolist()], least[some])):
                low[k] = v
            begin, held = i, 0
        if i < len(by):
            held += size[i]
    return low


def repeated_strings(dealt: DataFrame) -> DataFrame:
    """Per slice and bucket a bit for each string of its fragments: held under a smaller id elsewhere."""
    schema = arrow_schema(BLOCKS)

    def run(group: pa.Table) -> pa.Table:
        slices = group.column("slice").to_pylist()
        bits = repeat_bits([memoryview(x.as_buffer()) for x in group.column("block")])
        out = pa.Table.from_arrays([pa.array(slices, pa.int32()), pa.array([1] * len(slices), pa.int32()),
                                    group.column("bucket").combine_chunks(), pa.array(bits, pa.binary())], schema=schema)
        tidy_worker(keep=True)
        return out

    return dealt.groupBy("bucket").applyInArrow(run, BLOCKS)


def _marked(s: _Slice, marks: pa.Table) -> list[np.ndarray]:
    """Per document, in canonical order, which bytes go."""
    by, cut = s.dealt()
    windows = s.pieces.size - LENGTH + 1
    bits = dict(zip(marks.column("bucket").to_pylist(), marks.column("block").to_pylist()))
    start = np.cumsum(windows) - windows
    hit = np.zeros(int(windows.sum()), bool)
    for i, j in zip(cut.tolist(), [*cut[1:].tolist(), len(by)]):
        at = by[i:j]
        n = windows[at]
        flat = np.unpackbits(np.frombuffer(bits[s.bucket[at[0]]], np.uint8), count=int(n.sum())).astype(bool)
        hit[np.repeat(start[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())] = flat
    del bits
    sizes = np.array([len(t) for t in s.texts], np.int64)
    begin = np.cumsum(sizes) - sizes
    change = np.zeros(int(sizes.sum()) + 1, np.int32)
    for k in range(0, len(s.row), MARK_FRAGMENTS):
        row, which, n = (x[k:k + MARK_FRAGMENTS] for x in (s.row, s.which, s.count))
        flat = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        gone = np.repeat(s.ids[row] > s.least[which], n) | hit[np.repeat(start[which], n) + flat]
        at = (np.repeat(begin[row] + s.start[k:k + MARK_FRAGMENTS], n) + flat)[gone]
        np.add.at(change, at, 1)
        np.add.at(change, at + LENGTH, -1)
    np.cumsum(change, out=change)
    return np.split(change[:-1] > 0, begin[1:])


def _in_pieces(rows: pa.Table) -> pa.Table:
    """``rows`` that the executor gets, and holds, some at a time."""
    return pa.concat_tables([rows.slice(k, BATCH_ROWS) for k in range(0, max(1, rows.num_rows), BATCH_ROWS)])


def _with_spans(docs: DataFrame, finish, kind: str, parts: int | None = None) -> DataFrame:
    """``finish(documents, slice, marks)`` for every slice of ``docs``, to rows of ``kind``."""
    parts = parts or shuffle_tasks(docs.sparkSession)
    docs = sliced(docs, parts)
    with small_batches(docs.sparkSession, DEAL_ROWS):
        shared = materialize(shared_owners(owner_blocks(docs, parts)), "owners")
    shared = shared.select("slice", F.lit(0).alias("kind"), "bucket", "block")
    schema = arrow_schema(BLOCKS)
    out_schema = arrow_schema(kind)

    def side(blocks: pa.Table, which: int) -> pa.Table:
        return blocks.filter(pa.array(blocks.column("kind").to_numpy() == which))

    def deal(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        s = _Slice(left, right, parts)
        by, cut = s.dealt()
        here = right.column("slice")[0].as_py()
        out = pa.concat_tables([schema.empty_table(), *_dealt_blocks(s, by, cut, here, schema)])
        del s, by
        tidy_worker(keep=True)
        return out

    def cut_out(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return out_schema.empty_table()
        s = _Slice(left, side(right, 0), parts)
        out = _in_pieces(finish(left, s, _marked(s, side(right, 1))))
        del s
        tidy_worker()
        return out

    by_slice = docs.groupBy(SLICE)
    dealt = by_slice.cogroup(shared.groupBy("slice")).applyInArrow(deal, BLOCKS)
    return by_slice.cogroup(shared.union(repeated_strings(dealt)).groupBy("slice")).applyInArrow(cut_out, kind)


def repeat_report(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    ``parts`` slices and buckets; as many as shuffle partitions if not given."""
    kind = (f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_removed long, n_spans long, "
            "kept_sha256 string")
    schema = arrow_schema(kind)

    def finish(left: pa.Table, s: _Slice, gone: list[np.ndarray]) -> pa.Table:
        spans = [int(g[0]) + int(np.count_nonzero(g[1:] & ~g[:-1])) if len(g) else 0 for g in gone]
        kept = [hashlib.sha256(np.frombuffer(t, np.uint8)[~g].tobytes()).hexdigest() for t, g in zip(s.texts, gone)]
        return pa.Table.from_arrays([
            left.column("doc_id").take(pa.array(s.order)), pa.array([len(t) for t in s.texts], pa.int64()),
            pa.array([int(g.sum()) for g in gone], pa.int64()), pa.array(spans, pa.int64()), pa.array(kept)], schema=schema)

    return _with_spans(docs.select("doc_id", F.col("text").cast("string").alias("text")), finish, kind, parts)


def drop_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated spans cut out of the texts, whole characters only."""
    whole = docs.schema["n_chars"].dataType.simpleString() in ("bigint", "int") if "n_chars" in docs.columns else False
    given = docs.columns
    docs = docs.toDF(*[c if c.lower() not in (NODE, SLICE) else free_name(docs, c) for c in given])
    names = docs.columns

    def finish(left: pa.Table, s: _Slice, gone: list[np.ndarray]) -> pa.Table:
        rows = left.take(pa.array(s.order)).select(names)
        old = rows.column("text").to_pylist()
        new = [t if not g.any() else _kept_text(raw, g) for t, raw, g in zip(old, s.texts, gone)]
        put = {"text": pa.array(new, rows.schema.field("text").type)}
        if whole:
            chars = [n if a is b else len(b) for n, a, b in zip(rows.column("n_chars").to_pylist(), old, new)]
            put["n_chars"] = pa.array(chars, rows.schema.field("n_chars").type)
        for c, v in put.items():
            rows = rows.set_column(names.index(c), rows.schema.field(c), v)
        return rows

    return _with_spans(docs, finish, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)).toDF(*given)


def _kept_text(raw: bytes, gone: np.ndarray) -> str:
    x = np.frombuffer(raw, np.uint8)
    char = np.cumsum((x & 0xC0) != 0x80) - 1
    touched = np.bincount(char[gone], minlength=char[-1] + 1) > 0
    return x[~touched[char]].tobytes().decode()


def op2_merged_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_report(table(spark, sf_dir, "documents"))
