"""Byte-level BPE by a lazily determinised transducer, and streaming decode.

A sequence of tokens is the BPE encoding of its bytes exactly if every two
neighbours are the encoding of theirs. So the merges compile to a transducer
over bytes: it holds a token just ended and a place in the trie of tokens, and
may end a token only after a neighbour that it goes with. Of the tokenisations
of a prefix that go on, each ends in a different place, so there are at most as
many of them as bytes in the longest token. The determinised machine's state is
that set with the tokens in which its members differ; tokens that all members
share are put out as soon as that is so, which is after a lookahead of at most
the longest token. States and transitions are made when a text first needs
them and kept per worker; beyond ``MAX_STATES`` those go that no later text
came through.

:func:`encode` and :func:`decode` work on columns, document by document. A
null text counts as empty and gives no ids; empty and repeated texts are
nothing special, extra columns and their names stay as they are (the output
column's name must be free). Texts are worked on whole, in time linear in
their length. Ids that don't decode to UTF-8 give U+FFFD for every broken
sequence in :func:`decode_stream` and stay as they are in :func:`decode`.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import arrow_schema, table, text_chunks, tidy_worker, worker_cache

RANKS = "byte_bpe_multi_50k.tiktoken"
MAX_STATES = 300_000       # of the determinised transducer, per worker
MAX_PIECES = 400_000       # pieces of text whose ids a worker remembers
MAX_PIECE_CHARS = 48       # longer pieces aren't remembered
BATCH_PIECES = 20_000      # pieces that go through the transducer together
LONG_PIECE = 1024          # longer pieces go by themselves
CHUNK_BYTES = 2 << 20      # text that a task holds beside its batch
DECODE_IDS = 1 << 16       # ids that the streaming decoder takes at a time
DECODE_ROWS_IDS = 1 << 20  # ids of rows that are decoded together
NO_RANK = 1 << 60
BITS = 24                  # of a place in the trie
PLACE = (1 << BITS) - 1
GONE = -1
LOOK = 32                  # longer tokens that are tried before one is taken to go on
MAX_NEIGHBOURS = 1_000_000 # pairs of tokens that a worker remembers when states are dropped


def ranks_path(name: str = RANKS) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def piece_pattern() -> str:
    """The pattern that cuts texts into pieces before the merges."""
    import public_tokenizers

    return public_tokenizers.PATTERN


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


# -- the merges -------------------------------------------------------------

class Merges:
    """Which tokens the merges reach, what they are merged from, and which go side by side."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.longest = max(map(len, ranks))
        self._split: dict[bytes, tuple[bytes, bytes] | None] = {}

    def merged(self, data: bytes, until: int = 1) -> list[bytes]:
        """The lowest-ranked neighbours merged (leftmost first) until ``until`` parts are left or none can be."""
        parts = [data[i:i + 1] for i in range(len(data))]
        rank = self.ranks.get
        pairs = [rank(a + b, NO_RANK) for a, b in zip(parts, parts[1:])]
        while len(parts) > until:
            low = min(pairs)
            if low == NO_RANK:
                break
            i = pairs.index(low)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i:
                pairs[i - 1] = rank(parts[i - 1] + parts[i], NO_RANK)
            if i < len(pairs):
                pairs[i] = rank(parts[i] + parts[i + 1], NO_RANK)
        return parts

    def split(self, token: bytes) -> tuple[bytes, bytes] | None:
        """The two parts of which the merges make the token; none for a byte or one they don't reach."""
        if token not in self._split:
            parts = self.merged(token, 2) if len(token) > 1 else []
            whole = len(parts) == 2 and parts[0] + parts[1] in self.ranks
            self._split[token] = (parts[0], parts[1]) if whole else None
        return self._split[token]

    def reached(self, token: bytes) -> bool:
        return len(token) == 1 or self.split(token) is not None

    def beside(self, left: bytes, right: bytes) -> bool:
        """Whether the merges of ``left + right`` give just these two tokens.

        Undoes the merges at the border, the later one first, and looks for one
        across it that came before. At equal rank the left one comes first.
        """
        rank, before = self.ranks, NO_RANK
        while True:
            if rank.get(left + right, NO_RANK) < before:
                return False
            of_left, of_right = self.split(left), self.split(right)
            if of_left is None and of_right is None:
                return True
            if of_right is None or (of_left is not None and rank[left] > rank[right]):
                before, left = rank[left], of_left[1]
            else:
                before, right = rank[right] + 1, of_right[0]


# -- the transducer ---------------------------------------------------------

def _places(member: int) -> list[int]:
    """The tokens of a member that are not yet put out, then its place."""
    out = [member & PLACE]
    while member := member >> BITS:
        out.append(member & PLACE)
    return out[::-1]


class Transitions:
    """A hash table in arrays: (state << 8 | byte) -> (next state, ids that come out), looked up for many at once."""

    def __init__(self, keys: np.ndarray, to: np.ndarray, out: np.ndarray, slots: int = 1 << 12) -> None:
        while slots < 4 * len(keys):
            slots *= 2
        self._keys = np.full(slots, -1, np.int64)
        self._to, self._out = np.zeros(slots, np.int32), np.zeros(slots, np.int32)
        self.size = 0
        self.add(keys, to, out)

    def _place(self, keys: np.ndarray) -> np.ndarray:
        """The slot of every key, or the empty one where it belongs."""
        last = len(self._keys) - 1
        at = (keys * np.int64(0x9E3779B97F4A7C1) >> np.int64(20)) & last
        todo = np.flatnonzero((self._keys[at] != keys) & (self._keys[at] != -1))
        while len(todo):
            at[todo] = (at[todo] + 1) & last
            held = self._keys[at[todo]]
            todo = todo[(held != keys[todo]) & (held != -1)]
        return at

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(found, next states, numbers of the ids)"""
        at = self._place(keys)
        return self._keys[at] == keys, self._to[at], self._out[at]

    def add(self, keys: np.ndarray, to: np.ndarray, out: np.ndarray) -> None:
        """Add keys that are all different and not there yet."""
        if 2 * (self.size + len(keys)) > len(self._keys):
            old = self.all()
            self.__init__(*old, slots=4 * len(self._keys))
        left = np.arange(len(keys))
        while len(left):
            at = self._place(keys[left])
            self._keys[at] = keys[left]            # of two for one slot the later one stays
            won = self._keys[at] == keys[left]
            self._to[at[won]], self._out[at[won]] = to[left[won]], out[left[won]]
            left = left[~won]
        self.size += len(keys)

    def all(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at = np.flatnonzero(self._keys != -1)
        return self._keys[at], self._to[at], self._out[at]


class Transducer:
    """Encodes pieces byte by byte; ids come out as little-endian unsigned 32-bit integers.

    A token is named by its place in the trie, 0 is none. A member is one
    integer: the places of its tokens not yet put out and then its place in the
    trie, ``BITS`` bits each. A state is its members, the one at the end of a
    token first, then the last token put out and the place of the whole piece so
    far (``GONE`` where there is none). Many pieces go through the machine
    together, a byte of each at a time, and the transitions that they miss are
    made once.
    """

    def __init__(self, ranks: dict[bytes, int], max_states: int = MAX_STATES) -> None:
        self.merges = Merges(ranks)
        self.max_states = max_states
        # the trie: (place << 8 | byte) -> place; its places' tokens, ids and next bytes
        self._down: dict[int, int] = {}
        self._token: list[bytes | None] = [None]
        self._bytes: list[bytes] = [b""]
        for token in ranks:
            place = 0
            for b in token:
                to = self._down.get(place << 8 | b)
                if to is None:
                    to = self._down[place << 8 | b] = len(self._token)
                    self._token.append(None)
                    self._bytes.append(b"")
                    self._bytes[place] += bytes([b])
                place = to
            self._token[place] = token
        if len(self._token) > PLACE:
            raise ValueError(f"more than {PLACE} places in the trie of tokens")
        self._packed = [b"" if t is None else np.uint32(ranks[t]).tobytes() for t in self._token]
        self._beside: dict[int, bool] = {}          # two tokens -> whether they may stand side by side
        self._below: dict[int, list[int]] = {}      # place -> tokens below it
        self._goes_on: dict[int, bool] = {}         # token, place below -> whether a longer token may follow it
        self._outs: dict[bytes, int] = {b"": 0}     # ids that come out together -> their number
        self._out_list: list[bytes] = [b""]
        none = np.zeros(0, np.int64)
        self._keep([(0, 0, 0)], np.zeros(1, np.int32), Transitions(none, none, none))

    def _keep(self, states: list[tuple], ends: np.ndarray, transitions: Transitions) -> None:
        """Start with these states, numbered from 0."""
        self._states, self._numbers = states, {s: n for n, s in enumerate(states)}
        self._used = np.zeros(len(states), bool)    # whether a piece came through after the one that made them
        self._ends = ends                           # number of the ids where a piece ends
        self._transitions = transitions

    def _number(self, state: tuple) -> int:
        n = self._numbers.get(state)
        if n is None:
            n = self._numbers[state] = len(self._states)
            self._states.append(state)
        elif n < len(self._used):
            self._used[n] = True
        return n

    def _out_number(self, ids: bytes) -> int:
        n = self._outs.get(ids)
        if n is None:
            n = self._outs[ids] = len(self._out_list)
            self._out_list.append(ids)
        return n

    def _may_follow(self, left: int, right: int) -> bool:
        """Whether the token at ``right`` may come after the one at ``left`` (0: at the start)."""
        ok = self._beside.get(left << BITS | right)
        if ok is None:
            token = self._token[right]
            ok = self.merges.reached(token) and (not left or self.merges.beside(self._token[left], token))
            self._beside[left << BITS | right] = ok
        return ok

    def _tokens_below(self, place: int) -> list[int]:
        """Places of tokens below ``place``, the shorter ones first; more than ``LOOK`` are not all listed."""
        found, todo = [], [place]
        for at in todo:
            for b in self._bytes[at]:
                to = self._down[at << 8 | b]
                todo.append(to)
                if self._token[to] is not None:
                    found.append(to)
            if len(found) > LOOK:
                break
        self._below[place] = found
        return found

    def _may_go_on(self, left: int, place: int) -> bool:
        """Whether some token below ``place`` may come after ``left``; yes where it has more than ``LOOK`` to try."""
        tokens = self._below.get(place)
        if tokens is None:
            tokens = self._tokens_below(place)
        ok = len(tokens) > LOOK
        if not ok:
            known, pair = self._beside.get, left << BITS
            for to in tokens:
                ok = known(pair | to)
                if ok is None:
                    ok = self._may_follow(left, to)
                if ok:
                    break
        self._goes_on[left << BITS | place] = ok = bool(ok)
        return ok

    def _step(self, number: int, byte: int) -> tuple[int, int]:
        """Make a transition: the next state, and the number of the ids that are certain now."""
        down, tokens, goes_on, beside = self._down.get, self._token, self._goes_on.get, self._beside.get
        *old, last, plain = self._states[number]
        members, ended, differ = [0], 0, False
        for member in old:
            to = down((member & PLACE) << 8 | byte)
            if to is None:
                continue
            pending = member >> BITS
            left = (pending & PLACE) or last
            pair = left << BITS | to
            if not ended and tokens[to] is not None:
                ok = beside(pair)
                if ok or (ok is None and self._may_follow(left, to)):
                    ended = pending << BITS | to
            on = goes_on(pair)
            if on or (on is None and self._may_go_on(left, to)):
                members.append(pending << BITS | to)
                differ = differ or not pending
        if not ended:
            raise ValueError("the ranks lack a byte or aren't those of byte-level BPE")
        members[0] = ended << BITS
        out = b""
        if not differ:
            out, members, last = self._put_out(members, last)
        plain = down(plain << 8 | byte, GONE) if plain != GONE else GONE
        return self._number((*members, last, plain)), self._out_number(out)

    def _put_out(self, members: list[int], last: int) -> tuple[bytes, list[int], int]:
        """The ids of the tokens that all members share, the members without them, and the last token then."""
        out = b""
        sizes = [(m.bit_length() - 1) // BITS * BITS for m in members]    # bits below a member's first token
        while min(sizes) > 0:
            first = members[0] >> sizes[0]
            for m, k in zip(members, sizes):
                if m >> k != first:
                    return out, members, last
            out, last = out + self._packed[first], first
            # what follows a first token that went out is the next one, or the place alone
            members = [m & (1 << k) - 1 for m, k in zip(members, sizes)]
            sizes = [k - BITS for k in sizes]
        return out, members, last

    def _through(self, states: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the states get by one byte each, and the numbers of the ids that come out."""
        keys = states << 8 | data
        found, to, out = self._transitions.find(keys)
        self._used[to[found]] = True
        if not found.all():
            new = np.unique(keys[~found])
            made = np.array([self._step(k >> 8, k & 255) for k in new.tolist()], np.int32)
            self._transitions.add(new, made[:, 0], made[:, 1])
            grown = len(self._states) - len(self._used)
            self._used = np.r_[self._used, np.zeros(grown, bool)]
            self._ends = np.r_[self._ends, np.full(grown, -1, np.int32)]
            _, to, out = self._transitions.find(keys)
        return to.astype(np.int64), out

    def _end_numbers(self, states: np.ndarray) -> np.ndarray:
        """The numbers of the ids still to come where pieces end in these states."""
        for n in np.unique(states[self._ends[states] < 0]).tolist():
            self._ends[n] = self._out_number(b"".join([self._packed[t] for t in _places(self._states[n][0])[:-1]]))
        return self._ends[states]

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of every piece, none of which may be empty."""
        out: list[bytes] = [b""] * len(pieces)
        short = [i for i, p in enumerate(pieces) if len(p) <= LONG_PIECE]
        for a in range(0, len(short), BATCH_PIECES):
            part = short[a:a + BATCH_PIECES]
            for i, ids in zip(part, self._encode([pieces[i] for i in part])):
                out[i] = ids
            if len(self._states) > self.max_states:
                self._sweep(0)
        for i, p in enumerate(pieces):
            if len(p) > LONG_PIECE:
                out[i] = self._encode_long(p)
        return out

    def _encode_long(self, piece: bytes) -> bytes:
        """One piece by itself; ``known`` are the transitions that it has gone through."""
        state, known, outs = 0, {}, []
        for byte in piece:
            step = known.get(state << 8 | byte)
            if step is None:
                if len(self._states) > self.max_states or len(known) > self.max_states:
                    state, known = self._sweep(state), {}
                to, out = self._through(np.array([state]), np.array([byte]))
                step = known[state << 8 | byte] = (int(to[0]), self._out_list[out[0]])
            if step[1]:
                outs.append(step[1])
            state = step[0]
        if (whole := self._whole(state)) is not None:
            return whole
        return b"".join(outs) + self._out_list[self._end_numbers(np.array([state]))[0]]

    def _whole(self, state: int) -> bytes | None:
        """The id of the whole piece where it is a token: it stands for the piece, also where the merges don't reach it."""
        plain = self._states[state][-1]
        return self._packed[plain] if plain != GONE and self._token[plain] is not None else None

    def _encode(self, pieces: list[bytes]) -> list[bytes]:
        sizes = np.array([len(p) for p in pieces])
        order = np.argsort(-sizes, kind="stable")
        ordered = sizes[order]
        starts = (np.cumsum(sizes) - sizes)[order]
        data = np.frombuffer(b"".join(pieces), np.uint8)
        states = np.zeros(len(pieces), np.int64)
        who, what = [], []
        for at in range(int(ordered[0])):
            m = int(np.searchsorted(-ordered, -at, "left"))    # pieces longer than ``at``
            states[:m], out = self._through(states[:m], data[starts[:m] + at])
            some = np.flatnonzero(out)
            who.append(some)
            what.append(out[some])
        who.append(np.arange(len(pieces)))
        what.append(self._end_numbers(states))
        by_piece, outs = np.concatenate(who), np.concatenate(what)
        rank = np.argsort(order[by_piece], kind="stable")
        bounds = np.r_[0, np.cumsum(np.bincount(order[by_piece], minlength=len(pieces)))].tolist()
        ids, known = outs[rank].tolist(), self._out_list
        result = [b"".join([known[i] for i in ids[a:b]]) for a, b in zip(bounds, bounds[1:])]
        for i, n in zip(order.tolist(), states.tolist()):
            if (whole := self._whole(n)) is not None:
                result[i] = whole
        return result

    def _sweep(self, current: int) -> int:
        """Drop the states that weren't used again, or nearly all where most were; the new number of ``current``."""
        self._used[[0, current]] = True
        kept = np.flatnonzero(self._used)
        if len(kept) > self.max_states // 4 * 3:
            kept = np.unique([0, current])
        number = np.full(len(self._states), -1, np.int64)
        number[kept] = np.arange(len(kept))
        keys, to, out = self._transitions.all()
        stay = (number[keys >> 8] >= 0) & (number[to] >= 0)
        keys, to, out, ends = keys[stay], to[stay], out[stay], self._ends[kept]
        # ids that no transition gives any more go too
        named = np.unique(np.r_[0, out, ends[ends >= 0]])
        self._out_list = [self._out_list[n] for n in named.tolist()]
        self._outs = {ids: n for n, ids in enumerate(self._out_list)}
        ends = np.where(ends >= 0, np.searchsorted(named, ends), -1).astype(np.int32)
        self._keep([self._states[n] for n in kept.tolist()], ends,
                   Transitions(number[keys >> 8] << 8 | keys & 255, number[to], np.searchsorted(named, out)))
        for known in (self._beside, self._goes_on):
            if len(known) > MAX_NEIGHBOURS:
                known.clear()
        return int(number[current])


class Encoder:
    """Encodes texts: cuts them into pieces and sends every new piece through the transducer."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, max_states: int = MAX_STATES) -> None:
        import regex

        self._pieces = regex.compile(pattern).findall
        self._transducer = Transducer(ranks, max_states)
        self._known: dict[str, bytes] = {}     # the newer half; when it is full the older one goes
        self._older: dict[str, bytes] = {}

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of every text."""
        cut = [self._pieces(t) if t else [] for t in texts]
        known, older = self._known, self._older
        new = list(set().union(*cut).difference(known))
        known.update((p, older[p]) for p in new if p in older)
        new = [p for p in new if p not in known]
        known.update(zip(new, self._transducer.encode_pieces([p.encode() for p in new])))
        out = [b"".join(map(known.__getitem__, pieces)) for pieces in cut]
        for p in new:
            if len(p) > MAX_PIECE_CHARS:
                del known[p]
        if len(known) > MAX_PIECES // 2:
            self._known, self._older = {}, known
        return out


@worker_cache
@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    """This worker's encoder; it outlives a task."""
    return Encoder(read_ranks(path), pattern)


# -- decoding ---------------------------------------------------------------

# what may follow in UTF-8: state -> [(first byte, last byte, next state)]; 0 is between code points.
# The well-formed byte sequences of the Unicode standard.
UTF8_NEXT = {
    0: [(0x00, 0x7F, 0), (0xC2, 0xDF, 1), (0xE0, 0xE0, 2), (0xE1, 0xEC, 3), (0xED, 0xED, 4), (0xEE, 0xEF, 3),
        (0xF0, 0xF0, 5), (0xF1, 0xF3, 6), (0xF4, 0xF4, 7)],
    1: [(0x80, 0xBF, 0)],
    2: [(0xA0, 0xBF, 1)],
    3: [(0x80, 0xBF, 1)],
    4: [(0x80, 0x9F, 1)],
    5: [(0x90, 0xBF, 3)],
    6: [(0x80, 0xBF, 3)],
    7: [(0x80, 0x8F, 3)],
}
BROKEN = -1


def _utf8_table() -> list[list[int]]:
    out = []
    for state in range(len(UTF8_NEXT)):
        row = [BROKEN] * 256
        for lo, hi, to in UTF8_NEXT[state]:
            row[lo:hi + 1] = [to] * (hi - lo + 1)
        out.append(row)
    return out


_UTF8 = _utf8_table()


class Utf8Machine:
    """Turns bytes that come in any cut into whole code points; broken sequences become U+FFFD."""

    def __init__(self) -> None:
        self.state, self._open = 0, b""

    def _run(self, data: bytes) -> int:
        """The state after ``data``, from the present one."""
        state = self.state
        for b in data:
            state = _UTF8[state][b]
            if state == BROKEN:
                break
        return state

    def feed(self, data: bytes) -> str:
        """The text that is complete with ``data``; up to three bytes stay for the next call."""
        data = self._open + data
        # the last code point starts in the last four bytes: only these run through the machine
        cut = max(0, len(data) - 4)
        while cut < len(data) and 0x80 <= data[cut] < 0xC0:
            cut += 1
        while cut < len(data):
            self.state = 0
            end = cut + 1 + next((k for k, b in enumerate(data[cut + 1:]) if not 0x80 <= b < 0xC0), len(data) - cut - 1)
            if end == len(data):
                break
            cut = end
        if cut < len(data) and (state := self._run(data[cut:])) > 0:
            self.state, self._open = state, data[cut:]
            data = data[:cut]
        else:
            self.state, self._open = 0, b""
        return data.decode("utf-8", "replace")

    def close(self) -> str:
        """What an unfinished code point leaves."""
        left, self.state, self._open = self._open, 0, b""
        return left.decode("utf-8", "replace")


class Decoder:
    def __init__(self, ranks: dict[bytes, int]) -> None:
        self._bytes = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self._bytes[i] = token

    def raw(self, ids: np.ndarray) -> bytes:
        known = self._bytes
        return b"".join([known[i] for i in ids.tolist()])

    def stream(self, chunks: Iterable[np.ndarray]) -> Iterator[str]:
        """Text of ids that come in chunks; every piece ends at a code point's end."""
        machine = Utf8Machine()
        for ids in chunks:
            if text := machine.feed(self.raw(ids)):
                yield text
        if text := machine.close():
            yield text


@worker_cache
@lru_cache(maxsize=2)
def decoder(path: str) -> Decoder:
    return Decoder(read_ranks(path))


def decode_stream(path: str, chunks: Iterable[np.ndarray]) -> Iterator[str]:
    """Text of one stream of ids (a model's output, say), as far as it is complete."""
    return decoder(path).stream(chunks)


# -- columns ----------------------------------------------------------------

@dataclass(frozen=True)
class Step:
    """``out`` (of type ``kind``) made from ``column`` by ``fn``, which gives the values of some rows at a time."""

    column: str
    out: str
    kind: str
    fn: Callable[[pa.Array], Iterator[list]]


def with_steps(df: DataFrame, steps: list[Step], drop: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with the columns that the steps make one after another, and without those in ``drop``.

    One worker takes a row through all steps, a few rows at a time: each further
    ``mapInArrow`` of a stage would have workers of its own, which keep encoders of their own.
    """
    fields = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    for s in steps:
        if s.out in fields:
            raise ValueError(f"column {s.out} is there already")
        fields[s.out] = s.kind
    arrow = arrow_schema(", ".join(f"`{n}` {k}" for n, k in fields.items()))
    schema = ", ".join(f"`{n}` {k}" for n, k in fields.items() if n not in drop)

    def through(cols: dict[str, pa.Array], steps: list[Step]) -> Iterator[dict[str, pa.Array]]:
        if not steps:
            yield cols
            return
        step, first = steps[0], 0
        for made in step.fn(cols[step.column]):
            part = {n: c.slice(first, len(made)) for n, c in cols.items()}
            part[step.out] = pa.array(made, arrow.field(step.out).type)
            first += len(made)
            yield from through(part, steps[1:])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy_worker(keep=True)
        for b in batches:
            for cols in through(dict(zip(b.schema.names, b.columns)), steps):
                yield pa.RecordBatch.from_pydict({n: c.cast(arrow.field(n).type) for n, c in cols.items() if n not in drop})
        tidy_worker(keep=True)

    return df.mapInArrow(run, schema)


def encoding(path: str, pattern: str, text: str = "text", out: str = "ids") -> Step:
    """The ids of ``text`` as binary, four little-endian bytes each."""
    def run(column: pa.Array) -> Iterator[list[bytes]]:
        enc = encoder(path, pattern)
        whole = pa.RecordBatch.from_arrays([column], ["text"])
        for _, texts in text_chunks(whole, "text", CHUNK_BYTES):
            yield enc.encode(texts)

    return Step(text, out, "binary", run)


def decoding(path: str, ids: str = "ids", out: str = "decoded") -> Step:
    """The text of ``ids`` (binary, as :func:`encoding` makes them), streamed through the machine."""
    def run(column: pa.Array) -> Iterator[list[str]]:
        dec = decoder(path)
        texts, held = [], 0
        for i in range(len(column)):
            data = np.frombuffer(column[i].as_py() or b"", "<u4")
            chunks = (data[k:k + DECODE_IDS] for k in range(0, len(data), DECODE_IDS))
            texts.append("".join(dec.stream(chunks)))
            held += len(data)
            if held >= DECODE_ROWS_IDS:
                yield texts
                texts, held = [], 0
        if texts:
            yield texts

    return Step(ids, out, "string", run)


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``df`` with the ids of ``text`` as binary, four little-endian bytes each."""
    return with_steps(df, [encoding(path, pattern, text, out)])


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the text of ``ids`` (binary, as :func:`encode` writes them), streamed through the machine."""
    return with_steps(df, [decoding(path, ids, out)])


def op13_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = ranks_path()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    both = with_steps(docs, [encoding(path, piece_pattern()), decoding(path)], drop=("text",))
    return both.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
