"""Byte-level BPE: a lazily determinised transducer that encodes, and a streaming decoder.

Encoding. The encoding of a string is the one sequence of tokens in which all neighbours are *compatible*: two tokens
are compatible if merging the bytes of both by rank gives just these two again. So the last token of every prefix is
fixed, and a nondeterministic transducer can guess where the token under way began; it is determinised as it is used.
A state holds, for each start from which some token of the vocabulary can still grow, the place in the trie and the
token before it. Tokens on which all starts agree are certain and are emitted, so the lookahead is bounded whatever the
length of the piece. States and transitions are kept up to a limit and then forgotten. Pieces of less than WINDOW bytes,
from which nothing would be emitted on the way, are not determinised: the starts of a lot of new pieces step side by
side, as columns.

Decoding. A state machine over bytes keeps an unfinished UTF-8 character (at most three bytes) between tokens. Bytes
that can't be part of any character become U+FFFD.

Nulls are empty texts; an empty text has no ids. Null ids are passed over; an id outside the vocabulary is an error.
The result column takes the place of a column of the same name; all others pass through, repeated rows included.
"""

from __future__ import annotations

import base64
import struct
from array import array
from collections.abc import Iterable
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_column, text_of
from tidemark.llm.splitting import Memo, chunks_of
from tidemark.llm.wordcodes import lots, places

STATES = 100_000
WORDS = 50_000
NEVER = 1 << 62
ID, LOW = 24, (1 << 24) - 1
#: Bytes read before tokens are emitted; several times the longest token.
WINDOW = 1024
#: The state after so many first bytes is looked up whole.
HEAD = 5
#: Bytes of pieces that are encoded side by side.
LOT = 1 << 17
#: Bytes of texts that are cut into chunks at a time.
SLICE = 1 << 21
_MIX = np.uint64(0x9E3779B97F4A7C15)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


class Transducer:
    """Bytes to token ids, one piece of text at a time."""

    def __init__(self, ranks: dict[bytes, int], limit: int = STATES):
        self.ranks, self.limit = ranks, limit
        self.spelling = {rank: token for token, rank in ranks.items()}
        self.children: dict[int, int] = {}
        self.token, self.depth, self.grows = [-1], [0], [False]
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                nxt = self.children.get(node << 8 | byte)
                if nxt is None:
                    nxt = self.children[node << 8 | byte] = len(self.token)
                    self.token.append(-1)
                    self.depth.append(self.depth[node] + 1)
                    self.grows.append(False)
                    self.grows[node] = True
                node = nxt
            self.token[node] = rank
        self.fits: dict[int, bool] = {}
        self.steps: tuple[dict, dict] = ({}, {})
        self.whole: dict[int, bool] = {}
        self._forget()

    def _forget(self) -> None:
        self.states, self.numbers = [(0,)], {(0,): 0}
        self.moves: dict[int, int] = {}
        self.heads: dict[bytes, tuple[int, tuple[int, ...]]] = {}

    def _merges(self, number: int, last: bool) -> list[tuple[int, bytes]]:
        """How the bytes of a token merge: each step's rank and the last (or first) part after it. Begins with no step."""
        known = self.steps[last].get(number)
        if known is None:
            token = self.spelling[number]
            steps = self.merges(token)
            known = [(rank, parts[last]) for rank, *parts in steps] + [(NEVER, b"")]
            self.whole[number] = steps[-1][1] == token
            self.steps[last][number] = known
        return known

    def merges(self, token: bytes) -> list[tuple[int, bytes, bytes]]:
        """How bytes merge: each step's rank and the first and last part after it. Begins with no step."""
        parts = [token[i : i + 1] for i in range(len(token))]
        known = [(-1, parts[0], parts[-1])]
        while len(parts) > 1:
            ranks = [self.ranks.get(a + b, NEVER) for a, b in zip(parts, parts[1:], strict=False)]
            rank = min(ranks)
            if rank == NEVER:
                break
            at = ranks.index(rank)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            known.append((rank, parts[0], parts[-1]))
        return known

    def _compatible(self, left: int, right: int) -> bool:
        known = self.fits.get(left << ID | right)
        if known is None:
            if len(self.fits) > 4 * self.limit:
                self.fits.clear()
            known = self.fits[left << ID | right] = self._apart(left - 1, right)
        return known

    def _apart(self, left: int, right: int) -> bool:
        """Merges both tokens' bytes side by side, always the lowest rank, leftmost first, until one crosses between them."""
        ours = self._merges(right, False)
        if left < 0 or not self.whole[right]:
            return self.whole[right]
        if self.spelling[left] + self.spelling[right] in self.ranks:
            return False
        theirs, i, j = self._merges(left, True), 0, 0
        while True:
            a, b = theirs[i + 1][0], ours[j + 1][0]
            across = self.ranks.get(theirs[i][1] + ours[j][1], NEVER)
            if across < a and across <= b:
                return False
            if a == NEVER and b == NEVER:
                return True
            if a <= b:
                i += 1
            else:
                j += 1

    def _move(self, state: int, byte: int) -> int:
        """The next state and, in the low bits, the token that ends here. A start is its node and 1 + the token before it."""
        starts, here = [], -1
        for start in self.states[state]:
            node = self.children.get(start >> ID << 8 | byte)
            if node is None:
                continue
            before = start & LOW
            if here < 0 <= self.token[node] and self._compatible(before, self.token[node]):
                here = self.token[node]
            if self.grows[node]:
                starts.append(node << ID | before)
        nxt = (*starts, here + 1)
        number = self.numbers.get(nxt)
        if number is None:
            number = self.numbers[nxt] = len(self.states)
            self.states.append(nxt)
        move = self.moves[state << 8 | byte] = number << ID | here
        return move

    def _back(self, last: list[int], end: int) -> list[int]:
        """Where the tokens end that lead up to a place, from there back to the first that isn't emitted."""
        ends, spelling = [], self.spelling
        while end > 0:
            ends.append(end)
            end -= len(spelling[last[end - 1]])
        return ends

    def encode(self, piece: bytes) -> list[int]:
        if len(self.states) > self.limit:
            self._forget()
        ids, known, head = [], self.moves.get, piece[:HEAD]
        state, last = self.heads.get(head, (0, ()))
        last = [*last]
        rest = piece[len(last) :]
        if len(piece) < WINDOW and (last or len(piece) < HEAD):  # most pieces: nothing to remember or to emit on the way
            for byte in rest:
                move = known(state << 8 | byte)
                if move is None:
                    move = self._move(state, byte)
                state = move >> ID
                last.append(move & LOW)
            rest = b""
        for byte in rest:
            move = known(state << 8 | byte)
            if move is None:
                move = self._move(state, byte)
            state = move >> ID
            last.append(move & LOW)
            if len(last) >= WINDOW:  # what all starts agree on is certain
                chains = [self._back(last, len(last) - self.depth[start >> ID]) for start in self.states[state]]
                certain = set(chains[0]).intersection(*chains[1:])
                ids += [last[end - 1] for end in sorted(certain)]
                last = last[max(certain, default=0) :]
            elif len(last) == HEAD and not ids:
                self.heads[head] = (state, tuple(last))
        return ids + [last[end - 1] for end in reversed(self._back(last, len(last)))]


class Table:
    """Numbers by distinct keys of 0 or more, looked up by whole columns: open addressing, at most half full."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, (2 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int32)
        slots, todo = self._slots(keys), np.arange(len(keys))
        while len(todo):
            free = todo[self.keys[slots[todo]] < 0]
            self.keys[slots[free]] = keys[free]
            todo = todo[self.keys[slots[todo]] != keys[todo]]
            slots[todo] = slots[todo] + 1 & self.mask
        self.values[slots] = values

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * _MIX >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, or -1."""
        slots = self._slots(keys)
        there = self.keys[slots]
        out = np.where(there == keys, self.values[slots], -1).astype(np.int64)
        todo = np.flatnonzero((there != keys) & (there >= 0))
        while len(todo):
            slots[todo] = slots[todo] + 1 & self.mask
            there = self.keys[slots[todo]]
            hit = there == keys[todo]
            out[todo[hit]] = self.values[slots[todo[hit]]]
            todo = todo[~hit & (there >= 0)]
        return out


class Lanes:
    """The transducer on many pieces at once, as columns: every start of every piece takes its steps side by side.

    Here starts are not determinised, so there are no states to remember; a piece's tokens are told at its end.
    """

    FITS = 1 << 18

    def __init__(self, transducer: Transducer):
        t, column = transducer, lambda values: np.fromiter(values, np.int64)
        self.children = Table(column(t.children), column(t.children.values()))
        self.token, self.grows = np.array(t.token), np.array(t.grows)
        size = max(t.spelling, default=-1) + 1
        self.length, self.whole, self.at = np.zeros(size, np.int64), np.zeros(size, bool), np.zeros(size, np.int64)
        ranks, firsts, lasts, both, joint = (array("q") for _ in range(5))
        for number, token in t.spelling.items():
            self.length[number], self.at[number] = len(token), len(ranks)
            for i in range(1, len(token)):
                left, right = t.ranks.get(token[:i]), t.ranks.get(token[i:])
                if left is not None and right is not None:
                    both.append(left << ID | right)
                    joint.append(number)
            steps = t.merges(token)
            self.whole[number] = steps[-1][1] == token
            for rank, first, last in [*steps, (NEVER, b"", b"")]:
                ranks.append(rank)
                firsts.append(t.ranks.get(first, -1))
                lasts.append(t.ranks.get(last, -1))
        self.rank, self.first, self.last = (np.array(numbers, np.int64) for numbers in (ranks, firsts, lasts))
        self.pairs = Table(np.array(both, np.int64), np.array(joint, np.int64))
        self.known, self.fits = np.full(self.FITS, -1, np.int64), np.zeros(self.FITS, bool)

    def _joint(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of two tokens' bytes together."""
        found = self.pairs.get(np.where((left < 0) | (right < 0), 0, left << ID | right))
        return np.where((left < 0) | (right < 0) | (found < 0), NEVER, found)

    def _compatible(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether each token may follow the one on its left, or begin a piece (-1)."""
        keys = left + 1 << ID | right
        slots = (keys.astype(np.uint64) * _MIX >> np.uint64(46)).astype(np.int64)
        out, new = self.fits[slots], np.flatnonzero(self.known[slots] != keys)
        if len(new):
            _, once, of = np.unique(keys[new], return_index=True, return_inverse=True)
            out[new] = self._apart(left[new[once]], right[new[once]])[of]
            self.known[slots[new]] = -1
            self.known[slots[new[once]]] = keys[new[once]]
            kept = new[once][self.known[slots[new[once]]] == keys[new[once]]]
            self.fits[slots[kept]] = out[kept]
        return out

    def _apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """As the transducer tells it, pair by pair."""
        out = self.whole[right]
        todo = np.flatnonzero(out & (left >= 0))
        out[todo] = self._joint(left[todo], right[todo]) == NEVER
        todo = todo[out[todo]]
        i, j = self.at[left[todo]], self.at[right[todo]]
        while len(todo):
            a, b = self.rank[i + 1], self.rank[j + 1]
            across = self._joint(self.last[i], self.first[j])
            crosses = (across < a) & (across <= b)
            out[todo[crosses]] = False
            going = ~crosses & ((a < NEVER) | (b < NEVER))
            ours = a <= b
            todo, i, j = todo[going], (i + ours)[going], (j + ~ours)[going]
        return out

    def encode(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece (none may be empty), as little-endian 32-bit integers."""
        data = np.frombuffer(b"".join(pieces), np.uint8).astype(np.int64)
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ends = np.cumsum(sizes)
        starts, end_of = ends - sizes, np.repeat(ends, sizes)
        found, alive, node, k = [], np.arange(len(data)), np.zeros(len(data), np.int64), 0
        while len(alive):
            node = self.children.get(node << 8 | data[alive + k])
            k += 1
            token = np.where(node >= 0, self.token[node], -1)
            found.append((alive[token >= 0], alive[token >= 0] + k, token[token >= 0]))
            on = (node >= 0) & self.grows[node] & (alive + k < end_of[alive])
            alive, node = alive[on], node[on]
        begin, end, token = map(np.concatenate, zip(*found, strict=True))
        far = end - np.repeat(starts, sizes)[begin]  # from the start of the piece
        order = np.argsort(far.astype(np.int16), kind="stable")  # pieces are shorter than WINDOW
        begin, end, token, far = begin[order], end[order], token[order], far[order]
        last = np.full(len(data) + 1, -1, np.int64)  # by the place where it ends
        first = np.zeros(len(data) + 1, bool)
        first[starts] = True
        cuts = np.searchsorted(far, np.arange(1, sizes.max() + 2))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            at, now = begin[a:b], token[a:b]
            fits = self._compatible(np.where(first[at], -1, last[at]), now)
            last[end[a:b][fits]] = now[fits]
        lane, at, told, count = np.arange(len(pieces)), ends, [], np.zeros(len(pieces), np.int64)
        while len(lane):
            now = last[at]
            if now.min() < 0:
                raise ValueError("bytes that no token stands for")
            told.append((lane, now))
            count[lane] += 1
            at = at - self.length[now]
            lane, at = lane[at > starts[lane]], at[at > starts[lane]]
        out, to = np.empty(count.sum(), "<i4"), np.cumsum(count)
        for i, (lane, now) in enumerate(told):
            out[to[lane] - 1 - i] = now
        packed, to = out.tobytes(), (4 * to).tolist()
        return [packed[a:b] for a, b in zip([0, *to[:-1]], to, strict=True)]


class Encoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.transducer, self.pattern = Transducer(ranks), regex.compile(pattern)
        self.lanes = Lanes(self.transducer)
        self.pieces, self.chunks = Memo(self._piece, WORDS), Memo(self._chunk, WORDS)

    def _piece(self, piece: str) -> bytes:
        self._learn([piece])
        return self.pieces[piece]

    def _chunk(self, chunk: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.pattern.findall(chunk)))

    def _learn(self, pieces: Iterable[str]) -> None:
        """Remembers the ids of these pieces: long ones one by one, all others side by side."""
        lot, size = [], 0
        for piece in pieces:
            data = piece.encode()
            if len(data) >= WINDOW:
                ids = self.transducer.encode(data)
                self.pieces[piece] = struct.pack(f"<{len(ids)}i", *ids)
                continue
            lot.append((piece, data))
            size += len(data)
            if size >= LOT:
                self._learn_lot(lot)
                lot, size = [], 0
        self._learn_lot(lot)

    def _learn_lot(self, lot: list[tuple[str, bytes]]) -> None:
        if lot:
            self.pieces.update(zip((p for p, _ in lot), self.lanes.encode([d for _, d in lot]), strict=True))

    def _ids(self, chunks: list[str]) -> list[bytes]:
        """The ids of each of these distinct chunks."""
        for memo in (self.pieces, self.chunks):
            memo.trim()
        new = self.chunks.unknown(chunks)
        split = list(map(self.pattern.findall, new))
        self._learn(self.pieces.unknown(dict.fromkeys(chain.from_iterable(split))))
        known = self.pieces.__getitem__
        self.chunks.update(zip(new, (known(p[0]) if len(p) == 1 else b"".join(map(known, p)) for p in split), strict=True))
        return list(map(self.chunks.__getitem__, chunks))

    def encode(self, texts: pa.Array) -> pa.Array:
        """The ids of each text, as a list<int32> column."""
        found = [self._lists(texts.slice(i, j - i)) for i, j in lots(texts, SLICE)]
        return pa.concat_arrays(found) if found else pa.array([], pa.list_(pa.int32()))

    def _lists(self, texts: pa.Array) -> pa.Array:
        chunks, first = chunks_of(texts)
        coded = chunks.dictionary_encode()
        packed = self._ids(coded.dictionary.to_pylist())
        sizes = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
        of = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        where, _ = places((np.cumsum(sizes) - sizes)[of], sizes[of])
        ends = np.append(0, np.cumsum(sizes[of]))[first]
        values = np.frombuffer(b"".join(packed), "<i4")[where]
        return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values, pa.int32()))


def _sequences() -> dict[int, list[range]]:
    """By first byte, the ranges of the bytes that may follow (the well-formed sequences of the Unicode standard)."""
    tail = range(0x80, 0xC0)
    follow = {byte: [] for byte in range(0x80)}
    follow |= {byte: [tail] for byte in range(0xC2, 0xE0)}
    follow |= {byte: [tail, tail] for byte in range(0xE0, 0xF0)}
    follow |= {byte: [tail, tail, tail] for byte in range(0xF0, 0xF5)}
    follow[0xE0][0], follow[0xED][0] = range(0xA0, 0xC0), range(0x80, 0xA0)
    follow[0xF0][0], follow[0xF4][0] = range(0x90, 0xC0), range(0x80, 0x90)
    return follow


class Utf8:
    """The state is the unfinished character; feed() returns the characters that bytes have finished."""

    FOLLOW = _sequences()

    def __init__(self) -> None:
        self.held = b""

    def feed(self, data: bytes) -> str:
        out, start = [], 0
        data, at = self.held + data, len(self.held)
        while at < len(data):
            if at > start:
                if data[at] in self.FOLLOW[data[start]][at - start - 1]:
                    at += 1
                else:
                    out.append("�")
                    start = at
                    continue
            elif data[at] in self.FOLLOW:
                at += 1
            else:
                out.append("�")
                start = at = at + 1
                continue
            if at - start == 1 + len(self.FOLLOW[data[start]]):
                out.append(data[start:at].decode())
                start = at
        self.held = data[start:]
        return "".join(out)

    def end(self) -> str:
        held, self.held = self.held, b""
        return "�" if held else ""


class Decoder:
    def __init__(self, ranks: dict[bytes, int]):
        self.spelling = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.spelling[rank] = token
        self.whole: list[str | None] = []
        for token in self.spelling:
            machine = Utf8()
            text = machine.feed(token)
            self.whole.append(None if machine.held or "�" in text or not token else text)

    def decode(self, ids: list[int]) -> str:
        if ids and min(ids) < 0:
            raise ValueError("negative id")
        texts = list(map(self.whole.__getitem__, ids))
        if None not in texts:
            return "".join(texts)
        machine, out = Utf8(), []
        for number, text in zip(ids, texts, strict=True):
            out.append(text if text is not None and not machine.held else machine.feed(self.spelling[number]))
        return "".join(out) + machine.end()


@lru_cache(maxsize=4)
def _encoder(path: str, pattern: str) -> Encoder:
    return Encoder(read_ranks(path), pattern)


@lru_cache(maxsize=4)
def _decoder(path: str) -> Decoder:
    return Decoder(read_ranks(path))


def encode(
    df: DataFrame, ranks: str, pattern: str, text: str = "text", ids: str = "ids", decoded: str | None = None
) -> DataFrame:
    """Adds the token ids of each text; ranks is the path of a rank file, which every executor must hold.

    With decoded, a column of that name gets what the ids decode to, in the same pass.
    """

    def run(batch: pa.Array) -> pa.Array:
        found = _encoder(ranks, pattern).encode(batch)
        if decoded is None:
            return found
        return pa.StructArray.from_arrays([found, _texts(found, _decoder(ranks))], names=["ids", "decoded"])

    whole = text_of(df[text])
    if decoded is None:
        return df.withColumn(ids, arrow_column(run, "array<int>")(whole))
    both = df.withColumn("__coded", arrow_column(run, "struct<ids:array<int>,decoded:string>")(whole))
    return both.withColumns({ids: F.col("__coded.ids"), decoded: F.col("__coded.decoded")}).drop("__coded")


def _texts(lists: pa.Array, decoder: Decoder) -> pa.Array:
    ends, numbers = lists.offsets.to_numpy(), lists.values
    if lists.null_count or numbers.null_count:
        rows = [[i for i in row or () if i is not None] for row in lists.to_pylist()]
    else:
        numbers = numbers.to_numpy()
        rows = (numbers[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True))
    return pa.array(map(decoder.decode, rows), pa.string(), size=len(lists))


def decode(df: DataFrame, ranks: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Adds the text that the ids of each row stand for."""

    def run(batch: pa.Array) -> pa.Array:
        return _texts(batch, _decoder(ranks))

    return df.withColumn(text, arrow_column(run, "string")(df[ids].cast("array<int>")))
