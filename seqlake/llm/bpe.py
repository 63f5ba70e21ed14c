"""Byte-level BPE by a lazily determinised transducer, and streaming decoding.

Encoding. A token sequence is the merge result of its bytes exactly if every
two neighbours are the merge result of theirs. So the encodings of all prefixes
of a piece form a non-deterministic transducer: a configuration is a token
history and the bytes of the token in progress. Subsets of configurations are
determinised on demand, one (state, byte) at a time; a token is emitted as soon
as all live configurations agree on it, which looks ahead by no more than the
longest vocabulary entry. Where few tokens can still come of the bytes in
progress, a configuration in which none of them may follow the token before is
dropped, and one in which all may forgets that token: agreement comes early,
and states are shared by most histories.

Decoding. An incremental UTF-8 machine, a table of states and bytes, is composed
with the vocabulary into a table of states and tokens; ids run through that, a
chunk at a time, and the at most three bytes of an unfinished character are held
back until the next. Only chunks with broken characters take the machine byte by
byte; each broken sequence gives one replacement character.

Edge cases: null text is the empty text and has no tokens; every row of a table
gives one row of output, repeated rows and null ids included; other input
columns are ignored by the digest and kept by :func:`encode`.
"""

from __future__ import annotations

import base64
import hashlib
import math
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T


FEW = 24  # tokens below a trie node that are tried against the token before, all at once
MIXED, NONE, ALL = range(3)


class Transducer:
    """Lazily determinised transducer of one rank table."""

    def __init__(self, ranks: dict[bytes, int], max_transitions: int = 400_000):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.max_transitions = max_transitions
        # trie of the vocabulary; node 0 is its root, and a node's tokens are a range of the sorted ones
        self.kids: dict[int, int] = {}
        self.token_at, self.low, self.high = [-1], [0], [len(ranks)]
        ordered = sorted(ranks)
        self.ordered = [ranks[token] for token in ordered]
        for place, token in enumerate(ordered):
            node = 0
            for byte in token:
                kid = self.kids.setdefault(node << 8 | byte, len(self.token_at))
                if kid == len(self.token_at):
                    self.token_at.append(-1)
                    self.low.append(place)
                    self.high.append(place)
                node = kid
                self.high[node] = place + 1
            self.token_at[node] = ranks[token]
        self.fits: dict[tuple[int, int], bool] = {}
        self.spines: dict[int, tuple | None] = {}
        self._reset()

    def _reset(self) -> None:
        # a configuration is (history, trie node of the bytes in progress); history[0] was emitted already, or is -1
        # where it decides nothing any more
        self.states: list[tuple] = [(((-1,), 0),)]
        self.numbers = {self.states[0]: 0}
        self.steps: dict[int, tuple[int, tuple[int, ...]]] = {}
        self.views: dict[tuple[int, int], int] = {}
        self.fits.clear()

    def _spines(self, token: int) -> tuple | None:
        """How the first and the last symbol of a token grow: ((symbol, rank), ...) each.

        None where merging the token's bytes does not give the token.
        """
        if token in self.spines:
            return self.spines[token]
        data = self.tokens[token]
        parts = [data[i : i + 1] for i in range(len(data))]
        first, last, clock = [(parts[0], -1)], [(parts[-1], -1)], -1
        while (best := self._lowest(parts)) is not None:
            rank, i = best
            clock = max(clock, rank)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            if i == 0:
                first.append((parts[0], clock))
            if i == len(parts) - 1:
                last.append((parts[-1], clock))
        self.spines[token] = known = (tuple(first), tuple(last)) if parts == [data] else None
        return known

    def _lowest(self, parts: list[bytes]) -> tuple[int, int] | None:
        return min(
            ((r, i) for i in range(len(parts) - 1) if (r := self.ranks.get(parts[i] + parts[i + 1])) is not None),
            default=None,
        )

    def _follows(self, left: int, token: int) -> bool:
        """Whether no merge crosses from ``left`` into ``token`` while both grow."""
        right = self._spines(token)
        if left < 0 or right is None:
            return right is not None
        ends, starts, ranks = self._spines(left)[1], right[0], self.ranks
        i = j = 0
        while True:
            ahead = ends[i + 1][1] if i + 1 < len(ends) else math.inf
            behind = starts[j + 1][1] if j + 1 < len(starts) else math.inf
            crossing = ranks.get(ends[i][0] + starts[j][0])
            if crossing is not None and crossing < ahead and crossing <= behind:
                return False
            if ahead == behind == math.inf:
                return True
            if ahead <= behind:
                i += 1
            else:
                j += 1

    def _fit(self, left: int, token: int) -> bool:
        if (fit := self.fits.get((left, token))) is None:
            fit = self.fits[left, token] = self._follows(left, token)
        return fit

    def _view(self, left: int, node: int) -> int:
        """Whether ALL tokens below a node may follow ``left``, or NONE; MIXED also where they are many."""
        low, high = self.low[node], self.high[node]
        if left < 0 or high - low > FEW:
            return MIXED
        if (view := self.views.get((left, node))) is None:
            n = sum(self._follows(left, token) for token in self.ordered[low:high])
            view = self.views[left, node] = ALL if n == high - low else NONE if not n else MIXED
        return view

    def _step(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        live: list[tuple[tuple[int, ...], int]] = []
        for history, node in self.states[state]:
            node = self.kids.get(node << 8 | byte)
            if node is None or (view := self._view(history[-1], node)) == NONE:
                continue
            token = self.token_at[node]
            ends = token >= 0 and (view == ALL or self._fit(history[-1], token))
            live.append(((-1,) if view == ALL and len(history) == 1 else history, node))
            if ends:
                live.append(((-1, *history[1:], token), 0))
        out = []
        while live:
            agreed = live[0][0]
            if len(agreed) < 2:
                break
            ended = agreed[1]
            if any(len(h) < 2 or h[1] != ended for h, _ in live):
                break
            out.append(ended)
            live = [((ended,) if len(h) == 2 else (-1, *h[2:]), node) for h, node in live]
        after = tuple(live)
        number = self.numbers.get(after)
        if number is None:
            number = self.numbers[after] = len(self.states)
            self.states.append(after)
        made = self.steps[state << 8 | byte] = (number, tuple(out))
        return made

    def encode(self, piece: bytes) -> list[int]:
        if (whole := self.ranks.get(piece)) is not None:
            return [whole]
        if len(self.steps) > self.max_transitions:
            self._reset()
        state, out, steps = 0, [], self.steps
        for byte in piece:
            state, emitted = steps.get(state << 8 | byte) or self._step(state, byte)
            if emitted:
                out.extend(emitted)
        for history, node in self.states[state]:
            if not node:
                return out + list(history[1:])
        raise ValueError("no token for a byte of this piece")


class Pieces(dict):
    """Encoded pieces seen lately, as packed little-endian ids: two generations of bounded size."""

    def __init__(self, transducer: Transducer, most: int = 150_000):
        self.transducer, self.most, self.older = transducer, most, {}

    def __missing__(self, piece: str) -> bytes:
        if (ids := self.older.get(piece)) is None:
            ids = np.array(self.transducer.encode(piece.encode()), "<u4").tobytes()
        if len(piece) <= 64:
            if len(self) >= self.most:
                self.older = dict(self)
                self.clear()
            self[piece] = ids
        return ids


START, BROKEN = 0, 8


def _utf8_steps() -> np.ndarray:
    """The UTF-8 machine: the state after a state and a byte.

    States 1 to 3 wait for so many more continuation bytes, states 4 to 7 for
    the second byte after E0, ED, F0 and F4, whose range is narrower.
    """
    steps = np.full((9, 256), BROKEN, np.uint8)
    steps[START, :0x80] = START
    for state, first, last in ((1, 0xC2, 0xDF), (2, 0xE1, 0xEF), (3, 0xF1, 0xF3), (4, 0xE0, 0xE0), (5, 0xED, 0xED), (6, 0xF0, 0xF0), (7, 0xF4, 0xF4)):
        steps[START, first : last + 1] = state
    for state, first, last, after in ((1, 0x80, 0xBF, 0), (2, 0x80, 0xBF, 1), (3, 0x80, 0xBF, 2), (4, 0xA0, 0xBF, 1), (5, 0x80, 0x9F, 1), (6, 0x90, 0xBF, 2), (7, 0x80, 0x8F, 2)):
        steps[state, first : last + 1] = after
    return steps


STEPS = _utf8_steps()


class Utf8Stream:
    """Incremental UTF-8 decoder: feed bytes in any cuts, get whole characters."""

    def __init__(self) -> None:
        self.state, self.held, self.steps = START, b"", STEPS.tolist()

    def feed(self, data: bytes, after: int = BROKEN) -> str:
        """The characters that ``data`` completes. ``after``: the state after it, where a table of tokens gave that."""
        if after == BROKEN:
            return self._each(data)
        data = self.held + data
        end = len(data)
        if after != START:  # back to the first byte of the unfinished character
            end -= 1
            while data[end] & 0xC0 == 0x80:
                end -= 1
        self.state, self.held = after, data[end:]
        return data[:end].decode()

    def _each(self, data: bytes) -> str:
        at, data = len(self.held), self.held + data
        out, state, whole, first = [], self.state, 0, 0  # whole: where text that was not given yet begins; first: the character in hand
        while at < len(data):
            after = self.steps[state][data[at]]
            if after == BROKEN:
                out += [data[whole:first].decode(), "\ufffd"]
                at += state == START  # else the byte may begin a character of its own
                state, whole, first = START, at, at
                continue
            state, at = after, at + 1
            if state == START:
                first = at
        self.state, self.held = state, data[first:]
        return "".join([*out, data[whole:first].decode()])

    def close(self) -> str:
        rest, self.state, self.held = self.held, START, b""
        return "\ufffd" if rest else ""


class Codec:
    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}
        self.transducer = Transducer(ranks)
        self.pieces = Pieces(self.transducer)
        self.pattern = regex.compile(pattern)
        top = max(ranks.values()) + 1
        self.bytes_of = [self.transducer.tokens.get(i, b"") for i in range(top)]
        self.after = self._after()
        self.whole = self.after[START] == START  # tokens of whole characters

    def _after(self) -> np.ndarray:
        """The UTF-8 machine's state after a state and a token: all tokens at once, a byte at a time."""
        sizes = np.array([len(b) for b in self.bytes_of])
        flat, starts = np.frombuffer(b"".join(self.bytes_of), np.uint8), np.concatenate([[0], sizes.cumsum()[:-1]])
        states = np.repeat(np.arange(9, dtype=np.uint8)[:, None], len(sizes), axis=1)
        for i in range(sizes.max()):
            own = np.flatnonzero(sizes > i)
            states[:, own] = STEPS[states[:, own], flat[starts[own] + i]]
        return states

    def encode(self, text: str) -> bytes:
        """Packed little-endian ids of a whole text."""
        # findall gives tuples where the pattern has groups
        found = self.pattern.findall(text) if not self.pattern.groups else [m.group() for m in self.pattern.finditer(text)]
        return b"".join(map(self.pieces.__getitem__, found))

    def _run(self, state: int, ids: np.ndarray) -> int:
        """The UTF-8 machine's state after some tokens."""
        odd = np.flatnonzero(~self.whole[ids]).tolist()
        if state != START:
            odd.insert(0, 0)
        at = 0
        for first in odd:  # tokens between these begin and end whole characters
            at = max(at, first)
            while at < len(ids) and (at == first or state != START):
                state = int(self.after[state, ids[at]])
                at += 1
        return state

    def decode_stream(self, ids: bytes, chunk: int = 4096) -> Iterator[tuple[bytes, str]]:
        """(bytes, characters completed by them) for each chunk of ids, then the rest."""
        stream, of = Utf8Stream(), self.bytes_of.__getitem__
        numbers = np.frombuffer(ids, "<u4")
        for at in range(0, len(numbers), chunk):
            part = numbers[at : at + chunk]
            data = b"".join(map(of, part.tolist()))
            yield data, stream.feed(data, self._run(stream.state, part))
        yield b"", stream.close()


@lru_cache(2)
def codec(path: str, pattern: str) -> Codec:
    """One codec for each worker process."""
    return Codec(path, pattern)


def encode(df: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``df`` without ``text`` plus ``ids array<int>``, ``n_tokens`` and ``round_trip``.

    ``round_trip`` is true where the streamed decoding of the ids gives the text again.
    """
    keep = [f for f in df.schema.fields if f.name not in (text, "ids", "n_tokens", "round_trip")]
    out = T.StructType(
        [*keep, T.StructField("ids", T.ArrayType(T.IntegerType(), False)), T.StructField("n_tokens", T.LongType()), T.StructField("round_trip", T.BooleanType())]
    )
    names = [f.name for f in keep]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 128):  # ids outgrow texts: small batches out
                part = batch.slice(at, 128)
                ids, same = [], []
                for value in part.column(text).to_pylist():
                    packed = own.encode(value or "")
                    ids.append(packed)
                    same.append("".join(s for _, s in own.decode_stream(packed)) == (value or ""))
                n = np.array([len(x) // 4 for x in ids], np.int64)
                flat = pa.array(np.frombuffer(b"".join(ids), "<i4"), pa.int32())
                arrays = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], n.cumsum()]).astype(np.int32)), flat)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in names), arrays, pa.array(n), pa.array(same)], [*names, "ids", "n_tokens", "round_trip"]
                )

    return df.select(*names, text).mapInArrow(run, out)


def decode(df: DataFrame, path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """``df`` plus ``decoded``: the text of its ids; a null array gives the empty text."""
    out = T.StructType([*df.schema.fields, T.StructField("decoded", T.StringType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            texts = [
                "".join(s for _, s in own.decode_stream(np.array(x or [], "<u4").tobytes()))
                for x in batch.column(ids).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "decoded"])

    return df.mapInArrow(run, out)


def digests(df: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encode, then decode the ids."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            n, ids_sha, decoded_sha = [], [], []
            for value in batch.column(1):
                packed = own.encode(value.as_py() or "")
                n.append(len(packed) // 4)
                ids_sha.append(hashlib.sha256(packed).hexdigest())
                digest = hashlib.sha256()
                for _, characters in own.decode_stream(packed):
                    digest.update(characters.encode())
                decoded_sha.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(decoded_sha, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return df.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
