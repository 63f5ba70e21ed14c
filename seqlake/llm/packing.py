"""Packing of token ids into sequences by best-fit decreasing, with little padding.

Each task tokenises its documents in runs of bounded size and packs each run for
itself, so no id is shuffled and no task holds more than a run. In a run,
documents longer than a window are first cut into full windows; the rests go,
longest first, to the open window with the tightest room, which a segment tree
over remaining capacities finds. What best fit leaves open is closed by cutting
the emptiest windows into the gaps of the fullest, and the one window that is
left is cut at powers of two, which need no padding: so no sequence of a run
has padding but for the ``slack`` that a caller allows.

Results depend on how the table is read into tasks, as Spark's increasing ids
do; a task that is run again gives the same rows.
"""

from __future__ import annotations

import json
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

#: Ids or documents of a run, at least; a longer document is a run of its own.
RUN_IDS, RUN_DOCUMENTS = 4_000_000, 100_000
#: Characters of a text that are encoded at once, where it can be cut before a single space.
CHUNK = 1_000_000
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Encoder:
    """Token ids as the ``tokenizers`` library gives them for its file, without added special tokens.

    A byte-level vocabulary whose ids follow its merges is encoded by ranks,
    which gives the same ids three times as fast; any other by ``tokenizers``.
    """

    def __init__(self, path: str, pattern: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.path, self.library = path, None
        ranks = _ranks(spec)
        self.by_ranks = ranks is not None
        if self.by_ranks:
            special = {t["content"]: t["id"] for t in spec["added_tokens"]}
            self.codec = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)

    def encode(self, text: str) -> np.ndarray:
        if not self.by_ranks:
            return self._by_library(text)
        parts = [self._by_ranks(t) for t in (pieces_of_text(text, CHUNK) if len(text) > CHUNK else (text,))]
        return np.concatenate(parts) if len(parts) > 1 else parts[0]

    def _by_ranks(self, text: str) -> np.ndarray:
        try:
            return self.codec.encode_to_numpy(text, allowed_special="all")
        except ValueError:  # white space of a megabyte is beyond the stack of its pattern engine
            return self._by_library(text)

    def _by_library(self, text: str) -> np.ndarray:
        if self.library is None:
            self.library = Tokenizer.from_file(self.path)
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype=np.uint32)


def _byte_names() -> dict[str, int]:
    """The printable character of each byte in byte-level vocabularies: itself, or the next one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    names = {chr(b): b for b in plain}
    return names | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}


def _ranks(spec: dict) -> dict[bytes, int] | None:
    """Ranks by token of a plain byte-level BPE whose later merges have larger ids, else None."""
    model, before = spec["model"], spec.get("pre_tokenizer") or {}
    plain = not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    plain = plain and model["type"] == "BPE" and spec.get("normalizer") is None and spec.get("post_processor") is None
    plain = plain and before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
    plain = plain and all(t["special"] and not (t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"]) for t in spec["added_tokens"])
    if not plain:
        return None
    names, added = _byte_names(), {t["content"] for t in spec["added_tokens"]}
    merges = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
    ids = [model["vocab"][m] for m in merges]
    if ids != sorted(ids) or len(set(ids)) != len(ids):
        return None
    return {bytes(names[c] for c in token): i for token, i in model["vocab"].items() if token not in added}


def pieces_of_text(text: str, size: int) -> Iterator[str]:
    """``text`` in pieces that are encoded independently: cut before a single space between two other characters.

    Such a space always begins a match of its own with what follows. A piece is
    longer than ``size`` where there is none.
    """
    start = 0
    while len(text) - start > size:
        at = text.find(" ", start + size)
        while at > 0 and (at + 1 >= len(text) or text[at - 1].isspace() or text[at + 1].isspace()):
            at = text.find(" ", at + 1)
        if at < 0:
            break
        yield text[start:at]
        start = at
    yield text[start:]


class Capacities:
    """A segment tree over remaining capacities 0 to ``most``: its leaves are the open windows with that room."""

    def __init__(self, most: int):
        self.size = 1 << most.bit_length()
        self.count = [0] * (2 * self.size)
        self.windows: list[list[int]] = [[] for _ in range(most + 1)]

    def add(self, room: int, window: int) -> None:
        self.windows[room].append(window)
        self._change(room, 1)

    def _change(self, room: int, by: int) -> None:
        node = room + self.size
        while node:
            self.count[node] += by
            node >>= 1

    def tightest(self, need: int) -> tuple[int, int] | None:
        """Take out an open window of the smallest room that is at least ``need``: (room, window)."""
        node = need + self.size
        if not self.count[node]:
            # up to the first right neighbour with windows, then down to its leftmost leaf
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        room = node - self.size
        self._change(room, -1)
        return room, self.windows[room].pop()


Piece = tuple[int, int, int]  # document of the run, its ids before the piece, length


def best_fit(lengths: list[int], window: int) -> list[list[Piece]]:
    """Sequences of pieces: full windows of overlong documents, then best-fit decreasing of the rests."""
    sequences: list[list[Piece]] = []
    rests: list[list[Piece]] = [[] for _ in range(window)]
    for doc, n in enumerate(lengths):
        full = n - n % window
        sequences += [[(doc, start, window)] for start in range(0, full, window)]
        if full < n:
            rests[n - full].append((doc, full, n - full))
    open_windows = Capacities(window)
    for size in range(window - 1, 0, -1):
        for piece in rests[size]:
            found = open_windows.tightest(size)
            if found is None:
                room, at = window, len(sequences)
                sequences.append([])
            else:
                room, at = found
            sequences[at].append(piece)
            if room > size:
                open_windows.add(room - size, at)
    return sequences


def close_gaps(sequences: list[list[Piece]], window: int, slack: int = 0) -> list[list[Piece]]:
    """Sequences without gaps over ``slack``: the emptiest are cut into the fullest, the last one at powers of two."""
    filled = [(sum(p[2] for p in s), i) for i, s in enumerate(sequences)]
    done = [sequences[i] for n, i in filled if window - n <= slack or not n & (n - 1)]
    left = deque((n, sequences[i]) for n, i in sorted(filled) if window - n > slack and n & (n - 1))
    rest: list[Piece] = []  # pieces of the emptiest window, to be given away
    while left:
        n, fullest = left.pop()
        while n < window and (rest or left):
            if not rest:
                rest = left.popleft()[1]
            doc, start, size = rest.pop()
            give = min(size, window - n)
            fullest.append((doc, start, give))
            n += give
            if give < size:
                rest.append((doc, start + give, size - give))
        if n == window:
            done.append(fullest)
        else:
            rest = fullest
    return done + _powers_of_two(rest)


def _powers_of_two(pieces: list[Piece]) -> list[list[Piece]]:
    total, out = sum(p[2] for p in pieces), []
    pieces = list(reversed(pieces))
    for bit in reversed(range(total.bit_length())):
        need, sequence = total & 1 << bit, []
        while need:
            doc, start, size = pieces.pop()
            give = min(size, need)
            sequence.append((doc, start, give))
            need -= give
            if give < size:
                pieces.append((doc, start + give, size - give))
        if sequence:
            out.append(sequence)
    return out


def pack(docs: DataFrame, path: str, pattern: str, end_id: int = 1, window: int = 2048, slack: int = 0, keep_ids: bool = False) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of every piece, and its ids with ``keep_ids``.

    A document is the ids of its whole text (null: empty) by the vocabulary in
    ``path``, then ``end_id``, so an empty one is a piece of one id. Repeated
    rows and null doc_ids are documents like others; an empty table has no
    pieces. Pieces of a sequence follow each other from offset 0 without gaps.
    ``path`` is read by every task and lies on all machines.
    """
    schema = SCHEMA + (", ids array<int>" if keep_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path, pattern)
        first = TaskContext.get().partitionId() << 40
        names: list[int | None] = []
        ids: list[np.ndarray] = []
        total = 0

        def packed() -> Iterator[pa.RecordBatch]:
            nonlocal first, total
            sequences = close_gaps(best_fit([len(x) for x in ids], window), window, slack)
            yield from _rows(sequences, names, ids, first, keep_ids)
            first += len(sequences)
            names.clear()
            ids.clear()
            total = 0

        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = np.append(encoder.encode(text.as_py() or ""), np.uint32(end_id)).astype("<u4")
                names.append(name)
                ids.append(own)
                total += len(own)
                if total >= RUN_IDS or len(ids) >= RUN_DOCUMENTS:
                    yield from packed()
        if ids:
            yield from packed()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def _rows(sequences: list[list[Piece]], names: list, ids: list[np.ndarray], first: int, keep_ids: bool, rows: int = 8192) -> Iterator[pa.RecordBatch]:
    columns: list[list] = [[] for _ in range(8)]
    for number, sequence in enumerate(sequences, first):
        offset = 0
        for doc, start, size in sequence:
            own = ids[doc][start : start + size]
            row = (names[doc], start, size, zlib.crc32(own.tobytes()), len(ids[doc]), number, offset, own.astype(np.int32) if keep_ids else None)
            for column, value in zip(columns, row, strict=True):
                column.append(value)
            offset += size
        if len(columns[0]) >= rows:
            yield _batch(columns, keep_ids)
            columns = [[] for _ in range(8)]
    if columns[0]:
        yield _batch(columns, keep_ids)


def _batch(columns: list[list], keep_ids: bool) -> pa.RecordBatch:
    arrays = [pa.array(c, pa.int64()) for c in columns[:7]] + ([pa.array(columns[7], pa.list_(pa.int32()))] if keep_ids else [])
    return pa.record_batch(arrays, [c.split()[0] for c in SCHEMA.split(", ")] + (["ids"] if keep_ids else []))


def sequences(pieces: DataFrame, window: int = 2048, pad_id: int = 0) -> DataFrame:
    """(sequence_id, ids, ends, n_ids) for training, of pieces with their ids.

    ``ids`` are padded to ``window`` except at a power of two; ``ends`` are the
    offsets at which pieces end, so that attention can be kept within a
    document. A sequence is a group of at most ``window`` ids.
    """
    piece = F.struct("offset", "length", "ids")
    rows = pieces.groupBy("sequence_id").agg(F.array_sort(F.collect_list(piece)).alias("p"), F.sum("length").alias("n_ids"))
    short = F.when(F.bit_count("n_ids") == 1, 0).otherwise(F.lit(window) - F.col("n_ids"))
    ids = F.concat(F.flatten("p.ids"), F.array_repeat(F.lit(pad_id), short.cast("int")))
    return rows.select("sequence_id", ids.alias("ids"), F.transform("p", lambda x: x["offset"] + x["length"]).alias("ends"), "n_ids")


def report(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """The digest columns of every piece, at windows of 2048 ids and end id 1."""
    return pack(docs, path, pattern)
