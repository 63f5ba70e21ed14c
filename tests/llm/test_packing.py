"""Packing: every id once, in order, in full sequences; ids as the tokenizers library gives them."""

import collections
import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from seqlake.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
ODD = [None, "", " ", "\n\n  \t x", "a\x00b\x85c d\xa0e", "<|endoftext|> a <|endoftext|>\n", "日本語 テキスト 🎉🎉", "don't  we'll 12½", "x" * 5000, " " * 3000, "é" * 2047]


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def prose(n, r):
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 7))) for _ in range(n))


def padding(lengths, window=2048):
    return sum(0 if not n & (n - 1) else window - n for n in lengths)


def test_pieces_cover_each_document_once_and_sequences_have_no_gaps(spark):
    r = random.Random(3)
    texts = [*ODD, *(prose(r.choice([1, 20, 300, 900, 4000]), r) for _ in range(60))]
    rows = [(i, t, 1, "s") for i, t in enumerate(texts)] + [(3, texts[3], 1, "s"), (None, "null id", 1, "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start int, offset string").repartition(2)
    pieces = packing.pack(docs, PATH, public_tokenizers.PATTERN, keep_ids=True).cache()
    got = pieces.drop("ids").collect()
    assert [f.simpleString() for f in pieces.drop("ids").schema] == packing.SCHEMA.replace(" long", ":bigint").split(", ")

    whole = collections.Counter((i, tuple(library_ids(t)) + (1,)) for i, t, *_ in rows)
    spans = collections.defaultdict(list)
    for p in got:
        spans[p.doc_id].append(p)
    for i, own in spans.items():
        ids = next(x for j, x in whole if j == i)
        copies = sum(n for (j, _), n in whole.items() if j == i)
        assert all(p.doc_tokens == len(ids) for p in own)
        assert all(p.ids_crc32 == zlib.crc32(np.array(ids[p.start : p.start + p.length], dtype="<u4").tobytes()) for p in own)
        covered = collections.Counter(k for p in own for k in range(p.start, p.start + p.length))
        assert covered == {k: copies for k in range(len(ids))}

    sequences = collections.defaultdict(list)
    for p in got:
        sequences[p.sequence_id].append((p.offset, p.length))
    for own in sequences.values():
        own.sort()
        assert [o for o, _ in own] == [0, *itertools.accumulate(n for _, n in own)][:-1] and sum(n for _, n in own) <= 2048
    assert padding(sum(n for _, n in own) for own in sequences.values()) == 0

    rows = packing.sequences(pieces, pad_id=7).collect()
    ids = collections.Counter(x for r in rows for x in r.ids[: r.n_ids])
    assert ids == sum((collections.Counter({x: n for x, n in collections.Counter(t).items()}) for (_, t), k in whole.items() for _ in range(k)), collections.Counter())
    assert all(len(r.ids) == 2048 or not r.n_ids & (r.n_ids - 1) for r in rows) and all(r.ends[-1] == r.n_ids for r in rows)
    pieces.unpersist()


def test_an_empty_table_has_no_pieces(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), PATH, public_tokenizers.PATTERN).count() == 0


def test_runs_of_bounded_size(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "a b c d") for i in range(50)], "doc_id long, text string").coalesce(1)
    monkeypatch.setattr(packing, "RUN_DOCUMENTS", 7)
    got = packing.pack(docs, PATH, public_tokenizers.PATTERN).collect()
    assert sum(p.length for p in got) == 50 * 5 and len({(p.sequence_id, p.offset) for p in got}) == len(got)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 200), max_size=60), st.sampled_from([16, 64, 100]), st.sampled_from([0, 3]))
def test_best_fit_and_closed_gaps(lengths, window, slack):
    packed = packing.best_fit(lengths, window)
    closed = packing.close_gaps([list(s) for s in packed], window, slack)
    for sequences in (packed, closed):
        covered = collections.Counter((d, k) for s in sequences for d, start, n in s for k in range(start, start + n))
        assert covered == {(d, k): 1 for d, n in enumerate(lengths) for k in range(n)}
        assert all(0 < sum(p[2] for p in s) <= window for s in sequences)
    open_ones = sum(sum(p[2] for p in s) < window - slack and bool((n := sum(p[2] for p in s)) & (n - 1)) for s in closed)
    assert open_ones == 0


@given(st.lists(st.integers(1, 64), min_size=1, max_size=80))
def test_the_tree_finds_the_tightest_window(lengths):
    tree, rooms = packing.Capacities(64), collections.Counter()
    for n in lengths:
        fits = [r for r in rooms.elements() if r >= n]
        found = tree.tightest(n)
        assert (found and found[0]) == (min(fits) if fits else None)
        room = found[0] if found else 64
        if found:
            rooms[room] -= 1
        if room > n:
            rooms[room - n] += 1
            tree.add(room - n, 0)


def test_ids_equal_the_library_for_any_text_and_any_cut(monkeypatch):
    encoder, r = packing.Encoder(PATH, public_tokenizers.PATTERN), random.Random(5)
    assert encoder.by_ranks
    pool = " \t\n\r\x0b\x1c\x85\xa0​　᠎'sdtrvelmaZé日本ع१½Ⅷ🎉́_-.,!"
    for size in (1, 7, 40):
        monkeypatch.setattr(packing, "CHUNK", size)
        for i in range(700):
            text = "".join(r.choice(pool if i % 3 else "ab  c'") for _ in range(r.randint(0, 120)))
            text += "<|endoftext|> b" if i % 9 == 0 else ""
            assert list(encoder.encode(text)) == library_ids(text), text


@pytest.mark.parametrize("text", ["a" * 2_000_000, " " * 2_000_000, "ab " * 700_000, "x\n" * 500_000])
def test_very_long_texts(text):
    assert list(packing.Encoder(PATH, public_tokenizers.PATTERN).encode(text)) == library_ids(text)


def test_a_vocabulary_of_another_kind_is_left_to_the_library(tmp_path):
    encoder = packing.Encoder(public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.PATTERN)
    assert not encoder.by_ranks
    want = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")).encode("Some words", add_special_tokens=False).ids
    assert list(encoder.encode("Some words")) == want
