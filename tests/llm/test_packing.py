"""Packing (operator 11): exact round trips against the plain tokenizer, subset sums against brute force."""

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

from arrears.llm import packing
from tests.llm.rows import no_documents, odd_documents

MODEL = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(MODEL)


@pytest.fixture(scope="module")
def encoder():
    with open(MODEL, encoding="utf-8") as f:
        return packing.Encoder(f.read())


def ids_of(plain, text):
    return plain.encode(text or "", add_special_tokens=False).ids + [packing.END]


def check(pieces, ids, capacity=packing.CAPACITY):
    """Every id in one piece, sequences gapless from 0, none too long; returns the padding by sequence.

    `ids`: the id lists of each document id (several for repeated ids).
    """
    by_sequence, by_doc = collections.defaultdict(list), collections.defaultdict(list)
    for p in pieces:
        by_sequence[p.sequence_id].append(p)
        by_doc[p.doc_id].append(p)
        assert p.length > 0
    for doc, lists in ids.items():
        want = collections.Counter((len(x),) for x in lists)
        got = collections.Counter()
        for p in by_doc[doc]:
            assert any(len(x) == p.doc_tokens and zlib.crc32(np.array(x[p.start:p.start + p.length], "<u4").tobytes()) == p.ids_crc32 for x in lists)
            got[(p.doc_tokens,)] += p.length
        assert got == collections.Counter({k: k[0] * n for k, n in want.items()})
        for n in {len(x) for x in lists}:      # each place as often as there are documents of that length
            cover = np.zeros(n, int)
            for p in by_doc[doc]:
                if p.doc_tokens == n:
                    cover[p.start:p.start + p.length] += 1
            assert (cover == sum(len(x) == n for x in lists)).all()
    assert set(by_doc) == set(ids)
    padding = {}
    for s, of in by_sequence.items():
        of.sort(key=lambda p: p.offset)
        assert [p.offset for p in of] == list(itertools.accumulate([0] + [p.length for p in of]))[:-1]
        n = sum(p.length for p in of)
        assert n <= capacity
        padding[s] = 0 if n & (n - 1) == 0 else capacity - n
    return padding


def test_words_and_parts_give_the_tokenizers_ids(plain, encoder):
    rng = random.Random(6)
    alphabet = ["a", "B", "é", "É", "ß", "ŉ", "İ", "ı", "ſ", "Σ", "ς", "日本", "'s", "'S", "'ll", "''re", "1", "²", "½", " ", "  ", "\n", "\t", "\x0b",
                "\x1c", "\x7f", "\x85", "\xa0", " ", ".", "?!", "…", "<|", "<|endoftext|>", "<|ENDOFTEXT|>", "<<", "|>", "é", "́", "ﬁ", "👍🏽", "Ǆ", "﻿"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    texts += ["".join(rng.choice(["the", "THE", "over", "don't", "x", ",", " ", "\n", "Ünï", "42"]) for _ in range(300)) for _ in range(50)]
    got = encoder.encode(texts)
    for text, ids in zip(texts, got):
        assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids, text
    again = encoder.encode(texts[::-1])[::-1]              # from the dictionary
    assert all((a == b).all() for a, b in zip(got, again))


def test_slices_and_a_forgotten_dictionary_change_nothing(plain, monkeypatch):
    monkeypatch.setattr(packing, "SLICE", 40)
    monkeypatch.setattr(packing, "REMEMBERED", 5)
    with open(MODEL, encoding="utf-8") as f:
        encoder = packing.Encoder(f.read())
    texts = [None, "", "word " * 100, "no-blank" * 50, "a\n\nb  c", "It's 12 o'clock, " * 30]
    got, ended = collections.defaultdict(list), []
    for rows, parts, ends in packing.slices(texts):
        for row, ids, end in zip(rows, encoder.encode(parts), ends):
            got[row] += ids.tolist()
            ended += [row] * end
    assert ended == list(range(len(texts)))
    for row, text in enumerate(texts):
        assert got[row] == plain.encode(text or "", add_special_tokens=False).ids


@given(st.dictionaries(st.integers(1, 40), st.integers(1, 6), max_size=6), st.integers(0, 60))
@settings(max_examples=200, deadline=None)
def test_fullest_multiset(pool, capacity):
    picked = packing.fullest(sorted(((n, k) for n, k in pool.items() if n <= capacity), reverse=True), capacity)
    assert all(0 < k <= pool[n] for n, k in picked.items())
    sums = {0}
    for n, k in pool.items():
        sums |= {s + n * j for s in sums for j in range(1, k + 1)}
    assert sum(n * k for n, k in picked.items()) == max(s for s in sums if s <= capacity)


@given(st.lists(st.integers(1, 100), max_size=60), st.integers(1, 200))
@settings(max_examples=150, deadline=None)
def test_every_window_is_full_but_the_last_powers_of_two(sizes, pool):
    packer, ids = packing.Packer(32, pool, 5), {}
    for k, n in enumerate(sizes):
        ids[k] = [list(range(k * 1000, k * 1000 + n))]
        packer.feed(np.array(ids[k][0][:n // 2], np.uint32))
        packer.feed(np.array(ids[k][0][n // 2:], np.uint32))
        packer.end(k)
    packer.finish()
    Piece = collections.namedtuple("Piece", ["doc_id", *packing.PIECE])
    rows = [Piece(d[0], start, length, crc, d[1], seq, offset) for d, start, length, crc, seq, offset in packer.rows]
    padding = check(rows, ids, 32)
    assert sum(padding.values()) == 0
    total = sum(sizes)
    assert len(padding) == total // 32 + bin(total % 32).count("1") and (not padding or min(padding) == 5)


def test_round_trip_of_awkward_rows(spark, plain):
    docs = odd_documents(spark, n=40, long_words=20_000)
    ids = collections.defaultdict(list)
    for r in docs.collect():
        ids[r.doc_id].append(ids_of(plain, r.text))
    pieces = packing.pack(docs, MODEL).collect()
    padding = check(pieces, ids)
    assert sum(padding.values()) == 0
    small = packing.pack(docs, MODEL, capacity=64, pool=500).collect()
    assert sum(check(small, ids, 64).values()) == 0


def test_whole_documents_are_preferred(spark, plain):
    """Copies whose lengths add up to a window are not cut."""
    text = " ".join(["word"] * 1023)                        # with the end token 1024 ids
    docs = spark.createDataFrame([(i, text) for i in range(40)], "doc_id long, text string").coalesce(1)
    pieces = packing.pack(docs, MODEL).collect()
    assert len(pieces) == 40 and len({p.sequence_id for p in pieces}) == 10
    assert all(p.length == p.doc_tokens == 1024 for p in pieces)


def test_empty_table_and_text_ids(spark):
    assert packing.pack(no_documents(spark), MODEL).collect() == []
    docs = spark.createDataFrame([("a", None), (None, "")], "doc_id string, text string").coalesce(1)
    pieces = packing.pack(docs, MODEL).collect()
    assert {(p.doc_id, p.start, p.length, p.doc_tokens) for p in pieces} == {("a", 0, 1, 1), (None, 0, 1, 1)}
    assert len({p.sequence_id for p in pieces}) == 1
