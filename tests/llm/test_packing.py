"""Packing: pieces, the plan, and whole tables against the contract."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from llm_cases import corpus, docs, no_docs, odd_docs  # noqa: F401
from tokenizers import Tokenizer

from starmart.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def ids_of(text):
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids + [2]


def check_places(rows, most=1024):
    """Sequences without gaps or overlaps; how many there are."""
    held = {}
    for r in rows:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at and length > 0
            at += length
        assert at <= most
    return len(held)


@pytest.mark.parametrize("n, most", [(1, 4), (4, 4), (5, 4), (8, 4), (11, 4), (3000, 1024)])
def test_cut(n, most):
    found = packing.cut(n, most)
    assert sum(size for _, size in found) == n and all(size == most for _, size in found[1:])
    assert [start for start, _ in found] == [sum(s for _, s in found[:k]) for k in range(len(found))]
    assert len(found) == -(-n // most)


def test_patterns_are_all_there():
    lengths = [1, 2, 3, 5, 6, 9, 12]
    found = {tuple(x for x in row if x) for row in packing.patterns(np.array(lengths), 12).tolist()}
    wanted = {(12,)} | {(a, b) for a in lengths for b in lengths if a <= b and a + b == 12}
    wanted |= {(a, b, c) for a in lengths for b in lengths for c in lengths if a <= b <= c and a + b + c == 12}
    assert found == wanted
    assert packing.patterns(np.array(lengths), 12, most=5).shape[0] == 3  # (12,), (3, 9) and (6, 6)


def test_least_squares_meets_its_conditions():
    """No pattern in use has a slope; no pattern out of use would gain."""
    random = np.random.default_rng(3)
    histogram = np.append(0, random.integers(0, 1000, 60))
    made = packing.patterns(np.flatnonzero(histogram), 60)
    x = packing.repeat_counts(made, histogram, sweeps=20_000)
    weight = np.arange(61) / 60
    slope = (weight * (np.bincount(made.ravel(), np.repeat(x, 3), 61) - histogram))[made].sum(axis=1)
    assert (x >= 0).all() and slope.min() > -1 and np.abs(slope[x > 1]).max() < 1


@pytest.mark.parametrize("seed", range(4))
def test_plans_use_each_piece_once(seed):
    random = np.random.default_rng(seed)
    histogram = np.zeros(129, np.int64)
    for length in random.choice(np.arange(1, 129), random.integers(1, 120), replace=False):
        histogram[length] = random.integers(0, [3, 50, 10_000][seed % 3])
    plan = packing.plan(histogram)
    length = np.repeat(np.arange(129), histogram)
    rank = np.concatenate([np.arange(n) for n in histogram])
    sequence, offset = plan.places(length, rank)
    order = np.lexsort((offset, sequence))
    sequence, offset, length = sequence[order], offset[order], length[order]
    new = np.append(True, sequence[1:] != sequence[:-1])
    ends = offset + length
    assert (offset[new] == 0).all() and (offset[1:][~new[1:]] == ends[:-1][~new[1:]]).all() and ends.max() <= 128
    assert new.sum() == plan.sequences
    fewest = max(-(-length.sum() // 128), (length > 64).sum())
    assert plan.sequences <= 1.12 * fewest + 2


def test_nearly_full_sequences():
    """Many documents of mixed lengths leave next to nothing empty."""
    random = np.random.default_rng(1)
    lengths = np.clip(random.lognormal(5.5, 1.0, 200_000).astype(int), 1, 1024)
    histogram = np.bincount(lengths, minlength=1025)
    assert packing.plan(histogram).sequences <= 1.002 * lengths.sum() / 1024


def test_pack(docs, corpus):
    rows = packing.pack(docs, PATH).collect()
    wanted = {}
    for doc_id, text in corpus:
        ids = ids_of(text)
        for piece, (start, size) in enumerate(packing.cut(len(ids), 1024)):
            wanted[doc_id, piece] = (start, size, zlib.crc32(np.array(ids[start:start + size], "<u4").tobytes()))
    assert len(rows) == len(wanted)
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == wanted
    total = sum(size for _, size, _ in wanted.values())
    assert check_places(rows) <= total / 1024 + 1.5


def test_sequences_hold_the_ids(docs, corpus):
    rows = packing.packed_sequences(docs.where("doc_id > 10"), PATH, max_tokens=300).collect()
    packed = [tuple(part) for r in rows for part in
              np.split(np.frombuffer(r.ids, "<u4"), np.cumsum(r.lengths)[:-1])]
    wanted = [tuple(ids[start:start + size]) for i, text in corpus if i > 10 for ids in [ids_of(text)]
              for start, size in packing.cut(len(ids), 300)]
    assert sorted(packed) == sorted(wanted)


def test_pack_odd_rows(odd_docs, no_docs):
    rows = packing.pack(odd_docs, PATH).collect()
    assert len(rows) == 8 and [r.length for r in rows if r.doc_id == 3] == [1]
    assert sum(r.doc_id is None for r in rows) == 2
    check_places(rows)
    assert packing.pack(no_docs, PATH).count() == 0


def test_plan_keeps_the_pieces_apart(docs):
    """No sort by length and no cross join."""
    text = packing.pack(docs, PATH)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in text and "NestedLoop" not in text
