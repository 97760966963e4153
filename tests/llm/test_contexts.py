"""Contexts of the Pitman-Yor model: each is the token before, and its totals are those of all buckets."""

import random
from collections import Counter

import numpy as np
import pytest
from llm_cases import corpus, docs  # noqa: F401
from pyspark.sql import functions as F

from starmart.llm import pitman_yor


def test_context_is_the_token_before(spark):
    """Tokens that end alike are different contexts."""
    rows = [(k, "walking north" if k % 2 else "talking south", False) for k in range(80)]
    rows += [(100, "walking north", True), (101, "walking south", True), (102, "talking south", True),
             (103, "talking north", True), (104, "unseen north", True), (105, "north", True)]
    table = spark.createDataFrame(rows, "doc_id long, text string, held boolean").repartition(3)
    found = {r.doc_id: r.score for r in pitman_yor.score_documents(table, F.col("held").alias("held_out")).collect()}
    assert len(found) == len(rows) and all(np.isfinite(x) and x < 0 for x in found.values())
    assert found[100] > found[101] + 1 and found[102] > found[103] + 1
    assert found[104] < found[103] and found[105] > found[104]


def test_totals_of_contexts_are_those_of_all_buckets(spark, docs, corpus):
    expected = Counter()
    kinds = {}
    for _, text in corpus:
        words = [w.lower() for w in (text or "").encode().split()] + [b""]
        for before, word in zip([b"", *words], words):
            expected[before] += 1
            kinds.setdefault(before, set()).add(word)
    parts = pitman_yor.stored_by(pitman_yor.counted(docs, F.lit(False).alias("held_out"), 5, 3000), "bucket", 5, "parts")
    state = pitman_yor.stored_by(pitman_yor._merged(parts, 7), "bucket", 5, "seating", deal=False)
    names = {(r.bucket, r.grp): pitman_yor._unpack(bytes(r.data))[0].split(b"\n")
             for r in state.where("kind = 'names'").collect()}
    directory = pitman_yor.stored_by(pitman_yor._directory(state), "grp", 5, "contexts", deal=False)
    seen, buckets = set(), Counter()
    for r in pitman_yor._summed_tables(directory, [state], customers=True).collect():
        customers, tables = pitman_yor._unpack(bytes(r.data))
        for name, n, t in zip(names[r.bucket, r.grp], customers, tables, strict=True):
            assert n == expected[name] and t == len(kinds[name])
            seen.add(name)
            buckets[name] += 1
    assert seen == set(expected) and max(buckets.values()) > 1
    shared = pitman_yor._shared(state)
    assert shared[0] == sum(expected.values()) and shared[1] == sum(map(len, kinds.values()))


@pytest.mark.parametrize("largest", [pitman_yor.LARGEST_KEY, 0])
def test_chunks_count_pairs_and_their_documents(monkeypatch, largest):
    """Of texts with any white space, also where a pair and its document don't fit one number."""
    monkeypatch.setattr(pitman_yor, "LARGEST_KEY", largest)
    rng = random.Random(3)
    texts = [b"", b" ", b"\n", b"\x0b\x0c", b"A a  b\r\n\tB", "É é É".encode(), b"a\x00 \xff\x01 a\x00"] + [
        bytes(rng.choice(b"aAbB\x00\x1c\xff \n\t\r\x0b\x0c") for _ in range(rng.choice([1, 5, 80]))) for _ in range(60)]
    chunk, expected, learnt = pitman_yor.Chunk(5), Counter(), Counter()
    for k, text in enumerate(texts):
        chunk.add(k, k % 7 == 2, text)
        words = [*text.lower().split(), b""]
        for before, word in zip([b"", *words], words):
            expected[word, before, k] += 1
            learnt[word, before] += k % 7 != 2
    (_, docs, _), *buckets = chunk.cut()
    assert pitman_yor._unpack(docs) == [(k, k % 7 == 2, len(t.split()) + 1) for k, t in enumerate(texts)]
    found, found_learnt = Counter(), Counter()
    for _, pairs, entries in buckets:
        words, names, each, context, times = pitman_yor._unpack(pairs)
        words, names = words.split(b"\n")[:-1], names.split(b"\n")[:-1]
        assert len(set(words)) == len(words) and names == sorted(set(names), key=lambda w: w + b"\n")
        listed = [(w, names[c]) for w, c in zip(np.repeat(np.array(words, object), each), context)]
        found_learnt.update(dict(zip(listed, times.tolist())))
        many, doc, times, n = pitman_yor._unpack(entries)
        assert n == len(texts) and many.sum() == len(doc)
        for (word, before), k, number in zip([p for p, m in zip(listed, many) for _ in range(m)], doc.tolist(), times.tolist()):
            found[word, before, k] += number
    assert found == expected and +found_learnt == +learnt


@pytest.mark.parametrize("size", [1, 40, 1 << 20])
def test_words_are_numbered_the_same_in_any_slices(monkeypatch, size):
    monkeypatch.setattr(pitman_yor, "SLICE_BYTES", size)
    rng = random.Random(4)
    lists = [[b"%d" % rng.randrange(60) for _ in range(rng.randrange(30))] + [b""] for _ in range(30)]
    lines = [b"".join(w + b"\n" for w in words) for words in lists]
    words, numbers = pitman_yor.Words(), {}
    for number, k in words.numbered((x, k) for k, x in enumerate(lines)):
        assert number.tolist() == [numbers.setdefault(w, len(numbers)) for w in lists[k]]
    assert words.words.to_pylist() == [w + b"\n" for w in numbers]
    (number, _), = words.numbered([(b"new\n7\nother\n", None)], new=False)
    assert number[1] == numbers[b"7"] and min(number[0], number[2]) >= len(numbers) == len(words.words)


def test_dishes_of_many_tables_take_few_array_steps(monkeypatch):
    """What a few frequent pairs need beyond the others is done with plain numbers, with the same draws."""
    class Counting:
        def __init__(self):
            self.rng, self.arrays = np.random.default_rng(7), 0

        def beta(self, *args):
            return self.rng.beta(*args)

        def random(self, *size):
            self.arrays += bool(size)
            return self.rng.random(*size)

    customers = np.array([2_000_000, 3, 1, 50_000, 7] + [2] * 40)
    weight = np.linspace(30, 1, len(customers))
    fast, slow = Counting(), Counting()
    tables = pitman_yor.seat(customers, weight, 0.7, fast)
    assert tables.max() > 300 and fast.arrays < 20
    monkeypatch.setattr(pitman_yor, "FEW", 0)
    assert (tables == pitman_yor.seat(customers, weight, 0.7, slow)).all() and slow.arrays > 300
