"""Spelling variants against comparing all pairs."""

import random
import re
import zlib
from collections import Counter

import pytest
from llm_cases import corpus, docs, no_docs, odd_docs  # noqa: F401

from starmart.llm import spelling

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def counted(rows):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) == len(b) + 1 and any(a[:k] + a[k + 1:] == b for k in range(len(a)))


def variants(counts):
    out, form = {}, {}
    for w, n in counts.items():
        near = [x for x in counts if one_edit(w, x)]
        best = min(near, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best and counts[best] >= 2 * n else None
        out[w] = len(near)
    found = {}
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        found[w] = (form[w], root, n, out[w], counts[form[w]] if form[w] else None)
    return found


def rows_of(df):
    rows = df.collect()
    found = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(found) == len(rows)
    return found


def misspelt(seed, words=400, letters="abé"):
    rng = random.Random(seed)
    base = ["".join(rng.choices(letters, k=rng.randint(4, 9))) for _ in range(words)]
    texts = []
    for k in range(300):
        picked = rng.choices(base, weights=[1 / (i + 1) for i in range(words)], k=60)
        texts.append(" ".join(w if rng.random() < 0.8 else w.replace("a", "", 1) for w in picked) + ("\n" if k % 2 else "."))
    return list(enumerate(texts))


@pytest.mark.parametrize("crowded", [20_000, 12])
def test_variants(spark, crowded):
    """Also where parts under which many words meet are cut again and again."""
    rows = misspelt(3)
    wanted = variants(counted(rows))
    assert max(v[3] for v in wanted.values()) > 3 and any(v[1] != v[0] for v in wanted.values() if v[0])
    table = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, word string, n int")
    assert rows_of(spelling.variants(table.repartition(3), crowded=crowded)) == wanted


def test_words(docs, corpus):
    found = {r.word: r.n for r in spelling.vocabulary(docs).collect()}
    assert found == counted(corpus)


def test_code_points_are_dropped(spark):
    """Enough runs that the hash divides some; upper case beyond ASCII stays."""
    rows = [(i, " ".join(f"Wörd{a}xÉ" for a in "abcD")) for i in range(3000)]
    wanted = counted(rows)
    assert any("É" not in w for w in wanted) and any("É" in w for w in wanted)
    assert {r.word: r.n for r in spelling.vocabulary(spark.createDataFrame(rows, "doc_id long, text string")).collect()} == wanted


def test_long_chains(spark):
    """Roots over several forms; words of thousands of letters."""
    chain = [("a" * k + "bcdefg" + "z" * 3000, 3 * 2 ** k) for k in range(5)] + [("tiedaaa", 6), ("tiedaab", 6), ("tiedaax", 3)]
    rows = [(k, w) for w, n in chain for k in range(n)]
    counts = counted(rows)
    assert rows_of(spelling.variants(spark.createDataFrame(rows, "doc_id long, text string"))) == variants(counts)


def test_pairs_of_few_letters():
    """The composition accepts exactly the pairs that are one edit apart, each once."""
    rng = random.Random(1)
    for _ in range(60):
        words = sorted({"".join(rng.choices("ab", k=rng.randint(0, 6))) for _ in range(rng.randint(1, 40))})
        found = [tuple(sorted(p)) for p in spelling.one_edit_pairs(words)]
        assert len(found) == len(set(found))
        assert set(found) == {(a, b) for a in words for b in words if a < b and one_edit(a, b)}


def test_acceptors_are_minimal():
    made = spelling.Acceptor(sorted(["tap", "taps", "top", "tops"]))
    reached, seen = [0], {0}
    while reached:
        for to in made.arcs[reached.pop()].values():
            if to not in seen:
                seen.add(to)
                reached.append(to)
    assert len(seen) == 5


def test_each_pair_is_reported_under_one_part():
    """Whatever the place of the edit, one of the two parts is shared."""
    rng = random.Random(2)
    for _ in range(2000):
        a = "".join(rng.choices("ab", k=rng.randint(5, 12)))
        k = rng.randrange(len(a))
        b = a[:k] + rng.choice(["", "c"]) + a[k + 1:]
        length, one, two = max(len(a), len(b)), a, b
        for side in spelling.route(a, b, length, 2):
            front, end = spelling.halves(length)
            assert one[:front] == two[:front] if side == "f" else one[len(one) - end:] == two[len(two) - end:]
            one, two = (one[front:], two[front:]) if side == "f" else (one[:len(one) - end], two[:len(two) - end])
            length -= front if side == "f" else end


def test_odd_rows(spark, odd_docs, no_docs):
    rows = [tuple(r)[:2] for r in odd_docs.collect()]
    assert rows_of(spelling.variants(odd_docs)) == variants(counted(rows))
    assert spelling.variants(no_docs).count() == 0
    assert spelling.variants(spark.createDataFrame([(1, None), (None, "")], "doc_id long, text string")).count() == 0
