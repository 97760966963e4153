"""The licence scan against an alignment without an index."""

import math
import random
import time

import pytest

import brute
from llm_cases import corpus  # noqa: F401
from starmart.llm import license_scan
from starmart.llm.common import alnum_words
from starmart.llm.license_scan import MIN_SCORE, NOTICES, SLACK, TEMPLATES, Index, vocabulary

COMMON = "the of and to in this is with under by for alpha beta".split()


def rarities(rng):
    return {word: math.log(1 + rng.choice([0, 1, 3, 20, 500])) + 1e-3 for word in sorted(vocabulary(TEMPLATES))}


def damaged(rng, text):
    """A notice with words lost, added or replaced, some of them its own words again."""
    out = []
    for word in text.split():
        fate = rng.random()
        if fate < 0.08:
            continue
        if fate < 0.16:
            out += rng.choices(COMMON, k=rng.randint(1, 3))
        out.append(rng.choice(COMMON) if fate > 0.95 else word)
    return out


def written(rng):
    words = []
    for _ in range(rng.randint(1, 5)):
        words += rng.choices(COMMON + ["license", "version", "2", "0", "cc", "software"], k=rng.randint(0, 12))
        words += damaged(rng, rng.choice(TEMPLATES).text)
    return words


def expected(index, words):
    out = []
    for number, template in enumerate(TEMPLATES):
        if not template.fixed:
            out += [(template.label, *place) for place in brute.license_places(
                words, template.text.split(), index.idf[number], template.phrases, MIN_SCORE, SLACK)]
    return sorted(set(out))


@pytest.mark.parametrize("seed", range(40))
def test_places_equal_those_without_an_index(seed):
    rng = random.Random(seed)
    index = Index(TEMPLATES, rarities(rng))
    for _ in range(8):
        words = written(rng)
        found = index.places([w.encode() for w in words])
        assert sorted({(label, *place) for label, is_fixed, *place in found if not is_fixed}) == expected(index, words)


def test_two_rare_words_must_agree():
    """Rarities as in a corpus: most templates need two words in place, so single words are no candidates."""
    index = Index(TEMPLATES, {w: 0.1 if w.decode() in COMMON else 5.0 for w in vocabulary(TEMPLATES)})
    mit = next(k for k, t in enumerate(TEMPLATES) if t.text.startswith("permission is hereby"))
    assert index.agreeing[mit] == 2
    words = TEMPLATES[mit].text.split()
    place = {w: 100 * k for k, w in enumerate(words)}  # all its words, far apart
    assert index._windows(mit, [(place[w], words.index(w)) for w in set(words)]) == []
    assert len(index._windows(mit, [(7 + k, k) for k in range(len(words))])) == 1


def test_headers_and_identifiers(spark):
    texts = ["Apache License\nVersion 2.0, January 2004", "GNU GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007",
             "// SPDX-License-Identifier: MIT", "SPDX-License-Identifier: GPL-3.0-or-later", "an identifier of a license"]
    texts += ["Redistributions of source code must retain the above copyright notice, this list of conditions and the "
              "following disclaimer."] + ["plain words"] * 20
    found = license_scan.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    labels = {r.doc_id: {p.label for p in r.places if not p.fixed} for r in found}
    assert [labels[k] for k in range(7)] == [{"apache-2.0"}, {"gpl-3.0"}, {"mit"}, {"gpl-3.0"}, set(), {"bsd"}, set()]


def test_scan_equals_brute_force(corpus, spark):  # noqa: F811
    """Whole rows, with the rarities of the corpus itself."""
    rng = random.Random(3)
    texts = [t for _, t in corpus if t is None or len(t) < 20_000]
    texts += [" ".join(damaged(rng, rng.choice(NOTICES).text)) for _ in range(60)]
    held = {w: sum(w in set(alnum_words((t or "").encode())) for t in texts) for w in vocabulary(TEMPLATES)}
    index = Index(TEMPLATES, {w: math.log((1 + len(texts)) / (1 + n)) + 1e-3 for w, n in held.items()})
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    hits = 0
    for r in license_scan.scan(rows).collect():
        words = [w.decode() for w in alnum_words((texts[r.doc_id] or "").encode())]
        want = expected(index, words)
        assert sorted({(p.label, p.start, p.stop, p.score) for p in r.places if not p.fixed}) == want
        hits += len(want)
    assert hits >= 30


def test_licence_words_over_and_over_take_linear_time():
    index = Index(TEMPLATES, {w: 2.0 for w in vocabulary(TEMPLATES)})
    rng, pool = random.Random(1), [w for t in TEMPLATES for w in t.text.split()]
    started = time.time()
    index.places([w.encode() for w in rng.choices(pool, k=50_000)])
    index.places([b"license"] * 50_000)
    assert time.time() - started < 60
