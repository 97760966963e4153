"""Plain single-process answers to the operators' contracts, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def line_dedup(docs):
    """{doc_id: (n_lines, n_dropped, sha256)} of [(doc_id, text)] with different ids."""
    holders = defaultdict(set)
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    for i, text in docs:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 10:
                holders[key(line)].add(i)
    out = {}
    for i, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(holders.get(key(x), ())) < 2 or min(holders[key(x)]) == i]
        out[i] = (len(lines), len(lines) - len(kept), sha("\n".join(kept)))
    return out


def decontaminate(docs, items, window=13, coverage=20):
    """{doc_id: (n_words, n_hit, n_items, sha256 of items, contaminated)}."""
    words_of = lambda text: ALNUM.findall((text or "").translate(LOWER))
    windows = defaultdict(set)
    for name, text in items:
        words = words_of(text)
        size = min(window, len(words))
        for at in range(len(words) - size + 1 if words else 0):
            windows[tuple(words[at:at + size])].add(str(name))
    sizes = {len(w) for w in windows}
    out = {}
    for i, text in docs:
        words = words_of(text)
        hit, met = set(), set()
        for size in sizes:
            for at in range(len(words) - size + 1):
                owner = windows.get(tuple(words[at:at + size]))
                if owner:
                    hit.update(range(at, at + size))
                    met |= owner
        out[i] = (len(words), len(hit), len(met), sha(",".join(sorted(met))),
                  bool(hit) and 20 * len(hit) >= len(words))
    return out


def tokens(docs, path):
    """[(doc_id, start, n_tokens, crc32)] in ascending doc_id order."""
    import numpy as np
    from tokenizers import Tokenizer

    made, start, out = Tokenizer.from_file(path), 0, []
    for i, text in sorted(docs):
        ids = made.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def targets(sizes, weights=(5, 2, 1), most=3):
    """{source: target} by sharing out again and again, in exact numbers."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    left, held = Fraction(sum(sizes.values())), {}
    while True:
        free = [s for s in names if s not in held]
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] > most * sizes[s] * total]
        if not over:
            return {s: float(v) for s, v in (held | {s: left * weight[s] / total for s in free}).items()}
        for s in over:
            held[s] = Fraction(most * sizes[s])
            left -= held[s]


def license_base(text):
    """(n_words, n_base, first, last, labels) of the fixed phrases."""
    words = ALNUM.findall((text or "").translate(LOWER))
    found = []
    for phrase, label in (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")):
        want = phrase.split()
        found += [(at, label) for at in range(len(words)) if words[at:at + len(want)] == want]
    at = [a for a, _ in found]
    return len(words), len(found), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in found}))


def quality(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    grams = Counter(zip(words, words[1:], words[2:]))
    repeated = {k + d for k, g in enumerate(zip(words, words[1:], words[2:])) if grams[g] > 1 for d in range(3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(repeated),
            len(words) < 50 or 100 * len(repeated) > 50 * len(words))


def fingerprint(text):
    import xxhash

    words = WORD.findall((text or "").translate(LOWER))
    shingles = [" ".join(words[k:k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, radius=3):
    """{doc_id: smallest linked doc_id} of {doc_id: fingerprint}."""
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    for k, a in enumerate(ids):
        for b in ids[:k]:
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


def url_rule(url):
    """(host, path, rule, verdict of the rule)."""
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1].translate(LOWER), m[2]) if m else ("", "")
    best = None
    for verdict, rule in (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")):
        name, _, rest = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            if best is None or len(rule) > len(best[0]):
                best = (rule, verdict)
    return (host, path, *(best or (None, None)))


def base_scores(docs):
    """{doc_id: (held_out, n_tokens, n_known, train_tokens, base_score)}."""
    import math

    tokens_of = lambda text: WORD.findall((text or "").translate(LOWER)) + [None]
    out_of = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    counts = Counter(t for i, text in docs if not out_of(i) for t in tokens_of(text))
    n, v = sum(counts.values()), len(counts)
    out = {}
    for i, text in docs:
        found = [counts[t] for t in tokens_of(text)]
        out[i] = (out_of(i), len(found), sum(c > 0 for c in found), n,
                  sum(math.log10((c + 1) / (n + 1 * (v + 1))) for c in found))
    return out


def license_places(words, template, weights, phrases, least, slack):
    """(start, stop, score) of the places of a template, from all its words at all places, with no index.

    Every alignment of found words in order, the shift from one to the next changing by ``slack`` at most;
    per last word the one worth most, then the one that starts last; of overlapping places the best.
    """
    met = [(place, at) for place in range(len(words)) for at in range(len(template)) if words[place] == template[at]]
    ends, found = {}, set()
    for place, at in met:
        before = [ends[p, a] for p, a in met if p < place and a < at and abs(place - at - p + a) <= slack]
        worth, start = max(before, default=(0.0, place))
        ends[place, at] = (max(worth, 0.0) + weights[at], start)
        near = " " + " ".join(words[max(0, start - slack):place + 1 + slack]) + " "
        score = min(1.0, ends[place, at][0] / sum(weights))
        if score >= least and all(f" {p} " in near for p in phrases):
            found.add((-score, start, place + 1))
    kept = []
    for score, start, stop in sorted(found):
        if all(stop <= a or b <= start for a, b, _ in kept):
            kept.append((start, stop, -score))
    return sorted(kept)
