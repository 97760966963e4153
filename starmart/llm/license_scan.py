"""License scan with a positional index of rare words.

Method: templates are indexed by their rarest words, rarity being the inverse document frequency in
the scanned corpus itself. A file's licence words are looked up, rarest first, and the places that
their postings imply for a template are intersected: two different rare words must stand where the
template has them, give or take the words that may be missing or added between. Around such places the
template is aligned, and a place counts if enough of the template's rarity is there in order and its
mandatory phrases are. Fixed phrases are templates of which every word is mandatory.

So many rare words are indexed that no place which would count lacks the two; ``Index`` says why.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import alnum_words, lean_batches, text_slices

MIN_SCORE = 0.75
SLACK = 2  # words that may be missing or added between one found word of a template and the next
RESULT = "doc_id long, n_words long, places array<struct<label:string,fixed:boolean,start:long,stop:long,score:double>>"


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    phrases: tuple[str, ...]
    fixed: bool = False


def fixed(label: str, phrase: str) -> Template:
    return Template(label, phrase, (phrase,), True)


FIXED = (fixed("cc-by", "cc by"), fixed("gpl", "general public license"), fixed("reserved", "all rights reserved"))

# Notices of public licences, as their texts recommend them; each with what must stand in it.
NOTICES = (
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license",)),
    Template("mit", "released under the mit license", ("mit license",)),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software "
             "and associated documentation files", ("permission is hereby granted", "free of charge")),
    Template("gpl-3.0", "this work is licensed under the gnu general public license version 3",
             ("general public license version 3",)),
    Template("gpl-2.0", "this work is licensed under the gnu general public license version 2",
             ("general public license version 2",)),
    Template("lgpl", "licensed under the gnu lesser general public license", ("lesser general public license",)),
    Template("agpl-3.0", "licensed under the gnu affero general public license", ("affero general public license",)),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0",
             ("mozilla public license",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
             ("redistribution and use", "are permitted")),
    Template("cc-by-4.0", "licensed under cc by 4 0", ("cc by 4",)),
    Template("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc",)),
    Template("cc-by-sa-4.0", "licensed under cc by sa 4 0", ("cc by sa",)),
    Template("cc0-1.0", "dedicated to the public domain under cc0 1 0", ("cc0",)),
)
# First lines of licence texts, and clauses that other notices leave out.
HEADERS = (
    Template("apache-2.0", "apache license version 2 0 january 2004", ("apache license version 2 0",)),
    Template("apache-2.0", "unless required by applicable law or agreed to in writing software distributed under the "
             "license is distributed on an as is basis", ("applicable law or agreed to in writing",)),
    Template("gpl-3.0", "gnu general public license version 3 29 june 2007", ("general public license version 3",)),
    Template("gpl-2.0", "gnu general public license version 2 june 1991", ("general public license version 2",)),
    Template("lgpl", "gnu lesser general public license version", ("lesser general public license",)),
    Template("agpl-3.0", "gnu affero general public license version 3 19 november 2007",
             ("affero general public license version 3",)),
    Template("mpl-2.0", "mozilla public license version 2 0", ("mozilla public license version 2 0",)),
    Template("bsd", "redistributions of source code must retain the above copyright notice this list of conditions "
             "and the following disclaimer", ("redistributions of source code must retain",)),
    Template("mit", "the above copyright notice and this permission notice shall be included in all copies or "
             "substantial portions of the software", ("this permission notice shall be included",)),
    Template("cc-by-4.0", "creative commons attribution 4 0 international", ("creative commons attribution 4",)),
    Template("cc-by-sa-4.0", "creative commons attribution sharealike 4 0 international",
             ("creative commons attribution sharealike",)),
    Template("cc0-1.0", "creative commons cc0 1 0 universal", ("cc0 1 0 universal",)),
)


def identifier(label: str, name: str) -> Template:
    """The short form that names a licence in a source file; all of it is mandatory."""
    text = f"spdx license identifier {name}"
    return Template(label, text, (text,))


IDENTIFIERS = tuple(identifier(label, name) for label, name in (
    ("apache-2.0", "apache 2 0"), ("mit", "mit"), ("gpl-3.0", "gpl 3 0"), ("gpl-2.0", "gpl 2 0"), ("lgpl", "lgpl"),
    ("agpl-3.0", "agpl 3 0"), ("mpl-2.0", "mpl 2 0"), ("bsd", "bsd 2 clause"), ("bsd", "bsd 3 clause"),
    ("cc-by-4.0", "cc by 4 0"), ("cc-by-sa-4.0", "cc by sa 4 0"), ("cc0-1.0", "cc0 1 0")))
TEMPLATES = FIXED + NOTICES + HEADERS + IDENTIFIERS


def vocabulary(templates: tuple[Template, ...]) -> set[bytes]:
    return {word for t in templates for word in alnum_words(t.text.encode())}


def rarity(docs: DataFrame, words: set[bytes]) -> dict[bytes, float]:
    """Inverse document frequency over all rows; one count per word and task is shuffled."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for _, texts in text_slices(batch):
                found[b""] += len(texts)
                for text in texts:
                    found.update(words.intersection(alnum_words(text)))
        yield pa.RecordBatch.from_arrays([pa.array([w.decode() for w in found], pa.string()),
                                          pa.array(list(found.values()), pa.int64())], ["word", "n"])

    rows = (docs.select("doc_id", "text").mapInArrow(count, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).collect())
    held = {row["word"].encode(): row["n"] for row in rows}
    return {word: math.log((1 + held.get(b"", 0)) / (1 + held.get(word, 0))) + 1e-3 for word in words}


class Chains:
    """The best alignments of one template that end at each match, met in the order of places.

    A match is a word of the template at a place of the text; its shift is the place less its position in
    the template. An alignment goes from match to match with growing positions and places, and from one
    to the next the shift changes by ``SLACK`` at most. It is worth the rarity of its words. Matches of one
    shift come by growing position, so the best alignment of a shift up to a position is a running maximum.
    """

    def __init__(self, weights: list[float]) -> None:
        self.weights = weights
        self.by_shift: dict[int, list[tuple[int, tuple[float, int]]]] = {}

    def extend(self, place: int, positions: list[int]) -> list[tuple[float, int]]:
        """(worth, start) of the best alignment that ends at ``place`` with each of ``positions``; of
        several the one that starts last."""
        ends = []
        for at in positions:
            shift, best = place - at, (0.0, place)
            for near in range(shift - SLACK, shift + SLACK + 1):
                # A few matches at the end may stand further on in the template than this one.
                for before, (worth, start) in reversed(self.by_shift.get(near, ())):
                    if before < at:
                        best = max(best, (worth, start))
                        break
            ends.append((best[0] + self.weights[at], best[1]))
        for at, end in zip(positions, ends):
            seen = self.by_shift.setdefault(place - at, [])
            seen.append((at, max(end, seen[-1][1]) if seen else end))
        return ends


class Index:
    """Templates by their rarest words; ``places`` finds them in a list of words.

    A place counts if words worth ``min_score`` of a template's rarity stand there, so the missing ones are
    worth the rest at most. Words are indexed, rarest first, until they are worth more than that rest even
    without the rarest of them: then at least two indexed words stand at any place that counts. Where one
    word outweighs the others, one has to do, and enough words are indexed that one is there.
    """

    def __init__(self, templates: tuple[Template, ...], idf: dict[bytes, float], min_score: float = MIN_SCORE) -> None:
        self.templates, self.min_score = templates, min_score
        self.words = [alnum_words(t.text.encode()) for t in templates]
        self.phrases = [[alnum_words(p.encode()) for p in t.phrases] for t in templates]
        self.idf = [[idf[w] for w in words] for words in self.words]
        self.total = [sum(weights) for weights in self.idf]
        self.positions = [defaultdict(list) for _ in templates]
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        self.agreeing = []
        for number, words in enumerate(self.words):
            for at, word in enumerate(words):
                self.positions[number][word].append(at)
            needed, anchors = self._anchors(number)
            self.agreeing.append(needed)
            for at in anchors:
                self.postings[words[at]].append((number, at))
        self.rarest_first = sorted(self.postings, key=lambda word: (-idf[word], word))

    def _anchors(self, number: int) -> tuple[int, list[int]]:
        """How many indexed words must agree, and the positions of the indexed words."""
        weights = self.idf[number]
        by_rarity = sorted(range(len(weights)), key=lambda at: (-weights[at], at))
        if self.templates[number].fixed:
            return 1, by_rarity[:1]
        rest = (1 - self.min_score) * self.total[number] * (1 + 1e-9)
        for needed in (2, 1):
            held = 0.0
            for count, at in enumerate(by_rarity, 1):
                held += weights[at] if count >= needed else 0.0
                if held > rest:
                    return needed, by_rarity[:count]
        return 1, by_rarity

    def _windows(self, number: int, hits: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """The intersection: stretches of text around hits (place, position) that another one agrees with."""
        hits, size = sorted(hits), len(self.words[number])
        reach = (1 + SLACK) * size
        agreed = [self.agreeing[number] == 1] * len(hits)
        for one, (place, at) in enumerate(hits):
            for two in range(one + 1, len(hits)):
                other, further = hits[two]
                if other - place > reach:
                    break
                if further > at and other > place and abs(other - further - place + at) <= SLACK * (further - at):
                    agreed[one] = agreed[two] = True
        windows: list[tuple[int, int]] = []
        for (place, at), holds in zip(hits, agreed):
            if not holds:
                continue
            first, last = max(0, place - (1 + SLACK) * at), place + (1 + SLACK) * (size - at)
            if windows and first <= windows[-1][1]:
                windows[-1] = (min(first, windows[-1][0]), max(last, windows[-1][1]))
            else:
                windows.append((first, last))
        return windows

    def _holds_phrases(self, number: int, words: list[bytes], start: int, stop: int) -> bool:
        near = words[max(0, start - SLACK):stop + SLACK]
        return all(any(near[k:k + len(p)] == p for k in range(len(near) - len(p) + 1)) for p in self.phrases[number])

    def aligned(self, number: int, words: list[bytes], first: int, last: int) -> list[tuple[int, int, float]]:
        """(start, stop, score) of the places in a stretch that count; of overlapping ones the best."""
        chains, positions, found = Chains(self.idf[number]), self.positions[number], set()
        for place in range(first, min(last, len(words))):
            for worth, start in chains.extend(place, positions.get(words[place], [])):
                score = min(1.0, worth / self.total[number])
                if score >= self.min_score and self._holds_phrases(number, words, start, place + 1):
                    found.add((-score, start, place + 1))
        kept: list[tuple[int, int, float]] = []
        for negative, start, stop in sorted(found):
            next_one = bisect_left(kept, (start,))
            if (next_one == 0 or kept[next_one - 1][1] <= start) and (
                    next_one == len(kept) or stop <= kept[next_one][0]):
                kept.insert(next_one, (start, stop, -negative))
        return kept

    def places(self, words: list[bytes]) -> list[tuple[str, bool, int, int, float]]:
        """(label, fixed, start, stop, score) of every place, stops exclusive, in order."""
        present = self.postings.keys() & set(words)
        if not present:
            return []
        at_places: dict[bytes, list[int]] = defaultdict(list)
        for place, word in enumerate(words):
            if word in present:
                at_places[word].append(place)
        hits: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for word in self.rarest_first:
            for number, at in self.postings[word] if word in present else ():
                hits[number].extend((place, at) for place in at_places[word])
        out = set()
        for number, of_template in hits.items():
            template, size = self.templates[number], len(self.words[number])
            if template.fixed:
                out.update((template.label, True, place - at, place - at + size, 1.0) for place, at in of_template
                           if place >= at and words[place - at:place - at + size] == self.words[number])
            elif len({at for _, at in of_template}) >= self.agreeing[number]:
                for first, last in self._windows(number, of_template):
                    out.update((template.label, False, *place) for place in self.aligned(number, words, first, last))
        return sorted(out, key=lambda x: (x[2], x[3], x[0], x[4]))


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """(doc_id, n_words, places): one row per input row; texts are not shuffled.

    places are structs (label, fixed, start, stop, score) in words from 0, all of them, in order.
    Null or empty text has no words and no places. Repeated rows and rows without doc_id are scanned
    like any other. Extra columns are ignored; an empty table gives an empty one.
    """
    lean_batches(docs)
    index = Index(templates, rarity(docs, vocabulary(templates)))
    kind = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("places", pa.list_(pa.struct(
        [("label", pa.string()), ("fixed", pa.bool_()), ("start", pa.int64()), ("stop", pa.int64()),
         ("score", pa.float64())])))])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in text_slices(batch):
                rows = []
                for doc_id, text in zip(ids, texts):
                    words = alnum_words(text)
                    rows.append({"doc_id": doc_id, "n_words": len(words), "places": [
                        dict(zip(("label", "fixed", "start", "stop", "score"), p)) for p in index.places(words)]})
                yield pa.RecordBatch.from_pylist(rows, kind)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(find, RESULT)
