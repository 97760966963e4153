"""Spelling variants: words one edit apart, grouped under the most frequent spelling.

Method: the minimised acceptor of the vocabulary is composed with a transducer of exactly one inserted,
deleted or replaced code point and with the acceptor again; the pairs that the composition accepts are
the near words. The composition is cut by its initial states, so that no task sees the whole vocabulary:
of two near words of which the longer has L code points, either the first ceil((L-1)/2) agree or the last
floor((L-1)/2) do. Words meet under the shared part, and what is left of them there, which differs by
one edit again, is composed by itself. Parts under which too many words meet are cut the same way once
more, until two code points are left, of which the alphabet bounds the number.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.session import stored

LETTERS = "A-Za-zÀ-ÿ"
MIN_CHARS = 5
MIN_COUNT = 3
DROP_EVERY = 97  # a run whose crc32 this divides loses a code point
TIMES = 2  # a form is at least this many times as frequent
CROWDED = 20_000


# --- words -----------------------------------------------------------------------------------------

def _lowered(run: Column) -> Column:
    """A-Z become a-z; ``lower`` does the same where all characters are ASCII, and is faster."""
    return F.when(F.octet_length(run) == F.char_length(run), F.lower(run)).otherwise(
        F.translate(run, string.ascii_uppercase, string.ascii_lowercase))


def vocabulary(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): the words of all texts, some without a code point, and how often they occur.

    A null doc_id counts as no digits before the colon. Runs below ``min_chars`` can't become words, so
    they aren't looked at. Counts are summed before they are shuffled.
    """
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all(
        "text", F.lit(f"[{LETTERS}]{{{min_chars},}}"), F.lit(0))).alias("run"))
    low = runs.select("doc_id", _lowered(F.col("run")).alias("run"))
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    hashed = low.select("run", F.crc32(F.concat(name, F.lit(":"), F.col("run")).cast("binary")).alias("h"))
    place = (F.col("h") % F.char_length("run")).cast("int")
    word = F.when(F.col("h") % DROP_EVERY == 0, F.concat(F.substring("run", F.lit(1), place),
                                                         F.substring("run", place + 2, F.char_length("run")))
                  ).otherwise(F.col("run"))
    return (hashed.select(word.alias("word")).where(F.char_length("word") >= min_chars)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count))


# --- composition -----------------------------------------------------------------------------------

class Acceptor:
    """The minimal deterministic acceptor of sorted different words, built word by word."""

    def __init__(self, words: list[str]) -> None:
        self.arcs: list[dict[str, int]] = [{}]
        self.final: list[bool] = [False]
        known: dict[tuple, int] = {}
        path = [0]  # states of the last word
        last = ""
        for word in words:
            shared = 0
            for a, b in zip(word, last):
                if a != b:
                    break
                shared += 1
            self._settle(path, last, shared, known)
            for char in word[shared:]:
                self.arcs.append({})
                self.final.append(False)
                self.arcs[path[-1]][char] = len(self.arcs) - 1
                path.append(len(self.arcs) - 1)
            self.final[path[-1]] = True
            last = word
        self._settle(path, last, 0, known)

    def _settle(self, path: list[int], last: str, shared: int, known: dict[tuple, int]) -> None:
        """States behind the shared part won't change: replace each by its equal."""
        while len(path) > shared + 1:
            state = path.pop()
            same = known.setdefault((self.final[state], tuple(self.arcs[state].items())), state)
            self.arcs[path[-1]][last[len(path) - 1]] = same


def _spelled(path: tuple | None) -> str:
    found = []
    while path:
        path, char = path
        found.append(char)
    return "".join(reversed(found))


def one_edit_pairs(words: list[str]) -> list[tuple[str, str]]:
    """The pairs that acceptor, one-edit transducer and acceptor accept together, each once: the longer
    word or, of equal lengths, the smaller one comes first."""
    made = Acceptor(sorted(words))
    arcs, final = made.arcs, made.final
    found: list[tuple[str, str]] = []

    def agree(left: int, right: int, one: tuple | None, two: tuple | None, unless: str | None) -> None:
        """After the edit both read the same to the end; ``unless`` may not be the first that they read."""
        ahead = [(left, right, one, two)]
        while ahead:
            left, right, one, two = ahead.pop()
            if final[left] and final[right]:
                found.append((_spelled(one), _spelled(two)))
            others = arcs[right]
            for char, to in arcs[left].items():
                if char in others and char != unless:
                    ahead.append((to, others[char], (one, char), (two, char)))
            unless = None

    unread: list[tuple[int, tuple | None]] = [(0, None)]  # before the edit both are in one state
    while unread:
        state, path = unread.pop()
        out = arcs[state]
        chars = sorted(out)
        for at, char in enumerate(chars):
            to = out[char]
            unread.append((to, (path, char)))
            agree(to, state, (path, char), path, char)  # deleted; its next equal would give the pair again
            for other in chars[at + 1:]:
                agree(to, out[other], (path, char), (path, other), None)
    return found


# --- partitions ------------------------------------------------------------------------------------

def halves(length: int) -> tuple[int, int]:
    """Code points at the front and at the end, one of which near words of up to ``length`` share."""
    return length - 1 - (length - 1) // 2, (length - 1) // 2


def route(one: str, two: str, length: int, depth: int) -> str:
    """Of the parts under which two near words meet, the one at each depth that has to report them."""
    found = ""
    for _ in range(depth):
        front, end = halves(length)
        if one[:front] == two[:front]:
            found, one, two, length = found + "f", one[front:], two[front:], length - front
        else:
            found, one, two, length = found + "b", one[:len(one) - end], two[:len(two) - end], length - end
    return found


def _cut(rows: DataFrame) -> DataFrame:
    """Each row under the front part of its rest and under the end part, with what is left there."""
    end = F.expr("(room - 1) div 2")
    front = F.col("room") - 1 - end
    size = F.char_length("rest")
    piece = lambda side, key, rest, room: F.struct(
        F.concat("route", F.lit(side)).alias("route"), F.concat("key", F.lit("/"), key).alias("key"),
        rest.alias("rest"), room.cast("int").alias("room"))
    sides = F.array(
        piece("f", F.substring("rest", F.lit(1), front.cast("int")),
              F.substring("rest", (front + 1).cast("int"), size), F.col("room") - front),
        piece("b", F.substring("rest", (size - end + 1).cast("int"), end.cast("int")),
              F.substring("rest", F.lit(1), (size - end).cast("int")), F.col("room") - end))
    return (rows.select("word", "n", "longest", F.explode(sides).alias("p"))
            .select("word", "n", "longest", "p.route", "p.key", "p.rest", "p.room"))


def _compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near words of each part; rows come with equal (longest, route, key) together."""
    found: list[tuple[str, int, str, int]] = []
    members: dict[str, tuple[str, int]] = {}
    last = None

    def finish() -> None:
        if len(members) > 1:
            longest, path = last[0], last[1]
            for one, two in one_edit_pairs(list(members)):
                (word, n), (other, m) = members[one], members[two]
                if max(len(word), len(other)) == longest and route(word, other, longest, len(path)) == path:
                    found.append((word, n, other, m))
        members.clear()

    def made() -> pa.RecordBatch:
        columns = [[row[k] for row in found] for k in range(4)]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string() if k % 2 == 0 else pa.int64())
                                           for k, c in enumerate(columns)], ["word", "n", "near", "m"])

    for batch in batches:
        columns = [batch.column(name).to_pylist() for name in ("longest", "route", "key", "rest", "word", "n")]
        for longest, path, key, rest, word, n in zip(*columns):
            if (longest, path, key) != last:
                finish()
                last = (longest, path, key)
            members[rest] = (word, n)
        if len(found) > 10_000:
            yield made()
            found.clear()
    finish()
    yield made()


def near_words(words: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """(word, n, near, m): each pair of the different words (word, n) that are one edit apart, once.

    A part under which more than ``crowded`` words meet is cut again; with two code points left it holds
    no more words than there are pairs of letters.
    """
    size = F.char_length("word")
    rows = _cut(words.select("word", "n", F.explode(F.array(size, size + 1)).alias("longest"))
                .select("word", "n", "longest", F.lit("").alias("route"), F.lit("").alias("key"),
                        F.col("word").alias("rest"), F.col("longest").alias("room")))
    part = ["longest", "route", "key"]
    found = None
    while True:
        too_many = stored(rows.groupBy(*part).agg(F.count(F.lit(1)).alias("held"), F.max("room").alias("most"))
                          .where((F.col("held") > crowded) & (F.col("most") > 2)).select(*part), "crowded-parts")
        large = not too_many.isEmpty()
        small = rows.join(too_many, part, "left_anti") if large else rows
        pairs = (small.repartition(*part).sortWithinPartitions(*part)
                 .mapInArrow(_compose, "word string, n long, near string, m long"))
        found = pairs if found is None else found.unionByName(pairs)
        if not large:
            return found
        rows = stored(_cut(rows.join(too_many, part, "left_semi")), "crowded-words")


# --- forms -----------------------------------------------------------------------------------------

def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): the last of the forms that follow from a word.

    Each round doubles the steps that a row has gone; a form is ``TIMES`` as frequent as its word, so
    rounds grow with the logarithm of the logarithm of the largest count.
    """
    gone = stored(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "roots")
    while not gone.where("moved").isEmpty():
        ahead = gone.select(F.col("word").alias("at"), F.col("root").alias("next"))
        gone = stored(gone.join(ahead, F.col("root") == F.col("at"), "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
    return gone.select("word", "root")


def variants(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT,
             times: int = TIMES, crowded: int = CROWDED) -> DataFrame:
    """(word, form, root, n, n_near, form_n): one row per word of the texts.

    form: the most frequent near word, the smallest of several, if it is ``times`` as frequent as the
    word, else null; root: the last form that follows, or the word. Null and empty texts have no words; a
    null doc_id has no digits in the hash; rows that occur twice count twice. Nothing in, nothing out.
    Extra columns are ignored.
    """
    words = stored(vocabulary(docs.select("doc_id", "text"), min_chars, min_count), "vocabulary")
    pairs = stored(near_words(words, crowded), "near-words")
    both = pairs.unionByName(pairs.select(F.col("near").alias("word"), F.col("m").alias("n"),
                                          F.col("word").alias("near"), F.col("n").alias("m")))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                    F.min(F.struct((-F.col("m")).alias("less"), "near")).alias("best"))
    judged = words.join(best, "word", "left")
    formed = -F.col("best")["less"] >= F.lit(times) * F.col("n")
    table = stored(judged.select(
        "word", F.when(formed, F.col("best")["near"]).alias("form"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(formed, -F.col("best")["less"]).alias("form_n")), "word-forms")
    last = roots(table.where("form IS NOT NULL").select("word", "form"))
    return (table.join(last, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
