"""Benchmark decontamination by a generalised suffix automaton of the items' words.

Method: the automaton of all items is built once per block of items and sent to the tasks; each
document's words are streamed through it, which keeps at every word the longest match that ends
there. Matches of at least a window's length are hits; a document is contaminated if hits cover
enough of it. ``cut_spans`` removes the hits, ``keep_clean`` the contaminated documents. Items are dealt to blocks of bounded size, and every block sees every document, so a
block's automaton has a size bound (``BLOCK_WORDS`` words, or one item).
"""

from __future__ import annotations

import pickle
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import ROW_KEY, alnum_words, lean_batches, own_names, row_keyed, text_slices
from starmart.session import stored

WINDOW = 13
COVERAGE = 20  # contaminated: one word in so many is hit
BLOCK_WORDS = 200_000
HIT_SCHEMA = f"{ROW_KEY} string, doc_id long, n_words long, spans array<struct<start:long,stop:long>>, items array<string>"


class Automaton:
    """All runs of words of a set of items, with the items that hold each window.

    A window is ``window`` consecutive words of an item; a shorter item is one window.
    """

    def __init__(self, items: Iterable[tuple[str | None, list[bytes]]], window: int = WINDOW) -> None:
        self.window = window
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        items = [(name, words) for name, words in items if words]
        for _, words in items:
            last = 0
            for word in words:
                last = self._extend(last, word)
        self._mark(items)

    def _state(self, length: int, link: int, moves: dict[bytes, int]) -> int:
        self.next.append(moves)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, at: int, word: bytes, to: int) -> int:
        """A copy of ``to`` for the runs that end at ``at`` and ``word``; shorter ones move to it."""
        copy = self._state(self.length[at] + 1, self.link[to], dict(self.next[to]))
        self.link[to] = copy
        while at >= 0 and self.next[at].get(word) == to:
            self.next[at][word] = copy
            at = self.link[at]
        return copy

    def _extend(self, last: int, word: bytes) -> int:
        there = self.next[last].get(word)
        if there is not None:
            fits = self.length[there] == self.length[last] + 1
            return there if fits else self._split(last, word, there)
        new = self._state(self.length[last] + 1, 0, {})
        at = last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = new
            at = self.link[at]
        if at >= 0:
            to = self.next[at][word]
            self.link[new] = to if self.length[to] == self.length[at] + 1 else self._split(at, word, to)
        return new

    def _mark(self, items: list[tuple[str | None, list[bytes]]]) -> None:
        """Which states hold a window, whose windows they are, and words without which none occurs."""
        window, shorts = self.window, {}
        owners: dict[int, set] = {}
        frequency = Counter(word for _, words in items for word in words)
        rare = frequency.__getitem__
        self.anchors: set[bytes] = set()
        for name, words in items:
            size, state = min(window, len(words)), 0
            for at, word in enumerate(words):
                state = self.next[state][word]
                while self.length[self.link[state]] >= size:
                    state = self.link[state]
                if at + 1 >= size:
                    if size == window:
                        owners.setdefault(state, set()).add(name)
                    else:
                        shorts.setdefault(state, set()).add((size, name))
                    held = words[at + 1 - size:at + 1]
                    if self.anchors.isdisjoint(held):
                        self.anchors.add(min(held, key=rare))
        self.owners = [()] * len(self.next)
        self.shorts = [()] * len(self.next)
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            above = self.link[state]
            self.shorts[state] = self.shorts[above] + tuple(shorts.get(state, ()))
            if self.length[state] >= window:
                self.owners[state] = tuple(owners.get(state, self.owners[above]))
        self.holds = [bool(s) or n >= window for s, n in zip(self.shorts, self.length)]

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Spans [start, stop) of the words in any window's occurrence, merged, and the items met."""
        spans: list[tuple[int, int]] = []
        found: set[str] = set()
        if self.anchors.isdisjoint(words):
            return spans, found
        moves, link, length, holds = self.next, self.link, self.length, self.holds
        state = matched = 0
        for at, word in enumerate(words):
            to = moves[state].get(word)
            while to is None and state:
                state = link[state]
                matched = length[state]
                to = moves[state].get(word)
            if to is None:
                continue
            state, matched = to, matched + 1
            if not holds[state]:
                continue
            reach = 0
            if matched >= self.window:
                reach = matched
                found.update(self.owners[state])
            for size, name in self.shorts[state]:
                if size <= matched:
                    reach = max(reach, size)
                    found.add(name)
            if reach:
                start = at + 1 - reach
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append((start, at + 1))
        return spans, found


def automata(benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> Iterator[bytes]:
    """Pickled automata, one per block of items, built in the tasks and fetched one at a time.

    Items are dealt to as many blocks as their bytes call for. Rows without words have no window.
    Rows that share an item_id are parts of one item that do not touch.
    """
    texts = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // (4 * block_words)))

    def build(key: tuple, rows: pa.Table) -> pa.Table:
        names = rows.column("item_id").to_pylist()
        words = [alnum_words(t or b"") for t in rows.column("text").cast(pa.large_binary()).to_pylist()]
        made = pickle.dumps(Automaton(zip(names, words), window), protocol=5)
        return pa.table({"automaton": pa.array([made], pa.binary())})

    dealt = texts.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    built = stored(dealt.groupBy("block").applyInArrow(build, "automaton binary"), "automata")
    for row in built.toLocalIterator():
        yield bytes(row["automaton"])


def hits(docs: DataFrame, automaton: bytes) -> DataFrame:
    """(row key, doc_id, n_words, spans, items) of every keyed row against one block's automaton."""
    lean_batches(docs)
    sent = docs.sparkSession.sparkContext.broadcast(automaton)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = pickle.loads(sent.value)
        schema = pa.schema([(ROW_KEY, pa.string()), ("doc_id", pa.int64()), ("n_words", pa.int64()),
                            ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
                            ("items", pa.list_(pa.string()))])
        for batch in batches:
            keys = iter(batch.column(2).to_pylist())
            for ids, texts in text_slices(batch):
                rows = []
                for doc_id, text in zip(ids, texts):
                    words = alnum_words(text)
                    spans, found = machine.scan(words)
                    rows.append({ROW_KEY: next(keys), "doc_id": doc_id, "n_words": len(words),
                                 "spans": [{"start": a, "stop": b} for a, b in spans],
                                 "items": sorted(name for name in found if name is not None)})
                yield pa.RecordBatch.from_pylist(rows, schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", ROW_KEY).mapInArrow(
        scan, HIT_SCHEMA)


def _merged(spans):
    """Sorted spans, those that touch or overlap put together."""
    start = F.array().cast("array<struct<start:bigint,stop:bigint>>")

    def add(done, span):
        last = F.element_at(done, -1)
        joined = F.struct(last["start"].alias("start"), F.greatest(last["stop"], span["stop"]).alias("stop"))
        return F.when((F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["stop"] >= span["start"]),
                      F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined))).otherwise(
                          F.concat(done, F.array(span)))

    return F.aggregate(F.sort_array(spans), start, add)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  coverage: int = COVERAGE) -> DataFrame:
    """(doc_id, n_words, n_hit, spans, items, contaminated): one row per input row.

    spans are [start, stop) in words, apart from each other; items are the ids, as strings, of items
    with an occurring window. Null or empty text has no words and is never contaminated. Items with
    a null id hit, but are not listed. Empty benchmark: nothing is hit. Rows that share a doc_id or have
    none are judged each by its own text. Extra columns are ignored.
    """
    return _contamination(row_keyed(docs, "doc_id", "text"), benchmark, window, coverage).drop(ROW_KEY)


def _contamination(docs: DataFrame, benchmark: DataFrame, window: int, coverage: int) -> DataFrame:
    """``contamination`` of keyed rows, with their keys."""
    found = None
    blocks = 0
    for automaton in automata(benchmark, window):
        one = hits(docs, automaton)
        blocks += 1
        if blocks == 2:
            found = stored(found, "hits")
        found = one if found is None else found.unionByName(stored(one.where(F.size("spans") > 0), "hits"))
    if found is None:
        found = hits(docs, pickle.dumps(Automaton([], window)))
    if blocks > 1:
        found = found.groupBy(ROW_KEY).agg(
            F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"),
            _merged(F.flatten(F.collect_list("spans"))).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return (found.withColumn("n_hit", n_hit)
            .withColumn("contaminated", (F.col("n_hit") > 0)
                        & (F.lit(coverage) * F.col("n_hit") >= F.col("n_words"))))


def without_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans: each span is cut from its first word's first to its
    last word's last byte."""
    data = text.encode()
    at = [m.span() for m in re.finditer(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", data)]
    out, done = [], 0
    for start, stop in spans:
        out.append(data[done:at[start][0]])
        done = at[stop - 1][1]
    return b"".join([*out, data[done:]]).decode("utf-8", "replace")


@own_names
def keep_clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
               coverage: int = COVERAGE) -> DataFrame:
    """The rows of ``docs``, all columns, whose own text is not contaminated."""
    keyed = row_keyed(docs)
    found = _contamination(keyed, benchmark, window, coverage)
    gone = stored(found.where("contaminated").select(ROW_KEY), "contaminated")
    return keyed.join(gone, ROW_KEY, "left_anti").select(*docs.columns)


@own_names
def cut_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
              coverage: int = COVERAGE) -> DataFrame:
    """All rows of ``docs``, all columns, with the spans cut out of each row's own text.

    A span goes if it has ``window`` words or more; shorter ones, which are whole short items, go where the
    text is contaminated. Texts without such spans, null and empty ones stay as they are. A text that is
    nothing but spans keeps what stands around its words. Only texts with hits go through Python again.
    """
    keyed = row_keyed(docs)
    long_enough = lambda s: F.col("contaminated") | (s["stop"] - s["start"] >= window)
    found = stored(_contamination(keyed, benchmark, window, coverage).where(F.size("spans") > 0)
                   .select(ROW_KEY, F.filter("spans", long_enough).alias("__spans"))
                   .where(F.size("__spans") > 0), "spans")

    @F.pandas_udf("string")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([without_spans(text, [(s["start"], s["stop"]) for s in held])
                          for text, held in zip(texts, spans)], dtype=object)

    hit = keyed.join(found, ROW_KEY).withColumn("text", cut("text", "__spans"))
    clean = keyed.join(found, ROW_KEY, "left_anti")
    return clean.select(*docs.columns).unionByName(hit.select(*docs.columns))
