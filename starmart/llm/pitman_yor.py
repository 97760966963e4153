"""Language-model scoring by a hierarchical Pitman-Yor model.

Method: a token is served in the restaurant of its context, the token before it (the end of a text, where a
text starts); all context restaurants share a parent, which sends to a uniform base over the known tokens and
one unknown. Seating is sampled by Gibbs sweeps: in a sweep every dish of every restaurant is reseated as a
block by the Chinese restaurant process, given the other dishes' and the restaurants' totals of the last
sweep. Predictive probabilities are averaged over the sweeps after the burn-in.

How it runs: tasks turn chunks of documents into counts of (token, context) and of the documents that have
them, cut into buckets of tokens by a hash; they are shuffled once and kept by bucket, for training and for
scoring. A bucket holds its share of the vocabulary, and the contexts that its tokens come in. Sweeps run
per bucket on counts alone. A context's tokens lie in many buckets, so its tables are added up between them
in every sweep: contexts are dealt into groups, a bucket sends its tables of a group's contexts as bare
numbers, in an order that the group's directory knows, and gets the sums back in that order. Only totals
over all contexts reach the driver. Scores go back to the chunks as sums per document. A frequent pair of
tokens is one entry per document, however often it occurs.
"""

from __future__ import annotations

import ctypes
import math
import pickle
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import lean_batches, text_slices
from starmart.session import new_folder

CONTEXTS = 64  # groups of contexts for CONTEXT_BYTES of text and less; they grow with the text's cube root
CONTEXT_BYTES = 16 << 20
CHUNK_BYTES = 12 << 20  # of text; a longer document is a chunk of its own
BUCKET_BYTES = 32 << 20  # of text per bucket
SLICE_BYTES = 4 << 20  # of words that are numbered at once; more where more are known
BLOCK = 1 << 18  # types whose probabilities are computed at once
LARGEST_KEY = (1 << 63) - 1
FEW = 16  # dishes
BURN_IN = 2
SAMPLES = 3
STRENGTH = 1.0
END = b""  # no word is empty
OTHERS = 6  # totals that don't belong to a context
MOST_FILES = 100_000  # Spark's limit of buckets of a table
RESULT = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
          "score double")

# ASCII white space becomes a line break, A-Z become a-z.
_LINES = bytes(10 if b == 32 or 9 <= b <= 13 else b + 32 if 65 <= b <= 90 else b for b in range(256))


def _pack(value) -> bytes:
    return zstandard.compress(pickle.dumps(value, protocol=5), 3)


def _unpack(data: bytes):
    return pickle.loads(zstandard.decompress(data))


def _small(values: np.ndarray) -> np.ndarray:
    """The same numbers in as few bytes each as the largest needs."""
    return values.astype(np.min_scalar_type(int(values.max())) if len(values) else np.uint8)


def _batch(rows: list[tuple], names: tuple[str, ...], types: tuple) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], list(names))


def _array(offsets: np.ndarray, data: bytes) -> pa.LargeBinaryArray:
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1,
                                            [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _ends(lines: bytes) -> np.ndarray:
    """Where lines end, after a 0."""
    breaks = np.flatnonzero(np.frombuffer(lines, np.uint8) == 10)
    ends = np.zeros(len(breaks) + 1, np.int64)
    np.add(breaks, 1, out=ends[1:])
    return ends


def _listed(lines: bytes) -> pa.LargeBinaryArray:
    """Words that have a line each, with their line breaks; no word holds white space."""
    return _array(_ends(lines), lines)


def _lines(words: pa.LargeBinaryArray, cuts: Iterable[int] | None = None) -> Iterator[bytes]:
    """The lines of the words between two ``cuts`` each, or of all words."""
    cuts = [0, len(words)] if cuts is None else list(cuts)
    _, offsets, data = words.buffers()
    if not len(words):
        yield from (b"" for _ in cuts[1:])
        return
    at = np.frombuffer(offsets, np.int64)[words.offset:][cuts].tolist()
    for first, last in zip(at, at[1:]):
        yield data[first:last].to_pybytes()


def _crcs(words: pa.LargeBinaryArray) -> np.ndarray:
    """crc32 of the words without their line breaks."""
    cuts = [*range(0, len(words), 1 << 16), len(words)]
    return np.concatenate([np.fromiter(map(zlib.crc32, lines[:-1].split(b"\n")), np.int64)
                           for lines in _lines(words, cuts)])


class Words:
    """Numbers of words from 0; a new word gets the next."""

    def __init__(self) -> None:
        self.words = pa.array([], pa.large_binary())

    def numbered(self, parts: Iterable[tuple[bytes, Any]], new: bool = True) -> Iterator[tuple[np.ndarray, Any]]:
        """The numbers of each part's lines, and what comes with them. Without ``new`` words stay unknown,
        under numbers after the last one.

        Parts are numbered some at a time: at least half as many bytes as all known words have, as these are
        hashed again for each time.
        """
        waiting, size = [], 0
        for part in parts:
            waiting.append(part)
            size += len(part[0])
            if size >= max(SLICE_BYTES, self.words.nbytes // 2):
                yield from self._encoded(waiting, new)
                waiting, size = [], 0
        if waiting:
            yield from self._encoded(waiting, new)

    def _encoded(self, parts: list[tuple[bytes, Any]], new: bool) -> Iterator[tuple[np.ndarray, Any]]:
        at, sizes = len(self.words), [lines.count(b"\n") for lines, _ in parts]
        lines, others = b"".join(lines for lines, _ in parts), [rest for _, rest in parts]
        parts.clear()
        found = pa.concat_arrays([self.words, _listed(lines)])
        del lines
        found = found.dictionary_encode()
        if new:
            self.words = found.dictionary
        numbers = found.indices.to_numpy()
        del found
        _release()
        for size, rest in zip(sizes, others):
            yield numbers[at:at + size], rest
            at += size


def _release() -> None:
    """Give back what Arrow and C's allocator hold but don't use: a worker lives on after its task."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):  # not glibc
        pass


def stored_by(df: DataFrame, key: str, files: int, label: str, deal: bool = True) -> DataFrame:
    """Like ``stored``, as a table in buckets of ``key``: what groups by it reads it without a shuffle.
    ``deal`` is False for rows that lie together by key already."""
    spark, name, files = df.sparkSession, f"starmart_{uuid.uuid4().hex}", min(files, MOST_FILES)
    (df.repartition(files, key) if deal else df).write.bucketBy(files, key).option(
        "path", new_folder(spark, label)).format("parquet").saveAsTable(name)
    return spark.table(name)


def contexts_for(text_bytes: int) -> int:
    """How many groups the contexts of so much text are dealt into.

    Each bucket sends a row per group in each sweep, so rows stay few against the text at any size.
    """
    return max(CONTEXTS, int(CONTEXTS * (text_bytes / CONTEXT_BYTES) ** (1 / 3)))


class Chunk:
    """Tokens of some documents, to be cut into counts per bucket."""

    def __init__(self, buckets: int) -> None:
        self.buckets = buckets
        self.docs: list[tuple] = []  # (doc_id, held_out)
        self.texts: list[bytes] = []
        self.bytes = 0

    def add(self, doc_id, held_out: bool, text: bytes) -> None:
        self.texts.append(text.translate(_LINES))
        self.docs.append((doc_id, held_out))
        self.bytes += len(text)

    def _tokens(self) -> tuple[pa.LargeBinaryArray, np.ndarray]:
        """All tokens, an empty line for an end, and how many each document has."""
        last = np.cumsum([len(text) + 2 for text in self.texts])
        lines, self.texts = b"\n\n".join([*self.texts, b""]), []
        ends = _ends(lines)
        keep = np.diff(ends) > 1  # the other empty lines come of white space beside white space
        keep[np.searchsorted(ends, last) - 1] = True
        words = _array(ends, lines)
        if not keep.all():
            words, ends = words.filter(pa.array(keep)), ends[1:][keep]
        else:
            ends = ends[1:]
        return words, np.diff(np.searchsorted(ends, last, side="right"), prepend=0)

    def cut(self) -> Iterator[tuple[int, bytes, bytes]]:
        """(bucket, packed pairs of token and context, packed documents of each pair), and under -1 the
        documents themselves."""
        tokens, lengths = self._tokens()
        yield -1, _pack([(*doc, n) for doc, n in zip(self.docs, lengths.tolist())]), b""
        tokens = tokens.dictionary_encode()
        by_word = pc.array_sort_indices(tokens.dictionary)
        words, rank = tokens.dictionary.take(by_word), np.empty(len(by_word), np.int64)
        rank[by_word.to_numpy()] = np.arange(len(words))
        flat = rank[tokens.indices.to_numpy()]
        del tokens, by_word, rank
        bucket = _crcs(words) % self.buckets
        order = np.argsort(bucket, kind="stable")
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        keys = place[flat] * len(words)
        keys += np.roll(flat, 1)  # a text starts after an end, as the last token is
        del flat
        key, doc, times = _counted_runs(keys, np.repeat(np.arange(len(lengths)), lengths), len(words) ** 2)
        del keys
        new = np.diff(key, prepend=-1) != 0
        pairs, pair = key[new], np.cumsum(new) - 1
        token, context = np.divmod(pairs, len(words))
        train = np.array([not held for _, held in self.docs])
        learnt = np.bincount(pair, times * train[doc], len(pairs)).astype(np.int64)
        edges = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        lines = list(_lines(words.take(order), edges))
        place = np.empty(len(words), np.int64)
        _release()
        for number in np.flatnonzero(np.diff(edges)):
            first, last = edges[number], edges[number + 1]
            low, high = np.searchsorted(token, [first, last])
            used = np.zeros(len(words), bool)
            used[context[low:high]] = True
            used = np.flatnonzero(used)
            place[used] = np.arange(len(used))
            at = slice(*np.searchsorted(pair, [low, high]))
            yield (int(number),
                   _pack((lines[number], next(_lines(words.take(used))),
                          _small(np.bincount(token[low:high] - first, minlength=last - first)),
                          _small(place[context[low:high]]), _small(learnt[low:high]))),
                   _pack((_small(np.bincount(pair[at] - low, minlength=high - low)), _small(doc[at]),
                          _small(times[at]), len(lengths))))


def _counted_runs(keys: np.ndarray, doc: np.ndarray, bound: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each different pair of a key below ``bound`` and a document, in order, and how often it occurs."""
    docs = int(doc[-1]) + 1
    if bound * docs <= LARGEST_KEY:  # one number for both: sorting numbers is faster than sorting places
        both = keys * docs
        both += doc
        both.sort()
        starts = np.flatnonzero(np.diff(both, prepend=-1))
        return *np.divmod(both[starts], docs), np.diff(starts, append=len(both))
    at = np.argsort(keys, kind="stable")  # documents stay in order within a key
    keys, doc = keys[at], doc[at]
    starts = np.flatnonzero((np.diff(keys, prepend=-1) != 0) | (np.diff(doc, prepend=-1) != 0))
    return keys[starts], doc[starts], np.diff(starts, append=len(keys))


def counted(docs: DataFrame, held_out: Column, buckets: int, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(bucket, chunk, pairs, entries) of all documents; the documents themselves stand under buckets below 0."""
    names, types = ("bucket", "chunk", "pairs", "entries"), (pa.int32(), pa.int64(), pa.binary(), pa.binary())

    def rows(chunk: Chunk, number: int) -> Iterator[pa.RecordBatch]:
        own = -1 - zlib.crc32(b"%d" % number) % buckets
        for bucket, pairs, entries in chunk.cut():
            yield _batch([(bucket if bucket >= 0 else own, number, pairs, entries)], names, types)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, chunk = TaskContext.get().partitionId() << 32, Chunk(buckets)
        for batch in batches:
            flags = batch.column(2).to_pylist()
            at = 0
            for ids, texts in text_slices(batch):
                for doc_id, text in zip(ids, texts):
                    chunk.add(doc_id, flags[at], text)
                    at += 1
                    if chunk.bytes >= chunk_bytes:
                        yield from rows(chunk, number)
                        number, chunk = number + 1, Chunk(buckets)
        if chunk.docs:
            yield from rows(chunk, number)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out).mapInArrow(
        cut, "bucket int, chunk long, pairs binary, entries binary")


def _by_key(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows of sorted batches, one at a time."""
    for batch in batches:
        columns = [batch.column(k) for k in range(batch.num_columns)]
        for at in range(batch.num_rows):
            yield tuple(c[at].as_py() for c in columns)


@dataclass
class Bucket:
    """Training counts and seating of a bucket's tokens: types are (token, context) pairs, sorted."""

    words: pa.LargeBinaryArray
    types: np.ndarray  # token * contexts + context
    counts: np.ndarray
    tables: np.ndarray  # of each type in its context's restaurant
    parents: np.ndarray  # of each token in the parent restaurant
    samples: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    contexts: int = CONTEXTS

    def totals(self) -> np.ndarray:
        """Per context its customers and its tables; then tokens, parent tables, and types and tokens
        with one and with two customers."""
        n = self.contexts
        context, sent = self.types % n, np.bincount(self.types // n, self.tables, len(self.words))
        ones = [(x == few).sum() for x in (self.counts, sent) for few in (1, 2)]
        return np.concatenate([np.bincount(context, self.counts, n), np.bincount(context, self.tables, n),
                               [len(self.words), self.parents.sum(), *ones]]).astype(np.int64)


class Totals:
    """What buckets need to know of each other: ``Bucket.totals`` summed. Where these are of some contexts
    only, ``sent`` is the number of tables of all."""

    def __init__(self, sums: np.ndarray, discounts: tuple[float, float] | None = None,
                 sent: float | None = None) -> None:
        n = (len(sums) - OTHERS) // 2
        self.customers, self.tables = sums[:n].astype(float), sums[n:2 * n].astype(float)
        self.words, self.parent_tables, *ones = (float(x) for x in sums[2 * n:])
        estimate = lambda one, two: min(0.95, max(0.05, one / (one + 2 * two) if one else 0.5))
        self.discount, self.parent_discount = discounts or (estimate(*ones[:2]), estimate(*ones[2:]))
        self.base = 1 / (self.words + 1)
        self.sent = self.tables.sum() if sent is None else float(sent)

    def parent(self, sent: np.ndarray, parents: np.ndarray) -> np.ndarray:
        """The parent's predictive probability of tokens with so many customers and tables there."""
        spare = (STRENGTH + self.parent_discount * self.parent_tables) * self.base
        return (np.maximum(sent - self.parent_discount * parents, 0) + spare) / (STRENGTH + self.sent)

    def spare(self, context: np.ndarray) -> np.ndarray:
        """What a context's restaurant leaves to new tables, times its strength and customers."""
        return STRENGTH + self.discount * self.tables[context]


def seat(customers: np.ndarray, weight: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Tables that customers of one dish take in a Chinese restaurant process.

    With n seated at t tables the next one opens a table with odds weight : n - discount * t. How many
    join tables before that follows a geometric distribution of beta-distributed chance, so each step
    goes from one new table to the next. The last dishes, which have thousands of tables where pairs are
    frequent, go on as plain numbers, with the same draws.
    """
    tables = np.minimum(customers, 1)
    at = np.flatnonzero(customers > 1)
    seated = np.ones(len(at))
    while len(at) > FEW:
        chance = rng.beta(weight[at], seated - discount * tables[at])
        chance = np.minimum(np.maximum(chance, 1e-15), 1 - 1e-15)
        joined = np.floor(np.log1p(-rng.random(len(at))) / np.log1p(-chance))
        seated = seated + joined + 1
        more = seated <= customers[at]
        at, seated = at[more], seated[more]
        tables[at] += 1
        open_ = seated < customers[at]
        at, seated = at[open_], seated[open_]
    few = list(zip(at.tolist(), seated.tolist(), tables[at].tolist(), customers[at].tolist(), weight[at].tolist()))
    while few:
        chances, going = [rng.beta(w, n - discount * t) for _, n, t, _, w in few], []
        for (place, n, t, most, w), chance in zip(few, chances):
            n += math.floor(math.log1p(-rng.random()) / math.log1p(-min(max(chance, 1e-15), 1 - 1e-15))) + 1.0
            t += n <= most
            if n < most:
                going.append((place, n, t, most, w))
            else:
                tables[place] = t
        few = going
    return tables


def sweep(bucket: Bucket, totals: Totals, keep: bool, seed: list[int]) -> Bucket:
    """Reseat every type, then every token in the parent."""
    rng = np.random.default_rng(seed)
    token, context = bucket.types // bucket.contexts, bucket.types % bucket.contexts
    sent = np.bincount(token, bucket.tables, len(bucket.words))
    others = sent[token] - bucket.tables
    chance = totals.parent(others, np.minimum(bucket.parents[token], others))
    tables = seat(bucket.counts, totals.spare(context) * chance, totals.discount, rng)
    sent = np.bincount(token, tables, len(bucket.words)).astype(np.int64)
    spare = (STRENGTH + totals.parent_discount * totals.parent_tables) * totals.base
    parents = seat(sent, np.full(len(sent), spare), totals.parent_discount, rng)
    samples = [*bucket.samples, (_small(tables), _small(parents))] if keep else bucket.samples
    return Bucket(bucket.words, bucket.types, bucket.counts, tables, parents, samples, bucket.contexts)


def _merge(parts: Iterator[bytes]) -> tuple[Bucket, pa.LargeBinaryArray]:
    """A bucket of all its parts, each type at one table, and the contexts of its tokens, sorted; contexts
    of held-out documents alone are among them."""
    def lists() -> Iterator[tuple[bytes, tuple]]:
        for data in parts:
            words, names, *counts = _unpack(data)
            yield words + names, counts

    found, is_context = Words(), np.zeros(0, bool)
    keys, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.uint8)]
    for number, (each, context, learnt) in found.numbered(lists()):
        token, name = number[:len(each)], number[len(each):]
        if len(found.words) > len(is_context):
            is_context = np.append(is_context, np.zeros(len(found.words) - len(is_context), bool))
        is_context[name] = True
        use = learnt > 0
        keys.append(np.repeat(token.astype(np.int64), each)[use] << 32 | name[context[use]])
        counts.append(learnt[use])
    names, place = np.flatnonzero(is_context), np.empty(len(is_context), np.int64)
    names = names[pc.array_sort_indices(found.words.take(names)).to_numpy()]
    place[names] = np.arange(len(names))
    keys, counts = np.concatenate(keys), np.concatenate(counts)
    keys = (keys >> 32) * len(names) + place[keys & 0xFFFFFFFF]
    at = np.argsort(keys)
    keys = keys[at]
    starts = np.flatnonzero(np.diff(keys, prepend=-1))
    summed, types = np.add.reduceat(counts[at], starts, dtype=np.int64), keys[starts]
    token = types // len(names)
    new = np.diff(token, prepend=-1) != 0
    words = found.words.take(token[new])
    return Bucket(words, (np.cumsum(new) - 1) * len(names) + types % len(names), summed,
                  np.ones(len(types), np.int64), np.ones(len(words), np.int64), [], len(names)), found.words.take(names)


# Rows of the training: of a bucket its ``types``, fixed, and its ``seats``; of a bucket and a group of
# contexts the contexts' ``names``, and how many ``tables`` they have.
_STATE = ("kind string, bucket int, grp int, data binary, totals array<long>",
          ("kind", "bucket", "grp", "data", "totals"),
          (pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int64())))
_SUMS = ("bucket int, grp int, data binary", ("bucket", "grp", "data"), (pa.int32(), pa.int32(), pa.binary()))


def _table(rows: list[tuple], columns: tuple) -> pa.Table:
    return pa.Table.from_batches([_batch(rows, *columns[1:])])


def _rows(table: pa.Table, *columns: str) -> Iterator[tuple]:
    return zip(*(table.column(c).to_pylist() for c in columns))


def _grouped(names: pa.LargeBinaryArray, groups: int) -> Iterator[tuple[int, np.ndarray]]:
    """The places of each group's contexts."""
    group = _crcs(names) % groups
    order = np.argsort(group, kind="stable")
    found, starts = np.unique(group[order], return_index=True)
    yield from zip(found.tolist(), np.split(order, starts[1:]))


def _types(bucket: Bucket, names: pa.LargeBinaryArray, groups: list[tuple[int, np.ndarray]]) -> bytes:
    n = bucket.contexts
    return _pack((*_lines(bucket.words), *_lines(names), _small(np.bincount(bucket.types // n, minlength=len(bucket.words))),
                  _small(bucket.types % n), _small(bucket.counts), [(g, _small(at)) for g, at in groups]))


def _seats(bucket: Bucket) -> bytes:
    return _pack((_small(bucket.tables), _small(bucket.parents), bucket.samples))


def _seated(types: bytes, seats: bytes) -> tuple[Bucket, bytes, list[tuple[int, np.ndarray]]]:
    """A bucket, its contexts (in lines), and their places by group."""
    words, names, each, context, counts, groups = _unpack(types)
    tables, parents, samples = _unpack(seats)
    n = names.count(b"\n")
    return Bucket(_listed(words), np.repeat(np.arange(len(each)), each) * n + context, counts.astype(np.int64),
                  tables.astype(np.int64), parents.astype(np.int64), samples, n), names, groups


def _changing(number: int, bucket: Bucket, groups: list[tuple[int, np.ndarray]]) -> Iterator[tuple]:
    """The rows that each sweep makes anew."""
    n, sums = bucket.contexts, bucket.totals()
    customers, tables = sums[:n], sums[n:2 * n]
    yield "seats", number, -1, _seats(bucket), [int(customers.sum()), int(tables.sum()), *sums[2 * n:].tolist()]
    for group, at in groups:
        yield "tables", number, group, _pack(_small(tables[at])), None


def _merged(parts: DataFrame, groups: int) -> DataFrame:
    def merge(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = key[0].as_py()
        made, names = _merge(data for _, data in _by_key(batches))
        dealt, customers = list(_grouped(names, groups)), made.totals()[:made.contexts]
        yield _batch([("types", number, -1, _types(made, names, dealt), None)], *_STATE[1:])
        for row in _changing(number, made, dealt):
            yield _batch([row], *_STATE[1:])
        dealt_names = names.take(np.concatenate([at for _, at in dealt]))
        for (group, at), lines in zip(dealt, _lines(dealt_names, np.cumsum([0, *(len(at) for _, at in dealt)]))):
            yield _batch([("names", number, group, _pack((lines[:-1], _small(customers[at]))), None)], *_STATE[1:])

    return parts.where("bucket >= 0").select("bucket", "pairs").groupBy("bucket").applyInArrow(merge, _STATE[0])


def _directory(state: DataFrame) -> DataFrame:
    """Of each group of contexts, which of them each bucket has, in the bucket's order, and all customers."""
    def build(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def lists() -> Iterator[tuple[bytes, tuple]]:
            for bucket, _, data in _by_key(batches):
                names, customers = _unpack(data)
                yield names + b"\n", (bucket, customers)

        words, found, counts = Words(), {}, []
        for number, (bucket, customers) in words.numbered(lists()):
            found[bucket] = number
            counts.append(customers.astype(np.int64))
        total = np.bincount(np.concatenate(list(found.values())), np.concatenate(counts), len(words.words)).astype(np.int64)
        yield _batch([(-1, key[0].as_py(), _pack(({b: _small(at) for b, at in found.items()}, _small(total))))],
                     *_SUMS[1:])

    return state.where("kind = 'names'").select("bucket", "grp", "data").groupBy("grp").applyInArrow(build, _SUMS[0])


def _summed_tables(directory: DataFrame, sent: list[DataFrame], customers: bool = False) -> DataFrame:
    """What each bucket gets back for a group's contexts: their tables, by each of ``sent``, and first, if
    asked for, their customers."""
    number = len(sent)

    def add(key: tuple[pa.Scalar, ...], known: pa.Table, tables: pa.Table) -> pa.Table:
        places, total = _unpack(known.column("data")[0].as_py())
        sums = [np.zeros(len(total), np.int64) for _ in range(number)]
        for bucket, data, which in _rows(tables, "bucket", "data", "which"):
            sums[which][places[bucket]] += _unpack(data)
        if customers:
            sums.insert(0, total)
        return _table([(b, key[0].as_py(), _pack([_small(x[at]) for x in sums])) for b, at in places.items()], _SUMS)

    rows = [s.where("kind = 'tables'").select("bucket", "grp", "data", F.lit(k).alias("which"))
            for k, s in enumerate(sent)]
    every = rows[0]
    for more in rows[1:]:
        every = every.unionByName(more)
    return directory.groupBy("grp").cogroup(every.groupBy("grp")).applyInArrow(add, _SUMS[0])


def _placed(got: pa.Table, groups: list[tuple[int, np.ndarray]], contexts: int) -> list[np.ndarray]:
    """The sums of ``_summed_tables`` for each context of a bucket."""
    found = {g: _unpack(data) for kind, g, data in _rows(got, "kind", "grp", "data") if kind == "sums"}
    out = [np.zeros(contexts, np.int64) for _ in next(iter(found.values()))]
    for group, at in groups:
        for total, part in zip(out, found[group]):
            total[at] = part
    return out


def _only(table: pa.Table, kind: str) -> bytes:
    return next(data for k, data in _rows(table, "kind", "data") if k == kind)


def _received(*rows: DataFrame) -> DataFrame:
    """(kind, bucket, grp, data) of what a bucket gets."""
    every = [r if "kind" in r.columns else r.withColumn("kind", F.lit("sums")) for r in rows]
    out = every[0].select("kind", "bucket", "grp", "data")
    for more in every[1:]:
        out = out.unionByName(more.select("kind", "bucket", "grp", "data"))
    return out


def _swept(types: DataFrame, state: DataFrame, sums: DataFrame, shared: np.ndarray, discounts: tuple[float, float],
           number: int, keep: bool, seed: int) -> DataFrame:
    def run(key: tuple[pa.Scalar, ...], fixed: pa.Table, got: pa.Table) -> pa.Table:
        _release()
        bucket, _, groups = _seated(_only(fixed, "types"), _only(got, "seats"))
        tables, = _placed(got, groups, bucket.contexts)
        totals = Totals(np.concatenate([np.zeros_like(tables), tables, shared[2:]]), discounts, shared[1])
        made = sweep(bucket, totals, keep, [seed, number, key[0].as_py()])
        return _table(list(_changing(key[0].as_py(), made, groups)), _STATE)

    got = _received(state.where("kind = 'seats'"), sums)
    return types.groupBy("bucket").cogroup(got.groupBy("bucket")).applyInArrow(run, _STATE[0])


def _shared(state: DataFrame) -> np.ndarray:
    """Customers, tables and ``OTHERS`` of all buckets; the driver gets as many numbers as one bucket has."""
    rows = (state.where("kind = 'seats'").select(F.posexplode("totals").alias("at", "n"))
            .groupBy("at").agg(F.sum("n").alias("n")).collect())
    found = np.zeros(2 + OTHERS, np.int64)
    for row in rows:
        found[row["at"]] = row["n"]
    return found


@dataclass
class Model:
    """Buckets with their sampled seatings, the sums of their contexts, and the totals of each sample."""

    types: DataFrame
    seats: DataFrame
    sums: DataFrame
    shared: list[np.ndarray]
    discounts: tuple[float, float]


def train(parts: DataFrame, buckets: int, contexts: int = CONTEXTS, burn_in: int = BURN_IN, samples: int = SAMPLES,
          seed: int = 11) -> Model:
    """Merge the training counts and run the sweeps; each one's seating is written down. ``contexts`` is the
    number of groups that contexts are dealt into."""
    state = stored_by(_merged(parts, contexts), "bucket", buckets, "seating", deal=False)
    types = state.where("kind = 'types'").select("kind", "bucket", "grp", "data")
    directory = stored_by(_directory(state), "grp", buckets, "contexts", deal=False)
    shared, kept = _shared(state), []
    first = Totals(shared[2:])
    discounts = first.discount, first.parent_discount
    for number in range(burn_in + samples):
        state = stored_by(_swept(types, state, _summed_tables(directory, [state]), shared, discounts, number,
                                 number >= burn_in, seed), "bucket", buckets, "seating", deal=False)
        shared = _shared(state)
        if number >= burn_in:
            kept.append((state, shared))
    return Model(types, state.where("kind = 'seats'"), _summed_tables(directory, [s for s, _ in kept], customers=True),
                 [x for _, x in kept], discounts)


class Scorer:
    """Base-10 log probabilities of a bucket's types and of what it doesn't know."""

    def __init__(self, bucket: Bucket, samples: list[Totals]) -> None:
        self.types, self.samples, self.contexts = bucket.types, samples, len(samples[0].customers)
        token, blocks = bucket.types // self.contexts, range(0, len(bucket.types), BLOCK)
        self.counts = np.append(np.bincount(token, bucket.counts, len(bucket.words)), 0).astype(np.int64)
        self.parent, known = [], np.zeros(len(self.types))
        for (tables, parents), totals in zip(bucket.samples, samples):
            sent = np.append(np.bincount(token, tables, len(bucket.words)), 0)
            parent = totals.parent(sent, np.append(parents, 0))
            self.parent.append(parent)
            for at in (slice(k, k + BLOCK) for k in blocks):  # a bucket has many types
                context = bucket.types[at] % self.contexts
                chance = totals.spare(context)
                chance *= parent[token[at]]
                chance -= totals.discount * tables[at]
                chance += bucket.counts[at]
                chance /= STRENGTH + totals.customers[context]
                known[at] += chance
        known /= len(samples)
        self.known = known

    def chances(self, token: np.ndarray, context: np.ndarray) -> np.ndarray:
        """The mean probability of tokens (by number; the last number is unknown) in contexts."""
        out = np.zeros(len(token))
        for parent, totals in zip(self.parent, self.samples):
            out += totals.spare(context) * parent[token] / (STRENGTH + totals.customers[context])
        out /= len(self.samples)
        key = token * self.contexts + context
        at = np.minimum(np.searchsorted(self.types, key), max(0, len(self.types) - 1))
        if len(self.types):
            seen = self.types[at] == key
            out[seen] = self.known[at[seen]]
        return out


def score(parts: DataFrame, model: Model) -> DataFrame:
    """The result rows of all documents in ``parts``."""
    shared, discounts = model.shared, model.discounts
    tokens, words = int(shared[0][0]), int(shared[0][2])
    names, types = ("chunk", "bucket", "data"), (pa.int64(), pa.int32(), pa.binary())

    def score_bucket(key: tuple[pa.Scalar, ...], own: pa.Table, got: pa.Table) -> pa.Table:
        _release()
        bucket, contexts, groups = _seated(_only(got, "types"), _only(got, "seats"))
        customers, *tables = _placed(got, groups, bucket.contexts)
        found, rows, unknown = Words(), [], len(bucket.words)
        (known, _), (which, _) = list(found.numbered([(next(_lines(bucket.words)), None), (contexts, None)]))
        last = len(found.words)
        token_of, context_of = np.full(last + 1, unknown), np.empty(last, np.int64)
        token_of[known], context_of[which] = np.arange(len(known)), np.arange(len(which))
        del known, which, contexts, groups
        scorer = Scorer(bucket, [Totals(np.concatenate([customers, t, x[2:]]), discounts, x[1])
                                 for t, x in zip(tables, shared)])
        del bucket, customers, tables
        _release()

        def lists() -> Iterator[tuple[bytes, tuple]]:
            for at in range(own.num_rows):
                listed, before, each, context, _ = _unpack(own.column("pairs")[at].as_py())
                yield listed + before, (at, each, context)

        for number, (at, each, context) in found.numbered(lists(), new=False):
            chunk, entries = (own.column(c)[at].as_py() for c in ("chunk", "entries"))
            many, doc, times, docs = _unpack(entries)
            token = token_of[np.minimum(number[:len(each)], last)].repeat(each)
            context = context_of[number[len(each):]][context]
            seen = scorer.counts[token]
            add = lambda values: np.bincount(doc, times * np.repeat(values, many), docs)
            sums = (add(seen > 0), add(np.log10((seen + 1) / (tokens + words + 1))),
                    add(np.log10(scorer.chances(token, context))))
            rows.append((chunk, key[0].as_py(), _pack((_small(sums[0].astype(np.int64)), *sums[1:]))))
        return _table(rows, (None, names, types))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, docs, sums = None, [], None

        def rows():
            return _batch([(i, held, n, int(k), tokens, float(b), float(s))
                           for (i, held, n), k, b, s in zip(docs, *(x.tolist() for x in sums))],
                          ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"),
                          (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()))

        for chunk, bucket, data in _by_key(batches):
            if chunk != last:  # the documents stand first, under a bucket below 0
                if docs:
                    yield rows()
                last, docs = chunk, _unpack(data)
                sums = [np.zeros(len(docs)) for _ in range(3)]
                continue
            for total, part in zip(sums, _unpack(data)):
                total += part
        if docs:
            yield rows()

    got = _received(model.types, model.seats, model.sums)
    scored = (parts.where("bucket >= 0").groupBy("bucket").cogroup(got.groupBy("bucket"))
              .applyInArrow(score_bucket, "chunk long, bucket int, data binary"))
    documents = parts.where("bucket < 0").select("chunk", "bucket", F.col("pairs").alias("data"))
    return (scored.unionByName(documents).repartition("chunk").sortWithinPartitions("chunk", "bucket")
            .mapInArrow(finish, RESULT))


def score_documents(docs: DataFrame, held_out: Column, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score): one row per input row.

    Tokens are the words of the text with A-Z lower-cased, and one end per document. The model learns
    from all rows that are not ``held_out``. Scores are base-10 logs. Null text is empty: it has the end
    only. Repeated rows count and are scored as often as they occur; rows may have no doc_id. Without
    training rows every token has the base's probability. Extra columns are ignored; an empty table
    gives an empty one.
    """
    lean_batches(docs)
    held = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), held // BUCKET_BYTES)
    contexts = contexts_for(held)
    parts = stored_by(counted(docs, held_out, buckets, chunk_bytes), "bucket", buckets, "token-counts")
    return score(parts, train(parts, buckets, contexts))
