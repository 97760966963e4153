"""Best-fit packing of token sequences by patterns and non-negative least squares.

Method: documents are encoded and cut into pieces of at most ``max_tokens`` ids. Patterns of a few
piece lengths that fill a sequence exactly are enumerated, their repeat counts are fitted to the
histogram of lengths by non-negative least squares and rounded, and the pieces that are left over are
packed best fit, longest first, length by length. The plan is made from the histogram alone, which has
at most ``max_tokens`` numbers, and says for each length which place its k-th piece takes. Pieces learn
their number among those of their length by a count per task and length and a running sum over tasks:
no sort, and no length gathers its pieces.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import lean_batches
from starmart.llm.token_binary import END_ID, encoded, encoder
from starmart.session import stored

MAX_TOKENS = 1024
PATTERN_SIZE = 3  # pieces in a pattern
MAX_PATTERNS = 250_000
SWEEPS = 400
PIECE_SCHEMA = ("part int, rank long, doc_id long, piece int, start long, length long, ids_crc32 long, "
                "ids binary")
PLACED_SCHEMA = ("doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, "
                 "offset long, ids binary")
BATCH = 20_000


# --- the plan ------------------------------------------------------------------------------------

def patterns(lengths: np.ndarray, total: int, size: int = PATTERN_SIZE,
             most: int = MAX_PATTERNS) -> np.ndarray:
    """All multisets of at most ``size`` (1 to 3) of the different ``lengths`` that add up to ``total``.

    One row per pattern, ascending, filled with zeros in front. Size 3 is left out where it would give
    more than ``most`` patterns, which long sequences do: about total^2 / 12.
    """
    there = np.zeros(total + 1, bool)
    there[lengths] = True
    found = [np.array([[0, 0, total]])] if there[total] else []
    if size > 1:
        low = np.arange(1, total // 2 + 1)
        low = low[there[low] & there[total - low]]
        found.append(np.column_stack([np.zeros_like(low), low, total - low]))
    if size > 2 and total * total // 12 <= most:
        for first in np.flatnonzero(there[:total // 3 + 1]):
            second = np.arange(first, (total - first) // 2 + 1)
            second = second[there[second] & there[total - first - second]]
            found.append(np.column_stack([np.full_like(second, first), second, total - first - second]))
    return np.concatenate(found) if found else np.zeros((0, 3), np.int64)


def repeat_counts(made: np.ndarray, histogram: np.ndarray, sweeps: int = SWEEPS) -> np.ndarray:
    """How often to use each pattern: x >= 0 that fits the patterns' lengths to the histogram.

    Least squares weighted by length, since a long piece left over costs more than a short one, which
    fills a gap. Solved by accelerated projected gradients. The row sums of the normal matrix, which has
    no negative entry, bound it and give each pattern its own step.
    """
    weight = np.arange(len(histogram)) / (len(histogram) - 1)
    weight[0] = 0.0  # the filling of short patterns
    pieces = made.ravel()

    def lengths_of(x: np.ndarray) -> np.ndarray:
        return np.bincount(pieces, np.repeat(x, made.shape[1]), len(histogram))

    def onto_patterns(y: np.ndarray) -> np.ndarray:
        return (weight * y)[made].sum(axis=1)

    step = onto_patterns(lengths_of(np.ones(len(made))))
    x = ahead = np.zeros(len(made))
    pace = 1.0
    for _ in range(sweeps):
        after = np.maximum(ahead - onto_patterns(lengths_of(ahead) - histogram) / step, 0.0)
        if np.dot(step * (ahead - after), after - x) > 0:  # overshot: forget the pace
            pace = 1.0
        faster = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        ahead = after + (pace - 1) / faster * (after - x)
        x, pace = after, faster
    return x


def rounded(made: np.ndarray, x: np.ndarray, histogram: np.ndarray) -> tuple[list[tuple[list, int]], np.ndarray]:
    """Whole repeat counts, the largest first, as far as there are pieces; and what is left over."""
    left = histogram.astype(np.int64).copy()
    used = []
    for at in np.argsort(-x, kind="stable"):
        if x[at] < 0.5:
            break
        runs: dict[int, int] = defaultdict(int)
        for length in made[at].tolist():
            if length:
                runs[length] += 1
        count = min(int(round(x[at])), *(int(left[length]) // times for length, times in runs.items()))
        if count > 0:
            for length, times in runs.items():
                left[length] -= count * times
            used.append((sorted(runs.items(), reverse=True), count))
    return used, left


def best_fit(left: np.ndarray, total: int) -> list[tuple[list, int]]:
    """Pack a histogram best fit, longest first: sequences of one content are one entry with a count.

    A piece goes where the least room would do, and its equals fill that sequence up before the next
    one, so equal sequences can be filled together.
    """
    open_: dict[int, list[tuple[list, int]]] = defaultdict(list)  # room left -> sequences

    def fill(runs: list, count: int, room: int, length: int, pieces: int) -> int:
        """Put pieces of one length into ``count`` equal sequences; how many found a place."""
        each = room // length
        full = min(count, pieces // each)
        if full:
            open_[room - each * length].append((runs + [(length, each)], full))
        rest = pieces - full * each if full < count else 0
        if rest:
            open_[room - rest * length].append((runs + [(length, rest)], 1))
        if count > full + bool(rest):
            open_[room].append((runs, count - full - bool(rest)))
        return full * each + rest

    for length in range(total, 0, -1):
        pieces = int(left[length])
        while pieces:
            room = min((room for room, held in open_.items() if held and room >= length), default=None)
            if room is None:
                pieces -= fill([], -(-pieces // (total // length)), total, length, pieces)
            else:
                runs, count = open_[room].pop()
                pieces -= fill(runs, count, room, length, pieces)
    return [entry for held in open_.values() for entry in held]


@dataclass(frozen=True)
class Plan:
    """Where the pieces of each length go.

    Pieces stand by length and, within it, by rank. Entry k holds those from ``first[k]`` on: ``times``
    in each sequence, from ``sequence`` and ``offset`` on.
    """

    base: np.ndarray  # length -> pieces of lower lengths
    first: np.ndarray
    times: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int

    def places(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = self.base[length] + rank
        entry = np.searchsorted(self.first, at, "right") - 1
        turn, slot = np.divmod(at - self.first[entry], self.times[entry])
        return self.sequence[entry] + turn, self.offset[entry] + slot * length


def plan(histogram: np.ndarray, size: int = PATTERN_SIZE) -> Plan:
    """The plan for ``histogram[length]`` pieces of each length; its last length is a full sequence.

    The plan has at most a few entries per pattern, whatever the number of pieces.
    """
    histogram = np.asarray(histogram, np.int64)
    total = len(histogram) - 1
    made = patterns(np.flatnonzero(histogram), total, size)
    used, left = rounded(made, repeat_counts(made, histogram), histogram) if len(made) else ([], histogram)
    entries = defaultdict(list)  # length -> (pieces, times, sequence, offset)
    sequences = 0
    for runs, count in used + best_fit(left, total):
        offset = 0
        for length, times in runs:
            entries[length].append((count * times, times, sequences, offset))
            offset += length * times
        sequences += count
    rows = np.array([entry for length in sorted(entries) for entry in entries[length]], np.int64).reshape(-1, 4)
    return Plan(np.cumsum(histogram) - histogram, np.cumsum(rows[:, 0]) - rows[:, 0], rows[:, 1], rows[:, 2],
                rows[:, 3], sequences)


# --- the pieces ----------------------------------------------------------------------------------

def cut(n_tokens: int, most: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: full ones, but for the first."""
    first = n_tokens % most or min(n_tokens, most)
    return [(0, first), *((start, most) for start in range(first, n_tokens, most))]


def token_pieces(docs: DataFrame, path: str, max_tokens: int = MAX_TOKENS, end_id: int = END_ID,
                 keep_ids: bool = False) -> DataFrame:
    """The pieces of all documents, with their rank among those of their length in the task.

    One map pass; ``ids`` (little-endian unsigned 32-bit integers) is null unless it is asked for.
    """
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), encoder(path)
        seen = np.zeros(max_tokens + 1, np.int64)
        rows: list[tuple] = []
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())

        def flush() -> pa.RecordBatch:
            columns = [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)]
            rows.clear()
            return pa.RecordBatch.from_arrays(columns, [field.split()[0] for field in PIECE_SCHEMA.split(", ")])

        for batch in batches:
            for doc_id, ids in encoded(batch, made, end_id):
                for number, (start, length) in enumerate(cut(len(ids), max_tokens)):
                    raw = ids[start:start + length].tobytes()
                    rows.append((part, int(seen[length]), doc_id, number, start, length, zlib.crc32(raw),
                                 raw if keep_ids else None))
                    seen[length] += 1
                if len(rows) >= BATCH // (16 if keep_ids else 1):
                    yield flush()
        if rows:
            yield flush()

    lean_batches(docs)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(write, PIECE_SCHEMA)


def _placed(pieces: DataFrame, max_tokens: int, size: int) -> DataFrame:
    """Stored pieces with their places in sequences."""
    per_task = stored(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("held")), "piece-counts")
    histogram = np.zeros(max_tokens + 1, np.int64)
    for row in per_task.groupBy("length").agg(F.sum("held").alias("held")).collect():  # max_tokens rows at most
        histogram[row["length"]] = row["held"]
    made = plan(histogram, size)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_task.select("part", "length", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("base"))
    names = [field.split()[0] for field in PLACED_SCHEMA.split(", ")]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number = lambda name: batch.column(name).to_numpy(zero_copy_only=False)
            if batch.num_rows:
                sequence, offset = made.places(number("length"), number("rank") + number("base"))
                held = {"sequence_id": pa.array(sequence), "offset": pa.array(offset)}
                yield pa.RecordBatch.from_arrays([held.get(name) or batch.column(name) for name in names], names)

    return pieces.join(bases, ["part", "length"]).mapInArrow(place, PLACED_SCHEMA)


def pack(docs: DataFrame, path: str, max_tokens: int = MAX_TOKENS, size: int = PATTERN_SIZE,
         end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset): one row per piece.

    Null text is empty: a piece of the end id alone. Documents of more than ``max_tokens`` ids are cut;
    their first piece may be shorter. Rows that share a doc_id or have none are documents of their own.
    Pieces of a sequence follow each other without gaps from offset 0. Extra columns are ignored;
    nothing in, nothing out.
    """
    pieces = stored(token_pieces(docs, path, max_tokens, end_id), "pieces")
    return _placed(pieces, max_tokens, size).drop("ids")


def packed_sequences(docs: DataFrame, path: str, max_tokens: int = MAX_TOKENS, size: int = PATTERN_SIZE,
                     end_id: int = END_ID) -> DataFrame:
    """(sequence_id, ids, lengths): the packed sequences themselves, ids as little-endian unsigned 32-bit
    integers and the lengths of the pieces in them. Rows are treated as by ``pack``."""
    pieces = stored(token_pieces(docs, path, max_tokens, end_id, keep_ids=True), "pieces-with-ids")
    held = F.array_sort(F.collect_list(F.struct("offset", "length", "ids")))
    return (_placed(pieces, max_tokens, size).groupBy("sequence_id").agg(held.alias("held"))
            .select("sequence_id", F.aggregate("held", F.unhex(F.lit("")), lambda ids, p: F.concat(ids, p["ids"]))
                    .alias("ids"), F.col("held.length").alias("lengths")))
