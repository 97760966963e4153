"""Delimited records with line breaks inside quotes, read by as many tasks as there are file splits.

Whether a line starts inside a quoted field depends on all lines before it. A first pass finds for each
split what it makes of either beginning (a map of two states), a running composition over the splits of
a file gives each split's true beginning, and a second pass cuts every split's own records. Records that
cross splits leave a piece in each, and the few pieces are put together by file and place.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmart.session import stored

# A quoted field that runs on beyond this many bytes has lost its closing quote.
MOST_BYTES = 64 << 20
WHOLE, END, BETWEEN, BEGIN = range(4)  # a record, or the part of one that its split holds


class Quotes:
    """What one line does to the state "inside a quoted field". A quote counts only where a field starts
    or inside a quoted one, where two stand for one."""

    def __init__(self, separator: str) -> None:
        s = re.escape(separator).encode()
        inner = rb'(?:[^"]++|"")*+'
        field = rb'(?:"' + inner + rb'"[^' + s + rb']*+|[^"' + s + rb'][^' + s + rb']*+|)' + s
        self.separator = separator.encode()
        self.opening = re.compile(rb'(?:' + field + rb')*+"' + inner + rb'\Z')
        self.closing = re.compile(inner + rb'"[^' + s + rb']*+(?:' + s + rb'|\Z)')

    def after(self, line: bytes, inside: bool) -> bool:
        """Is the end of the line inside a quoted field?"""
        start = 0
        if inside:
            closed = self.closing.match(line)
            if not closed:
                return True
            start = closed.end()
            if start == len(line) and not line.endswith(self.separator):
                return False
        return self.opening.match(line, start) is not None


@cache
def quotes_of(separator: str) -> Quotes:
    return Quotes(separator)


def _lines(spark: SparkSession, paths: list[str], *more: str) -> DataFrame:
    """Raw lines in the order of the file, each with the id of its split; more: ``file``, ``start``."""
    meta = F.col("_metadata")
    file, start = meta["file_path"], meta["file_block_start"]
    named = {"file": file.alias("file"), "start": start.alias("start")}
    return spark.read.option("lineSep", "\n").text(paths).select(
        F.col("value").cast("binary").alias("line"), F.xxhash64(file, start).alias("split"),
        *[named[name] for name in more])


def _runs(split: np.ndarray) -> list[tuple[int, int]]:
    """Bounds of the runs of equal values."""
    edges = np.flatnonzero(np.r_[True, split[1:] != split[:-1]]) if len(split) else np.zeros(0, int)
    return list(zip(edges.tolist(), [*edges[1:].tolist(), len(split)]))


def _quoted(lines: pa.Array) -> np.ndarray:
    return np.flatnonzero(pc.match_substring(lines, '"').to_numpy(zero_copy_only=False))


def split_maps(spark: SparkSession, paths: list[str], separator: str) -> DataFrame:
    """(split, file, start, from_outside, from_inside): the state at the end of each split for both
    beginnings. A split without a line (it lies within a long one) has no row, and changes nothing."""
    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quotes = quotes_of(separator)
        ends: dict[int, list] = {}
        for batch in batches:
            text, split = batch.column(0), batch.column(1).to_numpy()
            for first, _ in _runs(split):
                if int(split[first]) not in ends:
                    ends[int(split[first])] = [batch.column(2)[first].as_py(), batch.column(3)[first].as_py(), False, True]
            for at in _quoted(text).tolist():
                line, state = text[at].as_py(), ends[int(split[at])]
                state[2:] = [quotes.after(line, inside) for inside in state[2:]]
        columns = [list(ends), *([e[k] for e in ends.values()] for k in range(4))]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.bool_(), pa.bool_()]
        yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)],
                                         ["split", "file", "start", "from_outside", "from_inside"])

    return _lines(spark, paths, "file", "start").mapInArrow(
        mapped, "split long, file string, start long, from_outside boolean, from_inside boolean")


def split_starts(spark: SparkSession, paths: list[str], separator: str) -> DataFrame:
    """(split, file, start, inside): each split's place, and whether it starts inside a quoted field.

    Of the splits before it, the last one that ends the same way from both beginnings settles the state;
    each one since then that turns both around flips it.
    """
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    settled = F.col("from_outside") == F.col("from_inside")
    flips = F.when(F.col("from_outside") & ~F.col("from_inside"), 1).otherwise(0)
    counted = split_maps(spark, paths, separator).withColumn("flips", F.sum(flips).over(upto))
    since = (F.coalesce(F.last("flips").over(before), F.lit(0))
             - F.coalesce(F.last(F.when(settled, F.col("flips")), ignorenulls=True).over(before), F.lit(0)))
    base = F.coalesce(F.last(F.when(settled, F.col("from_outside")), ignorenulls=True).over(before), F.lit(False))
    return counted.select("split", "file", "start", (base != (since % 2 == 1)).alias("inside"))


def _bounded(size: int) -> None:
    if size > MOST_BYTES:
        raise ValueError(f"a quoted field of more than {MOST_BYTES} bytes: its closing quote is missing")


def _cut(spark: SparkSession, paths: list[str], separator: str, inside_at_start: frozenset[int],
         keep_file: bool) -> DataFrame:
    """(record, split, part, heads_file, file_name): the records of each split and its parts of others."""
    schema = "record binary, split long, part int, heads_file boolean, file_name string"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quotes = quotes_of(separator)
        now, inside, awaits_head, name = None, False, False, None
        held: list[bytes] = []  # lines of the record that is open
        held_bytes, part = 0, WHOLE

        def made(records: pa.Array, parts: list[int] | int, heads: np.ndarray) -> pa.RecordBatch:
            n = len(records)
            parts = [parts] * n if isinstance(parts, int) else parts
            return pa.RecordBatch.from_arrays([
                records.cast(pa.binary()), pa.array(np.full(n, now)), pa.array(parts, pa.int32()), pa.array(heads),
                pa.array([name] * n, pa.string())], [field.split()[0] for field in schema.split(", ")])

        def close(as_part: int) -> pa.RecordBatch:
            nonlocal held, held_bytes, awaits_head
            head = awaits_head and as_part in (WHOLE, BEGIN)
            awaits_head = awaits_head and not head
            found = made(pa.array([b"\n".join(held)], pa.binary()), as_part, np.array([head]))
            held, held_bytes = [], 0
            return found

        def hold(lines: list[bytes]) -> None:
            nonlocal held_bytes
            held.extend(lines)
            held_bytes += sum(map(len, lines)) + len(lines)
            _bounded(held_bytes)

        for batch in batches:
            split = batch.column(1).to_numpy()
            for start, stop in _runs(split):
                if split[start] != now:
                    if inside and held:
                        yield close(BETWEEN if part == END else BEGIN)
                    now, inside, held, held_bytes = int(split[start]), int(split[start]) in inside_at_start, [], 0
                    part = END if inside else WHOLE
                    awaits_head = batch.column(2)[start].as_py() == 0
                    name = batch.column(3)[start].as_py() if keep_file else None
                text, at = batch.column(0).slice(start, stop - start), 0
                for quoted in _quoted(text).tolist():
                    after = quotes.after(text[quoted].as_py(), inside)
                    if after == inside:
                        continue
                    if inside:  # the record ends here
                        hold(text.slice(at, quoted + 1 - at).to_pylist())
                        yield close(part)
                        part, at = WHOLE, quoted + 1
                    elif quoted > at:
                        yield from plain(text.slice(at, quoted - at), made, awaits_head)
                        awaits_head, at = awaits_head and not has_record(text.slice(at, quoted - at)), quoted
                    inside = after
                rest = text.slice(at)
                if inside:
                    hold(rest.to_pylist())
                elif len(rest):
                    yield from plain(rest, made, awaits_head)
                    awaits_head = awaits_head and not has_record(rest)
        if inside and held:
            yield close(BETWEEN if part == END else BEGIN)

    def filled(text: pa.Array) -> np.ndarray:
        sizes = pc.binary_length(text).to_numpy(zero_copy_only=False)
        return np.flatnonzero((sizes > 1) | (sizes == 1) & (pc.equal(text, b"\r").to_numpy(zero_copy_only=False) == 0))

    def has_record(text: pa.Array) -> bool:
        return len(filled(text)) > 0

    def plain(text: pa.Array, made, awaits_head: bool) -> Iterator[pa.RecordBatch]:
        """Lines that are records; empty lines are none."""
        records = text.take(pa.array(filled(text)))
        if len(records):
            heads = np.zeros(len(records), bool)
            heads[0] = awaits_head
            yield made(records, WHOLE, heads)

    return _lines(spark, paths, "start", *(["file"] if keep_file else [])).mapInArrow(cut, schema)


def _joined(parts: DataFrame, places: DataFrame) -> DataFrame:
    """Records that cross splits, of their parts: a beginning, splits that lie within, an end."""
    order = Window.partitionBy("file").orderBy("start", "part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = parts.join(places.select("split", "file", "start"), "split").withColumn(
        "record_at", F.sum((F.col("part") == BEGIN).cast("int")).over(order))
    held = F.array_sort(F.collect_list(F.struct("start", "part", "record")))
    joined = numbered.groupBy("file", "record_at").agg(
        held.alias("held"), F.sum(F.octet_length("record")).alias("size"), F.max("heads_file").alias("heads_file"),
        F.first("file_name").alias("file_name"))
    text = F.aggregate(F.slice("held", 2, F.size("held")), F.col("held")[0]["record"],
                       lambda all_, p: F.concat(all_, F.lit(b"\n"), p["record"]))
    return joined.select(F.when(F.col("size") <= MOST_BYTES, text).otherwise(
        F.raise_error(F.lit(f"a quoted field of more than {MOST_BYTES} bytes: its closing quote is missing")))
        .alias("record"), "heads_file", "file_name")


def read_quoted(spark: SparkSession, paths: list[str], separator: str, columns: list[str], encoding: str = "UTF-8",
                file_name: str | None = None) -> DataFrame:
    """The records of delimited files with a header, as text columns; line breaks within quotes stay.
    ``file_name`` names a column for each record's file.

    Equal to Spark's reader with ``multiLine``, which reads a file in one task. For encodings in which the
    line break, the quote and the delimiter are single ASCII bytes; bytes that an encoding other than UTF-8 does
    not define are an error. Lines end in a line feed, with or
    without a carriage return before it. A quoted field of more than 64 MB is an error: without that, one
    lost quote would make a single record of the rest of its file. What the driver holds has 8 bytes per
    split that starts inside a quoted field. A pass over the files runs when this is called.
    """
    places = stored(split_starts(spark, paths, separator), "split-starts")
    inside = frozenset(row["split"] for row in places.where("inside").select("split").collect())
    cut = _cut(spark, paths, separator, inside, file_name is not None)
    records = cut.where(F.col("part") == WHOLE)
    if not places.where("inside").isEmpty():
        crossing = stored(cut.where(F.col("part") != WHOLE), "crossing-records")
        records = records.select("record", "heads_file", "file_name").unionByName(_joined(crossing, places))
    utf8 = encoding.upper().replace("_", "-") in ("UTF-8", "UTF8")
    text = F.col("record").cast("string") if utf8 else F.decode("record", encoding)
    escaped = [c.replace("`", "``") for c in columns]
    schema = ", ".join(f"`{c}` STRING" for c in escaped)
    parsed = records.where(~F.col("heads_file")).select(F.from_csv(
        F.regexp_replace(text, "\r$", ""), schema, {"sep": separator, "escape": '"', "mode": "PERMISSIVE"}).alias("_row"),
        "file_name")
    named = [F.col("file_name").alias(file_name)] if file_name else []
    return parsed.select(*[F.col(f"_row.`{c}`") for c in escaped], *named)
