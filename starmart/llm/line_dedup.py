"""Line dedup: a line found in several documents stays only in the first of them.

Method: lines are normalised and hashed with their place, documents are counted per hash, lines
over the threshold are dropped, and the rest is put together again by position. Everything is
native. The text is shuffled once (to meet its dropped places); hashes of lines, not lines, are
grouped and joined.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import ROW_KEY, row_keyed
from starmart.session import stored

STRIPPED = " \t\n\x0b\x0c\r"
MIN_KEY_CHARS = 10
MIN_DOCUMENTS = 2


def line_key(line: Column) -> Column:
    """The line without ASCII white space at its ends and with A-Z lower-cased.

    ``lower`` does the same as replacing A-Z where all characters are ASCII, and is faster.
    """
    bare = F.btrim(line, F.lit(STRIPPED))
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(
        F.translate(bare, string.ascii_uppercase, string.ascii_lowercase))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_hashes(docs: DataFrame, min_key_chars: int = MIN_KEY_CHARS) -> DataFrame:
    """(row key, doc_id, place, hash) of every line whose key is long enough; the hash has 128 bits."""
    return (docs.where(F.col("doc_id").isNotNull())
            .select(ROW_KEY, "doc_id", F.posexplode(_lines(F.col("text"))).alias("place", "line"))
            .select(ROW_KEY, "doc_id", "place", line_key(F.col("line")).alias("key"))
            .where(F.char_length("key") >= min_key_chars)
            .select(ROW_KEY, "doc_id", "place", F.unhex(F.md5("key")).alias("hash")))


def repeated_hashes(hashes: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """(hash, first) of lines in at least ``min_documents`` documents; first: the smallest doc_id.

    Two documents are told from one by the smallest and largest id, so the one shuffle carries a
    row per hash and map task. Higher thresholds count distinct ids.
    """
    if min_documents == 2:
        found = hashes.groupBy("hash").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
        return found.where("first < last").select("hash", "first")
    found = hashes.groupBy("hash").agg(F.min("doc_id").alias("first"),
                                       F.count_distinct("doc_id").alias("n"))
    return found.where(F.col("n") >= min_documents).select("hash", "first")


def dropped_places(hashes: DataFrame, repeated: DataFrame) -> DataFrame:
    """(row key, dropped): the places of the lines that each row loses.

    Both sides are plain scans, so adaptive execution can split a hash that holds many rows.
    """
    return (hashes.join(repeated, "hash").where(F.col("doc_id") != F.col("first"))
            .groupBy(ROW_KEY).agg(F.collect_list("place").alias("dropped")))


def dedup_lines(docs: DataFrame, min_key_chars: int = MIN_KEY_CHARS,
                min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept): one row per input row; kept is the remaining text.

    Null or empty text is one empty line. Rows with the same doc_id are one document in the counts, and
    each loses its own lines: those of which a smaller doc_id holds an equal one. Rows without doc_id keep
    all lines and count for nobody. All lines dropped: kept is empty. Extra columns are ignored.
    """
    keyed = row_keyed(docs, "doc_id", "text")
    hashes = stored(line_hashes(keyed, min_key_chars), "line-hashes")
    repeated = stored(repeated_hashes(hashes, min_documents), "repeated-lines")
    places = dropped_places(hashes, repeated)
    joined = keyed.join(places, ROW_KEY, "left")
    # The one-element array makes the lines a lambda variable: split once, then read by place.
    kept = F.transform(F.array(_lines(F.col("text"))), lambda lines: F.concat_ws("\n", F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("dropped")),
        lambda place: F.get(lines, place))))[0]
    return joined.select(
        "doc_id", F.size(_lines(F.col("text"))).cast("long").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("dropped").isNull(), F.coalesce("text", F.lit(""))).otherwise(kept).alias("kept"))
