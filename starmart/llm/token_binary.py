"""Token ids in fixed-width binary segments.

Format of a segment, all numbers little-endian:

    magic       8 bytes  b"TOKSEG01"
    bits        u32      bits of one id: the fewest that hold every id of the vocabulary
    block       u32      ids in a block, a multiple of 64
    documents   u64
    ids         u64
    documents x (i64 doc_id, u8 known, u64 ids)      known is 0 where doc_id is null
    offset      u64 for each block and one more      byte offsets from the first block's start
    blocks                                           ids packed at ``bits`` bits, padded to 64 ids

Any id is found from its block's offset alone, and 64 ids always fill ``bits`` whole 64-bit words, so
packing and unpacking are a few vector operations. Segments are rows of a Parquet table (part, seq,
documents, ids, payload): Spark commits and retries the writing, and any store that Spark reads will
do. Parts and their segments are in ascending doc_id order.
"""

from __future__ import annotations

import os
import struct
import sys
import unicodedata
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmart.llm.common import ROW_KEY, lean_batches, row_keyed

MAGIC = b"TOKSEG01"
HEADER = struct.Struct("<8sIIQQ")
DOCUMENT = np.dtype([("doc_id", "<i8"), ("known", "u1"), ("ids", "<u8")])
BLOCK = 4096
SEGMENT_IDS = 1 << 20
END_ID = 2
# What a worker remembers of pieces of text; the memory is emptied when it is full.
REMEMBERED_PIECES = 400_000
# Characters of text that are cut into pieces at once; a longer text stands alone.
SLICE_CHARS = 1 << 20
SPACE = " \t\n\r"
# Kinds of characters: plain white space, letters and digits, signs, other white space, unsettled.
BLANK, ALNUM, SIGN, ODD, UNSETTLED = range(5)
SEGMENT_SCHEMA = "part int, seq int, documents long, ids long, payload binary"
DOCUMENT_SCHEMA = "part int, seq int, place int, doc_id long, start long, n_tokens long, ids_crc32 long"


def bits_of(vocabulary: int) -> int:
    """The fewest bits that tell ``vocabulary`` ids apart."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids at ``bits`` bits each, padded with zeros to a multiple of 64 ids."""
    rows = np.zeros((-(-len(ids) // 64), 64), np.uint64)
    rows.reshape(-1)[:len(ids)] = ids
    words = np.zeros((len(rows), bits), np.uint64)
    for lane in range(64):
        word, shift = divmod(lane * bits, 64)
        words[:, word] |= rows[:, lane] << np.uint64(shift)
        if shift + bits > 64:
            words[:, word + 1] |= rows[:, lane] >> np.uint64(64 - shift)
    return words.astype("<u8").tobytes()


def unpack(packed: bytes | memoryview, bits: int, count: int) -> np.ndarray:
    """The first ``count`` ids of what ``pack`` made."""
    words = np.frombuffer(packed, "<u8").reshape(-1, bits).astype(np.uint64)
    rows = np.empty((len(words), 64), np.uint64)
    for lane in range(64):
        word, shift = divmod(lane * bits, 64)
        rows[:, lane] = words[:, word] >> np.uint64(shift)
        if shift + bits > 64:
            rows[:, lane] |= words[:, word + 1] << np.uint64(64 - shift)
    return (rows & np.uint64((1 << bits) - 1)).reshape(-1)[:count].astype("<u4")


def write_segment(doc_ids: list[int | None], ids: list[np.ndarray], bits: int, block: int = BLOCK) -> bytes:
    table = np.zeros(len(doc_ids), DOCUMENT)
    table["doc_id"] = [0 if i is None else i for i in doc_ids]
    table["known"] = [i is not None for i in doc_ids]
    table["ids"] = [len(i) for i in ids]
    flat = np.concatenate(ids) if ids else np.zeros(0, "<u4")
    blocks = [pack(flat[at:at + block], bits) for at in range(0, len(flat), block)]
    offsets = np.cumsum([0, *map(len, blocks)]).astype("<u8")
    return b"".join([HEADER.pack(MAGIC, bits, block, len(table), len(flat)), table.tobytes(),
                     offsets.tobytes(), *blocks])


class Segment:
    """A segment that is read in place: ``ids(start, stop)`` unpacks only the blocks it needs."""

    def __init__(self, payload: bytes) -> None:
        view = memoryview(payload)
        magic, self.bits, self.block, n_docs, self.n_ids = HEADER.unpack_from(view)
        if magic != MAGIC:
            raise ValueError("not a token segment")
        at = HEADER.size
        self.documents = np.frombuffer(view, DOCUMENT, n_docs, at)
        at += self.documents.nbytes
        self.offsets = np.frombuffer(view, "<u8", -(-self.n_ids // self.block) + 1, at)
        self.data = view[at + self.offsets.nbytes:]

    def ids(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        stop = self.n_ids if stop is None else min(stop, self.n_ids)
        if start >= stop:
            return np.zeros(0, "<u4")
        first, last = start // self.block, (stop - 1) // self.block + 1
        held = min(last * self.block, self.n_ids) - first * self.block
        found = unpack(self.data[int(self.offsets[first]):int(self.offsets[last])], self.bits,
                       -(-held // 64) * 64)
        return found[start - first * self.block:stop - first * self.block]


@cache
def character_kinds() -> np.ndarray:
    """The kind of every code point. Those that came to Unicode late are unsettled: libraries differ."""
    kinds = np.full(sys.maxunicode + 1, SIGN, np.uint8)
    for code in range(sys.maxunicode + 1):
        char = chr(code)
        now, before = unicodedata.category(char)[0], unicodedata.ucd_3_2_0.category(char)[0]
        if now != before or unicodedata.category(char) == "Cn":
            kinds[code] = UNSETTLED
        elif now in "LN":
            kinds[code] = ALNUM
        elif char.isspace():
            kinds[code] = BLANK if char in SPACE else ODD
    return kinds


@cache
def utf8_lengths() -> np.ndarray:
    lengths = np.ones(sys.maxunicode + 1, np.uint8)
    for first in (0x80, 0x800, 0x10000):
        lengths[first:] += 1
    return lengths


def piece_starts(codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Places where pieces start in the code points of several texts, which start at ``starts``.

    A piece starts where plain white space follows a letter, digit or sign, where other white space or a
    sign follows a letter or digit, and where a letter or digit follows a sign that is no apostrophe.
    """
    kinds = character_kinds()[codes]
    cut = np.zeros(len(codes), bool)
    last, this = kinds[:-1], kinds[1:]
    after_alnum, after_sign = last == ALNUM, last == SIGN
    cut[1:] = ((this == BLANK) & (after_alnum | after_sign)
               | ((this == SIGN) | (this == ODD)) & after_alnum
               | (this == ALNUM) & after_sign & (codes[:-1] != ord("'")))
    cut[starts[starts < len(cut)]] = True
    return np.flatnonzero(cut)


class Encoder:
    """Ids of texts by a tokenizers file whose pre-tokenizer is the byte-level one.

    That pre-tokenizer never joins what stands before the start of a piece (``piece_starts``) with what
    follows, so a text's ids are those of its pieces one after another. The different pieces of many
    texts are found at once; those that aren't remembered go through the library together. Texts with
    the string of an added token are encoded whole.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        known = self.tokenizer.get_vocab(with_added_tokens=True)
        self.token_bytes = np.zeros(max(known.values()) + 1, np.int64)  # a byte is one character of a token
        for token, number in known.items():
            self.token_bytes[number] = len(token)
        self.pieces: dict[bytes, bytes] = {}

    def whole(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers, by the library alone."""
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def learn(self, pieces: list[bytes]) -> None:
        """Remember the ids of new pieces.

        Those that start with a space and end in anything but white space stay apart when they are put
        together to one text; the bytes of the tokens tell which ids are whose.
        """
        blank, kinds = SPACE.encode(), character_kinds()
        joined = [p for p in pieces if p[0] == 0x20 and (
            p[-1] not in blank if p[-1] < 0x80 else kinds[ord(p.decode()[-1])] in (ALNUM, SIGN))]
        if joined:
            text = b"".join(joined).decode()
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            ends = np.cumsum(np.fromiter(map(len, joined), np.int64, len(joined)))
            stops = np.searchsorted(np.cumsum(self.token_bytes[ids]), ends) + 1
            raw, start = ids.tobytes(), 0
            for piece, stop in zip(joined, (4 * stops).tolist()):
                self.pieces[piece] = raw[start:stop]
                start = stop
        for piece in pieces:
            if piece not in self.pieces:
                self.pieces[piece] = self.whole(piece.decode())

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and how many each text has."""
        alone = {at: np.frombuffer(self.whole(text), "<u4") for at, text in enumerate(texts)
                 if any(token in text for token in self.added)}
        texts = ["" if at in alone else text for at, text in enumerate(texts)]
        joined = "".join(texts)
        ids, counts = np.zeros(0, "<u4"), np.zeros(len(texts), np.int64)
        if joined:
            ids, counts = self._by_pieces(joined, np.cumsum([0, *map(len, texts)]))
        if alone:
            parts = np.split(ids, np.cumsum(counts)[:-1])
            parts = [alone.get(at, part) for at, part in enumerate(parts)]
            ids, counts = np.concatenate(parts), np.array([len(part) for part in parts])
        return ids, counts

    def _by_pieces(self, joined: str, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        codes = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        at = piece_starts(codes, bounds[:-1])
        data = joined.encode()
        offsets = np.append(at, len(data)).astype(np.int64)
        if len(data) > len(codes):
            sizes = utf8_lengths()[codes]
            offsets[:-1] = np.cumsum(sizes, dtype=np.int64)[at] - sizes[at]
        pieces = pa.Array.from_buffers(pa.large_binary(), len(at),
                                       [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
        which = pieces.indices.to_numpy()
        names = pieces.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.pieces) + len(names) > REMEMBERED_PIECES:
            self.pieces.clear()
        self.learn([name for name in names if name not in self.pieces])
        found = [*map(self.pieces.__getitem__, names)]
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // 4
        pool, first = np.frombuffer(b"".join(found), "<u4"), np.cumsum(lengths) - lengths
        counts = lengths[which]
        ends = np.cumsum(counts)
        ids = pool[np.repeat(first[which] - (ends - counts), counts) + np.arange(ends[-1])]
        upto = np.append(0, ends)[np.searchsorted(at, bounds)]
        return ids, np.diff(upto)

    def encode(self, text: str) -> bytes:
        """The text's ids as little-endian unsigned 32-bit integers."""
        return self.encode_all([text])[0].astype("<u4").tobytes()


def slices(texts: list[str], chars: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts of about ``chars`` characters in all, one text at least."""
    start = held = 0
    for at, text in enumerate(texts):
        if held and held + len(text) > chars:
            yield start, at
            start, held = at, 0
        held += len(text)
    if start < len(texts):
        yield start, len(texts)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per worker and file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def encoded(batch: pa.RecordBatch, made: Encoder, end_id: int) -> Iterator[tuple[object, np.ndarray]]:
    """Id and token ids, the end id last, of each row of a batch of (id, text); null text is empty."""
    raw = batch.column(1).cast(pa.large_binary()).to_numpy(zero_copy_only=False)
    texts = [(text or b"").decode("utf-8", "replace") for text in raw]
    names = batch.column(0).to_pylist()
    for start, stop in slices(texts):
        ids, counts = made.encode_all(texts[start:stop])
        ends = np.cumsum(counts)
        closed = np.insert(ids, ends, end_id)
        at = 0
        for name, count in zip(names[start:stop], (counts + 1).tolist()):
            yield name, closed[at:at + count]
            at += count


def segments(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """(part, seq, documents, ids, payload): all texts encoded, in ascending doc_id order.

    Null text is empty: it has the end id only. Rows without doc_id come last; rows that share one
    follow each other by text. Empty tables give no segment. Extra columns are ignored. The text is
    shuffled once, to range partitions; a partition becomes one part, cut into segments of about
    ``SEGMENT_IDS`` ids at documents.
    """
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, made = TaskContext.get().partitionId(), 0, encoder(path)
        bits = bits_of(max(made.vocabulary, end_id + 1))
        ids: list[int | None] = []
        arrays: list[np.ndarray] = []
        held = 0

        def flush():
            row = [[part], [seq], [len(ids)], [held], [write_segment(ids, arrays, bits)]]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(row, (pa.int32(), pa.int32(), pa.int64(), pa.int64(),
                                                      pa.binary()))],
                ["part", "seq", "documents", "ids", "payload"])

        for batch in batches:
            for doc_id, found in encoded(batch, made, end_id):
                ids.append(doc_id)
                arrays.append(found)
                held += len(found)
                if held >= SEGMENT_IDS:
                    yield flush()
                    ids, arrays, held, seq = [], [], 0, seq + 1
        if ids:
            yield flush()

    lean_batches(docs)
    order = [F.col("doc_id").asc_nulls_last(), F.col("text").asc_nulls_first()]
    keyed = row_keyed(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    ranged = (keyed.repartitionByRange(F.col("doc_id").asc_nulls_last(), F.col(ROW_KEY))
              .sortWithinPartitions(*order))
    return ranged.select("doc_id", "text").mapInArrow(write, SEGMENT_SCHEMA)


def write_tokens(docs: DataFrame, path: str, target: str, end_id: int = END_ID) -> None:
    """Write the segments of all texts as a Parquet table at ``target``."""
    segments(docs, path, end_id).write.parquet(target)


def read_documents(spark: SparkSession, target: str) -> DataFrame:
    """Per document of the files at ``target``: doc_id, start, n_tokens, ids_crc32, part, seq, place.

    ``start`` counts the ids of all documents before it. Parts are shifted by what stands before
    them: a window over one row per part, then one over the segments of each part.
    """
    written = spark.read.schema(SEGMENT_SCHEMA).parquet(target)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, seq, payload in zip(*(batch.column(c).to_pylist() for c in range(3))):
                segment = Segment(payload)
                counts = segment.documents["ids"].astype(np.int64)
                ends = np.cumsum(counts)
                ids = segment.ids().tobytes()
                crcs = [zlib.crc32(ids[4 * (end - n):4 * end]) for n, end in zip(counts, ends)]
                n = len(counts)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(n, part, np.int32)), pa.array(np.full(n, seq, np.int32)),
                    pa.array(np.arange(n, dtype=np.int32)),
                    pa.array(segment.documents["doc_id"].astype(np.int64), mask=segment.documents["known"] == 0),
                    pa.array(ends - counts), pa.array(counts), pa.array(crcs, pa.int64())],
                    ["part", "seq", "place", "doc_id", "start", "n_tokens", "ids_crc32"])

    before = lambda w: F.coalesce(F.sum("ids").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = written.select("part", "seq", "ids")
    parts = (sizes.groupBy("part").agg(F.sum("ids").alias("ids"))
             .select("part", before(Window.orderBy("part")).alias("part_start")))
    bases = (sizes.withColumn("seq_start", before(Window.partitionBy("part").orderBy("seq")))
             .join(F.broadcast(parts), "part")
             .select("part", "seq", (F.col("part_start") + F.col("seq_start")).alias("base")))
    documents = written.select("part", "seq", "payload").mapInArrow(read, DOCUMENT_SCHEMA)
    return (documents.join(bases, ["part", "seq"])
            .select("doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids_crc32",
                    "part", "seq", "place"))
