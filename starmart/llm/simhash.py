"""SimHash near-dedup by covering locality-sensitive hashing.

Method: 64-bit SimHash fingerprints of word shingles. For radius r each bit gets a vector of r + 1
bits, and there is one table for every non-zero vector v: its mask keeps the bits whose vectors have
an odd product with v. The vectors of at most r differing bits leave some v orthogonal to them all,
so every pair within the radius agrees in some table. Equal fingerprints are put together first.

Buckets above ``BUCKET`` fingerprints are cut by blocks of the bits that their mask leaves free: of
r + 1 blocks one is equal in any linked pair, so each row goes on under r + 1 longer keys. That ends:
a key that leaves b bits free holds at most 2 ** b fingerprints. Within a bucket fingerprints are
compared in the task and give the edges of a spanning forest, not all pairs. Components come from
rounds of joins over those edges; nothing but a count per round reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import ROW_KEY, lean_batches, own_names, plain_words, row_keyed
from starmart.session import stored

SEED = 42
SHINGLE = 3
RADIUS = 3
BUCKET = 4096
FULL = (1 << 64) - 1


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprint(words: list[bytes], size: int = SHINGLE) -> int:
    """Bits that are set in over half of the shingles' XXH64; no words: zero."""
    from xxhash import xxh64_intdigest

    if not words:
        return 0
    grams = zip(*(words[k:] for k in range(size))) if len(words) >= size else [words]
    hashes = np.fromiter((xxh64_intdigest(b" ".join(g), SEED) for g in grams), np.uint64,
                         max(1, len(words) - size + 1))
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at:at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(text: Column, size: int = SHINGLE) -> Column:
    """The fingerprint (as a signed long) of a text column; null text is empty."""
    @F.arrow_udf("long")
    def printed(column: pa.Array) -> pa.Array:
        column = column.cast(pa.large_binary())
        return pa.array([_signed(fingerprint(plain_words((column[at].as_py() or b"").lower()), size))
                         for at in range(len(column))], pa.int64())

    return printed(text)


def covering_masks(radius: int = RADIUS) -> list[int]:
    """The masks of the tables; each bit's vector is one of the non-zero ones, dealt in turn."""
    vectors = [1 + bit % ((1 << radius + 1) - 1) for bit in range(64)]
    return [sum(1 << bit for bit in range(64) if (vectors[bit] & v).bit_count() % 2)
            for v in range(1, 1 << radius + 1)]


def blocks_of(mask: int, parts: int) -> list[int]:
    """The bits that a mask leaves free, dealt to ``parts`` masks in turn."""
    free = [bit for bit in range(64) if not mask >> bit & 1]
    return [sum(1 << bit for bit in free[k::parts]) for k in range(parts)]


def _bucket_edges(prints: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among different fingerprints: (fingerprint, its root)."""
    if len(prints) == 2:
        low, high = sorted(prints.tolist())
        return [(high, low)] if ((low ^ high) & FULL).bit_count() <= radius else []
    order = np.sort(prints)
    bits, root = order.view(np.uint64), np.arange(len(order))
    for k in range(len(bits)):
        near = np.unique(root[k:][np.bitwise_count(bits[k:] ^ bits[k]) <= radius])
        if len(near) > 1:
            root[np.isin(root, near[1:])] = near[0]
    return [(int(order[k]), int(order[root[k]])) for k in np.flatnonzero(root != np.arange(len(root)))]


def _edges(keyed: DataFrame, radius: int) -> DataFrame:
    """(a, b) of each bucket; keyed has (mask, key, print) with at most BUCKET prints per bucket."""
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        found: list[tuple[int, int]] = []
        last = None

        def made():
            return pa.RecordBatch.from_arrays([pa.array([e[k] for e in found], pa.int64()) for k in (0, 1)],
                                              ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            mask, key, prints = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
            starts = np.flatnonzero(np.r_[True, (mask[1:] != mask[:-1]) | (key[1:] != key[:-1])])
            for start, stop in zip(starts, [*starts[1:], len(prints)]):
                if held and last != (mask[start], key[start]):
                    found += _bucket_edges(np.concatenate(held), radius)
                    held = []
                held.append(prints[start:stop])
                last = (mask[start], key[start])
            if len(found) > 10_000:
                yield made()
                found = []
        if held:
            found += _bucket_edges(np.concatenate(held), radius)
        yield made()

    return (keyed.repartition("mask", "key").sortWithinPartitions("mask", "key")
            .select("mask", "key", "print").mapInArrow(compare, "a long, b long"))


def links(prints: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """(a, b): edges that connect all of the different fingerprints ``print`` within the radius."""
    spark = prints.sparkSession
    rows = prints.withColumn("mask", F.explode(F.array(*[F.lit(_signed(m)) for m in covering_masks(radius)])))
    edges = None
    while True:
        keyed = rows.withColumn("key", F.col("print").bitwiseAND(F.col("mask")))
        sizes = stored(keyed.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("held"))
                       .where("held > 1"), "buckets")
        found = keyed.join(sizes, ["mask", "key"])
        small = stored(_edges(found.where(F.col("held") <= bucket), radius), "edges")
        edges = small if edges is None else edges.unionByName(small)
        crowded = [row["mask"] for row in sizes.where(F.col("held") > bucket).select("mask").distinct().collect()]
        if not crowded:
            break
        # A few masks with r + 1 longer ones each; their number depends on the depth, not on the rows.
        longer = spark.createDataFrame([(mask, _signed(mask & FULL | block)) for mask in crowded
                                        for block in blocks_of(mask & FULL, radius + 1)], "mask long, longer long")
        large = found.where(F.col("held") > bucket).select("print", "mask")
        rows = stored(large.join(F.broadcast(longer), "mask").select("print", F.col("longer").alias("mask"))
                      .distinct(), "large-buckets")
    return edges.distinct()


def components(edges: DataFrame) -> DataFrame:
    """(print, root): the smallest node that each node of the edges can reach.

    Each round hooks the roots of linked nodes to the smallest root seen and then halves the paths,
    so rounds grow with the logarithm of the longest path. Each round's roots are written down.
    """
    both = stored(edges.union(edges.select("b", "a")).toDF("a", "b").distinct(), "links")
    roots = stored(both.groupBy(F.col("a").alias("print")).agg(F.least("a", F.min("b")).alias("root")), "roots")
    while True:
        grand = roots.alias("x").join(roots.alias("y"), F.col("x.root") == F.col("y.print")).select(
            F.col("x.print").alias("print"), F.col("x.root").alias("root"), F.col("y.root").alias("grand"))
        grand = stored(grand, "grand-roots")
        seen = both.join(grand, F.col("b") == F.col("print")).groupBy("a").agg(F.min("grand").alias("least"))
        hooked = grand.join(seen, F.col("print") == F.col("a")).select("print", "root", "grand", "least")
        offers = (hooked.select("print", F.least("grand", "least").alias("root"))
                  .unionByName(hooked.select(F.col("root").alias("print"), F.col("least").alias("root"))))
        after = stored(offers.groupBy("print").agg(F.min("root").alias("root")), "roots")
        changed = after.join(roots.withColumnRenamed("root", "was"), "print").where("root != was")
        if changed.isEmpty():
            return after
        roots = after


def near_duplicates(docs: DataFrame, size: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(doc_id, print, component_id): one row per input row.

    component_id is the smallest doc_id reachable over links between fingerprints. Null or empty text
    has fingerprint zero, linked like any other. Rows without doc_id have a fingerprint, but link
    nobody and have no component. Rows that share a doc_id and differ in text are linked through it
    only if their fingerprints are. Extra columns are ignored; nothing in, nothing out.
    """
    lean_batches(docs)
    printed = stored(docs.select("doc_id", fingerprints(F.col("text"), size).alias("print")), "fingerprints")
    known = printed.where(F.col("doc_id").isNotNull())
    first = stored(known.groupBy("print").agg(F.min("doc_id").alias("first")), "classes")
    root = components(links(first.select("print"), radius))
    rooted = first.join(root, "print", "left").withColumn("root", F.coalesce("root", "print"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = stored(rooted.join(least, "root").select("print", "component_id"), "components")
    return (printed.join(classes, "print", "left")
            .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id")))
            .select("doc_id", "print", "component_id"))


@own_names
def keep_first(docs: DataFrame, size: int = SHINGLE, radius: int = RADIUS, keep_unnamed: bool = True) -> DataFrame:
    """The rows of ``docs``, all columns: one of each component, the one with the smallest doc_id.

    Rows that share a doc_id are linked by their texts only. Rows without doc_id all stay and link
    nobody; without ``keep_unnamed`` they are linked like any other and come last in their component.
    """
    lean_batches(docs)
    keyed = row_keyed(docs)
    printed = stored(keyed.select(ROW_KEY, "doc_id", fingerprints(F.col("text"), size).alias("print")), "fingerprints")
    judged = printed.where(F.col("doc_id").isNotNull()) if keep_unnamed else printed
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", ROW_KEY)
    first = stored(judged.groupBy("print").agg(F.min(place).alias("first")), "classes")
    root = components(links(first.select("print"), radius))
    rooted = first.join(root, "print", "left").withColumn("root", F.coalesce("root", "print"))
    kept = rooted.groupBy("root").agg(F.min("first")[ROW_KEY].alias("kept"))
    classes = stored(rooted.join(kept, "root").select("print", "kept"), "components")
    gone = stored(judged.join(classes, "print").where(F.col(ROW_KEY) != F.col("kept")).select(ROW_KEY), "copies")
    return keyed.join(gone, ROW_KEY, "left_anti").select(*docs.columns)
