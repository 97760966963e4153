"""Helpers of the training-data operators: tables, text batches, words, running totals."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmart.session import stored

# Every byte that is not part of an alphanumeric word becomes a space, A-Z become a-z; bytes of
# characters beyond ASCII stay.
_ALNUM = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
               for b in range(256))

BATCH_ROWS = 1_000
ROW_KEY = "__row"

# Java pattern of the words that only ASCII white space separates.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plain_words(text: bytes) -> list[bytes]:
    """Words between ASCII white space (0x20, 0x09-0x0D), as they stand."""
    return text.split()


def alnum_words(text: bytes) -> list[bytes]:
    """Words of ASCII letters, digits and characters beyond ASCII, with A-Z lower-cased."""
    return text.translate(_ALNUM).split()


def lean_batches(docs: DataFrame) -> None:
    """Let the session send no more rows of text to Python at once than ``BATCH_ROWS``: Spark's default
    of 10,000 long texts is held several times over, by the JVM and by the worker."""
    conf, name = docs.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= BATCH_ROWS:
        conf.set(name, str(BATCH_ROWS))


def text_slices(batch: pa.RecordBatch, rows: int = 128) -> Iterator[tuple[list, list[bytes]]]:
    """Ids and UTF-8 texts (null: empty) of a batch of (id, text), a few rows at a time."""
    texts = batch.column(1).cast(pa.large_binary())
    for at in range(0, batch.num_rows, rows):
        yield (batch.column(0).slice(at, rows).to_pylist(),
               [text or b"" for text in texts.slice(at, rows).to_pylist()])


def row_keyed(docs: DataFrame, *columns: str) -> DataFrame:
    """The columns (or all) of ``docs`` and ``ROW_KEY``, a text that no two rows share and that every
    scan gives again.

    Rows of Parquet files are named by the file's path (its md5: the key goes along with the texts) and
    their place in it; other tables are written down first.
    """
    columns = columns or docs.columns
    if docs._jdf.queryExecution().analyzed().getClass().getSimpleName() == "LogicalRelation":
        try:
            found = docs.metadataColumn("_metadata")
            return docs.select(*columns, F.concat(F.md5(found["file_path"].cast("binary")), F.lit("#"),
                                                  found["row_index"].cast("string")).alias(ROW_KEY))
        except AnalysisException:  # not of Parquet files
            pass
    return stored(docs.select(*columns).withColumn(ROW_KEY, F.monotonically_increasing_id().cast("string")),
                  "keyed-rows")


def own_names(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """For functions from documents to documents, whose own columns start with two underscores: columns
    of the input that do so too get other names meanwhile."""
    @wraps(stage)
    def renamed(docs: DataFrame, *args, **options) -> DataFrame:
        taken = [name for name in docs.columns if name.startswith("__")]
        if not taken:
            return stage(docs, *args, **options)
        spare = "input"
        while any(name.startswith(spare) for name in docs.columns):
            spare += "_"
        result = stage(docs.withColumnsRenamed({name: spare + name for name in taken}), *args, **options)
        return result.withColumnsRenamed({spare + name: name for name in taken})

    return renamed


def fold_crc(id_column: str | Column, modulus: int) -> Column:
    """crc32 of the id as text modulo ``modulus``; a null id counts as the empty text."""
    column = F.col(id_column) if isinstance(id_column, str) else id_column
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % modulus


def running_total(df: DataFrame, order: list[Column], value: str, out: str, label: str) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the rows before each one, in the order given.

    Rows are range-partitioned and their places written down; each partition is then shifted by
    what stands before it, so no task holds more than its share. ``_part`` and ``_place`` stay as
    a key of the rows. No more than one row per partition is broadcast.
    """
    placed = stored(df.repartitionByRange(*order).sortWithinPartitions(*order)
                    .withColumn("_part", F.spark_partition_id())
                    .withColumn("_place", F.monotonically_increasing_id()), label)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = (placed.groupBy("_part").agg(F.sum(value).alias("_sum"))
             .select("_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base")))
    within = Window.partitionBy("_part").orderBy("_place").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return (placed.join(F.broadcast(bases), "_part")
            .withColumn(out, F.col("_base") + F.sum(value).over(within) - F.col(value))
            .drop("_base"))
