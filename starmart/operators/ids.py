"""Identity keys: dense ids in sort order, for tables of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.session import stored

_ROW_BITS = 33  # monotonically_increasing_id keeps the row position in its low 33 bits
_SMALL, _LARGE = 4 << 20, 64 << 20  # stored bytes of a task: as many tasks as cores between the two


def position() -> Column:
    """The place of a row in its scan; stable for a stored table."""
    return F.monotonically_increasing_id()


def _tasks(source: DataFrame) -> int:
    """Tasks by the size that Spark knows of a table; few for a small one at any session setting."""
    size = int(source._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    cores = source.sparkSession.sparkContext.defaultParallelism
    return max(1, min(-(-size // _SMALL), max(cores, -(-size // _LARGE))))


def _starts_of_days(source: DataFrame, day: str, partitions: int) -> DataFrame | None:
    """(_day, _part, _offset): the partition of each day and the rows before that partition.

    None where a day has more than twice the rows of an average partition. The window has a row per day.
    """
    days = stored(source.groupBy(F.col(day).alias("_day")).agg(F.count(F.lit(1)).alias("_n")), "days")
    rows, most = days.agg(F.coalesce(F.sum("_n"), F.lit(0)), F.coalesce(F.max("_n"), F.lit(0))).head()
    share = max(1, -(-rows // partitions))
    if most > 2 * share:
        return None
    before = Window.orderBy(F.col("_day").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    return (days.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
            .withColumn("_part", F.expr(f"CAST(_before div {share} AS int)"))
            .select("_day", "_part", F.min("_before").over(Window.partitionBy("_part")).alias("_offset")))


def dense_ids(df: DataFrame, order: list[str], id_name: str, start: int = 1, partitions: int | None = None,
              is_plain_scan: bool = False, is_unique: bool = False, tie: str | None = None,
              by_day: bool = False) -> DataFrame:
    """Add ``id_name`` = start, start+1, ... in the order of ``order``.

    The rows are range-partitioned on the sort columns, their place in the sorted partition is
    written down, and each partition is shifted by the number of rows before it. Equal rows may
    be a large share of the table: the scan position breaks ties, so the range partitioner can
    cut between them. That position is stable only for a stored input; anything else is stored
    first, unless ``is_unique`` says that ``order`` has no ties, or ``tie`` names a column with the
    ``position`` that the rows had in a stored table. That column is dropped.

    ``by_day`` says that ``order`` begins with a calendar key, of which there are few. Then the rows of each
    day are counted first and partitions are made of whole days, so the rows before a partition are known
    and nothing is sampled or written down in between. Where a day holds too many rows for one task, the
    range partitions stay.
    """
    is_stored = is_plain_scan or is_unique or tie is not None
    source = df if is_stored else stored(df, "rows")
    if partitions is None:
        # The size of joins and aggregations is a guess; those get the session's number.
        partitions = (int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
                      if is_unique or tie is not None else _tasks(source))
    if not is_unique:
        source = source.withColumn("_scan", position() if tie is None else F.col(tie))
    columns = [c for c in df.columns if c != tie]
    keys = [F.col(c).asc_nulls_last() for c in order] + ([] if is_unique else [F.col("_scan").asc()])
    starts = _starts_of_days(source, order[0], partitions) if by_day and is_stored else None
    if starts is not None:
        placed = (source.join(F.broadcast(starts), F.col(order[0]).eqNullSafe(F.col("_day")))
                  .repartitionById(partitions, F.col("_part")).sortWithinPartitions(*keys))
        row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
        return placed.select((F.col("_offset") + row + F.lit(start)).cast("bigint").alias(id_name), *columns)
    placed = (source.repartitionByRange(partitions, *keys)
              .sortWithinPartitions(*keys)
              .select(*columns, F.monotonically_increasing_id().alias("_at"))
              .withColumn("_part", F.shiftrightunsigned("_at", _ROW_BITS))
              .withColumn("_row", F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
              .drop("_at"))
    fixed_rows = stored(placed, "placed")
    # One row per partition: bounded by the number of partitions, not by the data.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (fixed_rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
               .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")))
    return (fixed_rows.join(F.broadcast(offsets), "_part")
            .select((F.col("_offset") + F.col("_row") + F.lit(start)).cast("bigint").alias(id_name), *columns))
