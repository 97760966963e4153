"""Mixing sources to target weights by weighted fair queueing.

Method: each shuffled document gets a virtual finish time, the words of its source up to and with
it divided by the source's target; documents are sorted by that time over the whole corpus and cut
at the total budget. A source whose target is above its size goes round again, up to ``MAX_COPIES``
times in all. Only ids and sizes are shuffled, never texts; a source that holds a third of all rows
is spread over range partitions by its shuffled order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import ROW_KEY, WORD_PATTERN, own_names, row_keyed, running_total
from starmart.session import stored

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES,
                   share: float = 1.0) -> DataFrame:
    """(source, rank, source_size, before, target, budget) of each source; budget is the whole mix.

    Sources by code point, null last, weigh ``weights`` in turn and share ``share`` of all words.
    No target passes ``max_copies`` times the source's size: taking sources by that limit per
    weight, each one is held at its limit if the level that the rest would get is above it. One row
    per source is all that the windows see.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = (sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
              .withColumn("rank", F.row_number().over(by_name))
              .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)),
                                                 (F.col("rank") - 1) % len(weights) + 1).cast("double"))
              .withColumn("before", F.sum("source_size").over(by_name) - F.col("source_size"))
              .withColumn("most", F.col("source_size") * F.lit(float(max_copies))))
    everything = Window.partitionBy()
    earlier = Window.orderBy(F.col("most") / F.col("weight"), "rank").rowsBetween(
        Window.unboundedPreceding, -1)
    total = F.sum("source_size").over(everything) * F.lit(float(share))
    level = ((total - F.coalesce(F.sum("most").over(earlier), F.lit(0.0)))
             / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0))))
    held = ranked.withColumn("total", total).withColumn("held", level > F.col("most") / F.col("weight"))
    free = lambda column: F.sum(F.when(~F.col("held"), F.col(column)).otherwise(0.0)).over(everything)
    taken = F.sum(F.when(F.col("held"), F.col("most")).otherwise(0.0)).over(everything)
    return held.withColumn("target", F.when(F.col("held"), F.col("most")).otherwise(
        F.col("weight") * ((F.col("total") - taken) / free("weight")))).select(
            "source", "rank", "source_size", "before", "target", F.col("total").alias("budget"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES,
        share: float = 1.0) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken): one row per input row.

    Null text has size 0. A document of size 0 takes part with no words, and copies counts its
    places within the budget. Documents are shuffled by the md5 of their id; a null id comes first.
    Rows with the same id, source and size may stand in either order, which gives the same rows.
    Nothing in, nothing out; all sizes 0: all targets and takings are 0.
    """
    return _mixed(row_keyed(docs, "doc_id", "source", "text"), [], weights, max_copies, share)


def _mixed(docs: DataFrame, extra: list[str], weights: tuple[int, ...], max_copies: int, share: float) -> DataFrame:
    """``mix`` of keyed rows, with the columns ``extra`` of theirs. The key cuts ties, so that equal rows, or
    rows without doc_id, are spread over partitions like any others."""
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                        F.md5(F.col("doc_id").cast("string").cast("binary")).alias("shuffled"), ROW_KEY)
    order = [F.col("source").asc_nulls_last(), F.col("shuffled"), F.col("doc_id"), F.col("size"), F.col(ROW_KEY)]
    queued = running_total(sized, order, "size", "words_before", "mix-queues")
    targets = stored(source_targets(queued, weights, max_copies, share), "mix-targets")
    joined = queued.join(targets.withColumnRenamed("source", "of"),
                         F.col("source").eqNullSafe(F.col("of"))).drop("of")
    turns = (joined.withColumnRenamed("_place", "row_key").drop("_part")
             .withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(max_copies - 1))))
             .withColumn("finish", (F.col("turn") * F.col("source_size") + F.col("words_before")
                                    - F.col("before") + F.col("size")) / F.nullif("target", F.lit(0.0))))
    queue = running_total(turns, [F.col("finish").asc_nulls_last(), F.col("rank"), F.col("turn"),
                                  F.col("shuffled"), F.col("doc_id"), F.col("row_key")],
                          "size", "total_before", "mix-finish")
    within = (F.col("total_before") + F.col("size") <= F.col("budget")) & F.col("finish").isNotNull()
    return (queue.withColumn("in_mix", within)
            .groupBy("row_key", "doc_id", "source", "size", "source_size", "target", *extra)
            .agg(F.sum(F.col("in_mix").cast("long")).alias("copies"))
            .withColumn("taken", F.col("copies") * F.col("size")).drop("row_key"))


@own_names
def take(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES,
         share: float = 1.0) -> DataFrame:
    """The rows of ``docs``, all columns, each as often as the mix takes it.

    Each row gets its own number of copies, also where rows share a doc_id or have none.
    """
    keyed = row_keyed(docs)
    copies = stored(_mixed(keyed, [ROW_KEY], weights, max_copies, share)
                    .select(F.col(ROW_KEY).alias("__of"), F.col("copies").cast("int").alias("__copies"))
                    .where("__copies > 0"), "mix-copies")
    # A row per document: as many as the texts have, so the sides are shuffled at any size.
    return (keyed.join(copies.hint("merge"), F.col(ROW_KEY) == F.col("__of"))
            .withColumn("__copy", F.explode(F.array_repeat(F.lit(1), F.col("__copies"))))
            .select(*docs.columns))
