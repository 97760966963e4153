"""Official establishment ids of internal ones, by a table of correspondences.

A correspondence may lead to an id that itself has one (an establishment that was merged or renamed), so
ids are followed to the end of their chain. What can't be told is not guessed: ids with two different
targets, and ids on a circle or on the way to either, stay as they are and are reported.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.functions import rules
from starmart.session import stored

RESOLVED, CONFLICT, CYCLE = "resolved", "conflict", "cycle"
NO_ID = "0"  # what the id rule makes of a blank


def steps(table: DataFrame, internal: str = "internal", official: str = "official") -> DataFrame:
    """(id, next, targets): one row per id with at least one target other than itself.

    Both ids follow the id rule; blank ones are left out. ``next`` is NULL where targets differ.
    """
    pairs = (table.select(rules.establishment_id(F.col(internal)).alias("id"),
                          rules.establishment_id(F.col(official)).alias("next"))
             .where(f"id <> '{NO_ID}' AND next <> '{NO_ID}' AND id <> next"))
    ends = pairs.groupBy("id").agg(F.min("next").alias("low"), F.max("next").alias("high"))
    return ends.select("id", F.when(F.col("low") == F.col("high"), F.col("low")).alias("next"))


def resolve(table: DataFrame, internal: str = "internal", official: str = "official") -> DataFrame:
    """(id, official_id, status): the end of each id's chain, NULL unless it is ``resolved``.

    Each round follows twice as many steps as the last one; rows that a round doesn't bring to an end
    although some were left, on which no other came to its end either, go round in circles. Rounds grow
    with the logarithm of the longest chain.
    """
    known = stored(steps(table, internal, official), "correspondence")
    conflicts = known.where("next IS NULL").select(F.col("id").alias("conflict"))
    walk = stored(known.where("next IS NOT NULL").select("id", F.col("next").alias("at")), "chains")
    moving = None
    while True:
        further = walk.select(F.col("id").alias("from_id"), F.col("at").alias("beyond"))
        walk = stored(walk.join(further, F.col("at") == F.col("from_id"), "left").select(
            "id", F.coalesce("beyond", "at").alias("at"), F.col("beyond").isNotNull().alias("moves")), "chains")
        now = walk.where("moves").count()
        if now == 0 or now == moving:
            break
        moving = now
    judged = walk.join(conflicts, F.col("at") == F.col("conflict"), "left").select(
        "id", "at", F.when(F.col("moves"), CYCLE).when(F.col("conflict").isNotNull(), CONFLICT)
        .otherwise(RESOLVED).alias("status"))
    own = conflicts.select(F.col("conflict").alias("id"), F.lit(None).cast("string").alias("at"),
                           F.lit(CONFLICT).alias("status"))
    return judged.unionByName(own).select(
        "id", F.when(F.col("status") == RESOLVED, F.col("at")).alias("official_id"), "status")


def official_ids(rows: DataFrame, resolved: DataFrame, column: str) -> DataFrame:
    """``rows`` with the official id in ``column`` where its own one is resolved, by the id rule."""
    table = resolved.where(F.col("status") == RESOLVED).select(F.col("id").alias("_own"), F.col("official_id").alias("_official"))
    conformed: Column = rules.establishment_id(F.col(column))
    joined = rows.withColumn("_conformed", conformed).join(table, F.col("_conformed") == F.col("_own"), "left")
    return joined.withColumn(column, F.coalesce("_official", column)).select(*rows.columns)
