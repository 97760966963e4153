"""Merges of keyed tables without MERGE: every function returns the whole new table.

Picks among several rows of one key are aggregations of a struct, never windows, so a key
that holds a large share of the rows is reduced before the shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def one_row_per_key(df: DataFrame, keys: list[str], values: list[str] | None = None) -> DataFrame:
    """The smallest row of each key, values compared in order with NULL last.

    Equal rows are put together by hash first: picking by ``min`` of a struct sorts its input.
    """
    values = values or [c for c in df.columns if c not in keys]
    if not values:
        return df.select(*keys).distinct()
    ordered = []
    for v in values:
        ordered += [F.col(v).isNull().alias(f"_null_{v}"), F.col(v).alias(v)]
    picked = df.select(*keys, *values).distinct().groupBy(*keys).agg(F.min(F.struct(*ordered)).alias("_picked"))
    return picked.select(*keys, *[F.col("_picked")[v].alias(v) for v in values])


def collapsed_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that stand for several different rows, with how many."""
    return (df.distinct().groupBy(*keys).agg(F.count(F.lit(1)).alias("nb_versions"))
            .filter(F.col("nb_versions") > 1))


def _differs(a: Column, b: Column) -> Column:
    return F.coalesce(a, F.lit("")) != F.coalesce(b, F.lit(""))


def overwrite_merge(current: DataFrame, incoming: DataFrame, key: str,
                    keep_old_when_null: list[str] = (), keep_old: list[str] = (),
                    ) -> DataFrame:
    """Type 1 upsert on a unique key.

    A matched row takes the incoming value; columns in ``keep_old_when_null`` take it only when
    it is not NULL, columns in ``keep_old`` never take it. Unmatched rows of either side stay.
    """
    cur, inc = current.alias("cur"), incoming.alias("inc")
    matched = F.col(f"inc.{key}").isNotNull()
    known = F.col(f"cur.{key}").isNotNull()
    columns = [F.coalesce(F.col(f"cur.{key}"), F.col(f"inc.{key}")).alias(key)]
    for c in current.columns:
        if c == key:
            continue
        old, new = F.col(f"cur.{c}"), F.col(f"inc.{c}")
        if c in keep_old:
            value = F.when(known, old).otherwise(new)
        elif c in keep_old_when_null:
            value = F.coalesce(new, old)
        else:
            value = F.when(matched, new).otherwise(old)
        columns.append(value.alias(c))
    return cur.join(inc, F.col(f"cur.{key}") == F.col(f"inc.{key}"), "full_outer").select(*columns)


def change_update(current: DataFrame, incoming: DataFrame, key: str,
                  text_columns: list[str]) -> DataFrame:
    """Update matched rows only where a text really changed (NULL and '' count as equal)."""
    cur, inc = current.alias("cur"), incoming.alias("inc")
    changed = F.col(f"inc.{key}").isNotNull() & reduce(
        lambda a, b: a | b,
        [_differs(F.col(f"cur.{c}"), F.col(f"inc.{c}")) for c in text_columns])
    columns = [
        (F.when(changed, F.col(f"inc.{c}")).otherwise(F.col(f"cur.{c}")) if c in text_columns
         else F.col(f"cur.{c}")).alias(c)
        for c in current.columns
    ]
    return cur.join(inc, F.col(f"cur.{key}") == F.col(f"inc.{key}"), "left").select(*columns)


def absent_rows(current: DataFrame, incoming: DataFrame, current_key: Column,
                incoming_key: Column) -> DataFrame:
    """Incoming rows whose computed key is not in the current table."""
    return (incoming.withColumn("_key", incoming_key)
            .join(current.select(current_key.alias("_key")), "_key", "left_anti").drop("_key"))
