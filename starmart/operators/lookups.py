"""Joins to the fixed code tables (99 and 38 rows, so they are always broadcast)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.functions import fixed_values as fixed
from starmart.functions import rules
from starmart.session import inline_table


def department_regions(spark: SparkSession) -> DataFrame:
    return inline_table(spark, list(fixed.DEPARTMENT_REGION.items()), ["_dep_code", "_region"])


def region_names(spark: SparkSession) -> DataFrame:
    return inline_table(spark, list(fixed.REGION_NAME_CODE.items()), ["_name_key", "_region"])


def add_region_of_department(df: DataFrame, department: str, out: str,
                             how: str = "left") -> DataFrame:
    """Add the region of a department code column.

    An unknown code has no region; with ``how='inner'`` its row drops out.
    """
    table = department_regions(df.sparkSession).withColumnRenamed("_region", out)
    return (df.join(F.broadcast(table), F.col(department) == F.col("_dep_code"), how)
            .drop("_dep_code"))


def add_region_of_place(df: DataFrame, place: str, out: str = "code_region",
                        how: str = "left") -> DataFrame:
    """Place code -> department -> region."""
    keyed = df.withColumn("_place_key", rules.department_key(F.col(place)))
    return add_region_of_department(keyed, "_place_key", out, how).drop("_place_key")


def add_region_of_name(df: DataFrame, name: Column, out: str) -> DataFrame:
    table = region_names(df.sparkSession).withColumnRenamed("_region", out)
    return (df.withColumn("_folded", rules.region_name_key(name))
            .join(F.broadcast(table), F.col("_folded") == F.col("_name_key"), "left")
            .drop("_folded", "_name_key"))


def add_region_code(df: DataFrame, code: str | None, name: str | None,
                    out: str = "code_region") -> DataFrame:
    """A short code wins; a longer text in the code column is a name; no code falls back to the name."""
    null = F.lit(None).cast("string")
    texts = (df.withColumn("_code_text", rules.stripped_or_null(F.col(code)) if code else null)
             .withColumn("_name_text", rules.stripped_or_null(F.col(name)) if name else null))
    code_text = F.col("_code_text")
    looked_up = (F.when(code_text.isNull(), F.col("_name_text"))
                 .when(F.length(code_text) > 3, code_text))
    joined = add_region_of_name(texts, looked_up, "_named_region")
    # The output column may replace one of the inputs, so it is computed before any drop.
    return (joined.withColumn("_region_out", F.when(F.length(code_text) <= 3, code_text)
                              .otherwise(F.col("_named_region")))
            .drop("_code_text", "_name_text", "_named_region", out)
            .withColumnRenamed("_region_out", out))
