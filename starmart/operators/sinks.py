"""Writers: exports, external tables, year partitions and publication."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.session import path_exists
from starmart.sources.delimited import write_bronze

EXPORTED = ["dim_temps", "dim_patient", "dim_geographie", "dim_etablissement", "dim_diagnostic",
            "dim_professionnel", "fait_consultation", "fait_deces", "fait_satisfaction"]
TEXT_DIMENSIONS = ["dim_temps", "dim_patient", "dim_geographie", "dim_etablissement",
                   "dim_diagnostic"]


def export_csv(tables: dict[str, DataFrame], folder: str) -> list[str]:
    """Write each exported gold table as CSV parts with a header."""
    names = [n for n in EXPORTED if n in tables]
    for name in names:
        write_bronze(tables[name], f"{folder}/{name}")
    return names


def read_export(spark: SparkSession, folder: str, name: str, schema) -> DataFrame:
    """An exported table with its own types; an empty text stays apart from NULL.

    Spark reads whatever equals the null value as NULL, which is the empty text unless another is named.
    """
    return (spark.read.schema(schema).option("header", True).option("escape", '"').option("multiLine", True)
            .option("nullValue", "\u0000").csv(f"{folder}/{name}"))


def _columns(schema) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def external_text_table(spark: SparkSession, name: str, schema, location: str) -> DataFrame:
    """A table over exported CSV; the schema comes from gold, so the two cannot drift apart."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({_columns(schema)}) USING csv "
              f"OPTIONS (header 'true', escape '\"') LOCATION '{location}'")
    return spark.table(name)


def with_year(fact: DataFrame) -> DataFrame:
    """Keep the year in the fact: filters on it prune folders without touching the calendar."""
    return fact.withColumn("annee", F.expr("CAST(id_temps div 10000 AS int)"))


def write_orc(df: DataFrame, path: str, partition: str | None = None) -> None:
    writer = df.write.mode("overwrite").option("compression", "snappy")
    (writer.partitionBy(partition) if partition else writer).orc(path)


def external_orc_table(spark: SparkSession, name: str, schema, location: str,
                       partition: str | None = None) -> DataFrame:
    """A table over ORC files; existing partition folders are registered."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    by = f"PARTITIONED BY ({partition})" if partition else ""
    spark.sql(f"CREATE TABLE {name} ({_columns(schema)}) USING orc {by} LOCATION '{location}'")
    if partition:
        spark.catalog.recoverPartitions(name)
    return spark.table(name)


VERSION_SCHEMA = "version bigint"


def current_version(spark: SparkSession, path: str) -> int | None:
    """The version of a table that readers see; None before the first one."""
    pointer = f"{path}/current"
    if not path_exists(spark, pointer):
        return None
    return spark.read.schema(VERSION_SCHEMA).parquet(pointer).agg(F.max("version")).head()[0]


def _version_path(path: str, version: int) -> str:
    return f"{path}/version={version}"


def insert_overwrite(df: DataFrame, path: str, partition: str | None = None) -> int:
    """Replace a columnar table; returns the new version.

    The rows go to a folder of their own and become the table by one appended pointer row, after they
    are all written. Until then, and after a write that fails, readers see the table as it was, so
    ``df`` may read the table that it replaces. Old versions stay until ``remove_old_versions``.
    """
    spark = df.sparkSession
    version = max((current_version(spark, path) or 0) + 1, time.time_ns())
    writer = df.write.mode("errorifexists")
    (writer.partitionBy(partition) if partition else writer).parquet(_version_path(path, version))
    (spark.createDataFrame([(version,)], VERSION_SCHEMA).coalesce(1)
     .write.mode("append").parquet(f"{path}/current"))
    return version


def read_table(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The current version of a table that ``insert_overwrite`` wrote, or an older one."""
    version = version or current_version(spark, path)
    if version is None:
        raise FileNotFoundError(f"no table at {path}")
    return spark.read.parquet(_version_path(path, version))


def remove_old_versions(spark: SparkSession, path: str, keep: int = 2) -> list[int]:
    """Delete all but the newest ``keep`` versions up to the current one, and those that failed before
    it; returns what went. Nobody may still be reading them."""
    now = current_version(spark, path)
    pointers = spark.read.schema(VERSION_SCHEMA).parquet(f"{path}/current")
    kept = {row["version"] for row in pointers.orderBy(F.col("version").desc()).limit(max(1, keep)).collect()}
    return remove_numbered(spark, path, "version", now, kept)


def remove_numbered(spark: SparkSession, path: str, name: str, before: int, kept: set[int]) -> list[int]:
    """Delete the folders ``<name>=<number>`` of ``path`` with numbers below ``before`` that aren't ``kept``."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [status.getPath().getName() for status in system.listStatus(folder)]
    found = sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{name}="))
    gone = [number for number in found if number < before and number not in kept]
    for number in gone:
        system.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}={number}"), True)
    return gone


def overwrite_years(df: DataFrame, path: str) -> None:
    """Replace only the years that ``df`` holds."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("annee").parquet(path))


def publish(spark: SparkSession, root: str, run_id: int, mode: str) -> None:
    """Make a finished run the current one: one appended row, written after everything else."""
    (spark.createDataFrame([(run_id, mode)], "run_id bigint, mode string").coalesce(1)
     .write.mode("append").parquet(f"{root}/published"))


def current(spark: SparkSession, root: str) -> tuple[int, str] | None:
    """Number and mode of the run that readers see."""
    folder = f"{root}/published"
    if not path_exists(spark, folder):
        return None
    published = spark.read.schema("run_id bigint, mode string").parquet(folder)
    run = published.agg(F.max_by(F.struct("run_id", "mode"), "run_id")).head()[0]
    return None if run is None else (run["run_id"], run["mode"])


def current_run(spark: SparkSession, root: str) -> int | None:
    found = current(spark, root)
    return None if found is None else found[0]
