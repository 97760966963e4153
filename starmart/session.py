"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

_local_folder: str | None = None


# Generated methods above this size are not compiled by the JVM and run interpreted; Spark then
# does better with smaller methods and no whole-stage code for that stage.
HUGE_METHOD_BYTES = "8000"


def tuned(spark: SparkSession) -> SparkSession:
    """Settings of the mart that a running session may take."""
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", HUGE_METHOD_BYTES)
    return spark


def build_session(app_name: str = "starmart", master: str | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A session with adaptive execution on; a cluster keeps its own master and sizes."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return tuned(builder.getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for cut lineage. Only a session on this machine alone may do
    without a name, and gets a temporary folder."""
    global _local_folder
    set_by_call = spark.sparkContext._jsc.sc().getCheckpointDir()
    named = spark.conf.get(CHECKPOINT_CONF, None) or (set_by_call.get() if set_by_call.isDefined() else None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError(f"{CHECKPOINT_CONF} must name a folder that all executors share")
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="starmart-")
    return _local_folder


def new_folder(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses."""
    return os.path.join(shared_folder(spark), "starmart", f"{label}-{uuid.uuid4().hex}")


def inline_table(spark: SparkSession, rows: list[tuple[str, ...]], columns: list[str]) -> DataFrame:
    """A few text rows as part of the plan itself, so their size is known and no job makes them."""
    quote = lambda v: "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    values = ", ".join("(" + ", ".join(quote(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(columns)})")


def empty_table(spark: SparkSession, schema: str) -> DataFrame:
    """No rows, known as such to the optimizer: joins and unions with it fold away."""
    fields = [field.split() for field in schema.split(", ")]
    columns = ", ".join(f"CAST(NULL AS {kind}) AS {name}" for name, kind in fields)
    return spark.sql(f"SELECT {columns} WHERE false")


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def stored(df: DataFrame, label: str = "stored") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The copy survives the loss of any executor, keeps Parquet pruning for what follows,
    and fixes values such as partition numbers that a recomputation could change.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
