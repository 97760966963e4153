"""Checks as tables: every check returns rows of one shape, which the gate and the log share."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmart.session import inline_table

RUN_STATUS = ["running", "success", "failed"]
FLOW_LOG_SCHEMA = "run_id bigint, flow string, rows_read bigint, rows_written bigint"
RUN_LOG_SCHEMA = ("run_id bigint, job_name string, started_at timestamp, ended_at timestamp, "
                  "status string, rows_read bigint, rows_written bigint, message string")


class GateError(RuntimeError):
    """At least one check failed; nothing may be published."""


def _rows(df: DataFrame, check: str | Column, table: str | Column, metric: str | Column, value: Column,
          threshold: Column, passed: Column) -> DataFrame:
    as_column = lambda c: c if isinstance(c, Column) else F.lit(c)
    return df.select(
        as_column(check).alias("check_name"), as_column(table).alias("table_name"),
        as_column(metric).alias("metric_name"), value.cast("decimal(38,6)").alias("metric_value"),
        threshold.cast("decimal(38,6)").alias("threshold_value"), passed.alias("passed"))


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row inventory: one row per table."""
    return union_all([df.agg(F.count(F.lit(1)).alias("nb_lignes"))
                      .select(F.lit(name).alias("table_name"), "nb_lignes")
                      for name, df in tables.items()])


def minimum_rows(tables: dict[str, DataFrame], minimum: int = 1) -> DataFrame:
    n = F.col("nb_lignes")
    return _rows(row_counts(tables), "min_rows", F.col("table_name"), "row_count", n,
                 F.lit(minimum), n >= minimum)


def _spread(counted: DataFrame, check: str, table: str, metrics: list[str]) -> DataFrame:
    """One row of counters -> one row per counter; zero passes."""
    pairs = F.array(*[F.struct(F.lit(m).alias("m"), F.col(f"`{m}`").alias("n")) for m in metrics])
    exploded = counted.select(F.explode(pairs).alias("c"))
    n = F.col("c.n")
    return _rows(exploded, check, table, F.col("c.m"), n, F.lit(0), n == 0)


def null_columns(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """NULLs of several columns in a single pass."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return _spread(counted, "null_columns", table, columns)


def rule_violations(df: DataFrame, table: str, broken: dict[str, Column]) -> DataFrame:
    """Rows that break each named rule, in a single pass."""
    counted = df.agg(*[F.count_if(rule).alias(name) for name, rule in broken.items()])
    return _spread(counted, "domain", table, list(broken))


def duplicate_keys(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    counted = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
               .agg(F.count(F.lit(1)).alias("_keys")))
    n = F.col("_keys")
    return _rows(counted, "unique_key", table, "+".join(keys), n, F.lit(0), n == 0)


def orphans(fact: DataFrame, table: str, column: str, dimension: DataFrame, key: str) -> DataFrame:
    """Fact rows whose non-null key is missing from the dimension.

    Fact keys are counted first, so a hot key is one row at the join.
    """
    used = (fact.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("_fk"))
            .agg(F.count(F.lit(1)).alias("_n")))
    lost = (used.join(dimension.select(F.col(key).alias("_pk")), F.col("_fk") == F.col("_pk"),
                      "left_anti")
            .agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("_lost")))
    n = F.col("_lost")
    return _rows(lost, "foreign_key", table, column, n, F.lit(0), n == 0)


@dataclass(frozen=True)
class Rules:
    """What must hold for a table: rows, one row per key, no NULLs, and keys that are in other tables."""

    minimum: int | None = None
    unique: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    foreign: dict[str, tuple[DataFrame, str]] = field(default_factory=dict)  # column -> (table, its key)


def soundness(df: DataFrame, table: str, rules: Rules) -> DataFrame:
    """All checks of a table from one scan of it, in the rows that the single checks give.

    The values of each key and reference are counted by grouping sets, summed before the one shuffle, so a
    hot key is one row per task there and one row where it meets the dimensions. NULLs of a counted column
    are the count of that value; those of other columns are counted along.
    """
    wanted = ([("min_rows", "row_count")] * (rules.minimum is not None)
              + [("unique_key", c) for c in rules.unique] + [("null_columns", c) for c in rules.not_null]
              + [("foreign_key", c) for c in rules.foreign])
    if not wanted:
        return _rows(df.limit(0), "none", table, "none", F.lit(0), F.lit(0), F.lit(True))
    keys = list(dict.fromkeys([*rules.unique, *rules.foreign]))
    along = [c for c in rules.not_null if c not in keys]
    counters = [F.count(F.lit(1)).alias("held"), *[F.count_if(F.col(c).isNull()).alias(f"_null{k}")
                                                   for k, c in enumerate(along)]]
    if keys:
        numbered = df.select(*[F.col(c).alias(f"_key{k}") for k, c in enumerate(keys)], *along)
        names = [f"_key{k}" for k in range(len(keys))]
        counted = numbered.groupingSets([[name] for name in names], *names).agg(
            *counters, *[(F.grouping(name) == 0).alias(f"_is{k}") for k, name in enumerate(names)])
        of_key = lambda values: reduce(lambda rest, k: F.when(F.col(f"_is{k}"), values[k]).otherwise(rest),
                                       range(len(keys)), F.lit(None))
        summed = ["held", *[f"_null{k}" for k in range(len(along))]]
        counted = counted.select(of_key([F.lit(k) for k in range(len(keys))]).alias("key"),
                                 of_key([F.col(name).cast("string") for name in names]).alias("value"),
                                 *summed, F.lit(False).alias("known"))
        if rules.foreign:
            known = union_all([dimension.select(F.lit(keys.index(c)).alias("key"), F.col(key).cast("string").alias("value"),
                                                *[F.lit(0).cast("long").alias(name) for name in summed],
                                                F.lit(True).alias("known"))
                               for c, (dimension, key) in rules.foreign.items()])
            counted = counted.unionByName(known).groupBy("key", "value").agg(
                *[F.sum(name).alias(name) for name in summed], F.bool_or("known").alias("known"))
        of = lambda c, n, also=F.lit(True): F.sum(F.when((F.col("key") == keys.index(c)) & also, n))
        held, given = F.col("held"), F.col("value").isNotNull()
        found = {("min_rows", "row_count"): of(keys[0], held)}
        found |= {("unique_key", c): of(c, F.lit(1), held > 1) for c in rules.unique}
        found |= {("null_columns", c): of(keys[0], F.col(f"_null{along.index(c)}")) if c in along else of(c, held, ~given)
                  for c in rules.not_null}
        found |= {("foreign_key", c): of(c, held, given & ~F.col("known")) for c in rules.foreign}
    else:
        counted = df.agg(*counters)
        found = {("min_rows", "row_count"): F.sum("held")}
        found |= {("null_columns", c): F.sum(f"_null{k}") for k, c in enumerate(along)}
    totals = counted.agg(*[F.coalesce(found[rule], F.lit(0)).cast("long").alias(f"n{k}") for k, rule in enumerate(wanted)])
    least = lambda check: rules.minimum if check == "min_rows" else 0
    rows = F.array(*[F.struct(F.lit(check).alias("check"), F.lit(metric).alias("metric"), F.col(f"n{k}").alias("n"),
                              F.lit(least(check)).cast("long").alias("least")) for k, (check, metric) in enumerate(wanted)])
    n = F.col("r.n")
    return _rows(totals.select(F.explode(rows).alias("r")), F.col("r.check"), table, F.col("r.metric"), n, F.col("r.least"),
                 F.when(F.col("r.check") == "min_rows", n >= F.col("r.least")).otherwise(n == 0))


_PART_BITS = 22  # of a hash: sums of parts stay longs, up to 2^41 rows


def _parts(h: Column) -> list[Column]:
    """A hash as three numbers, the highest signed."""
    low = F.lit((1 << _PART_BITS) - 1)
    return [h.bitwiseAND(low), F.shiftright(h, _PART_BITS).bitwiseAND(low), F.shiftright(h, 2 * _PART_BITS)]


def _whole(sums: list[Column]) -> Column:
    """The exact sum of hashes from the sums of their parts: decimal arithmetic once, not for every row."""
    low, middle, high = (c.cast("decimal(20,0)") for c in sums)
    factor = lambda n: F.lit(1 << n * _PART_BITS).cast(f"decimal({8 * n},0)")
    return (high * factor(2) + middle * factor(1) + low).cast("decimal(38,0)").cast("string")


def _told(df: DataFrame, column: str) -> Column:
    """A value as text that other engines write alike: six decimals for floating numbers."""
    kind = df.schema[column].dataType.typeName()
    told = F.col(f"`{column}`")
    if kind in ("float", "double"):
        told = told.try_cast("decimal(38,6)")
    elif kind.startswith("timestamp"):
        told = F.unix_micros(told.cast("timestamp"))
    return F.coalesce(told.cast("string"), F.lit("\\N"))


def fingerprint(df: DataFrame, table: str, columns: list[str] | None = None) -> DataFrame:
    """(table_name, column_name, nb_lignes, hash_sum, hash_xor) of a table and of each of its columns.

    It tells contents, not their order: the rows' hashes are added up and joined by exclusive or, so
    tables of any partitioning compare, and swapped, changed, lost or doubled values show, per column
    too. The row ``*`` hashes whole rows. Sixty bits of an md5 each. One scan: whole rows are hashed there,
    the values of each column are counted by grouping sets and each different one is hashed once.
    """
    columns = columns or df.columns
    told = [_told(df, c) for c in columns]
    hashed = lambda text: F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")
    names = [f"t{k}" for k in range(len(columns))]
    values = df.select(*[text.alias(name) for text, name in zip(told, names)], hashed(F.concat_ws("|", *told)).alias("row"))
    counted = values.groupingSets([[name] for name in names], *names).agg(
        F.count(F.lit(1)).alias("held"), *[F.sum(part).alias(f"r{j}") for j, part in enumerate(_parts(F.col("row")))],
        F.bit_xor("row").alias("rx"), *[(F.grouping(name) == 0).alias(f"is_{name}") for name in names])
    key, text = F.lit(None), F.lit(None)
    for k, name in enumerate(names):
        key, text = F.when(F.col(f"is_{name}"), k).otherwise(key), F.when(F.col(f"is_{name}"), F.col(name)).otherwise(text)
    counted = counted.select(key.alias("key"), hashed(text).alias("h"), "held", "r0", "r1", "r2", "rx")
    added = counted.groupBy("key").agg(
        F.sum("held").alias("n"), *[F.sum(F.col("held") * part).alias(f"s{j}") for j, part in enumerate(_parts(F.col("h")))],
        F.bit_xor(F.when(F.col("held") % 2 == 1, F.col("h"))).alias("x"),
        *[F.sum(f"r{j}").alias(f"r{j}") for j in range(3)], F.bit_xor("rx").alias("rx"))
    entry = lambda name, letter, xor: F.struct(name.alias("column_name"), _whole([F.col(f"{letter}{j}") for j in range(3)])
                                               .alias("hash_sum"), F.col(xor).alias("hash_xor"))
    # Every key's groups hold all rows, so the first one tells the whole rows' sums.
    entries = F.array_compact(F.array(
        entry(F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("key") + 1), "s", "x"),
        F.when(F.col("key") == 0, entry(F.lit("*"), "r", "rx"))))
    found = added.select("n", F.explode(entries).alias("r")).select("n", "r.*")
    wanted = inline_table(df.sparkSession, [(c,) for c in [*columns, "*"]], ["column_name"])
    return wanted.join(found, "column_name", "left").select(
        F.lit(table).alias("table_name"), "column_name", F.coalesce("n", F.lit(0)).cast("bigint").alias("nb_lignes"),
        F.coalesce("hash_sum", F.lit("0")).alias("hash_sum"), F.coalesce("hash_xor", F.lit(0)).cast("bigint").alias("hash_xor"))


def fingerprint_by(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, nb_lignes, hash_sum, hash_xor) of the rows under each value of ``key``, in any order.

    Values are hashed with a mark of being NULL, since a hash of several columns passes over NULLs.
    One scan, one row per key and task shuffled.
    """
    marked = [part for c in columns for part in (F.col(c), F.col(c).isNull())]
    return (df.select(key, F.xxhash64(*marked).alias("_hash")).groupBy(key)
            .agg(F.count(F.lit(1)).alias("nb_lignes"), F.bit_xor("_hash").alias("hash_xor"),
                 *[F.sum(part).alias(f"_s{j}") for j, part in enumerate(_parts(F.col("_hash")))])
            .select(key, "nb_lignes", _whole([F.col(f"_s{j}") for j in range(3)]).alias("hash_sum"), "hash_xor"))


def same_contents(copy: DataFrame, original: DataFrame, table: str, columns: list[str] | None = None) -> DataFrame:
    """A check row per column, and one for whole rows: 1 where a copy differs from its original."""
    columns = columns or original.columns
    one, other = fingerprint(copy, table, columns), fingerprint(original, table, columns)
    same = ["column_name", "nb_lignes", "hash_sum", "hash_xor"]
    judged = other.join(one.select(*same, F.lit(True).alias("found")), same, "left")
    differs = F.col("found").isNull().cast("int")
    return _rows(judged, "same_contents", table, F.col("column_name"), differs, F.lit(0), differs == 0)


def collapsed(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """Keys that had several different rows before one was picked: reported, never a failure."""
    from starmart.operators.keyed import collapsed_keys

    n = F.col("_keys")
    return _rows(collapsed_keys(df, keys).agg(F.count(F.lit(1)).alias("_keys")),
                 "collapsed_keys", table, "+".join(keys), n,
                 F.lit(None), F.lit(True))


def gate(checks: DataFrame) -> None:
    """Raise when a check failed. A handful of rows comes to the driver: one per check."""
    failed = checks.filter(~F.col("passed")).collect()
    if failed:
        raise GateError("; ".join(f"{r.table_name}: {r.check_name} {r.metric_name} = "
                                  f"{r.metric_value.normalize():f}" for r in failed))


def denied_columns(df: DataFrame, denied: list[str]) -> list[str]:
    """Columns of ``df`` that privacy rules keep out of the mart."""
    return [c for c in df.columns if c.lower() in denied]


def log_run(spark: SparkSession, path: str, run: dict) -> None:
    """Append one run to the run log."""
    if run["status"] not in RUN_STATUS:
        raise ValueError(f"run status {run['status']}")
    names = [field.split()[0] for field in RUN_LOG_SCHEMA.split(", ")]
    row = tuple(run.get(name, 0 if name.startswith("rows_") else None) for name in names)
    spark.createDataFrame([row], RUN_LOG_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def log_flows(spark: SparkSession, path: str, run_id: int, flows: dict[str, tuple[int, int]]) -> None:
    """Append a row per flow of a run: rows read from its feed and rows that its load accepted."""
    rows = [(run_id, flow, read, written) for flow, (read, written) in sorted(flows.items())]
    (spark.createDataFrame(rows, FLOW_LOG_SCHEMA).coalesce(1).write.mode("append").parquet(path))


def log_quality(checks: DataFrame, path: str, run_id: int) -> None:
    """Append the checks of a run. Numbering is one small window: a row per check."""
    numbered = checks.withColumn("quality_id", F.row_number().over(
        Window.orderBy("check_name", "table_name", "metric_name")).cast("bigint"))
    (numbered.select("quality_id", F.lit(run_id).cast("bigint").alias("run_id"), *checks.columns,
                     F.current_timestamp().alias("created_at"))
     .coalesce(1).write.mode("append").parquet(path))


def logged_volumes(flows: DataFrame, checks: DataFrame, run_id: int, gold: dict[str, str]) -> DataFrame:
    """The rows (zone, entity, nb_lignes) of a run from its logs alone, for ``volume_report``.

    ``flows`` is the flow log: rows read from a feed and rows staged. ``checks`` is the quality log, whose gate
    has counted every table; ``gold`` names the table of each flow. No fact is scanned.
    """
    of_run = flows.where(F.col("run_id") == run_id)
    zone = lambda name, column: of_run.select(F.lit(name).alias("zone"), F.col("flow").alias("entity"),
                                              F.col(column).alias("nb_lignes"))
    counted = checks.where((F.col("run_id") == run_id) & (F.col("check_name") == "min_rows"))
    tables = inline_table(flows.sparkSession, [(table, flow) for flow, table in gold.items()], ["table_name", "entity"])
    known = counted.join(tables, "table_name").select(
        F.lit("gold").alias("zone"), "entity", F.col("metric_value").cast("bigint").alias("nb_lignes"))
    return union_all([zone("bronze", "rows_read"), zone("staging", "rows_written"), known])


def volume_report(counts: DataFrame) -> DataFrame:
    """Rows per entity in each zone and how much of the previous zone each keeps.

    ``counts`` has columns zone (bronze, staging, gold), entity and nb_lignes.
    """
    zones = ["bronze", "staging", "gold"]
    wide = counts.groupBy("entity").pivot("zone", zones).agg(F.sum("nb_lignes"))
    ratio = lambda a, b: F.when(F.col(b) > 0, F.col(a).cast("double") / F.col(b).cast("double"))
    return wide.select("entity", *zones, ratio("staging", "bronze").alias("staging_ratio"),
                       ratio("gold", "staging").alias("gold_ratio"))
