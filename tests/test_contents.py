"""Contents of tables, checks in one scan, replaced tables, logs of flows, and plans that prune."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import values
from starmart.operators import facts, quality, sinks, staging
from starmart.plans import kpis
from starmart.plans import rebuild as mart
from starmart.session import new_folder
from test_plans import published, sources  # noqa: F401

SCHEMA = "k long, name string, day date, score double, price decimal(10,2), at timestamp, flag boolean"


def table(spark, seed=1, n=50):
    import datetime as dt

    rng = random.Random(seed)
    rows = [(rng.choice([None, i]), rng.choice([None, "", "é|", "\\N", "a"]), dt.date(2020, 1, 1 + i % 28), i / 8,
             None, dt.datetime(2020, 1, 1, 0, 0, i), i % 2 == 0) for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA)


def told(df):
    return {r.column_name: (r.nb_lignes, r.hash_sum, r.hash_xor) for r in quality.fingerprint(df, "t").collect()}


def test_fingerprint_tells_contents_not_order(spark):
    df = table(spark)
    base = told(df)
    assert base == told(df.repartition(7)) == told(df.orderBy(F.rand(3)))
    assert set(base) == {*df.columns, "*"} and all(v[0] == 50 for v in base.values())
    doubled = told(df.unionByName(df))
    assert all(doubled[c][0] == 100 and doubled[c][2] == 0 for c in doubled)  # exclusive or alone would be blind
    assert told(df.limit(0)) == {c: (0, "0", 0) for c in base}


def test_a_changed_cell_shows_in_its_column_only(spark):
    df = table(spark)
    base = told(df)
    for column, value in (("name", "b"), ("score", 99.5), ("k", -1), ("flag", None)):
        cell = F.when(F.col("score") == 2.0, F.lit(value).cast(df.schema[column].dataType)).otherwise(F.col(column))
        changed = told(df.withColumn(column, cell))
        assert {c for c in base if base[c] != changed[c]} == {column, "*"}


def test_swapped_values_show_in_whole_rows(spark, rows):
    one, other = rows("a int, b int", (1, 1), (2, 2)), rows("a int, b int", (1, 2), (2, 1))
    assert {c for c in told(one) if told(one)[c] != told(other)[c]} == {"*"}


def test_copies_are_checked_by_contents(spark, rows, tmp_path):
    gold = {"dim_diagnostic": rows("code_diag string, libelle string", ("D1", "a;\"b\"\nc"), ("D2", None), ("D3", ""))}
    sinks.export_csv(gold, str(tmp_path))
    back = sinks.read_export(spark, str(tmp_path), "dim_diagnostic", "code_diag string, libelle string")
    assert values(back) == values(gold["dim_diagnostic"])
    quality.gate(quality.same_contents(back, gold["dim_diagnostic"], "dim_diagnostic"))
    wrong = back.withColumn("libelle", F.coalesce("libelle", F.lit("x")))
    with pytest.raises(quality.GateError, match="same_contents"):
        quality.gate(quality.same_contents(wrong, gold["dim_diagnostic"], "dim_diagnostic"))


def test_one_scan_gives_the_rows_of_the_single_checks(rows):
    fact = rows("id int, d int, e string, n int", (1, 1, "a", None), (2, 9, None, 1), (2, 9, "b", 1), (None, 1, "z", None),
                (None, 2, "a", 1))
    days, names = rows("d int", (1,), (2,)), rows("e string", ("a",), ("b",))
    single = quality.union_all([
        quality.minimum_rows({"f": fact}, 3), quality.duplicate_keys(fact, "f", ["id"]),
        quality.null_columns(fact, "f", ["n", "e"]), quality.orphans(fact, "f", "d", days, "d"),
        quality.orphans(fact, "f", "e", names, "e")])
    at_once = quality.soundness(fact, "f", quality.Rules(3, ("id",), ("n", "e"), {"d": (days, "d"), "e": (names, "e")}))
    assert values(at_once) == values(single) and at_once.columns == single.columns
    assert {r.metric_name: int(r.metric_value) for r in at_once.collect()} == {
        "row_count": 5, "id": 2, "n": 2, "e": 1, "d": 2} or values(at_once)
    nothing = quality.soundness(fact.limit(0), "f", quality.Rules(1, ("id",), ("n",), {"d": (days, "d")}))
    assert [(r.check_name, r.passed) for r in nothing.orderBy("check_name").collect()] == [
        ("foreign_key", True), ("min_rows", False), ("null_columns", True), ("unique_key", True)]
    assert quality.soundness(fact, "f", quality.Rules()).count() == 0


def test_gate_scans_each_fact_once(spark, sources):  # noqa: F811
    run = mart.rebuild(spark, sources, new_folder(spark, "mart"), mart.EXTENDED)
    plan = mart.checks(run, mart.EXTENDED)._jdf.queryExecution().optimizedPlan().toString()
    relations = [line for line in plan.splitlines() if "Relation [" in line]
    fact = run.read("fait_consultation").columns
    scans = [line for line in relations if "nb_consultations#" in line]
    assert "nb_consultations" in fact and len(scans) == 1


def test_flows_are_logged(spark, sources):  # noqa: F811
    root = new_folder(spark, "mart")
    mart.rebuild(spark, sources, root, mart.EXTENDED)
    log = spark.read.parquet(f"{root}/audit/etl_flow_log")
    assert values(log.select("flow", "rows_read", "rows_written")) == [
        ("consultations", 120, 120), ("deces", 3, 2), ("etablissements", 2, 2), ("geographie", 3, 3),
        ("professionnels", 3, 3), ("satisfaction", 3, 3)]


def test_a_load_without_a_usable_row_fails_at_once(spark, sources):  # noqa: F811
    sources.deaths = sources.deaths.filter("date_deces = '2019-00-00'")
    with pytest.raises(staging.LoadError, match="stg_deces_raw"):
        mart.rebuild(spark, sources, new_folder(spark, "mart"), mart.EXTENDED)


def test_counted_deaths_add_up(rows):
    single = rows("date_deces string, code_region string", ("2019-01-01", "84"), ("2019-01-01", " 84"), ("x", "84"))
    counted = rows("date_deces string, code_region string, nb_deces string", ("2019-01-01", "84", "5"),
                   ("2019-01-01", "84", "2"), ("2019-01-02", "84", None), ("2019-01-02", " ", "3"))
    assert values(facts.deaths_by_day_and_region(single)) == [("2019-01-01", "84", 2)]
    assert values(facts.deaths_by_day_and_region(counted)) == [("2019-01-01", "84", 7), ("2019-01-02", "84", 1)]


def test_failed_replacement_leaves_the_table(spark, rows):
    path = new_folder(spark, "table")
    with pytest.raises(FileNotFoundError):
        sinks.read_table(spark, path)
    first = sinks.insert_overwrite(rows("n int", (1,), (2,)), path)
    broken = rows("n int", (1,), (2,)).select(
        F.when(F.col("n") == 2, F.raise_error(F.lit("lost"))).otherwise(F.col("n")).cast("int").alias("n"))
    with pytest.raises(Exception, match="lost"):
        sinks.insert_overwrite(broken, path)
    assert values(sinks.read_table(spark, path)) == [(1,), (2,)] and sinks.current_version(spark, path) == first


def test_a_table_may_be_replaced_by_what_is_read_from_it(spark, rows):
    path = new_folder(spark, "table")
    versions = [sinks.insert_overwrite(rows("n int", (1,)), path)]
    for _ in range(3):
        now = sinks.read_table(spark, path)
        versions.append(sinks.insert_overwrite(now.unionByName(now.select((F.col("n") + 1).alias("n"))), path))
    assert sinks.read_table(spark, path).count() == 8
    assert sinks.read_table(spark, path, versions[1]).count() == 2
    assert sinks.remove_old_versions(spark, path) == versions[:2]
    assert sinks.read_table(spark, path).count() == 8 and sinks.read_table(spark, path, versions[2]).count() == 4
    sinks.insert_overwrite(rows("n int", (1,)).limit(0), path)
    assert sinks.read_table(spark, path).count() == 0


@pytest.mark.parametrize("kpi", ["consultations_by_practitioner", "consultations_by_establishment", "demographics",
                                 "satisfaction_volume"])
def test_more_year_filters_prune_folders(published, kpi):  # noqa: F811
    filtered = getattr(kpis, kpi)(published).filter(F.col("annee") == 2019)
    plan = filtered._jdf.queryExecution().executedPlan().toString()
    assert any("annee" in part.split("]")[0] for part in plan.split("PartitionFilters: [")[1:]), plan
    assert filtered.count() == 1


def test_entry_keeps_the_other_queries_without_a_dependency():
    import subprocess
    import sys

    code = ("import sys, warnings; sys.modules['zstandard'] = None; warnings.simplefilter('ignore')\n"
            "import __spark_entry__ as e\n"
            "assert len(e.queries()) > 120 and 'pipeline' not in e.queries() and set(e.oracle_sql()) == set(e.queries())")
    import os

    assert subprocess.run([sys.executable, "-c", code], timeout=120,
                          cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__)))).returncode == 0
