from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import values
from starmart.functions import fixed_values as fixed
from starmart.operators import dimensions as dims
from starmart.operators import facts, keyed, quality, sinks, staging
from starmart.operators.ids import dense_ids
from starmart.session import empty_table, new_folder

STAGED = "id_patient string, date_consultation date, id_etablissement string, diagnostic string"
GEO = "id_geo int, code_region string, libelle_region string, pays string"


def test_one_row_per_key_takes_smallest_row_nulls_last(spark, rows):
    df = rows("k string, a string, b int", ("x", None, 1), ("x", "b", 2), ("x", "b", None), ("y", None, None))
    assert values(keyed.one_row_per_key(df, ["k"])) == [("x", "b", 2), ("y", None, None)]


def test_overwrite_merge_twice_equals_once(spark, rows):
    cur = rows("k string, a string, b string", ("1", "a", "b"), ("2", "a", "b"))
    inc = rows("k string, a string, b string", ("2", None, None), ("3", "c", "d"))
    once = keyed.overwrite_merge(cur, inc, "k", keep_old_when_null=["a"])
    assert values(once) == [("1", "a", "b"), ("2", "a", None), ("3", "c", "d")]
    assert values(keyed.overwrite_merge(once, inc, "k", keep_old_when_null=["a"])) == values(once)


def test_geography_numbers_new_codes_after_the_largest_id(spark, rows):
    cur = rows(GEO, (7, "84", "Old", "FRANCE"))
    staged = rows("code_region_src string, libelle_region_src string, pays_src string",
                  (" 93 ", "P", None), ("84", "New", " "), ("11", " ", "X"), ("11", "I", "X"), (" ", "z", "z"))
    expected = [(7, "84", "New", "FRANCE"), (8, "11", "I", "X"), (9, "93", "P", "FRANCE")]
    merged = dims.merge_geography(cur, staged)
    assert values(merged) == expected
    again = dims.merge_geography(merged, staged)
    assert values(again) == expected


def test_establishments_update_and_insert(spark, rows):
    geo = rows(GEO, (1, "84", "A", "F"))
    cur = rows("finess string, nom string, id_geo int", ("12", "old", None), ("9", "keep", 3))
    staged = rows("finess string, nom string, code_region string",
                  ("0012", " ", "84"), ("12", "B", " 84 "), ("77", "N", "x"), (" ", "z", "84"))
    incoming = dims.staged_establishments(staged, geo)
    two_steps = dims.insert_establishments(dims.update_establishments(cur, incoming), incoming)
    expected = [("12", "B", 1), ("77", "N", None), ("9", "keep", 3)]
    assert values(two_steps) == expected
    assert values(dims.merge_establishments(cur, staged, geo)) == expected
    survey = rows("finess_src string, code_region_src string", ("9", "84"), ("9", "84"), ("5", "84"), ("6", "x"))
    upserted = dims.merge_surveyed_establishments(cur, survey, geo)
    assert values(upserted) == [("12", "old", None), ("5", None, 1), ("9", "keep", 1)]


def test_practitioner_and_patient_upserts(spark, rows):
    cur = rows("id_professionnel string, nom string", ("1", "A"), ("2", "B"))
    staged = rows("id_prof_source string, nom_source string", (" 1 ", " "), ("1", None), ("3", "C"), ("", "x"))
    assert values(dims.merge_practitioners(cur, staged)) == [("1", "A"), ("2", "B"), ("3", "C")]
    patients = rows("id_patient string, sexe string, age int", ("1", "F", 3), ("2", "M", 4))
    raw = rows("id_patient string, sexe string, age string", (" 1", "x", " "), ("3", "Mme", "12"), (" ", "f", "1"))
    assert values(dims.merge_patients(patients, raw)) == [("1", None, None), ("2", "M", 4), ("3", "M", 12)]


def test_calendar_upsert_keeps_one_row_per_day(spark, rows):
    a = dims.calendar(rows("d date", (date(2021, 1, 1),), (None,)), "d")
    b = dims.calendar(rows("d date", (date(2021, 1, 1),), (date(2020, 2, 29),)), "d")
    assert [r[0] for r in values(dims.merge_calendar(a, b))] == [20200229, 20210101]


def test_dense_ids_number_copies_of_a_hot_row(spark):
    """A third of the rows are copies of one row; ids stay dense and follow the sort order."""
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 500).otherwise(F.col("id")).cast("int").alias("k"))
    out = dense_ids(df, ["k"], "n", partitions=7)
    found = [tuple(r) for r in out.collect()]
    assert sorted(n for n, _ in found) == list(range(1, 3001))
    by_id = [k for _, k in sorted(found)]
    assert by_id == sorted(by_id)
    spread = out.groupBy(F.spark_partition_id()).count().agg(F.max("count")).head()[0]
    assert spread < 1500


def test_consultation_fact_and_seeds(spark, rows):
    staged = rows(STAGED, ("1", date(2021, 1, 1), "00012", " "), ("1", date(2021, 1, 1), "12", "D1 "))
    assert values(facts.consultation_fact(staged)) == [
        (20210101, "1", "12", None, "D1", None, 1), (20210101, "1", "12", None, "UNKNOWN", None, 1)]
    assert values(dims.establishments_of_consultations(staged)) == [("12", None, None)]
    assert values(dims.diagnoses(staged)) == [("D1", "D1"), ("UNKNOWN", "UNKNOWN")]


def test_deaths_sum_to_input_less_rejects(spark, rows):
    raw = rows("date string, place string", *[("2020-01-01", "69001")] * 5,
               ("2020-01-01", "01000"), ("2019-00-00", "69001"), ("2020", "69001"),
               ("2020-01-02", "99999"))
    counted = facts.deaths_of_raw_rows(raw, "date", "place")
    loaded = staging.load_deaths_counts(counted)
    assert values(loaded.accepted) == [(date(2020, 1, 1), "84", 6)]
    assert values(loaded.rejected) == [("2019-00-00", "84", 1, "date_deces")]
    fact = facts.deaths_fact(loaded.accepted, rows(GEO, (1, "84", "A", "F"), (2, "93", "B", "F")))
    assert values(fact) == [(20200101, 1, 6)]


def test_hospitalisation_keeps_stays_outside_the_calendar(spark, rows):
    raw = rows("id_patient string, code_diag string, date_entree string, jours string, finess string",
               ("1", "D", " 01-01-2020", "3", "007"), ("2", "D", "31-02-2020", " ", "7"))
    calendar = dims.calendar(rows("d date", (date(2020, 1, 1),)), "d")
    assert values(facts.hospitalisation_fact(raw, calendar)) == [
        (20200101, "1", "7", "D", 1), (None, "2", "7", "D", 1)]
    days = facts.hospitalisation_fact(raw, calendar, count_days=True)
    assert [r[4] for r in values(days)] == [3, None]


def test_unknown_diagnosis_is_tagged(spark, rows):
    fact = rows("code_diag string, n int", ("D1", 1), ("D9", 1), (None, 1))
    out = facts.attach_diagnosis(fact, rows("code_diag string, libelle string", ("D1", "Un")))
    assert values(out) == [("D1", 1, "Un"), ("UNKNOWN", 1, "UNKNOWN"), ("UNKNOWN", 1, "UNKNOWN")]


def test_consultation_load_splits_rejects(spark, rows):
    raw = rows("id_consultation string, id_patient string, date_consultation string, diagnostic string, "
               "id_etablissement string, montant string, sexe string, age string",
               ("1", "p", "2020-01-01", None, "e", "0", "F", "45"),
               ("2", None, "2020-13-01", None, None, "n/a", "F", "x"),
               ("3", "p", "2020-01-01", None, "e", "", None, " "))
    loaded = staging.load_consultations(raw)
    assert [(r.id_consultation, r.montant, r.age) for r in loaded.accepted.orderBy("id_consultation").collect()] == [
        ("1", Decimal("0.00"), 45), ("3", None, None)]
    assert [r.reason for r in loaded.rejected.collect()] == [
        "id_patient,date_consultation,id_etablissement,montant,age"]


def test_geography_load_defaults(spark, rows):
    named = staging.load_geography(rows("region_code string, nom_region string", ("84", "A"), (" ", "B"))).accepted
    assert [tuple(r)[1:] for r in named.collect()] == [("84", "A", "FRANCE")]
    with_country = staging.load_geography(rows("id string, code_region string, pays string", ("3.0", "84", " "))).accepted
    assert values(with_country) == [(3, "84", None, None)]


def test_require_rows(spark):
    with pytest.raises(staging.LoadError):
        staging.require_rows(empty_table(spark, "a int"), "t")


def test_quality_checks_and_gate(spark, rows):
    df = rows("k string, v int", ("a", 1), ("a", None), (None, 2))
    checks = quality.union_all([
        quality.minimum_rows({"t": df}), quality.null_columns(df, "t", ["k", "v"]),
        quality.duplicate_keys(df, "t", ["k"]),
        quality.orphans(df, "t", "k", rows("id string", ("b",)), "id"),
        quality.rule_violations(df, "t", {"positive": F.col("v") < 0})])
    found = {(r.check_name, r.metric_name): (int(r.metric_value), r.passed) for r in checks.collect()}
    assert found == {("min_rows", "row_count"): (3, True), ("null_columns", "k"): (1, False),
                     ("null_columns", "v"): (1, False), ("unique_key", "k"): (1, False),
                     ("foreign_key", "k"): (2, False), ("domain", "positive"): (0, True)}
    with pytest.raises(quality.GateError, match="unique_key"):
        quality.gate(checks)
    assert values(quality.collapsed(df, "t", ["k"]))[0][3] == Decimal("1.000000")


def test_privacy(rows):
    assert quality.denied_columns(rows("id string, NOM string", ("1", "x")), fixed.DENIED_COLUMNS) == ["NOM"]


def test_run_log_refuses_unknown_status(spark):
    with pytest.raises(ValueError):
        quality.log_run(spark, new_folder(spark, "log"), {"run_id": 1, "status": "done"})


def test_year_reload_replaces_only_its_year(spark, rows):
    path = new_folder(spark, "years")
    sinks.overwrite_years(rows("n int, annee int", (1, 2019), (2, 2020)), path)
    sinks.overwrite_years(rows("n int, annee int", (3, 2020)), path)
    assert values(spark.read.parquet(path)) == [(1, 2019), (3, 2020)]


def test_orc_table_prunes_years(spark, rows):
    path = new_folder(spark, "orc")
    df = rows("n int, annee int", (1, 2019), (2, 2020))
    sinks.write_orc(df, path, "annee")
    table = sinks.external_orc_table(spark, "orc_pruned", df.schema, path, "annee").filter("annee = 2020")
    assert values(table) == [(2, 2020)]
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "annee" in plan.split("PartitionFilters: [")[1].split("]")[0]
