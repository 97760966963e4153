"""Refresh by changed years, ids beside it, and fingerprints per key."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from conftest import values
from starmart.operators import quality, sinks
from starmart.operators.ids import dense_ids, position
from starmart.plans import kpis
from starmart.plans import rebuild as mart
from starmart.session import new_folder, path_exists
from test_plans import sources  # noqa: F401

FACTS = {"fait_consultation": ["id_temps", "id_patient", "finess", "code_diag", "nb_consultations", "annee"],
         "fait_deces": ["id_temps", "id_geo", "nb_deces", "annee"],
         "fait_satisfaction": ["id_temps", "finess", "id_geo", "score_global", "annee"]}


def facts_of(run):
    return {name: values(run.read(name).select(*columns)) for name, columns in FACTS.items()}


def written_years(run):
    return {(r.fait, r.annee) for r in run.years().where(F.col("run_id") == run.run_id).collect()}


def test_refresh_writes_changed_years_and_equals_a_rebuild(spark, sources):  # noqa: F811
    root = new_folder(spark, "mart")
    first = mart.rebuild(spark, sources, root, mart.EXTENDED, changed_years_only=True)  # nothing to keep yet
    assert first.years() is None and first.needed_runs() == {first.run_id}

    changed = replace(sources, consultations=sources.consultations.withColumn(
        "diagnostic", F.when(F.col("id_consultation") == "4", "D9").otherwise(F.col("diagnostic"))),  # of 2019
        deaths=sources.deaths.where("NOT date_deces LIKE '2018%'"))
    second = mart.rebuild(spark, changed, root, mart.EXTENDED, changed_years_only=True)
    assert written_years(second) == {("fait_consultation", 2019)}
    assert second.needed_runs() == {first.run_id, second.run_id}
    assert not path_exists(spark, second.path("fait_deces"))  # a lost year is no longer listed
    full = mart.rebuild(spark, changed, new_folder(spark, "mart"), mart.EXTENDED)
    shown = mart.published_run(spark, root)
    assert shown.run_id == second.run_id and facts_of(shown) == facts_of(full)
    ids = [r[0] for r in shown.read("fait_consultation").select("id_fait_consultation").collect()]
    assert len(ids) == len(set(ids)) == 120 and max(ids) == 160

    # A second refresh carries years over from two runs; one of nothing new writes nothing.
    third = mart.rebuild(spark, replace(changed, deaths=sources.deaths), root, mart.EXTENDED, changed_years_only=True)
    assert written_years(third) == {("fait_deces", 2018)}
    assert third.needed_runs() == {first.run_id, second.run_id, third.run_id}
    fourth = mart.rebuild(spark, replace(changed, deaths=sources.deaths), root, mart.EXTENDED, changed_years_only=True)
    assert written_years(fourth) == set() and facts_of(fourth) == facts_of(third)

    plan = (kpis.deaths_by_region(fourth.star()).filter("annee = 2019")
            ._jdf.queryExecution().executedPlan().toString())
    assert plan.count("annee") and "PartitionFilters: [" in plan
    assert values(kpis.deaths_by_region(fourth.star()).select("annee", "nb_deces")) == [(2018, 1), (2019, 2)]


def test_old_runs_go_but_not_what_is_still_read(spark, sources):  # noqa: F811
    root = new_folder(spark, "mart")
    unused = mart.rebuild(spark, sources, root, mart.STANDARD)
    first = mart.rebuild(spark, sources, root, mart.STANDARD)
    changed = replace(sources, consultations=sources.consultations.where("id_consultation <> '4'"))
    second = mart.rebuild(spark, changed, root, mart.STANDARD, changed_years_only=True)
    assert second.needed_runs() == {first.run_id, second.run_id}
    assert mart.remove_old_runs(spark, root, keep=1) == [unused.run_id]
    assert mart.published_run(spark, root).read("fait_consultation").count() == 119
    report = {r.entity: (r.bronze, r.staging, r.gold, r.gold_ratio) for r in mart.volume_report(spark, root).collect()}
    assert report == {"consultations": (119, 119, 119, 1.0)}


def test_refresh_of_another_mode_is_a_rebuild(spark, sources):  # noqa: F811
    root = new_folder(spark, "mart")
    mart.rebuild(spark, sources, root, mart.STANDARD)
    run = mart.rebuild(spark, sources, root, mart.EXTENDED, changed_years_only=True)
    assert run.years() is None and run.read("fait_deces").count() == 2
    again = mart.rebuild(spark, sources, root, mart.STANDARD, changed_years_only=True)
    assert again.years() is None and again.read("fait_deces").count() == 0


def test_stays_without_a_day_and_stays_that_come_later(spark, sources, rows):  # noqa: F811
    schema = "id_patient string, finess string, code_diag string, date_entree string, jours string"
    root = new_folder(spark, "mart")
    mart.rebuild(spark, sources, root, mart.EXTENDED)  # without stays: a table without years
    stays = [("1", "1", "D1", "15-01-2018", "3"), ("1", "1", None, None, None)]
    run = mart.rebuild(spark, replace(sources, hospitalisations=rows(schema, *stays)), root, mart.EXTENDED, True)
    assert written_years(run) == {("fait_hospitalisation", 2018), ("fait_hospitalisation", None)}
    more = [*stays, ("2", "1", None, None, None)]
    run = mart.rebuild(spark, replace(sources, hospitalisations=rows(schema, *more)), root, mart.EXTENDED, True)
    assert written_years(run) == {("fait_hospitalisation", None)}
    found = mart.published_run(spark, root).read("fait_hospitalisation")
    assert values(found.select("id_patient", "annee")) == [("1", 2018), ("1", None), ("2", None)]
    none = mart.rebuild(spark, replace(sources, hospitalisations=rows(schema, ("x", "1", None, None, None))), root,
                        mart.EXTENDED, True)
    assert none.read("fait_hospitalisation").count() == 0
    assert mart.published_run(spark, root).read("fait_hospitalisation").count() == 0


def test_failed_refresh_publishes_nothing(spark, sources):  # noqa: F811
    root = new_folder(spark, "mart")
    first = mart.rebuild(spark, sources, root, mart.STANDARD)
    with pytest.raises(quality.GateError):
        mart.rebuild(spark, replace(sources, consultations=sources.consultations.filter("false")), root,
                     mart.STANDARD, changed_years_only=True)
    assert sinks.current_run(spark, root) == first.run_id


def test_fingerprints_per_key_tell_nulls_and_copies(rows):
    schema = "k int, a string, b string"
    told = lambda *found: {r.k: tuple(r)[1:] for r in quality.fingerprint_by(rows(schema, *found), "k", ["a", "b"]).collect()}
    assert told((1, "x", None), (2, "y", "z"), (None, "q", "q")) == told((None, "q", "q"), (2, "y", "z"), (1, "x", None))
    assert told((1, "x", None))[1] != told((1, None, "x"))[1]
    assert told((1, "x", "y"), (1, "x", "y"))[1] != told((1, "p", "q"), (1, "p", "q"))[1]  # copies don't cancel out


def test_ids_of_unique_and_of_placed_rows(spark, tmp_path):
    spark.range(1000).selectExpr("IF(id % 3 = 0, 7, id) AS k").write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    unique = dense_ids(stored.distinct(), ["k"], "n", start=5, is_unique=True)
    assert [tuple(r) for r in unique.orderBy("n").collect()] == list(
        enumerate(sorted({7 if i % 3 == 0 else i for i in range(1000)}), 5))
    placed = dense_ids(stored.withColumn("_at_scan", position()).where("k < 900"), ["k"], "n", tie="_at_scan")
    assert placed.columns == ["n", "k"]
    assert [tuple(r) for r in placed.orderBy("n").collect()] == list(
        enumerate(sorted(k for k in (7 if i % 3 == 0 else i for i in range(1000)) if k < 900), 1))
