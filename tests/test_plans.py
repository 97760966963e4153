"""Whole runs on a small mart, brute-force KPI checks, and assertions on physical plans."""
from collections import Counter, defaultdict
from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import values
from starmart.operators import quality, sinks, staging
from starmart.plans import kpis
from starmart.plans import raw_to_mart
from starmart.plans import rebuild as mart
from starmart.session import new_folder

CONSULTATION = ("id_consultation string, id_patient string, date_consultation string, diagnostic string, "
                "id_etablissement string, montant string, sexe string, age string")


@pytest.fixture
def sources(rows):
    consultations = [(str(i), str(i % 7), f"20{18 + i % 3}-0{1 + i % 9}-15", f"D{i % 4}" if i % 5 else " ",
                      f"00{i % 3}", "0", ["F", "M", None][i % 7 % 3], str(10 * (i % 7))) for i in range(120)]
    return mart.Sources(
        consultations=rows(CONSULTATION, *consultations),
        deaths=rows("date_deces string, code_region string", ("2019-01-01", "84"), ("2019-01-01", "84"),
                    ("2019-00-00", "84"), ("2018-05-05", "93")),
        surveys=rows("date_satisfaction string, finess string, code_region string, score_global string",
                     ("2020-01-01", "1", "84", "73.5"), ("2020-01-01", "1", "84", "90"), ("2020-06-01", "44", "93", "80")),
        establishments=rows("finess string, nom string, code_region string", ("1", "Un", "84"), ("55", "", "x")),
        practitioners=rows("id_prof_source string, nom_source string", ("p1", "A"), ("p1", ""), ("p2", "")),
        geography=rows("code_region string, libelle_region string, pays string", ("84", "Rhone", "FRANCE"),
                       ("84", "Autre", "FRANCE"), ("93", "Sud", "FRANCE")))


def test_extended_then_standard(spark, sources):
    root = new_folder(spark, "mart")
    mart.rebuild(spark, sources, root, mart.EXTENDED)
    run = mart.published_run(spark, root)
    fact = run.read("fait_consultation")
    assert sorted(r[0] for r in fact.select("id_fait_consultation").collect()) == list(range(1, 121))
    assert values(run.read("fait_deces").select("id_temps", "id_geo", "nb_deces")) == [
        (20180505, 2, 1), (20190101, 1, 2)]
    assert run.read("rejects_stg_deces_raw").count() == 1
    assert values(run.read("dim_geographie")) == [(1, "84", "Autre", "FRANCE"), (2, "93", "Sud", "FRANCE")]
    assert values(run.read("dim_professionnel")) == [("p1", "A"), ("p2", None)]
    assert dict(values(run.read("dim_etablissement").select("finess", "id_geo"))) == {
        "0": None, "1": 1, "2": None, "44": 2, "55": None}

    mart.rebuild(spark, sources, root, mart.STANDARD)
    after = mart.published_run(spark, root)
    assert after.run_id > run.run_id
    assert after.read("fait_deces").count() == after.read("fait_satisfaction").count() == 0
    assert after.read("dim_geographie").count() == 2 and after.read("dim_professionnel").count() == 2
    log = spark.read.parquet(f"{root}/audit/etl_run_log")
    assert values(log.select("status", "rows_read", "rows_written")) == [("success", 120, 120)] * 2
    assert spark.read.parquet(f"{root}/audit/data_quality_log").filter("NOT passed").count() == 0


def test_failed_run_publishes_nothing(spark, sources, rows):
    root = new_folder(spark, "mart")
    first = mart.rebuild(spark, sources, root, mart.STANDARD)
    bad = mart.Sources(consultations=sources.consultations.withColumn(
        "date_consultation", F.when(F.col("id_consultation") == "5", "2020-99-01").otherwise(F.col("date_consultation"))))
    with pytest.raises(staging.LoadError):
        mart.rebuild(spark, bad, root, mart.STANDARD)
    empty = mart.Sources(consultations=sources.consultations.filter("false"))
    with pytest.raises(quality.GateError, match="fait_consultation"):
        mart.rebuild(spark, empty, root, mart.STANDARD)
    assert sinks.current_run(spark, root) == first.run_id
    log = spark.read.parquet(f"{root}/audit/etl_run_log")
    assert Counter(r.status for r in log.collect()) == {"success": 1, "failed": 2}


@pytest.fixture
def star(rows):
    fact = [(20190100 + 1 + i % 3, str(i % 5), str(i % 2), f"p{i % 2}", ["D1", "D8", "D9"][i % 3], i % 4 or None, 1)
            for i in range(60)]
    return kpis.Star(
        patient=rows("id_patient string, sexe string, age int", ("0", "F", 17), ("1", None, 30),
                     ("2", "Non renseigné", 30), ("3", "F", None), ("4", "M", 71)),
        geography=rows("id_geo int, code_region string, libelle_region string", (1, "84", None)),
        establishment=rows("finess string, nom string, id_geo int", ("0", None, 1), ("1", "Un", 1)),
        diagnosis=rows("code_diag string, libelle string", ("D1", "Un")),
        practitioner=rows("id_professionnel string, nom string", ("p0", None), ("p9", "Z")),
        consultation=rows("id_temps int, id_patient string, finess string, id_professionnel string, "
                          "code_diag string, duree_consultation int, nb_consultations int", *fact),
        hospitalisation=rows("id_temps int, id_patient string, finess string, code_diag string, "
                             "nb_hospitalisations int", (20190101, "0", "0", "D8", 1), (20190101, "0", "0", "D9", 1),
                             (None, "0", "0", "D1", 1)),
        death=rows("id_temps int, id_geo int, nb_deces bigint", (20190101, 1, 5)),
        satisfaction=rows("id_temps int, finess string, id_geo int, score_global double",
                          (20200101, "1", 1, 80.05), (20200101, "1", 1, 80.0), (20200102, "1", 1, None)))


def test_null_and_literal_labels_stay_apart(star):
    found = [r for r in kpis.demographics(star).collect() if r.tranche_age == "30 – 49 ans"]
    assert [r.sexe for r in found] == ["Non renseigné"] * 2
    assert sum(r.nb_consultations for r in found) == 24


def test_distinct_patients_across_unknown_diagnoses(star):
    facts = [r for r in star.consultation.collect()]
    expected = defaultdict(set)
    sex = {r.id_patient: r.sexe for r in star.patient.collect()}
    for r in facts:
        expected[(r.finess, "D1" if r.code_diag == "D1" else None, sex[r.id_patient])].add(r.id_patient)
    found = {(r.finess, r.code_diag, r.sexe): r.nb_patients_distincts
             for r in kpis.consultations_volume(star).collect()}
    assert found == {k: len(v) for k, v in expected.items()}
    stay = kpis.hospitalisations_volume(star).collect()
    assert [(r.code_diag, r.nb_hospitalisations, r.nb_patients_distincts) for r in stay] == [(None, 2, 1)]


def test_unnamed_establishment_shows_no_region(star):
    found = {(r.finess, r.etablissement, r.region) for r in kpis.consultations_by_establishment(star).collect()}
    assert found == {("0", "Étab. 0", "Région inconnue"), ("1", "Un", "Région inconnue")}


def test_practitioners_without_activity(star):
    assert values(kpis.consultations_by_practitioner(star)) == [("p0", "Inconnu", 2019, 30), ("p9", "Z", None, 0)]
    assert tuple(kpis.practitioner_totals(star, True).head()) == (31, 1, 2)


def test_satisfaction_mean_and_label(star):
    assert tuple(kpis.satisfaction_by_region(star).head()) == ("84", "84", 2020, 80.0, 3)
    row = kpis.satisfaction_volume(star).head()
    assert (row.score_moyen, row.score_min, row.score_max, row.nb_mesures) == (80.025, 80.0, 80.05, 3)


def test_presented_order(star):
    assert [r.annee for r in kpis.presented(star, "deaths_by_region").collect()] == [2019]
    assert set(kpis.ORDER) <= set(dir(kpis))


def test_plans_have_no_python_and_no_cartesian_product(spark):
    from catalogue.queries import KPIS, registered

    for name in ["g01_consultations_detail", "g09_demographics", "g12_deaths_by_region", "f02_deaths_by_day_and_region"]:
        plan = registered()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "CartesianProduct" not in plan, name
    assert len(KPIS) > 30


def test_consultation_scan_reads_only_needed_columns(spark):
    from catalogue.queries import registered

    plan = registered()["g07_hospitalisations_by_quarter"](spark, "/root/testdata/sf0.001")
    text = plan._jdf.queryExecution().executedPlan().toString()
    scans = [part.split(">")[0] for part in text.split("ReadSchema: struct<")[1:]]
    assert not any("o_totalprice" in s or "l_quantity" in s for s in scans)


def test_every_query_has_its_sql():
    from catalogue.oracle_queries import ORACLES
    from catalogue.queries import REGISTRY

    assert set(REGISTRY) == set(ORACLES)


@pytest.fixture(scope="module")
def published(spark):
    """A mart of three years whose facts all have rows."""
    fact = {"consultation": "id_temps int, id_patient string, finess string, id_professionnel string, code_diag string,"
                            "duree_consultation int, nb_consultations int",
            "death": "id_temps int, id_geo int, nb_deces bigint",
            "satisfaction": "id_temps int, finess string, id_geo int, score_global double",
            "hospitalisation": "id_temps int, id_patient string, finess string, code_diag string, nb_hospitalisations int"}
    rows = {"consultation": lambda d: (d, "p", "1", "pr", "D", 5, 1), "death": lambda d: (d, 1, 2),
            "satisfaction": lambda d: (d, "1", 1, 80.0), "hospitalisation": lambda d: (d, "p", "1", "D", 1)}
    root, facts = new_folder(spark, "years"), {}
    for name, schema in fact.items():
        df = sinks.with_year(spark.createDataFrame([rows[name](y * 10000 + 115) for y in (2018, 2019, 2020)], schema))
        df.write.partitionBy("annee").parquet(f"{root}/{name}")
        facts[name] = spark.read.parquet(f"{root}/{name}")
    return kpis.Star(patient=spark.createDataFrame([("p", "F", 30)], "id_patient string, sexe string, age int"),
                     geography=spark.createDataFrame([(1, "84", "R", "F")], "id_geo int, code_region string, libelle_region string, pays string"),
                     establishment=spark.createDataFrame([("1", "E", 1)], "finess string, nom string, id_geo int"),
                     diagnosis=spark.createDataFrame([("D", "d")], "code_diag string, libelle string"),
                     practitioner=spark.createDataFrame([("pr", "n")], "id_professionnel string, nom string"), **facts)


@pytest.mark.parametrize("kpi", ["consultations_detail", "deaths_by_region", "satisfaction_by_region",
                                 "hospitalisations_by_quarter", "consultations_by_diagnosis", "consultations_volume",
                                 "hospitalisations_volume"])
def test_year_filters_prune_folders(published, kpi):
    filtered = getattr(kpis, kpi)(published).filter(F.col("annee") == 2019)
    plan = filtered._jdf.queryExecution().executedPlan().toString()
    assert "annee" in plan.split("PartitionFilters: [")[1].split("]")[0] and filtered.count() == 1


def test_unsound_stays_are_rejected(spark, sources, rows):
    stay = ("id_patient string, finess string, code_diag string, date_entree string, jours string")
    sources.hospitalisations = rows(stay, ("1", "1", "D1", "15-01-2018", "3"), ("nobody", "99999", "NODIAG", "15-01-2018", "1"),
                                    ("1", "1", None, None, None))
    run = mart.rebuild(spark, sources, new_folder(spark, "mart"), mart.EXTENDED)
    assert run.read("fait_hospitalisation").count() == 2
    assert values(run.read("rejects_fait_hospitalisation").select("finess", "reason")) == [("99999", "id_patient,finess,code_diag")]


def test_from_raw_files(spark, sources, tmp_path):
    files = {"deces.csv": "date,lieu_deces\n2019-01-01,69001\n,69001\n2019-01-02,99999\n2019-01-01,13001\n",
             "etab.csv": "finess;nom;code_region\n1;Un;84\n", "prof.csv": "identifiant;nom\n1;A\n",
             "enquete_2020.csv": "finess;region;score\n1;84;73,5\n1;84;\n"}
    from starmart.functions import fixed_values as fixed
    files["deces.csv"] = files["deces.csv"].replace("date,lieu_deces", f"{fixed.DEATH_ALIASES['date'][0]},{fixed.DEATH_ALIASES['place'][0]}")
    survey = fixed.SURVEY_ALIASES
    files["enquete_2020.csv"] = files["enquete_2020.csv"].replace(
        "finess;region;score", f"{survey['establishment'][0]};{survey['region_code'][0]};{survey['score'][0]}")
    paths = {name: str(tmp_path / name) for name in files}
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    raw = raw_to_mart.RawFeeds(consultations=sources.consultations, deaths=[paths["deces.csv"]],
                               surveys=[paths["enquete_2020.csv"]], establishments=[paths["etab.csv"]],
                               practitioner_files=[paths["prof.csv"]])
    run = raw_to_mart.run(spark, raw, str(tmp_path / "bronze"), str(tmp_path / "mart"))
    assert sum(r.nb_deces for r in run.read("fait_deces").collect()) == 2
    rejected = spark.read.option("header", True).csv(str(tmp_path / "bronze" / "rejects_deces"))
    assert sorted(r.reason for r in rejected.collect()) == ["date", "place"]
    assert run.read("fait_satisfaction").count() == 1
