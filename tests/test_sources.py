import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from conftest import values
from starmart.sources import delimited, feeds, relational


def write(path, text, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding, newline="") as f:
        f.write(text)
    return str(path)


def test_overlong_rows_skipped_short_rows_padded(spark, tmp_path):
    path = write(tmp_path / "raw" / "a.csv", "a;b;c\n1;2;3\n1;2;3;4\n1\n\"x;y\";é;\n", "latin1")
    df = delimited.read_delimited(spark, path, "ISO-8859-1")
    assert values(df) == [("1", "2", "3"), ("1", None, None), ("x;y", "é", None)]
    assert df.count() == 3


def test_landing_drops_blank_columns_of_every_file(spark, tmp_path):
    write(tmp_path / "raw" / "a.csv", "a;vide;b\n1; ;x\n2;;y\n", "latin1")
    write(tmp_path / "raw" / "b.csv", "k\tv\n1\té\n", "latin1")
    write(tmp_path / "raw" / "sub" / "c.csv", "z\n1\n")
    landed = delimited.land_folder(spark, str(tmp_path / "raw"), str(tmp_path / "bronze"))
    assert landed == {"a_raw.csv": ["a", "b"], "b_raw.csv": ["k", "v"]}
    assert values(delimited.read_delimited(spark, str(tmp_path / "bronze" / "b_raw.csv"))) == [
        ("1", "é")]


def test_first_alias_in_priority_order():
    headers = delimited.Headers(["Région", "Code Region", "FINESS_site"])
    assert headers.find(["finess", "finess_site"]) == "FINESS_site"
    assert headers.find(["code_region", "region"]) == "Code Region"
    assert headers.find(["nom"]) is None


def test_surveys_take_year_from_file_name(spark, tmp_path):
    a = write(tmp_path / "2018" / "enquete.csv",
              "finess;code_region;libelle_region;date;score\n0012;84;;;73,5\n;84;;;1\n5;;Occitanie;2021-03-04 x;2\n",
              "latin1")
    b = write(tmp_path / "2018" / "enquete_2020.csv",
              "FINESS_SITE,Region,tdacetbt\n7,Rhône-Alpes,80\n8,Nulle part,80\n9,Corse,\n", "latin1")
    found = values(feeds.survey_rows(feeds.read_surveys(spark, [a, b])))
    assert [(d, f, r, float(s)) for d, f, r, s in found] == [
        ("2020-01-01", "7", "84", 80.0), ("2021-03-04", "5", "76", 2.0),
        ("2024-01-01", "12", "84", 73.5)]


def test_deaths_keep_ten_character_dates_and_known_places(spark, tmp_path):
    path = write(tmp_path / "deces.csv",
                 "Nom,Date_Deces,Code lieu deces\nx,2019-00-00,69001\nx,2019-01,69001\n"
                 "x,,69001\nx,2020-05-06T1,97411\nx,2020-05-06,2A004\nx,2020-05-06,\n")
    found = values(feeds.death_rows(feeds.read_deaths(spark, [path])))
    assert found == [("2019-00-00", "UNKNOWN", "84", 1), ("2020-05-06", "UNKNOWN", "04", 1)]


def test_deaths_without_date_column_fail(spark, tmp_path):
    path = write(tmp_path / "d.csv", "a,b\n1,2\n")
    with pytest.raises(ValueError):
        feeds.read_deaths(spark, [path])


def test_establishments_fall_back_on_alternate_id_and_postal_code(spark, rows):
    raw = rows("id string, alternate_id string, name string, region string, postal string",
               ("0012", "9", " A ", "84", "75001"), (" ", "FR07", None, None, "33000"),
               ("abc", "9", "x", "84", None), (None, None, "x", "84", None),
               ("5", None, "B", " ", "x"))
    assert values(feeds.establishment_rows(raw)) == [
        ("12", "A", "84"), ("5", "B", ""), ("7", "", "33")]
    by_department = feeds.establishment_rows(raw, postal_as="department")
    assert values(by_department) == [("12", "A", "84"), ("5", "B", ""), ("7", "", "75")]


def test_practitioners_use_the_file_when_the_table_fails_or_is_empty(spark, rows, tmp_path):
    path = write(tmp_path / "p.csv", "Identifiant,Nom\n 7 ,A\n,B\n8,\n")
    missing = lambda: spark.table("no_such_table")
    empty = lambda: rows("id_professionnel string, nom string, prenom string")
    full = lambda: rows("id_professionnel string, nom string, prenom string", ("1", "A", None))
    for source in (missing, empty):
        assert values(feeds.practitioners(spark, source, [path])) == [("7", "A"), ("8", "")]
    assert values(feeds.practitioners(spark, full, [path])) == [("1", "A")]
    with pytest.raises(ValueError):
        feeds.practitioners(spark, missing, [])


def test_geography_falls_back_on_codes_of_the_facts(spark, rows):
    deaths, surveys = rows("code_region string", ("84",), ("84",)), rows("code_region string", ("32",), ("1",))
    unusable = rows("code string, label string, country string", ("x", "A", "F"))
    expected = [("32", "Region_32", "FRANCE"), ("84", "Region_84", "FRANCE")]
    for raw in (None, unusable):
        assert values(feeds.geography(raw, deaths, surveys)) == expected
    usable = rows("code string, label string, country string", ("R84", " A ", None), ("93", None, "X"))
    assert values(feeds.geography(usable, deaths, surveys)) == [
        ("84", "A", "FRANCE"), ("93", "Region_93", "X")]


def test_consultation_view_and_scan(spark, rows):
    raw = rows("Num_consultation int, Id_patient int, Date string, Code_diag string, Id_prof_sante int",
               (1, 10, "2020-01-01", "D1", 5), (2, 11, "2021-01-01", None, 6))
    room = rows("Id_salle int, Num_consultation int", (99, 1))
    view = relational.consultation_view(raw, room)
    assert [r.id_etablissement for r in view.orderBy("id_consultation").collect()] == ["99", "6"]
    patient = rows("id_patient string, sexe string, age int", ("10", "F", 45))
    scan = relational.consultations(view, patient, newest_first=True).collect()
    assert [(r.id_consultation, r.sexe, r.age) for r in scan] == [("2", None, None), ("1", "F", 45)]
    assert relational.consultations(view, patient, "p.age > 40").count() == 1


def test_source_name_check():
    assert relational.table_reference(" consultation ") == "operational.consultation"
    for bad in ("a.b.c", "x;drop", "1a"):
        with pytest.raises(ValueError):
            relational.table_reference(bad)


def test_quoted_line_breaks_and_doubled_headers(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "a.csv").write_text('finess;finess;nom\n1;2;"x\ny"\n3;4;z\n', "latin-1")
    delimited.land_folder(spark, str(tmp_path / "raw"), str(tmp_path / "bronze"))
    landed = delimited.read_delimited(spark, str(tmp_path / "bronze" / "a_raw.csv"), multi_line=True)
    assert values(landed) == [("1", "2", "x\ny"), ("3", "4", "z")]
    found = delimited.read_layouts(spark, [str(tmp_path / "raw" / "a.csv")], {"id": ["finess"], "name": ["nom"]},
                                   multi_line=True)
    assert values(found) == [("1", "x\ny"), ("3", "z")]


def test_headers_need_no_job(spark, tmp_path):
    for k in range(5):
        (tmp_path / f"{k}.csv").write_text("date,lieu\n2019-01-01,75\n" if k else "lieu,date\n75,2019-01-01\n")
    spark.sparkContext.setJobGroup("headers", "headers")
    feeds.read_deaths(spark, [str(tmp_path / f"{k}.csv") for k in range(5)])
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("headers")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not jobs


def test_practitioners_without_a_working_source(spark, tmp_path):
    for k in range(2):
        (tmp_path / f"{k}.csv").write_text(f"identifiant;nom\n{k};n{k}\n")
    names = [str(tmp_path / f"{k}.csv") for k in range(2)]
    broken = lambda: relational.jdbc_table(spark, "jdbc:nothing:none", "t", properties={"driver": "no.such.Driver"})
    assert len(values(feeds.practitioners(spark, broken, names))) == 2
    with pytest.raises(AnalysisException):
        feeds.practitioners(spark, lambda: spark.range(1).select("no_such_column"), names)
