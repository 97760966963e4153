"""The registered queries, one per inventory row; names start with the row's id."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.functions import fixed_values as fixed
from starmart.functions import rules
from starmart.functions.numbers import half_up_tenth
from starmart.operators import dimensions as dims
from starmart.operators import correspondence, facts, keyed, lookups, quality, sinks, staging
from starmart.operators.ids import dense_ids
from starmart.plans import kpis
from starmart.plans import rebuild as mart
from starmart.session import empty_table, new_folder, stored
from starmart.sources import delimited, feeds, relational

from catalogue.adapters import Tables
from catalogue.contents import GOLD_COLUMNS

PSEUDONYM_KEY = b"starmart demonstration key"

REGISTRY: dict[str, Callable[[Tables], DataFrame]] = {}


def query(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    REGISTRY[fn.__name__] = fn
    return fn


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn):
        return lambda spark, sf_dir: fn(Tables(spark, sf_dir))
    return {name: bind(fn) for name, fn in REGISTRY.items()}


def _counted(df: DataFrame) -> DataFrame:
    """Each different row with how often it occurs."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("n"))


# --- A: sources and sinks ---------------------------------------------------------------------

@query
def a01_consultation_scan(t: Tables) -> DataFrame:
    return relational.consultations(t.consultation(), t.patient(),
                                    "c.date_consultation >= DATE'1998-01-01'")


@query
def a02_consultation_view(t: Tables) -> DataFrame:
    return relational.consultation_view(t.raw_consultation(), t.raw_room())


@query
def a03_patient_view(t: Tables) -> DataFrame:
    return relational.patient_view(t.raw_patient())


@query
def a03_diagnosis_view(t: Tables) -> DataFrame:
    return relational.diagnosis_view(t.table("part").select(
        F.col("p_partkey").alias("Code_diag"), F.col("p_name").alias("Diagnostic")))


@query
def a03_practitioner_view(t: Tables) -> DataFrame:
    return relational.practitioner_view(t.raw_practitioner())


@query
def a03_room_view(t: Tables) -> DataFrame:
    return relational.room_view(t.raw_room())


@query
def a03_insurer_view(t: Tables) -> DataFrame:
    return relational.insurer_view(t.table("supplier").select(
        F.col("s_suppkey").cast("string").alias("Id_Mut"), F.col("s_name").alias("Nom"),
        F.col("s_nationkey").cast("string").alias("Adresse")))


def _write_lines(df: DataFrame, header: str, path: str, encoding: str = "UTF-8") -> None:
    """Write ready-made lines under a header line, so that they may be irregular."""
    (df.select(F.col(df.columns[0]).alias(header)).write.option("header", True)
     .option("sep", "\x01").option("quote", "\x02").option("encoding", encoding)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def _lines(df: DataFrame, *columns) -> DataFrame:
    """NULL becomes an empty field."""
    return df.select(F.concat_ws(";", *[F.coalesce(c, F.lit("")) for c in columns]).alias("line"))


@query
def a04_landing_clean(t: Tables) -> DataFrame:
    """Latin-1 lines with an all-blank column, short rows and over-long rows."""
    raw, bronze = new_folder(t.spark, "raw"), new_folder(t.spark, "bronze")
    line = F.expr("concat_ws(';', c_custkey, concat('Société ', c_name), ' ', c_mktsegment, "
                  "CASE WHEN c_nationkey = 5 THEN '\"a;b\"' ELSE 'x' END)")
    line = (F.when(F.col("c_nationkey") == 7, F.concat(line, F.lit(";extra;more")))
            .when(F.col("c_nationkey") == 3, F.expr("concat(c_custkey, ';seul')"))
            .otherwise(line))
    _write_lines(t.table("customer").select(line.alias("line")), "id;nom;vide;segment;note",
                 f"{raw}/clients.csv", "ISO-8859-1")
    delimited.land_folder(t.spark, raw, bronze)
    return delimited.read_delimited(t.spark, f"{bronze}/clients_raw.csv")


def _establishment_files(t: Tables) -> list[str]:
    """Two files with different headers, each with every establishment."""
    folder, rows = new_folder(t.spark, "raw"), t.establishment_text()
    _write_lines(_lines(rows, F.col("id"), F.col("name"), F.col("region"), F.lit("z")),
                 "FINESS;Nom Etablissement;Region;autre", f"{folder}/etablissements_a.csv")
    _write_lines(_lines(rows, F.col("postal"), F.col("alternate_id"), F.col("name")),
                 "code_postal;finess_site;raison_sociale", f"{folder}/etablissements_b.csv")
    return delimited.list_csv(t.spark, folder)


@query
def a06_multi_layout_reader(t: Tables) -> DataFrame:
    return feeds.read_establishments(t.spark, _establishment_files(t))


@query
def a07_deaths_pruned_scan(t: Tables) -> DataFrame:
    path = f"{new_folder(t.spark, 'raw')}/deces.csv"
    raw = t.death_text()
    delimited.write_bronze(raw.select(
        F.lit("x").alias("nom"), F.col("date").alias("Date_Deces"), F.lit("y").alias("prenom"),
        F.col("place").alias("code lieu deces")), path)
    return _counted(feeds.read_deaths(t.spark, [path]).select("date", "place"))


@query
def a08_survey_scan(t: Tables) -> DataFrame:
    """Two Latin-1 layouts; the year of the second is in its file name."""
    folder, rows = new_folder(t.spark, "raw"), t.survey_text()
    undated = F.col("file_name") == "enquete.csv"
    _write_lines(_lines(rows.filter(undated), F.col("establishment"), F.col("region_code"),
                        F.col("region_name"), F.col("date"), F.col("score")),
                 "finess;code_region;libelle_region;date_satisfaction;score_global",
                 f"{folder}/enquete.csv", "ISO-8859-1")
    _write_lines(_lines(rows.filter(~undated), F.col("score"), F.col("region_name"),
                        F.col("establishment"), F.col("region_code")),
                 "tdacetbt;Region;finess_site;CODE REGION", f"{folder}/enquete_2020_hebdo.csv",
                 "ISO-8859-1")
    raw = feeds.read_surveys(t.spark, delimited.list_csv(t.spark, folder))
    return _counted(feeds.survey_rows(raw))


@query
def a09_establishment_scan(t: Tables) -> DataFrame:
    files = _establishment_files(t)
    return _counted(feeds.establishment_rows(feeds.read_establishments(t.spark, files)))


@query
def a10_practitioner_fallback(t: Tables) -> DataFrame:
    """The relational source is missing, so the file is read."""
    path = f"{new_folder(t.spark, 'raw')}/professionnels.csv"
    rows = t.practitioner_source()
    delimited.write_bronze(rows.select(F.col("id_professionnel").alias("Identifiant"),
                                       F.col("nom").alias("NOM")), path)
    return feeds.practitioners(t.spark, lambda: t.spark.table("absent_practitioner_table"), [path])


@query
def a10_practitioner_source(t: Tables) -> DataFrame:
    return feeds.practitioners(t.spark, t.practitioner_source, [])


@query
def a11_geography_file(t: Tables) -> DataFrame:
    return feeds.geography(t.geography_text(), t.bronze_deaths(), t.bronze_surveys())


@query
def a11_geography_fallback(t: Tables) -> DataFrame:
    return feeds.geography(None, t.bronze_deaths(), t.bronze_surveys())


@query
def a13_bronze_writer(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "bronze") + "/satisfaction_raw.csv"
    delimited.write_bronze(t.bronze_surveys(), path)
    return _counted(delimited.read_delimited(t.spark, path))


@query
def a14_staging_consultations(t: Tables) -> DataFrame:
    return staging.load_consultations(t.consultation_text()).accepted


@query
def a14_staging_rejects(t: Tables) -> DataFrame:
    rejected = staging.load_consultations(t.consultation_text()).rejected
    return rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query
def a15_staging_geography(t: Tables) -> DataFrame:
    return staging.load_geography(t.bronze_geography(),
                                  ["code_region", "libelle_region", "pays"]).accepted


@query
def a16_staging_satisfaction(t: Tables) -> DataFrame:
    return staging.load_satisfaction(t.bronze_surveys()).accepted


@query
def a17_staging_establishments(t: Tables) -> DataFrame:
    return staging.load_establishments(t.bronze_establishments()).accepted


@query
def a17_staging_practitioners(t: Tables) -> DataFrame:
    return staging.load_practitioners(t.bronze_practitioners()).accepted


@query
def a18_full_reload(t: Tables) -> DataFrame:
    """Loading twice leaves one copy; the second load may read what it replaces."""
    path = new_folder(t.spark, "staging")
    sinks.insert_overwrite(t.staged_deaths(), path)
    sinks.insert_overwrite(sinks.read_table(t.spark, path), path)
    return sinks.read_table(t.spark, path)


def _gold(t: Tables) -> dict[str, DataFrame]:
    star = t.star()
    return {"dim_temps": t.dim_calendar(), "dim_patient": star.patient,
            "dim_geographie": star.geography, "dim_etablissement": star.establishment,
            "dim_diagnostic": star.diagnosis, "dim_professionnel": star.practitioner,
            "fait_consultation": star.consultation, "fait_deces": star.death,
            "fait_satisfaction": star.satisfaction}


def _staged(t: Tables) -> dict[str, DataFrame]:
    return {"stg_consultations_raw": t.consultation(), "stg_geographie_raw": t.staged_geography(),
            "stg_deces_raw": t.staged_deaths(), "stg_satisfaction_raw": t.staged_surveys(),
            "stg_etablissements_raw": staging.load_establishments(t.bronze_establishments()).accepted,
            "stg_professionnels_raw": staging.load_practitioners(t.bronze_practitioners()).accepted}


@query
def a19_gold_export(t: Tables) -> DataFrame:
    """Rows and contents read back from each exported folder."""
    folder, gold = new_folder(t.spark, "export"), _gold(t.settle())
    names = sinks.export_csv(gold, folder)
    return _contents({n: sinks.read_export(t.spark, folder, n, gold[n].schema) for n in names})


def _contents(tables: dict[str, DataFrame]) -> DataFrame:
    return quality.union_all([quality.fingerprint(df, name, GOLD_COLUMNS[name]) for name, df in tables.items()])


def _text_tables(t: Tables, prefix: str) -> dict[str, DataFrame]:
    """The exported dimensions as external text tables."""
    folder, gold = new_folder(t.spark, "export"), _gold(t)
    dimensions = {n: gold[n] for n in sinks.TEXT_DIMENSIONS}
    sinks.export_csv(dimensions, folder)
    return {n: sinks.external_text_table(t.spark, f"{prefix}_{n}", df.schema, f"{folder}/{n}")
            for n, df in dimensions.items()}


@query
def a20_text_table_contents(t: Tables) -> DataFrame:
    """Rows and contents of all five text tables."""
    return _contents(_text_tables(t, "whole_text"))


@query
def a20_external_text_tables(t: Tables) -> DataFrame:
    """Establishments with their region, both read through external text tables."""
    read = _text_tables(t, "text")
    return (read["dim_etablissement"].join(read["dim_geographie"], "id_geo", "left")
            .select("finess", "nom", "id_geo", "code_region", "pays"))


@query
def a21_orc_year_partitions(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "orc")
    fact = sinks.with_year(t.fact_consultation())
    sinks.write_orc(fact, path, "annee")
    table = sinks.external_orc_table(t.spark, "orc_fait_consultation", fact.schema, path, "annee")
    return (table.filter(F.col("annee") >= 1998).groupBy("annee")
            .agg(F.sum("nb_consultations").alias("nb_consultations"),
                 F.sum("duree_consultation").alias("duree_totale")))


@query
def a23_insert_overwrite(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "parquet")
    sinks.insert_overwrite(t.fact_stays(count_days=True), path)
    return _counted(sinks.read_table(t.spark, path))


# --- B: projections, filters, rejections ------------------------------------------------------

@query
def b01_deaths_rejection(t: Tables) -> DataFrame:
    return t.bronze_deaths().select("date_deces", "code_region")


@query
def b02_satisfaction_rejection(t: Tables) -> DataFrame:
    return t.bronze_surveys()


@query
def b01_death_rejects(t: Tables) -> DataFrame:
    return feeds.death_rejects(t.death_text()).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query
def b02_survey_rejects(t: Tables) -> DataFrame:
    return feeds.survey_rejects(t.survey_text()).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query
def t05_rows_accounted(t: Tables) -> DataFrame:
    """Raw rows of deaths and surveys are those of the bronze copies and of the rejects."""
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("rows"), "n")
    return quality.union_all([
        count(t.death_text(), "deaths raw"), count(t.bronze_deaths().unionByName(
            feeds.death_rejects(t.death_text()), allowMissingColumns=True), "deaths kept or rejected"),
        count(t.survey_text(), "surveys raw"), count(t.bronze_surveys().unionByName(
            feeds.survey_rejects(t.survey_text()), allowMissingColumns=True), "surveys kept or rejected")])


@query
def b03_establishment_rejection(t: Tables) -> DataFrame:
    return t.bronze_establishments()


@query
def b04_practitioner_rejection(t: Tables) -> DataFrame:
    return t.bronze_practitioners()


@query
def b05_blank_key_rejection(t: Tables) -> DataFrame:
    return t.practitioner_source().filter(rules.not_blank(F.col("id_professionnel")))


@query
def b07_kpi_filters(t: Tables) -> DataFrame:
    """A year of a KPI and a non-null diagnosis, both as plain filters."""
    return kpis.hospitalisations_by_diagnosis(t.star()).filter(F.col("annee") == 1998)


@query
def b08_privacy_projection(t: Tables) -> DataFrame:
    allowed = t.patient_file().select("id_patient", "sexe", "age")
    assert not quality.denied_columns(allowed, fixed.DENIED_COLUMNS)
    return allowed


# --- C: conforming rules ----------------------------------------------------------------------

@query
def c01_establishment_id(t: Tables) -> DataFrame:
    raw = _counted(t.consultation().select("id_etablissement"))
    return raw.withColumn("finess", rules.establishment_id(F.col("id_etablissement")))


@query
def c02_establishment_id_from_file(t: Tables) -> DataFrame:
    raw = t.establishment_text().select("id", "alternate_id")
    return raw.select(
        "id", "alternate_id", rules.establishment_id_from_file(F.col("id")).alias("finess"),
        rules.establishment_id_from_file(F.col("alternate_id"), True).alias("finess_zero"))


@query
def c03_department_region(t: Tables) -> DataFrame:
    return _counted(lookups.add_region_of_place(t.death_text().select("place"), "place"))


@query
def c04_region_name(t: Tables) -> DataFrame:
    names = _counted(t.survey_text().select("region_name"))
    return lookups.add_region_of_name(names, F.col("region_name"), "code_region")


@query
def c05_region_priority(t: Tables) -> DataFrame:
    pairs = _counted(t.survey_text().select(F.col("region_code").alias("raw_code"), "region_name"))
    return lookups.add_region_code(pairs, "raw_code", "region_name")


@query
def c06_two_digit_code(t: Tables) -> DataFrame:
    raw = t.establishment_text().select("region", "postal")
    return raw.select("region", "postal", rules.two_digit_code(F.col("region")).alias("region2"),
                      rules.two_digit_code(F.col("postal")).alias("postal2"))


@query
def c07_decimal_comma(t: Tables) -> DataFrame:
    return _counted(t.survey_text().select(
        F.col("score").alias("raw"), rules.decimal_comma(F.col("score")).alias("score")))


@query
def c08_date_cut(t: Tables) -> DataFrame:
    return _counted(t.death_text().select(F.col("date").alias("raw"),
                                          rules.text_date(F.col("date")).alias("day")))


@query
def c09_calendar_attributes(t: Tables) -> DataFrame:
    days = t.consultation().select("date_consultation").distinct()
    return days.select(*rules.calendar_columns(F.col("date_consultation")))


@query
def c10_blank_default(t: Tables) -> DataFrame:
    raw = _counted(t.consultation().select("diagnostic"))
    return raw.withColumn("code_diag", rules.blank_default(F.col("diagnostic"),
                                                           fixed.UNKNOWN_DIAGNOSIS))


@query
def c11_full_name(t: Tables) -> DataFrame:
    return t.practitioner_source().select(
        "nom", "prenom", rules.full_name(F.col("nom"), F.col("prenom")).alias("nom_complet"))


@query
def c12_sex_code(t: Tables) -> DataFrame:
    return t.patient_file().select("id_patient", F.col("sexe").alias("raw"),
                                   rules.sex_code(F.col("sexe")).alias("sexe"))


@query
def c13_blank_safe_integer(t: Tables) -> DataFrame:
    return t.patient_file().select("id_patient", F.col("age").alias("raw"),
                                   rules.blank_safe_int(F.col("age")).alias("age"))


@query
def c14_age_band(t: Tables) -> DataFrame:
    return t.patient().select("id_patient", "age",
                              rules.age_band(F.col("age")).alias("tranche_age"))


@query
def c15_prefix_mask(t: Tables) -> DataFrame:
    return t.patient().select(rules.prefix_mask(F.col("id_patient")).alias("id_masque"), "age")


@query
def c16_keyed_pseudonym(t: Tables) -> DataFrame:
    return t.patient().select(
        rules.keyed_pseudonym(F.col("id_patient"), PSEUDONYM_KEY).alias("pseudonyme"), "sexe")


@query
def c17_display_labels(t: Tables) -> DataFrame:
    places = t.dim_establishment().join(F.broadcast(t.dim_geography()), "id_geo", "left")
    return places.select(
        "finess", rules.establishment_label(F.col("nom"), F.col("finess")).alias("etablissement"),
        rules.region_label(F.col("libelle_region")).alias("region"),
        F.coalesce("libelle_region", "code_region").alias("region_ou_code"))


# --- D: dimensions ----------------------------------------------------------------------------

@query
def d01_calendar(t: Tables) -> DataFrame:
    return dims.calendar(t.consultation(), "date_consultation")


@query
def d02_calendar_upsert(t: Tables) -> DataFrame:
    return t.dim_calendar()


@query
def d03_patients(t: Tables) -> DataFrame:
    return dims.patients(t.consultations())


@query
def d04_establishment_seed(t: Tables) -> DataFrame:
    return dims.establishments_of_consultations(t.consultation())


@query
def d05_diagnoses(t: Tables) -> DataFrame:
    return t.dim_diagnosis()


def _current_geography(t: Tables) -> DataFrame:
    """Regions found in the facts, as a dimension that an earlier run left."""
    found = feeds.geography_from_facts(t.bronze_deaths(), t.bronze_surveys()).select(
        F.col("code_region").alias("code_region_src"),
        F.col("libelle_region").alias("libelle_region_src"), F.col("pays").alias("pays_src"))
    empty = empty_table(t.spark, dims.GEOGRAPHY_SCHEMA)
    return dims.merge_geography(empty, found)


@query
def d06_geography_insert(t: Tables) -> DataFrame:
    return dims.add_new_regions(_current_geography(t), dims.staged_regions(t.staged_geography()))


@query
def d07_geography_change_update(t: Tables) -> DataFrame:
    return dims.update_regions(_current_geography(t), dims.staged_regions(t.staged_geography()))


@query
def d08_establishment_update(t: Tables) -> DataFrame:
    seeds = dims.establishments_of_consultations(t.consultation())
    incoming = dims.staged_establishments(t.bronze_establishments(), t.dim_geography())
    return dims.update_establishments(seeds, incoming)


@query
def d09_establishment_insert(t: Tables) -> DataFrame:
    seeds = dims.establishments_of_consultations(t.consultation())
    incoming = dims.staged_establishments(t.bronze_establishments(), t.dim_geography())
    return dims.insert_establishments(seeds, incoming)


@query
def d10_establishment_survey_upsert(t: Tables) -> DataFrame:
    return t.dim_establishment()


@query
def d11_practitioner_upsert(t: Tables) -> DataFrame:
    """Every second id is known already under another name."""
    current = t.table("part").select(F.expr("string(p_partkey * 2)").alias("id_professionnel"),
                                     F.col("p_type").alias("nom"))
    return dims.merge_practitioners(current, t.bronze_practitioners())


@query
def d12_patient_upsert(t: Tables) -> DataFrame:
    return dims.merge_patients(t.patient(), t.patient_file())


# --- F: facts ---------------------------------------------------------------------------------

@query
def f01_consultation_fact(t: Tables) -> DataFrame:
    fact = facts.consultation_fact(t.consultation())
    return fact.select("id_temps", "id_patient", "finess", "id_professionnel", "code_diag",
                       "duree_consultation", "nb_consultations")


@query
def f02_deaths_by_day_and_region(t: Tables) -> DataFrame:
    return facts.deaths_by_day_and_region(t.bronze_deaths())


@query
def f03_deaths_fact(t: Tables) -> DataFrame:
    return t.fact_deaths()


@query
def f04_satisfaction_fact(t: Tables) -> DataFrame:
    return t.fact_satisfaction()


@query
def f05_hospitalisation_fact(t: Tables) -> DataFrame:
    return t.fact_stays()


@query
def f05_hospitalisation_days(t: Tables) -> DataFrame:
    return t.fact_stays(count_days=True)


@query
def f06_dense_ids(t: Tables) -> DataFrame:
    fact = t.fact_consultation().drop("duree_consultation", "id_professionnel")
    return dense_ids(fact, ["id_temps", "id_patient", "finess", "code_diag"],
                     "id_fait_consultation", is_plain_scan=True)


def mart_sources(t: Tables) -> mart.Sources:
    return mart.Sources(
        consultations=t.consultations().withColumn("date_consultation",
                                                   F.col("date_consultation").cast("string"))
        .withColumn("age", F.col("age").cast("string"))
        .withColumn("montant", F.col("montant").cast("string")),
        deaths=t.bronze_deaths(), surveys=t.bronze_surveys(),
        establishments=t.bronze_establishments(), practitioners=t.bronze_practitioners(),
        geography=t.bronze_geography(), hospitalisations=t.stay_text())


_REBUILT = ["dim_temps", "dim_patient", "dim_geographie", "dim_etablissement", "dim_diagnostic",
            "dim_professionnel", "fait_consultation", "fait_deces", "fait_satisfaction",
            "fait_hospitalisation"]


def _rebuilt(t: Tables, modes: list[str]) -> DataFrame:
    root = new_folder(t.spark, "mart")
    for mode in modes:
        mart.rebuild(t.spark, mart_sources(t), root, mode)
    run = mart.published_run(t.spark, root)
    return _contents({name: run.read(name) for name in _REBUILT})


@query
def f07_rebuild_extended(t: Tables) -> DataFrame:
    """Rows and contents of every table of the published run."""
    return _rebuilt(t, [mart.EXTENDED])


@query
def f07_rebuild_standard_after_extended(t: Tables) -> DataFrame:
    """A standard run empties the other facts and keeps geography and practitioners."""
    return _rebuilt(t, [mart.EXTENDED, mart.STANDARD])


def _refreshed(t: Tables) -> mart.Run:
    """A run on sources with two wrong years, then a refresh: consultations of 1994 and deaths of 1995 came twice."""
    root, sources = new_folder(t.spark, "mart"), mart_sources(t)
    again = lambda df, day, year: df.unionByName(df.where(F.col(day).startswith(year)))
    wrong = replace(sources, consultations=again(sources.consultations, "date_consultation", "1994"),
                    deaths=again(sources.deaths, "date_deces", "1995"))
    mart.rebuild(t.spark, wrong, root, mart.EXTENDED)
    return mart.rebuild(t.spark, sources, root, mart.EXTENDED, changed_years_only=True)


@query
def f07_refresh_changed_years(t: Tables) -> DataFrame:
    """A refresh leaves the contents of a full rebuild in every table."""
    run = _refreshed(t)
    return _contents({name: run.read(name) for name in _REBUILT})


@query
def f07_refreshed_years(t: Tables) -> DataFrame:
    """Rows of each year of each fact, 0 for no day, and whether the refresh wrote them."""
    run = _refreshed(t)
    return run.years().select("fait", F.coalesce("annee", F.lit(0)).alias("annee"), "nb_lignes", (F.col("run_id") == run.run_id).alias("reecrite"))


@query
def f09_orphan_tolerant_attach(t: Tables) -> DataFrame:
    fact = facts.attach_diagnosis(t.fact_stays(), t.dim_diagnosis())
    return fact.groupBy("code_diag", "libelle").agg(
        F.sum("nb_hospitalisations").cast("bigint").alias("nb_hospitalisations"))


# --- G: KPIs ----------------------------------------------------------------------------------

KPIS = {
    "g01_consultations_detail": kpis.consultations_detail,
    "g02_deaths_by_day": kpis.deaths_by_day,
    "g03_satisfaction_by_day": kpis.satisfaction_by_day,
    "g04_hospitalisations_detail": kpis.hospitalisations_detail,
    "g05_consultations_by_establishment": kpis.consultations_by_establishment,
    "g06_consultations_by_diagnosis": kpis.consultations_by_diagnosis,
    "g07_hospitalisations_by_quarter": kpis.hospitalisations_by_quarter,
    "g08_hospitalisations_by_diagnosis": kpis.hospitalisations_by_diagnosis,
    "g09_demographics": kpis.demographics,
    "g10_consultations_by_practitioner": kpis.consultations_by_practitioner,
    "g11_practitioner_totals": kpis.practitioner_totals,
    "g12_deaths_by_region": kpis.deaths_by_region,
    "g13_satisfaction_by_region": kpis.satisfaction_by_region,
    "g14_consultations_volume": kpis.consultations_volume,
    "g15_deaths_volume": kpis.deaths_volume,
    "g16_satisfaction_volume": kpis.satisfaction_volume,
    "g17_hospitalisations_volume": kpis.hospitalisations_volume,
    "g18_top_establishments": kpis.top_establishments,
    "g19_top_diagnosis_series": kpis.top_diagnosis_series,
    "g20_hospitalisations_by_year": kpis.hospitalisations_by_year,
    "g20_top_hospitalisation_diagnoses": kpis.top_hospitalisation_diagnoses,
    "g21_sex_age_totals": kpis.sex_age_totals,
    "g22_practitioner_count": kpis.practitioner_count,
    # deaths of the driver's tables run from 1995 to 2001
    "g23_deaths_of_year": lambda star: kpis.deaths_of_year(star, 2000),
    "g24_satisfaction_of_year": kpis.satisfaction_of_year,
    "g25_top_establishments_by_year": kpis.top_establishments_by_year,
    "g26_top_diagnoses_by_year": kpis.top_diagnoses_by_year,
    "g27_consultation_measures": kpis.consultation_measures,
    "g27_death_measure": kpis.death_measure,
    "g27_satisfaction_measures": kpis.satisfaction_measures,
    "g28_drill_consultations_deaths": kpis.drill_consultations_deaths,
    "g28_drill_consultations_satisfaction": kpis.drill_consultations_satisfaction,
    "g28_drill_satisfaction_deaths": kpis.drill_satisfaction_deaths,
    "t12_practitioner_totals_distinct":
        lambda star: kpis.practitioner_totals(star, extra_distinct=True),
}

for _name, _kpi in KPIS.items():
    REGISTRY[_name] = (lambda kpi: lambda t: kpi(t.star()))(_kpi)


@query
def t22_establishment_correspondence(t: Tables) -> DataFrame:
    """The official id of each internal one, or why it can't be told."""
    return correspondence.resolve(t.correspondence_text())


@query
def t22_consultations_by_official_id(t: Tables) -> DataFrame:
    """Consultations by establishment with their ids resolved: named ones where the register knows them."""
    resolved = correspondence.resolve(t.correspondence_text())
    rows = correspondence.official_ids(t.consultation(), resolved, "id_etablissement")
    fact = facts.consultation_fact(rows)
    names = t.dim_establishment().select("finess", "nom")
    return (fact.groupBy("finess").agg(F.sum("nb_consultations").cast("bigint").alias("nb_consultations"))
            .join(names, "finess", "left").select("finess", "nom", "nb_consultations"))


@query
def t01_exact_rounding(t: Tables) -> DataFrame:
    """Mean account balance in cents per nation, rounded half away from zero, with negatives."""
    cents = F.round(F.col("c_acctbal") * 100).cast("bigint")
    return (t.table("customer").groupBy("c_nationkey")
            .agg(half_up_tenth(F.sum(cents), F.count(cents)).alias("moyenne")))


# --- H: quality -------------------------------------------------------------------------------

@query
def h01_minimum_rows(t: Tables) -> DataFrame:
    """All staging and gold tables that a rebuild checks."""
    return quality.minimum_rows({**_staged(t), **_gold(t)})


@query
def h02_null_columns(t: Tables) -> DataFrame:
    return quality.null_columns(t.consultation_text(), "consultations",
                                ["id_patient", "date_consultation", "diagnostic",
                                 "id_etablissement", "age"])


@query
def h03_key_uniqueness(t: Tables) -> DataFrame:
    """Every primary key of the mart, and two tables of sources that repeat keys."""
    gold = _gold(t)
    return quality.union_all([
        quality.duplicate_keys(t.table("lineitem"), "lineitem", ["l_orderkey", "l_linenumber"]),
        quality.duplicate_keys(t.bronze_practitioners(), "professionnels", ["id_prof_source"]),
        *[quality.duplicate_keys(gold[name], name, [key]) for name, key in mart.PRIMARY_KEYS.items()]])


@query
def h03_collapsed_keys(t: Tables) -> DataFrame:
    return keyed.collapsed_keys(t.bronze_practitioners(), ["id_prof_source"])


@query
def h04_domain_rules(t: Tables) -> DataFrame:
    return quality.rule_violations(t.table("orders"), "orders", {
        "status": ~F.col("o_orderstatus").isin("O", "F"),
        "price": F.col("o_totalprice").isNull() | (F.col("o_totalprice") < 1000)})


@query
def h04_not_null_and_status(t: Tables) -> DataFrame:
    """Every NOT NULL of the mart's tables, and the status of logged runs."""
    root, tables = new_folder(t.spark, "mart"), {**_gold(t.settle()), "fait_hospitalisation": t.fact_stays()}
    mart.rebuild(t.spark, mart_sources(t), root, mart.STANDARD)
    log = t.spark.read.schema(quality.RUN_LOG_SCHEMA).parquet(f"{root}/audit/etl_run_log")
    status = quality.rule_violations(log, "etl_run_log", {
        "status": F.col("status").isNull() | ~F.col("status").isin(quality.RUN_STATUS)})
    return quality.union_all([status] + [
        quality.soundness(tables[name], name, quality.Rules(not_null=tuple(columns)))
        for name, columns in mart.NOT_NULL.items()])


@query
def h05_checks_in_one_scan(t: Tables) -> DataFrame:
    """Rows, keys, NULLs and foreign keys of the mart's tables, each table scanned once."""
    tables = {name: stored(df) for name, df in {**_gold(t.settle()), "fait_hospitalisation": t.fact_stays()}.items()}
    return quality.union_all([quality.soundness(table, name, quality.Rules(
        minimum=1, unique=(mart.PRIMARY_KEYS[name],) if name in mart.PRIMARY_KEYS else (),
        not_null=tuple(mart.NOT_NULL.get(name, ())),
        foreign={column: (tables[dimension], mart.PRIMARY_KEYS[dimension])
                 for column, dimension in mart.FOREIGN_KEYS.get(name, {}).items()})) for name, table in tables.items()])


@query
def h05_referential_integrity(t: Tables) -> DataFrame:
    """Every foreign key of the mart. Tables are written once; each key then reads its own column."""
    tables = {name: stored(df) for name, df in {**_gold(t.settle()), "fait_hospitalisation": t.fact_stays()}.items()}
    return quality.union_all([
        quality.orphans(tables[name], name, column, tables[dimension], mart.PRIMARY_KEYS[dimension])
        for name, keys in mart.FOREIGN_KEYS.items() for column, dimension in keys.items()])


@query
def h06_run_log(t: Tables) -> DataFrame:
    """Two rebuilds leave two log rows with rows read and written."""
    root = new_folder(t.spark, "mart")
    for _ in range(2):
        mart.rebuild(t.spark, mart_sources(t), root, mart.STANDARD)
    log = t.spark.read.schema(quality.RUN_LOG_SCHEMA).parquet(f"{root}/audit/etl_run_log")
    return log.select("job_name", "status", "rows_read", "rows_written")


@query
def h06_flow_log(t: Tables) -> DataFrame:
    """An extended rebuild logs the rows of each of its six flows."""
    root = new_folder(t.spark, "mart")
    mart.rebuild(t.spark, mart_sources(t), root, mart.EXTENDED)
    return (t.spark.read.schema(quality.FLOW_LOG_SCHEMA).parquet(f"{root}/audit/etl_flow_log")
            .select("flow", "rows_read", "rows_written"))


@query
def h07_quality_log(t: Tables) -> DataFrame:
    root = new_folder(t.spark, "mart")
    mart.rebuild(t.spark, mart_sources(t), root, mart.EXTENDED)
    log = t.spark.read.parquet(f"{root}/audit/data_quality_log")
    return log.select("check_name", "table_name", "metric_name", "metric_value", "threshold_value", "passed")


@query
def h08_row_inventory(t: Tables) -> DataFrame:
    return quality.row_counts(_gold(t))


@query
def h09_volume_report_of_a_run(t: Tables) -> DataFrame:
    """The six flows of a rebuild, from its logs."""
    root = new_folder(t.spark, "mart")
    mart.rebuild(t.spark, mart_sources(t), root, mart.EXTENDED)
    return mart.volume_report(t.spark, root)


@query
def h09_volume_report(t: Tables) -> DataFrame:
    tables = {
        ("bronze", "consultations"): t.consultation_text(),
        ("staging", "consultations"): staging.load_consultations(t.consultation_text()).accepted,
        ("gold", "consultations"): facts.consultation_fact(
            staging.load_consultations(t.consultation_text()).accepted),
        ("bronze", "deces"): t.bronze_deaths(), ("staging", "deces"): t.staged_deaths(),
        ("gold", "deces"): t.fact_deaths(),
        ("bronze", "satisfaction"): t.bronze_surveys(),
        ("staging", "satisfaction"): t.staged_surveys(),
        ("gold", "satisfaction"): t.fact_satisfaction(),
    }
    counts = quality.union_all([
        df.agg(F.count(F.lit(1)).alias("nb_lignes"))
        .select(F.lit(zone).alias("zone"), F.lit(entity).alias("entity"), "nb_lignes")
        for (zone, entity), df in tables.items()])
    return quality.volume_report(counts)
