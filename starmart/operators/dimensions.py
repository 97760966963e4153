"""Dimension builds and upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.functions import fixed_values as fixed
from starmart.functions import rules
from starmart.operators.ids import dense_ids
from starmart.operators.keyed import (absent_rows, change_update, one_row_per_key,
                                      overwrite_merge)

GEOGRAPHY_SCHEMA = "id_geo int, code_region string, libelle_region string, pays string"
ESTABLISHMENT_SCHEMA = "finess string, nom string, id_geo int"
PRACTITIONER_SCHEMA = "id_professionnel string, nom string"


def calendar(df: DataFrame, day: str) -> DataFrame:
    """One row per distinct day; attributes are computed after the distinct."""
    days = df.select(F.col(day).alias("_day")).filter(F.col("_day").isNotNull()).distinct()
    return days.select(*rules.calendar_columns(F.col("_day")))


def merge_calendar(current: DataFrame, incoming: DataFrame) -> DataFrame:
    """Upsert of days: attributes are functions of the key, so either row of a key is the new one."""
    return current.unionByName(incoming).dropDuplicates(["id_temps"])


def patients(staged: DataFrame) -> DataFrame:
    return one_row_per_key(staged.select("id_patient", "sexe", "age"), ["id_patient"],
                           ["sexe", "age"])


def merge_patients(current: DataFrame, raw: DataFrame) -> DataFrame:
    """Type 1 upsert of the patient file: sex and age conformed, blank ids dropped."""
    incoming = one_row_per_key(
        raw.filter(rules.not_blank(F.col("id_patient")))
        .select(F.trim("id_patient").alias("id_patient"),
                rules.sex_code(F.col("sexe")).alias("sexe"),
                rules.blank_safe_int(F.col("age")).alias("age")),
        ["id_patient"], ["sexe", "age"])
    return overwrite_merge(current, incoming, "id_patient")


def establishments_of_consultations(staged: DataFrame) -> DataFrame:
    """Seed rows: conformed ids, name and geography still unknown."""
    raw_ids = staged.select("id_etablissement").distinct()
    return (raw_ids.select(rules.establishment_id(F.col("id_etablissement")).alias("finess"))
            .distinct()
            .select("finess", F.lit(None).cast("string").alias("nom"),
                    F.lit(None).cast("int").alias("id_geo")))


def diagnoses(staged: DataFrame) -> DataFrame:
    code = rules.blank_default(F.col("diagnostic"), fixed.UNKNOWN_DIAGNOSIS)
    return (staged.select(code.alias("code_diag")).distinct()
            .select("code_diag", F.col("code_diag").alias("libelle")))


def staged_regions(staged: DataFrame) -> DataFrame:
    """Cleaned regions, one row per code (smallest label and country, NULL last)."""
    cleaned = (staged.filter(rules.not_blank(F.col("code_region_src")))
               .select(F.trim("code_region_src").alias("code_region"),
                       rules.blank_to_null(F.col("libelle_region_src")).alias("libelle_region"),
                       rules.blank_default(F.col("pays_src"), fixed.DEFAULT_COUNTRY).alias("pays")))
    return one_row_per_key(cleaned, ["code_region"], ["libelle_region", "pays"])


def add_new_regions(current: DataFrame, regions: DataFrame) -> DataFrame:
    """Append regions not yet present, numbered by code after the largest id in use."""
    new = absent_rows(current, regions, F.col("code_region"), F.col("code_region"))
    highest = current.agg(F.coalesce(F.max("id_geo"), F.lit(0))).scalar()
    numbered = dense_ids(new, ["code_region"], "_n", is_unique=True)
    added = numbered.select((highest + F.col("_n")).cast("int").alias("id_geo"),
                            "code_region", "libelle_region", "pays")
    return current.unionByName(added)


def update_regions(current: DataFrame, regions: DataFrame) -> DataFrame:
    return change_update(current, regions, "code_region", ["libelle_region", "pays"])


def merge_geography(current: DataFrame, staged: DataFrame) -> DataFrame:
    regions = staged_regions(staged)
    return update_regions(add_new_regions(current, regions), regions)


def region_ids(geography: DataFrame, code: str = "code_region") -> DataFrame:
    """Region code -> geography id. Spark broadcasts it by its measured size, and splits a code that
    holds many rows where it shuffles."""
    return geography.select(F.col("code_region").alias(code), "id_geo")


def staged_establishments(staged: DataFrame, geography: DataFrame) -> DataFrame:
    """Conformed establishments with their geography id, one row per id."""
    geo = region_ids(geography, "_code")
    rows = (staged.filter(rules.not_blank(F.col("finess")))
            .select(rules.establishment_id(F.col("finess")).alias("finess"),
                    rules.blank_to_null(F.col("nom")).alias("nom"),
                    F.trim("code_region").alias("_region"))
            .join(geo, F.col("_region") == F.col("_code"), "left")
            .select("finess", "nom", "id_geo"))
    return one_row_per_key(rows, ["finess"], ["nom", "id_geo"])


def update_establishments(current: DataFrame, incoming: DataFrame) -> DataFrame:
    """Staged name and geography replace the current ones where they are known."""
    cur = current.withColumn("_key", rules.establishment_id(F.col("finess"))).alias("cur")
    inc = incoming.alias("inc")
    return (cur.join(inc, F.col("cur._key") == F.col("inc.finess"), "left")
            .select(F.col("cur.finess").alias("finess"),
                    F.coalesce("inc.nom", "cur.nom").alias("nom"),
                    F.coalesce("inc.id_geo", "cur.id_geo").alias("id_geo")))


def insert_establishments(current: DataFrame, incoming: DataFrame) -> DataFrame:
    new = absent_rows(current, incoming, rules.establishment_id(F.col("finess")), F.col("finess"))
    return current.unionByName(new.select(*current.columns))


def merge_establishments(current: DataFrame, staged: DataFrame,
                         geography: DataFrame) -> DataFrame:
    """Update then insert, in one full outer join on the conformed id.

    Both sides are unique on that id here, since the current ids are conformed already.
    """
    incoming = staged_establishments(staged, geography)
    return overwrite_merge(current, incoming, "finess", keep_old_when_null=["nom", "id_geo"])


def surveyed_establishments(staged: DataFrame, geography: DataFrame) -> DataFrame:
    """Establishments of the survey with a known region, one row per id."""
    pairs = (staged.filter(rules.not_blank(F.col("finess_src")))
             .select(F.trim("finess_src").alias("finess"),
                     F.trim("code_region_src").alias("code_region")).distinct())
    rows = pairs.join(region_ids(geography), "code_region")
    return (one_row_per_key(rows.select("finess", "id_geo"), ["finess"], ["id_geo"])
            .select("finess", F.lit(None).cast("string").alias("nom"), "id_geo"))


def merge_surveyed_establishments(current: DataFrame, staged: DataFrame,
                                  geography: DataFrame) -> DataFrame:
    return overwrite_merge(current, surveyed_establishments(staged, geography), "finess",
                           keep_old=["nom"], keep_old_when_null=["id_geo"])


def staged_practitioners(staged: DataFrame) -> DataFrame:
    rows = (staged.filter(rules.not_blank(F.col("id_prof_source")))
            .select(F.trim("id_prof_source").alias("id_professionnel"),
                    rules.blank_to_null(F.col("nom_source")).alias("nom")))
    return one_row_per_key(rows, ["id_professionnel"], ["nom"])


def merge_practitioners(current: DataFrame, staged: DataFrame) -> DataFrame:
    return overwrite_merge(current, staged_practitioners(staged), "id_professionnel",
                           keep_old_when_null=["nom"])
