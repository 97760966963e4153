"""Extracts of the external feeds: raw text columns in, bronze columns out.

Every ``*_rows`` function takes the canonical columns of ``fixed_values`` aliases, so the same
rule serves files (``read_layouts``) and any other table of the same shape.
"""

from __future__ import annotations

import logging

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.functions import fixed_values as fixed
from starmart.functions import rules
from starmart.operators.lookups import add_region_code, add_region_of_place
from starmart.sources.delimited import plain, read_layouts

log = logging.getLogger(__name__)

BRONZE_DEATH_PATIENT = "UNKNOWN"


def read_deaths(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Deaths file: only the columns found by alias are read."""
    return read_layouts(spark, paths, fixed.DEATH_ALIASES, delimiter=",", required=("date",))


def death_rows(raw: DataFrame) -> DataFrame:
    """One row per death with a ten-character date and a known region."""
    dated = (raw.filter(rules.has_length(F.col("date"), 10))
             .select(rules.date_text(F.col("date")).alias("date_deces"), "place"))
    return (add_region_of_place(dated, "place", how="inner")
            .select("date_deces", F.lit(BRONZE_DEATH_PATIENT).alias("id_patient"), "code_region",
                    F.lit(1).alias("nb_deces")))


def death_rejects(raw: DataFrame) -> DataFrame:
    """The deaths that ``death_rows`` leaves out, with what they lack."""
    judged = add_region_of_place(raw, "place", "_region")
    dated = F.coalesce(rules.has_length(F.col("date"), 10), F.lit(False))
    return (judged.withColumn("reason", F.concat_ws(",", F.when(~dated, "date"),
                                                    F.when(F.col("_region").isNull(), "place")))
            .filter("reason <> ''").drop("_region"))


def read_surveys(spark: SparkSession, paths: list[str]) -> DataFrame:
    return read_layouts(spark, paths, fixed.SURVEY_ALIASES, encoding="ISO-8859-1",
                        keep_file_name=True)


def _surveys(raw: DataFrame) -> DataFrame:
    """Survey answers with whatever they lack.

    A missing date is the first of January of the year in the file name, else of the default year.
    """
    # The last part of the path is the file, or the folder of its part files, whose names say nothing.
    file = F.regexp_replace("file_name", "/part-[^/]*$", "")
    year = rules.first_match(file, r"20[0-9]{2}(?=[^/]*$)")
    day = F.coalesce(rules.date_text(F.col("date")),
                     F.concat(F.coalesce(year, F.lit(fixed.DEFAULT_SURVEY_YEAR)),
                              F.lit("-01-01")))
    rows = raw.select(
        day.alias("date_satisfaction"),
        rules.establishment_id_from_file(F.col("establishment"), no_digit_as_zero=True)
        .alias("finess"),
        "region_code", "region_name",
        rules.decimal_comma(F.col("score")).alias("score_global"))
    return (add_region_code(rows, "region_code", "region_name")
            .select("date_satisfaction", "finess", "code_region", "score_global"))


_SURVEY_NEEDS = ["finess", "code_region", "score_global"]


def survey_rows(raw: DataFrame) -> DataFrame:
    """Survey answers with an establishment, a region and a score."""
    return _surveys(raw).dropna(subset=_SURVEY_NEEDS)


def survey_rejects(raw: DataFrame) -> DataFrame:
    """The answers that ``survey_rows`` leaves out, with what they lack."""
    reasons = [F.when(F.col(c).isNull(), c) for c in _SURVEY_NEEDS]
    return _surveys(raw).withColumn("reason", F.concat_ws(",", *reasons)).filter("reason <> ''")


def read_establishments(spark: SparkSession, paths: list[str]) -> DataFrame:
    return read_layouts(spark, paths, fixed.ESTABLISHMENT_ALIASES)


def establishment_rows(raw: DataFrame, postal_as: str = "region") -> DataFrame:
    """Establishments with digits in an id column; name and region default to ''.

    The region falls back on the first two postal digits. That is a department: with
    ``postal_as='department'`` it is turned into its region, by default it is kept as it is.
    """
    identity = F.coalesce(rules.stripped_or_null(F.col("id")),
                          rules.stripped_or_null(F.col("alternate_id")))
    rows = raw.withColumn("_identity", identity).select(
        rules.establishment_id_from_file(F.col("_identity")).alias("finess"),
        F.coalesce(rules.strip(F.col("name")), F.lit("")).alias("nom"),
        rules.stripped_or_null(F.col("region")).alias("_region"), "postal")
    if postal_as == "department":
        rows = add_region_of_place(rows, "postal", "_postal_region")
    else:
        rows = rows.withColumn("_postal_region", rules.two_digit_code(F.col("postal")))
    return (rows.filter(F.col("finess").isNotNull())
            .select("finess", "nom",
                    F.coalesce("_region", "_postal_region", F.lit("")).alias("code_region")))


def practitioner_rows(source: DataFrame) -> DataFrame:
    """Practitioners from the relational source: full name, NULL ids left out."""
    named = source.filter(F.col("id_professionnel").isNotNull()).select(
        F.col("id_professionnel").cast("string").alias("id_prof_source"),
        rules.full_name(F.col("nom"), F.col("prenom")).alias("nom_source"))
    return _usable_practitioners(named)


def practitioner_file_rows(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Practitioners of all files; each needs an id column, a name is '' where there is none."""
    raw = read_layouts(spark, paths, fixed.PRACTITIONER_ALIASES, required=("id",), key=plain)
    return _usable_practitioners(raw.select(F.col("id").alias("id_prof_source"),
                                            F.col("name").alias("nom_source")))


def _usable_practitioners(df: DataFrame) -> DataFrame:
    identity = rules.strip(F.col("id_prof_source"))
    return (df.select(identity.alias("id_prof_source"),
                      F.coalesce(rules.strip(F.col("nom_source")), F.lit("")).alias("nom_source"))
            .filter(F.col("id_prof_source") != ""))


def practitioners(spark: SparkSession, source, files: list[str]) -> DataFrame:
    """The relational source; when it can't be reached or is empty, the files.

    ``source`` is a function that returns the table, so that a failing connection is seen here. A
    query that doesn't fit its table is an error, not a failing source.
    """
    table = None
    try:
        table = source()
        if not table.head(1):
            table = None
    except AnalysisException as error:
        if error.getCondition() != "TABLE_OR_VIEW_NOT_FOUND":
            raise
        log.warning("practitioner table missing: %s", error)
        table = None
    except (PySparkException, Py4JJavaError) as error:
        log.warning("practitioner source failed: %s", error)
        table = None
    if table is not None:
        return practitioner_rows(table)
    if not files:
        raise ValueError("no practitioner source: neither table nor file")
    return practitioner_file_rows(spark, files)


def read_geography(spark: SparkSession, paths: list[str]) -> DataFrame:
    return read_layouts(spark, paths, fixed.GEOGRAPHY_ALIASES)


def geography_rows(raw: DataFrame) -> DataFrame:
    """Distinct regions with a two-digit code; label and country default when absent."""
    code = rules.two_digit_code(F.col("code"))
    return (raw.filter(code.isNotNull())
            .select(code.alias("code_region"),
                    F.coalesce(rules.strip(F.col("label")), rules.generated_region_label(code))
                    .alias("libelle_region"),
                    F.coalesce(rules.strip(F.col("country")), F.lit(fixed.DEFAULT_COUNTRY))
                    .alias("pays")).distinct())


def geography_from_facts(deaths: DataFrame, surveys: DataFrame) -> DataFrame:
    """Regions found in the bronze deaths and surveys. Each side is made distinct before the union."""
    codes = [df.select("code_region").distinct() for df in (deaths, surveys)]
    code = rules.two_digit_code(F.col("code_region"))
    return (codes[0].union(codes[1]).select(code.alias("code_region"))
            .filter(F.col("code_region").isNotNull()).distinct()
            .select("code_region", rules.generated_region_label(F.col("code_region"))
                    .alias("libelle_region"), F.lit(fixed.DEFAULT_COUNTRY).alias("pays")))


def geography(raw: DataFrame | None, deaths: DataFrame, surveys: DataFrame) -> DataFrame:
    """The region file if it has a usable row, else the regions found in the facts."""
    if raw is not None:
        rows = geography_rows(raw)
        if rows.head(1):
            return rows
    return geography_from_facts(deaths, surveys)
