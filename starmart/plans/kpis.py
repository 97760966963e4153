"""KPI queries over the star schema. Each returns a lazy DataFrame without a final sort.

Facts are reduced to the join keys before dimensions are joined. That keeps shuffles small and
takes the weight out of hot keys (an unknown establishment, a default diagnosis). Dimensions carry
no broadcast hint: Spark broadcasts them when their measured size allows, and shuffles otherwise.
Diagnoses come before the last grouping, since all codes that the dimension lacks make one group.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.functions import fixed_values as fixed
from starmart.functions import rules
from starmart.functions.numbers import SCORE_UNITS, half_up_tenth, mean, score_units
from starmart.operators.facts import with_calendar


@dataclass
class Star:
    """The published tables a KPI may need; unused ones may stay None."""

    patient: DataFrame | None = None
    geography: DataFrame | None = None
    establishment: DataFrame | None = None
    diagnosis: DataFrame | None = None
    practitioner: DataFrame | None = None
    consultation: DataFrame | None = None
    death: DataFrame | None = None
    satisfaction: DataFrame | None = None
    hospitalisation: DataFrame | None = None


def _total(column: str) -> Column:
    return F.sum(column).cast("bigint").alias(column)


def _geo(star: Star) -> DataFrame:
    return star.geography.select("id_geo", "code_region", "libelle_region")


def _places(star: Star) -> DataFrame:
    """Establishments with their region."""
    return (star.establishment.join(_geo(star), "id_geo", "left")
            .select("finess", F.col("nom").alias("etablissement"), "code_region",
                    "libelle_region"))


def _diagnoses(star: Star) -> DataFrame:
    """Diagnosis labels; ``code_dim`` is NULL for a fact without a known diagnosis."""
    return star.diagnosis.select(F.col("code_diag").alias("code_dim"),
                                 F.col("libelle").alias("diagnostic"))


def _with_diagnosis(df: DataFrame, star: Star) -> DataFrame:
    return (df.join(_diagnoses(star), F.col("code_diag") == F.col("code_dim"), "left")
            .withColumn("code_diag", F.col("code_dim")).drop("code_dim"))


# --- detail KPIs ------------------------------------------------------------------------------

def consultations_detail(star: Star) -> DataFrame:
    """The fact is grouped by its own keys first; patients, places and diagnoses meet those groups."""
    rows = (star.consultation.groupBy("finess", "code_diag", *_day(star.consultation), "id_patient")
            .agg(_total("nb_consultations"), F.sum("duree_consultation").alias("_duration"),
                 F.count("duree_consultation").alias("_timed")))
    known = _with_diagnosis(rows, star).join(star.patient.select("id_patient", "sexe", "age"), "id_patient")
    summed = (known.groupBy("finess", "code_diag", "diagnostic", *_day(star.consultation), "sexe", "age")
              .agg(_total("nb_consultations"), F.sum("_duration").alias("_duration"),
                   F.sum("_timed").alias("_timed")))
    return (with_calendar(summed).join(_places(star), "finess")
            .select("finess", "etablissement", "code_region", "libelle_region", "annee", "date_complete",
                    "code_diag", "diagnostic", "sexe", "age", "nb_consultations",
                    mean(F.col("_duration"), F.col("_timed")).alias("duree_moy_min")))


def _day(fact: DataFrame) -> list[str]:
    """The day key and, where it is stored, the year that prunes the scan."""
    return [c for c in ("annee", "id_temps") if c in fact.columns]


def deaths_by_day(star: Star) -> DataFrame:
    return (with_calendar(star.death).groupBy("id_geo", "annee", "date_complete")
            .agg(_total("nb_deces")).join(_geo(star), "id_geo")
            .groupBy("code_region", "libelle_region", "annee", "date_complete")
            .agg(_total("nb_deces")))


def _scores(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(score_units(F.col("score_global"))).alias("_units"),
                                 F.count("score_global").alias("_scored"),
                                 F.min("score_global").alias("score_min"),
                                 F.max("score_global").alias("score_max"),
                                 F.count(F.lit(1)).alias("nb_mesures"))


def _rescored(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum("_units").alias("_units"), F.sum("_scored").alias("_scored"),
                                 F.min("score_min").alias("score_min"),
                                 F.max("score_max").alias("score_max"),
                                 F.sum("nb_mesures").alias("nb_mesures"))


def _mean_score() -> Column:
    return mean(F.col("_units"), F.col("_scored"), SCORE_UNITS).alias("score_moyen")


def _satisfaction_places(star: Star, *time: str) -> DataFrame:
    rows = _scores(with_calendar(star.satisfaction), "finess", "id_geo", *time)
    names = star.establishment.select("finess", F.col("nom").alias("etablissement"))
    return _rescored(rows.join(names, "finess").join(_geo(star), "id_geo", "left"),
                     "finess", "etablissement", "code_region", "libelle_region", *time)


def satisfaction_by_day(star: Star) -> DataFrame:
    rows = _satisfaction_places(star, "annee", "date_complete")
    return rows.select("finess", "etablissement", "code_region", "libelle_region", "annee",
                       "date_complete", _mean_score(), "nb_mesures")


def hospitalisations_detail(star: Star) -> DataFrame:
    rows = (with_calendar(star.hospitalisation, day_may_lack=True)
            .groupBy("finess", "code_diag", "annee", "date_complete")
            .agg(_total("nb_hospitalisations")))
    labelled = _with_diagnosis(rows.join(_places(star), "finess"), star)
    return (labelled.groupBy("finess", "etablissement", "libelle_region", "annee",
                             "date_complete", "code_diag", "diagnostic")
            .agg(_total("nb_hospitalisations")))


# --- dashboard KPIs ---------------------------------------------------------------------------

def consultations_by_establishment(star: Star) -> DataFrame:
    """Only named establishments are joined, so an unnamed one shows neither name nor region.

    Groups are the raw columns, labels come after.
    """
    named = _places(star).filter(F.col("etablissement").isNotNull())
    rows = (with_calendar(star.consultation).groupBy("finess", "annee", "trimestre")
            .agg(_total("nb_consultations")))
    return (rows.join(named, "finess", "left")
            .groupBy("finess", "etablissement", "libelle_region", "annee", "trimestre")
            .agg(_total("nb_consultations"))
            .select("finess",
                    rules.establishment_label(F.col("etablissement"), F.col("finess"))
                    .alias("etablissement"),
                    rules.region_label(F.col("libelle_region")).alias("region"),
                    "annee", "trimestre", "nb_consultations"))


def _by_diagnosis(fact: DataFrame, star: Star, measure: str) -> DataFrame:
    rows = (with_calendar(fact.filter(F.col("code_diag").isNotNull()), day_may_lack=True)
            .groupBy("code_diag", "annee", "trimestre").agg(_total(measure)))
    return (rows.join(_diagnoses(star), F.col("code_diag") == F.col("code_dim"), "left")
            .groupBy("code_diag", "diagnostic", "annee", "trimestre").agg(_total(measure))
            .select("code_diag", F.coalesce("diagnostic", "code_diag").alias("diagnostic"),
                    "annee", "trimestre", measure))


def consultations_by_diagnosis(star: Star) -> DataFrame:
    return _by_diagnosis(star.consultation, star, "nb_consultations")


def hospitalisations_by_quarter(star: Star) -> DataFrame:
    return (with_calendar(star.hospitalisation, day_may_lack=True).groupBy("annee", "trimestre")
            .agg(_total("nb_hospitalisations")))


def hospitalisations_by_diagnosis(star: Star) -> DataFrame:
    return _by_diagnosis(star.hospitalisation, star, "nb_hospitalisations")


def demographics(star: Star) -> DataFrame:
    """Per patient and year first, then sex and age band; the mean age weighs every consultation."""
    per_patient = (with_calendar(star.consultation).groupBy("id_patient", "annee")
                   .agg(_total("nb_consultations"), F.count(F.lit(1)).alias("_rows")))
    weight = F.when(F.col("age").isNotNull(), F.col("_rows")).otherwise(0)
    banded = (per_patient.join(star.patient.select("id_patient", "sexe", "age"), "id_patient")
              .withColumn("tranche_age", rules.age_band(F.col("age")))
              .groupBy("sexe", "tranche_age", "annee")
              .agg(_total("nb_consultations"),
                   half_up_tenth(F.sum(F.col("age") * F.col("_rows")), F.sum(weight))
                   .alias("age_moyen")))
    return banded.withColumn("sexe", F.coalesce("sexe", F.lit(fixed.NOT_STATED)))


def consultations_by_practitioner(star: Star) -> DataFrame:
    """Every practitioner; one without consultations shows no year and 0."""
    rows = (with_calendar(star.consultation.filter(F.col("id_professionnel").isNotNull()))
            .groupBy("id_professionnel", "annee").agg(_total("nb_consultations")))
    return (star.practitioner.join(rows, "id_professionnel", "left")
            .select("id_professionnel",
                    F.coalesce("nom", F.lit(fixed.UNKNOWN_NAME)).alias("nom_professionnel"),
                    "annee", F.coalesce("nb_consultations", F.lit(0).cast("bigint"))
                    .alias("nb_consultations")))


def practitioner_totals(star: Star, extra_distinct: bool = False) -> DataFrame:
    """Joined rows (a practitioner with n consultations counts n times) and active practitioners.

    ``extra_distinct`` adds the number of different practitioners.
    """
    activity = (star.consultation.filter(F.col("id_professionnel").isNotNull())
                .groupBy("id_professionnel").agg(F.count(F.lit(1)).alias("_n")))
    joined = star.practitioner.select("id_professionnel").join(activity, "id_professionnel", "left")
    counts = [F.coalesce(F.sum(F.coalesce("_n", F.lit(1))), F.lit(0)).cast("bigint")
              .alias("nb_professionnels_enregistres"),
              F.count("_n").alias("nb_professionnels_actifs")]
    if extra_distinct:
        counts.append(F.count(F.lit(1)).alias("nb_professionnels_distincts"))
    return joined.agg(*counts)


def practitioner_count(star: Star) -> DataFrame:
    return practitioner_totals(star).select("nb_professionnels_enregistres")


def deaths_by_region(star: Star) -> DataFrame:
    return (with_calendar(star.death).groupBy("id_geo", "annee").agg(_total("nb_deces"))
            .join(_geo(star), "id_geo")
            .groupBy("code_region", "libelle_region", "annee").agg(_total("nb_deces"))
            .select("code_region", F.coalesce("libelle_region", "code_region").alias("region"),
                    "annee", "nb_deces"))


def satisfaction_by_region(star: Star) -> DataFrame:
    rows = _rescored(_scores(with_calendar(star.satisfaction), "id_geo", "annee")
                     .join(_geo(star), "id_geo"), "code_region", "libelle_region", "annee")
    return rows.select(
        "code_region", F.coalesce("libelle_region", "code_region").alias("region"), "annee",
        half_up_tenth(F.col("_units"), F.col("_scored"), SCORE_UNITS).alias("satisfaction_moyenne"),
        F.col("nb_mesures").alias("nb_reponses"))


# --- large-volume KPIs ------------------------------------------------------------------------

def _known_codes(fact: DataFrame, star: Star) -> DataFrame:
    """The fact with NULL for every code that the dimension lacks, so that these make one group."""
    codes = star.diagnosis.select(F.col("code_diag").alias("code_dim"))
    return (fact.join(codes, F.col("code_diag") == F.col("code_dim"), "left")
            .withColumn("code_diag", F.col("code_dim")).drop("code_dim"))


def consultations_volume(star: Star) -> DataFrame:
    """Totals and exact distinct patients.

    Codes are resolved first, so that one grouping leaves a row per patient and group; labels come last.
    """
    measures = [_total("nb_consultations"), F.sum("_duration").alias("_duration"), F.sum("_timed").alias("_timed")]
    per_patient = (_known_codes(with_calendar(star.consultation), star)
                   .groupBy("finess", "annee", "code_diag", "id_patient")
                   .agg(measures[0], F.sum("duree_consultation").alias("_duration"),
                        F.count("duree_consultation").alias("_timed")))
    rows = (per_patient.join(star.patient.select("id_patient", "sexe"), "id_patient")
            .groupBy("finess", "annee", "code_diag", "sexe")
            .agg(*measures, F.count(F.lit(1)).alias("nb_patients_distincts")))
    return (_with_diagnosis(rows.join(_places(star), "finess"), star)
            .select("finess", "etablissement", "libelle_region", "annee", "code_diag",
                    "diagnostic", "sexe", "nb_consultations",
                    mean(F.col("_duration"), F.col("_timed")).alias("duree_moy_min"),
                    "nb_patients_distincts"))


def deaths_volume(star: Star) -> DataFrame:
    return (with_calendar(star.death).groupBy("id_geo", "annee").agg(_total("nb_deces"))
            .join(_geo(star), "id_geo")
            .groupBy("code_region", "libelle_region", "annee").agg(_total("nb_deces")))


def satisfaction_volume(star: Star) -> DataFrame:
    return _satisfaction_places(star, "annee").select(
        "finess", "etablissement", "code_region", "libelle_region", "annee", _mean_score(),
        "score_min", "score_max", "nb_mesures")


def hospitalisations_volume(star: Star) -> DataFrame:
    per_patient = (_known_codes(with_calendar(star.hospitalisation, day_may_lack=True), star)
                   .groupBy("finess", "annee", "code_diag", "id_patient").agg(_total("nb_hospitalisations")))
    rows = (per_patient.join(star.patient.select("id_patient"), "id_patient", "left_semi")
            .groupBy("finess", "annee", "code_diag")
            .agg(_total("nb_hospitalisations"), F.count(F.lit(1)).alias("nb_patients_distincts")))
    return (_with_diagnosis(rows.join(_places(star), "finess"), star)
            .select("finess", "etablissement", "libelle_region", "annee", "code_diag",
                    "diagnostic", "nb_hospitalisations", "nb_patients_distincts"))


# --- dashboard roll-ups -----------------------------------------------------------------------

def _sum_as(df: DataFrame, measure: str, name: str, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(measure).cast("bigint").alias(name))


def _top(df: DataFrame, n: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).limit(n)


def _down(name: str) -> Column:
    return F.col(name).desc_nulls_first()


def _up(name: str) -> Column:
    return F.col(name).asc_nulls_last()


def top_establishments(star: Star, n: int = 10) -> DataFrame:
    totals = _sum_as(consultations_by_establishment(star), "nb_consultations",
                     "total_consultations", "finess")
    return (_top(totals, n, _down("total_consultations"), _up("finess"))
            .select(F.col("finess").alias("etablissement"), "total_consultations"))


def top_diagnosis_series(star: Star, n: int = 15) -> DataFrame:
    """Yearly series of the n most frequent diagnoses; the yearly table serves both sides."""
    yearly = _sum_as(consultations_by_diagnosis(star), "nb_consultations", "total",
                     "diagnostic", "annee")
    best = _top(_sum_as(yearly, "total", "_all", "diagnostic"), n, _down("_all"),
                _up("diagnostic")).select("diagnostic")
    return yearly.join(best, "diagnostic", "left_semi")


def hospitalisations_by_year(star: Star) -> DataFrame:
    return _sum_as(hospitalisations_by_quarter(star), "nb_hospitalisations", "total", "annee")


def top_hospitalisation_diagnoses(star: Star, n: int = 50) -> DataFrame:
    totals = _sum_as(hospitalisations_by_diagnosis(star), "nb_hospitalisations", "total",
                     "diagnostic", "annee")
    return _top(totals, n, _down("annee"), _down("total"), _up("diagnostic"))


def sex_age_totals(star: Star) -> DataFrame:
    return _sum_as(demographics(star), "nb_consultations", "total", "sexe", "tranche_age")


def deaths_of_year(star: Star, year: int = 2019) -> DataFrame:
    rows = deaths_by_region(star).filter(F.col("annee") == year)
    return _sum_as(rows, "nb_deces", "total_deces", "region")


def satisfaction_of_year(star: Star, year: int = 2020) -> DataFrame:
    return (satisfaction_by_region(star).filter(F.col("annee") == year)
            .select("region", "satisfaction_moyenne", "nb_reponses"))


def top_establishments_by_year(star: Star, n: int = 50) -> DataFrame:
    totals = _sum_as(consultations_by_establishment(star), "nb_consultations", "total",
                     "etablissement", "region", "annee")
    return _top(totals, n, _down("annee"), _down("total"), _up("etablissement"), _up("region"))


def top_diagnoses_by_year(star: Star, n: int = 50) -> DataFrame:
    totals = _sum_as(consultations_by_diagnosis(star), "nb_consultations", "total",
                     "diagnostic", "annee")
    return _top(totals, n, _down("annee"), _down("total"), _up("diagnostic"))


# --- BI measures and drill-across -------------------------------------------------------------

def consultation_measures(star: Star) -> DataFrame:
    """Total and mean of the detail rows' mean durations.

    The mean of means is rounded to six decimals, since a sum of doubles depends on its order.
    """
    return consultations_detail(star).agg(
        F.coalesce(F.sum("nb_consultations"), F.lit(0)).cast("bigint").alias("nb_consultations"),
        F.round(F.avg(F.col("duree_moy_min").cast("decimal(20,10)")), 6).cast("decimal(20,6)")
        .alias("duree_moyenne"))


def death_measure(star: Star) -> DataFrame:
    return deaths_by_day(star).agg(
        F.coalesce(F.sum("nb_deces"), F.lit(0)).cast("bigint").alias("nb_deces"))


def satisfaction_measures(star: Star, above: float = 80) -> DataFrame:
    rows = satisfaction_by_day(star)
    return rows.agg(
        F.round(F.avg(F.col("score_moyen").cast("decimal(20,10)")), 6).cast("decimal(20,6)")
        .alias("score_moyen"),
        F.count_if(F.col("score_moyen") > above).alias("nb_scores_eleves"))


def drill_consultations_deaths(star: Star) -> DataFrame:
    """Consultations and deaths side by side per year and region label."""
    left = (with_calendar(star.consultation).groupBy("finess", "annee")
            .agg(_total("nb_consultations"))
            .join(_places(star).select("finess", "libelle_region"), "finess"))
    left = _sum_as(left, "nb_consultations", "nb_consultations", "annee", "libelle_region")
    right = _sum_as(deaths_volume(star), "nb_deces", "nb_deces", "annee", "libelle_region")
    return left.join(right, ["annee", "libelle_region"], "full_outer")


def drill_consultations_satisfaction(star: Star) -> DataFrame:
    """Consultations and satisfaction side by side per establishment."""
    known = star.establishment.select("finess")
    left = _sum_as(star.consultation, "nb_consultations", "nb_consultations", "finess")
    right = _scores(star.satisfaction, "finess").select("finess", _mean_score(), "nb_mesures")
    return (left.join(known, "finess", "left_semi")
            .join(right.join(known, "finess", "left_semi"), "finess", "full_outer"))


def drill_satisfaction_deaths(star: Star) -> DataFrame:
    """Satisfaction and deaths side by side per region and year."""
    left = satisfaction_by_region(star)
    right = deaths_by_region(star).select("code_region", "annee", "nb_deces")
    right = _sum_as(right, "nb_deces", "nb_deces", "code_region", "annee")
    left = left.select("code_region", "annee", "satisfaction_moyenne", "nb_reponses")
    return left.join(right, ["code_region", "annee"], "full_outer")


# Presentation order of each dashboard KPI, applied on demand by ``presented`` ('-' is descending).
ORDER = {
    "consultations_by_establishment": ["-annee", "-nb_consultations"],
    "consultations_by_diagnosis": ["-annee", "-nb_consultations"],
    "hospitalisations_by_quarter": ["annee", "trimestre"],
    "hospitalisations_by_diagnosis": ["-annee", "-nb_hospitalisations"],
    "demographics": ["-annee", "-nb_consultations"],
    "consultations_by_practitioner": ["-nb_consultations"],
    "deaths_by_region": ["-annee", "-nb_deces"],
    "satisfaction_by_region": ["-annee", "-satisfaction_moyenne"],
    "consultations_volume": ["-nb_consultations"],
    "deaths_volume": ["-annee", "-nb_deces"],
    "satisfaction_volume": ["-annee", "-score_moyen"],
    "hospitalisations_volume": ["-nb_hospitalisations"],
    "top_diagnosis_series": ["annee", "-total"],
    "hospitalisations_by_year": ["annee"],
    "sex_age_totals": ["-total"],
    "deaths_of_year": ["-total_deces"],
    "satisfaction_of_year": ["-satisfaction_moyenne"],
}


def presented(star: Star, name: str) -> DataFrame:
    """A KPI by name, in the order its dashboard shows it."""
    order = [_down(c[1:]) if c.startswith("-") else _up(c) for c in ORDER[name]]
    return globals()[name](star).orderBy(*order)
