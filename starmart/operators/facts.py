"""Fact builds. Ids are added where a fact is stored, see ``operators.ids``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.functions import fixed_values as fixed
from starmart.functions import rules
from starmart.operators.dimensions import region_ids
from starmart.operators.lookups import add_region_of_department

CONSULTATION_ORDER = ["id_temps", "id_patient", "finess"]


def consultation_fact(staged: DataFrame, practitioner: Column | None = None,
                      duration: Column | None = None) -> DataFrame:
    """One row per staged consultation.

    The staged feed has neither practitioner nor duration, so both are NULL unless given.
    """
    null = F.lit(None)
    return staged.select(
        rules.calendar_key(F.col("date_consultation")).alias("id_temps"),
        F.col("id_patient"),
        rules.establishment_id(F.col("id_etablissement")).alias("finess"),
        (null if practitioner is None else practitioner).cast("string").alias("id_professionnel"),
        rules.blank_default(F.col("diagnostic"), fixed.UNKNOWN_DIAGNOSIS).alias("code_diag"),
        (null if duration is None else duration).cast("int").alias("duree_consultation"),
        F.lit(1).alias("nb_consultations"),
    )


def deaths_by_day_and_region(bronze: DataFrame) -> DataFrame:
    """Deaths per date text and region; rows are single deaths or, with ``nb_deces``, that many.

    Texts are counted as they come and conformed once each, not once per death.
    """
    deaths = F.sum(F.coalesce(F.col("nb_deces").cast("bigint"), F.lit(1))) if "nb_deces" in bronze.columns else F.count(
        F.lit(1))
    counted = bronze.groupBy("date_deces", "code_region").agg(deaths.alias("_n"))
    day, region = rules.date_text(F.col("date_deces")), rules.strip(F.col("code_region"))
    # Naming the count keeps the tests above the aggregation.
    usable = F.when(F.col("_n").isNotNull(), (F.length("date_deces") == 10) & (F.length("code_region") > 0))
    return (counted.select(day.alias("date_deces"), region.alias("code_region"), "_n").filter(usable)
            .groupBy("date_deces", "code_region").agg(F.sum("_n").alias("nb_deces")))


def deaths_of_raw_rows(raw: DataFrame, day: str, place: str) -> DataFrame:
    """Scan to pre-aggregate in one pass: count per date text and department, then look up the
    region of the few counted rows instead of every death."""
    # The length test names the count to stay above the aggregation: below it, every row's date
    # would be cut out twice.
    counted = (raw.select(rules.date_text(F.col(day)).alias("date_deces"),
                          rules.department_key(F.col(place)).alias("_department"))
               .groupBy("date_deces", "_department").agg(F.count(F.lit(1)).alias("_n"))
               .filter(F.when(F.col("_n") > 0, F.length("date_deces") == 10)))
    return (add_region_of_department(counted, "_department", "code_region", how="inner")
            .groupBy("date_deces", "code_region").agg(F.sum("_n").alias("nb_deces")))


def deaths_fact(staged: DataFrame, geography: DataFrame) -> DataFrame:
    """Deaths per day and geography; regions without a geography row drop out.

    The staged rows are summed per code before the join; an id belongs to one code, so that is
    the sum per id too.
    """
    per_code = (staged.groupBy(rules.calendar_key(F.col("date_deces_src")).alias("id_temps"),
                               F.trim("code_region_src").alias("code_region"))
                .agg(F.sum(F.coalesce("nb_deces_src", F.lit(1))).alias("_n")))
    return (per_code.join(region_ids(geography), "code_region")
            .select("id_temps", "id_geo", F.col("_n").cast("bigint").alias("nb_deces")))


def satisfaction_fact(staged: DataFrame, geography: DataFrame, *kept: str) -> DataFrame:
    """One row per survey of a known region; ``kept`` columns of the staged rows come along."""
    rows = (staged.filter(rules.not_blank(F.col("finess_src")))
            .select(rules.calendar_key(F.col("date_mesure_src")).alias("id_temps"),
                    F.trim("finess_src").alias("finess"),
                    F.trim("code_region_src").alias("_region"),
                    F.col("score_global_src").cast("double").alias("score_global"), *kept))
    return (rows.join(region_ids(geography, "_region"), "_region")
            .select("id_temps", "finess", "id_geo", "score_global", *kept))


def hospitalisation_fact(raw: DataFrame, calendar: DataFrame,
                         count_days: bool = False) -> DataFrame:
    """One row per stay; a day-first date outside the calendar leaves the day key NULL.

    The measure is 1 per stay, or the blank-safe number of days when ``count_days``.
    """
    # Calendar keys come from ten-character dates, years 1 to 9999: under 3.7 million narrow rows.
    days = F.broadcast(calendar.select(F.col("date_complete").alias("_day"), "id_temps"))
    measure = rules.blank_safe_int(F.col("jours")) if count_days else F.lit(1)
    return (raw.withColumn("_entry", rules.day_first_date(F.col("date_entree")))
            .join(days, F.col("_entry") == F.col("_day"), "left")
            .select("id_temps", F.col("id_patient"),
                    rules.establishment_id(F.col("finess")).alias("finess"),
                    F.col("code_diag"), measure.alias("nb_hospitalisations")))


def unsound_keys(stays: DataFrame, **dimensions: tuple[DataFrame, bool]) -> DataFrame:
    """Add ``reason``: the key columns of each stay that its dimension lacks, '' if none.

    ``dimensions`` gives per column the dimension and whether the key may be NULL.
    """
    reasons, rows = [], stays
    for column, (dimension, may_lack) in dimensions.items():
        rows = rows.join(dimension.select(F.col(column).alias(f"_{column}")),
                         F.col(column) == F.col(f"_{column}"), "left")
        lost = F.col(f"_{column}").isNull()
        reasons.append(F.when(lost & F.col(column).isNotNull() if may_lack else lost, column))
    return rows.select(*stays.columns, F.concat_ws(",", *reasons).alias("reason"))


def attach_diagnosis(fact: DataFrame, diagnoses: DataFrame) -> DataFrame:
    """Keep rows with an unknown diagnosis and tag them instead of dropping them."""
    known = diagnoses.select(F.col("code_diag").alias("_known"), "libelle")
    return (fact.join(known, F.col("code_diag") == F.col("_known"), "left")
            .withColumn("code_diag", F.coalesce("_known", F.lit(fixed.UNKNOWN_DIAGNOSIS)))
            .withColumn("libelle", F.coalesce("libelle", F.lit(fixed.UNKNOWN_DIAGNOSIS)))
            .drop("_known"))


def with_calendar(fact: DataFrame, day_may_lack: bool = False) -> DataFrame:
    """Day attributes of a fact, read off its yyyymmdd key; a stored year is kept.

    Every day key of a published fact is in the calendar (the integrity check sees to it), and
    the attributes are functions of the key. So this equals the inner join with the calendar
    without its scan and join. Only stays may lack a day key; those rows drop out, as they do there.
    The stored year is the folder that a filter on ``annee`` prunes.
    """
    rows = fact.filter(F.col("id_temps").isNotNull()) if day_may_lack else fact
    month = F.expr("CAST(id_temps div 100 % 100 AS int)")
    if "annee" not in fact.columns:
        rows = rows.withColumn("annee", year_of_key())
    return (rows.withColumn("trimestre", F.expr("CAST((id_temps div 100 % 100 + 2) div 3 AS int)"))
            .withColumn("date_complete", F.make_date(year_of_key(), month, F.col("id_temps") % 100)))


def year_of_key() -> Column:
    return F.expr("CAST(id_temps div 10000 AS int)")
