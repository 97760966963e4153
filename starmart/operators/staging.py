"""Typed staging loads. Each returns accepted rows and, apart, the rejected rows with a reason."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from starmart.functions import fixed_values as fixed
from starmart.functions import rules
from starmart.operators.facts import deaths_by_day_and_region
from starmart.operators.ids import dense_ids
from starmart.sources.delimited import Headers


@dataclass
class Loaded:
    """A load: source rows, the target columns, and for each reason of rejection its condition.

    Conditions are never NULL.
    """

    source: DataFrame
    columns: list[Column]
    reasons: list[tuple[Column, str]]
    judged: DataFrame | None = None  # the target columns of all rows and whether a row is bad

    @property
    def accepted(self) -> DataFrame:
        if self.judged is not None:
            return self.judged.filter(~F.col("_bad")).drop("_bad")
        return self.source.filter(~self._bad()).select(*self.columns)

    @property
    def rejected(self) -> DataFrame:
        """The rejected source rows with every reason that applies."""
        reason = F.concat_ws(",", *[F.when(bad, F.lit(text)) for bad, text in self.reasons])
        return self.source.filter(self._bad()).withColumn("reason", reason)

    def counted(self, watch: Observation) -> Loaded:
        """Count read and rejected rows while the accepted ones are written, in the same pass.

        Filters are not pushed below the count, so each value is parsed once: for the test, the count and
        the target column.
        """
        counts = [F.count(F.lit(1)).alias("rows"), F.count_if(F.col("_bad")).alias("rejected")]
        # Unlike an OR, this evaluates all conditions, so Spark shares what they have in common with the columns.
        conditions = [bad for bad, _ in self.reasons]
        bad = F.greatest(*conditions) if len(conditions) > 1 else conditions[0]
        judged = self.source.select(*self.columns, bad.alias("_bad")).observe(watch, *counts)
        return Loaded(self.source, self.columns, self.reasons, judged)

    def _bad(self) -> Column:
        return reduce(lambda a, b: a | b, [bad for bad, _ in self.reasons])


class LoadError(ValueError):
    """A load or an extract that has no usable row, or a bad row in strict mode."""


def _unreadable(text: Column, value: Column) -> Column:
    return value.isNull() & rules.has_text(text)


def load_consultations(raw: DataFrame, with_loaded_at: bool = False) -> Loaded:
    day = rules.text_date(F.col("date_consultation"))
    amount = F.nullif(F.trim("montant"), F.lit("")).try_cast("decimal(12,2)")
    age = rules.blank_safe_int(F.col("age"))
    columns = [F.col("id_consultation"), F.col("id_patient"), day.alias("date_consultation"),
               F.col("diagnostic"), F.col("id_etablissement"), amount.alias("montant"),
               F.col("sexe"), age.alias("age")]
    if with_loaded_at:
        columns.append(F.current_timestamp().alias("loaded_at"))
    return Loaded(raw, columns, [
        (F.col("id_patient").isNull(), "id_patient"),
        (day.isNull(), "date_consultation"),
        (F.col("id_etablissement").isNull(), "id_etablissement"),
        (_unreadable(F.col("montant"), amount), "montant"),
        (_unreadable(F.col("age"), age), "age"),
    ])


def load_geography(raw: DataFrame, number_rows_by: list[str] | None = None) -> Loaded:
    """Region rows; the country default applies only where there is no country column.

    Without an id column rows are numbered from 1 in the order of ``number_rows_by``.
    """
    headers = Headers(raw.columns)
    aliases = fixed.GEOGRAPHY_STAGING_ALIASES
    id_col = headers.find(aliases["id"])
    if id_col is None:
        order = number_rows_by or raw.columns
        raw = dense_ids(raw, order, "_row_number")
        id_value = F.col("_row_number").cast("int")
    else:
        id_value = rules.stripped_or_null(F.col(id_col)).try_cast("double").cast("int")
    null = F.lit(None).cast("string")

    def text(name: str) -> Column:
        found = headers.find(aliases[name])
        return rules.stripped_or_null(F.col(found)) if found else null

    country = (text("country") if headers.find(aliases["country"])
               else F.lit(fixed.DEFAULT_COUNTRY))
    return Loaded(raw, [id_value.alias("id_geo_src"), text("code").alias("code_region_src"),
                       text("label").alias("libelle_region_src"), country.alias("pays_src")],
                  [(text("code").isNull(), "code_region"), (id_value.isNull(), "id_geo")])


def load_deaths(bronze: DataFrame) -> Loaded:
    """Bronze deaths, counted per day and region."""
    return load_deaths_counts(deaths_by_day_and_region(bronze))


def load_deaths_counts(counted: DataFrame) -> Loaded:
    """Counted deaths; a ten-character text that is no calendar date is rejected."""
    # The count is always positive. Naming it keeps the parsing above the aggregation: once per
    # day and region instead of once per death.
    day = F.when(F.col("nb_deces") > 0, rules.text_date(F.col("date_deces")))
    return Loaded(counted, [day.alias("date_deces_src"), F.col("code_region").alias("code_region_src"),
                           F.col("nb_deces").cast("int").alias("nb_deces_src")],
                 [(day.isNull(), "date_deces")])


def load_satisfaction(bronze: DataFrame, strict: bool = False) -> Loaded:
    headers = Headers(bronze.columns)

    def found(name: str) -> Column:
        column = headers.find(fixed.SURVEY_STAGING_ALIASES[name])
        return (F.col(column) if column else F.lit(None)).cast("string")

    day = rules.text_date(found("date"))
    score = rules.decimal_comma(found("score"), strict=strict)
    columns = [day.alias("date_mesure_src"), rules.strip(found("establishment")).alias("finess_src"),
               rules.strip(found("region")).alias("code_region_src"),
               score.alias("score_global_src")]
    return Loaded(bronze, columns, [
        (day.isNull(), "date"), (~rules.has_text(found("establishment")), "finess"),
        (~rules.has_text(found("region")), "code_region"), (score.isNull(), "score_global")])


def load_establishments(bronze: DataFrame) -> Loaded:
    return Loaded(bronze, [F.col("finess"), F.col("nom"), F.col("code_region")],
                 [(F.col("finess").isNull(), "finess")])


def load_practitioners(bronze: DataFrame) -> Loaded:
    return Loaded(bronze, [F.col("id_prof_source"), F.col("nom_source")],
                 [(F.col("id_prof_source").isNull(), "id_prof_source")])


def raise_on_reject(loaded: Loaded, watch: Observation, table: str) -> None:
    """Strict load: one rejected row fails the whole load, as a bulk copy would."""
    if watch.get["rejected"]:
        example = loaded.rejected.head(1)[0]
        raise LoadError(f"{table}: {watch.get['rejected']} rejected rows ({example['reason']})")


def require_accepted(table: str, read: int, accepted: int) -> None:
    """A load that accepts nothing is an error, before anything is built on it."""
    if not accepted:
        raise LoadError(f"{table}: none of {read} rows is usable")


def require_rows(df: DataFrame, table: str) -> DataFrame:
    """An extract or a load without a usable row is an error."""
    if not df.head(1):
        raise LoadError(f"{table}: no usable row")
    return df
