"""One job from raw files and the relational source to the published mart."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from starmart.operators import facts, staging
from starmart.plans import rebuild
from starmart.sources import delimited, feeds


@dataclass
class RawFeeds:
    """Paths of the raw files per feed, and the tables of the relational source."""

    consultations: DataFrame
    deaths: list[str] = field(default_factory=list)
    surveys: list[str] = field(default_factory=list)
    establishments: list[str] = field(default_factory=list)
    practitioner_files: list[str] = field(default_factory=list)
    practitioner_table: object = None  # a function that returns the table
    geography: list[str] = field(default_factory=list)
    hospitalisations: DataFrame | None = None
    correspondence: DataFrame | None = None


def bronze(spark: SparkSession, raw: RawFeeds, root: str) -> dict[str, DataFrame]:
    """Extract every feed to ``root``; what an extract leaves out goes to ``rejects_<feed>``.

    Deaths, the largest feed, are counted per day and department before anything is looked up or
    written, so their bronze table has a row per day and region. A feed without a usable row is an error.
    """
    deaths, surveys = feeds.read_deaths(spark, raw.deaths), feeds.read_surveys(spark, raw.surveys)
    rejects = {"deces": feeds.death_rejects(deaths), "satisfaction": feeds.survey_rejects(surveys)}
    for name, rows in rejects.items():
        delimited.write_bronze(rows, f"{root}/rejects_{name}")

    def land(name: str, rows: DataFrame) -> DataFrame:
        path = f"{root}/{name}_raw"
        delimited.write_bronze(rows, path)
        schema = ", ".join(f"`{c}` string" for c in rows.columns)
        landed = spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)
        return staging.require_rows(landed, name)

    landed = {"deces": land("deces", facts.deaths_of_raw_rows(deaths, "date", "place")),
              "satisfaction": land("satisfaction", feeds.survey_rows(surveys))}
    table = raw.practitioner_table or (lambda: spark.createDataFrame([], "id_professionnel string"))
    regions = feeds.read_geography(spark, raw.geography) if raw.geography else None
    return landed | {
        "etablissements": land("etablissements", feeds.establishment_rows(
            feeds.read_establishments(spark, raw.establishments))),
        "professionnels": land("professionnels", feeds.practitioners(spark, table, raw.practitioner_files)),
        "geographie": land("geographie", feeds.geography(regions, landed["deces"], landed["satisfaction"]))}


def run(spark: SparkSession, raw: RawFeeds, bronze_root: str, mart_root: str) -> rebuild.Run:
    """Extract all feeds, rebuild the mart from their bronze copies, check and publish it."""
    landed = bronze(spark, raw, bronze_root)
    return rebuild.rebuild(spark, rebuild.Sources(
        consultations=raw.consultations, deaths=landed["deces"], surveys=landed["satisfaction"],
        establishments=landed["etablissements"], practitioners=landed["professionnels"],
        geography=landed["geographie"], hospitalisations=raw.hospitalisations, correspondence=raw.correspondence), mart_root, rebuild.EXTENDED)
