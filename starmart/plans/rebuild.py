"""Rebuild of the mart: stage, build, check, then publish.

A run writes under ``<root>/run=<id>/<table>`` and never over a path it reads. Its tables become
visible through one appended publication row, after every check has passed; a failed run leaves
the published one untouched.

A refresh builds the same tables but writes only those years of a fact whose contents differ from the
published ones. The others stay where they are: the run's table ``annees`` names the run that holds
each year, and reading a fact puts the years together. Dimensions are written whole.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starmart.operators import dimensions as dims
from starmart.operators import correspondence, facts, quality, sinks, staging
from starmart.operators.ids import dense_ids, position
from starmart.plans.kpis import Star
from starmart.session import empty_table, path_exists

STANDARD, EXTENDED = "standard", "extended"

STANDARD_TABLES = ["stg_consultations_raw", "dim_temps", "dim_patient", "dim_etablissement",
                   "dim_diagnostic", "fait_consultation"]
EXTENDED_TABLES = ["stg_geographie_raw", "stg_deces_raw", "stg_satisfaction_raw",
                   "stg_etablissements_raw", "stg_professionnels_raw", "dim_geographie",
                   "dim_professionnel", "fait_deces", "fait_satisfaction"]

DEATH_SCHEMA = "id_fait_deces bigint, id_temps int, id_geo int, nb_deces bigint"
SATISFACTION_SCHEMA = ("id_fait_satisfaction bigint, id_temps int, finess string, id_geo int, "
                       "score_global double")
STAY_SCHEMA = ("id_fait_hospitalisation bigint, id_temps int, id_patient string, finess string, "
               "code_diag string, nb_hospitalisations int")

YEARS = "annees"
YEARS_SCHEMA = "fait string, annee int, run_id bigint, nb_lignes bigint, hash_sum string, hash_xor bigint"

PRIMARY_KEYS = {"dim_temps": "id_temps", "dim_patient": "id_patient", "dim_geographie": "id_geo",
                "dim_etablissement": "finess", "dim_diagnostic": "code_diag",
                "dim_professionnel": "id_professionnel"}
FOREIGN_KEYS = {
    "dim_etablissement": {"id_geo": "dim_geographie"},
    "fait_consultation": {"id_temps": "dim_temps", "id_patient": "dim_patient",
                          "finess": "dim_etablissement", "code_diag": "dim_diagnostic",
                          "id_professionnel": "dim_professionnel"},
    "fait_deces": {"id_temps": "dim_temps", "id_geo": "dim_geographie"},
    "fait_satisfaction": {"id_temps": "dim_temps", "finess": "dim_etablissement",
                          "id_geo": "dim_geographie"},
    "fait_hospitalisation": {"id_temps": "dim_temps", "id_patient": "dim_patient",
                             "finess": "dim_etablissement", "code_diag": "dim_diagnostic"},
}
NOT_NULL = {
    "dim_temps": ["id_temps", "date_complete", "annee", "trimestre", "mois", "semaine"],
    "fait_consultation": ["id_temps", "id_patient", "finess", "nb_consultations"],
    "fait_deces": ["id_temps", "id_geo", "nb_deces"],
    "fait_satisfaction": ["id_temps", "finess", "id_geo"],
    "fait_hospitalisation": ["id_patient", "finess", "nb_hospitalisations"],
}
# Tables whose keys may stand for several source rows, of which the smallest was taken.
COLLAPSED = {"stg_geographie_raw": ["code_region_src"], "stg_etablissements_raw": ["finess"],
             "stg_professionnels_raw": ["id_prof_source"]}


@dataclass
class Sources:
    """Bronze tables of one run; only consultations are needed in standard mode."""

    consultations: DataFrame
    deaths: DataFrame | None = None
    surveys: DataFrame | None = None
    establishments: DataFrame | None = None
    practitioners: DataFrame | None = None
    geography: DataFrame | None = None
    hospitalisations: DataFrame | None = None
    correspondence: DataFrame | None = None  # internal and official establishment ids of the consultations


class Run:
    """The tables of one run folder."""

    def __init__(self, spark: SparkSession, root: str, run_id: int):
        self.spark, self.root, self.run_id = spark, root, run_id
        self.schemas = {}  # of tables written by this object; an empty table has no file to tell
        self.homes: dict[str, dict[int, list]] | None = None  # per fact the runs that hold its years

    def path(self, table: str) -> str:
        return f"{self.root}/run={self.run_id}/{table}"

    def years(self) -> DataFrame | None:
        """What a refreshed run knows of each year of its facts; None for a run that wrote them all."""
        if not path_exists(self.spark, self.path(YEARS)):
            return None
        return self.spark.read.schema(YEARS_SCHEMA).parquet(self.path(YEARS))

    def _homes(self) -> dict[str, dict[int, list]]:
        """One row per fact and year comes to the driver: years of four digits, mostly a few dozen."""
        if self.homes is None:
            self.homes, known = {}, self.years()
            for row in [] if known is None else known.select("fait", "annee", "run_id").collect():
                self.homes.setdefault(row["fait"], {}).setdefault(row["run_id"], []).append(row["annee"])
        return self.homes

    def needed_runs(self) -> set[int]:
        """Runs whose folders this one reads; they must stay as long as it is published."""
        return {self.run_id}.union(*[set(runs) for runs in self._homes().values()])

    def read(self, table: str) -> DataFrame:
        """A table of this run. Filters on ``annee`` prune folders of years kept in older runs too."""
        if table not in self._homes():
            return self._own(table)
        parts = []
        for run_id, years in sorted(self._homes()[table].items()):
            home = self if run_id == self.run_id else Run(self.spark, self.root, run_id)
            parts.append(home._own(table).where(_of_years(years)))
        return reduce(DataFrame.unionByName, parts)

    def _own(self, table: str) -> DataFrame:
        reader = self.spark.read
        if table in self.schemas:
            reader = reader.schema(self.schemas[table])
        return reader.parquet(self.path(table))

    def write(self, table: str, df: DataFrame, partition: str | None = None) -> DataFrame:
        writer = df.write.mode("overwrite")
        (writer.partitionBy(partition) if partition else writer).parquet(self.path(table))
        self.schemas[table] = df.schema
        return self._own(table)

    def star(self) -> Star:
        return Star(patient=self.read("dim_patient"), geography=self.read("dim_geographie"),
                    establishment=self.read("dim_etablissement"),
                    diagnosis=self.read("dim_diagnostic"),
                    practitioner=self.read("dim_professionnel"),
                    consultation=self.read("fait_consultation"), death=self.read("fait_deces"),
                    satisfaction=self.read("fait_satisfaction"),
                    hospitalisation=self.read("fait_hospitalisation"))


def _of_years(years: list[int | None]) -> Column:
    known = F.col("annee").isin([y for y in years if y is not None])
    return known | F.col("annee").isNull() if None in years else known


def published_run(spark: SparkSession, root: str) -> Run | None:
    run_id = sinks.current_run(spark, root)
    return None if run_id is None else Run(spark, root, run_id)


def _previous(spark: SparkSession, root: str, table: str, schema: str) -> DataFrame:
    run = published_run(spark, root)
    return run.read(table) if run else empty_table(spark, schema)


def _write_fact(run: Run, table: str, rows: DataFrame, order: list[str], published: Run | None, **how) -> None:
    """Number a fact's rows and write them by year; see ``dense_ids`` for what ``how`` may say.

    With a published run, only years whose rows differ from the published ones are written. Their ids
    go on after the largest published one, so ids stay unique but have gaps.
    """
    rows, id_name = sinks.with_year(rows), f"id_{table}"
    stamped = lambda df, start: (dense_ids(df, order, id_name, start=start, **how)
                                 .withColumn("loaded_at", F.current_timestamp()))
    if published is None:
        run.write(table, stamped(rows, 1), partition="annee")
        return
    columns = [c for c in rows.columns if c not in ("annee", how.get("tie"))]
    old = published.read(table)
    known = published.years()
    if known is not None and table in published._homes():
        known = known.where(F.col("fait") == table)
    elif "annee" in old.columns:
        known = quality.fingerprint_by(old, "annee", columns).withColumn("run_id", F.lit(published.run_id))
    else:  # written without years because it was empty
        known = empty_table(run.spark, YEARS_SCHEMA)
    contents = ["nb_lignes", "hash_sum", "hash_xor"]
    found, kept = quality.fingerprint_by(rows, "annee", columns).alias("f"), known.alias("k")
    same = F.col("f.annee").eqNullSafe(F.col("k.annee"))
    for c in contents:
        same &= F.col(f"f.{c}") == F.col(f"k.{c}")
    judged = (found.join(kept, same, "left")
              .select(F.lit(table).alias("fait"), "f.annee",
                      F.coalesce("k.run_id", F.lit(run.run_id)).cast("bigint").alias("run_id"),
                      *[f"f.{c}" for c in contents]).collect())
    if not judged:
        run.write(table, stamped(rows, 1))
        return
    changed = [r["annee"] for r in judged if r["run_id"] == run.run_id]
    if changed:
        start = (old.agg(F.max(id_name)).head()[0] or 0) + 1
        run.write(table, stamped(rows.where(_of_years(changed)), start), partition="annee")
    run.spark.createDataFrame(judged, YEARS_SCHEMA).coalesce(1).write.mode("append").parquet(run.path(YEARS))
    run.homes = None


def _stage_extended(run: Run, sources: Sources) -> dict[str, tuple[int, int]]:
    """Stage the other feeds; rows read and written of each, counted while they are written."""
    flows = {}
    # Deaths are the largest feed: counted in one pass, then split into accepted and rejected.
    deaths = run.write("bronze_deces_par_jour", facts.deaths_by_day_and_region(sources.deaths))
    loads = {
        "stg_geographie_raw": staging.load_geography(
            sources.geography, ["code_region", "libelle_region", "pays"]),
        "stg_deces_raw": staging.load_deaths_counts(deaths),
        "stg_satisfaction_raw": staging.load_satisfaction(sources.surveys),
        "stg_etablissements_raw": staging.load_establishments(sources.establishments),
        "stg_professionnels_raw": staging.load_practitioners(sources.practitioners),
    }
    for table, loaded in loads.items():
        watch = Observation(f"{table}_{run.run_id}")
        run.write(table, loaded.counted(watch).accepted)
        counts = watch.get
        read, accepted = counts["rows"], counts["rows"] - counts["rejected"]
        staging.require_accepted(table, read, accepted)
        flows[table.removeprefix("stg_").removesuffix("_raw")] = (read, accepted)
        if counts["rejected"]:  # a second pass over the feed only where there is something to keep
            run.write(f"rejects_{table}", loaded.rejected)
    return flows


def build(run: Run, sources: Sources, mode: str = STANDARD,
          published: Run | None = None) -> dict[str, tuple[int, int]]:
    """Write every table of a run; returns the rows read and staged of each flow.

    With a ``published`` run of the same mode, years of facts that are as they were there stay there.

    A standard run empties the facts of the other flows, as truncating their shared dimensions
    would; geography and practitioners are carried over from the published run.
    """
    spark = run.spark
    extended = mode == EXTENDED
    loaded = staging.load_consultations(sources.consultations, with_loaded_at=True)
    watch = Observation(f"consultations_{run.run_id}")
    stg = run.write("stg_consultations_raw", loaded.counted(watch).accepted)
    staging.raise_on_reject(loaded, watch, "consultations")
    counts = watch.get
    flows = {"consultations": (counts["rows"], counts["rows"] - counts["rejected"])}
    if sources.correspondence is not None:
        resolved = run.write("etablissements_correspondance", correspondence.resolve(sources.correspondence))
        stg = run.write("stg_consultations_officielles", correspondence.official_ids(stg, resolved, "id_etablissement"))

    days = dims.calendar(stg, "date_consultation")
    establishments = dims.establishments_of_consultations(stg)
    geo = _previous(spark, run.root, "dim_geographie", dims.GEOGRAPHY_SCHEMA)
    practitioners = _previous(spark, run.root, "dim_professionnel", dims.PRACTITIONER_SCHEMA)
    if extended:
        flows |= _stage_extended(run, sources)
        deaths, surveys = run.read("stg_deces_raw"), run.read("stg_satisfaction_raw")
        geo = dims.merge_geography(geo, run.read("stg_geographie_raw"))
        practitioners = dims.merge_practitioners(practitioners, run.read("stg_professionnels_raw"))
    geo = run.write("dim_geographie", geo)
    if extended:
        establishments = dims.merge_establishments(
            establishments, run.read("stg_etablissements_raw"), geo)
        establishments = dims.merge_surveyed_establishments(establishments, surveys, geo)
        days = dims.merge_calendar(days, dims.calendar(deaths, "date_deces_src"))
        days = dims.merge_calendar(days, dims.calendar(surveys, "date_mesure_src"))
    days = run.write("dim_temps", days)
    run.write("dim_patient", dims.patients(stg))
    run.write("dim_etablissement", establishments)
    run.write("dim_diagnostic", dims.diagnoses(stg))
    run.write("dim_professionnel", practitioners)

    # Range partitions on the day leave one or two years per task, so few files per year folder.
    _write_fact(run, "fait_consultation", facts.consultation_fact(stg), facts.CONSULTATION_ORDER, published,
                is_plain_scan=True, by_day=True)
    if extended:
        _write_fact(run, "fait_deces", facts.deaths_fact(deaths, geo), ["id_temps", "id_geo"], published,
                    is_unique=True)
        _write_fact(run, "fait_satisfaction",
                    facts.satisfaction_fact(surveys.withColumn("_survey", position()), geo, "_survey"),
                    ["id_temps", "finess", "id_geo"], published, tie="_survey")
    else:
        run.write("fait_deces", empty_table(spark, DEATH_SCHEMA))
        run.write("fait_satisfaction", empty_table(spark, SATISFACTION_SCHEMA))
    if extended and sources.hospitalisations is not None:
        stays = run.write("stg_sejours", facts.unsound_keys(
            facts.hospitalisation_fact(sources.hospitalisations, days),
            id_patient=(run.read("dim_patient"), False), finess=(run.read("dim_etablissement"), False),
            code_diag=(run.read("dim_diagnostic"), True)))
        rejected = stays.filter("reason <> ''")
        if not rejected.isEmpty():
            run.write("rejects_fait_hospitalisation", rejected)
        _write_fact(run, "fait_hospitalisation", stays.filter("reason = ''").drop("reason"),
                    ["id_patient", "code_diag"], published, is_plain_scan=True)
    else:
        run.write("fait_hospitalisation", empty_table(spark, STAY_SCHEMA))
    return flows


def checks(run: Run, mode: str) -> DataFrame:
    """Minimum rows, keys, NULLs and foreign keys of the tables of a mode: one scan of each."""
    names = STANDARD_TABLES + (EXTENDED_TABLES if mode == EXTENDED else [])
    parts = []
    # Stays come from a source that a run may lack, so they may be empty, but never unsound.
    for name in [*names, "fait_hospitalisation"]:
        table = run.read(name)
        parts.append(quality.soundness(table, name, quality.Rules(
            minimum=1 if name in names else None,
            unique=(PRIMARY_KEYS[name],) if name in PRIMARY_KEYS else (), not_null=tuple(NOT_NULL.get(name, ())),
            foreign={column: (run.read(dimension), PRIMARY_KEYS[dimension])
                     for column, dimension in FOREIGN_KEYS.get(name, {}).items()})))
        if name in COLLAPSED:
            parts.append(quality.collapsed(table, name, COLLAPSED[name]))
    return quality.union_all(parts)


def rebuild(spark: SparkSession, sources: Sources, root: str, mode: str = STANDARD,
            changed_years_only: bool = False) -> Run:
    """Build a run, log it, and publish it if its checks pass.

    ``changed_years_only`` refreshes: facts equal a full rebuild's but for ids and load times, and only
    changed years are written. Without a published run of the same mode everything is.
    """
    if mode not in (STANDARD, EXTENDED):
        raise ValueError(f"unknown mode {mode}")
    last, last_mode = sinks.current(spark, root) or (0, None)
    published = Run(spark, root, last) if changed_years_only and last_mode == mode else None
    started = datetime.now(timezone.utc)
    run = Run(spark, root, max(last + 1, int(started.timestamp() * 1000)))
    entry = {"run_id": run.run_id, "job_name": f"{'refresh' if changed_years_only else 'rebuild'}_{mode}", "started_at": started}
    checked = None
    try:
        flows = build(run, sources, mode, published)
        checked = checks(run, mode).persist()
        quality.log_quality(checked, f"{root}/audit/data_quality_log", run.run_id)
        quality.gate(checked)
        # The gate has counted the fact.
        written = checked.where("check_name = 'min_rows' AND table_name = 'fait_consultation'").select(
            F.col("metric_value").cast("long")).first()[0]
        entry.update(status="success", rows_read=flows["consultations"][0], rows_written=written)
        quality.log_flows(spark, f"{root}/audit/etl_flow_log", run.run_id, flows)
        sinks.publish(spark, root, run.run_id, mode)
    except Exception as error:
        entry.update(status="failed", message=str(error))
        raise
    finally:
        if checked is not None:
            checked.unpersist()
        entry["ended_at"] = datetime.now(timezone.utc)
        quality.log_run(spark, f"{root}/audit/etl_run_log", entry)
    return run


# The table that shows what became of each flow.
GOLD_OF_FLOW = {"consultations": "fait_consultation", "deces": "fait_deces", "satisfaction": "fait_satisfaction",
                "geographie": "dim_geographie", "etablissements": "dim_etablissement",
                "professionnels": "dim_professionnel"}


def volume_report(spark: SparkSession, root: str) -> DataFrame:
    """Rows of each flow of the published run in each zone, from what the run logged while it wrote."""
    flows = spark.read.schema(quality.FLOW_LOG_SCHEMA).parquet(f"{root}/audit/etl_flow_log")
    checks = spark.read.parquet(f"{root}/audit/data_quality_log")
    run_id = sinks.current_run(spark, root)
    logged = flows.where(F.col("run_id") == run_id).select("flow").collect()  # six flows at most
    gold = {row["flow"]: GOLD_OF_FLOW[row["flow"]] for row in logged}
    return quality.volume_report(quality.logged_volumes(flows, checks, run_id, gold))


def remove_old_runs(spark: SparkSession, root: str, keep: int = 2) -> list[int]:
    """Delete the folders of all but the newest ``keep`` published runs, and of runs that failed before the
    newest; returns what went. Runs whose years a kept one still reads stay. Nobody may be reading the others.
    """
    published = spark.read.schema("run_id bigint, mode string").parquet(f"{root}/published")
    newest = [r["run_id"] for r in published.orderBy(F.col("run_id").desc()).limit(max(1, keep)).collect()]
    needed = set().union(*[Run(spark, root, run_id).needed_runs() for run_id in newest])
    return sinks.remove_numbered(spark, root, "run", max(newest), needed)
