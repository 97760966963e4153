"""The driver's tables in the shape of the mart's sources.

Values get deterministic irregularities (padding, blanks, accents, bad dates); rows are never
left out. ``oracles.py`` states the same sources in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.operators import dimensions as dims
from starmart.operators import facts, staging
from starmart.session import empty_table, stored, tuned
from starmart.sources import feeds, relational

# Region codes given to nations 0..24: two repeat with another label, some are padded or unusable.
NATION_CODES = ["84", "32", "93", "44", "76", "28", "75", "24", "27", "53", "52", "11", "01", "02",
                "03", "04", "06", "94", "84", "32", " 11 ", "", None, "99", "R98"]
SURVEY_REGIONS = ["Rhône-Alpes", "ILE DE FRANCE", "Provence-Alpes-Côte d'Azur", "Atlantide",
                  "Midi-Pyrénées", "La Réunion", "Franche-Comté"]


def once(build):
    """Build a table of a ``Tables`` object on first use and hand out the same plan afterwards."""
    def table(self, *args, **options):
        key = (build.__name__, *args, *options.items())
        if key not in self.built:
            self.built[key] = build(self, *args, **options)
        return self.built[key]
    return table


class Tables:
    """The driver's tables of one scale, and the sources derived from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = tuned(spark), sf_dir
        self.built: dict[tuple, DataFrame] = {}

    @once
    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # --- relational sources -------------------------------------------------------------------

    @once
    def consultation(self) -> DataFrame:
        """Consultations as the operational view gives them (dates typed, ids as text)."""
        return self.table("lineitem").select(
            text("concat(l_orderkey, '-', l_linenumber)").alias("id_consultation"),
            text("l_orderkey div 10").alias("id_patient"),
            F.col("l_shipdate").cast("date").alias("date_consultation"),
            F.expr(DIAGNOSIS).alias("diagnostic"), F.expr(ESTABLISHMENT).alias("id_etablissement"),
            F.lit(0).cast("decimal(12,2)").alias("montant"))

    @once
    def patient(self) -> DataFrame:
        return self.table("customer").select(
            text("c_custkey").alias("id_patient"), F.expr(SEX).alias("sexe"), F.expr(AGE).alias("age"))

    @once
    def consultations(self) -> DataFrame:
        """Staged consultations with sex and age."""
        return relational.consultations(self.consultation(), self.patient())

    @once
    def raw_consultation(self) -> DataFrame:
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("Num_consultation"),
            F.expr("l_orderkey div 10").alias("Id_patient"),
            F.col("l_shipdate").cast("date").alias("Date"), F.expr(DIAGNOSIS).alias("Code_diag"),
            F.col("l_suppkey").alias("Id_prof_sante"))

    @once
    def raw_room(self) -> DataFrame:
        """A room for every order; some rooms have no number, some belong to unknown consultations."""
        return self.table("orders").select(
            F.expr("CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderkey % 40 END")
            .alias("Id_salle"),
            F.expr("CASE WHEN o_orderkey % 6 = 1 THEN -o_orderkey ELSE o_orderkey END").alias("Num_consultation"),
            F.expr("o_orderkey % 7").alias("Code_bloc"), F.expr("o_orderkey % 4")
            .alias("Num_etage"), F.expr("o_orderkey % 90").alias("Num_salle"))

    @once
    def raw_patient(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").alias("Id_patient"), F.expr(SEX).alias("Sexe"), F.expr(AGE).alias("Age"),
            F.col("c_mktsegment").alias("Ville"), F.lit("FRANCE").alias("Pays"))

    @once
    def raw_practitioner(self) -> DataFrame:
        return self.table("part").select(
            F.expr(PRACTITIONER).alias("Identifiant"), F.expr(LAST_NAME).alias("Nom"), F.expr(FIRST_NAME).alias("Prenom"),
            F.col("p_type").alias("Profession"), F.col("p_size").alias("Code_specialite"))

    # --- text feeds ---------------------------------------------------------------------------

    @once
    def consultation_text(self) -> DataFrame:
        """The consultation extract as text, with a few rows no load can accept."""
        day = "string(date(l_shipdate))"
        return self.table("lineitem").select(
            text("concat(l_orderkey, '-', l_linenumber)").alias("id_consultation"),
            F.expr("CASE WHEN l_partkey % 401 = 5 THEN NULL ELSE string(l_orderkey div 10) END")
            .alias("id_patient"),
            F.expr(f"CASE WHEN l_partkey % 307 = 3 THEN '2019-02-30' ELSE {day} END")
            .alias("date_consultation"),
            F.expr(DIAGNOSIS).alias("diagnostic"),
            F.when(F.expr("l_partkey % 503 = 7"), None).otherwise(F.expr(ESTABLISHMENT))
            .alias("id_etablissement"),
            F.expr("CASE WHEN l_partkey % 601 = 9 THEN 'n/a' ELSE '0.00' END").alias("montant"),
            F.lit("F").alias("sexe"),
            F.expr("CASE l_linenumber WHEN 1 THEN ' ' WHEN 2 THEN NULL "
                   "ELSE string(l_suppkey % 95) END").alias("age"))

    @once
    def death_text(self) -> DataFrame:
        day = "string(date(l_shipdate))"
        return self.table("lineitem").select(
            F.expr(f"CASE l_partkey % 40 WHEN 0 THEN NULL WHEN 1 THEN '1999-01' "
                   f"WHEN 2 THEN '2019-00-00' WHEN 3 THEN concat('  ', {day}, ' 10:00:00') "
                   f"ELSE {day} END").alias("date"),
            F.expr("CASE l_suppkey % 20 WHEN 0 THEN '2A004' WHEN 1 THEN '97411' WHEN 2 THEN '99999'"
                   " WHEN 3 THEN NULL WHEN 4 THEN ' 69001 ' "
                   "ELSE concat(lpad(1 + l_suppkey % 95, 2, '0'), '001') END").alias("place"))

    @once
    def survey_text(self) -> DataFrame:
        names = F.array(*[F.lit(n) for n in SURVEY_REGIONS])
        name = F.element_at(names, F.expr("int(user_id % 7) + 1"))
        return self.table("events").select(
            F.expr("concat(CASE user_id % 5 WHEN 0 THEN '000' WHEN 1 THEN 'FR' WHEN 2 THEN ' ' "
                   "ELSE '' END, user_id, CASE WHEN user_id % 5 = 2 THEN ' ' ELSE '' END)")
            .alias("establishment"),
            F.when(F.expr("user_id % 3 = 0"), F.expr("CASE WHEN user_id % 2 = 0 THEN ' 84' "
                                                      "ELSE '32' END"))
            .when(F.expr("user_id % 3 = 1"), name).alias("region_code"),
            F.when(F.expr("user_id % 3 = 2"), name).alias("region_name"),
            F.expr("CASE WHEN event_id % 13 <> 0 THEN concat(date_sub(date(ts), "
                   "int(365 * (event_id % 6))), ' 08:00') END").alias("date"),
            F.expr("CASE event_id % 17 WHEN 0 THEN NULL WHEN 1 THEN 'abs' "
                   "ELSE replace(string(decimal(value)), '.', ',') END"
                   .replace("decimal(value)", "CAST(value AS DECIMAL(10,2))")).alias("score"),
            F.expr("CASE WHEN event_id % 2 = 0 THEN 'enquete.csv' ELSE "
                   "concat('enquete_20', 17 + event_id % 5, '_hebdo.csv') END").alias("file_name"))

    @once
    def establishment_text(self) -> DataFrame:
        key = "(CASE WHEN s_suppkey % 10 = 9 THEN s_suppkey - 1 ELSE s_suppkey END)"
        return self.table("supplier").select(
            F.expr(f"CASE s_suppkey % 6 WHEN 0 THEN concat('000', {key}) WHEN 1 THEN "
                   f"concat('FR', {key}) WHEN 2 THEN concat(' ', {key}, ' ') WHEN 3 THEN '  ' "
                   f"WHEN 4 THEN string({key}) ELSE NULL END").alias("id"),
            F.expr(f"CASE WHEN s_suppkey % 11 = 5 THEN 'sans' ELSE string({key}) END")
            .alias("alternate_id"),
            F.expr("CASE s_suppkey % 7 WHEN 0 THEN NULL WHEN 1 THEN ' ' "
                   "ELSE concat(' ', s_name) END").alias("name"),
            F.expr("CASE WHEN s_nationkey % 3 = 0 THEN NULL WHEN s_nationkey % 3 = 1 THEN '84' "
                   "ELSE ' 93 ' END").alias("region"),
            F.expr("CASE WHEN s_suppkey % 9 = 0 THEN 'x' "
                   "ELSE concat(11 + s_suppkey % 80, '000') END").alias("postal"))

    @once
    def correspondence_text(self) -> DataFrame:
        """Correspondences of establishment ids: chains, two targets, circles, blanks and ids of their own."""
        own = self.table("supplier").select("s_suppkey", F.expr(
            "CASE s_suppkey % 10 WHEN 1 THEN array(s_suppkey + 1) WHEN 2 THEN array(s_suppkey + 1) "
            "WHEN 4 THEN array(s_suppkey + 1, s_suppkey + 2) WHEN 5 THEN array(s_suppkey) "
            "WHEN 6 THEN array(s_suppkey - 2) WHEN 7 THEN array(s_suppkey + 1) WHEN 8 THEN array(s_suppkey - 1) "
            "WHEN 9 THEN array(s_suppkey - 1, s_suppkey - 1) WHEN 0 THEN array(NULL) END").alias("targets"))
        return (own.select(F.expr("concat(' 00', s_suppkey)").alias("internal"), F.explode("targets").alias("target"))
                .select("internal", F.col("target").cast("string").alias("official")))

    @once
    def practitioner_source(self) -> DataFrame:
        return self.table("part").select(F.expr(PRACTITIONER).alias("id_professionnel"),
                                         F.expr(LAST_NAME).alias("nom"), F.expr(FIRST_NAME).alias("prenom"))

    @once
    def geography_text(self) -> DataFrame:
        codes = F.array(*[F.lit(c) for c in NATION_CODES])
        # region has 5 rows in every scale
        named = self.table("nation").join(
            self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        return named.select(
            F.element_at(codes, F.expr("n_nationkey % 25 + 1")).alias("code"),
            F.expr("CASE n_nationkey % 6 WHEN 5 THEN NULL WHEN 4 THEN ' ' "
                   "ELSE concat(n_name, ' ') END").alias("label"),
            F.expr("CASE n_nationkey % 4 WHEN 1 THEN NULL WHEN 2 THEN ' ' ELSE r_name END")
            .alias("country"))

    @once
    def stay_text(self) -> DataFrame:
        return self.table("orders").select(
            text("o_custkey").alias("id_patient"),
            F.expr("CASE WHEN o_orderkey % 50 = 4 THEN NULL ELSE "
                   "concat('D', o_orderkey % 180) END").alias("code_diag"),
            F.expr("CASE o_orderkey % 30 WHEN 1 THEN '31-02-2020' WHEN 2 THEN ' ' "
                   "ELSE concat(' ', date_format(o_orderdate, 'dd-MM-yyyy')) END")
            .alias("date_entree"),
            F.expr("CASE o_orderkey % 9 WHEN 0 THEN ' ' WHEN 1 THEN NULL "
                   "ELSE string(o_orderkey % 20) END").alias("jours"),
            F.expr("lpad(o_orderkey % 110, 6, '0')").alias("finess"))

    @once
    def patient_file(self) -> DataFrame:
        """The patient file of the text flow, with ids and sexes as people type them."""
        return self.table("customer").select(
            F.expr("CASE WHEN c_custkey % 41 = 7 THEN ' ' WHEN c_custkey % 10 = 9 THEN "
                   "string(c_custkey - 1) ELSE concat(' ', c_custkey) END").alias("id_patient"),
            F.expr("CASE c_custkey % 5 WHEN 0 THEN 'Masculin' WHEN 1 THEN ' f' WHEN 2 THEN 'FEMME'"
                   " WHEN 3 THEN 'x' ELSE NULL END").alias("sexe"),
            F.expr("CASE c_custkey % 13 WHEN 0 THEN ' ' WHEN 1 THEN NULL "
                   "ELSE string(c_custkey % 95) END").alias("age"),
            F.col("c_name").alias("nom"), F.lit("1 rue X").alias("adresse"))

    # --- bronze and staging -------------------------------------------------------------------

    @once
    def bronze_deaths(self) -> DataFrame:
        return feeds.death_rows(self.death_text())

    @once
    def bronze_surveys(self) -> DataFrame:
        return feeds.survey_rows(self.survey_text())

    @once
    def bronze_establishments(self) -> DataFrame:
        return feeds.establishment_rows(self.establishment_text())

    @once
    def bronze_practitioners(self) -> DataFrame:
        return feeds.practitioner_rows(self.practitioner_source())

    @once
    def bronze_geography(self) -> DataFrame:
        return feeds.geography_rows(self.geography_text())

    @once
    def staged_deaths(self) -> DataFrame:
        """Straight from the raw feed, counted before the region lookup."""
        counted = facts.deaths_of_raw_rows(self.death_text(), "date", "place")
        return staging.load_deaths_counts(counted).accepted

    @once
    def staged_surveys(self) -> DataFrame:
        return staging.load_satisfaction(self.bronze_surveys()).accepted

    @once
    def staged_geography(self) -> DataFrame:
        return self.bronze_geography().select(
            F.col("code_region").alias("code_region_src"),
            F.col("libelle_region").alias("libelle_region_src"), F.col("pays").alias("pays_src"))

    # --- gold ---------------------------------------------------------------------------------

    @once
    def dim_geography(self) -> DataFrame:
        empty = empty_table(self.spark, dims.GEOGRAPHY_SCHEMA)
        return dims.merge_geography(empty, self.staged_geography())

    @once
    def dim_patient(self) -> DataFrame:
        """Patients of the consultations: ids are made distinct before the patient join."""
        seen = self.consultation().select("id_patient").distinct()
        return dims.patients(seen.join(self.patient(), "id_patient", "left"))

    @once
    def dim_diagnosis(self) -> DataFrame:
        return dims.diagnoses(self.consultation())

    @once
    def dim_establishment(self) -> DataFrame:
        geo = self.dim_geography()
        seeds = dims.establishments_of_consultations(self.consultation())
        merged = dims.merge_establishments(seeds, self.bronze_establishments(), geo)
        return dims.merge_surveyed_establishments(merged, self.staged_surveys(), geo)

    @once
    def dim_practitioner(self) -> DataFrame:
        empty = empty_table(self.spark, dims.PRACTITIONER_SCHEMA)
        return dims.merge_practitioners(empty, self.bronze_practitioners())

    @once
    def dim_calendar(self) -> DataFrame:
        days = dims.calendar(self.consultation(), "date_consultation")
        days = dims.merge_calendar(days, dims.calendar(self.staged_deaths(), "date_deces_src"))
        return dims.merge_calendar(days, dims.calendar(self.staged_surveys(), "date_mesure_src"))

    @once
    def fact_consultation(self) -> DataFrame:
        """The fact with practitioner and duration filled in, so that their KPIs have values."""
        source = self.table("lineitem").select(
            text("l_orderkey div 10").alias("id_patient"),
            F.col("l_shipdate").cast("date").alias("date_consultation"),
            F.expr(DIAGNOSIS).alias("diagnostic"), F.expr(ESTABLISHMENT).alias("id_etablissement"),
            "l_partkey", "l_quantity")
        return facts.consultation_fact(source, practitioner=F.col("l_partkey").cast("string"),
                                       duration=F.col("l_quantity").cast("int"))

    @once
    def fact_deaths(self) -> DataFrame:
        return facts.deaths_fact(self.staged_deaths(), self.dim_geography())

    @once
    def fact_satisfaction(self) -> DataFrame:
        return facts.satisfaction_fact(self.staged_surveys(), self.dim_geography())

    @once
    def fact_stays(self, count_days: bool = False) -> DataFrame:
        return facts.hospitalisation_fact(self.stay_text(), self.dim_calendar(), count_days)

    def settle(self) -> Tables:
        """Write down the staged feeds and the calendar, for queries of several gold tables built from them:
        each feed is then parsed once, not once per table."""
        for table in ("staged_deaths", "staged_surveys", "dim_calendar"):
            self.built[(table,)] = stored(getattr(self, table)())
        return self

    def star(self) -> "LazyStar":
        return LazyStar(self)


class LazyStar:
    """The star schema of a scale; a table is planned only when a KPI asks for it."""

    def __init__(self, tables: Tables):
        self._builders = {
            "patient": tables.dim_patient, "geography": tables.dim_geography,
            "establishment": tables.dim_establishment, "diagnosis": tables.dim_diagnosis,
            "practitioner": tables.dim_practitioner, "consultation": tables.fact_consultation,
            "death": tables.fact_deaths, "satisfaction": tables.fact_satisfaction,
            "hospitalisation": tables.fact_stays}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in self._builders:
            raise AttributeError(name)
        table = self._builders[name]()
        setattr(self, name, table)
        return table


def text(expression: str) -> Column:
    return F.expr(expression).cast("string")


DIAGNOSIS = (
    "CASE l_partkey % 11 WHEN 0 THEN NULL WHEN 1 THEN '   ' "
    "WHEN 2 THEN concat('  D', l_partkey % 150, ' ') ELSE concat('D', l_partkey % 150) END")
ESTABLISHMENT = (
    "CASE l_suppkey % 4 WHEN 0 THEN concat('000', l_suppkey) WHEN 1 THEN "
    "concat(' ', l_suppkey, ' ') ELSE string(l_suppkey) END")
SEX = ("CASE WHEN c_custkey % 30 = 2 THEN 'Non renseigné' WHEN c_custkey % 3 = 0 THEN 'F' "
             "WHEN c_custkey % 3 = 1 THEN 'M' END")
AGE = ("CASE WHEN c_custkey % 17 <> 0 THEN int(c_custkey % 95) END")
PRACTITIONER = (
    "CASE WHEN p_partkey % 50 = 7 THEN '  ' WHEN p_partkey % 60 = 8 THEN NULL "
    "WHEN p_partkey % 10 = 9 THEN concat(' ', p_partkey - 1) ELSE string(p_partkey) END")
LAST_NAME = ("CASE WHEN p_partkey % 7 = 3 THEN NULL ELSE p_name END")
FIRST_NAME = ("CASE WHEN p_partkey % 5 = 3 OR p_partkey % 14 = 10 THEN NULL "
                    "ELSE p_brand END")
