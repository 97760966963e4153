"""Columns by which the mart's tables are compared as contents, and the fingerprint in SQL."""

from __future__ import annotations

# Ids that a rebuild deals among equal rows, and load times, are left out.
GOLD_COLUMNS = {
    "dim_temps": ["id_temps", "date_complete", "annee", "trimestre", "mois", "semaine"],
    "dim_patient": ["id_patient", "sexe", "age"],
    "dim_geographie": ["id_geo", "code_region", "libelle_region", "pays"],
    "dim_etablissement": ["finess", "nom", "id_geo"],
    "dim_diagnostic": ["code_diag", "libelle"],
    "dim_professionnel": ["id_professionnel", "nom"],
    "fait_consultation": ["id_temps", "id_patient", "finess", "id_professionnel", "code_diag", "duree_consultation",
                          "nb_consultations"],
    "fait_deces": ["id_temps", "id_geo", "nb_deces"],
    "fait_satisfaction": ["id_temps", "finess", "id_geo", "score_global"],
    "fait_hospitalisation": ["id_temps", "id_patient", "finess", "code_diag", "nb_hospitalisations"],
}
FLOATING = {"score_global"}


def fingerprint_sql(table: str, rows: str) -> str:
    """The rows that ``quality.fingerprint`` gives for a table whose rows are ``rows``."""
    told = {}
    for c in GOLD_COLUMNS[table]:
        value = f"CAST({c} AS DECIMAL(38,6))" if c in FLOATING else c
        told[c] = f"COALESCE(CAST({value} AS VARCHAR), '\\N')"
    told["*"] = f"CONCAT_WS('|', {', '.join(told.values())})"
    hashes = ", ".join(f"CAST('0x' || SUBSTR(MD5({text}), 1, 15) AS BIGINT) AS h{k}" for k, text in enumerate(told.values()))
    sums = ", ".join(f"SUM(h{k}) AS s{k}, BIT_XOR(h{k}) AS x{k}" for k in range(len(told)))
    pick = lambda letter: "CASE k " + " ".join(f"WHEN {k} THEN {letter}{k}" for k in range(len(told))) + " END"
    names = ", ".join(f"({k}, '{c}')" for k, c in enumerate(told))
    return (f"SELECT '{table}' AS table_name, c AS column_name, n AS nb_lignes, "
            f"COALESCE(CAST({pick('s')} AS VARCHAR), '0') AS hash_sum, COALESCE({pick('x')}, 0) AS hash_xor "
            f"FROM (SELECT COUNT(*) AS n, {sums} FROM (SELECT {hashes} FROM ({rows}))) CROSS JOIN (VALUES {names}) v(k, c)")


def contents_sql(tables: dict[str, str]) -> str:
    return " UNION ALL ".join(fingerprint_sql(name, rows) for name, rows in tables.items())
