"""Official codes, labels and header aliases that results must agree on."""

# Department code -> region code (official codes since 2016).
DEPARTMENT_REGION = {
    "01": "84", "02": "32", "03": "84", "04": "93", "05": "93", "06": "93", "07": "84",
    "08": "44", "09": "76", "10": "44", "11": "76", "12": "76", "13": "93", "14": "28",
    "15": "84", "16": "75", "17": "75", "18": "24", "19": "75", "21": "27", "22": "53",
    "23": "75", "24": "75", "25": "27", "26": "84", "27": "28", "28": "24", "29": "53",
    "30": "76", "31": "76", "32": "76", "33": "75", "34": "76", "35": "53", "36": "24",
    "37": "24", "38": "84", "39": "27", "40": "75", "41": "24", "42": "84", "43": "84",
    "44": "52", "45": "24", "46": "76", "47": "75", "48": "76", "49": "52", "50": "28",
    "51": "44", "52": "44", "53": "52", "54": "44", "55": "44", "56": "53", "57": "44",
    "58": "27", "59": "32", "60": "32", "61": "28", "62": "32", "63": "84", "64": "75",
    "65": "76", "66": "76", "67": "44", "68": "44", "69": "84", "70": "27", "71": "27",
    "72": "52", "73": "84", "74": "84", "75": "11", "76": "28", "77": "11", "78": "11",
    "79": "75", "80": "32", "81": "76", "82": "76", "83": "93", "84": "93", "85": "52",
    "86": "75", "87": "75", "88": "44", "89": "27", "90": "27", "91": "11", "92": "11",
    "93": "11", "94": "11", "95": "11",
    "971": "01", "972": "02", "973": "03", "974": "04", "976": "06",
}

# Folded region name (old and new names) -> region code.
REGION_NAME_CODE = {
    "hautsdefrance": "32", "normandie": "28", "iledefrance": "11", "centrevaldeloire": "24",
    "grandest": "44", "bourgognefranchecomte": "27", "paysdelaloire": "52", "bretagne": "53",
    "nouvelleaquitaine": "75", "auvergnerhonealpes": "84", "occitanie": "76",
    "provencealpescotedazur": "93", "paca": "93", "corse": "94",
    "nordpasdecalais": "32", "nordpasdecalaispicardie": "32", "picardie": "32",
    "hautenormandie": "28", "bassenormandie": "28", "centre": "24", "champagneardenne": "44",
    "alsace": "44", "lorraine": "44", "bourgogne": "27", "franchecomte": "27",
    "poitoucharentes": "75", "limousin": "75", "aquitaine": "75", "auvergne": "84",
    "rhonealpes": "84", "languedocroussillon": "76", "midipyrenees": "76",
    "guadeloupe": "01", "martinique": "02", "guyane": "03", "lareunion": "04",
    "reunion": "04", "mayotte": "06",
}

# Accented letters and the plain letters they fold to, position by position.
ACCENTED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝŸ"
UNACCENTED = "aaaaaaceeeeiiiinooooouuuuyyAAAAAACEEEEIIIINOOOOOUUUUYY"

# Default texts and display labels.
UNKNOWN_DIAGNOSIS = "UNKNOWN"
DEFAULT_COUNTRY = "FRANCE"
NOT_STATED = "Non renseigné"
UNKNOWN_REGION = "Région inconnue"
UNKNOWN_NAME = "Inconnu"
ESTABLISHMENT_PREFIX = "Étab. "
REGION_PREFIX = "Region_"
PATIENT_PREFIX = "PATIENT_"
DEFAULT_SURVEY_YEAR = "2024"

# Upper age bound (exclusive) and label of each band, then the open band.
AGE_BANDS = [(18, "< 18 ans"), (30, "18 – 29 ans"), (50, "30 – 49 ans"), (70, "50 – 69 ans")]
OPEN_AGE_BAND = "70 ans et +"

# Header aliases by feed, in priority order.
DEATH_ALIASES = {
    "date": ["date_deces", "date", "datemort", "annee"],
    "patient": ["id_patient", "patient", "num_patient"],
    "place": ["code_lieu_deces", "code_lieu", "code_region", "region"],
    "count": ["nb_deces", "nombre_deces"],
}
SURVEY_ALIASES = {
    "establishment": ["finess", "finess_site", "id_etablissement", "etablissement",
                      "finessetablissementjuridique"],
    "region_code": ["code_region", "region_code", "coderegion"],
    "region_name": ["libelle_region", "libelleregion", "nom_region", "region"],
    "date": ["date_satisfaction", "date", "annee"],
    "score": ["score_global", "score", "tdacetbt", "trdcetbt", "deccetbt", "dtncetbt",
              "tdpcetbt", "trecetbt"],
}
ESTABLISHMENT_ALIASES = {
    "id": ["finess", "finess_site", "finessetablissementjuridique", "id_etablissement",
           "etablissement"],
    "alternate_id": ["finess_site", "finessetablissementjuridique", "finess"],
    "name": ["nom", "nom_etablissement", "raisonsocialesite", "raison_sociale",
             "enseignecommercialesite"],
    "region": ["code_region", "region", "region_code"],
    "postal": ["code_postal", "codepostal"],
}
GEOGRAPHY_ALIASES = {
    "code": ["code_region", "region", "code"],
    "label": ["libelle_region", "nom_region", "region_label"],
    "country": ["pays", "country"],
}
GEOGRAPHY_STAGING_ALIASES = {
    "id": ["id_geo", "id_region", "id"],
    "code": ["code_region", "region", "region_code", "code_reg"],
    "label": ["libelle_region", "nom_region", "region_label", "region"],
    "country": ["pays", "country"],
}
SURVEY_STAGING_ALIASES = {
    "date": ["date_satisfaction", "date", "date_mesure"],
    "establishment": ["finess", "id_etablissement", "etablissement"],
    "region": ["code_region", "region", "region_code"],
    "score": ["score_global", "score", "note"],
}
PRACTITIONER_ALIASES = {
    "id": ["id_professionnel", "id_prof_source", "id_prof", "id", "identifiant"],
    "name": ["nom_source", "nom", "professionnel", "nom_prenom"],
}

# Columns of a patient or practitioner that must never reach the mart.
DENIED_COLUMNS = ["nom", "prenom", "nss", "adresse", "ville", "telephone", "email", "verbatim"]
