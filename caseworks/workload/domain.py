"""The support-programme raw tables, derived from the test tables.

Each table is a list of column expressions over a FROM clause, in SQL that Spark and DuckDB both
read, so that the queries and their check SQL start from the same rows. Where the two dialects
differ, the text holds a mark that :func:`dialect` fills in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from caseworks.plans import flags
from caseworks.plans.marts import Source
from caseworks.schemas import (
    BENEF_COLUMNS,
    BONUS_LINE_COLUMNS,
    COMPILED_BONUS_COLUMNS,
    ENTITY_COLUMNS,
    RDV_COLUMNS,
)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


_schemas: dict[str, StructType] = {}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; its schema is read from the file once per process."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def _text(value: str) -> str:
    """A literal both dialects read, also with an apostrophe inside."""
    return " || chr(39) || ".join(f"'{piece}'" for piece in value.split("'"))


def _choice(selector: str, labels: list[str | None]) -> str:
    """One label by the selector's value; NULL where the list says None."""
    arms = " ".join(f"WHEN {i} THEN {_text(v)}" for i, v in enumerate(labels) if v is not None)
    return f"CASE {selector} {arms} END"


def _fill(columns: list[str], known: dict[str, str], kind: str = "STRING") -> dict[str, str]:
    return {c: known.get(c, f"CAST(NULL AS {kind})") for c in columns}


STATUSES = [
    flags.DROPPED, flags.NO_SHOW, flags.NOT_JOINED, flags.COMPLETED, flags.LEFT_EARLY, flags.ONGOING,
    flags.CANCELLED, flags.INVITED, None,
]
SITUATIONS = [
    flags.SHORT_JOB, flags.BACK_TO_WORK, flags.LASTING_JOB, flags.LONG_JOB, "Reprise d'activité",
    "Recherche d'emploi", None,
]

BENEF = _fill(
    BENEF_COLUMNS,
    {
        "id_benef": "o_orderkey",
        "nom": "c_name",
        "ide": "'IDE' || CAST(o_custkey AS STRING)",
        "agence": "n_name",
        "conseiller": "'CONS' || CAST(o_custkey % 50 AS STRING)",
        "referent": "'REF' || CAST(o_custkey % 20 AS STRING)",
        "id_ref_principal": "o_custkey % 20",
        "numero_commande": "'CMD' || CAST(o_orderkey AS STRING)",
        "date_demarrage": "CAST(o_orderdate AS DATE)",
        "date_fin_theo": "CAST(CAST(o_orderdate AS DATE) + INTERVAL 180 DAY AS DATE)",
        "date_fin_prest": (
            "CASE WHEN o_orderstatus <> 'O' THEN CAST(CAST(o_orderdate AS DATE) + INTERVAL 90 DAY AS DATE) END"
        ),
        "lot": (
            "CASE WHEN o_orderkey % 97 = 3 THEN NULL WHEN o_orderkey % 89 = 5 THEN 'ATC' "
            "ELSE CASE o_custkey % 4 WHEN 0 THEN 'ATC' WHEN 1 THEN 'ATR' WHEN 2 THEN 'ESPR' ELSE 'XXX' END "
            "|| ' ' || r_name || ' ' || n_name END"
        ),
        "site": "'SITE' || CAST(o_custkey % 7 AS STRING)",
        "id_site": "o_custkey % 7",
        "organisme": "'ORG' || CAST(c_nationkey AS STRING)",
        "statut": _choice("o_orderkey % 9", STATUSES),
        "situation": _choice("o_orderkey % 7", SITUATIONS),
        "suivi": "'SUIVI' || CAST(o_orderkey % 3 AS STRING)",
        "util_exclu_factu": "CASE WHEN o_orderkey % 11 = 0 THEN 'UTIL' || CAST(o_custkey % 5 AS STRING) END",
        "date_exclu_factu": "CASE WHEN o_orderkey % 11 = 0 THEN CAST(o_orderdate AS DATE) END",
    },
)
BENEF_FROM = (
    "orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey "
    "JOIN region ON n_regionkey = r_regionkey"
)

RDV = _fill(
    RDV_COLUMNS,
    {
        "id_benef": (
            "CASE WHEN l_orderkey % 211 = 5 THEN NULL WHEN l_orderkey % 101 = 7 THEN l_orderkey + 1000000000 "
            "ELSE l_orderkey END"
        ),
        "id_rdv": "l_orderkey * 8 + l_linenumber",
        "date_deb": "{add_hours}",
        "date_fin": "{add_minutes}",
        "type": "l_linestatus",
        "typage": "CASE l_returnflag WHEN 'A' THEN 'Entretien de diagnostic' "
        "WHEN 'N' THEN 'ENTRETIEN DE VALIDATION' ELSE 'Atelier' END",
        "objet": "'OBJ' || CAST(l_partkey % 9 AS STRING)",
        "referent": "CASE WHEN l_suppkey % 37 <> 0 THEN 'REF' || CAST(l_suppkey % 20 AS STRING) END",
        "id_referent": "l_suppkey % 20",
        "site": "'SITE' || CAST(l_partkey % 7 AS STRING)",
        "id_site": "l_partkey % 7",
        "present": "CASE l_linenumber % 5 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 9 END",
        "precision_rdv": "'P' || CAST(l_partkey % 3 AS STRING)",
    },
)

FACTURE = {
    "id_benef": "l_orderkey",
    "type_facture": "l_returnflag",
    "date_facture": "CAST(l_shipdate AS DATE)",
    "montant_HT": (
        "CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))), 2) "
        "AS DECIMAL(18,2))"
    ),
    "montant_TVA": (
        "CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)), 2) AS DECIMAL(18,2))"
    ),
    "num_facture": (
        "CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING)"
    ),
}

# Purchases are bonuses of the compiled sheet, all other events lines of the regional files. Order numbers
# repeat on purpose.
BONUS_SHEET = _fill(
    list(COMPILED_BONUS_COLUMNS.values()),
    {
        "Lot": "'LOT' || CAST(user_id % 6 AS STRING)",
        "Site": "'SITE' || CAST(user_id % 7 AS STRING)",
        "LC": "CASE WHEN event_id % 41 <> 0 THEN 'CMD' || CAST(FLOOR(event_id / 3.0) * 4 AS BIGINT) END",
        "CIP": "'REF' || CAST(user_id % 20 AS STRING)",
        "Date_primes": "CASE WHEN event_id % 17 <> 0 THEN {days_back} END",
        "Montant_prime": "CAST(value AS DECIMAL(18,2))",
        "Motif": "props",
        "Statut": "event_type",
        "ANNE_PRIME": "CAST(year(ts) AS STRING)",
        "MOIS_PRIME": "CAST(month(ts) AS STRING)",
    },
)

# The six regional files: title of the lot per file.
LOT_TITLES = ["Lot 1 CVL", "Lot 2 GUAD", "Lot 3 GUAD", "Lot 4 GUAD", "Lot GDEST", "Lot 6 IDF"]


def _bonus_file(number: int) -> dict[str, str]:
    return _fill(
        BONUS_LINE_COLUMNS,
        {
            "LC": "CASE WHEN event_id % 43 <> 0 THEN 'CMD' || CAST(FLOOR(event_id / 4.0) * 6 AS BIGINT) END",
            "Numero de commande": "'N' || CAST(event_id AS STRING)",
            "Numéro du lot": "'1' || CAST(user_id % 10 AS STRING)",
            "Intitulé du lot": f"CASE WHEN event_id % 13 = 0 THEN 'Lot 9 AUTRE' ELSE '{LOT_TITLES[number]}' END",
            "Numéro de marché": "'M' || CAST(user_id % 4 AS STRING)",
            "Date de debut": "CAST(ts AS DATE)",
            "Raison sociale titulaire": "'ORG' || CAST(user_id % 9 AS STRING)",
            "Identifiant local": "'L' || CAST(user_id AS STRING)",
            "Statut de la prestation": "event_type",
            "Montant facturé": "CAST(value AS DECIMAL(18,2))",
            "Date détection prime": "CASE WHEN event_id % 5 <> 0 THEN {days_back} END",
        },
    )


BUSINESS_UNITS = {
    "BRANCHE": "p_brand",
    "CODE_BU": "'BU' || CAST(p_partkey % 50 AS STRING)",
    "BU_LIBELLE": "p_type",
    "ANNEE": "2020 + p_partkey % 5",
    "MOIS": "p_size % 12 + 1",
    "TYPE": "CASE WHEN p_size % 2 = 0 THEN 'REEL' ELSE 'BUDGET' END",
    "CODE_RUBRIQUE": "'R' || CAST(p_size AS STRING)",
    "RUBRIQUE_LIBELLE": "p_name",
    "VALEUR": "p_retailprice",
}

ENTITIES = _fill(
    ENTITY_COLUMNS,
    {
        "ID": "CAST(s_suppkey AS STRING)",
        "Libelle": "s_name",
        "Libelle_Court": "'E' || CAST(s_suppkey % 10 AS STRING)",
        "Libelle_Lieu": "'LIEU' || CAST(s_nationkey AS STRING)",
        "Code_Analytique": "CAST(s_nationkey AS STRING)",
    },
)

# Decimals are compared exactly, as the text of a whole number of billionths.
EXACT_SCALE = 9


def exact(column: str) -> str:
    """The check SQL form of a decimal."""
    return f"CAST(CAST(CAST({column} AS DECIMAL(28,{EXACT_SCALE})) * {10**EXACT_SCALE} AS HUGEINT) AS VARCHAR)"


def dialect(text: str, engine: str) -> str:
    """Fill the marks in which Spark and DuckDB differ."""
    start = {
        "spark": "timestampadd(HOUR, CAST(l_linenumber AS INT), l_shipdate)",
        "duckdb": "l_shipdate + to_hours(CAST(l_linenumber AS BIGINT))",
    }[engine]
    marks = {
        "spark": {
            "{add_minutes}": f"timestampadd(SECOND, 30, timestampadd(MINUTE, CAST(l_quantity AS INT), {start}))",
            "{days_back}": "date_sub(CAST(ts AS DATE), CAST(event_id % 2500 AS INT))",
        },
        "duckdb": {
            "{add_minutes}": f"{start} + to_minutes(CAST(l_quantity AS BIGINT)) + INTERVAL 30 SECOND",
            "{days_back}": "CAST(CAST(ts AS DATE) - CAST(event_id % 2500 AS INTEGER) AS DATE)",
        },
    }[engine]
    for mark, value in (marks | {"{add_hours}": start}).items():
        text = text.replace(mark, value)
    return text


def projection(columns: dict[str, str], engine: str) -> list[str]:
    quote = "`" if engine == "spark" else '"'
    return [f"{dialect(expr, engine)} AS {quote}{name}{quote}" for name, expr in columns.items()]


def benef(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer, nation, region = (read(spark, sf_dir, t) for t in ("orders", "customer", "nation", "region"))
    joined = (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return joined.selectExpr(*projection(BENEF, "spark"))


def rdv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").selectExpr(*projection(RDV, "spark"))


def facture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").selectExpr(*projection(FACTURE, "spark"))


def bonus_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    bought = read(spark, sf_dir, "events").filter("event_type = 'purchase'")
    return bought.selectExpr(*projection(BONUS_SHEET, "spark"))


def bonus_files(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    events = read(spark, sf_dir, "events").filter("event_type <> 'purchase'")
    return [
        events.filter(f"event_id % 6 = {i}").selectExpr(*projection(_bonus_file(i), "spark"))
        for i in range(len(LOT_TITLES))
    ]


def business_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").selectExpr(*projection(BUSINESS_UNITS, "spark"))


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "supplier").selectExpr(*projection(ENTITIES, "spark"))


# Company of a session or enrolment by its number, and the raw table it lands in.
SESSION_TABLES = ["Presence_Soc_2", "Presence_Soc_3", "Presence_Soc_4"]
ENROLMENT_TABLES = ["Inscrite_Soc_2", "Inscrite_Soc_3"]

# One session per conversation turn, one personal slot per line of its text; system turns have no trainer.
SESSION = {
    "_id": "CAST(turn AS STRING)",
    "ID": "CAST(conv_id AS STRING) || '-' || CAST(turn AS STRING)",
    "Date": "timestampadd(HOUR, CAST(turn AS INT), timestampadd(DAY, CAST(conv_id % 365 AS INT), "
    "TIMESTAMP_NTZ '2024-01-01 00:00:00'))",
    "Debut": "'09:00:00'",
    "Duree": "'07:00:00'",
    "Fin": "'17:00:00'",
    "IDModule": "conv_id % 40",
    "IDAction": "conv_id",
    "Libelle_Court": "'S' || CAST(conv_id % 10 AS STRING)",
    "Libelle": "'SESSION ' || CAST(conv_id AS STRING)",
    "Libelle_Action": "'ACTION ' || role",
    "Visibilite_stagiaire": "turn % 2 = 0",
    "IDLieu": "conv_id % 12",
    "Libelle_Lieu": "'LIEU' || CAST(conv_id % 12 AS STRING)",
    "Seances_Persos": """transform(split(text, '\\n'), (line, i) -> named_struct(
        '_id', CAST(i AS STRING), 'Debut', '09:00:00',
        'Duree', concat(lpad(CAST(length(line) % 8 AS STRING), 2, '0'), ':', lpad(CAST(length(line) % 60 AS STRING), 2, '0'), ':00'),
        'Fin', '17:00:00', 'Type_Seance', CAST(i % 3 AS BIGINT), 'Libelle_Type_Seance', concat('TYPE', CAST(i % 3 AS STRING)),
        'Debut_Absence', CAST(NULL AS STRING),
        'Duree_Absence', CASE WHEN i % 2 = 0 THEN '00:30:00' ELSE '00:00:00' END, 'Fin_Absence', CAST(NULL AS STRING),
        'IDTypAbsen', CASE WHEN i % 4 = 0 THEN CAST(i AS STRING) END, 'LTypAbsen', '',
        'Libelle_Court', concat('L', CAST(i % 5 AS STRING)), 'Libelle', line, 'Module_Prevu', '', 'Personnalisee', 'NON',
        'Distancielle', i % 2 = 1, 'Seance_Action_Principale', true,
        'Inscrit', named_struct('_id', '1', 'ID', conv_id * 10 + turn,
            'Stagiaire', named_struct('_id', '2', 'ID', conv_id, 'ID_Individu', conv_id + 5, 'Reference', concat('ST', CAST(conv_id AS STRING)),
                'Civilite', 'Mme', 'Nom', concat('NOM', CAST(conv_id AS STRING)), 'Prenom', concat('PRENOM', CAST(turn AS STRING))),
            'Date_Entree', '2024-01-02T00:00:00', 'Date_Sortie', '2024-12-31T00:00:00', 'IDParcours_Groupe', conv_id % 6,
            'Libelle_Parcours_Groupe', 'PG', 'Libelle_Court_Parcours_Groupe', concat('PG', CAST(conv_id % 6 AS STRING)),
            'Libelle_Parcours', concat('PARCOURS', CAST(conv_id % 4 AS STRING)), 'Libelle_Court_Parcours', concat('P', CAST(conv_id % 4 AS STRING)),
            'Code_Analytique_Parcours', concat('CA', CAST(conv_id % 9 AS STRING)), 'Code_Region', '11', 'Type_Region', 'REGION',
            'Convention', CASE WHEN conv_id % 3 = 1 THEN CAST(NULL AS STRING) ELSE concat('{"ID":', CAST(conv_id AS STRING),
                ',"_id":"7","Libelle":"CONV","Client":{"ID":', CAST(turn AS STRING), ',"Nom":"CLIENT"},"Financeur":{"ID":"x","Nom":"FIN"}}') END),
        'Signature', CAST(NULL AS STRING)))""",
    "Salles": "'[]'",
    "Materiels": "'[]'",
    "Intervenants": """CASE WHEN role = 'system' THEN filter(array(named_struct('_id', '', 'ID', 0L, 'Reference', '', 'Civilite', '', 'Nom', '',
        'Prenom', '', 'Signature', CAST(NULL AS STRING))), t -> false)
        WHEN turn % 4 = 3 THEN array(named_struct('_id', '3', 'ID', conv_id % 30, 'Reference', 'R1', 'Civilite', 'M', 'Nom', concat('TRAINER', CAST(conv_id % 30 AS STRING)),
        'Prenom', 'A', 'Signature', CAST(NULL AS STRING)), named_struct('_id', '4', 'ID', conv_id % 30 + 100, 'Reference', 'R2', 'Civilite', 'M',
        'Nom', concat('TRAINER', CAST(conv_id % 30 + 100 AS STRING)), 'Prenom', 'B', 'Signature', CAST(NULL AS STRING)))
        ELSE array(named_struct('_id', '3', 'ID', conv_id % 30, 'Reference', 'R1', 'Civilite', 'M', 'Nom', concat('TRAINER', CAST(conv_id % 30 AS STRING)),
        'Prenom', 'A', 'Signature', CAST(NULL AS STRING))) END""",
}


def sessions(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    turns = read(spark, sf_dir, "conversations")
    return {
        name: turns.filter(F.col("conv_id") % 3 == i).selectExpr(*projection(SESSION, "spark"))
        for i, name in enumerate(SESSION_TABLES)
    }


def _person_struct(fields: dict[str, str]) -> str:
    inner = ", ".join(f"'{name}', {expr}" for name, expr in fields.items())
    return f"named_struct({inner})"


def enrolments(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Customers as trainees; every fifth has no trainer."""
    empty = "CAST(NULL AS STRING)"
    contact = {f"{kind}_{place}": empty for place in ("Pro", "Perso") for kind in ("Email", "Telephone", "Mobile")}
    address = _person_struct(
        {"ID": "CAST(c_nationkey AS BIGINT)", "_id": "'9'", "NumRue": "CAST(c_custkey % 100 AS STRING)"}
        | {name: empty for name in ("Adr1", "Adr2", "Adr3", "Adr4", "Code_Postal", "Code_Insee")}
        | {"Ville": "concat('VILLE', CAST(c_nationkey AS STRING))", "Arrondissement": empty, "Pays": "'FR'"}
    )
    trainer = _person_struct(
        {"ID": "c_custkey % 17", "_id": "'5'", "ID_Individu": "c_custkey % 17 + 1000", "Civilite": "'M'",
         "Nom": "concat('TRAINER', CAST(c_custkey % 17 AS STRING))", "Prenom": "'A'", "NomJF": empty,
         "Date_Naissance": empty} | contact | {"Adresse": address}
    )
    trainee = _person_struct(
        {"ID": "c_custkey", "_id": "'6'", "ID_Individu": "c_custkey + 5", "Reference": "c_mktsegment", "Civilite": "'Mme'",
         "Nom": "c_name", "Prenom": "'B'", "Nom_Naissance": empty, "Date_Naissance": empty,
         "Identifiant_Utilisateur": empty, "Charge_Affaires": empty} | contact | {"Adresse": address}
    )
    columns = {
        "Code_Analytique_Parcours": "concat('CA', CAST(c_nationkey AS STRING))", "Type_Region": "'REGION'",
        "Code_Region": "CAST(c_nationkey AS STRING)", "Libelle_Court_Parcours": "c_mktsegment",
        "Libelle_Parcours_Groupe": empty, "ID": "c_custkey", "Libelle_Parcours": "c_mktsegment",
        "IDAction": "c_custkey % 9", "CIR": empty,
        "Date_Entree": "timestampadd(DAY, CAST(c_custkey % 300 AS INT), TIMESTAMP_NTZ '2024-01-01 08:30:00')",
        "Convention": empty, "Date_Sortie": empty, "Type_apprentissage": empty, "IDParcours_Groupe": "c_custkey % 6",
        "Date_Sortie_Previsionnelle": "TIMESTAMP_NTZ '2025-06-30 00:00:00'",
        "formateur_referent": f"CASE WHEN c_custkey % 5 <> 0 THEN {trainer} END",
        "stagiaire": trainee,
    }
    people = read(spark, sf_dir, "customer")
    return [
        people.filter(F.col("c_custkey") % len(ENROLMENT_TABLES) == i).selectExpr(*projection(columns, "spark"))
        for i in range(len(ENROLMENT_TABLES))
    ]


RAW = {
    "benef": benef,
    "rdv": rdv,
    "facture": facture,
    "bonus_files": bonus_files,
    "bonus_sheet": bonus_sheet,
    "sessions": sessions,
    "enrolments": enrolments,
    "business_units": business_units,
}


def source(spark: SparkSession, sf_dir: str) -> Source:
    """The raw tables over one folder of test tables, each opened when it is asked for."""
    return lambda name: RAW[name](spark, sf_dir)


def check_tables() -> str:
    """The same raw tables as a WITH list for DuckDB."""

    def select(columns: dict[str, str], source: str) -> str:
        return f"SELECT {', '.join(projection(columns, 'duckdb'))} FROM {source}"

    files = " UNION ALL ".join(
        f"({select(_bonus_file(i), 'events')} WHERE event_type <> 'purchase' AND event_id % 6 = {i})"
        for i in range(len(LOT_TITLES))
    )
    tables = {
        "benef": select(BENEF, BENEF_FROM),
        "rdv": select(RDV, "lineitem"),
        "facture": select(FACTURE, "lineitem"),
        "bonus_sheet": select(BONUS_SHEET, "events") + " WHERE event_type = 'purchase'",
        "bonus_files": files,
        "business_units": select(BUSINESS_UNITS, "part"),
    }
    return ", ".join(f"{name} AS ({sql})" for name, sql in tables.items())
