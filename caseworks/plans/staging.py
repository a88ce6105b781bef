"""Staging: fixed column lists over the raw tables, renames and light cleaning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseworks.functions.times import as_datetime_text, clock_seconds, seconds_as_datetime_text
from caseworks.schemas import (
    BENEF_COLUMNS,
    BONUS_LINE_COLUMNS,
    COMPILED_BONUS_COLUMNS,
    CONVENTION_TYPE,
    ENROLMENT_FIELDS,
    ENTITY_COLUMNS,
    RDV_COLUMNS,
)

# Appointment kinds folded into one label.
DIAGNOSTIC_KINDS = ("entretien de diagnostic", "entretien de validation")
DIAGNOSTIC_LABEL = "Entretien de Diagnostic"


def beneficiaries(raw: DataFrame) -> DataFrame:
    return raw.select(*BENEF_COLUMNS)


def appointments(raw: DataFrame) -> DataFrame:
    """Appointments as published: times as text."""
    return timed_appointments(raw).withColumns({c: seconds_as_datetime_text(c) for c in ("date_deb", "date_fin")})


def timed_appointments(raw: DataFrame) -> DataFrame:
    """Appointments with times as seconds; plans group and rank on these and format them last."""
    changed = {
        "date_deb": clock_seconds("date_deb"),
        "date_fin": clock_seconds("date_fin"),
        "typage": F.when(F.lower("typage").isin(*DIAGNOSTIC_KINDS), DIAGNOSTIC_LABEL).otherwise(F.col("typage")),
    }
    # Columns that stay as they are get no name anew, so that plans that read this more than once have equal parts.
    return raw.select(*[changed[c].alias(c) if c in changed else c for c in RDV_COLUMNS])


def invoices(raw: DataFrame) -> DataFrame:
    return raw


def business_units(raw: DataFrame) -> DataFrame:
    """Code and label of the heading arrive swapped; one projection puts each under the other's name."""
    return raw.select(
        "BRANCHE", "CODE_BU", "BU_LIBELLE", "ANNEE", "MOIS", "TYPE",
        F.col("RUBRIQUE_LIBELLE").alias("CODE_RUBRIQUE"),
        F.col("CODE_RUBRIQUE").alias("RUBRIQUE_LIBELLE"),
        "VALEUR",
    )


def entities(raw: DataFrame) -> DataFrame:
    return raw.select(*ENTITY_COLUMNS)


def placements(raw: DataFrame) -> DataFrame:
    return raw


def bonus_lines(raw: DataFrame) -> DataFrame:
    return raw.select(*[F.col(f"`{c}`") for c in BONUS_LINE_COLUMNS])


def compiled_bonuses(raw: DataFrame) -> DataFrame:
    return raw.select(*[F.col(source).alias(name) for name, source in COMPILED_BONUS_COLUMNS.items()])


def enrolments(raw: DataFrame) -> DataFrame:
    """Two nested persons flattened to prefixed columns; a NULL person still gives its row."""
    dated = {"Date_Entree", "Date_Sortie_Previsionnelle"}
    return raw.select(
        *[
            (as_datetime_text(path) if path in dated else F.col(path)).alias(name)
            for name, path in ENROLMENT_FIELDS.items()
        ]
    )


def attendance(raw: DataFrame, source_table: str) -> DataFrame:
    """One row per session, personal slot and trainer; sessions without either vanish."""
    slots = raw.withColumn("seance", F.explode("Seances_persos")).withColumn("interv", F.explode("Intervenants"))
    # One shape for all companies: the agreement is JSON text, whether it came as an object or as a string.
    parsed = slots.withColumn("convention", F.from_json("seance.Inscrit.Convention", CONVENTION_TYPE))

    def texts(parent: str, fields: dict[str, str]) -> list[Column]:
        return [F.col(f"{parent}.{f}").cast("string").alias(name) for name, f in fields.items()]

    def numbers(parent: str, fields: dict[str, str]) -> list[Column]:
        return [F.col(f"{parent}.{f}").try_cast("bigint").alias(name) for name, f in fields.items()]

    slot, enrolment, person = "seance", "seance.Inscrit", "seance.Inscrit.Stagiaire"
    return parsed.select(
        F.coalesce("Materiels", F.lit("[]")).alias("materiels"),
        *texts(slot, {
            "seance_libelle": "Libelle", "seance_libelle_court": "Libelle_Court", "seance_internal_id": "_id",
            "module_prevu": "Module_Prevu", "type_seance": "Type_Seance", "libelle_type_seance": "Libelle_Type_Seance",
            "duree_seance": "Duree", "heure_debut": "Debut", "heure_fin_seance": "Fin",
        }),
        F.col("seance.Distancielle").alias("distancielle"),
        F.col("seance.Personnalisee").alias("personnalisee"),
        F.col("seance.Seance_Action_Principale").alias("seance_action_principale"),
        *texts(slot, {"signature": "Signature", "type_absence_libelle": "LTypAbsen"}),
        *numbers(slot, {"type_absence_id": "IDTypAbsen"}),
        *texts(slot, {"duree_absence": "Duree_Absence", "debut_absence": "Debut_Absence", "fin_absence": "Fin_Absence"}),
        *numbers(enrolment, {"inscription_id": "ID"}),
        *texts(enrolment, {
            "inscription_internal_id": "_id", "type_region": "Type_Region", "code_region": "Code_Region",
            "libelle_parcours": "Libelle_Parcours", "libelle_court_parcours": "Libelle_Court_Parcours",
            "libelle_parcours_groupe": "Libelle_Parcours_Groupe",
            "libelle_court_parcours_groupe": "Libelle_Court_Parcours_Groupe",
            "code_analytique_parcours": "Code_Analytique_Parcours",
        }),
        *numbers(enrolment, {"id_parcours_groupe": "IDParcours_Groupe"}),
        F.col("seance.Inscrit.Date_Entree").cast("date").alias("date_entree"),
        F.col("seance.Inscrit.Date_Sortie").cast("date").alias("date_sortie"),
        *numbers(person, {"stagiaire_id": "ID"}),
        *texts(person, {"stagiaire_internal_id": "_id"}),
        *numbers(person, {"stagiaire_individu_id": "ID_Individu"}),
        *texts(person, {
            "stagiaire_reference": "Reference", "stagiaire_civilite": "Civilite",
            "stagiaire_nom": "Nom", "stagiaire_prenom": "Prenom",
        }),
        *numbers("convention", {"convention_id": "ID"}),
        *texts("convention", {"convention_internal_id": "_id"}),
        *numbers("convention", {"convention_id_societe": "IDSociete"}),
        *texts("convention", {
            "convention_libelle": "Libelle", "convention_libelle2": "Libelle2", "convention_reference": "Reference",
            "convention_numero_interne": "Numero_interne", "convention_numero_financeur": "Numero_financeur",
        }),
        *[
            column
            for prefix, party in (("client", "convention.Client"), ("financeur", "convention.Financeur"))
            for column in (
                *numbers(party, {f"{prefix}_id": "ID"}),
                *texts(party, {f"{prefix}_internal_id": "_id", f"{prefix}_nom": "Nom", f"{prefix}_reference": "Reference"}),
            )
        ],
        F.coalesce("Salles", F.lit("[]")).alias("salles"),
        F.col("IDLieu").cast("bigint").alias("id_lieu"),
        F.col("Visibilite_stagiaire").alias("visibilite_stagiaire"),
        F.col("Libelle_Action").alias("libelle_action"),
        F.col("IDAction").alias("id_action"),
        F.col("Fin").alias("source_fin"),
        F.col("Libelle_Court").alias("source_libelle_court"),
        F.col("Duree").alias("source_duree"),
        F.col("Libelle_Lieu").alias("source_libelle_lieu"),
        F.col("Libelle").alias("source_libelle"),
        *numbers("interv", {"intervenant_id": "ID"}),
        *texts("interv", {
            "intervenant_internal_id": "_id", "intervenant_reference": "Reference", "intervenant_civilite": "Civilite",
            "intervenant_nom": "Nom", "intervenant_prenom": "Prenom", "intervenant_signature": "Signature",
        }),
        F.col("Debut").alias("source_debut"),
        F.col("IDModule").alias("id_module"),
        as_datetime_text("Date").alias("date_date"),
        F.col("ID").alias("source_id"),
        F.lit(source_table).alias("source_table"),
    )
