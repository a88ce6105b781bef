"""Training: attendance hours and enrolments."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseworks.functions.times import clock_minutes
from caseworks.plans import staging

# Published attendance columns after the type and duration columns.
SLOT_COLUMNS = ["duree_seance", "heure_debut", "heure_fin_seance", "distancielle", "personnalisee", "duree_absence"]
REST_COLUMNS = [
    "debut_absence", "fin_absence", "type_region", "libelle_parcours", "libelle_court_parcours",
    "libelle_court_parcours_groupe", "code_analytique_parcours", "date_entree", "date_sortie", "stagiaire_id",
    "stagiaire_nom", "source_libelle", "source_libelle_lieu", "intervenant_id", "intervenant_reference",
    "intervenant_nom", "source_debut", "source_fin", "source_duree", "id_module", "date_date",
]


def attendance(sessions: dict[str, DataFrame]) -> DataFrame:
    """Attendance of all companies; ``sessions`` maps a raw table's name to its rows.

    The published ``type_seance`` holds the short session label, as consumers of the report know it.
    """
    flat = reduce(DataFrame.unionByName, [staging.attendance(raw, name) for name, raw in sessions.items()])
    minutes = clock_minutes("duree_seance")
    return flat.select(
        F.col("seance_libelle_court").alias("type_seance"),
        "libelle_type_seance",
        minutes.alias("duree_seance_minutes"),
        (minutes / 60).alias("duree_seance_heures"),
        *SLOT_COLUMNS,
        (clock_minutes("duree_absence") / 60).alias("duree_absence_heures"),
        *REST_COLUMNS,
    )


def enrolments(tables: list[DataFrame]) -> DataFrame:
    """Enrolments of all companies that name a trainer."""
    flat = reduce(DataFrame.unionByName, [staging.enrolments(t) for t in tables])
    return flat.filter(F.col("fr_formateur_id").isNotNull())
