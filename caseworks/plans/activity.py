"""Activity and adhesion of beneficiaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseworks.plans import flags

# Published columns of both tables.
ACTIVITY_KEYS = [
    "id_benef", "numero_commande", "date_demarrage", "date_fin_prest", "date_fin_theo", "marche",
    "lot_sans_action", "organisme", "site", "statut", "situation", "referent",
]
ADHESION_COLUMNS = [
    "id_benef", "nom", "ide", "agence", "conseiller", "referent", "id_ref_principal", "date_demarrage",
    "date_fin_theo", "date_fin_prest", "marche", "lot", "lot_sans_action", "site", "id_site", "organisme",
    "statut", "situation",
]


def activity(benef: DataFrame) -> DataFrame:
    """Activity, adhesion and non-adhesion counts of the reported markets."""
    return (
        flags.with_lot_parts(benef)
        .filter(F.col("marche").isin(*flags.ACTIVITY_MARKETS))
        .withColumns({"activite": flags.active(), "adhesion": flags.joined(), "non_adhere": flags.not_joined()})
        .groupBy(*ACTIVITY_KEYS)
        .agg(*[F.sum(c).alias(c) for c in ("activite", "adhesion", "non_adhere")])
    )


def adhesion(benef: DataFrame) -> DataFrame:
    """Row-level adhesion flags."""
    return flags.with_lot_parts(benef).select(
        *ADHESION_COLUMNS,
        flags.active().alias("activite"),
        flags.joined().alias("adhesion"),
        flags.not_joined().alias("non_adhere"),
        flags.oriented_listed().alias("oriente"),
        flags.received_listed().alias("recu"),
        flags.completed().alias("prime"),
    )
