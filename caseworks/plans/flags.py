"""Status flags of a beneficiary, each written once and shared by every model.

Comparisons are case-sensitive, and a NULL status or situation follows SQL's three-valued logic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseworks.functions.text import after_first_token, token
from caseworks.functions.times import month_number

# Status labels of the source system.
DROPPED = "Demande sans suite"
NO_SHOW = "Ne s'est pas présenté"
NO_SHOW_LOWER = "ne s'est pas présenté"
NOT_JOINED = "N'a pas adhéré"
COMPLETED = "Prestation aboutie"
LEFT_EARLY = "Sortie anticipée"
ONGOING = "Prestation en cours"
CANCELLED = "Annulé"
INVITED = "convoqué"

# Situation labels of the source system.
SHORT_JOB = "Reprise d'emploi de moins de 6 mois"
BACK_TO_WORK = "Retour à l'emploi"
LASTING_JOB = "Emploi durable"
LONG_JOB = "Reprise d'emploi CDI ou CDD/CTT + de 6 mois + de 78h/mois"

# The markets the activity report keeps, and the day bonuses start to count from.
ACTIVITY_MARKETS = ("ATC", "ATR", "ESPR")
BONUS_START = "2021-01-01"

# Label per attendance code.
ATTENDANCE_LABELS = {1: "present", 0: "absent", 2: "annulé"}
ATTENDANCE_MISSING = "a catégoriser"
ATTENDANCE_OTHER = ""
PRESENT_CODE, OTHER_CODE = 1, -1


def status() -> Column:
    return F.col("statut")


def situation() -> Column:
    return F.col("situation")



def one_if(condition: Column, otherwise: int | None = None) -> Column:
    return F.when(condition, 1).otherwise(otherwise)


def active() -> Column:
    return F.when(status().isin(DROPPED, NO_SHOW), 0).otherwise(1)


def joined() -> Column:
    return F.when(status() == NOT_JOINED, 0).when(status().isin(COMPLETED, LEFT_EARLY, ONGOING), 1)


def not_joined() -> Column:
    return 1 - joined()


def oriented_listed() -> Column:
    """The adhesion report's list; its no-show label is in lower case, unlike the status itself."""
    return one_if(status().isin(COMPLETED, LEFT_EARLY, ONGOING, INVITED, DROPPED, NO_SHOW_LOWER))


def received_listed() -> Column:
    return one_if(status().isin(COMPLETED, LEFT_EARLY, ONGOING, INVITED, DROPPED))


def completed() -> Column:
    return one_if(status() == COMPLETED)


def oriented() -> Column:
    return one_if(~status().isin(DROPPED, CANCELLED))


def received() -> Column:
    return one_if(~status().isin(DROPPED, CANCELLED, NO_SHOW), otherwise=0)


def left_early_for_work() -> Column:
    """AND binds before OR, so a 'Retour...' situation counts whatever the status."""
    early = (status() == LEFT_EARLY) & (situation() != SHORT_JOB) & situation().startswith("Reprise")
    return one_if(early | situation().startswith("Retour"))


def completed_with_work() -> Column:
    return one_if((status() == COMPLETED) & (situation().startswith("Reprise") | situation().startswith("Retour")))


def completed_without_work() -> Column:
    return one_if((status() == COMPLETED) & ~situation().isin(SHORT_JOB, BACK_TO_WORK, LASTING_JOB, LONG_JOB))


def lasting_return() -> Column:
    return one_if(status().isin(COMPLETED, LEFT_EARLY) & (situation() == LONG_JOB))


def left_early() -> Column:
    return one_if(status() == LEFT_EARLY, otherwise=0)


def left_early_without_lasting_return() -> Column:
    return one_if((status() == LEFT_EARLY) & (situation() != LONG_JOB), otherwise=0)


def in_portfolio() -> Column:
    return one_if(F.col("date_fin_prest").isNull(), otherwise=0)


def lasting_return_or_bonus(bonus_day: Column) -> Column:
    counted = bonus_day.try_cast("date") >= F.lit(BONUS_START).cast("date")
    return one_if((F.col("retour_emploi") == 1) | counted, otherwise=0)


def attendance_code(code: Column) -> Column:
    """The known codes and NULL as they are, every other code as one."""
    return F.when(code.isNull() | code.isin(*ATTENDANCE_LABELS), code.cast("int")).otherwise(OTHER_CODE)


def attendance_label(code: Column) -> Column:
    label = F.when(code.isNull(), ATTENDANCE_MISSING)
    for value, name in ATTENDANCE_LABELS.items():
        label = label.when(code == value, name)
    return label.otherwise(ATTENDANCE_OTHER)


def with_lot_parts(benef: DataFrame) -> DataFrame:
    return benef.withColumns(
        {"marche": token("lot", 0), "lot_sans_action": after_first_token("lot")}
    )


def classified(benef: DataFrame) -> DataFrame:
    """The steering view of a beneficiary: identity, lot parts and every status flag.

    The column names are fixed values of the published table.
    """
    return benef.select(
        "id_benef", "nom", "ide", "agence", "conseiller", "referent", "id_ref_principal",
        "date_demarrage", "date_fin_theo", "date_fin_prest",
        token("lot", 0).alias("marche"),
        token("lot", 1).alias("region"),
        token("lot", 2).alias("lot_unique"),
        after_first_token("lot").alias("lot_sans_action"),
        "site", "id_site", "organisme", "statut", "situation",
        active().alias("activite"),
        joined().alias("adhesion"),
        not_joined().alias("non_adhere"),
        oriented().alias("oriente"),
        completed().alias("prime"),
        left_early_for_work().alias("sortie_anticipee_rep_emploi"),
        completed_with_work().alias("Prestation_aboutie_rep_emploi"),
        completed_without_work().alias("Prestation_aboutie"),
        lasting_return().alias("retour_emploi"),
        in_portfolio().alias("portefeuille"),
        left_early().alias("sortie_anticipee"),
        left_early_without_lasting_return().alias("sorties_anticipees_hors_sorties_positives"),
        received().alias("recu"),
        month_number("date_demarrage").alias("annee_mois_sort"),
    )
