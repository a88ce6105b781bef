"""Bonuses: regional lines, compiled sheet, steering flags, portfolios, first bonus."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseworks.functions.text import token
from caseworks.operators.joins import left_join_hot_right
from caseworks.plans import flags, staging
from caseworks.plans.appointments import is_known

# Region marks inside the lot title, and the region given to the eastern lot.
REGION_MARKS = ("CVL", "IDF", "GUAD")
EAST_MARK, EAST_REGION = "GDEST", "GE"

# Header of the regional files per output column.
BONUS_LINE_NAMES = {
    "lot_unique": "Numéro du lot",
    "numero_marche": "Numéro de marché",
    "date_deb": "Date de debut",
    "date_fin": "Date de fin",
    "organisme": "Raison sociale titulaire",
    "id_local": "Identifiant local",
    "resultat_declare": "Resultat déclaré",
    "statut_presta": "Statut de la prestation",
    "lib_statut_presta": "Libelle du statut de la prestation",
    "date_der_statut": "Date de dernier statut",
    "DPAE": "DPAE",
    "DSN": "DSN",
    "situation_DE": "Situation DE",
    "montant_facture": "Montant facturé",
    "refaction": "Réfaction",
    "certificat_emis": "Certificat émis",
    "date_detection_prime": "Date détection prime",
    "date_detection_complement": "Date détection complément",
    "numero_de_commande": "Numero de commande",
    "LC": "LC",
}


def all_regions(files: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [staging.bonus_lines(f) for f in files])


def _region() -> Column:
    title = F.col("`Intitulé du lot`")
    marked = reduce(Column.__or__, [title.contains(mark) for mark in REGION_MARKS])
    return F.when(marked, token(title, 2)).when(title.contains(EAST_MARK), EAST_REGION)


def _order_ids(benef: DataFrame) -> DataFrame:
    return benef.select(F.col("numero_commande").alias("LC"), "id_benef")


def bonus_lines(files: list[DataFrame], benef: DataFrame) -> DataFrame:
    """Regional bonus lines with their region and, by order number, their beneficiary."""
    named = {name: F.col(f"`{header}`").alias(name) for name, header in BONUS_LINE_NAMES.items()}
    first = named.pop("lot_unique")
    lines = all_regions(files).select(first, _region().alias("region"), *named.values())
    return lines.join(_order_ids(benef), "LC", "left").select("lot_unique", "region", *named, "id_benef")


def compiled_bonuses(sheet: DataFrame, benef: DataFrame) -> DataFrame:
    staged = staging.compiled_bonuses(sheet)
    return staged.join(_order_ids(benef), "LC", "left").select(*staged.columns, "id_benef")


def steering_flags(files: list[DataFrame], benef: DataFrame) -> DataFrame:
    """Status flags beside each bonus line; a beneficiary with several lines has several rows."""
    found = bonus_lines(files, benef).filter(F.col("id_benef").isNotNull())
    people = flags.classified(benef).drop("sorties_anticipees_hors_sorties_positives")
    return left_join_hot_right(people, found.select("id_benef", "date_detection_prime"), "id_benef").withColumn(
        "retour_emploi_env_semap", flags.lasting_return_or_bonus(F.col("date_detection_prime"))
    )


def portfolios(files: list[DataFrame], benef: DataFrame) -> DataFrame:
    """Open cases per counsellor; a case counts once per bonus line it has, at least once.

    Lines are counted per order number before they meet the beneficiaries, so no line row is joined.
    """
    per_order = all_regions(files).groupBy("LC").agg(F.count(F.lit(1)).alias("_lines"))
    per_benef = per_order.join(_order_ids(benef), "LC").groupBy("id_benef").agg(F.sum("_lines").alias("_lines"))
    keys = ["referent", "marche", "region", "lot_unique", "site", "statut"]
    return (
        flags.classified(benef)
        .filter((F.col("portefeuille") == 1) & (F.col("statut") == flags.ONGOING))
        .join(per_benef, "id_benef", "left")
        .groupBy(*keys)
        .agg(F.sum(F.coalesce("_lines", F.lit(1))).alias("candidats_en_portefeuille"))
        .orderBy("referent")
    )


def first_bonus(rdv: DataFrame, bonuses: DataFrame) -> DataFrame:
    """Earliest bonus above 1 of every beneficiary who has an appointment; an undated one comes first.

    Bonuses are shown on a counsellor's first slot with the beneficiary, and everyone with a slot has
    such a first slot. So the bonus follows from the bonus sheet and the set of ids with an
    appointment; the ranks need not be built.
    """
    met = rdv.filter(is_known()).select("id_benef").distinct()
    return (
        bonuses
        .filter((F.col("Montant_prime") > 1) & F.col("id_benef").isNotNull())
        .groupBy("id_benef")
        .agg(F.min(F.struct("Date_primes", "Montant_prime")).alias("first"))
        .join(met, "id_benef", "left_semi")
        .select("id_benef", "first.Montant_prime", "first.Date_primes")
    )


def steering(rdv: DataFrame, benef: DataFrame, bonuses: DataFrame) -> DataFrame:
    """Status flags of every beneficiary with the first bonus."""
    people = flags.classified(benef)
    bonus = first_bonus(rdv, bonuses)
    return people.join(bonus, "id_benef", "left").select(
        *people.columns,
        flags.lasting_return_or_bonus(F.col("Date_primes")).alias("retour_emploi_env_semap"),
        "Montant_prime",
        "Date_primes",
    )
