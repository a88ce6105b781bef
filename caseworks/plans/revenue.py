"""Invoices and revenue per beneficiary, counsellor and appointment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseworks.operators.joins import full_join_hot_left, left_join_hot_right
from caseworks.plans import appointments as apt
from caseworks.plans import bonus, flags
from caseworks.plans.activity import ADHESION_COLUMNS

OWNER_KEYS = [
    "id_benef", "referent", "date_demarrage", "date_fin_prest", "marche", "region", "lot_unique", "organisme",
    "statut", "situation", "site",
]
INVOICE_FIELDS = ["type_facture", "date_facture", "montant_HT", "montant_TVA", "num_facture"]


def invoices_with_counsellor(facture: DataFrame, benef: DataFrame) -> DataFrame:
    added = ["agence", "conseiller", "referent", "numero_commande", "date_demarrage", "date_fin_prest"]
    return facture.join(benef.select("id_benef", *added), "id_benef", "left").select(*facture.columns, *added)


def invoice_delay(facture: DataFrame, benef: DataFrame) -> DataFrame:
    """Invoices and beneficiaries, matched or not, with the days from end of service to invoice."""
    people = flags.with_lot_parts(benef).select(
        *ADHESION_COLUMNS,
        "util_exclu_factu",
        "date_exclu_factu",
        flags.active().alias("activite"),
        flags.joined().alias("adhesion"),
        flags.not_joined().alias("non_adhere"),
    )
    return full_join_hot_left(facture, people, "id_benef").select(
        *facture.columns,
        *[c for c in people.columns if c != "id_benef"],
        F.datediff("date_facture", "date_fin_prest").alias("nb_jour_fin_presta_paiment"),
    )


def owners(benef: DataFrame) -> DataFrame:
    """Whom revenue is reported on: the distinct steering rows, with the number of rows their id has (``_rows``).

    Bonus lines repeat steering rows without changing these columns, so they need no join here. Rows without an id
    have no common number and are not gathered for one.
    """
    rows = flags.classified(benef).groupBy(*OWNER_KEYS).agg(F.count(F.lit(1)).alias("_own"))
    nameless = F.when(F.col("id_benef").isNull(), F.xxhash64(*OWNER_KEYS))
    return rows.withColumn("_rows", F.sum("_own").over(Window.partitionBy("id_benef", nameless))).drop("_own")


def _once_per_row(matched: DataFrame) -> DataFrame:
    """An owner meets an invoice once per row its id has."""
    return matched.withColumn("_row", F.explode(F.sequence(F.lit(1).cast("bigint"), "_rows"))).drop("_row", "_rows")


def revenue_lines(facture: DataFrame, benef: DataFrame) -> DataFrame:
    """One row per owner and invoice; owners without an invoice stay."""
    bills = facture.select("id_benef", *INVOICE_FIELDS).withColumn("_billed", F.lit(True))
    rows = left_join_hot_right(owners(benef), bills, "id_benef")
    times = F.when(F.col("_billed"), F.col("_rows")).otherwise(F.lit(1).cast("bigint"))
    return _once_per_row(rows.withColumn("_rows", times)).select(*OWNER_KEYS, *INVOICE_FIELDS)


def _owner_totals(facture: DataFrame, benef: DataFrame) -> DataFrame:
    """Owners and their totals; invoices are summed per id before they meet their owner."""
    totals = facture.groupBy("id_benef").agg(
        F.max("date_facture").alias("date_facture"),
        F.sum("montant_HT").alias("_ht"),
        F.sum("montant_TVA").alias("_tva"),
    )
    times = F.col("_rows").cast("decimal(18,0)")
    return owners(benef).join(totals, "id_benef", "left").withColumns({"_ht": F.col("_ht") * times, "_tva": F.col("_tva") * times})


def _totals() -> list[Column]:
    return [
        F.max("date_facture").alias("date_facture"),
        F.max("region").alias("region"),
        F.sum("_ht").alias("CA_HT_total"),
        F.sum("_tva").alias("CA_TVA_total"),
    ]


def revenue_with_bonus(facture: DataFrame, benef: DataFrame, bonuses: DataFrame) -> DataFrame:
    """Revenue totals per owner beside each of the beneficiary's bonuses."""
    keys = [c for c in OWNER_KEYS if c != "region"]
    totals = _owner_totals(facture, benef).groupBy(*keys).agg(*_totals())
    owned = bonuses.filter(F.col("id_benef").isNotNull())
    return left_join_hot_right(totals, owned.select("id_benef", "Montant_prime", "Date_primes"), "id_benef").select(
        *keys, "date_facture", "region", "CA_HT_total", "CA_TVA_total", "Montant_prime", "Date_primes"
    )


def revenue_per_appointment(known: DataFrame, benef: DataFrame, facture: DataFrame, bonuses: DataFrame) -> DataFrame:
    """A beneficiary's revenue spread evenly over the known slots, with ranks and, on first slots, bonuses."""
    people = benef.filter(apt.is_known()).repartition("id_benef")
    revenue = _owner_totals(facture, people).groupBy("id_benef").agg(*_totals())
    bonuses = bonuses.select("id_benef", "Montant_prime", "Date_primes")
    most, more = apt.by_size(known.filter(~F.col(apt.SPREAD)), apt.numerous(bonuses))

    # Ids are never NULL here; most of them have their slots, revenue and bonuses in one task.
    together = most.join(revenue, "id_benef", "left").join(bonuses, "id_benef", "left")

    # Those with very many slots or bonuses are dealt by day, whatever they lie by: only days meet revenue and bonuses by id.
    spread = apt.by_day(known.filter(apt.SPREAD).unionAll(more)).repartition(*apt.DAY_KEYS)
    per_day = spread.select(*apt.DAY_KEYS).distinct().join(revenue, "id_benef", "left").join(bonuses, "id_benef", "left")
    spread = spread.join(per_day, apt.DAY_KEYS, "left")

    slot_count = (F.col("_slots") * F.coalesce("_variants", F.lit(1))).cast("double")
    columns = [
        *apt.BENEF_SLOT_COLUMNS,
        "date_facture",
        "region",
        (F.col("CA_HT_total").cast("double") / slot_count).alias("CA_HT_par_rdv"),
        (F.col("CA_TVA_total").cast("double") / slot_count).alias("CA_TVA_par_rdv"),
        *apt.RANK_COLUMNS,
        F.when(F.col("rang_entree") == 1, F.col("Montant_prime")).otherwise(0).alias("Montant_prime"),
        "Date_primes",
    ]
    return apt.timed(together).select(*columns).unionAll(apt.timed(spread).select(*columns))
