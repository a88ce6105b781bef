"""Appointments: attendees per slot, hours per counsellor, and entry and exit ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseworks.functions.times import month_number, seconds_as_date, seconds_as_datetime_text, whole_minutes
from caseworks.plans import flags

# Published columns of the appointment tables (``_code`` stands for the attendance label).
SLOT_KEYS = [
    "id_benef", "date_deb", "date_fin", "type", "typage", "referent", "id_referent", "site", "id_site", "_code",
    "precision_rdv",
]
BENEF_ATTRIBUTES = ["lot", "organisme", "statut", "situation", "suivi"]
PUBLIC_SLOT_COLUMNS = [
    "nb_de_personne_presente", "date_deb", "date_fin", "type", "typage", "referent", "id_referent", "site",
    "id_site", "presence", "lot_sans_action", "marche", "lot", "organisme", "tps_travail_ref",
]
BENEF_SLOT_COLUMNS = [
    "nb_de_personne_presente", "id_benef", *PUBLIC_SLOT_COLUMNS[1:], "statut", "situation", "precision_rdv", "suivi",
]
# A beneficiary's appointments with one counsellor on one day: the unit ranks are built from.
DAY_KEYS = ["id_benef", "_counsellor", "_day"]
NO_DAY, NO_DAY_SPAN = -(10**9), 10**8
TIE_BREAK = [c for c in SLOT_KEYS if c not in ("id_benef", "referent", "date_deb")]
MANY = 100_000  # rows of one beneficiary that a task takes; more are spread by day


def _planned_minutes() -> Column:
    return whole_minutes("date_deb", "date_fin")


def _worked_minutes() -> Column:
    return F.when(F.col("_code") == flags.PRESENT_CODE, _planned_minutes()).otherwise(F.lit(0).cast("bigint"))


def _coded(rdv: DataFrame) -> DataFrame:
    return rdv.withColumn("_code", flags.attendance_code(F.col("present")))


def _labelled(rows: DataFrame) -> DataFrame:
    """Published forms of what grouping and shuffling keep compact: labels, lot parts and texts."""
    return flags.with_lot_parts(rows).withColumns(
        {
            "tps_travail_ref": _worked_minutes(),
            "presence": flags.attendance_label(F.col("_code")),
            "date_deb": seconds_as_datetime_text("date_deb"),
            "date_fin": seconds_as_datetime_text("date_fin"),
        }
    )


def attendees_per_slot(rdv: DataFrame, benef: DataFrame) -> DataFrame:
    """How many beneficiaries share a slot; the beneficiary is not part of the grouping."""
    keys = [c for c in SLOT_KEYS if c not in ("id_benef", "precision_rdv")] + ["lot", "organisme"]
    seen = _coded(rdv).join(benef.select("id_benef", "lot", "organisme"), "id_benef", "left")
    counted = seen.groupBy(*keys).agg(F.count("id_benef").alias("nb_de_personne_presente"))
    return _labelled(counted).select(*PUBLIC_SLOT_COLUMNS)


def slots(rdv: DataFrame) -> DataFrame:
    """Distinct appointments of a beneficiary with their row count, before any join.

    Grouping on every slot key first spreads a beneficiary with very many rows over all tasks;
    grouping behind the join on ``id_benef`` would bring them into one.
    """
    return _coded(rdv).groupBy(*SLOT_KEYS).agg(F.count("id_benef").alias("_rows"))


def benef_attributes(benef: DataFrame) -> DataFrame:
    return benef.groupBy("id_benef", *BENEF_ATTRIBUTES).agg(F.count(F.lit(1)).alias("_copies"))


def _people() -> Column:
    return F.col("_rows") * F.coalesce("_copies", F.lit(1))


def benef_slots(rdv: DataFrame, benef: DataFrame) -> DataFrame:
    """Slots per beneficiary with status and follow-up: the counsellor's view."""
    joined = slots(rdv).join(benef_attributes(benef), "id_benef", "left")
    return _labelled(joined.withColumn("nb_de_personne_presente", _people())).select(*BENEF_SLOT_COLUMNS)


def slots_per_day(known: DataFrame) -> DataFrame:
    """Slot count per beneficiary, counsellor and day.

    Reading ``_rows`` keeps this branch on the very exchange that ``known`` itself uses.
    """
    return known.groupBy(*DAY_KEYS).agg(F.count_if(F.col("_rows") >= 0).alias("_in_day"))


def is_known() -> Column:
    """Real beneficiaries; id 0 and NULL are placeholders and may hold very many rows.

    NULL is named, though it equals nothing: plans that differ in what Spark infers do not share their shuffles.
    """
    return F.col("id_benef").isNotNull() & (F.col("id_benef") != 0)


def by_day(slot_rows: DataFrame) -> DataFrame:
    """Slots with their NULL-free day keys.

    Slots without a start come before all days. They are ordered by their end first, so they are dealt by the day of
    their end; what has neither is one slot per set of its other columns.
    """
    undated = F.coalesce(F.floor(F.col("date_fin") / 86400), F.lit(-NO_DAY_SPAN))
    return slot_rows.withColumns(
        {
            "_counsellor": F.coalesce(F.concat(F.lit("="), "referent"), F.lit("")),
            "_day": F.coalesce(F.floor(F.col("date_deb") / 86400), NO_DAY + undated),
        }
    )


def benef_pairs(benef: DataFrame) -> DataFrame:
    """Per beneficiary id: slot attributes beside each of its rows' end date, numbered by end date.

    One row per id as long as ids are unique; the numbering keeps repeated ids right as well. Dealt by id once, for
    grouping, join and numbering.
    """
    known = benef.filter(is_known()).repartition("id_benef")
    per_id = Window.partitionBy("id_benef")
    attributes = benef_attributes(known).withColumn("_variants", F.count(F.lit(1)).over(per_id))
    numbered = per_id.orderBy("date_fin_prest", *BENEF_ATTRIBUTES)
    return attributes.join(known.select("id_benef", "date_fin_prest"), "id_benef").withColumns(
        {"_pair": F.row_number().over(numbered), "_pairs": F.count(F.lit(1)).over(per_id)}
    )


def numerous(rows: DataFrame) -> DataFrame:
    """Beneficiaries with more than ``MANY`` rows: few, however large the table."""
    return rows.filter(is_known()).groupBy("id_benef").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > MANY).select("id_benef")


def by_size(rows: DataFrame, many: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of most beneficiaries, and of those that ``many`` names."""
    return tuple(rows.join(F.broadcast(many), "id_benef", how) for how in ("left_anti", "left_semi"))


def ranked_together(rdv: DataFrame, facts: DataFrame) -> DataFrame:
    """Slots as :func:`ranked_slots` gives them, each beneficiary's in one task: no more than ``MANY`` rows each.

    The wide rows are shuffled once, by beneficiary, for grouping, ranks and facts; their order over days is that of the
    entry times. ``_slots`` counts a beneficiary's slots.
    """
    pair = Window.partitionBy("id_benef", "referent")
    placed = slots(rdv.repartition("id_benef"))
    placed = placed.withColumn("_place", F.row_number().over(pair.orderBy("date_deb", *TIE_BREAK)))
    placed = placed.withColumn("_total", F.count(F.lit(1)).over(pair))
    placed = placed.withColumn("_slots", F.count(F.lit(1)).over(Window.partitionBy("id_benef")))
    return _ranked(placed.join(facts, "id_benef", "left"), F.col("_place"))


def ranked_slots(rdv: DataFrame, facts: DataFrame) -> DataFrame:
    """Slots with their beneficiary facts, entry rank and exit rank.

    Ranks run per (counsellor, beneficiary). A rank is the place within the day plus the slots of
    earlier days, so one pair with a huge number of appointments is sorted day by day, never in one
    task. Only day totals, at most one per calendar day, are gathered per pair. The facts travel on
    the day totals, so the wide slot rows are shuffled once for ranks and facts together.
    Ties: equal entry times by the slot's other columns; the exit order is by end date, then entry.
    """
    known = by_day(slots(rdv))
    per_day = slots_per_day(known)
    per_benef = per_day.groupBy("id_benef").agg(F.sum("_in_day").alias("_slots"))
    pair = Window.partitionBy("id_benef", "_counsellor")
    earlier = pair.orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    days = per_day.withColumns(
        {
            "_before": F.coalesce(F.sum("_in_day").over(earlier), F.lit(0)),
            "_total": F.sum("_in_day").over(pair),
        }
    ).join(per_benef.join(facts, "id_benef", "left"), "id_benef")

    in_day = Window.partitionBy(*DAY_KEYS).orderBy("date_deb", *TIE_BREAK)
    placed = known.withColumn("_place", F.row_number().over(in_day)).join(days.drop("_in_day"), DAY_KEYS)
    return _ranked(placed, F.col("_before") + F.col("_place"))


def _ranked(placed: DataFrame, place: Column) -> DataFrame:
    """Ranks from a slot's place among its pair's slots and the beneficiary facts."""
    number, copies = F.coalesce("_pair", F.lit(1)), F.coalesce("_pairs", F.lit(1))
    exit_rank = (number - 1) * F.col("_total") + place
    ranked = placed.withColumns(
        {
            "nb_de_personne_presente": _people(),
            "rang_entree": (place - 1) * copies + number,
            "rang_sortie": F.when(F.col("date_fin_prest").isNotNull(), exit_rank),
        }
    )
    return ranked.select(*KNOWN_COLUMNS)


KNOWN_COLUMNS = [
    *SLOT_KEYS, *BENEF_ATTRIBUTES, "nb_de_personne_presente", "rang_entree", "rang_sortie", "date_fin_prest", "_slots",
    "_variants",
]
SPREAD = "_spread"  # whether a slot's beneficiary has more than ``MANY`` rows


def known_slots(rdv: DataFrame, benef: DataFrame) -> DataFrame:
    """Slots of real beneficiaries with their facts and ranks, in the compact form that :func:`timed` completes."""
    most, many = by_size(rdv.filter(is_known()), numerous(rdv))
    facts = benef_pairs(benef)
    usual = ranked_together(most, facts).withColumn(SPREAD, F.lit(False))
    return usual.unionAll(ranked_slots(many, facts).withColumn(SPREAD, F.lit(True)))


def timed(known: DataFrame) -> DataFrame:
    """Known slots with planned and worked time, labels and texts."""
    return _labelled(
        known.withColumns(
            {
                "tps_travail_prevu": _planned_minutes(),
                "tps_travail_prevu_heure": _planned_minutes() / 60,
                "tps_travail_reel_heure": _worked_minutes() / 60,
                "annee_mois_sort": month_number(seconds_as_date("date_deb")),
            }
        )
    )


RANK_COLUMNS = [
    "tps_travail_prevu", "tps_travail_reel_heure", "tps_travail_prevu_heure", "rang_entree", "rang_sortie",
    "date_fin_prest", "annee_mois_sort",
]


def appointment_detail(known: DataFrame) -> DataFrame:
    """The known slots with planned and worked time and both ranks."""
    return timed(known).select(*BENEF_SLOT_COLUMNS, *RANK_COLUMNS)
