"""The decision tables by name, built from raw tables that a source looks up, and their publication.

A table names its inputs: raw tables, or steps that several tables share. One table alone is one lazy plan. Where
several are published together, a step that two or more of them read is written once and removed after its last reader.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseworks.plans import activity, appointments, attendance, bonus, revenue, staging
from caseworks.session import remove_folder, shared_folder, shuffles_removed
from caseworks.sources import landing

# Looks up a raw input by name; only the inputs a table needs are opened. Known names:
#   benef, rdv, facture, bonus_sheet, business_units -> DataFrame
#   bonus_files, enrolments -> list of DataFrames; sessions -> {raw table name: DataFrame}
Source = Callable[[str], Any]

PREPARE = {
    "benef": staging.beneficiaries,
    "rdv": staging.timed_appointments,
    "facture": staging.invoices,
    "business_units": staging.business_units,
}


@dataclass(frozen=True)
class Step:
    """A table with the names of the inputs it is built from; called with a source, it gives its lazy plan."""

    build: Callable[..., DataFrame]
    inputs: tuple[str, ...]

    def __call__(self, source: Source) -> DataFrame:
        return self.build(*map(_prepared(source), self.inputs))


def _staged(build: Callable[..., DataFrame], *names: str) -> Step:
    return Step(build, names)


# Steps that several tables read.
SHARED: dict[str, Step] = {
    "known_slots": _staged(appointments.known_slots, "rdv", "benef"),
    "bonuses": _staged(bonus.compiled_bonuses, "bonus_sheet", "benef"),
}

# Steps that are stored by a key, so that no reader has to shuffle them to join on it: the key, and the column that
# says which rows are kept apart and read in any parts, as their key is too frequent for one task.
STORED_BY = {"known_slots": ("id_benef", appointments.SPREAD)}


def _prepared(source: Source, stored: dict[str, DataFrame] | None = None) -> Source:
    """Looks up prepared inputs, each opened once: stored steps as they are, other steps and raw tables as plans."""
    found = dict(stored or {})

    def lookup(name: str) -> Any:
        if name not in found:
            if name in SHARED:
                found[name] = SHARED[name].build(*map(lookup, SHARED[name].inputs))
            else:
                found[name] = PREPARE.get(name, lambda table: table)(source(name))
        return found[name]

    return lookup


MARTS: dict[str, Step] = {
    "mrt_activite": _staged(activity.activity, "benef"),
    "mrt_adhesion": _staged(activity.adhesion, "benef"),
    "mrt_adv_facture": _staged(revenue.invoice_delay, "facture", "benef"),
    "mrt_benef_ca_prime": _staged(revenue.revenue_with_bonus, "facture", "benef", "bonuses"),
    "mrt_facture": _staged(revenue.invoices_with_counsellor, "facture", "benef"),
    "mrt_formateur_portefeuille": _staged(bonus.portfolios, "bonus_files", "benef"),
    "mrt_pilotage": _staged(bonus.steering, "rdv", "benef", "bonuses"),
    "mrt_presence": _staged(attendance.attendance, "sessions"),
    "mrt_prime": _staged(bonus.bonus_lines, "bonus_files", "benef"),
    "mrt_rdv": _staged(appointments.attendees_per_slot, "rdv", "benef"),
    "mrt_rdv_detail": _staged(appointments.appointment_detail, "known_slots"),
    "mrt_referent_Ca": _staged(revenue.revenue_lines, "facture", "benef"),
    "mrt_referent_rdv_ca": _staged(revenue.revenue_per_appointment, "known_slots", "benef", "facture", "bonuses"),
    "BDD_BU_SECURE": _staged(lambda table: table, "business_units"),
}

# Steps that are tables of their own in the flow, without being published.
INTERMEDIATE: dict[str, Step] = {
    "inscrite_union": _staged(attendance.enrolments, "enrolments"),
    "prime_union_region": _staged(bonus.all_regions, "bonus_files"),
    "prime_clean": SHARED["bonuses"],
    "pilotage_flags": _staged(bonus.steering_flags, "bonus_files", "benef"),
    "rdv_formateur": _staged(appointments.benef_slots, "rdv", "benef"),
}


class Stored:
    """A step's rows in the shared folder, until they are removed."""

    def __init__(self, plan: DataFrame, step: str):
        self.plan, self.step = plan, step
        self.spark = plan.sparkSession
        name = f"{step}_{uuid.uuid4().hex}"
        self.folder, self.table = f"{shared_folder(self.spark)}/{name}", f"spark_catalog.default.{name}"

    def write(self) -> DataFrame:
        with shuffles_removed(self.spark):
            writer = self.plan.write.option("compression", "zstd")
            if self.step not in STORED_BY:
                writer.parquet(self.folder)
                return self.spark.read.schema(self.plan.schema).parquet(self.folder)
            key, apart = STORED_BY[self.step]
            # As many buckets as a shuffle has partitions: other rows are dealt alike when they meet these.
            buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            writer = writer.format("parquet").option("path", self.folder).partitionBy(apart).bucketBy(buckets, key)
            writer.sortBy(key).saveAsTable(self.table)
            files = self.spark.read.schema(self.plan.schema).parquet(self.folder)
            return self.spark.table(self.table).filter(~F.col(apart)).unionAll(files.filter(apart))

    def remove(self) -> None:
        if self.step in STORED_BY:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
        remove_folder(self.spark, self.folder)


def publish(source: Source, path: str, names: Iterable[str] = MARTS, keep: int = 0) -> None:
    """Write the named decision tables under ``path``, each taking the place of its former state in one step. A table
    whose plan fails keeps its former state. ``sources.tables.read`` reads them; ``keep`` former versions stay.

    Steps that several of them read lie in the shared folder from their first reader to their last.
    """
    names = list(dict.fromkeys(names))
    readers = {step: [n for n in names if step in MARTS[n].inputs] for step in SHARED}
    stored: dict[str, DataFrame] = {}
    kept: dict[str, Stored] = {}
    try:
        for name in names:
            for step in MARTS[name].inputs:
                if len(readers.get(step, ())) > 1 and step not in stored:
                    kept[step] = Stored(_prepared(source, stored)(step), step)
                    stored[step] = kept[step].write()
            table = MARTS[name].build(*map(_prepared(source, stored), MARTS[name].inputs))
            with shuffles_removed(table.sparkSession):
                landing.replace(table, f"{path}/{name}", keep=keep)
            for step in [s for s in stored if readers[s][-1] == name and s in kept]:
                kept.pop(step).remove()
    finally:
        for left in kept.values():
            left.remove()
