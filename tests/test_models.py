"""Decision tables on small hand-made tables, with repeated ids and one very frequent beneficiary."""

from __future__ import annotations

import datetime as dt
import random
import time
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import pandas as pd
import pytest
from compare import plain
from compare import rows as bag
from pyspark.sql import functions as F

from caseworks.plans import appointments, flags, marts
from caseworks.plans.marts import INTERMEDIATE, MARTS, publish
from caseworks.schemas import BENEF_COLUMNS, BONUS_LINE_COLUMNS, COMPILED_BONUS_COLUMNS, RDV_COLUMNS
from caseworks.session import CLEANUP_SETTING
from caseworks.sources.tables import read
from caseworks.workload import domain, registry
from caseworks.workload.mart_checks import mart_sql

BENEF_TYPES = {
    "id_benef": "bigint", "id_ref_principal": "bigint", "id_site": "bigint",
    **{c: "date" for c in ("date_demarrage", "date_fin_theo", "date_fin_prest", "date_exclu_factu")},
}
RDV_TYPES = {
    "id_benef": "bigint", "id_rdv": "bigint", "id_referent": "bigint", "id_site": "bigint", "present": "int",
    "date_deb": "timestamp_ntz", "date_fin": "timestamp_ntz",
}
FACTURE_TYPES = {
    "id_benef": "bigint", "type_facture": "string", "date_facture": "date", "montant_HT": "decimal(18,2)",
    "montant_TVA": "decimal(18,2)", "num_facture": "string",
}
SHEET_COLUMNS = list(COMPILED_BONUS_COLUMNS.values())
SHEET_TYPES = {"Date_primes": "date", "Montant_prime": "decimal(18,2)"}
FILE_TYPES = {"Date détection prime": "date", "Date de debut": "date", "Montant facturé": "decimal(18,2)"}


def day(n):
    return dt.date(2020, 6, 1) + dt.timedelta(days=n)


def raw_rows(repeat_ids: bool, seed: int = 3):
    pick = random.Random(seed)
    ids = list(range(0, 30))
    benef = []
    for i in ids + ([4, 4, 7, 9] if repeat_ids else []) + [None]:
        benef.append({
            "id_benef": i, "nom": f"N{i}", "referent": f"R{pick.randrange(3)}", "numero_commande": f"C{i}",
            "date_demarrage": day(pick.randrange(90)), "date_fin_prest": pick.choice([None, day(200 + pick.randrange(9))]),
            "lot": pick.choice(["ATC GE 1", "ATR IDF 2 x", "ESPR", None, "XXX A 3"]), "site": "S", "organisme": "O",
            "statut": pick.choice([*domain.STATUSES]), "situation": pick.choice([*domain.SITUATIONS]), "suivi": "F",
        })
    if repeat_ids:  # an exact copy as well
        benef.append(dict(benef[5]))
    rdv = []
    for n in range(400):
        i = 4 if n % 3 == 0 else pick.choice([*ids, None, 99])
        start = dt.datetime(2024, 3, 30) + dt.timedelta(hours=pick.randrange(60), seconds=pick.randrange(3))
        rdv.append({
            "id_benef": i, "id_rdv": n, "date_deb": pick.choice([start, start, None]),
            "date_fin": pick.choice([None, *[start + dt.timedelta(seconds=pick.randrange(4000))] * 5]), "type": pick.choice(["a", "b"]),
            "typage": pick.choice(["Entretien de VALIDATION", "x", None]),
            "referent": "R1" if n % 3 == 0 else pick.choice(["R1", "R2", None]),
            "id_referent": 1, "present": pick.choice([0, 1, 2, 7, 8, None]), "precision_rdv": pick.choice(["p", None]),
        })
    facture = [
        {"id_benef": 7 if n % 3 == 0 else pick.choice([*ids, None, 98]), "type_facture": "T", "date_facture": day(n),
         "montant_HT": pd.NA if n == 5 else pick.randrange(9000) / 100, "montant_TVA": pick.randrange(900) / 100,
         "num_facture": str(n)}
        for n in range(60)
    ]
    sheet = [
        {"LC": pick.choice([f"C{i}" for i in (4, 4, 5, 7, 8, 77)] + [None]), "CIP": "R", "Montant_prime": pick.choice([0.5, 1, 20, 30]),
         "Date_primes": pick.choice([None, day(pick.randrange(400))])}
        for _ in range(25)
    ]
    files = [
        [{"LC": pick.choice([f"C{i}" for i in (4, 9, 10, 88)] + [None]), "Intitulé du lot": title,
          "Date détection prime": pick.choice([None, day(pick.randrange(400))])} for _ in range(8)]
        for title in domain.LOT_TITLES
    ]
    return {"benef": benef, "rdv": rdv, "facture": facture, "bonus_sheet": sheet, "bonus_files": files}


def frame(spark, data, columns, types):
    schema = ", ".join(f"`{c}` {types.get(c, 'string')}" for c in columns)

    def value(row, name):
        v = row.get(name)
        if v is None or v is pd.NA:
            return None
        if types.get(name, "").startswith("decimal"):
            from decimal import Decimal

            return Decimal(str(v)).quantize(Decimal("0.01"))
        return v

    return spark.createDataFrame([tuple(value(r, c) for c in columns) for r in data], schema)


@pytest.fixture(scope="module", params=[False, True], ids=["unique_ids", "repeated_ids"])
def world(request, spark, tmp_path_factory):
    data = raw_rows(request.param)
    tables = {
        "benef": frame(spark, data["benef"], BENEF_COLUMNS, BENEF_TYPES),
        "rdv": frame(spark, data["rdv"], RDV_COLUMNS, RDV_TYPES),
        "facture": frame(spark, data["facture"], list(FACTURE_TYPES), FACTURE_TYPES),
        "bonus_sheet": frame(spark, data["bonus_sheet"], SHEET_COLUMNS, SHEET_TYPES),
        "bonus_files": [frame(spark, f, BONUS_LINE_COLUMNS, FILE_TYPES) for f in data["bonus_files"]],
    }
    folder = tmp_path_factory.mktemp("raw")
    con = duckdb.connect()
    for name, table in tables.items():
        if name == "bonus_files":
            from functools import reduce

            table = reduce(type(table[0]).unionAll, table)
        table.write.parquet(f"{folder}/{name}")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}/*.parquet'")
    return request.param, tables, con


def both(world, name):
    """Rows by column name from Spark and from the check SQL."""
    _, tables, con = world
    df = registry.portable((MARTS | INTERMEDIATE)[name](tables.__getitem__))
    sql = mart_sql()[name].replace(f"WITH {domain.check_tables()} ", "")
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    want = [dict(zip(names, r)) for r in cursor.fetchall()]
    got = [r.asDict() for r in df.collect()]
    assert sorted(df.columns) == sorted(names)
    return got, want


def as_bag(rows, without=()):
    return Counter(tuple((k, plain(v)) for k, v in sorted(r.items()) if k not in without) for r in rows)


PLAIN = [
    "mrt_activite", "mrt_adhesion", "mrt_adv_facture", "mrt_benef_ca_prime", "mrt_facture", "mrt_formateur_portefeuille",
    "mrt_pilotage", "mrt_prime", "mrt_rdv", "mrt_referent_Ca", "pilotage_flags", "prime_clean", "rdv_formateur",
]


@pytest.mark.parametrize("name", PLAIN)
def test_table_equals_its_plain_definition(world, name):
    got, want = both(world, name)
    assert got and as_bag(got) == as_bag(want)


# With repeated ids several orders satisfy a rank, so there the order itself is checked.
TIED = ("rang_entree", "rang_sortie", "Montant_prime")


@pytest.mark.parametrize("name", ["mrt_rdv_detail", "mrt_referent_rdv_ca"])
def test_ranked_table(world, name):
    repeated = world[0]
    got, want = both(world, name)
    assert got and as_bag(got, TIED if repeated else ()) == as_bag(want, TIED if repeated else ())


def test_ranks_follow_entry_and_end(world):
    got, _ = both(world, "mrt_rdv_detail")
    groups = defaultdict(list)
    for r in got:
        groups[(r["referent"], r["id_benef"])].append(r)
    for rows in groups.values():
        assert sorted(r["rang_entree"] for r in rows) == list(range(1, len(rows) + 1))
        entries = [r["date_deb"] or "" for r in sorted(rows, key=lambda r: r["rang_entree"])]
        assert entries == sorted(entries)
        ended = sorted((r for r in rows if r["date_fin_prest"]), key=lambda r: r["rang_sortie"])
        assert [r["date_fin_prest"] for r in ended] == sorted(r["date_fin_prest"] for r in ended)
        assert len({r["rang_sortie"] for r in ended}) == len(ended)
        assert all(r["rang_sortie"] is None for r in rows if not r["date_fin_prest"])


@pytest.mark.parametrize("name", ["mrt_rdv_detail", "mrt_referent_rdv_ca"])
@pytest.mark.parametrize("many", [0, 4])
def test_ranks_are_the_same_for_ids_spread_by_day(world, monkeypatch, name, many):
    """However few rows make an id one that is spread by day; some of these ids have more than four."""
    repeated, tables, _ = world
    usual = MARTS[name](tables.__getitem__)
    want = bag([c for c in usual.columns if not (repeated and c in TIED)], usual.drop(*(TIED if repeated else ())).collect())
    monkeypatch.setattr(appointments, "MANY", many)
    spread = MARTS[name](tables.__getitem__)
    assert bag([c for c in spread.columns if not (repeated and c in TIED)], spread.drop(*(TIED if repeated else ())).collect()) == want


def test_slots_of_usual_ids_meet_their_facts_in_one_shuffle(world):
    """By beneficiary, for ranks, facts and bonuses; no day of theirs carries the facts through a shuffle."""
    plan = MARTS["mrt_referent_rdv_ca"](world[1].__getitem__)._jdf.queryExecution().optimizedPlan().toString()
    together = plan.partition("\n+- ")[0]  # the first part of the union
    assert "RepartitionByExpression [id_benef" in together
    assert "_day" not in together


def test_spread_revenue_adds_up_and_bonuses_show_once_per_counsellor(world):
    repeated, _, _ = world
    if repeated:
        pytest.skip("totals repeat with repeated ids")
    got, _ = both(world, "mrt_referent_rdv_ca")
    exact = {r["id_benef"]: r["CA_HT_total"] for r in both(world, "mrt_benef_ca_prime")[0]}
    totals = {i: None if v is None else int(v) / 10**domain.EXACT_SCALE for i, v in exact.items()}
    spread = defaultdict(dict)
    for r in got:
        spread[r["id_benef"]][(r["referent"], r["rang_entree"])] = r["CA_HT_par_rdv"]
        assert r["rang_entree"] == 1 or int(r["Montant_prime"]) == 0
    for id_benef, shares in spread.items():
        if totals.get(id_benef) is not None:
            assert sum(shares.values()) == pytest.approx(totals[id_benef])


def test_full_join_loses_the_id_of_uninvoiced_people(world):
    got, _ = both(world, "mrt_adv_facture")
    assert all(r["id_benef"] is None for r in got if r["num_facture"] is None)
    assert any(r["num_facture"] is None for r in got)


def test_swapped_heading_columns(spark):
    names = ["BRANCHE", "CODE_BU", "BU_LIBELLE", "ANNEE", "MOIS", "TYPE", "CODE_RUBRIQUE", "RUBRIQUE_LIBELLE", "VALEUR"]
    raw = spark.createDataFrame([("b", "c", "l", 2024, 1, "t", "the code", "the label", 1.0)], names)
    got = MARTS["BDD_BU_SECURE"]({"business_units": raw}.__getitem__).first()
    assert (got.CODE_RUBRIQUE, got.RUBRIQUE_LIBELLE) == ("the label", "the code")


def test_flags_of_null_status_and_precedence(spark):
    data = [
        (None, None), (flags.DROPPED, "Retour à l'emploi"), (flags.LEFT_EARLY, flags.SHORT_JOB), (flags.LEFT_EARLY, None),
        (flags.COMPLETED, None), (flags.COMPLETED, "Recherche"), (flags.LEFT_EARLY, flags.LONG_JOB),
    ]
    df = spark.createDataFrame(data, "statut string, situation string").select(
        flags.active(), flags.joined(), flags.not_joined(), flags.oriented(), flags.received(), flags.left_early_for_work(),
        flags.completed_without_work(), flags.lasting_return(), flags.left_early_without_lasting_return(),
    )
    assert [tuple(r) for r in df.collect()] == [
        (1, None, None, None, 0, None, None, None, 0),
        (0, None, None, None, 0, 1, None, None, 0),
        (1, 1, 0, 1, 1, None, None, None, 1),
        (1, 1, 0, 1, 1, None, None, None, 0),
        (1, 1, 0, 1, 1, None, None, None, 0),
        (1, 1, 0, 1, 1, None, 1, None, 0),
        (1, 1, 0, 1, 1, 1, None, 1, 0),
    ]


def test_attendance_labels(spark):
    df = spark.createDataFrame([(1,), (0,), (2,), (None,), (9,)], "present int")
    coded = df.select(flags.attendance_code(F.col("present")).alias("c"))
    assert [r[0] for r in coded.select(flags.attendance_label(F.col("c"))).collect()] == [
        "present", "absent", "annulé", "a catégoriser", "",
    ]


def test_publish_replaces_tables(world, spark, tmp_path):
    _, tables, _ = world
    for _ in range(2):
        publish(tables.__getitem__, str(tmp_path), ["mrt_activite", "mrt_facture"])
    written = read(spark, f"{tmp_path}/mrt_facture")
    assert bag(written.columns, written.collect()) == bag(written.columns, MARTS["mrt_facture"](tables.__getitem__).collect())


def test_publish_builds_shared_steps_once(world, spark, tmp_path, monkeypatch):
    _, tables, _ = world
    names = ["mrt_rdv_detail", "mrt_activite", "mrt_referent_rdv_ca", "mrt_benef_ca_prime"]
    built = Counter()

    def counting(name, step):
        def build(*inputs):
            built[name] += 1
            return step.build(*inputs)

        return marts.Step(build, step.inputs)

    want = {n: bag(MARTS[n](tables.__getitem__).columns, MARTS[n](tables.__getitem__).collect()) for n in names}
    monkeypatch.setattr(marts, "SHARED", {n: counting(n, s) for n, s in marts.SHARED.items()})
    shared = tmp_path / "shared"
    monkeypatch.setattr(marts, "shared_folder", lambda _: str(shared))
    publish(tables.__getitem__, str(tmp_path / "marts"), names)
    assert built == {"known_slots": 1, "bonuses": 1}
    for name in names:
        written = read(spark, f"{tmp_path}/marts/{name}")
        assert bag(written.columns, written.collect()) == want[name]
    assert list(shared.iterdir()) == []


def test_publish_removes_shared_steps_after_a_failure(world, spark, tmp_path, monkeypatch):
    _, tables, _ = world
    shared = tmp_path / "shared"
    monkeypatch.setattr(marts, "shared_folder", lambda _: str(shared))
    broken = dict(tables, facture=tables["facture"].withColumn("id_benef", F.raise_error(F.lit("broken")).cast("bigint")))
    with pytest.raises(Exception, match="broken"):
        publish(broken.__getitem__, str(tmp_path / "marts"), ["mrt_rdv_detail", "mrt_referent_rdv_ca"])
    assert read(spark, f"{tmp_path}/marts/mrt_rdv_detail").count() > 0
    assert list(shared.iterdir()) == []


def test_published_steps_are_shuffled_once(world, spark, tmp_path, monkeypatch):
    """Readers of the stored slots do not shuffle the usual ones again, and read those of frequent ids in any parts."""
    _, tables, _ = world
    plans = {}
    replace = marts.landing.replace

    def planned(df, path, **more):
        plans[path.rpartition("/")[2]] = df._jdf.queryExecution().executedPlan().toString()
        return replace(df, path, **more)

    monkeypatch.setattr(marts.landing, "replace", planned)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        publish(tables.__getitem__, str(tmp_path), ["mrt_rdv_detail", "mrt_referent_rdv_ca"])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "Exchange" not in plans["mrt_rdv_detail"]
    scans = [line for line in plans["mrt_referent_rdv_ca"].splitlines() if "FileScan" in line and "known_slots_" in line]
    usual = [s for s in scans if "NOT _spread" in s]
    assert any("Bucketed: true" in s for s in usual)
    assert len(scans) > len(usual) and not any("Bucketed: true" in s for s in scans if s not in usual)


def test_table_alone_shuffles_the_usual_slots_once(world):
    """Slots of ids with many bonuses are taken from the same shuffle."""
    found = []

    def walk(node):
        if node.nodeName() == "Exchange" and node.child().nodeName() == "BroadcastHashJoin":
            found.append(node)
        kids = node.initialPlan().children() if node.nodeName() == "AdaptiveSparkPlan" else node.children()
        for i in range(kids.length()):
            walk(kids.apply(i))

    walk(MARTS["mrt_referent_rdv_ca"](world[1].__getitem__)._jdf.queryExecution().executedPlan())
    by_benef = [e for e in found if e.toString().startswith("Exchange hashpartitioning(id_benef") and "REPARTITION_BY_COL" in e.toString()]
    assert len(by_benef) > 1
    assert all(e.sameResult(by_benef[0]) for e in by_benef)


@pytest.mark.parametrize("many", [0, 4])
def test_published_tables_are_the_same_for_ids_spread_by_day(world, spark, tmp_path, monkeypatch, many):
    repeated, tables, _ = world
    names = ["mrt_rdv_detail", "mrt_referent_rdv_ca"]
    usual = {n: MARTS[n](tables.__getitem__).drop(*(TIED if repeated else ())) for n in names}
    want = {n: bag(df.columns, df.collect()) for n, df in usual.items()}
    monkeypatch.setattr(appointments, "MANY", many)
    publish(tables.__getitem__, str(tmp_path), names)
    for name in names:
        written = read(spark, f"{tmp_path}/{name}").select(*usual[name].columns)
        assert bag(written.columns, written.collect()) == want[name]


def test_publish_leaves_no_shuffle_files_tables_or_settings(world, spark, tmp_path):
    _, tables, _ = world
    folders = [str(d) for d in spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirs()]

    def shuffled():
        return {f for folder in folders for f in Path(folder).rglob("shuffle_*.data")}

    before, setting = shuffled(), spark.conf.get(CLEANUP_SETTING, None)
    publish(tables.__getitem__, str(tmp_path), ["mrt_rdv_detail", "mrt_referent_rdv_ca"])
    until = time.time() + 10  # files are removed in the background
    while shuffled() - before and time.time() < until:
        time.sleep(0.1)
    assert not shuffled() - before
    assert spark.conf.get(CLEANUP_SETTING, None) == setting
    assert not [t.name for t in spark.catalog.listTables("default") if t.name.startswith("known_slots_")]
