from __future__ import annotations

import datetime as dt
import json
import os

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseworks.plans import attendance, staging
from caseworks.schemas import SESSION_SCHEMA
from caseworks.sources import audit, files, landing, relational
from caseworks.streaming.landing import document_stream, land_new


def session_doc(number: int, trainers: int = 1, slots: int = 2, agreement=None, **more):
    return {
        "$id": "1", "ID": f"S{number}", "Date": "2024-03-31T02:30:00", "Debut": "09:00:00", "Duree": "07:00:00",
        "Fin": "17:00:00", "IDModule": 7, "IDAction": 8, "Libelle_Court": "root short", "Libelle": "root label",
        "Libelle_Action": "action", "Visibilite_stagiaire": True, "IDLieu": 3, "Libelle_Lieu": "place",
        "Seances_Persos": [
            {"$id": str(s + 2), "Debut": "09:00:00", "Duree": "03:30:00", "Fin": "12:30:00", "Type_Seance": 1,
             "Libelle_Type_Seance": "lesson", "Duree_Absence": "00:45:00", "IDTypAbsen": "x", "LTypAbsen": "",
             "Libelle_Court": "slot short", "Libelle": "slot label", "Personnalisee": "NON", "Distancielle": False,
             "Inscrit": {"ID": 5, "Stagiaire": {"ID": 50 + s, "Nom": "T"}, "Date_Entree": "2024-01-02T00:00:00",
                         "Convention": agreement}}
            for s in range(slots)
        ],
        "Salles": [], "Materiels": [],
        "Intervenants": [{"$id": "9", "ID": 90 + t, "Nom": "I"} for t in range(trainers)],
        **more,
    }


@pytest.fixture()
def landed(tmp_path):
    agreement = {"ID": 11, "Libelle": "agreed", "Client": {"ID": 12, "Nom": "client"}}
    lines = [
        json.dumps(session_doc(1, agreement=agreement)),
        json.dumps(session_doc(2, trainers=0)),
        json.dumps(session_doc(3, trainers=2, slots=1, agreement=json.dumps(agreement))),
        '{"ID": "cut sho',
        "",
        json.dumps(session_doc(4, slots=0)),
    ]
    folder = tmp_path / "landing"
    folder.mkdir()
    (folder / "batch1.json").write_text("\n".join(lines))
    return folder


def test_documents_flatten_per_slot_and_trainer(spark, landed):
    documents = landing.read_documents(spark, str(landed), SESSION_SCHEMA)
    assert documents.count() == 5
    assert [r[0] for r in landing.rejected(documents).collect()] == ['{"ID": "cut sho']
    clean = landing.clean_fields(landing.accepted(documents))
    assert "_id" in clean.columns and clean.select("Seances_Persos._id", "Seances_Persos.Inscrit.Stagiaire.Nom").columns
    flat = staging.attendance(clean, "Presence_Soc_3")
    assert len(flat.columns) == 76
    # Sessions 2 (no trainer) and 4 (no slot) vanish; 1 has 2 slots x 1 trainer, 3 has 1 x 2.
    assert rows(flat.select("source_id", "stagiaire_id", "intervenant_id")) == [
        ("S1", 50, 90), ("S1", 51, 90), ("S3", 50, 90), ("S3", 50, 91),
    ]
    # The agreement came once as an object, once as text.
    assert rows(flat.select("convention_id", "client_nom", "convention_libelle", "financeur_id").distinct()) == [
        (11, "client", "agreed", None)
    ]
    first = flat.filter("source_id = 'S1'").first()
    assert (first.materiels, first.salles, first.type_absence_id, first.date_date) == ("[]", "[]", None, "2024-03-31 02:30:00")
    assert first.date_entree == dt.date(2024, 1, 2)


def test_published_type_holds_the_short_label(spark, landed):
    clean = landing.clean_fields(landing.accepted(landing.read_documents(spark, str(landed), SESSION_SCHEMA)))
    got = attendance.attendance({"Presence_Soc_2": clean, "Presence_Soc_3": clean}).first()
    assert (got.type_seance, got.duree_seance_minutes, got.duree_seance_heures, got.duree_absence_heures) == (
        "slot short", 210, 3.5, 0.75,
    )


def test_whole_file_batches(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([session_doc(1), session_doc(2)], indent=2))
    (tmp_path / "b.json").write_text('[{"ID": "S3"')
    documents = landing.read_documents(spark, str(tmp_path), SESSION_SCHEMA, whole_files=True)
    assert sorted(r.ID for r in landing.accepted(documents).collect()) == ["S1", "S2"]
    assert [r[0] for r in landing.rejected(documents).collect()] == ['[{"ID": "S3"']


def test_clean_names_at_every_depth(spark):
    kind = T.StructType().add("$id", T.IntegerType()).add("a.b-c d", T.ArrayType(T.StructType().add("@x#", T.IntegerType())))
    df = landing.clean_fields(spark.createDataFrame([(1, [(2,)])], kind))
    assert df.schema.simpleString() == "struct<_id:int,a_b_c_d:array<struct<_x_:int>>>"
    assert rows(df.select("_id", "a_b_c_d._x_")) == [(1, [2])]
    with pytest.raises(ValueError):
        landing.clean_fields(spark.createDataFrame([(1, 2)], T.StructType().add("$a", T.IntegerType()).add("@a", T.IntegerType())))


def test_append_replace_latest_and_counts(spark, tmp_path):
    path = str(tmp_path / "bronze")
    docs = spark.createDataFrame([("S1", "old"), ("S2", "only")], "ID string, v string")
    again = spark.createDataFrame([("S1", "new")], "ID string, v string")
    at = F.lit("2024-05-01 10:00:00").cast("timestamp_ntz")
    assert landing.append(landing.stamp(docs, at), path).get == {"rows": 2}
    assert landing.append(landing.stamp(again, F.lit("2024-05-02 10:00:00").cast("timestamp_ntz")), path).get == {"rows": 1}
    bronze = spark.read.parquet(path)
    assert bronze.count() == 3
    assert rows(landing.latest(bronze, ["ID"]).select("ID", "v")) == [("S1", "new"), ("S2", "only")]
    assert landing.replace(landing.stamp(again), path).get == {"rows": 1}
    assert spark.read.parquet(path).count() == 1


def test_quarantine_and_report(spark, landed, tmp_path):
    documents = landing.stamp(landing.read_documents(spark, str(landed), SESSION_SCHEMA))
    path = landing.quarantine(documents, str(tmp_path / "q"), "training", "Presence_Soc_3", "20240501_100000")
    assert path.endswith("backup_training_Presence_Soc_3_20240501_100000")
    assert [r.value for r in spark.read.text(path).collect()] == ['{"ID": "cut sho']
    only_bad = documents.filter(F.col(landing.REJECT).isNotNull())
    both = documents.withColumn("table", F.lit("good")).unionByName(only_bad.withColumn("table", F.lit("bad")))
    report = audit.load_report(both)
    assert {(r.table, r.total_records, r.rejected, r.success) for r in report.collect()} == {("good", 4, 1, True), ("bad", 0, 1, False)}
    assert tuple(audit.load_totals(report).first()) == (1, 1, 4)


def test_csv_with_accented_headers(spark, tmp_path):
    header = ",".join(files.BONUS_LINE_COLUMNS)
    values = ["x"] * len(files.BONUS_LINE_COLUMNS)
    values[files.BONUS_LINE_COLUMNS.index("LC")] = "C1"
    values[files.BONUS_LINE_COLUMNS.index("Date détection prime")] = "2024-02-01"
    (tmp_path / "16898.csv").write_text(header + "\n" + ",".join(values) + "\n", encoding="utf-8")
    got = files.read_bonus_file(spark, str(tmp_path), {"Date détection prime": "date"})
    assert got.columns == files.BONUS_LINE_COLUMNS
    assert rows(got.select("LC", "`Date détection prime`")) == [("C1", dt.date(2024, 2, 1))]


def test_physical_names():
    roots = {"casework": "/lake/casework"}
    assert files.raw_path(roots, "casework", "benef") == "/lake/casework/dt_benef"


def test_jdbc_reads_are_split_by_key():
    login = {"user": "u", "password": "p"}
    split = relational.read_options("jdbc:mysql://host/db", "dt_rdv", login, "id_rdv", (1, 900), 8)
    assert split["partitionColumn"] == "id_rdv" and split["upperBound"] == "900" and split["numPartitions"] == "8"
    assert "numPartitions" not in relational.read_options("jdbc:mysql://host/db", "dt_rdv", login)
    assert split["useCursorFetch"] == "true"
    assert relational.table_key("dt_rdv", {"dt_rdv": "id_rdv"}, ()) == "id_rdv"
    assert relational.table_key("lot", {}, ["lot"]) is None
    with pytest.raises(ValueError):
        relational.table_key("dt_rdv", {}, ["lot"])


def test_stream_keeps_late_corrected_and_broken_documents(spark, tmp_path):
    folder, out, progress, rejects = tmp_path / "in", *(str(tmp_path / n) for n in ("out", "progress", "rejects"))
    folder.mkdir()
    schema = "`$id` string, ID string, company int, note string"

    def arrive(name, at, *documents):
        lines = [json.dumps({"$id": "1", "ID": i, "company": 2, "note": note}) for i, note in documents]
        (folder / name).write_text("\n".join(lines) + "\n{broken\n")
        os.utime(folder / name, (at, at))

    def run():
        query = land_new(document_stream(spark, str(folder), schema), out, rejects, progress)
        assert query.awaitTermination(120)
        newest = landing.latest(spark.read.parquet(out), ["company", "ID"])
        return sorted((r.ID, r.note) for r in newest.collect())

    day = 86400
    arrive("one.json", 100 * day, ("S1", "first"), ("S2", "first"), ("S1", "first"))
    assert run() == [("S1", "first"), ("S2", "first")]
    arrive("two.json", 101 * day, ("S2", "corrected"), ("S3", "first"))
    arrive("late.json", 70 * day, ("S2", "outdated"), ("S4", "late"))
    assert run() == [("S1", "first"), ("S2", "corrected"), ("S3", "first"), ("S4", "late")]
    assert run() == [("S1", "first"), ("S2", "corrected"), ("S3", "first"), ("S4", "late")]
    assert spark.read.parquet(out).count() == 7
    assert [r.value for r in spark.read.text(rejects).collect()] == ["{broken"] * 3
    assert {"_id", "ID", "company", "note", "_extracted_at", "_batch"} == set(spark.read.parquet(out).columns)
