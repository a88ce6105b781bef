"""Committed tables, streams into them, and changes between states."""

from __future__ import annotations

import datetime as dt
import json
import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from caseworks.operators import changes
from caseworks.plans import marts
from caseworks.sources import audit, tables
from caseworks.streaming import landing
from caseworks.streaming.landing import committed_rejects, document_stream, land_changed, land_new


@pytest.fixture()
def table(spark, tmp_path):
    return tables.Table(spark, str(tmp_path / "table"))


def numbers(spark, *values, kind="bigint"):
    return spark.createDataFrame([(v,) for v in values], f"n {kind}")


def fails(df):
    return df.withColumn("n", F.when(F.col("n") > 0, F.raise_error(F.lit("broken")).cast("bigint")).otherwise(F.col("n")))


def test_a_load_counts_once(spark, table):
    assert table.append(numbers(spark, 1, 2), "monday").get == {"rows": 2}
    again = table.append(numbers(spark, 1, 2), "monday")
    assert again.get == {"rows": 2} and again.repeated
    with pytest.raises(Exception, match="broken"):
        table.append(fails(numbers(spark, 0, 5)), "tuesday")
    assert rows(table.read()) == [(1,), (2,)]
    table.append(numbers(spark, 3), "tuesday")
    table.append(numbers(spark, 3))  # a load without a name is one of its own
    assert rows(table.read()) == [(1,), (2,), (3,), (3,)]
    assert [(e.version, e.action, e.rows) for e in table.commits()] == [(0, "append", 2), (1, "append", 1), (2, "append", 1)]


def test_no_table_and_empty_loads(spark, table):
    with pytest.raises(FileNotFoundError):
        table.read()
    assert table.commits() == [] and table.sources().count() == 0
    table.append(numbers(spark))
    assert table.read().collect() == [] and table.read().columns == ["n"]


def test_a_failed_replace_leaves_the_table(spark, table):
    table.replace(numbers(spark, 1, 2))
    before = table.read()
    with pytest.raises(Exception, match="broken"):
        table.replace(fails(numbers(spark, 7)))
    assert rows(table.read()) == rows(before) == [(1,), (2,)]
    table.replace(numbers(spark, 8), keep=1)
    assert rows(table.read()) == [(8,)] and rows(before) == rows(table.read(0)) == [(1,), (2,)]
    table.append(numbers(spark, 9))
    table.retire()
    assert rows(table.read()) == [(8,), (9,)] and len([n for n in os.listdir(table.path) if n.startswith("_batch=")]) == 3
    # What the failed load left is unknown to the log; it is removed once it is old enough.
    assert table.sweep(hours=1) == [] and len(table.sweep(hours=-1)) == 1
    assert rows(table.read()) == [(8,), (9,)]


def test_publish_keeps_the_old_mart_if_the_plan_fails(spark, tmp_path):
    names = ["BRANCHE", "CODE_BU", "BU_LIBELLE", "ANNEE", "MOIS", "TYPE", "CODE_RUBRIQUE", "RUBRIQUE_LIBELLE", "VALEUR"]
    units = spark.createDataFrame([tuple("x" for _ in names)], ", ".join(f"{n} string" for n in names))
    marts.publish({"business_units": units}.__getitem__, str(tmp_path), ["BDD_BU_SECURE"])
    broken = units.withColumn("VALEUR", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        marts.publish({"business_units": broken}.__getitem__, str(tmp_path), ["BDD_BU_SECURE"])
    assert tables.read(spark, f"{tmp_path}/BDD_BU_SECURE").count() == 1


def test_columns_may_be_added_but_not_change_type(spark, table):
    table.append(numbers(spark, 1))
    table.append(numbers(spark, 2).withColumn("note", F.lit("x")))
    assert sorted(tuple(r) for r in table.read().select("n", F.coalesce("note", F.lit("-"))).collect()) == [(1, "-"), (2, "x")]
    table.append(numbers(spark, "3", kind="string"))
    with pytest.raises(ValueError, match="column 'n'"):
        table.read()


def test_writers_commit_one_after_the_other(spark, table):
    """A version that another writer has taken meanwhile is not overwritten."""
    other = tables.Table(spark, table.path)
    table.append(numbers(spark, 1), "a")
    stale = table.commits()
    table.append(numbers(spark, 2), "b")
    known, calls = other.commits, []

    def late():
        calls.append(1)
        return stale if len(calls) <= 2 else known()

    other.commits = late
    other.append(numbers(spark, 3), "c")
    assert [(e.version, e.load) for e in table.commits()] == [(0, "a"), (1, "b"), (2, "c")]
    assert rows(table.read()) == [(1,), (2,), (3,)]
    assert not [n for n in os.listdir(f"{table.path}/_log") if not n.endswith((".json", ".crc"))]


KEYED = "k bigint, v string, at bigint"


def test_merge_keeps_the_newest_row_per_key(spark, table):
    def merge(load, *given, **more):
        return table.merge(spark.createDataFrame(list(given), KEYED), ["k"], [F.col("at").desc_nulls_last()], load, 4, **more)

    merge("one", *[(k, "old", 10) for k in range(40)], (None, "null key", 1), (3, "older", 5))
    before = {name: os.listdir(f"{table.path}/{name}") for name in os.listdir(table.path) if name.startswith("_batch=")}
    assert rows(table.read().filter("k < 5")) == [(k, "old", 10) for k in range(5)] and table.read().count() == 41
    merge("two", (3, "new", 11), (4, "late", 9), (4, "equal", 10), (None, "again", 1))
    assert rows(table.read().filter("k < 5 OR k IS NULL")) == sorted(
        [(0, "old", 10), (1, "old", 10), (2, "old", 10), (3, "new", 11), (4, "equal", 10), (None, "again", 1)], key=lambda r: tuple((v is not None, str(v)) for v in r)
    )
    assert table.read().count() == 41
    assert merge("two", (5, "not again", 99)).repeated and table.read().filter("at = 99").count() == 0
    merge("none")
    assert table.read().count() == 41
    # Only touched buckets are written, in files of their own; the old files are as they were.
    two = next(e for e in table.commits() if e.load == "two")
    assert 0 < len(two.buckets) <= 3 and all(os.listdir(f"{table.path}/{n}") == files for n, files in before.items())
    table.retire()
    assert table.read().count() == 41 and not os.path.exists(f"{table.path}/_draft") or os.listdir(f"{table.path}/_draft") == []


def test_a_merge_that_was_overtaken_starts_again(spark, table):
    order = [F.col("at").desc()]
    table.merge(spark.createDataFrame([(1, "first", 1), (2, "first", 1)], KEYED), ["k"], order, "one", 1)
    slow, write, tried = tables.Table(spark, table.path), tables.Table._write, []

    def overtaken(df, load, *args, **more):
        tried.append(load)
        if len(tried) == 1:
            table.merge(spark.createDataFrame([(2, "overtaking", 5)], KEYED), ["k"], order, "two", 1)
        return write(slow, df, load, *args, **more)

    slow._write = overtaken
    slow.merge(spark.createDataFrame([(1, "slow", 3), (2, "slow", 3)], KEYED), ["k"], order, "three", 1)
    assert tried == ["three", "three"]
    assert rows(table.read()) == [(1, "slow", 3), (2, "overtaking", 5)]


# Streams.

SCHEMA = "ID string, note string"


@pytest.fixture()
def feed(spark, tmp_path):
    class Feed:
        table, rejects = str(tmp_path / "table"), str(tmp_path / "rejects")

        def arrive(self, folder, name, day, *documents):
            (tmp_path / folder).mkdir(exist_ok=True)
            lines = [json.dumps({"ID": i, "note": note}) for i, note in documents]
            (tmp_path / folder / name).write_text("\n".join(lines) + "\n{broken\n")
            os.utime(tmp_path / folder / name, (day * 86400, day * 86400))

        def run(self, folder, progress=None, keys=()):
            query = land_new(document_stream(spark, str(tmp_path / folder), SCHEMA), self.table, self.rejects, str(tmp_path / f"progress-{progress or folder}"), keys, 4)
            assert query.awaitTermination(120)
            return rows(tables.read(spark, self.table).select("ID", "note"))

        def changed(self, folder, keys=()):
            return land_changed(spark, str(tmp_path / folder), SCHEMA, self.table, self.rejects, keys, 4)

    return Feed()


def test_feeds_share_a_table_and_lose_nothing(spark, feed):
    feed.arrive("a", "1.json", 100, ("S1", "a"), ("S2", "a"))
    feed.arrive("b", "1.json", 90, ("S1", "b"))
    assert feed.run("a") == [("S1", "a"), ("S2", "a")]
    assert feed.run("b") == [("S1", "a"), ("S1", "b"), ("S2", "a")]
    feed.arrive("a", "2.json", 101, ("S3", "a"))
    # The progress is lost: files that the log knows are left out, the new one lands.
    all_three = [("S1", "a"), ("S1", "b"), ("S2", "a"), ("S3", "a")]
    assert feed.run("a", progress="lost") == feed.run("a") == feed.run("b") == all_three
    assert committed_rejects(spark, feed.table, feed.rejects).count() == 3
    report = audit.stream_report(spark, feed.table).collect()
    assert sorted((r.total_records, r.rejected, r.success) for r in report) == [(0, 0, False), (1, 1, True), (1, 1, True), (2, 1, True)]
    assert {r.last_extracted_at is None for r in report if r.success} == {False}


def test_a_batch_that_is_run_again_brings_nothing_twice(spark, feed, tmp_path):
    batch = spark.createDataFrame([("S1", "x", None), (None, None, "{cut")], f"ID string, note string, {landing.REJECT} string")
    batch = batch.withColumn(landing.LANDED, F.lit("2024-05-01 06:00:00").cast("timestamp"))
    for _ in range(2):
        landing._land(batch, tables.Table(spark, feed.table), feed.rejects, "feed-0", (), 4)
    landing._land(batch, tables.Table(spark, feed.table), feed.rejects, "feed-1", (), 4)
    # Rejects of an attempt that was never committed do not count.
    (tmp_path / "rejects" / "_batch=feed-2.x").mkdir()
    (tmp_path / "rejects" / "_batch=feed-2.x" / "part-0.txt").write_text("{never\n")
    assert tables.read(spark, feed.table).count() == 2
    assert [r.value for r in committed_rejects(spark, feed.table, feed.rejects).collect()] == ["{cut"] * 2


@pytest.mark.parametrize("keys", [(), ("ID",)])
def test_a_file_written_anew_under_its_name_is_landed(feed, keys):
    feed.arrive("a", "1.json", 100, ("S1", "old"), ("S2", "old"))
    feed.run("a", keys=keys)
    feed.arrive("a", "1.json", 101, ("S1", "new"))
    feed.arrive("a", "2.json", 99, ("S2", "late"))
    feed.run("a", keys=keys)
    assert [os.path.basename(p) for p in feed.changed("a", keys)] == ["1.json"]
    assert feed.changed("a", keys) == []
    now = feed.run("a", keys=keys)
    every = [("S1", "new"), ("S1", "old"), ("S2", "late"), ("S2", "old")]
    assert now == ([("S1", "new"), ("S2", "old")] if keys else every)


# Changes.

STATE = "k bigint, a string, b double"


def state(spark, *given):
    return spark.createDataFrame(list(given), STATE)


def test_changes_between_states(spark):
    before = state(spark, (1, "x", 1.0), (2, "x", None), (3, None, 1.0), (4, "", 1.0), (None, "x", 1.0), (6, "a-b", 0.0))
    after = state(spark, (1, "x", 1.0), (2, None, None), (3, None, 1.0), (4, None, 1.0), (None, "y", 1.0), (7, "x", 1.0))
    got = {r.k: r.change for r in changes.snapshot_changes(before, after, ["k"]).collect()}
    assert got == {1: "same", 2: "changed", 3: "same", 4: "changed", None: "changed", 6: "deleted", 7: "inserted"}
    only = changes.snapshot_changes(before, after, ["k"], columns=["b"])
    assert {r.change for r in only.filter("k < 5 OR k IS NULL").collect()} == {"same"}
    wider = changes.snapshot_changes(before, after.withColumn("c", F.lit("new")), ["k"])
    assert {r.change for r in wider.filter("k < 5").collect()} == {"changed"}
    assert changes.snapshot_changes(before.limit(0), after.limit(0), ["k"]).collect() == []
    with pytest.raises(Exception, match="a key repeats"):
        changes.snapshot_changes(before, after.unionAll(after), ["k"]).collect()


def test_history_over_states(spark):
    day = lambda n: F.lit(f"2024-05-{n:02} 00:00:00").cast("timestamp_ntz")
    when = lambda n: dt.datetime(2024, 5, n)
    history = changes.first_history(state(spark, (1, "x", 1.0), (2, "x", 1.0), (None, "x", 1.0)), ["k"], day(1))
    second = state(spark, (1, "x", 1.0), (2, "y", 1.0), (3, "x", 1.0))
    history = changes.snapshot_history(history, second, ["k"], day(2))
    history = changes.snapshot_history(history, second, ["k"], day(3))  # the same state again
    history = changes.snapshot_history(history, state(spark, (2, "y", 1.0), (None, "x", 1.0)), ["k"], day(4))
    assert rows(history.select("k", "a", "valid_from", "valid_to")) == rows(
        spark.createDataFrame(
            [
                (1, "x", when(1), when(4)), (2, "x", when(1), when(2)), (2, "y", when(2), None), (3, "x", when(2), when(4)),
                (None, "x", when(1), when(2)), (None, "x", when(4), None),
            ],
            "k bigint, a string, f timestamp_ntz, t timestamp_ntz",
        )
    )
    with pytest.raises(ValueError, match="differ in the columns"):
        changes.snapshot_history(history, second.drop("b"), ["k"], day(5))
    with pytest.raises(Exception, match="a key repeats"):
        changes.snapshot_history(history, second.unionAll(second), ["k"], day(5)).collect()
