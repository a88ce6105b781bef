"""Loads that fail, repeat or compete, and streams into one table: the test tables pass through the library's sinks.

Each build of a query works in a folder of its own under the shared folder, so that an earlier frame stays readable.
"""

from __future__ import annotations

import datetime as dt
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseworks.operators import changes
from caseworks.session import shared_folder
from caseworks.sources import audit, landing, tables
from caseworks.streaming.landing import committed_rejects, document_stream, land_changed, land_new
from caseworks.workload.domain import read

QUERIES: dict = {}
CHECKS: dict[str, str] = {}


def query(sql: str):
    """Register a query under its function name, with the SQL that must give the same rows."""

    def keep(build):
        QUERIES[build.__name__] = build
        CHECKS[build.__name__] = sql
        return build

    return keep


def _home(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


# Loads.


@query(
    """SELECT o_orderkey, o_custkey, o_totalprice, o_orderkey % 4 = 0 AS by_second FROM orders
    UNION ALL SELECT o_orderkey, o_custkey, o_totalprice, TRUE FROM orders WHERE o_orderkey % 4 = 1"""
)
def repeated_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders appended by two loads, each started again after it had been committed, and one that fails half-way and
    is run again: every load counts once."""
    table = tables.Table(spark, _home(spark, "repeated-loads"))
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    second = F.col("o_orderkey") % 4 == 0
    broken = F.when(F.col("o_orderkey") % 5 == 1, F.raise_error(F.lit("source closed")).cast("bigint")).otherwise(F.col("o_custkey"))
    _fails(lambda: table.append(orders.withColumn("o_custkey", broken).withColumn("by_second", second), "monday"))
    for _ in range(2):
        table.append(orders.filter(~second).withColumn("by_second", F.lit(False)), "monday")
        table.append(orders.filter(second | (F.col("o_orderkey") % 4 == 1)).withColumn("by_second", F.lit(True)), "tuesday")
    return table.read()


def _fails(load) -> None:
    try:
        load()
    except (Py4JJavaError, PySparkException):
        return
    raise AssertionError("the load was meant to fail")


@query(
    """SELECT 'after a failed replace' AS state, c_custkey, c_name, c_acctbal FROM customer
    UNION ALL SELECT 'replaced', c_custkey, c_name, c_acctbal + 1 FROM customer WHERE c_custkey % 3 = 0
    UNION ALL SELECT 'the version before', c_custkey, c_name, c_acctbal FROM customer"""
)
def replace_failed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table whose replacement fails while it is written, then succeeds: what readers see each time."""
    path = _home(spark, "replace-failed")
    customer = read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    newer = customer.filter("c_custkey % 3 = 0").withColumn("c_acctbal", F.col("c_acctbal") + 1)
    landing.replace(customer, path)
    broken = F.when(F.col("c_custkey") % 7 == 0, F.raise_error(F.lit("source closed")).cast("string")).otherwise(F.col("c_name"))
    _fails(lambda: landing.replace(newer.withColumn("c_name", broken), path))
    failed = tables.read(spark, path)
    landing.replace(newer, path, keep=1)
    states = {"after a failed replace": failed, "replaced": tables.read(spark, path), "the version before": tables.read(spark, path, 0)}
    named = [df.select(F.lit(name).alias("state"), "*") for name, df in states.items()]
    return named[0].unionByName(named[1]).unionByName(named[2])


# Streams.

SCHEMA = "`$id` bigint, turn bigint, role string, text string"
START = dt.datetime(2024, 5, 1, 6, tzinfo=dt.timezone.utc)


class _Feeds:
    """Conversation turns that arrive as files of JSON lines in two folders, and land in one table."""

    def __init__(self, spark: SparkSession, sf_dir: str, name: str, keys: tuple[str, ...] = ()):
        self.spark, self.turns, self.home, self.keys = spark, read(spark, sf_dir, "conversations"), _home(spark, name), keys
        self.path, self.rejects = f"{self.home}/table", f"{self.home}/rejects"

    def arrive(self, feed: str, hour: int, say: str, which: Column | None = None, names: str = "") -> None:
        """Files of a feed with the time ``hour`` hours after the start. With ``names`` they take fixed names, and the
        place of files that have them."""
        fs, draft = self.spark._jvm.org.apache.hadoop.fs, f"{self.home}/draft-{uuid.uuid4().hex}"
        turns = self.turns if which is None else self.turns.filter(which)
        turns = turns.withColumn("text", F.concat(F.lit(say), F.col("text")))
        whole = F.to_json(F.struct(F.col("conv_id").alias("$id"), "turn", "role", "text"))
        broken = F.when((F.col("conv_id") + F.col("turn")) % 7 == 0, F.left(whole, F.lit(8))).otherwise(whole)
        lines = turns.select(broken.alias("value"))
        (lines.repartition(4) if names else lines).write.text(draft)
        store = fs.Path(draft).getFileSystem(self.spark._jsc.hadoopConfiguration())
        store.mkdirs(fs.Path(f"{self.home}/{feed}"))
        for number, status in enumerate(store.globStatus(fs.Path(f"{draft}/part-*"))):
            target = fs.Path(f"{self.home}/{feed}/{f'{names}-{number}.txt' if names else status.getPath().getName()}")
            store.delete(target, False)
            store.rename(status.getPath(), target)
            store.setTimes(target, int((START + dt.timedelta(hours=hour)).timestamp() * 1000), -1)

    def run(self, feed: str, progress: str | None = None) -> None:
        stream = document_stream(self.spark, f"{self.home}/{feed}", SCHEMA)
        land_new(stream, self.path, self.rejects, f"{self.home}/progress-{progress or feed}", self.keys).awaitTermination()

    def run_all(self) -> None:
        """A feed with a resend, a second feed with late copies, and the first one again without its progress."""
        self.arrive("one", 0, "")
        self.run("one")
        self.arrive("one", 1, "corrected ", F.col("turn") % 5 == 0)
        self.run("one")
        self.arrive("two", -700, "late ", F.col("turn") % 3 == 0)
        self.run("two")
        self.run("one", progress="lost")


@query(
    """SELECT conv_id AS _id, turn, role, CASE WHEN turn % 5 = 0 THEN 'corrected ' || text ELSE text END AS text,
      1 + (turn % 5 = 0)::INT + (turn % 3 = 0)::INT AS copies
    FROM conversations WHERE (conv_id + turn) % 7 <> 0"""
)
def stream_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns landed in one table by several runs of two feeds, one of which loses its progress: the newest copy of each
    and the number of copies."""
    feeds = _Feeds(spark, sf_dir, "stream-landing")
    feeds.run_all()
    landed = tables.read(spark, feeds.path)
    copies = landed.groupBy("_id", "turn").agg(F.count(F.lit(1)).cast("int").alias("copies"))
    newest = landing.latest(landed, ["_id", "turn"])
    return newest.select("_id", "turn", "role", "text").join(copies, ["_id", "turn"])


@query(
    """SELECT left(to_json({'$id': conv_id}), 8) AS value, sum(1 + (turn % 5 = 0)::INT + (turn % 3 = 0)::INT)::BIGINT AS n
    FROM conversations WHERE (conv_id + turn) % 7 = 0 GROUP BY 1"""
)
def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the streams could not parse, kept as it came."""
    feeds = _Feeds(spark, sf_dir, "stream-rejects")
    feeds.run_all()
    return committed_rejects(spark, feeds.path, feeds.rejects).groupBy("value").agg(F.count(F.lit(1)).alias("n"))


@query(
    """WITH t AS (SELECT turn, (conv_id + turn) % 7 <> 0 AS good FROM conversations),
    counted AS (
      SELECT 0 AS hour, count(*) FILTER (good) AS good, count(*) FILTER (NOT good) AS bad FROM t
      UNION ALL SELECT 1, count(*) FILTER (good), count(*) FILTER (NOT good) FROM t WHERE turn % 5 = 0
      UNION ALL SELECT -700, count(*) FILTER (good), count(*) FILTER (NOT good) FROM t WHERE turn % 3 = 0)
    SELECT good AS total_records, bad AS rejected, good > 0 AS success,
      CASE WHEN good > 0 THEN epoch(TIMESTAMP '2024-05-01 06:00:00')::BIGINT + 3600 * hour END AS last_extracted FROM counted
    UNION ALL SELECT 0, 0, FALSE, NULL"""
)
def stream_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each run brought, from the log of the table: the last one, which had lost its progress, nothing."""
    feeds = _Feeds(spark, sf_dir, "stream-audit")
    feeds.run_all()
    moment = F.unix_timestamp(F.to_timestamp("last_extracted_at")).alias("last_extracted")
    return audit.stream_report(spark, feeds.path).select("total_records", "rejected", "success", moment)


@query(
    """SELECT conv_id AS _id, turn, role, CASE WHEN conv_id % 4 = 0 THEN 'final ' WHEN turn % 5 = 0 THEN 'corrected ' ELSE '' END || text AS text
    FROM conversations WHERE (conv_id + turn) % 7 <> 0"""
)
def stream_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table with one row per turn, kept so by merging: resends, late copies, a feed without its progress, and files
    written anew under their old names."""
    feeds = _Feeds(spark, sf_dir, "stream-newest", ("_id", "turn"))
    feeds.run_all()
    for hour, say in ((2, "draft "), (3, "final ")):
        feeds.arrive("one", hour, say, F.col("conv_id") % 4 == 0, names="fixed")
        feeds.run("one")
    land_changed(spark, f"{feeds.home}/one", SCHEMA, feeds.path, feeds.rejects, feeds.keys)
    return tables.read(spark, feeds.path).select("_id", "turn", "role", "text")


# States.

_STATES = """WITH s0 AS (SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer WHERE c_custkey % 11 <> 3),
    s1 AS (SELECT c_custkey, c_name, c_acctbal + (c_custkey % 5 = 0)::INT AS c_acctbal, CASE WHEN c_custkey % 13 <> 0 THEN c_mktsegment END AS c_mktsegment
      FROM customer WHERE c_custkey % 7 <> 2),
    s2 AS (SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer WHERE c_custkey % 11 <> 3)"""


def _states(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    customer = read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    first = customer.filter("c_custkey % 11 <> 3")
    balance = F.col("c_acctbal") + (F.col("c_custkey") % 5 == 0).cast("int")
    segment = F.when(F.col("c_custkey") % 13 != 0, F.col("c_mktsegment"))
    second = customer.filter("c_custkey % 7 <> 2").withColumns({"c_acctbal": balance, "c_mktsegment": segment})
    return [first, second, first]


@query(
    _STATES
    + """ SELECT coalesce(a.c_custkey, b.c_custkey) AS c_custkey,
      CASE WHEN a.c_custkey IS NULL THEN 'inserted' WHEN b.c_custkey IS NULL THEN 'deleted'
        WHEN (a.c_name, a.c_acctbal, a.c_mktsegment) IS NOT DISTINCT FROM (b.c_name, b.c_acctbal, b.c_mktsegment) THEN 'same'
        ELSE 'changed' END AS change
    FROM s0 a FULL JOIN s1 b ON a.c_custkey = b.c_custkey"""
)
def snapshot_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of two states of the table: inserted, changed, deleted or the same."""
    before, after, _ = _states(spark, sf_dir)
    return changes.snapshot_changes(before, after, ["c_custkey"]).select("c_custkey", "change")


@query(
    _STATES
    + """, stacked AS (SELECT 0 AS n, * FROM s0 UNION ALL SELECT 1, * FROM s1 UNION ALL SELECT 2, * FROM s2),
    marked AS (SELECT *, lag(n) OVER w AS n0, lag((c_name, c_acctbal, c_mktsegment)) OVER w AS row0 FROM stacked
      WINDOW w AS (PARTITION BY c_custkey ORDER BY n)),
    begun AS (SELECT * FROM marked WHERE n0 IS NULL OR n0 < n - 1 OR row0 IS DISTINCT FROM (c_name, c_acctbal, c_mktsegment)),
    ended AS (SELECT b.*, (SELECT min(k) FROM range(b.n + 1, 3) r(k) WHERE NOT EXISTS (SELECT 1 FROM stacked s WHERE s.c_custkey = b.c_custkey AND s.n = k
        AND (s.c_name, s.c_acctbal, s.c_mktsegment) IS NOT DISTINCT FROM (b.c_name, b.c_acctbal, b.c_mktsegment))) AS until FROM begun b)
    SELECT c_custkey, c_name, c_acctbal, c_mktsegment, n + 1 AS from_day, (until + 1)::INT AS to_day FROM ended"""
)
def snapshot_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history of customers over three states of the table, with the day from and to which each row holds."""
    days = [F.lit(f"2024-05-0{n} 00:00:00").cast("timestamp_ntz") for n in (1, 2, 3)]
    states = _states(spark, sf_dir)
    history = changes.first_history(states[0], ["c_custkey"], days[0])
    for state, day in zip(states[1:], days[1:]):
        history = changes.snapshot_history(history, state, ["c_custkey"], day)
    names = ["c_custkey", "c_name", "c_acctbal", "c_mktsegment"]
    return history.select(*names, F.day("valid_from").alias("from_day"), F.day("valid_to").alias("to_day"))
