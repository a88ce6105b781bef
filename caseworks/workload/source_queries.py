"""Sources and sinks as round trips: the test tables are written in each format and read back through the library.

Each query writes to a folder of its own under the shared folder, which its next run replaces.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseworks.plans import marts
from caseworks.schemas import BONUS_LINE_COLUMNS
from caseworks.session import shared_folder
from caseworks.sources import files, landing, tables
from caseworks.workload import domain, mart_checks
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


def _folder(spark: SparkSession, name: str) -> str:
    """A new folder for each build, so that a frame returned earlier keeps its files."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each conversation turn as a line of JSON with an unclean field name; every ninth is cut short."""
    turns = read(spark, sf_dir, "conversations")
    whole = F.to_json(F.struct(F.struct(F.col("conv_id").alias("$id"), "turn").alias("key"), "role", "text"))
    cut = F.concat(F.lit('{"key": '), F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string"))
    return turns.select(F.when((F.col("conv_id") + F.col("turn")) % 9 == 0, cut).otherwise(whole).alias("value"))


LINE_SCHEMA = "key struct<`$id`: bigint, turn: bigint>, role string, text string"


@query(
    """SELECT conv_id AS id, turn, role, length(text) AS n_chars FROM conversations WHERE (conv_id + turn) % 9 <> 0"""
)
def json_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed JSON files read with an explicit schema, field names cleaned at every depth."""
    path = _folder(spark, "json-landing")
    _lines(spark, sf_dir).write.text(path)
    documents = landing.clean_fields(landing.accepted(landing.read_documents(spark, path, LINE_SCHEMA)))
    return documents.select(F.col("key._id").alias("id"), "key.turn", "role", F.length("text").alias("n_chars"))


@query(
    """SELECT '{"key": ' || conv_id || '-' || turn AS value FROM conversations WHERE (conv_id + turn) % 9 = 0"""
)
def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text that does not parse, kept as it came under a name of dataset, table and time."""
    path = _folder(spark, "quarantine")
    documents = landing.parse_documents(_lines(spark, sf_dir), LINE_SCHEMA)
    kept = landing.quarantine(documents, path, "training", "Presence_Soc_2", "20240501_100000")
    return spark.read.text(kept)


@query(
    """SELECT c_custkey, c_name, CASE WHEN c_custkey % 3 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal,
      1 + (c_custkey % 3 = 0)::INT AS copies, (SELECT count(*) FROM customer) AS in_replaced FROM customer"""
)
def append_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appended loads of customers, the second corrected; the newest copy of each, beside a replaced table."""
    path = _folder(spark, "append-replace")
    customer = read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    corrected = customer.filter("c_custkey % 3 = 0").withColumn("c_acctbal", F.col("c_acctbal") + 1)
    for day, rows in (("2024-05-01", customer), ("2024-05-02", corrected)):
        landing.append(landing.stamp(rows, F.lit(f"{day} 08:00:00").cast("timestamp_ntz")), f"{path}/appended")
    for rows in (corrected, customer):
        landing.replace(landing.stamp(rows), f"{path}/replaced")
    landed = tables.read(spark, f"{path}/appended")
    copies = landed.groupBy("c_custkey").agg(F.count(F.lit(1)).cast("int").alias("copies"))
    newest = landing.latest(landed, ["c_custkey"]).drop(landing.STAMP).join(copies, "c_custkey")
    replaced = tables.read(spark, f"{path}/replaced").agg(F.count(F.lit(1)).alias("in_replaced"))
    return newest.withColumn("in_replaced", replaced.scalar())


@query(
    "WITH "
    + domain.check_tables()
    + " SELECT * REPLACE ("
    + ", ".join(f'CAST("{c}" AS VARCHAR) AS "{c}"' for c in ("Date de debut", "Date détection prime", "Montant facturé"))
    + ") FROM bonus_files"
)
def csv_bonus_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The six regional files as CSV with accented headers, read back as text."""
    path = _folder(spark, "csv-bonus")
    for number, rows in enumerate(domain.bonus_files(spark, sf_dir)):
        as_text = rows.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in BONUS_LINE_COLUMNS])
        as_text.write.option("header", True).csv(f"{path}/{number}")
    read_back = [files.read_bonus_file(spark, f"{path}/{n}") for n in range(len(domain.LOT_TITLES))]
    return reduce(DataFrame.unionByName, read_back)


# The six regional files by their logical names.
BONUS_TABLES = [name for name in files.RAW_NAMES["bonus"] if name[0].isdigit()]


@query(
    f"SELECT {BONUS_TABLES}[event_id % 6 + 1] AS name, count(*) AS n FROM events WHERE event_type <> 'purchase' GROUP BY 1"
)
def renamed_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines per regional file, written and found under the physical names of the logical tables."""
    roots = {"bonus": _folder(spark, "raw")}
    for name, rows in zip(BONUS_TABLES, domain.bonus_files(spark, sf_dir)):
        rows.write.parquet(files.raw_path(roots, "bonus", name))
    found = [
        spark.read.parquet(files.raw_path(roots, "bonus", name)).select(F.lit(name).alias("name"))
        for name in BONUS_TABLES
    ]
    return reduce(DataFrame.unionByName, found).groupBy("name").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT o_orderkey, o_custkey, o_orderdate::DATE::VARCHAR AS o_orderdate, o_totalprice, o_orderpriority FROM orders")
def typed_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a CSV seed, typed by an explicit schema."""
    path = _folder(spark, "typed-seed")
    orders = read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("o_orderdate"), "o_totalprice", "o_orderpriority"
    )
    orders.write.option("header", True).csv(path)
    kinds = dict(read(spark, sf_dir, "orders").dtypes) | {"o_orderdate": "date"}
    return files.read_csv(spark, path, ", ".join(f"{c} {kinds[c]}" for c in orders.columns))


@query(mart_checks.mart_sql()["mrt_facture"])
def publish_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A decision table published as parquet twice, the second time replacing the first, and read back."""
    path = _folder(spark, "marts")
    for _ in range(2):
        marts.publish(domain.source(spark, sf_dir), path, ["mrt_facture"])
    return tables.read(spark, f"{path}/mrt_facture")


@query(mart_checks.mart_sql()["mrt_rdv_detail"])
def publish_shared_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two decision tables published together, so that the slots they share are built once; the first read back."""
    path = _folder(spark, "shared-marts")
    marts.publish(domain.source(spark, sf_dir), path, ["mrt_rdv_detail", "mrt_referent_rdv_ca"])
    return tables.read(spark, f"{path}/mrt_rdv_detail")
