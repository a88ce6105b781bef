"""Operator queries over whole test tables, each beside its check SQL."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseworks.functions import text, values
from caseworks.operators import frequent, reports, reshape, rows
from caseworks.plans import staging
from caseworks.sources import audit, landing
from caseworks.workload import domain
from caseworks.workload.domain import read
from caseworks.workload.mart_checks import ATTENDANCE, enrolment_sql

QUERIES: dict = {}
CHECKS: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function name, with the SQL that must give the same rows."""

    def keep(build):
        QUERIES[build.__name__] = build
        if sql:
            CHECKS[build.__name__] = sql
        return build

    return keep


# Number and date rows.


@query(
    """SELECT CAST(CAST(d AS DATE) AS VARCHAR) AS date_day, count(o_orderkey) AS n_orders
    FROM (SELECT unnest(range(min(o_orderdate), max(o_orderdate) + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS d FROM orders) s
    LEFT JOIN orders ON CAST(o_orderdate AS DATE) = CAST(d AS DATE) GROUP BY d"""
)
def date_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per calendar day, days without an order included."""
    days = read(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("date_day"))
    ends = days.agg(F.min("date_day").alias("low"), F.max("date_day").alias("high")).first()
    spine = rows.date_spine(spark, "day", ends.low, ends.high + dt.timedelta(days=1))
    counted = days.groupBy("date_day").agg(F.count(F.lit(1)).alias("n_orders"))
    return spine.join(counted, "date_day", "left").fillna(0, ["n_orders"])


@query(
    """SELECT d AS date_hour, count(event_id) AS n_events
    FROM (SELECT unnest(range(date_trunc('hour', min(ts)), date_trunc('hour', max(ts)) + INTERVAL 1 HOUR, INTERVAL 1 HOUR))
      AS d FROM events) s LEFT JOIN events ON date_trunc('hour', ts) = d GROUP BY d"""
)
def date_spine_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per hour, silent hours included."""
    hours = read(spark, sf_dir, "events").select(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("date_hour"))
    ends = hours.agg(F.min("date_hour").alias("low"), F.max("date_hour").alias("high")).first()
    spine = rows.date_spine(spark, "hour", ends.low, ends.high + dt.timedelta(hours=1))
    counted = hours.groupBy("date_hour").agg(F.count(F.lit(1)).alias("n_events"))
    return spine.join(counted, "date_hour", "left").fillna(0, ["n_events"])


@query(
    """SELECT s.generated_number, count(l_orderkey) AS n_lines
    FROM (SELECT unnest(range(1, CAST(max(l_quantity) AS BIGINT) + 11)) AS generated_number FROM lineitem) s
    LEFT JOIN lineitem ON l_quantity = s.generated_number GROUP BY 1"""
)
def generate_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines per whole quantity, up to ten beyond the largest."""
    lines = read(spark, sf_dir, "lineitem").select(F.col("l_quantity").cast("bigint").alias("generated_number"))
    highest = lines.agg(F.max("generated_number")).first()[0]
    counted = lines.groupBy("generated_number").agg(F.count(F.lit(1)).alias("n_lines"))
    return rows.generate_series(spark, highest + 10).join(counted, "generated_number", "left").fillna(0, ["n_lines"])


@query(
    """WITH ends AS (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS b
      FROM orders GROUP BY 1),
    months AS (SELECT o_custkey, b, unnest(range(date_trunc('month', a), CAST(b AS TIMESTAMP) + INTERVAL 1 DAY,
      INTERVAL 1 MONTH)) AS m FROM ends)
    SELECT o_custkey, CAST(CAST(m AS DATE) AS VARCHAR) AS period_start,
      CAST(least(last_day(CAST(m AS DATE)), b) AS VARCHAR) AS period_end
    FROM months WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = months.o_custkey
      AND date_trunc('month', o.o_orderdate) = m)"""
)
def monthly_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months between a customer's first and last order in which nothing was ordered."""
    orders = read(spark, sf_dir, "orders")
    active = orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last"))
    bought = orders.select("o_custkey", F.trunc("o_orderdate", "MM").alias("period_start")).distinct()
    return (
        rows.monthly_periods(active, "first", "last")
        .join(bought, ["o_custkey", "period_start"], "left_anti")
        .select("o_custkey", "period_start", "period_end")
    )


# Keys, deduplication, frequent values.


@query(
    """SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1"""
)
def deduplicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's latest order."""
    return rows.deduplicate(read(spark, sf_dir, "orders"), ["o_custkey"], [F.desc("o_orderdate"), "o_orderkey"])


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, md5(CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)
      || '-' || CAST(l_partkey AS VARCHAR) || '-' || coalesce(nullif(l_returnflag, 'A'), '_dbt_utils_surrogate_key_null_'))
      AS line_key FROM lineitem"""
)
def surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One text key over four columns of every line, one of them with NULLs."""
    flag = F.nullif(F.col("l_returnflag"), F.lit("A"))
    key = values.surrogate_key(["l_orderkey", "l_linenumber", "l_partkey", flag])
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", key.alias("line_key"))


@query("SELECT o_orderpriority AS value, count(*) AS n FROM orders GROUP BY 1")
def column_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.column_values(read(spark, sf_dir, "orders"), "o_orderpriority")


@query("SELECT p_brand AS value, count(*) AS n FROM part WHERE p_size > 10 GROUP BY 1 ORDER BY n DESC, value LIMIT 5")
def column_values_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.column_values(read(spark, sf_dir, "part"), "p_brand", max_records=5, where="p_size > 10")


@query(
    """SELECT value, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS value FROM documents)
    WHERE value <> '' GROUP BY 1 ORDER BY n DESC, value LIMIT 40"""
)
def column_values_frequent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most frequent words of all texts, without shuffling the many rare ones."""
    words = read(spark, sf_dir, "documents").select(F.explode(F.split("text", " ", -1)).alias("word"))
    return frequent.most_frequent(words, "word", 40, where="word <> ''")


@query("SELECT l_partkey AS value, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, value LIMIT 25")
def column_values_even(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of nearly equal counts, where the proof leaves out little."""
    return frequent.most_frequent(read(spark, sf_dir, "lineitem"), "l_partkey", 25)


# Column sets and shapes.


@query(
    """SELECT o_orderpriority, o_orderstatus, count(*) AS n, min(o_totalprice) AS cheapest FROM orders GROUP BY 1, 2"""
)
def group_by_ordinals(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders").select("o_orderpriority", "o_orderstatus", "o_totalprice")
    return reshape.group_by_first(
        orders, 2, F.count(F.lit(1)).alias("n"), F.min("o_totalprice").alias("cheapest")
    )


@query(
    """SELECT p_partkey, nullif(CASE WHEN p_size % 5 = 0 THEN '' ELSE p_name END, '') AS p_name,
      nullif(p_type, '') AS p_type, p_size FROM part"""
)
def nullcheck_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts with some names blanked, empty text turned to NULL."""
    name = F.when(F.col("p_size") % 5 == 0, "").otherwise(F.col("p_name")).alias("p_name")
    return reshape.null_empty_strings(read(spark, sf_dir, "part").select("p_partkey", name, "p_type", "p_size"))


@query(
    """SELECT o_orderpriority, CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS "F",
      CAST(sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS "O",
      CAST(sum(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) AS BIGINT) AS "P" FROM orders GROUP BY 1"""
)
def pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per priority and status; the statuses are looked up first."""
    orders = read(spark, sf_dir, "orders")
    found = rows.column_value_list(orders, "o_orderstatus")
    return orders.groupBy("o_orderpriority").agg(*reshape.pivot_columns("o_orderstatus", sorted(found)))


BRANDS = [f"Brand#{n}" for n in range(1, 26)] + ["no such brand"]


@query(
    """SELECT o_orderstatus, """
    + ", ".join(f"count(*) FILTER (o_custkey % 150 = {n}) AS c{n}" for n in range(150))
    + " FROM orders GROUP BY 1"
)
def pivot_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per status and each of 150 customer groups, looked up first; every group gets its column."""
    orders = read(spark, sf_dir, "orders").withColumn("part", F.col("o_custkey") % 150)
    cells = reshape.pivot_columns("part", sorted(rows.column_value_list(orders, "part")), prefix="c")
    return orders.groupBy("o_orderstatus").agg(*cells)


@query(
    """SELECT event_type, count(*) FILTER (value >= 50) AS high, count(*) FILTER (value < 50) AS low FROM events GROUP BY 1"""
)
def pivot_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per kind and level of their value; an event without a value counts in no column."""
    events = read(spark, sf_dir, "events").withColumn(
        "level", F.when(F.col("value") >= 50, "high").when(F.col("value") < 50, "low")
    )
    return events.groupBy("event_type").agg(*reshape.pivot_columns("level", sorted(rows.column_value_list(events, "level"))))


@query(
    "SELECT p_size, "
    + ", ".join(
        f"max(CASE WHEN p_brand = '{b}' THEN p_retailprice ELSE 0 END) AS top_{text.slugify_name(b)}" for b in BRANDS
    )
    + " FROM part GROUP BY 1"
)
def pivot_slug(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dearest part per size and brand under cleaned column names."""
    cells = reshape.pivot_columns(
        "p_brand", BRANDS, agg="max", prefix="top ", then_value=F.col("p_retailprice"), slug_names=True
    )
    return read(spark, sf_dir, "part").groupBy("p_size").agg(*cells)


@query(
    "SELECT p_size, "
    + ", ".join(f"count(DISTINCT CASE WHEN p_brand <> '{b}' THEN p_type END) AS \"not {b}\"" for b in BRANDS)
    + " FROM part GROUP BY 1"
)
def pivot_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct part types per size outside each brand."""
    cells = reshape.pivot_columns(
        "p_brand", BRANDS, agg="count", cmp="<>", prefix="not ", then_value=F.col("p_type"), else_value=None,
        distinct=True,
    )
    return read(spark, sf_dir, "part").groupBy("p_size").agg(*cells)


@query("SELECT * EXCLUDE (c_acctbal, c_mktsegment) FROM customer")
def star_except(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = read(spark, sf_dir, "customer")
    return customer.select(*reshape.star(customer, without=["C_ACCTBAL", "c_mktsegment"]))


@query("SELECT c_custkey AS old_c_custkey_v1, c_name AS old_c_name_v1, c_nationkey AS old_c_nationkey_v1 FROM customer")
def star_affix(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = read(spark, sf_dir, "customer")
    return customer.select(*reshape.star(customer, ["c_acctbal", "c_mktsegment"], prefix="old_", suffix="_v1"))


@query(
    """SELECT 'customer' AS _dbt_source_relation, c_custkey AS id, c_name AS name, CAST(c_acctbal AS VARCHAR) AS balance,
      c_mktsegment AS segment, CAST(NULL AS INTEGER) AS nation FROM customer WHERE c_custkey >= 50
    UNION ALL SELECT 'supplier', s_suppkey, s_name, CAST(s_acctbal AS VARCHAR), NULL, s_nationkey FROM supplier
      WHERE s_suppkey >= 50"""
)
def union_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and suppliers in one table, with a retyped balance and one filter on both."""
    return reshape.union_relations(
        {
            "customer": read(spark, sf_dir, "customer").selectExpr(
                "c_custkey AS id", "c_name AS name", "c_acctbal AS balance", "c_mktsegment AS segment"
            ),
            "supplier": read(spark, sf_dir, "supplier").selectExpr(
                "s_suppkey AS id", "s_name AS name", "s_acctbal AS balance", "s_nationkey AS nation", "s_name AS hidden"
            ),
        },
        column_override={"balance": "string"},
        exclude=["HIDDEN"],
        where="id >= 50",
    )


def _event_views(spark: SparkSession, sf_dir: str, build) -> DataFrame:
    """What ``build`` makes of one view per kind of event; the views are dropped once the plan stands."""
    events = read(spark, sf_dir, "events")
    kinds = ("click", "view", "signup", "purchase", "error")
    for kind in kinds:
        columns = ["event_id", "user_id"] + (["value"] if kind == "view" else [])
        events.filter(F.col("event_type") == kind).select(*columns).createOrReplaceTempView(f"visits_{kind}")
    try:
        return build()
    finally:
        for kind in kinds:
            spark.catalog.dropTempView(f"visits_{kind}")


@query(
    """SELECT 'visits_' || event_type AS source_table, event_id, user_id, CASE event_type WHEN 'view' THEN value END AS value
    FROM events WHERE event_type <> 'error'"""
)
def union_matching(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Union of the catalogue's event tables that fit a pattern, but for one."""

    def build() -> DataFrame:
        return reshape.union_matching(spark, "VISITS\\_%", exclude="visits_err%", source_column_name="source_table")

    return _event_views(spark, sf_dir, build)


@query("SELECT 'visits_' || event_type AS source_table, event_id, user_id FROM events")
def union_prefixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Union of the catalogue's tables whose names start alike, without a column only one of them has."""

    def build() -> DataFrame:
        return reshape.union_prefixed(spark, "visits", source_column_name="source_table", exclude_columns=["value"])

    return _event_views(spark, sf_dir, build)


@query(
    """SELECT p_partkey, field_name, value FROM (SELECT p_partkey, p_brand, p_type, CAST(p_size AS VARCHAR) AS p_size,
      CAST(p_retailprice AS VARCHAR) AS p_retailprice FROM part)
    UNPIVOT INCLUDE NULLS (value FOR field_name IN (p_brand, p_type, p_size, p_retailprice))"""
)
def unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reshape.unpivot(read(spark, sf_dir, "part"), exclude=["p_partkey"], remove=["P_NAME"])


@query(
    """SELECT o_orderkey, prop, val FROM (SELECT o_orderkey, o_orderpriority AS priority,
      CASE o_orderstatus WHEN 'F' THEN 'true' WHEN 'O' THEN 'false' END AS finished FROM orders)
    UNPIVOT INCLUDE NULLS (val FOR prop IN (priority, finished))"""
)
def unpivot_bool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in long form with a boolean that is NULL for part of them."""
    wide = read(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_orderpriority AS priority",
        "CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS finished",
    )
    return reshape.unpivot(wide, exclude=["o_orderkey"], field_name="prop", value_name="val")


# Scalar helpers on whole tables.


@query(
    """SELECT o_custkey, CAST(sum(coalesce(nullif(o_orderkey % 3, 0), 0) + coalesce(nullif(o_orderkey % 5, 0), 0)
      + coalesce(o_custkey, 0)) AS BIGINT) AS total FROM orders GROUP BY 1"""
)
def safe_add(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [F.nullif(F.col("o_orderkey") % n, F.lit(0)) for n in (3, 5)]
    orders = read(spark, sf_dir, "orders")
    return orders.groupBy("o_custkey").agg(F.sum(values.safe_add([*parts, "o_custkey"])).alias("total"))


@query(
    """SELECT o_custkey, CAST(sum(coalesce(o_custkey, 0) - coalesce(nullif(o_orderkey % 3, 0), 0)
      - coalesce(nullif(o_orderkey % 5, 0), 0)) AS BIGINT) AS total FROM orders GROUP BY 1"""
)
def safe_subtract(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [F.nullif(F.col("o_orderkey") % n, F.lit(0)) for n in (3, 5)]
    orders = read(spark, sf_dir, "orders")
    return orders.groupBy("o_custkey").agg(F.sum(values.safe_subtract(["o_custkey", *parts])).alias("total"))


@query(
    """SELECT l_suppkey, count(*) FILTER (l_returnflag = 'R') / nullif(count(*) FILTER (l_linestatus = 'O' AND l_tax > 0.07), 0)
      AS returns_per_open FROM lineitem GROUP BY 1"""
)
def safe_divide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returned lines per open, highly taxed line of each supplier; NULL where there is none."""
    returned = F.count_if(F.col("l_returnflag") == "R")
    opened = F.count_if((F.col("l_linestatus") == "O") & (F.col("l_tax") > 0.07))
    ratio = values.safe_divide(returned, opened).alias("returns_per_open")
    return read(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(ratio)


@query(
    """SELECT CAST(CASE WHEN CAST(o_totalprice AS DECIMAL(38,9)) % CAST((400000.0 - 1000) / 20 AS DECIMAL(38,9)) = 0 THEN 1
      ELSE 0 END + least(ceil((o_totalprice - 1000) / ((400000.0 - 1000) / 20)), 21) AS BIGINT) AS bucket, count(*) AS n
    FROM orders GROUP BY 1"""
)
def histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.histogram(read(spark, sf_dir, "orders"), "o_totalprice", 1000.0, 400000.0, 20)


def _shipping(spark: SparkSession, sf_dir: str, unit: str) -> DataFrame:
    """Lines per customer and supplier nation with the distance between invented nation centres."""
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customers = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    suppliers = read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    owners = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    moved = lines.join(owners, F.col("l_orderkey") == F.col("o_orderkey")).join(
        suppliers, F.col("l_suppkey") == F.col("s_suppkey")
    )
    counted = moved.groupBy("c_nationkey", "s_nationkey").agg(F.count(F.lit(1)).alias("n_lines"))
    centre = [
        place
        for key in ("c_nationkey", "s_nationkey")
        for place in (F.col(key) * F.lit(3.25) - 40, F.col(key) * F.lit(13.5) - 170)
    ]
    distance = F.round(values.great_circle_distance(*centre, unit=unit), 6)
    return counted.withColumn("distance", distance)


def _shipping_sql(factor: str) -> str:
    lat = "radians({0} * 3.25::DOUBLE - 40)"
    lon = "radians({0} * 13.5::DOUBLE - 170)"
    a, b = "c_nationkey", "s_nationkey"
    return f"""SELECT c_nationkey, s_nationkey, count(*) AS n_lines, round(2 * 3961 * asin(sqrt(
        pow(sin(({lat.format(b)} - {lat.format(a)}) / 2), 2) + cos({lat.format(a)}) * cos({lat.format(b)})
        * pow(sin(({lon.format(b)} - {lon.format(a)}) / 2), 2))) * {factor}, 6) AS distance
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
      JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2"""


@query(_shipping_sql("1::DOUBLE"))
def haversine_mi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shipping(spark, sf_dir, "mi")


@query(_shipping_sql("1.60934::DOUBLE"))
def haversine_km(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shipping(spark, sf_dir, "km")


@query(
    """SELECT split_part(split_part(replace(replace(replace(url, 'android-app://', ''), 'http://', ''), 'https://', ''),
      '/', 1), '?', 1) AS host, count(*) AS n FROM pages GROUP BY 1"""
)
def url_host_traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.host_traffic(read(spark, sf_dir, "pages"), "url")


@query(
    """WITH bare AS (SELECT replace(replace(url, 'http://', ''), 'https://', '') AS u FROM pages)
    SELECT split_part(right(u, length(u) - coalesce(nullif(instr(u, '/'), 0), instr(u, '?') - 1)), '?', 1) AS path,
      count(*) AS n FROM bare GROUP BY 1"""
)
def url_path_traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.path_traffic(read(spark, sf_dir, "pages"), "url")


@query(
    """SELECT parameter, nullif(split_part(split_part(url, parameter || '=', 2), '&', 1), '') AS value, count(*) AS n
    FROM pages, (VALUES ('utm_source'), ('page'), ('ref')) AS p(parameter) GROUP BY 1, 2"""
)
def url_parameter_traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.parameter_traffic(read(spark, sf_dir, "pages"), "url", ["utm_source", "page", "ref"])


@query(
    """SELECT regexp_replace(regexp_replace(regexp_replace(lower(label), '[ -]+', '_', 'g'), '[^a-z0-9_]+', '', 'g'),
      '^([0-9])', '_\\1') AS slug, count(*) AS n
    FROM (SELECT o_orderpriority || ' (' || o_orderstatus || ')' AS label FROM orders) GROUP BY 1"""
)
def slugify_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.concat("o_orderpriority", F.lit(" ("), "o_orderstatus", F.lit(")"))
    return read(spark, sf_dir, "orders").groupBy(text.slugify(label).alias("slug")).agg(F.count(F.lit(1)).alias("n"))


# Staging and landing.


@query(
    "WITH " + domain.check_tables() + f""" SELECT * REPLACE (CAST(date_facture AS VARCHAR) AS date_facture,
      {domain.exact("montant_HT")} AS montant_HT, {domain.exact("montant_TVA")} AS montant_TVA) FROM facture"""
)
def stg_facture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.invoices(domain.facture(spark, sf_dir))


@query(
    "WITH " + domain.check_tables() + f""" SELECT * EXCLUDE (CIP, Date_d_entr__e) REPLACE (CAST(Date_primes AS VARCHAR)
      AS Date_primes, {domain.exact("Montant_prime")} AS Montant_prime), CIP AS referent, Date_d_entr__e AS date_entree
    FROM bonus_sheet"""
)
def stg_prime_compile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.compiled_bonuses(domain.bonus_sheet(spark, sf_dir))


@query("SELECT * FROM supplier")
def stg_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Placements, passed through whatever their columns."""
    return staging.placements(read(spark, sf_dir, "supplier"))


@query(enrolment_sql(without_trainer=True))
def stg_inscrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flattened enrolments of both companies, all columns; those without a trainer keep their row."""
    flat = [staging.enrolments(table) for table in domain.enrolments(spark, sf_dir)]
    return flat[0].unionByName(flat[1])


@query(
    "WITH " + domain.check_tables() + ", flat AS (SELECT * FROM benef) SELECT * REPLACE (CAST(date_demarrage AS VARCHAR) "
    "AS date_demarrage, CAST(date_fin_theo AS VARCHAR) AS date_fin_theo, CAST(date_fin_prest AS VARCHAR) AS "
    "date_fin_prest, CAST(date_exclu_factu AS VARCHAR) AS date_exclu_factu) FROM flat"
)
def stg_benef(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.beneficiaries(domain.benef(spark, sf_dir))


@query(
    "WITH " + domain.check_tables() + """ SELECT * REPLACE (strftime(date_deb, '%Y-%m-%d %H:%M:%S') AS date_deb,
      strftime(date_fin, '%Y-%m-%d %H:%M:%S') AS date_fin, CASE lower(typage) WHEN 'entretien de diagnostic' THEN
      'Entretien de Diagnostic' WHEN 'entretien de validation' THEN 'Entretien de Diagnostic' ELSE typage END AS typage)
    FROM rdv"""
)
def stg_rdv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.appointments(domain.rdv(spark, sf_dir))


@query(
    "SELECT "
    + ", ".join(f"{expr} AS {name}" for name, expr in domain.ENTITIES.items())
    + " FROM supplier"
)
def stg_entites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.entities(domain.entities(spark, sf_dir))


@query(ATTENDANCE)
def stg_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flattened attendance of all three companies, every column."""
    flat = [staging.attendance(raw, name) for name, raw in domain.sessions(spark, sf_dir).items()]
    return reduce(DataFrame.unionByName, flat)


@query(
    """WITH lines AS (SELECT conv_id, turn, role, len(string_split(text, chr(10))) AS n FROM conversations
      WHERE role <> 'system')
    SELECT source_table, convention_id, convention_internal_id, convention_libelle, client_id, client_nom, financeur_id,
      financeur_nom, CAST(sum(slots) AS BIGINT) AS slots FROM (
      SELECT 'Presence_Soc_' || (conv_id % 3 + 2) AS source_table,
        CASE WHEN conv_id % 3 <> 1 THEN conv_id END AS convention_id,
        CASE WHEN conv_id % 3 <> 1 THEN '7' END AS convention_internal_id,
        CASE WHEN conv_id % 3 <> 1 THEN 'CONV' END AS convention_libelle,
        CASE WHEN conv_id % 3 <> 1 THEN turn END AS client_id, CASE WHEN conv_id % 3 <> 1 THEN 'CLIENT' END AS client_nom,
        CAST(NULL AS BIGINT) AS financeur_id, CASE WHEN conv_id % 3 <> 1 THEN 'FIN' END AS financeur_nom,
        n * CASE turn % 4 WHEN 3 THEN 2 ELSE 1 END AS slots FROM lines) GROUP BY ALL"""
)
def stg_presence_conventions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slots per agreement of the flattened attendance, agreements read from JSON text."""
    flat = [staging.attendance(raw, name) for name, raw in domain.sessions(spark, sf_dir).items()]
    keys = [
        "source_table", "convention_id", "convention_internal_id", "convention_libelle", "client_id", "client_nom",
        "financeur_id", "financeur_nom",
    ]
    both = flat[0].unionByName(flat[1]).unionByName(flat[2])
    return both.groupBy(*keys).agg(F.count(F.lit(1)).alias("slots"))


@query(
    """SELECT event_id AS _id, event_type AS meta_kind, user_id AS owner_user_id, event_type AS tag_name FROM events"""
)
def field_name_cleaning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested events with unclean names, cleaned at every depth."""
    nested = read(spark, sf_dir, "events").selectExpr(
        "event_id AS `$id`", "event_type AS `meta.kind`", "named_struct('user-id', user_id) AS `the owner`",
        "array(named_struct('tag name', event_type)) AS `#tags`",
    )
    return landing.clean_fields(nested).selectExpr(
        "_id", "meta_kind", "the_owner.user_id AS owner_user_id", "_tags[0].tag_name AS tag_name"
    )


DOCUMENT = "conv_id bigint, turn bigint, role string, text string"


def _landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation turn as a JSON line; every seventh line is cut short. Stamped by the turn."""
    turns = read(spark, sf_dir, "conversations")
    whole = F.to_json(F.struct("conv_id", "turn", "role", "text"))
    broken = F.concat(F.lit('{"conv_id": '), F.col("conv_id").cast("string"))
    lines = turns.select(
        F.concat(F.lit("company_"), (F.col("conv_id") % 4).cast("string")).alias("table"),
        F.timestamp_add("HOUR", F.col("turn").cast("int"), F.lit("2024-05-01 06:00:00").cast("timestamp_ntz")).alias("at"),
        F.when((F.col("conv_id") + F.col("turn")) % 7 == 0, broken).otherwise(whole).alias("value"),
    )
    return landing.stamp(landing.parse_documents(lines, DOCUMENT), F.col("at")).drop("at")


@query(
    """SELECT 'company_' || (conv_id % 4) AS "table", count(*) FILTER ((conv_id + turn) % 7 <> 0) AS total_records,
      count(*) FILTER ((conv_id + turn) % 7 = 0) AS rejected,
      strftime(max(TIMESTAMP '2024-05-01 06:00:00' + to_hours(turn)) FILTER ((conv_id + turn) % 7 <> 0),
        '%Y-%m-%dT%H:%M:%S') || '.000000' AS last_extracted_at,
      count(*) FILTER ((conv_id + turn) % 7 <> 0) > 0 AS success FROM conversations GROUP BY 1"""
)
def load_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.load_report(_landed(spark, sf_dir))


@query(
    """WITH t AS (SELECT conv_id % 4 AS k, count(*) FILTER ((conv_id + turn) % 7 <> 0) AS n FROM conversations GROUP BY 1)
    SELECT count(*) FILTER (n > 0) AS success, count(*) FILTER (n = 0) AS failed, CAST(sum(n) AS BIGINT) AS total_records
    FROM t"""
)
def load_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.load_totals(audit.load_report(_landed(spark, sf_dir)))


@query(
    """SELECT '{"conv_id": ' || conv_id AS _corrupt_record FROM conversations WHERE (conv_id + turn) % 7 = 0"""
)
def rejected_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing.rejected(_landed(spark, sf_dir))


@query(
    """SELECT conv_id, role, text, strftime(TIMESTAMP '2024-05-01 06:00:00' + to_hours(turn), '%Y-%m-%dT%H:%M:%S')
      || '.000000' AS _extracted_at FROM conversations WHERE (conv_id + turn) % 7 <> 0
    QUALIFY row_number() OVER (PARTITION BY conv_id, role ORDER BY turn DESC) = 1"""
)
def latest_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest accepted document of each conversation and role after repeated loads."""
    good = landing.accepted(_landed(spark, sf_dir)).select("conv_id", "role", "text", landing.STAMP)
    return landing.latest(good, ["conv_id", "role"])
