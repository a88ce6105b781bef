"""Data-quality checks over whole test tables with planted faults, each beside its check SQL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseworks.quality import checks, fused, suite
from caseworks.workload.domain import exact, read

QUERIES: dict = {}
CHECKS: dict[str, str] = {}

NOW = dt.datetime(2024, 1, 30, 23, 0)


def check(sql: str):
    """Register a check under 'check_' and its function name, with the SQL that must give the same rows."""

    def keep(build):
        QUERIES[f"check_{build.__name__}"] = build
        CHECKS[f"check_{build.__name__}"] = sql
        return build

    return keep


def _lines(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *columns)


@check(
    """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity < 5 OR l_quantity > 45"""
)
def accepted_range(spark, sf_dir):
    return checks.accepted_range(_lines(spark, sf_dir, "l_quantity"), "l_quantity", 5, 45)


@check(
    """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity <= 5"""
)
def accepted_range_exclusive(spark, sf_dir):
    """A lower end only, itself not allowed."""
    return checks.accepted_range(_lines(spark, sf_dir, "l_quantity"), "l_quantity", min_value=5, inclusive=False)


@check(
    """SELECT o_custkey, count(CASE WHEN o_orderstatus = 'P' AND o_orderkey % 3 = 0 THEN 1 END) AS filler_column
    FROM orders GROUP BY 1 HAVING filler_column = 0"""
)
def at_least_one_grouped(spark, sf_dir):
    """Customers without a value in a mostly empty column."""
    orders = read(spark, sf_dir, "orders")
    rare = F.when((F.col("o_orderstatus") == "P") & (F.col("o_orderkey") % 3 == 0), 1)
    return checks.at_least_one(orders.withColumn("rare", rare), "rare", ["o_custkey"])


@check("SELECT count(CASE WHEN o_orderkey < 0 THEN 1 END) AS filler_column FROM orders HAVING filler_column = 0")
def at_least_one(spark, sf_dir):
    """A column that is NULL throughout."""
    orders = read(spark, sf_dir, "orders").withColumn("never", F.when(F.col("o_orderkey") < 0, 1))
    return checks.at_least_one(orders, "never")


@check(
    """WITH a AS (SELECT o_custkey, count(*) AS num_rows FROM orders GROUP BY 1),
    b AS (SELECT c_custkey, count(*) AS num_rows FROM customer GROUP BY 1)
    (FROM a EXCEPT FROM b) UNION ALL (FROM b EXCEPT FROM a)"""
)
def cardinality_equality(spark, sf_dir):
    return checks.cardinality_equality(
        read(spark, sf_dir, "orders"), "o_custkey", read(spark, sf_dir, "customer"), "c_custkey"
    )


@check(
    """SELECT count_a, count_b, abs(count_a - count_b) AS diff_count
    FROM (SELECT count(*) AS count_a FROM orders), (SELECT count(*) AS count_b FROM customer)"""
)
def equal_rowcount(spark, sf_dir):
    return checks.equal_rowcount(read(spark, sf_dir, "orders"), read(spark, sf_dir, "customer"))


def _by_nation(spark, sf_dir):
    """Customers and suppliers by nation; two nations are NULL on both sides, one is missing on each."""
    def nation(name: str, missing: int):
        key = F.col(name)
        return F.when(key > 1, F.when(key != missing, key).otherwise(key + 100)).alias("nation")

    return (
        read(spark, sf_dir, "customer").select(nation("c_nationkey", 5)),
        read(spark, sf_dir, "supplier").select(nation("s_nationkey", 7)),
    )


_NATIONS = """WITH a AS (SELECT CASE WHEN c_nationkey > 1 THEN CASE c_nationkey WHEN 5 THEN 105 ELSE c_nationkey END END
    AS nation, count(*) AS n FROM customer GROUP BY 1),
  b AS (SELECT CASE WHEN s_nationkey > 1 THEN CASE s_nationkey WHEN 7 THEN 107 ELSE s_nationkey END END AS nation,
    count(*) AS n FROM supplier GROUP BY 1)"""


@check(
    f"""{_NATIONS} SELECT a.nation AS nation_a, b.nation AS nation_b, a.n AS count_a, b.n AS count_b,
      abs(a.n - b.n) AS diff_count FROM a FULL JOIN b ON a.nation = b.nation"""
)
def equal_rowcount_grouped(spark, sf_dir):
    return checks.equal_rowcount(*_by_nation(spark, sf_dir), ["nation"])


@check(
    f"""{_NATIONS} SELECT a.nation AS nation_a, b.nation AS nation_b, a.n AS count_our_model, b.n AS count_comparison_model,
      CASE WHEN a.n > b.n THEN a.n - b.n WHEN a.n = b.n THEN 1 ELSE 0 END AS row_count_delta
    FROM a FULL JOIN b ON a.nation = b.nation"""
)
def fewer_rows_than_grouped(spark, sf_dir):
    return checks.fewer_rows_than(*_by_nation(spark, sf_dir), ["nation"])


@check(
    """SELECT *, greatest(count_our_model - count_comparison_model, 0) AS row_count_delta
    FROM (SELECT count(*) AS count_our_model FROM orders), (SELECT count(*) AS count_comparison_model FROM customer)"""
)
def fewer_rows_than(spark, sf_dir):
    return checks.fewer_rows_than(read(spark, sf_dir, "orders"), read(spark, sf_dir, "customer"))


def _changed_orders(spark, sf_dir):
    """Orders, and the same with every 50th price and some statuses changed."""
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    price = F.when(F.col("o_orderkey") % 50 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice") + 0.0001)
    status = F.when(F.col("o_orderkey") % 70 != 0, F.col("o_orderstatus"))
    return orders, orders.withColumns({"o_totalprice": price, "o_orderstatus": status})


_CHANGED = """WITH a AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders),
  b AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 70 <> 0 THEN o_orderstatus END AS o_orderstatus,
    CASE WHEN o_orderkey % 50 = 0 THEN o_totalprice + 1 ELSE o_totalprice + 0.0001::DOUBLE END AS o_totalprice FROM orders)"""


@check(
    f"""{_CHANGED}, x AS (SELECT * EXCLUDE (o_totalprice) FROM a), y AS (SELECT * EXCLUDE (o_totalprice) FROM b)
    SELECT 'a_minus_b' AS which_diff, * FROM (FROM x EXCEPT FROM y)
    UNION ALL SELECT 'b_minus_a', * FROM (FROM y EXCEPT FROM x)"""
)
def equality(spark, sf_dir):
    """Differences without the price column."""
    return checks.equality(*_changed_orders(spark, sf_dir), exclude_columns=["O_TOTALPRICE"])


@check(
    f"""{_CHANGED}, x AS (SELECT o_orderkey, round(CAST(o_totalprice AS DECIMAL(38,9)), 2) AS o_totalprice FROM a),
    y AS (SELECT o_orderkey, round(CAST(o_totalprice AS DECIMAL(38,9)), 2) AS o_totalprice FROM b)
    SELECT 'a_minus_b' AS which_diff, o_orderkey, {exact("o_totalprice")} AS o_totalprice FROM (FROM x EXCEPT FROM y)
    UNION ALL SELECT 'b_minus_a', o_orderkey, {exact("o_totalprice")} FROM (FROM y EXCEPT FROM x)"""
)
def equality_precision(spark, sf_dir):
    """Differences in key and price once numbers are rounded to two places."""
    return checks.equality(*_changed_orders(spark, sf_dir), compare_columns=["o_orderkey", "o_totalprice"], precision=2)


@check(
    """SELECT l_orderkey, l_linenumber, l_extendedprice, l_discount FROM lineitem
    WHERE NOT (l_extendedprice * (1 - l_discount) < 50000)"""
)
def expression_is_true(spark, sf_dir):
    lines = _lines(spark, sf_dir, "l_extendedprice", "l_discount")
    return checks.expression_is_true(lines, "l_extendedprice * (1 - l_discount) < 50000")


@check("SELECT l_orderkey, l_linenumber, l_discount FROM lineitem WHERE NOT (l_discount + 0.01::DOUBLE < 0.1::DOUBLE)")
def expression_is_true_column(spark, sf_dir):
    return checks.expression_is_true(_lines(spark, sf_dir, "l_discount"), "+ 0.01D < 0.1D", column="l_discount")


def _ranges_sql(source: str, group: str, lower: str, upper: str, length: str, gap: str, words: tuple[str, str]) -> str:
    key = f"{group} AS partition_by_col," if group else ""
    part = f"PARTITION BY {group}" if group else ""
    return f"""WITH w AS (SELECT {key} {lower} AS lower_bound, {upper} AS upper_bound,
        lead({lower}) OVER ({part} ORDER BY {lower} NULLS FIRST, {upper} NULLS FIRST) AS next_lower_bound,
        lead(1) OVER ({part} ORDER BY {lower} NULLS FIRST, {upper} NULLS FIRST) IS NULL AS is_last_record
      FROM {source}),
    c AS (SELECT *, coalesce(lower_bound {length} upper_bound, false) AS lower_bound_{words[0]}_upper_bound,
        coalesce(upper_bound {gap} next_lower_bound, is_last_record, false) AS upper_bound_{words[1]}_next_lower_bound
      FROM w)
    SELECT * FROM c WHERE NOT (lower_bound_{words[0]}_upper_bound AND upper_bound_{words[1]}_next_lower_bound)"""


@check(
    _ranges_sql(
        "orders", "o_custkey", "o_orderdate", "o_orderdate + INTERVAL 60 DAY", "<", "<=",
        ("less_than", "less_than_or_equal_to"),
    )
)
def mutually_exclusive_ranges(spark, sf_dir):
    """Sixty days per order, clashing within a customer."""
    return checks.mutually_exclusive_ranges(
        read(spark, sf_dir, "orders"), "o_orderdate", "o_orderdate + INTERVAL 60 DAY", partition_by="o_custkey"
    )


@check(
    _ranges_sql(
        "lineitem", "", "l_partkey", "CASE WHEN l_partkey % 2 = 0 THEN l_partkey ELSE l_partkey + 1 END", "<=", "=",
        ("less_than_or_equal_to", "equal_to"),
    )
)
def mutually_exclusive_ranges_no_gaps(spark, sf_dir):
    """One group over the whole table, with many equal ranges and empty ones allowed."""
    return checks.mutually_exclusive_ranges(
        read(spark, sf_dir, "lineitem"), "l_partkey", "CASE WHEN l_partkey % 2 = 0 THEN l_partkey ELSE l_partkey + 1 END",
        gaps="not_allowed", zero_length_range_allowed=True,
    )


@check(
    _ranges_sql(
        "events", "event_type", "ts", "CASE WHEN event_id % 9 <> 0 THEN ts + INTERVAL 3 MINUTE END", "<", "<",
        ("less_than", "less_than"),
    )
)
def mutually_exclusive_ranges_gaps(spark, sf_dir):
    """A gap is required between events of a type; some ranges have no end."""
    return checks.mutually_exclusive_ranges(
        read(spark, sf_dir, "events"), "ts", "CASE WHEN event_id % 9 <> 0 THEN ts + INTERVAL 3 MINUTE END",
        partition_by="event_type", gaps="required",
    )


@check("SELECT DISTINCT event_type AS value_field FROM events WHERE event_type IN ('error', 'view', 'none')")
def not_accepted_values(spark, sf_dir):
    return checks.not_accepted_values(read(spark, sf_dir, "events"), "event_type", ["error", "view", "none"])


@check("SELECT o_custkey, count(DISTINCT o_orderstatus) AS filler_column FROM orders GROUP BY 1 HAVING filler_column = 1")
def not_constant_grouped(spark, sf_dir):
    return checks.not_constant(read(spark, sf_dir, "orders"), "o_orderstatus", ["o_custkey"])


@check("SELECT count(DISTINCT o_orderkey * 0) AS filler_column FROM orders HAVING filler_column = 1")
def not_constant(spark, sf_dir):
    return checks.not_constant(read(spark, sf_dir, "orders").selectExpr("o_orderkey * 0 AS zero"), "zero")


@check("SELECT trim(CASE p_size % 4 WHEN 0 THEN '  ' WHEN 1 THEN '' ELSE p_name END) AS name FROM part WHERE name = ''")
def not_empty_string(spark, sf_dir):
    blanked = "CASE p_size % 4 WHEN 0 THEN '  ' WHEN 1 THEN '' ELSE p_name END AS name"
    return checks.not_empty_string(read(spark, sf_dir, "part").selectExpr(blanked), "name")


@check("SELECT CASE p_size % 4 WHEN 0 THEN '  ' WHEN 1 THEN '' ELSE p_name END AS name FROM part WHERE name = ''")
def not_empty_string_untrimmed(spark, sf_dir):
    blanked = "CASE p_size % 4 WHEN 0 THEN '  ' WHEN 1 THEN '' ELSE p_name END AS name"
    return checks.not_empty_string(read(spark, sf_dir, "part").selectExpr(blanked), "name", trim_whitespace=False)


@check(
    f"""SELECT l_suppkey, {exact("share")} AS not_null_proportion FROM (
      SELECT l_suppkey, CAST(count(nullif(l_returnflag, 'A')) / count(*) AS DECIMAL(28,9)) AS share FROM lineitem GROUP BY 1)
    WHERE share < 0.65 OR share > 0.68"""
)
def not_null_proportion_grouped(spark, sf_dir):
    """Share of lines with a flag per supplier, the flag 'A' counting as missing."""
    lines = read(spark, sf_dir, "lineitem").selectExpr("l_suppkey", "nullif(l_returnflag, 'A') AS flag")
    return checks.not_null_proportion(lines, "flag", 0.65, 0.68, ["l_suppkey"])


@check(
    f"""SELECT {exact("count(nullif(l_returnflag, 'A')) / count(*)")} AS not_null_proportion FROM lineitem"""
)
def not_null_proportion(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem").selectExpr("nullif(l_returnflag, 'A') AS flag")
    return checks.not_null_proportion(lines, "flag", 0.9)


@check(
    """SELECT user_id, max(ts) AS most_recent, TIMESTAMP '2024-01-30 17:00:00' AS threshold FROM events GROUP BY 1
    HAVING most_recent < threshold"""
)
def recency_grouped(spark, sf_dir):
    return checks.recency(read(spark, sf_dir, "events"), "ts", "hour", 6, group_by=["user_id"], now=NOW)


@check(
    """SELECT event_type, user_id, CAST(CAST(max(ts) AS DATE) AS VARCHAR) AS most_recent, '2024-01-25' AS threshold
    FROM events GROUP BY 1, 2 HAVING CAST(max(ts) AS DATE) < DATE '2024-01-25'"""
)
def recency_days(spark, sf_dir):
    return checks.recency(
        read(spark, sf_dir, "events"), "ts", "day", 5, ignore_time_component=True, group_by=["event_type", "user_id"], now=NOW
    )


@check(
    """SELECT l_partkey AS id, CAST(NULL AS BIGINT) AS right_id FROM lineitem WHERE l_quantity > 10 AND NOT EXISTS
      (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_size < 25)"""
)
def relationships_where(spark, sf_dir):
    return checks.relationships_where(
        read(spark, sf_dir, "lineitem"), "l_partkey", read(spark, sf_dir, "part"), "p_partkey",
        from_condition="l_quantity > 10", to_condition="p_size < 25",
    )


def _sequence_sql(source: str, group: str, column: str, step: str) -> str:
    key, part = (f"{group},", f"PARTITION BY {group}") if group else ("", "")
    return f"""WITH w AS (SELECT {key} {column}, lag({column}) OVER ({part} ORDER BY {column}) AS previous_{column}
      FROM {source}) SELECT * FROM w WHERE NOT ({column} = previous_{column} + {step})"""


@check(_sequence_sql("(SELECT event_id + event_id // 50 AS number FROM events)", "", "number", "1"))
def sequential_values(spark, sf_dir):
    """Gaps in a numbering of all events that skips one in fifty, over the table as one sequence."""
    return checks.sequential_values(read(spark, sf_dir, "events").selectExpr("event_id + event_id DIV 50 AS number"), "number")


@check(_sequence_sql("lineitem", "l_returnflag", "l_partkey", "1"))
def sequential_values_grouped(spark, sf_dir):
    """Part numbers per return flag: three large groups with many equal values."""
    return checks.sequential_values(read(spark, sf_dir, "lineitem"), "l_partkey", group_by=["l_returnflag"])


@check(_sequence_sql("(SELECT date_trunc('hour', ts) AS hour FROM events)", "", "hour", "INTERVAL 1 HOUR"))
def sequential_values_hourly(spark, sf_dir):
    hours = read(spark, sf_dir, "events").select(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"))
    return checks.sequential_values(hours, "hour", datepart="hour")


@check("SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def unique_combination_of_columns(spark, sf_dir):
    return checks.unique_combination(read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@check("SELECT l_orderkey, l_linenumber, nullif(l_returnflag, 'A') AS flag FROM lineitem WHERE flag IS NULL")
def not_null(spark, sf_dir):
    return checks.not_null(_lines(spark, sf_dir, F.expr("nullif(l_returnflag, 'A') AS flag")), "flag")


@check("SELECT o_custkey AS unique_field, count(*) AS n_records FROM orders GROUP BY 1 HAVING n_records > 1")
def unique(spark, sf_dir):
    return checks.unique(read(spark, sf_dir, "orders"), "o_custkey")


@check(
    """SELECT event_type AS value_field, count(*) AS n_records FROM events WHERE event_type NOT IN ('view', 'click')
    GROUP BY 1"""
)
def accepted_values(spark, sf_dir):
    return checks.accepted_values(read(spark, sf_dir, "events"), "event_type", ["view", "click"])


@check("SELECT c_custkey, c_custkey % 25 AS actual, c_nationkey AS expected FROM customer WHERE actual <> expected")
def assert_equal(spark, sf_dir):
    customers = read(spark, sf_dir, "customer").selectExpr(
        "c_custkey", "c_custkey % 25 AS actual", "c_nationkey AS expected"
    )
    return checks.assert_equal(customers, "actual", "expected")


@check(
    """SELECT * FROM (
      SELECT 'quantity_range' AS "check", count(*) FILTER (l_quantity < 5 OR l_quantity > 45) AS failures FROM lineitem
      UNION ALL SELECT 'price_limit', count(*) FILTER (NOT (l_extendedprice < 90000)) FROM lineitem
      UNION ALL SELECT 'flag_known', count(*) FILTER (l_returnflag IS NULL) FROM lineitem
      UNION ALL SELECT 'flag_not_blank', count(*) FILTER (trim(l_returnflag) = '') FROM lineitem),
      LATERAL (SELECT CASE WHEN failures <> 0 THEN 'error' ELSE 'pass' END AS status)"""
)
def row_suite(spark, sf_dir):
    """Four row-level checks in one scan."""
    return suite.run_row_checks(
        read(spark, sf_dir, "lineitem"),
        {
            "quantity_range": checks.out_of_range("l_quantity", 5, 45),
            "price_limit": checks.is_false("l_extendedprice < 90000"),
            "flag_known": F.col("l_returnflag").isNull(),
            "flag_not_blank": checks.is_blank("l_returnflag"),
        },
    )


@check(
    f"""{_NATIONS}, pairs AS (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)
    SELECT 'rows_per_nation' AS "check", CAST((SELECT sum(coalesce(abs(a.n - b.n), 0)) FROM a FULL JOIN b
      ON a.nation = b.nation) AS BIGINT) AS failures, 'error' AS status
    UNION ALL SELECT 'fewer_customers', (SELECT count(*) FROM customer) - (SELECT count(*) FROM supplier), 'warn'
    UNION ALL SELECT 'line_key', (SELECT count(*) FROM pairs), 'pass'
    UNION ALL SELECT 'same_segments', 0, 'pass'"""
)
def suite_thresholds(spark, sf_dir):
    """Checks on whole tables with their own failure counts, thresholds and severities."""
    customers, suppliers = _by_nation(spark, sf_dir)
    lines, segments = read(spark, sf_dir, "lineitem"), read(spark, sf_dir, "customer").select("c_mktsegment")
    return suite.run_checks(
        [
            suite.Check(
                "rows_per_nation", checks.equal_rowcount(customers, suppliers, ["nation"]), suite.summed("diff_count")
            ),
            suite.Check(
                "fewer_customers", checks.fewer_rows_than(customers, suppliers), suite.summed("row_count_delta"), severity="warn"
            ),
            suite.Check(
                "line_key", checks.unique_combination(lines, ["l_orderkey", "l_linenumber"]), warn_if="< 1", error_if="< 0"
            ),
            suite.Check("same_segments", checks.equality(segments, segments), suite.equality_failures()),
        ]
    )


@check(
    """SELECT 'small_parts_cheap' AS "check", count(*) FILTER (p_size <= 10 AND NOT p_retailprice <= 1500) AS failures,
      CASE WHEN count(*) FILTER (p_size <= 10 AND NOT p_retailprice <= 1500) > 0 THEN 'warn' ELSE 'pass' END AS status FROM part
    UNION ALL SELECT 'all_parts_cheap', count(*) FILTER (NOT p_retailprice <= 1500),
      CASE WHEN count(*) FILTER (NOT p_retailprice <= 1500) > 0 THEN 'error' ELSE 'pass' END FROM part"""
)
def suite_where(spark, sf_dir):
    """One rule on part of a table, as a warning, and on all of it."""
    part = read(spark, sf_dir, "part")

    def dear(rows):
        return checks.accepted_range(rows, "p_retailprice", max_value=1500)

    return suite.run_checks(
        [
            suite.Check.on("small_parts_cheap", part, dear, where="p_size <= 10", severity="warn"),
            suite.Check.on("all_parts_cheap", part, dear),
        ]
    )


@check(
    """SELECT max(ts) AS most_recent, TIMESTAMP '2024-01-30 17:00:00' AS threshold FROM events
    HAVING max(ts) < TIMESTAMP '2024-01-30 17:00:00' UNION ALL
    SELECT max(ts), TIMESTAMP '2024-01-30 17:00:00' FROM events WHERE user_id % 7 = 0
    HAVING max(ts) < TIMESTAMP '2024-01-30 17:00:00' UNION ALL
    SELECT max(ts) - INTERVAL 10 YEAR, TIMESTAMP '2024-01-30 17:00:00' FROM events
    HAVING max(ts) - INTERVAL 10 YEAR < TIMESTAMP '2024-01-30 17:00:00'"""
)
def recency_whole(spark, sf_dir):
    """Recency of a table as a whole: as it is, of some users, and with times moved back ten years."""
    events = read(spark, sf_dir, "events")
    moved = events.withColumn("ts", F.col("ts") - F.expr("INTERVAL 10 YEAR"))
    tables = (events, events.filter("user_id % 7 = 0"), moved)
    found = [checks.recency(table, "ts", "hour", 6, now=NOW) for table in tables]
    return found[0].unionAll(found[1]).unionAll(found[2])


# Rules of one table with the SQL that counts their violations.
LINE_RULES = [
    (fused.unique_combination("line_key", ["l_orderkey", "l_linenumber"]),
     "SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"),
    (fused.unique_combination("part_once_an_order", ["l_orderkey", "l_partkey"], severity="warn"),
     "SELECT 1 FROM lineitem GROUP BY l_orderkey, l_partkey HAVING count(*) > 1"),
    (fused.at_least_one("order_has_return", "returned", ["l_orderkey"]),
     "SELECT 1 FROM lineitem GROUP BY l_orderkey HAVING count(*) FILTER (l_returnflag = 'R') = 0"),
    (fused.not_constant("order_mixes_suppliers", "l_suppkey", ["l_orderkey"]),
     "SELECT 1 FROM lineitem GROUP BY l_orderkey HAVING min(l_suppkey) = max(l_suppkey)"),
    (fused.not_constant("part_mixes_dear_suppliers", "l_suppkey", ["l_partkey"], where="l_quantity > 40"),
     "SELECT 1 FROM lineitem WHERE l_quantity > 40 GROUP BY l_partkey HAVING min(l_suppkey) = max(l_suppkey)"),
    (fused.not_null_proportion("returns_a_supplier", "returned", 0.3, 0.35, ["l_suppkey"], warn_if="> 0", error_if="> 5"),
     "SELECT 1 FROM lineitem GROUP BY l_suppkey HAVING CAST(count(*) FILTER (l_returnflag = 'R') / count(*) AS DECIMAL(38, 9))"
     " NOT BETWEEN 0.3 AND 0.35"),
    (fused.recency("supplier_is_active", "l_shipdate", "day", 30, ["l_suppkey"], dt.datetime(2025, 1, 1)),
     "SELECT 1 FROM lineitem GROUP BY l_suppkey HAVING max(l_shipdate) < TIMESTAMP '2024-12-02'"),
    (fused.recency("table_is_recent", "l_shipdate", "hour", 1, now=dt.datetime(2100, 1, 1)),
     "SELECT 1 FROM lineitem HAVING max(l_shipdate) < TIMESTAMP '2099-12-31 23:00:00'"),
    (fused.at_least_one("any_return", "returned"),
     "SELECT 1 FROM lineitem HAVING count(*) FILTER (l_returnflag = 'R') = 0"),
    (fused.holds("quantity_in_range", "l_quantity BETWEEN 5 AND 45", severity="warn"),
     "SELECT 1 FROM lineitem WHERE l_quantity < 5 OR l_quantity > 45"),
    (fused.not_null("returned_known", "returned", where="l_linenumber = 1"),
     "SELECT 1 FROM lineitem WHERE l_linenumber = 1 AND l_returnflag <> 'R'"),
    (fused.unique("price_once", "l_extendedprice"),
     "SELECT 1 FROM lineitem WHERE l_extendedprice IS NOT NULL GROUP BY l_extendedprice HAVING count(*) > 1"),
]


def _counted(rule: fused.Rule, violations: str) -> str:
    status = f"WHEN failures {rule.warn_if.replace('!=', '<>')} THEN 'warn' ELSE 'pass' END AS status"
    if rule.severity == "error":
        status = f"WHEN failures {rule.error_if.replace('!=', '<>')} THEN 'error' {status}"
    return f"""SELECT '{rule.name}' AS "check", failures, CASE {status} FROM (SELECT count(*) AS failures FROM ({violations}))"""


@check(" UNION ALL ".join(_counted(rule, violations) for rule, violations in LINE_RULES))
def suite_fused(spark, sf_dir):
    """Twelve rules on six sets of group keys, from one scan."""
    lines = read(spark, sf_dir, "lineitem").withColumn("returned", F.when(F.col("l_returnflag") == "R", 1))
    return fused.run_rules(lines, [rule for rule, _ in LINE_RULES])
