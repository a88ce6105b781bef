from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from caseworks.quality import checks, fused, suite


def table(spark, schema, *data):
    return spark.createDataFrame([d if isinstance(d, tuple) else (d,) for d in data], schema)


def test_accepted_range(spark):
    df = table(spark, "id double", -1.0, 11.0, None)
    assert checks.accepted_range(df, "id", -1, 11).count() == 0
    assert checks.accepted_range(df, "id", -2, 11.1, inclusive=False).count() == 0
    assert rows(checks.accepted_range(df, "id", 0)) == [(-1.0,)]
    assert checks.accepted_range(df.filter("id <> -1"), "id", 0).count() == 0
    assert rows(checks.accepted_range(df, "id", -1, 11, inclusive=False)) == [(-1.0,), (11.0,)]
    assert checks.accepted_range(df, "id").count() == 0


def test_at_least_one(spark):
    df = table(spark, "field string, value int", ("a", 1), ("b", None))
    assert checks.at_least_one(df, "field").count() == 0
    assert rows(checks.at_least_one(df, "value", ["field"])) == [("b", 0)]
    assert checks.at_least_one(df.filter("field = 'b'"), "value").count() == 1


def test_cardinality_equality(spark):
    a, b = table(spark, "x int", 1, 2, 3), table(spark, "x int, y int", (1, 2), (2, 3), (3, 1))
    assert checks.cardinality_equality(a, "x", b, "x").count() == 0
    assert checks.cardinality_equality(a, "x", b, "y").count() == 0
    assert rows(checks.cardinality_equality(a, "x", table(spark, "z int", 1, 2, 2, None), "z")) == [
        (None, 1), (2, 1), (2, 2), (3, 1),
    ]


def test_equal_rowcount(spark):
    df = table(spark, "f int", 1, 1, 2, None)
    other = table(spark, "f int", 1, 3, None)
    assert rows(checks.equal_rowcount(df, df)) == [(4, 4, 0)]
    assert rows(checks.equal_rowcount(df, other)) == [(4, 3, 1)]
    got = set(rows(checks.equal_rowcount(df, other, ["f"])))
    assert got == {(1, 1, 2, 1, 1), (2, None, 1, None, None), (None, 3, None, 1, None), (None, None, 1, None, None),
                   (None, None, None, 1, None)}


def test_fewer_rows_than(spark):
    two, three = table(spark, "a int", 1, 1), table(spark, "a int", 1, 1, 2)
    assert rows(checks.fewer_rows_than(two, three)) == [(2, 3, 0)]
    assert rows(checks.fewer_rows_than(two, two)) == [(2, 2, 1)]
    assert rows(checks.fewer_rows_than(three, table(spark, "a int", 1))) == [(3, 1, 2)]
    assert (1, 1, 2, 2, 1) in rows(checks.fewer_rows_than(two, three, ["a"]))


def test_equality(spark):
    a = table(spark, "slot int, site string, hours int", (8, "Quai", 5), (9, "Quai", None), (9, None, 4), (10, "Gare", 2))
    b = table(spark, "slot int, site string, hours int", (8, "Quai", 6), (9, "Quai", None), (9, None, 4), (10, "Gare", 3))
    assert checks.equality(a, a).count() == 0
    assert sorted(r.which_diff for r in checks.equality(a, b).collect()) == ["a_minus_b"] * 2 + ["b_minus_a"] * 2
    assert checks.equality(a, b, compare_columns=["slot", "site"]).count() == 0
    assert checks.equality(a, b, exclude_columns=["HOURS"]).count() == 0
    assert checks.equality(a.drop("hours"), a, exclude_columns=["hours"]).count() == 0
    with pytest.raises(ValueError):
        checks.equality(a.drop("hours"), a)
    with pytest.raises(ValueError):
        checks.equality(a, a, ["slot"], ["site"])


def test_equality_precision(spark):
    schema = "id bigint, pay double, tax decimal(12,5), note string"
    a = table(spark, schema, (70001, 1250.1004, Decimal("3.10001"), "x"), (70002, 0.25, Decimal("1.5"), "x"))
    b = table(spark, schema, (70001, 1250.1003, Decimal("3.10002"), "y"), (70002, 0.25, Decimal("1.5"), "y"))
    assert checks.equality(a, b, exclude_columns=["note"], precision=3).count() == 0
    assert checks.equality(a, b, compare_columns=["id", "pay"], precision=3).count() == 0
    assert checks.equality(a, b, exclude_columns=["note"], precision=5).count() == 2
    assert checks.equality(a, b, precision=3).count() == 4


def test_equality_precision_leaves_whole_numbers_and_intervals(spark):
    df = spark.sql("SELECT 70001L AS id, 3 AS n, INTERVAL '1 02:03' DAY TO MINUTE AS span, 1.25D AS x")
    kinds = dict(checks.equality(df, df, precision=2).dtypes)
    assert (kinds["id"], kinds["n"], kinds["span"]) == ("bigint", "int", "interval day to minute")


def test_expression_is_true(spark):
    df = table(spark, "a double, b double", (0.0, 1.0), (1.0, 0.0), (0.5, 0.5), (None, 1.0))
    assert checks.expression_is_true(df, "a + b = 1").count() == 0
    assert checks.expression_is_true(df, "+ b = 1", column="a").count() == 0
    assert checks.expression_is_true(df, F.col("a") < 1).count() == 1


def test_mutually_exclusive_ranges(spark):
    no_gaps = table(spark, "lo int, hi int", (0, 1), (1, 2), (2, 4))
    assert checks.mutually_exclusive_ranges(no_gaps, "lo", "hi", gaps="not_allowed").count() == 0
    assert checks.mutually_exclusive_ranges(no_gaps, "lo", "hi", gaps="required").count() == 2
    day = dt.date
    with_gaps = table(
        spark, "s int, a date, b date", (1, day(2019, 1, 1), day(2019, 2, 1)), (1, day(2019, 3, 3), day(2019, 4, 1)),
        (2, day(2019, 5, 6), day(2019, 7, 2)), (2, day(2019, 7, 3), None), (3, day(2019, 1, 1), day(2019, 1, 1)),
    )
    upper = "coalesce(b, date'2099-01-01')"
    for gaps in ("allowed", "required"):
        bad = checks.mutually_exclusive_ranges(with_gaps, "a", upper, partition_by="s", gaps=gaps)
        assert [r.partition_by_col for r in bad.collect()] == [3]
    assert checks.mutually_exclusive_ranges(with_gaps, "a", upper, "s", zero_length_range_allowed=True).count() == 0
    assert checks.mutually_exclusive_ranges(with_gaps, "a", "b", "s", zero_length_range_allowed=True).count() == 1
    with pytest.raises(ValueError):
        checks.mutually_exclusive_ranges(no_gaps, "lo", "hi", gaps="some")


def test_mutually_exclusive_ranges_counts_every_copy(spark):
    df = table(spark, "lo int, hi int", (1, 3), (1, 3), (1, 3), (3, 4))
    bad = checks.mutually_exclusive_ranges(df, "lo", "hi")
    assert [(r.lower_bound, r.next_lower_bound, r.is_last_record) for r in bad.collect()] == [(1, 1, False)] * 2


def test_not_accepted_and_accepted_values(spark):
    df = table(spark, "city string", "Lima", "Oslo", "Oslo", None)
    assert rows(checks.not_accepted_values(df, "city", ["Oslo", "Rome"])) == [("Oslo",)]
    assert rows(checks.accepted_values(df, "city", ["Lima"])) == [("Oslo", 2)]


def test_not_constant(spark):
    df = table(spark, "g int, f int", (1, 1), (1, 1), (1, 2), (2, 7), (2, None), (3, None))
    assert checks.not_constant(df, "f").count() == 0
    assert rows(checks.not_constant(df, "f", ["g"])) == [(2, 1)]


def test_not_empty_string(spark):
    df = table(spark, "s string", "", "  ", None, "x", "\t")
    assert checks.not_empty_string(df, "s").count() == 3
    assert checks.not_empty_string(df, "s", trim_whitespace=False).count() == 1


def test_not_null_proportion(spark):
    df = table(spark, "half int, most int", *[(i if i % 2 else None, i if i else None) for i in range(10)])
    assert checks.not_null_proportion(df, "half", 0.5, 0.5).count() == 0
    assert checks.not_null_proportion(df, "most", 0.9).count() == 0
    assert checks.not_null_proportion(df, "most", 0.91).count() == 1
    assert checks.not_null_proportion(df, "half", 0, group_by=["most"]).count() == 0


def test_recency(spark):
    now = dt.datetime(2024, 5, 2, 12)
    df = table(spark, "g int, at timestamp_ntz", (1, now - dt.timedelta(hours=23)), (2, dt.datetime(2024, 5, 1)))
    assert rows(checks.recency(df, "at", "day", 1, group_by=["g"], now=now)) == [
        (2, dt.datetime(2024, 5, 1), dt.datetime(2024, 5, 1, 12))
    ]
    assert checks.recency(df, "at", "day", 1, now=now).count() == 0
    assert checks.recency(df, "at", "day", 1, ignore_time_component=True, group_by=["g"], now=now).count() == 0
    assert checks.recency(df.filter("g = 9"), "at", "day", 1, now=now).count() == 0
    assert checks.recency(df, "at", "day", 1).count() == 1


def test_relationships_where(spark):
    a, b = table(spark, "id int", 1, 2, 3), table(spark, "id int", 1, 2, 4, 4, None)
    assert rows(checks.relationships_where(b, "id", a, "id")) == [(4, None), (4, None)]
    assert checks.relationships_where(b, "id", a, "id", from_condition="id <> 4").count() == 0
    assert checks.relationships_where(a, "id", a, "id", to_condition="id < 3").count() == 1


def test_sequential_values(spark):
    df = table(spark, "g int, v int", (1, 2), (1, 4), (1, 6), (2, 8), (2, 10))
    assert checks.sequential_values(df, "v", interval=2).count() == 0
    assert checks.sequential_values(df, "v", interval=2, group_by=["g"]).count() == 0
    broken = table(spark, "v int", 1, 2, 2, 2, 5, None)
    assert rows(checks.sequential_values(broken, "v")) == [(2, 2), (2, 2), (5, 2)]
    hours = table(spark, "at timestamp_ntz", *[dt.datetime(2024, 3, 31, h) for h in (0, 1, 2, 3, 5)])
    assert rows(checks.sequential_values(hours, "at", datepart="hour")) == [
        (dt.datetime(2024, 3, 31, 5), dt.datetime(2024, 3, 31, 3))
    ]


def test_keys_and_equal_columns(spark):
    df = table(spark, "month string, product string", ("01", "p"), ("01", "q"), ("02", "p"), ("02", "p"), (None, "p"))
    assert rows(checks.unique_combination(df, ["month", "product"])) == [("02", "p")]
    assert rows(checks.unique(df, "month")) == [("01", 2), ("02", 2)]
    assert checks.not_null(df, "month").count() == 1
    assert rows(checks.assert_equal(table(spark, "x int, y int", (1, 1), (1, 2), (None, 3)), "x", "y")) == [(1, 2)]


def test_thresholds_and_severity(spark):
    df = table(spark, "x int", 1, 2, 3)
    bad = checks.accepted_range(df, "x", 2)
    got = {
        r.check: (r.failures, r.status)
        for r in suite.run_checks(
            [
                suite.Check("plain", bad),
                suite.Check("must_fail", bad, warn_if="< 0", error_if="< 1"),
                suite.Check("warned", bad, severity="warn"),
                suite.Check("tolerated", bad, warn_if="> 0", error_if="> 5"),
                suite.Check("passed", df.filter("x > 9")),
                suite.Check("unbalanced", checks.equality(df, df.filter("x = 1")), suite.equality_failures()),
                suite.Check("nothing", checks.equal_rowcount(df, df).filter("false"), suite.summed("diff_count")),
            ]
        ).collect()
    }
    assert got == {
        "plain": (1, "error"), "must_fail": (1, "pass"), "warned": (1, "warn"), "tolerated": (1, "warn"),
        "passed": (0, "pass"), "unbalanced": (4, "error"), "nothing": (0, "pass"),
    }


def test_row_checks_share_one_scan(spark):
    df = table(spark, "x int, s string", (1, "a"), (9, " "), (None, None))
    conditions = {"range": checks.out_of_range("x", 0, 5), "blank": checks.is_blank("s"), "even": checks.is_false("x % 2 = 1")}
    result = suite.run_row_checks(df, conditions)
    assert rows(result) == [("blank", 1, "error"), ("even", 0, "pass"), ("range", 1, "error")]


FUSED_NOW = dt.datetime(2024, 2, 1)
# Each rule with the check that must give the same number of violations.
FUSED = [
    (fused.at_least_one("a", "v", ["g"]), lambda df: checks.at_least_one(df, "v", ["g"])),
    (fused.at_least_one("b", "v"), lambda df: checks.at_least_one(df, "v")),
    (fused.not_constant("c", "v", ["g", "h"]), lambda df: checks.not_constant(df, "v", ["g", "h"])),
    (fused.not_constant("d", "v", ["h", "g"], where="v > 1"), lambda df: checks.not_constant(df.filter("v > 1"), "v", ["g", "h"])),
    (fused.not_constant("e", "v"), lambda df: checks.not_constant(df, "v")),
    (fused.unique_combination("f", ["g", "v"]), lambda df: checks.unique_combination(df, ["g", "v"])),
    (fused.unique("g", "v"), lambda df: checks.unique(df, "v")),
    (fused.unique("h", "v", where="h = 1"), lambda df: checks.unique(df.filter("h = 1"), "v")),
    (fused.recency("i", "t", "day", 3, ["g"], FUSED_NOW), lambda df: checks.recency(df, "t", "day", 3, group_by=["g"], now=FUSED_NOW)),
    (fused.recency("j", "t", "day", 3, now=FUSED_NOW), lambda df: checks.recency(df, "t", "day", 3, now=FUSED_NOW)),
    (fused.holds("k", "v < 3"), lambda df: checks.expression_is_true(df, "v < 3")),
    (fused.not_null("l", "v", where="h = 1"), lambda df: checks.not_null(df.filter("h = 1"), "v")),
    (fused.not_null("m", "g"), lambda df: checks.not_null(df, "g")),
]
SHARES = [
    (fused.not_null_proportion("n", "v", 0.5, 0.9, ["g"]), lambda df: checks.not_null_proportion(df, "v", 0.5, 0.9, ["g"])),
    (fused.not_null_proportion("o", "v", 0.9), lambda df: checks.not_null_proportion(df, "v", 0.9)),
]


def mixed_rows(spark, n):
    """Groups of several sizes with NULL keys and values; one group holds about a third of all rows."""
    v = F.when(F.col("id") % 4 != 0, F.col("id") % 7)
    g = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 11 != 0, F.col("id") % 29)
    t = F.timestamp_add("HOUR", -(F.col("id") % 200).cast("int"), F.lit("2024-02-01 00:00:00").cast("timestamp_ntz"))
    return spark.range(n).select(g.alias("g"), (F.col("id") % 2).alias("h"), v.alias("v"), t.alias("t"))


@pytest.mark.parametrize("n", [0, 1, 12, 400])
def test_fused_rules_count_like_the_checks(spark, n):
    df = mixed_rows(spark, n)
    pairs = FUSED + (SHARES if n else [])
    got = {r["check"]: (r.failures, r.status) for r in fused.run_rules(df, [rule for rule, _ in pairs]).collect()}
    want = {rule.name: build(df).count() for rule, build in pairs}
    assert got == {name: (count, "error" if count else "pass") for name, count in want.items()}


def test_fused_rules_read_the_table_once(spark, tmp_path):
    mixed_rows(spark, 50).write.parquet(f"{tmp_path}/rows")
    rules = [rule for rule, _ in FUSED + SHARES]
    plan = fused.run_rules(spark.read.parquet(f"{tmp_path}/rows"), rules)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    assert plan.count("Exchange hashpartitioning") == 1


def test_fused_rules_have_thresholds(spark):
    df = mixed_rows(spark, 100)
    rules = [
        fused.holds("warned", "v < 3", severity="warn"),
        fused.holds("few", "v < 3", warn_if="> 1", error_if="> 1000"),
        fused.holds("fine", "v < 3", warn_if="> 1000", error_if="> 1000"),
    ]
    assert {r["check"]: r.status for r in fused.run_rules(df, rules).collect()} == {
        "warned": "warn", "few": "warn", "fine": "pass",
    }
    assert fused.run_rules(df, rules[:1]).columns == ["check", "failures", "status"]
    with pytest.raises(ValueError, match="no rules"):
        fused.run_rules(df, [])


def test_fused_rules_share_of_an_empty_table(spark):
    """No rows, no share."""
    df = mixed_rows(spark, 0)
    assert [r.failures for r in fused.run_rules(df, [rule for rule, _ in SHARES]).collect()] == [0, 0]


def test_fused_groupings_share_columns_and_meet_in_even_tasks(spark):
    """No group's row carries the keys or parts of other groupings, and no task meets more rows than others."""
    df = mixed_rows(spark, 50)
    keys = [fused.unique_combination(name, [name]) for name in ("g", "h", "v")]
    latest = fused.recency("t", "t", "day", 3, ["t"], FUSED_NOW)
    result = fused.run_rules(df, [*keys, latest])
    plan = result._jdf.queryExecution().optimizedPlan().toString()
    assert "RebalancePartitions" in plan
    grouped = next(line for line in plan.splitlines() if "Aggregate [_grouping" in line).partition("], [")[0]
    assert grouped.count("_key") == 2  # one for the three numbers, one for the time
    assert [r.failures for r in result.collect()] == [*(checks.unique_combination(df, [c]).count() for c in "ghv"),
        checks.recency(df, "t", "day", 3, group_by=["t"], now=FUSED_NOW).count()]
