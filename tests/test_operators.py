from __future__ import annotations

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from caseworks.operators import frequent, joins, ordered, reports, reshape
from caseworks.operators import rows as row_ops


def test_date_spine_leaves_out_the_end(spark):
    days = [r[0] for r in row_ops.date_spine(spark, "day", dt.date(2018, 1, 1), dt.date(2018, 1, 10)).orderBy("date_day").collect()]
    assert days == [dt.date(2018, 1, d) for d in range(1, 10)]


@pytest.mark.parametrize(
    ("part", "start", "end", "expected"),
    [
        ("month", dt.date(2023, 11, 15), dt.date(2024, 2, 1), ["2023-11-15", "2023-12-15", "2024-01-15"]),
        ("week", dt.date(2024, 1, 1), dt.date(2024, 1, 15), ["2024-01-01", "2024-01-08"]),
        ("year", dt.date(2022, 6, 1), dt.date(2024, 1, 1), ["2022-06-01", "2023-06-01"]),
        ("quarter", dt.date(2024, 1, 31), dt.date(2024, 7, 1), ["2024-01-31", "2024-04-30"]),
        ("hour", dt.datetime(2024, 3, 31, 1), dt.datetime(2024, 3, 31, 4),
         ["2024-03-31 01:00:00", "2024-03-31 02:00:00", "2024-03-31 03:00:00"]),
    ],
)
def test_date_spine_units(spark, part, start, end, expected):
    spine = row_ops.date_spine(spark, part, start, end).select(F.col(f"date_{part}").cast("string").alias("d"))
    assert [r.d for r in spine.orderBy("d").collect()] == expected


def test_date_spine_needs_a_positive_span(spark):
    with pytest.raises(ValueError):
        row_ops.date_spine(spark, "day", dt.date(2024, 1, 2), dt.date(2024, 1, 2))


def test_generate_series(spark):
    assert [r[0] for r in row_ops.generate_series(spark, 10).collect()] == list(range(1, 11))
    with pytest.raises(ValueError):
        row_ops.generate_series(spark, 0)


def test_deduplicate_keeps_first_row_and_null_keys(spark):
    df = spark.createDataFrame([(1, "play", 1), (1, "play", 2), (2, None, 1), (None, "x", 1), (None, "y", 2)], "u int, e string, v int")
    assert rows(row_ops.deduplicate(df, ["u"], [F.desc("v")])) == [(None, "y", 2), (1, "play", 2), (2, None, 1)]


def test_deduplicate_limits_rows_before_the_shuffle(spark, capsys):
    df = spark.range(100).withColumn("k", F.col("id") % 3)
    row_ops.deduplicate(df, ["k"], [F.desc("id")]).explain()
    plan = capsys.readouterr().out
    before_shuffle = plan[plan.index("Exchange hashpartitioning(k"):]
    assert "WindowGroupLimit" in before_shuffle


def test_column_values(spark):
    data = [("north", 1), ("south", 1), ("south", 2), ("west", 2), ("west", 2), ("west", 1), (None, 1)]
    df = spark.createDataFrame(data, "region string, year int")
    assert [r.value for r in row_ops.column_values(df, "region", max_records=2).collect()] == ["west", "south"]
    assert row_ops.column_value_list(df, "region", where="year = 1", order_by=[F.asc("value")]) == ["north", "south", "west"]
    assert row_ops.column_value_list(df, "region", default=["none"], where="year = 9") == ["none"]
    assert row_ops.column_value_list(None, "region", default=["d"]) == ["d"]
    with pytest.raises(ValueError):
        row_ops.column_value_list(None, "region")


def test_column_value_list_never_cuts(spark):
    df = spark.range(400).withColumn("k", F.col("id") % 150)
    assert len(row_ops.column_value_list(df, "k")) == 150
    assert len(row_ops.column_value_list(df, "k", most=150)) == 150
    with pytest.raises(ValueError):
        row_ops.column_value_list(df, "k", most=149)


def test_monthly_periods(spark):
    df = spark.createDataFrame(
        [(1, dt.date(2024, 1, 15), dt.date(2024, 3, 10)), (2, dt.date(2024, 2, 2), dt.date(2024, 2, 1))], "k int, a date, b date"
    )
    got = [(r.k, str(r.period_start), str(r.period_end)) for r in row_ops.monthly_periods(df, "a", "b").orderBy("period_start").collect()]
    assert got == [(1, "2024-01-01", "2024-01-31"), (1, "2024-02-01", "2024-02-29"), (1, "2024-03-01", "2024-03-10")]


def test_pivot(spark):
    visits = [("Lyon", "phone"), ("Lyon", "phone"), ("Lyon", "l'atelier"), ("Metz", "office")]
    df = spark.createDataFrame(visits, "town string, place string")
    cells = reshape.pivot_columns("place", ["phone", "office", "l'atelier"], slug_names=True)
    got = df.groupBy("town").agg(*cells)
    assert got.columns == ["town", "phone", "office", "latelier"]
    assert rows(got) == [("Lyon", 2, 0, 1), ("Metz", 0, 1, 0)]
    named = df.groupBy("town").agg(*reshape.pivot_columns("place", ["l'atelier"], prefix="n ", suffix="!"))
    assert named.columns == ["town", "n l'atelier!"]


def test_star_names_are_case_insensitive_and_unaliased_without_affix(spark):
    df = spark.createDataFrame([("a", "b", 1), ("a", "b", 2), ("c", "d", 3)], "g1 string, g2 string, v int")
    kept = reshape.star(df, without=["V"])
    assert rows(df.groupBy(*kept).agg(F.sum("v").alias("s"))) == [("a", "b", 3), ("c", "d", 3)]
    assert df.select(*reshape.star(df, prefix="p_", suffix="_s")).columns == ["p_g1_s", "p_g2_s", "p_v_s"]
    assert reshape.star(df, without=["g1", "g2", "v"]) == []


def test_null_empty_strings(spark):
    df = spark.createDataFrame([("lot", "", 7), ("", "site", 8), (" ", None, 9)], "x string, y string, z int")
    assert rows(reshape.null_empty_strings(df)) == [(None, "site", 8), (" ", None, 9), ("lot", None, 7)]


def test_union_relations(spark):
    one = spark.createDataFrame([(11, "Quai", "B3"), (12, "Gare", "A1")], "id int, site string, lot string")
    two = spark.createDataFrame([(11, 0.5, 4)], "id int, load double, lot int")
    got = reshape.union_relations({"one": one, "two": two})
    assert got.columns == ["_dbt_source_relation", "id", "site", "lot", "load"]
    assert rows(got) == [("one", 11, "Quai", "B3", None), ("one", 12, "Gare", "A1", None), ("two", 11, None, "4", 0.5)]
    bare = reshape.union_relations({"one": one, "two": two}, exclude=["SITE"], source_column_name=None, where="id = 11")
    assert bare.columns == ["id", "lot", "load"]
    assert rows(bare) == [(11, "4", 0.5), (11, "B3", None)]
    retyped = reshape.union_relations({"one": one, "two": two}, include=["ID"], column_override={"id": "string"})
    assert retyped.dtypes[1] == ("id", "string")
    with pytest.raises(ValueError):
        reshape.union_relations({"one": one}, include=["id"], exclude=["name"])
    with pytest.raises(ValueError):
        reshape.union_relations({"one": one}, include=["nope"])


def test_union_matching_and_prefixed(spark):
    for week in (7, 8, 9):
        spark.createDataFrame([(week, "slot")], "week int, kind string").createOrReplaceTempView(f"plan_w{week}")
    found = reshape.union_matching(spark, "PLAN\\_%", exclude="%9", source_column_name=None)
    assert rows(found) == [(7, "slot"), (8, "slot")]
    assert reshape.union_prefixed(spark, "plan_w", source_column_name=None).count() == 3


def test_union_matching_in_a_database_skips_views(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS union_test")
    try:
        spark.createDataFrame([(1,)], "k int").write.mode("overwrite").saveAsTable("union_test.part_a")
        spark.createDataFrame([(2,)], "k int").createOrReplaceTempView("part_b")
        found = reshape.union_matching(spark, "part%", database="union_test")
        assert rows(found) == [("part_a", 1)]
    finally:
        spark.sql("DROP DATABASE union_test CASCADE")
        spark.catalog.dropTempView("part_b")


@pytest.mark.parametrize(
    ("pattern", "name", "fits"),
    [("a_c", "abc", True), ("a\\_c", "abc", False), ("a\\_c", "A_C", True), ("a%", "abc", True), ("a.c", "abc", False), ("", "", True)],
)
def test_like_pattern(pattern, name, fits):
    assert bool(reshape.like_pattern(pattern).fullmatch(name)) is fits


def test_unpivot_keeps_nulls_and_writes_booleans_as_text(spark):
    df = spark.createDataFrame([(1, "active", True), (2, "churned", None)], "id int, sTaTuS string, flag boolean")
    got = reshape.unpivot(df, exclude=["ID"], field_name="Prop", value_name="Val")
    assert got.columns == ["id", "Prop", "Val"]
    assert rows(got) == [(1, "flag", "true"), (1, "sTaTuS", "active"), (2, "flag", None), (2, "sTaTuS", "churned")]


def test_pivot_undoes_unpivot(spark):
    df = spark.createDataFrame([(1, 5, 7), (2, 0, 9)], "id int, a int, b int")
    long = reshape.unpivot(df, cast_to="int", exclude=["id"])
    back = long.groupBy("id").agg(*reshape.pivot_columns("field_name", ["a", "b"], agg="max", then_value=F.col("value"), else_value=None))
    assert rows(back) == rows(df)


def test_hot_joins_equal_plain_ones(spark):
    left = spark.createDataFrame([(k, i) for i, k in enumerate([1, 1, 1, 2, 3, None, None])], "k int, l int")
    right = spark.createDataFrame([(k, i) for i, k in enumerate([1, 1, 4, None, 4, 2])], "k int, r int")
    assert rows(joins.left_join_hot_right(left, right, "k").select("k", "l", "r")) == rows(left.join(right, "k", "left"))
    plain = left.join(right.withColumnRenamed("k", "k2"), F.col("k") == F.col("k2"), "full").select("k", "l", "r")
    assert rows(joins.full_join_hot_left(left, right, "k").select("k", "l", "r")) == rows(plain)


@pytest.fixture(params=["one range", "all ranges", "merged ranges"])
def range_setting(spark, request):
    """Adaptive execution merges small ranges: into one, not at all, or into a few."""
    settings = {
        "one range": {},
        "all ranges": {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "16"},
        "merged ranges": {
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "5KB",
            "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "100b",
            "spark.sql.shuffle.partitions": "16",
        },
    }[request.param]
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield request.param
    for k, v in before.items():
        spark.conf.set(k, v)


def test_neighbours_equal_a_global_window(spark, range_setting):
    data = [(g, v) for g in ("a", "b", None) for v in (1, 2, 2, 2, 5, 9, None)] + [("hot", i % 700) for i in range(3000)]
    df = spark.createDataFrame(data, "g string, v int")
    got = {
        (r.g, r.v): (r.copies, r.previous and r.previous.v, r.following and r.following.v)
        for r in ordered.distinct_with_neighbours(df, ["g"], ["v"]).collect()
    }
    assert got[("a", 2)] == (3, 1, 5)
    assert got[("a", None)] == (1, None, 1)
    assert got[(None, 9)] == (1, 5, None)
    assert all(got[("hot", i)][1:] == (i - 1 if i else None, i + 1 if i < 699 else None) for i in range(700))
    ranges = df.distinct().repartitionByRange("g", "v").select(F.spark_partition_id()).distinct().count()
    assert {"one range": ranges == 1, "all ranges": ranges > 10, "merged ranges": 1 < ranges < 16}[range_setting], ranges


@pytest.mark.parametrize("rows_per_range", [1, 7, 300])
def test_neighbours_over_many_ranges(spark, monkeypatch, rows_per_range):
    """Cuts at every key of the sample or at some; ranges are even."""
    monkeypatch.setattr(ordered, "RANGE_ROWS", rows_per_range)
    monkeypatch.setattr(ordered, "SAMPLE", 256)
    df = spark.createDataFrame([(i * 3, i % 4) for i in range(1000)], "v int, x int")
    got = {r.v: (r.previous and r.previous.v, r.following and r.following.v) for r in ordered.distinct_with_neighbours(df, [], ["v"]).collect()}
    assert got == {v: (v - 3 if v else None, v + 3 if v < 2997 else None) for v in range(0, 3000, 3)}
    sizes = [r["count"] for r in ordered._ranged(df.select("v").distinct(), ["v"]).groupBy("_range").count().collect()]
    assert sum(sizes) == 1000 and {1: 200 < len(sizes) <= 257, 7: 100 < len(sizes) <= 257, 300: 3 <= len(sizes) <= 5}[rows_per_range]
    assert ordered.distinct_with_neighbours(df.limit(0), [], ["v"]).collect() == []


def test_repeat_rows_in_blocks(spark):
    df = spark.createDataFrame([("a", 7), ("b", 2), ("c", 0), ("d", 1)], "k string, n bigint")
    got = ordered.repeat_rows(df, "n", block=3).groupBy("k").count()
    assert rows(got) == [("a", 7), ("b", 2), ("d", 1)]


def test_reports(spark):
    df = spark.createDataFrame([("http://a.example/x?ref=1",), ("https://a.example/y",)], "url string")
    assert rows(reports.host_traffic(df, "url")) == [("a.example", 2)]
    assert rows(reports.path_traffic(df, "url")) == [("x", 1), ("y", 1)]
    assert rows(reports.parameter_traffic(df, "url", ["ref"])) == [("ref", None, 1), ("ref", "1", 1)]
    numbers = spark.createDataFrame([(1.5,), (2.5,), (99.0,)], "x double")
    assert rows(reports.histogram(numbers, "x", 0.0, 10.0, 5)) == [(1, 1), (2, 1), (6, 1)]


def full_count(df, column, most):
    return [tuple(r) for r in row_ops.column_values(df, column, max_records=most).collect()]


@pytest.mark.parametrize("buckets", [1, 8, 64, 1 << 16])
@pytest.mark.parametrize("shape", ["skewed", "even", "hot", "none"])
def test_most_frequent_equals_the_full_count(spark, shape, buckets):
    number = F.col("id")
    value = {
        "skewed": F.floor(5000 / (number + 1)),
        "even": number % 500,
        "hot": F.when(number % 3 == 0, -1).when(number % 5 != 0, number),  # NULL is the second most frequent
        "none": F.lit(None).cast("bigint"),
    }[shape]
    df = spark.range(4000).select(value.alias("v"))
    for most in (1, 7, 600):
        got = [tuple(r) for r in frequent.most_frequent(df, "v", most, buckets=buckets).collect()]
        assert got == full_count(df, "v", most)


def test_most_frequent_of_few_rows(spark):
    df = spark.createDataFrame([(0.0, "x"), (-0.0, "x"), (1.5, "y"), (float("nan"), "x"), (float("nan"), "x")], "v double, w string")
    assert frequent.most_frequent(df, "v", 5, where="w = 'none'").collect() == []
    assert [r.n for r in frequent.most_frequent(df, "v", 5).collect()] == [2, 2, 1]
    assert [tuple(r) for r in frequent.most_frequent(df, "v", 5, where="w = 'y'").collect()] == [(1.5, 1)]
    with pytest.raises(ValueError, match="one value"):
        frequent.most_frequent(df, "v", 0)
