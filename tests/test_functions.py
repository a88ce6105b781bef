from __future__ import annotations

import datetime as dt
import hashlib
import math

import pytest
from pyspark.sql import functions as F

from caseworks.functions import text, times, values


def column(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_safe_add_and_subtract_count_null_as_zero(spark):
    data, schema = [(20, 7, 40), (None, 7, None), (20, None, -40), (None, None, None)], "a int, b int, c int"
    assert column(spark, data, schema, values.safe_add(["a", "b", "c"])) == [67, 7, -20, 0]
    assert column(spark, data, schema, values.safe_subtract(["a", "b", "c"])) == [-27, -7, 60, 0]


@pytest.mark.parametrize("function", [values.safe_add, values.safe_subtract])
def test_safe_arithmetic_wants_a_list(spark, function):
    with pytest.raises(TypeError):
        function("a")


def test_safe_divide(spark):
    data = [(21, 4), (-3, 0), (0, 0), (0, 8), (None, 3), (3, None), (None, None)]
    got = column(spark, data, "n int, d int", values.safe_divide("n", "d"))
    assert got == [5.25, None, None, 0.0, None, None, None]


def test_surrogate_key_hashes_null_as_token_or_empty(spark):
    data, schema = [("a", "b", "c"), ("a", None, "c"), (None, None, None)], "x string, y string, z string"

    def md5(*parts):
        return hashlib.md5("-".join(parts).encode()).hexdigest()

    token = values.NULL_KEY_TOKEN
    assert column(spark, data, schema, values.surrogate_key(["x", "y", "z"])) == [
        md5("a", "b", "c"), md5("a", token, "c"), md5(token, token, token),
    ]
    assert column(spark, data, schema, values.surrogate_key(["x"])) == [md5("a"), md5("a"), md5(token)]
    assert column(spark, data, schema, values.surrogate_key(["x", "y"], null_as_empty=True))[1] == md5("a", "")


def test_surrogate_key_known_hashes(spark):
    # Published answers of the key function.
    got = column(spark, [("a", "b", "c"), ("a", None, "c")], "x string, y string, z string", values.surrogate_key(["x", "y", "z"]))
    assert got == ["7b193b3d33184464106f41ddf733783b", "4f32a73dc87b7bbb7a654d8898d58c7e"]


def test_width_bucket(spark):
    hours = [-1.5, 0.5, 6.9, 7.0, 7.1, 13.9, 34.9, 36.5]
    got = column(spark, [(h,) for h in hours], "x double", values.width_bucket("x", 0.0, 35.0, 5))
    assert got == [0, 1, 1, 2, 2, 2, 5, 6]


def test_width_bucket_quirk_on_multiples_outside_the_range(spark):
    got = column(spark, [(42.0,), (-7.0,)], "x double", values.width_bucket("x", 0.0, 35.0, 5))
    assert got == [7, 0]


@pytest.mark.parametrize(("unit", "radius"), [("mi", 3961.0), ("km", 6371.0)])
def test_great_circle_distance(spark, unit, radius):
    """A quarter and a tenth of a meridian, a step along the equator, and no way at all."""
    points = [(0.0, 15.0, 90.0, 15.0), (9.0, -3.0, 27.0, -3.0), (0.0, 10.0, 0.0, 40.0), (45.0, 6.0, 45.0, 6.0)]
    distance = values.great_circle_distance("a", "b", "c", "d", unit)
    got = column(spark, points, "a double, b double, c double, d double", distance)
    want = [math.pi / 2 * radius, math.pi / 10 * radius, math.pi / 6 * radius, 0.0]
    assert got == pytest.approx(want, rel=2e-3)


def test_great_circle_distance_rejects_other_units():
    with pytest.raises(ValueError):
        values.great_circle_distance("a", "b", "c", "d", "nm")


URLS = {
    "https://lots.example/marche/7?page=2": ("lots.example", "marche/7"),
    "http://a.b.lots.example/": ("a.b.lots.example", ""),
    "agenda.example/semaine/": ("agenda.example", "semaine/"),
    "agenda.example?vue=mois": ("agenda.example", ""),
    "https://agenda.example/j#soir": ("agenda.example", "j#soir"),
    "seul.example": ("seul.example", "seul.example"),
}


def test_url_host_and_path(spark):
    data = [(u,) for u in URLS]
    assert column(spark, data, "u string", text.url_host("u")) == [host for host, _ in URLS.values()]
    assert column(spark, data, "u string", text.url_path("u")) == [path for _, path in URLS.values()]


def test_url_parameter_is_a_plain_text_match(spark):
    cases = {
        "https://agenda.example/liste?agence=12&page=3": ("12", "3"),
        "agenda.example?homepage=7": (None, "7"),
        "agenda.example?page=&agence=a=b": ("a=b", None),
        "/page=9": (None, "9"),
        "agenda.example/agence": (None, None),
        "x?agence=1&agence=2#page=4&z": ("1", "4"),
    }
    data = [(u,) for u in cases] + [(None,)]
    assert column(spark, data, "u string", text.url_parameter("u", "agence")) == [a for a, _ in cases.values()] + [None]
    assert column(spark, data, "u string", text.url_parameter("u", "page")) == [p for _, p in cases.values()] + [None]


@pytest.mark.parametrize(
    ("label", "slug"),
    [("", ""), (None, ""), ("Lot n°3 (Est)", "lot_n3_est"), ("16898 - GD Est", "_16898_gd_est"), ("Prix  HT-net", "prix_ht_net")],
)
def test_slugify(spark, label, slug):
    assert text.slugify_name(label) == slug
    assert column(spark, [(label,)], "s string", text.slugify("s")) == [slug]


def test_lot_tokens(spark):
    data = [("ATC GE 12 x",), ("ATC",), ("",), (None,)]
    assert column(spark, data, "lot string", text.token("lot", 0)) == ["ATC", "ATC", "", None]
    assert column(spark, data, "lot string", text.token("lot", 2)) == ["12", None, None, None]
    assert column(spark, data, "lot string", text.after_first_token("lot")) == ["GE 12 x", "ATC", "", None]


def test_strip_takes_all_blanks(spark):
    assert column(spark, [(" \t x y　\n",)], "s string", values.strip("s")) == ["x y"]


def test_times_ignore_the_session_zone(spark):
    """Both nights on which Paris clocks change."""
    moments = [
        (dt.datetime(2024, 3, 31, 1, 30, 59), dt.datetime(2024, 3, 31, 3, 30)),
        (dt.datetime(2024, 3, 31, 2, 30, 0, 999999), dt.datetime(2024, 3, 31, 2, 31)),
        (dt.datetime(2024, 10, 27, 1, 0), dt.datetime(2024, 10, 27, 4, 0)),
    ]
    schema = "a timestamp_ntz, b timestamp_ntz"
    seconds = times.clock_seconds("a"), times.clock_seconds("b")
    assert column(spark, moments, schema, times.whole_minutes(*seconds)) == [119, 1, 180]
    assert column(spark, moments, schema, times.seconds_as_datetime_text(seconds[0])) == [
        "2024-03-31 01:30:59", "2024-03-31 02:30:00", "2024-10-27 01:00:00",
    ]
    assert column(spark, moments, schema, times.as_datetime_text("a"))[1] == "2024-03-31 02:30:00"
    assert column(spark, moments, schema, times.seconds_as_date(seconds[0]))[0] == dt.date(2024, 3, 31)


def test_whole_minutes_cuts_towards_zero(spark):
    data = [(59, 120), (120, 59), (0, 59), (0, None)]
    assert column(spark, data, "a bigint, b bigint", times.whole_minutes("a", "b")) == [1, -1, 0, None]


def test_clock_minutes_and_month_number(spark):
    assert column(spark, [("07:35:59",), (None,)], "c string", times.clock_minutes("c")) == [455, None]
    assert column(spark, [(dt.date(2025, 1, 31),)], "d date", times.month_number("d")) == [202501]
