"""Values worked out by hand or by the standard library for functions without
a DuckDB twin, plus property tests for folds and histograms."""

from __future__ import annotations

import hashlib
import zlib
from datetime import datetime, timezone
from zoneinfo import ZoneInfo

import numpy as np
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kiln.operators import aggregates as agg
from kiln.operators import power


def _one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first()["x"]


def test_no_twin_string_functions(spark):
    # soundex by hand: keep the first letter, code the rest, drop vowels and repeats
    assert _one(spark, F.soundex(F.lit("Kilner"))) == "K456"
    assert _one(spark, F.soundex(F.lit("Xu"))) == "X000"
    assert _one(spark, F.initcap(F.lit("tWO wORDS here"))) == "Two Words Here"
    assert _one(spark, F.format_number(F.lit(-98765.4321), 3)) == "-98,765.432"
    path = "north/east/south/west"
    assert _one(spark, F.substring_index(F.lit(path), "/", 3)) == "north/east/south"
    assert _one(spark, F.substring_index(F.lit(path), "/", -1)) == "west"
    assert _one(spark, F.conv(F.lit("7e8"), 16, 10)) == str(int("7e8", 16))
    assert _one(spark, F.conv(F.lit("2024"), 10, 36)) == np.base_repr(2024, 36)
    for text in ("kiln", "", "fire clay"):
        assert _one(spark, F.crc32(F.lit(text).cast("binary"))) == zlib.crc32(text.encode())
        assert _one(spark, F.sha2(F.lit(text), 384)) == hashlib.sha384(text.encode()).hexdigest()
    assert _one(spark, F.levenshtein(F.lit("brick"), F.lit("trickle"))) == 3         # b>t, +l, +e


def test_no_twin_date_functions(spark):
    def day(text):
        return F.lit(text).cast("date")

    # 9 March 2021 was a Tuesday
    assert str(_one(spark, F.next_day(day("2021-03-09"), "Tue"))) == "2021-03-16"
    assert str(_one(spark, F.next_day(day("2021-03-09"), "Fri"))) == "2021-03-12"
    # whole months between equal days; else the day difference over 31
    assert _one(spark, F.months_between(day("2021-05-09"), day("2021-03-09"))) == 2.0
    assert _one(spark, F.months_between(day("2021-05-19"), day("2021-03-09"))) == round(2 + 10 / 31, 8)
    assert _one(spark, F.months_between(day("2021-02-28"), day("2021-01-31"))) == 1.0   # both last days
    assert str(_one(spark, F.add_months(day("2023-10-31"), 4))) == "2024-02-29"
    assert str(_one(spark, F.last_day(day("2100-02-03")))) == "2100-02-28"


def test_zones_with_daylight_saving(spark):
    def shown(expr):
        return _one(spark, F.date_format(expr, "yyyy-MM-dd HH:mm"))

    for zone in ("America/New_York", "Europe/Berlin"):
        for utc in ("2021-01-05 12:00:00", "2021-07-05 12:00:00"):
            local = datetime.fromisoformat(utc).replace(tzinfo=timezone.utc).astimezone(ZoneInfo(zone))
            assert shown(F.from_utc_timestamp(F.lit(utc).cast("timestamp"), zone)) == f"{local:%Y-%m-%d %H:%M}"


def test_rounding_modes(spark):
    assert _one(spark, F.round(F.lit(2.5), 0)) == 3.0          # HALF_UP
    assert _one(spark, F.rint(F.lit(2.5))) == 2.0               # half-even
    assert _one(spark, F.factorial(F.lit(20))) == 2432902008176640000


def test_sentinel_and_parsing(spark):
    lines = spark.createDataFrame([("16/12/2006;17:24:00;4.216;0.418;234.840;18.400;0.000;1.000;17.000",),
                                   ("16/12/2006;bad;x;0.4;;18;0;1;17",), ("a;b",)], "value string")
    p = power.parse_records(lines).toPandas()
    assert p.loc[0, "time"] == 17 * 60 + 24 and p.loc[0, "target"] == 4.216 and not p.loc[0, "is_bad"]
    assert p.loc[1, "time"] == 0 and p.loc[1, "target"] == 0.0 and p.loc[1, "voltage"] == 0.0
    assert p.loc[2, "is_bad"] and p.loc[2, "time"] == -1.0
    assert power.good_rows(power.parse_records(lines)).count() == 2


def test_numbers_parse_like_python(spark):
    vals = ["1_0", " 1.5 ", "nan", "-Infinity", "+1e3", "1__0", "0x10", "1,5", ""]
    line = ";".join(["d", "1_2:3_0"] + vals[:7])
    p = power.parse_records(spark.createDataFrame([(line,)], "value string"),
                            inputs=["time", "global_reactive_power", "voltage", "global_intensity",
                                    "sub_metering_1", "sub_metering_2", "sub_metering_3"]).first()
    assert p["time"] == 12 * 60 + 30
    assert p["target"] == 10.0 and p["global_reactive_power"] == 1.5
    assert p["global_intensity"] == float("-inf") and p["sub_metering_1"] == 1000.0
    assert p["sub_metering_2"] == 0.0 and p["sub_metering_3"] == 0.0        # "1__0", "0x10" fail in Python


def test_numbers_that_only_spark_reads_are_zero(spark):
    for text in ("1.5d", "2f", "0x1p3", "1e", "_1", "1_", "--1", "1 2", "infinit"):
        line = f"1/1/2007;1:2;{text};1;1;1;1;1;1"
        assert power.parse_records(spark.createDataFrame([(line,)], "value string")).first()["target"] == 0.0, text
    for text, value in (("1.", 1.0), (".5", 0.5), ("+2E-1", 0.2), ("INF", float("inf")), ("1_000.5", 1000.5)):
        line = f"1/1/2007;1:2;{text};1;1;1;1;1;1"
        assert power.parse_records(spark.createDataFrame([(line,)], "value string")).first()["target"] == value == float(text)
    p = power.parse_records(spark.createDataFrame([("1/1/2007;1.5:2;1;1;1;1;1;1;1",)], "value string")).first()
    assert p["time"] == 0


def test_header_is_the_first_line_of_the_first_file(spark, tmp_path):
    (tmp_path / "a.txt").write_text("H\nr1\nH\n")
    (tmp_path / "b.txt").write_text("".join(f"row {i}\n" for i in range(4000)) + "H\n")     # the larger split is read first
    lines = power.drop_header(spark.read.text(str(tmp_path)))
    assert lines.count() == 4001 and lines.where("value = 'H'").count() == 0
    assert power.drop_header(spark.read.text(str(tmp_path)), header="row 0").count() == 4003


def test_records_are_ordered_in_time(spark):
    lines = [("1/2/2007;0:0:5",), ("1/1/2008;0:0:0",), ("2/1/2007;23:59:59",), ("1/2/2007;0:0",), ("x",)]
    day, second = power.record_time()
    rows = spark.createDataFrame(lines, "value string").select("value", day.alias("d"), second.alias("s")).orderBy("d", "s").collect()
    assert [r.value for r in rows] == ["x", "2/1/2007;23:59:59", "1/2/2007;0:0", "1/2/2007;0:0:5", "1/1/2008;0:0:0"]


def test_drop_header_removes_every_copy(spark):
    lines = spark.createDataFrame([(i, "H" if i % 3 == 0 else f"r{i}") for i in range(10)], "i int, value string")
    assert power.drop_header(lines, order_by="i").count() == 6


@settings(max_examples=15, deadline=None)
@given(n=st.integers(min_value=5, max_value=60), k=st.integers(min_value=2, max_value=5))
def test_fold_sizes_property(spark, n, k):
    df = spark.createDataFrame([(1, i) for i in range(n)], "bucket int, key int")
    f = power.assign_folds(df, k, ["key"]).groupBy("fold").count().toPandas().sort_values("fold")
    each = n // k
    assert f["count"].tolist() == [each] * (k - 1) + [n - each * (k - 1)]


def test_fold_count_too_small_raises(spark):
    df = spark.createDataFrame([(1, i) for i in range(3)], "bucket int, key int")
    try:
        power.assign_folds(df, 5, ["key"]).collect()
        raise AssertionError("expected an error")
    except Exception as e:                                    # noqa: BLE001
        assert "a group has fewer rows than folds" in str(e)


@settings(max_examples=15, deadline=None)
@given(xs=st.lists(st.floats(min_value=-100, max_value=100, allow_nan=False), min_size=1, max_size=40),
       nb=st.integers(min_value=1, max_value=6))
def test_histogram_property(spark, xs, nb):
    df = spark.createDataFrame(pd.DataFrame({"x": xs}))
    h = agg.histogram(df, "x", nb).orderBy("bucket").toPandas()
    assert int(h.n.sum()) == len(xs)
    lo, hi = min(xs), max(xs)
    if lo == hi:
        assert len(h) == 1
        return
    edges = [lo + i * (hi - lo) / nb for i in range(nb)] + [hi]
    want = [sum(1 for x in xs if edges[i] <= x < edges[i + 1] or (i == nb - 1 and x == hi)) for i in range(nb)]
    assert h.n.tolist() == want


def test_histogram_explicit_boundaries_skip_outside(spark):
    df = spark.createDataFrame(pd.DataFrame({"x": [0.0, 1.0, 5.0, 10.0, 11.0, float("nan")]}))
    h = agg.histogram(df, "x", [0, 5, 10]).orderBy("bucket").toPandas()
    assert h.n.tolist() == [2, 2]


def test_describe_uses_population_std(spark):
    df = spark.createDataFrame([(2.0,), (5.0,)], "v double")
    d = {r["summary"]: float(r["v"]) for r in agg.describe_population(df, ["v"]).collect()}
    assert d["stddev"] == 1.5 and d["count"] == 2.0 and d["mean"] == 3.5


def test_keyed_reduce_with_monoid(spark):
    df = spark.createDataFrame([(k % 3, float(k)) for k in range(1, 30)], "k int, v double").repartition(4)
    got = {r["k"]: r["v"] for r in agg.keyed_reduce(df, "k", "v", np.multiply).collect()}
    want = {k: float(np.prod([float(i) for i in range(1, 30) if i % 3 == k])) for k in range(3)}
    assert got == want


def test_clt_estimate_covers_truth(spark):
    df = spark.range(20000).select((F.col("id") % 100).cast("double").alias("v"))
    est = {r["stat"]: r for r in agg.clt_estimate(df, "v", 0.2, seed=3).collect()}
    assert est["count"]["low"] <= 20000 <= est["count"]["high"]
    assert est["mean"]["low"] <= 49.5 <= est["mean"]["high"]


def test_keyed_reduce_merges_many_keys_in_a_call(spark, monkeypatch):
    """NULL is a key beside others over many batches, and a task's last
    merges are of groups of keys: a call for each key took most of the time."""
    monkeypatch.setattr(agg, "HELD_KEYS", 500)
    monkeypatch.setattr(agg, "KEY_GROUPS", 4)
    calls = spark.sparkContext.accumulator(0)

    class Counted:
        def reduceat(self, values, firsts):
            calls.add(1)
            return np.add.reduceat(values, firsts)

    rows = spark.range(6000, numPartitions=4).selectExpr("CASE WHEN id % 301 > 0 THEN id % 301 END AS k", "double(id) AS v")
    got = {r["k"]: r["v"] for r in agg.keyed_reduce(rows, "k", "v", Counted()).collect()}
    want = {}
    for i in range(6000):
        k = i % 301 or None
        want[k] = want.get(k, 0.0) + i
    assert got == want
    assert calls.value < 100
