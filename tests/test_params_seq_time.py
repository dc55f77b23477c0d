"""Param widening (N2/N3/N7), batch numbering (W1) and time boundaries."""

import datetime as dt

import pytest
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from conftest import p
from webtrail.functions.params import PARAMS_DDL, explode_params, has_params, param, parse_params_json, widen_params
from webtrail.functions.timeops import millisecond_boundaries, minute_boundaries, to_local
from webtrail.operators.sequence import global_sequence
from pyspark.sql import types as T


def _params_df(spark, rows):
    return spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"id int, params {PARAMS_DDL}")


def test_duplicate_key_takes_string_max(spark):
    df = _params_df(spark, [[p("page_title", "9"), p("page_title", "10")]])
    assert df.select(param("params", "page_title")).first()[0] == "9"


def test_string_value_wins_over_int(spark):
    df = _params_df(spark, [[p("k", string="s", int_="7")], [p("k", int_="7", double="1.5")]])
    assert [r[0] for r in df.orderBy("id").select(param("params", "k")).collect()] == ["s", "7"]


def test_trim_before_or_after_max(spark):
    # ' 7' vs '7': max first keeps the space, trim-before compares trimmed values
    df = _params_df(spark, [[p("sid", " 7"), p("sid", "6")]])
    r = df.select(param("params", "sid").alias("a"), param("params", "sid", trim_values=True).alias("b")).first()
    assert r.a == "6" and r.b == "7"


def test_empty_and_null_arrays_drop(spark):
    df = _params_df(spark, [[p("k", "v")], [], None])
    assert df.filter(has_params("params")).count() == 1
    assert explode_params(df, "params").count() == 1


def test_widening_equals_explode_and_pivot(spark):
    rows = [[p("a", "1"), p("b", "2"), p("a", "3")], [p("b", None)], [p("c", "x")], [p("a", int_="5"), p("a", "10")]]
    df = _params_df(spark, rows)
    fast = df.filter(has_params("params")).select("id", param("params", "a").alias("a"), param("params", "b").alias("b"))
    ex = explode_params(df, "params")
    slow = ex.groupBy("id").pivot("param_key", ["a", "b"]).agg(F.max("param_value"))
    assert sorted(fast.collect()) == sorted(slow.select("id", "a", "b").collect())


def test_one_pass_widening_equals_the_expression_per_key(spark):
    rows = [[p("a", "9"), p("a", "10"), p("b", int_="3")], [p("a", None), p("a", " x ")], [p(None, "lost"), p("", "y"), p("b", "z")],
            [p("c", None)], [], None, [p("b", "1"), p("b", None), p("b", "1"), p("a", double="1.5")]]
    df = _params_df(spark, rows)
    keys = ["a", "b", "c"]
    got = widen_params(df, "params", keys).select("id", *[f"__p_{k}" for k in keys]).collect()
    want = df.select("id", *[param("params", k) for k in keys]).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_parse_params_json_keeps_integer_digits(spark):
    df = spark.createDataFrame([('[{"key":"n","value":{"int_value":1700000000}}]',)], "t string")
    got = df.select(F.explode(parse_params_json("t")).alias("x")).select(F.col("x.value.int_value")).first()[0]
    assert got == "1700000000"


def test_global_sequence_equals_row_number_with_a_hot_timestamp(spark):
    # a third of the rows share one timestamp: the range bounds split them by the tie-break
    rows = [(i, 5 if i % 3 == 0 else i) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, ts long").repartition(7)
    got = global_sequence(df, [F.col("ts"), F.col("id")], num_partitions=6)
    ref = df.withColumn("rn", F.row_number().over(Window.orderBy("ts", "id")))
    j = got.join(ref, ["id", "ts"])
    assert j.count() == 3000 and j.filter("s_no != rn").count() == 0


@pytest.mark.parametrize("asked,written", [(4, 19), (19, 4), (6, 1)])
def test_global_sequence_when_the_stage_has_other_partitions_than_asked_for(spark, monkeypatch, asked, written):
    plain = DataFrame.repartitionByRange
    monkeypatch.setattr(DataFrame, "repartitionByRange", lambda df, n, *by: plain(df, written, *by))
    df = spark.range(1000).withColumn("ts", (F.col("id") * 7) % 101)
    got = global_sequence(df, [F.col("ts"), F.col("id")], num_partitions=asked).orderBy("s_no").collect()
    assert [r.s_no for r in got] == list(range(1, 1001))
    assert [(r.ts, r.id) for r in got] == sorted((i * 7 % 101, i) for i in range(1000))


def test_global_sequence_of_no_rows(spark):
    assert global_sequence(spark.range(0), [F.col("id")]).collect() == []


def _ntz(spark, pairs):
    return spark.createDataFrame([(dt.datetime.fromisoformat(a), dt.datetime.fromisoformat(b)) for a, b in pairs],
                                 "a timestamp_ntz, b timestamp_ntz")


def test_minute_boundaries(spark):
    df = _ntz(spark, [("2024-01-01 10:00:59", "2024-01-01 10:31:00"), ("2024-01-01 10:00:00", "2024-01-01 10:30:59")])
    assert [r[0] for r in df.select(minute_boundaries("a", "b")).collect()] == [31, 30]


def test_millisecond_boundaries(spark):
    df = _ntz(spark, [("2024-01-01 10:00:00.000999", "2024-01-01 10:00:00.001000")])
    assert df.select(millisecond_boundaries("a", "b")).first()[0] == 1


def test_local_time_autumn_repeats_an_hour(spark):
    df = spark.createDataFrame([(1730613540000000,), (1730613660000000,)], "t long")  # 05:59 and 06:01 UTC
    got = [r[0] for r in df.select(to_local("t", T.LongType())).collect()]
    assert got == [dt.datetime(2024, 11, 3, 1, 59), dt.datetime(2024, 11, 3, 1, 1)]
