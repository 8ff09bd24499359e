import re

from pyspark.sql import functions as F

from tillroll.functions.expr import (
    clamp_non_negative, concat_strict, file_base_name, file_extension, round_half_away,
    time_text, to_long_rounded, ts_from_date_and_time,
)


def test_clamp_keeps_null(spark):
    df = spark.createDataFrame([(-3.0,), (None,), (2.5,), (0.0,)], "x double")
    got = [r[0] for r in df.select(clamp_non_negative("x")).collect()]
    assert got == [0.0, None, 2.5, 0.0]


def test_int_cast_rounds_and_tolerates_junk(spark):
    df = spark.createDataFrame([("3.7",), ("-3.5",), ("abc",), (None,), ("12",)], "x string")
    got = [r[0] for r in df.select(to_long_rounded("x")).collect()]
    assert got == [4, -4, None, None, 12]


def test_int_cast_by_known_type_gives_the_same(spark):
    from pyspark.sql.types import DoubleType, LongType, StringType
    doubles = [3.7, -3.5, 0.49999999999999994, 0.5, -0.5, 2.5, 1e15 + 0.5, 4503599627370497.5, 9e15, -9e18, 1e19, 1e300,
               float("nan"), float("inf"), None, -0.2]
    df = spark.createDataFrame([(x,) for x in doubles], "x double")
    pairs = df.select(to_long_rounded("x").alias("a"), to_long_rounded("x", DoubleType()).alias("b")).collect()
    assert [r.a for r in pairs] == [r.b for r in pairs]
    texts = ["12", " 7 ", "3.7", "-3.5", "9007199254740993", "99999999999999999999", "1e3", "x", "", None, "+5", "0x1"]
    df = spark.createDataFrame([(x,) for x in texts], "x string")
    pairs = df.select(to_long_rounded("x").alias("a"), to_long_rounded("x", StringType()).alias("b")).collect()
    assert [r.a for r in pairs] == [r.b for r in pairs]
    df = spark.createDataFrame([(2**62,), (-5,), (None,)], "x long")
    assert [r[0] for r in df.select(to_long_rounded("x", LongType())).collect()] == [2**62, -5, None]


def test_timestamp_from_text(spark):
    df = spark.createDataFrame([("2023-05-01", "13:04:05"), ("2023-05-01", "99:99:99"),
                                (None, "01:00:00"), ("junk", "01:00:00")], "d string, t string")
    out = df.select(ts_from_date_and_time("d", "t").alias("ts"))
    got = out.select(time_text("ts")).collect()
    assert [r[0] for r in got] == ["13:04:05", None, None, None]


def test_concat_strict_propagates_null(spark):
    df = spark.createDataFrame([("a", None), ("a", "b")], "x string, y string")
    assert [r[0] for r in df.select(concat_strict("x", "y")).collect()] == [None, "ab"]


def test_round_half_away_from_zero(spark):
    df = spark.createDataFrame([(2.675,), (-2.675,), (1.005,), (32044308.795,), (None,)], "x double")
    got = [r[0] for r in df.select(round_half_away("x")).collect()]
    assert got == [2.68, -2.68, 1.01, 32044308.8, None]


def test_file_extension_matches_splitext(spark):
    import os
    names = ["a.JSON", "b.tar.gz", ".env", "noext", "file.", "x.Parquet", "..hidden.csv", ""]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r[0] for r in df.select(file_extension("n")).collect()]
    assert got == [os.path.splitext(n)[1].lower() for n in names]


def test_file_base_name_of_urls(spark):
    df = spark.createDataFrame([("https://h.example.com/en/25#top",),
                                ("http://h.example.com/fr/825?page=2&ref=x",),
                                ("https://h.example.com/en/853/",), ("s3://b/json/x.json",)], "u string")
    got = [r[0] for r in df.select(file_base_name(F.col("u"))).collect()]
    assert got == ["25", "825", "853", "x.json"]


def test_identity_tells_nulls_apart_and_sums_leave_nothing_out(spark):
    from pyspark.sql import functions as F

    from tillroll.functions import expr
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None), ("a|", "", "b")], "x string, y string, z string")
    assert len({r[0] for r in df.select(expr.file_identity("x", "y", "z")).collect()}) == 3
    nums = spark.createDataFrame([("9007199254740993",), ("3.5",), ("x",)], "s string")
    assert [r[0] for r in nums.select(expr.to_long_rounded("s")).collect()] == [9007199254740993, 4, None]
    money = spark.createDataFrame([(1.5,), (1e31,), (None,)], "v double")
    assert money.agg(expr.exact_sum("v")).first()[0] == 1e31
    assert money.where("v < 2").agg(expr.exact_sum("v")).first()[0] == 1.5


def test_short_decimal_text_is_rounded_without_a_decimal(spark):
    import random
    from decimal import ROUND_HALF_UP, Decimal

    from pyspark.sql.types import StringType
    from tillroll.functions import expr
    rng = random.Random(5)
    plain = [f"{rng.choice(['', '-'])}{rng.randrange(10 ** rng.randint(1, 9))}.{tail}" for _ in range(300)
             for tail in ("0", "5", "500000", "499999", "500001", str(rng.randrange(10 ** 6)))]
    plain += ["999999999.999999", "999999999.5", "-0.5", "-0.4", "0.499999", "007.50"]
    odd = ["12.0d", "1e3.0", " 12.0", "12.0\n", "12.", ".5", "+3.7", "NaN", "", None, "0.4999999999999999999", "9223372036854775807.4",
           "9223372036854775808.0", "1" * 40]
    df = spark.createDataFrame([(t,) for t in plain + odd], "t string")
    by_decimal = F.round(F.col("t").try_cast("decimal(38,18)")).try_cast("bigint")
    out = df.select("t", expr.to_long_rounded("t", StringType()).alias("got"),
                    F.coalesce(F.col("t").try_cast("bigint"), by_decimal).alias("want")).collect()
    assert [r.t for r in out if r.got != r.want] == []
    assert all(r.got == int(Decimal(r.t).quantize(Decimal(1), ROUND_HALF_UP)) for r in out[:len(plain)])
    # the decimal is asked for only where the text is not of that form
    assert all(re.search(expr.FEW_DIGITS.replace(r"\z", r"\Z"), t) for t in plain)
    assert "RLIKE" in df.select(expr.to_long_rounded("t", StringType()))._jdf.queryExecution().analyzed().toString()
