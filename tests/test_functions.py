from pyspark.sql import functions as F

from affinity.functions.encode import encode_customers
from affinity.functions.lists import format_id_list, parse_id_list
from affinity.functions.pairs import match_flag, standardised_difference, unit_if_zero


def test_status_encodings(spark):
    rows = [(1, None, None, "ACTIVE", "NONE", 30.0, "x"), (2, 1.0, 0.0, "OTHER", "None", None, "y"),
            (3, 0.0, 1.0, None, "weekly", 20.0, None), (4, None, None, "LEFT CLUB", None, None, None),
            (5, None, None, "PRE-CREATE", "Monthly", None, None), (6, None, None, None, "Regularly", None, None)]
    df = spark.createDataFrame(rows, "customer_id long, FN double, active_status double, member_status string, "
                                     "news_frequency string, age double, postal_code string")
    got = {r.customer_id: r for r in encode_customers(df).collect()}
    assert (got[1].FN, got[1].active_status) == (-1.0, -1.0)
    assert (got[2].FN, got[2].active_status) == (1.0, 0.0)
    assert [got[i].member_status for i in range(1, 7)] == [1.0, 0.0, 0.0, -1.0, 1.0, 0.0]
    assert [got[i].news_frequency for i in range(1, 7)] == [-1.0, 0.0, 0.0, 0.0, 0.5, 1.0]
    assert got[2].age is None


def test_list_text_round_trip(spark):
    df = spark.createDataFrame([("[1 2 3]",), ("[]",), ("[5 5]",), ("[108, 2051, 7]",), ("[10  2]",)], "t string")
    out = df.select(parse_id_list(F.col("t")).alias("a")).select("a", format_id_list(F.col("a")).alias("s")).collect()
    assert [r.a for r in out] == [[1, 2, 3], [], [5, 5], [108, 2051, 7], [10, 2]]
    assert [r.s for r in out] == ["[1 2 3]", "[]", "[5 5]", "[108 2051 7]", "[10 2]"]


def test_match_is_false_for_null_pairs(spark):
    df = spark.createDataFrame([(1, 1), (None, None), (1, None), (2, 3)], "a long, b long")
    assert [r.m for r in df.select(match_flag(F.col("a"), F.col("b")).alias("m")).collect()] == [True, False, False, False]


def test_standardised_difference_and_unit_std(spark):
    df = spark.createDataFrame([(5.0, 3.0, 0.0), (5.0, 3.0, None), (None, 3.0, 2.0), (4.0, 2.0, 2.0)],
                               "x double, m double, s double")
    out = df.select(standardised_difference(F.col("x"), F.col("m"), unit_if_zero(F.col("s"))).alias("d")).collect()
    assert [r.d for r in out] == [2.0, None, None, 1.0]
