import datetime as dt

from pyspark.sql import functions as F

from cohortforge.functions import (contains_ci, contains_cs_any, flag, hash_bin, hash_bucket, normalize_category,
                                   normalize_ethnicity, normalize_ethnicity_v1, strip_brackets, tolerant_double,
                                   tolerant_timestamp, whole_days, within_hours)


def one(spark, col, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(col).collect()]


def test_flag_two_valued(spark):
    got = one(spark, flag(F.col("v") < 136), [(130.0,), (136.0,), (None,), (float("nan"),)], "v double")
    # null compares False; NaN is not below 136 either
    assert got == [1, 0, 0, 0]


def test_negated_flag_of_missing_is_true(spark):
    male = flag(F.col("g") == 1) == 1
    got = one(spark, (~male).cast("int"), [(1,), (0,), (None,)], "g int")
    assert got == [0, 1, 1]


def test_contains_case_insensitive_null_false(spark):
    got = one(spark, contains_ci(F.col("t"), "Sodium"), [("SODIUM, whole",), ("potassium",), (None,)], "t string")
    assert got == [True, False, False]


def test_contains_case_sensitive_or(spark):
    got = one(spark, contains_cs_any(F.col("t"), ["pH", "PH"]), [("Arterial pH",), ("ph",), ("PHOS",), (None,)],
              "t string")
    assert got == [True, False, True, False]


def test_normalize_category_order(spark):
    got = one(spark, normalize_category(F.col("c")),
              [("ECONOMY - Lab's Results/Panel (economy)",), ("Resp  Care",), (None,)], "c string")
    assert got == ["economylab_results_panel_economy", "respcare", None]


def test_normalize_ethnicity(spark):
    rows = [("HISPANIC/LATINO - PUERTO RICAN",), ("ASIAN - CHINESE",), ("UNKNOWN/NOT SPECIFIED",)]
    assert one(spark, normalize_ethnicity(F.col("e")), rows, "e string") == [
        "hispanic_latino_puerto_rican", "asian_chinese", "unknown_not_specified"]
    assert one(spark, normalize_ethnicity_v1(F.col("e")), rows[:1], "e string") == ["hispanic_latino_-_puerto_rican"]


def test_strip_brackets(spark):
    assert one(spark, strip_brackets(F.col("l")), [("[Urine] Color",)], "l string") == ["Urine Color"]


def test_tolerant_parsers(spark):
    assert one(spark, tolerant_double(F.col("v")), [("1.5",), ("n/a",), ("NaN",), (None,)], "v string") == [
        1.5, None, None, None]
    got = one(spark, tolerant_timestamp(F.col("t")), [("2020-01-02 03:04:05",), ("not a time",)], "t string")
    assert got == [dt.datetime(2020, 1, 2, 3, 4, 5), None]


def test_within_hours_no_lower_bound_and_null(spark):
    rows = [(dt.datetime(2020, 1, 1, 5), dt.datetime(2020, 1, 1)),    # 5 h after
            (dt.datetime(2020, 1, 1, 6), dt.datetime(2020, 1, 1)),    # exactly 6 h: not < 6
            (dt.datetime(2019, 12, 1), dt.datetime(2020, 1, 1)),      # before the anchor counts
            (None, dt.datetime(2020, 1, 1))]
    got = one(spark, within_hours(F.col("e"), F.col("a"), 6).cast("int"), rows, "e timestamp_ntz, a timestamp_ntz")
    assert got == [1, 0, 1, 0]


def test_whole_days_is_floor(spark):
    rows = [(dt.datetime(2020, 1, 2, 1), dt.datetime(2020, 1, 1, 2)),   # 23 h -> 0
            (dt.datetime(2020, 1, 1, 1), dt.datetime(2020, 1, 1, 2)),   # -1 h -> -1
            (dt.datetime(2020, 1, 3), dt.datetime(2020, 1, 1))]         # 2 days
    got = one(spark, whole_days(F.col("e"), F.col("s")), rows, "e timestamp_ntz, s timestamp_ntz")
    assert got == [0, -1, 2]


def test_hash_bin_and_bucket_match_md5(spark):
    import hashlib
    keys = [0, 7, 123456789]
    got = one(spark, hash_bin(F.col("k")), [(k,) for k in keys], "k bigint")
    assert got == [hashlib.md5(str(k).encode()).hexdigest()[:2] for k in keys]
    got = one(spark, hash_bucket(F.col("k"), 10, "42"), [(k,) for k in keys], "k bigint")
    assert got == [int(hashlib.md5(f"42{k}".encode()).hexdigest()[:8], 16) % 10 for k in keys]
