"""Truth tables for the survey rules, including NULLs and sentinels."""

import pytest
from pyspark.sql import functions as F

from wayfarer.functions import codes
from wayfarer.functions import recode as R
from wayfarer.functions.columns import (clock_hhm, greatest_strict, least_strict, star_except,
                                        to_long_rounded, try_to_long_rounded)


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


def test_clock_hhm(spark):
    df = spark.createDataFrame([(7, 5), (None, 5), (995, 995), (-1, -1), (23, 59)], "h int, m int")
    out = df.select(clock_hhm("h", "m").alias("x"))
    assert [r.x for r in out.collect()] == [705, None, 995995, None, 2359]


def test_strict_greatest_least(spark):
    df = spark.createDataFrame([(1, None, 3), (1, 0, 0), (None, None, None)], "a bigint, b bigint, c bigint")
    out = df.select(greatest_strict("a", "b", "c").alias("g"), least_strict("a", F.lit(6)).alias("l"))
    assert rows(out, "g", "l") == [(None, 1), (1, 1), (None, None)]


def test_round_then_cast(spark):
    df = spark.createDataFrame([(2.5,), (2.7,), (-2.7,), (-2.5,), (None,)], "x double")
    assert [r.r for r in df.select(to_long_rounded("x").alias("r")).collect()] == [3, 3, -3, -3, None]
    big = spark.createDataFrame([(1e30,)], "x double")
    assert big.select(try_to_long_rounded("x").alias("r")).first().r is None


def test_safe_cast_of_traveller_strings(spark):
    from wayfarer.functions.columns import try_to_long_rounded
    df = spark.createDataFrame([("2",), ("2.5",), ("x",), ("",), (None,)], "n string")
    assert [r.n for r in df.select(try_to_long_rounded("n").alias("n")).collect()] == [2, 3, None, None, None]
    df = spark.createDataFrame([(2.5,), (-2.5,), (float("nan"),), (1e30,), (0.49999999999999994,)], "n double")
    assert [r.n for r in df.select(try_to_long_rounded("n").alias("n")).collect()] == [3, -3, None, None, 0]
    df = spark.createDataFrame([(2**63 - 1,), (-(2**63),)], "n bigint")
    assert [r.n for r in df.select(try_to_long_rounded("n").alias("n")).collect()] == [2**63 - 1, -(2**63)]


def test_segment_and_weights(spark):
    df = spark.createDataFrame([("College", 1.0), ("Supplemental", 2.0), (None, 3.0), ("Core", 4.0)],
                               "segment_type string, w double")
    col_w, main_w = R.weight_split("segment_type", "w")
    out = df.select(R.segment_cleaned().alias("s"), col_w.alias("c"), main_w.alias("m"))
    assert rows(out, "s", "c", "m") == [("College", 1.0, None), ("CBS", None, 2.0), (None, None, 3.0),
                                        ("Core", None, 4.0)]
    # a weight is never in both columns
    assert out.where(F.col("c").isNotNull() & F.col("m").isNotNull()).count() == 0


def test_person_age_rules(spark):
    df = spark.createDataFrame(
        [("Core", 2, 1), ("Core", 5, 2), ("Core", 10, None), ("Core", 13, 1), ("College", 5, 1), (None, 5, 1),
         ("Core", None, 1)], "segment_type string, age bigint, num_jobs bigint")
    adult, senior, child = R.jobs_by_age()
    out = df.select(R.lifegroup_person().alias("lg"), R.age_3cat().alias("a3"), adult.alias("aj"),
                    senior.alias("sj"), child.alias("cj"))
    assert rows(out, "lg", "a3", "aj", "sj", "cj") == [
        ("child", 1, 0, 0, 1), ("adult", 2, 2, 0, 0), ("senior", 3, 0, None, 0), (None, 3, 0, 1, 0),
        (None, None, 1, 0, 0), (None, None, 1, 0, 0), (None, None, 0, 0, 0)]


def test_residence_months(spark):
    def row(m0, months):
        return (m0, *months)
    data = [row(0, [None] * 12), row(0, [1] * 12), row(1, [1] * 11 + [995]), row(0, [0, 1] * 6),
            row(995, [1] * 12), row(None, [0] * 12)]
    schema = "m0 bigint, " + ", ".join(f"m{i} bigint" for i in range(1, 13))
    df = spark.createDataFrame(data, schema).select(
        F.col("m0").alias("residence_months_0"), *[F.col(f"m{i}").alias(f"residence_months_{i}") for i in range(1, 13)])
    out = df.select(R.residence_months_0_cleaned().alias("c"), R.num_months().alias("n"))
    assert rows(out, "c", "n") == [(1, 0), (1, 12), (995, 11), (0, 12), (995, 995), (None, 12)]


def test_household_summary_cases(spark):
    from wayfarer.plans.tables import household_person_summary
    persons = spark.createDataFrame(
        [(1, None), (1, None),            # only NULL ages -> lifecycle 3, counts NULL
         (2, 12), (2, 13),                # only ages > 11 -> lifecycle 3, counts 0
         (3, 5), (3, 10),                 # adult + senior -> lifecycle 3
         (4, 5), (4, 2),                  # adult + child -> 2
         (5, 6)],                         # adult only -> 1
        "hh_id bigint, age bigint")
    got = {r.hh_id: (r.lifecycle, r.hh_children, r.hh_adults, r.hh_seniors)
           for r in household_person_summary(persons).collect()}
    assert got == {1: (3, None, None, None), 2: (3, 0, 0, 0), 3: (3, 0, 1, 1), 4: (2, 1, 1, 0), 5: (1, 0, 1, 0)}


def test_purpose_variants_differ(spark):
    df = spark.createDataFrame([(3,), (2,), (995,), (None,)], "c bigint")
    out = df.select(R.purpose_3cat_linked("c").alias("l"), R.purpose_3cat_unlinked("c").alias("u"))
    assert rows(out, "l", "u") == [("Work", "Other"), ("Work", "Work"), ("Undefined", "Undefined"),
                                   ("Other", "Other")]


def test_school_level_null_handling(spark):
    df = spark.createDataFrame([(2, "HBSch", None), (2, "HBSch", 5), (2, "HBSch", 9), (1, "HBW", 6)],
                               "PURP7 int, Model_Purpose string, school_type bigint")
    out = df.select(R.school_level_unlinked().alias("u"), R.school_level_linked().alias("l"))
    assert rows(out, "u", "l") == [("undefined", None), ("primary", "primary"), ("undefined", "undefined"),
                                   (None, None)]


def test_occupancy_guard_and_model_mode(spark):
    df = spark.createDataFrame(
        [("Drive-Alone", 10, 2), ("Drive-Alone", 10, None), ("Shared-Ride 3+", 8, 2), ("TNC", 14, 2),
         ("Taxi", 13, None), ("Other", 17, 3), ("Missing Response", -1, None), (None, 99, 1)],
        "mode_t string, mode bigint, n bigint")
    out = df.select(R.occupancy_mismatch("mode_t", "n").alias("bad"), R.model_mode("mode", "n").alias("mm"))
    assert rows(out, "bad", "mm") == [
        (True, "auto-sov"), (None, "auto-sov"), (True, "auto-occ3p"), (False, "auto-occ3p"),
        (False, "auto-occ2"), (False, "auto-occ3p"), (False, "auto-sov"), (None, None)]


def test_purpose_period_and_peak(spark):
    df = spark.createDataFrame([(1, 7), (3, 10), (10, 6), (995, 16), (4, None)], "PURP7 int, depart_hour int")
    out = df.select(R.purpose_period().alias("pp"), R.period("depart_hour").alias("per"))
    assert rows(out, "pp", "per") == [(1, "AM"), (10, "MD"), (10, "AM"), (995, "PM"), (25, "EV")]
    assert [r.k for r in spark.createDataFrame([("AM",), ("EV",), ("XX",)], "depart_per string")
            .select(R.peak_offpeak().alias("k")).collect()] == ["PK", "OK", None]


def test_star_except_requires_columns(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert [c for c in df.select(*star_except(df, ["a"])).columns] == ["b"]
    with pytest.raises(ValueError):
        star_except(df, ["a", "missing"])


def test_fixed_linked_column_list():
    assert len(codes.TRIP_LINKED_COLS) == 114
    assert len(set(codes.TRIP_LINKED_COLS)) == 114
    assert len(codes.GUARDED_TRIP_ATTRS) == 24
