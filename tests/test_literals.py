"""Fixed survey values written out a second time, independent of ``codes`` and of the oracle."""

from pyspark.sql import functions as F

from wayfarer.functions import codes
from wayfarer.functions import recode as R


def mapped(spark, values, typ, column):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return {r.x: r.y for r in df.select("x", column.alias("y")).collect()}


def test_purpose_labels(spark):
    assert mapped(spark, [*range(-1, 16), 995, None], "bigint", R.purpose_type_label("x")) == {
        -1: None, 0: None, 1: "home", 2: "work", 3: "work-related", 4: "school", 5: "school-related", 6: "escort",
        7: "shop", 8: "meal", 9: "social-rec", 10: "errand", 11: "change-mode", 12: "overnight", 13: "other",
        14: None, 15: None, 995: None, None: None}


def test_linked_mode_labels(spark):
    assert mapped(spark, [*range(-1, 19), None], "bigint", R.linked_mode_label("x")) == {
        -1: "Missing Response", 0: None, 1: "School Bus", 2: "Drive-Transit", 3: None, 4: None, 5: "Walk-Transit",
        6: None, 7: None, 8: "Shared-Ride 3+", 9: "Shared-Ride 2", 10: "Drive-Alone", 11: "Bike", 12: "Scooter",
        13: "Taxi", 14: "TNC", 15: "Walk", 16: "Long Distance", 17: "Other", 18: None, None: None}


def test_linked_purpose_texts(spark):
    assert mapped(spark, ["HBW", "HBSch", "HBShp", "HBO", "NHBW", "NHBNW", "HBC", None], "string", R.purp7_text_linked("x")) == {
        "HBW": "HBW", "HBSch": "HBSch", "HBShp": "HBShp", "HBO": "HBOth", "NHBW": "NHBW", "NHBNW": "NHBNW", "HBC": "HBC", None: None}
    assert mapped(spark, ["NHBNW", "NHBW", "HBW", "HBSch", "HBC", "HBOth", "HBShp", "HBO", None], "string", R.purp5_text("x")) == {
        "NHBNW": "NHB", "NHBW": "NHB", "HBW": "HBW", "HBSch": "HBSch", "HBC": "HBC", "HBOth": "HBO", "HBShp": "HBO",
        "HBO": None, None: None}
    assert mapped(spark, ["AM", "PM", "MD", "EV", None], "string", R.peak_offpeak("x")) == {
        "AM": "PK", "PM": "PK", "MD": "OK", "EV": "OK", None: None}


def test_periods(spark):
    want = {h: "AM" for h in (6, 7, 8)} | {h: "MD" for h in range(9, 15)} | {h: "PM" for h in (15, 16, 17)}
    assert mapped(spark, [*range(-1, 25), 995, None], "int", R.period("x")) == {
        h: want.get(h, "EV") for h in [*range(-1, 25), 995, None]}


def test_fixed_model_modes(spark):
    df = spark.createDataFrame([(m, n) for m in [1, 2, 5, 8, 9, 10, 11, 12, 15] for n in (None, 1, 4)],
                               "linked_trip_mode bigint, num_travelers bigint")
    assert {(r.linked_trip_mode, r.y) for r in df.select("linked_trip_mode", R.model_mode().alias("y")).collect()} == {
        (1, "school_bus"), (2, "drive-to-transit"), (5, "walk-to-transit"), (8, "auto-occ3p"), (9, "auto-occ2"),
        (10, "auto-sov"), (11, "bike"), (12, "walk"), (15, "walk")}


def test_column_lists():
    assert set(codes.DAY_DROP) == set("Unnamed__0 segment_type day_weight day_weight_fri day_weight_sat day_weight_sun "
                                      "day_weight_v2 day_weight_aggregated_v2".split())
    assert set(codes.VEHICLE_DROP) == set("segment_type hh_weight hh_weight_fri hh_weight_sat hh_weight_sun".split())
    assert set(codes.HH_DROP) == set(
        "Unnamed__0 home_taz home_lat home_lon home_x home_y sample_home_lat sample_home_lon segment_type seasonal_res "
        "seasonal_res_in_region residence_months_0 hh_weight hh_weight_fri hh_weight_sat hh_weight_sun hh_weight_v2 "
        "hh_weight_aggregated_v2".split())
    assert len(codes.PERSON_DROP) == len(set(codes.PERSON_DROP)) == 29
    assert {"second_home_x", "work_bg_2010", "school_taz", "person_weight_v2"} <= set(codes.PERSON_DROP)
    assert set(codes.TRIP_UNLINKED_DROP) == set(
        "Unnamed__0 segment_type o_taz o_lon o_lat o_x o_y d_taz d_lon d_lat d_x d_y trip_weight_v2 trip_weight "
        "trip_weight_fri trip_weight_sat trip_weight_sun trip_weight_aggregated_v2".split())
    assert codes.TRIP_MATCH_KEYS == ["hh_id", "person_id", "day_id", "depart_hour", "depart_minute", "depart_seconds"]
    assert codes.GUARDED_TRIP_ATTRS == (
        "speed_mph speed_mph_collected speed_flag distance_meters distance_meters_collected distance_miles "
        "distance_miles_collected park_location park_type park_pay park_cost ev_charge_station ev_charge_station_level_1 "
        "ev_charge_station_level_2 ev_charge_station_level_998 ev_charge_station_decision tnc_type taxi_type taxi_pay "
        "transit_type num_travelers num_hh_travelers num_non_hh_travelers driver").split()


def test_passthrough_columns_keep_their_values(spark):
    """The linked table's untouched columns equal the source's, column by column."""
    import __spark_entry__ as E
    from wayfarer.plans.queries import Inputs
    from wayfarer.sources.fixtures import LINKED_PASSTHROUGH
    sf = "/root/testdata/sf0.001"
    names = [c for c, _ in LINKED_PASSTHROUGH if c in codes.TRIP_LINKED_COLS]
    assert len(names) == len(LINKED_PASSTHROUGH)

    def sums(df):
        return df.select(*[F.sum(F.xxhash64(c).cast("decimal(38,0)")).alias(c) for c in names]).first().asDict()

    got = sums(E.queries()["trip_linked"](spark, sf))
    assert got == sums(Inputs(spark, sf).trip_linked_src) and len(set(got.values())) == len(names)
