"""Fixed code lists, labels and column lists of the survey tables.

FIXED VALUES: every code, label and column name below must equal the survey
definitions exactly (labels are output data; column names are the output
schema).  They are written out in their natural order.
"""

# Purpose category code -> purpose type label (linked trips).
PURPOSE_TYPE_LABELS = {
    1: "home",
    2: "work",
    3: "work-related",
    4: "school",
    5: "school-related",
    6: "escort",
    7: "shop",
    8: "meal",
    9: "social-rec",
    10: "errand",
    11: "change-mode",
    12: "overnight",
    13: "other",
}

# Linked trip mode code -> label.
LINKED_MODE_LABELS = {
    -1: "Missing Response",
    1: "School Bus",
    2: "Drive-Transit",
    5: "Walk-Transit",
    8: "Shared-Ride 3+",
    9: "Shared-Ride 2",
    10: "Drive-Alone",
    11: "Bike",
    12: "Scooter",
    13: "Taxi",
    14: "TNC",
    15: "Walk",
    16: "Long Distance",
    17: "Other",
}

# PURP7 code -> purpose text (unlinked trips); anything else is 'HBOth'.
PURP7_LABELS = {
    1: "HBW",
    2: "HBSch",
    3: "HBShp",
    4: "HBOth",
    5: "NHBW",
    6: "NHBNW",
    7: "HBC",
    995: "Missing Response",
}
PURP7_DEFAULT = "HBOth"

# Seven purposes -> five purpose groups (linked trips).
PURP5_GROUPS = {
    "NHBNW": "NHB",
    "NHBW": "NHB",
    "HBW": "HBW",
    "HBSch": "HBSch",
    "HBC": "HBC",
    "HBOth": "HBO",
    "HBShp": "HBO",
}

# Linked trip mode code -> model mode; 13/14 and -1/16/17 depend on travellers.
MODEL_MODE_FIXED = {
    2: "drive-to-transit",
    5: "walk-to-transit",
    10: "auto-sov",
    11: "bike",
    12: "walk",
    15: "walk",
    1: "school_bus",
    9: "auto-occ2",
    8: "auto-occ3p",
}
MODEL_MODE_TAXI_TNC = (13, 14)
MODEL_MODE_OCCUPANCY_KNOWN = (-1, 16, 17)

# Period of day by hour (inclusive bounds); every other hour, and NULL, is 'EV'.
PERIODS = (("AM", 6, 8), ("MD", 9, 14), ("PM", 15, 17))
PERIOD_OTHER = "EV"

# Segment labels.
SEGMENT_COLLEGE = "College"
SEGMENT_SUPPLEMENTAL = "Supplemental"
SEGMENT_SUPPLEMENTAL_CLEAN = "CBS"

# Unlinked-trip attributes that are blanked on an occupancy mismatch, in order.
GUARDED_TRIP_ATTRS = [
    "speed_mph", "speed_mph_collected", "speed_flag",
    "distance_meters", "distance_meters_collected", "distance_miles", "distance_miles_collected",
    "park_location", "park_type", "park_pay", "park_cost",
    "ev_charge_station", "ev_charge_station_level_1", "ev_charge_station_level_2",
    "ev_charge_station_level_998", "ev_charge_station_decision",
    "tnc_type", "taxi_type", "taxi_pay", "transit_type",
    "num_travelers", "num_hh_travelers", "num_non_hh_travelers", "driver",
]

# Order of trips within a person for the previous-arrival lookup; the last
# columns only break ties between rows that repeat a trip id.
ACTIVITY_ORDER = ["hh_id", "person_id", "trip_id"]
ACTIVITY_TIEBREAK = ["depart_hour", "depart_minute", "arrive_hour", "arrive_minute", "distance_miles",
                     "trip_weight_v2", "speed_mph", "park_cost", "o_lon", "o_lat", "d_lon", "d_lat"]

# Keys that pair a linked trip with an unlinked trip (and de-duplicate the latter).
TRIP_MATCH_KEYS = ["hh_id", "person_id", "day_id", "depart_hour", "depart_minute", "depart_seconds"]

# Columns dropped from each source before the derived columns are appended.
DAY_DROP = ["Unnamed__0", "segment_type", "day_weight", "day_weight_fri", "day_weight_sat",
            "day_weight_sun", "day_weight_v2", "day_weight_aggregated_v2"]
VEHICLE_DROP = ["segment_type", "hh_weight", "hh_weight_fri", "hh_weight_sat", "hh_weight_sun"]
PERSON_DROP = ["Unnamed__0", "segment_type",
               "second_home_bg_2010", "second_home_bg_2020", "second_home_taz", "second_home_lon", "second_home_lat",
               "second_home_x", "second_home_y",
               "work_bg_2010", "work_bg_2020", "work_taz", "work_lon", "work_lat", "work_x", "work_y",
               "school_bg_2010", "school_bg_2020", "school_taz", "school_lon", "school_lat", "school_x", "school_y",
               "person_weight", "person_weight_fri", "person_weight_sat", "person_weight_sun",
               "person_weight_v2", "person_weight_aggregated_v2"]
HH_DROP = ["Unnamed__0", "home_taz", "home_lat", "home_lon", "home_x", "home_y", "sample_home_lat",
           "sample_home_lon", "segment_type", "seasonal_res", "seasonal_res_in_region",
           "residence_months_0", "hh_weight", "hh_weight_fri", "hh_weight_sat", "hh_weight_sun",
           "hh_weight_v2", "hh_weight_aggregated_v2"]
TRIP_UNLINKED_DROP = ["Unnamed__0", "segment_type", "o_taz", "o_lon", "o_lat", "o_x", "o_y",
                      "d_taz", "d_lon", "d_lat", "d_x", "d_y", "trip_weight_v2", "trip_weight",
                      "trip_weight_fri", "trip_weight_sat", "trip_weight_sun", "trip_weight_aggregated_v2"]
TRIP_LINKED_DROP = ["trip_weight_new", "o_lon", "o_lat", "d_lon", "d_lat"]

# The linked-trip output: exactly these columns in this order.
TRIP_LINKED_COLS = [
    "unique_id", "linked_trip_id", "hh_id", "person_id", "day_id", "day_weight",
    "person_num", "day_num",
    "participation_group", "diary_platform",
    "o_purpose", "o_purpose_category", "o_purpose_type", "o_purpose_category3", "o_purpose_type_rsg",
    "depart_time", "depart_date", "depart_hour", "depart_minute", "depart_second", "depart_per",
    "depart_hhm", "depart_mam",
    "d_purpose", "d_purpose_category", "d_purpose_type", "d_purpose_category3", "d_purpose_type_rsg",
    "arrive_time", "arrive_date", "arrive_hour", "arrive_minute", "arrive_second", "arrive_per",
    "arrive_hhm", "arrive_mam",
    "home_distance", "duration_minutes", "dwell_mins",
    "hh_member_1", "hh_member_2", "hh_member_3", "hh_member_4", "hh_member_5", "hh_member_6",
    "hh_member_7", "hh_member_8", "hh_member_9", "hh_member_10", "hh_member_11", "hh_member_12",
    "hh_member_13",
    "joint_status", "joint_trip_id", "joint_trip_num", "joint_num_participants",
    "escort_category", "outbound",
    "primdest_penalty", "trip_adjustment_factor",
    "speed_mph", "speed_mph_collected", "speed_flag",
    "distance_meters", "distance_meters_collected", "distance_miles", "distance_miles_collected",
    "park_location", "park_type", "park_pay", "park_cost",
    "ev_charge_station", "ev_charge_station_level_1", "ev_charge_station_level_2",
    "ev_charge_station_level_998", "ev_charge_station_decision",
    "tnc_type", "taxi_type", "taxi_pay",
    "transit_type",
    "num_travelers", "num_hh_travelers", "num_non_hh_travelers",
    "driver",
    "linked_trip_mode", "linked_trip_mode_t",
    "linked_trip_weight", "linked_trip_num",
    "tour_num", "tour_id",
    "trip_purp_RSG", "TMR_Purpose", "PURP5_t", "PURP7_t",
    "person_type", "person_cat",
    "school_type", "HBSch_lev",
    "PA_AP", "PK_OK",
    "oCO_TAZID_USTMv3", "dCO_TAZID_USTMv3", "pCO_TAZID_USTMv3", "aCO_TAZID_USTMv3",
    "oCO_TAZID_USTMv4", "dCO_TAZID_USTMv4", "pCO_TAZID_USTMv4", "aCO_TAZID_USTMv4",
    "pCO_FIPS", "aCO_FIPS", "pSUBAREAID", "aSUBAREAID", "model_trip_mode_WFv10",
    "trip_weight",
]
