"""Builders of the analysis tables.

Each builder takes source DataFrames and returns one DataFrame.  The rows are
computed when the caller writes or collects it; while the plan is built, the
trip builders run small sampling jobs over key columns (hot keys), and zone
indexes measure themselves.  Output columns follow the survey definitions: sources pass through except a drop list, derived
columns are appended, and the linked-trip table has a fixed column list.

Shuffle plan (per table, at scale):

* day, vehicle: narrow (scan + project).
* person: trips are filtered and partially aggregated per person before the
  shuffle; the aggregate's hash partitioning on person_id is reused by the
  join, so only persons are shuffled in addition.
* hh: one aggregation of persons per household (flags and counts together),
  two left joins on hh_id sharing one partitioning, zone lookups row-local.
* trip_unlinked: one join with persons on person_id (and piece, for persons
  with very many trips), whose partitioning the window reuses; zone lookups
  row-local (broadcast cell index).
* trip_linked: unlinked trips with complete keys are
  deduplicated (partial limit before the shuffle), and only the surviving row
  of a hot key is copied for the salted six-key join, which moves the linked trips
  once, with their source columns only; zone lookups and recodes follow row-local.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import codes
from ..functions import recode as R
from ..functions.columns import (clock_hhm, minutes_after_midnight, require_columns, star_except,
                                 to_long_rounded, try_to_long_rounded)
from ..operators import relational as rel
from ..operators.spatial import ZoneIndex, assign_zone, join_zones


def left_join_keep_order(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join on ``keys`` keeping the left columns first and in place."""
    renamed = [f"__r_{k}" for k in keys]
    r = right.select(*[F.col(k).alias(n) for k, n in zip(keys, renamed)],
                     *[c for c in right.columns if c not in keys])
    cond = None
    for k, n in zip(keys, renamed):
        c = F.col(k) == F.col(n)
        cond = c if cond is None else cond & c
    return left.join(r, cond, "left").drop(*renamed)


def _packed(df: DataFrame, rest: Sequence[str]) -> Column:
    """The columns ``rest`` as one struct ``__rest``: every join and lookup on the way copies it as one value, not column by column."""
    return F.struct(*[F.col(f"`{c}`").alias(c) for c in rest]).alias("__rest")


def _unpacked(names: Sequence[str], rest: Sequence[str], struct: str = "__rest") -> list[Column]:
    """Columns ``names``, those of ``rest`` out of ``struct``."""
    return [F.col(struct)[c].alias(c) if c in rest else F.col(f"`{c}`") for c in names]


# ---------------------------------------------------------------- T1 day
def build_day(core_day: DataFrame) -> DataFrame:
    college, other = R.weight_split("segment_type", "day_weight_v2")
    return core_day.select(
        *star_except(core_day, codes.DAY_DROP),
        R.segment_cleaned().alias("segment_type_cleaned"),
        college.alias("day_weight_col_enrol"),
        other.alias("day_weight"),
    )


# ---------------------------------------------------------------- T2 vehicle
def build_vehicle(core_vehicle: DataFrame) -> DataFrame:
    return core_vehicle.select(
        *star_except(core_vehicle, codes.VEHICLE_DROP),
        R.segment_cleaned().alias("segment_type_cleaned"),
    )


# ---------------------------------------------------------------- T3 person
def drive_work_by_person(core_trip: DataFrame) -> DataFrame:
    """E2+E1: work-type trips (trip_type 1 or 6) counted and summed per person."""
    trips = core_trip.where(F.col("trip_type").isin(1, 6)).select("person_id", "trip_id", "distance_miles")
    return rel.count_sum_by(trips, "person_id", "trip_id", "distance_miles",
                            "drive_work_trips", "drive_work_distance")


def build_person(core_person: DataFrame, core_trip: DataFrame) -> DataFrame:
    p = left_join_keep_order(core_person, drive_work_by_person(core_trip), ["person_id"])
    adult_jobs, senior_jobs, child_jobs = R.jobs_by_age()
    college, other = R.weight_split("segment_type", "person_weight_v2")
    return p.select(
        *star_except(core_person, codes.PERSON_DROP),
        R.segment_cleaned().alias("segment_type_cleaned"),
        R.lifegroup_person().alias("lifegroup"),
        R.age_3cat().alias("age_3cat"),
        adult_jobs.alias("adultJobs"),
        senior_jobs.alias("seniorJobs"),
        child_jobs.alias("childJobs"),
        R.made_trips().alias("person_made_trips"),
        F.coalesce(F.col("drive_work_trips"), F.lit(0)).alias("drive_work_trips"),
        F.coalesce(F.col("drive_work_distance"), F.lit(0)).cast("double").alias("drive_work_distance"),
        college.alias("person_weight_col_enrol"),
        other.alias("person_weight"),
    )


# ---------------------------------------------------------------- T4 household
def household_person_summary(core_person: DataFrame) -> DataFrame:
    """C17+C18 in one pass over persons: lifecycle and head counts per household.

    Head counts only see persons with a known age: a household whose ages are
    all NULL gets NULL counts (no counted rows), like a filtered aggregation.
    """
    age = F.col("age")
    group = R.lifegroup("age")
    agg = core_person.groupBy("hh_id").agg(
        F.max(F.when(group == "child", 1).otherwise(0)).alias("has_child"),
        F.max(F.when(group == "adult", 1).otherwise(0)).alias("has_adult"),
        F.max(F.when(group == "senior", 1).otherwise(0)).alias("has_senior"),
        F.count(age).alias("_n_age"),
        F.sum(F.when(age <= 3, 1).otherwise(0)).alias("_children"),
        F.sum(F.when((age > 3) & (age <= 8), 1).otherwise(0)).alias("_adults"),
        F.sum(F.when((age > 8) & (age <= 11), 1).otherwise(0)).alias("_seniors"),
    )
    known = F.col("_n_age") > 0
    return agg.select(
        "hh_id",
        R.lifecycle("has_child", "has_adult", "has_senior").alias("lifecycle"),
        F.when(known, F.col("_children")).alias("hh_children"),
        F.when(known, F.col("_adults")).alias("hh_adults"),
        F.when(known, F.col("_seniors")).alias("hh_seniors"),
    )


def household_lifecycle(core_person: DataFrame) -> DataFrame:
    """Presence flags and lifecycle per household."""
    group = R.lifegroup("age")
    flags = rel.presence_flags(core_person, "hh_id", group,
                               {"child": "has_child", "adult": "has_adult", "senior": "has_senior"})
    return flags.select("hh_id", "has_child", "has_adult", "has_senior",
                        R.lifecycle("has_child", "has_adult", "has_senior").alias("lifecycle"))


def household_lifegroup_counts(core_person: DataFrame) -> DataFrame:
    """children/adults/seniors per household over known ages."""
    age = F.col("age")
    return rel.conditional_counts(core_person.where(age.isNotNull()), "hh_id", {
        "hh_children": age <= 3,
        "hh_adults": (age > 3) & (age <= 8),
        "hh_seniors": (age > 8) & (age <= 11),
    })


def followon_flag(core_hh: DataFrame, followon_hh: DataFrame) -> DataFrame:
    """Left join the follow-on list (duplicates fan out) and flag matches."""
    f = followon_hh.select(F.col("hh_id").alias("__f_hh_id"))
    joined = core_hh.join(f, F.col("hh_id") == F.col("__f_hh_id"), "left")
    return joined.withColumn("completed_followon_hh", F.when(F.col("__f_hh_id").isNotNull(), 1).otherwise(0)) \
                 .drop("__f_hh_id")


def build_hh(core_hh: DataFrame, core_person: DataFrame, followon_hh: DataFrame,
             taz_v3: ZoneIndex, taz_v4: ZoneIndex) -> DataFrame:
    summary = household_person_summary(core_person)
    a = followon_flag(core_hh, followon_hh)
    a = left_join_keep_order(a, summary, ["hh_id"])
    a = join_zones(a, "home_lon", "home_lat", taz_v3,
                   {"CO_TAZID": "__h3_taz", "SUBAREAID": "__h3_sub"}, predicate="within", source=core_hh)
    a = join_zones(a, "home_lon", "home_lat", taz_v4,
                   {"CO_TAZID": "__h4_taz", "SUBAREAID": "__h4_sub"}, predicate="within", source=core_hh)
    college, other = R.weight_split("segment_type", "hh_weight_v2")
    lon_eq = R.same_rounded("home_lon", "seasonal_res_lon")
    lat_eq = R.same_rounded("home_lat", "seasonal_res_lat")
    return a.select(
        *star_except(core_hh, codes.HH_DROP),
        "completed_followon_hh",
        R.has_any_complete("num_complete_tue", "num_complete_wed", "num_complete_thu").alias("has_TuTh"),
        R.has_any_complete("num_complete_mon", "num_complete_tue", "num_complete_wed", "num_complete_thu",
                           "num_complete_fri").alias("has_MoFr"),
        R.has_any_complete("num_complete_sat", "num_complete_sun").alias("has_SaSu"),
        R.flag(lon_eq).alias("tmp_seasonal_res_lon"),
        R.flag(lat_eq).alias("tmp_seasonal_res_lat"),
        R.flag(lon_eq & lat_eq).alias("chk_seasonal_res"),
        R.segment_cleaned().alias("segment_type_cleaned"),
        R.seasonal_res_cleaned().alias("seasonal_res_cleaned"),
        R.seasonal_res_in_region_cleaned().alias("seasonal_res_in_region_cleaned"),
        R.residence_months_0_cleaned().alias("residence_months_0_cleaned"),
        R.capped("num_people", 6).alias("hhsize_6cat"),
        R.capped("num_workers", 3).alias("workers_4cat"),
        R.num_months().alias("num_months"),
        R.capped("num_vehicles", 3).alias("num_vehicles_4cat"),
        R.autosuf_wk().alias("autosuf_wk"),
        "lifecycle", "hh_children", "hh_adults", "hh_seniors",
        college.alias("hh_weight_col_enrol"),
        other.alias("hh_weight"),
        F.col("__h3_taz").alias("hCO_TAZID_USTMv3"),
        to_long_rounded("__h3_sub").alias("hSUBAREAID_USTMv3"),
        F.col("__h4_taz").alias("hCO_TAZID_USTMv4"),
        to_long_rounded("__h4_sub").alias("hSUBAREAID_USTMv4"),
    )


# ---------------------------------------------------------------- trip zones
TRIP_ENDS = [("o_lon", "o_lat"), ("d_lon", "d_lat")]


def trip_zones_unlinked(trips: DataFrame, taz_v3: ZoneIndex, taz_v4: ZoneIndex,
                        source: DataFrame | None = None) -> DataFrame:
    """D4x4 + pick (unlinked): zone ids as stored, sub-areas safely cast."""
    taz_v3, taz_v4 = (i.near(trips if source is None else source, TRIP_ENDS) for i in (taz_v3, taz_v4))
    t = assign_zone(trips, "o_lon", "o_lat", taz_v3, {"CO_TAZID": "oCO_TAZID_USTMv3"}, id_col="trip_id", source=source)
    t = assign_zone(t, "d_lon", "d_lat", taz_v3, {"CO_TAZID": "dCO_TAZID_USTMv3"}, id_col="trip_id", source=source)
    t = assign_zone(t, "o_lon", "o_lat", taz_v4, {"CO_TAZID": "oCO_TAZID_USTMv4", "SUBAREAID": "__o_sub"}, id_col="trip_id", source=source)
    t = assign_zone(t, "d_lon", "d_lat", taz_v4, {"CO_TAZID": "dCO_TAZID_USTMv4", "SUBAREAID": "__d_sub"}, id_col="trip_id", source=source)
    return t.withColumns({"dSUBAREAID": try_to_long_rounded("__d_sub"),
                          "oSUBAREAID": try_to_long_rounded("__o_sub")}).drop("__o_sub", "__d_sub")


def trip_zones_linked(trips: DataFrame, taz_v3: ZoneIndex, taz_v4: ZoneIndex,
                      source: DataFrame | None = None, id_col: str = "unique_id") -> DataFrame:
    """D4x4 + pick (linked): ids, counties and sub-areas strictly cast to BIGINT."""
    taz_v3, taz_v4 = (i.near(trips if source is None else source, TRIP_ENDS) for i in (taz_v3, taz_v4))
    t = assign_zone(trips, "o_lon", "o_lat", taz_v3, {"CO_TAZID": "__o3", "CO_FIPS": "__of"}, id_col=id_col, source=source)
    t = assign_zone(t, "d_lon", "d_lat", taz_v3, {"CO_TAZID": "__d3", "CO_FIPS": "__df"}, id_col=id_col, source=source)
    t = assign_zone(t, "o_lon", "o_lat", taz_v4, {"CO_TAZID": "__o4", "SUBAREAID": "__os"}, id_col=id_col, source=source)
    t = assign_zone(t, "d_lon", "d_lat", taz_v4, {"CO_TAZID": "__d4", "SUBAREAID": "__ds"}, id_col=id_col, source=source)
    return t.withColumns({
        "oCO_TAZID_USTMv3": to_long_rounded("__o3"), "dCO_TAZID_USTMv3": to_long_rounded("__d3"),
        "oCO_TAZID_USTMv4": to_long_rounded("__o4"), "dCO_TAZID_USTMv4": to_long_rounded("__d4"),
        "oCO_FIPS": to_long_rounded("__of"), "dCO_FIPS": to_long_rounded("__df"),
        "oSUBAREAID": to_long_rounded("__os"), "dSUBAREAID": to_long_rounded("__ds"),
    }).drop("__o3", "__d3", "__o4", "__d4", "__of", "__df", "__os", "__ds")


def pa_swap(pairs: Sequence[tuple[str, str, str, str]], pa: str = "PA_AP") -> list[Column]:
    """C36 over (origin, destination, production name, attraction name) tuples."""
    out = []
    for o, d, p_name, a_name in pairs:
        p, a = R.production_attraction(pa, o, d)
        out += [p.alias(p_name), a.alias(a_name)]
    return out


# ---------------------------------------------------------------- T5 trip_unlinked
ACTIVITY_ORDER = (*codes.ACTIVITY_ORDER, *codes.ACTIVITY_TIEBREAK)
# a person's pieces are cut on (hh, trip); tie-breakers only order rows inside a piece
RANGE_KEYS = ("hh_id", "trip_id")


def with_activity_gap(df: DataFrame, key_source: DataFrame | None = None) -> DataFrame:
    """previous arrival (per person, by hh, person, trip) and the gap to it.

    Persons with very many trips are split over several tasks (``HotRanges``);
    ``key_source`` is a cheaper table with the same trips.
    """
    arrive = minutes_after_midnight("arrive_hour", "arrive_minute")
    depart = minutes_after_midnight("depart_hour", "depart_minute")
    df = rel.previous_value_balanced(df, arrive, "person_id", list(ACTIVITY_ORDER), "lag_arrive_mam",
                                     key_source=key_source, range_keys=len(RANGE_KEYS))
    return df.withColumn("activ_dur", rel.gap_since_previous(depart, F.col("lag_arrive_mam")))


def person_lookup(core_trip: DataFrame, core_person: DataFrame):
    """Trips left-joined to their person on (person_id, piece).

    Every trip knows its piece; a person row is copied to each piece of a
    person with very many trips (all others have one).  The later per-person
    window runs on the same keys.  Returns (trips with ``__piece``, the ranges).
    """
    ranges = rel.HotRanges.find(core_trip, "person_id", list(RANGE_KEYS))
    trips = ranges.with_piece(core_trip, "__piece")
    persons = ranges.all_pieces(core_person.select("person_id", "school_type").where(F.col("person_id").isNotNull()),
                                "__piece")
    if ranges.table is None:     # piece 0 everywhere: the person alone is the key
        return left_join_keep_order(trips, persons.drop("__piece"), ["person_id"]), ranges
    return left_join_keep_order(trips, persons, ["person_id", "__piece"]), ranges


#: What the lookups, the window and the recodes of the unlinked trips read; other columns pass through as one struct.
_UNLINKED_READ = {
    "trip_id", "hh_id", "person_id", "depart_hour", "depart_minute", "arrive_hour", "arrive_minute", "segment_type", "trip_weight_v2",
    "o_lon", "o_lat", "d_lon", "d_lat", "o_bg_2020", "d_bg_2020", "o_purpose", "d_purpose", "o_purpose_category", "d_purpose_category",
    "o_purpose_type", "d_purpose_type", "trip_type", "mode_type_broad", "num_travelers", "distance_miles", "speed_mph", "park_cost",
}


def build_trip_unlinked(core_trip: DataFrame, core_person: DataFrame,
                        taz_v3: ZoneIndex, taz_v4: ZoneIndex) -> DataFrame:
    star_except(core_trip, codes.TRIP_UNLINKED_DROP)    # a name that is not there is an error
    dropped = {c.lower() for c in codes.TRIP_UNLINKED_DROP}
    kept = [c for c in core_trip.columns if c.lower() not in dropped]
    rest = [c for c in kept if c.lower() not in _UNLINKED_READ]
    read = [F.col(f"`{c}`") for c in core_trip.columns if c.lower() in _UNLINKED_READ]
    t, ranges = person_lookup(core_trip.select(*read, _packed(core_trip, rest)) if rest else core_trip, core_person)
    t = trip_zones_unlinked(t, taz_v3, taz_v4, source=core_trip)
    t = t.withColumn("PA_AP", R.direction_unlinked())
    t = t.withColumn("PURP7", R.purp7())
    derived = [c for c in t.columns if c not in core_trip.columns and c not in ("__piece", "__rest")]
    passthrough = _unpacked(kept + derived, rest)
    arrive = minutes_after_midnight("arrive_hour", "arrive_minute")
    depart = minutes_after_midnight("depart_hour", "depart_minute")
    # F2/F3 on the join's partitioning: no new shuffle
    t = rel.lag_in_pieces(t, ranges, "__piece", arrive, "lag_arrive_mam",
                          [c for c in ACTIVITY_ORDER if c != "person_id"], boundary_rows=core_trip)
    t = t.withColumn("activ_dur", rel.gap_since_previous(depart, F.col("lag_arrive_mam")))
    college, other = R.weight_split("segment_type", "trip_weight_v2")
    return t.select(
        *passthrough,
        R.segment_cleaned().alias("segment_type_cleaned"),
        R.purpose_3cat_unlinked("o_purpose_category").alias("o_purpose_3cat"),
        R.purpose_3cat_unlinked("d_purpose_category").alias("d_purpose_3cat"),
        R.period("depart_hour").alias("depart_per"),
        clock_hhm("depart_hour", "depart_minute").alias("depart_hhm"),
        minutes_after_midnight("depart_hour", "depart_minute").alias("depart_mam"),
        clock_hhm("arrive_hour", "arrive_minute").alias("arrive_hhm"),
        minutes_after_midnight("arrive_hour", "arrive_minute").alias("arrive_mam"),
        R.int_distance().alias("INT_Dist"),
        R.mode_auto().alias("mode_auto"),
        college.alias("trip_weight_col_enrol"),
        other.alias("trip_weight"),
        "lag_arrive_mam",
        "activ_dur",
        R.purp7_text().alias("PURP7_t"),
        R.trip_purpose_text().alias("trip_pur_t"),
        R.school_level_unlinked().alias("HBSch_lev"),
        R.purpose_period().alias("PURP_PER"),
        *pa_swap([("oCO_TAZID_USTMv3", "dCO_TAZID_USTMv3", "pCO_TAZID_USTMv3", "aCO_TAZID_USTMv3"),
                  ("oCO_TAZID_USTMv4", "dCO_TAZID_USTMv4", "pCO_TAZID_USTMv4", "aCO_TAZID_USTMv4"),
                  ("oSUBAREAID", "dSUBAREAID", "pSUBAREAID", "aSUBAREAID"),
                  ("o_bg_2020", "d_bg_2020", "p_bg_2020", "a_bg_2020")]),
    )


# ---------------------------------------------------------------- T6/T7 trip_linked
def dedup_unlinked_trips(core_trip: DataFrame) -> DataFrame:
    """One unlinked trip per match key (segment NULLS LAST, then trip_id).

    Rows that tie on (segment, trip_id) - repeated trip ids - are ordered by
    the attributes the match carries, so the kept row is deterministic.
    """
    order = [F.col("segment_type").asc_nulls_last(), F.col("trip_id").asc()]
    order += [F.col(c).asc() for c in codes.GUARDED_TRIP_ATTRS]
    return rel.dedup_first(core_trip, codes.TRIP_MATCH_KEYS, order)


def attach_unlinked(trips: DataFrame, core_trip: DataFrame, row_id: Sequence[str] | None = None,
                    key_source: DataFrame | None = None, packed: str | None = None) -> DataFrame:
    """D3+C37: six-key left join to the de-duplicated unlinked trips, guarded attributes.

    Unlinked trips with a NULL key can match nothing and are dropped first;
    the rest is deduplicated, and then only the one row of a hot key is copied
    per salt.  Linked trips on a hot key, or with a NULL key, spread over the
    salts by a row hash (``rel.SaltedKeys``).  Both sides are repartitioned on
    (keys, salt) explicitly, so balance depends on no session setting.
    ``row_id``: columns identifying a linked trip (for the salt hash).
    ``key_source``: a cheaper table with the same linked trips and keys to
    count hot keys on (e.g. the source before zone lookups).
    ``packed``: give the attributes as one struct of this name (NULL without a match)
    instead of columns, for a caller that carries them through further steps.
    """
    keys = codes.TRIP_MATCH_KEYS
    salt = rel.SaltedKeys.detect(key_source if key_source is not None else trips, keys)
    row_id = list(row_id or (["linked_trip_id"] if "linked_trip_id" in trips.columns else trips.columns))
    u = dedup_unlinked_trips(core_trip.dropna("any", subset=list(keys)))
    u = salt.salt_right(u.select(*keys, *codes.GUARDED_TRIP_ATTRS), "__salt")
    on = [*keys, "__salt"]
    attrs = ([F.struct(*codes.GUARDED_TRIP_ATTRS).alias(f"__u_{packed}")] if packed
             else [F.col(c).alias(f"__u_{c}") for c in codes.GUARDED_TRIP_ATTRS])
    u = u.select(*[F.col(k).alias(f"__u_{k}") for k in on], *attrs)
    u = u.repartition(*[F.col(f"__u_{k}") for k in on])
    t = salt.salt_left(trips, F.xxhash64(*[F.col(c) for c in row_id]), "__salt").repartition(*[F.col(k) for k in on])
    cond = F.lit(True)
    for k in on:
        cond = cond & (F.col(k) == F.col(f"__u_{k}"))
    j = t.join(u, cond, "left")
    bad = "__bad"
    if packed:
        mismatch = R.occupancy_mismatch("linked_trip_mode_t", F.col(f"__u_{packed}")["num_travelers"])
        return (j.withColumn(packed, F.when(mismatch, F.lit(None)).otherwise(F.col(f"__u_{packed}")))
                .drop("__salt", *[f"__u_{k}" for k in on], f"__u_{packed}"))
    j = j.withColumn(bad, R.occupancy_mismatch("linked_trip_mode_t", "__u_num_travelers"))
    guarded = {c: F.when(F.col(bad), F.lit(None)).otherwise(F.col(f"__u_{c}")) for c in codes.GUARDED_TRIP_ATTRS}
    return j.withColumns(guarded).drop(bad, "__salt", *[f"__u_{k}" for k in on],
                                       *[f"__u_{c}" for c in codes.GUARDED_TRIP_ATTRS])


def linked_recodes(t: DataFrame) -> DataFrame:
    """Stages 6-10 of the linked-trip table: purposes, mode, direction, times, school."""
    return t.withColumns({
        "o_purpose_category3": R.purpose_3cat_linked("o_purpose_category"),
        "d_purpose_category3": R.purpose_3cat_linked("d_purpose_category"),
        "o_purpose_type": R.purpose_type_label("o_purpose_category"),
        "d_purpose_type": R.purpose_type_label("d_purpose_category"),
        "linked_trip_mode_t": R.linked_mode_label("linked_trip_mode"),
    }).withColumns({
        "PA_AP": R.direction_linked("o_purpose_category3", "d_purpose_category3"),
        "depart_per": R.period("depart_hour"),
        "arrive_per": R.period("arrive_hour"),
        "depart_hhm": clock_hhm("depart_hour", "depart_minute"),
        "depart_mam": minutes_after_midnight("depart_hour", "depart_minute"),
        "arrive_hhm": clock_hhm("arrive_hour", "arrive_minute"),
        "arrive_mam": minutes_after_midnight("arrive_hour", "arrive_minute"),
        "PURP7_t": R.purp7_text_linked("Model_Purpose"),
        "depart_second": F.col("depart_seconds"),
        "HBSch_lev": R.school_level_linked("Model_Purpose", "school_type"),
    })


def build_trip_linked(trip_linked_with_uuid: DataFrame, core_trip: DataFrame,
                      taz_v3: ZoneIndex, taz_v4: ZoneIndex) -> DataFrame:
    src = trip_linked_with_uuid
    require_columns(src, [c for c in codes.TRIP_LINKED_COLS if c not in _LINKED_DERIVED], "trip_linked source")
    rest = [c for c in codes.TRIP_LINKED_COLS if c not in _LINKED_DERIVED and c not in _LINKED_READ]
    # the join first: it moves the source columns only, all others are derived behind its shuffle
    t = src.select(*_LINKED_READ, _packed(src, rest), R.linked_mode_label("linked_trip_mode").alias("linked_trip_mode_t"))
    t = attach_unlinked(t, core_trip, row_id=["unique_id"], key_source=src, packed="__match")
    t = trip_zones_linked(t, taz_v3, taz_v4, source=src)
    t = t.select(*star_except(t, codes.TRIP_LINKED_DROP), F.col("trip_weight_new").alias("trip_weight"))
    t = linked_recodes(t)
    t = t.select(
        *[c for c in t.columns if c not in ("__rest", "__match")],
        *_unpacked(rest, rest),
        *_unpacked(codes.GUARDED_TRIP_ATTRS, codes.GUARDED_TRIP_ATTRS, "__match"),
        *pa_swap([("oCO_TAZID_USTMv3", "dCO_TAZID_USTMv3", "pCO_TAZID_USTMv3", "aCO_TAZID_USTMv3"),
                  ("oCO_TAZID_USTMv4", "dCO_TAZID_USTMv4", "pCO_TAZID_USTMv4", "aCO_TAZID_USTMv4"),
                  ("oCO_FIPS", "dCO_FIPS", "pCO_FIPS", "aCO_FIPS"),
                  ("oSUBAREAID", "dSUBAREAID", "pSUBAREAID", "aSUBAREAID")]),
        R.model_mode("linked_trip_mode", F.col("__match")["num_travelers"]).alias("model_trip_mode_WFv10"),
        R.purp5_text("PURP7_t").alias("PURP5_t"),
        R.peak_offpeak("depart_per").alias("PK_OK"),
    )
    return t.select(*codes.TRIP_LINKED_COLS)


#: What the join, the lookups and the recodes of the linked trips read; other columns pass through as one struct.
_LINKED_READ = [
    "unique_id", *codes.TRIP_MATCH_KEYS, "o_lon", "o_lat", "d_lon", "d_lat", "o_purpose_category", "d_purpose_category",
    "arrive_hour", "arrive_minute", "linked_trip_mode", "Model_Purpose", "school_type", "trip_weight_new",
]

_LINKED_DERIVED = {
    "o_purpose_type", "o_purpose_category3", "depart_second", "depart_per", "depart_hhm", "depart_mam",
    "d_purpose_type", "d_purpose_category3", "arrive_per", "arrive_hhm", "arrive_mam",
    *codes.GUARDED_TRIP_ATTRS, "linked_trip_mode_t", "PURP5_t", "PURP7_t", "HBSch_lev", "PA_AP", "PK_OK",
    "oCO_TAZID_USTMv3", "dCO_TAZID_USTMv3", "pCO_TAZID_USTMv3", "aCO_TAZID_USTMv3",
    "oCO_TAZID_USTMv4", "dCO_TAZID_USTMv4", "pCO_TAZID_USTMv4", "aCO_TAZID_USTMv4",
    "pCO_FIPS", "aCO_FIPS", "pSUBAREAID", "aSUBAREAID", "model_trip_mode_WFv10", "trip_weight",
}
