"""Registered queries: one per operator group of SURVEY 7.3, plus the six tables.

Every callable takes ``(spark, sf_dir)``, reads the whole star tables under
``sf_dir`` (through the survey fixtures) and returns a lazy DataFrame whose
column names match the oracle SQL in ``oracle.py``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codes
from ..functions import recode as R
from ..functions.columns import clock_hhm, minutes_after_midnight, star_except
from ..operators import keys, spatial
from ..session import limit_methods
from ..sources import fixtures, zones
from . import tables as T


class Inputs:
    """Lazy loaders of the survey relations and zone indexes for one ``sf_dir``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        limit_methods(spark)
        self._zones = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name in fixtures.RELATIONS:
            return fixtures.load(self.spark, self.sf_dir, name)
        raise AttributeError(name)

    def zone_index(self, version: str):
        if version not in self._zones:
            self._zones[version] = zones.zone_index(zones.load_zones(self.spark, self.sf_dir, version), materialize=True)
        return self._zones[version]

    @property
    def v3(self):
        return self.zone_index("taz_v3")

    @property
    def v4(self):
        return self.zone_index("taz_v4")

    def trip_linked_with_key(self) -> DataFrame:
        """Linked trips with a deterministic surrogate key (comparable across engines)."""
        return keys.with_surrogate_key(self.trip_linked_src, method="hash", key_cols=["linked_trip_id"])


QUERIES: dict[str, Callable[[Inputs], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


# ---------------------------------------------------------------- projections & recodes
@query
def scan_star_except(i: Inputs) -> DataFrame:
    d = i.core_day
    return d.select(*star_except(d, codes.DAY_DROP), F.col("day_weight_v2").alias("day_weight_source"))


@query
def segment_clean(i: Inputs) -> DataFrame:
    return i.core_vehicle.select("vehicle_id", "segment_type", R.segment_cleaned().alias("segment_type_cleaned"))


@query
def weight_split(i: Inputs) -> DataFrame:
    college, other = R.weight_split("segment_type", "day_weight_v2")
    return i.core_day.select("day_id", "segment_type", college.alias("day_weight_col_enrol"),
                             other.alias("day_weight"))


@query
def drive_work_by_person(i: Inputs) -> DataFrame:
    return T.drive_work_by_person(i.core_trip)


@query
def person_trip_lookup(i: Inputs) -> DataFrame:
    p = T.left_join_keep_order(i.core_person.select("person_id"), T.drive_work_by_person(i.core_trip),
                               ["person_id"])
    return p.select("person_id",
                    F.coalesce("drive_work_trips", F.lit(0)).alias("drive_work_trips"),
                    F.coalesce("drive_work_distance", F.lit(0)).cast("double").alias("drive_work_distance"))


@query
def person_age_rules(i: Inputs) -> DataFrame:
    adult, senior, child = R.jobs_by_age()
    return i.core_person.select(
        "person_id", R.lifegroup_person().alias("lifegroup"), R.age_3cat().alias("age_3cat"),
        adult.alias("adultJobs"), senior.alias("seniorJobs"), child.alias("childJobs"),
        R.made_trips().alias("person_made_trips"))


# ---------------------------------------------------------------- households
@query
def hh_lifecycle(i: Inputs) -> DataFrame:
    return T.household_lifecycle(i.core_person)


@query
def hh_lifegroup_counts(i: Inputs) -> DataFrame:
    return T.household_lifegroup_counts(i.core_person)


@query
def hh_followon_flag(i: Inputs) -> DataFrame:
    return T.followon_flag(i.core_hh.select("hh_id"), i.followon_hh)


@query
def hh_day_flags(i: Inputs) -> DataFrame:
    return i.core_hh.select(
        "hh_id",
        R.has_any_complete("num_complete_tue", "num_complete_wed", "num_complete_thu").alias("has_TuTh"),
        R.has_any_complete("num_complete_mon", "num_complete_tue", "num_complete_wed", "num_complete_thu",
                           "num_complete_fri").alias("has_MoFr"),
        R.has_any_complete("num_complete_sat", "num_complete_sun").alias("has_SaSu"))


@query
def hh_capped_sizes(i: Inputs) -> DataFrame:
    return i.core_hh.select(
        "hh_id", R.capped("num_people", 6).alias("hhsize_6cat"), R.capped("num_workers", 3).alias("workers_4cat"),
        R.capped("num_vehicles", 3).alias("num_vehicles_4cat"), R.autosuf_wk().alias("autosuf_wk"))


@query
def hh_seasonal_checks(i: Inputs) -> DataFrame:
    lon_eq = R.same_rounded("home_lon", "seasonal_res_lon")
    lat_eq = R.same_rounded("home_lat", "seasonal_res_lat")
    return i.core_hh.select(
        "hh_id", R.flag(lon_eq).alias("tmp_seasonal_res_lon"), R.flag(lat_eq).alias("tmp_seasonal_res_lat"),
        R.flag(lon_eq & lat_eq).alias("chk_seasonal_res"),
        R.seasonal_res_cleaned().alias("seasonal_res_cleaned"),
        R.seasonal_res_in_region_cleaned().alias("seasonal_res_in_region_cleaned"))


@query
def hh_residence_months(i: Inputs) -> DataFrame:
    return i.core_hh.select("hh_id", R.residence_months_0_cleaned().alias("residence_months_0_cleaned"),
                            R.num_months().alias("num_months"))


# ---------------------------------------------------------------- zones
@query
def zone_within_home(i: Inputs) -> DataFrame:
    from ..functions.columns import to_long_rounded
    from ..operators.spatial import join_zones
    h = homes = i.core_hh.select("hh_id", "home_lon", "home_lat")
    h = join_zones(h, "home_lon", "home_lat", i.v3, {"CO_TAZID": "hCO_TAZID_USTMv3", "SUBAREAID": "_s3"})
    h = join_zones(h, "home_lon", "home_lat", i.v4, {"CO_TAZID": "hCO_TAZID_USTMv4", "SUBAREAID": "_s4"}, source=homes)
    return h.select("hh_id", "hCO_TAZID_USTMv3", to_long_rounded("_s3").alias("hSUBAREAID_USTMv3"),
                    "hCO_TAZID_USTMv4", to_long_rounded("_s4").alias("hSUBAREAID_USTMv4"))


@query
def zone_intersects_origin(i: Inputs) -> DataFrame:
    t = T.trip_zones_unlinked(i.core_trip.select("trip_id", "o_lon", "o_lat", "d_lon", "d_lat"), i.v3, i.v4)
    return t.select("trip_id", "oCO_TAZID_USTMv3", "oCO_TAZID_USTMv4", "oSUBAREAID")


@query
def zone_intersects_dest(i: Inputs) -> DataFrame:
    t = T.trip_zones_unlinked(i.core_trip.select("trip_id", "o_lon", "o_lat", "d_lon", "d_lat"), i.v3, i.v4)
    return t.select("trip_id", "dCO_TAZID_USTMv3", "dCO_TAZID_USTMv4", "dSUBAREAID")


@query
def zone_using_join(i: Inputs) -> DataFrame:
    t = T.trip_zones_linked(i.trip_linked_with_key().select("unique_id", "o_lon", "o_lat", "d_lon", "d_lat"),
                            i.v3, i.v4)
    return t.select("unique_id", "oCO_TAZID_USTMv3", "dCO_TAZID_USTMv3", "oCO_TAZID_USTMv4", "dCO_TAZID_USTMv4",
                    "oCO_FIPS", "dCO_FIPS", "oSUBAREAID", "dSUBAREAID")


def _wide_zones(i: Inputs, shift: float = 0.0) -> DataFrame:
    """The v3 zones ten times as large (edges of two degrees), moved east by ``shift`` degrees."""
    z = i.taz_v3
    for k in range(4):
        z = z.withColumns({f"x{k}": _moved(-112 + (F.col(f"x{k}") + 112) * 10, shift), f"y{k}": 40 + (F.col(f"y{k}") - 40) * 10})
    return zones.zones_from_quads(z)


def _moved(lon, shift: float):
    return lon if not shift else F.pmod(lon + (shift + 180), F.lit(360.0)) - 180


@query
def zone_geodesic_intersects(i: Inputs) -> DataFrame:
    index = zones.zone_index(_wide_zones(i), geodesic=True, materialize=True)
    t = i.core_trip.select("trip_id", "o_lon", "o_lat", "d_lon", "d_lat")
    t = spatial.assign_zone(t, "o_lon", "o_lat", index, {"CO_TAZID": "o_zone", "CO_FIPS": "o_fips"})
    return spatial.assign_zone(t, "d_lon", "d_lat", index, {"CO_TAZID": "d_zone"}).select("trip_id", "o_zone", "o_fips", "d_zone")


@query
def zone_geodesic_within(i: Inputs) -> DataFrame:
    h = homes = i.core_hh.select("hh_id", "home_lon", "home_lat")
    h = spatial.join_zones(h, "home_lon", "home_lat", zones.zone_index(_wide_zones(i), geodesic=True, materialize=True), {"CO_TAZID": "wide_zone"})
    small = zones.zone_index(zones.zones_from_quads(i.taz_v4), geodesic=True, materialize=True, off_globe="clip")
    return spatial.join_zones(h, "home_lon", "home_lat", small, {"CO_TAZID": "zone"}, source=homes).select("hh_id", "wide_zone", "zone")


@query
def zone_antimeridian(i: Inputs) -> DataFrame:
    """Homes and wide zones 75 degrees to the west, where the antimeridian runs through them."""
    h = i.core_hh.select("hh_id", _moved(F.col("home_lon"), -75.0).alias("lon"), F.col("home_lat").alias("lat"))
    return spatial.join_zones(h, "lon", "lat", zones.zone_index(_wide_zones(i, -75.0), geodesic=True, materialize=True),
                              {"CO_TAZID": "wide_zone"}).select("hh_id", "wide_zone")


@query
def zone_wkt(i: Inputs) -> DataFrame:
    """The household lookup with zones read from WKT text."""
    def index(df: DataFrame):
        points = [F.concat_ws(" ", F.col(f"x{k % 4}"), F.col(f"y{k % 4}")) for k in range(5)]
        text = F.concat(F.lit("POLYGON (("), F.concat_ws(", ", *points), F.lit("))"))
        return zones.zone_index(zones.with_rings(df.select(*zones.ZONE_ATTRS, text.alias("geometry"))), materialize=True)
    h = homes = i.core_hh.select("hh_id", "home_lon", "home_lat")
    h = spatial.join_zones(h, "home_lon", "home_lat", index(i.taz_v3), {"CO_TAZID": "hCO_TAZID_USTMv3"})
    return spatial.join_zones(h, "home_lon", "home_lat", index(i.taz_v4), {"CO_TAZID": "hCO_TAZID_USTMv4"}, source=homes).select(
        "hh_id", "hCO_TAZID_USTMv3", "hCO_TAZID_USTMv4")


@query
def zone_repeated_ids(i: Inputs) -> DataFrame:
    """Three trips share an id (every eleventh has none): each id gets the lowest zone of its trips."""
    t = i.core_trip.select("trip_id", "o_lon", "o_lat", F.when(F.col("trip_id") % 11 != 0, F.floor(F.col("trip_id") / 3)).alias("id"))
    t = spatial.assign_zone(t, "o_lon", "o_lat", i.v3, {"CO_TAZID": "zone", "CO_FIPS": "fips"}, id_col="id")
    return spatial.one_zone_per_id(t, "id", ["zone", "fips"]).select("trip_id", "id", "zone", "fips")


# ---------------------------------------------------------------- trip purposes & modes
@query
def purpose_3cat_linked(i: Inputs) -> DataFrame:
    return i.trip_linked_src.select(
        "linked_trip_id", R.purpose_3cat_linked("o_purpose_category").alias("o_purpose_category3"),
        R.purpose_3cat_linked("d_purpose_category").alias("d_purpose_category3"))


@query
def purpose_3cat_unlinked(i: Inputs) -> DataFrame:
    return i.core_trip.select(
        "trip_id", R.purpose_3cat_unlinked("o_purpose_category").alias("o_purpose_3cat"),
        R.purpose_3cat_unlinked("d_purpose_category").alias("d_purpose_3cat"))


@query
def purpose_labels(i: Inputs) -> DataFrame:
    return i.trip_linked_src.select(
        "linked_trip_id", R.purpose_type_label("o_purpose_category").alias("o_purpose_type"),
        R.purpose_type_label("d_purpose_category").alias("d_purpose_type"))


@query
def mode_labels(i: Inputs) -> DataFrame:
    return i.trip_linked_src.select("linked_trip_id", R.linked_mode_label().alias("linked_trip_mode_t"))


@query
def direction_linked(i: Inputs) -> DataFrame:
    return i.trip_linked_src.select(
        "linked_trip_id",
        R.direction_linked(R.purpose_3cat_linked("o_purpose_category"),
                           R.purpose_3cat_linked("d_purpose_category")).alias("PA_AP"))


@query
def direction_unlinked(i: Inputs) -> DataFrame:
    return i.core_trip.select("trip_id", R.direction_unlinked().alias("PA_AP"))


@query
def period_and_clock(i: Inputs) -> DataFrame:
    return i.core_trip.select(
        "trip_id", R.period("depart_hour").alias("depart_per"), R.period("arrive_hour").alias("arrive_per"),
        clock_hhm("depart_hour", "depart_minute").alias("depart_hhm"),
        minutes_after_midnight("depart_hour", "depart_minute").alias("depart_mam"),
        clock_hhm("arrive_hour", "arrive_minute").alias("arrive_hhm"),
        minutes_after_midnight("arrive_hour", "arrive_minute").alias("arrive_mam"))


@query
def int_distance_mode_auto(i: Inputs) -> DataFrame:
    return i.core_trip.select("trip_id", R.int_distance().alias("INT_Dist"), R.mode_auto().alias("mode_auto"))


@query
def purpose7_chain(i: Inputs) -> DataFrame:
    t = T.left_join_keep_order(i.core_trip, i.core_person.select("person_id", "school_type"), ["person_id"])
    t = t.withColumn("PURP7", R.purp7())
    return t.select("trip_id", "PURP7", R.purp7_text().alias("PURP7_t"), R.trip_purpose_text().alias("trip_pur_t"),
                    R.school_level_unlinked().alias("HBSch_lev"), R.purpose_period().alias("PURP_PER"))


@query
def purpose5_peak_linked(i: Inputs) -> DataFrame:
    t = i.trip_linked_src.withColumns({"PURP7_t": R.purp7_text_linked(), "depart_per": R.period("depart_hour")})
    return t.select("linked_trip_id", "PURP7_t", R.purp5_text().alias("PURP5_t"), R.peak_offpeak().alias("PK_OK"),
                    R.school_level_linked().alias("HBSch_lev"))


# ---------------------------------------------------------------- windows & trip matching
@query
def trip_dedup_first(i: Inputs) -> DataFrame:
    return T.dedup_unlinked_trips(i.core_trip).select("trip_id", *codes.TRIP_MATCH_KEYS, "segment_type")


@query
def activity_gap(i: Inputs) -> DataFrame:
    return T.with_activity_gap(i.core_trip).select("trip_id", "lag_arrive_mam", "activ_dur")


def _linked_with_unlinked(i: Inputs) -> DataFrame:
    t = i.trip_linked_src.withColumn("linked_trip_mode_t", R.linked_mode_label())
    return T.attach_unlinked(t, i.core_trip, key_source=i.trip_linked_src)


@query
def composite_trip_join(i: Inputs) -> DataFrame:
    return _linked_with_unlinked(i).select("linked_trip_id", *codes.GUARDED_TRIP_ATTRS)


@query
def model_mode(i: Inputs) -> DataFrame:
    t = _linked_with_unlinked(i)
    return t.select("linked_trip_id", "linked_trip_mode", "num_travelers",
                    R.model_mode().alias("model_trip_mode_WFv10"))


@query
def pa_swap(i: Inputs) -> DataFrame:
    t = T.trip_zones_unlinked(i.core_trip, i.v3, i.v4).withColumn("PA_AP", R.direction_unlinked())
    return t.select("trip_id", "PA_AP", *T.pa_swap([
        ("oCO_TAZID_USTMv3", "dCO_TAZID_USTMv3", "pCO_TAZID_USTMv3", "aCO_TAZID_USTMv3"),
        ("oCO_TAZID_USTMv4", "dCO_TAZID_USTMv4", "pCO_TAZID_USTMv4", "aCO_TAZID_USTMv4"),
        ("oSUBAREAID", "dSUBAREAID", "pSUBAREAID", "aSUBAREAID"),
        ("o_bg_2020", "d_bg_2020", "p_bg_2020", "a_bg_2020")]))


# ---------------------------------------------------------------- surrogate keys
@query
def surrogate_key(i: Inputs) -> DataFrame:
    """Random keys: one per row, all distinct, canonical 36-character form."""
    k = keys.with_surrogate_key(i.trip_linked_src, method="uuid")
    return k.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("unique_id").alias("n_distinct"),
                 F.min(F.length("unique_id")).alias("min_len"), F.max(F.length("unique_id")).alias("max_len"))


@query
def surrogate_key_hash(i: Inputs) -> DataFrame:
    return i.trip_linked_with_key().select("unique_id", "linked_trip_id")


# ---------------------------------------------------------------- whole tables
@query
def day(i: Inputs) -> DataFrame:
    return T.build_day(i.core_day)


@query
def vehicle(i: Inputs) -> DataFrame:
    return T.build_vehicle(i.core_vehicle)


@query
def person(i: Inputs) -> DataFrame:
    return T.build_person(i.core_person, i.core_trip)


@query
def hh(i: Inputs) -> DataFrame:
    return T.build_hh(i.core_hh, i.core_person, i.followon_hh, i.v3, i.v4)


@query
def trip_unlinked(i: Inputs) -> DataFrame:
    return T.build_trip_unlinked(i.core_trip, i.core_person, i.v3, i.v4)


@query
def trip_linked(i: Inputs) -> DataFrame:
    return T.build_trip_linked(i.trip_linked_with_key(), i.core_trip, i.v3, i.v4)


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn):
        return lambda spark, sf_dir: fn(Inputs(spark, sf_dir))
    return {name: bind(fn) for name, fn in QUERIES.items()}
