"""DuckDB oracle SQL for every registered query.

Each statement reads the star-table views through the same fixture text as
the Spark side (``fixtures.relation_sql``) and re-states the survey rules in
plain SQL.  DuckDB specifics handled here: ``* EXCLUDE``, explicit NULLS
FIRST/LAST, NULL-propagating GREATEST/LEAST by CASE, integer SUMs cast back
to BIGINT, and the point-in-polygon test spelt out over the four edges of
each test zone (DuckDB's spatial extension is not available offline).

The zone pick is "lowest CO_TAZID among the matching zones" with the other
attributes from that same zone, which is what the Spark operator returns.
"""

from __future__ import annotations

from ..functions import codes
from ..sources.fixtures import relation_sql


def _with(names, *ctes) -> str:
    parts = [f"{n} AS ({relation_sql(n)})" for n in names]
    parts += [f"{n} AS ({body})" for n, body in ctes]
    return "WITH " + ",\n".join(parts) + "\n"


# ---------------------------------------------------------------- spatial predicates
_QUAD_EDGES = [("x0", "y0", "x1", "y1"), ("x1", "y1", "x2", "y2"), ("x2", "y2", "x3", "y3"), ("x3", "y3", "x0", "y0")]


def _edges(z):
    return [tuple(f"{z}.{c}" for c in e) for e in _QUAD_EDGES]


def _inside(px, py, z) -> str:
    crossings = " + ".join(
        f"(CASE WHEN (({ya} > {py}) <> ({yb} > {py})) AND "
        f"({px} < ({xb} - {xa}) * ({py} - {ya}) / NULLIF({yb} - {ya}, 0.0) + {xa}) THEN 1 ELSE 0 END)"
        for xa, ya, xb, yb in _edges(z))
    return f"(({crossings}) % 2 = 1)"


def _on_edge(px, py, z) -> str:
    tests = " OR ".join(
        f"((({xb} - {xa}) * ({py} - {ya}) - ({yb} - {ya}) * ({px} - {xa}) = 0) "
        f"AND {px} BETWEEN least({xa}, {xb}) AND greatest({xa}, {xb}) "
        f"AND {py} BETWEEN least({ya}, {yb}) AND greatest({ya}, {yb}))"
        for xa, ya, xb, yb in _edges(z))
    return f"({tests})"


def intersects(px, py, z) -> str:
    return f"({_inside(px, py, z)} OR {_on_edge(px, py, z)})"


def within(px, py, z) -> str:
    return f"({_inside(px, py, z)} AND NOT {_on_edge(px, py, z)})"


def _pick(src, key, lon, lat, zone, extra=()) -> str:
    """Lowest matching zone id per key, other attributes from that zone."""
    cols = "".join(f", arg_min(z.{a}, z.CO_TAZID) AS {a}" for a in extra)
    return (f"SELECT t.{key}, min(z.CO_TAZID) AS CO_TAZID{cols} FROM {src} t JOIN {zone} z "
            f"ON {intersects(f't.{lon}', f't.{lat}', 'z')} GROUP BY t.{key}")


def _vector(lon: str, lat: str) -> list[str]:
    return [f"cos(radians({lat})) * cos(radians({lon}))", f"cos(radians({lat})) * sin(radians({lon}))", f"sin(radians({lat}))"]


def _arcs(zone: str, scale: int = 1) -> str:
    """Geodesic edges of a quad table, running eastwards, with the cross product of their ends; (CO_TAZID, CO_FIPS, x1 .. y2, nx, ny, nz)."""
    def at(c: str) -> str:
        if scale == 1:
            return c
        return f"-112 + ({c} + 112) * {scale}" if c[0] == "x" else f"40 + ({c} - 40) * {scale}"
    raw = " UNION ALL ".join(f"SELECT CO_TAZID, CO_FIPS, {at(a)} AS xa, {at(b)} AS ya, {at(c)} AS xb, {at(d)} AS yb FROM {zone}" for a, b, c, d in _QUAD_EDGES)
    east = ("SELECT CO_TAZID, CO_FIPS, least(xa, xb) AS x1, CASE WHEN xa <= xb THEN ya ELSE yb END AS y1, "
            f"greatest(xa, xb) AS x2, CASE WHEN xa <= xb THEN yb ELSE ya END AS y2 FROM ({raw})")
    a, b = _vector("x1", "y1"), _vector("x2", "y2")
    cross = [f"({a[i]}) * ({b[j]}) - ({a[j]}) * ({b[i]})" for i, j in ((1, 2), (2, 0), (0, 1))]
    return f"SELECT *, {cross[0]} AS nx, {cross[1]} AS ny, {cross[2]} AS nz FROM ({east})"


def _geodesic_hits(src: str, key: str, lon: str, lat: str, arcs: str) -> str:
    """(key, CO_TAZID, CO_FIPS, inside, edge): three-vector orientation of each point against the arcs that span its longitude."""
    v = _vector(f"t.{lon}", f"t.{lat}")
    dot = f"e.nx * ({v[0]}) + e.ny * ({v[1]}) + e.nz * ({v[2]})"
    north = f"CASE WHEN t.{lon} = e.x1 THEN e.y1 <= t.{lat} ELSE {dot} > 0 END"
    edge = (f"(t.{lon} = e.x1 AND t.{lat} = e.y1) OR (t.{lon} = e.x2 AND t.{lat} = e.y2) OR CASE WHEN e.x1 = e.x2 "
            f"THEN t.{lat} BETWEEN least(e.y1, e.y2) AND greatest(e.y1, e.y2) ELSE {dot} = 0 END")
    return (f"SELECT t.{key}, e.CO_TAZID, e.CO_FIPS, count(*) FILTER (t.{lon} < e.x2 AND {north}) % 2 = 1 AS inside, bool_or({edge}) AS edge "
            f"FROM {src} t JOIN {arcs} e ON t.{lon} BETWEEN e.x1 AND e.x2 GROUP BY ALL")


# ---------------------------------------------------------------- rule fragments
def seg_clean(c="segment_type"):
    return f"CASE WHEN {c} = 'Supplemental' THEN 'CBS' ELSE {c} END"


def w_college(w, s="segment_type"):
    return f"CASE WHEN {s} = 'College' THEN {w} END"


def w_other(w, s="segment_type"):
    return f"CASE WHEN {s} IS DISTINCT FROM 'College' THEN {w} END"


def greatest_strict(*cs):
    return f"CASE WHEN {' AND '.join(f'{c} IS NOT NULL' for c in cs)} THEN greatest({', '.join(cs)}) END"


def least_strict(c, cap):
    return f"CASE WHEN {c} IS NOT NULL THEN least({c}, {cap}) END"


def hhm(h, m):
    return f"TRY_CAST(printf('%02d%02d', {h}, {m}) AS BIGINT)"


def mam(h, m):
    return f"({h} * 60 + {m})"


def period(h):
    return (f"CASE WHEN {h} BETWEEN 6 AND 8 THEN 'AM' WHEN {h} BETWEEN 9 AND 14 THEN 'MD' "
            f"WHEN {h} BETWEEN 15 AND 17 THEN 'PM' ELSE 'EV' END")


def period_no(h):
    return (f"CASE WHEN {h} BETWEEN 6 AND 8 THEN 1 WHEN {h} BETWEEN 9 AND 14 THEN 2 "
            f"WHEN {h} BETWEEN 15 AND 17 THEN 3 ELSE 4 END")


def cat3(c, work_codes):
    return (f"CASE WHEN {c} = 1 THEN 'Home' WHEN {c} IN ({work_codes}) THEN 'Work' "
            f"WHEN {c} IN (995, -1) THEN 'Undefined' ELSE 'Other' END")


def cat3_linked(c):
    return cat3(c, "2, 3")


def cat3_unlinked(c):
    return cat3(c, "2")


def simple_case(c, mapping, default="NULL"):
    def lit(v):
        return f"'{v}'" if isinstance(v, str) else str(v)
    whens = " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in mapping.items())
    return f"CASE {c} {whens} ELSE {default} END"


def direction_unlinked(t=""):
    o, d = f"{t}o_purpose_category", f"{t}d_purpose_category"
    return (f"CASE WHEN {o} = 1 THEN 'PA' WHEN {d} = 1 THEN 'AP' "
            f"WHEN {o} = 2 AND ({cat3_unlinked(d)}) = 'Other' THEN 'PA' "
            f"WHEN ({cat3_unlinked(o)}) = 'Other' AND {d} = 2 THEN 'AP' "
            f"WHEN {t}o_purpose_type = 995 OR {t}d_purpose_type = 995 THEN 'Undefined' ELSE 'PA' END")


def direction_linked(o3, d3):
    return (f"CASE WHEN {o3} = 'Home' THEN 'PA' WHEN {d3} = 'Home' THEN 'AP' "
            f"WHEN {o3} = 'Work' AND {d3} = 'Other' THEN 'PA' WHEN {o3} = 'Other' AND {d3} = 'Work' THEN 'AP' "
            f"WHEN {o3} = 'Undefined' OR {d3} = 'Undefined' THEN 'Undefined' ELSE 'PA' END")


PURP7_SCH = ("CASE WHEN trip_type = 2 AND (o_purpose = 22 OR d_purpose = 22) THEN 7 "
             "WHEN trip_type = 2 AND (o_purpose = 21 OR d_purpose = 21) THEN 2 "
             "WHEN trip_type = 2 AND (o_purpose IN (23, 24, 25, 26) OR d_purpose IN (23, 24, 25, 26)) THEN 4 "
             "WHEN trip_type = 2 AND (o_purpose = 60 OR d_purpose = 60) AND school_type IN (11, 12, 13) THEN 7 "
             "WHEN trip_type = 2 AND (o_purpose = 60 OR d_purpose = 60) AND school_type IN (5, 6, 7) THEN 2 "
             "WHEN trip_type = 2 THEN 4 END")
PURP7 = (f"CASE trip_type WHEN 1 THEN 1 WHEN 3 THEN 3 WHEN 4 THEN 4 WHEN 5 THEN 4 WHEN 6 THEN 5 WHEN 7 THEN 6 "
         f"WHEN 995 THEN 995 WHEN 2 THEN COALESCE(CASE WHEN ({PURP7_SCH}) IN (2, 4, 7) THEN ({PURP7_SCH}) END, 10) "
         f"ELSE 10 END")
PURP7_T = simple_case("PURP7", codes.PURP7_LABELS, "'HBOth'")
TRIP_PUR_T = f"CASE WHEN PURP7 = 4 AND trip_type = 4 THEN 'HBPb' ELSE {PURP7_T} END"
HBSCH_UNLINKED = ("CASE WHEN PURP7 = 2 THEN (CASE WHEN school_type = 5 THEN 'primary' "
                  "WHEN school_type IN (6, 7) THEN 'secondary' ELSE 'undefined' END) END")
PURP_PER = f"CASE WHEN PURP7 = 995 THEN 995 ELSE PURP7 + (({period_no('depart_hour')}) - 1) * 7 END"

HBSCH_LINKED = ("CASE WHEN Model_Purpose = 'HBSch' THEN (CASE WHEN school_type = 5 THEN 'primary' "
                "WHEN school_type IN (6, 7) THEN 'secondary' WHEN school_type IS NOT NULL THEN 'undefined' END) END")
PURP7_T_LINKED = "CASE WHEN Model_Purpose = 'HBO' THEN 'HBOth' ELSE Model_Purpose END"
PURP5_T = simple_case("PURP7_t", codes.PURP5_GROUPS)
PK_OK = "CASE WHEN depart_per IN ('AM', 'PM') THEN 'PK' WHEN depart_per IN ('MD', 'EV') THEN 'OK' END"

MODE_AUTO = ("CASE WHEN mode_type_broad = 3 AND num_travelers = 1 THEN 3.1 "
             "WHEN mode_type_broad = 3 AND num_travelers = 2 THEN 3.2 "
             "WHEN mode_type_broad = 3 AND num_travelers >= 3 THEN 3.3 "
             "ELSE CAST(mode_type_broad AS DOUBLE) END")
INT_DIST = "CAST(floor(coalesce(distance_miles, 0)) AS BIGINT)"

MODEL_MODE = (
    "CASE WHEN linked_trip_mode IN (2, 5, 10, 11, 12, 15, 1, 9, 8) THEN "
    + simple_case("linked_trip_mode", codes.MODEL_MODE_FIXED)
    + " WHEN linked_trip_mode IN (13, 14) THEN (CASE WHEN TRY_CAST(num_travelers AS BIGINT) >= 2 "
      "THEN 'auto-occ3p' ELSE 'auto-occ2' END)"
    + " WHEN linked_trip_mode IN (-1, 16, 17) THEN (CASE WHEN TRY_CAST(num_travelers AS BIGINT) = 2 "
      "THEN 'auto-occ2' WHEN TRY_CAST(num_travelers AS BIGINT) >= 3 THEN 'auto-occ3p' ELSE 'auto-sov' END) END")


def pa(o, d, p_name, a_name, dirc="PA_AP"):
    return (f"CASE {dirc} WHEN 'PA' THEN {o} WHEN 'AP' THEN {d} END AS {p_name}, "
            f"CASE {dirc} WHEN 'PA' THEN {d} WHEN 'AP' THEN {o} END AS {a_name}")


def months_count(pred) -> str:
    return " + ".join(f"(CASE WHEN residence_months_{k} {pred} THEN 1 ELSE 0 END)" for k in range(1, 13))


RES_M0_CLEAN = (f"CASE WHEN ({months_count('= 995')}) > 0 THEN 995 "
                f"WHEN residence_months_0 = 0 AND ({months_count('<> 1')}) = 0 THEN 1 ELSE residence_months_0 END")
NUM_MONTHS = f"CAST(CASE WHEN residence_months_0 = 995 THEN 995 ELSE {months_count('IN (0, 1)')} END AS BIGINT)"

LON_EQ = "round(home_lon, 1) = round(seasonal_res_lon, 1)"
LAT_EQ = "round(home_lat, 1) = round(seasonal_res_lat, 1)"
SEASONAL = ("CASE WHEN seasonal_res_in_region = 0 AND seasonal_res IN (0, 1) THEN 2 "
            f"WHEN seasonal_res_in_region = 1 AND seasonal_res = 0 THEN (CASE WHEN {LAT_EQ} AND {LON_EQ} THEN 1 ELSE 2 END) "
            "WHEN seasonal_res_in_region = 1 AND seasonal_res = 1 AND "
            "(round(home_lat, 1) <> round(seasonal_res_lat, 1) OR round(home_lon, 1) <> round(seasonal_res_lon, 1)) THEN 2 "
            f"WHEN seasonal_res_in_region = 1 AND seasonal_res = 2 AND {LAT_EQ} AND {LON_EQ} THEN 1 "
            "ELSE seasonal_res END")
SEASONAL_REGION = ("CASE WHEN seasonal_res = 2 AND seasonal_res_in_region = 995 THEN 0 "
                   "ELSE seasonal_res_in_region END")
AUTOSUF = ("CASE WHEN num_vehicles >= num_workers THEN 'Sufficient' "
           "WHEN num_vehicles > 0 AND num_vehicles < num_workers THEN 'Insufficient' "
           "WHEN num_vehicles = 0 THEN 'No Vehicles' END")

LIFEGROUP = "CASE WHEN age <= 3 THEN 'child' WHEN age <= 8 THEN 'adult' WHEN age <= 11 THEN 'senior' END"
LIFECYCLE_CTE = (
    f"SELECT hh_id, has_child, has_adult, has_senior, "
    f"CASE WHEN has_adult = 1 AND has_child = 0 AND has_senior = 0 THEN 1 "
    f"WHEN has_adult = 1 AND has_child = 1 AND has_senior = 0 THEN 2 ELSE 3 END AS lifecycle FROM ("
    f"SELECT hh_id, max(CASE WHEN lg = 'child' THEN 1 ELSE 0 END) AS has_child, "
    f"max(CASE WHEN lg = 'adult' THEN 1 ELSE 0 END) AS has_adult, "
    f"max(CASE WHEN lg = 'senior' THEN 1 ELSE 0 END) AS has_senior "
    f"FROM (SELECT hh_id, {LIFEGROUP} AS lg FROM core_person) GROUP BY hh_id)")
COUNTS_CTE = ("SELECT hh_id, CAST(count(*) FILTER (WHERE age <= 3) AS BIGINT) AS hh_children, "
              "CAST(count(*) FILTER (WHERE age > 3 AND age <= 8) AS BIGINT) AS hh_adults, "
              "CAST(count(*) FILTER (WHERE age > 8 AND age <= 11) AS BIGINT) AS hh_seniors "
              "FROM core_person WHERE age IS NOT NULL GROUP BY hh_id")
DRIVE_WORK_CTE = ("SELECT person_id, count(trip_id) AS drive_work_trips, sum(distance_miles) AS drive_work_distance "
                  "FROM core_trip WHERE trip_type IN (1, 6) GROUP BY person_id")

PERSON_RULES = (
    "CASE WHEN segment_type <> 'College' AND age <= 3 THEN 'child' "
    "WHEN segment_type <> 'College' AND age <= 8 THEN 'adult' "
    "WHEN segment_type <> 'College' AND age <= 11 THEN 'senior' END AS lifegroup, "
    "CASE WHEN segment_type <> 'College' THEN (CASE WHEN age BETWEEN 0 AND 3 THEN 1 WHEN age BETWEEN 4 AND 8 THEN 2 "
    "WHEN age >= 9 THEN 3 END) END AS age_3cat, "
    "CASE WHEN age BETWEEN 4 AND 8 THEN num_jobs ELSE 0 END AS adultJobs, "
    "CASE WHEN age >= 9 THEN num_jobs ELSE 0 END AS seniorJobs, "
    "CASE WHEN age <= 3 THEN num_jobs ELSE 0 END AS childJobs, "
    "CASE WHEN num_trips > 0 THEN 1 ELSE 0 END AS person_made_trips")

HH_DAY_FLAGS = (
    greatest_strict("num_complete_tue", "num_complete_wed", "num_complete_thu") + " AS has_TuTh, "
    + greatest_strict("num_complete_mon", "num_complete_tue", "num_complete_wed", "num_complete_thu",
                      "num_complete_fri") + " AS has_MoFr, "
    + greatest_strict("num_complete_sat", "num_complete_sun") + " AS has_SaSu")


def _excl(names) -> str:
    return ", ".join(names)


ZONES = ["taz_v3", "taz_v4"]
UNLINKED_PICKS = [
    ("o3", _pick("core_trip", "trip_id", "o_lon", "o_lat", "taz_v3")),
    ("d3", _pick("core_trip", "trip_id", "d_lon", "d_lat", "taz_v3")),
    ("o4", _pick("core_trip", "trip_id", "o_lon", "o_lat", "taz_v4", ["SUBAREAID"])),
    ("d4", _pick("core_trip", "trip_id", "d_lon", "d_lat", "taz_v4", ["SUBAREAID"])),
]
UNLINKED_ZONE_COLS = ("o3.CO_TAZID AS oCO_TAZID_USTMv3, d3.CO_TAZID AS dCO_TAZID_USTMv3, "
                      "o4.CO_TAZID AS oCO_TAZID_USTMv4, d4.CO_TAZID AS dCO_TAZID_USTMv4, "
                      "TRY_CAST(round(d4.SUBAREAID) AS BIGINT) AS dSUBAREAID, "
                      "TRY_CAST(round(o4.SUBAREAID) AS BIGINT) AS oSUBAREAID")
UNLINKED_ZONE_JOINS = ("LEFT JOIN o3 ON t.trip_id = o3.trip_id LEFT JOIN d3 ON t.trip_id = d3.trip_id "
                       "LEFT JOIN o4 ON t.trip_id = o4.trip_id LEFT JOIN d4 ON t.trip_id = d4.trip_id")

LINKED_KEY = "SELECT sha256(concat(length(CAST(linked_trip_id AS VARCHAR)), ':', CAST(linked_trip_id AS VARCHAR))) AS unique_id, * FROM trip_linked_src"
LINKED_PICKS = [
    ("o3", _pick("tl", "unique_id", "o_lon", "o_lat", "taz_v3", ["CO_FIPS"])),
    ("d3", _pick("tl", "unique_id", "d_lon", "d_lat", "taz_v3", ["CO_FIPS"])),
    ("o4", _pick("tl", "unique_id", "o_lon", "o_lat", "taz_v4", ["SUBAREAID"])),
    ("d4", _pick("tl", "unique_id", "d_lon", "d_lat", "taz_v4", ["SUBAREAID"])),
]
LINKED_ZONE_COLS = ("CAST(round(o3.CO_TAZID) AS BIGINT) AS oCO_TAZID_USTMv3, "
                    "CAST(round(d3.CO_TAZID) AS BIGINT) AS dCO_TAZID_USTMv3, "
                    "CAST(round(o4.CO_TAZID) AS BIGINT) AS oCO_TAZID_USTMv4, "
                    "CAST(round(d4.CO_TAZID) AS BIGINT) AS dCO_TAZID_USTMv4, "
                    "CAST(round(o3.CO_FIPS) AS BIGINT) AS oCO_FIPS, CAST(round(d3.CO_FIPS) AS BIGINT) AS dCO_FIPS, "
                    "CAST(round(o4.SUBAREAID) AS BIGINT) AS oSUBAREAID, "
                    "CAST(round(d4.SUBAREAID) AS BIGINT) AS dSUBAREAID")
LINKED_ZONE_JOINS = ("LEFT JOIN o3 USING (unique_id) LEFT JOIN d3 USING (unique_id) "
                     "LEFT JOIN o4 USING (unique_id) LEFT JOIN d4 USING (unique_id)")

_KEYS = codes.TRIP_MATCH_KEYS
DEDUP_CTE = (f"SELECT * FROM core_trip QUALIFY row_number() OVER (PARTITION BY {', '.join(_KEYS)} "
             f"ORDER BY segment_type ASC NULLS LAST, trip_id ASC NULLS FIRST, "
             + ", ".join(f"{c} ASC NULLS FIRST" for c in codes.GUARDED_TRIP_ATTRS) + ") = 1")
_BAD = ("((tm = 'Drive-Alone' AND u.num_travelers <> 1) OR (tm = 'Shared-Ride 2' AND u.num_travelers <> 2) "
        "OR (tm = 'Shared-Ride 3+' AND u.num_travelers <= 2))")
GUARDED_COLS = ", ".join(f"CASE WHEN {_BAD} THEN NULL ELSE u.{c} END AS {c}" for c in codes.GUARDED_TRIP_ATTRS)
MATCH_ON = " AND ".join(f"l.{k} = u.{k}" for k in _KEYS)
MODE_T = simple_case("linked_trip_mode", codes.LINKED_MODE_LABELS)

ACTIVITY_WINDOW = ("WINDOW w AS (PARTITION BY person_id ORDER BY "
                   + ", ".join(f"{c} ASC NULLS FIRST" for c in [*codes.ACTIVITY_ORDER, *codes.ACTIVITY_TIEBREAK])
                   + ")")
LAG = "lag(arrive_hour * 60 + arrive_minute) OVER w"
ACTIV_DUR = (f"CASE WHEN (depart_hour * 60 + depart_minute) - {LAG} < 0 THEN -1 "
             f"ELSE coalesce((depart_hour * 60 + depart_minute) - {LAG}, 0) END")


def _build() -> dict[str, str]:
    q: dict[str, str] = {}

    q["scan_star_except"] = (_with(["core_day"])
                             + f"SELECT * EXCLUDE ({_excl(codes.DAY_DROP)}), day_weight_v2 AS day_weight_source "
                               "FROM core_day")
    q["segment_clean"] = (_with(["core_vehicle"])
                          + f"SELECT vehicle_id, segment_type, {seg_clean()} AS segment_type_cleaned FROM core_vehicle")
    q["weight_split"] = (_with(["core_day"])
                         + f"SELECT day_id, segment_type, {w_college('day_weight_v2')} AS day_weight_col_enrol, "
                           f"{w_other('day_weight_v2')} AS day_weight FROM core_day")
    q["drive_work_by_person"] = _with(["core_trip"]) + DRIVE_WORK_CTE
    q["person_trip_lookup"] = (_with(["core_trip", "core_person"], ("dw", DRIVE_WORK_CTE))
                               + "SELECT p.person_id, coalesce(dw.drive_work_trips, 0) AS drive_work_trips, "
                                 "CAST(coalesce(dw.drive_work_distance, 0) AS DOUBLE) AS drive_work_distance "
                                 "FROM core_person p LEFT JOIN dw ON p.person_id = dw.person_id")
    q["person_age_rules"] = _with(["core_person"]) + f"SELECT person_id, {PERSON_RULES} FROM core_person"

    q["hh_lifecycle"] = _with(["core_person"]) + LIFECYCLE_CTE
    q["hh_lifegroup_counts"] = _with(["core_person"]) + COUNTS_CTE
    q["hh_followon_flag"] = (_with(["core_hh", "followon_hh"])
                             + "SELECT a.hh_id, CASE WHEN b.hh_id IS NOT NULL THEN 1 ELSE 0 END AS completed_followon_hh "
                               "FROM core_hh a LEFT JOIN followon_hh b ON a.hh_id = b.hh_id")
    q["hh_day_flags"] = _with(["core_hh"]) + f"SELECT hh_id, {HH_DAY_FLAGS} FROM core_hh"
    q["hh_capped_sizes"] = (_with(["core_hh"])
                            + f"SELECT hh_id, {least_strict('num_people', 6)} AS hhsize_6cat, "
                              f"{least_strict('num_workers', 3)} AS workers_4cat, "
                              f"{least_strict('num_vehicles', 3)} AS num_vehicles_4cat, {AUTOSUF} AS autosuf_wk "
                              "FROM core_hh")
    q["hh_seasonal_checks"] = (_with(["core_hh"])
                               + f"SELECT hh_id, CASE WHEN {LON_EQ} THEN 1 ELSE 0 END AS tmp_seasonal_res_lon, "
                                 f"CASE WHEN {LAT_EQ} THEN 1 ELSE 0 END AS tmp_seasonal_res_lat, "
                                 f"CASE WHEN {LON_EQ} AND {LAT_EQ} THEN 1 ELSE 0 END AS chk_seasonal_res, "
                                 f"{SEASONAL} AS seasonal_res_cleaned, "
                                 f"{SEASONAL_REGION} AS seasonal_res_in_region_cleaned FROM core_hh")
    q["hh_residence_months"] = (_with(["core_hh"])
                                + f"SELECT hh_id, {RES_M0_CLEAN} AS residence_months_0_cleaned, "
                                  f"{NUM_MONTHS} AS num_months FROM core_hh")

    q["zone_within_home"] = (_with(["core_hh", *ZONES])
                             + "SELECT a.hh_id, z3.CO_TAZID AS hCO_TAZID_USTMv3, "
                               "CAST(round(z3.SUBAREAID) AS BIGINT) AS hSUBAREAID_USTMv3, "
                               "z4.CO_TAZID AS hCO_TAZID_USTMv4, CAST(round(z4.SUBAREAID) AS BIGINT) AS hSUBAREAID_USTMv4 "
                               f"FROM core_hh a LEFT JOIN taz_v3 z3 ON {within('a.home_lon', 'a.home_lat', 'z3')} "
                               f"LEFT JOIN taz_v4 z4 ON {within('a.home_lon', 'a.home_lat', 'z4')}")
    q["zone_wkt"] = (_with(["core_hh", *ZONES])
                     + "SELECT a.hh_id, z3.CO_TAZID AS hCO_TAZID_USTMv3, z4.CO_TAZID AS hCO_TAZID_USTMv4 "
                       f"FROM core_hh a LEFT JOIN taz_v3 z3 ON {within('a.home_lon', 'a.home_lat', 'z3')} "
                       f"LEFT JOIN taz_v4 z4 ON {within('a.home_lon', 'a.home_lat', 'z4')}")
    q["zone_repeated_ids"] = (
        _with(["core_trip", *ZONES], ("t", "SELECT trip_id, o_lon, o_lat, CASE WHEN trip_id % 11 <> 0 THEN CAST(floor(trip_id / 3) AS BIGINT) END AS id FROM core_trip"),
              ("best", f"SELECT t.id, min(z.CO_TAZID) AS zone, arg_min(z.CO_FIPS, z.CO_TAZID) AS fips FROM t JOIN taz_v3 z ON {intersects('t.o_lon', 't.o_lat', 'z')} GROUP BY t.id"))
        + "SELECT t.trip_id, t.id, best.zone, best.fips FROM t LEFT JOIN best ON best.id = t.id")
    wide, small = ("wide", _arcs("taz_v3", 10)), ("small", _arcs("taz_v4"))
    home = [(f"in_{arcs}", f"SELECT * FROM ({_geodesic_hits('core_hh', 'hh_id', 'home_lon', 'home_lat', arcs)}) WHERE inside AND NOT edge")
            for arcs in ("wide", "small")]
    q["zone_geodesic_within"] = (_with(["core_hh", *ZONES], wide, small, *home)
                                 + "SELECT a.hh_id, w.CO_TAZID AS wide_zone, s.CO_TAZID AS zone FROM core_hh a "
                                   "LEFT JOIN in_wide w ON w.hh_id = a.hh_id LEFT JOIN in_small s ON s.hh_id = a.hh_id")
    q["zone_antimeridian"] = (_with(["core_hh", *ZONES], wide, home[0])
                              + "SELECT a.hh_id, w.CO_TAZID AS wide_zone FROM core_hh a LEFT JOIN in_wide w ON w.hh_id = a.hh_id")
    ends = [(end, f"SELECT trip_id, min(CO_TAZID) AS zone, arg_min(CO_FIPS, CO_TAZID) AS fips FROM ("
                  f"{_geodesic_hits('core_trip', 'trip_id', f'{end}_lon', f'{end}_lat', 'wide')}) WHERE inside OR edge GROUP BY trip_id") for end in "od"]
    q["zone_geodesic_intersects"] = (_with(["core_trip", *ZONES], wide, *ends)
                                     + "SELECT t.trip_id, o.zone AS o_zone, o.fips AS o_fips, d.zone AS d_zone FROM core_trip t "
                                       "LEFT JOIN o ON o.trip_id = t.trip_id LEFT JOIN d ON d.trip_id = t.trip_id")
    zone_unl = _with(["core_trip", *ZONES], *UNLINKED_PICKS)
    q["zone_intersects_origin"] = (zone_unl + "SELECT t.trip_id, o3.CO_TAZID AS oCO_TAZID_USTMv3, "
                                   "o4.CO_TAZID AS oCO_TAZID_USTMv4, TRY_CAST(round(o4.SUBAREAID) AS BIGINT) AS oSUBAREAID "
                                   "FROM core_trip t LEFT JOIN o3 ON t.trip_id = o3.trip_id "
                                   "LEFT JOIN o4 ON t.trip_id = o4.trip_id")
    q["zone_intersects_dest"] = (zone_unl + "SELECT t.trip_id, d3.CO_TAZID AS dCO_TAZID_USTMv3, "
                                 "d4.CO_TAZID AS dCO_TAZID_USTMv4, TRY_CAST(round(d4.SUBAREAID) AS BIGINT) AS dSUBAREAID "
                                 "FROM core_trip t LEFT JOIN d3 ON t.trip_id = d3.trip_id "
                                 "LEFT JOIN d4 ON t.trip_id = d4.trip_id")
    q["zone_using_join"] = (_with(["trip_linked_src", *ZONES], ("tl", LINKED_KEY), *LINKED_PICKS)
                            + f"SELECT unique_id, {LINKED_ZONE_COLS} FROM tl {LINKED_ZONE_JOINS}")

    q["purpose_3cat_linked"] = (_with(["trip_linked_src"])
                                + f"SELECT linked_trip_id, {cat3_linked('o_purpose_category')} AS o_purpose_category3, "
                                  f"{cat3_linked('d_purpose_category')} AS d_purpose_category3 FROM trip_linked_src")
    q["purpose_3cat_unlinked"] = (_with(["core_trip"])
                                  + f"SELECT trip_id, {cat3_unlinked('o_purpose_category')} AS o_purpose_3cat, "
                                    f"{cat3_unlinked('d_purpose_category')} AS d_purpose_3cat FROM core_trip")
    q["purpose_labels"] = (_with(["trip_linked_src"])
                           + f"SELECT linked_trip_id, "
                             f"{simple_case('o_purpose_category', codes.PURPOSE_TYPE_LABELS)} AS o_purpose_type, "
                             f"{simple_case('d_purpose_category', codes.PURPOSE_TYPE_LABELS)} AS d_purpose_type "
                             "FROM trip_linked_src")
    q["mode_labels"] = (_with(["trip_linked_src"])
                        + f"SELECT linked_trip_id, {MODE_T} AS linked_trip_mode_t FROM trip_linked_src")
    q["direction_linked"] = (_with(["trip_linked_src"])
                             + f"SELECT linked_trip_id, "
                               f"{direction_linked(cat3_linked('o_purpose_category'), cat3_linked('d_purpose_category'))}"
                               " AS PA_AP FROM trip_linked_src")
    q["direction_unlinked"] = _with(["core_trip"]) + f"SELECT trip_id, {direction_unlinked()} AS PA_AP FROM core_trip"
    q["period_and_clock"] = (_with(["core_trip"])
                             + f"SELECT trip_id, {period('depart_hour')} AS depart_per, "
                               f"{period('arrive_hour')} AS arrive_per, "
                               f"{hhm('depart_hour', 'depart_minute')} AS depart_hhm, "
                               f"{mam('depart_hour', 'depart_minute')} AS depart_mam, "
                               f"{hhm('arrive_hour', 'arrive_minute')} AS arrive_hhm, "
                               f"{mam('arrive_hour', 'arrive_minute')} AS arrive_mam FROM core_trip")
    q["int_distance_mode_auto"] = (_with(["core_trip"])
                                   + f"SELECT trip_id, {INT_DIST} AS INT_Dist, {MODE_AUTO} AS mode_auto FROM core_trip")
    q["purpose7_chain"] = (_with(["core_trip", "core_person"],
                                 ("tb", "SELECT t.*, p.school_type FROM core_trip t "
                                        "LEFT JOIN core_person p ON t.person_id = p.person_id"),
                                 ("tp", f"SELECT *, {PURP7} AS PURP7 FROM tb"))
                           + f"SELECT trip_id, PURP7, {PURP7_T} AS PURP7_t, {TRIP_PUR_T} AS trip_pur_t, "
                             f"{HBSCH_UNLINKED} AS HBSch_lev, {PURP_PER} AS PURP_PER FROM tp")
    q["purpose5_peak_linked"] = (_with(["trip_linked_src"],
                                       ("t", f"SELECT *, {PURP7_T_LINKED} AS PURP7_t, "
                                             f"{period('depart_hour')} AS depart_per FROM trip_linked_src"))
                                 + f"SELECT linked_trip_id, PURP7_t, {PURP5_T} AS PURP5_t, {PK_OK} AS PK_OK, "
                                   f"{HBSCH_LINKED} AS HBSch_lev FROM t")

    q["trip_dedup_first"] = (_with(["core_trip"], ("dd", DEDUP_CTE))
                             + f"SELECT trip_id, {', '.join(_KEYS)}, segment_type FROM dd")
    q["activity_gap"] = (_with(["core_trip"])
                         + f"SELECT trip_id, {LAG} AS lag_arrive_mam, {ACTIV_DUR} AS activ_dur FROM core_trip "
                           + ACTIVITY_WINDOW)
    linked_unlinked = _with(["trip_linked_src", "core_trip"], ("dd", DEDUP_CTE),
                            ("lu", f"SELECT l.linked_trip_id, l.linked_trip_mode, {GUARDED_COLS} FROM "
                                   f"(SELECT *, {MODE_T} AS tm FROM trip_linked_src) l "
                                   f"LEFT JOIN dd u ON {MATCH_ON}"))
    q["composite_trip_join"] = linked_unlinked + (
        f"SELECT linked_trip_id, {', '.join(codes.GUARDED_TRIP_ATTRS)} FROM lu")
    q["model_mode"] = linked_unlinked + (
        f"SELECT linked_trip_id, linked_trip_mode, num_travelers, {MODEL_MODE} AS model_trip_mode_WFv10 FROM lu")
    q["pa_swap"] = (_with(["core_trip", *ZONES], *UNLINKED_PICKS,
                          ("z", f"SELECT t.*, {UNLINKED_ZONE_COLS}, {direction_unlinked('t.')} AS PA_AP "
                                f"FROM core_trip t {UNLINKED_ZONE_JOINS}"))
                    + "SELECT trip_id, PA_AP, "
                    + ", ".join([pa("oCO_TAZID_USTMv3", "dCO_TAZID_USTMv3", "pCO_TAZID_USTMv3", "aCO_TAZID_USTMv3"),
                                 pa("oCO_TAZID_USTMv4", "dCO_TAZID_USTMv4", "pCO_TAZID_USTMv4", "aCO_TAZID_USTMv4"),
                                 pa("oSUBAREAID", "dSUBAREAID", "pSUBAREAID", "aSUBAREAID"),
                                 pa("o_bg_2020", "d_bg_2020", "p_bg_2020", "a_bg_2020")])
                    + " FROM z")

    q["surrogate_key"] = (_with(["trip_linked_src"])
                          + "SELECT count(*) AS n_rows, count(*) AS n_distinct, CAST(36 AS INTEGER) AS min_len, "
                            "CAST(36 AS INTEGER) AS max_len FROM trip_linked_src")
    q["surrogate_key_hash"] = (_with(["trip_linked_src"])
                               + "SELECT sha256(concat(length(CAST(linked_trip_id AS VARCHAR)), ':', CAST(linked_trip_id AS VARCHAR))) AS unique_id, linked_trip_id "
                                 "FROM trip_linked_src")

    # ------------------------------------------------------------ whole tables
    q["day"] = (_with(["core_day"])
                + f"SELECT * EXCLUDE ({_excl(codes.DAY_DROP)}), {seg_clean()} AS segment_type_cleaned, "
                  f"{w_college('day_weight_v2')} AS day_weight_col_enrol, {w_other('day_weight_v2')} AS day_weight "
                  "FROM core_day")
    q["vehicle"] = (_with(["core_vehicle"])
                    + f"SELECT * EXCLUDE ({_excl(codes.VEHICLE_DROP)}), {seg_clean()} AS segment_type_cleaned "
                      "FROM core_vehicle")
    q["person"] = (_with(["core_person", "core_trip"], ("dw", DRIVE_WORK_CTE))
                   + f"SELECT p.* EXCLUDE ({_excl(codes.PERSON_DROP)}), {seg_clean('p.segment_type')} "
                     f"AS segment_type_cleaned, {PERSON_RULES}, "
                     "coalesce(dw.drive_work_trips, 0) AS drive_work_trips, "
                     "CAST(coalesce(dw.drive_work_distance, 0) AS DOUBLE) AS drive_work_distance, "
                     f"{w_college('p.person_weight_v2', 'p.segment_type')} AS person_weight_col_enrol, "
                     f"{w_other('p.person_weight_v2', 'p.segment_type')} AS person_weight "
                     "FROM core_person p LEFT JOIN dw ON p.person_id = dw.person_id")
    q["hh"] = (_with(["core_hh", "core_person", "followon_hh", *ZONES], ("lc", LIFECYCLE_CTE), ("cnt", COUNTS_CTE))
               + f"SELECT a.* EXCLUDE ({_excl(codes.HH_DROP)}), "
                 "CASE WHEN b.hh_id IS NOT NULL THEN 1 ELSE 0 END AS completed_followon_hh, "
                 f"{HH_DAY_FLAGS}, "
                 f"CASE WHEN {LON_EQ} THEN 1 ELSE 0 END AS tmp_seasonal_res_lon, "
                 f"CASE WHEN {LAT_EQ} THEN 1 ELSE 0 END AS tmp_seasonal_res_lat, "
                 f"CASE WHEN {LON_EQ} AND {LAT_EQ} THEN 1 ELSE 0 END AS chk_seasonal_res, "
                 f"{seg_clean('a.segment_type')} AS segment_type_cleaned, "
                 f"{SEASONAL} AS seasonal_res_cleaned, {SEASONAL_REGION} AS seasonal_res_in_region_cleaned, "
                 f"{RES_M0_CLEAN} AS residence_months_0_cleaned, "
                 f"{least_strict('num_people', 6)} AS hhsize_6cat, {least_strict('num_workers', 3)} AS workers_4cat, "
                 f"{NUM_MONTHS} AS num_months, {least_strict('num_vehicles', 3)} AS num_vehicles_4cat, "
                 f"{AUTOSUF} AS autosuf_wk, lc.lifecycle, cnt.hh_children, cnt.hh_adults, cnt.hh_seniors, "
                 f"{w_college('a.hh_weight_v2', 'a.segment_type')} AS hh_weight_col_enrol, "
                 f"{w_other('a.hh_weight_v2', 'a.segment_type')} AS hh_weight, "
                 "z3.CO_TAZID AS hCO_TAZID_USTMv3, CAST(round(z3.SUBAREAID) AS BIGINT) AS hSUBAREAID_USTMv3, "
                 "z4.CO_TAZID AS hCO_TAZID_USTMv4, CAST(round(z4.SUBAREAID) AS BIGINT) AS hSUBAREAID_USTMv4 "
                 "FROM core_hh a LEFT JOIN followon_hh b ON a.hh_id = b.hh_id "
                 "LEFT JOIN lc ON a.hh_id = lc.hh_id LEFT JOIN cnt ON a.hh_id = cnt.hh_id "
                 f"LEFT JOIN taz_v3 z3 ON {within('a.home_lon', 'a.home_lat', 'z3')} "
                 f"LEFT JOIN taz_v4 z4 ON {within('a.home_lon', 'a.home_lat', 'z4')}")
    q["trip_unlinked"] = (
        _with(["core_trip", "core_person", *ZONES], *UNLINKED_PICKS,
              ("tb", f"SELECT t.*, p.school_type, {UNLINKED_ZONE_COLS} FROM core_trip t "
                     f"LEFT JOIN core_person p ON t.person_id = p.person_id {UNLINKED_ZONE_JOINS}"),
              ("tp", f"SELECT *, {direction_unlinked()} AS PA_AP, {PURP7} AS PURP7 FROM tb"))
        + f"SELECT * EXCLUDE ({_excl(codes.TRIP_UNLINKED_DROP)}), "
          f"{seg_clean()} AS segment_type_cleaned, "
          f"{cat3_unlinked('o_purpose_category')} AS o_purpose_3cat, "
          f"{cat3_unlinked('d_purpose_category')} AS d_purpose_3cat, "
          f"{period('depart_hour')} AS depart_per, "
          f"{hhm('depart_hour', 'depart_minute')} AS depart_hhm, {mam('depart_hour', 'depart_minute')} AS depart_mam, "
          f"{hhm('arrive_hour', 'arrive_minute')} AS arrive_hhm, {mam('arrive_hour', 'arrive_minute')} AS arrive_mam, "
          f"{INT_DIST} AS INT_Dist, {MODE_AUTO} AS mode_auto, "
          f"{w_college('trip_weight_v2')} AS trip_weight_col_enrol, {w_other('trip_weight_v2')} AS trip_weight, "
          f"{LAG} AS lag_arrive_mam, {ACTIV_DUR} AS activ_dur, "
          f"{PURP7_T} AS PURP7_t, {TRIP_PUR_T} AS trip_pur_t, {HBSCH_UNLINKED} AS HBSch_lev, {PURP_PER} AS PURP_PER, "
          + ", ".join([pa("oCO_TAZID_USTMv3", "dCO_TAZID_USTMv3", "pCO_TAZID_USTMv3", "aCO_TAZID_USTMv3"),
                       pa("oCO_TAZID_USTMv4", "dCO_TAZID_USTMv4", "pCO_TAZID_USTMv4", "aCO_TAZID_USTMv4"),
                       pa("oSUBAREAID", "dSUBAREAID", "pSUBAREAID", "aSUBAREAID"),
                       pa("o_bg_2020", "d_bg_2020", "p_bg_2020", "a_bg_2020")])
        + " FROM tp " + ACTIVITY_WINDOW)

    o3, d3 = cat3_linked("o_purpose_category"), cat3_linked("d_purpose_category")
    q["trip_linked"] = (
        _with(["trip_linked_src", "core_trip", *ZONES], ("tl", LINKED_KEY), *LINKED_PICKS, ("dd", DEDUP_CTE),
              ("t1", f"SELECT tl.* EXCLUDE ({_excl(codes.TRIP_LINKED_DROP)}), {LINKED_ZONE_COLS}, "
                     f"tl.trip_weight_new AS trip_weight FROM tl {LINKED_ZONE_JOINS}"),
              ("t2", f"SELECT *, {o3} AS o_purpose_category3, {d3} AS d_purpose_category3, "
                     f"{simple_case('o_purpose_category', codes.PURPOSE_TYPE_LABELS)} AS o_purpose_type, "
                     f"{simple_case('d_purpose_category', codes.PURPOSE_TYPE_LABELS)} AS d_purpose_type, "
                     f"{MODE_T} AS linked_trip_mode_t, {direction_linked(o3, d3)} AS PA_AP, "
                     f"{period('depart_hour')} AS depart_per, {period('arrive_hour')} AS arrive_per, "
                     f"{hhm('depart_hour', 'depart_minute')} AS depart_hhm, "
                     f"{mam('depart_hour', 'depart_minute')} AS depart_mam, "
                     f"{hhm('arrive_hour', 'arrive_minute')} AS arrive_hhm, "
                     f"{mam('arrive_hour', 'arrive_minute')} AS arrive_mam, "
                     f"{PURP7_T_LINKED} AS PURP7_t, depart_seconds AS depart_second, "
                     f"{HBSCH_LINKED} AS HBSch_lev FROM t1"),
              ("t3", f"SELECT l.*, {GUARDED_COLS.replace('tm =', 'l.linked_trip_mode_t =')} "
                     f"FROM t2 l LEFT JOIN dd u ON {MATCH_ON}"),
              ("t4", "SELECT *, "
                     + ", ".join([pa("oCO_TAZID_USTMv3", "dCO_TAZID_USTMv3", "pCO_TAZID_USTMv3", "aCO_TAZID_USTMv3"),
                                  pa("oCO_TAZID_USTMv4", "dCO_TAZID_USTMv4", "pCO_TAZID_USTMv4", "aCO_TAZID_USTMv4"),
                                  pa("oCO_FIPS", "dCO_FIPS", "pCO_FIPS", "aCO_FIPS"),
                                  pa("oSUBAREAID", "dSUBAREAID", "pSUBAREAID", "aSUBAREAID")])
                     + f", {MODEL_MODE} AS model_trip_mode_WFv10, {PURP5_T} AS PURP5_t, {PK_OK} AS PK_OK FROM t3"))
        + f"SELECT {', '.join(codes.TRIP_LINKED_COLS)} FROM t4")
    return q


ORACLE_SQL = _build()
