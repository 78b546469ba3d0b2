"""Survey recode rules as Column functions.

Every function takes column names or Columns and returns a Column (or a
tuple of Columns), so builders compose them inside one ``select``.  All of
them are plain Catalyst expressions: no Python runs per row.

Where the linked and unlinked trip tables define the "same" concept with
different rules, both variants exist (``*_linked`` / ``*_unlinked``).

FIXED VALUES: the code numbers and labels inside the rules below (purposes,
school types, age bands, 995 and the like) are the survey's definitions, like
the lists in ``codes``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import codes
from .columns import code_label, col, greatest_strict, least_strict

COLLEGE = codes.SEGMENT_COLLEGE


# ---------------------------------------------------------------- segments & weights
def segment_cleaned(seg="segment_type") -> Column:
    """C1: 'Supplemental' -> 'CBS', everything else (NULL too) unchanged."""
    seg = col(seg)
    return F.when(seg == codes.SEGMENT_SUPPLEMENTAL, F.lit(codes.SEGMENT_SUPPLEMENTAL_CLEAN)).otherwise(seg)


def weight_split(seg, weight) -> tuple[Column, Column]:
    """(college weight, non-college weight); a NULL segment counts as non-college."""
    seg, weight = col(seg), col(weight)
    college = F.when(seg == COLLEGE, weight)
    other = F.when((seg != COLLEGE) | seg.isNull(), weight)
    return college, other


# ---------------------------------------------------------------- persons
def _age_band(age: Column, guard: Column | None) -> Column:
    def g(c):
        return c if guard is None else guard & c
    return (F.when(g(age <= 3), F.lit("child"))
            .when(g(age <= 8), F.lit("adult"))
            .when(g(age <= 11), F.lit("senior")))


def lifegroup_person(seg="segment_type", age="age") -> Column:
    """child/adult/senior for non-college persons; NULL segment gives NULL."""
    return _age_band(col(age), col(seg) != COLLEGE)


def lifegroup(age="age") -> Column:
    """child/adult/senior bands without a segment test (household prep)."""
    return _age_band(col(age), None)


def age_3cat(seg="segment_type", age="age") -> Column:
    """C4: 1 for 0-3, 2 for 4-8, 3 for 9 and over (open ended), non-college only."""
    seg, age = col(seg), col(age)
    nc = seg != COLLEGE
    return (F.when(nc & age.between(0, 3), 1)
            .when(nc & age.between(4, 8), 2)
            .when(nc & (age >= 9), 3))


def jobs_by_age(age="age", jobs="num_jobs") -> tuple[Column, Column, Column]:
    """(adultJobs, seniorJobs, childJobs); outside the band 0, NULL age 0."""
    age, jobs = col(age), col(jobs)
    return (F.when(age.between(4, 8), jobs).otherwise(0),
            F.when(age >= 9, jobs).otherwise(0),
            F.when(age <= 3, jobs).otherwise(0))


def made_trips(num_trips="num_trips") -> Column:
    """1 if the person reported any trip, else 0 (NULL -> 0)."""
    return F.when(col(num_trips) > 0, 1).otherwise(0)


# ---------------------------------------------------------------- households
def has_any_complete(*day_cols) -> Column:
    """1 if any listed day is complete; NULL if any of them is NULL."""
    return greatest_strict(*day_cols)


def capped(c, cap: int) -> Column:
    """LEAST(c, cap) with NULL kept."""
    return least_strict(col(c), F.lit(cap))


def same_rounded(a, b, digits: int = 1) -> Column:
    """Boolean: both values equal after rounding (NULL if either is NULL)."""
    return F.round(col(a), digits) == F.round(col(b), digits)


def flag(cond: Column) -> Column:
    """1 when ``cond`` is true, else 0 (NULL -> 0)."""
    return F.when(cond, 1).otherwise(0)


def seasonal_res_cleaned(res="seasonal_res", region="seasonal_res_in_region",
                         home_lon="home_lon", home_lat="home_lat",
                         s_lon="seasonal_res_lon", s_lat="seasonal_res_lat") -> Column:
    """Seasonal residence code corrected by region answer and location match."""
    res, region = col(res), col(region)
    lat_eq = same_rounded(home_lat, s_lat)
    lon_eq = same_rounded(home_lon, s_lon)
    lat_ne = F.round(col(home_lat), 1) != F.round(col(s_lat), 1)
    lon_ne = F.round(col(home_lon), 1) != F.round(col(s_lon), 1)
    in_region = region == 1
    return (F.when((region == 0) & res.isin(0, 1), 2)
            .when(in_region & (res == 0) & lat_eq & lon_eq, 1)
            .when(in_region & (res == 0), 2)
            .when(in_region & (res == 1) & (lat_ne | lon_ne), 2)
            .when(in_region & (res == 2) & lat_eq & lon_eq, 1)
            .otherwise(res))


def seasonal_res_in_region_cleaned(res="seasonal_res", region="seasonal_res_in_region") -> Column:
    """Region 995 for a seasonal residence (2) becomes 0."""
    res, region = col(res), col(region)
    return F.when((res == 2) & (region == 995), 0).otherwise(region)


def _months(prefix: str) -> Column:
    return F.array(*[F.col(f"{prefix}{i}") for i in range(1, 13)])


def _count_where(arr: Column, pred) -> Column:
    # NULL elements make the predicate NULL and are filtered out, as in SQL WHERE.
    return F.size(F.filter(arr, pred))


def residence_months_0_cleaned(prefix: str = "residence_months_") -> Column:
    """C14: 995 if any month is 995; 1 if months_0 = 0 and no month differs from 1."""
    m0 = F.col(f"{prefix}0")
    months = _months(prefix)
    return (F.when(_count_where(months, lambda x: x == 995) > 0, F.lit(995).cast("bigint"))
            .when((m0 == 0) & (_count_where(months, lambda x: x != 1) == 0), F.lit(1).cast("bigint"))
            .otherwise(m0))


def num_months(prefix: str = "residence_months_") -> Column:
    """995 if months_0 is 995, else the number of months answered 0 or 1."""
    m0 = F.col(f"{prefix}0")
    months = _months(prefix)
    return (F.when(m0 == 995, F.lit(995))
            .otherwise(_count_where(months, lambda x: x.isin(0, 1)))).cast("bigint")


def autosuf_wk(veh="num_vehicles", workers="num_workers") -> Column:
    """Vehicle sufficiency relative to workers."""
    veh, workers = col(veh), col(workers)
    return (F.when(veh >= workers, F.lit("Sufficient"))
            .when((veh > 0) & (veh < workers), F.lit("Insufficient"))
            .when(veh == 0, F.lit("No Vehicles")))


def lifecycle(has_child, has_adult, has_senior) -> Column:
    """C17: 1 adults only; 2 adults + children, no seniors; 3 everything else."""
    c, a, s = col(has_child), col(has_adult), col(has_senior)
    return (F.when((a == 1) & (c == 0) & (s == 0), 1)
            .when((a == 1) & (c == 1) & (s == 0), 2)
            .otherwise(3))


# ---------------------------------------------------------------- trip purposes
def purpose_3cat_linked(cat) -> Column:
    """Home / Work (2,3) / Undefined (995,-1) / Other (NULL too)."""
    cat = col(cat)
    return (F.when(cat == 1, F.lit("Home"))
            .when(cat.isin(2, 3), F.lit("Work"))
            .when(cat.isin(995, -1), F.lit("Undefined"))
            .otherwise(F.lit("Other")))


def purpose_3cat_unlinked(cat) -> Column:
    """As C19a but only code 2 is Work."""
    cat = col(cat)
    return (F.when(cat == 1, F.lit("Home"))
            .when(cat == 2, F.lit("Work"))
            .when(cat.isin(995, -1), F.lit("Undefined"))
            .otherwise(F.lit("Other")))


def purpose_type_label(cat) -> Column:
    """C20: purpose category code -> label; unknown codes NULL."""
    return code_label(cat, codes.PURPOSE_TYPE_LABELS)


def linked_mode_label(mode="linked_trip_mode") -> Column:
    """Linked trip mode code -> label; unknown codes NULL."""
    return code_label(mode, codes.LINKED_MODE_LABELS)


def direction_linked(o3, d3) -> Column:
    """production/attraction direction from the two 3-category purposes."""
    o3, d3 = col(o3), col(d3)
    return (F.when(o3 == "Home", F.lit("PA"))
            .when(d3 == "Home", F.lit("AP"))
            .when((o3 == "Work") & (d3 == "Other"), F.lit("PA"))
            .when((o3 == "Other") & (d3 == "Work"), F.lit("AP"))
            .when((o3 == "Undefined") | (d3 == "Undefined"), F.lit("Undefined"))
            .otherwise(F.lit("PA")))


def direction_unlinked(o_cat="o_purpose_category", d_cat="d_purpose_category",
                       o_type="o_purpose_type", d_type="d_purpose_type") -> Column:
    """As C22a on the unlinked categories; 'Undefined' comes from the purpose types."""
    o_cat, d_cat = col(o_cat), col(d_cat)
    o3, d3 = purpose_3cat_unlinked(o_cat), purpose_3cat_unlinked(d_cat)
    return (F.when(o_cat == 1, F.lit("PA"))
            .when(d_cat == 1, F.lit("AP"))
            .when((o_cat == 2) & (d3 == "Other"), F.lit("PA"))
            .when((o3 == "Other") & (d_cat == 2), F.lit("AP"))
            .when((col(o_type) == 995) | (col(d_type) == 995), F.lit("Undefined"))
            .otherwise(F.lit("PA")))


def period(hour) -> Column:
    """AM / MD / PM by hour, everything else (NULL too) EV."""
    hour = col(hour)
    out = None
    for label, lo, hi in codes.PERIODS:
        cond = hour.between(lo, hi)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit(codes.PERIOD_OTHER))


def period_number(hour) -> Column:
    """1..3 for AM/MD/PM, 4 otherwise."""
    hour = col(hour)
    out = None
    for n, (_, lo, hi) in enumerate(codes.PERIODS, start=1):
        cond = hour.between(lo, hi)
        out = F.when(cond, n) if out is None else out.when(cond, n)
    return out.otherwise(4)


def int_distance(miles="distance_miles") -> Column:
    """Floor of the distance, missing distance 0."""
    return F.floor(F.coalesce(col(miles), F.lit(0.0))).cast("bigint")


def mode_auto(mode="mode_type_broad", n="num_travelers") -> Column:
    """Auto mode 3 split by occupancy 3.1/3.2/3.3, other modes as doubles."""
    mode, n = col(mode), col(n)
    auto = mode == 3
    return (F.when(auto & (n == 1), F.lit(3.1))
            .when(auto & (n == 2), F.lit(3.2))
            .when(auto & (n >= 3), F.lit(3.3))
            .otherwise(mode.cast("double")))


def purp7_school(trip_type="trip_type", o_purpose="o_purpose", d_purpose="d_purpose",
                 school_type="school_type") -> Column:
    """School purpose split (college 7, K-12 2, other 4) for trip_type 2."""
    tt, o, d, st = col(trip_type), col(o_purpose), col(d_purpose), col(school_type)
    school = tt == 2
    either_60 = (o == 60) | (d == 60)
    return (F.when(school & ((o == 22) | (d == 22)), 7)
            .when(school & ((o == 21) | (d == 21)), 2)
            .when(school & (o.isin(23, 24, 25, 26) | d.isin(23, 24, 25, 26)), 4)
            .when(school & either_60 & st.isin(11, 12, 13), 7)
            .when(school & either_60 & st.isin(5, 6, 7), 2)
            .when(school, 4))


def purp7(trip_type="trip_type", school_purp: Column | None = None) -> Column:
    """Seven-purpose code from trip_type (school trips via C27)."""
    tt = col(trip_type)
    sp = purp7_school() if school_purp is None else school_purp
    return (F.when(tt == 1, 1)
            .when((tt == 2) & (sp == 2), 2)
            .when((tt == 2) & (sp == 4), 4)
            .when((tt == 2) & (sp == 7), 7)
            .when(tt == 3, 3)
            .when(tt == 4, 4)
            .when(tt == 5, 4)
            .when(tt == 6, 5)
            .when(tt == 7, 6)
            .when(tt == 995, 995)
            .otherwise(10))


def purp7_text(p7="PURP7") -> Column:
    """PURP7 -> text, unknown codes 'HBOth'."""
    return code_label(p7, codes.PURP7_LABELS, codes.PURP7_DEFAULT)


def trip_purpose_text(p7="PURP7", trip_type="trip_type") -> Column:
    """As C29 but purpose 4 with trip_type 4 is 'HBPb'."""
    p7, tt = col(p7), col(trip_type)
    return (F.when((p7 == 4) & (tt == 4), F.lit("HBPb"))
            .when((p7 == 4) & (tt != 4), F.lit("HBOth"))
            .otherwise(purp7_text(p7)))


def school_level_unlinked(p7="PURP7", school_type="school_type") -> Column:
    """School trips: 5 primary, 6/7 secondary, anything else (NULL too) undefined."""
    p7, st = col(p7), col(school_type)
    school = p7 == 2
    return (F.when(school & (st == 5), F.lit("primary"))
            .when(school & st.isin(6, 7), F.lit("secondary"))
            .when(school, F.lit("undefined")))


def school_level_linked(purpose="Model_Purpose", school_type="school_type") -> Column:
    """As C31a on 'HBSch', but a NULL school type stays NULL."""
    p, st = col(purpose), col(school_type)
    school = p == "HBSch"
    return (F.when(school & (st == 5), F.lit("primary"))
            .when(school & st.isin(6, 7), F.lit("secondary"))
            .when(school & ~st.isin(5, 6, 7), F.lit("undefined")))


def purpose_period(p7="PURP7", hour="depart_hour") -> Column:
    """Purpose x period code; 995 kept."""
    p7 = col(p7)
    return F.when(p7 == 995, 995).otherwise(p7 + (period_number(hour) - 1) * 7)


def purp7_text_linked(purpose="Model_Purpose") -> Column:
    """Model purpose with 'HBO' renamed to 'HBOth'."""
    p = col(purpose)
    return F.when(p == "HBO", F.lit("HBOth")).otherwise(p)


def purp5_text(p7t="PURP7_t") -> Column:
    """Seven purposes into five groups; unknown NULL."""
    return code_label(p7t, codes.PURP5_GROUPS)


def peak_offpeak(per="depart_per") -> Column:
    """AM/PM -> 'PK', MD/EV -> 'OK'."""
    per = col(per)
    return F.when(per.isin("AM", "PM"), F.lit("PK")).when(per.isin("MD", "EV"), F.lit("OK"))


def production_attraction(pa, o, d) -> tuple[Column, Column]:
    """(production, attraction) from origin/destination by direction."""
    pa, o, d = col(pa), col(o), col(d)
    return (F.when(pa == "PA", o).when(pa == "AP", d),
            F.when(pa == "PA", d).when(pa == "AP", o))


def occupancy_mismatch(mode_t, n) -> Column:
    """The reported mode contradicts the matched trip's traveller count.

    NULL count -> NULL condition -> not a mismatch, so the attributes are kept.
    """
    mode_t, n = col(mode_t), col(n)
    return (((mode_t == "Drive-Alone") & (n != 1))
            | ((mode_t == "Shared-Ride 2") & (n != 2))
            | ((mode_t == "Shared-Ride 3+") & (n <= 2)))


def model_mode(mode="linked_trip_mode", n="num_travelers") -> Column:
    """Model mode; taxi/TNC and unknown modes use the traveller count."""
    mode = col(mode)
    n = col(n).try_cast("bigint")
    out = None
    for code, label in codes.MODEL_MODE_FIXED.items():
        out = F.when(mode == code, F.lit(label)) if out is None else out.when(mode == code, F.lit(label))
    taxi = F.when(n >= 2, F.lit("auto-occ3p")).otherwise(F.lit("auto-occ2"))
    other = (F.when(n == 2, F.lit("auto-occ2"))
             .when(n >= 3, F.lit("auto-occ3p"))
             .otherwise(F.lit("auto-sov")))
    return (out.when(mode.isin(*codes.MODEL_MODE_TAXI_TNC), taxi)
            .when(mode.isin(*codes.MODEL_MODE_OCCUPANCY_KNOWN), other))
