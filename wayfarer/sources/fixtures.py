"""Survey-shaped input relations derived from the star-schema test tables.

Each relation is a list of ``(column, type, sql_expression)`` over a FROM
clause of the star tables (see FIXTURES.md).  The expressions use only
syntax shared by Spark SQL and DuckDB, so the same text builds the Spark
DataFrame (``load``) and the DuckDB oracle CTE (``relation_sql``).

At production scale these relations are real tables; ``load`` is only the
test-data adapter.  Catalyst prunes every column a query does not use, so a
builder that needs three columns reads three parquet columns.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codes


@dataclass(frozen=True)
class Relation:
    name: str
    base: str                       # driving star table
    columns: tuple                  # ((name, type, expr), ...)
    join: tuple | None = None       # (other_table, left_key, right_key)
    where: str | None = None
    spread: bool = False            # fact table: spread rows over all cores after the scan


def _seg(key: str) -> str:
    return (f"CASE {key} % 5 WHEN 0 THEN 'College' WHEN 1 THEN 'Supplemental' "
            f"WHEN 2 THEN NULL WHEN 3 THEN 'Core' WHEN 4 THEN 'Core' END")


def _nulls(names, typ="double"):
    return [(n, typ, "NULL") for n in names]


def _purpose_category(expr: str) -> str:
    whens = " ".join(f"WHEN {i} THEN {i}" for i in range(1, 14))
    return f"CASE {expr} % 16 WHEN 0 THEN NULL {whens} WHEN 14 THEN 995 WHEN 15 THEN -1 END"


# ---------------------------------------------------------------- core_hh
# Points lie in the first square degree for one half of the rows each way, and
# all over ten by ten degrees for the other, so every zone of any scale is hit.
def _wide(key: str) -> str:
    return f"CASE WHEN {key} % 2 = 0 THEN 10 ELSE 1 END"


_HOME_LON = f"(-112 + CAST((c_custkey * 7919) % 10007 AS double) / 10007 * {_wide('CAST(floor(c_custkey / 2) AS bigint)')})"
_HOME_LAT = f"(40 + CAST((c_custkey * 104729) % 10009 AS double) / 10009 * {_wide('c_custkey')})"

_DAYS = ["mon", "tue", "wed", "thu", "fri", "sat", "sun"]

_CORE_HH = (
    [
        ("hh_id", "bigint", "c_custkey"),
        ("Unnamed__0", "bigint", "c_custkey"),
        ("segment_type", "string", _seg("c_custkey")),
        ("num_people", "bigint", "1 + c_custkey % 8"),
        ("num_workers", "bigint", "c_custkey % 5"),
        ("num_vehicles", "bigint", "CASE WHEN c_custkey % 53 = 0 THEN NULL ELSE (c_custkey * 7) % 6 END"),
    ]
    + [
        (f"num_complete_{d}", "bigint",
         f"CASE WHEN c_custkey % 37 = {i} THEN NULL ELSE CAST(floor(c_custkey / {2 ** i}) AS bigint) % 2 END")
        for i, d in enumerate(_DAYS)
    ]
    + [
        ("home_lon", "double", _HOME_LON),
        ("home_lat", "double", _HOME_LAT),
        ("seasonal_res_lon", "double",
         f"{_HOME_LON} + CASE c_custkey % 3 WHEN 0 THEN 0 WHEN 1 THEN 0.25e0 WHEN 2 THEN NULL END"),
        ("seasonal_res_lat", "double",
         f"{_HOME_LAT} + CASE c_custkey % 2 WHEN 0 THEN 0 WHEN 1 THEN 0.25e0 END"),
        ("seasonal_res", "bigint",
         "CASE CAST(floor(c_custkey / 6) AS bigint) % 4 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 995 END"),
        ("seasonal_res_in_region", "bigint",
         "CASE CAST(floor(c_custkey / 24) AS bigint) % 3 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 995 END"),
        ("residence_months_0", "bigint",
         "CASE CAST(floor(c_custkey / 2) AS bigint) % 4 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 995 WHEN 3 THEN NULL END"),
    ]
    + [
        (f"residence_months_{k}", "bigint",
         f"CASE WHEN c_custkey % 13 = {k} THEN NULL WHEN c_custkey % 77 = {k} THEN 995 "
         f"WHEN c_custkey % 2 = 0 THEN 1 ELSE (c_custkey + {k}) % 2 END")
        for k in range(1, 13)
    ]
    + [("hh_weight_v2", "double", "c_acctbal")]
    + _nulls(["home_taz", "home_x", "home_y", "sample_home_lat", "sample_home_lon", "hh_weight",
              "hh_weight_fri", "hh_weight_sat", "hh_weight_sun", "hh_weight_aggregated_v2"])
)

# ---------------------------------------------------------------- core_person
_PLACE_COLS = [c for c in codes.PERSON_DROP if c.startswith(("second_home_", "work_", "school_"))]

_CORE_PERSON = (
    [
        ("person_id", "bigint", "o_orderkey"),
        ("hh_id", "bigint", "o_custkey"),
        ("Unnamed__0", "bigint", "o_orderkey"),
        ("segment_type", "string", _seg("o_custkey")),
        ("age", "bigint", "CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE (o_orderkey * 13 + o_custkey) % 14 END"),
        ("num_jobs", "bigint", "CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE o_orderkey % 3 END"),
        ("num_trips", "bigint", "CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_orderkey % 6 END"),
        ("school_type", "bigint", "CASE WHEN o_orderkey % 14 = 0 THEN NULL ELSE (o_orderkey * 11) % 14 END"),
        ("person_weight_v2", "double", "o_totalprice"),
    ]
    + _nulls(_PLACE_COLS)
    + _nulls(["person_weight", "person_weight_fri", "person_weight_sat", "person_weight_sun",
              "person_weight_aggregated_v2"])
)

# ---------------------------------------------------------------- trips
_TRIP_KEY = "((l_orderkey * 8 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey"
_DEPART_HOUR = ("CAST(CASE WHEN l_orderkey % 41 = 0 THEN NULL "
                "ELSE (l_orderkey + l_linenumber % 2 * 6) % 24 END AS int)")
_TRIP_COMMON = [
    ("hh_id", "bigint", "o_custkey"),
    ("person_id", "bigint", "l_orderkey"),
    ("day_id", "bigint", "l_orderkey * 10 + l_linenumber % 2"),
    ("depart_hour", "int", _DEPART_HOUR),
    ("depart_minute", "int", "CAST(l_orderkey % 4 * 15 AS int)"),
]
_TRIP_TIMES_AND_PLACES = [
    ("arrive_hour", "int", "CAST((l_orderkey + l_linenumber % 2 * 6 + l_suppkey % 3) % 24 AS int)"),
    ("arrive_minute", "int", "CAST(l_partkey % 60 AS int)"),
    ("o_lon", "double", f"-112 + CAST((l_orderkey * 7919 + l_linenumber * 31) % 10007 AS double) / 10007 * {_wide('l_orderkey')}"),
    ("o_lat", "double", f"40 + CAST((l_partkey * 104729 + l_linenumber * 17) % 10009 AS double) / 10009 * {_wide('l_linenumber')}"),
    ("d_lon", "double", f"-112 + CAST((l_partkey * 7919 + l_suppkey * 31) % 10007 AS double) / 10007 * {_wide('l_partkey')}"),
    ("d_lat", "double", f"40 + CAST((l_orderkey * 104729 + l_suppkey * 17) % 10009 AS double) / 10009 * {_wide('l_linenumber')}"),
    ("o_purpose_category", "bigint", _purpose_category("(l_suppkey * 3 + l_linenumber)")),
    ("d_purpose_category", "bigint", _purpose_category("(l_partkey * 5 + l_linenumber)")),
    ("o_purpose", "bigint", "CASE WHEN l_suppkey % 9 = 0 THEN 60 ELSE 20 + l_partkey % 8 END"),
    ("d_purpose", "bigint", "CASE WHEN l_partkey % 9 = 0 THEN 60 ELSE 1 + l_suppkey % 30 END"),
]

# Attribute columns carried from an unlinked trip to its linked trip; the
# fixture fills them with (l_partkey + k) % 7 in this order.
_ROTATING_ATTRS = [
    "speed_mph_collected", "speed_flag", "distance_meters", "distance_meters_collected",
    "distance_miles_collected", "park_location", "park_type", "park_pay", "ev_charge_station",
    "ev_charge_station_level_1", "ev_charge_station_level_2", "ev_charge_station_level_998",
    "ev_charge_station_decision", "tnc_type", "taxi_type", "taxi_pay", "transit_type",
    "num_hh_travelers", "num_non_hh_travelers", "driver",
]

_CORE_TRIP = (
    [("trip_id", "bigint", _TRIP_KEY)]
    + _TRIP_COMMON
    + [("depart_seconds", "int", "CAST(CASE WHEN l_suppkey % 7 = 0 THEN 1 ELSE 0 END AS int)")]
    + _TRIP_TIMES_AND_PLACES
    + [
        ("segment_type", "string", _seg("l_suppkey")),
        ("trip_type", "bigint",
         "CASE l_partkey % 9 WHEN 0 THEN 995 WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 3 WHEN 4 THEN 4 "
         "WHEN 5 THEN 5 WHEN 6 THEN 6 WHEN 7 THEN 7 WHEN 8 THEN NULL END"),
        ("o_purpose_type", "bigint", "CASE WHEN l_suppkey % 10 = 0 THEN 995 ELSE l_suppkey % 10 END"),
        ("d_purpose_type", "bigint", "CASE WHEN l_partkey % 10 = 0 THEN 995 ELSE l_partkey % 10 END"),
        ("mode_type_broad", "bigint", "1 + l_suppkey % 5"),
        ("num_travelers", "bigint", "CASE WHEN l_partkey % 23 = 0 THEN NULL ELSE l_linenumber % 5 END"),
        ("distance_miles", "double", "CASE WHEN l_partkey % 19 = 0 THEN NULL ELSE l_quantity * 0.37e0 END"),
        ("o_bg_2020", "bigint", "490000 + l_suppkey"),
        ("d_bg_2020", "bigint", "490000 + l_partkey"),
        ("trip_weight_v2", "double", "l_extendedprice"),
        ("speed_mph", "double", "l_tax * 100"),
        ("park_cost", "double", "l_discount * 100"),
    ]
    + [(c, "bigint", f"(l_partkey + {k}) % 7") for k, c in enumerate(_ROTATING_ATTRS)]
    + _nulls(["Unnamed__0", "o_taz", "o_x", "o_y", "d_taz", "d_x", "d_y", "trip_weight",
              "trip_weight_fri", "trip_weight_sat", "trip_weight_sun", "trip_weight_aggregated_v2"])
)

# Pass-through columns of the linked-trip source that the test tables do not
# model: each gets values of its own, so that a swapped or lost
# column shows.
LINKED_PASSTHROUGH = (
    [("day_weight", "double"), ("person_num", "bigint"), ("day_num", "bigint"),
     ("participation_group", "bigint"), ("diary_platform", "string"),
     ("o_purpose_type_rsg", "bigint"), ("depart_time", "timestamp_ntz"), ("depart_date", "date"),
     ("d_purpose_type_rsg", "bigint"), ("arrive_time", "timestamp_ntz"), ("arrive_date", "date"),
     ("arrive_second", "int"), ("home_distance", "double"), ("duration_minutes", "double"),
     ("dwell_mins", "double")]
    + [(f"hh_member_{i}", "bigint") for i in range(1, 14)]
    + [("joint_status", "bigint"), ("joint_trip_id", "bigint"), ("joint_trip_num", "bigint"),
       ("joint_num_participants", "bigint"), ("escort_category", "bigint"), ("outbound", "bigint"),
       ("primdest_penalty", "double"), ("trip_adjustment_factor", "double"),
       ("linked_trip_weight", "double"), ("linked_trip_num", "bigint"), ("tour_num", "bigint"),
       ("tour_id", "bigint"), ("trip_purp_RSG", "string"), ("TMR_Purpose", "string"),
       ("person_type", "bigint"), ("person_cat", "string")]
)

def _passthrough_value(k: int, typ: str) -> str:
    number = f"(l_orderkey * {2 * k + 3} + l_linenumber * {k + 1})"
    if typ == "string":
        return f"concat('c{k}_', CAST({number} % {50 + k} AS string))"
    if typ == "date":
        return f"(DATE '2020-01-01' + CAST({number} % {300 + k} AS int))"
    if typ == "timestamp_ntz":
        return f"CAST((DATE '2021-01-01' + CAST({number} % {300 + k} AS int)) AS timestamp_ntz)"
    return f"{number} % {1000 + k}" + (" / 8.0e0" if typ == "double" else "")


_TRIP_LINKED_SRC = (
    [("linked_trip_id", "bigint", _TRIP_KEY)]
    + _TRIP_COMMON
    + [("depart_seconds", "int", "CAST(CASE WHEN l_suppkey % 5 = 0 THEN 1 ELSE 0 END AS int)")]
    + _TRIP_TIMES_AND_PLACES
    + [
        ("linked_trip_mode", "bigint",
         "CASE (l_suppkey + l_linenumber) % 16 WHEN 0 THEN -1 WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 5 "
         "WHEN 4 THEN 8 WHEN 5 THEN 9 WHEN 6 THEN 10 WHEN 7 THEN 11 WHEN 8 THEN 12 WHEN 9 THEN 13 "
         "WHEN 10 THEN 14 WHEN 11 THEN 15 WHEN 12 THEN 16 WHEN 13 THEN 17 WHEN 14 THEN NULL WHEN 15 THEN 99 END"),
        ("Model_Purpose", "string",
         "CASE l_partkey % 8 WHEN 0 THEN 'HBW' WHEN 1 THEN 'HBSch' WHEN 2 THEN 'HBShp' WHEN 3 THEN 'HBO' "
         "WHEN 4 THEN 'NHBW' WHEN 5 THEN 'NHBNW' WHEN 6 THEN 'HBC' WHEN 7 THEN NULL END"),
        ("school_type", "bigint", "CASE WHEN l_orderkey % 14 = 0 THEN NULL ELSE (l_orderkey * 11) % 14 END"),
        ("trip_weight_new", "double", "l_extendedprice"),
    ]
    + [(c, t, _passthrough_value(k, t)) for k, (c, t) in enumerate(LINKED_PASSTHROUGH)]
)

# ---------------------------------------------------------------- day, vehicle
_CORE_DAY = (
    [
        ("day_id", "bigint", "event_id"),
        ("person_id", "bigint", "user_id"),
        ("segment_type", "string", _seg("event_id")),
        ("day_weight_v2", "double", "value"),
    ]
    + _nulls(["Unnamed__0", "day_weight", "day_weight_fri", "day_weight_sat", "day_weight_sun",
              "day_weight_aggregated_v2"])
)

_CORE_VEHICLE = (
    [
        ("vehicle_id", "bigint", "p_partkey"),
        ("hh_id", "bigint", "p_partkey % 100"),
        ("segment_type", "string", _seg("p_partkey")),
        ("vehicle_type", "string", "p_type"),
    ]
    + _nulls(["hh_weight", "hh_weight_fri", "hh_weight_sat", "hh_weight_sun"])
)

# ---------------------------------------------------------------- zones
def _quad(key: str, cols: int, rows: int, col_pitch: int, row_pitch: int, row_shear: int, width: str) -> list:
    """Vertices of a sheared grid cell: column = key % cols, row = key / cols; after ``rows`` rows the
    grid goes on one degree to the east."""
    col = f"({key} % {cols})"
    row = f"CAST(floor({key} % {cols * rows} / {cols}) AS bigint)"
    west = f"(-112 + CAST(floor({key} / {cols * rows}) AS bigint))"
    left = f"{west} + CAST({col} AS double) / {col_pitch}"
    right = f"{west} + CAST({col} * 1.0e0 + {width} AS double) / {col_pitch}"
    return [
        ("x0", "double", f"{left} + CAST({row} AS double) / {row_shear}"),
        ("y0", "double", f"40 + CAST({row} AS double) / {row_pitch}"),
        ("x1", "double", f"{right} + CAST({row} AS double) / {row_shear}"),
        ("y1", "double", f"40 + CAST({row} AS double) / {row_pitch}"),
        ("x2", "double", f"{right} + CAST({row} + 1 AS double) / {row_shear}"),
        ("y2", "double", f"40 + CAST({row} + 1 AS double) / {row_pitch}"),
        ("x3", "double", f"{left} + CAST({row} + 1 AS double) / {row_shear}"),
        ("y3", "double", f"40 + CAST({row} + 1 AS double) / {row_pitch}"),
    ]


_TAZ_V3 = [
    ("CO_TAZID", "bigint", "49000 + n_nationkey"),
    ("CO_FIPS", "bigint", "35 + n_regionkey"),
    ("SUBAREAID", "double", "CAST(n_regionkey AS double)"),
] + _quad("n_nationkey", 5, 5, 5, 5, 50, "1")

_TAZ_V4 = [
    ("CO_TAZID", "bigint", "490000 + p_partkey"),
    ("CO_FIPS", "bigint", "35 + p_partkey % 29"),
    ("SUBAREAID", "double", "CAST(p_size % 5 AS double)"),
] + _quad("p_partkey", 20, 100, 20, 10, 1000, "1.1e0")


RELATIONS: dict[str, Relation] = {
    r.name: r
    for r in [
        Relation("core_hh", "customer", tuple(_CORE_HH)),
        Relation("followon_hh", "customer", (("hh_id", "bigint", "c_custkey"),), where="c_custkey % 4 = 0"),
        Relation("core_person", "orders", tuple(_CORE_PERSON)),
        Relation("core_trip", "lineitem", tuple(_CORE_TRIP), join=("orders", "l_orderkey", "o_orderkey"),
                 spread=True),
        Relation("trip_linked_src", "lineitem", tuple(_TRIP_LINKED_SRC),
                 join=("orders", "l_orderkey", "o_orderkey"), spread=True),
        Relation("core_day", "events", tuple(_CORE_DAY)),
        Relation("core_vehicle", "part", tuple(_CORE_VEHICLE)),
        Relation("taz_v3", "nation", tuple(_TAZ_V3)),
        Relation("taz_v4", "part", tuple(_TAZ_V4)),
    ]
}


def _select_exprs(rel: Relation) -> list[str]:
    return [f"CAST({expr} AS {typ}) AS {name}" for name, typ, expr in rel.columns]


SPREAD_CONF = "wayfarer.source.spreadPartitions"


def _spread(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Round-robin the scanned rows over ``n`` partitions when the scan yields fewer.

    The test files hold one parquet row group each, so a scan is one task;
    without this every narrow operator downstream (zone lookups, recodes)
    would run on one core.  Round-robin is skew-free and deterministic on
    retry (rows are sorted locally first).  Real tables come in many splits
    and are left alone.
    """
    n = int(spark.conf.get(SPREAD_CONF, str(spark.sparkContext.defaultParallelism)))
    if n > 1 and df.rdd.getNumPartitions() < n:
        return df.repartition(n)
    return df


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Spark DataFrame for one survey relation over the star tables in ``sf_dir``."""
    rel = RELATIONS[name]
    df = spark.read.parquet(f"{sf_dir}/{rel.base}.parquet")
    if rel.where:
        df = df.where(rel.where)
    if rel.spread:
        df = _spread(spark, df)
    if rel.join:
        other, lk, rk = rel.join
        df = df.join(spark.read.parquet(f"{sf_dir}/{other}.parquet"), F.col(lk) == F.col(rk), "inner")
    return df.selectExpr(*_select_exprs(rel))


def relation_sql(name: str) -> str:
    """The same relation as one SELECT over the star-table views (DuckDB oracle)."""
    rel = RELATIONS[name]
    sql = f"SELECT {', '.join(_select_exprs(rel)).replace('timestamp_ntz', 'timestamp')} FROM {rel.base}"
    if rel.join:
        other, lk, rk = rel.join
        sql += f" JOIN {other} ON {lk} = {rk}"
    if rel.where:
        sql += f" WHERE {rel.where}"
    return sql


def with_relations(names, body: str) -> str:
    """``WITH <relation> AS (...), ... <body>`` for the oracle."""
    ctes = ",\n".join(f"{n} AS ({relation_sql(n)})" for n in names)
    return f"WITH {ctes}\n{body}" if not body.lstrip().upper().startswith("WITH") else \
        f"WITH {ctes},\n{body.lstrip()[4:]}"
