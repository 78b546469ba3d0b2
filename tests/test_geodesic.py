"""Geodesic zone edges: three-vector brute force, antimeridian, poles."""

import math
import random

import pytest
from pyspark.sql import functions as F

from wayfarer.operators.geodesic import build_geodesic_index
from wayfarer.operators.spatial import assign_zone, build_zone_index, join_zones

GEOM = "array<array<struct<lon:double,lat:double>>>"


def ring(*pts):
    return [{"lon": float(x), "lat": float(y)} for x, y in pts]


def vec(lon, lat):
    a, b = math.radians(lon), math.radians(lat)
    return (math.cos(b) * math.cos(a), math.cos(b) * math.sin(a), math.sin(b))


def cross(a, b):
    return (a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0])


def dot(a, b):
    return sum(x * y for x, y in zip(a, b))


def arcs_meet(a, b, c, d):
    """Whether the great-circle arcs a-b and c-d cross (general position)."""
    n, m = cross(a, b), cross(c, d)
    return (dot(n, c) > 0) != (dot(n, d) > 0) and (dot(m, a) > 0) != (dot(m, b) > 0) and dot(cross(n, m), tuple(
        x + y for x, y in zip(a, b))) * dot(cross(n, m), tuple(x + y for x, y in zip(c, d))) > 0


def inside(rings, lon, lat, outer):
    """Parity of the crossings on the way from a point known to be outside, by way of a bend."""
    bend = (0.31, -0.52, 0.79)
    bend = tuple(x / math.sqrt(dot(bend, bend)) for x in bend)
    path = [vec(lon, lat), bend, vec(*outer)]
    n = 0
    for r in rings:
        pts = [vec(p["lon"], p["lat"]) for p in r]
        for a, b in zip(pts, pts[1:] + pts[:1]):
            if a != b:
                n += sum(arcs_meet(p, q, a, b) for p, q in zip(path, path[1:]))
    return n % 2 == 1


def star(rnd, lon, lat, size, n):
    """A ring of n vertices round (lon, lat), radius up to ``size`` degrees of arc; may hold a pole or cross the antimeridian."""
    z = vec(lon, lat)
    east = cross((0, 0, 1), z)
    east = tuple(x / math.sqrt(dot(east, east)) for x in east)
    north = cross(z, east)
    pts = []
    for k in range(n):
        t, r = 2 * math.pi * (k + rnd.random() * 0.8) / n, math.radians(size * rnd.uniform(0.4, 1))
        v = tuple(math.cos(r) * z[i] + math.sin(r) * (math.cos(t) * east[i] + math.sin(t) * north[i]) for i in range(3))
        pts.append((math.degrees(math.atan2(v[1], v[0])), math.degrees(math.asin(v[2]))))
    return ring(*pts)


@pytest.mark.parametrize("seed,cell", [(1, "auto"), (2, 3.0)])
def test_equals_brute_force_all_over_the_globe(spark, seed, cell):
    rnd = random.Random(seed)
    centres = [(rnd.uniform(-180, 180), rnd.uniform(-80, 80)) for _ in range(16)] + [(179.5, 10), (-178, -60), (20, 88), (-70, -86)]
    zones = [(i, [star(rnd, x, y, rnd.choice([2, 10, 30]), rnd.randint(3, 9))]) for i, (x, y) in enumerate(centres)]
    zones[0][1].append(star(rnd, *centres[0], 0.7, 5))  # a hole
    points = [(k, math.degrees(math.atan2(rnd.gauss(0, 1), rnd.gauss(0, 1))), math.degrees(math.asin(rnd.uniform(-1, 1)))) for k in range(1500)]
    points += [(2000 + i, x + 0.01, float(y)) for i, (x, y) in enumerate(centres)]
    index = build_geodesic_index(spark.createDataFrame(zones, f"zid bigint, geometry {GEOM}"), "zid", cell_size=cell)
    out = join_zones(spark.createDataFrame(points, "k bigint, lon double, lat double"), "lon", "lat", index, {"zid": "z"})
    got = {}
    for r in out.collect():
        got.setdefault(r.k, set()).add(r.z)
    for k, lon, lat in points:
        want = {i for i, g in zones if inside(g, lon, lat, (centres[i][0] + 180.2 if centres[i][0] < 0 else centres[i][0] - 179.8, -centres[i][1]))}
        assert got[k] == (want or {None}), (k, lon, lat)


def names(spark, zones, points, predicate="intersects", index=build_geodesic_index):
    made = index(spark.createDataFrame(zones, f"zid bigint, geometry {GEOM}"), "zid")
    out = assign_zone(spark.createDataFrame(points, "name string, lon double, lat double"), "lon", "lat", made, {"zid": "z"}, predicate)
    return {r.name: r.z for r in out.collect()}


def test_a_long_edge_bulges_to_the_pole(spark):
    zone = [(1, [ring((-60, 40), (60, 40), (60, 60), (-60, 60))])]
    points = [("south_edge", 0.0, 45.0), ("middle", 0.0, 62.0), ("above", 0.0, 74.5), ("corner", -60.0, 40.0), ("side", 60.0, 50.0)]
    assert names(spark, zone, points) == {"south_edge": None, "middle": 1, "above": None, "corner": 1, "side": 1}
    assert names(spark, zone, points, "within") == {"south_edge": None, "middle": 1, "above": None, "corner": None, "side": None}
    assert names(spark, zone, points, index=build_zone_index) == {"south_edge": 1, "middle": None, "above": None, "corner": 1, "side": 1}


def test_antimeridian_and_poles(spark):
    zones = [(1, [ring((170, -10), (-170, -10), (-170, 10), (170, 10))]),
             (2, [ring((0, 80), (90, 80), (180, 80), (-90, 80))]),
             (3, [ring((0, -80), (120, -80), (-120, -80)), ring((0, -89), (120, -89), (-120, -89))])]
    points = [("west", 175.0, 0.0), ("east", -175.0, 0.0), ("seam", 180.0, 0.0), ("seam2", -180.0, 0.0), ("off", 165.0, 0.0), ("far", 0.0, 0.0),
              ("north", 33.0, 90.0), ("near_north", 45.0, 86.0), ("below", 45.0, 81.0), ("south", 0.0, -90.0), ("ring", 10.0, -85.0)]
    assert names(spark, zones, points) == {
        "west": 1, "east": 1, "seam": 1, "seam2": 1, "off": None, "far": None, "north": 2, "near_north": 2, "below": None,
        "south": None, "ring": 3}


def test_small_zones_agree_with_planar_ones(spark):
    rnd = random.Random(4)
    zones = [(i, [ring(*[(-112 + i % 5 * 0.01 + dx, 40 + i // 5 * 0.01 + dy) for dx, dy in ((0, 0), (0.01, 0.001), (0.011, 0.01), (0.001, 0.009))])])
             for i in range(25)]
    points = [(str(k), -112 + rnd.random() * 0.06, 40 + rnd.random() * 0.06) for k in range(800)]
    a, b = names(spark, zones, points), names(spark, zones, points, index=build_zone_index)
    assert sum(a[k] != b[k] for k in a) <= 2 and sum(v is not None for v in a.values()) > 300


@pytest.mark.parametrize("bad", [[(0, 0), (190, 0), (0, 5)], [(0, 0), (10, 95), (0, 5)], [(0, 0), (None, 1), (3, 3)], [(0, 0), (float("nan"), 1), (3, 3)]])
def test_impossible_vertices_fail(spark, bad):
    zone = [(1, [[{"lon": None if x is None else float(x), "lat": float(y)} for x, y in bad]])]
    with pytest.raises(Exception, match="zone"):
        names(spark, zone, [("p", 1.0, 1.0)])


def test_zones_beyond_180_degrees_hold_no_point_there(spark):
    zones = [(1, [ring((179.9, 0), (180.1, 0.001), (180.1, 0.1), (179.9, 0.1))]), (2, [ring((-180.1, 1), (-179.9, 1), (-179.9, 1.1), (-180.1, 1.1))]),
             (3, [ring((200, 0), (200.1, 0), (200.1, 0.1), (200, 0.1))]), (4, [ring((-160.5, 0), (-159.5, 0), (-159.5, 0.3), (-160.5, 0.3))])]
    points = [("in", 179.95, 0.05), ("beyond", -179.95, 0.05), ("in2", -179.95, 1.05), ("beyond2", 179.95, 1.05), ("turned", -159.95, 0.05), ("below", 179.95, -0.01)]
    clipped = names(spark, zones, points, index=lambda *a, **k: build_geodesic_index(*a, **k, off_globe="clip"))
    assert clipped == {"in": 1, "beyond": None, "in2": 2, "beyond2": None, "turned": 4, "below": None}
    assert clipped == names(spark, zones, points, index=build_zone_index)


def test_query_with_zones_beyond_180_degrees_matches_oracle(spark, tmp_dir):
    """Part keys of a million put zones far beyond the globe."""
    import duckdb
    import __spark_entry__ as E
    con = duckdb.connect()
    con.execute("CREATE TABLE part AS SELECT CAST(k AS BIGINT) AS p_partkey, CAST(k % 50 AS INTEGER) AS p_size FROM (SELECT unnest(range(0, 20000, 3)) k UNION ALL SELECT unnest(range(580000, 586000, 50)) UNION ALL SELECT 1171459)")
    con.execute("CREATE TABLE customer AS SELECT unnest(range(300)) AS c_custkey, CAST(NULL AS DOUBLE) AS c_acctbal")
    con.execute("CREATE TABLE nation AS SELECT CAST(unnest(range(25)) AS INTEGER) AS n_nationkey, CAST(0 AS INTEGER) AS n_regionkey")
    for t in ("part", "customer", "nation"):
        con.execute(f"COPY {t} TO '{tmp_dir}/{t}.parquet' (FORMAT parquet)")
    found = E.queries()["zone_geodesic_within"](spark, tmp_dir).collect()
    expected = con.execute(E.oracle_sql()["zone_geodesic_within"]).fetchall()
    key = lambda r: tuple(-1 if v is None else v for v in r)
    assert sorted((tuple(r) for r in found), key=key) == sorted(expected, key=key)
    assert sum(r.zone is not None for r in found) > 10
