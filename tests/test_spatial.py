"""Point-in-zone operator: boundary rules, holes, parts, overlap, NULLs, brute force."""

import random

import pytest
from pyspark.sql import functions as F

from wayfarer.operators.spatial import assign_zone, build_zone_index, join_zones, spread

GEOM = "array<array<struct<lon:double,lat:double>>>"


def ring(*pts):
    return [{"lon": float(x), "lat": float(y)} for x, y in pts]


def box(x0, y0, x1, y1):
    return ring((x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0))


ZONES = [
    (1, 10, [box(0, 0, 1, 1)]),
    (2, 20, [box(2, 0, 6, 4), box(3, 1, 5, 3)]),                      # square with a hole
    (3, 30, [box(10, 0, 11, 1), box(12, 0, 13, 1)]),                  # two parts
    (4, 40, [box(20, 0, 22, 2)]),
    (5, 50, [box(21, 0, 23, 2)]),                                     # overlaps zone 4
    (6, 60, [ring((30, 0), (31, 0), (30.5, 1))]),                     # open ring (closed by the operator)
]
POINTS = [
    ("vertex", 0.0, 0.0), ("edge", 0.5, 0.0), ("inside", 0.5, 0.5), ("outside", 1.5, 0.5),
    ("hole", 4.0, 2.0), ("hole_edge", 3.0, 2.0), ("ring_area", 2.5, 0.5), ("second_part", 12.5, 0.5),
    ("overlap", 21.5, 1.0), ("null_lon", None, 0.5), ("triangle", 30.5, 0.5),
]


@pytest.fixture(scope="module")
def zones_df(spark):
    return spark.createDataFrame(ZONES, f"zid bigint, attr bigint, geometry {GEOM}")


@pytest.fixture(scope="module")
def points_df(spark):
    return spark.createDataFrame(POINTS, "name string, lon double, lat double")


@pytest.mark.parametrize("cell", [0.3, 1.0, 7.0, "auto"])
def test_intersects_pick(spark, zones_df, points_df, cell):
    idx = build_zone_index(zones_df, "zid", ["attr"], cell_size=cell)
    out = assign_zone(points_df, "lon", "lat", idx, {"zid": "z", "attr": "a"}, predicate="intersects")
    got = {r.name: (r.z, r.a) for r in out.collect()}
    assert got == {
        "vertex": (1, 10), "edge": (1, 10), "inside": (1, 10), "outside": (None, None), "hole": (None, None),
        "hole_edge": (2, 20), "ring_area": (2, 20), "second_part": (3, 30), "overlap": (4, 40),
        "null_lon": (None, None), "triangle": (6, 60)}
    assert out.count() == len(POINTS)


@pytest.mark.parametrize("cell", [0.3, "auto"])
def test_within_fanout(spark, zones_df, points_df, cell):
    idx = build_zone_index(zones_df, "zid", ["attr"], cell_size=cell)
    out = join_zones(points_df, "lon", "lat", idx, {"zid": "z"}, predicate="within")
    got = sorted((r.name, r.z) for r in out.collect())
    assert got == sorted([
        ("vertex", None), ("edge", None), ("inside", 1), ("outside", None), ("hole", None), ("hole_edge", None),
        ("ring_area", 2), ("second_part", 3), ("overlap", 4), ("overlap", 5), ("null_lon", None),
        ("triangle", 6)])


def _brute(zones, px, py, predicate):
    hits = []
    for zid, _, rings in zones:
        edges = []
        for r in rings:
            pts = [(p["lon"], p["lat"]) for p in r]
            if pts[0] != pts[-1]:
                pts.append(pts[0])
            edges += [(pts[i][0], pts[i][1], pts[i + 1][0], pts[i + 1][1]) for i in range(len(pts) - 1)]
        cross = sum(1 for x1, y1, x2, y2 in edges
                    if ((y1 > py) != (y2 > py)) and px < (x2 - x1) * (py - y1) / (y2 - y1) + x1)
        on = any(((x2 - x1) * (py - y1) - (y2 - y1) * (px - x1) == 0) and min(x1, x2) <= px <= max(x1, x2)
                 and min(y1, y2) <= py <= max(y1, y2) for x1, y1, x2, y2 in edges)
        inside = cross % 2 == 1
        if (inside or on) if predicate == "intersects" else (inside and not on):
            hits.append(zid)
    return hits


def _random_zones(rng, n):
    zones = []
    for zid in range(1, n + 1):
        cx, cy, r = rng.uniform(0, 10), rng.uniform(0, 10), rng.uniform(0.3, 2.0)
        k = rng.randint(3, 9)
        import math
        angles = sorted(rng.uniform(0, 2 * math.pi) for _ in range(k))
        pts = [(cx + r * rng.uniform(0.4, 1.0) * math.cos(a), cy + r * rng.uniform(0.4, 1.0) * math.sin(a))
               for a in angles]
        zones.append((zid, zid * 7, [ring(*pts, pts[0])]))
    return zones


@pytest.mark.parametrize("seed,cell", [(1, 0.25), (2, 1.0), (3, "auto")])
def test_grid_join_equals_brute_force(spark, seed, cell):
    rng = random.Random(seed)
    zones = _random_zones(rng, 25)
    pts = [(i, rng.uniform(-1, 11), rng.uniform(-1, 11)) for i in range(1500)]
    # a few points exactly on vertices
    pts += [(10_000 + j, z[2][0][0]["lon"], z[2][0][0]["lat"]) for j, z in enumerate(zones[:5])]
    zdf = spark.createDataFrame(zones, f"zid bigint, attr bigint, geometry {GEOM}")
    pdf = spark.createDataFrame(pts, "pid bigint, lon double, lat double")
    idx = build_zone_index(zdf, "zid", ["attr"], cell_size=cell)
    got = {r.pid: r.z for r in assign_zone(pdf, "lon", "lat", idx, {"zid": "z"}).collect()}
    want = {pid: min(_brute(zones, x, y, "intersects"), default=None) for pid, x, y in pts}
    assert got == want
    got_w = sorted((r.pid, r.z) for r in join_zones(pdf, "lon", "lat", idx, {"zid": "z"}, "within").collect())
    want_w = sorted((pid, z) for pid, x, y in pts for z in (_brute(zones, x, y, "within") or [None]))
    assert got_w == want_w


def test_index_is_broadcast_only_under_limit(spark, zones_df):
    small = build_zone_index(zones_df, "zid", ["attr"], cell_size=0.5)
    assert small.broadcast and small.est_bytes > 0
    capped = build_zone_index(zones_df, "zid", ["attr"], cell_size=0.5, max_broadcast_bytes=10)
    assert not capped.broadcast
    pts = spark.createDataFrame([(0.5, 0.5)], "lon double, lat double")
    plan = assign_zone(pts, "lon", "lat", capped, {"zid": "z"})._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
    assert assign_zone(pts, "lon", "lat", capped, {"zid": "z"}).first().z == 1


def test_lookups_on_one_index_share_its_broadcast(spark, zones_df):
    """Two lookups on one index run no more jobs than one: the broadcast is reused."""
    idx = build_zone_index(zones_df, "zid", ["attr"], cell_size=0.5)
    pts = spark.createDataFrame([(float(i % 30), float(i % 4), float((i * 7) % 30), 0.5) for i in range(200)],
                                "x1 double, y1 double, x2 double, y2 double")
    sc = spark.sparkContext

    def jobs(label, df):
        sc.setJobGroup(label, label)
        df.write.format("noop").mode("overwrite").save()
        n = len(sc.statusTracker().getJobIdsForGroup(label))
        sc.setJobGroup("", "")
        return n
    one = jobs("one-lookup", assign_zone(pts, "x1", "y1", idx, {"zid": "a"}))
    two = jobs("two-lookups", assign_zone(assign_zone(pts, "x1", "y1", idx, {"zid": "a"}), "x2", "y2", idx,
                                          {"zid": "b"}))
    assert two == one


def test_nan_and_null_ids_get_no_zone(spark, zones_df):
    nan = float("nan")
    for limit in (None, 1):
        idx = build_zone_index(zones_df, "zid", ["attr"], cell_size=0.25, max_broadcast_bytes=limit)
        pts = spark.createDataFrame([(1, nan, nan), (2, nan, 0.5), (3, 0.5, nan), (None, 0.5, 0.5), (4, 0.5, 0.5), (4, 3.5, 3.5)],
                                    "pid long, lon double, lat double")
        got = sorted((tuple(r) for r in assign_zone(pts, "lon", "lat", idx, {"zid": "z"}, id_col="pid").select("pid", "z").collect()),
                     key=repr)
        assert got == [(1, None), (2, None), (3, None), (4, 1), (4, 2), (None, None)]


def test_many_zones_and_many_vertices(spark):
    """100,000 small zones need no more than the cover's bound; one zone of 50,000 vertices is cut by rows."""
    import math
    import time
    t = time.time()
    many = spark.range(100_000).selectExpr(
        "id AS zid", "id AS attr", "array(array(" + ", ".join(
            f"named_struct('lon', id % 400 / 10.0D + {x}, 'lat', CAST(floor(id / 400) AS double) / 10 + {y})"
            for x, y in ((0, 0), (0.1, 0), (0.1, 0.1), (0, 0.1))) + ")) AS geometry")
    idx = build_zone_index(many, "zid", ["attr"])
    pts = spark.createDataFrame([(i, 0.05 + (i * 37 % 400) / 10, 0.05 + (i * 11 % 250) / 10) for i in range(500)],
                                "pid long, lon double, lat double")
    got = {r.pid: r.z for r in assign_zone(pts, "lon", "lat", idx, {"zid": "z"}).collect()}
    assert got == {i: (i * 11 % 250) * 400 + i * 37 % 400 for i in range(500)}
    n = 50_000
    star = [(1 + 0.1 * (k % 2)) for k in range(n)]
    big = ring(*[(r * math.cos(2 * math.pi * k / n), r * math.sin(2 * math.pi * k / n)) for k, r in enumerate(star)])
    idx = build_zone_index(spark.createDataFrame([(1, 1, [big])], f"zid bigint, attr bigint, geometry {GEOM}"), "zid", ["attr"],
                           cell_size=0.01)
    pts = spark.createDataFrame([(0.0, 0.0), (0.99, 0.0), (0.0, -0.98), (1.2, 0.0), (0.8, 0.8)], "lon double, lat double")
    assert [r.z for r in assign_zone(pts, "lon", "lat", idx, {"zid": "z"}).collect()] == [1, 1, 1, None, None]
    assert time.time() - t < 120


def test_geojson_zones_equal_rings(spark, points_df):
    import json

    from wayfarer.sources.zones import with_rings
    rows = []
    for zid, attr, rings in ZONES:
        closed = [[[p["lon"], p["lat"]] for p in r] for r in rings]
        closed = [r if r[0] == r[-1] else r + [r[0]] for r in closed]
        shape = ({"type": "MultiPolygon", "coordinates": [[r] for r in closed]} if zid == 3 else
                 {"type": "Polygon", "coordinates": closed})
        rows.append((zid, attr, json.dumps({"type": "Feature", "properties": {}, "geometry": shape} if zid == 4 else shape)))
    rows += [(7, 70, "not json"), (8, 80, None), (9, 90, json.dumps({"type": "Point", "coordinates": [0, 0]}))]
    zones = with_rings(spark.createDataFrame(rows, "zid bigint, attr bigint, geometry string"))
    plain = spark.createDataFrame(ZONES, f"zid bigint, attr bigint, geometry {GEOM}")
    for predicate in ("intersects", "within"):
        a, b = (sorted((r.name, r.z) for r in join_zones(points_df, "lon", "lat", build_zone_index(x, "zid", ["attr"]),
                                                         {"zid": "z"}, predicate).fillna(-1, "z").collect()) for x in (zones, plain))
        assert a == b


def test_out_of_range_coordinates(spark, zones_df):
    idx = build_zone_index(zones_df, "zid", ["attr"], cell_size=0.5)
    pts = spark.createDataFrame([(0.5, 0.5), (0.5, 95.0)], "lon double, lat double")
    got = [r.z for r in assign_zone(pts, "lon", "lat", idx, {"zid": "z"}).collect()]
    assert got == [1, None]
    with pytest.raises(Exception, match="out of range"):
        assign_zone(pts, "lon", "lat", idx, {"zid": "z"}, on_bad="raise").collect()


def test_shuffled_lookup_salts_dense_cells(spark, zones_df):
    """Index over its broadcast limit: dense cells are salted and results stay the same."""
    idx_b = build_zone_index(zones_df, "zid", ["attr"], cell_size=0.5)
    idx_s = build_zone_index(zones_df, "zid", ["attr"], cell_size=0.5, max_broadcast_bytes=1)
    pts = spark.createDataFrame([(0.25 + (i % 7) * 0.01, 0.3, i) for i in range(300)]
                                + [(None, 0.5, 1000 + i) for i in range(20)] + [(21.5, 1.0, 2000)],
                                "lon double, lat double, pid long")
    spark.conf.set("wayfarer.skew.hotKeyRows", "50")
    spark.conf.set("wayfarer.skew.sampleFraction", "1.0")
    try:
        shuffled = assign_zone(pts, "lon", "lat", idx_s, {"zid": "z"})
        got = sorted((r.pid, r.z) for r in shuffled.collect())
        plan = shuffled._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("wayfarer.skew.hotKeyRows")
        spark.conf.unset("wayfarer.skew.sampleFraction")
    want = sorted((r.pid, r.z) for r in assign_zone(pts, "lon", "lat", idx_b, {"zid": "z"}).collect())
    assert got == want
    assert "__salt" in plan and "BroadcastNestedLoopJoin" not in plan


def _grid_of_zones(spark, n):
    """n unit squares in a row, read by one task."""
    x = F.col("id").cast("double")
    corners = [(x, F.lit(0.0)), (x + 1, F.lit(0.0)), (x + 1, F.lit(1.0)), (x, F.lit(1.0))]
    ring = F.array(*[F.struct(a.alias("lon"), b.alias("lat")) for a, b in corners])
    return spark.range(0, n, 1, 1).select(F.col("id").alias("zid"), F.array(ring).alias("geometry"))


def test_index_over_its_limit_is_never_broadcast_by_estimate(spark):
    """Spark's estimate of the cells is that of the zone table (small): it must not decide."""
    idx = build_zone_index(_grid_of_zones(spark, 20), "zid", max_broadcast_bytes=1)
    pts = spark.createDataFrame([(i + 0.5, 0.5) for i in range(20)], "lon double, lat double")
    found = assign_zone(pts, "lon", "lat", idx, {"zid": "z"})
    rows = sorted((r.lon, r.z) for r in found.collect())
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert rows == [(i + 0.5, i) for i in range(20)]
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


@pytest.mark.parametrize("lookup", [assign_zone, join_zones])
def test_cells_without_points_do_not_count_for_the_broadcast(spark, lookup):
    whole = build_zone_index(_grid_of_zones(spark, 100), "zid", cell_size=0.5)
    idx = build_zone_index(_grid_of_zones(spark, 100), "zid", cell_size=0.5, max_broadcast_bytes=whole.est_bytes // 20)
    assert not idx.broadcast
    pts = spark.createDataFrame([(i % 5 + 0.37, 0.61) for i in range(50)] + [(None, 0.5), (500.0, 0.5), (7.0, None)], "lon double, lat double")
    near = idx.near(pts, [("lon", "lat")])
    assert near.broadcast and 0 < near.est_bytes <= idx.max_broadcast_bytes
    got, want = ([tuple(r) for r in lookup(pts, "lon", "lat", i, {"zid": "z"}).collect()] for i in (idx, whole))
    assert sorted(got, key=str) == sorted(want, key=str)
    far = spark.createDataFrame([(i + 0.5, 0.5) for i in range(100)], "lon double, lat double")
    assert not idx.near(far, [("lon", "lat")]).broadcast


def test_zones_of_one_file_are_indexed_on_all_cores(spark):
    zones = _grid_of_zones(spark, 40)
    assert zones.rdd.getNumPartitions() == 1
    assert spread(zones).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = zones.repartition(3 * spark.sparkContext.defaultParallelism)
    assert spread(many).rdd.getNumPartitions() == many.rdd.getNumPartitions()


def test_cells_of_very_many_zones_stay_uncrowded(spark, monkeypatch):
    """The number of cells follows the number of zones beyond MAX_CELLS."""
    from wayfarer.operators import spatial
    monkeypatch.setattr(spatial, "MAX_CELLS", 50)
    idx = build_zone_index(_grid_of_zones(spark, 400), "zid")
    assert idx.cells.agg(F.max(F.size("zones"))).first()[0] <= 4


@pytest.mark.parametrize("lookup", [assign_zone, join_zones])
def test_zones_near_points_get_a_grid_as_fine_as_the_limit_allows(spark, monkeypatch, lookup):
    """However many zones lie elsewhere, most points of the zones in use fall in cells that need no test."""
    from wayfarer.operators import spatial
    monkeypatch.setattr(spatial, "MAX_CELLS", 50)
    idx = build_zone_index(_grid_of_zones(spark, 400), "zid", max_broadcast_bytes=100_000, materialize=True)
    whole = build_zone_index(_grid_of_zones(spark, 400), "zid", cell_size=0.5)
    pts = spark.createDataFrame([(100 + i / 20, i % 7 / 6) for i in range(101)] + [(None, 0.5), (7.0, None)], "lon double, lat double")
    near = idx.near(pts, [("lon", "lat")])
    assert not idx.broadcast and near.broadcast and near.est_bytes <= 100_000 and near.cell_size < idx.cell_size / 2
    assert near.cells.agg(F.avg(F.col("exact").cast("int"))).first()[0] > 0.4
    got, want = ([tuple(r) for r in lookup(pts, "lon", "lat", i, {"zid": "z"}, predicate="intersects").collect()] for i in (idx, whole))
    assert sorted(got, key=str) == sorted(want, key=str)
    assert sum(r[2] is not None for r in got) >= 101


@pytest.mark.parametrize("lookup", [assign_zone, join_zones])
def test_reference_points_are_not_computed_edge_by_edge(spark, lookup):
    idx = build_zone_index(_grid_of_zones(spark, 9), "zid", cell_size=0.5, materialize=True)
    pts = spark.createDataFrame([(100.1, 0.3)], "lon double, lat double")
    plan = lookup(pts, "lon", "lat", idx, {"zid": "z"})._jdf.queryExecution().optimizedPlan().toString()
    tests = [line for line in plan.splitlines() if "lambdafunction" in line]
    assert tests and not any("floor" in line.lower() for line in tests)
