"""WKT zones and zone validation."""

import pytest

from wayfarer.sources import zones as Z

GEOM = "array<array<struct<lon:double,lat:double>>>"
SQUARE = [(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)]
HOLE = [(1, 1), (2, 1), (2, 2), (1, 1)]


def ring(pts):
    return [{"lon": None if x is None else float(x), "lat": float(y)} for x, y in pts]


def test_wkt(spark):
    square, hole = "(0 0, 4 0, 4 4, 0 4, 0 0)", "(1 1,2 1,2 2,1 1)"
    good = {
        f"POLYGON ({square})": [SQUARE], f"polygon({square}, {hole})": [SQUARE, HOLE], f"  MULTIPOLYGON ((({square[1:-1]})))": [SQUARE],
        f"MULTIPOLYGON (({square}, {hole}),\n ({hole}))": [SQUARE, HOLE, HOLE], f"SRID=4326;POLYGON({hole})": [HOLE],
        "POLYGON Z ((0 0 9, 4 0 9, 4 4 9, 0 4 9, 0 0 9))": [SQUARE], "POLYGON ((-1.5e1 .5, 2. +3, 1 1))": [[(-15, 0.5), (2, 3), (1, 1)]],
        "POLYGON EMPTY": [], "MULTIPOLYGON EMPTY": []}
    broken = [None, "", "POINT (1 2)", "POLYGON", "POLYGON (0 0, 1 1, 2 2)", "POLYGON ((0 0, 1 1, 2 2)", "POLYGON ((0 0, 1, 2 2))", "POLYGON ((0 0, 1 x, 2 2))",
              "POLYGON ((0 0, 1 1, 2 2)) x", "POLYGON ((0 0, 1 1, 2 2),)", "POLYGON ((0 0,, 2 2))", "POLYGON ((0 0, 1 1 1 1 1, 2 2))", "POLYGON ()",
              "MULTIPOLYGON ((0 0, 1 1, 2 2))", "MULTIPOLYGON (((0 0, 1 1, 2 2)) ((0 0, 1 1, 2 2)))", "MULTIPOLYGON (((0 0, 1 1, 2 2)), (0 0, 1 1, 2 2))",
              "POLYGON (((0 0, 1 1, 2 2)))", "POLYGON ((0 0, NaN 1, 2 2))", "LINESTRING (0 0, 1 1)"]
    got = spark.createDataFrame([(i, t) for i, t in enumerate([*good, *broken])], "i int, t string").select("i", Z.rings_from_wkt(Z.F.col("t")).alias("g"))
    got = {r.i: r.g for r in got.collect()}
    for i, want in enumerate(good.values()):
        assert [[(p.lon, p.lat) for p in r] for r in got[i]] == [[tuple(map(float, p)) for p in r] for r in want], list(good)[i]
    for i, text in enumerate(broken, len(good)):
        assert got[i] is None, text


def test_long_wkt_ring(spark):
    n = 60_000
    text = "POLYGON ((" + ", ".join(f"{i * 1e-3} {i % 7}" for i in range(n)) + "))"
    row = spark.createDataFrame([(text,)], "t string").select(Z.rings_from_wkt(Z.F.col("t")).alias("g")).first()
    assert len(row.g) == 1 and len(row.g[0]) == n


def test_text_of_either_kind(spark):
    df = spark.createDataFrame([(1, '{"type": "Polygon", "coordinates": [[[0, 0], [4, 0], [4, 4]]]}'), (2, "POLYGON ((0 0, 4 0, 4 4))"), (3, "?")], "id int, geometry string")
    a, b, c = [r.geometry for r in Z.with_rings(df).orderBy("id").collect()]
    assert a == b and len(a[0]) == 3 and c is None


CASES = [
    ("sound", [ring(SQUARE), ring(HOLE)]), ("open ring", [ring(SQUARE[:-1])]), ("none", None), ("empty", []),
    ("bow-tie", [ring([(0, 0), (4, 4), (4, 0), (0, 4)])]), ("hole outside", [ring(SQUARE), ring([(3, 1), (6, 1), (6, 2), (3, 2)])]),
    ("null", [ring([(0, 0), (None, 1), (1, 1), (0, 1)])]), ("nan", [ring(SQUARE), ring([(0, 0), (float("nan"), 1), (1, 1), (0, 1)])]),
    ("off", [ring([(0, 0), (181, 0), (0, 91)])]), ("line", [ring([(0, 0), (1, 1), (0, 0)])]), ("twice", [ring([(0, 0), (0, 0), (1, 0), (1, 1)])])]


def test_problems(spark):
    df = spark.createDataFrame(CASES, f"id string, geometry {GEOM}")
    got = {tuple(r) for r in Z.zone_problems(df, "id").collect()}
    assert got == {
        ("none", None, "no geometry", 1), ("empty", None, "no geometry", 1), ("bow-tie", 0, "edges cross", 1), ("hole outside", 0, "edges cross", 2),
        ("null", 0, "vertex without a number", 1), ("nan", 1, "vertex without a number", 1), ("off", 0, "vertex off the globe", 2),
        ("line", 0, "fewer than three vertices", 1), ("twice", 0, "repeated vertex", 1)}
    with pytest.raises(ValueError, match="bow-tie: edges cross"):
        Z.check_zones(df, "id")
    sound = df.where("id in ('sound', 'open ring', 'twice')")
    assert Z.check_zones(sound, "id") is sound
    assert Z.zone_problems(df.limit(0), "id").count() == 0


def test_a_broken_vertex_is_not_left_out(spark):
    df = spark.createDataFrame([c for c in CASES if c[0] == "null"], f"CO_TAZID string, geometry {GEOM}").selectExpr("*", "1 as CO_FIPS", "1 as SUBAREAID")
    with pytest.raises(Exception, match="NULL or NaN vertex"):
        Z.zone_index(df)
