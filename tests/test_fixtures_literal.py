"""Literal cases the derived test tables do not cover (FIXTURES.md, last section)."""

from pyspark.sql import functions as F

from wayfarer.functions import codes
from wayfarer.operators.spatial import build_zone_index
from wayfarer.plans import tables as T
from wayfarer.sources import fixtures

SF = "/root/testdata/sf0.001"
GEOM = "array<array<struct<lon:double,lat:double>>>"


def _zones(spark):
    sq = [[{"lon": -113.0, "lat": 39.0}, {"lon": -110.0, "lat": 39.0}, {"lon": -110.0, "lat": 42.0},
           {"lon": -113.0, "lat": 42.0}, {"lon": -113.0, "lat": 39.0}]]
    z = spark.createDataFrame([(1, 35, 2.5, sq)], f"CO_TAZID bigint, CO_FIPS bigint, SUBAREAID double, geometry {GEOM}")
    return build_zone_index(z, "CO_TAZID", ["CO_TAZID", "CO_FIPS", "SUBAREAID"], cell_size=1.0)


def test_duplicate_followon_households_fan_out(spark):
    hh = spark.createDataFrame([(1,), (2,)], "hh_id bigint")
    fol = spark.createDataFrame([(1,), (1,)], "hh_id bigint")
    got = sorted((r.hh_id, r.completed_followon_hh) for r in T.followon_flag(hh, fol).collect())
    assert got == [(1, 1), (1, 1), (2, 0)]


def test_household_without_persons_gets_nulls(spark):
    core_hh = fixtures.load(spark, SF, "core_hh").limit(3)
    ids = [r.hh_id for r in core_hh.select("hh_id").collect()]
    persons = fixtures.load(spark, SF, "core_person").where(F.col("hh_id").isin(ids[1:]))
    fol = spark.createDataFrame([], "hh_id bigint")
    z = _zones(spark)
    out = {r.hh_id: r for r in T.build_hh(core_hh, persons, fol, z, z).collect()}
    lonely = out[ids[0]]
    assert lonely.lifecycle is None and lonely.hh_children is None and lonely.hh_seniors is None
    # zone ids: SUBAREAID 2.5 rounds half away from zero
    assert lonely.hCO_TAZID_USTMv3 == 1 and lonely.hSUBAREAID_USTMv3 == 3


def test_duplicate_persons_fan_out_through_the_range_join(spark):
    trips = fixtures.load(spark, SF, "core_trip")
    persons = fixtures.load(spark, SF, "core_person")
    one = persons.where(F.col("person_id") == trips.select(F.min("person_id")).first()[0])
    doubled = persons.unionByName(one)
    z = _zones(spark)
    out = T.build_trip_unlinked(trips, doubled, z, z)
    n_dup_trips = trips.join(one.select("person_id"), "person_id").count()
    assert out.count() == trips.count() + n_dup_trips
    assert (set(codes.TRIP_UNLINKED_DROP) - {"trip_weight"}).isdisjoint(out.columns)   # trip_weight is re-created
