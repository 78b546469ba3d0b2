"""Replacing tables with recovery, resuming a build, keys kept in step with their source, zones of repeated ids."""

import os

import pytest
from pyspark.sql import functions as F

from wayfarer.functions.columns import to_long_rounded, try_to_long_rounded
from wayfarer.plans import pipeline as P
from wayfarer.sources import fixtures

SF = "/root/testdata/sf0.001"


def configs(spark, folder):
    spark.sql("CREATE DATABASE IF NOT EXISTS wf_swap")
    return [P.BuildConfig(target=folder, suffix="_s"), P.BuildConfig(target="wf_swap", catalog=True, suffix="_s")]


def count(spark, cfg, base):
    return P._read(spark, cfg, base).count()


@pytest.mark.parametrize("mode", [0, 1])
def test_a_run_that_breaks_between_the_two_renames(spark, tmp_dir, mode, monkeypatch):
    cfg = configs(spark, tmp_dir)[mode]
    P._write(spark.range(7), cfg, "day")

    loc = cfg.location("day")
    mark = "0123456789ab"
    if cfg.catalog:
        P._rename_table(spark, loc, f"{loc}__old_{mark}")
        spark.range(9).write.saveAsTable(f"{loc}__new_{mark}")
    else:
        os.rename(loc, os.path.join(tmp_dir, f".old-{mark}-day_s"))
        spark.range(9).write.parquet(os.path.join(tmp_dir, f".new-{mark}-day_s"))
    assert not P._exists(spark, cfg, "day")
    assert P.recover(spark, cfg, "day") == "restored"
    assert count(spark, cfg, "day") == 7
    assert P.recover(spark, cfg, "day") is None
    # died after the new table had its place: only remains go
    if cfg.catalog:
        spark.range(3).write.saveAsTable(f"{loc}__old_{mark}")
    else:
        spark.range(3).write.parquet(os.path.join(tmp_dir, f".old-{mark}-day_s"))
    assert P.recover(spark, cfg, "day") == "cleared" and count(spark, cfg, "day") == 7
    left = [t.name for t in spark.catalog.listTables("wf_swap")] if cfg.catalog else os.listdir(tmp_dir)
    assert left == ["day_s"]
    if cfg.catalog:
        spark.sql(f"DROP TABLE {loc}")


def test_a_failed_rename_puts_the_old_table_back(spark, tmp_dir, monkeypatch):
    cfg = configs(spark, tmp_dir)[1]
    P._write(spark.range(7), cfg, "hh")
    rename = P._rename_table

    def broken(session, a, b):
        if "__new_" in a:
            raise RuntimeError("metastore gone")
        rename(session, a, b)
    monkeypatch.setattr(P, "_rename_table", broken)
    with pytest.raises(RuntimeError):
        P._write(spark.range(9), cfg, "hh")
    monkeypatch.undo()
    assert count(spark, cfg, "hh") == 7
    assert P.recover(spark, cfg, "hh") == "cleared"
    spark.sql(f"DROP TABLE {cfg.location('hh')}")


@pytest.mark.parametrize("mode", [0, 1])
def test_a_rerun_continues_after_the_failed_table(spark, tmp_dir, mode, monkeypatch):
    src = os.path.join(tmp_dir, "src")
    for n in ("core_day", "core_vehicle", "core_person", "core_trip"):
        fixtures.load(spark, SF, n).limit(50).write.parquet(os.path.join(src, f"{n}.parquet"))
    cfg = configs(spark, os.path.join(tmp_dir, "out"))[mode]
    cfg.resume, cfg.check_ids = True, False
    sources, tables = P.Sources.parquet_folder(spark, src), ["day", "vehicle", "person"]
    build = P.T.build_person
    monkeypatch.setattr(P.T, "build_person", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        P.run_pipeline(spark, sources, cfg, tables, log=lambda m: None)
    monkeypatch.setattr(P.T, "build_person", build)
    res = P.run_pipeline(spark, sources, cfg, tables, log=lambda m: None)
    assert res.kept == ["day", "vehicle"] and list(res.written) == ["person"]
    assert P.run_pipeline(spark, sources, cfg, tables, log=lambda m: None).kept == tables
    fixtures.load(spark, SF, "core_day").limit(60).write.mode("overwrite").parquet(os.path.join(src, "core_day.parquet"))
    res = P.run_pipeline(spark, sources, cfg, tables, log=lambda m: None)
    assert res.kept == ["vehicle", "person"] and count(spark, cfg, "day") == 60
    cfg.resume = False
    assert P.run_pipeline(spark, sources, cfg, ["day"], log=lambda m: None).kept == []
    for t in tables if cfg.catalog else []:
        spark.sql(f"DROP TABLE {cfg.location(t)}")


def test_keys_follow_the_source(spark, tmp_dir):
    rows = {"now": [(1, 10), (2, 20), (3, 30), (3, 31), (None, 5)]}
    sources = P.Sources(lambda n: spark.createDataFrame(rows["now"], "linked_trip_id long, v int"), lambda n: True, "x")
    cfg, said = P.BuildConfig(target=tmp_dir), []

    def keys():
        return {(r.linked_trip_id, r.v): r.unique_id for r in P.key_linked_trips(spark, sources, cfg, said.append).collect()}
    first = keys()
    assert len(set(first.values())) == 5 and keys() == first and not said
    rows["now"] = [(1, 11), (3, 30), (3, 31), (4, 40), (None, 5)]     # 1 changed, 2 gone, 4 new
    second = keys()
    assert second[1, 11] == first[1, 10] and {second[3, 30], second[3, 31]} == {first[3, 30], first[3, 31]}
    assert set(second) == {(1, 11), (3, 30), (3, 31), (4, 40), (None, 5)} and second[4, 40] not in first.values()
    assert len(set(second.values())) == 5 and said == ["trip_linked_with_uuid: 1 new trips, 1 gone"]
    assert keys() == second


def test_whole_numbers_in_text(spark):
    df = spark.createDataFrame([("2.0", 2.5), ("2.7", -2.5), (" 12 ", 0.4), ("x", None), (None, 1e30), ("-3", 7.0)], "t string, d double")
    got = [tuple(r) for r in df.select(try_to_long_rounded("t"), try_to_long_rounded("d")).collect()]
    assert got == [(None, 3), (None, -3), (12, 0), (None, None), (None, None), (-3, 7)]
    assert [r[0] for r in df.where("t in (' 12 ', '-3')").select(to_long_rounded("t")).collect()] == [12, -3]
    with pytest.raises(Exception, match="2.7"):
        df.where("t = '2.7'").select(to_long_rounded("t")).collect()


def test_one_zone_per_id(spark):
    from wayfarer.operators.spatial import one_zone_per_id
    rows = [(0, 1, 5, "e"), (1, 1, 3, "c"), (2, 1, None, None), (3, 2, 9, "i"), (4, None, 8, "h"), (5, None, 7, "g"), (6, 3, None, None), (7, 3, None, None)]
    df = spark.createDataFrame(rows, "k int, id long, zone int, `a` string")
    got = {r.k: (r.zone, r.a) for r in one_zone_per_id(df, "id", ["zone", "a"]).collect()}
    assert got == {0: (3, "c"), 1: (3, "c"), 2: (3, "c"), 3: (9, "i"), 4: (8, "h"), 5: (7, "g"), 6: (None, None), 7: (None, None)}
    unique = df.where("k in (0, 3, 4)")
    assert one_zone_per_id(unique, "id", ["zone", "a"]) is unique
