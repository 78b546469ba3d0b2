"""Batch rebuild: writes every table, replaces on rerun, keys are stored once."""

import os

import pytest
from pyspark.sql import functions as F

from wayfarer.functions import codes
from wayfarer.plans.pipeline import TABLE_ORDER, BuildConfig, Sources, check_inputs, run_pipeline

SF = "/root/testdata/sf0.001"


def test_pipeline_builds_and_rebuilds(spark, tmp_dir):
    cfg = BuildConfig(target=tmp_dir, prefix="b_", suffix="_v1", check_ids=False)   # a few ids repeat at this scale
    src = Sources.fixtures(spark, SF)
    res = run_pipeline(spark, src, cfg, log=lambda m: None)
    assert list(res.written) == TABLE_ORDER
    counts = {t: spark.read.parquet(loc).count() for t, loc in res.written.items()}
    assert counts["day"] == 1000 and counts["vehicle"] == 200 and counts["person"] == 1500
    assert counts["trip_unlinked"] == 6000 and counts["trip_linked"] == 6000 and counts["hh"] >= 150
    linked = spark.read.parquet(res.written["trip_linked"])
    assert linked.columns == codes.TRIP_LINKED_COLS
    # random keys: one per row, all distinct, and the keyed table is what trip_linked used
    keyed = spark.read.parquet(cfg.location("trip_linked_with_uuid"))
    assert keyed.select(F.countDistinct("unique_id")).first()[0] == keyed.count() == 6000
    assert linked.join(keyed.select("unique_id"), "unique_id", "left_anti").count() == 0
    # rerun replaces, does not append
    run_pipeline(spark, src, cfg, tables=["day"], log=lambda m: None)
    assert spark.read.parquet(res.written["day"]).count() == 1000
    assert os.path.basename(res.written["day"]) == "b_day_v1"


def test_missing_input_fails_before_work(spark, tmp_dir):
    src = Sources.parquet_folder(spark, tmp_dir)   # empty folder
    with pytest.raises(FileNotFoundError):
        check_inputs(src, ["day"])
    with pytest.raises(ValueError):
        check_inputs(src, ["not_a_table"])


def test_parquet_folder_sources(spark, tmp_dir):
    from wayfarer.sources import fixtures
    src_dir = os.path.join(tmp_dir, "src")
    for n in ["core_day", "core_vehicle"]:
        fixtures.load(spark, SF, n).write.parquet(os.path.join(src_dir, f"{n}.parquet"))
    out = os.path.join(tmp_dir, "out")
    res = run_pipeline(spark, Sources.parquet_folder(spark, src_dir), BuildConfig(target=out),
                       tables=["day", "vehicle"], log=lambda m: None)
    assert spark.read.parquet(res.written["vehicle"]).count() == 200


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0 and df.columns == codes.TRIP_LINKED_COLS


def test_config_from_env():
    cfg = BuildConfig.from_env({"TARGET_DATASET": "/x/prd", "TABLE_PREFIX": "b_", "TABLE_SUFFIX": "_v2"})
    assert cfg.location("hh") == "/x/prd/b_hh_v2"
    assert BuildConfig.from_env({"TARGET_DATASET": "prd", "TARGET_CATALOG": "1"}).location("day") == "prd.day"


def test_command_line_entry(spark, tmp_dir, monkeypatch):
    from wayfarer.plans.pipeline import main
    from wayfarer.sources import fixtures
    src_dir = os.path.join(tmp_dir, "src")
    fixtures.load(spark, SF, "core_vehicle").write.parquet(os.path.join(src_dir, "core_vehicle.parquet"))
    out = os.path.join(tmp_dir, "prd")
    monkeypatch.setenv("TARGET_DATASET", out)
    monkeypatch.setenv("TABLE_SUFFIX", "_x")
    main([src_dir, "vehicle"])
    assert spark.read.parquet(os.path.join(out, "vehicle_x")).count() == 200


def test_assert_unique_reports_repeated_keys(spark):
    from wayfarer.operators.relational import assert_unique
    df = spark.createDataFrame([(1,), (1,), (2,)], "person_id long")
    assert [r.person_id for r in assert_unique(df, ["person_id"]).collect()] == [1]


def test_catalog_sources_and_targets(spark):
    """Catalog mode: read source tables from a schema, replace target tables in another."""
    from wayfarer.sources import fixtures
    spark.sql("CREATE DATABASE IF NOT EXISTS wf_src")
    spark.sql("CREATE DATABASE IF NOT EXISTS wf_prd")
    fixtures.load(spark, SF, "core_day").write.mode("overwrite").saveAsTable("wf_src.core_day")
    cfg = BuildConfig(target="wf_prd", catalog=True, suffix="_c")
    res = run_pipeline(spark, Sources.catalog_schema(spark, "wf_src"), cfg, tables=["day"], log=lambda m: None)
    assert res.written["day"] == "wf_prd.day_c"
    assert spark.table("wf_prd.day_c").count() == 1000
    run_pipeline(spark, Sources.catalog_schema(spark, "wf_src"), cfg, tables=["day"], log=lambda m: None)
    assert spark.table("wf_prd.day_c").count() == 1000          # replaced, not appended
    with pytest.raises(FileNotFoundError):
        check_inputs(Sources.catalog_schema(spark, "wf_src"), ["vehicle"])


def test_checkpoint_dir_needs_a_shared_folder_on_a_cluster():
    """Only local mode may fall back to a temp folder; a set folder is used as is."""
    import pytest
    from types import SimpleNamespace
    from wayfarer.session import checkpoint_dir

    class Conf(dict):
        def set(self, k, v):
            self[k] = v

    def fake(master, conf, already=None):
        return SimpleNamespace(conf=Conf(conf), sparkContext=SimpleNamespace(
            master=master, getCheckpointDir=lambda: already, setCheckpointDir=lambda d: None))

    for master in ("spark://cluster:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            checkpoint_dir(fake(master, {}))
    assert checkpoint_dir(fake("yarn", {}, "hdfs:///given")) == "hdfs:///given"
    assert checkpoint_dir(fake("yarn", {"spark.checkpoint.dir": "hdfs:///ckpt"})) == "hdfs:///ckpt"


def _linked_sources(spark, folder):
    from wayfarer.sources import fixtures
    for name, relation in (("trip_linked", "trip_linked_src"), ("core_trip", "core_trip"), ("taz_v3", "taz_v3"), ("taz_v4", "taz_v4")):
        fixtures.load(spark, SF, relation).write.parquet(os.path.join(folder, f"{name}.parquet"))
    return Sources.parquet_folder(spark, folder)


def test_rebuilds_keep_the_surrogate_ids(spark, tmp_dir):
    src = _linked_sources(spark, os.path.join(tmp_dir, "src"))
    cfg = BuildConfig(target=os.path.join(tmp_dir, "out"), check_ids=False)

    def ids(cfg):
        res = run_pipeline(spark, src, cfg, tables=["trip_linked"], log=lambda m: None)
        return {r.unique_id for r in spark.read.parquet(res.written["trip_linked"]).select("unique_id").collect()}

    first = ids(cfg)
    assert len(first) == 6000 and ids(cfg) == first
    assert not ids(BuildConfig(target=cfg.target, rekey=True, check_ids=False)) & first


def test_no_output_replaces_an_input(spark, tmp_dir):
    src = _linked_sources(spark, tmp_dir)
    before = sorted(os.listdir(tmp_dir))
    for target, prefix, suffix in ((tmp_dir, "", ".parquet"), (tmp_dir + "/../" + os.path.basename(tmp_dir), "", ".parquet"),
                                   ("file:" + tmp_dir, "", ".parquet"), (os.path.dirname(tmp_dir), os.path.basename(tmp_dir) + "/", ".parquet")):
        with pytest.raises(ValueError, match="must differ"):
            run_pipeline(spark, src, BuildConfig(target=target, prefix=prefix, suffix=suffix), tables=["trip_linked"], log=lambda m: None)
    assert sorted(os.listdir(tmp_dir)) == before
    spark.sql("CREATE DATABASE IF NOT EXISTS wf_same")
    for n in ("trip_linked", "core_trip", "taz_v3", "taz_v4"):
        src(n).write.mode("overwrite").saveAsTable(f"wf_same.{n}")
    with pytest.raises(ValueError, match="must differ"):
        run_pipeline(spark, Sources.catalog_schema(spark, "wf_same"), BuildConfig(target="WF_SAME", catalog=True),
                     tables=["trip_linked"], log=lambda m: None)
    assert "Model_Purpose" in spark.table("wf_same.trip_linked").columns


def test_failed_build_leaves_the_old_table(spark, tmp_dir):
    from wayfarer.plans.pipeline import _write
    spark.sql("CREATE DATABASE IF NOT EXISTS wf_prd")
    bad = spark.range(100).select(F.when(F.col("id") > 90, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).alias("id"))
    for cfg in (BuildConfig(target=tmp_dir), BuildConfig(target="wf_prd", catalog=True, suffix="_f")):
        loc = _write(spark.range(7), cfg, "day")
        with pytest.raises(Exception, match="broken"):
            _write(bad, cfg, "day")
        assert (spark.table(loc) if cfg.catalog else spark.read.parquet(loc)).count() == 7
        _write(spark.range(9), cfg, "day")
        assert (spark.table(loc) if cfg.catalog else spark.read.parquet(loc)).count() == 9
    assert os.listdir(tmp_dir) == ["day"]
    assert not [t.name for t in spark.catalog.listTables("wf_prd") if "__new_" in t.name]


def test_repeated_trip_ids_are_refused(spark, tmp_dir):
    from wayfarer.plans.pipeline import check_ids
    once = spark.createDataFrame([(1, 1), (2, 2), (None, None), (None, None)], "trip_id long, linked_trip_id long")
    check_ids(Sources(lambda n: once, lambda n: True, "x"), ["trip_unlinked", "trip_linked"])
    for table in ("trip_unlinked", "trip_linked"):
        with pytest.raises(ValueError, match="repeats"):
            check_ids(Sources(lambda n: once.unionByName(once), lambda n: True, "x"), [table])


def test_cluster_defaults_respect_the_session(spark):
    from wayfarer.session import CLUSTER_DEFAULTS, apply_cluster_defaults
    before = {k: spark.conf.get(k, None) for k in CLUSTER_DEFAULTS}
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "7m")
    try:
        apply_cluster_defaults(spark)
        assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "7m"
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "256m"
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
