"""Plan shape: no nested-loop/cartesian joins, no Python UDFs, shared windows."""

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
FORBIDDEN = ["BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["day", "vehicle", "person", "hh", "trip_unlinked", "trip_linked"])
def test_tables_have_no_forbidden_operators(spark, name):
    p = plan(E.queries()[name](spark, SF))
    for f in FORBIDDEN:
        assert f not in p, f"{name}: {f} in plan"


def test_activity_gap_is_one_window(spark):
    """Without a hot person the LAG is one plain window over one shuffle."""
    p = plan(E.queries()["activity_gap"](spark, SF))
    assert p.count("Window [") == 1


def test_dedup_limits_before_shuffle(spark):
    df = E.queries()["trip_dedup_first"](spark, SF)
    p = df._jdf.queryExecution().sparkPlan().toString()
    assert "WindowGroupLimit" in p and "Partial" in p


def test_zone_lookups_do_not_shuffle_points(spark):
    """No exchange but the index's broadcasts lies between the lookups and the fixture's own join."""
    p = plan(E.queries()["zone_intersects_origin"](spark, SF)).split("\n")
    own = next(i for i, line in enumerate(p) if "Join" in line and "l_orderkey" in line)
    above = [line for line in p[:own] if "Exchange" in line and "BroadcastExchange" not in line]
    index = [line for line in above if "hashpartitioning(cx" in line]
    assert any("BroadcastHashJoin [__cx" in line for line in p[:own])
    assert above == index, above


def test_parquet_scans_are_pruned(spark):
    df = E.queries()["segment_clean"](spark, SF)
    p = plan(df)
    assert "ReadSchema: struct<p_partkey:bigint>" in p


def test_contract_keys_match():
    from wayfarer.plans.oracle import ORACLE_SQL
    from wayfarer.plans.queries import registry
    assert set(registry()) == set(ORACLE_SQL)
    assert set(E.oracle_sql()) <= set(E.queries())


def test_no_row_is_copied_before_the_dedup(spark):
    """The six-key match: partial limit, exchange, final limit, window; copies for hot keys only after it."""
    for hot in ("1000000", "2"):
        spark.conf.set("wayfarer.skew.hotKeyRows", hot)
        spark.conf.set("wayfarer.skew.sampleFraction", "1.0")
        try:
            p = plan(E.queries()["composite_trip_join"](spark, SF))
        finally:
            spark.conf.unset("wayfarer.skew.hotKeyRows")
            spark.conf.unset("wayfarer.skew.sampleFraction")
        assert p.count("WindowGroupLimit") == 2
        below = p[p.index("WindowGroupLimit"):]
        assert "Generate" not in below and "isnotnull" in below
        assert ("Generate explode" in p) == (hot == "2")


def test_drive_work_reads_only_needed_trip_columns(spark):
    """The per-person work-trip count/sum reads five of lineitem's columns, not all of them."""
    import re
    p = plan(E.queries()["drive_work_by_person"](spark, SF))
    schemas = re.findall(r"ReadSchema: struct<(l_[^>]*)>", p)
    assert schemas, p
    for s in schemas:
        cols = {c.split(":")[0] for c in s.split(",")}
        assert cols <= {"l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity"}, s


def _nodes(node):
    yield node
    for k in range(node.children().size()):
        yield from _nodes(node.children().apply(k))


@pytest.mark.parametrize("name, key", [("trip_linked", "__u_day_id"), ("trip_linked", "__cx"), ("trip_unlinked", "__cx")])
def test_passthrough_columns_travel_as_one_struct(spark, name, key):
    """Joins and lookups do not copy the wide trip rows column by column."""
    df = E.queries()[name](spark, SF)
    joins = [n for n in _nodes(df._jdf.queryExecution().optimizedPlan()) if n.nodeName() == "Join" and key in n.condition().toString()]
    assert joins and all(n.output().size() <= 60 for n in joins), [n.output().size() for n in joins]


def test_method_limit_is_set_unless_the_session_has_one(spark):
    from wayfarer.session import limit_methods
    key = "spark.sql.codegen.hugeMethodLimit"
    other = spark.newSession()
    other.conf.set(key, "5000")
    limit_methods(other)
    assert other.conf.get(key) == "5000"
    E.queries()["day"](spark, SF)
    assert spark.conf.get(key) == "8000"
