import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from histora.functions import scalars as sc
from histora.functions.calendar import year_month_dim
from histora.operators import checks, groups, hierarchy, lookup, surrogate
from histora.plans import pipeline, storage, views
from histora.plans.storage import Warehouse
from histora.sources import conform, empty_source, is_shell, source_or_shell
from histora.spec import ColumnSpec, ContractError, table
from histora import workspace
from histora.workspace import fresh_path, shared_root

SPEC = table(
    "dim_K",
    [
        ColumnSpec("dim_K_bk", "nvarchar(5)", bk=True, pk=True),
        ColumnSpec("Day", "date"),
        ColumnSpec("dim Person_bk", "nvarchar(5)"),
    ],
)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def one(spark, *values):
    return [r for r in spark.range(1).select(*[v.alias(f"c{i}") for i, v in enumerate(values)]).first()]


def test_scalars(spark):
    ts = F.lit("2024-03-31 02:30:59.9").cast("timestamp_ntz")
    assert one(spark, sc.date_key(ts), sc.time_key(ts), sc.closing_ts(sc.moment("2024-01-01"))) == [
        "2024-03-31", "02:30:59", dt.datetime(2023, 12, 31, 23, 59, 59),
    ]
    null = F.lit(None).cast("timestamp_ntz")
    assert one(spark, sc.date_key(null), sc.time_key(null)) == [None, None]
    assert one(spark, sc.composite_bk(F.lit("S"), F.lit(None), F.lit(3)), sc.padded_id(F.lit(3439499))) == ["S|-1|3", "0003439499"]
    assert one(spark, sc.padded_id(F.lit(12345678901))) == ["12345678901"]
    a, b = F.lit("2024-01-01").cast("date"), F.lit("2024-01-03").cast("date")
    assert one(spark, sc.length_of_stay(a, b), sc.duration("hour", a, b), sc.duration("day", b, a)) == [3, 48, -2]
    assert sc.whole_seconds(dt.datetime(2024, 1, 1, 0, 0, 0, 500000)) == dt.datetime(2024, 1, 1, 0, 0, 1)
    with pytest.raises(ValueError):
        sc.duration("week", a, b)


def test_keys_do_not_depend_on_the_time_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Zurich")
    try:
        a, b = sc.moment("2024-03-31 02:30:00"), sc.moment("2024-03-31 04:30:00")  # an hour that zone skips
        assert one(spark, sc.time_key(a), sc.duration("second", a, b)) == ["02:30:00", 7200]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_sources(spark, tmp_path):
    assert empty_source(spark, SPEC).count() == 0
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        source_or_shell(spark, SPEC, str(tmp_path / "none"))
    shell = source_or_shell(spark, SPEC, str(tmp_path / "none"), allow_shell=True)
    assert [(f.name, f.dataType) for f in shell.schema] == [(f.name, f.dataType) for f in SPEC.source_schema()]
    empty = spark.createDataFrame([], SPEC.source_schema())
    assert is_shell(shell) and not is_shell(empty) and shell.unionByName(empty).count() == 0
    raw = spark.createDataFrame([(1, "2024-01-01", "p", 0)], ["dim_K_bk", "Day", "dim Person_bk", "extra"])
    assert rows(conform(raw, SPEC)) == [("1", dt.date(2024, 1, 1), "p")]
    with pytest.raises(ContractError, match="Day"):
        conform(raw.drop("Day"), SPEC)
    assert rows(conform(raw.drop("Day"), SPEC, missing="null")) == [("1", None, "p")]
    raw.write.parquet(str(tmp_path / "there"))
    assert source_or_shell(spark, SPEC, str(tmp_path / "there")).count() == 1


def test_names_with_blanks_load(spark):
    house = Warehouse(spark, SPEC, fresh_path(spark, "blank"))
    for n, person in ((1, "p"), (2, "q")):
        source = spark.createDataFrame([("a", dt.date(2024, 1, 1), person)], ["dim_K_bk", "Day", "dim Person_bk"])
        pipeline.run_scd2(source, house, n, f"2024-0{n}-01", f"2024-0{n}-01")
    assert house.table().count() == 3
    assert spark.table("v_dim_K_cur").count() == 2 and spark.table("v_dim_K_fhi").count() == 3


def test_checks(spark):
    df = spark.createDataFrame(
        [("a", None, None, None), ("toolong", "2024-01-01", "2024-01-01", "p"), ("a", "2024-01-01", "2024-01-01x", "p")],
        "dim_K_bk string, Day string, dim_Date_Day_bk string, `dim Person_bk` string",
    )
    assert rows(checks.check_not_null(df, SPEC)) == [("Day", "a"), ("dim Person_bk", "a"), ("dim_Date_Day_bk", "a")]
    assert rows(checks.check_length(df, SPEC)) == [("dim_Date_Day_bk", "a"), ("dim_K_bk", "toolong")]
    assert rows(checks.check_unique_key(df, ["dim_K_bk"])) == [("a", 2)]


def test_positions_are_dense_and_ordered(spark):
    df = spark.range(0, 5000, 1, 7).select(F.pmod(F.col("id") * 7919, F.lit(5003)).alias("k"), F.lit("x").alias("v"))
    path = fresh_path(spark, "pos")
    surrogate.write_in_order(df, ["k"], path)
    placed = surrogate.with_positions(spark.read.parquet(path), start=10)
    got = [(r.k, r.position) for r in placed.orderBy("k").collect()]
    assert [p for _, p in got] == list(range(11, 5011))


def test_copies_of_one_row_are_spread(spark):
    """All rows alike: the ordered write still uses several files."""
    path = fresh_path(spark, "pos")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        surrogate.write_in_order(spark.range(4000).select(F.lit(1).alias("k")), ["k"], path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = spark.read.parquet(path).groupBy(F.col("_metadata.file_name")).count().collect()
    assert len(files) > 1 and max(f["count"] for f in files) < 4000
    placed = surrogate.with_positions(spark.read.parquet(path))
    assert placed.agg(F.min("position"), F.max("position"), F.countDistinct("position")).first() == (1, 4000, 4000)


def test_positions_without_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    path = fresh_path(spark, "pos")
    spark.range(0, 100, 1, 4).write.parquet(path)
    try:
        placed = surrogate.with_positions(spark.read.parquet(path))
        assert sorted(r.position for r in placed.collect()) == list(range(1, 101))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_first_last_flags(spark):
    df = spark.createDataFrame([(1, "g", 1), (2, "g", 1), (3, "g", 5), (4, "h", 2), (5, None, 1)], "id int, g string, o int")
    out = groups.first_last_flags(df, "g", "o", "id").select("id", "IsFirst_Flag", "IsLast_Flag")
    assert rows(out) == [(1, "1", "0"), (2, "0", "0"), (3, "0", "1"), (4, "1", "1"), (5, "-1", "-1")]


def test_current_of_sequence(spark):
    df = spark.createDataFrame(
        [(1, "a", "2020-01-01", "2020-12-31"), (2, "a", "2021-01-01", "2021-12-31"), (3, "b", "2020-01-01", "2029-12-31"),
         (4, "b", "2030-01-01", "2031-12-31"), (5, "c", "2030-01-01", "2031-12-31")],
        "id int, k string, f string, t string",
    )
    out = groups.current_of_sequence(df, ["k"], "f", "t", "2024-01-01", "id").select("id", "Current_flag")
    assert rows(out) == [(1, "0"), (2, "1"), (3, "1"), (4, "0"), (5, "0")]


def test_a_sequence_with_an_open_row_has_not_ended(spark):
    df = spark.createDataFrame(
        [(1, "a", "2020-01-01", "2020-12-31"), (2, "a", "2021-01-01", None), (3, "b", "2030-01-01", None), (4, "b", "2020-01-01", "2020-12-31")],
        "id int, k string, f string, t string",
    )
    out = groups.current_of_sequence(df, ["k"], "f", "t", "2024-01-01", "id").select("id", "Current_flag")
    assert rows(out) == [(1, "0"), (2, "1"), (3, "0"), (4, "0")]


def test_flags_of_ties_and_missing_order(spark):
    df = spark.createDataFrame([(1, "g", None), (2, "g", 4), (3, "g", 4), (4, "h", None), (5, "h", None)], "id int, g string, o int")
    out = groups.first_last_flags(df, "g", "o", "id").select("id", "IsFirst_Flag", "IsLast_Flag")
    assert rows(out) == [(1, "1", "0"), (2, "0", "0"), (3, "0", "1"), (4, "1", "0"), (5, "0", "1")]


def test_many_children_are_numbered_without_a_bound(spark):
    df = spark.range(1500).select(F.lit(1).alias("k"), (-F.col("id")).alias("o"), F.col("id").alias("v"))
    got = groups.number_children(df, ["k"], ["o"], ["v"]).collect()
    assert sorted((r.position, r.v) for r in got) == [(i + 1, 1499 - i) for i in range(1500)]
    with pytest.raises(TypeError):
        groups.nest_children(df, ["k"], ["o"], ["v"])


def test_plans_of_groups_and_codes(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(100).select(F.col("id"), (F.col("id") % 7).alias("g"), (F.col("id") % 5).alias("o"))
        days = df.select("id", "g", F.to_date(F.lit("2024-01-01")).alias("f"), F.to_date(F.lit("2024-02-01")).alias("t"))
        plan = lambda d: d._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan(groups.first_last_flags(df, "g", "o", "id"))
        assert "SortAggregate" not in plan(groups.current_of_sequence(days, ["g"], "f", "t", "2024-03-01", "id"))
        codes = spark.createDataFrame([("A", "alpha"), ("A01", "one")], "code string, name string")
        assert plan(lookup.code_levels(codes, "code", "name")).count("Exchange hashpartitioning") <= 4
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_parent_child_days(spark):
    parent = spark.createDataFrame([(1, dt.date(2024, 1, 1))], "k int, p date")
    child = spark.createDataFrame([(1, dt.date(2024, 1, 5)), (2, dt.date(2024, 1, 5))], "k int, c date")
    out = groups.parent_child_days(parent, child, "k", "p", "c")
    assert {r.k: r.days_between for r in out.collect()} == {1: 4, 2: None}


def test_nested_lists_stay_bounded(spark):
    """One parent holds most rows, many of them copies, and some rows have no parent."""
    big = spark.range(500).select(F.lit("big").alias("k"), (F.col("id") % 3).alias("o"), F.lit("same").alias("v"))
    small = spark.createDataFrame([("s", 2, "b"), ("s", 1, "a"), (None, 1, "x")], "k string, o long, v string")
    out = groups.nest_children(big.unionByName(small), ["k"], ["o"], ["o", "v"], part_size=64)
    got = out.collect()
    assert max(r.n_children for r in got) == 64 and sum(r.n_children for r in got) == 503
    assert [tuple(c) for r in got if r.k == "s" for c in r.children] == [(1, "a"), (2, "b")]
    order = [c["o"] for r in sorted((r for r in got if r.k == "big"), key=lambda r: r.part_no) for c in r.children]
    assert order == sorted(order) and len(order) == 500


def test_lookups(spark):
    df = spark.createDataFrame([(1, 10.0), (2, 10.0), (None, 1.0)], "id int, v double")
    mapping = spark.createDataFrame([("S", 1, "c1"), ("T", 2, "c2")], "sys string, id int, code string")
    out = lookup.map_codes(df, mapping, {"id": "id"}, "code", {"sys": "S"})
    assert {r.id: r.code for r in out.collect()} == {1: "c1", 2: "-1", None: "-1"}
    factors = spark.createDataFrame([(1, 2.0, 1, 1), (2, 3.0, 2, 1)], "id int, f double, a int, b int")
    out = lookup.recalculate_units(df, factors, ["id"], "v", "f", ["a", "b"])
    assert {r.id: r.StandardValue for r in out.collect()} == {1: 20.0, 2: None, None: None}


def test_a_mapping_must_not_multiply_rows(spark):
    df = spark.createDataFrame([(1, 10.0), (2, 10.0)], "id int, v double")
    same = spark.createDataFrame([(1, "c1"), (1, "c1"), (None, "c0"), (None, "c9")], "id int, code string")
    assert {r.id: r.code for r in lookup.map_codes(df, same, {"id": "id"}, "code").collect()} == {1: "c1", 2: "-1"}
    two = spark.createDataFrame([(1, "c1"), (1, "c2")], "id int, code string")
    with pytest.raises(Exception, match="several entries for 1"):
        lookup.map_codes(df, two, {"id": "id"}, "code").collect()
    factors = spark.createDataFrame([(1, 2.0, 1), (1, 3.0, 1)], "id int, f double, a int")
    with pytest.raises(Exception, match="several entries for 1"):
        lookup.recalculate_units(df, factors, ["id"], "v", "f", ["a"]).collect()


def test_code_levels(spark):
    codes = spark.createDataFrame([("A", "alpha"), ("A01", "one"), ("A01B", "bee"), ("XX", "odd")], "code string, name string")
    got = {r.code: r for r in lookup.code_levels(codes, "code", "name").collect()}
    bee = got["A01B"]
    assert (bee.LevelNumber, bee.Level00, bee.CodeLevel01, bee.Level02, bee.CodeLevel03) == (2, "alpha", "A01", "bee", "-1")
    assert got["XX"].LevelNumber is None and got["XX"].Level00 == "#NA#"


EDGE = "child string, parent string, name string"


def test_closure_of_a_tree_and_of_several_parents(spark):
    tree = spark.createDataFrame([("b", "a", "B"), ("c", "b", "C"), ("a", None, "A")], EDGE)
    assert rows(hierarchy.hierarchy_closure(tree, "child", "parent")) == [
        ("a", "b", 1, "1", "0"), ("a", "c", 2, "1", "1"), ("b", "c", 1, "0", "1"),
    ]
    poly = tree.unionByName(spark.createDataFrame([("c", "a", "C")], EDGE))
    assert ("a", "c", 1, "1", "1") in rows(hierarchy.hierarchy_closure(poly, "child", "parent"))
    assert hierarchy.hierarchy_closure(poly, "child", "parent").count() == 3


def test_cycles_are_reported(spark):
    loop = spark.createDataFrame([("b", "a", "B"), ("a", "b", "A")], EDGE)
    with pytest.raises(hierarchy.HierarchyCycle):
        hierarchy.hierarchy_closure(loop, "child", "parent")
    twice = spark.createDataFrame([("b", "a", "B"), ("c", "b", "C"), ("c", "a", "C"), ("a", "c", "A"), ("d", "c", "D")], EDGE)
    with pytest.raises(hierarchy.HierarchyCycle):
        hierarchy.hierarchy_closure(twice, "child", "parent")


def test_depth_has_no_bound(spark):
    chain = spark.createDataFrame([(f"n{i + 1:02d}", f"n{i:02d}", "x") for i in range(40)], EDGE).coalesce(1)
    got = hierarchy.hierarchy_closure(chain, "child", "parent").collect()
    assert len(got) == 40 * 41 // 2 and max(r.depth for r in got) == 40


def test_shortest_distance_where_ways_differ(spark):
    ways = spark.createDataFrame([("b", "a", ""), ("c", "b", ""), ("d", "c", ""), ("d", "a", ""), ("e", "d", "")], EDGE)
    got = {(r.ancestor, r.descendant): r.depth for r in hierarchy.hierarchy_closure(ways, "child", "parent").collect()}
    assert got["a", "d"] == 1 and got["a", "e"] == 2 and got["b", "e"] == 3 and len(got) == 10


def test_flatten_keeps_lost_nodes_and_missing_names(spark):
    edges = spark.createDataFrame(
        [("b", "a", None), ("c", "b", "C"), ("y", "x", "Y"), ("p", "q", "P"), ("q", "p", "Q")], EDGE
    )
    roots = spark.createDataFrame([("a", "A")], "child string, name string")
    out = hierarchy.hierarchy_flatten(edges, "child", "parent", "name", roots, levels=3)
    got = {r.node: (r.LevelNumber, r.TreeVector, r.CodeLevel01, r.Level01) for r in out.collect()}
    lost = (None, None, None, None)
    assert got == {
        "a": (0, "A", None, None), "b": (1, "A|#NA#", "b", None), "c": (2, "A|#NA#|C", "b", None),
        "x": lost, "y": lost, "p": lost, "q": lost,
    }
    chain = spark.createDataFrame([("b", "a", "B"), ("c", "b", "C")], EDGE)
    with pytest.raises(hierarchy.HierarchyTooDeep):
        hierarchy.hierarchy_flatten(chain, "child", "parent", "name", roots, levels=2)


def test_flatten_gives_a_row_per_path(spark):
    edges = spark.createDataFrame([("b", "a", "B"), ("c", "b", "C"), ("c", "a", "C"), ("c", "a", "C")], EDGE)
    roots = spark.createDataFrame([("a", "A")], "child string, name string")
    out = hierarchy.hierarchy_flatten(edges, "child", "parent", "name", roots, levels=4)
    got = rows(out.select("node", "LevelNumber", "TreeVector", "CodeLevel01", "Level02"))
    assert got == [
        ("a", 0, "A", None, None), ("b", 1, "A|B", "b", None), ("c", 1, "A|C", "c", None), ("c", 2, "A|B|C", "b", "C"),
    ]


def test_calendar(spark):
    got = rows(year_month_dim(spark, "2023-12-15", "2024-03-01").select("YearMonth", "Month"))
    assert got == [(202312, "Dezember"), (202401, "Januar"), (202402, "Februar"), (202403, "März")]


def test_sinks(spark, tmp_path):
    path = str(tmp_path / "parts")
    storage.switch_partition(spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string"), path, ["p"])
    storage.switch_partition(spark.createDataFrame([(3, "b"), (4, "c")], "v int, p string"), path, ["p"])
    assert rows(spark.read.parquet(path).select("v", "p")) == [(1, "a"), (3, "b"), (4, "c")]
    locked = table("dim_L", [ColumnSpec("dim_L_bk", "int", bk=True)], protect=True)
    with pytest.raises(storage.ProtectedTable):
        storage.switch_partition(spark.range(1), path, ["id"], locked)
    with pytest.raises(storage.ProtectedTable):
        storage.archive_table(spark, "anything", "1", locked)
    assert storage.archive_table(spark, "nothing_here", "1") is None
    storage.publish(spark.range(3), str(tmp_path / "v1"), "live")
    storage.publish(spark.range(5), str(tmp_path / "v2"), "live")
    assert spark.table("live").count() == 5
    steps = [lambda d: d.filter("id > 0"), lambda d: d.withColumn("x", F.col("id") * 2)]
    assert rows(storage.chain(spark.range(3), steps)) == rows(storage.chain(spark.range(3), steps, keep_steps=False))


def test_archived_table_keeps_its_rows(spark):
    spark.range(4).write.saveAsTable("dim_old")
    aside = storage.archive_table(spark, "dim_old", "20240101000000")
    assert aside == "xxx_dim_old_20240101000000" and spark.table(aside).count() == 4
    assert not spark.catalog.tableExists("dim_old")


def test_full_reload_has_no_history(spark):
    house = Warehouse(spark, SPEC, fresh_path(spark, "reload"))
    for n, keys in ((1, "ab"), (2, "bcd")):
        source = spark.createDataFrame([(k, dt.date(2024, 1, 1), "p") for k in keys], ["dim_K_bk", "Day", "dim Person_bk"])
        pipeline.run_full_reload(source, house, n, "2024-01-01")
    stored = house.table()
    assert rows(stored.select("dim_K_bk")) == [("-1",), ("b",), ("c",), ("d",)]
    assert rows(stored.select(SPEC.sid)) == [(1,), (2,), (3,), (4,)]
    assert views.view_cur(stored, SPEC).count() == 4


def test_a_protected_table_is_not_replaced(spark):
    house = Warehouse(spark, SPEC, fresh_path(spark, "kept"))
    source = spark.createDataFrame([("a", dt.date(2024, 1, 1), "p")], ["dim_K_bk", "Day", "dim Person_bk"])
    pipeline.run_full_reload(source, house, 1, "2024-01-01")
    locked = Warehouse(spark, table("dim_K", SPEC.columns, protect=True, table_type="reload"), house.base)
    for run in (pipeline.run_full_reload, pipeline.run_table):
        with pytest.raises(storage.ProtectedTable):
            run(source.limit(0), locked, 2)
    assert house.table().count() == 2


def test_a_text_that_is_too_long_is_refused(spark):
    house = Warehouse(spark, SPEC, fresh_path(spark, "long"))
    source = spark.createDataFrame([("a", dt.date(2024, 1, 1), "far too long")], ["dim_K_bk", "Day", "dim Person_bk"])
    for spec_type in ("scd2", "reload"):
        other = Warehouse(spark, table("dim_K", SPEC.columns, table_type=spec_type), house.base)
        with pytest.raises(checks.ConstraintViolation, match="dim Person_bk"):
            pipeline.run_table(source, other, 1)
    assert house.last_batch() is None


def test_one_failing_table_does_not_stop_the_others():
    specs = [table(n, [ColumnSpec("k_bk", "int", bk=True)]) for n in ("dim_A", "dim_B", "fct_C")]

    def run(spec):
        if spec.name == "dim_A":
            raise RuntimeError("broken")
        return spec.name

    got = pipeline.run_all(specs, run, "dim_*")
    assert set(got) == {"dim_A", "dim_B"} and isinstance(got["dim_A"], RuntimeError) and got["dim_B"] == "dim_B"


def test_shared_folder_comes_from_the_session(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")


def test_scratch_can_be_cleared(spark, monkeypatch):
    monkeypatch.setattr(workspace, "_MADE", [])
    kept = workspace.materialise(spark, "scratch", spark.range(3))
    assert kept.count() == 3 and len(workspace._MADE) == 1
    path = workspace._MADE[0]
    assert workspace.exists(spark, path) and workspace.clear_scratch(spark) == 1 and not workspace.exists(spark, path)
