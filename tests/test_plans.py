"""Tables in dependency order, views of the catalog, partitions with commits, hashes as surrogate keys, closure by doubling."""

import threading
import time

import pytest
from pyspark.sql import functions as F

from histora.operators import hierarchy, surrogate
from histora.plans import pipeline, storage
from histora.plans.partitions import PartitionedTable
from histora.plans.storage import BatchHasSuccessors, Warehouse
from histora.spec import ColumnSpec, ContractError, table
from histora.workspace import fresh_path, subfolders
from tests.test_history import SPEC, rows, run
from tests.test_storage import contract, source


# Order of tables ----------------------------------------------------------------------------------
def spec(name, *parents):
    columns = [ColumnSpec(f"{name}_bk", "int", bk=True)]
    return table(name, columns + [ColumnSpec(f"{p}_bk", "int", early_arrive_parent=p) for p in parents if p != name])


def test_layers():
    specs = [spec("d", "b", "c"), spec("c", "a"), spec("b", "a"), spec("a"), spec("x", "elsewhere")]
    assert [sorted(s.name for s in layer) for layer in pipeline.load_layers(specs)] == [["a", "x"], ["b", "c"], ["d"]]
    with pytest.raises(ContractError, match="circle: a, b"):
        pipeline.load_layers([spec("a", "b"), spec("b", "a"), spec("c")])


def test_parents_come_first_and_a_failing_one_stops_its_children_only():
    done, lock = [], threading.Lock()

    def load(s):
        if s.name == "b":
            raise RuntimeError("broken")
        with lock:
            done.append(s.name)
        return s.name

    got = pipeline.run_all([spec("e", "d"), spec("d", "b", "c"), spec("c", "a"), spec("b", "a"), spec("a"), spec("f", "c")], load)
    assert isinstance(got["b"], RuntimeError) and all(isinstance(got[n], pipeline.ParentFailed) for n in "de")
    assert "d failed" in str(got["e"]) and sorted(done) == ["a", "c", "f"] and done.index("a") < done.index("c") < done.index("f")


def test_independent_tables_are_loaded_at_the_same_time(spark):
    both, pools = threading.Barrier(2, timeout=30), set()

    def load(s):
        pools.add(spark.sparkContext.getLocalProperty("spark.scheduler.pool"))
        # passes only if the other table is being loaded as well
        both.wait()
        return spark.range(10).count()

    assert pipeline.run_all([spec("a"), spec("b")], load, spark=spark) == {"a": 10, "b": 10} and pools == {"a", "b"}
    start = []
    pipeline.run_all([spec("a"), spec("b")], lambda s: (start.append(time.time()), time.sleep(0.3)), parallel=1)
    assert start[1] - start[0] >= 0.3


# Views of the catalog -----------------------------------------------------------------------------
@pytest.mark.parametrize("buckets", [None, 2])
def test_another_session_reads_the_state_of_the_last_commit(spark, buckets):
    own = table("dim_Seen", [ColumnSpec("dim_Seen_bk", "nvarchar(20)", bk=True, pk=True), ColumnSpec("Name", "nvarchar(20)")], dummy=False)
    house = Warehouse(spark, own, fresh_path(spark, "seen"), catalog_views=True, buckets=buckets)

    def load(n, *members, steps=pipeline.STEPS):
        given = spark.createDataFrame([(k, v) for k, v in members], "dim_Seen_bk string, Name string")
        pipeline.run_scd2(given, house, n, f"2024-0{n}-01", f"2024-0{n}-01", steps=steps)

    def seen(kind):
        return rows(spark.newSession().table(f"v_dim_Seen_{kind}"), "dim_Seen_bk", "Name")

    load(1, ("a", "x"), ("b", "x"))
    assert seen("cur") == seen("cid") == seen("fhi") == [("a", "x"), ("b", "x")]
    load(2, ("a", "y"), steps=("staging", "checks", "history"))
    assert seen("cur") == [("a", "x"), ("b", "x")], "the batch is committed but not shown yet"
    load(2, ("a", "y"))
    assert seen("cur") == [("a", "y")] and seen("cid") == [("a", "y"), ("b", "x")]
    assert seen("fhi") == [("a", "x"), ("a", "y"), ("b", "x"), ("b", "x")]
    other = spark.newSession().table("v_dim_Seen_fhi")
    assert sorted(map(str, other.collect())) == sorted(map(str, house.table().collect()))


def test_catalog_views_over_replaced_ranges_and_updates(spark):
    given = contract(delta_load=True, delta_type="overlap", delta_column="Seen")
    house = Warehouse(spark, given, fresh_path(spark, "range-view"), catalog_views=True)
    pipeline.run_scd1(source(spark, *[(f"k{i}", "x", i) for i in range(10)]), house, 1, "2024-01-01")
    pipeline.run_scd1(source(spark, ("k5", "new", 5), ("m", "new", 7)), house, 2, "2024-02-01", last_value=4)
    house.update(3, "2024-03-01", stg=source(spark, ("k1", "up", 1)).withColumn("dwh_DeleteFlag", F.lit(0)))
    house.show()
    other = spark.newSession().table("v_dim_T_cid")
    assert rows(other, "dim_T_bk", "Name", "Seen") == rows(house.current(), "dim_T_bk", "Name", "Seen")
    assert ("k1", "up", 1) in rows(other, "dim_T_bk", "Name", "Seen")


def test_a_published_view_of_the_catalog(spark, tmp_path):
    storage.publish(spark.range(3), str(tmp_path / "v1"), "live_everywhere", in_catalog=True)
    other = spark.newSession()
    assert other.table("live_everywhere").count() == 3
    spark.range(5).write.parquet(str(tmp_path / "later"))
    assert other.table("live_everywhere").count() == 3
    storage.publish(spark.range(5), str(tmp_path / "v2"), "live_everywhere", in_catalog=True)
    assert other.table("live_everywhere").count() == 5


# Partitions ---------------------------------------------------------------------------------------
def test_partitions_with_commits(spark):
    own = table("fct_P", [ColumnSpec("fct_P_bk", "int", bk=True), ColumnSpec("Part", "nvarchar(9)", mandatory=False)])
    store = PartitionedTable(spark, own, fresh_path(spark, "parts"), "Part")

    def switch(n, *given):
        df = spark.createDataFrame(list(given), "fct_P_bk int, Part string")
        df = df.withColumns({"dwh_BatchRunIdInsert": F.lit(n), "dwh_DeleteFlag": F.lit(0)})
        return store.switch(df, n)

    def content(batch=None):
        return sorted((r[0], r[1] or "") for r in store.read(batch).select("fct_P_bk", "Part").collect())

    assert store.read().count() == 0
    assert len(switch(1, (1, "a"), (2, "b"), (3, None))) == 3
    switch(2, (4, "b"), (5, "c"))
    assert content() == [(1, "a"), (3, ""), (4, "b"), (5, "c")] and content(1) == [(1, "a"), (2, "b"), (3, "")]
    switch(2, (6, "a/b"))
    assert content() == [(1, "a"), (2, "b"), (3, ""), (6, "a/b")], "the repeat gives back b and takes away c"
    with pytest.raises(BatchHasSuccessors):
        switch(1, (9, "a"))
    bad = spark.createDataFrame([("no number", "a")], "fct_P_bk string, Part string")
    bad = bad.withColumns({"dwh_BatchRunIdInsert": F.lit(3), "dwh_DeleteFlag": F.lit(0)})
    with pytest.raises(Exception):  # noqa: B017 - Spark's error for the value
        store.switch(bad, 3)
    assert content() == [(1, "a"), (2, "b"), (3, ""), (6, "a/b")]
    switch(3)
    assert content() == content(2)
    assert store.rewind(2) == [3] and content() == content(2)
    switch(3, (7, "b"))
    kept = sum(len(subfolders(spark, f"{store.base}/parts/{a}")) for a in subfolders(spark, f"{store.base}/parts"))
    assert content() == [(1, "a"), (3, ""), (6, "a/b"), (7, "b")] and kept == 5


# Hashes as surrogate keys -------------------------------------------------------------------------
def test_hash_keys_collide_and_stay_unique(spark):
    df = spark.createDataFrame([(f"k{i}", i % 3) for i in range(60)] + [(None, 1)], "dim_T_bk string, v int")
    got = surrogate.assign_hash_sids(df, SPEC, ["dim_T_bk"], space=64)
    values = {r.dim_T_bk: r[SPEC.sid] for r in got.collect()}
    assert len(set(values.values())) == 61 and all(0 <= v < 64 for v in values.values())
    again = surrogate.assign_hash_sids(df.repartition(7), SPEC, ["dim_T_bk"], space=64)
    assert {r.dim_T_bk: r[SPEC.sid] for r in again.collect()} == values
    more = spark.createDataFrame([("x", 1), ("y", 2), ("z", 3)], "dim_T_bk string, v int")
    late = surrogate.assign_hash_sids(more, SPEC, ["dim_T_bk"], got.select(SPEC.sid), space=64)
    assert {r[SPEC.sid] for r in late.collect()} == set(range(64)) - set(values.values())
    with pytest.raises(surrogate.KeySpaceFull):
        surrogate.assign_hash_sids(df, SPEC, ["dim_T_bk"], space=60)
    with pytest.raises(ValueError, match="agree"):
        surrogate.assign_hash_sids(df.unionByName(df), SPEC, ["dim_T_bk"])
    assert surrogate.assign_hash_sids(df.limit(0), SPEC, ["dim_T_bk"]).count() == 0


def test_keys_given_out_are_computed_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def taken(value):
        seen.add(1)
        return value

    df = spark.createDataFrame([(f"k{i}", i) for i in range(12)], "dim_T_bk string, v int")
    # nulls, repeated values and values out of the space take no part
    held = spark.createDataFrame([(v,) for v in [*range(0, 60, 3), 0, None, None, 99]], "sid long").select(taken("sid").alias("sid"))
    got = surrogate.assign_hash_sids(df, SPEC, ["dim_T_bk"], held, space=64)
    values = {r[SPEC.sid] for r in got.collect()}
    assert len(values) == 12 and values <= set(range(64)) - set(range(0, 60, 3))
    assert seen.value == 24


def test_a_table_with_hash_keys(spark):
    house = Warehouse(spark, SPEC, fresh_path(spark, "hash"), hash_sids=True)
    run(spark, house, 1, ("a", "x"), ("b", "x"))
    before = {r["dim_T_bk"]: r[SPEC.sid] for r in house.current().collect()}
    run(spark, house, 2, ("a", "y"), ("b", "x"), ("c", "x"))
    got = house.table().collect()
    assert len({r[SPEC.sid] for r in got}) == len(got) == 5
    assert {r["dim_T_bk"]: r[SPEC.sid] for r in got if r["dwh_BatchRunIdInsert"] == 1} == before


def test_numbering_moves_no_rows(spark, tmp_path):
    spark.range(0, 1000, 1, 4).write.parquet(str(tmp_path / "a"))
    usual = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = surrogate.with_positions(spark.read.parquet(str(tmp_path / "a")), "n", 5)
        assert sorted(r.n for r in got.collect()) == list(range(6, 1006))
        assert "SortMergeJoin" not in got._jdf.queryExecution().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)


# Closure ------------------------------------------------------------------------------------------
EDGE = "child string, parent string, name string"


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    chain = spark.range(1000).selectExpr("concat('n', id + 1) AS child", "concat('n', id) AS parent", "'' AS name")
    bases = []
    monkeypatch.setattr(hierarchy, "fresh_path", lambda s, n: bases.append(fresh_path(s, n)) or bases[-1])
    got = hierarchy.hierarchy_closure(chain, "child", "parent")
    assert got.agg(F.count("*"), F.max("depth"), F.sum("depth")).first() == (500500, 1000, 167167000)
    assert len(subfolders(spark, bases[0])) <= 12


def test_closure_against_a_walk(spark):
    import random

    rng = random.Random(5)
    for several in (1, 3):
        edges = {(f"n{i}", f"n{rng.randrange(i)}") for i in range(1, 40) for _ in range(several)}
        want = {}
        for start in {p for _, p in edges}:
            level, depth = {start}, 0
            while level:
                depth += 1
                level = {c for c, p in edges if p in level}
                for c in level:
                    want.setdefault((start, c), depth)
        df = spark.createDataFrame([(c, p, "") for c, p in edges], EDGE)
        got = hierarchy.hierarchy_closure(df, "child", "parent").collect()
        assert {(r.ancestor, r.descendant): r.depth for r in got} == want and len(got) == len(want)
