"""What batches write and exchange, deltas at their boundary, keys under a collation."""

import random
import re

import pytest
from pyspark.sql import functions as F

from histora.operators import history as h
from histora.operators import staging as st
from histora.operators.checks import check_unique_key
from histora.operators.early import early_members
from histora.operators.type1 import delta_load
from histora.plans import pipeline
from histora.plans.storage import Warehouse
from histora.spec import ColumnSpec, table
from histora.workspace import fresh_path
from tests.test_history import SPEC, content, delivery, rows, run

CI = "UTF8_LCASE_RTRIM"


def contract(**flags):
    columns = [
        ColumnSpec("dim_T_bk", "nvarchar(20)", bk=True, pk=True),
        ColumnSpec("Name", "nvarchar(20)"),
        ColumnSpec("Seen", "bigint", mandatory=False),
    ]
    return table("dim_T", columns, table_type="scd1", delete_detection=False, dummy=False, **flags)


def source(spark, *rows_):
    return spark.createDataFrame(list(rows_), "dim_T_bk string, Name string, Seen long")


def written(house, batch):
    found = house._folders([house.commits()[batch]]).groupBy("dwh_action").count().collect()
    return {r["dwh_action"]: r["count"] for r in found}


@pytest.mark.parametrize(("after", "narrow"), [(0, 0), (20, 0), (20, 10**6)])
def test_a_delta_of_one_row_writes_one_row(spark, after, narrow):
    spec = contract(delta_load=True, delta_column="Seen")
    house = Warehouse(spark, spec, fresh_path(spark, "one"), rewrite_after=after, narrow_from=narrow)
    many = [(f"k{i:03}", "x", i) for i in range(100)]
    pipeline.run_scd1(source(spark, *many), house, 1, "2024-01-01")
    pipeline.run_scd1(source(spark, ("k007", "new", 500)), house, 2, "2024-02-01")
    pipeline.run_scd1(source(spark, ("k007", "x", 600), ("z", "z", 601)), house, 3, "2024-03-01")
    want = sorted([(k, n, s) if k != "k007" else (k, "x", 600) for k, n, s in many] + [("z", "z", 601)])
    assert rows(house.current(), "dim_T_bk", "Name", "Seen") == want
    assert rows(house.current(2).filter("Name = 'new'"), "dim_T_bk", "Seen") == [("k007", 500)]
    row = house.current().filter("dim_T_bk = 'k007'").first()
    assert (row["dwh_BatchRunIdInsert"], row["dwh_BatchRunIdUpdate"]) == (1, 3)
    sids = {r[0]: r[1] for r in house.current().select("dim_T_bk", spec.sid).collect()}
    assert sids["k007"] == house.current(2).filter("dim_T_bk = 'k007'").first()[spec.sid] and len(set(sids.values())) == 101
    if after:
        assert written(house, 2) == {"open": 1, "drop": 1} and written(house, 3) == {"open": 2, "drop": 1}
        # of the replaced image only its key is kept
        drop = house._folders([house.commits()[2]]).filter("dwh_action = 'drop'").first()
        assert drop["dim_T_bk"] == "k007" and drop["Name"] is None and drop["dwh_ValidFrom"] is None


@pytest.mark.parametrize("after", [1, 20])
def test_values_that_go_and_come_back(spark, after):
    house = Warehouse(spark, contract(), fresh_path(spark, "back"), rewrite_after=after, retain=5, narrow_from=0)
    states = [("a", "x"), ("a", "y"), ("a", "x"), ("a", "x"), ("a", "y")]
    for n, (key, name) in enumerate(states, 1):
        pipeline.run_scd1(source(spark, (key, name, 1), ("b", "b", 1)), house, n, f"2024-0{n}-01")
        assert rows(house.current(), "dim_T_bk", "Name") == [(key, name), ("b", "b")]
    for n, state in enumerate(states[1:], 2):
        if after == 20:
            assert rows(house.current(n), "dim_T_bk", "Name") == [state, ("b", "b")]
    house.rewind(3)
    assert rows(house.current(), "dim_T_bk", "Name") == [("a", "x"), ("b", "b")]
    pipeline.run_scd1(source(spark, ("a", "z", 1)), house, 4, "2024-04-01")
    house.rewrite()
    assert rows(Warehouse(spark, house.spec, house.base).current(), "dim_T_bk", "Name") == [("a", "z"), ("b", "b")]


def test_a_replaced_range_is_not_rewritten(spark):
    spec = contract(delta_load=True, delta_type="overlap", delta_column="Seen")
    house = Warehouse(spark, spec, fresh_path(spark, "range"), retain=5)
    pipeline.run_scd1(source(spark, *[(f"k{i}", "x", i) for i in range(10)]), house, 1, "2024-01-01")
    pipeline.run_scd1(source(spark, ("k5", "new", 5), ("m", "new", 7)), house, 2, "2024-02-01", last_value=4)
    pipeline.run_scd1(source(spark, ("late", "late", 7), ("n", "n", 20)), house, 3, "2024-03-01")
    kept = [(f"k{i}", "x", i) for i in (0, 1, 2, 3, 4, 8, 9)]
    assert rows(house.current(2), "dim_T_bk", "Name", "Seen") == sorted(kept + [("k5", "new", 5), ("m", "new", 7)])
    # 7 was where the third load starts: the late row is taken, the rows that were loaded with it stay
    assert rows(house.current(), "dim_T_bk", "Name", "Seen") == sorted(kept + [("k5", "new", 5), ("m", "new", 7), ("late", "late", 7), ("n", "n", 20)])
    assert written(house, 2) == {"open": 2} and written(house, 3) == {"open": 2}
    plan = house.current(2)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^\]]*LessThan\(Seen,5\)", plan)
    assert rows(house.table(), "dim_T_bk") == rows(house.current(), "dim_T_bk")


@pytest.mark.parametrize("kind", ["merge", "overlap"])
def test_rows_that_arrive_late_at_the_boundary(spark, kind):
    """Rows come in random order, several at a time and with equal values. Each load is offered all that have come; in the end the
    table holds every row that, when it came, was not below the highest value loaded."""
    rng = random.Random(11)
    spec = contract(delta_load=True, delta_column="Seen", delta_type="overlap" if kind == "overlap" else "")
    for trial in range(3):
        house = Warehouse(spark, spec, fresh_path(spark, f"late-{kind}-{trial}"))
        every = [(f"k{i}", f"n{i}", rng.randrange(4) + 3 * (i // 8)) for i in range(24)]
        rng.shuffle(every)
        every.sort(key=lambda r: r[2] // 3)
        arrived, want, reached = [], set(), None
        for n in range(1, 5):
            new, every = every[:6], every[6:]
            arrived += new
            want |= {r for r in new if reached is None or r[2] >= reached}
            reached = max(r[2] for r in want)
            pipeline.run_scd1(source(spark, *arrived), house, n, f"2024-0{n}-01")
            assert rows(house.current(), "dim_T_bk", "Name", "Seen") == sorted(want)


def test_delta_load_takes_unknown_keys_at_the_last_value(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 2), (None, 2), ("d", 3), ("e", None)], "k string, v int")
    known = spark.createDataFrame([("b",), (None,)], "k string")
    assert {r.k for r in delta_load(df, "v", 2, loaded=known, key="k").collect()} == {"c", "d", "e"}
    assert {r.k for r in delta_load(df, "v", 2, loaded=known.limit(0), key="k").collect()} == {"b", "c", None, "d", "e"}
    assert {r.k for r in delta_load(df, "v", 2).collect()} == {"d", "e"}
    assert delta_load(df, "v", None, loaded=known, key="k").count() == 6


# Narrow merges ------------------------------------------------------------------------------------
def batches(spark, house):
    run(spark, house, 1, *[(f"k{i}", "x") for i in range(50)])
    run(spark, house, 2, ("k0", "y"), *[(f"k{i}", "x") for i in range(1, 49)])
    run(spark, house, 3, ("k0", "x"), *[(f"k{i}", "x") for i in range(1, 50)])


def exchanges(plan: str) -> list[str]:
    return re.findall(r"Exchange hashpartitioning\(([^)]*)", plan)


def test_a_merge_exchanges_each_side_once_and_only_hashes(spark):
    house = Warehouse(spark, SPEC, fresh_path(spark, "narrow"), narrow_from=0)
    batches(spark, house)
    stg = house.stage(st.staging_full_load(delivery(spark, ("k0", "x")), SPEC, 4), 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        touched = house._touched(house._since_base(3), house._staged(4), True, None)
        plan = touched._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert stg.count() == 1 and len(house._since_base(3)) == 3
    assert len(exchanges(plan)) == 2 and "BatchScan" not in plan
    # three columns of the stored side are read and exchanged: key, surrogate key, hash
    stored = [s for s in re.findall(r"ReadSchema: struct<([^>]*)>", plan) if "dim_T_sid" in s]
    assert len(stored) == 2 and all(len(s.split(",")) <= 3 for s in stored)
    assert touched.collect() and not any("Name" in s for s in stored)


@pytest.mark.parametrize("options", [{}, {"null_safe": True}, {"by": "hash"}, {"stage_deletes": True}])
def test_narrow_and_wide_merges_agree(spark, options):
    deliveries = [
        [("a", "x", "n"), ("b", "x", None), ("c", "x", "n"), ("d", "x", "n")],
        [("a", "x", None), ("b", "x", "n"), ("c", "y", "n"), ("e", "x", None)],
        [("a", "x", "n"), ("d", "x", "n"), ("e", "x", "n")],
        [("a", "x", "n"), ("b", "x", None), ("c", "x", "n"), ("d", "x", "n")],
    ]
    found = []
    for after, narrow in ((0, 0), (20, 0), (20, 10**6)):
        house = Warehouse(spark, SPEC, fresh_path(spark, "agree"), rewrite_after=after, narrow_from=narrow)
        for n, given in enumerate(deliveries, 1):
            run(spark, house, n, *given, **options)
        found.append(sorted(map(str, house.table().drop(SPEC.sid).collect())))
        assert house.table().select(SPEC.sid).distinct().count() == len(found[-1])
    assert found[0] == found[1] == found[2]


def test_hashes_tell_where_nulls_are(spark):
    df = spark.createDataFrame([("a", "x", None), ("a", None, "x")], "dim_T_bk string, Name string, Note string")
    df = df.withColumn("Since", F.lit(None).cast("timestamp_ntz")).withColumn("dim_Date_Since_bk", F.lit("1"))
    df = df.withColumn("dim_Time_Since_bk", F.lit("1"))
    assert df.select(h.row_hash(SPEC)).distinct().count() == 2


# Collation ----------------------------------------------------------------------------------------
@pytest.mark.parametrize("narrow", [0, 10**6])
@pytest.mark.parametrize("staged", [True, False])
def test_deletes_under_a_collation(spark, staged, narrow):
    house = Warehouse(spark, SPEC, fresh_path(spark, "ci"), narrow_from=narrow)
    run(spark, house, 1, ("a", "x"), ("b", "x"), ("c ", "x"), collation=CI, stage_deletes=staged)
    run(spark, house, 2, ("A", "x"), ("B ", "y"), collation=CI, stage_deletes=staged)
    run(spark, house, 3, ("a", "X"), ("b", "y"), ("C", "x"), collation=CI, stage_deletes=staged)
    got = rows(house.table().filter("dim_T_bk <> '-1'"), "dim_T_bk", "Name", "dwh_CurrentFlag", "dwh_DeleteFlag")
    assert got == [
        ("B ", "y", 1, 0), ("C", "x", 1, 0), ("a", "x", 1, 0), ("b", "x", 0, 0), ("c ", "x", 0, 0), ("c ", "x", 0, 1),
    ]


def test_key_operators_under_a_collation(spark):
    stg = st.staging_full_load(delivery(spark, ("a", "1"), ("A ", "2"), ("b", "3")), SPEC, 1)
    assert check_unique_key(stg, ["dim_T_bk"]).count() == 0
    assert [tuple(r) for r in check_unique_key(stg, ["dim_T_bk"], SPEC, CI).collect()] == [("A ", 2)]
    dwh = h.stamp_dwh(st.staging_full_load(delivery(spark, ("a", "1"), ("B", "3")), SPEC, 1), SPEC, "1900-01-01", 1, "2024-01-01")
    new = st.staging_full_load(delivery(spark, ("A", "1"), ("b ", "3"), ("c", "4")), SPEC, 2)
    assert rows(h.new_members(new, dwh, SPEC, CI), "dim_T_bk") == [("c",)]
    assert rows(h.new_members(new, dwh, SPEC), "dim_T_bk") == [("A",), ("b ",), ("c",)]
    assert st.missing_members(dwh, new, SPEC, CI).count() == 0
    child = spark.createDataFrame([("A", "x"), ("b", "X "), (None, "-1")], "p string, q string")
    assert sorted(map(tuple, early_members(dwh, child, ["p", "q"], SPEC, CI).collect())) == [("X ", "q")]
    with pytest.raises(Exception, match="staged twice"):
        house = Warehouse(spark, SPEC, fresh_path(spark, "ci-twice"))
        run(spark, house, 1, ("a", "x"), ("A", "x"), collation=CI)
    assert content(Warehouse(spark, SPEC, house.base)) == []
