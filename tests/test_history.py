import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from histora.operators import history as h
from histora.operators import staging as st
from histora.operators.checks import check_not_null
from histora.operators.early import add_early_arriving
from histora.operators.type1 import scd1_merge
from histora.plans import pipeline, views
from histora.plans.storage import BatchHasSuccessors, Warehouse
from histora.sources import source_or_shell
from histora.spec import ColumnSpec, table
from histora.workspace import _path, fresh_path, subfolders

INIT = "1900-01-01 00:00:00"


def contract(null_bk: bool = False):
    return table(
        "dim_T",
        [
            ColumnSpec("dim_T_bk", "nvarchar(20)", mandatory=not null_bk, bk=True, pk=True),
            ColumnSpec("Name", "nvarchar(20)"),
            ColumnSpec("Note", "nvarchar(20)", mandatory=False),
            ColumnSpec("Since", "datetime", mandatory=False),
        ],
    )


SPEC = contract()


def delivery(spark, *rows):
    return spark.createDataFrame(
        [(r + (None, None, None))[:4] for r in rows], "dim_T_bk string, Name string, Note string, Since timestamp_ntz"
    )


def staged(spark, batch, *rows, spec=SPEC):
    return st.staging_full_load(delivery(spark, *rows), spec, batch)


def first(spark, *rows, spec=SPEC):
    return h.stamp_dwh(staged(spark, 1, *rows, spec=spec), spec, INIT, 1, "2024-01-01 01:00:00")


def apply(dwh, stg, batch=2, spec=SPEC, **options):
    return h.scd2_apply(dwh, stg, spec, batch, INIT, f"2024-0{batch}-01", f"2024-0{batch}-01 01:00:00", **options)


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


STATE = ("dim_T_bk", "Name", "dwh_CurrentFlag", "dwh_DeleteFlag", "dwh_BatchRunIdInsert", "dwh_BatchRunIdUpdate")


def test_close_open_insert_keep(spark):
    out = apply(first(spark, ("a", "x"), ("b", "y"), ("c", "z")), staged(spark, 2, ("a", "x"), ("b", "Y"), ("d", "new")))
    assert [r[:5] for r in sorted(map(tuple, out.select(*STATE[:5]).collect()))] == [
        ("a", "x", 1, 0, 1), ("b", "Y", 1, 0, 2), ("b", "y", 0, 0, 1), ("c", "z", 1, 0, 1), ("d", "new", 1, 0, 2),
    ]
    old, new = out.filter("dim_T_bk = 'b'").orderBy("dwh_CurrentFlag").collect()
    assert old["dwh_ValidTo"] == dt.datetime(2024, 1, 31, 23, 59, 59) and new["dwh_ValidFrom"] == dt.datetime(2024, 2, 1)
    assert old["dwh_BatchRunIdUpdate"] == 2 and new["dwh_BatchRunIdUpdate"] is None
    assert out.filter("dim_T_bk = 'd'").first()["dwh_ValidFrom"] == dt.datetime(1900, 1, 1)


def test_null_changes_count_only_when_asked(spark):
    dwh = first(spark, ("a", "x", "note"), ("b", "x", None))
    stg = staged(spark, 2, ("a", "x", None), ("b", "x", "note"))
    assert apply(dwh, stg).count() == 2
    assert apply(dwh, stg, null_safe=True).count() == 4
    assert apply(dwh, stg, by="hash").count() == 4


def test_hash_tells_apart_shifted_values(spark):
    dwh = first(spark, ("a", "x", "y"))
    assert apply(dwh, staged(spark, 2, ("a", "x1:y", None)), by="hash").count() == 2


def test_collation(spark):
    dwh, stg = first(spark, ("a", "Ampoule"), ("B", "x")), staged(spark, 2, ("a", "ampoule  "), ("b", "x"))
    assert apply(dwh, stg).count() == 4
    assert apply(dwh, stg, collation="UTF8_LCASE_RTRIM").count() == 2


def test_declared_collation(spark):
    asked = "x,ExtCollation,28=SQL_Latin1_General_CP1_CI_AS"
    spec = table(
        "dim_T",
        [c if c.name != "Name" else ColumnSpec("Name", "nvarchar(20)", extended=asked) for c in SPEC.columns],
    )
    dwh, stg = first(spark, ("a", "X", "n"), ("b", "x", "n"), spec=spec), staged(spark, 2, ("a", "x", "n"), ("b", "x", "N"), spec=spec)
    out = apply(dwh, stg, spec=spec, collation="declared")
    assert rows(out.filter("dwh_CurrentFlag = 0"), "dim_T_bk") == [("b",)]


def test_deletes_in_one_pass_equal_staged_deletes(spark):
    dwh = apply(
        first(spark, ("a", "x"), ("b", "y"), ("c", "z")), staged(spark, 2, ("a", "x2"), ("b", "y")), detect_deletes=True
    )
    stg = staged(spark, 3, ("c", "back"), ("b", "y2"))
    two = apply(dwh, st.with_deletes(stg, dwh, SPEC, 3), batch=3)
    one = apply(dwh, stg, batch=3, detect_deletes=True)
    names = SPEC.warehouse_columns(with_sid=False)
    assert rows(one.select([F.col(n).cast("string") for n in names]).fillna("null"), *names) == rows(
        two.select([F.col(n).cast("string") for n in names]).fillna("null"), *names
    )
    assert rows(one.filter("dwh_CurrentFlag = 1"), "dim_T_bk", "Name", "dwh_DeleteFlag") == [
        ("a", "x2", 1), ("b", "y2", 0), ("c", "back", 0),
    ]


def test_a_deleted_member_is_not_deleted_again(spark):
    dwh = apply(first(spark, ("a", "x"), ("b", "y")), staged(spark, 2, ("a", "x")), detect_deletes=True)
    again = apply(dwh, staged(spark, 3, ("a", "x")), batch=3, detect_deletes=True)
    assert rows(again, *STATE[:5]) == rows(dwh, *STATE[:5])


def test_duplicate_keys_are_refused(spark):
    with pytest.raises(Exception, match="staged twice: a"):
        apply(first(spark, ("a", "x")), staged(spark, 2, ("a", "x"), ("a", "y"))).collect()
    with pytest.raises(Exception, match="staged twice"):
        apply(first(spark, ("q", "x")), staged(spark, 2, ("a", "x"), ("A", "y")), collation="UTF8_LCASE").collect()


def test_null_keys_match_nothing(spark):
    spec = contract(null_bk=True)
    dwh = first(spark, (None, "x"), ("a", "x"), spec=spec)
    stg = staged(spark, 2, (None, "x"), (None, "y"), ("a", "x"), spec=spec)
    out = apply(dwh, stg, spec=spec)
    assert out.count() == 4 and out.filter("dwh_CurrentFlag = 1").count() == 4
    assert h.new_members(stg, dwh, spec).count() == 2
    assert st.missing_members(dwh, stg, spec).count() == 1
    gone = apply(dwh, stg, spec=spec, detect_deletes=True)
    assert gone.filter("dwh_DeleteFlag = 1").count() == 1


def test_steps_add_up_to_the_whole(spark):
    dwh, stg = first(spark, ("a", "x"), ("b", "y")), staged(spark, 2, ("a", "X"), ("b", "y"), ("c", "n"))
    names = SPEC.warehouse_columns(with_sid=False)
    closed = h.closed_versions(dwh, stg, SPEC, 2, "2024-02-01", "2024-02-01 01:00:00")
    opened = h.new_versions(dwh, stg, SPEC, 2, "2024-02-01", "2024-02-01 01:00:00")
    fresh = h.initial_versions(dwh, stg, SPEC, 2, INIT, "2024-02-01 01:00:00")
    kept = dwh.filter("dim_T_bk = 'b'")
    parts = closed.unionByName(opened).unionByName(fresh).unionByName(kept.select(*names))
    assert sorted(map(str, parts.select(*names).collect())) == sorted(map(str, apply(dwh, stg).select(*names).collect()))


def test_dummy_and_sentinels(spark):
    stg = pipeline.stage(delivery(spark, ("a", None)), SPEC, 1)
    got = {r["dim_T_bk"]: r for r in stg.collect()}
    assert got["a"]["Name"] == "#NA#" and got["a"]["dim_Date_Since_bk"] is None
    assert got["-1"]["Note"] is None and got["-1"]["dim_Date_Since_bk"] == "-1" and got["-1"]["dim_Time_Since_bk"] == "-1"


def test_early_member_is_replaced_by_its_delivery(spark):
    child = spark.createDataFrame([("a", "z"), ("y", None), ("y", "-1")], "one string, two string")
    dwh = add_early_arriving(first(spark, ("a", "x")), child, ["one", "two"], SPEC, 2, "2024-02-01", "2024-02-01")
    assert rows(dwh, "dim_T_bk", "dwh_EarlyArriveFlag", "dwh_EarlyArriveField") == [
        ("a", 0, "#NA#"), ("y", 1, "one"), ("z", 1, "two"),
    ]
    assert rows(views.view_cur(dwh, SPEC), "dim_T_bk") == [("a",)] and views.view_cid(dwh, SPEC).count() == 3
    out = apply(dwh, staged(spark, 3, ("a", "x"), ("y", "#NA#")), batch=3, detect_deletes=True)
    assert rows(out.filter("dim_T_bk = 'y'"), "dwh_CurrentFlag", "dwh_EarlyArriveFlag") == [(0, 1), (1, 0)]
    assert rows(out.filter("dim_T_bk = 'z'"), "dwh_CurrentFlag", "dwh_DeleteFlag") == [(1, 0)]


def test_scd1_updates_in_place(spark):
    dwh = first(spark, ("a", "x"), ("b", "y")).withColumn("dim_T_sid", F.lit(5).cast("long"))
    out = scd1_merge(dwh, staged(spark, 2, ("a", "X"), ("c", "n")), SPEC, 2, "2024-02-01 01:00:00")
    assert sorted((r.dim_T_bk, r.Name, r.dim_T_sid, r.dwh_BatchRunIdUpdate) for r in out.collect()) == [
        ("a", "X", 5, 2), ("b", "y", 5, None), ("c", "n", None, None),
    ]


def check_invariants(table_):
    versions = sorted(
        ((r.dim_T_bk, r.dwh_ValidFrom, r.dwh_ValidTo, r.dwh_CurrentFlag) for r in table_.collect()), key=lambda v: v[:2]
    )
    keys = {v[0] for v in versions}
    for key in keys:
        own = [v for v in versions if v[0] == key]
        assert sum(v[3] for v in own) == 1 and own[-1][3] == 1
        for before, after in zip(own, own[1:]):
            assert before[2] + dt.timedelta(seconds=1) == after[1]


def test_four_batches(spark):
    """Change, vanish, reappear, unchanged redelivery; surrogate keys stay unique and unchanged."""
    house = Warehouse(spark, SPEC, fresh_path(spark, "house"))
    deliveries = [
        [("a", "x"), ("b", "y"), ("c", "z")],
        [("a", "x2"), ("b", "y"), ("d", "n")],
        [("a", "x"), ("b", "y"), ("c", "z"), ("d", "n")],
        [("a", "x"), ("b", "y"), ("c", "z"), ("d", "n")],
    ]
    known: dict = {}
    for n, rows_ in enumerate(deliveries, 1):
        pipeline.run_scd2(
            delivery(spark, *rows_), house, n, f"2024-0{n}-01", f"2024-0{n}-01 01:00:00", INIT, stage_deletes=n == 3
        )
        stored = house.table()
        check_invariants(stored)
        sids = {(r.dim_T_bk, r.dwh_ValidFrom): r.dim_T_sid for r in stored.collect()}
        assert len(set(sids.values())) == len(sids) == stored.count()
        assert sorted(sids.values()) == list(range(1, len(sids) + 1))
        assert all(sids[k] == v for k, v in known.items())
        known = sids
        current, all_current = views.view_cur(stored, SPEC), views.view_cid(stored, SPEC)
        assert current.join(all_current, SPEC.sid, "left_anti").count() == 0
        if n == 2:
            assert rows(all_current.filter("dwh_DeleteFlag = 1"), "dim_T_bk") == [("c",)]
            assert current.filter("dim_T_bk = 'c'").count() == 0
        if n == 3:
            assert current.filter("dim_T_bk = 'c'").count() == 1
            third = sorted(map(str, stored.collect()))
    assert sorted(map(str, house.table().collect())) == third
    assert house.table().filter("dim_T_bk = '-1'").count() == 1
    assert sorted(map(str, house.table(2).select("dim_T_bk").collect())) != sorted(
        map(str, house.table().select("dim_T_bk").collect())
    )


def test_repeating_a_batch_changes_nothing(spark):
    house = Warehouse(spark, SPEC, fresh_path(spark, "house"))
    for n, rows_ in ((1, [("a", "x")]), (2, [("a", "y"), ("b", "n")]), (2, [("a", "y"), ("b", "n")])):
        pipeline.run_scd2(delivery(spark, *rows_), house, n, f"2024-0{n}-01", f"2024-0{n}-01 01:00:00", INIT)
        if n == 2:
            state = rows(house.table(), "dim_T_bk", "Name", "dwh_CurrentFlag", "dwh_BatchRunIdInsert")
            assert state == [("-1", "#NA#", 1, 1), ("a", "x", 0, 1), ("a", "y", 1, 2), ("b", "n", 1, 2)]


def run(spark, house, n, *rows_, **options):
    return pipeline.run_scd2(delivery(spark, *rows_), house, n, f"2024-0{n}-01", f"2024-0{n}-01 01:00:00", INIT, **options)


def content(house, batch=None):
    return sorted(map(str, house.table(batch).collect()))


@pytest.mark.parametrize("buckets", [None, 2])
def test_a_failing_repeat_leaves_the_table_as_it_was(spark, buckets):
    house = Warehouse(spark, SPEC, fresh_path(spark, "repeat"), buckets=buckets)
    run(spark, house, 1, ("a", "x"))
    run(spark, house, 2, ("a", "y"), ("b", "n"))
    before = content(house)
    with pytest.raises(Exception, match="staged twice"):
        run(spark, house, 2, ("a", "z"), ("a", "zz"))
    again = Warehouse(spark, SPEC, house.base, buckets=buckets)
    assert content(house) == content(again) == before
    run(spark, again, 2, ("a", "z"), ("c", "n"))
    assert rows(again.table(), "dim_T_bk", "Name", "dwh_CurrentFlag", "dwh_DeleteFlag") == [
        ("-1", "#NA#", 1, 0), ("a", "x", 0, 0), ("a", "z", 1, 0), ("c", "n", 1, 0),
    ]
    assert len({r[0] for r in again.table().select(SPEC.sid).collect()}) == 4
    assert len(subfolders(spark, f"{house.base}/versions/batch_id=2")) == 1


def test_a_batch_that_others_build_on_is_refused(spark):
    house = Warehouse(spark, SPEC, fresh_path(spark, "earlier"))
    for n, name in ((1, "x"), (2, "y"), (3, "z")):
        run(spark, house, n, ("a", name))
    before = content(house)
    with pytest.raises(BatchHasSuccessors, match=r"\[3\]"):
        run(spark, house, 2, ("a", "other"))
    assert content(house) == before
    assert house.rewind(2) == [3]
    assert rows(Warehouse(spark, SPEC, house.base).current(), "dim_T_bk", "Name") == [("-1", "#NA#"), ("a", "y")]
    run(spark, house, 3, ("a", "other"))
    assert rows(house.table(), "dim_T_bk", "Name", "dwh_CurrentFlag") == [
        ("-1", "#NA#", 1), ("a", "other", 1), ("a", "x", 0), ("a", "y", 0),
    ]
    with pytest.raises(ValueError, match="last 2"):
        house.rewind(1)


def size(spark, path):
    fs, place = _path(spark, path)
    return fs.getContentSummary(place).getLength()


@pytest.mark.parametrize("after", [0, 20])
def test_unchanged_batches_do_not_grow_the_table(spark, after):
    house = Warehouse(spark, SPEC, fresh_path(spark, "grow"), rewrite_after=after)
    sizes = []
    for n in range(1, 7):
        run(spark, house, n, *[(f"k{i}", "x") for i in range(200)])
        sizes.append((size(spark, f"{house.base}/versions"), size(spark, f"{house.base}/staged")))
    for parts in zip(*sizes[-4:], strict=True):  # but for the digits of the batch number
        assert max(parts) < 1.01 * min(parts)
    assert not [p for p in subfolders(spark, f"{house.base}/versions/batch_id=6") if "unnumbered" in p]


def test_a_batch_writes_only_what_it_opens_and_closes(spark):
    house = Warehouse(spark, SPEC, fresh_path(spark, "deltas"), rewrite_after=3)
    full = Warehouse(spark, SPEC, fresh_path(spark, "full"), rewrite_after=0)
    many = [(f"k{i}", "x") for i in range(100)]
    for n in range(1, 7):
        for target in (house, full):
            run(spark, target, n, ("a", f"x{n}"), *many)
        written = house._folders([house.commits()[n]]).groupBy("dwh_action").count().collect()
        whole = n in (1, 5)  # the fifth batch finds three others since the base
        assert {r.dwh_action: r["count"] for r in written} == (
            {"open": 102} if n == 1 else {"open": 1, "close": 1} | ({"keep": 101} if whole else {})
        )
        columns = [c for c in SPEC.warehouse_columns() if c != SPEC.sid]
        assert rows(house.table(), *columns[:2], "dwh_ValidFrom", "dwh_CurrentFlag") == rows(
            full.table(), *columns[:2], "dwh_ValidFrom", "dwh_CurrentFlag"
        )
        assert house.current().count() == 102 == house.current().select(SPEC.sid).distinct().count()
    before = content(house)
    house.rewrite()
    assert content(house) == content(Warehouse(spark, SPEC, house.base)) == before
    assert house.commits()[6].base == 6 and house.current(5).count() == 102
    assert house.rewind(5) == [6]
    run(spark, house, 6, ("a", "other"), *many)
    assert rows(house.current(), "dim_T_bk", "Name")[1] == ("a", "other")


@pytest.mark.parametrize("after", [0, 20])
def test_retained_batches_can_still_be_read(spark, after):
    house = Warehouse(spark, SPEC, fresh_path(spark, "retain"), retain=3, rewrite_after=after)
    states = {}
    for n in range(1, 6):
        run(spark, house, n, ("a", f"x{n}"), (f"b{n}", "y"))
        states[n] = content(house)
    assert all(content(house, n) == states[n] for n in (3, 4, 5))


def test_nothing_delivered_is_not_an_empty_delivery(spark, tmp_path):
    house = Warehouse(spark, SPEC, fresh_path(spark, "late"))
    run(spark, house, 1, ("a", "x"))
    before = content(house)
    with pytest.raises(AnalysisException):
        source_or_shell(spark, SPEC, str(tmp_path / "mistyped"))
    shell = source_or_shell(spark, SPEC, str(tmp_path / "mistyped"), allow_shell=True)
    with pytest.raises(pipeline.NothingDelivered):
        pipeline.run_scd2(shell, house, 2, "2024-02-01", "2024-02-01")
    assert content(house) == before
    pipeline.run_scd2(shell, house, 2, "2024-02-01", "2024-02-01", allow_shell=True)
    assert rows(house.current(), "dim_T_bk", "dwh_DeleteFlag") == [("-1", 0), ("a", 1)]


def test_a_key_that_fills_the_delivery_meets_in_no_task(spark):
    path = fresh_path(spark, "hot")
    staged(spark, 2, ("a", "x")).write.parquet(path)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = h.one_row_per_key(spark.read.parquet(path), SPEC)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    partial = plan.index("Partial")
    assert "WindowGroupLimit" in plan and plan.index("Exchange") < partial


def test_empty_deliveries(spark):
    """A source that sends nothing: first an empty table, later every member deleted."""
    house = Warehouse(spark, SPEC, fresh_path(spark, "house"))
    for n, rows_ in ((1, []), (2, [("a", "x")]), (3, [])):
        pipeline.run_scd2(delivery(spark, *rows_), house, n, f"2024-0{n}-01", f"2024-0{n}-01 01:00:00", INIT)
    assert rows(house.current(), "dim_T_bk", "dwh_DeleteFlag") == [("-1", 0), ("a", 1)]


def test_a_faulty_snapshot_is_refused(spark):
    house = Warehouse(spark, SPEC, fresh_path(spark, "house"))
    with pytest.raises(ValueError, match="staged twice"):
        pipeline.run_scd2(delivery(spark, ("a", "x"), ("a", "y")), house, 1, "2024-01-01", "2024-01-01", INIT)
    assert house.last_batch() is None
    with pytest.raises(ValueError, match="'-1'"):  # a missing key takes the place of the unknown member
        pipeline.run_scd2(delivery(spark, (None, "x")), house, 1, "2024-01-01", "2024-01-01", INIT)


def test_overlapping_batches_can_be_refused(spark):
    house = Warehouse(spark, SPEC, fresh_path(spark, "house"))
    for n, name in ((1, "x"), (2, "y")):
        pipeline.run_scd2(delivery(spark, ("a", name)), house, n, "2024-02-01", "2024-02-01", INIT)
    with pytest.raises(ValueError, match="or later"):
        pipeline.run_scd2(delivery(spark, ("a", "z")), house, 3, "2024-02-01", "2024-02-01", INIT, refuse_overlap=True)
    assert house.last_batch() == 2


def test_type1_batches(spark):
    house = Warehouse(spark, SPEC, fresh_path(spark, "type1"), buckets=2)
    for n, rows_ in ((1, [("a", "x"), ("b", "y")]), (2, [("b", "y2"), ("c", "n")])):
        pipeline.run_scd1(delivery(spark, *rows_), house, n, f"2024-0{n}-01")
    got = {r.dim_T_bk: (r.Name, r.dim_T_sid, r.dwh_DeleteFlag, r.dwh_BatchRunIdUpdate) for r in house.table().collect()}
    assert got["c"] == ("n", 4, 0, None) and {k: v[:1] + v[2:] for k, v in got.items() if k != "c"} == {
        "-1": ("#NA#", 0, None), "a": ("x", 1, 2), "b": ("y2", 0, 2),
    }
    assert sorted(v[1] for v in got.values()) == [1, 2, 3, 4]


def test_delta_batches(spark):
    """The start value is stored with the batch; rows without a value are always loaded."""
    spec = table("dim_T", SPEC.columns, table_type="scd1", delta_load=True, delta_column="Note", delta_filter="Name <> 'skip'")
    house = Warehouse(spark, spec, fresh_path(spark, "delta"))
    pipeline.run_table(delivery(spark, ("a", "x", "1"), ("b", "y", "2")), house, 1, now="2024-01-01")
    assert house.delta_value() == "2"
    source = delivery(spark, ("a", "changed before", "1"), ("b", "y3", "3"), ("c", "skip", "4"), ("d", "n", "4"), ("e", "no value"))
    pipeline.run_table(source, house, 2, now="2024-02-01")
    want = [("-1", "#NA#"), ("a", "x"), ("b", "y3"), ("d", "n"), ("e", "no value")]
    assert rows(house.current(), "dim_T_bk", "Name") == want and house.delta_value() == "4"
    pipeline.run_table(delivery(spark), house, 3, now="2024-03-01")
    assert rows(house.current(), "dim_T_bk", "Name") == want and Warehouse(spark, spec, house.base).delta_value() == "4"


def test_overlapping_deltas_replace_their_range(spark):
    spec = table("dim_T", SPEC.columns, table_type="fact", delta_load=True, delta_type="overlap", delta_column="Note", dummy=False)
    house = Warehouse(spark, spec, fresh_path(spark, "overlap"))
    pipeline.run_table(delivery(spark, ("a", "x", "1"), ("b", "y", "2"), ("c", "z", "3")), house, 1, now="2024-01-01")
    pipeline.run_scd1(delivery(spark, ("b", "new", "2"), ("d", "n", "3")), house, 2, "2024-02-01", last_value="1")
    got = rows(house.table(), "dim_T_bk", "Name", "dim_T_sid", "dwh_BatchRunIdInsert")
    assert [r[:2] + r[3:] for r in got] == [("a", "x", 1), ("b", "new", 2), ("d", "n", 2)]
    assert len({r[2] for r in got}) == 3 and min(r[2] for r in got[1:]) > 3 and house.delta_value() == "3"


def test_early_members_are_stored_and_replaced(spark):
    child = table(
        "fct_C", [ColumnSpec("fct_C_bk", "nvarchar(9)", bk=True), ColumnSpec("dim_T_bk", "nvarchar(20)", early_arrive_parent="dim_T")]
    )
    house = Warehouse(spark, SPEC, fresh_path(spark, "early"))
    run(spark, house, 1, ("a", "x"))
    facts = spark.createDataFrame([("f1", "a"), ("f2", "late"), ("f3", "late"), ("f4", None)], "fct_C_bk string, dim_T_bk string")
    assert pipeline.run_early_arriving(facts, child, {"dim_T": house}, 2, "2024-02-01", "2024-02-01") == ["dim_T"]
    early = rows(house.table(), "dim_T_bk", "Name", "dwh_EarlyArriveFlag", "dwh_EarlyArriveField", SPEC.sid)
    assert early[2] == ("late", "#NA#", 1, "dim_T_bk", 3)
    run(spark, house, 3, ("a", "x"), ("late", "here"))
    assert rows(house.current(), "dim_T_bk", "Name", "dwh_EarlyArriveFlag") == [("-1", "#NA#", 0), ("a", "x", 0), ("late", "here", 0)]
    with pytest.raises(KeyError, match="dim_T"):
        pipeline.run_early_arriving(facts, child, {}, 4)


def test_each_contract_gets_its_pipeline(spark):
    kinds = {"dim_H": "scd2", "dim_I": "scd1", "fct_R": "reload"}
    houses = []
    for name, kind in kinds.items():
        spec = table(name, SPEC.columns, table_type=kind, dummy=False)
        houses.append(Warehouse(spark, spec, fresh_path(spark, name)))
    for n, rows_ in ((1, [("a", "x"), ("b", "y")]), (2, [("a", "z")])):
        sources = {name: delivery(spark, *rows_) for name in kinds}
        got = pipeline.run_contracts(sources, houses, n, valid_from=f"2024-0{n}-01", now=f"2024-0{n}-01")
        assert all(isinstance(r, Warehouse) for r in got.values())
    state = {w.spec.name: rows(w.table(), "dim_T_bk", "Name", "dwh_CurrentFlag", "dwh_DeleteFlag") for w in houses}
    assert state == {
        "dim_H": [("a", "x", 0, 0), ("a", "z", 1, 0), ("b", "y", 0, 0), ("b", "y", 1, 1)],
        "dim_I": [("a", "z", 1, 0), ("b", "y", 1, 1)],
        "fct_R": [("a", "z", 1, 0)],
    }


def test_wide_contract(spark):
    """69 columns, a third of them dates: the merge of the widest contract plans and runs."""
    kinds = ["nvarchar(50)", "datetime", "float"]
    spec = table(
        "dim_W", [ColumnSpec("dim_W_bk", "bigint", bk=True)] + [ColumnSpec(f"c{i}", kinds[i % 3]) for i in range(68)]
    )
    source = spark.range(200).select(
        F.col("id").alias("dim_W_bk"),
        *[
            (F.lit("2024-01-01 10:00:00").cast("timestamp_ntz") if i % 3 == 1 else F.col("id")).alias(f"c{i}")
            for i in range(68)
        ],
    )
    stg = st.staging_full_load(source, spec, 1)
    dwh = h.stamp_dwh(stg, spec, INIT, 1, "2024-01-01")
    stg2 = stg.withColumn("c2", F.when(F.col("dim_W_bk") < 50, -1.0).otherwise(F.col("c2")))
    assert h.scd2_apply(dwh, stg2, spec, 2, INIT, "2024-02-01", "2024-02-01").count() == 250


@pytest.mark.parametrize("forget", [False, True])
def test_bucketed_storage_gives_the_same_table_without_exchange(spark, forget):
    plainly = Warehouse(spark, SPEC, fresh_path(spark, "plain"))
    base = fresh_path(spark, "bucketed")
    batches = [[("a", "x"), ("b", "y"), ("c", "z")], [("a", "x2"), ("b", "y"), ("d", "n")], [("c", "z"), ("d", "m")]]
    for n, rows_ in enumerate(batches, 1):
        house = Warehouse(spark, SPEC, base, buckets=3)
        if forget and n > 1:
            spark.sql(f"DROP TABLE {house._name(n - 1, house.commits()[n - 1].attempt)}")
        for target in (plainly, house):
            pipeline.run_scd2(delivery(spark, *rows_), target, n, f"2024-0{n}-01", f"2024-0{n}-01 01:00:00", INIT)
    names = [n for n in SPEC.warehouse_columns() if n != SPEC.sid]
    assert sorted(map(str, house.table().select(names).collect())) == sorted(map(str, plainly.table().select(names).collect()))
    assert house.table().select(SPEC.sid).distinct().count() == house.table().count()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        stg = house.staged(3).repartition(3, "dim_T_bk")
        merged = h.scd2_merge(house.current(), stg, SPEC, 4, INIT, "2024-04-01", "2024-04-01")
        plan = merged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan


def test_plans_stay_lean(spark):
    """Each side of the merge is exchanged once; guard and anti join reuse that partitioning."""
    path = fresh_path(spark, "lean")
    first(spark, ("a", "x")).write.parquet(path + "/d")
    staged(spark, 2, ("a", "x")).write.parquet(path + "/s")
    dwh, stg = spark.read.parquet(path + "/d"), spark.read.parquet(path + "/s")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merge = h.scd2_merge(dwh, stg, SPEC, 2, INIT, "2024-02-01", "2024-02-01", detect_deletes=True)
        plan = merge._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 2
        gone = st.missing_members(dwh, stg, SPEC)._jdf.queryExecution().executedPlan().toString()
        assert gone.count("Exchange hashpartitioning") == 2 and "PushedFilters: [IsNotNull(dwh_CurrentFlag)" in gone
        nulls = check_not_null(pipeline.stage(stg, SPEC, 1), SPEC)._jdf.queryExecution().optimizedPlan().toString()
        assert nulls.startswith("LocalRelation <empty>")
        load = st.staging_full_load(stg, SPEC, 1)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in load
        cur = views.view_cur(dwh, SPEC).select("Name")._jdf.queryExecution().executedPlan().toString()
        flags = "dwh_CurrentFlag:int,dwh_DeleteFlag:int,dwh_EarlyArriveFlag:int"
        assert "PushedFilters: [IsNotNull(dwh_CurrentFlag)" in cur and f"ReadSchema: struct<Name:string,{flags}>" in cur
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
