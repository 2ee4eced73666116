"""Random batches against a plain model of the historization, row by row."""

import random

import pytest

from histora.operators import history as h
from histora.operators import staging as st
from histora.operators.type1 import scd1_merge
from histora.spec import ColumnSpec, table

SPEC = table(
    "dim_M",
    [
        ColumnSpec("dim_M_bk", "nvarchar(20)", bk=True, pk=True),
        ColumnSpec("A", "nvarchar(20)"),
        ColumnSpec("B", "integer", mandatory=False),
    ],
)
SCHEMA = "dim_M_bk string, A string, B int"
FIELDS = ("dim_M_bk", "A", "B", "dwh_ValidFrom", "dwh_ValidTo", "dwh_CurrentFlag", "dwh_DeleteFlag", "dwh_BatchRunIdInsert", "dwh_BatchRunIdUpdate")
INIT, END = "1900-01-01 00:00:00", "9999-12-31 23:59:59"


def start(batch):
    return f"2024-0{batch}-01 00:00:00"


def end_before(batch):
    return {2: "2024-01-31 23:59:59", 3: "2024-02-29 23:59:59", 4: "2024-03-31 23:59:59", 5: "2024-04-30 23:59:59"}[batch]


def model(state, delivered, batch, null_safe, deletes):
    """state: list of rows as dicts; delivered: key -> (A, B)."""
    staged = {k: (a or "#NA#", b, 0) for k, (a, b) in delivered.items()}
    current = {r["dim_M_bk"]: r for r in state if r["dwh_CurrentFlag"] == 1}
    if deletes:
        for k, r in current.items():
            if k not in staged and r["dwh_DeleteFlag"] == 0:
                staged[k] = (r["A"], r["B"], 1)
    for k, (a, b, gone) in staged.items():
        old = current.get(k)
        if old is not None:
            values_differ = b != old["B"] if null_safe else None not in (b, old["B"]) and b != old["B"]
            if not (a != old["A"] or values_differ or gone != old["dwh_DeleteFlag"]):
                continue
            old.update(dwh_CurrentFlag=0, dwh_ValidTo=end_before(batch), dwh_BatchRunIdUpdate=batch)
        values = (k, a, b, start(batch) if old is not None else INIT, END, 1, gone, batch, None)
        state.append(dict(zip(FIELDS, values)))


def delivery(rng, keys):
    return {
        k: (rng.choice(["x", "y", None]), rng.choice([1, 2, None])) for k in keys if rng.random() < 0.8
    }


@pytest.mark.parametrize("seed, null_safe, deletes", [(1, False, True), (2, True, True), (3, False, False)])
def test_random_batches(spark, seed, null_safe, deletes):
    rng = random.Random(seed)
    keys = [f"k{i}" for i in range(60)]
    dwh, state = h.empty_warehouse(spark, SPEC, with_sid=False), []
    for batch in range(1, 6):
        delivered = delivery(rng, keys)
        source = spark.createDataFrame([(k, a, b) for k, (a, b) in delivered.items()], SCHEMA)
        stg = st.staging_full_load(source, SPEC, batch)
        out = h.scd2_apply(
            dwh, stg, SPEC, batch, INIT, start(batch), start(batch), null_safe=null_safe, detect_deletes=deletes
        )
        model(state, delivered, batch, null_safe, deletes)
        got = out.collect()
        dwh = spark.createDataFrame(got, out.schema)
        assert sorted(str(tuple(str(r[f]) for f in FIELDS)) for r in got) == sorted(
            str(tuple(str(r[f]) for f in FIELDS)) for r in state
        )


def test_random_updates_in_place(spark):
    rng = random.Random(4)
    keys = [f"k{i}" for i in range(60)]
    dwh, known = h.empty_warehouse(spark, SPEC, with_sid=False), {}
    for batch in range(1, 4):
        delivered = delivery(rng, keys)
        source = spark.createDataFrame([(k, a, b) for k, (a, b) in delivered.items()], SCHEMA)
        out = scd1_merge(dwh, st.staging_full_load(source, SPEC, batch), SPEC, batch, start(batch))
        for k, (a, b) in delivered.items():
            a = a or "#NA#"
            if k not in known:
                known[k] = (a, b, batch, None)
            elif known[k][:2] != (a, b):
                known[k] = (a, b, known[k][2], batch)
        got = out.collect()
        dwh = spark.createDataFrame(got, out.schema)
        assert {r.dim_M_bk: (r.A, r.B, r.dwh_BatchRunIdInsert, r.dwh_BatchRunIdUpdate) for r in got} == known
