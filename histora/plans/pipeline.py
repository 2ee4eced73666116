"""Load pipelines: the order of the steps for one table, and the loop over tables."""

from __future__ import annotations

import fnmatch
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from typing import Any, Callable, Iterable, Mapping

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from histora.functions.defaults import default_for
from histora.functions.scalars import whole_seconds
from histora.operators.checks import breaks_constraint, check_constraints, require
from histora.operators.staging import staging_full_load, with_deletes, with_dummy
from histora.operators.type1 import delta_load
from histora.plans.storage import ProtectedTable, Warehouse, switch_partition
from histora.sources.delivery import is_shell
from histora.spec import BEGINNING, ContractError, TableSpec, ref

STEPS = ("staging", "checks", "history", "views")


def stage(
    source: DataFrame, spec: TableSpec, batch_id: int, narrow: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Full load, then the unknown member. The dummy must precede delete detection, or it would be
    found missing and flagged as deleted."""
    stg = staging_full_load(source, spec, batch_id)
    stg = narrow(stg) if narrow else stg
    return with_dummy(stg, spec, batch_id) if spec.dummy else stg


class NothingDelivered(ValueError):
    """Delete detection on a source that has not been delivered would delete every member."""


def _stage_and_check(
    source: DataFrame | None,
    warehouse: Warehouse,
    batch_id: int,
    steps: set[str],
    with_gone: bool = False,
    merging: bool = True,
    detect: bool = False,
    allow_shell: bool = False,
    narrow: Callable[[DataFrame], DataFrame] | None = None,
    collation: str | None = None,
) -> None:
    """Write the staged snapshot and check it.

    Rows that break a constraint are counted while the snapshot is written; only if there are any is it read to
    name them. A merge checks the business key itself. narrow: what to leave of the cleansed rows.
    """
    spec = warehouse.spec
    warehouse.open_for(batch_id)
    prior, computed = warehouse.last_batch(before=batch_id), "staging" in steps
    if computed:
        if detect and not allow_shell and prior is not None and is_shell(source):
            raise NothingDelivered(f"{spec.name}: nothing delivered for batch {batch_id}")
        stg = stage(source, spec, batch_id, narrow)
        if with_gone and prior is not None:
            stg = with_deletes(stg, warehouse.current(prior), spec, batch_id, collation)
        counted = Observation()
        warehouse.stage(stg.observe(counted, F.count(F.when(breaks_constraint(stg, spec), True)).alias("bad")), batch_id)
    if "checks" in steps:
        merging = merging and prior is not None and "history" in steps
        bad = not computed or counted.get["bad"] > 0
        warehouse.verify(warehouse.staged(batch_id), key_in_merge=merging, rows=bad, collation=collation)


def run_scd2(
    source: DataFrame | None,
    warehouse: Warehouse,
    batch_id: int,
    valid_from=None,
    now=None,
    init_valid_from=BEGINNING,
    steps: Iterable[str] = STEPS,
    stage_deletes: bool = False,
    allow_shell: bool = False,
    **compare: Any,
) -> Warehouse:
    """One batch of a table with history: full load, dummy, delete detection, historization, views.

    Members missing from the delivery are found in the historization's own join. With stage_deletes
    they are first appended to the staged snapshot, which costs one more join. A shell (see
    `sources.source_or_shell`) is no delivery that members can miss from, unless allow_shell says so.
    """
    spec, steps = warehouse.spec, set(steps)
    now = whole_seconds() if now is None else now
    valid_from = whole_seconds() if valid_from is None else valid_from
    detect = spec.delete_detection
    _stage_and_check(
        source,
        warehouse,
        batch_id,
        steps,
        with_gone=detect and stage_deletes,
        detect=detect,
        allow_shell=allow_shell,
        collation=compare.get("collation"),
    )
    if "history" in steps:
        warehouse.historize(
            batch_id, init_valid_from, valid_from, now, detect_deletes=detect and not stage_deletes, **compare
        )
    if "views" in steps:
        warehouse.show()
    return warehouse


def run_scd1(
    source: DataFrame | None,
    warehouse: Warehouse,
    batch_id: int,
    now=None,
    last_value: Any = None,
    steps: Iterable[str] = STEPS,
    allow_shell: bool = False,
    **compare: Any,
) -> Warehouse:
    """One batch of a table that is updated in place.

    If the contract asks for delta loads, only cleansed rows beyond the stored start value are taken (and, if it has one,
    rows that pass its filter; rows without a value always are). Rows with that very value are taken if their key is not stored with
    it, so none is lost that comes late. last_value overrules the stored one. The highest value loaded is stored with the
    batch. A delta says nothing about missing members, so none are deleted. With delta_type 'overlap' the delta replaces all
    stored rows from its lowest value beyond the start to its highest one instead of being merged by key.
    """
    spec, steps = warehouse.spec, set(steps)
    now = whole_seconds() if now is None else now
    last = warehouse.delta_value(before=batch_id) if last_value is None else last_value

    def newer(stg: DataFrame) -> DataFrame:
        prior, known = warehouse.last_batch(before=batch_id), None
        if last is not None and prior is not None:
            kind = stg.schema[spec.delta_column].dataType
            known = warehouse.current(prior).filter(ref(spec.delta_column) == F.lit(last).cast(kind))
        condition = F.expr(spec.delta_filter) if spec.delta_filter else None
        return delta_load(stg, spec.delta_column, last, condition, known, spec.bk)

    detect = spec.delete_detection and not spec.delta_load
    _stage_and_check(
        source,
        warehouse,
        batch_id,
        steps,
        with_gone=detect,
        merging=not (spec.delta_load and spec.delta_type == "overlap"),
        detect=detect,
        allow_shell=allow_shell,
        narrow=newer if spec.delta_load else None,
        collation=compare.get("collation"),
    )
    if "history" in steps and not spec.delta_load:
        warehouse.update(batch_id, now, **compare)
    elif "history" in steps:
        # Neither the unknown member nor a default in the place of a missing value says how far a load has come
        loaded, column = warehouse.staged(batch_id), next(c for c in spec.columns if c.name == spec.delta_column)
        if spec.dummy:
            loaded = loaded.filter(~ref(spec.bk).eqNullSafe(default_for(spec.bk_column)))
        value = F.when(~ref(column.name).eqNullSafe(default_for(column)), ref(column.name))
        beyond = F.lit(True) if last is None else value > F.lit(last).cast(loaded.schema[column.name].dataType)
        low, high = loaded.agg(F.min(F.when(beyond, value)), F.max(value)).first()
        reached = last if high is None else high
        if spec.delta_type == "overlap" and low is not None and warehouse.last_batch(before=batch_id) is not None:
            warehouse.replace_range(batch_id, spec.delta_column, low, high, now, stg=loaded, delta_value=reached)
        else:
            warehouse.update(batch_id, now, delta_value=reached, **compare)
    if "views" in steps:
        warehouse.show()
    return warehouse


def run_full_reload(
    source: DataFrame | None, warehouse: Warehouse, batch_id: int, now=None, steps: Iterable[str] = STEPS
) -> Warehouse:
    """One batch of a table without history: stage, replace, views. A protected table is refused before anything is written."""
    spec, steps = warehouse.spec, set(steps)
    if spec.protect:
        raise ProtectedTable(spec.name)
    _stage_and_check(source, warehouse, batch_id, steps, merging=False)
    if "history" in steps:
        warehouse.reload(batch_id, whole_seconds() if now is None else now)
    if "views" in steps:
        warehouse.show()
    return warehouse


def run_partition_switch(
    source: DataFrame, spec: TableSpec, path: str, batch_id: int, partition_col: str, steps: Iterable[str] = STEPS
) -> DataFrame:
    """One batch of a table kept as partitions: those that occur in the delivery are replaced."""
    stg = staging_full_load(source, spec, batch_id)
    if "checks" in set(steps):
        require(check_constraints(stg, spec), f"{spec.name}: null in a mandatory column or text too long")
    switch_partition(stg.withColumn("_part", ref(partition_col)), path, ["_part"], spec)
    return source.sparkSession.read.schema(spec.staging_schema()).parquet(path)


def run_early_arriving(
    child: DataFrame,
    child_spec: TableSpec,
    parents: Mapping[str, Warehouse],
    batch_id: int,
    valid_from=None,
    now=None,
    collation: str | None = None,
) -> list[str]:
    """Placeholders for the members that a staged child refers to and its parents lack.

    The child's columns name their parents (`early_arrive_parent`). Returns the parents that took part.
    """
    wanted: dict[str, list[str]] = {}
    for c in child_spec.columns:
        if c.early_arrive_parent:
            wanted.setdefault(c.early_arrive_parent, []).append(c.name)
    for name, columns in wanted.items():
        if name not in parents:
            raise KeyError(f"{child_spec.name}: no warehouse for parent {name}")
        parents[name].add_early(
            batch_id,
            child,
            columns,
            whole_seconds() if valid_from is None else valid_from,
            whole_seconds() if now is None else now,
            collation,
        )
        parents[name].show()
    return list(wanted)


def run_table(
    source: DataFrame,
    warehouse: Warehouse,
    batch_id: int,
    valid_from=None,
    now=None,
    init_valid_from=BEGINNING,
    allow_shell: bool = False,
    **compare: Any,
) -> Warehouse:
    """One batch by the pipeline that the contract asks for.

    table_type 'scd2' keeps history; 'scd1' updates in place; anything else ('reload', 'fact') replaces the table, or, if
    the contract asks for delta loads, updates it by them. Unknown member and delete detection follow the flags; a
    protected table is refused where it would be replaced.
    """
    kind = warehouse.spec.table_type.lower()
    if kind == "scd2":
        return run_scd2(
            source, warehouse, batch_id, valid_from, now, init_valid_from, allow_shell=allow_shell, **compare
        )
    if kind == "scd1" or warehouse.spec.delta_load:
        return run_scd1(source, warehouse, batch_id, now, allow_shell=allow_shell, **compare)
    return run_full_reload(source, warehouse, batch_id, now)


def run_psa(
    stg: DataFrame,
    warehouse: Warehouse,
    batch_id: int,
    valid_from=None,
    now=None,
    init_valid_from=BEGINNING,
    checks: bool = True,
    **compare: Any,
) -> Warehouse:
    """Persistent staging: historize a staged snapshot that already exists, then the views."""
    if checks:
        merging = warehouse.last_batch(before=batch_id) is not None
        warehouse.verify(stg, key_in_merge=merging, collation=compare.get("collation"))
    warehouse.historize(
        batch_id,
        init_valid_from,
        whole_seconds() if valid_from is None else valid_from,
        whole_seconds() if now is None else now,
        stg=stg,
        **compare,
    )
    warehouse.show()
    return warehouse


class ParentFailed(RuntimeError):
    """A table was not loaded because one that it refers to was not."""


def parents_of(spec: TableSpec, names: Iterable[str]) -> set[str]:
    """The tables among `names` that columns of a contract refer to (`early_arrive_parent`); a reference to itself is none."""
    return {c.early_arrive_parent for c in spec.columns if c.early_arrive_parent in set(names) - {spec.name}}


def load_layers(specs: Iterable[TableSpec]) -> list[list[TableSpec]]:
    """Tables in layers: those of a layer refer to tables of earlier layers only. Tables that refer to each other in a circle are refused."""
    left = {s.name: s for s in specs}
    waiting = {name: parents_of(s, left) for name, s in left.items()}
    layers = []
    while waiting:
        ready = [name for name, parents in waiting.items() if not parents]
        if not ready:
            raise ContractError(f"tables refer to each other in a circle: {', '.join(sorted(waiting))}")
        layers.append([left[name] for name in ready])
        waiting = {name: parents - set(ready) for name, parents in waiting.items() if name not in ready}
    return layers


def run_all(
    specs: Iterable[TableSpec],
    run: Callable[[TableSpec], Any],
    tables: str = "*",
    parallel: int = 4,
    spark: SparkSession | None = None,
) -> dict[str, Any]:
    """Run the selected tables (a name or pattern), each as soon as all tables it refers to are done, up to `parallel` at a time.

    An error stops its own table and those that refer to it, and is returned as that table's result. The driver's threads only
    submit jobs; with `spark` each table's go to a scheduler pool of its own, which share the cluster evenly if the session
    runs with spark.scheduler.mode=FAIR. See `run_contracts` for the pipeline of each contract.
    """
    chosen = [s for s in specs if fnmatch.fnmatchcase(s.name, tables or "*")]
    order = [s for layer in load_layers(chosen) for s in layer]
    waiting = {s.name: parents_of(s, [o.name for o in order]) for s in order}
    by_name, results, running = {s.name: s for s in order}, {}, {}

    def work(spec: TableSpec) -> Any:
        if spark is not None:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", spec.name)
        return run(spec)

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as threads:
        while waiting or running:
            for name in [n for n, parents in waiting.items() if parents <= set(results)]:
                failed = sorted(p for p in waiting.pop(name) if isinstance(results[p], Exception))
                if failed:
                    results[name] = ParentFailed(f"{name}: not loaded, as {', '.join(failed)} failed")
                else:
                    target = work if spark is None else inheritable_thread_target(spark)(work)
                    running[threads.submit(target, by_name[name])] = name
            for future in wait(running, return_when=FIRST_COMPLETED).done if running else ():
                error = future.exception()
                if error is not None and not isinstance(error, Exception):
                    raise error
                results[running.pop(future)] = future.result() if error is None else error
    return {s.name: results[s.name] for s in order}


def run_contracts(
    sources: Mapping[str, DataFrame],
    warehouses: Iterable[Warehouse],
    batch_id: int,
    tables: str = "*",
    parallel: int = 4,
    **options: Any,
) -> dict[str, Any]:
    """One batch of every selected table, each by the pipeline of its contract; sources by table name. Tables that others refer
    to are loaded before them, independent ones at the same time."""
    by_name = {w.spec.name: w for w in warehouses}
    spark = next((w.spark for w in by_name.values()), None)
    return run_all(
        [w.spec for w in by_name.values()],
        lambda spec: run_table(sources[spec.name], by_name[spec.name], batch_id, **options),
        tables,
        parallel,
        spark,
    )
