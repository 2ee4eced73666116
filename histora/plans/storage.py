"""Where tables are kept: plain parquet folders under the shared folder or any path the cluster reaches.

Plain files know no MERGE. Every attempt at a batch therefore writes a folder of its own and becomes visible by one
small commit row at the end:

    <base>/staged/batch_id=<n>/                                       the staged snapshot
    <base>/versions/batch_id=<n>/attempt=<a>/dwh_action=keep          current versions the batch left alone
    <base>/versions/batch_id=<n>/attempt=<a>/dwh_action=open          versions the batch opened
    <base>/versions/batch_id=<n>/attempt=<a>/dwh_action=close         versions the batch closed
    <base>/versions/batch_id=<n>/attempt=<a>/dwh_action=drop          keys of rows the batch updated in place
    <base>/commits/                                                   one row per commit

Of the commit rows of a batch the latest counts. A full batch writes all current rows (keep and open). Any other batch
writes only what it changes, and names the last full batch as its base: versions opened and closed, or, without history, new
images of updated rows and the keys of the images they replace; a replaced range of values is just named in the commit row.
Current rows are then those of the base and those opened since, less what was closed, dropped or replaced after it was written;
history is the close folders of all batches. A failed attempt leaves the table as it was, and a repeat of the last batch
replaces it only when it commits. A batch that others build on is refused, unless the later ones are taken back by `rewind`.

Every row is stored with a hash of its values. A merge of a large table exchanges keys, surrogate keys and hashes only, and reads the
whole rows just of the keys that are new, differ or vanished.

History is never rewritten, and current rows only by a full batch: the first one, bucketed tables (a merge without an exchange of
the stored side, paid for by writing all of it), `rewrite()`, and every batch that finds `rewrite_after` others since the
base. Once a batch commits, folders that only serve older states go: staged, keep, open and drop folders that none of the last
`retain` batches needs, and attempts that no commit names.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from dataclasses import dataclass, replace
from functools import reduce
from typing import Any, Callable, Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from histora.functions.scalars import moment
from histora.operators import history as h
from histora.operators.checks import check_constraints, check_unique_key, require
from histora.operators.early import placeholders
from histora.operators.staging import comparable
from histora.operators.surrogate import assign_hash_sids, with_positions
from histora.operators.type1 import DROP, outside_range, scd1_changes, scd1_merge, scd1_overlap_replace
from histora.plans.views import publish_views, register_views
from histora.spec import VALID_FROM, TableSpec, quoted, ref
from histora.workspace import exists, materialise, remove, subfolders

UNNUMBERED = "unnumbered"
_COMMIT = T.StructType(
    [
        T.StructField("seq", T.LongType(), False),
        T.StructField("batch_id", T.IntegerType(), False),
        T.StructField("attempt", T.StringType(), False),
        T.StructField("prior", T.IntegerType(), True),
        T.StructField("base", T.IntegerType(), False),
        T.StructField("max_sid", T.LongType(), False),
        T.StructField("delta_value", T.StringType(), True),
        T.StructField("retired", T.BooleanType(), False),
        T.StructField("replaced", T.StringType(), True),
    ]
)


@dataclass(frozen=True)
class Commit:
    """The commit row that counts for a batch. `prior`: the batch it builds on; `base`: the batch whose folders hold all current
    rows; `delta_value`: where the next delta load starts; `replaced`: the range of values the batch took the place of."""

    seq: int
    batch_id: int
    attempt: str
    prior: int | None
    base: int
    max_sid: int
    delta_value: str | None
    retired: bool
    replaced: str | None = None


class BatchHasSuccessors(ValueError):
    """Later batches build on the one to be repeated."""


class ProtectedTable(PermissionError):
    """The contract forbids replacing this table."""


def write_staging(stg: DataFrame, spec: TableSpec, path: str) -> DataFrame:
    """Replace a staging folder by a snapshot in the declared schema, and read it back. The hash is stored for the merge."""
    schema = spec.staging_schema()
    typed = stg.select(*[ref(f.name).cast(f.dataType) for f in schema])
    typed.withColumn(h.HASH, h.staged_hash(spec)).write.mode("overwrite").parquet(path)
    return stg.sparkSession.read.schema(schema).parquet(path)


class Warehouse:
    """One warehouse table kept as a sequence of committed batches.

    buckets: store the versions in this many buckets of the business key. The merge of the next batch
    then joins the stored side where it lies, and only the staged side is exchanged. The session's
    catalog holds the bucket layout of an attempt's folder and may forget it: it is declared anew from the
    folder when missing.

    retain: how many batches stay readable as of their commit, the last one included.

    rewrite_after: how many batches may follow a full one before the next one is full again. More make a batch
    cheaper to write, and the current rows dearer to read.

    narrow_from: how many versions a table has had when merges begin to compare hashes first. That takes two passes over the narrow
    columns in the place of one over all, which pays once the exchange outweighs the start of a further job. Results are the same.

    catalog_views: the reporting views go to the catalog instead of the session. hash_sids: surrogate keys are 64-bit hashes of business
    key and start of the version instead of dense numbers (see `assign_hash_sids`).

    The commit rows are read once per object; a second writer on the same table is not foreseen.
    """

    def __init__(
        self,
        spark: SparkSession,
        spec: TableSpec,
        base: str,
        buckets: int | None = None,
        retain: int = 2,
        rewrite_after: int = 20,
        narrow_from: int = 1_000_000,
        catalog_views: bool = False,
        hash_sids: bool = False,
    ):
        if retain < 1:
            raise ValueError("the last batch has to stay")
        self.spark, self.spec, self.base, self.buckets, self.retain = spark, spec, base.rstrip("/"), buckets, retain
        self.rewrite_after, self.narrow_from = 0 if buckets else rewrite_after, narrow_from
        self.catalog_views, self.hash_sids = catalog_views, hash_sids
        self._known: list[Commit] | None = None
        self._stored = T.StructType(
            list(spec.warehouse_schema())
            + [T.StructField(h.HASH, T.LongType())]
            + [T.StructField(n, T.StringType()) for n in ("attempt", h.ACTION)]
            + [T.StructField("batch_id", T.IntegerType())]
        )

    # reading ------------------------------------------------------------------------------------
    def _rows(self) -> list[Commit]:
        if self._known is None:
            path = f"{self.base}/commits"
            rows = self.spark.read.schema(_COMMIT).parquet(path).collect() if exists(self.spark, path) else []
            self._known = sorted((Commit(**r.asDict()) for r in rows), key=lambda c: c.seq)
        return self._known

    def commits(self) -> dict[int, Commit]:
        """batch -> its commit. One row per commit is fetched."""
        latest = {c.batch_id: c for c in self._rows()}
        return {b: c for b, c in latest.items() if not c.retired}

    def refresh(self) -> None:
        """Forget the commit rows read so far."""
        self._known = None

    def last_batch(self, before: int | None = None) -> int | None:
        return max((b for b in self.commits() if before is None or b < before), default=None)

    def delta_value(self, before: int | None = None) -> str | None:
        """Where the next delta load starts, as text."""
        batch = self.last_batch(before)
        return None if batch is None else self.commits()[batch].delta_value

    def current(self, batch: int | None = None) -> DataFrame:
        """Current versions (deleted members included) as of a batch, by default the last one."""
        batch = self.last_batch() if batch is None else batch
        if batch is None:
            return h.empty_warehouse(self.spark, self.spec)
        if self.buckets:
            stored = self.spark.table(self._declared(self.commits()[batch]))
            return stored.filter(F.col(h.ACTION).isin(h.KEEP, h.OPEN)).select(*self._columns())
        commits = self._since_base(batch)
        return self._less_ended(self._images(commits), commits).select(*self._columns())

    def table(self, batch: int | None = None) -> DataFrame:
        """All versions as of a batch, by default the last one; only the folders needed are read."""
        commits = self.commits()
        batch = max(commits, default=None) if batch is None else batch
        if batch is None:
            return h.empty_warehouse(self.spark, self.spec)
        past = self._folders(self._chain(batch)).filter(F.col(h.ACTION) == h.CLOSE).select(*self._columns())
        return past.unionByName(self.current(batch))

    def show(self) -> list[str]:
        """(Re)create the reporting views on the last batch."""
        if not self.catalog_views:
            return register_views(self.table(), self.spec)
        return publish_views(self.spark, self.spec, self.state_sql())

    def state_sql(self) -> str:
        """The rows of `table()` in SQL, over the folders of the last batch, and dwh_past for closed versions."""
        batch, schema = self.last_batch(), self.spec.warehouse_schema()
        columns, sid = ", ".join(quoted(f.name) for f in schema), quoted(self.spec.sid)

        def parts(commits: list[Commit], actions: tuple[str, ...], select: str, where: Callable[[Commit], str] = lambda c: "TRUE") -> str:
            found = []
            for c in commits:
                folder = self._folder(c.batch_id, c.attempt)
                for name in subfolders(self.spark, folder):
                    if name.split("=", 1)[1] in actions:
                        source = f"parquet.{quoted(f'{folder}/{name}')}"
                        found.append(f"SELECT {select}, {c.batch_id} AS _batch FROM {source} WHERE {where(c)}")
            nothing = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS {quoted(f.name)}" for f in schema)
            return " UNION ALL ".join(found) or f"SELECT {select}, 0 AS _batch FROM (SELECT {nothing}) WHERE FALSE"

        commits = [] if batch is None else self._since_base(batch)
        kinds = {f.name: f.dataType.simpleString() for f in schema}

        def outside(commit: Commit) -> str:
            tests = ["TRUE"]
            for later in commits:
                if later.replaced and later.batch_id > commit.batch_id:
                    name, *bounds = json.loads(later.replaced)
                    escaped = [b.replace("\\", "\\\\").replace("'", "\\'") for b in bounds]
                    low, high = (f"CAST('{b}' AS {kinds[name]})" for b in escaped)
                    tests.append(f"({quoted(name)} IS NULL OR {quoted(name)} < {low} OR {quoted(name)} > {high})")
            return " AND ".join(tests)

        live = parts(commits, (h.KEEP, h.OPEN), columns, outside)
        ended = parts(commits[1:], (h.CLOSE, DROP), f"{sid} AS _sid")
        past = parts([] if batch is None else self._chain(batch), (h.CLOSE,), columns)
        return (
            f"SELECT {columns}, FALSE AS dwh_past FROM ({live}) AS r LEFT ANTI JOIN ({ended}) AS e ON r.{sid} = e._sid AND r._batch < e._batch"
            f" UNION ALL SELECT {columns}, TRUE AS dwh_past FROM ({past})"
        )

    def _chain(self, batch: int) -> list[Commit]:
        """The batch and those it builds on, latest first."""
        commits, chain, step = self.commits(), [], batch
        while step is not None:
            chain.append(commits[step])
            step = commits[step].prior
        return chain

    def _since_base(self, batch: int) -> list[Commit]:
        """The base of a batch and what was committed on it, up to the batch, in this order."""
        base = self.commits()[batch].base
        return [c for c in reversed(self._chain(batch)) if c.batch_id >= base]

    def _images(self, commits: list[Commit]) -> DataFrame:
        """All rows written as current by these commits, but for those in a range that a later one of them replaced. The ranges
        are filters on the scan, which passes over files and row groups that lie within."""
        parts, segment = [], []
        for i, c in enumerate(commits):
            segment.append(c)
            if i + 1 == len(commits) or commits[i + 1].replaced:
                rows = self._folders(segment).filter(F.col(h.ACTION).isin(h.KEEP, h.OPEN))
                for later in commits[i + 1 :]:
                    if later.replaced:
                        column, low, high = json.loads(later.replaced)
                        rows = rows.filter(outside_range(rows, column, low, high))
                parts.append(rows)
                segment = []
        return reduce(DataFrame.unionByName, parts)

    def _ended(self, commits: list[Commit]) -> DataFrame:
        """Rows that say that a version was closed or an image replaced."""
        return self._folders(commits).filter(F.col(h.ACTION).isin(h.CLOSE, DROP))

    def _less_ended(self, rows: DataFrame, commits: list[Commit], by_key: bool = False) -> DataFrame:
        """Rows of these commits without those that a later one of them ended.

        by_key: a merge on the business key follows. The rows are then subtracted by it (the surrogate key is compared as a
        further condition), so that the merge finds them exchanged and sorted as it needs them.
        """
        if len(commits) == 1:
            return rows
        bk, sid = self.spec.bk, self.spec.sid
        ended = self._ended(commits[1:]).select(ref(bk).alias("_bk"), ref(sid).alias("_sid"), F.col("batch_id").alias("_end"))
        same = ref(sid) - F.col("_sid") == 0 if by_key else ref(sid) == F.col("_sid")
        return rows.join(ended, (ref(bk) == F.col("_bk") if by_key else F.lit(True)) & same & (F.col("batch_id") < F.col("_end")), "left_anti")

    def _narrow(self, commits: list[Commit], collation: str | None = None) -> DataFrame:
        """(_key, sid, hash) of the current rows with a business key. Ended rows come in as a second row with a negative
        surrogate key and cancel out where the merge needs the rows anyway: one exchange, of three columns."""
        def narrow(rows: DataFrame, sign: int) -> DataFrame:
            rows = rows.filter(ref(self.spec.bk).isNotNull())
            key = comparable(self.spec.bk, None, self.spec, collation)
            return rows.select(key.alias("_key"), (ref(self.spec.sid) * sign).alias("sid"), F.col(h.HASH).alias("hash"))

        rows = narrow(self._images(commits), 1)
        if len(commits) > 1:
            rows = rows.unionAll(narrow(self._ended(commits[1:]), -1)).repartition("_key")
            rows = rows.groupBy("_key", F.abs("sid").alias("sid"), "hash").agg(F.sum(F.signum("sid")).alias("left"))
            rows = rows.filter("left > 0").select("_key", "sid", "hash")
        return rows

    def _touched(self, commits: list[Commit], stg: DataFrame, detect_deletes: bool, collation: str | None) -> DataFrame:
        key, has_key = comparable(self.spec.bk, None, self.spec, collation), ref(self.spec.bk).isNotNull()
        value = F.col(h.HASH) if h.HASH in stg.columns else h.staged_hash(self.spec)
        staged = stg.filter(has_key).select(ref(self.spec.bk), value.alias("hash"))
        staged = h.one_row_per_key(staged, self.spec, collation).select(key.alias("_key"), ref(self.spec.bk).alias("bk"), "hash")
        return h.touched_keys(self._narrow(commits, collation), staged, detect_deletes)

    def _whole(
        self, commits: list[Commit], stg: DataFrame, collation: str | None = None, detect_deletes: bool = False
    ) -> tuple[DataFrame, DataFrame]:
        """The current and the staged rows that a merge may have to do with, whole; the others were compared by their hashes."""
        touched = materialise(self.spark, f"{self.spec.name}-touched", self._touched(commits, stg, detect_deletes, collation))
        bk, sid = self.spec.bk, self.spec.sid
        sids = touched.filter("sid IS NOT NULL").select(F.col("sid").alias(sid))
        keys = touched.filter("bk IS NOT NULL").select(F.col("bk").alias(bk))
        rows = self._images(commits).join(sids, sid, "left_semi")
        if len(commits) > 1:
            # of a row updated in place the latest image counts; few rows are left here
            latest = Window.partitionBy(ref(sid)).orderBy(F.desc("batch_id"))
            rows = rows.withColumn("_nth", F.row_number().over(latest)).filter("_nth = 1")
        current, staged = rows.select(*self._columns()), stg.join(keys, bk, "left_semi")
        if not self.spec.bk_column.mandatory:
            # null keys match nothing
            if detect_deletes:
                lost = self._images(commits).filter(ref(bk).isNull())
                current = current.unionByName(self._less_ended(lost, commits).select(*self._columns()))
            staged = staged.unionByName(stg.filter(ref(bk).isNull()))
        return current, staged

    def _columns(self) -> list[Column]:
        return [ref(n) for n in self.spec.warehouse_columns()]

    def _folder(self, batch_id: int, attempt: str) -> str:
        return f"{self.base}/versions/batch_id={batch_id}/attempt={attempt}"

    def _folders(self, commits: list[Commit]) -> DataFrame:
        reader = self.spark.read.schema(self._stored).option("basePath", f"{self.base}/versions")
        return reader.parquet(*[self._folder(c.batch_id, c.attempt) for c in commits])

    def _declared(self, commit: Commit) -> str:
        """Name of the catalog table over the folder of an attempt."""
        name = self._name(commit.batch_id, commit.attempt)
        if not self.spark.catalog.tableExists(name):
            hidden = ("batch_id", "attempt")
            columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in self._stored if f.name not in hidden)
            self.spark.sql(
                f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY ({h.ACTION}) "
                f"CLUSTERED BY ({quoted(self.spec.bk)}) INTO {self.buckets} BUCKETS "
                f"LOCATION '{self._folder(commit.batch_id, commit.attempt)}'"
            )
            self.spark.catalog.recoverPartitions(name)
        return name

    def _name(self, batch_id: int, attempt: str) -> str:
        place = hashlib.md5(f"{self.base}/{attempt}".encode()).hexdigest()[:8]
        return quoted(f"{self.spec.name}_{place}_{batch_id}".lower())

    # writing ------------------------------------------------------------------------------------
    def stage(self, stg: DataFrame, batch_id: int) -> DataFrame:
        return write_staging(stg, self.spec, f"{self.base}/staged/batch_id={batch_id}")

    def staged(self, batch_id: int) -> DataFrame:
        return self._staged(batch_id).drop(h.HASH)

    def _staged(self, batch_id: int) -> DataFrame:
        schema = T.StructType(list(self.spec.staging_schema()) + [T.StructField(h.HASH, T.LongType())])
        return self.spark.read.schema(schema).parquet(f"{self.base}/staged/batch_id={batch_id}")

    def verify(self, stg: DataFrame, key_in_merge: bool = False, rows: bool = True, collation: str | None = None) -> None:
        """Refuse a snapshot that breaks NOT NULL, a declared length or the key.

        key_in_merge: a merge follows, which refuses repeated business keys itself; a primary key that
        is just the business key then needs no aggregation of its own. rows: check the rows one by one.
        """
        if rows:
            require(check_constraints(stg, self.spec), f"{self.spec.name}: null in a mandatory column or text too long")
        key = self.spec.pk or [self.spec.bk]
        if not (key_in_merge and key == [self.spec.bk]):
            require(check_unique_key(stg, key, self.spec, collation), f"{self.spec.name}: key staged twice")

    def open_for(self, batch_id: int) -> None:
        """Raise unless the batch is a new one or the last one."""
        later = sorted(b for b in self.commits() if b > batch_id)
        if later:
            raise BatchHasSuccessors(f"{self.spec.name}: batches {later} build on what precedes {batch_id}; rewind({batch_id}) takes them back")

    def rewind(self, batch_id: int) -> list[int]:
        """Take back the commits of all later batches; the table is as it was after `batch_id` again.

        Only the last `retain` batches can be returned to, as older states are not kept.
        """
        commits = self.commits()
        later = sorted((b for b in commits if b > batch_id), reverse=True)
        if batch_id not in commits:
            raise ValueError(f"{self.spec.name}: batch {batch_id} has no commit")
        if batch_id not in sorted(commits)[-self.retain :]:
            raise ValueError(f"{self.spec.name}: batch {batch_id} is not among the last {self.retain}")
        for b in later:
            c = commits[b]
            self._add(replace(c, seq=self._next(), retired=True))
        return later

    def historize(
        self,
        batch_id: int,
        init_valid_from,
        valid_from,
        now,
        stg: DataFrame | None = None,
        refuse_overlap: bool = False,
        **options,
    ) -> None:
        """Merge a snapshot (by default the staged one of the batch) into the table and commit.

        refuse_overlap: raise if a current version starts at valid_from or later; closing it would give
        it an end before its start.
        """
        prior = self._prior(batch_id)
        if prior is None:
            self._load_first(stg, batch_id, init_valid_from, now)
            return
        stg = self._staged(batch_id) if stg is None else stg
        if refuse_overlap:
            late = self.current(prior).filter(F.col(VALID_FROM) >= moment(valid_from)).select(ref(self.spec.bk), VALID_FROM)
            require(late, f"{self.spec.name}: versions start at {valid_from} or later")
        base, commits = self._base_for(prior), self._since_base(prior)
        narrow = base is not None and self.commits()[prior].max_sid >= self.narrow_from
        if narrow:
            current, stg = self._whole(commits, stg, options.get("collation"), options.get("detect_deletes", False))
            options["guard"] = False
        else:
            current, stg = self._for_merge(prior, commits), self._at_buckets(stg)
        merged = h.scd2_merge(current, stg, self.spec, batch_id, init_valid_from, valid_from, now, **options)
        if base is not None:
            merged = merged.filter(F.col(h.ACTION) != h.KEEP)
        part = F.when(F.col(h.ACTION) == h.OPEN, UNNUMBERED).otherwise(F.col(h.ACTION))
        self._store(merged.withColumn(h.ACTION, part), batch_id, prior, base=base)

    def _for_merge(self, prior: int, commits: list[Commit]) -> DataFrame:
        return self.current(prior) if self.buckets else self._less_ended(self._images(commits), commits, by_key=True).select(*self._columns())

    def update(self, batch_id: int, now, stg: DataFrame | None = None, delta_value: Any = None, **options) -> None:
        """Merge a snapshot in place, without history, and commit with where the next delta load starts."""
        prior = self._prior(batch_id)
        if prior is None:
            self._load_first(stg, batch_id, h.BEGINNING, now, delta_value)
            return
        stg = self._staged(batch_id) if stg is None else stg
        base, commits = self._base_for(prior), self._since_base(prior)
        if base is None:
            merged = scd1_merge(self._for_merge(prior, commits), self._at_buckets(stg), self.spec, batch_id, now, **options)
            self._store(self._to_number(merged), batch_id, prior, delta_value)
            return
        narrow = self.commits()[prior].max_sid >= self.narrow_from
        if narrow:
            current, stg = self._whole(commits, stg, options.get("collation"))
        else:
            current = self._for_merge(prior, commits)
        options["guard"] = not narrow
        changes = scd1_changes(current, stg, self.spec, batch_id, now, **options).withColumn(h.HASH, h.version_hash(self.spec))
        # of a replaced image only the key stays
        known, dropped = {self.spec.bk, self.spec.sid, h.HASH, h.ACTION}, F.col(h.ACTION) == DROP
        changes = changes.select(*[ref(n) if n in known else F.when(~dropped, ref(n)).alias(n) for n in changes.columns])
        new = ref(self.spec.sid).isNull()
        self._store(changes.withColumn(h.ACTION, F.when(new, UNNUMBERED).otherwise(F.col(h.ACTION))), batch_id, prior, delta_value, base)

    def replace_range(
        self, batch_id: int, column: str, low: Any, high: Any, now, stg: DataFrame | None = None, delta_value: Any = None
    ) -> None:
        """Put a snapshot in the place of the rows whose column lies between low and high (both included), and commit."""
        prior = self._prior(batch_id)
        if prior is None:
            self._load_first(stg, batch_id, h.BEGINNING, now, delta_value)
            return
        stg = self.staged(batch_id) if stg is None else stg
        base = self._base_for(prior)
        if base is None:
            left = scd1_overlap_replace(self.current(prior), stg, self.spec, column, low, high, batch_id, now)
            self._store(self._to_number(left), batch_id, prior, delta_value)
            return
        new = h.stamp_dwh(stg, self.spec, h.BEGINNING, batch_id, now).withColumn(self.spec.sid, F.lit(None).cast("bigint"))
        new = new.select(*self._columns(), F.lit(UNNUMBERED).alias(h.ACTION))
        self._store(new, batch_id, prior, delta_value, base, json.dumps([column, str(low), str(high)]))

    def add_early(
        self, batch_id: int, child: DataFrame, fk_columns: list[str], valid_from, now, collation: str | None = None
    ) -> None:
        """Add a placeholder for every key of the child that has no current version here, and commit.

        The next delivery of such a member replaces its placeholder.
        """
        prior = self._prior(batch_id)
        kept = h.empty_warehouse(self.spark, self.spec) if prior is None else self.current(prior)
        new = placeholders(kept, child, fk_columns, self.spec, batch_id, valid_from, now, collation)
        base = None if prior is None else self._base_for(prior)
        rows = new if base is not None else kept.unionByName(new)
        self._store(self._to_number(rows), batch_id, prior, base=base)

    def rewrite(self) -> None:
        """Store the current rows of the last batch in full, so that later reads need no older folders."""
        batch = self.last_batch()
        if batch is None or self.commits()[batch].base == batch:
            return
        c, attempt = self.commits()[batch], uuid.uuid4().hex
        closed = self._folders([c]).filter(F.col(h.ACTION) == h.CLOSE).select(*self._columns(), F.col(h.ACTION))
        rows = self.current(batch).withColumn(h.ACTION, F.lit(h.KEEP)).unionByName(closed)
        self._write(rows, batch, attempt, "overwrite")
        self._add(replace(c, seq=self._next(), attempt=attempt, base=batch, replaced=None))
        self._clear()

    def reload(self, batch_id: int, now) -> None:
        """Replace the table by the staged snapshot, without history."""
        if self.spec.protect:
            raise ProtectedTable(self.spec.name)
        self.open_for(batch_id)
        self._load_all(self.staged(batch_id), batch_id, h.BEGINNING, now, None)

    def _prior(self, batch_id: int) -> int | None:
        self.open_for(batch_id)
        return self.last_batch(before=batch_id)

    def _base_for(self, prior: int) -> int | None:
        """The base that a batch after `prior` can build on; None if it has to be full."""
        return self.commits()[prior].base if len(self._since_base(prior)) <= self.rewrite_after else None

    def _at_buckets(self, stg: DataFrame) -> DataFrame:
        """The one exchange of a bucketed batch: the staged rows move to the buckets of the stored ones."""
        return stg.repartition(self.buckets, ref(self.spec.bk)) if self.buckets else stg

    def _to_number(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(h.ACTION, F.when(ref(self.spec.sid).isNull(), UNNUMBERED).otherwise(h.KEEP))

    def _load_first(self, stg: DataFrame | None, batch_id: int, valid_from, now, delta_value: Any = None) -> None:
        files = self.staged(batch_id) if stg is None else materialise(self.spark, f"{self.spec.name}-first", stg)
        self._load_all(files, batch_id, valid_from, now, delta_value)

    def _store(
        self,
        merged: DataFrame,
        batch_id: int,
        prior: int | None,
        delta_value: Any = None,
        base: int | None = None,
        replaced: str | None = None,
    ) -> None:
        """Write a merged batch; only its new versions are read again, to number them."""
        attempt, counted = uuid.uuid4().hex, Observation()
        fresh = F.count(F.when(F.col(h.ACTION) == UNNUMBERED, True)).alias("fresh")
        self._write(merged.observe(counted, fresh), batch_id, attempt, "overwrite")
        max_sid = 0 if prior is None else self.commits()[prior].max_sid
        unnumbered = f"{self._folder(batch_id, attempt)}/{h.ACTION}={UNNUMBERED}"
        if counted.get["fresh"]:
            files = self.spark.read.schema(self.spec.warehouse_schema()).parquet(unnumbered)
            self._write_open(self._numbered(files, max_sid, prior), batch_id, attempt, "append")
            remove(self.spark, unnumbered)
        self._commit(batch_id, attempt, prior, max_sid + counted.get["fresh"], delta_value, base, replaced)

    def _load_all(self, files: DataFrame, batch_id: int, valid_from, now, delta_value: Any) -> None:
        """Every staged row opens a version; it is numbered by its place in the staged files."""
        attempt, counted = uuid.uuid4().hex, Observation()
        if self.hash_sids:
            loaded = self._numbered(h.stamp_dwh(files, self.spec, valid_from, batch_id, now), 0, None)
        else:
            numbered = with_positions(files, self.spec.sid)
            loaded = h.stamp_dwh(numbered, self.spec, valid_from, batch_id, now, keep=[self.spec.sid])
        self._write_open(loaded.observe(counted, F.count(F.lit(1)).alias("n")), batch_id, attempt, "overwrite")
        self._commit(batch_id, attempt, None, counted.get["n"], delta_value)

    def _numbered(self, files: DataFrame, max_sid: int, prior: int | None) -> DataFrame:
        if not self.hash_sids:
            return with_positions(files, self.spec.sid, max_sid)
        taken = None if prior is None else self.table(prior).select(ref(self.spec.sid))
        return assign_hash_sids(files, self.spec, [self.spec.bk, VALID_FROM], taken)

    def _write_open(self, rows: DataFrame, batch_id: int, attempt: str, mode: str) -> None:
        if self.buckets:
            rows = rows.repartition(self.buckets, ref(self.spec.bk))
        self._write(rows.select(*self._columns(), F.lit(h.OPEN).alias(h.ACTION)), batch_id, attempt, mode)

    def _write(self, rows: DataFrame, batch_id: int, attempt: str, mode: str) -> None:
        rows = rows if h.HASH in rows.columns else rows.withColumn(h.HASH, h.version_hash(self.spec))
        writer = rows.select(*self._columns(), h.HASH, h.ACTION).write.format("parquet").mode(mode).partitionBy(h.ACTION)
        writer = writer.option("partitionOverwriteMode", "static")
        if self.buckets:
            writer = writer.bucketBy(self.buckets, self.spec.bk).option("path", self._folder(batch_id, attempt))
            writer.saveAsTable(self._name(batch_id, attempt))
        else:
            writer.save(self._folder(batch_id, attempt))

    def _next(self) -> int:
        return max((c.seq for c in self._rows()), default=0) + 1

    def _add(self, commit: Commit) -> None:
        """Add a commit row; rows written before stay as they are."""
        row = self.spark.range(0, 1, 1, 1).select(
            *[F.lit(getattr(commit, f.name)).cast(f.dataType).alias(f.name) for f in _COMMIT]
        )
        row.write.mode("append").parquet(f"{self.base}/commits")
        self._rows().append(commit)

    def _commit(
        self,
        batch_id: int,
        attempt: str,
        prior: int | None,
        max_sid: int,
        delta_value: Any = None,
        base: int | None = None,
        replaced: str | None = None,
    ) -> None:
        value = None if delta_value is None else str(delta_value)
        base = batch_id if base is None else base
        self._add(Commit(self._next(), batch_id, attempt, prior, base, max_sid, value, False, replaced))
        self._clear()

    def _clear(self) -> None:
        """Remove what no commit needs: other attempts of the batch, and what only older states are made of."""
        commits = self.commits()
        keep = sorted(commits)[-self.retain :]
        needed = {c.batch_id for b in keep for c in self._since_base(b)}
        chained = {c.batch_id for b in keep for c in self._chain(b)}
        for name in subfolders(self.spark, f"{self.base}/versions"):
            old = int(name.split("=", 1)[1])
            for attempt in subfolders(self.spark, f"{self.base}/versions/{name}"):
                attempt = attempt.split("=", 1)[1]
                if old not in chained or attempt != commits[old].attempt:
                    self._drop(old, attempt)
                elif old not in needed:
                    for action in (h.KEEP, h.OPEN, DROP):
                        remove(self.spark, f"{self._folder(old, attempt)}/{h.ACTION}={action}")
            if old not in chained:
                remove(self.spark, f"{self.base}/versions/{name}")
        for name in subfolders(self.spark, f"{self.base}/staged"):
            if int(name.split("=", 1)[1]) not in keep:
                remove(self.spark, f"{self.base}/staged/{name}")

    def _drop(self, batch_id: int, attempt: str) -> None:
        if self.buckets:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._name(batch_id, attempt)}")
        remove(self.spark, self._folder(batch_id, attempt))


# Further sinks -----------------------------------------------------------------------------------
def switch_partition(stg: DataFrame, path: str, partition_cols: list[str], spec: TableSpec | None = None) -> None:
    """Replace the partitions that occur in the staged rows and leave all others as they are."""
    if spec is not None and spec.protect:
        raise ProtectedTable(spec.name)
    # Rebalancing brings a partition's rows together and splits the ones that outgrow a task
    even = stg.hint("rebalance", *partition_cols)
    even.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_cols).parquet(path)


def archive_table(spark: SparkSession, name: str, ts: str, spec: TableSpec | None = None) -> str | None:
    """Set an existing table aside under a time-stamped name; None if there is none."""
    if spec is not None and spec.protect:
        raise ProtectedTable(spec.name)
    if not spark.catalog.tableExists(name):
        return None
    aside = f"xxx_{name}_{ts}"
    spark.sql(f"ALTER TABLE {quoted(name)} RENAME TO {quoted(aside)}")
    return aside


def publish(df: DataFrame, path: str, view_name: str, in_catalog: bool = False) -> DataFrame:
    """Write to a new folder, then point the view to it: readers never meet an empty table. in_catalog: a view of the catalog, which
    readers in other sessions find as well; they see the old folder until the one statement that points it to the new one."""
    df.write.mode("errorifexists").parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    if in_catalog:
        df.sparkSession.sql(f"CREATE OR REPLACE VIEW {quoted(view_name)} AS SELECT * FROM parquet.{quoted(path)}")
    else:
        stored.createOrReplaceTempView(quoted(view_name))
    return stored


def chain(df: DataFrame, steps: Iterable[Callable[[DataFrame], DataFrame]], keep_steps: bool = True) -> DataFrame:
    """Staging views on top of each other; with keep_steps every intermediate result is written once."""

    def apply(previous: DataFrame, step: Callable[[DataFrame], DataFrame]) -> DataFrame:
        result = step(previous)
        return materialise(result.sparkSession, "chain", result) if keep_steps else result

    return reduce(apply, steps, df)
