"""Initial load and batches against the session catalog.

A batch writes new parts of tables (see :mod:`scdstar.plans.storage`), and last appends its
audit rows in a single file. Only these rows make it count: a batch that fails before is
repeated under the same id, on the same state. Before that, every logical table that changes is a
view of its rows before and after, of which the audit rows switch on one: so all tables change
at once. One writer at a time may load, see :mod:`scdstar.sources.lease`.
"""

from __future__ import annotations

import uuid
from collections.abc import Collection, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field, replace
from functools import partial as bound

from pyspark.sql import DataFrame, SparkSession, functions as F

from scdstar.operators.audit import constraint_violations
from scdstar.operators.keys import KEY_BUCKET
from scdstar.operators.scd2 import CLOSES, LoadOptions, TableSpec
from scdstar.plans.frames import Warehouse, load_table
from scdstar.plans.specs import REVIEWS, SPECS, waves
from scdstar.plans.star import DIMENSION_SOURCES, FACT_SOURCES, KEYS, build_star
from scdstar.plans.star_delta import (
    FIRST, PROJECTIONS, REFERENCES, SECOND, Delta, count_changes, first_counts, moves,
)
from scdstar.plans.storage import (
    Parts, Stored, newest_of, numbered_open_select, open_select, summed,
)
from scdstar.schemas import (
    CSV_STAGING, STAR, STAR_CONSTRAINTS, STAR_TABLES, WAREHOUSE, WAREHOUSE_CONSTRAINTS,
    WAREHOUSE_TABLES, schema_of,
)
from scdstar.session import side_by_side
from scdstar.sources import catalog
from scdstar.sources.lease import Lease

AUDIT = schema_of(
    "batch_id:int load_ts:string namespace:string table_name:string version:int"
    " inserted:long? closed:long? unresolved:long? status:string message:string? state:string?"
)

#: Tables that others look keys up in.
REFERRED = {look.table for spec in SPECS.values() for look in spec.lookups}

#: Namespace and table to where the rows are.
State = dict[tuple[str, str], Stored]

#: Marks namespaces of the report whose tables only batches read: latest keys, counts.
KEPT = "/kept"


def _is_logical(name: str) -> bool:
    return name in WAREHOUSE_TABLES or name in STAR_TABLES


@dataclass(frozen=True)
class Namespaces:
    warehouse: str = WAREHOUSE
    star: str = STAR
    staging: str = CSV_STAGING
    control: str = "batch_control"


@dataclass
class Pipeline:
    """Loads warehouse and star batch by batch.

    Tables are kept under ``root``, a folder all executors reach, or by default
    where the catalog keeps its tables. The oldest part of a warehouse table has ``buckets``
    files, by default as many as shuffles have partitions. A writer that has given no sign for
    ``expires`` seconds is taken for gone. With ``verify``, every batch checks all constraints of
    warehouse and star, which reads them whole, and reports violations.
    """

    spark: SparkSession
    names: Namespaces = field(default_factory=Namespaces)
    options: LoadOptions = LoadOptions()
    root: str | None = None
    buckets: int | None = None
    expires: float = 600.0
    verify: bool = False

    # -- batch control ---------------------------------------------------------

    @property
    def _audit_table(self) -> str:
        return f"{self.names.control}.load_audit"

    def audit(self) -> DataFrame:
        """The load report: one row per batch and table."""
        catalog.ensure_namespace(
            self.spark, self.names.control, {"load_audit": AUDIT}, self.root
        )
        return self.spark.table(self._audit_table)

    def _report(self, rows: list[tuple]) -> None:
        self.audit()
        report = self.spark.createDataFrame(rows, AUDIT).coalesce(1)
        catalog.append_by_name(report, self._audit_table)

    def _writing(self) -> Lease:
        """The right to load; an error if another writer has it."""
        self.audit()
        found = self.spark.sql(f"DESCRIBE NAMESPACE {self.names.control}").collect()
        folder = next(r.info_value for r in found if r.info_name == "Location")
        return Lease(self.spark, folder, self.expires)

    def last_batch_id(self) -> int:
        done = self.audit().where("status = 'ok'")
        return done.agg(F.coalesce(F.max("batch_id"), F.lit(0))).first()[0]

    def next_batch_id(self) -> int:
        """The id after the last batch that succeeded; a failed batch uses up none."""
        return self.last_batch_id() + 1

    def state(self) -> State:
        """Where the rows of each table are, as of the last successful batch."""
        audit = self.audit()
        reset = audit.where("status = 'reset'").agg(F.coalesce(F.max("batch_id"), F.lit(0)))
        valid = audit.where(
            (F.col("status") == "ok") & F.col("state").isNotNull()
            & (F.col("batch_id") >= reset.scalar())
        )
        latest = valid.groupBy("namespace", "table_name").agg(
            F.max_by("state", "batch_id").alias("state")
        )
        return {
            (r.namespace.removesuffix(KEPT), r.table_name): Stored.parse(r.state)
            for r in latest.collect()
        }

    # -- loads -----------------------------------------------------------------

    def run_initial(
        self, sources: Mapping[str, DataFrame], reviews: DataFrame, load_ts: str
    ) -> int:
        """Empty warehouse and star and load them in full: the warehouse first."""
        with self._writing() as lease:
            batch_id = self.next_batch_id()
            self._report(
                [(batch_id, load_ts, "batch", "all", 0, None, None, None, "reset", None, None)]
            )
            catalog.reset_namespace(
                self.spark, self.names.warehouse, WAREHOUSE_TABLES, self.root
            )
            catalog.reset_namespace(self.spark, self.names.star, STAR_TABLES, self.root)
            return self._run(lease, batch_id, sources, reviews, load_ts, initial=True)

    def run_batch(
        self,
        sources: Mapping[str, DataFrame],
        reviews: DataFrame | None,
        load_ts: str,
        partial: Collection[str] = (),
    ) -> int:
        """Load one batch on top of the last one. Tables without source stay as they are.

        ``partial`` names the tables whose source holds some of their rows only: under
        ``close_missing`` nothing of theirs is closed for being absent.
        """
        with self._writing() as lease:
            return self._run(
                lease, self.next_batch_id(), sources, reviews, load_ts, partial=partial
            )

    def _check_time(self, load_ts: str) -> None:
        """Versions must not end before they start."""
        loaded = self.audit().where("status = 'ok' AND namespace = 'batch'")
        last = loaded.agg(F.max(F.col("load_ts").cast("timestamp")))
        late = last.select((F.lit(load_ts).cast("timestamp") >= F.col(last.columns[0])).alias("ok"))
        if late.first().ok is False:
            raise ValueError(f"load time {load_ts} is before that of the last batch")

    def run_epoch(
        self,
        stream: str,
        epoch: int,
        sources: Mapping[str, DataFrame],
        reviews: DataFrame | None,
        load_ts: str,
    ) -> int | None:
        """Load a micro-batch of a stream, unless it was loaded since the last initial load.

        ``stream`` tells apart streams that count epochs by themselves, such as those
        with checkpoints of their own. Their reviews are new files only, so they never
        stand for all reviews.
        """
        with self._writing() as lease:
            audit = self.audit()
            reset = audit.where("status = 'reset'").agg(F.coalesce(F.max("batch_id"), F.lit(0)))
            seen = audit.where(
                (F.col("status") == "ok")
                & (F.col("batch_id") >= reset.scalar())
                & (F.col("namespace") == "stream")
                & (F.col("table_name") == stream)
                & (F.col("version") == epoch)
            )
            if not seen.isEmpty():
                return None
            return self._run(
                lease, self.next_batch_id(), sources, reviews, load_ts,
                stream_epoch=(stream, epoch), partial=(REVIEWS.name,),
            )

    def _run(
        self,
        lease: Lease,
        batch_id: int,
        sources: Mapping[str, DataFrame],
        reviews: DataFrame | None,
        load_ts: str,
        initial: bool = False,
        stream_epoch: tuple[str, int] | None = None,
        partial: Collection[str] = (),
    ) -> int:
        attempt = uuid.uuid4().hex
        try:
            previous = {} if initial else self.state()
            if not initial and not previous:
                raise RuntimeError("no initial load yet")
            state = dict(previous)
            if not initial:
                self._check_time(load_ts)
                self._drop_uncommitted(batch_id, previous)
            catalog.begin_staging(self.spark, self.names.staging, self.root)
            with self._joined_by_bucket():
                report, deltas = self._load_warehouse(
                    batch_id, sources, reviews, load_ts, state, partial
                )
            if initial:
                self._build_star(batch_id, state)
            elif any(d.n_fresh or d.n_closed for d in deltas.values()):
                self._refresh_star(batch_id, state, deltas)
            if self.verify:
                report += [
                    (batch_id, load_ts, "constraints", v.table_name, batch_id, None, None, v.n_rows,
                     "violated", f"{v.rule}: {v.columns}", None)
                    for v in self.violations(state, batch_id).collect()  # by constraint
                ]
            catalog.wipe_namespace(self.spark, self.names.staging)
            changed = [key for key in state if state[key] != previous.get(key)]
            loaded = {row[2:4] for row in report}
            for namespace, name in changed:
                if (namespace, name) not in loaded:
                    shown = namespace if _is_logical(name) else namespace + KEPT
                    report.append(
                        (batch_id, load_ts, shown, name, state[namespace, name].version,
                         None, None, None, "ok", None, state[namespace, name].text())
                    )
            self._publish(batch_id, changed, previous, state, attempt)
            if not lease.held():
                raise RuntimeError("another load has taken over")
        except Exception as error:
            self._report(
                [(batch_id, load_ts, "batch", "all", batch_id, None, None, None, "failed",
                  str(error), None)]
            )
            raise
        if stream_epoch:
            report.append(
                (batch_id, load_ts, "stream", *stream_epoch, None, None, None, "ok", None, None)
            )
        report.append(
            (batch_id, load_ts, "batch", "all", batch_id, None, None, None, "ok", attempt, None)
        )
        self._report(report)
        self._publish(batch_id, changed, previous, state)
        # Queries may still be reading what this batch has replaced.
        for namespace in (self.names.warehouse, self.names.star):
            used = {
                (name, b) for found in (previous, state) for (n, name), stored in found.items()
                if n == namespace for b, _ in stored.parts
            }
            catalog.drop_parts(self.spark, namespace, lambda t, b: (t, b) not in used)
        return batch_id

    def _drop_uncommitted(self, batch_id: int, state: State) -> None:
        """Drop what attempts left that failed since the last success."""
        warehouse, star = self.names.warehouse, self.names.star
        if any(catalog.parts_from(self.spark, n, batch_id) for n in (warehouse, star)):
            # Views may name parts of the failed attempt.
            self._publish(batch_id - 1, list(state), state, state)
        for namespace in (warehouse, star):
            catalog.drop_parts(self.spark, namespace, lambda _, b: b >= batch_id)
        catalog.drop_uncommitted(
            self.spark, warehouse, [f"{t}__history" for t in WAREHOUSE_TABLES], batch_id
        )
        catalog.drop_uncommitted(
            self.spark, star, [f"{t}__gone" for t in DIMENSION_SOURCES], batch_id
        )

    # -- where rows are --------------------------------------------------------

    @property
    def n_buckets(self) -> int:
        """The number of files of the oldest part of a warehouse table."""
        return self.buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))

    def _parts(self, namespace: str, table: str, key: tuple[str, ...] = ()) -> Parts:
        # Sources with copies of a key are grouped by it, and need no shuffle for their buckets.
        by_bucket = bool(key) and SPECS[table].unique_source
        return Parts(self.spark, namespace, table, key, self.n_buckets, by_bucket)

    def _open_select(
        self, namespace: str, name: str, stored: Stored, batch_id: int, dealt: bool = False
    ) -> str:
        """SQL for the rows of a table: of a warehouse table, the current versions, with
        their key bucket if they are ``dealt``."""
        parts = self._parts(namespace, name, SPECS[name].key if name in SPECS else ())
        listed = [(b, parts.name(b)) for b, _ in stored.parts]
        closed = f"update_id > {stored.since} AND update_id <= {batch_id}"
        removed = None
        if namespace == self.names.warehouse:
            spec, columns = SPECS[name], WAREHOUSE_TABLES[name].names
            buckets = parts.dealt_into(stored.version) if len(listed) == 1 and listed[0][0] else None
            if dealt and buckets:
                columns = [*columns, KEY_BUCKET]
            if stored.removed:
                key = ", ".join(spec.key)
                removed = (
                    f"SELECT {key}, max({spec.sk}) AS gone FROM {namespace}.{name}__history"
                    f" WHERE {closed} GROUP BY {key}"
                )
            return open_select(columns, [p for _, p in listed], removed, spec.key, spec.sk, buckets)
        columns = STAR_TABLES[name].names
        if name in FACT_SOURCES:
            if stored.removed:
                removed = (
                    f"SELECT {KEYS[name]} AS gone FROM"
                    f" {self.names.warehouse}.{FACT_SOURCES[name]}__history WHERE {closed}"
                )
            return open_select(columns, [p for _, p in listed], removed, (), KEYS[name])
        if stored.removed:
            removed = f"SELECT gone, update_id FROM {namespace}.{name}__gone WHERE {closed}"
        return numbered_open_select(columns, listed, removed, KEYS.get(name, ""))

    def _open(
        self, namespace: str, name: str, stored: Stored, batch_id: int, dealt: bool = False
    ) -> DataFrame:
        return self.spark.sql(self._open_select(namespace, name, stored, batch_id, dealt))

    def _history(self, name: str, batch_id: int, since: int = 0) -> DataFrame:
        return catalog.read_history(
            self.spark, self.names.warehouse, name, WAREHOUSE_TABLES[name], batch_id, since
        )

    def violations(self, state: State | None = None, batch_id: int | None = None) -> DataFrame:
        """Declared constraints of warehouse and star that rows violate, as of the last batch."""
        state = self.state() if state is None else state
        batch_id = self.last_batch_id() if batch_id is None else batch_id
        warehouse = self.warehouse(state, batch_id)
        tables = {name: warehouse.versions(name) for name in warehouse.current}
        for name in STAR_TABLES:
            where = self.names.star, name
            if where in state:
                tables[name] = self._open(*where, state[where], batch_id)
        return constraint_violations(
            tables, WAREHOUSE_TABLES | STAR_TABLES, WAREHOUSE_CONSTRAINTS | STAR_CONSTRAINTS
        )

    def _place(self, warehouse: Warehouse, name: str, state: State, batch_id: int) -> None:
        """Give a warehouse table's frames to ``warehouse``."""
        namespace = self.names.warehouse
        stored = state[namespace, name]
        warehouse.current[name] = self._open(namespace, name, stored, batch_id)
        warehouse.history[name] = self._history(name, batch_id)
        # The oldest part is bucketed, and by far the largest.
        cuts = (stored.parts[:1], stored.parts[1:])
        warehouse.pieces[name] = [
            self._open(namespace, name, replace(stored, parts=cut), batch_id, dealt=cut is cuts[0])
            for cut in cuts if cut
        ]
        keys = state.get((namespace, f"{name}__latest"))
        if keys:
            parts = self._parts(namespace, f"{name}__latest")
            warehouse.given_latest[name] = newest_of(
                [parts.read(b) for b, _ in keys.parts], SPECS[name].key[0]
            )

    def warehouse(self, state: State, batch_id: int) -> Warehouse:
        """The warehouse's frames in the given state."""
        found = Warehouse()
        for name in WAREHOUSE_TABLES:
            if (self.names.warehouse, name) in state:
                self._place(found, name, state, batch_id)
        return found

    def _stage(self, df: DataFrame, name: str) -> DataFrame:
        return catalog.stage_rows(df, self.names.staging, name)

    # -- warehouse -------------------------------------------------------------

    @contextmanager
    def _joined_by_bucket(self) -> Iterator[None]:
        """Joins by key bucket and key need no other shuffle than one by bucket. Spark would shuffle
        by all columns for fear of skew, but buckets are even."""
        name = "spark.sql.requireAllClusterKeysForCoPartition"
        before = self.spark.conf.get(name, None)
        self.spark.conf.set(name, "false")
        try:
            yield
        finally:
            self.spark.conf.unset(name) if before is None else self.spark.conf.set(name, before)

    def _load_warehouse(
        self,
        batch_id: int,
        sources: Mapping[str, DataFrame],
        reviews: DataFrame | None,
        load_ts: str,
        state: State,
        partial: Collection[str] = (),
    ) -> tuple[list[tuple], dict[str, Delta]]:
        """Load every table that has a source, and move ``state`` on."""
        namespace = self.names.warehouse
        before = self.warehouse(state, batch_id - 1)
        after = before.copy()
        given = dict(sources)
        if reviews is not None:
            given[REVIEWS.name] = self._stage(reviews, REVIEWS.name)
        deltas: dict[str, Delta] = {}

        def load(spec: TableSpec) -> tuple:
            name, schema = spec.name, WAREHOUSE_TABLES[spec.name]
            catalog.ensure_history(self.spark, namespace, name, schema)
            stored, parts = state.get((namespace, name)), self._parts(namespace, name, spec.key)
            # A source that holds some rows only says nothing about the others.
            whole = self.options.close_missing and name not in partial
            options = replace(self.options, close_missing=whole)
            base = F.lit(stored.top if stored else 0).cast("long")
            # First versions are written as the shuffle that made their keys has dealt them.
            buckets = parts.buckets if stored is None and parts.by_bucket else None
            done = load_table(
                spec, given[name], before, after, batch_id, load_ts, options, self._stage, base,
                buckets=buckets,
            )
            inserted = done.inserted.select(*schema.names, *([KEY_BUCKET] if buckets else []))
            n_closed = n_inserted = top = 0
            if stored is None:
                found = parts.first(inserted, batch_id)
                fresh = parts.read(batch_id)
            else:
                found, fresh = stored, None
                n_changes, n_closed = done.changes.agg(F.count("*"), F.count(CLOSES)).first()
                if n_changes:
                    fresh = self._stage(inserted, f"{name}_inserted")
            if fresh is not None:
                n_inserted, top = fresh.agg(
                    F.count("*"), F.coalesce(F.max(spec.sk), F.lit(0))
                ).first()
            if stored is None:
                # Without lookups no row can be lost on the way.
                n_changes = done.changes.count() if spec.lookups else n_inserted
            else:
                def close() -> int:
                    if not n_closed and not whole:
                        return 0
                    return catalog.add_partition(
                        done.closed, f"{namespace}.{name}__history", batch_id
                    )

                def keep_latest() -> None:
                    if name in REFERRED and n_inserted:
                        self._add_latest(spec, batch_id, fresh, n_inserted, state)

                n_closed = side_by_side(lambda run: run(), [close, keep_latest])[0]
                if n_inserted or n_closed:
                    none = parts.read(stored.version).limit(0)
                    found = parts.add(
                        stored, batch_id, fresh if n_inserted else none, n_inserted, n_closed,
                        bound(self._merged, namespace, name, batch_id),
                    )
                deltas[name] = Delta(
                    fresh if n_inserted else None,
                    self._history(name, batch_id, batch_id - 1) if n_closed else None,
                    n_inserted, n_closed,
                )
            state[namespace, name] = replace(found, top=max(found.top, top))
            self._place(after, name, state, batch_id)
            if stored is None:  # written with the star
                after.given_latest[name] = fresh.select(spec.key[0], spec.sk)
            return (batch_id, load_ts, namespace, name, found.version, n_inserted, n_closed,
                    n_changes - n_inserted, "ok", None, state[namespace, name].text())

        report = [row for wave in waves(given) for row in side_by_side(load, wave)]
        return report, deltas

    def _merged(
        self, namespace: str, name: str, batch_id: int, stored: Stored, fresh: DataFrame
    ) -> DataFrame:
        return self._open(namespace, name, stored, batch_id).unionByName(fresh)

    def _add_latest(
        self, spec: TableSpec, batch_id: int, fresh: DataFrame, n_fresh: int, state: State
    ) -> None:
        """Keep the latest key of each natural key: a batch's versions are the newest."""
        where, natural = (self.names.warehouse, f"{spec.name}__latest"), spec.key[0]
        parts, keys = self._parts(*where), fresh.select(natural, spec.sk)

        def merge(stored: Stored, rows: DataFrame) -> DataFrame:
            return newest_of([*(parts.read(b) for b, _ in stored.parts), rows], natural)

        state[where] = parts.add(state[where], batch_id, keys, n_fresh, 0, merge)

    # -- star ------------------------------------------------------------------

    def _build_star(self, batch_id: int, state: State) -> None:
        """Build the star in full, and count the references to its dimensions."""
        warehouse = self.warehouse(state, batch_id)

        def save(item: tuple[str, DataFrame]) -> DataFrame:
            name, df = item
            namespace = self.names.star if name in STAR_TABLES or "__refs" in name else self.names.warehouse
            parts = self._parts(namespace, name)
            state[namespace, name] = parts.first(df, batch_id)
            return parts.read(batch_id)

        #: What batches will need, as soon as it can be written.
        waiting = {
            f"{name}__latest": warehouse.current[name].select(SPECS[name].key[0], SPECS[name].sk)
            for name in REFERRED if name in warehouse.current
        }
        waiting |= {f"{d}__refs": first_counts(d, warehouse.current) for d in FIRST}

        def keep(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
            if "dim_airport" in tables:
                flights = self._parts(self.names.star, "dim_flight").read(batch_id)
                waiting.update({f"{d}__refs": first_counts(d, {"dim_flight": flights}) for d in SECOND})
            given = tables | waiting
            waiting.clear()
            found = dict(zip(given, side_by_side(save, given.items()), strict=True))
            return {name: found[name] for name in tables}

        build_star(self.spark, warehouse, keep=keep)

    def _refresh_star(self, batch_id: int, state: State, deltas: Mapping[str, Delta]) -> None:
        """Bring the star up to date with what a batch inserted and closed."""
        namespace = self.names.star
        referring = {table for found in REFERENCES.values() for table, _ in found}

        def add(name: str, fresh: DataFrame, n_fresh: int, n_removed: int) -> None:
            parts = self._parts(namespace, name)
            state[namespace, name] = parts.add(
                state[namespace, name], batch_id, fresh, n_fresh, n_removed,
                bound(self._merged, namespace, name, batch_id),
            )

        def fact(name: str) -> None:
            delta, stored = deltas.get(FACT_SOURCES[name]), state[namespace, name]
            if delta and delta.fresh is not None:
                add(name, PROJECTIONS[name](delta.fresh), delta.n_fresh, delta.n_closed)
            elif delta and delta.n_closed:
                none = self._parts(namespace, name).read(stored.version).limit(0)
                add(name, none, 0, delta.n_closed)

        def dimension(name: str, moved: Mapping[str, Delta]) -> Delta:
            """Bring one dimension up to date; what came and what went."""
            table, sk, project = DIMENSION_SOURCES[name], KEYS[name], PROJECTIONS[name]
            own = deltas.get(table, Delta(None, None, 0, 0))
            came, went, n_back, n_gone = [], None, 0, 0
            if own.fresh is not None:
                came.append(project(own.fresh))
            changes = count_changes(name, moved, own.closed)
            if changes is not None:
                changes = self._stage(changes, f"{name}_count_changes")
                refs = self._parts(namespace, f"{name}__refs")
                counts = state[namespace, f"{name}__refs"]

                def switch() -> DataFrame:
                    known = [refs.read(b) for b, _ in counts.parts]
                    return self._stage(moves(changes, known), f"{name}_moves")

                def count() -> Stored:
                    return refs.add(
                        counts, batch_id, changes, changes.count(), 0,
                        lambda some, rows: summed([*(refs.read(b) for b, _ in some.parts), rows]),
                    )

                switched, state[namespace, f"{name}__refs"] = side_by_side(
                    lambda run: run(), [switch, count]
                )
                n_back, n_gone = switched.agg(
                    F.count_if("came"), F.count_if(~F.col("came"))
                ).first()
                keys = switched.select(F.col("sk").alias(sk), "came")
                if n_back:
                    past = self._history(table, batch_id)
                    came.append(project(past.join(keys.where("came"), sk, "left_semi")))
                if n_gone:
                    gone = keys.where("NOT came")
                    catalog.ensure_removed(self.spark, namespace, name)
                    catalog.add_partition(
                        gone.select(F.col(sk).alias("gone"), F.lit(batch_id).cast("int").alias("update_id")),
                        f"{namespace}.{name}__gone", batch_id,
                    )
                    if name in referring:
                        rows = self._removed_rows(table, sk, gone, own, n_gone, batch_id)
                        went = self._stage(project(rows), f"{name}_went")
            fresh = came[0] if len(came) == 1 else came[0].unionByName(came[1]) if came else None
            if fresh is None and n_gone:
                fresh = self._parts(namespace, name).read(state[namespace, name].version).limit(0)
            n_fresh = own.n_fresh + n_back
            if n_fresh or n_gone:
                add(name, fresh, n_fresh, n_gone)
            return Delta(fresh if n_fresh else None, went, n_fresh, n_gone)

        first = [lambda n=n: fact(n) for n in FACT_SOURCES]
        first += [lambda n=n: dimension(n, deltas) for n in FIRST]
        done = dict(zip([*FACT_SOURCES, *FIRST], side_by_side(lambda run: run(), first)))
        moved = {"dim_flight": done["dim_flight"]}
        side_by_side(lambda name: dimension(name, moved), SECOND)

    def _removed_rows(
        self, table: str, sk: str, gone: DataFrame, own: Delta, n_gone: int, batch_id: int
    ) -> DataFrame:
        """The versions that leave a dimension. Most were closed in this very batch; history is
        read only if some were closed before and kept for their references."""
        if own.closed is not None:
            now = own.closed.join(gone, sk, "left_semi")
            if now.count() == n_gone:
                return now
        return self._history(table, batch_id).join(gone, sk, "left_semi")

    # -- publishing ------------------------------------------------------------

    def _published(self, namespace: str, name: str, stored: Stored, batch_id: int) -> str:
        """SQL for the logical table."""
        select = self._open_select(namespace, name, stored, batch_id)
        if namespace == self.names.star or (0, 0) in stored.parts:
            return select
        columns = ", ".join(WAREHOUSE_TABLES[name].names)
        return (
            f"{select} UNION ALL SELECT {columns} FROM {namespace}.{name}__history"
            f" WHERE update_id <= {batch_id}"
        )

    def _publish(
        self,
        batch_id: int,
        changed: Collection[tuple[str, str]],
        previous: State,
        state: State,
        attempt: str | None = None,
    ) -> None:
        """Make the logical tables views of ``state``; for an attempt that is not committed yet, of
        the previous state until it is."""
        for namespace, name in changed:
            if not _is_logical(name):
                continue
            select = self._published(namespace, name, state[namespace, name], batch_id)
            if attempt:
                stored = previous.get((namespace, name), Stored(((0, 0),)))
                before = self._published(namespace, name, stored, batch_id - 1)
                done = (
                    f"(SELECT count(*) FROM {self._audit_table} WHERE namespace = 'batch'"
                    f" AND status = 'ok' AND message = '{attempt}') > 0"
                )
                select = (
                    f"SELECT * FROM ({before}) WHERE NOT {done}"
                    f" UNION ALL SELECT * FROM ({select}) WHERE {done}"
                )
            catalog.publish(self.spark, namespace, name, select)
