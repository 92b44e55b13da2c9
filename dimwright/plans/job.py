"""End-to-end batch job over a contract: ingest -> dimensions -> warehouse -> DQ.

Storage layout under one root (any Hadoop filesystem):

    <root>/feed/            classified records, parquet, partitioned by
                            source_batch_date and ingest_part; record_status
                            is valid | invalid
    <root>/dims/<name>/     dimension snapshots, cut into buckets of the business key
    <root>/warehouse/<t>/   warehouse tables: dimensions with surrogate keys and
                            updated_at, in the same buckets; facts with
                            loaded_at, a part per date_id; dim_date
    <root>/ledger/          counts of (batch, status, key) and of (batch, field,
                            code), a part per batch; the metrics come from them
    <root>/violations/<t>/  what the last load of a table found: duplicate
                            natural keys, orphans, NULL measures
    <root>/control/<t>/     versioned control tables: etl_runs,
                            etl_ingestion_batches, etl_scd_batches, dq_run_metrics

Every write goes to new directories and is published by repointing
``_CURRENT``; a plan never overwrites what it reads.  A load reads and replaces
only the buckets that hold keys of its batches, and only the facts of their
dates; all other files stay as they are.  Commit order makes a crash at any
point recoverable by simply running again:

1. feed partitions of a batch are replaced idempotently, then its ingestion
   marker is written;
2. a dimension snapshot is published, then its batches are marked applied
   (with the warehouse marker cleared);
3. warehouse dimensions are upserted from the rows touched by the runs of the
   unloaded batches; the base dimension's batches are marked loaded only after
   the fact load, so a crash re-drives both.

Many pending batches are folded in one pass (no per-batch job loop).  After a
late batch (earlier than the latest applied one) the keys that it holds are
folded anew from all their batches, and the facts of the dates that their
versions lie in are loaded again; a contract-version change replays everything.
"""

from __future__ import annotations

import datetime as _dt
import json
import time
from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimwright.contract import Contract, DimensionSpec
from dimwright.operators import checks, dq, keys, marts, scd, shape, state, validate, warehouse
from dimwright.operators.plan_utils import sized_broadcast
from dimwright.operators.validate import ERRORS_COL, STATUS_COL
from dimwright.session import ensure_checkpoint_dir
from dimwright.sources import jsonl, paths, sinks

INGEST_SCHEMA = T.StructType([
    T.StructField("batch_date", T.DateType()), T.StructField("run_id", T.StringType()),
    T.StructField("first_processed_at", T.TimestampType()), T.StructField("processed_at", T.TimestampType()),
    T.StructField("input_record_count", T.LongType())])
SCD_SCHEMA = T.StructType([
    T.StructField("batch_date", T.DateType()), T.StructField("dimension_name", T.StringType()),
    T.StructField("contract_version", T.StringType()), T.StructField("run_id", T.StringType()),
    T.StructField("first_processed_on", T.TimestampType()), T.StructField("processed_on", T.TimestampType()),
    T.StructField("warehouse_loaded_on", T.TimestampType())])
RUNS_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()), T.StructField("started_at", T.TimestampType()),
    T.StructField("completed_at", T.TimestampType()), T.StructField("status", T.StringType()),
    T.StructField("error_text", T.StringType()), T.StructField("violations", T.LongType())])


DQ_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()), T.StructField("measured_at", T.TimestampType()),
    T.StructField("input_records", T.LongType()), T.StructField("valid_records", T.LongType()),
    T.StructField("invalid_records", T.LongType()), T.StructField("total_records", T.LongType()),
    T.StructField("reconciliation_difference", T.LongType()),
    T.StructField("valid_rate", T.DoubleType()), T.StructField("invalid_rate", T.DoubleType()),
    T.StructField("batch_count", T.LongType()),
    T.StructField("per_batch_valid", T.StringType()), T.StructField("per_batch_invalid", T.StringType()),
    T.StructField("invalid_error_breakdown", T.StringType()),
    T.StructField("valid_duplicate_rate", T.DoubleType()), T.StructField("invalid_duplicate_rate", T.DoubleType()),
    T.StructField("dimension_counts", T.StringType()), T.StructField("fact_rows", T.StringType())])


def _percent(part: int | None, total: int) -> float:
    """HALF_UP to two decimals; 0 without records."""
    return ((part or 0) * 20000 + total) // (2 * total) / 100.0 if total else 0.0


#: bucket of the business key that a stored dimension row lies in
BUCKET_COL = "key_bucket"
BATCH_COL = "source_batch_date"


class PipelineError(RuntimeError):
    pass


@dataclass
class Pipeline:
    spark: SparkSession
    contract: Contract
    input_root: str
    root: str
    #: a dimension built as a whole gets a bucket per so many source records, at most ``max_buckets``
    bucket_records: int = 1_000_000
    max_buckets: int = 4096
    #: marts kept up to date by each load of their fact
    marts: tuple[marts.MartSpec, ...] = ()
    # test hook: called with a stage name; raising simulates a crash there
    fault: Callable[[str], None] = field(default=lambda stage: None)
    # buckets of each dimension that the running load wrote
    _touched: dict[str, list[str]] = field(default_factory=dict)
    # runs whose versions the running load took up, and whether it took up a dimension as a whole
    _loaded: dict[str, tuple[set[str], bool]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        bases = {f.name: f.base for f in self.contract.facts}
        for mart in self.marts:
            if mart.fact not in bases or self.contract.dimension(bases[mart.fact]).business_key != mart.entity:
                raise PipelineError(f"mart {mart.name}: its entity must be the business key of the base of {mart.fact}")

    # ------------------------------------------------------------ storage
    def _path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    def _read(self, kind: str, name: str, schema: T.StructType | None = None) -> DataFrame | None:
        df = sinks.read_snapshot(self.spark, self._path(kind, name))
        if schema is None:
            return df
        if df is None:
            return self.spark.createDataFrame([], schema)
        # columns that an earlier version did not write are NULL
        return df.select(*[F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema])

    def _publish(self, kind: str, name: str, df: DataFrame, meta: dict | None = None) -> None:
        sinks.write_snapshot(df, self._path(kind, name), meta=meta)

    def control(self, name: str) -> DataFrame:
        schema = {"etl_ingestion_batches": INGEST_SCHEMA, "etl_scd_batches": SCD_SCHEMA,
                  "etl_runs": RUNS_SCHEMA}.get(name)
        return self._read("control", name, schema)

    def dimension(self, name: str, buckets: list[str] | None = None) -> DataFrame | None:
        df = sinks.read_parts(self.spark, self._path("dims", name), buckets)
        return None if df is None else df.drop(BUCKET_COL)

    def table(self, name: str, parts: list[str] | None = None) -> DataFrame | None:
        df = sinks.read_parts(self.spark, self._path("warehouse", name), parts)
        return None if df is None else df.drop(BUCKET_COL)

    def _bucket_count(self) -> int:
        records = self.control("etl_ingestion_batches").agg(F.sum("input_record_count").alias("n")).first()["n"] or 0
        return max(1, min(self.max_buckets, -(-records // self.bucket_records)))

    # ------------------------------------------------------------ run bookkeeping
    def _run_row(self, run_id: str, status: str, started, completed=None, error: str | None = None, violations: int | None = None) -> None:
        runs = self.control("etl_runs")
        row = self.spark.createDataFrame([(run_id, started, completed, status, (error or "")[:4000] or None, violations)], RUNS_SCHEMA)
        self._publish("control", "etl_runs",
                      state.upsert_by_key(runs, row, ["run_id"], keep_first=["started_at"]))

    def run(self, run_id: str, now: _dt.datetime | None = None) -> dict:
        now = now or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        ensure_checkpoint_dir(self.spark)
        begun = time.monotonic()
        self._run_row(run_id, "running", now)

        def end() -> _dt.datetime:
            return now + _dt.timedelta(seconds=time.monotonic() - begun)

        try:
            out = {"ingestion": self.run_ingestion(run_id, now)}
            out["dimensions"] = self.run_dimensions(run_id, now)
            out["warehouse"] = self.run_warehouse(run_id, now)
            out["violations"] = self.check_tables(out["warehouse"])
            out["dq"] = self.run_dq(run_id, now)
        except Exception as e:
            self._run_row(run_id, "failed", now, end(), f"{type(e).__name__}: {e}")
            raise
        self._run_row(run_id, "success", now, end(), violations=sum(out["violations"].values()))
        return out

    # ------------------------------------------------------------ A: ingestion
    def _batch_path(self, d: str) -> str:
        """``{date}`` pattern from the contract, else a file glob inside batch-<date>/."""
        p = self.contract.feed.path or "*"
        if "{date}" in p:
            return jsonl.batch_path(p, d)
        return f"{self.input_root.rstrip('/')}/batch-{d}/{p}"

    def run_ingestion(self, run_id: str, now: _dt.datetime) -> dict:
        feed = self.contract.feed
        discovered = paths.discover_batch_dates(self.spark, self.input_root)
        done = {r["batch_date"].isoformat() for r in self.control("etl_ingestion_batches")
                .select("batch_date").collect()}  # one row per batch (control table)
        pending = [d for d in discovered if d not in done]
        if not pending:
            return {"pending": []}
        batch_paths = [self._batch_path(d) for d in pending]
        reader = self.spark.read.format(feed.format).options(**dict(feed.options)).option("mode", "PERMISSIVE")
        if feed.enforce_schema and feed.schema is not None:
            reader = reader.schema(feed.schema)
        existing = [p for p in batch_paths if paths.path_exists(self.spark, p)]
        empty = [f for p in existing for f in paths.empty_files(self.spark, p)]
        if empty:
            raise PipelineError(f"empty input files: {empty}")
        missing = sorted(set(batch_paths) - set(existing))
        if missing and feed.required:
            raise PipelineError(f"required input missing: {missing}")
        read: dict[str, int] = {}
        if existing:  # a batch of an optional source without files is marked with 0 records
            raw = reader.load(existing)
            batch = F.to_date(F.regexp_extract(F.col("_metadata.file_path"), r"batch-(\d{4}-\d{2}-\d{2})", 1))
            stamped = raw.withColumns({"source_batch_date": batch, "processed_run_id": F.lit(run_id)})
            # records as the source delivers them, counted while they pass by
            counter = Observation("source records")
            of = {d: F.col("source_batch_date") == F.lit(d).cast("date") for d in pending}
            blank = F.lit(feed.enforce_schema and feed.schema is not None)
            for c in feed.schema.names if feed.schema is not None else ():
                blank = blank & F.col(f"`{c}`").isNull()
            stamped = stamped.observe(counter, *[F.count_if(x).alias(d) for d, x in of.items()],
                                      *[F.count_if(x & blank).alias(f"{d} unparsed") for d, x in of.items()])
            classified = validate.classify(stamped, feed.validations) \
                .withColumn("ingestion_dt", F.lit(now).cast("timestamp"))
            sinks.write_split(classified, self._path("feed"), batches=pending)
            read = dict(counter.get)
            lost = [d for d in pending if read.get(d) and read[d] == read.get(f"{d} unparsed")]
            if lost:  # not marked as ingested: a mended file is taken by the next run
                raise PipelineError(f"no record of these batches can be read under the declared schema: {lost}")
        self.fault("after_feed_write")
        marks = (self.spark.createDataFrame([(d, int(read.get(d) or 0)) for d in pending], "d string, n long")
                 .select(F.col("d").cast("date").alias("batch_date"), F.lit(run_id).alias("run_id"),
                         F.lit(now).cast("timestamp").alias("first_processed_at"),
                         F.lit(now).cast("timestamp").alias("processed_at"), F.col("n").alias("input_record_count")))
        self._publish("control", "etl_ingestion_batches",
                      state.upsert_by_key(self.control("etl_ingestion_batches"), marks, ["batch_date"],
                                          keep_first=["first_processed_at"]))
        return {"pending": pending}

    # ------------------------------------------------------------ B: dimensions
    def valid_rows(self, batch_dates: list[str] | None) -> DataFrame:
        return sinks.read_split(self.spark, self._path("feed"), "valid", batch_dates)

    def run_dimensions(self, run_id: str, now: _dt.datetime) -> dict:
        ingested = self.control("etl_ingestion_batches").select("batch_date")
        # batches present in the feed, from its partition directories (metadata only)
        listed = sinks.partition_values(self.spark, self._path("feed"), "source_batch_date")
        feed_batches = self.spark.createDataFrame([(d,) for d in listed], "b string").select(
            F.col("b").cast("date").alias("batch_date"))
        missing = [r["batch_date"] for r in state.missing_ingestion_state(feed_batches, ingested).collect()]
        if missing:
            raise PipelineError(f"valid batches missing ingestion state: {missing}")
        all_batches = sorted(r["batch_date"].isoformat() for r in ingested.collect())
        report = {}
        for spec in self.contract.dimensions:
            report[spec.name] = self._apply_dimension(spec, all_batches, run_id, now)
        return report

    def _repair(self, spec: DimensionSpec, now: _dt.datetime) -> None:
        """Roll the control table forward to the published snapshot.

        A crash between publishing a snapshot and marking its batches leaves
        batches in the snapshot that the control table does not know; they
        are marked applied (by the run that wrote them) before planning.
        """
        meta = sinks.snapshot_meta(self.spark, self._path("dims", spec.name))
        if not meta or "batches" not in meta:
            return
        ctl = self.control("etl_scd_batches")
        applied = {r["batch_date"].isoformat() for r in
                   ctl.where(F.col("dimension_name") == spec.name).select("batch_date").collect()}
        missing = sorted(set(meta["batches"]) - applied)
        if not missing and not (meta.get("rebuild") and set(meta["batches"]) != applied):
            return
        if meta.get("rebuild"):
            ctl = state.clear_markers(ctl, spec.name)
        b = self.spark.createDataFrame([(x,) for x in meta["batches"]], "batch_date string")
        ctl = state.mark_scd_done(ctl, b, spec.name, meta["run_id"], meta["contract_version"],
                                  F.lit(now).cast("timestamp"))
        self._publish("control", "etl_scd_batches", ctl)

    def _apply_dimension(self, spec: DimensionSpec, all_batches: list[str], run_id: str,
                         now: _dt.datetime) -> dict:
        self._repair(spec, now)
        ctl = self.control("etl_scd_batches")
        mine = ctl.where(F.col("dimension_name") == spec.name)
        applied = sorted(r["batch_date"].isoformat() for r in mine.select("batch_date").collect())
        latest = state.latest_version(mine).collect()
        rebuild = bool(applied) and bool(latest) and latest[0]["latest_version"] != spec.contract_version
        pending = all_batches if rebuild else [b for b in all_batches if b not in set(applied)]
        late = bool(applied and pending and not rebuild and min(pending) < max(applied))
        if not pending:
            return {"status": "skipped", "pending": []}
        root = self._path("dims", spec.name)
        meta = sinks.snapshot_meta(self.spark, root)
        if applied and meta is None and not rebuild:
            raise PipelineError(f"{spec.name}: batches up to {max(applied)} are marked applied, but there is no snapshot")
        rows = scd.prepare(self.valid_rows(pending), spec)
        whole = rebuild or meta is None or "buckets" not in meta
        buckets = self._bucket_count() if whole else meta["buckets"]
        bucket = keys.bucket_of(spec.business_key, buckets)
        # buckets that hold keys of the pending batches; at most ``buckets`` numbers
        touched = None if whole else sorted(str(r["b"]) for r in rows.select(bucket.alias("b")).distinct().collect())
        current = None if rebuild or meta is None else self.dimension(spec.name, touched)
        refolded = None
        if current is None:
            new_state = scd.replay(rows, spec, run_id)
        elif late:
            held = rows.select(spec.business_key).where(F.col(f"`{spec.business_key}`").isNotNull()).distinct().checkpoint()
            refolded = held.count()
            folded = self._rows_of_keys(sorted({*applied, *pending}), held, spec)
            new_state = scd.refold(current, folded.unionByName(rows.where(F.col(f"`{spec.business_key}`").isNull())), held, spec, run_id)
        elif len(pending) == 1:
            new_state = scd.apply_batch(current, rows, spec, run_id)
        else:
            new_state = scd.apply_batches(current, rows, spec, run_id)
        # facts to load again after a late batch: the dates of its keys' versions, before and after
        moved = {} if whole else dict(meta.get("late") or {})
        if refolded is not None:
            moved[run_id] = self._dates(current.join(held, spec.business_key, "left_semi"), spec) | self._dates(
                new_state.where(F.col("last_updated_run_id") == run_id), spec) | set(pending)
            moved[run_id] = sorted(moved[run_id])
        contained = sorted(set(pending) | (set() if rebuild else set(applied)))
        # the run that wrote a bucket last, so that a warehouse load finds the buckets of its runs
        every = [str(b) for b in range(buckets)]
        wrote = {**({} if whole else meta["wrote"]), **{b: run_id for b in (every if whole else touched)}}
        sinks.write_parts(new_state.withColumn(BUCKET_COL, bucket), root, BUCKET_COL, touched,
                          meta={"batches": contained, "run_id": run_id, "contract_version": spec.contract_version, "rebuild": rebuild,
                                "rebuilt_by": run_id if whole else meta.get("rebuilt_by"), "buckets": buckets, "wrote": wrote, "late": moved})
        self.fault(f"after_snapshot:{spec.name}")
        if rebuild:
            ctl = state.clear_markers(ctl, spec.name)
        batches = self.spark.createDataFrame([(b,) for b in pending], "batch_date string")
        ctl = state.mark_scd_done(ctl, batches, spec.name, run_id, spec.contract_version,
                                  F.lit(now).cast("timestamp"))
        self._publish("control", "etl_scd_batches", ctl)
        return {"status": "success", "pending": pending, "rebuild": rebuild, "refolded_keys": refolded}

    def _rows_of_keys(self, batches: list[str], held: DataFrame, spec: DimensionSpec) -> DataFrame:
        """Prepared rows of some business keys in some batches; the filter goes before the deduplication where it can."""
        rows, source = self.valid_rows(batches), scd.source_key(spec)
        if source in rows.columns:
            return scd.prepare(rows.join(sized_broadcast(held.withColumnRenamed(spec.business_key, source)), source, "left_semi"), spec)
        return scd.prepare(rows, spec).join(sized_broadcast(held), spec.business_key, "left_semi")

    @staticmethod
    def _dates(versions: DataFrame, spec: DimensionSpec) -> set[str]:
        """Batch dates of some versions; at most one per batch."""
        return {str(r["d"]) for r in versions.select(F.col(spec.batch_column).cast("date").alias("d")).distinct().collect()}

    # ------------------------------------------------------------ C: warehouse
    def _load_dimension(self, spec: DimensionSpec, run_id: str, now: _dt.datetime) -> list[str]:
        ctl = self.control("etl_scd_batches")
        pend = state.pending_star(ctl, spec.name)
        pending = [r["batch_date"].isoformat() for r in pend.collect()]
        if not pending:
            return []
        runs = state.pending_run_ids(ctl, spec.name, pend)
        names = {r["run_id"] for r in runs.collect()}  # a row per pending run
        snapshot = sinks.snapshot_meta(self.spark, self._path("dims", spec.name))
        buckets = snapshot["buckets"]
        root = self._path("warehouse", spec.table)
        meta = sinks.snapshot_meta(self.spark, root)
        # a snapshot that one of the runs built as a whole may lack versions that the table has
        whole = meta is None or meta.get("buckets") != buckets or snapshot["rebuilt_by"] in names
        touched = [str(b) for b in range(buckets)] if whole else sorted(b for b, run in snapshot["wrote"].items() if run in names)
        snap = self.dimension(spec.name, touched)
        staging = state.rows_of_runs(snap, runs)
        dups = checks.natural_key_dups(staging, list(spec.nk_columns))
        n_dups = dups.count()
        if n_dups:
            self._publish("violations", spec.name, dups)
            raise PipelineError(f"{spec.name}: duplicate natural key: {n_dups} of them, listed in violations/{spec.name}; "
                                f"the first is {dups.first().asDict()}")
        key = warehouse.surrogate_key_name(spec.name)
        stamp = F.lit(now).cast("timestamp")
        staging = shape.cast_to(staging, dict(spec.load_types)).withColumn("updated_at", stamp)
        if meta is None:
            loaded, base = warehouse.warehouse_dimension(staging, spec), 0
        else:
            target = self.table(spec.table, None if whole else touched)
            base = meta["max_key"] if "max_key" in meta else self.table(spec.table).agg(F.max(key)).first()[0] or 0
            # a rebuild or a late batch may have removed versions
            same = [F.col(f"t.`{c}`").eqNullSafe(F.col(f"s.`{c}`")) for c in spec.nk_columns]
            target = target.alias("t").join(snap.select(*spec.nk_columns).alias("s"), same, "left_semi")
            loaded = keys.merge_upsert(target, staging, list(spec.nk_columns), key, audit={"updated_at": stamp}, base=base)
        loaded = loaded.withColumn(BUCKET_COL, keys.bucket_of(spec.business_key, buckets))
        # the highest key given is known only once the rows are written: it goes into the pointer with them
        sinks.write_parts(loaded, root, BUCKET_COL, None if whole else touched, observe={"max_key": F.max(key)},
                          publish=lambda got: {"buckets": buckets, "max_key": max(base, got.get("max_key") or 0)})
        self._touched[spec.name], self._loaded[spec.name] = touched, (names, whole)
        return pending

    def run_warehouse(self, run_id: str, now: _dt.datetime) -> dict:
        base_names = {f.base for f in self.contract.facts}
        loaded: dict[str, list[str]] = {}
        for spec in self.contract.dimensions:
            loaded[spec.name] = self._load_dimension(spec, run_id, now)
            if spec.name not in base_names and loaded[spec.name]:
                self._mark_loaded(spec.name, loaded[spec.name], now)
        # calendar covering every ingested batch
        dates = self.control("etl_ingestion_batches").select(F.col("batch_date").alias("source_batch_date"))
        cal = warehouse.calendar(dates)
        old = self.table("dim_date")
        self._publish("warehouse", "dim_date",
                      cal if old is None else keys.merge_append_missing(old, cal, ["date_id"]))
        self.fault("before_fact")
        for fact in self.contract.facts:
            base_spec = self.contract.dimension(fact.base)
            pending = loaded.get(fact.base) or []
            if not pending:
                continue
            dims = {d: self.table(self.contract.dimension(d).table) for _, d, _, _ in fact.foreign_keys}
            root = self._path("warehouse", fact.name)
            stored = sinks.snapshot_meta(self.spark, root) or {}
            moved = sinks.snapshot_meta(self.spark, self._path("dims", base_spec.name)).get("late") or {}
            done = set(stored.get("late_done") or ())
            due = sorted({*pending, *(d for run, dates in moved.items() if run not in done for d in dates)})
            dates = [d.replace("-", "") for d in due]
            batch_df = self.spark.createDataFrame([(b,) for b in due], "d string").select(
                F.col("d").cast("date").alias(fact.date_source))
            # versions of new dates lie in the buckets that the pending runs wrote, those of older dates anywhere
            fresh = not any(d in (stored.get("parts") or {}) for d in dates)
            base = self.table(base_spec.table, self._touched[fact.base] if fresh else None)
            rows = warehouse.fact_rows(base, base_spec, fact, dims, batch_df).withColumn("loaded_at", F.lit(now).cast("timestamp"))
            self._publish("violations", fact.name, self._fact_violations(fact, base_spec, self.table(base_spec.table), dims, run_id))
            if "path" in stored:  # stored as a whole by an earlier version
                rows = self.table(fact.name).where(~F.col("date_id").isin([int(d) for d in dates])).unionByName(rows)
            sinks.write_parts(rows, root, "date_id", None if "path" in stored else dates, meta={"late_done": sorted(done | set(moved))})
            for mart in self.marts:
                if mart.fact == fact.name:
                    self._keep_mart(mart, base_spec, again=not fresh)
            self._mark_loaded(fact.base, pending, now)
        return {k: v for k, v in loaded.items()}

    def mart(self, name: str) -> DataFrame | None:
        """Figures of a kept mart by its groups; None if no load has written it."""
        groups = self._read("marts", f"{name}/groups")
        return None if groups is None else marts.served(groups)

    def _keep_mart(self, mart: marts.MartSpec, base_spec: DimensionSpec, again: bool) -> None:
        """Bring a mart up to date after a fact load.

        Only entities that the load touched are summed anew: their stored pairs are taken back from the groups, their new
        ones added, and only the buckets they lie in are written.  The mart is built as a whole if the load wrote dates
        ``again`` (late batches, a load that was cut off) or the dimension as a whole.  The groups name the number of the
        pairs they follow; groups of another number (a crash between the two) are summed from the pairs.
        """
        root, groups_root = self._path("marts", mart.name, "pairs"), self._path("marts", mart.name, "groups")
        stored, runs = sinks.snapshot_meta(self.spark, root), self._loaded[base_spec.name]
        buckets = sinks.snapshot_meta(self.spark, self._path("warehouse", base_spec.table))["buckets"]
        whole = again or runs[1] or not stored or (stored["buckets"], stored["definition"]) != (buckets, repr(mart))
        touched = None if whole else self._touched[base_spec.name]
        key = warehouse.surrogate_key_name(base_spec.name)
        versions, entities = self.table(base_spec.table, touched), None
        if not whole:
            entities = versions.where(F.col("last_updated_run_id").isin(sorted(runs[0]))).select(
                F.col(f"`{mart.entity}`").alias("entity"), F.lit(True).alias("__touched")).distinct().checkpoint()
            versions = versions.join(sized_broadcast(entities), F.col(f"`{mart.entity}`").eqNullSafe(F.col("entity")), "left_semi")
        facts = self.table(mart.fact)
        rows = facts.join(sized_broadcast(versions.select(key, *[c for c in versions.columns if c not in facts.columns])), key)
        after = marts.pairs(rows, mart).checkpoint()
        kept, before, groups = None, None, None
        if not whole:
            old = sinks.read_parts(self.spark, root, touched).drop(BUCKET_COL)
            named = entities.withColumnRenamed("entity", "__entity")
            old = old.join(sized_broadcast(named), F.col("entity").eqNullSafe(F.col("__entity")), "left").drop("__entity")
            before, kept = old.where("__touched").drop("__touched"), old.where("__touched IS NULL").drop("__touched")
            if (sinks.snapshot_meta(self.spark, groups_root) or {}).get("number") == stored["number"]:
                groups = sinks.read_snapshot(self.spark, groups_root)
            else:
                groups = marts.group_change(None, sinks.read_parts(self.spark, root).drop(BUCKET_COL), mart)
        change = marts.group_change(before, after, mart)
        groups = change if groups is None else marts.merge_groups(groups, change, mart)
        number = (stored or {}).get("number", 0) + 1
        pairs = after if kept is None else kept.unionByName(after)
        sinks.write_parts(pairs.withColumn(BUCKET_COL, keys.bucket_of("entity", buckets)), root, BUCKET_COL, touched,
                          meta={"buckets": buckets, "definition": repr(mart), "number": number})
        self.fault(f"after_pairs:{mart.name}")
        sinks.write_snapshot(groups, groups_root, meta={"number": number})

    def check_tables(self, loaded: dict[str, list[str]]) -> dict[str, int]:
        """Violations in what a load left in the tables, by check; the rows are kept under ``violations``.

        Dimensions are checked in the buckets that the load wrote: exactly one current version, no gap between versions,
        and the same rows in the snapshot and in the warehouse.  Facts add what their load has found.
        """
        found = {}
        for spec in self.contract.dimensions:
            if not loaded.get(spec.name):
                continue
            touched = self._touched[spec.name]
            snap, table = self.dimension(spec.name, touched), self.table(spec.table, touched)
            fields = [c for c in snap.columns if c not in spec.nk_columns]
            parts = {"snapshot": checks.snapshot_differences(shape.cast_to(snap, dict(spec.load_types)), table, list(spec.nk_columns), fields)}
            if spec.is_scd2 and "is_current" in table.columns:
                known = table.where(F.col(f"`{spec.business_key}`").isNotNull())
                parts["one_current"] = checks.one_current(known, spec.business_key)
                parts["gapless"] = checks.gapless_versions(known, spec.business_key)
            for name, rows in parts.items():
                found[f"{spec.name}: {name}"] = n = rows.count()
                if n:
                    self._publish("violations", f"{spec.name}-{name}", rows)
        for fact in self.contract.facts:
            if loaded.get(fact.base):
                found[fact.name] = self._read("violations", fact.name).agg(F.sum("violations").alias("n")).first()["n"] or 0
        return found

    def _fact_violations(self, fact, base_spec: DimensionSpec, base: DataFrame, dims: dict, run_id: str) -> DataFrame:
        """What the fact load leaves out or cannot trust: orphaned foreign keys and NULL measures, counted per check."""
        key = warehouse.surrogate_key_name(base_spec.name)
        parts = [checks.fk_orphans(base, dims[d], src, bk, [key]).agg(F.count(F.lit(1)).alias("violations"))
                 .select(F.lit("orphan").alias("check"), F.lit(fk).alias("column_name"), "violations")
                 for fk, d, src, bk in fact.foreign_keys]
        parts.append(checks.not_null(base, [src for _, src in fact.measures]).select(
            F.lit("null_measure").alias("check"), "column_name", F.col("null_count").alias("violations")))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out.withColumn("run_id", F.lit(run_id))

    def _mark_loaded(self, dim: str, batches: list[str], now) -> None:
        ctl = self.control("etl_scd_batches")
        b = self.spark.createDataFrame([(x,) for x in batches], "batch_date string")
        self._publish("control", "etl_scd_batches",
                      state.mark_loaded(ctl, b, dim, F.lit(now).cast("timestamp")))

    # ------------------------------------------------------------ D: data quality
    def run_dq(self, run_id: str, now: _dt.datetime) -> dict:
        keys_ = list(self.contract.feed.uniqueness_keys)
        entries, errors = self._ledger(keys_)
        inputs = self.control("etl_ingestion_batches").select(F.col("batch_date").alias("batch"), F.col("input_record_count").alias("input_records"))
        counts = dq.ledger_counts(entries, BATCH_COL, STATUS_COL).withColumnRenamed(BATCH_COL, "batch")
        recs = dq.reconciled(inputs, counts).collect()  # a row per batch and a total
        rec = next(r for r in recs if r["is_total"])
        batches = sorted((r for r in recs if not r["is_total"]), key=lambda r: str(r["batch"]))
        broken = dq.breakdown_json(errors.groupBy("field", "code").agg(F.sum("error_count").alias("error_count"))).first()
        rates = ({r[STATUS_COL]: r for r in dq.ledger_duplicate_rates(entries, BATCH_COL, STATUS_COL, keys_).where("is_total").collect()}
                 if keys_ else {})  # at most one row per status
        vdup, idup = rates.get("valid"), rates.get("invalid")
        dims = {d.name: self.dimension(d.name) for d in self.contract.dimensions
                if self.dimension(d.name) is not None}
        dim_counts = {r["dimension_name"]: r.asDict() for r in dq.dimension_counts(dims).collect()} \
            if dims else {}
        fact_rows = {f.name: (self.table(f.name).count() if self.table(f.name) is not None else 0)
                     for f in self.contract.facts}
        total = (rec["valid_records"] or 0) + (rec["invalid_records"] or 0)
        row = {
            "run_id": run_id, "measured_at": now,
            "input_records": rec["input_records"], "valid_records": rec["valid_records"],
            "invalid_records": rec["invalid_records"], "total_records": total,
            "reconciliation_difference": rec["difference"],
            "valid_rate": _percent(rec["valid_records"], total), "invalid_rate": _percent(rec["invalid_records"], total),
            "batch_count": len(batches),
            "per_batch_valid": {str(r["batch"]): r["valid_records"] for r in batches},
            "per_batch_invalid": {str(r["batch"]): r["invalid_records"] for r in batches},
            "invalid_error_breakdown": json.loads(broken["error_breakdown"] or "{}"),
            "valid_duplicate_rate": vdup["duplicate_rate"] if vdup else None,
            "invalid_duplicate_rate": idup["duplicate_rate"] if idup else None,
            "dimension_counts": dim_counts, "fact_rows": fact_rows,
        }
        self._persist_dq(row)
        return row

    def _ledger(self, keys_: list[str]) -> tuple[DataFrame, DataFrame]:
        """The ledger of (batch, status, key) counts and that of (batch, field, code) counts.

        Of the feed, only batches ingested since the last time are read: a batch's entries are replaced when another run
        has ingested it.
        """
        by = {r["batch_date"].isoformat(): r["run_id"] for r in self.control("etl_ingestion_batches").collect()}  # a row per batch
        roots = {"keys": self._path("ledger", "keys"), "errors": self._path("ledger", "errors")}
        known = {n: (sinks.snapshot_meta(self.spark, root) or {}) for n, root in roots.items()}
        same = all(m.get("keys") == keys_ for m in known.values())
        due = sorted(b for b, run in by.items() if not same or any(m["runs"].get(b) != run for m in known.values()))
        if due:
            feed = self.spark.read.parquet(self._path("feed")).where(F.col(BATCH_COL).isin([F.lit(b).cast("date") for b in due]))
            broken = feed.where(F.col(STATUS_COL) == "invalid").select(BATCH_COL, F.explode(ERRORS_COL).alias("field", "codes"))
            broken = broken.select(BATCH_COL, "field", F.explode("codes").alias("code")).groupBy(BATCH_COL, "field", "code").agg(
                F.count(F.lit(1)).alias("error_count"))
            for name, rows in (("keys", dq.ledger(feed, BATCH_COL, STATUS_COL, keys_)), ("errors", broken)):
                sinks.write_parts(rows, roots[name], BATCH_COL, due if same else None,
                                  meta={"keys": keys_, "runs": {**(known[name].get("runs") or {}), **{b: by[b] for b in due}}})
        return sinks.read_parts(self.spark, roots["keys"]), sinks.read_parts(self.spark, roots["errors"])

    def _persist_dq(self, row: dict) -> None:
        """Upsert the run's metrics row into control/dq_run_metrics (key: run_id)."""
        flat = self.spark.createDataFrame([tuple(
            json.dumps(row[c], sort_keys=True, default=str) if isinstance(row[c], dict) else row[c]
            for c in DQ_SCHEMA.names)], DQ_SCHEMA)
        old = self._read("control", "dq_run_metrics", DQ_SCHEMA)
        self._publish("control", "dq_run_metrics", state.upsert_by_key(old, flat, ["run_id"]))
