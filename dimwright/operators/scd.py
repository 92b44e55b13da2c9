"""Slowly changing dimensions: type 2 (versions), type 1 (refresh), insert-only.

Semantics, per business key and batch (one row per key after dedup):

* key not current in the state -> new open version from the batch row;
* a tracked field is non-NULL in the batch and differs from (or fills a NULL
  in) the open version -> the open version is closed (``end_date`` = batch
  date - 1 day, ``is_current`` false, run stamped) and a new version opens with
  every batch attribute as-is (NULLs included, no carry-forward);
* otherwise, with type-1 fields -> refresh in place: ``coalesce(new, current)``
  for type-1 fields only, run stamped (even if nothing changed); lineage,
  start and non-tracked fields keep their first-introduced values;
* otherwise (insert-only) -> unchanged; the first row seen wins.

A NULL incoming tracked value never opens a version.  NULL business keys never
match, so every such row is a new version (as an anti join would treat them).

Four evaluation strategies produce the same dimension:

``apply_batch``   one batch onto a snapshot: one left join of the current rows
                  with the batch, an action per row and an ``explode`` of 1-2
                  output rows, and the batch rows of new keys; history passes by.
``replay``        many batches at once, no loop: window path (lag/sum/lead)
                  when tracked fields are never NULL, else a per-key fold with
                  the built-in ``aggregate`` higher-order function.
``apply_batches`` many pending batches onto an existing snapshot in one
                  shuffle: the window (or fold) path seeded with each touched
                  key's open version.
``refold``        late batches: ``replay`` for the keys that they hold only.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimwright.contract import SCD2_METADATA, DimensionSpec
from dimwright.operators.dedup import dedup_latest
from dimwright.operators.plan_utils import fits_broadcast, sized_broadcast, spread
from dimwright.operators.shape import align, align_dimension, derive, dimension_types, rename

RunId = str | Column


def _run(run_id: RunId) -> Column:
    return run_id if isinstance(run_id, Column) else F.lit(str(run_id))


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


# --------------------------------------------------------------------------
# preparation

def prepare(rows: DataFrame, spec: DimensionSpec, per_batch: bool = True) -> DataFrame:
    """Dedup (per batch), rename source fields, add derived fields."""
    if spec.dedup.enabled:
        keys = list(spec.dedup_keys)
        if per_batch and spec.batch_column not in keys:
            keys.append(spec.batch_column)
        rows = dedup_latest(rows, keys, spec.dedup.order)
    rows = rename(rows, spec.field_renames)
    return derive(rows, spec.derived_fields)


def stamp_open(rows: DataFrame, spec: DimensionSpec, run_id: RunId) -> DataFrame:
    """Open-version stamp: start = batch date, end = sentinel, current, run."""
    return rows.withColumns({
        "start_date": _c(spec.batch_column).cast("date"),
        "end_date": F.lit(spec.open_end_date).cast("date"),
        "is_current": F.lit(True),
        "last_updated_run_id": _run(run_id),
    })


def initial_load(rows: DataFrame, spec: DimensionSpec, run_id: RunId) -> DataFrame:
    """No state yet: every prepared row is an open version."""
    return align_dimension(stamp_open(rows, spec, run_id), spec)


def _changed(new: Column, cur: Column, fields: Sequence[str]) -> Column:
    cond = F.lit(False)
    for f in fields:
        cond = cond | (new[f].isNotNull() & ~new[f].eqNullSafe(cur[f]))
    return cond


def changed_keys(state: DataFrame, batch: DataFrame, spec: DimensionSpec) -> DataFrame:
    """Business keys whose open version a batch changes (tracked-field test)."""
    bk = spec.business_key
    cur = state.where(_c("is_current")) if "is_current" in state.columns else state
    if not spec.scd2_fields:
        return cur.select(bk).limit(0)
    c = cur.select(F.col(f"`{bk}`").alias("__k"), F.struct(*[_c(f) for f in spec.scd2_fields]).alias("c"))
    n = batch.select(F.col(f"`{bk}`").alias("__k"), F.struct(*[_c(f) for f in spec.scd2_fields]).alias("n"))
    return (c.join(n, "__k", "inner")
            .where(_changed(F.col("n"), F.col("c"), spec.scd2_fields))
            .select(F.col("__k").alias(bk)).distinct())


# --------------------------------------------------------------------------
# incremental: one batch onto a snapshot

def apply_batch(state: DataFrame | None, batch: DataFrame, spec: DimensionSpec,
                run_id: RunId) -> DataFrame:
    """Apply ONE prepared batch (one row per business key) to a snapshot.

    ``state`` should be materialised (a snapshot read, or ``checkpoint()``).
    Its current rows pass once: a left join brings each its batch row, if there
    is one, and that decides what becomes of it; history passes by.  A batch
    under the broadcast size moves to the state, which is not shuffled.  The
    batch rows of keys that are not in the state are found from the key column.
    """
    if state is None:
        return initial_load(batch, spec, run_id)
    state = align_dimension(state, spec)
    cols = state.columns
    types = {f.name: f.dataType for f in state.schema.fields}
    bk = spec.business_key
    has_cur = "is_current" in cols
    cur = state.where(_c("is_current")) if has_cur else state

    opened = align_dimension(stamp_open(batch, spec, run_id), spec).select(*[_c(c).cast(types[c]).alias(c) for c in cols])
    n_side = sized_broadcast(opened.where(_c(bk).isNotNull()).select(_c(bk).alias("__k"), F.struct(*[_c(c) for c in cols]).alias("n")))
    c_side = cur.select(_c(bk).alias("__k"), F.struct(*[_c(c) for c in cols]).alias("c"))
    j = c_side.join(n_side, "__k", "left")
    c, n = F.col("c"), F.col("n")

    def with_fields(base: Column, repl: dict[str, Column]) -> Column:
        return F.struct(*[(repl[x] if x in repl else base[x]).cast(types[x]).alias(x) for x in cols])

    changed = _changed(n, c, spec.scd2_fields) if spec.scd2_fields else F.lit(False)
    closed = with_fields(c, {"end_date": F.date_sub(n["start_date"], 1),
                             "is_current": F.lit(False),
                             "last_updated_run_id": n["last_updated_run_id"]})
    refresh_fields = [f for f in spec.scd1_fields if f in cols]
    refreshed = with_fields(c, {**{f: F.coalesce(n[f], c[f]) for f in refresh_fields},
                                "last_updated_run_id": n["last_updated_run_id"]})
    after = F.when(n.isNull(), F.array(c)).when(changed, F.array(closed, n))
    after = after.otherwise(F.array(refreshed if refresh_fields else c))
    kept = j.select(F.explode(after).alias("r")).select("r.*")

    # keys that the state has, out of those of the batch: no more than the batch has, so they fit where its keys do
    keys = opened.select(_c(bk))
    known = cur.select(_c(bk)).join(sized_broadcast(keys), bk, "left_semi")
    known = F.broadcast(known) if fits_broadcast(keys) else known
    out = kept.unionByName(opened.join(known, bk, "left_anti"))
    return out if not has_cur else state.where(~_c("is_current")).unionByName(out)


# --------------------------------------------------------------------------
# full replay

def _entity(spec: DimensionSpec) -> list[Column]:
    """Partitioning of entities: the business key, and for a NULL key its batch.

    A NULL key never matches the state, so each (NULL, batch) row is its own
    entity with a single open version -- handled inside the same shuffle,
    without a second scan of the input.  Evaluated on stamped rows, where
    ``start_date`` is the batch date.
    """
    bk = _c(spec.business_key)
    return [bk, F.when(bk.isNull(), _c("start_date")).alias("__nb")]


def replay(rows: DataFrame, spec: DimensionSpec, run_id: RunId, method: str = "auto") -> DataFrame:
    """Dimension state after folding every batch of ``rows`` in batch order.

    ``rows`` are prepared rows (one per key and batch).  ``run_id`` may be a
    Column evaluated on the rows (the run that applied that batch).
    """
    if method == "auto":
        method = "window" if (spec.tracked_never_null or not spec.scd2_fields) else "fold"
    rows = rows.withColumn("__run", _run(run_id))
    if method == "window":
        return _replay_window(rows, spec)
    if method == "fold":
        return _fold(rows, spec, seed=None)
    raise ValueError(f"unknown replay method {method!r}")


def _replay_window(rows: DataFrame, spec: DimensionSpec, seed: DataFrame | None = None, parts: int | None = None) -> DataFrame:
    """Window formulation; exact when tracked fields are never NULL.

    With ``seed`` (open versions of the touched keys, or of all), each seed row is
    the first row of its entity by a flag of its own (a type-1 or insert-only state
    has no start date to order by): its start, lineage and run are kept, type-1
    values continue from it, and a tracked change closes it.  Entities without a
    new row keep their seeds as they are.  Rows of one key and batch
    (deduplication off) follow each other by a hash of their values.

    All steps take the rows in one order, so a task sorts them once: a version is
    given by its last row, with the opening row's values and the last type-1
    values carried on to it, and the row after it opens the next version.
    """
    bk = spec.business_key
    cols = _internal_columns(spec)
    types = dimension_types(spec)
    stamped = _stamped_with_run(rows, spec).withColumns({"__nb": _entity(spec)[1], "__new": F.lit(True)})
    if seed is not None:
        seed, st = _seed_types(stamped, seed, spec)
        stamped = stamped.withColumns({c: _c(c).cast(st[c]) for c in cols}).unionByName(seed.select(
            *[_c(c).cast(st[c]).alias(c) for c in cols],
            F.lit(None).cast(stamped.schema["__nb"].dataType).alias("__nb"), F.lit(False).alias("__new")))
    rows = spread(stamped, parts, bk).withColumn("__at", F.struct("__new", "start_date", F.xxhash64(*[_c(c) for c in cols])))
    ent = [_c(bk), _c("__nb")]
    w = Window.partitionBy(*ent).orderBy("__at")
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    chg = F.row_number().over(w) == 1
    for f in spec.scd2_fields:
        chg = chg | (_c(f).isNotNull() & ~_c(f).eqNullSafe(F.lag(_c(f)).over(w)))
    as_was = F.lit(False)
    if seed is not None:
        as_was = ~F.max("__new").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    rows = rows.withColumn("__as_was", as_was).withColumn("__chg", _c("__as_was") | chg)
    scd1 = [f for f in spec.scd1_fields if f in cols]
    opening = [c for c in cols if c not in scd1 and c != bk]
    # a later version always has a start: only seeds may lack one
    rows = rows.withColumns({
        "__ver": F.sum(_c("__chg").cast("int")).over(so_far),
        "__o": F.last(F.when(_c("__chg"), F.struct(*[_c(c) for c in opening])), ignorenulls=True).over(so_far),
        "__ends": F.lead("__chg", 1, True).over(w),
        "__nxt": F.lead("start_date").over(w),
        "__nxt_run": F.lead("last_updated_run_id").over(w),
    })
    rows = rows.withColumns({f"__s{i}": F.last(F.when(_c(s).isNotNull(), F.struct("__ver", _c(s).alias("v"))), ignorenulls=True)
                             .over(so_far) for i, s in enumerate(scd1)}).where("__ends")
    own_run = _c("last_updated_run_id") if scd1 else F.col("__o.last_updated_run_id")
    out = {c: F.col(f"__o.`{c}`") for c in opening}
    out |= {s: F.when(F.col(f"__s{i}.__ver") == _c("__ver"), F.col(f"__s{i}.v")) for i, s in enumerate(scd1)}
    followed = ~_c("__as_was") & _c("__nxt").isNotNull()
    out |= {
        bk: _c(bk),
        "end_date": F.when(_c("__as_was"), F.col("__o.end_date")).otherwise(
            F.coalesce(F.date_sub("__nxt", 1), F.lit(spec.open_end_date).cast("date"))),
        "is_current": F.when(_c("__as_was"), F.col("__o.is_current")).otherwise(_c("__nxt").isNull()),
        "last_updated_run_id": F.when(followed, _c("__nxt_run")).otherwise(own_run),
    }
    g = rows.select(*[(out[c].cast(types[c]) if c in types else out[c]).alias(c) for c in cols])
    return align_dimension(g, spec)


def _seed_types(stamped: DataFrame, seed: DataFrame, spec: DimensionSpec) -> tuple[DataFrame, dict[str, T.DataType]]:
    """Seeds with every (internal) dimension column, and the types that new rows and seeds share (the wider of the two)."""
    cols = _internal_columns(spec)
    seed = align(seed, cols, dimension_types(spec))
    return seed, {f.name: f.dataType for f in stamped.select(*[_c(c) for c in cols]).unionByName(seed).schema.fields}


def _internal_columns(spec: DimensionSpec) -> list[str]:
    """Dimension columns plus the version columns every strategy works with."""
    cols = spec.columns()
    return cols + [m for m in SCD2_METADATA if m not in cols]


def _stamped_with_run(rows: DataFrame, spec: DimensionSpec) -> DataFrame:
    """Stamped rows carrying every (internal) dimension column plus nothing else."""
    st = stamp_open(rows, spec, F.col("__run"))
    return align(st, _internal_columns(spec), dimension_types(spec))


def _fold(rows: DataFrame, spec: DimensionSpec, seed: DataFrame | None, parts: int | None = None) -> DataFrame:
    """Per-key fold over batch rows (optionally seeded with the open version).

    Per-key memory is the key's number of batches, independent of table size.
    """
    bk = spec.business_key
    cols = _internal_columns(spec)
    stamped = _stamped_with_run(rows, spec)
    if seed is None:
        types = {f.name: f.dataType for f in stamped.schema.fields}
    else:
        seed, types = _seed_types(stamped, seed, spec)
    elem = F.struct(*[_c(c).cast(types[c]).alias(c) for c in cols])
    items = stamped.select(F.struct(*_entity(spec)).alias("__k"),
                           F.struct(_c("start_date").alias("o"), F.lit(False).alias("seed"),
                                    elem.alias("e")).alias("x"))
    if seed is not None:
        items = items.unionByName(seed.select(
            F.struct(_c(bk), F.lit(None).cast("date").alias("__nb")).alias("__k"),
            F.struct(F.lit("0001-01-01").cast("date").alias("o"), F.lit(True).alias("seed"), elem.alias("e")).alias("x")))
    elem_type = T.StructType([T.StructField(c, types[c], True) for c in cols])
    scd1 = [f for f in spec.scd1_fields if f in cols]
    tracked = list(spec.scd2_fields)

    def rebuild(base: Column, repl: dict[str, Column]) -> Column:
        return F.struct(*[(repl[x] if x in repl else base[x]).cast(types[x]).alias(x) for x in cols])

    def step(acc: Column, x: Column) -> Column:
        r = x["e"]
        n = F.size(acc)
        last = F.element_at(acc, -1)
        head = F.slice(acc, 1, F.greatest(n - 1, F.lit(0)))
        changed = _changed(r, last, tracked) if tracked else F.lit(False)
        closed = rebuild(last, {"end_date": F.date_sub(r["start_date"], 1),
                                "is_current": F.lit(False),
                                "last_updated_run_id": r["last_updated_run_id"]})
        refreshed = rebuild(last, {**{f: F.coalesce(r[f], last[f]) for f in scd1},
                                   "last_updated_run_id": r["last_updated_run_id"]})
        res = F.when(n == 0, F.array(r)).when(changed, F.concat(head, F.array(closed, r)))
        if scd1:
            res = res.when(F.lit(True), F.concat(head, F.array(refreshed)))
        return res.otherwise(acc)

    after = F.aggregate("xs", F.array().cast(T.ArrayType(elem_type)), step)
    if seed is not None:  # entities without a new row keep their seeds as they are
        after = F.when(F.forall("xs", lambda x: x["seed"]), F.transform("xs", lambda x: x["e"])).otherwise(after)
    folded = (spread(items, parts, "__k").groupBy("__k")
              .agg(F.array_sort(F.collect_list("x")).alias("xs"))
              .select(F.explode(after).alias("v"))
              .select("v.*"))
    return align_dimension(folded, spec)


def apply_batches(state: DataFrame | None, rows: DataFrame, spec: DimensionSpec,
                  run_id: RunId, parts: int | None = None) -> DataFrame:
    """Apply several pending batches (all later than the state) in one shuffle.

    Current rows seed the fold; history and rows without a key pass through
    without moving.  If the pending batches fit a broadcast, so do the current rows
    of untouched keys; if not, the fold finds the untouched keys itself, so
    neither ``state`` nor ``rows`` is read again to join them.  ``state`` should be
    materialised (a snapshot read, or ``checkpoint()``).  ``parts`` is the number
    of parts that the fold's shuffle deals the keys out into, the session's if None.
    """
    if state is None:
        return replay(rows, spec, run_id)
    rows = rows.withColumn("__run", _run(run_id))
    state = align_dimension(state, spec)
    bk = spec.business_key
    cur = _c("is_current") if "is_current" in state.columns else F.lit(True)
    keyed = _c(bk).isNotNull()
    seed, passing = state.where(cur & keyed), state.where(~cur | (cur & ~keyed))
    touched = rows.where(keyed).select(bk).distinct()
    if fits_broadcast(touched):
        touched = F.broadcast(touched)
        passing = passing.unionByName(seed.join(touched, bk, "left_anti"))
        seed = seed.join(touched, bk, "left_semi")
    if spec.tracked_never_null or not spec.scd2_fields:
        versions = _replay_window(rows, spec, seed=seed, parts=parts)
    else:
        versions = _fold(rows, spec, seed=seed, parts=parts)
    return passing.unionByName(versions)


def refold(state: DataFrame, rows: DataFrame, keys: DataFrame, spec: DimensionSpec, run_id: RunId) -> DataFrame:
    """Snapshot after late batches: the versions of ``keys`` are folded anew, all others pass by.

    ``keys`` is one column, the business key, of the keys that the late batches hold; ``rows`` has the prepared rows of
    those keys in every batch, and the late rows without a key, which never meet a version and are added.
    """
    others = align_dimension(state, spec).join(sized_broadcast(keys), spec.business_key, "left_anti")
    return others.unionByName(replay(rows, spec, run_id))


def source_key(spec: DimensionSpec) -> str | None:
    """Source column that the business key comes from unchanged, if a filter on it may go before deduplication."""
    bk = spec.business_key
    if bk in {name for name, _ in spec.derived_fields}:
        return None
    source = {new: old for old, new in spec.field_renames}.get(bk, bk)
    return source if not spec.dedup.enabled or source in spec.dedup_keys else None


def current_view(dim: DataFrame) -> DataFrame:
    """Current versions only (a state without ``is_current`` is all current)."""
    return dim.where(_c("is_current")) if "is_current" in dim.columns else dim
