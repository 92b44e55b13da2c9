"""Declarative contract: feed schema, rules, dimensions and facts.

The contract is plain data (dataclasses).  ``contract_from_dict`` accepts the
JSON layout used by metadata-driven pipelines (``ingestion`` / ``dimension_*`` /
``star_schema`` / ``dq`` sections) so existing contracts can be reused as-is.
Validation of the contract happens here, at plan-build time, without data.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from typing import Any, Mapping, Sequence

from pyspark.sql import types as T

# Declarable source types and their Spark types.
SOURCE_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "integer": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "float": T.FloatType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "date": T.DateType(),
}

# Open-ended version sentinel and default lineage columns.
DEFAULT_OPEN_END_DATE = "2099-12-31"
DEFAULT_LINEAGE = ("source_batch_date", "processed_run_id", "ingestion_dt")
LINEAGE_TYPES: dict[str, T.DataType] = {
    "source_batch_date": T.DateType(),
    "processed_run_id": T.StringType(),
    "ingestion_dt": T.TimestampType(),
}
SCD2_METADATA = ("start_date", "end_date", "is_current", "last_updated_run_id")
PLAIN_METADATA = ("last_updated_run_id",)


@dataclass(frozen=True)
class Rule:
    name: str
    param: Any = None


@dataclass(frozen=True)
class FieldRules:
    field: str
    rules: tuple[Rule, ...]


@dataclass(frozen=True)
class FeedSpec:
    """A dated source feed: schema, reader options, validation rules."""

    name: str
    path: str = ""
    format: str = "json"
    schema: T.StructType | None = None
    enforce_schema: bool = True
    required: bool = True
    options: Mapping[str, Any] = field(default_factory=dict)
    validations: tuple[FieldRules, ...] = ()
    uniqueness_keys: tuple[str, ...] = ()

    def not_null_fields(self) -> set[str]:
        return {fr.field for fr in self.validations
                if any(r.name == "notNull" for r in fr.rules)}


@dataclass(frozen=True)
class DedupSpec:
    """Keep one row per key (default: the business key): the greatest by ``order`` (pairs column, descending)."""

    enabled: bool = True
    keys: tuple[str, ...] = ()
    order: tuple[tuple[str, bool], ...] = (("ingestion_dt", True), ("processed_run_id", True))


@dataclass(frozen=True)
class DimensionSpec:
    name: str
    business_key: str
    scd2_fields: tuple[str, ...] = ()
    scd1_fields: tuple[str, ...] = ()
    non_tracked_fields: tuple[str, ...] = ()
    lineage_columns: tuple[str, ...] = DEFAULT_LINEAGE
    metadata_columns: tuple[str, ...] | None = None
    natural_key_columns: tuple[str, ...] | None = None
    field_renames: tuple[tuple[str, str], ...] = ()
    derived_fields: tuple[tuple[str, str], ...] = ()
    dedup: DedupSpec = DedupSpec()
    batch_column: str = "source_batch_date"
    open_end_date: str = DEFAULT_OPEN_END_DATE
    contract_version: str = "1.0"
    target_table: str | None = None
    # warehouse types of columns, applied when the dimension is loaded
    load_types: tuple[tuple[str, str], ...] = ()
    # True when every tracked field is guaranteed non-null (e.g. a notNull rule):
    # the cheap window replay is then exact; otherwise the fold replay is used.
    tracked_never_null: bool = False

    @property
    def dedup_keys(self) -> tuple[str, ...]:
        """Source columns of the deduplication key."""
        back = {new: old for old, new in self.field_renames}
        return tuple(self.dedup.keys) or (back.get(self.business_key, self.business_key),)

    @property
    def is_scd2(self) -> bool:
        return bool(self.scd2_fields)

    @property
    def meta_columns(self) -> tuple[str, ...]:
        if self.metadata_columns is not None:
            return tuple(self.metadata_columns)
        return SCD2_METADATA if self.is_scd2 else PLAIN_METADATA

    @property
    def nk_columns(self) -> tuple[str, ...]:
        if self.natural_key_columns:
            return tuple(self.natural_key_columns)
        return (self.business_key, "start_date") if self.is_scd2 else (self.business_key,)

    @property
    def table(self) -> str:
        return self.target_table or self.name

    def columns(self) -> list[str]:
        """Snapshot column order: key, non-tracked, SCD1, SCD2, lineage, metadata."""
        out: list[str] = []
        for c in (self.business_key, *self.non_tracked_fields, *self.scd1_fields,
                  *self.scd2_fields, *self.lineage_columns, *self.meta_columns):
            if c and c not in out:
                out.append(c)
        return out

    def with_(self, **kw) -> "DimensionSpec":
        return replace(self, **kw)


@dataclass(frozen=True)
class FactSpec:
    """One fact row per version of ``base``; FKs resolve natural -> surrogate keys."""

    name: str
    base: str
    # (fk column name, dimension name, source column in base, dimension business key)
    foreign_keys: tuple[tuple[str, str, str, str], ...]
    # (measure name, source column in base)
    measures: tuple[tuple[str, str], ...]
    date_source: str = "source_batch_date"


@dataclass(frozen=True)
class Contract:
    feed: FeedSpec
    dimensions: tuple[DimensionSpec, ...]
    facts: tuple[FactSpec, ...] = ()

    def dimension(self, name: str) -> DimensionSpec:
        for d in self.dimensions:
            if d.name == name:
                return d
        raise KeyError(name)


class ContractError(ValueError):
    pass


# --------------------------------------------------------------------------
# parsing

def build_schema(schema_def: Mapping[str, Any]) -> T.StructType:
    """Declared top-level struct -> StructType; rejects unknown types."""
    if not isinstance(schema_def, Mapping) or schema_def.get("type") != "struct":
        raise ContractError("schema must be an object with type 'struct'")
    fields = schema_def.get("fields")
    if fields is None:
        raise ContractError("schema has no 'fields'")
    if not fields:
        raise ContractError("schema 'fields' is empty")
    out = []
    for f in fields:
        t = f.get("type")
        if t not in SOURCE_TYPES:
            raise ContractError(f"unsupported type {t!r} for field {f.get('name')!r}")
        out.append(T.StructField(f["name"], SOURCE_TYPES[t], bool(f.get("nullable", True)),
                                 f.get("metadata") or {}))
    return T.StructType(out)


def parse_rules(validations: Sequence[Mapping[str, Any]]) -> tuple[FieldRules, ...]:
    """Rule configs -> FieldRules; rules of a field declared twice are merged."""
    merged: dict[str, list[Rule]] = {}
    for v in validations:
        fld = v["field"]
        rules = merged.setdefault(fld, [])
        for r in v.get("rules", []):
            if isinstance(r, str):
                rules.append(Rule(r))
            elif isinstance(r, Mapping):
                rules.append(Rule(r.get("name"), r.get("params")))
            else:
                raise ContractError(f"invalid rule configuration for field {fld!r}: {r!r}")
    return tuple(FieldRules(k, tuple(v)) for k, v in merged.items())


def contract_from_dict(meta: Mapping[str, Any]) -> Contract:
    ing = meta["ingestion"]
    src = ing["source"]
    enforce = bool(src.get("schema_enforcement", {}).get("enabled", False))
    feed = FeedSpec(
        name=src.get("name", "source"),
        path=src.get("path", ""),
        format=src.get("format", "json"),
        schema=build_schema(src["schema"]) if src.get("schema") else None,
        enforce_schema=enforce,
        required=bool(src.get("required", True)),
        options=dict(src.get("options", {})),
        validations=parse_rules(ing.get("validations", [])),
        uniqueness_keys=tuple(meta.get("dq", {}).get("uniqueness", {}).get(
            "key_columns", [])),
    )
    not_null = feed.not_null_fields()
    defaults = dict(meta.get("dimension_defaults", {}))
    sentinel = meta.get("scd_defaults", {}).get("scd_sentinel_dates", {}).get(
        "end_date_open", DEFAULT_OPEN_END_DATE)
    dims = []
    for name in meta.get("dimension_registry", []):
        cfg = {**defaults, **meta.get(name, {})}
        renames = tuple(cfg.get("field_renames", {}).items())
        back = {new: old for old, new in renames}
        scd2 = tuple(cfg.get("scd_type_2_fields", []))
        dd = cfg.get("deduplication", {})
        dims.append(DimensionSpec(
            name=name,
            business_key=cfg["business_key"],
            scd2_fields=scd2,
            scd1_fields=tuple(cfg.get("scd_type_1_fields", [])),
            non_tracked_fields=tuple(cfg.get("non_tracked_fields", [])),
            lineage_columns=tuple(cfg.get("lineage_columns", DEFAULT_LINEAGE)),
            metadata_columns=tuple(cfg["metadata_columns"]) if "metadata_columns" in cfg else None,
            natural_key_columns=tuple(cfg.get("natural_key_columns", [])) or None,
            field_renames=renames,
            derived_fields=tuple((d["name"], d["expression"]) for d in cfg.get("derived_fields", [])),
            dedup=DedupSpec(
                enabled=bool(dd.get("enabled", False)),
                keys=(dd["key_column"],) if dd.get("key_column") else (),
                order=(("ingestion_dt", True), ("processed_run_id", True)),
            ),
            batch_column=cfg.get("batch_order_column", "source_batch_date"),
            open_end_date=sentinel,
            contract_version=str(cfg.get("contract_version", "1.0")),
            target_table=cfg.get("target_table"),
            load_types=tuple(cfg.get("load_types", {}).items()),
            tracked_never_null=all(back.get(f, f) in not_null for f in scd2),
        ))
    facts = []
    for f in meta.get("star_schema", {}).get("facts", []):
        measures = tuple((m, spec["source"]) for m, spec in f.get("measures", {}).items())
        base = f.get("base_dimension", dims[0].name if dims else "")
        fks = []
        base_dim = next((d for d in dims if d.name == base), None)
        for d in dims:
            if d.name == base or base_dim is None:
                continue
            cols = set(base_dim.columns())
            if d.business_key in cols:
                fks.append((d.name.replace("dim_", "") + "_id", d.name, d.business_key, d.business_key))
        facts.append(FactSpec(f["target_table"], base, tuple(fks), measures))
    contract = Contract(feed, tuple(dims), tuple(facts))
    validate_contract(contract)
    return contract


def validate_contract(c: Contract) -> None:
    """Plan-time checks: rules name known fields, measures resolve, keys declared."""
    from dimwright.functions.rules import RULES  # local import: avoid a cycle

    if c.feed.schema is not None:
        names = set(c.feed.schema.names)
        for fr in c.feed.validations:
            for r in fr.rules:
                if r.name not in RULES:
                    raise ContractError(
                        f"no rule is called {r.name!r} (asked for by the field {fr.field!r}); "
                        f"there are {', '.join(sorted(RULES))}")
            # a rule on a field that a record lacks yields 'fieldMissing' at run time, but the
            # declared schema has to know the field
            if c.feed.enforce_schema and fr.field not in names:
                raise ContractError(f"rules name the field {fr.field!r}, which the schema does not declare")
    for d in c.dimensions:
        if not d.business_key:
            raise ContractError(f"{d.name}: business_key is required")
        lost = [k for k in d.nk_columns if k not in d.columns()]
        if lost:
            raise ContractError(f"{d.name}: natural key columns {lost} are no columns of the dimension")
    dims = {d.name: d for d in c.dimensions}
    for f in c.facts:
        if f.base not in dims:
            raise ContractError(f"fact {f.name}: unknown base dimension {f.base!r}")
        base_cols = set(dims[f.base].columns())
        for m, src in f.measures:
            if src not in base_cols:
                raise ContractError(f"fact {f.name}: measure {m!r} source {src!r} not in {f.base}")
        if not f.measures:
            raise ContractError(f"fact {f.name}: no measures")
