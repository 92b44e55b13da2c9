"""Declarative validation: per-field error arrays, error map, valid/invalid split.

All rules of all fields are evaluated in one pass over the rows, so the source
is scanned once; valid and invalid outputs are two filters of that result, or
one partitioned write (see ``sources.sinks.write_split``).

Plan shape: a generator of one row evaluates every rule condition exactly once
into a boolean column (a projection would be repeated by a filter pushed below it); the arrays, the error map and the status are then
assembled from those columns by reference with ``concat`` / ``map_from_entries``
of guarded one-element arrays (no lambda functions, so the projection stays in
whole-stage code generation and no rule expression is inlined twice).
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimwright.contract import FieldRules
from dimwright.functions.rules import CODE_FIELD_MISSING, rule_parts

ERR_PREFIX = "__err_"
ERRORS_COL = "validation_errors"
STATUS_COL = "record_status"
ERROR_MAP_TYPE = T.MapType(T.StringType(), T.ArrayType(T.StringType()))
_CODES_TYPE = T.ArrayType(T.StringType())
_ENTRY_TYPE = T.ArrayType(T.StructType([T.StructField("key", T.StringType(), False),
                                        T.StructField("value", _CODES_TYPE, True)]))


def _guarded(value: Column, present: Column, empty_type: T.DataType) -> Column:
    """array(value) when ``present`` else an empty array."""
    return F.when(present, F.array(value)).otherwise(F.array().cast(empty_type))


def _codes_from_flags(flags: list[tuple[Column, Column]]) -> Column:
    """Array of the codes whose flag is set; NULL when none is."""
    if not flags:
        return F.lit(None).cast(_CODES_TYPE)
    any_bad = F.lit(False)
    for bad, _ in flags:
        any_bad = any_bad | bad
    parts = [_guarded(code, bad, _CODES_TYPE) for bad, code in flags]
    return F.when(any_bad, F.concat(*parts) if len(parts) > 1 else parts[0])


def field_error_column(field: str, rules: Iterable, present: bool) -> Column:
    """array<string> of failing codes for one field, NULL when every rule passes."""
    if not present:
        return F.array(F.lit(CODE_FIELD_MISSING))
    return _codes_from_flags([rule_parts(field, r.name, r.param) for r in rules])


def _flagged(df: DataFrame, validations: list[FieldRules]):
    """df + one boolean column per rule; plan of (field, [(flag column, code)] or None)."""
    cols = set(df.columns)
    flags: list[Column] = []
    plan: list[tuple[str, list[tuple[str, Column]] | None]] = []
    for v in validations:
        if v.field not in cols:
            plan.append((v.field, None))
            continue
        entries = []
        for r in v.rules:
            cond, code = rule_parts(v.field, r.name, r.param)
            name = f"__bad{len(flags)}"
            flags.append(cond.alias(name))
            entries.append((name, code))
        plan.append((v.field, entries))
    # a generator of one row: a filter on the status stays above it, so no rule is evaluated twice
    return (df.select("*", F.inline(F.array(F.struct(*flags)))) if flags else df), plan


def annotate(df: DataFrame, validations: Iterable[FieldRules]) -> DataFrame:
    """Original columns + one ``__err_<field>`` array column per validated field."""
    vs = list(validations)
    flagged, plan = _flagged(df, vs)
    out = []
    for fld, entries in plan:
        col = (F.array(F.lit(CODE_FIELD_MISSING)) if entries is None
               else _codes_from_flags([(F.col(n), code) for n, code in entries]))
        out.append(col.alias(ERR_PREFIX + fld))
    return flagged.select(*[F.col(f"`{c}`") for c in df.columns], *out)


def _error_map(validations: list[FieldRules]) -> Column:
    """map field -> codes, failing fields only."""
    if not validations:
        return F.lit(None).cast(ERROR_MAP_TYPE)
    parts = []
    for v in validations:
        err = F.col(f"`{ERR_PREFIX}{v.field}`")
        parts.append(_guarded(F.struct(F.lit(v.field).alias("key"), err.alias("value")),
                              err.isNotNull(), _ENTRY_TYPE))
    return F.map_from_entries(F.concat(*parts) if len(parts) > 1 else parts[0])


def _has_error(validations: list[FieldRules]) -> Column:
    cond = F.lit(False)
    for v in validations:
        cond = cond | F.col(f"`{ERR_PREFIX}{v.field}`").isNotNull()
    return cond


def classify(df: DataFrame, validations: Iterable[FieldRules]) -> DataFrame:
    """Original columns + ``validation_errors`` (NULL for valid rows) + ``record_status``."""
    vs = list(validations)
    original = [f"`{c}`" for c in df.columns]
    ann = annotate(df, vs).select("*", _has_error(vs).alias("__bad"))
    bad = F.col("__bad")
    return ann.select(
        *original,
        F.when(bad, _error_map(vs)).alias(ERRORS_COL),
        F.when(bad, F.lit("invalid")).otherwise(F.lit("valid")).alias(STATUS_COL),
    )


def split_valid_invalid(df: DataFrame, validations: Iterable[FieldRules]) -> tuple[DataFrame, DataFrame]:
    """(valid rows with original columns, invalid rows + validation_errors map)."""
    vs = list(validations)
    c = classify(df, vs)
    original = [f"`{x}`" for x in df.columns]
    valid = c.where(F.col(STATUS_COL) == "valid").select(*original)
    invalid = c.where(F.col(STATUS_COL) == "invalid").select(*original, ERRORS_COL)
    return valid, invalid


def violations(df: DataFrame, validations: Iterable[FieldRules], key_cols: list[str]) -> DataFrame:
    """Long form straight from the rule flags: one row per (key..., field, code).

    One generator over an array of (field, code) structs built from the
    boolean flags -- no map is built and exploded -- so this is the cheap path
    when only the violations are needed (breakdowns, error listings).
    """
    vs = list(validations)
    flagged, plan = _flagged(df, vs)
    entry = T.ArrayType(T.StructType([T.StructField("field", T.StringType(), False),
                                      T.StructField("code", T.StringType(), True)]))
    parts = []
    for fld, entries in plan:
        if entries is None:
            parts.append(F.array(F.struct(F.lit(fld).alias("field"), F.lit(CODE_FIELD_MISSING).alias("code"))))
            continue
        for n, code in entries:
            parts.append(_guarded(F.struct(F.lit(fld).alias("field"), code.alias("code")), F.col(n), entry))
    if not parts:
        return flagged.select(*key_cols, F.lit(None).cast("string").alias("field"),
                              F.lit(None).cast("string").alias("code")).limit(0)
    arr = F.concat(*parts) if len(parts) > 1 else parts[0]
    return flagged.select(*[F.col(f"`{k}`") for k in key_cols], F.inline(arr))
