"""Audits of table contracts, and deletes that follow their references."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.schemas import CONTRACTS, Contract, ForeignKey


def _any_null(columns: Sequence[str]) -> Column:
    return reduce(Column.__or__, [F.col(c).isNull() for c in columns])


def _per_column(rows: DataFrame, figures: Mapping[str, Mapping[str, Column]]) -> DataFrame:
    """One row of figures per column from a single aggregate over the table."""
    structs = [
        F.struct(F.lit(name).alias("column"), *[v.alias(k) for k, v in values.items()])
        for name, values in figures.items()
    ]
    return rows.agg(F.array(*structs).alias("rows")).select(F.inline("rows"))


def _tally(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def primary_key_violations(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that repeat or hold a NULL, with their row counts."""
    return (
        rows.groupBy(*keys).agg(F.count("*").alias("n")).where((F.col("n") > 1) | _any_null(keys))
    )


def unique_violations(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that repeat; NULLs never equal each other."""
    return (
        rows.where(~_any_null(keys))
        .groupBy(*keys)
        .agg(F.count("*").alias("n"))
        .where(F.col("n") > 1)
    )


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Key values without a parent and how many rows carry each.

    Children are counted per key first, so even a key held by most rows joins as one.
    """
    keys = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return keys.join(
        parent.select(F.col(parent_column).alias(column)), column, "left_anti"
    )


def null_audit(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _per_column(rows, {c: {"n_null": _tally(F.col(c).isNull())} for c in columns})


def length_audit(rows: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    return _per_column(rows, {
        c: {
            "max_chars": F.coalesce(F.max(F.length(c)), F.lit(0)),
            "n_too_long": _tally(F.length(c) > limit),
        }
        for c, limit in limits.items()
    })


def _overflows(column: str, precision: int, scale: int) -> Column:
    """Only values that rounding might carry over the limit need the slow conversion."""
    limit = 10 ** (precision - scale)
    size = F.abs(column)
    carried = (size >= limit - 10.0**-scale) & F.col(column).try_cast(
        f"decimal({precision},{scale})"
    ).isNull()
    return (size >= limit) | carried


def decimal_audit(rows: DataFrame, types: Mapping[str, tuple[int, int]]) -> DataFrame:
    """Values whose whole part does not fit DECIMAL(precision, scale)."""
    return _per_column(
        rows, {c: {"n_overflow": _tally(_overflows(c, p, s))} for c, (p, s) in types.items()}
    )


def required_columns(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """Which of ``names`` the table has, and in how many rows they are filled."""
    return _per_column(rows, {
        c: {
            "present": F.lit(c in rows.columns),
            "n_filled": F.count(F.col(c)) if c in rows.columns else F.count(F.lit(None)),
        }
        for c in names
    })


def add_columns(rows: DataFrame, contract_fields: Sequence) -> DataFrame:
    """Add the columns a table lacks, filled with their defaults; touch no others."""
    for f in contract_fields:
        if f.name not in rows.columns:
            default = F.expr(f.metadata.get("default", "NULL"))
            rows = rows.withColumn(f.name, default.cast(f.dataType))
    return rows


def schema_listing(rows: DataFrame, contract: Contract | None = None) -> DataFrame:
    """Name, type, nullability, default and NULL count of each column, by name."""
    fields = {f.name: f for f in contract.schema} if contract else {}
    figures = {}
    for f in rows.schema:
        promised = fields.get(f.name, f)
        figures[f.name] = {
            "data_type": F.lit(f.dataType.simpleString()),
            "is_nullable": F.lit(promised.nullable),
            "column_default": F.lit(promised.metadata.get("default")).cast("string"),
            "n_null": _tally(F.col(f.name).isNull()),
        }
    return _per_column(rows, figures).orderBy("column")


def audit(name: str, tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Every check the contract of ``name`` asks for, as named frames."""
    contract, rows = CONTRACTS[name], tables[name]
    out = {
        "primary_key": primary_key_violations(rows, contract.primary_key),
        "not_null": null_audit(rows, contract.required),
    }
    for keys in contract.unique:
        out["unique:" + ",".join(keys)] = unique_violations(rows, keys)
    for fk in contract.foreign_keys:
        if fk.parent in tables:
            out[f"foreign_key:{fk.column}"] = orphans(
                rows, fk.column, tables[fk.parent], fk.parent_column
            )
    if contract.max_lengths:
        out["length"] = length_audit(rows, contract.max_lengths)
    if contract.decimals:
        out["decimal"] = decimal_audit(
            rows, {c: (t.precision, t.scale) for c, t in contract.decimals.items()}
        )
    return out


def blocked_by_children(doomed: DataFrame, children: DataFrame, column: str) -> DataFrame:
    """Ids that cannot go because a restricting child still refers to them."""
    held = children.where(F.col(column).isNotNull()).select(F.col(column).alias("id")).distinct()
    return doomed.join(held, "id", "left_semi")


def without_children_of(rows: DataFrame, column: str, gone: DataFrame) -> DataFrame:
    return rows.join(gone.select(F.col("id").alias(column)), column, "left_anti")


def null_children_of(rows: DataFrame, column: str, gone: DataFrame) -> DataFrame:
    marked = gone.select(F.col("id").alias(column), F.lit(True).alias("_gone"))
    return (
        rows.join(marked, column, "left")
        .withColumn(column, F.when(F.col("_gone").isNull(), F.col(column)))
        .select(*rows.columns)
    )


def delete_rows(
    tables: Mapping[str, DataFrame], root: str, ids: DataFrame
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Delete ``ids`` from ``root`` the way the references say.

    Returns the tables after the delete and the ids a restricting child kept.
    """
    ids = ids.select("id").distinct()
    blocked = None
    for fk, child in _references(tables, root, "restrict"):
        held = blocked_by_children(ids, tables[child], fk.column)
        blocked = held if blocked is None else blocked.union(held).distinct()
    if blocked is None:
        blocked = ids.limit(0)
    else:
        ids = ids.join(blocked, "id", "left_anti")
    after = dict(tables)
    _delete(after, tables, root, ids)
    return after, blocked


def _references(
    tables: Mapping[str, DataFrame], parent: str, action: str
) -> list[tuple[ForeignKey, str]]:
    return [
        (fk, name)
        for name in tables
        for fk in CONTRACTS[name].foreign_keys
        if fk.parent == parent and fk.on_delete == action
    ]


def _delete(after: dict[str, DataFrame], before: Mapping[str, DataFrame], name: str,
            gone: DataFrame) -> None:
    if "id" in after[name].columns:
        after[name] = after[name].join(gone, "id", "left_anti")
    for fk, child in _references(before, name, "set_null"):
        after[child] = null_children_of(after[child], fk.column, gone)
    for fk, child in _references(before, name, "cascade"):
        if "id" in before[child].columns:
            dead = before[child].join(
                gone.select(F.col("id").alias(fk.column)), fk.column, "left_semi"
            ).select("id")
            _delete(after, before, child, dead)
        else:
            after[child] = without_children_of(after[child], fk.column, gone)
