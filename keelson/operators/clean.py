"""Projection, casts and schema contracts.

All of these are narrow transformations (no shuffle); the contract check
computes its verdict per row with built-in expressions so it runs inside
the scan's codegen stage.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType


def require_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Return ``df`` unchanged, or raise naming the first missing column."""
    present = set(df.columns)
    for c in cols:
        if c not in present:
            raise ValueError(f"missing column: {c}")
    return df


def cast_numeric(df: DataFrame, cols: Iterable[str], to: str = "double") -> DataFrame:
    """Cast columns to a numeric type; text that does not parse becomes null
    (``try_cast`` — Spark 4 runs in ANSI mode, where ``cast`` would fail)."""
    return df.withColumns({c: F.col(c).try_cast(to) for c in cols})


def rename_label(df: DataFrame, src: str, dst: str) -> DataFrame:
    require_columns(df, [src])
    return df.withColumnRenamed(src, dst)


def project(df: DataFrame, cols: Iterable[str | Column]) -> DataFrame:
    return df.select(*cols)


def drop_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Drop the listed columns; names not present are ignored."""
    return df.drop(*cols)


def _type_name(t: DataType) -> str:
    return t.simpleString()


def contract_errors(df: DataFrame, contract: StructType) -> Column:
    """``array<string>`` of violations for one row (empty when valid).

    * a non-nullable field that is null → ``'<field>: required'``
    * a value that does not convert to the field's type → ``'<field>: not <type>'``
    """
    require_columns(df, [f.name for f in contract.fields])
    checks = []
    for field in contract.fields:
        c = F.col(field.name)
        if not field.nullable:
            checks.append(F.when(c.isNull(), F.lit(f"{field.name}: required")))
        checks.append(
            F.when(c.isNotNull() & c.try_cast(field.dataType).isNull(),
                   F.lit(f"{field.name}: not {_type_name(field.dataType)}"))
        )
    return F.array_compact(F.array(*checks))


def contract_check(df: DataFrame, contract: StructType,
                   errors_col: str = "errors") -> tuple[DataFrame, DataFrame]:
    """Split ``df`` into rows that satisfy ``contract`` (typed per the
    contract) and rejected rows carrying their list of errors.

    One plan computes the errors column; both outputs filter it, so Spark
    evaluates the checks in the scan stage with no shuffle.
    """
    checked = df.withColumn(errors_col, contract_errors(df, contract))
    ok = F.size(F.col(errors_col)) == 0
    typed = {f.name: F.col(f.name).try_cast(f.dataType) for f in contract.fields}
    valid = checked.filter(ok).withColumns(typed).drop(errors_col)
    rejected = checked.filter(~ok)
    return valid, rejected
