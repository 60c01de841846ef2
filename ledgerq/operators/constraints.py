"""Declared column constraints, checked as columns because a Parquet table enforces none."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerq.operators.rules import WRITE, Rule, validate


@dataclass(frozen=True)
class Limit:
    """NOT NULL, VARCHAR(n), NUMERIC(p, s) and INTEGER of one column."""

    column: str
    required: bool = False
    max_length: int | None = None
    precision: tuple[int, int] | None = None
    integer: bool = False


def limit_rules(limits: Sequence[Limit], columns: Mapping[str, Column] | None = None) -> list[Rule]:
    """The limits as write-phase rules.

    ``columns`` maps a limit's column to the expression that holds its value before it is stored.
    """
    rules = []
    for limit in limits:
        value = (columns or {}).get(limit.column, F.col(limit.column))
        name = limit.column
        if limit.required:
            rules.append(Rule(f"nulo:{name}", value.isNull(), f"{name} no admite nulos", phase=WRITE))
        if limit.max_length is not None:
            size = limit.max_length
            rules.append(
                Rule(f"largo:{name}", F.length(value) > size, f"{name} excede {size} caracteres", phase=WRITE)
            )
        if limit.precision is not None:
            digits, scale = limit.precision
            too_large = F.abs(F.round(value, scale)) >= F.lit(10 ** (digits - scale))
            rules.append(
                Rule(f"precision:{name}", too_large, f"{name} excede numeric({digits},{scale})", phase=WRITE)
            )
        if limit.integer:
            rules.append(
                Rule(f"rango:{name}", F.abs(value.cast("long")) > 2**31 - 1, f"{name} excede integer", phase=WRITE)
            )
    return rules


def check_constraints(df: DataFrame, limits: Sequence[Limit]) -> DataFrame:
    """Add the reject columns for the first limit each row breaks; null where it breaks none."""
    return validate(df, limit_rules(limits))


class LimitBroken(ValueError):
    """Rows of a report that its table cannot hold."""


def require(df: DataFrame, limits: Sequence[Limit]) -> DataFrame:
    """``df``, or an error that names some rows and the limits they break. Looks at every row of ``df``."""
    broken = check_constraints(df, limits).where(F.col("reject_code").isNotNull())
    shown = broken.select(*df.columns, "reject_reason").limit(3).collect()
    if shown:
        raise LimitBroken("; ".join(f"{r['reject_reason']}: {tuple(r)[:2]}" for r in shown))
    return df
