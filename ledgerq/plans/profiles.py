"""Counts by value and by layout, to look at an input before it is loaded."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerq.functions.dates import date_layout
from ledgerq.functions.text import clean


def value_counts(inputs: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows per trimmed value of one column of each input."""
    parts = [
        df.groupBy(F.lit(name).alias("entrada"), clean(F.col(column)).alias("valor")).agg(
            F.count(F.lit(1)).alias("filas")
        )
        for name, (df, column) in inputs.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def layout_counts(df: DataFrame, column: str = "fecha") -> DataFrame:
    """Rows per date layout, and how many of them are not in the standard one."""
    layout = F.coalesce(date_layout(clean(F.col(column))), F.lit("ninguno"))
    return df.groupBy(layout.alias("formato")).agg(F.count(F.lit(1)).alias("filas"))


def key_profile(rows: DataFrame, natural_key: tuple[str, ...], account: str = "cuenta_id") -> DataFrame:
    """Valid rows, distinct accounts, distinct natural keys, and rows that repeat a key.

    Distinct pairs are counted in steps, so that no task holds a set of values.
    """
    names = ("filas", "cuentas", "claves", "repetidas")
    per_key = rows.groupBy(*natural_key).agg(F.count(F.lit(1)).alias("n"))
    keys = per_key.select(F.col("n"), F.lit(0), F.lit(1), F.col("n") - 1).toDF(*names)
    accounts = rows.select(account).distinct().select(F.lit(0), F.lit(1), F.lit(0), F.lit(0)).toDF(*names)
    return keys.unionByName(accounts).agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names))
