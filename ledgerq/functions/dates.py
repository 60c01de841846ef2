"""Dates written in any of four layouts: year-month-day or day-month-year, dash or slash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerq.functions.text import clean

# The accepted layouts, two digits for day and month and four for the year, with
# the same separator twice.
YEAR_FIRST = r"^[0-9]{4}(?:-[0-9]{2}-|/[0-9]{2}/)[0-9]{2}\z"
DAY_FIRST = r"^[0-9]{2}(?:-[0-9]{2}-|/[0-9]{2}/)[0-9]{4}\z"
LAYOUTS = {"iso": "yyyy-MM-dd", "ymd_slash": "yyyy/MM/dd", "dmy_dash": "dd-MM-yyyy", "dmy_slash": "dd/MM/yyyy"}


def date_layout(text: Column) -> Column:
    """Which layout the text is written in, null when none fits."""
    # The fifth character tells which of the two patterns can fit, so one regex runs per row.
    fifth = F.substring(text, 5, 1)
    return (
        F.when(fifth.isin("-", "/"), F.when(text.rlike(YEAR_FIRST), _by_separator(fifth, "iso", "ymd_slash")))
        .when(text.rlike(DAY_FIRST), _by_separator(F.substring(text, 3, 1), "dmy_dash", "dmy_slash"))
    )


def _by_separator(separator: Column, dashed: str, slashed: str) -> Column:
    return F.when(separator == "-", LAYOUTS[dashed]).otherwise(LAYOUTS[slashed])


def with_date(df: DataFrame, source: str, target: str = "fecha_ok", layout: str = "formato_fecha") -> DataFrame:
    """Add the parsed date and its layout.

    A day past the end of its month moves to the last day of that month; year 0, month 13 and day
    32 give null. Each step is a projection of its own, so that what it computes is computed once
    per row, and every part is nulled before ``make_date`` sees it: nothing here can throw.
    """
    text, year_first = F.col("_fecha"), F.col(layout).isin(LAYOUTS["iso"], LAYOUTS["ymd_slash"])

    def part(in_year_first: int, in_day_first: int, size: int) -> Column:
        start = F.when(year_first, in_year_first).when(F.col(layout).isNotNull(), in_day_first)
        return F.substring(text, start, F.lit(size)).try_cast("int")

    year, month, day = F.col("_y"), F.col("_m"), F.col("_d")
    real = year.between(1, 9999) & month.between(1, 12) & day.between(1, 31)
    last = F.dayofmonth(F.last_day(F.make_date(year, month, F.lit(1))))
    return (
        df.withColumn("_fecha", clean(F.col(source)))
        .withColumn(layout, date_layout(text))
        .withColumns({"_y": part(1, 7, 4), "_m": part(6, 4, 2), "_d": part(9, 1, 2)})
        .withColumns({name: F.when(real, F.col(name)) for name in ("_y", "_m", "_d")})
        .withColumn("_d", F.when(day > 28, F.least(day, last)).otherwise(day))
        .withColumn(target, F.make_date(year, month, day))
        .drop("_y", "_m", "_d", "_fecha")
    )
