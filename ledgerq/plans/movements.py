"""Annual movements and the statement built from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerq.functions.dates import with_date
from ledgerq.functions.numbers import MONEY, WIDE_TOTAL, is_decimal, money, sign_of, wide_decimal
from ledgerq.functions.text import clean, fold_accents, is_blank
from ledgerq.operators.constraints import limit_rules
from ledgerq.operators.rules import CORRUPT, WRITE, Rule, accepted, rejected, validate
from ledgerq.operators.upsert import merge_snapshot
from ledgerq.schemas import (
    MOV_INPUT,
    MOV_LIMITS,
    MOV_TABLE,
    MOVEMENT_TYPES,
    NO_DESCRIPTION,
    STATEMENT_KEY,
    STATEMENT_TABLE,
)
from ledgerq.sources.delimited import malformed_rule

RAW = MOV_INPUT.names
# Fixed value: reason text.
SIGN_FIXED = ("signo de monto corregido automaticamente (no correspondia al tipo de movimiento '", "')")


def validate_movements(raw: DataFrame) -> DataFrame:
    """Raw rows plus typed and corrected columns plus reject columns. One narrow pass."""
    monto, tipo = F.col("_monto"), F.col("_tipo")
    typed = (
        with_date(raw, "fecha")
        .withColumns({f"_{c}": clean(F.col(n)) for c, n in (("monto", "monto"), ("tipo", "transaccion"), ("texto", "descripcion"))})
        .withColumns({"_exacto": wide_decimal(monto), "tipo_movimiento": fold_accents(F.lower(tipo))})
        .withColumn("_signo", sign_of(monto, F.col("_exacto")))
    )
    wrong_sign = F.when(F.col("tipo_movimiento") == "deposito", F.col("_signo") < 0).otherwise(F.col("_signo") > 0)
    typed = typed.withColumns(
        {
            "es_anomalia": wrong_sign,
            "_al_guardar": money(monto),
            "descripcion_ok": F.when(is_blank(F.col("_texto")), NO_DESCRIPTION).otherwise(F.col("_texto")),
        }
    ).withColumns(
        {
            "monto_ok": F.when(F.col("es_anomalia"), -F.col("_al_guardar")).otherwise(F.col("_al_guardar")).cast(MONEY),
            "motivo_anomalia": F.when(
                F.col("es_anomalia"), F.concat(F.lit(SIGN_FIXED[0]), F.col("tipo_movimiento"), F.lit(SIGN_FIXED[1]))
            ),
        }
    )
    # A blank never parses, so the blank tests only look at what did not.
    no_date, no_amount = F.col("fecha_ok").isNull(), F.col("_exacto").isNull()
    ladder = [
        *malformed_rule(raw),
        Rule("fecha_vacia", no_date & is_blank(F.col("fecha")), "Fecha vacia o nula"),
        Rule("fecha_invalida", no_date, "Formato de fecha no reconocido: '%s'", clean(F.col("fecha"))),
        Rule(
            "tipo_no_reconocido",
            ~F.col("tipo_movimiento").isin(*MOVEMENT_TYPES),
            "tipo de movimiento no reconocido ('%s')",
            tipo,
            named=True,
        ),
        Rule("monto_vacio", no_amount & is_blank(F.col("monto")), "monto vacio o nulo", named=True),
        Rule(
            "monto_no_numerico", ~is_decimal(monto, F.col("_exacto")), "monto no numerico ('%s')", monto, named=True
        ),
        Rule("monto_cero", F.col("_signo") == 0, "movimiento con monto en cero, no se puede clasificar", named=True),
        Rule("precision:monto", F.col("monto_ok").isNull(), "monto excede numeric(15,2)", phase=WRITE),
        *limit_rules(
            [x for x in MOV_LIMITS if x.column != "monto"],
            {"fecha": F.col("fecha_ok"), "descripcion": F.col("descripcion_ok")},
        ),
    ]
    who = F.format_string("Cuenta %s: ", F.col("cuenta_id").cast("string"))
    return validate(typed, ladder, who).drop("_monto", "_tipo", "_texto", "_exacto", "_signo", "_al_guardar", CORRUPT)


def accepted_movements(validated: DataFrame) -> DataFrame:
    """The detail table. It has no unique key: equal movements all stay."""
    return accepted(validated).select(
        "cuenta_id",
        F.col("fecha_ok").alias("fecha"),
        "tipo_movimiento",
        F.col("monto_ok").alias("monto"),
        F.col("descripcion_ok").alias("descripcion"),
        "es_anomalia",
        "motivo_anomalia",
    ).select(*MOV_TABLE.names)


def rejected_movements(validated: DataFrame) -> DataFrame:
    return rejected(validated, RAW)


def statement_totals(movements: DataFrame) -> DataFrame:
    """Totals per account and year, as wide as they come: one hash aggregation, combined before its only shuffle."""

    def total(tipo: str | None = None) -> Column:
        value = F.col("monto") if tipo is None else F.when(F.col("tipo_movimiento") == tipo, F.col("monto"))
        return F.coalesce(F.sum(value), F.lit(0)).cast(WIDE_TOTAL)

    return (
        movements.groupBy("cuenta_id", F.year("fecha").alias("anio"))
        .agg(
            total("deposito").alias("total_depositos"),
            total("retiro").alias("total_retiros"),
            total("compra").alias("total_compras"),
            total("pago").alias("total_pagos"),
            total().alias("saldo_neto"),
            F.count(F.lit(1)).alias("cantidad_movimientos"),
            F.count_if("es_anomalia").alias("cantidad_anomalias"),
        )
        .select(*STATEMENT_TABLE.names)
    )


def as_statement(totals: DataFrame) -> DataFrame:
    """Totals that fit the statement, with its types."""
    return totals.select(*(F.col(f.name).cast(f.dataType) for f in STATEMENT_TABLE))


def annual_statement(movements: DataFrame) -> DataFrame:
    """The statement. A total that it cannot hold is an error; a run checks them first (``STATEMENT_LIMITS``)."""
    return as_statement(statement_totals(movements))


def upsert_statement(stored: DataFrame | None, statement: DataFrame) -> DataFrame:
    """Statements of this load replace stored ones of the same account and year."""
    return merge_snapshot(stored, statement, STATEMENT_KEY)
