"""Input and output schemas, declared constraints and the fixed values of the data domain."""

from __future__ import annotations

from pyspark.sql import types as T

from ledgerq.functions.numbers import MONEY, RATE, TOTAL
from ledgerq.operators.constraints import Limit


def _payload(key: str, *texts: str) -> T.StructType:
    return T.StructType([T.StructField(key, T.LongType()), *(T.StructField(t, T.StringType()) for t in texts)])


# Inputs: one numeric key, every other field kept as text so that bad values reach the rules.
TX_INPUT = _payload("id", "fecha", "monto", "tipo")
INT_INPUT = _payload("cuenta_id", "nombre", "saldo", "edad", "tipo")
MOV_INPUT = _payload("cuenta_id", "fecha", "transaccion", "monto", "descripcion")


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


TX_TABLE = _table(
    id_origen=T.LongType(), fecha=T.DateType(), monto=MONEY, tipo=T.StringType(),
    es_anomalia=T.BooleanType(), motivo_anomalia=T.StringType(),
)
INT_TABLE = _table(
    cuenta_id=T.LongType(), nombre=T.StringType(), tipo=T.StringType(), edad=T.IntegerType(),
    saldo_inicial=MONEY, tasa_interes_mensual=RATE, interes_calculado=MONEY, saldo_final=MONEY,
)
MOV_TABLE = _table(
    cuenta_id=T.LongType(), fecha=T.DateType(), tipo_movimiento=T.StringType(), monto=MONEY,
    descripcion=T.StringType(), es_anomalia=T.BooleanType(), motivo_anomalia=T.StringType(),
)
STATEMENT_TABLE = _table(
    cuenta_id=T.LongType(), anio=T.IntegerType(), total_depositos=TOTAL, total_retiros=TOTAL,
    total_compras=TOTAL, total_pagos=TOTAL, saldo_neto=TOTAL, cantidad_movimientos=T.LongType(),
    cantidad_anomalias=T.LongType(),
)

TX_KEY = ("fecha", "monto", "tipo")
INT_KEY = ("cuenta_id",)
INT_NATURAL_KEY = ("nombre", "saldo_inicial", "edad", "tipo")
STATEMENT_KEY = ("cuenta_id", "anio")

# Declared limits, in the order in which they are checked.
TX_LIMITS = (
    Limit("id_origen", required=True),
    Limit("fecha", required=True),
    Limit("monto", required=True, precision=(15, 2)),
    Limit("tipo", required=True, max_length=20),
    Limit("es_anomalia", required=True),
    Limit("motivo_anomalia", max_length=200),
)
INT_LIMITS = (
    Limit("cuenta_id", required=True),
    Limit("nombre", required=True, max_length=150),
    Limit("tipo", required=True, max_length=20),
    Limit("edad", required=True),
    Limit("saldo_inicial", required=True, precision=(15, 2)),
    Limit("tasa_interes_mensual", required=True, precision=(6, 4)),
    Limit("interes_calculado", required=True, precision=(15, 2)),
    Limit("saldo_final", required=True, precision=(15, 2)),
)
MOV_LIMITS = (
    Limit("cuenta_id", required=True),
    Limit("fecha", required=True),
    Limit("tipo_movimiento", required=True, max_length=20),
    Limit("monto", required=True, precision=(15, 2)),
    Limit("descripcion", required=True, max_length=200),
    Limit("es_anomalia", required=True),
    Limit("motivo_anomalia", max_length=200),
)
STATEMENT_LIMITS = (
    Limit("cuenta_id", required=True),
    Limit("anio", required=True),
    *(Limit(f.name, required=True, precision=(18, 2)) for f in STATEMENT_TABLE if f.dataType == TOTAL),
    Limit("cantidad_movimientos", required=True, integer=True),
    Limit("cantidad_anomalias", required=True, integer=True),
)
SUMMARY_LIMITS = (
    *(Limit(c, required=True, integer=True) for c in ("total_procesadas", "total_anomalias", "total_omitidas")),
    *(Limit(c, required=True, precision=(18, 2)) for c in ("monto_total_creditos", "monto_total_debitos")),
)

# Fixed values of the domain.
TX_TYPES = ("DEBITO", "CREDITO")
TX_UNKNOWN = "DESCONOCIDO"
ACCOUNT_RATES = {"ahorro": "0.0150", "prestamo": "0.0250"}
AGE_RANGE = (18, 90)
MOVEMENT_TYPES = ("deposito", "retiro", "compra", "pago")
NO_DESCRIPTION = "Movimiento sin descripcion registrada"
QUALITY_OK = "CALIDAD_OK"
REVIEW = "REVISION_REQUERIDA"
COMPLETED = "COMPLETED"
FAILED = "FAILED"
ALREADY_COMPLETE = "ALREADY_COMPLETE"
