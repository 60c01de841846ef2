"""Column rules on hand-written edge values."""

import calendar
import datetime as dt
import random
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerq.functions.dates import with_date
from ledgerq.functions.numbers import is_decimal, money, sign_of, strict_int, wide_decimal
from ledgerq.functions.text import clean, fold_accents, is_blank
from ledgerq.operators.constraints import Limit, check_constraints
from ledgerq.plans.interest import calculated_interest, validate_interest
from ledgerq.plans.movements import accepted_movements, validate_movements
from ledgerq.plans.transactions import accepted_transactions, validate_transactions


def texts(spark, values):
    return spark.createDataFrame([(v,) for v in values], "t string")


def column(spark, values, expression):
    return [r[0] for r in texts(spark, values).select(expression).collect()]


DATES = {
    "2024-02-30": dt.date(2024, 2, 29),
    "30/02/2023": dt.date(2023, 2, 28),
    "2024-04-31": dt.date(2024, 4, 30),
    "2024/01/05": dt.date(2024, 1, 5),
    "31-12-1999": dt.date(1999, 12, 31),
    " 01/02/2024\t": dt.date(2024, 2, 1),
    "2024-13-01": None,
    "2024-06-32": None,
    "00-01-2024": None,
    "2024-1-1": None,
    "0000-01-01": None,
    "2024-06-30T00": None,
    "2024-06/30": None,
    "20/06-2024": None,
    "٢٠٢٤-01-01": None,
    "": None,
    None: None,
}


def test_dates(spark):
    rows = with_date(texts(spark, DATES), "t").select("t", "fecha_ok").collect()
    assert {r["t"]: r["fecha_ok"] for r in rows} == DATES


def parsed(text):
    """The four layouts, one after the other, with late days moved back to the end of the month."""
    for pattern in (r"(?P<y>\d{4})(?P<s>[-/])(?P<m>\d\d)(?P=s)(?P<d>\d\d)", r"(?P<d>\d\d)(?P<s>[-/])(?P<m>\d\d)(?P=s)(?P<y>\d{4})"):
        found = re.fullmatch(pattern, text, re.ASCII)
        if found:
            y, m, d = (int(found[k]) for k in "ymd")
            if y >= 1 and 1 <= m <= 12 and 1 <= d <= 31:
                return dt.date(y, m, min(d, calendar.monthrange(y, m)[1]))
    return None


def test_random_dates(spark):
    rng = random.Random(7)
    shapes = ["{y:04d}{s}{m:02d}{s}{d:02d}", "{d:02d}{s}{m:02d}{s}{y:04d}", "{y}{s}{m}{s}{d}", "{y:04d}{s}{m:02d}{t}{d:02d}"]
    values = {
        rng.choice(shapes).format(y=rng.choice([0, 1, 1900, 2023, 2024, 9999]), m=rng.randrange(15), d=rng.randrange(34), s=s, t="/" if s == "-" else "-")
        for _ in range(3000)
        for s in ("-", "/")
    }
    rows = with_date(texts(spark, sorted(values)), "t").select("t", "fecha_ok").collect()
    assert [(r["t"], r["fecha_ok"]) for r in rows if r["fecha_ok"] != parsed(r["t"])] == []


def test_date_layouts(spark):
    rows = with_date(texts(spark, ["2024-13-01", "2024/01/01", "01-01-2024", "01/01/2024", "x"]), "t")
    assert [r[0] for r in rows.select("formato_fecha").collect()] == [
        "yyyy-MM-dd", "yyyy/MM/dd", "dd-MM-yyyy", "dd/MM/yyyy", None,
    ]


AMOUNTS = {"1e3": 1000, ".5": 0.5, "5.": 5, "+5": 5, "-0": 0, " 12 ": 12, "1e-30": 0, "-1e-30": 0}
NOT_AMOUNTS = ["NaN", "1d", "1,000", "Infinity", "", " ", "--1", "1e", "."]


def test_amounts(spark):
    text = clean(F.col("t"))
    assert column(spark, AMOUNTS, money(text)) == [Decimal(str(v)) for v in AMOUNTS.values()]
    numeric = is_decimal(text, wide_decimal(text))
    assert column(spark, [*AMOUNTS, "1e40"], numeric) == [True] * (len(AMOUNTS) + 1)
    assert column(spark, NOT_AMOUNTS, numeric) == [False] * len(NOT_AMOUNTS)


def test_amount_signs_are_those_of_the_exact_number(spark):
    text = F.col("t")
    values = {"1e-30": 1, "-1e-30": -1, "-1e40": -1, "1e40": 1, "0e9": 0, "-0.000": 0, "0.004": 1}
    assert column(spark, values, sign_of(text, wide_decimal(text))) == list(values.values())


def test_money_rounds_once(spark):
    assert column(spark, ["0.005", "-0.005", "0.00499999999999", "1e13"], money(F.col("t"))) == [
        Decimal("0.01"), Decimal("-0.01"), Decimal("0.00"), None,
    ]


def test_integers(spark):
    values = {"+25": 25, "18": 18, "-3": -3, "25.0": None, "": None, "2147483648": None, "1e1": None}
    assert column(spark, values, strict_int(F.col("t"))) == list(values.values())


def test_blank_and_trim(spark):
    assert column(spark, [None, "", " \t", " ", " ", "x"], is_blank(F.col("t"))) == [
        True, True, True, True, False, False,
    ]
    assert column(spark, ["\t a b \n", None, " x"], clean(F.col("t"))) == ["a b", "", " x"]


def test_accents(spark):
    values = ["depósito", "depósito", "retiro", "ḍeṗọsito", "ñ"]
    assert column(spark, values, fold_accents(F.col("t"))) == ["deposito", "deposito", "retiro", "deposito", "n"]


def raw_tx(spark, *rows):
    named = [(i, *r) for i, r in enumerate(rows, 1)]
    return spark.createDataFrame(named, "seq long, id long, fecha string, monto string, tipo string")


def test_transaction_flags(spark):
    rows = accepted_transactions(
        validate_transactions(
            raw_tx(
                spark,
                (1, "2024-01-01", "5", "credito"),
                (2, "2024-01-01", "-5", " Debito "),
                (3, "2024-01-01", "0", "otra"),
                (4, "2024-01-01", "0.001", ""),
                (5, "2024-01-01", "5", None),
            )
        )
    ).orderBy("seq")
    assert [(r["tipo"], str(r["monto"]), r["es_anomalia"], r["motivo_anomalia"]) for r in rows.collect()] == [
        ("CREDITO", "5.00", False, None),
        ("DEBITO", "-5.00", True, "monto negativo"),
        ("OTRA", "0.00", True, "tipo de transaccion no reconocido ('otra'); monto en cero"),
        ("DESCONOCIDO", "0.00", True, "tipo de transaccion no reconocido ('')"),
        ("DESCONOCIDO", "5.00", True, "tipo de transaccion no reconocido ('')"),
    ]


@pytest.mark.parametrize(
    "row, phase, code, reason",
    [
        ((7, " ", "", "x"), "process", "fecha_vacia", "Fecha vacia o nula"),
        ((7, "2024-13-01", "", "x"), "process", "fecha_invalida", "Formato de fecha no reconocido: '2024-13-01'"),
        ((7, "2024-01-01", " ", "x"), "process", "monto_vacio", "Transaccion id=7: monto vacio o nulo, no se puede procesar"),
        ((7, "2024-01-01", "a%sb", "x"), "process", "monto_no_numerico", "Transaccion id=7: monto no numerico ('a%sb')"),
        ((7, "2024-01-01", "1e13", "x"), "write", "precision:monto", "monto excede numeric(15,2)"),
        ((7, "2024-01-01", "1e40", "x"), "write", "precision:monto", "monto excede numeric(15,2)"),
        ((None, "2024-01-01", "1", "x"), "write", "nulo:id_origen", "id_origen no admite nulos"),
        ((7, "2024-01-01", "1", "x" * 21), "write", "largo:tipo", "tipo excede 20 caracteres"),
    ],
)
def test_transaction_rejects(spark, row, phase, code, reason):
    got = validate_transactions(raw_tx(spark, row)).first()
    assert (got["reject_phase"], got["reject_code"], got["reject_reason"]) == (phase, code, reason)


def raw_int(spark, *rows):
    named = [(i, *r) for i, r in enumerate(rows, 1)]
    return spark.createDataFrame(named, "seq long, cuenta_id long, nombre string, saldo string, edad string, tipo string")


def test_interest_rounding(spark):
    rows = calculated_interest(
        validate_interest(
            raw_int(
                spark,
                (1, " Ana ", "12345.665", "+25", "AHORRO"),
                (2, None, "8.99999998", "18", "ahorro"),
                (3, "x", "0", "90", "prestamo"),
                (4, "x", "10000", "30", " Prestamo "),
            )
        )
    ).orderBy("seq")
    assert [
        (r["nombre"], str(r["saldo_inicial"]), str(r["interes_calculado"]), str(r["saldo_final"])) for r in rows.collect()
    ] == [
        ("Ana", "12345.67", "185.18", "12530.85"),
        ("", "9.00", "0.13", "9.13"),
        ("x", "0.00", "0.00", "0.00"),
        ("x", "10000.00", "250.00", "10250.00"),
    ]


@pytest.mark.parametrize(
    "row, code, reason",
    [
        ((7, "n", "1", "30", "préstamo"), "tipo_no_soportado", "Cuenta 7: tipo de cuenta no soportado ('préstamo')"),
        ((7, "n", "", "", "ahorro"), "edad_vacia", "Cuenta 7: edad vacia o nula"),
        ((7, "n", "", "25.0", "ahorro"), "edad_no_numerica", "Cuenta 7: edad no numerica ('25.0')"),
        ((7, "n", "", "17", "ahorro"), "edad_fuera_de_rango", "Cuenta 7: edad fuera de rango permitido [18-90] (valor=17)"),
        ((7, "n", "", "91", "ahorro"), "edad_fuera_de_rango", "Cuenta 7: edad fuera de rango permitido [18-90] (valor=91)"),
        ((7, "n", None, "30", "ahorro"), "saldo_vacio", "Cuenta 7: saldo vacio o nulo"),
        ((7, "n", "NaN", "30", "ahorro"), "saldo_no_numerico", "Cuenta 7: saldo no numerico ('NaN')"),
        ((7, "n", "-1e20", "30", "ahorro"), "saldo_negativo", "Cuenta 7: saldo negativo no permitido (-1e20)"),
        ((7, "n" * 151, "1", "30", "ahorro"), "largo:nombre", "nombre excede 150 caracteres"),
        ((7, "n", "9999999999999", "30", "ahorro"), "precision:saldo_final", "saldo_final excede numeric(15,2)"),
    ],
)
def test_interest_rejects(spark, row, code, reason):
    got = validate_interest(raw_int(spark, row)).first()
    assert (got["reject_code"], got["reject_reason"]) == (code, reason)


def raw_mov(spark, *rows):
    named = [(i, *r) for i, r in enumerate(rows, 1)]
    schema = "seq long, cuenta_id long, fecha string, transaccion string, monto string, descripcion string"
    return spark.createDataFrame(named, schema)


def test_movement_corrections(spark):
    validated = validate_movements(
        raw_mov(
            spark,
            (1, "01/03/2024", "DEPÓSITO ", "-5", " a "),
            (1, "01/03/2024", "compra", "5", " "),
            (1, "01/03/2024", "pago", "-1e-30", None),
        )
    )
    rows = accepted_movements(validated).collect()
    fixed = "signo de monto corregido automaticamente (no correspondia al tipo de movimiento '%s')"
    assert [(r["tipo_movimiento"], str(r["monto"]), r["descripcion"], r["motivo_anomalia"]) for r in rows] == [
        ("deposito", "5.00", "a", fixed % "deposito"),
        ("compra", "-5.00", "Movimiento sin descripcion registrada", fixed % "compra"),
        ("pago", "0.00", "Movimiento sin descripcion registrada", None),
    ]


@pytest.mark.parametrize(
    "row, code",
    [
        ((1, "x", "otro", "", ""), "fecha_invalida"),
        ((1, "2024-01-01", "otro", "", ""), "tipo_no_reconocido"),
        ((1, "2024-01-01", "pago", "", ""), "monto_vacio"),
        ((1, "2024-01-01", "pago", "1,0", ""), "monto_no_numerico"),
        ((1, "2024-01-01", "pago", "-0.0", ""), "monto_cero"),
        ((1, "2024-01-01", "pago", "-1e14", ""), "precision:monto"),
        ((1, "2024-01-01", "pago", "-1", "d" * 201), "largo:descripcion"),
        ((None, "2024-01-01", "pago", "-1", "d"), "nulo:cuenta_id"),
    ],
)
def test_movement_rejects(spark, row, code):
    assert validate_movements(raw_mov(spark, row)).first()["reject_code"] == code


def test_first_broken_limit_is_named(spark):
    df = spark.createDataFrame([(None, "ab"), (Decimal("9999999999999.995"), "abc"), (Decimal(1), "abc"), (Decimal(1), None)], "m decimal(31,18), t string")
    limits = [Limit("m", required=True, precision=(15, 2)), Limit("t", max_length=2)]
    assert [r["reject_code"] for r in check_constraints(df, limits).collect()] == ["nulo:m", "precision:m", "largo:t", None]
