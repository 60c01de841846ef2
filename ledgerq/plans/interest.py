"""Monthly interest: rule ladder, rates, and the keyed account table."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerq.functions.numbers import RATE, is_decimal, money, money_round, sign_of, strict_int, wide_decimal
from ledgerq.functions.text import clean, is_blank
from ledgerq.operators.constraints import limit_rules
from ledgerq.operators.dedup import last_arrivals
from ledgerq.operators.rules import CORRUPT, REJECT_COLUMNS, WRITE, Rule, accepted, rejected, validate
from ledgerq.operators.serial_unique import settle
from ledgerq.operators.upsert import merge_snapshot
from ledgerq.schemas import (
    ACCOUNT_RATES,
    AGE_RANGE,
    INT_INPUT,
    INT_KEY,
    INT_LIMITS,
    INT_NATURAL_KEY,
    INT_TABLE,
)
from ledgerq.sources.delimited import malformed_rule

RAW = INT_INPUT.names
# Fixed value: reason text.
TAKEN = "clave natural (nombre, saldo_inicial, edad, tipo) en uso por otra cuenta"


def validate_interest(raw: DataFrame) -> DataFrame:
    """Raw rows plus typed columns, interest and reject columns. One narrow pass."""
    rates = F.create_map(*chain(*((F.lit(t), F.lit(r).cast(RATE)) for t, r in ACCOUNT_RATES.items())))
    saldo, edad, tipo = F.col("_saldo"), F.col("_edad"), F.col("_tipo")
    typed = (
        raw.withColumns({f"_{c}": clean(F.col(c)) for c in ("saldo", "edad", "tipo")})
        .withColumns(
            {
                "nombre_ok": clean(F.col("nombre")),
                "tipo_ok": F.lower(tipo),
                "edad_ok": strict_int(edad),
                "_exacto": wide_decimal(saldo),
                "saldo_inicial": money(saldo),
            }
        )
        .withColumns({"_signo": sign_of(saldo, F.col("_exacto")), "tasa_interes_mensual": rates[F.col("tipo_ok")]})
        # WIDE x RATE is decimal(38,22): the product is exact and is rounded once.
        .withColumn("interes_calculado", money_round(F.col("_exacto") * F.col("tasa_interes_mensual")))
        .withColumn("saldo_final", money_round(F.col("_exacto") + F.col("interes_calculado")))
    )
    low, high = AGE_RANGE
    age_range = f"edad fuera de rango permitido [{low}-{high}] (valor=%s)"
    ladder = [
        *malformed_rule(raw),
        Rule(
            "tipo_no_soportado",
            ~F.col("tipo_ok").isin(*ACCOUNT_RATES),
            "tipo de cuenta no soportado ('%s')",
            tipo,
            named=True,
        ),
        Rule("edad_vacia", F.col("edad_ok").isNull() & is_blank(F.col("edad")), "edad vacia o nula", named=True),
        Rule("edad_no_numerica", F.col("edad_ok").isNull(), "edad no numerica ('%s')", edad, named=True),
        Rule(
            "edad_fuera_de_rango",
            ~F.col("edad_ok").between(low, high),
            age_range,
            F.col("edad_ok").cast("string"),
            named=True,
        ),
        Rule("saldo_vacio", F.col("_exacto").isNull() & is_blank(F.col("saldo")), "saldo vacio o nulo", named=True),
        Rule("saldo_no_numerico", ~is_decimal(saldo, F.col("_exacto")), "saldo no numerico ('%s')", saldo, named=True),
        Rule("saldo_negativo", F.col("_signo") < 0, "saldo negativo no permitido (%s)", saldo, named=True),
        *limit_rules(
            [x for x in INT_LIMITS if x.precision is None],
            {"nombre": F.col("nombre_ok"), "tipo": F.col("tipo_ok"), "edad": F.col("edad_ok")},
        ),
        # An amount is null when it does not fit.
        *(
            Rule(f"precision:{x.column}", F.col(x.column).isNull(), "%s excede numeric(%d,%d)" % (x.column, *x.precision), phase=WRITE)
            for x in INT_LIMITS
            if x.precision is not None
        ),
    ]
    who = F.format_string("Cuenta %s: ", F.col("cuenta_id").cast("string"))
    return validate(typed, ladder, who).drop("_saldo", "_edad", "_tipo", "_exacto", "_signo", CORRUPT)


def calculated_interest(validated: DataFrame) -> DataFrame:
    """Rows that pass every row rule, with the order key."""
    return accepted(validated).select(
        "seq",
        "cuenta_id",
        F.col("nombre_ok").alias("nombre"),
        F.col("tipo_ok").alias("tipo"),
        F.col("edad_ok").alias("edad"),
        *INT_TABLE.names[4:],
    )


def latest_accounts(validated: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Upsert by account only: the last row of each account wins."""
    return merge_accounts(stored, last_arrivals(calculated_interest(validated), INT_KEY).select(*INT_TABLE.names))


def merge_accounts(stored: DataFrame | None, incoming: DataFrame) -> DataFrame:
    """The account table after ``incoming``, one row per account, was written over it."""
    return merge_snapshot(stored, incoming, INT_KEY)


def serial_verdicts(validated: DataFrame, stored: DataFrame | None = None, replay_rows: int = 500_000) -> DataFrame:
    """Accepted rows with ``conserva``: whether both keys held when the row arrived."""
    rows = calculated_interest(validated)
    return settle(rows, stored, "cuenta_id", INT_NATURAL_KEY, replay_rows)


def serial_accounts(verdicts: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """The account table after every kept row was applied in arrival order."""
    kept = verdicts.where("conserva")
    return merge_accounts(stored, last_arrivals(kept, INT_KEY).select(*INT_TABLE.names))


def rejected_interest(validated: DataFrame, verdicts: DataFrame | None = None) -> DataFrame:
    """The reject trail; with ``verdicts``, the rows a natural key turned away as well."""
    trail = rejected(validated, RAW)
    if verdicts is None:
        return trail
    turned_away = verdicts.where(~F.col("conserva")).select("seq")
    return trail.unionByName(
        accepted(validated)
        .join(turned_away, "seq", "left_semi")
        .select(
            "seq",
            *RAW,
            F.lit(WRITE).alias(REJECT_COLUMNS[0]),
            F.lit("clave_en_uso").alias(REJECT_COLUMNS[1]),
            F.lit(TAKEN).alias(REJECT_COLUMNS[2]),
        )
    )
