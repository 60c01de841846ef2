"""Daily transactions: rule ladder, anomaly flags, natural-key uniqueness and the summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerq.functions.dates import with_date
from ledgerq.functions.numbers import MONEY, TOTAL, WIDE_TOTAL, is_decimal, money, sign_of, wide_decimal
from ledgerq.functions.text import clean, is_blank
from ledgerq.operators.constraints import limit_rules
from ledgerq.operators.dedup import first_arrivals, late_arrivals, repeated_keys
from ledgerq.operators.row_ranges import RANGE
from ledgerq.operators.rules import CORRUPT, REJECT_COLUMNS, WRITE, Rule, accepted, rejected, validate
from ledgerq.schemas import TX_INPUT, TX_KEY, TX_LIMITS, TX_TABLE, TX_TYPES, TX_UNKNOWN
from ledgerq.sources.delimited import malformed_rule

RAW = TX_INPUT.names
#: The natural key among the columns of validated rows.
TYPED_KEY = tuple(f"{c}_ok" for c in TX_KEY)
# Reason texts.
BAD_TYPE = ("tipo de transaccion no reconocido ('", "')")
NEGATIVE, ZERO = "monto negativo", "monto en cero"
DUPLICATE = "clave natural duplicada (fecha, monto, tipo); se conserva el orden %s"


def validate_transactions(raw: DataFrame) -> DataFrame:
    """Raw rows plus typed columns plus reject columns. One narrow pass, no row dropped."""
    typed = (
        with_date(raw, "fecha")
        .withColumns({"_monto": clean(F.col("monto")), "_tipo": clean(F.col("tipo"))})
        .withColumns({"_exacto": wide_decimal(F.col("_monto")), "tipo_ok": F.upper("_tipo")})
        .withColumn("_signo", sign_of(F.col("_monto"), F.col("_exacto")))
    )
    monto, tipo = F.col("_monto"), F.col("_tipo")
    bad_type = F.when(~F.col("tipo_ok").isin(*TX_TYPES), F.concat(F.lit(BAD_TYPE[0]), tipo, F.lit(BAD_TYPE[1])))
    bad_sign = F.when(F.col("_signo") < 0, NEGATIVE).when(F.col("_signo") == 0, ZERO)
    typed = typed.withColumns(
        {
            "motivo_anomalia": F.nullif(F.concat_ws("; ", bad_type, bad_sign), F.lit("")),
            "tipo_ok": F.when(bad_type.isNotNull() & is_blank(tipo), TX_UNKNOWN).otherwise(F.col("tipo_ok")),
            "monto_ok": money(monto),
        }
    ).withColumn("es_anomalia", F.col("motivo_anomalia").isNotNull())
    who = F.format_string("Transaccion id=%s: ", F.col("id").cast("string"))
    # The amount has a rule of its own, as it is null when it does not fit.
    limits = limit_rules(
        [x for x in TX_LIMITS if x.column != "monto"],
        {"id_origen": F.col("id"), "fecha": F.col("fecha_ok"), "tipo": F.col("tipo_ok")},
    )
    # A blank never parses, so the blank tests only look at what did not.
    no_date, no_amount = F.col("fecha_ok").isNull(), F.col("_exacto").isNull()
    ladder = [
        *malformed_rule(raw),
        Rule("fecha_vacia", no_date & is_blank(F.col("fecha")), "Fecha vacia o nula"),
        Rule("fecha_invalida", no_date, "Formato de fecha no reconocido: '%s'", clean(F.col("fecha"))),
        Rule("monto_vacio", no_amount & is_blank(F.col("monto")), "monto vacio o nulo, no se puede procesar", named=True),
        Rule(
            "monto_no_numerico", ~is_decimal(monto, F.col("_exacto")), "monto no numerico ('%s')", monto, named=True
        ),
        Rule("precision:monto", F.col("monto_ok").isNull(), "monto excede numeric(15,2)", phase=WRITE),
        *limits,
    ]
    return validate(typed, ladder, who).drop("_monto", "_tipo", "_exacto", "_signo", CORRUPT)


def accepted_transactions(validated: DataFrame) -> DataFrame:
    """Rows that pass every row rule, with the order key; duplicates are still in."""
    return accepted(validated).select(
        "seq",
        F.col("id").alias("id_origen"),
        F.col("fecha_ok").alias("fecha"),
        F.col("monto_ok").alias("monto"),
        F.col("tipo_ok").alias("tipo"),
        "es_anomalia",
        "motivo_anomalia",
    )


def written_transactions(validated: DataFrame, repeated: DataFrame | None = None) -> DataFrame:
    """The detail table: the first arrival of each (date, stored amount, type)."""
    kept = first_arrivals(accepted_transactions(validated), TX_KEY, repeated=repeated)
    return kept.select(*TX_TABLE.names)


def written_by_range(validated: DataFrame, part: Column, repeated: DataFrame | None = None) -> DataFrame:
    """The same detail table with ``seq`` and the input range each row came from, for a layout by range."""
    kept = first_arrivals(accepted_transactions(validated), TX_KEY, repeated=repeated)
    return kept.select("seq", *TX_TABLE.names, part.alias(RANGE))


def repeated_transaction_keys(validated: DataFrame) -> DataFrame:
    """Natural keys held by more than one accepted row, with the row that keeps each."""
    return repeated_keys(accepted_transactions(validated), TX_KEY)


def duplicate_transactions(validated: DataFrame, repeated: DataFrame | None = None) -> DataFrame:
    """Write-phase rejects: later arrivals of a natural key, in the shape of the reject trail."""
    rows = accepted(validated).select(
        "seq", *(F.col(c).alias(f"_{c}") for c in RAW), F.col("fecha_ok").alias("fecha"),
        F.col("monto_ok").alias("monto"), F.col("tipo_ok").alias("tipo"),
    )
    return late_arrivals(rows, TX_KEY, repeated).select(
        "seq",
        *(F.col(f"_{c}").alias(c) for c in RAW),
        F.lit(WRITE).alias(REJECT_COLUMNS[0]),
        F.lit("clave_duplicada").alias(REJECT_COLUMNS[1]),
        F.format_string(DUPLICATE, F.col("_kept").cast("string")).alias(REJECT_COLUMNS[2]),
    )


def rejected_transactions(validated: DataFrame, repeated: DataFrame | None = None) -> DataFrame:
    """The whole reject trail: row rules and duplicates."""
    return rejected(validated, RAW).unionByName(duplicate_transactions(validated, repeated))


def summarize_transactions(written: DataFrame, skipped: int) -> DataFrame:
    """The report row of a published detail table, totals as wide as they come; ``skipped`` comes from the counters."""
    return written.agg(
        F.count(F.lit(1)).alias("total_procesadas"),
        F.count_if("es_anomalia").alias("total_anomalias"),
        F.lit(skipped).cast("long").alias("total_omitidas"),
        _total("CREDITO").alias("monto_total_creditos"),
        _total("DEBITO").alias("monto_total_debitos"),
    )


def _total(tipo: str) -> Column:
    return F.coalesce(F.sum(F.when(F.col("tipo") == tipo, F.col("monto"))), F.lit(0)).cast(WIDE_TOTAL)


def transaction_summary(validated: DataFrame) -> DataFrame:
    """The report straight from validated rows, in one shuffle.

    Rejected rows share one all-null key per phase, so they collapse before the shuffle. Every
    aggregate has a fixed-width buffer, hence hash aggregation with map-side combine throughout.
    """
    groups = _by_natural_key(validated).agg(
        F.count(F.lit(1)).alias("_n"), F.min_by("es_anomalia", "seq").alias("es_anomalia")
    )
    kept = F.col("reject_phase").isNull()
    return groups.agg(
        F.count_if(kept).alias("total_procesadas"),
        F.count_if(kept & F.col("es_anomalia")).alias("total_anomalias"),
        F.coalesce(F.sum(F.col("_n") - kept.cast("int")), F.lit(0)).alias("total_omitidas"),
        _total("CREDITO").cast(TOTAL).alias("monto_total_creditos"),
        _total("DEBITO").cast(TOTAL).alias("monto_total_debitos"),
    )


def count_by_anomaly(validated: DataFrame) -> DataFrame:
    """Rows of the detail table by anomaly flag, without carrying its texts through the shuffle."""
    kept = _by_natural_key(accepted(validated)).agg(F.min_by("es_anomalia", "seq").alias("es_anomalia"))
    return kept.groupBy("es_anomalia").agg(F.count(F.lit(1)).alias("filas"))


def transaction_metrics(validated: DataFrame) -> DataFrame:
    """Step counters in one shuffle, duplicates counted as write-phase skips."""
    groups = _by_natural_key(validated).agg(F.count(F.lit(1)).alias("_n"))
    return groups.select(
        F.when(F.col("reject_phase").isNull(), 1).otherwise(0).cast("long").alias("escritos"),
        F.coalesce(F.col("reject_phase"), F.lit(WRITE)).alias("reject_phase"),
        F.col("_n"),
    ).groupBy().agg(
        F.coalesce(F.sum(F.when(F.col("reject_phase") != "read", F.col("_n"))), F.lit(0)).alias("leidos"),
        F.coalesce(F.sum("escritos"), F.lit(0)).alias("escritos"),
        *(
            F.coalesce(
                F.sum(F.when(F.col("reject_phase") == phase, F.col("_n") - F.col("escritos"))), F.lit(0)
            ).alias(name)
            for phase, name in (
                ("read", "omitidos_lectura"), ("process", "omitidos_proceso"), ("write", "omitidos_escritura"),
            )
        ),
    )


def _by_natural_key(validated: DataFrame):
    ok = F.col("reject_phase").isNull()
    return validated.groupBy(
        "reject_phase",
        F.when(ok, F.col("fecha_ok")).alias("fecha"),
        F.when(ok, F.col("monto_ok")).cast(MONEY).alias("monto"),
        F.when(ok, F.col("tipo_ok")).alias("tipo"),
    )
