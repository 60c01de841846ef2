"""Every operator as a query over a folder of Parquet tables: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerq.config import RunConfig
from ledgerq.functions.dates import with_date
from ledgerq.functions.numbers import is_decimal, money, wide_decimal
from ledgerq.functions.text import clean, fold_accents, is_blank
from ledgerq.operators.constraints import check_constraints
from ledgerq.operators.dedup import key_conflicts
from ledgerq.operators.row_ranges import RANGE, range_of, range_of_dense, range_plan, split_points, write_by_range
from ledgerq.operators.rules import CORRUPT, accepted, validated_where
from ledgerq.plans import interest, movements, profiles, runs, transactions
from ledgerq.plans.metrics import less_turned_away, stack, step_counters, with_gate, with_skip_limit, with_status
from ledgerq.schemas import INT_KEY, INT_NATURAL_KEY, MOV_LIMITS, TX_INPUT
from ledgerq.sources import buckets, derived
from ledgerq.sources.delimited import scan, scan_ordered
from ledgerq.sources.tables import replace_table
from ledgerq.sources.workspace import cut, fresh_path
from ledgerq.streaming.incremental import UniqueKey, load_new_files, loaded

Query = Callable[[SparkSession, str], DataFrame]
RANGES = 7
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _tx(spark: SparkSession, sf: str) -> DataFrame:
    return transactions.validate_transactions(derived.raw_transactions(spark, sf))


def _int(spark: SparkSession, sf: str) -> DataFrame:
    return interest.validate_interest(derived.raw_interest(spark, sf))


def _mov(spark: SparkSession, sf: str) -> DataFrame:
    return movements.validate_movements(derived.raw_movements(spark, sf))


def _counters(spark: SparkSession, sf: str) -> DataFrame:
    return stack(
        {
            "transacciones": transactions.transaction_metrics(_tx(spark, sf)),
            "intereses": less_turned_away(step_counters(_int(spark, sf)), interest.serial_verdicts(_int(spark, sf))),
            "cuentas-anuales": step_counters(_mov(spark, sf)),
        }
    )


# Scans


def transactions_csv(spark: SparkSession, sf: str) -> str:
    """The raw transactions as a folder of delimited files."""
    path = fresh_path(spark, "transactions-csv")
    raw = derived.raw_transactions(spark, sf).select(*TX_INPUT.names)
    raw.write.option("header", True).option("escape", '"').csv(path)
    return path


def damaged_csv(spark: SparkSession, sf: str) -> str:
    """The same with short lines, long lines, keys that are no number, comment lines and blank lines."""
    path = fresh_path(spark, "damaged-csv")
    line = F.concat_ws(",", F.col("id").cast("string"), "fecha", "monto", F.trim("tipo"))
    key = F.col("id")
    damaged = (
        F.when(key % 11 == 3, F.concat_ws(",", key.cast("string"), "fecha"))
        .when(key % 13 == 3, F.concat(line, F.lit(",sobra")))
        .when(key % 17 == 3, F.concat(F.lit("x"), line))
        .when(key % 19 == 3, F.concat(F.lit("#"), line))
        .when(key % 23 == 3, F.concat(line, F.lit("\n")))
        .when(key % 29 == 3, F.concat(line, F.lit("\n  ")))
        .otherwise(line)
    )
    # Written as plain text, with the header in front of the first line of each file.
    header = F.lit(",".join(TX_INPUT.names) + "\n")
    first = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0
    lines = derived.raw_transactions(spark, sf).select(damaged.alias("line"))
    lines.select(F.when(first, F.concat(header, "line")).otherwise(F.col("line"))).write.text(path)
    return path


@query
def csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    lines = scan(spark, transactions_csv(spark, sf), TX_INPUT).where(F.col(CORRUPT).isNull())
    return lines.select("id", *(clean(F.col(c)).alias(c) for c in TX_INPUT.names[1:]))


@query
def csv_malformed(spark: SparkSession, sf: str) -> DataFrame:
    lines = scan_ordered(spark, damaged_csv(spark, sf), TX_INPUT)
    rejects = transactions.validate_transactions(lines).where(F.col("reject_phase") == "read")
    return rejects.select("reject_phase", "reject_code", "reject_reason")


@query
def csv_row_numbers(spark: SparkSession, sf: str) -> DataFrame:
    """Row numbers of a scan are 1 to n, each once, malformed lines included."""
    seq = scan_ordered(spark, damaged_csv(spark, sf), TX_INPUT).select("seq", "id", CORRUPT)
    return seq.agg(
        F.count(F.lit(1)).alias("filas"),
        F.min("seq").alias("primera"),
        F.max("seq").alias("ultima"),
        F.sum("seq").cast("long").alias("suma"),
        F.count(CORRUPT).alias("malformadas"),
        F.count("id").alias("con_clave"),
    )


@query
def range_split_plan(spark: SparkSession, sf: str) -> DataFrame:
    return range_plan(derived.raw_transactions(spark, sf), RANGES)


@query
def range_split_rows(spark: SparkSession, sf: str) -> DataFrame:
    raw = derived.raw_transactions(spark, sf)
    return raw.select("id", range_of(split_points(raw, RANGES)).alias("particion"))


@query
def range_read(spark: SparkSession, sf: str) -> DataFrame:
    """The numbered lines of a file laid out by range, of which three neighbouring ranges are read."""
    lines = scan_ordered(spark, transactions_csv(spark, sf), TX_INPUT).drop(CORRUPT)
    laid_out = write_by_range(lines.withColumn(RANGE, range_of_dense(lines.count(), RANGES)), fresh_path(spark, "ranges"))
    return laid_out.where(F.col(RANGE).between(2, 4)).groupBy(RANGE).agg(F.count(F.lit(1)).alias("filas"))


# Column rules


@query
def date_normalize(spark: SparkSession, sf: str) -> DataFrame:
    dated = with_date(derived.raw_transactions(spark, sf), "fecha")
    return dated.select("id", "fecha", "fecha_ok", "formato_fecha")


@query
def date_format_counts(spark: SparkSession, sf: str) -> DataFrame:
    return profiles.layout_counts(derived.raw_transactions(spark, sf))


@query
def amount_parse(spark: SparkSession, sf: str) -> DataFrame:
    text = clean(F.col("monto"))
    state = (
        F.when(is_blank(F.col("monto")), "vacio")
        .when(~is_decimal(text, wide_decimal(text)), "no_numerico")
        .otherwise("ok")
    )
    raw = derived.raw_transactions(spark, sf)
    return raw.select("id", F.col("monto").alias("crudo"), money(text).alias("monto"), state.alias("estado"))


@query
def mov_type_normalize(spark: SparkSession, sf: str) -> DataFrame:
    folded = fold_accents(F.lower(clean(F.col("transaccion"))))
    return derived.raw_movements(spark, sf).select("seq", "transaccion", folded.alias("tipo_movimiento"))


@query
def profile_types(spark: SparkSession, sf: str) -> DataFrame:
    return profiles.value_counts(
        {
            "transacciones": (derived.raw_transactions(spark, sf), "tipo"),
            "intereses": (derived.raw_interest(spark, sf), "tipo"),
            "cuentas-anuales": (derived.raw_movements(spark, sf), "transaccion"),
        }
    )


@query
def constraint_violations(spark: SparkSession, sf: str) -> DataFrame:
    """Texts offered as movements: dates missing, amounts too large, descriptions too long."""
    offered = derived.table(spark, sf, "documents").select(
        F.col("doc_id").alias("cuenta_id"),
        F.when(F.col("n_chars") >= 100, F.lit(dt.date(2024, 1, 1))).alias("fecha"),
        F.col("source").alias("tipo_movimiento"),
        (F.col("n_chars").cast("decimal(20,0)") * F.lit(10**9).cast("decimal(10,0)")).alias("monto"),
        F.col("text").alias("descripcion"),
        (F.col("n_chars") > 1000).alias("es_anomalia"),
        F.col("lang").alias("motivo_anomalia"),
    )
    broken = check_constraints(offered, MOV_LIMITS).where(F.col("reject_code").isNotNull())
    return broken.select("cuenta_id", "reject_phase", "reject_code", "reject_reason")


# Transactions


@query
def tx_accepted(spark: SparkSession, sf: str) -> DataFrame:
    return transactions.accepted_transactions(_tx(spark, sf)).drop("seq")


@query
def tx_anomalies(spark: SparkSession, sf: str) -> DataFrame:
    return transactions.accepted_transactions(_tx(spark, sf)).where("es_anomalia").drop("seq")


@query
def tx_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return transactions.written_transactions(_tx(spark, sf))


@query
def tx_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return transactions.duplicate_transactions(_tx(spark, sf))


@query
def tx_rejects(spark: SparkSession, sf: str) -> DataFrame:
    return transactions.rejected_transactions(_tx(spark, sf))


@query
def tx_rejects_of_range(spark: SparkSession, sf: str) -> DataFrame:
    """Rejected rows of a range of ids: the range reaches the scan, the verdict is made for its rows only."""
    raw = derived.raw_transactions(spark, sf)
    rows = validated_where(raw, transactions.validate_transactions, "id BETWEEN 1000 AND 9000", "reject_code IS NOT NULL")
    return rows.select("id", "reject_phase", "reject_code")


@query
def tx_summary(spark: SparkSession, sf: str) -> DataFrame:
    return transactions.transaction_summary(_tx(spark, sf))


@query
def tx_by_anomaly(spark: SparkSession, sf: str) -> DataFrame:
    return transactions.count_by_anomaly(_tx(spark, sf))


@query
def tx_partitioned(spark: SparkSession, sf: str) -> DataFrame:
    points = split_points(derived.raw_transactions(spark, sf), RunConfig().partitions)
    return transactions.written_by_range(_tx(spark, sf), range_of(points)).drop("seq")


@query
def sink_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    """Load twice: the second purge leaves one copy."""
    path = fresh_path(spark, "sink")
    detail = transactions.written_transactions(_tx(spark, sf))
    replace_table(detail, path)
    return replace_table(detail, path)


# Interest


@query
def int_calc(spark: SparkSession, sf: str) -> DataFrame:
    return interest.calculated_interest(_int(spark, sf))


@query
def int_rejects(spark: SparkSession, sf: str) -> DataFrame:
    return interest.rejected_interest(_int(spark, sf))


@query
def int_upsert_latest(spark: SparkSession, sf: str) -> DataFrame:
    return interest.latest_accounts(_int(spark, sf), derived.stored_accounts(spark, sf))


@query
def int_upsert_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_path(spark, "accounts")
    buckets.merge(None, cut(derived.stored_accounts(spark, sf), "stored"), INT_KEY, f"{path}/1")
    return buckets.merge(f"{path}/1", cut(interest.latest_accounts(_int(spark, sf)), "incoming"), INT_KEY, f"{path}/2")


@query
def int_upsert_serial(spark: SparkSession, sf: str) -> DataFrame:
    return interest.serial_accounts(interest.serial_verdicts(_int(spark, sf)))


@query
def int_upsert_serial_stored(spark: SparkSession, sf: str) -> DataFrame:
    stored = derived.stored_accounts(spark, sf)
    return interest.serial_accounts(interest.serial_verdicts(_int(spark, sf), stored), stored)


@query
def int_write_rejects(spark: SparkSession, sf: str) -> DataFrame:
    verdicts = interest.serial_verdicts(_int(spark, sf))
    return verdicts.where(~F.col("conserva")).select("seq", "cuenta_id", *INT_NATURAL_KEY)


@query
def int_key_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    return key_conflicts(interest.latest_accounts(_int(spark, sf)), INT_NATURAL_KEY)


@query
def int_key_profile(spark: SparkSession, sf: str) -> DataFrame:
    return profiles.key_profile(interest.calculated_interest(_int(spark, sf)), INT_NATURAL_KEY)


# Movements


@query
def mov_accepted(spark: SparkSession, sf: str) -> DataFrame:
    return movements.accepted_movements(_mov(spark, sf))


@query
def mov_rejects(spark: SparkSession, sf: str) -> DataFrame:
    return movements.rejected_movements(_mov(spark, sf))


@query
def mov_sign_fix(spark: SparkSession, sf: str) -> DataFrame:
    fixed = accepted(_mov(spark, sf)).where("es_anomalia")
    return fixed.select("seq", "tipo_movimiento", F.col("monto_ok").alias("monto"), "motivo_anomalia")


@query
def annual_statement(spark: SparkSession, sf: str) -> DataFrame:
    return movements.annual_statement(movements.accepted_movements(_mov(spark, sf)))


@query
def statement_upsert(spark: SparkSession, sf: str) -> DataFrame:
    return movements.upsert_statement(derived.stored_statements(spark, sf), annual_statement(spark, sf))


@query
def statement_sample(spark: SparkSession, sf: str) -> DataFrame:
    return annual_statement(spark, sf).orderBy("cuenta_id", "anio").limit(10)


# Counters, gate, runs


@query
def step_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return _counters(spark, sf)


@query
def job_report(spark: SparkSession, sf: str) -> DataFrame:
    report = with_status(with_gate(_counters(spark, sf), RunConfig().quality_threshold_pct))
    return report.select("trabajo", "leidos", "escritos", "omitidos", "estado", "salida")


@query
def quality_gate(spark: SparkSession, sf: str) -> DataFrame:
    gated = with_gate(_counters(spark, sf), RunConfig().quality_threshold_pct)
    return gated.select("trabajo", "intentados", "omitidos", "porcentaje_omision", "decision")


@query
def skip_limit_check(spark: SparkSession, sf: str) -> DataFrame:
    checked = with_skip_limit(_counters(spark, sf), RunConfig(skip_limit=900))
    return checked.select("trabajo", "omitidos", "limite", "limite_superado")


@query
def run_status(spark: SparkSession, sf: str) -> DataFrame:
    """The three loads run for real, into tables of their own, with their ledger rows."""
    sources = {
        "transacciones": derived.raw_transactions(spark, sf),
        "intereses": derived.raw_interest(spark, sf),
        "cuentas-anuales": derived.raw_movements(spark, sf),
    }
    status = runs.run_all(spark, sources, fresh_path(spark, "runs"), config=RunConfig(interest_mode="serial"))
    return status.select(*status.columns[:1], "estado", "salida", "leidos", "escritos", "omitidos_proceso", "omitidos_escritura")


@query
def run_partitioned(spark: SparkSession, sf: str) -> DataFrame:
    """The partitioned load run for real: its ledger row, and the rows of its table by range."""
    base = fresh_path(spark, "partitioned")
    runs.run_transactions_partitioned(spark, derived.raw_transactions(spark, sf), base)
    (row,) = runs.ledger(spark, base).collect()
    layout = spark.read.parquet(row["tablas"]["transacciones_procesadas"])
    shown = ("estado", "salida", "leidos", "escritos", "omitidos_proceso", "omitidos_escritura")
    return layout.groupBy(RANGE).agg(F.count(F.lit(1)).alias("filas"), *(F.lit(row[c]).alias(c) for c in shown))


@query
def incremental_load(spark: SparkSession, sf: str) -> DataFrame:
    """A stream over the files, run twice: the second run finds nothing new."""
    source, target = transactions_csv(spark, sf), fresh_path(spark, "incremental")
    for _ in range(2):
        load_new_files(spark, source, TX_INPUT, transactions.validate_transactions, target, f"{target}-state")
    rows = loaded(spark, target).withColumn("seq", F.col("id"))
    return transactions.written_transactions(rows)


@query
def incremental_unique(spark: SparkSession, sf: str) -> DataFrame:
    """Two arrivals of files in id order; the natural key holds over both, and a third call finds nothing new."""
    source, target = fresh_path(spark, "arrivals"), fresh_path(spark, "unique")
    raw = derived.raw_transactions(spark, sf).select(*TX_INPUT.names)
    key = UniqueKey(transactions.TYPED_KEY, "clave_duplicada", transactions.DUPLICATE)
    for part in (F.col("id") % 64 < 32, F.col("id") % 64 >= 32, F.lit(False)):
        arrived = raw.where(part).repartitionByRange("id").sortWithinPartitions("id")
        arrived.write.mode("append").option("header", True).option("escape", '"').csv(source)
        load_new_files(
            spark, source, TX_INPUT, transactions.validate_transactions, target, f"{target}-state", unique=key
        )
    return loaded(spark, target).select("id", F.col("lote").cast("int").alias("lote"), "reject_phase", "reject_code")
